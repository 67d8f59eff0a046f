"""What comes from outside: rendering, recognition and language models, all injectable.

A provider is made once per Python worker, by a factory that is sent there.  Failures
become columns; nothing raised by a provider ends a job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import present, sufficient
from ..operators.classify import AMBIGUOUS, CLASSES
from ..operators.classify import TYPE as CLASSIFICATION

#: content -> texts of its pages, or an exception
Renderer = Callable[[bytes], list[str]]
#: path or image reference -> text
Recogniser = Callable[[str], str]
#: prompt text -> decoded response
Model = Callable[[str], object]

PAGES = "path string, page_number int, embedded_text string, page_error string, render_error string"


def render(files: DataFrame, factory: Callable[[], Renderer]) -> DataFrame:
    """A row per page; a file that can't be opened or has no pages gives one row with ``render_error`` and no page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        renderer = factory()
        for frame in frames:
            rows: list[tuple] = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    pages = renderer(bytes(content))
                    if not pages:
                        rows.append((path, None, None, None, "no pages"))
                    for i, page in enumerate(pages, 1):
                        failed = isinstance(page, Exception)
                        rows.append((path, i, None if failed else page, str(page) if failed else None, None))
                except Exception as error:  # noqa: BLE001 - isolates the file
                    rows.append((path, None, None, None, str(error) or type(error).__name__))
            yield pd.DataFrame(rows, columns=["path", "page_number", "embedded_text", "page_error", "render_error"])

    return files.select("path", "content").mapInPandas(run, PAGES)


def recognise(pages: DataFrame, factory: Callable[[], Recogniser] | None) -> DataFrame:
    """``ocr_text`` for pages whose own text isn't enough; others never reach the provider."""
    if factory is None:
        return pages.withColumn("ocr_text", F.lit(None).cast("string"))

    @F.pandas_udf("string")
    def read(references: Iterator[pd.Series]) -> Iterator[pd.Series]:
        engine = factory()

        def one(reference: str | None) -> str | None:
            if reference is None:
                return None
            try:
                return engine(reference) or ""
            except Exception:  # noqa: BLE001 - isolates the page
                return ""

        for batch in references:
            yield batch.map(one)

    # one pass: pages that need no recognition, or have none to recognise, hand the provider a null
    poor = ~sufficient("embedded_text") & F.col("page_error").isNull() & F.col("render_error").isNull()
    return pages.withColumn("ocr_text", read(F.when(poor, F.concat_ws("#", "path", F.col("page_number").cast("string")))))


def choose_text(embedded: Column, ocr: Column) -> tuple[Column, Column]:
    """A page's text and its source: its own if that is enough, else what was recognised, else its own for what it is."""
    enough, read = sufficient(embedded), present(ocr)
    return (F.when(enough, embedded).when(read, ocr).otherwise(F.coalesce(embedded, F.lit(""))),
            F.when(enough, F.lit("embedded")).when(read, F.lit("ocr")).otherwise(F.lit("none")))


def _valid_classification(answer: object) -> dict:
    if not isinstance(answer, dict) or answer.get("label") not in CLASSES:
        raise ValueError("no valid label")
    sure = answer.get("confidence")
    if isinstance(sure, bool) or not isinstance(sure, (int, float)) or not 0 <= sure <= 1:
        raise ValueError("no valid confidence")
    evidence = answer.get("evidence")
    if not isinstance(evidence, list) or not all(isinstance(e, str) for e in evidence):
        raise ValueError("no valid evidence")
    return {"doc_class": answer["label"], "doc_type": answer.get("doc_type", "unknown"), "reason": answer.get("reason", "language model"), "confidence": float(sure), "evidence": evidence}


def _valid_extraction(answer: object) -> dict:
    if not isinstance(answer, dict) or not {"line_items", "confidence"} <= answer.keys() or not isinstance(answer["line_items"], list):
        raise ValueError("no line items")
    sure = answer["confidence"]
    if isinstance(sure, bool) or not isinstance(sure, (int, float)) or not 0 <= sure <= 1 or not isinstance(answer.get("fields", {}), dict):
        raise ValueError("no valid confidence or fields")
    return {"fields": json.dumps(answer.get("fields", {}), sort_keys=True), "line_items": json.dumps(answer["line_items"]), "confidence": float(sure)}


def _ask(model: Model, prompt: str, check: Callable[[object], dict], attempts: int) -> tuple[dict | None, str]:
    error = "not asked"
    for _ in range(attempts):
        try:
            return check(model(prompt)), ""
        except Exception as failed:  # noqa: BLE001 - any failure is tried again
            error = str(failed)
    return None, error


def classify(texts: DataFrame, factory: Callable[[], Model], attempts: int = 3) -> DataFrame:
    """``texts`` with ``classification`` by a model; after the last invalid answer, ambiguous with confidence 0."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            out = []
            for prompt in frame["text"]:
                good, error = _ask(model, prompt, _valid_classification, attempts)
                out.append(good or {"doc_class": AMBIGUOUS, "doc_type": "unknown", "reason": f"no valid answer in {attempts} attempts: {error}", "confidence": 0.0, "evidence": []})
            yield frame.assign(classification=out)

    schema = ", ".join(f"`{n}` {k}" for n, k in texts.dtypes)
    return texts.mapInPandas(run, f"{schema}, classification {CLASSIFICATION}")


def extract(texts: DataFrame, factory: Callable[[], Model], attempts: int = 3) -> DataFrame:
    """``texts`` with ``extraction`` by a model (fields and line items as JSON); null after the last invalid answer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            yield frame.assign(extraction=[_ask(model, prompt, _valid_extraction, attempts)[0] for prompt in frame["text"]])

    schema = ", ".join(f"`{n}` {k}" for n, k in texts.dtypes)
    return texts.mapInPandas(run, f"{schema}, extraction struct<fields:string,line_items:string,confidence:double>")
