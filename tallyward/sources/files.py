"""Documents in, results out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """``path, name, stem, content, modified, size, sort_key`` of the PDF files directly in a folder, which must exist.

    Booking goes in order of ``sort_key``, the name in lower case, and then the name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "false").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "content",
                        F.col("modificationTime").alias("modified"), F.col("length").alias("size"), F.lower(name).alias("sort_key"))


def file_hashes(files: DataFrame) -> DataFrame:
    return files.withColumn("file_hash", F.sha2("content", 256))


def write_results(results: DataFrame, folder: str) -> DataFrame:
    """One ``<stem>.json`` per row of ``results (file, payables, declined)``; returns ``file, path`` as written.

    ``folder`` is on a file system that all executors reach.  A file is written beside
    its name and moved there, so a task that runs again leaves the same file.
    """
    from pyarrow import fs

    rows = results.select("file", F.to_json(F.struct("file", "payables", "declined"), {"ignoreNullFields": "false"}).alias("body"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        target.create_dir(root, recursive=True)
        for frame in frames:
            paths = []
            for file, body in zip(frame["file"], frame["body"], strict=True):
                path = f"{root}/{file.rsplit('.', 1)[0]}.json"
                with target.open_output_stream(path + ".part", compression=None) as out:
                    out.write((json.dumps(json.loads(body), indent=2, ensure_ascii=False) + "\n").encode())
                target.move(path + ".part", path)
                paths.append(path)
            yield pd.DataFrame({"file": frame["file"], "path": paths})

    return rows.mapInPandas(run, "file string, path string")
