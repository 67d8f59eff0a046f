"""WARC round trips, packing, and the pipeline's stages."""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyarrow import fs

import corpus_pipeline
from tallyward.llm import packing, queries, simhash, warc

from .helpers import DATA, SCHEMA, awkward, clashing, documents, words


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_round_trip_matches_sql(spark):
    big, tricky = "é" * 600, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 60
    rows = [(1, "http://a", big), (2, "u", big), (2, "u", big), (3, None, None), (4, "x\r\ny", ""), (5, "s", "small"), (6, "s", "small"), (7, "t", tricky), (8, "t", tricky), (9, "b", big + "x"), (None, "n", "no id")]
    got = warc.round_trip(clashing(pages(spark, rows)))
    con = duckdb.connect()
    frame = pages(spark, rows).toPandas()
    frame["page_id"] = frame["page_id"].astype("Int64")
    con.register("pages", frame)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, con.sql(warc.ORACLE).fetchall()))
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_records_have_the_mandatory_fields_and_ids_of_their_own(spark, tmp_path):
    """Ids are unique for repeated and null page ids too; payloads of megabytes come back whole."""
    long = "é<p>" * 1_500_000
    rows = [(1, "u", "same"), (1, "u", "same"), (None, None, None), (None, "v", "x"), (5, "w", long), (6, "w", long)]
    folder = f"file://{tmp_path}/w"
    made = warc.write_archives(warc.with_revisits(pages(spark, rows)), folder).cache()
    made.collect()
    heads = []
    for archive in (tmp_path / "w").glob("part-*.gz"):
        raw = gzip.decompress(archive.read_bytes())
        while raw:
            head, _, raw = raw.partition(b"\r\n\r\n")
            heads.append(warc.parse_header(head))
            raw = raw[int(heads[-1]["content-length"]) + 4 :]
    assert len(heads) == 6 == len({h["warc-record-id"] for h in heads})
    assert all({"warc-type", "warc-date", "content-type", "content-length", "warc-target-uri"} <= set(h) for h in heads)
    normal = warc.normalise_archives(made, folder, f"file://{tmp_path}/n").cache()
    got = {r["page_id"]: r for r in warc.read_records(normal, f"file://{tmp_path}/n", with_payload=True).where("page_id > 1").collect()}
    assert bytes(got[6]["payload"]).decode() == long and got[5]["refers_to"] == 6 and got[5]["payload_bytes"] == len(long.encode())


def test_every_archive_has_a_task(spark, tmp_path):
    """Neither rewriting nor reading lands in one task."""
    rows = [(i, "u", f"page {i} " * 40) for i in range(300)]
    folder = f"file://{tmp_path}/w"
    made = warc.write_archives(warc.with_revisits(pages(spark, rows).repartition(8)), folder).cache()
    assert made.count() == 8
    normal = warc.normalise_archives(made, folder, f"file://{tmp_path}/n")
    assert normal.rdd.glom().map(len).collect() == [1] * 8


def test_normalised_archive_is_a_member_per_record(tmp_path):
    """A monolithic stream, and one of several members, become members that each inflate alone; the index finds them."""
    records = [warc.record(warc.Page(i, f"http://{i}", "00"), (b"payload %d " % i) * (i * 40_000 + 1), uuid.uuid4(), "2024-01-01T00:00:00Z") for i in range(4)]
    local = fs.LocalFileSystem()
    whole = b"".join(records)
    for raw in (gzip.compress(whole), b"".join(gzip.compress(r) for r in records), gzip.compress(whole[:100]) + gzip.compress(whole[100:])):
        (tmp_path / "in.gz").write_bytes(raw)
        assert warc.normalise(local, str(tmp_path / "in.gz"), str(tmp_path / "out.gz")) == 4
        out, index = (tmp_path / "out.gz").read_bytes(), (tmp_path / "out.gz.idx").read_bytes()
        import struct

        entries = list(struct.iter_unpack("<QQ", index))
        assert [zlib.decompress(out[o : o + n], 31) for o, n in entries] == records
        assert gzip.GzipFile(fileobj=io.BytesIO(out)).read() == whole


def test_a_record_cut_short_is_an_error(tmp_path):
    (tmp_path / "in.gz").write_bytes(gzip.compress(warc.record(warc.Page(1, "u", "00"), b"x" * 5000, uuid.uuid4(), "2024-01-01T00:00:00Z")[:-500]))
    with pytest.raises(ValueError, match="cut short"):
        warc.normalise(fs.LocalFileSystem(), str(tmp_path / "in.gz"), str(tmp_path / "out.gz"))


# ---- packing


@given(st.integers(1, 9000))
def test_cuts_cover_a_document_and_waste_little(length):
    pieces = packing.cut(length)
    assert sum(pieces) == length and len(pieces) <= length // packing.CAPACITY + 6
    for p in pieces:  # a class's bin leaves little empty, or is made of the class's own size
        k = packing.CAPACITY // p
        assert packing.CAPACITY - k * p <= max(packing.SLACK, k - 1)


def check_packing(rows, ids_of, capacity=2048):
    """Every id in exactly one piece; sequences gapless and within capacity; returns the share of padding."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    total = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        total += at
        padded += at if at & (at - 1) == 0 else capacity
    for (doc, n), pieces in by_doc.items():
        ids = ids_of(doc)
        if ids is not None:
            assert len(ids) == n
            at = 0
            for r in sorted(pieces, key=lambda r: r["start"]):
                part = ids[r["start"] : r["start"] + r["length"]]
                assert r["start"] == at and zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in part)) == r["ids_crc32"]
                at += r["length"]
            assert at == n
    return (padded - total) / max(padded, 1)


def test_packing_of_whole_table(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op6_packing(spark, DATA).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert check_packing(rows, lambda d: [*plain.encode(texts[d], add_special_tokens=False).ids, 1]) < 0.01


def test_packing_of_awkward_rows(spark):
    texts = [(i, t) for i, t in awkward() if i not in (1, 2, None)] + [(50, "<|endoftext|> x"), (51, "汉字 and 🎉 “quotes” ​"), (52, None)]
    encode = packing.encoder()
    slow = encode.slow
    rows = packing.pack(clashing(documents(spark, texts)), with_ids=True).collect()
    check_packing(rows, lambda d: [*slow.encode(dict(texts)[d] or "", add_special_tokens=False).ids, 1])
    repeated = packing.pack(documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, "c")])).collect()
    assert len(repeated) >= 4 and sum(r["length"] for r in repeated) == 2 * 3 + 2 * 2
    assert packing.pack(documents(spark, [])).count() == 0


def test_both_token_formats_agree():
    encode = packing.encoder()
    for text in ("Hello  world\n\n x", "naïve café été", "don't we'll\t tabs", "a" * 3000, "  lead", "1234567 8.9", "Éé ñ ß"):
        assert encode(text) == encode.slow.encode(text, add_special_tokens=False).ids


# ---- pipeline


def tables(spark, folder, docs, labels, bench):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_each_stage_on_planted_rows(spark, tmp_path):
    clean = {i: " ".join(words(1000 + i, 90)) for i in range(60)}
    passage, question = " ".join(words(5, 70)), " ".join(words(6, 14))
    base = words(7, 200)
    near = [*base]
    near[100] = "altered"
    texts = [*clean.items(), (100, "vile scum " + " ".join(words(8, 60))), (101, passage + " " + " ".join(words(9, 40))), (102, " ".join(words(10, 40)) + " " + passage), (103, " ".join(words(12, 80))), (104, " ".join(words(12, 80))),
             (105, " ".join(words(13, 40)) + " " + question), (106, ""), (107, None)]
    toxic = [(200 + i, f"vile scum {' '.join(words(300 + i, 30))}") for i in range(60)]
    labels = [(i, 1, 0) for i in clean] + [(i, 1, 1) for i, _ in toxic]
    folder = str(tmp_path / "t")
    docs = documents(spark, texts + toxic)
    tables(spark, folder, docs, labels, [(1, question)])
    frames, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, folder)
        if name != "packing":
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{name}")
            at = spark.read.parquet(f"{folder}/{name}")
            frames[name] = {r["doc_id"]: r["text"] for r in at.collect()}
    assert set(frames["toxicity"]) == {i for i, _ in texts} - {100}
    lines = frames["line_dedup"]
    assert 104 not in lines and lines[103] == dict(texts)[103] and passage in lines[101] and passage not in lines[102] and len(lines[102].split()) == 40
    assert all(lines[i] == clean[i] for i in clean)
    kept = frames["simhash_near_dedup"]
    assert (106 in kept) and 107 not in kept and set(clean) <= set(kept)
    assert 105 not in frames["benchmark_decontamination"] and set(clean) <= set(frames["benchmark_decontamination"])
    packed = corpus_pipeline.run(spark, folder).collect()
    final = frames["benchmark_decontamination"]
    encode = packing.encoder()
    assert {r["doc_id"] for r in packed} == set(final)
    check_packing(packed, lambda d: [*encode(final[d] or ""), 1])


def test_near_copies_leave_one(spark):
    base = words(7, 300)
    rows = []
    for i in range(5):
        copy = list(base)
        copy[50 + i] = f"changed{i}"
        rows.append((i + 1, " ".join(copy)))
    docs = documents(spark, rows)
    components = {r["doc_id"]: r["component_id"] for r in simhash.components(docs).collect()}
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    assert kept == {i for i, c in components.items() if i == c}


def test_stages_on_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "e")
    tables(spark, folder, spark.createDataFrame([], SCHEMA), [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_on_awkward_rows_with_clashing_columns(spark, tmp_path):
    """Nulls, ties, repeated rows, one id with several texts, a very long text: every stage keeps the columns, and rows are those that brute force keeps."""
    from .test_dedup import plain_kept

    folder = str(tmp_path / "a")
    texts = [*awkward(300), (9, "one text " + " ".join(words(51, 80))), (9, "another text " + " ".join(words(52, 80))), (10, None), (None, None)]
    docs = clashing(documents(spark, texts))
    tables(spark, folder, docs, [(1, 1, 0), (None, 1, 1), (9, None, None)], [(1, None), (2, ""), (None, "no such words anywhere in here at all")])
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        before, at = at, spark.read.parquet(f"{folder}/{name}")
        if name == "simhash_near_dedup":
            assert sorted(str(r["doc_id"]) for r in at.collect()) == sorted(map(str, plain_kept([(r["doc_id"], r["text"]) for r in before.collect()])))
    packed = corpus_pipeline.STAGES[-1][1](spark, at, folder).collect()
    assert sum(r["length"] for r in packed) == sum({(r["doc_id"], r["doc_tokens"]): r["doc_tokens"] for r in packed if r["start"] == 0 and r["doc_id"] is not None}.values()) + sum(
        r["doc_tokens"] for r in packed if r["start"] == 0 and r["doc_id"] is None)


def test_a_task_that_runs_twice_keeps_one_archive(tmp_path):
    """Also on file systems that refuse to rename onto a file; without such a file the error stands."""

    class Strict:
        def __init__(self):
            self.local = fs.LocalFileSystem()

        def move(self, own, final):
            if self.local.get_file_info(final).type == fs.FileType.File:
                raise OSError("file exists")
            self.local.move(own, final)

        def __getattr__(self, name):
            return getattr(self.local, name)

    for target in (fs.LocalFileSystem(), Strict()):
        for _ in range(2):
            (tmp_path / "own").write_bytes(b"same")
            warc._finish(target, str(tmp_path / "own"), str(tmp_path / "final"))
        assert [x.name for x in tmp_path.iterdir()] == ["final"]
        (tmp_path / "final").unlink()
    with pytest.raises(OSError):
        warc._finish(Strict(), str(tmp_path / "none"), str(tmp_path / "final"))
