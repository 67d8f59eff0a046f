"""Exact dedup by a persistent index of digests, bucketed and sorted by digest.

A text's digest is the SHA-256 of its UTF-8 bytes with A-Z lower-cased.  The index is two
tables, bucketed and sorted alike, that only grow:

    entries   digest, keep_id      one row per digest: the document that stays
    arrivals  digest, n, batch     how many rows each batch brought, and the batch

A batch is reduced to one row per digest before any shuffle, appended to ``arrivals``, and what a
sort-merge anti-join doesn't find among the entries is appended to ``entries``.  Both sides
of that join are bucketed by digest, so it needs no exchange.  First come stays; within a batch the largest id does.

A group of any number of copies costs one row a task.  Where rows are told what became of them, digests
of more than one in ``HOT`` of all rows, of which there can't be more than ``HOT``, are broadcast, and the rest is shuffled.

Everything is built-in expressions.  Texts are read once; what is shuffled are 32 bytes and an id a row.

Defined results: a null text counts as empty; rows without an id lose to any with one, and stay where a group has
no others (``keep_id`` null).  Rows alike in id and text are told alike; :func:`deduplicated` leaves one of
them.  An empty table changes nothing.  A batch that was added but whose job failed can be added again:
its digests are then found with its own ids, so the same rows stay, though its rows count twice in ``n``.  Extra columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import dropped, join_small, lacking, own_name, scratch_path, written

#: A digest of more than one in so many rows is hot.
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column | str) -> Column:
    """32 bytes; equal for texts that are equal once A-Z are lower-cased."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER).cast("binary"), 256))


class DigestIndex:
    """The index in the folder ``path``, which all machines share; opened if it exists, else made with so many buckets.

    Later sessions open the same folder.  Choose ``buckets`` for the size the index will have: a bucket is what one task sorts.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark = spark
        try:
            self.buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
        except AnalysisException:  # no index yet
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(f"{path}/layout")
        name = f"tallyward_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        self._entries = self._table(f"{name}_entries", "digest BINARY, keep_id BIGINT", f"{path}/entries")
        self._arrivals = self._table(f"{name}_arrivals", "digest BINARY, keep_id BIGINT, n BIGINT, batch STRING", f"{path}/arrivals")

    def _table(self, name: str, columns: str, path: str) -> str:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    @property
    def entries(self) -> DataFrame:
        """``digest, keep_id``."""
        return self.spark.table(self._entries)

    @property
    def sizes(self) -> DataFrame:
        """``digest, n``: rows that came with each digest so far; no exchange."""
        return self.spark.table(self._arrivals).groupBy("digest").agg(F.sum("n").alias("n"))

    def _append(self, rows: DataFrame, table: str) -> None:
        if int(self.spark.conf.get("spark.sql.shuffle.partitions")) != self.buckets:
            rows = rows.repartition(self.buckets, "digest")  # else each task has its buckets to itself already
        rows.write.insertInto(table)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of a batch ``doc_id, digest`` that the index hasn't got."""
        batch = uuid.uuid4().hex
        self._append(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).select("digest", "keep_id", "n", F.lit(batch).alias("batch")), self._arrivals)
        came = self.spark.table(self._arrivals).where(F.col("batch") == batch).select("digest", "keep_id")
        self._append(came.join(self.entries.hint("merge"), "digest", "left_anti"), self._entries)

    def told(self, rows: DataFrame) -> DataFrame:
        """``doc_id, digest, keep_id, group_size`` for each of ``rows (doc_id, digest)``, a written table whose digests are indexed."""
        groups = self.entries.join(self.sizes.hint("merge"), "digest").select("digest", "keep_id", F.col("n").alias("group_size"))
        limit = max(2, -(-rows.count() // HOT))
        hot = groups.where(F.col("group_size") > limit).orderBy(F.desc("group_size"), "digest").limit(HOT)  # more can be only by earlier batches' counts
        hot = F.broadcast(written(hot, "hot_digests"))
        apart = rows.join(hot, "digest", "left")
        known = apart.where("group_size is not null").select("doc_id", "digest", "keep_id", "group_size")
        rest = apart.where("group_size is null").select("doc_id", "digest").join(groups.hint("merge"), "digest")
        return known.unionByName(rest.select("doc_id", "digest", "keep_id", "group_size"))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest`` of every row, written: the one pass over the texts."""
    rows = lacking(docs, [("doc_id", "long"), ("text", "string")])
    return written(rows.select("doc_id", digest("text").alias("digest")), "digests")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``, by a new index in which the largest id of each group stays.

    The upper half of the ids is added first and the lower half deduplicated against it, so first come is largest.
    """
    spark = docs.sparkSession
    index, rows = DigestIndex(spark, path or scratch_path(spark, "digest_index")), digests(docs)
    middle = rows.agg(F.percentile_approx("doc_id", 0.5).alias("m")).first()["m"]
    late = F.coalesce(F.col("doc_id") > F.lit(middle).cast("long"), F.lit(False))
    for part in (late, ~late):
        index.add(rows.where(part))
    return index.told(rows).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` whose texts ``index`` hadn't got, one of each text, all columns; the index has them from now on.

    Texts are moved only where rows are alike in id and text, or where those that go are too many to broadcast.
    """
    rows = digests(docs)
    index.add(rows)
    key = own_name(docs, "digest_key")
    of = lambda hashed: F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), F.lit(":"), F.hex(hashed)), 256))
    told = written(index.told(rows).select(of(F.col("digest")).alias(key), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")).groupBy(key, "kept").agg(F.count(F.lit(1)).alias("rows")), "told")
    dropped(rows)
    marked = join_small(docs.withColumn(key, of(digest("text"))), told.where("not kept").select(key), [key], "left_anti", 64)
    repeated = told.where("kept and rows > 1").select(key)
    once = join_small(marked, repeated, [key], "left_anti", 64).unionByName(join_small(marked, repeated, [key], "left_semi", 64).dropDuplicates([key]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


#: DuckDB's SQL for the registered query.
ORACLE = """
with d as (
  select doc_id, sha256(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from max(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""
