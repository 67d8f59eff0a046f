"""Steps that several operators share: computing columns once, and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def spare(df: DataFrame, stem: str) -> str:
    """A prefix with which no column of ``df`` begins."""
    prefix = f"_{stem}_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, also where filters on it follow.

    The optimizer moves a filter below the projection that makes its column, and would evaluate
    that column's whole derivation a second time there.  It moves none below a generator of one row.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*kept, F.explode(F.array(value)).alias(name))


def tasks(spark: SparkSession) -> int:
    """Parts for steps whose rows take long and few bytes: as many as asked for, at least the cores; Spark itself would join small parts into few."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` of a table dealt by ``key`` to all tasks where it has fewer files than there are cores: a file of one row group is read by one task, whatever is asked of its rows."""
    few = len(rows.inputFiles()) < rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks(rows.sparkSession), key) if few else rows


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A new path in ``spark.checkpoint.dir``; in a folder of our own only where none is named and there is one machine."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallyward-")
        context.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to a :func:`scratch_path`, as Parquet, and read from there."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete what :func:`checkpointed` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
