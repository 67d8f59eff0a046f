"""Duplicates of a stream: each batch is settled against what all batches before it booked.

A row can equal booked rows by any of four tiers, near-equal texts among them, so its verdict
hangs on several keys at once and state under one key can't hold it.  What was booked is therefore
a table that grows by a folder for each batch; a batch is settled by linked groups together with what was booked of these;
for a small batch that is looked up first, so that the table isn't moved.

Booking order is by batch and within it by ``seq``; if batches come in that order, the verdicts equal the batch plan's.
A batch that runs again reads only the folders before its own and overwrites its own two, so a lost driver or a restart leaves
neither a row twice nor one missing.  A batch without rows, and rows with null fields, are settled like in :func:`dedupe.settle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedupe


def settle_batch(rows: DataFrame, folder: str, number: int) -> None:
    """Settle batch ``number`` of :func:`dedupe.evidence`'s input and write ``verdicts/batch=`` and ``booked/batch=`` below ``folder``."""
    spark = rows.sparkSession
    registry = f"{folder}/booked"
    if number == 0:
        spark.createDataFrame([], dedupe.BOOKED).write.mode("overwrite").parquet(f"{registry}/batch=-1")
    prior = spark.read.schema(f"{dedupe.BOOKED}, batch long").parquet(registry).where(f"batch < {number}").drop("batch")
    verdicts, added = dedupe.settle_after(dedupe.evidence(rows), prior)
    verdicts.write.mode("overwrite").parquet(f"{folder}/verdicts/batch={number}")
    added.write.mode("overwrite").parquet(f"{registry}/batch={number}")


def settled(rows: DataFrame, folder: str) -> StreamingQuery:
    """Start settling a stream of rows; ``folder`` (shared by all machines) takes verdicts, booked rows and the stream's own offsets.

    Takes what is there and ends; started again on the same folder it goes on with what is new.
    """
    return (rows.writeStream.foreachBatch(lambda batch, number: settle_batch(batch, folder, number))
            .option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start())
