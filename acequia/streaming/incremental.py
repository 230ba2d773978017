"""Type-1 upsert of arriving batches with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from acequia.operators.dedupe import dedupe_keep_last
from acequia.operators.upsert import CHANGE, delta, upsert
from acequia.sources.tables import current_run, publish, read_published, run_tables

KEEP_RUNS = 3


def upsert_stream(
    arriving: DataFrame,
    initial: DataFrame,
    root: str,
    table: str,
    keys: Sequence[str],
    attrs: Sequence[str],
    order: str,
    checkpoint: str,
) -> StreamingQuery:
    """Apply every available micro-batch to a published table, then stop.

    A batch is published under its number, so one that is delivered again after a
    failure is recognised and skipped. The table has a root of its own, as a run
    stands for all tables of its root; another one is refused. The last
    `KEEP_RUNS` snapshots are kept.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark, run_id = batch.sparkSession, f"{number:020d}"
        last = current_run(spark, root)
        if last is not None and last >= run_id:
            return
        if last is not None and run_tables(spark, root, last) != {table}:
            raise ValueError(f"{root} holds other tables than {table}")
        current = initial if last is None else read_published(spark, root, table)
        # last row per key first: an older row must not win because the newest changes nothing
        changes = delta(current, dedupe_keep_last(batch, keys, order), keys, attrs)
        publish({table: upsert(current, changes, keys, attrs, order).drop(CHANGE)}, root, run_id, keep_runs=KEEP_RUNS)

    return (
        arriving.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
