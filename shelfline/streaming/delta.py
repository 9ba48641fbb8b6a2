"""Group deltas of snapshots that arrive one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import FIELDS, group_delta, snapshot_union


def delta_writer(
    spark: SparkSession, state_path: str, emit: Callable[[DataFrame, int], None], snapshot: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``. Without ``snapshot`` each micro-batch is a whole
    snapshot of refined groups, numbered by its batch. With it that column of whole
    numbers says which snapshot a row belongs to: a snapshot may come in several
    batches and is over when rows of a greater number arrive, so the last one is
    emitted only then. A snapshot is compared with the greatest one before it that
    exists and kept below ``state_path`` by its number and batch; a batch that runs
    again replaces its own files, so its deltas are the same."""

    def stored(number: int) -> DataFrame:
        return spark.read.parquet(f"{state_path}/snapshot={number}").select(*FIELDS)

    def parts(path: str) -> list[int]:
        """Numbers of the folders name=number in a folder."""
        jvm = spark.sparkContext._jvm
        own = jvm.org.apache.hadoop.fs.Path(path)
        fs = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(own)] if fs.exists(own) else []
        return sorted(int(n.partition("=")[2]) for n in names if "=" in n)

    def numbers(before: int | None = None) -> list[int]:
        """Snapshots; with ``before`` those that had rows before that batch."""
        return [n for n in parts(state_path) if before is None or parts(f"{state_path}/snapshot={n}")[0] < before]

    def compare(number: int) -> None:
        before = [n for n in numbers() if n < number]
        current = stored(number)
        emit(group_delta(snapshot_union(current, stored(before[-1]) if before else current.limit(0))), number)

    def run(batch: DataFrame, number: int) -> None:
        if snapshot is None:
            batch.select(*FIELDS).write.mode("overwrite").parquet(f"{state_path}/snapshot={number}/batch={number}")
            compare(number)
            return
        held = batch.select(*FIELDS, snapshot).persist()
        try:
            found = sorted(r[0] for r in held.select(snapshot).distinct().collect())  # snapshots of one batch
            open_before = numbers(number)[-1:]
            for n in found:
                held.where(F.col(snapshot) == n).select(*FIELDS).write.mode("overwrite").parquet(f"{state_path}/snapshot={n}/batch={number}")
        finally:
            held.unpersist()
        # rows of a greater number end the snapshot that was open, and all but the last of this batch
        for n in sorted({*open_before, *found}):
            if found and n < found[-1] and n >= max(open_before, default=n):
                compare(n)

    return run
