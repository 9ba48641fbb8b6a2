"""What the training-data operators share: the shared folder, materialised
tables and small column helpers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Used only where spark.checkpoint.dir is unset and the session is local.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor reach (``spark.checkpoint.dir``).

    A session on a cluster must set it; a local session without it gets
    :data:`LOCAL_SHARED`.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
    return LOCAL_SHARED


#: Paths handed out in this process, in order.
_MADE: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    _MADE.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove_scratch(spark: SparkSession, paths: Sequence[str] | None = None) -> None:
    """Deletes ``paths``, or all that :func:`scratch` handed out in this process:
    results that are still to be computed from them fail then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in list(_MADE if paths is None else paths):
        own = jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(conf).delete(own, True)
        _MADE.remove(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, so
    that the loss of an executor later never repeats the work above it."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``materialize(make(), label)``, after which the files that ``make`` left on its
    way are removed: nothing reads them any more."""
    mark = len(_MADE)
    out = materialize(make(), label)
    remove_scratch(out.sparkSession, _MADE[mark:-1])
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col(quoted(name))


def schema_of(df: DataFrame, names: Sequence[str], more: str = "") -> StructType:
    """The fields ``names`` of ``df``, then those of a DDL string."""
    return StructType([*(df.schema[n] for n in names), *(StructType.fromDDL(more).fields if more else ())])


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``df.mapInArrow``, which can't read columns whose names have dots or back-quotes."""
    plain = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=plain.names)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(renamed, plain).toDF(*schema.names)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_hashes(text: Column) -> list[Column]:
    """128 bits that stand for a text, as two numbers; null has numbers as well."""
    return [F.xxhash64(text).alias("hash_x"), F.xxhash64(F.lit(1), text).alias("hash_y")]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
