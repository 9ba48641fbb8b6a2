"""Where results go: files, several outputs of one input, and an index service."""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import Settings
from ..operators import clustering
from .text_files import lines_of_rows

#: Sends one request body to a collection of the index; raises if it isn't taken.
Send = Callable[[str, str], None]


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None, overwrite: bool = True) -> None:
    lines_of_rows(df, columns).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def run_path(base: str, run_id: str | None = None) -> str:
    """A folder of its own for a run."""
    return f"{base.rstrip('/')}/{run_id or int(time.time() * 1000)}"


def write_clustering(goods: DataFrame, base: str, settings: Settings = Settings()) -> None:
    """Listings in the 12 columns of the file between jobs, group sizes and sellers'
    ratios, as three outputs of one pass over the fingerprinted input, which is kept
    meanwhile."""
    rows = clustering.fingerprinted(goods).persist()
    try:
        write_tsv(clustering.stamped(rows, settings), f"{base}/result")
        write_tsv(clustering.cluster_info(rows), f"{base}/clusterInfo")
        write_tsv(clustering.seller_dup_ratio(rows), f"{base}/info")
    finally:
        rows.unpersist()


def collection_name(name: str, names: dict[str, str] | None = None) -> str:
    """The stored name of a collection; others stand for themselves."""
    return (names or {}).get(name, name)


def send_documents(docs: DataFrame, send: Send, collection: str, settings: Settings = Settings()) -> None:
    """Sends column ``doc`` in batches of ``flush_docs`` from each partition, with
    a pause after each full one. A batch that isn't taken fails its task, which
    Spark runs again: delivery is at least once, and updates are idempotent."""
    flush, pause = settings.flush_docs, settings.pause_seconds

    def run(rows: Iterator) -> None:
        batch: list[str] = []
        for row in rows:
            batch.append(row["doc"])
            if len(batch) >= flush:
                send(collection, "[" + ",".join(batch) + "]")
                batch = []
                time.sleep(pause)
        if batch:
            send(collection, "[" + ",".join(batch) + "]")

    docs.select("doc").foreachPartition(run)


def send_deletes(ids: DataFrame, send: Send, collection: str, key: str = "G_NO", flush: int = 1000) -> None:
    """Deletes documents by id, in batches."""

    def run(rows: Iterator) -> None:
        batch: list[str] = []
        for row in rows:
            batch.append(row[0])
            if len(batch) >= flush:
                send(collection, json.dumps({"delete": batch}))
                batch = []
        if batch:
            send(collection, json.dumps({"delete": batch}))

    ids.select(ids[key].cast("string")).foreachPartition(run)


def read_index(spark: SparkSession, fetch: Callable[[str], str], query: str, fields: Sequence[str], page: int | None = None) -> DataFrame:
    """Documents that a select query finds; ``fetch`` takes the query's text to the
    body of a JSON response. Without ``page`` the response is one page, whose size the
    query sets. With it the driver asks only how many documents there are, and tasks
    fetch pages of so many, each handed on as it comes."""

    def rows_of(body: str) -> list[list[str | None]]:
        return [[None if x.get(f) is None else str(x[f]) for f in fields] for x in json.loads(body)["response"]["docs"]]

    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    if page is None:
        return spark.createDataFrame(rows_of(fetch(query)), schema)
    if page <= 0:
        raise ValueError("a page needs at least one document")
    count = json.loads(fetch(f"{query}&start=0&rows=0"))["response"]["numFound"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in frame["start"]:
                yield pd.DataFrame(rows_of(fetch(f"{query}&start={start}&rows={page}")), columns=list(fields), dtype=object)

    pages = -(-count // page)
    starts = spark.range(0, count, page, numPartitions=max(1, min(pages, 1000))).withColumnRenamed("id", "start")
    return starts.mapInPandas(run, schema)


def live_endpoints(state: str, collection: str, live: Sequence[str], aliases: dict[str, str] | None = None) -> list[list[str]]:
    """Addresses of each shard's live replicas, leaders first, from the JSON of the
    index service's cluster state. A collection's alias must name one collection."""
    name = (aliases or {}).get(collection, collection)
    if "," in name:
        raise ValueError(f"alias {collection} names several collections")
    found = json.loads(state).get(name)
    if found is None:
        raise ValueError(f"no collection {name}")
    shards = []
    for _, shard in sorted(found["shards"].items()):
        up = [r for r in shard["replicas"].values() if r.get("state") == "active" and r.get("node_name") in live]
        up.sort(key=lambda r: (str(r.get("leader", "")).lower() != "true", r["core"]))
        shards.append([f"{r['base_url']}/{r['core']}" for r in up])
    return shards


def endpoint(shards: Sequence[Sequence[str]], index: int | None = None, seed: int | None = None, leader: bool = True) -> str:
    """One address: of shard ``index``, or of one picked by ``seed``; its leader, or a
    replica that isn't."""
    pick = random.Random(seed)
    usable = [s for s in ([shards[index]] if index is not None else shards) if s]
    if not usable:
        raise ValueError("no live replica")
    shard = pick.choice(usable)
    return shard[0] if leader or len(shard) == 1 else pick.choice(shard[1:])


@contextmanager
def run_lock(spark: SparkSession, folder: str, run_id: str | None = None) -> Iterator[str]:
    """An advisory lock file for the time of a run, on any Hadoop file system. It
    tells others of the run and stops nobody."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/application{run_id or uuid.uuid4().hex}.lock.file")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(path, False).close()
    try:
        yield path.toString()
    finally:
        fs.delete(path, False)
