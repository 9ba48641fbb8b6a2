"""Queries through files against their SQL, and what SQL can't say about sources and sinks."""

import json
import math
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfline.config import CLUSTERING_COLUMNS, Settings
from shelfline.operators import clustering, eligibility, refine
from shelfline.plans import jobs
from shelfline.plans.catalog import QUERIES as CATALOGUE
from shelfline.plans.file_queries import ORACLES, QUERIES
from shelfline.sources import sinks, text_files
from shelfline.sources.scratch import scratch


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_names_are_new():
    assert set(QUERIES) == set(ORACLES) and not set(QUERIES) & set(CATALOGUE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    mine = rows_of(df.columns, df.collect())
    assert mine and mine == rows_of(names, found.fetchall())


def test_one_head_a_group(spark):
    schema = "G_NO string, FINGERPRINT string, RANK string, G_POST_TIME timestamp"
    when = datetime(2024, 1, 1)
    rows = [("x1", "f", "3", when), ("x2", "f", "3", when), ("7", "g", None, when), ("07", "g", None, when), ("8", "g", "x", None)]
    out = {(r["FINGERPRINT"], r["G_NO"]): (r["GROUP_HEAD"], r["GROUP_NUM"]) for r in refine.group_refine(spark.createDataFrame(rows, schema)).collect()}
    assert out == {("f", "x1"): ("N", 2), ("f", "x2"): ("Y", 2), ("g", "7"): ("Y", 3), ("g", "07"): ("N", 3)}


def test_ranks_count_as_numbers(spark):
    rows = [("1", "9"), ("1", "10"), ("2", "x"), ("2", "3"), ("3", "y"), ("4", None)]
    found = eligibility.greatest_ranks(spark.createDataFrame(rows, "G_NO string, RANK string"))
    assert {tuple(r) for r in found.collect()} == {("1", "10"), ("2", "3"), ("3", "y"), ("4", None)}


def test_times_on_the_file_path(spark, tmp_path):
    """A listing whose time doesn't parse counts in its group and is then left out."""
    lines = ["\t".join(["s", no, "c", "name", "1", time, "u", "2.5", "(null)", "(null)", "f", "2024-01-01T00:00:00.000Z"]) for no, time in (("1", "2024-02-03T04:05:06.7Z"), ("2", "2024-02-03T04:05:06Z"), ("3", "(null)"))]
    spark.createDataFrame([(x,) for x in [*lines, "short\tline"]], "value string").write.text(f"{tmp_path}/in")
    jobs.refine_job(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    rows = text_files.read_clustering(spark, f"{tmp_path}/out").collect()
    assert [(r["G_NO"], r["GROUP_NUM"], r["GROUP_HEAD"], r["G_POST_TIME"]) for r in rows] == [("1", 3, "Y", datetime(2024, 2, 3, 4, 5, 6, 7000))]
    assert rows[0]["UPDATE"] == datetime(2024, 1, 1)
    with pytest.raises(Exception, match="(?i)exists"):
        jobs.refine_job(spark, f"{tmp_path}/in", f"{tmp_path}/out")


def test_first_run_inserts(spark, tmp_path):
    goods = spark.createDataFrame([(str(i), "s", "same" if i < 3 else "own", datetime(2024, 1, 1)) for i in range(4)], "G_NO string, CTRL_ROWID string, G_NAME string, G_POST_TIME timestamp").withColumn("RANK", F.lit("1"))
    goods.write.parquet(f"{tmp_path}/eligible")
    jobs.cluster_job(spark, f"{tmp_path}/eligible", f"{tmp_path}/c", Settings())
    assert text_files.read_clustering(spark, f"{tmp_path}/c/result").columns == list(CLUSTERING_COLUMNS)
    jobs.refine_job(spark, f"{tmp_path}/c/result", f"{tmp_path}/r")
    assert sorted((r["G_NO"], r["ACTION"], r["HEAD"]) for r in jobs.delta_job(spark, f"{tmp_path}/r", None).collect()) == [("0", "insert", False), ("1", "insert", False), ("2", "insert", True)]
    memory = refine.group_refine(clustering.fingerprinted(goods)).select("G_NO", "GROUP_NUM", "GROUP_HEAD", "FINGERPRINT")
    filed = text_files.read_clustering(spark, f"{tmp_path}/r").select("G_NO", "GROUP_NUM", "GROUP_HEAD", "FINGERPRINT")
    assert sorted(map(tuple, memory.collect())) == sorted(map(tuple, filed.collect()))


def test_paged_reads(spark):
    def fetch(query):
        args = dict(x.split("=") for x in query.split("&"))
        start, rows = int(args["start"]), int(args["rows"])
        return json.dumps({"response": {"numFound": 25, "docs": [{"id": i, "x": None} for i in range(start, min(25, start + rows))]}})

    for page in (1, 4, 25, 100):
        found = sinks.read_index(spark, fetch, "q=*", ("id", "x", "no`ne"), page).collect()
        assert sorted(int(r["id"]) for r in found) == list(range(25)) and found[0]["x"] is None
    none = sinks.read_index(spark, lambda q: '{"response": {"numFound": 0, "docs": []}}', "q=*", ("id",), 10)
    assert none.count() == 0
    with pytest.raises(ValueError):
        sinks.read_index(spark, fetch, "q=*", ("id",), 0)


def test_endpoints():
    def replica(core, node, state="active", **more):
        return {"core": core, "node_name": node, "base_url": f"http://{node}/s", "state": state} | more

    state = json.dumps({"main": {"shards": {
        "shard1": {"replicas": {"a": replica("m1a", "n1"), "b": replica("m1b", "n2", leader="true"), "c": replica("m1c", "n3", "down")}},
        "shard2": {"replicas": {"a": replica("m2a", "gone")}},
    }}})
    shards = sinks.live_endpoints(state, "all", ["n1", "n2", "n3"], {"all": "main"})
    assert shards == [["http://n2/s/m1b", "http://n1/s/m1a"], []]
    assert sinks.endpoint(shards, 0) == sinks.endpoint(shards, seed=3) == "http://n2/s/m1b" and sinks.endpoint(shards, 0, leader=False) == "http://n1/s/m1a"
    for call in (lambda: sinks.endpoint(shards, 1), lambda: sinks.live_endpoints(state, "x", []), lambda: sinks.live_endpoints(state, "two", [], {"two": "main,other"})):
        with pytest.raises(ValueError):
            call()


def test_settings_overlay(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text('{"threshold": 7, "flush_docs": 50, "batch_ts": "2024-05-06T07:08:09"}')
    assert Settings.load(path=str(path)) == Settings(threshold=7, flush_docs=50, batch_ts=datetime(2024, 5, 6, 7, 8, 9))
    spark.conf.set("spark.shelfline.threshold", "3")
    try:
        assert Settings.load(spark, str(path)).threshold == 3 and Settings.load(spark).flush_docs == 1000
        spark.conf.set("spark.shelfline.unknown", "1")
        with pytest.raises(ValueError, match="unknown"):
            Settings.load(spark)
    finally:
        spark.conf.unset("spark.shelfline.threshold")
        spark.conf.unset("spark.shelfline.unknown")


def test_snapshots_in_several_batches(spark, tmp_path):
    from shelfline.streaming.delta import delta_writer

    seen = []
    run = delta_writer(spark, str(tmp_path / "state"), lambda df, n: seen.append((n, sorted((r["G_NO"], r["ACTION"]) for r in df.collect()))), "snap")
    schema = "G_NO string, FINGERPRINT string, GROUP_HEAD string, GROUP_NUM bigint, UPDATE int, snap int"

    def batch(number, *rows):
        run(spark.createDataFrame([(no, "f", "Y", num, snap, snap) for no, num, snap in rows], schema), number)

    batch(0, ("1", 2, 5))
    batch(1, ("2", 2, 5))
    assert seen == []  # the snapshot may still go on
    batch(7, ("1", 2, 8))
    assert seen == [(5, [("1", "insert"), ("2", "insert")])]
    batch(8, ("2", 1, 8), ("1", 2, 9), ("3", 2, 9))
    assert seen[1:] == [(8, [("2", "delete")])]
    batch(9)
    batch(10, ("1", 1, 12))
    assert seen[2:] == [(9, [("2", "delete"), ("3", "insert")])]


def test_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
