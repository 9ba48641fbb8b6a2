"""Decision tables and edge cases that the driver tables don't have."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfline.config import NULL_TEXT, SELLER_COLUMNS, SHARD_BOUNDS, Settings
from shelfline.functions import hashes, text
from shelfline.operators import clustering, counts, delta, eligibility, imagehash, refine
from shelfline.schemas import ADS, GOODS, IMAGES, RANKS
from shelfline.sources import sequence_files, sinks, text_files


def goods(spark, rows):
    full = [(r[0], r[1], None, r[2], r[3] if len(r) > 3 else datetime(2024, 1, 1), None, 1.0, *(r[4] if len(r) > 4 else (None, None, None))) for r in rows]
    return spark.createDataFrame(full, GOODS)


# ---------------------------------------------------------------- text


def test_lines_with_empty_last_fields_drop_out(spark):
    lines = spark.createDataFrame([("a\tb\tc\td",), ("a\tb\tc\t",), ("a\tb",), ("a\t\t\td",), ("(null)\tb\tc\td",)], "value string")
    got = [tuple(r) for r in text_files.rows_of_lines(lines, SELLER_COLUMNS).collect()]
    assert got == [("a", "b", "c", "d"), ("a", "", "", "d"), (None, "b", "c", "d")]


def test_width_tells_records_apart(spark):
    lines = spark.createDataFrame([("a\t1",), ("a\tb\tc",), ("x",)], "value string")
    kinds = text_files.split_by_width(lines, size=("fp", "n"), row=("a", "b", "c"))
    assert [tuple(r) for r in kinds["size"].collect()] == [("a", "1")]
    assert [tuple(r) for r in kinds["row"].collect()] == [("a", "b", "c")]
    with pytest.raises(ValueError):
        text_files.split_by_width(lines, one=("a",), two=("b",))


def test_time_fraction_is_milliseconds(spark):
    rows = [("2024-01-02T03:04:05.7Z",), ("2024-01-02T03:04:05.123Z",), ("2024-01-02T03:04:05.0Z",), ("2024-01-02T03:04:05Z",), ("(null)",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(text.millis(text.parse_time(F.col("t"))).alias("ms"), text.format_time(text.parse_time(F.col("t"))).alias("s"))
    base = 1704164645000
    assert [r["ms"] for r in df.collect()] == [base + 7, base + 123, base, None, None, None]
    assert df.first()["s"] == "2024-01-02T03:04:05.007Z"


def test_json_lines(spark):
    lines = spark.createDataFrame([('{"G_NO": 5, "IMG_HASH_V2": "ab"}',), ("{bad",), ('{"G_NO": null}',)], "value string")
    got = [tuple(r) for r in text_files.fields_of_json(lines, ("G_NO", "IMG_HASH_V2")).collect()]
    assert got == [("5", "ab"), (None, None)]


def test_count_by_first_column(spark):
    lines = spark.createDataFrame([("a\tx",), ("a",), ("",), ("\tq",)], "value string")
    assert {tuple(r) for r in counts.count_by_first_col(lines).collect()} == {("a", 2), ("", 2)}


# ---------------------------------------------------------------- eligibility


def test_unknown_coin_is_a_running_ad(spark):
    ads = spark.createDataFrame([("1", "s", "r", None), ("2", "s", "R", "0"), ("3", "s", "x", "1"), ("4", "s", None, "1")], ADS)
    assert [r["G_NO"] for r in eligibility.active_ads(ads).collect()] == ["1"]


def test_ads_of_excluded_sellers_exclude_nothing(spark):
    out = spark.createDataFrame([("bad", "A", None, None), ("good", "C", None, None)], "CTRL_ROWID string, APPLY_STATUS string, ASD_WEIGHT string, _SOURCE_TIME string")
    rows = goods(spark, [("1", "good", "n"), ("2", "good", "n"), ("3", "bad", "n"), ("4", None, "n"), ("5", "(null)", "n")])
    ads = spark.createDataFrame([("1", "bad", "r", "5"), ("2", "good", "r", "5")], ADS)
    ranks = spark.createDataFrame([("1", "bad", "9")], RANKS)
    got = eligibility.eligible_goods(rows, ads, ranks, out).collect()
    assert [(r["G_NO"], r["RANK"]) for r in got] == [("1", None)]


def test_listing_filter(spark):
    marks = [(None, None, None), ("", "", "n"), ("0", None, "N"), ("5", None, None), (None, "2020-01-01", None), (None, None, "Y"), (None, None, "y")]
    rows = goods(spark, [(str(i), "s", "n", datetime(2024, 1, 1), m) for i, m in enumerate(marks)])
    assert [r["G_NO"] for r in eligibility.eligible_listings(rows).collect()] == ["0", "1", "2"]


# ---------------------------------------------------------------- groups


def test_null_names_of_a_seller_are_one_group(spark):
    rows = clustering.fingerprinted(goods(spark, [("1", "s", None), ("2", "s", None), ("3", "t", None)]))
    assert sorted(r["n"] for r in clustering.cluster_info(rows).collect()) == [1, 2]


def test_size_counts_rows_without_time_and_head_order(spark):
    rows = goods(spark, [("1", "s", "n"), ("2", "s", "n", None), ("10", "s", "n"), ("9", "s", "n")]).withColumn("RANK", F.when(F.col("G_NO") == "1", NULL_TEXT).otherwise("3"))
    got = {r["G_NO"]: (r["GROUP_NUM"], r["GROUP_HEAD"]) for r in refine.group_refine(clustering.fingerprinted(rows)).collect()}
    assert got == {"1": (4, "N"), "10": (4, "Y"), "9": (4, "N")}


def test_ratio_has_single_precision(spark):
    rows = clustering.fingerprinted(goods(spark, [("1", "s", "a"), ("2", "s", "a"), ("3", "s", "a")]))
    assert clustering.seller_dup_ratio(rows).first()["ratio"] == 0.3333333432674408


# ---------------------------------------------------------------- delta

CASES = [
    # (current, old): fingerprint, head, size, time
    ((("f", "Y", 2, 2), ("g", "Y", 2, 1)), "update"),
    ((("f", "Y", 2, 2), ("f", "N", 2, 1)), "update"),
    ((("F", "Y", 2, 2), ("f", "Y", 2, 1)), None),
    ((("f", "Y", 3, 2), ("f", "Y", 2, 1)), None),
    ((("f", "Y", 2, 2), ("f", "Y", 1, 1)), "insert"),
    ((("f", "Y", 1, 2), ("f", "Y", 2, 1)), "delete"),
    ((("f", "Y", 1, 2), ("g", "N", 1, 1)), None),
    ((("f", "Y", 2, 2), None), "insert"),
    ((("f", "Y", 1, 2), None), None),
    ((None, ("f", "Y", 1, 1)), "delete"),
    ((None, ("f", "Y", 5, 1)), "delete"),
    # an old snapshot that is newer is the current one
    ((("f", "Y", 1, 1), ("f", "Y", 2, 2)), "insert"),
]


def test_delta_decisions(spark):
    schema = "G_NO string, FINGERPRINT string, GROUP_HEAD string, GROUP_NUM bigint, UPDATE int"
    now = spark.createDataFrame([(str(i), *c[0]) for i, (c, _) in enumerate(CASES) if c[0]], schema)
    old = spark.createDataFrame([(str(i), *c[1]) for i, (c, _) in enumerate(CASES) if c[1]], schema)
    got = {r["G_NO"]: r["ACTION"] for r in delta.group_delta(delta.snapshot_union(now, old)).collect()}
    assert got == {str(i): action for i, (_, action) in enumerate(CASES) if action}


def test_third_row_is_ignored(spark):
    rows = [("1", "f", "Y", 2, 3, "N"), ("1", "f", "Y", 2, 2, "Y"), ("1", "g", "Y", 1, 1, "Y")]
    df = spark.createDataFrame(rows, "G_NO string, FINGERPRINT string, GROUP_HEAD string, GROUP_NUM bigint, UPDATE int, IS_OLD string")
    assert delta.group_delta(df).count() == 0


def test_documents_write_nulls(spark):
    rows = spark.createDataFrame([("1", "f", True, 2, "N", "insert"), ("2", "f", True, 2, "Y", "delete")], "G_NO string, FINGERPRINT string, HEAD boolean, GROUP_NUM bigint, IS_OLD string, ACTION string")
    first, second = [r["doc"] for r in delta.index_update_docs(rows, datetime(2024, 1, 1)).collect()]
    assert first.startswith('{"id":"1","GROUP_TAG":{"set":"f"},"GROUP_HEAD":{"set":true},"GROUP_NUM":{"set":2}')
    assert second.startswith('{"id":"2","GROUP_TAG":{"set":null},"GROUP_HEAD":{"set":null},"GROUP_NUM":{"set":null}')


def test_streamed_snapshots(spark, tmp_path):
    from shelfline.streaming.delta import delta_writer

    seen = {}
    run = delta_writer(spark, str(tmp_path / "state"), lambda df, n: seen.update({n: sorted((r["G_NO"], r["ACTION"]) for r in df.collect())}))
    schema = "G_NO string, FINGERPRINT string, GROUP_HEAD string, GROUP_NUM bigint, UPDATE int"
    run(spark.createDataFrame([("1", "f", "Y", 2, 1), ("2", "f", "N", 2, 1)], schema), 0)
    run(spark.createDataFrame([("1", "f", "Y", 1, 2)], schema), 1)
    assert seen == {0: [("1", "insert"), ("2", "insert")], 1: [("1", "delete"), ("2", "delete")]}


# ---------------------------------------------------------------- images


def leader_model(images, bits, shift, threshold):
    """The sequential scan, one band after another."""
    groups = {}
    for gno, h in images:
        value = int(h, 16)
        for i in range(0, bits, shift):
            groups.setdefault((value >> i) & ((1 << shift) - 1), []).append((f"{value:x}", gno))
    out = set()
    for rows in groups.values():
        rows.sort()
        runs = []
        for h, gno in rows:
            if runs and (int(h, 16) ^ int(runs[-1][0], 16)).bit_count() < threshold:
                runs[-1][1].append(gno)
            else:
                runs.append((h, [gno]))
        out |= {(gno, leader) for leader, members in runs if len(members) >= 2 for gno in members}
    return out


@pytest.mark.parametrize(("bits", "shift", "threshold"), [(256, 128, 10), (256, 32, 10), (64, 16, 4), (64, 6, 10)])
def test_clusters_follow_the_scan(spark, bits, shift, threshold):
    rng = random.Random(bits + shift)
    rows = []
    for i in range(60):
        value = rng.getrandbits(bits)
        rows.append((str(i), f"{value:x}"))
        for j in range(rng.randrange(3)):
            rows.append((f"{i}-{j}", f"{value ^ (1 << rng.randrange(bits)) ^ (1 << rng.randrange(bits)):x}"))
    rows += [("zero", "0"), ("same", "ab" * (bits // 8))]
    df = spark.createDataFrame(rows, IMAGES)
    got = {tuple(r) for r in imagehash.image_clusters(df, Settings(hash_bits=bits, band_bits=shift, threshold=threshold)).collect()}
    assert got == leader_model(rows, bits, shift, threshold)
    assert any(g == "same" for g, _ in got)


def test_threshold_zero_gives_nothing_and_width_zero_is_refused(spark):
    df = spark.createDataFrame([("1", "ff"), ("2", "ff")], IMAGES)
    assert imagehash.image_clusters(df, Settings(threshold=0)).count() == 0
    with pytest.raises(ValueError):
        Settings(band_bits=0)


def test_distance_of_wide_hashes(spark):
    df = spark.createDataFrame([("f" * 64, "0"), ("8" + "0" * 63, "0"), ("1" + "0" * 16, "1")], "a string, b string")
    assert [r[0] for r in df.select(hashes.hamming(F.col("a"), F.col("b"))).collect()] == [256, 1, 2]


def test_bands_without_whole_digits(spark):
    value = 0xDEADBEEF12345678
    df = spark.createDataFrame([(f"{value:x}",)], "h string").select(hashes.bands(F.col("h"), 64, 6).alias("b"))
    assert [int(x, 2) for x in df.first()["b"]] == [(value >> i) & 63 for i in range(0, 64, 6)]


# ---------------------------------------------------------------- shards, sinks, files


def test_murmur_and_shards(spark):
    assert hashes.murmur3_32(b"") == 0
    assert hashes.murmur3_32(b"abcd") == 0x43ED676A
    assert hashes.murmur3_32(b"hello, world") == 0x149BBB7F
    numbers = [-(2**31), *SHARD_BOUNDS, *(b + 1 for b in SHARD_BOUNDS), 2**31 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "h int").select("h", hashes.shard(F.col("h")).alias("s"), hashes.sub_shard(F.col("h")).alias("t"))
    for row in df.collect():
        assert row["s"] == sum(row["h"] > b for b in SHARD_BOUNDS)
        assert row["t"] == row["s"] + (row["h"] & 0x7FFFFFFF) % 3 * 12
    words = spark.createDataFrame([("abcde",), (None,)], "x string").select(hashes.murmur3("x").alias("m"))
    assert [r["m"] for r in words.collect()] == [hashes.murmur3_32(b"abcde"), None]


def test_batches_of_the_sink(spark, tmp_path):
    docs = spark.range(2500).selectExpr("concat('{\"id\":', id, '}') AS doc").coalesce(1)
    folder = str(tmp_path)

    def send(collection, body):
        import json
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{collection} {len(json.loads(body))}")

    sinks.send_documents(docs, send, sinks.collection_name("all", {"all": "main"}), Settings(pause_seconds=0))
    assert sorted(p.read_text() for p in tmp_path.iterdir()) == ["main 1000", "main 1000", "main 500"]

    def refuse(collection, body):
        raise OSError("refused")

    with pytest.raises(Exception, match="refused"):
        sinks.send_documents(docs, refuse, "x", Settings(pause_seconds=0))


def test_deletes_and_reads(spark, tmp_path):
    folder = str(tmp_path)

    def send(collection, body):
        with open(f"{folder}/one", "w") as f:
            f.write(body)

    sinks.send_deletes(spark.createDataFrame([("7",), ("8",)], "G_NO string").coalesce(1), send, "c")
    assert (tmp_path / "one").read_text() == '{"delete": ["7", "8"]}'
    found = sinks.read_index(spark, lambda q: '{"response": {"docs": [{"id": 1}, {"x": 2}]}}', "q=*", ("id",))
    assert [r[0] for r in found.collect()] == ["1", None]


def test_three_outputs_and_lock(spark, tmp_path):
    rows = goods(spark, [("1", "s", "a"), ("2", "s", "a"), ("3", "s", None)]).withColumn("RANK", F.lit("1"))
    sinks.write_clustering(rows, str(tmp_path))
    assert spark.read.text(f"{tmp_path}/result").count() == 3
    assert spark.read.text(f"{tmp_path}/clusterInfo").count() == 2
    assert spark.read.text(f"{tmp_path}/info").first()[0].startswith("s\t0.66666")
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_tsv(rows, f"{tmp_path}/result", overwrite=False)
    with sinks.run_lock(spark, str(tmp_path), "7"):
        assert (tmp_path / "application7.lock.file").exists()
    assert not (tmp_path / "application7.lock.file").exists()
    assert sinks.run_path("/x/", "r1") == "/x/r1"


def test_sequence_files(spark, tmp_path):
    df = spark.createDataFrame([("1", "s", None), ("2", None, "商品")], "G_NO string, CTRL_ROWID string, G_NAME string")
    sequence_files.write_sequence(df, str(tmp_path / "seq"))
    back = sequence_files.read_sequence(spark, str(tmp_path / "seq"), ("G_NO", "CTRL_ROWID", "G_NAME"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
