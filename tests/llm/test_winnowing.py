import bisect
import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from shelfline.llm.q_winnowing import ORACLES, op9_winnowing
from shelfline.llm.winnowing import BASE, POSITION_BITS, PRIME, K, W, edited_text, fingerprints, hash_set, positions, range_of, units, winnow, with_successor


def brute_positions(hashes, w=W):
    """Rightmost least hash of each window, each place once."""
    if not hashes:
        return []
    if len(hashes) < w:
        low = min(h for h, _ in hashes)
        return [max(i for h, i in hashes if h == low)]
    out = []
    for at in range(len(hashes) - w + 1):
        window = hashes[at : at + w]
        low = min(h for h, _ in window)
        place = max(i for h, i in window if h == low)
        if place not in out:
            out.append(place)
    return out


def test_minimum_of_each_window(spark):
    texts = ["a b c d e f g h i j k l m n", "x x x x x x x x x x", "a b", "", None, "a b c", "a b c d", "a b c a b c a b c", "日本語 の テキスト"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    # every gram's hash, as windows of one give it
    every = df.select(winnow(F.col("t"), K, 1).alias("p"), positions(winnow(F.col("t"), K, 1)).alias("at"), positions(winnow(F.col("t"))).alias("chosen"), F.size(units(F.col("t"))).alias("n"))
    for row in every.collect():
        hashes = sorted((i, p >> 30) for p, i in zip(row["p"], row["at"], strict=True))
        assert len(hashes) == (0 if row["n"] == 0 else max(1, row["n"] - K + 1))
        assert row["chosen"] == brute_positions([(h, i) for i, h in hashes])


def test_shared_run_is_found(spark):
    run = " ".join(f"s{i}" for i in range(K + W - 1))
    df = spark.createDataFrame([(f"one two three {run} four five", f"p q {run} r s t u v")], "a string, b string")
    one, two = (fingerprints(df.select(F.col(c).alias("t")), "t").first()["fingerprint"] for c in "ab")
    assert {x["hash"] for x in one} & {x["hash"] for x in two}


def expected(rows):
    """(key, length, sha of the edited text) in order of key, then text."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    out = []
    for i, (k, t) in enumerate(rows):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + rows[(i + 1) % len(rows)][1][:cut]
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


def edited(df):
    rows = with_successor(df).select("doc_id", F.length("text").alias("n"), F.sha2(edited_text(F.col("text"), F.col("next")), 256).alias("s")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_neighbours(spark, odd, none, clashing, monkeypatch):
    from shelfline.llm import winnowing

    for per_range in (4000, 2):
        monkeypatch.setattr(winnowing, "ROWS_PER_RANGE", per_range)
        for df in (odd, clashing):
            assert edited(df) == expected([(r["doc_id"], r["text"]) for r in df.collect()])
        many = spark.range(0, 500).selectExpr("pmod(id * 7919, 1000) - 300 AS doc_id", "concat('text ', id, repeat('é', int(id % 9))) AS text").repartition(5)
        assert edited(many) == expected([tuple(r) for r in many.collect()])
    assert with_successor(none).count() == 0
    single = spark.createDataFrame([(1, "abcdefgh")], "doc_id int, text string")
    assert edited(single) == expected([(1, "abcdefgh")])


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    df = op9_winnowing(spark, sf_dir)
    rows = df.collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr) == expected(docs)
    prints = {}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(dict(docs)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in prints.values())
    long = [r for r in rows if r["n_chars"] > 400]
    assert sum(r["near_edited"] > 0.4 for r in long) > 0.9 * len(long) and sum(r["near_next"] < 0.1 for r in long) > 0.9 * len(long)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_scripts_without_spaces_and_long_words(spark):
    thai = "สวัสดีชาวโลก"
    df = spark.createDataFrame([(thai,), ("日本語ab カ",), ("x" * 40,), ("a\x0bb\x85c",)], "t string")
    assert [len(r[0]) for r in df.select(units(F.col("t"))).collect()] == [len(thai), 5, 3, 2]
    rng = random.Random(1)
    text, other = ("".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(1100)) for _ in range(2))
    rows = [(1, text), (2, other)]
    near = spark.createDataFrame(rows, "doc_id int, text string")
    cut = len(text) // 4
    one = near.where("doc_id = 1").select(hash_set(winnow(F.col("text"))).alias("a"), hash_set(winnow(F.lit(text[:-cut] + rows[1][1][:cut]))).alias("b")).first()
    assert len(set(one["a"]) & set(one["b"])) >= 0.4 * len(set(one["a"]) | set(one["b"]))


def test_rolling_hash(spark):
    """Grams are polynomials in their units' CRC-32."""
    words = "a bc déf ghi 日".split()
    row = spark.createDataFrame([(" ".join(words),)], "t string").select(winnow(F.col("t"), K, 1)).first()[0]
    crcs = [zlib.crc32(w.encode()) for w in words]
    want = []
    for i in range(len(words) - K + 1):
        h = crcs[i]
        for c in crcs[i + 1 : i + K]:
            h = (h * BASE + c) % PRIME
        want.append((h << POSITION_BITS) + (1 << POSITION_BITS) - 1 - i)
    assert row == want


def test_ranges(spark):
    cuts = sorted({(i * i * 7919) % 100_003 - 50_000 for i in range(1000)})
    df = spark.createDataFrame([(k,) for k in [None, *range(-60_000, 60_000, 997), *cuts]], "k bigint")
    for some in (cuts, cuts[:1], cuts[:5], []):
        for r in df.select("k", range_of(F.col("k"), some).alias("r")).collect():
            assert r["r"] == (None if r["k"] is None else bisect.bisect_right(some, r["k"]))


def test_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(ORACLES["op9_winnowing"])
    names = [c[0] for c in want.description]
    df = op9_winnowing(spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
