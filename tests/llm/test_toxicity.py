import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import toxicity
from shelfline.llm.q_toxicity import op1_toxicity_machine
from shelfline.llm.toxicity import FactorizationMachine, Terms, drop_toxic, fit, fit_toxicity, held_out, labelled_sample, score_toxicity

LABEL = "doc_id bigint, quality int, toxic int"


def test_score_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    machine = FactorizationMachine({i: i for i in range(9)}, 0.3, rng.normal(size=9), rng.normal(size=(9, 8)))
    for row in ([], [3], [0, 4, 8], list(range(9))):
        value = 0.3 + sum(machine.w[i] for i in row) + sum(machine.v[i] @ machine.v[j] for a, i in enumerate(row) for j in row[a + 1 :])
        assert abs(machine.score([row])[0] - 1 / (1 + np.exp(-value))) < 1e-9
    assert len(machine.score([])) == 0


def test_pairs_are_learned():
    """Neither word alone tells anything; both together do."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        own = [*([1] if a else []), *([2] if b else []), *rng.integers(100, 130, 4)]
        rows.append(np.unique(own).astype(np.int32))
        labels.append(int(a and b and rng.random() < 0.98))
    machine = fit(rows, labels)
    score = machine.score([[machine.index[t] for t in x if t in machine.index] for x in ([1], [2], [1, 2], [])])
    assert score[2] > 0.8 and max(score[0], score[1], score[3]) < 0.3


def test_same_sample_same_machine(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs.repartition(7), labels.repartition(3))
    assert a.index == b.index and (a.w == b.w).all() and a.bias == b.bias


def test_no_label_of_a_held_out_row_is_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, turned)
    assert a.index == b.index and (a.w == b.w).all()


def test_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (5, 1, None), (None, 1, 1), (8, 0, 0), (6, 0, 0)], LABEL)
    machine = fit_toxicity(odd, labels)
    for df in (odd, clashing):
        rows = score_toxicity(df, machine).collect()
        assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
        assert drop_toxic(df, labels).columns == df.columns
    assert score_toxicity(none, machine).count() == 0
    empty = fit_toxicity(none, labels.limit(0))
    assert score_toxicity(odd, empty).where("score = 0.5").count() == odd.count()
    assert Terms()(None) == set()
    lists, y = labelled_sample(odd, labels)
    assert len(lists) == len(y)


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_accuracy(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = op1_toxicity_machine(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert {r["held_out"] for r in rows} == {True, False}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    mine = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in mine) / len(mine) > 0.93
    assert not [r for r in mine if r["predicted"] and not r["toxic"]]


def test_xor_is_learned():
    """Neither term differs between the classes by itself: only the pair tells."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.unique([*([1] if a else []), *([2] if b else []), *rng.integers(100, 130, 4)]).astype(np.int32))
        labels.append(int(a != b))
    machine = fit(rows, labels)
    scores = machine.score([[machine.index[t] for t in x if t in machine.index] for x in rows])
    right = ((scores >= 0.5) == np.array(labels)).mean()
    assert {1, 2} <= set(machine.index) and right > 0.95


def test_nothing_learned_drops_nothing(spark, odd, none):
    for rows in ([], [(1, 1, 1), (8, 1, 1)], [(1, 1, 0)], [(None, 1, 1)], [(1, 1, None)]):
        assert drop_toxic(odd, spark.createDataFrame(rows, LABEL)).count() == odd.count()
    assert drop_toxic(none, spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABEL)).count() == 0


def test_own_columns_stay(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    extra = docs.withColumns({"__toxicity": F.lit("mine"), "toxicity": F.lit(7), "od`d.name": F.col("doc_id")})
    left = drop_toxic(extra, labels)
    assert left.columns == extra.columns and 0 < left.count() < extra.count()
    assert {(r["__toxicity"], r["toxicity"], r["od`d.name"] == r["doc_id"]) for r in left.collect()} == {("mine", 7, True)}


def test_sample_is_bounded(spark, monkeypatch):
    """An id trains once however often it stands there, and terms are bounded before they are collected."""
    docs = spark.createDataFrame([(i % 40, f"text number{chr(97 + i % 40)} of some words" + (" again" if i > 400 else "")) for i in range(800)], "doc_id bigint, text string").repartition(7)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], LABEL)
    lists, y = labelled_sample(docs, labels)
    assert len(lists) == len(y) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40))
    assert len(labelled_sample(docs, labels, rows=7)[0]) == 7
    monkeypatch.setattr(toxicity, "MAX_TRAIN_TERMS", sum(map(len, lists[:5])))
    few, marks = labelled_sample(docs, labels)
    assert [x.tolist() for x in few] == [x.tolist() for x in lists[:5]] and marks == y[:5]


def test_query_is_the_sum_by_definition(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    machine = fit_toxicity(docs, labels)
    rows = {r["doc_id"]: r for r in op1_toxicity_machine(spark, sf_dir).collect()}
    assert len(rows) == docs.count()
    for doc in docs.collect():
        found = {t for w in re.findall(r"[^\W\d_]+", doc["text"].lower()) for t in Terms.of_word(w)}
        own = np.array(sorted(machine.index[t] for t in found if t in machine.index), dtype=int)
        value, so_far = machine.bias + machine.w[own].sum(), np.zeros(machine.v.shape[1])
        for v in machine.v[own]:
            value += v @ so_far
            so_far = so_far + v
        assert abs(rows[doc["doc_id"]]["score"] - 1 / (1 + np.exp(-value))) < 1e-6
        assert rows[doc["doc_id"]]["held_out"] == (zlib.crc32(str(doc["doc_id"]).encode()) % 5 == 0)


def rows_of_terms(n, size, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = rng.integers(-(1 << 31), 1 << 31, 40_000).astype(np.int32)
    rows = [np.unique(vocabulary[(40_000 * rng.random(size) ** 3).astype(int)]) for _ in range(n)]
    return rows, [int(vocabulary[200] in x) for x in rows]


def test_fit_holds_little_besides_its_rows(monkeypatch):
    """On the driver; the pipeline's check stopped for that. Nor does it keep memory afterwards."""
    monkeypatch.setattr(toxicity, "EPOCHS", (4, 4))
    rows, labels = rows_of_terms(4000, 1500)
    taken = sum(x.nbytes for x in rows)
    tracemalloc.start()
    try:
        fit(rows, labels)
        left, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert taken > 10e6 and most < 2 * taken + 32e6 and left < 8e6


@pytest.mark.parametrize("piece", [1, 50, 997, 1 << 18])
def test_terms_by_ranges_are_those_of_all(monkeypatch, piece):
    rows, labels = rows_of_terms(400, 20)
    rows[3], rows[7] = rows[3][:0], np.array([-(1 << 31), (1 << 31) - 1], np.int32)
    rows += [rows[7]] * 20
    y = np.array(labels + [1] * 20, dtype=float)
    monkeypatch.setattr(toxicity, "PIECE", piece, raising=False)
    terms, strong = toxicity.candidate_terms(rows, y)
    counts, hits = {}, {}
    for row, mark in zip(rows, y):
        for t in row.tolist():
            counts[t], hits[t] = counts.get(t, 0) + 1, hits.get(t, 0) + mark
    p = y.mean()
    stands_out = {t: abs(hits[t] - n * p) >= toxicity.MIN_Z * (n * p * (1 - p)) ** 0.5 for t, n in counts.items()}
    found = sorted((t for t, n in counts.items() if n >= (toxicity.MIN_ROWS_STRONG if stands_out[t] else toxicity.MIN_ROWS)), key=lambda t: (-counts[t], t))
    assert terms.tolist() == found and strong.tolist() == [stands_out[t] for t in found]
    assert {-(1 << 31), (1 << 31) - 1} <= set(found)
