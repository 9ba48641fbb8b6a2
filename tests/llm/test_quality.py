import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from shelfline.llm import ngram_quality
from shelfline.llm.ngram_quality import (
    BEGIN, BITS, ORDER, OWN, KeyTable, discounts, drop_low_quality, fit_model, key_steps, keys_of, log_probabilities, marked, packed_blocks, score_quality, symbols,
)
from shelfline.llm.q_quality import op4_ngram_quality


def brute_model(texts):
    """Interpolated modified Kneser-Ney over tuples, from the definition."""
    grams = Counter()
    for t in texts:
        own = [BEGIN] * (ORDER - 1) + symbols(marked(t)).tolist()
        for i in range(ORDER - 1, len(own)):
            grams[tuple(own[i - ORDER + 1 : i + 1])] += 1
    levels = {ORDER: dict(grams)}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = dict(Counter(g[1:] for g in levels[n + 1]))
    d = {n: discounts(Counter(min(c, 5) for c in level.values())) for n, level in levels.items()}
    after = {n: defaultdict(list) for n in levels}
    for n, level in levels.items():
        for g, c in level.items():
            after[n][g[:-1]].append(c)

    def p(gram):
        if not gram:
            return 1 / (1 << BITS)
        n = len(gram)
        counts = after[n].get(gram[:-1])
        if not counts:
            return p(gram[1:])
        c = levels[n].get(gram, 0)
        off = 0 if not c else d[n][min(c, 3) - 1]
        weight = sum(d[n][min(x, 3) - 1] for x in counts) / sum(counts)
        return max(c - off, 0) / sum(counts) + weight * p(gram[1:])

    return p


def test_model_is_the_definition(spark):
    texts = ["the cat sat on the mat", "the the the dog", "a cat", "日本語 cat", "the cat sat again and again"]
    p = brute_model(texts)
    model = fit_model(spark.createDataFrame([(t,) for t in texts], "text string")).toPandas()
    table = KeyTable(model["key"].to_numpy())
    alpha, gamma = model["alpha"].fillna(0).to_numpy(), model["gamma"].fillna(1).to_numpy()
    for text in [*texts, "unseen words of a dog", "xyz"]:
        keys, _ = keys_of([marked(text)])
        want = []
        own = [BEGIN] * (ORDER - 1) + symbols(marked(text)).tolist()
        for i in range(ORDER - 1, len(own)):
            want.append(math.log(p(tuple(own[i - ORDER + 1 : i + 1]))))
        assert np.allclose(log_probabilities(keys, table, alpha, gamma), want)


def test_probabilities_sum_to_one(spark):
    model = fit_model(spark.createDataFrame([("abracadabra",), ("abba",)], "text string")).toPandas()
    table = KeyTable(model["key"].to_numpy())
    context = keys_of(["abra"])[0][-1] << BITS & ((1 << (BITS * ORDER)) - 1)
    every = context + np.arange(1 << BITS)
    assert abs(np.exp(log_probabilities(every, table, model["alpha"].fillna(0).to_numpy(), model["gamma"].fillna(1).to_numpy())).sum() - 1) < 1e-3


def test_marks_keys_and_tables():
    assert marked("a a a b b c") == "a \x01 \x02 b \x01 c" and marked(None) == "" and marked("aa a") == "aa a"
    assert marked("x " * 12) == "x " + " ".join("\x01\x02\x03\x04\x05\x06\x07\x08\x08\x08\x08")
    keys, sizes = keys_of(["ab", "", "c"])
    assert sizes.tolist() == [2, 0, 1] and len(keys) == 3 and keys[0] & 4095 == ord("a") + 1 and keys[2] >> BITS == keys[0] >> BITS
    assert symbols("日\U0010ffff").min() > 2047 and symbols("日\U0010ffff").max() < BEGIN
    rng = np.random.default_rng(1)
    own = np.unique(rng.integers(0, 2**60, 5000))
    table = KeyTable(own)
    assert (table.find(own) == np.arange(len(own))).all() and (table.find(own + 1)[~np.isin(own + 1, own)] == -1).all()
    assert KeyTable(own[:0]).find(own[:3]).tolist() == [-1] * 3


def test_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (8, 1, 1)], "doc_id bigint, quality int, toxic int")
    for df in (odd, clashing):
        rows = score_quality(df, labels).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert (r["n_symbols"] == 0) == (r["perplexity"] is None)
            assert r["n_symbols"] or not r["kept"]
        assert drop_low_quality(df, labels).columns == df.columns
    untrained = score_quality(odd, labels.limit(0)).collect()
    assert all(r["perplexity"] is None and r["kept"] == (r["n_symbols"] > 0) for r in untrained)
    assert score_quality(none, labels).count() == 0


def test_each_row_has_its_own_decision(spark):
    """Rejected texts go though their id is null or has a kept text as well."""
    words = "the cat sat on a mat and then it ran to see who came from town by bus".split()
    good = [" ".join(words[(i * 7 + j * (1 + i % 5)) % len(words)] for j in range(40)) for i in range(40)]
    junk = "xq zvk jjw " + " ".join(f"{i * 7919 % 99991:x}#" for i in range(60))
    odd_ids = [(100, good[3]), (100, junk), (None, good[4]), (None, junk), (None, junk), (101, junk)]
    df = spark.createDataFrame([(i, t, "en") for i, t in [*enumerate(good), *odd_ids]], "doc_id bigint, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    scored = [(r["doc_id"], r["kept"]) for r in score_quality(df, labels).collect()]
    assert sorted(k for i, k in scored if i == 100) == [False, True] and sorted(k for i, k in scored if i is None) == [False, False, True]
    left = drop_low_quality(df, labels).collect()
    assert sorted([r["doc_id"] for r in left], key=repr) == sorted([i for i, k in scored if k], key=repr)
    assert all(r["text"] != junk for r in left)


def test_labels_and_scores(spark):
    d = "/root/testdata/sf0.01"
    rows = op4_ngram_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_long_texts_are_cut(spark, monkeypatch):
    """Cut anywhere, a text has the keys and the score that it has whole."""
    texts = ["the cat sat on the mat and the dog " * 3, "", "ab", "日本語のテキスト" * 9, "x"]
    whole, sizes = keys_of(texts)
    for step in (1, 2, 3, 7, 50, 10_000):
        monkeypatch.setattr(ngram_quality, "STEP_CHARS", step)
        own = {i: [] for i in range(len(texts))}
        for keys, numbers, counts in key_steps(texts):
            at = 0
            for i, n in zip(numbers, counts, strict=True):
                own[int(i)] += keys[at : at + n].tolist()
                at += n
        assert [len(own[i]) for i in own] == sizes.tolist() and sum(own.values(), []) == whole.tolist()


def test_ideographs_are_symbols_of_their_own():
    own = "".join(chr(c) for a, b in OWN for c in range(a, b))
    found = symbols(own)
    assert len(np.unique(found)) == len(own) and found.min() == 1 and found.max() < BEGIN
    rare = symbols("☃가\U0001f600\U0010ffff")
    assert rare.min() > found.max() and rare.max() < BEGIN
    assert symbols("az").tolist() == symbols("azé")[:2].tolist()


def test_repeated_rows_are_spread_and_held_once(spark):
    """Rows equal in all columns: each has its score, and a blob has the text once."""
    words = "the cat sat on a mat and then it ran to see who came from town by bus".split()
    rows = [(i, " ".join(words[(i + j * 5) % len(words)] for j in range(30)), "en") for i in range(30)] + [(500, "the same text again and again " * 9, "en")] * 300 + [(None, "no id here at all", None)] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(6)
    blobs = packed_blocks(df, "doc_id", "text", "lang", 3).collect()
    held = [ngram_quality._unpack(bytes(r["blob"])) for r in blobs]
    assert sum(t.num_rows for t, _, _ in held) == len(rows) and all(len(set(texts)) == len(texts) for _, texts, _ in held)
    where = [r["block"] for r, (t, texts, place) in zip(blobs, held, strict=True) if "no id here at all" in texts]
    assert len(set(where)) > 1  # equal rows of several partitions are in several blocks
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    scored = score_quality(df, labels).collect()
    assert len(scored) == len(rows) and len({round(r["perplexity"], 9) for r in scored if r["doc_id"] == 500}) == 1


def test_whole_query(spark, sf_dir):
    """Every perplexity against the model by definition, over the same trusted text."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    trusted = [r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] == 1]
    p = brute_model([docs[k]["text"] for k in trusted if zlib.crc32(str(k).encode()) % 5 != 1])
    known = {}
    rows = op4_ngram_quality(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in sorted(rows, key=lambda r: r["n_symbols"])[:60]:
        own = [BEGIN] * (ORDER - 1) + symbols(marked(docs[r["doc_id"]]["text"])).tolist()
        logs = 0.0
        for i in range(ORDER - 1, len(own)):
            gram = tuple(own[i - ORDER + 1 : i + 1])
            if gram not in known:
                known[gram] = math.log(p(gram))
            logs += known[gram]
        n = len(own) - ORDER + 1
        assert r["n_symbols"] == n
        assert n == 0 or abs(r["perplexity"] / math.exp(-logs / n) - 1) < 1e-4
        assert r["kept"] == (n > 0 and r["adjusted"] <= r["threshold"])
