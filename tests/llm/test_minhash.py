import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfline.llm import minhash
from shelfline.llm.minhash import components, keep_one_of_each, least_estimate, minima, near_duplicates, shingle_set, signature, word_hashes
from shelfline.llm.q_minhash import ORACLES, op10_minhash_bbit


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """(id, set size, component, kept): all pairs that share a shingle."""
    sets = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in sets if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    distinct = {}
    for k, s in sets:
        if k is None or not s:
            continue
        if s in distinct:
            a, b = sorted((root(k), root(distinct[s])))
            parent[b] = a
            continue
        distinct[s] = k
        common = Counter(o for g in s for o in holders[g])
        for other, n in common.items():
            if 100 * n >= 75 * (len(s) + len(other) - n):
                a, b = sorted((root(k), root(distinct[other])))
                parent[b] = a
        for g in s:
            holders[g].append(s)
    return sorted(((k, len(s), None if k is None else root(k) if s else k, k is None or not s or root(k) == k) for k, s in sets), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_words_are_the_contract_s(monkeypatch):
    text = "A b\tc\nd\x0be\x0cf\rg  hé x\x1cy\xa0z"
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    assert len(word_hashes(text.encode())) == len(words)
    same = word_hashes(b"one two one twoone")
    assert same[0] == same[2] and len(set(same.tolist())) == 3
    long = " ".join(f"w{i % 977}" for i in range(5000)).encode()
    whole = word_hashes(long)
    monkeypatch.setattr(minhash, "_PIECE", 100)
    assert (word_hashes(long) == whole).all()


def test_estimates_and_bands():
    rng = np.random.default_rng(3)
    errors, shared = [], 0
    for _ in range(300):
        both, own = rng.integers(0, 2**63, 300, dtype=np.uint64), rng.integers(0, 2**63, (2, 50), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, o])) for o in own)
        (pa, ka), (pb, kb) = signature(minima(a)), signature(minima(b))
        x = pa ^ pb
        unequal = sum(((int(v) | int(v) >> 1) & 0x5555555555555555).bit_count() for v in x)
        errors.append(((1 - unequal / 128) - 0.25) / 0.75 - 300 / 400)
        shared += bool((ka == kb).any())
    assert abs(np.mean(errors)) < 0.01 and min(errors) > least_estimate() - 0.75 and shared == 300


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    rows = components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()
    assert {r["id"]: r["component"] for r in rows} == {k: root(k) for k in parent}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def copies(seed, n, spread):
    """Copies of one text with more and more words changed, and unrelated texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(spread)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(n + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(30)]
    return rows + [(n + 100 + i, rows[i * 3][1].upper()) for i in range(n // 5)]


@pytest.mark.parametrize(("n", "spread", "block"), [(60, 4, 1024), (120, 12, 16), (90, 25, 7)])
def test_groups_of_copies(spark, monkeypatch, n, spread, block):
    """Near and far copies: bulk, strays and pairs at the threshold."""
    monkeypatch.setattr(minhash, "BLOCK_STRAYS", block)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    rows = copies(n, n, spread)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert got(near_duplicates(df)) == brute(rows)
    kept = {r["doc_id"] for r in keep_one_of_each(df).collect()}
    assert kept == {k for k, _, _, keep in brute(rows) if keep}


def test_odd_rows(odd, none, clashing):
    one_text = odd.where("doc_id IS NULL OR doc_id <> 6")
    assert got(near_duplicates(one_text)) == brute([(r["doc_id"], r["text"]) for r in one_text.collect()])
    assert near_duplicates(clashing).count() == odd.count()
    assert {r["component_id"] for r in near_duplicates(odd).where("doc_id = 6").collect()} == {6}
    assert keep_one_of_each(clashing).columns == clashing.columns
    assert near_duplicates(none).count() == 0 and keep_one_of_each(none).count() == 0
    assert shingle_set(None).size == 0


@pytest.mark.parametrize("sf", ["0.01"])
def test_query(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(op10_minhash_bbit(spark, d)) == brute(rows)


def test_long_words(monkeypatch):
    """Long words keep tables small, and one word has one hash wherever it stands."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdef", k=n)) for n in (3, 40, 41, 300, 5, 1000, 2, 39, 40)]
    monkeypatch.setattr(minhash, "_LONG_WORD", 40)
    whole = None
    for piece in (10, 33, 100, 350, 5000):
        monkeypatch.setattr(minhash, "_PIECE", piece)
        monkeypatch.setattr(minhash, "_TABLES", [np.zeros(0, np.uint64)] * 2)
        found = [word_hashes(" ".join(w).encode()) for w in (words, words[::-1], [*words[3:], *words[:3]])]
        assert found[0].tolist() == found[1][::-1].tolist() == [*found[2][-3:], *found[2][:-3]]
        assert len(minhash._TABLES[0]) <= piece + 200
        assert whole is None or whole == found[0].tolist()
        whole = found[0].tolist()
    assert len(set(whole)) == len(set(words))


def test_strays_need_a_likely_partner(spark):
    """Buckets of many unlike members move signatures; sets only where a partner is likely."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[:n], rng.integers(0, 2**63, 400 - n, dtype=np.uint64)])) for n in (400, 390, 380, 200, 150, 0)]
    made = {
        "id": pa.array(range(6), pa.int64()), "c": pa.array(range(6), pa.int64()),
        "packed": pa.array([signature(minima(x))[0].view(np.int64) for x in sets], pa.list_(pa.int64())), "set": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
    }
    table = pa.table(made)
    likely = minhash._likely(table, table, 75)
    exact = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for b in sets] for a in sets])
    assert likely[(exact >= 0.75) & ~np.eye(6, dtype=bool)].all() and not likely[exact < 0.2].any() and not likely.diagonal().any()
    links = minhash._linked(table, table, 75).to_pylist()
    assert {(r["x"], r["y"]) for r in links} == {(i, j) for i in range(6) for j in range(6) if i != j and exact[i, j] >= 0.75}


def test_odd_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", 1), (2, "a b c d e f g", 2), (3, None, 3)], "`i``d` bigint, `te.xt` string, near_duplicate int")
    out = keep_one_of_each(df, "i`d", "te.xt")
    assert out.columns == df.columns and sorted(r["i`d"] for r in out.collect()) == [1, 3]


def test_sql():
    """The oracle SQL is the definition."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall() + [(-1, None), (-2, ""), (-3, "One  two"), (-4, "one two"), (-5, "a b c d e"), (-6, "a\tb\x0bc d\ne")]
    con.execute("CREATE OR REPLACE TABLE all_rows (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO all_rows VALUES (?, ?)", rows[-6:])
    con.execute("CREATE OR REPLACE TABLE both_rows AS SELECT doc_id, text FROM documents UNION ALL SELECT * FROM all_rows")
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM both_rows")
    assert sorted(con.execute(ORACLES["op10_minhash_bbit"]).fetchall(), key=repr) == brute(rows)
