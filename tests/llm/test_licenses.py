import re

import pytest

from shelfline.llm.licenses import COVERAGE, MERGE_GAP, PHRASES, scan_licenses, template_rows
from shelfline.llm.licenses import TEXTS as FULL
from shelfline.llm.q_licenses import ORACLES, op5_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words, starts, labels = WORD.findall(low), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    "CC-BY mit license MIT  License, gnu general public license apache license cc by",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under the very Apache License, Version 2.0 and more",
    "gnu general public gnu general public license",
    "cc cc by by",
    "apache\x7flicense ünder MIT licensé mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "general public license apache licenses",
    None,
    "",
    "mit",
    "K" + "mit license " * 3000,
]


def got(df):
    return {r[0]: tuple(r)[1:6] for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()}


def query_of(spark, tmp_path, rows, extra=""):
    path = tmp_path / "x"
    spark.createDataFrame(rows, "doc_id bigint, text string" + extra).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return op5_license_scan(spark, str(path))


def test_texts(spark, tmp_path):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)]
    df = query_of(spark, tmp_path, [*rows, *rows], ", label string, score int")
    assert df.count() == 2 * len(rows)  # repeated rows don't vote twice
    assert got(df) == {i: brute(t) for i, t in enumerate(TEXTS)}
    more = {r["doc_id"]: (r["labels"], r["score"]) for r in df.collect()}
    assert more[1] == ("apache,apache-2.0", 1.0)
    assert more[2][0] == "apache" or "apache-2.0" in more[2][0]
    assert more[6] == ("mit-text", 1.0) and more[8] == ("", 0.0)


def test_neighbouring_diagonals_merge(spark):
    text = "permission is hereby granted free of any charge to any person obtaining a copy of this software"
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [s["label"] for s in row["spans"]] == ["mit-text"] and 0.8 <= row["score"] < 1
    assert (row["spans"][0]["first"], row["spans"][0]["last"]) == (0, 16)


def test_odd_rows(odd, none, clashing):
    for df in (odd, clashing):
        rows = scan_licenses(df).collect()
        assert sorted((r["doc_id"], r["n_words"]) for r in rows if r["doc_id"]) == sorted((r["doc_id"], brute(r["text"])[0]) for r in df.collect() if r["doc_id"])
    assert scan_licenses(none).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op5_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("sf", ["0.01"])
def test_query(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert got(op5_license_scan(spark, d)) == {k: brute(t) for k, t in docs.items()}


def plain_spans(text, rows):
    """Verified spans of a text, by comparing every gram with every template's."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    templates = {}
    for t, label, phrase, k, gram, at, grams, most in rows:
        templates.setdefault(t, (label, phrase, k, grams, most, []))[5].append((at, gram))
    out = []
    for label, phrase, k, grams, most, own in templates.values():
        votes = sorted((i - at, i, at) for at, gram in own for i in range(len(words) - k + 1) if words[i : i + k] == gram)
        diagonals = sorted({d for d, _, _ in votes})
        runs = []
        for d in diagonals:
            if runs and not phrase and d - runs[-1][-1] <= MERGE_GAP:
                runs[-1].append(d)
            else:
                runs.append([d])
        runs = [part for run in runs for part in ([run] if run[-1] - run[0] <= most else [[d] for d in run])]
        for run in runs:
            top, n = -1, 0
            mine = sorted((i, at) for d, i, at in votes if d in run)
            for _, at in mine:
                if at > top:
                    top, n = at, n + 1
            if n == grams or (not phrase and n / grams >= COVERAGE):
                out.append((mine[0][0], mine[-1][0] + k - 1, label, phrase, n / grams))
    return sorted(out)


MIT = next(iter(FULL))
MORE = [
    "released under x under the y the mit z mit license",
    "released under the mit license " * 40,
    "mit license released under the mit license under the mit",
    MIT,
    MIT.replace("without restriction", "with no restriction at all").replace("merge, ", ""),
    " ".join(reversed(MIT.split())),
    MIT[: len(MIT) // 2],
    "\n".join(FULL),
    "license mit the under released",
    "gnu lesser general public license, gnu lesser, general public license",
    "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.",
]


def test_spans_are_the_plain_ones(spark):
    texts = [*TEXTS, *MORE, *FULL]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    rows = template_rows()
    got = {r["doc_id"]: [(s["first"], s["last"], s["label"], s["phrase"], s["share"]) for s in r["spans"]] for r in scan_licenses(df).collect()}
    assert got == {i: plain_spans(t, rows) for i, t in enumerate(texts)}


def test_drifting_votes_are_no_notice(spark):
    df = spark.createDataFrame([(0, MORE[0]), (1, "released under the mit license"), (2, MIT), (3, MORE[4])], "doc_id int, text string")
    rows = {r["doc_id"]: ({s["label"] for s in r["spans"]}, r["score"]) for r in scan_licenses(df).collect()}
    assert rows[0] == ({"mit"}, 1.0) and rows[1] == ({"mit", "mit-notice"}, 1.0)
    assert rows[2] == ({"mit-full", "mit-text"}, 1.0) and "mit-full" in rows[3][0]


def test_null_ids_and_texts_of_one_id(spark):
    pairs = [(None, "mit license"), (None, "apache license"), (7, "mit license"), (7, "cc by"), (7, "cc by"), (None, None)]
    rows = scan_licenses(spark.createDataFrame(pairs, "doc_id int, text string")).collect()
    assert sorted(((r["doc_id"], r["n_words"], [s["label"] for s in r["spans"]]) for r in rows), key=repr) == sorted(
        ((k, len((t or "").split()), [PHRASES[t]] if t else []) for k, t in pairs), key=repr
    )


def test_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = con.execute(ORACLES["op5_license_scan"])
    names = [c[0] for c in want.description]
    df = op5_license_scan(spark, d)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(want.fetchall())
