import pytest

from shelfline.llm.q_substring import op6_substring_dedup
from shelfline.llm.substring_dedup import MIN_WORDS, find_repeats, remove_repeats, repeated_spans, units, without


def brute(rows):
    """Earliest document of each unit by comparing all of them."""
    first = {}
    for k, t in rows:
        for _, _, form in units(t or ""):
            if k is not None:
                first[form] = min(first.get(form, k), k)
    out = []
    for k, t in rows:
        repeats = {i for i, (_, _, form) in enumerate(units(t or "")) if form in first and first[form] != k}
        cut = repeated_spans(t, repeats) if t else []
        out.append((k, without(t, cut) if cut else t, cut))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["text"], [(s["start"], s["end"]) for s in r["removed"]]) for r in df.collect()), key=repr)


def test_units():
    text = "One two.  Three! four\n\n Five 3.14 six?\nx。y"
    assert [(text[a:b], form) for a, b, form in units(text)] == [("One two.", "one two."), ("Three!", "three!"), ("four", "four"), ("Five 3.14 six?", "five 3.14 six?"), ("x。", "x。"), ("y", "y")]
    assert units("") == units(" \n ") == []
    assert [text[a:b] for a, b, _ in units(text)] == [text[a:b].strip() for a, b, _ in units(text)]


def test_offsets_give_the_rest_back():
    text = "Keep this. " + "a b c d e f g h i. " + "And this.\n" + "a b c d e f g h i.\n" + "end"
    spans = repeated_spans(text, set())
    assert [text[a:b] for a, b in spans] == ["a b c d e f g h i."]
    assert without(text, spans) == "Keep this. a b c d e f g h i. And this.\nend"
    assert without("abc", [(0, 3)]) == "" and without("a b c", []) == "a b c" and without("a b c", [(2, 3)]) == "a c"


def test_short_runs_stay():
    rest = " ".join(f"w{i}" for i in range(MIN_WORDS - 1)) + "."
    assert repeated_spans(rest, {0}) == []
    assert repeated_spans(f"{rest} x.", {0, 1}) == [(0, len(rest) + 3)]


def test_ideographs_and_kana_count_singly():
    passage = "我们在山谷里走了整整三天。\nその後で村に戻りました。"
    assert repeated_spans(f"own words\n{passage}\nmore", {1, 2}) == [(10, 10 + len(passage))]
    assert repeated_spans("是的。ünï çødé é", {0, 1}) == []


PASSAGE = " ".join(f"Sentence {i} of a passage that many documents share." for i in range(8))


def test_passages_in_lines(spark):
    rows = [(i, f"Own text {i} here and {i * 7} there {PASSAGE} and so on {i}.\nLast line of number {i} alone.") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = got(remove_repeats(df))
    assert out == brute(rows)
    holding = [k for k, t, _ in out if "Sentence 3 of a passage" in t]
    assert holding == [0]
    assert all(f"Last line of number {k} alone." in t for k, t, _ in out)


def test_odd_rows(odd, none, clashing):
    for df in (odd, clashing):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        own = remove_repeats(df)
        assert own.columns == [c for c in df.columns if c != "removed"] + ["removed"]
        assert [x for x in got(own) if x[0] is not None] == [x for x in brute(rows) if x[0] is not None]
    assert remove_repeats(none).count() == 0 and find_repeats(none).count() == 0


def test_texts_of_one_id(spark):
    """A repeat in one text cuts nothing from the others of its id, null included."""
    shared = "This sentence of ten words stands in many different documents."
    own = {k: f"Unit zero of text {k} has words enough to go alone. Unit one of text {k} has words enough to go too." for k in "abcd"}
    rows = [(1, shared)]
    for key, first, second in ((7, "a", "b"), (None, "c", "d")):
        rows += [(key, f"{own[first]} {shared}"), (key, f"{shared} {own[first]}"), (key, f"{own[second]} And the last unit of {second} is no repeat of any.")]
    want = [(k, t.replace(shared, "").strip() if k != 1 else t) for k, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(((k, t) for k, t, _ in got(remove_repeats(df))), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("sf", ["0.01"])
def test_query(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(op6_substring_dedup(spark, d)) == brute(rows)


def test_null_ids_and_repeated_rows_lose_no_unique_text(spark):
    """Every unit that stands anywhere still stands somewhere; units that only one
    text has stay where they are, whatever ids the rows have."""
    def unit(i):
        return f"Sentence number {i} has quite enough words of its own to go alone."

    rows = [(None, f"{unit(1)} {unit(2)} {unit(3)}"), (None, f"{unit(4)} {unit(2)} {unit(5)}"), (None, f"{unit(4)} {unit(2)} {unit(5)}")]
    rows += [(7, f"{unit(6)} {unit(2)}"), (7, f"{unit(7)} {unit(8)} {unit(2)}"), (7, f"{unit(6)} {unit(2)}"), (3, f"{unit(8)} {unit(9)}"), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = got(remove_repeats(df))
    assert len(out) == len(rows)
    kept = " ".join(t or "" for _, t, _ in out)
    assert all(unit(i) in kept for i in range(1, 10))
    for k, t, cut in out:
        source = [x for key, x in rows if key == k and without(x or "", cut) == (t or "")]
        assert source  # what stays is a row's own text without the spans
    by_key = {}
    for k, t, _ in out:
        by_key.setdefault(k, []).append(t)
    assert sorted(by_key[None]) == sorted([f"{unit(1)} {unit(3)}", f"{unit(4)} {unit(5)}", f"{unit(4)} {unit(5)}"])
    assert sorted(by_key[7]) == sorted([f"{unit(6)} {unit(2)}", f"{unit(6)} {unit(2)}", f"{unit(7)} {unit(2)}"])


def test_all_ids_null(spark):
    rows = [(None, PASSAGE), (None, PASSAGE + " And more of it.")]
    out = got(remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert out == sorted(((k, t, []) for k, t in rows), key=repr)  # rows without an id are one document


def test_odd_names(spark):
    df = spark.createDataFrame([(1, PASSAGE, 1), (2, PASSAGE, 2)], "`i``d` bigint, `te.xt` string, dedup_key int")
    out = remove_repeats(df, "i`d", "te.xt")
    assert out.columns == ["i`d", "te.xt", "dedup_key", "removed"] and sorted(len(r["te.xt"]) for r in out.collect()) == [0, len(PASSAGE)]
