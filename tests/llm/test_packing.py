import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfline.llm import packing
from shelfline.llm.packing import LIMIT, WordTokens, pack_documents, plan_slots, token_pieces
from shelfline.llm.q_packing import op8_best_fit_packing, public_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizer())


def test_word_tokens_are_the_tokenizer_s(tokenizer):
    words = WordTokens(public_tokenizer())
    rng = random.Random(3)
    texts = ["", "a", "  a", "a  b", "a \nb", "a\tb c", "x <|endoftext|> y<|endoftext|>z", "I'm don't 'll we've", "a b\n\nc", "12 34,5 --- !!! ??", "日本 語", "a\x85b c", "a　 b"]
    texts += ["".join(rng.choices("ab é\n\t'ls1,.　  ", k=rng.randrange(40))) for _ in range(2000)]
    want = [np.asarray(tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert words(texts) == want
    assert words(texts) == want  # from the cache


def best_fit(lengths, limit):
    """Best-fit in falling length, document by document."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            i = min(fits, key=lambda i: room[i])
            room[i] -= n
        else:
            room.append(limit - n)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_every_place_once(seed):
    rng = random.Random(seed)
    limit = rng.choice([16, 100, 1024])
    counts = {n: rng.choice([0, 1, 2, 7, 200]) for n in range(1, limit + 1) if rng.random() < 0.5}
    counts[max(1, limit // 3)] = 5000 if seed == 5 else 3
    slots, sequences = plan_slots(counts, limit)
    ranks, places = Counter(), {}
    for length, rank, n, first, offset in slots:
        for i in range(n):
            ranks[length, rank + i] += 1
            places.setdefault(first + i, []).append((offset, length))
    assert set(ranks.values()) <= {1} and len(ranks) == sum(counts.values())
    assert len(places) == sequences
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= limit
    if sum(counts.values()) < 3000:
        assert sequences <= best_fit([n for n, c in counts.items() for _ in range(c)], limit) + 1


def check(rows, texts, tokenizer):
    """Pieces cover each text's ids in order, sequences have no gaps."""
    ids = {k: Counter(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,) for t in v) for k, v in texts.items()}
    groups, places = {}, {}
    for r in rows:
        groups.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(groups) == set(ids)
    for key, pieces in groups.items():
        for own, n in ids[key].items():
            first = len(own) % LIMIT or min(LIMIT, len(own))
            at, number = 0, 0
            while at < len(own):
                stop = at + first if number == 0 else at + LIMIT
                crc = zlib.crc32(np.asarray(own[at:stop], "<u4").tobytes())
                assert sum((p["piece"], p["start"], p["length"], p["ids_crc32"]) == (number, at, stop - at, crc) for p in pieces) >= n
                at, number = stop, number + 1
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= LIMIT


def test_odd_rows(odd, none, clashing, tokenizer):
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    for df in (odd, clashing):
        check(pack_documents(df, public_tokenizer()).collect(), texts, tokenizer)
    assert pack_documents(none, public_tokenizer()).count() == 0


def test_ids_column(odd, tokenizer):
    row = token_pieces(odd.where("doc_id = 8"), public_tokenizer(), with_ids=True).first()
    assert row["ids"] == [*tokenizer.encode("one").ids, 2]


def test_query(spark, sf_dir, tokenizer):
    texts = {r["doc_id"]: [r["text"]] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_best_fit_packing(spark, sf_dir).collect()
    check(rows, texts, tokenizer)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / LIMIT + 1


def test_full_pieces_and_many_buckets(spark, monkeypatch, tokenizer):
    """Full pieces have sequences of their own; ranks hold over any number of buckets."""
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    texts = {i: ["word " * (2600 if i % 7 == 0 else 5 + i % 3)] for i in range(120)}
    df = spark.createDataFrame([(k, t[0]) for k, t in texts.items()], "doc_id bigint, text string").repartition(5)
    rows = pack_documents(df, public_tokenizer()).collect()
    check(rows, texts, tokenizer)
    full = [r for r in rows if r["length"] == LIMIT]
    assert full and len({r["sequence_id"] for r in full}) == len(full) and all(r["sequence_id"] < 0 and r["offset"] == 0 for r in full)
    lengths = [r["length"] for r in rows]
    assert len({r["sequence_id"] for r in rows}) <= best_fit(lengths, LIMIT) + 1
