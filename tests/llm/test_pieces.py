import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from shelfline.llm.piece_viterbi import BYTE, NORMAL, UNKNOWN, PieceAutomaton, Vocabulary, automaton, decode_lists, decode_pieces, encode_pieces, rank_score
from shelfline.llm.q_packing import public_tokenizer
from shelfline.llm.q_pieces import op3_piece_viterbi

PATH = public_tokenizer("piece_bpe_32k.model")


def brute(vocabulary, text, unknown):
    """The greatest sum of scores over all segmentations."""
    scores = {p: s for p, s, kind in vocabulary.pieces if kind == NORMAL}
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            if text[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[text[start:end]])
        if text[end - 1] not in scores:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def total(vocabulary, ids, unknown):
    return sum(unknown if i == 0 else vocabulary.pieces[i][1] for i in ids)


@pytest.mark.parametrize("seed", range(5))
def test_best_sum_on_random_vocabularies(seed):
    rng = random.Random(seed)
    names = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(25)} - {"b"})
    vocabulary = Vocabulary([("<unk>", 0.0, UNKNOWN), *((n, -rng.random() * 5, NORMAL) for n in names)], dummy_prefix=False)
    auto = PieceAutomaton(vocabulary)
    for _ in range(100):
        text = "".join(rng.choices("abcd", k=rng.randrange(1, 25)))
        ids = np.frombuffer(auto.encode(text), "<i4").tolist()
        assert abs(total(vocabulary, ids, auto.unknown_score) - brute(vocabulary, text, auto.unknown_score)) < 1e-9


def test_same_sums_as_the_library(spark, sf_dir):
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    for p in model.pieces:
        if p.type == NORMAL:
            p.score = rank_score(p.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    auto = automaton(PATH)
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()] + ["", " ", "  a  b ", "é\n\tb", "ꙮ x 日本語", "▁ a", "a▁b"]
    same = 0
    for text in texts:
        mine, theirs = np.frombuffer(auto.encode(text), "<i4").tolist(), library.encode(text)
        score = [p[1] if p[2] != BYTE else 0.0 for p in auto.vocabulary.pieces]
        assert abs(sum(score[i] for i in mine) - sum(score[i] for i in theirs)) < 1e-2
        same += mine == theirs
    assert same > 0.9 * len(texts)  # others are ties


def test_odd_rows(spark, odd, none, clashing):
    for df in (odd, clashing):
        back = decode_pieces(encode_pieces(df.drop("ids"), PATH, "text", ("doc_id", "text")), PATH, "ids", ("doc_id", "text"))
        for row in back.collect():
            assert row["decoded"] == (row["text"] or "")
    assert encode_pieces(none, PATH).count() == 0
    texts = decode_lists(pa.array([[259, 264], None, []], pa.list_(pa.int32())), automaton(PATH).vocabulary).to_pylist()
    assert texts == ["  a", None, ""]


def test_query(spark, sf_dir):
    rows = op3_piece_viterbi(spark, sf_dir).collect()
    assert rows and all(r["round_trip"] for r in rows)


@pytest.mark.parametrize(("prefix", "strip"), [(True, False), (True, True), (False, False), (False, True)])
def test_ids_of_unigram_models(spark, tmp_path, prefix, strip):
    """A made-up unigram model without byte pieces gives the library's ids, unknown
    runs included, with and without a normaliser that strips spaces."""
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 8))) for _ in range(120)]
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces = prefix, strip
    names = {"▁", *"etaoinshrdlu", *("▁" + w for w in words[:60]), *(w[:3] for w in words)}
    for name, kind in [("<unk>", UNKNOWN), ("<s>", 3), ("</s>", 3), *((n, NORMAL) for n in sorted(names))]:
        model.pieces.add(piece=name, score=-rng.random() * 9 if kind == NORMAL else 0.0, type=kind)
    path = f"{tmp_path}/made.model"
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    corpus = [" ".join(rng.choices(words, k=12)) for _ in range(40)]
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*corpus[:40], "日本語 " + corpus[0], "日本 語x日 本", "QQ qq", "  two  spaces ", "", " ", "ＡＢＣ etaoin", "日", "e日本aét"]
    rows = encode_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path).collect()
    mine = {r["doc_id"]: list(r["ids"]) for r in rows}

    def total_of(ids):
        return sum(library.get_score(i) for i in ids)

    for i, text in enumerate(texts):
        theirs = library.encode(text)
        assert mine[i] == theirs or (len([x for x in mine[i] if x == 0]) == len([x for x in theirs if x == 0]) and abs(total_of(mine[i]) - total_of(theirs)) < 1e-4), text
    back = decode_pieces(spark.createDataFrame([(i, x) for i, x in mine.items()], "doc_id int, ids array<int>"), path).collect()
    assert all(r["decoded"] == library.decode(mine[r["doc_id"]]) for r in back)


def test_query_is_the_automaton_s(spark, sf_dir):
    """The whole query against a plain dynamic program over all segmentations."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in op3_piece_viterbi(spark, sf_dir).collect()}
    vocabulary = automaton(PATH).vocabulary
    scores = {p: s for p, s, kind in vocabulary.pieces if kind == NORMAL}
    longest = max(map(len, scores))
    unknown = automaton(PATH).unknown_score
    assert set(rows) == {r["doc_id"] for r in docs}
    for doc in sorted(docs, key=lambda r: len(r["text"]))[:40]:
        marked = "▁" + doc["text"].replace(" ", "▁")
        best = [(0.0, 0)] + [(float("-inf"), 0)] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(max(0, end - longest), end):
                if marked[start:end] in scores:
                    best[end] = max(best[end], (best[start][0] + scores[marked[start:end]], best[start][1] + 1))
            if marked[end - 1] not in scores:
                best[end] = max(best[end], (best[end - 1][0] + unknown, best[end - 1][1] + len(marked[end - 1].encode())))
        row = rows[doc["doc_id"]]
        assert row["n_chars"] == len(doc["text"]) and row["round_trip"]
        ids = np.frombuffer(automaton(PATH).encode(doc["text"]), "<i4").tolist()
        assert row["n_pieces"] == len(ids)
        own = sum(vocabulary.pieces[i][1] for i in ids if vocabulary.pieces[i][2] != BYTE)
        left = best[-1][0] - unknown * sum(c not in scores for c in marked)
        assert abs(own - left) < 1e-6
