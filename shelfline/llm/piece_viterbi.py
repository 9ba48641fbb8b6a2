"""SentencePiece encoding and decoding: an Aho-Corasick automaton over a
vocabulary's pieces drives one Viterbi pass, which at each position follows the
output links and relaxes the best score.

The vocabulary is a SentencePiece model file; its path is a parameter. Scores are
log-probabilities: the segmentation with the greatest sum wins, and of equal
ones the one whose last piece is longest. A unigram model stores such scores, and
its ids are the library's. A merge model stores negative merge ranks, which here
become log-probabilities of a rank-frequency law, -log(2 + rank): its ids are those
of this law, not of the merges. Texts of a model with a normaliser of its own go
through the library's normaliser first, so they decode to the normalised text.

Defined results
    null or empty text    no ids, decodes to the empty text
    characters without a piece  their UTF-8 bytes as byte pieces, or one unknown id
                          for each run of them where the vocabulary lacks byte pieces
    null ids              null text
    invalid UTF-8 from byte pieces  U+FFFD for each bad sequence
Rows are handled one by one; repeated rows, ties, empty tables and other
columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow, named, quoted, schema_of

SPACE = "▁"
#: Words of at most this length are cached, and so many of them.
CACHE_LENGTH, CACHE_WORDS = 48, 400_000
#: Below the least score by so much lies the score of a character without a piece.
UNKNOWN_PENALTY = 10.0
#: Score of pieces outside a merge model's ranks, such as runs of spaces.
UNMERGED = -12.0

LOWEST = (float("-inf"), (1, -1))
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def rank_score(stored: float) -> float:
    """Log-probability of a merge rank; pieces that no merge makes have a stored
    score beyond any rank and get :data:`UNMERGED`."""
    return -math.log(2.0 - stored) if stored > -1e8 else UNMERGED


class Vocabulary:
    """Pieces, scores and kinds of a SentencePiece model file."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool = True, byte_fallback: bool = True, normalize: Callable[[str], str] | None = None) -> None:
        self.pieces, self.dummy_prefix = pieces, dummy_prefix
        #: From text to its normalised form with SPACE for spaces; None for the identity.
        self.normalize = normalize
        self.unknown = next((i for i, x in enumerate(pieces) if x[2] == UNKNOWN), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE} if byte_fallback else {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("only vocabularies with marks in front of words are supported")
        plain = model.normalizer_spec.name == "identity" and not model.normalizer_spec.remove_extra_whitespaces and not model.denormalizer_spec.precompiled_charsmap
        normalize = None if plain else SentencePieceProcessor(model_file=path).normalize
        score = rank_score if model.trainer_spec.model_type == model.trainer_spec.BPE else float
        return cls([(x.piece, score(x.score), x.type) for x in model.pieces], model.normalizer_spec.add_dummy_prefix, model.trainer_spec.byte_fallback, normalize)


class PieceAutomaton:
    """Aho-Corasick automaton whose nodes hold piece lengths, scores and ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        usable = [(p, s, i) for i, (p, s, kind) in enumerate(vocabulary.pieces) if kind in (NORMAL, USER_DEFINED)]
        self.unknown_score = min((s for _, s, _ in usable), default=0.0) - UNKNOWN_PENALTY
        self.goto: list[dict[str, int]] = [{}]
        self.length, self.score, self.id = [0], [0.0], [-1]
        depth = [0]
        for piece, score, i in usable:
            node = 0
            for c in piece:
                if c not in self.goto[node]:
                    self.goto[node][c] = len(self.goto)
                    self.goto.append({})
                    depth.append(depth[node] + 1)
                    self.length.append(0)
                    self.score.append(0.0)
                    self.id.append(-1)
                node = self.goto[node][c]
            self.length[node], self.score[node], self.id[node] = len(piece), score, i
        n = len(self.goto)
        self.fail = [0] * n
        #: first: the node itself if a piece ends there, else as next. next: the longest proper suffix that is a piece; 0 if none.
        self.first, self.next = [0] * n, [0] * n
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for c, child in self.goto[node].items():
                back = self.fail[node]
                while back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[child] = self.goto[back].get(c, 0) if node else 0
                self.next[child] = self.first[self.fail[child]]
                self.first[child] = child if self.id[child] >= 0 else self.next[child]
                queue.append(child)
        #: The output links of each node followed to their end: (length, score, id) of all pieces that end there, longest first.
        entry = [(self.length[k], self.score[k], self.id[k]) for k in range(n)]
        self.outputs: list[tuple] = [()] * n
        order = sorted(range(n), key=depth.__getitem__)
        for node in order:
            last = self.first[node]
            self.outputs[node] = () if not last else (entry[last], *self.outputs[self.next[last]]) if last == node else self.outputs[last]
        self.singles = {p for p, _, _ in usable if len(p) == 1}
        #: Whether the best path never crosses the start of a run of SPACE, so that words can be taken by themselves.
        self.by_word = all(SPACE not in p[1:] or set(p) == {SPACE} for p, _, _ in usable)
        self.cache: dict[str, bytes] = {}

    def segment(self, text: str) -> list[int]:
        goto, fail, outputs, singles = self.goto, self.fail, self.outputs, self.singles
        best, via = [0.0], [(0, -1)]
        node = 0
        for end, c in enumerate(text, 1):
            step = goto[node].get(c)
            while step is None and node:
                node = fail[node]
                step = goto[node].get(c)
            node = step or 0
            top, how = LOWEST
            for size, score, i in outputs[node]:
                value = best[end - size] + score
                if value > top:
                    top, how = value, (size, i)
            if c not in singles and (value := best[-1] + self.unknown_score) > top:
                top, how = value, (1, -1)
            best.append(top)
            via.append(how)
        ids: list[int] = []
        end = len(text)
        while end:
            size, i = via[end]
            end -= size
            if i >= 0:
                ids.append(i)
                continue
            table = self.vocabulary.byte_ids
            data = text[end].encode("utf-8", "replace")
            ids.extend([table[b] for b in reversed(data)] if all(b in table for b in data) else [self.vocabulary.unknown])
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit words."""
        if not text:
            return b""
        if self.vocabulary.normalize:
            marked = self.vocabulary.normalize(text)
            if not marked:
                return b""
        else:
            marked = (SPACE if self.vocabulary.dummy_prefix else "") + text.replace(" ", SPACE)
        if not self.by_word:
            return np.array(self.segment(marked), "<i4").tobytes()
        words = marked.split(SPACE)
        if "" in words[1:] or words[0]:  # runs of spaces, or no space in front
            words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)
        else:
            words = words[1:]
            cache = self.cache
            try:
                return b"".join([cache[x] for x in words])
            except KeyError:
                pass
            words = [SPACE + x for x in words]
        out = []
        for word in words:
            key = word[1:]
            packed = self.cache.get(key) if word[0] == SPACE and key[:1] != SPACE else None
            if packed is None:
                packed = np.array(self.segment(word), "<i4").tobytes()
                if word[0] == SPACE and key and key[0] != SPACE and len(key) <= CACHE_LENGTH:
                    if len(self.cache) >= CACHE_WORDS:
                        self.cache = {}
                    self.cache[key] = packed
            out.append(packed)
        return b"".join(out)


    def encode_joined(self, text: str) -> bytes:
        """Ids as the library gives them: neighbouring unknown characters are one."""
        packed = self.encode(text)
        if self.vocabulary.byte_ids:
            return packed
        ids = np.frombuffer(packed, "<i4")
        again = np.zeros(len(ids), dtype=bool)
        again[1:] = (ids[1:] == self.vocabulary.unknown) & (ids[:-1] == self.vocabulary.unknown)
        return ids[~again].tobytes()


_LOADED: dict[str, PieceAutomaton] = {}


def automaton(path: str) -> PieceAutomaton:
    """One automaton a worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceAutomaton(Vocabulary.load(path))
    return _LOADED[path]


def decode_lists(ids: pa.ListArray, vocabulary: Vocabulary) -> pa.Array:
    """Texts of lists of ids, by a lookup of pieces and a join within each list."""
    plain = [
        bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode()
        for p, _, kind in vocabulary.pieces
    ]
    pieces = pa.array(plain, pa.binary()).take(ids.flatten())
    start = ids.offsets[0].as_py()
    offsets = pc.subtract(ids.offsets, start).cast(pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces), b"")
    try:
        texts = joined.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
    if vocabulary.dummy_prefix:
        texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
    return pc.if_else(pc.is_valid(ids), texts, pa.scalar(None, pa.string()))


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and the ids of ``text``."""
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = automaton(model_path).encode_joined
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                packed = [encode(x) if x else b"" for x in batch.column(n).to_pylist()]
                offsets = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), "<i4")))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], lists], names=[*keep, ids])

    return map_arrow(df.select(*map(named, keep), named(text)), run, schema_of(df, keep, f"{quoted(ids)} array<int>"))


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), text: str = "decoded") -> DataFrame:
    """Columns ``keep`` and the text of ``ids``."""
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = automaton(model_path).vocabulary
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                texts = decode_lists(batch.column(n).cast(pa.list_(pa.int32())), vocabulary)
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], texts], names=[*keep, text])

    return map_arrow(df.select(*map(named, keep), named(ids)), run, schema_of(df, keep, f"{quoted(text)} string"))
