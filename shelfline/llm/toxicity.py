"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words and the first letters of each
word, hashed to 32 bits. The machine scores them as
    bias + sum w_i + sum_{i<j} <v_i, v_j>
so that two terms together can tell more than each alone. It is fitted on the
driver on a bounded sample of labelled documents (:data:`MAX_TRAIN_ROWS`, those
with the least hash of their id; of an id's texts the one with the least hash).
Every term of :data:`MIN_ROWS` training texts or more has a weight and factors; of
more than :data:`MAX_FEATURES` such terms those in the most texts have. A term whose
own rate doesn't stand out pays for its weight and its factors (:data:`PENALTY`,
proximal steps), so that it keeps them only if pairs with others earn them; those
that have nothing left after :data:`TRIAL` epochs leave the machine.
Scoring reads every text whole and does not shuffle.

Defined results
    null or empty text   the score of the bias alone
    no labelled rows, or one class only   the smoothed share of toxic rows; as
                         nothing was learned, drop_toxic drops nothing then
    several labels of one document   toxic if any says so; null labels don't count
    repeated rows        scored alike; an id trains once, however many rows it has
    null ids             scored, never trained on
    empty table          no rows
Other columns pass through; one named like the score is replaced by it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, materialize, named, quoted, schema_of

#: Labelled documents from which the machine learns, at most.
MAX_TRAIN_ROWS = 12_000
#: Terms of all training rows together, at most; where rows are longer, fewer rows are learned from, each with all of its terms.
MAX_TRAIN_TERMS = 20_000_000
#: Terms with parameters of their own, at most.
MAX_FEATURES = 1 << 17
#: A term has parameters if it stands in so many training rows; it pays no penalty if its rate is so many deviations from all rows'.
MIN_ROWS, MIN_Z = 10, 3.5
#: Of many training rows it needs a share; terms that stand out need fewer rows.
MIN_SHARE, MIN_ROWS_STRONG = 1 / 400, 3
PENALTY, TRIAL = 1e-2, 3
FACTORS, RATE, DECAY, SPREAD = 8, 0.05, 1e-4, 0.05
#: About so many steps, but within these numbers of epochs.
STEPS, EPOCHS = 1_500, (10, 30)
#: Training rows of a step.
BATCH = 64
#: Terms that are sorted or looked up at once: of the training rows the driver holds their terms and feature numbers, the rest does not grow with them.
PIECE = 1 << 18
PREFIXES = (3, 5)
WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 120_000


def held_out(key: Column) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0


# ---------------------------------------------------------------- terms


class Terms:
    """Hashed terms of texts, or with ``index`` the numbers of those terms that have
    one, with a bounded cache of words."""

    def __init__(self, index: dict[int, int] | None = None) -> None:
        self.index = index
        self.cache: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def of_word(word: str) -> tuple[int, ...]:
        forms = (word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n))
        return tuple(zlib.crc32(x.encode()) - (1 << 31) for x in forms)

    def __call__(self, text: str | None) -> set[int]:
        found: set[int] = set()
        cache = self.cache
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        for word in set(WORD.findall((text or "").lower())):
            terms = cache.get(word)
            if terms is None:
                terms = self.of_word(word)
                if self.index is not None:
                    terms = tuple(self.index[t] for t in terms if t in self.index)
                cache[word] = terms
            found.update(terms)
        return found


# ---------------------------------------------------------------- machine


@dataclass
class FactorizationMachine:
    """Weights of the terms in ``index``; terms outside it do not count. Not
    ``learned`` means that no rows of both classes were there to learn from."""

    index: dict[int, int] = field(default_factory=dict)
    bias: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    v: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))
    learned: bool = False

    def score(self, rows: list[list[int]]) -> np.ndarray:
        """Probabilities of rows of feature numbers."""
        sizes = np.array([len(x) for x in rows], dtype=np.int64)
        out = np.full(len(rows), self.bias)
        some = np.flatnonzero(sizes)
        if len(some):
            flat = np.concatenate([rows[i] for i in some]).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            sums = np.add.reduceat(self.v[flat], starts, axis=0)
            squares = np.add.reduceat((self.v**2).sum(axis=1)[flat], starts)
            out[some] += np.add.reduceat(self.w[flat], starts) + ((sums**2).sum(axis=1) - squares) / 2
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def candidate_terms(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms with parameters, and which of them stand out by themselves. Terms are
    counted range by range, of so many ranges that one has about PIECE of them."""
    p, least = y.mean(), max(MIN_ROWS, len(rows) * MIN_SHARE)
    sizes = np.array([len(x) for x in rows], dtype=np.int64)
    blocks = np.split(np.arange(len(rows)), np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1)
    edges = [(i << 32) // n - (1 << 31) for n in [int(sizes.sum()) // PIECE + 1] for i in range(n + 1)]
    found = []
    for low, high in zip(edges, edges[1:]):
        own, marks = [], []
        for block in blocks:
            flat = np.concatenate([rows[i] for i in block])
            within = (flat >= low) & (flat <= high - 1)
            own.append(flat[within])
            marks.append(np.repeat(y[block], sizes[block])[within])
        terms, at, n = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        hits = np.bincount(at, weights=np.concatenate(marks), minlength=len(terms))
        strong = np.abs(hits - n * p) >= MIN_Z * np.sqrt(n * p * (1 - p))
        enough = n >= np.where(strong, MIN_ROWS_STRONG, least)
        found.append((terms[enough], strong[enough], n[enough]))
    terms, strong, n = map(np.concatenate, zip(*found))
    order = np.argsort(-n, kind="stable")[:MAX_FEATURES]
    return terms[order], strong[order]


class Steps:
    """Mini-batches, whose rows never change: the feature numbers of all rows in one
    array, step by step. A step's matrix is there only while it is used."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, parts: list[np.ndarray], chosen: np.ndarray) -> None:
        order = np.argsort(chosen)
        ranked, order = chosen[order], order.astype(np.int32)
        self.flat = np.empty(sum(map(len, rows)), np.int32)
        self.y = [y[part].astype(np.float32) for part in parts]
        self.sizes: list[np.ndarray] = []
        self.starts = [0]
        self.seen, self.place = np.zeros(len(chosen), bool), np.zeros(len(chosen), np.int32)
        end = 0
        for part in parts:
            sizes = []
            for row in (rows[i] for i in part):
                begin = end
                for at in range(0, len(row), PIECE):
                    piece = row[at : at + PIECE]
                    near = np.minimum(np.searchsorted(ranked, piece), len(ranked) - 1)
                    own = order[near[ranked[near] == piece]]
                    self.flat[end : end + len(own)] = own
                    end += len(own)
                sizes.append(end - begin)
            self.sizes.append(np.array(sizes))
            self.starts.append(end)

    def __len__(self) -> int:
        return len(self.y)

    def keep(self, alive: np.ndarray) -> None:
        """Only these features stay."""
        end, starts = 0, self.starts
        self.starts = [0]
        for i, (a, b) in enumerate(zip(starts, starts[1:])):
            own = self.flat[a:b]
            stays = alive[own]
            owner = np.repeat(np.arange(len(self.sizes[i])), self.sizes[i])
            self.sizes[i] = np.bincount(owner[stays], minlength=len(self.sizes[i]))
            own = own[stays]
            self.flat[end : end + len(own)] = own
            end += len(own)
            self.starts.append(end)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Labels, used features and the matrix of rows by used features."""
        own = self.flat[self.starts[i] : self.starts[i + 1]]
        self.seen[own] = True
        used = np.flatnonzero(self.seen)
        self.seen[used] = False
        self.place[used] = np.arange(len(used), dtype=np.int32)
        matrix = np.zeros((len(self.y[i]), len(used)), np.float32)
        matrix[np.repeat(np.arange(len(self.y[i]), dtype=np.int32), self.sizes[i]), self.place[own]] = 1
        return self.y[i], used, matrix


def fit(rows: list[np.ndarray], labels: list[int], seed: int = 7) -> FactorizationMachine:
    """Logistic loss by AdaGrad over mini-batches; the same rows give the same machine."""
    y = np.array(labels, dtype=float)
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    machine = FactorizationMachine(bias=float(np.log(share / (1 - share))), learned=bool(0 < y.sum() < len(y)))
    if not machine.learned or not sum(map(len, rows)):
        return machine
    chosen, strong = candidate_terms(rows, y)
    if not len(chosen):
        return machine
    rng = np.random.default_rng(seed)
    k = len(chosen)
    steps = Steps(rows, y, np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)), chosen)
    # single precision halves what the sums move
    w, v = np.zeros(k, np.float32), rng.normal(0, SPREAD, (k, FACTORS)).astype(np.float32)
    gw, gv, gb = np.full(k, 1e-2, np.float32), np.full((k, FACTORS), 1e-2, np.float32), 1e-2
    price = np.where(strong, 0.0, PENALTY).astype(np.float32)
    for epoch in range(min(EPOCHS[1], max(EPOCHS[0], -(-STEPS // len(steps))))):
        if epoch == TRIAL:
            steps.keep(strong | (w != 0) | v.any(axis=1))
        for i in rng.permutation(len(steps)):
            marks, used, x = steps[i]
            n = len(marks)
            own_w, own_v = w[used], v[used]
            sums = x @ own_v
            out = machine.bias + x @ (own_w - (own_v**2).sum(axis=1) / 2) + (sums**2).sum(axis=1) / 2
            error = 1 / (1 + np.exp(-np.clip(out, -40, 40))) - marks
            gradient_b = float(error.mean())
            gb += gradient_b**2
            machine.bias -= RATE * gradient_b / gb**0.5
            # the derivative of a row by its feature's factors is its sum of factors less the feature's own
            both = x.T @ np.column_stack([sums * error[:, None], error])
            dw = both[:, -1] / n + DECAY * own_w
            dv = (both[:, :-1] - own_v * both[:, -1:]) / n + DECAY * own_v
            gw[used] += dw**2
            gv[used] += dv**2
            rate_w, rate_v = RATE / np.sqrt(gw[used]), RATE / np.sqrt(gv[used])
            moved, turned = own_w - rate_w * dw, own_v - rate_v * dv
            w[used] = np.sign(moved) * np.maximum(np.abs(moved) - rate_w * price[used], 0)
            size = np.sqrt((turned**2).sum(axis=1)) + 1e-12
            v[used] = turned * np.maximum(1 - rate_v.mean(axis=1) * price[used] / size, 0)[:, None]
    left = strong | (w != 0) | v.any(axis=1)
    machine.index = {int(t): i for i, t in enumerate(chosen[left])}
    machine.w, machine.v = w[left].astype(np.float64), v[left].astype(np.float64)
    return machine


# ---------------------------------------------------------------- operators


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = MAX_TRAIN_ROWS) -> tuple[list[np.ndarray], list[int]]:
    """Terms and labels of the training rows, in a fixed order. The chosen label
    rows are at most ``rows``, so they may be broadcast to the documents; terms are
    kept in the shared folder, and only those within MAX_TRAIN_TERMS come to the driver."""
    own, mark = named(key), named(label)
    chosen = (
        labels.where(mark.isNotNull() & own.isNotNull() & ~held_out(own))
        .groupBy(own.alias("__key"))
        .agg(F.max(mark.cast("int")).alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(rows)
    )
    picked = docs.select(own.alias("__key"), named(text).alias("__text")).join(F.broadcast(chosen), "__key")
    once = picked.groupBy("__key", "__label").agg(F.min(F.struct(F.xxhash64("__text").alias("h"), F.col("__text").alias("t"))).alias("__least"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for big in batches:
            for at in range(0, big.num_rows, 200):
                batch = big.slice(at, 200)
                found = [sorted(terms(x)) for x in batch.column(2).to_pylist()]
                sizes = pa.array([len(x) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(found, pa.list_(pa.int32()))], names=["key", "label", "n", "terms"])

    typed = once.select(F.col("__key").cast("string"), "__label", F.col("__least")["t"].alias("text"))
    kept = materialize(typed.mapInArrow(run, "key string, label int, n bigint, terms array<int>"), "training-terms")
    order = sorted(((zlib.crc32(r["key"].encode()), r["key"], r["n"]) for r in kept.select("key", "n").collect()))  # ``rows`` rows at most
    total, within = 0, []
    for crc, k, n in order:
        total += n
        if total > MAX_TRAIN_TERMS:
            break
        within.append((crc, k))
    if not within:
        return [], []
    last = within[-1]
    crc = F.crc32(F.encode("key", "UTF-8"))
    found = kept.where((crc < last[0]) | ((crc == last[0]) & (F.col("key") <= last[1]))).select("key", "label", "terms").toArrow()
    own: dict[str, tuple[np.ndarray, int]] = {}
    for batch in found.to_batches():  # views: what came is held once
        values, offsets = batch.column("terms").values.to_numpy(), batch.column("terms").offsets.to_numpy()
        for i, (k, mark) in enumerate(zip(batch.column("key").to_pylist(), batch.column("label").to_pylist())):
            own[k] = values[offsets[i] : offsets[i + 1]], mark
    return [own[k][0] for _, k in within], [own[k][1] for _, k in within]


def fit_toxicity(docs: DataFrame, labels: DataFrame, **names: str) -> FactorizationMachine:
    return fit(*labelled_sample(docs, labels, **names))


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score``, which replaces one of that name."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by MAX_FEATURES
    kept = [c for c in docs.columns if c != score]
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        terms = _worker_terms(machine)
        for big in batches:
            for start in range(0, big.num_rows, 200):
                batch = big.slice(start, 200)
                rows = [sorted(terms(x)) for x in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(machine.score(rows))], names=[*kept, score])

    return map_arrow(docs.select(*map(named, kept)), run, schema_of(docs, kept, f"{quoted(score)} double"))


_TERMS: list = [None, None]


def _worker_terms(machine: FactorizationMachine) -> Terms:
    """One cache of words a worker process and machine."""
    if _TERMS[0] is not machine:
        _TERMS[:] = machine, Terms(machine.index)
    return _TERMS[1]


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns; all of
    them if the labels told nothing."""
    machine = fit_toxicity(docs, labels)
    if not machine.learned:
        return docs
    score = free_name(docs, "toxicity")
    scored = score_toxicity(docs, machine, score=score)
    return scored.where(named(score) < threshold).select(*map(named, docs.columns))
