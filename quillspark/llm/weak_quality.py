"""Quality classifier: weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation over the counts of
vote patterns (all documents; a few hundred patterns) estimates how often each labeller is right and how common good
documents are, without any given label. The posterior probabilities of a bounded sample then train a linear scorer over
hashed words and word shapes, which scores every document.

Defined cases: a null or empty text, like any text on which no labeller votes and no word speaks, scores the share of
good documents; with no documents of either kind in the sample the scorer gives that share throughout; a very long text is
judged as a whole, like any other; repeated rows give equal rows; a null id is kept, and however many rows have none, the
sample has SAMPLE_ROWS at most; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_bytes, by_slice
from quillspark.llm.quality_rules import class_histogram, repeated_lines

#: Frequent words of some languages, for the labeller "common".
COMMON_WORDS = {
    "en": "the of and to a in is was it that for on with as at by he be from are this not have or an had which you but his",
    "fr": "le la les de des du un une et est en que qui dans pour par sur pas au ne se ce il elle avec son plus ou sont aux",
    "de": "der die das und ist in zu den mit von des auf dem im nicht ein eine als auch es an werden aus er hat dass sie nach bei um",
    "es": "el la los las de del un una y en que es por con para su se no al lo como más o este sus mi pero le ha si",
}
_COMMON = frozenset(" ".join(COMMON_WORDS.values()).encode().split())
#: Rows that train the scorer at most: those of the least hashes of id and text.
SAMPLE_ROWS = 4000
#: Half for words, half for word shapes.
BUCKETS = 1 << 16
#: Bucket of words that repeat the one before.
REPEAT = 0
#: Words and shapes that count for the share of good documents: a text of few words says little.
LITTLE = 20
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
KEEP_FROM = 0.5
BAD, GOOD, NONE = 0, 1, 2
_BASE = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SHAPE = bytes(
    32 if b in b" \t\n\r\x0b\x0c" else ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b if b > 32 and b != 127 else ord("?")
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


@dataclass
class Facts:
    """What the labellers look at."""

    words: int
    symbols: float  # share of characters
    upper: float  # share of letters
    distinct: float  # share of words
    same: float  # share of words equal to the one before
    common: float  # share of words that are frequent in some language
    lines: int
    copies: float  # share of lines equal to an earlier one
    ends: float  # ends of sentences per word


def facts(raw: bytes, words: list[bytes]) -> Facts:
    n = max(1, len(words))
    h = class_histogram(raw)
    lines = raw.count(b"\n") + 1
    same = sum(map(bytes.__eq__, words[1:], words)) if len(words) > 1 else 0
    return Facts(
        len(words), h[7] / max(1, h.sum()), h[1] / max(1, h[0] + h[1] + h[9]), len(set(words)) / n, same / n,
        1 - (len(words) - sum(map(_COMMON.__contains__, words))) / n, lines, repeated_lines(raw) / lines, h[5] / n,
    )


def _two(value: float, good: Callable[[float], bool], bad: Callable[[float], bool], known: bool = True) -> int:
    return NONE if not known else BAD if bad(value) else GOOD if good(value) else NONE


LABELLERS: dict[str, Callable[[Facts], int]] = {
    "symbols": lambda f: _two(f.symbols, lambda x: x < 0.005, lambda x: x > 0.02, f.words >= 3),
    "upper": lambda f: _two(f.upper, lambda x: x < 0.1, lambda x: x > 0.3, f.words >= 3),
    "distinct": lambda f: _two(f.distinct, lambda x: x > 0.45, lambda x: x < 0.3, 50 <= f.words <= 2000),
    "repeats": lambda f: _two(f.same, lambda x: x < 0.05, lambda x: x > 0.15, f.words >= 10),
    "common": lambda f: _two(f.common, lambda x: x > 0.15, lambda x: x < 0.08, f.words >= 20),
    "copies": lambda f: _two(f.copies, lambda x: x < 0.05, lambda x: x > 0.2, f.lines >= 4),
    "sentences": lambda f: _two(f.ends, lambda x: 0.02 < x < 0.5, lambda x: x == 0 or x > 0.8, f.words >= 40),
}


def votes(f: Facts) -> int:
    """The vote pattern, a digit to base 3 for each labeller."""
    code = 0
    for labeller in LABELLERS.values():
        code = code * 3 + labeller(f)
    return code


def digits(code: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS))[::-1]
    return code[:, None] // powers % 3


@dataclass
class LabelModel:
    good: float  # share of good documents
    right: np.ndarray  # [labeller, class]: how often a vote on that class is right
    posterior: dict[int, float] = field(default_factory=dict)

    def of(self, code: int) -> float:
        """Probability of a good document by its vote pattern."""
        if code not in self.posterior:
            self.posterior[code] = float(_posterior(digits(np.array([code])), self.good, self.right)[0])
        return self.posterior[code]


def _posterior(v: np.ndarray, good: float, right: np.ndarray) -> np.ndarray:
    up = np.where(v == GOOD, np.log(right[:, 1]), np.where(v == BAD, np.log(1 - right[:, 1]), 0)).sum(axis=1) + np.log(good)
    down = np.where(v == BAD, np.log(right[:, 0]), np.where(v == GOOD, np.log(1 - right[:, 0]), 0)).sum(axis=1) + np.log(1 - good)
    return 1 / (1 + np.exp(np.clip(down - up, -700, 700)))


def estimate(patterns: dict[int, int], rounds: int = 100) -> LabelModel:
    """Expectation-maximisation. It starts from labellers that seldom blame a good document, while each sees two in five of
    the bad ones: one of them looks at one kind of flaw only."""
    good, right = 0.8, np.array([[0.4, 0.97]] * len(LABELLERS))
    if not patterns:
        return LabelModel(good, right)
    codes = sorted(patterns)
    v, n = digits(np.array(codes)), np.array([patterns[c] for c in codes], float)
    for _ in range(rounds):
        p = _posterior(v, good, right)
        was = right.copy()
        good = float(np.clip((n * p).sum() / n.sum(), 0.01, 0.99))
        for k, weight in ((1, n * p), (0, n * (1 - p))):
            cast = (weight[:, None] * (v != NONE)).sum(axis=0)
            hit = (weight[:, None] * (v == (GOOD if k else BAD))).sum(axis=0)
            right[:, k] = np.clip((hit + 1) / (cast + 2), 0.02, 0.995)
        if np.abs(was - right).max() < 1e-9:
            break
    return LabelModel(good, right)


class Hasher:
    """Buckets of words (one for all that repeat the word before) and of word shapes (runs of one class shortened); remembers those it has met within a slice."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.shapes: dict[bytes, int] = {}

    def __call__(self, raw: bytes, words: list[bytes]) -> np.ndarray:
        half = BUCKETS // 2
        mine, known = self.words, self.shapes
        shapes = raw.translate(_SHAPE).split()
        for w in set(words).difference(mine):
            mine[w] = 1 + zlib.crc32(w) % (half - 1)
        for s in set(shapes).difference(known):
            known[s] = half + zlib.crc32(_RUN.sub(rb"\1", s)) % half
        own = np.array([*map(mine.__getitem__, words)], np.int64)
        own[1:][own[1:] == own[:-1]] = REPEAT
        return np.concatenate([own, np.array([*map(known.__getitem__, shapes)], np.int64)])

    def forget(self) -> None:
        self.words.clear()


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def __call__(self, buckets: np.ndarray) -> float:
        z = self.bias + self.weights[buckets].sum() / (len(buckets) + LITTLE)
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def train(rows: list[tuple[list[int], list[float], float]], good: float) -> Scorer:
    """rows: buckets, their shares of the document, target probability. Full-batch logistic regression with Adagrad."""
    bias0 = float(np.log(good / (1 - good)))
    if not rows:
        return Scorer(np.zeros(BUCKETS), bias0)
    sizes = np.array([len(r[0]) for r in rows])
    at = np.concatenate([np.array(r[0], np.int64) for r in rows]) if sizes.sum() else np.zeros(0, np.int64)
    share = np.concatenate([np.array(r[1], float) for r in rows]) if sizes.sum() else np.zeros(0)
    row = np.repeat(np.arange(len(rows)), sizes)
    target = np.array([r[2] for r in rows])
    w, b = np.zeros(BUCKETS), bias0
    seen, seen_b = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(EPOCHS):
        z = np.bincount(row, share * w[at], len(rows)) + b
        miss = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - target
        grad = np.bincount(at, share * miss[row], BUCKETS) / len(rows) + DECAY * w / len(rows)
        seen += grad**2
        w -= RATE * 10 * grad / np.sqrt(seen)
        seen_b += miss.mean() ** 2
        b -= RATE * miss.mean() / np.sqrt(seen_b)
    return Scorer(w.astype(np.float32).astype(float), float(b))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> tuple[LabelModel, Scorer]:
    """Vote patterns are counted over all documents (at most 3 to the number of labellers reach the driver); the scorer's
    sample has a fixed number of rows at most and reaches the driver as bucket shares."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([votes(facts(raw, raw.translate(_LOWER).split())) for raw in as_bytes(batch.column(0))], pa.int64())], ["votes"])

    counted = texts.select("text").mapInArrow(by_slice(vote), "votes long").groupBy("votes").count().collect()
    labels = estimate({r["votes"]: r["count"] for r in counted})
    total = sum(r["count"] for r in counted)

    def features(batches):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hasher = Hasher()
            out = []
            for raw in as_bytes(batch.column(0)):
                words = raw.translate(_LOWER).split()
                found, n = np.unique(hasher(raw, words), return_counts=True)
                out.append((found.tolist(), (n / (n.sum() + LITTLE)).tolist(), labels.of(votes(facts(raw, words)))))
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64()), strict=True)], ["buckets", "shares", "target"])

        return by_slice(work)(batches)

    hashed = texts.withColumn("hash", F.xxhash64("id", "text"))
    share = F.pmod("hash", F.lit(_BASE)) < min(_BASE, 2 * _BASE * rows // max(1, total) + 1)  # twice as many are expected, so that few rows are sorted
    part = hashed.where(share).orderBy("hash", "id").limit(rows)
    sample = part.select("text").mapInArrow(features, "buckets array<long>, shares array<double>, target double").collect()
    return labels, train([(r["buckets"], r["shares"], r["target"]) for r in sample], labels.good)


FIELDS = ["votes string", "posterior double", "score double", "kept boolean"]


def weak_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[LabelModel, Scorer] | None = None) -> DataFrame:
    """One row per row of docs: id, votes (G, B or - for each labeller), posterior by the votes, score by the scorer, kept
    (score of KEEP_FROM or more)."""
    labels, scorer = model or fit(docs, id_col, text_col)
    names = [id_col, *(x.split()[0] for x in FIELDS)]

    def run(batches):
        hasher = Hasher()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for raw in as_bytes(batch.column(1)):
                words = raw.translate(_LOWER).split()
                code = votes(facts(raw, words))
                score = scorer(hasher(raw, words))
                out.append(("".join("BG-"[d] for d in digits(np.array([code]))[0]), labels.of(code), score, score >= KEEP_FROM))
            hasher.forget()
            cols = zip(*out, strict=True)
            types = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

        return by_slice(work, text_col)(batches)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {', '.join(FIELDS)}")
