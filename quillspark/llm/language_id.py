"""Language ID: segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over
all its segmentations of the product of its pieces' probabilities, found by a forward pass over the lattice; a text's is
the product over its words (runs of letters, lower case, a space in front). The piece probabilities are fitted by
expectation-maximisation over all segmentations of a bounded sample of labelled rows.

The score says which of the learned languages is nearest, not whether it is near: so a document is kept only if, besides,
its language explains the text better than the vocabulary's own order of pieces does, by a share of what it gains per letter
on texts of that language.

Defined cases: a null text, or one without a letter, is `und` with score 0; rows of a null language or id teach nothing;
without any labelled row every text is `und`; ties go to the first language by name; repeated rows give equal rows; words of
a very long text are worked on some at a time, and a very long word in parts between positions that no piece spans; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import by_slice, column, kept_rows, written
from quillspark.llm.lattice import Pieces, build, exact_parts, forward, log_whole, pieces_of, posteriors, shares

#: Expected rows of each language that teach (chosen by a hash of the id; all rows of a rarer language).
SAMPLE_ROWS = 2000
ROUNDS = 2
#: Languages that are scored, and whose counts a task holds, at a time. All are learned: the model takes 0.26 MB for each.
COLUMNS, HELD_LANGS = 16, 64
#: The more texts are handled together, the more often a word's lattice is used.
BATCH_BYTES = 6 << 20
#: Code points whose lattices are summed together.
CODES = 1 << 18
#: Expected counts that are added in the vocabulary's own proportions; probability of a code point without a piece.
SMOOTHING, UNKNOWN = 1000, 1e-7
#: A document is kept if its language is known with such a score.
MIN_SCORE = 0.5
#: A text of so many letters must gain this share of what its language gains per letter on the texts that taught it, above
#: the vocabulary's own order of pieces; a shorter one is judged by the score alone.
MIN_LETTERS, MIN_GAIN = 60, 0.25
UNDETERMINED = "und"
_WORD = regex.compile(r"\p{L}+")
_BASE = 1 << 20


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # a row for each piece and one for code points without a piece; a column for each language
    gains: np.ndarray | None = None  # of each language: mean log probability per letter above the vocabulary's own


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def first_weights(pieces: Pieces) -> np.ndarray:
    """By rank in the vocabulary, before any language is known."""
    p = 1 / (pieces.ranks + 10)
    return np.append(p / p.sum(), UNKNOWN)[:, None]


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4: such rows never teach."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Model:
    """The piece probabilities of each language. Word counts of the sample stay distributed; what reaches the driver is a
    number for each language and piece."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    totals = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(totals)
    pieces = pieces_of()
    if not langs:
        return Model([], np.zeros((pieces.size + 1, 0)))
    shares = docs.sparkSession.createDataFrame([(k, min(_BASE, int(_BASE * rows / totals[k]) + 1)) for k in langs], "lang string, share long")
    sample = labelled.where("text IS NOT NULL").join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("id"), F.lit(_BASE)) < F.col("share")).select("lang", "text")

    def count(batches):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[tuple[str, str], int] = {}
            for lang, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                for w in words_of(text):
                    found[lang, w] = found.get((lang, w), 0) + 1
            keys = list(zip(*found, strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(keys[0], pa.string()), pa.array(keys[1], pa.string()), pa.array(found.values(), pa.int64())], ["lang", "word", "n"])

        return by_slice(work)(batches)

    counted = written(sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    at = {lang: k for k, lang in enumerate(langs)}
    weights = np.repeat(first_weights(pieces), len(langs), axis=1)
    for _ in range(rounds):
        def expect(batches, weights=weights):
            found: dict[int, np.ndarray] = {}
            own = pieces_of()

            def flush():
                piece = [np.flatnonzero(x) for x in found.values()]
                cols = np.repeat(list(found), list(map(len, piece))), np.concatenate(piece), np.concatenate([x[i] for x, i in zip(found.values(), piece, strict=True)])
                found.clear()
                return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["lang", "piece", "n"])

            for lang, words, n in by_language(batches):
                k = at[lang]
                if len(found) == HELD_LANGS and k not in found:
                    yield flush()
                held = expected(words, n, own, weights[:, k : k + 1])
                found[k] = found[k] + held if k in found else held
            if found:
                yield flush()

        sums = counted.mapInArrow(expect, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        weights = np.repeat(SMOOTHING * first_weights(pieces), len(langs), axis=1)
        weights[sums["piece"].to_numpy(), sums["lang"].to_numpy()] += np.round(sums["n"].to_numpy(), 6)
        weights /= weights.sum(axis=0)
        weights[-1] = UNKNOWN
    model = Model(langs, weights)

    def gain(batches):
        found: dict[int, np.ndarray] = {}
        own = pieces_of()
        plain = first_weights(own)
        for lang, words, n in by_language(batches):
            k = at[lang]
            logs = score_words(words, own, np.hstack([model.weights[:, k : k + 1], plain]))
            letters = np.fromiter(map(len, words), np.int64, len(words))
            found[k] = found.get(k, np.zeros(2)) + (((logs[:, 0] - logs[:, 1]) * n).sum(), (letters * n).sum())
        if found:
            sums = np.array(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["lang", "gain", "letters"])

    total = counted.mapInArrow(gain, "lang long, gain double, letters double").groupBy("lang").agg(F.sum("gain"), F.sum("letters")).collect()
    model.gains = np.zeros(len(langs))
    for k, above, letters in total:
        model.gains[k] = round(above / letters, 9) if letters else 0
    return model


def by_language(batches):
    """(language, words, counts) of each batch of (lang, word, n)."""
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        names, numbers = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        order = np.argsort(numbers, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1) if len(order) else ():
            part = batch.take(pa.array(rows))
            yield names[numbers[rows[0]]], part.column(1).to_pylist(), part.column(2).to_numpy()


def in_chunks(words: list[str], pieces: Pieces):
    """(numbers, texts) of words, CODES code points at a time; a very long word is several texts with one number."""
    numbers, texts, size = [], [], 0
    for i, word in enumerate(words):
        for part in exact_parts(" " + word, pieces):
            if texts and size + len(part) > CODES:
                yield np.array(numbers), texts
                numbers, texts, size = [], [], 0
            numbers.append(i)
            texts.append(part)
            size += len(part)
    if texts:
        yield np.array(numbers), texts


def expected(words: list[str], counts: np.ndarray, pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """How often each piece stands in the words, summed over all segmentations by their probability. weights: one column."""
    out = np.zeros(pieces.size)
    for number, texts in in_chunks(words, pieces):
        lattice = build(texts, pieces)
        w = weights[lattice.piece]
        share = posteriors(lattice, shares(lattice, w, forward(lattice, w))[:, 0])
        unit = np.searchsorted(lattice.first, lattice.start, "right") - 1
        known = lattice.piece >= 0
        out += np.bincount(lattice.piece[known], (share * counts[number[unit]])[known], pieces.size)
    return out


def score_words(words: list[str], pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows) in each language (columns)."""
    out = np.zeros((len(words), weights.shape[1]))
    for number, texts in in_chunks(words, pieces):
        lattice = build(texts, pieces)
        found = log_whole(lattice, forward(lattice, weights[lattice.piece]))
        first = np.flatnonzero(np.diff(number, prepend=-1))  # parts of a word are neighbours
        out[number[first]] += np.add.reduceat(found, first, axis=0) if len(first) < len(number) else found
    return out


def predict(texts: list[str | None], model: Model, pieces: Pieces) -> tuple[list[str], list[float], list[bool]]:
    """Language, score, and whether the language explains the text well enough."""
    words: list[str] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = words_of(text) if text else []
        sizes[i] = len(found)
        words += found
    langs, scores, kept = [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
    if not words or not model.langs:
        return langs, scores, kept
    number = dict.fromkeys(words)
    number = dict(zip(number, range(len(number)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    letters = np.fromiter(map(len, number), np.int64, len(number))
    some = np.flatnonzero(sizes)
    begin = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
    length = np.add.reduceat(letters[ids], begin)
    sums = []
    for at in range(0, len(model.langs), COLUMNS):  # the vocabulary's own weights are a further column of the first ones
        weights = model.weights[:, at : at + COLUMNS]
        logs = score_words(list(number), pieces, weights if at else np.hstack([first_weights(pieces), weights]))
        sums += [np.add.reduceat(column[ids], begin) for column in logs.T]
    plain, sums = sums[0], np.stack(sums[1:], axis=1)
    best = sums.argmax(axis=1)
    top = sums.max(axis=1)
    odds = np.exp(sums - top[:, None])
    found = odds.max(axis=1) / odds.sum(axis=1)
    near = (length < MIN_LETTERS) | (top - plain >= MIN_GAIN * model.gains[best] * length)
    for i, k, score, ok in zip(some.tolist(), best.tolist(), found.tolist(), (near & (found >= MIN_SCORE)).tolist(), strict=True):
        langs[i], scores[i], kept[i] = model.langs[k], score, ok
    return langs, scores, kept


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score, kept (MIN_SCORE and, for texts of MIN_LETTERS, MIN_GAIN)."""
    model = model or fit(docs, id_col, text_col, lang_col)
    names = [id_col, "held_out", "lang_pred", "score", "kept"]

    def run(batches):
        pieces = pieces_of()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores, kept = predict(batch.column(2).to_pylist(), model, pieces)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs), pa.array(scores), pa.array(kept)], names)

        return by_slice(work, "text", BATCH_BYTES)(batches)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, kept boolean")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """The rows of docs whose language is found, with all their columns."""
    model = model or fit(docs, id_col, text_col, lang_col)
    return kept_rows(docs, lambda batch: predict(column(batch, text_col).to_pylist(), model, pieces_of())[2], text_col, BATCH_BYTES)
