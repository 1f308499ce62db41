"""Quality rules: counts per document, and distribution divergence from language references.

The character-class histogram of a document and the histogram of its common words are compared with those of its language
by Jensen-Shannon distance. A reference is the sum over all documents of a language; its common words are the COMMON most
frequent ones there, all others being one bin. Every language with enough text has a reference, however many there are:
references are a table that is joined to the documents. Texts below a minimum length are not judged by a histogram, since
short samples are far from any reference by chance; nor are documents whose language has no reference.

Defined cases: a null or empty text has no words, so it fails the base rule; a very long text is counted as a whole, like any
other; words of more than WORD_BYTES bytes are never common; of equally frequent words the lesser bytes come first; repeated
rows give equal rows; documents of a null language, or of one with too little text for a reference, are judged by the base
rules alone, as are all where no language has a reference (an empty table); further columns of the input are ignored by
quality_rules and carried along by keep_good.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quillspark.llm.common import as_bytes, by_slice, column, fresh, written

#: Character classes by byte: lower case, upper case, digit, space, line end, end of sentence, other punctuation, symbol, control, beyond ASCII.
CLASSES = 10
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Characters, and words, of a reference at least.
REFERENCE_CHARS, REFERENCE_WORDS = 2000, 300
#: Common words of a language, and the bytes of one at most.
COMMON, WORD_BYTES = 24, 64
#: A histogram is judged from so many characters or words on, and rejected beyond such distance (0 to 1) from the reference.
MIN_CHARS_JUDGED, MAX_CLASS_DISTANCE = 200, 0.35
#: For words, the distance that chance alone gives falls with the number of words of the text, n, and of the reference, N:
#: the limit is the root of WORD_FLOOR ** 2 + WORD_NOISE * (1 / n + 1 / N).
MIN_WORDS_JUDGED, WORD_FLOOR, WORD_NOISE = 50, 0.18, 8
#: References of so many languages are broadcast (less than 3 kB each); more are joined as Spark sees fit.
BROADCAST_LANGS = 5000
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 200_000
WINDOW = 5

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SYMBOLS = b"#*$%&|<>"


def _class(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return 9
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c == " ":
        return 3
    if c in "\n\r\t\v\f":
        return 4
    if b < 32 or b == 127:
        return 8
    if c in ".!?":
        return 5
    return 7 if c in "#*$%&|<>=+@^~\\{}[]_`/" else 6


_CLASS_OF = bytes(_class(b) for b in range(256))
_DROP_CONTINUATION = bytes(range(128, 192))
_NO_SPACE = bytes(b for b in range(256) if b not in b" \t\n\r\x0b\x0c")


def class_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(raw.translate(_CLASS_OF, _DROP_CONTINUATION), np.uint8), minlength=CLASSES)


def word_histogram(words: list[bytes], bins: dict[bytes, int]) -> np.ndarray:
    """words: lower case. Punctuation at a word's ends is not looked through: it makes another word. The last bin is any other."""
    get, other = bins.get, len(bins)
    return np.bincount([get(w, other) for w in words], minlength=other + 1) if words else np.zeros(other + 1, np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that are found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    key = ids[:n]
    for k in range(1, WINDOW):  # windows of k + 1 words get numbers that are equal for equal windows only
        key = key * len(number) + ids[k : n + k]
        if k < WINDOW - 1 and len(number) ** (k + 2) >= 1 << 62 or k == WINDOW - 1:
            _, key, count = np.unique(key, return_inverse=True, return_counts=True)
    if len(count) == n:
        return 0
    twice = np.flatnonzero(count[key] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.translate(None, b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def distance(counts: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, square root of the divergence) to a reference (shares)."""
    p = counts / counts.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        both = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, both / 2)))


def word_limit(n: int, reference: int) -> float:
    """The largest word distance that a text of n words may have from a reference of so many words."""
    return (WORD_FLOOR**2 + WORD_NOISE * (1 / n + 1 / reference)) ** 0.5


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang and ref (classes, words, counts, n_words) of each language with REFERENCE_CHARS characters or more, as a written
    table. Words are counted over all documents, in parts by task, then by word; tasks pass on COMMON words of a language
    at most for its row."""
    total, common = CLASSES, CLASSES + 1  # kinds of counts, beside the classes

    def run(batches):
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def flush():
            rows = [(lang, k, b"", n) for lang, sums in classes.items() for k, n in enumerate(sums.tolist())]
            rows += [(lang, common, w, n) for lang, found in words.items() for w, n in found.items() if len(w) <= WORD_BYTES]
            classes.clear()
            words.clear()
            types = pa.string(), pa.int32(), pa.binary(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["lang", "kind", "word", "n"])

        def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            for lang, raw in zip(batch.column(1).to_pylist(), as_bytes(batch.column(0)), strict=True):
                held = classes.setdefault(lang, np.zeros(CLASSES + 1, np.int64))
                found = raw.translate(_LOWER).split()
                held[:CLASSES] += class_histogram(raw)
                held[total] += len(found)
                words.setdefault(lang, Counter()).update(found)
            return flush() if sum(map(len, words.values())) + len(classes) > HELD_COUNTS else None

        yield from by_slice(work)(batches)
        if classes:
            yield flush()

    held = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")
    counts = held.mapInArrow(run, "lang string, kind int, word binary, n long").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    order = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word"))
    first = counts.withColumn("nth", order).where(F.col("nth") <= COMMON)  # cut by a group limit before the exchange
    of = lambda kind, x: F.when(F.col("kind") == kind, x)
    rows = first.groupBy("lang").agg(
        F.array(*(F.coalesce(F.sum(of(k, F.col("n"))), F.lit(0)) for k in range(CLASSES))).alias("classes"),
        F.sort_array(F.collect_list(of(common, F.struct("nth", "word", "n")))).alias("top"),
        F.sum(of(total, F.col("n"))).alias("n_words"),
    )
    enough = rows.where(F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x) >= REFERENCE_CHARS)
    return written(enough.select("lang", F.struct("classes", F.col("top.word").alias("words"), F.col("top.n").alias("counts"), "n_words").alias("ref")), "references")


FIELDS = ["n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long", "base_failed boolean", "kept boolean", "class_distance double", "word_distance double"]


def shares_of(ref: dict | None) -> tuple[np.ndarray | None, tuple[dict[bytes, int], np.ndarray, int] | None]:
    """Of a reference: shares of classes; bins of the common words, shares of these and any other, and number of words."""
    if ref is None:
        return None, None
    classes, n = np.array(ref["classes"], float), ref["n_words"]
    common = None
    if n >= REFERENCE_WORDS:
        common = {w: i for i, w in enumerate(map(bytes, ref["words"]))}, np.array([*ref["counts"], n - sum(ref["counts"])], float) / n, n
    return classes / classes.sum(), common


def judge(raw: bytes, classes: np.ndarray | None, common: tuple[dict[bytes, int], np.ndarray, int] | None) -> tuple:
    words = raw.split()
    n = len(words)
    chars = len(raw.translate(None, _DROP_CONTINUATION + b" \t\n\r\x0b\x0c"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    by_class = by_word = None
    far = False
    if classes is not None and (counts := class_histogram(raw)).sum() >= MIN_CHARS_JUDGED:
        by_class = distance(counts, classes)
        far = by_class > MAX_CLASS_DISTANCE
    if common is not None and n >= MIN_WORDS_JUDGED:
        bins, shares, total = common
        by_word = distance(word_histogram(raw.translate(_LOWER).split(), bins), shares)
        far = far or by_word > word_limit(n, total)
    return n, chars, symbols, repeated_lines(raw), repeat, failed, not (failed or far), by_class, by_word


def judged(texts: pa.Array, langs: pa.Array, refs: pa.Array) -> list[tuple]:
    """judge() of each row, by its language and that language's reference."""
    against: dict[str | None, tuple] = {}
    out = []
    for i, (lang, raw) in enumerate(zip(langs.to_pylist(), as_bytes(texts), strict=True)):
        if lang not in against:
            against[lang] = shares_of(refs[i].as_py())
        out.append(judge(raw, *against[lang]))
    return out


def with_references(docs: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, str, str]:
    """docs with two columns more, whose names are given, too: the language as text and its reference."""
    refs = references(docs, text_col, lang_col)
    lang, ref = fresh(docs, "lang_of", "ref")
    refs = refs.toDF(lang, ref)
    if refs.count() <= BROADCAST_LANGS:
        refs = F.broadcast(refs)
    return docs.withColumn(lang, F.col(lang_col).cast("string")).join(refs, lang, "left"), lang, ref


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: id and FIELDS. One pass for the references, one for the verdicts; texts are not shuffled
    while the references are few enough to broadcast."""
    names = [x.split()[0] for x in FIELDS]
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("own"))
    both, lang, ref = with_references(held, "text", "own")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = judged(*(column(batch, c) for c in ("text", lang, ref)))
        return pa.RecordBatch.from_arrays([column(batch, "id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return both.select("id", "text", lang, ref).mapInArrow(by_slice(work), f"`{id_col}` {kind}, {', '.join(FIELDS)}")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns."""
    both, lang, ref = with_references(docs, text_col, lang_col)
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [r[6] for r in judged(*(column(batch, c) for c in (text_col, lang, ref)))]
        return pa.RecordBatch.from_arrays([column(batch, c) for c in names], names).filter(pa.array(kept, pa.bool_()))

    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema.fields])
    return both.mapInArrow(by_slice(work, text_col), schema)
