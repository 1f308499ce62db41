"""License scans: Aho-Corasick finds identifier tags and notice phrases; a shunting-yard parser evaluates licence expressions.

Words are runs of digits, a-z (A-Z lower-cased) and anything beyond ASCII. The automaton runs once over the
space-joined words of a text. Behind a tag the raw text up to the end of the line is read as an expression of
and / or / with and brackets, in one pass for the grammar and one for the postfix order.

Defined cases: a null or empty text has no words, no labels and score 0; the work on a very long text, line or expression
grows with its length; repeated rows give equal rows; a null doc_id is kept; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import as_bytes, by_slice

#: Phrase and label; these are the base.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notice phrases and their labels.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl-2",
    "eclipse public license": "epl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "all rights reserved": "proprietary",
}
TAGS = ("spdx license identifier",)
#: Licence identifiers (lower case, without -only, -or-later, +) that go under the label of a phrase.
LABELS = {
    "apache-2.0": "apache-2", "cc0-1.0": "cc0", "cc-by-4.0": "cc-by", "cc-by-nc-4.0": "cc-by-nc", "cc-by-sa-4.0": "cc-by-sa", "gpl-2.0": "gpl-2",
    "gpl-3.0": "gpl-3", "lgpl-2.1": "lgpl", "lgpl-3.0": "lgpl", "agpl-3.0": "agpl", "mpl-2.0": "mpl-2", "epl-2.0": "epl",
}
#: Identifiers of permissive licences.
PERMISSIVE = frozenset(
    "0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0 bsd-1-clause "
    "bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-source-code bsl-1.0 cc-by-1.0 cc-by-2.0 "
    "cc-by-2.5 cc-by-3.0 cc-by-4.0 cc0-1.0 curl ecl-2.0 efl-2.0 fair ftl hpnd icu ijg isc json libpng libtiff linux-openib mit mit-0 "
    "mit-advertising mit-cmu mit-feh mitnfa mulanpsl-2.0 naumen ncsa nist-pd ntp ogc-1.0 openssl pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 "
    "python-2.0 ruby sgi-b-2.0 tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib zlib-acknowledgement zpl-2.0 zpl-2.1".split()
)
#: Identifiers of other licences whose names hold no digit.
OTHERS = frozenset("apafml cnri-python entessa frameworx-1.0 glide glulxe imagemagick info-zip interbase-1.0 latex2e miros motosoto multics nokia oclc-2.0 plexus sleepycat sendmail".split())
#: What may stand for a licence and names none.
NO_LICENCE = frozenset({"none", "noassertion"})
#: Binding strength of the operators.
STRENGTH = {"or": 1, "and": 2, "with": 3}
#: Score of the strongest evidence: a parsed expression, a notice phrase.
TAG_SCORE, NOTICE_SCORE = 1.0, 0.8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(rb"[()]|[a-z0-9][a-z0-9.+:-]*")
_NAME = re.compile(r"[a-z][a-z0-9.-]*\+?")
_VERSIONED = re.compile(r"[a-z][a-z0-9.]*(-[a-z][a-z0-9.]*)*-[0-9]+(\.[0-9]+)*(-[a-z0-9.]+)*")
#: What may stand between a tag and its expression, and behind an expression that fills its line.
_BEFORE, _BEHIND = b" \t\r\x0b\x0c:='\"", b" \t\r\x0b\x0c*/->#;.'\"}]!%"
_SUFFIX = re.compile(r"(-only|-or-later|\+)$")


def expression(raw: bytes, start: int = 0, stop: int | None = None) -> tuple[list[str], int]:
    """The longest well-formed expression at the start of raw[start:stop] (lower case), in postfix order, and how many
    licences it names. What stands behind the last identifier or bracket that completes an expression is left out. Where an
    expression fills raw[start:stop] but for the end of a comment, any name in it is an identifier; else known ones are."""
    stop = len(raw) if stop is None else stop
    tokens: list[str] = []
    whole = depth = licences = counted = 0  # tokens of the longest complete expression so far; open brackets; licences, and those of it
    operand_next, exception_next = True, False
    listed = fills = True  # whether all names so far are known; whether there is nothing but the expression
    end = start
    for match in _TOKEN.finditer(raw, start, stop):
        token = match[0].decode()
        token = token.rstrip(".:-") or token
        fills = fills and not raw[end : match.start()].strip(_BEFORE if end == start else None)
        end = match.end()
        if token in STRENGTH:
            if operand_next:
                fills = False
                break
            operand_next, exception_next = True, token == "with"
        elif token == "(":
            if not operand_next or exception_next:
                fills = False
                break
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                fills = False
                break
            depth -= 1
        else:
            listed = listed and bool(exception_next or known(token))
            fills = fills and bool(listed or exception_next or known(token) or _NAME.fullmatch(token) and token not in NO_LICENCE)
            if not operand_next or not (listed or fills):
                fills = False
                break
            licences += not exception_next
            operand_next = exception_next = False
        tokens.append(token)
        if not operand_next and not depth and listed:
            whole, counted = len(tokens), licences
    if fills and not operand_next and not depth and not raw[end:stop].strip(_BEHIND):
        whole, counted = len(tokens), licences
    return postfix(tokens[:whole]), counted


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators wait on a stack until one that binds no more strongly, or a closing bracket, comes."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token in STRENGTH:
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[token]:
                out.append(waiting.pop())
            waiting.append(token)
        elif token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            out.append(token)
    return out + waiting[::-1]


def named(identifier: str) -> tuple[str, bool]:
    """Label of a licence, its own name where no phrase has one, and whether it is permissive."""
    base = _SUFFIX.sub("", identifier)
    return LABELS.get(base, base), base in PERMISSIVE


@lru_cache(maxsize=1 << 14)
def known(identifier: str) -> tuple[str, bool] | None:
    """named() of what is an identifier wherever it stands behind a tag: one of the lists, a name followed by a version, or
    a declared reference."""
    if identifier in STRENGTH or identifier in "()":
        return None
    base = _SUFFIX.sub("", identifier)
    if base in PERMISSIVE or base in OTHERS or base in LABELS or base.startswith(("licenseref-", "documentref-")) or _VERSIONED.fullmatch(base):
        return named(identifier)
    return None


def evaluate(tokens: list[str]) -> tuple[set[str], bool]:
    """Labels of all licences in the expression, and whether its terms can be met permissively (or: one side, and: both)."""
    stack: list[tuple[set[str], bool]] = []
    for token in tokens:
        if token == "with":
            stack.pop()  # the exception; it only widens what the licence permits
        elif token in STRENGTH:
            b, a = stack.pop(), stack.pop()
            if len(a[0]) < len(b[0]):
                a, b = (b[0], a[1]), (a[0], b[1])
            a[0].update(b[0])  # the larger set takes the smaller one in
            stack.append((a[0], a[1] or b[1] if token == "or" else a[1] and b[1]))
        else:
            label, free = named(token)
            stack.append(({label}, free))
    return stack[0] if stack else (set(), False)


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in ((0, BASE_PHRASES), (1, NOTICE_PHRASES), (2, dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 1))
    found.make_automaton()
    return found


def scan(raw: bytes, machine: ahocorasick.Automaton) -> tuple:
    words = raw.translate(_TO_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    n_base, first, last = 0, None, None
    base: set[str] = set()
    more: set[str] = set()
    tags, parsed, permissive = [], [], None
    counted = words_before = 0
    for end, (kind, label, length) in machine.iter(joined):
        if kind == 0:
            start = end - length
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
            n_base += 1
            base.add(label)
        elif kind == 1:
            more.add(label)
        else:
            words_before += joined.count(" ", counted, end)  # words up to the tag's end
            counted = end
            tags.append(words_before)
    if tags:
        lower = raw.translate(_LOWER)
        ends = [m.end() for m in _WORD.finditer(lower)]
        line_end = -1
        for n in tags:
            start = ends[n - 1]
            if start > line_end:
                line_end = lower.find(b"\n", start)
                line_end = len(lower) if line_end < 0 else line_end
            found, identifiers = expression(lower, start, line_end)
            if identifiers:
                labels, free = evaluate(found)
                more |= labels
                parsed.append(" ".join(found))
                permissive = free if permissive is None else permissive and free
    at = lambda x: None if x is None else joined.count(" ", 0, x)
    score = TAG_SCORE if parsed else NOTICE_SCORE if base or more else 0.0
    return len(words), n_base, at(first), at(last), ",".join(sorted(base)), ",".join(sorted(base | more)), score, ";".join(parsed), permissive


FIELDS = ["n_words long", "n_base long", "first_word long", "last_word long", "base_labels string", "labels string", "score double", "expressions string", "permissive boolean"]
TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.bool_()]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, and FIELDS. A narrow map without a shuffle."""
    names = [x.split()[0] for x in FIELDS]

    def run(batches):
        machine = automaton()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scan(raw, machine) for raw in as_bytes(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True))], [id_col, *names])

        return by_slice(work, text_col)(batches)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {', '.join(FIELDS)}")
