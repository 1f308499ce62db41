"""Text expressions, all built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r"


def none_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """The first of the columns that is neither null nor empty."""
    return F.coalesce(*(none_if_blank(c) for c in cs))


def transcript_key(filename: Column, ticker: Column, event: Column) -> Column:
    """The file's name, or ticker_event where there is none."""
    return F.coalesce(none_if_blank(filename), F.concat_ws("_", ticker, event))


def company_or_ticker(company: Column, ticker: Column, unknown: str = "Unknown") -> Column:
    """The company's name, or its ticker with spaces for dashes, or the literal."""
    return first_filled(company, F.replace(ticker, F.lit("-"), F.lit(" ")), F.lit(unknown))


def mixed_order(c: Column) -> list[Column]:
    """Sort keys of texts of which some are whole numbers: those first, by value, then the others by text."""
    return [F.when(c.rlike("^[0-9]+$"), c.try_cast("decimal(38,0)")).asc_nulls_last(), c.asc()]


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def word_count(c: Column) -> Column:
    """Runs of anything but white space; 0 for null."""
    return F.coalesce(F.size(words(c)), F.lit(0))


def token_estimate(c: Column) -> Column:
    """Weighted estimate from length without runs of white space (half), length (3 tenths) and words (2 tenths), plus a
    tenth, truncated; 0 for null and empty texts."""
    # the text is split once: a one-element array binds its words to a name
    value = lambda found: (F.length(F.array_join(found, " ")) / 3.5 * 0.5 + F.length(c) / 4.0 * 0.3 + F.size(found) * 1.3 * 0.2) * 1.1
    return F.when(F.length(c) > 0, F.get(F.transform(F.array(words(c)), lambda found: value(found).cast("int")), F.lit(0))).otherwise(0)


def preview(c: Column, n: int) -> Column:
    """The first n characters, with dots only if there are more."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def clean(c: Column) -> Column:
    """White space of any kind to single characters, outer white space gone."""
    return F.trim(F.regexp_replace(F.trim(c, F.lit(BLANKS)), r"[\r\n\t]", " "))


def escaped(c: Column) -> Column:
    """clean() with quotes behind a backslash, for interchange formats that want them so."""
    return F.replace(clean(c), F.lit('"'), F.lit('\\"'))


def html_text(c: Column) -> Column:
    """Text of an HTML page: scripts, styles and tags out, white space squeezed."""
    bare = c
    for tag in ("script", "style"):
        bare = F.regexp_replace(bare, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def path_safe(c: Column) -> Column:
    """Spaces to underscores; dots and commas out."""
    return F.translate(c, " .,", "_")


def is_safe_path(c: Column, longest: int = 260) -> Column:
    """No step up, no root, none of the characters that file shares refuse, not too long."""
    return F.coalesce(~c.contains("..") & ~c.startswith("/") & ~c.rlike(r'[<>:"|?*\x00]') & (F.length(c) <= longest) & (c != ""), F.lit(False))


def is_safe_share_path(c: Column) -> Column:
    """Slashes at the ends don't count; of the steps between them none is empty, `.` or `..`, and each is a safe path."""
    steps = F.split(F.regexp_replace(c, "^/+|/+$", ""), "/")
    return F.coalesce(F.forall(steps, lambda x: (x != ".") & is_safe_path(x)), F.lit(False))


def speaker_label(name: Column, title: Column, affiliation: Column) -> Column:
    """name, title, affiliation; empty parts and those equal to an earlier one are left out."""
    name, title, affiliation = none_if_blank(F.trim(name)), none_if_blank(F.trim(title)), none_if_blank(F.trim(affiliation))
    t = F.when(F.coalesce(title != name, F.lit(True)), title)
    a = F.when(F.coalesce(affiliation != name, F.lit(True)) & F.coalesce(affiliation != title, F.lit(True)), affiliation)
    return F.when(name.isNull(), F.lit("Unknown Speaker")).otherwise(F.concat_ws(", ", name, t, a))


def question_flag(kind: Column) -> Column:
    return F.when(kind == "q", "question").when(kind == "a", "answer")


def is_analyst(c: Column) -> Column:
    return F.coalesce(F.lower(c).contains("analyst"), F.lit(False))


#: Forms of titles (a call's whole title, a period anywhere, a spelt-out and a short one), spelt-out quarters.
CALL_TITLE = r"(?i)^Q([1-4])\s+(20\d{2})\s+Earnings\s+Call$"
PERIOD = r"(?i)Q([1-4])\s+(20\d{2})"
SPELT_PERIOD = r"(?i)%s\s+Quarter\s+(20\d{2})"
SHORT_PERIOD = r"(?i)%dQ(\d{2})"
SPELT = {"First": "Q1", "Second": "Q2", "Third": "Q3", "Fourth": "Q4"}


def title_is_call(c: Column) -> Column:
    """Exactly `Qn 20yy Earnings Call`, any case."""
    return F.coalesce(c.rlike(CALL_TITLE), F.lit(False))


def title_period(c: Column, extended: bool = True) -> tuple[Column, Column]:
    """(quarter, year) of a title, 'Unknown' where none is found. `Q1 2024` anywhere; extended: then `First Quarter 2024`,
    then `1Q24`. A miss of Spark's regexp_extract is an empty string."""
    quarter = F.when(c.rlike(PERIOD), F.concat(F.lit("Q"), F.regexp_extract(c, PERIOD, 1)))
    year = none_if_blank(F.regexp_extract(c, PERIOD, 2))
    if extended:
        spelt_q, spelt_y = [], []
        for word, q in SPELT.items():
            pattern = SPELT_PERIOD % word
            spelt_q.append(F.when(c.rlike(pattern), q))
            spelt_y.append(none_if_blank(F.regexp_extract(c, pattern, 1)))
        short = [(n, SHORT_PERIOD % n) for n in range(1, 5)]
        quarter = F.coalesce(quarter, *spelt_q, *(F.when(c.rlike(p), F.lit(f"Q{n}")) for n, p in short))
        year = F.coalesce(year, *spelt_y, *(F.when(c.rlike(p), F.concat(F.lit("20"), F.regexp_extract(c, p, 1))) for _, p in short))
    return F.coalesce(quarter, F.lit("Unknown")), F.coalesce(year, F.lit("Unknown"))


#: Endings of company names.
SUFFIXES = ("PLC", "AG", "N.V.", "S.A.", "Inc.", "Inc", "Corp.", "Corp", "Ltd.", "Ltd", "Group", "Limited", "Corporation", "Company", "AB", "Abp", "S.p.A.")


def bare_company(c: Column) -> Column:
    """A company's name without endings such as Inc. or Group."""
    ends = "|".join(x.replace(".", r"\.") for x in SUFFIXES)
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?i)(\s+(?:{ends}))+$", ""), r"\s+", " "))


#: First words that say nothing about a company, and a word that is looked for by itself.
COMMON_FIRST, OWN_WORDS = ("The", "St", "St."), ("James",)


def search_terms(c: Column) -> Column:
    """What a company is looked for by: its bare name, its first word unless that says nothing, and words of their own."""
    bare = bare_company(c)
    first = F.get(F.split(bare, " "), F.lit(0))
    own = [F.when(c.contains(w), w) for w in OWN_WORDS]
    return F.array_distinct(F.array_compact(F.array(F.nullif(bare, F.lit("")), F.when((first != "") & ~first.isin(*COMMON_FIRST), first), *own)))


def ticker_variants(c: Column, exchanges: tuple[str, ...] = ("US", "CA", "GB")) -> Column:
    """The ticker, its part before the dash, upper case of both, and that part with exchange endings; each once."""
    base = F.split(c, "-")[0]
    return F.array_distinct(F.array(c, base, F.upper(c), F.upper(base), *(F.concat(F.upper(base), F.lit(f"-{x}")) for x in exchanges)))


def redacted_url(c: Column) -> Column:
    """Credentials and query of a URL masked."""
    return F.regexp_replace(F.regexp_replace(c, r"//[^/@]*@", "//***@"), r"\?.*$", "?***")


def display_label(c: Column, labels: dict[str, str]) -> Column:
    """Label by map; else underscores read as spaces."""
    known = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)) if labels else None
    plain = F.replace(c, F.lit("_"), F.lit(" "))
    return plain if known is None else F.coalesce(known[c], plain)


def token_cost(prompt: Column, completion: Column, prompt_rate: float, completion_rate: float) -> Column:
    return F.round(prompt / 1000 * prompt_rate + completion / 1000 * completion_rate, 6)


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(part * 100.0 / F.nullif(whole, F.lit(0)), 1), F.lit(0.0))


def terms(c: Column) -> Column:
    """Distinct lower-case runs of letters a-z and digits: what a full-text index would hold."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([a-z0-9]+)"), F.lit(1)))


def ordered_terms(c: Column) -> Column:
    """All of them, in their order, repeats included."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def has_terms(c: Column, wanted: list[str]) -> Column:
    """Whether all wanted terms stand in the text. A cheap substring test goes first."""
    found = F.lit(True)
    low = F.lower(c)
    for w in wanted:
        found = found & low.contains(w)
    for w in wanted:
        found = found & low.rlike(rf"(^|[^a-z0-9]){w}([^a-z0-9]|$)")
    return F.coalesce(found, F.lit(False))


def block_digest(paragraphs: Column, most: int = 3, n: int = 200) -> Column:
    """The first paragraphs of a block, each cut to n characters, and how many more there are."""
    shown = F.array_join(F.transform(F.slice(paragraphs, 1, most), lambda p: preview(p, n)), "\n")
    more = F.size(paragraphs) - most
    return F.when(more > 0, F.concat(shown, F.lit("\n... and "), more, F.lit(" more"))).otherwise(shown)


def labelled_ids(ids: Column, names: dict[int, str]) -> Column:
    """`1: Name, 2: Other` for ids with names."""
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.array_join(F.transform(F.filter(ids, lambda i: known[i].isNotNull()), lambda i: F.concat(i.cast("string"), F.lit(": "), known[i])), ", ")
