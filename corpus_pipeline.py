"""A cleaning pipeline over documents: rules, language, near copies, repeated passages, packing.

Defined cases, for every stage: a null text counts as empty, so the quality rules drop it; very long texts are worked on
whole; of equal rows one stays; rows of a null id stay unless their text goes; further columns of documents are carried
along, whatever their names, up to packing; an empty table gives an empty result. A document whose whole text repeats keeps
its row, with an empty text, and is packed as the end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import language_id, packing, quality_rules, simhash, substring_dedup
from quillspark.llm.common import clear, made, table, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; ties don't arise, each document is judged by itself."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found and explains them; where no row has a language, none is kept."""
    return language_id.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: 2 bits or fewer between fingerprints, or
    5-word shingles of similarity 0.8 or more."""
    return simhash.keep_first(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat an earlier document; n_chars, if there is one, follows the text."""
    return substring_dedup.deduplicate(docs).withColumns({c: F.length("text").cast(docs.schema[c].dataType) for c in docs.columns if c == "n_chars"})


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of each document lie in the sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", rules), ("language ID", language), ("SimHash near-dedup", near_copies), ("suffix-array dedup", passages), ("packing", packed)]

#: Several stages (fitted language models, token ids) can't be stated in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Intermediate tables of a stage are removed once its result is written."""
    docs, previous = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        older = set(made())
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
        result = made()[-1]
        clear(spark, [path for path in made() if path != result and (path not in older or path == previous)])
        previous = result
    return docs
