"""Corpus pipeline over ``documents``: five stages, each written as Parquet and
read back as the next one's input.

A stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on every row its
predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.llm import text as T
from grainline.llm.decontaminate import contaminated
from grainline.llm.language import identify
from grainline.llm.line_dedup import drop_lines
from grainline.llm.mixing import mix_sources
from grainline.llm.ngram_join import jaccard_components
from grainline.llm.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents whose language is rejected go; null, empty and letterless texts are rejected."""
    return T.without(docs, written(identify(docs).filter("rejected").select(T.K1, T.K2), "rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: recurring lines go, and documents of which no word is left; a text
    without a word that lost no line stays as it is."""
    removed = T.fresh(docs, "_n_removed")
    out = drop_lines(docs, counts=(T.fresh(docs, "_n_lines"), removed))
    blank = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    return out.filter(~((F.col(removed) > 0) & blank)).drop(*out.columns[-2:])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the first document of each group stays; rows of equal id and text are one
    document, texts without a word are a group of their own each."""
    return T.without(docs, written(jaccard_components(docs).filter(~F.col("leader")).select(T.K1, T.K2), "copies"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go; items without a word are never found."""
    found = contaminated(docs, T.table(spark, sf_dir, "benchmark"))
    return T.without(docs, written(found.select(T.K1, T.K2).distinct(), "leaks"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents the mix takes words from, with their counts; blank texts go."""
    return mix_sources(docs).filter("taken > 0").select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]

#: the language model and the flow have no SQL form; tests/llm checks near_copies by brute force, the other
#: stages through their operators
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's output is written and read back."""
    T.prepare(spark)
    docs = T.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
