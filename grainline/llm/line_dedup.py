"""Operator 1: line dedup by a log-template tree (DataFrame functions only).

A text is cut into lines at ``\\n``.  Within a line, words that hold a digit
are fields (``<*>``).  The tree has a fixed depth: a line falls into the leaf
of its number of words and its first ``depth`` words.

Within a leaf, a word at a position is constant if at least ``min_docs``
documents have it there (counted over distinct masked lines of a document);
every other word is a variable field.  A line's template keeps its constants
and generalises the rest.  When fewer than ``similarity`` of its words are
constants the template is the masked line itself.  A template that recurs in
at least ``min_docs`` documents is boilerplate: its lines are dropped from all
documents but the first (smallest ``doc_id``; null ids last), which keeps them.

Scale: lines are counted per leaf first (8 bytes a line, summed in the map
tasks); only lines of leaves that can recur go on.  Equal lines are summed
before their words are exploded.  Texts are shuffled once at most, to meet
their list of dropped line numbers.

Edge cases: null text stays null with no lines; lines without a word are never
counted or dropped; a line repeated within one document counts once; rows of
equal id and text are one document; an empty table gives an empty result;
other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import written

DEPTH = 4
MIN_DOCS = 10
SIMILARITY = 60               # per cent of a line's words
FIELD = "<*>"
#: a word with a digit; starts at a word's start only and never backtracks, so long words cost linear time
_FIELD_RE = r"(?:^|(?<=[\x20\x09-\x0D]))[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _FIELD_RE, FIELD)).otherwise(line)


def _spaced(line: Column) -> Column:
    """``line`` with single spaces between its words, so that it is split at a plain character."""
    odd = line.rlike(r"[\x09-\x0D]|\x20\x20")
    return F.btrim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line), F.lit(" "))


def _lines(docs: DataFrame) -> DataFrame:
    """``(key, doc_id, line, words)`` of every line with a word.

    The filter reads the raw line; on ``words`` it would be pushed below the
    projection and compute them a second time."""
    return (T.keyed(docs).filter("text is not null")
            .select(T.K1, T.K2, "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
            .filter(F.col("body").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("body", _spaced(F.col("body")))
            .select(T.K1, T.K2, "doc_id", "line", F.split(_masked(F.col("body")), " ").alias("words")))


def _leaf(depth: int) -> Column:
    return F.xxhash64(F.size("words"), F.slice("words", 1, depth))


def line_templates(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                   similarity: int = SIMILARITY) -> DataFrame:
    """Written table ``(key, doc_id, line, template, first)`` of the lines whose
    template recurs; ``first`` marks the template's first document."""
    T.prepare(docs.sparkSession)
    lines = _lines(docs).withColumn("leaf", _leaf(depth))
    leaves = written(lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= min_docs)
                     .select("leaf"), "leaves")
    # lines of leaves that can recur; lid names the masked line within its leaf
    hot = written(lines.join(leaves, "leaf").withColumn("lid", F.xxhash64("words")), "hot")
    kinds = hot.select(T.K1, T.K2, "leaf", "lid").distinct().groupBy("leaf", "lid").agg(F.count(F.lit(1)).alias("docs"))
    bodies = hot.groupBy("leaf", "lid").agg(F.max("words").alias("words"))
    cells = written(bodies.join(kinds, ["leaf", "lid"])
                    .select("leaf", "lid", "docs", F.posexplode("words").alias("pos", "word")), "cells")
    constants = (cells.groupBy("leaf", "pos", "word").agg(F.sum("docs").alias("support"))
                 .filter(F.col("support") >= min_docs).select("leaf", "pos", "word", F.lit(True).alias("constant")))
    marked = cells.join(constants, ["leaf", "pos", "word"], "left")
    fixed = F.coalesce("constant", F.lit(False)) & (F.col("word") != FIELD)
    shape = (marked.groupBy("leaf", "lid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(fixed.cast("int")).alias("fixed"),
        F.sort_array(F.collect_list(F.struct("pos", F.when(fixed, F.col("word")).otherwise(F.lit(FIELD)).alias("shown"),
                                             "word"))).alias("cells")))
    general = F.col("fixed") * 100 >= F.col("n") * similarity
    shape = shape.select("leaf", "lid", F.array_join(F.when(general, F.col("cells.shown")).otherwise(F.col("cells.word")), " ")
                         .alias("template"))
    found = written(hot.select(T.K1, T.K2, "doc_id", "line", "leaf", "lid").join(shape, ["leaf", "lid"])
                    .select(T.K1, T.K2, "doc_id", "line", "leaf", "template"), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", T.K1, T.K2)
    recurring = (found.select("leaf", "template", order.alias("doc")).distinct()
                 .groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"))
                 .filter(F.col("docs") >= min_docs))
    return written(found.join(recurring, ["leaf", "template"]).select(
        T.K1, T.K2, "doc_id", "line", "template", "docs",
        ((F.col(T.K1) == F.col(f"first.{T.K1}")) & (F.col(T.K2) == F.col(f"first.{T.K2}"))).alias("first")), "boilerplate")


def drop_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similarity: int = SIMILARITY,
               counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with recurring lines dropped from ``text``, and two counts, whose
    names replace input columns of the same name."""
    gone = (line_templates(docs, depth, min_docs, similarity).filter(~F.col("first"))
            .groupBy(T.K1, T.K2).agg(F.collect_set("line").alias("_gone")))
    plain, names = T.positional(docs)
    text = names[T.spot(docs, "text")]
    k = T.key_columns(names[T.spot(docs, "doc_id")], text)
    out = plain.withColumns({T.K1: k[0], T.K2: k[1]}).join(gone, [T.K1, T.K2], "left")
    lines = F.split(F.col(text).cast("string"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    # the lines are bound to a lambda's variable, so a text is cut once and not once a line
    left = F.get(F.transform(F.array(lines), lambda cut: F.transform(stay, lambda i: F.get(cut, i))), 0)
    kept = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint")
    removed = F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("bigint")
    replaced = {c.lower() for c in counts}
    stays = [(at, c) for at, c in zip(names, docs.columns) if c.lower() not in replaced]
    return out.select(*[kept if at == text else F.col(at) for at, _ in stays], n, removed) \
        .toDF(*[c for _, c in stays], *counts)
