"""Operator 12: Merkle manifest of a dataset, proofs by a recursive query.

A leaf is the hash of a row's fields.  Leaves of a language, in the order of
their ids, are hashed in runs of ``FAN`` into nodes, nodes again, up to the
language's subroot; the subroots, in the order of the languages, likewise give
the root.

* **Levels.**  Leaves are numbered within their language by a multi-level scan,
  so a language that holds most rows is numbered by many tasks.  A level is a
  group-by of the one below on ``index div FAN`` (groups of ``FAN`` at most),
  written to shared storage.
* **Node rows.**  ``nodes`` are the parent links a climb follows: the row of
  (tree, level, index) holds the joined digests of its children and the row's
  own position among its siblings.  A language's way from subroot to root
  follows its own levels, under the same tree.
* **Climb.**  One ``WITH RECURSIVE`` query ascends from the leaves: it starts
  with a row per run of leaves, which carries the digests to be checked (of the
  tampered texts, where there are any), and in each step joins the parent's
  row, appends the siblings to the proof and folds every carried digest with
  them.  The leaves of a run share all siblings above the run, so these are
  stored once a run.
* **Hot nodes.**  All leaves of a language meet at its upper nodes.  Node rows
  that more than ``BLOCK`` runs reach are repeated once per block of runs and
  joined on the block as well, so no join key is met by more than ``BLOCK``
  rows, whatever the size of a language.

Digests travel as 32 bytes and are hashed as lowercase hex text.

Edge cases: a null field counts as ``-``; a null language is a tree of its own
and comes first; null ids come first in their tree and are never tampered with;
rows equal in every field are leaves of their own; one leaf is its own subroot,
one language its own root; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import numbered_within
from . import text as T
from .shared import written

FAN = 8
BLOCK = 4096                  # runs of leaves that share a copy of an upper node's row
TAMPERED = 3                  # rows whose id's checksum it divides are tampered with
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_MOST = 20                    # levels a tree can have: FAN ** 20 leaves


def _field(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _hash(digests: Column) -> Column:
    return F.unhex(F.sha2(_hex(digests), 256))


def tampered(text: Column) -> Column:
    """``text`` with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """Written table ``(tree, i, doc_id, leaf, checked)``: each row's leaf, its
    place in its language, and the digest to check against the proof."""
    T.prepare(docs.sparkSession)
    i, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    rest = [F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("bigint").cast("string")]
    hit = F.coalesce(F.crc32(i.cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    # a tree's name keeps the order of the languages, null first
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"), i.alias("doc_id"),
        leaf(i.cast("string"), *rest, text).alias("leaf"),
        F.when(hit, leaf(i.cast("string"), *rest, tampered(text))).alias("other"))
    numbered = numbered_within(rows, ["tree"], ["doc_id", "leaf"], "i")
    return written(numbered.select("tree", (F.col("i") - 1).alias("i"), "doc_id", "leaf",
                                   F.coalesce("other", "leaf").alias("checked")), "leaves")


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node is left."""
    return F.expr(f"size(filter(sequence(0, {_MOST}), l -> shiftleft(1L, 3 * l) < {n}))")


def _joined(i: Column, digest: Column) -> Column:
    """Digests of a group as one value, by index."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(i.alias("i"), _hex(digest).alias("h")))),
                                    lambda x: x["h"]), "")


def _levels(base: DataFrame, label: str) -> DataFrame:
    """``(tree, level, i, kids)`` of all nodes above ``base (tree, i, digest)``."""
    found, live, level = None, base, 0
    while True:
        level += 1
        # trees of a single node are done
        parents = (live.groupBy("tree", F.expr(f"i div {FAN}").alias("i"))
                   .agg(F.unhex(_joined(F.col("i"), F.col("digest"))).alias("kids")))
        live = written(parents.withColumn("digest", _hash(F.col("kids"))), f"{label}-{level}")
        rows = live.select("tree", F.lit(level).alias("level"), "i", "kids")
        found = rows if found is None else found.union(rows)
        open_ = live.filter("i > 0").select("tree").distinct()
        if open_.isEmpty():
            return found
        live = live.join(written(open_, f"{label}-open"), "tree", "left_semi").select("tree", "i", "digest")


def build(leaf_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, trees)``: the node rows a climb joins, and per language
    ``(tree, n, height, rank, subroot)``."""
    counts = leaf_rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"),
                                           F.max(F.when(F.col("i") == 0, F.col("leaf"))).alias("lone"))
    counts = written(counts.withColumn("height", _height("n")), "trees")
    many = leaf_rows.join(counts.filter("n > 1").select("tree"), "tree", "left_semi")
    inner = _levels(many.select("tree", "i", F.col("leaf").alias("digest")), "level")
    inner = inner.join(counts.select("tree", "n", "height"), "tree").filter(F.col("level") <= F.col("height"))
    tops = inner.filter(F.col("level") == F.col("height")).select("tree", _hash(F.col("kids")).alias("top"))
    trees = counts.join(tops, "tree", "left").select("tree", "n", "height", F.coalesce("top", "lone").alias("subroot"))
    trees = written(numbered_within(trees.withColumn("all", F.lit(0)), ["all"], ["tree"], "rank")
                    .select("tree", "n", "height", "subroot", (F.col("rank") - 1).alias("rank")), "subroots")
    n_trees = trees.count()
    blocks = F.expr(f"((n + {FAN - 1}) div {FAN} + {BLOCK - 1}) div {BLOCK}")
    # nodes inside a tree: the blocks of runs a node covers, one for all but the upper levels
    first = F.expr(f"(i * shiftleft(1L, 3 * (level - 1))) div {BLOCK}")
    last = F.least(blocks - 1, F.expr(f"((i + 1) * shiftleft(1L, 3 * (level - 1)) - 1) div {BLOCK}"))
    inside = (inner.join(trees.select("tree", "rank"), "tree")
              .withColumn("block", F.explode(F.sequence(first, F.greatest(first, last))))
              .select("tree", "block", "level", "i", "kids",
                      F.when(F.col("level") == F.col("height"), F.col("rank") % FAN).otherwise(F.col("i") % FAN)
                      .cast("int").alias("at"), (F.col("level") == F.col("height")).alias("top")))
    nodes = inside.select("*", (F.col("top") & F.lit(n_trees == 1)).alias("done"))
    if n_trees > 1:
        above = _levels(trees.select(F.lit("").alias("tree"), F.col("rank").alias("i"), F.col("subroot").alias("digest")), "top")
        above = written(above.select(F.col("level").alias("up"), F.col("i").alias("j"), "kids"), "top")
        highest = above.agg(F.max("up")).first()[0]
        chain = trees.withColumn("up", F.explode(F.sequence(F.lit(1), F.lit(int(highest)))))
        chain = chain.withColumn("j", F.expr("rank div shiftleft(1L, 3 * up)")).join(above, ["up", "j"])
        chain = (chain.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
                 .select("tree", "block", (F.col("height") + F.col("up")).alias("level"), F.lit(0).cast("bigint").alias("i"), "kids",
                         (F.col("j") % FAN).cast("int").alias("at"), F.lit(False).alias("top"),
                         (F.col("up") == highest).alias("done")))
        nodes = nodes.unionByName(chain)
    return written(nodes, "nodes"), trees


# the climb: in each step the parent's children left and right of the row's own
# position join the proof, and every carried digest is folded between them
_CLIMB = """
WITH RECURSIVE climb (tree, run, level, i, at, done, ids, checked, own, proof, subroot) AS (
  SELECT tree, run, level, i, at, done, ids, checked, own, proof, subroot FROM {starts}
  UNION ALL
  SELECT c.tree, c.run, c.level + 1, c.i div {fan}, n.at, n.done, c.ids,
    transform(c.checked, x -> unhex(sha2(concat(lower(hex(substring(n.kids, 1, 32 * c.at))), lower(hex(x)),
                                                lower(hex(substring(n.kids, 32 * c.at + 33)))), 256))),
    c.own, concat(c.proof, substring(n.kids, 1, 32 * c.at), substring(n.kids, 32 * c.at + 33)),
    coalesce(c.subroot, CASE WHEN n.top THEN unhex(sha2(lower(hex(n.kids)), 256)) END)
  FROM climb c JOIN {nodes} n
    ON n.tree = c.tree AND n.level = c.level + 1 AND n.i = c.i div {fan} AND n.block = c.run div {block}
  WHERE NOT c.done)
SELECT * FROM climb WHERE done
"""


def climb(leaf_rows: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """Written table of one row per run of leaves: ids, leaves (``own``), the
    proof above the run, and the folded digests."""
    spark = leaf_rows.sparkSession
    x = F.struct("i", "doc_id", "leaf", "checked")
    runs = leaf_rows.groupBy("tree", F.expr(f"i div {FAN}").alias("run")).agg(F.array_sort(F.collect_list(x)).alias("x"))
    own = F.unhex(F.array_join(F.transform("x.leaf", _hex), ""))
    rows = runs.withColumn("own", own).join(trees.select("tree", "height", "rank"), "tree")

    # a run's own fold: each digest between its siblings in the run
    def folded(xs):
        def one(k, i):
            left = F.array_join(F.transform(F.slice(xs["leaf"], 1, i), _hex), "")
            right = F.array_join(F.transform(F.slice(xs["leaf"], i + 2, FAN), _hex), "")
            return F.unhex(F.sha2(F.concat(left, _hex(k), right), 256))
        return F.transform(xs["checked"], one)
    height, only = F.col("height"), F.lit(trees.count() == 1)
    starts = rows.select(
        "tree", "run", F.least(height, F.lit(1)).alias("level"), F.col("run").alias("i"),
        F.when(height <= 1, F.col("rank") % FAN).otherwise(F.col("run") % FAN).cast("int").alias("at"),
        ((height <= 1) & only).alias("done"), F.col("x.doc_id").alias("ids"),
        F.when(height == 0, F.col("x.checked")).otherwise(folded(F.col("x"))).alias("checked"), "own",
        F.lit(b"").alias("proof"),
        F.when(height == 0, F.col("own")).when(height == 1, _hash(F.col("own"))).alias("subroot"))
    starts = written(starts, "climb-start")
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    views = [f"_climb_{uuid.uuid4().hex}" for _ in range(2)]
    starts.createOrReplaceTempView(views[0])
    nodes.createOrReplaceTempView(views[1])
    spark.conf.set(limit, "-1")                       # the rows of a climb grow with the table
    try:
        return written(spark.sql(_CLIMB.format(starts=views[0], nodes=views[1], fan=FAN, block=BLOCK)), "climb")
    finally:
        spark.conf.set(limit, before)
        for view in views:
            spark.catalog.dropTempView(view)


def manifest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row."""
    rows = leaves(docs)
    nodes, trees = build(rows)
    climbed = climb(rows, nodes, trees)
    top = root(trees, nodes)
    each = climbed.select("own", "proof", "subroot", F.posexplode(F.arrays_zip("ids", "checked")).alias("p", "x"))
    own = F.expr("concat(substring(own, 1, 32 * p), substring(own, 32 * p + 33))")
    folded = _hex(F.col("x.checked"))
    return each.select(
        F.col("x.ids").alias("doc_id"), _hex(F.expr("substring(own, 32 * p + 1, 32)")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"), F.lit(top).cast("string").alias("root"),
        F.sha2(F.concat(_hex(own), _hex(F.col("proof"))), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.lit(top).cast("string")).alias("verified"))


def root(trees: DataFrame, nodes: DataFrame) -> str | None:
    """Root of the manifest as hex text (null for an empty table)."""
    last = nodes.filter("done").select(_hex(_hash(F.col("kids"))).alias("h")).first()
    if last is None:
        last = trees.select(_hex(F.col("subroot")).alias("h")).first()
    return last["h"] if last else None
