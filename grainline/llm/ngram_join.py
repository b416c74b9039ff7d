"""Operator 8: n-gram Jaccard join by vertical partitioning.

A document's set holds its distinct 5-word shingles (ASCII letters in lower
case).  Two documents link when the Jaccard similarity of their sets is at
least the threshold; linked documents form components.

1. **Sets.**  One pass gives every document its set size and a 64-bit
   fingerprint of its set, its *node*: documents with equal sets are one node.
   The same pass counts shingles within each task and reports the locally
   repeated ones; the globally frequent ones (at most ``max_frequent``, 8
   bytes each) close the global n-gram order, all others are ordered by hash.
   Any order that all documents share gives the same links, so this table
   only decides how much work is needed.
2. **Candidates.**  Two sets that reach the threshold share an n-gram among
   the first ``n - ceil(t n) + 1`` of each.  Those prefixes go to Spark keyed
   by n-gram; n-grams of a single node drop out (``shared.recurring``).
3. **First round.**  The sets of an n-gram fall into size classes; every node is
   paired only with ``HUBS`` sets of its class and of the class below, so a group
   of near copies costs pairs in proportion to its size.  Verified pairs are
   contracted to components.
4. **Second round.**  Where an n-gram still joins different components, the
   rows outside its largest component meet the rows of all others.  Pairs in
   one component are never emitted; every pair that could link two components
   is, if the number and places of its shared prefix n-grams still allow it;
   bit signatures of the prefixes bound that number before a pair is made, and
   signatures of the whole sets (``_marks``, eight to sixteen bits a shingle) bound
   the overlap of a pair before its fragments are counted.
5. **Verification, by fragments.**  The global order is cut into fragments;
   each candidate pair's overlap is counted in every fragment by itself and
   the partial counts are summed per pair.  The exact sum decides.

Edge cases: a null or empty text has an empty set and is its own component;
1 to 4 words are one shingle; repeated rows and copies share a node; a null
``doc_id`` takes part in links but never names a component (a component of
null ids only has a null ``component_id``); other columns are not read.
Sets are compared through 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .shared import SINGLE, bitmap, in_bitmap, recurring, route, written

THRESHOLD = 75                 # per cent
FRAGMENTS = 4                  # hash fragments; the frequent n-grams are one more
MAX_FREQUENT = 1 << 20         # size bound of the broadcast table of frequent n-grams
FREQUENT = 30                  # documents from which an n-gram may count as frequent
LOCAL = 3                      # documents of one task from which it reports an n-gram
FLUSH = 4 << 20
HUBS = 4                       # sets of a size class that all others of it are held against
EVIDENCE = 30                  # per cent of a prefix that a first-round pair shares at least
NEAR = 6                       # earlier n-grams a row of the second round carries along
SIGNATURE = 4                  # 64-bit words of a node's signature in the second round; a power of two
SIZE_CLASS = 1.16              # ratio of set sizes within a class: a link spans two classes at most


def _sets(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, bounds = T.hashed_words(pc.ascii_lower(arr))
    return T.distinct_per_text(*T.shingle_hashes(h, bounds))


def _nodes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprint of each set; 0 for the empty set."""
    n = np.diff(bounds)
    a = T.sums(T.mix(h), bounds)
    b = T.sums(T.mix(h ^ np.uint64(0x5851F42D4C957F2D)), bounds)
    node = T.mix(T.mix(a) ^ T.mix(b + np.uint64(1)) ^ n.astype(np.uint64))
    return np.where(n == 0, np.uint64(0), np.where(node == 0, np.uint64(1), node))


def _marks(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Bits of each whole set in 64-bit words: a power of two of words, eight to
    sixteen bits a shingle.  Halves of a longer signature fold onto a shorter one."""
    n = np.diff(bounds)
    words = np.int64(1) << np.ceil(np.log2(np.maximum(n / 8, 1))).astype(np.int64)
    offs = np.concatenate([[0], np.cumsum(words)])
    which = np.repeat(np.arange(len(n)), n)
    bits = np.zeros(int(offs[-1]) * 64, bool)
    bits[offs[which] * 64 + (T.mix(h) & (words[which] * 64 - 1).astype(np.uint64)).astype(np.int64)] = True
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(np.packbits(bits, bitorder="little").view(np.int64)))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(row, node, n, 0)`` per document and ``(null, shingle, 0, count)``
    per locally repeated shingle."""
    schema = pa.schema([(T.K1, pa.int64()), (T.K2, pa.int32()), ("doc_id", pa.int64()), ("node", pa.int64()),
                        ("n", pa.int64()), ("seen", pa.int64()), ("marks", pa.list_(pa.int64()))])

    def counts(parts):
        k, c = np.unique(np.concatenate(parts), return_counts=True)
        k, c = k[c >= LOCAL], c[c >= LOCAL]
        z = np.zeros(len(k), np.int64)
        return pa.record_batch([pa.array(z), pa.array(z.astype(np.int32)), pa.nulls(len(k), pa.int64()), pa.array(T.signed(k)),
                                pa.array(z), pa.array(c.astype(np.int64)), pa.nulls(len(k), pa.list_(pa.int64()))], schema=schema)

    kept, total = [], 0
    for batch, arr in T.rows(batches):
        h, _, bounds = _sets(arr)
        n = np.diff(bounds).astype(np.int64)
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(T.signed(_nodes(h, bounds))),
                               pa.array(n), pa.array(np.zeros(len(n), np.int64)), _marks(h, bounds)], schema=schema)
        kept.append(h)
        total += len(h)
        if total >= FLUSH:
            yield counts(kept)
            kept, total = [], 0
    if total:
        yield counts(kept)


class _Order:
    """The global n-gram order: hash order, frequent n-grams last."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.frequent & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def is_frequent(self, h: np.ndarray) -> np.ndarray:
        out = in_bitmap(self.bits, h)
        if out.any():
            at = np.minimum(np.searchsorted(self.frequent, h[out]), len(self.frequent) - 1)
            out[out] = self.frequent[at] == h[out]
        return out


def _positions(late: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rank of each hash in its (ascending) set when the late ones come last."""
    n = np.diff(bounds)
    early = ~late
    before = np.concatenate([[0], np.cumsum(early)])
    first = np.repeat(bounds[:-1], n)
    rank_early = before[:-1] - before[first]
    n_early = np.repeat(before[bounds[1:]] - before[bounds[:-1]], n)
    return np.where(early, rank_early, n_early + (np.arange(len(late)) - first - rank_early))


def survey(docs: DataFrame) -> DataFrame:
    """Written table of set sizes and nodes per input row, and local counts."""
    return written(T.keyed(docs).mapInArrow(_survey, f"{T.K1} bigint, {T.K2} int, doc_id bigint, node bigint, n bigint, "
                                            "seen bigint, marks array<bigint>"), "sets")


def frequent_shingles(seen: DataFrame, max_frequent: int = MAX_FREQUENT) -> np.ndarray:
    """The most frequent n-grams, at most ``max_frequent`` of them."""
    top = (seen.filter("seen > 0").groupBy("node").agg(F.sum("seen").alias("c"))
           .filter(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "node").limit(max_frequent).select("node"))
    return top.toPandas()["node"].to_numpy(np.int64).view(np.uint64)


def _prefixes(docs: DataFrame, order, threshold: int) -> DataFrame:
    """``(shingle, node, meta)`` rows of all prefixes; ``meta`` packs the set's
    size, the shingle's position in the global order, and the routing state."""
    schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("meta", pa.int64())])

    def emit(batches):
        for batch in batches:
            # the whole Arrow batch is routed at once: one witness an n-gram
            shingles, nodes, metas, known = [], [], [], set()
            for _, arr in T.rows([batch]):
                h, which, bounds = _sets(arr)
                node = _nodes(h, bounds)
                n = np.diff(bounds)
                fresh = _first_seen(node, known)          # copies within the batch are one node
                length = np.where(fresh, n - (-(-threshold * n // 100)) + 1, 0)
                late = order.value.is_frequent(h)
                place = _positions(late, bounds)
                pick = place < np.repeat(length, n)
                shingles.append(h[pick])
                nodes.append(node[which[pick]])
                metas.append((n[which[pick]] << 33) | (place[pick] << 2))
            if not shingles:
                continue
            h, node, meta = map(np.concatenate, (shingles, nodes, metas))
            o = np.argsort(h)
            h, node = h[o], node[o]
            meta = meta[o] | route(h)
            for a in range(0, len(h), 100_000):
                b = slice(a, a + 100_000)
                yield pa.record_batch([pa.array(T.signed(h[b])), pa.array(T.signed(node[b])), pa.array(meta[b])],
                                      schema=schema)

    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(emit, "shingle bigint, node bigint, meta bigint"))


def _first_seen(node: np.ndarray, known: set) -> np.ndarray:
    """True for each nonempty set not met before; remembers them in ``known``."""
    fresh = np.zeros(len(node), bool)
    for i, x in enumerate(node.tolist()):
        if x and x not in known:
            known.add(x)
            fresh[i] = True
    return fresh


def _fragments(docs: DataFrame, wanted: DataFrame, order, fragments: int) -> DataFrame:
    """``(node, fragment, grams)`` of the wanted documents (and of some others)."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(wanted, T.K1))
    shift = np.uint64(64 - max(1, (fragments - 1).bit_length()))
    schema = pa.schema([("node", pa.int64()), ("fragment", pa.int32()), ("grams", pa.list_(pa.int64()))])

    def cut(batches):
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(in_bitmap(bits.value, key)))
            seen: set = set()
            for _, arr in T.rows([batch]):
                h, which, bounds = _sets(arr)
                node = _nodes(h, bounds)
                pick = _first_seen(node, seen)[which]
                h, which = h[pick], which[pick]
                frag = np.where(order.value.is_frequent(h), fragments, ((h >> shift) % np.uint64(fragments)).astype(np.int64))
                o = np.lexsort((h, frag, which))
                h, which, frag = h[o], which[o], frag[o]
                if not len(h):
                    continue
                start = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (frag[1:] != frag[:-1])])
                offs = np.r_[start, len(h)].astype(np.int32)
                yield pa.record_batch([pa.array(T.signed(node[which[start]])), pa.array(frag[start].astype(np.int32)),
                                       pa.ListArray.from_arrays(pa.array(offs), pa.array(T.signed(h)))], schema=schema)

    return (T.keyed(docs).select(T.K1, "text")
            .mapInArrow(cut, "node bigint, fragment int, grams array<bigint>")
            .dropDuplicates(["node", "fragment"]))


def possible(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Written table of the pairs ``(a, b, na, nb)`` that the whole signatures do not rule out."""
    near = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    marks = sets.select("node", "marks").join(near, "node", "left_semi").dropDuplicates(["node"])
    both = (pairs.join(marks.select(F.col("node").alias("a"), F.col("marks").alias("kx")), "a")
            .join(marks.select(F.col("node").alias("b"), F.col("marks").alias("ky")), "b")
            .withColumnsRenamed({"na": "nx", "nb": "ny"}))
    return written(both.filter(_overlap_bound() * (100 + threshold) >= (F.col("nx") + F.col("ny")) * threshold)
                   .select("a", "b", F.col("nx").alias("na"), F.col("ny").alias("nb")), "possible")


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, order, threshold: int = THRESHOLD,
             fragments: int = FRAGMENTS) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` whose summed fragment overlaps reach the threshold."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.join(reps, "node").select(T.K1, "node")
    segs = _fragments(docs, wanted, order, fragments)
    left = segs.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = segs.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb"))
    cut = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(i) for i in range(fragments + 1)])))
    partial = (cut.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("o")))
    both = partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("overlap"))
    return both.filter(F.col("overlap") * 100 >= threshold * (F.col("na") + F.col("nb") - F.col("overlap")))


def _sizes(threshold: int):
    """Different nodes whose sizes allow a link."""
    return ((F.col("x") != F.col("y"))
            & (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * threshold))


def _ahead():
    """Overlap two sets can have when this is the first n-gram they share."""
    return F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))


def _beyond(threshold: int):
    """Most n-grams that the set whose prefix ends first holds after it."""
    return F.greatest(*[F.ceil(F.col(n) * threshold / 100) - 1 for n in ("nx", "ny")])


def _signature():
    """Bits of a node's prefix n-grams, ``64 * SIGNATURE`` in all."""
    bit = F.expr("shiftleft(1L, cast(shingle & 63 as int))")
    word = F.shiftright("shingle", 6).bitwiseAND(F.lit(SIGNATURE - 1))
    return F.struct(*[F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0)).alias(f"s{i}") for i in range(SIGNATURE)]).alias("sig")


def _common():
    """Most prefix n-grams two nodes share: a bit that only one of them has set
    stands for an n-gram the other lacks, so nothing that links is lost."""
    def lacking(u: str, v: str):
        return sum((F.bit_count(F.col(f"{u}.s{i}").bitwiseAND(F.bitwise_not(F.col(f"{v}.s{i}")))) for i in range(SIGNATURE)), F.lit(0))
    return F.least(F.col("mx") - lacking("sx", "sy"), F.col("my") - lacking("sy", "sx"))


def _overlap_bound():
    """Most shingles two sets share by their whole signatures: a bit only one of
    them has set stands for a shingle the other lacks."""
    short = F.least(F.size("kx"), F.size("ky"))

    def folded(k: str):
        half = F.zip_with(F.slice(k, F.lit(1), short), F.slice(k, short + 1, short), lambda u, v: u.bitwiseOR(v))
        return F.when(F.size(k) > short, half).otherwise(F.col(k))

    def lacking(u, v):
        bits = F.zip_with(u, v, lambda i, j: F.bit_count(i.bitwiseAND(F.bitwise_not(j))))
        return F.aggregate(bits, F.lit(0), lambda total, c: total + c)
    x, y = folded("kx"), folded("ky")
    return F.least(F.col("nx") - lacking(x, y), F.col("ny") - lacking(y, x))


def _counted(met: DataFrame) -> DataFrame:
    """Distinct pairs ``x < y`` with the number ``c`` of n-grams at which they met."""
    swap = F.col("x") > F.col("y")

    def put(name: str, u: str, v: str):
        return F.when(swap, F.col(v)).otherwise(F.col(u)).alias(name)

    return (met.select(put("x", "x", "y"), put("y", "y", "x"), put("nx", "nx", "ny"), put("ny", "ny", "nx"))
            .groupBy("x", "y", "nx", "ny").agg(F.count(F.lit(1)).alias("c")))


def jaccard_components(docs: DataFrame, threshold: int = THRESHOLD, fragments: int = FRAGMENTS,
                       max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, leader)`` and the row key for every
    row of ``docs`` (``doc_id``, ``text``); ``leader`` is true for the row that
    comes first in its component (rows of equal id and text share a key and
    lead together) and for every row without words."""
    spark = docs.sparkSession
    T.prepare(spark)
    seen = survey(docs)
    sets = seen.filter("seen = 0")
    order = spark.sparkContext.broadcast(_Order(frequent_shingles(seen, max_frequent)))
    reps = written(sets.filter("node != 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", T.K1, T.K2)).alias("first"),
        F.first("n").alias("n")).select("node", "first.doc_id", f"first.{T.K1}", f"first.{T.K2}", "n"), "reps")

    meta = F.col("meta")
    lists = written(recurring(_prefixes(docs, order, threshold), "shingle", "meta", "node")
                    .select("shingle", "node", F.shiftright(meta, 33).cast("int").alias("n"),
                            F.shiftright(meta, 2).bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("p")), "lists")
    x = [F.col("node").alias("x"), F.col("n").alias("nx"), F.col("p").alias("px")]

    # first round: each node with the smallest set of its size class, and of the one below
    cls = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(SIZE_CLASS))).cast("int")
    classed = lists.withColumn("cls", cls)
    ranks = [F.col("n").cast("bigint")] + [F.xxhash64(F.lit(i), "node") for i in range(1, HUBS)]
    hubs = classed.groupBy("shingle", "cls").agg(
        *[F.min(F.struct(r.alias("r"), "node", "n", "p")).alias(f"h{i}") for i, r in enumerate(ranks)])
    hubs = (hubs.select("shingle", F.col("cls").alias("own"), F.explode(F.array_distinct(F.array(*[
        F.struct(F.col(f"h{i}.node").alias("node"), F.col(f"h{i}.n").alias("n"), F.col(f"h{i}.p").alias("p"))
        for i in range(HUBS)]))).alias("hub"))
        .select("shingle", "hub", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("cls")))
    met = _counted(classed.join(hubs, ["shingle", "cls"])
                   .select(*x, F.col("hub.node").alias("y"), F.col("hub.n").alias("ny"), F.col("hub.p").alias("py"))
                   .filter(_sizes(threshold)))
    # worth a look now: a fair part of the smaller prefix; the second round misses none
    first = written(met.filter(F.col("c") * 1600 >= F.least("nx", "ny") * EVIDENCE)
                    .select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("nx").alias("na"), F.col("ny").alias("nb")),
                    "pairs")
    links = verified(possible(first, sets, threshold), docs, reps, order, threshold, fragments).select("a", "b")
    roots = components(links)

    # second round: what still joins different components
    rows = lists.join(roots, "node", "left").select("shingle", "node", "n", "p", F.coalesce("root", "node").alias("root"))
    mixed = rows.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("shingle")
    rows = rows.join(mixed, "shingle", "left_semi").distinct()
    main = (rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("shingle").agg(F.max(F.struct("c", "root")).alias("m"))
            .select("shingle", F.col("m.root").alias("main")))
    # each row knows the NEAR n-grams before its own: a pair is emitted at its first common n-gram, and again
    # only where no common one lies among those of both rows, so it is never lost and rarely repeated
    grams = rows.groupBy("node", "n", "root").agg(F.sort_array(F.collect_list(F.struct("p", "shingle"))).alias("g"), _signature())
    rows = written(grams.select("node", "n", "root", "g", "sig", F.posexplode("g").alias("i", "own"))
                   .select("own.shingle", "node", "n", "own.p", "root", "sig", F.size("g").alias("m"),
                           F.slice(F.col("g.shingle"), F.greatest(F.col("i") - NEAR, F.lit(0)) + 1,
                                   F.least(F.col("i"), F.lit(NEAR))).alias("before"))
                   .join(main, "shingle"), "mixed")
    rest = (rows.filter("root != main")
            .select("shingle", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("p").alias("py"),
                    F.col("root").alias("ry"), "main", F.col("before").alias("by"), F.col("sig").alias("sy"), F.col("m").alias("my")))
    cross = rest.join(rows.select("shingle", *x, F.col("root").alias("rx"), F.col("before").alias("bx"),
                                  F.col("sig").alias("sx"), F.col("m").alias("mx")), "shingle").filter(
        (F.col("rx") != F.col("ry")) & ((F.col("rx") == F.col("main")) | (F.col("x") < F.col("y")))
        & _sizes(threshold) & (_ahead() * (100 + threshold) >= (F.col("nx") + F.col("ny")) * threshold)
        & ((_common() + _beyond(threshold)) * (100 + threshold) >= (F.col("nx") + F.col("ny")) * threshold)
        & ~F.arrays_overlap("bx", "by"))
    cross = _counted(cross.select("x", "y", "nx", "ny")).drop("c")
    # the overlap is at most the n-grams two prefixes share and what follows the prefix
    # that ends first in the global order
    shown = grams.select("node", F.col("g.shingle").alias("grams"))
    both = (cross.join(shown.select(F.col("node").alias("x"), F.col("grams").alias("gx")), "x")
            .join(shown.select(F.col("node").alias("y"), F.col("grams").alias("gy")), "y"))
    most = F.size(F.array_intersect("gx", "gy")) + _beyond(threshold)
    second = written(both.filter(most * (100 + threshold) >= (F.col("nx") + F.col("ny")) * threshold)
                     .select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("nx").alias("na"), F.col("ny").alias("nb")),
                     "pairs")
    second = possible(second, sets, threshold)
    if not second.isEmpty():
        more = verified(second, docs, reps, order, threshold, fragments).select("a", "b")
        more = (more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
                .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
                .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
        top = components(more)
        # nodes without a link of the first round may have one now
        own = reps.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        roots = (own.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
                 .select("node", F.coalesce("top", "root").alias("root")))
    roots = written(reps.join(roots, "node", "left")
                    .select("node", "doc_id", T.K1, T.K2, F.coalesce("root", "node").alias("root")), "roots")
    names = roots.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", T.K1, T.K2)).alias("first"))
    named = roots.join(names, "root").select("node", F.col("first.doc_id").alias("component_id"),
                                             F.col(f"first.{T.K1}").alias("lead1"), F.col(f"first.{T.K2}").alias("lead2"))
    out = sets.join(named, "node", "left")
    alone = F.col("node") == 0
    return out.select(T.K1, T.K2, "doc_id", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (alone | ((F.col(T.K1) == F.col("lead1")) & (F.col(T.K2) == F.col("lead2")))).alias("leader"))
