"""Operator 10: mixing overlapping sources to target weights by min-cost flow.

A text that several sources hold belongs to all of them.  Texts are therefore
aggregated by *membership pattern*, the set of sources that hold them.  Tokens
flow from patterns to source quotas: the first pass over a pattern's texts
costs nothing, each further pass one unit more than the one before, so the
costs are convex and repetition is spread as thin as the quotas allow.  Second
and later copies of a text inside one source, whether under other ids or as
repeated rows, are a last resort of that source; they count with their full size.
The flow network has a node per pattern and per source and is solved on the
driver; texts never get there.

* **Targets.**  Sources in code point order (null last) weigh 5, 2, 1,
  repeating, and share 150 % of all sizes; a target stops at twice its source's
  size and the excess is shared again by weight.
* **Selection.**  Within a pattern, texts are laid on a line in a seeded order.
  Its sources take consecutive stretches of that line, which wraps around, so
  repeats only begin once every text was taken.  The positions are two-level
  prefix sums (hash buckets, then within a bucket).  A stretch may end inside
  a text, so each source takes its target exactly, rounded down.

Bounds: one driver row per source and per membership pattern, that is per set of
sources some text occurs in; texts, ids and rows never get there.

Edge cases: null or blank text has size 0 and is never taken; a null source is
a source; rows equal in id, source and text share what is taken evenly, the
first of them (in the order of the staged rows) one word more where it does not
divide; an empty table gives an empty result; other columns are ignored.
Reruns agree: the order depends on the seed and the texts alone.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import numbered_within
from . import text as T
from .shared import place, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
SEED = 20
BUCKETS = 4096


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> dict:
    """Target per source: weighted shares of ``budget`` times all sizes, none
    above ``most`` times its source, the excess shared again."""
    order = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    out, left, open_ = {}, budget * sum(size.values()), [s for s, _ in order]
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= most * size[s]]
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            out[s] = float(most * size[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


class _Flow:
    """Maximum flow (shortest augmenting levels) that keeps the flow it has."""

    def __init__(self, n: int):
        self.to, self.cap, self.out = [], [], [[] for _ in range(n)]

    def arc(self, a: int, b: int, cap: int) -> int:
        for x, y, c in ((a, b, cap), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
        return len(self.to) - 2

    def push(self, s: int, t: int) -> None:
        while True:
            level, queue = {s: 0}, deque([s])
            while queue:
                x = queue.popleft()
                for e in self.out[x]:
                    if self.cap[e] > 0 and self.to[e] not in level:
                        level[self.to[e]] = level[x] + 1
                        queue.append(self.to[e])
            if t not in level:
                return
            at = [0] * len(self.out)
            while True:
                path, x = [], s
                while x != t:
                    while at[x] < len(self.out[x]):
                        e = self.out[x][at[x]]
                        if self.cap[e] > 0 and level.get(self.to[e]) == level[x] + 1:
                            break
                        at[x] += 1
                    if at[x] < len(self.out[x]):
                        path.append(self.out[x][at[x]])
                        x = self.to[path[-1]]
                    elif path:
                        x = self.to[path.pop() ^ 1]
                        at[x] += 1
                    else:
                        break
                if x != t:
                    break
                amount = min(self.cap[e] for e in path)
                for e in path:
                    self.cap[e] -= amount
                    self.cap[e ^ 1] += amount


def route(patterns: list[tuple[tuple, int]], extra: dict, quota: dict) -> tuple[dict, dict]:
    """Tokens per (pattern index, source) and per source's extra copies.

    Passes open one after the other, cheapest first; augmenting never takes
    flow back from a pattern, so the result has minimum cost."""
    names = sorted(quota, key=lambda s: (s is None, s or ""))
    node = {s: i + 2 for i, s in enumerate(names)}
    first = 2 + len(names)
    net = _Flow(first + len(patterns))
    for s in names:
        net.arc(node[s], 1, quota[s])
    inflow, arcs = [], []
    for i, (members, size) in enumerate(patterns):
        inflow.append(net.arc(0, first + i, 0))
        for s in members:
            arcs.append((i, s, net.arc(first + i, node[s], MOST * size)))
    longest = max((len(m) for m, _ in patterns), default=0)
    for level in range(MOST * longest):
        for i, (members, size) in enumerate(patterns):
            if level < MOST * len(members):
                net.cap[inflow[i]] += size
        net.push(0, 1)
    got = {(i, s): net.cap[e ^ 1] for i, s, e in arcs if net.cap[e ^ 1] > 0}
    had = {s: 0 for s in names}
    for (_, s), f in got.items():
        had[s] += f
    return got, {s: min(MOST * extra.get(s, 0), quota[s] - had[s]) for s in names if quota[s] > had[s]}


def mix_sources(docs: DataFrame, seed: int = SEED, max_patterns: int | None = None, weights=WEIGHTS,
                budget: float = BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` per row of ``docs``.

    ``max_patterns`` (none unless asked for) splits all but the largest patterns
    into one per source, which changes where repeats fall, never how much a
    source takes."""
    spark = docs.sparkSession
    T.prepare(spark)
    text, source = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("source").cast("string")
    rows = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), source.alias("source"),
        F.size(T.words_of(text)).cast("bigint").alias("size"), F.md5(text.cast("binary")).alias("g")), "sizes")
    sizes = [(r["source"], r["s"]) for r in rows.groupBy("source").agg(F.sum("size").alias("s")).collect()]
    target = targets(sizes, weights, budget)
    table = spark.createDataFrame([(s, int(n), float(target[s])) for s, n in sizes],
                                  "source string, source_size bigint, target double")
    mark = F.col("source").isNull()
    # a unit: the rows of one id, source and text; ``c`` of them
    units = rows.filter("size > 0").groupBy("g", "source", "doc_id").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("c"))
    lead = units.groupBy("g", F.col("source").alias("s2")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id")).alias("lead"))
    units = written(units.join(lead, "g").filter(F.col("source").eqNullSafe(F.col("s2"))).select(
        "g", "source", "doc_id", "size", "c", F.col("doc_id").eqNullSafe(F.col("lead.doc_id")).alias("lead")), "units")
    # one row of a text's first unit in a source is its first copy there, all other rows are further copies
    copies = units.withColumn("more", F.col("c") - F.col("lead").cast("int")).filter("more > 0")
    member = F.struct(mark.alias("x"), "source")
    groups = written(units.filter("lead").groupBy("g").agg(F.sort_array(F.collect_set(member)).alias("p"),
                                                           F.max("size").alias("size")), "texts")
    if max_patterns is not None:
        order = F.struct((-F.col("size")).alias("s"), "name")
        top = groups.groupBy("p").agg(F.sum("size").alias("size"), F.min("g").alias("name")).orderBy(order).limit(max_patterns)
        groups = groups.join(top.select("p", F.lit(True).alias("whole")), "p", "left").withColumn(
            "p", F.explode(F.when(F.col("whole"), F.array("p")).otherwise(F.transform("p", lambda m: F.array(m))))).drop("whole")
        groups = written(groups, "split-texts")
    kinds = groups.groupBy("p").agg(F.sum("size").alias("size"), F.min("g").alias("name")).orderBy(F.desc("size"), "name")
    patterns = [(tuple(m["source"] for m in r["p"]), int(r["size"])) for r in kinds.collect()]
    extra = {r["source"]: int(r["s"]) for r in copies.groupBy("source").agg(
        F.sum(F.col("size") * F.col("more")).alias("s")).collect()}
    flow, more = route(patterns, extra, {s: int(target[s]) for s, _ in sizes})

    # stretches of each pattern's line: (pattern, source, from, to)
    def by_name(s):
        return s is None, s or ""
    stretches, at = [], {}
    for (i, s), f in sorted(flow.items(), key=lambda r: (r[0][0], *by_name(r[0][1]))):
        stretches.append((i, s, at.get(i, 0), at.get(i, 0) + f, patterns[i][1]))
        at[i] = at.get(i, 0) + f
    last_resort = {s: len(patterns) + j for j, s in enumerate(sorted(more, key=by_name))}
    stretches += [(i, s, 0, more[s], extra[s]) for s, i in last_resort.items() if more[s] > 0]
    reach = spark.createDataFrame(stretches, "pattern int, source string, a bigint, b bigint, u bigint")
    lines = spark.createDataFrame(list(last_resort.items()), "source string, pattern int")
    listed = spark.createDataFrame([([{"x": s is None, "source": s} for s in p], i) for i, (p, _) in enumerate(patterns)],
                                   "p array<struct<x:boolean,source:string>>, pattern int")
    # texts on their pattern's line; further copies, a unit's together, on their source's line
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    whole = groups.join(listed, "p").select("g", "pattern", "size", F.lit(None).cast("string").alias("doc"))
    others = copies.join(lines, copies["source"].eqNullSafe(lines["source"])).select(
        "g", "pattern", (F.col("size") * F.col("more")).alias("size"), doc.alias("doc"))
    items = whole.union(others)
    spot = F.xxhash64(F.lit(seed), "pattern", "g", "doc")
    items = items.withColumn("spot", spot).withColumn("bucket", F.pmod("spot", F.lit(buckets)))
    sums = items.groupBy("pattern", "bucket").agg(F.sum("size").alias("s"))
    before = sums.withColumn("base", F.sum("s").over(
        Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("pattern", "bucket").orderBy("spot", "g", "doc").rowsBetween(Window.unboundedPreceding, -1)
    placed = (items.withColumn("inside", F.sum("size").over(inner))
              .join(before.select("pattern", "bucket", "base"), ["pattern", "bucket"])
              .select("g", "doc", "pattern", "size", (F.coalesce("base", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("x")))

    # words of [x, x + size) within [a, b) on a line that repeats every u words
    def covered(until):
        turns = F.expr(f"{until} div u")
        return turns * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col(until) - turns * F.col("u") - F.col("x")))
    drawn = (placed.join(reach, "pattern").withColumn("n", covered("b") - covered("a")).filter("n > 0")
             .select("g", F.col("source").alias("s2"), F.col("doc").alias("d2"), "n"))
    # what a unit takes: of its text's line, if it leads there, and of its source's further copies
    none = F.lit(None).cast("string")
    named = units.select("g", "source", "doc_id", "c", F.explode(
        F.when(F.col("lead"), F.array(none, doc)).otherwise(F.array(doc))).alias("name"))
    taken = named.join(drawn, "g").filter(F.col("source").eqNullSafe(F.col("s2")) & F.col("name").eqNullSafe(F.col("d2"))) \
        .groupBy("g", F.col("source").alias("s3"), F.col("doc_id").alias("id3")).agg(F.max("c").alias("c"), F.sum("n").alias("n"))
    uneven = taken.filter("c > 1 and n % c > 0")
    of_unit = (F.col("g") == F.col("g3")) & F.col("source").eqNullSafe(F.col("s3")) & F.col("doc_id").eqNullSafe(F.col("id3"))
    taken = taken.withColumnRenamed("g", "g3")
    each = rows.withColumn("u", place())
    # the rows of a unit that take one word more, where its words do not divide
    odd = uneven.withColumnRenamed("g", "g3")
    dealt = numbered_within(each.join(odd, of_unit).select("g3", "s3", "id3", "u", F.expr("n % c").alias("over")),
                            ["g3", "s3", "id3"], ["u"], "nth").filter("nth <= over").select(F.col("u").alias("u1"))
    out = (each.join(taken, of_unit, "left").join(dealt, F.col("u") == F.col("u1"), "left")
           .select("doc_id", "source", "size", (F.coalesce(F.expr("n div c"), F.lit(0)) + F.when(
               F.col("u1").isNull(), F.lit(0)).otherwise(F.lit(1))).cast("bigint").alias("taken")))
    return (out.join(table.withColumnRenamed("source", "s4"), out["source"].eqNullSafe(F.col("s4")))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))
