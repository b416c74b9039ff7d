"""Operator 3: quality rules and robust multivariate outliers.

Base rules fail a document of fewer than 50 words, or with more than half of
its words in repeated 3-word windows.  All others are held against a
minimum-covariance-determinant (MCD) estimate of their language and source:
five transformed statistics (length, word length, symbols, repeated words,
repeated lines) make a vector, and a vector whose squared Mahalanobis
distance exceeds ``cut`` is rejected.

The estimate starts from each group's medians and median deviations and takes
``steps`` concentration steps over *all* rows of the group: keep the
``COVERAGE`` of rows that are nearest to the current estimate, and estimate
again.  A step is a few partial aggregates: distances are counted in fine
logarithmic bins, the bin that completes the coverage is the limit, and sums of
products give mean and covariance.  A last step reweights: it estimates from
all rows within the cut.  No group is gathered; the hot group only adds counts.

Groups of fewer than ``MIN_ROWS`` rows are pooled by language, pools that are
still too small into one, and below ``MIN_ROWS`` rows in all nothing is
rejected.  Deviations have a floor per statistic, so a statistic that hardly
varies does not reject small differences.

Edge cases: null or blank text has no words and fails the base rules; null
language and source are values of their own; repeated rows count as often as
they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import written

MIN_WORDS = 50
STEPS = 5
COVERAGE = 0.75
CONSISTENCY = 1.41              # of a 75 % covariance in five dimensions, chi-square
CUT = 40.0                      # chi-square with five degrees of freedom: p about 1e-7
MIN_ROWS = 50
#: least standard deviation of each statistic; those of the three ratios are so small that each of them can reject
#: alone (at 40 % where a group has none), and a single symbol or repeated line does not
FLOORS = (0.6, 0.35, 0.1, 0.1, 0.1)
P = len(FLOORS)
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_BLANK = " \t\n\x0b\x0c\r"


def _code_points(arr: pa.Array) -> np.ndarray:
    return pc.utf8_length(arr).to_numpy(zero_copy_only=False).astype(np.int64)


def _symbols(arr: pa.Array) -> np.ndarray:
    _, offs, data = arr.buffers()
    bounds = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return T.sums(_SYMBOL[raw], bounds - bounds[0])


def repeat_words(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text in 3-word windows that it holds twice or more."""
    n = np.diff(bounds)
    total = len(words)
    if total < 3:
        return np.zeros(len(n), np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    h = T.mix(T.mix(T.mix(words[:-2]) + words[1:-1]) + words[2:])
    at = np.flatnonzero(doc[:-2] == doc[2:])
    h, d = h[at], doc[at]
    o = np.argsort(h, kind="stable")
    o = o[np.argsort(d[o], kind="stable")]
    eq = np.zeros(len(o), bool)
    eq[1:] = (h[o][1:] == h[o][:-1]) & (d[o][1:] == d[o][:-1])
    twice = eq.copy()
    twice[:-1] |= eq[1:]
    start = at[o[twice]]
    cover = np.zeros(total, bool)
    for j in range(3):
        cover[start + j] = True
    return T.sums(cover.astype(np.int64), bounds)


def _duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("g", pa.string()), ("lang", pa.string())]
                    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, arr in T.rows(batches):
        chars, n, rep = [], [], []
        for a, b in T.chunks(arr, 1 << 20):
            flat, bounds = T.split_words(arr.slice(a, b - a))
            chars.append(T.sums(_code_points(flat), bounds))
            rep.append(repeat_words(T.hash_words(flat), bounds))
            n.append(np.diff(bounds))
        texts = arr.to_pylist()
        cols = [np.concatenate(x) for x in (n, chars)] + [
            _symbols(arr), [_duplicate_lines(t) for t in texts], np.concatenate(rep), [t.count("\n") + 1 for t in texts]]
        yield pa.record_batch([*(batch.column(i) for i in range(3)), *(pa.array(c, pa.int64()) for c in cols)], schema=_SCHEMA)


def statistics(docs: DataFrame) -> DataFrame:
    """Written table of the counts of every row, with its group key."""
    key = F.to_json(F.struct(F.col("lang").cast("string").alias("l"), F.col("source").cast("string").alias("s")))
    lang = F.to_json(F.struct(F.col("lang").cast("string").alias("l")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("g"), lang.alias("lang"),
                       F.col("text").cast("string").alias("text"))
    ddl = "doc_id bigint, g string, lang string, " + ", ".join(f"{f.name} bigint" for f in list(_SCHEMA)[3:])
    return written(rows.mapInArrow(_measure, ddl), "statistics")


def _vector() -> list:
    n = F.col("n_words")
    return [F.log1p(n.cast("double")), F.col("word_chars") / n, F.sqrt(F.col("n_symbols") / n),
            F.sqrt(F.col("n_repeat_words") / n), F.sqrt(F.col("n_dup_lines") / F.col("n_lines"))]


def _with_groups(rows: DataFrame) -> DataFrame:
    """Pools groups that are too small: by language, then all of them, then none."""
    for name in ("lang", None):
        n = rows.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
        pool = F.concat(F.lit("pool"), F.col(name)) if name else F.lit("pool")
        rows = rows.join(n, "g").withColumn("g", F.when(F.col("m") >= MIN_ROWS, F.col("g")).otherwise(pool)).drop("m")
    n = rows.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
    return rows.join(n, "g").withColumn("g", F.when(F.col("m") >= MIN_ROWS, F.col("g"))).drop("m")


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median deviations per group, from counts in fine bins."""
    def median(df, value):
        bins = df.groupBy("g", "j", F.round(value * 200).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy("g", "j")
        run = bins.withColumn("run", F.sum("c").over(w.orderBy("bin"))).withColumn("all", F.sum("c").over(w))
        return run.filter("2 * run >= all").groupBy("g", "j").agg((F.min("bin") / 200).alias("m"))

    long = rows.filter("g is not null").select("g", F.posexplode("x").alias("j", "v"))
    mid = median(long, F.col("v"))
    dev = median(long.join(mid, ["g", "j"]), F.abs(F.col("v") - F.col("m"))).withColumnRenamed("m", "d")
    per = mid.join(dev, ["g", "j"]).groupBy("g").agg(F.sort_array(F.collect_list(F.struct("j", "m", "d"))).alias("s"))
    floors = F.array(*[F.lit(f) for f in FLOORS])
    inv = F.flatten(F.transform("s", lambda a: F.transform("s", lambda b: F.when(
        a["j"] == b["j"], 1 / F.pow(F.greatest(a["d"] * 1.4826, F.element_at(floors, a["j"] + 1)), F.lit(2.0))).otherwise(F.lit(0.0)))))
    return per.select("g", F.col("s.m").alias("mu"), inv.alias("inv"))


def _distance():
    d = [F.col("x")[i] - F.col("mu")[i] for i in range(P)]
    return sum((F.col("inv")[i * P + j] * d[i] * d[j] for i in range(P) for j in range(P)), F.lit(0.0))


def _inverses(consistency: float):
    schema = pa.schema([("g", pa.string()), ("mu", pa.list_(pa.float64())), ("inv", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mu = np.array(r["s"]) / r["m"]
                cov = (np.array(r["q"]).reshape(P, P) / r["m"] - np.outer(mu, mu)) * consistency
                diag = np.arange(P)
                cov[diag, diag] = np.maximum(cov[diag, diag], np.array(FLOORS) ** 2)
                # shrink correlations until the matrix is well conditioned
                off = cov - np.diag(cov[diag, diag])
                for share in (1.0, 0.9, 0.5, 0.0):
                    c = np.diag(cov[diag, diag]) + share * off
                    if np.linalg.eigvalsh(c / np.sqrt(np.outer(c[diag, diag], c[diag, diag])))[0] > 1e-3:
                        break
                out.append({"g": r["g"], "mu": mu.tolist(), "inv": np.linalg.inv(c).ravel().tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _estimate(chosen: DataFrame, consistency: float) -> DataFrame:
    sums = [F.sum(F.col("x")[i]) for i in range(P)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(P) for j in range(P)]
    agg = chosen.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.array(*sums).alias("s"), F.array(*products).alias("q"))
    return agg.mapInArrow(_inverses(consistency), "g string, mu array<double>, inv array<double>")


def estimates(rows: DataFrame, steps: int = STEPS, coverage: float = COVERAGE, cut: float = CUT) -> DataFrame:
    """Written ``(g, mu, inv)`` per group of ``rows`` (``g``, ``x``)."""
    rows = rows.filter("g is not null")
    model = written(_start(rows), "mcd")
    for _ in range(steps):
        near = rows.join(model, "g").withColumn("bin", F.floor(F.log(_distance() + 1e-6) * 32).cast("int"))
        bins = near.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy("g")
        limit = (bins.withColumn("run", F.sum("c").over(w.orderBy("bin"))).withColumn("all", F.sum("c").over(w))
                 .filter(F.col("run") >= F.col("all") * coverage).groupBy("g").agg(F.min("bin").alias("last")))
        model = written(_estimate(near.join(limit, "g").filter(F.col("bin") <= F.col("last")), CONSISTENCY), "mcd")
    inside = rows.join(model, "g").filter(_distance() <= cut)
    return written(_estimate(inside, 1.0), "mcd")


def judge(docs: DataFrame, steps: int = STEPS, coverage: float = COVERAGE, cut: float = CUT) -> DataFrame:
    """The counts of every row of ``docs`` with ``base_failed``, ``distance``
    (null where no estimate applies) and ``kept``."""
    T.prepare(docs.sparkSession)
    stats = statistics(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    vectors = _with_groups(stats.filter(~failed).select("g", "lang", F.array(*_vector()).alias("x")))
    vectors = written(vectors.select("g", "x"), "vectors")
    model = estimates(vectors, steps, coverage, cut)
    # the pool a group went to, from its counts
    sizes = stats.filter(~failed).groupBy("g", "lang").agg(F.count(F.lit(1)).alias("m"))
    pooled = sizes.withColumn("pool", F.when(F.col("m") >= MIN_ROWS, F.col("g")).otherwise(F.concat(F.lit("pool"), "lang")))
    by_pool = pooled.groupBy("pool").agg(F.sum("m").alias("pm"))
    pooled = pooled.join(by_pool, "pool").select("g", F.when(F.col("pm") >= MIN_ROWS, F.col("pool")).otherwise(F.lit("pool")).alias("pool"))
    out = (stats.withColumn("x", F.when(~failed, F.array(*_vector()))).join(pooled, "g", "left")
           .join(model.withColumnRenamed("g", "pool"), "pool", "left"))
    distance = F.when(F.col("x").isNotNull() & F.col("mu").isNotNull(), _distance())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), distance.alias("distance"),
                      (~failed & F.coalesce(distance <= cut, F.lit(True))).alias("kept"))
