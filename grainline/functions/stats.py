"""Distributed column statistics used by every fitted operator.

* ``exact_quantiles`` — exact linear-interpolated quantiles (pandas / numpy
  ``linear``, DuckDB ``quantile_cont``) without Spark's ``percentile``
  aggregate, whose buffer holds every distinct value of a column and merges
  them in one task.  Instead: a ``percentile_approx`` sketch (mergeable, fixed
  size) brackets each wanted rank, one counting pass verifies all brackets of
  all columns (binary search to a cell, one group-by), and only the values inside
  a bracket (at most ``collect_limit`` of them) are gathered.  Brackets that are still too wide are narrowed by another sketch
  pass over their rows only.  Every pass is a plain partial-then-final
  aggregate, so hot values cost nothing extra.
* ``column_modes`` — most frequent value, smallest on ties, via a partial
  ``groupBy(value).count()`` and a ``min(struct(-count, value))`` — never a
  per-group value map.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exprs import as_double, qcol


def approx_quantiles(df: DataFrame, columns: list[str], probs: list[float], *, accuracy: int = 10_000,
                     where=None, extra: dict | None = None, extra_out: dict | None = None):
    """One-pass ``percentile_approx`` quantiles (the ``approximate`` option)."""
    base = df if where is None else df.where(where)
    extra = extra or {}
    aggs = [F.percentile_approx(as_double(base, c), list(probs), accuracy).alias(f"q{i}")
            for i, c in enumerate(columns)]
    aggs += [e.alias(f"x_{name}") for name, e in extra.items()]
    row = base.agg(*aggs).first()
    if extra_out is not None:
        extra_out.update({name: row[f"x_{name}"] for name in extra})
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs))
            for i, c in enumerate(columns)}


def _columns_of(df: DataFrame, extra: dict) -> list[str]:
    """Source columns the extra aggregates may refer to (all, when any)."""
    return list(df.columns) if extra else []


def _needed_ranks(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    lo = int(math.floor(h))
    frac = h - lo
    hi = lo + 1 if frac > 0 and lo + 1 < n else lo
    return lo, hi, frac


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], *,
                    accuracy: int = 2_000, collect_limit: int = 50_000,
                    where=None, extra: dict | None = None,
                    extra_out: dict | None = None, approximate: bool = False) -> dict[str, list[float | None]]:
    """Exact quantiles of numeric ``columns`` at ``probs`` (NaN and null skipped).

    Returns ``{column: [q(p) for p in probs]}``; ``None`` for a column without
    values.  ``where`` optionally restricts the rows (a boolean Column).
    ``extra`` — ``{name: aggregate Column over df}`` — rides along in the first
    pass (saving the caller a job); the values land in ``extra_out``.
    ``approximate=True`` stops after the sketch (one pass, rank error below
    ``1/accuracy``; the values are data values, not interpolated).
    """
    if not columns:
        return {}
    if approximate:
        return approx_quantiles(df, columns, probs, accuracy=max(accuracy, 10_000), where=where,
                                extra=extra, extra_out=extra_out)
    base = df if where is None else df.where(where)
    extra = extra or {}
    base = base.select(*[as_double(base, c).alias(f"v{i}") for i, c in enumerate(columns)],
                       *[qcol(c) for c in _columns_of(df, extra)])
    v = {c: F.col(f"v{i}") for i, c in enumerate(columns)}

    # pass 1: sizes, extremes and one mergeable sketch per column
    eps = 3.0 / accuracy
    probes = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-eps, eps)})
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(v[c]).alias(f"n{i}"), F.min(v[c]).alias(f"mn{i}"),
                 F.max(v[c]).alias(f"mx{i}"),
                 F.percentile_approx(v[c], probes, accuracy).alias(f"pa{i}")]
    aggs += [e.alias(f"x_{name}") for name, e in extra.items()]
    row = base.agg(*aggs).first()
    if extra_out is not None:
        extra_out.update({name: row[f"x_{name}"] for name in extra})

    out: dict[str, list[float | None]] = {}
    known: dict[tuple[str, int], float] = {}
    pending: dict[tuple[str, int], dict] = {}
    plan = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if not n:
            out[c] = [None] * len(probs)
            continue
        sketch = dict(zip(probes, row[f"pa{i}"]))
        plan[c] = []
        for p in probs:
            lo_r, hi_r, frac = _needed_ranks(n, p)
            plan[c].append((lo_r, hi_r, frac))
            for r in (lo_r, hi_r):
                if r == 0:
                    known[(c, r)] = float(row[f"mn{i}"])
                elif r == n - 1:
                    known[(c, r)] = float(row[f"mx{i}"])
                elif (c, r) not in pending:
                    lo_p = min(1.0, max(0.0, p - eps))
                    hi_p = min(1.0, max(0.0, p + eps))
                    pending[(c, r)] = {"n": n, "lo": sketch[lo_p] if p - eps > 0 else None,
                                       "hi": sketch[hi_p] if p + eps < 1 else None}
    known.update(_resolve(base, v, pending, accuracy, collect_limit))
    for c, ranks in plan.items():
        res = []
        for lo_r, hi_r, frac in ranks:
            lo_v, hi_v = known[(c, lo_r)], known[(c, hi_r)]
            res.append(lo_v if hi_r == lo_r else lo_v + (hi_v - lo_v) * frac)
        out[c] = res
    return out


_WIDE = 1 << 16                 # cells of a column are numbered below this


def _between(col, t):
    """Values strictly inside a bracket."""
    cond = F.lit(True)
    if t["lo"] is not None:
        cond = cond & (col > F.lit(t["lo"]))
    if t["hi"] is not None:
        cond = cond & (col < F.lit(t["hi"]))
    return F.when(cond, col)


def _cell(value, edges: list[float]):
    """Where a value lies among ascending edges: ``2 i + 1`` on edge ``i``, ``2 i``
    before it; found by binary search in one expression."""
    def search(lo: int, hi: int):
        if lo > hi:
            return F.lit(2 * lo)
        mid = (lo + hi) // 2
        return (F.when(value < F.lit(edges[mid]), search(lo, mid - 1))
                .when(value == F.lit(edges[mid]), F.lit(2 * mid + 1)).otherwise(search(mid + 1, hi)))
    return search(0, len(edges) - 1)


def _cell_counts(base, v, edges: dict[str, list[float]], inside: dict[str, set[int]]) -> tuple[dict, dict]:
    """Rows per cell of every column, and the distinct values (with their counts)
    of the cells listed in ``inside``, from one scan and one group-by."""
    cols = list(edges)
    cells = [F.when(v[c].isNotNull(), _cell(v[c], edges[c])) for c in cols]
    spots = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), cell.alias("cell"), v[c].alias("v"))
                                for i, (c, cell) in enumerate(zip(cols, cells))])).alias("s")
    rows = base.select(spots).select("s.k", "s.cell", "s.v")
    wanted = [i * _WIDE + cell for i, c in enumerate(cols) for cell in inside.get(c, ())]
    if wanted:
        rows = rows.withColumn("v", F.when((F.col("k") * _WIDE + F.col("cell")).isin(wanted), F.col("v")))
        counted = rows.groupBy("k", "cell", "v").agg(F.count(F.lit(1)).alias("n"))
    else:
        counted = rows.groupBy("k", "cell").agg(F.count(F.lit(1)).alias("n"))
    out = {c: [0] * (2 * len(edges[c]) + 1) for c in cols}
    values: dict[str, list[tuple[float, int]]] = {c: [] for c in cols}
    for r in counted.collect():                   # a row per column and cell, and per value of the listed cells
        if r["cell"] is None:
            continue
        c = cols[r["k"]]
        out[c][r["cell"]] += r["n"]
        if wanted and r["v"] is not None:
            values[c].append((r["v"], r["n"]))
    return out, {c: sorted(x) for c, x in values.items()}


def _inside_values(base, v, brackets: list[tuple[str, dict]]) -> list[list[tuple[float, int]]]:
    """Distinct values strictly inside each bracket with their counts, ascending."""
    cols = list(dict.fromkeys(c for c, _ in brackets))
    kept = []
    for i, c in enumerate(cols):
        inside = F.lit(False)
        for _, t in (x for x in brackets if x[0] == c):
            inside = inside | _between(v[c], t).isNotNull()
        kept.append(F.when(inside, F.struct(F.lit(i).alias("k"), v[c].alias("v"))))
    rows = (base.select(F.explode(F.array_compact(F.array(*kept))).alias("s")).groupBy("s.k", "s.v")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    found = {c: sorted((r["v"], r["n"]) for r in rows if r["k"] == i) for i, c in enumerate(cols)}
    return [[(x, n) for x, n in found[c] if (t["lo"] is None or x > t["lo"]) and (t["hi"] is None or x < t["hi"])]
            for c, t in brackets]


def _nth(values: list[tuple[float, int]], at: int) -> float:
    """The value at a position of the ascending ``(value, count)`` pairs."""
    for x, n in values:
        if at < n:
            return float(x)
        at -= n
    raise AssertionError("fewer values than counted")


def _resolve(base, v, pending, accuracy, collect_limit):
    """Turn rank brackets ``{(column, rank): {n, lo, hi}}`` into exact values.

    A missing end (``None``) means unbounded.  Each round: the ends of all
    brackets of a column are its edges; one scan finds the cell of every value
    (binary search) and counts per column and cell, at every size and for any
    number of columns.  A rank that falls on an end is done, a bracket the sketch
    missed is opened on that side, brackets with few values inside are gathered
    (at most ``collect_limit`` values a job over all brackets), and wide ones get
    a finer sketch over the values strictly inside, so heavy values at the ends
    cannot come back.  In the first round a bracket holds ``8 / accuracy`` of the rows
    at most, by the sketch's error bound; where all of them together stay within
    ``collect_limit``, their values come with the counts, in the same pass.
    """
    done = {}
    eps = 3.0 / accuracy
    first = True
    while pending:
        edges: dict[str, set] = {}
        for (c, _), t in pending.items():
            edges.setdefault(c, set()).update(x for x in (t["lo"], t["hi"]) if x is not None)
        ends = {c: sorted(e) for c, e in edges.items()}
        at_edge = {c: {x: 2 * i + 1 for i, x in enumerate(e)} for c, e in ends.items()}
        inside_cells: dict[str, set[int]] = {}
        if first and sum(8 * t["n"] / accuracy + 1 for t in pending.values()) <= collect_limit:
            for (c, _), t in pending.items():
                if t["lo"] is not None and t["hi"] is not None:
                    inside_cells.setdefault(c, set()).update(range(at_edge[c][t["lo"]] + 1, at_edge[c][t["hi"]]))
        first = False
        cells, met = _cell_counts(base, v, ends, inside_cells)
        gather, narrow = [], []
        for key, t in pending.items():
            c, rank = key
            n = cells[c]
            low = at_edge[c][t["lo"]] if t["lo"] is not None else -1
            high = at_edge[c][t["hi"]] if t["hi"] is not None else len(n)
            on_low, on_high = (n[low] if low >= 0 else 0), (n[high] if low < high < len(n) else 0)
            inside = sum(n[low + 1:high])
            at = rank - sum(n[:max(low, 0)])
            if at < 0:                                      # low end above the rank: open it
                t["lo"] = None
            elif at < on_low:
                done[key] = float(t["lo"])
            elif at - on_low < inside:
                t["at"], t["size"] = at - on_low, inside
                if t["lo"] is not None and t["hi"] is not None and low + 1 in inside_cells.get(c, ()):
                    done[key] = _nth([x for x in met[c] if t["lo"] < x[0] < t["hi"]], t["at"])
                    continue
                (gather if t["size"] <= collect_limit else narrow).append(key)
            elif at - on_low - inside < on_high:
                done[key] = float(t["hi"])
            else:                                           # high end below the rank: open it
                t["hi"] = None
        while gather:
            some, total = [], 0
            while gather and (not some or total + pending[gather[0]]["size"] <= collect_limit):
                total += pending[gather[0]]["size"]
                some.append(gather.pop(0))
            for key, values in zip(some, _inside_values(base, v, [(c, pending[(c, r)]) for c, r in some])):
                done[key] = _nth(values, pending[key]["at"])
        if narrow:
            aggs = []
            for j, (c, r) in enumerate(narrow):
                t = pending[(c, r)]
                q = t["at"] / max(t["size"] - 1, 1)
                pr = [min(1.0, max(0.0, q - eps)), min(1.0, max(0.0, q + eps))]
                aggs.append(F.percentile_approx(_between(v[c], t), pr, accuracy).alias(f"p{j}"))
            row = base.agg(*aggs).first()
            for j, key in enumerate(narrow):
                pending[key]["lo"], pending[key]["hi"] = row[f"p{j}"]
        for key in list(pending):
            if key in done:
                del pending[key]
    return done


def column_modes(df: DataFrame, columns: list[str], distinct_out: dict | None = None) -> dict[str, object]:
    """Most frequent non-null value per column, smallest value on ties.

    Columns of one type family are stacked into ``(column, value)`` rows and
    counted by one partial aggregation (combined map-side, so a value holding a
    third of the table is one row per task before the shuffle); then one
    ``min(struct(-count, value))`` per column over the distinct values (the
    number of distinct values per column comes with it: ``distinct_out``).  Text
    columns, integer columns and floating columns (NaN counts as missing) each take
    one job; other types keep their own type, one job each.
    """
    from pyspark.sql import types as T
    families: dict[str, list[str]] = {}
    for c in columns:
        dt = df.schema[c].dataType
        if isinstance(dt, T.StringType):
            families.setdefault("string", []).append(c)
        elif isinstance(dt, T.IntegralType):
            families.setdefault("bigint", []).append(c)
        elif isinstance(dt, (T.FloatType, T.DoubleType)):
            families.setdefault("double", []).append(c)
        else:
            families.setdefault(f"own:{c}", []).append(c)
    out = {}
    for fam, cols in families.items():
        cast = (lambda c: qcol(c)) if fam.startswith("own:") else (lambda c, t=fam: qcol(c).cast(t))
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), cast(c).alias("v"))
                                    for i, c in enumerate(cols)])).alias("p")
        present = F.col("v").isNotNull() & (~F.isnan("v") if fam == "double" else F.lit(True))
        counted = (df.select(pairs).select("p.k", "p.v").where(present)
                   .groupBy("k", "v").agg(F.count(F.lit(1)).alias("cnt")))
        best = counted.groupBy("k").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("v"))).alias("m"),
                                        F.count(F.lit(1)).alias("d"))
        rows = best.collect()                                       # one row per column
        found = {r["k"]: r["m"]["v"] for r in rows}
        if distinct_out is not None:
            distinct_out.update({cols[r["k"]]: r["d"] for r in rows})
        for i, c in enumerate(cols):
            v = found.get(i)
            out[c] = v
    return out
