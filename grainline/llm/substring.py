"""Operator 5: substring dedup by recompression.

Removes every word covered by a window of ``width`` consecutive words whose
sequence also starts earlier (smaller ``doc_id``, or same document, earlier
start); windows are judged on the input.

* **Recompression.**  Words are symbols of level 0.  Each round first names
  maximal runs of one symbol, then pairs ``ab`` where a coin drawn from the
  symbol's name calls ``a`` left and ``b`` right.  Names are 64-bit hashes of what they
  stand for, so equal substrings get equal names in every task without a
  dictionary; only symbols at a substring's border can differ.  With every
  symbol goes the extent of words that fixes its parse.
* **Shared symbols.**  A window's key is the longest symbol (ties: largest
  name, then leftmost) of any round whose extent, of at most ``REACH`` words,
  lies inside it.  Equal windows have equal keys.  Neighbouring windows with the
  same occurrence are one row, with a hash of all words they cover.
* **Verification.**  Spark sorts the rows by key and age.  A row that equals the
  earliest of its key in all its words is a repeat for certain; rows that differ
  from it, and that earliest one, are then compared window by window in the same
  way.  Hashes are of 64 bits, and as many again for whole rows.
* **Hot keys.**  Each batch settles its own rows first: equal ones are repeats, and where
  a key has more than ``FORMS`` forms they are looked at without meeting the others.  So a
  batch sends at most ``FORMS`` rows to the task that decides on a key, however often it occurs;
  decided rows are dealt evenly.

Texts are shuffled once; key search, verification and removal read the same
partitioning.

Edge cases: null or blank text has no words (hash of the empty text); texts
shorter than a window lose nothing; null ids come after all others, ordered by
row key (64 bits of id and text); rows of equal id and text are one document
and are judged alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

WIDTH = 20
ROUNDS = 3
REACH = 6                      # longest extent, in words, of a symbol that may serve as a key
TILE = 200_000
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_HASH_BITS = np.uint64(58)


def window_keys(words: np.ndarray, doc: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS,
                reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """Key of the window that starts at each word, and where the symbol
    occurrence behind the key lies.

    Only meaningful where the whole window lies in one document."""
    n = len(words)
    sym, lo, hi = words, np.arange(n), np.arange(1, n + 1)      # extent of the parse
    b, e = lo, hi                                               # words the symbol stands for
    at, length, rank = [lo], [np.ones(n, np.int64)], [(words >> np.uint64(6)) | (np.uint64(1) << _HASH_BITS)]
    far = np.int64(1) << np.int64(40)
    for r in range(rounds):
        # runs; a run's parse depends on both neighbours
        d = doc[b]
        head = np.ones(len(sym), bool)
        head[1:] = (sym[1:] != sym[:-1]) | (d[1:] != d[:-1])
        first = np.flatnonzero(head)
        last = np.r_[first[1:], len(sym)] - 1
        times = (last - first + 1).astype(np.uint64)
        left, right = np.maximum(first - 1, 0), np.minimum(last + 1, len(sym) - 1)
        lo2 = np.where((first > 0) & (d[left] == d[first]), lo[left], lo[first] - far)
        hi2 = np.where((last < len(sym) - 1) & (d[right] == d[last]), hi[right], hi[last] + far)
        name = np.where(times > 1, T.mix(sym[first] ^ T.mix(times + np.uint64(7))), sym[first])
        sym, lo, hi, b, e = name, lo2, hi2, b[first], e[last]
        # pairs: a left symbol and a right one after it
        d = doc[b]
        side = (T.mix(sym + np.uint64(1000 + r)) & np.uint64(1)).astype(bool)      # True: right
        joins = np.zeros(len(sym), bool)
        joins[:-1] = ~side[:-1] & side[1:] & (d[1:] == d[:-1])
        second = np.zeros(len(sym), bool)
        second[1:] = joins[:-1]
        nxt, prv = np.minimum(np.arange(len(sym)) + 1, len(sym) - 1), np.maximum(np.arange(len(sym)) - 1, 0)
        alone_lo = np.where(side, np.where((prv < np.arange(len(sym))) & (d[prv] == d), np.minimum(lo, lo[prv]), lo - far), lo)
        alone_hi = np.where(side, hi, np.where((nxt > np.arange(len(sym))) & (d[nxt] == d), np.maximum(hi, hi[nxt]), hi + far))
        name = np.where(joins, T.mix(T.mix(sym) + sym[nxt] * _P), sym)
        lo = np.where(joins, np.minimum(lo, lo[nxt]), alone_lo)[~second]
        hi = np.where(joins, np.maximum(hi, hi[nxt]), alone_hi)[~second]
        e = np.where(joins, e[nxt], e)[~second]
        sym, b = name[~second], b[~second]
        ok = hi - lo <= reach
        at.append(lo[ok])
        length.append((hi - lo)[ok])
        rank.append((sym[ok] >> np.uint64(6)) | (np.minimum(e - b, 60)[ok].astype(np.uint64) << _HASH_BITS))
    at, length, rank = np.concatenate(at), np.concatenate(length), np.concatenate(rank)
    by_length = np.argsort(length.astype(np.uint8), kind="stable")
    cuts = np.searchsorted(length[by_length], np.arange(1, reach + 2))
    best, pick = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for w in range(1, width + 1):               # best symbol within w words; equal ones: the leftmost
        if w > 1:
            later = best[1:] > best[:-1]
            best[:-1] = np.where(later, best[1:], best[:-1])
            pick[:-1] = np.where(later, pick[1:], pick[:-1])
        if w <= reach:
            own = by_length[cuts[w - 1]:cuts[w]]
            before = best[at[own]]
            np.maximum.at(best, at[own], rank[own])
            won = own[(rank[own] == best[at[own]]) & (rank[own] >= before)][::-1]
            pick[at[won]] = won
    # an occurrence's key: its name and all words of its extent
    powers, back = _powers(n)
    run = np.r_[np.uint64(0), np.cumsum(T.mix(words) * powers[:n], dtype=np.uint64)]
    span = T.mix((run[at + length] - run[at]) * back[at]) ^ T.mix(rank + length.astype(np.uint64))
    return span[pick], at[pick]


def _tiled_keys(words: np.ndarray, doc: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """``window_keys`` by tiles; a window's key depends on its own words only."""
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a in range(0, len(words), TILE):
        b, m = min(a + TILE + width - 1, len(words)), min(TILE, len(words) - a)
        k, at = window_keys(words[a:b], doc[a:b], width, rounds)
        keys.append(k[:m])
        places.append(at[:m] + a)
    return np.concatenate(keys), np.concatenate(places)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.cumprod(np.r_[np.uint64(1), np.full(n, _P)], dtype=np.uint64),
            np.cumprod(np.r_[np.uint64(1), np.full(n, _P_INV)], dtype=np.uint64))


def _slice_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of ``words[first:last]`` for each pair."""
    powers, back = _powers(len(words))
    run = np.r_[np.uint64(0), np.cumsum(T.mix(words) * powers[:-1], dtype=np.uint64)]
    return T.mix((run[last] - run[first]) * back[first] + (last - first).astype(np.uint64))


def _stretches(full: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of neighbouring windows with one symbol occurrence."""
    at = np.flatnonzero(full)
    if not len(at):
        return at, at
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (place[at[1:]] != place[at[:-1]]) | (key[at[1:]] != key[at[:-1]])
    first = np.flatnonzero(cut)
    return at[first], at[np.r_[first[1:], len(at)] - 1]


# spot: first window << 16 | number of windows after it << 2 | state
_ROW = f"key bigint, body bigint, {T.K1} bigint, doc_id bigint, spot bigint"
_SCHEMA = pa.schema([("key", pa.int64()), ("body", pa.int64()), (T.K1, pa.int64()), ("doc_id", pa.int64()), ("spot", pa.int64())])
# to be decided; a repeat for certain; to be compared window by window; the first of rows that differ
OPEN, GONE, LOOK, MIXED = 0, 1, 2, 3
MAX_WIDTH = 1 << 14
FORMS = 8                       # differing rows of one key that a batch sends on undecided; any number gives the same result


def _ranks(batch: pa.RecordBatch) -> np.ndarray:
    """Rank of each row of a batch in the order that decides who is earlier."""
    k1, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, k1[i]))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    return rank


def _rows_out(batch, ids, key, body, lo, more, state):
    pick = pa.array(ids)
    spot = (lo.astype(np.int64) << 16) | (more.astype(np.int64) << 2) | state
    for a in range(0, len(lo), 100_000):
        s = slice(a, a + 100_000)
        yield pa.record_batch([pa.array(T.signed(key[s])), pa.array(T.signed(body[s])),
                               *(batch.column(i).take(pick[s]) for i in range(2)), pa.array(spot[s])], schema=_SCHEMA)


def _settled(batch, ids, key, body, lo, more, forms):
    """Rows of one batch, equal keys compared within the batch.

    Whatever equals an earlier row of its key and body is a repeat for certain;
    the earliest row of each form is left open.  A key of more than ``forms`` forms
    is known to have rows that differ: they need not meet the others of the key to
    be looked at, and only the earliest stays undecided (``MIXED``).  A row again,
    from a repeated row of the table, goes."""
    rank = _ranks(batch)
    k1 = batch.column(0).to_numpy(zero_copy_only=False)
    o = np.lexsort((lo, rank[ids], body, key))
    ids, key, body, lo, more = ids[o], key[o], body[o], lo[o], more[o]
    head = np.ones(len(key), bool)
    head[1:] = (key[1:] != key[:-1]) | (body[1:] != body[:-1])
    first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(key) else np.zeros(0, np.int64)
    state = np.where(head, OPEN, GONE)
    own = head | (k1[ids] != k1[ids[first]]) | (lo != lo[first])
    at = np.flatnonzero(head)
    cut = np.ones(len(at), bool)
    cut[1:] = key[at[1:]] != key[at[:-1]]
    group = np.cumsum(cut) - 1
    many = np.bincount(group)[group] > forms if len(at) else cut
    eldest = np.zeros(len(at), bool)
    eldest[np.lexsort((lo[at], rank[ids[at]], group))[cut]] = True
    state[at[many]] = np.where(eldest[many], MIXED, LOOK)
    yield from _rows_out(batch, *(c[own] for c in (ids, key, body, lo, more, state)))


def _search(width: int, rounds: int, forms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bodies, ids, los, more, base = [], [], [], [], [], 0
            for part, arr in T.rows([batch]):
                words, bounds = T.hashed_words(arr)
                n = np.diff(bounds)
                doc = np.repeat(np.arange(len(n)), n)
                full = (np.arange(len(words)) - bounds[:-1][doc] + width) <= n[doc]
                key, place = _tiled_keys(words, doc, width, rounds)
                a, b = _stretches(full, place, key)
                keys.append(key[a])
                # equal bodies: all words of the stretch are equal, and the symbol lies at the same place in them
                bodies.append(T.mix(_slice_hashes(words, a, b + width) ^ (place[a] - a).astype(np.uint64)))
                ids.append(doc[a] + base)
                los.append(a - bounds[:-1][doc[a]])
                more.append(b - a)
                base += len(n)
            yield from _settled(batch, *map(np.concatenate, (ids, keys, bodies, los, more)), forms)

    return run


def _decide(loose: int):
    """Streams rows sorted by key and age.  Rows equal to the first of their key
    are repeats; the others, and then the first as well, leave as ``loose``; so does
    the first of a key with a ``MIXED`` row.  The first row again (same document,
    same place) is no repeat of itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, None                 # current key; its first row, until it has left
        body = row = place = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k, b, k1, spot = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            lo, state = spot >> 16, spot & 3
            out = (state == GONE) | (state == LOOK)
            open_ = np.flatnonzero(~out)
            if len(open_):
                ko, bo, ro, po = k[open_], b[open_], k1[open_], lo[open_]
                head = np.ones(len(open_), bool)
                head[1:] = ko[1:] != ko[:-1]
                head[0] = key is None or key != ko[0]
                group = np.cumsum(head)             # 0: goes on from the batch before
                lead = np.flatnonzero(head)
                fb, fr, fp = (np.r_[0 if old is None else old, new[lead]][group] for old, new in ((body, bo), (row, ro), (place, po)))
                other = ~head & ((ro != fr) | (po != fp))
                equal = other & (bo == fb)
                differ = other & ~equal
                mixed = np.unique(group[differ | (state[open_] == MIXED)])
                state[open_[equal]] = GONE
                state[open_[differ]] = loose
                out[open_[equal | differ]] = True
                if len(mixed) and mixed[0] == 0 and first is not None:
                    yield _with_state(first, np.array([loose]))
                    first = None
                leads = open_[lead[mixed[mixed > 0] - 1]]
                state[leads] = loose
                out[leads] = True
                if len(lead):
                    at = open_[lead[-1]]
                    key, body, row, place = ko[-1], bo[lead[-1]], ro[lead[-1]], po[lead[-1]]
                    first = None if out[at] else batch.slice(at, 1)
            if out.any():
                yield _with_state(batch, state).filter(pa.array(out))

    return run


def _with_state(batch: pa.RecordBatch, state: np.ndarray) -> pa.RecordBatch:
    spot = batch.column(4).to_numpy(zero_copy_only=False)
    return batch.set_column(4, "spot", pa.array((spot & ~np.int64(3)) | state))


def _sorted(rows: DataFrame) -> DataFrame:
    """Open rows dealt by key, decided ones evenly; sorted by key and age."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, F.when(_state().isin(GONE, LOOK), F.xxhash64(T.K1, "spot")).otherwise(F.col("key")))
            .sortWithinPartitions("key", F.col("doc_id").asc_nulls_last(), T.K1, "spot"))


def _state():
    return F.col("spot").bitwiseAND(F.lit(3))


def _range():
    """First and last window of a row, as a struct."""
    lo = F.shiftright("spot", 16).cast("int")
    return F.struct(lo.alias("lo"), (lo + F.shiftright("spot", 2).bitwiseAND(F.lit(MAX_WIDTH - 1)).cast("int")).alias("hi"))


def _ranges(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row index, ``lo`` and ``hi`` of a batch's list of ranges."""
    col = batch.column(batch.schema.get_field_index(name))
    n = np.array([len(x) if x is not None else 0 for x in col.to_pylist()], np.int64) if col.null_count else \
        np.diff(col.offsets.to_numpy())
    flat = col.flatten()
    return np.repeat(np.arange(len(n)), n), flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)


def _marked(row, lo, hi, start, total) -> np.ndarray:
    """Boolean over all words, true in ``[start[row] + lo, start[row] + hi)``."""
    delta = np.zeros(total + 1, np.int64)
    np.add.at(delta, start[row] + lo, 1)
    np.add.at(delta, start[row] + hi, -1)
    return np.cumsum(delta[:-1]) > 0


def _verify(width: int):
    """Windows of the ranges to look at, as rows keyed by all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, pos, base = [], [], [], 0
            for part, arr in T.rows([batch]):
                words, bounds = T.hashed_words(arr)
                row, lo, hi = _ranges(part, "ranges")
                near = _marked(row, lo, hi + 1, bounds[:-1], len(words))
                doc = np.repeat(np.arange(len(arr)), np.diff(bounds))
                at = np.flatnonzero(near)
                keys.append(_slice_hashes(words, at, at + width))
                ids.append(doc[at] + base)
                pos.append(at - bounds[:-1][doc[at]])
                base += len(arr)
            key, ids, pos = map(np.concatenate, (keys, ids, pos))
            none = np.zeros(len(key), np.uint64)
            yield from _settled(batch, ids, key, none, pos, none, FORMS)

    return run


_OUT = pa.schema([(T.K1, pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                  ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])


def _apply(width: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, arr in T.rows([batch]):
                row, lo, hi = _ranges(part, "gone")
                cuts = np.searchsorted(row, np.arange(len(arr) + 1))
                out = []
                for i, text in enumerate(arr.cast(pa.large_binary()).to_pylist()):
                    words = text.split()
                    n = len(words)
                    if cuts[i] < cuts[i + 1]:
                        s = slice(cuts[i], cuts[i + 1])
                        gone = _marked(np.zeros(s.stop - s.start, np.int64), lo[s], hi[s] + width, np.zeros(1, np.int64), n)
                        words = [words[j] for j in np.flatnonzero(~gone).tolist()]
                    kept = b" ".join(words)
                    out.append((n, n - len(words), kept.decode() if texts else None, hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*out))
                yield pa.record_batch([*(part.column(i) for i in range(2)),
                                       *(pa.array(c, t.type) for c, t in zip(cols, list(_OUT)[2:]))], schema=_OUT)

    return run


def dedup_substrings(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, texts: bool = True,
                     forms: int = FORMS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)`` and the row key, one row
    per row of ``docs``; ``kept`` (the kept words joined by one space) only with ``texts``."""
    if not 0 < width < MAX_WIDTH:
        raise ValueError(f"width must lie between 1 and {MAX_WIDTH - 1}")
    spark = docs.sparkSession
    T.prepare(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = T.keyed(docs).select(T.K1, "doc_id", "text").repartition(n, T.K1)
    first = _sorted(rows.mapInArrow(_search(width, rounds, forms), _ROW)).mapInArrow(_decide(LOOK), _ROW)
    per = first.groupBy(T.K1).agg(
        F.collect_list(F.when(_state() == LOOK, _range())).alias("ranges"),         # bounded by the document's words
        F.collect_list(F.when(_state() == GONE, _range())).alias("sure"))
    both = rows.join(per, T.K1, "left").select(T.K1, "doc_id", "text", "ranges", "sure")
    # the second comparison only sees documents with ranges to look at
    windows = both.filter(F.size("ranges") > 0).select(T.K1, "doc_id", "text", "ranges").mapInArrow(_verify(width), _ROW)
    found = _sorted(windows).mapInArrow(_decide(GONE), _ROW).filter(_state() == GONE)
    gone = found.groupBy(T.K1).agg(F.collect_list(_range()).alias("more"))
    all_ = F.concat(F.coalesce("sure", F.array().cast("array<struct<lo:int,hi:int>>")),
                    F.coalesce("more", F.array().cast("array<struct<lo:int,hi:int>>")))
    return (both.join(gone, T.K1, "left").select(T.K1, "doc_id", "text", all_.alias("gone"))
            .mapInArrow(_apply(width, texts), f"{T.K1} bigint, doc_id bigint, n_words bigint, n_removed bigint, "
                        "kept string, kept_sha256 string"))
