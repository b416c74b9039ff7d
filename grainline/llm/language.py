"""Operator 9: language identification by character language models.

One interpolated Kneser-Ney model per language, over letters in lower case
within words (a maximal run of letters, with a boundary before and after).

* **Counting.**  Every text is counted, in one pass: each task adds up the
  character n-grams of its distinct words and sends one row per ``(language,
  n-gram)`` (no language for texts that are no training rows); Spark sums them.
  What is gathered grows with the input until the languages' n-grams are exhausted.
* **Model.**  Continuation counts, discounts ``n1 / (n1 + 2 n2)``, context
  totals and back-off weights are DataFrame aggregates over the counts.  The
  model holds every n-gram of the training texts over whole code points.
* **Probabilities.**  The n-grams that occur in any text meet the model in Spark,
  order by order: one join each for the n-gram's own share, its context's back-off
  and the next lower order.  A join key has at most one row per symbol of the alphabet.
  The result is a table of 64-bit n-gram hashes with one log-probability per language.
* **Scores.**  The most frequent n-grams, as many as fit in ``frequent`` bytes,
  are broadcast as sorted hash arrays (a fixed size, whatever the input); a text sums them
  in place and lists its other n-grams, whose values come by a join on the hash.
  None of those is frequent, so no key of that join is hot.  A text's cross-entropy is the
  sum divided by the number of predicted characters.  The lowest one wins
  (ties: first language by name).
* **Rejection.**  The winners' cross-entropies over all training texts give a
  mean and deviation per language and length class (powers of two of the
  number of predicted characters, lower classes with few texts borrow from
  the language as a whole).  A text is rejected if it has no letter, or if its
  cross-entropy lies above its class by more than ``z`` deviations and by
  more than ``slack`` nats.

``score`` is the winner's posterior probability under a per-character weight
capped at ``CAP`` characters, 0 for ``und``.

Edge cases: null, empty or letterless text gives ``und``, score 0, rejected; a
null ``doc_id`` is no training row and its result keeps the null; no training
rows give ``und`` for all; repeated rows give repeated results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import place, written

ORDER = 5
FREQUENT = 32 << 20             # bytes of n-grams that are broadcast
PIECE = 1 << 20                 # bytes of text a task takes apart at once; its n-grams take up to a hundred times that
HELD = 1_000_000                # n-grams a counting task holds before it hands them over
STEPS = 8                       # classes of n-gram frequency per power of two
BOUNDARY = 1
Z = 8.0
SLACK = 1.0
CAP = 40.0
MIN_CLASS = 30

_LETTER = regex.compile(r"\p{L}")
_KNOWN = np.zeros(0x110000, np.int8)      # per worker: 0 unknown, 1 letter, 2 other


def _letters(cp: np.ndarray) -> np.ndarray:
    new = np.unique(cp[_KNOWN[cp] == 0])
    for c in new.tolist():
        _KNOWN[c] = 1 if _LETTER.match(chr(c)) else 2
    return _KNOWN[cp] == 1


class _Events:
    """The n-grams that end at each letter and each word end of some tokens.

    ``hash`` is the n-gram's 64-bit hash, ``token`` its token's index.  The history
    reaches back ``order - 1`` symbols, at most to the boundary before the word's first letter."""

    def __init__(self, words: pa.Array, order: int):
        self.order = order
        self.hash, self.token = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        cp = np.frombuffer("\n".join(words.to_pylist()).lower().encode("utf-32-le"), np.uint32)
        letter = _letters(cp) if len(cp) else np.zeros(0, bool)
        if not letter.any():
            return
        start = letter & ~np.r_[False, letter[:-1]]
        at = np.flatnonzero(letter)
        run = np.cumsum(start)[at] - 1
        # sequence: boundary, letters, boundary, for every run of letters
        pos = np.arange(len(at)) + 2 * run + 1
        size = len(at) + 2 * (int(run[-1]) + 1)
        self.seq = np.full(size, BOUNDARY, np.uint32)
        self.seq[pos] = cp[at]
        first = np.flatnonzero(start[at])
        begin = pos[first] - 1                       # the leading boundary of each run
        length = np.diff(np.r_[begin, size])
        depth = np.arange(size) - np.repeat(begin, length)      # symbols before this one in its run
        self.end = np.flatnonzero(depth > 0)
        self.used = np.minimum(depth[self.end], order - 1) + 1
        self.hash = np.zeros(len(self.end), np.uint64)
        for j in range(order - 1, -1, -1):           # oldest symbol first
            has = np.flatnonzero(self.used > j)
            self.hash[has] = T.mix(self.hash[has] ^ (self.seq[self.end[has] - j].astype(np.uint64) * T._M1 + T._M3))
        self.token = np.repeat(np.cumsum(cp == 10)[at][first], length)[self.end]

    def strings(self, which: np.ndarray) -> np.ndarray:
        """The n-grams of some events as text, the boundary as ``U+0001``."""
        out = np.zeros((len(which), self.order), np.uint32)
        used, end = self.used[which], self.end[which]
        for j in range(self.order):
            has = np.flatnonzero(used > j)
            out[has, j] = self.seq[end[has] - used[has] + 1 + j]
        return out.view(f"<U{self.order}").ravel()


def _merged(old, new):
    h, at, inv = np.unique(np.concatenate([old[0], new[0]]), return_index=True, return_inverse=True)
    c = np.zeros(len(h), np.int64)
    np.add.at(c, inv, np.concatenate([old[1], new[1]]))
    return h, c, np.concatenate([old[2], new[2]])[at]


def _count(order: int):
    schema = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("c", pa.int64()), ("gram", pa.string())])

    def handed_over(sums):
        for name, (h, c, g) in sums.items():
            for a in range(0, len(h), 100_000):
                s = slice(a, a + 100_000)
                yield pa.record_batch([pa.array([name] * len(h[s]), pa.string()), pa.array(T.signed(h[s])), pa.array(c[s]),
                                       pa.array(g[s].tolist(), pa.string())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch, arr in T.rows(batches, limit=PIECE):
            enc_lang = batch.column(0).dictionary_encode(null_encoding="encode")
            names = enc_lang.dictionary.to_pylist()
            flat, bounds = T.split_words(arr)
            if not len(flat):
                continue
            enc = flat.dictionary_encode()
            idx = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            ev = _Events(enc.dictionary, order)
            if not len(ev.hash):
                continue
            h, at, inv = np.unique(ev.hash, return_index=True, return_inverse=True)
            text = ev.strings(at)
            code = np.repeat(enc_lang.indices.to_numpy(zero_copy_only=False), np.diff(bounds))
            for i, name in enumerate(names):
                times = np.bincount(idx[code == i], minlength=len(enc.dictionary))
                c = np.bincount(inv, weights=times[ev.token], minlength=len(h)).astype(np.int64)
                new = h[c > 0], c[c > 0], text[c > 0]
                sums[name] = _merged(sums[name], new) if name in sums else new
            if sum(len(x[0]) for x in sums.values()) > HELD:      # bounded memory: hand over and start again
                yield from handed_over(sums)
                sums = {}
        yield from handed_over(sums)

    return run


def count(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, h, c)``: how often each n-gram occurs in the rows of each ``lang``, null included."""
    return written(rows.select("lang", "text").mapInArrow(_count(order), "lang string, h bigint, c bigint, gram string")
                   .groupBy("lang", "gram", "h").agg(F.sum("c").alias("c")), "grams")


@dataclass
class Model:
    """``grams`` and ``contexts`` are tables ``(key, at, v)``: an n-gram's discounted share and a context's
    back-off weight in the language at place ``at`` of ``langs``."""
    langs: list[str]
    order: int
    floor: float
    grams: DataFrame
    contexts: DataFrame


def fit(counts: DataFrame, order: int = ORDER) -> Model | None:
    """Fit on the rows of ``counts`` that have a language; all orders go through each step together."""
    counts = counts.filter("lang is not null")
    # every suffix of every n-gram; only n-grams cut off by a word's start bring their own count to a lower order
    seen = written(counts.select("lang", "gram", "c", F.explode(F.sequence(F.lit(1), F.char_length("gram"))).alias("k"))
                   .select("lang", F.expr("right(gram, k)").alias("gram"),
                           F.when(F.col("k") == F.char_length("gram"), F.col("c")).otherwise(F.lit(0)).alias("c"))
                   .groupBy("lang", "gram").agg(F.sum("c").alias("c")), "suffixes")
    left = seen.filter("char_length(gram) > 1").selectExpr("lang", "substring(gram, 2) AS gram", "1L AS c")
    table = written(seen.union(left).groupBy("lang", "gram").agg(F.sum("c").alias("c"))
                    .withColumn("k", F.char_length("gram")), "kneser")
    n = {(r["lang"], r["k"], r["c"]): r["n"] for r in table.groupBy("lang", "k", F.least("c", F.lit(3)).alias("c"))
         .agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted({x for x, _, _ in n})
    if not langs:
        return None
    disc = []
    for k in range(1, order + 1):
        for x in langs:
            n1, n2 = n.get((x, k, 1), 0), n.get((x, k, 2), 0)
            disc.append(min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.1)
    code = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int")
    discount = F.element_at(F.array(*[F.lit(float(d)) for d in disc]), (F.col("k") - 1) * len(langs) + code)
    symbols = table.filter("k = 1").select("gram").distinct().count()
    table = table.withColumn("context", F.expr("left(gram, k - 1)"))
    totals = written(table.groupBy("lang", "k", "context")
                     .agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")), "contexts")
    grams = table.join(totals, ["lang", "k", "context"]).select(
        F.col("gram").alias("key"), (code - 1).alias("at"),
        F.greatest((F.col("c") - discount) / F.col("total"), F.lit(0.0)).alias("v"))
    backs = totals.select(F.col("context").alias("key"), (code - 1).alias("at"),
                          (discount * F.col("kinds") / F.col("total")).alias("v"))
    return Model(langs, order, 1.0 / (symbols + 1), grams, backs)


def log_probabilities(model: Model, asked: DataFrame) -> DataFrame:
    """``asked`` (distinct ``gram``, other columns kept) with ``lp``, the natural log of
    P(last symbol | the ones before) per language."""
    near = lambda df: df.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("v"))
    shares, backs = written(near(model.grams), "shares"), written(near(model.contexts), "backs")
    every = written(asked.select("gram", F.explode(F.sequence(F.lit(1), F.char_length("gram"))).alias("k"))
                    .select(F.expr("right(gram, k)").alias("gram"), "k").distinct(), "asked")
    lower, tables = None, []
    for k in range(1, model.order + 1):
        own = (every.filter(F.col("k") == k).withColumns({"context": F.expr("left(gram, k - 1)"), "suffix": F.expr("right(gram, k - 1)")})
               .join(shares.select(F.col("key").alias("gram"), F.col("v").alias("share")), "gram", "left")
               .join(backs.select(F.col("key").alias("context"), F.col("v").alias("back")), "context", "left"))
        own = (own.withColumn("below", F.array_repeat(F.lit(model.floor), len(model.langs))) if lower is None
               else own.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix"))
        p = F.transform("below", lambda q, i: F.coalesce(F.element_at("share", i), F.lit(0.0))
                        + F.coalesce(F.element_at("back", i), F.lit(1.0)) * q)
        lower = written(own.select("gram", p.alias("p")), f"order{k}")
        tables.append(lower)
    lp = F.transform("p", lambda q: F.log(F.greatest(q, F.lit(1e-12))).cast("float")).alias("lp")
    return asked.join(reduce(DataFrame.union, tables).select("gram", lp), "gram")


def _frequent(asked: DataFrame, limit: int) -> pa.Table:
    """The ``(h, lp)`` of the most frequent n-grams, ``limit`` at most, by the classes of their counts."""
    cls = F.floor(F.log2(F.col("c").cast("double")) * STEPS).cast("int")
    sizes = asked.groupBy(cls.alias("cls")).agg(F.count(F.lit(1)).alias("n")).collect()      # 64 * STEPS rows at most
    total, cut = 0, 1 << 30
    for r in sorted(sizes, key=lambda r: -r["cls"]):
        total += r["n"]
        if total > limit:
            break
        cut = r["cls"]
    return asked.filter(cls >= cut).select("h", "lp").toArrow()


def _score(known_b, width: int, order: int):
    schema = pa.schema([(T.K1, pa.int64()), (T.K2, pa.int32()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("n", pa.int64()),
                        ("known", pa.list_(pa.float64())), ("rest", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = known_b.value
        for batch, arr in T.rows(batches, limit=PIECE):
            size = len(arr)
            n, total = np.zeros(size, np.int64), np.zeros((size, width))
            doc, rest, times = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            flat, bounds = T.split_words(arr)
            if len(flat):
                enc = flat.dictionary_encode()
                idx = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ev, words = _Events(enc.dictionary, order), len(enc.dictionary)
                n = T.sums(np.bincount(ev.token, minlength=words)[idx], bounds)
                kinds, inv = np.unique(ev.hash, return_inverse=True)
                at = np.minimum(np.searchsorted(keys, kinds), max(len(keys) - 1, 0))
                hit = keys[at] == kinds if len(keys) else np.zeros(len(kinds), bool)
                lp = np.zeros((len(kinds), width))
                if hit.any():
                    lp[hit] = values[at[hit]]
                for j in range(width):
                    per_word = np.bincount(ev.token, weights=lp[inv, j], minlength=words)
                    total[:, j] = T.sums(per_word[idx], bounds)
                if width and not hit.all():
                    doc, rest, times = _rest(ev, ~hit[inv], idx, bounds, words)
            offsets = pa.array(np.searchsorted(doc, np.arange(size + 1)).astype(np.int32))
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(n),
                                   pa.ListArray.from_arrays(pa.array((np.arange(size + 1) * width).astype(np.int32)), pa.array(total.ravel())),
                                   pa.ListArray.from_arrays(offsets, pa.array(T.signed(rest))),
                                   pa.ListArray.from_arrays(offsets, pa.array(times))], schema=schema)

    return run


def _rest(ev: _Events, miss: np.ndarray, idx: np.ndarray, bounds: np.ndarray, words: int):
    """Per text and hash, in order, how often an n-gram that is not broadcast occurs."""
    token, h = ev.token[miss], ev.hash[miss]               # tokens ascend
    per = np.bincount(token, minlength=words)
    first = np.cumsum(per) - per
    reps = per[idx]
    start = np.repeat(first[idx] - (np.cumsum(reps) - reps), reps)
    h = h[start + np.arange(len(start))]
    doc = np.repeat(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), reps)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return doc[head], h[head], np.diff(np.r_[head, len(h)])


def _scored(rows: DataFrame, asked: DataFrame | None, langs: list[str], order: int, frequent: int) -> DataFrame:
    """Each row's key, ``train``, ``n`` predicted characters, best language, its cross-entropy and score."""
    width = len(langs)
    known = np.zeros(0, np.uint64), np.zeros((0, width), np.float32)
    if asked is not None:
        got = _frequent(asked, frequent // (8 + 4 * width)).sort_by("h").combine_chunks()
        h = got["h"].to_numpy().view(np.uint64)
        lp = pc.list_flatten(got["lp"]).to_numpy().reshape(len(h), width)
        by = np.argsort(h)
        known = h[by], lp[by]
    parts = written(rows.mapInArrow(_score(rows.sparkSession.sparkContext.broadcast(known), width, order),
                                    f"{T.K1} bigint, {T.K2} int, doc_id bigint, train boolean, n bigint, "
                                    "known array<double>, rest array<bigint>, times array<bigint>"), "sums")
    parts = parts.withColumn("_at", place())
    total = F.col("known")
    if asked is not None:
        rest = (parts.filter(F.size("rest") > 0).select("_at", F.explode(F.arrays_zip("rest", "times")).alias("r"))
                .select("_at", F.col("r.rest").alias("h"), F.col("r.times").alias("times"))
                .join(asked.select("h", "lp"), "h").groupBy("_at")
                .agg(*[F.sum(F.col("lp")[i].cast("double") * F.col("times")).alias(f"s{i}") for i in range(width)])
                .select("_at", F.array(*[f"s{i}" for i in range(width)]).alias("others")))
        parts = parts.join(rest, "_at", "left")
        total = F.when(F.col("others").isNull(), F.col("known")).otherwise(F.zip_with("known", "others", lambda a, b: a + b))
    none = F.lit(width == 0) | (F.col("n") == 0)
    low = F.array_min("ces")
    weight = F.least(F.col("n").cast("double"), F.lit(CAP))
    spread = F.aggregate("ces", F.lit(0.0), lambda s, x: s + F.exp(-(x - F.col("low")) * weight))
    return written(
        parts.withColumn("ces", F.transform(total, lambda x: -x / F.greatest(F.col("n"), F.lit(1)))).withColumn("low", low)
        .select(T.K1, T.K2, "doc_id", "train", "n",
                F.when(none, F.lit(-1)).otherwise((F.array_position("ces", F.col("low")) - 1).cast("int")).alias("best"),
                F.when(none, F.lit(0.0)).otherwise(F.col("low")).alias("ce"),
                F.when(none, F.lit(0.0)).otherwise(1.0 / spread).alias("score")), "scores")


def held_out(doc_id=None):
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame, order: int = ORDER, z: float = Z, slack: float = SLACK, frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, cross_entropy, n_letters, rejected)``
    and the row key per row of ``docs`` (``doc_id``, ``text``, ``lang``), fitted on its training rows."""
    spark = docs.sparkSession
    T.prepare(spark)
    out = F.coalesce(held_out(), F.lit(False))
    train = F.col("doc_id").isNotNull() & ~out & F.col("lang").isNotNull() & F.col("text").isNotNull()
    text = F.col("text").cast("string").alias("text")
    counts = count(docs.filter("text is not null").select(F.when(train, F.col("lang").cast("string")).alias("lang"), text), order)
    model = fit(counts, order)
    langs = model.langs if model else []
    asked = None
    if model:
        each = written(counts.groupBy("gram", "h").agg(F.sum("c").alias("c")), "each")
        asked = written(log_probabilities(model, each), "log-probabilities")
    rows = docs.select(*T.key_columns(), F.col("doc_id").cast("bigint").alias("doc_id"), train.alias("train"), text)
    scored = _scored(rows, asked, langs, order, frequent)
    cls = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    seen = scored.filter("train and best >= 0")
    stats = [F.count(F.lit(1)).alias("m"), F.avg("ce").alias("mu"), F.stddev_pop("ce").alias("sd")]
    whole = seen.groupBy("best").agg(*stats)
    per = (seen.groupBy("best", cls.alias("cls")).agg(*stats).filter(F.col("m") >= MIN_CLASS)
           .select("best", "cls", F.col("mu").alias("cmu"), F.col("sd").alias("csd")))
    limits = scored.withColumn("cls", F.when(F.col("best") >= 0, cls)).join(
        whole.select("best", "mu", "sd"), "best", "left").join(per, ["best", "cls"], "left")
    mu, sd = F.coalesce("cmu", "mu"), F.coalesce("csd", "sd")
    over = F.coalesce((F.col("ce") > mu + F.lit(z) * sd) & (F.col("ce") > mu + F.lit(slack)), F.lit(False))
    names = F.array(*[F.lit(x) for x in langs]) if langs else F.array(F.lit("und"))
    return limits.select(
        T.K1, T.K2, "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.when(F.col("best") < 0, F.lit("und")).otherwise(F.get(names, F.col("best"))).alias("lang_pred"),
        "score", F.col("ce").alias("cross_entropy"), F.col("n").alias("n_letters"),
        ((F.col("best") < 0) | over).alias("rejected"))
