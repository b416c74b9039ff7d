"""Operator 7: toxicity by multiple-instance learning.

Labels are known for documents only, the offence sits in a few sentences.  A
sentence's probability is a logistic function of its words; a document is
toxic with the noisy-or of its sentences, ``1 - prod(1 - p)``.  The model is trained
on document labels through the noisy-or, and then names the offending sentences.

* **Sample.**  At most ``sample`` labelled documents per label, those with the
  smallest hash of their id, as long as their texts hold ``chars`` characters at most
  together; whole texts, rows of equal id and text once.  Held-out rows (crc32 of the id,
  modulo 5, is 0) are never in it.  Labels, language, source and id are not inputs.
* **Fit.**  Spark cuts the sampled texts into sentences; every word found in
  at least ``min_docs`` sampled documents is in the vocabulary.  The driver fits their
  weights by Adam with steps that die out and an L1 pull that sets a weight to zero;
  it holds one Arrow table of the sample, so rows and bytes are both bounded.
* **Scores.**  One pass over all texts, weights broadcast (bounded by the sample as well).

Sentences end at ``.``, ``!``, ``?`` and line ends; words are runs of letters in lower case.

Edge cases: null or empty text has no sentence and the score 0; a null id is
never a training row; labels of one id that disagree are not used; no labels
of both kinds give the score 0 for all; repeated rows give repeated results;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import written

SAMPLE = 2000
MIN_DOCS = 4
CHARS = 16_000_000
ITERATIONS = 400
RATE = 0.15
L1 = 2e-4
_CUT = regex.compile(r"[^.!?\n]+")
_WORD = regex.compile(r"\p{L}+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Code point spans of a text's sentences."""
    return [m.span() for m in _CUT.finditer(text)]


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("toxic", pa.int32()), ("bags", pa.list_(pa.list_(pa.string())))])
    for batch, arr in T.rows(batches):
        bags = [[sorted(set(_WORD.findall(t[a:b].lower()))) for a, b in sentences(t)] for t in arr.to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array([[s for s in b if s] for b in bags], schema.field(1).type)], schema=schema)


def _sampled(docs: DataFrame, labels: DataFrame, sample: int, chars: int) -> DataFrame:
    """``(toxic, text)`` of the sampled documents."""
    known = (labels.filter("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("hi"))
             .filter("toxic = hi").filter(~held_out()))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = [known.filter(F.col("toxic") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    pick = written(first[0].union(first[1]).select("doc_id", "toxic"), "sample")
    # the sample is bounded by a parameter, so it may be broadcast and its lengths summed in one task
    rows = T.keyed(docs).join(F.broadcast(pick), "doc_id")
    sizes = rows.select(T.K1, T.K2, "doc_id", "toxic", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("size")).distinct()
    kept = [sizes.filter(F.col("toxic") == y).orderBy(*order, T.K1, T.K2).limit(sample) for y in (0, 1)]
    upto = Window.partitionBy("toxic").orderBy(*order, T.K1, T.K2)
    kept = written(kept[0].union(kept[1]).withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") <= chars)
                   .select(T.K1, T.K2), "sampled")
    return (rows.join(F.broadcast(kept), [T.K1, T.K2], "left_semi").groupBy(T.K1, T.K2)
            .agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, min_docs: int = MIN_DOCS,
        chars: int = CHARS, iterations: int = ITERATIONS) -> tuple[dict[str, float], float] | None:
    """Word weights and bias, or None without labels of both kinds."""
    bags = (_sampled(docs, labels, sample, chars).mapInArrow(_bags, "toxic int, bags array<array<string>>")
            .orderBy(F.xxhash64("bags"), "toxic").toArrow().combine_chunks())
    y = bags["toxic"].to_numpy().astype(np.int64)
    if not len(y) or y.min() == y.max():
        return None
    lists = pa.concat_arrays(bags["bags"].chunks)
    parts = lists.flatten()
    owner = np.repeat(np.arange(len(y)), pc.list_value_length(lists).to_numpy())
    size = pc.list_value_length(parts).to_numpy()
    enc = parts.flatten().dictionary_encode()
    code = enc.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(owner)), size)
    held = np.unique(owner[row] * max(1, len(enc.dictionary)) + code) % max(1, len(enc.dictionary))
    often = np.bincount(held, minlength=len(enc.dictionary)) >= min_docs
    words = enc.dictionary.filter(pa.array(often)).to_pylist()
    keep = often[code]
    col, row = (np.cumsum(often) - 1)[code[keep]], row[keep]
    w, b = np.zeros(len(words)), -5.0
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    balance = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for t in range(1, iterations + 1):
        z = np.clip(b + np.bincount(row, weights=w[col], minlength=len(owner)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        safe = np.bincount(owner, weights=-np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))    # -log P(not toxic)
        clean = np.exp(-safe)
        # d loss / d safe, then through the sentences: d(-log(1 - p)) / dz = p
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-6), 1.0) * balance
        dz = pull[owner] * p
        grad = np.r_[np.bincount(col, weights=dz[row], minlength=len(words)), dz.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        rate = RATE * 0.5 * (1 + np.cos(np.pi * (t - 1) / iterations))
        scale = rate / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-6)
        step = scale * (m / (1 - 0.9 ** t))
        w, b = w - step[:-1], b - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - scale[:-1] * L1, 0.0)
    return {x: float(u) for x, u in zip(words, w) if u}, float(b)


def _logits(text: str, weights: dict[str, float], bias: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    cuts = sentences(text)
    low = [text[a:b].lower() for a, b in cuts]
    return cuts, np.array([bias + sum(weights.get(w, 0.0) for w in set(_WORD.findall(s))) for s in low])


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted`` and ``offending``,
    all sentences with a probability of 0.5 or more as ``start:end``; the strongest one (ties:
    the first) where a predicted document has none."""
    spark = docs.sparkSession
    T.prepare(spark)
    model = spark.sparkContext.broadcast(fit(docs, labels, sample))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32()), ("offending", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value if model.value else ({}, -30.0)
        for batch, arr in T.rows(batches):
            scores, found = [], []
            for text in arr.to_pylist():
                cuts, z = _logits(text, weights, bias)
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                scores.append(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0)
                worst = np.flatnonzero(p >= 0.5).tolist() or ([int(np.argmax(p))] if scores[-1] >= 0.5 else [])
                found.append(",".join(f"{cuts[i][0]}:{cuts[i][1]}" for i in worst))
            s = np.clip(np.array(scores), 0.0, 1.0)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32)),
                                   pa.array(found, pa.string())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, offending string")
