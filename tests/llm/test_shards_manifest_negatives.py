"""Operators 11 to 13 against brute force, and their edge cases."""

import glob
import hashlib
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, _h1 string, tree string"
LONG = " ".join(f"w{i % 977}X" for i in range(30_000))
ODD = [(1, "A b c", "en", "s1", 5, 0, "k", "t"), (1, "A b c", "en", "s1", 5, 0, "k", "t"),
       (2, None, "en", None, None, None, None, None), (3, "", None, "s1", 0, 1, "", ""),
       (None, "A b c", None, "s2", 1, 1, "x", "y"), (None, None, None, None, None, None, None, None),
       (6, LONG, "en", "s1", 1, 1, "x", "y"), (7, LONG, "EN", "s2", 1, 1, "x", "y"), (8, "é" * 500, "", "s1", 1, 1, "x", "y"),
       (9, "Ünï", "-", "s1", 1, 1, "x", "y")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def size(text):
    return len((text or "").encode()) + 16


def brute_shards(rows, n):
    """Shard of each size in order: the one its middle byte falls into."""
    total, run, out = sum(rows), 0, []
    for s in rows:
        out.append((2 * run + s) * n // (2 * total))
        run += s
    return out


def check_slots(got):
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_edges(spark, odd):
    from grainline.llm.sharding import shard_documents
    got = shard_documents(odd, n_shards=4, carry=("text", "size")).collect()
    assert len(got) == len(ODD)
    assert sorted(((r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got), key=str) == sorted(
        ((size(r[1]), zlib.crc32((r[1] or "").encode()), "bytes", None) for r in ODD), key=str)
    check_slots(got)
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in ordered]
    assert ids == sorted(ids)
    assert [r["shard"] for r in ordered] == brute_shards([size(r["text"]) for r in ordered], 4)
    assert shard_documents(odd.limit(0)).count() == 0


def test_shards_hot_key_and_pieces(spark, tmp_path):
    """A third of the rows under one id and text; shards cut into many pieces; files in slot order."""
    from grainline.llm.sharding import shard_documents, write_shards
    rng = np.random.default_rng(3)
    rows = [(5, "same text") if i % 3 == 0 else (int(rng.integers(0, 400)), "x" * int(rng.integers(0, 300))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7, "doc_id")
    out = shard_documents(df, n_shards=10, carry=("text",), probes=4, piece_bytes=2000)
    got = out.collect()
    check_slots(got)
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in ordered] == sorted(r[0] for r in rows)
    assert [r["shard"] for r in ordered] == brute_shards([size(r["text"]) for r in ordered], 10)
    path = write_shards(out, str(tmp_path))
    assert len(glob.glob(os.path.join(path, "shard=*"))) == 10
    back = spark.read.parquet(path).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert {r["shard"]: r["b"] for r in back} == {s: sum(r["size"] for r in got if r["shard"] == s) for s in range(10)}


def test_shards_within_tolerance(spark):
    from grainline.llm.sharding import shard_documents
    rows = [(i, "y" * (i * 7919 % 200)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = shard_documents(df, n_shards=8, tolerance=0.05, probes=8).collect()
    check_slots(got)
    total = sum(r["size"] for r in got)
    below = 0
    for s in range(7):
        below += sum(r["size"] for r in got if r["shard"] == s)
        assert abs(below - total * (s + 1) / 8) <= 0.05 * total / 8
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in ordered] == list(range(4000))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, t, lang, s, n):
        return digest(field(d) + field(s) + field(lang) + field(n) + field(t))

    def tower(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r[:5])
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in names:
        trees[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    towers = {k: tower([leaf(*r) for r in trees[k]]) for k in names}
    top = tower([towers[k][-1][0] for k in names])
    out = []
    for at, k in enumerate(names):
        for j, r in enumerate(trees[k]):
            own = cur = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                cur = leaf(r[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            proof = ""
            for levels, i in ((towers[k], j), (top, at)):
                for level in levels[:-1]:
                    run, o = level[i // 8 * 8:i // 8 * 8 + 8], i % 8
                    proof += "".join(run[:o] + run[o + 1:])
                    cur = digest("".join(run[:o] + [cur] + run[o + 1:]))
                    i //= 8
            out.append((r[0], own, towers[k][-1][0], top[-1][0], digest(proof), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(df):
    from grainline.llm.manifest import manifest
    return sorted((tuple(r) for r in manifest(df).collect()), key=str)


def test_manifest_edges(spark, odd):
    assert manifest_rows(odd) == brute_manifest(ODD)
    assert manifest_rows(odd.limit(0)) == []


def test_manifest_lone_leaf_and_single_language(spark):
    one = [(4, "Only ONE", "en", "s", 8)]
    some = [(i, f"Text {i} UP", "en", "s", i) for i in range(70)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    assert manifest_rows(spark.createDataFrame(one, schema)) == brute_manifest(one)
    assert manifest_rows(spark.createDataFrame(some, schema)) == brute_manifest(some)


def test_manifest_upper_nodes_in_blocks(spark, monkeypatch):
    """Many languages (two levels above the subroots), one hot, upper nodes repeated per block of runs."""
    from grainline.llm import manifest as M
    monkeypatch.setattr(M, "BLOCK", 3)
    rows = [(i, f"Doc {i * 31 % 57} TEXT", f"l{i % 20}" if i % 3 else "hot", None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    assert manifest_rows(df) == brute_manifest(rows)


def brute_negatives(rows, anchors=100):
    keep = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, [int(np.floor(256 * x)) for x in v])
            for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    def order(r): return (-r[0], r[1] is None, r[1] or 0)  # noqa: E704
    out = []
    for n, (i, lab, v) in enumerate(keep):
        if i is None or i % anchors:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, other) for m, (j, other, w) in enumerate(keep) if m != n]
        for p, pid, _ in sorted((s for s in scores if s[2] == lab), key=order)[:5]:
            fit = [s for s in scores if s[2] != lab and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(i, pid, k + 1, nid, p, s) for k, (s, nid, _) in enumerate(sorted(fit, key=order)[:10])]
    return sorted(out, key=str)


def mined(df, **kw):
    from grainline.llm.negatives import mine
    return sorted((tuple(r) for r in mine(df, **kw).collect()), key=str)


VECTORS = "vec_id bigint, embedding array<float>, label int, row string, z int"


def test_negatives_match_brute_force(spark):
    """Clustered vectors, one very common vector, ties and repeated rows; anchors in several blocks."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, 40))
    rows = []
    for i in range(900):
        v = centres[0] if i % 3 == 0 else centres[i % 10] + 0.6 * rng.normal(size=40)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 10)), "r", 1))
    rows += [rows[100], rows[7], rows[7]]
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    want = brute_negatives([r[:3] for r in rows])
    assert mined(df) == want and want
    assert mined(df, anchor_bytes=8 * 40 * 3, stages=1) == want


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1, None, None), (0, [1.0, 2.0], 1, None, None), (100, [1.0], 1, "a", 1), (200, [], 2, "a", 1),
            (1, [0.5, 0.5], 1, "a", 1), (2, [0.5, 0.25, 3.0], 2, "a", 1), (None, [0.4, 0.9], 2, "a", 1), (3, None, 1, "a", 1),
            (4, [1.0, nan], 1, "a", 1), (5, [inf], 1, "a", 1), (6, [1.0, None], 2, "a", 1), (8, [0.3, 0.3], None, "a", 1),
            (300, [-1.0, -2.0], 1, "a", 1), (9, [0.7, 0.7], 3, "a", 1), (10, [0.7, 0.7], 3, "a", 1)]
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df) == brute_negatives([r[:3] for r in rows])
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id = 1")) == []
    with pytest.raises(ValueError):
        mined(spark.createDataFrame([(0, [1e30], 1, "a", 1)], VECTORS))


@pytest.mark.parametrize("dim, stages", [(64, 4), (40, 1), (130, 3), (1, 2)])
def test_intervals_hold_every_score(dim, stages):
    from grainline.llm.negatives import Anchors, encode, rotation
    rng = np.random.default_rng(dim)
    z, q = (rng.integers(-300, 300, size=(n, dim)) for n in (500, 20))
    z[:3], q[0] = 0, z[5]
    turn = rotation(dim)
    assert np.allclose(turn @ turn.T, np.eye(dim))
    codes, align, left = encode(z, turn, stages)
    block = Anchors(q, turn)
    gap = np.abs(q @ z.T - block.estimate(codes, align))
    assert (gap <= block.reach(align, left, stages)).all()
    # the codes narrow the intervals: a residual is shorter than its vector
    assert (left <= np.sqrt((z.astype(float) ** 2).sum(1)) + 1e-6).all()
