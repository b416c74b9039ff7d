"""Secret scans and toxicity against plain Python over all rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

DOCS = "doc_id bigint, text string, source string"
ALNUM = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def run_of(text, at, chars):
    end = at
    while end < len(text) and text[end] in chars:
        end += 1
    return end


def assign_at(text, i):
    """End and value of an assignment that starts at ``i``."""
    low = text[i:i + 8]
    low = "".join(c.lower() if c in ALNUM else c for c in low)
    for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        if low.startswith(name):
            j = i + len(name)
            j += j < len(text) and text[j] in "\"'"
            j = run_of(text, j, " ")
            if j < len(text) and text[j] in ":=":
                j = run_of(text, j + 1, " ")
                j += j < len(text) and text[j] in "\"'"
                end = run_of(text, j, ALNUM | set("+/_.=-"))
                if end > j:
                    return end, text[j:end]
    return None


def brute_base(text):
    """Leftmost non-overlapping matches per kind, one start after the other."""
    out = []
    for rank, kind in enumerate(("assign", "access", "hex")):
        i = 0
        while i < len(text):
            got = None
            if kind == "assign":
                got = assign_at(text, i)
                least = 6
            elif kind == "access":
                least, end = 20, run_of(text, i + 4, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
                if text.startswith("AKIA", i) and end > i + 4:
                    got = end, text[i:end]
            else:
                least, end = 24, run_of(text, i, set("0123456789abcdef"))
                if end > i:
                    got = end, text[i:end]
            if got is None:
                i += 1
                continue
            if len(got[1]) >= least:
                out.append((i, rank, got[0], got[1]))
            i = got[0]
    return sorted(out)


def test_secrets_equal_brute_force(spark):
    from grainline.llm.secrets import KINDS, spans, scan
    rng = random.Random(7)
    parts = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "abc", "abcdef1", "AKIA", "Z9" * 9,
             "deadbeef", "0123456789abcdef", "é", "\n", "-", "=", ".", "x" * 7, "ghp_" + "a1" * 18, "https://u:pw1@h", "ftp://:q@"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) if i % 17 else None, f"s{rng.randint(0, 4)}") for i in range(600)]
    rows += rows[:20]
    got = collections.defaultdict(list)
    for r in scan(spark.createDataFrame(rows, DOCS), owners=3, copies=5).collect():
        got[r.doc_id].append(r)
    repos, owners = collections.defaultdict(set), collections.defaultdict(set)
    for i, t, s in rows:
        for *_, v in spans(t or ""):
            repos[v].add(i)
            owners[v].add(s)
    name = lambda f: f"{KINDS[f[1]][0]}:{f[0]}:{f[2]}"
    seen = 0
    for i, t, _ in rows:
        base, full = brute_base(t or ""), spans(t or "")
        assert [f for f in full if f[1] < 3] == base
        live = [name(f) for f in full if len(owners[f[3]]) < 3 and len(repos[f[3]]) < 5]
        for r in got[i]:
            assert [r.n_assign, r.n_access, r.n_hex] == [sum(f[1] == k for f in base) for k in range(3)]
            assert r.base_sha256 == hashlib.sha256(",".join(map(name, base)).encode()).hexdigest()
            assert r.spans == ",".join(map(name, full)) and r.live_spans == ",".join(live)
            assert (r.n_live, r.n_copied) == (len(live), len(full) - len(live))
        seen += len(base)
    assert seen > 200


def test_spans_have_no_length_bounds():
    from grainline.llm.secrets import spans
    scheme, kind = "a" + "b+" * 40, "VERY LONG " * 9
    assert [(a, v) for a, _, _, v in spans(f"9{scheme}://u:pw@h")] == [(1, "pw")]
    assert [(a, v) for a, _, _, v in spans(f"-----BEGIN {kind}PRIVATE KEY-----\nQUJD\n-----END {kind}PRIVATE KEY-----")] == [(0, "QUJD")]
    text = "x" * 300_000 + " a://u:p@ " + "y" * 300_000 + "://u:p@"
    assert [(a, v) for a, _, _, v in spans(text)] == [(300_010, "p")]
    assert not spans("://u:p@ 1.://u:p@")


def words_of(text):
    return [set(re.findall(r"[^\W\d_]+", s.lower())) for s in re.split(r"[.!?\n]", text or "") if s]


def test_scores_are_noisy_or_of_the_sentences(spark):
    from grainline.llm.toxicity import fit, score
    rng = random.Random(3)
    words = [f"w{a}{b}" .translate(str.maketrans("0123456789", "abcdefghij")) for a in range(10) for b in range(10)]
    rows = []
    for i in range(300):
        s = [" ".join(rng.choices(words, k=6)) for _ in range(rng.randint(1, 5))]
        if i % 4 == 0:
            s[-1] += " vile"
        rows.append((i, ". ".join(s), "s"))
    rows += [(300, None, "s"), (301, "", "s"), (302, "\n.!", "s"), (303, "vile " * 2000, "s")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    weights, bias = fit(docs, labels)
    got = {r.doc_id: r for r in score(docs, labels).collect()}
    for i, t, _ in rows:
        clean = 1.0
        for s in words_of(t):
            clean *= 1 - 1 / (1 + math.exp(-max(-30, min(30, bias + sum(weights.get(w, 0.0) for w in s)))))
        want = 1 - clean
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= 0.5)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_vocabulary_is_whole_and_sample_is_bounded(spark):
    from grainline.llm import toxicity as X
    letters = "abcdefghijklmnop"
    word = lambda n: "".join(letters[(n >> s) & 15] for s in (16, 12, 8, 4, 0))
    text = ". ".join(" ".join(word(n) for n in range(a, a + 50)) for a in range(0, 60_000, 50))
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:8]
    rows = [(i, text + (". vile" if n % 2 else ". kind"), "s") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows + rows[:3], DOCS)
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id bigint, toxic int")
    bags = X._sampled(docs, labels, 2000, X.CHARS).toPandas()
    assert len(bags) == 8 and set(bags.text) == {t for _, t, _ in rows}
    size = len(rows[0][1])
    few = X._sampled(docs, labels, 2000, 2 * size + 10).toPandas()
    assert few.toxic.value_counts().to_dict() == {0: 2, 1: 2} and set(few.text.map(len)) == {size}
    assert X._sampled(docs, labels, 1, X.CHARS).count() == 2
    from unittest import mock
    with mock.patch.object(np, "sign", wraps=np.sign) as seen:
        X.fit(docs, labels, iterations=1)
    assert len(seen.call_args[0][0]) == 60_002
