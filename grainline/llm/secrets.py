"""Operator 6: secret scans with corpus-wide ownership frequency.

Every whole text is searched for the base kinds (``assign``, ``access``,
``hex``) and for the method's own kinds (private key blocks, provider tokens,
signed web tokens, credentials in a URL); matches of one kind do not overlap.
A candidate is a match's secret value, known to Spark by its SHA-256.  For each
candidate the distinct repositories (documents) and owners (sources) that hold
it are counted over the whole corpus.  The value of a private key is its body:
the span reaches from the header to the END line, or over the base64 (and key
headers) that follows where there is none; blanks and line ends, also quoted
ones, do not count.  A value with at least ``owners`` owners, or
at least ``copies`` repositories, is a widely copied example; any other is owner-specific and
reported as live.  All spans stay in the result, the class is added.

Scale: values never leave their task, only 32-byte hashes do; counts are
partial aggregates over distinct ``(value, owner, repository)``; the texts are
read once and never shuffled.

Edge cases: null text is empty; a null source is an owner of its own; rows of
equal id and text are one repository; positions are code points with exclusive
ends; a key header without a body has the header as its value; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import written

OWNERS = 3
COPIES = 20
BASE = ("assign", "access", "hex")
#: fixed values: kind, pattern, group of the secret value, least length of it
#: (base kinds first, in the order that breaks ties between equal starts)
KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("cloud", r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    ("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("url", r"://[^\x00-\x20/:@]*:([^\x00-\x20/@]+)@", 1, 0),
]
_COMPILED = [(k, re.compile(p), g, n) for k, p, g, n in KINDS]
_RANK = {k: i for i, (k, *_) in enumerate(KINDS)}
#: text without any of these holds no match
_HINT = re.compile(r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|-----BEGIN |gh[pousr]_|xox[abprs]-|AIza|eyJ|://")

_KEY_TAIL = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
#: lines of base64 or key headers, or a long run of base64 on the same line; line ends may be quoted
_EOL = r"(?:\\r|\\n|[\r\n])"
_KEY_BODY = re.compile(rf"""(?:[ \t]*{_EOL}(?:[ \t]*{_EOL})*(?:[A-Za-z][A-Za-z0-9-]*:[ \t][^\r\n\\]*|[ \t]*[A-Za-z0-9+/]+={{0,2}}(?=[ \t]*(?:\\r|\\n|[\r\n"'`]|\Z)))"""
                       r"|[ \t]*[A-Za-z0-9+/]{24,}={0,2})*")
_FILLER = re.compile(r"(?:\\r|\\n|\s)+")


def _key_block(text: str, m: re.Match, limit: int) -> tuple[int, str]:
    """End and value of the private key whose header is ``m``; the next header
    is at ``limit``."""
    tail = _KEY_TAIL.search(text, m.end(), limit)
    end = tail.end() if tail else _KEY_BODY.match(text, m.end(), limit).end()
    body = _FILLER.sub("", text[m.end():tail.start() if tail else end])
    return end, body or m.group()


def _scheme(text: str, at: int, after: int) -> int | None:
    """Start of the URL scheme (two characters or more) that ends at ``at``, not
    before ``after``; each character is looked at once, whatever its length."""
    first = None
    for i in range(at - 1, after - 1, -1):
        c = text[i]
        if "a" <= c <= "z":
            first = i
        elif not ("0" <= c <= "9" or c in "+.-"):
            break
    return first if first is not None and at - first >= 2 else None


def spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, rank of the kind, end, value)`` of all matches, in order."""
    if not _HINT.search(text):
        return []
    out = []
    for kind, pattern, group, least in _COMPILED:
        if kind == "key":
            heads = list(pattern.finditer(text))
            for m, after in zip(heads, [*(h.start() for h in heads[1:]), len(text)]):
                end, value = _key_block(text, m, after)
                out.append((m.start(), _RANK[kind], end, value))
            continue
        if kind == "url":
            after = 0
            for m in pattern.finditer(text):
                start = _scheme(text, m.start(), after)
                if start is not None:
                    out.append((start, _RANK[kind], m.end(), m.group(group)))
                    after = m.end()
            continue
        for m in pattern.finditer(text):
            if len(m.group(group)) >= least:
                out.append((m.start(), _RANK[kind], m.end(), m.group(group)))
    return sorted(out)


def _joined(found) -> str:
    return ",".join(f"{KINDS[r][0]}:{a}:{b}" for a, r, b, _ in found)


_SCHEMA = pa.schema([(T.K1, pa.int64()), (T.K2, pa.int32()), ("doc_id", pa.int64()), ("source", pa.string()),
                     ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
                     ("spans", pa.string()), ("span", pa.list_(pa.string())), ("value", pa.list_(pa.binary()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, arr in T.rows(batches):
        out = []
        for text in arr.to_pylist():
            found = spans(text)
            base = [f for f in found if f[1] < len(BASE)]
            out.append((*(sum(f[1] == i for f in base) for i in range(3)), hashlib.sha256(_joined(base).encode()).hexdigest(),
                        _joined(found), [_joined([f]) for f in found], [hashlib.sha256(f[3].encode()).digest() for f in found]))
        cols = list(zip(*out))
        yield pa.record_batch([*(batch.column(i) for i in range(4)),
                               *(pa.array(c, f.type) for c, f in zip(cols, list(_SCHEMA)[4:]))], schema=_SCHEMA)


def scan(docs: DataFrame, owners: int = OWNERS, copies: int = COPIES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``,
    ``spans``, ``live_spans``, ``n_live`` and ``n_copied``."""
    T.prepare(docs.sparkSession)
    rows = docs.select(*T.key_columns(), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    ddl = (f"{T.K1} bigint, {T.K2} int, doc_id bigint, source string, n_assign bigint, n_access bigint, n_hex bigint, "
           "base_sha256 string, spans string, span array<string>, value array<binary>")
    found = written(rows.mapInArrow(_scan, ddl), "secrets")
    each = (found.filter(F.size("span") > 0).select(T.K1, T.K2, "source", F.explode(F.arrays_zip("span", "value")).alias("s"))
            .select(T.K1, T.K2, "source", "s.span", "s.value"))
    holds = each.select("value", "source", T.K1, T.K2).distinct()
    by_owner = holds.groupBy("value", "source").agg(F.count(F.lit(1)).alias("n"))
    spread = (by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repos"))
              .select("value", ((F.col("owners") >= owners) | (F.col("repos") >= copies)).alias("copied")))
    marked = (each.distinct().join(spread, "value").groupBy(T.K1, T.K2, F.coalesce("source", F.lit("")).alias("s"),
                                                 F.col("source").isNull().alias("no_source"))
              .agg(F.collect_set(F.when(~F.col("copied"), F.col("span"))).alias("live")))
    here = [F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("no_source")]
    out = found.select("*", *here).join(marked, [T.K1, T.K2, "s", "no_source"], "left")
    live = F.filter("span", lambda x: F.array_contains(F.coalesce("live", F.array().cast("array<string>")), x))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                      F.array_join(live, ",").alias("live_spans"), F.size(live).cast("bigint").alias("n_live"),
                      (F.size("span") - F.size(live)).cast("bigint").alias("n_copied"))
