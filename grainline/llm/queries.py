"""Registered queries of this subpackage: thin digests of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    T.prepare(spark)
    return T.table(spark, sf_dir, "documents")


@query("op8_ngram_jaccard_join")
def op8(spark, sf_dir):
    from .ngram_join import jaccard_components
    return jaccard_components(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query("op9_language_id")
def op9(spark, sf_dir):
    from .language import identify
    return identify(_documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


# the words of a line in DuckDB, fields masked; the tree's leaf is (n, head)
_OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, string_split(text, chr(10))[i] AS body
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
w AS (
  SELECT doc_id, line, list_filter(string_split_regex(
    regexp_replace(body, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM l),
t AS (SELECT doc_id, line, words, len(words) AS n, words[1:4] AS head FROM w WHERE len(words) > 0),
u AS (SELECT n, head, words, count(DISTINCT doc_id) AS docs FROM t GROUP BY ALL),
c AS (SELECT n, head, words, docs, unnest(range(1, n + 1)) AS pos FROM u),
s AS (SELECT n, head, pos, words[pos] AS word FROM c GROUP BY ALL HAVING sum(docs) >= 10),
m AS (SELECT c.n, c.head, c.words, c.pos, c.words[c.pos] AS word,
        s.word IS NOT NULL AND c.words[c.pos] <> '<*>' AS fixed
      FROM c LEFT JOIN s ON c.n = s.n AND c.head = s.head AND c.pos = s.pos AND c.words[c.pos] = s.word),
p AS (SELECT n, head, words, CASE WHEN sum(fixed::INT) * 100 >= n * 60
        THEN list(CASE WHEN fixed THEN word ELSE '<*>' END ORDER BY pos) ELSE words END AS template
      FROM m GROUP BY n, head, words),
f AS (SELECT t.doc_id, t.line, t.n, t.head, p.template FROM t JOIN p ON t.n = p.n AND t.head = p.head AND t.words = p.words),
r AS (SELECT n, head, template, min(doc_id) AS first_doc FROM f GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
g AS (SELECT f.doc_id, f.line FROM f JOIN r ON f.n = r.n AND f.head = r.head AND f.template = r.template
      WHERE f.doc_id <> r.first_doc)
SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
  md5(coalesce(string_agg(l.body, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '')) AS kept_md5
FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id
"""


@query("op1_line_dedup", _OP1_SQL)
def op1(spark, sf_dir):
    from .line_dedup import drop_lines
    return drop_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


_OP2_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~',
    'abcdefghijklmnopqrstuvwxyz' || repeat(' ', 32)), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~',
    'abcdefghijklmnopqrstuvwxyz' || repeat(' ', 32)), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM bs GROUP BY item_id)
SELECT ds.doc_id, bs.item_id, any_value(n_item_shingles) AS n_item_shingles, count(*) AS n_shared
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY ds.doc_id, bs.item_id
HAVING count(*) * 100 >= 75 * any_value(n_item_shingles)
"""


@query("op2_benchmark_decontamination", _OP2_SQL)
def op2(spark, sf_dir):
    from .decontaminate import contaminated
    return contaminated(_documents(spark, sf_dir), T.table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_item_shingles", "n_shared")


@query("op10_source_mixing")
def op10(spark, sf_dir):
    from .mixing import mix_sources
    return mix_sources(_documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


@query("op5_substring_dedup")
def op5(spark, sf_dir):
    from .substring import dedup_substrings
    return dedup_substrings(_documents(spark, sf_dir), texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_quality_rules")
def op3(spark, sf_dir):
    from .quality import judge
    return judge(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query("op4_token_counts")
def op4(spark, sf_dir):
    from .token_counts import histogram, lengths
    return histogram(lengths(_documents(spark, sf_dir)))


@query("op6_secret_scan")
def op6(spark, sf_dir):
    from .secrets import scan
    return scan(_documents(spark, sf_dir))


@query("op7_toxicity")
def op7(spark, sf_dir):
    from .toxicity import score
    return score(_documents(spark, sf_dir), T.table(spark, sf_dir, "labels"))


# CRC-32 in DuckDB: the table from its polynomial, then a fold over the bytes of the UTF-8 text
_CRC_TABLE = """
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


_OP11_SQL = f"""
WITH {_CRC_TABLE},
d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS body, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size FROM documents),
h AS MATERIALIZED (SELECT doc_id, size, list_transform(string_split(hex(encode(body)), ''), lambda c: strpos('0123456789ABCDEF', c) - 1) AS x FROM d),
b AS MATERIALIZED (SELECT doc_id, size, list_transform(range(1, 2 * (size - 16), 2), lambda i: x[i] * 16 + x[i + 1]) AS octets FROM h),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, octets),
        lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, crc),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM c),
s AS (SELECT *, ((2 * before + size) * 40 // (2 * total))::INTEGER AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard FROM s
"""


@query("op11_histogram_shards", _OP11_SQL)
def op11(spark, sf_dir):
    from .sharding import shard_documents
    return shard_documents(_documents(spark, sf_dir))


def _op12_sql(tree_levels: int = 8, top_levels: int = 3) -> str:
    """The manifest with its levels unrolled: trees of up to 8 ** 8 rows, up to 8 ** 3 languages."""
    def field(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(({x})::VARCHAR)) || ':' || ({x})::VARCHAR END"

    def leaf(text):
        return "sha256(concat(" + ", ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + "))"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    id_bytes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c))"
    parts = [_CRC_TABLE.strip(), f"""d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf,
  CASE WHEN xor(list_reduce(list_prepend(4294967295, {id_bytes}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 3 = 0
    THEN {leaf(lower)} ELSE {leaf('text')} END AS checked FROM documents, crc)""",
             "n0 AS MATERIALIZED (SELECT doc_id, tree, leaf AS h, checked, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i FROM d)",
             "c0 AS MATERIALIZED (SELECT doc_id, tree, h AS leaf, i, checked AS f, '' AS proof FROM n0)"]

    def climb(nodes, climbers, k, tree):
        n, c = f"{nodes}{k}", f"{climbers}{k}"
        parts.append(f"""{nodes}{k + 1} AS MATERIALIZED (SELECT tree, i // 8 AS i,
  CASE WHEN any_value(most) = 0 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM (SELECT *, max(i) OVER (PARTITION BY tree) AS most FROM {n}) GROUP BY tree, i // 8)""")
        parts.append(f"""{climbers}{k + 1} AS MATERIALIZED (SELECT c.*  REPLACE (c.i // 8 AS i,
    CASE WHEN g.most = 0 THEN c.f ELSE sha256(g.l || c.f || g.r) END AS f, c.proof || g.l || g.r AS proof)
  FROM {c} c JOIN (SELECT tree, i, max(i) OVER (PARTITION BY tree) AS most,
      coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {n}) g ON g.tree = c.{tree} AND g.i = c.i)""")

    for k in range(tree_levels):
        climb("n", "c", k, "tree")
    last = tree_levels
    parts.append(f"s0 AS MATERIALIZED (SELECT 'top' AS tree, tree AS lang, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM n{last})")
    parts.append(f"""t0 AS MATERIALIZED (SELECT doc_id, 'top' AS tree, leaf, s0.h AS subroot, s0.i AS i, f, proof
  FROM c{last} c JOIN s0 ON s0.lang = c.tree)""")
    for k in range(top_levels):
        climb("s", "t", k, "tree")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, s.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = s.h AS verified
FROM t{top_levels} CROSS JOIN s{top_levels} s"""


@query("op12_merkle_manifest", _op12_sql())
def op12(spark, sf_dir):
    from .manifest import manifest
    return manifest(_documents(spark, sf_dir))


_OP13_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_inner_product(a.z, b.z)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) <= 10
"""


@query("op13_hard_negatives", _OP13_SQL)
def op13(spark, sf_dir):
    from .negatives import mine
    T.prepare(spark)
    return mine(T.table(spark, sf_dir, "embeddings"))
