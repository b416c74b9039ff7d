"""Cases found in review: specs, sources, rules, encodings and sinks that went wrong."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainline.operators import encode as E
from grainline.operators import predicates as P
from grainline.plans import rules as R
from grainline.plans.runner import apply_step, extract_sources, run_spec
from grainline.sinks.writers import write_targets
from grainline.sources import files as SF


def _file(tmp_path, name, body, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(body.encode(encoding))
    return str(path)


# ------------------------------------------------------------------ sources
def test_csv_header_row_number(spark, tmp_path):
    path = _file(tmp_path, "a.csv", "a title line\nid,name\n1,x\n2,y\n")
    out = SF.read_csv(spark, path, header=1)
    assert out.columns == ["id", "name"] and sorted(map(tuple, out.collect())) == [(1, "x"), (2, "y")]


def test_csv_quoted_line_breaks(spark, tmp_path):
    path = _file(tmp_path, "b.csv", 'id,note\n1,"two\nlines"\n2,"say ""hi"""\n3,plain\n')
    want = [(1, "two\nlines"), (2, 'say "hi"'), (3, "plain")]
    assert sorted(map(tuple, SF.read_csv(spark, path).collect())) == want
    path = _file(tmp_path, "c.csv", 'junk\nmore, junk\nid,note\n1,"two\nlines"\n2,"say ""hi"""\n3,plain\n')
    assert sorted(map(tuple, SF.read_csv(spark, path, skip_rows=2).collect())) == want


def test_csv_skip_rows_in_latin_1(spark, tmp_path):
    path = _file(tmp_path, "d.csv", "größe\nid;name\n1;Müller\n2;Ås\n", "latin-1")
    out = SF.read_csv(spark, path, separator=";", encoding="ISO-8859-1", skip_rows=1)
    assert sorted(map(tuple, out.collect())) == [(1, "Müller"), (2, "Ås")]


def test_json_whole_documents_and_lines(spark, tmp_path):
    doc = {"resp": {"data": [{"v": 1}, {"v": 2}]}}
    whole = _file(tmp_path, "e.json", json.dumps(doc, indent=2))
    lines = _file(tmp_path, "f.json", json.dumps(doc) + "\n" + json.dumps(doc) + "\n")
    assert sorted(r["v"] for r in SF.read_json_records(spark, whole, "resp.data").collect()) == [1, 2]
    assert sorted(r["v"] for r in SF.read_json_records(spark, lines, "resp.data").collect()) == [1, 1, 2, 2]


def test_two_sources_of_one_name(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    spec = {"extraction": {"sources": [{"name": "o", "type": "dataframe", "data": df}, {"name": "o", "type": "dataframe", "data": df}]}}
    assert {r["_source"] for r in extract_sources(spark, spec["extraction"]).collect()} == {"o"}
    res = run_spec(spark, spec)
    assert res.success and res.source_rows == {"o": 4}


# ------------------------------------------------------------- specs, sinks
def test_unknown_step_option_raises(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="colums"):
        apply_step(df, {"type": "scale", "colums": ["a"]})
    res = run_spec(spark, {"extraction": {"sources": [{"name": "s", "type": "dataframe", "data": df}]},
                           "transformation": {"steps": [{"type": "scale", "config": {"colums": ["a"]}}]}})
    assert not res.success and "colums" in res.error


def test_named_targets_and_groups(spark, tmp_path):
    df = spark.createDataFrame([(1, "a/b"), (2, "c"), (3, None)], "id int, g string")
    out = write_targets(df, [
        {"name": "flat", "type": "csv", "path": str(tmp_path / "flat"), "include_index": False, "include_header": True},
        {"name": "split", "type": "multiple_files", "base_path": str(tmp_path / "groups"), "group_by": "g", "file_format": "csv"},
        {"name": "p", "type": "parquet", "path": str(tmp_path / "p"), "compression": "snappy"}])
    assert [r["name"] for r in out] == ["flat", "split", "p"] and all(r["ok"] for r in out)
    assert sorted(os.path.basename(x) for x in glob.glob(str(tmp_path / "groups" / "g=*"))) == ["g=a_b", "g=c"]
    assert spark.read.option("header", "true").csv(str(tmp_path / "flat")).count() == 3
    for name in ("flat", "groups", "p"):
        assert os.path.exists(tmp_path / name / "_SUCCESS")
    with pytest.raises(ValueError, match="seperator"):
        write_targets(df, [{"type": "csv", "path": str(tmp_path / "no"), "seperator": ";"}])
    assert not os.path.exists(tmp_path / "no")
    kept = write_targets(df, [{"type": "parchment", "path": "x"}, {"type": "json", "path": str(tmp_path / "j")}], False)
    assert [r["ok"] for r in kept] == [False, True] and spark.read.json(str(tmp_path / "j")).count() == 3


def test_several_targets_compute_the_table_once(spark, tmp_path):
    """Each row passes the plan once, whatever the number of targets; also with a shuffle below."""
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).repartition(3).mapInArrow(tick, "id bigint")
    write_targets(df, [{"type": "parquet", "path": str(tmp_path / x)} for x in "abc"])
    assert seen.value == 1000
    assert all(spark.read.parquet(str(tmp_path / x)).count() == 1000 for x in "abc")


# -------------------------------------------------------------------- rules
def _rule(df, cat, **rule):
    return R.validate(df, {cat: [rule]}).collect()[0]


def test_two_phase_duplicates_match_distinct(spark):
    rng = np.random.default_rng(1)
    rows = [(int(a) if a else None, None if b < 2 else f"k{b}", float("nan") if b == 3 else -0.0 if b == 4 else float(b))
            for a, b in zip(rng.integers(0, 30, 2000), rng.integers(0, 9, 2000))]
    rows += [(None, "x", 1.0), ("x" and 7, None, 1.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    for cols in (["a"], ["a", "b"], ["a", "b", "c"]):
        clean = [F.nanvl("c", F.lit(None).cast("double")) if c == "c" else F.col(c) for c in cols]
        want = df.count() - df.select(*clean).distinct().count()
        got = _rule(df, "quality", type="duplicate_check", columns=cols, allow_duplicates=False)
        assert got["metric"] == want and not got["passed"]
    unique = spark.range(3000)
    assert _rule(unique, "quality", type="duplicate_check", allow_duplicates=False)["passed"]
    for col in "abc":
        want = df.count() - df.select(F.count_distinct(F.nanvl(col, F.lit(None).cast("double")) if col == "c" else F.col(col))).first()[0]
        assert _rule(df, "quality", type="uniqueness", columns=[col])["metric"] == want
    assert _rule(df.limit(0), "quality", type="uniqueness", columns=["a"])["passed"]


def test_hash_collisions_do_not_count_as_duplicates(spark):
    """Nulls are skipped by the hash, so these keys share one; they are told apart."""
    df = spark.createDataFrame([(5, None), (None, 5), (5, None)], "a bigint, b bigint")
    assert df.select(F.xxhash64("a", "b")).distinct().count() == 1
    assert _rule(df, "quality", type="duplicate_check", allow_duplicates=False)["metric"] == 1


def test_approximate_uniqueness_within_its_error(spark):
    ids = spark.range(50_000)
    assert _rule(ids, "quality", type="uniqueness", columns=["id"], approximate=True)["passed"]
    assert not _rule(ids.select((F.col("id") % 40_000).alias("id")), "quality", type="uniqueness", columns=["id"], approximate=True)["passed"]


def test_patterns_are_those_of_the_engine(spark):
    df = spark.createDataFrame([("état",), ("ab",)], "s string")
    assert _rule(df, "quality", type="regex_pattern", columns=["s"], pattern=r"\p{L}+$")["passed"]
    assert _rule(df, "quality", type="regex_pattern", columns=["s"], pattern=r"(?P<n>é|a).*\Z")["passed"]
    both = R.validate(df, {"quality": [{"type": "regex_pattern", "columns": ["s"], "pattern": "(?<=a+)b"},
                                       {"type": "regex_pattern", "columns": ["s"], "pattern": "("},
                                       {"type": "null_check", "columns": ["s"]}]}).collect()
    assert not both[1]["passed"] and both[2]["passed"]


def test_schema_rules_take_no_job(spark):
    def boom(batches):
        raise RuntimeError("read")
        yield from batches
    df = spark.range(3).mapInArrow(boom, "id bigint")
    out = R.validate(df, {"schema": [{"type": "required_columns", "columns": ["id"]}, {"type": "column_count", "exact": 1},
                                     {"type": "column_types", "types": {"id": "int"}}]}).collect()
    assert all(r["passed"] for r in out)


# ---------------------------------------------------------------- operators
def test_in_filter_over_numbers_and_text(spark):
    df = spark.createDataFrame([("1", 1), ("x", 2), (None, None)], "s string, n int")
    assert [r["s"] for r in P.filter_rows(df, "s", "in", [1, 2]).collect()] == ["1"]
    assert [r["n"] for r in P.filter_rows(df, "n", "in", ["2", "abc"]).collect()] == [2]
    assert [r["n"] for r in P.filter_rows(df, "n", "in", list(range(2, 12_000))).collect()] == [2]
    assert [r["s"] for r in P.filter_rows(df, "s", "in", list(range(12_000))).collect()] == ["1"]


def test_onehot_names_that_exist_and_sparse_form(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "c string, c_x int")
    with pytest.raises(ValueError, match="c_x"):
        E.encode_onehot(df, ["c"])
    wide = spark.range(20_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"), "id")
    wide = wide.union(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    got = {r["id"]: r["k_onehot"] for r in E.encode_onehot_sparse(wide, ["k"]).collect()}
    assert all(got[i]["index"] == i and got[i]["size"] == 20_000 for i in range(20_000)) and got[-1]["index"] is None
    small = {r["c_x"]: tuple(r["c_onehot"]) for r in apply_step(df, {"type": "encode", "config": {
        "columns": ["c"], "sparse": True, "drop_first": True}}).collect()}
    assert small == {1: (1, None), 2: (1, 0), 3: (1, None)}


def test_forest_on_an_empty_table(spark):
    from grainline.operators import forest
    df = spark.createDataFrame([], "id int, x double, y double")
    out = forest.fit_isolation_forest(df, ["x", "y"], n_trees=5).transform(df)
    assert out.count() == 0 and "is_outlier" in out.columns


def test_scores_of_many_features_in_blocks(spark, monkeypatch):
    """Features cut into blocks score as they do together."""
    from grainline.operators import selection as S
    rng = np.random.default_rng(5)
    X = rng.normal(size=(120, 30))
    df = spark.createDataFrame([(*map(float, r), int(i % 3)) for i, r in enumerate(X)],
                               ", ".join(f"c{i} double" for i in range(30)) + ", y int")
    def scores():
        return [sorted(map(tuple, f.collect())) for f in (S.variance_scores(df, None, "y"), S.anova_f_scores(df, "y"),
                                                          S.regression_f_scores(df, "y"))]
    whole = scores()
    monkeypatch.setattr(S, "BLOCK", 7)
    for a, b in zip(whole, scores()):
        assert [r[0] for r in a] == [r[0] for r in b] and np.allclose([r[1] for r in a], [r[1] for r in b])
    assert len(whole[0]) == 30 and S.variance_scores(df, ["none"]).count() == 0


def test_pages_behind_the_stop_are_not_parsed(spark, monkeypatch):
    """A stop in a later window; pages behind it may hold anything."""
    from grainline.sources import misc as M
    monkeypatch.setattr(M, "FIRST_WINDOW", 4)
    rows = [(p, json.dumps({"data": [{"v": p * 10 + i} for i in range(10)]})) for p in range(1, 21)]
    rows += [(21, json.dumps({"data": [{"v": 210}]})), (22, '{"data": [{"v": "text", "w": 1}'), (23, "no json at all")]
    pages = spark.createDataFrame(rows, "page bigint, body string")
    out = M.paged_records(pages, "data", page_size=10)
    assert out.columns == ["v"] and sorted(r["v"] for r in out.collect()) == list(range(10, 211))
    assert M.paged_records(pages, "data", page_size=10, max_pages=3).count() == 30
    assert M.paged_records(pages, "data", page_size=10, paginate=False).count() == 10
    assert M.paged_records(pages.where("page <= 20"), "data", page_size=10).count() == 200
