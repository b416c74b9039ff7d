import pytest

from grainline.operators import clean as C


def test_dedupe_first_last_none(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (1, "a", 2), (2, "b", 5), (3, None, 1), (3, None, 2)],
                               "k int, g string, t int")
    first = {tuple(r) for r in C.dedupe(df, ["k", "g"], "first", ["t"]).collect()}
    assert first == {(1, "a", 1), (2, "b", 5), (3, None, 1)}
    last = {tuple(r) for r in C.dedupe(df, ["k", "g"], "last", ["t"]).collect()}
    assert last == {(1, "a", 3), (2, "b", 5), (3, None, 2)}
    none = {tuple(r) for r in C.dedupe(df, ["k", "g"], "none").collect()}
    assert none == {(2, "b", 5)}


def test_text_ops_unicode(spark):
    df = spark.createDataFrame([(1, "  Héllo,\tWörld! 12٣ _x  "), (2, None), (3, "")], "id int, t string")
    out = {r["id"]: r["t"] for r in C.clean_text(df, "t", ["strip", "remove_punctuation", "remove_digits",
                                                          "remove_extra_spaces", "lowercase"]).collect()}
    assert out[1] == "héllo wörld _x"
    assert out[2] is None and out[3] == ""


def test_strftime_translation():
    assert C.strftime_to_spark("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert C.strftime_to_spark("%d/%m/%YT%H") == "dd/MM/yyyy'T'HH"


def test_cast_policies(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "s string")
    assert [r[0] for r in C.cast_columns(df, {"s": "int"}, on_error="null").collect()] == [1, None, None]
    kept = C.cast_columns(df, {"s": "int"}, on_error="keep")
    assert dict(kept.dtypes)["s"] == "string"


def test_text_ops_follow_python_unicode_semantics(spark):
    import re

    from grainline.operators import features as FE
    samples = ["　a b c, d!\x1c", "x\u0085y\t\tz", "é_1٣ ½ !?", "", "   "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "id int, t string")
    strip = {r["id"]: r["t"] for r in C.clean_text(df, "t", ["strip"]).collect()}
    spaces = {r["id"]: r["t"] for r in C.clean_text(df, "t", ["remove_extra_spaces"]).collect()}
    punct = {r["id"]: r["t"] for r in C.clean_text(df, "t", ["remove_punctuation"]).collect()}
    words = {r["id"]: r["t_word_count"] for r in FE.text_features(df, "t", ["word_count"]).collect()}
    for i, t in enumerate(samples):
        assert strip[i] == t.strip()
        assert spaces[i] == re.sub(r"\s+", " ", t)
        assert punct[i] == re.sub(r"[^\w\s]", "", t)
        assert words[i] == len(t.split())
