"""Operators stay correct when one key holds a third of the rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from grainline.operators import clean as C
from grainline.operators import encode as E
from grainline.plans import profile as PR
from grainline.sinks import batches as BT


def _hot(spark, n=3000):
    rng = np.random.default_rng(11)
    key = np.where(np.arange(n) < n // 3, "hot", np.array([f"k{i % 97}" for i in range(n)]))
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "t": rng.integers(0, 1000, n),
                        "y": rng.normal(size=n).round(6)})
    return spark.createDataFrame(pdf), pdf


def test_dedupe_with_hot_key(spark):
    df, pdf = _hot(spark)
    got = C.dedupe(df, ["key"], "first", ["t", "id"]).toPandas().set_index("key")["id"].to_dict()
    ref = pdf.sort_values(["t", "id"]).drop_duplicates("key").set_index("key")["id"].to_dict()
    assert got == ref


def test_target_encoding_with_hot_key(spark):
    df, pdf = _hot(spark)
    got = E.encode_target(df, ["key"], "y", drop_original=False).toPandas()
    ref = pdf.groupby("key")["y"].mean()
    assert np.allclose(got["key_target_encoded"], got["key"].map(ref))


def test_top_values_with_hot_value(spark):
    df, pdf = _hot(spark)
    top = PR.profile_top_values(df.select("key"), k=3).orderBy(F.desc("count"), "value").collect()
    counts = pdf["key"].value_counts()
    ref = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [(r["value"], r["count"]) for r in top] == ref


def test_request_batches_keep_every_row(spark):
    df, pdf = _hot(spark)
    out = BT.request_batches(df.select("id", "key"), ["key", "id"], 128)
    assert out.agg(F.sum("batch_size")).first()[0] == len(pdf)
