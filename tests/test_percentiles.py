"""Percentiles from kept sketches against sorted lists."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import percentiles

GROUPS = {
    "hot": np.random.default_rng(3).lognormal(0, 2, 20_000),
    "run": np.concatenate([np.full(9000, 5.0), np.random.default_rng(4).random(9000) * 10]),
    "ties": np.repeat([1.0, 2.0, 3.0], 700),
    "two": np.array([1.0, 10.0]),
    "one": np.array([4.0]),
}
PS = (50, 95, 99, 0, 100)


def rows_of(spark, groups):
    rows = [(g, i % 3, float(v)) for g, values in groups.items() for i, v in enumerate(values)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["g", "day", "v"])).repartition(8)


@pytest.mark.parametrize(("size", "few"), [(64, 50), (1024, 8192)])
def test_days_merge_and_brackets_narrow_to_the_exact_value(spark, monkeypatch, size, few):
    monkeypatch.setattr(percentiles, "GATHERED", few)
    df = rows_of(spark, GROUPS)
    sketches = percentiles.value_sketches(df, ["g", "day"], "v", size)
    assert sketches.count() == 3 + 3 + 3 + 2 + 1
    got = {r.g: r for r in percentiles.exact_percentiles(df, sketches, "g", "v", PS, size).collect()}
    assert set(got) == set(GROUPS)
    for g, values in GROUPS.items():
        assert got[g].row_count == len(values)
        assert [got[g][f"p{p}"] for p in PS] == pytest.approx(list(np.percentile(values, PS)), rel=1e-12)


def test_nulls_are_no_values_and_a_null_group_is_one(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), (None, 7.0), ("n", float("nan")), ("n", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    sketches = percentiles.value_sketches(df, ["g"], "v")
    got = {r.g: (r.row_count, r.p50) for r in percentiles.exact_percentiles(df, sketches, "g", "v", (50,)).collect()}
    assert got == {"a": (2, 2.0), None: (2, 6.0)}
    none = df.limit(0)
    assert percentiles.exact_percentiles(none, percentiles.value_sketches(none, ["g"], "v"), "g", "v").count() == 0


def test_sketches_of_other_rows_are_refused(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "GATHERED", 10)
    df = rows_of(spark, {"a": np.arange(200.0)})
    sketches = percentiles.value_sketches(df, ["g"], "v")
    with pytest.raises(ValueError, match="not of these rows"):
        percentiles.exact_percentiles(df.filter(F.col("v") < 100), sketches, "g", "v", (99,)).collect()
