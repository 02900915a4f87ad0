"""Where no side is small enough to broadcast, Spark splits the hot key of a join at run time."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators.dashboard import value_percentiles
from tickloom.operators.models import vwap_facts
from tickloom.operators.positions import position_pnl
from tickloom.session import store

# As if tables were large: nothing is broadcast, and a partition counts as large early.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 300_000


@pytest.fixture
def large(spark):
    before = {key: spark.conf.get(key, None) for key in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    rows = df.toPandas()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("Initial Plan")[0]


def test_trades_of_one_symbol(large):
    i = F.col("id")
    trades = large.range(ROWS).repartition(16).select(
        F.lit("BUY").alias("event_type"),
        F.when(i % 3 == 0, F.lit(7)).otherwise(i % 20000).alias("symbol"),
        i.alias("shares"),
        (i % 99 + 1.0).alias("price"),
        F.concat(F.lit("P-"), i).alias("portfolio_id"),
    )
    positions = large.range(20000).select(
        F.col("id").alias("symbol"), F.lit(1).cast("bigint").alias("total_shares"), F.lit(2.0).alias("avg_cost")
    )
    rows, plan = final_plan(position_pnl(trades, positions))
    assert len(rows) == ROWS and "SortMergeJoin(skew=true)" in plan


def test_windows_with_one_start_and_equal_volatility(large):
    i = F.col("id")
    at_start = i % 3 == 1
    windows = store(
        large.range(ROWS).repartition(16).select(
            F.concat(F.lit("S"), F.when(i % 3 == 0, F.lit(0)).otherwise(i)).alias("symbol"),
            F.timestamp_seconds(F.when(at_start, F.lit(0)).otherwise(i * 300)).alias("window_start"),
            F.timestamp_seconds(F.lit(300)).alias("window_end"),
            (100 + i % 77).cast("double").alias("vwap"),
            F.lit(90.0).alias("min_price"),
            (120 + i % 991).cast("double").alias("max_price"),
            F.when(i % 3 < 2, F.lit(0.0)).otherwise((i % 1000) / 1000.0).alias("volatility"),
            F.lit(1.0).alias("price_range"),
            F.lit(5).cast("bigint").alias("trade_count"),
            F.lit(100.0).alias("total_volume"),
        ),
        "skewed",
    )
    rows, plan = final_plan(vwap_facts(windows))
    assert len(rows) == ROWS and rows["volatility_rank"].notna().all()
    assert "SortMergeJoin(skew=true)" in plan


def test_values_of_one_group(large):
    i = F.col("id")
    values = large.range(ROWS).repartition(16).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), i % 5000)).alias("g"),
        i.cast("double").alias("v"),
    )
    rows, plan = final_plan(value_percentiles(values, "g", "v", (50,), accuracy=1000))
    hot = rows[rows["g"] == "hot"].iloc[0]
    assert (hot["row_count"], hot["p50"]) == (ROWS // 3, (ROWS - 3) / 2)
    assert "SortMergeJoin(skew=true)" in plan
