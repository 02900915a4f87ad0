from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.operators.models import portfolio_summary, stg_windows, vwap_facts
from tickloom.operators.quality import (
    ContractError,
    check_schema,
    contract_check,
    contract_tests,
    dq_report,
    enforce,
    require_unique,
)
from tickloom.schemas import FACT_CONTRACT, STAGING_CONTRACT, SUMMARY_CONTRACT
from tickloom.session import scratch_path, shared_root
from tickloom.sources.lake import lake_scan, lake_union, load_lake, write_lake
from tickloom.sources import versioned
from tickloom.sources.mirror import mirror_log, mirror_parity, mirror_refresh, mirror_scan, unequal_buckets


@pytest.fixture(scope="module")
def facts(five_rows):
    return vwap_facts(stg_windows(five_rows)).cache()


def test_clean_relations_pass(spark, five_rows, facts):
    ticks = spark.createDataFrame(
        [("A", 1.0, 1.0, None, "s")], "symbol string, price double, size double, ts timestamp, source string"
    )
    relations = [
        (stg_windows(five_rows), STAGING_CONTRACT),
        (facts, FACT_CONTRACT),
        (portfolio_summary(facts), SUMMARY_CONTRACT),
    ]
    failing = [(r.relation, r.column_name) for r in dq_report(relations, ticks).collect() if r.failures]
    assert failing == [("ticks", "ts")]


def test_data_tests_count_failures(facts):
    broken = facts.withColumn("symbol", F.when(F.col("symbol") != "AAPL", F.col("symbol"))).withColumn(
        "vwap", -F.col("vwap")
    )
    got = {(r.check, r.column_name): r.failures for r in contract_tests(broken, FACT_CONTRACT).collect()}
    assert got == {
        ("not_null", "symbol"): 1,
        ("not_null", "vwap"): 0,
        ("not_null", "session_high"): 0,
        ("vwap_positive", "vwap"): 3,
        ("volatility_not_negative", "volatility"): 0,
        ("drawdown_not_negative", "drawdown_pct"): 0,
    }


def test_repeated_key_is_found(facts):
    doubled = portfolio_summary(facts).unionByName(portfolio_summary(facts))
    unique = contract_tests(doubled, SUMMARY_CONTRACT).filter("check = 'unique'").first()
    assert unique.failures == 3
    with pytest.raises(ContractError):
        require_unique(doubled, SUMMARY_CONTRACT)


def test_contract_rejects_wrong_shape(facts):
    check_schema(facts, FACT_CONTRACT)
    for wrong in (
        facts.drop("vwap"),
        facts.withColumn("extra", F.lit(1)),
        facts.withColumn("volatility_rank", F.col("volatility_rank").cast("int")),
        facts.select(*reversed(facts.columns)),
    ):
        with pytest.raises(ContractError):
            enforce(wrong, FACT_CONTRACT)


def test_contract_fails_the_write_on_a_null(spark, facts):
    broken = facts.withColumn("session_high", F.lit(None).cast("double"))
    with pytest.raises(PySparkException, match="session_high must not be null"):
        enforce(broken, FACT_CONTRACT).write.parquet(scratch_path(spark, "broken"))


def test_contract_report(facts):
    broken = facts.withColumn("vwap", F.lit(None).cast("double")).drop("price_range")
    rows = {r.column_name: r for r in contract_check(broken, FACT_CONTRACT).collect()}
    assert (rows["vwap"].null_rows, rows["vwap"].ok) == (3, False)
    assert (rows["price_range"].actual_type, rows["price_range"].ok) == ("missing", False)
    assert rows["symbol"].ok and len(rows) == 13


MIRROR = "symbol string, vwap double, trade_count bigint"


def test_mirror_round_trip(spark):
    lake = spark.createDataFrame([("AAPL", 172.5, 10), ("NVDA", 820.0, 20), ("AAPL", 173.0, 30)], MIRROR)
    path, target = scratch_path(spark, "lake"), scratch_path(spark, "mirror")
    lake.coalesce(1).write.parquet(path)
    stored = spark.read.schema(MIRROR).parquet(path)
    info = mirror_refresh(stored, target)
    assert (info["row_count"], info["files"]) == (3, 1)
    current = mirror_scan(spark, target, stored.schema)
    assert current.count() == 3 and current.filter("symbol = 'AAPL'").count() == 2
    assert mirror_parity(stored, current).first().asDict() == {"only_in_lake": 0, "only_in_mirror": 0}


def test_refresh_replaces_and_may_read_the_mirror(spark):
    path, target = scratch_path(spark, "lake"), scratch_path(spark, "mirror")
    spark.createDataFrame([("A", 1.0, 1)], MIRROR).write.parquet(path)
    stored = spark.read.schema(MIRROR).parquet(path)
    mirror_refresh(stored, target)
    mirror_refresh(stored, target)
    assert mirror_scan(spark, target, stored.schema).count() == 1
    mirror_refresh(mirror_scan(spark, target, stored.schema), target)
    assert mirror_scan(spark, target, stored.schema).count() == 1
    assert mirror_log(spark, target).count() == 3


def test_a_refused_refresh_keeps_the_old_version(spark):
    target = scratch_path(spark, "versioned")
    one = spark.createDataFrame([("A", 1.0, 1)], MIRROR)

    def refuse(stored):
        assert stored.count() == 2
        raise ContractError("refused")

    versioned.publish(one, target)
    with pytest.raises(ContractError):
        versioned.publish(one.unionByName(one), target, check=refuse)
    assert versioned.current(spark, target, one.schema).count() == 1
    versioned.publish(one.unionByName(one), target)
    assert versioned.current(spark, target, one.schema).count() == 2
    assert [r.version for r in versioned.history(spark, target).orderBy("version").collect()] == [1, 2]


def test_nothing_published_yet(spark):
    with pytest.raises(FileNotFoundError):
        versioned.current(spark, scratch_path(spark, "none"), spark.range(1).schema)


def test_parity_counts_copies(spark):
    one = spark.createDataFrame([("A", 1.0, 1)] * 3 + [("B", 1.0, 1)], MIRROR)
    two = spark.createDataFrame([("A", 1.0, 1)] * 2 + [("C", None, 1)], MIRROR)
    assert mirror_parity(one, two).first().asDict() == {"only_in_lake": 2, "only_in_mirror": 1}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_equal_sides_shuffle_no_row(spark):
    one = spark.createDataFrame([(f"S{i % 9}", float(i), i % 5) for i in range(1000)], MIRROR)
    two = one.orderBy(F.desc("vwap")).select(*reversed(one.columns))
    by = F.col("symbol")
    assert unequal_buckets(one, two, by).isEmpty()
    same, other = mirror_parity(one, two, by), mirror_parity(one, one.limit(999), by)
    assert same.first().asDict() == {"only_in_lake": 0, "only_in_mirror": 0}
    assert "Aggregate" not in plan_of(same) and "Aggregate" in plan_of(other)
    assert other.first().asDict() == {"only_in_lake": 1, "only_in_mirror": 0}


def test_differences_are_found_from_the_top(spark):
    rows = [(f"S{i % 9}", float(i), i) for i in range(1000)]
    one = spark.createDataFrame(rows, MIRROR)
    # One value changed, one row missing, one row twice, in three parts.
    other = [("S1", -1.0, 1), *rows[2:17], rows[17], *rows[17:500], *rows[501:], rows[0]]
    two = spark.createDataFrame(other, MIRROR)
    found = unequal_buckets(one, two, F.col("symbol"), 64).collect()
    assert {r.part for r in found} == {"S1", "S8", f"S{500 % 9}"} and 3 <= len(found) <= 4
    want = Counter(rows) - Counter(other), Counter(other) - Counter(rows)
    for by in (None, F.col("symbol")):
        got = mirror_parity(one, two, by).first()
        assert tuple(got) == tuple(sum(w.values()) for w in want) == (2, 2)


def test_parity_tells_nulls_apart_and_takes_empty_sides(spark):
    schema = "a string, b string, part string"
    one = spark.createDataFrame([("x", None, None), (None, "y", None), (None, None, "p")], schema)
    two = spark.createDataFrame([(None, "x", None), (None, "y", None), (None, None, "p")], schema)
    for by in (None, F.col("part")):
        assert tuple(mirror_parity(one, two, by).first()) == (1, 1)
        assert tuple(mirror_parity(one, two.limit(0), by).first()) == (3, 0)
        assert tuple(mirror_parity(one.limit(0), two.limit(0), by).first()) == (0, 0)
    nan = spark.createDataFrame([("A", float("nan"), 1), ("B", 0.0, 1)], MIRROR)
    zero = spark.createDataFrame([("B", -0.0, 1), ("A", float("nan"), 1)], MIRROR)
    assert tuple(mirror_parity(nan, zero).first()) == (0, 0)


def test_empty_lake_is_refused(spark):
    empty = scratch_path(spark, "empty")
    spark.sparkContext._jvm.java.io.File(empty).mkdirs()
    with pytest.raises(FileNotFoundError):
        mirror_refresh(spark.read.schema(MIRROR).parquet(empty), scratch_path(spark, "mirror"))


def test_lake_behind_different_formats(spark, five_rows):
    path = scratch_path(spark, "lake")
    write_lake(five_rows, path)
    five_rows.write.mode("overwrite").saveAsTable("lake_copy")
    five_rows.write.orc(path + "-orc")
    for fmt, source in (("parquet", path), ("table", "lake_copy"), ("orc", path + "-orc")):
        assert load_lake(spark, fmt, source).count() == 5


def test_union_matches_columns_by_name(five_rows):
    both = lake_union(five_rows, five_rows.select(*reversed(five_rows.columns)))
    assert both.count() == 10 and both.select("symbol").distinct().count() == 3


def test_many_roots_read_as_one(spark, five_rows):
    one, two = scratch_path(spark, "lake"), scratch_path(spark, "lake")
    write_lake(five_rows, one)
    write_lake(five_rows, two)
    assert lake_scan(spark, one, two).count() == 10
    assert lake_scan(spark, one, two, first_day="2026-05-11").count() == 0


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
