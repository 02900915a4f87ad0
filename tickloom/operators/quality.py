"""Data-quality tests and contracts of the published relations."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import Contract

# Value rules of windows and facts.
VALUE_RULES = {
    "vwap_positive": ("vwap", lambda c: c > 0),
    "volatility_not_negative": ("volatility", lambda c: c >= 0),
    "drawdown_not_negative": ("drawdown_pct", lambda c: c >= 0),
}
TICK_FIELDS = ("symbol", "price", "size", "ts", "source")


class ContractError(ValueError):
    """A relation does not have the columns, types or key its contract promises."""


def _one_pass(df: DataFrame, relation: str, counters: dict[tuple[str, str], Column]) -> DataFrame:
    """All counters of a relation in one aggregation, turned into one row per check."""
    names = list(counters)
    wide = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())])
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column_name"),
                F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failures"),
            )
            for i, (check, column) in enumerate(names)
        ]
    )
    return wide.select(F.lit(relation).alias("relation"), F.inline(rows))


def row_checks(
    df: DataFrame, relation: str, not_null: Iterable[str], rules: Iterable[str] = ()
) -> DataFrame:
    """Rows with a null where none may be, and rows that break a value rule; one scan for all."""
    counters = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null}
    for rule in rules:
        column, passes = VALUE_RULES[rule]
        counters[(rule, column)] = F.count_if(~passes(F.col(column)))
    return _one_pass(df, relation, counters)


def rules_for(df: DataFrame) -> list[str]:
    """The value rules whose column the relation has."""
    return [rule for rule, (column, _) in VALUE_RULES.items() if column in df.columns]


def unique_check(df: DataFrame, relation: str, key: Iterable[str]) -> DataFrame:
    """Key values that occur more than once; copies merge before the shuffle."""
    key = list(key)
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(relation).alias("relation"),
        F.lit("unique").alias("check"),
        F.lit(",".join(key)).alias("column_name"),
        "failures",
    )


def contract_tests(df: DataFrame, contract: Contract) -> DataFrame:
    """The data tests that a contract lists, and the value rules that apply."""
    checks = row_checks(df, contract.name, contract.tested_not_null, rules_for(df))
    if contract.key:
        return checks.unionByName(unique_check(df, contract.name, contract.key))
    return checks


def dq_report(relations: Iterable[tuple[DataFrame, Contract]], ticks: DataFrame) -> DataFrame:
    """Failures of every data test, value rule and required tick field."""
    parts = [row_checks(ticks, "ticks", TICK_FIELDS)]
    parts += [contract_tests(df, contract) for df, contract in relations]
    return reduce(DataFrame.unionByName, parts)


def _type_name(dtype: T.DataType) -> str:
    return "timestamp" if isinstance(dtype, T.TimestampNTZType) else dtype.simpleString()


def check_schema(df: DataFrame, contract: Contract) -> None:
    """Compares column names, order and types with the contract; needs no Spark job."""
    actual = [(f.name, _type_name(f.dataType)) for f in df.schema]
    wanted = [(f.name, _type_name(f.dataType)) for f in contract.schema]
    if actual != wanted:
        wrong = sorted({f"{n} {t}" for n, t in set(actual) ^ set(wanted)}) or ["column order"]
        raise ContractError(f"{contract.name}: {', '.join(wrong)}")


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` with the contract's guarantees: wrong columns fail now, a null fails the write."""
    check_schema(df, contract)

    def guarded(name: str) -> Column:
        column = F.col(name)
        if name not in contract.required:
            return column
        failure = F.raise_error(F.lit(f"{contract.name}.{name} must not be null"))
        return F.when(column.isNull(), failure).otherwise(column).alias(name)

    return df.select(*[guarded(f.name) for f in contract.schema])


def require_unique(df: DataFrame, contract: Contract) -> None:
    """Fails if a key value of a stored relation repeats."""
    if contract.key and unique_check(df, contract.name, contract.key).first()["failures"]:
        raise ContractError(f"{contract.name}: key {contract.key} is not unique")


def contract_check(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per contract column: promised and actual type, nulls where none may be."""
    actual = {f.name: _type_name(f.dataType) for f in df.schema}
    counters = {
        f.name: F.count_if(F.col(f.name).isNull())
        if f.name in contract.required and f.name in actual
        else F.lit(0)
        for f in contract.schema
    }
    present = df.agg(*[c.cast("bigint").alias(f"c_{n}") for n, c in counters.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(_type_name(f.dataType)).alias("promised_type"),
                F.lit(actual.get(f.name, "missing")).alias("actual_type"),
                F.lit(f.name in contract.required).alias("required"),
                F.col(f"c_{f.name}").alias("null_rows"),
            )
            for f in contract.schema
        ]
    )
    return present.select(F.lit(contract.name).alias("relation"), F.inline(rows)).withColumn(
        "ok", (F.col("promised_type") == F.col("actual_type")) & (F.col("null_rows") == 0)
    )
