"""Building and serving the marts: lake, staging view, fact table, summary, alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.models import (
    portfolio_summary,
    stg_windows,
    volatility_alerts,
    vwap_facts,
)
from tickloom.operators.ordered import positions
from tickloom.operators.quality import enforce, require_unique
from tickloom.schemas import (
    ALERT_CONTRACT,
    FACT_CONTRACT,
    STAGING_CONTRACT,
    SUMMARY_CONTRACT,
    Contract,
)
from tickloom.sources import versioned


@dataclass(frozen=True)
class Marts:
    staged: DataFrame
    facts: DataFrame
    summary: DataFrame
    alerts: DataFrame


def publish_files(df: DataFrame, contract: Contract, path: str) -> DataFrame:
    """Write a relation under its contract as versioned Parquet and return the stored one.

    Every model ends in a shuffle, whose partitions Spark merges to a good file size, so the
    rows are written as they come. A repeated key keeps the previous version current.
    """
    return versioned.publish(
        enforce(df, contract), path, check=lambda stored: require_unique(stored, contract)
    )


def publish_table(df: DataFrame, contract: Contract, database: str) -> DataFrame:
    """Publish a relation under its contract in the catalog and return the published one.

    The name is a view on one of two tables. A refresh writes and checks the other one, and
    only then moves the view: a null or repeated key leaves the old rows readable. A reader
    that has lasted through two refreshes loses its table.
    """
    spark = df.sparkSession
    name = f"{database}.{contract.name}"
    slot = f"{name}__{'b' if _slot(spark, name) == 'a' else 'a'}"
    enforce(df, contract).write.mode("overwrite").saveAsTable(slot)
    require_unique(spark.table(slot), contract)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('slot' = '{slot[-1]}') AS SELECT * FROM {slot}"
    )
    return spark.table(name)


def _slot(spark: SparkSession, name: str) -> str | None:
    """The slot that the published view reads; null before the first publication."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'slot'").collect()
    return rows[0]["value"] if rows else None


def build_marts(lake: DataFrame, root: str) -> Marts:
    """Facts, summary and alerts from the lake, stored under ``root``.

    Staged windows are stored too: the fact model reads them in several branches, each with
    its own few columns, and the de-duplication must not run once per branch.
    """
    staged = publish_files(stg_windows(lake), STAGING_CONTRACT, f"{root}/{STAGING_CONTRACT.name}")
    facts = publish_files(vwap_facts(staged), FACT_CONTRACT, f"{root}/{FACT_CONTRACT.name}")
    summary = publish_files(
        portfolio_summary(facts), SUMMARY_CONTRACT, f"{root}/{SUMMARY_CONTRACT.name}"
    )
    alerts = publish_files(volatility_alerts(facts), ALERT_CONTRACT, f"{root}/{ALERT_CONTRACT.name}")
    return Marts(staged, facts, summary, alerts)


def build_mart_tables(lake: DataFrame, database: str = "marts") -> Marts:
    """The same relations as catalog tables."""
    lake.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    staged = publish_table(stg_windows(lake), STAGING_CONTRACT, database)
    facts = publish_table(vwap_facts(staged), FACT_CONTRACT, database)
    summary = publish_table(portfolio_summary(facts), SUMMARY_CONTRACT, database)
    alerts = publish_table(volatility_alerts(facts), ALERT_CONTRACT, database)
    return Marts(staged, facts, summary, alerts)


_CONTRACTS = (STAGING_CONTRACT, FACT_CONTRACT, SUMMARY_CONTRACT, ALERT_CONTRACT)


def read_marts(spark: SparkSession, database: str = "marts") -> Marts:
    """The published tables, read by qualified name."""
    return Marts(*[spark.table(f"{database}.{contract.name}") for contract in _CONTRACTS])


def current_marts(spark: SparkSession, root: str) -> Marts:
    """The current versions of the relations under ``root``."""
    return Marts(
        *[versioned.current(spark, f"{root}/{c.name}", c.schema) for c in _CONTRACTS]
    )


SUMMARY_ORDER = (("avg_volatility", True), ("symbol", False))
ALERT_ORDER = (("drawdown_pct", True), ("volatility", True), ("symbol", False))


def serve_portfolio(summary: DataFrame, alerts: DataFrame) -> DataFrame:
    """Both marts as one JSON record per row, tagged with the list it belongs to.

    A record per row keeps the export distributed; a server joins the records of a list.
    """

    def records(df: DataFrame, section: str) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"),
            "symbol",
            F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"),
        )

    return records(summary, "portfolio").unionByName(records(alerts, "alerts"))


def serve_in_order(summary: DataFrame, alerts: DataFrame) -> DataFrame:
    """The records with their ``position`` in their list, as a column: files and joins keep no order."""
    places = positions(summary, SUMMARY_ORDER, "position").select(F.lit("portfolio").alias("section"), "symbol", "position")
    places = places.unionByName(
        positions(alerts, ALERT_ORDER, "position").select(F.lit("alerts").alias("section"), "symbol", "position")
    )
    return serve_portfolio(summary, alerts).join(places, ["section", "symbol"])
