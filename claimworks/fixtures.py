"""The job's two inputs, derived from the order tables of a scale-factor folder.

``prescriber_fact`` has one row per order line (prescriber = customer, drug =
part) and ``city_dim`` six or five rows per nation.  The expressions put in every
edge case the cleaning step knows: null keys, absent counts, odd experience texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import schemas
from claimworks.plans.workspace import fresh_path
from claimworks.sources.readers import read_city_dim, read_prescriber_fact

# Expressions that Spark and a second SQL engine both accept (fixed values).
FACT_COLUMNS = {
    "npi": "case when (l_orderkey + l_linenumber) % 97 = 0 then null else c_custkey end",
    "nppes_provider_last_org_name": "case when c_custkey % 22 = 0 then null else c_name end",
    "nppes_provider_first_name": "case when c_custkey % 11 = 0 then null "
    "else concat('FN', cast(c_custkey % 10 as varchar(10))) end",
    "nppes_provider_city": "concat('CITY ', cast(c_custkey % 4 as varchar(10)))",
    "nppes_provider_state": "case when n_nationkey = 24 then null else n_name end",
    "specialty_description": "c_mktsegment",
    "years_of_exp": "case when c_custkey % 37 = 0 then 'N/A' when c_custkey % 41 = 0 then null "
    "when c_custkey % 5 = 0 then concat(cast((c_custkey * 7) % 60 as varchar(10)), '.0') "
    "else concat('= ', cast((c_custkey * 7) % 60 as varchar(10))) end",
    "drug_name": "case when l_partkey % 53 = 0 then null "
    "else concat('DRUG ', cast(l_partkey as varchar(10))) end",
    "total_claim_count": "case when l_linenumber = 7 or c_custkey % 101 = 0 then null "
    "else cast(l_quantity as int) end",
    "total_day_supply": "cast(l_quantity * 30 as int)",
    "total_drug_cost": "l_extendedprice",
}

CITY_COLUMNS = {
    "city": "concat('City ', cast(k % 5 as varchar(10)))",
    "state_id": "n_name",
    "state_name": "concat('State of ', n_name)",
    "county_name": "concat('County ', cast(k as varchar(10)))",
    "population": "cast(1000 * (n_nationkey + 1) + k as bigint)",
    "zips": "case when (n_nationkey + k) % 13 = 0 then null when (n_nationkey + k) % 13 = 1 then '' "
    "when (n_nationkey + k) % 13 = 2 then '10001  10002' "
    "else substr('10001 10002 10003 10004 10005 10006', 1, 6 * ((n_nationkey + k) % 6 + 1) - 1) end",
}


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in columns.items()]


def derive_city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    numbered = nation.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    kept = numbered.filter((F.col("k") < 5) | (F.col("n_nationkey") % 5 == 0))
    return schemas.conform(kept.selectExpr(*_aliased(CITY_COLUMNS)), schemas.CITY_DIM)


def derive_prescriber_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins the small sides first, so that order lines move only once.

    Lines and orders grow together, so neither is ever broadcast.
    """
    lines, orders, customers, nations = (
        spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("lineitem", "orders", "customer", "nation")
    )
    holders = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    owned = orders.join(holders, F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(owned.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return schemas.conform(rows.selectExpr(*_aliased(FACT_COLUMNS)), schemas.PRESCRIBER_FACT)


_written: dict[tuple[str, str, str], str] = {}


def _written_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """Path of an input, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written or not _exists(spark, _written[key]):
        path = fresh_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path)
    except AnalysisException:
        return False
    return True


def city_path(spark: SparkSession, sf_dir: str) -> str:
    """The city dimension as the parquet file set that a run starts from."""
    return _written_once(
        spark, sf_dir, "city_dim", lambda path: derive_city_dim(spark, sf_dir).write.parquet(path)
    )


def prescriber_path(spark: SparkSession, sf_dir: str) -> str:
    """The prescriber fact, converted to parquet."""
    return _written_once(
        spark, sf_dir, "prescriber_fact",
        lambda path: derive_prescriber_fact(spark, sf_dir).write.parquet(path),
    )


def prescriber_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The prescriber fact as the CSV file set that a run starts from."""
    return _written_once(
        spark, sf_dir, "prescriber_csv",
        lambda path: prescriber_fact(spark, sf_dir).write.csv(path, header=True, nullValue=""),
    )


def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_city_dim(spark, city_path(spark, sf_dir))


def prescriber_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_prescriber_fact(spark, prescriber_path(spark, sf_dir), file_format="parquet")


def prescriber_csv(spark: SparkSession, sf_dir: str, infer: bool = False) -> DataFrame:
    return read_prescriber_fact(spark, prescriber_csv_path(spark, sf_dir), infer=infer)
