"""The city report and the prescriber report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks import schemas
from claimworks.functions import token_count
from claimworks.operators.impute import city_totals, impute_trx, prescriber_totals
from claimworks.operators.rank import RANK, with_dense_rank
from claimworks.plans.workspace import write_table

ROW, PRESCRIBER = "row", "prescriber"


def add_zip_counts(city: DataFrame) -> DataFrame:
    return city.withColumn("zip_counts", token_count("zips"))


def city_prescriber_agg(rows: DataFrame) -> DataFrame:
    """Distinct prescribers and claims per (state, city), from prepared rows.

    Rows are first summed per prescriber, which makes the distinct count a plain
    count and lets missing claims be filled in on sums: one pass over five columns
    of the fact, and no raw row is shuffled.
    """
    return city_totals(rows, "presc_state", "presc_city").groupBy("presc_state", "presc_city").agg(
        F.count(F.lit(1)).alias("presc_counts"), F.sum("trx_cnt").alias("trx_counts")
    )


def city_join(city: DataFrame, counts: DataFrame) -> DataFrame:
    """Cities that have prescribers.  A city listed twice is reported twice."""
    same_city = (F.col("state_id") == F.col("presc_state")) & (F.col("city") == F.col("presc_city"))
    return city.join(counts, same_city)


def city_report(city: DataFrame, rows: DataFrame) -> DataFrame:
    """Zips, distinct prescribers and total claims of each city with a prescriber.

    Takes the clean city dimension and prepared (or already imputed) fact rows.
    """
    joined = city_join(add_zip_counts(city), city_prescriber_agg(rows))
    return joined.select(schemas.CITY_REPORT.names)


def in_experience_range(rows: DataFrame, low: int = 20, high: int = 50) -> DataFrame:
    """Rows with ``low`` to ``high`` whole years, both included; unknown years fail.

    As a distance from the middle: the filter moves down to the scan, where two bounds
    would parse the experience text twice.
    """
    off_middle = F.abs(2 * F.col("years_of_exp").cast("long") - (low + high))
    return rows.filter(off_middle <= high - low)


def totals_by_prescriber(rows: DataFrame) -> DataFrame:
    """Claims, days and cost per prescriber, missing claims filled in on sums."""
    totals = prescriber_totals(
        rows, "presc_fullname", "presc_state", "country_name", "years_of_exp",
        total_day_supply=F.sum("total_day_supply"),
        total_drug_cost=F.sum("total_drug_cost"),
    )
    return totals.select(schemas.PRESCRIBER_TOTALS.names)


def top_prescribers(
    rows: DataFrame, n: int = 5, low: int = 20, high: int = 50, grain: str = ROW
) -> DataFrame:
    """Rows with the ``n`` highest claim counts of each state, all ties kept.

    ``grain='row'`` ranks prescriber-drug rows, ``grain='prescriber'`` ranks
    prescribers by their total.  Takes prepared (or already imputed) fact rows.

    The rows that are ranked are kept as a table of the report's columns, so ranks and rows
    come from that: the fact is read once for the means and once (twice if the means are
    too large to be broadcast) for the table.
    """
    if grain == ROW:
        ranked = in_experience_range(impute_trx(rows), low, high)
        ranked = write_table(ranked.select(schemas.PRESCRIBER_REPORT.names), "ranked-rows")
    elif grain == PRESCRIBER:
        ranked = in_experience_range(totals_by_prescriber(rows), low, high)
    else:
        raise ValueError(f"grain must be {ROW!r} or {PRESCRIBER!r}, not {grain!r}")
    ranked = ranked.select(schemas.PRESCRIBER_REPORT.names)
    return with_dense_rank(ranked, "presc_state", "trx_cnt", n).drop(RANK)


# The city report as one SQL text over the raw inputs {city} and {fact}.
CITY_REPORT_SQL = """
with claims as (
  select npi, nppes_provider_state as state, nppes_provider_city as city,
         sum(total_claim_count) as known_claims,
         count(total_claim_count) as known_rows,
         count_if(total_claim_count is null) as missing_rows
  from {fact}
  where npi is not null and drug_name is not null
  group by npi, nppes_provider_state, nppes_provider_city
), with_mean as (
  select *, cast(round(try_divide(sum(known_claims) over prescriber,
                                  sum(known_rows) over prescriber)) as int) as mean_claims
  from claims
  window prescriber as (partition by npi)
), per_city as (
  select state, city, count(*) as presc_counts,
         sum(case when known_rows = 0 then missing_rows * mean_claims
                  else known_claims + coalesce(missing_rows * mean_claims, 0) end) as trx_counts
  from with_mean
  group by state, city
)
select upper(d.city) as city, upper(d.state_name) as state_name,
       upper(d.county_name) as county_name, d.population,
       size(split(d.zips, ' ')) as zip_counts, c.trx_counts, c.presc_counts
from {city} d join per_city c on d.state_id = c.state and upper(d.city) = c.city
"""


def city_report_sql(city: DataFrame, fact: DataFrame) -> DataFrame:
    return city.sparkSession.sql(CITY_REPORT_SQL, city=city, fact=fact)
