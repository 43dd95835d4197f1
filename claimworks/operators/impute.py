"""Missing claim counts become the prescriber's rounded mean.

A window over the rows of a prescriber would move and sort every row, and put all
rows of one prescriber into one task.  Means are aggregated instead (partial sums
before the shuffle) and brought back to the rows, or sums, that lack a count.

Filling in twice changes nothing: afterwards a prescriber has a count in every row
or in none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from claimworks.plans.membership import key_bitmap, with_membership
from claimworks.plans.workspace import Lookup, write_lookup, write_table

PRESCRIBER = "presc_id"
CLAIMS = "trx_cnt"
_MEAN = "mean_claims"
_LACKS = "lacks_claims"


def _rounded_mean(total: Column, rows: Column) -> Column:
    return F.round(F.try_divide(total, rows)).cast("int")


def claim_sums(rows: DataFrame, *keys: str, **more: Column) -> DataFrame:
    """Per prescriber and ``keys``: reported claims, rows with and without a count."""
    return rows.groupBy(PRESCRIBER, *keys).agg(
        F.sum(CLAIMS).alias("known_claims"),
        F.count(CLAIMS).alias("known_rows"),
        F.count_if(F.col(CLAIMS).isNull()).alias("missing_rows"),
        *[column.alias(name) for name, column in more.items()],
    )


def claim_means(sums: DataFrame) -> DataFrame:
    """Mean of each prescriber that has rows of both kinds.

    Takes :func:`claim_sums` with one row per prescriber.
    """
    return sums.filter((F.col("missing_rows") > 0) & (F.col("known_rows") > 0)).select(
        PRESCRIBER, _rounded_mean(F.col("known_claims"), F.col("known_rows")).alias(_MEAN)
    )


def _sums_per_prescriber(sums: DataFrame) -> DataFrame:
    names = ("known_claims", "known_rows", "missing_rows")
    return sums.groupBy(PRESCRIBER).agg(*[F.sum(name).alias(name) for name in names])


def _with_total(sums: DataFrame, mean: Column) -> DataFrame:
    """The claim total that imputed rows would add up to, in place of the sums."""
    filled = F.col("missing_rows") * mean
    total = F.when(F.col("known_rows") == 0, filled).otherwise(
        F.col("known_claims") + F.coalesce(filled, F.lit(0))
    )
    return sums.withColumn(CLAIMS, total).drop("known_claims", "known_rows", "missing_rows")


def city_totals(rows: DataFrame, state: str, city: str) -> DataFrame:
    """Imputed claim total of each prescriber in each city.

    Rows are summed before the first shuffle.  What a window then gathers for one
    prescriber is a line per city: limited by the number of cities, however many
    rows the prescriber has.
    """
    sums = claim_sums(rows, state, city)
    everywhere = Window.partitionBy(PRESCRIBER)
    mean = _rounded_mean(
        F.sum("known_claims").over(everywhere), F.sum("known_rows").over(everywhere)
    )
    return _with_total(sums.withColumn(_MEAN, mean), F.col(_MEAN)).drop(_MEAN)


def prescriber_totals(
    rows: DataFrame, *keys: str, broadcast_bytes: int | None = None, **more: Column
) -> DataFrame:
    """Imputed claim total of each prescriber and ``keys``, with ``more`` aggregates.

    Nothing limits how many names or states a (placeholder) prescriber number comes
    with, so means are joined, not windowed.  Sums are kept as a table, which makes it
    one pass over the fact; so are means, because the adaptive skew join splits a
    busy number only if neither side of the join is an aggregation itself.
    """
    sums = write_table(claim_sums(rows, *keys, **more), "claim-sums")
    means = write_lookup(claim_means(_sums_per_prescriber(sums)), "claim-means")
    joined = _join_means(sums, means, broadcast_bytes)
    return _with_total(joined, F.col(_MEAN)).drop(_MEAN)


def _join_means(rows: DataFrame, means: Lookup, broadcast_bytes: int | None) -> DataFrame:
    frame = F.broadcast(means.frame) if means.fits_broadcast(broadcast_bytes) else means.frame
    return rows.join(frame, PRESCRIBER, "left")


def impute_trx(rows: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Rows with missing claim counts filled in.

    Runs one narrow pass for the means.  If they are measured to be small, rows get
    theirs without any shuffle.  Otherwise a second pass parts the rows into two work tables: those
    that lack a count and may have a mean, by a bitmap of the prescribers that have one, and all others.
    Only the former are shuffled; those of one busy prescriber are split by the adaptive skew join.
    Either way the rows' source is read twice.
    """
    counted = Observation()
    found = claim_means(claim_sums(rows)).observe(counted, F.count(F.lit(1)).alias("means"))
    means = write_lookup(found, "claim-means")
    columns = [
        F.coalesce(CLAIMS, _MEAN).alias(CLAIMS) if name == CLAIMS else F.col(name)
        for name in rows.columns
    ]
    if means.fits_broadcast(broadcast_bytes):
        return _join_means(rows, means, broadcast_bytes).select(columns)
    bitmap, bits = key_bitmap(means.frame, PRESCRIBER, counted.get["means"])
    lacking = F.when(F.col(CLAIMS).isNull(), F.col(PRESCRIBER))
    parted = with_membership(rows, lacking, bitmap, bits, _LACKS)
    parted = write_table(parted, "claim-rows", by=_LACKS)
    complete = parted.filter(~F.col(_LACKS)).select(rows.columns)
    filled = _join_means(parted.filter(_LACKS).select(rows.columns), means, broadcast_bytes)
    return complete.unionByName(filled.select(columns))
