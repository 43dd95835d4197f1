"""Checks on frames and loaded tables, as frames that Spark computes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks import schemas


def row_counts(frames: dict[str, DataFrame], name_column: str = "frame_name") -> DataFrame:
    """One row per frame with its number of rows, in one job."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias(name_column), "row_count"
        )
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def column_profile(frame: DataFrame) -> DataFrame:
    """Position, type, rows and nulls of each column, in one pass."""
    counts = frame.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array(*[F.count(name) for name in frame.columns]).alias("filled"),
    )
    described = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                "row_count",
                (F.col("row_count") - F.col("filled")[position]).alias("null_count"),
            )
            for position, field in enumerate(frame.schema)
        ]
    )
    return counts.select(F.inline(described))


# Sketch sizes: the standard error of distinct counts is about 1.04 / sqrt(2 ** DISTINCT_LOG), the
# rank error of quantiles about 1 / ACCURACY.
DISTINCT_LOG = 12
ACCURACY = 1000
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def sketch_profile(frame: DataFrame) -> DataFrame:
    """Per column: rows, nulls, a sketch of its distinct values with their estimated number and, for numbers,
    five quantiles, in one pass.

    Every aggregate is merged from partial ones of bounded size, whatever the number of values: exact distinct
    counts would shuffle each column's values.  Sketches of several frames are united by
    :func:`merged_distinct`, so a profile of all runs needs no look at old rows.
    """
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    described = []
    for position, field in enumerate(frame.schema):
        column, at = F.col(f"`{field.name}`"), str(position)
        numeric = isinstance(field.dataType, _NUMBERS)
        aggregates += [
            F.count(column).alias(f"filled_{at}"), F.hll_sketch_agg(column.cast("string"), DISTINCT_LOG).alias(f"sketch_{at}"),
        ]
        quantiles = F.lit(None).cast("array<double>")
        if numeric:
            number = column.cast("double")
            aggregates.append(F.percentile_approx(number, list(QUANTILES), ACCURACY).alias(f"quantiles_{at}"))
            quantiles = F.col(f"quantiles_{at}")
        described.append(
            F.struct(
                F.lit(position).alias("position"), F.lit(field.name).alias("column_name"), "row_count",
                (F.col("row_count") - F.col(f"filled_{at}")).alias("null_count"),
                F.col(f"sketch_{at}").alias("sketch"),
                F.hll_sketch_estimate(f"sketch_{at}").alias("distinct_count"), quantiles.alias("quantiles"),
            )
        )
    return frame.agg(*aggregates).select(F.inline(F.array(*described)))


def merged_distinct(profiles: DataFrame) -> DataFrame:
    """column_name, rows, nulls and distinct count over all frames whose profiles are given, from the
    sketches alone."""
    united = profiles.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return united.select(
        "column_name", "row_count", "null_count", F.hll_sketch_estimate("sketch").alias("distinct_count")
    )


def require_contract(frame: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """The frame itself; raises if its columns are not those of the contract."""
    problems = schemas.contract_violations(frame, schema)
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))
    return frame


def preview(frame: DataFrame, keys: list, n: int = 10) -> DataFrame:
    """The first ``n`` rows by ``keys``, so that two previews agree."""
    return frame.orderBy(*keys).limit(n)


def table_names(names: str | list[str]) -> list[str]:
    """``'a, b'`` or a list, without blanks around the names."""
    parts = names.split(",") if isinstance(names, str) else names
    return [part.strip() for part in parts]


def require_rows(counts: DataFrame, name_column: str) -> DataFrame:
    """Counts as they are; the query fails if one of them is 0, whatever it selects."""
    failure = F.raise_error(
        F.concat(F.lit("data quality check failed: no rows in "), F.col(name_column))
    )
    # a filter, because a failing column would be pruned where it is not selected
    return counts.filter(F.when(F.col("row_count") > 0, True).otherwise(failure.cast("boolean")))


def loaded_tables(spark: SparkSession, names: str | list[str]) -> DataFrame:
    """Row count per loaded table; the query fails on an empty one."""
    tables = {name: spark.table(name) for name in table_names(names)}
    return require_rows(row_counts(tables, "table_name"), "table_name")
