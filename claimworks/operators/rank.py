"""Dense ranks within groups of any size.

Equal values share a rank, so ranking the distinct values of a group is enough.
These are few compared with the rows and are reduced before the shuffle; the rows
themselves are never sorted or gathered by group, they look their rank up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_lookup

RANK = "dense_rank"


def value_ranks(rows: DataFrame, group: str, value: str, n: int | None = None) -> DataFrame:
    """Dense rank of each distinct value in its group, highest first, nulls last.

    With ``n``, only the first ``n`` ranks: every task then passes on at most ``n``
    values per group.
    """
    by_value = Window.partitionBy(group).orderBy(F.desc_nulls_last(value))
    ranked = rows.select(group, value).distinct().withColumn(RANK, F.dense_rank().over(by_value))
    return ranked if n is None else ranked.filter(F.col(RANK) <= n)


def with_dense_rank(
    rows: DataFrame, group: str, value: str, n: int | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows with their dense rank in ``group``; with ``n``, the top ``n`` and all ties.

    The null group and null values count like any other.
    """
    lookup = write_lookup(value_ranks(rows, group, value, n), "value-ranks")
    ranks = lookup.frame.select(F.col(group).alias("_group"), F.col(value).alias("_value"), RANK)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    if lookup.fits_broadcast(broadcast_bytes):
        ranks = F.broadcast(ranks)
    return rows.join(ranks, same).drop("_group", "_value")
