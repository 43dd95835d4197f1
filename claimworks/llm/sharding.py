"""Contiguous shards of equal bytes, from global prefix sums.

Rows are reduced to a few numbers by the scan, ordered by ``doc_id`` into range partitions
and written.  The totals of the partitions give every partition its offset, so the global
prefix sum needs no global sort or window: a running sum inside each partition plus the
offset.  A document belongs to the shard in whose equal share of the bytes its middle
lies; shard borders therefore differ from the targets by half a document at most.

Defined cases: a null text has no bytes and checksum 0; null ids sort first; rows that repeat
an id are told apart by their position in the input, so a single id that holds a third of
all rows is split like any other run; an empty table gives an empty result; fewer rows than
shards leave shards empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import CRC32_CHECKS, crc32_sql
from claimworks.plans.workspace import write_table

LAW = "bytes"
OVERHEAD = 8


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def text_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def shard_rows(rows: DataFrame, size: str, order: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; ``size`` and ``order`` name columns of it.

    ``rows`` should be narrow: it is shuffled once and written.
    """
    order_by = [F.asc_nulls_first(order), F.asc("_row")]
    numbered = write_table(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-sizes")
    ranged = numbered.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id())
    ranged = write_table(ranged, "shard-ranges")

    totals = ranged.groupBy("_part").agg(
        F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = ranged.withColumns(
        {
            "_start": F.coalesce(F.sum(size).over(inside), F.lit(0)),
            "_index": F.count(F.lit(1)).over(inside),
        }
    ).join(F.broadcast(offsets), "_part")
    middle = 2 * (F.col("_start") + F.col("_bytes_before")) + F.col(size)
    # share of the total before the document's middle, in decimals: no overflow at any size
    cut = F.floor(
        middle.cast("decimal(25,0)") * F.lit(shards).cast("decimal(9,0)")
        / (2 * F.col("_total")).cast("decimal(25,0)")
    )
    assigned = write_table(
        placed.select(
            *rows.columns,
            F.least(F.lit(shards - 1), cut).cast("int").alias("shard"),
            (F.col("_index") + F.col("_rows_before")).alias("_index"),
        ),
        "shard-assigned",
    )
    first = assigned.groupBy("shard").agg(F.min("_index").alias("_first"))  # a row per shard
    return assigned.join(F.broadcast(first), "shard").select(
        *rows.columns, "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )
    placed = shard_rows(narrow, "size", "doc_id", shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def oracle_sql(shards: int = 24) -> str:
    """DuckDB SQL for :func:`shard_documents` over the documents table, whose ids are unique."""
    code = "list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda b: ('0x' || b)::bigint)"
    return f"""
with {CRC32_CHECKS},
sized as (
  select doc_id, strlen(coalesce(text, '')) + {OVERHEAD} as size, {crc32_sql(code)} as text_crc32
  from documents, checks),
placed as (
  select *, sum(size) over () as total, coalesce(sum(size) over (
    order by doc_id nulls first rows between unbounded preceding and 1 preceding), 0) as start
  from sized),
cut as (
  select *, least({shards - 1}, (2 * start + size) * {shards} // (2 * total))::int as shard from placed)
select doc_id, size::bigint as size, text_crc32, '{LAW}' as law, shard,
       row_number() over (partition by shard order by doc_id nulls first) - 1 as slot, null::int as grown_shard
from cut"""
