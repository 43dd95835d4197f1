"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words; a word is a run of anything else (fixed values).
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda word: word != "")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def shingles(tokens: Column, size: int) -> Column:
    """Distinct runs of ``size`` words; the whole sequence if it is shorter, none if empty."""
    count = F.size(tokens)
    run = F.transform(
        F.sequence(F.lit(0), F.greatest(count - size, F.lit(0))),
        lambda at: F.concat_ws(" ", *[F.get(tokens, at + k) for k in range(size)]),
    )
    return F.when(count == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(run))


def masked(frame: DataFrame, but: Sequence[str] = ()) -> list[Column]:
    """The columns of ``frame`` under names (``c0``, ...) that clash with nothing, all ``but`` some."""
    return [
        F.col(f"`{name}`").alias(name if name in but else f"c{at}") for at, name in enumerate(frame.columns)
    ]


def unmasked(frame: DataFrame, but: Sequence[str] = (), names: Sequence[str] | None = None) -> list[Column]:
    """The columns of ``frame``, or only ``names``, out of what :func:`masked` selected."""
    wanted = frame.columns if names is None else names
    return [
        F.col(name if name in but else f"c{at}").alias(name)
        for at, name in enumerate(frame.columns)
        if name in wanted
    ]


# DuckDB: the remainders of all bytes, as a table ``checks``; the checksum's polynomial is reversed (fixed value).
CRC32_CHECKS = """checks as (
  select list(list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b)
              order by b) as of_byte
  from range(256) r(b))"""


def crc32_sql(data: str) -> str:
    """DuckDB SQL for the checksum of a list of bytes, beside ``checks``."""
    step = "xor(c // 256, of_byte[xor(c, b::bigint) % 256 + 1])"
    return f"xor(4294967295, list_reduce({data}, lambda c, b: {step}, 4294967295))"


def sample_order(key: Column, seed: int) -> Column:
    """A number that orders rows at random, the same in every run."""
    return F.xxhash64(F.lit(seed), key.cast("string"))


Batches = Iterator[pa.RecordBatch]


def hand_back() -> None:
    """Return memory that this Python worker has freed to the system.

    Workers live on from stage to stage, and allocators keep what was freed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a C library may lack it
    if trim is not None:
        trim(0)


def handing_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, with :func:`hand_back` after every batch and at the end."""

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        for batch in run(batches):
            yield batch
            del batch
            hand_back()
        hand_back()

    return wrapped
