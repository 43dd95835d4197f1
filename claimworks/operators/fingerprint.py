"""Order-free fingerprints of frames, which any SQL engine can compute again.

The fingerprint of a frame is the sum of a hash of each row, with the number of rows: it does not
depend on order, files or partitions, partial sums add up, and repeated rows count. A row's hash
is the beginning of the MD5 of a text in which each value is preceded by its length, so that
no two rows share a text.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 15  # hexadecimal digits of a row's hash: 60 bits
ROWS, SUM = "row_count", "fingerprint"
_NULL = "n"


def row_text(schema: T.StructType) -> Column:
    """The values of a row as one text; null, ``''`` and the text of null differ."""
    nested = [f.name for f in schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if nested:
        raise ValueError(f"no fingerprint of nested columns: {', '.join(nested)}")

    def value(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(_NULL))

    return F.concat(F.lit(""), *[value(name) for name in schema.names])


def row_hash(schema: T.StructType) -> Column:
    digits = F.substring(F.md5(row_text(schema).cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def measures(schema: T.StructType) -> list[Column]:
    """Number of rows and fingerprint, as aggregates for ``agg`` or ``observe``."""
    total = F.coalesce(F.sum(row_hash(schema)), F.lit(0)).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias(ROWS), total.alias(SUM)]


@dataclass(frozen=True)
class Fingerprint:
    """Number of rows and sum of their hashes."""

    rows: int
    total: Decimal

    @classmethod
    def seen(cls, observation: Observation) -> Fingerprint:
        """What an observation with :func:`measures` has seen; waits for its job."""
        found = observation.get
        return cls(found[ROWS], found[SUM])


def fingerprint(frame: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``fingerprint``."""
    return frame.agg(*measures(frame.schema))


def of(frame: DataFrame) -> Fingerprint:
    return Fingerprint(*fingerprint(frame).first())


def fingerprints(frames: dict[str, DataFrame], name_column: str = "frame_name") -> DataFrame:
    """One row per frame, in one job."""
    named = [fingerprint(frame).select(F.lit(name).alias(name_column), ROWS, SUM) for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, named)


def require_same(name: str, expected: Fingerprint, loaded: Fingerprint) -> None:
    """Raises unless the same rows were found as were written, and there are any."""
    if loaded.rows != expected.rows or not loaded.rows:
        raise ValueError(f"{name} holds {loaded.rows} rows after loading {expected.rows}")
    if loaded.total != expected.total:
        raise ValueError(f"{name} holds other values than were loaded: fingerprint {loaded.total}, not {expected.total}")
