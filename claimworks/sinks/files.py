"""File sinks.  Every writer runs on the executors; nothing passes the driver."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.sources.readers import REPORT_CSV, escaped


def _as_lines(df: DataFrame) -> DataFrame:
    return df.select(
        [
            escaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def balanced(df: DataFrame) -> DataFrame:
    """Rows dealt anew, so that no task writes much more than the session's advisory partition size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) however they were grouped before.

    Adaptive execution merges what is small and splits what is large; without it, rows go to as
    many files as there are shuffle partitions.
    """
    return df.hint("rebalance")


def _save(df: DataFrame, path: str, mode: str, file_format: str, balance: bool = False, max_rows: int = 0) -> None:
    """``balance`` deals rows anew for even files; ``max_rows``, if not 0, bounds the rows of a file
    without any shuffle."""
    df = _as_lines(df) if file_format == "csv" else df
    writer = (balanced(df) if balance else df).write.mode(mode).option("maxRecordsPerFile", max_rows)
    if file_format == "csv":
        writer.options(**REPORT_CSV).csv(path)
    else:
        writer.format(file_format).save(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", balance: bool = False, max_rows: int = 0
) -> None:
    """CSV with header that :func:`claimworks.sources.readers.read_report_csv` gives back as
    it was: null, ``''``, blanks, quotes, backslashes and line breaks."""
    _save(df, path, mode, "csv", balance, max_rows)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", balance: bool = False, max_rows: int = 0
) -> None:
    _save(df, path, mode, "parquet", balance, max_rows)


def write_run(df: DataFrame, root: str, key: str, stamp: str, file_format: str = "parquet") -> str:
    """Write one run's report to its own folder below ``root/key`` and return it.

    ``root`` is any file system Spark can reach, e.g. ``s3a://bucket``.  The stamp
    is given by the caller, so a repeated run replaces exactly its own folder.
    """
    if not re.fullmatch(r"[0-9A-Za-z_-]+", stamp):
        raise ValueError(f"run stamp {stamp!r} must be letters, digits, '-' and '_' only")
    path = f"{root.rstrip('/')}/{key}/ingested_at={stamp}"
    _save(df, path, "overwrite", file_format)
    return path


def write_once(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Create the target; fail if it is there already (e.g. on ``abfss://``)."""
    _save(df, path, "errorifexists", file_format)
