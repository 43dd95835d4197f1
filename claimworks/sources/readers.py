"""Readers of the two inputs and of written reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks import schemas
from claimworks.sources.records import csv_records

# Written for null, so that null and '' stay apart in a CSV (fixed value).
CSV_NULL = r"\N"
# Report files are read as they were written: blanks at both ends count, quotes are doubled.
REPORT_CSV = {
    "header": True, "nullValue": CSV_NULL, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
BAD_LINE = "_bad"


def escaped(text: Column) -> Column:
    """Backslashes and line breaks spelled out, so that a row is a line and ``\\N`` is a text."""
    for raw, spelled in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(spelled))
    return text


def unescaped(text: Column) -> Column:
    """What :func:`escaped` was given."""

    def breaks(part: Column) -> Column:
        part = F.replace(part, F.lit("\\n"), F.lit("\n"))
        return F.replace(part, F.lit("\\r"), F.lit("\r"))

    # between doubled backslashes, a single one begins a line break's spelling
    parts = F.transform(F.split(text, r"\\\\"), breaks)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def read_city_dim(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """City dimension in any format whose files carry their schema."""
    return spark.read.format(file_format).load(path)


def header_schema(
    spark: SparkSession, path: str, contract: T.StructType, sep: str = ","
) -> T.StructType:
    """The columns of a CSV in the order of its header: the contract's types for its own
    columns, text for any others.  Raises with the names of the contract that are missing."""
    names = spark.read.csv(path, header=True, sep=sep).columns
    missing = [name for name in contract.names if name not in names]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    kinds = {field.name: field.dataType for field in contract}
    return T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in names])


def read_prescriber_fact(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    infer: bool = False,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Prescriber fact under its declared schema.

    A CSV is bound by its header: columns may come in any order and among others, and
    every file must have the same header.  ``infer=True`` lets Spark guess the column types
    instead, at the price of one more pass over the share of the text that
    ``sampling_ratio`` names.
    """
    reader = spark.read.format(file_format)
    if file_format != "csv":
        return (reader if infer else reader.schema(schemas.PRESCRIBER_FACT)).load(path)
    reader = reader.options(header=True, sep=",")
    if infer:
        return reader.options(inferSchema=True, samplingRatio=sampling_ratio).load(path)
    bound = header_schema(spark, path, schemas.PRESCRIBER_FACT)
    found = reader.option("enforceSchema", False).schema(bound).load(path)
    return found.select(schemas.PRESCRIBER_FACT.names)


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV report written by :func:`claimworks.sinks.files.write_csv`."""
    found = spark.read.schema(schema).options(**REPORT_CSV).csv(path)
    return found.select(
        [
            unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in schema
        ]
    )


def parsed_lines(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", line_breaks: bool = False
) -> DataFrame:
    """The contract's columns and, for lines that do not fit, their text in ``BAD_LINE``.

    The whole line is parsed, once, whatever columns a query later selects, so a line is
    good or bad independently of the query.  Columns are bound by the header; a file whose
    header has another order fails the query.  Values with line breaks are kept if ``line_breaks`` is
    set, see :mod:`claimworks.sources.records`; otherwise each of their lines is malformed.
    """
    bound = header_schema(spark, path, schema, sep)
    parsed_schema = T.StructType(bound.fields + [T.StructField(BAD_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "sep": sep}
    plain = F.replace(F.col("value"), F.lit('"'), F.lit(""))
    names = F.split(plain, re.escape(sep))
    like_header = F.contains(F.col("value"), F.lit(bound.names[0])) & (
        F.sort_array(names) == F.array(*map(F.lit, sorted(bound.names)))
    )
    is_header = F.when(~like_header, False).otherwise(
        F.when(plain == sep.join(bound.names), True).otherwise(
            F.raise_error(F.concat(F.lit("a file has another header: "), F.col("value"))).cast("boolean")
        )
    )
    text = csv_records(spark, path) if line_breaks else spark.read.text(path)
    lines = text.filter((F.length(F.trim("value")) > 0) & ~is_header)
    # as a generator the parser stands once in the plan
    parsed = lines.select(F.inline(F.array(F.from_csv("value", parsed_schema.toDDL(), options))))
    return parsed.select(*schema.names, BAD_LINE)


def split_malformed(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", line_breaks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Lines of a CSV with header that fit ``schema``, and the text of those that do not."""
    parsed = parsed_lines(spark, path, schema, sep, line_breaks)
    good = parsed.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    return good, parsed.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE)


def count_malformed(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ","
) -> DataFrame:
    """Number of good and malformed lines, from one pass."""
    is_bad = F.col(BAD_LINE).isNotNull()
    counts = parsed_lines(spark, path, schema, sep).agg(
        F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("malformed")
    )
    return counts.unpivot([], ["good", "malformed"], "lines", "row_count")
