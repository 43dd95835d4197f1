"""Records of CSV files whose quoted values hold line breaks, cut from splits that are read apart.

A line break ends a record only outside quotes, so a split alone does not tell where its records
begin.  But it tells how many of its lines hold an odd number of quotes, after each of which the text is on
the other side of them.  These numbers add up over the splits of a file, which tells of each split
whether it begins inside quotes.  Knowing that, the lines of a record are joined where they are read; only
the two ends of a record that two splits share meet, by file and split of the first one.

A file is never read by one task.  The text is scanned three times: for the splits' numbers, for the
records inside a split, and, of the splits that begin or end inside quotes, for the ends of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_lookup

QUOTE = '"'
# Ends of a record that two splits share (fixed values).
BEGUN, ENDED = 0, 1
SHARED = "file string, first_split long, part int, value string"


def _joined(pieces: list[pa.Array], ends: np.ndarray) -> pa.Array:
    """The lines of ``pieces`` as records, of which each ends before one of ``ends``."""
    lines = pa.concat_arrays(pieces)
    if len(ends) == len(lines):
        return lines
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


class _Split:
    """The lines of one split, in batches."""

    def __init__(self, file: str, split: int, open_split: int | None) -> None:
        self.file, self.split, self.open_split = file, split, open_split
        # whether the next line lies inside quotes, and whether its record began in an earlier split
        self.inside = self.headless = open_split is not None
        self.pieces: list[pa.Array] = []  # lines of the record that has not ended

    def add(self, lines: pa.Array, odd: np.ndarray) -> tuple[pa.Array | None, pa.Array | None]:
        """The end of the record that an earlier split began, and the records that end in these lines."""
        after = (self.inside + np.cumsum(odd)) % 2
        self.inside = bool(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        if not len(ends):
            self.pieces.append(lines)
            return None, None
        before, last = sum(map(len, self.pieces)), int(ends[-1])
        found = _joined([*self.pieces, lines.slice(0, last)], before + ends)
        self.pieces = [lines.slice(last)] if last < len(lines) else []
        if not self.headless:
            return None, found
        self.headless = False
        return found.slice(0, 1), found.slice(1)

    def rest(self) -> pa.Array | None:
        """The beginning of the record that the split does not end."""
        if not self.pieces:
            return None
        if self.headless:
            raise ValueError(f"a file was changed while it was read: {self.file}")
        return _joined(self.pieces, np.array([sum(map(len, self.pieces))]))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch, cut where another split begins."""
    begins = np.zeros(max(batch.num_rows - 1, 0), bool)
    for name in ("file", "split"):
        column = batch.column(name)
        begins |= pc.not_equal(column.slice(1), column.slice(0, len(begins))).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(begins) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _shared(split: _Split, part: int, value: pa.Array) -> pa.RecordBatch:
    first = split.split if part == BEGUN else split.open_split
    return pa.RecordBatch.from_pydict(
        {
            "file": pa.array([split.file]), "first_split": pa.array([first], pa.int64()),
            "part": pa.array([part], pa.int32()), "value": value,
        }
    )


def _cut(shared: bool):
    """For ``mapInArrow``: the records inside splits or, if ``shared``, the ends of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for part in _parts(batch):
                place = tuple(part.column(name)[0].as_py() for name in ("file", "split", "open_split"))
                if split is None or place != (split.file, split.split, split.open_split):
                    rest = split and split.rest()
                    if shared and rest is not None:
                        yield _shared(split, BEGUN, rest)
                    split = _Split(*place)
                odd = part.column("odd").to_numpy(zero_copy_only=False)
                end, records = split.add(part.column("value"), odd)
                if shared and end is not None:
                    yield _shared(split, ENDED, end)
                elif not shared and records is not None:
                    yield pa.RecordBatch.from_arrays([records], ["value"])
        rest = split and split.rest()
        if shared and rest is not None:
            yield _shared(split, BEGUN, rest)

    return run


def _lines(spark: SparkSession, path: str, escape: str) -> DataFrame:
    """file, split and value of each line, and whether it holds an odd number of quotes: of those that begin or
    end a quoted value, or come in pairs."""
    lines = spark.read.option("lineSep", "\n").text(path)
    text = F.col("value")
    if escape != QUOTE:
        escapes = F.contains(text, F.lit(escape))
        text = F.when(escapes, F.regexp_replace(text, f"(?s)\\Q{escape}\\E.", "")).otherwise(text)
    placed = lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        text.alias("text"),
    )
    quotes = F.octet_length("text") - F.octet_length(F.replace("text", F.lit(QUOTE), F.lit("")))
    return placed.select("file", "split", "value", (quotes % 2 == 1).alias("odd"))


def split_cases(spark: SparkSession, path: str, escape: str) -> DataFrame:
    """The splits that begin or end inside quotes; for the former, the split that the record open there
    began in.

    Raises where a whole split lies inside one value: a quote is missing, or the value is
    longer than a split.
    """
    totals = _lines(spark, path, escape).groupBy("file", "split").agg(F.count_if("odd").alias("odds"))
    in_order = Window.partitionBy("file").orderBy("split")
    so_far = F.sum("odds").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    cases = totals.withColumns({"so_far": so_far, "earlier": F.lag("split").over(in_order)})
    inside, ends_inside = (F.col("so_far") - F.col("odds")) % 2 == 1, F.col("so_far") % 2 == 1
    spans = F.when(~inside | (F.col("odds") > 0), inside | ends_inside).otherwise(
        F.raise_error(
            F.concat(F.lit("a quoted value spans a whole split, is a quote missing? "), F.col("file"))
        ).cast("boolean")
    )
    # a split that is inside quotes at its end has begun the record that is open there
    return cases.filter(spans).select("file", "split", F.when(inside, F.col("earlier")).alias("open_split"))


def csv_records(spark: SparkSession, path: str, escape: str = "\\") -> DataFrame:
    """The records of CSV files, each as one text in ``value``, line breaks in quotes kept.

    ``escape`` stands before a quote that belongs to a value; doubled quotes need none.  Lines end
    with ``\\n`` or ``\\r\\n``.
    """
    lookup = write_lookup(split_cases(spark, path, escape), "csv-splits")
    cases = lookup.frame.withColumnsRenamed({"file": "_file", "split": "_split"})
    lines = _lines(spark, path, escape)
    same = (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split"))

    def cased(how: str) -> DataFrame:
        columns = "file", "split", "open_split", "odd", "value"
        if lookup.fits_broadcast():
            return lines.join(F.broadcast(cases), same, how).select(*columns)
        # a join that shuffles takes the lines of a split apart and out of their order
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(cases, same, how)
        return numbered.repartition("file", "split").sortWithinPartitions("file", "split", "line").select(*columns)

    whole = cased("left").mapInArrow(_cut(shared=False), "value string")
    parts = cased("inner").mapInArrow(_cut(shared=True), SHARED).groupBy("file", "first_split").agg(
        F.array_sort(F.collect_list(F.struct("part", "value"))).alias("parts")
    )
    begun = F.when(F.col("parts")[0]["part"] == BEGUN, True).otherwise(
        F.raise_error(F.concat(F.lit("a file was changed while it was read: "), F.col("file"))).cast("boolean")
    )
    joined = parts.filter(begun).select(
        F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("value")
    )
    ends = F.endswith("value", F.lit("\r"))
    unended = F.when(ends, F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value"))
    return whole.unionByName(joined).select(unended.alias("value"))
