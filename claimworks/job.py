"""The whole job: read both inputs, write both reports to every sink, check them.

    zip -r claimworks.zip claimworks
    spark-submit --conf spark.checkpoint.dir=<shared folder> --py-files claimworks.zip \\
        run_job.py --city <parquet> --fact <csv> --out <folder>
"""

from __future__ import annotations

import argparse
import logging
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimworks import schemas
from claimworks.operators import fingerprint, quality, reports
from claimworks.operators.clean import clean_city, prepare_presc
from claimworks.plans.workspace import input_state, stage_key, stage_table, temporary_tables, write_table
from claimworks.session import spark_session
from claimworks.sinks import files, runs, tables
from claimworks.sources.readers import (
    BAD_LINE, escaped, parsed_lines, read_city_dim, read_prescriber_fact, read_report_csv,
    split_malformed,
)

log = logging.getLogger(__name__)

# A sink takes a report and its name, "city" or "top5_prescribers", and returns the frame
# that reads what it has written, or None if it has checked that itself.
Sink = Callable[[DataFrame, str], DataFrame | None]


def preview_order() -> list[Column]:
    """A total order of the prescriber report, up to equal rows."""
    highest = F.desc_nulls_last("trx_cnt")
    others = [name for name in schemas.PRESCRIBER_REPORT.names if name not in ("presc_state", "trx_cnt")]
    return [F.asc_nulls_first("presc_state"), highest, *[F.asc_nulls_first(name) for name in others]]


def csv_sink(root: str, balance: bool = False, max_rows: int = 0) -> Sink:
    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}.csv"
        files.write_csv(df, path, balance=balance, max_rows=max_rows)
        return read_report_csv(df.sparkSession, path, df.schema)

    return write


def parquet_sink(root: str, balance: bool = False, max_rows: int = 0) -> Sink:
    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}.parquet"
        files.write_parquet(df, path, balance=balance, max_rows=max_rows)
        return _reread(df, path, "parquet")

    return write


def _reread(df: DataFrame, path: str, file_format: str) -> DataFrame:
    if file_format == "csv":
        return read_report_csv(df.sparkSession, path, df.schema)
    return df.sparkSession.read.format(file_format).schema(df.schema).load(path)


def run_sink(root: str, stamp: str, file_format: str = "parquet") -> Sink:
    def write(df: DataFrame, name: str) -> DataFrame:
        return _reread(df, files.write_run(df, root, name, stamp, file_format), file_format)

    return write


def create_once_sink(root: str, file_format: str = "csv") -> Sink:
    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}.{file_format}"
        files.write_once(df, path, file_format)
        return _reread(df, path, file_format)

    return write


def table_sink(root: str, database: str | None = None) -> Sink:
    def write(df: DataFrame, name: str) -> DataFrame:
        table = tables.REPORT_TABLES[name]
        full = f"{database}.{table}" if database else table
        tables.save_table(df, full, f"{root}/{table}")
        return df.sparkSession.table(full)

    return write


def committed_run_sink(root: str, stamp: str, file_format: str = "parquet") -> Sink:
    """A run folder that readers see only once it is whole; it is checked before it is committed."""

    def write(df: DataFrame, name: str) -> None:
        runs.write_run(df, root, name, stamp, file_format)

    return write


def jdbc_sink(
    url: str, properties: dict[str, str] | None = None, token: str | None = None,
    connect: tables.Connect | None = None,
) -> Sink:
    """Load into a database in two phases: a staging table of this run is loaded and checked by
    fingerprint, then its rows replace those of the table that readers use in one transaction."""

    def write(df: DataFrame, name: str) -> None:
        tables.load_jdbc(df, url, tables.REPORT_TABLES[name], token or uuid.uuid4().hex, properties, connect=connect)

    return write


def _load(report: DataFrame, name: str, sink: Sink, expected: fingerprint.Fingerprint) -> None:
    """Write one report and check that the same rows are there afterwards."""
    found = sink(report, name)
    if found is not None:
        fingerprint.require_same(name, expected, fingerprint.of(found.select(report.columns)))


def write_fingerprinted(df: DataFrame, label: str) -> tuple[DataFrame, fingerprint.Fingerprint]:
    """A report as a written table, with the fingerprint seen by the job that wrote it."""
    seen = Observation()
    table = write_table(df.observe(seen, *fingerprint.measures(df.schema)), label, keep=True)
    return table, fingerprint.Fingerprint.seen(seen)


@dataclass(frozen=True)
class Result:
    """What a run produced; the frames read written tables."""

    city_report: DataFrame
    prescriber_report: DataFrame
    row_counts: DataFrame
    preview: DataFrame


def run(
    spark: SparkSession,
    city_path: str,
    fact_path: str,
    sinks: Sequence[Sink],
    *,
    city_format: str = "parquet",
    fact_format: str = "csv",
    grain: str = reports.ROW,
    normalize_keys: bool = False,
    bad_lines: str | None = None,
    infer: bool = False,
    restart: str | None = None,
    line_breaks: bool = False,
) -> Result:
    """Read, clean, report, write and check.

    The text of a CSV fact is parsed once, into a parquet table of prepared rows that
    both reports read.  Lines that do not fit the contract end the run, unless
    ``bad_lines`` names a folder for their text (a second pass over the text, if there are
    any).  ``infer`` lets Spark guess the types of a CSV fact first, which costs one more pass, and casts
    them to the contract's; a value that does not fit ends the run.  ``line_breaks`` keeps values with line
    breaks, for two more passes.  ``restart`` names a folder where the prepared rows stay: a run over the same
    files with the same options starts from them, so one that died later does not parse the text again.  The
    folder is the caller's to clear.  Each report is computed once, whatever the number of sinks, and what each sink
    wrote is compared with it by fingerprint afterwards.  Work tables are removed at the end.  Any error ends the
    run.
    """
    with temporary_tables(spark):
        return _run(
            spark, city_path, fact_path, sinks, city_format, fact_format, grain, normalize_keys, bad_lines, infer,
            restart, line_breaks,
        )


def _together(spark: SparkSession, *works: Callable[[], Any]) -> list:
    """Results of works that do not depend on one another; their jobs share the cluster.

    All are waited for, also if one fails; then the first error is raised.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        # tags and properties of the caller's thread hold for its jobs there, too
        futures = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
        return [future.result() for future in futures]


# Counts when prepared rows of equal inputs change, so that stages of older code are not taken up.
PREPARED_VERSION = 1


def _prepared_csv(
    spark: SparkSession, path: str, normalize_keys: bool, bad_lines: str | None, infer: bool,
    restart: str | None, line_breaks: bool,
) -> tuple[DataFrame, DataFrame]:
    """Prepared rows of the good lines, and the numbers of good and malformed ones.

    The text is parsed once.  With ``restart`` the rows stay there under a key of the files and
    parameters, and a later run that has the same takes them up.
    """
    is_bad = F.col(BAD_LINE).isNotNull()

    def compute() -> tuple[DataFrame, Callable[[], dict]]:
        seen = Observation()
        if infer:
            guessed = schemas.conform(read_prescriber_fact(spark, path, infer=True), schemas.PRESCRIBER_FACT)
            good = guessed.observe(seen, F.count(F.lit(1)).alias("good"))
        else:
            lines = parsed_lines(spark, path, schemas.PRESCRIBER_FACT, line_breaks=line_breaks).observe(
                seen, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("malformed")
            )
            good = lines.filter(~is_bad).drop(BAD_LINE)
        return prepare_presc(good, normalize_keys=normalize_keys), lambda: {"malformed": 0, **seen.get}

    if restart is None:
        frame, facts = compute()
        rows, counts = write_table(frame, "prepared-rows"), facts()
    else:
        key = stage_key(
            PREPARED_VERSION, schemas.PRESCRIBER_FACT.jsonValue(), input_state(spark, path), normalize_keys, infer,
            line_breaks,
        )
        rows, counts = stage_table(spark, restart, "prepared-rows", key, compute)
    if counts["malformed"]:
        if bad_lines is None:
            raise ValueError(f"{path} has {counts['malformed']} malformed lines")
        bad = split_malformed(spark, path, schemas.PRESCRIBER_FACT, line_breaks=line_breaks)[1]
        # a record with line breaks is one line there, too
        text = escaped(F.col(BAD_LINE)).alias(BAD_LINE) if line_breaks else F.col(BAD_LINE)
        bad.select(text).write.mode("overwrite").text(bad_lines)
    named = [("df_fact", counts["good"]), ("malformed_lines", counts["malformed"])]
    return rows, spark.createDataFrame(named, "frame_name string, row_count long")


def _run(
    spark: SparkSession, city_path: str, fact_path: str, sinks: Sequence[Sink], city_format: str,
    fact_format: str, grain: str, normalize_keys: bool, bad_lines: str | None, infer: bool,
    restart: str | None, line_breaks: bool,
) -> Result:
    city = schemas.conform(read_city_dim(spark, city_path, city_format), schemas.CITY_DIM)
    if fact_format == "csv":
        rows, fact_count = _prepared_csv(
            spark, fact_path, normalize_keys, bad_lines, infer, restart, line_breaks
        )
    else:
        fact = read_prescriber_fact(spark, fact_path, fact_format)
        rows = prepare_presc(fact, normalize_keys=normalize_keys)
        fact_count = quality.row_counts({"df_fact": fact})
    quality.require_contract(rows, schemas.CLEAN_PRESC, "cleaned fact")

    city = clean_city(city, normalize_keys)
    for name, frame in (("city", city), ("fact", rows)):
        log.info("clean %s: %s", name, frame.schema.simpleString())
    (city_result, city_seen), (presc_result, presc_seen) = _together(
        spark,
        lambda: write_fingerprinted(reports.city_report(city, rows), "city-report"),
        lambda: write_fingerprinted(reports.top_prescribers(rows, grain=grain), "prescriber-report"),
    )
    expected = schemas.PRESCRIBER_REPORT if grain == reports.ROW else schemas.PRESCRIBER_TOTALS
    quality.require_contract(city_result, schemas.CITY_REPORT, "city report")
    quality.require_contract(presc_result, expected, "prescriber report")

    written = {"city": (city_result, city_seen), "top5_prescribers": (presc_result, presc_seen)}
    sizes = {tables.REPORT_TABLES[name]: seen.rows for name, (_, seen) in written.items()}
    computed = spark.createDataFrame(list(sizes.items()), "table_name string, row_count long")
    quality.require_rows(computed, "table_name").collect()  # two rows
    for sink in sinks:
        _together(spark, *[partial(_load, report, name, sink, seen) for name, (report, seen) in written.items()])
    counted = spark.createDataFrame(list(sizes.items()), "frame_name string, row_count long")
    counts = quality.row_counts({"df_city": city}).unionByName(counted).unionByName(fact_count)
    return Result(city_result, presc_result, counts, quality.preview(presc_result, preview_order()))


SINKS = ("csv", "parquet", "table", "run", "committed", "once", "jdbc")


def _sink(kind: str, args: argparse.Namespace) -> Sink:
    root, stamp = args.out, args.stamp
    if kind in ("run", "committed"):
        if stamp is None:
            raise ValueError(f"the {kind} sink needs --stamp")
        return {"run": run_sink, "committed": committed_run_sink}[kind](f"{root}/runs", stamp)
    if kind == "jdbc":
        if args.jdbc_url is None:
            raise ValueError("the jdbc sink needs --jdbc-url")
        return jdbc_sink(args.jdbc_url, dict(pair.split("=", 1) for pair in args.jdbc_property), stamp)
    if kind in ("csv", "parquet"):
        return {"csv": csv_sink, "parquet": parquet_sink}[kind](root, args.balance, args.max_rows)
    makers = {"table": table_sink, "once": create_once_sink}
    folder = {"table": f"{root}/tables", "once": f"{root}/once"}[kind]
    return makers[kind](folder)


def _check_tables(names: str) -> None:
    for row in quality.loaded_tables(spark_session(), names).collect():
        log.info("%s: %s rows", row.table_name, row.row_count)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--check-tables", help="only check that these tables, 'a, b', have rows")
    parser.add_argument("--city", help="city dimension (parquet)")
    parser.add_argument("--fact", help="prescriber fact")
    parser.add_argument("--fact-format", default="csv")
    parser.add_argument("--infer", action="store_true", help="guess the types of a CSV fact")
    parser.add_argument("--line-breaks", action="store_true", help="values of a CSV fact may hold line breaks")
    parser.add_argument("--restart", help="folder of finished stages that a later run takes up")
    parser.add_argument("--out", help="folder of the reports")
    parser.add_argument("--city-format", default="parquet")
    parser.add_argument("--sink", action="append", choices=SINKS, help="repeatable; csv if none")
    parser.add_argument("--stamp", help="name of this run's folder or staging table")
    parser.add_argument("--jdbc-url", help="database of the jdbc sink")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="repeatable")
    parser.add_argument("--balance", action="store_true", help="even files of the csv and parquet sinks")
    parser.add_argument("--max-rows", type=int, default=0, help="most rows of such a file")
    parser.add_argument("--normalize-keys", action="store_true")
    parser.add_argument("--bad-lines", help="folder for malformed lines; they end the run if unset")
    parser.add_argument("--grain", default=reports.ROW, choices=[reports.ROW, reports.PRESCRIBER])
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    if args.check_tables:
        _check_tables(args.check_tables)
        return
    missing = [f"--{name}" for name in ("city", "fact", "out") if getattr(args, name) is None]
    if missing:
        parser.error(f"the following arguments are required: {', '.join(missing)}")
    result = run(
        spark_session(), args.city, args.fact,
        [_sink(kind, args) for kind in args.sink or ["csv"]],
        city_format=args.city_format, fact_format=args.fact_format, grain=args.grain,
        normalize_keys=args.normalize_keys, bad_lines=args.bad_lines, infer=args.infer,
        restart=args.restart, line_breaks=args.line_breaks,
    )
    for name, report in (("city", result.city_report), ("prescriber", result.prescriber_report)):
        log.info("%s report: %s", name, report.schema.simpleString())
    for row in result.row_counts.collect():
        log.info("%s: %s rows", row.frame_name, row.row_count)
    for row in result.preview.collect():
        log.info("%s", row.asDict())


if __name__ == "__main__":
    main()
