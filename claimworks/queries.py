"""Every operator as a query over a scale-factor folder: ``(spark, sf_dir) -> frame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks import fixtures, job, schemas
from claimworks.functions import token_count, token_count_arrow
from claimworks.operators import clean, fingerprint, impute, quality, rank, reports
from claimworks.plans.workspace import fresh_path, write_table
from claimworks.sinks import files, runs, tables
from claimworks.sources import readers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_city(fixtures.city_dim(spark, sf_dir))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.prepare_presc(fixtures.prescriber_fact(spark, sf_dir))


def _city_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_report(_city(spark, sf_dir), _rows(spark, sf_dir))


def _presc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_prescribers(_rows(spark, sf_dir))


# --- sources ---------------------------------------------------------------


@query
def scan_city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.city_dim(spark, sf_dir)


@query
def scan_presc_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.prescriber_csv(spark, sf_dir)


@query
def scan_presc_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = fixtures.prescriber_csv(spark, sf_dir, infer=True)
    return schemas.conform(guessed, schemas.PRESCRIBER_FACT)


@query
def reload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "reload-report")
    files.write_csv(_presc_report(spark, sf_dir), path)
    return readers.read_report_csv(spark, path, schemas.PRESCRIBER_REPORT)


def _lines_with_errors(spark: SparkSession, sf_dir: str) -> str:
    """The fact as CSV lines; text in a number where the drug is null, and one field
    too many where the state is null."""
    fact = fixtures.prescriber_fact(spark, sf_dir)
    supply = F.when(F.col("drug_name").isNull(), F.lit("unknown")).otherwise(
        F.col("total_day_supply").cast("string")
    )
    surplus = F.when(F.col("nppes_provider_state").isNull(), F.lit("surplus"))
    values = [
        F.coalesce(supply if name == "total_day_supply" else F.col(name).cast("string"), F.lit(""))
        for name in fact.columns
    ]
    path = fresh_path(spark, "lines-with-errors")
    # one column whose name is the header, which then stands on top of every file
    lines = fact.select(F.concat_ws(",", *values, surplus).alias(",".join(fact.columns)))
    lines.write.csv(path, header=True, sep="\x01", quote="", emptyValue="")
    return path


def _rewritten_csv(spark: SparkSession, sf_dir: str, label: str, *columns: Column | str) -> DataFrame:
    """The fact after a trip through a CSV of these columns."""
    path = fresh_path(spark, label)
    fixtures.prescriber_fact(spark, sf_dir).select(*columns).write.csv(path, header=True, nullValue="")
    return readers.read_prescriber_fact(spark, path)


@query
def scan_presc_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with the columns in another order."""
    return _rewritten_csv(spark, sf_dir, "csv-reordered", *reversed(schemas.PRESCRIBER_FACT.names))


@query
def scan_presc_csv_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with more columns before, between and after."""
    names = schemas.PRESCRIBER_FACT.names
    extra = [F.concat(F.lit(f"x{k} "), F.col("npi").cast("string")).alias(f"extra_{k}") for k in range(3)]
    return _rewritten_csv(
        spark, sf_dir, "csv-wide", extra[0], *names[:6], extra[1], *names[6:], extra[2]
    )


@query
def csv_skip_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_with_errors(spark, sf_dir)
    return readers.split_malformed(spark, path, schemas.PRESCRIBER_FACT)[0]


@query
def csv_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_with_errors(spark, sf_dir)
    return readers.count_malformed(spark, path, schemas.PRESCRIBER_FACT)


# --- cleaning --------------------------------------------------------------


@query
def clean_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city(spark, sf_dir)


@query
def presc_select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.select_fact(fixtures.prescriber_fact(spark, sf_dir))


@query
def presc_add_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_country(presc_select_rename(spark, sf_dir))


@query
def presc_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_full_name(presc_select_rename(spark, sf_dir))


@query
def presc_years_of_exp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_experience(presc_select_rename(spark, sf_dir))


@query
def presc_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_null_keys(presc_select_rename(spark, sf_dir))


@query
def impute_trx(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select("presc_id", "drug_name", "trx_cnt")
    return impute.impute_trx(rows)


@query
def clean_presc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_presc(fixtures.prescriber_fact(spark, sf_dir))


# --- functions -------------------------------------------------------------


@query
def zip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.add_zip_counts(_city(spark, sf_dir))


@query
def zip_counts_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _city(spark, sf_dir).withColumn("zip_counts", token_count_arrow("zips"))
    return counted.withColumn("agrees", F.col("zip_counts").eqNullSafe(token_count("zips")))


# --- reports ---------------------------------------------------------------


@query
def city_prescriber_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_prescriber_agg(_rows(spark, sf_dir))


@query
def city_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_join(_city(spark, sf_dir), city_prescriber_agg(spark, sf_dir))


@query
def city_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_report(spark, sf_dir)


@query
def city_report_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_report_sql(
        fixtures.city_dim(spark, sf_dir), fixtures.prescriber_fact(spark, sf_dir)
    )


@query
def presc_exp_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.in_experience_range(clean_presc(spark, sf_dir))


@query
def presc_rank_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = presc_exp_range(spark, sf_dir).select("presc_id", "presc_state", "drug_name", "trx_cnt")
    return rank.with_dense_rank(rows, "presc_state", "trx_cnt")


@query
def top5_prescribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _presc_report(spark, sf_dir)


@query
def top5_prescribers_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs are rounded here, where the order of adding would show in the comparison."""
    report = reports.top_prescribers(_rows(spark, sf_dir), grain=reports.PRESCRIBER)
    return report.withColumn("total_drug_cost", F.round("total_drug_cost", 2))


# --- quality ---------------------------------------------------------------


@query
def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(
        {
            "df_city": fixtures.city_dim(spark, sf_dir),
            "df_fact": fixtures.prescriber_fact(spark, sf_dir),
            "city_report": _city_report(spark, sf_dir),
            "prescriber_report": _presc_report(spark, sf_dir),
        }
    )


@query
def dq_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile(clean_presc(spark, sf_dir))


@query
def dq_column_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched distinct counts and quantiles of the cleaned fact, held against exact ones: a distinct count
    may be off by 5 percent, a quantile by 1 percent of the ranks."""
    rows = clean_presc(spark, sf_dir)
    sketched = quality.sketch_profile(rows)
    exact = rows.agg(*[F.count_distinct(name).alias(name) for name in rows.columns])
    exact = exact.unpivot([], exact.columns, "column_name", "exact")
    numbers = [f.name for f in rows.schema if f.dataType.typeName() in ("integer", "long", "double")]
    values = rows.select([F.col(name).cast("double").alias(name) for name in numbers])
    values = values.unpivot([], numbers, "column_name", "value").filter("value is not null")
    asked = sketched.filter("quantiles is not null").select(
        "column_name", F.posexplode("quantiles").alias("k", "quantile")
    )
    share = F.element_at(F.array(*map(F.lit, quality.QUANTILES)), F.col("k") + 1)
    # ranks that the value could have among all of its column, as shares
    ranks = values.join(F.broadcast(asked), "column_name").groupBy("column_name", "k", "quantile").agg(
        F.avg((F.col("value") < F.col("quantile")).cast("int")).alias("low"),
        F.avg((F.col("value") <= F.col("quantile")).cast("int")).alias("high"),
    )
    near = (F.col("low") - 0.01 <= share) & (share <= F.col("high") + 0.01)
    ranked = ranks.groupBy("column_name").agg(F.every(near).alias("quantiles_near"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return sketched.join(exact, "column_name").join(ranked, "column_name", "left").select(
        "position", "column_name", "row_count", "null_count", close.alias("distinct_near"),
        F.coalesce("quantiles_near", F.lit(True)).alias("quantiles_near"),
    )


@query
def dq_merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the good and the other half of the fact, merged: rows and nulls are exact, distinct counts
    equal those of one pass over all rows, because united sketches are the sketch of the union."""
    rows = _rows(spark, sf_dir)
    in_range = F.coalesce(F.col("years_of_exp").between(20, 50), F.lit(False))
    halves = [quality.sketch_profile(rows.filter(half)) for half in (in_range, ~in_range)]
    merged = quality.merged_distinct(halves[0].unionByName(halves[1]))
    whole = quality.sketch_profile(rows).select("column_name", F.col("distinct_count").alias("at_once"))
    near = F.abs(F.col("distinct_count") - F.col("at_once")) <= F.greatest(F.lit(1.0), 0.05 * F.col("at_once"))
    return merged.join(whole, "column_name").select(
        "column_name", "row_count", "null_count", near.alias("distinct_near")
    )


@query
def dq_sink_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reports written to every kind of sink: the fingerprint seen while they were computed, and
    the one of what a reader finds."""
    written = {
        "city": job.write_fingerprinted(_city_report(spark, sf_dir), "fingerprint-city"),
        "top5_prescribers": job.write_fingerprinted(_presc_report(spark, sf_dir), "fingerprint-presc"),
    }
    path = fresh_path(spark, "fingerprints")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {database} location '{path}'")
    sinks = {
        "csv": job.csv_sink(f"{path}/csv", balance=True), "parquet": job.parquet_sink(f"{path}/parquet", max_rows=500),
        "run": job.run_sink(f"{path}/run", "s1"), "once": job.create_once_sink(f"{path}/once"),
        "table": job.table_sink(f"{path}/tables", database),
    }
    found = []
    for kind, sink in sinks.items():
        for name, (report, seen) in written.items():
            loaded = fingerprint.fingerprint(sink(report, name).select(report.columns))
            found.append(loaded.select(
                F.lit(kind).alias("sink"), F.lit(tables.REPORT_TABLES[name]).alias("table_name"),
                F.lit(seen.rows).cast("long").alias("written_rows"),
                F.lit(seen.total).cast("decimal(38,0)").alias("written_fingerprint"),
                F.col("row_count").alias("loaded_rows"), F.col("fingerprint").alias("loaded_fingerprint"),
            ))
    return reduce(DataFrame.unionByName, found)


@query
def dq_loaded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _save_tables(spark, sf_dir)
    loaded = quality.loaded_tables(spark, f"{database}.prescriber_report, {database}.city_report")
    return loaded.withColumn("table_name", F.substring_index("table_name", ".", -1))


@query
def preview_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.preview(_presc_report(spark, sf_dir), job.preview_order())


# --- sinks: write to a new folder, return what a reader finds there ----------


def _save_tables(spark: SparkSession, sf_dir: str) -> str:
    """Saves both reports in a database of this call's own and returns its name."""
    path = fresh_path(spark, "tables")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {database} location '{path}'")
    sink = job.table_sink(path, database)
    sink(_city_report(spark, sf_dir), "city")
    sink(_presc_report(spark, sf_dir), "top5_prescribers")
    return database


@query
def sink_city_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "city-csv")
    files.write_csv(_city_report(spark, sf_dir), path)
    return readers.read_report_csv(spark, path, schemas.CITY_REPORT)


@query
def sink_presc_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "presc-csv")
    files.write_csv(top5_prescribers_total(spark, sf_dir), path)
    return readers.read_report_csv(spark, path, schemas.PRESCRIBER_TOTALS)


@query
def sink_city_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "city-parquet")
    files.write_parquet(_city_report(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_object_store_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one report side by side; the first is written twice."""
    root = fresh_path(spark, "object-store")
    report = write_table(_city_report(spark, sf_dir), "city-report")
    for stamp in ("2024-01-07_00-00-00", "2024-01-14_00-00-00", "2024-01-07_00-00-00"):
        files.write_run(report, root, "city_report", stamp)
    schema = T.StructType(schemas.CITY_REPORT.fields + [T.StructField("ingested_at", T.StringType())])
    return spark.read.schema(schema).parquet(f"{root}/city_report")


def _finished_and_unfinished_runs(spark: SparkSession, sf_dir: str) -> str:
    """Two committed runs, in two formats, and one that ended before its manifest was written."""
    root = fresh_path(spark, "committed-runs")
    report = write_table(_presc_report(spark, sf_dir), "presc-report")
    runs.write_run(report, root, "presc", "2024-01-07")
    runs.write_run(report.filter("presc_state < 'NATION_2'"), root, "presc", "2024-01-14", "csv")
    files.write_run(report, root, "presc", "2024-01-21")
    return root


@query
def sink_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of finished runs; those of the unfinished one are not seen."""
    root = _finished_and_unfinished_runs(spark, sf_dir)
    return runs.read_runs(spark, root, "presc", schemas.PRESCRIBER_REPORT)


@query
def dq_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fingerprint that each finished run's manifest states, and those of its files."""
    root = _finished_and_unfinished_runs(spark, sf_dir)
    return runs.check_runs(spark, root, "presc", schemas.PRESCRIBER_REPORT)


@query
def sink_create_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "create-once")
    files.write_once(_city_report(spark, sf_dir), path)
    return readers.read_report_csv(spark, path, schemas.CITY_REPORT)


@query
def warehouse_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a database load would insert: empty texts are null."""
    return tables.warehouse_rows(_presc_report(spark, sf_dir))


@query
def report_tables_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _save_tables(spark, sf_dir)
    return spark.sql(
        f"""
        select c.state_name, c.cities, c.claims, p.listed_rows, p.top_claims
        from (select state_name, count(*) as cities, sum(trx_counts) as claims
              from {database}.city_report group by state_name) c
        join (select upper(concat('State of ', presc_state)) as state_name,
                     count(*) as listed_rows, max(trx_cnt) as top_claims
              from {database}.prescriber_report group by presc_state) p
          on c.state_name = p.state_name
        """
    )


def _partitioned_report(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The prescriber report as a warehouse table with a folder per state, and its path."""
    path = fresh_path(spark, "partitioned")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {database} location '{path}'")
    table = f"{database}.prescriber_report"
    tables.save_partitioned(_presc_report(spark, sf_dir), table, f"{path}/report", ["presc_state"])
    return table, path


@query
def report_tables_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed prescribers of the states that have a city of fewer than 5,000 people; folders of
    other states are not read."""
    table, _ = _partitioned_report(spark, sf_dir)
    small = _city(spark, sf_dir).filter("population < 5000").select("state_id").distinct()
    rows = spark.table(table)
    return rows.join(small, rows.presc_state == small.state_id).select(schemas.PRESCRIBER_REPORT.names)


@query
def report_tables_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two states were loaded again, with fewer rows; the others stay."""
    table, path = _partitioned_report(spark, sf_dir)
    again = _presc_report(spark, sf_dir).filter("presc_state in ('NATION_1', 'NATION_2') and trx_cnt >= 49")
    tables.save_partitioned(again, table, f"{path}/report", ["presc_state"])
    return spark.table(table).select(schemas.PRESCRIBER_REPORT.names)


@query
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact whose texts hold line breaks, quotes and separators, read back record by record."""
    fact = fixtures.prescriber_fact(spark, sf_dir)
    odd = ["concat('line\none, ', npi)", "concat('\n\n', npi, '\n')", "'say \"no\"\n'", "specialty_description"]
    picked = F.expr(f"case npi % 4 when 0 then {odd[0]} when 1 then {odd[1]} when 2 then {odd[2]} else {odd[3]} end")
    path = fresh_path(spark, "csv-quoted-breaks")
    as_it_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fact.withColumn("specialty_description", picked).write.csv(path, header=True, nullValue="", **as_it_is)
    return readers.split_malformed(spark, path, schemas.PRESCRIBER_FACT, line_breaks=True)[0]


@query
def csv_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with blanks at both ends, quotes, separators, backslashes, line breaks, '' and null."""
    odd = ["' lead'", "'trail '", "'a \"b\" c'", "'a,b'", "'back\\\\slash'", "'two\\nlines'", "''", "'\\\\N'", "null"]
    cities = fixtures.city_dim(spark, sf_dir)
    picked = F.expr(f"element_at(array({', '.join(odd)}), cast(population % {len(odd)} as int) + 1)")
    rows = cities.select("city", "state_id", "population", picked.alias("odd"))
    path = fresh_path(spark, "csv-lossless")
    files.write_csv(rows, path)
    return readers.read_report_csv(spark, path, rows.schema)


def _job_report(spark: SparkSession, sf_dir: str, fact: str, name: str, schema: T.StructType, **options: str) -> DataFrame:
    """One report of a whole run, read back from its CSV sink."""
    root = fresh_path(spark, "job")
    job.run(spark, fixtures.city_path(spark, sf_dir), fact, [job.csv_sink(root)], **options)
    return readers.read_report_csv(spark, f"{root}/{name}.csv", schema)


@query
def whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from its two input files to the CSV reports; returns its row counts."""
    city = fixtures.city_path(spark, sf_dir)
    fact = fixtures.prescriber_csv_path(spark, sf_dir)
    return job.run(spark, city, fact, [job.csv_sink(fresh_path(spark, "job"))]).row_counts


@query
def job_city_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fixtures.prescriber_csv_path(spark, sf_dir)
    return _job_report(spark, sf_dir, fact, "city", schemas.CITY_REPORT)


@query
def job_prescriber_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fixtures.prescriber_csv_path(spark, sf_dir)
    return _job_report(spark, sf_dir, fact, "top5_prescribers", schemas.PRESCRIBER_REPORT)


@query
def job_with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city report of a run that sets malformed lines aside."""
    fact, bad = _lines_with_errors(spark, sf_dir), fresh_path(spark, "bad-lines")
    return _job_report(spark, sf_dir, fact, "city", schemas.CITY_REPORT, bad_lines=bad)


@query
def job_with_bad_lines_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prescriber report of such a run."""
    fact, bad = _lines_with_errors(spark, sf_dir), fresh_path(spark, "bad-lines")
    return _job_report(spark, sf_dir, fact, "top5_prescribers", schemas.PRESCRIBER_REPORT, bad_lines=bad)
