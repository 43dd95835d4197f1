import pathlib

import pytest
from pyspark.errors import PySparkException

from claimworks import fixtures, job, schemas
from claimworks.operators import quality, reports
from claimworks.plans import workspace
from claimworks.sinks import tables
from claimworks.sources import readers

SF_DIR = "/root/testdata/sf0.001"


def test_row_counts(spark):
    frame = quality.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.frame_name: r.row_count for r in frame.collect()} == {"a": 3, "b": 0}


def test_column_profile(fact):
    rows = {r.column_name: r for r in quality.column_profile(fact({}, {"npi": None})).collect()}
    assert len(rows) == len(schemas.PRESCRIBER_FACT)
    npi = rows["npi"]
    assert (npi.position, npi.data_type, npi.row_count, npi.null_count) == (0, "bigint", 2, 1)


def test_column_profile_of_an_empty_frame(fact):
    rows = quality.column_profile(fact({}).limit(0)).collect()
    assert {(r.row_count, r.null_count) for r in rows} == {(0, 0)}


def test_table_names_are_trimmed():
    assert quality.table_names("a, b") == ["a", "b"]
    assert quality.table_names(["a ", "b"]) == ["a", "b"]


def test_empty_table_fails_the_check(spark, tmp_path):
    tables.save_table(spark.range(2), "filled", f"{tmp_path}/f")
    tables.save_table(spark.range(0), "hollow", f"{tmp_path}/h")
    assert [tuple(r) for r in quality.loaded_tables(spark, "filled").collect()] == [("filled", 2)]
    with pytest.raises(PySparkException, match="no rows in hollow"):
        quality.loaded_tables(spark, "filled, hollow").collect()
    with pytest.raises(PySparkException, match="no rows in hollow"):
        quality.loaded_tables(spark, "filled, hollow").count()
    with pytest.raises(PySparkException, match="no rows in hollow"):
        quality.loaded_tables(spark, "filled, hollow").select("table_name").collect()
    spark.sql("drop table filled")
    spark.sql("drop table hollow")


def test_contract_check_names_every_difference(spark):
    frame = spark.range(1).selectExpr("cast(id as int) as city", "1 as extra")
    with pytest.raises(ValueError) as error:
        quality.require_contract(frame, schemas.CITY_REPORT, "city report")
    for part in ("city report", "missing column zip_counts", "unexpected column extra", "city is int"):
        assert part in str(error.value)


def test_preview_is_ordered(spark):
    rows = quality.preview(spark.range(100).repartition(7), ["id"], 3).collect()
    assert [r.id for r in rows] == [0, 1, 2]


def test_job_writes_the_same_reports_to_every_sink(spark, tmp_path):
    root = str(tmp_path)
    sinks = [
        job.csv_sink(f"{root}/csv"),
        job.parquet_sink(f"{root}/parquet"),
        job.run_sink(f"{root}/runs", "2024-01-07"),
        job.create_once_sink(f"{root}/once"),
        job.table_sink(f"{root}/tables"),
    ]
    result = job.run(
        spark, fixtures.city_path(spark, SF_DIR), fixtures.prescriber_csv_path(spark, SF_DIR), sinks
    )
    counts = {r.frame_name: r.row_count for r in result.row_counts.collect()}
    assert counts == {"df_city": 130, "df_fact": 6000, "city_report": 82, "prescriber_report": 280, "malformed_lines": 0}
    for name, schema in (("city", schemas.CITY_REPORT), ("top5_prescribers", schemas.PRESCRIBER_REPORT)):
        expected = sorted(spark.table(tables.REPORT_TABLES[name]).collect(), key=str)
        for found in (
            readers.read_report_csv(spark, f"{root}/csv/{name}.csv", schema),
            readers.read_report_csv(spark, f"{root}/once/{name}.csv", schema),
            spark.read.parquet(f"{root}/parquet/{name}.parquet"),
            spark.read.parquet(f"{root}/runs/{name}/ingested_at=2024-01-07"),
        ):
            assert sorted(found.collect(), key=str) == expected
    assert len(result.preview.collect()) == 10


def test_job_on_a_parquet_fact_at_prescriber_grain(spark):
    result = job.run(
        spark, fixtures.city_path(spark, SF_DIR), fixtures.prescriber_path(spark, SF_DIR), [],
        fact_format="parquet", grain=reports.PRESCRIBER,
    )
    assert result.prescriber_report.count() == 69


def test_job_fails_on_an_empty_report(spark, cities, fact, tmp_path):
    cities({"city": "Elsewhere"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.parquet(f"{tmp_path}/fact")
    with pytest.raises(PySparkException, match="no rows in city_report"):
        job.run(spark, f"{tmp_path}/city", f"{tmp_path}/fact", [], fact_format="parquet")


def test_job_normalizes_keys_on_request(spark, cities, fact, tmp_path):
    cities({"state_id": "il"}).write.parquet(f"{tmp_path}/city")
    rows = fact({"nppes_provider_city": "Springfield", "nppes_provider_state": "Il"})
    rows.write.parquet(f"{tmp_path}/fact")
    result = job.run(
        spark, f"{tmp_path}/city", f"{tmp_path}/fact", [], fact_format="parquet", normalize_keys=True
    )
    assert [r.presc_counts for r in result.city_report.collect()] == [1]


def test_job_from_the_command_line(spark, tmp_path):
    job.main(
        ["--city", fixtures.city_path(spark, SF_DIR),
         "--fact", fixtures.prescriber_csv_path(spark, SF_DIR), "--out", str(tmp_path)]
    )
    report = readers.read_report_csv(spark, f"{tmp_path}/city.csv", schemas.CITY_REPORT)
    assert report.count() == 82


def test_load_check_notices_repeated_rows(spark, monkeypatch):
    class Silent:
        """A connection that takes everything and counts four rows."""

        def __getattr__(self, name):
            return lambda *args: 4 if name == "getLong" else self

    monkeypatch.setattr(tables, "write_jdbc", lambda *args: None)
    monkeypatch.setattr(tables, "create_jdbc", lambda *args: None)
    monkeypatch.setattr(tables, "staged_rows", lambda *args: spark.range(4))
    sink = job.jdbc_sink("jdbc:x", token="t", connect=Silent)
    sink(spark.range(4), "city")
    with pytest.raises(ValueError, match="city_report_staging_t holds 4 rows after loading 2"):
        sink(spark.range(2), "city")


def test_inputs_are_written_again_when_they_are_gone(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_written", {})
    key = (spark.sparkContext.applicationId, SF_DIR, "city_dim")
    fixtures._written[key] = "/nonexistent/city_dim"
    assert fixtures.city_dim(spark, SF_DIR).count() == 130


def test_contract_compares_the_order(fact):
    frame = fact({})
    assert schemas.contract_violations(frame, schemas.PRESCRIBER_FACT) == []
    [problem] = schemas.contract_violations(frame.select(frame.columns[::-1]), schemas.PRESCRIBER_FACT)
    assert "ordered" in problem


def test_malformed_lines_end_the_job_unless_they_are_set_aside(spark, cities, tmp_path):
    cities({"city": "X"}).write.parquet(f"{tmp_path}/city")
    line = "1,DOE,JO,X,IL,D,= 30,ASPIRIN,{},30,1.5"
    text = "\n".join([",".join(schemas.PRESCRIBER_FACT.names), line.format(10), line.format("ten"), "1,DOE", ""])
    (tmp_path / "fact.csv").write_text(text)
    inputs = spark, f"{tmp_path}/city", f"{tmp_path}/fact.csv"
    with pytest.raises(ValueError, match="2 malformed lines"):
        job.run(*inputs, [])
    result = job.run(*inputs, [], bad_lines=f"{tmp_path}/bad")
    assert [r.trx_counts for r in result.city_report.collect()] == [10]
    counts = {r.frame_name: r.row_count for r in result.row_counts.collect()}
    assert (counts["df_fact"], counts["malformed_lines"]) == (1, 2)
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/bad").collect()) == sorted(["1,DOE", line.format("ten")])


def test_sinks_are_checked_after_writing(spark, cities, fact, tmp_path):
    cities({"city": "SPRINGFIELD"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.parquet(f"{tmp_path}/fact")
    with pytest.raises(ValueError, match="city holds 0 rows after loading 1"):
        job.run(
            spark, f"{tmp_path}/city", f"{tmp_path}/fact", [lambda df, name: df.limit(0)], fact_format="parquet"
        )


@pytest.mark.parametrize(
    "kind, place",
    [("csv", "city.csv"), ("parquet", "city.parquet"), ("table", "tables/city_report"),
     ("run", "runs/city/ingested_at=s1"), ("once", "once/city.csv")],
)
def test_sinks_from_the_command_line(spark, cities, fact, tmp_path, kind, place):
    cities({"city": "springfield", "state_id": "il"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.parquet(f"{tmp_path}/fact")
    job.main(
        ["--city", f"{tmp_path}/city", "--fact", f"{tmp_path}/fact", "--fact-format", "parquet",
         "--out", f"{tmp_path}/out", "--sink", kind, "--stamp", "s1", "--normalize-keys"]
    )
    assert (tmp_path / "out" / place / "_SUCCESS").exists()
    for table in tables.REPORT_TABLES.values():
        spark.sql(f"drop table if exists {table}")


def test_only_the_reports_stay_after_a_run(spark, cities, fact, tmp_path):
    cities({"city": "SPRINGFIELD"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.csv(f"{tmp_path}/fact", header=True)
    folder = pathlib.Path(workspace.work_dir(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    result = job.run(spark, f"{tmp_path}/city", f"{tmp_path}/fact", [])
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert left == {"city-report", "prescriber-report"}
    assert result.preview.count() == 1


def test_works_that_run_together_are_all_waited_for(spark):
    ended = []

    def fails():
        raise ValueError("first")

    def works():
        ended.append(spark.range(5).count())
        return ended[0]

    with pytest.raises(ValueError, match="first"):
        job._together(spark, fails, works)
    assert ended == [5]
    assert job._together(spark, works, works) == [5, 5]
