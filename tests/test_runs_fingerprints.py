"""Fingerprints, committed runs and the two-phase database load."""

import json
import pathlib

import pytest

from claimworks import job, schemas
from claimworks.operators import fingerprint as fp
from claimworks.sinks import files, runs, tables

ROWS = "k int, t string, d double"


@pytest.fixture
def report(spark):
    return spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "", 1e300), (3, "", 1e300)], ROWS)


def test_fingerprint_is_free_of_order_and_partitions(report):
    expected = fp.of(report)
    assert expected.rows == 4
    assert fp.of(report.orderBy("d").repartition(3)) == expected
    assert fp.of(report.unionByName(report)).total == 2 * expected.total


@pytest.mark.parametrize(
    "change",
    [
        "k, t, case when k = 1 then d + 1e-15 else d end as d", "k, coalesce(t, '') as t, d",
        "case when k = 1 then 2 when k = 2 then 1 else k end as k, t, d", "k, case when t = '' then null else t end as t, d",
        "k, case when k = 1 then 'a ' else t end as t, d",
    ],
)
def test_one_differing_value_changes_the_fingerprint(report, change):
    expected, changed = fp.of(report), fp.of(report.selectExpr(*_split(change)))
    assert changed.rows == expected.rows and changed.total != expected.total
    with pytest.raises(ValueError, match="other values"):
        fp.require_same("x", expected, changed)


def _split(text):
    parts, depth = [""], 0
    for part in text.replace("(", " ( ").replace(")", " ) ").split(" "):
        depth += (part == "(") - (part == ")")
        if part.endswith(",") and not depth:
            parts[-1] += " " + part[:-1]
            parts.append("")
        else:
            parts[-1] += " " + part
    return parts


def test_values_do_not_run_into_one_another(spark):
    schema = "a string, b string"
    rows = [("1", "2:"), ("12", ":"), (None, "n"), ("n", None), ("", None), (None, "")]
    totals = {fp.of(spark.createDataFrame([row], schema)).total for row in rows}
    assert len(totals) == len(rows)


def test_empty_and_nested_frames(spark):
    assert fp.of(spark.createDataFrame([], ROWS)) == fp.Fingerprint(0, 0)
    with pytest.raises(ValueError, match="nested columns: b"):
        fp.of(spark.createDataFrame([(1, [1])], "a int, b array<int>"))


def test_a_sink_that_changes_a_value_fails_the_job(spark, cities, fact, tmp_path):
    cities({"city": "SPRINGFIELD"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.parquet(f"{tmp_path}/fact")
    wrong = lambda df, name: df.selectExpr("*").replace("Illinois".upper(), "Indiana")
    with pytest.raises(ValueError, match="city holds other values"):
        job.run(spark, f"{tmp_path}/city", f"{tmp_path}/fact", [wrong], fact_format="parquet")


# --- committed runs ------------------------------------------------------------


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_only_committed_runs_are_read(spark, report, tmp_path, file_format):
    root = str(tmp_path)
    manifest = runs.write_run(report.repartition(2), root, "r", "s1", file_format)
    assert {(r.file_name is None, r.row_count) for r in manifest.collect()} >= {(True, 4)}
    # a run that died before its manifest was written
    files.write_run(report, root, "r", "s2", file_format)
    found = runs.read_runs(spark, root, "r", report.schema)
    assert {r.ingested_at for r in found.collect()} == {"s1"}
    assert fp.of(found.drop("ingested_at")) == fp.of(report)
    runs.write_run(report.limit(1), root, "r", "s2", file_format)
    found = runs.read_runs(spark, root, "r", report.schema)
    assert sorted(r.ingested_at for r in found.collect()) == ["s1"] * 4 + ["s2"]
    assert runs.read_runs(spark, root, "r", report.schema, ["s2"]).count() == 1


def test_stray_files_are_not_read_and_missing_ones_fail(spark, report, tmp_path):
    root = str(tmp_path)
    runs.write_run(report.coalesce(1), root, "r", "s1")
    report.coalesce(1).write.mode("append").parquet(f"{root}/r/ingested_at=s1")
    assert runs.read_runs(spark, root, "r", report.schema).count() == 4
    checked = runs.check_runs(spark, root, "r", report.schema).first()
    assert (checked.manifest_rows, checked.manifest_fingerprint) == (checked.row_count, checked.fingerprint)
    names = {r.file_name for r in runs.list_runs(spark, root, "r").collect()}
    [gone] = [p for p in pathlib.Path(f"{root}/r/ingested_at=s1").glob("part-*") if p.name in names]
    gone.unlink()
    with pytest.raises(Exception, match="(?i)does not exist|PATH_NOT_FOUND"):
        runs.read_runs(spark, root, "r", report.schema).count()


def test_a_repeated_run_is_withdrawn_before_it_is_written(spark, report, tmp_path, monkeypatch):
    root = str(tmp_path)
    runs.write_run(report, root, "r", "s1")

    def dies(*args):
        raise OSError("lost")

    monkeypatch.setattr(files, "write_run", dies)
    with pytest.raises(OSError, match="lost"):
        runs.write_run(report, root, "r", "s1")
    assert runs.read_runs(spark, root, "r", report.schema).count() == 0


def test_a_run_can_refuse_to_be_replaced(spark, report, tmp_path):
    root = str(tmp_path)
    runs.write_run(report, root, "r", "s1", replace=False)
    with pytest.raises(FileExistsError):
        runs.write_run(report.limit(1), root, "r", "s1", replace=False)
    assert runs.read_runs(spark, root, "r", report.schema).count() == 4


def test_the_manifest_of_an_empty_run(spark, report, tmp_path):
    runs.write_run(report.limit(0), str(tmp_path), "r", "s1")
    [line] = runs.list_runs(spark, str(tmp_path), "r").filter("file_name is null").collect()
    assert (line.row_count, line.fingerprint) == (0, 0)
    assert runs.read_runs(spark, str(tmp_path), "r", report.schema).count() == 0
    assert runs.list_runs(spark, str(tmp_path), "other").count() == 0
    assert not list(pathlib.Path(f"{tmp_path}/r/_manifests").glob("_draft*"))
    text = pathlib.Path(f"{tmp_path}/r/_manifests/s1.json").read_text()
    assert json.loads(text.splitlines()[0])["ingested_at"] == "s1"


# --- the database load: no database runs here, its connection is recorded -----------------


class Recorded:
    """A connection that notes what it is told; ``fails`` is a statement that raises."""

    def __init__(self, rows=4, fails=None):
        self.said, self.rows, self.fails = [], rows, fails

    def setAutoCommit(self, on):
        self.said.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def execute(self, text):
        self.said.append(text)
        if self.fails and text.startswith(self.fails):
            raise RuntimeError(f"refused: {text}")

    def executeQuery(self, text):
        self.said.append(text)
        return self

    def next(self):
        return True

    def getLong(self, column):
        return self.rows

    def commit(self):
        self.said.append("commit")

    def rollback(self):
        self.said.append("rollback")

    def close(self):
        pass


@pytest.fixture
def loaded(monkeypatch, report):
    """Runs a load against a recorded connection, with parquet in place of the staging table."""

    def run(connection, staged=lambda df: df):
        seen = {}
        monkeypatch.setattr(tables, "write_jdbc", lambda df, url, table, *rest: (
            connection.said.append(f"load {table}"), seen.update(rows=df)))
        monkeypatch.setattr(tables, "staged_rows", lambda spark, url, table, schema, *rest: (
            tables.without_repeats(staged(seen["rows"]), schema.names)))
        monkeypatch.setattr(tables, "create_jdbc", lambda df, url, table, properties: (
            connection.said.append(f"create {table}")))
        tables.load_jdbc(report, "jdbc:x", "city_report", "t1", connect=lambda: connection)
        return connection.said

    return run


STAGING = "city_report_staging_t1"
MOVE = [
    "autocommit False", "delete from city_report",
    f"insert into city_report (k, t, d) select k, t, d from (select distinct load_row, k, t, d from {STAGING}) staged",
    "select count(*) from city_report",
]


def test_load_touches_the_live_table_in_one_transaction(loaded):
    assert loaded(Recorded()) == [
        f"load {STAGING}", "create city_report", *MOVE, "commit", "autocommit True", f"drop table {STAGING}",
    ]


def test_a_failing_insert_rolls_back_and_drops_the_staging_table(loaded):
    connection = Recorded(fails="insert")
    with pytest.raises(RuntimeError, match="refused: insert"):
        loaded(connection)
    assert connection.said[-3:] == ["rollback", "autocommit True", f"drop table {STAGING}"]
    assert "commit" not in connection.said


def test_a_differing_count_rolls_back(loaded):
    connection = Recorded(rows=5)
    with pytest.raises(ValueError, match="would hold 5 rows after loading 4"):
        loaded(connection)
    assert "rollback" in connection.said and "commit" not in connection.said


@pytest.mark.parametrize("damage", ["rows", "values"])
def test_wrong_staging_rows_never_reach_the_live_table(loaded, damage):
    connection = Recorded()
    change = (lambda df: df.limit(3)) if damage == "rows" else (lambda df: df.fillna({"d": 0.0}))
    with pytest.raises(ValueError, match="holds"):
        loaded(connection, staged=change)
    assert connection.said == [f"load {STAGING}", "autocommit True", f"drop table {STAGING}"]


def test_rows_of_a_repeated_task_come_once(loaded):
    """A task whose insert was committed and which then ran again: same rows, same numbers."""
    assert "commit" in loaded(Recorded(), staged=lambda df: df.unionByName(df.limit(3)))


def test_load_token_must_fit_a_table_name(report):
    with pytest.raises(ValueError, match="token"):
        tables.load_jdbc(report, "jdbc:x", "t", "a-b; drop", connect=Recorded)


# --- from the command line -----------------------------------------------------------


@pytest.fixture
def arguments(cities, fact, tmp_path):
    cities({"city": "springfield", "state_id": "il"}).write.parquet(f"{tmp_path}/city")
    fact({}).write.parquet(f"{tmp_path}/fact")
    return [
        "--city", f"{tmp_path}/city", "--fact", f"{tmp_path}/fact", "--fact-format", "parquet", "--out", f"{tmp_path}/out",
        "--normalize-keys",
    ]


def test_committed_runs_from_the_command_line(spark, arguments, tmp_path):
    job.main([*arguments, "--sink", "committed", "--stamp", "s1"])
    assert (tmp_path / "out/runs/city/_manifests/s1.json").exists()
    assert runs.read_runs(spark, f"{tmp_path}/out/runs", "city", schemas.CITY_REPORT).count() == 1
    with pytest.raises(ValueError, match="--stamp"):
        job.main([*arguments, "--sink", "committed"])


def test_the_database_sink_from_the_command_line(arguments, monkeypatch):
    seen = []
    monkeypatch.setattr(tables, "load_jdbc", lambda df, url, table, token, properties, connect: seen.append(
        (url, table, token, properties)))
    job.main([*arguments, "--sink", "jdbc", "--jdbc-url", "jdbc:x", "--jdbc-property", "user=u", "--stamp", "s1"])
    assert sorted(seen) == [("jdbc:x", name, "s1", {"user": "u"}) for name in ("city_report", "prescriber_report")]
    with pytest.raises(ValueError, match="--jdbc-url"):
        job.main([*arguments, "--sink", "jdbc"])


def test_loaded_tables_are_checked_from_the_command_line(spark, tmp_path):
    spark.range(3).write.option("path", f"{tmp_path}/t").saveAsTable("some_rows")
    spark.range(0).write.option("path", f"{tmp_path}/e").saveAsTable("no_rows")
    try:
        job.main(["--check-tables", " some_rows"])
        with pytest.raises(Exception, match="no rows in no_rows"):
            job.main(["--check-tables", "some_rows, no_rows"])
        with pytest.raises(SystemExit):
            job.main(["--city", "x"])
    finally:
        for table in ("some_rows", "no_rows"):
            spark.sql(f"drop table {table}")
