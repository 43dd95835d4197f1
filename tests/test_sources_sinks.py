import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import readwriter

from claimworks import schemas
from claimworks.sinks import files, tables
from claimworks.sources import readers

REPORT_ROWS = [
    (1, "", "IL", "USA", 30, 5, 10, 1.5),
    (2, None, None, "USA", None, None, None, None),
    (3, 'quoted "x", y', "OH", "USA", 20, 1, 2, 0.1),
]


@pytest.fixture
def small_report(spark):
    return spark.createDataFrame(REPORT_ROWS, schemas.PRESCRIBER_REPORT)


def rows_of(frame):
    return sorted([tuple(row) for row in frame.collect()], key=str)


def test_csv_keeps_null_and_empty_text_apart(spark, small_report, tmp_path):
    path = f"{tmp_path}/r.csv"
    for _ in range(2):  # the second write replaces the first
        files.write_csv(small_report, path)
    back = readers.read_report_csv(spark, path, schemas.PRESCRIBER_REPORT)
    assert rows_of(back) == sorted(REPORT_ROWS, key=str)


def test_parquet_round_trip(spark, small_report, tmp_path):
    path = f"{tmp_path}/r.parquet"
    for _ in range(2):
        files.write_parquet(small_report, path)
    assert rows_of(spark.read.parquet(path)) == sorted(REPORT_ROWS, key=str)


def test_fact_csv_round_trip_and_inference(spark, fact, tmp_path):
    written = fact({}, {"npi": None, "total_claim_count": None, "years_of_exp": "N/A"})
    path = f"{tmp_path}/fact"
    written.write.csv(path, header=True, nullValue="")
    declared = readers.read_prescriber_fact(spark, path)
    assert declared.schema == schemas.PRESCRIBER_FACT
    assert rows_of(declared) == rows_of(written)
    inferred = readers.read_prescriber_fact(spark, path, infer=True)
    assert dict(inferred.dtypes)["npi"] == "int"
    assert rows_of(schemas.conform(inferred, schemas.PRESCRIBER_FACT)) == rows_of(written)


def test_city_dim_in_another_format(spark, cities, tmp_path):
    cities({}).write.orc(f"{tmp_path}/c")
    assert rows_of(readers.read_city_dim(spark, f"{tmp_path}/c", "orc")) == rows_of(cities({}))


@pytest.fixture
def messy_csv(tmp_path):
    header = ",".join(schemas.PRESCRIBER_FACT.names)
    good = ["1,DOE,JO,X,IL,D,= 5,ASPIRIN,3,30,1.5", ",,,,,,,,,,"]
    bad = ["1,DOE,JO,X,IL,D,= 5,ASPIRIN,three,30,1.5", "1,DOE,JO,X,IL,D,= 5,ASPIRIN,3,30,1.5,more", "1,DOE"]
    folder = tmp_path / "messy"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([header, good[0], bad[0], ""]))
    (folder / "b.csv").write_text("\n".join([header, bad[1], "", good[1], bad[2]]))
    return str(folder), bad


def test_malformed_lines_are_set_aside(spark, messy_csv):
    path, bad_lines = messy_csv
    good, bad = readers.split_malformed(spark, path, schemas.PRESCRIBER_FACT)
    assert sorted(row[0] for row in bad.collect()) == sorted(bad_lines)
    assert good.schema == schemas.PRESCRIBER_FACT
    assert [r.total_claim_count for r in good.orderBy("npi").collect()] == [None, 3]


def test_selected_columns_do_not_change_which_lines_are_good(spark, messy_csv):
    good, bad = readers.split_malformed(spark, messy_csv[0], schemas.PRESCRIBER_FACT)
    assert good.count() == good.select("npi").count() == len(good.select("npi").collect()) == 2
    assert bad.count() == 3
    counts = readers.count_malformed(spark, messy_csv[0], schemas.PRESCRIBER_FACT)
    assert sorted(map(tuple, counts.collect())) == [("good", 2), ("malformed", 3)]


def test_each_run_has_its_own_folder(spark, small_report, tmp_path):
    root = str(tmp_path)
    first = files.write_run(small_report, root, "presc", "2024-01-07")
    files.write_run(small_report.limit(1), root, "presc", "2024-01-14", "csv")
    files.write_run(small_report, root, "presc", "2024-01-07")
    assert first == f"{root}/presc/ingested_at=2024-01-07"
    assert spark.read.parquet(first).count() == 3
    assert spark.read.csv(f"{root}/presc/ingested_at=2024-01-14", header=True).count() == 1


def test_run_stamp_must_fit_a_path(small_report, tmp_path):
    with pytest.raises(ValueError, match="stamp"):
        files.write_run(small_report, str(tmp_path), "presc", "2024-01-07_10:00:00")


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_create_once_refuses_to_overwrite(small_report, tmp_path, file_format):
    files.write_once(small_report, f"{tmp_path}/once", file_format)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        files.write_once(small_report, f"{tmp_path}/once", file_format)


def test_catalog_table_is_recreated(spark, small_report, tmp_path):
    for count in (3, 1):
        tables.save_table(small_report.limit(count), "some_report", f"{tmp_path}/t")
        assert spark.table("some_report").count() == count
    spark.sql("drop table some_report")


def test_warehouse_rows_turn_empty_text_into_null(small_report):
    names = [r.presc_fullname for r in tables.warehouse_rows(small_report).orderBy("presc_id").collect()]
    assert names == [None, None, 'quoted "x", y']


def test_jdbc_write_options(small_report, monkeypatch):
    """No database runs here: the writer is checked up to the point of saving."""
    seen = {}
    cls = readwriter.DataFrameWriter
    monkeypatch.setattr(cls, "save", lambda self, *a, **k: seen.update(saved=True))
    monkeypatch.setattr(cls, "mode", lambda self, mode: seen.update(mode=mode) or self)
    monkeypatch.setattr(cls, "format", lambda self, fmt: seen.update(format=fmt) or self)
    monkeypatch.setattr(cls, "options", lambda self, **options: seen.update(options) or self)
    tables.write_jdbc(
        small_report, "jdbc:postgresql://host/db", "prescriber_report", {"user": "u"}, connections=4
    )
    assert seen == {
        "saved": True, "mode": "overwrite", "format": "jdbc", "url": "jdbc:postgresql://host/db",
        "dbtable": "prescriber_report", "numPartitions": 4, "batchsize": 10_000,
        "truncate": False, "user": "u",
    }


def test_jdbc_without_driver_fails_loudly(spark, small_report):
    with pytest.raises(Py4JJavaError, match="(?i)No suitable driver"):
        tables.write_jdbc(small_report, "jdbc:nosuch:db", "t")
    with pytest.raises(Py4JJavaError, match="(?i)No suitable driver"):
        tables.count_jdbc(spark, "jdbc:nosuch:db", "t")


def test_report_csv_keeps_every_text(spark, tmp_path):
    texts = [" lead", "trail ", 'a "b"', "a,b", "\\", "\\n", "a\nb", "a\r\nb", "\\\n", "", None, "\\N", '"']
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    files.write_csv(rows, f"{tmp_path}/odd")
    back = readers.read_report_csv(spark, f"{tmp_path}/odd", rows.schema)
    assert [r.t for r in back.orderBy("k").collect()] == texts


def write_fact(path, names, values):
    path.write_text("\n".join([",".join(names), ",".join(values[n] for n in names), ""]))


VALUES = dict(zip(schemas.PRESCRIBER_FACT.names, "1,DOE,JO,X,IL,D,= 5,ASPIRIN,3,30,1.5".split(","))) | {
    "note": "n", "other": "o",
}


def test_fact_is_bound_by_its_header(spark, tmp_path):
    names = ["note", *reversed(schemas.PRESCRIBER_FACT.names), "other"]
    write_fact(tmp_path / "f.csv", names, VALUES)
    expected = [(1, "DOE", "JO", "X", "IL", "D", "= 5", "ASPIRIN", 3, 30, 1.5)]
    path = f"{tmp_path}/f.csv"
    assert rows_of(readers.read_prescriber_fact(spark, path)) == expected
    good, bad = readers.split_malformed(spark, path, schemas.PRESCRIBER_FACT)
    assert (rows_of(good), bad.count()) == (expected, 0)


def test_missing_column_is_named(spark, tmp_path):
    write_fact(tmp_path / "f.csv", schemas.PRESCRIBER_FACT.names[1:], VALUES)
    with pytest.raises(ValueError, match="lacks columns: npi"):
        readers.read_prescriber_fact(spark, f"{tmp_path}/f.csv")


def test_files_with_different_headers_fail(spark, tmp_path):
    names = schemas.PRESCRIBER_FACT.names
    write_fact(tmp_path / "a.csv", names, VALUES)
    write_fact(tmp_path / "b.csv", names[::-1], VALUES)
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        readers.read_prescriber_fact(spark, str(tmp_path)).collect()
    with pytest.raises(PySparkException, match="another header"):
        readers.split_malformed(spark, str(tmp_path), schemas.PRESCRIBER_FACT)[0].collect()


def test_quoted_header_is_a_header(spark, tmp_path):
    names = schemas.PRESCRIBER_FACT.names
    line = ",".join(VALUES[n] for n in names)
    (tmp_path / "q.csv").write_text(",".join(f'"{n}"' for n in names) + "\n" + line + "\n")
    good, bad = readers.split_malformed(spark, f"{tmp_path}/q.csv", schemas.PRESCRIBER_FACT)
    assert (good.count(), bad.count()) == (1, 0)


def test_lines_are_parsed_once(spark, messy_csv):
    good, _ = readers.split_malformed(spark, messy_csv[0], schemas.PRESCRIBER_FACT)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
