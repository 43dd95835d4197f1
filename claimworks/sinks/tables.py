"""Reports as warehouse tables: in Spark's catalog or in a database."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.operators import fingerprint as fp

# Report -> warehouse table (fixed values).
REPORT_TABLES = {"city": "city_report", "top5_prescribers": "prescriber_report"}


def save_table(df: DataFrame, table: str, path: str) -> None:
    """Recreate a catalog table, ``name`` or ``database.name``, whose files lie at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)


def save_partitioned(df: DataFrame, table: str, path: str, by: Sequence[str]) -> None:
    """Put rows into a catalog table with a folder per value of ``by``, replacing only the values that come.

    The table is created when it is not there; its files lie at ``path``.  Rows are rebalanced by ``by``:
    small values share a task and a large one is split over several files.
    """
    spark = df.sparkSession
    names = [name for name in df.columns if name not in by] + list(by)  # a table ends with its partition columns
    writer = df.select(names).hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    if not spark.catalog.tableExists(table):
        writer.option("path", path).format("parquet").saveAsTable(table)
        return
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    described = spark.sql(f"describe table extended {table}").filter("col_name = 'Partition Provider'")
    if not described.isEmpty():  # the catalog keeps a list of folders of its own
        spark.sql(f"alter table {table} recover partitions")
    spark.catalog.refreshTable(table)


def warehouse_rows(df: DataFrame) -> DataFrame:
    """Rows as the warehouse stores them: empty texts are null."""
    return df.select(
        [
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int = 8,
    batch_rows: int = 10_000,
    truncate: bool = False,
) -> None:
    """Replace a database table, each task inserting batches over its own connection.

    ``connections`` bounds the parallel load on the database.  ``truncate`` keeps
    the existing table definition.  A failed insert fails the load.
    """
    options = {
        "numPartitions": connections,
        "batchsize": batch_rows,
        "truncate": truncate,
        **(properties or {}),
    }
    rows = warehouse_rows(df)
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("overwrite").save()


def count_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None
) -> int:
    """Rows of a database table, counted by the database."""
    query = f"select count(*) as row_count from {table}"
    reader = spark.read.format("jdbc").options(url=url, query=query, **(properties or {}))
    return int(reader.load().first()[0])


# Number of a row within one load: a task that is repeated after its insert was committed
# inserts the same numbers again.
LOAD_ROW = "load_row"
Connect = Callable[[], Any]


def connect_jdbc(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None) -> Any:
    """A connection of the driver to the database, as Spark's own writer opens it."""
    jvm = spark._jvm
    given = dict(properties or {})
    if "driver" in given:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(given.pop("driver"))
    java_properties = jvm.java.util.Properties()
    for name, value in given.items():
        java_properties.setProperty(name, str(value))
    return jvm.java.sql.DriverManager.getConnection(url, java_properties)


def staged_rows(
    spark: SparkSession, url: str, staging: str, schema: T.StructType, last: int,
    properties: Mapping[str, str] | None = None, connections: int = 8,
) -> DataFrame:
    """The distinct rows of a staging table, read over several connections by their numbers."""
    options = {
        "partitionColumn": LOAD_ROW, "lowerBound": 0, "upperBound": max(last, 1), "numPartitions": connections,
        **(properties or {}),
    }
    found = spark.read.format("jdbc").options(url=url, dbtable=staging, **options).load()
    return without_repeats(found, schema.names)


def without_repeats(staged: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of a staging table, each number once."""
    return staged.select(LOAD_ROW, *names).distinct().select(*names)


def _execute(connection: Any, *statements: str) -> None:
    for text in statements:
        statement = connection.createStatement()
        try:
            statement.execute(text)
        finally:
            statement.close()


def _single(connection: Any, query: str) -> int:
    statement = connection.createStatement()
    try:
        result = statement.executeQuery(query)
        result.next()
        return result.getLong(1)
    finally:
        statement.close()


def swap(connection: Any, staging: str, table: str, columns: Sequence[str], expected: int) -> None:
    """Replace a table's rows by those of a staging table in one transaction.

    Readers see the old rows until the commit and the new ones from then on.  Rows that a repeated
    task has inserted twice are equal, number included, and come once.  The count is checked
    before the commit; any error rolls back.
    """
    names = ", ".join(columns)
    connection.setAutoCommit(False)
    try:
        _execute(
            connection,
            f"delete from {table}",
            f"insert into {table} ({names}) select {names} from "
            f"(select distinct {LOAD_ROW}, {names} from {staging}) staged",
        )
        loaded = _single(connection, f"select count(*) from {table}")
        if loaded != expected:
            raise ValueError(f"{table} would hold {loaded} rows after loading {expected}")
        connection.commit()
    except BaseException:
        connection.rollback()
        raise


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    token: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    connect: Connect | None = None,
) -> None:
    """Replace the rows of a database table in two phases.

    First all tasks insert into a staging table of this run (its name ends in ``token``), which is read
    back and compared by fingerprint.  Then the driver moves the rows in one transaction, see
    :func:`swap`; the table that readers use is touched by nothing else, except that it is created, empty,
    where it does not exist.  The staging table is dropped whether the load succeeds or fails; one
    that a killed run left behind is dropped by the next load with its token.
    """
    if not re.fullmatch(r"[0-9A-Za-z_]+", token):
        raise ValueError(f"load token {token!r} must be letters, digits and '_' only")
    spark, staging = df.sparkSession, f"{table}_staging_{token}"
    rows = warehouse_rows(df)
    numbered = rows.withColumn(LOAD_ROW, F.monotonically_increasing_id())
    count, total, last = numbered.agg(*fp.measures(rows.schema), F.max(LOAD_ROW)).first()
    expected = fp.Fingerprint(count, total)
    connection = (connect or (lambda: connect_jdbc(spark, url, properties)))()
    try:
        try:
            write_jdbc(numbered, url, staging, properties, connections)
            staged = staged_rows(spark, url, staging, rows.schema, last or 0, properties, connections)
            fp.require_same(staging, expected, fp.of(staged))
            create_jdbc(rows, url, table, properties)
            swap(connection, staging, table, rows.columns, expected.rows)
        finally:
            connection.setAutoCommit(True)
            _execute(connection, f"drop table {staging}")
    finally:
        connection.close()


def create_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Create an empty table for the rows where there is none."""
    empty = df.limit(0).write.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    empty.mode("append").save()
