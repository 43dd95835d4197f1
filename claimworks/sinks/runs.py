"""Run folders that count only when they are finished.

A run's files lie in ``<root>/<key>/ingested_at=<stamp>``.  When all are written they are read
back, file by file, and compared with what was seen while writing; only then is the run's manifest
put to ``<root>/<key>/_manifests/<stamp>.json``, by renaming a file.  Readers start from the
manifests and read the files that these name, so a folder that a failing run left behind, or
that is still being written, is never seen.  A repeated run withdraws its manifest before it
touches a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.operators import fingerprint as fp
from claimworks.sinks import files
from claimworks.sources.readers import read_report_csv

MANIFESTS = "_manifests"
# One line per file of a run, and one without a file for the whole run (fixed layout).
MANIFEST = "ingested_at string, file_format string, file_name string, file_bytes long, row_count long, \
fingerprint decimal(38,0)"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def rename(spark: SparkSession, source: str, target: str, replace: bool) -> None:
    """One rename, in which a file at ``target`` is replaced, or refuses it."""
    jvm = spark._jvm
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    chosen = spark.sparkContext._gateway.new_array(options, 1)
    chosen[0] = options.OVERWRITE if replace else options.NONE
    qualified = _file_system(spark, target).makeQualified(_path(spark, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        qualified.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(_path(spark, source), _path(spark, target), chosen)


def _folder(root: str, key: str) -> str:
    return f"{root.rstrip('/')}/{key}"


def _manifest_path(root: str, key: str, stamp: str) -> str:
    return f"{_folder(root, key)}/{MANIFESTS}/{stamp}.json"


def _read(spark: SparkSession, schema: T.StructType, file_format: str, paths: str | Sequence[str]) -> DataFrame:
    if file_format == "csv":
        return read_report_csv(spark, paths, schema)
    return spark.read.format(file_format).schema(schema).load(paths)


def _by_file(spark: SparkSession, schema: T.StructType, file_format: str, path: str) -> DataFrame:
    """Rows and fingerprint of each file, as a reader finds them."""
    found = _read(spark, schema, file_format, path)
    named = found.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_bytes"))
    measured = named.groupBy("_file", "_bytes").agg(*fp.measures(schema))
    return measured.withColumnsRenamed({"_file": "file_name", "_bytes": "file_bytes"})


def _put_manifest(lines: DataFrame, target: str, replace: bool) -> None:
    """Write the lines to one file beside the target and rename it."""
    spark = lines.sparkSession
    draft = f"{target.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}"
    lines.coalesce(1).write.json(draft)
    system = _file_system(spark, draft)
    try:
        [part] = [s.getPath() for s in system.listStatus(_path(spark, draft)) if s.getPath().getName().startswith("part-")]
        rename(spark, part.toString(), target, replace)
    finally:
        system.delete(_path(spark, draft), True)


def write_run(
    df: DataFrame, root: str, key: str, stamp: str, file_format: str = "parquet", replace: bool = True
) -> DataFrame:
    """Write, check and commit one run; returns its manifest.

    ``replace=False`` refuses a stamp that is committed already, also if another writer
    commits it first.
    """
    spark, target = df.sparkSession, _manifest_path(root, key, stamp)
    if exists(spark, target):
        if not replace:
            raise FileExistsError(f"run {stamp} of {key} is committed already")
        _file_system(spark, target).delete(_path(spark, target), False)
    seen = Observation()
    path = files.write_run(df.observe(seen, *fp.measures(df.schema)), root, key, stamp, file_format)
    written = fp.Fingerprint.seen(seen)
    by_file = _by_file(spark, df.schema, file_format, path).cache()
    try:
        total = by_file.agg(F.sum(fp.ROWS), F.sum(fp.SUM)).first()
        found = fp.Fingerprint(total[0] or 0, total[1] or 0)
        if found != written:
            raise ValueError(f"run {stamp} of {key} wrote {written} and holds {found}")
        layout = f"file_name string, file_bytes long, {fp.ROWS} long, {fp.SUM} decimal(38,0)"
        whole = spark.createDataFrame([(None, None, written.rows, written.total)], layout)
        lines = whole.unionByName(by_file)
        named = lines.select(F.lit(stamp).alias("ingested_at"), F.lit(file_format).alias("file_format"), "*")
        _put_manifest(named, target, replace)
    finally:
        by_file.unpersist()
    return list_runs(spark, root, key).filter(F.col("ingested_at") == stamp)


def list_runs(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The manifests of all committed runs: a line per file, and one without a file per run."""
    if not exists(spark, f"{_folder(root, key)}/{MANIFESTS}"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{_folder(root, key)}/{MANIFESTS}")


def read_runs(
    spark: SparkSession, root: str, key: str, schema: T.StructType, stamps: Sequence[str] | None = None
) -> DataFrame:
    """The rows of committed runs, all or those of ``stamps``, with the run in ``ingested_at``.

    Reads exactly the files that the manifests name; one that is missing fails the query.
    """
    named = list_runs(spark, root, key).filter(F.col("file_name").isNotNull())
    if stamps is not None:
        named = named.filter(F.col("ingested_at").isin(*stamps))
    by_format: dict[str, list[str]] = {}
    # file names, which the driver lists for any scan
    for row in named.select("ingested_at", "file_format", "file_name").collect():
        by_format.setdefault(row.file_format, []).append(
            f"{_folder(root, key)}/ingested_at={row.ingested_at}/{row.file_name}"
        )
    stamp = F.regexp_extract(F.col("_metadata.file_path"), "ingested_at=([0-9A-Za-z_-]+)/", 1)
    empty = T.StructType([*schema.fields, T.StructField("ingested_at", T.StringType())])
    found = spark.createDataFrame([], empty)
    for file_format, paths in sorted(by_format.items()):
        rows = _read(spark, schema, file_format, paths)
        found = found.unionByName(rows.select("*", stamp.alias("ingested_at")))
    return found


def check_runs(spark: SparkSession, root: str, key: str, schema: T.StructType) -> DataFrame:
    """Per committed run the rows and fingerprint of its manifest and of its files now."""
    listed = list_runs(spark, root, key).filter(F.col("file_name").isNull())
    listed = listed.select("ingested_at", F.col(fp.ROWS).alias("manifest_rows"), F.col(fp.SUM).alias("manifest_fingerprint"))
    now = read_runs(spark, root, key, schema).groupBy("ingested_at").agg(*fp.measures(schema))
    found = listed.join(now, "ingested_at", "left")
    return found.withColumns({name: F.coalesce(name, F.lit(0).cast(kind)) for name, kind in
                              ((fp.ROWS, "long"), (fp.SUM, "decimal(38,0)"))})
