"""Tables that a plan writes once and reads again.

They live below the shared folder named by ``spark.checkpoint.dir``, so they
outlive any executor.  The folder is taken as shared, as its setting says, also where it
is a mount with a ``file:`` path.  A written table is parquet: later reads are pruned to the
columns they need and the planner knows the table's true size.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table that may be copied to every executor, measured on its values.
BROADCAST_BYTES = 64 * 1024 * 1024

_local_dir: tempfile.TemporaryDirectory | None = None


def work_dir(spark: SparkSession) -> str:
    """Folder of this application below the session's checkpoint directory."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = _local_fallback(spark)
    return f"{root.rstrip('/')}/claimworks-{spark.sparkContext.applicationId}"


def _local_fallback(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(
            "set spark.checkpoint.dir to a folder all executors share "
            f"(master is {master}, a machine-local folder would not do)"
        )
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.TemporaryDirectory(prefix="claimworks-")
    return _local_dir.name


_scopes: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A path below :func:`work_dir` that nothing has been written to yet.

    Inside :func:`temporary_tables` it is removed at the end unless ``keep`` is set.
    """
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes and not keep:
        _scopes[-1].append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes what is written to fresh paths inside, when it is left."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Lookup:
    """A written table to be joined: the frame that reads it, its size in memory."""

    frame: DataFrame
    size: int

    def fits_broadcast(self, max_bytes: int | None = None) -> bool:
        """Whether it is small enough to be copied to every executor."""
        return self.size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def _value_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
    return F.lit(16)


def write_table(df: DataFrame, label: str, keep: bool = False, by: str | None = None) -> DataFrame:
    """Run ``df`` once, keep it as parquet and return the frame that reads it.

    With ``by``, a column of few values, each value has a folder of its own, which a filter on it
    reads alone.
    """
    path = fresh_path(df.sparkSession, label, keep)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_lookup(df: DataFrame, label: str) -> Lookup:
    """:func:`write_table` for the side of a join that may turn out small.

    Its size, 16 bytes per value plus the text, is measured by the writing job.
    """
    row_bytes = sum((_value_bytes(f) for f in df.schema), F.lit(0).cast("long"))
    measured = Observation()
    table = write_table(df.observe(measured, F.sum(row_bytes).alias("bytes")), label)
    return Lookup(table, measured.get["bytes"] or 0)


def input_state(spark: SparkSession, path: str) -> list[list]:
    """Name, length and time of every file of an input, as its file system lists them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(target, True)
    found = []
    while files.hasNext():
        status = files.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def stage_key(*parts) -> str:
    """A name for what a stage computes: equal for equal inputs and parameters only."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def stage_table(
    spark: SparkSession, root: str, label: str, key: str, compute: Callable[[], tuple[DataFrame, Callable[[], dict]]]
) -> tuple[DataFrame, dict]:
    """A table that a finished stage has left below ``root`` under its key, or that it leaves now; with
    facts about it.

    ``compute`` gives the frame and what returns the facts once it is written.  The facts are put beside
    the table last, by renaming a file: a stage without them is not finished and is computed anew.  Two runs
    with the same key must not compute it at the same time.
    """
    path = f"{root.rstrip('/')}/{label}-{key}"
    facts_path = f"{path}.facts/facts.json"
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    done, hold = (jvm.org.apache.hadoop.fs.Path(p) for p in (facts_path, f"{path}.draft"))
    system = done.getFileSystem(hadoop)
    if not system.exists(done):
        frame, facts = compute()
        frame.write.mode("overwrite").parquet(path)
        # the schema goes with the facts: an empty table's files need not tell it
        line = json.dumps({"schema": frame.schema.jsonValue(), "facts": facts()})
        text = spark.createDataFrame([(line,)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{path}.draft")
        [part] = [s.getPath() for s in system.listStatus(hold) if s.getPath().getName().startswith("part-")]
        system.mkdirs(done.getParent())
        if not system.rename(part, done):
            raise OSError(f"{facts_path} could not be written")
        system.delete(hold, True)
    kept = json.loads(spark.read.text(facts_path).first()[0])
    schema = T.StructType.fromJson(kept["schema"])
    return spark.read.schema(schema).parquet(path), kept["facts"]
