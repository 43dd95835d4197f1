"""The reports in their direct formulation against this library's, on one fact of any size.

The direct forms are what one would write first: a window mean per prescriber, an exact distinct count, a
Python function for the zips, a dense rank over the rows.  The large fact is the folder's repeated
``FORMS_COPIES`` times, other prescribers in each copy, with a third of all rows under one prescriber.  Prints a
JSON line per result with all runs; ``beyond`` is the library's way beyond the broadcast bound.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from claimworks import fixtures  # noqa: E402
from claimworks.operators import clean, impute, reports  # noqa: E402
from claimworks.plans import workspace  # noqa: E402
from claimworks.session import spark_session  # noqa: E402

BUSY = 7  # the prescriber with a third of the rows


def large_fact(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    fact = fixtures.prescriber_fact(spark, sf_dir)
    repeated = fact.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    shifted = F.when(F.col("npi").isNotNull(), F.col("npi") + F.col("copy") * 1_000_000)
    busy = F.when(F.pmod(F.xxhash64("drug_name", "copy", "npi", "total_drug_cost"), F.lit(3)) == 0, F.lit(BUSY))
    return repeated.withColumn("npi", F.coalesce(busy, shifted).cast("long")).drop("copy")


def direct_clean(rows: DataFrame) -> DataFrame:
    mean = F.avg("trx_cnt").over(Window.partitionBy("presc_id"))
    return rows.withColumn("trx_cnt", F.coalesce("trx_cnt", F.round(mean)).cast("int"))


def direct_city(city: DataFrame, rows: DataFrame) -> DataFrame:
    count = F.udf(lambda zips: None if zips is None else len(zips.split(" ")), "int")
    sums = direct_clean(rows).groupBy("presc_state", "presc_city").agg(
        F.count_distinct("presc_id").alias("presc_counts"), F.sum("trx_cnt").alias("trx_counts")
    )
    same = (F.col("state_id") == F.col("presc_state")) & (F.col("city") == F.col("presc_city"))
    return city.withColumn("zip_counts", count("zips")).join(sums, same)


def direct_top(rows: DataFrame) -> DataFrame:
    ranked = Window.partitionBy("presc_state").orderBy(F.desc("trx_cnt"))
    in_range = direct_clean(rows).filter(F.col("years_of_exp").between(20, 50))
    return in_range.withColumn("r", F.dense_rank().over(ranked)).filter("r <= 5")


def timed(frame) -> float:
    start = time.perf_counter()
    frame().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def beyond(frame) -> DataFrame:
    """The frame as it is built with a broadcast bound of 0."""
    bound, workspace.BROADCAST_BYTES = workspace.BROADCAST_BYTES, 0
    try:
        return frame()
    finally:
        workspace.BROADCAST_BYTES = bound


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.TemporaryDirectory(prefix="forms-")
    spark = spark_session("forms", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": scratch.name,
    })
    spark.sparkContext.setLogLevel("ERROR")
    copies = int(os.environ.get("FORMS_COPIES", "20"))
    fact = workspace.write_table(large_fact(spark, sf_dir, copies), "large-fact")
    rows, city = clean.prepare_presc(fact), clean.clean_city(fixtures.city_dim(spark, sf_dir))
    forms = {
        "city report": (partial(direct_city, city, rows), partial(reports.city_report, city, rows)),
        "cleaned fact": (partial(direct_clean, rows), partial(impute.impute_trx, rows)),
        "prescriber report": (partial(direct_top, rows), partial(reports.top_prescribers, rows)),
    }
    print(json.dumps({"rows": fact.count(), "busy": fact.filter(F.col("npi") == BUSY).count()}), flush=True)
    for name, (direct, own) in forms.items():
        ways = {"direct": direct, "own": own, "beyond": partial(beyond, own)}
        print(json.dumps({"result": name, **{way: [timed(f) for _ in range(runs)] for way, f in ways.items()}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
