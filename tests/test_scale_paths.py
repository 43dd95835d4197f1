"""Ways beyond the broadcast bound, and skewed groups: same rows, split work."""

import random
from collections import defaultdict

import pytest
from executed import executed_plan
from pyspark.sql import functions as F

from claimworks.operators import clean, impute, reports
from claimworks.operators.impute import impute_trx, prescriber_totals
from claimworks.operators.rank import value_ranks, with_dense_rank
from claimworks.plans import membership, workspace


def half_up(total, rows):
    return (2 * total + rows) // (2 * rows)


def skewed_rows(seed, n=600):
    """A third of all rows belongs to one prescriber and one state."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(
            {
                "npi": 7 if hot else rng.randrange(100, 140),
                "nppes_provider_state": "HOT" if hot else rng.choice(["IL", "OH", None]),
                "nppes_provider_city": rng.choice(["A", "B", None]),
                "years_of_exp": rng.choice(["10", "20", "= 35", "50", "51", "N/A"]),
                "drug_name": rng.choice(["X", "Y", None]),
                "total_claim_count": rng.choice([None, *range(1, 12)]),
            }
        )
    # prescribers without any count
    return rows + [{"npi": 999, "total_claim_count": None}] * 3


def cleaned_by_hand(rows):
    kept = [dict(row) for row in rows if row["npi"] is not None and row.get("drug_name", "ASPIRIN")]
    known = defaultdict(list)
    for row in kept:
        if row["total_claim_count"] is not None:
            known[row["npi"]].append(row["total_claim_count"])
    for row in kept:
        counts = known[row["npi"]]
        if row["total_claim_count"] is None and counts:
            row["total_claim_count"] = half_up(sum(counts), len(counts))
    return kept


def top_by_hand(kept, n):
    result = []
    groups = defaultdict(list)
    for row in kept:
        if row.get("years_of_exp", "= 30") in ("20", "= 35", "50", "= 30"):
            groups[row.get("nppes_provider_state", "IL")].append(row)
    for state, members in groups.items():
        order = sorted(
            {r["total_claim_count"] for r in members}, key=lambda c: -1 if c is None else c, reverse=True
        )
        result += [
            (state, r["npi"], r["total_claim_count"])
            for r in members
            if r["total_claim_count"] in order[:n]
        ]
    return sorted(result, key=str)


def listed(frame, *names):
    return sorted([tuple(row[name] for name in names) for row in frame.collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_imputation_equals_brute_force(fact, seed, broadcast_bytes):
    raw = skewed_rows(seed)
    frame = impute_trx(clean.prepare_presc(fact(*raw)), broadcast_bytes)
    expected = [(r["npi"], r["total_claim_count"]) for r in cleaned_by_hand(raw)]
    assert listed(frame, "presc_id", "trx_cnt") == sorted(expected, key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("n", [1, 5, 50])
def test_top_rows_equal_brute_force(fact, seed, n):
    raw = skewed_rows(seed)
    frame = reports.top_prescribers(clean.prepare_presc(fact(*raw)), n=n)
    assert listed(frame, "presc_state", "presc_id", "trx_cnt") == top_by_hand(cleaned_by_hand(raw), n)


@pytest.mark.parametrize("n", [None, 3])
def test_rank_without_broadcast_gives_the_same_rows(fact, n):
    rows = clean.clean_presc(fact(*skewed_rows(4)))
    names = ("presc_state", "presc_id", "trx_cnt", "dense_rank")
    small = with_dense_rank(rows, "presc_state", "trx_cnt", n)
    large = with_dense_rank(rows, "presc_state", "trx_cnt", n, broadcast_bytes=0)
    assert listed(small, *names) == listed(large, *names)


def test_city_totals_equal_brute_force(fact):
    raw = skewed_rows(5)
    ids, total = defaultdict(set), defaultdict(int)
    for row in cleaned_by_hand(raw):
        key = (row.get("nppes_provider_state", "IL"), row.get("nppes_provider_city", "SPRINGFIELD"))
        ids[key].add(row["npi"])
        total[key] += row["total_claim_count"] or 0
    frame = reports.city_prescriber_agg(clean.prepare_presc(fact(*raw)))
    found = {
        (r.presc_state, r.presc_city): (r.presc_counts, r.trx_counts or 0) for r in frame.collect()
    }
    assert found == {key: (len(ids[key]), total[key]) for key in ids}


def test_reports_accept_prepared_and_imputed_rows_alike(fact):
    prepared = clean.prepare_presc(fact(*skewed_rows(6)))
    imputed = impute_trx(prepared)
    for report in (
        reports.city_prescriber_agg,
        reports.top_prescribers,
        lambda rows: reports.top_prescribers(rows, grain=reports.PRESCRIBER),
    ):
        names = report(prepared).columns
        assert listed(report(prepared), *names) == listed(report(imputed), *names)


def test_total_grain_equals_summing_imputed_rows(fact):
    raw = skewed_rows(7)
    prepared = clean.prepare_presc(fact(*raw))
    summed = (
        reports.in_experience_range(impute_trx(prepared))
        .groupBy("presc_id", "presc_fullname", "presc_state", "years_of_exp")
        .agg(F.sum("trx_cnt").alias("trx_cnt"), F.sum("total_day_supply").alias("days"))
    )
    totals = reports.in_experience_range(reports.totals_by_prescriber(prepared))
    names = ("presc_id", "presc_state", "years_of_exp", "trx_cnt")
    assert listed(summed, *names, "days") == listed(totals, *names, "total_day_supply")


def test_results_do_not_depend_on_the_partitioning(fact):
    rows = fact(*skewed_rows(8))
    one = reports.top_prescribers(clean.prepare_presc(rows.coalesce(1)))
    many = reports.top_prescribers(clean.prepare_presc(rows.repartition(13)))
    assert listed(one, *one.columns) == listed(many, *many.columns)


SKEW = {
    "autoBroadcastJoinThreshold": -1,
    "adaptive__autoBroadcastJoinThreshold": -1,
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "adaptive__skewJoin__skewedPartitionFactor": 1.5,
    "adaptive__advisoryPartitionSizeInBytes": "2KB",
    "adaptive__coalescePartitions__enabled": "false",
    "shuffle__partitions": 16,
}


def hot_frame(spark, n=40_000):
    """One prescriber with a third of the rows, written in several files."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000 + 100)
    frame = spark.range(n, numPartitions=8).select(
        hot.cast("long").alias("presc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 40)).alias("presc_state"),
        F.when(F.col("id") % 2 == 0, (F.col("id") % 9).cast("int")).alias("trx_cnt"),
        F.col("id"),
    )
    return workspace.write_table(frame, "hot")


def test_busy_prescriber_is_split_when_means_are_not_broadcast(spark, conf):
    conf(**SKEW)
    imputed = impute_trx(hot_frame(spark), broadcast_bytes=0)
    plan = executed_plan(imputed)
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan
    assert imputed.count() == 40_000


def test_the_fact_is_read_twice_on_either_side_of_the_bound(spark, conf, monkeypatch):
    """Scans of the source in every job that runs, and in the frame that comes out."""
    conf(**SKEW)
    rows = hot_frame(spark)
    source = rows.inputFiles()[0].rsplit("/", 1)[0]
    plans, save = [], workspace.write_table

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(df, *args, **options)

    monkeypatch.setattr(workspace, "write_table", noted)
    monkeypatch.setattr(impute, "write_table", noted)
    place = source.rsplit("/", 1)[1][:40]
    for bound in (None, 0):
        plans.clear()
        imputed = impute_trx(rows, broadcast_bytes=bound)
        plans.append(imputed._jdf.queryExecution().executedPlan().toString())
        assert sum(plan.count(place) for plan in plans) == 2
        # only rows that lack a count reach an exchange, and none does below the bound
        assert ("Exchange hashpartitioning(presc_id" in plans[-1]) == (bound == 0)
    assert not any(place in name for name in imputed.inputFiles())


def test_prescribers_without_any_count_are_not_shuffled(spark, conf):
    """Both kinds of rows: only those whose prescriber has a mean are parted off."""
    conf(**SKEW)
    rows = spark.range(20_000).select(
        (F.col("id") % 4000).alias("presc_id"), F.col("id"),
        F.when((F.col("id") % 4000 >= 2000) & (F.col("id") < 8000), F.col("id").cast("int")).alias("trx_cnt"),
    )
    imputed = impute_trx(workspace.write_table(rows, "some"), broadcast_bytes=0)
    lacking = [f for f in imputed.inputFiles() if "lacks_claims=true" in f]
    parted = spark.read.parquet(*lacking)
    assert {r.kind for r in parted.select((F.col("presc_id") >= 2000).alias("kind")).distinct().collect()} >= {True}
    wrong = parted.filter("presc_id < 2000").count()
    assert wrong < 0.1 * 10_000  # the bitmap's false hits
    assert listed(imputed, "id", "trx_cnt") == listed(impute_trx(workspace.write_table(rows, "some")), "id", "trx_cnt")


def test_bitmaps_find_every_key_and_few_others(spark):
    keys = workspace.write_table(spark.range(0, 300_000, 3).withColumnRenamed("id", "k"), "keys")
    for most, false_hits in ((2**28, 0.06), (2**15, 1.01)):
        bitmap, bits = membership.key_bitmap(keys, "k", 100_000, most)
        assert bits <= max(most, 2**15)
        rows = spark.range(300_000).select(F.when(F.col("id") % 1000 != 1, F.col("id")).alias("k"))
        found = membership.with_membership(rows, F.col("k"), bitmap, bits, "known")
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        counts = {(r[0], r[1]): r[2] for r in found.groupBy(F.expr("k % 3 = 0"), "known").count().collect()}
        assert (True, False) not in counts and (None, True) not in counts
        assert counts.get((False, True), 0) < false_hits * 200_000
    empty, bits = membership.key_bitmap(keys.limit(0), "k", 0)
    assert membership.with_membership(keys, F.col("k"), empty, bits, "known").filter("known").count() == 0


def test_big_state_is_split_when_ranks_are_not_broadcast(spark, conf):
    conf(**SKEW)
    ranked = with_dense_rank(hot_frame(spark), "presc_state", "trx_cnt", broadcast_bytes=0)
    plan = executed_plan(ranked)
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan
    assert ranked.count() == 40_000


def test_busy_prescriber_with_many_names_is_split(spark, conf):
    conf(**SKEW)
    totals = prescriber_totals(hot_frame(spark), "id", broadcast_bytes=0)
    assert "skew=true" in executed_plan(totals)
    assert totals.count() == 40_000


def test_top_n_passes_on_few_values_per_task(spark):
    plan = executed_plan(value_ranks(hot_frame(spark), "presc_state", "trx_cnt", 5))
    assert plan.count("WindowGroupLimit") == 2  # once before, once after the shuffle


def test_size_of_a_written_table_counts_values_and_text(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, None)], "a long, b string")
    table = workspace.write_lookup(frame, "sized")
    assert table.size == 2 * 32 + 3
    assert table.fits_broadcast(67) and not table.fits_broadcast(66)


def test_empty_table_has_size_zero(spark):
    table = workspace.write_lookup(spark.createDataFrame([], "a long"), "none")
    assert table.size == 0 and table.frame.count() == 0


def test_work_dir_is_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.work_dir(spark).startswith(root)


class SessionWithoutFolder:
    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})


def test_no_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workspace.work_dir(SessionWithoutFolder(master))


def test_local_mode_falls_back_to_one_temporary_folder():
    first = workspace.work_dir(SessionWithoutFolder("local[4]"))
    assert first == workspace.work_dir(SessionWithoutFolder("local")) and "claimworks-" in first


@pytest.mark.parametrize("broadcast_bytes", [64 * 1024 * 1024, 0])
def test_row_report_reads_the_fact_three_times_at_most(spark, fact, tmp_path, monkeypatch, broadcast_bytes):
    """Once for the means, once or twice for the kept rows, never for the ranks."""
    from claimworks.plans import membership, workspace

    path = f"{tmp_path}/fact"
    fact({}, {"total_claim_count": None}, {"npi": 2, "total_claim_count": 7}).write.parquet(path)
    rows = clean.prepare_presc(spark.read.parquet(path))
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", broadcast_bytes)
    table_scans, write = [], workspace.write_table

    def counted(df, *args, **kwargs):
        table_scans.append(str(df._jdf.queryExecution().executedPlan()).count("FileScan parquet [npi"))
        return write(df, *args, **kwargs)

    for module in (workspace, reports):
        monkeypatch.setattr(module, "write_table", counted)
    report = reports.top_prescribers(rows)
    assert sorted(r.trx_cnt for r in report.collect()) == [7, 10, 10]
    assert f"{path}" not in report._jdf.queryExecution().executedPlan().toString()
    assert sum(table_scans) <= 3
