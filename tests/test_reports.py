import pytest
from executed import executed_plan

from claimworks import fixtures, schemas
from claimworks.operators import clean, reports

SF_DIR = "/root/testdata/sf0.001"


def report(cities, fact):
    return reports.city_report(clean.clean_city(cities), clean.prepare_presc(fact))


def test_city_matches_in_upper_case_only(cities, fact):
    city = cities({}, {"city": "Peoria", "zips": None})
    rows = fact({}, {"npi": 2}, {"nppes_provider_city": "Peoria"}, {"nppes_provider_city": "PEORIA"})
    found = {r.city: (r.zip_counts, r.presc_counts, r.trx_counts) for r in report(city, rows).collect()}
    assert found == {"SPRINGFIELD": (2, 2, 20), "PEORIA": (None, 1, 10)}


def test_state_key_is_compared_as_it_is(cities, fact):
    assert report(cities({"state_id": "il"}), fact({})).count() == 0


def test_city_without_prescriber_is_not_reported(cities, fact):
    assert report(cities({"city": "Empty"}), fact({})).count() == 0


def test_city_listed_twice_is_reported_twice(cities, fact):
    rows = report(cities({"county_name": "A"}, {"county_name": "B"}), fact({})).collect()
    assert sorted(r.county_name for r in rows) == ["A", "B"]
    assert {(r.presc_counts, r.trx_counts) for r in rows} == {(1, 10)}


def test_null_state_is_in_no_city(cities, fact):
    assert report(cities({"state_id": None}), fact({"nppes_provider_state": None})).count() == 0


def test_mean_crosses_cities(cities, fact):
    rows = fact(
        {"total_claim_count": 4}, {"nppes_provider_city": "PEORIA", "total_claim_count": None}
    )
    found = {r.city: r.trx_counts for r in report(cities({}, {"city": "Peoria"}), rows).collect()}
    assert found == {"SPRINGFIELD": 4, "PEORIA": 4}


def test_claims_of_a_city_without_counts_are_null(cities, fact):
    assert report(cities({}), fact({"total_claim_count": None})).first().trx_counts is None


def test_city_report_as_sql_text(cities, fact):
    city = cities({}, {"city": "Peoria", "zips": ""})
    rows = fact(
        {"total_claim_count": 4},
        {"npi": 3, "nppes_provider_city": "PEORIA"},
        {"nppes_provider_city": "PEORIA", "total_claim_count": None},
    )
    by_sql = reports.city_report_sql(city, rows)
    assert by_sql.columns == schemas.CITY_REPORT.names
    assert sorted(by_sql.collect()) == sorted(report(city, rows).collect())


def top(fact, **options):
    return reports.top_prescribers(clean.prepare_presc(fact), **options)


def test_experience_range_includes_both_ends(fact):
    years = ["19", "20", "50", "51", None]
    rows = fact(*[{"npi": i, "years_of_exp": y} for i, y in enumerate(years)])
    assert sorted(r.years_of_exp for r in top(rows).collect()) == [20, 50]


def test_all_ties_of_the_first_five_values_are_kept(fact):
    rows = fact(*[{"npi": i, "total_claim_count": n} for i, n in enumerate([9, 9, 8, 7, 6, 5, 4])])
    assert sorted(r.trx_cnt for r in top(rows).collect()) == [5, 6, 7, 8, 9, 9]


def test_null_claims_rank_last(fact):
    rows = fact(*[{"npi": i, "total_claim_count": n} for i, n in enumerate([3, 2, None])])
    assert [r.trx_cnt for r in top(rows, n=2).collect() if r.trx_cnt is None] == []
    assert len([r for r in top(rows, n=3).collect() if r.trx_cnt is None]) == 1


def test_null_state_is_a_group_of_its_own(fact):
    rows = fact({"nppes_provider_state": None, "total_claim_count": 1}, {"total_claim_count": 99})
    assert sorted((r.presc_state or "", r.trx_cnt) for r in top(rows, n=1).collect()) == [
        ("", 1), ("IL", 99),
    ]


def test_row_grain_lists_a_prescriber_per_drug_and_total_grain_once(fact):
    rows = fact({"drug_name": "A"}, {"drug_name": "B", "total_claim_count": 5}, {"npi": 2})
    assert top(rows).count() == 3
    totals = {r.presc_id: (r.trx_cnt, r.total_day_supply, r.total_drug_cost)
              for r in top(rows, grain=reports.PRESCRIBER).collect()}
    assert totals == {1: (15, 600, 25.0), 2: (10, 300, 12.5)}


def test_report_contracts(cities, fact):
    assert schemas.contract_violations(report(cities({}), fact({})), schemas.CITY_REPORT) == []
    assert schemas.contract_violations(top(fact({})), schemas.PRESCRIBER_REPORT) == []
    totals = top(fact({}), grain=reports.PRESCRIBER)
    assert schemas.contract_violations(totals, schemas.PRESCRIBER_TOTALS) == []


def test_unknown_grain_is_refused(fact):
    with pytest.raises(ValueError, match="grain"):
        top(fact({}), grain="drug")


# --- plans on written inputs -------------------------------------------------


@pytest.fixture(scope="module")
def inputs(spark):
    return fixtures.city_dim(spark, SF_DIR), fixtures.prescriber_fact(spark, SF_DIR)


def test_city_report_reads_five_fact_columns_once(inputs):
    plan = executed_plan(report(*inputs))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert plan.count("FileScan") == 2
    assert "PushedFilters: [IsNotNull(npi), IsNotNull(drug_name)" in plan
    assert (
        "ReadSchema: struct<npi:bigint,nppes_provider_city:string,nppes_provider_state:string,"
        "drug_name:string,total_claim_count:int>" in plan
    )


def test_city_report_sums_before_its_first_shuffle(inputs):
    plan = executed_plan(report(*inputs))
    below_first_exchange = plan.rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_sum" in below_first_exchange


def test_top_report_shuffles_no_rows(inputs):
    plan = executed_plan(top(inputs[1]))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_claims_add_up(inputs):
    fact = inputs[1]
    per_city = reports.city_prescriber_agg(clean.prepare_presc(fact))
    total = per_city.agg({"trx_counts": "sum"}).first()[0]
    assert total == clean.clean_presc(fact).agg({"trx_cnt": "sum"}).first()[0]
