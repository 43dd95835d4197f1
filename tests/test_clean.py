import pytest

from claimworks import schemas
from claimworks.functions import first_int, token_count, token_count_arrow
from claimworks.operators import clean
from claimworks.operators.impute import impute_trx


def column(frame, name):
    return [row[name] for row in frame.collect()]


@pytest.mark.parametrize(
    "text, expected",
    [("N/A", None), (None, None), ("= 45.0", 45), ("-7", 7), ("", None), ("99999999999", None)],
)
def test_experience_is_the_first_run_of_digits(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string").select(first_int("t").alias("n"))
    assert column(frame, "n") == [expected]


def test_token_count(spark):
    texts = [None, "", "a  b", "a b ", "a"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    counted = frame.select(token_count("t").alias("a"), token_count_arrow("t").alias("b"))
    assert column(counted, "a") == [None, 1, 3, 3, 1]
    assert column(counted, "b") == [None, 1, 3, 3, 1]


def test_token_count_arrow_on_nulls_only(spark):
    frame = spark.createDataFrame([(None,), (None,)], "t string").coalesce(1)
    assert column(frame.select(token_count_arrow("t").alias("b")), "b") == [None, None]


def test_clean_city_upper_cases_names_but_not_the_state_key(cities):
    row = clean.clean_city(cities({"state_id": "il"})).first()
    assert (row.city, row.state_id, row.state_name, row.county_name) == (
        "SPRINGFIELD", "il", "ILLINOIS", "SANGAMON",
    )


def test_normalized_keys_are_upper_case_on_both_sides(cities, fact):
    city = clean.clean_city(cities({"state_id": "il"}), normalize_keys=True).first()
    rows = fact({"nppes_provider_city": "Springfield", "nppes_provider_state": "il"})
    presc = clean.prepare_presc(rows, normalize_keys=True).first()
    assert (city.state_id, city.city) == (presc.presc_state, presc.presc_city)


def test_full_name_skips_missing_parts(fact):
    first, last = "nppes_provider_first_name", "nppes_provider_last_org_name"
    rows = fact({first: "A", last: "B"}, {first: None}, {last: None}, {first: None, last: None})
    names = column(clean.clean_presc(rows), "presc_fullname")
    assert sorted(names) == ["", "A B", "DOE", "JO"]


def test_clean_fact_keeps_its_contract(fact):
    cleaned = clean.clean_presc(fact({}))
    assert schemas.contract_violations(cleaned, schemas.CLEAN_PRESC) == []
    assert cleaned.columns == schemas.CLEAN_PRESC.names
    assert cleaned.first().country_name == "USA"


def test_country_is_a_parameter(fact):
    assert clean.clean_presc(fact({}), country="NO").first().country_name == "NO"


def test_rows_without_prescriber_or_drug_are_dropped(fact):
    assert clean.prepare_presc(fact({"npi": None}, {"drug_name": None}, {})).count() == 1


def claims(frame):
    return sorted(((r.presc_id, r.trx_cnt) for r in frame.collect()), key=str)


def test_missing_claims_become_the_rounded_mean(fact):
    rows = fact(*[{"total_claim_count": n} for n in (2, 3, None)])
    assert claims(clean.clean_presc(rows)) == [(1, 2), (1, 3), (1, 3)]


def test_prescriber_without_any_claims_stays_null(fact):
    rows = fact({"total_claim_count": None}, {"total_claim_count": None}, {"npi": 2})
    assert claims(clean.clean_presc(rows)) == [(1, None), (1, None), (2, 10)]


def test_mean_ignores_dropped_rows(fact):
    rows = fact(
        {"total_claim_count": 10, "drug_name": None},
        {"total_claim_count": 2},
        {"total_claim_count": None},
    )
    assert claims(clean.clean_presc(rows)) == [(1, 2), (1, 2)]


def test_mean_is_taken_over_all_experience_values(fact):
    rows = fact(
        {"total_claim_count": 100, "years_of_exp": "5"},
        {"total_claim_count": None, "years_of_exp": "30"},
        {"total_claim_count": 50, "years_of_exp": "30"},
    )
    assert claims(clean.clean_presc(rows)) == [(1, 100), (1, 50), (1, 75)]


def test_imputing_again_changes_nothing(fact):
    rows = fact(*[{"total_claim_count": n} for n in (1, 1, 2, None)], {"npi": 2, "total_claim_count": None})
    once = clean.clean_presc(rows)
    assert claims(impute_trx(once)) == claims(once)
