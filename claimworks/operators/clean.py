"""Cleaning of the two inputs, one function per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.functions import first_int
from claimworks.operators.impute import impute_trx

# Raw fact column -> name in the cleaned fact (fixed values).
FACT_NAMES = {
    "npi": "presc_id",
    "nppes_provider_last_org_name": "presc_lname",
    "nppes_provider_first_name": "presc_fname",
    "nppes_provider_city": "presc_city",
    "nppes_provider_state": "presc_state",
    "specialty_description": "presc_spclt",
    "years_of_exp": "years_of_exp",
    "drug_name": "drug_name",
    "total_claim_count": "trx_cnt",
    "total_day_supply": "total_day_supply",
    "total_drug_cost": "total_drug_cost",
}
COUNTRY = "USA"


def clean_city(city: DataFrame, normalize_keys: bool = False) -> DataFrame:
    """Needed columns of the city dimension, names in upper case.

    ``state_id`` is compared as it is unless ``normalize_keys`` is set.
    """
    state = F.upper("state_id").alias("state_id") if normalize_keys else F.col("state_id")
    return city.select(
        F.upper("city").alias("city"),
        state,
        F.upper("state_name").alias("state_name"),
        F.upper("county_name").alias("county_name"),
        "population",
        "zips",
    )


def select_fact(fact: DataFrame) -> DataFrame:
    return fact.select([F.col(raw).alias(name) for raw, name in FACT_NAMES.items()])


def add_country(rows: DataFrame, country: str = COUNTRY) -> DataFrame:
    return rows.withColumn("country_name", F.lit(country))


def parse_experience(rows: DataFrame) -> DataFrame:
    """``'= 45.0'`` becomes 45; texts without digits become null, never an error."""
    return rows.withColumn("years_of_exp", first_int("years_of_exp"))


def add_full_name(rows: DataFrame) -> DataFrame:
    """First and last name joined by a space; a missing part leaves no space."""
    full_name = F.concat_ws(" ", "presc_fname", "presc_lname")
    return rows.withColumn("presc_fullname", full_name).drop("presc_fname", "presc_lname")


def drop_null_keys(rows: DataFrame) -> DataFrame:
    """Rows with prescriber and drug; written so that the file scan filters."""
    return rows.filter(F.col("presc_id").isNotNull() & F.col("drug_name").isNotNull())


def upper_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.upper(name) for name in ("presc_city", "presc_state")})


def prepare_presc(
    fact: DataFrame, country: str = COUNTRY, normalize_keys: bool = False
) -> DataFrame:
    """Every cleaning step that looks at one row only.

    All reports start from here: each of them fills in missing claim counts in the
    cheapest form for its own grain.
    """
    rows = (
        fact.transform(select_fact)
        .transform(add_country, country)
        .transform(parse_experience)
        .transform(add_full_name)
        .transform(drop_null_keys)
    )
    return rows.transform(upper_keys) if normalize_keys else rows


def clean_presc(
    fact: DataFrame, country: str = COUNTRY, normalize_keys: bool = False
) -> DataFrame:
    """The cleaned fact: prepared rows with missing claim counts filled in.

    Means are taken after the key filter and before any experience filter.
    """
    return prepare_presc(fact, country, normalize_keys).transform(impute_trx)
