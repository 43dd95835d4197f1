import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimworks import schemas  # noqa: E402
from claimworks.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "10000",  # whole read schemas in plans
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


FACT_DEFAULTS = {
    "npi": 1,
    "nppes_provider_last_org_name": "DOE",
    "nppes_provider_first_name": "JO",
    "nppes_provider_city": "SPRINGFIELD",
    "nppes_provider_state": "IL",
    "specialty_description": "DENTIST",
    "years_of_exp": "= 30",
    "drug_name": "ASPIRIN",
    "total_claim_count": 10,
    "total_day_supply": 300,
    "total_drug_cost": 12.5,
}


@pytest.fixture
def fact(spark):
    """Raw fact rows; every column not given has an ordinary value."""

    def build(*rows):
        full = [{**FACT_DEFAULTS, **row} for row in rows]
        names = schemas.PRESCRIBER_FACT.names
        return spark.createDataFrame(
            [tuple(row[name] for name in names) for row in full], schemas.PRESCRIBER_FACT
        )

    return build


CITY_DEFAULTS = {
    "city": "Springfield",
    "state_id": "IL",
    "state_name": "Illinois",
    "county_name": "Sangamon",
    "population": 1000,
    "zips": "62701 62702",
}


@pytest.fixture
def cities(spark):
    def build(*rows):
        full = [{**CITY_DEFAULTS, **row} for row in rows]
        names = schemas.CITY_DIM.names
        return spark.createDataFrame(
            [tuple(row[name] for name in names) for row in full], schemas.CITY_DIM
        )

    return build
