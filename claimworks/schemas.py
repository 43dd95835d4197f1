"""Column contracts of the two inputs, the cleaned frames and the reports.

The values below are fixed: names and order are what users of the job see.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CITY_DIM = _schema(
    city=_STR, state_id=_STR, state_name=_STR, county_name=_STR, population=_LONG, zips=_STR,
)

PRESCRIBER_FACT = _schema(
    npi=_LONG,
    nppes_provider_last_org_name=_STR,
    nppes_provider_first_name=_STR,
    nppes_provider_city=_STR,
    nppes_provider_state=_STR,
    specialty_description=_STR,
    years_of_exp=_STR,
    drug_name=_STR,
    total_claim_count=_INT,
    total_day_supply=_INT,
    total_drug_cost=_DBL,
)

CLEAN_PRESC = _schema(
    presc_id=_LONG,
    presc_city=_STR,
    presc_state=_STR,
    presc_spclt=_STR,
    years_of_exp=_INT,
    drug_name=_STR,
    trx_cnt=_INT,
    total_day_supply=_INT,
    total_drug_cost=_DBL,
    country_name=_STR,
    presc_fullname=_STR,
)

CITY_REPORT = _schema(
    city=_STR, state_name=_STR, county_name=_STR, population=_LONG,
    zip_counts=_INT, trx_counts=_LONG, presc_counts=_LONG,
)

PRESCRIBER_REPORT = _schema(
    presc_id=_LONG, presc_fullname=_STR, presc_state=_STR, country_name=_STR,
    years_of_exp=_INT, trx_cnt=_INT, total_day_supply=_INT, total_drug_cost=_DBL,
)

PRESCRIBER_TOTALS = _schema(
    presc_id=_LONG, presc_fullname=_STR, presc_state=_STR, country_name=_STR,
    years_of_exp=_INT, trx_cnt=_LONG, total_day_supply=_LONG, total_drug_cost=_DBL,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns, in its order, cast to its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def contract_violations(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences between a frame's schema and a contract, as readable lines."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in schema}
    missing = [f"missing column {name}" for name in wanted if name not in actual]
    extra = [f"unexpected column {name}" for name in actual if name not in wanted]
    retyped = [
        f"column {name} is {actual[name].simpleString()}, expected {kind.simpleString()}"
        for name, kind in wanted.items()
        if name in actual and actual[name] != kind
    ]
    moved = []
    if not missing + extra and list(actual) != list(wanted):
        moved = [f"columns are ordered {', '.join(actual)}, expected {', '.join(wanted)}"]
    return missing + extra + retyped + moved
