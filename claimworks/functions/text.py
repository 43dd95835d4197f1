"""Column functions on text."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_count(text: str | Column) -> Column:
    """Number of tokens between single spaces: null for null, 1 for ``''``."""
    return F.size(F.split(text, " ")).cast("int")


@F.pandas_udf(T.IntegerType())
def token_count_arrow(text: pd.Series) -> pd.Series:
    """:func:`token_count` as a user-defined function over Arrow batches.

    Shown as the pattern for bringing one's own function; reports use the built-in.
    """
    return (text.str.count(" ") + 1).astype("Int32")


def first_int(text: str | Column) -> Column:
    """First run of digits as int; null when there is none or it is too large."""
    return F.regexp_extract(text, r"\d+", 0).try_cast("int")
