"""Unicode normal forms, which Spark has no function for: Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def nfkc(c: Column) -> Column:
    """In compatibility normal form; null stays null."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return of(c)


def squeezed_nfkc(c: Column) -> Column:
    """In compatibility normal form, without any white space; null is empty."""
    return F.regexp_replace(F.coalesce(nfkc(c), F.lit("")), r"(?U)\s+", "")
