"""Text to number; whatever does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def to_number(text: Column) -> Column:
    """Double, or null when the text is not a finite-or-infinite number."""
    number = F.trim(text.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating column becomes null: one notion of missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
