"""Choosing, renaming and checking columns; joining tables end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.coerce import to_number


def extract_columns(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    target: str | None = None,
    numeric_text: Sequence[str] = (),
) -> DataFrame:
    """Key, features and (if given) the target; text columns in ``numeric_text`` become numbers.

    Raises KeyError listing every absent column, without running a job.
    """
    wanted = [key, *features]
    if target is not None and target not in wanted:
        wanted.append(target)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise KeyError(f"These columns are needed but absent: {missing}")
    picked = df.select(*[F.col(f"`{c}`") for c in wanted])
    return picked.withColumns({c: to_number(F.col(c)) for c in numeric_text if c in wanted})


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns, under their new names; header blanks are ignored."""
    at = {c.strip(): c for c in df.columns}
    missing = [c for c in mapping if c not in at]
    if missing:
        raise KeyError(f"These columns are needed but absent: {missing}")
    return df.select(*[F.col(f"`{at[old]}`").alias(new) for old, new in mapping.items()])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop whichever of the columns exist."""
    return df.drop(*columns)


def any_missing(columns: Sequence[str]):
    """True when any of the columns is null."""
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def without_keys(df: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the removed ones."""
    return df.join(removed.select(key), key, "left_anti")
