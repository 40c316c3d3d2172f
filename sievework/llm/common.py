"""Readings of the tables that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievework.operators import examples

def role_of(role: Column | str) -> Column:
    """system, user, assistant, or null for a role that is none of them; spelling and blanks don't matter."""
    return examples.role_of(F.col(role) if isinstance(role, str) else role)


def once(df: DataFrame, *key: str) -> DataFrame:
    """One row for each key; rows delivered again repeat the content, so any of them will do."""
    return df.dropDuplicates(list(key))
