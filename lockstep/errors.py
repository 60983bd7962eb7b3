"""Failures with stable identifiers, and checks that raise them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class AlignmentError(ValueError):
    """A violated contract; ``identifier`` is ``function:Name``."""

    def __init__(self, identifier: str, message: str = ""):
        self.identifier = identifier
        super().__init__(f"{identifier}: {message}" if message else identifier)


def require(ok: bool, identifier: str, message: str = "") -> None:
    if not ok:
        raise AlignmentError(identifier, message)


def guard(df: DataFrame, column: Column, bad: Column, identifier: str, name: str) -> DataFrame:
    """df with column as name; a row for which bad holds fails the query with the identifier when it is computed."""
    return df.withColumn(name, F.when(bad, F.raise_error(F.lit(identifier))).otherwise(column))
