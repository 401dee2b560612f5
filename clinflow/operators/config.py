"""Config tables: fixed and small, and held to that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a table may have to be taken for configuration; beyond it Spark chooses the join itself.
CONFIG_ROWS = 100_000


def config_hint(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What marks sides made from ``table`` for broadcast if it has CONFIG_ROWS rows at most; else what leaves them as they are."""
    return F.broadcast if table.limit(CONFIG_ROWS + 1).count() <= CONFIG_ROWS else lambda df: df


def config(table: DataFrame) -> DataFrame:
    return config_hint(table)(table)
