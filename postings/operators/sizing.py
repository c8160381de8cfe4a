"""Broadcast only what has been measured."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def local_copy(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` as a local relation if it has at most ``max_rows`` rows, else None.

    The rows are fetched with a limit one above the bound, so the driver never
    holds more than that.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def fetched(df: DataFrame, what: str, max_rows: int = BROADCAST_ROWS) -> list[Row]:
    """The rows of a relation that is small by its nature, days say; beyond the bound an error, never a part."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return rows


def measured_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast local relation within the bound, else ``df`` itself.

    What is measured is what is broadcast: the relation is computed once.
    Beyond the bound it stays distributed and without a hint, and the join is a
    shuffled one that adaptive execution may still convert or split.
    """
    small = local_copy(df, max_rows)
    return df if small is None else F.broadcast(small)


def null_safe(left: str, right: str, columns: list[str]) -> Column:
    """Join condition between two aliases: the columns are equal, NULL equals NULL."""
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(and_, pairs, F.lit(True))
