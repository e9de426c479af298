"""Keep the latest row per key of a dimension snapshot.

Customers reach the master table as appended rows, so an updated customer
appears twice and would double every alert joined to it.  Reducing the
snapshot to its latest row per id before the join prevents that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """The row with the greatest ``order_by`` for each ``key``.

    ``max`` over a struct led by ``order_by`` is an ordinary aggregate:
    each task keeps one candidate per key before the shuffle, so a key with
    very many versions costs no more than one with two.  Ties on
    ``order_by`` are broken by the remaining columns, deterministically.
    """
    others = [c for c in df.columns if c not in (key, order_by)]
    latest = df.groupBy(key).agg(F.max(F.struct(order_by, *others)).alias("_latest"))
    return latest.select(key, *[F.col(f"_latest.{c}").alias(c) for c in [order_by, *others]]
                         ).select(df.columns)
