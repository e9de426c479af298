"""Customer master from a relational database (the connector form of the load).

The JDBC driver jar is not in this image, so this is exercised only where
one is installed (untested here).  A read is split by a list of predicates,
one task each, so a large table is read by many tasks; predicates on a hash
of the text key give even parts whatever the key looks like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CUSTOMER


def hash_predicates(bucket: str, partitions: int) -> list[str]:
    """Predicates splitting a table evenly by ``bucket``.

    ``bucket`` is SQL of the database for a non-negative integer from the
    key, e.g. ``abs(hashtext(customer_id))`` on PostgreSQL.
    """
    return [f"mod({bucket}, {partitions}) = {i}" for i in range(partitions)]


def read_customers_jdbc(spark: SparkSession, url: str, table: str, *, user: str, password: str,
                        predicates: list[str], fetch_size: int = 10_000) -> DataFrame:
    """The customer table, one task per predicate, with the declared column types.

    The predicates must cover every row exactly once.
    """
    df = spark.read.jdbc(url, table, predicates=predicates, properties={
        "user": user, "password": password, "fetchsize": str(fetch_size)})
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in CUSTOMER.fields])
