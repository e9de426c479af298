"""Equi-joins that stay fast when one key holds a large share of the rows.

Strategies, chosen by size checks rather than by hope:

* the other side is small (the measured bytes of its rows in memory fit the
  broadcast budget): broadcast it; every task joins its own
  rows locally, so a hot key costs nothing extra;
* otherwise one shuffle join that salts only the hot keys: keys holding at
  least ``min_share`` of the fact rows (at most ``1/min_share`` of them, a
  proven bound) get a salt range sized so each shard is about one task's
  share of the rows, and only their dimension rows are repeated per salt.
  Cold keys keep salt 0 and their dimension rows appear once.  The facts
  are read once;
* for a stateful stream-stream join, where the key layout is fixed by the
  checkpoint, a shuffle join on ``(key, salt)``: each large-side row gets a
  salt from a hash of its own identity (deterministic, so a retried batch
  sends every row to the same place) and the other side is repeated once
  per salt value.  A busy key is spread over ``salt_buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DecimalType,
                               DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, TimestampNTZType, TimestampType)

# Types whose values take a fixed number of bytes (a wide decimal: 16 besides its field).
FIXED_WIDTH = (BooleanType, ByteType, ShortType, IntegerType, LongType, DateType, FloatType,
               DoubleType, TimestampType, TimestampNTZType)
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
DEFAULT_SALT_BUCKETS = 8
# A key is hot when it holds at least this share of the fact rows; there
# can be at most 1 / DEFAULT_HOT_SHARE such keys.
DEFAULT_HOT_SHARE = 0.001
BUCKETS = "_buckets"
SALT = "_salt"


# Bytes that a row costs in a broadcast hash table besides its fields: the
# row's header and size, its entry in the table, which is at most half full.
ROW_OVERHEAD = 64


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row in memory: 8 per field, the null bits, texts in words of 8, overhead.

    Values of other types (structs, arrays) are measured by their JSON text.
    """
    fields = df.schema.fields
    size = F.lit(ROW_OVERHEAD + 8 * -(-len(fields) // 64) + 8 * len(fields))
    for f in fields:
        if not isinstance(f.dataType, FIXED_WIDTH):
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, DecimalType):
                size = size + 16
                continue
            text = c if isinstance(f.dataType, (StringType, BinaryType)) else F.to_json(F.struct(c))
            size = size + F.coalesce(F.octet_length(text), F.lit(0)) + 8
    return size


def fits_broadcast(df: DataFrame, budget_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to broadcast, by measuring it.

    One job that sums the bytes of the rows, partition by partition; only
    the sum comes to the driver.  Project the frame to the join columns
    first.
    """
    if budget_bytes <= 0:
        return False
    return (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= budget_bytes


def salt_of(identity: list[str | Column], buckets: int) -> Column:
    """Deterministic salt in ``[0, buckets)`` from a row's identity columns."""
    cols = [F.col(c) if isinstance(c, str) else c for c in identity]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def repeat_per_salt(df: DataFrame, buckets: int) -> DataFrame:
    """Each row once per salt value (a generator, not a cross join)."""
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))


def _shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side that its join shuffles, never broadcasts.

    Spark takes a side's size from the bytes of its files, which repeated
    names compress to a few hundredths of the rows in memory, and a row per
    salt as no more than one; what was measured as too large to broadcast
    would go through the driver after all.  Two streams are not concerned.
    """
    return df.hint("merge")


def _condition(left: DataFrame, right: DataFrame, on: list[tuple[str, str]],
               null_safe: bool = False) -> Column:
    cond = None
    for a, b in on:
        c = left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def salted_join(large: DataFrame, small: DataFrame, on: list[tuple[str, str]],
                identity: list[str | Column], buckets: int = DEFAULT_SALT_BUCKETS,
                how: str = "inner", extra: Column | None = None,
                null_safe: bool = False) -> DataFrame:
    """Shuffle join with the large side salted and the small side repeated.

    ``on`` pairs a column of ``large`` with one of ``small``; the two sides
    should not share other column names.  ``extra`` is a further condition
    (e.g. a time range) by column name; ``null_safe`` matches NULL keys with
    each other.  Works for streams on either side.
    """
    if buckets <= 1:
        cond = _condition(large, small, on, null_safe)
        return large.join(_shuffled(small), cond if extra is None else cond & extra, how)
    salted_large = large.withColumn(SALT, salt_of(identity, buckets))
    repeated_small = repeat_per_salt(small, buckets).withColumnRenamed(SALT, "_small_salt")
    cond = _condition(salted_large, repeated_small, on, null_safe) & (
        salted_large[SALT] == repeated_small["_small_salt"])
    if extra is not None:
        cond = cond & extra
    return salted_large.join(_shuffled(repeated_small), cond, how).drop(SALT, "_small_salt")


def hot_keys(facts: DataFrame, keys: list[str], min_share: float = DEFAULT_HOT_SHARE,
             partitions: int | None = None) -> DataFrame:
    """Key values holding at least ``min_share`` of the rows of a batch frame.

    Also gives each hot key ``_buckets``: how many tasks its rows need to be
    about one task's share (``rows * partitions / total``, at least 2).  A
    partial aggregate per task, then a filter against the total row count
    (a scalar subquery); at most ``1/min_share`` rows come out, so the
    result may always be broadcast.  Lazy: nothing runs until it is used.
    """
    if partitions is None:
        partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = facts.agg(F.count(F.lit(1))).scalar()
    buckets = F.greatest(F.lit(2), F.ceil(F.col("_rows") * F.lit(partitions) / total))
    return (facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") >= total * F.lit(min_share))
            .select(*keys, buckets.cast("int").alias(BUCKETS)))


def hot_key_salted_join(facts: DataFrame, dim: DataFrame, on: list[tuple[str, str]],
                        hot: DataFrame, identity: list[str | Column], null_safe: bool = False,
                        extra: Column | None = None) -> DataFrame:
    """Inner join on ``(key, salt)`` where only hot keys have more than one salt.

    ``hot`` lists hot key values (named like the fact keys) with their
    ``_buckets``; it is broadcast to both sides (stream-static left joins
    when a side is a stream).  Works for a stream-stream join too, as long
    as ``hot`` stays the same for the life of the checkpoint.
    """
    fact_keys = [a for a, _ in on]
    if BUCKETS not in hot.columns:
        hot = hot.withColumn(BUCKETS, F.lit(DEFAULT_SALT_BUCKETS))
    flags = F.broadcast(hot.select(*[F.col(a).alias(f"_hot_{a}") for a in fact_keys],
                                   F.col(BUCKETS)))
    hot_cols = [f"_hot_{a}" for a in fact_keys]
    flagged_facts = facts.join(flags, _condition(facts, flags, [(a, f"_hot_{a}")
                                                                for a in fact_keys], True), "left")
    salted_facts = flagged_facts.withColumn(
        SALT, F.coalesce(F.pmod(F.xxhash64(*[F.col(c) if isinstance(c, str) else c
                                              for c in identity]), F.col(BUCKETS)).cast("int"),
                         F.lit(0))).drop(BUCKETS, *hot_cols)
    flagged_dim = dim.join(flags, _condition(dim, flags, [(b, f"_hot_{a}") for a, b in on], True),
                           "left")
    repeated_dim = flagged_dim.withColumn(
        "_small_salt", F.explode(F.when(F.col(BUCKETS).isNotNull(),
                                        F.sequence(F.lit(0), F.col(BUCKETS) - 1))
                                 .otherwise(F.array(F.lit(0))))).drop(BUCKETS, *hot_cols)
    cond = _condition(salted_facts, repeated_dim, on, null_safe) & (
        salted_facts[SALT] == repeated_dim["_small_salt"])
    if extra is not None:
        cond = cond & extra
    return salted_facts.join(_shuffled(repeated_dim), cond, "inner").drop(SALT, "_small_salt")


def join_dimension(facts: DataFrame, dim: DataFrame, on: list[tuple[str, str]],
                   identity: list[str | Column], *,
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   salt_buckets: int = DEFAULT_SALT_BUCKETS,
                   null_safe: bool = False, hot: DataFrame | None = None,
                   min_hot_share: float = DEFAULT_HOT_SHARE) -> DataFrame:
    """Inner join of facts (batch or stream) with a static dimension.

    Broadcast when the dimension passes the size check.  Otherwise a single
    shuffle join in which only hot keys are salted (see ``hot_keys``).
    ``hot`` lists the hot key values (columns named like the fact keys,
    optionally ``_buckets``); for a batch frame it is computed from the
    facts when not given, for a stream it should come from history
    (``hot_keys`` of a snapshot).  A stream with no hot list is salted
    uniformly over ``salt_buckets``.  Project the dimension to the needed
    columns first: the size check and the broadcast see only those.
    """
    if fits_broadcast(dim, broadcast_bytes):
        return facts.join(F.broadcast(dim), _condition(facts, dim, on, null_safe), "inner")
    if hot is None and not facts.isStreaming:
        hot = hot_keys(facts, [a for a, _ in on], min_hot_share)
    if hot is None:
        return salted_join(facts, dim, on, identity, salt_buckets, null_safe=null_safe)
    return hot_key_salted_join(facts, dim, on, hot, identity, null_safe)
