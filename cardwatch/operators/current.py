"""The current row of every key, kept in hash buckets, and joins that touch only the buckets they need.

A load is merged into the table bucket by bucket: only buckets in which a
row really changes are rewritten, in one commit.  A key's current row is the
one with the latest ``order_by``; of equal times the later load's.  Rows that
are repeated as they were change nothing.

A micro-batch joined with the table first finds its own distinct keys.  They
choose the buckets to scan and, broadcast if they are few enough, the rows of
those buckets; what is left is at most one row per key of the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..streaming.ledger import Ledger
from .dedup import latest_per_key
from .joins import DEFAULT_BROADCAST_BYTES, fits_broadcast

BUCKET = "_bucket"
DEFAULT_BUCKETS = 64


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def current_table(spark: SparkSession, root: str, schema: StructType) -> Ledger:
    """The ledger of current rows of this schema."""
    fields = [f for f in schema.fields if f.name != BUCKET]
    return Ledger(spark, root, StructType([*fields, StructField(BUCKET, IntegerType())]), (BUCKET,)).create()


def merge_load(table: Ledger, load: DataFrame, key: str, order_by: str, load_id: int, *,
               buckets: int = DEFAULT_BUCKETS) -> list[int]:
    """Merge a load into the current rows; the buckets that were rewritten.

    Rows without a key are left out.  The same ``load_id`` merges once.  The
    number of buckets has to stay the same for the life of the table.
    """
    if table.committed("load", load_id):
        return []
    names = [c for c in table.schema.names if c != BUCKET]
    keyed = load.select(names).filter(F.col(key).isNotNull())
    incoming = latest_per_key(keyed, key, order_by).withColumn(BUCKET, bucket_of(key, buckets))
    # The keys alone tell the buckets.
    wanted = [r[0] for r in keyed.select(bucket_of(key, buckets)).distinct().collect()]
    current = table.read().filter(F.col(BUCKET).isin(wanted))
    old, new = current.alias("old"), incoming.alias("new")
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    # NULL times are older than any other.
    older = F.col(f"old.{order_by}").isNotNull() & (
        F.col(f"new.{order_by}").isNull() | (F.col(f"new.{order_by}") < F.col(f"old.{order_by}")))
    on = (F.col(f"old.{BUCKET}") == F.col(f"new.{BUCKET}")) & (F.col(f"old.{key}") == F.col(f"new.{key}"))
    changed = new.join(old, on, "left").filter(F.col(f"old.{key}").isNull() | ~(same | older)).select("new.*")
    touched = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())
    if not touched:
        return []
    kept = current.filter(F.col(BUCKET).isin(touched)).join(changed.select(BUCKET, key), [BUCKET, key], "left_anti")
    table.replace(kept.select(table.schema.names).unionByName(changed.select(table.schema.names)),
                  [f"/{b}" for b in touched], "load", load_id)
    return touched


def needed_rows(table: Ledger, batch: DataFrame, batch_key: str, key: str, columns: list[str], *,
                buckets: int = DEFAULT_BUCKETS, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The current rows whose key occurs in ``batch`` (a batch frame, or a micro-batch).

    Only the buckets of the batch's keys are scanned.  When the keys fit a
    broadcast the table is not shuffled either.
    """
    ids = batch.select(F.col(batch_key).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    ids = ids.withColumn("_id_bucket", bucket_of("_id", buckets))
    hit = [r[0] for r in ids.select("_id_bucket").distinct().collect()]
    rows = table.read().filter(F.col(BUCKET).isin(hit))
    if fits_broadcast(ids, broadcast_bytes):
        ids = F.broadcast(ids)
    return rows.join(ids, rows[key] == ids["_id"], "left_semi").select(*columns)
