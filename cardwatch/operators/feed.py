"""Watchlist feed: deliver the records of the feed CSV not yet delivered.

Delivered records are the JSON files already in the drop folder.  The
highest numeric watchlist id among them is the high-water mark; a feed
record is new when its id number is above it (ids compare as numbers, so
``WL000010`` follows ``WL000009`` and ``WL9`` alike).  With nothing
delivered yet, every record is new, whatever its id.  Afterwards a feed
record whose id has no ``WL<digits>`` form cannot be placed before or after
the mark and goes to the rejects instead.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import watchlist_number
from ..schemas import WATCHLIST_RECORD
from ..sources.files import read_watchlist_csv, read_watchlist_files


def delivered_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records in the drop folder; an empty frame when there is none yet."""
    try:
        return read_watchlist_files(spark, folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WATCHLIST_RECORD)


def high_water_mark(delivered: DataFrame) -> DataFrame:
    """One row: the highest id number delivered and the id it came from.

    Ids without a ``WL<digits>`` form are ignored.  A partial aggregate per
    task, one row to the final stage.
    """
    numbered = delivered.select("watchlist_id",
                                watchlist_number("watchlist_id").alias("id_num"))
    return numbered.agg(F.max("id_num").alias("max_id_num"),
                        F.max_by("watchlist_id", "id_num").alias("latest_watchlist_id"))


def new_records(feed: DataFrame, max_id_num: int | None) -> DataFrame:
    """Feed records whose id number is above the mark (all records if None)."""
    if max_id_num is None:
        return feed
    return feed.filter(watchlist_number("watchlist_id") > F.lit(max_id_num))


def rejected_records(feed: DataFrame, max_id_num: int | None) -> DataFrame:
    """Feed records that the mark cannot place: ids without a ``WL<digits>`` form."""
    placed = F.lit(max_id_num is None) | watchlist_number("watchlist_id").isNotNull()
    return feed.filter(~placed)


def deliver(spark: SparkSession, feed_csv: str, folder: str, rejects: str | None = None
            ) -> DataFrame:
    """Append the new feed records to the drop folder as JSON; return them.

    The mark is read once (a single number on the driver) before writing,
    so the returned frame stays the same after the new files exist.  The
    rejects of this feed replace those in the folder ``rejects``.
    """
    mark = high_water_mark(delivered_records(spark, folder)).first()["max_id_num"]
    feed = read_watchlist_csv(spark, feed_csv)
    if rejects is not None:
        rejected_records(feed, mark).write.mode("overwrite").json(rejects)
    fresh = new_records(feed, mark)
    fresh.write.mode("append").json(folder)
    return fresh
