"""File and table sources: the watchlist drop folder, the feed CSV, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RESCUED, WATCHLIST_RECORD


def watchlist_lines(lines: DataFrame) -> DataFrame:
    """Watchlist records from lines of JSON, one record per line.

    Fields that the record does not declare go to ``rescued_data`` as a
    JSON object of texts; a line that is no JSON object goes there whole,
    with every field NULL.  Blank lines are skipped.
    """
    known = F.array(*[F.lit(f.name) for f in WATCHLIST_RECORD.fields])
    record = F.from_json("value", WATCHLIST_RECORD)
    every = F.from_json("value", "map<string,string>")
    unknown = F.map_filter(every, lambda k, _: ~F.array_contains(known, k))
    is_object = F.get_json_object("value", "$").isNotNull() & F.ltrim("value").startswith("{")
    rescued = (F.when(~is_object, F.col("value"))
               .when(F.size(unknown) > 0, F.to_json(unknown)))
    return (lines.filter(F.trim("value") != "")
            .withColumn("_record", record).withColumn(RESCUED, rescued)
            .select(*[F.col(f"_record.{f.name}").alias(f.name) for f in WATCHLIST_RECORD.fields],
                    RESCUED, "source_file"))


def watchlist_stream(spark: SparkSession, folder: str, *, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """New files in the watchlist drop folder, as a stream of records.

    Every file of the folder is read, whatever its name.  The record's
    fields are declared (``entity_id`` stays text because it is compared
    with card numbers); see ``watchlist_lines`` for all else.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return watchlist_lines(reader.text(folder).select(
        "value", F.col("_metadata.file_path").alias("source_file")))


def read_watchlist_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every delivered watchlist record, as a batch frame."""
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).select(
        "value", F.col("_metadata.file_path").alias("source_file"))
    return watchlist_lines(lines).select(*WATCHLIST_RECORD.fieldNames())


def read_watchlist_csv(spark: SparkSession, path: str) -> DataFrame:
    """The watchlist feed CSV, a file or a folder of them; all columns as text, found by name in the header.

    Files are read in parallel, a file by one task (values may hold line
    breaks), so a large feed should come in many, each with its header line.
    Quotes are doubled inside quoted values, which may hold line breaks.  A
    declared column that is missing is an error; columns that the record
    does not declare follow the declared ones.
    """
    feed = (spark.read.option("header", True).option("multiLine", True).option("recursiveFileLookup", "true")
            .option("quote", '"').option("escape", '"').csv(path))
    declared = WATCHLIST_RECORD.fieldNames()
    missing = [c for c in declared if c not in feed.columns]
    if missing:
        raise ValueError(f"the watchlist feed {path} lacks the columns {missing}")
    return feed.select(*declared, *[f"`{c}`" for c in feed.columns if c not in declared])


def table_stream(spark: SparkSession, path: str, schema: StructType | None = None,
                 *, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table folder read as a stream of its new files."""
    reader = spark.readStream
    reader = reader.schema(schema) if schema is not None else reader.schema(
        spark.read.parquet(path).schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def table_snapshot(spark: SparkSession, path: str, schema: StructType | None = None
                   ) -> DataFrame:
    """A parquet table folder as it is now (re-read on every call)."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
