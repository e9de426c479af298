"""Partitioned Parquet tables whose rows count only once a commit names them.

A ledger is a folder of Parquet files below partition folders, and a log of
commits beside it::

    rows/<partition columns>/_gen=<generation>/*.parquet
    log/*.parquet            a few rows per commit, one file each

A writer first writes its rows, tagged with a commit id of their own, and
then the commit's log rows as a single file, which a store shows whole or
not at all, renames or not.  Rows without a commit are never read: a crash in
between loses and doubles nothing.  A batch of a source commits once; when
it is replayed nothing is written, and should two writers race, readers
agree on the one with the lower version.

``compact`` rewrites partitions that many commits have touched into a new
generation and commits that; from then on readers skip the older generation's
folders, which may be removed when no reader is left that began before.  Rows
keep the commit they came with, so whoever follows the table by versions is
not disturbed.  ``replace`` commits new contents of whole partitions.

Metrics of a batch (expectation counts) are part of its commit, so they are
as exact as the rows.  One writer at a time appends to or replaces in a
ledger; compaction of an appended one may run beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from .runner import start_foreach_batch

COMMIT, GENERATION = "_commit", "_gen"
LOG = ("part string, gen string, commit string, version long, source string, batch_id long, "
       "kind string, covers long, metrics map<string,bigint>")
APPEND, REPLACE = "append", "replace"
COMPACTION = "compaction"
# Rows of one partition that a task writes at most, roughly.
ROWS_PER_WRITER = 250_000


@dataclass(frozen=True)
class Ledger:
    """A table below ``root``; ``partition_by`` names columns of ``schema``.

    At least ``writers`` tasks write a partition of a batch, a file each;
    more where it is large, so that none sorts more than about
    ``ROWS_PER_WRITER`` rows (or a shuffle partition of adaptive execution).
    """

    spark: SparkSession
    root: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    writers: int = 2

    @property
    def data(self) -> str:
        return f"{self.root}/rows"

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def create(self) -> "Ledger":
        """Make the folders, empty, unless they are there."""
        empty = self.spark.createDataFrame([], self._stored())
        empty.write.mode("ignore").partitionBy(*self.partition_by, GENERATION).parquet(self.data)
        self.spark.createDataFrame([], LOG).write.mode("ignore").parquet(self.log_path)
        return self

    def on(self, spark: SparkSession) -> "Ledger":
        """The same table on another session (a micro-batch's is not the one that started the stream)."""
        return replace(self, spark=spark)

    def _stored(self) -> StructType:
        kept = [f for f in self.schema.fields if f.name not in self.partition_by]
        return StructType([*kept, StructField(COMMIT, StringType()),
                           *(self.schema[c] for c in self.partition_by), StructField(GENERATION, StringType())])

    def part(self) -> Column:
        """The partition a row lies in, as text."""
        return F.concat_ws("/", F.lit(""), *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                             for c in self.partition_by])

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.log_path)

    def commits(self) -> DataFrame:
        """Log rows of the appended batches that count: of each batch the commit with the lowest version."""
        appends = self.log().filter(F.col("kind") == APPEND)
        first = appends.groupBy("source", "batch_id").agg(F.min(F.struct("version", "commit")).alias("first"))
        return appends.join(first.select(F.col("first.commit").alias("commit")), "commit", "left_semi")

    def _replaced(self) -> DataFrame:
        latest = F.max(F.struct("version", "gen", "covers")).alias("r")
        return (self.log().filter(F.col("kind") == REPLACE).groupBy("part").agg(latest)
                .select("part", F.col("r.gen").alias("new_gen"), F.col("r.covers").alias("covered")))

    def version(self) -> int:
        """The version of the latest commit; 0 before the first."""
        return self.log().agg(F.max("version")).first()[0] or 0

    def committed(self, source: str, batch_id: int) -> bool:
        return not self.log().filter((F.col("source") == source) & (F.col("batch_id") == batch_id)).isEmpty()

    # -- reading ------------------------------------------------------------------

    def read(self, since: int | None = None, upto: int | None = None) -> DataFrame:
        """Committed rows; with versions given, those of appends after ``since`` and up to ``upto``.

        Only folders that hold such rows are scanned; filters on partition
        columns prune further.
        """
        return self.tagged(since, upto).drop(COMMIT, GENERATION).select(self.schema.names)

    def tagged(self, since: int | None = None, upto: int | None = None) -> DataFrame:
        rows = self.spark.read.schema(self._stored()).parquet(self.data)
        replaced = self._replaced()
        wanted = self.commits().filter(F.col("part").isNotNull())
        if since is not None:
            wanted = wanted.filter(F.col("version") > since)
        if upto is not None:
            wanted = wanted.filter(F.col("version") <= upto)
        placed = wanted.join(replaced, "part", "left").withColumn(
            "moved", F.coalesce(F.col("version") <= F.col("covered"), F.lit(False)))
        versions = since is not None or upto is not None
        folders = placed.select("part", F.when(F.col("moved"), F.col("new_gen")).otherwise(F.col("gen")).alias("gen"),
                                "moved")
        if not versions:
            folders = folders.filter(~F.col("moved")).unionByName(
                replaced.select("part", F.col("new_gen").alias("gen"), F.lit(True).alias("moved")))
        # At most a row per live partition folder.
        live = folders.distinct().collect()
        folder = F.concat_ws("#", self.part(), F.col(GENERATION))

        def within(moved: bool) -> DataFrame:
            return rows.filter(folder.isin([f"{r['part']}#{r['gen']}" for r in live if r["moved"] is moved]))

        recent = within(False).join(placed.filter(~F.col("moved")).select(F.col("commit").alias(COMMIT)).distinct(),
                                    COMMIT, "left_semi")
        settled = within(True)
        if versions:
            settled = settled.join(placed.filter("moved").select(F.col("commit").alias(COMMIT)).distinct(),
                                   COMMIT, "left_semi")
        if not any(r["moved"] for r in live):
            return recent
        if all(r["moved"] for r in live):
            return settled
        return recent.unionByName(settled)

    def metrics(self) -> DataFrame:
        """``(source, batch_id, metric, value)`` of every committed batch."""
        return (self.commits().groupBy("source", "batch_id").agg(F.first("metrics").alias("metrics"))
                .select("source", "batch_id", F.explode("metrics").alias("metric", "value")))

    # -- writing --------------------------------------------------------------------

    def _write(self, rows: DataFrame, gen: str, commit: str | None) -> list[str]:
        """Write rows (not committed yet); the partitions they went to.

        Without dealing them first, every task would write a file to every
        partition.  Few rows of many partitions share tasks.  Adaptive
        execution splits a large partition by its measured bytes; micro-batches
        run without it, so their largest partition is counted first.
        """
        if commit is not None:
            rows = rows.withColumn(COMMIT, F.lit(commit))
        if self.partition_by:
            adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
            if adaptive or commit is None:
                rows = rows.hint("rebalance", *self.partition_by)
            else:
                kept = [c for c in self.schema.names if c not in self.partition_by]
                rows = rows.repartition(*self.partition_by, F.pmod(F.xxhash64(*kept), F.lit(self._writers(rows))))
        stored = rows.withColumn(GENERATION, F.lit(gen)).select(self._stored().names)
        seen = Observation()
        stored = stored.observe(seen, F.collect_set(self.part()).alias("parts"))
        stored.write.mode("append").partitionBy(*self.partition_by, GENERATION).parquet(self.data)
        return list(seen.get["parts"])

    def _writers(self, rows: DataFrame) -> int:
        """Tasks for the largest partition of a batch."""
        most = rows.groupBy(*self.partition_by).count().agg(F.max("count")).first()[0] or 0
        return max(self.writers, -(-most // ROWS_PER_WRITER))

    def _commit(self, parts: list[str | None], gen: str, commit: str, version: int, source: str,
                batch_id: int | None, kind: str, covers: int | None, metrics: dict[str, int] | None) -> None:
        # Literals on one row: a single task, a single file.
        counts = [x for name, n in (metrics or {}).items() for x in (F.lit(name), F.lit(n))]
        values = {"part": F.explode(F.array(*[F.lit(p) for p in parts])), "gen": F.lit(gen), "commit": F.lit(commit),
                  "version": F.lit(version), "source": F.lit(source), "batch_id": F.lit(batch_id),
                  "kind": F.lit(kind), "covers": F.lit(covers),
                  "metrics": F.create_map(*counts) if counts else F.lit(None)}
        types = StructType.fromDDL(LOG)
        (self.spark.range(0, 1, 1, 1).select(*[values[f.name].alias(f.name) for f in types.fields])
         .select(*[F.col(f.name).cast(f.dataType) for f in types.fields])
         .write.mode("append").parquet(self.log_path))

    def append(self, rows: DataFrame, source: str, batch_id: int,
               metrics: Callable[[], dict[str, int]] | None = None) -> bool:
        """Append a batch of a source, unless it is committed already.

        ``metrics`` is called after the rows are written (for what an
        ``Observation`` of them counted) and committed with them.
        """
        state = self.log().agg(
            F.max("version").alias("version"),
            F.max(F.when(F.col("kind") == REPLACE, F.col("version"))).alias("replaced"),
            F.bool_or((F.col("source") == source) & (F.col("batch_id") == batch_id)).alias("done")).first()
        if state["done"]:
            return False
        commit, gen = uuid.uuid4().hex, f"a{state['replaced'] or 0}"
        parts = self._write(rows, gen, commit)
        # A batch without rows is committed as well, in no partition.
        self._commit(parts or [None], gen, commit, (state["version"] or 0) + 1, source, batch_id, APPEND, None,
                     metrics() if metrics else None)
        return True

    def replace(self, rows: DataFrame, parts: list[str], source: str, batch_id: int) -> bool:
        """New contents of whole partitions; rows of other partitions must not be among them."""
        if self.committed(source, batch_id):
            return False
        version = self.version() + 1
        commit, gen = uuid.uuid4().hex, f"c{version}"
        self._write(rows, gen, commit)
        self._commit(parts, gen, commit, version, source, batch_id, REPLACE, version - 1, None)
        return True

    def compact(self, least_commits: int = 2, where: Column | None = None) -> list[str]:
        """Rewrite the partitions that at least so many commits lie in; returns them.

        ``where`` limits the work to partitions (a condition on partition
        columns).  Adaptive execution deals a large partition to several tasks.
        """
        covers = self.version()
        rows = self.tagged()
        if where is not None:
            rows = rows.filter(where)
        settled = self._replaced()
        open_parts = self.commits().filter((F.col("version") <= covers) & F.col("part").isNotNull()).join(
            settled, "part", "left").filter(F.col("covered").isNull() | (F.col("version") > F.col("covered")))
        busy = [r["part"] for r in open_parts.groupBy("part").count().filter(
            F.col("count") >= least_commits).select("part").collect()]
        if not busy:
            return []
        # What came after the version read stays where it is.
        late = self.commits().filter(F.col("version") > covers).select(F.col("commit").alias(COMMIT))
        rows = rows.filter(self.part().isin(busy)).join(late, COMMIT, "left_anti")
        gen = f"c{covers + 1}-{uuid.uuid4().hex[:8]}"
        parts = self._write(rows, gen, None)
        if parts:
            self._commit(parts, gen, gen, covers + 1, COMPACTION, None, REPLACE, covers, None)
        return sorted(parts)

    # -- streams ---------------------------------------------------------------------

    def sink(self, source: str, shape: Callable[[DataFrame], DataFrame] | None = None
             ) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` handler that appends each micro-batch once."""
        def handle(batch: DataFrame, batch_id: int) -> None:
            self.on(batch.sparkSession).append(shape(batch) if shape else batch, source, batch_id)
        return handle

    def follow(self, handler: Callable[[DataFrame, int], None], checkpoint: str, **options) -> StreamingQuery:
        """Hand each newly committed batch's rows to ``handler(rows, batch_id)``.

        The stream reads the log, not the data, so rewritten rows are not
        seen again and rows without a commit never.
        """
        stream = self.spark.readStream.schema(LOG).parquet(self.log_path).filter(F.col("kind") == APPEND)

        def handle(batch: DataFrame, batch_id: int) -> None:
            here = self.on(batch.sparkSession)
            new = batch.select("commit").distinct()
            span = (here.commits().join(new, "commit", "left_semi")
                    .agg(F.min("version").alias("low"), F.max("version").alias("high")).first())
            if span["low"] is None:
                return
            rows = here.tagged(span["low"] - 1, span["high"]).join(
                new.select(F.col("commit").alias(COMMIT)), COMMIT, "left_semi")
            handler(rows.drop(COMMIT, GENERATION).select(self.schema.names), batch_id)

        return start_foreach_batch(stream, handle, checkpoint, **options)
