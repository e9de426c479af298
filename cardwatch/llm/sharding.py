"""Extendible hashing: documents into shards that each fit a byte limit.

A document's hash is a string of 60 bits.  A shard is a prefix of those
bits; its local depth is the prefix's length.  Starting from the empty
prefix, only shards over the limit split, on one more bit, until every
shard fits.  The directory has one entry per hash prefix of the global
depth; several entries name the same shard where its local depth is less.

Byte sums are taken once per directory cell (a prefix a few bits longer
than needed on average) and added up the binary tree of prefixes, so one
pass over the sizes decides all splits down to that depth.  Cells still
over the limit there, few by construction, are opened by further rounds
of bits that read only their rows.

Rows that repeat both id and text are told apart by a copy number: the first
keeps the hash of id and text, each further one hashes that and its number.

Edge cases: a null text has 0 bytes; a null id hashes as ``null``.  A document
larger than the limit, however long, makes a shard of its own that stays over
it, marked ``fits = false``.  An empty table gives
no rows.  Extra columns are carried along; columns named like the added
ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, row_key, unused, written

HASH_BITS = 60
# Bytes of text a shard may hold.
LIMIT_BYTES = 16 * 1024 * 1024
# Bits of a directory cell beyond those that equal shards would need, and
# bits that each further round opens.
SPARE_BITS = 4
ROUND_BITS = 8


def hash_bits(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The first 60 bits of the row key, as a long."""
    return _first_bits(row_key(doc_id, text))


def _first_bits(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def _prefix(bits: int) -> Column:
    return F.expr(f"shiftright(h, {HASH_BITS - bits})")


def _round(sized: DataFrame, above: int, bits: int, limit: int) -> DataFrame:
    """Directory cells of ``bits`` bits: (cell, depth, bytes, docs, done).

    ``above``: the depth that is known to be over the limit (-1: none).
    A prefix is settled if it fits or holds a single hash; a shard is a
    settled prefix whose parent is not.  ``done`` is false for a cell that
    is not settled and has to be opened further.
    """
    cells = (sized.groupBy(_prefix(bits).alias("cell"))
             .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"),
                  F.min("h").alias("low"), F.max("h").alias("high")))
    nodes = (cells.withColumn("depth", F.explode(F.sequence(F.lit(above + 1), F.lit(bits))))
             .groupBy("depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("prefix"))
             .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"),
                  F.min("low").alias("low"), F.max("high").alias("high"))
             .withColumn("settled", (F.col("bytes") <= limit) | (F.col("low") == F.col("high"))))
    parents = nodes.filter(~F.col("settled")).select(
        (F.col("depth") + 1).alias("depth"), F.explode(
            F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
        F.lit(True).alias("split"))
    first = F.col("depth") == above + 1
    shards = (nodes.join(parents, ["depth", "prefix"], "left")
              .filter((first | F.col("split")) & (F.col("settled") | (F.col("depth") == bits))))
    # A shard's entries of the directory: every cell below its prefix that holds rows.
    entries = shards.withColumn("cell", F.explode(F.expr(
        f"sequence(shiftleft(prefix, {bits} - depth), shiftleft(prefix + 1, {bits} - depth) - 1)")))
    return entries.join(cells.select("cell"), "cell", "left_semi").select(
        "cell", "depth", "prefix", F.col("bytes").alias("shard_bytes"),
        F.col("docs").alias("shard_docs"), F.col("settled").alias("done"))


def numbered(sized: DataFrame) -> DataFrame:
    """Rows ``(h, bytes, ...)`` with ``h`` made different where rows share it.

    Two steps, so that no task gets all rows of one hash: rows are numbered
    within the task that wrote them, and tasks by running sums of their
    counts.  Which of the rows that share a hash gets which number is open
    (they have the same id and text), but it is settled once, in the table
    written here.
    """
    part = unused(sized, "__part")
    rows = written(sized.withColumn(part, F.spark_partition_id()), "shards-sizes")   # one pass over the texts
    over = Window.partitionBy("h")
    counts = (rows.groupBy("h", part).agg(F.count(F.lit(1)).alias("n"))
              .withColumns({"__before": F.sum("n").over(over.orderBy(part)) - F.col("n"),
                            "__all": F.sum("n").over(over)})
              .filter(F.col("__all") > 1).select("h", part, "__before"))
    repeated = written(counts, "shards-repeated")
    once = rows.join(repeated.select("h").distinct(), "h", "left_anti")
    copy = F.col("__before") + F.row_number().over(Window.partitionBy("h", part).orderBy("bytes")) - 1
    again = (rows.join(repeated, ["h", part]).withColumn("__copy", copy)
             .withColumn("h", F.when(F.col("__copy") == 0, F.col("h")).otherwise(
                 _first_bits(F.md5(F.concat_ws(":", "h", "__copy"))))))
    return written(once.select(*sized.columns).unionByName(again.select(*sized.columns)), "shards-numbered")


def assign(sized: DataFrame, limit: int = LIMIT_BYTES, name: str = "shards") -> DataFrame:
    """Rows ``(h, bytes, ...)`` with ``shard``, ``shard_depth``, ``shard_bytes``, ``shard_docs``, ``fits``.

    ``shard`` spells the prefix in binary (empty: a single shard).  The
    driver only gets the byte total and, per round, the number of cells
    that are still open.
    """
    if limit < 1:
        raise ValueError("a shard needs a limit of one byte at least")
    sized = numbered(sized)
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    above, bits = -1, min(HASH_BITS, SPARE_BITS + math.ceil(math.log2(max(1.0, total / limit))))
    rows, parts = sized, []
    while True:
        directory = written(_round(rows, above, bits, limit), f"{name}-directory")
        joined = rows.withColumn("cell", _prefix(bits)).join(directory, "cell")
        last = bits == HASH_BITS
        parts.append(joined if last else joined.filter("done"))
        if last or directory.filter(~F.col("done")).isEmpty():
            break
        rows = joined.filter(~F.col("done")).select(*sized.columns)
        above, bits = bits, min(HASH_BITS, bits + ROUND_BITS)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*sized.columns, F.expr("lpad(bin(prefix), depth, '0')").alias("shard"),
                      F.col("depth").cast("int").alias("shard_depth"), "shard_bytes", "shard_docs",
                      (F.col("shard_bytes") <= limit).alias("fits"))


def shard_documents(docs: DataFrame, limit: int = LIMIT_BYTES, doc_id: str = "doc_id",
                    text: str = "text", with_fits: bool = False) -> DataFrame:
    """``docs`` with the column ``shard``, rows of a shard side by side.

    The documents are written once with a number per row, by which the rows
    find their shards, so that rows that are alike can go to different ones.
    ``with_fits`` adds ``fits``, false for a shard over the limit (a single
    document).
    """
    h, size, row = (unused(docs, x) for x in ("__h", "__bytes", "__row"))
    kept = written(docs.withColumns({h: hash_bits(doc_id, text), size: text_bytes(text),
                                     row: F.monotonically_increasing_id()}), "shards-documents")
    placed = assign(kept.select(F.col(row).alias("row"), F.col(h).alias("h"), F.col(size).alias("bytes")), limit)
    names = ["shard", "fits"] if with_fits else ["shard"]
    added = placed.select(F.col("row").alias(row), F.struct(*names).alias(h))
    out = (kept.drop(h, size).join(added, row)
           .withColumns({name: F.col(f"{h}.{name}") for name in names}).drop(h, row))
    return out.repartition("shard").sortWithinPartitions("shard", doc_id)


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, at the production limit."""
    sized = read(spark, sf_dir, "documents").select(
        "doc_id", hash_bits().alias("h"), text_bytes().alias("bytes"))
    return assign(sized).select("doc_id", F.col("bytes").alias("n_bytes"), "shard", "shard_depth",
                                "shard_bytes", "shard_docs", "fits")


ORACLE_TEMPLATE = """
WITH keyed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' ||
                             coalesce(md5(text), 'null')), 1, 15))::BIGINT AS k
  FROM {documents}),
copies AS (SELECT *, row_number() OVER (PARTITION BY k) - 1 AS copy FROM keyed),
sized AS (
  SELECT doc_id, n_bytes, CASE WHEN copy = 0 THEN k
         ELSE ('0x' || substr(md5(k || ':' || copy), 1, 15))::BIGINT END AS h
  FROM copies),
nodes AS (
  SELECT d.depth, h >> (60 - d.depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes,
         count(*) AS shard_docs
  FROM sized, (SELECT unnest(range(61))::INTEGER AS depth) d
  GROUP BY 1, 2 HAVING sum(n_bytes) <= {limit} OR min(h) = max(h)),
ranked AS (
  SELECT s.doc_id, s.n_bytes, n.*, min(n.depth) OVER (PARTITION BY s.h) AS least
  FROM sized s JOIN nodes n ON n.prefix = s.h >> (60 - n.depth))
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
       depth AS shard_depth, shard_bytes, shard_docs, shard_bytes <= {limit} AS fits
FROM ranked WHERE depth = least
"""
ORACLE = ORACLE_TEMPLATE.format(documents="documents", limit=LIMIT_BYTES)
