"""Line dedup: windows of three lines that occurred before are removed.

Every run of three consecutive lines of a text is hashed to 128 bits (two
64-bit hashes with different seeds), so that even 10^12 windows leave no
chance match to be expected.  Over the whole corpus the first occurrence of a window (by document id, row key and
position) stays; each later one marks its three lines as covered, and a
document loses the union of its covered lines.

Edge cases: a null text stays null (0 lines); texts of fewer than three
lines, and windows without any word, are never covered.  A null id sorts
last.  Rows that repeat both id and text count as one document and lose
the same lines.  An empty table gives no rows.  Lines are compared as
they are, without trimming.  A very long text is split into its lines in one
row, and its windows are rows of their own from then on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, row_key, unused

WINDOW = 3
# Begins the second of a window's two hashes.
SEED = 7919


def covered_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, covered)``: sorted line numbers (from 0) to remove, per row key."""
    lines = docs.select(F.col(doc_id).alias("id"), row_key(doc_id, text).alias("key"),
                        F.split(F.col(text), "\n", -1).alias("lines"))
    hashes = F.expr(f"""transform(sequence(0, size(lines) - {WINDOW}), i ->
        if(concat(lines[i], lines[i + 1], lines[i + 2]) rlike '[^\\\\x20\\\\x09-\\\\x0D]',
           struct(xxhash64(lines[i], lines[i + 1], lines[i + 2]) as a,
                  xxhash64({SEED}, lines[i], lines[i + 1], lines[i + 2]) as b), null))""")
    windows = (lines.filter(F.size("lines") >= WINDOW)
               .select("id", "key", F.posexplode(hashes).alias("at", "hash"))
               .filter(F.col("hash").isNotNull())
               .select("id", "key", "at", "hash.a", "hash.b"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "at")
    firsts = (windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
              .filter(F.col("n") > 1)
              .select("a", "b", F.col("first.key").alias("first_key"), F.col("first.at").alias("first_at")))
    later = windows.join(firsts, ["a", "b"]).filter(
        (F.col("key") != F.col("first_key")) | (F.col("at") != F.col("first_at")))
    return later.groupBy("key").agg(F.collect_set("at").alias("at")).select(
        "key", F.expr(f"array_sort(array_distinct(flatten(transform(at, a -> "
                      f"sequence(a, a + {WINDOW - 1})))))").alias("covered"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the text cleaned, and ``n_lines`` and ``n_removed`` (replaced if present)."""
    key, gone, lines = (unused(docs, x) for x in ("__key", "__covered", "__lines"))
    covered = covered_lines(docs, doc_id, text).select(F.col("key").alias(key),
                                                       F.col("covered").alias(gone))
    joined = (docs.withColumn(key, row_key(doc_id, text)).join(covered, key, "left")
              .withColumn(lines, F.split(F.col(text), "\n", -1)))
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)),
        lambda i: F.element_at(F.col(lines), i + 1)), "\n")
    count = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0).cast("long")
    return (joined.withColumn("n_lines", count(lines)).withColumn("n_removed", count(gone))
            .withColumn(text, F.when(F.col("n_removed") > 0, kept).otherwise(F.col(text)))
            .drop(key, gone, lines))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of windows that occurred before it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


ORACLE_TEMPLATE = r"""
WITH docs AS (
  SELECT doc_id, text, md5(coalesce(doc_id::VARCHAR, 'null') || ':' ||
                           coalesce(md5(text), 'null')) AS key,
         string_split(text, chr(10)) AS lines
  FROM {documents}),
windows AS (
  SELECT doc_id, key, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS w
  FROM (SELECT DISTINCT doc_id, key, lines, unnest(range(len(lines) - 2)) AS pos
        FROM docs WHERE len(lines) >= 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS LAST, key, pos) AS nth
  FROM windows WHERE regexp_matches(w, '[^\x20\x09-\x0D]')),
covered AS (
  SELECT key, list(DISTINCT line) AS removed
  FROM (SELECT key, unnest([pos, pos + 1, pos + 2]) AS line FROM placed WHERE nth > 1) GROUP BY key)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines,
       coalesce(len(removed), 0)::BIGINT AS n_removed,
       CASE WHEN removed IS NULL THEN text ELSE array_to_string(
         [lines[i + 1] FOR i IN range(len(lines)) IF NOT list_contains(removed, i)], chr(10)) END AS text
FROM docs LEFT JOIN covered USING (key)
"""
ORACLE = ORACLE_TEMPLATE.format(documents="documents")
