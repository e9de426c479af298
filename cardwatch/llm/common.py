"""Helpers shared by the text operators: words, row keys, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import new_run

# A word is a run of anything but the six ASCII space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A never-null key of a row: md5 (hex) of its id and of the md5 of its text.

    Rows that repeat both id and text share a key; a null id or text is
    spelled ``null``.
    """
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"),
                          F.coalesce(F.md5(F.col(text)), F.lit("null"))))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# Characters of text that a task works on at a time.
CHARS = 2_000_000


def slices(texts: Sequence[str | None], limit: int = CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts of about ``limit`` characters (one text may be longer)."""
    a, n = 0, 0
    for i, t in enumerate(texts):
        if i > a and n + len(t or "") > limit:
            yield a, i
            a, n = i, 0
        n += len(t or "")
    if a < len(texts):
        yield a, len(texts)


def word_count(text: str | Column = "text") -> Column:
    """Words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs no recomputation of what lies
    before, and several readers do not compute it twice.
    """
    spark = df.sparkSession
    path = new_run(spark, name).table("rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
