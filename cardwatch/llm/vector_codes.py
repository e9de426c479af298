"""Vector code compression: integer product codes, nearest entries found in the Walsh-Hadamard domain.

A vector's components become integers ``floor(scale * x)``; the vector is
cut into equal consecutive parts, and each part is replaced by the index of
the nearest entry in the codebook of its position.

Nearest entries are exact and need no floating point.  Parts and entries
are padded with zeros to a power of two P and transformed by integer
butterflies.  The transform scales every squared distance by exactly P, so
the squared differences of the coefficients, added up in sequency order
(slowly changing patterns first, where most of a part's energy lies), are
growing lower bounds: an entry leaves as soon as its sum exceeds the full
sum of a first guess.  What is left at the end holds the nearest entry.

Codebooks start as the parts of the vectors with the smallest ids and are
replaced, round by round, by the floored means of what was assigned to
them.  Tasks add up sums and counts per entry, so a round brings one row per
codebook component to the driver, whatever the number of vectors.

Edge cases: a null vector, or one with a null, NaN or infinite component,
is left out.  Vectors shorter than the longest kept one, and a longest one
that the parts do not divide, count as followed by zeros.  Ties go to the
lower index; entries to which nothing is assigned stay.  Rows that repeat
an id are separate rows (among the first entries, equal ids are ordered by
their components; a null id comes last).  With fewer vectors than entries
the codebooks are as short.  An empty table gives no rows.  Components so
large that squared distances would leave 64 bits (beyond 1.4 million for 64
components and a scale of 256) stop the job with a message.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import read, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Vectors that a task assigns at a time.
ROWS = 4096


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform, in sequency order, of the last axis padded to a power of two."""
    width = 1 << max(0, x.shape[-1] - 1).bit_length()
    out = np.zeros((*x.shape[:-1], width), dtype=np.int64)
    out[..., :x.shape[-1]] = x
    half = 1
    while half < width:
        pairs = out.reshape(*out.shape[:-1], width // (2 * half), 2, half)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :]
        pairs[..., 0, :] += b
        pairs[..., 1, :] = a - b
        half *= 2
    # Coefficient i of the butterflies changes sign as often as the Gray code of its reversed bits says.
    bits = width.bit_length() - 1
    natural = np.zeros(width, dtype=np.int64)
    for i in range(width):
        gray = i ^ (i >> 1)
        natural[i] = int(f"{gray:0{bits}b}"[::-1], 2) if bits else 0
    return out[..., natural]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, scaled squared distance) of the nearest entry of each transformed point."""
    by_first = np.argsort(entries[:, 0], kind="stable")
    at = np.searchsorted(entries[by_first, 0], points[:, 0])
    guess = entries[by_first[np.minimum(at, len(entries) - 1)]]
    bound = ((points - guess) ** 2).sum(axis=1)
    total = (points[:, :1] - entries[:, 0]) ** 2
    row, entry = np.nonzero(total <= bound[:, None])
    total = total[row, entry]
    for s in range(1, points.shape[1]):
        step = points[row, s] - entries[entry, s]
        total += step * step
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # Pairs are in order of row, then entry, and the guess always stays.
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(total, starts)
    ties = np.flatnonzero(total == least[row])
    first = ties[np.r_[True, row[ties][1:] != row[ties][:-1]]]
    return entry[first], least


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, index, position]``, whole numbers."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, errors): entry index per part and its squared distance, both rows x parts."""
        points = transform(vectors.reshape(len(vectors), self.parts, self.width))
        known = transform(self.entries)
        codes = np.empty((len(vectors), self.parts), dtype=np.int64)
        errors = np.empty_like(codes)
        for j in range(self.parts):
            codes[:, j], errors[:, j] = nearest(points[:, j], known[j])
        return codes, errors // points.shape[-1]

    def digest(self) -> str:
        """sha256 (hex) of all components, in decimal and in order."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def largest_component(parts: int, width: int) -> int:
    """Components up to this one keep every sum of squares within 64 bits."""
    padded = 1 << max(0, width - 1).bit_length()
    return math.isqrt((1 << 61) // max(1, width * max(padded, parts)))


def whole_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows kept, their lengths, their integer components one after the other)."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    bad = np.zeros(len(lengths), dtype=bool)
    bad[owner[~np.isfinite(flat)]] = True
    kept = (lengths >= 0) & ~bad
    with np.errstate(over="ignore"):
        scaled = np.floor(flat[kept[owner]] * scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 62:
        raise ValueError("a vector component is too large for exact integer codes")
    return np.flatnonzero(kept), lengths[kept], scaled.astype(np.int64)


def matrix(lengths: np.ndarray, flat: np.ndarray, parts: int, width: int) -> np.ndarray:
    """Vectors of ``parts * width`` components, zeros behind the shorter ones."""
    limit = largest_component(parts, width)
    if len(flat) and max(flat.max(), -flat.min()) > limit:
        raise ValueError(f"a scaled vector component exceeds {limit}, the most that exact integer codes allow")
    out = np.zeros((len(lengths), parts * width), dtype=np.int64)
    out[np.arange(parts * width) < lengths[:, None]] = flat
    return out


def _blocks(batches: Iterator[pa.RecordBatch], books: Codebooks):
    """(batch, rows, codes, errors, vectors) of at most ROWS kept rows at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            rows, lengths, flat = whole_vectors(part.column(0), books.scale)
            if len(rows):
                vectors = matrix(lengths, flat, books.parts, books.width)
                yield part, rows, *books.assign(vectors), vectors


def _integers(scale: int):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, flat = whole_vectors(batch.column(0), scale)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(rows)), pa.ListArray.from_arrays(ends, flat)],
                names=["id", "whole"])
    return convert


def _summer(books: Codebooks):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(books.entries.shape, dtype=np.int64)
        counts = np.zeros(books.entries.shape[:2], dtype=np.int64)
        for _, _, codes, _, vectors in _blocks(batches, books):
            pieces = vectors.reshape(len(vectors), books.parts, books.width)
            for j in range(books.parts):
                np.add.at(sums[j], codes[:, j], pieces[:, j])
                counts[j] += np.bincount(codes[:, j], minlength=counts.shape[1])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": counts[part, entry],
            "total": pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))})
    return add_up


def _improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: entries become floored means of their parts."""
    sums = vectors.mapInArrow(_summer(books), "part int, entry int, n long, total array<long>")
    exact = "decimal(38,0)"
    rows = (sums.select("part", "entry", "n", F.posexplode("total").alias("at", "value"))
            .groupBy("part", "entry", "at")
            .agg(F.sum(F.col("value").cast(exact)).alias("value"), F.sum("n").alias("n")).collect())
    entries = books.entries.copy()
    for r in rows:
        entries[r["part"], r["entry"], r["at"]] = int(r["value"]) // r["n"]
    return Codebooks(entries, books.scale)


def train(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of a table of vectors; None when no vector is kept.

    The driver holds the codebooks: ``entries`` times the vectors' length.
    """
    both = vectors.select(F.col(vector).alias("vector"), F.col(vec_id).alias("id"))
    schema = StructType([StructField("id", both.schema["id"].dataType),
                         StructField("whole", ArrayType(LongType()))])
    whole = both.mapInArrow(_integers(scale), schema)
    longest = whole.agg(F.max(F.size("whole"))).first()[0]
    if longest is None:
        return None
    first = whole.orderBy(F.col("id").asc_nulls_last(), "whole").limit(entries).collect()
    width = -(-longest // parts)
    start = matrix(np.array([len(r["whole"]) for r in first]),
                   np.array([x for r in first for x in r["whole"]], dtype=np.int64), parts, width)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2)), scale)
    only = both.select("vector")
    for _ in range(rounds):
        books = _improved(only, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding", code: str = "code",
           error: str = "error") -> DataFrame:
    """Kept rows of ``vectors`` with ``code`` (two hex digits a part) and ``error`` in place of the vector."""
    others = [c for c in vectors.columns if c not in (vector, code, error)]
    schema = StructType([*(vectors.schema[c] for c in others), StructField(code, StringType()),
                         StructField(error, LongType())])
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, codes, errors, _ in _blocks(batches, books):
            texts = ["".join(r) for r in digits[codes].tolist()]
            kept = [part.column(i + 1).take(pa.array(rows)) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), pa.array(errors.sum(axis=1))], names=[*others, code, error])

    if books.entries.shape[1] > 256:
        raise ValueError("two hex digits a part hold at most 256 entries")
    return vectors.select(vector, *others).mapInArrow(run, schema)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every kept vector, the error of its label, the codebooks' digest."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = train(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, "
                                         "codebooks_sha256 string")
    coded = written(encode(vectors, books), "vector-codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")))


def _oracle() -> str:
    """DuckDB SQL of ``op11_vector_codes``: plain distances to every entry."""
    def assigned(books: str) -> str:
        return f"""
        SELECT vec_id, row_no, label, part, x,
               arg_min(entry, (list_sum(list_transform(range(1, len(x) + 1),
                   lambda i: (x[i] - e[i]) * (x[i] - e[i])))::BIGINT * 64 + entry)) AS entry,
               min(list_sum(list_transform(range(1, len(x) + 1),
                   lambda i: (x[i] - e[i]) * (x[i] - e[i])))::BIGINT) AS d
        FROM parts JOIN {books} USING (part) GROUP BY vec_id, row_no, label, part, x"""

    def means(assignment: str, books: str) -> str:
        return f"""
        SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {books} b LEFT JOIN (
            SELECT part, entry, list(value ORDER BY pos) AS e FROM (
                SELECT part, entry, pos, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*))
                                         // count(*))::BIGINT AS value
                FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS pos FROM {assignment})
                GROUP BY part, entry, pos) GROUP BY part, entry) m USING (part, entry)"""

    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row_no,
               list_transform(embedding, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS whole
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, row_no, label, part,
               whole[part * (len(whole) // {PARTS}) + 1:(part + 1) * (len(whole) // {PARTS})] AS x
        FROM kept, unnest(range({PARTS})) AS p(part)),
    b0 AS MATERIALIZED (SELECT part, row_no - 1 AS entry, x AS e FROM parts WHERE row_no <= {ENTRIES}),
    a0 AS MATERIALIZED ({assigned("b0")}),
    b1 AS MATERIALIZED ({means("a0", "b0")}),
    a1 AS MATERIALIZED ({assigned("b1")}),
    b2 AS MATERIALIZED ({means("a1", "b1")}),
    a2 AS MATERIALIZED ({assigned("b2")}),
    coded AS (
        SELECT vec_id, row_no, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
               sum(d)::BIGINT AS error
        FROM a2 GROUP BY vec_id, row_no, label),
    flat AS (SELECT part, entry, unnest(e) AS v, unnest(range(len(e))) AS pos FROM b2),
    digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS sha FROM flat)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           sha AS codebooks_sha256
    FROM coded, digest"""


ORACLE = _oracle()
