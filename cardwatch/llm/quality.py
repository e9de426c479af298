"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the corpus.

Words, pairs of words and triples of bytes are hashed into two tables of
counts, one over the trusted documents (labelled good and not toxic), one
over all documents.  A document's score is the mean, over its n-grams, of
the log ratio of the two smoothed multinomials.  The threshold is a low
quantile of the trusted documents' scores, less a margin; every document
is held against it, and against the base rules.

Edge cases: null and wordless texts have score null and fail the base
rules; without trusted documents all scores are 0 and only the base rules
decide.  Rows that repeat an id are scored each; labels that contradict
each other make a document untrusted.  Null ids are never trusted.  An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from .common import read, written

# Buckets of either table: words and their pairs; triples of bytes.
BITS = 16
BUCKETS = 2 << BITS
SMOOTHING = 1.0
# The threshold keeps all but this share of the trusted documents, less a
# margin: their own n-grams are in the counts, those of other clean
# documents are not.
TRUSTED_LOST = 0.002
MARGIN = 0.15

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACE = b"\t\n\x0b\x0c\r "
LEAST_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def buckets(raw: bytes, hashes: np.ndarray) -> np.ndarray:
    """Bucket of each n-gram of a text: its words, pairs of words and triples of bytes."""
    shift = np.uint64(64 - BITS)
    pairs = (hashes[:-1] * _MIX) ^ hashes[1:]
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    triples = ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(0x9E3779B1)
    return np.concatenate([(hashes * _MIX >> shift).astype(np.int64),
                           (pairs * _MIX >> shift).astype(np.int64),
                           (triples >> np.uint32(32 - BITS)).astype(np.int64) + (1 << BITS)])


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words lying in windows that occur twice or more."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        h = (h ^ hashes[i:n + i]) * _MIX
        h ^= h >> np.uint64(31)
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[inverse] > 1)
    edge = np.bincount(starts, minlength=len(hashes) + 1) - np.bincount(
        starts + window, minlength=len(hashes) + 1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def count_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    every = np.zeros(BUCKETS, dtype=np.int64)
    trusted = np.zeros(BUCKETS, dtype=np.int64)
    for frame in frames:
        for text, good in zip(frame["text"], frame["trusted"]):
            if text is not None:
                raw = text.encode("utf-8", "surrogatepass")
                n = np.bincount(buckets(raw, word_hashes(raw.split())), minlength=BUCKETS)
                every += n
                if good:
                    trusted += n
    at = np.flatnonzero(every)
    yield pd.DataFrame({"bucket": at, "trusted": trusted[at], "every": every[at]})


def scorer(ratio: np.ndarray):
    def score_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                raw = (text or "").encode("utf-8", "surrogatepass")
                words = raw.split()
                h = word_hashes(words)
                spaces = len(raw) - len(raw.translate(None, SPACE))
                score = float(ratio[buckets(raw, h)].mean()) if words else None
                rows.append((len(words), len(text or "") - spaces,
                             len(raw) - len(raw.translate(None, SYMBOLS)),
                             duplicate_lines(text or ""), repeated_words(h), score))
            out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words", "score"])
            out["doc_id"], out["trusted"] = frame["doc_id"].to_numpy(), frame["trusted"].to_numpy()
            yield out
    return score_batches


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that every label calls good and none toxic."""
    return (labels.groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("good"),
        F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .filter("doc_id is not null and good = 1 and toxic = 0").select("doc_id"))


def log_ratio(counts: DataFrame) -> np.ndarray:
    """Log ratio per bucket from counts ``(bucket, trusted, every)``: at most ``BUCKETS`` rows."""
    n, table = np.zeros((2, BUCKETS)), counts.toArrow()
    for row, name in enumerate(("trusted", "every")):
        n[row, table["bucket"].to_numpy()] = table[name].to_numpy()
    out = np.zeros(BUCKETS)
    if n[0].any():
        for half in (slice(0, 1 << BITS), slice(1 << BITS, BUCKETS)):   # a multinomial each
            p = n[:, half] + SMOOTHING
            p /= p.sum(axis=1, keepdims=True)
            out[half] = np.log(p[0] / p[1])
    return out


def rate_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, ``score``, ``base_failed`` and ``kept`` for ``docs(doc_id, text)``."""
    ids = trusted_ids(labels).withColumn("trusted", F.lit(True))
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    # Ids travel as text: pandas would turn whole numbers with nulls into floats.
    marked = docs.select("doc_id", "text").join(ids, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text",
        F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = marked.select("text", "trusted").mapInPandas(
        count_batches, "bucket long, trusted long, every long")
    ratio = log_ratio(counts.groupBy("bucket").agg(F.sum("trusted").alias("trusted"),
                                                   F.sum("every").alias("every")))
    scored = written(marked.mapInPandas(
        scorer(ratio), "doc_id string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, score double, trusted boolean"), "quality-scores")
    # An exact-rank quantile over a bounded histogram of the scores, so reruns agree.
    step = 1e-4
    histogram = (scored.filter("trusted and score is not null")
                 .groupBy(F.floor(F.col("score") / step).alias("cell")).count())
    cells = sorted((r["cell"], r["count"]) for r in histogram.collect())
    allowed, threshold = TRUSTED_LOST * sum(n for _, n in cells), float("-inf")
    for cell, n in cells:
        allowed -= n
        if allowed < 0:
            threshold = cell * step - MARGIN
            break
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
            .withColumn("threshold", F.lit(threshold)).drop("trusted")
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document."""
    return rate_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
