"""SimHash near-duplicates: 64-bit fingerprints searched in BK-trees.

A fingerprint bit is 1 where over half of the hashes of a text's three-word
shingles have it.  Two fingerprints link when at most ``radius`` bits
differ; a component holds everything that links can reach.

A BK-tree keys the children of a node by their Hamming distance to it.  All
descendants behind key k lie at distance k from the node, so a search with
distance d to the node follows only the edges d - radius .. d + radius.

One tree over all fingerprints would prune little (distances of unrelated
fingerprints crowd around 32) and fit no task, so the trees are shards:

1. Of ``radius + 1`` blocks of bits, two linked fingerprints agree in at
   least one.  Every distinct fingerprint goes to one bucket per block, and
   each bucket has a tree.
2. A bucket beyond ``SHARD`` fingerprints is cut anew by the bits that are
   not fixed yet, by the same rule, up to ``DEPTH`` times.  What is still
   larger is dealt in pieces, and the tree of each piece meets every piece,
   a task a pair.  Either way no link is lost and no task holds more than a
   bounded number of fingerprints.
3. A task builds the trees of its buckets, level by level, and searches
   them with all its fingerprints at a time.  It returns each fingerprint
   with the least of its linked part.

Trees are sent to the fingerprints that search them by a shuffle on their
shard.  A driver broadcast would take all fingerprints through the driver.

Edge cases: texts without a word (null and empty ones too) have fingerprint
zero and link like any other; one or two words form one shingle.  Very long
texts are hashed in runs of bounded size.  Bits that exactly half of the
hashes have are 0.  Rows that repeat an id are rows of their own; a null id
never names a component unless all its ids are null.  An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import read, slices, written
from .components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
# Fingerprints of a bucket that is searched as one tree; cuts of larger ones.
SHARD = 512
DEPTH = 3
# Fingerprints of a task, and of a search step.
TASK = 32_768
STEP = 2048
# Bytes of text split into words at a time, and hashes counted at a time.
RUN = 1 << 20
HASHES = 1 << 16

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: str | None) -> Iterator[list[int]]:
    """The XXH64 of a text's shingles, in order, in runs of bounded size."""
    data = text.encode("utf-8", "surrogatepass").lower() if text else b""
    digest, tail, seen, a = xxhash.xxh64_intdigest, [], 0, 0
    while a < len(data):
        space = _SPACE.search(data, a + RUN) if len(data) - a > RUN else None
        b = space.start() if space else len(data)
        words = data[a:b].split()
        seen += len(words)
        words = tail + words
        yield [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(SHINGLE)))]
        tail, a = words[1 - SHINGLE:], b
    if 0 < seen < SHINGLE:
        yield [digest(b" ".join(tail), SEED)]


def fingerprints_of(texts: list[str | None]) -> np.ndarray:
    """Signed 64-bit fingerprint of each text."""
    ones = np.zeros((len(texts), BITS), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    held, owners, n = [], [], 0

    def count() -> None:
        hashes = np.array([h for run in held for h in run], dtype=np.uint64)
        owner = np.repeat(np.array(owners, dtype=np.int64), [len(run) for run in held])
        for a in range(0, len(hashes), HASHES):
            part, of = hashes[a:a + HASHES], owner[a:a + HASHES]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[of[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
            totals[of[starts]] += np.diff(np.r_[starts, len(of)])

    for i, text in enumerate(texts):
        for run in shingle_hashes(text):
            if run:
                held.append(run)
                owners.append(i)
                n += len(run)
            if n > HASHES:
                count()
                held, owners, n = [], [], 0
    count()
    bits = np.packbits(2 * ones > totals[:, None], axis=1)
    return bits.view(">u8").ravel().astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``, one row per document; the fingerprint is a signed long."""
    both = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([both.schema["doc_id"], StructField("fingerprint", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [fingerprints_of(texts[a:b]) for a, b in slices(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(found) if found else [], pa.int64())],
                names=["doc_id", "fingerprint"])
    return both.mapInArrow(run, schema)


class Forest:
    """BK-trees of several buckets, as arrays; all of a bucket's values are distinct.

    ``buckets`` (sorted) and ``values`` are aligned.  A node is an index into
    them; the first of a bucket is its root.
    """

    def __init__(self, buckets: np.ndarray, values: np.ndarray) -> None:
        self.values = values
        first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]][:len(buckets)])
        self.roots = dict(zip(buckets[first].tolist(), first.tolist()))
        parent = np.full(len(values), -1, dtype=np.int64)
        edge = np.zeros(len(values), dtype=np.int64)
        left = np.setdiff1d(np.arange(len(values)), first, assume_unique=True)
        at = first[np.searchsorted(first, left, side="right") - 1]
        # Each round every value goes down one edge; the first to take an edge becomes its node.
        while len(left):
            far = np.bitwise_count(values[left] ^ values[at]).astype(np.int64)
            _, new, via = np.unique(at * (BITS + 1) + far, return_index=True, return_inverse=True)
            parent[left[new]], edge[left[new]] = at[new], far[new]
            at = left[new][via]
            rest = at != left
            left, at = left[rest], at[rest]
        child = np.flatnonzero(parent >= 0)
        links = parent[child] * (BITS + 1) + edge[child]
        order = np.argsort(links, kind="stable")
        self.links, self.children = links[order], child[order]

    def search(self, buckets: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of every node of the query's bucket within the radius."""
        queries, nodes = [], []
        for a in range(0, len(values), STEP):
            root = np.array([self.roots.get(b, -1) for b in buckets[a:a + STEP].tolist()], dtype=np.int64)
            query = np.flatnonzero(root >= 0)
            node, query = root[query], query + a
            while len(query):
                far = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
                hit = far <= radius
                queries.append(query[hit])
                nodes.append(node[hit])
                low = np.searchsorted(self.links, node * (BITS + 1) + np.maximum(far - radius, 0))
                high = np.searchsorted(self.links, node * (BITS + 1) + np.minimum(far + radius, BITS), side="right")
                wide = high - low
                query = np.repeat(query, wide)
                step = np.arange(len(query)) - np.repeat(np.cumsum(wide) - wide, wide)
                node = self.children[np.repeat(low, wide) + step]
        none = np.empty(0, dtype=np.int64)
        return np.concatenate([none, *queries]), np.concatenate([none, *nodes])


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, least value that its links reach) of all linked values."""
    known, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    label = np.arange(len(known))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        # Hand the better label to the old label's own place as well, then shorten chains.
        np.minimum.at(new, label, new.copy())
        new = new[new]
        if (new == label).all():
            return known, known[label]
        label = new


def searcher(radius: int):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["shard", "fingerprint"])
        shard = frame["shard"].to_numpy()
        value = frame["fingerprint"].to_numpy().view(np.uint64)
        tree, asks = frame["tree"].to_numpy(), frame["asks"].to_numpy()
        forest = Forest(shard[tree], value[tree])
        query, node = forest.search(shard[asks], value[asks], radius)
        a, b = value[asks][query].view(np.int64), forest.values[node].view(np.int64)
        other = a != b
        u, v = least_reachable(a[other], b[other])
        moved = u != v
        return pd.DataFrame({"u": u[moved], "v": v[moved]})
    return search


def cuts(fixed: int, radius: int) -> list[int]:
    """Masks that fix one more block of the bits that ``fixed`` leaves; one for each of radius + 1 blocks."""
    free = [1 << i for i in range(BITS) if not fixed >> i & 1]
    ends = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [fixed | sum(free[a:b]) for a, b in zip(ends, ends[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def shards(distinct: DataFrame, radius: int = RADIUS, limit: int = SHARD, depth: int = DEPTH) -> DataFrame:
    """``(task, shard, fingerprint, tree, asks)``: who builds and who searches the tree of which shard."""
    masks = cuts(0, radius)
    level = distinct.select("fingerprint", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    done = None
    for deeper in range(depth + 1):
        level = written(level.withColumn("bits", F.col("fingerprint").bitwiseAND(F.col("mask"))), "simhash-buckets")
        large = written(level.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit),
                        "simhash-large")
        if large.isEmpty() or deeper == depth:
            break
        kept = level.join(large, ["mask", "bits"], "left_anti").select("fingerprint", "mask", "bits")
        done = kept if done is None else done.unionByName(kept)
        next_masks = {m: cuts(m, radius) for m in masks}
        masks = sorted({c for m in masks for c in next_masks[m]})
        children = F.create_map(*[x for m, cs in next_masks.items() for x in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cs]))])
        level = level.join(large, ["mask", "bits"], "left_semi").select(
            "fingerprint", F.explode(F.element_at(children, F.col("mask"))).alias("mask"))
    small = level.join(large, ["mask", "bits"], "left_anti").select("fingerprint", "mask", "bits")
    small = small if done is None else done.unionByName(small)
    total = small.count()
    shard = F.xxhash64("mask", "bits")
    small = small.select(F.pmod(shard, F.lit(max(1, math.ceil(total / TASK)))).alias("task"),
                         F.concat_ws(":", F.hex("mask"), F.hex("bits")).alias("shard"), "fingerprint",
                         F.lit(True).alias("tree"), F.lit(True).alias("asks"))
    pieces = (level.join(large, ["mask", "bits"])
              .withColumn("pieces", F.ceil(F.col("n") / limit).cast("long"))
              .withColumn("piece", F.pmod(F.xxhash64("fingerprint"), F.col("pieces")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
              .withColumn("a", F.least("piece", "other")).withColumn("b", F.greatest("piece", "other")))
    pieces = pieces.select(
        (-1 - F.pmod(F.xxhash64("mask", "bits", "a", "b"), F.lit((1 << 62)))).alias("task"),
        F.concat_ws(":", F.hex("mask"), F.hex("bits"), "a", "b").alias("shard"), "fingerprint",
        (F.col("piece") == F.col("a")).alias("tree"), (F.col("piece") == F.col("b")).alias("asks"))
    return small.unionByName(pieces)


def linked_components(marked: DataFrame, radius: int = RADIUS, limit: int = SHARD, depth: int = DEPTH) -> DataFrame:
    """``(fingerprint, component_id)`` for the ``(doc_id, fingerprint)`` of ``marked``."""
    distinct = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    ties = (shards(distinct.select("fingerprint"), radius, limit, depth)
            .groupBy("task").applyInPandas(searcher(radius), "u long, v long"))
    roots = components(ties, "simhash-links").select(F.col("u").alias("fingerprint"), "root")
    rooted = written(distinct.join(roots, "fingerprint", "left")
                     .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "simhash-rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fingerprint", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document; the fingerprint in hex."""
    marked = written(fingerprints(docs, doc_id, text), "simhash-fingerprints")
    found = written(linked_components(marked, radius), "simhash-components")
    return marked.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
