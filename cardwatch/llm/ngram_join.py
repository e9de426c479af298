"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets verify them.

Links are pairs of documents whose sets of five-word shingles have a
Jaccard similarity of at least the threshold.  A class is a connected
component of links.

1. A text is represented once, whatever the number of its copies (by the
   md5 of the text); copies add to the counts only.
2. A signature of ``bands * rows`` minima is cut into bands.  Rows and
   bands follow from the recall wanted at the threshold.  Texts are
   shuffled by band hash; within a bucket each text is tied to the
   bucket's least one, so a bucket of n texts costs n - 1 rows, not all
   pairs.
3. The components of these ties hold every candidate pair.  Small ones are
   packed into tasks of bounded bytes; large ones are cut into blocks, and
   all pairs of blocks are compared.
4. A block of a large component gets each of its texts once, and the
   component's first text beside them.  It keeps of every text what its
   shingle set and the first one's do not share: with D the difference to L,
   ``|A & B| = |L| - |L - A| - |L - B| + |D(A) & D(B)|``, exactly.  Near
   copies differ in few shingles, so what travels to the pairs of blocks is a
   small part of the texts.
5. Exact Jaccard similarities come from the full shingle sets (64-bit
   hashes), or from the differences, by products of blocks of the incidence
   matrix.  A task returns one row per text: how many documents it links to
   there, and the least text of its linked part, which stands for the
   links when classes are joined up across blocks.

Edge cases: texts of one to four words form a single shingle; texts
without a word link only to their copies; a null text is a class of its
own without links.  Rows that repeat id and text are documents like any
others.  A null id is the last choice for a class's id.  Of rows that repeat
id and text but differ elsewhere the first in the order of all columns stays.
Very long texts are compared whole; a block holds one at least.  An empty
table gives no rows.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..operators.joins import fits_broadcast
from .common import read, row_key, unused, written
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
SEED = 41
# Texts of a block of a large component, and bytes of text of a block or pack.
BLOCK_TEXTS = 512
BLOCK_BYTES = 4 * 1024 * 1024
# Cells of the incidence matrix held at a time.
CELLS = 4_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands, for this recall at the threshold, fit the budget.

    A pair of similarity s shares a band with probability
    ``1 - (1 - s ** rows) ** bands``.
    """
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the budget of hashes is too small for this recall")
    return best


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    n = min(SHINGLE, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = (out ^ h[i:len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 1 << 64, n, dtype=np.uint64))


def minima(shingles: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 2048):
        part = shingles[None, a:a + 2048] ^ masks[:, None]
        part *= factors[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def signer(bands: int, rows: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors, masks = _hash_family(bands * rows)
        for frame in frames:
            signatures, last, signature = [], None, None
            for digest, text in zip(frame["digest"], frame["text"]):
                if digest != last:
                    s = shingle_hashes(text)
                    m = minima(s, factors, masks).reshape(bands, rows)
                    signature = ([xxhash.xxh3_64_intdigest(b.tobytes(), seed=i) - (1 << 63)
                                  for i, b in enumerate(m)] if len(s) else [])
                    last = digest
                signatures.append(signature)
            yield pd.DataFrame({"digest": frame["digest"], "key": frame["key"],
                                "bands": signatures})
    return sign


def common_counts(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """How many hashes any two sets share; with ``split``, of the first part against the rest."""
    n, cut = len(sets), split
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    common = np.cumsum(count > 1) - 1
    column = common[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(1, CELLS // n)
    left, right = (slice(None), slice(None)) if cut is None else (slice(0, cut), slice(cut, None))
    overlap = np.zeros((n if cut is None else cut, n if cut is None else n - cut))
    total = int(column[-1]) + 1 if len(column) else 0
    for c0 in range(0, total, width):
        a, b = np.searchsorted(column, [c0, c0 + width])
        m = np.zeros((n, min(width, total - c0)), dtype=np.float32)
        m[owner[a:b], column[a:b] - c0] = 1
        overlap += m[left] @ m[right].T
    if cut is None:
        np.fill_diagonal(overlap, [len(s) for s in sets])
    return overlap


def links_of(overlap: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets, of these sizes and overlaps, are similar enough."""
    union = left[:, None].astype(np.float64) + right[None, :] - overlap
    return (overlap >= threshold * union - 1e-9) & (overlap > 0)


def jaccard_links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of links among sets."""
    sizes = np.array([len(s) for s in sets])
    links = links_of(common_counts(sets), sizes, sizes, threshold)
    np.fill_diagonal(links, False)
    return links


def _least_linked(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the least index of its connected part."""
    label = np.arange(len(links))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def link_rows(links: np.ndarray, digests: np.ndarray, copies: np.ndarray) -> pd.DataFrame:
    """One row per linked text of a symmetric matrix: the least text it reaches, and linked documents."""
    linked = np.flatnonzero(links.any(axis=1))
    least = _least_linked(links[np.ix_(linked, linked)])
    return pd.DataFrame({"digest": pd.Series(list(digests[linked]), dtype=object),
                         "hub": pd.Series(list(digests[linked[least]]), dtype=object),
                         "links": (links[linked] @ copies).astype(np.int64)})


def verifier(threshold: float):
    """Links within the small components of a task."""
    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["root", "digest"]).sort_values(["root", "digest"])
        out = [link_rows(np.zeros((0, 0), dtype=bool), np.empty(0, dtype=object), np.empty(0, dtype=np.int64))]
        for _, part in frame.groupby("root", sort=False):
            if len(part) > 1:
                links = jaccard_links([shingle_hashes(t) for t in part["text"]], threshold)
                out.append(link_rows(links, part["digest"].to_numpy(), part["copies"].to_numpy()))
        return pd.concat(out, ignore_index=True)
    return verify


def differences(threshold: float):
    """Links within a block of a large component, and the block as differences to the component's first text."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first = shingle_hashes(frame.loc[frame["first"], "text"].iloc[0])
        part = frame[~frame["first"]].drop_duplicates("digest").sort_values("digest")
        sizes, removed, differ = [], [], []
        for text in part["text"]:
            s = shingle_hashes(text)
            d = np.setxor1d(s, first, assume_unique=True)
            sizes.append(len(s))
            differ.append(d)
            removed.append((len(d) - len(s) + len(first)) // 2)
        sizes, removed = np.array(sizes), np.array(removed)
        digests, copies = part["digest"].to_numpy(), part["copies"].to_numpy()
        overlap = common_counts(differ) + (len(first) - removed[:, None] - removed[None, :])
        links = links_of(overlap, sizes, sizes, threshold)
        np.fill_diagonal(links, False)
        out = link_rows(links, digests, copies)
        out["pack"] = None
        packed = io.BytesIO()
        np.savez_compressed(packed, first=len(first), sizes=sizes, removed=removed, copies=copies,
                            digests=np.frombuffer(b"".join(map(bytes, digests)), dtype="V16"),
                            ends=np.cumsum([len(d) for d in differ]), differ=np.concatenate(differ))
        block = pd.DataFrame({"digest": [None], "hub": [None], "links": [0], "pack": [packed.getvalue()]})
        out = pd.concat([out, block], ignore_index=True) if len(out) else block
        return out.assign(root=frame["root"].iloc[0], block=frame["block"].iloc[0])
    return run


def cross_verifier(threshold: float):
    """Links between the texts of two blocks of a component."""
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for packed in zip(frame["left"], frame["right"]):
                a, b = (np.load(io.BytesIO(p)) for p in packed)
                sets = [s for x in (a, b) for s in np.split(x["differ"], x["ends"][:-1])]
                n = len(a["sizes"])
                overlap = common_counts(sets, n) + (
                    int(a["first"]) - a["removed"][:, None] - b["removed"][None, :])
                links = np.zeros((len(sets), len(sets)), dtype=bool)
                links[:n, n:] = links_of(overlap, a["sizes"], b["sizes"], threshold)
                links |= links.T
                digests = np.array([d.tobytes() for x in (a, b) for d in x["digests"]], dtype=object)
                yield link_rows(links, digests, np.concatenate([a["copies"], b["copies"]]))
    return verify


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per distinct text: ``digest, class_id, class_key, n_links``.

    ``class_id`` is the class's least document id and ``class_key`` the row
    key of that document; ``n_links`` counts the documents other than
    itself that a document with this text links to.
    """
    bands, rows = choose_bands(threshold, recall)
    keyed = docs.filter(F.col(text).isNotNull()).select(
        _digest(text).alias("digest"), F.unhex(row_key(doc_id, text)).alias("key"),
        F.col(doc_id).alias("id"), F.col(text).alias("text"))
    signed = (keyed.select("digest", "key", "text")
              .mapInPandas(signer(bands, rows), "digest binary, key binary, bands array<bigint>"))
    # One signature per text, with the row its text is read from later.
    signed = written(signed.groupBy("digest").agg(F.min(F.struct("key", "bands")).alias("s"))
                     .select("digest", "s.key", "s.bands"), "ngram-signatures")
    texts = keyed.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"),
        F.first(F.octet_length("text")).alias("bytes"))
    texts = written(texts, "ngram-texts")

    buckets = signed.select("digest", F.explode("bands").alias("bucket"))
    leaders = (buckets.groupBy("bucket").agg(F.min("digest").alias("leader"),
                                             F.max("digest").alias("other"))
               .filter(F.col("leader") != F.col("other")).select("bucket", "leader"))
    ties = (buckets.join(leaders, "bucket").filter(F.col("digest") != F.col("leader"))
            .select(F.col("digest").alias("u"), F.col("leader").alias("v")).distinct())
    tied = components(ties, "ngram-candidates")
    members = tied.unionByName(tied.select(F.col("root").alias("u"), "root").distinct()).select(
        F.col("u").alias("digest"), "root")
    members = members.join(texts.select("digest", "copies", "bytes"), "digest").join(
        signed.select("digest", "key"), "digest")
    lengths = texts.select(F.col("digest").alias("root"), F.col("bytes").alias("first_bytes"))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total")).join(
        lengths, "root")
    # A difference is at most as long as both texts.
    held = F.col("total") + F.col("n") * F.col("first_bytes")
    blocks = F.when((F.col("n") <= BLOCK_TEXTS) & (F.col("total") <= BLOCK_BYTES), 1).otherwise(
        F.greatest(F.lit(2), F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(held / (4 * BLOCK_BYTES))))
    sizes = written(sizes.select("root", "n", "total", blocks.cast("int").alias("blocks")), "ngram-sizes")
    small = sizes.filter("blocks = 1").agg(F.sum("total"), F.sum("n")).first()
    packs = max(1, math.ceil((small[0] or 0) / BLOCK_BYTES), math.ceil((small[1] or 0) / BLOCK_TEXTS))
    placed = written(members.join(sizes.select("root", "blocks"), "root")
                     .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
                     .select("digest", "key", "copies", "root", "blocks", "block"), "ngram-tasks")
    # Of the texts only those with candidates are needed, each read twice at most.
    keys = placed.select("key").distinct()
    source = written(keyed.select("key", "text").join(F.broadcast(keys) if fits_broadcast(keys) else keys, "key"),
                     "ngram-needed")
    wanted = placed.filter("blocks = 1").select(
        "key", "digest", "copies", "root", F.pmod(F.xxhash64("root"), F.lit(packs)).alias("task"))
    checked = (wanted.join(source, "key").groupBy("task")
               .applyInPandas(verifier(threshold), "digest binary, hub binary, links bigint"))
    large = placed.filter("blocks > 1")
    if not large.isEmpty():
        first = large.filter(F.col("digest") == F.col("root")).select(
            "key", "digest", "copies", "root", "blocks",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("first"))
        of_blocks = large.withColumn("first", F.lit(False)).unionByName(first)
        within = written(of_blocks.join(source, "key").groupBy("root", "block").applyInPandas(
            differences(threshold), "digest binary, hub binary, links bigint, pack binary, root binary, block int"),
            "ngram-blocks")
        packed = within.filter(F.col("pack").isNotNull()).join(sizes.select("root", "blocks"), "root")
        # A row for each pair of blocks that a block is in.
        later = packed.filter(F.col("block") < F.col("blocks") - 1).select(
            "root", F.col("block").alias("a"), F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("b"),
            F.col("pack").alias("left"))
        earlier = packed.filter(F.col("block") > 0).select(
            "root", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("a"), F.col("block").alias("b"),
            F.col("pack").alias("right"))
        across = later.join(earlier, ["root", "a", "b"]).select("left", "right").mapInPandas(
            cross_verifier(threshold), "digest binary, hub binary, links bigint")
        checked = checked.unionByName(within.filter(F.col("pack").isNull()).select("digest", "hub", "links")) \
            .unionByName(across)
    checked = written(checked, "ngram-links")
    counts = checked.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("digest").alias("u"), F.col("hub").alias("v")),
                       "ngram-classes").select(F.col("u").alias("digest"), F.col("root").alias("class"))
    named = (texts.join(roots, "digest", "left").join(counts, "digest", "left")
             .withColumn("class", F.coalesce("class", "digest")))
    named = written(named.select("digest", "class", "copies", "first",
                                 (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
                    "ngram-named")
    ids = named.groupBy("class").agg(F.min("first").alias("least"))
    return named.join(ids, "class").select(
        "digest", F.col("least.id").alias("class_id"), F.col("least.key").alias("class_key"), "n_links")


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(doc_id, class_id, n_links)``, one row per document."""
    found = written(classes(docs, doc_id, text, threshold, recall), "ngram-result")
    rows = docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest"))
    joined = rows.join(found.select("digest", "class_id", "n_links",
                                    F.lit(True).alias("known")), "digest", "left")
    return joined.select("doc_id", F.when(F.col("known"), F.col("class_id")).otherwise(F.col("doc_id"))
                         .alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Rows with a null text all stay, but repeated ones once.
    """
    key = unused(docs, "__key")
    keepers = (classes(docs, doc_id, text, threshold, recall)
               .select(F.col("class_key").alias(key)).distinct())
    nulls = docs.filter(F.col(text).isNull()).select(
        F.unhex(row_key(doc_id, text)).alias(key)).distinct()
    keep = written(keepers.unionByName(nulls), "ngram-kept")
    rows = docs.withColumn(key, F.unhex(row_key(doc_id, text))).join(keep, key)
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    ordered = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)])
    return rows.groupBy(key).agg(F.min_by(every, ordered).alias("row")).select("row.*")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return link_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
