"""Benchmark decontamination: BM25 retrieval of test items for every training passage.

The test items are the indexed side.  Each training document is cut into
overlapping passages and each passage is a query.  Items longer than most
of a passage are indexed in pieces.  A piece's score is its BM25 score for
the passage's distinct words as a share of its score for its own words, so
one threshold fits short and long ones.  Retrieval is exact block-max
WAND: all pieces at or above the threshold are found.
Before the walk, the same block maxima are summed for a whole batch of
passages at once; passages without a block that can reach the threshold
need no walk.

Retrieved pairs are verified on the whole document.  An item's answer is
its last sentence or line (of one-sentence items the last quarter), the
question is what precedes it; both need the given share of their n-grams
in the document.

The index of a chunk of items (``ITEMS_PER_INDEX`` and ``BYTES_PER_INDEX`` at
most on average) is built on the driver and sent to the tasks; a larger
benchmark is handled chunk by chunk, each against all documents.  Word and
length statistics are those of all items, so scores do not depend on the
number of chunks.

Edge cases: null or wordless texts give no passage; items without words
are never found; equal items are each reported; a null item id is
reported as null.  Rows that repeat a document are each searched.  Empty
tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, row_key, slices, unused, written

# Words of a passage, and from one passage to the next.
PASSAGE = 64
STRIDE = 32
# Longer items are indexed in even pieces of at most so many words, so that
# five sixths of a piece at least lie within one passage.
PIECE = 48
# Least share of a piece's own score to be retrieved.
THRESHOLD = 0.6
# Verification: n-gram length and least shares.
NGRAM = 5
QUESTION_SHARE = 0.6
ANSWER_SHARE = 0.5
# Usual BM25 constants; postings per block of the index.
K1, B = 1.2, 0.75
BLOCK = 8
# Items and bytes of text of an index, which the driver builds.
ITEMS_PER_INDEX = 20_000
BYTES_PER_INDEX = 16 * 1024 * 1024
# Characters of text worked on at a time.
CHARS = 500_000

_WORDS = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, _SENTENCE_END.split(text)) if w]
    if len(parts) > 1:
        return [x for p in parts[:-1] for x in p], parts[-1]
    every = parts[0] if parts else []
    cut = len(every) - max(1, len(every) // 4)
    return every[:cut], every[cut:]


def ngrams(tokens: list[str], n: int = NGRAM) -> set[tuple[str, ...]]:
    n = min(n, len(tokens))
    return set(zip(*[tokens[i:] for i in range(n)])) if n else set()


def share_found(part: list[str], found: dict[int, set]) -> float:
    """Share of a part's n-grams in the document's n-grams of that length (1 for an empty part)."""
    grams = ngrams(part)
    if not grams:
        return 1.0
    return len(grams & found[len(next(iter(grams)))]) / len(grams)


def pieces(tokens: list[str], size: int = PIECE) -> list[list[str]]:
    n = -(-len(tokens) // size)
    return [tokens[k * len(tokens) // n:(k + 1) * len(tokens) // n] for k in range(n)]


@dataclass(frozen=True)
class Statistics:
    """Of all items, whatever chunk they are in: pieces, words, and pieces that hold a word."""

    pieces: int
    words: int
    holding: dict[str, int]


class Index:
    """Postings of a chunk of items, by word, in blocks with their largest impact.

    ``statistics`` are those of all chunks (at least for this one's words);
    without them the items are taken to be all.
    """

    def __init__(self, items: list[tuple[int | None, str]], statistics: Statistics | None = None):
        docs = [((item, number), piece, question_and_answer(text))
                for number, (item, text) in enumerate(items) for piece in pieces(words_of(text))]
        counts = [Counter(w) for _, w, _ in docs]
        df = Counter(w for c in counts for w in c)
        every = statistics or Statistics(len(docs), sum(len(w) for _, w, _ in docs), df)
        mean = every.words / max(1, every.pieces)
        idf = {w: math.log(1 + (every.pieces - every.holding[w] + 0.5) / (every.holding[w] + 0.5)) for w in df}
        scored = []
        for (item, words, parts), c in zip(docs, counts):
            norm = K1 * (1 - B + B * len(words) / mean)
            impact = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in c.items()}
            own = sum(impact.values())
            scored.append((item, parts, {w: x / own for w, x in impact.items()}))
        # Items with like weights side by side, so that a block's maxima are tight.
        scored.sort(key=lambda x: (max(x[2].values()), str(x[0])))
        self.items = [(item, parts) for item, parts, _ in scored]
        self.terms = {w: k for k, w in enumerate(sorted(df))}
        self.n_blocks = -(-len(scored) // BLOCK)
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for k, (_, _, impact) in enumerate(scored):
            for w, x in impact.items():
                postings[self.terms[w]].append((k, x))
        self.docs = [[k for k, _ in p] for p in postings]
        self.impacts = [[x for _, x in p] for p in postings]
        self.top = [max(x) for x in self.impacts]
        self.block_top: list[dict[int, float]] = []
        rows, blocks, tops = [], [], []
        for t, p in enumerate(postings):
            best: dict[int, float] = {}
            for k, x in p:
                best[k // BLOCK] = max(best.get(k // BLOCK, 0.0), x)
            self.block_top.append(best)
            rows += [t] * len(best)
            blocks += best.keys()
            tops += best.values()
        # The block maxima again as a table in rows of terms, for batches of passages.
        self.starts = np.searchsorted(np.array(rows, dtype=np.int64), np.arange(len(self.terms) + 1))
        self.blocks = np.array(blocks, dtype=np.int64)
        self.tops = np.array(tops, dtype=np.float64)

    def may_reach(self, query: np.ndarray, passage: np.ndarray, n: int, least: float) -> np.ndarray:
        """Which of ``n`` passages have a block whose maxima add up to ``least``.

        ``query`` and ``passage`` are the distinct (term, passage) pairs.
        """
        out = np.zeros(n, dtype=bool)
        top = np.array(self.top)
        total = np.bincount(passage, weights=top[query], minlength=n)
        keep = total[passage] >= least           # the plain WAND bound first
        query, passage = query[keep], passage[keep]
        step = max(1, 4_000_000 // max(1, self.n_blocks))
        order = np.argsort(passage, kind="stable")
        query, passage = query[order], passage[order]
        for p0 in range(0, n, step):
            a, b = np.searchsorted(passage, [p0, p0 + step])
            q = query[a:b]
            lengths = self.starts[q + 1] - self.starts[q]
            if not lengths.sum():
                continue
            at = np.repeat(self.starts[q] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            at += np.arange(lengths.sum())
            cell = np.repeat(passage[a:b] - p0, lengths) * self.n_blocks + self.blocks[at]
            bound = np.bincount(cell, weights=self.tops[at], minlength=step * self.n_blocks)
            hit = np.unique(np.flatnonzero(bound >= least) // self.n_blocks) + p0
            out[hit[hit < n]] = True
        return out

    def search(self, query: list[int], least: float) -> list[tuple[int, float]]:
        """All items scoring at least ``least``, by block-max WAND."""
        cursors = [[self.docs[t][0], 0, t] for t in query]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                bound += self.top[t]
                if bound >= least:
                    pivot = cursors[i][0]
                    last = i
                    break
            if pivot < 0:
                break
            while last + 1 < len(cursors) and cursors[last + 1][0] == pivot:
                last += 1
            block = pivot // BLOCK
            if sum(self.block_top[t].get(block, 0.0) for _, _, t in cursors[:last + 1]) >= least:
                if cursors[0][0] == pivot:
                    score = sum(self.impacts[t][at] for _, at, t in cursors[:last + 1])
                    if score >= least:
                        found.append((pivot, score))
                    target = pivot + 1
                else:
                    target = pivot
            else:                     # nothing in this block, nor before the next list starts
                target = (block + 1) * BLOCK
                if last + 1 < len(cursors):
                    target = min(target, cursors[last + 1][0])
                target = max(target, pivot + 1)
            for c in cursors[:last + 1]:
                docs, at = self.docs[c[2]], c[1]
                while at < len(docs) and docs[at] < target:
                    at += 1
                c[0], c[1] = (docs[at] if at < len(docs) else -1), at
            cursors = [c for c in cursors if c[0] >= 0]
        return found


SCHEMA = "key string, item_id long, score double, question_share double, answer_share double"


COLUMNS = ["key", "item_id", "score", "question_share", "answer_share"]


def retrieve(texts: list[str | None], index: Index, least: float) -> dict[int, dict[int, float]]:
    """For each text, the pieces that one of its passages retrieves, with the best score."""
    get, n_terms = index.terms.get, len(index.terms)
    # Distinct (passage, term) pairs; passages are numbered through.
    pairs, firsts, owner, passages = [], [], [], 0
    for d, text in enumerate(texts):
        words = words_of(text)
        if not words or not n_terms:
            continue
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        n = max(1, -(-(len(ids) - (PASSAGE - STRIDE)) // STRIDE))
        at = np.flatnonzero(ids >= 0)
        for back in range(-(-PASSAGE // STRIDE)):
            p = at // STRIDE - back
            ok = (p >= 0) & (p < n) & (at - p * STRIDE < PASSAGE)
            pairs.append((passages + p[ok]) * n_terms + ids[at[ok]])
        firsts.append(passages)
        owner.append(d)
        passages += n
    hits: dict[int, dict[int, float]] = {}
    if not pairs:
        return hits
    pair = np.unique(np.concatenate(pairs))
    passage, term = pair // n_terms, pair % n_terms
    for p in np.flatnonzero(index.may_reach(term, passage, passages, least)):
        a, b = np.searchsorted(passage, [p, p + 1])
        for piece, score in index.search(term[a:b].tolist(), least):
            best = hits.setdefault(owner[int(np.searchsorted(firsts, p, side="right")) - 1], {})
            best[piece] = max(best.get(piece, 0.0), score)
    return hits


def search_texts(keys, texts, index: Index, least: float, question: float, answer: float) -> list[tuple]:
    """Verified pairs of some texts, in the order of ``COLUMNS``."""
    out = []
    for d, retrieved in retrieve(texts, index, least).items():
        tokens = words_of(texts[d])
        found = {n: ngrams(tokens, n) if n <= len(tokens) else set() for n in range(1, NGRAM + 1)}
        best_of: dict[tuple, tuple] = {}              # an item's best piece
        for k, score in retrieved.items():
            item, parts = index.items[k]
            best_of[item] = (max(score, best_of.get(item, (0.0,))[0]), parts)
        for (item, _), (score, (q, a)) in sorted(best_of.items(), key=lambda x: x[0][1]):
            shares = share_found(q, found), share_found(a, found)
            if shares[0] >= question and shares[1] >= answer:
                out.append((keys[d], item, score, *shares))
    return out


def searcher(index: Index, least: float, question: float, answer: float):
    def search_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, texts = frame["key"].to_numpy(), frame["text"].to_numpy()
            for a, b in slices(texts, CHARS):
                out = search_texts(keys[a:b], texts[a:b], index, least, question, answer)
                if out:
                    yield pd.DataFrame(out, columns=COLUMNS).astype({"item_id": "Int64"})
    return search_batches


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 least: float = THRESHOLD, question: float = QUESTION_SHARE,
                 answer: float = ANSWER_SHARE) -> DataFrame:
    """``(key, item_id, score, question_share, answer_share)`` of all verified pairs.

    ``key`` is the row key of the document; ``items`` has ``item_id`` and
    ``text``.
    """
    spark = docs.sparkSession
    keyed = docs.select(row_key(doc_id, text).alias("key"), F.col(text).alias("text")) \
        if doc_id else docs
    items = items.select("item_id", "text").filter(F.col("text").isNotNull())
    size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_chunks = max(1, math.ceil(size[0] / ITEMS_PER_INDEX), math.ceil((size[1] or 0) / BYTES_PER_INDEX))
    items = items.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_chunks)))
    every = statistics_of(items) if n_chunks > 1 else None
    out = spark.createDataFrame([], SCHEMA)
    for k in range(n_chunks):
        chunk = items.filter(F.col("chunk") == k).select("item_id", "text").orderBy("item_id", "text")
        index = Index([tuple(r) for r in chunk.collect()], every and every(k))
        found = keyed.mapInPandas(searcher(index, least, question, answer), SCHEMA)
        # One index a plan.
        out = out.unionByName(written(found, "contaminated-chunk") if n_chunks > 1 else found)
    return out


def statistics_of(items: DataFrame) -> Callable[[int], Statistics]:
    """The statistics of all items, for the words of a chunk; counted in tasks."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(chunk, word, 1, 0) for chunk, text in zip(frame["chunk"], frame["text"])
                    for piece in pieces(words_of(text)) for word in set(piece)]
            # The row without a word counts pieces and their words.
            rows += [(chunk, None, 1, len(piece)) for chunk, text in zip(frame["chunk"], frame["text"])
                     for piece in pieces(words_of(text))]
            if rows:
                yield pd.DataFrame(rows, columns=["chunk", "word", "n", "words"])

    counts = written(items.select("chunk", "text").mapInPandas(count, "chunk long, word string, n long, words long")
                     .groupBy("chunk", "word").agg(F.sum("n").alias("n"), F.sum("words").alias("words")),
                     "contaminated-words")
    total = counts.filter(F.col("word").isNull()).agg(F.sum("n"), F.sum("words")).first()
    holding = counts.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))

    def of(chunk: int) -> Statistics:
        words = counts.filter((F.col("chunk") == chunk) & F.col("word").isNotNull()).select("word")
        return Statistics(total[0] or 0, total[1] or 0,
                          {r["word"]: r["n"] for r in holding.join(words, "word", "left_semi").collect()})
    return of


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    key = unused(docs, "__key")
    found = written(contaminated(docs, items, doc_id, text).select("key").distinct(),
                    "contaminated").withColumnRenamed("key", key)
    return docs.withColumn(key, row_key(doc_id, text)).join(found, key, "left_anti").drop(key)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the test items they hold, for every document."""
    docs = read(spark, sf_dir, "documents").select(
        F.concat_ws("", F.col("doc_id").cast("string")).alias("key"), "text")
    pairs = contaminated(docs, read(spark, sf_dir, "benchmark"), doc_id="")
    return pairs.select(F.expr("try_cast(key as bigint)").alias("doc_id"), "item_id", "score",
                        "question_share", "answer_share")
