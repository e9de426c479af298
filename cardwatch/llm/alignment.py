"""Cross-tokenizer alignment: external spill counting of overlapping token pairs.

Tokenizers A (byte-level pairs) and B (pieces with byte fallback) both cut
``" " + text`` into runs of bytes.  Offsets where tokens of both end cut
the text into groups.  Every stretch between two neighbouring ends of either
side lies in one A token and one B token, and each overlapping pair of
occurrences has exactly one such stretch, so links are found by merging the
two lists of ends.  An id pair's count is the number of documents that
hold it linked.

1. Tasks tokenise slices of documents (a slice is a bounded number of
   characters or a single text) once, and write the pair-document records of
   a slice in order of pair and document, dealt by radix (the A id modulo
   ``RADIX``) into runs of zstd frames: pairs with their numbers of documents
   in one list of frames, documents with their links in another.
2. The runs of a radix are merged by a heap on their next pair, which adds up
   the documents per pair; at most about ``FAN`` runs meet in a task, and
   further passes merge what came out.  Only pairs travel here, so a
   frequent A id costs a slice one entry per B id, whatever its documents.
3. The last pass sees all pairs of an A id next to each other (A-major
   order), so it marks those with the A id's highest count as it goes.
4. Runs meet the counts of their radix again, ``FAN`` slices a task, and
   stream back what each document's links add up to; a slice adds up what
   comes from its radixes.

Everything between the steps is written to the shared folder.

Edge cases: null and empty texts, and texts whose tokens of either side do
not join up to ``" " + text`` (such as those with U+2581, which B reads as
a space), have no tokens: zeros and an empty digest.  Special tokens' strings
inside a text are plain text.  Very long texts are tokenised in pieces that
end before a single space between a visible character and an ASCII letter,
where no token of either side can cross.  Pairs that tie for the highest
count are all best.  Rows that repeat an id or a text are documents of their
own.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, ArrayType, BinaryType

from .common import read, slices, written

RADIX = 32
# Runs that a task merges, and slices whose documents a task serves.
FAN = 64
# Pairs or records of a frame, and characters of a slice and of a piece of a long text.
FRAME = 1 << 16
CHARS = 1_000_000

# Public tokenizer files; how A's files write bytes as characters, B's word start and bytes.
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
WORD_START = "▁"

# A's pre-tokens, which its file names only by kind.
A_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_CUT = re.compile(r"(?<=[^\s▁]) (?=[A-Za-z])")
# The faster encoder of A cannot match runs of white space that are much longer than this.
_LONG_SPACE = re.compile(r"\s{500}")


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (none negative) as one zstd frame, each in its least width."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = np.asarray(a)
        top = int(a.max()) if len(a) else 0
        width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
        head += [width, len(a)]
        body.append(a.astype(f"<u{width}").tobytes())
    return zstandard.ZstdCompressor(level=3).compress(np.array(head, dtype="<u8").tobytes() + b"".join(body))


def unpack(frame: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    count = int(np.frombuffer(data, "<u8", 1)[0])
    head = np.frombuffer(data, "<u8", 1 + 2 * count).tolist()[1:]
    out, at = [], 8 * (1 + 2 * count)
    for width, n in zip(head[::2], head[1::2]):
        out.append(np.frombuffer(data, f"<u{width}", n, at).astype(np.int64))
        at += width * n
    return out


def steps(sorted_keys: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the first key in front."""
    return np.diff(sorted_keys, prepend=0)


class Sides:
    """Both tokenizers, the bytes of their tokens, and the pieces of digest texts."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # A's files write a byte that is no visible Latin-1 character as the next one from U+0100 on.
        hidden = [b for b in range(256) if b not in set(PLAIN_BYTES)]
        byte_of = {chr(b): b for b in PLAIN_BYTES} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = (bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token)
                               else token.encode())
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(WORD_START, " ").encode()
                        for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        # The same vocabulary and merges in an encoder four times as fast.
        with open(a_path, encoding="utf-8") as file:
            merged = json.load(file)["model"]["vocab"]
        self.a_fast = tiktoken.Encoding("a", pat_str=A_PATTERN, special_tokens={},
                                        mergeable_ranks={self.a_bytes[i]: i for i in merged.values()})
        self.a_len = np.array([len(t) for t in self.a_bytes])
        self.b_len = np.array([len(t) for t in self.b_bytes])
        # A token of a digest text, with "," or what ends its side of the group.
        self.spelled = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"]
        self.spelled += [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]

    def encode_a(self, text: str) -> list[int]:
        if _LONG_SPACE.search(text):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.a_fast.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of each text; long texts piece by piece."""
        pieces, owner = [], []
        for i, text in enumerate(texts):
            a = 0
            while len(text) - a > CHARS and (cut := _CUT.search(text, a + CHARS)):
                pieces.append(text[a:cut.start()])
                owner.append(i)
                a = cut.start() + 1
            pieces.append(text[a:])
            owner.append(i)
        left: list[list[int]] = [[] for _ in texts]
        right: list[list[int]] = [[] for _ in texts]
        # Pieces behind a cut have lost their space, which both sides put in front anyway.
        for start, end in slices(pieces, CHARS):
            for i, piece in zip(owner[start:end], pieces[start:end]):
                left[i] += self.encode_a(" " + piece)
            for i, ids in zip(owner[start:end], self.b.encode(pieces[start:end], num_threads=1)):
                right[i] += ids
        return left, right


class Aligned:
    """The tokens, groups and links of a slice of texts, as arrays over the slice."""

    def __init__(self, sides: Sides, texts: list[str | None]) -> None:
        asked = [i for i, t in enumerate(texts) if t]
        left, right = sides.encode([texts[i] for i in asked])
        n = len(texts)
        kept = []
        for at, i in enumerate(asked):
            want = b" " + texts[i].encode("utf-8", "surrogatepass")
            if (b"".join(map(sides.a_bytes.__getitem__, left[at])) == want
                    and b"".join(map(sides.b_bytes.__getitem__, right[at])) == want):
                kept.append(at)
        docs = np.array([asked[at] for at in kept], dtype=np.int64)
        self.n_a, self.n_b = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        self.n_a[docs] = [len(left[at]) for at in kept]
        self.n_b[docs] = [len(right[at]) for at in kept]
        none = np.empty(0, dtype=np.int64)
        a = np.concatenate([none, *(np.array(left[at], dtype=np.int64) for at in kept)])
        b = np.concatenate([none, *(np.array(right[at], dtype=np.int64) for at in kept)])
        del left, right
        # Texts follow each other as if they were one: both sides end where a text ends.
        a_end, b_end = np.cumsum(sides.a_len[a]), np.cumsum(sides.b_len[b])
        ends = np.union1d(a_end, b_end)
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        doc_end = a_end[np.cumsum(self.n_a[docs]) - 1] if len(docs) else none
        self.doc = docs[np.searchsorted(doc_end, ends)] if len(docs) else none
        self.a = a[np.searchsorted(a_end, ends)]
        self.b = b[np.searchsorted(b_end, ends)]
        self.n_links = np.bincount(self.doc, minlength=n)
        self.n_groups = np.bincount(docs[np.searchsorted(doc_end, common)], minlength=n) if len(docs) else self.n_links
        # Where each token stands in the digest text: by group, A before B.
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        place_a = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        place_b = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
        text = np.empty(len(a) + len(b), dtype=np.int64)
        text[place_a] = 2 * a + (common[a_group] == a_end)
        text[place_b] = 2 * len(sides.a_bytes) + 2 * b + (common[b_group] == b_end)
        self.digests = [""] * n
        at = 0
        for i, size in zip(docs.tolist(), (self.n_a + self.n_b)[docs].tolist()):
            spelled = "".join(map(sides.spelled.__getitem__, text[at:at + size].tolist()))
            self.digests[i] = hashlib.sha256(spelled[:-1].encode()).hexdigest()
            at += size

    def runs(self, b_size: int, radix: int) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
        """(radix, frames of pairs, frames of documents) of the slice's pair-document records."""
        width = max(1, len(self.n_a))
        keys, links = np.unique((self.a * b_size + self.b) * width + self.doc, return_counts=True)
        pairs, docs = keys // width, keys % width
        of = pairs // b_size % radix
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(radix + 1))
        for r in range(radix):
            mine = order[bounds[r]:bounds[r + 1]]
            if not len(mine):
                continue
            starts = np.flatnonzero(np.r_[True, pairs[mine][1:] != pairs[mine][:-1]])
            held = np.diff(np.r_[starts, len(mine)])
            pair_frames, doc_frames = [], []
            for a in range(0, len(starts), FRAME):
                first = mine[starts[a:a + FRAME]]
                whole = mine[starts[a]:starts[a + FRAME] if a + FRAME < len(starts) else len(mine)]
                pair_frames.append(pack(steps(pairs[first]), held[a:a + FRAME]))
                doc_frames.append(pack(docs[whole], links[whole]))
            yield r, pair_frames, doc_frames


RUN_SCHEMA = "slice string, radix int, pairs array<binary>, docs array<binary>"
DOC_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def tokenised(docs: DataFrame, doc_id: str, text: str, a_path: str, b_path: str, radix: int) -> DataFrame:
    """The runs (rows with a radix) and the documents (rows without one) of all slices."""
    both = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([
        StructField("slice", StringType()), StructField("radix", IntegerType()),
        StructField("pairs", ArrayType(BinaryType())), StructField("docs", ArrayType(BinaryType())),
        StructField("place", LongType()), both.schema["doc_id"],
        *(StructField(c, LongType()) for c in DOC_FIELDS), StructField("groups_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, number = None, 0
        frames = pa.list_(pa.binary())
        for batch in batches:
            sides = sides or Sides(a_path, b_path)
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in slices(texts, CHARS):
                found = Aligned(sides, texts[start:end])
                name, n = f"{TaskContext.get().partitionId()}-{number}", end - start
                number += 1
                empty = pa.nulls(n, frames)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.nulls(n, pa.int32()), empty, empty, pa.array(np.arange(n)),
                     ids.slice(start, n), *(pa.array(getattr(found, c)) for c in DOC_FIELDS),
                     pa.array(found.digests)], names=schema.names)
                for r, pairs, held in found.runs(len(sides.b_bytes), radix):
                    blank = [pa.nulls(1, t) for t in (pa.int64(), ids.type, *[pa.int64()] * len(DOC_FIELDS), pa.string())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([r], pa.int32()), pa.array([pairs], frames),
                         pa.array([held], frames), *blank], names=schema.names)
    return both.mapInArrow(run, schema)


def merge(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (pairs, documents) of all runs, chunk by chunk; one frame of each run is open at a time.

    The heap holds each run's next pair.  A chunk reaches up to the least last
    pair of the open frames, so every run's share of it is at hand.
    """
    frames = [iter(run) for run in runs]
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        frame = next(frames[i], None)
        if frame is None:
            opened.pop(i, None)
            return
        pairs, documents = unpack(frame)[:2]
        opened[i] = np.cumsum(pairs), documents
        heapq.heappush(heap, (int(opened[i][0][0]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        bound = min(int(pairs[-1]) for pairs, _ in opened.values())
        keys, counts = [], []
        while heap and heap[0][0] <= bound:
            _, i = heapq.heappop(heap)
            pairs, documents = opened[i]
            cut = int(np.searchsorted(pairs, bound, side="right"))
            keys.append(pairs[:cut])
            counts.append(documents[:cut])
            if cut == len(pairs):
                advance(i)
            else:
                opened[i] = pairs[cut:], documents[cut:]
                heapq.heappush(heap, (int(pairs[cut]), i))
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), dtype=np.int64)
        np.add.at(total, at, np.concatenate(counts))
        yield found, total


def _framed(pairs: np.ndarray, *columns: np.ndarray) -> Iterator[bytes]:
    for a in range(0, len(pairs), FRAME):
        yield pack(steps(pairs[a:a + FRAME]), *(c[a:a + FRAME] for c in columns))


def merger(b_size: int | None):
    """Merges the runs of a task; the last pass (``b_size`` given) also marks the best pairs of each A id."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out, held = [], (np.empty(0, dtype=np.int64),) * 2
        for pairs, counts in merge(list(frame["pairs"])):
            if b_size is None:
                out += _framed(pairs, counts)
                continue
            # The last A id may go on in the next chunk.
            pairs, counts = np.concatenate([held[0], pairs]), np.concatenate([held[1], counts])
            last = int(np.searchsorted(pairs, pairs[-1] // b_size * b_size))
            held = pairs[last:], counts[last:]
            out += _framed(pairs[:last], counts[:last], best_of(pairs[:last] // b_size, counts[:last]))
        if len(held[0]):
            out += _framed(*held, best_of(held[0] // b_size, held[1]))
        return pd.DataFrame({"radix": frame["radix"].iloc[:1], "slice": frame["slice"].iloc[:1], "pairs": [out]})
    return run


def best_of(a: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a count is the highest of its A id; equal ids are neighbours."""
    if not len(a):
        return a
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    highest = np.maximum.reduceat(counts, starts)
    return (counts == np.repeat(highest, np.diff(np.r_[starts, len(a)]))).astype(np.int64)


def counted(runs: DataFrame, n_slices: int, b_size: int, fan: int = FAN) -> DataFrame:
    """``(radix, pairs)``: all pairs of a radix with their documents and whether they are best."""
    left = runs.select("radix", "slice", "pairs")
    while n_slices > fan:
        n_slices = math.ceil(n_slices / fan)
        dealt = left.withColumn("slice", F.pmod(F.xxhash64("slice"), F.lit(n_slices)).cast("string"))
        left = written(dealt.groupBy("radix", "slice").applyInPandas(
            merger(None), "radix int, slice string, pairs array<binary>"), "alignment-merged")
    return left.groupBy("radix").applyInPandas(
        merger(b_size), "radix int, slice string, pairs array<binary>").select("radix", "pairs")


def _contributions(runs: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    """Per slice of a task: frames of (document, links that are best, counts over links)."""
    none = np.empty(0, dtype=np.int64)
    parts = [unpack(f) for frames in table["pairs"] for f in frames]
    known = np.concatenate([none, *(np.cumsum(p[0]) for p in parts)])
    counts = np.concatenate([none, *(p[1] for p in parts)])
    best = np.concatenate([none, *(p[2] for p in parts)])
    del parts
    out = []
    for pair_frames, doc_frames in zip(runs["pairs"], runs["docs"]):
        sums = []
        for pair_frame, doc_frame in zip(pair_frames, doc_frames):
            pairs, held = unpack(pair_frame)
            docs, links = unpack(doc_frame)
            at = np.repeat(np.searchsorted(known, np.cumsum(pairs)), held)
            sums.append(added_up(docs, links * best[at], links * counts[at]))
        sums = added_up(*(np.concatenate(c) for c in zip(*sums)))
        out.append([pack(*sums)])
    return pd.DataFrame({"slice": runs["slice"].astype(object), "sums": pd.Series(out, index=runs.index, dtype=object)})


def added_up(docs: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct documents and the sums of each column."""
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[starts], *(np.add.reduceat(c[order], starts) for c in columns)


def _finished(docs: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    best, total = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
    docs = docs.sort_values("place")
    for frames in sums["sums"]:
        for frame in frames:
            place, b, c = unpack(frame)
            best[place] += b
            total[place] += c
    return pd.DataFrame({"slice": docs["slice"], "place": docs["place"], "n_best": best, "count_sum": total})


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    sides = Sides(a_path, b_path)
    return len(sides.a_bytes), len(sides.b_bytes)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None,
          b_path: str | None = None, radix: int = RADIX, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per radix of the pair counts).

    The paths name the tokenizer files, at the same place on every machine.
    """
    a_path, b_path = a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)
    _, b_size = vocabulary_sizes(a_path, b_path)
    cut = written(tokenised(docs, doc_id, text, a_path, b_path, radix), "alignment-runs")
    runs = cut.filter(F.col("radix").isNotNull()).select("slice", "radix", "pairs", "docs")
    base = cut.filter(F.col("radix").isNull()).drop("radix", "pairs", "docs")
    n_slices = base.select("slice").distinct().count()
    table = written(counted(runs, n_slices, b_size, fan), "alignment-counts")
    shares = max(1, math.ceil(n_slices / fan))
    dealt = runs.withColumn("share", F.pmod(F.xxhash64("slice"), F.lit(shares)).cast("int"))
    repeated = table.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    sums = written(dealt.groupBy("radix", "share").cogroup(repeated.groupBy("radix", "share"))
                   .applyInPandas(_contributions, "slice string, sums array<binary>"), "alignment-sums")
    totals = (base.select("slice", "place").groupBy("slice").cogroup(sums.groupBy("slice"))
              .applyInPandas(_finished, "slice string, place long, n_best long, count_sum long"))
    rows = base.join(written(totals, "alignment-totals"), ["slice", "place"]).select(
        "doc_id", *DOC_FIELDS, "n_best", "count_sum", "groups_sha256")
    return rows, table


def pair_counts(table: DataFrame, b_size: int) -> DataFrame:
    """``(a_id, b_id, documents, best)``, one row per linked id pair."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for packed in frame["pairs"]:
                for part in packed:
                    pairs, counts, best = unpack(part)
                    pairs = np.cumsum(pairs)
                    yield pd.DataFrame({"a_id": pairs // b_size, "b_id": pairs % b_size, "documents": counts,
                                        "best": best.astype(bool)})
    return table.select("pairs").mapInPandas(run, "a_id long, b_id long, documents long, best boolean")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups, links and corpus-wide counts of the links of every document."""
    return align(read(spark, sf_dir, "documents").select("doc_id", "text"))[0]
