"""Class-based n-gram scoring (Brown classes found by exchange clustering).

Every word of the training documents has one of ``CLASSES`` classes, the
end of a text one of its own.  The probability of a word after another is

    MIX * P(class | previous class) * P(word | class) + (1 - MIX) * P(word)

with smoothed counts from all training documents; the text's probability
is the product over its words and its end.  The base score uses the last
term alone.

1. Texts are cut into blocks, as they come, of a bounded number of tokens.
   A block is one row: its distinct tokens (64-bit hashes), in order, with
   training counts, and its documents as numbers in that list.
2. The hashes fall into ranges of about ``RANGE_ENTRIES`` (block, token)
   entries.  A block sends each range one row with its part of the list;
   where the rows of a range meet, its words are numbered and their counts
   summed, and every block gets both back.  All that follows travels as
   such rows of packed arrays, one per block and range, never per token.
3. A start: pairs of neighbouring words are counted by state (one of the
   ``FREQUENT`` most frequent words, word ending, end), a table whose size
   depends on parameters only, and the driver exchanges these states until
   none moves.  Words start in the class of their state.
4. Exchange over all words: blocks count the pairs of classes, and by class
   the neighbours of the words that the next step moves, those of one hashed
   batch; the rows of a range meet, and each of these words takes the class
   that raises the likelihood most, given the class-by-class table and the
   moves of the same range.  If the likelihood falls because neighbours moved at
   once, the step is taken back, and the next round has twice the batches.
   It ends with a round that raises the likelihood by less than
   ``LEAST_RISE`` nats per token, or two in turn if steps were taken back,
   or when steps of a ``MOST_BATCHES``-th of the words still lower it.
5. Blocks meet their words' classes again and are scored.

Only the class-by-class table is broadcast.  A word without training count
keeps the class it starts in.  A task that chooses holds the entries of one
range and, of a word that every block holds, at most ``SLOTS`` counts per
block.  Tables of steps that are over are removed.

Words are ASCII-lower-cased; the end is a token of its own.  Distinct
tokens are told apart by 64-bit hashes.

Edge cases: null texts are empty, that is one end token.  A null id counts
as the empty text for the fold (held out).  Without any training document
all counts are 0 and both scores fall back to the uniform base.  Rows that
repeat an id are scored, and counted, each.  An empty table gives no rows.
A very long text is a block of its own.  Of classes that raise the likelihood
alike a word takes the lowest, and stays where it is unless one is better.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import new_run
from .common import read, slices, written

FREQUENT = 1000
# Words rarer than one in a million tokens are not ranked for the start.
LEAST_SHARE = 1e-6
CLASSES = 64
ENDINGS = 128
# Classes with the end's; what is counted per word: classes to its right
# and to its left, and its own repeats.
K = CLASSES + 1
SLOTS = 2 * K + 1
LEAST_RISE = 1e-3
BATCHES, MOST_BATCHES = 1, 4
MIX = 0.9
ALPHA = 0.1
# Pseudo-counts of a class's transitions, spread by class frequency.
BACKOFF = 2.0
FOLDS = 10
BLOCK_TOKENS = 3_000_000
# Distinct tokens of blocks, summed over blocks, in a range of hashes.
RANGE_ENTRIES = 400_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Neighbour counts worked on at a time.
ENTRIES = 16_000
# Words whose gains are worked out at a time.
PART = 2048
# Counts of a word that are added one by one for all such words.
FEW = 4
# Neighbouring words worked on at a time.
PIECE = 500_000

END = xxhash.xxh3_64_intdigest(b"") - (1 << 63)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def tokens_in(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' words, lower-cased in ASCII, each text's followed by the end; their
    endings; and the texts' numbers of tokens.

    An ending is the class of a word's last two bytes.
    """
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    raw = b"\n".join([*raws, b""])
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, raw.split())), dtype=">u8").astype(np.uint64)
    b = np.frombuffer(raw, dtype=np.uint8)
    space = _SPACE[b]
    last = np.flatnonzero(~space[:-1] & space[1:])
    before = np.where((last > 0) & ~space[last - 1], b[last - 1], 0)
    both = b[last].astype(np.uint32) | (before.astype(np.uint32) << 8)
    ends = np.searchsorted(last, np.cumsum([len(r) + 1 for r in raws]))
    token = np.insert((h ^ np.uint64(1 << 63)).view(np.int64), ends, END)
    both = np.insert(both, ends, 0)
    return (token, ((both * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % ENDINGS,
            np.diff(ends, prepend=0) + 1)


def tokens_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a text and their endings."""
    return tokens_in([text])[:2]


# ``learnt``: an end and the training documents' tokens, ``held``: those of the others, both as
# 32-bit numbers of the block's distinct ``tokens``.  ``doc_ids``, ``lengths``: of the documents,
# ``n_learnt`` training ones first.  Ids travel as text: pandas would turn whole numbers with
# nulls into floats.
BLOCK_SCHEMA = ("block long, doc_ids array<string>, lengths binary, n_learnt long, learnt binary, held binary, "
                "entries long, tokens binary, endings binary, here binary")


def squeezed(x: np.ndarray, kind: str) -> bytes:
    """``x`` compressed: its numbers' first bytes, then their second ones and so on."""
    width = np.dtype(kind).itemsize
    own, out = np.ascontiguousarray(x, dtype=kind).view("u1").reshape(-1, width), np.empty((width, len(x)), dtype="u1")
    for i in range(width):
        out[i] = own[:, i]
    return out.nbytes.to_bytes(8, "little") + pa.compress(out.tobytes(), codec="zstd", asbytes=True)


def loose(x: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd"), dtype="u1")
    width = np.dtype(kind).itemsize
    out = np.empty((len(raw) // width, width), dtype="u1")
    for i, part in enumerate(raw.reshape(width, -1)):
        out[:, i] = part
    return out.reshape(-1).view(kind)


def block_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per block."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    docs, pending = [], 0
    for frame in frames:
        texts, ids, held = frame["text"].tolist(), frame["doc_id"].tolist(), frame["held_out"].to_numpy(dtype=bool)
        for i, j in slices(texts):
            docs.append((ids[i:j], held[i:j], *tokens_in(texts[i:j])))
            pending += len(docs[-1][2])
            if pending >= BLOCK_TOKENS:
                yield _block(number, docs)
                docs, pending, number = [], 0, number + 1
    if docs:
        yield _block(number, docs)


def _block(number: int, docs: list[tuple]) -> pd.DataFrame:
    doc_ids = [i for d in docs for i in d[0]]
    held, token, endings, lengths = (np.concatenate([d[k] for d in docs]) for k in range(1, 5))
    # Numbered as they come, then in order.
    ids, distinct = pd.factorize(token)
    endings = endings[_starts(np.maximum.accumulate(ids))]
    order = np.argsort(distinct)
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order))
    ids, token = place[ids], distinct[order]
    learnt = np.repeat(~held, lengths)
    here = np.bincount(ids[learnt], minlength=len(token))
    end = np.searchsorted(token, END).astype(np.uint32)
    docs_in_order = np.argsort(held, kind="stable")
    return pd.DataFrame({
        "block": number, "doc_ids": [[doc_ids[i] for i in docs_in_order]],
        "lengths": [squeezed(lengths[docs_in_order], "<i8")], "n_learnt": int((~held).sum()),
        "learnt": [squeezed(np.concatenate([[end], ids[learnt]]), "<u4")], "held": [squeezed(ids[~learnt], "<u4")],
        "entries": len(token), "tokens": [token.astype("<i8").tobytes()],
        "endings": [squeezed(endings[order], "u1")], "here": [squeezed(here, "<u4")]})


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of like values start."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])


def pair_counter(frequent: np.ndarray):
    """Counts ``(a, b, n)`` of neighbouring states in training documents; a text starts after an end."""
    states = len(frequent) + ENDINGS + 1

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(states * states, dtype=np.int64)
        for frame in frames:
            for tokens, endings, learnt in zip(frame["tokens"], frame["endings"], frame["learnt"]):
                s = states_of(np.frombuffer(tokens, dtype="<i8"), frequent, loose(endings, "u1").astype(np.int64))
                t = loose(learnt, "<u4")
                for i in range(0, len(t) - 1, PIECE):
                    now = s[t[i:i + PIECE + 1]]
                    total += np.bincount(now[:-1] * states + now[1:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"a": at // states, "b": at % states, "n": total[at]})
    return count


def states_of(token: np.ndarray, frequent: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """States: place among the sorted frequent tokens, else ending, else (last) the end."""
    at = np.searchsorted(frequent, token)
    known = np.zeros(len(token), dtype=bool)
    if len(frequent):
        at = np.minimum(at, len(frequent) - 1)
        known = frequent[at] == token
    out = np.where(known, at, len(frequent) + endings)
    out[token == END] = len(frequent) + ENDINGS
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, frequency: np.ndarray, n_words: int, classes: int = CLASSES,
             passes: int | None = None) -> np.ndarray:
    """Class of each state; the first ``n_words`` states move, the others keep their own class.

    Moves each word in turn (by falling frequency) to the class that gives
    the greatest likelihood of the class pairs, until nothing moves or
    ``passes`` are done.
    """
    n_states = len(pairs)
    classes = max(1, min(classes, n_words))
    order = np.argsort(-frequency[:n_words], kind="stable")
    of = np.concatenate([np.empty(n_words, dtype=np.int64), classes + np.arange(n_states - n_words)])
    of[order] = np.arange(n_words) % classes
    k = classes + n_states - n_words
    member = np.zeros((n_states, k))
    member[np.arange(n_states), of] = 1
    table = member.T @ pairs @ member
    row, col = table.sum(axis=1), table.sum(axis=0)
    free = np.arange(classes)
    least = 1e-9 * max(1.0, pairs.sum())      # above rounding
    for _ in itertools.count() if passes is None else range(passes):
        moved = 0
        for w in order:
            a, own = of[w], pairs[w, w]
            r = np.bincount(of, weights=pairs[w], minlength=k)
            c = np.bincount(of, weights=pairs[:, w], minlength=k)
            r[a] -= own
            c[a] -= own
            rs, cs = r.sum() + own, c.sum() + own
            table[a] -= r
            table[:, a] -= c
            table[a, a] -= own
            row[a] -= rs
            col[a] -= cs
            t_row, t_col = table[free], table[:, free].T
            diagonal = table[free, free]
            gain = (_xlogx(t_row + r) - _xlogx(t_row)).sum(axis=1)
            gain += (_xlogx(t_col + c) - _xlogx(t_col)).sum(axis=1)
            gain -= _xlogx(diagonal + r[free]) + _xlogx(diagonal + c[free]) - 2 * _xlogx(diagonal)
            gain += _xlogx(diagonal + r[free] + c[free] + own) - _xlogx(diagonal)
            gain -= _xlogx(row[free] + rs) - _xlogx(row[free])
            gain -= _xlogx(col[free] + cs) - _xlogx(col[free])
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + least:
                b = int(a)
            moved += b != a
            of[w] = b
            table[b] += r
            table[:, b] += c
            table[b, b] += own
            row[b] += rs
            col[b] += cs
        if not moved:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class pairs, up to a part that no class changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _nlogn(n: np.ndarray) -> np.ndarray:
    """``_xlogx`` of whole numbers."""
    return n * np.log(np.maximum(n, 1.0))


def _rises(rise: np.ndarray, kind: np.ndarray, of: np.ndarray, alone: np.ndarray, hit: np.ndarray,
           of_hit: np.ndarray):
    """Gains by class of neighbour counts: of their kinds, but apart for the word's own class and its counts."""

    def rises(at: np.ndarray) -> np.ndarray:
        out = rise[kind[at]]
        out[np.arange(len(at)), of[at]] = alone[at]
        own = np.flatnonzero(hit[at] >= 0)
        out[own] = of_hit[hit[at[own]]]
        return out
    return rises


def best_classes(word: np.ndarray, slot: np.ndarray, n: np.ndarray, of: np.ndarray,
                 table: np.ndarray) -> np.ndarray:
    """Class of each word that gives the greatest likelihood if it moves alone.

    ``word`` (rising), ``slot``, ``n``: counts of the words' neighbours.
    ``of``: their classes now.  The last class of ``table`` is the end's.
    """
    k, free = len(table), len(table) - 1
    n = n.astype(np.float64)
    own = np.bincount(word[slot == 2 * k], n[slot == 2 * k], len(of))
    sides = []
    for which, across in ((0, table.T), (1, table)):
        at = np.flatnonzero(slot // k == which)
        w, c, x = word[at], slot[at] % k, n[at]
        total = np.bincount(w, x, len(of)) + own
        sums = across[:, :free].sum(axis=0)
        # Many words have the same count of the same class: its gains are worked out once.
        kinds, kind = np.unique(x.astype(np.int64) * k + c, return_inverse=True)
        rise = _nlogn(across[kinds % k, :free] + (kinds // k)[:, None]) - _nlogn(across[:, :free])[kinds % k]
        totals, total_kind = np.unique(total, return_inverse=True)
        fall = _nlogn(sums + totals[:, None]) - _nlogn(sums)
        # The word's own class is taken without the word.
        a = of[w]
        alone = _nlogn(across[c, a]) - _nlogn(across[c, a] - x)
        alone_fall = _nlogn(sums[of]) - _nlogn(sums[of] - total)
        sides.append((across, w, c, x, a, kind, rise, alone, total_kind, fall, alone_fall))
    best = np.empty(len(of), dtype=np.int64)
    # As many words at a time as stay in a processor's cache.
    for lo in range(0, len(of), PART):
        hi = min(lo + PART, len(of))
        every, now, itself = np.arange(hi - lo), of[lo:hi], own[lo:hi]
        spans = [slice(*np.searchsorted(side[1], (lo, hi))) for side in sides]
        near = np.zeros((2, hi - lo, k))
        for counts, span, side in zip(near, spans, sides):
            counts[side[1][span] - lo, side[2][span]] = side[3][span]
        gain = np.zeros((hi - lo, free))
        for other, span, (across, *each, rise, alone, total_kind, fall, alone_fall) in zip(near[::-1], spans, sides):
            w, c, x, a, kind = (e[span] for e in each)
            if len(w):
                w, alone = w - lo, alone[span]
                hits = np.flatnonzero(c == a)
                t = across[c[hits], :free] - other[w[hits], :free]
                t[np.arange(len(hits)), a[hits]] -= x[hits] + itself[w[hits]]
                of_hit = _nlogn(t + x[hits, None]) - _nlogn(t)
                hit = np.full(len(w), -1)
                hit[hits] = np.arange(len(hits))
                rises = _rises(rise, kind, a, alone, hit, of_hit)
                # Counts are added one by one: of words with few of them, of all at a time.
                starts = _starts(w)
                sizes = np.diff(starts, append=len(w))
                order = np.argsort(sizes, kind="stable")
                starts, sizes = starts[order], sizes[order]
                few = int(np.searchsorted(sizes, FEW, side="right"))
                summed = np.empty((len(starts), free))
                for i in range(sizes[few - 1] if few else 0):
                    some = int(np.searchsorted(sizes, i, side="right"))
                    if i:
                        summed[some:few] += rises(starts[some:few] + i)
                    else:
                        summed[:few] = rises(starts[:few])
                if few < len(starts):
                    firsts = np.cumsum(sizes[few:]) - sizes[few:]
                    at = np.repeat(starts[few:] - firsts, sizes[few:]) + np.arange(sizes[few:].sum())
                    summed[few:] = np.add.reduceat(rises(at), firsts, axis=0)
                gain[w[starts]] += summed
            part = fall[total_kind[lo:hi]]
            part[every, now] = alone_fall[lo:hi]
            gain -= part
        # Pairs within a class matter where a word has it on both sides, or repeats itself.
        right, left = near
        w, j = np.nonzero(((right > 0) & (left > 0))[:, :free] | (itself > 0)[:, None])
        r, c, o = right[w, j], left[w, j], itself[w]
        d = np.diag(table)[j] - np.where(j == now[w], r + c + o, 0.0)
        gain[w, j] += _nlogn(d + r + c + o) - _nlogn(d + r) + _nlogn(d) - _nlogn(d + c)
        top = gain.argmax(axis=1)
        best[lo:hi] = np.where(gain[every, top] > gain[every, now] + 1e-9, top, now)
    return best


def range_cuts(token: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the ``2 ** bits`` ranges of hashes starts among sorted tokens, and their number."""
    starts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(token, (starts ^ np.uint64(1 << 63)).view(np.int64)), [len(token)]])


def by_range(bits: int):
    """A row per block and range with its part of the block's tokens."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, tokens, here in zip(frame["block"], frame["tokens"], frame["here"]):
                token, n = np.frombuffer(tokens, dtype="<i8"), loose(here, "<u4")
                cuts = range_cuts(token, bits)
                held = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({
                    "range": held, "block": block,
                    "tokens": [token[cuts[i]:cuts[i + 1]].tobytes() for i in held],
                    "here": [squeezed(n[cuts[i]:cuts[i + 1]], "<u4") for i in held]})
    return split


# Per block and range: numbers of its words within the range (differences),
# their counts in the whole corpus, whether this block is the first to hold
# a training word; in one row of a range also its words' sums and most frequent words.
NUMBERED_SCHEMA = ("block long, range long, numbers binary, totals binary, firsts binary, "
                   "mass long, words long, top binary, top_totals binary")


def number_words(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    tokens = [np.frombuffer(t, dtype="<i8") for t in rows["tokens"]]
    word, first, number = np.unique(np.concatenate(tokens), return_index=True, return_inverse=True)
    here = np.concatenate([loose(n, "<u4") for n in rows["here"]])
    total = np.bincount(number, weights=here, minlength=len(word)).astype(np.int64)
    firsts = np.zeros(len(number), dtype=np.uint8)
    firsts[first] = total > 0
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    spans = list(zip(cuts, cuts[1:]))
    ranked = np.lexsort((word, -total))
    ranked = ranked[(word[ranked] != END) & (total[ranked] > 0)][:FREQUENT]
    more = [None] * (len(rows) - 1)
    return pd.DataFrame({
        "block": rows["block"].to_numpy(), "range": rows["range"].to_numpy(),
        "numbers": [squeezed(np.diff(number[i:j], prepend=0), "<u4") for i, j in spans],
        "totals": [squeezed(total[number[i:j]], "<i8") for i, j in spans],
        "firsts": [squeezed(firsts[i:j], "u1") for i, j in spans],
        "mass": pd.Series([int(total.sum()), *[0] * len(more)]),
        "words": pd.Series([int((total > 0).sum()), *[0] * len(more)]),
        "top": [word[ranked].tobytes(), *more], "top_totals": [total[ranked].tobytes(), *more]})


def top_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for top, totals in zip(frame["top"], frame["top_totals"]):
            yield pd.DataFrame({"token": np.frombuffer(top, dtype="<i8"),
                                "total": np.frombuffer(totals, dtype="<i8")})


# Classes of a block's tokens in a range, one byte each.
CLASS_SCHEMA = "block long, range long, classes binary"


def _unpacked(packed: pd.DataFrame, classes: pd.DataFrame):
    """Documents of a block, its rows per range, and its tokens' classes."""
    own = packed["learnt"].notna()
    of = [loose(c, "u1") for c in classes.sort_values("range")["classes"]]
    return packed[own].iloc[0], packed[~own].sort_values("range"), of


def in_batch(word: np.ndarray, step: int, batches: int) -> np.ndarray:
    """Whether a word moves in this step; ``batches`` steps in turn move every word once."""
    h = (word.astype(np.uint64) + np.uint64(1 + step // batches)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(40)) % np.uint64(batches)).astype(np.int64) == step % batches


# Per block and range: word numbers, classes, how many neighbour counts each
# word has, their slots and the counts.  In one row of a block also its pairs
# of classes and distinct training words per class.
NEAR_SCHEMA = ("block long, range long, numbers binary, classes binary, sizes binary, slots binary, "
               "counts binary, cells binary")


def neighbour_counter(step: int, batches: int):
    """Neighbour counts of the words that a step moves, and the pairs of classes of all words."""

    def count(packed: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
        doc, ranges, parts = _unpacked(packed, classes)
        of = np.concatenate(parts)
        t = loose(doc["learnt"], "<u4")
        first = np.concatenate([loose(x, "u1") for x in ranges["firsts"]])
        moves = np.ones(len(of), dtype=bool)
        if batches > 1:
            moves = np.concatenate([in_batch(np.cumsum(loose(x, "<u4"), dtype=np.int64), step, batches)
                                    for x in ranges["numbers"]])
        moves[t[0]] = False                   # the end
        cells = np.append(np.zeros(K * K, dtype=np.int64), np.bincount(of[first > 0], minlength=K))
        kind = np.uint32 if len(of) * SLOTS < 1 << 32 else np.int64
        keys = []
        for i in range(0, len(t) - 1, PIECE):
            now = t[i:i + PIECE + 1]
            c, some, same = of[now].astype(kind), moves[now], now[1:] == now[:-1]
            cells[:K * K] += np.bincount((c[:-1] * kind(K) + c[1:]).astype(np.int64), minlength=K * K)
            a, b = now[:-1].astype(kind, copy=False), now[1:].astype(kind, copy=False)
            x, y, z = (np.flatnonzero(some[:-1] & ~same), np.flatnonzero(some[1:] & ~same),
                       np.flatnonzero(some[:-1] & same))
            keys += [a[x] * kind(SLOTS) + c[1:][x], b[y] * kind(SLOTS) + kind(K) + c[:-1][y],
                     a[z] * kind(SLOTS) + kind(2 * K)]
        keys = np.concatenate(keys) if keys else np.empty(0, dtype=kind)
        keys.sort()                               # in place: blocks are large
        starts = _starts(keys)
        keys, n = keys[starts], np.diff(starts, append=len(keys))
        word, slot = keys // kind(SLOTS), (keys % kind(SLOTS)).astype(np.uint8)
        sizes = np.bincount(word, minlength=len(of))
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        near = np.concatenate([[0], np.cumsum(sizes)])[cuts]
        spans, entries = list(zip(cuts, cuts[1:])), list(zip(near, near[1:]))
        return pd.DataFrame({
            "block": ranges["block"].to_numpy(), "range": ranges["range"].to_numpy(),
            "numbers": ranges["numbers"].to_numpy(), "classes": [squeezed(p, "u1") for p in parts],
            "sizes": [squeezed(sizes[i:j], "u1") for i, j in spans],
            "slots": [squeezed(slot[i:j], "u1") for i, j in entries],
            "counts": [squeezed(n[i:j], "<u4") for i, j in entries],
            "cells": [squeezed(cells, "<i8"), *[None] * (len(ranges) - 1)]})
    return count


def sum_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = np.zeros(K * K + K, dtype=np.int64)
    for frame in frames:
        for cells in frame["cells"]:
            n += loose(cells, "<i8")
    at = np.flatnonzero(n)
    yield pd.DataFrame({"cell": at, "n": n[at]})


def mover(table: np.ndarray):
    """New classes of a range's words, for every block that holds them."""

    def move(rows: pd.DataFrame) -> pd.DataFrame:
        numbers = [np.cumsum(loose(x, "<u4"), dtype=np.int64) for x in rows["numbers"]]
        of = np.zeros(max(int(x[-1]) for x in numbers) + 1, dtype=np.int64)
        keys = []
        for number, classes, sizes, slots, n in zip(numbers, rows["classes"], rows["sizes"],
                                                    rows["slots"], rows["counts"]):
            of[number] = loose(classes, "u1")
            key = np.repeat(number, loose(sizes, "u1")) * SLOTS + loose(slots, "u1")
            keys.append(key << 32 | loose(n, "<u4").astype(np.int64))
        # Word, slot and count in one number: a range has far fewer words than 2 ** 31 / SLOTS.
        key = np.concatenate(keys)
        del keys
        key.sort()
        n = key & 0xFFFFFFFF
        key >>= 32
        starts = _starts(key)
        key, n = key[starts], (np.add.reduceat(n, starts) if len(starts) else n).astype(np.float64)
        local = table.copy()
        movable, at = np.unique(key // SLOTS, return_inverse=True)
        slot, i = key % SLOTS, 0
        while i < len(at):
            # As many whole words as ENTRIES holds, one at least.
            j = int(np.searchsorted(at, at[i + ENTRIES])) if i + ENTRIES < len(at) else len(at)
            if j <= i:
                j = int(np.searchsorted(at, at[i], side="right"))
            some, w, side = movable[at[i]:at[j - 1] + 1], at[i:j] - at[i], slot[i:j] // K
            old = of[some]
            of[some] = best_classes(w, slot[i:j], n[i:j], old, local)
            # What the range's next words see of these moves.
            for sign, now in ((-1, old), (1, of[some])):
                for this, first, columns in ((0, now[w], slot[i:j] % K), (1, slot[i:j] % K, now[w]),
                                             (2, now[w], now[w])):
                    np.add.at(local, (first[side == this], columns[side == this]), sign * n[i:j][side == this])
            i = j
        return pd.DataFrame({"block": rows["block"].to_numpy(), "range": rows["range"].to_numpy(),
                             "classes": [squeezed(of[x], "u1") for x in numbers]})
    return move


def starter(frequent: np.ndarray, class_of: np.ndarray, bits: int):
    """Classes that tokens start in."""

    def start(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, tokens, endings in zip(frame["block"], frame["tokens"], frame["endings"]):
                token = np.frombuffer(tokens, dtype="<i8")
                of = class_of[states_of(token, frequent, loose(endings, "u1").astype(np.int64))]
                cuts = range_cuts(token, bits)
                held = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({"block": block, "range": held,
                                    "classes": [squeezed(of[cuts[i]:cuts[i + 1]], "u1") for i in held]})
    return start


class Step(NamedTuple):
    """A table of a step and its folder."""

    rows: DataFrame
    path: str

    @classmethod
    def of(cls, df: DataFrame, name: str) -> Step:
        path = new_run(df.sparkSession, name).table("rows")
        df.write.parquet(path)
        return cls(df.sparkSession.read.schema(df.schema).parquet(path), path)

    def remove(self) -> None:
        spark = self.rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cluster(packed: DataFrame, classes: Step) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Classes after the exchange, pairs of classes, words per class."""
    grouped = packed.groupBy("block")

    def measured(state: Step, step: int, batches: int) -> tuple[Step, np.ndarray, np.ndarray]:
        near = Step.of(grouped.cogroup(state.rows.groupBy("block"))
                       .applyInPandas(neighbour_counter(step, batches), NEAR_SCHEMA), "lm-near")
        counted = (near.rows.filter("cells is not null").select("cells")
                   .mapInPandas(sum_cells, "cell long, n long")
                   .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
        n = np.zeros(K * K + K)
        n[counted["cell"].to_numpy()] = counted["n"].to_numpy()
        return near, n[:K * K].reshape(K, K), n[K * K:]

    batches, rounds, still = BATCHES, 0, 0
    near, table, kinds = measured(classes, 0, batches)
    while table.any() and still < 2:
        before, taken_back = likelihood(table), False
        for turn in range(batches):
            if near is None:                      # a step was taken back
                near = measured(classes, rounds * batches + turn, batches)[0]
            moved = Step.of(near.rows.drop("cells").groupBy("range").applyInPandas(
                mover(table), CLASS_SCHEMA), "lm-classes")
            # What the next step moves, if this one stays.
            coming = ((rounds * batches + turn + 1, batches) if turn + 1 < batches
                      else ((rounds + 1) * _next(batches, taken_back), _next(batches, taken_back)))
            new_near, new_table, new_kinds = measured(moved, *coming)
            better = likelihood(new_table) >= likelihood(table)
            for over in (classes, near) if better else (moved, near, new_near):
                over.remove()
            if better:
                classes, near, table, kinds = moved, new_near, new_table, new_kinds
            else:
                near, taken_back = None, True
        rounds += 1
        rises = likelihood(table) - before >= LEAST_RISE * table.sum()
        still = 0 if rises else still + 1 if taken_back and batches < MOST_BATCHES else 2
        batches = _next(batches, taken_back)
    if near is not None:
        near.remove()
    return classes.rows, table, kinds


def _next(batches: int, taken_back: bool) -> int:
    return min(batches * 2, MOST_BATCHES) if taken_back else batches


def scorer(after: np.ndarray, mass: np.ndarray, kinds: np.ndarray, total: int, distinct: int):
    """Scores a block: its documents and tokens, and its tokens' classes.

    ``after[i, j]``: probability of class j after i.  ``mass`` and
    ``kinds``: tokens and distinct tokens of a class in training.
    """
    end = len(mass) - 1

    def score(packed: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
        doc, ranges, k = _unpacked(packed, classes)
        k = np.concatenate(k).astype(np.int64)
        c = np.concatenate([loose(x, "<i8") for x in ranges["totals"]]).astype(np.float64)
        base = (c + ALPHA) / (total + ALPHA * (distinct + 1))
        emission = np.where(k < end, (c + ALPHA) / (mass[k] + ALPHA * (kinds[k] + 1)),
                            c / np.maximum(1, mass[k]))
        known, log_base = c > 0, np.log10(base)
        rows = []
        tokens = np.concatenate([loose(doc["learnt"], "<u4")[1:], loose(doc["held"], "<u4")])
        ends = np.cumsum(loose(doc["lengths"], "<i8"))
        for i, j in zip([0, *ends[:-1]], ends):
            t = tokens[i:j]
            cls = k[t]
            before = np.concatenate([[end], cls[:-1]])
            p = MIX * after[before, cls] * emission[t] + (1 - MIX) * base[t]
            rows.append((len(t), int(known[t].sum()), total, log_base[t].sum(), np.log10(p).sum()))
        out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "train_tokens", "base_score", "score"])
        out["doc_id"], out["held_out"] = list(doc["doc_ids"]), np.arange(len(out)) >= doc["n_learnt"]
        return out[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]]
    return score


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings in which a query's shuffle files go when it ends.

    Nothing reads them later: what a step leaves is a table in the shared folder.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(CLEANUP, "true")
    return own


class Model(NamedTuple):
    """``blocks`` with their documents and token lists; ``numbered`` words of blocks; their
    ``classes``; ``pairs`` of classes; ``kinds``: distinct training words per class; training
    tokens and distinct ones."""

    blocks: DataFrame
    numbered: DataFrame
    classes: DataFrame
    pairs: np.ndarray
    kinds: np.ndarray
    total: int
    distinct: int


def learn(docs: DataFrame) -> Model:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), (fold == 0).alias("held_out"),
                       "text")
    made = Step.of(rows.mapInPandas(block_batches, BLOCK_SCHEMA), "lm-blocks")
    blocks = own_session(docs.sparkSession).read.schema(BLOCK_SCHEMA).parquet(made.path)
    entries = blocks.agg(F.sum("entries").alias("n")).first()["n"] or 0
    bits = max(4, int(entries // RANGE_ENTRIES).bit_length())
    numbered = written(blocks.select("block", "tokens", "here")
                       .mapInPandas(by_range(bits), "range long, block long, tokens binary, here binary")
                       .groupBy("range").applyInPandas(number_words, NUMBERED_SCHEMA), "lm-words")
    sums = numbered.agg(F.sum("mass").alias("n"), F.sum("words").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    # A million words at most have this share, so no more meet in one task.
    top = (numbered.filter("top is not null").select("top", "top_totals")
           .mapInPandas(top_words, "token long, total long").filter(F.col("total") >= total * LEAST_SHARE)
           .orderBy(F.col("total").desc(), "token").limit(FREQUENT).select("token").collect())
    frequent = np.array(sorted(r["token"] for r in top), dtype=np.int64)

    n_states = len(frequent) + ENDINGS + 1
    pairs = np.zeros((n_states, n_states))
    counted = (blocks.select("tokens", "endings", "learnt")
               .mapInPandas(pair_counter(frequent), "a long, b long, n long")
               .groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow())
    pairs[counted["a"].to_numpy(), counted["b"].to_numpy()] = counted["n"].to_numpy()
    del counted
    class_of = exchange(pairs, pairs.sum(axis=0), n_states - 1)
    del pairs

    packed = (blocks.select("block", "learnt")
              .unionByName(numbered.select("block", "range", "numbers", "firsts"), allowMissingColumns=True))
    start = Step.of(blocks.select("block", "tokens", "endings")
                    .mapInPandas(starter(frequent, class_of, bits), CLASS_SCHEMA), "lm-classes")
    return Model(blocks, numbered, *cluster(packed, start), int(total), int(distinct))


SCORE_SCHEMA = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of ``docs(doc_id, text)``."""
    model = learn(docs)
    table = model.pairs
    mass = table.sum(axis=0)
    prior = (mass + 1) / (mass.sum() + K)
    after = (table + BACKOFF * prior) / (table.sum(axis=1, keepdims=True) + BACKOFF)
    packed = (model.blocks.select("block", "doc_ids", "lengths", "n_learnt", "learnt", "held")
              .unionByName(model.numbered.select("block", "range", "totals"), allowMissingColumns=True))
    scored = Step.of(packed.groupBy("block").cogroup(model.classes.groupBy("block"))
                     .applyInPandas(scorer(after, mass, model.kinds, model.total, model.distinct),
                                    SCORE_SCHEMA), "lm-scores")
    return (docs.sparkSession.read.schema(SCORE_SCHEMA).parquet(scored.path)
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def op6_class_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and class-model log probabilities of every document."""
    return score_documents(read(spark, sf_dir, "documents"))
