"""Language identification by a linear-chain conditional random field over words.

Each word of a text is labelled with a language, given its neighbours, so
text that switches languages is told apart word by word.  A word (a run
of letters, lower-cased) has three families of features: its affixes
(first and last three letters), its n-grams (triples of letters, with
edges) and the lexicon (the whole word).  A family's evidence for a
language is the sum of centred log probabilities of its hashed features,
counted over all training documents.  The field learns the weight of each
family, a bias per language and the transition scores between languages;
forward-backward gives each word's posterior.

A text's language has the greatest mean posterior, words weighted by
their letters; that mean is the score.  Posteriors only compare the learnt
languages with each other, so the score is 0 for a text in none of them:
one whose n-grams' mean log probability, as if all languages were one, is
more than ``MARGIN`` below the ``LOW_SHARE`` quantile over all training
documents.

The counts cover all training documents.  The few weights of the field are
fitted on the driver to a sample of at most ``SAMPLE_DOCS`` training
documents of each language, the first by a hash of their row keys among those
with ``PIECE`` words, and at most ``SEGMENT`` consecutive words of each; the segment's own counts are taken
off first.  Segments are cut up and spliced, so that transitions are learnt
from text that does switch.

Edge cases: texts that are null or have no letter get ``und`` and score 0.
Languages that tie go to the first in code point order.  Very long texts are
worked on by themselves, whole.
Without training documents every text is ``und``.  A null id hashes as the
empty text (a training row).  Rows that repeat an id are labelled each.
An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import read, row_key, slices, unused, written

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
# Hashed features per family: n-grams, affixes, lexicon.
FAMILY_BITS = (15, 15, 17)
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in FAMILY_BITS])])
FAMILIES = len(FAMILY_BITS)
SMOOTHING = 0.5
SAMPLE_DOCS = 250
SEGMENT = 64
PIECE = 16
FIT_STEPS = 150
L2 = 0.01
# What separates a text in no learnt language: a quantile over training
# documents of the mean log probability of n-grams, and nats below it.
LOW_SHARE = 0.01
MARGIN = 1.0
# Characters and words worked on at a time.
CHARS = 400_000
WORDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(32)
    return h


def _bucket(h: np.ndarray, family: int) -> np.ndarray:
    shift = np.uint64(64 - FAMILY_BITS[family])
    return ((h * _MIX) >> shift).astype(np.int32) + np.int32(OFFSETS[family])


def words_and_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Words of some texts: the text each is in, its letters, and the features by family.

    A family's features come as ``(bucket, word)``.
    """
    lowered = [t.lower() for t in texts]
    lengths = np.array([len(t) + 1 for t in lowered])
    c = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # Which code points occur, and which of those are letters: two look-ups, no sort.
    present = np.zeros(sys.maxunicode + 1, dtype=bool)
    present[c] = True
    kinds = np.flatnonzero(present)
    present[kinds] = [chr(k).isalpha() for k in kinds.tolist()]
    letter = present[c]
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    del edge
    size = end - start
    text = np.searchsorted(np.cumsum(lengths), start, side="right")
    x = np.concatenate([[0, 0], np.where(letter, c, 0), [0, 0]]).astype(np.uint32)
    at = np.flatnonzero(letter) + 2
    word = np.repeat(np.arange(len(start)), size)
    ngrams = _bucket(_hash(x[at - 1], x[at], x[at + 1]), 0), word
    first, last = start + 2, end + 1
    two, three = size > 1, size > 2
    prefix = _hash(np.full(len(start), 1), x[first], np.where(two, x[first + 1], 0),
                   np.where(three, x[np.minimum(first + 2, len(x) - 1)], 0))
    suffix = _hash(np.full(len(start), 2), x[last], np.where(two, x[last - 1], 0),
                   np.where(three, x[last - 2], 0))
    number = np.arange(len(start))
    affixes = np.concatenate([_bucket(prefix, 1), _bucket(suffix, 1)]), np.concatenate([number, number])
    # A word's hash: its letters times powers of an odd number, summed.
    longest = int(size.max()) if len(size) else 1
    power = np.multiply.accumulate(np.full(longest, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))
    place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    whole = (np.add.reduceat((x[at].astype(np.uint64) + np.uint64(7)) * power[place], np.cumsum(size) - size)
             if len(size) else np.empty(0, dtype=np.uint64))
    lexicon = _bucket(whole ^ (whole >> np.uint64(31)), 2), number
    return text, size, [ngrams, affixes, lexicon]


def counter(langs: list[str]):
    """Counts ``(cell, n)``; a cell is a feature and a language."""
    index = {lang: i for i, lang in enumerate(langs)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(OFFSETS[-1] * len(langs), dtype=np.int64)
        for frame in frames:
            texts = frame["text"].tolist()
            lang = np.array([index[x] for x in frame["lang"]])
            for a, b in slices(texts, CHARS):
                text, _, families = words_and_features(texts[a:b])
                for bucket, word in families:
                    cell = bucket.astype(np.int64) * len(langs) + lang[a:b][text[word]]
                    total += np.bincount(cell, minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at, "n": total[at]})
    return count


def log_evidence(n: np.ndarray, family_totals: np.ndarray, family: int) -> np.ndarray:
    """Centred log probabilities of features given languages, from counts ``[..., language]``."""
    p = np.log(n + SMOOTHING) - np.log(family_totals + SMOOTHING * (1 << FAMILY_BITS[family]))
    return p - p.mean(axis=-1, keepdims=True)


def family_sums(values: list[np.ndarray], families: list[tuple], n_words: int) -> np.ndarray:
    """Evidence ``[word, family, language]``: feature values summed per word."""
    n_langs = values[0].shape[-1]
    out = np.zeros((n_words, FAMILIES, n_langs), dtype=np.float32)
    for f, ((_, word), v) in enumerate(zip(families, values)):
        for k in range(n_langs):
            out[:, f, k] = np.bincount(word, weights=v[:, k], minlength=n_words)
    return out


def common_evidence(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the hashed n-grams, all languages weighing the same."""
    n = counts[OFFSETS[0]:OFFSETS[1]].astype(np.float64)
    return np.log(((n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * (1 << FAMILY_BITS[0]))).mean(axis=1))


def mean_evidence(common: np.ndarray, text: np.ndarray, ngrams: tuple, n_texts: int) -> np.ndarray:
    """Mean of ``common`` over each text's n-grams; NaN for texts without letters."""
    bucket, word = ngrams
    n = np.bincount(text[word], minlength=n_texts)
    total = np.bincount(text[word], weights=common[bucket], minlength=n_texts)
    return np.where(n > 0, total / np.maximum(1, n), np.nan)


def evidence_of_texts(common: np.ndarray):
    """Mean evidence of every text that has letters."""

    def evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts, CHARS):
                text, _, families = words_and_features(texts[a:b])
                mean = mean_evidence(common, text, families[0], b - a)
                yield pd.DataFrame({"evidence": mean[~np.isnan(mean)]})
    return evidence


def segments(langs: list[str], counts: np.ndarray):
    """One segment of each sampled document: its language and its evidence, own counts taken off."""
    index = {lang: i for i, lang in enumerate(langs)}
    totals = [counts[OFFSETS[f]:OFFSETS[f + 1]].sum(axis=0) for f in range(FAMILIES)]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, text, lang in zip(frame["key"], frame["text"], frame["lang"]):
                _, size, families = words_and_features([text])
                n = len(size)
                if n < PIECE:
                    continue
                own = index[lang]
                begin = int(key[:8], 16) % max(1, n - SEGMENT + 1)
                values = []
                for f, (bucket, _) in enumerate(families):
                    c = counts[bucket].astype(np.float64)
                    ids, back, times = np.unique(bucket, return_inverse=True, return_counts=True)
                    c[:, own] -= times[back]
                    t = totals[f].astype(np.float64)
                    t[own] -= len(bucket)
                    values.append(log_evidence(np.maximum(c, 0), np.maximum(t, 0), f))
                e = family_sums(values, families, n)[begin:begin + SEGMENT]
                rows.append((key, own, e.astype("<f4").tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "lang", "evidence"])
    return cut


def forward_backward(emission: np.ndarray, transition: np.ndarray, begin: np.ndarray,
                     lengths: np.ndarray) -> np.ndarray:
    """Posteriors of words.  ``emission`` are log scores of all sequences one after the other.

    Steps run along the longest sequence; at each step the sequences that
    are long enough are worked on together.
    """
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    # How many sequences are longer than step s.
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    forward = np.empty_like(e)
    a = None
    for s, n in enumerate(active):
        at = first[:n] + s
        a = e[at] * (np.exp(begin - begin.max()) if s == 0 else a[:n] @ t)
        a /= a.sum(axis=1, keepdims=True)
        forward[at] = a
    b = np.empty((0, e.shape[1]), dtype=e.dtype)
    for s in range(len(active) - 1, -1, -1):
        n = active[s]
        if len(b) < n:                    # sequences that end here
            b = np.concatenate([b, np.ones((n - len(b), e.shape[1]), dtype=e.dtype)])
        at = first[:n] + s
        f = forward[at] * b
        forward[at] = f / f.sum(axis=1, keepdims=True)
        b = (e[at] * b) @ t.T
        b /= b.sum(axis=1, keepdims=True)
    return forward


def splice(lang: np.ndarray, evidence: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of equal length from pieces of segments in shuffled order: evidence and labels."""
    pieces = [(k, e[i:i + PIECE]) for k, e in zip(lang, evidence)
              for i in range(0, len(e) - PIECE + 1, PIECE)]
    rng = np.random.default_rng(5)
    order = rng.permutation(len(pieces))
    per = min(4, len(pieces))
    rows = [order[i:i + per] for i in range(0, len(order) - per + 1, per)]
    x = np.array([np.concatenate([pieces[p][1] for p in r]) for r in rows], dtype=np.float64)
    y = np.array([np.repeat([pieces[p][0] for p in r], PIECE) for r in rows])
    return x, y


def fit(x: np.ndarray, y: np.ndarray, n_langs: int) -> dict[str, np.ndarray]:
    """Family weights, biases, transitions and starts by ascent on the conditional likelihood (Adam)."""
    p = {"family": np.full(FAMILIES, 0.5), "bias": np.zeros(n_langs),
         "transition": np.zeros((n_langs, n_langs)), "begin": np.zeros(n_langs)}
    if not len(x):
        p["transition"] += 3.0 * np.eye(n_langs)
        return p
    n, steps = y.shape
    gold = np.eye(n_langs)[y]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for it in range(1, FIT_STEPS + 1):
        emission = np.einsum("ntfk,f->ntk", x, p["family"]) + p["bias"]
        e = np.exp(emission - emission.max(axis=2, keepdims=True))
        t = np.exp(p["transition"] - p["transition"].max())
        alpha, beta = np.empty_like(e), np.ones_like(e)
        a = e[:, 0] * np.exp(p["begin"] - p["begin"].max())
        for s in range(steps):
            if s:
                a = e[:, s] * (a @ t)
            a = a / a.sum(axis=1, keepdims=True)
            alpha[:, s] = a
        for s in range(steps - 2, -1, -1):
            b = (e[:, s + 1] * beta[:, s + 1]) @ t.T
            beta[:, s] = b / b.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        pair = alpha[:, :-1, :, None] * t * (e * beta)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        seen = np.zeros((n_langs, n_langs))
        np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        off = gold - post
        grad = {"family": np.einsum("ntk,ntfk->f", off, x), "bias": off.sum(axis=(0, 1)),
                "transition": seen - pair.sum(axis=(0, 1)), "begin": off[:, 0].sum(axis=0)}
        for k, g in grad.items():
            g = g / n - L2 * p[k]
            m, v = moments[k]
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.99 * v + 0.01 * g * g
            p[k] = p[k] + 0.05 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    return p


def labeler(langs: list[str], table: np.ndarray, p: dict[str, np.ndarray]):
    """Language and score of each text.

    ``table``: evidence of every hashed feature, already weighted by family.
    """
    n_langs = len(langs)

    def label_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        evidence = np.full(len(texts), np.nan)
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if not pending:
                return
            text = np.concatenate([t for t, _, _ in pending])
            size = np.concatenate([s for _, s, _ in pending])
            emission = np.concatenate([e for _, _, e in pending])
            pending.clear()
            ids, lengths = np.unique(text, return_counts=True)
            post = forward_backward(emission, p["transition"].astype(np.float32),
                                    p["begin"].astype(np.float32), lengths)
            first = np.cumsum(lengths) - lengths
            weight = size.astype(np.float64)
            mean = np.add.reduceat(post * weight[:, None], first, axis=0)
            mean /= mean.sum(axis=1, keepdims=True)
            best[ids], score[ids] = mean.argmax(axis=1), mean.max(axis=1)

        held = 0
        for a, b in slices(texts, CHARS):
            text, size, families = words_and_features(texts[a:b])
            if not len(size):
                continue
            evidence[a:b] = mean_evidence(p["common"], text, families[0], b - a)
            emission = np.tile(p["bias"].astype(np.float32), (len(size), 1))
            for bucket, word in families:
                for k in range(n_langs):
                    emission[:, k] += np.bincount(word, weights=table[bucket, k], minlength=len(size))
            pending.append((text + a, size, emission))
            held += len(size)
            if held > WORDS:
                flush()
                held = 0
        flush()
        return best, score, evidence

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best, score, evidence = label_texts([t or "" for t in frame["text"]])
            yield pd.DataFrame({
                "key": frame["key"], "lang_pred": [langs[i] if i >= 0 else UNKNOWN for i in best],
                "score": score, "evidence": evidence, "training": frame["training"]})
    return label


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def is_training(doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Column:
    return (fold(doc_id) != HELD_OUT) & F.col(lang).isNotNull() & F.col(text).isNotNull()


def sampled(rows: DataFrame, per_lang: dict[str, int]) -> DataFrame:
    """The first ``SAMPLE_DOCS`` rows of each language, by a hash of their keys, that have letters enough.

    A thin slice of each language's hashes is cut off first, so that few rows
    are ranked: it holds four times the sample on average.
    """
    order = F.xxhash64("key")
    share = F.element_at(F.create_map(*[x for lang, n in per_lang.items() for x in (
        F.lit(lang), F.lit(min(1.0, 4 * SAMPLE_DOCS / n)))]), F.col("lang"))
    thin = rows.filter(order.cast("double") <= (share - 0.5) * float(1 << 64))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "key"))
    return thin.filter(F.regexp_count("text", F.lit(r"\p{L}+")) >= PIECE).withColumn("rank", rank) \
        .filter(F.col("rank") <= SAMPLE_DOCS).drop("rank")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          bounded: bool = True) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """(languages, weighted evidence table, field weights) from the rows outside the held-out fold.

    ``bounded`` reads the training texts once more for the least evidence of
    a text in a learnt language, which a model for other documents needs; see
    ``identify`` for documents that the training rows are among.
    """
    rows = docs.filter(is_training(doc_id, text, lang)) \
        .select(row_key(doc_id, text).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    per_lang = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(per_lang)
    if not langs:
        return [], np.zeros((OFFSETS[-1], 0)), {}
    cells = (rows.select("text", "lang").mapInPandas(counter(langs), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(OFFSETS[-1] * len(langs), dtype=np.int64)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    del cells
    counts = counts.reshape(-1, len(langs))
    sample = sampled(rows, per_lang)
    cut = sample.mapInPandas(segments(langs, counts), "key string, lang int, evidence binary") \
        .toPandas().sort_values("key")
    evidence = [np.frombuffer(e, dtype="<f4").reshape(-1, FAMILIES, len(langs)) for e in cut["evidence"]]
    usable = [(k, e) for k, e in zip(cut["lang"], evidence) if len(e) >= PIECE]
    x, y = splice(np.array([k for k, _ in usable], dtype=np.int64), [e for _, e in usable]) \
        if usable else (np.empty((0, 0, 0, 0)), np.empty((0, 0), dtype=np.int64))
    p = fit(x, y, len(langs))
    p["common"] = common_evidence(counts)
    if bounded:
        p["least"] = least_evidence(rows.select("text").mapInPandas(evidence_of_texts(p["common"]),
                                                                    "evidence double"))
    table = np.concatenate([
        p["family"][f] * log_evidence(counts[OFFSETS[f]:OFFSETS[f + 1]].astype(np.float64),
                                      counts[OFFSETS[f]:OFFSETS[f + 1]].sum(axis=0), f)
        for f in range(FAMILIES)]).astype(np.float32)
    return langs, table, p


def least_evidence(evidence: DataFrame) -> np.ndarray:
    """What a text's evidence must reach, from the ``evidence`` of all training rows."""
    low = evidence.filter(~F.isnan("evidence")).approxQuantile("evidence", [LOW_SHARE], 0.001)
    return np.array(low[0] - MARGIN if low else -np.inf)


def identify(docs: DataFrame, model: tuple, key: str = "key", text: str = "text",
             training: Column | None = None) -> DataFrame:
    """``(key, lang_pred, score)`` for rows with a string key and a text.

    With a model that is not ``bounded``, ``training`` tells the training rows
    among ``docs``; the least evidence is taken from their labelled rows, which
    saves a reading of the texts.
    """
    langs, table, p = model
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       (F.lit(False) if training is None else training).alias("training"))
    if not langs:
        return rows.select("key", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    labelled = rows.mapInPandas(labeler(langs, table, p), "key string, lang_pred string, score double, "
                                                          "evidence double, training boolean")
    least = p.get("least")
    if least is None:
        labelled = written(labelled, "languages-labelled")
        least = least_evidence(labelled.filter("training"))
    foreign = F.col("evidence") < F.lit(float(least))
    return labelled.select("key", "lang_pred", F.when(foreign, 0.0).otherwise(F.col("score")).alias("score"))


def keep_identified(docs: DataFrame, least_score: float, doc_id: str = "doc_id", text: str = "text",
                    lang: str = "lang") -> DataFrame:
    """``docs`` without texts of no learnt language, or whose language is less sure than ``least_score``."""
    model = train(docs, doc_id, text, lang, bounded=False)
    key = unused(docs, "__key")
    keyed = docs.withColumn(key, row_key(doc_id, text))
    rejected = written(identify(keyed, model, key, text, is_training(doc_id, text, lang))
                       .filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least_score))
                       .select("key").distinct(), "languages-rejected").withColumnRenamed("key", key)
    return keyed.join(rejected, key, "left_anti").drop(key)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return identify(keyed, train(docs, bounded=False), training=is_training()).select(
        F.expr("try_cast(key as bigint)").alias("doc_id"),
        (F.crc32(F.col("key").cast("binary")) % FOLDS == HELD_OUT).alias("held_out"),
        "lang_pred", F.col("score").cast("double"))
