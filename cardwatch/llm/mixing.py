"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words.  The sources, in code point order with null last, weigh
5, 2, 1 and so on in turn and share all words by weight; a target stops
at three times its source's size and the excess is shared again by weight
(``targets``).

A source's documents fall into blocks by hash.  Every block is taken
``floor(target / size)`` times, and of a permutation of the blocks as
many once more as fit the rest of the target, blocks larger than the rest
set aside.  What is left is filled the same way from all blocks that still
fit, until none does; a last block follows if it brings the sum nearer.

The takings ("draws") are then dealt to output shards.  Their counts per
source form the root of a binary tree over the shards.  A node sends to
its left half a multivariate hypergeometric draw of its counts, source by
source, each a hypergeometric variate got by inverting its distribution
at a hashed uniform number; the rest goes right.  The leaves are exact
quotas of blocks per shard and source.  Along a second permutation of a
source's draws, each shard takes as many consecutive ones as its quota
says, so the shards are disjoint; within a shard documents are put in
hash order.

All random numbers are hashes of the seed and of stable keys, so runs
agree.  Ranks are taken in two steps, over hash ranges and within one, so
no task holds all blocks of a source.  Only tables of sources meet in one
task (a few numbers per source).

Edge cases: a null or empty text has size 0 and is taken as often as its
block; a null source is a source of its own, the last one.  Rows that
repeat id and text share a block.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, row_key, unused, word_count, written

# The weights of the sources in turn, and the cap on repeats.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

SEED = 20240117
# Words of an output shard, and blocks per source: as many as BLOCK_WORDS
# gives, but LEAST_BLOCKS at least (most of them empty in a small source,
# whose documents then are blocks of their own).
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 1_000_000
LEAST_BLOCKS = 1024
# Hash ranges for ranks in two steps.
RANGES = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, ...)`` with ``idx`` and ``target``, one row per source.

    The targets are ``least(cap, level * weight)``; along rising cap per
    weight the level over the sources not yet at their cap rises until the
    first one that stays below, so the right level is its maximum.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.col("idx") % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("idx", F.row_number().over(by_name) - 1)
              .withColumn("weight", share).withColumn("cap", F.col("source_size") * float(max_repeats)))
    everything = Window.partitionBy()
    before = (Window.orderBy(F.col("cap") / F.col("weight"), "idx")
              .rowsBetween(Window.unboundedPreceding, -1))
    level = ((F.sum("source_size").over(everything).cast("double")
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("weight")))
            .drop("weight", "cap", "level"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _ranked(df: DataFrame, group: str, order: Column, tie: list[str], value: str) -> DataFrame:
    """``rank`` (from 0) and ``before`` (sum of ``value`` over lower ranks) per group, in two steps."""
    df = df.withColumn("_order", order).withColumn("_range", F.pmod(F.col("_order"), F.lit(RANGES)))
    inner = (Window.partitionBy(group, "_range").orderBy("_order", *tie)
             .rowsBetween(Window.unboundedPreceding, -1))
    outer = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (df.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
              .withColumn("_n0", F.coalesce(F.sum("_n").over(outer), F.lit(0)))
              .withColumn("_v0", F.coalesce(F.sum("_v").over(outer), F.lit(0))))
    return (df.withColumn("_i", F.coalesce(F.count(F.lit(1)).over(inner), F.lit(0)))
            .withColumn("_s", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(ranges.select(group, "_range", "_n0", "_v0"), [group, "_range"])
            .withColumn("rank", F.col("_n0") + F.col("_i"))
            .withColumn("before", F.col("_v0") + F.col("_s"))
            .drop("_order", "_range", "_i", "_s", "_n0", "_v0"))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       word_count(text).alias("size"), row_key(doc_id, text).alias("key"))


def block_table(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``idx``, ``block`` and their source's figures; and the blocks with ``copies``."""
    blocks_of = F.greatest(F.lit(LEAST_BLOCKS),
                           F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS))).cast("long")
    named = sources.withColumn("n_blocks", blocks_of).withColumnRenamed("source", "_source")
    placed = (rows.join(named, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "key"), F.col("n_blocks"))))
    blocks = placed.groupBy("idx", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"))
    full = F.when(F.col("source_size") == 0, 0).otherwise(
        F.floor(F.col("target") / F.col("source_size"))).cast("int")
    blocks = (blocks.withColumn("full", full)
              .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")))
    filled = fill(blocks.withColumn("extra", F.lit(0)))
    return placed, (filled.withColumn("copies", F.least(F.lit(MAX_REPEATS), F.col("full") + F.col("extra")))
                    .select("idx", "block", "words", "copies"))


def fill(blocks: DataFrame) -> DataFrame:
    """``blocks`` with as many ``extra`` copies as bring each source's words nearest to ``rest``.

    In every round the blocks larger than the gap are set aside, and the
    others follow along the permutation as far as they fit; then the gap
    is less than the first that did not, so few rounds do.  Blocks not yet
    taken once more come first.
    """
    blocks, level, start = written(blocks, "mix-fill"), 0, True
    while level < MAX_REPEATS:
        fits = (_with_gap(blocks).filter((F.col("extra") <= level) & (F.col("words") <= F.col("gap"))
                                         & (F.lit(start) | (F.col("words") > 0))))
        more = written(_ranked(fits, "idx", F.xxhash64(F.lit(SEED + 1), "idx", "block"), ["block"], "words")
                       .filter(F.col("before") + F.col("words") <= F.col("gap"))
                       .select("idx", "block", F.lit(1).alias("more")), "mix-more")
        start = False
        if more.isEmpty():
            level += 1
        else:
            blocks = _once_more(blocks, more)
    nearest = (_with_gap(blocks).filter(F.col("words") < 2 * F.col("gap")).groupBy("idx")
               .agg(F.min(F.struct("words", "block"))["block"].alias("block"), F.lit(1).alias("more")))
    return _once_more(blocks, nearest)


def _with_gap(blocks: DataFrame) -> DataFrame:
    """Blocks that may be taken once more, with the words their source lacks."""
    gaps = blocks.groupBy("idx").agg((F.first("rest") - F.sum(F.col("words") * F.col("extra"))).alias("gap"))
    return blocks.filter(F.col("full") + F.col("extra") < MAX_REPEATS).join(gaps, "idx")


def _once_more(blocks: DataFrame, more: DataFrame) -> DataFrame:
    return written(blocks.join(more, ["idx", "block"], "left")
                   .withColumn("extra", F.col("extra") + F.coalesce("more", F.lit(0))).drop("more"), "mix-fill")


# A hypergeometric variate: of ``n`` balls drawn from ``m`` of which ``k`` are
# marked, how many are.  ``u`` is uniform in (0, 1).  Weights are relative to
# the mode; the sum runs over ten deviations to either side, beyond which
# less than 1e-20 lies.
def hypergeometric_sql(m: str, k: str, n: str, u: str) -> str:
    bounds = f"""transform(array(named_struct(
        'm', {m}, 'k', {k}, 'n', {n}, 'u', {u},
        'lo', greatest(0L, {n} + {k} - {m}), 'hi', least({n}, {k}),
        'mode', least(least({n}, {k}), greatest(greatest(0L, {n} + {k} - {m}),
                cast(floor(({n} + 1D) * ({k} + 1D) / ({m} + 2D)) as bigint))),
        'reach', cast(5 + ceil(10 * sqrt(greatest(0D, {n} * ({k} / greatest(1D, cast({m} as double)))
                 * (1 - {k} / greatest(1D, cast({m} as double)))))) as bigint))),
        x -> named_struct('m', x.m, 'k', x.k, 'n', x.n, 'u', x.u, 'mode', x.mode,
             'a', greatest(x.lo, x.mode - x.reach), 'b', least(x.hi, x.mode + x.reach)))"""
    up = "(x.k - i) * cast(x.n - i as double) / ((i + 1D) * (x.m - x.k - x.n + i + 1))"
    down = "i * cast(x.m - x.k - x.n + i as double) / ((x.k - i + 1D) * (x.n - i + 1))"
    start = "named_struct('w', 1D, 's', 0D)"
    step = "named_struct('w', acc.w * ({0}), 's', acc.s + acc.w * ({0}))"
    sums = f"""transform({bounds}, x -> named_struct('x', x,
        'up', aggregate(if(x.b > x.mode, sequence(x.mode, x.b - 1), cast(array() as array<bigint>)),
              {start}, (acc, i) -> {step.format(up)}).s,
        'down', aggregate(if(x.a < x.mode, sequence(x.mode, x.a + 1, -1L), cast(array() as array<bigint>)),
              {start}, (acc, i) -> {step.format(down)})))"""
    walk_up = up.replace("x.", "y.x.")
    return f"""element_at(transform({sums}, y -> aggregate(sequence(y.x.a, y.x.b),
        named_struct('w', if(y.x.a < y.x.mode, y.down.w, 1D), 's', 0D, 'v', y.x.a),
        (acc, i) -> named_struct('w', if(i < y.x.b, acc.w * ({walk_up}), 0D),
                                 's', acc.s + acc.w,
                                 'v', if(acc.s < y.x.u * (1 + y.up + y.down.s), i, acc.v))).v), 1)"""


def _left_counts() -> Column:
    """What a node's left half gets of each source: ``counts`` drawn ``take`` balls in all."""
    draw = hypergeometric_sql("z.m", "c", "z.n", "z.u")
    return F.expr(f"""aggregate(counts,
        named_struct('m', aggregate(counts, 0L, (s, c) -> s + c), 'n', take, 'out', cast(array() as array<bigint>)),
        (acc, c) -> element_at(transform(array(named_struct('m', acc.m, 'n', acc.n, 'u',
                (pmod(xxhash64({SEED}, shard, shards, size(acc.out)), {1 << 52}L) + 0.5D) / {float(1 << 52)}D)),
            z -> element_at(transform(array({draw}), v -> named_struct(
                'm', z.m - c, 'n', z.n - v, 'out', concat(acc.out, array(v)))), 1)), 1)).out""")


def splitting_tree(counts: DataFrame, n_shards: int) -> DataFrame:
    """Quotas ``(shard, idx, quota)`` from ``(idx, draws)``, for ``n_shards`` shards.

    ``counts`` has one row per source; ``idx`` runs from 0 without gaps.
    """
    nodes = counts.agg(F.array_sort(F.collect_list(F.struct("idx", "draws"))).alias("c")).select(
        F.lit(0).alias("shard"), F.lit(n_shards).alias("shards"),
        F.col("c.draws").cast("array<bigint>").alias("counts"))
    for level in range(math.ceil(math.log2(max(1, n_shards)))):
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c)
        half = F.floor(F.col("shards") / 2).cast("int")
        nodes = (nodes.withColumn("half", half)
                 .withColumn("take", F.when(F.col("shards") > 1, F.round(total * F.col("half")
                                            / F.col("shards"))).otherwise(0).cast("bigint"))
                 .withColumn("left", _left_counts())
                 .withColumn("child", F.explode(F.filter(F.array(
                     F.struct(F.col("shard"), F.col("half").alias("shards"),
                              F.col("left").alias("counts")),
                     F.struct((F.col("shard") + F.col("half")).alias("shard"),
                              (F.col("shards") - F.col("half")).alias("shards"),
                              F.zip_with("counts", "left", lambda c, x: c - x).alias("counts"))),
                     lambda n: n["shards"] > 0)))
                 .select("child.*"))
        if level % 6 == 5:                    # enough nodes to share among tasks
            nodes = nodes.repartition("shard")
    return nodes.select("shard", F.posexplode("counts").alias("idx", "quota"))


def mix(rows: DataFrame, name: str = "mix") -> DataFrame:
    """``rows`` (see ``sized``) with ``source_size``, ``target``, ``taken`` and ``shards``.

    ``shards`` lists the output shard of each copy, sorted.
    """
    rows = written(rows, f"{name}-sizes")
    sources = written(targets(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"))), f"{name}-sources")
    placed, blocks = block_table(rows, sources)
    blocks = written(blocks, f"{name}-blocks")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    n_shards = max(1, math.ceil(total / SHARD_WORDS))
    quotas = splitting_tree(
        sources.select("idx").join(blocks.groupBy("idx").agg(F.sum("copies").alias("draws")), "idx")
        .select("idx", "draws"), n_shards)
    before = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = (quotas.filter("quota > 0")
             .withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)))
             .select("idx", "shard", F.explode(F.expr("sequence(start, start + quota - 1)")).alias("rank")))
    draws = (blocks.filter("copies > 0")
             .select("idx", "block", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
                     F.lit(1).alias("one")))
    draws = _ranked(draws, "idx", F.xxhash64(F.lit(SEED + 2), "idx", "block", "copy"),
                    ["block", "copy"], "one")
    dealt = (draws.join(slots, ["idx", "rank"]).groupBy("idx", "block")
             .agg(F.array_sort(F.collect_list("shard")).alias("shards")))
    none = F.array().cast("array<int>")
    return (placed.join(dealt, ["idx", "block"], "left")
            .withColumn("shards", F.coalesce("shards", none))
            .withColumn("taken", F.col("size") * F.size("shards"))
            .select("doc_id", "key", "size", "source_size", "target", "taken", "shards"))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  source: str = "source") -> DataFrame:
    """The rows of the mix: ``docs``' columns, a row per copy, shard by shard in hash order."""
    mixed = mix(sized(docs, doc_id, text, source))
    key, shards, copy, shard = (unused(docs, x) for x in ("__key", "__shards", "__copy", "__shard"))
    copies = (mixed.groupBy("key").agg(F.first("shards").alias(shards))
              .filter(F.size(shards) > 0).withColumnRenamed("key", key))
    out = (docs.withColumn(key, row_key(doc_id, text)).join(copies, key)
           .select("*", F.posexplode(shards).alias(copy, shard)))
    order = F.xxhash64(F.lit(SEED + 3), shard, key, copy)
    return out.repartition(shard).sortWithinPartitions(shard, order).drop(key, shards, copy, shard)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes, and the shards its copies go to."""
    return mix(sized(read(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", F.col("target").cast("double"),
        F.col("taken").cast("long"), "shards")
