"""The corpus pipeline stage by stage against plain versions, and its edge cases."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwatch.llm import decontaminate, language_id, mixing, sharding
from cardwatch.llm.common import row_key, written
from tests.llm.test_operators import EDGE, SCHEMA, plain_links, water_level


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(input, output) of every stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, docs, sf_dir), "test-stage")
        out.append((docs, kept))
        docs = kept
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination",
        "mixing sources to target weights", "sharding"]


def test_columns_and_whole_rows(stages):
    for k, (before, after) in enumerate(stages):
        assert after.columns == before.columns + (["shard"] if k == 4 else [])
        assert after.select(before.columns).subtract(before).isEmpty()


def test_language_stage_keeps_text_in_a_language(stages):
    before, after = stages[0]
    texts = {r.doc_id for r in before.collect() if r.text and any(c.isalpha() for c in r.text)}
    model = language_id.train(before)
    sure = {int(r.key) for r in language_id.identify(
        before.withColumn("key", F.col("doc_id").cast("string")), model).collect()
        if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    assert {r.doc_id for r in after.collect()} == sure and sure <= texts


def test_language_stage_rejects_what_is_in_no_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = np.random.default_rng(8)
    noise = [" ".join("".join(rng.choice(list(letters), 6)) for _ in range(n))
             for letters in ("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω") for n in (20, 200)]
    clean = {r.lang: r.text for r in docs.filter("n_chars > 600 and lang is not null")
             .orderBy("doc_id").collect()}
    mixed = [" ".join(" ".join(clean[x].split()[:60]) for x in pair)
             for pair in itertools.combinations(sorted(clean), 2)]
    planted = spark.createDataFrame(
        [(10_000_000 + i, t, None, "x", len(t)) for i, t in enumerate(noise + mixed)], SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(
        spark, docs.unionByName(planted), sf_dir).collect()}
    assert not kept & set(range(10_000_000, 10_000_000 + len(noise)))
    assert kept >= set(range(10_000_000 + len(noise), 10_000_000 + len(noise + mixed)))


def test_one_of_each_near_duplicate_class(stages):
    before, after = stages[1]
    linked = plain_links([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c, _ in linked})


def test_no_document_with_a_test_item_stays(spark, sf_dir, stages):
    before, after = stages[2]
    items = [" ".join(decontaminate.words_of(r.text))
             for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before.collect()
             if not any(i in " ".join(decontaminate.words_of(r.text)) for i in items)}
    assert {r.doc_id for r in after.collect()} == clean and after.count() < before.count()


def test_mix_takes_near_the_targets(stages):
    before, after = stages[3]
    count = lambda rows: collections.Counter({
        s: sum(r.n for r in rows if r.source == s) for s in {r.source for r in rows}})
    words = mixing.word_count("text").alias("n")
    sizes, taken = (count(x.select("source", words).collect()) for x in (before, after))
    want = water_level(dict(sizes))
    assert all(abs(taken[s] - t) <= 0.25 * t for s, t in want.items())
    assert max(r["count"] for r in after.groupBy("doc_id").count().collect()) <= 3


def test_every_row_gets_its_shard(stages):
    before, after = stages[4]
    assert sorted(after.drop("shard").collect(), key=str) == sorted(before.collect(), key=str)
    sized = before.select(row_key().alias("key"), sharding.hash_bits().alias("h"),
                          sharding.text_bytes().alias("bytes"))
    want = {(r.key, r.shard) for r in sharding.assign(sized).select("key", "shard").collect()}
    assert {tuple(r) for r in after.select(row_key(), "shard").collect()} == want


@pytest.mark.parametrize("rows", [[], EDGE], ids=["empty", "edge"])
def test_stages_take_odd_tables(spark, sf_dir, rows):
    docs = (spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("size", F.lit("x"))
            .withColumn("__key", F.lit(2)).withColumn("shards", F.lit(3)))
    docs = written(docs, "test-odd")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, sf_dir), "test-odd")
        assert out.columns == docs.columns + (["shard"] if k == 4 else [])
        assert not rows or 0 < out.count() <= 3 * docs.count()
        docs = out
    assert rows or docs.count() == 0


def test_run_is_the_stages_in_order(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(got.collect(), key=str) == sorted(stages[-1][1].collect(), key=str)


def test_tasks_need_no_installed_package():
    """What tasks run is pickled by value, so executors do not import the package."""
    import pickletools

    from pyspark import cloudpickle

    from cardwatch.llm import class_lm, ngram_join, quality
    for function in (class_lm.block_batches, ngram_join.signer(2, 3), ngram_join.verifier(0.8),
                     quality.count_batches, language_id.counter(["en"]),
                     decontaminate.searcher(decontaminate.Index([(1, "a b c")]), 0.5, 0.5, 0.5)):
        names = [arg for op, arg, _ in pickletools.genops(cloudpickle.dumps(function))
                 if op.name in ("GLOBAL", "SHORT_BINUNICODE", "BINUNICODE")]
        strings = "\n".join(str(n) for n in names)
        assert "subimport\ncardwatch" not in strings
