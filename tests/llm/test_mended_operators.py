"""What round three mended in earlier operators: chunks, large components, hubs, samples per language."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import components, decontaminate, language_id, line_dedup, ngram_join, personal_data, sharding
from tests.conftest import explain_text


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scores_do_not_depend_on_the_number_of_chunks(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 120")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = items.unionByName(items.limit(1)).unionByName(
        spark.createDataFrame([(None, "no id here at all"), (7, None), (8, "")], "item_id long, text string"))
    one = rows(decontaminate.contaminated(docs, items))
    assert one
    monkeypatch.setattr(decontaminate, "ITEMS_PER_INDEX", items.count() // 7 + 1)
    assert rows(decontaminate.contaminated(docs, items)) == one


def test_differences_give_the_links_of_whole_sets():
    """Blocks of a large component, within and across, against plain Jaccard similarities."""
    import pandas as pd
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        words = list(base)
        for j in rng.integers(0, 60, size=i % 5):
            words[j] = f"x{rng.integers(9)}"
        texts.append(" ".join(words if i % 11 else words[:int(rng.integers(3, 60))]))
    texts = sorted(set(texts))
    sets = [set(ngram_join.shingle_hashes(t).tolist()) for t in texts]
    n = len(texts)
    plain = np.array([[i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)]
                      for i, a in enumerate(sets)])
    digests, copies = [bytes([i]) * 16 for i in range(n)], list(range(1, n + 1))
    got, packs = np.zeros(n, dtype=np.int64), []
    for block in range(2):
        mine = [i for i in range(n) if i % 2 == block]
        frame = pd.DataFrame([(digests[i], copies[i], texts[i], False, b"r", block) for i in mine]
                             + [(digests[0], 1, texts[0], True, b"r", block)],
                             columns=["digest", "copies", "text", "first", "root", "block"])
        out = ngram_join.differences(0.8)(frame)
        packs.append(out.loc[out["pack"].notna(), "pack"].iloc[0])
        for d, links in out.loc[out["pack"].isna(), ["digest", "links"]].itertuples(index=False):
            got[d[0]] += links
    for out in ngram_join.cross_verifier(0.8)(iter([pd.DataFrame({"left": packs[:1], "right": packs[1:]})])):
        for d, links in out[["digest", "links"]].itertuples(index=False):
            got[d[0]] += links
    assert got.tolist() == (plain @ np.array(copies)).tolist() and got.any()


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1050)] + [(2000, 1050)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**{i: 0 for i in range(1, 300)}, **{i: 1000 for i in range(1001, 1051)}, 2000: 1000}
    plan_rows = components._with_least(spark.createDataFrame(edges, "u long, v long"))
    assert plan_rows.filter("u = 0").agg(F.min("m")).first()[0] == 1


@pytest.mark.parametrize("budget", [0, components.BROADCAST_BYTES])
def test_rounds_of_components_are_few_and_cheap(spark, monkeypatch, budget):
    tables, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or written(df, name))
    monkeypatch.setattr(components, "BROADCAST_BYTES", budget)
    stars = [(str(i % 7), f"x{i}") for i in range(70)] + [("0", "0"), (None, "0"), ("0", None)]
    got = rows(components.components(spark.createDataFrame(stars, "u string, v string")))
    assert sorted(got) == sorted((f"x{i}", str(i % 7)) for i in range(70))
    assert len(tables) == 1                       # nothing to do: no round
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (380, 2))] + [(1000, i) for i in range(500, 800)]
    least = {x: x for e in edges for x in e}
    while True:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    df = spark.createDataFrame(edges, "u long, v long")
    assert dict(rows(components.components(df))) == {x: r for x, r in least.items() if x != r}
    plan = explain_text(components._small_star(components._large_star(df)), "simple")
    assert plan.count("Exchange hashpartitioning") <= 10      # with those used twice


def test_every_language_is_sampled(spark, monkeypatch):
    text = " ".join("abcdefgh"[i % 8] * 3 for i in range(40))
    data = [(str(i), f"{text} {i}", "common" if i % 40 else "rare") for i in range(400)]
    data += [(f"s{i}", "short", "rare") for i in range(50)]
    df = spark.createDataFrame(data, "key string, text string, lang string")
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 6)
    counts = dict(rows(language_id.sampled(df, {"common": 390, "rare": 60}).groupBy("lang").count()))
    assert counts["common"] == 6 and counts["rare"] >= 1


def test_equal_rows_go_to_different_shards(spark):
    """Three copies of a text, and a third of all rows alike, over a limit that holds two of either."""
    data = [(1, "x" * 65)] * 3 + [(None, "y" * 60)] * 40 + [(i, "z" * 20) for i in range(2, 80)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    sized = docs.select("doc_id", sharding.hash_bits().alias("h"), sharding.text_bytes().alias("bytes"))
    h = [r.h for r in sharding.numbered(sized).collect()]
    assert len(set(h)) == len(h) == len(data)
    assert {r.h for r in sized.collect()} <= set(h)              # the first copies keep their hash
    out = sharding.shard_documents(docs.withColumn("fits", F.lit("mine")), limit=130, with_fits=True)
    assert out.columns == ["doc_id", "text", "fits", "shard"]
    got = out.groupBy("shard").agg(F.sum(F.length("text")).alias("n"), F.first("fits").alias("fits")).collect()
    assert all(r.n <= 130 and r.fits for r in got)
    assert rows(out.select("doc_id", "text")) == sorted(data, key=repr)
    alone = sharding.shard_documents(docs, limit=64, with_fits=True)
    assert alone.filter("not fits").groupBy("shard").count().agg(F.max("count")).first()[0] == 1
    assert alone.filter("not fits").count() == 3


def test_repeated_windows_go_and_others_stay(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "d\ne\nf"), (3, "a\nb\nc\ng")], "doc_id long, text string")
    assert rows(line_dedup.dedup_lines(docs).select("doc_id", "n_removed", "text")) == [
        (1, 0, "a\nb\nc"), (2, 0, "d\ne\nf"), (3, 3, "g")]


def test_classifier_beats_the_vote_on_planted_spans(spark):
    """Telephone numbers and stock numbers of one layout; only some have a word that a labeler knows.

    Votes alone cannot tell the others apart; the words beside them can.
    """
    rng = np.random.default_rng(10)
    data, true = [], set()
    neutral = ["with", "under", "using", "then", "also", "just", "please", "take"]
    for i in range(240):
        number = f"{rng.integers(200, 999)} {rng.integers(200, 999)} {rng.integers(1000, 9999)}"
        person, known = i % 2 == 0, i % 4 < 2
        if person:
            text = f"you can {'phone' if known else rng.choice(neutral)} {number} evenings"
            true.add(i)
        else:
            text = f"the lot {'no.' if known else rng.choice(neutral)} {number} crates"
        data.append((i, text))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    scanned = personal_data.scan(docs)
    cast = personal_data.votes(scanned)
    weights, voted = personal_data.train(cast)
    ids = scanned.select("doc_id", "key")
    got = cast.withColumn("p", personal_data.probability(weights)).join(ids, "key").collect()
    assert len(got) == 240
    vote = {r.doc_id: voted[r.kind, tuple(r[x] for x in personal_data.LABELERS)] for r in got}
    model = {r.doc_id: r.p for r in got}

    def quality(p):
        said = {i for i, x in p.items() if x >= personal_data.ACCEPT}
        return len(said & true) / max(1, len(said)), len(said & true) / len(true)

    precision, recall = quality(model)
    vote_precision, vote_recall = quality(vote)
    print("classifier", precision, recall, "vote", vote_precision, vote_recall)
    assert precision > 0.95 and recall > 0.95
    assert min(precision, recall) > min(vote_precision, vote_recall) + 0.2


def test_personal_spans_are_added(spark):
    """Spans beyond the strict patterns reach the result, of whole texts and with null and repeated rows."""
    rows_ = [(i, f"please phone {200 + i} 555 {1000 + i} at home") for i in range(40)]
    rows_ += [(100, "x " * 40_000 + "phone 212 555 0147 " + "y " * 40_000), (100, None), (None, "")]
    docs = spark.createDataFrame(rows_ + rows_[:2], "doc_id long, text string").withColumn("key", F.lit(1))
    got = personal_data.find_personal_data(docs).select(
        "doc_id", F.size("base").alias("n"), personal_data.joined("added", "rank start").alias("s")).collect()
    assert len(got) == len(rows_) + 2 and all(r.n == 0 for r in got)
    spans = {(r.doc_id, r.s) for r in got}
    assert {(0, "phone_local:13:25"), (100, "phone_local:80006:80018"), (100, ""), (None, "")} <= spans
