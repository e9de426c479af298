"""Vector codes, SimHash components and token alignment against plain versions, edge cases included."""

import collections
import hashlib
import math
import re

import duckdb
import numpy as np
import pytest
import xxhash

from cardwatch.llm import alignment, simhash, vector_codes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<float>, label int, code string, id int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- vector codes ----------------------------------------------------------------

def plain_codes(vectors, parts, entries, rounds, scale):
    """Codes, errors and codebooks by comparing every part with every entry in whole numbers."""
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if good(v)]
    width = -(-max(len(v) for _, v in kept) // parts)
    kept = [(i, v + [0] * (parts * width - len(v))) for i, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [(i, [v[j * width:(j + 1) * width] for j in range(parts)]) for i, v in kept]
    books = [[p[j] for _, p in cut[:entries]] for j in range(parts)]

    def assign(j, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[j]))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, p in cut:
            for j in range(parts):
                members[j, assign(j, p[j])[1]].append(p[j])
        for (j, k), held in members.items():
            books[j][k] = [sum(c) // len(held) for c in zip(*held)]
    out = []
    for i, p in cut:
        found = [assign(j, p[j]) for j in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


@pytest.mark.parametrize("size, parts, entries", [(64, 16, 64), (21, 4, 5), (3, 16, 8), (96, 2, 64)])
def test_codes_equal_plain_ones(spark, size, parts, entries):
    rng = np.random.default_rng(size)
    data = [(int(i), rng.normal(0, 1, size).round(2).tolist()) for i in rng.permutation(150)]
    data += [(3, data[0][1]), (3, data[5][1]), (None, data[7][1]), (900, None), (901, [float("nan")] * size),
             (902, [float("inf")] + [0.0] * (size - 1)), (903, data[1][1][:size - 2]), (904, []),
             (-5, [None] + [0.0] * (size - 1)), (905, [0.0] * size), (906, [0.0] * size)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in data], VECTORS).repartition(3)
    books = vector_codes.train(df, parts=parts, entries=entries)
    got = rows(vector_codes.encode(df.select("vec_id", "embedding"), books))
    want, plain = plain_codes([(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v])
                               for i, v in data], parts, entries, 2, vector_codes.SCALE)
    assert books.entries.tolist() == plain
    assert got == sorted(want, key=repr)


def test_codes_keep_other_columns_and_take_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0] * 16, None, "old", 7), (2, None, 1, "old", 8)], VECTORS)
    coded = vector_codes.encode(df, vector_codes.train(df))
    assert coded.columns == ["vec_id", "label", "id", "code", "error"]
    assert rows(coded) == [(1, None, 7, "00" * 16, 0)]
    assert vector_codes.train(df.limit(0)) is None
    assert vector_codes.train(df.filter("vec_id = 2")) is None


def test_components_beyond_the_exact_range_are_an_error(spark):
    df = spark.createDataFrame([(1, [3e37] * 16, 0, "", 0), (2, [0.0] * 16, 0, "", 0)], VECTORS)
    with pytest.raises(Exception, match="too large"):
        vector_codes.train(df)


def test_transform_scales_distances_and_is_in_sequency_order():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 7, 16):
        a, b = rng.integers(-99, 99, (2, 5, n))
        scaled = ((vector_codes.transform(a) - vector_codes.transform(b)) ** 2).sum(axis=1)
        width = 1 << (n - 1).bit_length()
        assert (scaled == width * ((a - b) ** 2).sum(axis=1)).all()
        basis = vector_codes.transform(np.eye(width, dtype=np.int64)).T
        assert [int((np.diff(row) != 0).sum()) for row in basis] == list(range(width))


def test_nearest_takes_the_lower_index_of_ties():
    entries = vector_codes.transform(np.array([[5, 5], [1, 0], [0, 1], [1, 0]]))
    index, far = vector_codes.nearest(vector_codes.transform(np.array([[0, 0], [1, 0], [6, 5]])), entries)
    assert index.tolist() == [1, 1, 0] and (far // 2).tolist() == [1, 0, 1]


def test_op11_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(vector_codes.ORACLE)
    names = [c[0] for c in want.description]
    got = vector_codes.op11_vector_codes(spark, sf_dir)
    assert got.columns == names and rows(got) == sorted(want.fetchall(), key=repr)


# -- SimHash ------------------------------------------------------------------------

def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, values, radius=3):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(values))]


TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ÀÉ two THREE four\x0bfive"),
         (8, "a b c d e f g " * 9), (9, "a b c d e f g " * 9), (9, "a b c d e f g " * 9), (None, "a b c d e f g " * 9),
         (None, "all alone here with other words"), (11, "é☃😀 " * 400_000 + "tail"), (12, "x" * 3_000_000)]


def test_fingerprints_equal_plain_ones(monkeypatch):
    texts = [t for _, t in TEXTS]
    want = [plain_fingerprint(t) for t in texts]
    assert [int(x) % (1 << 64) for x in simhash.fingerprints_of(texts)] == want
    monkeypatch.setattr(simhash, "RUN", 7)
    monkeypatch.setattr(simhash, "HASHES", 5)
    short = [t if t is None else t[:200] for t in texts]
    assert [int(x) % (1 << 64) for x in simhash.fingerprints_of(short)] == list(map(plain_fingerprint, short))


def test_op12_edge_rows(spark):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in TEXTS], "doc_id long, text string, fingerprint string, u int")
    values = [plain_fingerprint(t) for _, t in TEXTS]
    ids = plain_components([i for i, _ in TEXTS], values)
    want = sorted(((i, f"{v:016x}", c) for (i, _), v, c in zip(TEXTS, values, ids)), key=repr)
    assert rows(simhash.near_duplicates(df)) == want
    assert rows(simhash.near_duplicates(df.limit(0))) == []


@pytest.mark.parametrize("limit, depth", [(512, 3), (4, 3), (4, 0), (2, 1)])
def test_components_of_clustered_fingerprints(spark, limit, depth):
    """A dense cluster, chains of links and random values; small shards are cut anew and in pieces."""
    rng = np.random.default_rng(limit + depth)
    centre = int(rng.integers(1 << 62))
    values = {0, centre}
    values |= {centre ^ sum(1 << int(b) for b in rng.choice(40, rng.integers(1, 9), replace=False)) for _ in range(60)}
    chain = int(rng.integers(1 << 62))
    for i in range(20):
        chain ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        values.add(chain)
    values |= {int(x) for x in rng.integers(1 << 63, size=40, dtype=np.uint64)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    marked = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fingerprint long")
    got = dict(rows(simhash.linked_components(marked, limit=limit, depth=depth)))
    assert [got[v] for v in signed] == plain_components(range(len(values)), values)


def test_tree_search_equals_comparing_all():
    rng = np.random.default_rng(5)
    base = rng.integers(1 << 63, size=4, dtype=np.uint64)
    values = np.unique(base[rng.integers(4, size=500)] ^ (np.uint64(1) << rng.integers(12, size=500).astype(np.uint64))
                       ^ rng.integers(64, size=500).astype(np.uint64))
    buckets = np.sort(rng.integers(3, size=len(values)))
    query, node = simhash.Forest(buckets, values).search(buckets, values, 3)
    far = np.bitwise_count(values[:, None] ^ values[None, :])
    want = np.argwhere((far <= 3) & (buckets[:, None] == buckets[None, :]))
    assert sorted(zip(query.tolist(), node.tolist())) == sorted(map(tuple, want.tolist()))


# -- alignment -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sides():
    return alignment.Sides(alignment.tokenizer_path(alignment.A_FILE), alignment.tokenizer_path(alignment.B_FILE))


def plain_alignment(sides, text):
    """(n_a, n_b, groups, links, digest) by walking over the tokens; None without tokens."""
    if not text:
        return None
    want = (" " + text).encode()

    def spans(ids, spelled):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(spelled[i]), i))
            at = out[-1][1]
        return out

    a = spans(sides.a.encode(" " + text, add_special_tokens=False).ids, sides.a_bytes)
    b = spans(sides.b.encode(text), sides.b_bytes)
    if b"".join(sides.a_bytes[t[2]] for t in a) != want or b"".join(sides.b_bytes[t[2]] for t in b) != want:
        return None
    links = [(x, y) for s, e, x in a for t, f, y in b if s < f and t < e]
    groups, last = [], 0
    for end in sorted({t[1] for t in a} & {t[1] for t in b}):
        groups.append("|".join(",".join(str(t[2]) for t in side if last < t[1] <= end) for side in (a, b)))
        last = end
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def plain_rows(sides, texts):
    found = [plain_alignment(sides, t) for _, t in texts]
    counts = collections.Counter(p for f in found if f for p in set(f[3]))
    highest = collections.Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    return sorted(((i, *f[:3], len(f[3]), sum(counts[p] == highest[p[0]] for p in f[3]), sum(map(counts.get, f[3])),
                    f[4]) if f else (i, 0, 0, 0, 0, 0, 0, "") for (i, _), f in zip(texts, found)), key=repr), counts


ALIGNED = [(1, None), (2, ""), (3, " "), (4, "\n \t\n"), (5, "Plain words, naïve café ☃😀!"), (6, "a▁b"),
           (7, "<|endoftext|> and <s></s><unk> stay text"), (8, "Plain words, naïve café ☃😀!"),
           (8, "Plain words, naïve café ☃😀!"), (None, "  two  spaces it's 12345"), (9, "the the the the cat"),
           (10, "ein Dachbodenfund überraschte"), (11, "b" * 700), (12, "x" + " " * 900 + "y")]


@pytest.mark.parametrize("fan", [64, 1])
def test_op13_edge_rows_and_counts(spark, sides, fan):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in ALIGNED], "doc_id long, text string, slice string, place int")
    want, counts = plain_rows(sides, ALIGNED)
    # One row a partition, so that every text is a slice; with one slice a task its runs are merged in passes.
    found, table = alignment.align(df.repartition(8), radix=3, fan=max(fan, 2))
    assert rows(found) == want
    links = {(r["a_id"], r["b_id"]): r["documents"] for r in alignment.pair_counts(table, len(sides.b_bytes)).collect()}
    assert links == dict(counts)


def test_op13_equals_plain_rows(spark, sf_dir, sides):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
             if len(r["text"] or "") < 3000]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(alignment.align(df)[0]) == plain_rows(sides, texts)[0]


def test_op13_empty_table(spark):
    found, table = alignment.align(spark.createDataFrame([], "doc_id long, text string"))
    assert rows(found) == [] and rows(table) == []


def test_long_texts_in_pieces_have_the_same_tokens(sides, monkeypatch):
    rng = np.random.default_rng(2)
    parts = ["word", "It's", " ", "  ", "\n", "12", "x,", "☃", "überall", "don't", "▁q", "(a)", "--"]
    text = "".join(parts[i] + " " * int(j) for i, j in zip(rng.integers(len(parts), size=3000),
                                                           rng.integers(0, 3, size=3000)))
    whole = sides.encode([text, "short", text[:50]])
    monkeypatch.setattr(alignment, "CHARS", 40)
    assert sides.encode([text, "short", text[:50]]) == whole


def test_both_encoders_of_a_agree(sides):
    """The fast encoder against the one that reads the whole file, in seven places of every 7th code point."""
    points = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b 1{c}2 {c}{c}x{c} ,{c}.\n {c}{c} \t{c}" for c in points]
    texts += [" " * 499 + "x", " " * 5000 + "x", "\n" * 1_000_000, "\u3000" * 3000, "a" * 50_000, ""]
    slow = [e.ids for e in sides.a.encode_batch(texts, add_special_tokens=False)]
    assert [sides.encode_a(t) for t in texts] == slow


def test_merge_of_many_frames_adds_up(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 3)
    rng = np.random.default_rng(3)
    runs, want = [], collections.Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 60, size=25))
        counts = rng.integers(1, 300, size=len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(list(alignment._framed(keys, counts)))
    merged = list(alignment.merge(runs))
    keys = np.concatenate([k for k, _ in merged])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in merged]).tolist())) == dict(want)
