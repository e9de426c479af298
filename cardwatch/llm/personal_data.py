"""Personal data: labelers vote, EM weighs them, a span classifier decides.

Spans of the strict patterns (e-mail, IP address, payment card, phone) are
always reported.  Looser candidates, such as national phone numbers,
written-out e-mail addresses, card-like digit runs and identity numbers,
are reported if the trained classifier says so.

1. Labelers vote yes (1), no (0) or abstain (-1) on every candidate, strict
   ones included: by format and checksum (regex), by lists of domains and
   number ranges (gazetteer) and by the words before and the characters
   around a span (context).
2. The votes of the whole corpus are counted per kind and pattern of votes;
   there are finitely many patterns, whatever the corpus.  Expectation
   maximisation for two classes, with votes independent given the class,
   estimates each labeler's rates for a kind and every pattern's probability.
3. A logistic regression is fitted to these probabilities.  It sees what no
   labeler votes on: the shape of the span (runs of letters and digits) and
   the words on both sides of it, hashed, besides kind and length.  So it
   tells apart candidates whose votes are alike.  It scores each candidate as
   a column expression and has the last word.

The driver sees the table of patterns, whose size is bounded by the numbers
of kinds and labelers, and the classifier's training rows,
at most ``FIT_SAMPLE`` candidates of each kind (first by hash), weighted by
the kind's count; reliabilities cover every candidate of the corpus.

Edge cases: null and empty texts have no spans.  Rows that repeat id and
text get the same spans; each counts in the fit.  Null ids are kept.
Without any candidate nothing is fitted.  An empty table gives no rows.
Very long texts are scanned whole; a candidate keeps only 32 characters of
either side.  Equal probabilities need no order: each candidate is decided
by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, row_key, written
from .spans import find_spans, joined

# The strict patterns.  Lookbehinds and possessive repeats only
# keep the search linear; a match starts where a run starts either way.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)

# Looser candidates.
WORDED_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?(?:\(at\)|\[at\]|\{at\})\x20?"
                r"[A-Za-z0-9-]{2,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{2,63}){1,4}")
LOCAL_PHONE = r"(?<![0-9+().-])(?<![0-9+)]\x20)\(?[0-9]{3,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9-])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

KINDS = ("email", "ip", "card", "phone", "email_worded", "card_like", "phone_local", "identity")
STRICT = KINDS[:4]

# Gazetteers and words of context, in the languages of the corpus.
DOMAINS = "com|org|net|edu|gov|info|io|eu|uk|de|fr|es|us"
CARD_RANGES = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
BEFORE = (r"(?i)(?<![A-Za-z])(e-?mail|mail|contact|correo|kontakt|call|phone|tel|fax|mobile|cell|tél|teléfono|"
          r"telefon|anruf|card|visa|mastercard|carte|tarjeta|karte|ssn|social|ip|host|address)"
          r"(?:[\x20:.#=-]+(?:is|me|us|at|on|to|my|our|number|address|le|la|el|al|die|der|am)){0,2}[\x20:.#=-]{0,4}$")
NOT_BEFORE = r"(?i)([$€£#§]|(?<!\p{L})(no\.|nr\.|vol\.|isbn|page|version|v|id|x))[\x20:]?$"

LETTERS = r"\p{L}+"
# What follows a measure or an amount, not a number of a person.
AFTER = r"(?i)^\x20?(%|€|\$|kg|km|cm|mm|ml|mb|gb|eur|usd|units|items|pages)"

LABELERS = ("checksum", "gazetteer", "before", "not_before", "after", "pieces", "format")
LENGTHS = 4
EM_ROUNDS = 50
# What a vote that every candidate gets weighs at the start, against 1 for a rare one.
COMMON = 0.1
FIT_ROUNDS = 150
# Candidates of a kind that the classifier learns from, and its hashed values per feature.
FIT_SAMPLE = 1_000
BUCKETS = 64
HASHED = ("shape", "left", "right")
# Candidates beyond the strict ones need this probability.
ACCEPT = 0.9


def _digits(m: str = "m") -> Column:
    return F.regexp_replace(F.col(m), "[^0-9]", "")


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the Luhn test."""
    digit = f"cast(substring(reverse({digits}), i, 1) as int)"
    return (f"(aggregate(sequence(1, length({digits})), 0, (t, i) -> t + {digit} * (1 + (i + 1) % 2) "
            f"- if(i % 2 = 0 and {digit} > 4, 9, 0)) % 10 = 0)")


def _digits_of(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def _kind(spans: str, kind: str, condition: str = "true") -> str:
    return (f"transform(filter({spans}, s -> {condition}), s -> named_struct('start', s.start, "
            f"'end', s.end, 'rank', {KINDS.index(kind)}, 'kind', '{kind}', 'm', s.m, 'l', s.l, 'r', s.r))")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, key, base, loose)``: strict spans and looser candidates of every row."""
    found = docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"),
        *[find_spans(text, p).alias(k) for k, p in (
            ("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE),
            ("email_worded", WORDED_EMAIL), ("phone_local", LOCAL_PHONE), ("identity", IDENTITY))])
    ip_ok = "not exists(split(s.m, '\\\\.'), x -> cast(x as double) > 255)"
    d = _digits_of("s.m")
    in_range = lambda r: f"length({d}) between {r[0]} and {r[1]}"
    card_ok = f"{in_range(CARD_DIGITS)} and {luhn(d)}"
    base = (f"concat({_kind('email', 'email')}, {_kind('ip', 'ip', ip_ok)}, "
            f"{_kind('card', 'card', card_ok)}, {_kind('phone', 'phone', in_range(PHONE_DIGITS))})")
    card_like = f"{in_range(CARD_DIGITS)} and not {luhn(d)}"
    loose = (f"concat({_kind('email_worded', 'email_worded')}, {_kind('card', 'card_like', card_like)}, "
             f"{_kind('phone_local', 'phone_local')}, {_kind('identity', 'identity')})")
    found = found.withColumn("base", F.expr(base)).withColumn("loose", F.expr(loose))
    return found.select("doc_id", "key", "base", F.expr(
        "filter(loose, w -> not exists(base, b -> b.start < w.end and b.end > w.start))").alias("loose"))


def votes(scanned: DataFrame) -> DataFrame:
    """One row per candidate with the labelers' votes and its length class."""
    c = (scanned.select("key", F.explode(F.concat("base", "loose")).alias("c")).select("key", "c.*")
         .withColumn("d", _digits()))
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    digits = F.length("d")
    is_mail = F.col("kind").startswith("email")
    is_card = F.col("kind").isin("card", "card_like")
    luhn_ok = F.expr(luhn("d"))
    known = F.col("m").rlike(rf"(?i)[.\])}}\x20]({DOMAINS})$")
    area = F.col("d").rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$") | F.col("m").startswith("+")
    same = F.col("d").rlike(r"^(\d)\1*$") | F.lit("01234567890123456789").contains(F.col("d"))
    return c.select(
        "key", "start", "end", "rank", "kind",
        F.when(is_card, vote(luhn_ok, ~luhn_ok)).when(F.col("kind") == "identity", vote(
            ~F.col("d").rlike("^(000|666|9..)|^...00|0000$"), F.lit(True)))
        .otherwise(-1).alias("checksum"),
        F.when(is_mail, vote(known, ~known)).when(is_card, vote(
            F.col("d").rlike(CARD_RANGES), ~F.col("d").rlike(CARD_RANGES)))
        .when(F.col("kind").startswith("phone"), vote(area, ~area))
        .when(F.col("kind") == "ip", vote(~F.col("m").rlike(r"^(0|127|255)\."),
                                          F.col("m").rlike(r"^(0|127|255)\."))).otherwise(-1)
        .alias("gazetteer"),
        F.when(F.col("l").rlike(BEFORE), 1).otherwise(-1).alias("before"),
        F.when(F.col("l").rlike(NOT_BEFORE), 0).otherwise(-1).alias("not_before"),
        F.when(F.col("r").rlike(AFTER), 0).otherwise(-1).alias("after"),
        F.when(is_mail, vote(F.col("m").rlike("[A-Za-z]{2}"), ~F.col("m").rlike("[A-Za-z]{2}")))
        .otherwise(F.when(same, 0).otherwise(-1)).alias("pieces"),
        _format().alias("format"),
        F.when(is_mail, F.least(F.lit(LENGTHS - 1), F.floor(F.length("m") / 16)))
        .otherwise(F.when(digits < 8, 0).when(digits < 12, 1).when(digits < 16, 2).otherwise(3))
        .cast("int").alias("length"),
        bucket(F.regexp_replace(F.regexp_replace(F.regexp_replace(
            "m", "[A-Z]+", "A"), "[a-z]+", "a"), "[0-9]+", "9")).alias("shape"),
        # A word that a labeler votes on is left out, or the classifier would only learn that vote again.
        bucket(F.when(F.col("l").rlike(BEFORE) | F.col("l").rlike(NOT_BEFORE), "").otherwise(
            F.lower(F.regexp_extract("l", rf"({LETTERS})[^\p{{L}}]*$", 1)))).alias("left"),
        bucket(F.when(F.col("r").rlike(AFTER), "").otherwise(
            F.lower(F.regexp_extract("r", rf"^[^\p{{L}}]*({LETTERS})", 1)))).alias("right"))


def _format() -> Column:
    """The vote of the layout: like separators and groups speak for a span, mixed ones against it."""
    m, kind = F.col("m"), F.col("kind")
    vote = lambda yes: F.when(yes, 1).otherwise(0)
    separators = F.array_distinct(F.split(F.regexp_replace(m, r"[^\x20.-]", ""), ""))
    return (F.when(kind.isin("card", "card_like"), vote(m.rlike(r"^(\d{16}|\d{4}([\x20-])\d{4}\2\d{4}\2\d{4})$")))
            .when(kind == "phone", vote(F.size(separators) <= 2))
            .when(kind == "phone_local", vote(m.startswith("(") | (F.size(separators) == 1)))
            .when(kind == "ip", vote(~m.rlike(r"(^|\.)0[0-9]")))
            .when(kind == "email_worded", vote(m.rlike(r"(?i)[(\[{]at[)\]}]")
                                               & m.rlike(r"(?i)[(\[{]dot[)\]}]|[a-z]\.[a-z]")))
            .otherwise(-1))


def bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict], list[float]]:
    """EM over counted vote patterns: prior, per labeler vote rates by class, pattern probabilities.

    Starts from the share of yes among a pattern's votes, a vote weighing the
    more the rarer it is: one that all candidates get tells nothing apart.
    Rates are smoothed by one vote.
    """
    n = len(patterns[0][0]) if patterns else 0
    share = {(j, x): sum(c for v, c in patterns if v[j] == x) / sum(c for _, c in patterns)
             for j in range(n) for x in (0, 1)}
    prob = []
    for v, _ in patterns:
        cast = [(x, 1 + COMMON - share[j, x]) for j, x in enumerate(v) if x >= 0]
        yes, every = sum(w for x, w in cast if x), sum(w for _, w in cast)
        prob.append(min(0.95, max(0.05, (yes + 0.5) / (every + 1))))
    prior, rates = 0.5, []
    for _ in range(EM_ROUNDS):
        total = sum(c for _, c in patterns)
        yes = sum(p * c for p, (_, c) in zip(prob, patterns))
        prior = min(0.99, max(0.01, yes / total)) if total else 0.5
        rates = []
        for j in range(n):
            rate = {}
            for x in (-1, 0, 1):
                a = sum(p * c for p, (v, c) in zip(prob, patterns) if v[j] == x)
                b = sum((1 - p) * c for p, (v, c) in zip(prob, patterns) if v[j] == x)
                rate[x] = ((a + 1) / (yes + 3), (b + 1) / (total - yes + 3))
            rates.append(rate)
        prob = []
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(rates[j][x][0] / rates[j][x][1]) for j, x in enumerate(v))
            prob.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return prior, rates, prob


def _features(kind: str, length: int, hashed: tuple[int, ...]) -> list[str]:
    return ["bias", f"kind={kind}", f"length={length}", *[f"{name}={x}" for name, x in zip(HASHED, hashed)]]


def fit(rows: list[tuple]) -> dict[str, float]:
    """Logistic regression on soft labels: weights by feature, from (kind, length, hashed, weight, label)."""
    rows = [(_features(k, n, h), c, y) for k, n, h, c, y in rows]
    names = sorted({f for features, _, _ in rows for f in features})
    at = {f: i for i, f in enumerate(names)}
    x = [([at[f] for f in features], c, y) for features, c, y in rows]
    total = sum(c for _, c, _ in x) or 1
    w = [0.0] * len(names)
    rate = [0.0] * len(names)
    for _ in range(FIT_ROUNDS):              # Adagrad steps
        grad = [1e-4 * wi for wi in w]
        for f, c, y in x:
            z = sum(w[i] for i in f)
            e = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) * c / total
            for i in f:
                grad[i] += e
        for i, g in enumerate(grad):
            rate[i] += g * g
            w[i] -= 0.5 * g / math.sqrt(rate[i] + 1e-12)
    return dict(zip(names, w))


def probability(weights: dict[str, float]) -> Column:
    """The classifier as a column expression over a row of ``votes``.

    A hashed value that it never saw adds nothing.
    """
    z = F.lit(weights.get("bias", 0.0))
    for name, w in sorted(weights.items()):
        column, _, value = name.partition("=")
        if name != "bias" and column not in HASHED:
            value = value if column == "kind" else int(value)
            z = z + F.when(F.col(column) == value, w).otherwise(0.0)
    for column in HASHED:
        table = F.array(*[F.lit(weights.get(f"{column}={i}", 0.0)) for i in range(BUCKETS)])
        z = z + F.element_at(table, F.col(column) + 1)
    return 1 / (1 + F.exp(-z))


def train(cast: DataFrame) -> tuple[dict[str, float], dict[tuple, float]]:
    """The classifier's weights and the aggregated votes' probability by (kind, votes)."""
    # At most len(KINDS) * 3 ** len(LABELERS) rows, whatever the corpus.
    counted = cast.groupBy("kind", *LABELERS).count().orderBy("kind", *LABELERS).collect()
    voted: dict[tuple, float] = {}
    for kind in KINDS:
        patterns = [(tuple(r[x] for x in LABELERS), r["count"]) for r in counted if r["kind"] == kind]
        voted.update({(kind, v): p for (v, _), p in zip(patterns, estimate(patterns)[2])})
    totals: dict[str, int] = {}
    for r in counted:
        totals[r["kind"]] = totals.get(r["kind"], 0) + r["count"]
    rows = []
    for kind, total in sorted(totals.items()):
        # At most FIT_SAMPLE rows a kind.
        sample = (cast.filter(F.col("kind") == kind).orderBy(F.xxhash64("key", "start"), "key", "start")
                  .select("length", *LABELERS, *HASHED).limit(FIT_SAMPLE).collect())
        for r in sample:
            v = tuple(r[x] for x in LABELERS)
            rows.append((kind, r["length"], tuple(r[x] for x in HASHED), total / len(sample), voted[kind, v]))
    return fit(rows), voted


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, base, added)``: arrays of spans for every row."""
    scanned = written(scan(docs, doc_id, text), "personal-scanned")
    cast = written(votes(scanned), "personal-votes")         # a row per candidate
    weights, _ = train(cast)
    loose = ~F.col("kind").isin(*STRICT)
    added = (cast.filter(loose).withColumn("p", probability(weights)).filter(F.col("p") >= ACCEPT)
             .groupBy("key").agg(F.collect_set(F.struct("start", "end", "rank", "kind")).alias("added")))
    base = F.expr("transform(base, s -> struct(s.start as start, s.end as end, s.rank as rank, s.kind as kind))")
    return scanned.select("doc_id", "key", base.alias("base")).join(added, "key", "left").select(
        "doc_id", "base", F.coalesce("added", F.expr("filter(base, b -> false)")).alias("added"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the personal data of every document."""
    found = find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return (found.withColumn("every", F.concat("base", "added"))
            .select("doc_id", *[count(k).alias(f"n_{k}") for k in STRICT],
                    F.sha2(joined("base", "rank start"), 256).alias("base_sha256"),
                    joined("every", "rank start").alias("spans"),
                    F.size("added").cast("long").alias("n_added")))
