"""Secret scan with multipart credential linking.

Strong parts are reported wherever they stand: assignments of a password,
secret, token or key, access key identifiers, and long runs of hex
digits.  Weak parts are user or client identifiers, endpoints (URLs with a
scheme that takes credentials) and tokens of mixed letters and digits;
alone they are everyday text.  A weak part is reported only if a part that
complements it lies in the same scope, that is with at most ``SCOPE`` code
points between them:

* a weak token needs an identifier (weak or an access key) or an endpoint;
* an identifier or an endpoint needs a secret (strong or a weak token).

The scopes are joined as intervals: parts are entered once per cell of
``SCOPE`` code points that they cover, a cell keeps only the least start
and the greatest end of each class, and a weak part asks the cells its
scope reaches.  No pairs of parts of a document are formed.

Edge cases: null and empty texts have no spans.  Rows that repeat id and
text get the same spans.  Null ids are kept.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, row_key, written
from .spans import find_spans, joined

SCOPE = 200

# The strong parts, with the least length of what they find.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 12
# Runs are maximal, so a least length within the pattern drops the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

IDENT = (r"""(?i:user_?name|user|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?"""
         r"[A-Za-z0-9@._-]{3,64}")
ENDPOINT = (r"(?i:https?|s?ftp|ssh|jdbc:[a-z]{2,16}|mongodb|postgres(?:ql)?|mysql|redis|amqps?)"
            r"""://[^\x20\x09-\x0D"'<>]+""")
_T = "A-Za-z0-9+/_-"
WEAK = (rf"(?<![{_T}])(?=[{_T}]{{20}})(?=[{_T}]*[0-9])(?=[{_T}]*[a-z])(?=[{_T}]*[A-Z])"
        rf"[{_T}]{{20,}}+")

# Kind: order in the result, class of part.
KINDS = {"assign": (0, "secret"), "access": (1, "id"), "hex": (2, "secret"),
         "ident": (3, "id"), "endpoint": (4, "end"), "weak": (5, "secret")}
NEEDS = {"ident": ["secret"], "endpoint": ["secret"], "weak": ["id", "end"]}


def _kind(spans: str, kind: str, condition: str = "true") -> str:
    order, part = KINDS[kind]
    return (f"transform(filter({spans}, s -> {condition}), s -> named_struct('start', s.start, "
            f"'end', s.end, 'rank', {order}, 'kind', '{kind}', 'part', '{part}'))")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, key, base, weak)``: strong and weak parts of every row."""
    found = docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"),
        find_spans(text, ASSIGN, 1).alias("assign"), find_spans(text, ACCESS).alias("access"),
        find_spans(text, HEX).alias("hex"), find_spans(text, IDENT).alias("ident"),
        find_spans(text, ENDPOINT).alias("endpoint"), find_spans(text, WEAK).alias("weak"))
    found = found.select("doc_id", "key", "ident", "endpoint", "weak", F.expr(
        f"concat({_kind('assign', 'assign', f'length(s.g) >= {ASSIGN_LEAST}')}, "
        f"{_kind('access', 'access')}, {_kind('hex', 'hex')})").alias("base"))
    weak = f"concat({_kind('ident', 'ident')}, {_kind('endpoint', 'endpoint')}, {_kind('weak', 'weak')})"
    return found.select("doc_id", "key", "base", F.expr(
        f"filter({weak}, w -> not exists(base, b -> b.start < w.end and b.end > w.start))").alias("weak"))


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(key, linked)``: the weak parts that a complementary part stands by."""
    few = scanned.filter(F.size("weak") > 0)
    parts = few.select("key", F.explode(F.concat("base", "weak")).alias("p")).select("key", "p.*")
    cell = F.explode(F.expr(f"sequence(start div {scope}, (end - 1) div {scope})")).alias("cell")
    cells = (parts.select("key", "part", "start", "end", cell)
             .groupBy("key", "part", "cell").agg(
                 F.min(F.greatest("start", F.col("cell") * scope)).alias("least"),
                 F.max(F.least("end", (F.col("cell") + 1) * scope)).alias("greatest")))
    needs = F.map_from_arrays(F.array(*[F.lit(k) for k in NEEDS]),
                              F.array(*[F.array(*[F.lit(x) for x in v]) for v in NEEDS.values()]))
    asked = (few.select("key", F.explode("weak").alias("w")).select("key", "w.*").distinct()
             .withColumn("need", F.explode(F.element_at(needs, F.col("kind"))))
             .withColumn("at", F.explode(F.expr(
                 f"sequence(greatest(0L, start - {scope}) div {scope}, (end + {scope}) div {scope})"))))
    hit = ((asked["key"] == cells["key"]) & (asked["need"] == cells["part"])
           & (asked["at"] == cells["cell"]) & (cells["least"] <= asked["end"] + scope)
           & (cells["greatest"] >= asked["start"] - scope))
    return (asked.join(cells, hit, "left_semi").groupBy("key")
            .agg(F.collect_set(F.struct("start", "end", "rank", "kind", "part")).alias("linked")))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 scope: int = SCOPE) -> DataFrame:
    """``(doc_id, base, linked)``: arrays of spans for every row."""
    scanned = written(scan(docs, doc_id, text), "secrets-scanned")
    linked = link(scanned, scope)
    return scanned.join(linked, "key", "left").select(
        "doc_id", "base", F.coalesce("linked", F.expr("filter(base, b -> false)")).alias("linked"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the secrets of every document."""
    found = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return (found.withColumn("every", F.concat("base", "linked"))
            .select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                    F.sha2(joined("base", "start rank"), 256).alias("base_sha256"),
                    joined("every", "start rank").alias("spans"),
                    F.size("linked").cast("long").alias("n_linked")))
