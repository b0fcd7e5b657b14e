"""Secrets in texts: fixed patterns, and strings that a character Markov model finds random.

Patterns are scanned by the JVM's regular expressions. ``split`` gives the gaps between the matches of
``regexp_extract_all``; running sums over gaps and matches of one text give code-point positions. Only matches are
shuffled, never texts.

The random model is trained on the values that the patterns find in all documents, the ordinary one on the long words of
all documents that no pattern touches; of equal texts each weighs its part, so that together they count once. Both are first-order Markov chains over a fixed alphabet,
smoothed towards their character frequencies; at most alphabet squared counts reach the driver. A further run of ``MIN_RUN`` or more token
characters is a secret if the log-likelihood ratio for random exceeds ``MIN_RATIO`` in all and ``MIN_MEAN`` for each
transition, and if it overlaps no span of the patterns. Base spans always stay.

NULL and empty texts have no spans. Repeated rows and ids are answered row by row. With no document that has a
pattern the random model is flat and adds nothing. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import text_of
from riskgraph.operators.lineage import cut

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
MIN_RUN, MIN_RATIO, MIN_MEAN = 16, 12.0, 0.6
PRIOR = 200.0  # pseudo-counts of the character frequencies behind each row; rare contexts, also of stray secrets, stay near them
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
WORD = r"[A-Za-z0-9+/_=-]{6,}"


def _matches(text: Column, kind: int, pattern: str, value_group: int = 0) -> Column:
    """Array of (kind, number, gap, length, value): the leftmost non-overlapping matches and what lies before each."""
    regex = F.lit(pattern)
    found, values = F.regexp_extract_all(text, regex, F.lit(0)), F.regexp_extract_all(text, regex, F.lit(value_group))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    lengths = F.transform(found, lambda x: F.length(x))
    each = F.zip_with(F.zip_with(gaps, lengths, lambda g, n: F.struct(g.alias("gap"), n.alias("length"))), values,
                      lambda x, v: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["length"].alias("length"), v.alias("value")))
    return F.when(text.rlike(pattern), F.slice(each, 1, F.size(found)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows (rid, doc_id), and the matches with positions: rid, kind (place in ``KINDS``), start, end, value."""
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kinds = [_matches(text, 0, ASSIGN, 2), _matches(text, 1, ACCESS), _matches(text, 2, HEX), _matches(text, 3, RUN)]
    scanned = cut(rows.select("rid", "doc_id", *[k.alias(f"k{i}") for i, k in enumerate(kinds)]))
    exploded = None
    for i in range(len(kinds)):
        part = scanned.where(F.col(f"k{i}").isNotNull()).select("rid", F.posexplode(f"k{i}").alias("number", "m")).select("rid", "number", "m.*")
        exploded = part if exploded is None else exploded.unionByName(part)
    so_far = Window.partitionBy("rid", "kind").orderBy("number")
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    spans = exploded.select("rid", "kind", (end - F.col("length")).alias("start"), end.alias("end"), "value")
    return scanned.select("rid", "doc_id"), spans.where((F.col("kind") != 0) | (F.length("value") >= 12))


def _transitions(values: DataFrame, value: str) -> DataFrame:
    """(pair, count) of the characters side by side in ``value``; a row counts ``weight`` times."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.substring(F.col(value), i, 2))
    return values.where(F.length(value) > 1).select("weight", F.explode(pairs).alias("pair")).groupBy("pair").agg(
        F.round(F.sum("weight"), 3).alias("count"))


def log_ratios(random: DataFrame, ordinary: DataFrame) -> dict[str, float]:
    """Log-likelihood ratio of each pair of alphabet characters, from the two tables of pair counts."""
    logs = []
    for table in (random, ordinary):
        counts = {r["pair"]: r["count"] for r in table.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_.=-]{2}$")).collect()}
        first, second = dict.fromkeys(ALPHABET, 0), dict.fromkeys(ALPHABET, 0.5)
        for pair, n in counts.items():
            first[pair[0]] += n
            second[pair[1]] += n
        every = sum(second.values())
        logs.append({a + b: math.log((counts.get(a + b, 0) + PRIOR * second[b] / every) / (first[a] + PRIOR)) for a in ALPHABET for b in ALPHABET})
    return {pair: logs[0][pair] - logs[1][pair] for pair in logs[0]}


def train(docs: DataFrame, spans: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Random strings: every value of the patterns. Ordinary ones: long words of all documents, patterns cut out."""
    random = _transitions(spans.where(F.col("kind") < 3).withColumn("weight", F.lit(1.0)), "value")
    texts = docs.select(text_of(text_col).alias("text"))
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    name = F.xxhash64("text").alias("name")
    copies = cut(texts.select(name).groupBy("name").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    words = texts.select(name, F.regexp_extract_all(clean, F.lit(WORD), F.lit(0)).alias("words")).join(copies, "name", "left").select(
        (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("weight"), F.explode("words").alias("value"))
    return log_ratios(random, _transitions(words, "value"))


def _ratio(value: Column, ratios: dict[str, float]) -> Column:
    size = len(ALPHABET)
    table = F.from_json(F.lit(json.dumps([ratios[a + b] for a in ALPHABET for b in ALPHABET])), "array<double>")
    place = lambda i: F.position(F.substring(value, i, 1), F.lit(ALPHABET)) - 1
    return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), lambda acc, i: acc + F.get(table, place(i) * size + place(i + 1)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    rows, spans = scan(docs, id_col, text_col)
    spans = cut(spans)
    ratios = train(docs, spans, text_col)
    scored = spans.withColumn("ratio", F.when(F.col("kind") == 3, _ratio(F.col("value"), ratios)))
    likely = scored.where((F.col("kind") < 3) | ((F.col("ratio") > MIN_RATIO) & (F.col("ratio") > MIN_MEAN * (F.length("value") - 1))))
    by_place = Window.partitionBy("rid").orderBy("start")
    base_end, base_start = F.when(F.col("kind") < 3, F.col("end")), F.when(F.col("kind") < 3, F.col("start"))
    ends_before = F.max(base_end).over(by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    starts_after = F.min(base_start).over(by_place.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    free = (F.coalesce(ends_before, F.lit(0)) <= F.col("start")) & (F.col("end") <= F.coalesce(starts_after, F.col("end")))
    kept = likely.withColumn("free", free).where((F.col("kind") < 3) | F.col("free"))

    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    shown = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    entry = F.struct("start", "kind", "end", shown.alias("shown"))
    count = lambda i: F.count_if(F.col("kind") == i)
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["shown"]), ",")
    found = kept.groupBy("rid").agg(
        *[count(i).alias(f"n_{KINDS[i]}") for i in range(4)],
        F.sha2(joined(F.collect_list(F.when(F.col("kind") < 3, entry))), 256).alias("base_sha256"),
        joined(F.collect_list(entry)).alias("spans"))
    none = F.sha2(F.lit(""), 256)
    return rows.join(found, "rid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
