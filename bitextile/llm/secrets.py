"""Secret scans with character Markov models.

Three base rules give spans by pattern. The method adds spans: each run of 16 or more characters that keys are written
with is scored by two first-order character models, one of random strings and one of ordinary identifiers; a run whose
log-likelihood ratio passes a threshold, in sum and for each character, is a secret. Runs that touch a base span are left
to it.

The models are counted by Spark from labelled samples: words under 16 characters of a bounded hash sample of documents, each
different text once, without what the base rules find, are ordinary (longer runs are judged, and so never taught); what the
rules find there, and strings made from SHA-256 digests, are random. Only two tables of character pairs, bounded by the
alphabet, reach the driver. All else is built-in functions on every whole text.

Defined results: a null or empty text has no spans; repeated rows give repeated results; an empty table gives no rows; where
the sample has no words, the ordinary model is uniform; runs of equal likelihood under both models are no secrets; a very
long text is scanned like any other, in time linear in its length; other columns are kept out of report() and kept by
redact(). Both thresholds are arguments.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused
from .native import let, matches, merged, outside, touches

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/=_-]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
SAMPLE = 4_000  # documents, about, that the models are counted from
LEAST_SUM, LEAST_MEAN = 12.0, 0.5  # thresholds of the log-likelihood ratio in nats


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the base rules, sorted."""

    def of(kind: int, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    assigned = F.filter(matches(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= 12)
    return F.sort_array(F.concat(of(0, assigned), of(1, matches(text, ACCESS)), of(2, matches(text, HEX))))


def labelled(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(random, word): the labelled samples of both kinds."""
    rows = documents.count()
    share = min(1.0, sample / max(rows, 1))
    some = documents.select(_text().alias("text"), F.xxhash64("text").alias("h")).where(F.pmod("h", F.lit(1_000_000)) < math.ceil(share * 1e6)).dropDuplicates(["text"])
    rest = F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    ordinary = some.select(F.lit(False).alias("random"), F.explode(F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9+/=_-]{4,}"), F.lit(0))).alias("word")).where(F.length("word") < 16)
    found = some.select(
        F.lit(True).alias("random"),
        F.explode(F.concat(F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= 12), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))).alias("word"),
    )
    digest = documents.sparkSession.range(sample, numPartitions=1).select(F.sha2(F.concat(F.lit("random"), F.col("id").cast("string")).cast("binary"), 256).alias("x"))
    coded = digest.select("x", F.base64(F.unhex("x")).alias("b"))
    plain = F.regexp_replace("b", "[+/=]", "")
    made = coded.select(F.lit(True).alias("random"), F.explode(F.array(F.substring("x", 1, 40), F.regexp_replace("b", "=", ""), plain, F.upper(plain), F.lower(plain))).alias("word"))
    return ordinary.union(found).union(made)


def train(words: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters, row by row of the alphabet."""
    pairs = words.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1))), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.where("length(pair) = 2").groupBy("random", "pair").agg(F.count("*").alias("n")).where(F.col("pair").rlike("^[A-Za-z0-9+/=_-]{2}$")).collect()}
    models = [_transitions({p: n for (r, p), n in counts.items() if r is random}) for random in (True, False)]
    return [math.log(p) - math.log(q) for p, q in zip(*models, strict=True)]


def _transitions(counts: dict[str, int], strength: float = 4.0) -> list[float]:
    """P(b | a) for all pairs of the alphabet, smoothed towards how often b occurs at all."""
    total = sum(counts.values())
    second = {b: 0.1 for b in ALPHABET}
    first = dict.fromkeys(ALPHABET, 0)
    for pair, n in counts.items():
        first[pair[0]] += n
        second[pair[1]] += n
    share = {b: n / (total + 0.1 * len(ALPHABET)) for b, n in second.items()}
    return [(counts.get(a + b, 0) + strength * share[b]) / (first[a] + strength) for a in ALPHABET for b in ALPHABET]


def ratio(word: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a string over the alphabet: random against ordinary."""
    values = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")  # folded into one literal
    alphabet = F.lit(ALPHABET)

    def place(i: Column) -> Column:
        return F.position(F.substring(word, i, F.lit(1)), alphabet) - 1

    return F.aggregate(F.sequence(F.lit(1), F.length(word) - 1), F.lit(0.0), lambda acc, i: acc + F.get(values, place(i) * len(ALPHABET) + place(i + 1)))


def markov_spans(text: Column, base: Column, table: list[float], least_sum: float = LEAST_SUM, least_mean: float = LEAST_MEAN) -> Column:
    """Array of (start, kind number, end) of runs that the models hold for random and that touch no base span."""
    free = lambda runs: F.filter(F.zip_with(runs, touches(runs, base), lambda x, hit: F.when(~hit, x)), lambda x: x.isNotNull())
    likely = F.filter(let(matches(text, RUN), free), lambda x: let(ratio(x["value"], table), lambda r: (r >= least_sum) & (r >= least_mean * F.length(x["value"]))))
    return F.transform(likely, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))


def found(table: list[float], least_sum: float = LEAST_SUM, least_mean: float = LEAST_MEAN) -> Column:
    """(base, spans) of the column text: arrays of (start, kind number, end)."""
    kind = "array<struct<start:int,kind:int,end:int>>"
    return let(_text(), lambda t: let(base_spans(t), lambda b: F.struct(b.cast(kind).alias("base"), F.sort_array(F.concat(b.cast(kind), markov_spans(t, b, table, least_sum, least_mean).cast(kind))).alias("spans"))))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(documents: DataFrame, least_sum: float = LEAST_SUM, least_mean: float = LEAST_MEAN) -> DataFrame:
    """Counts of base matches, the digest of base spans, and all spans of each document."""
    judged = documents.select("doc_id", found(train(labelled(documents)), least_sum, least_mean).alias("x"))
    n = lambda k: F.size(F.filter("x.base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return judged.select("doc_id", n(0), n(1), n(2), F.sha2(written(F.col("x.base")).cast("binary"), 256).alias("base_sha256"), written(F.col("x.spans")).alias("spans"))


def redact(documents: DataFrame, mark: str = "[SECRET]", least_sum: float = LEAST_SUM, least_mean: float = LEAST_MEAN) -> DataFrame:
    """The documents with every found span replaced by `mark`; n_chars, if there, is set anew for changed texts."""
    name = unused(documents, "found")
    some = F.size(f"{name}.spans") > 0
    new = let(merged(F.col(f"{name}.spans")), lambda m: F.array_join(outside(F.col("text"), m["starts"], m["ends"]), mark))
    out = documents.withColumn(name, found(train(labelled(documents)), least_sum, least_mean)).withColumn("text", F.when(some, new).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
