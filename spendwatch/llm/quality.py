"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base counts are computed inside each row (no shuffle of text): repeated 8-word
windows are found by sorting the row's own window hashes.  A rule rejects a
document whose statistic reaches a cutoff.  For each stratum (language) and
rule the cutoff is chosen on labelled documents: a cutoff may be used only if
the exact binomial test rejects "the rule rejects at least ``risk`` of the good
documents of this stratum" at level ``error`` divided by the number of tests
(strata x rules x cutoffs); among the usable cutoffs the one that rejects most
bad documents wins, then the one that rejects fewest good ones; a cutoff that
rejects fewer than nine bad documents for each good one is not used.  Without enough
labelled documents no cutoff is usable and the rule rejects nothing there.

Defined cases: a null text has no words; a null language shares the
stratum of the empty one; repeated labels of a document count once, as bad if any says so; labels
without a document and null labels are not used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendwatch.llm.common import empty_if_null, stage, trimmed

SPACE = r"\x20\x09-\x0D"
RISK = 0.005
ERROR = 0.05
LEVELS = 32
SALTS = 64
LEAST_YIELD = 9  # bad documents that a cutoff must reject for each good one
# rule: (statistic, least cutoff, greatest cutoff); cutoffs are LEVELS equal steps.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.01, 0.5),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.02, 1.0),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.02, 0.3),
    "long_words": ("word_chars / greatest(n_words, 1)", 6.0, 20.0),
    "short_words": ("-word_chars / greatest(n_words, 1)", -5.0, -1.0),
}
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8


def _let(value: Column, body) -> Column:
    """Compute ``value`` once per row and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words covered by windows of WINDOW words that the text has more than once."""
    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)

    def repeated(ranked: Column) -> Column:
        return F.filter(ranked, lambda x, j: F.coalesce(F.get(ranked, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(ranked, j + 1)["h"] == x["h"], F.lit(False)))

    def among(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = F.sort_array(F.transform(_let(ranked, repeated), lambda x: x["i"]))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            _let(places, covered))

    def over(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))
        return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(_let(hashes, among))

    return _let(words, over)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the base counts, computed row by row."""
    text = empty_if_null("text")
    base = trimmed(docs, "doc_id", "text", "lang").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    counts = F.struct(
        F.length(F.regexp_replace("text", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda ls: F.struct(F.size(ls).alias("n_lines"),
                                        (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup"))).alias("lines"),
        _let(F.regexp_extract_all("text", F.lit(f"([^{SPACE}]+)"), F.lit(1)),
             lambda ws: F.struct(F.size(ws).alias("n"), repeated_words(ws).alias("n_repeat"))).alias("words"))
    out = base.select("doc_id", "lang", counts.alias("c")).select(
        "doc_id", "lang", F.col("c.words.n").cast("long").alias("n_words"), "c.word_chars", "c.n_symbols",
        F.col("c.lines.n_lines").cast("long").alias("n_lines"), F.col("c.lines.n_dup").cast("long").alias("n_dup_lines"),
        F.col("c.words.n_repeat").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _level(rule: str) -> Column:
    """How many of the rule's cutoffs the document reaches."""
    statistic, low, high = RULES[rule]
    return F.width_bucket(F.expr(f"cast({statistic} as double)"), F.lit(low), F.lit(high), F.lit(LEVELS - 1)).cast("int")


def _tail(k: Column, n: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k), summed term by term in logarithms."""
    odds = math.log(risk / (1 - risk))
    start = F.struct(F.lit(0.0).alias("sum"), (n * math.log1p(-risk)).alias("term"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, lambda acc, j: F.struct(
        (acc["sum"] + F.exp(acc["term"])).alias("sum"), (acc["term"] + F.ln((n - j) / (j + 1)) + odds).alias("term")))
    return total["sum"]


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """lang, rule, level: the chosen cutoff of each stratum and rule that has a usable one."""
    marks = trimmed(labels, "doc_id", "quality").where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _level(r).alias("level")) for r in RULES])).alias("r")
    judged = measured.where("not base_failed").join(marks, "doc_id").select("lang", "quality", rules)
    good, bad = (F.count(F.when(F.col("quality") == q, 1)) for q in (1, 0))
    cells = judged.groupBy("lang", "r.rule", "r.level").agg(good.alias("good"), bad.alias("bad"))
    whole = W.partitionBy("lang", "rule")
    down = whole.orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, 0)
    cells = cells.select("lang", "rule", "level", F.sum("good").over(whole).alias("n"),
                         F.sum("good").over(down).alias("k"), F.sum("bad").over(down).alias("caught"))
    # Every judged document has a cell for every rule, so each rule sees all strata.
    strata = cells.groupBy("rule").agg(F.countDistinct("lang").alias("strata"))
    tested = cells.join(strata, "rule").where(
        f"level > 0 and caught > 0 and caught >= {LEAST_YIELD} * k and k < {risk} * n").withColumn(
        "p", _tail(F.col("k"), F.col("n"), risk)).where(F.col("p") * F.col("strata") * (len(RULES) * LEVELS) <= error)
    best = W.partitionBy("lang", "rule").orderBy(F.desc("caught"), F.asc("k"), F.desc("level"))
    return tested.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("lang", "rule", "level")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The base counts of every document, base_failed, kept, and the first rule that rejects it."""
    measured = stage(measure(docs), "quality-measured")
    chosen = cutoffs(measured, labels, risk, error).groupBy("lang").agg(
        *[F.min(F.when(F.col("rule") == r, F.col("level"))).alias(f"cut_{r}") for r in RULES])
    rejected = F.coalesce(*[F.when(_level(r) >= F.col(f"cut_{r}"), F.lit(r)) for r in RULES])
    # A language may hold a third of the documents: its cutoffs are joined salted.
    salted = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    out = out.join(salted, ["lang", "salt"], "left").withColumn("rejected_by", rejected)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by")
