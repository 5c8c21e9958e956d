"""JN16/FL14: long lists of name patterns, as a join.

A glob can only match a name that holds every literal run of the glob.  Names and
patterns are closed with a start and an end mark, so an anchored end is a literal
too.  Equal patterns are one pattern, of the first of their rules.  Of each pattern
the one gram of up to GRAM characters that the fewest names hold is found, and the
pattern is looked up by the longest part of the literal run around it: the beginning
or end of a name where the run has a mark, a window of one of SIZES elsewhere.  A
short gram is held by a fixed share of the names; such a part is as rare as the
literal, so the candidates grow with the names and patterns and not with their
product.  Names are cut into the sizes of part that are in use only; the candidates
are tested with the pattern's regular expression, and the first rule in order wins.

The list stays a table: nothing of it is collected but the kinds of part in use.  A
pattern with a gram that no name holds costs nothing further.  A pattern of wildcards
alone has the marks as its grams and thus all names as candidates, as it should.  The
kinds of few patterns are broadcast; the join of the others is salted by name, so the
names of a common part meet its patterns in SALTS tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.rules import glob_to_regex
from spendwatch.operators.joins import broadcast_if_fits
from spendwatch.session import workers_import, written

GRAM = 3
SALTS = 16
SIZES = (1, 2, 3, 4, 6, 8, 12, 16)  # of windows; ends have any length up to the last
FEW = 100_000  # patterns of the kinds whose join is broadcast
BEGIN, LAST, WITHIN, WHOLE = "b", "l", "w", "n"
START, END = "\x02", "\x03"


def literal_runs(pattern: str) -> list[str]:
    """The maximal literal runs of a marked glob; a bracket is a wildcard unless it stays open."""
    runs, at = [START], 0
    while at < len(pattern):
        c = pattern[at]
        close = -1
        if c == "[":
            first = at + 2 if pattern[at + 1:at + 2] == "!" else at + 1
            close = pattern.find("]", first + 1)  # a bracket right after the opening is a member
        if c in "*?" or close > 0:
            runs.append("")
        else:
            runs[-1] += c
        at = close + 1 if close > 0 else at + 1
    runs[-1] += END
    return [r for r in runs if r]


def grams(run: str) -> list[str]:
    size = min(GRAM, len(run))
    return [run[k:k + size] for k in range(len(run) - size + 1)]


def lookups(pattern: str) -> dict[str, str]:
    """Of each distinct gram of a pattern the longest part of its literal run around it, behind its kind."""
    runs, out = literal_runs(pattern), {}
    for k, run in enumerate(runs):
        first, last = k == 0, k == len(runs) - 1
        for at, gram in enumerate(grams(run)):
            if first and last:
                part = WHOLE + run
            elif first and at + len(gram) <= SIZES[-1]:
                part = BEGIN + run[:SIZES[-1]]
            elif last and len(run) - at <= SIZES[-1]:
                part = LAST + run[-SIZES[-1]:]
            else:
                size = max(n for n in SIZES if n <= len(run))
                start = min(max(at - (size - len(gram)) // 2, 0), len(run) - size)
                part = WITHIN + run[start:start + size]
            out[gram] = max(out.get(gram, ""), part, key=len)
    return out


def pattern_grams(rules: DataFrame) -> DataFrame:
    """rule_order, pattern, regex, gram, part: a row per distinct gram of each distinct pattern, of its first rule."""
    workers_import(rules.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(order, pattern, glob_to_regex(pattern), gram, part) for order, pattern in zip(*(c.to_pylist() for c in batch.columns))
                    for gram, part in lookups(pattern).items()]
            cols = zip(*rows) if rows else ((),) * 5
            kinds = (pa.int64(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["rule_order", "pattern", "regex", "gram", "part"])

    # A struct, so a null order comes first here too.
    firsts = (rules.where(F.col("pattern").isNotNull()).groupBy("pattern")
              .agg(F.min(F.struct(F.col("rule_order").cast("long").alias("rule_order"))).alias("first")))
    return firsts.select("first.rule_order", "pattern").mapInArrow(
        run, "rule_order long, pattern string, regex string, gram string, part string")


def marked_names(names: DataFrame, name: str) -> DataFrame:
    """name, marked: the distinct non-null names."""
    distinct = names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    return distinct.withColumn("marked", F.concat(F.lit(START), F.col("name"), F.lit(END)))


def _windows(size: int) -> Column:
    starts = F.when(F.length("marked") >= size, F.sequence(F.lit(1), F.length("marked") - size + 1))
    return F.coalesce(F.transform(starts, lambda i: F.substr("marked", i, F.lit(size))), F.array().cast("array<string>"))


def name_grams(marked: DataFrame) -> DataFrame:
    """name, gram: the distinct grams of 1 to GRAM characters of each name."""
    every = F.concat(*[_windows(n) for n in range(1, GRAM + 1)])
    return marked.select("name", F.explode(F.array_distinct(every)).alias("gram"))


def name_parts(marked: DataFrame, kinds: list[tuple[str, int]]) -> DataFrame:
    """name, part: the distinct parts of the given kinds and sizes of each name."""
    def parts(kind: str, size: int) -> Column:
        if kind == WITHIN:
            return F.transform(_windows(size), lambda w: F.concat(F.lit(kind), w))
        if kind == WHOLE:
            return F.array(F.concat(F.lit(kind), "marked"))
        start = F.lit(1) if kind == BEGIN else F.length("marked") - size + 1
        part = F.concat(F.lit(kind), F.substr("marked", start, F.lit(size)))
        return F.array_compact(F.array(F.when(F.length("marked") >= size, part)))

    every = F.concat(*[parts(kind, size) for kind, size in kinds])
    return marked.select("name", F.explode(F.array_distinct(every)).alias("part"))


def rarest_parts(marked: DataFrame, rules: DataFrame) -> DataFrame:
    """rule_order, pattern, regex, part: how each pattern that may match a name is looked up."""
    seen = name_grams(marked).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rated = pattern_grams(rules).join(seen, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # Of two equal counts the gram that leads to the longer part.
    least = F.min(F.struct("n", F.length("part") * -1, "gram", "part")).alias("least")
    return (rated.groupBy("rule_order", "pattern", "regex").agg(least)
            .where("least.n > 0").select("rule_order", "pattern", "regex", F.col("least.part").alias("part")))


def first_matching(names: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """name, rule_order, pattern: of each distinct non-null name that any pattern matches, the first."""
    marked = written(marked_names(names, name), "glob-names")
    asked = written(rarest_parts(marked, rules).withColumns({
        "kind": F.substring("part", 1, 1),
        "size": F.when(F.substring("part", 1, 1) == WHOLE, 0).otherwise(F.length("part") - 1)}), "glob-parts")
    few, many, so_far = [], [], 0
    for row in sorted(asked.groupBy("kind", "size").count().collect(), key=lambda r: (r["count"], r["kind"], r["size"])):
        so_far += row["count"]
        (few if so_far <= FEW else many).append((row["kind"], row["size"]))
    met = marked.select("name").crossJoin(asked.select("rule_order", "pattern", "regex").limit(0))
    for kinds in filter(None, (few, many)):
        of_kinds = F.struct("kind", "size").isin(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("size")) for k, n in kinds])
        held, patterns, on = name_parts(marked, kinds), asked.where(of_kinds).drop("kind", "size"), ["part"]
        if kinds is few:
            patterns = broadcast_if_fits(patterns, FEW)
        else:
            held = held.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int"))
            patterns = patterns.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            on = ["part", "salt"]
        met = met.unionByName(held.join(patterns, on).where(F.regexp_like("name", "regex")).select(met.columns))
    best = met.groupBy("name").agg(F.min(F.struct("rule_order", "pattern")).alias("first"))
    return best.select("name", "first.rule_order", "first.pattern")
