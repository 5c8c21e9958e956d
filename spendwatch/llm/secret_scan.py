"""Secret scans in DataFrame functions only: fixed patterns plus a randomness battery.

Base spans come from three patterns.  The battery looks at the other long
tokens.  For each it infers an encoding (hex, base32, base64 with its URL form)
and takes it into the document's family unless it is plainly structured: paths,
identifiers and the like seldom change between small letters, capitals, digits and
signs from one character to the next, random text does so about as often as its
alphabet says.  That criterion is fixed beforehand and sees no test.

Three equivalence tests ask whether a token is as good as random: the alphabet's
chi-squared statistic against a non-central distribution whose shift grows with the
length, the lag-one serial correlation, and the number of runs above and below the
alphabet's middle.  Each must lean to random (a normal score of at most LEAN), and the
p-value is that of their scores' sum, so it falls with the length and has no floor.
Within a document the family's p-values meet a Benjamini-Hochberg cutoff with weights
in proportion to the length, which limits the share of false discoveries.

Everything happens inside the row: no shuffle, and a document's result depends
on nothing else.  Positions are code points, end exclusive.

Defined cases: a null text is empty; documents without spans have an empty
list; repeated rows give repeated results; a token may be as long as the text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import empty_if_null, trimmed

# kind: (pattern, group whose length counts, least length)
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of at least 24: the same spans as all runs less the shorter ones.
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}"
RANDOM = "random"
FDR = 0.05
# encoding: (its characters in order, excess of the index of coincidence that counts as not random,
# least share of neighbours of different classes; random text has 0.47, 0.30 and 0.64 on average)
ENCODINGS = {
    "hex": ("0123456789abcdef", 1.0, 0.25),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.25, 0.12),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 1.5, 0.45),
}
MAX_CORRELATION, MAX_RUN_SHIFT = 0.5, 0.5
LEAN = -0.52
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _let(value: Column, body) -> Column:
    """Compute ``value`` once per row and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x)


def _in_blocks(xs: Column) -> Column:
    """A non-empty array in blocks of about the root of its size."""
    width = F.greatest(F.ceil(F.sqrt(F.size(xs))), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int")),
                       lambda b: F.slice(xs, b * width + 1, width))


def _ends(lengths: Column) -> Column:
    """Running sums."""
    def inside(cut: Column) -> Column:
        return _let(F.transform(cut, _total), lambda sums: F.flatten(F.transform(cut, lambda block, b: _let(
            _total(F.slice(sums, F.lit(1), b)),
            lambda before: F.transform(block, lambda x, i: before + _total(F.slice(block, F.lit(1), i + 1)))))))

    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(
        _let(lengths, lambda xs: _let(_in_blocks(xs), inside)))


def _reach(spans: Column) -> Column:
    """The largest end; 0 without spans."""
    return F.coalesce(F.array_max(F.transform(spans, lambda x: x["end"])), F.lit(0))


def _placed(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end, text and length of the named group of every leftmost match."""
    def spans(found: Column, sized: Column) -> Column:
        between = F.slice(F.split(text, pattern), F.lit(1), F.size(found))
        pairs = F.flatten(F.transform(F.arrays_zip(found.alias("m"), between.alias("b")),
                                      lambda x: F.array(F.length(x["b"]), F.length(x["m"]))))
        return _let(_ends(pairs), lambda ends: F.transform(found, lambda m, i: F.struct(
            F.get(ends, i * 2).alias("start"), F.get(ends, i * 2 + 1).alias("end"), m.alias("text"),
            F.length(F.get(sized, i)).alias("size"))))

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if group == 0:
        return _let(whole, lambda found: spans(found, found))
    return _let(whole, lambda found: _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda s: spans(found, s)))


def _found(text: Column, pattern: str, group: int, kind: str, rank: int, least: int) -> Column:
    """Spans of one kind; a text without any match costs one search."""
    long_enough = F.filter(_placed(text, pattern, group), lambda x: x["size"] >= least)
    spans = F.transform(long_enough, lambda x: F.struct(
        x["start"], F.lit(rank).alias("rank"), x["end"], F.lit(kind).alias("kind")))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPAN)).cast(SPAN)


def _normal_cdf(z: Column) -> Column:
    """Normal distribution function by a rational approximation (error below 1e-7)."""
    coefficients = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = F.lit(1.0) / (F.abs(z) * 0.2316419 + 1)
    series = F.lit(0.0)
    for c in reversed(coefficients):
        series = (series + c) * t
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, 1 - upper).otherwise(upper)


def encoding_of(token: Column) -> Column:
    """The narrowest alphabet that the token's characters suggest; null for words and numbers."""
    classes = sum((F.regexp_like(token, F.lit(c)).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]")), F.lit(0))
    both = F.regexp_like(token, F.lit("[0-9]")) & F.regexp_like(token, F.lit("[a-fA-F]"))
    return (F.when(F.regexp_like(token, F.lit("^([0-9a-f]+|[0-9A-F]+)$")), F.when(both, "hex"))
            .when(F.regexp_like(token, F.lit("^[A-Z2-7]+$")) & (classes == 2), "base32")
            .when(classes >= 2, "base64"))


def class_changes(token: Column) -> Column:
    """The share of neighbouring characters of different classes: small letters, capitals, digits, signs."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    classes = F.translate(token, letters + letters.upper() + "0123456789-_+/", "a" * 26 + "A" * 26 + "0" * 10 + "/" * 4)
    return (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / (F.length(token) - 1)


def in_family(token: Column) -> Column:
    """Whether the battery tests the token: an encoding, and no plain structure."""
    return _let(class_changes(token), lambda share: _let(encoding_of(token), lambda e: F.coalesce(
        *[F.when(e == name, share >= least) for name, (_, _, least) in ENCODINGS.items()], F.lit(False))))


def random_p(token: Column, encoding: str) -> Column:
    """The combined p-value of the three equivalence tests, for a token without padding."""
    alphabet, excess, _ = ENCODINGS[encoding]
    k = len(alphabet)
    plain = F.lower(token) if encoding == "hex" else F.translate(token, "-_", "+/")

    def tests(chars: Column, size: Column, body: Column) -> Column:
        n = size.cast("double")  # its cube is beyond an int from 1,291 characters on
        squares = F.aggregate(F.transform(F.array_distinct(chars), lambda c: F.pow(
            n - F.length(F.replace(body, c, F.lit(""))), 2)), F.lit(0.0), lambda acc, x: acc + x)
        shift = n * excess
        chi = (squares * k / n - n - (k - 1) - shift) / F.sqrt((shift * 2 + k - 1) * 2)

        def by_index(x: Column) -> Column:
            mean = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v) / n
            high = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.when(v >= k // 2, 1.0).otherwise(0.0))

            def rest(mean: Column, high: Column) -> Column:
                def lagged(f) -> Column:
                    return F.aggregate(F.sequence(F.lit(1), size - 1), F.lit(0.0),
                                       lambda acc, i: acc + f(F.get(x, i), F.get(x, i - 1)))
                variance = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean))
                correlation = F.when(variance > 0, lagged(lambda a, b: (a - mean) * (b - mean)) / variance).otherwise(1.0)
                serial = (F.abs(correlation) - MAX_CORRELATION) * F.sqrt(n)
                runs = lagged(lambda a, b: ((a >= k // 2) != (b >= k // 2)).cast("double")) + 1
                product = high * (n - high) * 2
                expected, spread = product / n + 1, product * (product - n) / (n * n * (n - 1))
                shifted = F.when(spread > 0, (F.abs(runs - expected) - expected * MAX_RUN_SHIFT) / F.sqrt(spread)).otherwise(0.0)
                return _let(F.array(chi, serial, shifted), lambda z: F.when(F.array_max(z) > LEAN, 1.0).otherwise(
                    _normal_cdf((z[0] + z[1] + z[2]) / math.sqrt(3))))

            return _let(mean, lambda m: _let(high, lambda h: rest(m, h)))

        index = F.transform(chars, lambda c: (F.position(c, F.lit(alphabet)) - 1).cast("double"))
        return _let(index, by_index)

    def split(body: Column) -> Column:
        return _let(F.split(body, ""), lambda cs: tests(cs, F.size(cs), body))

    return _let(plain, split)


def _battery(text: Column, base: Column) -> Column:
    """Spans of the tokens that the battery takes for secrets."""
    tokens = F.filter(F.transform(_placed(text, TOKEN), lambda t: F.struct(
        t["start"], t["end"], F.regexp_replace(t["text"], "=+$", "").alias("body"))), lambda t: in_family(t["body"]))

    def scored(ts: Column) -> Column:
        p = lambda t: _let(encoding_of(t["body"]), lambda e: F.coalesce(
            *[F.when(e == name, random_p(t["body"], name)) for name in ENCODINGS]))
        mean = _total(F.transform(ts, lambda t: F.length(t["body"]))) / F.size(ts)
        return _let(mean, lambda m: F.transform(ts, lambda t: F.struct(
            t["start"], t["end"], (p(t) * m / F.length(t["body"])).alias("p"))))

    def controlled(ts: Column) -> Column:
        ranked = F.sort_array(F.transform(ts, lambda t: t["p"]))
        last = F.array_max(F.filter(F.transform(ranked, lambda x, i: F.when(x <= (i + 1) * FDR / F.size(ts), x)),
                                    lambda x: x.isNotNull()))
        return _let(last, lambda cut: F.transform(F.filter(ts, lambda t: t["p"] <= cut), lambda t: F.struct(
            t["start"], F.lit(len(KINDS)).alias("rank"), t["end"], F.lit(RANDOM).alias("kind"))))

    def apart(spans: Column) -> Column:
        def meets(x: Column, t: Column) -> Column:
            return (x["start"] < t["end"]) & (x["end"] > t["start"])

        # A block of base spans is only looked into where it meets the token as a whole.
        blocks = F.transform(_in_blocks(base), lambda b: F.struct(
            F.get(b, F.lit(0))["start"].alias("start"), _reach(b).alias("end"), b.alias("spans")))
        return F.when(F.size(base) == 0, spans).otherwise(_let(blocks, lambda bs: F.filter(
            spans, lambda t: ~F.exists(bs, lambda b: meets(b, t) & F.exists(b["spans"], lambda x: meets(x, t))))))

    found = _let(tokens, lambda ts: F.when(F.size(ts) == 0, F.array().cast(SPAN)).otherwise(
        _let(_let(scored(ts), controlled), apart).cast(SPAN)))
    return F.when(F.regexp_like(text, F.lit(TOKEN)), found).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, text, base (spans of the fixed patterns) and added (spans of the battery), both in order."""
    text = F.col("text")
    base = F.flatten(F.array(*[_found(text, pattern, group, kind, rank, least)
                               for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items())]))
    rows = trimmed(docs, "doc_id", "text", *also).withColumn("text", empty_if_null("text"))
    rows = rows.withColumn("base", F.array_sort(base))
    return rows.withColumn("added", _battery(text, F.col("base")))


def digest_input(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    count = lambda kind, of="base": F.size(F.filter(of, lambda x: x["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(digest_input(F.col("base")), 256).alias("base_sha256"),
        digest_input(F.array_sort(F.concat("base", "added"))).alias("spans"), count(RANDOM, "added").alias("n_random"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span's text replaced by ``mark``; overlapping spans share one mark."""
    found = scan(docs.select("doc_id", "text", F.struct(*docs.columns).alias("whole")), "whole")

    def block_text(block: Column, before: Column, after: Column) -> Column:
        """The text between two positions that block's spans begin and end in, marked."""
        def part(cut: Column, x: Column, i: Column) -> Column:
            return _let(F.greatest(before, _reach(F.slice(block, F.lit(1), i))), lambda at: F.when(x["start"] < at, F.lit("")).otherwise(
                F.concat(F.substr(cut, at - before + 1, x["start"] - at), F.lit(mark))))

        return _let(F.substr(F.col("text"), before + 1, after - before),
                    lambda cut: F.array_join(F.transform(block, lambda x, i: part(cut, x, i)), ""))

    def marked(blocks: Column) -> Column:
        return _let(F.transform(blocks, _reach), lambda ends: F.concat(
            F.array_join(F.transform(blocks, lambda block, b: _let(
                F.coalesce(F.array_max(F.slice(ends, F.lit(1), b)), F.lit(0)),
                lambda before: block_text(block, before, F.greatest(before, F.get(ends, b))))), ""),
            F.substr(F.col("text"), F.array_max(ends) + 1, F.length("text"))))

    merged = _let(F.array_sort(F.concat("base", "added")), lambda spans: _let(_in_blocks(spans), marked))
    text = F.when(F.size("base") + F.size("added") == 0, F.col("text")).otherwise(merged)
    return found.select(*[text.alias(c) if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns])
