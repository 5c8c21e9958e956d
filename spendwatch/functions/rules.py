"""Exclusion rules: exact ids, cluster-name globs and creators."""

from __future__ import annotations

import base64
import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.session import local_frame

# Id and creator lists up to this length are matched inline (IN set); longer ones
# by a broadcast join.
INLINE_LIST_MAX = 10_000
# Up to so many globs are one flat expression.
INLINE_GLOBS = 64
# Most rules that a rule table may hold.
RULES_MAX = 100_000
_REGEX_META = set(".^$*+?{}[]\\|()")
_CLASS_META = set("\\[]^-&")


def _class_char(c: str) -> str:
    return "\\" + c if c in _CLASS_META else c


def _bracket(body: str, negate: bool) -> str:
    """Translate the inside of ``[...]``: single characters and ``a-z``
    ranges; a reversed range matches nothing (as in fnmatch)."""
    items, k = [], 0
    while k < len(body):
        if k + 2 < len(body) and body[k + 1] == "-":
            lo, hi = body[k], body[k + 2]
            if lo <= hi:
                items.append(_class_char(lo) + "-" + _class_char(hi))
            k += 3
        else:
            items.append(_class_char(body[k]))
            k += 1
    if not items:
        return "." if negate else "(?!)"
    return "[" + ("^" if negate else "") + "".join(items) + "]"


def glob_to_regex(pattern: str) -> str:
    """Translate a shell glob (``*``, ``?``, ``[seq]``, ``[!seq]``) into an
    anchored regular expression valid in both Java and RE2 syntax.

    Matching is whole-string and case-sensitive.
    """
    out = []
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:  # no closing bracket: a literal "["
                out.append("\\[")
                continue
            body = pattern[i:j]
            i = j + 1
            negate = body.startswith("!")
            out.append(_bracket(body[1:] if negate else body, negate))
        elif c in _REGEX_META:
            out.append("\\" + c)
        else:
            out.append(c)
    return "^(?s:" + "".join(out) + ")\\z"


def _encoded(text: str) -> str:
    return base64.b64encode(text.encode()).decode()


@dataclasses.dataclass(frozen=True)
class ExclusionRules:
    """The three rule lists.  Priority when several match: id, then name
    patterns in list order, then creator."""

    ids: tuple[str, ...] = ()
    name_patterns: tuple[str, ...] = ()
    creators: tuple[str, ...] = ()

    def ids_frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, [(i,) for i in dict.fromkeys(self.ids)], "rule_id string")

    def creators_frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, [(c,) for c in dict.fromkeys(self.creators)], "rule_creator string")

    def patterns_frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, list(enumerate(self.name_patterns)), "rule_order long, pattern string")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = ([("id", v) for v in self.ids] + [("name_glob", v) for v in self.name_patterns]
                + [("creator", v) for v in self.creators])
        return local_frame(spark, [(i + 1, t, v) for i, (t, v) in enumerate(rows)], S.EXCLUSION_RULES)

    @classmethod
    def from_frame(cls, rules: DataFrame) -> "ExclusionRules":
        """The lists of a rule table (``schemas.EXCLUSION_RULES``), in
        rule_order.  Rules are hand-kept configuration: more than RULES_MAX
        of them is an error, not a truncated list."""
        rows = rules.orderBy("rule_order").limit(RULES_MAX + 1).collect()
        if len(rows) > RULES_MAX:
            raise ValueError(f"more than {RULES_MAX} exclusion rules")
        unknown = {r["rule_type"] for r in rows} - {"id", "name_glob", "creator"}
        if unknown:
            raise ValueError(f"unknown rule types {sorted(map(str, unknown))}")
        of = lambda kind: tuple(r["pattern"] for r in rows if r["rule_type"] == kind)
        return cls(of("id"), of("name_glob"), of("creator"))

    def name_reason(self, name: Column) -> Column:
        """First matching pattern's reason text, else NULL (list order wins).

        Short lists are one flat expression.  A long list is looked up by
        position, and only for names that the combined pattern matches."""
        if len(self.name_patterns) <= INLINE_GLOBS:
            return F.coalesce(F.lit(None).cast("string"), *[
                F.when(name.rlike(glob_to_regex(g)), F.lit(f"cluster_name matches pattern '{g}'")) for g in self.name_patterns])
        regexes = F.split(F.lit("\n".join(_encoded(glob_to_regex(g)) for g in self.name_patterns)), "\n")
        globs = F.split(F.lit("\n".join(_encoded(g) for g in self.name_patterns)), "\n")
        plain = lambda x: F.decode(F.unbase64(x), "UTF-8")
        places = F.sequence(F.lit(1), F.lit(len(self.name_patterns)))
        first = F.element_at(F.filter(places, lambda i: F.regexp_like(name, plain(F.element_at(regexes, i)))), 1)
        reason = F.concat(F.lit("cluster_name matches pattern '"), plain(F.element_at(globs, first)), F.lit("'"))
        return F.when(self.name_matches(name), reason)

    def name_matches(self, name: Column) -> Column:
        if not self.name_patterns:
            return F.lit(False)
        return F.coalesce(name.rlike("|".join(glob_to_regex(g) for g in self.name_patterns)), F.lit(False))
