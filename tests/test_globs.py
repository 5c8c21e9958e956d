"""The pattern join against fnmatch."""

import fnmatch
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from spendwatch.operators import globs


def first(names, rules):
    return {n: min((o, p) for o, p in rules if fnmatch.fnmatchcase(n, p)) for n in names if n is not None and any(fnmatch.fnmatchcase(n, p) for _, p in rules)}


def test_first_matching_rule_equals_fnmatch(spark):
    rng = random.Random(4)
    bits = ["a", "b", "ab", "ba", "x1", "-", ".", "é", "[", "]", "!", "日本", "job", "*"]
    names = [None, "", "a", "job", "*", "[", "a]b"] + ["".join(rng.choice(bits) for _ in range(rng.randrange(6))) for _ in range(200)]
    globbed = [*bits, "*", "?", "[ab]", "[!a]", "[a-c]", "[]]", "[!]]", "[b", "**"]
    rules = [(k * 37 % 101, "".join(rng.choice(globbed) for _ in range(rng.randrange(1, 6)))) for k in range(90)] + [(500, "*"), (501, "never")]
    got = globs.first_matching(spark.createDataFrame([(n, 1) for n in names], "cluster_name string, gram int").repartition(3), "cluster_name",
                               spark.createDataFrame(rules + [(0, None)], "rule_order long, pattern string"))
    assert {r["name"]: (r.rule_order, r.pattern) for r in got.collect()} == first(names, rules)


def test_only_names_with_the_rarest_gram_are_tested(spark):
    names = spark.range(3000).selectExpr("concat('cluster-', id) AS cluster_name")
    rules = spark.range(2000).selectExpr("id AS rule_order", "concat('*-', id, '?') AS pattern")
    got = globs.first_matching(names, "cluster_name", rules)
    assert got.count() == 2990
    assert globs.first_matching(names.limit(0), "cluster_name", rules).count() == 0 == globs.first_matching(names, "cluster_name", rules.limit(0)).count()


@settings(max_examples=200, deadline=None)
@given(st.text("ab[]!-*?x", max_size=12), st.text("ab[]!-x", max_size=8))
def test_a_name_that_matches_holds_every_gram(pattern, name):
    if fnmatch.fnmatchcase(name, pattern):
        marked = globs.START + name + globs.END
        assert all(g in marked for r in globs.literal_runs(pattern) for g in globs.grams(r))


def test_long_lists_exclude_as_short_ones_do(spark, monkeypatch):
    from spendwatch.functions import rules as R
    from spendwatch.operators import scoring, usage
    from spendwatch.params import Params
    rules = R.ExclusionRules(ids=("9",), name_patterns=tuple(f"*-{k:02d}?" for k in range(90)) + ("team-[13]*", "*"[:0] + "team-2??"), creators=("ann",))
    inv = spark.createDataFrame([(1, str(k), f"team-{k:03d}", "ann" if k % 7 == 0 else "bob") for k in range(400)] + [(1, "x", None, None)],
                                "workspace_id long, cluster_id string, cluster_name string, creator_user_name string")
    history = inv.withColumnRenamed("creator_user_name", "owned_by")

    def both():
        reasons = scoring.exclusion_reason(inv, rules, Params())
        return sorted(map(str, reasons.collect())), sorted(map(str, usage.exclusion_keys(rules, history).collect()))

    long = both()
    monkeypatch.setattr(scoring, "INLINE_GLOBS", 1000)
    monkeypatch.setattr(usage, "INLINE_GLOBS", 1000)
    monkeypatch.setattr(R, "INLINE_GLOBS", 1000)
    assert long == both()


def test_patterns_are_looked_up_by_long_literals(spark):
    """Ten times the names and patterns have about ten times the candidates, not a hundred times."""
    assert globs.lookups("*-urgent-12345?")["123"] == globs.WITHIN + "urgent-12345"
    assert globs.lookups("*-12345")["123"] == globs.LAST + "-12345" + globs.END
    assert set(globs.lookups("job-7").values()) == {globs.WHOLE + globs.START + "job-7" + globs.END}

    def candidates(n):
        names = spark.range(n).selectExpr("concat('team-urgent-', 100000 + id * 37 % 10007) AS cluster_name")
        rules = spark.range(n).selectExpr("id AS rule_order", "concat('*-', 100000 + id * 37 % 10007) AS pattern")
        marked = globs.marked_names(names, "cluster_name")
        asked = globs.rarest_parts(marked, rules.unionAll(rules.selectExpr("rule_order + 100000", "pattern")))
        assert asked.count() == n
        kinds = {(r.part[0], len(r.part) - 1) for r in asked.select("part").collect()}
        return globs.name_parts(marked, sorted(kinds)).join(asked, "part").count()

    assert candidates(200) == 200 and candidates(2000) == 2000


def test_few_and_many_kinds_of_parts_agree(spark, monkeypatch):
    names = [f"{'ab'[k % 2]}-urgent-{k * 7919 % 1000}" for k in range(300)]
    rules = [(k, p.format(k * 7919 % 1000)) for k in range(200) for p in ("*-{}", "a-*{}?", "?-urgent-{}*", "*gent*{}*", "b-urgent-{}")]
    frames = (spark.createDataFrame([(n,) for n in names], "cluster_name string"), "cluster_name",
              spark.createDataFrame(rules, "rule_order long, pattern string"))
    got = []
    for few in (globs.FEW, 150, 0):
        monkeypatch.setattr(globs, "FEW", few)
        got.append({r["name"]: (r.rule_order, r.pattern) for r in globs.first_matching(*frames).collect()})
    assert got[0] == got[1] == got[2] == first(set(names), rules)
