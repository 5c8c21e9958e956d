import re

import corpus_pipeline
from spendwatch.llm import quality
from spendwatch.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.test_near_dup import brute, shingle_set
from tests.llm.test_packing import tokenizer
from tests.llm.test_secret_scan import brute as secret_spans


def by_hand(spark, rows, benchmark, rejected):
    """What the stages keep of (doc_id, text), in plain Python."""
    kept = [(i, t) for i, t in rows if i not in rejected]
    stays = {i for i, _, _, keep in brute(kept, 80) if keep}
    kept = [(i, t) for i, t in kept if i in stays]
    items = [g for g in map(shingle_set, benchmark) if g]
    kept = [(i, t) for i, t in kept if not any(100 * len(g & shingle_set(t)) >= 80 * len(g) for g in items)]
    out = {}
    for i, t in kept:
        parts, at = [], 0
        for a, _, b, _ in secret_spans(t):
            if a >= at:
                parts += [t[at:a], "[SECRET]"]
            at = max(at, b)
        out[i] = "".join(parts) + t[at:]
    return out


def test_run_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    # At this size no cutoff has enough labels, so only the base rules reject.
    rejected = {r.doc_id for r in quality.measure(table(spark, SF_SMALL, "documents")).where("base_failed").collect()}
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows}
    assert {i for i in words if words[i] < 20} <= rejected
    benchmark = [r.text for r in table(spark, SF_SMALL, "benchmark").collect()]
    expected = by_hand(spark, rows, benchmark, rejected)
    t = tokenizer()
    lengths = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in expected.items()}
    got = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths


def test_stages_keep_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "word " * 5 + " ".join(f"w{k}" for k in range(40)), "en", "s", 1),
                                  (3, " ".join(f"v{k}" for k in range(40)) + " password=abcdefgh", "en", None, 2)] * 2,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    expected = {"quality_rules": 4, "near_duplicates": 2, "decontamination": 2, "secrets": 2, "best_fit_packing": 2}
    for name, stage in corpus_pipeline.STAGES:
        assert name == "best_fit_packing" or stage(spark, docs.limit(0), SF_SMALL).columns == docs.columns
        out = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() == expected[name], name
        if name == "secrets":
            hit = docs.where("doc_id = 3").first()
            assert hit.text.endswith(" [SECRET]") and hit.n_chars == len(hit.text)
