"""op12 against a plain version."""

import math
import random
import re
from collections import Counter

import pytest

from spendwatch.llm import term_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    own = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in own if t), sum(len(t) for _, t in own)
    df = Counter(t for _, ts in own for t in set(ts))
    out = []
    for item_id, text in dict.fromkeys(items):
        found = []
        for doc_id, ts in own:
            if not ts:
                continue
            tf, m = Counter(ts), 10 + 90 * len(ts) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in set(terms(text)) if tf[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    words = ["cat", "Cat", "CATS", "dog", "é", "É", "naïve", "x1", "1", "日本", "日", "the", "The", "rare", "straße", "a b", "ca"]
    seps = [" ", ", ", "-", "\n", "_", ".", "\x00", "\x7f", "  "]
    text = lambda size: "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(size)))
    docs = [(i, text(60)) for i in range(n)] + [(500, None), (501, ""), (502, "--- \n"), (None, "cat rare"), (None, "dog"), (7, "cat dog")]
    docs += [(600 + i, "same words of the copies") for i in range(15)]
    items = [(i, text(12)) for i in range(20)] + [(30, None), (31, "..."), (32, "unheard"), (33, "cat"), (33, "dog"), (34, "same copies"),
                                                  (34, "same copies"), (None, "rare"), (35, "the " * 50)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, score string").repartition(5),
            spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int"))


@pytest.mark.parametrize("limits", [{}, {"CELLS": 7}, {"PIECE": 5}])
def test_ranks_equal_the_plain_version(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(term_search, name, value)
    docs, items = corpus()
    d, b = frames(spark, docs, items)
    assert rows(term_search.search(d, b)) == plain(docs, items)
    if not limits:
        assert rows(term_search.search(d, b, k=3, block_bytes=40)) == plain(docs, items, 3)


def test_pieces_of_a_long_text_give_its_frequencies(monkeypatch):
    items = term_search.Items(["alpha beta 日本 x"])
    guard = term_search.guarded((" alpha, x日本 日本\nBETA alphabet x" * 200).encode())
    whole = [x.tolist() for x in term_search.frequencies(term_search.automaton(items), guard)]
    expected = Counter(terms(" alpha, x日本 日本\nBETA alphabet x" * 200))
    assert dict(zip((items.terms[k].decode() for k in whole[0]), whole[1])) == {t: expected[t] for t in ("alpha", "beta", "日本", "x") if expected[t]}
    assert term_search.count_terms(guard) == sum(expected.values())
    monkeypatch.setattr(term_search, "PIECE", 3)
    assert [x.tolist() for x in term_search.frequencies(term_search.automaton(items), guard)] == whole


def test_empty_tables_and_very_long_texts(spark):
    docs, items = corpus(n=5)
    d, b = frames(spark, docs, items)
    assert rows(term_search.search(d.limit(0), b)) == [] == rows(term_search.search(d, b.limit(0)))
    docs, items = [(1, "cat " * 800_000 + "dog"), (2, "z" * 3_000_000 + " cat"), (3, "dog"), (4, "other")], [(1, "cat dog"), (2, "z" * 3_000_000)]
    d, b = frames(spark, docs, items)
    assert rows(term_search.search(d, b)) == plain(docs, items)
