import random
import re

import pytest

from spendwatch.llm import near_dup
from spendwatch.llm.shingles import sets


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    s = {i: shingle_set(t) for i, t in rows}
    label = {i: i for i in s}
    links = [(a, b) for a in s for b in s if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return {(i, len(s[i]), label[i], label[i] == i) for i in s}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdEFé") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.6:  # edits of one text: many linked, many just not
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        elif kind < 0.7 and rows:
            w = [rng.choice(rows)[1].upper().replace("É", "é")]
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows + [(n, ""), (n + 1, None), (n + 2, "One two"), (n + 3, "one  TWO"), (n + 4, " \n"), (n + 5, "a b c d"), (n + 6, "a\u00a0b c d")]


def test_sets_equal_plain_shingling():
    import numpy as np
    texts = [t or "" for _, t in corpus(1)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    got = sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    plain = [shingle_set(t) for t in texts]
    assert [g.size for g in got] == [len(p) for p in plain]
    for i in range(0, len(texts), 7):
        for j in range(0, len(texts), 11):
            assert np.intersect1d(got[i], got[j]).size == len(plain[i] & plain[j])


@pytest.mark.parametrize("block,part", [(near_dup.BLOCK_DOCS, near_dup.PART_DOCS), (40, 3), (7, 3)])
def test_components_equal_brute_force(spark, monkeypatch, block, part):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    monkeypatch.setattr(near_dup, "PART_DOCS", part)
    rows = corpus(block)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, component_id int").repartition(4)
    assert {tuple(r) for r in near_dup.near_duplicates(docs).collect()} == brute(rows)


def test_a_hot_group_of_linked_copies_is_not_paired_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 8)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(200):
        w = list(base)
        w[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows.append((200, " ".join(base[:300] + [f"y{i}" for i in range(100)])))  # shares bands, but is not linked
    seen = []
    real = near_dup.verified_links
    monkeypatch.setattr(near_dup, "verified_links", lambda members, *rest: (
        seen.append(members.selectExpr("coalesce(sum(size(others)), 0)").first()[0]), real(members, *rest))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in near_dup.near_duplicates(docs).collect()} == brute(rows)
    assert len(seen) == 3 and sum(seen) < 201 * (near_dup.PASSES + 2)  # all pairs of blocks: 201 * 26


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "some words that are said again and again here"
    docs = spark.createDataFrame([(5, text), (5, text), (2, text + " more"), (None, text), (7, None)], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect())
    assert rows == [("2", 2, True), ("5", 5, True), ("5", 5, True), ("7", 7, True), ("None", None, True)]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_pruning_bound_is_the_posterior_tail():
    table = near_dup.least_matches(0.85, 120, 24, 1e-6)
    assert [n for n, _ in table] == [24, 48, 72, 96, 120]
    assert all(0 < m <= 0.85 * n for n, m in table)
    n, m = table[-1]
    assert near_dup._binomial_tail(m, n + 1, 0.85) >= 1e-6 > near_dup._binomial_tail(m - 1, n + 1, 0.85)
