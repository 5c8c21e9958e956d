import hashlib
import random

import numpy as np
import pytest

from spendwatch.llm import suffix_dedup as sd


def brute(rows, length=sd.LENGTH):
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    key = lambda i: sd.NO_ID if i is None else i
    for i, b in data:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            least[w] = min(least.get(w, sd.NO_ID), key(i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < key(i):
                gone[p:p + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh", b"a", bytes(range(97, 123)) + b"\xff"])
def test_suffix_array_equals_sorting(letters):
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 700):
        text = rng.choice(np.frombuffer(letters, np.uint8), n)
        raw = text.tobytes()
        order = sd.suffix_array(text, 64)
        assert sorted(order) == list(range(n))
        cut = [raw[i:i + 64] for i in order]
        assert cut == sorted(cut)


def corpus(seed, n_docs):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(25) for _ in range(4)]
    rows = []
    for i in range(n_docs):
        kind = rng.random()
        if kind < 0.2 and rows:
            t = rng.choice(rows)[1]
            if rng.random() < 0.5 and t:
                cut = rng.randrange(len(t) + 1)
                t = t[:cut] + rng.choice(words) + t[cut:]
        else:
            t = text(rng.randrange(0, 120))
            for _ in range(rng.randrange(0, 3)):
                t = t + rng.choice(["", " ", "\n"]) + rng.choice(passages) + text(rng.randrange(0, 20))
        rows.append((i, t))
    rows += [(n_docs, None), (n_docs + 1, ""), (n_docs + 2, "a" * 400), (n_docs + 3, "a" * 300 + "b" * 49),
             (3, passages[0]), (None, passages[1]), (n_docs + 4, "x" * 50), (n_docs + 5, "y" + "x" * 50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot,chunk", [(sd.HOT, sd.CHUNK_BYTES), (2, 3000), (0, 500), (sd.HOT, 700)])
def test_equals_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(sd, "PART_ROWS", 50)
    rows = corpus(len(str(hot)) + chunk, 120)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").repartition(3)
    order = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r) for r in sd.report(docs).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


@pytest.mark.parametrize("chunk", [sd.CHUNK_BYTES, 600])
def test_anchors_dealt_by_segment_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(sd, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 4000)
    rows = corpus(chunk, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = {"hot": 0}
    found = sd._hot_anchors
    monkeypatch.setattr(sd, "_hot_anchors", lambda *a: seen.update(hot=(x := found(*a)).size) or x)
    order = lambda r: tuple((x is None, str(x)) for x in r)
    out = sd.remove_repeats(docs, hot_entries=3, sample=1)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out.collect()), key=order)
    assert got == sorted(brute(rows), key=order)
    assert seen["hot"] > 5


def test_rows_that_repeat_an_id_are_cut_alike(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 150)
    words = [f"word{k}" for k in range(40)]
    base = " ".join(words)
    rows = [(1, base), *[(5, "other " + base[:160] + f" end of it")] * 4, *[(None, "another " + base[30:200])] * 3]
    out = [tuple(r) for r in sd.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(out, key=str) == sorted(brute(rows), key=str)


def test_a_line_of_all_documents_bounds_the_largest_bucket(spark, monkeypatch):
    """One line in otherwise different documents: its edges' anchors have a segment a document."""
    monkeypatch.setattr(sd, "CHUNK_BYTES", 1 << 15)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 1 << 15)
    rng = random.Random(3)
    line = "all of these documents end or begin with the very same line of eighty five characters"
    free = lambda: "".join(rng.choice("abcdefghij ") for _ in range(60))
    rows = [(i, free() + line + free()) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    total = sum(len(t) for _, t in rows)
    buckets = -(-total // sd.BUCKET_BYTES)
    chunks = sd._chunks(docs, total, 4)

    def largest(hot):
        kept = spark.sparkContext.broadcast(hot)
        sizes = sd._send(chunks, buckets, kept).selectExpr("bucket", "length(segs) / 8 as n").groupBy("bucket").sum("n").collect()
        return max(r[1] for r in sizes), sum(r[1] for r in sizes) / buckets

    plain, mean = largest(np.zeros(0, np.uint64))
    split, _ = largest(sd._hot_anchors(chunks, 4, 500))
    assert plain > 3 * mean
    assert split < 2 * mean


def test_empty_table(spark):
    assert sd.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
