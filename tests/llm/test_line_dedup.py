"""op11: filters, counts and reversibility against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.llm import line_dedup
from spendwatch.llm.line_dedup import Cuckoo, Index, delete, drop_lines, insert

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain(corpus, texts, least):
    """Lines before, lines dropped and the text kept, of ``texts`` against the counts of ``corpus``."""
    count = Counter(k for t in corpus for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def frame(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def result(df):
    return [tuple(r) for r in df.orderBy("doc_id").select("n_lines", "n_dropped", "text").collect()]


def texts(seed, n=80):
    rng = random.Random(seed)
    common = ["Home", " home\t", "HOME", "É", "é", " nbsp", "Share this", "x" * 300, "\x0b\x0cok\r", "ok"]
    return [None, "", "\n", "\n\n", " \t"] + [
        "\n".join(rng.choice([*common, "", "  ", f"line {rng.randrange(40)}", f"unique {seed} {i} {j}"]) for j in range(rng.randrange(1, 9))) for i in range(n)]


def test_cuckoo_filter_holds_removes_and_rarely_lies():
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63, 40_000)
    cuckoo = Cuckoo(1 << 14)  # 61 % full
    cuckoo.add(keys)
    assert cuckoo.has(keys).all() and not any(cuckoo.stash.values())
    assert np.count_nonzero(cuckoo.table) == cuckoo.held == keys.size
    assert not cuckoo.has(rng.integers(-2**63, 2**63, 100_000)).any()
    cuckoo.remove(keys[:30_000])
    assert cuckoo.has(keys[30_000:]).all() and cuckoo.has(keys[:30_000]).mean() < 1e-3
    cuckoo.add(keys[:1000])
    assert cuckoo.has(keys[:1000]).all() and cuckoo.held == 11_000
    with pytest.raises(ValueError):
        cuckoo.remove(np.array([12345]))


def test_surplus_of_one_bucket_lies_in_the_stash(monkeypatch):
    monkeypatch.setattr(line_dedup, "ROUNDS", 20)
    cuckoo, same = Cuckoo(4), np.full(12, (7 << 32) | 1)
    cuckoo.add(same)
    assert sum(cuckoo.stash.values()) == 4 and cuckoo.has(same[:1]).all()
    for _ in range(12):
        assert cuckoo.has(same[:1]).all()
        cuckoo.remove(same[:1])
    assert not cuckoo.has(same[:1]).any() and cuckoo.held == 0


def test_shard_agrees_between_tasks_and_sql(spark):
    high = np.array([0, 1, -1, 2**63 - 1, -2**63, 12345678901234567, -98765], np.int64)
    got = spark.createDataFrame([(int(h),) for h in high], "high long").select(line_dedup._shard(Index(shards=7))).collect()
    assert [r[0] for r in got] == line_dedup.shard_of(high, 7).tolist()


def test_lines_drop_as_in_plain_python(spark):
    corpus = texts(1)
    docs = frame(spark, corpus)
    index = insert(Index(), docs)
    expected = plain(corpus, corpus, 10)
    assert sum(d for _, d, _ in expected) > 50
    assert result(drop_lines(docs, index)) == expected
    # Filters too large to ship: the salted join gives the same.
    assert result(drop_lines(docs, index, filter_bytes=0)) == expected
    got = line_dedup.report(docs).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_dropped, r.kept_sha256) for r in got] == [(n, d, hashlib.sha256(t.encode()).hexdigest()) for n, d, t in expected]


def test_insertions_and_deletions_are_reversible(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 8)  # several shards, and more of them as keys come
    a, b, c = texts(1), texts(2), texts(3, 30)
    parts = [frame(spark, x, 1000 * k) for k, x in enumerate((a, b, c))]
    one = insert(Index(), parts[0])
    two = insert(one, parts[1])
    three = insert(two, parts[2])
    assert one.shards > 1 and three.shards >= one.shards
    assert result(drop_lines(parts[0], one)) == plain(a, a, 10)
    assert result(drop_lines(parts[0], three)) == plain(a + b + c, a, 10)
    back = delete(three, parts[1])
    assert result(drop_lines(parts[0], back)) == plain(a + c, a, 10)
    assert result(drop_lines(parts[1], back)) == plain(a + c, b, 10)
    # Counts and filters are those of an index that never saw the deleted documents.
    fresh = insert(insert(Index(), parts[0]), parts[2])
    same = lambda x, y: sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
    assert same(line_dedup.counts(spark, back), line_dedup.counts(spark, fresh))
    assert same(line_dedup.counts(spark, line_dedup.compact(spark, back)), line_dedup.counts(spark, fresh))
    held = lambda i: spark.read.parquet(i.filters).agg(F.sum("keys")).first()[0]
    assert held(back) == held(fresh) == line_dedup.frequent(spark, fresh).count()
    assert result(drop_lines(parts[2], line_dedup.compact(spark, back))) == plain(a + c, c, 10)
    # A handle still describes the index as it was.
    assert result(drop_lines(parts[0], one)) == plain(a, a, 10)
    gone = delete(delete(back, parts[0]), parts[2])
    assert line_dedup.counts(spark, gone).count() == 0 and held(gone) == 0
    assert result(drop_lines(parts[0], gone)) == plain([], a, 10)
    with pytest.raises(ValueError, match="not inserted"):
        delete(one, parts[1])


def test_keys_that_pass_without_being_frequent_are_found(spark, monkeypatch):
    corpus = texts(4)
    docs = frame(spark, corpus)
    index = insert(Index(), docs)
    # An index whose counts lost a key that the filter still holds.
    lost = line_dedup.frequent(spark, index).orderBy("high").limit(1)
    path = line_dedup._written(line_dedup.counts(spark, index).join(lost, line_dedup.KEY, "left_anti"), "layer")
    import dataclasses
    wrong = dataclasses.replace(index, layers=(path,))
    assert result(drop_lines(docs, wrong)) == result(drop_lines(docs, wrong, filter_bytes=0)) != plain(corpus, corpus, 10)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    index = insert(Index(), empty)
    assert index == Index() and drop_lines(empty, index).collect() == [] and line_dedup.report(empty).collect() == []
    rows = [(5, "again\nown", 1, 2)] * 6 + [(None, "AGAIN \nother", 3, 4)] * 4 + [(9, "x" * 3_000_000 + "\nagain", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, gone_high int")
    out = drop_lines(docs, insert(Index(), docs))
    assert out.columns == ["doc_id", "gone_high", "n_lines", "n_dropped", "text"]
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, len(r.text), r.gone_high) for r in out.collect())
    assert got == sorted([("5", 2, 1, 3, 2)] * 6 + [("None", 2, 1, 5, 4)] * 4 + [("9", 2, 1, 3_000_000, 6)])


def test_one_line_in_every_document_reaches_the_counts_once_per_task(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("same\nown "), "id").alias("text")).repartition(4)
    index = insert(Index(), docs)
    assert line_dedup.frequent(spark, index).count() == 1
    assert drop_lines(docs, index).where("n_dropped <> 1 or text <> concat('own ', doc_id)").count() == 0
