import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from spendwatch.llm import packing


def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def texts():
    rng = random.Random(4)
    out = [None, "", "a", "<|endoftext|> x", "é𝄞\u0085\u2028 \u00a0", " " * 50, "word " * 3000, "x" * 5000]
    return out + ["".join(chr(rng.choice([32, 10, rng.randrange(33, 127), rng.randrange(0xA1, 0x500)])) for _ in range(rng.randrange(900))) for _ in range(60)]


def test_pieces_equal_the_tokenizers_library_and_fill_sequences(spark):
    rows = list(enumerate(texts())) + [(3, "repeated"), (3, "repeated")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("zzz", "zzz")
    out = packing.pack(docs, with_ids=True).collect()
    t = tokenizer()
    expected = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) - 2048 * (-(-len(ids) // 2048) - 1)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            raw = np.array(ids[a:b], "<u4").tobytes()
            expected.append((i, k, a, b - a, zlib.crc32(raw), raw))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in out]
    assert sorted(got) == sorted(expected)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.1 * sum(e[3] for e in expected) / 2048 + 1


def naive_best_fit(lengths, capacity, limit):
    open_bins, bins, used = {}, [], 0
    for n in lengths:
        fits = [(free, b) for b, free in open_bins.items() if free >= n]
        if fits:
            least = min(f for f, _ in fits)
            choice = [b for f, b in fits if f == least]
        else:
            if len(open_bins) == limit:
                least = min(open_bins.values())
                open_bins.pop(next(b for b, f in open_bins.items() if f == least))
            choice = [used]
            open_bins[used] = capacity
            used += 1
        bins.append((choice, open_bins[choice[0]]))
        open_bins[choice[0]] -= n
        if open_bins[choice[0]] == 0:
            open_bins.pop(choice[0])
    return bins, used


def test_best_fit_takes_the_fullest_bin_that_fits_and_bounds_open_bins():
    rng = random.Random(2)
    for limit in (1, 3, 10_000):
        lengths = [rng.randrange(1, 65) for _ in range(500)]
        bins, offsets = packing.best_fit(lengths, 64, limit)
        plain, used = naive_best_fit(lengths, 64, limit)
        assert [64 - o for o in offsets] == [free for _, free in plain]
        assert max(bins) + 1 == used


def test_groups_are_packed_online_in_order_with_bounded_bins(spark):
    rng = random.Random(6)
    rows = [(i, "word " * rng.randrange(1, 700)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for bound, falling in ((3, False), (packing.OPEN_BINS, False), (packing.OPEN_BINS, True)):
        out = packing.pack(docs, open_bins=bound, falling=falling).collect()
        out.sort(key=lambda r: (-r.length if falling else 0, r.doc_id, r.piece))
        plain, used = naive_best_fit([r.length for r in out], packing.CAPACITY, bound)
        assert [packing.CAPACITY - r.offset for r in out] == [free for _, free in plain]
        assert len({r.sequence_id for r in out}) == used


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, offset int")).count() == 0


def test_special_tokens_and_long_whitespace_equal_the_library_with_its_defaults(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext>", " " * 1_000_000 + "x", "\n " * 700_000 + "x",
             "　" * 100_000 + "<|endoftext|>", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = {}
    for r in packing.pieces(docs, with_ids=True, special_tokens=True).orderBy("doc_id", "piece").collect():
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    for i, text in enumerate(texts):
        assert ids[i] == np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert np.frombuffer(ids[0], "<u4").tolist() == [64, 50256, 65, 0]


def test_the_queries_take_the_library_defaults(spark, tmp_path):
    import corpus_pipeline
    from spendwatch.llm.queries import op10_packing
    spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    crc = zlib.crc32(np.array([64, 50256, 65, 0], "<u4").tobytes())
    assert [r.ids_crc32 for r in op10_packing(spark, str(tmp_path)).collect()] == [crc]
    assert [r.ids_crc32 for r in corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path)).collect()] == [crc]
