"""op13 against a plain version on the two libraries' own calls."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from spendwatch.llm import token_align
from spendwatch.llm.queries import op13_token_align
from tests.conftest import SF_SMALL

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_of():
    """The character of each byte in a byte-level vocabulary, inverted."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def plain():
    path = public_tokenizers.path("byte_bpe_50k.json")
    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    of = byte_of()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    bytes_a = {i: bytes(of[c] for c in t) for t, i in vocabulary.items() if all(c in of for c in t)}

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def spans(text):
        if not text:
            return [], []
        raw, out = (" " + text).encode(), []
        for ids, own in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a.__getitem__), (b.encode(text), bytes_b)):
            at, side = 0, []
            for i in ids:
                side.append((i, at, at := at + len(own(i))))
            if b"".join(own(i) for i in ids) != raw:
                return [], []
            out.append(side)
        return out

    def run(rows):
        links, parts = [], []
        for doc_id, text in rows:
            side_a, side_b = spans(text)
            own, k = [], 0
            for i, x, y in side_a:
                while k < len(side_b) and side_b[k][2] <= x:
                    k += 1
                j = k
                while j < len(side_b) and side_b[j][1] < y:
                    own.append((i, side_b[j][0]))
                    j += 1
            cuts = sorted({y for *_, y in side_a} & {y for *_, y in side_b})
            groups, low = [], 0
            for cut in cuts:
                groups.append("|".join(",".join(str(i) for i, x, y in side if low <= x and y <= cut) for side in (side_a, side_b)) if len(side_a) < 3000 else None)
                low = cut
            parts.append((doc_id, len(side_a), len(side_b), groups))
            links.append(own)
        count = Counter(p for own in links for p in own)
        best = {}
        for (_, b_id), n in count.items():
            best[b_id] = max(best.get(b_id, 0), n)
        out = []
        for (doc_id, n_a, n_b, groups), own in zip(parts, links):
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups and None not in groups else "" if not groups else None
            out.append((doc_id, n_a, n_b, len(groups), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), digest))
        return out
    return run


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


TEXTS = [None, "", " ", "  ", "a", "a ", " a", "a  b   c", "x▁ y", "▁", "<s> </s> <unk> <0x41> <|endoftext|>", "é𝄞　ﬁ x́", "\n\n a\r\n\tb \n", "the the the cat", "don't can't", "a\x00b",
         "supercalifragilistic 123456789 1,234.5", "日本語テキスト 中文", "=" * 90, "the cat", "the cat"]


def test_alignment_equals_the_libraries_and_all_pairs(spark, plain):
    rng = random.Random(3)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "é", "日", "▁", "9", "'s", "<", "\t", "😀", "-"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(120)]
    rows = [*enumerate(texts), (3, "repeated words words"), (3, "repeated words words"), (None, "no id here")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, chunk int, radix string").repartition(5)
    expected = sorted(plain(rows), key=str)
    assert rows_of(token_align.alignments(docs)) == expected
    assert rows_of(token_align.alignments(docs, merge_bytes=1 << 10)) == expected


def test_segments_flushes_chunks_and_merge_rounds_change_nothing(spark, plain, monkeypatch):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta's", "naïve", "x1", "Zürich,", "  ", "\n", "42.", "日本"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 300))) for _ in range(12)]
    rows = list(enumerate(texts))
    s = token_align.sides("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    monkeypatch.setattr(token_align, "SEGMENT", 40)
    for text in texts + [t for t in TEXTS if t]:
        whole = (s.encode_a(" " + text), s.model.encode(text))
        parts = s.encode(text)
        if parts:
            assert [[int(i) for p in parts for i in p[k]] for k in (0, 1)] == [list(x) for x in whole]
    assert max(len(s.encode(t)) for t in texts) > 3
    # The same rows through small flushes, chunks and merges, task by task without Spark.
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(plain(rows), key=str)
    monkeypatch.setattr(token_align, "FLUSH_BYTES", 100)
    monkeypatch.setattr(token_align, "BLOCK", 7)
    chunk = token_align._Chunk()
    bodies = []
    for i, t in rows:
        chunk.ids.append(i)
        chunk.counts.append([0] * 4)
        chunk.hashes.append(None)
        for a, b in s.encode(t):
            chunk.pending.append((len(chunk.ids) - 1, a, b))
            for batch in chunk.flush(s):
                bodies += batch.to_pylist()
    assert len(bodies) > 100
    assert [(c[0], c[1], c[2], c[3], h.hexdigest()) for c, h in zip(chunk.counts, chunk.hashes)] == [
        (r[1], r[2], r[3], r[4], r[7]) for r in sorted(plain(rows))]
    got = token_align.merge([(r["body"], 3) for r in bodies], s.size_a)
    twice = token_align.merge([(token_align.merge([(r["body"], 3) for r in bodies[k::4]], s.size_a), 2) for k in range(4)], s.size_a)
    assert got == twice
    assert rows_of(token_align.alignments(docs)) == expected


def test_very_long_texts(spark, plain):
    rng = random.Random(8)
    long = " ".join(rng.choice(["one", "two", "three,", "four4", "fünf"]) for _ in range(300_000))
    rows = [(1, long), (2, "x" * 50_000), (3, "one two")]
    got = {r.doc_id: r for r in token_align.alignments(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    s = token_align.sides("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    assert len(s.encode(long)) > 1
    assert got[1].n_a == len(s.encode_a(" " + long)) and got[1].n_b == len(s.model.encode(long))
    assert got[2].n_links > 0 and got[3].n_links == got[3].n_a


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.alignments(empty).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(token_align.alignments(nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_equals_the_plain_version_on_whole_documents(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for got, expected in zip(rows_of(op13_token_align(spark, SF_SMALL)), sorted(plain(rows), key=str)):
        assert got[:7] == expected[:7]
        if expected[7] is not None:
            assert got[7] == expected[7]
