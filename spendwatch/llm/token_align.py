"""Alignment of two tokenisations of one text, with corpus-wide link counts.

A link is a pair of token occurrences, one of each side, whose byte ranges
overlap.  The ends of both sides cut the text into elementary pieces, and each
piece is exactly one link; the ends that both sides share cut it into groups.

How often a pair of ids is linked in the whole corpus is counted externally:

1. A task encodes documents by the chunk and aligns them in flushes of at most
   FLUSH_BYTES of text.  A flush writes its pair-document records, sorted by
   side B's id, A's id and document, as one zstd run per radix of B's id.
2. Each partition of that table merges its own runs, radix by radix, through a
   heap of run heads into runs of counts; these are merged again, at most
   MERGE_BYTES a task, until one run a radix is left.
3. Order by B's id first gives each B id's counts in a row, thus its maximum.
   The record runs pass by their radix' counts once more and give every
   document its contributions, which are summed by chunk.

A merge holds the compressed runs and one block of each; no step holds an id's
records together, so an id in every document is no hot group.  The radices bound
the count tables, lanes of about MERGE_BYTES the passes over records.

Texts of more than SEGMENT characters are encoded in segments.  They are cut
only before a single space between two other non-blank characters, where
neither side has a token that goes on: side A starts a word there by its
pattern, side B has no piece with a space after another character (checked when
the model is loaded; without that, texts are not cut).  For the same reason side
B's words are encoded once and remembered.

Defined cases: null and empty texts, and texts whose tokens' bytes do not join
to a space and the text, have no tokens: zeros and an empty ``groups_sha256``;
repeated rows are documents of their own and each counts; null ids are kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import empty_if_null, stage, trimmed
from spendwatch.llm.packing import encoder, ids_of

RADICES = 32
FLUSH_BYTES = 4 << 20
CHUNK_BYTES = 16 << 20
MERGE_BYTES = 64 << 20
SEGMENT = 1 << 20
BLOCK = 1 << 15
WORDS_KEPT = 1 << 18
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_sides: dict[tuple[str, str], "Sides"] = {}


class Sides:
    """Both tokenisers: ids and bytes of their tokens, loaded once per worker."""

    def __init__(self, vocabulary: str, model: str):
        import public_tokenizers
        import sentencepiece
        self.encode_a = ids_of(vocabulary, False)
        ranks = encoder(public_tokenizers.path(vocabulary))
        self.bytes_a = [ranks.decode_single_token_bytes(i) for i in range(ranks.max_token_value + 1)]
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = len(self.bytes_a)
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.words: dict[str, list[int]] = {"": [self.model.piece_to_id(SPACE)]}
        # An id and the mark after it: "," within a side, "|" after side A, ";" after side B.
        name = [np.array([b"%d%s" % (i, mark) for i in range(n)], object)
                for n, marks in ((self.size_a, b",|"), (len(pieces), b",;")) for mark in (marks[:1], marks[1:])]
        self.names = np.concatenate(name)
        self.start = np.cumsum([0, *map(len, name[:3])])

    def encode_b(self, text: str) -> list[int]:
        if not self.by_word:
            return self.model.encode(text, num_threads=1)
        ids: list[int] = []
        known = self.words
        for word in self.split(text):
            own = known.get(word)
            if own is None:
                own = self.model.encode(word, num_threads=1)
                if len(word) <= 64:
                    if len(known) >= WORDS_KEPT:
                        known.clear()
                        known[""] = [self.model.piece_to_id(SPACE)]
                    known[word] = own
            ids += own
        return ids

    @staticmethod
    def split(text: str) -> list[str]:
        """The words, without the space before each; further spaces go with the word after them."""
        words, blanks = [], 0
        for word in text.split(" "):
            if word:
                words.append(" " * blanks + word)
                blanks = 0
            else:
                blanks += 1
        if blanks:  # at the end: a last word of one space less, for its own is implied
            words.append(" " * (blanks - 1))
        return words

    def segments(self, text: str) -> Iterator[str]:
        at = 0
        while self.by_word and len(text) - at > SEGMENT:
            cut = _CUT.search(text, at + SEGMENT)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    def encode(self, text: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of both sides by segment; none if the joined bytes are not a space and the text."""
        out = []
        for part in self.segments(text) if text else ():
            raw = b" " + part.encode()
            a, b = self.encode_a(" " + part), self.encode_b(part)
            if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                return []
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return out


def sides(vocabulary: str, model: str) -> Sides:
    if (vocabulary, model) not in _sides:
        _sides[vocabulary, model] = Sides(vocabulary, model)
    return _sides[vocabulary, model]


def align(s: Sides, parts: list[tuple[np.ndarray, np.ndarray]]):
    """For texts encoded by both sides: per text its links, groups and group string; per link its text and pair key."""
    n_a = np.array([len(a) for a, _ in parts])
    n_b = np.array([len(b) for _, b in parts])
    a, b = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
    end_a, end_b = np.cumsum(s.length_a[a]), np.cumsum(s.length_b[b])
    size = int(end_a[-1]) + 1
    at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
    at_a[end_a] = at_b[end_b] = True
    upto_a, upto_b = np.cumsum(at_a, dtype=np.int32), np.cumsum(at_b, dtype=np.int32)
    both = at_a & at_b
    ends = end_a[np.cumsum(n_a) - 1]
    pieces = np.flatnonzero(at_a | at_b)
    # A piece ending at p lies in the first token of each side that ends at p or later.
    keys = b[upto_b[pieces - 1]] * s.size_a + a[upto_a[pieces - 1]]
    n_links = np.diff(np.searchsorted(pieces, ends, "right"), prepend=0)
    upto = np.cumsum(both, dtype=np.int32)
    n_groups = np.diff(upto[ends], prepend=0)
    # Names in the order group by group, side A before side B.
    shared = np.flatnonzero(both)
    place_a = np.arange(a.size) + np.append(0, upto_b[shared])[upto[end_a - 1]]
    place_b = np.arange(b.size) + upto_a[shared][upto[end_b - 1]]
    order = np.empty(a.size + b.size, np.int64)
    order[place_a] = a + np.where(both[end_a], s.start[1], s.start[0])
    order[place_b] = b + np.where(both[end_b], s.start[3], s.start[2])
    names = s.names[order].tolist()
    bounds = np.append(0, np.cumsum(n_a + n_b))
    groups = [b"".join(names[i:j])[:-1] for i, j in zip(bounds, bounds[1:])]
    return n_links, n_groups, groups, np.repeat(np.arange(len(parts)), n_links), keys


def write_run(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Records in key order as zstd blocks: lengths, key differences and values."""
    pack = zstandard.ZstdCompressor(level=3)
    blocks = []
    for i in range(0, keys.size, BLOCK):
        own = [np.diff(keys[i:i + BLOCK], prepend=0), *(v[i:i + BLOCK] for v in values)]
        body = pack.compress(b"".join(x.astype("<i8").tobytes() for x in own))
        blocks += [len(body).to_bytes(4, "little"), body]
    return b"".join(blocks)


def read_run(run: bytes, width: int) -> Iterator[list[np.ndarray]]:
    """The blocks of a run: keys and ``width`` - 1 value columns."""
    unpack, at = zstandard.ZstdDecompressor(), 0
    while at < len(run):
        size = int.from_bytes(run[at:at + 4], "little")
        own = np.frombuffer(unpack.decompress(run[at + 4:at + 4 + size]), "<i8").reshape(width, -1)
        yield [np.cumsum(own[0]), *own[1:]]
        at += 4 + size


def heads(run: bytes, width: int, size_a: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A run's B ids in order, each with its keys and their last column."""
    for keys, *values in read_run(run, width):
        ids = keys // size_a
        bounds = np.flatnonzero(np.diff(ids)) + 1
        for i, j in zip([0, *bounds], [*bounds, keys.size]):
            yield int(ids[i]), keys[i:j], values[-1][i:j]


def merge(runs: list[tuple[bytes, int]], size_a: int) -> bytes:
    """k-way heap merge, by B id, of runs of (body, width) into one run of keys and summed counts."""
    streams = [heads(body, width, size_a) for body, width in runs]
    heap = [(head[0], k, head) for k, stream in enumerate(streams) if (head := next(stream, None))]
    heapq.heapify(heap)
    keys, counts = [], []
    while heap:
        current, held = heap[0][0], []
        while heap and heap[0][0] == current:
            _, k, head = heap[0]
            held.append(head)
            following = next(streams[k], None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], k, following))
        own, place = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
        total = np.zeros(own.size, np.int64)
        np.add.at(total, place, np.concatenate([h[2] for h in held]))
        keys.append(own)
        counts.append(total)
    return write_run(np.concatenate(keys), np.concatenate(counts))


_RUNS = "chunk string, radix int, body binary"
_PER_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int32(), pa.binary()))],
                                      names=["chunk", "radix", "body"])


class _Chunk:
    """Documents whose rows and records travel together."""

    def __init__(self):
        self.name = uuid.uuid4().hex
        self.ids: list = []
        self.counts: list[list[int]] = []
        self.hashes: list = []
        self.pending: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.size = self.waiting = 0

    def flush(self, s: Sides) -> Iterator[pa.RecordBatch]:
        if not self.pending:
            return
        n_links, n_groups, groups, part, keys = align(s, [(a, b) for _, a, b in self.pending])
        docs = np.array([d for d, _, _ in self.pending])
        for (d, a, b), links, found, text in zip(self.pending, n_links.tolist(), n_groups.tolist(), groups):
            if self.hashes[d] is None:
                self.hashes[d] = hashlib.sha256(text)
            else:
                self.hashes[d].update(b";" + text)
            for at, n in enumerate((len(a), len(b), found, links)):
                self.counts[d][at] += n
        self.pending, self.waiting = [], 0
        radix = keys // s.size_a % RADICES
        both, n = np.unique((radix * (keys.max() + 1) + keys) * len(self.ids) + docs[part], return_counts=True)
        pair, doc = np.divmod(both, len(self.ids))
        radix, pair = np.divmod(pair, keys.max() + 1)
        bounds = np.searchsorted(radix, np.arange(RADICES + 1))
        rows = [(self.name, r, write_run(pair[i:j], doc[i:j], n[i:j])) for r, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j]
        yield _rows(rows)

    def close(self) -> pa.RecordBatch:
        columns = [pa.array(self.ids, pa.int64()), *(pa.array([c[k] for c in self.counts], pa.int64()) for k in range(4)),
                   pa.array(["" if h is None else h.hexdigest() for h in self.hashes])]
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", *_PER_DOC, "groups_sha256"])
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return _rows([(self.name, -1, sink.getvalue().to_pybytes())])


def records(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """chunk, radix, body: record runs, and one row of radix -1 with the documents of each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, chunk = sides(vocabulary, model), _Chunk()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk.ids.append(doc_id)
                chunk.counts.append([0] * 4)
                chunk.hashes.append(None)
                chunk.size += 64
                for a, b in s.encode(text.as_py()):
                    chunk.pending.append((len(chunk.ids) - 1, a, b))
                    size = int(s.length_a[a].sum())
                    chunk.size += size
                    chunk.waiting += size
                    if chunk.waiting >= FLUSH_BYTES:
                        yield from chunk.flush(s)
                if chunk.size >= CHUNK_BYTES:
                    yield from chunk.flush(s)
                    yield chunk.close()
                    chunk = _Chunk()
        if chunk.ids:
            yield from chunk.flush(s)
            yield chunk.close()

    plain = trimmed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), empty_if_null("text"))
    return plain.mapInArrow(run, _RUNS)


def _merged(runs: DataFrame, size_a: int, width: int) -> DataFrame:
    """One run of counts for each radix within each partition of ``runs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, int]]] = {}
        for batch in batches:
            for radix, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(radix, []).append((body, width))
        for radix in sorted(held):
            body = merge(held.pop(radix), size_a)
            yield pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([body], pa.binary())], names=["radix", "body"])

    return runs.select("radix", "body").mapInArrow(run, "radix int, body binary")


def totals(runs: DataFrame, size_a: int, merge_bytes: int = MERGE_BYTES) -> DataFrame:
    """radix, body: one run of all pairs' counts for each radix, from the record runs."""
    counts = stage(_merged(runs, size_a, 3), "align-counts")
    while True:
        most = (counts.groupBy("radix").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("bytes"))
                .agg(F.max("n").alias("n"), F.max("bytes").alias("bytes")).first())
        if (most["n"] or 0) <= 1:
            return counts
        lanes = max(1, min(most["n"] // 2, -(-most["bytes"] // merge_bytes)))
        lane = F.pmod(F.xxhash64("body"), F.lit(lanes))
        counts = stage(_merged(counts.repartition(RADICES * lanes, "radix", lane), size_a, 2), "align-counts")


def contributions(runs: DataFrame, counts: DataFrame, size_a: int, merge_bytes: int = MERGE_BYTES) -> DataFrame:
    """chunk, radix, body: of each record run, the links of best pairs and the sum of counts per document."""
    total = runs.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    lanes = max(1, -(-total // (RADICES * merge_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        of = pairs = count = best = None
        for batch in batches:
            rows = []
            for radix, chunk, body in zip(*(batch.column(c).to_pylist() for c in ("radix", "chunk", "body"))):
                if chunk is None:
                    blocks = list(read_run(body, 2))
                    of = radix
                    pairs, count = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
                    first = np.flatnonzero(np.diff(pairs // size_a, prepend=-1))
                    best = count == np.repeat(np.maximum.reduceat(count, first), np.diff(np.append(first, count.size)))
                    continue
                if of != radix:
                    raise ValueError(f"no counts before the runs of radix {radix}")
                sums: list[np.ndarray] = [np.zeros(0), np.zeros(0)]
                for keys, doc, n in read_run(body, 3):
                    at = np.searchsorted(pairs, keys)
                    for k, each in enumerate((n * best[at], n * count[at])):
                        own = np.zeros(max(sums[k].size, int(doc.max()) + 1), np.int64)
                        own[:sums[k].size] = sums[k]
                        np.add.at(own, doc, each)
                        sums[k] = own
                rows.append((chunk, radix, pack.compress(np.concatenate(sums).astype("<i8").tobytes())))
            if rows:
                yield _rows(rows)

    lane = F.pmod(F.xxhash64("chunk"), F.lit(lanes)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    both = runs.select("radix", lane.alias("lane"), "chunk", "body").unionByName(
        counts.select("radix", every.alias("lane"), F.lit(None).cast("string").alias("chunk"), "body"))
    return (both.repartition(RADICES * lanes, "radix", "lane").sortWithinPartitions("radix", "lane", F.col("chunk").asc_nulls_first())
            .mapInArrow(run, _RUNS))


def alignments(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", model: str = "piece_bpe_32k.model",
               merge_bytes: int = MERGE_BYTES) -> DataFrame:
    """One row per document: tokens, groups, links, links of a B id's most frequent pairs, and the sum of all links' counts."""
    size_a = sides(vocabulary, model).size_a
    table = stage(records(docs, vocabulary, model), "align-records")
    runs = table.where("radix >= 0")
    parts = table.where("radix < 0").unionByName(contributions(runs, totals(runs, size_a, merge_bytes), size_a, merge_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held: pa.RecordBatch | None = None
        best = total = None

        def done() -> pa.RecordBatch:
            columns = [*held.columns, pa.array(best), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, names=[*held.schema.names, "n_best", "count_sum"])

        for batch in batches:
            for radix, body in zip(*(batch.column(c).to_pylist() for c in ("radix", "body"))):
                if radix < 0:
                    if held is not None:
                        yield done()
                    held = pa.ipc.open_stream(body).read_next_batch()
                    best, total = np.zeros(held.num_rows, np.int64), np.zeros(held.num_rows, np.int64)
                else:
                    own = np.frombuffer(unpack.decompress(body), "<i8").reshape(2, -1)
                    best[:own.shape[1]] += own[0]
                    total[:own.shape[1]] += own[1]
        if held is not None:
            yield done()

    out = (parts.repartition("chunk").sortWithinPartitions("chunk", "radix")
           .mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
