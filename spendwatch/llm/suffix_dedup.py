"""Exact removal of repeated byte strings with suffix arrays.

A byte goes when it is covered by a ``LENGTH``-byte string that also starts in a
document with a smaller doc_id.  Sorting every suffix of a corpus would ship
each many times, so the work is narrowed first, without losing a match:

1. Documents are laid out in chunks (a bucketed table in the shared folder).
2. In every window of LENGTH bytes the ``GRAM``-byte gram with the least hash is
   the window's anchor, so equal windows have equal anchors.  Consecutive
   windows with one anchor form a segment.  A chunk sends each distinct
   (anchor, segment hash) once, with its least doc_id.
3. Per anchor: a segment that a smaller document has too is removed whole.
   Where an anchor has several different segments, their first occurrences are
   compared as text.
4. Their texts are grouped by anchor.  A suffix array by two-stage sorting
   (suffixes smaller than their successors are sorted directly, the others are
   induced by scanning the buckets) puts equal windows side by side; common
   prefixes of neighbours of at least LENGTH give the classes of equal windows,
   and a window goes if its class has a smaller document.
5. The chunks collect what was decided and cut their documents.

An anchor with more than ``HOT`` segments (the edge of a passage that very many
documents share) is compared window by window instead, under the window's own
hash, after each chunk has kept the least document of every window.  Anchors
that a sample of the windows finds in more than ``HOT_ENTRIES`` segments are so
compared from the start, and their segments are dealt by segment instead of by
anchor, so that no bucket has to hold them all.  What still meets in one place
is a string's one entry for each chunk of ``CHUNK_BYTES`` that has it.

Defined cases: a null text is empty; documents with equal ids do not remove
each other's text; a null doc_id counts as the largest; shorter texts keep all.
A chunk's number is its place in the input, so ``docs`` should be a table (or a
written stage) that is read alike when a lost task is repeated.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm import shingles as sh
from spendwatch.llm.common import grouped, stage, trimmed, workers_import
from spendwatch.session import scratch_path

LENGTH, GRAM = 50, 24
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
PART_ROWS = 20_000
HOT = 5_000
HOT_ENTRIES = 20_000
MAX_HOT_ANCHORS = 1_000_000  # of 8 bytes each, sent to the workers
SAMPLE = 16  # one document and one segment of so many is looked at for hot anchors
NO_ID = np.iinfo(np.int64).max
_SLICE = 1 << 22
_U = np.uint64


# --- suffix array -----------------------------------------------------------

def _word_at(padded: np.ndarray, places: np.ndarray, shift: int) -> np.ndarray:
    """The eight bytes from places + shift, as numbers that compare like the bytes."""
    view = np.ndarray(shape=(padded.size - 7,), dtype=">u8", buffer=padded, strides=(1,))
    return view[places + shift].astype(_U)


def _direct(padded: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` by their first ``depth`` bytes; each pass only touches what is still tied."""
    order = places[np.argsort(_word_at(padded, places, 0), kind="stable")]
    first = _word_at(padded, order, 0)
    group = np.cumsum(np.concatenate([[0], (first[1:] != first[:-1]).astype(np.int64)])) if order.size else np.zeros(0, np.int64)
    for shift in range(8, depth, 8):
        size = np.bincount(group) if group.size else np.zeros(0, np.int64)
        at = np.flatnonzero(size[group] > 1) if group.size else np.zeros(0, np.int64)
        if at.size == 0:
            break
        word = _word_at(padded, order[at], shift)
        rank = np.lexsort((word, group[at]))
        order[at], word, g = order[at][rank], word[rank], group[at]
        split = np.zeros(group.size, np.int64)
        split[at[1:]] = (g[1:] == g[:-1]) & (word[1:] != word[:-1])
        group = group + np.cumsum(split)
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes of ``text`` in the order of (at least) their first ``depth`` bytes."""
    n = text.size
    if n == 0:
        return np.zeros(0, np.int64)
    step = np.sign(np.diff(text.astype(np.int16)))
    # A suffix is smaller than its successor if the next differing byte is larger; the last one is not.
    known = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(known[::-1])[::-1] if n > 1 else known
    rising = np.zeros(n, dtype=bool)
    some = following < n
    rising[: n - 1][some] = step[following[some]] > 0
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    out = np.full(n, -1, np.int64)
    size = np.bincount(text, minlength=256)
    end = np.cumsum(size)
    direct = _direct(padded, np.flatnonzero(rising), depth)
    in_bucket = np.bincount(text[direct], minlength=256)
    offset = np.concatenate([[0], np.cumsum(in_bucket)])
    fill = end - size
    for c in np.flatnonzero(in_bucket):
        out[end[c] - in_bucket[c]:end[c]] = direct[offset[c]:offset[c + 1]]

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~rising[before]]
        byte = text[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        value, start, count = np.unique(byte, return_index=True, return_counts=True)
        for b, s, k in zip(value, start, count):
            out[fill[b]:fill[b] + k] = before[s:s + k]
            fill[b] += k

    out[fill[text[n - 1]]] = n - 1
    fill[text[n - 1]] += 1
    for c in np.flatnonzero(size):
        at = end[c] - size[c]
        while at < fill[c]:  # induced suffixes of this bucket may induce more of it
            stop = fill[c]
            induce(out[at:stop].copy())
            at = stop
        induce(out[end[c] - in_bucket[c]:end[c]])
    return out


def equal_windows(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A class number for each start (ascending): equal for windows with equal bytes."""
    order = suffix_array(text, length)
    wanted = np.zeros(text.size, dtype=bool)
    wanted[starts] = True
    order = order[wanted[order]]
    padded = np.concatenate([text, np.zeros(length + 16, np.uint8)])
    differs = np.zeros(max(order.size - 1, 0), dtype=bool)
    for shift in range(0, length, 8):
        word = _word_at(padded, order, shift)
        if shift + 8 > length:
            word = word >> _U(8 * (shift + 8 - length))
        differs |= word[1:] != word[:-1]
    number = np.concatenate([[0], np.cumsum(differs)]) if order.size else np.zeros(0, np.int64)
    out = np.zeros(text.size, np.int64)
    out[order] = number
    return out[starts]


# --- anchors ----------------------------------------------------------------

def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial of the bytes and the inverse powers."""
    power, inverse = sh._powers(data.size)
    total = np.zeros(data.size + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * power, out=total[1:])
    return total, inverse


def _span_hash(total, inverse, start, stop) -> np.ndarray:
    return sh.mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def _segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """anchor, segment hash, first and last window start of every segment, in order."""
    n, grams = data.size, LENGTH - GRAM + 1
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64))
    total, inverse = _hashes(data)
    g = sh.mix((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
    least = ((g >> _U(23)) << _U(23)) | np.arange(g.size, dtype=_U)
    width = 1
    while width * 2 <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = grams - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    owner = np.repeat(np.arange(offsets.size - 1), np.diff(offsets))[: least.size]
    valid = np.arange(least.size) + LENGTH <= offsets[1:][owner]
    start = np.flatnonzero(valid)
    if start.size == 0:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64))
    place = (least[start] & _U((1 << 23) - 1)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[start][1:] != owner[start][:-1])])
    at = np.flatnonzero(new)
    first, last = start[at], start[np.concatenate([at[1:], [start.size]]) - 1]
    anchor = place[at]
    key = g[anchor]
    seg = sh.mix(_span_hash(total, inverse, first, last + LENGTH) + (anchor - first).astype(_U))
    return key, seg, first, last


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``_segments`` of all documents, and each segment's document; a very long document goes in overlapping slices."""
    parts = []
    for i, j in sh.sub_batches(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        for s in range(lo, max(hi, lo + 1), _SLICE):
            e = min(hi, s + _SLICE + LENGTH - 1)
            local = np.array([0, e - s]) if hi - lo > _SLICE else offsets[i:j + 1] - lo
            key, seg, first, last = _segments(data[s:e], local)
            parts.append((key, seg, first + s, last + s))
    out = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, t) for t in (_U, _U, np.int64, np.int64)]
    return (*out, np.searchsorted(offsets, out[2], side="right") - 1)


def _among(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if among.size == 0:
        return np.zeros(values.size, bool)
    return among[np.minimum(np.searchsorted(among, values), among.size - 1)] == values


def _sampled_anchors(ids: np.ndarray, blob: bytes, lengths: np.ndarray, sample: int) -> np.ndarray:
    """The anchor of one of ``sample`` distinct segments, in one of ``sample`` documents."""
    places = sh.mix(ids.astype(_U) + np.arange(ids.size, dtype=_U) * _U(0x9E3779B97F4A7C15))
    chosen = np.flatnonzero(places % _U(sample) == 0)
    start = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(blob[start[d]:start[d + 1]] for d in chosen), np.uint8)
    key, seg, *_ = segments(data, np.concatenate([[0], np.cumsum(lengths[chosen])]))
    both, index = np.unique(sh.mix(key ^ sh.mix(seg + _U(0x51ED270B))), return_index=True)
    return key[index[both % _U(sample) == 0]]


class Chunk:
    """A chunk's documents with their segments; rebuilt alike in every pass."""

    def __init__(self, ids: bytes, lengths: bytes, blob: bytes, buckets: int, hot: np.ndarray):
        self.ids = np.frombuffer(ids, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int64))])
        self.data = np.frombuffer(blob, np.uint8)
        self.key, seg, self.first, self.last, self.doc = segments(self.data, self.offsets)
        both = sh.mix(self.key ^ sh.mix(seg + _U(0x51ED270B)))
        _, index, self.entry_of = np.unique(both, return_index=True, return_inverse=True)
        # Entries (distinct anchor and segment) in the order of their first occurrence, which has the least document.
        rank = np.argsort(index, kind="stable")
        number = np.empty(rank.size, np.int64)
        number[rank] = np.arange(rank.size)
        self.entry_of, self.entry = number[self.entry_of], index[rank]
        self.seg = seg
        # Anchors go to one bucket, those of the sorted ``hot`` by segment to all.
        anchor = self.key[self.entry]
        self.bucket = (np.where(_among(anchor, hot), both[self.entry], anchor) % _U(buckets)).astype(np.int64)

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(self.bucket, kind="stable")
        b = self.bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if b.size else []
        for s, e in zip(cut, [*cut[1:], b.size]):
            yield int(b[s]), order[s:e]

    def states(self, found: list) -> np.ndarray:
        """The state of every entry, from the buckets' answers."""
        out = np.zeros(self.entry.size, np.uint8)
        answers = {f["bucket"]: f["states"] for f in found or []}
        for b, entries in self.by_bucket():
            if b in answers:
                out[entries] = np.frombuffer(zlib.decompress(answers[b]), np.uint8)
        return out

    def hot_windows(self, states: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of the hot entries: entry, number in it, start, hash, and which row has the window's least document."""
        entries = np.flatnonzero(states == 3)
        first, last = self.first[self.entry[entries]], self.last[self.entry[entries]]
        count = last - first + 1
        entry = np.repeat(entries, count)
        number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(first, count) + number
        if start.size == 0:
            return entry, number, start, np.zeros(0, _U), start
        total, inverse = _hashes(self.data)
        h = _span_hash(total, inverse, start, start + LENGTH)
        _, index, back = np.unique(h, return_index=True, return_inverse=True)
        return entry, number, start, h, index[back]


# --- passes -----------------------------------------------------------------

def _chunks(docs: DataFrame, total: int, sample: int) -> DataFrame:
    """chunk, n_bytes, ids, lengths, blob, anchors (a sample): documents by id within a chunk;
    bucketed by chunk in the shared folder, about BUCKET_BYTES of the ``total`` bytes a bucket."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = sh.text_bytes(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for i, j in sh.sub_batches(offsets, CHUNK_BYTES):
                order = np.argsort(ids[i:j], kind="stable") + i
                blob = b"".join(data[offsets[d]:offsets[d + 1]].tobytes() for d in order)
                lengths = np.diff(offsets)[order]
                anchors = _sampled_anchors(ids[order], blob, lengths, sample)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([len(blob)], pa.int64()), pa.array([ids[order].tobytes()], pa.binary()),
                    pa.array([lengths.tobytes()], pa.binary()), pa.array([blob], pa.binary()), pa.array([anchors.tobytes()], pa.binary())],
                    names=["chunk", "n_bytes", "ids", "lengths", "blob", "anchors"])
                number += 1

    laid = trimmed(docs, "doc_id", "text").mapInArrow(
        run, "chunk long, n_bytes long, ids binary, lengths binary, blob binary, anchors binary")
    name = f"llm_chunks_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = max(1, min(most, -(-total // BUCKET_BYTES)))
    # Dealt like the buckets first: one file a bucket, whatever the number of tasks.
    (laid.repartition(buckets, "chunk").write.format("parquet").bucketBy(buckets, "chunk").option("compression", "zstd")
     .option("path", scratch_path(spark, "llm-suffix-chunks")).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry only; the files are read by their path
    return out


def _hot_anchors(chunks: DataFrame, sample: int, hot_entries: int) -> np.ndarray:
    """Sorted anchors that the sample finds in more than ``hot_entries`` segments, or in more than
    one of MAX_HOT_ANCHORS of all segments: so there are no more than MAX_HOT_ANCHORS of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], names=["anchor"])

    seen = chunks.select("anchors").mapInArrow(run, "anchor long")
    total = chunks.agg(F.sum(F.length("anchors")).alias("n")).first()["n"] or 0
    least = max(hot_entries // sample ** 2, total // 8 // MAX_HOT_ANCHORS)
    hot = seen.groupBy("anchor").count().where(F.col("count") > least).select("anchor").toArrow()
    return np.sort(hot.column(0).to_numpy().astype(np.int64).view(_U))


def _send(chunks: DataFrame, buckets: int, hot: Broadcast) -> DataFrame:
    """bucket, chunk, n, keys, segs, ids: each chunk's distinct segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, lengths, blob in zip(*(batch.column(c).to_pylist() for c in range(4))):
                c = Chunk(ids, lengths, blob, buckets, hot.value)
                key, seg, doc = c.key[c.entry], c.seg[c.entry], c.ids[c.doc[c.entry]]
                rows = [(b, chunk, (key[e] >> _U(32)).astype(np.uint32).tobytes(), seg[e].tobytes(),
                         zlib.compress(np.diff(doc[e], prepend=0).tobytes(), 1)) for b, e in c.by_bucket()]
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [pa.int64(), pa.int64(), *[pa.binary()] * 3])],
                                                 names=["bucket", "chunk", "keys", "segs", "ids"])

    return chunks.select("chunk", "ids", "lengths", "blob").mapInArrow(
        run, "bucket long, chunk long, keys binary, segs binary, ids binary")


def _answer(sent: DataFrame, hot: Broadcast) -> DataFrame:
    """chunk, bucket, states, n_open: per distinct segment 0 keep, 1 remove, 2 compare, 3 compare window by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_hot = np.unique((hot.value >> _U(32)).astype(np.uint32))
        for group in grouped(batches, "bucket"):
            key = np.concatenate([np.frombuffer(x, np.uint32) for x in group["keys"].to_pylist()])
            seg = np.concatenate([np.frombuffer(x, _U) for x in group["segs"].to_pylist()])
            ids = [np.cumsum(np.frombuffer(zlib.decompress(x), np.int64)) for x in group["ids"].to_pylist()]
            size = [x.size for x in ids]
            doc = np.concatenate(ids)
            order = np.lexsort((doc, seg, key))
            k, s, d = key[order], seg[order], doc[order]
            new_key = np.concatenate([[True], k[1:] != k[:-1]])
            new_seg = new_key | np.concatenate([[True], s[1:] != s[:-1]])
            seg_at, seg_no = np.flatnonzero(new_seg), np.cumsum(new_seg) - 1
            # Anchors with several segments in several documents: compare the occurrences in the first document.
            key_at = np.flatnonzero(new_key[seg_at])
            count = np.diff(np.append(key_at, seg_at.size))
            apart = (np.maximum.reduceat(d[seg_at], key_at) > np.minimum.reduceat(d[seg_at], key_at)) & (count > 1)
            kind = np.where(apart, np.where(count > HOT, 3, 2), 0).astype(np.uint8)
            kind[_among(k[seg_at][key_at], known_hot)] = 3  # its other segments are in other buckets
            state = np.where(d > d[seg_at][seg_no], 1, np.repeat(kind, count)[seg_no]).astype(np.uint8)
            back = np.empty_like(state)
            back[order] = state
            parts = np.split(back, np.cumsum(size)[:-1])
            rows = [(c, b, zlib.compress(p.tobytes(), 1), int((p > 1).sum())) for c, b, p in
                    zip(group["chunk"].to_pylist(), group["bucket"].to_pylist(), parts) if p.any()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.binary(), pa.int64()])],
                                                 names=["chunk", "bucket", "states", "n_open"])

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "chunk long, bucket long, states binary, n_open long")


def _texts(chunks: DataFrame, answers: DataFrame, buckets: int, hot: Broadcast, parts: int) -> DataFrame:
    """part, key, doc_id, chunk, entry, number, text: what has to be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, lengths, blob, found in zip(*(batch.column(c).to_pylist() for c in range(5))):
                c = Chunk(ids, lengths, blob, buckets, hot.value)
                states = c.states(found)
                entry = np.flatnonzero(states == 2)
                at = c.entry[entry]
                start, stop, key, number = c.first[at], c.last[at] + LENGTH, c.key[at], np.zeros(at.size, np.int64)
                h_entry, h_number, h_start, h, least = c.hot_windows(states)
                own = least == np.arange(least.size)
                entry, number = np.concatenate([entry, h_entry[own]]), np.concatenate([number, h_number[own]])
                start, stop = np.concatenate([start, h_start[own]]), np.concatenate([stop, h_start[own] + LENGTH])
                key = np.concatenate([key, h[own]])
                doc = c.ids[c.doc[c.entry[entry]]]
                for lo in range(0, entry.size, 20_000):
                    cut = slice(lo, lo + 20_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array((sh.mix(key[cut]) % _U(parts)).astype(np.int64)), pa.array(doc[cut]), pa.array(np.full(doc[cut].size, chunk)),
                        pa.array(entry[cut].astype(np.int32)), pa.array(number[cut].astype(np.int16)),
                        pa.array([blob[a:b] for a, b in zip(start[cut].tolist(), stop[cut].tolist())], pa.binary())],
                        names=["part", "doc_id", "chunk", "entry", "number", "text"])

    return _joined(chunks, answers.where("n_open > 0").select("chunk").distinct().join(answers, "chunk")).mapInArrow(
        run, "part long, doc_id long, chunk long, entry int, number short, text binary")


def _joined(chunks: DataFrame, answers: DataFrame, how: str = "inner") -> DataFrame:
    own = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "states")).alias("found"))
    return chunks.join(own, "chunk", how).select("chunk", "ids", "lengths", "blob", "found")


def _compare(texts: DataFrame) -> DataFrame:
    """chunk, entry, bits: the windows of each compared segment that a smaller document has too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "part"):
            data, offsets = [], [0]
            for text in group["text"].to_pylist():
                data.append(text)
                offsets.append(offsets[-1] + len(text) + 1)
            joined = np.frombuffer(b"\xff".join(data), np.uint8)
            offsets = np.array(offsets)
            count = np.diff(offsets) - LENGTH
            row = np.repeat(np.arange(count.size), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            classes = equal_windows(joined, offsets[:-1][row] + place)
            doc = group["doc_id"].to_numpy()[row]
            least = np.full(int(classes.max(initial=-1)) + 1, NO_ID)
            np.minimum.at(least, classes, doc)
            gone = doc > least[classes]
            bit = np.left_shift(np.int64(1), place + group["number"].to_numpy()[row])
            bits = np.zeros(count.size, np.int64)
            np.bitwise_or.at(bits, row[gone], bit[gone])
            some = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays([
                pa.array(group["chunk"].to_numpy()[some]), pa.array(group["entry"].to_numpy()[some]), pa.array(bits[some])],
                names=["chunk", "entry", "bits"])

    return texts.repartition("part").sortWithinPartitions("part").mapInArrow(run, "chunk long, entry int, bits long")


def _cut(chunks: DataFrame, answers: DataFrame, compared: DataFrame, buckets: int, hot: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, blob, found, entries, bits in zip(*(batch.column(c).to_pylist() for c in range(1, 7))):
                c = Chunk(ids, lengths, blob, buckets, hot.value)
                states = c.states(found)
                local = c.doc > c.doc[c.entry[c.entry_of]]  # a smaller document of the chunk has the segment
                local &= c.ids[c.doc] > c.ids[c.doc[c.entry[c.entry_of]]]
                whole = local | (states[c.entry_of] == 1)
                delta = np.zeros(c.data.size + 1, np.int32)
                np.add.at(delta, c.first[whole], 1)
                np.add.at(delta, c.last[whole] + LENGTH, -1)
                # Segments that were compared: windows by their bits, for every occurrence in the first document.
                mask = np.zeros(c.entry.size, np.int64)
                np.bitwise_or.at(mask, np.array(entries or [], np.int64), np.array(bits or [], np.int64))
                h_entry, h_number, _, _, least = c.hot_windows(states)
                if least.size:
                    doc = c.ids[c.doc[c.entry[h_entry]]]
                    gone = (doc > doc[least]) | ((mask[h_entry[least]] >> h_number[least]) & 1 == 1)
                    np.bitwise_or.at(mask, h_entry[gone], np.left_shift(np.int64(1), h_number[gone]))
                some = np.flatnonzero(~whole & (mask[c.entry_of] != 0))
                for k in range(LENGTH - GRAM + 1):
                    p = c.first[some][(mask[c.entry_of[some]] >> k) & 1 == 1] + k
                    np.add.at(delta, p, 1)
                    np.add.at(delta, p + LENGTH, -1)
                gone = np.cumsum(delta[:-1]) > 0
                edge = gone & ~np.concatenate([[False], gone[:-1]])
                edge[c.offsets[:-1][np.diff(c.offsets) > 0]] |= gone[c.offsets[:-1][np.diff(c.offsets) > 0]]
                removed = np.concatenate([[0], np.cumsum(gone)])
                spans = np.concatenate([[0], np.cumsum(edge)])
                kept = c.data[~gone]
                kept_at = c.offsets - removed[c.offsets]
                yield pa.RecordBatch.from_arrays([
                    pa.array(c.ids, mask=c.ids == NO_ID), pa.array(np.diff(c.offsets)), pa.array(np.diff(removed[c.offsets])),
                    pa.array(np.diff(spans[c.offsets])),
                    pa.array([kept[a:b].tobytes() for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist())], pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    own = compared.groupBy("chunk").agg(F.collect_list(F.struct("entry", "bits")).alias("rows")).select(
        "chunk", F.col("rows.entry").alias("entries"), F.col("rows.bits").alias("bits"))
    joined = _joined(chunks, answers, "left").join(own, "chunk", "left")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, hot_entries: int = HOT_ENTRIES, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes)."""
    workers_import(docs.sparkSession)
    total = trimmed(docs, "doc_id", "text").agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    chunks = _chunks(docs, total, sample)
    hot = docs.sparkSession.sparkContext.broadcast(_hot_anchors(chunks, sample, hot_entries))
    answers = stage(_answer(_send(chunks, buckets, hot), hot), "suffix-answers")
    open_rows = answers.agg(F.sum("n_open").alias("n")).first()["n"] or 0
    parts = max(1, -(-open_rows // PART_ROWS))
    compared = stage(_compare(_texts(chunks, answers, buckets, hot, parts)), "suffix-compared")
    return _cut(chunks, answers, compared, buckets, hot)


def report(docs: DataFrame) -> DataFrame:
    """The counts, and the digest of what remains."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
