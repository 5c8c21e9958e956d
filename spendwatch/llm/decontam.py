"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is reduced to its shingles that occur in any test item (found with a
two-probe bitmap of fixed size, so nothing that grows with the benchmark is
broadcast).  The containment of an item is the same in this projection as in
the whole document.  Projections are partitioned by size (powers of two); the
upper size of a partition turns the containment threshold into a Jaccard
threshold for each item, and that chooses how many signature values form a
band.  Where the projection is so much larger
than the item that not even single values reach the wanted miss probability (a
short item inside a document with much other test material), the item's own
minimum shingles are looked up among the document's shingles instead: each is
present with a probability of at least the containment.  Only documents of
those sizes are looked up so, and no key is made for a size that cannot hold
the item; a shingle that very many items and documents share therefore does
not by itself make candidates of all their pairs.  Candidates are verified by exact containment.

Defined cases: null, empty and wordless texts contain and match nothing; a text
of fewer words than a shingle is one shingle of its own, so an item of one to four
words is found only in a document that is nothing but the item; of repeated rows of
one (doc_id, item_id) the highest containment is returned once; rows with a
null doc_id or item_id are not reported.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm import shingles as sh
from spendwatch.llm.common import stage, trimmed

THRESHOLD_PERCENT = 80
SIGNATURE = 64
BAND_ROWS = (4, 2, 1)
MISS = 1e-6
BITMAP_BITS = 1 << 24
MAX_CLASS = 31


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(40)) % np.uint64(BITMAP_BITS), (h >> np.uint64(8)) % np.uint64(BITMAP_BITS)


def band_rows(item_size: int, largest: int, percent: int, miss: float) -> int:
    """Values in a band for projections of at most ``largest`` shingles; 0: look minima up directly."""
    shared = math.ceil(item_size * percent / 100)
    similarity = shared / (max(largest, shared) + item_size - shared)
    for rows in BAND_ROWS:
        if (1 - similarity ** rows) ** (SIGNATURE // rows) <= miss:
            return rows
    return 0


def _band_key(size_class: int, rows: int, values: np.ndarray) -> np.ndarray:
    cut = values[: SIGNATURE // rows * rows].reshape(-1, rows).astype(np.uint64)
    key = np.arange(cut.shape[0], dtype=np.uint64) + np.uint64(1000 * rows + 100_000 * size_class)
    for r in range(rows):
        key = sh.mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, r])
    return key.astype(np.int64)


def describe_items(items: DataFrame, percent: int, miss: float) -> DataFrame:
    """item_id, its shingles, and the keys under which documents are to be found, of a least size class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xor, mul = sh.signature_seeds(SIGNATURE)
        for batch in batches:
            data, offsets = sh.text_bytes(batch.column(1))
            parts = sh.sets(data, offsets)
            sig = sh.signatures(parts, SIGNATURE)
            keys = []
            for p, s in zip(parts, sig):
                own: list[dict] = []
                if p.size:
                    least = max(1, math.ceil(p.size * percent / 100)).bit_length() - 1
                    rows = {c: band_rows(p.size, (2 << c) - 1, percent, miss) for c in range(least, MAX_CLASS)}
                    for c in rows:
                        own += [{"key": k, "least": c} for k in (_band_key(c, rows[c], s).tolist() if rows[c] else [])]
                    # A larger class never has longer bands, so the classes without any are the last ones.
                    beyond = min((c for c in rows if not rows[c]), default=MAX_CLASS)
                    minima = np.unique([p[np.argmin((p ^ x) * m >> np.uint64(32))] for x, m in zip(xor, mul)])
                    own += [{"key": k, "least": beyond} for k in minima.astype(np.uint64).view(np.int64).tolist()]
                keys.append(own)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([p.view(np.int64).tolist() for p in parts], pa.list_(pa.int64())),
                pa.array(keys, pa.list_(pa.struct([("key", pa.int64()), ("least", pa.int32())])))],
                names=["item_id", "item_shingles", "keys"])

    return trimmed(items, "item_id", "text").mapInArrow(
        run, "item_id long, item_shingles array<long>, keys array<struct<key:long,least:int>>")


def bitmap_of(items: DataFrame) -> np.ndarray:
    """The bitmap of all item shingles: BITMAP_BITS bits whatever the benchmark's size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            places = np.unique(np.concatenate(_probes(values))) if values.size else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((places >> np.uint64(5)).astype(np.int64)),
                                              pa.array(np.left_shift(1, (places & np.uint64(31)).astype(np.int64)))],
                                             names=["word", "bits"])

    words = items.select("item_shingles").mapInArrow(run, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(BITMAP_BITS // 32, dtype=np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def project(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """doc_id, its shingles that are in the bitmap, their size class, and its keys; only documents that have such shingles."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for batch in batches:
            data, offsets = sh.text_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            rows: list[tuple[int, list[int], int, list[int]]] = []
            for i, j in sh.sub_batches(offsets):
                h, first = sh.shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                found = np.ones(h.size, dtype=bool)
                for place in _probes(h):
                    found &= (words[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & 1 == 1
                at = np.flatnonzero(found)
                owner = np.searchsorted(first, at, side="right") - 1
                for d in np.unique(owner):
                    hits = np.unique(h[at[owner == d]])
                    s = sh.signatures([hits], SIGNATURE)[0]
                    size_class = int(hits.size).bit_length() - 1
                    keys = np.concatenate([_band_key(size_class, r, s) for r in BAND_ROWS] + [hits.view(np.int64)])
                    rows.append((ids[i + d], hits.view(np.int64).tolist(), size_class, keys.tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                names=["doc_id", "hits", "size_class", "keys"])

    return trimmed(docs, "doc_id", "text").mapInArrow(run, "doc_id long, hits array<long>, size_class int, keys array<long>")


def candidates(found: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id of projections and items with a key in common that is made for the projection's size."""
    doc_keys = found.select("doc_id", "size_class", F.explode("keys").alias("key"))
    item_keys = items.select("item_id", F.explode("keys").alias("k")).select("item_id", "k.key", "k.least")
    return doc_keys.join(item_keys, "key").where("size_class >= least").select("doc_id", "item_id").distinct()


def contained_items(docs: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT, miss: float = MISS) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment of each item that a document contains."""
    items = stage(describe_items(items, percent, miss), "decontam-items")
    found = stage(project(docs, bitmap_of(items)), "decontam-docs")
    shared = F.size(F.array_intersect("hits", "item_shingles")).cast("long")
    return (candidates(found, items).join(found.select("doc_id", "hits"), "doc_id")
            .join(items.select("item_id", "item_shingles"), "item_id")
            .select("doc_id", "item_id", F.size("item_shingles").cast("long").alias("n_item_shingles"), shared.alias("n_shared"))
            .where(F.col("n_shared") * 100 >= F.col("n_item_shingles") * percent)
            .groupBy("doc_id", "item_id").agg(F.max("n_item_shingles").alias("n_item_shingles"), F.max("n_shared").alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item_shingles")))
