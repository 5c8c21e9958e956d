"""Ranked lexical search of whole documents by one automaton of the queries' terms.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in
lower case.  A text is searched as bytes in which everything else is a space, and
the automaton holds every term of the items between two spaces, so it reports
whole terms only, and neighbours share their space.  Documents are scanned as
they lie; no index of them is kept.

Items are dealt into blocks of about BLOCK_BYTES of text, the bound of what is
broadcast; each block costs two scans, one for the terms' document frequencies
and one that scores.  The second takes each document's term frequencies through
the terms' lists of items, and a task keeps its ``k`` best documents of each item.
These meet first by item and salt, then by item.

All numbers but a term's weight, floor(1000 ln((2N + 2) / (2 df + 1))), are
64-bit integers with divisions rounded down: a document of n terms has the length
m = 10 + 90 n N / L, and a term adds weight * (10^9 tf / (1000 tf + 8 m)).

Defined cases: null and empty texts have no terms and are not counted in N; an
item without terms, or whose terms no document holds, has no rows; equal scores
go by doc_id, null ids last; repeated documents each take a rank; repeated items
are searched once, items that share an id but not a text each have ranks of their
own; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch.llm.common import empty_if_null, trimmed, workers_import

TOP = 10
BLOCK_BYTES = 4 << 20
PIECE = 1 << 20
CELLS = 1 << 21
SALTS = 32
_TERM = [c for c in range(256) if c >= 0x80 or chr(c).isalnum()]
_GUARD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _TERM else 0x20 for c in range(256))


def guarded(text: bytes) -> bytes:
    """The text with a space at its ends and for every character outside terms, A-Z in lower case."""
    return b" " + text.translate(_GUARD) + b" "


def count_terms(guard: bytes) -> int:
    inside = np.frombuffer(guard, np.uint8) != 0x20
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


class Items:
    """The items of one block: their distinct terms and, for each term, its items."""

    def __init__(self, texts: list[str]):
        own = [sorted(set(guarded(t.encode()).split())) for t in texts]
        self.terms = sorted({t for terms in own for t in terms})
        place = {t: k for k, t in enumerate(self.terms)}
        term = np.array([place[t] for terms in own for t in terms], np.int64)
        item = np.repeat(np.arange(len(own)), [len(terms) for terms in own])
        order = np.argsort(term, kind="stable")
        self.items = item[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.size = len(texts)
        self.name = uuid.uuid4().hex


_automata: dict[str, object] = {}


def automaton(items: Items):
    """The block's automaton, built once per worker."""
    if items.name not in _automata:
        import ahocorasick
        built = ahocorasick.Automaton()
        for k, term in enumerate(items.terms):
            built.add_word(f" {term.decode('latin-1')} ", k)
        built.make_automaton()
        _automata.clear()
        _automata[items.name] = built
    return _automata[items.name]


def frequencies(built, guard: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The block's terms in a guarded text, and how often."""
    found, at = [], 0
    while at < len(guard) - 1:
        end = guard.find(b" ", at + PIECE)
        end = len(guard) - 1 if end < 0 else end
        found += [k for _, k in built.iter(guard[at:end + 1].decode("latin-1"))]
        at = end
    return np.unique(np.array(found, np.int64), return_counts=True)


def _corpus(docs: DataFrame, items) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms in all, and each term's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, df = automaton(items.value), np.zeros(len(items.value.terms) + 2, np.int64)
        for batch in batches:
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                guard = guarded(text)
                n = count_terms(guard)
                df[-2:] += (n > 0, n)
                df[frequencies(built, guard)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "n"])

    sums = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(items.value.terms) + 2, np.int64)
    for r in sums:
        df[r["term"]] = r["n"]
    return int(df[-2]), int(df[-1]), df[:-2]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def scores(items: Items, weight: np.ndarray, doc: np.ndarray, length: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int) -> np.ndarray:
    """Of ``n`` documents of the given lengths m, a row of scores by item; ``doc``, ``term`` and ``tf`` are parallel."""
    each = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
    many = items.first[term + 1] - items.first[term]
    place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(items.first[term], many)
    out = np.zeros(n * items.size, np.int64)
    np.add.at(out, np.repeat(doc, many) * items.size + items.items[place], np.repeat(each, many))
    return out.reshape(n, items.size)


class _Best:
    """The ``k`` best (score, then doc_id, nulls last) documents of each item so far."""

    def __init__(self, size: int, k: int):
        self.k, self.floor = k, np.ones(size, np.int64)
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def take(self, found: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(found >= self.floor)
        if not row.size:
            return
        item, score = np.append(self.item, item), np.append(self.score, found[row, item])
        doc, null = np.append(self.doc, doc[row]), np.append(self.null, null[row])
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        rank = np.arange(item.size) - np.searchsorted(item, item)
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[item[last]] = score[last]
        self.item, self.score, self.doc, self.null = item[keep], score[keep], doc[keep], null[keep]


def _scored(docs: DataFrame, items, weight, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """at (the item's place in its block), doc_id, score: the best of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, built = items.value, automaton(items.value)
        best = _Best(own.size, k)
        most = max(1, CELLS // own.size)

        def settle(ids, length, parts) -> None:
            if parts:
                doc = np.repeat(np.arange(len(ids)), [len(t) for t, _ in parts])
                term, tf = (np.concatenate([p[j] for p in parts]) for j in (0, 1))
                found = scores(own, weight.value, doc, np.array(length, np.int64), term, tf, len(ids))
                best.take(found, np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool))

        for batch in batches:
            ids, length, parts, held = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                guard = guarded(text)
                term, tf = frequencies(built, guard)
                if not term.size:
                    continue
                ids.append(doc_id)
                length.append(10 + 90 * count_terms(guard) * n_docs // n_terms)
                parts.append((term, tf))
                held += int((own.first[term + 1] - own.first[term]).sum())
                if len(ids) >= most or held >= CELLS:
                    settle(ids, length, parts)
                    ids, length, parts, held = [], [], [], 0
            settle(ids, length, parts)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score)],
                                         names=["at", "doc_id", "score"])

    return docs.mapInArrow(run, "at long, doc_id long, score long")


def _top(found: DataFrame, keys: list, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    workers_import(spark)
    docs = trimmed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), empty_if_null("text").alias("text"))
    wanted = trimmed(benchmark, "item_id", "text").select("item_id", empty_if_null("text").alias("text")).distinct()
    kind = wanted.schema["item_id"].dataType
    blocks = max(1, -(-(wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        own = Items([r["text"] for r in rows])
        if not own.terms:
            continue
        items = spark.sparkContext.broadcast(own)
        n_docs, n_terms, df = _corpus(docs, items)
        if not n_docs:
            continue
        found = _scored(docs, items, spark.sparkContext.broadcast(weights(n_docs, df)), n_docs, n_terms, k)
        found = _top(found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), ["at", "salt"], k).drop("rank", "salt")
        ids = spark.createDataFrame([(at, r["item_id"]) for at, r in enumerate(rows)],
                                    T.StructType([T.StructField("at", T.LongType()), T.StructField("item_id", kind)]))
        out = out.unionByName(_top(found, ["at"], k).join(F.broadcast(ids), "at").select("item_id", "rank", "doc_id", "score"))
    return out
