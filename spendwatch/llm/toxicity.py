"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The index holds the whole vectors of a bounded sample of labelled documents (at
most ``MAX_EXAMPLES``, by hash of the id whatever the label, so their shares stay):
all their words, none left out.  Document frequencies are counted over all
documents.  A word that leans toxic weighs 1 + G times its TF-IDF, G being the
log-likelihood ratio of its presence over the sample's labels; there is no cutoff.
(Plain TF-IDF cosines find neighbours of like topic; held-out accuracy is 0.95 with
them, 0.98 with the weights.)  Examples with equal
vectors are one index entry with its votes.  Words that fewer than one in
``COMMON`` entries have are postings, the others dense columns; a query's cosines
with all entries are summed in full, so the neighbours are exact.

The score: votes weighted by cosine, smoothed by the share of toxic documents,
then calibrated by a monotone map fitted on the sample's own left-out votes.
A document without any of the examples' words gets the share seen among such
examples.  The nearest examples' ids and cosines are the evidence.

Only texts decide a score; labels enter through the sample alone.  Defined
cases: null and empty texts have no words; words that no example has carry no
weight; without labels of both kinds every score is the share of toxic examples,
0 without any; ties among neighbours go by entry number; repeated rows score alike.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import empty_if_null, stage, trimmed

FOLDS = 5
MAX_EXAMPLES = 5_000
EVIDENCE = 3
NEIGHBOURS = 32
QUERIES = 32
COMMON = 16  # one entry in so many makes a word common
PRIOR_VOTES = 1.0
_WORD = re.compile(r"[^\W\d_]+")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class BlockIndex:
    """The examples' unit vectors by word: postings, and dense columns for words of many entries."""

    def __init__(self, vectors: np.ndarray, toxic: np.ndarray, clean: np.ndarray):
        rows, terms = np.nonzero(vectors)
        self._fill(rows, terms, vectors[rows, terms], vectors.shape[1], toxic, clean)

    @classmethod
    def of_postings(cls, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, toxic: np.ndarray, clean: np.ndarray) -> BlockIndex:
        """From (entry, word, weight) triples in the order of entries."""
        index = cls.__new__(cls)
        index._fill(rows, terms, weights, n_terms, toxic, clean)
        return index

    def _fill(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, toxic: np.ndarray, clean: np.ndarray) -> None:
        self.toxic, self.clean = np.asarray(toxic, float), np.asarray(clean, float)
        n = len(self.toxic)
        seen = np.bincount(terms, minlength=n_terms)
        common = seen * COMMON >= n
        # Words of many entries: their weights side by side.
        self.column = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        self.common = np.zeros((n, int(common.sum())), np.float32)
        dense = common[terms]
        self.common[rows[dense], self.column[terms[dense]]] = weights[dense]
        # The others: postings in the order of words and entries.
        rows, terms, weights = rows[~dense], terms[~dense], weights[~dense]
        order = np.argsort(terms, kind="stable")
        self.entries, self.weights = rows[order].astype(np.int32), weights[order].astype(np.float32)
        self.starts = np.zeros(n_terms + 1, np.int64)
        np.cumsum(np.where(common, 0, seen), out=self.starts[1:])

    @property
    def vectors(self) -> np.ndarray:
        """The dense vectors, for small indexes."""
        out = np.zeros((len(self.toxic), len(self.column)), np.float32)
        out[:, self.column >= 0] = self.common
        out[self.entries, np.repeat(np.arange(out.shape[1]), np.diff(self.starts))] = self.weights
        return out

    def nearest_each(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query, entries and cosines of the k nearest with a positive cosine; QUERIES of them share a product."""
        n = len(self.toxic)
        for lo in range(0, len(queries), QUERIES):
            group = queries[lo:lo + QUERIES]
            dense = np.zeros((len(group), self.common.shape[1]), np.float32)
            columns = [self.column[t] for t, _ in group]
            for row, c, (_, w) in zip(dense, columns, group):
                row[c[c >= 0]] = w[c >= 0]
            for cosines, c, (t, w) in zip(dense @ self.common.T, columns, group):
                rare = c < 0
                starts, ends = self.starts[t[rare]], self.starts[t[rare] + 1]
                cut = [slice(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b > a]
                if cut:
                    own = np.concatenate([self.weights[x] for x in cut]) * np.repeat(w[rare], ends - starts)
                    cosines = cosines + np.bincount(np.concatenate([self.entries[x] for x in cut]), own, minlength=n)
                least = max(np.partition(cosines, -k)[-k], 0.0) if n > k else 0.0
                at = np.flatnonzero((cosines >= least) & (cosines > 0))
                at = at[np.lexsort((at, -cosines[at]))[:k]]
                yield at, cosines[at].astype(np.float32)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        return next(self.nearest_each([(np.asarray(terms), np.asarray(weights, np.float32))], k))


class Model:
    """The sample's words, their weights, the index and the calibration; bounded by the sample."""

    def __init__(self, terms: pa.Array, weights: np.ndarray, share: float):
        self.terms, self.term_weights, self.share = terms, weights.astype(np.float32), share
        self.empty, self.x, self.y = share, np.zeros(0), np.zeros(0)
        self.ids = np.zeros(0, np.int64)  # the least doc_id of each entry's examples
        self._place: dict[str, int] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_place": None}

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The text's words by number, and its unit vector."""
        if self._place is None:
            self._place = {w: i for i, w in enumerate(self.terms.to_pylist())}
        place = self._place.get
        seen = sorted((i, n) for w, n in Counter(words(text)).items() if (i := place(w)) is not None)
        t = np.array([i for i, _ in seen], np.int32)
        w = (1 + np.log(np.array([n for _, n in seen], np.float32))) * self.term_weights[t]
        return t, (w / max(float(np.sqrt((w * w).sum())), 1e-9)).astype(np.float32)

    def vote(self, found: np.ndarray, cosines: np.ndarray, own: int = -1, label: int = 0) -> float:
        """The neighbours' weighted vote; an example of entry ``own`` leaves its own vote out."""
        near = cosines.astype(float) ** 4
        toxic, clean = self.index.toxic[found], self.index.clean[found]
        (toxic if label else clean)[found == own] -= 1
        for_it, against = float((near * toxic).sum()), float((near * clean).sum())
        return (for_it + PRIOR_VOTES * self.share) / (for_it + against + PRIOR_VOTES)

    def calibrate(self, points: list[tuple[float, int]]) -> None:
        """Pooled adjacent violators over the examples' (left-out vote, label)."""
        pools: list[list[float]] = []
        for x, y in sorted(points):
            pools.append([x, x, y, 1])
            while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
                last = pools.pop()
                pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
        self.x = np.array([p[k] for p in pools for k in (0, 1)])
        self.y = np.array([v for p in pools for v in [(p[2] + self.share) / (p[3] + 1)] * 2])

    def scores(self, texts: list[str]) -> list[tuple[float, list[float], list[int]]]:
        """Each text's calibrated score, its neighbours' cosines and the nearest ones' ids."""
        own = [self.vector(t) for t in texts]
        near = self.index.nearest_each([v for v in own if v[0].size], NEIGHBOURS) if any(v[0].size for v in own) else iter(())
        out = []
        for t, _ in own:
            if not t.size:
                out.append((self.empty, [], []))
                continue
            found, cosines = next(near)
            raw = self.vote(found, cosines)
            score = float(np.interp(raw, self.x, self.y)) if self.x.size else raw
            out.append((score, cosines.tolist(), self.ids[found[:EVIDENCE]].tolist()))
        return out


def sample(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """doc_id, toxic, text of the bounded sample: the ``most`` labelled ids with the least hash, held-out fold left out."""
    marks = trimmed(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")).where(fold(F.col("doc_id")) != 0)
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return trimmed(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max(empty_if_null("text")).alias("text"))


def word_counts(examples: DataFrame) -> pa.Table:
    """w, c, t: the examples' words in order, and in how many clean and toxic ones each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in set(words(text)):
                    counts.setdefault(w, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                                              pa.array([c[1] for c in counts.values()], pa.int64())], names=["w", "c", "t"])

    counted = examples.select("toxic", "text").mapInArrow(run, "w string, c long, t long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    return counted.toArrow().sort_by("w")


def leaning(c: np.ndarray, t: np.ndarray, nc: int, nt: int) -> np.ndarray:
    """1 + G of the words that toxic examples have more often than clean ones, 1 of the others."""
    n, seen = nc + nt, c + t

    def cell(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1) / np.maximum(expected, 1e-300)), 0.0)

    g = 2 * (cell(t, seen * nt / n) + cell(c, seen * nc / n) + cell(nt - t, (n - seen) * nt / n) + cell(nc - c, (n - seen) * nc / n))
    return np.where(t * nc > c * nt, 1 + np.maximum(g, 0), 1.0)


def document_frequencies(docs: DataFrame, terms: pa.Array) -> tuple[np.ndarray, int]:
    """In how many of all documents each word occurs, and how many documents there are."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(sent.value.to_pylist())}
        counts, n = np.zeros(len(place) + 1, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                counts[[place[w] for w in set(words(text)) if w in place]] += 1
        counts[-1] = n
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["i", "n"])

    rows = docs.select(empty_if_null("text").alias("text")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    out = np.zeros(len(terms) + 1, np.int64)
    out[rows["i"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def example_vectors(examples: DataFrame, model: Model) -> DataFrame:
    """doc_id, toxic, key, terms, weights of the examples; examples with equal vectors have one key."""
    sent = examples.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sent.value.vector(t) for t in batch.column(2).to_pylist()]
            keys = [hashlib.sha256(t.tobytes() + w.tobytes()).digest() for t, w in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
                                              pa.array([t.tobytes() for t, _ in own], pa.binary()), pa.array([w.tobytes() for _, w in own], pa.binary())],
                                             names=["doc_id", "toxic", "key", "terms", "weights"])

    plain = examples.select(F.col("doc_id").cast("long"), "toxic", "text")
    return stage(plain.mapInArrow(run, "doc_id long, toxic int, key binary, terms binary, weights binary"), "toxicity-vectors")


def left_out(vectors: DataFrame, model: Model, entries: dict[bytes, int]) -> list[tuple[float, int]]:
    """Each example's vote without itself, and its label."""
    sent = vectors.sparkSession.sparkContext.broadcast((model.index, model.share, entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, share, place = sent.value
        own = Model(pa.array([], pa.string()), np.zeros(0), share)
        own.index = index
        for batch in batches:
            toxic, keys, t, w = (c.to_pylist() for c in batch.columns)
            near = index.nearest_each([(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b in zip(t, w)], NEIGHBOURS)
            votes = [own.vote(*found, place[key], label) for found, key, label in zip(near, keys, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(0)], names=["vote", "toxic"])

    rows = (vectors.where(F.length("terms") > 0).select("toxic", "key", "terms", "weights").repartition(64)
            .mapInArrow(run, "vote double, toxic int").toArrow())
    sent.destroy()
    return list(zip(rows["vote"].to_pylist(), rows["toxic"].to_pylist()))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> Model:
    examples = stage(sample(docs, labels, most), "toxicity-sample")
    totals = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    nc, nt = totals.get(0, 0), totals.get(1, 0)
    if not nc or not nt:
        return Model(pa.array([], pa.string()), np.zeros(0), float(nt > 0))
    counted = word_counts(examples)
    terms = counted["w"].combine_chunks()
    seen, n = document_frequencies(docs, terms)
    idf = np.log((1 + n) / (1 + seen)) + 1
    model = Model(terms, idf * leaning(counted["c"].to_numpy(), counted["t"].to_numpy(), nc, nt), nt / (nc + nt))
    vectors = example_vectors(examples, model)
    rows = vectors.groupBy("key").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"), F.first("terms").alias("terms"),
                                      F.first("weights").alias("weights"), F.min("doc_id").alias("id")).toArrow().sort_by("key")
    toxic, number = rows["t"].to_numpy(), rows["n"].to_numpy()
    parts = [np.frombuffer(x, np.int32) for x in rows["terms"].to_pylist()]
    sizes = np.array([len(x) for x in parts])
    none = sizes == 0
    model.empty = float((toxic[none].sum() + model.share) / (number[none].sum() + 1))
    use = np.flatnonzero(~none)
    values = rows["weights"].to_pylist()
    keys = rows["key"].to_pylist()
    entries = {keys[i]: at for at, i in enumerate(use.tolist())}
    flat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int32)
    model.index = BlockIndex.of_postings(
        np.repeat(np.arange(len(use), dtype=np.int32), sizes[use]), flat([parts[i] for i in use]),
        flat([np.frombuffer(values[i], np.float32) for i in use]), len(terms), toxic[use], number[use] - toxic[use])
    model.ids = rows["id"].to_numpy()[use]
    del rows, parts, values
    model.calibrate(left_out(vectors, model, entries))
    return model


def score(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """doc_id, held_out, score, predicted, n_neighbours, top_cosine, evidence_ids and evidence_cosines of the nearest examples."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = model.scores(batch.column(2).to_pylist())
            scores = [min(1.0, max(0.0, s)) for s, _, _ in out]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array([len(e) for _, e, _ in out], pa.int32()), pa.array([e[0] if e else 0.0 for _, e, _ in out], pa.float64()),
                pa.array([i for _, _, i in out], pa.list_(pa.int64())), pa.array([e[:EVIDENCE] for _, e, _ in out], pa.list_(pa.float64()))],
                names=["doc_id", "held_out", "score", "predicted", "n_neighbours", "top_cosine", "evidence_ids", "evidence_cosines"])

    rows = trimmed(docs, "doc_id", "text").select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), empty_if_null("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_neighbours int, top_cosine double, "
                           "evidence_ids array<bigint>, evidence_cosines array<double>")
