"""Incremental, reversible removal of lines that many documents share.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case, held as a 128-bit hash.  An ``Index`` is a handle of immutable
tables in the shared folder:

* *layers* are exact reference counts: one per insertion (positive) or deletion
  (negative), a row per key with the number of its documents; their sum is a
  key's count, and ``compact`` folds them into one;
* *filters* are cuckoo filters, one per shard of the key space, of the keys that
  at least ``least`` documents have.

``insert`` and ``delete`` count a batch's keys, sum them with the layers for
those keys only, and send the keys that cross ``least`` to their shard, which
adds them to or takes them from its filter.  A shard that would fill beyond
FULL is built anew, twice as large, from the counts; when shards hold more than
KEYS_PER_SHARD keys on average, all are built anew over more shards.  Handles
are values: the handle before an insertion still describes the index before it.

``drop_lines`` tests every line against the filters.  These never miss a
frequent key, and the few keys that pass without being frequent (about
2^-29 of all keys) are found by joining the distinct passing keys with the
counts; lines go if they pass and are not among those.  Filters beyond
``filter_bytes`` in all are not shipped to tasks: lines then meet the frequent
keys in a salted join.

Defined cases: null and empty texts are one empty line; empty keys are neither
counted nor dropped; every row is a document of its own, also rows that repeat
an id; null ids are kept; documents deleted without having been inserted raise;
an empty table gives no rows and leaves the index as it is; ``drop_lines`` passes
other columns on, but for any named as its own n_lines and n_dropped.
"""

from __future__ import annotations

import dataclasses
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch.llm.common import empty_if_null, grouped, stage, trimmed, workers_import
from spendwatch.session import scratch_path

LEAST = 10
KEYS_PER_SHARD = 1 << 20
FILTER_BYTES = 64 << 20
SLOTS = 4
FULL = 0.85
ROUNDS = 500
SALTS = 16
BLANK = b" \t\n\x0b\x0c\r"
KEY = ["high", "low"]


@dataclasses.dataclass(frozen=True)
class Index:
    """Paths of the counts' layers and of the filters; ``shards`` follows from the frequent keys."""
    least: int = LEAST
    shards: int = 0
    layers: tuple[str, ...] = ()
    filters: str | None = None


# --- cuckoo filter ------------------------------------------------------------------
class Cuckoo:
    """Fingerprints of 32 bits in buckets of SLOTS; what finds no place lies in a small stash."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint32)
        self.stash: dict[tuple[int, int], int] = {}
        self.held = 0

    @staticmethod
    def capacity(keys: int) -> int:
        """Buckets, a power of two, that ``keys`` fill to at most FULL / 2."""
        return 1 << max(2, int(np.ceil(np.log2(max(keys, 1) * 2 / (FULL * SLOTS)))))

    def places(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = low.view(np.uint64)
        mark = np.maximum(low >> np.uint64(32), 1).astype(np.uint32)
        return mark, (low & np.uint64(len(self.table) - 1)).astype(np.int64)

    def other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        mixed = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
        return at ^ (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)

    def add(self, low: np.ndarray) -> None:
        """Insert each key once; a bucket's surplus goes to the other bucket, then by evictions."""
        mark, at = self.places(low)
        self.held += mark.size
        rng = np.random.default_rng(self.held)
        for turn in range(ROUNDS):
            if not mark.size:
                return
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            first = np.flatnonzero(np.diff(at, prepend=-1))
            rank = np.arange(at.size) - np.repeat(first, np.diff(np.append(first, at.size)))
            free = (self.table[at] == 0).sum(axis=1)
            fits = rank < free
            slot = np.argsort(self.table[at] != 0, axis=1, kind="stable")[np.arange(at.size), np.minimum(rank, SLOTS - 1)]
            self.table[at[fits], slot[fits]] = mark[fits]
            evicts = (rank == free) & (turn > 0)
            slot = rng.integers(0, SLOTS, int(evicts.sum()))
            out = self.table[at[evicts], slot]
            self.table[at[evicts], slot] = mark[evicts]
            rest = ~fits & ~evicts
            mark, at = np.concatenate([mark[rest], out]), np.concatenate([at[rest], at[evicts]])
            at = self.other(mark, at)
        for pair in zip(mark.tolist(), np.minimum(at, self.other(mark, at)).tolist()):
            self.stash[pair] = self.stash.get(pair, 0) + 1

    def remove(self, low: np.ndarray) -> None:
        """Take out one copy of each key's fingerprint; the keys must have been inserted."""
        marks, ats = self.places(low)
        self.held -= marks.size
        for mark, a, b in zip(marks.tolist(), ats.tolist(), self.other(marks, ats).tolist()):
            for at in (a, b):
                own = np.flatnonzero(self.table[at] == mark)
                if own.size:
                    self.table[at, own[0]] = 0
                    break
            else:
                pair = (mark, min(a, b))
                if not self.stash.get(pair):
                    raise ValueError("a key to remove is not in the filter")
                self.stash[pair] -= 1

    def has(self, low: np.ndarray) -> np.ndarray:
        mark, a = self.places(low)
        b = self.other(mark, a)
        found = ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)
        if any(self.stash.values()):
            found |= np.array([bool(self.stash.get(p)) for p in zip(mark.tolist(), np.minimum(a, b).tolist())], bool)
        return found


def shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return (high.view(np.uint64) % np.uint64(shards)).astype(np.int64)


# --- lines and keys ------------------------------------------------------------------
def keys_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of each line's hash; zeros for an empty key."""
    import xxhash
    digest = xxhash.xxh3_128_digest
    empty = bytes(16)
    raw = b"".join([digest(key) if (key := line.strip(BLANK).lower()) else empty for line in lines])
    both = np.frombuffer(raw, "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def key_counts(docs: DataFrame) -> DataFrame:
    """high, low, n: in how many rows of ``docs`` each key occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = [], []
            for text in _texts(batch):
                h, w = keys_of(text.split(b"\n"))
                own = np.unique(np.stack([h, w], axis=1), axis=0) if h.size > 1 else np.stack([h, w], axis=1)
                high.append(own[:, 0])
                low.append(own[:, 1])
            if not high:
                continue
            both = np.stack([np.concatenate(high), np.concatenate(low)], axis=1)
            both, n = np.unique(both[(both != 0).any(axis=1)], axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n)], names=[*KEY, "n"])

    plain = docs.select(empty_if_null("text").alias("text"))
    return plain.mapInArrow(run, "high long, low long, n long").groupBy(*KEY).agg(F.sum("n").alias("n"))


# --- the index ------------------------------------------------------------------------
_COUNTS = "high long, low long, n long"
_FILTERS = "shard long, keys long, room long, body binary"


def _written(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, f"llm-lines-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return path


def counts(spark: SparkSession, index: Index) -> DataFrame:
    """high, low, n: the documents of every key that has any."""
    if not index.layers:
        return spark.createDataFrame([], _COUNTS)
    layers = spark.read.schema(_COUNTS).parquet(*index.layers)
    if len(index.layers) == 1:
        return layers
    return layers.groupBy(*KEY).agg(F.sum("n").alias("n")).where("n <> 0")


def frequent(spark: SparkSession, index: Index) -> DataFrame:
    return counts(spark, index).where(F.col("n") >= index.least).select(*KEY)


def insert(index: Index, docs: DataFrame) -> Index:
    return _apply(index, docs, 1)


def delete(index: Index, docs: DataFrame) -> Index:
    """Take back the rows of ``docs``; they must have been inserted before."""
    return _apply(index, docs, -1)


def _apply(index: Index, docs: DataFrame, sign: int) -> Index:
    spark = docs.sparkSession
    workers_import(spark)
    layer = _written(key_counts(docs).withColumn("n", F.col("n") * sign), "layer")
    batch = spark.read.schema(_COUNTS).parquet(layer)
    if batch.isEmpty():
        return index
    if index.layers:
        held = spark.read.schema(_COUNTS).parquet(*index.layers).join(batch.select(*KEY), KEY, "left_semi")
        before = held.groupBy(*KEY).agg(F.sum("n").alias("before"))
        change = batch.join(before, KEY, "left").fillna(0, ["before"])
    else:
        change = batch.withColumn("before", F.lit(0).cast("long"))
    change = change.withColumn("after", F.col("before") + F.col("n"))
    if sign < 0 and not change.where("after < 0").isEmpty():
        raise ValueError("documents to delete that were not inserted")
    crossing = change.select(*KEY, (F.col("after") >= index.least).cast("int").alias("now"),
                             (F.col("before") >= index.least).cast("int").alias("then"))
    crossing = stage(crossing.where("now <> then").select(*KEY, (F.col("now") - F.col("then")).alias("step")), "lines-crossing")
    return _filtered(spark, dataclasses.replace(index, layers=(*index.layers, layer)), crossing)


def _shard(index: Index):
    # As shard_of: the unsigned remainder.
    n = index.shards
    high = F.col("high")
    return F.pmod(F.pmod(F.shiftrightunsigned(high, 1), F.lit(n)) * 2 + F.pmod(high, F.lit(2)), F.lit(n)).cast("long")


def _filtered(spark: SparkSession, index: Index, crossing: DataFrame) -> Index:
    """``index`` with its filters brought up to date by the crossings."""
    kept = spark.read.schema(_FILTERS).parquet(index.filters) if index.filters else spark.createDataFrame([], _FILTERS)
    held = (kept.agg(F.sum("keys")).first()[0] or 0) + (crossing.agg(F.sum("step")).first()[0] or 0)
    anew = not index.shards or held > index.shards * KEYS_PER_SHARD
    if anew:
        index = dataclasses.replace(index, shards=max(1, -(-2 * held // KEYS_PER_SHARD)))
        kept = kept.limit(0)
        full = spark.range(index.shards).select(F.col("id").alias("shard"))
    steps = crossing.withColumn("shard", _shard(index))
    if not anew:
        sizes = steps.groupBy("shard").agg(F.sum("step").alias("more")).join(kept.select("shard", "keys", "room"), "shard")
        full = stage(sizes.where(F.col("keys") + F.col("more") > F.col("room") * FULL).select("shard"), "lines-full")
    rows = steps.join(full, "shard", "left_anti").select("shard", "low", "step").withColumn("body", F.lit(None).cast("binary"))
    rows = rows.unionByName(kept.select("shard", F.lit(0).cast("long").alias("low"), F.lit(0).alias("step"), "body"))
    if anew or not full.isEmpty():  # "step" 2 marks the keys of a filter built from the counts, 3 that it is
        again = frequent(spark, index).withColumn("shard", _shard(index)).join(full, "shard", "left_semi").select("shard", "low", F.lit(2).alias("step"))
        again = again.unionByName(full.select("shard", F.lit(0).cast("long").alias("low"), F.lit(3).alias("step")))
        rows = rows.unionByName(again.withColumn("body", F.lit(None).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "shard"):
            shard = group["shard"][0].as_py()
            low, step = group["low"].to_numpy(), group["step"].to_numpy()
            body = next((b for b in group["body"].to_pylist() if b is not None), None)
            if (step == 3).any():
                cuckoo = Cuckoo(Cuckoo.capacity(int((step == 2).sum())))
                cuckoo.add(low[step == 2])
            else:
                cuckoo = pickle.loads(body)
                cuckoo.remove(low[step == -1])
                cuckoo.add(low[step == 1])
            columns = [[shard], [cuckoo.held], [cuckoo.table.size], [pickle.dumps(cuckoo)]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "keys", "room", "body"])

    built = rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, _FILTERS)
    return dataclasses.replace(index, filters=_written(built, "filters"))


def compact(spark: SparkSession, index: Index) -> Index:
    """The same index with one layer."""
    if len(index.layers) < 2:
        return index
    return dataclasses.replace(index, layers=(_written(counts(spark, index), "layer"),))


# --- dropping lines ---------------------------------------------------------------------
_loaded: dict[str, dict[int, Cuckoo]] = {}


class Screen:
    """All filters, sent to tasks and unpacked once per worker."""

    def __init__(self, spark: SparkSession, index: Index, bodies: DataFrame):
        self.name, self.shards = uuid.uuid4().hex, index.shards
        self.bodies = spark.sparkContext.broadcast({r["shard"]: bytes(r["body"]) for r in bodies.collect()})

    def passes(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        if self.name not in _loaded:
            _loaded.clear()
            _loaded[self.name] = {shard: pickle.loads(body) for shard, body in self.bodies.value.items()}
        shard, out = shard_of(high, self.shards), np.zeros(high.size, bool)
        for s, cuckoo in _loaded[self.name].items():
            own = np.flatnonzero(shard == s)
            out[own] = cuckoo.has(low[own])
        return out & ((high != 0) | (low != 0))


def screen(spark: SparkSession, index: Index, filter_bytes: int) -> Screen | None:
    """The filters for tasks, unless they are larger than ``filter_bytes`` in all."""
    table = spark.read.schema(_FILTERS).parquet(index.filters)
    size = table.agg(F.sum(F.length("body"))).first()[0] or 0
    return None if size > filter_bytes else Screen(spark, index, table.select("shard", "body"))


def _without(lines: list[bytes], gone: list[bool]) -> tuple[int, int, bytes]:
    kept = [line for line, drop in zip(lines, gone) if not drop]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _out(batch: pa.RecordBatch, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    own = zip(*rows) if rows else ((),) * 3
    arrays = [pa.array(c, k) for c, k in zip(own, (pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["rest", "n_lines", "n_dropped", "text"])


def drop_lines(docs: DataFrame, index: Index, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``docs`` with text freed of frequent lines, and n_lines (before), n_dropped."""
    spark = docs.sparkSession
    workers_import(spark)
    others = [n for n in docs.columns if n not in ("text", "n_lines", "n_dropped")]
    packed = docs.select(F.struct(*others).alias("rest"), empty_if_null("text").alias("text"))
    schema = T.StructType([packed.schema["rest"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                           T.StructField("text", T.BinaryType())])
    filters = screen(spark, index, filter_bytes) if index.filters else None
    refuted = None
    if filters is not None:
        # Keys that pass without being frequent: a few in a billion.
        bound = FILTER_BYTES // 64
        wrong = _passing(packed, filters).join(frequent(spark, index), KEY, "left_anti").limit(bound + 1).collect()
        if len(wrong) <= bound:
            refuted = {(r["high"], r["low"]) for r in wrong}
    if index.filters and refuted is None:
        out = _dropped_by_join(packed, index, schema)
    else:
        out = _dropped_by_filter(packed, filters, refuted, schema)
    return out.select("rest.*", "n_lines", "n_dropped", F.col("text").cast("string").alias("text"))


def _passing(packed: DataFrame, filters: Screen) -> DataFrame:
    """The distinct keys that pass the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = keys_of([line for text in _texts(batch) for line in text.split(b"\n")])
            at = filters.passes(high, low)
            own = np.unique(np.stack([high[at], low[at]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 0]), pa.array(own[:, 1])], names=KEY)

    return packed.select("text").mapInArrow(run, "high long, low long").distinct()


def _dropped_by_filter(packed: DataFrame, filters: Screen | None, refuted: set | None, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [text.split(b"\n") for text in _texts(batch)]
            high, low = keys_of([line for lines in split for line in lines])
            gone = filters.passes(high, low) if filters is not None else np.zeros(high.size, bool)
            if refuted:
                gone &= np.array([pair not in refuted for pair in zip(high.tolist(), low.tolist())], bool)
            gone, bounds = gone.tolist(), np.cumsum([0, *map(len, split)]).tolist()
            yield _out(batch, [_without(lines, gone[i:j]) for lines, i, j in zip(split, bounds, bounds[1:])])

    return packed.mapInArrow(run, schema)


def _dropped_by_join(packed: DataFrame, index: Index, schema: T.StructType) -> DataFrame:
    """Every text asks for its distinct keys in a join with the frequent ones,
    salted by text; whether a line goes depends on its key alone, so equal texts
    share an answer."""
    spark = packed.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0), _texts(batch)):
                both = np.unique(np.stack(keys_of(text.split(b"\n")), axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.repeat(name, len(both)), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["name", *KEY])

    packed = packed.withColumn("name", F.sha2("text", 256))
    salt = F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int")
    asked = packed.select("name", "text").mapInArrow(keys, "name string, high long, low long").withColumn("salt", salt)
    known = frequent(spark, index).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = (asked.join(known, [*KEY, "salt"], "left_semi").groupBy("name").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
            .select("name", F.col("gone.high").alias("gone_high"), F.col("gone.low").alias("gone_low")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, high, low in zip(_texts(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines, own = text.split(b"\n"), set(zip(high or (), low or ()))
                rows.append(_without(lines, [k in own for k in zip(*(x.tolist() for x in keys_of(lines)))]))
            yield _out(batch, rows)

    return packed.join(gone, "name", "left").select("rest", "text", "gone_high", "gone_low").mapInArrow(run, schema)


def report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of ``docs`` freed of the lines that an index of them finds frequent."""
    docs = trimmed(docs, "doc_id", "text")
    index = insert(Index(least), docs)
    return drop_lines(docs, index).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
