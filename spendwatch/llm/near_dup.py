"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets collapse into one representative (the least
id).  Representatives that share a band of the signature are candidates; the
candidate graph's components (clusters) bound which documents can be linked at
all.  Inside a cluster, banded pairs are compared one batch of signature values
after the other: a pair is dropped as soon as the posterior probability of a
similarity at or above the threshold falls below ``miss`` (uniform prior, so
the posterior tail is a binomial tail).  Survivors are verified on full sets,
and a spanning set of the verified links goes into the final components.

A large cluster is cut into blocks of a bounded number of documents and
shingles; every pair of blocks is its own task group, so no cluster has to fit
into one task.  Each document's text is shipped once per block pair.  Where that
would ship a text more than ``PASSES`` times, the cluster is contracted first:
its documents are compared inside the buckets of ``PASSES`` bands (a large
bucket dealt over blocks, anew in every band), which links the copies of a hot
group at a cost in proportion to its size.  Two documents of one component need
no further comparison, so only buckets that hold several components stay
candidates, and the blocks of a cluster's largest component are paired with the
other documents only.

Defined cases: a null or wordless text has an empty set, is linked with nothing
and is kept; repeated rows of one document fall into one component; a null
doc_id keeps a null component and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm import shingles as sh
from spendwatch.llm.common import grouped, stage, trimmed
from spendwatch.llm.graph import components

THRESHOLD_PERCENT = 85
BANDS, ROWS = 24, 5
BATCH = 24
MISS = 1e-6
BLOCK_DOCS, BLOCK_SHINGLES = 768, 1_000_000
PART_DOCS = 256
PASSES = 4


def _binomial_tail(m: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= m)."""
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
                              + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(m + 1))


def least_matches(threshold: float, size: int, batch: int, miss: float) -> list[tuple[int, int]]:
    """After each batch of signature values: how many must agree so far.

    With a uniform prior and m of n values equal, the similarity has a
    Beta(m + 1, n - m + 1) posterior, and P(similarity >= t) equals
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(batch, size + 1, batch):
        m = 0
        while m < n and _binomial_tail(m, n + 1, threshold) < miss:
            m += 1
        out.append((n, m))
    return out


def describe(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set, band keys (empty set: none)."""
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for batch in batches:
            data, offsets = sh.text_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in sh.sub_batches(offsets):
                parts = sh.sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                keys = band_keys(sh.signatures(parts, size), bands, rows)
                digests = [hashlib.blake2b(p.tobytes(), digest_size=16).digest() if p.size
                           else b"empty:%d" % (ids[i + k] or 0) for k, p in enumerate(parts)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).cast(pa.int64()),
                    pa.array([p.size for p in parts], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([k.tolist() if p.size else [] for p, k in zip(parts, keys)], pa.list_(pa.int64())),
                ], names=["doc_id", "n_shingles", "digest", "keys"])

    return trimmed(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """documents x bands: a 64-bit key of each band's values and its number."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (sig.shape[0], bands))
    cut = sig.reshape(sig.shape[0], bands, rows).astype(np.uint64)
    for r in range(rows):
        key = sh.mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, r])
    return key.astype(np.int64)


def _pairs(sig_a, key_a, label_a, sig_b, key_b, label_b, same: bool,
           table: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Banded pairs of different labels that no batch of signature values has ruled out."""
    banded = np.zeros((len(sig_a), len(sig_b)), dtype=bool)
    for b in range(key_a.shape[1]):
        banded |= key_a[:, b][:, None] == key_b[:, b][None, :]
    banded &= label_a[:, None] != label_b[None, :]
    if same:
        banded = np.triu(banded, 1)
    i, j = np.nonzero(banded)
    agree, done = np.zeros(i.size, dtype=np.int32), 0
    for n, need in table:
        for lo in range(0, i.size, 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            agree[cut] += (sig_a[i[cut], done:n] == sig_b[j[cut], done:n]).sum(axis=1)
        keep = agree >= need
        i, j, agree, done = i[keep], j[keep], agree[keep], n
    return i, j


def _links(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs reach the threshold on full sets."""
    if i.size <= 2 * (len(a) + len(b)):
        inter = np.array([np.intersect1d(a[x], b[y], assume_unique=True).size for x, y in zip(i, j)], dtype=np.int64)
    else:  # counts of common shingles by products of 0/1 matrices, some columns at a time
        ra, rb = np.unique(i), np.unique(j)
        rows = [a[x] for x in ra] + [b[y] for y in rb]
        value, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(rows)), [r.size for r in rows])
        shared = times[column] > 1
        renumber = np.cumsum(times > 1) - 1
        column, row = renumber[column[shared]], row[shared]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        total = np.zeros((ra.size, rb.size), dtype=np.float32)
        width = 4096
        for lo in range(0, int(renumber[-1]) + 1 if renumber.size else 0, width):
            s, e = np.searchsorted(column, [lo, lo + width])
            m = np.zeros((len(rows), width), dtype=np.float32)
            m[row[s:e], column[s:e] - lo] = 1
            total += m[:ra.size] @ m[ra.size:].T
        inter = total[np.searchsorted(ra, i), np.searchsorted(rb, j)].astype(np.int64)
    na, nb = np.array([s.size for s in a], dtype=np.int64), np.array([s.size for s in b], dtype=np.int64)
    return 100 * inter >= percent * (na[i] + nb[j] - inter)


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join two trees: as good as all of them for components."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in pairs:
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _blocks(count, shingles):
    return F.greatest(F.ceil(count / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _clustered(reps: DataFrame, banded: DataFrame, name: str) -> DataFrame:
    """rep, label, n, cluster of every representative that shares a band (rep, label, key) with another label."""
    buckets = banded.groupBy("key").agg(F.min("rep").alias("least"), F.min("label").alias("low"),
                                        F.max("label").alias("high")).where("low <> high")
    stars = banded.join(buckets, "key").where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    clusters = components(stars, f"neardup-{name}")
    return stage(reps.select("rep", "label", "n").join(
        clusters.select(F.col("id").alias("rep"), F.col("component").alias("cluster")), "rep"), f"neardup-{name}")


def _block_pairs(clustered: DataFrame) -> DataFrame:
    """doc_id, label, cluster, blocks, block, others (the blocks that the document's block is compared with).

    The blocks of a cluster's largest label come first and are not compared
    with each other.
    """
    labels = clustered.groupBy("cluster", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sized = labels.groupBy("cluster").agg(
        F.sum("c").alias("docs"), F.sum("s").alias("shingles"), F.max(F.struct("c", "label", "s")).alias("top"))
    sized = sized.withColumn("first", F.when(_blocks(F.col("top.c"), F.col("top.s")) > 1, _blocks(F.col("top.c"), F.col("top.s"))).otherwise(0))
    rest = _blocks(F.col("docs") - F.col("top.c"), F.col("shingles") - F.col("top.s"))
    sized = sized.withColumn("blocks", F.when(F.col("first") > 0, F.col("first") + F.greatest(rest, F.lit(1)))
                             .otherwise(_blocks(F.col("docs"), F.col("shingles"))))
    top = (F.col("first") > 0) & (F.col("label") == F.col("top.label"))
    spread = F.xxhash64("rep")
    block = F.when(top, F.pmod(spread, F.greatest("first", F.lit(1)))).otherwise(
        F.col("first") + F.pmod(spread, F.col("blocks") - F.col("first"))).cast("int")
    return clustered.join(sized, "cluster").select(
        F.col("rep").alias("doc_id"), "label", "cluster", "blocks", block.alias("block"),
        F.sequence(F.when(top, F.col("first")).otherwise(0), F.col("blocks") - 1).alias("others"))


def _bucket_blocks(reps: DataFrame, bands: int) -> DataFrame:
    """The same columns for the buckets of PASSES bands; a block is compared with itself only."""
    step = max(1, bands // PASSES)
    chosen = F.posexplode(F.filter("keys", lambda _, i: (i % step == 0) & (i < step * PASSES)))
    rows = reps.select("rep", "label", "n", chosen.alias("pass", "key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("c"), _blocks(F.count("*"), F.sum("n")).alias("blocks")).where("c > 1")
    block = F.pmod(F.xxhash64("rep", "pass"), F.col("blocks")).cast("int")
    return rows.join(sizes, "key").select(F.col("rep").alias("doc_id"), "label", F.col("key").alias("cluster"), "blocks",
                                          block.alias("block"), F.array(block).alias("others"))


def verified_links(members: DataFrame, texts: DataFrame, percent: int, bands: int, rows: int, batch: int,
                   miss: float) -> DataFrame:
    """Spanning links (a, b) between different labels, by the blocks that ``members`` names."""
    size = bands * rows
    table = least_matches(percent / 100, size, batch, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "part"):
            order = np.argsort(np.array(group["doc_id"].to_pylist(), dtype=np.int64), kind="stable")
            ids = group["doc_id"].to_numpy()[order]
            side = group["side"].to_numpy()[order]
            label = group["label"].to_numpy()[order]
            data, offsets = sh.text_bytes(group["text"].combine_chunks().take(pa.array(order)))
            parts: list[np.ndarray] = []
            for i, j in sh.sub_batches(offsets):
                parts += sh.sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sig = sh.signatures(parts, size)
            keys = band_keys(sig, bands, rows)
            a = np.flatnonzero(side != 1)
            b = np.flatnonzero(side != 0)
            same = bool((side == 2).all())
            i, j = _pairs(sig[a], keys[a], label[a], sig[b], keys[b], label[b], same, table)
            sa, sb = [parts[x] for x in a], [parts[x] for x in b]
            ok = _links(sa, sb, i, j, percent) if i.size else np.zeros(0, bool)
            found = _forest([(int(ids[a[x]]), int(ids[b[y]])) for x, y in zip(i[ok], j[ok])])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                              pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    # Small clusters share a part: documents of different clusters have no band in common.
    shared = max(1, members.where("blocks = 1").count() // PART_DOCS)
    # One row per pair of blocks that the document's block is in; side 2: a
    # block with itself, else 0 for the lower and 1 for the higher block.
    placed = members.withColumn("other", F.explode("others")).select(
        "doc_id", "label",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(shared)))
        .otherwise(F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))).alias("part"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))
    # The placed rows grow with the input: never broadcast.
    return (texts.join(placed.hint("merge"), "doc_id").select("part", "side", "doc_id", "label", "text")
            .repartition("part").sortWithinPartitions("part").mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT, bands: int = BANDS, rows: int = ROWS,
                    batch: int = BATCH, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row."""
    described = stage(describe(docs, bands, rows), "neardup-described")
    reps = described.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    reps = stage(reps, "neardup-reps")
    alone = reps.withColumn("label", F.col("rep"))
    clustered = _clustered(alone, alone.select("rep", "label", F.explode("keys").alias("key")), "clusters")
    # Only the texts of candidates are joined again, and shipped, below.
    texts = stage(trimmed(docs, "doc_id", "text").join(
        clustered.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi"), "neardup-texts")
    how = (texts, percent, bands, rows, batch, miss)
    members = _block_pairs(clustered)
    links = verified_links(members.where(F.col("blocks") <= PASSES), *how)
    large = stage(members.where(F.col("blocks") > PASSES).select(F.col("doc_id").alias("rep")), "neardup-large")
    if not large.isEmpty():
        inside = alone.join(large, "rep", "left_semi")
        near = components(verified_links(_bucket_blocks(inside, bands), *how), "neardup-near")
        inside = stage(inside.drop("label").join(near.select(F.col("id").alias("rep"), F.col("component").alias("label")), "rep", "left")
                       .withColumn("label", F.coalesce("label", "rep")), "neardup-contracted")
        mixed = _clustered(inside, inside.select("rep", "label", F.explode("keys").alias("key")), "mixed")
        links = links.unionAll(near.select("id", "component")).unionAll(verified_links(_block_pairs(mixed), *how))
    found = components(links, "neardup-links")
    classes = reps.select("digest", "rep").join(
        found.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    out = described.drop("keys").join(classes, "digest", "left")
    component = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
