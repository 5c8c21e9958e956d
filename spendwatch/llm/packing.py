"""Bounded-space best-fit packing of tokenised documents.

A document's ids are its tokens and a closing id; one of more than ``capacity``
ids is cut into full pieces, the first piece taking the remainder.  Pieces are
dealt by hash into groups of about GROUP_SEQUENCES sequences.  A group takes its
pieces online, in order of doc_id and piece, and keeps at most ``open_bins`` open
bins, held in stacks by free space; a bitset says which free spaces have a bin, so
the best fit is the lowest set bit at or above the piece's length.  When a new
bin is needed and none may be opened, the fullest bin closes.  With ``falling`` a
group is sorted by falling length first: tighter by about a hundredth, not online.

The ids are those of the tokenizers library on the vocabulary's JSON file.  The
rank form of the same vocabulary encodes several times faster and takes the texts
for which both give the same ids; the library itself takes those with a run of at
least LONG_RUN whitespace characters, where the rank form's split overflows, and,
with ``special_tokens``, those with the literal of an added token.

Defined cases: a null or empty text is the closing id alone; an added token's
literal is ordinary text unless ``special_tokens`` is set, as the queries do, which
gives its id as the library does by default; repeated rows are packed as often as they occur; ties go by doc_id and piece, so the result of a
group does not depend on the order of its input.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import empty_if_null, grouped, stage, trimmed

CAPACITY = 2048
CLOSING_ID = 0
OPEN_BINS = 64
GROUP_SEQUENCES = 4096
LONG_RUN = 100_000
_RUN = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")
_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a rank file (base64 token, rank), loaded once per worker."""
    if vocabulary not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        _encoders[vocabulary] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


def library(vocabulary: str, special_tokens: bool):
    """The tokenizers library on a vocabulary's JSON file, loaded when first needed."""
    if (vocabulary, special_tokens) not in _encoders:
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(vocabulary)
        if not special_tokens:
            own.encode_special_tokens = True
        _encoders[vocabulary, special_tokens] = own
    return _encoders[vocabulary, special_tokens]


def added_tokens(vocabulary: str) -> list[str]:
    """The literals that the library reads as single tokens."""
    import json
    with open(vocabulary, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def ids_of(vocabulary: str, special_tokens: bool):
    """The function from a text to its ids."""
    import public_tokenizers
    bpe = encoder(public_tokenizers.path(vocabulary))
    whole = public_tokenizers.path(vocabulary.rsplit(".", 1)[0] + ".json")
    literals = added_tokens(whole) if special_tokens else []

    def run(text: str) -> list[int]:
        if any(x in text for x in literals) or (len(text) >= LONG_RUN and _RUN.search(text)):
            return library(whole, special_tokens).encode(text, add_special_tokens=False).ids
        return bpe.encode_ordinary(text)

    return run


def pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, with_ids: bool = False,
           special_tokens: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the document's ids, cut at ``capacity``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(vocabulary, special_tokens)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(np.array(encode(text.as_py()), dtype="<u4"), np.uint32(CLOSING_ID)).astype("<u4")
                count = -(-ids.size // capacity)
                cut = ids.size - capacity * (count - 1)
                for k in range(count):
                    start = 0 if k == 0 else cut + capacity * (k - 1)
                    own = ids[start:cut + capacity * k].tobytes()
                    rows.append((doc_id, k, start, len(own) // 4, zlib.crc32(own), own))
            doc, piece, start, length, crc, ids = zip(*rows) if rows else ((),) * 6
            arrays = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return trimmed(docs, "doc_id", "text").select("doc_id", empty_if_null("text").alias("text")).mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """The bin and the offset of each length, in the order given."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = opened = used = 0
    bins, offsets = [], []
    for length in lengths:
        fitting = bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = stacks[free].pop()
            if not stacks[free]:
                bits ^= 1 << free
            opened -= 1
        else:
            if opened == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                stacks[fullest].pop()
                if not stacks[fullest]:
                    bits ^= 1 << fullest
                opened -= 1
            own, free = used, capacity
            used += 1
        bins.append(own)
        offsets.append(capacity - free)
        if free > length:
            stacks[free - length].append(own)
            bits |= 1 << (free - length)
            opened += 1
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         with_ids: bool = False, special_tokens: bool = False, falling: bool = False) -> DataFrame:
    """One row per piece: its ids' place in the document, their checksum, its sequence and the offset there."""
    cut = stage(pieces(docs, vocabulary, capacity, with_ids, special_tokens), "packing-pieces")
    total = cut.agg(F.sum("length").alias("n")).first()["n"] or 0
    groups = max(1, round(total / (capacity * GROUP_SEQUENCES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "part"):
            bins, offsets = best_fit(group["length"].to_pylist(), capacity, open_bins)
            first = group["part"][0].as_py() << 32
            out = group.drop_columns(["part"]).append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
            yield from out.append_column("offset", pa.array(offsets, pa.int64())).combine_chunks().to_batches()

    columns = ", ".join(f"{n} {t}" for n, t in cut.dtypes)
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("long"))
    # Ties of repeated rows go by what differs in them, so the order does not depend on the input's.
    order = [*[F.desc("length")] * falling, "doc_id", "piece", "length", "ids_crc32"]
    return (dealt.repartition("part").sortWithinPartitions("part", *order)
            .mapInArrow(run, f"{columns}, sequence_id long, offset long"))
