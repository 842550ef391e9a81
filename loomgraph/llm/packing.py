"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Pieces of one length are interchangeable, so the packing is decided on the
histogram of lengths (at most ``size`` numbers, whatever the corpus): lengths go
in decreasing order, and a segment tree over remaining capacities finds the
tightest open bin in logarithmic time.  Bins of equal capacity with adjacent
numbers are handled as one range, which gives what placing one piece at a time
gives.  The decisions come back as a bounded list of steps and each piece finds
its place from its rank among the pieces of its length.

Defined cases: a null text counts as empty and packs as its end token alone; a
text of any length is cut into full pieces and a rest; repeated rows are packed
separately; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import trim
from .store import materialise, partitions
from .wordbpe import WordBpe

SIZE = 2048
END_ID = 0
#: Code points that are encoded together.
GROUP = 1 << 20
#: Parts that the pieces of one length are ranked in, at most; bounds the counts sent to the driver.
MOST_PARTS = 256


class CapacityTree:
    """Segment tree over capacities 0..size that finds the least one holding a bin and at least as large as asked."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.full = bytearray(2 * self.leaves)

    def set(self, capacity: int, held: bool) -> None:
        k = self.leaves + capacity
        self.full[k] = held
        while k > 1:
            k //= 2
            self.full[k] = self.full[2 * k] | self.full[2 * k + 1]

    def tightest(self, least: int) -> int | None:
        k = self.leaves + least
        if self.full[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.full[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.full[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


@dataclass
class Plan:
    """Steps by length: pieces ``first..first+count`` of a length go, ``each`` a bin, to bins from ``bin`` on, at ``base``."""

    steps: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=dict)
    bins: int = 0


def plan(counts: dict[int, int], size: int = SIZE) -> Plan:
    """Best-fit-decreasing of ``counts[length]`` pieces into bins of ``size``.

    A length leaves at most four more bin ranges and a bin holds at most 63
    different lengths of 2048, so there are at most 4 * 2048 * 63 steps.
    """
    tree, out = CapacityTree(size), Plan()
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def put(capacity: int, first: int, n: int) -> None:
        ranges[capacity].append((first, n))
        tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        left, placed, steps = counts[length], 0, out.steps.setdefault(length, [])
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, n = size, -(-left // (size // length))
                first, out.bins = out.bins, out.bins + n
            else:
                first, n = ranges[capacity].pop()
                if not ranges[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            whole = min(n, left // each)
            if whole:
                steps.append((placed, whole * each, first, each, size - capacity))
                put(capacity - each * length, first, whole)
                placed, left, first, n = placed + whole * each, left - whole * each, first + whole, n - whole
            if n and left and left < each:
                steps.append((placed, left, first, left, size - capacity))
                put(capacity - left * length, first, 1)
                placed, left, first, n = placed + left, 0, first + 1, n - 1
            if n:
                put(capacity, first, n)
    return out


def tokenise(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids of every text and its end id: key, piece, start, length, ids_crc32 and, if asked, ids.

    ``tokenizer`` is the path of the vocabulary file, the same on all machines.
    """
    source = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = source.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe(tokenizer)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts: list[str] = []
                room = GROUP
                while at + len(texts) < batch.num_rows and room > 0:
                    texts.append(batch.column(1)[at + len(texts)].as_py())
                    room -= len(texts[-1])
                yield rows(batch.column(0).slice(at, len(texts)), encoder.encode(texts), batch.schema.field(0).type)
                at += len(texts)
            trim()

    def rows(keys: pa.Array, found: list[np.ndarray], key_type: pa.DataType) -> pa.RecordBatch:
        owner, piece, start, length, crc, ids = [], [], [], [], [], []
        for k, doc in enumerate(found):
            doc = np.append(doc, np.uint32(END_ID)).astype("<u4", copy=False)
            for p, s in enumerate(range(0, len(doc), size)):
                part = doc[s : s + size]
                owner.append(k)
                piece.append(p)
                start.append(s)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                if with_ids:
                    ids.append(part.astype(np.int32))
        columns = [keys.take(pa.array(owner, pa.int64())).cast(key_type), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return source.mapInArrow(cut, schema)


def pack(pieces: DataFrame, order: list[str], size: int = SIZE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1..size and ``order`` tells pieces apart.

    ``pieces`` should be cheap to read twice (a table).  Each length's pieces are
    ranked in parts by hash, so that one common length spreads over all tasks.
    """
    spark = pieces.sparkSession
    parts = max(1, min(MOST_PARTS, partitions(spark)))
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    table = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")).toArrow()
    sizes = np.zeros((size + 1, parts), np.int64)
    sizes[table.column("length").to_numpy(), table.column("_part").to_numpy()] = table.column("n").to_numpy()
    before = np.cumsum(sizes, axis=1) - sizes
    made = plan({int(x): int(sizes[x].sum()) for x in np.flatnonzero(sizes.sum(axis=1))}, size)
    steps = {x: np.array(s, np.int64).reshape(-1, 5) for x, s in made.steps.items()}
    shared = spark.sparkContext.broadcast((before, steps))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*kept).schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, steps = shared.value
        for batch in batches:
            length, part = batch.column("length").to_numpy(), batch.column("_part").to_numpy()
            rank = before[length, part] + batch.column("_rank").to_numpy() - 1
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                s = steps[int(x)]
                hit = s[np.searchsorted(s[:, 0], rank[rows], side="right") - 1]
                at = rank[rows] - hit[:, 0]
                sequence[rows] = hit[:, 2] + at // hit[:, 3]
                offset[rows] = hit[:, 4] + at % hit[:, 3] * x
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "_part", "_rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row a piece; with ``with_ids`` also the ids themselves."""
    pieces = materialise(tokenise(docs, tokenizer, key, text, size, with_ids), "pieces")
    return pack(pieces, [key, "piece", "start", "ids_crc32"], size)
