"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

1. Each text gives its set of distinct word shingles and a MinHash signature.
   Texts with equal sets form one class; only its smallest key goes on.
2. Signatures are cut into bands; classes that agree on a band share a bucket.
   Within a bucket the signatures are compared batch by batch, and a pair is
   dropped once the posterior chance that its similarity reaches the threshold,
   given the agreements so far, is under the miss probability.
3. Survivors are verified exactly on the full sets.  A first round verifies the
   maximum spanning forest of each bucket's survivors, which joins nearly all
   that belongs together; the second verifies every survivor that still lies
   between two components, in matrix products of whole blocks, each of which
   gives back a spanning forest of its true links.  After it no surviving pair
   between components is left unverified, so components are as if all pairs had
   been verified, yet no more rows are made than buckets have members.

Buckets are cut into blocks by set size and each pair of blocks is one task's
group, so a large group of copies spreads; blocks whose sizes alone exclude the
threshold are never paired.  No partner or candidate is capped.

Defined cases: a null text, or one without words, has an empty set and links
with nothing; a text with fewer words than a shingle is one shingle; texts of
any length are read whole; repeated rows are one class; rows with a null key are
left out; a key on rows of different texts gives a row for each of them, and as
links go by key their classes may be mixed up, so such rows should get keys of
their own first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .kernels import U64, mix, sequence_hash, trim, window_hashes, word_bounds, word_hashes
from .store import materialise

SHINGLE = 5
#: Least similarity of a link in percent, where the caller gives none.
THRESHOLD = 85
#: Signature length, and rows of a band; a pair at 85 % misses all bands with probability 4e-7, one at 80 % with 5e-5.
HASHES, ROWS = 128, 5
BANDS = HASHES // ROWS
#: Signature places compared at a time, and the posterior under which a pair is dropped: eight such checks miss under 1e-4 together.
BATCH, MISS = 16, 1e-5
BLOCK = 2_048
#: Fixed-size filter of document keys, in bits; with more documents it only lets more through.
FILTER_BITS = 25
_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle names of a text, ASCII letters lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    words = word_hashes(data, *word_bounds(data), lower=True)
    if not len(words):
        return np.empty(0, U64)
    if len(words) < width:
        return np.array([sequence_hash(words)], U64)
    return np.unique(window_hashes(words, width))


def signature(names: np.ndarray) -> np.ndarray:
    """The least of each of ``HASHES`` multiply-shift images of a set, in slices of bounded size."""
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(names), 4096):
        part = (names[None, at : at + 4096] * _MULTIPLIERS[:, None]) >> U64(32)
        out = np.minimum(out, part.min(axis=1).astype(np.uint32))
    return out


def least_agreements(threshold: float, miss: float = MISS) -> list[int]:
    """For each number of compared batches: agreements under which P(similarity >= threshold) < miss, with a flat prior."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while _beta_tail(m + 1, n - m + 1, threshold) < miss:
            m += 1
        out.append(m)
    return out


def _beta_tail(a: int, b: int, x: float) -> float:
    """P(Beta(a, b) > x) for whole a and b, as a binomial sum."""
    n = a + b - 1
    return sum(math.comb(n, k) * x**k * (1 - x) ** (n - k) for k in range(a))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc``, ``n``, a 128-bit name of the set, and the signature (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, name, sig = [], [], []
            for cell in batch.column(1):
                found = shingle_set(cell.as_py())
                n.append(len(found))
                sums = np.array([np.bitwise_xor.reduce(mix(found)), np.add.reduce(mix(found ^ U64(0xA5A5A5A5A5A5A5A5)))]) if len(found) else None
                name.append(None if sums is None else sums.tobytes())
                sig.append(signature(found).tobytes() if len(found) else None)
            trim()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(name, pa.binary()), pa.array(sig, pa.binary())], names=["doc", "n", "name", "sig"])

    source = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc long, n long, name binary, sig binary")


def bands(classes: DataFrame) -> DataFrame:
    """One row for each class and band: ``bucket`` and the class's ``doc``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, HASHES).astype(U64)
            docs = batch.column(0).to_numpy()
            for b in range(BANDS):
                h = np.full(len(docs), b + 1, U64)
                for r in range(ROWS):
                    h = mix(h * U64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(docs), b, np.int32)), pa.array(docs)], names=["bucket", "nth", "doc"])

    return classes.select("doc", "sig").mapInArrow(run, "bucket long, nth int, doc long")


def _survivors(n_a: np.ndarray, sig_a: np.ndarray, n_b: np.ndarray, sig_b: np.ndarray, open_: np.ndarray, least: list[int], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and agreements of the pairs that sequential comparison leaves of those ``open_``."""
    ratio = np.minimum(n_a[:, None], n_b[None, :]) * 100 >= np.maximum(n_a[:, None], n_b[None, :]) * threshold
    i, j = np.nonzero(open_ & ratio)
    same = np.zeros(len(i), np.int64)
    for step, bound in enumerate(least):
        part = slice(step * BATCH, (step + 1) * BATCH)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            same[s] += (sig_a[i[s], part] == sig_b[j[s], part]).sum(axis=1)
        keep = same >= bound
        i, j, same = i[keep], j[keep], same[keep]
    return i, j, same


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Indexes of a maximum spanning forest (Kruskal)."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for k in np.lexsort((j, i, -weight)):
        a, b = root(int(i[k])), root(int(j[k]))
        if a != b:
            up[a] = b
            out.append(k)
    return np.array(out, int)


class _Group:
    """One pair of blocks: its members by side, and which pairs of them are open (between components)."""

    def __init__(self, table: pa.Table):
        side = table.column("side").to_numpy()
        order = np.lexsort((table.column("doc").to_numpy(), side))
        self.table = table
        self.doc, self.n, self.comp = (table.column(c).to_numpy()[order] for c in ("doc", "n", "comp"))
        self.order, side = order, side[order]
        # side 0 and 1: two blocks, all pairs between; side 2: one block, all pairs within
        within = bool((side == 2).all())
        self.a = np.arange(len(side)) if within else np.flatnonzero(side == 0)
        self.b = self.a if within else np.flatnonzero(side == 1)
        self.open = np.triu(np.ones((len(self.a), len(self.b)), bool), 1) if within else np.ones((len(self.a), len(self.b)), bool)
        self.open &= self.comp[self.a][:, None] != self.comp[self.b][None, :]

    def signatures(self) -> np.ndarray:
        raw = self.table.column("sig").to_pylist()
        return np.frombuffer(b"".join(raw), np.uint32).reshape(len(raw), HASHES)[self.order]

    def survivors(self, least: list[int], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Members i and j, agreements of the surviving pairs, and all signatures."""
        sig = self.signatures()
        i, j, same = _survivors(self.n[self.a], sig[self.a], self.n[self.b], sig[self.b], self.open, least, threshold)
        return self.a[i], self.b[j], same, sig


def forest(members: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``a`` < ``b``: a maximum spanning forest of the surviving pairs of each group of ``members`` (see ``blocks``)."""
    least = least_agreements(threshold / 100)

    def run(table: pa.Table) -> pa.Table:
        group = _Group(table)
        i, j, same, _ = group.survivors(least, threshold)
        keep = _forest(i, j, same, len(group.doc))
        x, y = group.doc[i[keep]], group.doc[j[keep]]
        return pa.table([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return members.groupBy("bucket", "left", "right").applyInArrow(run, "a long, b long").distinct()


def crossing(members: DataFrame, threshold: int) -> DataFrame:
    """The ``members`` of each group that have a surviving pair across components, without signatures.

    A pair that shares several buckets counts in the first of them only.
    """
    least = least_agreements(threshold / 100)

    def run(table: pa.Table) -> pa.Table:
        group = _Group(table)
        i, j, _, sig = group.survivors(least, threshold)
        nth = table.column("nth")[0].as_py()
        if nth and len(i):
            first = np.ones(len(i), bool)
            for b in range(nth):
                part = slice(b * ROWS, (b + 1) * ROWS)
                first &= ~(sig[i, part] == sig[j, part]).all(axis=1)
            i, j = i[first], j[first]
        held = np.zeros(len(group.doc), bool)
        held[i] = held[j] = True
        rows = group.order[held]
        return table.select(["bucket", "left", "right", "side", "doc", "n", "comp"]).take(pa.array(rows))

    return members.groupBy("bucket", "left", "right").applyInArrow(run, "bucket long, left int, right int, side int, doc long, n long, comp long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of all sets in ``a`` with all in ``b``, as products of 0/1 matrices over slices of names."""
    both = [*a, *b]
    sizes = [len(x) for x in both]
    names, back, counts = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # only names in two sets can be shared
    owner = np.repeat(np.arange(len(both)), sizes)
    shared = counts[back] > 1
    owner, place = owner[shared], number[back[shared]]
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        s = slice(*np.searchsorted(place, [low, low + 4096]))
        part = np.zeros((len(both), 4096), np.float32)
        part[owner[s], place[s] - low] = 1
        out += part[: len(a)] @ part[len(a) :].T
    return out.astype(np.int64)


def cross_links(members: DataFrame, threshold: int) -> DataFrame:
    """Links ``a`` < ``b`` that join components: a spanning forest of the true links of each group of ``members`` (with ``names``)."""

    def run(table: pa.Table) -> pa.Table:
        group = _Group(table)
        raw = table.column("names").to_pylist()
        sets = [np.frombuffer(raw[k], U64) for k in group.order]
        shared = overlaps([sets[k] for k in group.a], [sets[k] for k in group.b]) if len(group.a) and len(group.b) else np.zeros(group.open.shape, np.int64)
        whole = group.n[group.a][:, None] + group.n[group.b][None, :] - shared
        i, j = np.nonzero(group.open & (100 * shared >= threshold * whole))
        i, j = group.a[i], group.b[j]
        _, comp = np.unique(group.comp, return_inverse=True)
        keep = _forest(comp[i], comp[j], np.ones(len(i)), len(group.doc))
        x, y = group.doc[i[keep]], group.doc[j[keep]]
        return pa.table([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return members.groupBy("bucket", "left", "right").applyInArrow(run, "a long, b long").distinct()


def blocks(members: DataFrame, threshold: int) -> DataFrame:
    """Deal the members of each bucket (bucket, nth, size, doc, n, sig, comp) to pairs of blocks.

    Blocks are ranges of log set size cut further by hash, about ``BLOCK``
    members each; a pair of size ranges too far apart for the threshold is left out.
    """
    step = math.log(100 / threshold) * 1.0001  # wider than a pair at the threshold, rounding included
    size_range = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    cuts = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    # small buckets are one block; in larger ones only equal and adjacent size ranges can hold pairs
    own = F.when(F.col("size") <= BLOCK, F.lit(0)).otherwise(size_range * cuts + F.pmod(F.xxhash64("doc"), cuts).cast("int"))
    rows = members.withColumn("cuts", cuts).withColumn("range", size_range).withColumn("own", own)
    near = F.when(F.col("size") <= BLOCK, F.array(F.lit(0))).otherwise(F.sequence((F.col("range") - 1) * F.col("cuts"), (F.col("range") + 2) * F.col("cuts") - 1))
    rows = rows.withColumn("other", F.explode(near))
    left, right = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("int")
    return rows.select("bucket", left.alias("left"), right.alias("right"), side.alias("side"), "nth", "doc", "n", "sig", "comp")


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)


def _filter(keys: DataFrame) -> np.ndarray:
    """A fixed-size bitmap of a one-column table of keys."""
    slots = keys.select(_slot(F.col(keys.columns[0]).cast("long")).alias("h"))
    words = slots.groupBy(F.shiftright("h", 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 31 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.astype(np.uint32)


def _maybe(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((bitmap[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def split_by_filter(docs: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` whose key is surely not among ``keys``, and the rest: a few more than those whose key is."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(keys))
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def part(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    held = _maybe(shared.value, batch.column(batch.num_columns - 1).to_numpy()) == wanted
                    yield batch.select(names).filter(pa.array(held))

        return docs.withColumn("_slot", F.coalesce(_slot(F.col(key).cast("long")), F.lit(0))).mapInArrow(run, schema)

    return part(False), part(True)


def sets_of(docs: DataFrame, key: str, text: str, pairs: DataFrame) -> DataFrame:
    """``doc`` and ``names`` (its sorted set, binary) for the documents in ``pairs`` and, by filter chance, a few others."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(pairs.select(F.explode(F.array("a", "b")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            take = np.flatnonzero(_maybe(shared.value, batch.column(2).to_numpy()))
            names = [shingle_set(batch.column(1)[int(k)].as_py()).tobytes() for k in take]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), pa.array(names, pa.binary())], names=["doc", "names"])

    own = F.col(key).cast("long")
    source = docs.where(F.col(key).isNotNull()).select(own.alias("doc"), F.col(text).alias("text"), _slot(own).alias("h"))
    return source.mapInArrow(run, "doc long, names binary")


def verify(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The ``pairs`` whose sets overlap enough, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            trim()
            keep = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    # which end fetches first is drawn by hash, so that one text with many links does not order all of them
    turn = pairs.select(F.when(F.xxhash64("a", "b") % 2 == 0, F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"))).alias("p")).select("p.a", "p.b")
    one = turn.join(sets.select(F.col("doc").alias("a"), F.col("names").alias("x")), "a")
    two = one.join(sets.select(F.col("doc").alias("b"), F.col("names").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row a document: key, ``n_shingles``, ``component_id`` (its smallest key), ``kept``; ``threshold`` in percent."""
    found = materialise(signatures(docs, key, text), "signatures")
    classes = found.where("n > 0").groupBy("name").agg(F.min("doc").alias("doc"), F.first("sig").alias("sig"), F.first("n").alias("n"))
    classes = materialise(classes, "classes")
    slots = materialise(bands(classes), "bands")
    shared = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(slots.join(shared, "bucket"), "members")
    full = members.join(classes.select("doc", "n", "sig"), "doc")
    first = materialise(forest(blocks(full.withColumn("comp", F.col("doc")), threshold), threshold), "forest")
    sets = sets_of(docs, key, text, first).join(first.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "doc", "left_semi")
    sets = materialise(sets.dropDuplicates(["doc"]), "sets")
    links = materialise(verify(first, sets, threshold), "links")
    parts = materialise(connected(links), "parts")
    # buckets that still hold several components among the documents with any survivor
    alive = sets.select("doc").join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left").select("doc", F.coalesce("component", "doc").alias("comp"))
    rest = members.join(alive, "doc")
    open_ = rest.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("bucket")
    rest = rest.join(open_, "bucket").join(classes.select("doc", "n", "sig"), "doc")
    second = cross_links(crossing(blocks(rest, threshold), threshold).join(sets, "doc"), threshold)
    links = links.union(materialise(second, "cross-links"))
    final = connected(links).select(F.col("node").alias("doc"), "component")
    named = classes.join(final, "doc", "left").select("name", F.coalesce("component", "doc").alias("component"))
    out = found.select("doc", "n", "name").join(named, "name", "left").withColumn("component", F.coalesce("component", "doc"))
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))
