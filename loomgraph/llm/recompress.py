"""Removal of long repeated word sequences by recompression.

A text's words are named by content.  Runs of one word get one name, then in
each round adjacent names join to a pair's name: a coin drawn from each name
makes it a left or a right one, and a left one joins a right one that follows.
Names and coins depend on content only, so equal stretches of text anywhere get
equal interior symbols.  Each symbol also carries its reach: the words that its
name and borders depend on.  A window that holds the whole reach of a symbol
that occurs once in the corpus cannot occur twice, so windows are candidates
only where all their symbols are shared; candidates are verified by 128-bit
names of their words, two independent ones of 64 bits.  Symbols are known by 64
bits: two that pass as one only leave a window among the candidates.

A round that asked Spark for the name of each distinct run or pair would hand
out numbers instead of hashes, one for each content, and so give the same
classes of equal symbols, the same coins being drawn from content.  Only which
symbols occur more than once takes the whole corpus, and that is asked of Spark
once, after the last round, instead of once a round.

Both questions are exchanges between blocks of documents and ranges of names:
a block sends its distinct names to the range they fall in and gets one bit for
each back.  A name is sent once a block however often it occurs, so one passage
in a third of all documents costs no range more than others, and no task sees
more than a range's share; there are as many ranges as the amount of text asks
for.  Blocks are a bucketed table, so texts are never shuffled.

Two different windows among n candidates pass as equal with a chance of about
n * n / 2**129.

Defined cases: a null text has no words; texts with fewer words than a window
lose nothing; texts of any length are read whole; repeated rows repeat each
other; an empty table gives an empty result; other columns are carried along
(but ``n_words``, ``n_removed`` and ``kept_sha256``, which are replaced).
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import U64, mix, trim, window_hashes, word_bounds, word_hashes
from .store import fresh_path, partitions

WINDOW = 35
ROUNDS = 5
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Bytes of text for each range of names, at most: each range's names fit in a task's memory.
RANGE = 128 << 20
_FAR = 1 << 40


def blocks(docs: DataFrame, text: str) -> DataFrame:
    """The documents as a table of ``block``, ``bytes`` of text and ``rows`` (Arrow stream, compressed), bucketed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).cumsum()
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + BLOCK, side="right")))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.slice(at, stop - at))
                size = int(sizes[stop - 1] - before)
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "bytes", "rows"])
                number, at = number + 1, stop

    spark = docs.sparkSession
    name = f"loomgraph_blocks_{uuid.uuid4().hex}"
    table = docs.mapInArrow(run, "block long, bytes long, rows binary")
    table.write.option("path", fresh_path(spark, name)).option("compression", "none").bucketBy(partitions(spark), "block").saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name: the files stay in the shared folder, and the plan has them
    return held


def unpack(rows: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(rows).read_next_batch()


class Words:
    """The words of a block: byte bounds, names, and the document each belongs to."""

    def __init__(self, texts: pa.Array):
        parts = [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in texts.to_pylist()]
        self.texts = parts
        data = np.frombuffer(b" ".join(parts), np.uint8)
        starts, ends = word_bounds(data)
        self.names = word_hashes(data, starts, ends)
        self._bytes = data, starts, ends
        offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
        self.first = np.searchsorted(starts, offsets)  # first word of each document, and the end
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(parts)), self.counts)

    def windows(self) -> np.ndarray:
        """Start of every window inside one document."""
        n = max(0, len(self.names) - WINDOW + 1)
        return np.flatnonzero(self.owner[:n] == self.owner[len(self.names) - n :])

    def window_names(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second names of the windows at ``starts``."""
        if not len(starts):
            return np.empty(0, U64), np.empty(0, U64)
        second = word_hashes(*self._bytes, second=True)
        return window_hashes(self.names, WINDOW)[starts], window_hashes(second, WINDOW)[starts]


def symbols(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, reach start and reach end (word positions in the block) of each symbol after all rounds."""
    name, owner = words.names, words.owner
    n = len(name)
    if not n:
        return name, np.empty(0, np.int64), np.empty(0, np.int64)
    # runs: the reach is the run and one word on either side
    new = np.ones(n, bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    name = np.where(size > 1, mix(name[start] + size.astype(U64) * U64(0x9FB21C651E98DF25)), name[start])
    owner = owner[start]
    low, high = start - 1, start + size + 1
    edge = np.ones(len(start), bool)
    edge[1:] = owner[1:] != owner[:-1]
    low[edge] = -_FAR
    high[np.append(edge[1:], True)] = _FAR
    for r in range(ROUNDS):
        left = (mix(name + U64(0x632BE59BD9B4E019 + r)) & U64(1)).astype(bool)
        m = len(name)
        same = np.zeros(m, bool)  # the next symbol is in the same document
        same[:-1] = owner[1:] == owner[:-1]
        join = np.zeros(m, bool)
        join[:-1] = left[:-1] & ~left[1:] & same[:-1]
        # a lone left symbol's fate hangs on the next one, a lone right symbol's on the one before
        next_high = np.append(high[1:], _FAR)
        next_low = np.append(low[1:], _FAR)
        last_low = np.append(-_FAR, low[:-1])
        last_high = np.append(-_FAR, high[:-1])
        after, ahead = same, np.append(False, same[:-1])
        taken = np.append(False, join[:-1])
        new_low, new_high = low.copy(), high.copy()
        use = left & ~join
        new_high[use] = np.where(after[use], np.maximum(high[use], next_high[use]), _FAR)
        new_low[use & after] = np.minimum(low, next_low)[use & after]
        use = ~left & ~taken
        new_low[use] = np.where(ahead[use], np.minimum(low[use], last_low[use]), -_FAR)
        new_high[use & ahead] = np.maximum(high, last_high)[use & ahead]
        new_high[join] = np.maximum(high, next_high)[join]
        new_low[join] = np.minimum(low, next_low)[join]
        next_name = np.append(name[1:], U64(0))
        name = np.where(join, mix(name * U64(0xFF51AFD7ED558CCD) + next_name + U64(0x2545F4914F6CDD1D)), name)
        keep = ~taken
        name, owner, low, high = name[keep], owner[keep], new_low[keep], new_high[keep]
    return name, low, high


def possible(words: Words, once: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Start of the windows that hold no whole reach of a symbol that occurs ``once``."""
    starts = words.windows()
    # such a symbol rules out the windows that start in high - WINDOW .. low
    a, b = np.maximum(high[once] - WINDOW, 0), low[once]
    ok = a <= b
    ruled = np.zeros(len(words.names) + 2, np.int64)
    ruled += np.bincount(a[ok], minlength=len(ruled))[: len(ruled)]
    ruled -= np.bincount(b[ok] + 1, minlength=len(ruled))[: len(ruled)]
    return starts[np.cumsum(ruled)[starts] == 0]


class Distinct:
    """The distinct names of an array, sorted; with ``second`` names, the distinct pairs of both."""

    def __init__(self, names: np.ndarray, second: np.ndarray | None = None):
        order = np.argsort(names, kind="stable")
        new = np.ones(len(names), bool)
        new[1:] = names[order[1:]] != names[order[:-1]]
        if second is not None and ((second[order[1:]] != second[order[:-1]]) & ~new[1:]).any():
            order = np.lexsort((second, names))
            new[1:] = (names[order[1:]] != names[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
        self.names = names[order[new]]
        self.second = None if second is None else second[order[new]]
        group = np.cumsum(new) - 1
        self.back = np.empty(len(names), np.int64)
        self.back[order] = group
        self.counts = np.bincount(group, minlength=len(self.names))


def _ranges(names: np.ndarray, n: int) -> np.ndarray:
    """Ends of the slices of sorted names that fall in each of ``n`` equal ranges of 64 bits."""
    width = (1 << 64) // n + 1
    return np.searchsorted(names, np.array([min((1 << 64) - 1, width * (k + 1) - 1) for k in range(n)], U64), side="right")


def _send(block: int, found: Distinct, n: int) -> pa.RecordBatch:
    """One row for each range that a block's names fall in: distinct names, then second ones, and bits for those twice here."""
    ends = _ranges(found.names, n)
    starts = np.append(0, ends[:-1])
    at = np.flatnonzero(ends > starts)
    cut = [slice(starts[k], ends[k]) for k in at]
    own = [found.names[c].tobytes() + (b"" if found.second is None else found.second[c].tobytes()) for c in cut]
    twice = [np.packbits(found.counts[c] > 1).tobytes() for c in cut]
    m = len(at)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([block] * m, pa.int64()), pa.array([_NAMES] * m, pa.int32()), pa.array(own, pa.binary()), pa.array(twice, pa.binary())], names=_SENT)


_SENT = ["range", "block", "kind", "names", "twice"]
_SENT_SCHEMA = "range int, block long, kind int, names binary, twice binary"
#: Kinds of rows in an exchange: names to be counted, and notes that come back unchanged.
_NAMES, _NOTE = 0, 1


def exchange(sent: DataFrame, wide: bool = False) -> DataFrame:
    """For each block the answers of all ranges: ``answers``, an array of kind, range and bits (name, or pair of names if ``wide``, occurs more than once)."""

    def count(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        raw, twice = table.column("names").to_pylist(), table.column("twice").to_pylist()
        rows = np.flatnonzero(kinds == _NAMES)
        bits: list[bytes] = list(raw)
        if len(rows):
            parts = [np.frombuffer(raw[k], U64).reshape(1 + wide, -1) for k in rows]
            whole = Distinct(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]) if wide else None)
            again = np.concatenate([np.unpackbits(np.frombuffer(twice[k], np.uint8), count=p.shape[1]) for k, p in zip(rows, parts, strict=True)]).astype(bool)
            many = whole.counts > 1
            many[whole.back[again]] = True
            answer, at = many[whole.back], 0
            for k, p in zip(rows, parts, strict=True):
                bits[k] = np.packbits(answer[at : at + p.shape[1]]).tobytes()
                at += p.shape[1]
        return pa.table([table.column("block"), table.column("kind"), table.column("range"), pa.array(bits, pa.binary())], names=["block", "kind", "range", "bits"])

    answered = sent.groupBy("range").applyInArrow(count, "block long, kind int, range int, bits binary")
    return answered.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "bits")).alias("answers"))


def _many(found: Distinct, answers: list[dict], n: int) -> np.ndarray:
    """For each name of the array behind ``found``, whether it occurs more than once in the corpus."""
    ends = _ranges(found.names, n)
    out = np.zeros(len(found.names), bool)
    for x in answers:
        if x["kind"] == _NAMES:
            start = ends[x["range"] - 1] if x["range"] else 0
            m = ends[x["range"]] - start
            out[start : start + m] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=m)
    return out[found.back]


def remove_repeats(docs: DataFrame, text: str = "text", digest: bool = False, verbatim: bool = False) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept words joined by one space, ``n_words`` and ``n_removed``.

    With ``digest`` the text is left out and ``kept_sha256`` given in its place;
    with ``verbatim`` a text that loses no word stays as it is, null included.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256")
    table = blocks(docs, text)
    n = max(partitions(docs.sparkSession), -(-(table.agg(F.sum("bytes")).first()[0] or 0) // RANGE))

    def send_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield _send(block, Distinct(symbols(Words(unpack(rows).column(text)))[0]), n)
            trim()

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, words = batch.column(0)[k].as_py(), Words(unpack(batch.column(1)[k].as_py()).column(text))
                name, low, high = symbols(words)
                starts = possible(words, ~_many(Distinct(name), batch.column(2)[k].as_py() or [], n), low, high)
                yield _send(block, Distinct(*words.window_names(starts)), n)
                note = np.zeros(len(words.names), bool)
                note[starts] = True
                note = pa.compress(np.packbits(note).tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([block % n], pa.int32()), pa.array([block]), pa.array([_NOTE], pa.int32()), pa.array([note], pa.binary()), pa.array([b""], pa.binary())], names=_SENT)
            trim()

    kept = [f for f in docs.schema.fields if not (digest and f.name == text)]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = unpack(batch.column(1)[k].as_py())
                answers = batch.column(2)[k].as_py() or []
                words = Words(rows.column(text))
                total = len(words.names)
                gone = np.zeros(total + 1, np.int64)
                if total:
                    note = next(x["bits"] for x in answers if x["kind"] == _NOTE)
                    size = -(-total // 8)
                    note = np.frombuffer(pa.decompress(note, size, "zstd", asbytes=True), np.uint8)
                    starts = np.flatnonzero(np.unpackbits(note, count=total))
                    starts = starts[_many(Distinct(*words.window_names(starts)), answers, n)]
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + WINDOW, -1)
                gone = np.cumsum(gone)[:total] > 0
                out_text, removed = [], []
                for d, raw in enumerate(words.texts):
                    mask = gone[words.first[d] : words.first[d + 1]]
                    lost = int(np.count_nonzero(mask))
                    removed.append(lost)
                    if verbatim and not digest and not lost:
                        out_text.append(rows.column(text)[d].as_py())
                        continue
                    own = raw.split()
                    joined = b" ".join(own if not lost else itertools.compress(own, ~mask))
                    out_text.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "surrogatepass"))
                columns = {f.name: rows.column(f.name) for f in kept}
                columns["kept_sha256" if digest else text] = pa.array(out_text, pa.string())
                columns |= {"n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            trim()

    told = exchange(table.select("block", "rows").mapInArrow(send_symbols, _SENT_SCHEMA)).hint("shuffle_hash")
    told = exchange(table.join(told, "block", "left").select("block", "rows", "answers").mapInArrow(send_windows, _SENT_SCHEMA), wide=True).hint("shuffle_hash")
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["kept_sha256 string"] * digest + ["n_words long", "n_removed long"]
    return table.join(told, "block", "left").select("block", "rows", "answers").mapInArrow(reduce, ", ".join(schema))
