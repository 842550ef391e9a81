"""SentencePiece segmentation by a max-plus parallel scan, and its inverse.

A text (spaces become U+2581, one is put in front) is cut into the vocabulary's
pieces so that the sum of their scores is largest; a code point that no piece
covers costs the usual unknown penalty and becomes byte pieces.  No piece goes
on behind an inner U+2581, so a text falls into units at word starts and the
best cut of each distinct unit is computed once.  Texts or units that are too
long for that are cut into chunks at fixed places, wherever that is: each chunk
gives a matrix of best sums between its boundary states (how far the last piece
reaches over the border); the matrices combine under (max, +), which is
associative, and with the states known every chunk is traced back on its own.
Scores are fixed-point integers, so all orders of combination give equal sums;
of equal sums the longest last piece wins.

Giant texts are rows of blocks of chunks: every block's matrix and every block's
trace is a task's work of its own, and only matrices and pieces of one text, never
its chunks, meet in one group (a text that Spark can hold has at most 2**15 blocks).

Defined cases: a null or empty text has no pieces; texts of any length are cut
whole; U+2581 in a text decodes as a space, as the format has it; repeated rows
are answered separately; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise
from .wordbpe import Slots

SPACE = "▁"
SCALE = 1 << 10
UNKNOWN_PENALTY = 10.0
CHUNK = 256
#: Texts from this many code points on, and units above the other, go through the chunk scan.
GIANT, LONG_UNIT = 65_536, 256
#: Code points of a block of a giant text (whole chunks), and of the parts in which it is first cut (whole blocks).
BLOCK, PART = 1 << 16, 1 << 22
#: Distinct units remembered a worker; emptied when full.
MEMORY = 300_000
_LOW = np.int64(-(1 << 60))


class Pieces:
    """Encoder and decoder for one SentencePiece model file, read through its library for pieces and scores only."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, model.unk_id(), np.int64)
        texts: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.bytes_of.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                texts[name] = i
                self.bytes_of.append(name.replace(SPACE, " ").encode())
        scores = np.array([round(model.get_score(i) * SCALE) for i in range(n)], np.int64)
        usual = [scores[i] for i in texts.values()]
        self.unknown = int(min(usual)) - int(UNKNOWN_PENALTY * SCALE)
        self.width = max(map(len, texts))
        self.powers = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(self.width + 1)], np.uint64)
        ids = np.array(list(texts.values()), np.int64)
        keys = np.array([self._key(np.array([*map(ord, t)], np.uint64)) for t in texts], np.uint64).view(np.int64)
        self.slots = Slots(keys, ids)
        self.scores = np.append(scores, 0)
        # units are only cut apart where no piece could go on
        self.splits = not any(SPACE in t.lstrip(SPACE) for t in texts)
        self.known: dict[str, bytes] = {}

    def _key(self, codes: np.ndarray) -> np.uint64:
        out = np.zeros(1, np.uint64)
        for c in codes:
            out = out * self.powers[1:2] + c + np.uint64(1)
        return (out ^ (out >> np.uint64(29)))[0]

    def table(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Id and score of the piece of each length from each of the first ``n`` places of rows of code points (0 pads); -1 and low where there is none."""
        lanes, wide = codes.shape
        w = min(self.width, wide)
        ids = np.full((lanes, n, w), -1, np.int64)
        hashes = np.zeros((lanes, n), np.uint64)
        for k in range(w):
            m = min(n, wide - k)  # places from which a piece of this length stays in the row
            hashes = hashes[:, :m] * self.powers[1] + codes[:, k : k + m] + np.uint64(1)
            found = self.slots.get((hashes ^ (hashes >> np.uint64(29))).view(np.int64))
            ids[:, :m, k] = np.where(found < len(self.scores) - 1, found, -1)
        score = np.where(ids >= 0, self.scores[ids], _LOW)
        score[:, :, 0] = np.where((ids[:, :, 0] < 0) & (codes[:, :n] > 0), self.unknown, score[:, :, 0])
        return ids, score

    @staticmethod
    def forward(score: np.ndarray, start: np.ndarray, trace: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Best sums at places 0..n+width-1 for tokens that begin before ``n``, from start values at the first places; and last lengths.

        ``score``: lanes x n x width; ``start``: lanes x states x width.  A place
        is reached from earlier ones first, so of equal sums the longest last
        piece stays.
        """
        (lanes, states, _), (_, n, w) = start.shape, score.shape
        best = np.full((lanes, states, n + w), _LOW)
        best[:, :, : start.shape[2]] = start
        last = np.zeros((lanes, states, n + w), np.int8) if trace else None
        sizes = np.arange(1, w + 1, dtype=np.int8)
        for t in range(n):
            new = best[:, :, t, None] + score[:, None, t, :]
            to = best[:, :, t + 1 : t + 1 + w]
            if trace:
                part = last[:, :, t + 1 : t + 1 + w]
                np.copyto(part, np.broadcast_to(sizes, part.shape), where=new > to)
            np.maximum(to, new, out=to)
        return best, last

    def _trace(self, codes: np.ndarray, ids: np.ndarray, last: np.ndarray, place: int) -> tuple[list[int], int]:
        """Piece ids of one lane, last first, back from ``place`` to before it; and where the first begins (may be over the left border)."""
        out: list[int] = []
        while place > 0 and last[place]:
            size = int(last[place])
            piece = int(ids[place - size, size - 1])
            if piece >= 0:
                out.append(piece)
            else:
                out += [int(x) for x in self.byte_ids[np.frombuffer(chr(int(codes[place - size])).encode("utf-8", "surrogatepass"), np.uint8)][::-1]]
            place -= size
        return out, place

    def scan(self, text: str) -> np.ndarray:
        """The best cut of one text, chunk by chunk."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        total, w = len(codes), self.width
        n = -(-total // CHUNK)
        rows = np.zeros((n, CHUNK + w), np.uint64)
        for c in range(n):
            part = codes[c * CHUNK : (c + 1) * CHUNK + w]
            rows[c, : len(part)] = part
        ids, score = self.table(rows, CHUNK)
        # 1: transfer matrices: state k is a piece border k places behind the chunk's start
        eye = np.full((w, w), _LOW)
        np.fill_diagonal(eye, 0)
        moves = np.concatenate([self.forward(score[a : a + 256], np.broadcast_to(eye, (len(score[a : a + 256]), w, w)), trace=False)[0][:, :, CHUNK : CHUNK + w] for a in range(0, n, 256)])
        # 2: values at every chunk's start, by a scan of max-plus products
        entry = np.concatenate([eye[None, :1], _prefixes(moves)[:-1, :1]])[:, 0]
        # 3: every chunk alone from its entry values; 4: states at the borders, then the pieces
        _, last = self.forward(score, entry[:, None, :])
        out: list[int] = []
        place = total - (n - 1) * CHUNK
        for c in range(n - 1, -1, -1):
            found, stop = self._trace(rows[c], ids[c], last[c, 0], place)
            out += found
            place = stop + CHUNK
        return np.array(out[::-1], np.int64)

    def _block(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunks of the first ``n`` code points of a block (more may follow, which pieces may reach into): codes, ids, scores, matrices."""
        w, chunks = self.width, -(-n // CHUNK)
        rows = np.zeros((chunks, CHUNK + w), np.uint64)
        for c in range(chunks):
            part = codes[c * CHUNK : (c + 1) * CHUNK + w]
            rows[c, : len(part)] = part
        ids, score = self.table(rows, CHUNK)
        eye = np.full((w, w), _LOW)
        np.fill_diagonal(eye, 0)
        moves = [self.forward(score[a : a + 64], np.broadcast_to(eye, (len(score[a : a + 64]), w, w)), trace=False)[0][:, :, CHUNK : CHUNK + w] for a in range(0, chunks, 64)]
        return rows, ids, score, np.concatenate(moves)

    def block_move(self, codes: np.ndarray, n: int) -> np.ndarray:
        """The transfer matrix of a whole block, as a tree of products."""
        moves = self._block(codes, n)[3]
        while len(moves) > 1:
            odd = moves[len(moves) & ~1 :]
            moves = np.concatenate([product(moves[0:-1:2], moves[1::2]), odd])
        return moves[0]

    def block_paths(self, codes: np.ndarray, n: int, entry: np.ndarray, exits: range) -> tuple[np.ndarray, list[tuple[int, np.ndarray, int, bool]]]:
        """The cuts of a block that end ``exits`` places behind its start, given the best sums at its first places.

        Paths from different ends soon meet, so they share one body of ids: each
        end has the number of body ids that it uses, its own ids after them, the
        place where its first piece begins, and whether its ids decode to the text.
        """
        rows, ids, score, moves = self._block(codes, n)
        starts = [entry]
        for move in moves[:-1]:
            starts.append(np.maximum((starts[-1][:, None] + move).max(axis=0), _LOW))
        best, last = self.forward(score, np.array(starts)[:, None, :])
        best, last = best[-1, 0], last[:, 0]
        chunks, met, body, out, first_same = len(rows), {}, [], [], True
        text = codes.astype(np.uint32)
        for place in exits:
            # (end in the block, ids) of each piece, last first
            own: list[tuple[int, list[int]]] = []
            c, at, begin = chunks - 1, place - (chunks - 1) * CHUNK, None
            if best[at] <= _LOW // 2:  # no piece reaches so far
                out.append((0, np.empty(0, "<u4"), 0, False))
                continue
            while begin is None:
                size = int(last[c, at]) if at > 0 else 0
                if not size:
                    if c == 0:
                        begin = at
                    c, at = c - 1, at + CHUNK
                    continue
                end = c * CHUNK + at
                if end in met:
                    break
                piece = int(ids[c, at - size, size - 1])
                code = chr(int(rows[c, at - size])).encode("utf-8", "surrogatepass") if piece < 0 else b""
                own.append((end, [piece] if piece >= 0 else [int(x) for x in self.byte_ids[np.frombuffer(code, np.uint8)]]))
                at -= size
            own.reverse()
            if begin is None:  # met the body, which covers the rest
                used, begin, start = *met[end], end
            else:
                used, start = 0, begin
            tail = [x for _, part in own for x in part]
            if not body:
                sizes = np.cumsum([len(part) for _, part in own])
                met = {end: (int(k), begin) for (end, _), k in zip(own, sizes, strict=True)}
                body, used, tail_ids, same = tail, len(tail), [], self._spells(tail, text[start:place])
                first_same = same
            else:
                tail_ids, same = tail, first_same and self._spells(tail, text[start:place])
            out.append((used, np.array(tail_ids, "<u4"), begin, same))
        return np.array(body, "<u4"), out

    def _spells(self, ids: list[int], codes: np.ndarray) -> bool:
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").replace(SPACE, " ")
        return b"".join(self.bytes_of[x] for x in ids) == text.encode("utf-8", "surrogatepass")

    def _cut(self, units: list[str]) -> list[bytes]:
        """The best cuts of units of like length, all traced back together."""
        n = max(map(len, units))
        codes = np.frombuffer("".join(u.ljust(n, "\0") for u in units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).astype(np.uint64)
        ids, score = self.table(codes, n)
        start = np.full((len(units), 1, 1), 0, np.int64)
        last = self.forward(score, start)[1][:, 0]
        place = np.array([len(u) for u in units])
        rows = np.arange(len(units))
        found = np.full((len(units), n), -1, np.int64)
        step = n
        while place.any():
            size = last[rows, place].astype(np.int64)
            step -= 1
            place = np.where(size > 0, place - size, 0)
            found[:, step] = np.where(size > 0, ids[rows, place, np.maximum(size, 1) - 1] * 2, -1)
            unknown = (size > 0) & (found[:, step] < 0)
            found[unknown, step] = codes[unknown, place[unknown]].astype(np.int64) * 2 + 1  # odd: a code point for byte pieces
        plain = ((found < 0) | (found % 2 == 0)).all(axis=1)
        tokens = (found // 2).astype(np.int64)
        first = (found >= 0).argmax(axis=1)
        out = []
        short = tokens.astype("<u4")
        for r in range(len(units)):
            if plain[r]:
                row = short[r, first[r] :]
                out.append(row[found[r, first[r] :] >= 0].tobytes() if (found[r, first[r] :] < 0).any() else row.tobytes())
            else:
                ids_r: list[int] = []
                for x in found[r][found[r] >= 0]:
                    ids_r += [int(x) // 2] if x % 2 == 0 else self.byte_ids[np.frombuffer(chr(int(x) // 2).encode("utf-8", "surrogatepass"), np.uint8)].tolist()
                out.append(np.array(ids_r, "<u4").tobytes())
        return out

    def _learn(self, units: list[str]) -> None:
        units.sort(key=len)
        at = 0
        while at < len(units):
            n = len(units[at])
            stop = at + 1
            while stop < len(units) and len(units[stop]) <= n + 1 and (stop - at) * (n + 1) < 1 << 17:
                stop += 1
            part = units[at:stop]
            if len(part[-1]) > LONG_UNIT:
                for u in part:
                    self.known[u] = self.scan(u).astype("<u4").tobytes()
                at = stop
                continue
            self.known.update(zip(part, self._cut(part), strict=True))
            at = stop

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit arrays."""
        cut: list[list[str] | None] = []
        for text in texts:
            marked = text.replace(" ", SPACE)
            if not text:
                cut.append([])
            elif not self.splits or len(text) >= GIANT or "\0" in text:
                cut.append(None)
            else:  # a run of marks stays with the word that follows
                parts = (SPACE + marked).split(SPACE)
                cut.append(_units(parts))
        if len(self.known) > MEMORY:
            self.known.clear()
        new = set().union(*(c for c in cut if c))
        self._learn(list(new.difference(self.known)))
        held = self.known.__getitem__
        return [
            self.scan(SPACE + text.replace(" ", SPACE)).astype("<u4") if units is None else np.frombuffer(b"".join(map(held, units)), "<u4")
            for text, units in zip(texts, cut, strict=True)
        ]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "surrogatepass") if raw[:1] == b" " else raw.decode("utf-8", "surrogatepass")


def _units(parts: list[str]) -> list[str]:
    """Words with the marks before them, from a text split at its marks (the first part is empty)."""
    if "" not in parts[1:]:
        return [SPACE + p for p in parts[1:]]
    out, marks = [], 0
    for p in parts[1:]:
        marks += 1
        if p:
            out.append(SPACE * marks + p)
            marks = 0
    if marks:
        out.append(SPACE * marks)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacks of matrices."""
    return np.maximum((a[:, :, :, None] + b[:, None, :, :]).max(axis=2), _LOW)


def _prefixes(moves: np.ndarray) -> np.ndarray:
    """Products of the first 1..n matrices by doubling."""
    out, step = moves.copy(), 1
    while step < len(out):
        out[step:] = product(out[:-step], out[step:])
        step *= 2
    return out


_SCHEMA = "ids array<int>, ids_crc32 long, round_trip boolean"


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, ``ids`` (array of int), ``ids_crc32`` and whether decoding gives the text back."""
    source = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = source.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Pieces(model)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts: list[str] = []
                room = 1 << 20
                while at + len(texts) < batch.num_rows and room > 0:
                    texts.append(batch.column(1)[at + len(texts)].as_py())
                    room -= len(texts[-1])
                found = coder.encode(texts)
                same = [coder.decode(ids) == t.replace(SPACE, " ") for ids, t in zip(found, texts, strict=True)]
                sizes = np.cumsum([0, *(len(x) for x in found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(found).astype(np.int32)))
                crc = pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids, crc, pa.array(same)], names=[key, "ids", "ids_crc32", "round_trip"])
                at += len(texts)

    giant = F.length("_text") >= GIANT
    return source.where(~giant).mapInArrow(run, f"`{key}` {kind}, {_SCHEMA}").unionByName(encode_giants(source.where(giant), model, key))


def _cut(text: Column, size: int, more: int, most: Column | None = None) -> Column:
    """Numbered pieces of ``size`` code points of ``text``, each with up to ``more`` that follow; pieces start before ``most``."""
    n = F.length(text) if most is None else F.least(F.length(text), most)
    return F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda k: F.substring(text, k * size + 1, F.lit(size + more))))


def encode_giants(source: DataFrame, model: str, key: str) -> DataFrame:
    """``_key`` and ``_text`` (not empty) as ``encode_documents`` gives them, each text's blocks in tasks of their own."""
    w = Pieces(model).width
    kind = source.schema["_key"].dataType.simpleString()
    marked = F.concat(F.lit(SPACE), F.replace(F.col("_text"), F.lit(" "), F.lit(SPACE)))
    rows = source.select(F.monotonically_increasing_id().alias("row"), "_key", marked.alias("t"))
    parts = rows.select("row", "_key", F.length("t").alias("total"), _cut(F.col("t"), PART, w).alias("part", "t"))
    cut = parts.select("row", "_key", "total", "part", _cut(F.col("t"), BLOCK, w, F.lit(PART)).alias("block", "t"))
    block = (F.col("part") * (PART // BLOCK) + F.col("block")).cast("int")
    n = F.least(F.lit(BLOCK), F.col("total") - block * BLOCK).cast("int")
    blocks = materialise(cut.select("row", "_key", "total", block.alias("block"), n.alias("n"), "t"), "blocks")

    def codes_of(cell: pa.Scalar) -> np.ndarray:
        return np.frombuffer(cell.as_py().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Pieces(model)
        for batch in batches:
            for k in range(batch.num_rows):
                move = coder.block_move(codes_of(batch.column(3)[k]), batch.column(2)[k].as_py()).tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([move], pa.binary())], names=["row", "block", "move"])

    def entries(table: pa.Table) -> pa.Table:
        """The best sums at each block's first places: a row vector through the matrices before it."""
        order = np.argsort(table.column("block").to_numpy())
        entry, out = np.full(w, _LOW), []
        entry[0] = 0
        raw = table.column("move")
        for k in order:
            out.append(entry.tobytes())
            move = np.frombuffer(raw[int(k)].as_py(), np.int64).reshape(w, w)
            entry = np.maximum((entry[:, None] + move).max(axis=0), _LOW)
        return table.select(["row", "block"]).take(pa.array(order)).append_column("entry", pa.array(out, pa.binary()))

    paths = pa.list_(pa.struct([("used", pa.int32()), ("tail", pa.binary()), ("begin", pa.int32()), ("same", pa.bool_())]))
    names = ["row", "key", "block", "body", "paths"]

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Pieces(model)
        for batch in batches:
            for k in range(batch.num_rows):
                x = {c: batch.column(c)[k] for c in ("total", "block", "n", "t", "entry")}
                n, block = x["n"].as_py(), x["block"].as_py()
                final = block * BLOCK + n == x["total"].as_py()
                codes, entry = codes_of(x["t"]), np.frombuffer(x["entry"].as_py(), np.int64)
                ends = range(n, n + 1) if final else range(n, min(n + w, len(codes) + 1))
                body, found = coder.block_paths(codes, n, entry, ends)
                held = [{"used": u, "tail": t.tobytes(), "begin": b, "same": s} for u, t, b, s in found]
                columns = [batch.column("row").slice(k, 1), batch.column("_key").slice(k, 1), pa.array([block], pa.int32()), pa.array([body.tobytes()], pa.binary()), pa.array([held], paths)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def joined(table: pa.Table) -> pa.Table:
        """One text's ids: from its end back, each block's path is the one that ends where the next block's begins."""
        out, same, end = [], True, 0
        for k in np.argsort(-table.column("block").to_numpy()):
            path = table.column("paths")[int(k)].as_py()[end]
            out += [path["tail"], table.column("body")[int(k)].as_py()[: 4 * path["used"]]]
            same, end = same and path["same"], path["begin"]
        raw = b"".join(reversed(out))
        ids = pa.array([np.frombuffer(raw, "<u4").astype(np.int32)], pa.list_(pa.int32()))
        return pa.table([table.column("key").slice(0, 1), ids, pa.array([zlib.crc32(raw)], pa.int64()), pa.array([same])], names=[key, "ids", "ids_crc32", "round_trip"])

    moved = blocks.select("row", "block", "n", "t").mapInArrow(moves, "row long, block int, move binary")
    entered = moved.groupBy("row").applyInArrow(entries, "row long, block int, entry binary")
    traced = blocks.join(entered, ["row", "block"]).mapInArrow(traces, f"row long, key {kind}, block int, body binary, paths array<struct<used:int,tail:binary,begin:int,same:boolean>>")
    return traced.groupBy("row").applyInArrow(joined, f"`{key}` {kind}, {_SCHEMA}")


def decode_documents(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row a document: key and ``text``."""
    source = encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    kind = source.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Pieces(model)
        for batch in batches:
            texts = [coder.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return source.mapInArrow(run, f"`{key}` {kind}, text string")
