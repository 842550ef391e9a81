"""Exact ids of the lower-casing word BPE vocabulary at batch speed.

Texts made only of characters whose handling is plain (listed in ``PLAIN``) are
cut by one regular expression and each distinct token is merged once, all new
tokens of a batch together as matrix steps.  Every other text, and every text
that holds one of the file's added tokens (such as an end-of-text mark), goes to
the tokenizer library itself.  Ids equal the library's either way (tested).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Characters that NFC leaves alone and whose lower case is one known character; the apostrophe is left out (contractions).
PLAIN = r"\t\n\x0b\x0c\r -&(-~¡-©«-±´¶-¸»¿-ÖØ-öø-įıĴ-ňŊ-ž–—…«»“”„€•"
_OTHER = re.compile(f"[^{PLAIN}]")
_TOKEN = re.compile(r"[a-zà-öø-žß]+|[0-9]|[^\sa-z0-9à-öø-žß]+")
#: Distinct tokens remembered a worker; the memory is emptied when full.
MEMORY = 300_000


class WordBpe:
    """Encoder for one tokenizer file; its added tokens inside texts get their own ids, as in the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        held = json.loads(self.slow.to_str())
        model = held["model"]
        added = [re.escape(t["content"]) for t in held["added_tokens"]]
        self.added = re.compile("|".join(added) or r"(?!)", re.IGNORECASE)
        vocab, merges = model["vocab"], model["merges"]
        self.suffix = model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 20 | right
        _, first = np.unique(keys[::-1], return_index=True)
        rank = len(keys) - 1 - first  # a pair that is listed twice keeps its last rank
        self.table = Slots(keys[rank], rank)
        self.made = made
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit arrays, without special tokens; new tokens of all texts are merged together."""
        cut = [None if _OTHER.search(t) or self.added.search(t) else _TOKEN.findall(t.lower()) for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = set().union(*(t for t in cut if t))
        self._learn(list(new.difference(self.known)))
        held = self.known.__getitem__
        return [
            np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
            if tokens is None
            else np.frombuffer(b"".join(map(held, tokens)), np.uint32)
            for text, tokens in zip(texts, cut, strict=True)
        ]

    def _learn(self, tokens: list[str]) -> None:
        raw = [t.encode() for t in tokens]
        sizes = np.array([len(r) for r in raw])
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            # tokens of like length share a matrix; a very long one is merged alone
            width = int(sizes[order[at]])
            stop = at + 1
            while stop < len(order) and sizes[order[stop]] <= max(width + 2, width * 5 // 4) and (stop - at) * sizes[order[stop]] < 1 << 20:
                stop += 1
            part = order[at:stop]
            if sizes[part[-1]] > 512:
                for k in part:
                    ids = self.slow.encode(tokens[k], add_special_tokens=False).ids
                    self.known[tokens[k]] = np.array(ids, np.uint32).tobytes()
            else:
                for k, ids in zip(part, self._merge([raw[k] for k in part], sizes[part]), strict=True):
                    self.known[tokens[k]] = ids
            at = stop

    def _merge(self, raw: list[bytes], sizes: np.ndarray) -> list[bytes]:
        width = int(sizes.max())
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(len(raw), width)
        ids = self.inner[data]
        rows = np.arange(len(raw))
        ids[rows, sizes - 1] = self.last[data[rows, sizes - 1]]
        ids[np.arange(width) >= sizes[:, None]] = -1
        left, out = sizes.copy(), [b""] * len(raw)
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        alive = rows
        while len(alive):
            if ids.shape[1] > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(ids)), at]
                done = best == _NONE
            else:
                at, best, done = np.zeros(len(ids), int), None, np.ones(len(ids), bool)
            if done.any():
                final = ids[done].astype(np.uint32)
                for k, row, n in zip(alive[done], final, left[done], strict=True):
                    out[k] = row[:n].tobytes()
                go = ~done
                alive, ids, left, at, ranks = alive[go], ids[go], left[go], at[go], ranks[go]
                if not len(alive):
                    break
                best = best[go]
            here = np.arange(len(ids))
            ids[here, at] = self.made[best]
            keep = np.ones(ids.shape, bool)
            keep[here, at + 1] = False
            ids = ids[keep].reshape(len(ids), -1)
            left -= 1
            if ids.shape[1] == 1:
                ranks = np.empty((len(ids), 0), np.int64)
                continue
            # one pair fewer: the one after the merged symbol closes up, its neighbours get new ranks
            drop = np.ones(ranks.shape, bool)
            drop[here, np.minimum(at + 1, ranks.shape[1] - 1)] = False
            ranks = ranks[drop].reshape(len(ids), -1)
            for side in (at - 1, at):
                ok = (side >= 0) & (side < ranks.shape[1])
                r, c = here[ok], side[ok]
                ranks[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.table.get(a << 20 | np.maximum(b, 0))
        return np.where((a < 0) | (b < 0), _NONE, found)


_NONE = np.int64(1 << 40)


class Slots:
    """A static hash table of 64-bit keys for whole arrays of look-ups."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = 19
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int64)
        rest, at = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = self.keys[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            first = first[free[first]]
            self.keys[at[first]], self.values[at[first]] = keys[rest[first]], values[rest[first]]
            left = np.ones(len(rest), bool)
            left[first] = False
            rest, at = rest[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        shape, keys = keys.shape, keys.ravel()
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], _NONE)
        rest = np.flatnonzero((held != keys) & (held != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[rest]]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (held != -1)]
        return out.reshape(shape)


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else 256 onwards."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
