"""Secret scan: fixed patterns, and guess costs of values in credential contexts.

The fixed patterns give the base spans.  Beside them every value that stands
where a credential would (after a credential word and a separator, or as the
password of a URL) is costed by dynamic programming over its segmentations into
words, dates, repeats, keyboard walks, sequences and brute-force spans; a value
that takes too many guesses to find is a secret and adds a ``guess`` span.
A word's cost is its rank in a list of common passwords followed by the whole
words of a tokenizer vocabulary in its own order, which is by frequency.

Values are costed whole, however long.  Costs are exact below ``CEILING`` (far
above the limit of a secret) and reported as ``CEILING`` from there on; as every
segment costs something, states beyond it are given up, so the work depends on
what can still be cheap and not on the square of the length.

Defined cases: a null text counts as empty; an empty text has no spans; texts
are scanned whole whatever their length; repeated rows are answered separately;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import trim

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that announce a credential, and what may stand between them and the value.
_WORD = r"(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|credentials?|token|bearer|(?:api|auth|access|private)[_ -]?key|login)"
_CONTEXT = re.compile(
    rf"""(?ai){_WORD}"""
    r"""["']?(?:\x20*(?P<mark>:=|=>|->|[:=])\x20*|\x20+is\x20+|\x20+)(?P<quote>["'`]?)(?=[^\s"'`,;<>]{6})"""
)
_VALUE = re.compile(r"""[^\s"'`,;<>]+""")
#: A credential word at the end of a value, and a mark after it, which makes the value a name of the next one.
_LAST_WORD = re.compile(rf"(?ai){_WORD}\Z")
_MARK = re.compile(r"""[.)\]}!?]*["'`]?\x20*(?:=>|->|[:=])""")
_PADDED = re.compile(r"(?P<body>[A-Za-z0-9+/_-]+)={1,2}")
_URL = re.compile(r"(?a)://[^\s/:@]++:(?P<value>[^\s/@]{6,}+)@")
_CONTEXT_WORDS = ("pass", "pwd", "secret", "credential", "token", "bearer", "key", "login")
#: Guesses, as a power of ten, from which a value is a secret; a value without a mark or quotes must also mix character kinds.
STRONG = 6.0
#: Guesses, as a power of ten, that are told apart no more.
CEILING = 20.0

#: Words common in passwords, most common first.
WORDS = (
    "password 123456 qwerty letmein monkey dragon iloveyou admin welcome login master sunshine princess football shadow "
    "michael jordan superman batman trustno1 hello freedom whatever secret pass test guest root user change changeme "
    "default summer winter spring autumn love money hunter ranger george charlie thomas killer pepper daniel access "
    "flower ginger computer internet server example sample none null true false your here value token key string"
).split()
#: Rows of a common keyboard, for walks.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (r, k) for r, row in enumerate(KEYBOARD) for k, c in enumerate(row)}
_LEET = str.maketrans("430157$@", "aeoistsa")
_DATE = re.compile(r"(?:(?:19|20)\d\d)(?:[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")
#: Guesses that find a keyboard walk's first key and step.
_WALK = math.log10(47 * 4)


class Words:
    """Ranks of known words: the fixed list, then those of a vocabulary file that stand for a whole word of three letters or more."""

    def __init__(self, vocabulary: str | None = None):
        words = list(WORDS)
        if vocabulary:
            with open(vocabulary, encoding="utf-8") as file:
                model = json.load(file)["model"]
            end = model.get("end_of_word_suffix") or ""
            whole = sorted((n, w.removesuffix(end)) for w, n in model["vocab"].items() if end and w.endswith(end))
            words += [w for _, w in whole if len(w) >= 3 and w.isalpha()]
        self.rank: dict[str, int] = {}
        for k, w in enumerate(words):
            self.rank.setdefault(w, k + 1)
        self.longest = max(map(len, self.rank))
        self.known: dict[str, float] = {}


@lru_cache(maxsize=4)
def words(vocabulary: str | None = None) -> Words:
    return Words(vocabulary)


def _walks(low: str) -> list[int]:
    """How far a keyboard walk (neighbouring keys) goes on from each place."""
    out = [0] * len(low)
    for k in range(len(low) - 2, -1, -1):
        a, b = _PLACE.get(low[k]), _PLACE.get(low[k + 1])
        if a and b and a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1:
            out[k] = out[k + 1] + 1
    return out


def _sequences(value: str) -> list[int]:
    """How far a run of equal steps of one code point goes on from each place."""
    out = [0] * len(value)
    for k in range(len(value) - 2, -1, -1):
        step = ord(value[k + 1]) - ord(value[k])
        if abs(step) == 1:
            same = k + 2 < len(value) and ord(value[k + 2]) - ord(value[k + 1]) == step
            out[k] = out[k + 1] + 1 if same else 1
    return out


class _Segments:
    """The segments of one value other than brute force, worked out where they are asked for.

    A walk or sequence ends where its run does or where a word or date begins in
    it; a repeat takes all whole copies of its unit, whose cost is that of the
    unit itself.
    """

    def __init__(self, value: str, known: Words):
        self.value, self.low, self.known = value, value.lower(), known
        self.low = self.low if len(self.low) == len(value) else value
        self.plain = self.low.translate(_LEET)
        self.walks, self.sequences = _walks(self.low), _sequences(value)
        self.repeats: dict[int, list[tuple[int, float]]] = {}
        self.fixed: dict[int, list[tuple[int, float]]] = {}

    def _fixed(self, i: int) -> list[tuple[int, float]]:
        """Words and dates from place ``i``."""
        if i in self.fixed:
            return self.fixed[i]
        found, value, low = [], self.value, self.low
        for j in range(i + 3, min(len(value), i + self.known.longest) + 1):
            rank = self.known.rank.get(low[i:j])
            leet = rank is None
            rank = rank or self.known.rank.get(self.plain[i:j])
            if rank:
                cased = value[i:j] != low[i:j]
                found.append((j, math.log10(rank * (2 if cased else 1) * (4 if leet else 1) + 1)))
        if m := _DATE.match(value, i):
            found.append((m.end(), math.log10(365 * 100) if m.end() - i > 4 else 2.0))
        self.fixed[i] = found
        return found

    def _runs(self, i: int, most: int, longest: float) -> Iterator[int]:
        """Lengths, up to ``longest``, of a run from ``i`` that goes on for ``most`` steps: all of it, or up to a word or date in it."""
        for w in range(3, int(min(most, longest)) + 1):
            if self._fixed(i + w):
                yield w
        if 3 <= most + 1 <= longest:
            yield most + 1

    def _units(self, i: int) -> Iterator[int]:
        """Lengths of the units that repeat from ``i``, shortest first, but for those that repeat a shorter one."""
        value, most = self.value, (len(self.value) - i) // 2
        unit = 1
        while unit <= most:
            if unit > 8:  # from here on its first code points are searched for
                at = value.find(value[i : i + 8], i + unit)
                unit = at - i
                if at < 0 or unit > most:
                    return
            if value.startswith(value[i : i + unit], i + unit):
                yield unit
                # two periods that overlap by the sum of their lengths have a common part, so the next unit is no shorter than this
                unit = max(unit, _overlap(value, i, unit) - unit)
            unit += 1

    def _repeats(self, i: int) -> list[tuple[int, float]]:
        if i not in self.repeats:
            found = []
            for unit in self._units(i):
                copies = _overlap(self.value, i, unit) // unit
                if copies * unit >= 3:
                    found.append((i + copies * unit, min(float(unit), guesses(self.value[i : i + unit], self.known)) + math.log10(copies)))
            self.repeats[i] = found
        return self.repeats[i]

    def at(self, i: int, room: float = math.inf) -> list[tuple[int, float]]:
        """(end, cost) of the segments from place ``i``; of runs only those that cost at most ``room``."""
        room = min(room, 300.0)
        found = self._fixed(i) + [(i + w, _WALK + 2 * math.log10(w)) for w in self._runs(i, self.walks[i], 10 ** ((room - _WALK) / 2))]
        return found + [(i + w, math.log10(26 * w)) for w in self._runs(i, self.sequences[i], 10**room / 26)] + self._repeats(i)


def _overlap(value: str, i: int, unit: int) -> int:
    """Length of the longest stretch from ``i`` with period ``unit`` that is whole units, by doubling and halving steps."""
    done, step = unit, unit
    while value.startswith(value[i : i + step], i + done):
        done, step = done + step, 2 * step
    while step > unit:
        step = step // 2
        if value.startswith(value[i : i + step], i + done):
            done += step
    return done


def guesses(value: str, known: Words | None = None) -> float:
    """log10 of the guesses that find ``value``: the least over its segmentations of k! times the product of segment costs, up to ``CEILING``."""
    known = known or words()
    if value in known.known:
        return known.known[value]
    n, segments = len(value), _Segments(value, known)
    # row[i]: least sum of the first i code points in k segments; a brute-force span costs a digit's worth a code point
    row, answer, k = {0: 0.0}, min(float(n), CEILING), 0
    while row:
        k += 1
        order = math.lgamma(k + 1) / math.log(10)
        more: dict[int, float] = {}
        for i, cost in row.items():
            room = answer - cost - order
            if i == n or room <= 0:
                continue
            spans = segments.at(i, room) + [(j, float(j - i)) for j in range(i + 1, min(n, i + int(room) + 1) + 1)]
            for j, extra in spans:
                if cost + extra + order < answer and cost + extra < more.get(j, math.inf):
                    more[j] = cost + extra
        if n in more:
            answer = min(answer, more[n] + order)
        row = more
    if len(known.known) >= 4096:
        known.known.clear()
    known.known[value] = answer
    return answer


def _bare_end(text: str, start: int, bare: int, end: int) -> int:
    """Where a value ends that is followed by closing punctuation and separators from ``bare``; base64 keeps its padding."""
    m = _PADDED.match(text, start, end)
    if m and m.end("body") == bare and (m.end() - start) % 4 == 0 and re.search(r"[A-Z0-9]", m["body"]):
        return m.end()
    return max(start, bare)


def _is_secret(text: str, start: int, end: int, certain: bool, known: Words) -> bool:
    """Whether a value takes many guesses and is not the credential word of a context of its own; one that is not ``certain`` must mix kinds."""
    if end - start < 6:
        return False
    word = _LAST_WORD.search(text, max(start, end - 16), end)
    if word and (word.start() == start or _MARK.match(text, end)):
        return False
    value = text[start:end]
    if guesses(value, known) < STRONG:
        return False
    mixed = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w]")) >= 2 and bool(re.search(r"[0-9]|[^\w.-]", value))
    return mixed or certain


def _credentials(text: str, known: Words) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(w in low for w in _CONTEXT_WORDS):
        done = end = tail = 0
        # a match ends where its value begins: what is no secret may itself begin or hold the context of one
        for m in _CONTEXT.finditer(text):
            start = m.end()
            if start < done:
                continue
            if start >= end:
                end = tail = _VALUE.match(text, start).end()
                while tail > start and text[tail - 1] in ".)]}!?:=":
                    tail -= 1
            bare = _bare_end(text, start, tail, end)
            if _is_secret(text, start, bare, bool(m["quote"] and m["mark"]), known):
                yield start, bare
                done = end
    if "://" in text:
        for m in _URL.finditer(text):
            if guesses(m["value"], known) >= STRONG:
                yield m.span("value")


def scan(text: str | None, known: Words | None = None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed; ends are exclusive, code points."""
    text = text or ""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found += [(s, 3, e) for s, e in set(_credentials(text, known or words()))]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row a document: its key and ``spans``, an array of kind, start, end and the value's log10 guesses.

    ``vocabulary`` is the path of a tokenizer file whose words count as known, the same on all machines.
    """
    source = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = source.schema[key].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(vocabulary)
        for batch in batches:
            out = []
            for cell in batch.column(1):
                text = cell.as_py() or ""
                out.append([{"kind": k, "start": s, "end": e, "guesses": guesses(text[s:e], known) if k == "guess" else None} for k, s, e in scan(text, known)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, span_type)], names=[key, "spans"])

    return source.mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,guesses:double>>")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by ``mark``, overlapping spans together; a null text stays null."""
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def clean(value: str | None, known: Words) -> str | None:
        if not value:
            return value
        out, done = [], 0
        for _, start, end in sorted(scan(value, known), key=lambda x: (x[1], x[2])):
            if start >= done:
                out += [value[done:start], mark]
            done = max(done, end)
        return "".join([*out, value[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(vocabulary)
        for batch in batches:
            yield batch.set_column(at, text, pa.array([clean(x.as_py(), known) for x in batch.column(at)], pa.string()))
            trim()

    return docs.mapInArrow(run, schema)
