"""Language identification by mixture inference over character n-grams.

A document is taken as draws from a mixture of the learned languages.
Expectation-maximisation estimates its proportions from the likelihood of each
character trigram; the set of languages grows one at a time while the gain in
log likelihood is above a penalty, so a single-language text keeps one.

Above 4,096 trigrams the distinct ones are weighed by their counts, below each
counts by itself: the same sums, equal up to rounding.

Defined cases: a null or empty text, or one without a letter, is ``und`` with
score 0; ties go to the language that sorts first; repeated rows are answered
separately; an empty table gives an empty result and a model without languages
answers ``und``; other columns of the input are carried through unread (their
names may clash with nothing but the three result columns, which replace them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import trim

#: Hashed trigram space; the model holds this many floats a language, whatever the corpus.
SPACE = 1 << 16
#: Expected upper bound of labelled training rows a language (a hash of the key picks them).
TRAIN_ROWS = 3000
#: Code points counted at a time, so that scratch space stays bounded on any text.
BLOCK = 1 << 19
SMOOTHING = 0.5
#: Log likelihood that each further language must add: this many times log(1 + trigrams).
PENALTY = 6.0
ROUNDS = 12
UNKNOWN = "und"


def trigram_ids(text: str) -> np.ndarray:
    """Hashed ids of the trigrams of a lower-cased text that hold a letter, non-letters folded to one blank."""
    found = []
    for at in range(0, max(1, len(text)), BLOCK):
        part = " " + text[max(0, at - 1) : at + BLOCK].lower() + " "
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_is_letter(codes), codes, np.uint32(32)).astype(np.uint64)
        if len(codes) < 3:
            continue
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        keep = b != 32
        h = (a * np.uint64(0x9E3779B1) + b) * np.uint64(0x85EBCA77) + c
        h = h * np.uint64(0xD6E8FEB86659FD93)
        found.append((h[keep] >> np.uint64(48)).astype(np.int64))
    return np.concatenate(found) if found else np.empty(0, np.int64)


_LETTERS = np.zeros(0x110000, bool)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS.any():
        _LETTERS[:] = [chr(x).isalpha() for x in range(0x110000)]
    return _LETTERS[codes]


@dataclass(frozen=True)
class LanguageModel:
    """``logs[l, g]``: log probability of hashed trigram ``g`` in ``languages[l]``; languages are sorted."""

    languages: list[str]
    logs: np.ndarray

    def infer(self, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
        """The main language, its proportion, and the proportions of the selected set."""
        ids = trigram_ids(text) if text else np.empty(0, np.int64)
        if not len(ids) or not self.languages:
            return UNKNOWN, 0.0, []
        if len(ids) > 4096:
            counts = np.bincount(ids, minlength=SPACE)
            ids = np.flatnonzero(counts)
            weights = counts[ids].astype(np.float64)
        else:
            weights = np.ones(len(ids))
        logs = self.logs[:, ids]
        top = logs.max(axis=0)
        like = np.exp(logs - top)
        total = weights.sum()
        singles = logs @ weights
        chosen, best, share = [int(np.argmax(singles))], float(singles.max()), np.ones(1)
        while len(chosen) < len(self.languages):
            step = None
            for extra in range(len(self.languages)):
                if extra not in chosen:
                    score, shares = _mixture(like[[*chosen, extra]], top, weights)
                    if step is None or score > step[0]:
                        step = score, shares, extra
            if step[0] - best <= PENALTY * np.log1p(total):
                break
            best, share = step[0], step[1]
            chosen.append(step[2])
        order = sorted(zip(share, chosen, strict=True), key=lambda x: (-x[0], x[1]))
        return self.languages[order[0][1]], float(min(1.0, order[0][0])), [(self.languages[k], float(p)) for p, k in order]


def _mixture(like: np.ndarray, top: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood and proportions of one language set, by expectation-maximisation."""
    share, total = np.full(len(like), 1 / len(like)), weights.sum()
    for _ in range(ROUNDS):
        held = share @ like
        share = share * (like @ (weights / held)) / total
        share /= share.sum()
    return float(np.dot(weights, np.log(share @ like) + top)), share


def fit(docs: DataFrame, text: str, lang: str, key: str, train: Column, rows: int = TRAIN_ROWS) -> LanguageModel:
    """Learn trigram probabilities from labelled rows where ``train`` holds.

    About ``rows`` rows a language are read, picked by a hash of ``key``; only
    counts in a fixed space reach the driver.
    """
    labelled = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)).alias("draw")
    )
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((0, SPACE), np.float32))
    bound = F.lit(0)
    for name, n in sizes.items():
        bound = F.when(F.col("lang") == name, F.lit(int(1_000_000 * min(1.0, rows / n)))).otherwise(bound)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = sums.setdefault(name, np.zeros(SPACE, np.int64))
                held += np.bincount(trigram_ids(t), minlength=SPACE)
        for name, held in sums.items():
            ids = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids)), pa.array(ids), pa.array(held[ids])], names=["lang", "gram", "n"])

    found = labelled.where(F.col("draw") < bound).select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    table = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(sizes)
    counts = np.zeros((len(names), SPACE))
    where = np.array([names.index(x) for x in table.column("lang").to_pylist()], int)
    counts[where, table.column("gram").to_numpy()] = table.column("n").to_numpy()
    counts += SMOOTHING
    return LanguageModel(names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_mix`` (array of language and proportion)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.logs))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_mix")]
    source = docs.select(*kept)
    at = kept.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LanguageModel(*shared.value)
        mix_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            found = [held.infer(t.as_py()) for t in batch.column(at)]
            new = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([[{"lang": k, "share": p} for k, p in x[2]] for x in found], mix_type),
            ]
            trim()
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*kept, "lang_pred", "score", "lang_mix"])

    return source.mapInArrow(answer, f"{schema}, lang_pred string, score double, lang_mix array<struct<lang:string,share:double>>")
