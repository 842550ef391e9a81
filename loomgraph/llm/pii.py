"""Personal data by weak supervision, in DataFrame functions only.

Fixed patterns give the base spans, which always stay.  Looser patterns give
further candidates.  On every candidate five labelers (format, checks, gazetteer,
context, borders) vote for, against or not at all.  The corpus is reduced to
counts of vote patterns, a table whose size does not depend on the corpus;
expectation-maximisation on it estimates how reliable each labeler is, and the
resulting probabilities train a logistic classifier of spans, which decides on
the candidates as a plain column expression.

Positions come from marking matches with a character that no pattern can hold
(any such character in the text is first replaced by another one, so that
nothing shifts); patterns are written so that long runs cost linear time, and so
is all that follows a match: a megabyte of numbers takes seconds.

Defined cases: a null text counts as empty and has no spans; texts of any
length are scanned whole; repeated rows are answered separately (and count
separately in the estimates); an empty table gives an empty result; without
candidates the classifier accepts none; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise

BASE = ("email", "ip", "card", "phone")
EXTRA = ("ssn", "iban", "local_phone", "name")
KINDS = BASE + EXTRA
_LOCAL = "A-Za-z0-9._%+-"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TITLE = "(?:Mrs?|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?)"
_CAPITAL = "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+"
#: Pattern of each kind, and a cheap test that every text with a match passes.
PATTERNS = {
    "email": (rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@")),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+")),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]")),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])", lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}")),
    "local_phone": (r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])", lambda t: t.rlike(r"[0-9]{3}[.-][0-9]{4}")),
    "name": (rf"(?<![A-Za-z]){_TITLE}\.?\x20{_CAPITAL}(?:\x20{_CAPITAL})?", lambda t: t.rlike(rf"{_TITLE}\.?\x20[A-ZÀ-Þ]")),
}
#: Given names, and words that speak for or against personal data beside a span.
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Maria Ana Jose Juan Carlos Luis "
    "Hans Peter Anna Karl Heinz Ursula Pierre Jean Marie Claude Sophie Luc Camille Antonio Carmen Wolfgang Sabine"
).split()
FOR_WORDS = "(?i)(?:ssn|social security|iban|account|konto|call|tel|phone|mobile|fax|contact|reach|name is|named|signed|patient|born|address|mail)"
AGAINST_WORDS = "(?i)(?:version|order|invoice|isbn|serial|part no|item|ticket|figure|table|page|street|avenue|the late)"
#: Code points around a span that the labelers see.
BEFORE, AFTER = 32, 8
#: Numbers that a running sum folds at a time.
SUMS = 512
LABELERS = ("v_format", "v_check", "v_list", "v_context", "v_border")
_MARK, _OTHER = "\ue000", "\ufffd"
_SPAN = "array<struct<start:bigint,kind:int,end:bigint,v_format:int,v_check:int,v_list:int,v_context:int,v_border:int,size:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 1 to 19 digits passes the Luhn check."""
    at = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
    worth = lambda i: F.when(i % 2 == 0, at(i)).otherwise(F.when(at(i) > 4, 2 * at(i) - 9).otherwise(2 * at(i)))
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), worth), F.lit(0), lambda a, x: a + x)
    return (F.length(digits) > 0) & (total % 10 == 0)


def _by_kind(kind: Column, cases: dict[str, Column], otherwise: Column) -> Column:
    """The case of the kind whose number ``kind`` is."""
    out = otherwise
    for name, value in cases.items():
        out = F.when(kind == KINDS.index(name), value).otherwise(out)
    return out


def _passes(kind: Column, x: Column) -> Column:
    n = F.length(_digits(x))
    cases = {
        "ip": x.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": F.when(n.between(14, 19), luhn(_digits(x))).otherwise(F.lit(False)),
        "phone": n.between(10, 15),
    }
    return _by_kind(kind, cases, F.lit(True))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _votes(kind: Column, x: Column, before: Column, after: Column) -> list[Column]:
    """The five labelers' votes on a candidate and the text around it."""
    digits, no, yes = _digits(x), F.lit(False), F.lit(True)
    given = rf"\b(?:{'|'.join(GIVEN_NAMES)})\b"
    form = {
        "ssn": _vote(yes, digits.rlike("^(?:000|666|9)")), "iban": _vote(F.length(F.replace(x, F.lit(" "), F.lit(""))) >= 15, x.rlike("[A-Z]{9}")),
        "local_phone": _vote(x.rlike(r"^\(?[2-9]"), x.rlike(r"^\(?[01]")), "name": _vote(x.rlike(rf"\x20{_CAPITAL}\x20{_CAPITAL}$"), no),
    }
    check = {
        "card": F.lit(1), "ip": _vote(x.rlike("^(?:[1-9]|1[0-9]|2[0-4])"), x.rlike("^0")), "ssn": _vote(no, digits.rlike("(?:^...00|0000$)")),
        "local_phone": _vote(no, digits.rlike("(?:^...[01]|(.)\\1{6})")), "email": _vote(x.rlike(r"\.[A-Za-z]{2,12}$"), x.rlike(r"\.[0-9]+$")),
    }
    listed = {"name": _vote(x.rlike(given), x.rlike("(?:The|This|That|And|Der|Die|Das|Les|Una)$")), "email": _vote(x.rlike(r"(?i)\.(?:com|org|net|edu|de|fr|es|info)$"), no)}
    border = _vote(before.rlike(r"(?:^|[\s:;,(\"'])$") & after.rlike(r"^(?:$|[\s.,;:)\"'!?|])"), before.rlike(r"[A-Za-z0-9_#/=]$") | after.rlike(r"^[A-Za-z0-9_#/=@]"))
    return [_by_kind(kind, form, F.lit(1)), _by_kind(kind, check, F.lit(0)), _by_kind(kind, listed, F.lit(0)), _vote(before.rlike(FOR_WORDS), before.rlike(AGAINST_WORDS)), border]


def running_sums(sizes: Column) -> Column:
    """For each of an array's numbers the sum of those before it.

    A fold that appends copies its array, so the fold runs inside blocks of
    bounded length, and once over the blocks' sums.
    """
    appended = lambda values, first: F.aggregate(
        values, F.struct(first.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("held")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["held"], a["at"]).alias("held")),
    )["held"]
    cut = lambda held: F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(held) - 1) / SUMS), F.lit(0)).cast("int")), lambda b: F.slice(held, b * SUMS + 1, F.lit(SUMS))
    )
    totals = lambda blocks: F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
    within = lambda blocks: _let(appended(totals(blocks), F.lit(0)), lambda first: F.flatten(F.transform(blocks, lambda b, k: appended(b, F.get(first, k)))))
    return _let(sizes, lambda held: _let(cut(held), within))


def _placed(kind: Column, p: Column) -> Column:
    """The spans of one kind from a text cut at its matches: odd pieces are matches.

    What stands around a match is taken from the ends of the pieces beside it, of
    which every second one is at least one character, so long texts cost no more
    a match than short ones.
    """
    odd = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i % 2 == 1) & _passes(kind, F.get(p, i)))

    def judged(x: Column) -> Column:
        votes = [v.cast("int").alias(n) for v, n in zip(_votes(kind, x["match"], x["before"], x["after"]), LABELERS, strict=True)]
        size = F.least(F.floor(F.length(x["match"]) / 8), F.lit(3)).cast("int").alias("size")
        return F.struct(x["begin"].alias("start"), kind.alias("kind"), (x["begin"] + F.length(x["match"])).alias("end"), *votes, size)

    def span(i: Column, x: Column) -> Column:
        first = F.greatest(i - 2 * BEFORE, F.lit(0))
        before = F.right(F.array_join(F.slice(x["tails"], first + 1, i - first), ""), F.lit(BEFORE))
        after = F.left(F.array_join(F.slice(x["heads"], i + 2, F.lit(2 * AFTER)), ""), F.lit(AFTER))
        return _let(F.struct(F.get(p, i).alias("match"), F.get(x["starts"], i).alias("begin"), before.alias("before"), after.alias("after")), judged)

    ends = lambda name, cut, n: F.transform(p, lambda x: cut(x, F.lit(n))).alias(name)
    around = F.struct(running_sums(F.transform(p, lambda x: F.length(x))).alias("starts"), ends("tails", F.right, BEFORE), ends("heads", F.left, AFTER))
    return _let(around, lambda x: F.transform(odd, lambda i: span(i, x)))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's key and candidate spans with votes, by start, then kind."""
    own = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    safe = F.replace(F.col("_text"), F.lit(_MARK), F.lit(_OTHER))
    nothing = F.array().cast("array<string>")
    cut = [F.when(test(F.col("_text")), F.split(F.regexp_replace(safe, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)).otherwise(nothing) for pattern, test in PATTERNS.values()]
    by_kind = F.transform(F.array(*cut), lambda p, kind: F.when(F.size(p) > 1, _placed(kind, p)).otherwise(F.array().cast(_SPAN)).cast(_SPAN))
    return own.select("_key", F.sort_array(F.flatten(by_kind)).alias("spans"))


@dataclass
class Classifier:
    """Labeler reliabilities (chance of each vote given truth) and the weights of the span classifier."""

    reliability: dict[str, dict[tuple[int, int], float]]
    weights: dict[str, float]

    def score(self, x: Column) -> Column:
        z = F.lit(self.weights.get("bias", -1.0))
        for name in LABELERS:
            for v in (-1, 1):
                z = z + F.when(x[name] == v, self.weights.get(f"{name}:{v}", 0.0)).otherwise(0.0)
        for k in range(len(KINDS)):
            z = z + F.when(x["kind"] == k, self.weights.get(f"kind:{k}", 0.0)).otherwise(0.0)
        for s in range(4):
            z = z + F.when(x["size"] == s, self.weights.get(f"size:{s}", 0.0)).otherwise(0.0)
        return z


def learn(patterns: list[tuple[dict[str, int], int]], rounds: int = 40) -> Classifier:
    """Expectation-maximisation over counted vote patterns, then a logistic fit to its probabilities."""
    rows = [(p, n) for p, n in patterns if n]
    truth = [1 / (1 + math.exp(-1.5 * sum(p[v] for v in LABELERS))) for p, _ in rows]
    reliability: dict[str, dict[tuple[int, int], float]] = {}
    for _ in range(rounds if rows else 0):
        prior: dict[int, float] = {}
        for k in range(len(KINDS)):
            own = [(t, n) for (p, n), t in zip(rows, truth, strict=True) if p["kind"] == k]
            prior[k] = (1 + sum(t * n for t, n in own)) / (2 + sum(n for _, n in own))
        for name in LABELERS:
            sums = {(v, y): 0.5 + (0.5 if v == (1 if y else -1) else 0) for v in (-1, 0, 1) for y in (0, 1)}
            for (p, n), t in zip(rows, truth, strict=True):
                sums[p[name], 1] += n * t
                sums[p[name], 0] += n * (1 - t)
            total = {y: sum(sums[v, y] for v in (-1, 0, 1)) for y in (0, 1)}
            reliability[name] = {(v, y): s / total[y] for (v, y), s in sums.items()}
        for i, (p, _) in enumerate(rows):
            z = math.log(prior[p["kind"]] / (1 - prior[p["kind"]])) + sum(math.log(reliability[v][p[v], 1] / reliability[v][p[v], 0]) for v in LABELERS)
            truth[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    # weighted logistic regression by gradient steps on the same bounded table
    weights: dict[str, float] = {}
    active = [["bias", f"kind:{p['kind']}", f"size:{p['size']}", *(f"{v}:{p[v]}" for v in LABELERS if p[v])] for p, _ in rows]
    total = sum(n for _, n in rows)
    for _ in range(300):
        grad: dict[str, float] = {}
        for names, (_, n), t in zip(active, rows, truth, strict=True):
            z = sum(weights.get(x, 0.0) for x in names)
            g = n * (t - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) / total
            for x in names:
                grad[x] = grad.get(x, 0.0) + g
        for x, g in grad.items():
            weights[x] = weights.get(x, 0.0) * 0.999 + 2.0 * g
    return Classifier(reliability, weights)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Classifier]:
    """Each document's key and ``spans`` (kind, start, end, score), by start, then kind; and the classifier."""
    table = materialise(candidates(docs, key, text), "candidates")
    fields = ["kind", "size", *LABELERS]
    counted = table.select(F.explode("spans").alias("x")).select(*(F.col(f"x.{f}").alias(f) for f in fields)).groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))
    model = learn([({f: r[f] for f in fields}, r["n"]) for r in sorted(counted.collect())])
    stays = lambda x: (x["kind"] < len(BASE)) | (model.score(x) > 0)
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    spans = F.transform(F.filter("spans", stays), lambda x: F.struct(name(x).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), model.score(x).alias("score")))
    return table.select(F.col("_key").alias(key), spans.alias("spans")), model
