"""Column functions over tagged markdown text.

Patterns use ``(?U)`` so that white space and letters are those of Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols of math commands.
MATH_SYMBOLS = {
    "times": "×", "cdot": "·", "pm": "±", "leq": "≤", "geq": "≥", "approx": "≈", "rightarrow": "→", "leftarrow": "←",
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "mu": "μ", "circ": "°",
}


def normalise_inline(text: Column) -> Column:
    """Drops super- and subscript tags and turns figure and table references into anchors behind their text."""
    text = F.regexp_replace(text, r"(?i)</?su[pb]\s*>", "")
    for tag, mark in (("figref", "FIG"), ("tblref", "TBL")):
        text = F.regexp_replace(text, rf"(?is)<{tag}\s+id\s*=\s*[\"']?([^\"'>\s]+)[\"']?\s*>(.*?)</{tag}\s*>", rf"$2[[{mark}:$1]]")
    return text


def slug(text: Column, longest: int = 48) -> Column:
    cut = F.substring(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-")), 1, longest)
    return F.rtrim(cut, F.lit("-"))


def duplicate_key(text: Column) -> Column:
    """Text with white space collapsed, lower case: equal for copies."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def parse_source_line(text: Column) -> Column:
    """``key: value | key: value`` as a map; the first colon splits and a later key wins."""
    pairs = F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit(":")))
    entry = lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("key"), F.trim(F.regexp_replace(x, r"(?s)^[^:]*:", "")).alias("value"))
    entries = F.transform(pairs, entry)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def anchors(text: Column, mark: str) -> Column:
    """The distinct ids of a kind of anchor, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"\[\[{mark}:([^\]]+)\]\]"), 1)))


def lift_anchors(text: Column) -> Column:
    """Text without anchors; blanks on both sides of one become a single blank."""
    text = F.regexp_replace(text, r"(?U)[ \t]+(?:\[\[(?:FIG|TBL):[^\]]+\]\])+[ \t]+", " ")
    return F.regexp_replace(text, r"\[\[(?:FIG|TBL):[^\]]+\]\]", "")


def drop_formula_sentences(text: Column) -> Column:
    """Each line without its sentences that hold a ``$...$`` span."""
    sentences = lambda line: F.filter(F.split(line, r"(?U)(?<=[.!?])\s+(?=[^\s\d])"), lambda s: ~s.rlike(r"\$[^$]+\$"))
    return F.array_join(F.transform(F.split(text, "\n", -1), lambda line: F.array_join(sentences(line), " ")), "\n")


def flatten_math(text: Column) -> Column:
    """``$...$`` spans as plain characters: commands become symbols, braces and markers go, blanks close up."""

    def plain(x: Column) -> Column:
        for name, symbol in MATH_SYMBOLS.items():
            x = F.regexp_replace(x, rf"\\{name}(?![A-Za-z])", symbol)
        x = F.regexp_replace(x, r"\\[A-Za-z]+", "")
        return F.regexp_replace(x, r"[{}_^\\\s]+", "")

    pieces = F.split(text, r"\$", -1)
    last = F.size(pieces) - 1
    # a dollar sign without partner stays
    flat = F.transform(pieces, lambda p, i: F.when((i % 2 == 1) & (i < last), plain(p)).when((i % 2 == 1) & (i == last), F.concat(F.lit("$"), p)).otherwise(p))
    return F.array_join(flat, "")


def strip_emphasis(text: Column, rounds: int = 3) -> Column:
    """Text without emphasis marks, nested ones up to ``rounds`` deep."""
    for _ in range(rounds):
        text = F.regexp_replace(text, r"(\*\*|__|\*|_)(?=\S)([^*_\n]*\S)\1", "$2")
    return F.replace(text, F.lit("*"), F.lit(""))


def clean_text(text: Column) -> Column:
    """Each line without heading marks, one bullet and emphasis, blanks collapsed; empty lines go."""

    def line(x: Column) -> Column:
        x = F.regexp_replace(F.trim(x), r"^#{1,6}\s+", "")
        x = F.regexp_replace(x, r"^(?:[-*+•]|\d+[.)])\s+", "")
        return F.trim(F.regexp_replace(strip_emphasis(x), r"(?U)[ \t]+", " "))

    return F.array_join(F.filter(F.transform(F.split(text, "\n", -1), line), lambda x: x != ""), "\n")


def split_items(text: Column) -> Column:
    """Bullet lines of a text, cleaned; without any the text as one item."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.trim(x))
    bullet = r"^(?:[-*+•]|\d+[.)])\s+"
    items = F.transform(F.filter(lines, lambda x: x.rlike(bullet)), lambda x: F.regexp_replace(x, bullet, ""))
    return F.when(F.size(items) > 0, items).otherwise(F.filter(F.array(F.trim(text)), lambda x: x != ""))


def marker_counts(text: Column, markers: dict[str, str]) -> Column:
    """For each marker pattern its number of matches and the first line with one (120 characters at most)."""
    lines = F.split(text, "\n", -1)

    def row(name: str, pattern: str) -> Column:
        first = F.get(F.filter(lines, lambda x: x.rlike(pattern)), F.lit(0))
        return F.struct(F.lit(name).alias("marker"), F.regexp_count(text, F.lit(pattern)).alias("n"), F.substring(F.trim(first), 1, 120).alias("example"))

    rows = [row(k, p) for k, p in markers.items()]
    return F.filter(F.array(*rows), lambda x: x["n"] > 0)


def looks_structured(text: Column) -> Column:
    """A heading-like line, or a text that is mostly bullets or lines without a full stop."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    ended = lambda x: x.rlike(r"[.!?]$")
    n, full = F.size(lines), F.size(F.filter(lines, ended))
    bullets = F.size(F.filter(lines, lambda x: x.rlike(r"^(?:[-*+•]|\d+[.)])\s")))
    short = ~ended(F.get(lines, F.lit(0))) & (F.size(F.split(F.get(lines, F.lit(0)), r"(?U)\s+")) <= 8)
    return F.when(n == 0, F.lit(False)).when(n == 1, short).otherwise((bullets >= 0.4 * n) | (full < 0.5 * n))
