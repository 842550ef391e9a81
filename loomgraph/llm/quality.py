"""Quality rules with cross-document line frequency, in DataFrame functions only.

Each text gives its counts and the hashes of its normalised lines in one pass;
everything across documents then runs on that small table.  A line that more
than a limit of one host's documents hold is boilerplate: its words do not
count, and a document left with too small a share of its words is rejected.

Line counts are combined before they are shuffled and their key is host and
line, so neither a host with a third of all documents nor a line in all of them
falls to one task; the join back is one that the adaptive planner can split.
Lines are known by two independent 64-bit hashes, so two different ones among n
pass as one with a chance of about n * n / 2**129.  What is counted inside one
text (repeated lines and three-word windows) is compared by its words.

Defined cases: a null text counts as empty and fails the base rules; a null host
is a host of its own; texts of any length are counted whole, in one way; repeated
rows each count as a document; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise

SPACES = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A line that more documents of one host hold is removed; a document that keeps less of its words is rejected.
MOST_DOCUMENTS = 20
LEAST_KEPT = 0.5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in ``words``.

    A window's hash takes the bits of a long that its place leaves free; windows
    that share one are candidates, and these are compared by their three words.
    """

    def covered(places: Column) -> Column:
        sizes = lambda p: F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        total = lambda p: F.aggregate(sizes(p), F.lit(0).cast("long"), lambda a, x: a + x)
        return F.when(F.size(places) == 0, F.lit(0).cast("long")).otherwise(_let(F.sort_array(places), total))

    def equal(w: Column, places: Column) -> Column:
        """Those of ``places`` whose windows hold the same words as another's."""
        word = lambda i, k: F.get(w, (i + k).cast("int"))
        named = F.sort_array(F.transform(places, lambda i: F.struct(word(i, 0).alias("a"), word(i, 1).alias("b"), word(i, 2).alias("c"), i.alias("i"))))
        same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        twice = lambda k: F.filter(k, lambda x, i: same(x, F.get(k, i + 1)) | same(x, F.get(k, i - 1)))
        return F.transform(_let(named, twice), lambda x: x["i"])

    def counted(w: Column, bits: Column) -> Column:
        hashed = lambda x, i: F.call_function("shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long"))
        keys = F.sort_array(F.slice(F.transform(w, hashed), 1, F.size(w) - 2))
        key = lambda x: F.call_function("shiftright", x, bits)
        twice = lambda k: F.filter(k, lambda x, i: (key(x) == key(F.get(k, i + 1))) | (key(x) == key(F.get(k, i - 1))))
        places = lambda k: F.transform(twice(k), lambda x: x - F.call_function("shiftleft", key(x), bits))
        return _let(keys, lambda k: covered(_let(places(k), lambda p: equal(w, p))))

    bits = F.length(F.bin(F.size(words).cast("long"))).cast("int")
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(bits, lambda b: counted(words, b)))


def normalise_line(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), "[0-9]+", "0")


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Counts of each text and ``lines``: two hashes and words of each line that has a word."""
    own = docs.select(F.col(key).alias("_key"), F.col(host).cast("string").alias("_host"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    bare = F.col("_text")
    for space in SPACES:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        names = lambda n: F.struct(F.xxhash64(n).alias("a"), F.xxhash64(F.lit("line"), n).alias("b"))
        held = F.transform(x, lambda line: F.struct(_let(normalise_line(line), names).alias("line"), F.size(words_of(line)).cast("long").alias("words")))
        return F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), held.alias("lines"))

    out = own.select(
        "_key", "_host", F.length(bare).cast("long").alias("word_chars"), F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(words_of(F.col("_text")), counts).alias("w"), _let(lines, of_lines).alias("l"),
    )
    return out.select("_key", "_host", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.lines")


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", most: int = MOST_DOCUMENTS, least: float = LEAST_KEPT) -> DataFrame:
    """Counts, ``base_failed``, ``n_removed_words`` (in lines above the limit) and ``kept`` of each document."""
    table = materialise(measure(docs, key, text, host).withColumn("_row", F.monotonically_increasing_id()), "measured")
    host_key = F.coalesce("_host", F.lit("\0"))
    held = table.select(host_key.alias("h"), F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    common = held.groupBy("h", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("h", "line")
    spread = table.select("_row", host_key.alias("h"), F.explode("lines").alias("x")).select("_row", "h", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    removed = spread.join(common, ["h", "line"]).groupBy("_row").agg(F.sum("words").alias("n_removed_words"))
    out = table.join(removed, "_row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words") >= least * F.col("n_words")
    return out.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & left).alias("kept"), "n_removed_words",
    )
