"""N-Quads in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import QUAD_COLUMNS

# Terms as the N-Quads grammar has them, with the parts that are columns in groups.
_IRI, _BLANK = r"<([^<>\x22{}|^`\\\x00-\x20]*)>", r"(_:[^\s<>\x22]+)"
_LITERAL = r"\x22([^\x22\n\r]*+)\x22(?:\^\^<([^<>\s]*)>|@([A-Za-z]+(?:-[A-Za-z0-9]+)*))?"
_LINE = rf"^\s*(?:{_IRI}|{_BLANK})\s*<([^<>\s]*)>\s*(?:{_IRI}|{_BLANK}|{_LITERAL})\s*(?:{_IRI}|{_BLANK})?\s*\.\s*(?:#.*)?$"
#: What stands for a written backslash or quote while a line is matched, so that a literal is a run without quotes however long it is.
_MASKS = (("\x02", "\x02m"), ("\\\\", "\x02b"), ('\\"', "\x02q"))
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def escape(text: Column) -> Column:
    for raw, written in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """Escapes resolved from left to right, so that an escaped backslash does not start another."""
    pieces = F.split(F.regexp_replace(text, r"(\\(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.))", "\x01$1\x01"), "\x01", -1)
    known = F.create_map(*(F.lit(x) for raw, written in (*_ESCAPES, ("\b", "\\b"), ("\f", "\\f"), ("'", "\\'")) for x in (written, raw)))

    def one(piece: Column, i: Column) -> Column:
        code = F.conv(F.regexp_extract(piece, r"^\\[uU]([0-9A-Fa-f]+)$", 1), 16, 10).cast("long")
        high = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(i % 2 == 0, piece).when(piece.rlike(r"^\\[uU]"), high).otherwise(F.coalesce(F.try_element_at(known, piece), piece))

    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """Quads of lines of N-Quads; blank and comment lines are skipped, others that do not parse have a null ``p``."""
    line = F.col(column)
    for written, mask in _MASKS:
        line = F.replace(line, F.lit(written), F.lit(mask))
    group = lambda n: F.nullif(F.regexp_extract(line, _LINE, n), F.lit(""))
    text = F.regexp_extract(line, _LINE, 6)
    for written, mask in reversed(_MASKS):
        text = F.replace(text, F.lit(mask), F.lit(written))
    rows = lines.where(~F.col(column).rlike(r"^\s*(?:#.*)?$"))
    is_iri, is_blank = group(4).isNotNull(), group(5).isNotNull()
    return rows.select(
        F.coalesce(group(1), group(2)).alias("s"),
        group(3).alias("p"),
        F.when(is_iri, group(4)).when(is_blank, group(5)).otherwise(unescape(text)).alias("o"),
        F.when(is_iri, "iri").when(is_blank, "bnode").otherwise("lit").alias("o_kind"),
        group(7).alias("o_dt"),
        group(8).alias("o_lang"),
        F.coalesce(group(9), group(10)).alias("g"),
    )


def read(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Quads of N-Quads files.  With ``strict`` a line that does not parse fails the job; otherwise it is left out."""
    quads = parse(spark.read.text(path))
    if strict:
        bad = F.raise_error(F.lit("not an N-Quads line"))
        return quads.withColumn("p", F.when(F.col("p").isNull(), bad.cast("string")).otherwise(F.col("p")))
    return quads.where(F.col("p").isNotNull())


def _term(value: Column) -> Column:
    return F.when(value.startswith("_:"), value).otherwise(F.concat(F.lit("<"), value, F.lit(">")))


def format_lines(quads: DataFrame) -> DataFrame:
    literal = F.concat(
        F.lit('"'), escape(F.col("o")), F.lit('"'),
        F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(F.col("o_dt").isNotNull(), F.concat(F.lit("^^<"), F.col("o_dt"), F.lit(">"))).otherwise(""),
    )
    obj = F.when(F.col("o_kind") == "lit", literal).otherwise(_term(F.col("o")))
    return quads.select(F.concat_ws(" ", _term(F.col("s")), _term(F.col("p")), obj, F.when(F.col("g").isNotNull(), _term(F.col("g"))), F.lit(".")).alias("value"))


def malformed(term: Column) -> Column:
    """An IRI that cannot be written: empty, or with angle brackets or white space."""
    return (term == "") | term.rlike(r"(?U)[<>\s]")


def write(quads: DataFrame, path: str) -> dict[str, int]:
    """Write as N-Quads and read back; fails unless everything written parses again.

    Rows whose subject is not an IRI or blank node cannot be written and are counted.
    """
    distinct = quads.select(*QUAD_COLUMNS).distinct()
    fine = ~malformed(F.col("s"))
    counts = distinct.agg(F.count_if(fine).alias("kept"), F.count_if(~fine).alias("removed")).first()
    format_lines(distinct.where(fine)).write.mode("overwrite").text(path)
    back = read(quads.sparkSession, path, strict=True).count()
    if back != counts["kept"]:
        raise ValueError(f"wrote {counts['kept']} quads and read back {back}")
    return {"written": counts["kept"], "removed_literal_subjects": counts["removed"]}
