"""Qualified mentions as instance nodes with deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import INST, ONT, det_id, local_name
from ..ontology import ROLE_CHANGING, Ontology, default, expand

# Words and what they qualify a concept as.
VALUE_NAMES = {
    "severe": "sct:24484000",
    "moderate": "sct:6736007",
    "mild": "sct:255604002",
    "acute": "sct:424124008",
    "substernal": "sct:51185008",
    "left arm": "sct:368208006",
    "deficiency": "ont:Deficiency",
    "deficiencies": "ont:Deficiency",
    "deficient": "ont:Deficiency",
    "insufficient": "ont:Deficiency",
    "insufficiency": "ont:Deficiency",
    "inadequate": "ont:Deficiency",
    "lack of": "ont:Deficiency",
    "depletion": "ont:Deficiency",
    "underproduction": "ont:Deficiency",
    "hyposecretion": "ont:Deficiency",
    "too little": "ont:Deficiency",
    "low": "ont:Deficiency",
    "excess": "ont:Excess",
    "excessive": "ont:Excess",
    "excessively": "ont:Excess",
    "elevated": "ont:Excess",
    "raised": "ont:Excess",
    "overproduction": "ont:Excess",
    "hypersecretion": "ont:Excess",
    "too much": "ont:Excess",
    "high": "ont:Excess",
    "elevation": "ont:Excess",
    "elevations": "ont:Excess",
    "resistance": "ont:Resistance",
    "resistant": "ont:Resistance",
    "unresponsive": "ont:Resistance",
}
VALUES = {words: expand(name) for words, name in VALUE_NAMES.items()}
OPPOSITES = ((ONT + "Deficiency", ONT + "Excess"),)
#: Labels whose spans a deviation can change the role of.
DEVIATES = ("Substance", "Drug", "Protein")
#: The phrases of each value, as one pattern of whole words.
_SAYS = {value: rf"(?iU)\b(?:{'|'.join(k for k, v in VALUES.items() if v == value)})\b" for value in sorted(set(VALUES.values()))}


def lexicon_uri(text: Column) -> Column:
    """The value a qualifier's words name: all of them, or else the longest known phrase in them; null if none."""
    key = F.lower(F.trim(text))
    whole = F.try_element_at(F.create_map(*(F.lit(x) for pair in VALUES.items() for x in pair)), key)
    part = F.lit(None).cast("string")
    for phrase in sorted(VALUES, key=len):  # later conditions wrap earlier ones, so the longest comes first
        part = F.when(key.rlike(rf"(?U)\b{phrase}\b"), VALUES[phrase]).otherwise(part)
    return F.coalesce(whole, part)


def value_uri(modifier: Column) -> Column:
    """The value's IRI: by lexicon, else by its link unless it changes the role, else a placeholder by its text."""
    linked = F.when(~modifier["type"].isin(*ROLE_CHANGING), F.nullif(modifier["uri"], F.lit("")))
    return F.coalesce(lexicon_uri(modifier["text"]), linked, F.concat(F.lit(ONT + "value/"), det_id(F.lower(F.trim(modifier["text"])))))


def is_placeholder(modifier: Column) -> Column:
    return value_uri(modifier).startswith(ONT + "value/")


def _role(m: Column) -> Column:
    return m["type"].isin(*ROLE_CHANGING)


def judge(spans: DataFrame) -> DataFrame:
    """Linked affirmed spans with their modifiers sorted out, by place in the array.

    ``modelled`` become attributes; role-changing ones that the label cannot
    carry, that contradict each other, or whose value the span's text already
    says by one of its phrases as whole words are ``misapplied``,
    ``contradictory`` and ``redundant``.
    """
    rows = spans.where("uri IS NOT NULL AND NOT negated AND size(modifiers) > 0")
    values = F.transform(F.filter("modifiers", _role), lambda m: lexicon_uri(m["text"]))
    clash = F.lit(False)
    for a, b in OPPOSITES:
        clash = clash | (F.array_contains(F.col("_values"), a) & F.array_contains(F.col("_values"), b))
    rows = rows.withColumn("_values", F.filter(values, lambda x: x.isNotNull())).withColumn("_clash", clash)
    fits = F.coalesce(F.col("label").isin(*DEVIATES), F.lit(False))

    phrases = F.create_map(*(F.lit(x) for pair in _SAYS.items() for x in pair))
    said = lambda m: F.coalesce(F.rlike("text", F.try_element_at(phrases, lexicon_uri(m["text"]))), F.lit(False))
    sort = lambda m: F.when(~_role(m), "modelled").when(~fits, "misapplied").when(F.col("_clash"), "contradictory").when(said(m), "redundant").otherwise("modelled")
    return rows.withColumn("sorted", F.transform("modifiers", lambda m: F.struct(sort(m).alias("as"), m.alias("m")))).drop("_values", "_clash")


def compose_label(text: Column, sorted_: Column) -> Column:
    """``text [quality, ...]`` from the role-changing modifiers that count; null without any.  Never a bare number."""
    name = lambda m: F.lower(F.coalesce(local_name(lexicon_uri(m["text"])), F.when(~local_name(m["uri"]).rlike("^[0-9]*$"), local_name(m["uri"])), F.trim(m["text"])))
    names = F.transform(F.filter(sorted_, lambda x: (x["as"] == "modelled") & _role(x["m"])), lambda x: name(x["m"]))
    return F.when(F.size(names) > 0, F.concat(text, F.lit(" ["), F.array_join(names, ", "), F.lit("]")))


def post_coordinate(spans: DataFrame, existing: DataFrame | None = None, ontology: Ontology | None = None) -> tuple[DataFrame, DataFrame]:
    """Instances of qualified spans that have none yet, and review rows of what was not modelled.

    The id depends on document, concept and sorted attributes only, so equal
    mentions share a node; its label stands on the first record alone.
    """
    ontology = ontology or default()
    judged = judge(spans)
    if existing is not None:
        judged = judged.join(existing.select("source_id", F.col("source_span").alias("span_id")), ["source_id", "span_id"], "left_anti")
    known = F.create_map(*(F.lit(x) for pair in ontology.modifiers.items() for x in pair))
    prop = lambda m: F.coalesce(F.try_element_at(known, m["type"]), F.lit(ONT + "hasModifier"))
    modelled = F.filter("sorted", lambda x: x["as"] == "modelled")
    attributes = F.transform(modelled, lambda x: F.struct(prop(x["m"]).alias("prop"), value_uri(x["m"]).alias("value")))
    rows = judged.withColumn("attributes", attributes).where(F.size("attributes") > 0)
    written = F.transform(F.array_sort("attributes"), lambda a: F.concat(F.lit("('"), a["prop"], F.lit("', '"), a["value"], F.lit("')")))
    listed = F.concat(F.lit("["), F.array_join(written, ", "), F.lit("]"))
    rows = rows.withColumn("inst_id", F.concat(F.lit(INST), det_id(F.col("source_id"), F.col("cui"), listed)))
    nth = F.row_number().over(Window.partitionBy("source_id", "inst_id").orderBy("seq"))
    label = F.when(nth == 1, compose_label(F.col("text"), F.col("sorted")))
    instances = rows.select("source_id", "seq", "inst_id", F.col("uri").alias("type_uri"), F.col("span_id").alias("source_span"), "attributes", label.alias("label"))
    reasons = F.explode(F.filter("sorted", lambda x: (x["as"] != "modelled") | is_placeholder(x["m"])))
    review = judged.select("source_id", "span_id", F.col("text").alias("span"), reasons.alias("x"))
    stage = F.when(F.col("x.as") == "misapplied", "postcoord-deviation-type").when(F.col("x.as") == "contradictory", "postcoord-deviation-conflict").when(F.col("x.as") == "redundant", "postcoord-deviation-redundant").otherwise("postcoord")
    return instances, review.select("source_id", "span_id", stage.alias("stage"), "span", F.col("x.m.text").alias("modifier"))


def redirecting(instances: DataFrame, spans: DataFrame) -> DataFrame:
    """Instances that relations attach to: those of spans with a role-changing modifier that counts."""
    own = judge(spans).where(F.exists("sorted", lambda x: (x["as"] == "modelled") & _role(x["m"]))).select("source_id", F.col("span_id").alias("source_span"))
    return instances.join(own, ["source_id", "source_span"], "left_semi")
