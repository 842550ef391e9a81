"""Vocabulary, table schemas and deterministic ids of the knowledge graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public vocabularies; the two local namespaces are this package's own and only need to be consistent.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCT = "http://purl.org/dc/terms/"
PROV = "http://www.w3.org/ns/prov#"
SNOMED = "http://snomed.info/id/"
RXNORM = "http://purl.bioontology.org/ontology/RXNORM/"
UMLS = "http://linkedlifedata.com/resource/umls/id/"
ONT = "http://example.org/loomgraph/ont#"
INST = "http://example.org/loomgraph/inst/"
GRAPH = "urn:graph:"
GROUP = "urn:group:"
PREFIXES = {"rdf": RDF, "rdfs": RDFS, "xsd": XSD, "dct": DCT, "dcterms": DCT, "prov": PROV, "sct": SNOMED, "rx": RXNORM, "umls": UMLS, "ont": ONT, "inst": INST}
TYPE, LABEL = RDF + "type", RDFS + "label"
PROVENANCE, CATALOG, LABELS, INFERRED = (GRAPH + x for x in ("provenance", "catalog", "labels", "inferred"))

QUAD = "s string, p string, o string, o_kind string, o_dt string, o_lang string, g string"
QUAD_COLUMNS = ("s", "p", "o", "o_kind", "o_dt", "o_lang", "g")
TRIPLE_COLUMNS = QUAD_COLUMNS[:-1]
MODIFIERS = "array<struct<type:string,text:string,char_start:int,char_end:int,cui:string,uri:string>>"
SPANS = f"source_id string, span_id string, chunk_id string, seq long, text string, char_start int, char_end int, label string, negated boolean, modifiers {MODIFIERS}, cui string, uri string, link_score double, ner_label string"
RELATIONS = "source_id string, rel_id string, seq long, head string, tail string, type string, polarity string, evidence_start int, evidence_end int, score double"
CHUNKS = "source_id string, chunk_id string, seq long, text string, char_start int, char_end int, section_path array<string>, kind string, figure_refs array<string>, table_refs array<string>, section_id string"
DOCUMENTS = "source_id string, title string, edition string, origin string, generator string, generated_at string"
REVIEW = "source_id string, stage string, code string, reason string, rel_id string, span_id string, extra map<string,string>"

# The kinds of text that extraction reads, and its thresholds.
EXTRACTABLE = ("prose", "definition", "keypoint", "clinical", "summary", "table")
LINK_FLOOR, RELATION_FLOOR, RERANK_MARGIN, CHUNK_CHARS, LINK_K = 0.70, 0.50, 0.05, 1500, 20
SNOMED_VERSION = "2026-03"


def det_id(*parts: Column | str) -> Column:
    """The first 12 hex digits of the SHA-1 of the parts joined by a bar; a null part reads ``None``."""
    columns = [F.coalesce(p.cast("string"), F.lit("None")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *columns)), 1, 12)


def document_graph(source_id: Column) -> Column:
    return F.concat(F.lit(GRAPH), source_id)


def section_graph(source_id: Column, section_id: Column) -> Column:
    """The graph of a section; that of the document where there is no section."""
    missing = section_id.isNull() | (section_id == "")
    return F.when(missing, document_graph(source_id)).otherwise(F.concat(F.lit(GRAPH), source_id, F.lit("/"), section_id))


def local_name(iri: Column) -> Column:
    """What follows the last ``#`` or ``/``."""
    return F.regexp_replace(iri, "^.*[#/]", "")


def concept_of(uri: Column, text: Column) -> Column:
    """The identity of what a span names: its link, or else its text."""
    return F.coalesce(F.nullif(uri, F.lit("")), F.lower(F.trim(text)))


def iri(s: Column, p: Column | str, o: Column | str, g: Column | str) -> list[Column]:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    none = F.lit(None).cast("string")
    return [s.alias("s"), as_column(p).alias("p"), as_column(o).alias("o"), F.lit("iri").alias("o_kind"), none.alias("o_dt"), none.alias("o_lang"), as_column(g).alias("g")]


def literal(s: Column, p: Column | str, value: Column, g: Column | str, datatype: str | None = None) -> list[Column]:
    out = iri(s, p, value.cast("string"), g)
    out[3] = F.lit("lit").alias("o_kind")
    out[4] = F.lit(datatype).cast("string").alias("o_dt")
    return out


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def quads_of(rows: DataFrame, quads: list[list[Column]]) -> DataFrame:
    """Several quads from each row in one pass; those without an object are left out."""
    held = F.array(*(F.struct(*q) for q in quads))
    return rows.select(F.explode(held).alias("q")).select("q.*").where("s IS NOT NULL AND o IS NOT NULL")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
