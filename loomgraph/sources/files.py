"""File sources: document discovery, IR JSON, group manifests, and pipe-delimited release files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions.text import slug

_SPAN = "span_id string, chunk_id string, text string, char_start int, char_end int, label string, negated boolean, modifiers " + model.MODIFIERS + ", cui string, uri string, link_score double, ner_label string"
#: One document of the intermediate JSON; unknown fields are dropped and missing ones are null.
IR = f"""doc_id string, source_path string, normalized_path string,
source struct<source_id:string,title:string,edition:string,section:string,page:int,origin:string,generator:string,generated_at:string>,
chunks array<struct<chunk_id:string,text:string,char_start:int,char_end:int,section_path:array<string>,kind:string,figure_refs:array<string>,table_refs:array<string>,section_id:string>>,
passages array<struct<passage_id:string,kind:string,text:string,char_start:int,char_end:int,section_path:array<string>,section_id:string>>,
spans array<struct<{_SPAN.replace(' string', ':string').replace(' int', ':int').replace(' boolean', ':boolean').replace(' double', ':double').replace(' array', ':array').replace(', ', ',')}>>,
relations array<struct<rel_id:string,head:string,tail:string,type:string,polarity:string,evidence_start:int,evidence_end:int,score:double>>,
instances array<struct<inst_id:string,type_uri:string,source_span:string,attributes:array<array<string>>,label:string>>,
figures array<struct<fig_id:string,image_path:string,caption:string,referenced_from:string,marker:string,description:string,label:string,panel:string,content_chunk:string,caption_span:array<int>,description_span:array<int>,section_id:string,depicts:array<struct<text:string,cui:string,uri:string,score:double,source_span:array<int>>>>>,
tables array<struct<table_id:string,label:string,caption:string,referenced_from:string,content_chunk:string,caption_span:array<int>,section_id:string>>,
needs_review array<map<string,string>>"""
# Columns of the release files that are used, by position.
CONCEPT_COLUMNS = {"cui": 0, "lat": 1, "sab": 11, "code": 13, "string": 14, "suppress": 16}
SUPPRESSED = ("O", "E", "Y")


def discover(spark: SparkSession, paths: list[str], extensions: tuple[str, ...] = (".md", ".markdown")) -> DataFrame:
    """``path`` and ``text`` of the documents in files or directories (not below them), in order of path.

    Hidden and already normalised files are left out; a file named twice counts once.
    """
    # only names that can be wanted are opened
    pattern = "*{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in x) for x in extensions) + "}"
    whole = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("text"))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    wanted = F.lit(False)
    for x in extensions:
        wanted = wanted | name.endswith(x)
    return whole.where(wanted & ~name.startswith(".") & ~name.endswith(".normalized.md")).dropDuplicates(["path"]).orderBy("path")


def read_ir(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """IR documents: files of one object each, or with ``lines`` files of one object a line, as ``write_ir`` makes them."""
    return spark.read.schema(IR).option("multiLine", not lines).json(path)


def ir_tables(ir: DataFrame) -> dict[str, DataFrame]:
    """The tables of IR documents, each keyed by source and in document order (``seq``)."""
    ir = ir.withColumn("source_id", F.coalesce("source.source_id", "doc_id"))
    child = lambda name: ir.select("source_id", F.posexplode(name).alias("seq", "x")).select("source_id", F.col("seq").cast("long").alias("seq"), "x.*")
    tables = {name: child(name) for name in ("chunks", "passages", "spans", "relations", "instances", "figures", "tables")}
    tables["spans"] = tables["spans"].withColumn("negated", F.coalesce("negated", F.lit(False))).withColumn("modifiers", F.coalesce("modifiers", F.array().cast(model.MODIFIERS)))
    tables["relations"] = tables["relations"].withColumn("polarity", F.coalesce("polarity", F.lit("affirmed")))
    tables["documents"] = ir.select("source_id", *(F.coalesce(f"source.{c}", F.lit("")).alias(c) for c in ("title", "edition", "origin", "generator", "generated_at")))
    tables["review"] = ir.select("source_id", F.explode("needs_review").alias("extra")).select("source_id", *(F.try_element_at("extra", F.lit(c)).alias(c) for c in ("stage", "code", "reason", "rel_id", "span_id")), "extra")
    return tables


def write_ir(ir: DataFrame, path: str) -> None:
    ir.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str | None) -> DataFrame:
    """``name`` (slugged) and ``member`` of the groups of a manifest; none without one."""
    if path is None:
        return model.empty(spark, "name string, member string")
    groups = spark.read.schema("groups map<string,array<string>>").option("multiLine", True).json(path)
    return groups.select(F.explode("groups").alias("name", "members")).select(slug(F.col("name")).alias("name"), F.explode("members").alias("member"))


def _pipe(spark: SparkSession, path: str, columns: dict[str, int], least: int) -> DataFrame:
    parts = F.split("value", r"\|", -1)
    rows = spark.read.text(path).where(F.size(parts) >= least)
    return rows.select(*(F.get(parts, F.lit(i)).alias(n) for n, i in columns.items()), F.monotonically_increasing_id().alias("pos"))


def concept_names(spark: SparkSession, path: str, languages: tuple[str, ...] = ("ENG",), vocabularies: tuple[str, ...] | None = None) -> DataFrame:
    """cui, sab, code, string of the names in force, with their place in the file."""
    rows = _pipe(spark, path, CONCEPT_COLUMNS, 17).where(F.col("lat").isin(*languages) & ~F.col("suppress").isin(*SUPPRESSED))
    if vocabularies is not None:
        rows = rows.where(F.col("sab").isin(*vocabularies))
    return rows.select("cui", "sab", "code", "string", "pos")


def concept_types(spark: SparkSession, path: str) -> DataFrame:
    return _pipe(spark, path, {"cui": 0, "tui": 1}, 2).where("cui <> '' AND tui <> ''")


def network_relations(spark: SparkSession, path: str) -> DataFrame:
    """Relation rows of a semantic-network definition file."""
    return _pipe(spark, path, {"kind": 0, "ui": 1, "name": 2, "tree": 3, "definition": 4, "inverse": 9}, 10).where("kind = 'RL'").drop("kind")


def network_structure(spark: SparkSession, path: str) -> DataFrame:
    return _pipe(spark, path, {"head": 0, "relation": 1, "tail": 2}, 3)


def is_current(written: Column, read: Column) -> Column:
    """Whether an output is at least as new as its input."""
    return written.isNotNull() & (written >= read)
