"""The driver's tables as extraction tables of a knowledge graph.

Regions are documents, nations their sections and chunks, parts and suppliers
are mentioned concepts, and line items are relations.  Each table is one SELECT
that Spark and the oracle's engine both read, so both start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..operators import assertion
from ..sources.tables import materialise, release

_SOURCE = "replace(lower(r.r_name), ' ', '-')"
_ITEMS = f"""
SELECT {_SOURCE} AS source_id, n.n_nationkey, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  min(l.l_discount) AS score, min(l.l_returnflag) AS flag
FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_nationkey, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey"""
SELECTS = {
    "documents": f"""
SELECT {_SOURCE} AS source_id, r.r_name AS title, '' AS edition, concat('tables/', r.r_name) AS origin, 'loader-1' AS generator, '2026-01-01' AS generated_at
FROM {{region}} r""",
    "chunks": f"""
SELECT {_SOURCE} AS source_id, concat('c', CAST(n.n_nationkey AS VARCHAR(20))) AS chunk_id, CAST(n.n_nationkey AS BIGINT) AS seq, n.n_name AS text, 0 AS char_start,
  length(n.n_name) AS char_end, 'prose' AS kind, replace(lower(n.n_name), '_', '-') AS section_id, n.n_name AS heading
FROM {{nation}} n JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "spans": f"""
SELECT source_id, concat('p', CAST(l_partkey AS VARCHAR(20))) AS span_id, concat('c', CAST(min(n_nationkey) AS VARCHAR(20))) AS chunk_id, l_partkey AS seq, p_name AS text,
  CASE WHEN p_size % 3 = 0 THEN 'Substance' WHEN p_size % 3 = 1 THEN 'Disease' ELSE 'Protein' END AS label,
  concat('{model.SNOMED}', CAST(l_partkey % 997 AS VARCHAR(20))) AS uri
FROM ({_ITEMS}) i JOIN {{part}} p ON i.l_partkey = p.p_partkey GROUP BY source_id, l_partkey, p_name, p_size
UNION ALL
SELECT source_id, concat('s', CAST(l_suppkey AS VARCHAR(20))), concat('c', CAST(min(n_nationkey) AS VARCHAR(20))), 1000000000 + l_suppkey, lower(s_name), 'Substance',
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE concat('{model.SNOMED}9', CAST(l_suppkey AS VARCHAR(20))) END
FROM ({_ITEMS}) i JOIN {{supplier}} s ON i.l_suppkey = s.s_suppkey GROUP BY source_id, l_suppkey, s_name""",
    "relations": f"""
SELECT source_id, concat_ws('-', 'r', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)), CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS rel_id,
  l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey * 100 + l_suppkey % 100 AS seq,
  concat('p', CAST(l_partkey AS VARCHAR(20))) AS head, concat('s', CAST(l_suppkey AS VARCHAR(20))) AS tail,
  CASE l_linenumber WHEN 1 THEN 'caused_by' WHEN 2 THEN 'treated_with' WHEN 3 THEN 'complication_of' WHEN 4 THEN 'stimulates' WHEN 5 THEN 'regulates' WHEN 6 THEN 'secretes'
    ELSE 'associated_with' END AS type,
  CASE flag WHEN 'A' THEN 'negated' WHEN 'R' THEN 'uncertain' ELSE 'affirmed' END AS polarity, score
FROM ({_ITEMS}) i""",
}
TABLES = ("region", "nation", "supplier", "part", "lineitem")


def oracle(name: str) -> str:
    """The SELECT of a table with plain table names."""
    return SELECTS[name].format(**{t: t for t in TABLES})


def _held(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The line items with what they refer to, grouped once and stored, and the extraction tables over them."""
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    items = materialise(spark.sql(_ITEMS, **{t: read[t] for t in TABLES if t != "part"}), "items")
    read["items"] = items
    selects = {name: sql.replace(f"({_ITEMS})", "{items}") for name, sql in SELECTS.items()}
    found = {name: spark.sql(sql, **{t: read[t] for t in read if f"{{{t}}}" in sql}) for name, sql in selects.items()}
    none = F.lit(None)
    found["chunks"] = found["chunks"].select(
        "source_id", "chunk_id", "seq", "text", "char_start", "char_end", F.array(F.col("heading")).alias("section_path"), "kind", none.cast("array<string>").alias("figure_refs"),
        none.cast("array<string>").alias("table_refs"), "section_id",
    )
    found["spans"] = found["spans"].select(
        "source_id", "span_id", "chunk_id", "seq", "text", F.lit(0).alias("char_start"), F.length("text").alias("char_end"), "label", F.lit(False).alias("negated"),
        F.array().cast(model.MODIFIERS).alias("modifiers"), F.regexp_replace("uri", "^.*/", "").alias("cui"), "uri", F.lit(1.0).alias("link_score"), F.lit(None).cast("string").alias("ner_label"),
    )
    found["relations"] = found["relations"].select("source_id", "rel_id", "seq", "head", "tail", "type", "polarity", none.cast("int").alias("evidence_start"), none.cast("int").alias("evidence_end"), "score")
    return items, found


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The extraction tables over a folder of the driver's tables."""
    return _held(spark, sf_dir)[1]


_STORES: dict[tuple[str, str], assertion.Store] = {}


def store(spark: SparkSession, sf_dir: str) -> assertion.Store:
    """The quad store of a folder, with two declared groups: tables that are built once an application and then read."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _STORES:
        items, found = _held(spark, sf_dir)
        groups = found["documents"].select(F.when(F.col("source_id") < "b", "early").otherwise("late").alias("name"), "source_id")
        found["spans"] = materialise(found["spans"], "spans")
        _STORES[key] = assertion.store(found, groups)
        release(items, found["spans"])
    return _STORES[key]


def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quads of a folder's store, to be read by predicate."""
    return store(spark, sf_dir).by_predicate
