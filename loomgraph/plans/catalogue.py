"""Registered queries over the driver's tables and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import text
from ..model import CATALOG, DCT, INST, LABEL, LABELS, ONT, PROV, PROVENANCE, RDF, RDFS, TYPE, XSD
from ..operators import assertion, graphs, guards, linking, reasoning
from ..ontology import default
from . import adapters, named, sparql, stated

Query = Callable[[SparkSession, str], DataFrame]
_TYPES = ", ".join(f"('{t.name}', '{t.uri}', {str(t.symmetric).lower()}, {f"'{t.parent}'" if t.parent else 'NULL'})" for t in default().relations.values())
#: The quads of the adapted tables, in the oracle's SQL.
BASE_SQL = f"""
documents_ AS MATERIALIZED ({adapters.oracle("documents")}), chunks_ AS MATERIALIZED ({adapters.oracle("chunks")}), spans_ AS MATERIALIZED ({adapters.oracle("spans")}), relations_ AS MATERIALIZED ({adapters.oracle("relations")}),
types_ AS (SELECT * FROM (VALUES {_TYPES}) t(type, uri, sym, parent)),
ends_ AS MATERIALIZED (SELECT s.source_id, span_id, uri, '{model.GRAPH}' || s.source_id || '/' || section_id AS g, s.text FROM spans_ s JOIN chunks_ c USING (source_id, chunk_id)),
rel_ AS MATERIALIZED (
  SELECT r.*, h.uri AS h_uri, h.g, t.uri AS t_uri, y.uri AS pred, polarity = 'affirmed' AND t.uri IS NOT NULL AS fact
  FROM relations_ r JOIN ends_ h ON r.source_id = h.source_id AND r.head = h.span_id AND h.uri IS NOT NULL
  LEFT JOIN ends_ t ON r.source_id = t.source_id AND r.tail = t.span_id JOIN types_ y USING (type)
),
facts_ AS MATERIALIZED (SELECT *, '{INST}stmt/' || substr(sha1(concat_ws('|', g, h_uri, pred, t_uri)), 1, 12) AS stmt FROM rel_ WHERE fact),
claims_ AS MATERIALIZED (SELECT *, '{INST}assert/' || substr(sha1(concat_ws('|', source_id, rel_id, h_uri, type)), 1, 12) AS node FROM rel_ WHERE NOT fact),
labels_ AS MATERIALIZED (
  SELECT uri, first(text ORDER BY n DESC, length(text), f) AS label, sum(n)::BIGINT AS mentions
  FROM (SELECT uri, text, count(*) AS n, min((source_id, seq)) AS f FROM spans_ WHERE uri IS NOT NULL GROUP BY uri, text) GROUP BY uri
),
docs_ AS (SELECT *, '{model.GRAPH}' || source_id AS d, '{INST}agent/' || substr(sha1('agent|' || generator), 1, 12) AS agent FROM documents_),
secs_ AS (SELECT source_id, section_id, heading, '{model.GRAPH}' || source_id AS d, '{model.GRAPH}' || source_id || '/' || section_id AS s, row_number() OVER (PARTITION BY source_id ORDER BY seq) AS ord FROM chunks_),
groups_ AS (SELECT DISTINCT CASE WHEN source_id < 'b' THEN 'early' ELSE 'late' END AS name, d FROM docs_),
quads AS MATERIALIZED (
  SELECT DISTINCT * FROM (
  SELECT h_uri AS s, pred AS p, t_uri AS o, 'iri' AS o_kind, NULL AS o_dt, g FROM facts_
  UNION ALL SELECT stmt, '{TYPE}', '{RDF}Statement', 'iri', NULL, g FROM facts_
  UNION ALL SELECT stmt, '{RDF}subject', h_uri, 'iri', NULL, g FROM facts_
  UNION ALL SELECT stmt, '{RDF}predicate', pred, 'iri', NULL, g FROM facts_
  UNION ALL SELECT stmt, '{RDF}object', t_uri, 'iri', NULL, g FROM facts_
  UNION ALL SELECT stmt, '{ONT}confidence', round(score, 3)::VARCHAR, 'lit', '{XSD}double', g FROM facts_
  UNION ALL SELECT stmt, '{ONT}extractedBy', 'llm-re', 'lit', NULL, g FROM facts_
  UNION ALL SELECT node, '{TYPE}', '{ONT}ClinicalAssertion', 'iri', NULL, g FROM claims_
  UNION ALL SELECT node, '{ONT}about', h_uri, 'iri', NULL, g FROM claims_
  UNION ALL SELECT node, '{ONT}assertionType', pred, 'iri', NULL, g FROM claims_
  UNION ALL SELECT node, '{ONT}polarity', '{ONT}' || upper(polarity[1]) || polarity[2:], 'iri', NULL, g FROM claims_
  UNION ALL SELECT node, '{ONT}target', t_uri, 'iri', NULL, g FROM claims_ WHERE t_uri IS NOT NULL
  UNION ALL SELECT uri, '{LABEL}', label, 'lit', NULL, '{LABELS}' FROM labels_
  UNION ALL SELECT uri, '{ONT}mentionCount', mentions::VARCHAR, 'lit', '{XSD}integer', '{LABELS}' FROM labels_
  UNION ALL SELECT d, '{DCT}source', origin, 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{DCT}hasVersion', edition, 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{ONT}snomedVersion', '{model.SNOMED_VERSION}', 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT agent, '{TYPE}', '{PROV}SoftwareAgent', 'iri', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT agent, '{LABEL}', generator, 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{PROV}wasGeneratedBy', agent, 'iri', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{PROV}wasDerivedFrom', origin, 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{PROV}generatedAtTime', generated_at, 'lit', NULL, '{PROVENANCE}' FROM docs_
  UNION ALL SELECT d, '{TYPE}', '{ONT}Document', 'iri', NULL, '{CATALOG}' FROM docs_
  UNION ALL SELECT d, '{LABEL}', title, 'lit', NULL, '{CATALOG}' FROM docs_
  UNION ALL SELECT d, '{DCT}identifier', source_id, 'lit', NULL, '{CATALOG}' FROM docs_
  UNION ALL SELECT s, '{TYPE}', '{ONT}Section', 'iri', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{LABEL}', heading, 'lit', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{DCT}identifier', section_id, 'lit', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{ONT}sectionPath', heading, 'lit', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{ONT}sectionOrder', ord::VARCHAR, 'lit', '{XSD}integer', '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{ONT}inDocument', d, 'iri', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT s, '{DCT}isPartOf', d, 'iri', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT d, '{ONT}hasSection', s, 'iri', NULL, '{CATALOG}' FROM secs_
  UNION ALL SELECT '{model.GROUP}' || name, '{TYPE}', '{ONT}DocumentGroup', 'iri', NULL, '{CATALOG}' FROM groups_
  UNION ALL SELECT '{model.GROUP}' || name, '{LABEL}', name, 'lit', NULL, '{CATALOG}' FROM groups_
  UNION ALL SELECT '{model.GROUP}' || name, '{ONT}hasMember', d, 'iri', NULL, '{CATALOG}' FROM groups_
  )
),
triples AS MATERIALIZED (SELECT DISTINCT s, p, o, o_kind, o_dt FROM quads),
label AS MATERIALIZED (SELECT s, o AS l FROM triples WHERE p = '{LABEL}')
"""


def _sql(select: str, more: str = "") -> str:
    return f"WITH RECURSIVE {BASE_SQL}{', ' + more if more else ''} {select}"


_LOCAL = r"regexp_replace({}, '^.*[#/]', '')"


def _over(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(adapters.quads(spark, sf_dir))


def _named(name: str) -> Query:
    return _over(lambda quads: named.run(name, quads))


def _with_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = adapters.quads(spark, sf_dir)
    return quads.unionByName(reasoning.materialise_inferred(quads))


def _subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = adapters.store(spark, sf_dir).subset(documents=("africa",), sections=("NATION_5", "nation-10")).quads
    return kept.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


def _guarded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = adapters.tables(spark, sf_dir)
    return guards.run(t["relations"], t["spans"], t["chunks"])


def _dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _guarded(spark, sf_dir)
    return kept.where("polarity = 'affirmed'").groupBy("source_id", "type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("score") * 100).cast("long")).alias("points"))


def _review(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    code = F.get_json_object("props", "$.k")
    rows = events.select(F.col("event_type").alias("stage"), F.when(F.col("value") < 10, F.lit("")).otherwise(F.substring(code, 1, 1)).alias("code"), F.when(F.col("value") > 5, F.concat(F.lit("value of "), F.col("event_id"))).alias("reason"), F.col("event_id").alias("seq"))
    return guards.review_summary(rows)


def _topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    unit = linking.normalise(F.col("embedding"))
    found = linking.top_k(rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), unit.alias("vector")), rows.select(F.col("label").alias("cui"), unit.alias("vector")), k=5)
    return found.select(F.col("query").cast("long").alias("query"), "cui", F.round("score", 6).alias("score"), "rank")


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.slug(F.col("text")).alias("slug"), F.sha1(text.duplicate_key(F.col("text"))).alias("dup_key"), F.length(text.drop_formula_sentences(F.col("text"))).alias("n_kept"))


def _offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.parsing import merge_segments

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("string").alias("source_id"), F.col("turn").alias("seq"), F.col("role").alias("kind"), F.lit("").alias("section_id"), F.coalesce("text", F.lit("")).alias("text"))
    return merge_segments(rows).groupBy("source_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("char_end").alias("ends"), F.sum("char_start").alias("starts"))


_ABOUT = "small ring"
_SPARQL = """
SELECT ?subject ?object (MAX(?conf) AS ?best) (COUNT(DISTINCT ?stmt) AS ?n) WHERE {
  ?stmt rdf:subject ?s ; rdf:predicate ont:caused_by ; rdf:object ?o .
  OPTIONAL { ?stmt ont:confidence ?conf }
  OPTIONAL { ?s rdfs:label ?sl } OPTIONAL { ?o rdfs:label ?ol }
  FILTER(?conf >= 0.05)
  BIND(COALESCE(?sl, STR(?s)) AS ?subject) BIND(COALESCE(?ol, STR(?o)) AS ?object)
} GROUP BY ?subject ?object ORDER BY DESC(?best) ?subject"""
_CLASS_SCHEMA = [(f"{model.SNOMED}91", RDFS + "subClassOf", ONT + "Drug"), (ONT + "Drug", RDFS + "subClassOf", ONT + "Thing"), (ONT + "treated_with", RDFS + "range", f"{ONT}Treatment")]

QUERIES: dict[str, Query] = {
    "quads": lambda spark, d: adapters.store(spark, d).quads.select("s", "p", "o", "o_kind", "o_dt", "g"),
    **{f"q_{name}": _named(name) for name in named.NAMED if name not in ("inferred", "figures", "instances", "concepts")},
    "q_concepts": _over(lambda quads: named.run("concepts", quads).withColumn("mentions", F.col("mentions").cast("double"))),  # a nullable count
    "q_instances": lambda spark, d: named.unfold(adapters.store(spark, d).subjects(INST)),
    "q_inferred": lambda spark, d: named.run("inferred", _with_inferred(spark, d)),
    "q_about": _over(lambda quads: named.about(graphs.load_graph(quads, skip=("inferred",)), _ABOUT)),
    "q_negated_only": _over(lambda quads: named.with_polarity(graphs.flatten(quads), "Negated")),
    "q_scopes": lambda spark, d: graphs.Catalog(adapters.store(spark, d).plain).scopes(),
    "q_scoped_relations": lambda spark, d: named.relations(graphs.flatten(adapters.store(spark, d).subset(groups=("early",)).by_predicate)),
    "q_sparql": _over(lambda quads: sparql.query(graphs.flatten(quads), _SPARQL)),
    "describe": lambda spark, d: graphs.describe(adapters.store(spark, d).quads, distinct=True),
    "subset": _subset,
    "labels_elected": lambda spark, d: assertion.elect_labels(adapters.tables(spark, d)["spans"]),
    "guards_kept": _dedupe,
    "guards_report": lambda spark, d: guards.report(*_guarded(spark, d)),
    "guards_sentences_kept": stated.kept,
    "guards_sentences_report": stated.report,
    "review_summary": _review,
    "rdfs_closure": _over(lambda quads: reasoning.materialise_inferred(quads, schema=_schema(quads)).select("s", "p", "o")),
    "linker_top_k": _topk,
    "text_functions": _structured,
    "merged_offsets": _offsets,
}


def _schema(quads: DataFrame) -> DataFrame:
    rows = quads.sparkSession.createDataFrame(_CLASS_SCHEMA, "s string, p string, o string")
    return rows.select(*model.iri(F.col("s"), F.col("p"), F.col("o"), F.lit(None).cast("string"))[:6])


_RELATION_ROWS = f"""rows_ AS MATERIALIZED (
  SELECT t.s, t.p, t.o, coalesce(a.l, t.s) AS subject, {_LOCAL.format('t.p')} AS predicate, coalesce(b.l, t.o) AS object
  FROM triples t JOIN (SELECT uri FROM types_) y ON t.p = y.uri LEFT JOIN label a ON a.s = t.s LEFT JOIN label b ON b.s = t.o
), stated AS MATERIALIZED (
  SELECT a.s AS stmt, a.o AS s, b.o AS p, c.o AS o FROM triples a JOIN triples b ON a.s = b.s AND b.p = '{RDF}predicate' JOIN triples c ON a.s = c.s AND c.p = '{RDF}object'
  WHERE a.p = '{RDF}subject'
), conf AS MATERIALIZED (SELECT s AS stmt, try_cast(o AS DOUBLE) AS conf FROM triples WHERE p = '{ONT}confidence')"""
_CLAIM_ROWS = f"""claim AS MATERIALIZED (
  SELECT {_LOCAL.format('pol.o')} AS polarity, coalesce(al.l, ab.o) AS about, coalesce(tl.l, ta.o, '') AS target, {_LOCAL.format('aty.o')} AS "assertionType"
  FROM triples x JOIN triples ab ON ab.s = x.s AND ab.p = '{ONT}about' JOIN triples pol ON pol.s = x.s AND pol.p = '{ONT}polarity'
  LEFT JOIN triples ta ON ta.s = x.s AND ta.p = '{ONT}target' LEFT JOIN label tl ON tl.s = ta.o
  LEFT JOIN triples aty ON aty.s = x.s AND aty.p = '{ONT}assertionType' LEFT JOIN label al ON al.s = ab.o
  WHERE x.p = '{TYPE}' AND x.o = '{ONT}ClinicalAssertion'
)"""
_RELATIONS = "SELECT subject, predicate, object, max(conf) AS confidence, count(DISTINCT st.stmt) AS extractions FROM rows_ r LEFT JOIN (SELECT stated.*, conf FROM stated JOIN conf USING (stmt)) st USING (s, p, o) GROUP BY ALL"
_EARLY = f"triples_early AS (SELECT DISTINCT s, p, o FROM quads WHERE g LIKE '{model.GRAPH}a%')"
_KEPT = """con AS (
  SELECT r.*, lower(trim(h.text)) AS h_text, lower(trim(t.text)) AS t_text, coalesce(h.uri, lower(trim(h.text))) AS hc, coalesce(t.uri, lower(trim(t.text))) AS tc, y.sym, y.parent
  FROM relations_ r JOIN spans_ h ON r.source_id = h.source_id AND r.head = h.span_id JOIN spans_ t ON r.source_id = t.source_id AND r.tail = t.span_id JOIN types_ y USING (type)
), dirc AS (
  SELECT source_id, rel_id FROM con a WHERE NOT sym AND hc <> tc AND EXISTS (SELECT 1 FROM con b WHERE b.source_id = a.source_id AND b.type = a.type AND b.hc = a.tc AND b.tc = a.hc)
), aff AS (
  SELECT * FROM con WHERE polarity = 'affirmed' AND rel_id NOT IN (SELECT rel_id FROM dirc)
), loops AS (
  SELECT source_id, rel_id FROM aff a WHERE type IN ('stimulates', 'regulates') AND EXISTS (SELECT 1 FROM aff b WHERE b.type = 'secretes' AND b.source_id = a.source_id AND b.hc = a.tc AND b.tc = a.hc)
), selfs AS (
  SELECT source_id, rel_id FROM aff WHERE rel_id NOT IN (SELECT rel_id FROM loops) AND NOT sym AND (hc = tc OR h_text = t_text)
), good AS (
  SELECT * FROM aff WHERE rel_id NOT IN (SELECT rel_id FROM loops) AND rel_id NOT IN (SELECT rel_id FROM selfs)
), best AS (
  SELECT *, row_number() OVER (PARTITION BY source_id, type, hc, tc ORDER BY score DESC, seq) AS n FROM good
), sub AS (
  SELECT source_id, rel_id FROM best a WHERE n = 1 AND EXISTS (SELECT 1 FROM best b WHERE b.n = 1 AND b.parent = a.type AND b.source_id = a.source_id AND b.hc = a.hc AND b.tc = a.tc)
)"""
_FIRED = {"re-direction": "dirc", "re-feedback-loop": "loops", "re-self-loop": "selfs", "re-duplicate": "(SELECT * FROM best WHERE n > 1)", "re-subsumed": "sub"}

ORACLES: dict[str, str] = {
    "quads": _sql("SELECT s, p, o, o_kind, o_dt, g FROM quads"),
    "q_relations": _sql(_RELATIONS, _RELATION_ROWS),
    "q_flagged": _sql("SELECT * FROM claim WHERE polarity <> 'Affirmed'", _CLAIM_ROWS),
    "q_negated": _sql("SELECT * FROM claim", _CLAIM_ROWS),
    "q_negated_only": _sql("SELECT * FROM claim WHERE polarity = 'Negated'", _CLAIM_ROWS),
    "q_concepts": _sql(f"SELECT l AS label, label.s AS concept, try_cast(m.o AS DOUBLE) AS mentions FROM label LEFT JOIN triples m ON m.s = label.s AND m.p = '{ONT}mentionCount'"),
    "q_provenance": _sql(f"SELECT s AS graph, {_LOCAL.format('p')} AS property, o AS value FROM triples WHERE p IN ({', '.join(repr(p) for p in named.PROVENANCE_PROPERTIES)})"),
    "q_evidence": _sql(f"""SELECT coalesce(a.l, st.s) AS subject, {_LOCAL.format('st.p')} AS predicate, coalesce(b.l, st.o) AS object, conf AS confidence, e.o AS "extractedBy"
FROM stated st LEFT JOIN conf USING (stmt) LEFT JOIN triples e ON e.s = st.stmt AND e.p = '{ONT}extractedBy' LEFT JOIN label a ON a.s = st.s LEFT JOIN label b ON b.s = st.o""", _RELATION_ROWS),
    "q_instances": _sql(f"""SELECT regexp_replace(a.s, '^.*/', '') AS instance, {_LOCAL.format('b.p')} AS property, b.o AS value
FROM triples a JOIN triples b ON a.s = b.s AND b.p <> '{TYPE}' WHERE a.p = '{TYPE}' AND starts_with(a.s, '{INST}')"""),
    "q_inferred": _sql(f"""SELECT coalesce(a.l, t.s) AS subject, {_LOCAL.format('t.p')} AS predicate, coalesce(b.l, t.o) AS object
FROM (SELECT t.s, q.uri AS p, t.o FROM triples t JOIN types_ c ON t.p = c.uri JOIN types_ q ON c.parent = q.type EXCEPT SELECT s, p, o FROM triples) t
LEFT JOIN label a ON a.s = t.s LEFT JOIN label b ON b.s = t.o"""),
    "q_about": _sql(f"""SELECT 'out' AS direction, {_LOCAL.format('t.p')} AS predicate, coalesce(l.l, t.o) AS other FROM triples t JOIN c ON t.s = c.s LEFT JOIN label l ON l.s = t.o WHERE t.p <> '{LABEL}'
UNION ALL SELECT 'in', {_LOCAL.format('t.p')}, coalesce(l.l, t.s) FROM triples t JOIN c ON t.o = c.s AND t.o_kind <> 'lit' LEFT JOIN label l ON l.s = t.s""", f"c AS (SELECT min(s) AS s FROM label WHERE lower(l) = lower('{_ABOUT}'))"),
    "q_scopes": _sql("""SELECT 'document' AS kind, d AS uri, source_id AS id, title AS label, '' AS within FROM docs_
UNION ALL SELECT 'section', s, section_id, heading, d FROM secs_ UNION ALL SELECT 'group', 'urn:group:' || name, name, name, string_agg(d, ' ' ORDER BY d) FROM groups_ GROUP BY name"""),
    "q_scoped_relations": _sql(_RELATIONS, (_EARLY + ", " + _RELATION_ROWS).replace("FROM triples ", "FROM triples_early ").replace("JOIN triples ", "JOIN triples_early ")),
    "q_sparql": _sql(f"""SELECT coalesce(a.l, st.s) AS subject, coalesce(b.l, st.o) AS object, max(conf) AS best, count(DISTINCT st.stmt) AS n FROM stated st JOIN conf USING (stmt)
LEFT JOIN label a ON a.s = st.s LEFT JOIN label b ON b.s = st.o WHERE st.p = '{ONT}caused_by' AND conf >= 0.05 GROUP BY ALL""", _RELATION_ROWS),
    "describe": _sql("SELECT g, count(*) AS n FROM quads GROUP BY g"),
    "subset": _sql("SELECT g, count(*) AS n FROM (SELECT * FROM own UNION SELECT * FROM meta UNION SELECT q.* FROM quads q JOIN terms ON q.s = terms.t WHERE q.g = 'urn:graph:labels') GROUP BY g", f"""
pick AS (SELECT s AS g FROM secs_ WHERE source_id = 'africa' AND section_id IN ('nation-5', 'nation-10')),
about AS (SELECT g AS t FROM pick UNION SELECT regexp_replace(g, '/[^/]*$', '') FROM pick), own AS (SELECT q.* FROM quads q JOIN pick USING (g)),
meta AS (SELECT q.* FROM quads q WHERE g IN ('{PROVENANCE}', '{CATALOG}') AND (s IN (SELECT t FROM about) OR (o_kind <> 'lit' AND o IN (SELECT t FROM about)))),
terms AS (SELECT s AS t FROM own UNION SELECT p FROM own UNION SELECT o FROM own WHERE o_kind <> 'lit' UNION SELECT s FROM meta UNION SELECT p FROM meta UNION SELECT o FROM meta WHERE o_kind <> 'lit')"""),
    "labels_elected": _sql("SELECT uri, label, mentions FROM labels_"),
    "guards_kept": _sql("SELECT source_id, type, count(*) AS n, sum(round(score * 100))::BIGINT AS points FROM best WHERE n = 1 AND rel_id NOT IN (SELECT rel_id FROM sub) GROUP BY source_id, type", _KEPT),
    "guards_report": _sql(" UNION ALL ".join(f"SELECT '{stage}' AS guard, count(*) AS n FROM {rows} HAVING count(*) > 0" for stage, rows in _FIRED.items())
        + " UNION ALL SELECT 'affirmed_remaining', count(*) FROM best WHERE n = 1 AND rel_id NOT IN (SELECT rel_id FROM sub)", _KEPT),
    "guards_sentences_kept": stated.KEPT_SQL,
    "guards_sentences_report": stated.REPORT_SQL,
    "review_summary": """WITH r AS (SELECT event_type AS stage, CASE WHEN value < 10 THEN '' ELSE substr(json_extract_string(props, '$.k'), 1, 1) END AS code,
  CASE WHEN value > 5 THEN 'value of ' || event_id END AS reason, event_id FROM events)
SELECT stage, coalesce(nullif(code, ''), '-') AS code, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM r), 1) AS share, arg_min(reason, event_id) FILTER (reason IS NOT NULL) AS example FROM r GROUP BY ALL""",
    "rdfs_closure": _sql(f"""SELECT DISTINCT s, p, o FROM closure WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.s = closure.s AND b.p = closure.p AND b.o = closure.o)""", f"""
base AS (SELECT DISTINCT s, p, o FROM quads WHERE g NOT IN ('{PROVENANCE}', '{CATALOG}') UNION SELECT c.uri, '{RDFS}subPropertyOf', q.uri FROM types_ c JOIN types_ q ON c.parent = q.type
  UNION SELECT * FROM (VALUES {', '.join(str(x) for x in _CLASS_SCHEMA)}) v(s, p, o)),
closure AS (SELECT * FROM base UNION
  SELECT * FROM (
  SELECT c.s, q.o AS p, c.o FROM closure c JOIN base q ON q.s = c.p AND q.p = '{RDFS}subPropertyOf'
  UNION ALL SELECT c.o, '{TYPE}', q.o FROM closure c JOIN base q ON q.s = c.p AND q.p = '{RDFS}range'
  UNION ALL SELECT c.s, c.p, q.o FROM closure c JOIN base q ON q.s = c.o AND q.p = '{RDFS}subClassOf' WHERE c.p IN ('{TYPE}', '{RDFS}subClassOf')))"""),
    "linker_top_k": """WITH v AS (SELECT vec_id, label::VARCHAR AS cui, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
n AS (SELECT vec_id, cui, list_transform(e, lambda x: x / (sqrt(list_sum(list_transform(e, lambda y: y * y))) + 1e-12)) AS e FROM v),
s AS (SELECT q.vec_id AS query, a.cui, max(list_dot_product(q.e, a.e)) AS score FROM n q, n a WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query, cui, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, cui) AS rank FROM s) WHERE rank <= 5""",
}
