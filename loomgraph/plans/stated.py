"""The driver's line items as sentences with mentions, evidence and modifiers, so that every rule over relations has something to find.

One SELECT that Spark and the oracle's engine both read makes the sentences; the
oracle then judges them by the rules as set operations of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..ontology import default
from ..operators import guards
from ..sources.tables import materialise

TABLES = ("nation", "supplier", "part", "lineitem")
#: Type, words before the head, between both ends and after the tail, by pattern number.
_FORMS = (
    ("caused_by", "The ", " is caused by ", "."), ("caused_by", "The ", " causes ", "."), ("converts_to", "The ", " is converted to ", "."), ("converts_to", "The ", " is derived from ", "."),
    ("stimulates", "A lack of ", " acts on ", "."), ("secretes", "The ", " gives off ", " levels."), ("associated_with", "Here is ", ". Elsewhere there is ", "."),
    ("treated_with", "The ", " goes with ", "."), ("treated_with", "The ", " meets ", " often."), ("risk_factor_for", "The ", " leads to ", "!"), ("catalyzes", "The ", " acts upon ", "."),
    ("inhibits", "The ", " holds down ", "."), ("located_in", "The ", " lies in ", "."), ("regulates", "The ", " changes ", "."),
)


def _case(at: int) -> str:
    return "CASE k " + " ".join(f"WHEN {k} THEN '{form[at]}'" for k, form in enumerate(_FORMS)) + " END"


_RAW = f"""
SELECT lower(n.n_name) AS source_id, l.l_orderkey AS o, l.l_linenumber AS n, l.l_partkey AS p, l.l_suppkey AS s, min(p.p_name) AS p_name, min(s.s_name) AS s_name,
  min(l.l_returnflag) AS flag, min(l.l_discount) AS score, (l.l_orderkey * 7 + l.l_linenumber * 5 + l.l_suppkey) % {len(_FORMS)} AS k
FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey JOIN {{part}} p ON l.l_partkey = p.p_partkey
GROUP BY n.n_name, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey"""
STATED = f"""
SELECT source_id, concat_ws('-', 'r', CAST(o AS VARCHAR(20)), CAST(n AS VARCHAR(20)), CAST(p AS VARCHAR(20)), CAST(s AS VARCHAR(20))) AS rel_id,
  o * 100000000 + n * 10000000 + p * 100 + s % 100 AS seq, o * 1600 + n * 200 AS base, k,
  CASE WHEN k = 13 AND o % 3 = 0 THEN 'secretes' WHEN k = 13 AND o % 3 = 1 THEN 'stimulates' WHEN k = 10 AND p % 40 > 0 THEN 'requires' ELSE {_case(0)} END AS type,
  {_case(1)} AS pre, {_case(2)} AS mid, {_case(3)} AS post,
  CASE WHEN k = 7 AND p % 3 = 0 THEN 'type 2' WHEN k = 11 AND p % 2 = 0 THEN concat('hyper', p_name) WHEN k = 11 THEN concat('hypo', p_name) ELSE p_name END AS h_text,
  CASE WHEN k = 8 AND s % 2 = 0 THEN 'disease' ELSE lower(s_name) END AS t_text,
  CASE WHEN k IN (7, 11) THEN NULL WHEN k = 13 THEN concat('{model.SNOMED}7', CAST(p % 17 AS VARCHAR(20))) ELSE concat('{model.SNOMED}', CAST(p % 211 AS VARCHAR(20))) END AS h_uri,
  CASE WHEN k = 8 OR s % 5 = 0 AND k <> 13 THEN NULL WHEN k = 13 THEN concat('{model.SNOMED}7', CAST(s % 17 AS VARCHAR(20))) ELSE concat('{model.SNOMED}9', CAST(s % 13 AS VARCHAR(20))) END AS t_uri,
  k = 12 AND o % 2 = 0 AS deviates, CASE flag WHEN 'A' THEN 'negated' ELSE 'affirmed' END AS polarity, score
FROM ({_RAW}) x"""


def oracle() -> str:
    return STATED.format(**{t: t for t in TABLES})


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``relations``, ``spans`` and ``chunks`` (one sentence or two each) of the stated line items."""
    rows = spark.sql(STATED, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    rows = materialise(rows, "stated")
    base = F.col("base").cast("long")  # order keys times 1,600 pass an int
    rows = rows.withColumn("h_at", base + F.length("pre")).withColumn("t_at", F.col("h_at") + F.length("h_text") + F.length("mid"))
    none, empty = F.lit(None), F.array().cast(model.MODIFIERS)
    deviation = F.array(F.struct(F.lit("deviation").alias("type"), F.lit("low").alias("text"), *(none.cast(t).alias(c) for c, t in (("char_start", "int"), ("char_end", "int"), ("cui", "string"), ("uri", "string"))))).cast(model.MODIFIERS)

    def side(x: str, n: int) -> DataFrame:
        changed = F.when(F.col("deviates"), deviation).otherwise(empty) if x == "t" else empty
        return rows.select(
            "source_id", F.concat("rel_id", F.lit(x)).alias("span_id"), F.col("rel_id").alias("chunk_id"), (F.col("seq") * 2 + n).alias("seq"), F.col(f"{x}_text").alias("text"), F.col(f"{x}_at").alias("char_start"),
            (F.col(f"{x}_at") + F.length(f"{x}_text")).alias("char_end"), F.lit("Substance").alias("label"), F.lit(False).alias("negated"), changed.alias("modifiers"),
            F.regexp_replace(f"{x}_uri", "^.*/", "").alias("cui"), F.col(f"{x}_uri").alias("uri"), F.lit(1.0).alias("link_score"), none.cast("string").alias("ner_label"),
        )

    text = F.concat("pre", "h_text", "mid", "t_text", "post")
    relations = rows.select(
        "source_id", "rel_id", "seq", F.concat("rel_id", F.lit("h")).alias("head"), F.concat("rel_id", F.lit("t")).alias("tail"), "type", "polarity",
        F.col("h_at").alias("evidence_start"), (F.col("h_at") + F.length("h_text")).alias("evidence_end"), "score",
    )
    chunks = rows.select(
        "source_id", F.col("rel_id").alias("chunk_id"), "seq", text.alias("text"), base.alias("char_start"), (base + F.length(text)).alias("char_end"), F.array("source_id").alias("section_path"),
        F.lit("prose").alias("kind"), none.cast("array<string>").alias("figure_refs"), none.cast("array<string>").alias("table_refs"), F.lit("all").alias("section_id"),
    )
    return {"relations": relations, "spans": side("h", 0).unionByName(side("t", 1)), "chunks": chunks}


def _cues(cues: tuple[str, ...]) -> str:
    return "(?:" + "|".join(cues) + ")"


def _list(values: tuple[str, ...] | list[str]) -> str:
    return ", ".join(f"'{x}'" for x in values)


_SYMMETRIC = [t.name for t in default().relations.values() if t.symmetric]
_PARENTS = ", ".join(f"('{t.name}', '{t.parent}')" for t in default().relations.values() if t.parent)
_GAP = r"(?:[^.;\s]+(?:\s+[^.;\s]+){0,3}|(?:\s+[^.;\s]+){0,4})\s*$"


def _governed(x: str) -> str:
    before = f"substr(body, greatest({x}_at - base - {guards.WINDOW_BEFORE - 1}, 1)::INT, least({x}_at - base, {guards.WINDOW_BEFORE})::INT)"
    after = f"substr(body, ({x}_at - base + length({x}_text) + 1)::INT, {guards.WINDOW_AFTER})"
    return rf"(regexp_matches({before}, '(?is){_cues(guards.BEFORE)}{_GAP}') OR regexp_matches({after}, '(?i)^[\s\-]{{0,3}}(?:\([A-Za-z0-9/\-]{{1,12}}\)[\s\-]{{0,2}})?{_cues(guards.AFTER)}\b'))"


def _stem(column: str, what: str) -> str:
    out = "CASE"
    for k, pair in enumerate(guards.ANTONYMS):
        for n, prefix in enumerate(pair):
            value = f"'{k}:' || substr(lower(trim({column})), {len(prefix) + 1})" if what == "stem" else str(n)
            out += f" WHEN starts_with(lower(trim({column})), '{prefix}') THEN {value}"
    return out + " END"


def _out(x: str) -> str:
    inside = f"({x}_at BETWEEN lo AND hi AND {x}_at + length({x}_text) <= hi)"
    return f"NOT ({inside} OR contains(lower(scope), lower({x}_text)))"


def _step(name: str, before: str, hit: str, affirmed: bool = True) -> str:
    """A CTE that demotes what ``hit`` names and notes it under the rule's name."""
    fired = f"({'polarity = ' + repr('affirmed') + ' AND ' if affirmed else ''}({hit}))"
    return f"{name} AS MATERIALIZED (SELECT x.* EXCLUDE (polarity), CASE WHEN {fired} THEN 'uncertain' ELSE polarity END AS polarity, {fired} AS f_{name} FROM {before} x)"


_FIRST = f"(CASE WHEN h_at < t_at THEN h_at + length(h_text) ELSE t_at + length(t_text) END - base)"
#: Rules in order: CTE name, stage of the review row.
STAGES = {
    "direction": "re-direction", "antonym": "re-antonym-conflict", "scoped": "re-evidence-scope", "ruled": "re-governed-role", "causal": "re-causal-direction", "conversion": "re-conversion-direction",
    "feedback": "re-feedback-loop", "selfs": "re-self-loop", "fragment": "re-fragment-span", "vacuous": "re-vacuous-endpoint", "structural": "re-structural-deviation", "enzyme": "re-enzyme-as-substrate",
}
_ROWS = f"""st AS (SELECT *, base + length(pre) AS h_at, base + length(pre) + length(h_text) + length(mid) AS t_at, pre || h_text || mid || t_text || post AS body FROM ({oracle()})),
w AS (SELECT *, h_at - base AS ea, h_at - base + length(h_text) AS eb FROM st),
w2 AS (SELECT *, base + ea - length(regexp_extract(substr(body, 1, ea::INT), '[^.!?\\n]*$')) AS lo,
  base + eb + CASE WHEN regexp_matches(substr(body, eb::INT, 1), '[.!?\\n]') THEN 0 ELSE length(regexp_extract(substr(body, (eb + 1)::INT), '^[^.!?\\n]*[.!?\\n]?')) END AS hi FROM w),
con AS MATERIALIZED (SELECT *, substr(body, (lo - base + 1)::INT, (hi - lo)::INT) AS scope, coalesce(h_uri, lower(trim(h_text))) AS hc, coalesce(t_uri, lower(trim(t_text))) AS tc, h_at < t_at AS head_first,
  substr(body, ({_FIRST} + 1)::INT, ((CASE WHEN h_at < t_at THEN t_at ELSE h_at END) - base - {_FIRST})::INT) AS between FROM w2),
judged AS MATERIALIZED (SELECT *, regexp_matches(between, '(?i){_cues(guards.CAUSE_FIRST)}') AS cf, regexp_matches(between, '(?i){_cues(guards.EFFECT_FIRST)}') AS cb,
  regexp_matches(between, '(?i){_cues(guards.SOURCE_FIRST)}') AS vf, regexp_matches(between, '(?i){_cues(guards.PRODUCT_FIRST)}') AS vb,
  type IN ({_list(_SYMMETRIC)}) AS sym, {_out('h')} AS h_out, {_out('t')} AS t_out, {_governed('h')} OR (NOT deviates AND {_governed('t')}) AS governed FROM con),
ways AS MATERIALIZED (SELECT DISTINCT source_id, type, coalesce(h_uri, lower(h_text)) AS a, coalesce(t_uri, lower(t_text)) AS b FROM judged WHERE NOT sym),
{_step('direction', 'judged', "NOT sym AND coalesce(h_uri, lower(h_text)) <> coalesce(t_uri, lower(t_text)) AND EXISTS (SELECT 1 FROM ways w WHERE w.source_id = x.source_id AND w.type = x.type AND w.a = coalesce(x.t_uri, lower(x.t_text)) AND w.b = coalesce(x.h_uri, lower(x.h_text)))", affirmed=False)},
stems AS MATERIALIZED (SELECT source_id, rel_id, type, coalesce(t_uri, lower(t_text)) AS tk, {_stem('h_text', 'stem')} AS stem, {_stem('h_text', 'side')} AS side FROM direction WHERE polarity = 'affirmed'),
{_step('antonym', 'direction', "rel_id IN (SELECT a.rel_id FROM stems a JOIN stems b USING (source_id, type, tk, stem) WHERE a.side <> b.side)")},
sp AS MATERIALIZED (SELECT source_id, rel_id, 'h' AS side, hc AS c, h_at AS a, h_at + length(h_text) AS b FROM judged UNION ALL SELECT source_id, rel_id, 't', tc, t_at, t_at + length(t_text) FROM judged),
lost AS (SELECT e.rel_id FROM (SELECT source_id, rel_id, 'h' AS side, hc AS c, lo, hi FROM antonym WHERE h_out UNION ALL SELECT source_id, rel_id, 't', tc, lo, hi FROM antonym WHERE t_out) e
  WHERE NOT EXISTS (SELECT 1 FROM sp o WHERE o.source_id = e.source_id AND o.c = e.c AND (o.rel_id, o.side) <> (e.rel_id, e.side) AND e.lo <= o.a AND o.b <= e.hi)),
{_step('scoped', 'antonym', 'rel_id IN (SELECT rel_id FROM lost)')},
{_step('ruled', 'scoped', 'governed')},
{_step('causal', 'ruled', f"type IN ({_list(guards.CAUSAL + guards.CAUSAL_INVERTED)}) AND cf <> cb AND head_first <> CASE WHEN type IN ({_list(guards.CAUSAL_INVERTED)}) THEN cf ELSE cb END")},
{_step('conversion', 'causal', "type = 'converts_to' AND vf <> vb AND head_first <> vf")},
made AS (SELECT DISTINCT source_id, hc, tc FROM conversion WHERE polarity = 'affirmed' AND type IN ({_list(guards.PRODUCTION)})),
{_step('feedback', 'conversion', f"type IN ({_list(guards.ACTIVATION)}) AND EXISTS (SELECT 1 FROM made m WHERE m.source_id = x.source_id AND m.hc = x.tc AND m.tc = x.hc)")},
{_step('selfs', 'feedback', 'NOT sym AND (hc = tc OR lower(trim(h_text)) = lower(trim(t_text)))')},
{_step('fragment', 'selfs', "regexp_matches(trim(h_text), '(?i)^(?:type|class|stage|grade|group|phase|step|form)\\s*[0-9ivx]+$')")},
{_step('vacuous', 'fragment', f"lower(trim(h_text)) IN ({_list(guards.VACUOUS)}) OR lower(trim(t_text)) IN ({_list(guards.VACUOUS)})")},
{_step('structural', 'vacuous', f"type IN ({_list(guards.STRUCTURAL)}) AND deviates")},
enz AS (SELECT DISTINCT source_id, hc AS c FROM structural WHERE polarity = 'affirmed' AND type = 'catalyzes'),
{_step('enzyme', 'structural', "type = 'converts_to' AND EXISTS (SELECT 1 FROM enz e WHERE e.source_id = x.source_id AND (e.c = x.hc OR e.c = x.tc))")},
best AS MATERIALIZED (SELECT *, polarity = 'affirmed' AS ok, row_number() OVER (PARTITION BY source_id, type, hc, tc, polarity = 'affirmed' ORDER BY score DESC, seq) AS nth FROM enzyme),
up AS (SELECT * FROM (VALUES {_PARENTS}) t(child, parent)),
specific AS (SELECT DISTINCT source_id, parent AS type, hc, tc FROM best JOIN up ON type = child WHERE ok AND nth = 1),
final AS MATERIALIZED (SELECT b.*, ok AND nth > 1 AS again, ok AND nth = 1 AND EXISTS (SELECT 1 FROM specific s WHERE s.source_id = b.source_id AND s.type = b.type AND s.hc = b.hc AND s.tc = b.tc) AS subsumed FROM best b)"""
REPORT_SQL = (
    f"WITH {_ROWS} SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{stage}' AS guard, count(*) AS n FROM {name} WHERE f_{name}" for name, stage in STAGES.items())
    + " UNION ALL SELECT 're-duplicate', count(*) FROM final WHERE again UNION ALL SELECT 're-subsumed', count(*) FROM final WHERE subsumed) WHERE n > 0"
    + " UNION ALL SELECT 'affirmed_remaining', count(*) FROM final WHERE polarity = 'affirmed' AND NOT again AND NOT subsumed"
)
KEPT_SQL = f"WITH {_ROWS} SELECT source_id, rel_id, type, polarity FROM final WHERE NOT again AND NOT subsumed"


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return guards.run(t["relations"], t["spans"], t["chunks"])[0].select("source_id", "rel_id", "type", "polarity")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return guards.report(*guards.run(t["relations"], t["spans"], t["chunks"]))
