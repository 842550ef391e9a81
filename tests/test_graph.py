"""Graph side: text functions, N-Quads, selection, named and free queries, assertion, reasoning, guards."""

from __future__ import annotations

import hashlib
from functools import reduce

import pytest
from pyspark.sql import functions as F

from loomgraph import model
from loomgraph.functions import text as T
from loomgraph.model import CATALOG, INST, LABEL, ONT, RDFS, SNOMED, TYPE
from loomgraph.ontology import default, of_table
from loomgraph.operators import assertion, graphs, guards, linking, parsing, postcoordination, questions, reasoning
from loomgraph.operators.extraction import RELATION_REPLY, map_label, parse_reply
from loomgraph.plans import named, sparql
from loomgraph.sources import nquads
from loomgraph.streaming import ingest

GOLDEN = """<meta><title>Thyroid</title>
<src>source: thyroid_source.md | model: m1 | generated: 2026-01-01</src></meta>
<sec id="s1" level="2"><head>Iodine</head>
<con>A deficiency in dietary iodine can lead to goiter.</con>
<key><pt>A deficiency in dietary iodine can lead to goiter.</pt></key>
</sec>
"""
SENTENCE = "A deficiency in dietary iodine can lead to goiter."


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "x string").select(function(F.col("x")).alias("y")).first()["y"]


def stored(df):
    """The rows as a small local table, so that later queries do not plan all that made them."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def tables(spark, modifiers=(), spans=None, relations=None, body=SENTENCE, base=0):
    spans = spans or [("s001", "iodine", body.find("iodine"), "Substance", SNOMED + "62834003", "C0021968"), ("s002", "goiter", body.find("goiter"), "Disease", SNOMED + "3716002", "C0018021")]
    relations = relations or [("r001", "s002", "s001", "caused_by", "affirmed", 0, len(body), 0.9)]
    mods = {"s001": [{"type": t, "text": x, "char_start": None, "char_end": None, "cui": None, "uri": None} for t, x in modifiers]}
    return {
        "documents": spark.createDataFrame([("thyroid_source", "Thyroid", "", "thyroid_source.md", "m1", "2026-01-01")], model.DOCUMENTS),
        "chunks": spark.createDataFrame([("thyroid_source", "c001", 0, body, base, base + len(body), ["Thyroid", "Iodine"], "prose", [], [], "iodine")], model.CHUNKS),
        "spans": spark.createDataFrame([("thyroid_source", i, "c001", n, t, base + a, base + a + len(t), label, False, mods.get(i, []), cui, uri, 1.0, None) for n, (i, t, a, label, uri, cui) in enumerate(spans)], model.SPANS),
        "relations": spark.createDataFrame([("thyroid_source", i, n, h, t, y, p, base + a, base + b, s) for n, (i, h, t, y, p, a, b, s) in enumerate(relations)], model.RELATIONS),
    }


def test_text_functions(spark):
    assert one(spark, "Héllo, World -- x!", T.slug) == "h-llo-world-x"
    assert one(spark, 'H<sub>2</sub>O in <figref id="f1">Fig. 1</figref>', T.normalise_inline) == "H2O in Fig. 1[[FIG:f1]]"
    assert one(spark, "see [[FIG:f1]] and[[TBL:t2]].", T.lift_anchors) == "see and."
    assert one(spark, "source: a: b | figures: 2 | source: c", T.parse_source_line) == {"figures": "2", "source": "c"}
    assert one(spark, "Keep this. Drop $x^2$ now. Keep 2 too.\n$y$ only.", T.drop_formula_sentences) == "Keep this. Keep 2 too.\n"
    assert one(spark, r"at $2.0 \times 10^{-2}$ a", T.flatten_math) == "at 2.0×10-2 a"
    assert one(spark, "# Head\n- **bold** item\n\n  1. a  b", T.clean_text) == "Head\nbold item\na b"
    assert one(spark, "- a\n- b\nc", T.split_items) == ["a", "b"]
    assert one(spark, "Short heading", T.looks_structured) and not one(spark, "A sentence that ends. Another one.", T.looks_structured)
    assert one(spark, "A  b C", T.duplicate_key) == "a b c"


def test_golden_parse(spark):
    meta, segments = parsing.segments_of(GOLDEN)
    assert meta["title"] == "Thyroid" and meta["model"] == "m1"
    below = ["Thyroid", "Iodine"]
    assert [(s["kind"], s["level"], s["section_id"], s["section_path"]) for s in segments] == [("heading", 1, "", []), ("heading", 2, "iodine", below), ("prose", 0, "iodine", below), ("keypoint", 0, "iodine", below)]
    rows = stored(parsing.parse_documents(spark.createDataFrame([("/x/thyroid.md", GOLDEN)], "path string, text string")))
    found = {k: stored(v) for k, v in parsing.assemble(rows).items()}
    chunks = found["chunks"].orderBy("seq").collect()
    assert [(c["source_id"], c["chunk_id"], c["kind"], c["duplicate_of"], c["char_start"], c["char_end"]) for c in chunks] == [("thyroid_source", "c001", "prose", None, 22, 72), ("thyroid_source", "c002", "duplicate", "c001", 74, 124)]
    assert parsing.normalised_text(found["pieces"]).first()["normalized_text"] == f"# Thyroid\n\n## Iodine\n\n{SENTENCE}\n\n{SENTENCE}\n\n"
    assert parsing.misplaced(found["chunks"], parsing.normalised_text(found["pieces"])).count() == 0
    assert [(r["stage"], r["duplicate_of"]) for r in found["review"].collect()] == [("stage1-duplicate", "c001")]


def test_media(spark):
    text = """<meta><title>T</title></meta><sec><head>H</head><con>See it<figref id="f1">here</figref> and <tblref id="t1">there</tblref> well.</con>
<fig id="f1" src="a.png" label="1-1"><cap>Shows x</cap><desc>One claim. Two claims.</desc></fig><fig><cap>Lost</cap></fig><fig id="f2"><cap>Shows y</cap></fig>
<tbl id="t1" label="2"><cap>Grid</cap><con>Row one is here.</con></tbl><tbl id="t2"></tbl><tbl id="t3"><cap>Empty</cap></tbl><note status="failed">section</note><con>This part could not be generated.</con></sec>"""
    found = {k: stored(v) for k, v in parsing.assemble(stored(parsing.parse_documents(spark.createDataFrame([("/x/doc.md", text)], "path string, text string")))).items()}
    laid = parsing.normalised_text(found["pieces"]).first()["normalized_text"]
    bound = parsing.bind_media(found)
    figures = {r["ref"]: r for r in bound["figures"].collect()}
    assert set(figures) == {"f1", "f2"} and figures["f1"]["src"] == "a.png" and figures["f1"]["referenced_from"] == "c001" and figures["f1"]["content_chunk"] == "c002" and figures["f2"]["content_chunk"] is None
    assert all(laid[slice(*r["caption_span"])] == r["caption"] for r in figures.values())
    tables_ = {r["ref"]: (r["caption"], r["content_chunk"], r["referenced_from"]) for r in bound["tables"].collect()}
    assert tables_ == {"t1": ("Grid", "c003", "c001"), "t3": ("Empty", None, None)}
    assert sorted((r["ref"], r["reason"]) for r in bound["review"].collect()) == [("f2", "figure has no src image"), ("f2", "figure never anchored in prose"), ("t3", "table has no restated content"), ("t3", "table never cited in prose")]
    assert sorted((r["stage"], r["text"]) for r in found["review"].collect()) == [("stage1-figure", "figure block with no id"), ("stage1-tagged", "This part could not be generated."), ("stage1-tagged", "section")]
    assert parsing.misplaced(found["chunks"], parsing.normalised_text(found["pieces"])).count() == 0


def test_merge_caps(spark):
    rows = spark.createDataFrame([("d", k, "prose" if k != 3 else "table", "s", "x" * n) for k, n in enumerate([5, 6, 10, 4, 3])], "source_id string, seq long, kind string, section_id string, text string")
    got = [(r["chunk_id"], r["char_start"], r["char_end"], r["n_segments"]) for r in parsing.merge_segments(rows, most=14).orderBy("seq").collect()]
    assert got == [("c001", 0, 13, 2), ("c002", 15, 25, 1), ("c003", 27, 31, 1), ("c004", 33, 36, 1)]


def test_golden_quads(spark):
    t = tables(spark, modifiers=[("deviation", "A deficiency in")])
    t["instances"], review = postcoordination.post_coordinate(t["spans"])
    t["instances"] = stored(t["instances"])
    inst = t["instances"].first()
    listed = f"[('{ONT}hasDeviation', '{ONT}Deficiency')]"
    assert inst["inst_id"] == INST + hashlib.sha1(f"thyroid_source|C0021968|{listed}".encode()).hexdigest()[:12]
    assert inst["label"] == "iodine [deficiency]" and review.count() == 0
    quads = stored(assertion.assert_documents(t))
    assert quads.count() == 33
    rows = named.run("relations", quads).collect()
    assert [tuple(r) for r in rows] == [("goiter", "caused_by", "iodine [deficiency]", 0.9, 1)]
    assert named.run("flagged", quads).count() == 0 and named.run("evidence", quads).count() == 1
    assert named.about(graphs.flatten(quads), "GOITER").where("direction = 'out'").count() > 0


def exchanges(df):
    """Keys by which the plan deals rows out."""
    import re

    return re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*?)(?:, ENSURE_REQUIREMENTS|, \d+\))", df._jdf.queryExecution().executedPlan().toString())


def test_store_is_a_set_without_dealing_quads(spark):
    t = tables(spark, relations=[("r001", "s002", "s001", "caused_by", "affirmed", 0, 5, 0.9), ("r002", "s002", "s001", "caused_by", "affirmed", 0, 5, 0.9), ("r003", "s002", "s001", "caused_by", "affirmed", 0, 5, 0.5), ("r004", "s002", "s001", "caused_by", "negated", 0, 5, 0.5), ("r005", "s001", "s009", "caused_by", "affirmed", 0, 5, None), ("r006", "s002", "s001", "stimulates", "affirmed", 0, 5, None)])
    store = assertion.store(t, spark.createDataFrame([("endo", "thyroid_source")], "name string, source_id string"))
    whole = sorted(map(str, store.quads.collect()))
    assert whole == sorted(map(str, store.by_predicate.collect())) and len(whole) == len(set(whole))
    # one fact stated three times is a triple and a statement with two confidences; one without a score is a triple; two are assertions
    assert store.quads.where(F.col("g") == model.GRAPH + "thyroid_source/iodine").count() == 1 + 5 + 2 + 1 + 5 + 4
    assert sorted(map(str, named.unfold(store.subjects(INST)).collect())) == sorted(map(str, named.instances(graphs.flatten(store.quads)).collect()))
    part, asked = store.subset(sections=("iodine",)), graphs.subset(store.quads, sections=("iodine",))
    assert sorted(map(str, part.quads.collect())) == sorted(map(str, asked.collect()))
    with pytest.raises(ValueError):
        store.subset(sections=("nope",))
    # counting graphs deals out graph names only, and joins on a node deal out nothing
    assert all(x.startswith(("g#", "n#")) for x in exchanges(graphs.describe(store.quads, distinct=True)))
    triples = graphs.load_graph(store.by_predicate, skip=("inferred",))
    about = lambda p: triples.where(F.col("p") == ONT + p).select("s", F.col("o").alias(p))
    assert exchanges(about("about").join(about("polarity").hint("merge"), "s").join(about("target").hint("merge"), "s", "left")) == []


def test_store_of_a_document_named_as_a_graph(spark):
    t = {k: v.withColumn("source_id", F.lit("catalog")) for k, v in tables(spark).items()}
    t["chunks"] = t["chunks"].withColumn("section_id", F.lit(""))
    rows = assertion.store(t).quads.where(F.col("g") == CATALOG)
    assert rows.where(F.col("p") == ONT + "caused_by").count() == 1 == rows.where(F.col("p") == ONT + "confidence").count()


def test_governed_variant(spark):
    t = tables(spark)
    kept, review = guards.run(t["relations"], t["spans"], t["chunks"])
    assert [r["polarity"] for r in kept.collect()] == ["uncertain"] and [r["stage"] for r in review.collect()] == ["re-governed-role"]
    quads = stored(assertion.assert_documents(t | {"relations": stored(kept.select(*t["relations"].columns))}))
    assert quads.where(F.col("g") == model.GRAPH + "thyroid_source/iodine").count() == 5
    assert named.run("relations", quads).count() == 0 and named.run("flagged", quads).count() == 1 == named.run("negated", quads).count()


def guard_stages(spark, body, spans, relations, modifiers=()):
    placed = [(i, t, body.find(t), label, uri, "C") for i, t, label, uri in spans]
    t = tables(spark, modifiers, placed, [(i, h, x, y, "affirmed", 0, len(body), s) for i, h, x, y, s in relations], body)
    kept, review = guards.run(t["relations"], t["spans"], t["chunks"])
    return sorted((r["rel_id"], r["stage"]) for r in review.collect()), {r["rel_id"]: r["polarity"] for r in kept.collect()}


def test_guards(spark):
    thyroid = [("s001", "hyperthyroidism", "Disease", None), ("s002", "hypothyroidism", "Disease", None), ("s003", "thyroid hormones", "Substance", "u:t")]
    fired, _ = guard_stages(spark, "hyperthyroidism, hypothyroidism and thyroid hormones.", thyroid, [("r1", "s001", "s003", "caused_by", 0.9), ("r2", "s002", "s003", "caused_by", 0.8)])
    assert fired == [("r1", "re-antonym-conflict"), ("r2", "re-antonym-conflict")]
    pair = [("s001", "TRH", "Substance", "u:1"), ("s002", "TSH", "Substance", "u:2")]
    fired, kept = guard_stages(spark, "TRH and TSH.", pair, [("r1", "s001", "s002", "stimulates", 0.7), ("r2", "s001", "s002", "stimulates", 0.9), ("r3", "s001", "s002", "regulates", 0.9)])
    assert fired == [("r1", "re-duplicate"), ("r3", "re-subsumed")] and kept == {"r2": "affirmed"}
    fired, _ = guard_stages(spark, "TRH and TSH.", pair, [("r1", "s001", "s002", "converts_to", 0.7), ("r2", "s002", "s001", "converts_to", 0.9), ("r3", "s001", "s002", "connects_to", 0.9), ("r4", "s002", "s001", "connects_to", 0.9)])
    assert fired == [("r1", "re-direction"), ("r2", "re-direction")]
    loop = [("s001", "hypothalamus", "BodyStructure", "u:h"), ("s002", "TRH", "Substance", "u:r")]
    fired, _ = guard_stages(spark, "hypothalamus and TRH.", loop, [("r1", "s001", "s002", "secretes", 0.9), ("r2", "s002", "s001", "stimulates", 0.9)])
    assert fired == [("r2", "re-feedback-loop")]
    graves = [("s001", "Graves' disease", "Disease", "u:g"), ("s002", "hyperthyroidism", "Disease", "u:h")]
    body = "Graves' disease is a frequent cause of hyperthyroidism"
    assert guard_stages(spark, body, graves, [("r1", "s001", "s002", "caused_by", 0.9)])[0] == [("r1", "re-causal-direction")]
    assert guard_stages(spark, body, graves, [("r1", "s002", "s001", "caused_by", 0.9)])[0] == []
    odd = [("s001", "Type 3", "Protein", "u:a"), ("s002", "organ", "BodyStructure", "u:b"), ("s003", "Thyroxine", "Substance", "u:c"), ("s004", "thyroxine", "Substance", "u:d")]
    fired, _ = guard_stages(spark, "Type 3, organ, Thyroxine, thyroxine.", odd, [("r1", "s001", "s003", "catalyzes", 0.9), ("r2", "s003", "s002", "located_in", 0.9), ("r3", "s003", "s004", "converts_to", 0.9)])
    assert fired == [("r1", "re-fragment-span"), ("r2", "re-vacuous-endpoint"), ("r3", "re-self-loop")]


def test_guards_at_places_beyond_an_int(spark):
    t, far = tables(spark), 5_000_000_000
    moved = {k: t[k].withColumns({c: (F.col(c).cast("long") + far) for c in columns}) for k, columns in (("spans", ("char_start", "char_end")), ("chunks", ("char_start", "char_end")), ("relations", ("evidence_start", "evidence_end")))}
    kept, review = guards.run(moved["relations"], moved["spans"], moved["chunks"])
    assert [r["polarity"] for r in kept.collect()] == ["uncertain"] and [r["stage"] for r in review.collect()] == ["re-governed-role"]


@pytest.mark.parametrize("few", [0, 20_000])
def test_guards_with_few_and_many_hits(spark, monkeypatch, few):
    monkeypatch.setattr(guards, "FEW", few)
    monkeypatch.setattr(guards, "STRETCH", 8)
    body = "hypothalamus acts on TRH. Later it says TSH and enzyme."
    spans = [("s001", "hypothalamus", body.find("hypothalamus"), "BodyStructure", "u:h", "C"), ("s002", "TRH", body.find("TRH"), "Substance", "u:r", "C"), ("s003", "TSH", body.find("TSH"), "Substance", "u:s", "C"), ("s004", "acts", body.find("acts"), "Substance", "u:s", "C"), ("s005", "enzyme", body.find("enzyme"), "Protein", "u:e", "C")]
    relations = [("r1", "s001", "s002", "secretes", "affirmed", 0, 20, 0.9), ("r2", "s002", "s001", "stimulates", "affirmed", 0, 20, 0.9), ("r3", "s001", "s005", "regulates", "affirmed", 0, 20, 0.9), ("r4", "s001", "s003", "regulates", "affirmed", 0, 20, 0.9), ("r5", "s005", "s003", "catalyzes", "affirmed", 26, 50, 0.9), ("r6", "s005", "s003", "converts_to", "affirmed", 26, 50, 0.9)]
    t = tables(spark, (), spans, relations, body)
    kept, review = guards.run(t["relations"], t["spans"], t["chunks"])
    # r4's tail stands elsewhere, but another mention of its concept is in the sentence
    assert sorted((r["rel_id"], r["stage"]) for r in review.collect()) == [("r2", "re-feedback-loop"), ("r3", "re-evidence-scope"), ("r6", "re-enzyme-as-substrate")]
    assert {r["rel_id"]: r["polarity"] for r in kept.collect()} == {"r1": "affirmed", "r2": "uncertain", "r3": "uncertain", "r4": "affirmed", "r5": "affirmed", "r6": "uncertain"}
    assert kept.columns == ["source_id", "rel_id", "seq", "head", "tail", "type", "evidence_start", "evidence_end", "score", "polarity"]


def test_guards_leave_no_replaced_table(spark):
    from pathlib import Path

    t, shared = tables(spark), Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {x.name for x in shared.iterdir()} if shared.exists() else set()
    guards.run(t["relations"], t["spans"], t["chunks"])
    # neither contexts nor the joins before them stay
    assert not [x.name for x in shared.iterdir() if x.name not in before and x.name.startswith(("context", "heads", "tails", "ends"))]


def test_degenerate_confidence(spark):
    rows = spark.createDataFrame([("d", f"r{k}", k, 0.9 if k else 0.5) for k in range(10)] + [("e", f"r{k}", k, 0.9) for k in range(7)], "source_id string, rel_id string, seq long, score double")
    assert [tuple(r) for r in guards.degenerate_confidence(rows).collect()] == [("d", 0.9, 9, 10)]


def test_validate(spark):
    t = tables(spark)
    ask = [("c001", "results_in", "s001", "s002", SENTENCE, 0.9), ("c001", "nothing", "s001", "s002", SENTENCE, 0.9), ("c001", "caused_by", "s002", "s009", SENTENCE, 0.9), ("c001", "caused_by", "s002", "s001", "no such quote", 0.9), ("c001", "caused_by", "s002", "s001", SENTENCE, 0.49), ("c001", "caused_by", "s001", "s002", SENTENCE, 0.5)]
    rows = spark.createDataFrame([("thyroid_source", *a) for a in ask], "source_id string, chunk_id string, type string, head string, tail string, evidence string, confidence double")
    codes = sorted(str(r["code"]) for r in guards.validate(rows, t["spans"], t["chunks"]).collect())
    assert codes == ["None", "below-floor", "head-label:caused_by", "tail-span-missing", "ungrounded-evidence", "unknown-type"]


def test_nquads_round_trip(spark, tmp_path):
    hard = 'a "b" \\ c\nd\té <x> \\n'
    rows = [("u:s", "u:p", hard, "lit", None, None, "u:g"), ("u:s", "u:p", "5", "lit", model.XSD + "integer", None, "u:g"), ("_:b", "u:p", "chat", "lit", None, "fr", "u:g"), ("u:s", "u:p", "u:o", "iri", None, None, None), ("a literal", "u:p", "u:o", "iri", None, None, "u:g")]
    quads = spark.createDataFrame(rows, model.QUAD)
    assert nquads.write(quads, f"{tmp_path}/q") == {"written": 4, "removed_literal_subjects": 1}
    assert sorted(map(str, nquads.read(spark, f"{tmp_path}/q").collect())) == sorted(map(str, quads.where("s <> 'a literal'").collect()))


def test_scopes(spark):
    t = tables(spark)
    quads = stored(assertion.assert_documents(t, spark.createDataFrame([("endo", "thyroid_source")], "name string, source_id string")))
    resolved = lambda **k: (lambda g, p: (sorted(r["g"] for r in g.collect()), p))(*graphs.resolve_scopes(quads, **k))
    assert resolved(sections=("IODINE",)) == (["urn:graph:thyroid_source/iodine"], [])
    assert resolved(documents=("thyr",))[0] == ["urn:graph:thyroid_source/iodine"]
    assert resolved(groups=("endo",), sections=("nope",)) == ([], ["no section matches 'nope' in urn:graph:thyroid_source"])
    part = graphs.subset(quads, documents=("Thyroid",))
    assert part.where(F.col("g") == CATALOG).count() > 0 and graphs.describe(part).count() >= 3
    with pytest.raises(ValueError):
        named.run("inferred", quads, documents=("Thyroid",))
    with pytest.raises(ValueError):
        graphs.check_source_ids(t["documents"].union(t["documents"]))


def test_sparql_equals_plans(spark):
    triples = stored(graphs.flatten(assertion.assert_documents(tables(spark, [("deviation", "deficiency")]))))
    text = """SELECT ?label ?concept ?mentions WHERE { ?concept rdfs:label ?label . OPTIONAL { ?concept ont:mentionCount ?mentions } } ORDER BY DESC(?mentions) ?label"""
    a = [(r["label"], r["concept"], r["mentions"]) for r in sparql.query(triples, text).collect()]
    assert sorted(map(str, a)) == sorted(str((r["label"], r["concept"], None if r["mentions"] is None else str(r["mentions"]))) for r in named.concepts(triples).collect())
    text = """PREFIX o: <%s> SELECT DISTINCT ?s WHERE { { ?s a o:Section } UNION { ?s a o:Document } FILTER(STRSTARTS(STR(?s), "urn:graph:") && !CONTAINS(STR(?s), "zzz")) BIND("x" AS ?y) } LIMIT 5""" % ONT
    assert {r["s"] for r in sparql.query(triples, text).collect()} == {"urn:graph:thyroid_source", "urn:graph:thyroid_source/iodine"}
    text = "SELECT ?p (COUNT(*) AS ?n) WHERE { VALUES ?p { rdfs:label rdf:type } ?s ?p ?o } GROUP BY ?p HAVING (?n > 1) ORDER BY DESC(?n)"
    assert {r["p"] for r in sparql.query(triples, text).collect()} == {LABEL, TYPE}
    with pytest.raises(sparql.SyntaxProblem):
        sparql.query(triples, "SELECT ?s WHERE { ?s nope:x ?o }")


def test_reasoning(spark):
    a, b, c = (SNOMED + x for x in "123")
    rows = [("u:x", TYPE, a), ("u:x", ONT + "complication_of", "u:y"), ("u:z", ONT + "caused_by", "u:x")]
    triple = lambda r: spark.createDataFrame([(*x, "iri", None, None) for x in r], "s string, p string, o string, o_kind string, o_dt string, o_lang string")
    schema = reasoning.axioms(spark, more=triple([(a, RDFS + "subClassOf", b), (b, RDFS + "subClassOf", c), (c, RDFS + "subClassOf", a)]))
    got = {(r["s"], r["p"], r["o"]) for r in reasoning.close(triple(rows), schema).collect()}
    assert {("u:x", TYPE, b), ("u:x", TYPE, c), ("u:x", ONT + "caused_by", "u:y"), (a, RDFS + "subClassOf", c)} <= got
    assert ("u:z", ONT + "caused_by", "u:y") not in got and not any((s, p, o) in got for s, p, o in rows)
    more = {(r["s"], r["o"]) for r in reasoning.close(triple(rows), schema, transitive_properties=(ONT + "caused_by",)).collect()}
    assert ("u:z", "u:y") in more


def test_linking(spark):
    atoms = spark.createDataFrame([("C1", [1.0, 0.0]), ("C1", [0.9, 0.1]), ("C2", [0.96, 0.28]), ("C3", [0.0, 1.0])], "cui string, vector array<double>")
    asked = spark.createDataFrame([("q1", [1.0, 0.0]), ("q2", [0.1, 0.2])], "query string, vector array<double>")
    found = linking.top_k(asked, atoms, k=2)
    assert [(r["cui"], r["score"]) for r in found.where("query = 'q1'").orderBy("rank").collect()] == [("C1", 1.0), ("C2", 0.96)]
    assert {r["query"] for r in linking.needs_rerank(found).collect()} == {"q1", "q2"}
    assert [r["query"] for r in linking.link(found).collect()] == ["q1"]
    spans = spark.createDataFrame([("d", "c", f"s{k}", k, a, b) for k, (a, b) in enumerate([(0, 5), (3, 12), (10, 14), (13, 15)])], "source_id string, chunk_id string, span_id string, seq long, char_start int, char_end int")
    assert sorted(r["span_id"] for r in linking.longest_spans(spans).collect()) == ["s1", "s3"]


def test_top_k_in_blocks_and_with_ties(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(linking, "QUERY_BLOCK", 3)
    monkeypatch.setattr(linking, "ATOM_BLOCK", 7)
    vectors = np.random.default_rng(1).normal(size=(20, 24))
    rows = [(f"{k + 20 * copy:03d}", (vectors[k] / np.sqrt((vectors[k] ** 2).sum())).tolist()) for copy in range(3) for k in range(20)]
    atoms = spark.createDataFrame(rows, "cui string, vector array<double>")
    asked = atoms.where("CAST(cui AS INT) % 5 = 0").select(F.col("cui").alias("query"), "vector")
    dot = lambda a, b: reduce(lambda all_, xy: all_ + xy[0] * xy[1], zip(a, b), 0.0)  # noqa: E731  sum() would make up for rounding
    held = dict(rows)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one task has all blocks
    try:
        for own in (False, True):
            got = {}
            for r in linking.top_k(asked, atoms, k=4, own_first=own).orderBy("query", "rank").collect():
                got.setdefault(r["query"], []).append((r["cui"], r["score"]))
            want = {q: sorted(((c, dot(held[q], v)) for c, v in rows), key=lambda x: (-x[1], own and x[0] != q, x[0]))[:4] for q in held if int(q) % 5 == 0}  # noqa: B023
            assert got == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_pair_counts_equal_pairs(spark):
    labels = ("Drug", "Disease", "Cell", "Finding", "Organism", "Nonsense")
    rows = [("d", f"c{k % 3}", f"s{k}", labels[k % 6]) for k in range(40)] + [("d", "c0", "s0", "Disease"), ("d", "c0", "s3", "Finding"), ("d", "c9", "s99", "Drug"), ("d", "c1", "s1", None)]
    spans = spark.createDataFrame(rows, "source_id string, chunk_id string, span_id string, label string")
    plan = guards.pair_counts(spans)
    want = guards.candidate_pairs(spans).groupBy("source_id", "chunk_id").count()
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, want.collect()))
    # 20,000 spans in one chunk are 400 million pairs
    many = spark.range(20_000).select(F.lit("d").alias("source_id"), F.lit("c").alias("chunk_id"), F.col("id").cast("string").alias("span_id"), F.when(F.col("id") % 2 == 0, "Drug").otherwise("Disease").alias("label"))
    admitted = {(r["head_label"], r["tail_label"]) for r in default().admitted(spark, hierarchy=False).collect()}
    n = sum(10_000 * (10_000 - (a == b)) for a in ("Drug", "Disease") for b in ("Drug", "Disease") if (a, b) in admitted)
    assert [r["pairs"] for r in guards.pair_counts(many).collect()] == [n]


def test_ontology(spark):
    o = default()
    assert len(o.relations) == 27 and o.satisfies("Drug", frozenset({"Substance"})) and not o.satisfies(None, frozenset({"Substance"}))
    names = {r["name"]: (r["type"], r["swap"]) for r in o.names(spark).collect()}
    assert names["activates"] == ("stimulates", False) and names["leads_to"] == ("caused_by", True) and len(names) == 27 + 37
    ends = {"head": ["X"], "tail": ["Y"]}
    broken = of_table({"a": ends | {"parent": "b"}, "b": ends | {"parent": "a"}, "c": {"head": ["Q"], "tail": ["Y"], "parent": "zz"}})
    kinds = {(p["kind"], p["name"]) for p in broken.problems(["X", "Y"])}
    assert kinds == {("type-cycle", "a"), ("type-cycle", "b"), ("unknown-parent", "c"), ("unreachable-head", "c")}


def test_replies(spark):
    good = '<think>[1]</think>```json\n[{"head_id":"a","tail_id":"b","type":"x","polarity":"affirmed","evidence":"e","confidence":0.5}]\n```'
    assert len(one(spark, good, lambda c: parse_reply(c, RELATION_REPLY))) == 1
    assert one(spark, "no json", lambda c: parse_reply(c, RELATION_REPLY)) == [] == one(spark, None, lambda c: parse_reply(c, RELATION_REPLY))
    assert one(spark, "GENE_OR_GENE_PRODUCT", lambda c: map_label(c, {"DISEASE": "Disease"})) == "GeneOrGeneProduct"


def test_questions(spark):
    body = "The pituitary gland secretes growth hormone into the blood. " + " ".join(f"Substance{chr(97 + k)} is here." for k in range(6))
    spans = [("s001", "pituitary gland", body.find("pituitary gland"), "BodyStructure", "u:p", "C")] + [("s002", "growth hormone", body.find("growth hormone"), "Substance", "u:g", "C")]
    spans += [(f"s1{k}", f"Substance{chr(97 + k)}", body.find(f"Substance{chr(97 + k)}"), "Substance", f"u:{k}", "C") for k in range(6)]
    t = tables(spark, (), spans, [("r001", "s001", "s002", "secretes", "affirmed", 0, 59, 0.9), ("r002", "s001", "s10", "secretes", "uncertain", 0, 59, 0.9)], body)
    items = questions.build(t["relations"], t["spans"], t["chunks"]).collect()
    assert len(items) == 1 and items[0]["answer"] == "growth hormone" in items[0]["options"] and len(items[0]["options"]) == 5
    assert "substancea" not in items[0]["options"] and items[0]["rationale"].startswith("The pituitary gland secretes")


def test_incremental_ingest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.md").write_text(GOLDEN)
    for expected in (4, 4, 8):  # the second run finds nothing new, the third one new file
        if expected == 8:
            (folder / "b.md").write_text(GOLDEN.replace("thyroid_source", "other"))
        ingest.ingest(spark, str(folder), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == expected


def test_registry_answers(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["subject", "predicate", "object", "confidence", "extractions"]


def test_media_quads_are_counted_by_one_distinct_at_a_time(spark):
    from loomgraph.plans import more

    plan = more.QUERIES["media_quads"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning(p_partkey" in plan


def test_texts_are_made_by_several_tasks(spark, monkeypatch):
    from loomgraph.plans import more

    monkeypatch.setattr(more, "PART_ROWS", 20)
    n = spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
    assert more.QUERIES["texts_marked"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == max(3, -(-n // 20)) > 1
