"""From extraction tables to quads: relations, assertions, instances, figures, tables, provenance, catalog, labels."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model
from ..model import CATALOG, DCT, GROUP, INFERRED, INST, LABEL, LABELS, ONT, PROV, PROVENANCE, RDF, TYPE, XSD, det_id, document_graph, iri, literal, quads_of, section_graph
from ..ontology import Ontology, default
from ..sources.tables import bucketed, materialise, pieces, release

#: Relations in a bucket of the store, about; graph names that are sent to all.
NODE_ROWS, NAMES = 150_000, 10_000


def sections(chunks: DataFrame, passages: DataFrame | None = None) -> DataFrame:
    """Sections of each document in order of first appearance, chunks before passages; ``order`` counts from 1."""
    rows = chunks.select("source_id", "section_id", "section_path", F.lit(0).alias("part"), "seq")
    if passages is not None:
        rows = rows.unionByName(passages.select("source_id", "section_id", "section_path", F.lit(1).alias("part"), "seq"))
    at = F.struct("part", "seq")
    first = rows.where("coalesce(section_id, '') <> ''").groupBy("source_id", "section_id").agg(F.min(at).alias("at"), F.min_by("section_path", at).alias("section_path"))
    order = F.row_number().over(Window.partitionBy("source_id").orderBy("at"))
    return first.select("source_id", "section_id", "section_path", order.alias("order"))


def endpoints(spans: DataFrame, chunks: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """Each span with the node that relations attach to (its instance, or else its concept) and its graph."""
    rows = spans.join(chunks.select("source_id", "chunk_id", "section_id"), ["source_id", "chunk_id"], "left")
    if instances is None:
        node = F.col("uri")
    else:
        own = instances.groupBy("source_id", F.col("source_span").alias("span_id")).agg(F.min("inst_id").alias("inst_id"))
        rows, node = rows.join(own, ["source_id", "span_id"], "left"), F.coalesce("inst_id", "uri")
    return rows.select("source_id", "span_id", "uri", node.alias("node"), section_graph(F.col("source_id"), F.col("section_id")).alias("g"))


def relation_rows(relations: DataFrame, ends: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """For each relation whose head is linked the node that stands for it, its graph, ends and predicate.

    Affirmed ones with a linked tail are facts, whose node holds the graph, so
    equal facts of two documents stay apart; all others are assertions.
    ``more`` is the score of a fact or the polarity of an assertion.
    """
    types = (ontology or default()).types(relations.sparkSession).select("type", F.col("uri").alias("pred"))
    side = lambda x, *more: ends.select("source_id", F.col("span_id").alias(x), F.col("uri").alias(f"{x}_uri"), F.col("node").alias(f"{x}_node"), *more)
    claim = det_id(F.col("source_id"), F.col("rel_id"), F.col("head_uri"), F.col("type"))
    # what names an assertion is worked out here, so that the second exchange is spared the long ids
    rows = relations.join(side("head", F.col("g")), ["source_id", "head"]).where("head_uri IS NOT NULL")
    rows = materialise(rows.select("source_id", "tail", "type", "polarity", "score", F.col("head_node").alias("h"), "g", claim.alias("claim")), "heads")
    linked = F.coalesce(F.nullif("tail_uri", F.lit("")).isNotNull(), F.lit(False))
    joined = rows.join(side("tail"), ["source_id", "tail"], "left").join(F.broadcast(types), "type")
    joined = joined.select("g", "h", "pred", F.when(linked, F.col("tail_node")).alias("t"), (F.coalesce(F.col("polarity") == "affirmed", F.lit(False)) & linked).alias("fact"), "polarity", "score", "claim")
    fact = F.col("fact")
    node = F.when(fact, F.concat(F.lit(INST + "stmt/"), det_id(F.col("g"), F.col("h"), F.col("pred"), F.col("t")))).otherwise(F.concat(F.lit(INST + "assert/"), F.col("claim")))
    polarity = F.concat(F.lit(ONT), F.upper(F.substring("polarity", 1, 1)), F.expr("substring(polarity, 2)"))
    out = joined.select(node.alias("s"), "g", "fact", "h", F.col("pred").alias("p"), "t", F.when(fact, F.round("score", 3).cast("string")).otherwise(polarity).alias("more"))
    out = materialise(out, "tails")  # before the next exchange, so that the files of this one are gone by then
    release(rows)
    return out


def relation_nodes(rows: DataFrame, buckets: int) -> DataFrame:
    """One row for each node and graph with all that is said of it: the quads as a set, before they take up room.

    Ids are cut hashes, so a node may stand for two relations; sets of values
    keep the quads distinct then.
    """
    stated = ~F.col("fact") | F.col("more").isNotNull()
    kept = lambda c: F.collect_set(F.when(stated, F.col(c)))
    nodes = rows.repartition(buckets, "s").groupBy("s", "g", "fact").agg(
        kept("h").alias("h"), kept("p").alias("p"), kept("t").alias("t"), F.collect_set("more").alias("more"), F.collect_set(F.when(F.col("fact"), F.struct("h", "p", "t"))).alias("triples"),
    )
    return bucketed(nodes.sortWithinPartitions("fact", "s"), "nodes", "s", buckets)


def _said(fact: bool) -> list[tuple[str, str, str | None, bool]]:
    """Of what nodes of a kind have: predicate, column of values or a constant, datatype, and whether literal."""
    if fact:
        return [
            (TYPE, RDF + "Statement", None, False), (RDF + "subject", "h", None, False), (RDF + "predicate", "p", None, False), (RDF + "object", "t", None, False),
            (ONT + "confidence", "more", XSD + "double", True), (ONT + "extractedBy", "llm-re", None, True),
        ]
    return [
        (TYPE, ONT + "ClinicalAssertion", None, False), (ONT + "about", "h", None, False), (ONT + "assertionType", "p", None, False), (ONT + "polarity", "more", None, False), (ONT + "target", "t", None, False),
    ]


_COLUMNS = ("h", "p", "t", "more")


def node_quads(nodes: DataFrame, by_predicate: bool = False) -> DataFrame:
    """The quads under the nodes themselves, in one pass, or as a select for each predicate, so that a query reads only those that it names."""
    if not by_predicate:
        return nodes.select("s", "g", F.explode(_held()).alias("x")).select("s", "x.*", "g")
    none = F.lit(None).cast("string")
    parts = []
    for fact in (True, False):
        for p, value, kind, text in _said(fact):
            rows = nodes.where(F.col("fact") == fact) if value in _COLUMNS else nodes.where((F.col("fact") == fact) & (F.size("h") > 0))
            o = F.explode(value) if value in _COLUMNS else F.lit(value)
            parts.append(rows.select("s", F.lit(p).alias("p"), o.alias("o"), F.lit("lit" if text else "iri").alias("o_kind"), F.lit(kind).cast("string").alias("o_dt"), none.alias("o_lang"), "g"))
    return model.union(parts)


def _held() -> Column:
    """All that is said of a node: an array of (p, o, o_kind, o_dt, o_lang)."""
    nothing = F.array().cast("array<string>")

    def listed(fact: bool) -> Column:
        each = lambda p, kind, text: lambda o: F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit("lit" if text else "iri").alias("o_kind"), F.lit(kind).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
        values = lambda value: F.coalesce(F.col(value), nothing) if value in _COLUMNS else F.when(F.size("h") > 0, F.array(F.lit(value))).otherwise(nothing)
        return F.concat(*(F.transform(values(value), each(p, kind, text)) for p, value, kind, text in _said(fact)))

    return F.when(F.col("fact"), listed(True)).otherwise(listed(False))


def node_triples(nodes: DataFrame) -> DataFrame:
    """The facts themselves."""
    return nodes.where("fact").select("g", F.inline("triples").alias("s", "p", "o")).select(*iri(F.col("s"), F.col("p"), F.col("o"), F.col("g")))


def instance_quads(instances: DataFrame, ends: DataFrame) -> DataFrame:
    """Type, attributes and label of post-coordinated instances, in the graph of their span."""
    rows = instances.join(ends.select("source_id", F.col("span_id").alias("source_span"), "g"), ["source_id", "source_span"], "left")
    g = F.coalesce("g", document_graph(F.col("source_id")))
    i = F.col("inst_id")
    attributes = rows.select("inst_id", g.alias("g"), F.explode("attributes").alias("a"))
    labels = F.nullif("label", F.lit(""))
    return model.union([quads_of(rows, [iri(i, TYPE, F.col("type_uri"), g), literal(i, LABEL, labels, g)]), attributes.select(*iri(i, F.col("a.prop"), F.col("a.value"), F.col("g")))])


def _nodes(kind: str, rows: Column, key: Column) -> Column:
    return F.when(key.isNotNull() & (key != ""), F.concat(F.lit(f"{INST}{kind}/"), rows, F.lit("/"), key))


def media_quads(figures: DataFrame, tables: DataFrame, chunks: DataFrame) -> DataFrame:
    """Figures, tables, and the chunks that they cite; a description is text only where no chunk holds it."""
    src = F.col("source_id")
    g = section_graph(src, F.col("section_id"))
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    fig, tbl = _nodes("fig", src, F.col("fig_id")), _nodes("tbl", src, F.col("table_id"))
    chunk = lambda c: _nodes("chunk", src, F.col(c))
    described = F.when(F.coalesce(full("content_chunk"), F.lit("")) == "", full("description"))
    shown = figures.select("*", F.explode_outer("depicts").alias("d"))
    cited = model.union([x.select("source_id", F.explode(F.array("referenced_from", "content_chunk")).alias("chunk_id")) for x in (figures, tables)]).where("coalesce(chunk_id, '') <> ''").distinct()
    held = chunks.join(cited, ["source_id", "chunk_id"], "left_semi")
    c = chunk("chunk_id")
    return model.union([
        quads_of(figures, [
            iri(fig, TYPE, ONT + "FigureImage", g), literal(fig, ONT + "caption", full("caption"), g), literal(fig, ONT + "visualDescription", described, g),
            literal(fig, ONT + "figureLabel", full("label"), g), literal(fig, ONT + "figurePanel", full("panel"), g),
            iri(fig, ONT + "figureRef", chunk("referenced_from"), g), iri(fig, ONT + "figureContent", chunk("content_chunk"), g),
        ]),
        quads_of(shown.where("d.uri IS NOT NULL"), [iri(fig, ONT + "depicts", F.col("d.uri"), g)]),
        quads_of(tables, [
            iri(tbl, TYPE, ONT + "Table", g), literal(tbl, ONT + "tableLabel", full("label"), g), literal(tbl, ONT + "caption", full("caption"), g),
            iri(tbl, ONT + "tableRef", chunk("referenced_from"), g), iri(tbl, ONT + "tableContent", chunk("content_chunk"), g),
        ]),
        quads_of(held, [
            iri(c, TYPE, ONT + "Chunk", g), literal(c, ONT + "chunkKind", F.col("kind"), g),
            literal(c, ONT + "charStart", F.col("char_start"), g, XSD + "integer"), literal(c, ONT + "charEnd", F.col("char_end"), g, XSD + "integer"),
            iri(c, ONT + "fromSection", g, g),
        ]),
    ])


def provenance_quads(documents: DataFrame, snomed_version: str = model.SNOMED_VERSION) -> DataFrame:
    """What each document is and what wrote its prose."""
    d = document_graph(F.col("source_id"))
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    made = F.col("generator").isNotNull() & (F.col("generator") != "")
    agent = F.when(made, F.concat(F.lit(INST + "agent/"), det_id("agent", F.col("generator"))))
    return quads_of(documents, [
        literal(d, DCT + "source", F.coalesce(full("origin"), F.col("title"), F.lit("")), PROVENANCE), literal(d, DCT + "hasVersion", F.coalesce("edition", F.lit("")), PROVENANCE),
        literal(d, ONT + "snomedVersion", F.lit(snomed_version), PROVENANCE), iri(agent, TYPE, PROV + "SoftwareAgent", PROVENANCE),
        literal(agent, LABEL, F.col("generator"), PROVENANCE), iri(d, PROV + "wasGeneratedBy", agent, PROVENANCE),
        literal(d, PROV + "wasDerivedFrom", F.when(made, full("origin")), PROVENANCE), literal(d, PROV + "generatedAtTime", F.when(made, full("generated_at")), PROVENANCE),
    ])


def catalog_quads(documents: DataFrame, section_rows: DataFrame) -> DataFrame:
    """Three quads a document and eight a section."""
    d = document_graph(F.col("source_id"))
    s = section_graph(F.col("source_id"), F.col("section_id"))
    heading = F.when(F.size("section_path") > 0, F.element_at("section_path", -1)).otherwise(F.col("section_id"))
    return model.union([
        quads_of(documents, [
            iri(d, TYPE, ONT + "Document", CATALOG), literal(d, LABEL, F.coalesce(F.nullif("title", F.lit("")), F.col("source_id")), CATALOG),
            literal(d, DCT + "identifier", F.col("source_id"), CATALOG),
        ]),
        quads_of(section_rows, [
            iri(s, TYPE, ONT + "Section", CATALOG), literal(s, LABEL, heading, CATALOG), literal(s, DCT + "identifier", F.col("section_id"), CATALOG),
            literal(s, ONT + "sectionPath", F.array_join("section_path", " > "), CATALOG), literal(s, ONT + "sectionOrder", F.col("order"), CATALOG, XSD + "integer"),
            iri(s, ONT + "inDocument", d, CATALOG), iri(s, DCT + "isPartOf", d, CATALOG), iri(d, ONT + "hasSection", s, CATALOG),
        ]),
    ])


def group_quads(groups: DataFrame) -> DataFrame:
    """Declared groups (``name``, ``source_id``); those without members are not there."""
    gid = F.concat(F.lit(GROUP), F.col("name"))
    return quads_of(groups, [iri(gid, TYPE, ONT + "DocumentGroup", CATALOG), literal(gid, LABEL, F.col("name"), CATALOG), iri(gid, ONT + "hasMember", document_graph(F.col("source_id")), CATALOG)]).distinct()


def elect_labels(spans: DataFrame) -> DataFrame:
    """For each concept its most frequent text (ties: the shorter, then the first seen) and its number of mentions."""
    forms = spans.where("uri IS NOT NULL").groupBy("uri", "text").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("source_id", "seq")).alias("first"))
    # min_by over (-n, length, first): one partial aggregate, no window over a frequent concept's mentions
    best = F.min_by("text", F.struct((-F.col("n")).alias("n"), F.length("text").alias("size"), "first"))
    return forms.groupBy("uri").agg(best.alias("label"), F.sum("n").alias("mentions"))


def label_quads(spans: DataFrame) -> DataFrame:
    u = F.col("uri")
    return quads_of(elect_labels(spans), [literal(u, LABEL, F.col("label"), LABELS), literal(u, ONT + "mentionCount", F.col("mentions"), LABELS, XSD + "integer")])


@dataclass(frozen=True)
class Store:
    """All quads of a corpus as a set: what is said of each relation's node in one row, the rest (all of catalog, provenance and labels) as quads."""

    nodes: DataFrame
    plain: DataFrame
    #: The predicates of facts and of ``plain``: with them the planner leaves out what a query can't be asking for.
    facts: tuple[str, ...]
    others: tuple[str, ...]
    #: Whether ``plain`` may hold facts of the nodes too.
    shared: bool

    def _rest(self) -> DataFrame:
        # spelled out as alternatives: the planner folds those against the predicate that a query asks for, an IN it does not
        among = lambda names: reduce(or_, [F.col("p") == x for x in names], F.lit(False))
        rest = node_triples(self.nodes).where(among(self.facts)).unionByName(self.plain.where(among(self.others)))
        return rest.distinct() if self.shared else rest

    @property
    def quads(self) -> DataFrame:
        """The quads, for queries that go over graphs: the smallest plan."""
        return node_quads(self.nodes).unionByName(self._rest())

    @property
    def by_predicate(self) -> DataFrame:
        """The quads, for queries that name predicates."""
        return node_quads(self.nodes, True).unionByName(self._rest())

    def subjects(self, prefix: str, skip: str = INFERRED) -> DataFrame:
        """Subjects that start with ``prefix`` with the distinct properties that they have in all graphs but ``skip``: s, held (p, o)."""
        other = ~F.col("g").endswith(skip.rpartition(":")[2]) & F.col("s").startswith(prefix)
        own = self.nodes.where(other).select("s", _held().alias("held"))
        own = own.groupBy("s").agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held")).where(F.size("held") > 0)
        rest = node_triples(self.nodes).unionByName(self.plain).where(other).groupBy("s").agg(F.collect_set(F.struct("p", "o", "o_kind", "o_dt", "o_lang")).alias("held"))
        return own.unionByName(rest)

    def subset(self, **scopes: tuple[str, ...]) -> Store:
        """``graphs.subset`` of the store as a store: nodes stay rows, so nothing has to become a set anew."""
        from . import graphs

        chosen, problems = graphs.resolve_scopes(self.plain, names=self.nodes.select("g").union(self.plain.select("g")), **scopes)
        if problems:
            raise ValueError("; ".join(problems))
        chosen = materialise(chosen.distinct(), "graphs")
        names = F.broadcast(chosen) if chosen.count() <= NAMES else chosen
        nodes = self.nodes.join(names, "g", "left_semi")
        own = self.plain.join(names, "g", "left_semi").select(*model.QUAD_COLUMNS)
        kept = own.unionByName(graphs.about(self.plain, chosen)).distinct()
        listed = F.array_union(F.concat("h", "p", F.coalesce("t", F.array().cast("array<string>"))), F.when(~F.col("fact"), F.col("more")).otherwise(F.array().cast("array<string>")))
        fixed = sorted({p for fact in (True, False) for p, *_ in _said(fact)} | {RDF + "Statement", ONT + "ClinicalAssertion"})
        labels = self.plain.where(F.col("g") == LABELS).select(*model.QUAD_COLUMNS)
        # the nodes' own ids are looked up only where a label is one of them
        odd = labels.where(F.col("s").startswith(INST + "stmt/") | F.col("s").startswith(INST + "assert/")).select("s")
        terms = nodes.select(F.explode(listed).alias("s")).union(nodes.select("s").join(odd, "s", "left_semi"))
        terms = terms.union(self.plain.sparkSession.createDataFrame([(x,) for x in fixed], "s string")).union(graphs.terms(kept)).distinct()
        plain = kept.unionByName(labels.join(terms, "s", "left_semi").select(*model.QUAD_COLUMNS)).distinct()
        return Store(nodes, materialise(plain, "plain"), self.facts, self.others, self.shared)


def store(tables: dict[str, DataFrame], groups: DataFrame | None = None, ontology: Ontology | None = None) -> Store:
    """The store of a corpus; fails when two documents share an id.

    Quads are never dealt out to become a set: relations are, in one row each,
    and only they grow with what is stated.
    """
    from .graphs import check_source_ids

    check_source_ids(tables["documents"])
    ends = endpoints(tables["spans"], tables["chunks"], tables.get("instances"))
    rows = relation_rows(tables["relations"], ends, ontology)
    nodes = relation_nodes(rows, pieces(tables["relations"], NODE_ROWS))
    release(rows)
    # a document may be called as one of the graphs that the store keeps as quads
    own = F.coalesce(F.col("g"), F.lit("")).isin(PROVENANCE, CATALOG, LABELS, INFERRED)
    named, nodes = nodes.where(own), nodes.where(~own)
    parts = [node_quads(named), node_triples(named)]
    if "instances" in tables:
        parts.append(instance_quads(tables["instances"], ends))
    if "figures" in tables:
        parts.append(media_quads(tables["figures"], tables["tables"], tables["chunks"]))
    parts += [provenance_quads(tables["documents"]), catalog_quads(tables["documents"], sections(tables["chunks"], tables.get("passages"))), label_quads(tables["spans"])]
    if groups is not None:
        parts.append(group_quads(groups))
    plain = materialise(model.union(parts).distinct(), "plain")
    others = sorted(r["p"] for r in plain.select("p").distinct().collect())
    return Store(nodes, plain, tuple(sorted(t.uri for t in (ontology or default()).relations.values())), tuple(others), "instances" in tables)


def assert_documents(tables: dict[str, DataFrame], groups: DataFrame | None = None, ontology: Ontology | None = None) -> DataFrame:
    """All quads of a corpus as a set; fails when two documents share an id."""
    return store(tables, groups, ontology).quads
