"""Selection of graphs from a quad table: unions, scopes, subsets, the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions.text import slug
from ..model import CATALOG, DCT, GRAPH, INFERRED, LABEL, LABELS, ONT, PROVENANCE, TRIPLE_COLUMNS, TYPE


def _ends(suffixes: tuple[str, ...] | list[str]) -> Column:
    out = F.lit(False)
    for x in suffixes:
        out = out | F.col("g").endswith(x)
    return out


def load_graph(quads: DataFrame, only: tuple[str, ...] | None = None, skip: tuple[str, ...] = (), keep_labels: bool = False) -> DataFrame:
    """The set union of the graphs whose name ends with one of ``only`` and none of ``skip``; labels of all graphs if asked."""
    chosen = (F.lit(True) if only is None else _ends(only)) & ~_ends(skip)
    if keep_labels:
        chosen = chosen | (F.col("p") == LABEL)
    return flatten(quads.where(chosen))


def flatten(quads: DataFrame) -> DataFrame:
    """All triples as a set, graphs forgotten."""
    return quads.select(*TRIPLE_COLUMNS).distinct()


def graph_names(quads: DataFrame) -> DataFrame:
    return quads.where("g IS NOT NULL").select("g").distinct().orderBy("g")


def describe(quads: DataFrame, distinct: bool = False) -> DataFrame:
    """Distinct triples of each graph, largest first; ``distinct`` says that the quads are a set already, as a store's are."""
    rows = quads.where("g IS NOT NULL")
    return (rows if distinct else rows.distinct()).groupBy("g").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "g")


def select(quads: DataFrame, graphs: DataFrame, include_inferred: bool = False, carry: bool = True) -> DataFrame:
    """The quads of ``graphs`` (column ``g``) and what makes them readable alone.

    Carried along: provenance and catalog rows about the graphs or their
    documents, and labels of terms that the subset mentions.
    """
    graphs = graphs.select("g").distinct()
    own = quads.join(graphs, "g", "left_semi").select(*model.QUAD_COLUMNS)
    if include_inferred:
        own = own.unionByName(quads.where(F.col("g") == INFERRED).select(*model.QUAD_COLUMNS))
    if not carry:
        return own.distinct()
    kept = own.unionByName(about(quads, graphs))
    labels = quads.where(F.col("g") == LABELS).select(*model.QUAD_COLUMNS).join(terms(kept).distinct(), "s", "left_semi").select(*model.QUAD_COLUMNS)
    return kept.unionByName(labels).distinct()


def about(quads: DataFrame, graphs: DataFrame) -> DataFrame:
    """Provenance and catalog rows about ``graphs`` or their documents."""
    parent = F.when(F.col("g").startswith(GRAPH), F.regexp_replace("g", "/[^/]*$", "")).otherwise(F.col("g"))
    named = graphs.select(F.explode(F.array(F.col("g"), parent)).alias("t")).distinct()
    meta = quads.where(F.col("g").isin(PROVENANCE, CATALOG)).select(*model.QUAD_COLUMNS)
    by_subject = meta.join(named.withColumnRenamed("t", "s"), "s", "left_semi")
    by_object = meta.where("o_kind <> 'lit'").join(named.withColumnRenamed("t", "o"), "o", "left_semi")
    return by_subject.select(*model.QUAD_COLUMNS).unionByName(by_object.select(*model.QUAD_COLUMNS))


def terms(quads: DataFrame) -> DataFrame:
    """What quads mention: subjects, predicates and objects that are no literals (``s``, not distinct)."""
    return quads.select(F.explode(F.array(F.col("s"), F.col("p"), F.when(F.col("o_kind") != "lit", F.col("o")))).alias("s")).where("s IS NOT NULL")


class Catalog:
    """Documents, sections and groups, read back from the catalog graph (one row a document, section or membership)."""

    def __init__(self, quads: DataFrame):
        rows = quads.where(F.col("g") == CATALOG)
        wanted = {"type": TYPE, "label": LABEL, "id": DCT + "identifier", "path": ONT + "sectionPath", "order": ONT + "sectionOrder", "doc": ONT + "inDocument"}
        value = [F.coalesce(F.min(F.when(F.col("p") == iri, F.col("o"))), F.lit("")).alias(name) for name, iri in wanted.items()]
        things = rows.groupBy("s").agg(*value)
        number = F.when(F.col("order").rlike("^[0-9]+$"), F.col("order").cast("int")).otherwise(0)
        self.documents = things.where(F.col("type") == ONT + "Document").select(F.col("s").alias("uri"), "label", "id")
        self.sections = things.where(F.col("type") == ONT + "Section").select(F.col("s").alias("uri"), "label", "id", "doc", "path", number.alias("order"))
        named = things.where(F.col("type") == ONT + "DocumentGroup").select("s", F.col("label").alias("name"))
        self.groups = named.join(rows.where(F.col("p") == ONT + "hasMember").select("s", F.col("o").alias("doc")), "s", "left").select("name", "doc")

    def scopes(self) -> DataFrame:
        """A listing of all that can be selected: kind, uri, id, label, and the document or members."""
        members = self.groups.groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("doc")), " ").alias("within"))
        return model.union([
            self.documents.select(F.lit("document").alias("kind"), "uri", "id", "label", F.lit("").alias("within")),
            self.sections.select(F.lit("section").alias("kind"), "uri", "id", "label", F.col("doc").alias("within")),
            members.select(F.lit("group").alias("kind"), F.concat(F.lit(model.GROUP), "name").alias("uri"), F.col("name").alias("id"), F.col("name").alias("label"), "within"),
        ])

    def find_documents(self, term: str) -> DataFrame:
        """Graphs (``uri``) of documents whose id, graph or title is the term; only without any, those whose title holds it."""
        return _find(self.documents, term, ("uri", "id", "label"), ("label", "id"))

    def find_sections(self, term: str, documents: DataFrame | None = None) -> DataFrame:
        """Graphs of sections that match, of ``documents`` (``uri``) if given."""
        rows = self.sections if documents is None else self.sections.join(documents.select(F.col("uri").alias("doc")), "doc", "left_semi")
        return _find(rows, term, ("uri", "id", "label"), ("label",))

    def find_group(self, term: str) -> DataFrame:
        """Graphs of the documents in a group."""
        rows = self.groups.where((F.lower("name") == term.lower()) | (F.col("name") == slug(F.lit(term)))).where("doc IS NOT NULL")
        return rows.select(F.col("doc").alias("uri")).distinct()

    def sections_of(self, document: str) -> DataFrame:
        return self.sections.where(F.col("doc") == document).orderBy("order", "uri")


def _find(rows: DataFrame, term: str, exact: tuple[str, ...], loose: tuple[str, ...]) -> DataFrame:
    low = term.lower()
    same, part = F.lit(False), F.lit(False)
    for c in exact:
        same = same | (F.lower(c) == low)
    for c in loose:
        part = part | F.contains(F.lower(c), F.lit(low))
    hits = rows.where(same).select("uri")
    return (rows.where(part).select("uri") if hits.isEmpty() else hits).distinct()


def resolve_scopes(quads: DataFrame, documents: tuple[str, ...] = (), sections: tuple[str, ...] = (), groups: tuple[str, ...] = (), names: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Graphs (``g``) for the terms, and what matched nothing.  Groups and documents add up; sections narrow within them.

    ``names``: rows with all graphs, where ``quads`` has only the catalog's.
    """
    catalog = Catalog(quads)
    found: list[DataFrame] = []
    problems: list[str] = []
    for kind, terms, find in (("group", groups, catalog.find_group), ("document", documents, catalog.find_documents)):
        for term in terms:
            hits = find(term)
            if hits.isEmpty():
                problems.append(f"no {kind} matches {term!r}")
            found.append(hits)
    within = model.union(found).distinct() if found else None
    if sections:
        chosen = []
        for term in sections:
            hits = catalog.find_sections(term, within)
            if hits.isEmpty():
                named = [r["uri"] for r in within.orderBy("uri").limit(20).collect()] if within is not None else []
                problems.append(f"no section matches {term!r}" + (f" in {', '.join(named)}" if named else ""))
            chosen.append(hits)
        return model.union(chosen).distinct().select(F.col("uri").alias("g")), problems
    names = graph_names(quads if names is None else names)
    if within is None:
        return names.where("false").select("g"), problems
    # a document's graphs are its own and those below it
    parts = F.split("g", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return names.select("g", F.explode(above).alias("uri")).join(within, "uri", "left_semi").select("g").distinct(), problems


def subset(quads: DataFrame, include_inferred: bool = False, **scopes: tuple[str, ...]) -> DataFrame:
    """``select`` of resolved scopes; terms that match nothing are an error, never a smaller subset."""
    graphs, problems = resolve_scopes(quads, **scopes)
    if problems:
        raise ValueError("; ".join(problems))
    return select(quads, graphs, include_inferred)


def subset_name(terms: list[str]) -> str:
    """A file name from scope terms, 80 characters at most."""
    import re

    parts = [re.sub("[^a-z0-9]+", "-", t.lower()).strip("-") for t in terms]
    return ("-".join(filter(None, parts))[:80].rstrip("-") or "subset") + ".nq"


def match_groups(manifest: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of a manifest as source ids, by id, then by file name without ending; and those that match none."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    by_id = documents.select(F.col("source_id").alias("i"), F.col("source_id").alias("by_id"))
    by_stem = documents.select(stem.alias("t"), F.col("source_id").alias("by_stem"))
    rows = manifest.join(by_id, F.col("member") == F.col("i"), "left").join(by_stem, F.regexp_replace("member", r"\.[^.]*$", "") == F.col("t"), "left")
    rows = rows.select("name", "member", F.coalesce("by_id", "by_stem").alias("source_id"))
    return rows.where("source_id IS NOT NULL").select("name", "source_id").distinct(), rows.where("source_id IS NULL").select("name", "member").distinct()


def check_source_ids(documents: DataFrame) -> None:
    """Fails when two documents share a source id."""
    twice = documents.groupBy("source_id").count().where("count > 1").orderBy("source_id").limit(20).collect()
    if twice:
        raise ValueError("source ids used twice: " + ", ".join(f"{r['source_id']} ({r['count']})" for r in twice))
