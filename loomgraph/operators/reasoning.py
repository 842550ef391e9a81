"""RDFS closure of a triple table, semi-naively, into a graph of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..model import CATALOG, INFERRED, PROVENANCE, RDFS, TRIPLE_COLUMNS, TYPE, iri
from ..ontology import Ontology, default
from ..sources.tables import materialise

SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE = (RDFS + x for x in ("subClassOf", "subPropertyOf", "domain", "range"))
#: Rules that are applied by default: closures of both hierarchies, and what they, domains and ranges imply.
RULES = ("rdfs2", "rdfs3", "rdfs5", "rdfs7", "rdfs9", "rdfs11")
#: Pairs of a closed class hierarchy that are sent to all; longer ones are joined by exchange.
CLASSES = 100_000


def axioms(spark: SparkSession, ontology: Ontology | None = None, more: DataFrame | None = None) -> DataFrame:
    """Sub-property axioms of the ontology and any further schema triples."""
    rows = [(t.uri, SUB_PROPERTY, (ontology or default()).relations[t.parent].uri) for t in (ontology or default()).relations.values() if t.parent]
    base = spark.createDataFrame(rows, "s string, p string, o string").select(*iri(F.col("s"), F.col("p"), F.col("o"), F.lit(None).cast("string"))[:6])
    return base if more is None else base.unionByName(more.select(*TRIPLE_COLUMNS))


def transitive(edges: DataFrame, rounds: int = 32) -> DataFrame:
    """All pairs (s, o) that a path of ``edges`` joins, by repeated squaring: the number of rounds is logarithmic in the longest path."""
    paths = materialise(edges.select("s", "o").distinct(), "paths")
    n = paths.count()
    for _ in range(rounds):
        step = paths.select("s", F.col("o").alias("m")).join(paths.select(F.col("s").alias("m"), "o"), "m").select("s", "o")
        paths = materialise(paths.union(step).distinct(), "paths")
        before, n = n, paths.count()
        if n == before:
            return paths
    raise RuntimeError("hierarchy too deep")


def close(triples: DataFrame, schema: DataFrame, rules: tuple[str, ...] = RULES, transitive_properties: tuple[str, ...] = (), rounds: int = 32) -> DataFrame:
    """Triples that follow from ``triples`` and ``schema`` under ``rules`` and are in neither.

    Each round joins only the triples that are new with the closed hierarchies;
    ``transitive_properties`` is an extra that RDFS itself does not have.
    """
    told = triples.select(*TRIPLE_COLUMNS).unionByName(schema.select(*TRIPLE_COLUMNS))
    stated = materialise(told.where(F.col("p").isin(SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE)).distinct(), "axioms")
    links = lambda p: stated.where((F.col("p") == p) & (F.col("o_kind") != "lit")).select("s", "o")
    nothing = stated.select("s", "o").limit(0)
    classes = transitive(links(SUB_CLASS)) if "rdfs11" in rules else links(SUB_CLASS)
    properties = transitive(links(SUB_PROPERTY)) if "rdfs5" in rules else links(SUB_PROPERTY)
    domains, ranges = (links(DOMAIN) if "rdfs2" in rules else nothing), (links(RANGE) if "rdfs3" in rules else nothing)
    # only triples that a rule reads or could derive are stored and joined: those of the properties in the schema, and types that it names
    above = {r["o"] for r in properties.select("o").distinct().collect()} if "rdfs7" in rules else set()
    read = {r["s"] for x in (properties, domains, ranges) for r in x.select("s").distinct().collect()}
    made = sorted(above | {TYPE, SUB_CLASS, SUB_PROPERTY, *transitive_properties})
    named = read | above | {SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE, *transitive_properties}
    few = classes.count() <= CLASSES
    small = lambda x: F.broadcast(x) if few else x
    known = told.where(F.col("p").isin(sorted(named)))
    if TYPE not in named:
        kinds = model.union([classes.select(F.col("s").alias("o")), classes.select("o"), domains.select("o"), ranges.select("o")]).distinct()
        known = known.unionByName(told.where(F.col("p") == TYPE).join(small(kinds), "o", "left_semi").select(*TRIPLE_COLUMNS))
    known = materialise(known.distinct(), "known")
    as_triples = lambda pairs, p: pairs.select(*iri(F.col("s"), p, F.col("o"), F.lit(None).cast("string"))[:6])
    derived = model.union([as_triples(classes, SUB_CLASS), as_triples(properties, SUB_PROPERTY)])
    fresh = known.unionByName(derived)
    found = _minus(derived.distinct(), known)
    for _ in range(rounds):
        step = []
        over = lambda x, names: F.broadcast(x.select(F.col("s").alias("p"), F.col("o").alias(names)))
        if "rdfs7" in rules:
            step.append(fresh.join(over(properties, "q"), "p").select("s", F.col("q").alias("p"), "o", "o_kind", "o_dt", "o_lang"))
        types = lambda rows: rows.select(*iri(F.col("x"), TYPE, F.col("c"), F.lit(None).cast("string"))[:6])
        step.append(types(fresh.join(over(domains, "c"), "p").select(F.col("s").alias("x"), "c")))
        step.append(types(fresh.where("o_kind <> 'lit'").join(over(ranges, "c"), "p").select(F.col("o").alias("x"), "c")))
        if "rdfs9" in rules:
            step.append(types(fresh.where(F.col("p") == TYPE).select("s", "o").join(small(classes.select(F.col("s").alias("o"), F.col("o").alias("c"))), "o").select(F.col("s").alias("x"), "c")))
        if transitive_properties:
            all_ = known.unionByName(found).where(F.col("p").isin(*transitive_properties))
            new = fresh.where(F.col("p").isin(*transitive_properties))
            ahead = lambda a, b: a.select("s", "p", F.col("o").alias("m")).join(b.select(F.col("s").alias("m"), "p", "o", "o_kind", "o_dt", "o_lang"), ["m", "p"]).select(*TRIPLE_COLUMNS)
            step += [ahead(new, all_), ahead(all_, new)]
        before = known.unionByName(found).where(F.col("p").isin(made))
        fresh = materialise(_minus(model.union([x.select(*TRIPLE_COLUMNS) for x in step]).distinct(), before), "fresh")
        if fresh.isEmpty():
            return found
        found = found.unionByName(fresh)
    raise RuntimeError("closure takes too many rounds")


def _minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that are not in ``b``, nulls equal."""
    b = b.select(*(F.col(c).alias(f"_{c}") for c in TRIPLE_COLUMNS))
    same = F.lit(True)
    for c in TRIPLE_COLUMNS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(b, same, "left_anti")


def filter_materialised(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without literal subjects and ``rdf:type rdfs:Resource``; and the counts of both."""
    vacuous = (F.col("p") == TYPE) & (F.col("o") == RDFS + "Resource")
    odd = ~F.col("s").startswith("_:") & ~F.col("s").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    counts = triples.agg(F.count_if(odd).alias("literal_subject"), F.count_if(vacuous & ~odd).alias("axiomatic"))
    return triples.where(~vacuous & ~odd), counts


def materialise_inferred(quads: DataFrame, ontology: Ontology | None = None, schema: DataFrame | None = None, **options) -> DataFrame:
    """New triples from all graphs but provenance and catalog, as quads of the inferred graph."""
    base = quads.where(~F.col("g").isin(PROVENANCE, CATALOG)).select(*TRIPLE_COLUMNS).distinct()
    found, _ = filter_materialised(close(base, axioms(quads.sparkSession, ontology, schema), **options))
    return found.select(*TRIPLE_COLUMNS, F.lit(INFERRED).alias("g"))


