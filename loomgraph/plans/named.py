"""The named queries over a set of triples, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import INST, LABEL, ONT, PROV, DCT, RDF, TYPE, local_name
from ..ontology import Ontology, default


def _of(triples: DataFrame, p: str, s: str, o: str) -> DataFrame:
    """Subject and object of one predicate under the given names."""
    return triples.where(F.col("p") == p).select(F.col("s").alias(s), F.col("o").alias(o))


def _labels(triples: DataFrame, term: str, label: str) -> DataFrame:
    return _of(triples, LABEL, term, label)


def _typed(triples: DataFrame, iri: str, s: str) -> DataFrame:
    return triples.where((F.col("p") == TYPE) & (F.col("o") == iri)).select(F.col("s").alias(s))


def _relation_rows(triples: DataFrame, ontology: Ontology) -> DataFrame:
    """Triples of relation types with the labels of both ends (a row for each label)."""
    rows = triples.where(F.col("p").isin(sorted(t.uri for t in ontology.relations.values()))).select("s", "p", "o")
    rows = rows.join(_labels(triples, "s", "sl"), "s", "left").join(_labels(triples, "o", "ol"), "o", "left")
    return rows.select("s", "p", "o", F.coalesce("sl", "s").alias("subject"), local_name(F.col("p")).alias("predicate"), F.coalesce("ol", "o").alias("object"))


def relations(triples: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """Asserted relations by label, with the best confidence and the number of statements behind them."""
    ontology = ontology or default()
    stated = _of(triples, RDF + "subject", "stmt", "s").join(_of(triples, RDF + "predicate", "stmt", "p"), "stmt").join(_of(triples, RDF + "object", "stmt", "o"), "stmt")
    stated = stated.join(_of(triples, ONT + "confidence", "stmt", "conf"), "stmt")
    rows = _relation_rows(triples, ontology).join(stated, ["s", "p", "o"], "left")
    out = rows.groupBy("subject", "predicate", "object").agg(F.max(F.expr("try_cast(conf AS double)")).alias("confidence"), F.count_distinct("stmt").alias("extractions"))
    return out.orderBy("subject", "predicate", "object")


def inferred(triples: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    return _relation_rows(triples, ontology or default()).select("subject", "predicate", "object").orderBy("subject", "predicate", "object")


def _assertions(triples: DataFrame) -> DataFrame:
    rows = _typed(triples, ONT + "ClinicalAssertion", "stmt").join(_of(triples, ONT + "about", "stmt", "a"), "stmt").join(_of(triples, ONT + "polarity", "stmt", "pol"), "stmt")
    rows = rows.join(_of(triples, ONT + "target", "stmt", "t"), "stmt", "left").join(_of(triples, ONT + "assertionType", "stmt", "at"), "stmt", "left")
    # all joins on the node come first: the ones with labels need not carry it
    rows = rows.join(_labels(triples, "t", "tl"), "t", "left").join(_labels(triples, "a", "al"), "a", "left")
    return rows.select(
        local_name(F.col("pol")).alias("polarity"), F.coalesce("al", "a").alias("about"), F.coalesce("tl", "t", F.lit("")).alias("target"), local_name(F.col("at")).alias("assertionType"), "pol",
    )


def flagged(triples: DataFrame) -> DataFrame:
    """Assertions that are not affirmed."""
    return _assertions(triples).where(F.col("pol") != ONT + "Affirmed").drop("pol")


def negated(triples: DataFrame) -> DataFrame:
    """All assertion nodes, affirmed ones without a linked target included."""
    return _assertions(triples).drop("pol").select("polarity", "about", "assertionType", "target")


def concepts(triples: DataFrame) -> DataFrame:
    rows = _labels(triples, "concept", "label").join(_of(triples, ONT + "mentionCount", "concept", "mentions"), "concept", "left")
    rows = rows.select("label", "concept", F.expr("try_cast(mentions AS bigint)").alias("mentions"))
    return rows.orderBy(F.desc_nulls_last("mentions"), "label")


def figures(triples: DataFrame) -> DataFrame:
    shown = _of(triples, ONT + "depicts", "fig", "d").join(_labels(triples, "d", "dl"), "d", "left")
    rows = _typed(triples, ONT + "FigureImage", "fig").join(_of(triples, ONT + "caption", "fig", "caption"), "fig", "left").join(shown, "fig", "left")
    return rows.select(F.regexp_replace("fig", "^.*/", "").alias("figure"), "caption", F.coalesce("dl", "d", F.lit("")).alias("depicts")).orderBy("figure")


def instances(triples: DataFrame, namespace: str = INST) -> DataFrame:
    """Properties of all nodes of the instance namespace, once for each of their types."""
    own = triples.where(F.col("s").startswith(namespace))
    return unfold(own.groupBy("s").agg(F.collect_set(F.struct("p", "o", "o_kind", "o_dt", "o_lang")).alias("held")))


def unfold(subjects: DataFrame) -> DataFrame:
    """``instances`` of subjects with what is said of each (s, held); a subject is put in order as one row and unfolded there."""
    typed = F.size(F.filter("held", lambda x: x["p"] == TYPE))
    said = F.transform(F.filter("held", lambda x: x["p"] != TYPE), lambda x: F.struct(local_name(x["p"]).alias("property"), x["o"].alias("value")))
    rows = subjects.select(F.regexp_replace("s", "^.*/", "").alias("instance"), typed.alias("n"), said.alias("said")).where("n > 0").orderBy("instance")
    return rows.select("instance", F.explode(F.flatten(F.array_repeat("said", F.col("n")))).alias("x")).select("instance", "x.property", "x.value")


PROVENANCE_PROPERTIES = (DCT + "source", DCT + "hasVersion", PROV + "wasGeneratedBy", PROV + "wasDerivedFrom", PROV + "generatedAtTime", ONT + "snomedVersion")


def provenance(triples: DataFrame) -> DataFrame:
    rows = triples.where(F.col("p").isin(*PROVENANCE_PROPERTIES))
    return rows.select(F.col("s").alias("graph"), local_name(F.col("p")).alias("property"), F.col("o").alias("value"))


def evidence(triples: DataFrame) -> DataFrame:
    """Reified statements with confidence and extractor."""
    rows = _of(triples, RDF + "subject", "stmt", "s").join(_of(triples, RDF + "predicate", "stmt", "p"), "stmt").join(_of(triples, RDF + "object", "stmt", "o"), "stmt")
    rows = rows.join(_of(triples, ONT + "confidence", "stmt", "conf"), "stmt", "left").join(_of(triples, ONT + "extractedBy", "stmt", "extractedBy"), "stmt", "left")
    rows = rows.join(_labels(triples, "s", "sl"), "s", "left").join(_labels(triples, "o", "ol"), "o", "left")
    rows = rows.select(F.coalesce("sl", "s").alias("subject"), local_name(F.col("p")).alias("predicate"), F.coalesce("ol", "o").alias("object"), F.expr("try_cast(conf AS double)").alias("confidence"), "extractedBy")
    return rows.orderBy(F.desc_nulls_last("confidence"), "subject", "predicate", "object")  # few confidences: they alone would leave few ranges


def about(triples: DataFrame, term: str) -> DataFrame:
    """Edges out of (without labels) and into a concept named by IRI or, in any case, by label; the first of several by IRI."""
    by_iri = triples.where(F.col("s") == term).select(F.col("s").alias("c"), F.lit(0).alias("way"))
    by_label = triples.where((F.col("p") == LABEL) & (F.lower("o") == term.lower())).select(F.col("s").alias("c"), F.lit(1).alias("way"))
    # one name, as a constant: so the triples are filtered where they are read, before they become a set
    concept = F.lit(by_iri.union(by_label).agg(F.min_by("c", F.struct("way", "c")).alias("c")).first()["c"]).cast("string")
    out = triples.where((F.col("s") == concept) & (F.col("p") != LABEL)).select("p", F.col("o").alias("t"), F.lit("out").alias("direction"))
    into = triples.where((F.col("o") == concept) & (F.col("o_kind") != "lit")).select("p", F.col("s").alias("t"), F.lit("in").alias("direction"))
    rows = out.union(into).join(_labels(triples, "t", "l"), "t", "left")
    return rows.select("direction", local_name(F.col("p")).alias("predicate"), F.coalesce("l", "t").alias("other")).orderBy("direction", "predicate", "other")


def treated_with_drug(triples: DataFrame, disease: str, drug_predicate: str = ONT + "treated_with") -> DataFrame:
    """What treats anything that is, also by subclass inference, of a class: conditions and drugs by label."""
    is_a = triples.where(((F.col("p") == TYPE) | F.col("p").endswith("#subClassOf")) & (F.col("o") == disease)).select("s").distinct()
    rows = _of(triples, drug_predicate, "s", "o").join(is_a, "s", "left_semi").join(_labels(triples, "s", "sl"), "s", "left").join(_labels(triples, "o", "ol"), "o", "left")
    return rows.select(F.coalesce("sl", "s").alias("condition"), F.coalesce("ol", "o").alias("drug"))


def show(rows: DataFrame, limit: int = 25) -> None:
    """Print rows; 0 prints all."""
    rows.show(limit or rows.count(), truncate=False)


def with_polarity(triples: DataFrame, polarity: str) -> DataFrame:
    return _assertions(triples).where(F.col("polarity") == polarity).drop("pol")


NAMED = {
    "relations": relations, "flagged": flagged, "inferred": inferred, "concepts": concepts, "negated": negated, "figures": figures,
    "instances": instances, "provenance": provenance, "evidence": evidence,
}


def run(name: str, quads: DataFrame, **scopes: tuple[str, ...]) -> DataFrame:
    """A named query on the graphs it is meant for: asserted ones, or for ``inferred`` that graph with all labels."""
    from ..operators.graphs import flatten, load_graph, subset

    if any(scopes.values()):
        if name == "inferred":
            raise ValueError("inferred triples belong to no document; they cannot be scoped")
        return NAMED[name](flatten(subset(quads, **scopes)))
    if name == "inferred":
        return inferred(load_graph(quads, only=("inferred",), keep_labels=True))
    return NAMED[name](load_graph(quads, skip=("inferred",)))


