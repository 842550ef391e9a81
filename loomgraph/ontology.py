"""The relation ontology as data: load, normalise, validate, extend."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import ONT, PREFIXES

ANY = "*ANY*"

# Relation types with the labels of their ends (no tail: the type has none), parents, aliases and inverse names.
RELATIONS = {
    "treated_with": {"head": ["Disease"], "tail": ["Drug", "Substance"], "inverse": ["treats"]},
    "prevented_by": {"head": ["Disease"], "tail": ["Drug", "Substance"]},
    "caused_by": {"head": ["Disease", "Finding", "Morphology"], "tail": ["Disease", "Finding", "BodyStructure", "Substance", "Organism", "Protein"], "inverse": ["causes", "leads_to", "results_in"]},
    "finding_site": {"head": ["Finding", "Symptom", "Disease", "Morphology"], "tail": ["BodyStructure", "Cell", "CellComponent"]},
    "associated_with": {"head": ["Disease", "Finding", "Symptom"], "tail": ["Disease", "Finding", "Symptom", "BodyStructure", "Substance"], "symmetric": True},
    "present_in_patient": {"head": ["Disease", "Finding", "Symptom"], "tail": None},
    "part_of": {"head": ["BodyStructure", "Cell", "CellComponent"], "tail": ["BodyStructure", "Cell", "AnatomicalSystem"], "inverse": ["has_part", "consists_of"]},
    "located_in": {"head": ["BodyStructure", "Cell", "CellComponent", "Substance"], "tail": ["BodyStructure", "Cell"], "inverse": ["contains", "location_of"]},
    "composed_of": {"head": ["BodyStructure"], "tail": ["Cell", "BodyStructure", "Substance"]},
    "connects_to": {"head": ["BodyStructure"], "tail": ["BodyStructure"], "symmetric": True},
    "secretes": {"head": ["BodyStructure", "Cell"], "tail": ["Substance", "Protein"], "aliases": ["produces", "releases"], "inverse": ["produced_by", "secreted_by", "released_by"]},
    "synthesizes": {"head": ["BodyStructure", "Cell", "CellComponent", "Protein"], "tail": ["Substance", "Protein"], "aliases": ["makes"], "inverse": ["synthesized_by"]},
    "stores": {"head": ["BodyStructure", "Cell", "CellComponent"], "tail": ["Substance", "Protein"], "aliases": ["holds"], "inverse": ["stored_in"]},
    "transports": {"head": ["BodyStructure", "Cell", "Protein", "Substance"], "tail": ["Substance", "Protein"], "aliases": ["carries"], "inverse": ["transported_by", "carried_by"]},
    "converts_to": {"head": ["Substance", "Protein"], "tail": ["Substance", "Protein"], "inverse": ["converted_from", "derived_from"]},
    "catalyzes": {"head": ["Protein"], "tail": ["Substance", "Protein"], "aliases": ["breaks_down", "metabolizes"], "inverse": ["catalyzed_by", "broken_down_by"]},
    "regulates": {"head": ["BodyStructure", "Cell", "Substance", "Protein"], "tail": ["BodyStructure", "Cell", "Substance", "Protein", "Finding"], "aliases": ["acts_on", "affects", "modulates"], "inverse": ["affected_by", "regulated_by"]},
    "stimulates": {"head": ["BodyStructure", "Cell", "Substance", "Protein"], "tail": ["BodyStructure", "Cell", "Substance", "Protein", "Finding"], "parent": "regulates", "aliases": ["activates"], "inverse": ["stimulated_by", "activated_by"]},
    "inhibits": {"head": ["BodyStructure", "Cell", "Substance", "Protein", "Drug"], "tail": ["BodyStructure", "Cell", "Substance", "Protein", "Finding"], "parent": "regulates", "inverse": ["inhibited_by"]},
    "requires": {"head": ["BodyStructure", "Cell", "Protein", "Substance"], "tail": ["Substance", "Protein"], "inverse": ["required_for", "needed_for"]},
    "has_function": {"head": ["BodyStructure", "Cell", "Substance", "Protein"], "tail": ["Finding"]},
    "risk_factor_for": {"head": ["Disease", "Finding", "Substance", "Drug"], "tail": ["Disease"]},
    "complication_of": {"head": ["Disease", "Finding"], "tail": ["Disease"], "parent": "caused_by"},
    "diagnosed_by": {"head": ["Disease", "Finding"], "tail": ["Finding", "Substance"]},
    "adverse_effect_of": {"head": ["Disease", "Finding", "Symptom"], "tail": ["Drug", "Substance"]},
    "contraindicated_in": {"head": ["Drug", "Substance"], "tail": ["Disease", "Finding"]},
    "has_mechanism": {"head": ["Drug", "Substance"], "tail": ["Protein", "Substance", "Cell", "CellComponent"]},
}
# What each label is also, and the property of each modifier.
LABEL_PARENTS = {"Drug": "Substance", "Protein": "Substance", "MultiTissueStructure": "BodyStructure", "AnatomicalSystem": "BodyStructure"}
MODIFIER_PROPERTIES = {
    "severity": "sct:246112005", "deviation": "ont:hasDeviation", "location": "sct:363698007", "laterality": "sct:272741003", "acuity": "ont:hasAcuity",
    "radiation": "ont:radiatesTo", "temporality": "ont:hasTemporality", "quantity": "ont:hasQuantity", "frequency": "ont:hasFrequency", "route": "ont:hasRoute",
}
ROLE_CHANGING = ("deviation",)


def expand(name: str) -> str:
    """A CURIE as a full IRI; anything else unchanged."""
    prefix, colon, rest = name.partition(":")
    return PREFIXES[prefix] + rest if colon and prefix in PREFIXES else name


@dataclass
class RelationType:
    name: str
    head: frozenset[str]
    tail: frozenset[str] | None
    uri: str
    symmetric: bool = False
    parent: str | None = None
    aliases: tuple[str, ...] = ()
    inverse: tuple[str, ...] = ()


@dataclass
class Ontology:
    relations: dict[str, RelationType]
    label_parents: dict[str, str] = field(default_factory=lambda: dict(LABEL_PARENTS))
    modifiers: dict[str, str] = field(default_factory=lambda: {k: expand(v) for k, v in MODIFIER_PROPERTIES.items()})

    def ancestors(self, label: str) -> list[str]:
        """A label and what it is also, nearest first; a cycle ends the climb."""
        out: list[str] = []
        while label and label not in out:
            out.append(label)
            label = self.label_parents.get(label, "")
        return out

    def satisfies(self, label: str | None, allowed: frozenset[str] | None) -> bool:
        return label is not None and allowed is not None and (ANY in allowed or any(x in allowed for x in self.ancestors(label)))

    def types(self, spark: SparkSession) -> DataFrame:
        """One row a relation type; at most as many as the ontology has, so it can be broadcast."""
        rows = [(t.name, t.uri, sorted(t.head), None if t.tail is None else sorted(t.tail), t.symmetric, t.parent) for t in self.relations.values()]
        return spark.createDataFrame(rows, "type string, uri string, head_labels array<string>, tail_labels array<string>, symmetric boolean, parent string")

    def names(self, spark: SparkSession) -> DataFrame:
        """``name`` to ``type`` and whether the ends swap; a type's own name comes before aliases, those before inverses."""
        found: dict[str, tuple[str, bool]] = {}
        for swap, names in ((False, lambda t: (t.name,)), (False, lambda t: t.aliases), (True, lambda t: t.inverse)):
            for t in self.relations.values():
                for n in names(t):
                    found.setdefault(n, (t.name, swap))
        return spark.createDataFrame([(n, t, s) for n, (t, s) in found.items()], "name string, type string, swap boolean")

    def label_closure(self, spark: SparkSession, labels: list[str] | None = None) -> DataFrame:
        known = set(labels or ()) | set(self.label_parents) | {x for t in self.relations.values() for x in t.head | (t.tail or frozenset())}
        return spark.createDataFrame([(a, b) for a in sorted(known) for b in self.ancestors(a)], "label string, is_also string")

    def admitted(self, spark: SparkSession, hierarchy: bool = True) -> DataFrame:
        """(type, head_label, tail_label) triples that a type admits; a type without tail has a null one."""
        labels = sorted(set(self.label_parents) | {x for t in self.relations.values() for x in t.head | (t.tail or frozenset())})
        ok = self.satisfies if hierarchy else (lambda x, allowed: x in allowed or ANY in allowed)
        rows = [
            (t.name, a, b)
            for t in self.relations.values()
            for a in labels
            if ok(a, t.head)
            for b in ([None] if t.tail is None else [x for x in labels if ok(x, t.tail)])
        ]
        return spark.createDataFrame(rows, "type string, head_label string, tail_label string")

    def reachable(self, emitted: list[str]) -> set[str]:
        return {x for label in emitted for x in self.ancestors(label)}

    def problems(self, emitted: list[str] | None = None) -> list[dict[str, str]]:
        """Unknown parents, cycles among types or labels, and ends that no emitted label reaches."""
        out: list[dict[str, str]] = []
        for t in self.relations.values():
            if t.parent and t.parent not in self.relations:
                out.append({"kind": "unknown-parent", "name": t.name, "detail": t.parent})
        out += [{"kind": "type-cycle", "name": x, "detail": ""} for x in _cycles({t.name: t.parent for t in self.relations.values() if t.parent})]
        out += [{"kind": "label-cycle", "name": x, "detail": ""} for x in _cycles(self.label_parents)]
        if emitted is not None:
            reach = self.reachable(emitted)
            for t in self.relations.values():
                for end, labels in (("head", t.head), ("tail", t.tail)):
                    if labels and ANY not in labels and not labels & reach:
                        out.append({"kind": f"unreachable-{end}", "name": t.name, "detail": " ".join(sorted(labels))})
        return out

    def merged(self, more: dict[str, RelationType]) -> Ontology:
        """With further types; those known stay as they are and incomplete ones are left out."""
        new = {n: t for n, t in more.items() if n not in self.relations and t.head and t.uri and not n.startswith("_")}
        return Ontology(self.relations | new, self.label_parents, self.modifiers)


def _cycles(parents: dict[str, str | None]) -> list[str]:
    out = []
    for start in parents:
        seen, at = set(), start
        while at in parents and at not in seen:
            seen.add(at)
            at = parents[at]
        if at == start:
            out.append(start)
    return sorted(out)


def of_table(table: dict[str, dict]) -> Ontology:
    """An ontology from a table like ``RELATIONS``."""
    relations = {
        name: RelationType(
            name, frozenset(r["head"]), None if r["tail"] is None else frozenset(r["tail"]), ONT + name, r.get("symmetric", False), r.get("parent"), tuple(r.get("aliases", ())), tuple(r.get("inverse", ())),
        )
        for name, r in table.items()
    }
    return Ontology(relations)


def default() -> Ontology:
    return of_table(RELATIONS)


def load(path: str | None = None) -> Ontology:
    """An ontology from a JSON file (relations, label_hierarchy, modifiers), or the built-in one."""
    if path is None:
        return default()
    data = json.loads(Path(path).read_text())
    labels = lambda x: None if x is None else frozenset([ANY] if x == ANY else x)
    relations = {
        n: RelationType(n, labels(r["head"]), labels(r.get("tail")), expand(r["uri"]), bool(r.get("symmetric")), r.get("subPropertyOf"), tuple(r.get("aliases", ())), tuple(r.get("inverseOf", ())))
        for n, r in data["relations"].items()
        if not n.startswith("_")
    }
    parents = {k: v for k, v in data.get("label_hierarchy", {}).items() if not k.startswith("_")}
    modifiers = {k: expand(v["uri"]) for k, v in data.get("modifiers", {}).items() if not k.startswith("_")}
    return Ontology(relations, parents, modifiers or {k: expand(v) for k, v in MODIFIER_PROPERTIES.items()})


def propose(definitions: DataFrame, structure: DataFrame, groups: DataFrame, known: Ontology) -> DataFrame:
    """Candidate types from a semantic network: relations not known yet, with mapped head and tail labels.

    ``definitions``: ui, name, tree, definition, inverse; ``structure``: head,
    relation, tail; ``groups``: semantic type name to label.
    """
    spark = definitions.sparkSession
    taken = spark.createDataFrame([(n,) for n in known.names(spark).toPandas()["name"]], "name string")
    mapped = structure.join(groups.select(F.col("sty").alias("head"), F.col("label").alias("h")), "head").join(groups.select(F.col("sty").alias("tail"), F.col("label").alias("t")), "tail")
    ends = mapped.groupBy("relation").agg(F.array_sort(F.collect_set("h")).alias("head_labels"), F.array_sort(F.collect_set("t")).alias("tail_labels"))
    return definitions.join(taken, "name", "left_anti").join(ends, F.col("name") == F.col("relation")).select("name", "definition", "inverse", "head_labels", "tail_labels")


def near_names(candidates: DataFrame, known: DataFrame, least: float = 0.6) -> DataFrame:
    """For each candidate ``name`` the known one with the largest word overlap, if that is at least ``least``.

    Both sides are ontologies' type names, a bounded number.
    """
    words = lambda c: F.array_distinct(F.split(F.lower(c), "[^a-z0-9]+"))
    pairs = candidates.select("name").join(F.broadcast(known.select(F.col("name").alias("known"))), F.arrays_overlap(words(F.col("name")), words(F.col("known"))))
    a, b = words(F.col("name")), words(F.col("known"))
    scored = pairs.withColumn("overlap", F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).where(F.col("overlap") >= least)
    best = F.max_by(F.struct("known", "overlap"), F.struct("overlap", F.col("known"))).alias("b")
    return scored.groupBy("name").agg(best).select("name", "b.known", "b.overlap")
