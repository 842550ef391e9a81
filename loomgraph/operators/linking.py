"""Linking of mentions to concepts: exact vector top-k, floors and margins, crosswalks, label reconciliation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import LINK_FLOOR, LINK_K, RERANK_MARGIN, RXNORM, SNOMED, UMLS

# Which label a concept with several semantic types gets, first to last.
LABEL_PRIORITY = ("Cell", "CellComponent", "Protein", "Drug", "AnatomicalSystem", "BodyStructure", "Substance", "Disease", "Symptom", "Morphology", "Finding", "Organism")
QUERY_BLOCK, ATOM_BLOCK = 4096, 16384


def normalise(vector: Column) -> Column:
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: x / (norm + 1e-12))


def top_k(queries: DataFrame, atoms: DataFrame, k: int = LINK_K, fetch: int | None = None, own_first: bool = False) -> DataFrame:
    """The ``k`` best concepts of each query by inner product: query, cui, score, rank (ties: the smaller concept).

    ``queries``: query, vector; ``atoms``: cui, vector, both normalised.  As in a
    flat index ``fetch`` best atoms are found first (all that tie included is
    not needed: the best atom of a concept is what counts) and then collapsed to
    concepts.  Both sides go in blocks of bounded size, a product of matrices
    for each pair of blocks, so neither has to fit anywhere as a whole.

    A product of matrices rounds by the place of a row in it, so it only finds
    what may be among the best; those are scored anew, component by component,
    and equal vectors tie.  ``own_first``: of ties, the query's own concept.
    """
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    n_a = max(1, -(-atoms.count() // ATOM_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # one type on both sides: an int and a long of one value are dealt to different places
    block = lambda x, n: F.pmod(F.xxhash64(x), F.lit(n)).cast("int")
    left = queries.select(block("query", n_q).alias("i"), every(n_a).alias("j"), F.col("query").cast("string"), F.col("vector").cast("array<double>").alias("v"))
    # atoms of one concept may meet in several blocks: a concept has no bound
    right = atoms.select(every(n_q).alias("i"), F.pmod(F.xxhash64("cui", "vector"), F.lit(n_a)).cast("int").alias("j"), F.col("cui").cast("string"), F.col("vector").cast("array<double>").alias("v"))
    names = ["query", "cui", "score"]

    def best(asked: pa.Table, own: pa.Table) -> pa.Table:
        q_ids, c_ids = asked.column("query").to_pylist(), np.array(own.column("cui").to_pylist(), object)
        if not len(q_ids) or not len(c_ids):
            return pa.table([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.float64())], names=names)
        q, a = (np.array(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1) for t in (asked, own))
        concepts, back = np.unique(c_ids.astype(str), return_inverse=True)
        order = np.argsort(back, kind="stable")
        a, back = a[order], back[order]
        starts = np.searchsorted(back, np.arange(len(concepts)))
        most = min(fetch or k, len(concepts))
        # far above what a sum of this many products can be off by
        slack = 1e-12 * a.shape[1] * max(1.0, float(np.abs(a).max())) * max(1.0, float(np.abs(q).max()))
        place = {c: n for n, c in enumerate(concepts.tolist())}
        out_q, out_c, out_s = [], [], []
        for at in range(0, len(q), 256):
            rough = q[at : at + 256] @ a.T
            top = np.maximum.reduceat(rough, starts, axis=1)
            least = np.partition(top, len(concepts) - most, axis=1)[:, len(concepts) - most] - slack
            for r, row in enumerate(rough):
                near = np.flatnonzero(row >= least[r])
                exact = np.zeros(len(near))
                for x, y in zip(q[at + r], a[near].T, strict=True):
                    exact += x * y
                kinds, first = np.unique(back[near], return_index=True)
                scores = np.maximum.reduceat(exact, first)
                mine = kinds != place.get(q_ids[at + r], -1) if own_first else np.zeros(len(kinds))
                chosen = np.lexsort((kinds, mine, -scores))[:most]
                out_q += [q_ids[at + r]] * len(chosen)
                out_c += concepts[kinds[chosen]].tolist()
                out_s += scores[chosen].tolist()
        return pa.table([pa.array(out_q, pa.string()), pa.array(out_c, pa.string()), pa.array(out_s, pa.float64())], names=names)

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(best, "query string, cui string, score double")
    found = found.groupBy("query", "cui").agg(F.max("score").alias("score"))
    ties = [F.col("cui") != F.col("query"), F.col("cui")] if own_first else [F.col("cui")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), *ties))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def needs_rerank(candidates: DataFrame, margin: float = RERANK_MARGIN) -> DataFrame:
    """Queries whose best two candidates are closer than ``margin``."""
    ahead = F.lead("score").over(Window.partitionBy("query").orderBy("rank"))
    return candidates.withColumn("next", ahead).where((F.col("rank") == 1) & (F.col("score") - F.col("next") < margin)).select("query")


def link(candidates: DataFrame, reranked: DataFrame | None = None, floor: float = LINK_FLOOR) -> DataFrame:
    """The concept of each query: the reranked choice if there is one, else the best; below ``floor`` none."""
    best = candidates.where("rank = 1").select("query", "cui", "score")
    if reranked is not None:
        chosen = candidates.join(reranked.select("query", F.col("cui").alias("chosen")), "query").where("cui = chosen").select("query", F.col("cui").alias("r_cui"), F.col("score").alias("r_score"))
        best = best.join(chosen, "query", "left").select("query", F.coalesce("r_cui", "cui").alias("cui"), F.coalesce("r_score", "score").alias("score"))
    return best.where(F.col("score") >= floor)


def link_spans(spans: DataFrame, linked: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Spans with concept, IRI and score; ``linked.query`` is the lower-cased text, each looked up once."""
    found = linked.join(crosswalk, "cui", "left").select(F.col("query").alias("_q"), F.col("cui").alias("_cui"), "score", concept_iri(F.col("cui"), F.col("codes")).alias("_uri"))
    rows = spans.drop("cui", "uri", "link_score").join(found, F.lower(F.trim("text")) == F.col("_q"), "left")
    return rows.withColumns({"cui": F.col("_cui"), "uri": F.col("_uri"), "link_score": F.col("score")}).drop("_q", "_cui", "_uri", "score")


def concept_iri(cui: Column, codes: Column) -> Column:
    """The IRI by drug code, else by clinical term code, else by concept."""
    at = lambda key, base: F.concat(F.lit(base), F.nullif(F.try_element_at(codes, F.lit(key)), F.lit("")))
    return F.coalesce(at("RXNORM", RXNORM), at("SNOMEDCT_US", SNOMED), F.concat(F.lit(UMLS), cui))


def crosswalk(names: DataFrame) -> DataFrame:
    """For each concept its codes by vocabulary (the last row wins) and its name (the first row's)."""
    codes = names.groupBy("cui", "sab").agg(F.max_by("code", "pos").alias("code"))
    codes = codes.groupBy("cui").agg(F.map_from_entries(F.collect_list(F.struct("sab", "code"))).alias("codes"))
    return codes.join(names.groupBy("cui").agg(F.min_by("string", "pos").alias("name")), "cui")


def semantic_types(types: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Distinct semantic types of each concept in order of first appearance."""
    rows = types if only is None else types.join(only.select("cui").distinct(), "cui", "left_semi")
    first = rows.groupBy("cui", "tui").agg(F.min("pos").alias("pos"))
    return first.groupBy("cui").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tui"))), lambda x: x["tui"]).alias("tuis"))


def concept_labels(types: DataFrame, labels: DataFrame, priority: tuple[str, ...] = LABEL_PRIORITY) -> DataFrame:
    """One label for each concept: the first in ``priority`` among those of its semantic types (``labels``: tui, label)."""
    place = F.array_position(F.array(*map(F.lit, priority)), F.col("label"))
    rows = types.select("cui", "tui").join(F.broadcast(labels), "tui").withColumn("place", place).where("place > 0")
    return rows.groupBy("cui").agg(F.min_by("label", "place").alias("label"))


def reconcile(spans: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans with their concept's label in place of the recogniser's (kept as ``ner_label``); and counts of the changes."""
    rows = spans.join(labels.select("cui", F.col("label").alias("_new")), "cui", "left")
    moved = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("label"))
    moves = rows.where(moved).groupBy(F.col("label").alias("old"), F.col("_new").alias("new")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "old", "new")
    rows = rows.withColumns({"ner_label": F.when(moved, F.coalesce("ner_label", "label")).otherwise(F.col("ner_label")), "label": F.coalesce("_new", "label")})
    return rows.drop("_new"), moves


def indexed_concepts(atoms: DataFrame, codes: DataFrame) -> DataFrame:
    return atoms.select("cui").union(codes.select("cui")).distinct()


def write_index(atoms: DataFrame, concepts: DataFrame, path: str) -> None:
    """The vector index as tables: ``atoms`` (cui, vector), made unit length, and ``concepts`` (cui, codes, name, tuis)."""
    atoms.select("cui", normalise(F.col("vector")).alias("vector")).write.mode("overwrite").parquet(f"{path}/atoms")
    concepts.write.mode("overwrite").parquet(f"{path}/concepts")


def open_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``atoms`` and ``concepts`` of an index."""
    return spark.read.parquet(f"{path}/atoms"), spark.read.parquet(f"{path}/concepts")


def self_retrieval(atoms: DataFrame, every: int = 50) -> DataFrame:
    """Atoms of an index, one in ``every`` by hash, whose own concept is not what their vector finds."""
    asked = atoms.withColumn("query", F.concat_ws("|", "cui", F.xxhash64("vector"))).where(F.pmod(F.xxhash64("query"), F.lit(every)) == 0)
    found = top_k(asked.select("query", "vector"), atoms, k=1)
    return found.where(F.substring_index("query", "|", 1) != F.col("cui")).where("score < 0.999999").select("query", "cui", "score")


def longest_spans(spans: DataFrame) -> DataFrame:
    """Of overlapping entity spans of a chunk the longest, then the first, taken greedily.

    The choice depends on those before it, so a chunk's spans are folded in order.
    """
    by = F.struct((-(F.col("char_end") - F.col("char_start"))).alias("size"), "char_start", "seq", "char_end", "span_id")
    ordered = spans.groupBy("source_id", "chunk_id").agg(F.array_sort(F.collect_list(by)).alias("all"))
    none = F.slice("all", 1, 0)
    clear = lambda kept, x: ~F.exists(kept, lambda y: (y["char_start"] < x["char_end"]) & (x["char_start"] < y["char_end"]))
    kept = F.aggregate("all", none, lambda acc, x: F.when(clear(acc, x), F.array_append(acc, x)).otherwise(acc))
    chosen = ordered.select("source_id", "chunk_id", F.explode(F.transform(kept, lambda x: x["span_id"])).alias("span_id"))
    return spans.join(chosen, ["source_id", "chunk_id", "span_id"], "left_semi")
