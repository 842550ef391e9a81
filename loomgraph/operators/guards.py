"""Deterministic quality rules over relations.

Rules demote (polarity ``uncertain``) and file a review row; only the two
redundancy rules drop rows.  What a rule needs of one relation alone is worked
out once, in a context of relation, both spans and chunk; rules over several
relations are joins on concepts within a document.  Rules run in a fixed order
because most look at what is still affirmed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import RELATION_FLOOR, concept_of, union
from ..ontology import ROLE_CHANGING, Ontology, default
from ..sources.tables import materialise, release

# Phrases that change what the mention after them denotes.
BEFORE = (
    r"deficien(?:cy|t|cies)", r"insufficien(?:t|cy)", "inadequate", "lack of", "absence of", r"deplet(?:ion|ed)", "loss of", r"excess(?:ive)?", "elevated", "raised",
    "overproduction", "underproduction", "hyper-?secretion", "hypo-?secretion", "too much", "too little", "impaired", "reduced", "decreased", "increased", "resistance to",
    "unopposed", "reverse", "inactive", "against", "attacks?", r"antibodies (?:to|against)", "autoantibodies", "destruction of", "removal of", "removing", "conversion of",
    "converting", "breakdown of", "degradation of", "excretion of", "uptake of", "transport of", "binding of", "levels? of", "concentrations? of", "amounts? of",
)
# Nouns right after a mention that make it the first half of another noun phrase.
AFTER = (
    "resorption", "secretion", "synthesis", "uptake", "transport", "excretion", "metabolism", "de-?iodination", "iodination", "conversion", "production", "release",
    "formation", "degradation", "breakdown", "clearance", "turnover", "storage", "binding", "atoms?", "levels?", "concentrations?", "deficiency", "excess", "intake",
    "content", "activity", "receptors?", "antibodies", "antagonists?", "agonists?", "replacement", "supplementation", "hormones?", "drugs?", "medications?", "medicines?",
    "agents?", "axis", "therapy", "therapies", "treatments?", "disorders?", "dysfunction", "failure", "insufficiency", "disease", "syndrome", "systems?",
)
# Words that name a category rather than a thing.
VACUOUS = (
    "organ organs tissue tissues body system systems structure structures condition conditions disease disorder disorders hormone hormones level levels function cell "
    "cells gland glands patient patients area areas region regions process processes factor factors substance substances symptom symptoms"
).split()
# Connectives, by whether the cause (or starting material) comes before or after them.
CAUSE_FIRST = (
    "causes", "cause of", "leads? to", "leading to", "results? in", "resulting in", "induces?", "produces?", "contributes? to", "contributing to", "progresses? to",
    "gives? rise to", "responsible for", "predisposes? to", "triggers?", "precipitates?",
)
EFFECT_FIRST = (
    "caused by", "due to", "results? from", "resulting from", "arises? from", "arising from", "secondary to", "consequence of", "complication of", "attributable to",
    "owing to", "stems? from", "cause is", "causes are", "brought on by", "provoked by",
)
SOURCE_FIRST = (
    "into", "converted to", "converts? to", "reduced to", "oxidi[sz]ed to", "deiodinated to", "metaboli[sz]ed to", "transformed to", "yields?", "to form", "to produce",
    "to yield", "becomes?", "giving",
)
PRODUCT_FIRST = ("derived from", "formed from", "produced from", "converted from", "reduced from", "originates from", "arises from", "from")
STRUCTURAL = ("located_in", "part_of", "composed_of", "connects_to", "finding_site")
CAUSAL, CAUSAL_INVERTED = ("caused_by", "complication_of"), ("risk_factor_for",)
PRODUCTION, ACTIVATION = ("secretes", "synthesizes", "produces", "expresses"), ("stimulates", "regulates")
ANTONYMS = (("hyper-", "hypo-"), ("hyper", "hypo"), ("over", "under"))
_ENUMERATOR = r"(?i)^(?:type|class|stage|grade|group|phase|step|form)\s*[0-9ivx]+$"
WINDOW_BEFORE, WINDOW_AFTER = 48, 27
DEGENERATE_LEAST, DEGENERATE_SHARE = 8, 0.9
#: Keys that are sent to all; characters of text by which mentions meet sentences.
FEW, STRETCH = 20_000, 2048


def _any(cues: tuple[str, ...]) -> str:
    return f"(?:{'|'.join(cues)})"


def governed(text: Column, start: Column, end: Column) -> Column:
    """Whether the mention at [start, end) is only part of the phrase that carries the meaning."""
    before = F.substring(text, F.greatest(start - WINDOW_BEFORE + 1, F.lit(1)), F.least(start, F.lit(WINDOW_BEFORE)))
    after = F.substring(text, end + 1, F.lit(WINDOW_AFTER))
    # from the cue to the mention: the same clause and four words at most
    gap = r"(?:[^.;\s]+(?:\s+[^.;\s]+){0,3}|(?:\s+[^.;\s]+){0,4})\s*$"
    pre = before.rlike(rf"(?iU)(?s){_any(BEFORE)}{gap}")
    return pre | after.rlike(rf"(?iU)^[\s\-]{{0,3}}(?:\([A-Za-z0-9/\-]{{1,12}}\)[\s\-]{{0,2}})?{_any(AFTER)}\b")


def orientation(between: Column, forward: tuple[str, ...], backward: tuple[str, ...]) -> Column:
    """``forward``, ``backward``, or null where neither or both kinds of connective stand between two mentions."""
    f, b = between.rlike(f"(?i){_any(forward)}"), between.rlike(f"(?i){_any(backward)}")
    return F.when(f & ~b, "forward").when(b & ~f, "backward")


def sentence_window(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """[start, end) widened to the sentences it lies in; they end with ``.``, ``!``, ``?`` or a line break."""
    left = start - F.length(F.regexp_extract(F.substring(text, F.lit(1), start), r"[^.!?\n]*$", 0))
    ended = F.substring(text, end, F.lit(1)).rlike(r"[.!?\n]")
    more = F.length(F.regexp_extract(F.substring(text, end + 1, F.length(text)), r"^[^.!?\n]*[.!?\n]?", 0))
    return left, F.when(ended, end).otherwise(end + more)


def antonym_stem(text: Column) -> tuple[Column, Column]:
    """What is left after an antonym prefix with the prefix pair, and which side of the pair it is; nulls without one."""
    low = F.lower(F.trim(text))
    stem, side = F.lit(None).cast("string"), F.lit(None).cast("int")
    for k, pair in reversed(list(enumerate(ANTONYMS))):
        for n, prefix in enumerate(pair):
            hit = low.startswith(prefix)
            stem = F.when(hit, F.concat(F.lit(f"{k}:"), F.substring(low, F.lit(len(prefix) + 1), F.length(low)))).otherwise(stem)
            side = F.when(hit, F.lit(n)).otherwise(side)
    return stem, side


def context(relations: DataFrame, spans: DataFrame, chunks: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """Each relation with concepts, what the rules over several relations compare, and the verdicts that need nothing else.

    Each join is stored before the next one, so only one exchange is there at a time.
    """
    ontology = ontology or default()
    role = F.exists(F.coalesce("modifiers", F.array().cast(dict(spans.dtypes)["modifiers"])), lambda m: m["type"].isin(*ROLE_CHANGING))
    flat = spans.select("source_id", "span_id", "chunk_id", "text", "char_start", "char_end", "uri", role.alias("role"))
    end = lambda x: flat.select("source_id", F.col("span_id").alias(x), *(F.col(c).alias(f"{x[0]}_{c}") for c in ("chunk_id", "text", "char_start", "char_end", "uri", "role")))
    held = chunks.select("source_id", F.col("chunk_id").alias("h_chunk_id"), F.col("text").alias("body"), F.col("char_start").alias("base"))
    flat = materialise(flat, "ends")
    headed = materialise(relations.join(end("head"), ["source_id", "head"], "left"), "heads")
    both_ends = materialise(headed.join(end("tail"), ["source_id", "tail"], "left"), "tails")
    release(headed, flat)
    c = both_ends.join(held, ["source_id", "h_chunk_id"], "left")
    symmetric = [t.name for t in ontology.relations.values() if t.symmetric]
    c = c.withColumn("hc", concept_of(F.col("h_uri"), F.col("h_text"))).withColumn("tc", concept_of(F.col("t_uri"), F.col("t_text")))
    near = lambda x: (x - F.col("base")).try_cast("int")  # noqa: E731  a place in the chunk; places in the corpus may be long
    a, b = near(F.col("evidence_start")), near(F.col("evidence_end"))
    usable = F.coalesce((a >= 0) & (b <= F.length("body")) & (a < b), F.lit(False))
    left, right = sentence_window(F.col("body"), a, b)
    c = c.withColumn("scope_start", F.when(usable, left + F.col("base"))).withColumn("scope_end", F.when(usable, right + F.col("base")))
    scope = F.substring("body", near(F.col("scope_start")) + 1, (F.col("scope_end") - F.col("scope_start")).try_cast("int"))

    def grounded(x: str) -> Column:
        inside = (F.col("scope_start") <= F.col(f"{x}_char_start")) & (F.col(f"{x}_char_end") <= F.col("scope_end"))
        return F.coalesce(F.col(f"{x}_text").isNull() | inside | F.contains(F.lower(scope), F.lower(f"{x}_text")), F.lit(False))

    def part_of_phrase(x: str) -> Column:
        s, e = near(F.col(f"{x}_char_start")), near(F.col(f"{x}_char_end"))
        same = (F.col(f"{x}_chunk_id") == F.col("h_chunk_id")) & ~F.col(f"{x}_role") & (s >= 0) & (e <= F.length("body"))
        return F.coalesce(same & governed(F.col("body"), s, e), F.lit(False))

    together = (F.col("t_chunk_id") == F.col("h_chunk_id")) & (F.col("h_char_start") != F.col("t_char_start"))
    head_first = F.col("h_char_start") < F.col("t_char_start")
    first = near(F.when(head_first, F.col("h_char_end")).otherwise(F.col("t_char_end")))
    second = near(F.when(head_first, F.col("t_char_start")).otherwise(F.col("h_char_start")))
    between = F.when(together & (second > first), F.substring("body", first + 1, second - first))
    cause, conversion = orientation(between, CAUSE_FIRST, EFFECT_FIRST), orientation(between, SOURCE_FIRST, PRODUCT_FIRST)
    should = F.when(F.col("type").isin(*CAUSAL_INVERTED), cause == "forward").otherwise(cause == "backward")
    no = F.lit(False)
    word = lambda x: F.lower(F.trim(f"{x}_text"))
    enumerator = lambda x: F.coalesce(F.trim(f"{x}_text").rlike(_ENUMERATOR), no)
    vacuous = lambda x: F.coalesce(word(x).isin(*VACUOUS), no)
    both = F.col("hc").isNotNull() & F.col("tc").isNotNull()
    key = lambda x: F.coalesce(F.nullif(f"{x}_uri", F.lit("")), F.lower(f"{x}_text"))
    stem, side = antonym_stem(F.col("h_text"))
    rows = c.select(
        *relations.columns, "hc", "tc", key("h").alias("head_key"), key("t").alias("tail_key"), stem.alias("stem"), side.alias("side"), "scope_start", "scope_end",
        (F.col("h_text").isNotNull() & usable & ~grounded("h")).alias("head_out"), (F.col("h_text").isNotNull() & usable & ~grounded("t")).alias("tail_out"),
        (F.col("body").isNotNull() & (part_of_phrase("t") | part_of_phrase("h"))).alias("is_governed"),
        F.coalesce(F.col("type").isin(*CAUSAL, *CAUSAL_INVERTED) & cause.isNotNull() & (head_first != should), no).alias("is_reversed"),
        F.coalesce((F.col("type") == "converts_to") & conversion.isNotNull() & (head_first != (conversion == "forward")), no).alias("is_unconverted"),
        F.coalesce(both & ~F.col("type").isin(*symmetric) & ((F.col("hc") == F.col("tc")) | (word("h") == word("t"))), no).alias("is_loop"),
        (enumerator("h") | enumerator("t")).alias("is_fragment"), (vacuous("t") | vacuous("h")).alias("is_vacuous"),
        F.coalesce(F.col("type").isin(*STRUCTURAL) & (F.coalesce("h_role", no) | F.coalesce("t_role", no)), no).alias("is_structural"),
        F.col("type").isin(*symmetric).alias("symmetric"), F.array().cast("array<string>").alias("fired"),
    )
    rows = materialise(rows, "context")
    release(both_ends)
    return rows


def direction_conflicts(ctx: DataFrame) -> DataFrame:
    """Keys of the relations of a directed type that are asserted both ways round, whatever their polarity."""
    rows = ctx.where(_directed()).select("source_id", "type", "head_key", "tail_key")
    ahead = F.col("head_key") < F.col("tail_key")
    pairs = rows.groupBy("source_id", "type", F.least("head_key", "tail_key").alias("a"), F.greatest("head_key", "tail_key").alias("b")).agg(F.bool_or(ahead).alias("f"), F.bool_or(~ahead).alias("r"))
    both = pairs.where("f AND r").select("source_id", "type", F.explode(F.array(F.struct(F.col("a").alias("h"), F.col("b").alias("t")), F.struct(F.col("b").alias("h"), F.col("a").alias("t")))).alias("x"))
    return both.select("source_id", "type", F.col("x.h").alias("head_key"), F.col("x.t").alias("tail_key"))


def _directed() -> Column:
    return ~F.col("symmetric") & (F.col("head_key") != F.col("tail_key"))


def antonym_conflicts(ctx: DataFrame) -> DataFrame:
    """Keys of the affirmed relations with an opposite: heads of both sides of a stem, same type and tail.

    Pairs meet on (type, tail, stem), never as all pairs of a tail.
    """
    rows = ctx.where("polarity = 'affirmed' AND tail_key IS NOT NULL AND stem IS NOT NULL")
    sides = rows.groupBy("source_id", "type", "tail_key", "stem").agg(F.bool_or(F.col("side") == 0).alias("a"), F.bool_or(F.col("side") == 1).alias("b"))
    return sides.where("a AND b").drop("a", "b")


def _demote(ctx: DataFrame, at: Column, hits: DataFrame, stage: str) -> DataFrame:
    """Rows where ``at`` holds and whose key is in ``hits`` (distinct) become uncertain and get ``stage``.

    Few keys are sent to all. With many only the rows that may be hit are dealt
    out by their key, and the result is stored.
    """
    hits = materialise(hits, "hits")
    keys, flag = hits.columns, hits.withColumn("_hit", F.lit(True))
    few = hits.count() <= FEW
    may = F.coalesce(at, F.lit(False))
    rows = ctx.join(F.broadcast(flag), keys, "left") if few else ctx.where(may).join(flag, keys, "left")
    hit = may & F.coalesce("_hit", F.lit(False))
    out = rows.select(*(F.when(hit, F.array_append("fired", F.lit(stage))).otherwise(F.col("fired")).alias(c) if c == "fired" else F.when(hit, F.lit("uncertain")).otherwise(F.col("polarity")).alias(c) if c == "polarity" else F.col(c) for c in ctx.columns))
    return out if few else materialise(out.unionByName(ctx.where(~may)), "context")


def _local(ctx: DataFrame, verdicts: list[tuple[str, str]]) -> DataFrame:
    """Row-local rules in order; each looks at rows that are still affirmed."""
    for column, stage in verdicts:
        hit = (F.col("polarity") == "affirmed") & F.col(column)
        ctx = ctx.withColumns({"fired": F.when(hit, F.array_append("fired", F.lit(stage))).otherwise(F.col("fired")), "polarity": F.when(hit, "uncertain").otherwise(F.col("polarity"))})
    return ctx


def ungrounded(ctx: DataFrame, spans: DataFrame) -> DataFrame:
    """Relations whose cited sentences hold an end neither by place, nor by text, nor by another mention of its concept.

    An end that is out lies outside the sentences itself, so any mention inside
    them is another one. Mentions meet sentences by concept and stretch of text:
    a frequent concept's mentions are not all compared with all.
    """
    out = [F.struct(F.col(f).alias("out"), F.col(c).alias("concept")) for f, c in (("head_out", "hc"), ("tail_out", "tc"))]
    rows = ctx.where("head_out OR tail_out").select("source_id", "rel_id", "scope_start", "scope_end", F.explode(F.filter(F.array(*out), lambda x: x["out"])).alias("e"))
    stretches = F.sequence(F.floor(F.col("scope_start") / STRETCH), F.floor(F.col("scope_end") / STRETCH))
    rows = rows.select("source_id", "rel_id", F.col("e.concept").alias("concept"), "scope_start", "scope_end")
    asked = rows.where("concept IS NOT NULL").select("*", F.explode(stretches).alias("stretch"))
    mentions = spans.select("source_id", concept_of(F.col("uri"), F.col("text")).alias("concept"), F.floor(F.col("char_start") / STRETCH).alias("stretch"), "char_start", "char_end")
    inside = (F.col("scope_start") <= F.col("char_start")) & (F.col("char_end") <= F.col("scope_end"))
    ends = ["source_id", "rel_id", "concept"]
    held = asked.join(mentions, ["source_id", "concept", "stretch"]).where(inside).select(*ends).distinct()
    return rows.select(*ends).join(held, [rows[c].eqNullSafe(held[c]) if c == "concept" else rows[c] == held[c] for c in ends], "left_anti").select("source_id", "rel_id").distinct()


def run(relations: DataFrame, spans: DataFrame, chunks: DataFrame, ontology: Ontology | None = None) -> tuple[DataFrame, DataFrame]:
    """All rules in order: the relations that stay, with their polarity, and one review row for each rule that fired."""
    ontology = ontology or default()
    affirmed = F.col("polarity") == "affirmed"
    known = affirmed & F.col("hc").isNotNull() & F.col("tc").isNotNull()
    ctx = held = context(relations, spans, chunks, ontology)

    def demote(at: Column, hits: DataFrame, stage: str) -> DataFrame:
        nonlocal held
        out = _demote(ctx, at, hits, stage)
        if hasattr(out, "loomgraph_path"):  # stored anew: nothing reads the table before it any more
            release(held)
            held = out
        return out

    ctx = demote(_directed(), direction_conflicts(ctx), "re-direction")
    ctx = demote(affirmed, antonym_conflicts(ctx), "re-antonym-conflict")
    out = affirmed & (F.col("head_out") | F.col("tail_out"))
    if not ctx.where(out).isEmpty():
        ctx = demote(out, ungrounded(ctx.where(affirmed), spans), "re-evidence-scope")
    ctx = _local(ctx, [("is_governed", "re-governed-role"), ("is_reversed", "re-causal-direction"), ("is_unconverted", "re-conversion-direction")])
    made = ctx.where(known & F.col("type").isin(*PRODUCTION)).select("source_id", F.col("hc").alias("tc"), F.col("tc").alias("hc")).distinct()
    ctx = demote(known & F.col("type").isin(*ACTIVATION), made, "re-feedback-loop")
    ctx = _local(ctx, [("is_loop", "re-self-loop"), ("is_fragment", "re-fragment-span"), ("is_vacuous", "re-vacuous-endpoint"), ("is_structural", "re-structural-deviation")])
    enzymes = materialise(ctx.where(known & (F.col("type") == "catalyzes")).select("source_id", F.col("hc").alias("c")).distinct(), "enzymes")
    for end in ("hc", "tc"):  # a relation that the first has demoted is not affirmed any more
        ctx = demote(known & (F.col("type") == "converts_to"), enzymes.withColumnRenamed("c", end), "re-enzyme-as-substrate")
    judged = materialise(ctx.select(*relations.columns, "hc", "tc", "fired"), "judged")
    release(held)
    kept, dropped = drop_redundant(judged, ontology)
    review = judged.select("source_id", "rel_id", "seq", F.explode("fired").alias("stage")).unionByName(dropped)
    return kept.select("source_id", "rel_id", *(c for c in relations.columns if c not in ("source_id", "rel_id", "polarity")), "polarity"), review


def drop_redundant(ctx: DataFrame, ontology: Ontology) -> tuple[DataFrame, DataFrame]:
    """Without affirmed relations that repeat a fact (the best score stays, then the first) or that a more specific one implies."""
    pair = (F.col("polarity") == "affirmed") & F.col("hc").isNotNull() & F.col("tc").isNotNull()
    key = ["source_id", "type", "hc", "tc"]
    # the winner by a partial aggregate, so a fact that is stated very often is no window partition
    rank = F.struct(F.coalesce("score", F.lit(-1.0)).alias("score"), (-F.col("seq")).alias("seq"), "rel_id")
    best = ctx.where(pair).groupBy(*key).agg(F.max_by("rel_id", rank).alias("winner"))
    rows = materialise(ctx.where(pair).join(best, key).withColumn("again", F.col("rel_id") != F.col("winner")).drop("winner"), "deduplicated")
    parents = [(t.name, t.parent) for t in ontology.relations.values() if t.parent]
    up = ctx.sparkSession.createDataFrame(parents, "child string, parent string")
    first = rows.where(~F.col("again"))
    specific = first.join(F.broadcast(up), F.col("type") == F.col("child")).select("source_id", F.col("parent").alias("type"), "hc", "tc").distinct()
    # only types that are a parent of another can be implied
    implied = F.col("type").isin(sorted({p for _, p in parents}))
    asked = materialise(first.where(implied).join(specific.withColumn("implied", F.lit(True)), key, "left").withColumn("implied", F.coalesce("implied", F.lit(False))), "implied")
    columns = ctx.columns
    kept = union([ctx.where(~F.coalesce(pair, F.lit(False))), first.where(~implied).select(*columns), asked.where(~F.col("implied")).select(*columns)])
    gone = rows.where("again").select("source_id", "rel_id", "seq", F.lit("re-duplicate").alias("stage"))
    return kept, gone.unionByName(asked.where("implied").select("source_id", "rel_id", "seq", F.lit("re-subsumed").alias("stage")))


def degenerate_confidence(relations: DataFrame, least: int = DEGENERATE_LEAST, share: float = DEGENERATE_SHARE) -> DataFrame:
    """Documents nearly all of whose scores are one number: that number, its count, and the total."""
    counts = relations.where("score IS NOT NULL").groupBy("source_id", F.round("score", 3).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    mode = F.max_by(F.struct("value", "n"), F.struct("n", (-F.col("first")).alias("first"))).alias("m")
    rows = counts.groupBy("source_id").agg(mode, F.sum("n").alias("total"))
    return rows.where((F.col("total") >= least) & (F.col("m.n") / F.col("total") >= share)).select("source_id", "m.value", F.col("m.n").alias("n"), "total")


def degenerate_review(relations: DataFrame) -> DataFrame:
    """A review row for each document whose scores are next to constant."""
    rows = degenerate_confidence(relations)
    reason = F.concat_ws(" ", "n", F.lit("of"), "total", F.lit("scores are"), "value")
    return rows.select("source_id", F.lit("re-degenerate-confidence").alias("stage"), reason.alias("reason"), "value", "n", "total")


def report(kept: DataFrame, review: DataFrame) -> DataFrame:
    """Entries of each rule, and the number of relations still affirmed."""
    counts = review.groupBy(F.col("stage").alias("guard")).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(kept.where("polarity = 'affirmed'").agg(F.lit("affirmed_remaining").alias("guard"), F.count(F.lit(1)).alias("n")))


def review_summary(review: DataFrame) -> DataFrame:
    """Review rows by stage and code: count, share, and the first reason given; most frequent first."""
    rows = review.groupBy("stage", F.coalesce(F.nullif("code", F.lit("")), F.lit("-")).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.min_by(F.nullif("reason", F.lit("")), F.when(F.coalesce("reason", F.lit("")) != "", F.col("seq"))).alias("example"))
    total = rows.agg(F.sum("n").alias("total"))
    return rows.crossJoin(F.broadcast(total)).select("stage", "code", "n", F.round(100 * F.col("n") / F.col("total"), 1).alias("share"), "example").orderBy(F.desc("n"), "stage", "code")


def validate(candidates: DataFrame, spans: DataFrame, chunks: DataFrame, ontology: Ontology | None = None, floor: float = RELATION_FLOOR, carry: tuple[str, ...] = ()) -> DataFrame:
    """Proposed relations with the ``code`` of the first check they fail (null: none) and the place of their evidence.

    ``candidates``: source_id, chunk_id, type, head, tail, evidence, confidence.
    Names are resolved first, inverse ones swap the ends; labels count with what they are also.
    """
    ontology = ontology or default()
    spark = candidates.sparkSession
    names = ontology.names(spark).withColumnRenamed("type", "real").withColumnRenamed("name", "type")
    rows = candidates.join(F.broadcast(names), "type", "left")
    swap = F.coalesce("swap", F.lit(False))
    rows = rows.withColumns({"head": F.when(swap, F.col("tail")).otherwise(F.col("head")), "tail": F.when(swap, F.col("head")).otherwise(F.col("tail"))})
    end = lambda x: spans.select("source_id", F.col("span_id").alias(x), F.col("label").alias(f"{x}_label"), F.lit(True).alias(f"{x}_known"))
    rows = rows.join(end("head"), ["source_id", "head"], "left").join(end("tail"), ["source_id", "tail"], "left")
    rows = rows.join(F.broadcast(ontology.types(spark).select(F.col("type").alias("real"), "head_labels", "tail_labels")), "real", "left")
    rows = rows.join(chunks.select("source_id", "chunk_id", F.col("text").alias("body"), F.col("char_start").alias("base")), ["source_id", "chunk_id"], "left")
    parents = F.create_map(*(F.lit(x) for pair in ontology.label_parents.items() for x in pair)) if ontology.label_parents else None

    def fits(label: Column, allowed: Column) -> Column:
        out, at = F.coalesce(F.array_contains(allowed, label), F.lit(False)) | F.array_contains(allowed, "*ANY*"), label
        for _ in range(len(ontology.label_parents)):
            at = F.try_element_at(parents, at)
            out = out | F.coalesce(F.array_contains(allowed, at), F.lit(False))
        return F.coalesce(label.isNotNull() & out, F.lit(False))

    at = F.expr("locate(evidence, body)")
    unary = F.col("tail_labels").isNull()
    code = (
        F.when(F.col("real").isNull(), "unknown-type")
        .when(F.col("head_known").isNull(), "head-span-missing")
        .when(~fits(F.col("head_label"), F.col("head_labels")), F.concat(F.lit("head-label:"), F.col("real")))
        .when(~unary & F.col("tail_known").isNull(), "tail-span-missing")
        .when(~unary & ~fits(F.col("tail_label"), F.col("tail_labels")), F.concat(F.lit("tail-label:"), F.col("real")))
        .when(F.coalesce("confidence", F.lit(0.0)) < floor, "below-floor")
        .when((F.coalesce("evidence", F.lit("")) == "") | (at == 0) | at.isNull(), "ungrounded-evidence")
    )
    start = F.when(at > 0, F.col("base") + at - 1).cast("int")
    return rows.select(*carry, "source_id", "chunk_id", F.coalesce("real", "type").alias("type"), "head", "tail", "confidence", code.alias("code"), start.alias("evidence_start"), (start + F.length("evidence")).cast("int").alias("evidence_end"))


def backfill_codes(review: DataFrame, spans: DataFrame, chunks: DataFrame, ontology: Ontology | None = None, floor: float = RELATION_FLOOR) -> DataFrame:
    """Review rows of rejected relations that hold the reply's item but no code, with the code that today's rules give.

    ``review``: stage, code and the columns that ``validate`` needs; an item that
    would be accepted now says so, and rows of unknown chunks stay as they are.
    """
    keyed = review.withColumn("_row", F.xxhash64("source_id", "chunk_id", "type", "head", "tail", "evidence", "confidence"))
    open_ = keyed.where((F.col("stage") == "re") & (F.coalesce("code", F.lit("")) == "") & F.col("type").isNotNull()).join(chunks.select("source_id", "chunk_id"), ["source_id", "chunk_id"], "left_semi")
    asked = open_.select("_row", "source_id", "chunk_id", "type", "head", "tail", "evidence", "confidence").dropDuplicates(["_row"])
    found = validate(asked, spans, chunks, ontology, floor, ("_row",)).select("_row", F.coalesce("code", F.lit("would-now-pass")).alias("_code"))
    empty = (F.col("stage") == "re") & (F.coalesce("code", F.lit("")) == "")
    return keyed.join(found, "_row", "left").withColumn("code", F.when(empty, F.coalesce("_code", "code")).otherwise(F.col("code"))).drop("_row", "_code")


def candidate_pairs(spans: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """Ordered pairs of spans in a chunk that some type admits by their own labels; the admitted label pairs are a bounded table."""
    spark = spans.sparkSession
    admitted = (ontology or default()).admitted(spark, hierarchy=False).where("tail_label IS NOT NULL").select("head_label", "tail_label").distinct()
    head = spans.select("source_id", "chunk_id", F.col("span_id").alias("head"), F.col("label").alias("head_label")).join(F.broadcast(admitted), "head_label")
    tail = spans.select("source_id", "chunk_id", F.col("span_id").alias("tail"), F.col("label").alias("tail_label"))
    return head.join(tail, ["source_id", "chunk_id", "tail_label"]).where("head <> tail").select("source_id", "chunk_id", "head", "tail").distinct()


def pair_counts(spans: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """How many pairs ``candidate_pairs`` has for each chunk, counted by labels: work grows with the spans, not with their pairs."""
    spark = spans.sparkSession
    admitted = (ontology or default()).admitted(spark, hierarchy=False).where("tail_label IS NOT NULL").select("head_label", "tail_label").distinct()
    # a span's labels together, so one with several counts once
    held = spans.where("span_id IS NOT NULL AND label IS NOT NULL").groupBy("source_id", "chunk_id", "span_id").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    kinds = held.groupBy("source_id", "chunk_id", "labels").agg(F.count(F.lit(1)).alias("n"))
    sets = kinds.select("labels").distinct()
    heads = sets.select(F.col("labels").alias("a"), F.explode("labels").alias("head_label")).join(F.broadcast(admitted), "head_label")
    tails = sets.select(F.col("labels").alias("b"), F.explode("labels").alias("tail_label"))
    joined = F.broadcast(heads.join(tails, "tail_label").select("a", "b").distinct())  # pairs of sets of labels: of the ontology's size
    side = lambda x, n: kinds.select("source_id", "chunk_id", F.col("labels").alias(x), F.col("n").alias(n))
    both = side("a", "n_a").join(joined, "a").join(side("b", "n_b"), ["source_id", "chunk_id", "b"])
    pairs = F.col("n_a") * (F.col("n_b") - F.when(F.col("a") == F.col("b"), 1).otherwise(0))
    return both.groupBy("source_id", "chunk_id").agg(F.sum(pairs).alias("pairs")).where("pairs > 0")


def number(rows: DataFrame, prefix: str, key: str = "source_id", order: str = "seq") -> Column:
    """Per-document counter ids in document order, as ``r001``."""
    return F.format_string(f"{prefix}%03d", F.row_number().over(Window.partitionBy(key).orderBy(order)))
