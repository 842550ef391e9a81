"""Question sets from asserted relations: eligibility, labels, distractors, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import concept_of
from ..sources.tables import materialise
from .guards import antonym_stem
from .postcoordination import compose_label, judge

#: Question for each relation type; ``{head}`` is the head's label.  Several forms of one type take turns by hash.
TEMPLATES = {
    "treated_with": ("Which of these treats {head}?", "What is given against {head}?"), "prevented_by": ("Which of these prevents {head}?",),
    "caused_by": ("Which of these brings about {head}?", "What lies behind {head}?"), "finding_site": ("Where is {head} found?",),
    "part_of": ("Which of these has {head} as a part?",), "located_in": ("Where does {head} lie?",), "composed_of": ("What is {head} made of?",),
    "secretes": ("Which of these does {head} give off?",), "synthesizes": ("Which of these does {head} make?",), "stores": ("Which of these does {head} keep?",),
    "transports": ("Which of these does {head} carry?",), "converts_to": ("What does {head} turn into?",), "catalyzes": ("Which reaction partner does {head} act upon?",),
    "regulates": ("Which of these does {head} control?",), "stimulates": ("Which of these does {head} raise?",), "inhibits": ("Which of these does {head} hold down?",),
    "requires": ("Which of these does {head} need?",), "has_function": ("What does {head} do?",), "risk_factor_for": ("Which of these does {head} make likelier?",),
    "complication_of": ("Which of these can {head} follow from?",), "diagnosed_by": ("How is {head} recognised?",), "adverse_effect_of": ("Which of these has {head} as a side effect?",),
    "contraindicated_in": ("In which of these must {head} not be given?",),
}
OPTIONS, LONGEST_OPTION, SHARE, LEAST_CAP, LONGEST_STEM = 5, 6, 0.10, 3, 300
#: Qualities that name nothing and so cannot be answers.
NOT_ANSWERS = "high low normal abnormal severe mild moderate acute chronic increased decreased elevated reduced common rare active inactive primary secondary positive negative left right".split()
# Plural and singular last words that no ending tells.
PLURAL_HEADS = (
    "viscera", "adnexa", "cristae", "rami", "sulci", "gyri", "septa", "ostia", "fasciae", "lamellae", "papillae", "villi", "alveoli", "bronchi", "nuclei", "glomeruli", "canaliculi",
    "mitochondria", "data", "criteria", "phenomena", "ganglia", "cilia", "stomata", "foramina", "cornua",
)
SINGULAR_HEADS = ("pancreas", "diabetes", "ascites", "series", "species", "faeces", "feces", "herpes")
_VERB = r"(?i)\b(?:is|are|was|were|has|have|had|can|may|does|do|causes?|leads?|results?|produces?|contains?|increases?|decreases?|stimulates?|inhibits?|secretes?|forms?|occurs?)\b"


def tidy(label: Column) -> Column:
    """Without brackets and stops around it; a capital at the start goes unless the word is an acronym."""
    label = F.trim(F.rtrim(F.ltrim(F.trim(label), F.lit("([{-–— \t")), F.lit(".,;:)]}")))
    first = F.substring_index(label, " ", 1)
    lower = (F.length(first) <= 1) | first.rlike(r"^.\p{Ll}+$")
    return F.when(lower, F.concat(F.lower(F.substring(label, 1, 1)), F.substring(label, F.lit(2), F.length(label)))).otherwise(label)


def is_abbreviation(label: Column) -> Column:
    first = F.substring_index(F.trim(label), " ", 1)
    capitals = F.regexp_count(first, F.lit(r"\p{Lu}"))
    return (F.length(first) > 0) & (F.length(first) <= 6) & ((capitals >= 2) | (first.rlike(r"^\p{Lu}") & first.rlike("[0-9]")))


def is_plural(label: Column) -> Column:
    """Whether a label takes a plural verb, by its last word."""
    last = F.lower(F.substring_index(F.trim(label), " ", -1))
    return last.isin(*PLURAL_HEADS) | (~last.isin(*SINGULAR_HEADS) & last.endswith("s") & ~last.rlike("(?:is|us|ss)$"))


def usable(label: Column) -> Column:
    """An option of a few words that names something, with its brackets whole."""
    count = lambda x: F.length(label) - F.length(F.replace(label, F.lit(x), F.lit("")))
    heading = label.rlike(r"(?i)^(?:\d+(?:\.\d+)*\s|(?:chapter|section|figure|table)\s)")
    return (F.trim(label) != "") & ~F.lower(F.trim(label)).isin(*NOT_ANSWERS) & ~heading & (count("(") == count(")")) & (F.size(F.split(F.trim(label), r"\s+")) <= LONGEST_OPTION)


def too_close(a: Column, b: Column) -> Column:
    """Equal, or one begins or ends with the other (of four characters at least)."""
    a, b = F.lower(F.trim(a)), F.lower(F.trim(b))
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return (a == b) | ((F.length(short) >= 4) & (long.startswith(short) | long.endswith(short)))


def words(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]{4,})"), 1), lambda x: ~x.isin("which", "these", "what", "where", "does", "with", "from", "must", "into", "have"))


def variant(count: Column, *parts: Column) -> Column:
    """A number below ``count`` from the SHA-1 of the parts, its first eight bytes taken as one unsigned number."""
    return (F.conv(F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16), 16, 10).cast("decimal(20,0)") % count).cast("int")


def stem(type_: Column, head: Column, rel_id: Column) -> Column:
    table = F.create_map(*(x for k, v in TEMPLATES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    forms = F.try_element_at(table, type_)
    return F.replace(F.get(forms, variant(F.size(forms), rel_id, type_)), F.lit("{head}"), head)


def evidence_text(text: Column, start: Column, end: Column) -> Column:
    """A quote widened to the line breaks or stops before and behind it (a rule of its own, not that of the guards)."""
    before = F.regexp_extract(F.substring(text, F.lit(1), start), r"(?s)((?:(?!\. |\n).)*)$", 1)
    after = F.regexp_extract(F.substring(text, end + 1, F.length(text)), r"(?s)^((?:(?!\. |\n).)*\.?)", 1)
    return F.trim(F.concat(before, F.substring(text, start + 1, end - start), after))


def mentions(spans: DataFrame) -> DataFrame:
    """Spans with concept, label key (concept and sorted qualities) and the label to show: that of its key used most, not an abbreviation."""
    qualities = judge(spans).select("source_id", "span_id", compose_label(F.lit(""), F.col("sorted")).alias("q"))
    rows = spans.join(qualities, ["source_id", "span_id"], "left")
    shown = F.trim(F.concat_ws(" ", "text", F.regexp_replace(F.coalesce("q", F.lit("")), r"^ \[|\]$|,", "")))
    rows = rows.select("source_id", "span_id", "chunk_id", "seq", "text", "label", concept_of(F.col("uri"), F.col("text")).alias("concept"), F.coalesce("q", F.lit("")).alias("q"), tidy(shown).alias("surface"))
    forms = rows.where("surface <> ''").groupBy("source_id", "concept", "q", "surface").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("surface", F.struct((~is_abbreviation(F.col("surface"))).alias("whole"), "n", F.length("surface").alias("size"), "surface"))
    return rows.join(forms.groupBy("source_id", "concept", "q").agg(best.alias("shown")), ["source_id", "concept", "q"], "left")


def build(relations: DataFrame, spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """Items: stem, options (the answer among them, sorted), answer, rationale, relation, confidence, and why each distractor was taken.

    A distractor has the answer's label, is tied to the head by no relation
    whatever its polarity, and comes from the nearest tier: tails of the same
    relation type, opposites of the answer, the same concept otherwise
    qualified, then any span of the label.  Everything stays within a document.
    """
    m = materialise(mentions(spans), "mentions")
    side = lambda x: m.select("source_id", F.col("span_id").alias(x), *(F.col(c).alias(f"{x[0]}_{c}") for c in ("concept", "q", "label", "shown", "text")))
    linked = relations.join(side("head"), ["source_id", "head"]).join(side("tail"), ["source_id", "tail"])
    linked = materialise(linked, "linked")
    edges = linked.select("source_id", F.col("h_concept").alias("a"), F.col("t_concept").alias("b"))
    blocked = edges.unionByName(edges.select("source_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    good = linked.where((F.col("polarity") == "affirmed") & F.col("type").isin(*TEMPLATES) & F.col("evidence_start").isNotNull() & F.col("evidence_end").isNotNull())
    strength = F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), (F.col("evidence_end") - F.col("evidence_start")).alias("size"), "t_text", "rel_id")
    one = good.groupBy("source_id", "h_concept", "type").agg(F.max_by("rel_id", strength).alias("rel_id"))
    good = good.join(one, ["source_id", "h_concept", "type", "rel_id"], "left_semi")
    held = chunks.select("source_id", "chunk_id", F.col("text").alias("body"), F.col("char_start").alias("base"))
    good = good.join(m.select("source_id", F.col("span_id").alias("head"), "chunk_id"), ["source_id", "head"]).join(held, ["source_id", "chunk_id"])
    good = good.withColumn("rationale", evidence_text(F.col("body"), (F.col("evidence_start") - F.col("base")).cast("int"), (F.col("evidence_end") - F.col("base")).cast("int")))
    good = good.withColumn("stem", stem(F.col("type"), F.col("h_shown"), F.col("rel_id")))
    named = F.contains(F.lower("rationale"), F.lower("t_shown")) | F.contains(F.lower("rationale"), F.lower("h_shown")) | F.contains(F.lower("rationale"), F.lower("t_text"))
    supported = (F.size(F.split("rationale", r"\s+")) >= 5) & F.col("rationale").rlike(_VERB) & named
    good = materialise(good.where(usable(F.col("t_shown")) & ~F.arrays_overlap(words(F.col("t_shown")), words(F.col("stem"))) & supported), "eligible")
    chosen = distractors(good, linked, m, blocked)
    items = good.join(chosen, ["source_id", "rel_id"]).where(F.size("picked") >= OPTIONS - 1)
    options = F.array_append(F.transform("picked", lambda x: x["shown"]), F.col("t_shown"))
    items = items.select("source_id", "rel_id", "seq", F.col("type").alias("relation"), "stem", F.array_sort(options, lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).otherwise(0)).alias("options"), F.col("t_shown").alias("answer"), F.col("t_concept").alias("key"), "rationale", F.col("score").alias("confidence"), F.transform("picked", lambda x: x["why"]).alias("distractor_basis"))
    return number_items(cap_repeats(items))


def distractors(good: DataFrame, linked: DataFrame, m: DataFrame, blocked: DataFrame) -> DataFrame:
    """The first few candidates of each item by tier and document order."""
    # The names of the tiers in the output.
    tiers = ("same-role sibling", "antonym of the answer", "same concept, different deviation", "same semantic type")
    ask = good.select("source_id", "rel_id", "type", "h_concept", "t_concept", "t_label", "t_shown", "t_text", "t_q")
    # one span stands for a concept: its first of the label
    spans = m.groupBy("source_id", F.col("label").alias("t_label"), "concept", "q").agg(F.min("seq").alias("at"), F.min_by("shown", "seq").alias("shown"), F.min_by("text", "seq").alias("text"))
    offered = ask.join(spans, ["source_id", "t_label"])
    sibling = linked.where("polarity = 'affirmed'").select("source_id", "type", F.col("t_concept").alias("concept"), F.lit(True).alias("is_sibling")).distinct()
    offered = offered.join(sibling, ["source_id", "type", "concept"], "left")
    (s1, side1), (s2, side2) = antonym_stem(F.col("text")), antonym_stem(F.col("t_text"))
    tier = F.when(F.col("is_sibling"), 0).when((s1 == s2) & (side1 != side2), 1).when((F.col("concept") == F.col("t_concept")) & ((F.col("q") == "") != (F.col("t_q") == "")), 2).otherwise(3)
    offered = offered.withColumn("tier", tier).where((F.col("concept") != F.col("h_concept")) & (F.col("concept") != F.col("t_concept")) & usable(F.col("shown")) & ~too_close(F.col("shown"), F.col("t_shown")))
    offered = offered.join(blocked.select("source_id", F.col("a").alias("h_concept"), F.col("b").alias("concept")), ["source_id", "h_concept", "concept"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("source_id", "rel_id").orderBy("tier", "at", "concept"))
    why = F.element_at(F.array(*map(F.lit, tiers)), F.col("tier") + 1)
    first = offered.groupBy("source_id", "rel_id", "concept").agg(F.min(F.struct("tier", "at", "shown")).alias("x")).select("source_id", "rel_id", "concept", "x.*")
    top = first.withColumn("n", rank).where(F.col("n") <= OPTIONS - 1)
    return top.groupBy("source_id", "rel_id").agg(F.array_sort(F.collect_list(F.struct("n", "shown", why.alias("why")))).alias("picked"))


def cap_repeats(items: DataFrame) -> DataFrame:
    """At most a tenth of a document's items (three at least) share an answer: the most certain, then the best explained."""
    cap = items.groupBy("source_id").agg(F.greatest(F.lit(LEAST_CAP), F.ceil(F.count(F.lit(1)) * SHARE)).alias("cap"))
    order = Window.partitionBy("source_id", "key").orderBy(F.desc_nulls_last("confidence"), F.desc(F.length("rationale")), "stem")
    return items.withColumn("_n", F.row_number().over(order)).join(cap, "source_id").where(F.col("_n") <= F.col("cap")).drop("_n", "cap")


def number_items(items: DataFrame) -> DataFrame:
    return items.withColumn("item_id", F.format_string("q%03d", F.row_number().over(Window.partitionBy("source_id").orderBy("seq", "rel_id"))))


def accept_stem(stem: Column, options: Column) -> Column:
    """Why a rewritten stem cannot be used: the first reason; null if it can."""
    return (
        F.when(F.coalesce(F.trim(stem), F.lit("")) == "", "empty").when(~F.trim(stem).endswith("?"), "not-a-question").when(stem.rlike(r"(?i)\b(?:not|except|never|least|false)\b"), "negative")
        .when(F.exists(options, lambda o: F.arrays_overlap(words(o), words(stem))), "leaks-option").when(F.length(stem) > LONGEST_STEM, "too-long")
    )


def settle_stems(items: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Items with acceptable rewritten stems; later ones that equal an earlier stem go back to the template, and of items still equal the most certain stays."""
    rows = items.join(rewritten.select("source_id", "item_id", F.col("stem").alias("_new")), ["source_id", "item_id"], "left")
    rows = rows.withColumn("_new", F.when(F.col("_new").isNotNull() & accept_stem(F.col("_new"), F.col("options")).isNull(), F.trim("_new")))
    nth = F.row_number().over(Window.partitionBy("source_id", F.lower("_new")).orderBy("item_id"))
    use = F.col("_new").isNotNull() & (nth == 1)
    rows = rows.withColumn("_use", use).withColumns({"stem": F.when(F.col("_use"), F.col("_new")).otherwise(F.col("stem")), "stem_source": F.when(F.col("_use"), "llm").otherwise("template")})
    best = F.row_number().over(Window.partitionBy("source_id", F.lower("stem")).orderBy(F.desc_nulls_last("confidence"), "item_id"))
    return rows.withColumn("_n", best).where("_n = 1").drop("_new", "_use", "_n")
