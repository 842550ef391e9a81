"""Around injected models: prompts, replies, modifiers, entity labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import EXTRACTABLE
from ..ontology import Ontology, default

RELATION_REPLY = "array<struct<head_id:string,tail_id:string,type:string,polarity:string,evidence:string,confidence:double>>"
MODIFIER_REPLY = "array<struct<span_id:string,type:string,text:string>>"
STEM_REPLY = "array<struct<id:string,stem:string>>"


def extractable(chunks: DataFrame, kinds: tuple[str, ...] = EXTRACTABLE) -> DataFrame:
    return chunks.where(F.col("kind").isin(*kinds))


def passages_of(passages: DataFrame, kind: str) -> DataFrame:
    """Passages are text that is shown but never extracted from."""
    return passages.where(F.col("kind") == kind)


def last_json(reply: Column) -> Column:
    """The last array or object that a reply holds, reasoning and fences taken off; null if there is none."""
    text = F.regexp_replace(reply, r"(?is)^.*</think(?:ing)?>", "")
    fenced = F.regexp_extract(text, r"(?s).*```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(text)
    return F.nullif(F.regexp_extract(body, r"(?s)(\[.*\]|\{.*\})", 1), F.lit(""))


def parse_reply(reply: Column, schema: str) -> Column:
    """Rows of a JSON reply; an empty array where it holds none, never an error."""
    return F.coalesce(F.from_json(last_json(reply), schema), F.array().cast(schema))


def validate_modifiers(replies: DataFrame, spans: DataFrame, chunks: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """Modifiers of known spans and types whose words stand in the chunk (in any case), with their place."""
    types = list((ontology or default()).modifiers)
    rows = replies.join(spans.select("source_id", "span_id", "chunk_id"), ["source_id", "span_id"]).join(chunks.select("source_id", "chunk_id", F.col("text").alias("body"), "char_start"), ["source_id", "chunk_id"])
    at = F.position(F.lower("text"), F.lower("body"))
    start = (F.col("char_start") + at - 1).cast("int")
    return rows.where(F.col("type").isin(*types) & (F.trim("text") != "") & (at > 0)).select("source_id", "span_id", "type", "text", start.alias("char_start"), (start + F.length("text")).alias("char_end"))


def map_label(label: Column, known: dict[str, str]) -> Column:
    """The ontology's label of a recogniser's one, or else its words run together with capitals."""
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair)) if known else None
    camel = F.replace(F.initcap(F.regexp_replace(F.lower(label), "[_-]+", " ")), F.lit(" "), F.lit(""))
    return F.coalesce(F.try_element_at(table, label), camel) if known else camel


def relation_menu(spans: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """For each chunk the types that its spans' own labels admit."""
    admitted = (ontology or default()).admitted(spans.sparkSession, hierarchy=False).select("type", "head_label", "tail_label")
    labels = spans.select("source_id", "chunk_id", "label").distinct()
    heads = labels.join(F.broadcast(admitted), F.col("label") == F.col("head_label")).drop("label")
    tails = labels.select("source_id", "chunk_id", F.col("label").alias("tail_label"))
    both = heads.where("tail_label IS NULL").drop("tail_label").unionByName(heads.join(tails, ["source_id", "chunk_id", "tail_label"]).drop("tail_label"))
    return both.groupBy("source_id", "chunk_id").agg(F.array_sort(F.collect_set("type")).alias("types"))


def prompts(chunks: DataFrame, spans: DataFrame, menu: DataFrame) -> DataFrame:
    """What a model is asked about each chunk with a menu: heading path, text, mentions, admitted types."""
    listed = F.array_sort(F.collect_list(F.struct("seq", F.concat_ws(" | ", "span_id", "label", "text").alias("line"))))
    found = spans.groupBy("source_id", "chunk_id").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("mentions"))
    rows = extractable(chunks).join(found, ["source_id", "chunk_id"]).join(menu, ["source_id", "chunk_id"])
    return rows.select("source_id", "chunk_id", F.concat_ws("\n\n", F.array_join("section_path", " > "), "text", "mentions", F.array_join("types", ", ")).alias("prompt"))


def call_model(asked: DataFrame, make: Callable[[], Callable[[str], str]], failures: int = 5) -> DataFrame:
    """Replies to distinct prompts from an injected model, which ``make`` builds once a worker.

    After ``failures`` failed calls in a row a task fails, and Spark tries it anew elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = make(), 0
        for batch in batches:
            out: list[str | None] = []
            for prompt in batch.column(0).to_pylist():
                try:
                    out.append(model(prompt))
                    row = 0
                except Exception:
                    row += 1
                    if row >= failures:
                        raise
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["prompt", "reply"])

    replies = asked.select("prompt").distinct().mapInArrow(run, "prompt string, reply string")
    return asked.join(replies, "prompt")


def unanswered(replies: DataFrame, stage: str) -> DataFrame:
    return replies.where("coalesce(trim(reply), '') = ''").select("source_id", "chunk_id", F.lit(f"{stage}-no-response").alias("stage"))


def bridge_figures(figures: DataFrame, mentions: DataFrame, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Figures with ``depicts`` from the mentions of their captions, and review rows of mentions that link to nothing.

    ``mentions``: source_id, fig_id, seq, text, negated, of an injected recogniser
    over the captions; of those equal in any case the first counts, and negated
    ones depict nothing.  ``links``: query (lower-case text), cui, uri, score.
    """
    named = mentions.withColumn("query", F.lower(F.trim("text"))).where("query <> ''")
    # a name's first mention decides for it, unless that is negated
    first = named.where(~F.coalesce("negated", F.lit(False))).groupBy("source_id", "fig_id", "query").agg(F.min(F.struct("seq", F.trim("text").alias("text"))).alias("m"))
    rows = first.select("source_id", "fig_id", "query", "m.seq", "m.text")
    if links is None:
        rows = rows.select("*", F.lit(None).cast("string").alias("cui"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("double").alias("score"), F.lit(True).alias("ok"))
    else:
        rows = rows.join(links.select("query", "cui", "uri", "score", F.lit(True).alias("ok")), "query", "left")
    held = F.struct("seq", "text", "cui", "uri", "score")
    shown = rows.where("ok").groupBy("source_id", "fig_id").agg(F.array_sort(F.collect_list(held)).alias("d"))
    shown = shown.select("source_id", "fig_id", F.transform("d", lambda x: F.struct(x["text"], x["cui"], x["uri"], x["score"])).alias("_depicts"))
    out = figures.drop("depicts").join(shown, ["source_id", "fig_id"], "left").withColumnRenamed("_depicts", "depicts")
    lost = rows.where("ok IS NULL").select("source_id", "fig_id", F.lit("stage5-link").alias("stage"), "text")
    return out, lost


def recognise(chunks: DataFrame, make: Callable[[], Callable[[str], list[tuple[int, int, str]]]], known: dict[str, str] | None = None) -> DataFrame:
    """Spans from an injected recogniser (start, end, label of a text), overlaps settled for the longest, numbered in document order."""
    from .linking import longest_spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for batch in batches:
            rows = [(s, c, base + a, base + b, text[a:b], label) for s, c, text, base in zip(*(x.to_pylist() for x in batch.columns), strict=True) for a, b, label in find(text)]
            names = ["source_id", "chunk_id", "char_start", "char_end", "text", "ner_label"]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    found = extractable(chunks).select("source_id", "chunk_id", "text", "char_start").mapInArrow(run, "source_id string, chunk_id string, char_start int, char_end int, text string, ner_label string")
    found = found.withColumn("seq", F.row_number().over(Window.partitionBy("source_id").orderBy("char_start", "char_end", "ner_label")).cast("long")).withColumn("span_id", F.concat(F.lit("t"), F.col("seq")))
    kept = longest_spans(found)
    ids = F.format_string("s%03d", F.row_number().over(Window.partitionBy("source_id").orderBy("char_start", "char_end")))
    return kept.withColumn("span_id", ids).withColumn("label", map_label(F.col("ner_label"), known or {}))
