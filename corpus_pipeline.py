"""A training-data pipeline over ``documents``: each stage applies one operator to all that the one before kept.

Every stage is written as Parquet and read again, by itself already, so that it runs under a setting of its own; once that is written, the tables
that it made on the way are removed.  All but the last return the columns of ``documents``; a stage that changes a text sets ``n_chars`` anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import language, neardup, packing, recompress, secrets
from loomgraph.llm.queries import WORD_BPE
from loomgraph.llm.store import mark, materialise, release

#: Rows that go to a Python worker at a time; texts are long, and two workers share an executor's memory with its heap.
BATCH, ROWS_AT_A_TIME = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000
#: Least similarity of near duplicates in percent: five words and 0.8 or more.
SIMILAR = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter (null and empty ones too) and those in which no language makes up half.

    Rows are judged one by one, so repeated ones fare alike; an empty table stays empty and other columns go.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = language.fit(docs, "text", "lang", "doc_id", ~held)
    found = language.predict(docs.select(*COLUMNS), model)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that of the smallest doc_id; of rows equal in doc_id and text, one.

    Rows are told apart by a 64-bit hash of doc_id and text, so a doc_id that stands on different texts loses only the copies.
    Null texts and those without words are no copies of anything; a null doc_id comes last in its group; an empty table stays empty.
    """
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_row"))
    found = materialise(neardup.near_duplicates(rows, "_row", threshold=SIMILAR).select("_row", "component_id"), "found")
    counted = found.groupBy("_row", "component_id").count()
    named = counted.join(rows.select("_row", "doc_id").distinct(), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    best = named.groupBy("component_id").agg(first.alias("x")).select(F.col("x._row").alias("_row"), F.lit(True).alias("best"))
    judged = counted.join(best, "_row", "left").where("best IS NULL OR count > 1").select("_row", F.col("best").isNotNull().alias("again"))
    judged = materialise(judged, "judged")
    again = judged.where("again").select("_row")
    # texts that a filter of fixed size clears stay where they are; only the others meet the keys that go
    clear, rest = neardup.split_by_filter(rows, "_row", judged.select("_row"))
    kept = clear.unionByName(rest.join(judged, "_row", "left_anti")).select(*COLUMNS)
    if again.isEmpty():
        return kept
    return kept.unionByName(rest.join(again, "_row", "left_semi").dropDuplicates(["_row", "doc_id", "text"]).select(*COLUMNS))


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words in repeated 35-word windows; a text that loses none stays as it is, one that loses all goes.

    Null and empty texts have no words and stay; repeated rows repeat each other; an empty table stays empty.
    """
    found = recompress.remove_repeats(docs.select(*COLUMNS), verbatim=True)
    return _documents(found.where("n_removed = 0 OR n_removed < n_words"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of each secret; null texts stay null, and no row goes."""
    return _documents(secrets.redact(docs.select(*COLUMNS), vocabulary=WORD_BPE))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences; a null text is its end token alone."""
    return packing.pack_documents(docs, WORD_BPE)


def _bounded(name: str, stage):
    """``stage`` written by batches of ``ROWS_AT_A_TIME`` rows; when it returns, the session has its own setting back and of the stage's tables only that result is left."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before, since = spark.conf.get(BATCH), mark()
        spark.conf.set(BATCH, str(ROWS_AT_A_TIME))
        try:
            out = materialise(stage(spark, docs, sf_dir), name)
        finally:
            spark.conf.set(BATCH, before)
        release(spark, since, keep=1)
        return out

    return run


STAGES = [(name, _bounded(name, stage)) for name, stage in [("language_id", language_id), ("near_duplicates", near_duplicates), ("long_repeats", long_repeats), ("secret_scan", secret_scan), ("packing", packed)]]
#: Language mixtures, guess costs and tokenizers have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's result is removed once the next one's is written."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        release(spark, since, keep=1)
    return docs
