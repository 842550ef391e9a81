"""The pipeline on a small folder against its stages one by one."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from loomgraph.llm import neardup


def test_pipeline(spark, tmp_path):
    r = random.Random(5)
    parts = {"en": "the and ing tion er of".split(), "de": "sch und ein ich ung der".split()}
    text = lambda code, n=80: " ".join("".join(r.choice(parts[code]) for _ in range(3)) for _ in range(n))
    passage = text("en", 45)
    texts = [(text(c), c) for c in ("en", "de") * 40]
    texts += [(texts[0][0], "en"), (texts[2][0] + " extra", "en"), ("123 456", "en"), (f"{text('en')} {passage} {text('en')}", "en"), (f"{text('en')} {passage}", "en")]
    texts += [(text("en") + " password: kT9vQ2xZ77aa", "en"), ("", "en"), (None, "en")]
    rows = [(k, t, c, "s", len(t or "")) for k, (t, c) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = {x["doc_id"]: x["text"] for x in docs.collect()}
    everything = set(range(len(texts)))
    assert set(kept["language_id"]) == everything - {82, 86, 87}
    assert set(kept["near_duplicates"]) == everything - {82, 86, 87, 80, 81}
    assert passage not in kept["long_repeats"][83] and passage not in kept["long_repeats"][84]
    assert all(kept["long_repeats"][k] == texts[k][0] for k in range(80))
    assert "[SECRET]" in kept["secret_scan"][85] and "kT9" not in kept["secret_scan"][85]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {x["doc_id"] for x in out.select("doc_id").collect()} == set(kept["secret_scan"])
    used = Counter()
    for x in out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect():
        used[x["sequence_id"]] += x["n"]
    assert max(used.values()) <= 2048


def test_repeated_rows(spark, tmp_path):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 3 + [(2, "h i j k l m n", "en", "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(x["doc_id"] for x in out) == [1, 2]


def test_pairs_from_80_percent_on(spark, tmp_path):
    r = random.Random(11)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(n)]
    base = words(204)
    # 200 shingles; another end leaves 180 of 220 (0.82) or 176 of 224 (0.786)
    texts = [base, base[:184] + words(20), words(204)]
    texts.append(texts[2][:180] + words(24))
    rows = [(k, " ".join(t), "en", "s", 0) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()) == [0, 2, 3]
    assert neardup.near_duplicates(docs).where("NOT kept").count() == 0


def test_one_key_on_two_texts(spark, tmp_path):
    """Only rows whose own text is a copy go, whatever else stands under their key."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (4, text(4) + " more"), (4, text(5)), (4, text(5))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((x["doc_id"], x["text"]) for x in out) == sorted([(1, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (4, text(5))])


def test_edges(spark, tmp_path):
    """Empty tables, null keys, texts and labels, and columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, n string, component_id string, block string"
    text = lambda k, n=60: " ".join(f"wort{chr(97 + k)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    rows = [(None, text(1)), (5, text(1)), (None, text(2)), (7, None), (8, ""), (9, "\n"), (10, text(3, 3000)), (11, text(4)), (11, text(4))]
    extra = ["x"] * 5
    for name, kept in (("some", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        table = spark.createDataFrame([(k, t, "de" if k != 11 else None, None, None, *extra) for k, t in kept], schema)
        table.coalesce(1).write.parquet(f"{folder}/documents.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
        got = [x["doc_id"] for x in out.where("piece = 0").collect()]
        assert sorted(map(str, got)) == (["10", "11", "5", "None"] if kept else [])


def test_settings_and_tables(spark, tmp_path):
    """A run leaves the session's setting as it was, and of its own tables only the last."""
    from loomgraph.llm import store

    before, since = spark.conf.get(corpus_pipeline.BATCH), store.mark()
    rows = [(k, f"some words of text number {k} that stand alone here", "en", "s", 10) for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert spark.conf.get(corpus_pipeline.BATCH) == before and store.mark() == since + 1
    assert out.select("doc_id").distinct().count() == 20


def test_stages_leave_their_results_only(spark, tmp_path):
    """Stages called one by one, as by a caller who writes each result himself, leave one table each, and all of them can still be read."""
    from pathlib import Path

    from loomgraph.llm import store

    folder = Path(store.shared_folder(spark).removeprefix("file:"))
    tables = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    texts = [text(k) for k in range(20)] + [text(0) + " more", text(1) + " " + text(2)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        before, since = tables(), store.mark()
        docs = stage(spark, docs, str(tmp_path))
        results.append(docs)
        left = tables() - before
        assert store.mark() == since + 1 and len(left) == 1 and left.pop().startswith(name)
    assert [x.select("doc_id").distinct().count() for x in results] == [22, 21, 18, 18, 18]  # the 22nd text is the second and third: all three lose all words


def test_long_repeats_stores_texts_once(spark, tmp_path, monkeypatch):
    """Blocks hold the columns of documents and nothing twice; texts that lose no word keep their blanks, null stays null."""
    from loomgraph.llm import recompress

    stored, blocks = [], recompress.blocks
    monkeypatch.setattr(recompress, "blocks", lambda docs, text: stored.append(docs.columns) or blocks(docs, text))
    passage = " ".join(f"p{i}" for i in range(40))
    texts = ["  two\t\twords \n", None, "", " \n ", f"one  {passage}\n end", f"{passage}\tother", passage, "é\x0bü   x"]
    docs = spark.createDataFrame([(k, t, "en", "s", -1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: (x["text"], x["n_chars"]) for x in corpus_pipeline.long_repeats(spark, docs, str(tmp_path)).collect()}
    want = {0: texts[0], 1: None, 2: "", 3: texts[3], 4: "one end", 5: "other", 7: texts[7]}
    assert got == {k: (t, None if t is None else len(t)) for k, t in want.items()}
    assert stored == [list(corpus_pipeline.COLUMNS)]
