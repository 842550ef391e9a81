"""Tagged documents to segments, chunks and figure or table records."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..model import CHUNK_CHARS

# The tags of the format, and the kind of text that each holds.
TAGS = "meta title topic src obj goal sec head con fig cap desc key pt def term clin tbl note sum ref cit".split()
KINDS = {"con": "prose", "def": "definition", "key": "keypoint", "clin": "clinical", "sum": "summary", "desc": "figure_content", "obj": "objective", "ref": "reference"}
PASSAGES = ("objective", "reference")
#: Kinds that become chunks; of these, consecutive segments of one element merge.
CHUNKS = ("prose", "definition", "keypoint", "clinical", "summary", "table", "figure_content", "duplicate")
#: Kinds whose math is flattened; in other texts sentences with formulas go.
NAMES = ("heading", "caption", "table_caption", "objective", "reference")
_FAILED = re.compile("could not be generated", re.IGNORECASE)
_FIGURE = re.compile(r"\[\s*FIGURE\s*:\s*([^\]\n]+?)\s*\]", re.IGNORECASE)
_MARK = re.compile(rf"<(/?)({'|'.join(TAGS)})((?:\s+\w+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+))*)\s*/?>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"(\w+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SEGMENT = "seq long, kind string, level int, text string, section_path array<string>, section_id string, element string, ref string, label string, src string, panel string"


class Node:
    """An element of the tag tree; ``parts`` are texts and nodes in order."""

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.parts: list[str | Node] = []

    def text(self) -> str:
        return "".join(p if isinstance(p, str) else p.text() for p in self.parts)

    def children(self, *tags: str) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node) and (not tags or p.tag in tags)]


def parse_tags(source: str) -> Node:
    """A tree of the known tags; unknown ones stay text, a closing tag closes what is open inside it, a stray one is nothing."""
    root = Node("", {})
    stack, at = [root], 0
    for m in _MARK.finditer(source):
        stack[-1].parts.append(source[at : m.start()])
        at = m.end()
        tag = m[2].lower()
        if not m[1]:
            node = Node(tag, {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(m[3])})
            stack[-1].parts.append(node)
            stack.append(node)
        elif any(n.tag == tag for n in stack):
            while stack.pop().tag != tag:
                pass
    stack[-1].parts.append(source[at:])
    return root


def _slug(text: str) -> str:
    return re.sub("[^a-z0-9]+", "-", text.lower()).strip("-")[:48].rstrip("-")


def _clean(text: str) -> str:
    lines = (re.sub(r"[ \t]+", " ", re.sub(r"^(?:#{1,6}|[-*+•]|\d+[.)])\s+", "", line.strip())).strip() for line in text.split("\n"))
    return "\n".join(filter(None, lines))


def segments_of(source: str) -> tuple[dict[str, str], list[dict[str, Any]]]:
    """What a document says of itself, and its segments in order.

    A section hangs below the nearest earlier one of a lower level; its id is
    kept only where it and the heading's slug begin alike, else it is the slug.
    Headings and figure marks are segments too, as they take room in the text;
    a ``notice`` says that a section or figure cannot be used and takes none.
    """
    root = parse_tags(source)
    meta: dict[str, str] = {}
    out: list[dict[str, Any]] = []

    def find(node: Node, *tags: str) -> Iterator[Node]:
        for child in node.children():
            if child.tag in tags:
                yield child
            yield from find(child, *tags)

    for node in find(root, "title", "src"):
        if node.tag == "title":
            meta.setdefault("title", node.text().strip())
        else:
            for pair in node.text().split("|"):
                key, colon, value = pair.partition(":")
                if colon:
                    meta[key.strip().lower()] = value.strip()
    title = meta.get("title", "")

    def add(kind: str, text: str, path: list[str], section: str, level: int = 0, **more: str) -> None:
        text = text if kind == "figure_marker" else _clean(text)
        if kind in CHUNKS and _FAILED.search(text):
            kind = "notice"
        if text:
            blank = dict.fromkeys(("element", "ref", "label", "src", "panel"), "")
            out.append({"seq": len(out), "kind": kind, "level": level, "text": text, "section_path": path, "section_id": section, **blank} | more)

    add("heading", title, [], "", 1)

    open_: list[tuple[int, str]] = []

    def walk(node: Node, path: list[str], section: str) -> None:
        for child in node.children():
            tag = child.tag
            if tag == "sec":
                head = next((h.text().strip() for h in child.children("head")), "")
                level = int(child.attributes.get("level", "1")) if child.attributes.get("level", "1").isdigit() else 1
                while open_ and open_[-1][0] >= level:
                    open_.pop()
                own, slug = child.attributes.get("id", ""), _slug(head)
                section_id = own if own and slug and (slug.startswith(own) or own.startswith(slug)) else slug or own
                below = [t for t in ([title] if title else []) + [h for _, h in open_] + [head] if t]
                open_.append((level, head))
                add("heading", head, below, section_id, level)
                walk(child, below, section_id)
            elif tag in ("fig", "tbl"):
                mark = _FIGURE.search(child.text()) if tag == "fig" else None
                name = child.attributes.get("id", "").strip() or (mark[1] if mark else "")
                more = {"element": tag, "ref": name} | {k: child.attributes.get(k, "").strip() for k in ("label", "src", "panel")}
                if tag == "fig" and not name:
                    add("notice", "figure block with no id", path, section)
                    continue
                if tag == "fig":
                    add("figure_marker", mark[0] if mark else f"[FIGURE:{name}]", path, section, **more)
                for part in child.children("cap"):
                    add("caption" if tag == "fig" else "table_caption", part.text(), path, section, **more)
                body = child.children("desc" if tag == "fig" else "con")
                add("figure_content" if tag == "fig" else "table", "\n".join(part.text() for part in body), path, section, **more)
            elif tag in KINDS:
                items = child.children("pt", "goal", "cit", "term")
                add(KINDS[tag], "\n".join(i.text().strip() for i in items) if items else child.text(), path, section)
            elif tag == "note":
                if child.attributes.get("status") == "failed" or _FAILED.search(child.text()):
                    add("notice", child.text(), path, section)
            elif tag not in ("meta", "head"):
                walk(child, path, section)

    walk(root, [title] if title else [], "")
    return meta, out


def parse_documents(files: DataFrame) -> DataFrame:
    """Segments of files (``path``, ``text``): source_id, title, origin, generator and one row a segment.

    The scanner keeps a stack of open tags, which no column expression can, so
    it runs as an Arrow function; references are turned into anchors before it.
    """
    source = files.select("path", T.normalise_inline(F.coalesce("text", F.lit(""))).alias("text"))
    meta_type = pa.map_(pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                meta, found = segments_of(text)
                rows += [{"path": path, "meta": list(meta.items()), **s} for s in found]
            kinds = {"seq": pa.int64(), "level": pa.int32(), "section_path": pa.list_(pa.string()), "meta": meta_type}
            names = ["path", "meta", *(x.split()[0] for x in _SEGMENT.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

    rows = source.mapInArrow(run, f"path string, meta map<string,string>, {_SEGMENT}")
    stem = F.regexp_replace(F.element_at(F.split(F.coalesce(F.try_element_at("meta", F.lit("source")), "path"), "/"), -1), r"\.[^.]*$", "")
    at = lambda k: F.coalesce(F.try_element_at("meta", F.lit(k)), F.lit(""))
    return rows.select(stem.alias("source_id"), at("title").alias("title"), at("source").alias("origin"), at("model").alias("generator"), at("generated").alias("generated_at"), "seq", "kind", "level", "text", "section_path", "section_id", "element", "ref", "label", "src", "panel")


def merge_segments(segments: DataFrame, most: int = CHUNK_CHARS, same: tuple[str, ...] = ("kind", "section_id"), mergeable: tuple[str, ...] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive segments of one kind and section merged up to ``most`` characters, with offsets in the joined text.

    Segments and the merged chunks are two characters (an empty line) apart.
    The size cap starts anew with each chunk, so runs are folded in order: a
    run of one kind in one section, never a whole document.  With ``mergeable``
    other kinds stay single; arrays in ``carry`` are united, sorted.
    """
    order = Window.partitionBy("source_id").orderBy("seq")
    new = F.lit(False) if mergeable is None else ~F.col("kind").isin(*mergeable)
    for c in same:
        new = new | ~F.col(c).eqNullSafe(F.lag(c).over(order)) if c else new
    rows = segments.withColumn("_run", F.sum(F.when(new, 1).otherwise(0)).over(order))
    one = F.struct("seq", "text", *carry)
    runs = rows.groupBy("source_id", "_run").agg(F.array_sort(F.collect_list(one)).alias("parts"), *(F.first(c).alias(c) for c in same))
    part = dict(runs.dtypes)["parts"]
    start = F.struct(F.slice("parts", 1, 0).alias("now"), F.lit(0).alias("size"), F.array().cast(f"array<{part}>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        n = F.length(x["text"])
        fits = (F.size(acc["now"]) == 0) | (acc["size"] + 2 + n <= most)
        size = F.when(F.size(acc["now"]) == 0, n).when(fits, acc["size"] + 2 + n).otherwise(n)
        now = F.when(fits, F.array_append(acc["now"], x)).otherwise(F.array(x))
        done = F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["now"]))
        return F.struct(now.alias("now"), size.alias("size"), done.alias("done"))

    folded = F.aggregate("parts", start, step, lambda acc: F.array_append(acc["done"], acc["now"]))
    chunks = runs.select("source_id", *same, F.explode(folded).alias("c"))
    chunks = chunks.select("source_id", *same, F.col("c")[0]["seq"].alias("seq"), F.array_join(F.transform("c", lambda x: x["text"]), "\n\n").alias("text"), F.size("c").alias("n_segments"), *(F.array_sort(F.array_distinct(F.flatten(F.col("c").getField(k)))).alias(k) for k in carry))
    begin = F.coalesce(F.sum(F.length("text") + 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = chunks.withColumn("char_start", begin).withColumn("char_end", begin + F.length("text"))
    return chunks.withColumn("chunk_id", F.format_string("c%03d", F.row_number().over(order)))


def assemble(segments: DataFrame, most: int = CHUNK_CHARS) -> dict[str, DataFrame]:
    """Segments laid out as one text a document: ``pieces`` (all that is written, with offsets), ``chunks``, ``passages`` and ``review``.

    Headings, figure marks and captions take room in the text without being chunks.
    """
    text = F.when(F.col("kind").isin(*NAMES), T.flatten_math(F.col("text"))).when(F.col("kind").isin(*CHUNKS), T.drop_formula_sentences(F.col("text"))).otherwise(F.col("text"))
    rows = lift(segments.withColumn("text", text))
    rows = rows.withColumn("text", F.when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("#"), F.greatest("level", F.lit(1))), F.lit(" "), F.col("text"))).otherwise(F.col("text")))
    written = rows.where((F.col("kind") != "notice") & (F.trim("text") != ""))
    kept = ("kind", "section_id", "section_path", "element", "ref", "label", "src", "panel")
    pieces = merge_segments(written, most, kept, CHUNKS, ("figure_refs", "table_refs")).drop("chunk_id")
    nth = lambda kinds: F.sum(F.when(F.col("kind").isin(*kinds), 1).otherwise(0)).over(Window.partitionBy("source_id").orderBy("seq"))
    pieces = pieces.withColumns({
        "chunk_id": F.when(F.col("kind").isin(*CHUNKS), F.format_string("c%03d", nth(CHUNKS))), "passage_id": F.when(F.col("kind").isin(*PASSAGES), F.format_string("p%03d", nth(PASSAGES))),
    })
    chunks = mark_duplicates(pieces.where("chunk_id IS NOT NULL").drop("passage_id"))
    again = chunks.where("duplicate_of IS NOT NULL").select("source_id", "seq", F.lit("stage1-duplicate").alias("stage"), "duplicate_of", F.substring("text", 1, 120).alias("text"))
    notices = rows.where("kind = 'notice'").select("source_id", "seq", F.when(F.col("text") == "figure block with no id", "stage1-figure").otherwise("stage1-tagged").alias("stage"), F.lit(None).cast("string").alias("duplicate_of"), F.substring("text", 1, 300).alias("text"))
    return {"pieces": pieces, "chunks": chunks, "passages": pieces.where("passage_id IS NOT NULL").drop("chunk_id"), "review": again.unionByName(notices)}


def bind_media(assembled: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``figures`` and ``tables`` with caption places, content chunk and the first chunk that cites each; and ``review`` of what is missing."""
    pieces, chunks = assembled["pieces"], assembled["chunks"]
    key, seq = ["source_id", "ref"], "seq"

    def bound(element: str, caption: str, refs: str) -> DataFrame:
        own = pieces.where((F.col("element") == element) & (F.col("ref") != ""))
        is_caption = F.col("kind") == caption
        rows = own.groupBy(*key).agg(
            *(F.min_by(c, seq).alias(c) for c in ("section_id", "label", "src", "panel")), F.min_by(F.when(is_caption, F.col("text")), F.when(is_caption, F.col(seq))).alias("caption"),
            F.min_by(F.array("char_start", "char_end"), F.when(is_caption, F.col(seq))).alias("caption_span"), F.min_by("chunk_id", F.when(F.col("chunk_id").isNotNull(), F.col(seq))).alias("content_chunk"), F.min(seq).alias(seq),
        )
        return rows.join(first_references(chunks, refs), key, "left")

    figures, tables = bound("fig", "caption", "figure_refs"), bound("tbl", "table_caption", "table_refs").drop("src", "panel")
    lacks = lambda rows, stage, reason, test: rows.where(test).select("source_id", "ref", F.lit(stage).alias("stage"), F.lit(reason).alias("reason"))
    review = lacks(figures, "stage1-figure", "figure never anchored in prose", F.col("referenced_from").isNull()).unionByName(lacks(figures, "stage1-figure", "figure has no src image", F.col("src") == ""))
    review = review.unionByName(lacks(tables, "stage1-table", "table has no restated content", F.col("content_chunk").isNull())).unionByName(lacks(tables, "stage1-table", "table never cited in prose", F.col("referenced_from").isNull()))
    return {"figures": figures, "tables": tables, "review": review}


def mark_duplicates(chunks: DataFrame) -> DataFrame:
    """Later copies of a chunk's text in its document become kind ``duplicate`` with ``duplicate_of``."""
    key = T.duplicate_key(F.col("text"))
    first = chunks.groupBy("source_id", key.alias("_key")).agg(F.min_by("chunk_id", "seq").alias("_first"))
    rows = chunks.withColumn("_key", key).join(first, ["source_id", "_key"])
    again = F.col("chunk_id") != F.col("_first")
    return rows.withColumns({"kind": F.when(again, "duplicate").otherwise(F.col("kind")), "duplicate_of": F.when(again, F.col("_first"))}).drop("_key", "_first")


def lift(chunks: DataFrame) -> DataFrame:
    """Chunks with anchors taken out of the text into sorted reference lists (before offsets are given)."""
    return chunks.withColumns({"figure_refs": T.anchors(F.col("text"), "FIG"), "table_refs": T.anchors(F.col("text"), "TBL"), "text": T.lift_anchors(F.col("text"))})


def first_references(chunks: DataFrame, column: str) -> DataFrame:
    """For each figure or table the first chunk that refers to it."""
    return chunks.select("source_id", "chunk_id", "seq", F.explode(column).alias("ref")).groupBy("source_id", "ref").agg(F.min_by("chunk_id", "seq").alias("referenced_from"))


def normalised_text(chunks: DataFrame) -> DataFrame:
    """Each document's text as its chunks and empty lines make it up."""
    parts = F.array_sort(F.collect_list(F.struct("char_start", "text")))
    return chunks.groupBy("source_id").agg(F.concat(F.array_join(F.transform(parts, lambda x: x["text"]), "\n\n"), F.lit("\n\n")).alias("normalized_text"))


def misplaced(chunks: DataFrame, texts: DataFrame) -> DataFrame:
    """Chunks whose offsets do not give their text; there must be none."""
    cut = F.substring("normalized_text", F.col("char_start").cast("int") + 1, (F.col("char_end") - F.col("char_start")).cast("int"))
    return chunks.join(texts, "source_id").where(cut != F.col("text")).select("source_id", "chunk_id")
