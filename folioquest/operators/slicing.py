"""Documents to segments and topic trees by a chat provider.

Calls run on the executors, one row a piece or a document. With a cache folder, both kinds of answers are kept by the hash of
what was asked, in a table that later runs read first, so an edited text or a changed target is asked anew and a
repeated task isn't. Calls that failed aren't kept.
"""

from __future__ import annotations

import json
import tempfile
from array import array
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioquest.functions import fixed, storage, text
from folioquest.functions.providers import ChatProvider, Request, attempt, parse_json
from folioquest.operators import ordering, similarity, splitting

MOST_SEGMENTS, LEAST_CHARS = 6, 200
#: How many characters of a segment a model sees when it finds topics.
SHOWN = 500
#: About how many characters are sent back at once, and how many bytes of a document's contents are held in memory; more lie in a file of the task.
SENT, HELD = 4 << 20, 16 << 20
SEGMENTS = "doc_id long, source string, piece_no int, pos int, title string, content string"
SLICE_SYSTEM = "You divide a text into parts that each treat one subject. Copy the text of each part unchanged. Answer in JSON."
TOPIC_SYSTEM = "You arrange the parts of a document under topics and subtopics. A part may stand under several. Answer in JSON."
ASSIGN_SYSTEM = "You name, for each part, the topic it belongs to. Answer in JSON."


def accepted_segments(answer: str | None, piece: str) -> list[tuple[int, str, str]]:
    """(position, title, content) of the first six items that have 200 characters. No answer: the piece itself; one that can't be read: nothing."""
    if answer is None:
        return [(0, "", piece)]
    value = parse_json(answer)
    items = value.get("segments", []) if isinstance(value, dict) else []
    out = []
    for k, item in enumerate(items[:MOST_SEGMENTS] if isinstance(items, list) else []):
        content = str(item.get("content") or "").strip() if isinstance(item, dict) else ""
        if len(content) >= LEAST_CHARS:
            out.append((k, str(item.get("title") or "").strip(), content))
    return out


def _cut(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that only a few of its rows are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _sent(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose content is UTF-8 or null, in batches of about ``SENT`` bytes; a large content isn't copied."""

    def batch() -> pa.RecordBatch:
        sizes = [0, *accumulate(len(c or b"") for c in contents)]
        data = contents[0] or b"" if len(contents) == 1 else b"".join(c or b"" for c in contents)
        known = pa.array([c is not None for c in contents]).buffers()[1]
        column = pa.StringArray.from_buffers(len(contents), pa.py_buffer(array("i", sizes)), pa.py_buffer(data), known)
        rest = pa.RecordBatch.from_pylist(held, schema=schema)
        return rest.set_column(schema.get_field_index("content"), schema.field("content"), column)

    held, contents, size = [], [], 0
    for r in rows:
        contents.append(r["content"])
        held.append(r | {"content": None})
        size += len(contents[-1] or b"") + 1000
        del r
        if size >= SENT:
            yield batch()
            held, contents, size = [], [], 0
    if held:
        yield batch()


def slice_documents(docs: DataFrame, provider: ChatProvider, retries: int = 3, size: int = 12_000, overlap: int = 500, cache: str | None = None) -> DataFrame:
    """doc_id, source, seg_no, seg_id, title, content, content_type. Segments are numbered before near-duplicates go, so numbers have gaps; a document without any is one segment."""

    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("piece_no", pa.int32()), ("pos", pa.int32()), ("title", pa.string()), ("content", pa.string()), ("failed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for r in (r for batch in batches for part in _cut(batch) for r in part.to_pylist()):
                answer = attempt(provider, Request("slice", SLICE_SYSTEM, r["piece"], {"text": r["piece"]}, 0.1, 4096), retries)
                for k, t, c in accepted_segments(answer, r["piece"]):
                    yield {"doc_id": r["doc_id"], "source": r["source"], "piece_no": r["piece_no"], "pos": k, "title": t, "content": c.encode(), "failed": answer is None}

        return _sent(rows(), schema)

    texts = docs.select("doc_id", "source", "content")
    model = F.lit(f"slice {size} {overlap} {getattr(provider, 'model', type(provider).__name__)}")
    asked = texts.select("doc_id", F.sha2(F.concat_ws("\x1f", model, "source", "content"), 256).alias("ask"))
    ask = lambda ids: splitting.slices(texts if ids is None else texts.join(ids, "doc_id", "left_semi"), size, overlap).select("doc_id", "source", "piece_no", "piece").mapInArrow(run, SEGMENTS + ", failed boolean")
    found = storage.remembered(asked, cache, ask).select("doc_id", "source", "piece_no", "pos", "title", "content")

    def kept(own: pa.Table) -> pa.Table:
        n = sum(title is not None for title in own.column("title").to_pylist())
        if not n:
            return own.append_column("seg_no", pa.array([0] * len(own), pa.int32()))
        # documents have no piece and come first
        own = own.slice(len(own) - n).append_column("seg_no", pa.array(range(n), pa.int32()))
        return own.filter(similarity.new_segments(own, "content"))

    # documents come along, as what is left if they have no segment, so nothing is cut or folded twice
    every = found.unionByName(texts.select("doc_id", "source", F.lit(None).cast("int").alias("piece_no"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("title"), "content"))
    both = ordering.folded(every, "doc_id", ["piece_no", "pos"], kept, SEGMENTS + ", seg_no int").withColumn("title", F.coalesce("title", text.stem("source")))
    return both.select("doc_id", "source", "seg_no", F.format_string("seg_%03d", "seg_no").alias("seg_id"), F.when(F.col("title") == "", F.concat(F.lit("Segment "), (F.col("seg_no") + 1).cast("string"))).otherwise(F.col("title")).alias("title"), "content", F.lit("body").alias("content_type"))


def contents_of(listed: DataFrame, segments: DataFrame) -> DataFrame:
    """topic, n_segments, content: the contents of the segments (seg_id, content) that a topic lists (topic, pos, seg_id), in its order; unknown ids are left out."""
    found = listed.join(segments.select("seg_id", "content"), "seg_id").groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("c"), F.count("*").alias("n_segments"))
    return found.select("topic", "n_segments", F.array_join(F.col("c.content"), "\n\n").alias("content"))


def left_over(listed: DataFrame, segments: DataFrame) -> DataFrame:
    """The segments that no topic lists."""
    return segments.join(listed.select("seg_id"), "seg_id", "left_anti")


def listing(segments: list[dict]) -> str:
    """The parts as a model sees them: id, title and the first ``SHOWN`` characters."""
    return "\n\n".join(f"[{s['id']}] {s['title']}\n{s['content'][:SHOWN]}{'...' if len(s['content']) > SHOWN else ''}" for s in segments)


Tree = dict  # name, content, children


def _leaf(name: str, parts: list[dict]) -> Tree:
    return {"name": name, "content": None, "parts": parts, "children": []}


def _has_content(node: Tree) -> bool:
    return len(node["parts"]) > 1 or any(s["content"] for s in node["parts"])


def _joined(parts: list[str]) -> str | None:
    return "\n\n".join(parts) or None


def _filled(node: Tree) -> Tree:
    """Sets the contents of a node and of all below it."""
    node["content"] = _joined([s["content"] for s in node["parts"]])
    for child in node["children"]:
        _filled(child)
    return node


def flat_tree(source_stem: str, segments: list[dict]) -> Tree:
    """The document with a leaf for each segment."""
    return _leaf(source_stem, []) | {"children": [_leaf(s["title"], [s]) for s in segments]}


def _branch(topic: dict, by_id: dict[str, dict], used: set[str]) -> Tree | None:
    ids = [i for i in topic.get("segment_ids") or [] if i in by_id]
    used.update(ids)
    below = [b for t in topic.get("subtopics") or [] if isinstance(t, dict) and (b := _branch(t, by_id, used))]
    own = _leaf(str(topic.get("topic") or "Untitled Topic"), [by_id[i] for i in ids])
    if not below:
        return own if _has_content(own) else None
    overview = [_leaf("Overview", own["parts"])] if _has_content(own) else []
    return own | {"parts": [], "children": overview + below}


def _targets(tops: list[Tree]) -> dict[str, Tree]:
    """Where leftovers may go, by name: nodes without children on the first two levels, all on the third; the last of a name counts."""
    out: dict[str, Tree] = {}
    for top in tops:
        for mid in [top, *top["children"]]:
            if not mid["children"]:
                out[mid["name"]] = mid
            if mid is not top:
                out |= {low["name"]: low for low in mid["children"]}
    return out


def topic_tree(answer, source_stem: str, segments: list[dict], assign=None) -> tuple[Tree, bool]:
    """A document's tree with its contents, and whether the model's topics were used."""
    root, used = topic_parts(answer, source_stem, segments, assign)
    return _filled(root), used


def topic_parts(answer, source_stem: str, segments: list[dict], assign=None) -> tuple[Tree, bool]:
    """A document's tree with the segments of each node as its ``parts``, and whether the model's topics were used. Of a segment's content counts only whether it has any.

    Unknown ids are left out; a segment may stand under several topics. A topic with content and subtopics gets its
    content as a first child "Overview"; one with neither goes. ``assign(leftovers, names)`` may name topics for
    segments that have none; those still left are put together under "Other Content".
    """
    value = parse_json(answer) if isinstance(answer, str) else answer
    topics = value.get("topics") if isinstance(value, dict) else None
    if not isinstance(topics, list) or not topics:
        return flat_tree(source_stem, segments), False
    by_id, used = {s["id"]: s for s in segments}, set()
    tops = [b for t in topics if isinstance(t, dict) and (b := _branch(t, by_id, used))]
    left = {s["id"]: s for s in segments if s["id"] not in used}
    if left and assign is not None:
        targets, open_ = _targets(tops), dict(left)
        for item in assign(list(left.values()), list(targets)) or []:
            target, s = targets.get(item.get("subtopic") or item.get("topic")), open_.get(item.get("segment_id"))
            if target is not None and s is not None:
                if s["content"]:
                    target["parts"].append(s)
                left.pop(s["id"], None)
    if left:
        tops.append(_leaf(fixed.OTHER_CONTENT, list(left.values())))
    if not tops:
        return flat_tree(source_stem, segments), False
    return _leaf(str(value.get("document_title") or "Untitled Document"), []) | {"children": tops}, True


def numbered(root: Tree) -> list[dict]:
    """The tree as rows, parents before their children: idx, parent_idx, ancestors, name, content, parts, depth, level, is_leaf."""
    out: list[dict] = []

    def visit(node: Tree, above: list[dict]) -> None:
        idx = len(out)
        out.append({"idx": idx, "parent_idx": above[-1]["idx"] if above else None, "ancestors": above, "name": node["name"], "content": node["content"], "parts": node["parts"], "depth": max(1, len(above)), "level": len(above) + 1, "is_leaf": not node["children"]})
        for child in node["children"]:
            visit(child, [*above, {"idx": idx, "name": node["name"]}])

    visit(root, [])
    return out


TOPIC_NODES = "doc_id long, source string, idx int, parent_idx int, ancestors array<struct<idx:int,name:string>>, name string, content string, depth int, level int, is_leaf boolean, used_topics boolean"
_STEP = pa.struct([("idx", pa.int32()), ("name", pa.string())])
_NODES_ARROW = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("idx", pa.int32()), ("parent_idx", pa.int32()), ("ancestors", pa.list_(_STEP)), ("name", pa.string()), ("content", pa.string()), ("depth", pa.int32()), ("level", pa.int32()), ("is_leaf", pa.bool_()), ("used_topics", pa.bool_()), ("failed", pa.bool_())])


def topic_nodes(segments: DataFrame, provider: ChatProvider, retries: int = 3, share: int | None = None, cache: str | None = None) -> DataFrame:
    """The topic tree of every document as rows in the form of ``tree``; calls are made where a document's segments are gathered. A provider gets the segments' first characters, as many as the prompt has and one more; the contents wait in a file of the task until their nodes are sent. ``share``: questions a document is to get; half again as many leaves are asked for, three a segment at most, or one a segment without it."""

    def of_document(rows: Iterator[dict], file) -> Iterator[dict]:
        own, source, at = [], None, 0
        for r in rows:
            data = (r["content"] or "").encode()
            file.write(data)
            # one character more than is shown tells that there are more
            own.append({"id": r["seg_id"], "title": r["title"], "content": (r["content"] or "")[: SHOWN + 1], "at": at, "size": len(data)})
            at += len(data)
            doc_id, source = r["doc_id"], source if len(own) > 1 else r["source"]
        n = len(own) if share is None else min(max(share, int(1.5 * share)), 3 * len(own))
        facts = lambda some: [{k: s[k] for k in ("id", "title", "content")} for s in some]
        request = Request("topics", TOPIC_SYSTEM, f"About {n} leaves.\n\n{listing(own)}", {"source": source, "segments": facts(own), "target": n}, 0.2, 4096)

        def assign(left, names):
            short = [{**s, "content": s["content"][:300]} for s in left]
            value = parse_json(attempt(provider, Request("assign", ASSIGN_SYSTEM, json.dumps({"topics": names}) + "\n" + listing(short), {"topics": names, "segments": facts(left)}, 0.1, 2000), 1))
            return [x for x in value.get("assignments", []) if isinstance(x, dict)] if isinstance(value, dict) else []

        def content(parts: list[dict]) -> bytearray:
            out = bytearray()
            for k, part in enumerate(parts):
                file.seek(part["at"])
                out += b"\n\n" * (k > 0)
                out += file.read(part["size"])
            return out

        stem = source.rsplit(".", 1)[0] if "." in source[1:] else source
        answer = attempt(provider, request, retries)
        root, used = topic_parts(answer, stem, own, assign)
        for x in numbered(root):
            found = content(x.pop("parts"))
            yield x | {"doc_id": doc_id, "source": source, "content": found or None, "used_topics": used, "failed": answer is None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[dict]:
            each = (r for batch in batches for part in _cut(batch) for r in part.to_pylist())
            for _, rows in groupby(each, key=lambda r: r["doc_id"]):
                with tempfile.SpooledTemporaryFile(HELD) as file:
                    yield from of_document(rows, file)

        return _sent(nodes(), _NODES_ARROW)

    rows = segments.select("doc_id", "source", "seg_no", "seg_id", "title", "content")
    model = F.lit(f"topics {share} {getattr(provider, 'model', type(provider).__name__)}")
    parts = F.array_sort(F.collect_list(F.struct("seg_no", "seg_id", "title", "content")))
    asked = rows.groupBy("doc_id", "source").agg(parts.alias("s")).select("doc_id", F.sha2(F.concat_ws("\x1f", model, "source", F.to_json("s")), 256).alias("ask"))
    ask = lambda ids: (rows if ids is None else rows.join(ids, "doc_id", "left_semi")).repartition("doc_id").sortWithinPartitions("doc_id", "seg_no").mapInArrow(run, TOPIC_NODES + ", failed boolean")
    return storage.remembered(asked, cache, ask)
