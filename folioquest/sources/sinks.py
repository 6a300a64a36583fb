"""Datasets, reports and trees to files."""

from __future__ import annotations

import html
import json
import os
import shutil
from collections import Counter
from collections.abc import Iterable
from itertools import count, groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioquest.functions import fixed, text

ENTRY = "question string, answer string, contexts array<string>, ground_truth string, source string, metadata struct<type:string,difficulty:string,topic_path:array<string>,source:string>"


def save_dataset(entries: Iterable[dict], path: str) -> int:
    """One JSON array, indented, non-ASCII characters as they are. Written beside and moved into place."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    n = 0
    with open(tmp := f"{path}.tmp", "w", encoding="utf-8") as f:
        f.write("[")
        for e in entries:
            f.write(("," if n else "") + "\n" + "\n".join("  " + line for line in json.dumps(e, ensure_ascii=False, indent=2).split("\n")))
            n += 1
        f.write("\n]\n" if n else "]\n")
    os.replace(tmp, path)
    return n


def rows_as_dicts(entries: DataFrame) -> Iterable[dict]:
    return (r.asDict(recursive=True) for r in entries.toLocalIterator())


def write_lines(entries: DataFrame, path: str) -> None:
    """JSON Lines from all executors, for datasets of any size."""
    entries.write.mode("overwrite").json(path)


def counts(entries: DataFrame, column: str, order: str) -> DataFrame:
    """value, n: most frequent first, ties by the first row that has the value."""
    return entries.groupBy(F.coalesce(column, F.lit("-")).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("first_row")).orderBy(F.desc("n"), "first_row").select("value", "n")


def stats(entries: DataFrame, order: str) -> DataFrame:
    """field, value, n for the source's stem, the kind and the difficulty, in one pass over the entries."""
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), F.coalesce(c, F.lit("-")).alias("value")) for name, c in (("source", text.stem("source")), ("type", F.col("metadata.type")), ("difficulty", F.col("metadata.difficulty")))])
    return entries.select(F.col(order).alias("at"), F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n"), F.min("at").alias("first_row"))


def _stem(name: str) -> str:
    return os.path.splitext(name)[0]


def escape(s: str) -> str:
    return html.escape(s, quote=False)


def html_report(entries: list[dict]) -> str:
    tables = []
    for title, value in (("Source", lambda e: _stem(e.get("source") or "") or "-"), ("Type", lambda e: (e.get("metadata") or {}).get("type") or "-"), ("Difficulty", lambda e: (e.get("metadata") or {}).get("difficulty") or "-")):
        rows = "".join(f"<tr><td>{escape(v)}</td><td>{n}</td></tr>" for v, n in Counter(map(value, entries)).most_common())
        tables.append(f"<table><tr><th>{title}</th><th>Pairs</th></tr>{rows}</table>")
    cards = []
    for k, e in enumerate(entries, 1):
        meta = e.get("metadata") or {}
        where = " > ".join((meta.get("topic_path") or [])[-3:])
        contexts = "".join(f"<details><summary>Context</summary><pre>{escape(c)}</pre></details>" for c in e.get("contexts") or [])
        cards.append(f"<section><h2>{k}. {escape(e['question'])}</h2><p class='meta'>{escape(meta.get('type') or '-')} &middot; {escape(meta.get('difficulty') or '-')} &middot; {escape(where)}</p><p>{escape(e['ground_truth'])}</p>{contexts}</section>")
    style = "body{font:16px sans-serif;max-width:60em;margin:2em auto}table{border-collapse:collapse;margin:1em 0}td,th{border:1px solid #ccc;padding:.3em .8em}section{border-top:1px solid #ccc}.meta{color:#666}pre{white-space:pre-wrap}"
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>Questions and answers</title><style>{style}</style></head><body><h1>{len(entries)} questions and answers</h1>{''.join(tables)}{''.join(cards)}</body></html>\n"


def save_html(entries: list[dict], path: str) -> str:
    """Writes the report; the suffix becomes .html."""
    path = f"{_stem(path)}.html"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(html_report(entries))
    return path


NODE_FIELDS = ("doc_id", "source", "idx", "parent_idx", "ancestors", "name", "content", "depth", "level", "is_leaf")
NODES = "doc_id long, source string, idx int, parent_idx int, ancestors array<struct<idx:int,name:string>>, name string, content string, depth int, level int, is_leaf boolean"


def _nested(rows: list[dict]) -> list[dict]:
    """A document's nodes as trees; a node whose parent isn't there stands at the top."""
    made = {r["idx"]: {"name": r["name"], "source": r["source"], "depth": r["depth"], "content": r["content"], "chunks": [], "children": []} for r in rows}
    tops = []
    for r in rows:
        (made[r["parent_idx"]]["children"] if r["parent_idx"] in made else tops).append(made[r["idx"]])
    return tops


def save_tree(nodes: DataFrame, path: str) -> None:
    """Nodes as a table that all executors write, or with a path that ends in .json as one nested file: the root, a node for each file, and its sections; written document by document and moved into place when whole. Nothing is written without nodes."""
    if nodes.isEmpty():
        return
    if not path.endswith(".json"):
        nodes.select(*NODE_FIELDS).write.mode("overwrite").parquet(path)
        return
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    tmp = f"{path}.tmp"
    rows = (r.asDict(recursive=True) for r in nodes.select(*NODE_FIELDS).orderBy("doc_id", "idx").toLocalIterator())
    try:
        with open(tmp, "w", encoding="utf-8") as f:
            f.write(json.dumps({"name": fixed.ROOT_NAME, "source": "root", "depth": 0, "content": None, "chunks": []}, ensure_ascii=False)[:-1] + ', "children": [')
            for k, (_, own) in enumerate(groupby(rows, key=lambda r: r["doc_id"])):
                own = list(own)
                file = {"name": own[0]["source"], "source": own[0]["source"], "depth": 0, "content": None, "chunks": [], "children": _nested(own)}
                f.write((",\n" if k else "\n") + json.dumps(file, ensure_ascii=False, indent=2))
            f.write("\n]}\n")
        os.replace(tmp, path)
    finally:
        if os.path.exists(tmp):
            os.remove(tmp)


def _valid(node) -> bool:
    return isinstance(node, dict) and isinstance(node.get("name"), str) and isinstance(node.get("source"), str) and isinstance(node.get("children", []), list) and all(map(_valid, node.get("children", [])))


def load_tree(spark, path: str) -> DataFrame:
    """The nodes of a saved tree. In a nested file the nodes below the root are files; one without children (a document that gave no tree) is its own only section."""
    if not path.endswith(".json"):
        return spark.read.parquet(path).select(*NODE_FIELDS)
    with open(path, encoding="utf-8") as f:
        root = json.load(f)
    if not _valid(root):
        raise ValueError(f"{path} holds no tree")
    rows: list[tuple] = []
    for doc_id, file in enumerate(root.get("children", [])):
        number = count()

        def visit(node: dict, above: list[dict], file=file, doc_id=doc_id, number=number) -> None:
            idx, below = next(number), node.get("children", [])
            rows.append((doc_id, file["source"], idx, above[-1]["idx"] if above else None, above, node["name"], node.get("content"), int(node.get("depth", 0)), len(above) + 1, not below))
            for child in below:
                visit(child, [*above, {"idx": idx, "name": node["name"]}])

        for top in file.get("children", []) or [file]:
            visit(top, [])
    return spark.createDataFrame(rows, NODES)


def tree_exists(spark, path: str) -> bool:
    if path.endswith(".json"):
        return os.path.exists(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def wipe(*paths: str) -> None:
    """Delete caches: files or folders that exist. Only what the settings name is passed here."""
    for p in paths:
        if os.path.isdir(p):
            shutil.rmtree(p)
        elif os.path.exists(p):
            os.remove(p)
