import random

import json

import pytest

from folioquest.operators import ordering, quota, tree
from folioquest.sources import sinks

LONG = "This sentence is here to give the section more than fifty characters."


def docs(spark, *contents):
    return spark.createDataFrame([(k, c, f"doc{k}.md") for k, c in enumerate(contents)], "doc_id long, content string, source string")


def brute(content):
    """Nodes by a stack: (name, parent, content)."""
    lines = content.split("\n")
    heads = [(len(x.strip()) - len(x.strip().lstrip("#")), x.strip().lstrip("#").strip(), i) for i, x in enumerate(lines) if x.strip().startswith("#") and x.strip().lstrip("#")[:1] == " " and x.strip().lstrip("#").strip() and len(x.strip()) - len(x.strip().lstrip("#")) <= 6]
    out, stack = [], []
    for k, (level, name, at) in enumerate(heads):
        end = heads[k + 1][2] if k + 1 < len(heads) else len(lines)
        if k:
            while len(stack) > 1 and stack[-1][1] >= level:
                stack.pop()
        out.append((name, stack[-1][0] if stack else None, "\n".join(lines[at + 1 : end]).strip() or None))
        stack.append((k, level))
    return out


def test_headings_against_a_stack(spark):
    rng = random.Random(2)
    texts = []
    for k in range(150):
        parts = ["lost before the first heading"] if k % 3 else []
        for j in range(rng.randrange(2, 12)):
            parts.append("#" * rng.randint(1, 6) + f" H{j}")
            if rng.random() < 0.6:
                parts.append(f"text {j}\n  more")
        texts.append("\n".join(parts))
    got = {}
    for r in tree.heading_nodes(docs(spark, *texts)).collect():
        got.setdefault(r["doc_id"], []).append((r["idx"], r["name"], r["parent_idx"], r["content"]))
    for k, t in enumerate(texts):
        assert [x[1:] for x in sorted(got[k])] == brute(t)


def test_trees_of_documents_shuffle_nothing(spark):
    """Texts went through windows; ancestors and verdicts are found in each document now."""
    some = docs(spark, f"# T\n## One\n{LONG}\n#tag\n \x1c# Two\n\u2003## Three\r\n{LONG}", f"# U\n{LONG}", "\n\n## \n#Bare\n")
    nodes, leaves = tree.build(some)
    for df in (tree.heading_nodes(some), nodes, leaves, tree.forest(nodes)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
    got = [(r["doc_id"], r["idx"], r["name"], r["parent_idx"], r["content"]) for r in tree.heading_nodes(some).orderBy("doc_id", "idx").collect()]
    assert got == [(0, 0, "T", None, None), (0, 1, "One", 0, f"{LONG}\n#tag"), (0, 2, "Two", 0, None), (0, 3, "Three", 2, LONG), (1, 0, "U", None, LONG), (2, 0, "doc2", None, "## \n#Bare")]


def test_verdicts_in_place_are_those_of_pruning(spark):
    rng = random.Random(5)
    texts = ["\n".join("#" * rng.randint(1, 6) + rng.choice((" A", " References", " B")) + rng.choice(("", f"\n{LONG}", "\nx", "\nISBN 1\nall rights reserved " + LONG)) for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    some = docs(spark, *texts)
    want = tree.survivors(tree.heading_nodes(some))
    assert sorted(map(str, tree.build(some)[0].collect())) == sorted(map(str, want.collect()))


def test_two_levels_give_two_leaves(spark):
    nodes, leaves = tree.build(docs(spark, f"# Guide\nintro\n## One\n{LONG}\n## Two\n{LONG}"))
    assert sorted(r["name"] for r in leaves.collect()) == ["One", "Two"]
    assert {(r["name"], r["depth"], r["level"]) for r in nodes.collect()} == {("Guide", 1, 1), ("One", 1, 2), ("Two", 1, 2)}


def test_no_headings_and_bare_heading(spark):
    got = tree.heading_nodes(docs(spark, f"  {LONG}\n", "# Only a title")).collect()
    assert [(r["name"], r["content"]) for r in got] == [("doc0", LONG)]


def test_skipped_subtree_goes_whole(spark):
    leaves = tree.build(docs(spark, f"# T\n## References\n{LONG}\n### Deep\n{LONG}\n## Kept\n{LONG}"))[1]
    assert [r["name"] for r in leaves.collect()] == ["Kept"]


def test_node_without_its_children_is_judged_as_a_leaf(spark):
    nodes, leaves = tree.build(docs(spark, f"# T\n## Part\n{LONG}\n### Tiny\nx"))
    assert [r["name"] for r in leaves.collect()] == ["Part"] and nodes.count() == 2


def test_pruning_against_recursion(spark):
    rng = random.Random(3)
    texts = ["\n".join(f"{'#' * rng.randint(1, 4)} {rng.choice(['A', 'B', 'References', 'Annex 1'])}\n{LONG if rng.random() < 0.5 else 'x'}" for _ in range(rng.randrange(2, 9))) for _ in range(120)]

    def prune(nodes, k):
        if nodes[k][0] in ("References", "Annex 1"):
            return []
        below = [x for j, n in enumerate(nodes) if n[1] == k for x in prune(nodes, j)]
        return below or ([k] if len(nodes[k][2] or "") >= 50 else [])

    got = {}
    for r in tree.leaves(tree.heading_nodes(docs(spark, *texts))).collect():
        got.setdefault(r["doc_id"], set()).add(r["idx"])
    for k, t in enumerate(texts):
        assert got.get(k, set()) == set(prune(brute(t), 0))


def test_fallback_only_if_nothing_is_left(spark):
    nodes, leaves = tree.build(docs(spark, "# A\n## B\nshort", "# C\n## D\nshort"))
    assert sorted(r["name"] for r in leaves.collect()) == ["doc0", "doc1"] and nodes.count() == 2
    assert tree.build(docs(spark, "# A\n## B\nshort", LONG))[1].count() == 1


def test_front_matter_goes_from_inner_nodes(spark):
    nodes = tree.build(docs(spark, f"# T\nISBN 1\nall rights reserved\n## Leaf\n{LONG}"))[0]
    assert {r["name"]: r["content"] for r in nodes.collect()} == {"T": None, "Leaf": LONG}


def test_paths_totals_and_drawing(spark):
    nodes, leaves = tree.build(docs(spark, f"# T\n## One\n{LONG}\n## Two\n### Deep\n{LONG}"))
    paths = {r["name"]: r["topic_path"] for r in tree.topic_path(leaves).collect()}
    assert paths["Deep"] == ["Document Topics", "doc0.md", "T", "Two", "Deep"]
    totals = {r["idx"]: (r["total_chars"], r["n_nodes"]) for r in tree.subtree_totals(nodes).collect()}
    assert totals[0] == (2 * len(LONG), 4) and totals[2] == (len(LONG), 2)
    drawn = tree.draw(nodes)
    assert f"└── [FILE] doc0.md — total: {2 * len(LONG)} chars" in drawn and "├── One" in drawn and "Leaf nodes: 2\nTotal chunks: 0" in drawn
    chunks = spark.createDataFrame([(0, 1, 3), (0, 3, 4)], "doc_id long, idx int, n int")
    drawn = tree.draw(nodes, chunks)
    assert f"├── One ({len(LONG)} chars) [3 chunks]" in drawn and "Total chunks: 7" in drawn
    assert tree.draw(nodes.limit(0)) == "No tree built yet."


def test_the_forest_has_a_root_and_files(spark):
    nodes = tree.build(docs(spark, f"# T\n## One\n{LONG}", f"# U\n{LONG}"))[0]
    rows = tree.forest(nodes).collect()
    assert [(r["name"], r["source"], r["depth"], r["level"]) for r in rows if r["kind"] == "root"] == [("Document Topics", "root", 0, 0)]
    assert sorted((r["name"], r["idx"], r["depth"], r["level"]) for r in rows if r["kind"] == "file") == [("doc0.md", -1, 0, 1), ("doc1.md", -1, 0, 1)]
    assert {(r["name"], r["parent_idx"], r["level"]) for r in rows if r["kind"] == "section"} == {("T", -1, 2), ("One", 0, 3), ("U", -1, 2)}
    assert tree.forest(nodes.limit(0)).count() == 0


def test_headings_of_long_documents(spark):
    """Many headings: each takes its own lines along."""
    text = "\n".join(f"{'#' * (1 + k % 6)} H{k}\nline {k}\n" for k in range(3000))
    rows = tree.heading_nodes(docs(spark, text)).collect()
    assert len(rows) == 3000 and all(r["content"] == f"line {r['idx']}" for r in rows)


@pytest.mark.parametrize("name", ["tree.json", "tree"])
def test_save_and_load(spark, tmp_path, name):
    nodes = tree.build(docs(spark, f"# T\n## One\n{LONG}\n## Two\n### é\n{LONG}", f"# U\n{LONG}"))[0]
    path = str(tmp_path / "deep" / name)
    sinks.save_tree(nodes, path)
    back = sinks.load_tree(spark, path)
    fields = [f for f in sinks.NODE_FIELDS if f not in ("idx", "parent_idx", "ancestors")]
    assert sorted(map(str, back.select(fields).collect())) == sorted(map(str, nodes.select(fields).collect()))
    paths = lambda n: sorted((r["doc_id"], r["topic_path"]) for r in tree.topic_path(n.where("is_leaf")).collect())
    assert paths(back) == paths(nodes)
    if name.endswith(".json"):
        root = json.load(open(path, encoding="utf-8"))
        assert root["name"] == "Document Topics" and root["depth"] == 0 and [c["name"] for c in root["children"]] == ["doc0.md", "doc1.md"]
        top = root["children"][0]["children"][0]
        assert top["name"] == "T" and [c["name"] for c in top["children"]] == ["One", "Two"] and top["children"][1]["children"][0]["content"] == LONG
    sinks.save_tree(nodes.limit(0), str(tmp_path / "none.json"))
    assert not (tmp_path / "none.json").exists()
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        sinks.load_tree(spark, str(tmp_path / "bad.json"))


def leaves_of(spark, sizes):
    return spark.createDataFrame([(k, s, "x" * n) for k, (s, n) in enumerate(sizes)], "leaf_idx long, source string, content string")


@pytest.mark.parametrize(("target", "want"), [(9, [3, 3, 3]), (10, [4, 3, 3]), (2, [1, 1]), (0, [])])
def test_round_robin(spark, target, want):
    got = quota.round_robin(leaves_of(spark, [("a", 1)] * 3), target).orderBy("leaf_idx").collect()
    assert [r["quota"] for r in got] == want


def test_balanced_rounds_half_to_even_and_never_to_nothing(spark):
    got = quota.balanced(leaves_of(spark, [("b", 500), ("b", 500), ("a", 100), ("a", 9900)]), 11).orderBy("leaf_idx").collect()
    # b comes first and gets 6, a 5: halves of 6; 0.05 and 4.95 of 5
    assert [r["quota"] for r in got] == [3, 3, 1, 5]
    half = quota.balanced(leaves_of(spark, [("a", 100), ("a", 100)]), 5).collect()
    assert [r["quota"] for r in half] == [2, 2]


def test_sources_without_a_share_go(spark):
    assert quota.balanced(leaves_of(spark, [("a", 100), ("b", 100), ("c", 100)]), 2).count() == 2


def test_types_in_turn(spark):
    got = quota.deal_types(spark.range(6), "id").orderBy("id").collect()
    assert [r["type"] for r in got] == ["single-hop", "multi-hop", "inference", "paraphrase", "true-false", "single-hop"]
    assert [r["difficulty"] for r in got] == ["easy", "medium", "hard"] * 2


def test_dense_ids(spark):
    rows = [(k % 7, k) for k in range(500)]
    got = ordering.dense_ids(spark.createDataFrame(rows, "a int, b int").repartition(5), ["a", "b"], "id", 4).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["id"])] == sorted(rows)
    assert sorted(r["id"] for r in got) == list(range(500))
    assert ordering.dense_ids(spark.createDataFrame([], "a int"), ["a"], "id").count() == 0


def test_first_numbers(spark):
    rows = [(k * 3 % 101, k % 5 + 1) for k in range(101)]
    got = {r["key"]: r["first"] for r in ordering.first_numbers(spark.createDataFrame(rows, "key int, n long").repartition(5), "key", "n", "first", 4).collect()}
    before = 0
    for key, n in sorted(rows):
        assert got[key] == before
        before += n
    assert ordering.first_numbers(spark.createDataFrame([], "key int, n long"), "key", "n", "first").count() == 0
