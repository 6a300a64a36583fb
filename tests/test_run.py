"""Files, providers, slicing, generation, and whole runs."""

import json
import os
import time

import pyarrow as pa
import pytest

from folioquest import __main__ as cli
from folioquest import config as settings
from folioquest.functions import providers
from folioquest.operators import generation, ordering, similarity, slicing
from folioquest.plans import pipeline
from folioquest.sources import files, sinks

TEXT = "The council keeps a register of all trees. Every tree has a number on a small plate. Residents may ask for a new tree in autumn. Old trees are checked twice a year by a trained team. A fallen tree is replaced within two winters. The register is open to the public on weekdays. "


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "b").mkdir(parents=True)
    (tmp_path / "in" / "a.md").write_text(f"# Trees\n## Register\n{TEXT * 3}\n## Care\n{TEXT[::-1] * 2}\n## References\n{TEXT}")
    (tmp_path / "in" / "b" / "c.TXT").write_bytes(b"line\r\nnext \xff end" + TEXT.encode() * 4)
    (tmp_path / "in" / "_x.txt").write_text("hidden by Spark " + TEXT)
    (tmp_path / "in" / "empty.txt").write_text("")
    (tmp_path / "in" / "skip.csv").write_text("no")
    return tmp_path


def test_folders(spark, folder):
    got = files.load_documents(spark, str(folder / "in")).orderBy("doc_id").collect()
    assert [r["source"] for r in got] == ["_x.txt", "a.md", "c.TXT", "empty.txt"]
    by = {r["source"]: r for r in got}
    assert by["c.TXT"]["content"].startswith("line\nnext  end") and by["c.TXT"]["doc_type"] == "txt" and by["a.md"]["doc_type"] == "md"
    assert by["empty.txt"]["content"] == "" and by["empty.txt"]["pages"] == [] and by["a.md"]["metadata"]["size"] == len(by["a.md"]["content"])
    with pytest.raises(FileNotFoundError):
        files.load_documents(spark, str(folder / "none"))


def test_pdf_reader_cache_and_errors(spark, folder, tmp_path):
    (folder / "in" / "p.pdf").write_bytes(b"%PDF one")
    (folder / "in" / "q.pdf").write_bytes(b"broken")
    cache = str(tmp_path / "cache")

    def reader(data):
        if b"PDF" not in data:
            raise ValueError("no PDF")
        return {"content": "page one", "pages": ["page one"], "num_pages": 1, "pdf_method": "own"}

    def load(r):
        return {x["source"]: x for x in files.load_documents(spark, str(folder / "in"), r, cache).collect()}

    first = load(reader)
    assert first["p.pdf"]["content"] == "page one" and not first["p.pdf"]["metadata"]["cached"] and "no PDF" in first["q.pdf"]["error"]
    again = load(None)
    assert again["p.pdf"]["metadata"]["cached"] and again["p.pdf"]["content"] == "page one" and "not a PDF" in again["q.pdf"]["error"]


def make_pdf(pages, packed=False, unicode_font=False):
    """A file with a content stream for each page; ``packed``: page objects in an object stream; ``unicode_font``: codes of two bytes with a ToUnicode table."""
    import zlib

    def stream(data, head=b""):
        z = zlib.compress(data)
        return b"<</Filter /FlateDecode /Length %d %s>>\nstream\n%s\nendstream" % (len(z), head, z)

    table = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <00FF> <0000> endbfrange"
    font = b"<</Type /Font /Subtype /Type0 /ToUnicode 8 0 R>>" if unicode_font else b"<</Type /Font /Subtype /Type1 /Encoding <</Differences [128 /fi]>>>>"
    objects = {1: b"<</Type /Catalog /Pages 2 0 R>>", 2: b"<</Type /Pages /Kids [%s] /MediaBox [0 0 600 800] /Resources <</Font <</F1 3 0 R>>>>>>" % b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(len(pages))), 3: font}
    streams = {8: stream(table)}
    for k, page in enumerate(pages):
        objects[10 + 2 * k] = b"<</Type /Page /Parent 2 0 R /Contents %d 0 R>>" % (11 + 2 * k)
        streams[11 + 2 * k] = stream(page)
    if packed:
        bodies = [b"%d %s" % (n, o) for n, o in objects.items()]
        index, body = b"", b""
        for n, o in objects.items():
            index += b"%d %d " % (n, len(body))
            body += o + b" "
        assert bodies
        streams[99] = stream(index + body, b"/Type /ObjStm /N %d /First %d" % (len(objects), len(index)))
        objects = {}
    out = b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in [*objects.items(), *streams.items()])
    return out + b"trailer <</Root 1 0 R>>\n%%EOF"


def shown(text, unicode_font=False):
    return b"<" + text.encode("utf-16-be").hex().encode() + b">" if unicode_font else b"(" + text.encode("cp1252").replace(b"(", b"\\(").replace(b")", b"\\)") + b")"


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("unicode_font", [False, True])
def test_the_text_layer_of_pdf_files(spark, tmp_path, packed, unicode_font):
    def page(title, body):
        lines = b" ".join(shown(line, unicode_font) + b" Tj 0 -12 Td" for line in body)
        return b"BT /F1 20 Tf 1 0 0 1 50 700 Tm %s Tj ET q 2 0 0 2 0 0 cm BT /F1 5 Tf 25 300 Td %s ET Q" % (shown(title, unicode_font), lines.replace(b"0 -12", b"0 -6"))

    body = ["The council keeps a register (of all trees) in a", "large green book that anyone may read on weekdays."]
    (tmp_path / "a.pdf").write_bytes(make_pdf([page("Trees", body), page("More", ["Café hours are from nine to five on every working day."])], packed, unicode_font))
    (tmp_path / "scan.pdf").write_bytes(make_pdf([b"q Q"]))
    (tmp_path / "locked.pdf").write_bytes(make_pdf([b""]).replace(b"trailer <<", b"trailer <</Encrypt 5 0 R "))
    got = {r["source"]: r for r in files.load_documents(spark, str(tmp_path)).collect()}
    a = got["a.pdf"]
    assert a["error"] is None and a["metadata"]["num_pages"] == 2 and a["metadata"]["pdf_method"] == "text layer"
    assert a["content"] == "# Trees\n\n" + " ".join(body) + "\n\n# More\n\nCafé hours are from nine to five on every working day." and len(a["pages"]) == 2
    assert "OCR" in got["scan.pdf"]["error"] and "encrypted" in got["locked.pdf"]["error"]
    again = {r["source"]: r for r in files.load_documents(spark, str(tmp_path), ocr=lambda data, lang, tables: [f"read in {lang}", ""], ocr_lang="pt").collect()}
    assert again["scan.pdf"]["content"] == "read in pt" and again["scan.pdf"]["metadata"]["pdf_method"] == "ocr" and again["scan.pdf"]["metadata"]["num_pages"] == 2


def test_blank_cache_files_go(spark, tmp_path):
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "a.md").write_text(" \n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"x")
    reader = lambda data: {"content": "read", "pages": ["read"], "num_pages": 1, "pdf_method": "own"}
    assert files.load_documents(spark, str(tmp_path / "in"), reader, str(tmp_path / "cache")).first()["content"] == "read"
    assert (tmp_path / "cache" / "a.md").read_text() == "read"


@pytest.mark.parametrize(("answer", "value"), [('```json\n[1]\n```', [1]), ("x ```\n{\"a\": 2}\n``` y", {"a": 2}), ("3", 3), ("nope", None), (None, None)])
def test_answers(answer, value):
    assert providers.parse_json(answer) == value


def test_attempts_wait_and_give_up():
    waits = []

    class Broken:
        def complete(self, request):
            raise OSError

    assert providers.attempt(Broken(), None, 6, waits.append) is None and waits == [1, 2, 4, 8, 16]


def test_segments_of_an_answer():
    good = "x" * 200
    answer = json.dumps({"segments": [{"title": " a ", "content": good}, {"content": "short"}] + [{"title": "t", "content": good}] * 6})
    assert [k for k, _, _ in slicing.accepted_segments(answer, "p")] == [0, 2, 3, 4, 5]
    assert slicing.accepted_segments("not json", "p") == [] and slicing.accepted_segments(None, "p") == [(0, "", "p")]


def seg(*ids):
    return [{"id": i, "title": f"T{i}", "content": f"content {i}"} for i in ids]


def test_topic_trees():
    answer = {"document_title": "D", "topics": [{"topic": "A", "segment_ids": ["1", "9"], "subtopics": [{"topic": "B", "segment_ids": ["1", "2"]}, {"topic": "none", "segment_ids": []}]}, {"topic": "C", "segment_ids": []}]}
    root, used = slicing.topic_tree(answer, "stem", seg("1", "2", "3"))
    rows = slicing.numbered(root)
    assert used and [(r["name"], r["parent_idx"], r["content"]) for r in rows] == [("D", None, None), ("A", 0, None), ("Overview", 1, "content 1"), ("B", 1, "content 1\n\ncontent 2"), ("Other Content", 0, "content 3")]
    assert rows[3]["ancestors"] == [{"idx": 0, "name": "D"}, {"idx": 1, "name": "A"}]


def test_leftovers_are_assigned_by_name():
    answer = {"topics": [{"topic": "A", "segment_ids": ["1"]}]}
    root, _ = slicing.topic_tree(answer, "stem", seg("1", "2", "3"), lambda left, names: [{"segment_id": "2", "topic": "A", "subtopic": None}, {"segment_id": "3", "topic": "A", "subtopic": "missing"}])
    assert [(c["name"], c["content"]) for c in root["children"]] == [("A", "content 1\n\ncontent 2"), ("Other Content", "content 3")]


@pytest.mark.parametrize("answer", [None, "x", {}, {"topics": []}])
def test_flat_trees(answer):
    root, used = slicing.topic_tree(answer, "stem", seg("1", "2"))
    assert not used and root["name"] == "stem" and [c["name"] for c in root["children"]] == ["T1", "T2"]


def test_many_leftovers_take_linear_time():
    """Each was joined to all that its topic had already: 160 GB of copies here."""
    segments = [{"id": str(k), "title": "t", "content": f"{k:<20000}"} for k in range(4000)]
    began = time.perf_counter()
    root, _ = slicing.topic_tree({"topics": [{"topic": "A", "segment_ids": ["0"]}]}, "stem", segments, lambda left, names: [{"segment_id": s["id"], "topic": "A"} for s in left])
    assert time.perf_counter() - began < 5
    assert root["children"][0]["content"] == "\n\n".join(s["content"] for s in segments)


def test_slices_are_asked_and_folded_once_in_a_stream(spark, tmp_path):
    calls = str(tmp_path / "calls")
    rows = [(k, TEXT * (5 * (k % 3)) + str(k) * (k % 2), f"d{k}.md") for k in range(60)] + [(60, None, "none.md"), (61, "", ".md")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, source string").repartition(5)
    segments = slicing.slice_documents(docs, Counting(calls), 1)
    assert "FlatMapGroupsInArrow" not in segments._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in segments.collect():
        got.setdefault(r["doc_id"], []).append((r["seg_no"], r["title"], r["content"]))
    assert open(calls).read().split() == ["slice"] * 61  # all but the null one
    for k, content, source in rows:
        found = slicing.accepted_segments(providers.OfflineChat().complete(providers.Request("slice", "", "", {"text": content})), content) if content else []
        keep = similarity.keep_new([frozenset(c.lower().split()) for _, _, c in found])
        want = [(n, t, c) for n, ((_, t, c), new) in enumerate(zip(found, keep, strict=True)) if new]
        assert sorted(got[k]) == (want or [(0, source[: source.rindex(".")] or source, content)])


def test_groups_across_batches():
    keys = [1, 1, 2, 3, 3, 3, 3, 4, None, None, 5]
    for cuts in ([3], [4, 5, 6], [1, 1, 2], [0, 11], [2, 8]):
        at = [0, *cuts, len(keys)]
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[a:b], pa.int64()), "n": pa.array(range(a, b), pa.int64())}) for a, b in zip(at, at[1:])]
        found = [t.to_pydict() for t in ordering.groups(iter(batches), "k")]
        assert [t["k"] for t in found] == [[1, 1], [2], [3] * 4, [4], [None, None], [5]] and sum((t["n"] for t in found), []) == list(range(len(keys)))


class Seeing(providers.OfflineChat):
    """Fails for segments of which more is given than a prompt shows."""

    def complete(self, request):
        if any(len(s["content"]) > slicing.SHOWN + 1 for s in request.data["segments"]):
            raise OSError
        return super().complete(request)


def test_contents_of_topics_wait_in_a_file(spark, monkeypatch):
    monkeypatch.setattr(slicing, "HELD", 100)
    rows = [(d, "a.md", n, f"seg_{n}", f"{'AB'[n % 2]} title", f"{d} {n} é " * 300) for d in range(3) for n in range(40)]
    segments = spark.createDataFrame(rows, "doc_id long, source string, seg_no int, seg_id string, title string, content string").repartition(7)
    got = slicing.topic_nodes(segments, Seeing(), 1).collect()
    for d in range(3):
        own = {r["name"]: r for r in got if r["doc_id"] == d}
        assert {k: r["content"] for k, r in own.items()} == {"a.md": None} | {c: "\n\n".join(r[5] for r in rows if r[0] == d and r[4][0] == c) for c in "AB"}
        assert all(r["used_topics"] for r in own.values())


class Counting(providers.OfflineChat):
    """Writes the kind of each call to a file; fails for texts with ``broken`` in them while that file says so."""

    def __init__(self, calls):
        self.calls = calls

    def complete(self, request):
        with open(self.calls, "a") as f:
            f.write(request.kind + "\n")
        if "broken" in str(request.data) and not os.path.exists(self.calls + ".mended"):
            raise OSError
        return super().complete(request)


def test_answers_are_kept_by_content(spark, tmp_path):
    calls, cache = str(tmp_path / "calls"), str(tmp_path / "cache")
    rows = [(0, TEXT * 5, "a.md"), (1, "tiny", "b.md"), (2, TEXT * 5, "a.md")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, source string")

    def run(docs):
        segments = slicing.slice_documents(docs, Counting(calls), 1, cache=f"{cache}/segments").cache()
        nodes = slicing.topic_nodes(segments, Counting(calls), 1, cache=f"{cache}/topics")
        return sorted(map(str, segments.collect())), sorted(map(str, nodes.collect()))

    one = run(docs)
    asked = open(calls).read().split()
    # the same text under the same name is asked about once
    assert sorted(set(asked)) == ["slice", "topics"] and asked.count("slice") == 2 and asked.count("topics") == 2
    assert run(docs) == one and open(calls).read().split() == asked
    more = docs.unionAll(spark.createDataFrame([(3, "broken " + TEXT * 4, "c.md")], docs.schema))
    run(more)
    assert open(calls).read().split()[len(asked) :] == ["slice", "topics"]
    # a call that failed is asked again, and then no more
    (tmp_path / "calls.mended").write_text("")
    run(more)
    n = len(open(calls).read().split())
    assert n > len(asked) + 2 and run(more) and len(open(calls).read().split()) == n


class Scripted:
    """Answers by kind from lists."""

    def __init__(self, **answers):
        self.answers, self.asked = answers, []

    def complete(self, request):
        self.asked.append(request)
        queue = self.answers[request.kind]
        value = queue.pop(0) if len(queue) > 1 else queue[0]
        return value if isinstance(value, str) else json.dumps(value)


def section(content=TEXT, related=()):
    return generation.Section(0, "a.md", "Register", ["Root", "a.md", "Register"], content, [], list(related))


def config(**more):
    return settings.Config(num_samples=5, **more)


GOOD = {"question": "Which register does the council keep for the town?", "ground_truth": "Of all trees"}


def test_single_pair():
    provider = Scripted(facts=[{"extracted_fact": "Every tree has a number."}], question=[GOOD | {"type": "own", "difficulty": "hard"}])
    pairs = generation.Generator(config(), provider).pairs(section(related=["other text"]), 1)
    assert len(pairs) == 1 and pairs[0]["metadata"] == {"type": "own", "difficulty": "hard", "topic_path": ["Root", "a.md", "Register"], "source": "a.md"}
    assert pairs[0]["contexts"] == [TEXT] and "other text" in provider.asked[0].prompt
    e = generation.entry(pairs[0])
    assert e["answer"] == e["ground_truth"] == "Of all trees" and e["source"] == "a.md"


def test_bad_answers_give_nothing():
    for facts, question in ((["nope"], [GOOD]), ([[]], [GOOD]), ([[{"extracted_fact": "A fact."}]], ["nope"]), ([[{"extracted_fact": "A fact."}]], [{"question": "", "ground_truth": "x"}]), ([[{"extracted_fact": "A fact."}]], [{"question": "What is it?", "ground_truth": "x"}])):
        assert generation.Generator(config(), Scripted(facts=facts, question=question)).pairs(section(), 1) == []


def test_batches_align_and_drop_duplicates():
    facts = [[{"extracted_fact": f"Fact number {k} about trees."} for k in range(4)]]
    questions = [[GOOD, GOOD, "bad", {"question": "Who checks the old trees, and how often in a year?", "ground_truth": "A team"}]]
    pairs = generation.Generator(config(), Scripted(facts=facts, questions=questions)).pairs(section(), 4)
    assert [p["metadata"]["type"] for p in pairs] == ["single-hop", "paraphrase"]


def test_an_object_where_an_array_is_due():
    g = generation.Generator(config(), Scripted(facts=[{"extracted_fact": "x"}], questions=[[GOOD]]))
    assert g.pairs(section(), 3) == [] and g.facts(section(), 3, 100, lone=True) == ["x"]


def test_history():
    h = generation.History()
    h.accept("Which of the many trees stands nearest to the old gate?", "single-hop", None)
    assert h.is_duplicate(" which of the many trees stands nearest to the old GATE??")
    assert h.is_duplicate("Which of the many old trees stands nearest to the gate?")
    assert not h.is_duplicate("How often is each tree in the park checked by the team?")
    for k in range(20):
        h.accept(f"q{k}", "single-hop", None)
    assert not h.is_duplicate("Which of the many old trees stands nearest to the gate?")
    assert h.is_duplicate("Which of the many trees stands nearest to the old gate?")


def test_sides_are_balanced():
    h = generation.History()
    sides = []
    for k in range(4):
        sides.append(h.next_true())
        h.accept(f"q{k}", "true-false", sides[-1])
    assert sides == [True, False, True, False]


def test_fresh_facts():
    h = generation.History()
    h.facts.extend(["a b c d", "e f g h"])
    assert h.freshest(["a b c d", "a b x y", "m n o p"], 1) == "m n o p"
    assert generation.History().freshest(["one", "two"], 1) in ("one", "two")


def test_the_loop_stops():
    never = Scripted(facts=["nope"], question=["nope"], questions=["nope"])
    assert generation.generate(lambda: iter([(section(), 3)]), config(), never) == []
    facts = [[{"extracted_fact": "A fact."}]]
    many = [[{"question": f"Which {'abcdefghi'[k] * 3} rule {'stuvwxyzq'[k] * 4} does {'klmnopqrs'[k] * 5} set out?", "ground_truth": "x"}] for k in range(9)]
    out = generation.generate(lambda: iter([(section(), 2), (section("other " + TEXT), 9)]), settings.Config(num_samples=2), Scripted(facts=facts, questions=many, question=[m[0] for m in many]))
    assert len(out) == 2


@pytest.mark.parametrize("llm", [False, True])
def test_whole_run(spark, folder, llm):
    c = settings.Config(num_samples=6, use_llm_pipeline=llm, tree_path=str(folder / ("tree.json" if llm else "tree")), slicer_cache_dir=str(folder / "sliced"), parsed_path=str(folder / "parsed"), output_path=str(folder / "out.json"))
    out = pipeline.run_pipeline(spark, str(folder / "in"), c)
    assert 1 <= len(out) <= 6 and all(set(e) == {"question", "answer", "contexts", "ground_truth", "source", "metadata"} for e in out)
    assert len({e["question"] for e in out}) == len(out)
    again = pipeline.run_pipeline(spark, None, c, qa_only=True)
    assert [e["question"] for e in again] == [e["question"] for e in out]
    sinks.save_dataset(out, c.output_path)
    assert json.load(open(c.output_path, encoding="utf-8")) == json.loads(json.dumps(out))
    assert sinks.save_html(out, c.output_path).endswith("out.html")


def test_a_second_run_asks_nothing(spark, folder):
    calls = str(folder / "calls")
    c = settings.Config(num_samples=6, tree_path=str(folder / "tree"), slicer_cache_dir=str(folder / "sliced"), parsed_path=str(folder / "parsed"))
    docs = spark.createDataFrame([(0, TEXT * 5, "a.md"), (1, TEXT[::-1] * 4, "b.md")], "doc_id long, content string, source string")
    one = pipeline.build_tree(docs, c, Counting(calls)).count()
    n = len(open(calls).read().split())
    assert pipeline.build_tree(docs, c, Counting(calls)).count() == one and len(open(calls).read().split()) == n


def test_models_by_name():
    assert isinstance(providers.chat_of("offline"), providers.OfflineChat)
    chat = providers.chat_of("some-model", "http://localhost:1/chat", "KEY")
    assert (chat.model, chat.url, chat.key_variable) == ("some-model", "http://localhost:1/chat", "KEY")
    assert isinstance(providers.embedder_of("hashing"), providers.HashingEmbedder) and providers.embedder_of("e", "http://x").model == "e"
    for make in (providers.chat_of, providers.embedder_of):
        with pytest.raises(ValueError):
            make("some-model")


def test_chat_over_http(monkeypatch):
    import http.server
    import threading

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            out = {"data": [{"embedding": [1.0, 2.0]} for _ in body["input"]]} if "input" in body else {"choices": [{"message": {"content": f"{body['model']} {body['messages'][1]['content']} {self.headers['Authorization']}"}}]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("TEST_KEY", "secret")
    url = f"http://127.0.0.1:{server.server_port}/"
    assert providers.chat_of("m", url, "TEST_KEY").complete(providers.Request("facts", "s", "hello")) == "m hello Bearer secret"
    assert providers.embedder_of("e", url, "TEST_KEY").embed(["a", "b"]).tolist() == [[1.0, 2.0]] * 2
    server.shutdown()


def test_run_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, None, settings.Config(tree_path=str(tmp_path / "no.json")), qa_only=True)
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, None, settings.Config(tree_path=str(tmp_path / "no")), qa_only=True)
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        pipeline.run_pipeline(spark, str(tmp_path / "none"), settings.Config(parsed_path=str(tmp_path / "p")))


def test_dataset_files(tmp_path):
    path = str(tmp_path / "d.json")
    assert sinks.save_dataset([], path) == 0 and json.load(open(path)) == []
    sinks.save_dataset([{"a": "é"}], path)
    assert "é" in open(path, encoding="utf-8").read()


def test_report():
    entry = {"question": "a < b & c?", "ground_truth": "x", "contexts": ["<p>"], "source": "s.md", "metadata": {"type": None, "difficulty": "easy", "topic_path": ["1", "2", "3", "4"]}}
    page = sinks.html_report([entry, entry])
    assert "a &lt; b &amp; c?" in page and "<td>s</td><td>2</td>" in page and "<td>-</td>" in page and "2 &gt; 3 &gt; 4" in page and "1 &gt; 2" not in page


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("# note\nCHUNK_SIZE=300\nUSE_LLM_PIPELINE='TRUE'\nBALANCE_TRUE_FALSE=yes\n")
    env = settings.read_env_file(str(tmp_path / ".env"))
    c = settings.from_env(env, num_samples=7, batch_size=None)
    assert (c.chunk_size, c.use_llm_pipeline, c.balance_true_false, c.num_samples, c.batch_size) == (300, True, False, 7, 5)
    with pytest.raises(ValueError):
        settings.Config(chunk_size=0)
    args = cli.parser().parse_args(["in", "--chunk-size", "50", "--no-balance-docs"])
    c = cli.config_of(args, {"CHUNK_OVERLAP": "9"})
    assert (c.chunk_size, c.chunk_overlap, c.balance_per_document, c.use_llm_pipeline) == (50, 9, False, True)


def test_wipe(tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "f").write_text("x")
    sinks.wipe(str(tmp_path / "d"), str(tmp_path / "f"), str(tmp_path / "none"))
    assert list(tmp_path.iterdir()) == []
