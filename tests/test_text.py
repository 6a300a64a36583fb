import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioquest.functions import fixed, text
from folioquest.operators import filters, generation, splitting


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "t string").select(*columns).first())


@pytest.mark.parametrize("value", ["", "  a b ", " x\x1c ", "\n\t", "a\x85b", "é 😀 "])
def test_strip_and_words_are_unicode(spark, value):
    assert one(spark, value, text.strip("t"), text.words("t")) == (value.strip(), value.split())


@pytest.mark.parametrize("value", ["a & b < c > d &amp;", "<<>>", ""])
def test_escape(spark, value):
    assert one(spark, value, text.escape_html("t")) == (value.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"),)


def test_stem(spark):
    assert [one(spark, v, text.stem("t"))[0] for v in ("a.md", "a.b.txt", ".hidden", "plain")] == ["a", "a.b", ".hidden", "plain"]


PROSE = "The committee met in spring and agreed on a plan that covers the whole region, with clear aims for every town and a budget for roads, schools and parks that all members accepted."


@pytest.mark.parametrize(
    ("chunk", "reason"),
    [
        ("short", "short"),
        (PROSE, None),
        (PROSE + " Vol. 160, aprovado pelo conselho editorial", "patterns"),
        ("word\n" * 50, "newlines"),
        (PROSE + " copyright", "metadata"),
        (PROSE * 2 + " copyright", None),
        (PROSE * 2 + " copyright, ISBN", "metadata"),
        (PROSE + " et al. doi:10", "citations"),
        (PROSE * 2 + " et al. doi:10", None),
    ],
)
def test_chunk_quality(spark, chunk, reason):
    assert one(spark, chunk, filters.quality_reasons(F.col("t"))) == (reason,)


def test_own_patterns_and_none(spark):
    assert one(spark, PROSE + " spam eggs", filters.quality_reasons(F.col("t"), ("spam", "eggs"))) == ("patterns",)
    assert one(spark, PROSE + " vol. 160 pes160", filters.quality_reasons(F.col("t"), ())) == (None,)


@pytest.mark.parametrize("name", ["REFERÊNCIAS", "References", "Annex 3", "Sumári", "Table of Contents", "CONTENTS  ", "© 2020", "Members of the panel"])
def test_skipped_names(spark, name):
    assert one(spark, name, filters.skipped_name(F.col("t"))) == (True,)


@pytest.mark.parametrize("name", ["Introduction", "Contents of the box", "My references list", "Annex"])
def test_other_names_stay(spark, name):
    assert one(spark, name, filters.skipped_name(F.col("t"))) == (False,)


@pytest.mark.parametrize(("content", "front"), [("", False), (None, False), ("\n \n", True), ("ISBN 1\nprose\nprose", True), ("ISBN 1\nprose\nprose\nmore", False), ("1. Intro 7\n2. End 9", True)])
def test_front_matter(spark, content, front):
    assert one(spark, content, filters.is_front_matter(F.col("t"))) == (front,)


QUESTIONS = ["What is it?", "What is the purpose of it?", "What is the recommended daily amount of salt for adults over fifty", "Como evitar quedas em casa?", "Como evitar quedas em casa quando o piso fica molhado todos os dias?", "Which of the three plans costs least per year?", "explain the water cycle to me", "É " * 15]


@pytest.mark.parametrize("question", QUESTIONS)
def test_generic_questions_in_both_forms(spark, question):
    assert one(spark, question, filters.is_generic_question(F.col("t")))[0] == generation.is_generic(question)


def test_generic_rules():
    assert [generation.is_generic(q) for q in QUESTIONS] == [True, True, False, True, False, False, True, False]


@pytest.mark.parametrize(("kind", "true", "answer", "wrong"), [("true-false", True, " FALSO: x", True), ("true-false", False, "Falso", False), ("true-false", False, "verdadeiro, x", True), ("single-hop", True, "Falso", False)])
def test_polarity(spark, kind, true, answer, wrong):
    assert one(spark, answer, filters.wrong_polarity(F.lit(kind), F.lit(true), F.col("t"))) == (wrong,)
    assert generation.has_wrong_polarity(kind, true, answer) == wrong


def test_grounding(spark):
    assert one(spark, "  ", filters.is_grounded(F.col("t"))) == (False,)
    assert one(spark, "a b c", filters.grounding_score(F.col("t"), F.lit("b c d"))) == (pytest.approx(2 / 3),)


def test_exact_question_dedup(spark):
    rows = [(1, "What now?"), (2, " what NOW??"), (3, "Else?")]
    got = filters.first_of_each_question(spark.createDataFrame(rows, "id int, q string"), "q", "id").select("id").collect()
    assert sorted(r["id"] for r in got) == [1, 3]


def test_tails():
    plain = "x" * 5000
    assert len(splitting.pieces_of(plain, "document", 1000, 200, "reference")) == 206
    assert len(splitting.pieces_of(plain, "document", 1000, 200, "stop")) == 6
    assert len(splitting.pieces_of("x" * 30_000, "slice", 12_000, 500, "reference")) == 503
    assert len(splitting.pieces_of("x" * 30_000, "slice", 12_000, 500, "stop")) == 3


def test_short_texts():
    assert splitting.pieces_of("  a b ", "leaf", 500, 100, "reference") == [(0, 6, "  a b ")]
    assert splitting.pieces_of("", "leaf", 500, 100, "reference") == []
    assert splitting.pieces_of("", "document", 500, 100, "reference") == [(0, 0, "")]


def test_pieces_cover_all_words():
    rng = random.Random(1)
    for _ in range(50):
        t = " ".join("w" * rng.randrange(1, 30) for _ in range(rng.randrange(1, 300)))
        for kind in ("document", "leaf", "slice"):
            pieces = splitting.pieces_of(t, kind, 200, 40, "stop")
            covered = set()
            for a, b, c in pieces:
                covered.update(range(a, b))
                assert c == t[a:b].strip() or len(pieces) == 1
            assert all(i in covered for i, c in enumerate(t) if c != " ")


def test_paragraphs_are_preferred():
    t = "a" * 90 + "\n\n" + "b c " * 40
    assert splitting.pieces_of(t, "slice", 120, 10, "stop")[0] == (0, 90, "a" * 90)


def test_split_rows(spark):
    df = spark.createDataFrame([(1, "Word " * 200, "s"), (2, None, "s"), (3, "", "s")], "doc_id long, content string, source string")
    got = splitting.leaf_chunks(df, 200, 20).collect()
    assert {r["doc_id"] for r in got} == {1} and all(len(r["piece"]) <= 200 for r in got)
    assert [r["piece_no"] for r in sorted(got, key=lambda r: r["start_pos"])] == list(range(len(got)))


def test_fixed_lists():
    assert len(fixed.METADATA_TERMS) == 48 and len(fixed.SKIP_SECTIONS) == 23 and len(fixed.FRONT_MATTER) == 12


def test_a_pattern_for_any_term():
    import random
    import re

    rng = random.Random(3)
    for _ in range(100):
        terms = ["".join(rng.choice("ab.( \n") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 12))]
        for _ in range(20):
            t = "".join(rng.choice("ab.( \n") for _ in range(rng.randrange(8)))
            assert bool(re.search(filters.any_of(terms), t)) == any(x in t for x in terms)


def test_new_questions_are_those_a_run_accepts():
    import random

    from folioquest.operators import generation

    rng, stock = random.Random(4), [f"w{k}" for k in range(14)]
    asked = [" ".join(rng.choice(stock) for _ in range(rng.randrange(1, 12))) + rng.choice(["", "?", "??"]) for _ in range(400)]
    history, want = generation.History(), []
    for q in asked:
        want.append(not history.is_duplicate(q))
        if want[-1]:
            history.accept(q, "single-hop", None)
    assert filters.new_questions([q.lower().strip().rstrip("?") for q in asked]) == want and 50 < sum(want) < 400


def test_numbered_chunks_against_dense_numbers(spark):
    import random

    from folioquest.operators import ordering, splitting

    rng = random.Random(5)
    rows = [(k * 7 % 40, " ".join(rng.choice(["word", "abstract", "isbn", "longer-word", "\n"]) for _ in range(rng.randrange(0, 900)))) for k in range(40)] + [(100, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content string").repartition(3)
    good = filters.good_chunks(splitting.document_chunks(docs))
    want = sorted((r["chunk_id"], r["doc_id"], r["start_pos"], r["end_pos"], r["piece"]) for r in ordering.dense_ids(good, ["doc_id", "start_pos"], "chunk_id").collect())
    got = sorted(tuple(r) for r in splitting.numbered_chunks(docs).select("chunk_id", "doc_id", "start_pos", "end_pos", "piece").collect())
    assert got == want and len(got) > 20


def test_pieces_are_sent_in_bounded_arrays():
    texts = ["one two three " * n for n in (100, 0, 90, 1, 120)]
    batch = pa.array([*texts, None])
    whole = [[{"start": a, "end": b, "content": c} for a, b, c in splitting.pieces_of(t, "document", 1000, 200, "reference")] for t in texts] + [[]]
    sent = list(splitting._arrays(iter([batch, batch.slice(0, 0), batch]), "document", 1000, 200, "reference", 1000))
    assert [own for part in sent for own in part.to_pylist()] == whole * 2
    # the texts of over 1,000 characters end an array each, so none waits for the batch's end
    assert [len(part) for part in sent] == [1, 2, 2, 1] * 2


def test_many_pieces_keep_their_rows(spark, monkeypatch):
    monkeypatch.setattr(splitting, "SENT", 500)
    docs = spark.createDataFrame([(k, f"{k} words " * (k * 7 % 300)) for k in range(60)], "doc_id long, content string").coalesce(1)
    got = sorted(tuple(r) for r in splitting.document_chunks(docs).select("doc_id", "start_pos", "end_pos", "piece").collect())
    assert got == sorted((k, *p) for k in range(60) for p in splitting.pieces_of(f"{k} words " * (k * 7 % 300), "document", 1000, 200, "reference"))
