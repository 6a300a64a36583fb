import pytest
from pyspark.sql import functions as F

from folioquest.operators import layout

SPANS = "doc_id string, page int, block_no int, line_no int, span_no int, text string, size double, x0 double, y0 double, x1 double, y1 double, kind int"


def spans(spark, blocks):
    """blocks: (page, y, size, text)."""
    return spark.createDataFrame([("d", p, k, 0, 0, t, float(s), 0.0, float(y), 90.0, float(y) + 5, 0) for k, (p, y, s, t) in enumerate(blocks)], SPANS)


@pytest.mark.parametrize(
    ("sizes", "want"),
    [
        ([10, 10, 18, 14, 12], (10, 18, 14, 12)),
        ([10, 10, 18, 14], (10, 18, 18, 14)),
        ([10, 10, 18], (10, 18, 18, 18)),
        ([10, 10, 8], (10, 10, 10, 10)),
        ([12, 10, 12, 10], (12, 12, 12, 12)),
    ],
)
def test_thresholds(spark, sizes, want):
    r = layout.heading_thresholds(layout.font_sizes(spans(spark, [(1, k, s + 0.04, "t") for k, s in enumerate(sizes)]))).first()
    assert (r["body"], r["h1"], r["h2"], r["h3"]) == want


def test_blocks_become_headings(spark):
    got = {r["raw_text"]: r["text"] for r in layout.page_blocks(spans(spark, [(1, 0, 18, "Title"), (1, 10, 10, "body"), (1, 20, 10, "body 2"), (1, 30, 18, "x" * 200)])).collect()}
    assert got["Title"] == "# Title" and got["body"] == "body" and got["x" * 200] == "x" * 200


@pytest.mark.parametrize(
    ("blocks", "want"),
    [
        (["T", "his is it"], ["This is it"]),
        (["A", "B", "C", "rest"], ["AB", "Crest"]),
        (["A", "B"], ["AB"]),
        (["rest", "A"], ["rest", "# A"]),
        (["A", "B", "C"], ["AB", "# C"]),
        (["A", "rest", "B", "C"], ["Arest", "BC"]),
    ],
)
def test_drop_caps(spark, blocks, want):
    sized = [(1, 10 * k, 20 if len(b) == 1 else 10, b) for k, b in enumerate(blocks)] + [(2, 0, 10, "body")] * 9
    got = layout.page_blocks(spans(spark, sized)).where("page = 1").orderBy("y").collect()
    assert [r["text"] for r in got] == want


def test_headers_and_footers(spark):
    blocks = [(p, y, 10, t) for p in range(1, 5) for y, t in ((0, f"Report  Page {p}"), (5, f"Chapter {'iv' if p % 2 else 'ix'}"), (10, f"text number {'abcd'[p - 1]}"))]
    done = layout.markdown(layout.page_blocks(spans(spark, blocks))).first()
    assert done["content"] == "\n\n".join(f"# text number {c}" for c in "abcd") and len(done["pages"]) == 4


def test_two_pages_have_no_headers(spark):
    assert layout.repeated_headers(layout.text_blocks(spans(spark, [(1, 0, 10, "same"), (2, 0, 10, "same")]))).count() == 0


def test_tables(spark):
    rows = spark.createDataFrame([("d", 1, [["a ", None], ["1", "b"]], 0.0, 8.0, 50.0, 16.0)], "doc_id string, page int, rows array<array<string>>, x0 double, y0 double, x1 double, y1 double")
    got = layout.page_blocks(spans(spark, [(1, 0, 10, "above"), (1, 10, 10, "inside"), (1, 20, 10, "below")]), rows).orderBy("y").collect()
    assert [r["text"] for r in got] == ["# above", '<table border="1">\n<tr><th>a</th><th></th></tr>\n<tr><td>1</td><td>b</td></tr>\n</table>', "# below"]
    empty = spark.createDataFrame([([],)], "rows array<array<string>>").select(layout.table_html(F.col("rows")))
    assert empty.first()[0] == ""


def test_digital(spark):
    pages = spark.createDataFrame([("a", "x" * 51, 1), ("a", "", 2), ("b", " " * 60 + "x", 1)], "doc_id string, text string, page int")
    assert {r["doc_id"]: r["is_digital"] for r in layout.is_digital(pages).collect()} == {"a": True, "b": False}
    assert {r["doc_id"]: r["num_pages"] for r in layout.page_count(pages).collect()} == {"a": 2, "b": 1}
