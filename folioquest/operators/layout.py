"""Pages of text blocks to Markdown.

spans: doc_id, page, block_no, line_no, span_no, text, size, x0, y0, x1, y1 (the block's box), kind (0: text).
tables: doc_id, page, rows (array of arrays of strings), x0, y0, x1, y1.
How they are taken from a file is a provider's matter; all rules about them are here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioquest.functions import storage, text

KEY = ["doc_id", "page"]


def is_digital(page_texts: DataFrame) -> DataFrame:
    """doc_id, is_digital: some page (doc_id, text) has over 50 characters."""
    return page_texts.groupBy("doc_id").agg(F.bool_or(F.length(text.strip("text")) > 50).alias("is_digital"))


def page_count(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.countDistinct("page").alias("num_pages"))


def font_sizes(spans: DataFrame) -> DataFrame:
    """doc_id, size (to a tenth), n, first_pos of text spans."""
    place = F.struct("page", "block_no", "line_no", "span_no")
    sized = spans.where("kind = 0").select("doc_id", F.round("size", 1).alias("size"), place.alias("place")).where("size > 0")
    return sized.groupBy("doc_id", "size").agg(F.count("*").alias("n"), F.min("place").alias("first_pos"))


def heading_thresholds(sizes: DataFrame) -> DataFrame:
    """doc_id, body, h1, h2, h3. The body's size is the most frequent one, ties to the first met; larger sizes are headings, and without any every short block is one."""
    body = sizes.groupBy("doc_id").agg(F.min_by("size", F.struct(-F.col("n"), "first_pos")).alias("body"), F.collect_set("size").alias("all"))
    larger = F.sort_array(F.filter("all", lambda s: s > F.col("body")), asc=False)
    at = lambda k: F.try_element_at(F.col("larger"), F.lit(k))
    n = F.size("larger")
    picked = body.select("doc_id", "body", larger.alias("larger"))
    return picked.select("doc_id", "body", F.coalesce(at(1), "body").alias("h1"), F.when(n >= 3, at(2)).otherwise(F.coalesce(at(1), "body")).alias("h2"), F.when(n >= 3, at(3)).otherwise(F.coalesce(at(2), at(1), "body")).alias("h3"))


#: Without any sized text.
DEFAULT_THRESHOLDS = {"body": 10.0, "h1": 18.0, "h2": 14.0, "h3": 12.0}


def table_html(rows: Column) -> Column:
    """First row as heads; empty cells stay empty."""
    cell = lambda tag: lambda c: F.concat(F.lit(f"<{tag}>"), text.strip(F.coalesce(c, F.lit(""))), F.lit(f"</{tag}>"))
    line = lambda r, i: F.concat(F.lit("<tr>"), F.array_join(F.when(i == 0, F.transform(r, cell("th"))).otherwise(F.transform(r, cell("td"))), ""), F.lit("</tr>"))
    return F.when(F.size(rows) > 0, F.concat(F.lit('<table border="1">\n'), F.array_join(F.transform(rows, line), "\n"), F.lit("\n</table>"))).otherwise("")


def text_blocks(spans: DataFrame) -> DataFrame:
    """One row a block: its spans stripped and joined by spaces, its largest size and its box."""
    kept = spans.where("kind = 0").withColumn("t", text.strip("text")).where("t <> ''")
    place = F.struct("line_no", "span_no", "t")
    blocks = kept.groupBy(*KEY, "block_no").agg(F.array_sort(F.collect_list(place)).alias("parts"), F.max("size").alias("max_font"), *[F.first(c).alias(c) for c in ("x0", "y0", "x1", "y1")])
    return blocks.select(*KEY, "block_no", F.array_join(F.col("parts.t"), " ").alias("raw_text"), "max_font", "x0", "y0", "x1", "y1")


def outside_tables(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """Blocks whose box meets no table's on the page."""
    boxes = tables.select(*KEY, *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")])
    meets = (F.col("x0") < F.col("t_x1")) & (F.col("t_x0") < F.col("x1")) & (F.col("y0") < F.col("t_y1")) & (F.col("t_y0") < F.col("y1"))
    same = (blocks["doc_id"] == boxes["doc_id"]) & (blocks["page"] == boxes["page"])
    return blocks.join(boxes, same & meets, "left_anti")


def marked_blocks(blocks: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds ``text`` with its heading marks, and is_heading: short blocks in a size of headings."""
    sized = blocks.join(thresholds, "doc_id", "left")
    at_least = lambda h: F.col("max_font") >= F.coalesce(h, F.lit(DEFAULT_THRESHOLDS[h]))
    marks = F.when(F.length("raw_text") >= 200, "").when(at_least("h1"), "# ").when(at_least("h2"), "## ").when(at_least("h3"), "### ").otherwise("")
    return sized.select(*KEY, "block_no", "raw_text", F.concat(marks, "raw_text").alias("text"), (marks != "").alias("is_heading"), F.col("y0").alias("y"))


def merge_drop_caps(blocks: DataFrame) -> DataFrame:
    """Blocks in order of their place (y, block_no) with drop caps merged.

    A heading of one or two characters is glued to the block below, which then is no heading. So in a run of such
    headings the first goes into the second, the third into the fourth, and an odd last one into what follows the
    run; if nothing follows on the page it stays.
    """
    order = Window.partitionBy(*KEY).orderBy("y", "block_no")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("is_heading") & (F.length(text.strip("raw_text")) <= 2)
    rows = blocks.withColumns({"at": F.row_number().over(order), "cap": cap}).withColumn("last_other", F.coalesce(F.max(F.when(~F.col("cap"), F.col("at"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    in_run = F.when(F.col("cap"), F.col("at") - F.col("last_other"))
    rows = rows.withColumns({"gives": F.coalesce((in_run % 2 == 1) & (F.col("at") < F.max("at").over(whole)), F.lit(False))})
    lead = rows.withColumns({"takes": F.coalesce(F.lag("gives").over(order), F.lit(False)), "cap_text": text.strip(F.lag("raw_text").over(order))}).where(~F.col("gives"))
    glued = F.concat("cap_text", F.regexp_replace("raw_text", f"^[{text.SPACE}]+", ""))
    return lead.select(*KEY, "block_no", "y", F.when(F.col("takes"), glued).otherwise(F.col("raw_text")).alias("raw_text"), F.when(F.col("takes"), glued).otherwise(F.col("text")).alias("text"), (F.col("is_heading") & ~F.col("takes")).alias("is_heading"))


def page_blocks(spans: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """All blocks of all pages in Markdown: tables as HTML, text outside them, drop caps merged."""
    thresholds = heading_thresholds(font_sizes(spans))
    blocks = text_blocks(spans)
    if tables is None:
        return merge_drop_caps(marked_blocks(blocks, thresholds))
    html = table_html(F.col("rows"))
    as_blocks = tables.where(F.size("rows") > 0).select(*KEY, (-F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("y0"), F.desc("x0")))).alias("block_no"), html.alias("raw_text"), html.alias("text"), F.lit(False).alias("is_heading"), F.col("y0").alias("y"))
    return merge_drop_caps(as_blocks.unionByName(marked_blocks(outside_tables(blocks, tables), thresholds)))


def normal_header(raw: Column) -> Column:
    """Lower case, numbers and Roman numerals as #, white space collapsed."""
    out = F.regexp_replace(F.lower(text.strip(raw)), r"(?U)\d+", "#")
    out = F.regexp_replace(out, r"(?U)\b[ivxlcdm]{1,6}\b", "#")
    return text.strip(F.regexp_replace(out, f"[{text.SPACE}]+", " "))


def repeated_headers(blocks: DataFrame) -> DataFrame:
    """doc_id, norm: short texts on three pages at least and three in ten of the document's; documents under three pages have none."""
    pages = blocks.groupBy("doc_id").agg(F.countDistinct("page").alias("n_pages"))
    norms = blocks.select(*KEY, normal_header(F.col("raw_text")).alias("norm")).where((F.length("norm") < 200) & (F.length("norm") > 0))
    counts = norms.groupBy("doc_id", "norm").agg(F.countDistinct("page").alias("n"))
    return counts.join(pages, "doc_id").where((F.col("n_pages") >= 3) & (F.col("n") >= F.greatest(F.lit(3.0), 0.3 * F.col("n_pages")))).select("doc_id", "norm")


def without_headers(blocks: DataFrame) -> DataFrame:
    marked = blocks.withColumn("norm", normal_header(F.col("raw_text")))
    return marked.join(repeated_headers(blocks), ["doc_id", "norm"], "left_anti").drop("norm")


def markdown(blocks: DataFrame) -> DataFrame:
    """doc_id, content, pages: blocks and pages joined by blank lines; a page without blocks isn't there. The blocks are stored first, as they are read three times."""
    blocks = storage.checkpoint(blocks)
    pages = without_headers(blocks).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("y", "block_no", "text"))).alias("b"))
    pages = pages.select(*KEY, F.array_join(F.col("b.text"), "\n\n").alias("page_text"))
    docs = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "page_text"))).alias("p"))
    return docs.select("doc_id", F.array_join(F.col("p.page_text"), "\n\n").alias("content"), F.col("p.page_text").alias("pages"))
