"""Layout rules over web pages: the host is the document, a page is a page, each text between tags is a block, and its place and length give a size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.operators import layout
from folioquest.plans.tables import table
from folioquest.plans.text_queries import quote

HOST = r"^https?://([^/]+)"
BETWEEN = ">([^<]+)<"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    each = pages.select(F.regexp_extract("url", HOST, 1).alias("doc_id"), F.col("page_id").alias("page"), F.posexplode(F.regexp_extract_all("html", F.lit(BETWEEN), F.lit(1))).alias("block_no", "text"))
    short = F.length("text") < 60
    size = F.when(F.col("block_no") == 0, 18.04).when(short & (F.col("block_no") % 3 == 1), 12.0).when(short & (F.col("block_no") % 7 == 2), 14.0).otherwise(10.0)
    y = F.col("block_no").cast("double") * 10
    return each.select("doc_id", "page", "block_no", F.lit(0).alias("line_no"), F.lit(0).alias("span_no"), "text", size.alias("size"), F.lit(0.0).alias("x0"), y.alias("y0"), F.lit(100.0).alias("x1"), (y + 9).alias("y1"), F.lit(0).alias("kind"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table over part of every page."""
    pages = table(spark, sf_dir, "pages")
    rows = F.array(F.array(F.lit("a "), F.lit(None).cast("string")), F.array(F.col("url"), F.lit("2")))
    return pages.select(F.regexp_extract("url", HOST, 1).alias("doc_id"), F.col("page_id").alias("page"), rows.alias("rows"), F.lit(10.0).alias("x0"), F.lit(15.0).alias("y0"), F.lit(50.0).alias("x1"), F.lit(25.0).alias("y1"))


def font_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.heading_thresholds(layout.font_sizes(spans(spark, sf_dir)))


def header_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.repeated_headers(layout.text_blocks(spans(spark, sf_dir)))


def blocks_outside_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = layout.outside_tables(layout.text_blocks(spans(spark, sf_dir)), boxes(spark, sf_dir))
    return blocks.select("doc_id", "page", F.col("block_no").cast("long").alias("block_no"), F.length("raw_text").cast("long").alias("chars"))


def digital_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(spark, sf_dir)
    return layout.is_digital(found.select("doc_id", "text")).join(layout.page_count(found), "doc_id")


def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents from blocks and tables, without repeated headers."""
    done = layout.markdown(layout.page_blocks(spans(spark, sf_dir), boxes(spark, sf_dir)))
    return done.select("doc_id", F.size("pages").cast("long").alias("n_pages"), F.md5(F.encode("content", "UTF-8")).alias("content_md5"))


def table_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).select("page", layout.table_html(F.col("rows")).alias("html"))


_T = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_SPANS = f"""
el AS (SELECT regexp_extract(url, {quote(HOST)}, 1) AS doc_id, page_id AS page, regexp_extract_all(html, {quote(BETWEEN)}, 1) AS els FROM pages),
ek AS (SELECT doc_id, page, els, unnest(range(1, len(els) + 1)) AS k FROM el),
sp AS (SELECT doc_id, page, k - 1 AS block_no, {_T.format("els[k]")} AS raw, CASE WHEN k = 1 THEN 18.0 WHEN length(els[k]) < 60 AND (k - 1) % 3 = 1 THEN 12.0 WHEN length(els[k]) < 60 AND (k - 1) % 7 = 2 THEN 14.0 ELSE 10.0 END AS size FROM ek)"""
_BLOCKS = f"{_SPANS}, bl AS (SELECT * FROM sp WHERE raw <> '')"
# RE2's word boundaries are ASCII: words are taken out whole and numerals among them replaced
_NORM = _T.format("regexp_replace(array_to_string(list_transform(regexp_extract_all(regexp_replace(lower(raw), '\\d+', '#', 'g'), '[\\pL\\pN\\pM_]+|[^\\pL\\pN\\pM_]+'), lambda w: CASE WHEN regexp_full_match(w, '[ivxlcdm]{1,6}') THEN '#' ELSE w END), ''), '\\s+', ' ', 'g')")
_HEADERS = f"""
np AS (SELECT doc_id, count(DISTINCT page) AS n_pages FROM BLOCKS GROUP BY doc_id),
nm AS (SELECT doc_id, page, {_NORM} AS norm FROM BLOCKS),
hd AS (SELECT doc_id, norm FROM nm JOIN np USING (doc_id) WHERE length(norm) BETWEEN 1 AND 199 AND n_pages >= 3 GROUP BY doc_id, norm, n_pages HAVING count(DISTINCT page) >= greatest(3, 0.3 * n_pages))"""
_THRESHOLDS = """
fs AS (SELECT doc_id, size, count(*) AS n, min((page, block_no)) AS pos FROM sp GROUP BY doc_id, size),
bd AS (SELECT doc_id, arg_min(size, (-n, pos)) AS body FROM fs GROUP BY doc_id),
lg AS (SELECT bd.doc_id, body, coalesce(list_sort(list(size) FILTER (size > body), 'DESC'), []) AS l FROM bd JOIN fs USING (doc_id) GROUP BY bd.doc_id, body),
th AS (SELECT doc_id, CAST(body AS DOUBLE) AS body, CAST(coalesce(l[1], body) AS DOUBLE) AS h1, CAST(CASE WHEN len(l) >= 3 THEN l[2] ELSE coalesce(l[1], body) END AS DOUBLE) AS h2, CAST(CASE WHEN len(l) >= 3 THEN l[3] ELSE coalesce(l[2], l[1], body) END AS DOUBLE) AS h3 FROM lg)"""
_HTML = "'<table border=\"1\">' || chr(10) || '<tr><th>a</th><th></th></tr>' || chr(10) || '<tr><td>' || url || '</td><td>2</td></tr>' || chr(10) || '</table>'"

QUERIES = {
    "font_modes": font_modes,
    "header_footer": header_footer,
    "blocks_outside_tables": blocks_outside_tables,
    "digital_hosts": digital_hosts,
    "page_markdown": page_markdown,
    "table_html": table_html,
}

ORACLES = {
    "font_modes": f"WITH {_SPANS}, {_THRESHOLDS} SELECT doc_id, body, h1, h2, h3 FROM th",
    "header_footer": f"WITH {_BLOCKS}, {_HEADERS.replace('BLOCKS', 'bl')} SELECT doc_id, norm FROM hd",
    "blocks_outside_tables": f"WITH {_BLOCKS} SELECT doc_id, page, block_no, length(raw) AS chars FROM bl WHERE NOT (block_no * 10 < 25 AND 15 < block_no * 10 + 9)",
    "digital_hosts": f"WITH {_SPANS} SELECT doc_id, bool_or(length(raw) > 50) AS is_digital, count(DISTINCT page) AS num_pages FROM sp GROUP BY doc_id",
    "page_markdown": f"""
WITH {_SPANS}, {_THRESHOLDS},
tx AS (SELECT doc_id, page, block_no, raw, size FROM sp WHERE raw <> '' AND NOT (block_no * 10 < 25 AND 15 < block_no * 10 + 9)),
mk AS (SELECT doc_id, page, block_no, block_no * 10.0 AS y, raw, length(raw) < 200 AND size >= least(h1, h2, h3) AS head,
  CASE WHEN length(raw) >= 200 THEN '' WHEN size >= h1 THEN '# ' WHEN size >= h2 THEN '## ' WHEN size >= h3 THEN '### ' ELSE '' END || raw AS txt FROM tx JOIN th USING (doc_id)
  UNION ALL SELECT regexp_extract(url, {quote(HOST)}, 1), page_id, -1, 15.0, {_HTML}, false, {_HTML} FROM pages),
oc AS (SELECT *, head AND length(raw) <= 2 AS cap, row_number() OVER o AS pos FROM mk WINDOW o AS (PARTITION BY doc_id, page ORDER BY y, block_no)),
ol AS (SELECT *, pos - coalesce(max(CASE WHEN NOT cap THEN pos END) OVER (PARTITION BY doc_id, page ORDER BY pos), 0) AS r, max(pos) OVER (PARTITION BY doc_id, page) AS most FROM oc),
og AS (SELECT *, cap AND r % 2 = 1 AND pos < most AS gives FROM ol),
ot AS (SELECT *, coalesce(lag(gives) OVER w, false) AS takes, lag(raw) OVER w AS before FROM og WINDOW w AS (PARTITION BY doc_id, page ORDER BY pos)),
bk AS (SELECT doc_id, page, block_no, y, CASE WHEN takes THEN before || ltrim(raw) ELSE raw END AS raw, CASE WHEN takes THEN before || ltrim(raw) ELSE txt END AS txt FROM ot WHERE NOT gives),
{_HEADERS.replace('BLOCKS', 'bk')},
kp AS (SELECT * FROM bk WHERE (doc_id, {_NORM}) NOT IN (SELECT (doc_id, norm) FROM hd)),
pg AS (SELECT doc_id, page, string_agg(txt, chr(10) || chr(10) ORDER BY y, block_no) AS t FROM kp GROUP BY doc_id, page)
SELECT doc_id, count(*) AS n_pages, md5(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS content_md5 FROM pg GROUP BY doc_id""",
    "table_html": f"SELECT page_id AS page, {_HTML} AS html FROM pages",
}
