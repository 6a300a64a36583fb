"""Secret scans over an incremental blob ledger, in DataFrame functions alone.

Every version of every path is addressed by the SHA-256 of its text (its *blob*). The ledger holds the pairs of blob
and rule version that were scanned, and what was found in them. A scan takes one row of each blob that has rules left
to run, runs those rules, adds to the ledger, and joins findings back to all paths by the blob. Of the ledger's history
only what concerns the blobs at hand is joined.

The ledger is a folder of batches, one a scan: ``findings/<batch>`` is written first, and the batch counts from when
``scanned/<batch>`` is there as a whole. A scan that breaks off leaves nothing that counts; two at the same time may scan
the same pairs, whose findings are then read once.

Offsets are code points and are counted without regular expressions that return them: a rule's matches and the text
between them alternate, so running sums of their lengths, taken in rows instead of growing arrays, give each start.

Null texts are empty. Repeated rows and copies share a blob and are scanned once; each keeps its row in the result.
Empty tables give empty results; columns other than the path's and the text's are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioquest.llm import common


def _either(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A finding is a match whose ``group`` has at least ``least`` characters. Change ``version`` with the pattern."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
BASE = (
    Rule("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
RULES = (
    *BASE,
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # first parts are bounded, so that long runs of their characters aren't searched again from each of their places
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{1,1000}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, 2),
    Rule("login", r"[a-z][a-z0-9+]{0,30}://[^\s/:@]+:[^\s/:@]+@", version=2),
)
#: Characters of a text that are handled at a time when parts of it are put together.
PART = 4096
#: No text without a run that long has a finding of the rule; what the full pattern returns is not changed by it.
HINTS = {"hex": "[0-9a-f]{32}", "access": "AKIA[A-Z0-9]{12}", "login": "://", "jwt": r"eyJ[A-Za-z0-9_-]{1,1000}\."}


def versions(docs: DataFrame, path_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The path's columns, ``blob`` and ``body``."""
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(*[F.col(f"`{c}`") for c in path_cols], F.sha2(body, 256).alias("blob"), body.alias("body"))


def _matches(rule: Rule, rank: int) -> Column:
    """For each match of the rule, and for the text after the last: its place in order, the length of the text before it, its own, and whether it counts."""
    body, pattern = F.col("body"), F.lit(rule.pattern)
    gaps = F.split(body, rule.pattern, -1)
    whole = F.regexp_extract_all(body, pattern, F.lit(0))
    value = F.regexp_extract_all(body, pattern, F.lit(rule.group)) if rule.group else whole
    entry = F.transform(
        F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(value, lambda v: F.length(v) >= rule.least).alias("ok")),
        lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("pos"), x["gap"].alias("gap"), F.coalesce(x["size"], F.lit(0)).alias("size"), F.coalesce(x["ok"], F.lit(False)).alias("ok")),
    )
    wanted = F.array_contains("todo", rule.name) & F.when(F.lit(rule.kind in HINTS), body.rlike(HINTS.get(rule.kind, ""))).otherwise(body.rlike(rule.pattern))
    empty = F.array().cast("array<struct<rank:int,pos:int,gap:int,size:int,ok:boolean>>")
    return F.when(wanted, entry).otherwise(empty)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob, rank, start, end) in the rows (blob, todo, body) by the rules that ``todo`` names; ends are exclusive."""
    rows = blobs.select("blob", F.explode(F.concat(*[_matches(r, k) for k, r in enumerate(rules)])).alias("m")).select("blob", "m.*").distinct()
    upto = Window.partitionBy("blob", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ended = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    return ended.where("ok").select("blob", "rank", (F.col("end") - F.col("size")).alias("start"), "end")


def unseen(seen_versions: DataFrame, scanned: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row (blob, path, todo) for each blob with rules that the ledger's ``scanned`` (blob, rules) doesn't have."""
    all_rules = F.array(*[F.lit(r.name) for r in rules])
    blobs = seen_versions.groupBy("blob").agg(F.min("path").alias("path"))
    if scanned is None:
        return blobs.withColumn("todo", all_rules)
    known = scanned.join(seen_versions.select("blob").distinct(), "blob", "left_semi").groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
    left = blobs.join(known, "blob", "left").withColumn("todo", F.array_except(all_rules, F.coalesce("known", F.array().cast("array<string>"))))
    return left.where(F.size("todo") > 0).drop("known")


def new_findings(keyed: DataFrame, work: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of what is unseen: rows (path, blob, body) of which ``work`` (blob, path, todo) names one for each blob."""
    todo = work.select(F.col("blob").alias("one_blob"), F.col("path").alias("one_path"), "todo")
    texts = keyed.join(todo.hint("shuffle_hash"), (F.col("blob") == F.col("one_blob")) & F.col("path").eqNullSafe(F.col("one_path"))).select("blob", "todo", "body")
    return scan_blobs(texts, rules)


def batches(spark: SparkSession, ledger: str) -> list[str]:
    """The names of the ledger's whole batches."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/scanned")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/scanned/{n}/_SUCCESS")))


def findings(keyed: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, rank, start, end of all findings in rows (path, blob, body). With a ledger, only unseen pairs of blob and rule version are scanned, what they hold is added, and all findings come from it."""
    if ledger is None:
        return new_findings(keyed, unseen(keyed.select("path", "blob"), None, rules), rules)
    spark = keyed.sparkSession
    before = batches(spark, ledger)
    history = lambda table: spark.read.parquet(*[f"{ledger}/{table}/{b}" for b in before])
    work = common.checkpoint(unseen(keyed.select("path", "blob"), history("scanned") if before else None, rules))
    batch = uuid.uuid4().hex
    named = F.array(*[F.lit(r.name) for r in rules])
    found = new_findings(keyed, work, rules).select("blob", F.element_at(named, F.col("rank") + 1).alias("rule"), "start", "end")
    found.write.parquet(f"{ledger}/findings/{batch}")
    work.select("blob", F.col("todo").alias("rules")).write.parquet(f"{ledger}/scanned/{batch}")
    known = spark.read.parquet(f"{ledger}/findings/{batch}")
    if before:
        old = history("findings").where(F.col("rule").isin([r.name for r in rules]))
        known = known.unionByName(old.join(keyed.select("blob").distinct(), "blob", "left_semi")).distinct()
    ranks = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    return known.select("blob", ranks[F.col("rule")].alias("rank"), "start", "end")


def by_path(keyed: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of (path, blob) with its blob's findings, an array sorted by start and rule; empty where there are none."""
    kinds = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(k), F.lit(r.kind))])
    listed = findings.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("found"))
    named = listed.select("blob", F.transform("found", lambda x: F.struct(kinds[x["rank"]].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return keyed.select("path", "blob").join(named, "blob", "left").select("path", "blob", F.coalesce("findings", none).alias("findings"))


def scan(docs: DataFrame, ledger: str | None = None, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob, findings for every row, through the ledger in a folder if one is named."""
    keyed = versions(docs, (path_col,), text_col).withColumnRenamed(path_col, "path")
    return by_path(keyed, findings(keyed, ledger, rules), rules)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """The rows with each stretch of overlapping or touching findings in ``text`` replaced by the mark, and ``n_chars`` counted anew where there is one.

    A text with findings is cut into parts of ``PART`` characters once; what stays between two stretches is taken from
    the parts it lies in, so the work follows the text's length whatever the number of findings.
    """
    keyed = versions(docs).withColumnRenamed("doc_id", "path")
    rows = findings(keyed, ledger, rules).select("blob", F.col("start").alias("s"), F.col("end").alias("e"))
    order = Window.partitionBy("blob").orderBy("s", "e")
    fresh = rows.withColumn("fresh", F.coalesce(F.col("s") > F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)))
    runs = fresh.withColumn("run", F.sum(F.col("fresh").cast("int")).over(order)).groupBy("blob", "run").agg(F.min("s").cast("int").alias("s"), F.max("e").cast("int").alias("e"))
    # the text kept before each run, and after the last
    runs = runs.withColumn("from", F.coalesce(F.lag("e").over(Window.partitionBy("blob").orderBy("s")), F.lit(0)))
    cuts = runs.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("s", "e", "from"))).alias("cuts"))
    whole = docs.select(common.whole_row(docs), F.sha2(F.coalesce("text", F.lit("")), 256).alias("own_blob"))
    text = F.col("row.text")
    joined = whole.join(cuts, F.col("own_blob") == F.col("blob"), "left")
    joined = joined.withColumn("parts", F.when(F.col("cuts").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))))
    at = lambda x: F.floor(x / PART).cast("int")

    def between(a: Column, b: Column) -> Column:
        parts = F.array_join(F.slice("parts", at(a) + 1, F.greatest(at(b) - at(a) + 1, F.lit(0))), "")
        return F.substring(parts, (a - at(a) * PART + 1).cast("int"), (b - a).cast("int"))

    kept = F.transform("cuts", lambda c: F.concat(between(c["from"], c["s"]), F.lit(mark)))
    clean = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.array_join(kept, ""), between(F.element_at("cuts", -1)["e"], F.length(text))))
    return common.with_text(joined, docs, clean)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table through a ledger of its own, begun in the shared folder."""
    rows = scan(common.documents(spark, sf_dir), f"{common.shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}")
    base = F.filter("findings", lambda x: x["kind"].isin([r.kind for r in BASE]))
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(F.col("path").alias("doc_id"), *[count(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def _oracle() -> str:
    def quote(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = [
        f"SELECT doc_id, {k} AS r, {quote(rule.kind)} AS kind, {rule.least} AS least, string_split_regex(body, {quote(rule.pattern)}) AS gaps, "
        f"regexp_extract_all(body, {quote(rule.pattern)}, 0) AS whole, regexp_extract_all(body, {quote(rule.pattern)}, {rule.group}) AS val FROM d"
        for k, rule in enumerate(RULES)
    ]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT doc_id, r, kind, least, unnest(range(1, len(whole) + 1)) AS pos, gaps, whole, val FROM m WHERE len(whole) > 0),
l AS (SELECT doc_id, r, kind, pos, length(gaps[pos]) AS gap, length(whole[pos]) AS size, length(val[pos]) >= least AS ok FROM e),
p AS (SELECT doc_id, r, kind, ok, size, sum(gap + size) OVER (PARTITION BY doc_id, r ORDER BY pos) AS stop FROM l),
f AS (SELECT doc_id, r, kind, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM p WHERE ok),
g AS (SELECT doc_id, count(*) FILTER (r = 0) AS n_assign, count(*) FILTER (r = 1) AS n_access, count(*) FILTER (r = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r) FILTER (r < 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""


QUERIES = {"op1_secret_scan": op1_secret_scan}
ORACLES = {"op1_secret_scan": _oracle()}
