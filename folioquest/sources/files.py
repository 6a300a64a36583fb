"""Folders of .txt, .md and .pdf files to documents.

The driver lists names through Hadoop's file system, so any store that Spark can read will do, and keeps the order by
path parts. Contents are read on the executors. Spark's file reader leaves out files without bytes and names that begin
with ``_`` or ``.``; the first need no reading, and the others, which are rare, are read one by one through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.functions import storage, text
from folioquest.operators import layout
from folioquest.sources import pdf

SUFFIXES = (".txt", ".md", ".pdf")
META = "struct<filename:string,size:bigint,num_pages:int,pdf_method:string,cached:boolean>"
DOCUMENT = f"doc_id long, content string, source string, doc_type string, metadata {META}, pages array<string>, error string"


def decode(data: bytes) -> str:
    """UTF-8 without what can't be decoded; all line ends become line feeds."""
    return data.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")


def suffix(name: str) -> str:
    dot = name.rfind(".")
    return name[dot:].lower() if dot > 0 else ""


def stem(name: str) -> str:
    dot = name.rfind(".")
    return name[:dot] if dot > 0 else name


def listing(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(path below the folder, whole path, bytes) of the supported files, sorted by the parts of the path."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        raise FileNotFoundError(f"no such folder: {folder}")
    base, found = fs.getFileStatus(top).getPath().toString().rstrip("/"), []
    walk = fs.listFiles(top, True)
    while walk.hasNext():
        status = walk.next()
        path = status.getPath().toString()
        if suffix(path.rsplit("/", 1)[-1]) in SUFFIXES:
            found.append((path[len(base) + 1 :], path, status.getLen()))
    return sorted(found, key=lambda f: f[0].split("/"))


def _read_on_driver(spark: SparkSession, path: str) -> bytes:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_bytes(spark: SparkSession, files: list[tuple[str, str, int]]) -> DataFrame:
    """doc_id, rel, data."""
    rows = [(k, rel, path, n, any(p[0] in "_." for p in rel.split("/"))) for k, (rel, path, n) in enumerate(files)]
    direct = [(k, rel, b"" if not n else _read_on_driver(spark, path)) for k, rel, path, n, hidden in rows if hidden or not n]
    out = spark.createDataFrame(direct, "doc_id long, rel string, data binary")
    plain = {path: (k, rel) for k, rel, path, n, hidden in rows if n and not hidden}
    if plain:
        names = spark.createDataFrame([(k, rel, path) for path, (k, rel) in plain.items()], "doc_id long, rel string, path string")
        # the reader writes local paths with other slashes than the lister
        tidy = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
        read = spark.read.format("binaryFile").load(list(plain)).select(tidy("path").alias("path"), F.col("content").alias("data"))
        out = out.unionByName(names.withColumn("path", tidy("path")).join(read, "path").select("doc_id", "rel", "data"))
    return out


class NoOcr:
    """Stands where no OCR is installed. An OCR takes a file's bytes, a language and whether to look for tables, and returns the pages in Markdown."""

    def __call__(self, data: bytes, lang: str, tables: bool) -> list[str]:
        raise ImportError("a file without a text layer needs OCR: pass ocr to load_documents")


SPANS = "doc_id long, page int, block_no int, line_no int, span_no int, text string, size double, x0 double, y0 double, x1 double, y1 double, kind int, error string"
_SPANS_ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.int32()) for c in ("page", "block_no", "line_no", "span_no")], ("text", pa.string()), *[(c, pa.float64()) for c in ("size", "x0", "y0", "x1", "y1")], ("kind", pa.int32()), ("error", pa.string())])


def pdf_spans(files: DataFrame) -> DataFrame:
    """The spans in the rows (doc_id, data), one more row for each page (without a text), and one with the error for a file that can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist(), strict=True):
                try:
                    rows = [{"doc_id": doc_id, **s} for k, page in enumerate(pdf.read(bytes(data))) for s in [{"page": k}, *page]]
                except Exception as e:
                    rows = [{"doc_id": doc_id, "error": f"{type(e).__name__}: {e}"}]
                yield pa.RecordBatch.from_pylist(rows, schema=_SPANS_ARROW)

    return files.select("doc_id", "data").mapInArrow(run, SPANS)


TEXTS = "doc_id long, content string, pages array<string>, num_pages int, pdf_method string, error string"


def read_pdfs(files: DataFrame, ocr: Callable[[bytes, str, bool], list[str]] | None = None, lang: str = "en", tables: bool = True) -> DataFrame:
    """TEXTS of the rows (doc_id, data). A file some page of which has text goes by its text layer and the layout rules, any other through OCR."""
    spans = storage.checkpoint(pdf_spans(files))
    known = spans.where("error is null")
    page_texts = known.groupBy("doc_id", "page").agg(F.coalesce(F.concat_ws(" ", F.collect_list("text")), F.lit("")).alias("text"))
    n_pages = layout.page_count(known).withColumn("num_pages", F.col("num_pages").cast("int"))
    digital = layout.is_digital(page_texts).where("is_digital").select("doc_id")
    texts = layout.markdown(layout.page_blocks(known.where("text is not null").join(digital, "doc_id", "left_semi")))
    layer = texts.join(n_pages, "doc_id").select("doc_id", "content", "pages", "num_pages", F.lit("text layer").alias("pdf_method"), F.lit(None).cast("string").alias("error"))
    reader = ocr or NoOcr()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("content", pa.string()), ("pages", pa.list_(pa.string())), ("num_pages", pa.int32()), ("pdf_method", pa.string()), ("error", pa.string())])
        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist(), strict=True):
                try:
                    pages = reader(bytes(data), lang, tables)
                    row = {"doc_id": doc_id, "content": "\n\n".join(p for p in pages if p), "pages": pages, "num_pages": len(pages), "pdf_method": "ocr"}
                except Exception as e:
                    row = {"doc_id": doc_id, "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    broken = spans.where("error is not null").select("doc_id", "error")
    failed = broken.select("doc_id", F.lit(None).cast("string").alias("content"), F.lit(None).cast("array<string>").alias("pages"), F.lit(None).cast("int").alias("num_pages"), F.lit(None).cast("string").alias("pdf_method"), "error")
    scanned = files.select("doc_id", "data").join(digital.unionByName(broken.select("doc_id")), "doc_id", "left_anti").mapInArrow(scan, TEXTS)
    return layer.unionByName(failed).unionByName(scanned)


def load_documents(spark: SparkSession, folder: str, pdf_reader: Callable[[bytes], dict] | None = None, cache_dir: str | None = None, ocr: Callable[[bytes, str, bool], list[str]] | None = None, ocr_lang: str = "en", tables: bool = True) -> DataFrame:
    """DOCUMENT rows; a file that can't be read has its ``error`` and no content instead of stopping the load.

    PDF files go by their text layer, or through ``ocr`` without one; a ``pdf_reader``, which takes a file's bytes and
    returns content, pages, num_pages and pdf_method, replaces both. A blank or missing ``<stem>.md`` in the cache folder is
    asked for again; texts that were read are put there.
    """
    files = listing(spark, folder)
    any_pdf = any(suffix(rel) == ".pdf" for rel, _, _ in files)
    cache = _cached(spark, cache_dir) if cache_dir else spark.createDataFrame([], "stem string, cached_content string")
    keyed = read_bytes(spark, files).withColumn("stem", F.regexp_replace(F.regexp_extract("rel", "([^/]*)$", 1), r"(?<=.)\.[^.]+$", "")).join(cache, "stem", "left")
    if any_pdf and pdf_reader is None:
        todo = keyed.where(F.lower("rel").endswith(".pdf") & F.col("cached_content").isNull())
        read = read_pdfs(todo, ocr, ocr_lang, tables)
    else:
        read = spark.createDataFrame([], TEXTS)
    rows = keyed.join(read.select("doc_id", F.struct("content", "pages", "num_pages", "pdf_method", "error").alias("got")), "doc_id", "left")

    def parse(frames):
        for frame in frames:
            out = []
            for doc_id, rel, data, known, got in zip(frame.doc_id, frame.rel, frame.data, frame.cached_content, frame.got, strict=True):
                name = rel.rsplit("/", 1)[-1]
                kind = suffix(name)[1:]
                meta = {"filename": name, "size": None, "num_pages": None, "pdf_method": None, "cached": False}
                content, pages, error = None, [], None
                try:
                    if kind != "pdf":
                        content = decode(bytes(data))
                        pages = [content] if content else []
                    elif isinstance(known, str):
                        content, meta["cached"] = known, True
                    else:
                        got = pdf_reader(bytes(data)) if pdf_reader else got if isinstance(got, dict) else {"error": "no text was found"}
                        if got.get("error"):
                            raise RuntimeError(got["error"])
                        content, pages = got["content"], list(got["pages"]) if got.get("pages") is not None else []
                        meta |= {"num_pages": got.get("num_pages"), "pdf_method": got.get("pdf_method")}
                    meta["size"] = len(content)
                except Exception as e:
                    content, error = None, str(e) if isinstance(e, RuntimeError) else f"{type(e).__name__}: {e}"
                out.append({"doc_id": doc_id, "content": content, "source": name, "doc_type": kind, "metadata": meta, "pages": pages, "error": error})
            yield pd.DataFrame(out, columns=["doc_id", "content", "source", "doc_type", "metadata", "pages", "error"])

    docs = rows.select("doc_id", "rel", "data", "cached_content", "got").mapInPandas(parse, DOCUMENT)
    if cache_dir and any_pdf:
        _fill_cache(spark, docs.where("doc_type = 'pdf' and error is null and not metadata.cached"), cache_dir)
    return docs


def _cached(spark: SparkSession, folder: str) -> DataFrame:
    try:
        files = [f for f in listing(spark, folder) if suffix(f[0]) == ".md" and "/" not in f[0]]
    except FileNotFoundError:
        files = []
    if not files:
        return spark.createDataFrame([], "stem string, cached_content string")
    decoded = F.pandas_udf(lambda s: s.map(lambda b: decode(bytes(b))), "string")
    texts = lambda found: read_bytes(spark, found).select("rel", F.regexp_replace("rel", r"(?<=.)\.[^.]+$", "").alias("stem"), decoded("data").alias("cached_content"))
    blank = {r["rel"] for r in texts(files).where(text.strip("cached_content") == "").select("rel").collect()}  # no answers; they go
    for rel, path, _ in files:
        if rel in blank:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)
    left = [f for f in files if f[0] not in blank]
    return texts(left).select("stem", "cached_content") if left else spark.createDataFrame([], "stem string, cached_content string")


def _fill_cache(spark: SparkSession, docs: DataFrame, folder: str) -> None:
    """One file a document, written one by one as they come."""
    jvm = spark._jvm
    for r in docs.select("source", "content").toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{stem(r['source'])}.md")
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        stream.write(bytearray(r["content"].encode()))
        stream.close()
