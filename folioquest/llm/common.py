"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; null texts are empty. Whatever other columns exist are left behind, so their names can't clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(df: DataFrame):
    """All columns as one value, ``row``: none of them can then be taken for one of ours, whatever its name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def with_text(rows: DataFrame, docs: DataFrame, text) -> DataFrame:
    """The columns of docs out of ``row``, with another text, and ``n_chars`` counted anew where there is one."""
    new = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return rows.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; one of our own only where none is named and all run on one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioquest-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def row_map(df: DataFrame, make: Callable[[], Callable[[int | None, str], tuple]], schema: str) -> DataFrame:
    """One output row per (doc_id, text) row. ``make`` builds the row function once per task."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                rows = [f(i, t) for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)]
                cols = list(zip(*rows, strict=True)) if rows else [[] for _ in target]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, target, strict=True)], schema=target)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def doc_crc(doc_id: int | None) -> int:
    """crc32 of the id as text (null: of the empty text), unsigned."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_column(col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
