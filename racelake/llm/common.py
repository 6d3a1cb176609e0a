"""Helpers shared by the operators: shared scratch tables, bounded sub-batches."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a Python task; bounds a worker's memory.
SUB_BATCH_BYTES = 12 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master (tests) may run without that setting; a scratch folder
    is made for it then.  On a cluster a machine-local folder would be invisible
    to the other machines, so the call fails instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def store_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small file on whatever store ``path`` names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(data)
    out.close()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, so that their Python
    workers import the operators whether or not they share the driver's folders."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{shared_dir(spark)}/llm/{app}/{root.name}-{uuid.uuid4().hex}.zip"
    store_bytes(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for one written intermediate table."""
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage at a
    table that survives the loss of any executor and is evaluated once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(documents: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")):
    """``documents`` with every column but ``keep`` under a name of our own, so that no
    name clashes with an operator's columns; and the way back to the given names."""
    given = documents.columns
    ours = [c if c in keep else f"x{i}" for i, c in enumerate(given)]
    return documents.toDF(*ours), lambda df: df.select(*ours).toDF(*given)


def row_key(doc_id: str = "doc_id", text: str = "text") -> list:
    """Columns that tell rows apart up to exact repeats: the id and a 64-bit hash
    of the text.  Rows that agree in both are copies of one row and always get
    the same result, so joining back on these columns is safe without a row id."""
    return [F.col(doc_id).cast("long").alias("__doc"),
            F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("__tx")]


def release() -> None:
    """Give back what a finished task's arrays have left in Arrow's memory pool: a
    worker process lives on and serves other operators."""
    pa.default_memory_pool().release_unused()


def sub_batches(batch: pa.RecordBatch, column: int, limit: int = SUB_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into slices of about ``limit`` bytes of text.

    A single text above the limit is a slice of its own and stays whole.
    """
    col = batch.column(column)
    n = batch.num_rows
    if not n:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    lo = acc = 0
    for i, size in enumerate(sizes):
        if acc and acc + size > limit:
            yield batch.slice(lo, i - lo)
            lo, acc = i, 0
        acc += size
    yield batch.slice(lo, n - lo)


import pyarrow.compute  # noqa: E402,F401  (binds pa.compute)
