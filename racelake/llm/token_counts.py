"""op4: token counts by source, language and tokenizer version, kept up to date
by signed deltas.

A batch is a table of events (doc_id, source, lang, version, op, n_tokens, text
not needed) with op ``insert``, ``delete`` or ``revise``.  ``apply_batch`` looks up
the committed counts of the documents it names, writes the signed differences
per (source, lang, version) and the new counts per document, and commits.  Totals
are the sum of all committed differences: no batch reads any text again.

The counts per document (the ledger) are split by a hash of the doc_id; a batch reads
only the splits that hold its documents.  ``compact`` folds committed differences into
one snapshot of totals, and the ledger's rows into one snapshot with a row for each
document and version.

Commits are idempotent: a batch writes to folders of its own name (a rerun after a
failure overwrites them) and counts only from the moment its marker exists; a batch
whose marker exists is skipped.  So with snapshots: one counts, and covers the batches up
to its number, only from the moment its marker exists; what an interrupted ``compact``
left is never read, and written over by the next.  One writer at a time, readers at any.

Defined cases: an insert of a known document replaces its count; a delete or
revision of an unknown one changes nothing.  Several events of one batch for
the same document and version: delete wins over revise over insert, then the largest
count, source and language.  A null doc_id can't be referred to again: such inserts
each add, other events change nothing.  Null source or language is a group of
its own; null text has no tokens.  Empty batches commit without effect.  A hot
source is summed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sub_batches, written
from .tokenizing import CACHE_WORDS, encoder

KEYS = ["source", "lang", "version"]
DELTAS = "source string, lang string, version string, n_docs long, n_tokens long"
LEDGER = "doc_id long, version string, source string, lang string, n_tokens long, batch_no long, split int"
#: Splits of the ledger, by a hash of the doc_id.
SPLITS = 32


def count_tokens(documents: DataFrame, vocabularies: dict[str, str]) -> DataFrame:
    """doc_id, source, lang, version, n_tokens: a row for each document and version."""
    limit = CACHE_WORDS // (2 * len(vocabularies))  # the tables of all versions share the memory

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sub_batches(batch, 3, 6 << 20):
                for version, path in vocabularies.items():
                    _, counts = encoder(path, limit).encode_many(piece.column(3))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0), piece.column(1), piece.column(2), pa.array([version] * piece.num_rows), pa.array(counts)],
                        names=["doc_id", "source", "lang", "version", "n_tokens"])
    rows = documents.select(F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("source", "lang", "text")])
    return rows.mapInArrow(run, "doc_id long, source string, lang string, version string, n_tokens long")


def _split():
    return F.pmod(F.xxhash64("doc_id"), F.lit(SPLITS)).cast("int")


class Rollup:
    """Totals in a folder of a store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._fs = self._jvm.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # commits -----------------------------------------------------------------
    def _names(self, folder: str) -> list[str]:
        at = self._jvm.Path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def committed(self) -> dict[str, int]:
        """Batch name -> commit number; one small marker file a batch."""
        out = {}
        for name in self._names("commits"):
            number, _, batch = name.partition("-")
            out[batch] = int(number)
        return out

    def _mark(self, batch: str, number: int) -> None:
        self._fs.create(self._jvm.Path(f"{self.path}/commits/{number:012d}-{batch}"), False).close()

    # tables ------------------------------------------------------------------
    def _read(self, folder: str, names, schema: str) -> DataFrame:
        paths = [f"{self.path}/{folder}/{n}" for n in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def snapshot(self) -> int:
        """Number of the last published snapshot (0: none); it holds all batches up to it."""
        return max(map(int, self._names("published")), default=0)

    def _ledger_rows(self, splits: list[int] | None = None) -> DataFrame:
        """Committed rows of the ledger, of all splits or the given ones."""
        last = self.snapshot()
        live = [b for b, n in self.committed().items() if n > last]
        if live:  # the batch is a partition column too: folders without a marker are not opened
            rows = self.spark.read.schema(LEDGER + ", batch string").parquet(f"{self.path}/ledger").where(F.col("batch").isin(live)).drop("batch")
        else:
            rows = self._read("ledger", [], LEDGER)
        if last:
            rows = rows.unionByName(self._read("ledger-snapshots", [f"{last:012d}"], LEDGER))
        return rows if splits is None else rows.where(F.col("split").isin(splits))  # a partition column: prunes folders

    def ledger(self) -> DataFrame:
        """Committed counts: the last row of each document and version, if not deleted."""
        last = self._ledger_rows().groupBy("doc_id", "version").agg(
            F.max_by(F.struct("source", "lang", "n_tokens", "batch_no"), "batch_no").alias("x"))
        return last.select("doc_id", "version", "x.*").where("n_tokens is not null")

    def _write_ledger(self, rows: DataFrame, folder: str) -> None:
        rows = rows.withColumn("split", _split())
        (rows.hint("rebalance", "split").sortWithinPartitions("split").write.mode("overwrite")
         .partitionBy("split").parquet(f"{self.path}/{folder}"))

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens of the groups that hold documents."""
        last = self.snapshot()
        rows = self._read("deltas", [b for b, n in self.committed().items() if n > last], DELTAS)
        if last:
            rows = rows.unionByName(self._read("snapshots", [f"{last:012d}"], DELTAS))
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0")

    def compact(self) -> None:
        """Fold all committed differences and the ledger into one snapshot, then publish it."""
        number = max(self.committed().values(), default=0)
        if number > self.snapshot():
            self.totals().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/{number:012d}")
            self._write_ledger(self.ledger(), f"ledger-snapshots/{number:012d}")
            self._fs.create(self._jvm.Path(f"{self.path}/published/{number:012d}"), False).close()

    # batches -----------------------------------------------------------------
    def apply_batch(self, batch: str, events: DataFrame) -> bool:
        """Apply ``events`` once; False if the batch was committed before."""
        done = self.committed()
        if batch in done:
            return False
        number = max(done.values(), default=0) + 1
        events = written(events.select("doc_id", "source", "lang", "version", "op", F.col("n_tokens").cast("long").alias("n_tokens")), "events")
        nameless = events.where(F.col("doc_id").isNull() & (F.col("op") == "insert"))
        rank = F.when(F.col("op") == "delete", 2).when(F.col("op") == "revise", 1).otherwise(0)
        named = (events.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "version")
                 .agg(F.max(F.struct(rank.alias("rank"), "n_tokens", "source", "lang")).alias("new")))
        if done:
            keys = named.select("doc_id", "version")
            splits = [r["split"] for r in keys.select(_split().alias("split")).distinct().collect()]  # at most SPLITS
            rows = self._ledger_rows(splits).join(keys, ["doc_id", "version"], "left_semi")
            old = rows.groupBy("doc_id", "version").agg(F.max_by(F.struct("source", "lang", "n_tokens"), "batch_no").alias("old"))
            both = named.join(old.where("old.n_tokens is not null"), ["doc_id", "version"], "left")
        else:
            both = named.withColumn("old", F.lit(None).cast("struct<source:string,lang:string,n_tokens:long>"))
        known = F.col("old").isNotNull()
        both = both.where(known | (F.col("new.rank") == 0))  # the rest refers to unknown documents
        both = written(both.withColumn("gone", F.col("new.rank") == 2), "changes")
        minus = both.where(known).select(
            F.col("old.source").alias("source"), F.col("old.lang").alias("lang"), "version",
            F.lit(-1).cast("long").alias("n_docs"), (-F.col("old.n_tokens")).alias("n_tokens"))
        plus = both.where(~F.col("gone")).select(
            F.col("new.source").alias("source"), F.col("new.lang").alias("lang"), "version",
            F.lit(1).cast("long").alias("n_docs"), F.col("new.n_tokens").alias("n_tokens"))
        extra = nameless.select("source", "lang", "version", F.lit(1).cast("long").alias("n_docs"), "n_tokens")
        deltas = (minus.unionByName(plus).unionByName(extra).groupBy(*KEYS)
                  .agg(F.sum("n_docs").alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens")))
        count = F.when(~F.col("gone"), F.coalesce(F.col("new.n_tokens"), F.lit(0)))
        ledger = both.select("doc_id", "version", F.col("new.source").alias("source"), F.col("new.lang").alias("lang"),
                             count.cast("long").alias("n_tokens"), F.lit(number).cast("long").alias("batch_no"))
        deltas.write.mode("overwrite").parquet(f"{self.path}/deltas/{batch}")
        self._write_ledger(ledger, f"ledger/batch={batch}")
        self._mark(batch, number)
        return True


def corpus_rollup(documents: DataFrame, labels: DataFrame, vocabularies: dict[str, str], path: str) -> DataFrame:
    """Totals after a load, a removal and a revision of the corpus.

    load: all documents; removal: those labelled toxic; revision: documents with a
    repeated line, counted again with each line once.  The removal is sent a
    second time, which changes nothing.
    """
    rollup = Rollup(documents.sparkSession, path)
    rollup.apply_batch("load", count_tokens(documents, vocabularies).withColumn("op", F.lit("insert")))
    versions = F.explode(F.array(*[F.lit(v) for v in vocabularies])).alias("version")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    none = F.lit(None).cast("string")
    removal = toxic.select("doc_id", none.alias("source"), none.alias("lang"), versions, F.lit("delete").alias("op"),
                           F.lit(None).cast("long").alias("n_tokens"))
    rollup.apply_batch("removal", removal)
    lines = F.split("text", "\n")
    repeated = documents.where(F.size(F.array_distinct(lines)) < F.size(lines))
    once = repeated.withColumn("text", F.array_join(F.array_distinct(F.split("text", "\n")), "\n"))
    rollup.apply_batch("revision", count_tokens(once, vocabularies).withColumn("op", F.lit("revise")))
    rollup.apply_batch("removal", removal)
    rollup.compact()
    return rollup.totals()
