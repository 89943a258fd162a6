"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch of changes inserts, revises or deletes the token count of a document
under a tokenizer version. A commit compares it with the counts that earlier
batches left, writes these differences as signed totals, and marks the batch as
done. A batch that is committed again changes nothing; one that broke off is
written anew from the same earlier state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
CHANGES = "op string, seq bigint, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint"


@dataclass
class RollupStore:
    """Tables below ``root``: ledger (a document's counts), deltas (signed totals), commits."""

    spark: SparkSession
    root: str

    def _path(self, table: str, batch: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{table}"
        return base if batch is None else f"{base}/batch={batch}"

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: int) -> bool:
        return self._exists(f"{self._path('commits', batch)}/_SUCCESS")

    def _done(self, table: str) -> DataFrame | None:
        """Rows of a table that belong to committed batches."""
        if not self._exists(self._path("commits")):
            return None
        done = self.spark.read.parquet(self._path("commits")).select("batch").distinct()
        rows = self.spark.read.option("mergeSchema", "false").parquet(self._path(table))
        return rows.join(done, "batch", "left_semi")

    def state(
        self, before: int | None = None, of: DataFrame | None = None
    ) -> DataFrame | None:
        """(doc_id, tokenizer, source, lang, n_tokens) that stand, before a batch if named,
        of the documents in ``of`` (doc_id, tokenizer) if given."""
        ledger = self._done("ledger")
        if ledger is None:
            return None
        if before is not None:
            ledger = ledger.filter(F.col("batch") < before)
        if of is not None:  # what doesn't change needn't be grouped
            ledger = ledger.join(of, ["doc_id", "tokenizer"], "left_semi")
        last = ledger.groupBy("doc_id", "tokenizer").agg(
            F.max(F.struct("batch", "deleted", "source", "lang", "n_tokens")).alias("last")
        )
        return last.filter("not last.deleted").select(
            "doc_id", "tokenizer", "last.source", "last.lang", "last.n_tokens"
        )

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch; False if it had been applied. Batches go in ascending order: one
        below the newest that is committed is refused, as is an ``op`` of another name.

        ``changes`` has the columns of ``CHANGES``. ``insert`` and ``revise`` both
        set the count (an insert of what stands is a revision, a revision of what
        doesn't an insert); ``delete`` removes it, if it stands. Of several
        changes of a document in a batch the one with the largest seq counts,
        then the largest count. Rows without doc_id, tokenizer or op, and counts
        of null, are left out; null source and lang are groups of their own.
        """
        if self.committed(batch):
            return False
        if self._exists(self._path("commits")):
            newest = self.spark.read.parquet(self._path("commits")).agg(F.max("batch")).first()[0]
            if newest is not None and batch < newest:
                raise ValueError(f"batch {batch} comes after batch {newest}")
        unknown = F.raise_error(F.concat(F.lit("unknown op "), F.col("op")))
        valid = changes.dropna(subset=["doc_id", "tokenizer", "op"]).withColumn(
            "op", F.when(F.col("op").isin("insert", "revise", "delete"), F.col("op")).otherwise(unknown)
        )
        valid = valid.filter((F.col("op") == "delete") | F.col("n_tokens").isNotNull())
        last = valid.groupBy("doc_id", "tokenizer").agg(
            F.max(F.struct("seq", "n_tokens", "op", "source", "lang")).alias("c")
        )
        entries = last.select(
            "doc_id",
            "tokenizer",
            (F.col("c.op") == "delete").alias("deleted"),
            "c.source",
            "c.lang",
            F.coalesce("c.n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
        )
        entries.write.mode("overwrite").parquet(self._path("ledger", batch))
        entries = self.spark.read.parquet(self._path("ledger", batch))

        added = entries.filter("not deleted").select(
            *KEYS, "n_tokens", F.lit(1).cast("bigint").alias("n_docs")
        )
        gone = self.state(before=batch, of=entries.select("doc_id", "tokenizer"))
        if gone is not None:  # what stood before of the documents that change
            added = added.union(
                gone.select(*KEYS, -F.col("n_tokens"), F.lit(-1).cast("bigint"))
            )
        added.groupBy(*KEYS).agg(
            F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs")
        ).write.mode("overwrite").parquet(self._path("deltas", batch))
        self.spark.range(1).write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens), groups without documents left out."""
        deltas = self._done("deltas")
        if deltas is None:
            return self.spark.createDataFrame(
                [], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
            )
        return (
            deltas.groupBy(*KEYS)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .filter("n_docs > 0")
        )
