"""Token counts as additive totals that change by signed rows.

A batch brings new counts of documents, or their deletion. What a document had
before is taken back by a row with a minus sign, so that the totals by source,
language and tokenizer are sums over all committed batches. A batch is written
to folders of its own and counts from the moment its commit is there; doing a
batch again, after a crash or by mistake, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
_LEDGER = "doc_id string, source string, lang string, tokenizer string, sign int, tokens long, batch long"
_TOTALS = "source string, lang string, tokenizer string, docs long, tokens long, batch long"
_COMMITS = "digest long, n_changes long, n_rejected long, batch long"


class TokenRollup:
    """Totals below a folder that all executors share.

    Changes are rows ``doc_id, source, lang, tokenizer, tokens``; null tokens
    delete the document's count for that tokenizer. If a batch has several rows
    for a document and tokenizer, the one with the most tokens counts, and among
    equals that of the largest source and language; a deletion yields to a
    count. Rows without id or tokenizer are rejected, and their number is in the
    commit. Null sources and languages are keys like others. Deleting what is
    not there changes nothing, nor does an empty batch. Other columns are left
    out. Ids are kept as text.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _read(self, name: str, schema: str) -> DataFrame:
        # The first batch makes the folders.
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}/batch=*")

    def commits(self) -> DataFrame:
        """``digest, n_changes, n_rejected, batch`` of committed batches."""
        return self._read("commits", _COMMITS)

    def _committed(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        commits = self.commits().select("batch")
        if before is not None:
            commits = commits.where(F.col("batch") < before)
        # One row for each batch ever made.
        return self._read(name, schema).join(commits, "batch", "left_semi")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch; False if it was committed before.

        Batches come in rising order. Raises if another content was committed
        under the number, or a later batch was.
        """
        rows = changes.select(
            F.col("doc_id").cast("string").alias("doc_id"), *KEYS, F.col("tokens").cast("long").alias("tokens")
        )
        content = rows.agg(
            F.coalesce(F.sum(F.xxhash64(*rows.columns).bitwiseAND(F.lit(2**40 - 1))), F.lit(0)).alias("digest"),
            F.count("*").alias("n"),
            F.count(F.when(F.col("doc_id").isNull() | F.col("tokenizer").isNull(), 1)).alias("rejected"),
        ).first()
        last = self.commits().agg(F.max("batch").alias("last"), F.max(F.when(F.col("batch") == batch, F.col("digest"))).alias("own")).first()
        if last["own"] is not None:
            if last["own"] != content["digest"]:
                raise ValueError(f"batch {batch} was committed with other content")
            return False
        if last["last"] is not None and last["last"] > batch:
            raise ValueError(f"batch {last['last']} is committed, {batch} is too late")
        latest = (
            rows.where("doc_id is not null and tokenizer is not null")
            .groupBy("doc_id", "tokenizer")
            .agg(F.max(F.struct("tokens", "source", "lang")).alias("new"))
        )
        document = ["doc_id", "tokenizer"]
        present = (
            self._committed("ledger", _LEDGER, batch)
            .join(latest.select(*document), document, "left_semi")
            .groupBy("doc_id", *KEYS, "tokens")
            .agg(F.sum("sign").alias("sign"))
            .where("sign > 0")
        )
        added = latest.where("new.tokens is not null").select(
            "doc_id", "new.source", "new.lang", "tokenizer", F.lit(1).alias("sign"), "new.tokens"
        )
        taken = present.select("doc_id", *KEYS, F.lit(-1).alias("sign"), "tokens")
        ledger = f"{self.root}/ledger/batch={batch}"
        added.unionByName(taken).write.mode("overwrite").parquet(ledger)
        self._sums(self.spark.read.schema(_LEDGER).parquet(ledger), "sign").write.mode("overwrite").parquet(
            f"{self.root}/totals/batch={batch}"
        )
        commit = [(content["digest"], content["n"], content["rejected"])]
        self.spark.createDataFrame(commit, "digest long, n_changes long, n_rejected long").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/commits/batch={batch}")
        return True

    @staticmethod
    def _sums(rows: DataFrame, sign: str | Column) -> DataFrame:
        return rows.groupBy(*KEYS).agg(
            F.sum(sign).cast("long").alias("docs"), F.sum(F.col(sign) * F.col("tokens")).cast("long").alias("tokens")
        )

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens``; keys without documents are gone."""
        sums = self._committed("totals", _TOTALS).groupBy(*KEYS)
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")
