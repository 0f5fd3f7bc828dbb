"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is a row with ``sign`` 1 or -1 and a number of tokens: an insert is +, a delete -, a revised count
the old one with - and the new one with +.  Totals are additive, so a batch is stored as its own sums and
never touches earlier ones.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata.llm import common
from daystrata.llm.units import ByteLevelIds, unit_ids

KEYS = ("source", "lang", "version")
SUMS = "source string, lang string, version string, docs bigint, tokens bigint"


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens, text_hash) of every whole text; a null text has no tokens."""
    def count(batches):
        encoder = unit_ids(ByteLevelIds, tokenizer)
        for batch in batches:
            n = [k for _, lengths in encoder.batches(batch.column(3)) for k in lengths.tolist()]
            arrays = [*batch.columns[:3], pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64()), batch.column(4)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "source", "lang", "version", "n_tokens", "text_hash"])

    narrow = common.columns(docs, doc_id="bigint", source="string", lang="string", text="string").withColumn("text_hash", F.sha2("text", 256))
    return common.map_batches(narrow, count, "doc_id bigint, source string, lang string, version string, n_tokens bigint, text_hash string")


def signed(rows: DataFrame, sign: int, tokens="n_tokens", version="version") -> DataFrame:
    """Rows as changes: source, lang, version, sign, n_tokens."""
    return rows.select("source", "lang", F.lit(version).alias("version") if version != "version" else "version", F.lit(sign).alias("sign"), F.col(tokens).alias("n_tokens") if isinstance(tokens, str) else tokens.alias("n_tokens"))


class Rollup:
    """Totals in one folder: ``batch=ID`` holds the sums of a committed batch, ``base=K`` those of all batches
    folded so far, with their names.

    A batch is committed when its folder has Spark's success mark.  Committing a name again changes nothing;
    an attempt that died before the mark is written over.  Folding is optional and may die at any point too:
    a base counts only when it is marked, and the batches it names are left out from then on.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _marked(self, folder: str) -> bool:
        return self._files.exists(self._path(f"{self.path}/{folder}/_SUCCESS"))

    def _listed(self, kind: str) -> list[str]:
        found = self._files.globStatus(self._path(f"{self.path}/{kind}=*"))
        return sorted(n for n in (f.getPath().getName() for f in found or ()) if self._marked(n))

    def _base(self) -> tuple[str | None, set[str]]:
        bases = sorted(self._listed("base"), key=lambda n: int(n[5:]))
        if not bases:
            return None, set()
        named = self.spark.read.schema("name string").parquet(f"{self.path}/names-{bases[-1]}")
        return bases[-1], {r["name"] for r in named.collect()}

    def committed(self, batch: str) -> bool:
        return self._marked(f"batch={batch}") or f"batch={batch}" in self._base()[1]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False where it was already.  ``changes``: source, lang, version, sign, n_tokens.

        Null keys are a group like others; a change without tokens or sign counts as 0 tokens or sign; sums that
        come to nothing are left out; an empty batch is committed without rows; other columns are ignored.
        Rows are summed before the shuffle, so a source with most of the rows is no hot key.
        """
        if not batch or any(c in batch for c in "/=*{}[]"):
            raise ValueError("a batch name is a plain word")
        if self.committed(batch):
            return False
        rows = common.columns(changes, source="string", lang="string", version="string", sign="bigint", n_tokens="bigint").fillna(0, ["sign", "n_tokens"])
        self._summed(rows.select(*KEYS, F.col("sign").alias("docs"), (F.col("sign") * F.col("n_tokens")).alias("tokens"))).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs <> 0 or tokens <> 0")

    def _total(self, base: str | None, batches: list[str]) -> DataFrame:
        folders = [f"{self.path}/{n}" for n in [*([base] if base else []), *batches]]
        if not folders:
            return self.spark.createDataFrame([], SUMS)
        return self._summed(self.spark.read.schema(SUMS).parquet(*folders))

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches."""
        base, folded = self._base()
        return self._total(base, [b for b in self._listed("batch") if b not in folded])

    def fold(self) -> None:
        """Sum up all committed batches into a new base: exactly those listed once at the start, so one that is
        committed meanwhile stays outside.  One writer folds at a time, and no two commit one name at a time."""
        base, folded = self._base()
        batches = [b for b in self._listed("batch") if b not in folded]
        new = f"base={int(base[5:]) + 1 if base else 0}"
        rows = [(n,) for n in sorted(folded.union(batches))]
        self.spark.createDataFrame(rows, "name string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/names-{new}")
        self._total(base, batches).write.mode("overwrite").parquet(f"{self.path}/{new}")
