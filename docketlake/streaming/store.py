"""A table in hash buckets that batches are merged into: a batch reads and rewrites the buckets of its own keys only.

Files lie under in_bucket=<k>/by_batch=<id>. A batch writes its merged buckets by dynamic partition overwrite under its own id, then marks itself as done, so a batch that
runs again after a failure starts from what was there before it and replaces its own half-done work; readers take, for each bucket, the latest version
of a batch that is done. Of a bucket the version before the latest stays, for a batch that has to run again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.session import intermediate, written


@dataclass(frozen=True)
class BucketStore:
    """A table in ``folder`` in ``buckets`` by a hash of ``key``. The number of buckets is the table's for good."""

    spark: SparkSession
    folder: str
    key: str = "docket_id"
    buckets: int = 64

    def _at(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath, jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, pattern: str) -> list[tuple[int, ...]]:
        """The numbers after = or at the end in the names of matching paths: a row a bucket and version, none a row of data."""
        jpath, store = self._at(f"{self.folder}/{pattern}")
        found = [str(f.getPath()).removeprefix("file:") for f in (store.globStatus(jpath) or [])]
        depth = pattern.count("/") + 1
        return [tuple(int(part.split("=")[-1]) for part in p.split("/")[-depth:]) for p in found]

    def done(self) -> list[int]:
        """The ids of batches that are done, of which the latest are kept."""
        return sorted(n[0] for n in self._numbers("done=*"))

    def versions(self) -> dict[int, list[int]]:
        """The batches that each bucket has versions of."""
        told: dict[int, list[int]] = {}
        for bucket, batch in sorted(self._numbers("in_bucket=*/by_batch=*")):
            told.setdefault(bucket, []).append(batch)
        return told

    def read(self, *, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The latest version of every bucket, or of those named, by batches that are done and earlier than ``before``; None where there is none."""
        done = self.done()
        last = max(done, default=-1) if before is None else before - 1
        latest = {k: max(b for b in batches if b <= last) for k, batches in self.versions().items() if (buckets is None or k in buckets) and any(b <= last for b in batches)}
        return self.spark.read.parquet(*(f"{self.folder}/in_bucket={k}/by_batch={b}" for k, b in sorted(latest.items()))) if latest else None

    def bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def merge(self, batch: int, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merges a batch's rows into the buckets of their keys, and returns these; ``merge`` (stored, new) has to combine rows of equal keys only."""
        with intermediate(self.spark):
            new = written(new, "delta")
            touched = sorted(r[0] for r in new.select(self.bucket()).distinct().collect())  # at most one number a bucket
            if touched:
                old = self.read(before=batch, buckets=touched)
                whole = merge(old, new) if old is not None else new
                placed = whole.select(*new.columns).withColumn("in_bucket", self.bucket()).withColumn("by_batch", F.lit(batch).cast("long")).repartition("in_bucket")
                placed.write.partitionBy("in_bucket", "by_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.folder)
        jpath, store = self._at(f"{self.folder}/done={batch}")
        store.mkdirs(jpath)
        self._clean(touched, batch)
        return touched

    def _clean(self, touched: list[int], batch: int) -> None:
        every = self.versions()
        for k in touched:
            for gone in [b for b in every[k] if b < batch][:-1]:
                jpath, store = self._at(f"{self.folder}/in_bucket={k}/by_batch={gone}")
                store.delete(jpath, True)
        for gone in self.done()[:-2]:
            jpath, store = self._at(f"{self.folder}/done={gone}")
            store.delete(jpath, True)
