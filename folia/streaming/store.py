"""A keyed store of newest rows that a stream keeps up to date.

Rows lie in ``buckets`` folders by the hash of their key. A micro-batch
rewrites only the buckets it touches: what the bucket held and the batch are
merged, the newest row of each key stays. ``heads/epoch=n`` says in which
epoch each bucket was last written and is published after the data, so a
reader sees an epoch whole; a repeated epoch merges with the heads before it
and gives the same rows. What no recent head points to is removed, so storage
grows with the keys, not with the epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.session import folder_names, remove_folder


class LatestStore:
    """Newest row of each ``key`` by ``order`` (ascending), in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: Sequence[str], buckets: int = 16):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, list(order), buckets
        self.schema = spark.createDataFrame([], schema).schema

    def epochs(self) -> list[int]:
        return sorted(int(n.removeprefix("epoch=")) for n in folder_names(self.spark, f"{self.path}/heads") if n.startswith("epoch="))

    def heads(self, epoch: int | None) -> dict[int, int]:
        """Bucket -> the epoch that wrote it last; at most ``buckets`` rows."""
        if epoch is None:
            return {}
        rows = self.spark.read.schema("bucket int, written long").parquet(f"{self.path}/heads/epoch={epoch}").collect()
        return {r["bucket"]: r["written"] for r in rows}

    def _rows(self, heads: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/rows/epoch={e}/bucket={b}" for b, e in sorted(heads.items())]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c != self.key]
        picked = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("r"))
        return picked.select(*[F.col(self.key) if c == self.key else F.col(f"r.{c}").alias(c) for c in self.schema.names])

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """Take a micro-batch in, for ``foreachBatch``."""
        before = max((e for e in self.epochs() if e < epoch), default=None)
        heads = self.heads(before)
        bucket = F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")
        fresh = self.newest(batch.select(*self.schema.names)).persist()  # of one batch; read for its buckets and its rows
        try:
            touched = [r[0] for r in fresh.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
            if touched:
                kept = self._rows({b: heads[b] for b in touched if b in heads})
                merged = self.newest(kept.unionByName(fresh)).withColumn("bucket", bucket)
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/epoch={epoch}")
        finally:
            fresh.unpersist()
        after = heads | dict.fromkeys(touched, epoch)
        self.spark.createDataFrame([(b, e) for b, e in sorted(after.items())], "bucket int, written long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/heads/epoch={epoch}")
        self._compact(epoch, before, after, heads)

    def _compact(self, epoch: int, before: int | None, *live: dict[int, int]) -> None:
        """Remove what neither this epoch nor the one before points to: that one may be read or repeated."""
        used = {(e, b) for heads in live for b, e in heads.items()}
        for e in self.epochs():
            if e < epoch and e != before:
                remove_folder(self.spark, f"{self.path}/heads/epoch={e}")
        for name in folder_names(self.spark, f"{self.path}/rows"):
            e = int(name.removeprefix("epoch="))
            inside = [n for n in folder_names(self.spark, f"{self.path}/rows/{name}") if n.startswith("bucket=")]
            dead = [n for n in inside if (e, int(n.removeprefix("bucket="))) not in used]
            if len(dead) == len(inside):
                remove_folder(self.spark, f"{self.path}/rows/{name}")
            else:
                for n in dead:
                    remove_folder(self.spark, f"{self.path}/rows/{name}/{n}")

    def read(self) -> DataFrame:
        found = self.epochs()
        return self._rows(self.heads(found[-1] if found else None))
