"""The sitemap manifest as a versioned table on disk.

``children`` has the page URLs of every child sitemap, a partition for each
child and the version in which it was read; ``index`` has, for every version,
the listed children in order, the digest of each child's document and the
version it was read in (null: listed, not read yet). Loading a new set of
documents compares digests first: only children that changed or are new are
parsed and written, all others are pointed to where they lie. The index of a
version is written last, so a reader sees a version whole or not at all, and
a load that is repeated overwrites its own partitions alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import urls as U
from folia.operators.sitemaps import key_index, sitemap_locs
from folia.session import folder_names, materialize, remove_folder

_CHILD = "sitemap_url string, loc_pos long, page_url string, key string, error string, version long, sitemap string"
_INDEX = "sitemap_url string, sitemap_pos long, digest string, loaded long"


class SitemapTable:
    """A manifest table in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(int(n.removeprefix("version=")) for n in folder_names(self.spark, f"{self.path}/index") if n.startswith("version="))

    def index(self, version: int | None = None) -> DataFrame:
        """(sitemap_url, sitemap_pos, digest, loaded) of a version, the newest by default."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(f"{self.path}/index/version={found[-1] if version is None else version}")

    def _listed(self, docs: DataFrame, index_url: str) -> DataFrame:
        top = sitemap_locs(docs.where(F.col("sitemap_url") == index_url)).limit(1).collect()
        if not top or top[0]["error"]:
            raise ValueError(f"the sitemap index cannot be read: {top[0]['error'] if top else 'no document'}")
        # an index lists 50,000 children at most
        return self.spark.createDataFrame([(u, k + 1) for k, u in enumerate(top[0]["locs"])], "sitemap_url string, sitemap_pos long")

    def _publish(self, rows: DataFrame, version: int) -> int:
        rows.select("sitemap_url", "sitemap_pos", "digest", "loaded").write.mode("overwrite").parquet(f"{self.path}/index/version={version}")
        return version

    def load(self, docs: DataFrame, index_url: str) -> int:
        """A new version from (sitemap_url, xml). Children without a document
        here keep what was read before; an index that cannot be read is an
        error and leaves the table as it was."""
        version = max(self.versions(), default=0) + 1
        listed = self._listed(docs, index_url)
        digests = docs.where((F.col("sitemap_url") != index_url) & F.col("xml").isNotNull()).groupBy("sitemap_url").agg(F.max(F.md5("xml")).alias("now"))
        plan = materialize(
            listed.join(digests, "sitemap_url", "left").join(self.index().drop("sitemap_pos"), "sitemap_url", "left").selectExpr(
                "sitemap_url", "sitemap_pos", "coalesce(now, digest) AS digest",
                f"CASE WHEN now IS NOT NULL AND (loaded IS NULL OR NOT now <=> digest) THEN {version}L ELSE loaded END AS loaded"))
        fresh = plan.where(F.col("loaded") == version).select("sitemap_url", "digest")
        wanted = docs.withColumn("digest", F.md5("xml")).join(fresh, ["sitemap_url", "digest"], "left_semi").dropDuplicates(["sitemap_url"])
        rows = sitemap_locs(wanted).selectExpr("sitemap_url", "error", "posexplode_outer(locs) AS (p, page_url)").selectExpr(
            "sitemap_url", "CAST(p + 1 AS BIGINT) AS loc_pos", "page_url", f"CASE WHEN page_url IS NOT NULL THEN {U.url_canonical('page_url')} END AS key", "error",
            f"{version}L AS version", "md5(sitemap_url) AS sitemap")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "sitemap").parquet(f"{self.path}/children")
        return self._publish(plan, version)

    def refresh(self, docs: DataFrame, index_url: str) -> int:
        """A new version with the index alone: every child is to be read again."""
        return self._publish(self._listed(docs, index_url).selectExpr("*", "CAST(NULL AS STRING) AS digest", "CAST(NULL AS BIGINT) AS loaded"), max(self.versions(), default=0) + 1)

    def _children(self, index: DataFrame) -> DataFrame:
        """Rows of the children that an index points to, from their partitions."""
        read_in = [r["loaded"] for r in index.select("loaded").where("loaded IS NOT NULL").distinct().collect()]  # some of the versions
        if not read_in:
            return self.spark.createDataFrame([], _CHILD)
        rows = self.spark.read.schema(_CHILD).parquet(f"{self.path}/children")
        return rows.where(F.col("version").isin(read_in))

    def manifest(self, version: int | None = None) -> DataFrame:
        """(sitemap_url, sitemap_pos, loc_pos, page_url, key, error) of a
        version: a row per page URL, one of nulls for a child without any."""
        index = self.index(version)
        at = index.select("sitemap_url", "sitemap_pos", F.col("loaded").alias("version"), F.md5("sitemap_url").alias("sitemap"))
        return at.join(self._children(index).drop("sitemap_url"), ["version", "sitemap"], "left").select("sitemap_url", "sitemap_pos", "loc_pos", "page_url", "key", "error")

    def key_index(self, version: int | None = None) -> DataFrame:
        return key_index(self.manifest(version).drop("key"))

    def changes(self, before: int, after: int) -> DataFrame:
        """(item, change): children 'kept', 'changed', 'added' or 'removed'
        from one version to another, and each key 'key_lost' that no child has any more."""
        old, new = self.index(before), self.index(after)
        both = old.selectExpr("sitemap_url", "digest AS d0", "true AS o").join(new.selectExpr("sitemap_url", "digest AS d1", "true AS n"), "sitemap_url", "full_outer")
        children = both.selectExpr("sitemap_url AS item", "CASE WHEN n IS NULL THEN 'removed' WHEN o IS NULL THEN 'added' WHEN d0 <=> d1 THEN 'kept' ELSE 'changed' END AS change")
        keys = lambda v: self.manifest(v).where("key IS NOT NULL").select(F.col("key").alias("item")).distinct()
        return children.unionByName(keys(before).join(keys(after), "item", "left_anti").withColumn("change", F.lit("key_lost")))

    def vacuum(self, keep: int = 1) -> None:
        """Remove all versions but the last ``keep`` and the partitions that only those point to."""
        found = self.versions()
        kept = found[-keep:] if keep > 0 else []
        for v in found[: len(found) - len(kept)]:
            remove_folder(self.spark, f"{self.path}/index/version={v}")
        used: dict[int, set[str]] = {}
        for v in kept:  # one narrow row per child sitemap, 50,000 at most
            for r in self.index(v).where("loaded IS NOT NULL").select("loaded", F.md5("sitemap_url").alias("s")).toLocalIterator():
                used.setdefault(r["loaded"], set()).add(r["s"])
        for name in folder_names(self.spark, f"{self.path}/children"):
            if not name.startswith("version="):
                continue
            live = used.get(int(name.removeprefix("version=")), set())
            inside = folder_names(self.spark, f"{self.path}/children/{name}")
            for s in inside:
                if s.removeprefix("sitemap=") not in live:
                    remove_folder(self.spark, f"{self.path}/children/{name}/{s}")
            if not live:
                remove_folder(self.spark, f"{self.path}/children/{name}")
