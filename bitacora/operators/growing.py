"""Connected components of a graph that grows batch by batch.

The label of a folio is the smallest folio of its component.  A folder keeps two tables that
are only ever added to: ``labels``, each folio with the label it got when it first came,
and ``parents``, each label that was joined to another with that one.  A batch of edges reads
the labels of its own folios, follows their parents, and is contracted to edges between
labels; the components of those say which labels join.  What is read and computed depends
on the batch and on how often its components were joined before, not on the folios there are.

Both tables lie in ``buckets`` folders by hash, of which a batch opens those it has folios
in.  A batch counts once its mark is written; one that failed is written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitacora.operators.graph import connected_components
from bitacora.storage import Workspace

BUCKETS = 256

_SCHEMAS = {
    "labels": "folio string, label string, batch bigint, bucket bigint",
    "parents": "label string, parent string, batch bigint, bucket bigint",
}


class GrowingComponents:
    """The components of all edges that were added under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets

    def add(self, edges: DataFrame) -> dict:
        """Adds edges (src, dst) between distinct folios; an edge may be there already.

        Gives the numbers of the batch, its folios that are new, and labels that were joined.
        """
        batch = self._last() + 1
        ws = Workspace(self.spark)
        try:
            given, _ = ws.stage(edges.select("src", "dst").where("src <> dst").distinct())
            ends = given.select(F.explode(F.array("src", "dst")).alias("folio")).distinct()
            known, _ = ws.stage(self._labelled(ends, ws))
            label = F.coalesce("label", "folio")
            a = known.select(F.col("folio").alias("src"), label.alias("a"))
            b = known.select(F.col("folio").alias("dst"), label.alias("b"))
            # Edges of a batch may crowd at a folio: in this join of tables Spark splits them.
            between = given.join(a, "src").join(b, "dst").where("a <> b")
            between = between.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
            groups, _ = connected_components(between, ws)
            groups, _ = ws.stage(groups.select(F.col("folio").alias("_from"), F.col("label").alias("group")))
            least = groups.groupBy("group").agg(F.min("_from").alias("into"))
            joined, seen = ws.stage(
                groups.join(least, "group").where("_from <> into").select("_from", "into"),
                joined=F.count(F.lit(1)),
            )
            new, counted = ws.stage(
                known.where("label IS NULL").select("folio"), folios=F.count(F.lit(1))
            )
            renamed = F.coalesce("into", "folio")
            labels = new.join(joined, F.col("folio") == F.col("_from"), "left").select("folio", renamed.alias("label"))
            # New folios have no parents: nothing points to them yet.
            old = joined.join(new, F.col("_from") == F.col("folio"), "left_anti")
            self._write("labels", batch, labels, F.col("folio"))
            self._write("parents", batch, old.select(F.col("_from").alias("label"), F.col("into").alias("parent")), F.col("label"))
            self._mark(batch)
        finally:
            ws.remove()
        return {"batch": batch, "folios": counted["folios"] or 0, "joined": seen["joined"] or 0}

    def labels(self) -> DataFrame:
        """Every folio with its label: (folio, label).  It reads the tables of a folder of its own."""
        ws = Workspace(self.spark)
        first = self._read("labels").select("folio", "label")
        found = self._followed(first.select("label").distinct(), ws)
        return first.join(found, "label").select("folio", F.col("now").alias("label"))

    # ------------------------------------------------------------------

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("bigint")

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _last(self) -> int:
        """Number of the last batch whose mark is written; 0 if there is none."""
        system, marks = self._system(), self._path("done")
        if not system.exists(marks):
            return 0
        return max((int(s.getPath().getName()) for s in system.listStatus(marks)), default=0)

    def _mark(self, batch: int) -> None:
        self._system().create(self._path(f"done/{batch}"), False).close()

    def _write(self, table: str, batch: int, df: DataFrame, key: Column) -> None:
        df.withColumn("bucket", self._bucket(key)).write.partitionBy("bucket").mode("overwrite").parquet(
            f"{self.folder}/{table}/batch={batch}"
        )

    def _read(self, table: str) -> DataFrame:
        last = self._last()
        if not last:
            return self.spark.createDataFrame([], _SCHEMAS[table])
        read = self.spark.read.schema(_SCHEMAS[table]).option("basePath", f"{self.folder}/{table}")
        return read.parquet(f"{self.folder}/{table}").where(F.col("batch") <= last)

    def _touched(self, table: str, keys: DataFrame, key: str) -> DataFrame:
        """Rows of a table in the buckets that the keys fall into; their numbers are few."""
        used = keys.select(self._bucket(F.col(key)).alias("b")).distinct().collect()
        return self._read(table).where(F.col("bucket").isin([r["b"] for r in used])).drop("batch", "bucket")

    def _labelled(self, ends: DataFrame, ws: Workspace) -> DataFrame:
        """Folios with the label they have now; null for those that are new."""
        first, _ = ws.stage(ends.join(self._touched("labels", ends, "folio"), "folio", "left"))
        now = self._followed(first.select("label").where("label IS NOT NULL").distinct(), ws)
        return first.join(now, "label", "left").select("folio", F.col("now").alias("label"))

    def _followed(self, labels: DataFrame, ws: Workspace) -> DataFrame:
        """(label, now): where the parents of labels lead to."""
        open_, seen = ws.stage(labels.select("label", F.col("label").alias("now")), n=F.count(F.lit(1)))
        done = []
        while seen["n"]:
            here = open_.select(F.col("now").alias("at")).distinct()
            parents = self._touched("parents", here, "at").withColumnRenamed("label", "at")
            moved, seen = ws.stage(
                open_.join(parents, F.col("now") == F.col("at"), "left").select("label", "now", "parent"),
                n=F.count("parent"),
            )
            done.append(moved.where("parent IS NULL").select("label", "now"))
            open_ = moved.where("parent IS NOT NULL").select("label", F.col("parent").alias("now"))
        found = open_
        for part in done:
            found = found.unionByName(part)
        return found
