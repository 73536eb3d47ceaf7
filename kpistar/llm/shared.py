"""Written tables in the cluster's shared folder, and connected components by star joins."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.session import ensure_checkpoint_dir


class Scratch:
    """Tables written under the shared checkpoint folder: they cut lineage and survive executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpistar-llm/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them back."""
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables of this scratch that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Have the shuffle files of finished steps deleted now.  Spark's cleaner does so when the
        driver collects its garbage, which for a small driver plan may not come for long."""
        gc.collect()
        self.spark._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (they need not have it installed)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="kpistar-ship-"), "kpistar_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest node reachable.

    ``edges`` has two long columns u, v.  Alternates the large-star and small-star
    steps of Kiveris et al. (2014): per node the least neighbour comes from a
    map-side combined ``min``, and is joined back to the edges, so a node that holds
    a third of all edges is a skewed join side that adaptive execution may split.
    Rounds are written tables; it ends when the edges are stars: every node has only
    greater neighbours or a single one.
    """
    cur, rounds = scratch.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges-0"), 0
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("last")).where("m < u and m <> last").isEmpty():
            break
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rounds += 1
        cur = scratch.put(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), f"edges-{rounds}")
        scratch.drop(f"edges-{rounds - 1}")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
