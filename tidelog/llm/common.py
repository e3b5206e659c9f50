"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import scratch_path


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Writes the frame as Parquet below the shared folder and reads it again.

    This cuts the lineage: a lost executor costs a read of the files. The files go when the session ends.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    forget_at_exit(frame, path)
    return spark.read.schema(frame.schema).parquet(path)


def forget_at_exit(frame: DataFrame, path: str) -> None:
    """Has the session delete the path when it ends."""
    context = frame.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)


def packed(frame: DataFrame) -> Column:
    """All columns as one struct column ``row``, so that no name of the input can clash with a helper's."""
    return F.struct(*[frame[f"`{c}`"].alias(c) for c in frame.columns]).alias("row")


def unpacked(columns: list[str], *new: str) -> list[Column]:
    """The columns of ``row`` again, without those that a new column replaces."""
    return [F.col("row").getField(c).alias(c) for c in columns if c not in new]


def connected(links: DataFrame, rounds: int = 40) -> DataFrame:
    """Smallest node that each node reaches: ``links`` has columns a and b; returns (node, root), a row per node.

    Large-star and small-star steps in turn: every node hands its larger (then its smaller) neighbours to its
    smallest neighbour, until nothing changes. Each step stores its links, which never outnumber the links
    given, so the work per step is linear; a hub's rows are spread by the adaptive skew join.
    """
    now = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "links")
        # every link of large runs from a larger node a to a smaller one b
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = stored(small.where("a <> b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
