"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, settled


def _both_ways(edges: DataFrame) -> DataFrame:
    """(u, v) in both directions, without loops."""
    return edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Large: each node sends its larger neighbours to the
    smallest node it sees; small: each node sends its smaller neighbours
    (and itself) there. Nodes are joined to their minimum, never gathered."""
    if large:
        rows = _both_ways(edges)
    else:
        rows = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = rows.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    out = rows.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    got = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return got["n"], got["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v; long, no nulls):
    the smallest node that it reaches. Loops and repeated edges do no harm.

    Each round is written to the shared folder, so a lost executor costs a
    re-read of one small table; the rounds grow with the logarithm of the
    nodes, and go once the result is written."""
    return settled(edges.sparkSession, lambda: _settling(edges), "components")


def _settling(edges: DataFrame) -> DataFrame:
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    was, mark = None, _signature(now)
    while mark != was:
        was = mark
        now = materialise(_star(_star(now, large=True), large=False), "edges")
        mark = _signature(now)
    inner = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return inner.union(roots)
