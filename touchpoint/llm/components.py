"""Connected components of a link table, by alternating large and small stars.

Every round replaces the links of a node by links to the smallest node it sees, first for its larger
neighbours, then for its smaller ones. The number of rounds grows with the logarithm of the longest
chain. Links are never gathered per node or in the driver: the smallest neighbour is a partial
aggregate, written out so that both sides of the join that follows are plain scans, which adaptive
execution can split where a node has very many links. All tables of a round lie in the shared
checkpoint folder, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.llm.scratch import written


def _smallest(links: DataFrame) -> DataFrame:
    """Each node with the smallest node it sees, itself included, joined to its links."""
    least = written(links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
    return links.join(least, "u")


def _stars(links: DataFrame) -> bool:
    """Every node has one link to a smaller node, which has none: the components are found."""
    ends = links.select("u", F.lit(1).alias("up")).union(links.select("v", F.lit(None)))
    crossed = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("all"))
    return crossed.where("ups > 1 or (ups = 1 and all > 1)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link; the component is its smallest reachable node.

    Self links and repeated links are allowed; links with a null end are left out. No links give no rows.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    start = written(ends.distinct(), "links")
    current = start.where("u <> v")
    while not _stars(current):
        both = current.union(current.select("v", "u"))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = written(large.distinct(), "links")
        pairs = F.array(F.struct(F.col("v").alias("u"), "least"), F.struct("u", "least"))
        small = _smallest(large).select(F.inline(pairs)).select("u", F.col("least").alias("v")).where("u <> v")
        current = written(small.distinct(), "links")
    nodes = current.union(current.select("v", "v")).union(start.where("u = v"))
    return nodes.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
