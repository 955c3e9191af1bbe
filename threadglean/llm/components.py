"""Connected components of links, by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from threadglean.operators.scale import cut_lineage, skew_join


def _pairs(edges):
    return edges.where(F.col("u") != F.col("v")).distinct()


def _star(edges, small):
    """Hang the larger (or, with `small`, the not larger) neighbours of a node on its least one."""
    if small:
        directed = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        directed = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = skew_join(directed, least, "u", "inner", "v", hot_from=directed)
    if small:
        moved = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _pairs(moved)


def components(edges):
    """(id, component): the least id reachable, for every id that has a link.

    `edges` has long columns u and v without nulls; order and repeats don't matter.
    Links are stored in the shared folder after each step; a node with very many
    links is dealt over several tasks. A chain of n nodes takes about log n steps.
    """
    now = cut_lineage(_pairs(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        now = cut_lineage(_star(_star(now, small=False), small=True))
    return now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


class Forest:
    """Union-find over positions 0 to n - 1 inside one task."""

    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a, b):
        """True if a and b were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
