"""Connected components of an edge table of any size, without any node's neighbours meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import stored


#: Tasks that the pairs of one node are dealt over at least.
SALTS = 64


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an edge, root being the least node of its component.

    Large and small stars alternate until nothing changes: a logarithmic number of rounds, each linear in the edges
    and written to the shared folder. Null ends, loops and repeated edges do no harm; no edges give no rows.
    """
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    pairs = pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, state = stored(pairs), None
    while True:
        # large star: every larger neighbour of u is tied to the least of u and its neighbours; that minimum is taken
        # before the shuffle and goes to the salts the neighbours have, so a node with most of all pairs is no skew
        up = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), F.pmod(F.xxhash64("u"), F.lit(SALTS)).alias("salt"))
        both = up.unionAll(pairs.select("u", "v", F.lit(None).cast("long")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.collect_set("salt").alias("salts"))
        large = up.join(least.select("u", "m", F.explode("salts").alias("salt")), ["u", "salt"])
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of u, and u itself, is tied to the least of them; u has one smaller
        # neighbour per node it was tied to, not one per node tied to it
        small = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = small.select("v", "m").filter("v <> m").unionAll(small.select(F.col("u").alias("v"), "m"))
        pairs = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        sums = [F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")]
        before, state = state, pairs.agg(*sums).first()
        if state == before or state[0] == 0:
            break
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
