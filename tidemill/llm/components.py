"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the least node it is connected with, for all nodes of ``a``-``b`` links.

    Every round takes the least label among the neighbours and then the label
    of that label, so long chains halve. Labels are written to the shared
    folder each round; sums are partial before every shuffle.
    """
    pairs = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = pairs.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        lower = labels.join(near.select(F.col("a").alias("node"), "m"), "node").select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        lower = stored(lower, "labels")
        over = lower.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        after = stored(lower.join(over, "comp").select("node", "was", F.col("top").alias("comp")), "labels")
        labels = after.select("node", "comp")
        if after.filter("was != comp").isEmpty():
            return labels
