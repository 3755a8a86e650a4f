"""Connected components as joins, without links or labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(sid, comp) for each end of the links (a, b): the least end that links reach.

    Each round takes the least label among neighbours, then the label's own label, so long
    chains halve. The labels of a round are a written table.
    """
    both = links.select(F.col("a").alias("sid"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("sid"), F.col("a").alias("other"))).distinct()
    both = stored(both, "arcs")
    label = both.groupBy("sid").agg(F.min("other").alias("least")).select("sid", F.least("sid", "least").alias("comp"))
    label = stored(label, "labels")
    while True:
        near = both.join(label.select(F.col("sid").alias("other"), "comp"), "other").groupBy("sid").agg(F.min("comp").alias("near"))
        step = label.join(near, "sid").select("sid", "comp", F.least("comp", "near").alias("next"))
        jump = label.select(F.col("sid").alias("next"), F.col("comp").alias("far"))
        step = step.join(jump, "next", "left").select("sid", "comp", F.least("next", F.coalesce("far", "next")).alias("next"))
        step = stored(step, "labels")
        moved = step.filter("comp != next").limit(1).count()
        label = step.select("sid", F.col("next").alias("comp"))
        if not moved:
            return label
