"""Connected components of link tables, by union-find inside tasks and label exchange between them."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import give_back, ship, staged
from maskline.sources.staging import stage

# About as many links as one task unites. It bounds a task's memory (20 MB for so many separate ones); more take more tasks.
TASK_LINKS = 100_000


def _contract(batches, heads: bool = False):
    """Replace the links of one task by a link from every node to its group's least node; with `heads` from that one too."""
    give_back()
    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        nodes = [x for x in parent if heads or root(x) != x]
        for i in range(0, len(nodes), 10_000):
            part = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, schema.field(0).type), pa.array([root(x) for x in part], schema.field(1).type)],
                schema=schema,
            )


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (columns a, b); label is the group's least node.

    Links inside a task are united there, TASK_LINKS in each. Where that is one task, it has
    settled them all. What else crosses tasks is settled by passing the least label along
    links and jumping from label to label: the number of rounds grows with the logarithm of a
    chain's length, and each is several shuffles, so few links do not go that way. Self links
    are allowed; empty input gives an empty result. Nothing is collected.
    """
    ship(links.sparkSession)
    schema = links.select("a", "b").schema
    edges, n = stage(links.select("a", "b").where("a <> b"), "links")
    parts = max(1, math.ceil(n / TASK_LINKS))
    packed = edges.coalesce(parts)
    if parts == 1:
        return staged(packed.mapInArrow(lambda batches: _contract(batches, heads=True), schema), "labels").toDF("node", "label")
    edges = staged(packed.mapInArrow(_contract, schema).distinct(), "links")
    both = edges.union(edges.select("b", "a"))
    labels = staged(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(around, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = staged(
            lower.join(jump, "label", "left").select(
                "node", "was", F.least("label", F.coalesce("far", "label")).alias("label")
            ),
            "labels",
        )
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
