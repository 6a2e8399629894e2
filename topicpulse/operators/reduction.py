"""Exact betweenness on a smaller graph.

Two kinds of nodes need no search of their own:

* *Nodes with one neighbour* are peeled off, again and again: what hangs on a node of the rest
  is a tree, and every path between it and other nodes goes through that node.  A node stands
  for ``sends`` nodes of its tree that reach it and ``takes`` nodes that it reaches, itself
  included.
* *Nodes that only send*, to the same neighbours, are merged; so are nodes that only receive,
  from the same neighbours.  No path goes through or between them.  (Nodes that do both and
  have equal neighbours have paths among themselves, so they stay apart.)

The searches of Brandes run on the rest.  A source counts as often as its nodes send, and a
reached node as often as its nodes take.  What trees add is counted without a search: with
``out`` nodes beyond a node that it reaches and ``came`` nodes beyond that reach it, the paths
between its own tree and these are ``(sends - 1) * out + came * (takes - 1)``, and those between
two branches of its tree ``(sends - 1) * (takes - 1)`` less those that would stay in a branch.
For peeled nodes ``out`` and ``came`` follow from those of the node they hung on, in the order
opposite to the peeling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from topicpulse.operators.graph import TopicGraph, topic_graph
from topicpulse.operators.lineage import Stages

# Rounds of peeling at most.  A tree that is deeper keeps the nodes near its root, and they are
# searched as others are: the result is the same.
PEEL_ROUNDS = 30

NODE = ["Category", "id"]


@dataclass
class Reduced:
    """A smaller graph and how to get back from it.

    * ``edges``    Category, Source, Target of what is searched
    * ``weights``  Category, id, sends, takes, same: nodes with a tree; others have 1, 1, 0
    * ``classes``  Category, id, stands: nodes that another one stands for
    * ``peeled``   by round: Category, id, on, sent, got, sends, takes, same
    """

    edges: DataFrame
    weights: DataFrame
    classes: DataFrame
    peeled: list[DataFrame]


def neighbours(edges: DataFrame) -> DataFrame:
    """``Category, id, near, sent, got``: each node with each of its neighbours, once.

    ``sent`` is 1 if there is an edge to the neighbour, ``got`` if there is one from it.
    """
    end = lambda a, b, sent: F.struct(
        F.col(a).alias("id"), F.col(b).alias("near"), F.lit(sent).alias("sent"), F.lit(1 - sent).alias("got")
    )
    both = edges.filter("Source <> Target").select(
        "Category", F.inline(F.array(end("Source", "Target", 1), end("Target", "Source", 0)))
    )
    return both.groupBy("Category", "id", "near").agg(F.max("sent").alias("sent"), F.max("got").alias("got"))


def _added(weights: list[DataFrame]) -> DataFrame:
    """Weights of the nodes in several tables, added up (``sends`` and ``takes`` less one)."""
    whole = weights[0]
    for more in weights[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("sends", "takes", "same")])


def _hanging(near: DataFrame) -> DataFrame:
    """``Category, id, on, sent, got``: nodes with one neighbour; of two that have only each
    other, the greater one."""
    single = near.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n"), F.max("near").alias("on"), F.max("sent").alias("sent"), F.max("got").alias("got")
    ).filter("n = 1")
    ends = [F.least("id", "on").alias("_low"), F.greatest("id", "on").alias("_high")]
    picked = single.groupBy("Category", *ends).agg(F.max(F.struct("id", "on", "sent", "got")).alias("x"))
    return picked.select("Category", "x.*")


def peel(edges: DataFrame, stages: Stages, rounds: int = PEEL_ROUNDS) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The neighbours that are left, the weights, and the peeled nodes of each round."""
    near = stages.keep(neighbours(edges))
    weights, peeled = None, []
    for _ in range(rounds):
        found = _hanging(near)
        if weights is not None:
            found = found.join(weights, NODE, "left")
        else:
            found = found.withColumns({c: F.lit(0).cast("bigint") for c in ("sends", "takes", "same")})
        counts = {"sends": 1, "takes": 1, "same": 0}
        found = stages.keep(
            found.withColumns({c: F.coalesce(c, F.lit(0)) + F.lit(n).cast("bigint") for c, n in counts.items()})
        )
        if found.isEmpty():
            break
        peeled.append(found)
        sent, got = F.col("sent") * F.col("sends"), F.col("got") * F.col("takes")
        given = found.select("Category", F.col("on").alias("id"), sent.alias("sends"), got.alias("takes"), (sent * got).alias("same"))
        weights = stages.keep(_added([given] if weights is None else [weights, given]))
        gone = found.select(*NODE)
        left = near.join(gone, NODE, "left_anti")
        near = stages.keep(left.join(gone.withColumnRenamed("id", "near"), ["Category", "near"], "left_anti"))
    return near, weights, peeled


def _alike(near: DataFrame, only: str) -> DataFrame:
    """``Category, id, stands``: nodes without ``only``, by the least one of equal neighbours.

    Neighbourhoods are told apart by 128 hashed bits and their size.
    """
    shape = [F.bit_xor(F.xxhash64("near")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "near")).alias("b")]
    one_way = near.groupBy(*NODE).agg(F.max(only).alias("both"), F.count(F.lit(1)).alias("n"), *shape).filter("both = 0")
    first = one_way.groupBy("Category", "n", "a", "b").agg(F.min("id").alias("stands"), F.count(F.lit(1)).alias("alike"))
    known = one_way.join(first.filter("alike > 1"), ["Category", "n", "a", "b"])
    return known.filter("id <> stands").select(*NODE, "stands")


def reduce_graph(graph: TopicGraph, stages: Stages, rounds: int = PEEL_ROUNDS) -> Reduced:
    near, weights, peeled = peel(graph.edges, stages, rounds)
    classes = []
    for only in ("got", "sent"):
        merged = stages.keep(_alike(near, only))
        classes.append(merged)
        gone = merged.select(*NODE)
        near = near.join(gone, NODE, "left_anti")
        near = stages.keep(near.join(gone.withColumnRenamed("id", "near"), ["Category", "near"], "left_anti"))
    edges = near.filter("sent = 1").select("Category", F.col("id").alias("Source"), F.col("near").alias("Target"))
    if weights is None:
        weights = graph.degrees.select(*NODE, *[F.lit(0).cast("bigint").alias(c) for c in ("sends", "takes", "same")]).limit(0)
    whole = weights.select(*NODE, (F.col("sends") + 1).alias("sends"), (F.col("takes") + 1).alias("takes"), "same")
    return Reduced(stages.keep(edges), whole, classes[0].unionByName(classes[1]), peeled)


def search_weights(reduced: Reduced, searched: TopicGraph, stages: Stages) -> DataFrame:
    """``Category, key, id, out_degree, sends, takes`` of the nodes of the smaller graph, with
    those that they stand for."""
    others = reduced.classes.join(reduced.weights, NODE, "left").groupBy("Category", F.col("stands").alias("id")).agg(
        F.sum(F.coalesce("sends", F.lit(1))).alias("_sends"), F.sum(F.coalesce("takes", F.lit(1))).alias("_takes")
    )
    nodes = searched.degrees.join(reduced.weights, NODE, "left").join(others, NODE, "left")
    total = lambda c: (F.coalesce(c, F.lit(1)) + F.coalesce(f"_{c}", F.lit(0))).cast("double").alias(c)
    return stages.keep(nodes.select("Category", "key", "id", "out_degree", total("sends"), total("takes")))


def restored(graph: TopicGraph, reduced: Reduced, found: DataFrame, stages: Stages) -> DataFrame:
    """``Category, id, betweenness`` of all nodes from ``Category, id, betweenness, out, came``
    of those that were searched."""
    zero, one = F.lit(0.0), F.lit(1)
    # A node has what the one that stands for it has, but for its tree; no path goes through it.
    alike = reduced.classes.join(found.withColumnRenamed("id", "stands"), ["Category", "stands"]).select(
        *NODE, zero.alias("betweenness"), "out", "came"
    )
    peeled = None
    for r, one_round in enumerate(reduced.peeled):
        tagged = one_round.withColumn("round", F.lit(r))
        peeled = tagged if peeled is None else peeled.unionByName(tagged)
    core = graph.degrees.select(*NODE)
    if peeled is not None:
        core = core.join(peeled.select(*NODE), NODE, "left_anti")
    told = core.join(found.unionByName(alike), NODE, "left").join(reduced.weights, NODE, "left")
    sends, takes = F.coalesce("sends", one), F.coalesce("takes", one)
    out, came = F.coalesce("out", zero), F.coalesce("came", zero)
    inner = (sends - 1) * (takes - 1) - F.coalesce("same", F.lit(0))
    whole = F.coalesce("betweenness", zero) + (sends - 1) * out + came * (takes - 1) + inner
    known = stages.keep(
        told.select(*NODE, whole.alias("betweenness"), (out + takes).alias("reaches"), (came + sends).alias("reached"))
    )
    scores = [known.select(*NODE, "betweenness")]
    for one_round in reversed(reduced.peeled):
        on = known.select("Category", F.col("id").alias("on"), "reaches", "reached")
        # Beyond the node: what the one it hangs on reaches, less what it reaches through it.
        out = F.col("sent") * (F.col("reaches") - F.col("got") * F.col("takes"))
        came = F.col("got") * (F.col("reached") - F.col("sent") * F.col("sends"))
        beyond = one_round.join(on, ["Category", "on"]).withColumns({"out": out, "came": came})
        inner = (F.col("sends") - 1) * (F.col("takes") - 1) - F.col("same")
        value = (F.col("sends") - 1) * F.col("out") + F.col("came") * (F.col("takes") - 1) + inner
        added = stages.keep(
            beyond.select(
                *NODE,
                value.cast("double").alias("betweenness"),
                (F.col("out") + F.col("takes")).alias("reaches"),
                (F.col("came") + F.col("sends")).alias("reached"),
            )
        )
        scores.append(added.select(*NODE, "betweenness"))
        known = known.unionByName(added)
    whole = scores[0]
    for more in scores[1:]:
        whole = whole.unionByName(more)
    return whole


def smaller_graph(reduced: Reduced, heavy_rows: int) -> TopicGraph:
    return topic_graph(reduced.edges, heavy_rows, written=True)
