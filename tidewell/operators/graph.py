"""Graph measures over edge tables (src, dst) as joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import durable

CUT_EVERY = 4


def both_ways(edges: DataFrame) -> DataFrame:
    """Undirected form without self-loops and duplicates."""
    pairs = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return pairs.filter(F.col("src") != F.col("dst")).distinct()


def degree_topk(edges: DataFrame, k: int = 10) -> DataFrame:
    """Nodes with the most incident edges; the smaller id wins a tie."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).orderBy(F.col("degree").desc(), "node").limit(k)


def label_propagation(edges: DataFrame, iterations: int) -> DataFrame:
    """Each node takes the most frequent label of its neighbours, the smallest on a tie; synchronous rounds."""
    links = durable(both_ways(edges))
    labels = links.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    for round_no in range(1, iterations + 1):
        votes = (
            links.join(labels, F.col("dst") == F.col("node"))
            .groupBy("src", "label")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        labels = (
            votes.groupBy("src")
            .agg(F.max_by("label", F.struct(F.col("n"), -F.col("label"))).alias("label"))
            .withColumnRenamed("src", "node")
        )
        if round_no % CUT_EVERY == 0 and round_no < iterations:
            labels = durable(labels)
    return labels


def pagerank(edges: DataFrame, damping: float = 0.85, iterations: int = 20) -> DataFrame:
    """PageRank with a fixed number of rounds; the rank of nodes without out-links is shared by all."""
    links = edges.select("src", "dst").distinct()
    degrees = links.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    nodes = durable(
        links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        .join(degrees, F.col("node") == F.col("src"), "left").drop("src")
    )
    links = durable(links)
    count = nodes.count()
    ranks = nodes.withColumn("rank", F.lit(1.0 / max(count, 1)))
    for round_no in range(1, iterations + 1):
        share = ranks.filter(F.col("out_degree").isNotNull()).select(
            F.col("node").alias("src"), (F.col("rank") / F.col("out_degree")).alias("share")
        )
        received = links.join(share, "src").groupBy("dst").agg(F.sum("share").alias("received"))
        lost = ranks.agg(F.coalesce(F.sum(F.when(F.col("out_degree").isNull(), F.col("rank"))), F.lit(0.0)).alias("lost"))
        ranks = (
            nodes.join(received, F.col("node") == F.col("dst"), "left")
            .crossJoin(F.broadcast(lost))
            .select(
                "node", "out_degree",
                ((1 - damping) / count + damping * (F.coalesce("received", F.lit(0.0)) + F.col("lost") / count)).alias("rank"),
            )
        )
        if round_no % CUT_EVERY == 0 and round_no < iterations:
            ranks = durable(ranks)
    return ranks.select("node", "rank")


def transfer_chains(transfers: DataFrame, min_amount: float, since: str, min_hops: int = 2, max_hops: int = 4) -> DataFrame:
    """Chains of transfers with no repeated edge between two different accounts, each above the amount and recent."""
    recent = transfers.filter((F.col("amount") > min_amount) & (F.col("sent_at") > F.lit(since).cast("timestamp"))).select(
        "transfer_id", "src", "dst", F.col("amount").cast("decimal(18,2)").alias("amount")
    )
    step = recent.select(
        F.col("transfer_id").alias("next_id"), F.col("src").alias("next_src"), F.col("dst").alias("next_dst"), F.col("amount").alias("next_amount")
    )
    paths = recent.select(
        F.array("transfer_id").alias("path"), F.col("src").alias("first"), F.col("dst").alias("last"), F.col("amount").cast("decimal(24,2)").alias("total_amount")
    )
    found = []
    for hops in range(2, max_hops + 1):
        paths = (
            paths.join(step, F.col("last") == F.col("next_src"))
            .filter(~F.array_contains("path", F.col("next_id")))
            .select(
                F.concat("path", F.array("next_id")).alias("path"), "first", F.col("next_dst").alias("last"),
                (F.col("total_amount") + F.col("next_amount")).cast("decimal(24,2)").alias("total_amount"),
            )
        )
        if hops >= min_hops:
            found.append(paths.filter(F.col("first") != F.col("last")).withColumn("hops", F.lit(hops)))
    out = reduce(lambda a, b: a.unionByName(b), found)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


def co_purchase(purchases: DataFrame, user, k: int = 10) -> DataFrame:
    """Products bought by users who share products with ``user``; the score counts the connecting paths.

    Paths are counted per other user first, so the second join meets one weighted row per user.
    """
    owned = purchases.filter(F.col("user_id") == user).select("product_id")
    others = (
        purchases.filter(F.col("user_id") != user)
        .join(owned, "product_id", "left_semi")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    return (
        purchases.join(others, "user_id")
        .join(owned, "product_id", "left_anti")
        .groupBy("product_id")
        .agg(F.sum("shared").alias("score"))
        .orderBy(F.col("score").desc(), "product_id")
        .limit(k)
    )


def graph_features(users: DataFrame, friends: DataFrame, purchases: DataFrame) -> DataFrame:
    """Distinct friends (either direction) and distinct purchases per user, 0 when there are none."""
    friend_count = both_ways(friends).groupBy(F.col("src").alias("user_id")).agg(F.count(F.lit(1)).alias("friend_count"))
    bought = purchases.groupBy("user_id").agg(F.count_distinct("product_id").alias("purchase_count"))
    return users.join(friend_count, "user_id", "left").join(bought, "user_id", "left").fillna(
        0, ["friend_count", "purchase_count"]
    )


def build_graph(rows: DataFrame, src: str, dst: str, kind: str, src_label: str = "User", dst_label: str = "Product") -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) merged from rows: one vertex per id and label, one edge per triple with its count."""
    ends = rows.select(
        F.explode(
            F.array(
                F.struct(F.col(src).cast("string").alias("id"), F.lit(src_label).alias("label")),
                F.struct(F.col(dst).cast("string").alias("id"), F.lit(dst_label).alias("label")),
            )
        ).alias("v")
    )
    vertices = ends.select("v.*").filter(F.col("id").isNotNull()).distinct()
    edges = rows.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"), F.upper(kind).alias("kind")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    return vertices, edges


def components(edges: DataFrame) -> DataFrame:
    """Connected components, labelled by their smallest node.

    Each round hooks every node to the smallest label around it and then jumps to that
    label's own label, which shortens long chains by doubling. Stops when nothing changes.
    """
    links = durable(both_ways(edges))
    state = durable(links.select(F.col("src").alias("node")).distinct().withColumn("component", F.col("node")))
    while True:
        near = (
            links.join(state, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("component").alias("near"))
        )
        hooked = state.join(near, F.col("node") == F.col("src"), "left").select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("__old")
        )
        target = hooked.select(F.col("node").alias("__root"), F.col("component").alias("__jump"))
        state = durable(
            hooked.join(target, F.col("component") == F.col("__root"), "left").select(
                "node", F.least("component", "__jump").alias("component"), "__old"
            )
        )
        if state.filter(F.col("component") != F.col("__old")).isEmpty():
            return state.drop("__old")
        state = state.drop("__old")


def shortest_hops(edges: DataFrame, sources: DataFrame, max_hops: int) -> DataFrame:
    """Fewest directed hops from any source, up to ``max_hops``; ``sources`` has a column ``node``."""
    links = durable(edges.select("src", "dst").distinct())
    seen = sources.select("node").distinct().withColumn("hops", F.lit(0))
    for hop in range(1, max_hops + 1):
        frontier = (
            seen.filter(F.col("hops") == hop - 1)
            .join(links, F.col("node") == F.col("src"))
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
            .withColumn("hops", F.lit(hop))
        )
        seen = durable(seen.unionByName(frontier))
    return seen
