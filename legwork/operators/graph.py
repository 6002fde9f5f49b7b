"""Undirected graph metrics as joins and aggregations.

Iterative jobs write their state to the checkpoint folder every round, so a lost executor
costs one round and the plan stays short. Neighbour lists are never collected for the
raw graph; only the degree-oriented lists are, and those hold at most sqrt(2 * edges)
ids however large a hub is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwork.functions.scalars import countries_of, ratio
from legwork.operators.profile import describe
from legwork.operators.ranking import exact_quantiles
from legwork.session import cut_lineage, cut_to_table


def undirected(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, as (a, b) with a < b; loops are left out."""
    pairs = edges.select(
        F.least("src_id", "target_id").alias("a"), F.greatest("src_id", "target_id").alias("b")
    )
    return pairs.filter("a < b").distinct()


def both_ways(pairs: DataFrame) -> DataFrame:
    """Symmetric adjacency (src, dst) of undirected edges."""
    ends = F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst")),
    )
    return pairs.select(F.inline(ends))


def all_ids(nodes: DataFrame) -> DataFrame:
    """Every id from 0 to the largest one; ids without a row count as isolated nodes."""
    top = nodes.agg(F.max("id").alias("top")).first()["top"]
    return nodes.sparkSession.range(0, -1 if top is None else top + 1)


def degrees(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Degree of every id, 0 for isolated ones."""
    counted = both_ways(pairs).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return ids.join(counted, "id", "left").fillna(0, subset=["degree"])


def degree_summary(degree: DataFrame) -> DataFrame:
    """Mean, largest and median degree."""
    keyed = degree.select(F.lit(0).alias("k"), "degree")
    middle = exact_quantiles(keyed, ["k"], "degree", {"median": 0.5}).agg(F.max("median")).scalar()
    return degree.agg(F.avg("degree").alias("mean"), F.max("degree").alias("max")).withColumn("median", middle)


def components(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Smallest id of the component of every id.

    Alternates two star steps until nothing changes: every node's larger neighbours move
    to the smallest neighbour, then the smaller ones do. The number of rounds grows
    with the logarithm of the longest path. Pairs (a < b) and ids may be of any ordered type.
    """
    current = cut_to_table(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")), "stars")
    mark = _edge_mark(current)
    while mark[0]:
        # large star
        sym = current.select("u", "v").union(current.select("v", "u")).toDF("u", "v")
        least = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        linked = sym.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = linked.filter("u <> v").distinct()
        # small star
        low = linked.groupBy("u").agg(F.min("v").alias("m"))
        moved = linked.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = low.select("u", F.col("m").alias("v"))
        current = cut_to_table(moved.union(kept).filter("u <> v").distinct(), "stars")
        previous, mark = mark, _edge_mark(current)
        if mark == previous:
            break
    roots = current.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return ids.join(roots, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _edge_mark(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge set."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return (row["n"], row["h"])


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def oriented(pairs: DataFrame) -> DataFrame:
    """Edges from the lower to the higher (degree, id) end."""
    degree = both_ways(pairs).groupBy("src").agg(F.count(F.lit(1)).alias("d"))
    a = degree.select(F.col("src").alias("a"), F.col("d").alias("da"))
    b = degree.select(F.col("src").alias("b"), F.col("d").alias("db"))
    ends = pairs.join(a, "a").join(b, "b")
    forward = F.struct("da", "a") < F.struct("db", "b")
    return ends.select(
        F.when(forward, F.col("a")).otherwise(F.col("b")).alias("low"),
        F.when(forward, F.col("b")).otherwise(F.col("a")).alias("high"),
    )


def triangles(pairs: DataFrame) -> DataFrame:
    """Number of triangles at every node that has one.

    Every edge intersects the oriented neighbour lists of its two ends; only the found
    third corners become rows, no candidate pairs.
    """
    arcs = cut_lineage(oriented(pairs))
    lists = arcs.groupBy("low").agg(F.collect_list("high").alias("out"))
    from_low = lists.select("low", F.col("out").alias("out_low"))
    from_high = lists.select(F.col("low").alias("high"), F.col("out").alias("out_high"))
    third = F.array_intersect("out_low", "out_high")
    closed = arcs.join(from_low, "low").join(from_high, "high").select("low", "high", third.alias("third"))
    closed = closed.filter(F.size("third") > 0)
    corners = closed.select(
        F.inline(
            F.concat(
                F.array(
                    F.struct(F.col("low").alias("id"), F.size("third").cast("bigint").alias("n")),
                    F.struct(F.col("high").alias("id"), F.size("third").cast("bigint").alias("n")),
                ),
                F.transform("third", lambda w: F.struct(w.alias("id"), F.lit(1).cast("bigint").alias("n"))),
            )
        )
    )
    return corners.groupBy("id").agg(F.sum("n").alias("triangles"))


def clustering(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Local clustering coefficient, 0 below two neighbours."""
    joined = degrees(pairs, ids).join(triangles(pairs), "id", "left").fillna(0, subset=["triangles"])
    possible = F.col("degree") * (F.col("degree") - 1)
    return joined.withColumn("clustering_coeff", ratio(2 * F.col("triangles"), possible)).drop("triangles")


def _held(links: DataFrame, key: str) -> DataFrame:
    """Links written once and held by ``key``: a round that joins them by it moves the nodes only."""
    spark = links.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return cut_to_table(links, "links").repartition(parts, key).persist()


def pagerank(
    pairs: DataFrame, ids: DataFrame, alpha: float = 0.85, max_rounds: int = 100, tolerance: float | None = 1e-6
) -> DataFrame:
    """PageRank by power iteration; rank of nodes without edges is spread evenly.

    Stops when the summed change falls below ``tolerance``; None runs all rounds.
    """
    degree = cut_lineage(degrees(pairs, ids))
    links = _held(
        both_ways(pairs)
        .join(degree.select(F.col("id").alias("src"), "degree"), "src")
        .select("src", "dst", (1.0 / F.col("degree")).alias("share")),
        "src",
    )
    n = degree.count()
    ranks = cut_lineage(degree.select("id", "degree", F.lit(1.0 / n).alias("pagerank")))
    for _ in range(max_rounds):
        received = (
            links.join(ranks.select(F.col("id").alias("src"), "pagerank"), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("pagerank") * F.col("share")).alias("received"))
        )
        loose = ranks.agg(F.coalesce(F.sum(F.when(F.col("degree") == 0, F.col("pagerank"))), F.lit(0.0))).scalar()
        base = alpha * loose / n + (1 - alpha) / n
        following = ranks.join(received, "id", "left").select(
            "id",
            "degree",
            (alpha * F.coalesce("received", F.lit(0.0)) + base).alias("pagerank"),
            F.col("pagerank").alias("_old"),
        )
        following = cut_lineage(following)
        ranks = following.drop("_old")
        if tolerance is not None:
            change = following.agg(F.sum(F.abs(F.col("pagerank") - F.col("_old")))).first()[0]
            if change < tolerance:
                break
    links.unpersist()
    return ranks.select("id", "pagerank")


def core_numbers(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Core number of every id.

    Each round replaces a node's value by the h-index of its neighbours' values until
    nothing changes. The values are counted per node first; a node sees at most
    as many distinct values as there are distinct degrees.
    """
    adjacency = _held(both_ways(pairs), "dst")
    values = cut_to_table(degrees(pairs, ids).select("id", F.col("degree").alias("core")), "cores")
    while True:
        seen = (
            adjacency.join(values.select(F.col("id").alias("dst"), F.col("core").alias("c")), "dst")
            .groupBy(F.col("src").alias("id"), "c")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        at_least = F.sum("n").over(
            Window.partitionBy("id").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
        )
        h = seen.withColumn("h", F.least(at_least, F.col("c"))).groupBy("id").agg(F.max("h").alias("h"))
        updated = values.join(h, "id", "left").select(
            "id", F.least(F.col("core"), F.coalesce("h", F.lit(0))).alias("core"), F.col("core").alias("_old")
        )
        updated = cut_to_table(updated, "cores")
        values = updated.drop("_old")
        if updated.filter("core <> _old").isEmpty():
            adjacency.unpersist()
            return values.withColumnRenamed("core", "core_number")


def network_summary(pairs: DataFrame, ids: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes, edges, density, components and the extremes of their sizes, one row."""
    sizes = component_sizes(labels)
    edges = pairs.agg(F.count(F.lit(1))).scalar()
    nodes = ids.agg(F.count(F.lit(1))).scalar()
    top = sizes.orderBy(F.desc("size"), "component").limit(5).agg(F.sort_array(F.collect_list("size"), False)).scalar()
    return sizes.agg(
        F.count(F.lit(1)).alias("n_components"),
        F.max("size").alias("largest_component"),
        F.min("size").alias("smallest_component"),
    ).select(
        nodes.alias("n_nodes"),
        edges.alias("n_edges"),
        (2 * edges / (nodes * (nodes - 1.0))).alias("density"),
        "*",
        F.array_join(top.cast("array<string>"), ",").alias("top_sizes"),
        (F.col("n_components") == 1).cast("int").alias("is_connected"),
    )


def enhanced_nodes(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Node attributes with degree, clustering, PageRank and core number."""
    pairs = cut_lineage(pairs)
    ids = cut_lineage(all_ids(nodes))
    metrics = (
        clustering(pairs, ids)
        .join(pagerank(pairs, ids), "id")
        .join(core_numbers(pairs, ids), "id")
    )
    return nodes.join(metrics, "id", "left")


def dataset_summary(nodes: DataFrame, top_languages: int = 3) -> DataFrame:
    """Positive shares, means, medians and skew of the targets, and the largest languages."""
    flags = [c for c in ("affiliate_status", "explicit_content", "dead_account") if c in nodes.columns]
    numbers = [c for c in ("view_count", "account_lifetime") if c in nodes.columns]
    n = F.count(F.lit(1))
    shares = nodes.agg(
        F.array(*[F.struct(F.lit(c).alias("item"), F.lit("positive_pct").alias("measure"),
                           (F.avg(c) * 100).alias("value")) for c in flags]).alias("r")
    ).select(F.inline("r"))
    stats = describe(nodes, numbers).unpivot(["column"], ["mean", "median", "skew"], "measure", "value")
    counts = nodes.groupBy(F.col("language").alias("item")).agg(n.alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    languages = counts.orderBy(F.desc("rows"), "item").limit(top_languages).select(
        "item", F.lit("language_pct").alias("measure"), (F.col("rows") / total * 100).alias("value")
    )
    return shares.union(stats.select(F.col("column").alias("item"), "measure", "value")).union(languages)


def country_users(nodes: DataFrame) -> DataFrame:
    """Users per country: every country of a language gets all users of the language."""
    counts = nodes.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.select(F.explode(countries_of(F.col("language"))).alias("country"), "n")
    return spread.groupBy("country").agg(F.sum("n").alias("users"))
