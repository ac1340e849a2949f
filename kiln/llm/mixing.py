"""Mixing sources to target weights by min-cost flow.

Sources may overlap: a document belongs to a set of sources, its membership
pattern. Documents are aggregated by pattern; token capacity flows from
patterns to source quotas. The first use of a pattern's tokens is cheap, every
further use costs more (convex repetition costs), so a quota is met with fresh
documents as far as any routing allows. Patterns that share no source are
independent, so each connected group of sources is solved in a task of its own
with one row per (pattern, source); nothing but two sums per round reaches the
driver.

Selection is seeded: within a pattern, documents are ranked by a hash of their
id. The prefix sum of sizes is taken over a fixed number of hash ranges first
(one row each) and then inside the single range in which the quota ends, so no
task sees a whole source. Documents are taken whole; the quota is met to within
half of the document in which it ends.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import keep, n_words
from kiln.llm.components import connected_components

RANGES = 4096
WEIGHTS = (5, 2, 1)


def _offset(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """0-based rank by ``by`` as column ``name``: range partitions, each ranked, plus offsets."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = keep(df.repartitionByRange(n, *[F.asc_nulls_last(c) for c in by]).withColumn("__p", F.spark_partition_id()), "ranked")
    sizes = d.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.select(
        "__p",
        F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
    )
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(*[F.asc_nulls_last(c) for c in by]))
    return d.withColumn("__r", inside - 1).join(before, "__p").withColumn(name, F.col("__off") + F.col("__r")).drop("__p", "__off", "__r")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order (null last) take the weights in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess is shared again until none is above.
    """
    ranked = _offset(sizes, ["source"], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    # per weight, a source is capped once the share per unit of weight reaches this ratio
    s = keep(ranked.select("source", "source_size", w.alias("weight")).withColumn("cap", most * F.col("source_size")), "targets")
    total = s.agg(F.sum("source_size")).collect()[0][0] or 0
    level, budget, capped = 0.0, share * total, -1
    while True:
        free = F.col("cap") > level * F.col("weight") if level else F.col("cap") > 0
        row = s.agg(
            F.sum(F.when(free, F.col("weight"))).alias("w"),
            F.sum(F.when(~free, F.col("cap"))).alias("full"),
            F.count_if(~free).alias("n"),
        ).collect()[0]
        if not row["w"] or row["n"] == capped:
            break
        level, capped = (budget - (row["full"] or 0.0)) / row["w"], row["n"]
    return s.select("source", "source_size", F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def min_cost_flow(supply: list[int], quota: list[int], arcs: list[tuple[int, int]], repeats: int) -> dict[tuple[int, int], int]:
    """Tokens on each (pattern, source) arc, by successive shortest paths.

    Use number k of a pattern's tokens costs k; what the quotas can't get is
    left out. All numbers are integers, so reruns agree.
    """
    start, end = 0, 1 + len(supply) + len(quota)
    graph: list[list[list]] = [[] for _ in range(end + 1)]  # of arcs [to, room, cost, index of the reverse]

    def add(u: int, v: int, room: int, cost: int) -> list:
        graph[u].append([v, room, cost, len(graph[v])])
        graph[v].append([u, 0, -cost, len(graph[u]) - 1])
        return graph[u][-1]

    for p, size in enumerate(supply):
        for k in range(repeats):
            add(start, 1 + p, size, k)
    routes = {(p, s): add(1 + p, 1 + len(supply) + s, supply[p] * repeats, 0) for p, s in arcs}
    for s, q in enumerate(quota):
        add(1 + len(supply) + s, end, q, 0)
    while True:
        cost: list[float] = [math.inf] * (end + 1)
        cost[start], back, queue, queued = 0, [None] * (end + 1), deque([start]), {start}
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for i, (v, room, c, _) in enumerate(graph[u]):
                if room > 0 and cost[u] + c < cost[v]:
                    cost[v], back[v] = cost[u] + c, (u, i)
                    if v not in queued:
                        queue.append(v)
                        queued.add(v)
        if cost[end] == math.inf:
            break
        path, v = [], end
        while v != start:
            u, i = back[v]
            path.append(graph[u][i])
            v = u
        moved = min(a[1] for a in path)
        for a in path:
            a[1] -= moved
            graph[a[0]][a[3]][1] += moved
    return {k: supply[k[0]] * repeats - arc[1] for k, arc in routes.items()}


def _solve(pdf, repeats: int):
    """Flow of one connected group of sources: rows (grp, pattern, supply, source, quota)."""
    import pandas as pd

    pdf = pdf.sort_values(["pattern", "source"], na_position="last")
    patterns, sources = list(dict.fromkeys(pdf["pattern"])), list(dict.fromkeys(pdf["source_key"]))
    p_at, s_at = {x: i for i, x in enumerate(patterns)}, {x: i for i, x in enumerate(sources)}
    supply = pdf.drop_duplicates("pattern")["supply"].tolist()
    by_source = dict(zip(pdf["source_key"], pdf["quota"]))
    arcs = [(p_at[p], s_at[s]) for p, s in zip(pdf["pattern"], pdf["source_key"])]
    flow = min_cost_flow([int(x) for x in supply], [int(by_source[s]) for s in sources], arcs, repeats)
    got = [0] * len(patterns)
    for (p, _), moved in flow.items():
        got[p] += moved
    return pd.DataFrame({"pattern": patterns, "quota": got})


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    size: Column | None = None,
    sources: Column | None = None,
    seed: int = 7,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """The mix and the targets of its sources.

    The mix has one row per input row: ``id, sources, size, uses``; ``uses`` is 0
    to ``repeats``. The targets have one row per source: ``source, source_size,
    target``.

    ``size``: words of column ``text`` by default (null: 0). ``sources``: an
    array of source names, by default the one of column ``source`` (null is a
    source of its own, last in order; an empty array belongs to none).
    * texts without words have size 0, take nothing from a quota and are used once at least;
    * equal ids rank together: repeated rows are ordered by their size;
    * an empty table gives an empty table; other columns are ignored.
    """
    size = n_words(F.col("text")) if size is None else size
    sources = F.array("source") if sources is None else sources
    d = keep(
        docs.select(
            F.col(id_col).alias("id"), size.cast("long").alias("size"), F.array_sort(F.array_distinct(sources)).alias("pattern")
        ).withColumn("h", F.xxhash64(F.lit(seed), F.col("id").cast("string"))),
        "sizes",
    )
    patterns = keep(d.groupBy("pattern").agg(F.sum("size").alias("supply")), "patterns")
    arcs = patterns.select("pattern", "supply", F.explode("pattern").alias("source"))
    targets = source_targets(
        arcs.groupBy("source").agg(F.sum("supply").alias("source_size")), weights, share, repeats
    )
    quotas = keep(
        arcs.join(targets.select("source", F.round("target").cast("long").alias("quota")), arcs["source"].eqNullSafe(targets["source"]))
        .select("pattern", "supply", arcs["source"], "quota"),
        "quotas",
    )
    key = lambda c: F.when(c.isNull(), "1").otherwise(F.concat(F.lit("0"), c))
    named = quotas.withColumn("source_key", key(F.col("source"))).withColumn("pattern", F.to_json("pattern", {"ignoreNullFields": "false"}))
    # sources that share a pattern are solved together; most often each is alone
    first = F.min("source_key").over(Window.partitionBy("pattern"))
    links = named.withColumn("first", first).where("first <> source_key").select("source_key", "first")
    group = connected_components(links)
    grouped = named.join(group, named["source_key"] == group["node"], "left").select(
        F.coalesce("component", "source_key").alias("grp"), "pattern", "supply", "source", "source_key", "quota"
    )
    solved = grouped.groupBy("grp").applyInPandas(lambda pdf: _solve(pdf, repeats), "pattern string, quota long")
    return _select(d.withColumn("p", F.to_json("pattern", {"ignoreNullFields": "false"})), patterns, solved, repeats).select(
        F.col("id").alias(id_col), F.col("pattern").alias("sources"), "size", "uses"
    ), targets


def _select(d: DataFrame, patterns: DataFrame, solved: DataFrame, repeats: int) -> DataFrame:
    """Seeded choice: every document ``quota // supply`` times, the first ones by hash once more."""
    want = keep(
        patterns.select(F.to_json("pattern", {"ignoreNullFields": "false"}).alias("p"), "supply")
        .join(solved.withColumnRenamed("pattern", "p"), "p", "left")
        .select(
            "p",
            F.when(F.col("supply") > 0, F.least(F.floor(F.col("quota") / F.col("supply")), F.lit(repeats))).otherwise(1).cast("long").alias("base"),
            "supply",
            F.coalesce("quota", F.lit(0)).alias("quota"),
        )
        .select("p", F.coalesce("base", F.lit(0).cast("long")).alias("base"), (F.col("quota") - F.coalesce("base", F.lit(0)) * F.col("supply")).alias("rest")),
        "want",
    )
    r = F.shiftrightunsigned("h", 64 - int(math.log2(RANGES)))
    per = d.groupBy("p", r.alias("r")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("p").orderBy("r").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranges = (
        per.withColumn("upto", upto)
        .join(want, "p")
        .withColumn("before", F.col("upto") - F.col("n"))
        .select("p", "r", "base", "rest", "before", F.when(F.col("upto") <= F.col("rest"), 1).when(F.col("before") >= F.col("rest"), 0).alias("more"))
    )
    x = d.withColumn("r", r).join(ranges, ["p", "r"])
    # only the range in which a quota ends is ranked document by document
    edge = x.where("more IS NULL")
    order = Window.partitionBy("p", "r").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("at", F.col("before") + F.sum("size").over(order)).withColumn(
        "more", (F.col("at") - F.col("size") / 2 <= F.col("rest")).cast("int")
    ).drop("at")
    return x.where("more IS NOT NULL").unionByName(edge).withColumn(
        "uses", F.least(F.greatest(F.col("base") + F.col("more"), (F.col("size") == 0).cast("long")), F.lit(repeats))
    )
