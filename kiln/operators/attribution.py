"""Exact attribution of forest predictions.

The value of a feature is its Shapley value in the game "features of S from the
explained row, the others from a training row", averaged over *all* training
rows. For one leaf the game is a product: with X the path features only the
explained row satisfies and Z those only the training row does, the leaf is
reached exactly by the sets that hold X and miss Z (a feature that neither
satisfies closes the leaf). Its value v then gives every feature of X
``v (|X|-1)! |Z|! / (|X|+|Z|)!`` and every feature of Z
``-v |X|! (|Z|-1)! / (|X|+|Z|)!``.

A training row thus matters only by which path features it satisfies at each
leaf. One aggregate counts the rows by (tree, decisions at its nodes), a second
one by (leaf, satisfied features): at most leaves x 2^features rows, a bound of
the model and not of the table. No row is sampled, none reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decisions that share one long.
BITS = 62


def _walk(node, path: list, splits: list, leaves: list) -> None:
    """Collect the splits ``(feature, threshold)`` and leaves ``(value, path)`` below a fitted node."""
    if node.subtreeDepth() == 0:
        leaves.append((float(node.prediction()), path))
        return
    split, at = node.split(), len(splits)
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only splits of continuous features can be attributed")
    splits.append((split.featureIndex(), float(split.threshold())))
    _walk(node.leftChild(), [*path, (split.featureIndex(), at, True)], splits, leaves)
    _walk(node.rightChild(), [*path, (split.featureIndex(), at, False)], splits, leaves)


def _part(conditions: Sequence[tuple[int, bool]], words: int) -> tuple[list[int], list[int]]:
    """Bits that must be set and must not be set, by word."""
    left, right = [0] * words, [0] * words
    for at, goes_left in conditions:
        (left if goes_left else right)[at // BITS] |= 1 << at % BITS
    return left, right


class ForestPaths:
    """Splits and leaves of a fitted regression forest (mean of its trees)."""

    def __init__(self, forest):
        self.splits, self.leaves = [], []
        for tree, model in enumerate(forest.trees):
            splits, leaves = [], []
            _walk(model._java_obj.rootNode(), [], splits, leaves)
            self.splits.append(splits)
            words = max(1, -(-len(splits) // BITS))
            for leaf, (value, path) in enumerate(leaves):
                features = sorted({f for f, _, _ in path})
                if len(features) > 20:
                    raise ValueError("a path with more than 20 features overflows the factorials")
                parts = [(f, *_part([(at, left) for g, at, left in path if g == f], words)) for f in features]
                self.leaves.append((tree, leaf, value, parts))

    def leaf_table(self, spark) -> DataFrame:
        """One row per leaf; its size is that of the model."""
        return spark.createDataFrame(
            self.leaves, "tree int, leaf int, value double, parts array<struct<feature:int,left:array<bigint>,right:array<bigint>>>"
        )

    def decisions(self, features: str) -> Column:
        """``array<struct<tree, d>>``: the nodes of each tree at which a row goes left, as bits.

        The splits are one folded literal walked by higher-order functions: an
        expression per node would outgrow the limits of generated code.
        """
        words = [[splits[i : i + BITS] for i in range(0, max(1, len(splits)), BITS)] for splits in self.splits]
        nodes = ",".join(f"array({','.join(_word(w) for w in tree)})" for tree in words)
        return F.expr(
            f"transform(array({nodes}), (t, i) -> struct(i AS tree, transform(t, w -> "
            f"aggregate(w, 0L, (acc, s) -> acc + IF({features}[s.f] <= s.at, s.bit, 0L))) AS d))"
        )


def _word(splits: Sequence[tuple[int, float]]) -> str:
    """SQL literal of the splits that share a long."""
    nodes = ",".join(f"named_struct('f', {f}, 'at', {at!r}D, 'bit', {1 << i}L)" for i, (f, at) in enumerate(splits))
    return f"CAST(array({nodes}) AS array<struct<f:int,at:double,bit:bigint>>)"


def _satisfied() -> Column:
    """For each path feature of a leaf, whether the decisions ``d`` keep to the path."""
    return F.expr(
        "transform(parts, p -> forall(sequence(0, size(d) - 1), "
        "i -> (d[i] & p.left[i]) = p.left[i] AND (d[i] & p.right[i]) = 0))"
    )


def forest_attribution(forest, train: DataFrame, explain: DataFrame, key: str, names: Sequence[str],
                       vector: str = "features") -> DataFrame:
    """``key, feature, shapley_value``: a row for every row of ``explain`` and feature.

    ``forest`` is a fitted random-forest regressor over the vector column
    ``vector`` of both frames, whose entries ``names`` names; ``train`` holds
    the background rows, all of which count. The values of a row sum to its
    prediction minus the mean prediction of ``train``. ``key`` names the rows of
    ``explain``; rows that repeat a key would be added up. A feature on no path
    gets 0, an empty ``train`` nulls.
    """
    paths = ForestPaths(forest)
    leaves = paths.leaf_table(train.sparkSession)
    one = F.explode(paths.decisions("x")).alias("t")

    seen = train.select(vector_to_array(vector).alias("x")).select(one)
    patterns = seen.groupBy(F.col("t.tree").alias("tree"), F.col("t.d").alias("d")).agg(F.count("*").alias("n"))
    background = patterns.join(leaves, "tree").groupBy("tree", "leaf", _satisfied().alias("z")).agg(F.sum("n").alias("n"))

    rows = explain.select(F.col(key).alias("id"), vector_to_array(vector).alias("x")).select("id", one)
    rows = rows.select("id", "t.tree", "t.d").join(leaves, "tree")
    rows = rows.select("id", "tree", "leaf", "value", F.col("parts.feature").alias("path"), _satisfied().alias("own"))

    games = rows.join(background, ["tree", "leaf"]).where("forall(zip_with(own, z, (a, b) -> a OR b), r -> r)")
    games = games.withColumn("a", F.expr("size(filter(z, b -> NOT b))")).withColumn("b", F.expr("size(filter(own, a -> NOT a))"))
    fact = F.factorial
    both = fact(F.col("a") + F.col("b")).cast("double")
    gain = fact(F.greatest(F.col("a") - 1, F.lit(0))) * fact(F.col("b")) / both
    loss = fact(F.col("a")) * fact(F.greatest(F.col("b") - 1, F.lit(0))) / both
    games = games.withColumn("gain", F.col("value") * F.col("n") * gain).withColumn("loss", F.col("value") * F.col("n") * loss)
    shares = games.select(
        "id",
        F.explode(F.expr(
            "transform(path, (f, i) -> struct(f AS feature, CASE WHEN own[i] AND NOT z[i] THEN gain WHEN z[i] AND NOT own[i] THEN -loss ELSE 0D END AS share))"
        )).alias("s"),
    )
    total = train.count() * len(forest.trees)
    sums = shares.groupBy("id", F.col("s.feature").alias("feature")).agg(F.sum("s.share").alias("share"))
    every = explain.select(F.col(key).alias("id"), F.posexplode(F.array(*[F.lit(c) for c in names])).alias("feature", "name"))
    value = F.coalesce(F.col("share"), F.lit(0.0)) / F.lit(float(total)) if total else F.lit(None).cast("double")
    return every.join(sums, ["id", "feature"], "left").select(
        F.col("id").alias(key), F.col("name").alias("feature"), value.alias("shapley_value")
    )
