"""Boosted classifiers from folded rows: equal rows become one row with a weight, and a check over all rows says that
nothing was lost by it.

A tree sees of a row only the features that the trees split on. Rows that agree in these and in the label stay
together in every round, so Spark's trainer may learn from one weighted row for all of them, and a round costs what
their different values cost, however many rows there are. Which features the trees split on is guessed from one round
over all rows, and then checked: for every node of every round, the gain of every split on each feature left out comes
from counts over all training rows. A feature that beats a split of the trees is added, and the fit is done again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from threading import Lock

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators.ranking import prefix_sums
from fieldlens.session import discard, stored

# --- fixed values: different folded rows at most, and rows that one of them must stand for on average ------------
MOST_CELLS, LEAST_FOLD = 50_000, 20
# Gains that differ by less, relative to the node's mean square, are equal but for rounding.
ROUNDING = 1e-9
# ------------------------------------------------------------------------------


class Folding:
    """Rows of fits (``features``, ``target``, ``__held``), folded by the features that trees split on."""

    def __init__(self, rows: DataFrame, n: int, target: str, bins: int):
        self.rows, self.n, self.target, self.bins = rows, n, target, bins
        self.width = None
        self.train = rows.filter(~F.col("__held"))
        self._made, self._lock, self._tables = {}, Lock(), []

    def _once(self, key, make):
        with self._lock:
            if key not in self._made:
                self._made[key] = make()
            return self._made[key]

    def _stored(self, df: DataFrame, label: str) -> tuple[DataFrame, int]:
        table, n = stored(df, label)
        self._tables.append(table)
        return table, n

    def discard(self) -> None:
        for table in self._tables:
            discard(table)

    def _values(self, rows: DataFrame) -> DataFrame:
        """Each feature as a column ``f<number>``."""
        if self.width is None:
            self.width = len(rows.select("features").first()["features"])
        return rows.withColumn("__v", vector_to_array("features")).select(
            self.target, "__held", *[F.col("__v")[i].alias(f"f{i}") for i in range(self.width)])

    def cells(self, active: tuple[int, ...]) -> DataFrame | None:
        """One row per different (active features, target, held back), its number of rows as ``__n``; other features are 0.

        None if they are too many to be worth it.
        """
        def make():
            names = [f"f{i}" for i in active]
            folded = self._values(self.rows).groupBy(*names, self.target, "__held").agg(
                F.count(F.lit(1)).cast("double").alias("__n"))
            vector = array_to_vector(F.array(*[F.col(f"f{i}") if i in active else F.lit(0.0) for i in range(self.width)]))
            table, n = self._stored(folded.select(vector.alias("features"), self.target, "__held", "__n"), "fold-cells")
            return table if n <= MOST_CELLS and n * LEAST_FOLD <= self.n else None
        return self._once(("cells", active), make)

    def lows(self) -> dict[int, list[float]]:
        """The lowest value of each bin of a feature: every value is a bin, or, beyond ``bins`` values, bins hold about
        equally many training rows, as in Spark's trees. At most ``bins`` numbers a feature reach the driver."""
        def make():
            values = self._values(self.train).select(F.posexplode(F.array(*[f"f{i}" for i in range(self.width)])).alias("j", "value"))
            counts = values.groupBy("j", "value").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
            middle = F.col("prior_n") + F.col("n") / 2
            placed = prefix_sums(counts, ["j"], "value", ["n", "one"]).withColumn("bin", F.when(
                F.col("total_one") <= self.bins, F.col("prior_one")).otherwise(F.floor(middle * self.bins / F.col("total_n"))))
            out = {}
            for r in placed.groupBy("j", "bin").agg(F.min("value").alias("low")).collect():
                out.setdefault(r["j"], []).append(r["low"])
            return {j: sorted(v) for j, v in out.items()}
        return self._once("lows", make)

    def counts(self, active: tuple[int, ...]) -> DataFrame | None:
        """Training rows per cell, label and bin of each feature left out: cell, target, j, bin, n. None if none can split."""
        lows = self.lows()
        rest = [j for j in sorted(lows) if j not in active and len(lows[j]) > 1]

        def make():
            binned = Bucketizer(inputCols=[f"f{j}" for j in rest], outputCols=[f"b{j}" for j in rest], splitsArray=[
                [-float("inf"), *lows[j][1:], float("inf")] for j in rest]).transform(self._values(self.train))
            pairs = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b{j}").cast("int").alias("bin")) for j in rest])
            names = [f"f{i}" for i in active]
            counted = binned.select(*names, self.target, F.inline(pairs)).groupBy(*names, self.target, "j", "bin").agg(
                F.count(F.lit(1)).alias("n"))
            return self._stored(counted, "fold-counts")[0]
        return self._once(("counts", active), make) if rest else None


def tree_tables(model) -> list[dict[str, np.ndarray]]:
    """The nodes of each tree of a model, or of a model that is one, in order: split feature (-1: leaf), threshold, children, gain, prediction, depth."""
    out = []
    for tree in getattr(model, "trees", None) or [model]:
        rows, todo = [], [(tree._java_obj.rootNode(), 0, None)]
        while todo:
            node, depth, parent = todo.pop()
            if parent is not None:
                rows[parent[0]][parent[1]] = len(rows)
            leaf = node.getClass().getSimpleName() == "LeafNode"
            at = len(rows)
            rows.append({"feature": -1 if leaf else node.split().featureIndex(), "threshold": 0.0 if leaf else node.split().threshold(),
                         "left": at, "right": at, "gain": 0.0 if leaf else node.gain(), "prediction": node.prediction(), "depth": depth})
            if not leaf:
                todo += [(node.leftChild(), depth + 1, (at, "left")), (node.rightChild(), depth + 1, (at, "right"))]
        out.append({c: np.array([r[c] for r in rows]) for c in rows[0]})
    return out


def node_sums(counts: DataFrame, trees: Sequence[dict[str, np.ndarray]], weights: Sequence[float], active: Sequence[int],
              target: str, width: int, bins: int, depth: int) -> DataFrame:
    """What each round's trees fit, summed up per node, left-out feature and bin: tree, node, j, bin, n, s, q (of squares).

    A node that may not split any more, for its depth, does not count. A batch of counts goes through all rounds.
    """
    places = {i: k for k, i in enumerate(active)}
    names = [f"f{i}" for i in active]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, n = batch[names].to_numpy(float), batch["n"].to_numpy(float)
            y = 2.0 * batch[target].to_numpy(float) - 1.0
            key = batch["j"].to_numpy() * (bins + 1) + batch["bin"].to_numpy()
            score, cells, line = np.zeros(len(x)), width * (bins + 1), np.arange(len(x))
            for t, tree in enumerate(trees):
                r = y if t == 0 else 4.0 * y / (1.0 + np.exp(2.0 * y * score))     # the first tree fits the labels
                at, nodes = np.zeros(len(x), int), len(tree["depth"])
                held = sums.setdefault(t, np.zeros((3, nodes * cells)))
                column = np.array([places.get(f, 0) for f in tree["feature"]])
                for level in range(depth):
                    here = tree["depth"][at] == level
                    slot = at[here] * cells + key[here]
                    for k, v in enumerate((n, n * r, n * r * r)):
                        held[k] += np.bincount(slot, v[here], nodes * cells)
                    left = x[line, column[at]] <= tree["threshold"][at]
                    at = np.where(tree["feature"][at] < 0, at, np.where(left, tree["left"][at], tree["right"][at]))
                score = score + weights[t] * tree["prediction"][at]
        for t, held in sums.items():
            slot = np.flatnonzero(held[0])
            node, rest = slot // (width * (bins + 1)), slot % (width * (bins + 1))
            yield pd.DataFrame({"tree": t, "node": node, "j": rest // (bins + 1), "bin": rest % (bins + 1),
                                "n": held[0][slot], "s": held[1][slot], "q": held[2][slot]})

    parts = counts.mapInPandas(walk, "tree long, node long, j long, bin long, n double, s double, q double")
    return parts.groupBy("tree", "node", "j", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])


def beaten_by(sums: DataFrame, trees: Sequence[dict[str, np.ndarray]], least: int) -> set[int]:
    """Features whose best split of some node gains more than the tree's own, with ``least`` rows or more on each side."""
    whole = Window.partitionBy("tree", "node", "j")
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = sums.select("tree", "node", "j", *[F.sum(c).over(w).alias(c + end) for c in ("n", "s") for w, end in ((running, "_l"), (whole, ""))],
                        F.sum("q").over(whole).alias("q")).filter((F.col("n_l") >= least) & (F.col("n") - F.col("n_l") >= least))
    n, s, n_l, s_l = (F.col(c) for c in ("n", "s", "n_l", "s_l"))
    gain = (s_l * s_l / n_l + (s - s_l) * (s - s_l) / (n - n_l) - s * s / n) / n
    known = sums.sparkSession.createDataFrame(pd.DataFrame(
        [(t, k, float(g)) for t, tree in enumerate(trees) for k, g in enumerate(tree["gain"])], columns=["tree", "node", "own"]))
    more = split.join(F.broadcast(known), ["tree", "node"]).filter(
        gain > F.col("own") * (1 + ROUNDING) + ROUNDING * F.col("q") / n)
    return {r["j"] for r in more.select("j").distinct().collect()}


def _unstopped(trainer, rounds: int):
    """The same trainer without an early stop."""
    out = trainer.copy().setMaxIter(rounds)
    out.clear(out.validationIndicatorCol)
    return out


def weighted(trainer, learned: DataFrame):
    """The same trainer for folded rows; None if there are too few rows to split.

    A folded row is many rows, so the least rows of a node are asked for as weight.
    """
    least, n = trainer.getMinInstancesPerNode(), learned.agg(F.sum("__n").alias("n")).first()["n"] or 0.0
    return None if n < 2 * least else trainer.copy().setWeightCol("__n").setMinInstancesPerNode(1).setMinWeightFractionPerNode((least - 0.5) / n)


def fit_folded(trainer, folding: Folding, whole: DataFrame):
    """The classifier that ``trainer`` makes from all rows, learned from folded rows; None where folding does not help.

    ``whole`` has the rows as the trainer would take them.
    """
    first = _unstopped(trainer, 1).fit(whole.filter(~F.col("__held")))
    active = set(first.featureImportances.indices.tolist())
    while active:
        chosen = tuple(sorted(active))
        cells = folding.cells(chosen)
        if cells is None:
            return None
        made = checked_fit(trainer, cells, lambda: folding.counts(chosen), chosen, folding.target, folding.width, folding.bins)
        if made is None or not made[1]:
            return made and made[0]
        active |= made[1]
    return None


def checked_fit(trainer, cells: DataFrame, counts: Callable[[], DataFrame | None], active: tuple[int, ...], target: str, width: int,
                bins: int) -> tuple | None:
    """The classifier from folded rows, and the features left out that some node of some round should have split on.

    The round that ends an early stop is not in the model; its tree is fitted again for the check, because the stop
    depends on it. None if there are too few rows to split.
    """
    least, depth = trainer.getMinInstancesPerNode(), trainer.getMaxDepth()
    cells = cells.coalesce(1)                                                # at most MOST_CELLS rows
    learned = cells.filter(~F.col("__held"))
    light = weighted(trainer, learned)
    if light is None:
        return None
    model = light.fit(cells)
    left_out = counts()
    if left_out is None:
        return model, set()
    trees, weights = tree_tables(model), list(model.treeWeights)
    if model.getNumTrees < trainer.getMaxIter():
        trees, weights = trees + tree_tables(_next_tree(light, model, learned)), [*weights, trainer.getStepSize()]
    return model, beaten_by(node_sums(left_out, trees, weights, active, target, width, bins, depth), trees, least)


def _next_tree(light, model, learned: DataFrame):
    """The tree that boosting would fit after those of the model: the gradient of its loss at every row."""
    y, score = 2 * F.col(light.getLabelCol()) - 1, vector_to_array(F.col(model.getRawPredictionCol()))[1]
    left = model.transform(learned).select("features", "__n", (4 * y / (1 + F.exp(2 * y * score))).alias("__left"))
    return DecisionTreeRegressor(labelCol="__left", weightCol="__n", maxDepth=light.getMaxDepth(), maxBins=light.getMaxBins(),
                                 minInstancesPerNode=1, minWeightFractionPerNode=light.getMinWeightFractionPerNode(),
                                 seed=light.getSeed()).fit(left)
