"""Tuning, alone or with the final fits: what the classifiers of all folds and of all rows need comes from one set of counts.

A fold's rows differ from those of the others by a third only, so nothing is computed per fold on rows. The rows are
counted once, by their given values and their fold; medians, modes, codes, folded rows and the counts that prove them
(see ``folding``) are sums of these over the folds that a fit learns from. Only the regressor goes over all rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators import evaluation as ev
from fieldlens.operators import folding as fo
from fieldlens.operators import modelling as ml
from fieldlens.operators.ranking import exact_percentiles, prefix_sums, row_positions
from fieldlens.session import discard, ensure_checkpointing, stored

# Share of the label's variance from which a feature is taken to tell it by itself, and deviations that it must be beyond
# chance; what is missed is found by the check.
TELLS, BEYOND = 0.001, 5


def tune_and_fit(train: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str, label: str, group: str, folds: int = 3):
    """The threshold of the best F1 out of fold, and features, regressor and classifier of all rows (ML-5, ML-6, ML-9).

    Few rows, and rows that do not fold, are tuned and fitted by ``modelling`` alone.
    """
    tuned = lambda: ml.tune_classifier(
        train, numeric, text, label, group, [ml.CLASSIFICATION], folds, by_counts=False).first()["threshold"]
    if train.count() < ml.FOLD_ROWS:
        threshold, features = tuned(), ml.fit_features(train, numeric, text)
        return threshold, features, *ml.fit_both(train, features, target, label, group)
    counted = Counted(train, numeric, text, label, group, folds)
    features = counted.features(folds)
    with ThreadPoolExecutor(folds + 2) as pool:
        regressor = pool.submit(ml.fit_regressor, train, features, target, ml.REGRESSION, group)
        guess = counted.guess()
        made = list(pool.map(lambda k: counted.classifier(*counted.fit_rows(k), ml.CLASSIFICATION),
                             counted.fits)) if guess and counted.fold(guess) else [None]
        regressor = regressor.result()
    if all(m is not None and not m[1] for m in made):
        models = [m[0] for m in made]
        out = counted.threshold(models), features, regressor, models[folds]
    else:
        out = tuned(), features, regressor, ml.fit_classifier(train, features, label, ml.CLASSIFICATION, group)
    counted.discard()
    return out


def counted_scores(train: DataFrame, numeric: Sequence[str], text: Sequence[str], label: str, group: str,
                   settings: Sequence[ml.Boosting], folds: int, at_once: int) -> tuple[Counted, list[DataFrame]] | None:
    """The counts of the training rows, and for each of the settings what the models say of the folds that they have not seen.

    All fits of a fold learn from the same folded rows. Features that the check of a fit finds are added, and that fit is
    done again. None if the rows do not fold.
    """
    counted = Counted(train, numeric, text, label, group, folds, whole=False)
    active, models, tried = set(counted.guess()), {}, set()
    todo = [(number, k) for number in range(len(settings)) for k in counted.fits]
    while todo:
        if not active or not counted.fold_some(active, max(settings, key=lambda s: s.depth)) or counted.active in tried:
            counted.discard()
            return None
        tried.add(counted.active)
        with ThreadPoolExecutor(at_once) as pool:
            parts = dict(zip(counted.fits, pool.map(counted.fit_rows, counted.fits)))
            made = dict(zip(todo, pool.map(lambda job: counted.classifier(*parts[job[1]], settings[job[0]]), todo)))
        if None in made.values():
            counted.discard()
            return None
        models |= {job: model for job, (model, missed) in made.items() if not missed}
        todo = [job for job in todo if job not in models]
        active = {*counted.active, *(i for _, missed in made.values() for i in missed)}
    return counted, [counted.scores([models[number, k] for k in counted.fits]) for number in range(len(settings))]


class Counted:
    """Training rows counted by fold and given value. Fit ``k`` learns from all folds but ``k``; with ``whole``, fit ``folds``
    learns from all rows."""

    def __init__(self, train: DataFrame, numeric: Sequence[str], text: Sequence[str], label: str, group: str, folds: int,
                 whole: bool = True):
        self.numeric, self.text, self.folds, self.fits = tuple(numeric), tuple(text), folds, range(folds + whole)
        self.names = [*numeric, *text]
        self._tables, self._features = [], {}
        fold_of = ev.group_folds(train, group, folds).select(group, "fold")
        rows = train.select(group, F.col(label).alias("__label"), *[F.col(c).cast("double").alias(c) for c in numeric],
                            *[F.col(c).cast("string").alias(c) for c in text]).join(fold_of, group, "left")
        self.rows, self.n = self._stored(rows.select(
            F.coalesce("fold", F.lit(-1)).cast("int").alias("__fold"), ml.held_back(group).alias("__held"), "__label", *self.names), "folds")
        with ThreadPoolExecutor(4) as pool:
            self.numbers, self.texts = pool.map(lambda columns: self._stored(self._values(columns), "values")[0], (numeric, text))
            fitted = pool.submit(self._fit_features)
            self.placed = dict(zip(("number", "text"), pool.map(self._bins, (self.numbers, self.texts))))
            fitted.result()
        self.lows, self.tells = {}, {}
        sums = reduce(lambda a, b: a.unionByName(b), [
            p.groupBy("column_name", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"),
                                                (F.min("value") if kind == "number" else F.lit(0.0)).alias("low"))
            for kind, p in self.placed.items()])
        for r in sorted(sums.collect(), key=lambda r: (r["column_name"], r["bin"])):
            self.lows.setdefault(r["column_name"], []).append(r["low"])
            self.tells.setdefault(r["column_name"], []).append((r["n"], r["pos"]))

    def _stored(self, df: DataFrame, label: str) -> tuple[DataFrame, int]:
        table, n = stored(df, label)
        self._tables.append(table)
        return table, n

    def discard(self) -> None:
        for table in self._tables:
            discard(table)

    def _values(self, columns: Sequence[str]) -> DataFrame:
        """Rows of each value of each column, by fold, held back or not, and label. One column is read at a time."""
        return reduce(lambda a, b: a.unionByName(b), [
            self.rows.groupBy("__fold", "__held", "__label", F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn(
                "column_name", F.lit(c)) for c in columns])

    def _bins(self, values: DataFrame) -> DataFrame:
        """The bin of each value that a fit may learn from, in the order of the values: see ``Folding.lows``."""
        known = values.filter(~F.col("__held") & F.col("value").isNotNull()).groupBy("column_name", "value").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("__label"), F.col("n")).otherwise(0)).alias("pos"), F.lit(1).alias("one"))
        place = F.when(F.col("total_one") <= ml.BINS, F.col("prior_one")).otherwise(
            F.floor((F.col("prior_n") + F.col("n") / 2) * ml.BINS / F.col("total_n")))
        placed = prefix_sums(known, ["column_name"], "value", ["n", "one"]).withColumn("place", place)
        order = placed.select("column_name", "place").distinct().withColumn(          # at most BINS a column
            "bin", F.row_number().over(Window.partitionBy("column_name").orderBy("place")) - 1)
        return self._stored(placed.join(F.broadcast(order), ["column_name", "place"]).select(
            "column_name", "value", "n", "pos", F.col("bin").cast("int").alias("bin")), "bins")[0]

    def _learns(self, k: Column | int) -> Column:
        """Whether fit ``k`` learns from a row; rows without a group are in no fold."""
        k = F.lit(k) if isinstance(k, int) else k
        return (k == self.folds) | ((F.col("__fold") >= 0) & (F.col("__fold") != k))

    def _of_fits(self, values: DataFrame) -> DataFrame:
        fits = F.filter(F.array(*[F.lit(k) for k in self.fits]), self._learns)
        return values.withColumn("fit", F.explode(fits)).groupBy("fit", "column_name", "value").agg(F.sum("n").alias("n"))

    def _fit_features(self) -> None:
        """Medians, modes and codes of every fit, as ``fit_features`` has them."""
        medians, modes, fits = {}, {}, self.fits
        for r in exact_percentiles(self._of_fits(self.numbers), ["fit", "column_name"], "value", {"middle": 0.5}, weight="n").collect():
            medians.setdefault(r["fit"], {})[r["column_name"]] = r["middle"]
        words = self._of_fits(self.texts).filter("value IS NOT NULL")
        best = words.groupBy("fit", "column_name").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
        for r in best.collect():
            modes.setdefault(r["fit"], {})[r["column_name"]] = r["best"]["value"]
        void = [(k, c, "") for k in fits for c in self.text if c not in modes.get(k, {})]      # a column without any text
        seen = words.select("fit", "column_name", "value").unionByName(
            words.sparkSession.createDataFrame(void, "fit int, column_name string, value string"))
        codes, n = stored(row_positions(seen, ["fit", "column_name"], [F.col("value")], "code"), "codes")
        for k in fits:
            known = codes.filter(F.col("fit") == k).select("column_name", "value", "code")
            self._features[k] = ml.Features(self.numeric, self.text, medians.get(k, {}), modes.get(k, {}),
                                            F.broadcast(known) if n <= 100_000 else known)

    def features(self, k: int) -> ml.Features:
        return self._features[k]

    def guess(self) -> tuple[int, ...]:
        """Features that tell the label by themselves; the check finds the others."""
        out = []
        for i, c in enumerate(self.names):
            bins = self.tells.get(c, [])
            total = sum(n for n, _ in bins)
            share = sum(p for _, p in bins) / max(1, total)
            if 0 < share < 1:
                told = (sum(n * (p / n - share) ** 2 for n, p in bins) / (share * (1 - share)) - len(bins)) / total
                out += [i] if told > max(TELLS, BEYOND * (2 * len(bins)) ** 0.5 / total) else []
        return tuple(out)

    def fold(self, active: tuple[int, ...]) -> bool:
        """Fold the rows by the features; False if a fit's are too many for it to be worth it."""
        self.active, chosen = active, [self.names[i] for i in active]
        self.cells, n = self._stored(self.rows.groupBy("__fold", "__held", "__label", *chosen).agg(
            F.count(F.lit(1)).cast("double").alias("__n")), "fold-cells")
        most = self._merged(self.cells, "__held", "__label", *chosen).count()      # those of a fit at most
        if most > fo.MOST_CELLS or n * fo.LEAST_FOLD > self.n:
            return False
        rest = [c for i, c in enumerate(self.names) if i not in active and len(self.lows.get(c, [])) > 1]
        self.counts = self._stored(reduce(lambda a, b: a.unionByName(b), [
            self._binned(c, chosen).groupBy("__fold", "__label", *chosen, "bin").agg(F.count(F.lit(1)).alias("n")).withColumn(
                "j", F.lit(self.names.index(c))) for c in rest]), "fold-counts")[0] if rest else None
        return True

    def fold_some(self, active: set[int], settings: ml.Boosting) -> bool:
        """Fold the rows by the features, or, if they are too many then, by those that one round splits on. Of features that
        go together, such as a year and what changed in it, the trees need one."""
        if self.fold(tuple(sorted(active))):
            return True
        fewer = self._split_on(settings)
        return 0 < len(fewer) < len(active) and self.fold(fewer)

    def _split_on(self, settings: ml.Boosting) -> tuple[int, ...]:
        """The active features that one round of the first fit splits on."""
        own = self._merged(self.cells.filter(self._learns(0) & ~F.col("__held")), "__held", "__label", *[self.names[i] for i in self.active])
        cells, n = self._stored(self._vectors(own, 0), "fit-cells")
        trainer = fo.weighted(ml.set_up(GBTClassifier(), "__target", settings, True), cells)
        if trainer is None:
            return ()
        tree, = fo.tree_tables(fo._unstopped(trainer, 1).fit(cells.repartition(ml.fit_tasks(cells.sparkSession, n))))
        return tuple(sorted({int(i) for i, gain in zip(tree["feature"], tree["gain"]) if i >= 0 and gain > fo.ROUNDING}))

    @staticmethod
    def _merged(cells: DataFrame, *keys: str) -> DataFrame:
        """Folded rows of several folds as one where they agree."""
        return cells.groupBy(*keys).agg(F.sum("__n").alias("__n"))

    def _binned(self, column: str, chosen: Sequence[str]) -> DataFrame:
        """Rows to learn from with the bin of a column's value, -1 where it is missing."""
        rows = self.rows.filter(~F.col("__held")).select("__fold", "__label", *chosen, column)
        if column in self.numeric:
            splits = [-float("inf"), *self.lows[column][1:], float("inf")]
            out = Bucketizer(inputCol=column, outputCol="__b", splits=splits, handleInvalid="keep").transform(rows)
        else:
            bins = self.placed["text"].filter(F.col("column_name") == column).select(F.col("value").alias(column), F.col("bin").alias("__b"))
            out = rows.join(bins, column, "left")
        return out.withColumn("bin", F.coalesce(F.col("__b").cast("int"), F.lit(-1)))

    def _coded(self, df: DataFrame, k: int) -> DataFrame:
        """The numbers that fit ``k`` has for the active features, as ``f<number>``."""
        f, chosen = self._features[k], {self.names[i] for i in self.active}
        some = ml.Features(tuple(c for c in self.numeric if c in chosen), tuple(c for c in self.text if c in chosen), f.medians, f.modes, f.codes)
        return some.coded(df).withColumnsRenamed({f"{self.names[i]}__f": f"f{i}" for i in self.active})

    def _vectors(self, df: DataFrame, k: int) -> DataFrame:
        """Folded rows as fit ``k`` sees them; features left out are 0."""
        vector = array_to_vector(F.array(*[F.col(f"f{i}") if i in self.active else F.lit(0.0) for i in range(len(self.names))]))
        return self._coded(df, k).select(vector.alias("features"), "__label", F.col("__label").cast("double").alias("__target"), "__held", "__n")

    def _missing_bins(self, k: int) -> Mapping[int, int]:
        """The bin that a missing value of each left-out feature falls into."""
        f, out = self._features[k], {}
        for i, c in enumerate(self.names):
            if c in self.numeric and c in f.medians and c in self.lows:
                out[i] = max(0, bisect_right(self.lows[c], f.medians[c]) - 1)
        words = self.placed["text"].filter(reduce(lambda a, b: a | b, [
            (F.col("column_name") == c) & (F.col("value") == v) for c, v in f.modes.items()], F.lit(False)))
        return out | {self.names.index(r["column_name"]): r["bin"] for r in words.collect()}

    def _left_out(self, k: int) -> DataFrame:
        bins = self._missing_bins(k)
        filled = reduce(lambda e, j: e.when((F.col("bin") < 0) & (F.col("j") == j), F.lit(bins[j])), bins, F.when(F.lit(False), 0))
        own = self.counts.filter(self._learns(k)).withColumn("bin", F.greatest(filled.otherwise(F.col("bin")), F.lit(0)))
        keys = ["__label", *[self.names[i] for i in self.active], "j", "bin"]
        return self._coded(own.groupBy(*keys).agg(F.sum("n").alias("n")), k).withColumn("__target", F.col("__label").cast("double"))

    def fit_rows(self, k: int) -> tuple[DataFrame, DataFrame | None]:
        """Folded rows of fit ``k`` and the counts of its check, stored once for all settings."""
        own = self._merged(self.cells.filter(self._learns(k)), "__held", "__label", *[self.names[i] for i in self.active])
        return self._stored(self._vectors(own, k), "fit-cells")[0], None if self.counts is None else self._stored(
            self._left_out(k), "fit-counts")[0]

    def classifier(self, cells: DataFrame, left_out: DataFrame | None, settings: ml.Boosting):
        """The fit of rows from ``fit_rows``, and the features that it should not have left out."""
        ensure_checkpointing(self.rows.sparkSession)
        trainer = ml.set_up(GBTClassifier(predictionCol="__class"), "__target", settings, True)
        return fo.checked_fit(trainer, cells, lambda: left_out, self.active, "__target", len(self.names), ml.BINS)

    def scores(self, models: Sequence) -> DataFrame:
        """What each fold's model says of the fold: label, number of rows, probability."""
        return reduce(lambda a, b: a.unionByName(b), [
            models[k].transform(self._vectors(self.cells.filter(F.col("__fold") == k), k)).select(
                "__label", "__n", vector_to_array("probability")[1].alias("probability")) for k in range(self.folds)])

    def threshold(self, models: Sequence) -> float:
        """The threshold of the best F1 of what each fold's model says of the fold."""
        sweep = ev.threshold_sweep(self.scores(models), "__label", "probability", "__n")
        return ev.best_threshold(sweep).first()["threshold"]
