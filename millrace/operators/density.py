"""Density clustering (eps, min_points) on a grid, exact, without forming all close pairs.

Cells have a diagonal of at most eps. A cell that holds min_points rows makes all its points core
at once; only points of thinner cells are compared with others, and only with cells that the eps
sphere cuts. Core points of one cell always share a cluster, so clusters are connected components
of cells.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.session import written

NOISE = -1
# Pairs of boxes with at most this many point pairs are compared point by point, as are boxes halved
# so often that their points differ by rounding only.
DIRECT_PAIRS, FINEST = 256, 40


class DensityClustering:
    """Steps of one fit over ``rows`` (an ``id`` and numeric features without nulls)."""

    def __init__(self, rows: DataFrame, features: Sequence[str], eps: float = 0.5, min_points: int = 5, id_: str = "event_id"):
        if len(features) > 4:
            raise ValueError("the grid suits up to four features")
        self.features = list(features)
        self.eps, self.min_points = float(eps), min_points
        # Feature values are join keys below, so they are fixed by writing them once.
        self.rows = written(rows.select(F.col(id_).alias("id"), *self.features), "points")
        self.side = self.eps / math.sqrt(len(self.features)) * (1 - 1e-9)
        self.reach = math.ceil(math.sqrt(len(self.features)))
        distinct = self.rows.groupBy(*self.features).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
        cell = F.array(*[F.floor(F.col(c) / F.lit(self.side)).cast("long") for c in self.features])
        x = F.array(*[F.col(c) for c in self.features])
        self.points = written(distinct.select("id", "n", x.alias("x"), cell.alias("cell")), "cells")
        self._core = self._border = self._labels = None

    def _neighbour_cells(self) -> Column:
        steps = itertools.product(range(-self.reach, self.reach + 1), repeat=len(self.features))
        offsets = [F.array(*[F.lit(v).cast("long") for v in s]) for s in steps]
        return F.transform(F.array(*offsets), lambda o: F.zip_with("cell", o, lambda a, b: a + b))

    def _gap(self, low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> tuple[Column, Column]:
        """Least and greatest squared distance between two boxes given by corner arrays."""
        near = F.lit(0.0)
        far = F.lit(0.0)
        for i in range(len(self.features)):
            apart = F.greatest(F.lit(0.0), low_a[i] - high_b[i], low_b[i] - high_a[i])
            across = F.greatest(high_a[i] - low_b[i], high_b[i] - low_a[i])
            near, far = near + apart * apart, far + across * across
        return near, far

    def _squared(self, a: Column, b: Column) -> Column:
        return reduce(lambda s, t: s + t, [(a[i] - b[i]) * (a[i] - b[i]) for i in range(len(self.features))])

    def _boxes(self, points: DataFrame, *keys: str) -> DataFrame:
        dims = range(len(self.features))
        return points.groupBy(*keys).agg(
            F.array(*[F.min(F.col("x")[i]) for i in dims]).alias("low"),
            F.array(*[F.max(F.col("x")[i]) for i in dims]).alias("high"),
            F.sum("n").alias("weight"), F.count(F.lit(1)).alias("count"),
        )

    def core(self) -> DataFrame:
        """Distinct points with ``is_core``."""
        if self._core is not None:
            return self._core
        limit = F.lit(self.eps * self.eps)
        boxes = written(self._boxes(self.points, "cell"), "boxes")
        full = boxes.where(F.col("weight") >= self.min_points).select("cell", F.lit(True).alias("full"))
        marked = self.points.join(full, "cell", "left")
        thin = marked.where("full is null").drop("full")
        probes = thin.select("id", "x", F.explode(self._neighbour_cells()).alias("cell"))
        near, far = self._gap(F.col("x"), F.col("x"), F.col("low"), F.col("high"))
        met = probes.join(boxes, "cell").withColumn("near", near).withColumn("far", far).where(F.col("near") <= limit)
        inside = F.col("far") <= limit
        met = met.select("id", "x", "cell", inside.alias("inside"), "weight")
        sure = met.groupBy("id").agg(F.sum(F.when(F.col("inside"), F.col("weight")).otherwise(0)).alias("sure"))
        enough = sure.where(F.col("sure") >= self.min_points).select("id")
        cut = met.where(~F.col("inside")).join(enough, "id", "left_anti").select("id", "x", "cell")
        others = self.points.select("cell", F.col("x").alias("y"), "n")
        counted = cut.join(others, "cell").where(self._squared(F.col("x"), F.col("y")) <= limit)
        counted = counted.groupBy("id").agg(F.sum("n").alias("counted"))
        total = sure.join(counted, "id", "left").select(
            "id", (F.col("sure") + F.coalesce(F.col("counted"), F.lit(0)) >= self.min_points).alias("reached")
        )
        flagged = marked.join(total, "id", "left")
        is_core = F.coalesce(F.col("full"), F.col("reached"), F.lit(False))
        self._core = written(flagged.select("id", "n", "x", "cell", is_core.alias("is_core")), "core")
        return self._core

    def border(self) -> DataFrame:
        """(``id``, ``cell``) of points that are not core but close to a core point of the cell.

        Boxes of core points decide first: a cell wholly inside the eps sphere needs no comparison.
        """
        if self._border is not None:
            return self._border
        limit = F.lit(self.eps * self.eps)
        core = self.core()
        cores = core.where("is_core")
        boxes = self._boxes(cores, "cell").select("cell", "low", "high")
        probes = core.where("not is_core").select("id", "x", F.explode(self._neighbour_cells()).alias("cell"))
        near, far = self._gap(F.col("x"), F.col("x"), F.col("low"), F.col("high"))
        met = probes.join(boxes, "cell").withColumn("near", near).withColumn("far", far).where(F.col("near") <= limit)
        sure = met.where(F.col("far") <= limit).select("id", "cell")
        cut = met.where(F.col("far") > limit).select("id", "x", "cell")
        close = cut.join(cores.select("cell", F.col("x").alias("y")), "cell")
        close = close.where(self._squared(F.col("x"), F.col("y")) <= limit).select("id", "cell").distinct()
        self._border = written(sure.union(close), "border")
        return self._border

    def _cell_edges(self) -> DataFrame:
        """Pairs of cells (``a`` < ``b``) with two core points within eps.

        Boxes of core points are compared first; boxes whose nearest corners are within eps but
        whose farthest are not are halved along each axis until a pair is decided or small.
        """
        limit = F.lit(self.eps * self.eps)
        cores = self.core().where("is_core").select("x", "cell", "n")
        boxes = self._boxes(cores, "cell")
        left = boxes.select("cell", F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.col("count").alias("count_a"))
        left = left.withColumn("a", F.col("cell")).withColumn("cell", F.explode(self._neighbour_cells()))
        right = boxes.select("cell", F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("count").alias("count_b"))
        pairs = left.join(right, "cell").withColumnRenamed("cell", "b").where("a < b")
        pairs = pairs.withColumn("part_a", F.col("a")).withColumn("part_b", F.col("b"))
        decided: list[DataFrame] = []
        level = 0
        while True:
            near, far = self._gap(*[F.col(c) for c in ("low_a", "high_a", "low_b", "high_b")])
            open_pairs = pairs.withColumn("near", near).withColumn("far", far).where(F.col("near") <= limit)
            open_pairs = written(open_pairs, "pairs")
            met = open_pairs.where(F.col("far") <= limit).select("a", "b").distinct()
            rest = open_pairs.where(F.col("far") > limit).join(met, ["a", "b"], "left_anti")
            small = (F.col("count_a") * F.col("count_b") <= DIRECT_PAIRS) | F.lit(level >= FINEST)
            parts = cores.withColumn("part", self._part(level))
            direct = rest.where(small).select("a", "b", "part_a", "part_b")
            direct = direct.join(parts.select(F.col("part").alias("part_a"), F.col("x").alias("p")), "part_a")
            direct = direct.join(parts.select(F.col("part").alias("part_b"), F.col("x").alias("q")), "part_b")
            direct = direct.where(self._squared(F.col("p"), F.col("q")) <= limit).select("a", "b").distinct()
            found = written(met.union(direct).distinct(), "edges")
            decided.append(found)
            rest = rest.where(~small).join(found, ["a", "b"], "left_anti")
            if rest.isEmpty():
                return reduce(DataFrame.union, decided)
            level += 1
            finer = self._boxes(cores.withColumn("part", self._part(level)).withColumn("up", self._part(level - 1)), "up", "part")
            finer = written(finer, "parts")
            rest = rest.select("a", "b", F.col("part_a").alias("up_a"), F.col("part_b").alias("up_b"))
            one = finer.select(F.col("up").alias("up_a"), F.col("part").alias("part_a"), F.col("low").alias("low_a"),
                               F.col("high").alias("high_a"), F.col("count").alias("count_a"))
            two = finer.select(F.col("up").alias("up_b"), F.col("part").alias("part_b"), F.col("low").alias("low_b"),
                               F.col("high").alias("high_b"), F.col("count").alias("count_b"))
            pairs = rest.join(one, "up_a").join(two, "up_b").drop("up_a", "up_b")

    def _part(self, level: int) -> Column:
        """Address of a point's box: its cell, and below it the cell of a grid halved ``level`` times."""
        if level == 0:
            return F.col("cell")
        finer = [F.floor(F.col("x")[i] / F.lit(self.side / 2**level)).cast("long") for i in range(len(self.features))]
        return F.concat(F.col("cell"), F.array(*finer))

    def _cell_labels(self) -> DataFrame:
        """(``cell``, ``label``) of every cell with core points."""
        if self._labels is None:
            core = self.core()
            roots = connected_components(self._cell_edges().select(F.col("a").alias("u"), F.col("b").alias("v")))
            cells = core.where("is_core").groupBy("cell").agg(F.min("id").alias("first"))
            cells = cells.join(roots.withColumnRenamed("node", "cell"), "cell", "left")
            cells = cells.select("cell", "first", F.coalesce("root", "cell").alias("root"))
            names = cells.groupBy("root").agg(F.min("first").alias("label"))
            self._labels = written(cells.join(names, "root").select("cell", "label"), "labels")
        return self._labels

    def labels(self) -> DataFrame:
        """(``id``, ``label``) of every row: the least id among the cluster's core points, or -1.

        A border point close to several clusters joins the one with the least label.
        """
        core, cells = self.core(), self._cell_labels()
        inner = core.where("is_core").join(cells, "cell").select("id", "label")
        outer = self.border().join(cells, "cell").groupBy("id").agg(F.min("label").alias("label"))
        labelled = core.select("id", "x").join(inner.union(outer), "id", "left")
        return self._per_row(labelled.select("x", F.coalesce(F.col("label"), F.lit(NOISE)).alias("label")), "label")

    def _per_row(self, points: DataFrame, column: str) -> DataFrame:
        keyed = points.select(*[F.col("x")[i].alias(c) for i, c in enumerate(self.features)], column)
        return self.rows.join(keyed, self.features).select("id", column)

    def near_core(self, rows: DataFrame, id_: str) -> DataFrame:
        """(``id_``, ``label``) of new rows: the cluster of their cell, else the least label among
        core points within eps, or -1. The new rows do not change the clusters.
        """
        limit = F.lit(self.eps * self.eps)
        cell = F.array(*[F.floor(F.col(c) / F.lit(self.side)).cast("long") for c in self.features])
        x = F.array(*[F.col(c) for c in self.features])
        asked = rows.select(id_, x.alias("x"), cell.alias("cell"))
        labels = self._cell_labels()
        at_home = asked.join(labels, "cell").select(id_, "label")
        abroad = asked.join(labels, "cell", "left_anti").select(id_, "x", F.explode(self._neighbour_cells()).alias("cell"))
        cores = self.core().where("is_core")
        boxes = self._boxes(cores, "cell").select("cell", "low", "high").join(labels, "cell")
        near, far = self._gap(F.col("x"), F.col("x"), F.col("low"), F.col("high"))
        met = abroad.join(boxes, "cell").withColumn("near", near).withColumn("far", far).where(F.col("near") <= limit)
        sure = met.where(F.col("far") <= limit).select(id_, "label")
        cut = met.where(F.col("far") > limit).select(id_, "x", "cell", "label")
        close = cut.join(cores.select("cell", F.col("x").alias("y")), "cell")
        close = close.where(self._squared(F.col("x"), F.col("y")) <= limit).select(id_, "label")
        found = at_home.union(sure).union(close).groupBy(id_).agg(F.min("label").alias("label"))
        return rows.select(id_).join(found, id_, "left").select(id_, F.coalesce("label", F.lit(NOISE)).alias("label"))

    def core_rows(self) -> DataFrame:
        return self._per_row(self.core(), "is_core")

    def noise_rows(self) -> DataFrame:
        """(``id``, ``is_noise``): neither core nor close to a core point. Needs no clusters."""
        close = self.border().select("id").distinct().withColumn("close", F.lit(True))
        marked = self.core().join(close, "id", "left")
        noise = ~(F.col("is_core") | F.coalesce(F.col("close"), F.lit(False)))
        return self._per_row(marked.select("x", noise.alias("is_noise")), "is_noise")
