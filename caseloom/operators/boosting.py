"""Boosted trees in few Spark jobs: rows alike in every bin are counted, trees are grown on the counts.

Spark's GBTClassifier starts several jobs a tree level, thousands for 300 rounds. The trees here are the same ones: variance
gain, logistic residuals, at most 32 bins a feature, a least number of rows (not of distinct ones) a leaf. Bins are cut as
Spark cuts them, from the weighted counts of every value where Spark takes a sample beyond 10,000 rows."""

from __future__ import annotations

import json
import re
import time

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import stored, work_path

#: More distinct rows than these are not given to one task.
IN_ONE_TASK = 4_000_000
NODES = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


# --- growing ----------------------------------------------------------------------------------------


def cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> list[float]:
    """Midpoints between sorted values: all where there are fewer than ``bins``, else those nearest to equal weights."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(values) <= bins:
        return middle.tolist()
    upto, stride = np.cumsum(weights), weights.sum() / bins
    out, target = [], stride
    for k in range(len(middle)):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            out.append(float(middle[k]))
            target += stride
    return out


def counted(rows: DataFrame, columns: list[str], label: str, weight: str, bins: int) -> tuple[DataFrame, list[list[float]]]:
    """(cells, label, weight, n: rows alike in every bin; the cuts of each column)."""
    alike = stored(rows.groupBy(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("y")).agg(F.first(weight).alias("w"), F.count("*").alias("n")), "alike")
    values = alike.select(F.posexplode(F.array(*columns)).alias("feature", "value"), (F.col("w") * F.col("n")).alias("w")).groupBy("feature", "value").agg(F.sum("w").alias("w"))

    def of_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("value")
        return pd.DataFrame({"feature": [pdf.feature.iloc[0]], "cuts": [cuts(pdf.value.to_numpy(), pdf.w.to_numpy(), bins)]})

    found = {r.feature: list(r.cuts) for r in values.groupBy("feature").applyInPandas(of_one, "feature int, cuts array<double>").collect()}
    edges = [found.get(k, []) for k in range(len(columns))]

    def binned(batches):
        for pdf in batches:
            yield pd.DataFrame({"cells": packed(np.stack([np.searchsorted(e, pdf[c].to_numpy()) for c, e in zip(columns, edges)], 1).astype("u1")), "y": pdf.y, "w": pdf.w, "n": pdf.n})

    cells = alike.mapInPandas(binned, "cells binary, y double, w double, n bigint").groupBy("cells", "y").agg(F.first("w").alias("w"), F.sum("n").alias("n"))
    return stored(cells, "cells"), edges


def packed(matrix: np.ndarray) -> list[bytes]:
    data, k = np.ascontiguousarray(matrix).tobytes(), matrix.shape[1] * matrix.itemsize
    return [data[i : i + k] for i in range(0, len(data), k)]


class Grower:
    """Trees on counted rows. ``cells``: (features, rows), ``y``: 1 and -1, ``w``: weight of a row, ``n``: how many it stands for."""

    def __init__(self, cells: np.ndarray, y: np.ndarray, w: np.ndarray, n: np.ndarray, edges: list[list[float]], depth: int, least: int):
        self.cells, self.y, self.w, self.n, self.edges, self.depth, self.least = np.ascontiguousarray(cells), y, w * n, n.astype(float), edges, depth, least
        self.used, self.bins = [f for f, e in enumerate(edges) if e], max([len(e) for e in edges] or [0]) + 1
        self.possible = np.array([[k < len(edges[f]) for k in range(self.bins - 1)] for f in self.used]).reshape(len(self.used), self.bins - 1)
        self.root = None

    def _sums(self, at: np.ndarray | None, where: np.ndarray | None, groups: int, of: list[np.ndarray]) -> np.ndarray:
        """(groups, len(of), features, bins)."""
        of = of if at is None else [x[at] for x in of]
        out = np.empty((groups, len(of), len(self.used), self.bins))
        for k, f in enumerate(self.used):
            key = self.cells[f] if at is None else self.cells[f][at] + where * self.bins
            for j, x in enumerate(of):
                out[:, j, k] = np.bincount(key, x, groups * self.bins).reshape(groups, self.bins)
        return out

    def tree(self, g: np.ndarray) -> tuple[dict[int, dict], np.ndarray]:
        """(nodes by heap number, prediction of each row)."""
        s = self.w * g
        q, size = s * g, 2 << self.depth
        if self.root is None:
            self.root = self._sums(None, None, 1, [self.w, self.n])
        sums = {1: np.concatenate([self.root[0, :1], self._sums(None, None, 1, [s])[0], self.root[0, 1:]])}  # weight, weight x residual, rows
        node, nodes, opened = np.ones(len(s), int), {}, [1]
        for level in range(self.depth + 1):
            totals = [np.bincount(node, x, size) for x in (self.w, s, q, self.n)]
            feature, last, split = np.zeros(size, int), np.zeros(size, int), np.zeros(size, bool)
            for k in opened:
                w, a, b, n = (t[k] for t in totals)
                impurity = (b - a * a / w) / w
                nodes[k] = {"prediction": a / w, "impurity": impurity, "stats": [w, a, b], "n": int(n)}
                if level == self.depth or not self.used or impurity < 1e-15:
                    continue
                lw, ls, ln = np.cumsum(sums[k][:, :, :-1], 2)
                fine = self.possible & (ln >= self.least) & (n - ln >= self.least)
                if not fine.any():
                    continue
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(fine, (ls * ls / lw + (a - ls) ** 2 / (w - lw) - a * a / w) / w, -np.inf)
                best = int(gain.argmax())
                if gain.flat[best] <= 1e-12 * impurity:
                    continue
                f, at = self.used[best // gain.shape[1]], best % gain.shape[1]
                feature[k], last[k], split[k] = f, at, True
                nodes[k] |= {"gain": float(gain.flat[best]), "feature": f, "threshold": self.edges[f][at]}
            if not split.any():
                break
            moved = np.flatnonzero(split[node])
            was = node[moved]
            node[moved] = 2 * was + (self.cells[feature[was], moved] > last[was])
            parents, held = np.flatnonzero(split), np.bincount(node, minlength=size)
            opened = [c for p in parents for c in (2 * p, 2 * p + 1)]
            if level + 1 < self.depth:  # the smaller child is summed, the other is the rest
                small = [2 * p + int(held[2 * p + 1] < held[2 * p]) for p in parents]
                local = np.full(size, -1)
                local[small] = range(len(small))
                at = np.flatnonzero(local[node] >= 0)
                made = self._sums(at, local[node[at]], len(small), [self.w, s, self.n])
                sums = {c: x for p, k, own in zip(parents, small, made) for c, x in ((k, own), (k ^ 1, sums[p] - own))}
        value = np.zeros(size)
        for k, x in nodes.items():
            value[k] = x["prediction"]
        return nodes, value[node]

    def boost(self, rounds: int, step: float):
        """Each round's nodes; the first tree fits the labels and counts whole, the others fit the residuals."""
        margin = np.zeros(len(self.y))
        for k in range(rounds):
            nodes, fit = self.tree(self.y if k == 0 else 4.0 * self.y / (1.0 + np.exp(np.minimum(2.0 * self.y * margin, 700.0))))
            margin += fit * (step if k else 1.0)
            yield nodes


def as_rows(nodes: dict[int, dict]) -> list[dict]:
    """Nodes in the order in which Spark stores a tree."""
    order: dict[int, int] = {}

    def visit(k: int) -> None:
        order[k] = len(order)
        if "feature" in nodes[k]:
            visit(2 * k)
            visit(2 * k + 1)

    visit(1)
    out = []
    for k, i in order.items():
        x, inner = nodes[k], "feature" in nodes[k]
        out.append({
            "id": i, "prediction": x["prediction"], "impurity": x["impurity"], "impurityStats": x["stats"], "rawCount": x["n"], "gain": x["gain"] if inner else -1.0,
            "leftChild": order[2 * k] if inner else -1, "rightChild": order[2 * k + 1] if inner else -1,
            "split": {"featureIndex": x["feature"] if inner else -1, "leftCategoriesOrThreshold": [x["threshold"]] if inner else [], "numCategories": -1},
        })
    return out


def fit(gbt: GBTClassifier, rows: DataFrame, columns: list[str]) -> GBTClassificationModel | None:
    """The model of ``gbt``; None where more distinct rows are left than one task should hold."""
    spark, label, depth, least, rounds, step = rows.sparkSession, gbt.getLabelCol(), gbt.getMaxDepth(), gbt.getMinInstancesPerNode(), gbt.getMaxIter(), gbt.getStepSize()
    cells, edges = counted(rows, columns, label, gbt.getWeightCol(), gbt.getMaxBins())
    if cells.count() > IN_ONE_TASK:
        return None

    def grown(batches):
        pdf = pd.concat(list(batches))
        matrix = np.frombuffer(b"".join(pdf.cells), "u1").reshape(len(pdf), len(columns)).T
        grower = Grower(matrix, pdf.y.to_numpy() * 2 - 1, pdf.w.to_numpy(), pdf.n.to_numpy(), edges, depth, least)
        for k, nodes in enumerate(grower.boost(rounds, step)):
            out = as_rows(nodes)
            yield pd.DataFrame({"treeID": [k] * len(out), "nodeData": out})

    path = work_path(spark, "trees")
    cells.coalesce(1).mapInPandas(grown, NODES).write.parquet(f"{path}/data")
    named = lambda m, only: {p.name: v for p, v in m.items() if not only or p.name in only}
    of_tree = {"cacheNodeIds", "checkpointInterval", "featuresCol", "labelCol", "maxDepth", "minInstancesPerNode", "seed", "weightCol", "impurity", "maxBins", "maxMemoryInMB", "minInfoGain", "minWeightFractionPerNode", "predictionCol", "leafCol"}

    def described(kind: str, uid: str, only=None, **more) -> str:
        about = {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps(about | {"paramMap": named(gbt._paramMap, only), "defaultParamMap": named(gbt._defaultParamMap, only)} | more)

    trees = [(k, described("regression.DecisionTreeRegressionModel", f"dtr_{gbt.uid}_{k}", of_tree), step if k else 1.0) for k in range(rounds)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    about = described("classification.GBTClassificationModel", gbt.uid, numFeatures=len(columns), numTrees=rounds)
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)


# --- scoring ----------------------------------------------------------------------------------------


class Forest:
    """A boosted model as bit masks: of each feature and cell, the leaves of every tree that it leaves open. One bit a tree remains."""

    def __init__(self, model: GBTClassificationModel, features: int):
        steps, weights = re.findall(r"If \(feature (\d+) <= (\S+)\)|(Predict): (\S+)|Tree \d+ \(weight (\S+)\)", model.toDebugString), []
        trees, stack = [], []
        for f, t, leaf, value, weight in steps:
            if weight:
                weights.append(float(weight))
                trees.append(([], []))
                stack = []
                continue
            tests, leaves = trees[-1]
            if leaf:
                leaves.append(float(value))
                while stack and stack[-1][1] is not None:
                    stack.pop()[0][3] = len(leaves)
                if stack:
                    stack[-1][1] = stack[-1][0][2] = len(leaves)
            else:
                tests.append(x := [int(f), float(t), 0, 0, len(leaves)])  # feature, threshold, first leaf of the right, end, first of the left
                stack.append([x, None])
        self.bits = next(b for b in (16, 32, 64) if all(len(v) <= b for _, v in trees))
        kind, every = f"u{self.bits // 8}", (1 << self.bits) - 1
        self.edges = [sorted({t for tests, _ in trees for f, t, *_ in tests if f == j}) for j in range(features)]
        self.masks = [np.full((len(e) + 1, len(trees)), every, kind) for e in self.edges]
        self.values = np.zeros((len(trees), self.bits))
        for k, (tests, leaves) in enumerate(trees):
            self.values[k, : len(leaves)] = np.array(leaves) * weights[k]
            for f, t, right, end, left in tests:
                at = self.edges[f].index(t) + 1
                self.masks[f][:at, k] &= np.array(every & ~((1 << end) - (1 << right)), kind)
                self.masks[f][at:, k] &= np.array(every & ~((1 << right) - (1 << left)), kind)
            for m in self.masks[:1]:
                m[:, k] &= np.array((1 << len(leaves)) - 1, kind)
        self.first, self.kind = np.arange(len(trees)) * self.bits, "u1" if max(map(len, self.edges)) < 256 else "u2"
        self.place = np.frexp(np.arange(1 << 16, dtype="f4"))[1].astype(int) - 1 if self.bits == 16 else None

    def cells(self, values: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, v) for e, v in zip(self.edges, values)], 1).astype(self.kind)

    def open(self, cells: np.ndarray, features: list[int]) -> np.ndarray:
        """The leaves that these features leave open."""
        out = self.masks[features[0]][cells[:, features[0]]]
        for f in features[1:]:
            out &= self.masks[f][cells[:, f]]
        return out

    def margin(self, leaves: np.ndarray) -> np.ndarray:
        """The weighted sum of the one leaf left of each tree, which ranks as the probability does; rounded, as sums equal but for
        their last bits tie."""
        which = self.place[leaves] if self.bits == 16 else np.frexp(leaves.astype("f8"))[1] - 1
        return self.values.ravel()[which + self.first].sum(1).round(12)


# --- permutation importance -------------------------------------------------------------------------


class Dealt:
    """Rows of one bucket: cells, label, and for each repeat the row whose value is dealt to each."""

    SCHEMA, AT_ONCE = "rows int, cells binary, positive binary, donors binary", 4096

    def __init__(self, forest: Forest, cells: np.ndarray, positive: np.ndarray, donors: np.ndarray):
        self.forest, self.cells, self.positive, self.donors = forest, cells, positive, donors

    @classmethod
    def read(cls, forest: Forest, rows: int, cells: bytes, positive: bytes, donors: bytes) -> Dealt:
        return cls(forest, np.frombuffer(cells, forest.kind).reshape(rows, -1), np.frombuffer(positive, bool), np.frombuffer(donors, "i4").reshape(-1, rows))

    def packed(self) -> list:
        return [len(self.cells), self.cells.tobytes(), self.positive.tobytes(), self.donors.astype("i4").tobytes()]

    def margins(self, moved: list[int], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct margins, for each repeat and row of ``at`` which of them) when the values of the features ``moved`` are dealt out.

        What the other features leave open is found once for rows alike in them, and each pair of that and dealt values once."""
        rest = [k for k in range(self.cells.shape[1]) if k not in moved]
        alike, of_rest = self._distinct(self.cells[at][:, rest])
        values, of_value = self._distinct(self.cells[:, moved])
        pairs, of_pair = np.unique(of_rest * len(values) + of_value[self.donors[:, at]] if moved else of_rest[None], return_inverse=True)
        left, own = self.forest.open(self.cells[at][alike], rest), self.forest.open(self.cells[values], moved) if moved else None
        out = np.empty(len(pairs))
        for k in range(0, len(pairs), self.AT_ONCE):
            a, b = np.divmod(pairs[k : k + self.AT_ONCE], len(values)) if moved else (pairs[k : k + self.AT_ONCE], None)
            out[k : k + self.AT_ONCE] = self.forest.margin(left[a] & own[b] if moved else left[a])
        return out, of_pair.reshape(-1, len(at))

    @staticmethod
    def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a row of each kind, the kind of each row)."""
        if not cells.shape[1]:
            return np.zeros(1, int), np.zeros(len(cells), int)
        data = np.ascontiguousarray(cells)
        _, first, kind = np.unique(data.view(f"V{data.shape[1] * data.itemsize}").ravel(), return_index=True, return_inverse=True)
        return first, kind.ravel()


def average_precisions(forest: Forest, inputs: list[str], rows: DataFrame, keys: list[str], positive, moved: list[list[int]], repeats: int, seed: int, buckets: int) -> dict[tuple[int, int], float]:
    """(place in ``moved``, repeat) -> average precision when those features' values change rows; (-1, 0): as they are.

    Rows are dealt into buckets by one hash; within a bucket the values of the row that is n-th by a second hash, another
    one each repeat, go to the row that is n-th by the keys. The margins of the positive rows are gathered first; of all
    others only the number beyond each of these is needed."""
    spark = rows.sparkSession
    orders = [F.xxhash64(*keys, F.lit(seed + 1_000 + r)).alias(f"_h{r}") for r in range(repeats)]
    keyed = rows.select(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets)).alias("_b"), positive.alias("_y"), *orders, *[F.col(c).alias(f"_k{k}") for k, c in enumerate(keys)], *[F.col(c).cast("double").alias(c) for c in inputs])

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([f"_k{k}" for k in range(len(keys))], kind="stable", na_position="first")
        donors = np.stack([np.argsort(pdf[f"_h{r}"].to_numpy(), kind="stable") for r in range(repeats)])
        dealt = Dealt(forest, forest.cells([pdf[c].to_numpy() for c in inputs]), pdf._y.to_numpy(bool), donors)
        return pd.DataFrame([dealt.packed()], columns=["rows", "cells", "positive", "donors"])

    dealt = stored(keyed.repartition(min(buckets, 1_000), "_b").groupBy("_b").applyInPandas(deal, Dealt.SCHEMA), "dealt")
    asked = [(-1, []), *enumerate(moved)]

    def best(batches):
        for pdf in batches:
            for x in pdf.itertuples(index=False):
                one = Dealt.read(forest, *x)
                for c, features in asked if one.positive.any() else []:
                    margins, which = one.margins(features, np.flatnonzero(one.positive))
                    for r, w in enumerate(which):
                        yield pd.DataFrame({"c": c, "r": r, "s": margins[w]})

    found = dealt.mapInPandas(best, "c int, r int, s double").groupBy("c", "r", "s").agg(F.count("*").alias("n")).toPandas()
    steps = {(c, r): np.sort(g.s.to_numpy()) for (c, r), g in found.groupby(["c", "r"])}
    shared = spark.sparkContext.broadcast(steps)

    def tally(batches):
        for pdf in batches:
            for x in pdf.itertuples(index=False):
                one = Dealt.read(forest, *x)
                for c, features in asked:
                    margins, which = one.margins(features, np.arange(len(one.cells)))
                    for r, w in enumerate(which):
                        n = np.bincount(np.searchsorted(shared.value[c, r], margins, side="right")[w])
                        at = np.flatnonzero(n)
                        yield pd.DataFrame({"c": c, "r": r, "k": at, "n": n[at]})

    counts = dealt.mapInPandas(tally, "c int, r int, k int, n bigint").groupBy("c", "r", "k").agg(F.sum("n").alias("n")).toPandas() if steps else None
    out = {}
    for (c, r), g in found.groupby(["c", "r"]):
        pos = g.sort_values("s").n.to_numpy()
        of = counts[(counts.c == c) & (counts.r == r)]
        beyond = np.bincount(of.k.to_numpy(), of.n.to_numpy(), len(pos) + 1)[1:]
        upward = lambda x: np.cumsum(x[::-1])[::-1]
        out[c, r] = float((pos * upward(pos) / upward(beyond)).sum() / pos.sum())
    return out
