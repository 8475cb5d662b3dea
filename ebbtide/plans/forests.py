"""Random forests grown tree by tree from counts by bin, for tables MLlib's own growing is slow on."""

from __future__ import annotations

import json
import time
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import fresh_path

#: Up to so many rows MLlib grows a forest itself: it is as fast there.
FEW_ROWS = 20_000
#: Rows a block holds, whose bins are one value, and rows a task reads on average.
BLOCK = 32_768
TASK_ROWS = 2_000_000
#: Points a task's summary of a column keeps.
POINTS = 1024
#: Counts the trees of one pass may have together in a task's output.
PASS_CELLS = 1 << 25

# The distribution of how often a bootstrap draws a row, at a resolution of 16 bits.
_POISSON = np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 9)])), np.arange(1 << 16) / (1 << 16), side="right").astype(np.uint8)


def _summary(values: np.ndarray, counts: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts, at most ``points``: runs of neighbours are counted at their largest."""
    at, inverse = np.unique(values, return_inverse=True)
    n = np.bincount(inverse, weights=counts, minlength=len(at))
    if len(at) <= points:
        return at, n
    ends = np.unique(np.searchsorted(n.cumsum(), np.arange(1, points + 1) * (n.sum() / points) * (1 - 1e-12)))
    ends = np.append(ends[ends < len(at) - 1], len(at) - 1)
    return at[ends], np.diff(n.cumsum()[ends], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Between distinct values if these are at most ``bins``, else near equal shares of the rows."""
    if len(values) > bins:
        ends = np.unique(np.searchsorted(counts.cumsum(), np.arange(1, bins) * (counts.sum() / bins)))
        ends = ends[ends < len(values) - 1]
    else:
        ends = np.arange(len(values) - 1)
    low, high = values[ends], values[ends + 1]
    middle = low + (high - low) / 2
    return np.where((middle >= low) & (middle < high), middle, low)


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _all_thresholds(rows: DataFrame, size: int, bins: int) -> list[np.ndarray]:
    """Thresholds of every column, from all rows."""

    def summaries(batches):
        found, waiting = [(np.empty(0), np.empty(0))] * size, []

        def add():
            x = np.concatenate(waiting)
            for f, (values, counts) in enumerate(found):
                # far more points than are handed on, so that adding up shifts little
                found[f] = _summary(np.concatenate([values, x[:, f]]), np.concatenate([counts, np.ones(len(x))]), 16 * POINTS)
            waiting.clear()

        for batch in batches:
            waiting.append(_matrix(batch, size))
            if sum(map(len, waiting)) >= 4 * BLOCK:
                add()
        if waiting:
            add()
        out = [[], [], []]
        for f, (values, counts) in enumerate(_summary(*of, POINTS) if len(of[0]) else of for of in found):
            for column, v in zip(out, (np.full(len(values), f), values, counts)):
                column.append(v)
        arrays = [pa.array(np.concatenate(c), t) for c, t in zip(out, (pa.int32(), pa.float64(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["feature", "value", "n"])

    points = rows.mapInArrow(summaries, "feature int, value double, n double").groupBy("feature", "value").agg(F.sum("n").alias("n")).toArrow()
    feature, value, n = (points[c].to_numpy() for c in ("feature", "value", "n"))
    return [thresholds(*_summary(value[feature == f], n[feature == f], len(value) + 1), bins) for f in range(size)]


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``id, bins, labels``: the bins of up to ``BLOCK`` rows, a byte a column, row after row, and their labels."""
    size = len(cuts)

    def run(batches):
        part, n, waiting, labels = TaskContext.get().partitionId(), 0, [], []
        held = 0

        def block():
            x, y = np.concatenate(waiting), np.concatenate(labels)
            arrays = [pa.array([v], t) for v, t in (((part << 32) + n, pa.int64()), (x.tobytes(), pa.binary()), (y.tobytes(), pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, ["id", "bins", "labels"])

        for batch in batches:
            x = _matrix(batch, size)
            waiting.append(np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.uint8))
            labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8))
            held += len(x)
            if held >= BLOCK:
                yield block()
                n, held, waiting, labels = n + 1, 0, [], []
        if held:
            yield block()

    return rows.mapInArrow(run, "id long, bins binary, labels binary")


class _Tree:
    """A tree as it grows: per node the feature and bin that split it, its left child and its counts by class."""

    def __init__(self, seed: int, number: int):
        self.number = number
        self.rng = np.random.default_rng([seed, number])
        self.feature, self.bin, self.left = np.zeros(1, np.int32), np.full(1, 255, np.uint8), np.zeros(1, np.int32)
        self.counts, self.gain = np.zeros((1, 2)), np.full(1, -1.0)
        self.open = np.zeros(1, np.int64)

    def draw(self, size: int, some: int) -> None:
        """The features the open nodes may be split by."""
        drawn = self.rng.random((len(self.open), size))
        self.tried = np.sort(np.argpartition(drawn, some - 1, axis=1)[:, :some], axis=1).astype(np.int32)

    def grow(self, feature, bin_, left, right, gain, more: bool) -> None:
        """Split the open nodes that have a gain; their children that aren't pure are open next, if ``more``."""
        good = np.flatnonzero(gain > 0)
        at, first = self.open[good], len(self.feature)
        self.feature[at], self.bin[at], self.gain[at] = feature[good], bin_[good], gain[good]
        self.left[at] = first + 2 * np.arange(len(good))
        n = 2 * len(good)
        ids = first + np.arange(n)
        children = np.stack([left[good], right[good]], axis=1).reshape(-1, 2)
        self.feature = np.append(self.feature, np.zeros(n, np.int32))
        self.bin = np.append(self.bin, np.full(n, 255, np.uint8))
        self.left = np.append(self.left, ids.astype(np.int32))
        self.counts = np.concatenate([self.counts, children])
        self.gain = np.append(self.gain, np.full(n, -1.0))
        self.open = ids[(children > 0).all(1)] if more else ids[:0]

    def saved(self, cuts: list[np.ndarray]) -> list[np.ndarray]:
        """Columns of the saved nodes in their order, siblings that predict alike merged, as MLlib does."""
        inner = self.gain > 0
        levels, at = [], np.zeros(1, np.int64)
        while len(at):
            levels.append(at)
            down = self.left[at[inner[at]]].astype(np.int64)
            at = np.stack([down, down + 1], axis=1).reshape(-1)
        predicted = (self.counts[:, 1] > self.counts[:, 0]).astype(np.float64)
        size = np.ones(len(inner), np.int64)
        for at in reversed(levels):
            at = at[inner[at]]
            left, right = self.left[at], self.left[at] + 1
            same = ~inner[left] & ~inner[right] & (predicted[left] == predicted[right])
            inner[at[same]] = False
            at = at[~same]
            size[at] = 1 + size[self.left[at]] + size[self.left[at] + 1]
        place = np.full(len(inner), -1, np.int64)
        place[0] = 0
        for at in levels:
            at = at[inner[at] & (place[at] >= 0)]
            place[self.left[at]] = place[at] + 1
            place[self.left[at] + 1] = place[at] + 1 + size[self.left[at]]
        kept = np.flatnonzero(place >= 0)
        kept = kept[place[kept].argsort()]
        go, total = inner[kept], self.counts[kept].sum(1)
        cut = [[float(cuts[f][b])] if g else [] for f, b, g in zip(self.feature[kept], self.bin[kept], go)]
        impurity = _gini(self.counts[kept])
        left = np.where(go, place[np.where(go, self.left[kept], 0)], -1)
        right = np.where(go, place[np.where(go, self.left[kept] + 1, 0)], -1)
        return [np.full(len(kept), self.number), np.arange(len(kept)), predicted[kept], impurity, list(self.counts[kept]), total,
                np.where(go, self.gain[kept], -1.0), left, right, np.where(go, self.feature[kept], -1), cut, np.full(len(kept), -1)]


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(-1)
    share = counts / np.maximum(total, 1)[..., None]
    return np.where(total > 0, 1 - (share * share).sum(-1), 0.0)


def _counted(blocks: DataFrame, trees: list[_Tree], seed: int, widths: np.ndarray) -> DataFrame:
    """``tree, counts``: for each task and tree the rows of its open nodes by tried feature, bin and class."""
    size = len(widths)
    state = []
    for t in trees:
        spans = 2 * widths[t.tried].reshape(-1)
        place = np.full(len(t.feature), -1, np.int64)
        place[t.open] = np.arange(len(t.open))
        state.append((t.number, t.feature, t.bin, t.left, place, t.tried, (spans.cumsum() - spans).reshape(t.tried.shape), int(spans.sum())))

    def run(batches):
        held = []
        for batch in batches:
            for i, bins, labels in zip(*(batch.column(c).to_pylist() for c in range(3))):
                held.append((i, np.frombuffer(bins, np.uint8), np.frombuffer(labels, np.uint8)))
        if not held:
            return
        for number, feature, bin_, left, place, tried, starts, cells in state:
            feature, left, counts = feature.astype(np.int64), left.astype(np.int64), np.zeros(cells)
            for i, bins, labels in held:
                drawn = np.random.default_rng([seed, number, i]).integers(0, 1 << 16, len(labels), dtype=np.uint16)
                drawn = _POISSON[drawn]
                row = np.flatnonzero(drawn)
                first, node = row * size, np.zeros(len(row), np.int64)
                while True:
                    down = left[node] + (bins[first + feature[node]] > bin_[node])
                    if np.array_equal(down, node):
                        break
                    node = down
                at = place[node]
                inside = at >= 0
                at, row, first = at[inside], row[inside], first[inside]
                label, weight = labels[row].astype(np.int64), drawn[row].astype(np.float64)
                for j in range(tried.shape[1]):
                    cell = starts[at, j] + 2 * bins[first + tried[at, j]] + label
                    counts += np.bincount(cell, weight, cells)
            out = [pa.array([number], pa.int32()), pa.array([counts.astype("<i4").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["tree", "counts"])

    return blocks.mapInArrow(run, "tree int, counts binary")


def _best(trees: list[_Tree], widths: np.ndarray, least: int, least_gain: float):
    """Of a tree's summed counts the best split of each open node: feature, bin, gain, counts on both sides."""
    tried = {t.number: t.tried for t in trees}

    def run(key, table):
        number = key[0].as_py()
        counts = sum(np.frombuffer(c, "<i4").astype(np.float64) for c in table["counts"].to_pylist()).reshape(-1, 2)
        features = tried[number]
        nodes, some = features.shape
        spans = widths[features.reshape(-1)]
        ends = spans.cumsum()
        starts = ends - spans
        slot = np.repeat(np.arange(len(spans)), spans)
        running = np.concatenate([np.zeros((1, 2)), counts.cumsum(0)])
        left = running[1:] - running[starts][slot]
        whole = running[ends] - running[starts]
        right = whole[slot] - left
        n_left, n_right = left.sum(1), right.sum(1)
        n = np.maximum(n_left + n_right, 1)
        gain = _gini(whole)[slot] - (n_left * _gini(left) + n_right * _gini(right)) / n
        last = np.zeros(len(slot), bool)
        last[ends - 1] = True
        gain[last | (n_left < least) | (n_right < least) | (gain < least_gain)] = -1.0
        of = starts.reshape(nodes, some)[:, 0]
        most = np.maximum.reduceat(gain, of)
        hit = np.flatnonzero(gain >= np.repeat(most, spans.reshape(nodes, some).sum(1)))
        node = slot[hit] // some
        at = hit[np.unique(node, return_index=True)[1]]
        found = features.reshape(-1)[slot[at]].astype("<f8"), (at - starts[slot[at]]).astype("<f8"), gain[at], left[at], right[at]
        return pa.table({"tree": pa.array([number], pa.int32()), "splits": pa.array([np.column_stack(found).astype("<f8").tobytes()], pa.binary())})

    return run


def _grown(blocks: DataFrame, widths: np.ndarray, trees: int, depth: int, some: int, seed: int, least: int, least_gain: float) -> list[_Tree]:
    """All trees, level by level; a pass over the blocks counts for as many trees as ``PASS_CELLS`` admits."""
    grown = [_Tree(seed, t) for t in range(trees)]
    for level in range(depth):
        waiting = [t for t in grown if len(t.open)]
        for t in waiting:
            t.draw(len(widths), some)
        while waiting:
            cells, now = 0, []
            while waiting and (not now or cells + (more := 2 * int(widths[waiting[0].tried].sum())) <= PASS_CELLS):
                cells += more if now else 2 * int(widths[waiting[0].tried].sum())
                now.append(waiting.pop(0))
            counted = _counted(blocks, now, seed, widths)
            by_number = {t.number: t for t in now}
            found = counted.groupBy("tree").applyInArrow(_best(now, widths, least, least_gain), "tree int, splits binary").toArrow()
            for number, splits in zip(found["tree"].to_pylist(), found["splits"].to_pylist()):
                s = np.frombuffer(splits, "<f8").reshape(-1, 7)
                tree = by_number[number]
                if level == 0:
                    tree.counts[0] = s[0, 3:5] + s[0, 5:7]
                tree.grow(s[:, 0].astype(np.int32), s[:, 1].astype(np.uint8), s[:, 3:5], s[:, 5:7], s[:, 2], level + 1 < depth)
    return grown


class Forest(RandomForestClassifier):
    """MLlib's random forest, with another way of growing it on many rows.

    Rows become bins once, a byte a slot. A pass over them counts, one tree after another, so that the counts in
    use stay in a core's cache, and sums meet by tree. Splits, bootstrap, feature subsets, stopping and merging of
    leaves are MLlib's; random numbers aren't, and thresholds come from all rows. The result is MLlib's model.
    What this doesn't cover (weights, several classes, categories with numbers, other settings, few rows) MLlib grows.
    """

    def _covered(self, dataset: DataFrame) -> bool:
        get = self.getOrDefault
        attrs = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        return (
            not self.isSet("weightCol") and not self.isSet("thresholds") and "nominal" not in attrs and get("maxDepth") > 0
            and get("impurity") == "gini" and get("bootstrap") and get("subsamplingRate") == 1.0 and get("minWeightFractionPerNode") == 0.0
            and get("featureSubsetStrategy") in ("auto", "sqrt") and get("numTrees") > 1 and 2 <= get("maxBins") <= 256 and not get("leafCol")
        )

    def _fit(self, dataset: DataFrame):
        if not self._covered(dataset):
            return super()._fit(dataset)
        label = F.col(self.getLabelCol()).cast("double")
        n, fine, top, size = dataset.agg(
            F.count(F.lit(1)), F.count_if(label.isin(0.0, 1.0)), F.max(label), F.max(F.size(vector_to_array(self.getFeaturesCol())))
        ).first()
        if n <= FEW_ROWS or fine < n or top != 1.0:
            return super()._fit(dataset)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()), label)
        get = self.getOrDefault
        cuts = _all_thresholds(rows, size, get("maxBins"))
        widths = np.array([len(c) + 1 for c in cuts], np.int64)
        wanted = max(3 * dataset.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
        blocks = _blocks(rows.coalesce(wanted), cuts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = _grown(blocks, widths, get("numTrees"), get("maxDepth"), ceil(sqrt(size)), get("seed") % (1 << 63),
                           get("minInstancesPerNode"), get("minInfoGain"))
        finally:
            blocks.unpersist()
        return self._model(dataset.sparkSession, trees, cuts)

    def _model(self, spark, trees: list[_Tree], cuts: list[np.ndarray]) -> RandomForestClassificationModel:
        """The trees as MLlib's model, by way of its saved form."""
        path, now = fresh_path(spark, "forest"), int(time.time() * 1000)

        def metadata(kind: str, uid: str, given: dict, default: dict, **more) -> str:
            of_kind = {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": now, "sparkVersion": spark.version, "uid": uid}
            return json.dumps({**of_kind, "paramMap": given, "defaultParamMap": default, **more})

        given, default = ({p.name: v for p, v in m.items()} for m in (self._paramMap, self._defaultParamMap))
        whole = metadata("RandomForestClassificationModel", self.uid, given, default, numFeatures=len(cuts), numClasses=2, numTrees=len(trees))
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        shared = ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "impurity", "featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol")
        of_trees = {k: v for k, v in (default | given).items() if k in shared}
        each = [(t.number, metadata("DecisionTreeClassificationModel", f"dtc_{self.uid}_{t.number}", {}, of_trees), 1.0) for t in trees]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        columns = [np.concatenate(c) if isinstance(c[0], np.ndarray) else [v for part in c for v in part] for c in zip(*(t.saved(cuts) for t in trees))]
        names = ("treeID", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "featureIndex", "cut", "numCategories")
        types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.int32())
        table = pa.table({n: pa.array(c, t) if not pa.types.is_integer(t) else pc.cast(pa.array(c), t, safe=False) for n, c, t in zip(names, columns, types)})
        split = F.struct("featureIndex", F.col("cut").alias("leftCategoriesOrThreshold"), "numCategories").alias("split")
        nodes = spark.createDataFrame(table).select("treeID", F.struct(*names[1:9], split).alias("nodeData"))
        nodes.coalesce(1).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)
