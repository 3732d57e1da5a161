"""Boosted regression trees over sparse features, at a cost that goes by what the rows hold.

MLlib adds up every feature of every row at each level of each tree. Here a row is the list of its cells, the
(feature, bin) pairs outside its features' bins of zero; what these hold is what a node holds less the others.
Of two children only the smaller is added up, the larger is the rest of its parent. Nodes of many rows are
added up side by side in all parts of the rows; the rows of the others travel once to the task that grows
all that lies below. Bins, gains, leaves and weights are those of MLlib's `GBTRegressor` with squared error
on unweighted rows; among splits of equal gain rounding may choose another one, as MLlib's does between runs.
"""

import heapq
import json
import time
from functools import partial
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatline.session import drop_folder, fresh_folder, shared_folder, ship

#: Entries of the rows of a node that one task grows on alone.
ALONE = 1 << 24
#: Cells of nodes, and entries of rows, that are held at once.
CELLS, ENTRIES = 1 << 22, 1 << 21
#: Rounds between two checkpoints of the predictions, and rows from which bins are found at least (as in MLlib).
KEPT, SAMPLE = 10, 10_000
#: Share of a node's mean square below which a gain is rounding; half the last place (of 2 ** 52) that tells two gains apart.
NOISE, HALF = 1e-15, 1 << 15
PACKED = "lengths binary, features binary, values binary, labels binary"
NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
         "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,"
         "numCategories:int>>")


class Layout(NamedTuple):
    """Where the cells of each feature lie: features of equally many bins stand together, those of one bin nowhere."""
    size: int
    first: np.ndarray
    bins: np.ndarray
    zero: np.ndarray
    thresholds: np.ndarray
    groups: list[tuple[int, int, np.ndarray]]


class Block(NamedTuple):
    """Some rows: where the cells of each begin, the cells in order, label and prediction so far."""
    starts: np.ndarray
    cells: np.ndarray
    label: np.ndarray
    prediction: np.ndarray


class Tree:
    """Per node the feature (-1: a leaf) and last bin of its left child, the children, gain and (rows, sum, squares)."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.gain, self.sums = [], [], [], [], [], []

    def grow(self) -> int:
        for column, value in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.gain, -1.0),
                              (self.sums, None)):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node: int, gain: float, feature: int, last: int) -> tuple[int, int]:
        self.gain[node], self.feature[node], self.bin[node] = float(gain), int(feature), int(last)
        self.left[node], self.right[node] = self.grow(), self.grow()
        return self.left[node], self.right[node]

    def attach(self, node: int, other: "Tree") -> None:
        """`other` in the place of a leaf."""
        place = [node, *[self.grow() for _ in other.feature[1:]]]
        for k, at in enumerate(place):
            self.feature[at], self.bin[at], self.gain[at], self.sums[at] = (
                other.feature[k], other.bin[k], other.gain[k], other.sums[k])
            if other.feature[k] >= 0:
                self.left[at], self.right[at] = place[other.left[k]], place[other.right[k]]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c, np.int64) for c in (self.feature, self.bin, self.left, self.right))

    def means(self) -> np.ndarray:
        return np.array([s[1] / s[0] for s in self.sums])


# -- bins ----------------------------------------------------------------------------------------

def packed(batches):
    """Arrow batches of (vector struct, label) as arrays of bytes."""
    for batch in batches:
        vector, label = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        lists, places = vector.field("values"), vector.field("indices")
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        values, named = lists.flatten().to_numpy(zero_copy_only=False), places.flatten().to_numpy(zero_copy_only=False)
        dense = np.repeat(vector.field("type").to_numpy(zero_copy_only=False) == 1, lengths)
        features = ranges(np.zeros(len(lengths), np.int64), lengths)
        features[~dense] = named
        if np.isnan(label).any() or not np.isfinite(values).all():
            raise ValueError("labels must be known and features finite")
        arrays = [lengths, features.astype(np.int32), values, label]
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays],
                                         ["lengths", "features", "values", "labels"])


def unpacked(records) -> tuple[np.ndarray, ...]:
    """(lengths, features, values, labels) of all records together."""
    kinds, records = (np.int64, np.int32, np.float64, np.float64), list(records)
    return tuple(np.concatenate([np.zeros(0, kind), *[np.frombuffer(r[i], kind) for r in records]]) for i, kind in enumerate(kinds))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] places, then those of the next."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def value_counts(records):
    """(feature, (values, counts)) of a part, zeros left out; the number of rows as feature -1."""
    lengths, features, values, _ = unpacked(records)
    yield -1, (np.zeros(1), np.array([len(lengths)]))
    order = np.lexsort((values, features))
    features, values = features[order], values[order]
    kept = values != 0
    features, values = features[kept], values[kept]
    edges = np.flatnonzero(np.diff(features, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(features)]):
        yield int(features[a]), np.unique(values[a:b], return_counts=True)


def split_points(found: list[tuple], rows: int, most: int) -> list[float]:
    """Thresholds between values: all if they are at most `most`, else at about equal counts of rows."""
    values, inverse = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([n for _, n in found])).astype(float)
    if rows > counts.sum():
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, rows - counts.sum())
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= most:
        return between.tolist()
    stride, reached = rows / (most + 1), np.cumsum(counts)
    target, points = stride, []
    for k in range(1, len(values)):
        if abs(reached[k - 1] - target) < abs(reached[k] - target):
            points.append(float(between[k - 1]))
            target += stride
    return points


def layout_of(points: dict[int, list[float]], size: int, most: int) -> Layout:
    width = 1
    while width - 1 < most:
        width *= 2
    thresholds = np.full((size, width - 1), np.inf)
    for feature, found in points.items():
        thresholds[feature, :len(found)] = found
    bins = np.isfinite(thresholds).sum(axis=1) + 1
    first, zero, groups, at = np.full(size, -1), (thresholds < 0).sum(axis=1), [], 0
    for count in np.unique(bins[bins > 1]):
        own = np.flatnonzero(bins == count)
        first[own] = at + np.arange(len(own)) * count
        groups.append((at, int(count), own))
        at += len(own) * int(count)
    return Layout(at, first, bins, zero, thresholds, groups)


def bins_of(features: np.ndarray, values: np.ndarray, layout: Layout) -> np.ndarray:
    """Thresholds below each value, halving the places left."""
    found = np.zeros(len(features), np.int64)
    step = (layout.thresholds.shape[1] + 1) // 2
    while step:
        found += step * (layout.thresholds[features, found + step - 1] < values)
        step //= 2
    return found


def binned(record, layout) -> Block:
    layout = layout.value
    lengths, features, values, labels = unpacked([record])
    bins = bins_of(features, values, layout)
    kept = (layout.first[features] >= 0) & (bins != layout.zero[features])
    row = np.repeat(np.arange(len(lengths)), lengths)[kept]
    key = np.sort(row * layout.size + layout.first[features[kept]] + bins[kept])
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lengths)))]).astype(np.int64)
    kind = np.uint16 if layout.size <= 1 << 16 else np.int32
    return Block(starts, (key % max(layout.size, 1)).astype(kind), labels, np.zeros(len(labels)))


# -- trees ---------------------------------------------------------------------------------------

def row_sums(slot, target, slots: int) -> np.ndarray:
    """Rows, sum and squares of the target per slot."""
    return np.stack([np.bincount(slot, w, slots) for w in (None, target, target * target)], axis=1)


def profiles(starts, cells, slot, target, slots: int, layout: Layout) -> np.ndarray:
    """Per slot the rows and sums of the target in each cell, and the slot's rows, sum and squares; rows without a slot are -1."""
    size, rows = layout.size, np.flatnonzero(slot >= 0)
    out = np.zeros((slots, 2 * size + 3))
    slot, target = slot[rows], target[rows]
    out[:, 2 * size:] = row_sums(slot, target, slots)
    begin, lengths = starts[rows], starts[rows + 1] - starts[rows]
    ends = np.cumsum(lengths)
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + ENTRIES, "right")))
        if begin[b - 1] - begin[a] == ends[b - 1] - lengths[b - 1] - ends[a] + lengths[a]:
            at = cells[begin[a]:begin[b - 1] + lengths[b - 1]]
        else:
            at = cells[ranges(begin[a:b], lengths[a:b])]
        at = at + np.repeat(slot[a:b] * size, lengths[a:b])
        out[:, :size] += np.bincount(at, minlength=slots * size).reshape(slots, size)
        out[:, size:2 * size] += np.bincount(at, np.repeat(target[a:b], lengths[a:b]), slots * size).reshape(slots, size)
        a = b
    return out


def best_splits(found: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, last bin of the left child) per profile; of gains that are equal but for rounding the first feature."""
    k, size = len(found), layout.size
    n, total, squares = found[:, 2 * size:].T
    best, feature, last = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
    rank = np.zeros(k, np.int64)
    for at, bins, features in layout.groups:
        m = len(features)
        count, summed = (found[:, s + at:s + at + m * bins].reshape(k, m, bins).copy() for s in (0, size))
        own = np.arange(m), layout.zero[features]
        count[:, *own] = n[:, None] - count.sum(axis=2)
        summed[:, *own] = total[:, None] - summed.sum(axis=2)
        count, summed = np.cumsum(count, axis=2)[:, :, :-1], np.cumsum(summed, axis=2)[:, :, :-1]
        rest = n[:, None, None] - count
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = summed ** 2 / count + (total[:, None, None] - summed) ** 2 / rest
        gain -= (total ** 2 / n)[:, None, None]
        gain[(count < 0.5) | (rest < 0.5) | (gain <= (NOISE * squares)[:, None, None])] = 0
        # The bits of doubles from 0 on are in their order: the last ones are rounded away.
        ranks = (gain.reshape(k, m * (bins - 1)).view(np.int64) + HALF) // (2 * HALF)
        top = np.argmax(ranks, axis=1)
        ranks = ranks[np.arange(k), top]
        better = (ranks > rank) | (ranks == rank) & (ranks > 0) & (features[top // (bins - 1)] < feature)
        rank[better], top = ranks[better], top[better]
        best[better] = gain.reshape(k, -1)[better, top]
        feature[better], last[better] = features[top // (bins - 1)], top % (bins - 1)
    return best / n, feature, last


def bins_in(starts, cells, rows, feature, layout: Layout) -> np.ndarray:
    """The bin of one feature in each row: its cell, if the row has one, is found by halving the row."""
    wanted, low, high = layout.first[feature], starts[rows], starts[rows + 1]
    end, last = high, len(cells) - 1
    while (open := low < high).any():
        middle = (low + high) >> 1
        less = cells[np.minimum(middle, last)] < wanted
        low, high = np.where(less & open, middle + 1, low), np.where(less, high, middle)
    if last < 0:
        return layout.zero[feature]
    there = cells[np.minimum(low, last)].astype(np.int64) - wanted
    return np.where((low < end) & (there < layout.bins[feature]), there, layout.zero[feature])


def moved(starts, cells, layout: Layout, at: np.ndarray, rows: np.ndarray, tree) -> None:
    """Rows in split nodes go on to the child."""
    feature, last, left, right = tree
    node = at[rows]
    at[rows] = np.where(bins_in(starts, cells, rows, feature[node], layout) <= last[node], left[node], right[node])


def places(block: Block, tree, layout: Layout) -> np.ndarray:
    """The node of each row."""
    at, feature = np.zeros(len(block.label), np.int64), tree[0]
    rows = np.flatnonzero(feature[at] >= 0)
    while len(rows):
        moved(block.starts, block.cells, layout, at, rows, tree)
        rows = rows[feature[at[rows]] >= 0]
    return at


def target_of(block: Block, first: bool) -> np.ndarray:
    """What a tree learns: the labels, then twice what they are above the prediction."""
    return block.label if first else 2 * (block.label - block.prediction)


def subtree(starts, cells, target, depth: int, layout: Layout) -> Tree:
    """The tree of these rows. Nodes of a level are split together, as many as their profiles may take."""
    tree, at = Tree(), np.zeros(len(target), np.int64)

    def told(sums: np.ndarray, nodes) -> np.ndarray:
        """Notes the sums of the nodes; which of them can be split."""
        for node in nodes:
            tree.sums[node] = sums[node].tolist()
        n, total, squares = sums[nodes].T
        return (n > 1) & (squares - total ** 2 / n > NOISE * squares)

    def visit(nodes: np.ndarray, found: np.ndarray, left: int) -> None:
        gain, feature, last = best_splits(found, layout)
        parents = np.flatnonzero(feature >= 0)
        if not len(parents):
            return
        pairs = np.array([tree.split(int(nodes[k]), gain[k], feature[k], last[k]) for k in parents])
        own = np.zeros(len(tree.feature), bool)
        own[nodes[parents]] = True
        rows = np.flatnonzero(own[at])
        moved(starts, cells, layout, at, rows, tree.arrays())
        sums = row_sums(at[rows], target[rows], len(tree.feature))
        worth = told(sums, pairs.ravel()).reshape(-1, 2)
        some = np.flatnonzero(worth.any(axis=1)) if left > 1 else []
        step = max(1, CELLS // (2 * layout.size))
        for a in range(0, len(some), step):
            ask = some[a:a + step]
            less = (sums[pairs[ask, 0], 0] > sums[pairs[ask, 1], 0]).astype(int)
            slots = np.full(len(tree.feature), -1)
            slots[pairs[ask, less]] = np.arange(len(ask))
            small = profiles(starts, cells, slots[at], target, len(ask), layout)
            first, second = worth[ask, less], worth[ask, 1 - less]
            large = found[parents[ask[second]]]
            large -= small[second]
            visit(np.concatenate([pairs[ask, less][first], pairs[ask, 1 - less][second]]),
                  np.concatenate([small[first], large]), left - 1)

    root = tree.grow()
    if told(row_sums(at, target, 1), [root])[0] and depth and layout.size:
        visit(np.array([root]), profiles(starts, cells, at, target, 1, layout), depth)
    return tree


def node_profiles(blocks, tree, nodes, first, layout):
    """(place in `nodes`, profile) of the nodes that rows of the part are in."""
    layout, found = layout.value, 0
    slots = np.full(len(tree[0]), -1)
    slots[nodes] = np.arange(len(nodes))
    for block in blocks:
        slot = slots[places(block, tree, layout)]
        found = found + profiles(block.starts, block.cells, slot, target_of(block, first), len(nodes), layout)
    if not np.isscalar(found):
        yield from ((k, own) for k, own in enumerate(found) if own[2 * layout.size])


def node_rows(part, blocks, tree, nodes, first, layout):
    """(node, ((part, block), lengths, cells, targets)) of the listed nodes that rows of a block are in."""
    for k, block in enumerate(blocks):
        at = places(block, tree, layout.value)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], nodes), np.searchsorted(at[order], nodes, "right")
        lengths, target = np.diff(block.starts), target_of(block, first)
        for node, a, b in zip(nodes, *edges):
            if a < b:
                own = order[a:b]
                yield int(node), ((part, k), lengths[own], block.cells[ranges(block.starts[own], lengths[own])], target[own])


def subtrees(records, depths, layout):
    """(node, tree) for each node of which this task has the rows."""
    own = {}
    for node, rows in records:
        own.setdefault(node, []).append(rows)
    for node, parts in own.items():
        parts.sort(key=lambda p: p[0])
        lengths, cells, target = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        yield node, subtree(starts, cells, target, depths[node], layout.value)


def dealt(loads: dict[int, int], tasks: int) -> dict[int, int]:
    """A task for each node, the largest first to the task of the fewest rows."""
    free, place = [(0, t) for t in range(tasks)], {}
    for node, rows in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        held, task = heapq.heappop(free)
        place[node] = task
        heapq.heappush(free, (held + rows, task))
    return place


def grown(rows: RDD, count: int, most: int, depth: int, first: bool, layout) -> Tree:
    """The next tree. Profiles of nodes of more than `most` rows come to the driver, as many as it may hold."""
    tree, parts = Tree(), rows.getNumPartitions()
    held, level, below = {}, [(tree.grow(), count)], {}

    def counted(nodes: list[int]) -> dict[int, np.ndarray]:
        task = partial(node_profiles, tree=tree.arrays(), nodes=np.array(nodes), first=first, layout=layout)
        found = rows.mapPartitions(task).reduceByKey(add, min(len(nodes), parts)).collect()
        return {nodes[k]: own for k, own in found}

    def halves(pairs: list[tuple]) -> dict[int, np.ndarray]:
        """Profiles of the nodes asked for, of two children the smaller one's and what the parent has besides."""
        found = counted([k for small, _, _ in pairs for k in small])
        for small, large, parent in pairs:
            if parent is not None:
                found[large] = parent - found[small[0]]
        return found

    for k in range(depth + 1):
        large = [(node, n) for node, n in level if n > most and k < depth]
        below |= {node: (n, depth - k) for node, n in level if n <= most or k == depth}
        if not large:
            break
        wanted, asked = dict(large), []
        for node, n in large:
            parent, sibling, other = held.get(node, (None, None, 0))
            if parent is None:
                asked.append(([node], None, None))
            elif n >= other and not (n == other and sibling in wanted and sibling < node):
                asked.append(([sibling], node, parent))
        step, level, kept = max(1, CELLS // (2 * layout.value.size + 3)), [], {}
        for a in range(0, len(asked), step):
            found = halves(asked[a:a + step])
            nodes = [node for node in found if node in wanted]
            gain, feature, last = best_splits(np.stack([found[node] for node in nodes]), layout.value)
            for i, node in enumerate(nodes):
                tree.sums[node] = found[node][2 * layout.value.size:].tolist()
                if feature[i] < 0:
                    continue
                pair = tree.split(node, gain[i], feature[i], last[i])
                number = rows_left(found[node], feature[i], last[i], layout.value)
                sizes = number, wanted[node] - number
                level += zip(pair, sizes)
                if len(kept) < 2 * step:
                    kept |= {pair[s]: (found[node], pair[1 - s], sizes[1 - s]) for s in (0, 1)}
        held = kept
    if below:
        loads = {node: n for node, (n, _) in below.items()}
        place, depths = dealt(loads, min(parts, len(loads))), {node: d for node, (_, d) in below.items()}
        task = partial(node_rows, tree=tree.arrays(), nodes=np.array(sorted(loads)), first=first, layout=layout)
        sent = rows.mapPartitionsWithIndex(task).partitionBy(min(parts, len(loads)), place.get)
        for node, other in sorted(sent.mapPartitions(partial(subtrees, depths=depths, layout=layout)).collect(), key=lambda x: x[0]):
            tree.attach(node, other)
    return tree


def rows_left(found: np.ndarray, feature: int, last: int, layout: Layout) -> int:
    """Rows that go to the left child."""
    first, zero = layout.first[feature], layout.zero[feature]
    counts = found[first:first + layout.bins[feature]].copy()
    counts[zero] = found[2 * layout.size] - counts.sum()
    return int(round(counts[:last + 1].sum()))


def stepped(block: Block, tree, values, layout) -> Block:
    return block._replace(prediction=block.prediction + values[places(block, tree, layout.value)])


# -- fits ----------------------------------------------------------------------------------------

def fit(model: GBTRegressor, rows: DataFrame) -> GBTRegressionModel:
    """`model.fit(rows)` for squared error, all features at every split and no subsampling."""
    if (model.getLossType(), model.getFeatureSubsetStrategy(), model.getSubsamplingRate()) != ("squared", "all", 1.0):
        raise ValueError("squared error over all rows and features only")
    if model.getMinInstancesPerNode() != 1 or model.getMinInfoGain() or model.getMinWeightFractionPerNode():
        raise ValueError("nodes of any size and gain only")
    spark = ship(rows.sparkSession)
    shared_folder(spark)
    rows = rows.select(F.col(model.getFeaturesCol()).alias("vector"), F.col(model.getLabelCol()).cast("double").alias("label"))
    size = rows.first()[0].size
    count = rows.count()
    sample = max(model.getMaxBins() ** 2, SAMPLE)
    some = rows if count <= sample else rows.sample(sample / count, model.getSeed())
    layout = spark.sparkContext.broadcast(find_layout(some, size, min(model.getMaxBins(), count) - 1))
    trees = boosted(spark, arrays_of(rows).map(partial(binned, layout=layout)), count, model, layout)
    found = stored_model(spark, model, trees, size, layout.value)
    layout.unpersist()
    return found


def arrays_of(rows: DataFrame) -> RDD:
    return rows.select(F.unwrap_udt("vector"), "label").mapInArrow(packed, PACKED).rdd


def find_layout(rows: DataFrame, size: int, most: int) -> Layout:
    found = arrays_of(rows).mapPartitions(value_counts).groupByKey().mapValues(list).persist(StorageLevel.MEMORY_AND_DISK)
    number = sum(int(n[0]) for _, own in found.filter(lambda x: x[0] < 0).collect() for _, n in own)
    points = found.filter(lambda x: x[0] >= 0).mapValues(lambda own: split_points(own, number, most)).collect()
    found.unpersist()
    return layout_of(dict(points), size, most)


def boosted(spark: SparkSession, rows: RDD, count: int, model: GBTRegressor, layout) -> list[Tree]:
    """A tree a round. Predictions travel with the rows, stored anew after every round."""
    trees, checkpoint, before = [], None, None
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    entries = rows.map(lambda block: len(block.cells)).sum()
    most = max(1, ALONE * count // max(1, entries))
    for k in range(model.getMaxIter()):
        if k:
            values = trees[-1].means() * (1.0 if k == 1 else model.getStepSize())
            before, rows = rows, rows.map(partial(stepped, tree=trees[-1].arrays(), values=values, layout=layout))
            rows.persist(StorageLevel.MEMORY_AND_DISK)
        if k % KEPT == KEPT - 1:
            rows.checkpoint()
        trees.append(grown(rows, count, most, model.getMaxDepth(), k == 0, layout))
        if before is not None:
            before.unpersist()
        if rows.isCheckpointed():
            if checkpoint:
                drop_folder(spark, checkpoint)
            checkpoint = rows.getCheckpointFile()
    rows.unpersist()
    if checkpoint:
        drop_folder(spark, checkpoint)
    return trees


def node_table(number: int, tree: Tree, layout: Layout) -> list[tuple]:
    """The nodes as MLlib stores them, a parent before its left and then its right side."""
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        if tree.feature[node] >= 0:
            stack += [tree.right[node], tree.left[node]]
    place, rows = {node: k for k, node in enumerate(order)}, []
    for node in order:
        n, total, squares = tree.sums[node]
        impurity, f = max(0.0, squares / n - (total / n) ** 2), tree.feature[node]
        children, split = (-1, -1), (-1, [], -1)
        if f >= 0:
            children = place[tree.left[node]], place[tree.right[node]]
            split = (f, [float(layout.thresholds[f, tree.bin[node]])], -1)
        rows.append((number, (place[node], total / n, impurity, [n, total, squares], int(round(n)), tree.gain[node], *children, split)))
    return rows


def stored_model(spark: SparkSession, model: GBTRegressor, trees: list[Tree], size: int, layout: Layout) -> GBTRegressionModel:
    """The trees in the format in which MLlib stores them, read by MLlib."""
    own = {p.name: model.getOrDefault(p) for p in model.params if model.isSet(p)}
    usual = {p.name: model.getOrDefault(p) for p in model.params if model.hasDefault(p) and not model.isSet(p)}
    said = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = {"class": "org.apache.spark.ml.regression.GBTRegressionModel", **said, "uid": model.uid, "paramMap": own,
             "defaultParamMap": usual, "numFeatures": size, "numTrees": len(trees)}
    boosting = {"maxIter", "stepSize", "lossType", "featureSubsetStrategy", "subsamplingRate", "validationTol"}
    one = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", **said,
           "paramMap": {k: v for k, v in own.items() if k not in boosting},
           "defaultParamMap": {k: v for k, v in usual.items() if k not in boosting}}
    listed = [(k, json.dumps({**one, "uid": f"dtr_{model.uid}_{k}"}), 1.0 if k == 0 else model.getStepSize()) for k in range(len(trees))]
    nodes = [row for k, tree in enumerate(trees) for row in node_table(k, tree, layout)]
    path = fresh_folder(spark, "trees")
    try:
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(nodes, NODES, verifySchema=False).write.parquet(f"{path}/data")
        return GBTRegressionModel.load(path)
    finally:
        drop_folder(spark, path)
