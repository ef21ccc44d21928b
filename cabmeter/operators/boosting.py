"""Boosted regression trees for squared error, as Spark's ``GBTRegressor`` grows them.

Same candidate thresholds (its sample and its rule), same gains, leaf rules,
rounds and weights, and a ``GBTRegressionModel`` comes out.  What differs is
how rows are kept and counted:

* Rows are binned once.  The bins of several features make one code, so a row
  is a few bytes and its residual, in blocks of ``CHUNK`` rows that Spark
  caches (and spills); Spark keeps an object a row, beside its residuals.
* A pass over the rows adds residuals up by code in numpy.  A node's sibling
  is what it leaves of their parent, so after the root only the rows of the
  smaller children are counted.
* A row's node comes from one table look-up a code instead of one comparison a
  level: the entry has a bit for each leaf that the code does not rule out,
  and the lowest bit that is left is the row's leaf.
"""

from __future__ import annotations

import json
import time

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame

from ..session import checkpoint_dir, scratch_path

BLOCK = 1 << 14       # rows of a packed block when blocks are dealt to partitions
CHUNK = 1 << 16       # rows of a cached block, so that a worker's arrays stay in a processor's cache
CELLS = 1 << 12       # codes of a group of features, so that a node's sums stay in a processor's cache
HELD = 1 << 16        # that many rows (a few bytes each) are worked on where they are collected
DEPTH = 6             # deepest trees whose leaves fit the bits of a word
DIRECT = 32           # partitions whose sums the driver adds up itself
EVERY = 10            # rounds between checkpoints
EPSILON = 2.0 ** -52
TREE_PARAMS = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")


# ---------------------------------------------------------------------------
# Bins.
# ---------------------------------------------------------------------------
def candidate_thresholds(values, fraction: float, rows: int, most: int):
    """Thresholds of one numeric feature from its sampled values: between all
    distinct values if these are few, else at about equal counts (the rule of
    ``RandomForest.findSplitsForContinuousFeature``)."""
    some = values[values != 0.0]
    if not len(some):
        return np.empty(0)
    distinct, counts = np.unique(some, return_counts=True)
    counts = counts.astype(float)
    expected = fraction * rows
    if expected - len(some) > EPSILON * len(some) * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, expected - len(some))
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    out, seen, target = [], counts[0], stride
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def _sampled(df: DataFrame, fraction: float, seed: int) -> list:
    """The columns of the rows that ``GBTRegressor`` samples for its thresholds;
    their number follows ``maxBins``, not the rows."""
    spark = df.sparkSession
    if fraction < 1.0:
        rows = df._jdf.toJavaRDD().sample(False, fraction, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        df = DataFrame(spark._jsparkSession.createDataFrame(rows, df._jdf.schema()), spark)
    return [c.to_numpy() for c in df.toArrow().columns]


def grouped(sizes: list[int]) -> list[list[int]]:
    """Features with two bins or more in groups whose codes stay below
    ``CELLS`` (a wider feature is alone)."""
    groups: list[list[int]] = []
    for f in sorted((f for f, n in enumerate(sizes) if n > 1), key=lambda f: -sizes[f]):
        for g in groups:
            if sizes[f] * int(np.prod([sizes[i] for i in g])) <= CELLS:
                g.append(f)
                break
        else:
            groups.append([f])
    return groups


class Layout:
    """How the bins of a row are kept: groups of features, the codes of each
    group and the bin of a feature in each of them."""

    def __init__(self, maps: list, thresholds: list):
        self.maps, self.thresholds = maps, thresholds
        categories = self.categories = [len(m) for m in maps]
        self.sizes = [c if c > 1 else len(t) + 1 for c, t in zip(categories, thresholds)]
        self.groups = grouped(self.sizes)
        self.radices = [[self.sizes[f] for f in g] for g in self.groups]
        self.codes = [int(np.prod(r)) for r in self.radices]
        self.types = ["u1" if n <= 1 << 8 else "u2" if n <= 1 << 16 else "u4" for n in self.codes]
        self.place, self.digit = {}, {}
        for g, members in enumerate(self.groups):
            digits = np.unravel_index(np.arange(self.codes[g]), self.radices[g])
            for f, d in zip(members, digits):
                self.place[f], self.digit[f] = g, d


def _packer(layout: Layout):
    """Rows (features, label) of Arrow batches to blocks of codes and labels."""
    thresholds, groups, radices, types = layout.thresholds, layout.groups, layout.radices, layout.types
    maps = [(np.array(sorted(m)), np.array([m[v] for v in sorted(m)], np.int64)) if len(m) > 1 else None for m in layout.maps]

    def bins(f, v):
        if maps[f] is None:
            return np.searchsorted(thresholds[f], v, "left")
        values, places = maps[f]
        at = np.searchsorted(values, v).clip(max=len(values) - 1)
        if (values[at] != v).any():
            raise ValueError(f"feature {f} has a value that is none of its categories")
        return places[at]

    def block(columns):
        if not all(np.isfinite(c).all() for c in columns):
            raise ValueError("features and labels must not be missing or infinite")
        out = []
        for members, sizes, kind in zip(groups, radices, types):
            code = np.zeros(len(columns[-1]), np.int64)
            for f, n in zip(members, sizes):
                code *= n
                code += bins(f, columns[f])
            out.append(code.astype(kind).tobytes())
        return b"".join(out), columns[-1].tobytes()

    def run(batches):
        import pyarrow as pa

        def made(parts):
            packed, labels = block([np.concatenate(c) for c in zip(*parts)])
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([labels], pa.binary())], ["codes", "labels"])

        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                held += batch.num_rows
            if held >= BLOCK:
                yield made(parts)
                parts, held = [], 0
        if held:
            yield made(parts)

    return run


def _parted(codes: bytes, rows: int, types) -> list:
    out, at = [], 0
    for kind in types:
        out.append(np.frombuffer(codes, kind, rows, at))
        at += rows * out[-1].itemsize
    return out


def _joined(types):
    """Blocks of a partition to larger ones: (codes, residuals, squares by leaf)."""

    def made(blocks):
        parts = [_parted(c, len(y) // 8, types) for c, y in blocks]
        codes = b"".join(np.concatenate([p[g] for p in parts]).tobytes() for g in range(len(types)))
        return codes, b"".join(y for _, y in blocks), b""

    def run(rows):
        blocks, held = [], 0
        for row in rows:
            blocks.append((bytes(row[0]), bytes(row[1])))
            held += len(row[1]) // 8
            if held >= CHUNK:
                yield made(blocks)
                blocks, held = [], 0
        if blocks:
            yield made(blocks)

    return run


# ---------------------------------------------------------------------------
# Passes over the rows.
# ---------------------------------------------------------------------------
def _left(codes, tests):
    """For every row the bits of the leaves that no code rules out; ``tests``
    has (group, table of leaf bits by code)."""
    left = None
    for g, table in tests:
        bits = table.take(codes[g], mode="clip")
        left = bits if left is None else np.bitwise_and(left, bits, out=left)
    return left


def _lowest(left):
    """The place of the lowest bit set (some place if none is)."""
    low = left & (~left + left.dtype.type(1))
    return ((low.astype(np.float32).view(np.int32) >> 23) - 127).astype(np.intp)  # the exponent of a power of two


def _counter(layout: Layout, tests, nodes, wanted: int):
    """A pass: of the rows whose leaf is one of ``wanted`` nodes (``nodes``: its
    number for each leaf, or -1; all rows without ``tests``) the number and the
    residuals' sum by node and bin, the sum of their squares by node, the sums
    of squares that the blocks carry, and number and sum over all nodes."""
    types, radices, sizes = layout.types, layout.radices, layout.codes

    def run(chunks):
        counts = [np.zeros(wanted * n, np.int64) for n in sizes]
        sums = [np.zeros(wanted * n) for n in sizes]
        squares, carried, rows, whole = np.zeros(wanted), None, 0, 0.0
        known = None  # the node for each pattern of bits, if there are few
        if tests and tests[0][1].itemsize <= 2:
            known = nodes.take(_lowest(np.arange(np.iinfo(tests[0][1].dtype).max + 1, dtype=tests[0][1].dtype)), mode="clip")
        for packed, residuals, before in chunks:
            r = np.frombuffer(residuals)
            if before:
                before = np.frombuffer(before)
                carried = before if carried is None else carried + before
            codes = _parted(packed, len(r), types)
            if tests:
                left = _left(codes, tests)
                node = nodes.take(_lowest(left), mode="clip") if known is None else known.take(left, mode="clip")
                kept = np.flatnonzero(node >= 0)
                node, r = node.take(kept, mode="clip").astype(np.intp), r.take(kept, mode="clip")
                squares += np.bincount(node, r * r, wanted)
                codes = [node * n + c.take(kept, mode="clip") for n, c in zip(sizes, codes)]
            else:
                codes = [c.astype(np.intp) for c in codes]
                squares[0] += np.dot(r, r)
            rows, whole = rows + len(r), whole + r.sum()
            for g, code in enumerate(codes):
                counts[g] += np.bincount(code, minlength=len(counts[g]))
                sums[g] += np.bincount(code, r, len(sums[g]))
        by_feature = []
        for cells in (counts, sums):
            parts = [np.empty((wanted, 0), cells[0].dtype if cells else float)]
            for a, shape in zip(cells, radices):
                a = a.reshape(wanted, *shape)
                parts += [a.sum(axis=tuple(j + 1 for j in range(len(shape)) if j != i)) for i in range(len(shape))]
            by_feature.append(np.concatenate(parts, axis=1))
        yield by_feature[0], by_feature[1], squares, carried, rows, whole

    return run


def _mover(types, tests, leaves: int, values, factor: float):
    """A pass: residuals times ``factor`` less the value of the row's leaf;
    blocks carry the sum of squares before that by leaf."""

    def run(chunks):
        for packed, residuals, _ in chunks:
            r = np.frombuffer(residuals)
            leaf = _lowest(_left(_parted(packed, len(r), types), tests)) if tests else np.zeros(len(r), np.intp)
            moved = factor * r - values[leaf]
            yield packed, moved.tobytes(), np.bincount(leaf, r * r, leaves).tobytes()

    return run


def _plus(a, b):
    carried = b[3] if a[3] is None else a[3] if b[3] is None else a[3] + b[3]
    return a[0] + b[0], a[1] + b[1], a[2] + b[2], carried, a[4] + b[4], a[5] + b[5]


class Held:
    """The blocks of a small table, in this process."""

    def __init__(self, chunks: list):
        self.chunks = chunks

    def total(self, counter):
        return next(iter(counter(self.chunks)))

    def moved(self, mover, _) -> Held:
        return Held(list(mover(self.chunks)))

    def freed(self) -> None:
        pass


class Cached:
    """The blocks of a table, cached where they were made.  Lineage is cut by a
    checkpoint every ``EVERY`` rounds, and the one before is deleted."""

    def __init__(self, rdd, checkpoints=()):
        self.rdd, self.checkpoints, self.old = rdd.persist(StorageLevel.MEMORY_AND_DISK_DESER), list(checkpoints), None

    def total(self, counter):
        parts = self.rdd.mapPartitions(counter)
        if parts.getNumPartitions() > DIRECT:
            out = parts.treeReduce(_plus)
        else:
            first, *others = parts.collect()
            out = first
            for other in others:
                out = _plus(out, other)
        if self.old:  # this state is cached now
            self.old.rdd.unpersist()
            self.old = None
        while len(self.checkpoints) > 1 and self.checkpoints[-1].isCheckpointed():
            _delete(self.checkpoints.pop(0))
        return out

    def moved(self, mover, done: int) -> Cached:
        new = Cached(self.rdd.mapPartitions(mover), self.checkpoints)
        if done % EVERY == 0:
            new.rdd.checkpoint()
            new.checkpoints.append(new.rdd)
        new.old = self
        return new

    def freed(self) -> None:
        for state in (self, self.old):
            if state:
                state.rdd.unpersist()
        for rdd in self.checkpoints:
            _delete(rdd)


def _delete(rdd) -> None:
    if rdd.isCheckpointed():
        path = rdd.ctx._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile())
        path.getFileSystem(rdd.ctx._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame, features: list[str], maps: list, label: str, max_bins: int, seed: int) -> tuple[Layout, Held | Cached]:
    """The rows of ``df`` in bins, and how they are binned.  ``maps``: for each
    feature its categories' places by value, {} for a numeric one."""
    spark = df.sparkSession
    rows = df.count()
    if not rows:
        raise ValueError("there are no rows to train on")
    bins = min(max_bins, rows)
    most = max(map(len, maps))
    if most > bins:
        raise ValueError(f"a categorical feature has {most} values, more than {bins}, the least of maxBins and the rows")
    widest = max(len(m) if len(m) > 1 else bins for m in maps)
    needed = max(widest * widest, 10000)
    fraction = needed / rows if needed < rows else 1.0
    numeric = [f for f, m in enumerate(maps) if not m]
    thresholds = [np.empty(0)] * len(maps)
    if numeric:
        for f, values in zip(numeric, _sampled(df.select([features[f] for f in numeric]), fraction, seed)):
            thresholds[f] = candidate_thresholds(values, fraction, rows, bins - 1)
    layout = Layout(maps, thresholds)
    blocks = df.select(*features, label).mapInArrow(_packer(layout), "codes binary, labels binary")
    if rows <= HELD:
        return layout, Held(list(_joined(layout.types)(blocks.collect())))
    parts = min(spark.sparkContext.defaultParallelism, -(-rows // BLOCK))
    state = Cached(blocks.repartition(parts).rdd.mapPartitions(_joined(layout.types)))
    state.rdd.count()
    return layout, state


# ---------------------------------------------------------------------------
# Trees.
# ---------------------------------------------------------------------------
class Node:
    """A node of a tree: rows, sum and sum of squares of its residuals, and the
    split (feature, bins that go left) with its gain, if it has one."""

    def __init__(self, n, s, q=None):
        self.n, self.s, self.q = int(n), float(s), q
        self.split = self.children = None
        self.gain, self.failed = -1.0, False

    @property
    def value(self) -> float:
        return self.s / self.n

    @property
    def impurity(self) -> float:
        return (self.q - self.s * self.s / self.n) / self.n

    def leaves(self) -> list[Node]:
        return [self] if self.children is None else [x for c in self.children for x in c.leaves()]


def best_splits(layout: Layout, counts, sums, min_leaf: int):
    """For each node (a row of the sums by bin) the best split: gain in
    variance, feature, bins on the left, rows and sum on the left.  The first
    of equal gains is taken, in the order of features and thresholds; without
    a split that leaves ``min_leaf`` rows on both sides the gain is -inf."""
    nodes = len(counts)
    best = [(-np.inf, None, None, 0, 0.0)] * nodes
    at = 0
    where = {}
    for members in layout.groups:
        for f in members:
            where[f] = slice(at, at := at + layout.sizes[f])
    for f in sorted(where):
        n, s = counts[:, where[f]].astype(float), sums[:, where[f]]
        order = None
        if layout.categories[f] > 1:  # categories by their mean, those without rows last
            mean = np.divide(s, n, out=np.full(s.shape, np.finfo(float).max), where=n > 0)
            order = np.argsort(mean, axis=1, kind="stable")
            n, s = np.take_along_axis(n, order, 1), np.take_along_axis(s, order, 1)
        ln, ls = np.cumsum(n, axis=1), np.cumsum(s, axis=1)
        total, whole = ln[:, -1:], ls[:, -1:]
        ln, ls = ln[:, :-1], ls[:, :-1]
        rn, rs = total - ln, whole - ls
        ok = (ln >= min_leaf) & (rn >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, (ls * ls / ln + rs * rs / rn - whole * whole / total) / total, -np.inf)
        pick = gain.argmax(axis=1)
        for i, j in enumerate(pick):
            if gain[i, j] > best[i][0]:
                left = np.zeros(layout.sizes[f], bool)
                left[np.arange(j + 1) if order is None else order[i, :j + 1]] = True
                best[i] = float(gain[i, j]), f, left, int(ln[i, j]), float(ls[i, j])
    return best


def leaf_tests(layout: Layout, root: Node):
    """The look-up tables that take a row to the leaf of a tree."""
    leaves = {id(x): i for i, x in enumerate(root.leaves())}
    kind = next(np.dtype(f"u{b}") for b in (1, 2, 4, 8) if len(leaves) <= 8 * b)
    tables: dict[int, np.ndarray] = {}

    def visit(node):
        if node.children is None:
            return 1 << leaves[id(node)]
        left, right = (visit(c) for c in node.children)
        f, goes_left = node.split
        g = layout.place[f]
        table = tables.setdefault(g, np.full(layout.codes[g], np.iinfo(kind).max, kind))
        table[~goes_left[layout.digit[f]]] &= kind.type(np.iinfo(kind).max ^ left)
        return left | right

    visit(root)
    return sorted(tables.items())


def grown(layout: Layout, rows: Held | Cached, max_depth: int, min_leaf: int):
    """One tree by levels: its root, and the sums of squares that the blocks carried."""
    counts, sums, squares, carried, n, whole = rows.total(_counter(layout, (), None, 1))
    root = Node(n, whole, float(squares[0]))
    open_nodes = [root] if layout.groups else []
    for depth in range(max_depth):
        # A pure node stays a leaf, but for the root.
        alive = [i for i, x in enumerate(open_nodes) if depth == 0 or abs(x.impurity) >= EPSILON]
        open_nodes, counts, sums = [open_nodes[i] for i in alive], counts[alive], sums[alive]
        parents = []
        for i, (x, (gain, f, left, ln, ls)) in enumerate(zip(open_nodes, best_splits(layout, counts, sums, min_leaf))):
            x.failed = gain < 0
            if gain > 0:
                x.gain, x.split = gain, (f, left)
                x.children = Node(ln, ls), Node(x.n - ln, x.s - ls)
                parents.append((i, x))
        if not parents or depth + 1 == max_depth:
            break
        smaller = [x.children[0] if x.children[0].n <= x.children[1].n else x.children[1] for _, x in parents]
        number = {id(x): i for i, x in enumerate(smaller)}
        nodes = np.array([number.get(id(x), -1) for x in root.leaves()], np.int8)
        few, part, squares, *_ = rows.total(_counter(layout, leaf_tests(layout, root), nodes, len(smaller)))
        open_nodes, next_counts, next_sums = [], [], []
        for j, (i, x) in enumerate(parents):
            rest = counts[i] - few[j]
            other = np.where(rest == 0, 0.0, sums[i] - part[j])
            for child in x.children:
                small = child is smaller[j]
                child.q = float(squares[j]) if small else x.q - float(squares[j])
                open_nodes.append(child)
                next_counts.append(few[j] if small else rest)
                next_sums.append(part[j] if small else other)
        counts, sums = np.array(next_counts), np.array(next_sums)
    return root, carried


def _set_squares(root: Node, carried) -> None:
    for x, q in zip(root.leaves(), carried):
        x.q = float(q)


def boosted(layout: Layout, rows: Held | Cached, rounds: int, max_depth: int, min_leaf: int, step: float) -> list[Node]:
    """The trees.  The first is fitted to the labels and counts whole, the
    others to minus the gradient, twice the residual, and count ``step``."""
    trees: list[Node] = []
    try:
        for done in range(rounds):
            root, carried = grown(layout, rows, max_depth, min_leaf)
            if trees:
                _set_squares(trees[-1], carried)
            trees.append(root)
            leaves = root.leaves()
            weight = step if done else 1.0
            values = np.array([2.0 * weight * x.value for x in leaves])
            tests = leaf_tests(layout, root) if root.children else ()
            rows = rows.moved(_mover(layout.types, tests, len(leaves), values, 1.0 if done else 2.0), done + 1)
        _set_squares(trees[-1], rows.total(_counter(layout, (), None, 1))[3])
    finally:
        rows.freed()
    return trees


# ---------------------------------------------------------------------------
# The model.
# ---------------------------------------------------------------------------
def _listed(layout: Layout, tree: int, root: Node) -> list[tuple]:
    """Rows of Spark's saved form of a tree, numbered root, left, right."""
    out: list = []

    def pruned(node):  # two leaves with one prediction are one leaf
        if node.children is None:
            return True
        leaves = [pruned(c) for c in node.children]
        if all(leaves) and node.children[0].value == node.children[1].value:
            node.children = node.split = None
            node.gain = -1.0
        return node.children is None

    def visit(node):
        at = len(out)
        out.append(None)
        stats = [float(node.n), node.s, node.q], node.n
        if node.children is None:  # Spark notes no impurity where it found no split
            out[at] = (tree, (at, node.value, -1.0 if node.failed else node.impurity, *stats, -1.0, -1, -1, (-1, [], -1)))
            return at
        f, left = node.split
        if layout.categories[f] > 1:
            split = f, [float(i) for i in np.flatnonzero(left)], layout.sizes[f]
        else:
            split = f, [float(layout.thresholds[f][int(left.sum()) - 1])], -1
        l, r = (visit(c) for c in node.children)
        out[at] = (tree, (at, node.value, node.impurity, *stats, node.gain, l, r, split))
        return at

    pruned(root)
    visit(root)
    return out


NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
         "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def as_model(spark, estimator: GBTRegressor, layout: Layout, trees: list[Node]) -> GBTRegressionModel:
    """The trees as Spark's model, through the form in which it is saved."""
    path = scratch_path(spark, "boosted_trees")
    given = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items()}

    def described(name, uid, keep, **more):
        part = {k: {p: v for p, v in params.items() if p in keep} for k, params in (("paramMap", given), ("defaultParamMap", default))}
        return json.dumps({"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, **part, **more})

    whole = described("GBTRegressionModel", estimator.uid, {*given, *default}, numFeatures=len(layout.sizes), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    about = [(i, described("DecisionTreeRegressionModel", f"dtr_{estimator.uid[-12:]}_{i}", TREE_PARAMS), 1.0 if i == 0 else estimator.getStepSize())
             for i in range(len(trees))]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for i, root in enumerate(trees) for row in _listed(layout, i, root)]
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)


def fit_packed(estimator: GBTRegressor, spark, layout: Layout, rows: Held | Cached) -> GBTRegressionModel:
    """``estimator`` fitted to packed rows."""
    checkpoint_dir(spark)
    trees = boosted(layout, rows, estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getStepSize())
    return as_model(spark, estimator, layout, trees)
