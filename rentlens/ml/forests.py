"""Tree ensembles grown over binned rows, for MLlib's estimators of regression and two classes.

A row is a byte per source column, not a vector slot of four bytes, a bag count and a node id per tree: a categorical column
is one byte for all its one-hot slots, the bag of a row is drawn anew from (seed, tree, block) and its node is found by
walking the tree. A pass grows one level of many trees: tasks count their rows per node, column and bin with numpy, counts of
a tree meet in one reducer, only its splits come to the driver. Candidates for splits, gain, bags, subsets of slots, limits
and weights are those of MLlib's trees; the draws are others. The result is MLlib's own model class, read back from its
own files.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoderModel, StandardScalerModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete_folder, new_folder, remove_folder

MODELS = {
    RandomForestRegressor: RandomForestRegressionModel,
    GBTRegressor: GBTRegressionModel,
    RandomForestClassifier: RandomForestClassificationModel,
}
# Rows of a block, cells per node of a table over several columns, cells of such a table, bytes of counts a task sends in
# a pass, levels that are walked node by node, and trees after which boosted residuals are checkpointed.
BLOCK = 1 << 17
JOINT = 1 << 10
CELLS = 1 << 16
SENT = 64 << 20
WALKED = 5
CHECKPOINTED = 10
# Gains below this share of the node's own sum of squares are rounding.
NOISE = 1e-13


@dataclass(frozen=True)
class Binned:
    """A source column: its slots in the vector, and upper ends of its bins, or none where a bin is a category."""

    name: str
    slots: tuple[int, ...]
    cuts: tuple[float, ...] | None

    @property
    def size(self) -> int:
        return len(self.slots) if self.cuts is None else len(self.cuts) + 1


@cache
def _times(rate: float) -> np.ndarray:
    """How often a row with a draw of 16 bits is in a bag with repeats: Poisson's law."""
    share = term = np.exp(-rate)
    ends, k = [], 0
    while share < 1 - 2.0**-17 and k < 255:
        ends.append(share)
        k += 1
        term *= rate / k
        share += term
    return np.searchsorted(np.array(ends), (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)


@dataclass(frozen=True)
class Rule:
    """What decides over splits. ``costs`` are the weights of the two classes, none for a regression."""

    columns: tuple[Binned, ...]
    n_slots: int
    chosen: int
    least: int
    gain: float
    seed: int
    rate: float
    repeats: bool
    costs: tuple[float, float] | None

    def score(self, a, b):
        """Weight times the sum of squared means or shares; what a split adds to it is the impurity it takes away."""
        if self.costs is None:
            return np.divide(b * b, a, out=np.zeros(np.shape(a)), where=a > 0)
        a, b = a * self.costs[0], b * self.costs[1]
        return np.divide(a * a + b * b, a + b, out=np.zeros(np.shape(a)), where=a + b > 0)

    def weight(self, a, b):
        return a if self.costs is None else a * self.costs[0] + b * self.costs[1]

    def says(self, a, b):
        """What a leaf with these sums predicts."""
        if self.costs is not None:
            return (b * self.costs[1] > a * self.costs[0]).astype(np.float64)
        return np.divide(b, a, out=np.zeros(np.shape(a)), where=a > 0)

    def bag(self, tree: int, block: int, n: int) -> np.ndarray | None:
        """How often each row of a block is in the tree's bag, or none if all are once."""
        if not self.repeats and self.rate >= 1:
            return None
        drawn = np.random.default_rng([self.seed, tree, block]).integers(0, 1 << 16, n, np.uint16)
        if not self.repeats:
            return (drawn < round(self.rate * (1 << 16))).view(np.uint8)
        return _times(self.rate)[drawn]

    def subset(self, tree: int, level: int, n_open: int) -> np.ndarray | None:
        """Which slots each open node may split by, or none if all."""
        if self.chosen >= self.n_slots:
            return None
        order = np.random.default_rng([self.seed, tree, 1 << 32, level]).random((n_open, self.n_slots))
        mask = np.zeros((n_open, self.n_slots), bool)
        np.put_along_axis(mask, np.argpartition(order, self.chosen - 1, axis=1)[:, : self.chosen], True, axis=1)
        return mask


@dataclass
class Tree:
    """Splits by level and place; the children of place p are 2p and 2p + 1 of the next level, a row in a leaf goes on at 2p.

    ``walk`` has per level the column (-1: no split), the first bin that goes right and how many follow it. ``nodes`` has
    per level what the model says of a node, the two sums first.
    """

    walk: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    nodes: list[dict[str, np.ndarray]] = field(default_factory=list)
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    squares: np.ndarray | None = None

    @property
    def n_open(self) -> int:
        return int(self.open.max()) + 1

    def split(self, found: dict[str, np.ndarray], rule: Rule, depth: int) -> None:
        """Take the splits of the open nodes and open their children."""
        places, level = np.flatnonzero(self.open >= 0), len(self.walk)
        width = len(self.open)
        if not self.nodes:
            self.nodes.append({"a": found["a"].copy(), "b": found["b"].copy(), "here": np.ones(1, bool)})
        kind = np.uint16 if any(c.size > 255 for c in rule.columns) else np.uint8
        column, low, span = np.full(width, -1, np.int16), np.full(width, np.iinfo(kind).max, kind), np.zeros(width, kind)
        yes = found["slot"] >= 0
        at = places[yes]
        column[at], low[at], span[at] = found["column"][yes], found["low"][yes], found["span"][yes]
        self.walk.append((column, low, span))
        here = self.nodes[level]
        for name, empty in (("slot", -1), ("cut", 0), ("gain", -1.0)):
            here[name] = np.full(width, empty, found[name].dtype)
            here[name][at] = found[name][yes]
        below = {name: np.zeros(2 * width) for name in ("a", "b")} | {"here": np.zeros(2 * width, bool)}
        for name in ("a", "b"):
            below[name][2 * at], below[name][2 * at + 1] = found["l" + name][yes], found["r" + name][yes]
        below["here"][2 * at] = below["here"][2 * at + 1] = True
        self.nodes.append(below)
        n = below["a"] if rule.costs is None else below["a"] + below["b"]
        mixed = below["here"] & (n >= 2 * rule.least)
        if rule.costs is not None:
            mixed &= (below["a"] > 0) & (below["b"] > 0)
        if level + 1 >= depth:
            mixed[:] = False
        self.open = np.where(mixed, np.cumsum(mixed) - 1, -1).astype(np.int32)

    def prune(self, rule: Rule) -> None:
        """Two leaves that say the same become one, as MLlib's do."""
        for nodes, below in reversed(list(zip(self.nodes, self.nodes[1:], strict=False))):
            leaf = below["slot"] < 0 if "slot" in below else np.ones(len(below["here"]), bool)
            says = rule.says(below["a"], below["b"])
            at = np.flatnonzero((nodes["slot"] >= 0) & leaf[::2] & leaf[1::2] & (says[::2] == says[1::2]))
            nodes["slot"][at] = -1
            below["here"][2 * at] = below["here"][2 * at + 1] = False


def covers(estimator: Estimator) -> bool:
    """Whether ``fit`` does all that the estimator asks for; else its own ``fit`` is to be used."""
    if type(estimator) not in MODELS:
        return False
    set_ = lambda name: estimator.hasParam(name) and estimator.isDefined(name) and estimator.getOrDefault(name)
    plain = not set_("validationIndicatorCol") and not set_("thresholds") and not set_("leafCol")
    plain &= estimator.getOrDefault("minWeightFractionPerNode") == 0 and 1 <= estimator.getMaxDepth() <= 14 and estimator.getMaxBins() <= 256
    plain &= estimator.getImpurity() in ("variance", "gini") and _chosen(estimator, 10, 2) is not None
    if isinstance(estimator, GBTRegressor):
        return plain and estimator.getLossType() == "squared" and not set_("weightCol")
    return plain and (isinstance(estimator, RandomForestClassifier) or not set_("weightCol"))


def _chosen(estimator: Estimator, n_slots: int, n_trees: int) -> int | None:
    """Slots a node may choose from."""
    named = estimator.getFeatureSubsetStrategy()
    if named == "auto":
        boosted = isinstance(estimator, GBTRegressor) or n_trees == 1
        named = "all" if boosted else "sqrt" if isinstance(estimator, RandomForestClassifier) else "onethird"
    known = {"all": n_slots, "sqrt": np.ceil(np.sqrt(n_slots)), "onethird": np.ceil(n_slots / 3), "log2": max(1, np.ceil(np.log2(n_slots)))}
    return int(known[named]) if named in known else None


def _cuts(rows: DataFrame, numbers: Sequence[str], bins: int) -> dict[str, tuple[float, ...]]:
    """Candidates for splits: half-way between all values where they are few, else quantiles of all rows."""
    if not numbers:
        return {}
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    points = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.agg(
        *[F.approx_count_distinct(known[c]).alias(f"n_{i}") for i, c in enumerate(numbers)],
        *[F.percentile_approx(known[c], points, F.lit(10_000)).alias(f"q_{i}") for i, c in enumerate(numbers)],
        *[F.max(known[c]).alias(f"m_{i}") for i, c in enumerate(numbers)],
    ).first()
    few = [c for i, c in enumerate(numbers) if found[f"n_{i}"] <= bins + bins // 4]
    values = rows.agg(*[F.collect_set(known[c]).alias(str(i)) for i, c in enumerate(few)]).first() if few else ()
    cuts = {c: tuple(q for q in sorted(set(found[f"q_{i}"] or ())) if q < found[f"m_{i}"]) for i, c in enumerate(numbers)}
    for c, all_values in zip(few, values, strict=True):
        if len(all_values) <= bins:
            ends = sorted(all_values)
            cuts[c] = tuple((x + y) / 2 for x, y in zip(ends, ends[1:], strict=False))
    return cuts


def _columns(rows: DataFrame, stages: Sequence[Transformer], numbers: Sequence[str], categories: Sequence[str], bins: int) -> tuple[Binned, ...]:
    cuts = _cuts(rows, numbers, bins)
    columns = [Binned(c, (i,), cuts[c]) for i, c in enumerate(numbers)]
    at = len(numbers)
    sizes = next((s.categorySizes for s in stages if isinstance(s, OneHotEncoderModel)), [])
    for c, size in zip(categories, sizes, strict=True):
        columns.append(Binned(f"{c}_idx", tuple(range(at, at + size)), None))
        at += size
    return tuple(columns)


def _packed(columns: tuple[Binned, ...]):
    """Rows as blocks of bins, column by column, with their labels."""
    kind = np.uint16 if any(c.size > 255 for c in columns) else np.uint8

    def block(x, y, part: int, number: int) -> pa.RecordBatch:
        cells = [[(part << 20) + number], [np.ascontiguousarray(x).tobytes()], [y.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cells, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["id", "x", "y"])

    def run(batches):
        part, number, xs, ys = TaskContext.get().partitionId(), 0, [], []
        for batch in batches:
            x = np.empty((len(columns), batch.num_rows), kind)
            for i, c in enumerate(columns):
                values = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                x[i] = values if c.cuts is None else np.searchsorted(np.array(c.cuts), values, side="left")
            xs.append(x)
            ys.append(batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(np.float64))
            if sum(map(len, ys)) >= BLOCK:
                x, y = np.concatenate(xs, axis=1), np.concatenate(ys)
                while len(y) >= BLOCK:
                    yield block(x[:, :BLOCK], y[:BLOCK], part, number)
                    x, y, number = x[:, BLOCK:], y[BLOCK:], number + 1
                xs, ys = [x], [y]
        if ys and sum(map(len, ys)):
            yield block(np.concatenate(xs, axis=1), np.concatenate(ys), part, number)

    def opened(row):
        y = np.frombuffer(row.y, np.float64)
        return row.id, np.frombuffer(row.x, kind).reshape(len(columns), len(y)), y

    return run, opened


def placed(x: np.ndarray, walk) -> np.ndarray:
    """The place of every row in the level below the walk."""
    n = x.shape[1]
    at, flat, rows = np.zeros(n, np.uint8), None, None
    for level, (column, low, span) in enumerate(walk):
        if level < WALKED:
            right = np.zeros(n, bool)
            for p in np.flatnonzero(column >= 0):
                goes = (x[column[p]] - low[p]) <= span[p]
                if level:
                    goes &= at == p
                right |= goes
            at = (at << 1) | right.view(np.uint8)
        else:
            if flat is None:
                flat, rows, at = np.ascontiguousarray(x).reshape(-1), np.arange(n), at.astype(np.intp)
            cells = flat[(np.maximum(column, 0).astype(np.intp) * n)[at] + rows]
            at = 2 * at + ((cells - low[at]) <= span[at])
    return at


def _groups(columns: tuple[Binned, ...], n_open: int) -> list[list[int]]:
    """Columns that are counted together, as one count of all their bins is cheaper than a count of each."""
    limit, groups, size = max(1, min(JOINT, CELLS // max(1, n_open))), [], 0
    for i, c in sorted(enumerate(columns), key=lambda ic: ic[1].size):
        if groups and size * c.size <= limit:
            groups[-1].append(i)
            size *= c.size
        else:
            groups.append([i])
            size = c.size
    return groups


def tallied(blocks, tree: int, walk, open_: np.ndarray, n_open: int, rule: Rule) -> list[np.ndarray]:
    """Per column an array of open node, sum and bin: the counts of the two classes, or count and sum of the labels."""
    columns = rule.columns
    groups = _groups(columns, n_open)
    sizes = [int(np.prod([columns[i].size for i in g])) for g in groups]
    tables = [np.zeros((n_open * 2 if rule.costs else n_open) * size) for size in sizes]
    sums = None if rule.costs else [np.zeros(n_open * size) for size in sizes]
    for id_, x, y in blocks:
        at = placed(x, walk)
        node = open_.astype(np.intp)[at]
        bag, keep = rule.bag(tree, id_, len(y)), node >= 0
        if bag is not None:
            keep &= bag > 0
        rows = np.flatnonzero(keep)
        node, y = node[rows], y[rows]
        times = None if bag is None or not rule.repeats else bag[rows].astype(np.float64)
        if rule.costs:
            node = 2 * node + (y > 0)
        else:
            y = y if times is None else y * times
        for g, (group, size) in enumerate(zip(groups, sizes, strict=True)):
            code = x[group[0]]
            for i in group[1:]:
                code = code.astype(np.uint16) * np.uint16(columns[i].size) + x[i]
            cells = node * size + code[rows]
            tables[g] += np.bincount(cells, times, len(tables[g]))
            if sums is not None:
                sums[g] += np.bincount(cells, y, len(sums[g]))
    found = [None] * len(columns)
    for g, group in enumerate(groups):
        shape = [columns[i].size for i in group]
        if rule.costs:
            joint = tables[g].reshape(n_open, 2, *shape)
        else:
            joint = np.stack([tables[g].reshape(n_open, *shape), sums[g].reshape(n_open, *shape)], axis=1)
        for k, i in enumerate(group):
            found[i] = joint.sum(axis=tuple(2 + j for j in range(len(group)) if j != k))
    return found


def _kept(rule: Rule, mask: np.ndarray | None) -> list[np.ndarray | slice]:
    """Open nodes that may split by a column."""
    return [slice(None) if mask is None else np.flatnonzero(mask[:, c.slots].any(axis=1)) for c in rule.columns]


def sent(counts: Sequence[np.ndarray], tree: int, level: int, n_open: int, rule: Rule) -> list[np.ndarray]:
    """What of the counts is needed, whole numbers in as few bytes as hold them."""
    out = []
    for count, nodes in zip(counts, _kept(rule, rule.subset(tree, level, n_open)), strict=True):
        part = count[nodes]
        if rule.costs:
            part = part.astype(np.min_scalar_type(int(part.max(initial=0))))
        out.append(part)
    return out


def best(counts: Sequence[np.ndarray], tree: int, level: int, n_open: int, rule: Rule) -> dict[str, np.ndarray]:
    """The split of most gain for every open node, the lowest slot and bin of equals; slot -1 where there is none."""
    mask = rule.subset(tree, level, n_open)
    names = ("a", "b", "la", "lb", "ra", "rb")
    out = {n: np.zeros(n_open) for n in names} | {n: np.zeros(n_open, np.int32) for n in ("column", "low", "span", "cut")}
    out |= {"slot": np.full(n_open, -1, np.int32), "gain": np.zeros(n_open)}
    for i, (c, nodes) in enumerate(zip(rule.columns, _kept(rule, mask), strict=True)):
        h = counts[i].astype(np.float64)
        nodes = np.arange(n_open)[nodes]
        if not len(nodes):
            continue
        total = h.sum(axis=2)
        out["a"][nodes], out["b"][nodes] = total[:, 0], total[:, 1]
        if c.cuts is None:
            right = h
            left = total[:, :, None] - right
            allowed = np.ones((len(nodes), c.size), bool) if mask is None else mask[np.ix_(nodes, c.slots)]
        else:
            if c.size == 1:
                continue
            left = h.cumsum(axis=2)[:, :, :-1]
            right = total[:, :, None] - left
            allowed = np.ones(left.shape[::2], bool)
        for side in (left, right):
            allowed &= (side[:, 0] if rule.costs is None else side[:, 0] + side[:, 1]) >= rule.least
        whole = rule.score(total[:, 0], total[:, 1])[:, None]
        weight = rule.weight(total[:, 0], total[:, 1])[:, None]
        more = rule.score(left[:, 0], left[:, 1]) + rule.score(right[:, 0], right[:, 1]) - whole
        gain = np.where(allowed & (more > NOISE * whole), np.divide(more, weight, out=np.zeros_like(more), where=weight > 0), -1.0)
        pick = gain.argmax(axis=1)
        at = np.arange(len(nodes))
        won = gain[at, pick]
        better = (won > np.maximum(out["gain"][nodes], 0.0)) & (won >= rule.gain)
        at, pick, to = at[better], pick[better], nodes[better]
        out["gain"][to], out["column"][to] = won[better], i
        if c.cuts is None:
            out["slot"][to], out["low"][to], out["span"][to], out["cut"][to] = np.array(c.slots)[pick], pick, 0, 0
        else:
            out["slot"][to], out["low"][to], out["span"][to], out["cut"][to] = c.slots[0], pick + 1, c.size - 2 - pick, pick
        for k, name in enumerate("ab"):
            out["l" + name][to], out["r" + name][to] = left[at, k, pick], right[at, k, pick]
    return out


def _grow(blocks: RDD, rule: Rule, n_trees: int, depth: int) -> list[Tree]:
    """All trees of a forest, level by level."""
    sc, trees, width = blocks.context, [Tree() for _ in range(n_trees)], blocks.getNumPartitions()
    cells = sum(c.size for c in rule.columns) * min(1.0, rule.chosen / len(rule.columns))
    for level in range(depth):
        waiting = [t for t, tree in enumerate(trees) if (tree.open >= 0).any()]
        while waiting:
            group, bytes_ = [], 0.0
            while waiting and (not group or bytes_ + 16 * cells * trees[waiting[0]].n_open <= SENT):
                bytes_ += 16 * cells * trees[waiting[0]].n_open
                group.append(waiting.pop(0))
            state = sc.broadcast({t: (trees[t].walk, trees[t].open, trees[t].n_open) for t in group})

            def count(rows, state=state, level=level):
                held = list(rows)
                for t, (walk, open_, n_open) in state.value.items():
                    yield t, sent(tallied(held, t, walk, open_, n_open, rule), t, level, n_open, rule)

            def settle(pieces, state=state, level=level):
                merged = {}
                for t, counts in pieces:
                    wide = [c.astype(np.float64) for c in counts]
                    merged[t] = wide if t not in merged else [x + y for x, y in zip(merged[t], wide, strict=True)]
                for t, counts in merged.items():
                    yield t, best(counts, t, level, state.value[t][2], rule)

            for t, found in blocks.mapPartitions(count).partitionBy(min(len(group), width), int).mapPartitions(settle).collect():
                trees[t].split(found, rule, depth)
            state.destroy()
            if bytes_ > SENT // 4:
                # Lets Spark remove the shuffle files of the passes that are over.
                sc._jvm.System.gc()
    return trees


def _leaf_sums(x, y, walk, depth: int, bag: np.ndarray | None) -> np.ndarray:
    """Count, sum and sum of squares of the bag at every place below the deepest split."""
    at = placed(x, walk).astype(np.intp) << (depth - len(walk))
    times = np.ones(len(y)) if bag is None else bag.astype(np.float64)
    return np.stack([np.bincount(at, w, 1 << depth) for w in (times, times * y, times * y * y)])


def _forest(blocks: RDD, rule: Rule, n_trees: int, depth: int) -> list[Tree]:
    trees = _grow(blocks, rule, n_trees, depth)
    if rule.costs is not None:
        return trees
    state = blocks.context.broadcast([t.walk for t in trees])

    def sums(rows):
        held = list(rows)
        for t, walk in enumerate(state.value):
            yield t, sum(_leaf_sums(x, y, walk, depth, rule.bag(t, id_, len(y))) for id_, x, y in held) + np.zeros((3, 1 << depth))

    for t, found in blocks.mapPartitions(sums).reduceByKey(np.add, min(n_trees, blocks.getNumPartitions())).collect():
        trees[t].squares = found
    state.destroy()
    return trees


def _boosted(blocks: RDD, rule: Rule, n_trees: int, depth: int, step: float) -> list[Tree]:
    """Trees over the residuals of those before them. A block carries its residuals and the leaf sums of the last tree; the
    first pass of a tree makes them, so a tree takes as many passes as it has levels."""
    trees, state, before, old_files = [], blocks.map(lambda b: (*b, None)).persist(StorageLevel.MEMORY_AND_DISK), None, []
    for t in range(n_trees + 1):
        tree = Tree()
        for level in range(depth if t < n_trees else 1):
            if not (tree.open >= 0).any():
                break
            walk, open_, n_open = tree.walk, tree.open, tree.n_open

            def count(rows, t=t, walk=walk, open_=open_, n_open=n_open, level=level):
                held = [(b[:3], b[3]) for b in rows]
                counts = tallied([b for b, _ in held], t, walk, open_, n_open, rule) if t < n_trees else None
                last = [s for _, s in held if s is not None]
                yield counts, sum(last) if last and level == 0 else None

            pieces = state.mapPartitions(count).collect()
            if level == 0 and t:
                trees[-1].squares = sum(s for _, s in pieces if s is not None)
                before.unpersist()
                if state.isCheckpointed():
                    for path in old_files:
                        delete_folder(state.context, path)
                    old_files = [state.getCheckpointFile()]
            if t < n_trees:
                tree.split(best([sum(c) for c in zip(*[c for c, _ in pieces], strict=True)], t, level, n_open, rule), rule, depth)
        if t == n_trees:
            break
        trees.append(tree)
        # MLlib's residual is the gradient, twice the difference, for all trees but the first.
        share, means = (2.0 * step if t else 1.0), _means(tree, rule, depth)

        def onward(b, t=t, walk=tree.walk, share=share, first=not t, means=means):
            id_, x, y, _ = b
            sums = _leaf_sums(x, y if first else 2.0 * y, walk, depth, rule.bag(t, id_, len(y)))
            return id_, x, y - share * means[placed(x, walk).astype(np.intp) << (depth - len(walk))], sums

        before, state = state, state.map(onward).persist(StorageLevel.MEMORY_AND_DISK)
        if t % CHECKPOINTED == CHECKPOINTED - 1:
            state.checkpoint()
    state.unpersist()
    for path in old_files:
        delete_folder(blocks.context, path)
    return trees


def _means(tree: Tree, rule: Rule, depth: int) -> np.ndarray:
    """Mean label of the leaf at every place of the deepest level, as the sums of the splits give it."""
    out = np.zeros(1 << depth)
    for level, nodes in enumerate(tree.nodes):
        leaf = nodes["here"] & (nodes["slot"] < 0 if "slot" in nodes else True)
        at = np.flatnonzero(leaf)
        out[at << (depth - level)] = rule.says(nodes["a"][at], nodes["b"][at])
    return out


def _table(tree: Tree, number: int, rule: Rule, scale: np.ndarray, depth: int, times: float) -> dict[str, np.ndarray]:
    """The tree as rows of MLlib's node table, children after their parents."""
    by_slot = {s: c for c in rule.columns for s in c.slots}
    parts, first = [], 0
    for level, nodes in enumerate(tree.nodes):
        at = np.flatnonzero(nodes["here"])
        a, b = nodes["a"][at], nodes["b"][at] * times
        slot = nodes["slot"][at] if "slot" in nodes else np.full(len(at), -1, np.int32)
        inner = slot >= 0
        left = np.where(inner, first + len(at) + 2 * (np.cumsum(inner) - 1), -1)
        cut = nodes["cut"][at] if "cut" in nodes else slot
        ends = [0.0 if s < 0 else (0.5 if by_slot[s].cuts is None else by_slot[s].cuts[k]) * scale[s] for s, k in zip(slot, cut, strict=True)]
        if rule.costs is None:
            groups = tree.squares.reshape(3, 1 << level, -1).sum(axis=2)[:, at]
            squares = groups[2]
            mean = rule.says(a, b)
            stats = (a, b, squares)
            impurity = np.maximum(np.divide(squares, a, out=np.zeros(len(a)), where=a > 0) - mean * mean, 0.0)
            raw, says = a, mean
        else:
            wa, wb = a * rule.costs[0], b * rule.costs[1]
            whole = np.where(wa + wb > 0, wa + wb, 1.0)
            stats, raw, says = (wa, wb, np.zeros(len(a))), a + b, rule.says(a, b)
            impurity = 1.0 - (wa / whole) ** 2 - (wb / whole) ** 2
        gain = np.where(inner, nodes["gain"][at] * times * times if "gain" in nodes else -1.0, -1.0)
        parts.append(
            {
                "treeID": np.full(len(at), number, np.int32), "id": np.arange(first, first + len(at), dtype=np.int32),
                "prediction": says, "impurity": impurity, "s0": stats[0], "s1": stats[1], "s2": stats[2],
                "rawCount": np.rint(raw).astype(np.int64), "gain": gain, "leftChild": left.astype(np.int32),
                "rightChild": np.where(inner, left + 1, -1).astype(np.int32), "featureIndex": slot.astype(np.int32), "end": np.array(ends, np.float64),
            }
        )
        first += len(at)
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _model(spark: SparkSession, estimator: Estimator, trees: Sequence[Tree], rule: Rule, scale: np.ndarray) -> Model:
    """MLlib's model: its own files of a model of one leaf, with these trees in its place."""
    depth, boosted = estimator.getMaxDepth(), isinstance(estimator, GBTRegressor)
    size = "maxIter" if boosted else "numTrees"
    kept = {estimator.getParam(n): v for n, v in ((size, 1), ("maxDepth", 1))}
    weight = estimator.hasParam("weightCol") and estimator.isDefined("weightCol") and estimator.getWeightCol()
    rows = [(Vectors.sparse(rule.n_slots, []), float(i), 1.0) for i in range(2)]
    small = spark.createDataFrame(rows, [estimator.getFeaturesCol(), estimator.getLabelCol(), weight or "_weight"])
    path = new_folder(spark, "trees")
    estimator.copy(kept).fit(small).write().save(f"{path}/leaf")
    about = json.loads(spark.read.text(f"{path}/leaf/metadata").first()["value"])
    about["paramMap"] |= {size: estimator.getOrDefault(size), "maxDepth": depth}
    about["numTrees"] = len(trees)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    leaf = spark.read.parquet(f"{path}/leaf/treesMetadata").first()
    of_tree = json.loads(leaf[1])
    of_tree["paramMap"]["maxDepth"] = depth
    step = estimator.getStepSize() if boosted else 1.0
    named = [(t, json.dumps(of_tree | {"uid": f"{of_tree['uid']}_{t}"}), step if t else 1.0) for t in range(len(trees))]
    spark.createDataFrame(named, spark.read.parquet(f"{path}/leaf/treesMetadata").schema).coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    for tree in trees:
        tree.prune(rule)
    tables = [_table(tree, t, rule, scale, depth, 2.0 if boosted and t else 1.0) for t, tree in enumerate(trees)]
    nodes = spark.createDataFrame(pa.table({n: np.concatenate([t[n] for t in tables]) for n in tables[0]}))
    inner = F.col("featureIndex") >= 0
    split = F.struct(
        "featureIndex",
        F.when(inner, F.array("end")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    stats = F.array(*["s0", "s1", "s2"][: 2 if rule.costs else 3]).alias("impurityStats")
    data = F.struct("id", "prediction", "impurity", stats, "rawCount", "gain", "leftChild", "rightChild", split.alias("split"))
    nodes.select("treeID", data.alias("nodeData")).write.parquet(f"{path}/model/data")
    model = MODELS[type(estimator)].load(f"{path}/model")
    remove_folder(spark, path)
    return model


def _costs(rows: DataFrame, estimator: Estimator) -> tuple[float, float] | None:
    """The weight of each of two classes, or none if there are others or rows of a class differ in weight."""
    label, named = F.col(estimator.getLabelCol()), estimator.isDefined("weightCol") and estimator.getWeightCol()
    weight = F.col(named) if named else F.lit(1.0)
    found = rows.groupBy(label.cast("double").alias("y")).agg(F.min(weight).alias("low"), F.max(weight).alias("high")).collect()
    if {r["y"] for r in found} - {0.0, 1.0} or any(r["low"] != r["high"] or not r["low"] > 0 for r in found) or len(found) < 2:
        return None
    by_class = {r["y"]: r["low"] for r in found}
    return by_class[0.0], by_class[1.0]


def fit(estimator: Estimator, rows: DataFrame, stages: Sequence[Transformer], numbers: Sequence[str], categories: Sequence[str]) -> Model:
    """The estimator's model of rows that went through the feature stages of ``features.feature_stages``."""
    scaler = next(s for s in stages if isinstance(s, StandardScalerModel))
    columns = _columns(rows, stages, numbers, categories, estimator.getMaxBins())
    n_slots, spread = sum(len(c.slots) for c in columns), scaler.std.toArray()
    costs = _costs(rows, estimator) if isinstance(estimator, RandomForestClassifier) else None
    odd = isinstance(estimator, RandomForestClassifier) and costs is None
    if odd or len(spread) != n_slots or any(c.size > 65_000 for c in columns):
        return estimator.fit(rows)
    boosted = isinstance(estimator, GBTRegressor)
    n_trees = estimator.getMaxIter() if boosted else estimator.getNumTrees()
    rule = Rule(
        columns,
        n_slots,
        _chosen(estimator, n_slots, n_trees),
        estimator.getMinInstancesPerNode(),
        estimator.getMinInfoGain(),
        estimator.getSeed() % (1 << 63),
        estimator.getSubsamplingRate(),
        not boosted and estimator.getOrDefault("bootstrap"),
        costs,
    )
    run, opened = _packed(columns)
    packed = rows.select(*[f"`{c.name}`" for c in columns], estimator.getLabelCol()).mapInArrow(run, "id long, x binary, y binary")
    blocks = packed.rdd.map(opened)
    scale = np.divide(1.0, spread, out=np.zeros(n_slots), where=spread != 0)
    if boosted:
        trees = _boosted(blocks, rule, n_trees, estimator.getMaxDepth(), estimator.getStepSize())
    else:
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = _forest(blocks, rule, n_trees, estimator.getMaxDepth())
        finally:
            blocks.unpersist()
    return _model(rows.sparkSession, estimator, trees, rule, scale)
