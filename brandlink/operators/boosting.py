"""Histogram gradient boosting of many models at once.

A search over settings and folds is one set of models over the same binned
rows.  Training is level-wise: one job sums the gradients of every (model, node,
feature, bin) of a level, with partial sums in each block of rows, picks each
node's split where its sums meet, and gives the driver one record for each node.
The driver holds nothing but these records, which are the models.  A training
set of at most ``TASK_ROWS`` rows needs no job for a level: each model then grows
in a task of its own, by the same code.

Gradients are whole numbers of a fixed step, so sums do not depend on the order
or on the partitions, and both ways, and reruns, give the same trees.

Trees follow the usual second-order rules (Chen and Guestrin, "XGBoost: A
Scalable Tree Boosting System", KDD 2016): gain GL^2/(HL+l) + GR^2/(HR+l) -
G^2/(H+l), at least ``min_child_weight`` of hessian on both sides, splits below
``gamma`` cut back from the leaves, leaf value -G/(H+l) times the learning rate.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TASK_ROWS = 200_000   # rows of a training set that one task may hold
BLOCK_ROWS = 20_000   # rows of a block in the level-wise way
LEAST_GAIN = 1e-6
_LOW = (1 << 26) - 1


@dataclass(frozen=True)
class Setting:
    """Parameters of one model."""

    rounds: int = 100
    learning_rate: float = 0.3
    max_depth: int = 6
    min_child_weight: float = 1.0
    gamma: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    reg_lambda: float = 1.0
    positive_scale: float = 1.0
    patience: int | None = None   # rounds without a better held-out loss before the model stops
    seed: int = 42


# ------------------------------------------------------------------- binning

def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 256) -> list[list[float]]:
    """Upper edges of each feature's bins: its quantiles, distinct, without the
    largest (at most ``bins - 1`` numbers for each feature)."""
    share = [i / bins for i in range(1, bins)] + [1.0]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), share, 1_000_000).alias(f"q{i}")
                   for i, f in enumerate(features)]).first()
    return [sorted(set(q or []))[:-1] for q in row]


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers; a missing value (NaN) is below all others."""
    out = np.empty(values.shape, np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16)
    for j, e in enumerate(edges):
        v = np.where(np.isnan(values[:, j]), -np.inf, values[:, j])
        out[:, j] = np.searchsorted(e, v, side="left")
    return out


# ------------------------------------------------------------- sums and splits

def _whole_sums(codes: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of 64-bit whole numbers by code (doubles hold 53 bits)."""
    low = np.bincount(codes, weights=v & _LOW, minlength=size).astype(np.int64)
    return (np.bincount(codes, weights=v >> 26, minlength=size).astype(np.int64) << 26) + low


def sums(node: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int):
    """Sorted codes (node, feature, bin) with sums of g, h and the rows."""
    n, features = x.shape
    codes = ((node[:, None] * features + np.arange(features)) * bins + x).ravel()
    known, back = np.unique(codes, return_inverse=True)
    rep = lambda v: np.repeat(v, features)
    return (known, _whole_sums(back, rep(g), len(known)), _whole_sums(back, rep(h), len(known)),
            np.bincount(back, minlength=len(known)).astype(np.int64))


def merged(parts):
    """Sums of the same codes from several blocks."""
    codes = np.concatenate([p[0] for p in parts])
    known, back = np.unique(codes, return_inverse=True)
    return (known, *[_whole_sums(back, np.concatenate([p[k] for p in parts]), len(known)) for k in (1, 2, 3)])


def best_splits(hist, features: int, bins: int, allowed: np.ndarray, s: Setting, step: float) -> dict:
    """node -> (feature, bin, gain, G, H, rows) of its best split; feature -1
    where none helps.  Ties go to the first feature, then the lowest bin."""
    codes, g, h, n = hist
    if not len(codes):
        return {}
    part = codes // bins                          # (node, feature)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    seg = np.cumsum(np.concatenate([[True], part[1:] != part[:-1]])) - 1
    ends = np.append(first[1:], len(codes)) - 1
    run = lambda v: (c := np.cumsum(v)) - np.concatenate([[0], c])[first][seg]
    gl, hl = run(g), run(h)
    gt, ht, nt = gl[ends][seg], hl[ends][seg], run(n)[ends]
    last = np.zeros(len(codes), bool)
    last[ends] = True
    gl_, hl_, gt_, ht_ = gl * step, hl * step, gt * step, ht * step
    gr_, hr_ = (gt - gl) * step, (ht - hl) * step
    lam = s.reg_lambda
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl_ ** 2 / (hl_ + lam) + gr_ ** 2 / (hr_ + lam) - gt_ ** 2 / (ht_ + lam)
    ok = ~last & (hl_ >= s.min_child_weight) & (hr_ >= s.min_child_weight) & allowed[part % features]
    gain = np.where(ok & (gain > LEAST_GAIN), gain, -np.inf)
    node = part // features
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    order = np.lexsort((np.arange(len(codes)), -gain, node))[starts]
    out = {}
    for at, i in zip(starts, order):
        f = int(part[i] % features) if gain[i] > -np.inf else -1
        out[int(node[at])] = (f, int(codes[i] % bins), float(gain[i]) if f >= 0 else 0.0,
                              float(gt_[at]), float(ht_[at]), int(nt[seg[at]]))
    return out


class Tree:
    """Nodes in heap order: children of i are 2i + 1 and 2i + 2."""

    def __init__(self):
        self.nodes: dict[int, tuple] = {}   # node -> (feature, bin, gain, G, H, rows)

    def place(self, x: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The lowest known node of each row."""
        at = np.zeros(len(x), np.int64) if at is None else at
        known = np.array(sorted(k for k, v in self.nodes.items() if v[0] >= 0), np.int64)
        feature = np.array([self.nodes[k][0] for k in known.tolist()], np.int64)
        bin_ = np.array([self.nodes[k][1] for k in known.tolist()], np.int64)
        go = np.arange(len(x))
        while len(known):
            i = np.searchsorted(known, at[go])
            i[i == len(known)] = 0
            inner = known[i] == at[go]
            go, i = go[inner], i[inner]
            if not len(go):
                break
            at[go] = 2 * at[go] + 1 + (x[go, feature[i]] > bin_[i])
        return at

    def prune(self, gamma: float) -> None:
        """Splits of two leaves that gain less than ``gamma`` go, from below."""
        for k in sorted(self.nodes, reverse=True):
            v = self.nodes[k]
            if v[0] >= 0 and v[2] < gamma and all(self.nodes[c][0] < 0 for c in (2 * k + 1, 2 * k + 2)):
                self.nodes[k] = (-1, *v[1:])
                del self.nodes[2 * k + 1], self.nodes[2 * k + 2]

    def value(self, node: int, s: Setting) -> float:
        _, _, _, g, h, _ = self.nodes[node]
        return -g / (h + s.reg_lambda) * s.learning_rate if h + s.reg_lambda else 0.0

    def add(self, x: np.ndarray, margin: np.ndarray, s: Setting) -> None:
        at = self.place(x)
        leaves, back = np.unique(at, return_inverse=True)
        margin += np.array([self.value(int(k), s) for k in leaves])[back]


def _columns(s: Setting, round_: int, features: int) -> np.ndarray:
    """Features that a tree may use: a seeded draw of the share, one at least."""
    k = max(1, int(s.colsample * features + 1e-9))
    allowed = np.zeros(features, bool)
    allowed[random.Random(f"{s.seed}:{round_}:columns").sample(range(features), k)] = True
    return allowed


def _drawn(s: Setting, round_: int, key: np.ndarray) -> np.ndarray:
    """Rows that a tree is grown on, by a hash of their key."""
    if s.subsample >= 1:
        return np.ones(len(key), bool)
    x = key ^ np.uint64(random.Random(f"{s.seed}:{round_}:rows").getrandbits(64))
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return (x ^ (x >> np.uint64(33))) < np.uint64(int(s.subsample * (2.0 ** 64 - 1)))


def _gradients(y: np.ndarray, margin: np.ndarray, s: Setting, step: float):
    """First and second derivatives of the logistic loss in whole steps."""
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y > 0, s.positive_scale, 1.0)
    g = np.rint((p - y) * w / step).astype(np.int64)
    h = np.rint(np.maximum(p * (1 - p), 1e-16) * w / step).astype(np.int64)
    return g, h


def _loss(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Log loss of each row, probabilities kept off 0 and 1."""
    p = np.clip(1 / (1 + np.exp(-margin)), 2.220446049250313e-16, 1 - 2.220446049250313e-16)
    return -np.where(y > 0, np.log(p), np.log1p(-p))


def _step(rows: int, settings: Sequence[Setting]) -> float:
    """Fixed step of the gradients: sums over all rows stay below 2^61."""
    most = max(rows, 1) * max(max(s.positive_scale, 1.0) for s in settings)
    return 2.0 ** -min(40, 61 - math.ceil(math.log2(most) + 1))


class Stopper:
    """Stops a model after ``patience`` rounds without a better held-out loss."""

    def __init__(self, s: Setting):
        self.patience, self.best, self.best_round, self.losses = s.patience, math.inf, -1, []

    def done(self, loss: float) -> bool:
        self.losses.append(loss)
        if loss < self.best:
            self.best, self.best_round = loss, len(self.losses) - 1
        return self.patience is not None and len(self.losses) - 1 - self.best_round >= self.patience


def train_in_task(x, y, key, held, s: Setting, bins: int, step: float):
    """One model over the rows that are not held out: (trees, held-out losses)."""
    margin, trees, stop = np.zeros(len(y)), [], Stopper(s)
    fit = ~held
    for r in range(s.rounds):
        g, h = _gradients(y, margin, s, step)
        use = np.flatnonzero(fit & _drawn(s, r, key))
        tree, allowed = Tree(), _columns(s, r, x.shape[1])
        at, active = np.zeros(len(use), np.int64), np.arange(len(use))
        for depth in range(s.max_depth + 1):
            if not len(active):
                break
            rows = use[active]
            hist = sums(at[active], x[rows], g[rows], h[rows], bins)
            found = best_splits(hist, x.shape[1], bins, allowed, s, step)
            if depth == s.max_depth:
                found = {k: (-1, *v[1:]) for k, v in found.items()}
            tree.nodes.update(found)
            if depth < s.max_depth:
                now = at[active]
                level = Tree()
                level.nodes = found
                moved = level.place(x[rows], now.copy())
                at[active] = moved
                active = active[moved != now]
        if not tree.nodes:  # no row was drawn
            tree.nodes = {0: (-1, 0, 0.0, 0.0, 0.0, 0)}
        tree.prune(s.gamma)
        tree.add(x, margin, s)
        trees.append(tree)
        if held.any() and stop.done(float(_loss(y[held], margin[held]).mean())):
            break
    return trees, stop.losses


# --------------------------------------------------------------- whole training

TREES = ("model int, round int, node long, feature int, bin int, gain double, grad double, cover double, "
         "rows long, loss double")


def _records(model: int, trees: list[Tree], losses: list[float], s: Setting):
    for r, t in enumerate(trees):
        for k, v in sorted(t.nodes.items()):
            yield (model, r, k, *v, losses[r] if k == 0 and r < len(losses) else None)


def _record_batch(rows) -> pa.Table:
    names = ["model", "round", "node", "feature", "bin", "gain", "grad", "cover", "rows", "loss"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(),
             pa.int64(), pa.float64()]
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names)


_BLOCK = "block long, n int, x binary, y binary, key binary, fold binary"


def _block_up(edges, features: int):
    """Rows ``fold, y, key, features`` to blocks of binned rows."""
    edges = [np.array(e, float) for e in edges]

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(at, BLOCK_ROWS)
                v = np.column_stack([b.column(3 + j).to_numpy(zero_copy_only=False).astype(float)
                                     for j in range(features)])
                cols = [_binned(v, edges), b.column(1).to_numpy(zero_copy_only=False).astype(np.int8),
                        b.column(2).to_numpy(zero_copy_only=False).astype(np.int64),
                        b.column(0).to_numpy(zero_copy_only=False).astype(np.int8)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([b.num_rows], pa.int32()),
                     *[pa.array([c.tobytes()], pa.binary()) for c in cols]], ["block", "n", "x", "y", "key", "fold"])
                number += 1
    return run


def _open_block(row, features: int, wide: bool):
    x = np.frombuffer(row["x"], np.uint16 if wide else np.uint8).reshape(-1, features)
    return (x, np.frombuffer(row["y"], np.int8).astype(float), np.frombuffer(row["key"], np.uint64),
            np.frombuffer(row["fold"], np.int8))


class Training:
    """Models = settings x folds over one set of rows.

    ``df``: the features, ``label`` (0 or 1) and a ``fold`` column; model (s, f)
    is fitted on the rows of other folds than f and judged on those of f.  A
    fold of -1 belongs to every fit.  ``folds``: the folds to hold out; [None]
    fits on all rows.  ``keys``: columns that tell rows apart (for sampling).
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Setting],
                 keys: Sequence[str], folds: Sequence[int | None] = (None,), fold: str | None = None,
                 task_rows: int = TASK_ROWS):
        self.features, self.task_rows = list(features), task_rows
        self.models = [(s, f) for s in settings for f in folds]
        self.spark = df.sparkSession
        d = df.select((F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
                      F.col(label).cast("int").alias("y"), F.xxhash64(*keys).alias("key"),
                      *[F.col(c).cast("double").alias(f"f{j}") for j, c in enumerate(features)])
        self.edges = bin_edges(d, [f"f{j}" for j in range(len(features))])
        self.bins = max(map(len, self.edges), default=0) + 1
        self.blocks = cut_lineage(d.mapInArrow(_block_up(self.edges, len(features)), _BLOCK))
        self.rows = self.blocks.agg(F.sum("n")).first()[0] or 0
        self.step = _step(self.rows, settings)

    def fit(self) -> DataFrame:
        """The trees: a record for each node, ``loss`` at the root the held-out
        loss after the round.  ``feature`` -1 marks a leaf."""
        if self.rows <= self.task_rows:
            return cut_lineage(self._in_tasks())
        return self._by_level()

    # a model in a task
    def _in_tasks(self) -> DataFrame:
        models, width, bins, step = self.models, len(self.features), self.bins, self.step

        def grow(t: pa.Table) -> pa.Table:
            m = t.column("model")[0].as_py()
            s, f = models[m]
            rows = sorted(t.to_pylist(), key=lambda r: r["block"])
            x, y, key, fold = (np.concatenate(c) for c in zip(*[_open_block(r, width, bins > 256) for r in rows]))
            held = np.zeros(len(y), bool) if f is None else fold == f
            trees, losses = train_in_task(x, y, key, held, s, bins, step)
            return _record_batch(_records(m, trees, losses, s))

        many = self.blocks.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))))
        return many.repartition(len(models), "model").groupBy("model").applyInArrow(grow, TREES)

    # one job for each level of all models
    def _by_level(self) -> DataFrame:
        models, width, bins, step = self.models, len(self.features), self.bins, self.step
        trees = [[] for _ in models]
        stops = [Stopper(s) for s, _ in models]
        state = self.blocks.withColumn("margin", F.lit(None).cast("binary"))
        live, round_ = list(range(len(models))), 0
        while live:
            now = {m: Tree() for m in live}
            open_, depth = {m: {0} for m in live}, 0
            while any(open_.values()):
                asked = {m: (models[m], now[m], open_[m]) for m in live if open_[m]}
                parts = state.mapInArrow(_level_sums(asked, len(models), round_, width, bins, step),
                                         "model int, part int, codes binary, g binary, h binary, n binary")
                found = parts.groupBy("model", "part").applyInArrow(
                    _level_splits(models, round_, width, bins, step),
                    "model int, node long, feature int, bin int, gain double, grad double, cover double, rows long")
                open_ = {m: set() for m in live}
                for r in found.collect():   # one record for each node of the level
                    s = models[r.model][0]
                    leaf = r.feature < 0 or depth == s.max_depth
                    now[r.model].nodes[r.node] = (-1 if leaf else r.feature, r.bin, r.gain, r.grad, r.cover, r.rows)
                    if not leaf:
                        open_[r.model] |= {2 * r.node + 1, 2 * r.node + 2}
                depth += 1
            for m, t in now.items():
                t.nodes = t.nodes or {0: (-1, 0, 0.0, 0.0, 0.0, 0)}
                t.prune(models[m][0].gamma)
                trees[m].append(t)
            state = cut_lineage(state.mapInArrow(_advance(now, models, width, bins), f"{_BLOCK}, margin binary, loss binary"))
            losses = {r.model: (r.loss, r.n) for r in state.select("loss").mapInArrow(
                _open_losses, "model int, loss double, n long").groupBy("model").agg(
                F.sum("loss").alias("loss"), F.sum("n").alias("n")).collect()}
            round_ += 1
            still = []
            for m in live:
                loss, n = losses.get(m, (0.0, 0))
                if not (n and stops[m].done(loss / n)) and round_ < models[m][0].rounds:
                    still.append(m)
            live, state = still, state.drop("loss")
        rows = [r for m, (s, _) in enumerate(models) for r in _records(m, trees[m], stops[m].losses, s)]
        return cut_lineage(self.spark.createDataFrame(rows, TREES))


def _margins(row, models: int, n: int) -> np.ndarray:
    if row["margin"] is None:
        return np.zeros((models, n))
    return np.frombuffer(row["margin"]).reshape(models, n)


def _level_sums(asked, models: int, round_: int, width: int, bins: int, step: float):
    """A block's sums for the open nodes of every model, cut by node into parts
    so that no task merges a whole level of a model."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y, key, fold = _open_block(row, width, bins > 256)
                margins, out = _margins(row, models, len(y)), []
                for m, ((s, f), tree, nodes) in asked.items():
                    use = _drawn(s, round_, key)
                    if f is not None:
                        use &= fold != f
                    use = np.flatnonzero(use)
                    g, h = _gradients(y[use], margins[m][use], s, step)
                    at = tree.place(x[use])
                    here = np.isin(at, np.fromiter(nodes, np.int64))
                    hist = sums(at[here], x[use][here], g[here], h[here], bins)
                    part = hist[0] // bins // width % 64
                    for p in np.unique(part):
                        k = part == p
                        out.append((m, int(p), *[c[k].tobytes() for c in hist]))
                cols = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                     *[pa.array(c, pa.binary()) for c in cols[2:]]], ["model", "part", "codes", "g", "h", "n"])
    return run


def _level_splits(models, round_: int, width: int, bins: int, step: float):
    def run(t: pa.Table) -> pa.Table:
        m = t.column("model")[0].as_py()
        s = models[m][0]
        hist = merged([[np.frombuffer(r[c], np.int64) for c in ("codes", "g", "h", "n")] for r in t.to_pylist()])
        found = best_splits(hist, width, bins, _columns(s, round_, width), s, step)
        names = ["model", "node", "feature", "bin", "gain", "grad", "cover", "rows"]
        cols = list(zip(*[(m, k, *v) for k, v in sorted(found.items())])) or [()] * 8
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return run


def _advance(now, models, width: int, bins: int):
    """Blocks with the round's trees added to the margins, and the summed
    held-out loss of each model."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y, key, fold = _open_block(row, width, bins > 256)
                margins = _margins(row, len(models), len(y)).copy()
                loss = np.zeros((len(models), 2))
                for m, tree in now.items():
                    s, f = models[m]
                    tree.add(x, margins[m], s)
                    held = fold == f if f is not None else np.zeros(len(y), bool)
                    loss[m] = _loss(y[held], margins[m][held]).sum(), held.sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["n"]], pa.int32()),
                     *[pa.array([row[c]], pa.binary()) for c in ("x", "y", "key", "fold")],
                     pa.array([margins.tobytes()], pa.binary()), pa.array([loss.tobytes()], pa.binary())],
                    ["block", "n", "x", "y", "key", "fold", "margin", "loss"])
    return run


def _open_losses(batches):
    for batch in batches:
        for b in batch.column(0):
            v = np.frombuffer(b.as_py()).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(v)), pa.int32()), pa.array(v[:, 0]), pa.array(v[:, 1].astype(np.int64))],
                ["model", "loss", "n"])


# ----------------------------------------------------------------- a fitted model

class BoostedModel:
    """One model's trees.  A model that watched a held-out set answers with the
    trees up to its best round."""

    def __init__(self, trees: DataFrame, model: int, setting: Setting, features: Sequence[str], edges):
        # the model itself: at most rounds x 2^(depth + 1) records
        rows = trees.where(F.col("model") == model).collect()
        self.setting, self.features, self.edges = setting, list(features), edges
        count = max((r["round"] for r in rows), default=-1) + 1
        losses = {r["round"]: r["loss"] for r in rows if r["loss"] is not None}
        self.losses = [losses[r] for r in range(count) if r in losses]
        self.grown = count
        self.best_round = min(range(len(self.losses)), key=self.losses.__getitem__) if self.losses else count - 1
        keep = self.best_round + 1 if setting.patience is not None else count
        self.trees = [Tree() for _ in range(keep)]
        for r in rows:
            if r["round"] < keep:
                self.trees[r["round"]].nodes[r["node"]] = tuple(r)[3:9]

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, the predicted class and both probabilities."""
        trees, s, edges = self.trees, self.setting, [np.array(e, float) for e in self.edges]
        width = len(self.features)
        d = df.select(*keep, *[F.col(c).cast("double").alias(f"_b{j}") for j, c in enumerate(self.features)])
        out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:len(keep)])

        def run(batches):
            for batch in batches:
                v = np.column_stack([batch.column(len(keep) + j).to_numpy(zero_copy_only=False).astype(float)
                                     for j in range(width)])
                x, margin = _binned(v, edges), np.zeros(batch.num_rows)
                for t in trees:
                    t.add(x, margin, s)
                p = 1 / (1 + np.exp(-margin))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array((p > 0.5).astype(np.int32)), pa.array(1 - p), pa.array(p)],
                    [*batch.schema.names[:len(keep)], "target_predicted", "proba_0", "proba_1"])
        return d.mapInArrow(run, f"{out}, target_predicted int, proba_0 double, proba_1 double")


def importance(trees: DataFrame, features: Sequence[str], model: int = 0) -> DataFrame:
    """For each feature that splits, ``splits``, mean ``gain`` and mean
    ``cover`` (hessian) of its splits, and their sums."""
    names = F.array(*[F.lit(f) for f in features])
    return (trees.where((F.col("model") == model) & (F.col("feature") >= 0))
            .groupBy(F.element_at(names, F.col("feature") + 1).alias("feature"))
            .agg(F.count(F.lit(1)).alias("splits"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"),
                 F.sum("gain").alias("total_gain"), F.sum("cover").alias("total_cover")))


def fit(df: DataFrame, features: Sequence[str], label: str, setting: Setting, keys: Sequence[str],
        valid: str | None = None, task_rows: int = TASK_ROWS) -> tuple[BoostedModel, DataFrame]:
    """One model and its trees.  ``valid``: a boolean column of the rows that are
    not fitted on but watched after each round (M13: with ``patience`` the
    training itself ends, not a later look at it)."""
    d, fold = df, None
    if valid:
        d, fold = df.withColumn("_fold", F.when(F.col(valid), 0).otherwise(-1)), "_fold"
    t = Training(d, features, label, [setting], keys, [0] if valid else [None], fold, task_rows)
    trees = t.fit()
    return BoostedModel(trees, 0, setting, features, t.edges), trees


def settings_of(base: Setting, grid: dict[str, Sequence], sample: int | None = None, seed: int = 42) -> list[Setting]:
    """All settings of a grid, or ``sample`` of them drawn without repeats."""
    every = [replace(base, **dict(zip(grid, v))) for v in itertools.product(*grid.values())]
    return every if sample is None or sample >= len(every) else random.Random(seed).sample(every, sample)


def search(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Setting], keys: Sequence[str],
           names: Sequence[str], folds: int = 5, task_rows: int = TASK_ROWS) -> DataFrame:
    """Cross-validated search over stratified folds by log loss, all
    settings and folds trained together.  One row for each setting: its ``names``,
    ``mean_log_loss``, ``std_log_loss`` (over the folds) and ``rank``."""
    from .classify import stratified_folds

    d = stratified_folds(df, label, keys, folds)
    t = Training(d, features, label, settings, keys, range(folds), "fold", task_rows)
    trees = t.fit()
    # the loss after the last round of each model
    last = (trees.where("node = 0").groupBy("model").agg(F.max_by("loss", "round").alias("loss"))
            .withColumn("setting", F.floor(F.col("model") / folds).cast("int")))
    table = df.sparkSession.createDataFrame(
        [(i, *[float(asdict(s)[n]) for n in names]) for i, s in enumerate(settings)],
        "setting int, " + ", ".join(f"{n} double" for n in names))
    agg = last.groupBy("setting").agg(F.avg("loss").alias("mean_log_loss"), F.stddev_pop("loss").alias("std_log_loss"))
    # a row for each setting: a window over the settings
    rank = F.row_number().over(Window.orderBy("mean_log_loss", "setting"))
    return table.join(agg, "setting").withColumn("rank", rank).select(*names, "mean_log_loss", "std_log_loss", "rank")
