"""A decision tree over presence flags (M8, M9), grown in the tasks that hold its rows.

The library's tree lies in the driver as objects, a node for every few item
sets once it is deep.  Here rows are item sets with their class counts.  The
driver knows only the nodes above those of ``NODE_ROWS`` rows; each of these is
finished, down to its leaves, by the task that gets its rows.  What comes out is no
tree but every asked item set's class at each depth.  Gini gains, ties (the first
flag) and leaves (no gain) are the library's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows of a node that one task finishes alone
NODE_ROWS = 1 << 15
_LEAF, _LOCAL = -1, -2


def _gini(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """1 - the classes' squared shares, subtracted one by one as the library does (rounding decides ties)."""
    out = np.ones(n.shape)
    for k in range(c.shape[-1]):
        share = c[..., k] / np.maximum(n, 1.0)
        out -= share * share
    return np.where(n == 0, 0.0, out)


def best_flags(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Flag with the highest gain per node, -1 where none gains: class counts of nodes and of their rows with each flag."""
    zeros = total[:, None, :] - ones
    n, n0, n1 = total.sum(-1), zeros.sum(-1), ones.sum(-1)
    gain = _gini(total, n)[:, None] - n0 / n[:, None] * _gini(zeros, n0) - n1 / n[:, None] * _gini(ones, n1)
    gain[(n0 == 0) | (n1 == 0)] = -1.0
    best = gain.argmax(1)
    return np.where(gain[np.arange(len(best)), best] > 0, best, -1)


class Top:
    """The nodes that the driver knows: flag (or kind), children, and the classes from the root to the node."""

    def __init__(self):
        self.flag, self.child, self.path = [_LOCAL], [(0, 0)], [()]

    def split(self, node: int, flag: int) -> list:
        self.flag[node], self.child[node] = flag, (len(self.flag), len(self.flag) + 1)
        self.flag += [_LOCAL, _LOCAL]
        self.child += [(0, 0), (0, 0)]
        self.path += [self.path[node], self.path[node]]
        return list(self.child[node])

    def route(self, mask: np.ndarray) -> np.ndarray:
        """The node that each item set ends in."""
        flag, child = np.array(self.flag), np.array(self.child)
        node = np.zeros(len(mask), int)
        while (go := np.flatnonzero(flag[node] >= 0)).size:
            at = node[go]
            node[go] = child[at, (mask[go] >> flag[at]) & 1]
        return node


def _columns(b, classes: int):
    mask = b.column(0).to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else b.column(0).to_numpy()
    return mask, np.column_stack([np.asarray(b.column(1 + k), float) for k in range(classes)])


def _counted(rows: DataFrame, top: Top, nodes: list, flags: int, classes: int) -> np.ndarray:
    """Per node of ``nodes``: its rows, its class counts, and those of its rows with each flag."""
    slot = np.full(len(top.flag), -1)
    slot[nodes] = np.arange(len(nodes))

    def run(batches):
        out = np.zeros((len(nodes), 1 + classes * (1 + flags)))
        for b in batches:
            mask, c = _columns(b, classes)
            at = slot[top.route(mask)]
            mask, c, at = mask[at >= 0], c[at >= 0], at[at >= 0]
            out[:, 0] += np.bincount(at, minlength=len(nodes))
            for k in range(classes):
                out[:, 1 + k] += np.bincount(at, c[:, k], len(nodes))
            for i in range(flags):
                on = (mask >> i) & 1 == 1
                for k in range(classes):
                    out[:, 1 + classes * (1 + i) + k] += np.bincount(at[on], c[on, k], len(nodes))
        yield pa.RecordBatch.from_pydict({"v": [out.tobytes()]})
    # one table of counts per task: as many tasks as cores
    parts = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "v binary").collect()
    return sum(np.frombuffer(r["v"], float).reshape(len(nodes), -1) for r in parts)


def top_nodes(rows: DataFrame, flags: int, classes: int, depth: int) -> Top:
    """The tree above the nodes of at most ``NODE_ROWS`` rows, level by level; at most rows / NODE_ROWS are open at once."""
    top, nodes = Top(), [0]
    while nodes:
        found, following = _counted(rows, top, nodes, flags, classes), []
        total = found[:, 1:1 + classes]
        if not total.any():
            raise ValueError("no training rows")
        ones = found[:, 1 + classes:].reshape(len(nodes), flags, classes)
        for node, n, t, best in zip(nodes, found[:, 0], total, best_flags(total, ones) if flags else np.full(len(nodes), -1)):
            if n <= NODE_ROWS:
                continue
            top.path[node] = (*top.path[node], int(t.argmax()))
            if best < 0 or len(top.path[node]) > depth:
                top.flag[node] = _LEAF
            else:
                following += top.split(node, int(best))
        nodes = following
    return top


def grown_below(mask: np.ndarray, c: np.ndarray, flags: int, depth: int) -> np.ndarray:
    """Classes of a node's item sets from that node (first) to ``depth`` levels below, a leaf's repeated."""
    out = np.zeros((len(mask), depth + 1), np.uint8)
    idx, node, starts = np.arange(len(mask)), np.zeros(len(mask), int), np.array([0])
    for level in range(depth + 1):
        total = np.add.reduceat(c[idx], starts)
        out[idx, level:] = total.argmax(1)[node][:, None]
        mixed = total.max(1) < total.sum(1)
        on = mixed[node]  # a pure node gains nothing
        if level == depth or not on.any():
            break
        idx, node, total = idx[on], (np.cumsum(mixed) - 1)[node[on]], total[mixed]
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        ones, m, w = np.empty((len(total), flags, c.shape[1])), mask[idx], c[idx]
        for i in range(flags):
            ones[:, i] = np.add.reduceat(w * ((m >> i) & 1)[:, None], starts)
        best = best_flags(total, ones)[node]
        idx, node, m, best = (a[best >= 0] for a in (idx, node, m, best))
        if not len(idx):
            break
        key = node * 2 + ((m >> best) & 1)
        order = np.argsort(key, kind="stable")
        idx, key = idx[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        starts, node = np.flatnonzero(new), np.cumsum(new) - 1
    return out


def _texts(classes: np.ndarray) -> pa.Array:
    """A row's classes as a text, a character each."""
    rows = np.ascontiguousarray(classes + np.uint8(ord("0")))
    return pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary()).cast(pa.string())


def paths(rows: DataFrame, flags: int, classes: int, depth: int) -> DataFrame:
    """``rows`` (mask, a count per class, asked) -> (mask, path) of those asked for: the class predicted at
    each depth, a character each, of the tree grown on the counts."""
    top = top_nodes(rows, flags, classes, depth)
    spark, counts = rows.sparkSession, [f"c{k}" for k in range(classes)]

    def ended(batches):
        known = np.zeros((len(top.path), depth + 1), np.uint8)
        for i, p in enumerate(top.path):
            if top.flag[i] == _LEAF:
                known[i] = [*p, *[p[-1]] * (depth + 1 - len(p))]
        leaf = np.array(top.flag) == _LEAF
        for b in batches:
            mask = b.column(0).to_numpy()
            node = top.route(mask)
            on = leaf[node]
            yield pa.RecordBatch.from_arrays([pa.array(mask[on]), _texts(known[node[on]])], ["mask", "path"])

    def tagged(batches):
        local = np.array(top.flag) == _LOCAL
        for b in batches:
            node = top.route(b.column(0).to_numpy())
            b = pa.RecordBatch.from_arrays([*b.columns, pa.array(node)], [*b.schema.names, "node"])
            yield b.filter(pa.array(local[node]))

    def finished(key, t):
        above = top.path[key[0].as_py()]
        mask, c = _columns(t, classes)
        out = np.empty((len(mask), depth + 1), np.uint8)
        out[:, :len(above)] = above
        out[:, len(above):] = grown_below(mask, c, flags, depth - len(above))
        asked = t.column(1 + classes).to_numpy()
        return pa.table({"mask": mask[asked], "path": _texts(out[asked])})

    rows = rows.select("mask", *counts, "asked")
    types = "mask long, " + ", ".join(f"{c} double" for c in counts) + ", asked boolean, node long"
    below = rows.mapInArrow(tagged, types).groupBy("node").applyInArrow(finished, "mask long, path string")
    if _LEAF not in top.flag:
        return below
    return below.unionByName(rows.filter("asked").mapInArrow(ended, "mask long, path string"))
