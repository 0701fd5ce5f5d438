"""A multiway hyperplane tree over a block of vectors, searched for the best rows within a window of scores.

A node has several split points; a row belongs to the nearest one. The node keeps, for every pair of a split point and a
sibling's subtree, the least and largest distance of the subtree's rows to the split point, and per subtree the range of its
rows' squared lengths. A window of inner products, with those lengths, is an annulus of distances around the probe: siblings
whose range of possible distances misses the annulus are left out. Leaves score their rows exactly.

Scores are whole numbers. Distances are rounded, so ranges are compared with room for the rounding, and never decide a result.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import ClassVar

import numpy as np

from tidemill.llm.exact_gemm import products

SPLITS = 8
LEAF_ROWS = 48
CANDIDATES = 3 * SPLITS

_PROBES_AT_ONCE = 512
_ROUNDING = 1e-12
_NONE = np.int64(np.iinfo(np.int64).min)


@dataclass
class HyperplaneTree:
    """Rows ordered so that a subtree is a run of them; node arrays have a row per inner node."""

    vectors: np.ndarray  # int64 (rows, dims)
    rows: np.ndarray  # the caller's numbers of the rows
    first: np.ndarray  # (nodes, SPLITS) start of each child's run
    stop: np.ndarray  # (nodes, SPLITS) its end; equal to the start for an absent child
    child: np.ndarray  # (nodes, SPLITS) the child's node, or -1 for a leaf
    point: np.ndarray  # (nodes, SPLITS) the row that is the split point
    near: np.ndarray  # (nodes, SPLITS, SPLITS) least distance of split point i to subtree j
    far: np.ndarray  # the largest
    short: np.ndarray  # (nodes, SPLITS) least squared length in the subtree
    long: np.ndarray

    TYPES: ClassVar[dict] = {"near": np.float64, "far": np.float64, "short": np.float64, "long": np.float64}

    def to_bytes(self) -> dict[str, bytes]:
        return {f.name: np.ascontiguousarray(getattr(self, f.name)).tobytes() for f in fields(self)}

    @classmethod
    def from_bytes(cls, parts: dict[str, bytes], dims: int) -> HyperplaneTree:
        shapes = {"vectors": (len(parts["rows"]) // 8, dims), "rows": (-1,), "near": (-1, SPLITS, SPLITS), "far": (-1, SPLITS, SPLITS)}
        return cls(
            **{f.name: np.frombuffer(parts[f.name], cls.TYPES.get(f.name, np.int64)).reshape(shapes.get(f.name, (-1, SPLITS))) for f in fields(cls)}
        )


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of two float matrices, up to rounding."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def _split_points(v: np.ndarray) -> np.ndarray:
    """Candidates spread over the run and the row farthest from the first; of these each next one far from those taken.

    Different vectors only, so one alone where all rows are equal.
    """
    far = int(_distances(v, v[:1])[:, 0].argmax())
    candidates = np.unique(np.append(np.linspace(0, len(v) - 1, min(len(v), CANDIDATES)).astype(np.int64), far))
    c = v[candidates]
    points = [0]
    gap = _distances(c, c[:1])[:, 0]
    while len(points) < SPLITS:
        gap[[i for i in range(len(c)) if (c[points] == c[i]).all(1).any()]] = -1
        best = int(gap.argmax())
        if gap[best] < 0:
            break
        points.append(best)
        gap = np.minimum(gap, _distances(c, c[best : best + 1])[:, 0])
    return candidates[points]


def build_tree(vectors: np.ndarray, rows: np.ndarray) -> HyperplaneTree:
    """A tree over all ``vectors``; equal vectors that no split point can part stay together in a leaf of any size."""
    v = vectors.astype(np.float64)
    length = (v * v).sum(1)
    order = np.arange(len(v))
    nodes: list[dict[str, np.ndarray]] = []
    waiting = [(0, len(v), -1, 0)] if len(v) else []  # a run, and the entry of its parent
    while waiting:
        start, end, parent, slot = waiting.pop()
        members = order[start:end].copy()
        if parent >= 0 and end - start <= LEAF_ROWS:
            continue
        picked = _split_points(v[members])
        if parent >= 0 and len(picked) < 2:
            continue
        points = members[picked]
        gap = _distances(v[points], v[members])
        owner = gap.argmin(axis=0)
        owner[picked] = np.arange(len(picked))  # however the distance to itself rounds
        node = {c: np.full(SPLITS, start if c in ("first", "stop") else -1, np.int64) for c in ("first", "stop", "child", "point")}
        node |= {c: np.zeros((SPLITS, SPLITS)) for c in ("near", "far")} | {c: np.zeros(SPLITS) for c in ("short", "long")}
        if parent >= 0:
            nodes[parent]["child"][slot] = len(nodes)
        at = start
        for j, point in enumerate(points):
            mine = owner == j
            run = members[mine]
            node["first"][j], node["stop"][j], node["point"][j] = at, at + len(run), point
            node["near"][: len(points), j], node["far"][: len(points), j] = gap[:, mine].min(1), gap[:, mine].max(1)
            node["short"][j], node["long"][j] = length[run].min(), length[run].max()
            waiting.append((at, at + len(run), len(nodes), j))
            order[at : at + len(run)] = run
            at += len(run)
        nodes.append(node)
    if not nodes:
        none = {c: np.zeros((0, SPLITS), np.int64) for c in ("first", "stop", "child", "point")}
        none |= {c: np.zeros((0, SPLITS, SPLITS)) for c in ("near", "far")} | {c: np.zeros((0, SPLITS)) for c in ("short", "long")}
        return HyperplaneTree(vectors=vectors, rows=rows, **none)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    stacked = {c: np.stack([n[c] for n in nodes]) for c in nodes[0]}
    stacked["point"] = np.where(stacked["point"] >= 0, place[stacked["point"]], -1)
    return HyperplaneTree(vectors=vectors[order], rows=rows[order], **stacked)


@dataclass
class Probes:
    """What is searched for: per probe a vector, the window of scores, and the groups of rows it may find."""

    vectors: np.ndarray  # int64 (probes, dims)
    own: np.ndarray  # the number of the row that is never found
    low: np.ndarray  # least score, int64
    high: np.ndarray  # largest score
    group: np.ndarray  # the probe's group of rows
    same: bool  # find rows of the same group, or only of others


class Best:
    """Per probe the ``k`` best rows so far: by score, then by the smaller id, then by the row."""

    def __init__(self, probes: int, k: int):
        self.k = k
        self.score = np.full((probes, k), _NONE)
        self.id = np.full((probes, k), np.iinfo(np.int64).max)
        self.row = np.full((probes, k), -1, np.int64)

    def floor(self) -> np.ndarray:
        """The score a row must reach to be of use."""
        return self.score[:, -1]

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, good: np.ndarray) -> None:
        """``score`` has a row per probe of ``who`` and a column per candidate; only ``good`` ones count."""
        good = good & (score >= self.floor()[who][:, None])
        use = np.flatnonzero(good.any(1))
        if not len(use):
            return
        at = who[use]
        shape = (len(use), len(rows))
        s = np.hstack([self.score[at], np.where(good[use], score[use], _NONE)])
        i = np.hstack([self.id[at], np.broadcast_to(ids, shape)])
        r = np.hstack([self.row[at], np.where(good[use], np.broadcast_to(rows, shape), -1)])
        # Ties at the k-th score are decided by id, so they all stay in the sort; it runs over the few probes with finds.
        order = np.lexsort((r, i, -np.maximum(s, _NONE + 1), r < 0), axis=1)[:, : self.k]
        self.score[at], self.id[at], self.row[at] = (np.take_along_axis(x, order, 1) for x in (s, i, r))


def search(tree: HyperplaneTree, ids: np.ndarray, groups: np.ndarray, probes: Probes, best: Best) -> int:
    """Put the tree's rows that fit each probe into ``best``; ``ids`` and ``groups`` are in the order of the tree's rows.

    Returns how many pairs of a probe and a row were scored.
    """
    scored = 0
    v = probes.vectors.astype(np.float64)
    length = (v * v).sum(1)

    def visit(node: int, active: np.ndarray) -> list[tuple]:
        """The node's children, the nearest ones last: they are taken first and raise the floor for the others."""
        points = tree.point[node][tree.point[node] >= 0]
        gap = _distances(v[active], tree.vectors[points].astype(np.float64))
        return [(node, j, active, gap) for j in np.argsort(-gap.mean(0), kind="stable")]

    for at in range(0, len(v), _PROBES_AT_ONCE):
        waiting = visit(0, np.arange(at, min(len(v), at + _PROBES_AT_ONCE))) if len(tree.rows) else []
        while waiting:
            node, j, active, gap = waiting.pop()
            low = np.maximum(probes.low[active], best.floor()[active])
            active = active[_meets(tree, node, j, gap, length[active], low, probes.high[active])]
            if not len(active):
                continue
            if tree.child[node][j] >= 0:
                waiting += visit(int(tree.child[node][j]), active)
                continue
            run = slice(int(tree.first[node][j]), int(tree.stop[node][j]))
            score = products(probes.vectors[active], tree.vectors[run])
            scored += score.size
            good = (groups[run][None, :] == probes.group[active][:, None]) == probes.same
            good &= (score >= probes.low[active][:, None]) & (score <= probes.high[active][:, None])
            good &= tree.rows[run][None, :] != probes.own[active][:, None]
            best.add(active, score, ids[run], tree.rows[run], good)
    return scored


def _meets(tree: HyperplaneTree, node: int, j: int, gap: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which probes' annulus of distances meets the range of their distances to subtree ``j``."""
    near, far = tree.near[node, : gap.shape[1], j], tree.far[node, : gap.shape[1], j]
    short, long = tree.short[node, j], tree.long[node, j]
    room = _ROUNDING * (length + long)
    least = np.maximum(gap - far, near - gap).max(1) - np.sqrt(room)
    most = (gap + far).min(1) + np.sqrt(room)
    inner = length + short - 2 * high.astype(np.float64) - room
    outer = length + long - 2 * low.astype(np.float64) + room
    return (outer >= 0) & (np.maximum(least, 0) ** 2 <= outer + room) & (most**2 >= inner - room)
