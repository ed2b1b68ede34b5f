"""A hierarchical k-means tree, and the best-bin-first order of its leaves."""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np


class Tree(NamedTuple):
    """Nodes in one array; ``children[i]`` are the places of node i's children, none for a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: list[int]
    leaves: int


def _kmeans(points: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = points[random.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        mine = nearest(points, centres)
        for j in range(k):
            members = points[mine == j]
            centres[j] = members.mean(0) if len(members) else points[random.integers(len(points))]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each point; ties go to the first."""
    return ((centres**2).sum(1)[None, :] - 2 * points @ centres.T).argmin(1)


def grow(sample: np.ndarray, leaf_size: int, branching: int = 8, seed: int = 5) -> Tree:
    """Split the sample again and again until a node holds at most ``leaf_size`` of it."""
    random = np.random.default_rng(seed)
    centres, children, leaf_of, leaves = [sample.mean(0)], [[]], [-1], 0
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        points = sample[rows]
        k = min(branching, -(-len(rows) // leaf_size))
        if k < 2 or (points == points[0]).all():
            leaf_of[node] = leaves
            leaves += 1
            continue
        found = _kmeans(points, k, random)
        mine = nearest(points, found)
        used = [j for j in range(k) if (mine == j).any()]
        if len(used) < 2:
            leaf_of[node] = leaves
            leaves += 1
            continue
        for j in used:
            children[node].append(len(centres))
            todo.append((len(centres), rows[mine == j]))
            centres.append(found[j])
            children.append([])
            leaf_of.append(-1)
    return Tree(np.array(centres), children, leaf_of, leaves)


def leaf_numbers(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf that each point descends to."""
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if not tree.children[node]:
            out[rows] = tree.leaf_of[node]
            continue
        own = np.array(tree.children[node])
        mine = nearest(points[rows], tree.centres[own])
        todo += [(int(child), rows[mine == j]) for j, child in enumerate(own)]
    return out


def best_bin_first(tree: Tree, query: np.ndarray):
    """Leaves by a priority queue: the nearest node met so far is opened next."""
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        own = tree.children[node]
        if not own:
            yield tree.leaf_of[node]
            continue
        gap = ((tree.centres[own] - query) ** 2).sum(1)
        for distance, child in zip(gap.tolist(), own, strict=True):
            heapq.heappush(queue, (distance, child))
