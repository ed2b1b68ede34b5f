"""Minimum cut of a graph of blocks between two labels."""

from __future__ import annotations

from collections import deque


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that maximise the gains of the chosen nodes minus the weights of cut edges.

    A node's terminal capacity is its gain: to the source where positive, to the sink where
    negative. Nodes whose gain outweighs all their edges keep their sign in any minimum
    cut, so only the others enter the flow. Among equal cuts the one with the fewest
    chosen nodes is taken.
    """
    n = len(gain)
    gain = list(gain)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i, j, w in edges:
        if w > 0 and i != j:
            near[i].append((j, w))
            near[j].append((i, w))
    fixed: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if fixed[i] is None and abs(gain[i]) > sum(w for j, w in near[i] if fixed[j] is None):
            fixed[i] = gain[i] > 0
            for j, w in near[i]:
                if fixed[j] is None:
                    gain[j] += w if fixed[i] else -w
                    todo.append(j)
    open_ = [i for i in range(n) if fixed[i] is None]
    if open_:
        chosen = _flow(open_, gain, near, fixed)
        for i in open_:
            fixed[i] = i in chosen
    return [bool(x) for x in fixed]


def _flow(nodes: list[int], gain: list[float], near: list, fixed: list) -> set[int]:
    """Nodes on the source side after a maximum flow by shortest augmenting levels."""
    place = {i: k for k, i in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    head: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, i in enumerate(nodes):
        if gain[i] > 0:
            link(source, k, gain[i], 0.0)
        elif gain[i] < 0:
            link(k, sink, -gain[i], 0.0)
        for j, w in near[i]:
            if fixed[j] is None and i < j:
                link(k, place[j], w, w)
    while True:
        level = [-1] * len(head)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return {i for k, i in enumerate(nodes) if level[k] >= 0}
        at = [0] * len(head)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                most = min(room[e] for e in path)
                for e in path:
                    room[e] -= most
                    room[e ^ 1] += most
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[a] < len(head[a]):
                e = head[a][at[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(head[a]):
                path.append(head[a][at[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]
