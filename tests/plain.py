"""Plain versions of what operators compute, for small tables."""

from __future__ import annotations

import numpy as np


def spanning_tree(x: np.ndarray) -> list[tuple[float, int, int]]:
    """Edges of a minimum spanning tree of Euclidean distances, shortest first; by Prim's algorithm."""
    n = len(x)
    best, link, inside = np.full(n, np.inf), np.zeros(n, int), np.zeros(n, bool)
    at, edges = 0, []
    for _ in range(n - 1):
        inside[at] = True
        d = np.sqrt(np.square(x - x[at]).sum(axis=1))
        nearer = ~inside & (d < best)
        best[nearer], link[nearer] = d[nearer], at
        at = int(np.where(inside, np.inf, best).argmin())
        edges.append((float(best[at]), int(link[at]), at))
    return sorted(edges)


def leaf_clusters(x: np.ndarray, least: int) -> np.ndarray:
    """Labels from the leaves of the condensed single-linkage tree; -1 is noise.

    With one neighbour asked for, core distances are 0 and mutual
    reachability is plain distance. Going down the tree, a split makes two
    new clusters if both sides have ``least`` members; else the smaller
    side falls out of the cluster. Clusters that never split are the leaves.
    """
    n = len(x)
    labels = np.full(n, -1)
    if n < 2:
        return labels
    children: list[tuple[int, int]] = []
    size, top = [1] * n, list(range(n))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for _, a, b in spanning_tree(x):
        a, b = find(a), find(b)
        children.append((a, b))
        size.append(size[a] + size[b])
        top.append(len(top))
        top[a] = top[b] = len(top) - 1

    def members(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            i = todo.pop()
            if i < n:
                out.append(i)
            else:
                todo.extend(children[i - n])
        return out

    def fallen(node: int) -> tuple[int, tuple[int, int] | None]:
        """The node at which a cluster that starts at ``node`` truly splits, and its two sides."""
        while node >= n:
            a, b = children[node - n]
            if size[a] >= least and size[b] >= least:
                return node, (a, b)
            bigger = a if size[a] >= size[b] else b
            if size[bigger] < least:
                return node, None
            node = bigger
        return node, None

    root = len(top) - 1
    todo, leaves = [root], []
    while todo:
        start = todo.pop()
        _, sides = fallen(start)
        if sides is None:
            leaves.append(start)
        else:
            todo.extend(sides)
    if leaves == [root]:
        return labels  # the whole is no cluster of its own
    for k, leaf in enumerate(sorted(leaves, key=lambda i: min(members(i)))):
        labels[members(leaf)] = k
    return labels
