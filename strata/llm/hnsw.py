"""A hierarchical navigable small-world graph in flat arrays, for vectors of one shard.

Nodes stand in order of their level, highest first, so the nodes of layer l are the first ``sizes[l]``
and the neighbours of layer l are one array ``links[l][sizes[l], width]`` of node numbers (-1: none).

Nodes are inserted in batches that at most double the graph: a batch looks for its neighbours in the graph
so far by beam search, layer by layer, and among itself; neighbours are chosen by the diversity rule (a
candidate that is nearer to a chosen neighbour than to the node waits until the others are served) and
linked back. All searches of a batch take their steps together, as array operations.

Nearness is the inner product. For the graph, vectors get one more coordinate that brings all of a shard to
one length, so that the largest product is also the smallest distance; queries have 0 there."""

from __future__ import annotations

import numpy as np

#: Most bytes of the visited marks of one block of searches.
MARK_BYTES = 16 << 20
#: A link is kept before nearer ones while its target has no more incoming links than this.
LEAST_INCOMING = 6


def even_lengths(vectors: np.ndarray) -> np.ndarray:
    """``vectors`` scaled to a largest length of 1, with the coordinate that completes each to 1."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(initial=np.finfo(np.float64).tiny)  # squares cannot overflow
    square = np.einsum("ij,ij->i", x, x)
    most = square.max(initial=np.finfo(np.float64).tiny)
    rest = np.sqrt(np.maximum(0.0, 1.0 - square / most))
    return np.hstack([x / np.sqrt(most), rest[:, None]]).astype(np.float32)


def query_form(vectors: np.ndarray) -> np.ndarray:
    """Queries of length 1 (which changes no order) with a last coordinate of 0."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.hstack([x, np.zeros((len(x), 1))]).astype(np.float32)


class Graph:
    def __init__(self, points: np.ndarray, sizes: list[int], links: list[np.ndarray]) -> None:
        self.points, self.sizes, self.links = points, sizes, links

    def _entered(self, q: np.ndarray, layer_sizes: list[int], width: int, down_to: int) -> np.ndarray:
        """Entry points [b, width] of layer ``down_to``, found from the top layer downwards."""
        entry = np.zeros((len(q), 1), np.int32)
        for layer in range(len(layer_sizes) - 1, down_to, -1):
            if layer_sizes[layer]:
                entry = self.beam(q, entry, layer, width, layer_sizes[layer])[0]
        return entry

    def beam(
        self, q: np.ndarray, entry: np.ndarray, layer: int, width: int, size: int, step: int = 2,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Best ``width`` nodes of a layer for each query, and their products (-1 and -inf where the layer
        has fewer). Every step expands the ``step`` best nodes that wait; a search ends when all of its
        beam has been expanded."""
        b = len(q)
        block = max(1, MARK_BYTES // max(1, size))
        if b > block:
            done = [self.beam(q[s:s + block], entry[s:s + block], layer, width, size, step)
                    for s in range(0, b, block)]
            return np.vstack([d[0] for d in done]), np.vstack([d[1] for d in done])
        links, points = self.links[layer], self.points
        out_ids = np.full((b, width), -1, np.int32)
        out_sim = np.full((b, width), -np.inf, np.float32)
        ids, sim = out_ids.copy(), out_sim.copy()
        waits = np.zeros((b, width), bool)
        seen = np.zeros((b, size), bool)
        rows = np.arange(b)[:, None]
        entry = entry[:, :width]
        some = entry >= 0
        start = np.where(some, entry, 0)
        first = np.einsum("bd,bed->be", q, points[start])
        n = entry.shape[1]
        ids[:, :n], sim[:, :n], waits[:, :n] = entry, np.where(some, first, -np.inf), some
        r, c = np.nonzero(some)
        seen[r, entry[r, c]] = True
        at = np.arange(b)  # where the searches still going on belong
        while True:
            going = waits.any(axis=1)
            if not going.all():
                over = ~going
                out_ids[at[over]], out_sim[at[over]] = ids[over], sim[over]
                at, ids, sim, waits, seen, q = at[going], ids[going], sim[going], waits[going], seen[going], q[going]
                rows = np.arange(len(at))[:, None]
            if not len(at):
                break
            ahead = np.where(waits, sim, -np.inf)
            best = np.argpartition(-ahead, min(step, width) - 1, axis=1)[:, :step]
            live = np.take_along_axis(waits, best, 1)
            waits[rows, best] = False
            found, fresh = [], []
            for e in range(best.shape[1]):
                near = links[np.where(live[:, e], ids[rows[:, 0], best[:, e]], 0)]
                there = (near >= 0) & live[:, e:e + 1]
                near = np.where(there, near, 0)
                new = there & ~seen[rows, near]
                r, c = np.nonzero(new)
                seen[r, near[r, c]] = True
                found.append(near)
                fresh.append(new)
            near, new = np.hstack(found), np.hstack(fresh)
            r, c = np.nonzero(new)
            more = np.full(near.shape, -np.inf, np.float32)
            more[r, c] = np.einsum("ij,ij->i", q[r], points[near[r, c]])
            all_sim = np.hstack([sim, more])
            keep = np.argpartition(-all_sim, width - 1, axis=1)[:, :width]
            sim = np.take_along_axis(all_sim, keep, 1)
            ids = np.take_along_axis(np.hstack([ids, near]), keep, 1)
            waits = np.take_along_axis(np.hstack([waits, new]), keep, 1)
            ids[np.isneginf(sim)] = -1
        order = np.argsort(-out_sim, axis=1, kind="stable")
        return np.take_along_axis(out_ids, order, 1), np.take_along_axis(out_sim, order, 1)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Numbers [b, width] of the nearest nodes found (-1: none)."""
        q = query_form(queries)
        entry = self._entered(q, self.sizes, 8, 0)
        return self.beam(q, entry, 0, width, self.sizes[0])[0]


def _diverse(
    points: np.ndarray, ids: np.ndarray, sim: np.ndarray, most: int, must: np.ndarray | None = None,
) -> np.ndarray:
    """Up to ``most`` of the candidates ``ids`` [b, c] of each row (-1: none), whose products ``sim`` fall:
    first those marked in ``must``, then those that no chosen one is nearer to than the node is, then the
    nearest of the others."""
    b, c = ids.shape
    if c <= most:
        return np.hstack([ids, np.full((b, most - c), -1, np.int32)])
    vectors = points[np.maximum(ids, 0)]
    among = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros((b, c), bool)
    count = np.zeros(b, np.int64)
    near = np.full((b, c), -np.inf, np.float32)
    for j in range(c):
        ok = (ids[:, j] >= 0) & (count < most) & (near[:, j] < sim[:, j])
        chosen[:, j] = ok
        count += ok
        near = np.where(ok[:, None], np.maximum(near, among[:, j]), near)
    rank = np.where(ids < 0, 2, np.where(chosen, 0, 1)) * c + np.arange(c)
    if must is not None:
        rank = np.where(must & (ids >= 0), np.arange(c) - c, rank)
    pick = np.argsort(rank, axis=1)[:, :most]
    return np.take_along_axis(ids, pick, 1)


def _by_nearness(points: np.ndarray, node: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of each node in order of falling product, and the products."""
    sim = np.einsum("bd,bcd->bc", points[node], points[np.maximum(ids, 0)])
    sim = np.where(ids >= 0, sim, -np.inf).astype(np.float32)
    order = np.argsort(-sim, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)


def _cut(
    points: np.ndarray, links: np.ndarray, incoming: np.ndarray, node: np.ndarray, ids: np.ndarray, degree: int,
) -> None:
    """Give each ``node`` the best ``degree`` of the candidates ``ids``. Links to nodes that few others link to
    go first: far out in space lie nodes that are nobody's nearest, and a search must still reach them."""
    ids, sim = _by_nearness(points, node, ids)
    kept = _diverse(points, ids, sim, degree, incoming[np.maximum(ids, 0)] <= LEAST_INCOMING)
    np.subtract.at(incoming, ids[ids >= 0], 1)
    np.add.at(incoming, kept[kept >= 0], 1)
    links[node] = -1
    links[node, :degree] = kept


def _link_back(
    points: np.ndarray, links: np.ndarray, incoming: np.ndarray, new: np.ndarray, chosen: np.ndarray, degree: int,
) -> None:
    """Add each of the ``new`` nodes to the links of its ``chosen`` neighbours. The array has room for half
    as many again as ``degree``; only a node that overflows it is cut down to ``degree``."""
    r, c = np.nonzero(chosen >= 0)
    if not len(r):
        return
    target, source = chosen[r, c], new[r]
    order = np.lexsort((source, target))
    target, source = target[order], source[order]
    start = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
    n_in = np.diff(np.r_[start, len(target)])
    nodes = target[start]
    for group in np.array_split(np.argsort(n_in, kind="stable"), max(1, len(nodes) // 512)):
        if not len(group):
            continue
        wide = int(n_in[group].max())
        at = start[group][:, None] + np.arange(wide)
        more = np.where(np.arange(wide) < n_in[group][:, None], source[np.minimum(at, len(source) - 1)], -1)
        own = links[nodes[group]]
        more[(more[:, :, None] == own[:, None, :]).any(axis=2)] = -1  # two of a batch that chose each other
        np.add.at(incoming, more[more >= 0], 1)
        both = np.hstack([own, more.astype(np.int32)])
        fits = (both >= 0).sum(axis=1) <= links.shape[1]
        if fits.any():
            order = np.argsort(both[fits] < 0, axis=1, kind="stable")[:, :links.shape[1]]
            links[nodes[group[fits]]] = np.take_along_axis(both[fits], order, 1)
        if not fits.all():
            _cut(points, links, incoming, nodes[group[~fits]], both[~fits], degree)


def build(
    vectors: np.ndarray, degree: int = 16, width: int = 96, batch: int = 512, seed: int = 7,
) -> tuple[np.ndarray, Graph]:
    """The order of the nodes (numbers of ``vectors``' rows) and the graph over them. ``degree``: neighbours
    a node keeps on the upper layers, twice that on the lowest; ``width``: beam of an insertion."""
    n = len(vectors)
    levels = np.floor(-np.log(1.0 - np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int)
    order = np.argsort(-levels, kind="stable")
    levels = levels[order]
    points = even_lengths(vectors)[order] if n else np.zeros((0, vectors.shape[1] + 1), np.float32)
    sizes = [int((levels >= layer).sum()) for layer in range(int(levels.max(initial=0)) + 1)]
    keep = [degree * (1 if layer else 2) for layer in range(len(sizes))]
    links = [np.full((s, d + d // 2), -1, np.int32) for s, d in zip(sizes, keep)]
    incoming = [np.zeros(s, np.int64) for s in sizes]
    graph = Graph(points, sizes, links)
    done = 0
    while done < n:
        new = np.arange(done, min(n, done + min(batch, max(1, done))))
        _insert(graph, incoming, new, done, keep, width)
        done = int(new[-1]) + 1
    for layer, most in enumerate(keep):  # cut what is over the degree
        for start in range(0, sizes[layer], 512):
            node = np.arange(start, min(sizes[layer], start + 512))
            _cut(points, links[layer], incoming[layer], node, links[layer][node], most)
        links[layer] = np.ascontiguousarray(links[layer][:, :most])
    return order, graph


def _insert(
    graph: Graph, incoming: list[np.ndarray], new: np.ndarray, done: int, keep: list[int], width: int,
) -> None:
    q = graph.points[new]
    there = [min(done, s) for s in graph.sizes]
    entry = np.zeros((len(new), 1), np.int32)
    chosen = []
    for layer in range(len(graph.sizes) - 1, -1, -1):
        own = new[new < graph.sizes[layer]]  # the batch's nodes on this layer are its first ones
        found = np.full((len(new), 1), -1, np.int32)
        if there[layer]:
            few = graph.beam(q[len(own):], entry[len(own):], layer, 8, there[layer])[0]
            many = graph.beam(q[:len(own)], entry[:len(own)], layer, width, there[layer])[0]
            found = np.full((len(new), max(few.shape[1], many.shape[1])), -1, np.int32)
            found[:len(own), :many.shape[1]], found[len(own):, :few.shape[1]] = many, few
            entry = found
        if len(own):
            mates = q[:len(own)] @ q[:len(own)].T
            np.fill_diagonal(mates, -np.inf)
            n_mates = min(16, len(own) - 1)
            near = np.argpartition(-mates, n_mates, axis=1)[:, :n_mates] if n_mates else np.zeros((len(own), 0), int)
            both = np.hstack([found[:len(own)], own[near].astype(np.int32)])
            ids, sim = _by_nearness(graph.points, own, both)
            most = 4 * keep[layer] // 2
            chosen.append((layer, own, _diverse(graph.points, ids[:, :most], sim[:, :most], keep[layer] // (1 if layer else 2))))
    for layer, own, near in chosen:
        graph.links[layer][own, :near.shape[1]] = near
        np.add.at(incoming[layer], near[near >= 0], 1)
    for layer, own, near in chosen:
        _link_back(graph.points, graph.links[layer], incoming[layer], own, near, keep[layer])
