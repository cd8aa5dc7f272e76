"""Hierarchical navigable small-world graph over unit vectors, searched for many queries at once."""

from __future__ import annotations

import numpy as np

LINKS = 16
BUILD_BEAM = 48
BATCH = 256
# One in so many nodes of a layer also stands in the layer above.
LAYER_RATIO = 16
TOP_NODES = 128


class Graph:
    """Layers of neighbour lists; the lowest holds every node, and nodes are row numbers.

    Nodes enter in row order, which the caller shuffles, a batch at a time: a batch finds
    candidates by searching the graph so far, and among itself by comparison. Neighbours are
    chosen diversely, so that groups of near-equal vectors keep links to the rest.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        sizes = [n]
        while sizes[-1] > TOP_NODES:
            sizes.append(-(-sizes[-1] // LAYER_RATIO))
        # Rows come shuffled, so the first rows are a random sample for the upper layers.
        self.sizes = sizes
        self.layers: list[np.ndarray] = [np.empty((0, 0), dtype=np.int32)] * len(sizes)
        for level in range(len(sizes) - 1, -1, -1):
            self.layers[level] = np.full((sizes[level], 2 * LINKS if level == 0 else LINKS), -1, dtype=np.int32)
            self._build(level)

    def _build(self, level: int) -> None:
        n, layer = self.sizes[level], self.layers[level]
        at = 0
        while at < n:
            # The first batch has only itself to link to.
            batch = np.arange(at, min(n, at + (TOP_NODES if at == 0 else min(BATCH, at))))
            q = self.vectors[batch]
            inner = q @ q.T
            np.fill_diagonal(inner, -np.inf)
            near = min(LINKS, len(batch) - 1)
            ids = np.empty((len(batch), 0), dtype=np.int64)
            sims = np.empty((len(batch), 0), dtype=np.float32)
            if near:
                local = np.argpartition(-inner, near - 1, axis=1)[:, :near]
                ids, sims = batch[local], np.take_along_axis(inner, local, axis=1)
            if at:
                found, found_sims, _ = self._beam(level, q, self._entries(level, q), BUILD_BEAM, at)
                ids, sims = np.concatenate([found, ids], axis=1), np.concatenate([found_sims, sims], axis=1)
            chosen, chosen_sims = self._choose(ids, sims, LINKS)
            layer[batch, : chosen.shape[1]] = chosen
            self._link_back(layer, batch, chosen, chosen_sims)
            at = int(batch[-1]) + 1

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``most`` of each row's candidates: first those closer to the node than to any
        chosen one, then the closest others; -1 fills up."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 4 * LINKS]
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        real = np.isfinite(sims) & (ids >= 0)
        points = self.vectors[np.maximum(ids, 0)]
        between = np.matmul(points, points.transpose(0, 2, 1))
        kept = np.zeros(ids.shape, dtype=bool)
        for k in range(ids.shape[1]):
            blocked = (kept[:, :k] & (between[:, k, :k] > sims[:, k : k + 1])).any(axis=1)
            kept[:, k] = real[:, k] & ~blocked
        # Diverse ones first, each kind by closeness; a quarter of the places is for the closest.
        rank = np.where(kept, 0, 1) + 2 * ~real
        rank[:, : most // 4] = np.where(real[:, : most // 4], 0, rank[:, : most // 4])
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        real = np.take_along_axis(real, order, axis=1)
        return np.where(real, ids, -1).astype(np.int32), np.where(real, sims, -np.inf)

    def _link_back(self, layer: np.ndarray, batch: np.ndarray, chosen: np.ndarray, sims: np.ndarray) -> None:
        real = chosen >= 0
        target, source = chosen[real].astype(np.int64), np.repeat(batch, real.sum(axis=1))
        score = sims[real]
        if not len(target):
            return
        # The closest new links of each target, as many as a list holds.
        order = np.lexsort((-score, target))
        target, source, score = target[order], source[order], score[order]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
        width = layer.shape[1]
        fits = place < width
        nodes = target[first]
        row = np.repeat(np.arange(len(nodes)), np.diff(np.r_[first, len(target)]))
        new = np.full((len(nodes), min(width, int(place.max()) + 1)), -1, dtype=np.int64)
        new_sims = np.full(new.shape, -np.inf, dtype=np.float32)
        new[row[fits], place[fits]] = source[fits]
        new_sims[row[fits], place[fits]] = score[fits]
        for k in range(0, len(nodes), 1024):
            part = slice(k, k + 1024)
            old = layer[nodes[part]].astype(np.int64)
            old_sims = np.einsum("nd,nkd->nk", self.vectors[nodes[part]], self.vectors[np.maximum(old, 0)])
            old_sims[old < 0] = -np.inf
            known = (new[part][:, :, None] == old[:, None, :]).any(axis=2)
            fresh_sims = np.where(known, -np.inf, new_sims[part])
            ids, every = np.concatenate([old, new[part]], axis=1), np.concatenate([old_sims, fresh_sims], axis=1)
            picked, _ = self._choose(ids, every, width)
            layer[nodes[part], : picked.shape[1]] = picked
            layer[nodes[part], picked.shape[1] :] = -1

    def _entries(self, level: int, q: np.ndarray) -> np.ndarray:
        """Nodes of layer ``level`` to start from, found in the layers above."""
        top = len(self.sizes) - 1
        if level == top:
            return np.zeros((len(q), 1), dtype=np.int64)
        near = q @ self.vectors[: self.sizes[top]].T
        found = np.argpartition(-near, min(8, near.shape[1]) - 1, axis=1)[:, :8].astype(np.int64)
        for above in range(top - 1, level, -1):
            found = self._beam(above, q, found, 16, self.sizes[above])[0][:, :8]
        return np.maximum(found, 0)

    def _beam(self, level: int, q: np.ndarray, entries: np.ndarray, beam: int, limit: int, floor: float = np.inf):
        """(ids, cosines) of each query's beam, best first, and all (query, node) met above ``floor``.

        All queries advance together; each step expands the best few unexpanded nodes of every
        beam. Only nodes below ``limit`` are there yet.
        """
        layer, b = self.layers[level], len(q)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, limit), dtype=bool)
        ids = np.sort(np.minimum(entries, limit - 1), axis=1)
        repeated = np.zeros(ids.shape, dtype=bool)
        repeated[:, 1:] = ids[:, 1:] == ids[:, :-1]
        sims = np.einsum("bd,bkd->bk", q, self.vectors[ids])
        seen[rows, ids] = True
        met = [np.argwhere(~repeated & (sims >= floor))]
        met_ids = [ids[~repeated & (sims >= floor)]]
        sims[repeated] = -np.inf
        done = repeated.copy()
        pad = max(0, beam - ids.shape[1])
        ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
        sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf)
        done = np.pad(done, ((0, 0), (0, pad)), constant_values=True)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        ids, sims, done = (np.take_along_axis(x, order, axis=1) for x in (ids, sims, done))
        active = np.arange(b)
        while len(active):
            waiting = ~done[active]
            active = active[waiting.any(axis=1)]
            if not len(active):
                break
            waiting = ~done[active]
            # The first unexpanded places of each beam: beams are sorted, so these are the best.
            place = np.cumsum(waiting, axis=1)
            pick = waiting & (place <= 4)
            who, where = np.nonzero(pick)
            done[active[who], where] = True
            nodes = ids[active[who], where]
            step = place[who, where] - 1
            near = np.full((len(active), 4, layer.shape[1]), -1, dtype=np.int64)
            near[who, step] = layer[nodes]
            near = np.sort(near.reshape(len(active), -1), axis=1)
            fresh = (near >= 0) & (near < limit)
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[active[:, None], np.clip(near, 0, limit - 1)]
            # Left-pack the fresh ones, so fewer vectors are gathered.
            most = int(fresh.sum(axis=1).max(initial=0))
            if not most:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
            near, fresh = np.take_along_axis(near, order, axis=1), np.take_along_axis(fresh, order, axis=1)
            a, c = np.nonzero(fresh)
            seen[active[a], near[a, c]] = True
            new = np.full(near.shape, -np.inf, dtype=np.float32)
            new[a, c] = np.einsum("kd,kd->k", q[active[a]], self.vectors[near[a, c]])
            above = new >= floor
            if above.any():
                x, y = np.nonzero(above)
                met.append(np.stack([active[x], y], axis=1))
                met_ids.append(near[x, y])
            every = np.concatenate([sims[active], new], axis=1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            sims[active] = np.take_along_axis(every, order, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), order, axis=1)
            flags = np.concatenate([done[active], ~fresh], axis=1)
            done[active] = np.take_along_axis(flags, order, axis=1)
        pairs = np.concatenate([m[:, 0] for m in met]), np.concatenate(met_ids)
        return ids, sims, pairs

    def above(self, q: np.ndarray, floor: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a cosine of at least ``floor``; a beam widens until it compares with all nodes."""
        queries, nodes, left = self.search(q, floor, beam, len(self.vectors))
        x, y = np.nonzero(q[left] @ self.vectors.T >= floor)
        return np.concatenate([queries, left[x]]), np.concatenate([nodes, y])

    def search(self, q: np.ndarray, floor: float, beam: int, widest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, node) pairs with a cosine of at least ``floor``, as far as the search finds them, and the
        queries that are left.

        A beam that is full of such nodes may have missed more: its query is searched again
        with twice the beam, up to ``widest``. Queries whose widest beam is full have no pairs and are left
        to comparison with all nodes.
        """
        n = len(self.vectors)
        asked = np.arange(len(q))
        queries, nodes = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        while len(asked) and beam < n:
            again = []
            for k in range(0, len(asked), BATCH):
                part = asked[k : k + BATCH]
                _, sims, (x, y) = self._beam(0, q[part], self._entries(0, q[part]), beam, n, floor)
                full = sims[:, -1] >= floor
                again.append(part[full])
                keep = ~full[x]
                queries.append(part[x[keep]])
                nodes.append(y[keep])
            asked = np.concatenate(again)
            beam *= 2
            if beam > widest:
                break
        return np.concatenate(queries), np.concatenate(nodes), asked
