"""Brandes' sums of a graph whose edges all have an end among few nodes, its hubs.

Accounts that many mention are such hubs: the others meet at them, and two that are no hubs are never
linked. Hubs are found by degree: of an edge, the end with more edges is a hub. What is no hub (a leaf) has
hubs for neighbours only, so the distances from a source to the hubs follow from the edges between hubs and
the ways from hub to hub over one leaf; those to the leaves then take one pass over the edges, in place of
rounds until nothing changes. What is left out of that:

- an edge or a way over a leaf that is longer, by more than all rounding could add up to (``slack``), than
  another way between its ends. No shortest path from any source has it, and it never ties with one.
- ways over leaves of the same ends and weights are one row with their number. If weights are whole numbers,
  sums are exact: then these rows also count paths, and as paths are the same both ways, a pair of leaves is
  taken from one of them for both (so sums are right over all nodes as sources). With other weights, paths
  are counted over the leaves themselves, by the same doubles, left to right from the source, as everywhere
  else.

Nothing is rounded, sampled or cut: graphs that are not of this kind are left to the general way.
"""

from __future__ import annotations

import numpy as np

#: Hubs at most (a table of the ways between them is held).
MOST_HUBS = 2048
#: Pairs of edges of a leaf at most, over all leaves.
MOST_WAYS = 1 << 29
#: Edges of a leaf, the shortest ones, that are tried for a shorter way than an edge.
NEAREST = 6
#: Sources that go through a piece of the edges, one after the other, while it is in the processor's cache.
AT_ONCE = 8


def hub_trees(most_hubs: int = MOST_HUBS, most_ways: int = MOST_WAYS, piece: int = 1 << 14):
    """A function in one piece, so that workers need not have this package: (nodes, sources, u, v, w) of
    edges given once to the dependencies per node, summed over the sources; None if the graph has too many
    hubs, or weights too small against its size to tell ties from rounding."""

    def counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(keys, return_inverse=True)
        return keys, np.bincount(place, times, len(keys))

    def nths(groups: np.ndarray, n: int) -> np.ndarray:
        """Of rows in order of their group: the place in it."""
        return np.arange(len(groups)) - np.searchsorted(groups, np.arange(n))[groups]

    def between(hubs: int, cu, cv, cw, h, v, w, leaves: int):
        """No more than this far from hub to hub (a row and column more, for no hub), and of every edge of a
        leaf the shortest other way that was found between its ends."""
        nth = nths(v, leaves)
        near = nth < NEAREST
        ends, far = np.full((NEAREST, leaves), hubs), np.full((NEAREST, leaves), np.inf)
        ends[nth[near], v[near]], far[nth[near], v[near]] = h[near], w[near]
        way = np.full((hubs + 1, hubs + 1), np.inf)
        np.minimum.at(way.ravel(), cu.astype(np.int64) * (hubs + 1) + cv, cw)
        for i in range(NEAREST):
            for j in range(i):
                np.minimum.at(way.ravel(), ends[i] * (hubs + 1) + ends[j], far[i] + far[j])
        way = np.minimum(way, way.T)
        if hubs <= 512:
            for k in range(hubs):
                np.minimum(way, way[:, k, None] + way[k], out=way)
        np.fill_diagonal(way, np.inf)
        other = np.full(len(w), np.inf)
        for a in range(0, len(w), 1 << 18):
            some = slice(a, a + (1 << 18))
            for i in range(NEAREST):
                np.minimum(other[some], way[ends[i][v[some]], h[some]] + far[i][v[some]], out=other[some])
        return way, other

    def laid(h, v, w, hubs: int, leaves: int):
        """Leaves in order of their number of edges, in pieces (first edge, edges a leaf, leaves, first leaf)
        of like ones: nth edges of a piece's leaves stand side by side. Missing ones lead to no hub, at inf."""
        count = np.bincount(v, minlength=leaves)
        step = 1 << np.maximum(0, np.frexp(count)[1].astype(np.int64) - 5)
        wide = -(-count // step) * step
        order = np.argsort(wide, kind="stable")
        pieces, at, lead, gap = [], 0, np.empty(leaves, np.int64), np.empty(leaves, np.int64)
        for k, first, rows in zip(*(x.tolist() for x in np.unique(wide[order], return_index=True, return_counts=True))):
            most = max(1, piece // k)
            for a in range(first, first + rows, most):
                r = min(most, first + rows - a)
                pieces.append((at, k, r, a))
                lead[a:a + r], gap[a:a + r] = at + np.arange(r), r
                at += k * r
        place = np.empty(leaves, np.int64)
        place[order] = np.arange(leaves)
        where = lead[place[v]] + nths(v, leaves) * gap[place[v]]
        to, far = np.full(at, hubs), np.full(at, np.inf)
        to[where], far[where] = h, w
        return order, count[order], pieces, lead, gap, to, far

    def ways_of(way, pieces, to, far, kinds, hubs: int):
        """Of the leaves of a piece: (first leaf, leaves, leaf of each way over it, key of each way)."""
        kind = len(kinds)
        for at, k, r, first in pieces:
            h, w = (x[at:at + k * r].reshape(k, r) for x in (to, far))
            c = np.searchsorted(kinds, w)
            for i in range(k):
                j, x = np.nonzero(w[i] + w <= np.take(way, h[i] * (hubs + 1) + h))
                yield first, r, x, ((h[i][x] * hubs + h[j, x]) * kind + c[i][x]) * kind + c[j, x]

    def over_leaves(ways, most: int):
        """(key, number) of the ways over a leaf; None if more than most."""
        found, times, new, size = np.empty(0, np.int64), np.empty(0), [], 0
        for *_, keys in ways:
            new.append(keys)
            size += len(keys)
            if size > 1 << 20:
                found, times = counted(np.concatenate([found, *new]), np.concatenate([times, np.ones(size)]))
                new, size = [], 0
                if len(found) > most:
                    return None
        found, times = counted(np.concatenate([found, *new]), np.concatenate([times, np.ones(size)]))
        return None if len(found) > most else (found, times)

    def prepared(n: int, u, v, w):
        """The graph by hubs and leaves, of what may lie on a shortest path; None if it is not of this kind."""
        degree = np.bincount(u, minlength=n) + np.bincount(v, minlength=n)
        swap = (degree[u] < degree[v]) | ((degree[u] == degree[v]) & (u < v))
        u, v = np.where(swap, v, u), np.where(swap, u, v)
        hub = np.zeros(n, bool)
        hub[u] = True
        hubs = int(hub.sum())
        leaves = n - hubs
        slack = n * w.max() * (4 * hubs + 16) * 2.0 ** -53
        if hubs > most_hubs or not w.min() > slack:
            return None
        most, exact = 2 * len(w), bool((w % 1 == 0).all()) and n * w.max() < 2.0 ** 52
        place = np.empty(n, np.int32)
        place[hub], place[~hub] = np.arange(hubs), np.arange(leaves)
        both = hub[v]
        cu, cv, cw = place[u[both]], place[v[both]], w[both]
        h, v, w = place[u[~both]], place[v[~both]], w[~both]
        del u, swap, both, degree
        # An order of its own, so that all tasks lay out leaves alike.
        order = np.lexsort((h, w, v))
        h, v, w = h[order], v[order], w[order]
        del order
        way, other = between(hubs, cu, cv, cw, h, v, w, leaves)
        keep = w <= other + slack
        del other
        h, v, w = h[keep], v[keep], w[keep]
        keep = cw <= way[cu, cv] + slack
        cu, cv, cw = (np.concatenate([cu[keep], cv[keep]]).astype(np.int64),
                      np.concatenate([cv[keep], cu[keep]]).astype(np.int64), np.tile(cw[keep], 2))
        if (np.bincount(v).astype(float) ** 2).sum() > most_ways:
            return None
        order, count, pieces, lead, gap, to, far = laid(h, v, w, hubs, leaves)
        del h, v, w
        # Back to itself, or to no hub, is no way.
        np.fill_diagonal(way, -np.inf)
        way[hubs] = way[:, hubs] = -np.inf
        kinds = np.unique(far)
        kind = len(kinds)
        if float(hubs) ** 2 * float(kind) ** 2 > 2.0 ** 62:
            return None
        way = way.ravel() + slack
        found = over_leaves(ways_of(way, pieces, to, far, kinds, hubs), most)
        if found is None:
            return None
        keys, times = found
        (ws, wt), (wa, wb) = np.divmod(keys // (kind * kind), hubs), np.divmod(keys % (kind * kind), kind)
        ws, wt, wa, wb, times = (np.concatenate(x) for x in zip(
            (ws, wt, kinds[wa], kinds[wb], times), (cu, cv, cw, np.zeros(len(cw)), np.ones(len(cw)))))
        by = np.argsort(wt, kind="stable")

        def per_leaf(on_ways: np.ndarray) -> np.ndarray:
            """What is on the ways, summed per leaf that they go over."""
            by_key, sums = np.empty(len(by)), np.zeros(leaves)
            by_key[by] = on_ways
            for first, r, x, some in ways_of(way, pieces, to, far, kinds, hubs):
                sums[first:first + r] += np.bincount(x, by_key[np.searchsorted(keys, some)], r)
            return sums

        names = np.concatenate([np.flatnonzero(hub), np.flatnonzero(~hub)[order]])
        return (hubs, exact, names, pieces, lead, gap, count, to, far, (cu, cv, cw), per_leaf,
                (ws[by], wt[by], wa[by], wb[by], times[by], *np.unique(wt[by], return_index=True)))

    def run(n: int, own: np.ndarray, u, v, w) -> np.ndarray | None:
        graph = prepared(n, u, v, w)
        if graph is None:
            return None
        hubs, exact, names, pieces, lead, gap, count, to, far, (cu, cv, cw), per_leaf, ways = graph
        ws, wt, wa, wb, times, ends, starts = ways
        leaves, nothing = n - hubs, np.empty(0, np.int64)
        most = max(k * r for _, k, r, _ in pieces)
        here, then, into, out = np.empty(most), np.empty(most), np.empty(most, bool), np.empty(most, bool)
        nth = {(k, r): np.tile(np.arange(r), k) for _, k, r, _ in pieces}
        place, on_ways = np.empty(n, np.int64), np.zeros(len(ws))
        place[names] = np.arange(n)

        class Source:
            """A source: its distances and paths to the hubs (one more for no hub, never on a path)."""

            def __init__(self, s: int):
                self.s, self.leaf = s, s - hubs
                d, paths = np.full(hubs + 1, np.inf), np.zeros(hubs)
                if self.leaf < 0:
                    d[s], paths[s] = 0.0, 1.0
                else:
                    mine = lead[self.leaf] + gap[self.leaf] * np.arange(count[self.leaf])
                    np.minimum.at(d, to[mine], far[mine])
                sent = nothing
                while len(ws):
                    sent = d[ws]
                    sent += wa
                    sent += wb
                    best = np.minimum.reduceat(sent, starts)
                    less = best < d[ends]
                    if not less.any():
                        break
                    d[ends[less]] = best[less]
                if self.leaf >= 0:
                    paths += np.bincount(to[mine][far[mine] == d[to[mine]]], minlength=hubs)
                self.apart = d[:hubs].max() == np.inf
                if exact:
                    on = np.flatnonzero((sent == d[wt]) & (sent < np.inf)) if len(ws) else nothing
                    self.on, self.a, self.b, self.times = on, ws[on], wt[on], times[on]
                else:
                    on = np.flatnonzero((d[cu] + cw == d[cv]) & (d[cu] < np.inf))
                    self.a, self.b, self.times = cu[on], cv[on], 1.0
                d[hubs] = 0.0
                self.d, self.paths = d, paths
                self.enter, self.middle, self.leave = [], [], []
                self.q = np.zeros(hubs)
                if exact:
                    self.count_paths()
                else:
                    self.sigmas = np.zeros(leaves)

            def leaves_of(self, at: int, k: int, r: int, first: int) -> None:
                """Of a piece, the distances of its leaves and the arcs of shortest paths that enter and leave
                them. Exact sums are the same both ways, so of two leaves one is the source, for both."""
                if exact and first + r <= self.leaf + 1:
                    return
                size, mine = k * r, first <= self.leaf < first + r
                ends, edge, leaf = to[at:at + size], far[at:at + size].reshape(k, r), nth[k, r]
                hub_far, sent, is_in, is_out = (x[:size].reshape(k, r) for x in (here, then, into, out))
                np.take(self.d, ends, out=here[:size], mode="clip")
                np.add(hub_far, edge, out=sent)
                best = np.minimum.reduce(sent, axis=0)
                if self.apart:
                    best[best == np.inf] = np.nan  # not reached: no arc
                if mine:
                    best[0 if exact else self.leaf - first:self.leaf - first + 1] = np.nan
                np.equal(sent, best, out=is_in)
                on = np.flatnonzero(into[:size])
                arcs = ends[on], leaf[on], first, r
                if exact:
                    self.share(*arcs)
                    return
                self.enter.append(arcs)
                np.add(edge, best, out=sent)
                np.equal(sent, hub_far, out=is_out)
                on = np.flatnonzero(out[:size])
                if len(on):
                    self.leave.append((ends[on], leaf[on] + first))
                    is_in &= is_out.any(axis=0)
                    on = np.flatnonzero(into[:size])
                    self.middle.append((ends[on], leaf[on] + first))

            def share(self, h, v, first: int, r: int) -> None:
                """The paths to a piece's leaves, and what their hubs get for them."""
                sigma = np.bincount(v, self.sigma[h], r)
                if not exact:
                    self.sigmas[first:first + r] = sigma
                self.q += np.bincount(h, (1.0 / np.maximum(sigma, 1.0))[v], hubs)

            def over(self, first, second, x: np.ndarray) -> np.ndarray:
                """What hubs send to hubs: by the arcs between them, and over leaves."""
                (a, b, by), (mh, ml, lh, ll, enters, leaves_by) = first, second
                sent = np.bincount(b, by * x[a], hubs)
                return sent if exact else sent + np.bincount(
                    lh, leaves_by * np.bincount(ml, enters * x[mh], leaves)[ll], hubs)

            def count_paths(self) -> None:
                """By the number of hubs on them."""
                self.lh, self.ll = map(np.concatenate, zip(*self.leave)) if self.leave else (nothing, nothing)
                self.mh, self.ml = map(np.concatenate, zip(*self.middle)) if self.middle else (nothing, nothing)
                self.sigma, paths = np.zeros(hubs), self.paths
                while paths.any():
                    self.sigma += paths
                    paths = self.over((self.a, self.b, self.times), (self.mh, self.ml, self.lh, self.ll, 1.0, 1.0), paths)

            def add_to(self, total: np.ndarray) -> None:
                if not exact:
                    self.count_paths()
                    for arcs in self.enter:
                        self.share(*arcs)
                elif self.leaf >= 0:
                    self.q = 2.0 * self.q
                sigma, lh, ll, mh, ml = self.sigma, self.lh, self.ll, self.mh, self.ml
                by = self.times * sigma[self.a] / sigma[self.b]
                q = self.q * sigma + np.bincount(self.a, by, hubs)
                enters = leaves_by = None
                if not exact:
                    enters, leaves_by = sigma[mh] / self.sigmas[ml], self.sigmas[ll] / sigma[lh]
                    q = q + np.bincount(mh, enters * np.bincount(ll, leaves_by, leaves)[ml], hubs)
                delta = np.zeros(hubs)
                while q.any():
                    delta += q
                    q = self.over((self.b, self.a, by), (lh, ll, mh, ml, leaves_by, enters), q)
                rate = (1.0 + delta) / np.maximum(sigma, 1.0)
                if exact:
                    on_ways[self.on] += sigma[self.a] * rate[self.b]
                elif len(ll):
                    total[hubs:] += np.bincount(ll, rate[lh], leaves) * self.sigmas
                if self.leaf < 0:
                    delta[self.s] = 0.0
                total[:hubs] += delta

        total, own = np.zeros(n), place[own].tolist()
        for i in range(0, len(own), AT_ONCE):
            sources = [Source(s) for s in own[i:i + AT_ONCE]]
            for piece in pieces:
                for source in sources:
                    source.leaves_of(*piece)
            for source in sources:
                source.add_to(total)
        if exact:
            total[hubs:] = per_leaf(on_ways)
        scores = np.empty(n)
        scores[names] = total
        return scores

    return run
