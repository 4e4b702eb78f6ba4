"""Plain single-machine Brandes (Dijkstra, exact float ties) for checking the Spark version."""

from __future__ import annotations

import heapq
from collections import defaultdict
from itertools import count


def simple_graph(edges):
    """Undirected simple graph; a repeated pair (either direction) keeps its last weight."""
    nodes, weight = set(), {}
    for a, b, w in edges:
        nodes.update((a, b))
        weight[(a, b) if a <= b else (b, a)] = float(w)
    adj = defaultdict(dict)
    for (a, b), w in weight.items():
        if a != b:
            adj[a][b] = w
            adj[b][a] = w
    return nodes, adj


def betweenness(edges, normalized=True):
    nodes, adj = simple_graph(edges)
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        order, preds = [], defaultdict(list)
        sigma = dict.fromkeys(nodes, 0.0)
        sigma[s] = 1.0
        done, seen, tie = {}, {s: 0.0}, count()
        heap = [(0.0, next(tie), s)]
        while heap:
            d, _, v = heapq.heappop(heap)
            if v in done:
                continue
            done[v] = d
            order.append(v)
            for x, w in adj[v].items():
                nd = d + w
                if x in done:
                    continue
                if x not in seen or nd < seen[x]:
                    seen[x] = nd
                    sigma[x] = sigma[v]
                    preds[x] = [v]
                    heapq.heappush(heap, (nd, next(tie), x))
                elif nd == seen[x]:
                    sigma[x] += sigma[v]
                    preds[x].append(v)
        delta = dict.fromkeys(order, 0.0)
        for x in reversed(order):
            for v in preds[x]:
                delta[v] += sigma[v] / sigma[x] * (1.0 + delta[x])
            if x != s:
                bc[x] += delta[x]
    n = len(nodes)
    if normalized:
        scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else None
    else:
        scale = 0.5
    if scale is not None:
        bc = {k: v * scale for k, v in bc.items()}
    return bc
