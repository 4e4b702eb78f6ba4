"""Betweenness of graphs whose edges have an end among few nodes, against a brute-force Brandes."""

import random
from pathlib import Path

import numpy as np
import pytest

import brandes
from helpers import write_text
from warbler.operators import centrality, graph, hubs
from warbler.plans import registry, workloads
from warbler.sources import tables

WEIGHTS = {
    "whole": lambda r: r.randint(1, 3),
    "tenths": lambda r: r.randint(1, 9) / 10,
    "near ties": lambda r: r.choice([0.1, 0.2, 0.3, 0.1 + 0.2, 0.7]),
    "real": lambda r: r.random() + 0.01,
}


def _hub_edges(seed, weight, nodes=25, hub_count=5):
    r, edges = random.Random(seed), {}
    for _ in range(r.randint(10, 90)):
        a, b = r.randrange(hub_count if r.random() < 0.9 else nodes), r.randrange(nodes)
        if a != b:
            edges[min(a, b), max(a, b)] = weight(r)
    return [(a, b, w) for (a, b), w in edges.items()]


def _by_hubs(edges, **limits):
    names = sorted({x for a, b, _ in edges for x in (a, b)})
    u, v = (np.array([names.index(e[i]) for e in edges], np.int32) for i in (0, 1))
    scores = hubs.hub_trees(**limits)(len(names), np.arange(len(names)), u, v,
                                      np.array([e[2] for e in edges], float))
    return None if scores is None else dict(zip(names, scores / 2))


@pytest.mark.parametrize("kind", WEIGHTS)
@pytest.mark.parametrize("piece", [1, 16, 1 << 14])
def test_random_hubs(kind, piece):
    for seed in range(40):
        edges = _hub_edges(seed, WEIGHTS[kind])
        want, got = brandes.betweenness(edges, normalized=False), _by_hubs(edges, piece=piece)
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want), seed


def test_parts_stars_and_long_edges():
    star = [("hub", i, 1 + i % 4) for i in range(30)]
    pair = [("x", "y", 2)]
    far = [("a", i, 1) for i in range(40, 60)] + [("b", i, 1) for i in range(50, 70)] + [("a", "b", 9), ("b", 45, 8)]
    for edges in (star, pair, [(str(a), str(b), w) for a, b, w in star + pair + far]):
        names = [(str(a), str(b), w) for a, b, w in edges]
        want, got = brandes.betweenness(names, normalized=False), _by_hubs(names)
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_graphs_that_are_left_to_the_general_way():
    edges = _hub_edges(1, WEIGHTS["whole"])
    assert _by_hubs(edges, most_hubs=1) is None and _by_hubs(edges, most_ways=1) is None
    assert _by_hubs([("a", "b", 1e20), ("b", "c", 1.0)]) is None


@pytest.mark.parametrize("kind", ["whole", "tenths"])
def test_hubs_by_tasks_in_batches(spark, tmp_dir, monkeypatch, kind):
    """The queries' way: edges held by tasks, isolated nodes, more than one batch."""
    monkeypatch.delattr(centrality, "_distances")
    monkeypatch.setattr(centrality, "HELD_BATCH", 1000)
    done, publish = [], centrality._Kept.publish
    monkeypatch.setattr(centrality._Kept, "publish", lambda *a: (done.append(a[2]), publish(*a)))
    edges = [(f"n{a}", f"n{b}", w) for a, b, w in _hub_edges(3, WEIGHTS[kind], 60)] + [("lone", "lone", 1)]
    path = write_text(f"{tmp_dir}/hubs.csv", "".join(f"{a},{b},{w}\n" for a, b, w in edges))
    g = graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")
    got = {r.node: r.betweenness for r in
           centrality.betweenness(g, held_arcs=centrality.HELD_ARCS, max_batch_rows=1).collect()}
    want = brandes.betweenness(edges)
    assert set(got) == set(want) and len(done) == done[0] > 1
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_larger_graphs_are_held_if_their_hubs_are_few(spark, tmp_dir, monkeypatch):
    edges = [("h", f"n{i}", 1) for i in range(10)]
    path = write_text(f"{tmp_dir}/star.csv", "".join(f"{a},{b},{w}\n" for a, b, w in edges))
    g = graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")
    monkeypatch.setattr(centrality, "MOST_HUBS", 0)
    assert not centrality._few_hubs(g.arcs.select(*(g.arcs[x].alias(y) for x, y in (("src", "u"), ("dst", "v")))))
    monkeypatch.setattr(centrality, "MOST_HUBS", 1)
    monkeypatch.delattr(centrality, "_distances")
    got = centrality.betweenness(g, held_arcs=4, hub_arcs=20).collect()
    assert {r.node: r.betweenness for r in got} == {"h": 1.0, **{f"n{i}": 0.0 for i in range(10)}}
    with pytest.raises(NameError):  # by rows
        centrality.betweenness(g, held_arcs=4, hub_arcs=19)


@pytest.mark.parametrize("kind", WEIGHTS)
def test_tasks_that_share_the_sources(kind):
    """Edges come to tasks in any order and direction; of whole weights, a pair of leaves is taken once."""
    r = random.Random(5)
    for seed in range(20):
        edges = [(a, b, w) for a, b, w in _hub_edges(seed, WEIGHTS[kind])]
        names = sorted({x for a, b, _ in edges for x in (a, b)})
        total = np.zeros(len(names))
        for part in range(3):
            r.shuffle(edges)
            ends = [(a, b) if r.random() < 0.5 else (b, a) for a, b, _ in edges]
            u, v = (np.array([names.index(e[i]) for e in ends], np.int32) for i in (0, 1))
            total += hubs.hub_trees()(len(names), np.arange(part, len(names), 3), u, v,
                                      np.array([e[2] for e in edges], float))
        want = brandes.betweenness(edges, normalized=False)
        assert all(got == pytest.approx(want[k], abs=1e-9) for k, got in zip(names, total / 2)), seed


def test_held_sums_are_kept_apart_from_sums_by_rows(spark, tmp_dir):
    edges = _hub_edges(2, WEIGHTS["whole"])
    path = write_text(f"{tmp_dir}/kept.csv", "".join(f"{a},{b},{w}\n" for a, b, w in edges))
    g = graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")
    want = brandes.betweenness([(str(a), str(b), w) for a, b, w in edges])
    for options in ({}, {"held_arcs": 1000}):
        got = centrality.betweenness(g, resume=f"{tmp_dir}/kept", **options).collect()
        assert {r.node: r.betweenness for r in got} == pytest.approx(want, abs=1e-12)
    [kept] = Path(f"{tmp_dir}/kept").iterdir()
    assert {p.name for p in kept.iterdir()} >= {"graph", "scores-1", "held-1"}


def test_queries_and_edge_lists_hold_larger_graphs_with_hubs(spark, tmp_dir, monkeypatch):
    """Neither goes by rows for want of room for the arcs alone."""
    edges = _hub_edges(4, WEIGHTS["whole"])
    path = write_text(f"{tmp_dir}/larger.csv", "".join(f"{a},{b},{w}\n" for a, b, w in edges))
    g = graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")
    monkeypatch.setattr(centrality, "HELD_ARCS", 2)
    monkeypatch.delattr(centrality, "_distances")
    want = brandes.betweenness([(str(a), str(b), w) for a, b, w in edges])
    for scores in (registry._betweenness(g), workloads.edge_list_centrality(spark, path)):
        assert {r.node: r.betweenness for r in scores.collect()} == pytest.approx(want, abs=1e-12)
