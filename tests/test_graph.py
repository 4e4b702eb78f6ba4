"""Graph building and betweenness against a brute-force Brandes."""

import random

import pytest

import brandes
from helpers import write_text
from warbler.operators import centrality, graph
from warbler.sources import tables

EXAMPLE = "a,b,1.0\na,c,2.0\nb,c,1.5\nb,d,1.7\n"


def _graph_from_text(spark, tmp_dir, text, name="g.csv"):
    path = write_text(f"{tmp_dir}/{name}", text)
    return graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")


def _scores(df):
    return {r.node: r.betweenness for r in df.collect()}


def _check(spark, tmp_dir, edges, **kw):
    text = "".join(f"{a},{b},{w}\n" for a, b, w in edges)
    g = _graph_from_text(spark, tmp_dir, text)
    got = _scores(centrality.betweenness(g, **kw))
    want = brandes.betweenness(edges)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12), k


def test_example_golden(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, EXAMPLE)
    got = _scores(centrality.node_sizes(centrality.betweenness(g)).select("node", "betweenness"))
    assert got["b"] == pytest.approx(2 / 3, abs=1e-15)
    assert got["a"] == got["c"] == got["d"] == 0.0
    sizes = {r.node: r.node_size for r in centrality.node_sizes(centrality.betweenness(g)).collect()}
    assert sizes["b"] == pytest.approx(5000 * 2 / 3)


def test_example_in_batches(spark, tmp_dir):
    edges = [("a", "b", 1.0), ("a", "c", 2.0), ("b", "c", 1.5), ("b", "d", 1.7)]
    _check(spark, tmp_dir, edges, max_batch_rows=10)


def test_duplicate_edge_last_line_wins(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, "a,b,5\nb,c,1\na,c,1\nb,a,1\n")
    arcs = sorted(tuple(r) for r in g.arcs.collect())
    assert ("a", "b", 1.0) in arcs and ("b", "a", 1.0) in arcs and len(arcs) == 6


def test_self_loop_node_counts_but_edge_ignored(spark, tmp_dir):
    edges = [("a", "b", 1), ("b", "c", 1), ("z", "z", 3)]
    _check(spark, tmp_dir, edges)


def test_two_nodes_and_disconnected_parts(spark, tmp_dir):
    _check(spark, tmp_dir, [("a", "b", 1.0)])
    _check(spark, tmp_dir, [("a", "b", 1), ("b", "c", 1), ("x", "y", 2), ("y", "z", 2)])


def test_grid_ties(spark, tmp_dir):
    edges = []
    for i in range(4):
        for j in range(4):
            if i < 3:
                edges.append((f"n{i}{j}", f"n{i + 1}{j}", 1))
            if j < 3:
                edges.append((f"n{i}{j}", f"n{i}{j + 1}", 1))
    _check(spark, tmp_dir, edges)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs(spark, tmp_dir, seed):
    rnd = random.Random(seed)
    names = [f"v{i}" for i in range(12)]
    edges = [(rnd.choice(names), rnd.choice(names), rnd.choice([1, 2, 3, 0.5, 1.25]))
             for _ in range(24)]
    _check(spark, tmp_dir, edges, max_batch_rows=100 if seed == 3 else 2_000_000)


def test_nonpositive_weight_rejected(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, "a,b,0\nb,c,1\n")
    with pytest.raises(ValueError):
        centrality.betweenness(g)


def test_mention_edges_drop_self_and_merge_directions(spark):
    def rec(user, msg):
        return f"T\tx\nU\thttp://twitter.com/{user}\nW\t{msg}"
    vals = [rec("a", "@b #t x"), rec("b", "@a #t x"), rec("a", "@a #t x"), rec("c", "@a @a #t x")]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    got = sorted(tuple(r) for r in graph.mention_edges(df).collect())
    assert got == [("a", "b", 2), ("a", "c", 2)]
    topic = sorted(tuple(r) for r in graph.topic_mention_graph(df, "t").collect())
    assert topic == got


def test_last_wins_across_files_in_name_order(spark, tmp_dir):
    import os
    folder = os.path.join(tmp_dir, "edges")
    os.makedirs(folder)
    write_text(f"{folder}/part-0.csv", "a,b,1\nb,c,2\n")
    write_text(f"{folder}/part-1.csv", "b,a,7\n")
    g = graph.undirected_graph(tables.scan_edge_list(spark, folder, keep_order=True), "last")
    arcs = {(r.src, r.dst): r.weight for r in g.arcs.collect()}
    assert arcs[("a", "b")] == 7.0 and arcs[("b", "a")] == 7.0 and arcs[("c", "b")] == 2.0


def test_graph_without_arcs(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, "a,a,1\n")
    assert _scores(centrality.betweenness(g)) == {"a": 0.0}


def test_nan_weight_rejected(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, "a,b,NaN\nb,c,1\n")
    with pytest.raises(ValueError):
        centrality.betweenness(g)


def test_many_rounds(spark, tmp_dir):
    # A long weighted path with a few shortcuts: many rounds that change few rows.
    rnd = random.Random(7)
    edges = [(f"p{i:02d}", f"p{i + 1:02d}", rnd.choice([1, 2, 3])) for i in range(24)]
    edges += [("p00", "p05", 9), ("p03", "p11", 14), ("p10", "p20", 25), ("x", "y", 1)]
    _check(spark, tmp_dir, edges)


def test_no_stale_distance_is_counted(spark, tmp_dir):
    # u is reached by 0.9 and later by 0.3 + 0.6, one ulp less; v must count one path, not two.
    _check(spark, tmp_dir, [("s", "u", 0.9), ("s", "x", 0.3), ("x", "u", 0.6), ("u", "v", 2.0)])


def test_decimal_weights(spark, tmp_dir):
    # Many random graphs as the parts of one: paths never leave their part, so the raw scores of
    # the parts can be held against one run.
    rnd = random.Random(11)
    edges = []
    for part in range(200):
        names = [f"g{part}n{i}" for i in range(rnd.randint(3, 7))]
        edges += [(rnd.choice(names), rnd.choice(names), rnd.choice([0.1, 0.2, 0.3, 0.6, 0.7, 0.9, 0.25, 1.15]))
                  for _ in range(2 * len(names))]
    text = "".join(f"{a},{b},{w}\n" for a, b, w in edges)
    g = _graph_from_text(spark, tmp_dir, text)
    got = _scores(centrality.betweenness(g, normalized=False, max_batch_rows=1_000_000))
    want = brandes.betweenness(edges, normalized=False)
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) <= 1e-12


def test_star(spark, tmp_dir):
    _check(spark, tmp_dir, [("hub", f"leaf{i:03d}", 1 + i % 3) for i in range(120)])


def test_absorbed_weight_rejected(spark, tmp_dir):
    g = _graph_from_text(spark, tmp_dir, "a,b,1e20\nb,c,1\n")
    with pytest.raises(ValueError):
        centrality.betweenness(g)


def _random_edges(seed, nodes, n):
    rng = random.Random(seed)
    return [(f"n{rng.randrange(nodes)}", f"n{rng.randrange(nodes)}", rng.randint(1, 6)) for _ in range(n)]


def test_arcs_dealt_as_a_table(spark, tmp_dir):
    _check(spark, tmp_dir, _random_edges(1, 25, 60), broadcast_arcs=0, max_batch_rows=1500)


def test_rounds_read_less_as_sources_finish(spark, tmp_dir, monkeypatch):
    """A long chain with a tail: most sources finish early, and later rounds read what is left."""
    read = []
    original = centrality._Runs.known

    def spy(self):
        read.append((sum(rows for _, rows in self.runs), len(self.runs)))
        return original(self)

    monkeypatch.setattr(centrality._Runs, "known", spy)
    edges = [(f"c{i}", f"c{i + 1}", 1) for i in range(16)]  # a chain: its ends finish last
    edges += [(f"x{i}", f"x{(i + 1) % 5}", 1) for i in range(5)] + [(f"p{i}", f"q{i}", 2) for i in range(60)]
    _check(spark, tmp_dir, edges)
    most = max(rows for rows, _ in read)
    assert min(rows for rows, _ in read) >= 1 and read[-1][0] < most / 2
    assert all(runs <= 2 + most.bit_length() for _, runs in read)


def test_a_stopped_run_goes_on(spark, tmp_dir, monkeypatch):
    edges = _random_edges(2, 16, 40)
    text = "".join(f"{a},{b},{w}\n" for a, b, w in edges)
    options = {"max_batch_rows": 200, "in_flight": 1, "resume": f"{tmp_dir}/kept"}
    done = []
    original = centrality._Kept.publish

    def stops(self, batch, batches, scores):
        if len(done) == 2:
            raise RuntimeError("the cluster goes")
        original(self, batch, batches, scores)
        done.append((batch, batches))

    monkeypatch.setattr(centrality._Kept, "publish", stops)
    with pytest.raises(RuntimeError, match="the cluster goes"):
        centrality.betweenness(_graph_from_text(spark, tmp_dir, text), **options)
    assert [b for b, _ in done] == [0, 1] and done[0][1] >= 4
    monkeypatch.setattr(centrality._Kept, "publish", lambda *a: (done.append(a[1:3]), original(*a)))
    got = _scores(centrality.betweenness(_graph_from_text(spark, tmp_dir, text, "again.csv"), **options))
    assert sorted(b for b, _ in done) == list(range(done[0][1]))
    want = brandes.betweenness(edges)
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    # Another graph in the same folder starts anew.
    other = _random_edges(3, 12, 30)
    _check(spark, tmp_dir, other, **options)


def test_batches_at_once(spark, tmp_dir, monkeypatch):
    import threading

    running, most, lock = set(), [0], threading.Lock()
    original = centrality._distances

    def counted(cut, sources, arcs):
        with lock:
            running.add(cut.root)
            most[0] = max(most[0], len(running))
        try:
            return original(cut, sources, arcs)
        finally:
            with lock:
                running.discard(cut.root)

    monkeypatch.setattr(centrality, "_distances", counted)
    _check(spark, tmp_dir, _random_edges(4, 16, 40), max_batch_rows=200, in_flight=3)
    assert 2 <= most[0] <= 3


@pytest.mark.parametrize("seed", [5, 6])
def test_arcs_held_by_tasks(spark, tmp_dir, monkeypatch, seed):
    """No rounds over tables; ties, parts that are not connected, lone nodes, several batches."""
    monkeypatch.delattr(centrality, "_distances")
    edges = _random_edges(seed, 30, 45) + [("x", "y", 1), ("y", "z", 2), ("lone", "lone", 1)]
    _check(spark, tmp_dir, edges, held_arcs=1000, max_batch_rows=100)
    _check(spark, tmp_dir, [("s", "u", 0.9), ("s", "x", 0.3), ("x", "u", 0.6), ("u", "v", 2.0)], held_arcs=8)


def test_held_arcs_over_a_long_chain_and_a_hub(spark, tmp_dir):
    edges = [(f"c{i}", f"c{i + 1}", 1 + i % 3) for i in range(60)]
    edges += [("c0", f"leaf{i}", 0.1 * (i % 7 + 1)) for i in range(80)]
    edges += [(f"leaf{i}", f"leaf{i + 1}", 0.3) for i in range(0, 80, 2)]
    _check(spark, tmp_dir, edges, held_arcs=1000)


def test_held_arcs_refuse_absorbed_weights_and_leave_others_to_rows(spark, tmp_dir, monkeypatch):
    g = _graph_from_text(spark, tmp_dir, "a,b,1e20\nb,c,1\n")
    with pytest.raises(ValueError, match="too small"):
        centrality.betweenness(g, held_arcs=1000)
    monkeypatch.delattr(centrality, "_held")
    _check(spark, tmp_dir, _random_edges(7, 8, 12), held_arcs=10)
    with pytest.raises(ValueError, match="too small"):  # as by rows: the way on from b counts for nothing
        centrality.betweenness(_graph_from_text(spark, tmp_dir, "a,b,Infinity\nb,c,1\n", "far.csv"),
                               held_arcs=1000)
