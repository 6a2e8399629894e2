from __future__ import annotations

import random
from dataclasses import replace

import pytest

import brute_force
from fixtures import labelled
from topicpulse.operators import graph as g
from topicpulse.operators import cover, dense, labelling, pagerank, paths, reduction, sketches
from topicpulse.operators.lineage import Stages, cut, fixed_layout


def _scores(frame, column):
    return {(r.Category, r.id): getattr(r, column) for r in frame.collect()}


@pytest.fixture(scope="module")
def m2(spark):
    return g.topic_graph(labelled(spark))


def test_topics_nodes_and_links(m2):
    assert m2.topics == ["A", "B"]
    assert {r.id for r in m2.nodes.collect()} == set("abcd")
    assert m2.links.count() == 5
    assert [r.Category for r in g.edge_topics(m2.edges).collect()] == ["A", "B"]
    assert g.grid(m2).count() == 8


def test_degree_of_every_node_and_topic(m2):
    assert _scores(g.degree(m2), "degree") == {
        **{("A", v): 2.0 for v in "abcd"},
        ("B", "a"): 1.0,
        ("B", "b"): 1.0,
        ("B", "c"): 0.0,
        ("B", "d"): 0.0,
    }
    assert _scores(g.degree(m2, "in"), "degree")["A", "c"] == 2
    assert _scores(g.degree(m2, "out"), "degree")["A", "c"] == 0
    with pytest.raises(ValueError):
        g.degree(m2, "sideways")


def test_reciprocal_pair_counts_twice(spark):
    pair = g.topic_graph(labelled(spark, [("a", "b", "A"), ("b", "a", "A")]))
    assert set(_scores(g.degree(pair), "degree").values()) == {2.0}


def test_closeness(m2):
    got = _scores(paths.closeness(m2), "closeness")
    assert [got["A", v] for v in "abcd"] == pytest.approx([0, 1, 0.75, 1])
    assert [got["B", v] for v in "abcd"] == pytest.approx([0, 1, 0, 0])
    out = _scores(paths.closeness(m2, "out"), "closeness")
    assert [out["A", v] for v in "abcd"] == pytest.approx([0.75, 1, 0, 1])
    both = _scores(paths.closeness(m2, "both"), "closeness")
    assert [both["A", v] for v in "abcd"] == pytest.approx([0.75] * 4)
    scaled = _scores(paths.closeness(m2, wasserman_faust=True), "closeness")
    assert [scaled["A", v] for v in "abcd"] == pytest.approx([0, 1 / 3, 0.75, 1 / 3])
    with pytest.raises(ValueError):
        paths.closeness(m2, "up")


def test_betweenness(m2):
    got = _scores(paths.betweenness(m2), "betweenness")
    assert [got["A", v] for v in "abcd"] == pytest.approx([0, 0.5, 0, 0.5])
    assert [got["B", v] for v in "abcd"] == [0] * 4


def test_pagerank(m2):
    got = _scores(pagerank.pagerank(m2), "pagerank")
    assert [got["A", v] for v in "abcd"] == pytest.approx([0.15, 0.21375, 0.513375, 0.21375])
    assert [got["B", v] for v in "abcd"] == pytest.approx([0.15, 0.2775, 0.15, 0.15])
    with pytest.raises(ValueError):
        pagerank.pagerank(m2, rounds=0)


HUB = [(f"l{i}", "hub", "A") for i in range(15)] + [("hub", f"l{i}", "A") for i in range(15)]
CHAIN = [(f"c{i}", f"c{i + 1}", "A") for i in range(6)]


def test_a_share_of_one_is_exact(spark):
    graph = g.topic_graph(labelled(spark, HUB + CHAIN), heavy_rows=4)
    exact = _scores(paths.betweenness(graph), "betweenness")
    assert exact["A", "c3"] == 9
    assert _scores(paths.betweenness_sampled(graph, 1.0), "betweenness") == pytest.approx(exact)
    for share in (0, 1.5):
        with pytest.raises(ValueError):
            paths.sample_sources(graph, share)


def test_samples_are_right_on_average(spark):
    """The estimate is linear in the chosen sources, so brute force gives it for any seed."""
    edges = HUB + CHAIN
    nodes = sorted({v for e in edges for v in e[:2]})
    graph = g.topic_graph(labelled(spark, edges))
    names = {(r.Category, r.key): r.id for r in graph.degrees.collect()}
    alone = {v: brute_force.betweenness(edges, "A", nodes, sources=[v]) for v in nodes}
    exact = brute_force.betweenness(edges, "A", nodes)
    drawn = [
        [(names[r.Category, r.key], r.weight) for r in paths.sample_sources(graph, 0.4, seed).collect()]
        for seed in range(60)
    ]
    means = {v: sum(w * alone[s][v] for one in drawn for s, w in one) / len(drawn) for v in nodes}
    for v in ("hub", "c2", "c3", "c4"):
        assert means[v] == pytest.approx(exact[v], rel=0.35)
    got = _scores(paths.betweenness_sampled(graph, 0.4, seed=3), "betweenness")
    assert {v: got["A", v] for v in nodes} == pytest.approx(
        {v: sum(w * alone[s][v] for s, w in drawn[3]) for v in nodes}
    )


@pytest.mark.parametrize("direction, end", [("in", "node"), ("out", "source")])
@pytest.mark.parametrize("heavy_rows", [1_000_000, 2])
def test_closeness_in_blocks_is_that_of_single_searches(spark, direction, end, heavy_rows):
    names = [f"n{i:03}" for i in range(150)]
    edges = _random_edges(8, names, 400)
    graph = g.topic_graph(labelled(spark, edges).repartition(3), heavy_rows)
    blocks = paths.reach_sums(graph, outward=direction == "out")
    single = paths.path_scores(graph, end, with_betweenness=False)
    columns = ["Category", "id", "reached", "distance"]
    assert {tuple(r) for r in blocks.select(*columns).collect()} == {
        tuple(r) for r in single.select(*columns).collect()
    }


@pytest.mark.parametrize("sizes", [None, (1, 3, 20, 40)])
def test_undirected_sums_over_a_cover_are_those_of_blocks(spark, monkeypatch, sizes):
    """Chains, parts that are not connected, loops, links twice, a topic without nodes outside."""
    for name, value in zip(("LONGS", "ROWS", "CHUNK_LINKS", "SENT_LINKS"), sizes or ()):
        monkeypatch.setattr(cover, name, value)
    fans = [(f"s{i:03}", f"r{(i * j * j + i // 7) % 24}", "A") for i in range(200) for j in range(1 + i % 3)]
    chain = [(f"r{k}", f"r{k + 1}", "A") for k in range(24, 60, 2)] + [("r1", "r1", "A"), ("lone", "lone", "A")]
    chain += [(f"t{k}", f"r{k + j}", "A") for k in range(24, 60) for j in (0, 1)]
    ring = [(f"r{k}", f"r{(k + 1) % 9}", "B.c") for k in range(9)]
    graph = g.topic_graph(labelled(spark, [*fans, *fans[:9], *chain, *ring, ("x", "y", "C")]).repartition(3))
    expected = paths.reach_sums(g.topic_graph(g.reversed_both_ways(graph.edges)), wide=1)
    monkeypatch.setattr(paths, "reach_sums", None)
    rows = lambda x: {tuple(r) for r in x.filter("reached > 0").select("Category", "id", "reached", "distance").collect()}
    assert rows(paths.undirected_sums(graph)) == rows(expected)


def test_many_batches_end_in_one_table(spark):
    edges = _random_edges(5, [f"n{i:02}" for i in range(60)], 120)
    graph = g.topic_graph(labelled(spark, edges))
    most = max(paths._Search(graph, paths.MAX_VISITS, None)._most_visits() // 16, 1)
    search = paths._Search(graph, most, None)
    assert search.batches >= 16
    batched = paths.path_scores(graph, None, max_visits=most)
    whole = paths.path_scores(graph, None)
    assert len(str(batched._jdf.queryExecution().optimizedPlan()).splitlines()) == len(
        str(whole._jdf.queryExecution().optimizedPlan()).splitlines()
    )
    assert _scores(batched, "betweenness") == pytest.approx(_scores(whole, "betweenness"))


def test_links_that_no_search_gets_to_ask_for_no_batches(spark):
    """Links of nodes without incoming ones are visited once; the bound takes them so."""
    ring = [(f"r{k}", f"r{(k + 1) % 5}", "A") for k in range(5)]
    fan = [(f"s{k:03}", f"r{(k + j) % 5}", "A") for k in range(200) for j in (0, 2)]
    graph = g.topic_graph(labelled(spark, ring + fan))
    search = paths._Search(graph, 2_000, None)
    # The links of each source, and the five of the ring from each of them.
    assert search._most_visits() == 405 + 205 * 5
    assert search.batches == 1
    alone = paths._Search(graph, 2_000, paths.sample_sources(graph, 1.0))
    assert alone._most_visits() == 405 + 205 * 5
    nodes = sorted({v for e in ring + fan for v in e[:2]})
    expected = brute_force.betweenness(ring + fan, "A", nodes)
    got = _scores(paths.betweenness(graph, max_visits=2_000), "betweenness")
    assert {v: got["A", v] for v in nodes} == pytest.approx(expected)


def test_partitions_of_closeness_follow_the_links(spark, m2, monkeypatch):
    class Told(Exception):
        pass

    def told(session, partitions):
        raise Told(partitions)

    sizes = {"A": replace(m2.sizes["A"], edges=8_000_000)}
    monkeypatch.setattr(paths, "fixed_layout", told)
    with pytest.raises(Told) as found:
        paths.reach_sums(replace(m2, sizes=sizes))
    assert found.value.args[0] >= 32


@pytest.mark.parametrize("direction", ["in", "out", "both"])
def test_closeness_by_sketches_of_few_nodes_is_exact(spark, direction):
    names = [f"n{i:02}" for i in range(40)]
    edges = _random_edges(3, names, 90)
    heavy_rows = 4 if direction == "in" else 1_000_000
    graph = g.topic_graph(labelled(spark, edges).repartition(3), heavy_rows)
    got = _scores(sketches.closeness_sketched(graph, direction, True), "closeness")
    expected = _scores(paths.closeness(graph, direction, True), "closeness")
    assert got == pytest.approx(expected)
    with pytest.raises(ValueError):
        sketches.closeness_sketched(graph, "up")


def test_closeness_by_small_sketches_is_near(spark):
    names = [f"n{i:03}" for i in range(400)]
    edges = sorted({(s, t, "A") for s, t, _ in _random_edges(4, names, 1500)})
    graph = g.topic_graph(labelled(spark, edges))
    exact = _scores(paths.closeness(graph), "closeness")
    for lg_k, error in ((6, 0.13), (10, 0.0325)):
        got = _scores(sketches.closeness_sketched(graph, lg_k=lg_k), "closeness")
        apart = [abs(got[k] / v - 1) for k, v in exact.items() if v]
        # A ratio of two counts of one sketch; three standard errors for nearly all.
        assert sum(x <= 3 * error for x in apart) >= 0.97 * len(apart)
        assert all((got[k] == 0) == (v == 0) for k, v in exact.items())


def test_intervals_cover_the_exact_betweenness(spark):
    """What a seed draws is weighed as the query does, for many seeds and two levels."""
    edges = sorted({(s, t, "A") for s, t, _ in _random_edges(9, [f"n{i:02}" for i in range(60)], 220)})
    nodes = sorted({v for e in edges for v in e[:2]})
    graph = g.topic_graph(labelled(spark, edges))
    names = {r.key: r.id for r in graph.degrees.collect()}
    alone = {v: brute_force.betweenness(edges, "A", nodes, sources=[v]) for v in nodes}
    exact = brute_force.betweenness(edges, "A", nodes)
    covered = {1.96: [], 4.0: []}
    for seed in range(25):
        drawn = [(names[r.key], r.weight) for r in paths.sample_sources(graph, 0.5, seed).collect()]
        for v in nodes:
            near = sum(w * alone[s][v] for s, w in drawn)
            apart = sum((1 - 1 / w) * (w * alone[s][v]) ** 2 for s, w in drawn) ** 0.5
            if exact[v] > 20:
                for level, found in covered.items():
                    found.append(abs(near - exact[v]) <= level * apart)
        if seed == 3:
            got = {r.id: r for r in paths.betweenness_estimated(graph, 0.5, seed).collect()}
            for v in nodes:
                near = sum(w * alone[s][v] for s, w in drawn)
                apart = sum((1 - 1 / w) * (w * alone[s][v]) ** 2 for s, w in drawn) ** 0.5
                assert (got[v].betweenness, got[v].std_error) == pytest.approx((near, apart))
    # What the docstring of ``betweenness_within`` says of skewed sums.
    assert 0.75 < sum(covered[1.96]) / len(covered[1.96]) < 0.95
    assert sum(covered[4.0]) / len(covered[4.0]) > 0.87


def test_sources_are_added_until_the_error_holds(spark):
    edges = _random_edges(9, [f"n{i:02}" for i in range(30)], 90)
    graph = g.topic_graph(labelled(spark, edges))
    nodes = sorted({v for e in edges for v in e[:2]})
    for error in (0.0, 0.4):
        found = paths.betweenness_within(graph, error, share=0.3).collect()
        for topic in graph.topics:
            own = [r for r in found if r.Category == topic]
            most = max(r.betweenness for r in own)
            assert all(4 * r.std_error <= error * most + 1e-9 for r in own)
            assert all(r.low <= r.betweenness <= r.high for r in own)
            if not error:
                expected = brute_force.betweenness(edges, topic, nodes)
                assert {r.id: r.betweenness for r in own} == pytest.approx(expected)
    with pytest.raises(ValueError):
        paths.betweenness_within(graph, -1)


def _tree(seed, size, both=0.3):
    """A random tree whose edges go down, up or both ways."""
    draw = random.Random(seed)
    edges = []
    for k in range(1, size):
        pair = (f"t{draw.randrange(k):02}", f"t{k:02}")
        way = draw.random()
        edges += [pair] if way > both else []
        edges += [pair[::-1]] if way < 0.6 else []
    return [(s, t, "A") for s, t in edges]


def _stars(seed):
    """Senders and receivers with equal neighbours around a small random graph, with trees."""
    draw = random.Random(seed)
    core = [f"c{k}" for k in range(7)]
    edges = {(s, t) for s in core for t in core if s != t and draw.random() < 0.3}
    for k in range(12):
        ends = draw.choice([core[:2], core[2:5], core[4:6]])
        edges |= {(f"s{k}", c) for c in ends} if k % 2 else {(c, f"r{k}") for c in ends}
    edges |= {("x1", "s1"), ("s3", "x2"), ("x2", "s3"), ("r0", "x3"), ("x3", "x4"), ("c1", "c1"), ("i", "j"), ("j", "i")}
    return sorted((s, t, "A") for s, t in edges)


REDUCIBLE = {
    "tree": _tree(1, 40),
    "another tree": _tree(7, 30, both=0.6),
    "path": [(f"p{k:02}", f"p{k + 1:02}", "A") for k in range(20)],
    "star": [("hub", f"l{k}", "A") for k in range(9)] + [(f"m{k}", "hub", "A") for k in range(5)],
    "stars": _stars(2),
    "more stars": _stars(5),
    "loops": [("a", "a", "A"), ("a", "b", "A"), ("c", "c", "B")],
}


@pytest.mark.parametrize("rounds", [30, 1])
@pytest.mark.parametrize("name", list(REDUCIBLE))
def test_betweenness_on_the_reduced_graph(spark, name, rounds):
    edges = REDUCIBLE[name]
    graph = g.topic_graph(labelled(spark, edges))
    got = _scores(paths.betweenness_reduced(graph, rounds=rounds), "betweenness")
    nodes = {v for e in edges for v in e[:2]}
    for topic in graph.topics:
        expected = brute_force.betweenness(edges, topic, nodes)
        assert {v: got[topic, v] for v in nodes} == pytest.approx(expected), topic


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_betweenness_on_reduced_random_graphs(spark, seed):
    draw = random.Random(seed)
    names = [f"n{i:02}" for i in range(24)]
    edges = sorted({(draw.choice(names), draw.choice(names), draw.choice("AAB")) for _ in range(30)})
    graph = g.topic_graph(labelled(spark, edges).repartition(seed), 2 if seed == 6 else 1_000_000)
    most = 40 if seed == 5 else paths.MAX_VISITS
    got = _scores(paths.betweenness_reduced(graph, most), "betweenness")
    nodes = {v for e in edges for v in e[:2]}
    for topic in graph.topics:
        expected = brute_force.betweenness(edges, topic, nodes)
        assert {v: got[topic, v] for v in nodes} == pytest.approx(expected), topic


def test_reduction_leaves_few_nodes_to_search(spark):
    stages = Stages(spark)
    star = g.topic_graph(labelled(spark, REDUCIBLE["star"]))
    assert reduction.reduce_graph(star, stages).edges.count() == 0
    graph = g.topic_graph(labelled(spark, REDUCIBLE["stars"]))
    reduced = reduction.smaller_graph(reduction.reduce_graph(graph, stages), graph.heavy_rows)
    assert reduced.degrees.count() <= 7 + 6
    stages.release()


def _random_edges(seed, nodes, count):
    pick = random.Random(seed)
    found = set()
    while len(found) < count:
        s, t = pick.choice(nodes), pick.choice(nodes)
        # One node in a third of all edges, and a topic of its own for a few of them.
        s = nodes[0] if pick.random() < 0.34 else s
        found.add((s, t, pick.choice(["A", "A", "B.c"])))
    return sorted(found)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_measures_match_brute_force(spark, seed):
    names = [f"n{i}" for i in range(14)]
    edges = _random_edges(seed, names, 34)
    nodes = sorted({v for e in edges for v in e[:2]})
    frame = labelled(spark, edges).repartition(seed)
    # Seed 1 runs plainly, the others with split nodes, the last in batches as well.
    heavy_rows = 1_000_000 if seed == 1 else 2
    max_visits = 10**9 if seed < 3 else 250
    graph = g.topic_graph(frame, heavy_rows)
    rank = _scores(pagerank.pagerank(graph, rounds=12), "pagerank")
    near = _scores(paths.closeness(graph), "closeness")
    between = _scores(paths.betweenness(graph, max_visits=max_visits), "betweenness")
    degrees = _scores(g.degree(graph), "degree")
    for topic in graph.topics:
        def of(scores):
            return {v: scores[topic, v] for v in nodes}

        assert of(rank) == pytest.approx(brute_force.pagerank(edges, topic, nodes, 12))
        assert of(near) == pytest.approx(brute_force.closeness(edges, topic, nodes))
        assert of(between) == pytest.approx(brute_force.betweenness(edges, topic, nodes))
        assert sum(of(degrees).values()) == 2 * sum(c == topic for _, _, c in edges)
    if seed == 3:
        assert paths._Search(graph, max_visits, None).batches > 1
        assert paths._Search(graph, max_visits, None).split


def test_long_chain_and_settings_restored(spark):
    chain = [(f"v{i:02}", f"v{i + 1:02}", "A") for i in range(9)]
    graph = g.topic_graph(labelled(spark, chain))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    got = _scores(paths.betweenness(graph), "betweenness")
    assert [got["A", f"v{i:02}"] for i in range(10)] == [i * (9 - i) for i in range(10)]
    assert {k: spark.conf.get(k) for k in before} == before


def test_pagerank_can_stop_early(spark):
    graph = g.topic_graph(labelled(spark, [("a", "b", "A"), ("b", "a", "A")]))
    stopped = _scores(pagerank.pagerank(graph, tolerance=1e-3), "pagerank")
    assert stopped["A", "a"] == pytest.approx(1.0, abs=0.02)
    full = _scores(pagerank.pagerank(graph, rounds=60), "pagerank")
    assert full["A", "a"] == pytest.approx(1.0, abs=1e-4)


def test_only_self_references(spark):
    graph = g.topic_graph(labelled(spark, [("a", "a", "A")]))
    assert _scores(paths.closeness(graph), "closeness") == {("A", "a"): 0.0}
    assert _scores(paths.betweenness(graph), "betweenness") == {("A", "a"): 0.0}


def test_labelling(spark):
    pairs = spark.createDataFrame(
        [("u1", "u2"), ("u1", "u3"), ("u9", "u1")], "Source string, Target string"
    )
    topics = spark.createDataFrame(
        [("u1", ["A", "B"]), ("u2", ["A", "B", "C"]), ("u3", [])],
        "id string, userCategory array<string>",
    )
    assert {tuple(r) for r in labelling.label_edges(pairs, topics).collect()} == {
        ("u1", "u2", "A"),
        ("u1", "u2", "B"),
    }
    nodes = labelling.nodes(pairs)
    assert {r.id: r.userCategory for r in labelling.node_topics(nodes, topics).collect()} == {
        "u1": ["A", "B"],
        "u2": ["A", "B", "C"],
        "u3": [],
        "u9": None,
    }
    shared = labelling.with_shared_topics(pairs, topics)
    assert {(r.Source, r.Target): r.Categories for r in shared.collect()} == {
        ("u1", "u2"): ["A", "B"],
        ("u1", "u3"): [],
        ("u9", "u1"): None,
    }


def test_nothing_stays_cached(spark, m2):
    pagerank.pagerank_scores(m2, rounds=7)
    paths.path_scores(m2)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("topicpulse")]


def test_local_searches_are_the_shuffled_ones(spark, monkeypatch):
    ring = [(f"r{k}", f"r{(k + 1) % 5}", "A") for k in range(5)]
    fan = [(f"s{k}", f"r{(k * j) % 5}", "A") for k in range(9) for j in (1, 2)]
    edges = sorted({*ring, *fan, ("r0", "r3", "A"), ("r1", "r3", "A"), ("r4", "x", "A")})
    graph = g.topic_graph(labelled(spark, edges))
    nodes = sorted({v for e in edges for v in e[:2]})
    expected = brute_force.betweenness(edges, "A", nodes)
    found = []
    for most, local in ((paths.LOCAL_LINKS, True), (-1, False)):
        monkeypatch.setattr(paths, "LOCAL_LINKS", most)
        assert paths._Search(graph, 100, None).local == local
        rows = paths.path_scores(graph, "source").collect()
        found.append({r.id: (r.reached, r.distance) for r in rows if r.reached})
        between = {r.id: r.betweenness or 0.0 for r in rows}
        assert {v: between.get(v, 0.0) for v in nodes} == pytest.approx(expected)
    assert found[0] == found[1]


def test_searches_in_matrices_are_those_of_rows(spark, monkeypatch):
    """Sources in blocks, two topics that share nodes, a sample with weights, closeness at both ends."""
    draw = random.Random(5)
    core = {(f"r{draw.randrange(9)}", f"r{draw.randrange(12)}", t) for t in "AB" for _ in range(25)}
    fan = {(f"s{k:02}", f"r{draw.randrange(12)}", t) for t in "AB" for k in range(20) for _ in (1, 2)}
    edges = sorted(core | fan | {("r1", "r1", "A")})
    graph = g.topic_graph(labelled(spark, edges))
    sample = cut(paths.sample_sources(graph, 0.4))
    monkeypatch.setattr(dense, "SOURCES", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    found = []
    try:
        for most in (paths.LOCAL_NODES, 0):
            monkeypatch.setattr(paths, "LOCAL_NODES", most)
            assert paths._Search(graph, 10**6, None).dense == (most > 0)
            found.append(
                [
                    {(r.Category, r.id): r for r in paths.path_scores(graph, end, sample=s).collect()}
                    for end in ("node", "source")
                    for s in (None, sample)
                ]
            )
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for rows, expected in zip(*found):
        assert rows.keys() == expected.keys() and len(rows) > 15
        for at, row in rows.items():
            assert (row.reached, row.distance) == (expected[at].reached, expected[at].distance)
            for name in {"betweenness", "variance"} & set(row.asDict()):
                assert (row[name] or 0.0) == pytest.approx(expected[at][name] or 0.0)
    between = {at: r.betweenness or 0.0 for at, r in found[0][0].items()}
    nodes = sorted({v for e in edges if e[2] == "A" for v in e[:2]})
    exact = brute_force.betweenness(edges, "A", nodes)
    assert {v: between.get(("A", v), 0.0) for v in nodes} == pytest.approx(exact)


def test_local_searches_do_not_move(spark):
    """Neither levels nor visits of searches with few links to take are shuffled."""
    ring = [(f"r{k}", f"r{(k + 1) % 5}", "A") for k in range(5)]
    fan = [(f"s{k:03}", f"r{(k + j) % 5}", "A") for k in range(60) for j in (0, 2)]
    graph = g.topic_graph(labelled(spark, ring + fan))
    search = paths._Search(graph, paths.MAX_VISITS, None)
    with fixed_layout(spark, search.partitions, by_part_of_keys=True):
        link_table = search.link_table()
        levels = [cut(search.first_level(0))]
        level, steps = search.advance(levels, levels[0].count(), link_table, True)
        back = steps.join(search.ends(level), search.step_key).groupBy("source", "before").count()
        plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert link_table.count() == 5


def test_undirected_closeness_in_batches_of_wide_blocks(spark, monkeypatch):
    """Levels hand on few rows at a time, and the batches add up."""
    edges = [(f"n{i}", f"n{i + 1}", "A") for i in range(7)] + [("n2", "n9", "A"), ("x", "y", "A")]
    graph = g.topic_graph(labelled(spark, edges))
    searched = g.topic_graph(g.reversed_both_ways(graph.edges))
    taken, sums = [], paths._block_sums
    count = lambda *a: taken.append(a[-2:]) or sums(*a)
    monkeypatch.setattr(paths, "_block_sums", count)
    # A path of eight nodes with a branch, and a pair: 18 links both ways, one block.
    rows = paths.reach_sums(searched, wide=1, max_handed=9).collect()
    assert taken == [(0, 2), (1, 2)]
    got = {r.id: (r.reached, r.distance) for r in rows}
    assert got["n0"] == (8, 28 + 3) and got["n9"] == (8, 1 + 2 * 2 + 2 * 3 + 4 + 5 + 6)
    assert got["x"] == got["y"] == (1, 1)
