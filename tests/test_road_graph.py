from decimal import Decimal

import numpy as np

from viaduct.operators import road_graph, roads

SCHEMA = "id_arista long, nodo_a long, nodo_b long, metros double"


def by_walking(edges):
    """(nodo_a, nodo_b, metros, tramos) of the simplified graph, by following each chain."""
    at = {}
    for e, a, b, m in edges:
        at.setdefault(a, []).append((e, b, m))
        at.setdefault(b, []).append((e, a, m))
    bend = {n for n, out in at.items() if len(out) == 2 and len({x[1] for x in out} - {n}) == 2}
    done, result = set(), []
    for n in at:
        if n in bend:
            continue
        for e, head, m in at[n]:
            if e in done:
                continue
            done.add(e)
            length, steps = m, 1
            while head in bend:
                e, head, m = next(x for x in at[head] if x[0] != e)
                done.add(e)
                length, steps = length + m, steps + 1
            result.append((min(n, head), max(n, head), length, steps))
    return sorted(result + [(min(a, b), max(a, b), m, 1) for e, a, b, m in edges if e not in done])


def simplified(spark, edges):
    out, nodes, rounds = road_graph.simplify(spark.createDataFrame(edges, SCHEMA).repartition(4))
    rows = [tuple(r) for r in out.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    assert {r.nodo for r in nodes.collect()} == {n for r in rows for n in r[1:3]}
    return sorted((a, b, float(m), t) for _, a, b, m, t in rows), rounds


def test_shapes(spark):
    edges = [
        (1, 1, 2, 1.5), (2, 3, 2, 1.0), (3, 3, 4, 2.0), (4, 4, 5, 1.0), (5, 5, 5, 3.0), (6, 5, 6, 1.0), (7, 5, 7, 1.0), (8, 7, 8, 1.0), (9, 8, 5, 1.0),
        (10, 20, 21, 1.0), (11, 21, 22, 1.0), (12, 22, 20, 1.0), (13, 30, 31, 1.0), (14, 31, 30, 2.0), (15, 40, 41, 1.0), (16, 50, 50, 1.0),
    ]
    got, _ = simplified(spark, edges)
    assert got == by_walking(edges)
    assert (5, 5, 3.0, 3) in got and (1, 5, 5.5, 4) in got and (20, 21, 1.0, 1) in got and (30, 31, 2.0, 1) in got


def test_random_graphs(spark):
    random = np.random.default_rng(4)
    for nodes, count in ((30, 25), (200, 180), (50, 200)):
        edges = [(i, int(a), int(b), float(m)) for i, (a, b, m) in enumerate(random.integers(0, nodes, (count, 3)))]
        assert simplified(spark, edges)[0] == by_walking(edges)


def test_rounds_grow_with_the_logarithm(spark):
    chain = [(i, (i * 7919) % 5003, ((i + 1) * 7919) % 5003, 1.0) for i in range(5000)]
    got, rounds = simplified(spark, chain)
    assert got == [(min(0, (5000 * 7919) % 5003), (5000 * 7919) % 5003, 5000.0, 5000)] and rounds <= 14


def test_nulls_and_nothing(spark):
    assert simplified(spark, [(1, None, 2, 1.0), (2, 3, None, 1.0), (None, 4, 5, 1.0)])[0] == []
    assert simplified(spark, [])[0] == []


def test_edges_of_one_zone_and_statistics(spark):
    edges = spark.createDataFrame([(1, 1, 2, 1500.0), (2, 2, 3, 10.0), (3, 3, 4, 20.0), (4, 1, 9, 5.0)], SCHEMA)
    located = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 8), (9, None)], "id_nodo long, id_zona int")
    own = road_graph.within_zones(edges, located)
    assert {(r.id_arista, r.id_zona) for r in own.collect()} == {(1, 7), (3, 8)}
    areas = spark.createDataFrame([(7, 2.0), (8, 0.0)], "id_zona int, area double")
    got = {r.id_zona: (r.long_via_km, r.n_intersecciones, r.densidad_interseccion) for r in roads.graph_stats(own, areas).collect()}
    assert got == {7: (Decimal("1.50"), 2, 1.0), 8: (Decimal("0.02"), 2, None)}


def test_finished_rows_leave_the_rounds(spark, monkeypatch):
    """Edges without bends and chains at their end aren't carried through the rounds of the longest chain; numbers may be negative."""
    long = [(-i, i, i + 1, 1.0) for i in range(1, 401)]
    short = [(1000 + i, 10_000 + 3 * i, 10_001 + 3 * i, 2.0) for i in range(3000)]
    written, write = [], road_graph._written

    def counted(df):
        out = write(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(road_graph, "_written", counted)
    got, rounds = simplified(spark, long + short)
    assert got == by_walking(long + short) and 8 <= rounds <= 10
    assert sum(written) < 3 * len(long + short) + 2 * len(long) * rounds + 500
