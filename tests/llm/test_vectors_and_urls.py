"""Vector and URL operators against brute force and SQL."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftworks.llm import ann, cover_tree, graph, joins, queries, urls


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    b = rng.normal(size=(200, 8))
    rows = [(i, b[i].tolist()) for i in range(200)] + [(1000 + i, b[3].tolist()) for i in range(50)] + [(3000 + i, (b[i % 7] + rng.normal(size=8) * 0.12 * (i % 5)).tolist()) for i in range(500)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] * 8), (2080, []), (2100, [1.0, 2.0]), (2101, [1.0, 2.0])]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")


def good(x):
    return x is not None and len(x) > 0 and all(c is not None and np.isfinite(c) for c in x) and any(x)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(50)] + [(int(a), int(b)) for a, b in rng.integers(100, 200, (60, 2))] + [(7, 7), (None, 3)]
    parent = {i: i for e in edges for i in e if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {i for a, b in edges[:-1] if a != b for i in (a, b)}
    assert got == {i: find(i) for i in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_frequent_keys_are_joined_whole(spark, monkeypatch):
    rows = [("hot", i) for i in range(40)] + [(f"k{i % 7}", i) for i in range(20)] + [(None, 1), ("none", 2)]
    df = spark.createDataFrame(rows, "k string, i long")
    per_key = df.where("k is not null and k <> 'none'").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("m"))
    for least in (3, 20, 1000):
        monkeypatch.setattr(joins, "ROWS", least)
        for how in ("inner", "left"):
            want = df.join(per_key.drop("n"), "k", how)
            got = joins.hub_join(df, per_key, ["k"], "n", len(rows), how)
            assert sorted(map(str, got.select("k", "i", "m").collect())) == sorted(map(str, want.select("k", "i", "m").collect()))
    monkeypatch.setattr(joins, "ROWS", 5)
    star = spark.createDataFrame([(0, i) for i in range(1, 60)] + [(100, i) for i in range(101, 110)] + [(30, 100)], "a long, b long")
    assert {r.component for r in graph.components(star).collect()} == {0}


@pytest.mark.parametrize("settings", [{}, {"block_rows": 60, "cells": 20}])
def test_cover_tree(points, settings):
    p = points.toPandas()
    ok = [good(x) and len(x) == 8 for x in p.embedding]
    e = np.stack(p.embedding[ok].to_list()).astype(float)
    e /= np.linalg.norm(e, axis=1)[:, None]
    ids, hit = p.vec_id[ok].to_numpy(), e @ e.T >= 0.95
    np.fill_diagonal(hit, False)
    label = ids.copy()
    for _ in range(len(ids)):
        new = np.array([min(label[i], label[hit[i]].min(initial=label[i])) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    out = {r.vec_id: r for r in cover_tree.near_duplicates(points, **settings).collect()}
    assert len(out) == len(p)
    for i, n, c in zip(ids, hit.sum(1), label):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (n, c, i == c)
    assert [out[i].n_links for i in (2000, 2020, 2040, 2060, 2080, 2100)] == [0, 0, 0, 0, 0, 1]
    assert out[2101].component_id == 2100 and out[2020].kept
    assert cover_tree.near_duplicates(points.limit(0)).count() == 0


def planted(rng, n=1200, dim=64):
    """Unit vectors without clusters, groups of near copies around some, chains of links, scaled copies."""
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, 300, 3):
        x[k + 1] = x[k] + rng.normal(size=dim) * 0.03
    for k in range(400, 460):
        x[k] = x[400] + rng.normal(size=dim) * 0.015 * (k % 3)
    for k in range(501, 520):
        x[k] = x[k - 1] + rng.normal(size=dim) * 0.035
    x[600] = 3 * x[601]
    return x


def test_cover_tree_invariants():
    for x in (planted(np.random.default_rng(2), 700), np.random.default_rng(3).normal(size=(300, 2)), np.ones((5, 3)), np.ones((1, 3))):
        x = x / np.linalg.norm(x, axis=1)[:, None]
        t, n = cover_tree.build(x), len(x)
        y = x[t.order]
        d = cover_tree.distances(y, y)
        assert sorted(t.order) == list(range(n)) and t.parent[0] == 0 and t.level[0] == 0
        for i in range(1, n):
            p = t.parent[i]
            assert p < i < t.last[i] <= t.last[p] and t.level[p] < t.level[i]
            assert d[i, p] <= t.top / 2 ** (t.level[i] - 1) + 1e-7  # covering
        for k in range(1, int(t.level.max()) + 1):  # separation of the nested nets
            nodes = np.flatnonzero(t.level <= k)
            if t.top / 2**k >= 1e-7:
                off = d[np.ix_(nodes, nodes)][~np.eye(len(nodes), dtype=bool)]
                assert not len(off) or off.min() > t.top / 2**k - 1e-7
        assert all(d[i, i : t.last[i]].max() <= t.radius[i] + 1e-7 for i in range(n))


@pytest.mark.parametrize("settings", [{}, {"block_rows": 150, "cells": 40}])
def test_planted_links_in_64_dimensions(spark, settings):
    x = planted(np.random.default_rng(5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    assert 1000 < hit.sum() < 20_000
    label = np.arange(len(u))
    for _ in range(len(u)):
        label = np.array([min(label[i], label[hit[i]].min(initial=label[i])) for i in range(len(u))])
        if all(label[i] == label[j] for i, j in np.argwhere(hit)):
            break
    report = {}
    out = {r.vec_id: r for r in cover_tree.near_duplicates(df, report=report, **settings).collect()}
    assert all((out[i].n_links, out[i].component_id) == (hit[i].sum(), label[i]) for i in range(len(u)))
    distinct = len(np.unique(x, axis=0))
    assert report["pairs"] == distinct * (distinct - 1) // 2 and report["products"] > 0


def test_clusters_are_pruned(spark):
    """Tight clusters far apart: the trees leave few of all products."""
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(60, 16)), 40, 0) + rng.normal(size=(2400, 16)) * 0.02
    report = {}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = cover_tree.near_duplicates(df, block_rows=300, report=report).groupBy("component_id").count().collect()
    assert len(out) == 60 and report["products"] < 0.15 * report["pairs"]


def test_conflicting_and_repeated_vectors(spark):
    rows = [(1, [1.0, 0.0], 5), (1, [0.0, 1.0], 5), (2, [1.0, 0.0], 6), (2, [1.0, 0.0], 6), (3, [0.0, 2.0], 7), (None, [1.0, 0.0], 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, _id int")
    out = sorted(((r.vec_id or -1, r._id, r.n_links, r.component_id) for r in cover_tree.near_duplicates(df).collect()), key=str)
    assert out == sorted([(1, 5, 1, 1), (1, 5, 1, 1), (2, 6, 0, 2), (2, 6, 0, 2), (3, 7, 1, 1), (-1, 8, 0, None)], key=str)


def test_neighbours_of_all_embeddings(spark):
    """Recall against all rows; ties go to smaller ids, at the end of the list too."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    p = df.toPandas()
    e, ids = np.stack(p.embedding.to_list()).astype(float), p.vec_id.to_numpy()
    report = {}
    out = ann.nearest(df, F.col("vec_id") % 20 == 0, leaf_rows=64, report=report).toPandas()
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        s = (e * e[i]).sum(1)
        s[i] = -np.inf
        recall.append(len({*ids[np.lexsort((ids, -s))[:20]]} & {*out[out.query_id == ids[i]].vec_id}) / 20)
    assert np.mean(recall) >= 0.9 and 0 < report["rows"] <= 4 * len(ids)
    square = [(i, [1.0, float(i % 2), 0.5]) for i in range(60)] + [(100, [9.0, 0.0, 0.0])]
    got = ann.nearest(spark.createDataFrame(square + square[:3], "vec_id long, embedding array<double>"), F.col("vec_id") == 100, k=5).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [0, 1, 2, 3, 4]


def test_shared_queue_gives_out_all_leaves_in_order():
    rng = np.random.default_rng(9)
    forest = ann.grow(rng.normal(size=(400, 6)), 10.0, 5, 3)
    q = rng.normal(size=(20, 6))
    order = forest.search(q, forest.leaves)
    for row, x in zip(order, q):
        cost = {}
        for t in range(3):
            along = forest.directions[t] @ np.append(x, 0)
            for leaf in range(32):
                node, c = 0, 0.0
                for level in range(5):
                    bit = leaf >> (4 - level) & 1
                    over = along[level] - forest.split(np.array([t]), level, np.array([node]))[0]
                    c += over**2 if (over > 0) != bit else 0
                    node = 2 * node + bit
                cost[t * 32 + leaf] = c
        assert sorted(row.tolist()) == list(range(96)) and np.allclose([cost[k] for k in row.tolist()], sorted(cost.values()))
    deep = ann.grow(rng.normal(size=(50, 3)), 10.0, 12, 2)  # deeper than its sample can tell
    assert (np.unique(deep.place(rng.normal(size=(500, 3)))) < deep.leaves).all() and len(deep.splits) < 3


def test_neighbours(spark, points):
    eight = points.where("vec_id < 2100")
    p = eight.toPandas()
    p = p[[good(x) for x in p.embedding]]
    e, ids = np.stack(p.embedding.to_list()).astype(float), p.vec_id.to_numpy()
    for settings in ({}, {"leaf_rows": 16}):
        out = ann.nearest(eight, F.col("vec_id") % 20 == 0, **settings).toPandas()
        recall = []
        for i in np.flatnonzero(ids % 20 == 0):
            s = (e * e[i]).sum(1)
            exact = dict(zip(ids.tolist(), s.tolist()))
            s[i] = -np.inf
            want = ids[np.lexsort((ids, -s))[:20]]
            got = out[out.query_id == ids[i]].sort_values("rank")
            assert got["rank"].tolist() == list(range(1, 21)) and np.allclose(got.score, [exact[v] for v in got.vec_id], atol=1e-12)
            assert list(zip(-got.score, got.vec_id)) == sorted(zip(-got.score, got.vec_id))
            recall.append(len({*got.vec_id} & {*want}) / 20)
        assert np.mean(recall) >= 0.9
    assert ann.nearest(points.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 0


def compare(df, con):
    cols = ["page_id", "host", "path", "rule", "verdict", "score"]
    rows = lambda d: sorted(map(repr, d[cols].astype(object).where(d[cols].notna(), None).itertuples(index=False, name=None)))
    assert rows(df.toPandas()) == rows(con.sql(urls.oracle_sql()).df())


def test_urls_agree_with_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    compare(queries.op7_urls(spark, sf), con)
    odd = [(1, None), (2, ""), (3, "nope"), (4, "HTTP://WWW.Example.COM/en/7?x#y"), (5, "://com/en/"), (6, "a://b://c/d"), (7, "http://É.net/de/é^é\n?"), (7, "http://É.net/de/é^é\n?"), (8, "http://xcom/en/"), (9, "http://example.net/de/81"), (10, "http://example.net#/de/8"), (11, "x://" + "a" * 5000)]
    df = spark.createDataFrame([(*r, "taken", 1) for r in odd], "page_id long, url string, host string, score int")
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(odd, columns=["page_id", "url"]))
    out = urls.judge(df).withColumn("score", F.round("score", 9))
    compare(out, con)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got[4] == ("www.example.com", "/en/7", "example.com/en/7", "allow") and got[5] == ("com", "/en/", "com/en/", "block")
    assert got[9][2:] == ("example.net/de/8", "block") and got[1] == ("", "", None, "allow") and got[8][2] is None
    assert urls.judge(df.limit(0)).count() == 0
