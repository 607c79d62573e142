"""Lists that a query visits follow the number of lists; no query is left with fewer than k."""

import numpy as np

from ledgerloom.llm import posting_lists


def test_probes_follow_the_number_of_lists():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2100, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = posting_lists.Graph(x[:2048])
    who, lists = graph.query_lists(x[2048:])
    least = np.bincount(who).min()
    assert least >= posting_lists.SHARE * 2048 > posting_lists.PROBES
    dist = np.sqrt(posting_lists.squared(x[2048:], graph.centroids))
    for i in range(5):
        assert set(np.argsort(dist[i])[:100]) <= set(lists[who == i])


def test_queries_alone_in_their_list_find_k(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST_SIZE", 4)
    monkeypatch.setattr(posting_lists, "RATIO", 1.0)
    rng = np.random.default_rng(2)
    x = [(i, (rng.standard_normal(8) + 40 * (i % 9)).tolist()) for i in range(90)]
    got = posting_lists.nearest(spark.createDataFrame(x, "vec_id long, embedding array<double>"), "vec_id < 9").collect()
    for q in range(9):
        assert sum(r.query_id == q for r in got) == 10
