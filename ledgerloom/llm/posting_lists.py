"""Approximate nearest neighbours (7): balanced posting lists behind an in-memory graph of centroids.

1. Equal vectors become one, with the smallest of their ids; no more are needed for a
   result of ``k`` and the query's own row.
2. Centroids are the means of a tree that halves a sample of at most ``SAMPLE`` vectors along
   its widest direction until a part holds its share, so lists are balanced. They are at
   most ``MOST_LISTS``, which bounds the broadcast graph: each centroid with its near
   ones, less those that another of them is nearer to.
3. Every vector goes to its nearest list and, where it lies at a border, to up to
   ``REPLICAS`` lists: those not much further than the nearest whose centroids are not nearer to
   a list already chosen.
4. A query's nearest centroids are found in the graph; it visits the lists within ``RATIO`` times the distance
   of the nearest, as many as ``PROBES`` or the share ``SHARE`` of all lists, whichever is more, so they follow the number of lists. A query
   that has found fewer than ``k`` then visits all lists. Lists are
   paged by a hash, and a task streams queries past one page of vectors at a time, so neither
   long lists nor many queries have to fit memory. Distances are exact, in double precision.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import staged

SAMPLE, MOST_LISTS, LIST_SIZE = 65_536, 8192, 128
NEIGHBOURS, POOL, SEEDS = 24, 96, 16
REPLICAS, SPREAD = 8, 1.15
RATIO, PROBES, SHARE = 1.6, 96, 0.0625
#: Centroids that a query's search holds, as a multiple of those it visits, and how many it expands at a time.
SLACK, WIDTH = 3, 8
#: Vectors of a list that are compared with a query at a time.
PAGE = 2048


def valid_vectors(df, vector="embedding", key="vec_id"):
    """(vec_id, vec) of vectors that are whole, finite and not zero, of the commonest length; equal rows once."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("vec_id"), v.alias("vec")).where(
        F.col("vec_id").isNotNull()
        & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (lengths["n"] if lengths else 0)), lengths["n"] if lengths else 0


def distinct_vectors(rows, k):
    """Each vector once: vid, vec and its k + 1 smallest ids."""
    first = Window.partitionBy("vec").orderBy("vec_id")
    return (
        rows.groupBy("vec", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("vid"), "vec", "ids")
    )


def centroids_of(sample, lists):
    """Means of the parts of a tree of halvings, about ``lists`` of them."""
    share = max(1, len(sample) / lists)
    parts, out = [np.arange(len(sample))], []
    while parts:
        part = parts.pop()
        if len(part) < 1.5 * share or len(part) < 2:
            out.append(sample[part].mean(0))
            continue
        x = sample[part] - sample[part].mean(0)
        way = x[np.argmax((x * x).sum(1))]
        for _ in range(8):
            way = x.T @ (x @ way)
            way /= max(np.linalg.norm(way), 1e-300)
        order = np.argsort(x @ way, kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return np.array(out)


def squared(a, b):
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


class Graph:
    """Centroids and for each its neighbours, searched by many queries at once."""

    def __init__(self, centroids):
        self.centroids = centroids
        n, most = len(centroids), min(NEIGHBOURS, len(centroids) - 1)
        self.links = np.full((n, max(1, NEIGHBOURS)), -1)
        for lo in range(0, n, 256):
            d = squared(centroids[lo : lo + 256], centroids)
            near = np.argsort(d, axis=1, kind="stable")[:, : 4 * most + 1]
            for i, (row, own) in enumerate(zip(near, np.take_along_axis(d, near, 1))):
                keep = []
                for c, dist in zip(row.tolist(), own.tolist()):
                    if c != lo + i and len(keep) < most:
                        gap = ((centroids[keep] - centroids[c]) ** 2).sum(1) if keep else np.zeros(0)
                        if len(keep) < most // 2 or (gap > dist).all():
                            keep.append(c)
                self.links[lo + i, : len(keep)] = keep
        self.seeds = np.unique(np.linspace(0, n - 1, SEEDS).astype(int))

    def search(self, x, pool=POOL, width=1):
        """For each vector its nearest centroids as found, nearest first (-1 where none), with distances.

        The ``width`` nearest centroids that are not expanded yet are expanded at a time, until the pool has none.
        """
        n = len(x)
        ids = np.tile(self.seeds, (n, 1))
        dist = squared(x, self.centroids[self.seeds])
        seen = np.zeros(ids.shape, bool)
        active = np.arange(n)
        out_ids, out_dist = np.full((n, pool), -1), np.full((n, pool), np.inf)
        while len(active):
            open_ = np.where(seen | (ids < 0), np.inf, dist)
            some = min(width, open_.shape[1])
            pick = np.argpartition(open_, some - 1, axis=1)[:, :some] if some > 1 else open_.argmin(1)[:, None]
            row = np.arange(len(active))[:, None]
            done = ~np.isfinite(open_[row, pick]).any(1)
            if done.any():
                w = ids.shape[1]
                out_ids[active[done], :w], out_dist[active[done], :w] = ids[done], dist[done]
                active, ids, dist, seen, pick = (a[~done] for a in (active, ids, dist, seen, pick))
                row = np.arange(len(active))[:, None]
                if not len(active):
                    break
            closed = seen[row, pick] | (ids[row, pick] < 0)
            seen[row, pick] = True
            new = np.where(closed[:, :, None], -1, self.links[ids[row, pick]]).reshape(len(active), -1)
            gap = self.centroids[new] - x[active][:, None, :]
            far = np.where(new < 0, np.inf, np.einsum("ijk,ijk->ij", gap, gap))
            ids, dist = np.concatenate([ids, new], 1), np.concatenate([dist, far], 1)
            seen = np.concatenate([seen, np.zeros(new.shape, bool)], 1)
            # one entry per centroid, the seen one if there is one
            order = np.lexsort([~seen, ids], axis=1)
            ids, dist, seen = (np.take_along_axis(a, order, 1) for a in (ids, dist, seen))
            dist[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
            order = np.argsort(dist, axis=1, kind="stable")[:, :pool]
            ids, dist, seen = (np.take_along_axis(a, order, 1) for a in (ids, dist, seen))
            ids = np.where(np.isfinite(dist), ids, -1)
        return out_ids, np.sqrt(out_dist)

    def border_lists(self, x):
        """Pairs (vector, list) for all lists that a vector is put in."""
        ids, dist = self.search(x, 4 * REPLICAS)
        near = (ids >= 0) & (dist <= SPREAD * dist[:, :1] + 1e-12)
        chosen = np.zeros(ids.shape, bool)
        chosen[:, 0] = True
        for j in range(1, ids.shape[1]):
            able = np.flatnonzero(near[:, j] & (chosen.sum(1) < REPLICAS))
            if not len(able):
                continue
            gap = self.centroids[ids[able]] - self.centroids[ids[able, j]][:, None, :]
            between = np.sqrt((gap * gap).sum(2))
            blocked = (chosen[able] & (between < 0.5 * dist[able, j][:, None])).any(1)
            chosen[able[~blocked], j] = True
        who, place = np.nonzero(chosen)
        return who, ids[who, place]

    def query_lists(self, x):
        """Pairs (vector, list) for the lists that a query visits: the nearest ones that the graph finds, pruned by distance ratio."""
        if not len(x):
            return np.zeros(0, int), np.zeros(0, int)
        probes = max(PROBES, int(np.ceil(SHARE * len(self.centroids))))
        pool = max(POOL, int(np.ceil(SLACK * probes)))
        who, lists = [], []
        for lo in range(0, len(x), 256):
            ids, dist = self.search(x[lo : lo + 256], pool, WIDTH)
            ids, dist = ids[:, :probes], dist[:, :probes]
            row, place = np.nonzero((ids >= 0) & (dist <= RATIO * dist[:, :1] + 1e-12))
            who.append(row + lo)
            lists.append(ids[row, place])
        return np.concatenate(who), np.concatenate(lists)

    def all_lists(self, x):
        n = len(self.centroids)
        return np.repeat(np.arange(len(x)), n), np.tile(np.arange(n), len(x))


def fit(vectors, dim):
    """A graph over the centroids of a sample chosen by a hash of the vectors."""
    count = vectors.count()
    step = max(1, -(-count // (SAMPLE * 9 // 10)))
    sample = vectors.where(F.pmod(F.xxhash64("vec"), F.lit(step)) == 0).limit(SAMPLE).select("vec").toArrow()["vec"]
    sample = sample.combine_chunks().flatten().to_numpy().reshape(-1, dim)
    if not len(sample):
        sample = np.array(vectors.limit(1).select("vec").first()[0])[None, :]
    # an order that does not depend on arrival
    sample = sample[np.lexsort(sample.T[::-1])]
    return Graph(centroids_of(sample, min(MOST_LISTS, max(1, count // LIST_SIZE))))


def matrix(column, dim):
    return column.flatten().to_numpy().reshape(-1, dim)


def _into_lists(frame, graph, dim, method):
    sent = frame.sparkSession.sparkContext.broadcast(graph)

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                who, lists = getattr(sent.value, method)(matrix(part.column("vec"), dim))
                who = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists, pa.int32()), part.column("vid").take(who), part.column("vec").take(who)],
                    names=["list", "vid", "vec"],
                )

    return frame.mapInArrow(work, "list int, vid long, vec array<double>")


def _scan(pages, dim, k):
    """The k + 1 nearest vectors of its page for each query; a page's vectors come before its queries."""

    def scan(batches):
        at, ids, held = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("list", "page", "kind", "vid")]
            vecs = matrix(batch.column("vec"), dim)
            change = np.ones(batch.num_rows, bool)
            change[1:] = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
            heads = np.append(np.flatnonzero(change), batch.num_rows).tolist()
            for lo, hi in zip(heads, heads[1:]):
                here = (cols[0][lo], cols[1][lo])
                if here != at:
                    at, ids, held = here, [], []
                if cols[2][lo] == 0:
                    ids.append(cols[3][lo:hi])
                    held.append(vecs[lo:hi])
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                step = max(1, (4 << 20) // held[0].size)
                for a in range(lo, hi, step):
                    q = vecs[a : min(hi, a + step)]
                    gap = q[:, None, :] - held[0][None, :, :]
                    score = np.sqrt((gap * gap).sum(2))
                    order = np.lexsort([np.broadcast_to(ids[0], score.shape), score], axis=1)[:, : k + 1]
                    n = order.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(cols[3][a : a + len(q)], n), pa.int64()),
                            pa.array(ids[0][order].ravel(), pa.int64()),
                            pa.array(np.take_along_axis(score, order, 1).ravel(), pa.float64()),
                        ],
                        names=["qid", "vid", "score"],
                    )

    return (
        pages.repartition("list", "page")
        .sortWithinPartitions("list", "page", "kind")
        .mapInArrow(scan, "qid long, vid long, score double")
    )


def nearest(df, queries, vector="embedding", key="vec_id", k=10):
    """The ``k`` nearest other rows found for each row that meets the condition ``queries`` (SQL on vec_id).

    query_id, rank, vec_id and score, the Euclidean distance; ties go to the smaller vec_id. Rows with
    a null key, or a vector that is null, zero, of another than the commonest length, or with null or
    non-finite components take no part; repeated rows count once; an empty table gives no rows; other
    columns do not matter. Equal vectors are found whole, since they are one vector here.
    """
    common.ship(df.sparkSession)
    rows, dim = valid_vectors(df, vector, key)
    if not dim:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = staged(rows, "vectors")
    vectors = staged(distinct_vectors(rows, k), "distinct-vectors")
    graph = fit(vectors, dim)
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    asked = staged(asked.join(vectors.select("vec", "vid"), "vec").select("query_id", "vid"), "asked")
    asking = vectors.join(asked.select("vid").distinct(), "vid", "left_semi")

    posted = staged(_into_lists(vectors, graph, dim, "border_lists"), "postings")
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PAGE).cast("int").alias("pages"))
    posted = posted.join(F.broadcast(sizes), "list").select(
        "list", F.pmod(F.xxhash64("vid"), F.col("pages")).cast("int").alias("page"), F.lit(0).alias("kind"), "vid", "vec"
    )

    def found_by(some, method):
        visits = _into_lists(some, graph, dim, method).join(F.broadcast(sizes), "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"), F.lit(1).alias("kind"), "vid", "vec"
        )
        found = _scan(posted.unionByName(visits), dim, k).groupBy("qid", "vid").agg(F.min("score").alias("score"))
        return staged(found.join(vectors.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id")), "near")

    with_ids = found_by(asking, "query_lists")
    enough = with_ids.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select(F.col("qid").alias("vid"))
    short = staged(asking.join(enough, "vid", "left_anti"), "short")
    if not short.isEmpty():
        with_ids = with_ids.join(enough, F.col("qid") == F.col("vid"), "left_semi").unionByName(found_by(short, "all_lists"))
    best = Window.partitionBy("qid").orderBy("score", "vec_id")
    lists = staged(
        with_ids.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
        .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found")),
        "found",
    )
    others = F.expr(f"slice(filter(found, f -> f.vec_id <> query_id), 1, {int(k)})")
    return (
        asked.join(lists, asked["vid"] == lists["qid"])
        .select("query_id", F.posexplode(others).alias("place", "f"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
    )
