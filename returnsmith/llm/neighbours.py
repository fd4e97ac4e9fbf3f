"""Nearest neighbours by inner product: a neighbour graph by NN-descent, searched greedily, both as Spark joins.

Equal vectors are one node that knows its smallest ids, so a group of copies of any size is one row. Inner products rank
as distances do once every vector has one more component that makes all norms equal; the graph is built on those, queries
have 0 there. A node's list starts with its nearest nodes in a few random blocks. In a round a node's neighbours in either
direction meet there and are compared (new ones with all, old ones with new ones only); pairs nearer than the worst of a list are
sent to it. A search keeps the best nodes seen by a query, and in a round joins those of them that were not expanded yet with the graph and
compares their neighbours, until all of its best are expanded. Blocks of nodes and of queries have a bounded size.

The graph is approximate; the tests measure its recall against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from returnsmith.session import settle

NEIGHBOURS = 20   # of a node's list
REVERSE = 20      # nodes that name a node, besides its own list, chosen by hash: part of the method, as a hub may be named by all
MEET_OWN = 14     # of its list, and of those that name it, that meet at a node in a round; new ones first, then by hash
MEET_NAMED = 10
BLOCK = 4096      # nodes of a block
STARTS = 3        # random blocks that a node is in at the start
MEETINGS = 512    # nodes whose neighbours are compared at a time
BEST = 128        # nodes a query keeps
ENTRIES = 16      # nodes where every search begins, besides the query's own
REQUESTS = 8192   # queries that ask a block at a time
SETTLED = 0.005   # a round that changes a smaller share of the lists is the last
ROUNDS = 12


def _valid(vectors: DataFrame, name: str, vector: str) -> DataFrame:
    """(id, v double array) of vectors that are not null, not zero and wholly finite."""
    v = vectors.select(F.col(name).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return v.filter("v is not null and exists(v, x -> x <> 0) and forall(v, x -> coalesce(abs(x) < double('infinity'), false))")


def _nodes(vectors: DataFrame, k: int) -> DataFrame:
    """(node, v, ids) of distinct vectors: the smallest id, and the k + 1 smallest ids of equal ones."""
    first = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= k + 1)
    return few.groupBy("v").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of vectors; shorter ones are filled with zeros."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values, kind))


LIST = "node bigint, half binary, near array<bigint>, score array<float>, fresh array<boolean>"


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of each owner the k best others, each once; one already listed (not fresh) wins over its repeats."""
    order = np.lexsort((fresh, other, owner))
    owner, other, score, fresh = (x[order] for x in (owner, other, score, fresh))
    once = np.append(True, (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])) if len(owner) else np.zeros(0, bool)
    owner, other, score, fresh = (x[once] for x in (owner, other, score, fresh))
    order = np.lexsort((other, -score, owner))
    owner, other, score, fresh = (x[order] for x in (owner, other, score, fresh))
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return tuple(x[place < k] for x in (owner, other, score, fresh))


def _list_table(owner: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, source: pa.Table) -> pa.Table:
    """Rows of ``LIST`` for all nodes of ``source`` (node, half), each once, those without neighbours too."""
    ids = source.column("node").to_numpy()
    nodes, first = np.unique(ids, return_index=True)
    sizes = np.bincount(np.searchsorted(nodes, owner), minlength=len(nodes))
    return pa.table({"node": nodes, "half": source.column("half").take(pa.array(first)), "near": _lists(other, sizes, pa.int64()),
                     "score": _lists(score.astype(np.float32), sizes, pa.float32()), "fresh": _lists(fresh, sizes, pa.bool_())})


def _block(column: str, blocks: int, salt: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(salt)), F.lit(blocks)).cast("int")


def _entries(lists: pa.Table) -> tuple[np.ndarray, ...]:
    """Rows of ``LIST`` as flat arrays: owner, other, score, fresh."""
    near, score, fresh = (lists.column(c).combine_chunks() for c in ("near", "score", "fresh"))
    owner = np.repeat(lists.column("node").to_numpy(), np.diff(near.offsets.to_numpy()))
    return owner, *(x.flatten().to_numpy(zero_copy_only=False) for x in (near, score, fresh))


def _few(members: DataFrame, most: int, salt: int) -> DataFrame:
    """Of (centre, node, fresh) at most so many a centre: fresh ones first, then by a hash that changes with the round."""
    order = Window.partitionBy("centre").orderBy(F.desc("fresh"), F.xxhash64("node", F.lit(salt)), "node")
    return members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def build_graph(points: DataFrame, count: int, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``LIST``: each node's k nearest found, of ``points`` (node, and bytes of equal norm: code of 32, half of 16 bits a number)."""
    blocks = max(1, -(-count // BLOCK))

    def start(table: pa.Table) -> pa.Table:
        """The nearest ones within a random block."""
        nodes = table.column("node").to_numpy()
        x = np.frombuffer(b"".join(table.column("code").to_pylist()), np.float32).reshape(len(nodes), -1)
        take = min(k, len(nodes) - 1)
        parts = []
        for low in range(0, len(nodes), 1024):
            s = x[low:low + 1024] @ x.T
            s[np.arange(len(s)), np.arange(low, low + len(s))] = -np.inf
            near = np.argpartition(-s, take - 1, axis=1)[:, :take] if take else np.zeros((len(s), 0), np.int64)
            parts.append((near, np.take_along_axis(s, near, 1)))
        near, score = (np.concatenate(p) for p in zip(*parts, strict=True))
        owner = np.repeat(nodes, take)
        rows = _best(owner, nodes[near.ravel()], score.ravel(), np.ones(len(owner), bool), k)
        return _list_table(*rows, table)

    def gather(table: pa.Table) -> pa.Table:
        return _list_table(*_best(*_entries(table), k), table)

    def compare(table: pa.Table) -> pa.Table:
        """Members that meet at a centre, where at least one is fresh there: pairs nearer than a list's worst."""
        table = table.sort_by("centre")
        centre, node = table.column("centre").to_numpy(), table.column("node").to_numpy()
        worst, fresh = table.column("worst").to_numpy(), table.column("fresh").to_numpy()
        x = np.frombuffer(b"".join(table.column("code").to_pylist()), np.float16).reshape(len(node), -1).astype(np.float32)
        begin = np.flatnonzero(np.append(True, centre[1:] != centre[:-1]))
        sizes = np.diff(np.append(begin, len(centre)))
        found: list[tuple] = []
        for size in np.unique(sizes).tolist():
            own = begin[sizes == size]
            for low in range(0, len(own), 256):
                at = own[low:low + 256, None] + np.arange(size)
                m = x[at]
                s = m @ m.transpose(0, 2, 1)
                good = (s > worst[at][:, :, None]) & (fresh[at][:, :, None] | fresh[at][:, None, :])
                good[:, np.arange(size), np.arange(size)] = False
                g, a, b = np.nonzero(good)
                found.append((node[at[g, a]], node[at[g, b]], s[g, a, b]))
        owner, other, score = (np.concatenate(p) for p in zip(*found, strict=True))
        owner, other, score, _ = _best(owner, other, score, np.ones(len(owner), bool), k)
        return pa.table({"node": owner, "other": other, "score": score})

    def merge(lists: pa.Table, news: pa.Table) -> pa.Table:
        owner, near, score, _ = _entries(lists)
        rows = [np.concatenate([x, news.column(c).to_numpy()]) for x, c in ((owner, "node"), (near, "other"), (score, "score"))]
        return _list_table(*_best(*rows, np.arange(len(rows[0])) >= len(owner), k), lists)

    lists = points.groupBy(_block("node", blocks, 0)).applyInArrow(start, LIST)
    if blocks > 1:
        for i in range(1, STARTS):
            lists = lists.unionByName(points.groupBy(_block("node", blocks, i)).applyInArrow(start, LIST))
        lists = lists.groupBy(_block("node", blocks, -1)).applyInArrow(gather, LIST)
    lists = settle(lists, "graph")
    groups = max(1, -(-count // MEETINGS))
    for i in range(rounds if blocks > 1 else 0):
        # all that is settled about a centre follows from one shuffle by it
        edges = lists.selectExpr("node", "explode(arrays_zip(near, fresh)) as e").selectExpr("node", "e.near", "e.fresh")
        members = edges.selectExpr("node as centre", "near as node", "fresh", "true as own").unionByName(
            edges.selectExpr("near as centre", "node", "fresh", "false as own"))
        order = Window.partitionBy("centre", "own").orderBy(F.desc("fresh"), F.xxhash64("node", F.lit(i)), "node")
        members = members.repartition("centre").withColumn("place", F.row_number().over(order)).filter(
            F.col("place") <= F.when(F.col("own"), MEET_OWN).otherwise(MEET_NAMED))
        members = members.groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
        members = members.withColumn("any", F.max("fresh").over(Window.partitionBy("centre"))).filter("any")
        side = lists.select("node", F.col("half").alias("code"), F.when(F.size("score") < k, F.lit(float("-inf"))).otherwise(
            F.array_min("score")).alias("worst"))
        told = members.join(side, "node").select(_block("centre", groups, -2).alias("group"), "centre", "node", "worst", "fresh", "code")
        news = told.groupBy("group").applyInArrow(compare, "node bigint, other bigint, score float")
        lists = settle(lists.groupBy(_block("node", blocks, -1)).cogroup(news.groupBy(_block("node", blocks, -1)))
                       .applyInArrow(merge, LIST), "graph")
        changed = lists.agg(F.sum(F.expr("size(filter(fresh, x -> x))"))).first()[0] or 0
        if changed <= SETTLED * count * k:
            break
    return lists


def _points(nodes: DataFrame, width: int, longest: float) -> DataFrame:
    """(node, code, half): vectors with the component that makes all norms equal, as bytes of 32 and 16 bits a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(pa.chunked_array([batch.column("v")]), width)
            rest = np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0))
            x = np.column_stack([v, rest]) / np.sqrt(longest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), *(pa.array([r.tobytes() for r in x.astype(t)], pa.binary()) for t in (np.float32, np.float16))],
                names=["node", "code", "half"])

    return nodes.select("node", "v").mapInArrow(run, "node bigint, code binary, half binary")


def _scored(asked: DataFrame, state: DataFrame, nodes: DataFrame, count: int, width: int, queries: int) -> DataFrame:
    """(q, node, score) of asked (q, node) not in the query's pool: inner products in double precision, block by block of nodes.

    ``state`` has q, its vector qv and its pool, an array of nodes.
    """
    blocks = max(1, -(-count // BLOCK))

    def products(requests: pa.Table, block: pa.Table) -> pa.Table:
        if not requests.num_rows or not block.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = block.column("node").to_numpy()
        order = np.argsort(ids)
        x, y = _matrix(block.column("v"), width)[order], _matrix(requests.column("qv"), width)
        near = requests.column("asked").combine_chunks()
        row = np.repeat(np.arange(requests.num_rows), np.diff(near.offsets.to_numpy()))
        node = near.flatten().to_numpy()
        at = np.searchsorted(ids[order], node)
        score = np.concatenate([np.einsum("ij,ij->i", x[at[i:i + 65536]], y[row[i:i + 65536]]) for i in range(0, len(at), 65536)])
        return pa.table({"q": requests.column("q").to_numpy()[row], "node": node, "score": score})

    block = _block("node", blocks, -3)
    asked = asked.groupBy("q", block.alias("block")).agg(F.collect_set("node").alias("asked"))
    asked = asked.join(state, "q").select("q", "block", "qv", F.array_except("asked", "pool").alias("asked")).filter("size(asked) > 0")
    schema = "q bigint, node bigint, score double"
    if queries <= REQUESTS:
        parts = nodes.select(block.alias("part"), "node", "v")
        return asked.groupBy("block").cogroup(parts.groupBy("part")).applyInArrow(products, schema)
    # nodes that very many queries reach: their block is read by several tasks, each with some of the queries
    asked = settle(asked, "asked")
    slices = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / REQUESTS).alias("slices"))
    dealt = asked.join(slices, "block").withColumn("slice", F.pmod(F.xxhash64("q"), "slices")).drop("slices")
    parts = nodes.select("node", "v", block.alias("block")).join(slices, "block").selectExpr(
        "block as part", "explode(sequence(0, slices - 1)) as copy", "node", "v")
    return dealt.groupBy("block", "slice").cogroup(parts.groupBy("part", "copy")).applyInArrow(products, schema)


def _entered(queries: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(q, node, score) of the nodes where searches begin: a few that all queries share, and the query's own."""
    few = nodes.select(F.struct(F.xxhash64("node").alias("h"), "node", "v").alias("e")).orderBy("e").limit(ENTRIES).select("e.*").collect()
    entries = [(r["node"], r["v"]) for r in few]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, q = _matrix(pa.chunked_array([batch.column("v")]), width), batch.column("q").to_numpy()
            own = batch.column("own")
            there = own.is_valid().to_numpy(zero_copy_only=False)
            at = own.fill_null(-1).to_numpy()
            rows = [(q[there], at[there], np.einsum("ij,ij->i", y, y)[there])]
            for node, v in entries:
                x = np.zeros(width)
                x[:len(v)] = v
                other = ~there | (at != node)
                rows.append((q[other], np.full(other.sum(), node), np.einsum("ij,j->i", y, x)[other]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=["q", "node", "score"])

    return queries.select("q", "v", "own").mapInArrow(run, "q bigint, node bigint, score double")


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, count: int, width: int, best: int = BEST) -> DataFrame:
    """(q, node, score) of the best nodes found for each of queries (q, v, own: the node that equals it, or null)."""
    edges = graph.selectExpr("node", "explode(near) as near")
    named = _few(graph.selectExpr("explode(near) as centre", "node", "true as fresh"), REVERSE, 0)
    named = named.select(F.col("centre").alias("node"), F.col("node").alias("near"))
    both = settle(edges.unionByName(named).groupBy("node").agg(F.collect_set("near").alias("near")), "adjacent")
    many = queries.count()
    vectors = queries.select("q", F.col("v").alias("qv"))
    pool = _entered(queries, nodes, width).withColumn("done", F.lit(False))
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    while True:
        left = Observation()
        pool = pool.withColumn("i", F.row_number().over(ranked)).filter(F.col("i") <= best).drop("i")
        pool = settle(pool.observe(left, F.count_if(~F.col("done")).alias("n")), "pool")  # of the rows that are written
        if not left.get["n"]:
            return pool.select("q", "node", "score")
        state = pool.groupBy("q").agg(F.collect_list("node").alias("pool")).join(vectors, "q")
        reached = pool.filter("not done").select("q", "node").join(both, "node").selectExpr("q", "explode(near) as node")
        news = _scored(reached, state, nodes, count, width, many)
        pool = pool.withColumn("done", F.lit(True)).unionByName(news.withColumn("done", F.lit(False)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, best: int = BEST, name: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the largest inner product found for each row of ``queries``.

    Both have the columns ``name`` and ``vector``; a row is no candidate for a query of its id. Score is the inner product in
    double precision, rank starts at 1, ties go to the smaller id. Vectors that are null, zero, or hold a null or a non-finite
    component take no part; null ids neither. A shorter vector counts as filled with zeros. Repeated ids count once; of different
    vectors under one id the smallest counts. Where fewer than k candidates exist, all are given. Empty
    in, empty out.
    """
    valid = _valid(vectors, name, vector).filter("id is not null")
    nodes = settle(_nodes(valid.groupBy("id").agg(F.min("v").alias("v")), k), "nodes")
    facts = nodes.select(F.size("v").alias("n"), F.expr("aggregate(v, 0d, (s, x) -> s + x * x)").alias("norm")).agg(
        F.count(F.lit(1)), F.max("n"), F.max("norm")).first()
    asking = _valid(queries, name, vector).filter("id is not null").groupBy("id").agg(F.min("v").alias("v"))
    classes = settle(asking.groupBy("v").agg(F.min("id").alias("q")).join(
        nodes.select("v", F.col("node").alias("own")), "v", "left"), "queries")
    asked_width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    count, width, longest = facts[0], max(facts[1] or 1, asked_width), facts[2] or 1.0
    points = settle(_points(nodes, width, longest), "points")
    graph = build_graph(points, count, max(k, NEIGHBOURS))
    found = search(classes, graph, nodes, count, width, max(best, k + 1))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    told = (found.join(nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("vec_id"))
            .withColumn("i", F.row_number().over(order)).filter(F.col("i") <= k + 1))
    rows = asking.select("v", F.col("id").alias("query_id")).join(classes.select("v", "q"), "v")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (rows.select("query_id", "q").join(told, "q").filter("vec_id <> query_id").withColumn("rank", F.row_number().over(mine))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
