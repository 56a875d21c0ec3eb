"""Approximate nearest neighbours by inner product: an NN-descent graph, searched greedily.

Equal vectors are one node of the graph. Vectors get one more component that makes all norms equal, so that
neighbours by cosine serve the search for large inner products. The graph starts from blocks of nodes whose signs on
random directions agree. Each round then joins, at every node, its neighbours and the nodes it is a neighbour
of (neighbours of neighbours); nodes keep their best. Rounds end when few edges change. The work on the graph uses
vectors of one byte a component.

A search starts at the query's own node. Rounds expand the best nodes found that are not expanded yet, along edges
in both directions. The best nodes found are scored again on the original vectors in double precision, and become
rows: equal scores go to the smaller id. Every row with a usable vector is indexed; a recall of 0.9 and more against
brute force is tested.

Vectors that are null, zero, of another length than most or with null or non-finite components take no part, neither do
null ids. Rows that repeat an id with the same vector are one candidate.
An empty table gives no rows; columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duesight.llm.runs import starts_of, whole_runs
from duesight.llm.scratch import cut


@dataclass(frozen=True)
class Build:
    neighbours: int = 30
    #: Nodes of the blocks the graph starts from, the edges a node takes from each, and the number of divisions into
    #: blocks for each doubling of the nodes.
    block: int = 1024
    start_edges: int = 8
    starts: float = 3.5
    #: Edges of a node that take part in a round in each direction.
    new: int = 20
    old: int = 20
    rounds: int = 8
    few: float = 0.03  # share of new edges that ends the rounds


@dataclass(frozen=True)
class Search:
    beam: int = 100
    expand: int = 30
    rounds: int = 4
    rescored: int = 45


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` of the rows that take part."""
    vec = F.col(vec_col)
    given = rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.cast("array<double>").alias("vec"))
    fine = given.filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    sizes = fine.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return fine.filter(F.size("vec") == (sizes[0].n if sizes else 0))


def nodes_of(rows: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """``node, vec`` of the distinct vectors (named by their smallest id), and each node's ``members`` smallest ids."""
    # Two steps, so that a vector that very many rows share leaves few rows of each part.
    salted = Window.partitionBy("vec", "salt").orderBy("vec_id")
    some = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= members).drop("rank", "salt")
    own = Window.partitionBy("vec").orderBy("vec_id")
    ranked = some.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= members)
    listed = cut(ranked.groupBy("vec").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    return listed.select("node", "vec"), listed.select("node", "ids")


def _codes(largest: float):
    """Nodes with one byte for each component: ``code`` (the last is the added one) and its ``scale``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch.vec.to_list()).astype(np.float64)
                rest = np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1), 0))
                x = np.column_stack([x, rest]) / largest
                scale = np.abs(x).max(axis=1) / 127
                codes = np.rint(x / scale[:, None]).astype(np.int8)
                yield pd.DataFrame({"node": batch.node, "code": [c.tobytes() for c in codes], "scale": scale.astype(np.float32)})

    return run


def _matrix(codes: pd.Series, scales: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), dtype=np.int8).reshape(len(codes), -1)
    return raw.astype(np.float32) * scales.to_numpy(dtype=np.float32)[:, None]


EDGE = "v long, u long, score float, fresh boolean"


def _best_edges(k: int):
    """For rows sorted by v: the k best distinct edges of each; an edge that was there before is not fresh."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["v"]):
            frame = frame.sort_values(["v", "u", "fresh"]).drop_duplicates(["v", "u"])
            frame = frame.sort_values(["v", "score", "u"], ascending=[True, False, True])
            yield frame[frame.groupby("v").cumcount() < k][["v", "u", "score", "fresh"]]

    return run


def _keep_best(edges: DataFrame, k: int) -> DataFrame:
    return edges.repartition("v").sortWithinPartitions("v").mapInPandas(_best_edges(k), EDGE)


def _first_graph(nodes: DataFrame, build: Build, dims: int, number: int) -> DataFrame:
    """Edges inside blocks of nodes whose signs on random directions agree."""
    bits = max(1, int(np.ceil(np.log2(max(2, number / build.block)))) + 2)
    starts = int(np.ceil(build.starts * bits))
    taken = build.start_edges if number > build.block else build.neighbours  # a single block is the whole graph
    directions = np.random.default_rng(7).standard_normal((starts, bits, dims + 1)).astype(np.float32)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch.code, batch.scale)
                for t in range(starts):
                    signs = (x @ directions[t].T > 0) @ (1 << np.arange(bits))
                    yield batch.assign(start=t, signs=signs.astype(np.int64))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rest) >= 2 * build.block:
                yield _inside(rest.iloc[: build.block], taken)
                rest = rest.iloc[build.block :]
        if rest is not None and len(rest) > 1:
            yield _inside(rest, taken)

    parts = max(1, min(10_000, number * starts // (build.block * 16)))
    placed = nodes.mapInPandas(place, "node long, code binary, scale float, start int, signs long")
    blocks = placed.repartitionByRange(parts, "start", "signs", "node").sortWithinPartitions("start", "signs", "node")
    return _keep_best(blocks.mapInPandas(join, EDGE), build.neighbours)


def _inside(block: pd.DataFrame, k: int) -> pd.DataFrame:
    x, names = _matrix(block.code, block.scale), block.node.to_numpy()
    scores = x @ x.T
    scores[names[:, None] == names[None, :]] = -np.inf
    k = min(k, len(block) - 1)
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    found = pd.DataFrame({"v": np.repeat(names, k), "u": names[top.ravel()], "score": np.take_along_axis(scores, top, 1).ravel(), "fresh": True})
    return found[np.isfinite(found.score)]


def _local_join():
    """At each pivot: scores of all pairs with a fresh member that beat what the member's list ends with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["pivot"]):
            cuts = starts_of(frame, ["pivot"])
            x, names = _matrix(frame.code, frame.scale), frame.node.to_numpy()
            worst, fresh = frame.worst.to_numpy(), frame.fresh.to_numpy()
            vs, us, ss = [], [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a < 2 or not fresh[a:b].any():
                    continue
                scores = x[a:b] @ x[a:b].T
                ok = scores > worst[a:b, None]
                ok &= fresh[a:b, None] | fresh[None, a:b]
                ok &= names[a:b, None] != names[None, a:b]
                i, j = np.nonzero(ok)
                vs.append(names[a + i])
                us.append(names[a + j])
                ss.append(scores[i, j])
            if vs:
                yield pd.DataFrame({"v": np.concatenate(vs), "u": np.concatenate(us), "score": np.concatenate(ss), "fresh": True})

    return run


def _round(edges: DataFrame, nodes: DataFrame, build: Build) -> DataFrame:
    """One round of neighbours of neighbours over the graph ``edges``."""
    both = edges.select(F.col("v").alias("pivot"), F.col("u").alias("node"), "fresh", F.lit(True).alias("out")).union(
        edges.select(F.col("u").alias("pivot"), F.col("v").alias("node"), "fresh", F.lit(False).alias("out"))
    )
    # Those of a node's edges that take part, drawn by a hash.
    order = Window.partitionBy("pivot", "fresh", "out").orderBy(F.xxhash64("pivot", "node"))
    some = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.when(F.col("fresh"), build.new).otherwise(build.old))
    drawn = some.groupBy("pivot", "node").agg(F.max("fresh").alias("fresh"))
    worst = edges.groupBy("v").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n")).select(
        F.col("v").alias("node"), F.when(F.col("n") < build.neighbours, float("-inf")).otherwise(F.col("worst")).cast("float").alias("worst")
    )
    known = nodes.join(worst, "node")
    attached = drawn.join(known, "node").select("pivot", "node", "code", "scale", "worst", "fresh")
    found = attached.repartition("pivot").sortWithinPartitions("pivot").mapInPandas(_local_join(), EDGE)
    # An edge that was drawn as fresh has met all it will meet through it.
    met = edges.join(drawn.filter("fresh").select(F.col("pivot").alias("v"), F.col("node").alias("u"), F.lit(True).alias("met")), ["v", "u"], "left")
    kept = met.select("v", "u", "score", (F.col("fresh") & F.col("met").isNull()).alias("fresh"))
    return _keep_best(kept.union(found.select("v", "u", "score", "fresh")), build.neighbours)


def graph(nodes: DataFrame, dims: int, number: int, build: Build) -> DataFrame:
    """``v, u, score``: each node's best neighbours found."""
    edges = cut(_first_graph(nodes, build, dims, number), "edges")
    for _ in range(build.rounds if number > build.block else 0):
        edges = cut(_round(edges, nodes, build), "edges")
        n = edges.agg(F.count(F.lit(1)).alias("n"), F.count_if("fresh").alias("fresh")).first()
        if n.fresh <= build.few * n.n:
            break
    return edges


def _scored(search: Search):
    """For the rows of each query (its own first): score new nodes, keep the beam, mark what to expand."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["q"]):
            cuts = starts_of(frame, ["q"])
            out = []
            x = _matrix(frame.code, frame.scale)
            names, scores, state = frame.node.to_numpy(), frame.score.to_numpy().copy(), frame.state.to_numpy()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = a + int(np.flatnonzero(names[a:b] == frame.q.iat[a])[0])
                scores[a:b] = x[a:b, :-1] @ x[own, :-1]
                rows = pd.DataFrame({"q": frame.q.iat[a], "node": names[a:b], "score": scores[a:b], "state": state[a:b]})
                rows = rows.sort_values("state", ascending=False).drop_duplicates("node")  # an expanded node stays so
                rows = rows.sort_values(["score", "node"], ascending=[False, True])
                keep = (np.arange(len(rows)) < search.beam) | (rows.node == frame.q.iat[a]).to_numpy()
                rows = rows[keep]
                todo = np.flatnonzero(rows.state.to_numpy() == 0)[: search.expand]
                marks = rows.state.to_numpy().copy()
                marks[marks == 1] = 2
                marks[todo] = 1
                out.append(rows.assign(state=marks))
            yield pd.concat(out)

    return run


#: state: 0 not expanded, 1 to expand now, 2 expanded.
BEAM = "q long, node long, score float, state int"


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, how: Search) -> DataFrame:
    """``q, node``: the best nodes found for the nodes ``q``."""
    ways = cut(edges.select("v", "u").union(edges.select("u", "v")).distinct(), "ways")
    own = queries.select("q", F.col("q").alias("node"), F.lit(1).alias("state"))
    beam = own
    for _ in range(how.rounds + 1):
        near = beam.filter("state = 1").join(ways, F.col("node") == ways.v).select("q", F.col("u").alias("node"), F.lit(0).alias("state"))
        rows = beam.select("q", "node", "state").union(near).groupBy("q", "node").agg(F.max("state").alias("state"))
        coded = rows.join(nodes, "node").select("q", "node", "code", "scale", F.lit(0.0).cast("float").alias("score"), "state")
        beam = cut(coded.repartition("q").sortWithinPartitions("q").mapInPandas(_scored(how), BEAM), "beam")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    return beam.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= how.rescored).select("q", "node")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, build: Build = Build(), how: Search = Search(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found for each row of ``queries``, itself left out.

    ``queries`` are rows of the same table, with the same columns.
    """
    fine = cut(usable(rows, id_col, vec_col), "vectors")
    vectors, members = nodes_of(fine, k + 1)
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("top"), F.max(F.size("vec")).alias("dims")).first()
    dims, top = size.dims or 1, float(np.sqrt(size.top or 1.0))
    nodes = cut(vectors.mapInPandas(_codes(top), "node long, code binary, scale float"), "codes")
    edges = graph(nodes, dims, size.n, build)
    asked = cut(usable(queries, id_col, vec_col).distinct().join(vectors, "vec").select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")), "asked")
    found = search(asked.select("q").distinct(), nodes, edges, how)

    # Original vectors, in double precision, added up from the left.
    pairs = found.join(vectors, "node").withColumnRenamed("vec", "vec_u").join(vectors.select(F.col("node").alias("q"), F.col("vec").alias("vec_q")), "q")
    product = F.aggregate(F.zip_with("vec_u", "vec_q", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = pairs.select("q", "node", product.alias("score"))
    rows_found = scored.join(members, "node").select("q", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = (
        rows_found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    )
    others = asked.join(lists, "q").select("query_id", F.filter("found", lambda x: x["vec_id"] != F.col("query_id")).alias("found"))
    each = others.select("query_id", F.posexplode(F.slice("found", 1, k)).alias("at", "one"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score")
