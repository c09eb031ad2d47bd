"""Approximate nearest neighbours by largest inner product: a small-world graph hierarchy per shard.

Vectors are dealt to bands of length, each from one power of two to the next, and within a band to shards of about
`SHARD` distinct vectors by a hash of the vector. Each shard gets a hierarchical navigable small-world graph, kept as
flat neighbour arrays, one table row per shard. Inner products become angles by one more coordinate that gives all
vectors of a shard the same length, so the graph is one of true neighbours; as no vector of a shard is twice as long as
another, that coordinate never drowns the rest. Queries go in blocks to every shard, which stays in one task and is
loaded once; each shard returns its best, scored in double precision, and the shards' results are merged. All vectors
are indexed; all rows take part. The index is shuffled once; queries, a part of the rows, once for each shard.

Equal vectors are one node that carries its smallest ids (one more than asked for, which is all that a result can
hold), so thousands of copies neither fill a shard nor cut the graph off.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null id; only
vectors of one dimension are compared. Rows equal in id count once, of different vectors under one id the smallest
counts. Products beyond the doubles are infinite, and those without a value come last. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import materialize, new_folder, table

SHARD, BLOCK = 4096, 2048
LINKS, LOWEST_LINKS, BUILD_WIDTH, SEARCH_WIDTH, EXPAND = 16, 32, 64, 128, 4
LANES = 512


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The best `width` nodes found for each query and their products, best first; -1 fills up.

    All queries walk in step: each expands its `EXPAND` best nodes not yet expanded, until none is left in its beam."""
    count, lanes = len(vectors), np.arange(len(queries))
    ids = np.full((len(queries), width), -1, np.int64)
    near = np.full((len(queries), width), -np.inf, np.float32)
    ids[:, 0], near[:, 0] = entry, np.einsum("bd,bd->b", vectors[entry], queries)
    open_ = np.zeros((len(queries), width), bool)
    open_[:, 0] = True
    seen = np.zeros((len(queries), count + 1), bool)
    seen[:, count] = True  # stands for "no node"
    seen[lanes, entry] = True
    active = lanes
    while len(active):
        rank = np.cumsum(open_[active], 1)
        pick = open_[active] & (rank <= EXPAND)
        row, place = np.nonzero(pick)
        open_[active[row], place] = False
        next_ = np.full((len(active), EXPAND, links.shape[1]), count, np.int64)
        next_[row, rank[row, place] - 1] = links[ids[active[row], place]]
        next_ = next_.reshape(len(active), -1)
        next_[next_ < 0] = count
        next_.sort(1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = count
        next_[seen[active[:, None], next_]] = count
        keep = int((next_ < count).sum(1).max(initial=0))
        if keep:
            next_ = np.sort(next_, 1)[:, :keep]
            seen[active[:, None], next_] = True
            real = next_ < count
            found = np.full(next_.shape, -np.inf, np.float32)
            at = np.nonzero(real)
            found[at] = np.einsum("xd,xd->x", vectors[next_[at]], queries[active[at[0]]])
            all_near = np.concatenate([near[active], found], 1)
            order = np.argsort(-all_near, 1, kind="stable")[:, :width]
            near[active] = np.take_along_axis(all_near, order, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(real, next_, -1)], 1), order, 1)
            open_[active] = np.take_along_axis(np.concatenate([open_[active], real], 1), order, 1)
        active = active[open_[active].any(1)]
    return ids, near


def diverse(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, -1: none) those nearer to the node than to one taken before,
    then the nearest of the rest, `most` in all."""
    if ids.shape[1] <= 1:
        return ids[:, :most]
    held = vectors[ids]
    between = held @ held.transpose(0, 2, 1)
    taken = np.zeros(ids.shape, bool)
    total = np.zeros(len(ids), np.int64)
    closest = np.full(ids.shape, -np.inf, np.float32)
    for place in range(ids.shape[1]):
        good = (ids[:, place] >= 0) & (near[:, place] > closest[:, place]) & (total < most)
        taken[:, place] = good
        total += good
        np.maximum(closest, between[:, place], out=closest, where=good[:, None])
    order = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), 1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1)


def connect(vectors: np.ndarray, nodes: np.ndarray, entry: np.ndarray, most: int) -> np.ndarray:
    """Neighbour array (all vectors, most) of one layer: `nodes` in order of insertion, `entry` where to start for each."""
    links = np.full((len(vectors), most), -1, np.int64)
    done = 1
    while done < len(nodes):
        block = nodes[done: done + min(max(done, 32), LANES)]
        ids, near = beam(vectors, links, vectors[block], entry[done: done + len(block)], BUILD_WIDTH)
        inner = vectors[block] @ vectors[block].T
        inner[np.triu_indices(len(block))] = -np.inf  # those before it in the block
        best = np.argsort(-inner, 1, kind="stable")[:, :most]
        more = np.take_along_axis(inner, best, 1)
        ids = np.concatenate([ids, np.where(np.isfinite(more), block[best], -1)], 1)
        near = np.concatenate([near, more], 1)
        order = np.argsort(-near, 1, kind="stable")[:, :BUILD_WIDTH]
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        own = diverse(vectors, ids, near, most)
        links[block, : own.shape[1]] = own
        source, target = np.repeat(block, own.shape[1]), own.ravel()
        source, target = source[target >= 0], target[target >= 0]
        touched = np.unique(target)
        old = links[touched]
        left, right = np.repeat(touched, most)[old.ravel() >= 0], old.ravel()[old.ravel() >= 0]
        left, right = np.concatenate([left, target]), np.concatenate([right, source])
        product = np.einsum("xd,xd->x", vectors[left], vectors[right])
        order = np.lexsort((right, -product, left))
        left, right, product = left[order], right[order], product[order]
        start = np.searchsorted(left, touched)
        rank = np.arange(len(left)) - start[np.searchsorted(touched, left)]
        width = min(BUILD_WIDTH + most, int(rank.max()) + 1)
        fits = rank < width
        row = np.searchsorted(touched, left[fits])
        some, close = np.full((len(touched), width), -1, np.int64), np.full((len(touched), width), -np.inf, np.float32)
        some[row, rank[fits]], close[row, rank[fits]] = right[fits], product[fits]
        full = (some >= 0).sum(1) > most
        links[touched[~full], : min(width, most)] = some[~full, :most]
        for part in np.array_split(np.flatnonzero(full), max(1, int(full.sum()) // LANES)):
            if len(part):
                links[touched[part]] = diverse(vectors, some[part], close[part], most)
        done += len(block)
    return links


class Graph:
    """Vectors of one length, a layer number for each, and one neighbour array per layer."""

    def __init__(self, vectors: np.ndarray, layers: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.layers, self.links = vectors, layers, links
        self.top = int(np.argmax(layers))

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Layers are drawn by a hash of the vector, so an index built again is the same."""
        drawn = np.array([int.from_bytes(hashlib.blake2b(v.tobytes(), digest_size=7).digest()) for v in vectors]) / 2.0**56
        layers = np.floor(-np.log(np.maximum(drawn, 1e-12)) / np.log(LINKS)).astype(np.int64)
        graph = cls(vectors, layers, [np.zeros((0, 0), np.int64)] * (int(layers.max()) + 1))
        order = np.lexsort((np.arange(len(vectors)), -layers))
        for layer in range(int(layers.max()), -1, -1):
            nodes = order[layers[order] >= layer]
            entry = graph.descend(vectors[nodes], layer)
            graph.links[layer] = connect(vectors, nodes, entry, LOWEST_LINKS if layer == 0 else LINKS)
        return graph

    def descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """The nearest node found in the layers above `layer`, from the top down."""
        entry = np.full(len(queries), self.top)
        for above in range(len(self.links) - 1, layer, -1):
            for start in range(0, len(queries), LANES):
                part = slice(start, start + LANES)
                entry[part] = beam(self.vectors, self.links[above], queries[part], entry[part], EXPAND)[0][:, 0]
        return entry

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        entry = self.descend(queries, 0)
        return np.concatenate([np.zeros((0, width), np.int64), *(
            beam(self.vectors, self.links[0], queries[s: s + LANES], entry[s: s + LANES], width)[0]
            for s in range(0, len(queries), LANES))])


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector over its largest entry, and that entry; their squares stay within the doubles."""
    most = np.abs(vectors).max(1, keepdims=True, initial=0)
    return vectors / np.where(most > 0, most, 1), most[:, 0]


def one_length(vectors: np.ndarray) -> np.ndarray:
    """Single precision, scaled to at most 1, with one more coordinate that makes every length 1."""
    part, most = directions(vectors)
    largest = most.max(initial=0)
    part *= (most / largest)[:, None]
    scaled = part / max(np.sqrt((part * part).sum(1)).max(initial=0), 1e-300)
    rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
    return np.ascontiguousarray(np.column_stack([scaled, rest]), np.float32)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and vec (array of double) of the rows that take part, one per id."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)).groupBy(
        "vec_id").agg(F.min("vec").alias("vec"))


def _band(vector: str) -> F.Column:
    """The power of two that a vector's length lies above."""
    most = F.array_max(F.transform(vector, F.abs))
    share = F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    return F.floor(F.log2(most) + F.log2(share) / 2).cast("int")


INDEX = "dim int, shard long, size long, vectors binary, ids binary, first binary, layers binary, links binary"


def build_index(vectors: DataFrame, nearest: int) -> DataFrame:
    """One row per shard from vec_id and vec: distinct vectors, their smallest ids, layers and flat neighbour arrays."""
    spark = vectors.sparkSession
    same = Window.partitionBy("vec").orderBy("vec_id")
    held = vectors.withColumn("place", F.row_number().over(same)).where(F.col("place") <= nearest + 1)
    held = materialize(held, "vectors")
    told = held.withColumn("dim", F.size("vec")).withColumn("band", _band("vec"))
    start: dict[int, int] = {}
    bands = []  # one for each power of two of a dimension, shards numbered on from band to band
    for row in told.where("place = 1").groupBy("dim", "band").agg(F.count("*").alias("n")).orderBy("dim", "band").collect():
        count = -(-row["n"] // SHARD)
        bands.append((row["dim"], row["band"], start.get(row["dim"], 0), count))
        start[row["dim"]] = start.get(row["dim"], 0) + count
    if not bands:
        return spark.createDataFrame([], INDEX)
    dealt = told.join(spark.createDataFrame(bands, "dim int, band int, start long, shards long"), ["dim", "band"]).withColumn(
        "shard", F.col("start") + F.pmod(F.xxhash64("vec"), F.col("shards")))

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        matrix = np.stack(rows["vec"].to_list()).astype(np.float64) + 0.0
        distinct, number = np.unique(matrix, axis=0, return_inverse=True)
        number = number.ravel()
        order = np.argsort(number, kind="stable")
        first = np.searchsorted(number[order], np.arange(len(distinct) + 1))
        graph = Graph.build(one_length(distinct))
        return pd.DataFrame([{
            "dim": rows["dim"].iat[0], "shard": rows["shard"].iat[0], "size": len(distinct), "vectors": distinct.tobytes(),
            "ids": rows["vec_id"].to_numpy(np.int64)[order].tobytes(), "first": first.astype(np.int64).tobytes(),
            "layers": graph.layers.astype(np.int8).tobytes(),
            "links": np.concatenate([links[graph.layers >= layer].ravel() for layer, links in enumerate(graph.links)]).astype(
                np.int32).tobytes(),
        }])

    return dealt.select("vec_id", "vec", "dim", "shard").groupBy("dim", "shard").applyInPandas(make, INDEX)


def load(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph, distinct vectors, their ids and where each one's ids begin, from an index row."""
    vectors = np.frombuffer(row["vectors"]).reshape(row["size"], row["dim"])
    layers = np.frombuffer(row["layers"], np.int8).astype(np.int64)
    flat, links, place = np.frombuffer(row["links"], np.int32), [], 0
    for layer in range(int(layers.max()) + 1):
        nodes = np.flatnonzero(layers >= layer)
        most = LOWEST_LINKS if layer == 0 else LINKS
        whole = np.full((len(layers), most), -1, np.int64)
        whole[nodes] = flat[place: place + len(nodes) * most].reshape(-1, most)
        links.append(whole)
        place += len(nodes) * most
    return Graph(one_length(vectors), layers, links), vectors, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["first"], np.int64)


def search(index: DataFrame, queries: DataFrame, nearest: int) -> DataFrame:
    """query_id, rank, vec_id and score of each query's nearest other rows; queries have vec_id and vec."""
    sizes = {row["dim"]: max(1, -(-row["n"] // BLOCK)) for row in queries.groupBy(F.size("vec").alias("dim")).agg(
        F.count("*").alias("n")).collect()}
    count = F.create_map(*(F.lit(x) for pair in (sizes or {0: 1}).items() for x in pair))
    dealt = queries.withColumn("dim", F.size("vec")).withColumn("block", F.pmod(F.xxhash64("vec_id"), count[F.col("dim")]))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"dim": rows["dim"].iat[0], "block": rows["block"].iat[0],
                              "asked": rows["vec_id"].to_numpy(np.int64).tobytes(),
                              "wanted": np.stack(rows["vec"].to_list()).astype(np.float64).tobytes()}])

    blocks = dealt.groupBy("dim", "block").applyInPandas(pack, "dim int, block long, asked binary, wanted binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(n, 1).to_pylist()[0] for n in range(batch.num_rows)):
                if row["asked"] is None:  # a shard; the blocks that ask it follow
                    graph, vectors, ids, first = load(row)
                    continue
                asked = np.frombuffer(row["asked"], np.int64)
                wanted = np.frombuffer(row["wanted"]).reshape(len(asked), row["dim"])
                part = directions(wanted)[0]
                part = part / np.sqrt((part * part).sum(1, keepdims=True))
                found = graph.search(np.column_stack([part, np.zeros(len(asked))]).astype(np.float32), max(SEARCH_WIDTH, 2 * nearest))
                best = []
                for query, vector, nodes in zip(asked, wanted, found, strict=True):
                    nodes = nodes[nodes >= 0]
                    with np.errstate(over="ignore", invalid="ignore"):
                        score = (vectors[nodes] * vector).sum(1)
                    score[np.isnan(score)] = -np.inf
                    order = np.argsort(-score, kind="stable")
                    edge = score[order[min(nearest, len(order) - 1)]]  # all that tie with the last one stay
                    nodes, score = nodes[order], score[order]
                    nodes, score = nodes[score >= edge], score[score >= edge]
                    pairs = [(-s, v) for n, s in zip(nodes.tolist(), score.tolist(), strict=True)
                             for v in ids[first[n]: first[n + 1]].tolist() if v != query]
                    best.append([{"low": a, "vec_id": b} for a, b in sorted(pairs)[:nearest]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked), pa.array(best, pa.list_(pa.struct([("low", pa.float64()), ("vec_id", pa.int64())])))],
                    names=["query_id", "best"])

    shards = {row["dim"]: row["n"] for row in index.groupBy("dim").agg((F.max("shard") + 1).alias("n")).collect()}
    most = F.create_map(*(F.lit(x) for pair in (shards or {-1: 0}).items() for x in pair))
    asking = blocks.where(F.col("dim").isin(list(shards))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), most[F.col("dim")].cast("long") - 1)))
    both = index.unionByName(asking, allowMissingColumns=True)
    dealt_out = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.asc_nulls_first("block"))
    found = dealt_out.mapInArrow(run, "query_id long, best array<struct<low:double,vec_id:long>>")
    merged = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, nearest).alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.low")).alias("score"))


def nearest_rows(rows: DataFrame, queries: DataFrame, nearest: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The `nearest` rows for each of the `queries` (rows of the same table), by largest inner product."""
    folder = new_folder(rows.sparkSession, "neighbours")
    index = materialize(build_index(usable(rows, key, vector), nearest), "index", folder)
    return search(index, usable(queries, key, vector), nearest)


def op3_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest_rows(rows, rows.where(F.col("vec_id") % 20 == 0), 20)
