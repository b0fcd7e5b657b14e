"""Graph embeddings as Spark jobs: spectral (truncated SVD) and translational / bilinear models.

Vectors live in DataFrames ``(node, vec)``. Only k-by-k matrices, never node-sized data, pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.functions import vectors
from riskgraph.functions.vectors import rounded
from riskgraph.operators.joins import lookup_join
from riskgraph.operators.lineage import cut
from riskgraph.operators.ranking import hash_first, hash_rank
from riskgraph.operators.triples import hr

OUTCOME = hr(f"indicator/{V.OUTCOME_INDICATOR}")
NODE_VEC = "node string, vec array<double>"
MARGIN, TIE = 1.0, 1e-9
TILE = 1024  # rows and columns of scores at a time
MOST_RELATIONS = 1 << 14
COLUMNS = ["place", "block", "vec", "squares", "weight"]


def held_out_nodes(graph: DataFrame, outcome: str = OUTCOME) -> DataFrame:
    """Measurements of the outcome indicator, kept out of training so that labels do not leak."""
    hit = (F.col("p") == hr("measuresIndicator")) & (F.col("o") == outcome) & (F.col("o_kind") == "iri")
    return graph.where(hit).select(F.col("s").alias("node")).distinct()


def iri_triples(graph: DataFrame, held_out: DataFrame) -> DataFrame:
    """IRI-to-IRI triples that touch no held-out node."""
    links = graph.where(F.col("o_kind") == "iri").select("s", "p", "o")
    without_subject = lookup_join(links, held_out.select(F.col("node").alias("s")), "s", "left_anti")
    kept = lookup_join(without_subject, held_out.select(F.col("node").alias("o")), "o", "left_anti")
    return kept.select("s", "p", "o")


def typed_edges(triples: DataFrame) -> DataFrame:
    """Each triple as two edges through a node of its predicate."""
    mark = F.concat("p", F.lit(V.PREDICATE_MARK))
    pair = F.array(
        F.struct(F.col("s").alias("left"), mark.alias("right")), F.struct(mark.alias("left"), F.col("o").alias("right"))
    )
    return triples.select(F.explode(pair).alias("e")).select("e.left", "e.right")


def normalised_adjacency(edges: DataFrame) -> DataFrame:
    """Entries ``(i, j, w)`` of (A + I) / sqrt(d_i d_j) for the symmetric 0/1 matrix A."""
    both = F.array(
        F.struct(F.col("left").alias("i"), F.col("right").alias("j")),
        F.struct(F.col("right").alias("i"), F.col("left").alias("j")),
    )
    links = edges.select(F.explode(both).alias("e")).select("e.i", "e.j").distinct().withColumn("a", F.lit(1.0))
    loops = links.select("i").distinct().select("i", F.col("i").alias("j"), F.lit(1.0).alias("a"))
    entries = links.unionByName(loops).groupBy("i", "j").agg(F.sum("a").alias("a"))
    degree = entries.groupBy("i").agg(F.greatest(F.sum("a"), F.lit(1.0)).alias("d"))
    left = degree.select("i", F.col("d").alias("di"))
    right = degree.select(F.col("i").alias("j"), F.col("d").alias("dj"))
    weighted = lookup_join(lookup_join(entries, left, "i"), right, "j")
    return weighted.select("i", "j", (F.col("a") / F.sqrt(F.col("di") * F.col("dj"))).alias("w"))


def _vector_sum(dim: int, weight: Column, vec: str = "vec") -> Column:
    return F.array(*[F.sum(weight * F.get(vec, F.lit(k))) for k in range(dim)])


def _apply(matrix: DataFrame, block: DataFrame, dim: int) -> DataFrame:
    """Matrix times block: one join on the column node and one partial/final sum on the row node."""
    columns = block.select(F.col("node").alias("j"), "vec")
    products = lookup_join(matrix, columns, "j")
    return products.groupBy(F.col("i").alias("node")).agg(_vector_sum(dim, F.col("w")).alias("vec"))


def _cross_product(block: DataFrame, other: str = "vec") -> np.ndarray:
    """``vec' other`` over all rows: partial products per batch, summed on Spark, k*k numbers to the driver."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                product = np.stack(batch["a"].to_numpy()).T @ np.stack(batch["b"].to_numpy())
                yield pd.DataFrame({"pos": np.arange(product.size), "x": product.ravel()})

    pairs = block.select(F.col("vec").alias("a"), F.col(other).alias("b"))
    sums = pairs.mapInPandas(partial, "pos int, x double").groupBy("pos").agg(F.sum("x").alias("x")).orderBy("pos")
    flat = np.array([r.x for r in sums.collect()])
    side = math.isqrt(flat.size)
    return flat.reshape(side, side)


def _times_small(block: DataFrame, small: np.ndarray) -> DataFrame:
    """Rotate every vector by a small dense matrix."""
    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"node": batch["node"], "vec": list(np.stack(batch["vec"].to_numpy()) @ small)})

    return block.select("node", "vec").mapInPandas(rotate, NODE_VEC)


def _triangle(block: DataFrame, fan_in: int = 32) -> np.ndarray:
    """R of the block's QR factors, by a tree: one R a partition, then one of every ``fan_in`` together, k rows each."""
    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = None
        for batch in batches:
            if len(batch):
                rows = np.stack(batch["vec"].to_numpy())
                r = np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")
        if r is not None:
            yield pd.DataFrame({"part": TaskContext.get().partitionId(), "pos": np.arange(len(r)), "r": list(r)})

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        r = np.linalg.qr(np.stack(group.sort_values(["part", "pos"])["r"].to_numpy()), mode="r")
        return pd.DataFrame({"part": group["part"].iat[0] // fan_in, "pos": np.arange(len(r)), "r": list(r)})

    schema = "part long, pos int, r array<double>"
    parts = cut(block.select("vec").mapInPandas(local, schema))
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        parts = cut(parts.groupBy(F.floor(F.col("part") / fan_in)).applyInPandas(joined, schema))
    return np.array([r.r for r in parts.orderBy("pos").collect()])


def _orthonormal(block: DataFrame) -> DataFrame:
    """Orthonormal columns by the triangular factor, whose condition is the block's and not its square; directions without
    weight become zero. A second pass takes off what rounding has left in the first."""
    for _ in range(2):
        block = cut(block)
        _, values, turned = np.linalg.svd(_triangle(block))
        strong = values > values.max() * 1e-13
        inverse = np.where(strong, 1.0 / np.where(strong, values, 1.0), 0.0)
        block = _times_small(block, turned.T[:, : len(values)] * inverse)
    return block


def svd_embedding(
    edges: DataFrame, dim: int = V.EMBEDDING_DIM, oversample: int = 10, iterations: int = 5, seed: int = V.SEED
) -> DataFrame:
    """Truncated SVD of the normalised adjacency, U times singular values, zero-padded to ``dim``.

    Randomised subspace iteration on the symmetric matrix, then a Rayleigh-Ritz step. Signs are fixed by the
    largest component of each dimension.
    """
    matrix = cut(normalised_adjacency(edges))
    nodes = matrix.select(F.col("i").alias("node")).distinct()
    if nodes.isEmpty():
        raise ValueError("no edges to embed")
    n = nodes.count()
    width = min(dim + oversample, n)
    kept = min(dim, max(1, n - 1))
    noise = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda k: F.xxhash64(F.col("node"), k, F.lit(seed)) / F.lit(float(2**63)),
    )
    basis = _orthonormal(_apply(matrix, nodes.select("node", noise.alias("vec")), width))
    for _ in range(iterations):
        basis = _orthonormal(_apply(matrix, basis, width))
    basis = cut(basis)
    image = _apply(matrix, basis, width).select("node", F.col("vec").alias("image"))
    values, vectors = np.linalg.eigh(_cross_product(basis.join(image, "node"), "image"))
    leading = np.argsort(-np.abs(values), kind="stable")[:kept]
    rotation = vectors[:, leading] * np.abs(values[leading])
    scores = cut(_times_small(basis, np.pad(rotation, ((0, 0), (0, dim - kept)))))
    peaks = [
        F.max(F.struct(F.abs(F.round(F.get("vec", F.lit(k)), 9)), "node", F.signum(F.get("vec", F.lit(k))).alias("sign")))
        .getField("sign").alias(f"s{k}") for k in range(dim)
    ]
    signs = [-1.0 if s is not None and s < 0 else 1.0 for s in scores.agg(*peaks).first()]
    return scores.select("node", F.array(*[F.get("vec", F.lit(k)) * s for k, s in enumerate(signs)]).alias("vec"))


def _initial_vectors(names: DataFrame, dim: int, seed: int, *carried: str) -> DataFrame:
    """Uniform start values within 6 / sqrt(dim), derived from the name alone."""
    bound = 6.0 / math.sqrt(dim) / 2.0
    start = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda k: F.xxhash64(F.col("node"), k, F.lit(seed)) / F.lit(float(2**63)) * bound,
    )
    return names.select("node", *carried, start.alias("vec"))


def _product(*arrays: Column) -> Column:
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x * y), arrays)


def _plus(a: Column, b: Column, sign: float = 1.0) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y * sign)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def _score(model: str, h: Column, r: Column, t: Column) -> Column:
    if model == "DistMult":
        return _total(_product(h, r, t))
    gap = _plus(_plus(h, r), t, -1.0)
    return -F.sqrt(_total(_product(gap, gap)))


def _contrasted(triples: DataFrame, params: DataFrame, entities: int, model: str, seed: int) -> DataFrame:
    """Each triple with a corrupted one: one end, by hash, is replaced by an entity drawn by hash from all of them."""
    draw = F.pmod(F.xxhash64("s", "p", "o", F.lit(seed)), F.lit(entities))
    side = F.pmod(F.xxhash64("s", "p", "o", F.lit(seed), F.lit("side")), F.lit(2)) == 0
    nodes = params.where("kind = 'entity'")
    rows = triples.select("s", "p", "o", draw.alias("place"), side.alias("swap"))
    rows = rows.join(nodes.select(F.col("node").alias("s"), F.col("vec").alias("h")), "s")
    rows = rows.join(params.where("kind = 'relation'").select(F.col("node").alias("p"), F.col("vec").alias("r")), "p")
    rows = rows.join(nodes.select(F.col("node").alias("o"), F.col("vec").alias("t")), "o")
    rows = rows.join(nodes.select("place", F.col("node").alias("fake"), F.col("vec").alias("f")), "place")
    rows = rows.withColumns({"nh": F.when(F.col("swap"), F.col("f")).otherwise(F.col("h")), "nt": F.when(F.col("swap"), F.col("t")).otherwise(F.col("f"))})
    good, bad = (_score(model, F.col(a), F.col("r"), F.col(b)) for a, b in (("h", "t"), ("nh", "nt")))
    return rows.withColumn("loss", F.greatest(F.lit(0.0), F.lit(MARGIN) - good + bad))


def _slopes(model: str, h: np.ndarray, r: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a batch and their derivatives by head, relation and tail."""
    if model == "DistMult":
        return (h * r * t).sum(1), r * t, h * t, h * r
    gap = h + r - t
    norm = np.sqrt(np.square(gap).sum(1))
    unit = gap / (norm + 1e-9)[:, None]
    return -norm, -unit, -unit, unit


def _descend(values: np.ndarray, squares: np.ndarray, rows: np.ndarray, slopes: np.ndarray, rate: float) -> np.ndarray:
    """One AdaGrad step of the rows that a batch has met, each with the sum of its slopes; returns them."""
    met, at = np.unique(rows, return_inverse=True)
    total = np.zeros((len(met), values.shape[1]))
    np.add.at(total, at, slopes)
    squares[met] += np.square(total)
    values[met] -= rate * total / (np.sqrt(squares[met]) + 1e-10)
    return met


def _visit(
    model: str, nodes: np.ndarray, node_squares: np.ndarray, relations: np.ndarray, relation_squares: np.ndarray, s: np.ndarray, p: np.ndarray, o: np.ndarray,
    heads: np.ndarray, tails: np.ndarray, passes: int, batch: int, rate: float, seed: list[int],
) -> None:
    """Mini-batches over the edges of one bucket, in place. Corrupted ends come from the bucket's own blocks.

    ``heads`` and ``tails``: for each edge the (first, size) range of rows that its head's and its tail's block has.
    """
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        order = rng.permutation(len(s))
        for lo in range(0, len(order), batch):
            e = order[lo : lo + batch]
            h, r, t = s[e], p[e], o[e]
            swap = rng.random(len(e)) < 0.5
            place = np.where(swap[:, None], heads[e], tails[e])
            fake = place[:, 0] + (rng.random(len(e)) * place[:, 1]).astype(np.int64)
            nh, nt = np.where(swap, fake, h), np.where(swap, t, fake)
            good, gh, gr, gt = _slopes(model, nodes[h], relations[r], nodes[t])
            bad, bh, br, bt = _slopes(model, nodes[nh], relations[r], nodes[nt])
            on = MARGIN - good + bad > 0
            if not on.any():
                continue
            rows = np.concatenate([h[on], t[on], nh[on], nt[on]])
            met = _descend(nodes, node_squares, rows, np.concatenate([-gh[on], -gt[on], bh[on], bt[on]]), rate)
            nodes[met] /= np.maximum(1.0, np.sqrt(np.square(nodes[met]).sum(1)))[:, None]
            _descend(relations, relation_squares, r[on], (br - gr)[on], rate)


def _turn_of(one: Column, other: Column, blocks: int) -> Column:
    """When two blocks meet: 0 for a block with itself, else the turn of a round robin, in which pairs are disjoint."""
    last = blocks - 1 + blocks % 2  # of an even number of players; with an odd number of blocks it is one that is not there
    if last < 1:
        return F.lit(0)
    with_last = F.when(one == last, other).when(other == last, one)
    return F.when(one == other, F.lit(0)).otherwise(1 + F.coalesce(2 * with_last, one + other) % last).cast("int")


def _pair_of(block: Column, turn: int, blocks: int) -> Column:
    """The smaller block of the pair that a block is in during a turn."""
    last = blocks - 1 + blocks % 2
    if turn == 0:
        return block
    partner = F.pmod(F.lit(turn - 1) - block, F.lit(last))
    # the player that would meet itself meets the last one
    half = [x for x in range(last) if 2 * x % last == (turn - 1) % last]
    partner = F.when(block == last, F.lit(half[0])).when(block == half[0], F.lit(last)).otherwise(partner)
    return F.when(partner >= blocks, block).otherwise(F.least(block, partner)).cast("int")


def _start(triples: DataFrame, dim: int, seed: int, blocks: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Initial entities (node, place from 0 in hash order, block, vec, squares), relations (node, place, vec), and the
    triples by numbers (s, p, o) with the blocks of their ends."""
    ends = triples.select(F.explode(F.array("s", "o")).alias("node")).distinct()
    numbers = cut(hash_rank(ends, [], F.col("node"), seed).select("node", (F.col("_rank") - 1).cast("long").alias("place")))
    entities = _initial_vectors(numbers, dim, seed, "place").select(
        "node", "place", F.pmod("place", F.lit(blocks)).cast("int").alias("block"), "vec", vectors.zeros(dim).alias("squares"))
    names = cut(triples.select(F.col("p").alias("node")).distinct())
    if (many := names.count()) > MOST_RELATIONS:
        raise ValueError(f"{many} predicates; up to {MOST_RELATIONS} are sent to the tasks")
    ordered = [r.node for r in names.orderBy("node").collect()]
    relations = _initial_vectors(triples.sparkSession.createDataFrame(list(enumerate(ordered)), "place long, node string"), dim, seed + 1, "place")
    edges = triples.join(numbers.select(F.col("node").alias("s"), F.col("place").alias("sn")), "s")
    edges = edges.join(numbers.select(F.col("node").alias("o"), F.col("place").alias("on")), "o")
    edges = edges.join(F.broadcast(relations.select(F.col("node").alias("p"), F.col("place").alias("pn"))), "p")
    ids = edges.select(F.col("sn").alias("s"), F.col("pn").alias("p"), F.col("on").alias("o"))
    return cut(entities), cut(relations), ids.withColumns({
        "i": F.pmod("s", F.lit(blocks)).cast("int"), "j": F.pmod("o", F.lit(blocks)).cast("int")})


def _mover(model: str, shared, blocks: int, passes: int, batch: int, rate: float, seed: tuple[int, int]):
    """The function of one turn: a pair's blocks and bucket to the moved blocks, and the moves of the relations met."""
    def move(key: tuple, held: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        own = held.sort_values(["block", "place"]).reset_index(drop=True)
        if not len(bucket):
            return own.assign(weight=0.0)[COLUMNS]
        nodes, node_squares = np.stack(own["vec"].to_numpy()), np.stack(own["squares"].to_numpy())
        relations, relation_squares = (x.copy() for x in shared.value)
        bucket = bucket.sort_values(["s", "p", "o"])
        first = own["block"].to_numpy()
        ranges = lambda b: np.stack([np.searchsorted(first, b), np.searchsorted(first, b, "right") - np.searchsorted(first, b)], axis=1)
        heads, tails, p = ranges(bucket["i"].to_numpy()), ranges(bucket["j"].to_numpy()), bucket["p"].to_numpy()
        s, o = heads[:, 0] + bucket["s"].to_numpy() // blocks, tails[:, 0] + bucket["o"].to_numpy() // blocks
        _visit(model, nodes, node_squares, relations, relation_squares, s, p, o, heads, tails, passes, batch, rate, [*seed, int(key[0])])
        met, weight = np.unique(p, return_counts=True)
        moves = pd.DataFrame({"place": met, "block": -1, "vec": list(relations[met] - shared.value[0][met]),
                              "squares": list(relation_squares[met] - shared.value[1][met]), "weight": weight.astype(float)})
        return pd.concat([own.assign(vec=list(nodes), squares=list(node_squares), weight=0.0)[COLUMNS], moves])

    return move


def train_translation_model(
    train: DataFrame, model: str = "DistMult", dim: int = V.EMBEDDING_DIM, rounds: int = 30, rate: float = 0.1, seed: int = V.SEED, batch: int = 256,
    least_updates: int = 400, block_rows: int = 1 << 16, bucket_edges: int = 1 << 20,
) -> tuple[DataFrame, DataFrame]:
    """Train TransE or DistMult on ``(s, p, o)`` by mini-batches; returns entity and relation vectors.

    Entities are dealt into blocks of at most ``block_rows`` by number, edges into buckets by the blocks of their ends. In a
    turn of a round robin every block is in one pair only, so a pair's task holds the only copy of its two blocks, takes
    the mini-batches of the pair's bucket one after the other, and gives the moved blocks back; nothing is averaged. The
    buckets are cut into slices of about ``bucket_edges`` edges, a turn for each, so a hub is no larger task. A round is one
    pass over all buckets. Relations, few by check, are sent to all tasks of a turn; those moved by several tasks take the
    mean of the moves, weighted by edges. Every turn ends in a table; with one block all rounds are one turn.

    There are ``rounds`` passes, or more until ``least_updates`` batches have moved a small graph.
    """
    if model not in ("TransE", "DistMult"):
        raise ValueError(f"unknown model {model}")
    spark = train.sparkSession
    triples = cut(train.select("s", "p", "o").distinct())
    many = triples.select(F.explode(F.array("s", "o")).alias("node")).agg(F.countDistinct("node")).first()[0]
    blocks = max(1, -(-many // block_rows))
    entities, names, edges = _start(triples, dim, seed, blocks)
    pair = F.least("i", "j")
    largest = edges.groupBy("i", "j").count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-2 * largest // bucket_edges)) if blocks > 1 else max(1, -(-largest // bucket_edges))
    turn = _turn_of(F.col("i"), F.col("j"), blocks) * slices + F.pmod(F.xxhash64("s", "p", "o", F.lit(seed)), F.lit(slices)).cast("int")
    edges = cut(edges.select("s", "p", "o", "i", "j", pair.alias("pair"), turn.alias("turn")), partition_by="turn")
    total = edges.count()
    turns = (1 if blocks == 1 else blocks + blocks % 2) * slices
    passes = max(rounds, -(-least_updates * batch // max(total, 1))) if rounds else 0
    inner = passes if turns == 1 else 1  # one turn holds everything: no table between rounds
    rows = names.orderBy("place").collect()
    relations, squares = np.array([r.vec for r in rows]).reshape(len(rows), dim), np.zeros((len(rows), dim))
    table = entities.select("place", "block", "vec", "squares")
    for step in range((passes // inner if inner else 0) * turns):
        at = step % turns
        shared = spark.sparkContext.broadcast((relations, squares))

        grouped = table.withColumn("pair", _pair_of(F.col("block"), at // slices, blocks)).groupBy("pair")
        bucket = edges.where(F.col("turn") == at).drop("turn").groupBy("pair")
        done = cut(grouped.cogroup(bucket).applyInPandas(_mover(model, shared, blocks, inner, batch, rate, (seed, step)), "place long, block int, vec array<double>, squares array<double>, weight double"))
        table = done.where("block >= 0").drop("weight")
        moves = done.where("block < 0").groupBy("place").agg(
            F.sum("weight").alias("w"), _vector_sum(dim, F.col("weight")).alias("vec"), _vector_sum(dim, F.lit(1.0), "squares").alias("squares"))
        for r in moves.collect():
            relations[r.place] += np.array(r.vec) / r.w
            squares[r.place] += r.squares
        shared.unpersist()
    ends = spark.createDataFrame([(r.node, relations[r.place].tolist()) for r in rows], NODE_VEC)
    return entities.select("node", "place").join(table.select("place", "vec"), "place").select("node", "vec"), ends


def margin_loss(triples: DataFrame, entities: DataFrame, relations: DataFrame, model: str, seed: int = V.SEED) -> DataFrame:
    """Mean margin loss of the triples against one corrupted triple each, as one row."""
    numbers = hash_rank(entities, [], F.col("node"), V.SEED).select(F.lit("entity").alias("kind"), "node", (F.col("_rank") - 1).alias("place"), "vec")
    params = numbers.unionByName(relations.select(F.lit("relation").alias("kind"), "node", F.lit(None).cast("long").alias("place"), "vec"))
    return _contrasted(triples, params, entities.count(), model, seed).agg(F.avg("loss").alias("loss"))


def split_triples(triples: DataFrame, test_share: float = 0.1, seed: int = V.SEED) -> tuple[DataFrame, DataFrame]:
    """Split in hash order, by ``test_share`` of all triples. The first triple of each subject, predicate and object
    stays in training, so that everything a test triple names has been trained.
    """
    name = F.concat_ws("|", "s", "p", "o")
    known = cut(triples.select("s", "p", "o").distinct().withColumn("_name", name).withColumn("_hash", F.xxhash64(name, F.lit(seed))))
    ends = known.select(F.explode(F.array(F.struct(F.lit("node").alias("role"), F.col("s").alias("node")), F.struct(F.lit("p").alias("role"), F.col("p").alias("node")),
                                          F.struct(F.lit("node").alias("role"), F.col("o").alias("node")))).alias("x"), "_hash", "_name")
    keepers = ends.groupBy("x.role", "x.node").agg(F.min(F.struct("_hash", "_name")).alias("k")).select(F.col("k._name").alias("_name")).distinct()
    free = known.join(keepers, "_name", "left_anti")
    wanted = int(known.count() * test_share)
    test = cut(hash_first(free, [], F.col("_name"), seed, F.lit(wanted), "_in").where("_in").select("s", "p", "o"))
    return known.select("s", "p", "o").join(test, ["s", "p", "o"], "left_anti"), test


def link_queries(test: DataFrame, entities: DataFrame, relations: DataFrame, model: str) -> DataFrame:
    """Both prediction sides of each test triple as ``(query_id, target, q, t)``: a query and a target vector.

    ``split_triples`` leaves no test triple without trained ends.
    """
    rows = lookup_join(test, entities.select(F.col("node").alias("s"), F.col("vec").alias("hv")), "s")
    rows = lookup_join(rows, relations.select(F.col("node").alias("p"), F.col("vec").alias("rv")), "p")
    rows = lookup_join(rows, entities.select(F.col("node").alias("o"), F.col("vec").alias("tv")), "o")
    if model == "DistMult":
        forward = F.zip_with("hv", "rv", lambda x, y: x * y)
        backward = F.zip_with("tv", "rv", lambda x, y: x * y)
    else:
        forward = F.zip_with("hv", "rv", lambda x, y: x + y)
        backward = F.zip_with("tv", "rv", lambda x, y: x - y)
    name = F.concat_ws("|", "s", "p", "o")
    sides = F.array(
        F.struct(F.concat(F.lit("tail|"), name).alias("query_id"), F.concat_ws("|", F.lit("tail"), "s", "p").alias("asked"), F.col("o").alias("target"), forward.alias("q"), F.col("tv").alias("t")),
        F.struct(F.concat(F.lit("head|"), name).alias("query_id"), F.concat_ws("|", F.lit("head"), "p", "o").alias("asked"), F.col("s").alias("target"), backward.alias("q"), F.col("hv").alias("t")),
    )
    return rows.select(F.explode(sides).alias("x")).select("x.*")


def true_answers(queries: DataFrame, triples: DataFrame) -> DataFrame:
    """(query_id, node) of every true answer to the queries of ``link_queries`` made from some of ``triples``."""
    sides = F.array(*[F.struct(F.concat_ws("|", F.lit(side), a, b).alias("_asked"), F.col(c).alias("node")) for side, a, b, c in (("tail", "s", "p", "o"), ("head", "p", "o", "s"))])
    answers = triples.select(F.explode(sides).alias("x")).select("x.*").distinct()
    return queries.join(answers, F.col("asked") == F.col("_asked")).select("query_id", "node")


def target_ranks(
    queries: DataFrame, entities: DataFrame, similarity: str = "dot", block_rows: int = 32_768, known: DataFrame | None = None,
    average_ties: bool = False, apart: tuple[str, str] | None = None,
) -> DataFrame:
    """Rank of each query's target among all entities: one plus the entities that score higher.

    With ``average_ties`` an equal score counts a half. ``known`` (query_id, node) names other true answers, which are
    left out of the count. ``apart`` names a column of the queries and one of the entities: entities with the query's value
    (NULL like NULL) are left out, without a row for any of them. Queries and entities are cut into bounded blocks; every
    pair of blocks is one group that multiplies tiles of two matrices and returns counts per query; no pair of rows is ever
    emitted, and a task holds two blocks and one tile.
    """
    n_blocks = max(1, math.ceil(entities.count() / block_rows))
    n_chunks = max(1, math.ceil(queries.count() / block_rows))
    wanted, value = (F.col(c).cast("string") for c in apart) if apart else (F.lit(None).cast("string"), F.lit(None).cast("string"))
    left = queries.select(
        "query_id", "target", "q", "t", wanted.alias("wanted"), F.pmod(F.xxhash64("query_id"), F.lit(n_chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
    )
    right = entities.select(
        "node", "vec", value.alias("value"), F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
    )

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(len(column), -1)

    def codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        both = pd.factorize(np.concatenate([a.to_numpy(), b.to_numpy()]), use_na_sentinel=False)[0].astype(np.int32)
        return both[: len(a)], both[len(a) :]

    def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        if similarity == "dot":
            return q @ v.T
        return -(np.square(q).sum(1)[:, None] - 2.0 * (q @ v.T) + np.square(v).sum(1)[None, :])

    def count_higher(asked: pa.Table, block: pa.Table) -> pa.Table:
        n, m = asked.num_rows, block.num_rows
        higher, equal = np.zeros(n, dtype="int64"), np.zeros(n, dtype="int64")
        if n and m:
            q, t, vecs = matrix(asked["q"]), matrix(asked["t"]), matrix(block["vec"])
            target, nodes = codes(asked["target"], block["node"])
            mine, theirs = codes(asked["wanted"], block["value"])
            own = (q * t).sum(1) if similarity == "dot" else -np.square(q - t).sum(1)
            for lo in range(0, n, TILE):
                for at in range(0, m, TILE):
                    rows, cols = slice(lo, lo + TILE), slice(at, at + TILE)
                    gap = scores(q[rows], vecs[cols]) - own[rows, None]
                    other = target[rows, None] != nodes[None, cols]
                    if apart:
                        other &= mine[rows, None] != theirs[None, cols]
                    higher[rows] += ((gap > TIE) & other).sum(1)
                    equal[rows] += ((np.abs(gap) <= TIE) & other).sum(1)
        return pa.table({"query_id": asked["query_id"].cast(pa.string()), "higher": higher, "equal": equal})

    counted = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(
        count_higher, "query_id string, higher long, equal long")
    if known is not None:
        answers = known.distinct().join(queries, "query_id").where(F.col("node") != F.col("target")).join(entities, "node")
        score = lambda v: vectors.dot(F.col("q"), v) if similarity == "dot" else -_total(_product(_plus(F.col("q"), v, -1.0), _plus(F.col("q"), v, -1.0)))
        gap = score(F.col("vec")) - score(F.col("t"))
        counted = counted.unionByName(answers.select(
            "query_id", (-(gap > TIE).cast("long")).alias("higher"), (-(F.abs(gap) <= TIE).cast("long")).alias("equal")))
    rank = F.sum("higher") + 1 + (F.sum("equal") / 2 if average_ties else F.lit(0))
    return counted.groupBy("query_id").agg(rank.alias("rank"))


def rank_metrics(ranks: DataFrame) -> DataFrame:
    """Mean reciprocal rank, Hits@10 and mean rank of a table of ranks."""
    return ranks.agg(
        F.round(F.avg(F.lit(1.0) / F.col("rank")), 9).alias("mrr"),
        F.round(F.avg((F.col("rank") <= 10).cast("double")), 9).alias("hits_at_10"),
        F.round(F.avg("rank"), 9).alias("mean_rank"),
        F.count(F.lit(1)).alias("ranked"),
    )


def _finite(vec: str) -> Column:
    return F.forall(vec, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))


def best_model(
    triples: DataFrame, models: tuple[str, ...] = ("TransE", "DistMult"), dim: int = V.EMBEDDING_DIM, **training
) -> tuple[DataFrame, DataFrame]:
    """Train each model on 90 % of the triples, rank the rest (filtered, ties averaged); returns the vectors of the best one and all metrics.

    The loop runs over a handful of model names. The best is named only among all of them: a model that fails, or whose
    vectors are no numbers (they would rank first everywhere), fails the whole.
    """
    spark = triples.sparkSession
    train, test = split_triples(cut(triples))
    train, test = cut(train), cut(test)
    found = {}
    for model in models:
        try:
            entities, relations = train_translation_model(train, model, dim, **training)
            if not entities.unionByName(relations).where(~_finite("vec")).isEmpty():
                raise ArithmeticError("vectors that are no numbers")
            queries = cut(link_queries(test, entities, relations, model))
            similarity = "dot" if model == "DistMult" else "l2"
            answers = true_answers(queries, train.unionByName(test))
            row = rank_metrics(target_ranks(queries, entities, similarity, known=answers, average_ties=True)).first()
        except Exception as failure:
            raise RuntimeError(f"embedding model {model} failed: {failure}") from failure
        found[model] = (entities, row)
    best = max(found, key=lambda m: found[m][1].mrr if found[m][1].mrr is not None else -1.0)
    rows = [(m, r.mrr, r.hits_at_10, r.mean_rank, r.ranked, m == best) for m, (_, r) in found.items()]
    metrics = spark.createDataFrame(
        rows, "model string, mrr double, hits_at_10 double, mean_rank double, ranked long, selected boolean")
    return found[best][0], metrics


def embedding_table(vectors: DataFrame, dim: int = V.EMBEDDING_DIM) -> DataFrame:
    """Wide form: the node and one column per dimension, ordered by node."""
    return vectors.select("node", *[F.get("vec", F.lit(k)).alias(f"kg_emb_{k:02d}") for k in range(dim)]).orderBy("node")


def from_embedding_table(table: DataFrame) -> DataFrame:
    """Back from the wide form; vector columns are found by prefix."""
    columns = sorted(c for c in table.columns if c.startswith("kg_emb_"))
    return table.select("node", F.array(*[F.col(c).cast("double") for c in columns]).alias("vec"))


def rounded_vectors(vectors: DataFrame, places: int = 6) -> DataFrame:
    return vectors.select("node", rounded(F.col("vec"), places).alias("vec"))
