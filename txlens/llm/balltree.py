"""Exact maximum inner product search: ball trees per shard, branch and bound, shared thresholds.

Vectors are dealt over shards of bounded size: by the nearest of a bounded number of pivots (a sample of the vectors),
so that a shard's vectors lie together, and a pivot's vectors by row over as many shards as they need, so that a
vector or an id that holds a third of all rows is spread. Each shard is built into a ball tree (nodes halve
their vectors along the direction between two far ones; a node has a centre and a radius) that is
stored as one row of arrays. Queries come in blocks of bounded size. A block searches a tree from
its root, always at the node with the largest upper bound ``q.centre + |q| * radius`` of any query;
a query leaves a node whose bound is below its current kth score.

Thresholds are shared in two rounds: first every block searches one shard of its own pivot, whose kth scores are lower
bounds of the final ones. Then the bounds of the other shards' roots (a centre and a radius each) are held against
these scores, and only queries that a shard can still answer are sent to it; there they start from the same scores, so that
only candidates that can still count are returned. Ties at the kth score are searched like better ones
and go to the smaller id, so a shard returns at most k rows per query row, however many copies a vector has. Queries are a
stated set of rows (in blocks) against all vectors.

Scores are sums of products of integers, held in float64 and exact below 2^53.

Edge cases: vectors that are null, or hold null or non-finite components, take no part, as query or
as candidate; vectors of different lengths are searched among their equals only (all products of empty ones are 0); a query is never its
own answer (rows that share its id are left out); fewer candidates than k give fewer rows; repeated
rows of an id each count, as candidates and as queries: the answer of a query id is the k best of the pairs of any of its rows
with any candidate row; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize

LEAF = 128
SHARD_VECTORS = 16_384
BLOCK_QUERIES = 512
#: Pivots at most: they go to every task that deals vectors.
MOST_PIVOTS = 1_024
#: Roots of shards in one row.
ROOTS = 1_024


class BallTree:
    """Nodes as arrays: first and last vector, children, centre, radius. Vectors in tree order."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(vectors))
        first, last, left, right, centres, radii = [], [], [], [], [], []

        def node(a: int, b: int) -> int:
            inside = vectors[order[a:b]]
            centre = inside.mean(0)
            far = ((inside - centre) ** 2).sum(1)
            i = len(first)
            first.append(a), last.append(b), left.append(-1), right.append(-1)
            centres.append(centre), radii.append(float(np.sqrt(far.max())))
            return i

        todo = [node(0, len(vectors))] if len(vectors) else []
        while todo:
            i = todo.pop()
            a, b = first[i], last[i]
            if b - a <= leaf or radii[i] == 0:
                continue
            inside = vectors[order[a:b]]
            one = inside[((inside - centres[i]) ** 2).sum(1).argmax()]
            other = inside[((inside - one) ** 2).sum(1).argmax()]
            along = inside @ (other - one)
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(along, half)]
            left[i], right[i] = node(a, a + half), node(a + half, b)
            todo += [left[i], right[i]]
        self.vectors, self.ids = vectors[order], ids[order]
        self.first, self.last = np.array(first, np.int32), np.array(last, np.int32)
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.centres = np.array(centres).reshape(len(first), vectors.shape[1])
        self.radii = np.array(radii)

    FIELDS = (("vectors", np.float64), ("ids", np.int64), ("first", np.int32), ("last", np.int32), ("left", np.int32), ("right", np.int32), ("centres", np.float64), ("radii", np.float64))

    def pack(self) -> list[bytes]:
        return [getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS]

    @classmethod
    def unpack(cls, width: int, parts: list[bytes]) -> BallTree:
        tree = cls.__new__(cls)
        for (name, kind), raw in zip(cls.FIELDS, parts):
            setattr(tree, name, np.frombuffer(raw, kind))
        tree.vectors = tree.vectors.reshape(len(tree.ids), width)
        tree.centres = tree.centres.reshape(len(tree.first), width)
        return tree

    def search(self, queries: np.ndarray, query_ids: np.ndarray, kth: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the (ids, scores) of its k best candidates (ties to the smaller id) among
        those that reach ``kth``, the scores known to be reached elsewhere."""
        n = len(queries)
        found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(n)]
        if not len(self.first):
            return found
        kth = kth.copy()
        length = np.sqrt((queries**2).sum(1))

        def bounds(i: int, who: np.ndarray) -> np.ndarray:
            return upper_bound(queries[who] @ self.centres[i], length[who], self.radii[i])

        everyone = np.arange(n)
        top = bounds(0, everyone)
        heap = [(-top.max(), 0, everyone, top)]
        while heap:
            _, i, who, bound = heapq.heappop(heap)
            who = who[bound >= kth[who]]
            if not len(who):
                continue
            if self.left[i] >= 0:
                for child in (int(self.left[i]), int(self.right[i])):
                    bound = bounds(child, who)
                    some = bound >= kth[who]
                    if some.any():
                        heapq.heappush(heap, (-bound[some].max(), child, who[some], bound[some]))
                continue
            a, b = self.first[i], self.last[i]
            scores = queries[who] @ self.vectors[a:b].T
            ids = self.ids[a:b]
            for q, row in zip(who.tolist(), scores):
                at = np.flatnonzero((row >= kth[q]) & (ids != query_ids[q]))
                if len(at):
                    all_ids = np.concatenate([found[q][0], ids[at]])
                    all_scores = np.concatenate([found[q][1], row[at]])
                    if len(all_scores) >= k:
                        keep = np.lexsort((all_ids, -all_scores))[:k]
                        all_ids, all_scores = all_ids[keep], all_scores[keep]
                        kth[q] = max(kth[q], all_scores[-1])
                    found[q] = (all_ids, all_scores)
        return found


def upper_bound(to_centre, length, radius):
    """Largest inner product of a query with any vector of a ball; a hair above, against rounding in the square roots."""
    bound = to_centre + length * radius
    return bound + np.abs(bound) * 1e-12 + 1e-6


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, width, v array<double>): floor(scale * x) of the vectors whose components are all finite."""
    usable = F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(F.coalesce(usable, F.lit(False)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.size(vector_col).alias("width"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"),
    )


def _packed(column, width: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(column), width)


def _celled(vectors: DataFrame, cells: int) -> DataFrame:
    """The vectors with ``cell``, the nearest of at most ``MOST_PIVOTS`` pivots of their width (0 if it has none)."""
    if cells == 1:
        return vectors.withColumn("cell", F.lit(0))
    sample = vectors.orderBy(F.xxhash64("row", F.lit(17)), "row").select("width", "v").limit(min(cells, MOST_PIVOTS))
    pivots: dict[int, list] = {}
    for r in sample.collect():
        pivots.setdefault(r["width"], []).append(r["v"])
    pivots = {width: np.array(rows) for width, rows in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths = b.column("width").to_numpy()
            cell = np.zeros(len(widths), np.int32)
            for width in np.unique(widths).tolist():
                if width in pivots and width:
                    at = np.flatnonzero(widths == width)
                    x = _packed(b.column("v").take(pa.array(at)), width)
                    p = pivots[width]
                    cell[at] = ((p**2).sum(1) - 2 * (x @ p.T)).argmin(1)
            yield b.append_column("cell", pa.array(cell))

    return vectors.mapInArrow(run, "id bigint, width int, v array<double>, row bigint, cell int")


def _split(cell, n, rows_each: int, salt: int):
    """A part of a cell of ``n`` rows, in parts of about ``rows_each``, by row."""
    parts = F.ceil(n / F.lit(rows_each)).cast("bigint")
    return F.shiftleft(cell.cast("bigint"), 32) + F.pmod(F.xxhash64("id", "row", F.lit(salt)), parts)


def _trees(vectors: DataFrame) -> DataFrame:
    """(width, shard, centre, radius, tree fields): one row per shard of the vectors."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        column = group["v"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        ids = group["id"].to_numpy()
        inside = np.argsort(ids, kind="stable")
        tree = BallTree(_packed(column, key[0].as_py())[inside], ids[inside])
        names = ["width", "shard", "centre", "radius", *[name for name, _ in BallTree.FIELDS]]
        head = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([tree.centres[0]], pa.list_(pa.float64())), pa.array([tree.radii[0]])]
        return pa.table([*head, *[pa.array([x], pa.binary()) for x in tree.pack()]], names)

    fields = ", ".join(f"{name} binary" for name, _ in BallTree.FIELDS)
    return vectors.groupBy("width", "shard").applyInArrow(build, f"width int, shard bigint, centre array<double>, radius double, {fields}")


def _reachable(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    """(width, shard, q): of each block the queries that a shard's root still lets reach their kth score, the block's home
    shard left out. ``roots`` has a list of roots a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                width, home = b.column("width")[r].as_py(), b.column("home")[r].as_py()
                q, root = b.column("q")[r].values, b.column("roots")[r].values
                kth = q.field("kth").to_numpy()
                vectors = q.field("v").flatten().to_numpy().reshape(len(kth), width)
                radii = root.field("radius").to_numpy()
                centres = root.field("centre").flatten().to_numpy().reshape(len(radii), width)
                length = np.sqrt((vectors**2).sum(1))
                bound = upper_bound(vectors @ centres.T, length[:, None], radii[None, :])
                for i, shard in enumerate(root.field("shard").to_pylist()):
                    some = np.flatnonzero(bound[:, i] >= kth)
                    if shard != home and len(some):
                        kept = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), q.take(pa.array(some)))
                        yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([shard], pa.int64()), kept], ["width", "shard", "q"])

    pairs = blocks.join(roots, "width").select("width", "home", "q", "roots")
    return pairs.mapInArrow(run, "width int, shard bigint, q array<struct<id:bigint,v:array<double>,kth:double>>")


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) from rows of (tree, block, kth thresholds)."""
    names = [name for name, _ in BallTree.FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                width = b.column(0)[r].as_py()
                tree = BallTree.unpack(width, [b.column(2 + i)[r].as_py() for i in range(len(names))])
                q = b.column(1)[r].values
                ids = q.field(0).to_numpy()
                vectors = q.field(1).flatten().to_numpy().reshape(len(ids), width)
                kth = q.field(2).to_numpy()
                found = tree.search(vectors, ids, kth, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, [len(x) for x, _ in found])),
                        pa.array(np.concatenate([x for x, _ in found])),
                        pa.array(np.concatenate([s for _, s in found]).astype(np.int64)),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return pairs.select("width", "q", *names).mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query id, with rank; the limit is taken before the shuffle too."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best other vectors of every row for which the
    column ``is_query`` (over ``id``) holds."""
    spark = vectors.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(int(spark.conf.get(key)), 2_000)))
    numbered = integers(vectors, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id())
    every = materialize(numbered, "ball-rows")
    n = every.count()
    celled = materialize(_celled(every, max(1, -(-n // SHARD_VECTORS))), "ball-vectors")
    chosen = F.coalesce(is_query, F.lit(False))
    sizes = celled.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(chosen).alias("n_queries"))
    sized = celled.join(broadcast_if_small(materialize(sizes, "ball-cells")), ["width", "cell"])
    dealt = sized.select("id", "width", "v", _split(F.col("cell"), F.col("n"), SHARD_VECTORS, 11).alias("shard"))
    trees = materialize(_trees(dealt), "ball-trees")
    # a block's home is one of the shards of its own cell
    block = _split(F.col("cell"), F.col("n_queries"), BLOCK_QUERIES, 13)
    parts = F.ceil(F.col("n") / F.lit(SHARD_VECTORS)).cast("bigint")
    home = F.shiftleft(F.col("cell").cast("bigint"), 32) + F.pmod(block, parts)
    queries = sized.where(chosen).select("id", "width", "v", block.alias("block"), home.alias("home"))
    lowest = F.lit(float("-inf")).alias("kth")
    blocks = materialize(_blocks(queries.select("*", lowest)), "ball-blocks")

    # shards are about evenly filled, but by a hash: one of them may have no row, and its blocks search the others only
    nearest = materialize(_search(blocks.withColumnRenamed("home", "shard").join(trees, ["width", "shard"]), k), "ball-home")
    n_shards = trees.select("shard").count()
    if n_shards == 1:
        return _best(nearest, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    reached = nearest.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("reached"))
    known = _blocks(queries.join(reached, "id", "left").withColumn("kth", F.coalesce(F.col("reached"), lowest)))
    root = F.struct("shard", "centre", "radius")
    part = F.pmod(F.xxhash64("shard"), F.lit(-(-n_shards // ROOTS)))
    roots = trees.groupBy("width", part.alias("part")).agg(F.collect_list(root).alias("roots")).drop("part")
    asked = materialize(_reachable(known, roots), "ball-asked")
    rest = _search(asked.join(trees, ["width", "shard"]), k)
    return _best(nearest.unionByName(rest), k)


def _blocks(queries: DataFrame) -> DataFrame:
    """(width, block, home, q): one row per block of queries."""
    return queries.groupBy("width", "block", "home").agg(F.array_sort(F.collect_list(F.struct("id", "v", "kth"))).alias("q"))
