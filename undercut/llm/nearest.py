"""Nearest vectors by inner product: balanced posting lists, reached over a graph of their centres."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.shared import materialise

#: Vectors that the centres are fitted on, and queries that the pruning ratio is fitted on, about.
SAMPLE, TRIALS = 32_768, 256
#: Vectors of a list that is aimed at, and sample vectors that a centre rests on at least.
LIST_SIZE, REST = 256, 8
#: Share of the true neighbours of the trial queries that must lie in the lists chosen.
REACH = 0.97
#: A vector also goes to lists whose centres are at most so many times as far as the nearest,
#: to this many lists in all.
BOUNDARY, COPIES = 1.15, 4
#: Graph edges of a centre: to near ones, and drawn ones that keep the graph in one piece.
NEAR, FAR = 24, 4
#: Centres that every search expands at least, and how many at a time until then.
BEAM, STRIDE = 16, 4
#: Vectors and queries of a block: what meets in one row of the join of lists and queries.
BLOCK, QUERY_BLOCK = 512, 256
#: Queries whose best are held by a task before they leave it.
HELD = 1 << 16


@dataclass
class Index:
    """Centres in the lifted space, their graph, the bound of lengths and the pruning ratio."""

    centres: np.ndarray
    graph: np.ndarray
    bound: float
    kind: str
    ratio: float = np.inf


# Vectors: bytes of little-endian numbers of the table's own width


CODED = "vec_id long, asked boolean, name binary, vector binary, squared double"


def _encode(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, as bytes, with a 128-bit name of their contents and their squared length."""
    for batch in batches:
        kept, names, data, lengths = [], [], [], []
        for i, values in enumerate(batch.column("embedding")):
            if not values.is_valid or values.values.null_count:
                continue
            vector = values.values.to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # no negative zeros
            if not np.isfinite(vector).all() or not vector.any():
                continue
            kept.append(i)
            data.append(vector.tobytes())
            names.append(xxhash.xxh3_128_digest(data[-1]))
            lengths.append(float(np.square(vector, dtype=np.float64).sum()))
        rows = batch.take(pa.array(kept, pa.int64()))
        made = [pa.array(names, pa.binary()), pa.array(data, pa.binary()), pa.array(lengths, pa.float64())]
        yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("asked"), *made], ["vec_id", "asked", "name", "vector", "squared"])


def _matrix(rows: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def _lift(vectors: np.ndarray, bound: float, query: bool = False) -> np.ndarray:
    """Points whose distances order candidates as inner products do.

    A candidate x becomes (x, sqrt(bound^2 - |x|^2)), a query q becomes (q bound / |q|, 0).
    """
    squared = np.square(vectors).sum(axis=1)
    if query:
        scaled = vectors * (bound / np.sqrt(squared))[:, None]
        return np.hstack([scaled, np.zeros((len(vectors), 1))]).astype(np.float32)
    return np.hstack([vectors, np.sqrt(np.maximum(0, bound**2 - squared))[:, None]]).astype(np.float32)


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows in double precision, each summed in one order whatever stands beside it."""
    return np.einsum("ij,ij->i", queries, vectors, optimize=False)


# Centres and their graph


def _halved(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Whether a point belongs to the second of two equal halves, cut between two centres."""
    one, two = points[rng.choice(len(points), 2, replace=False)]
    for _ in range(6):
        side = points @ (two - one) > (np.square(two).sum() - np.square(one).sum()) / 2
        if side.all() or not side.any():
            break
        one, two = points[~side].mean(axis=0), points[side].mean(axis=0)
    rank = np.argsort(np.argsort(points @ (two - one), kind="stable"), kind="stable")
    return rank >= len(points) // 2


def balanced_centres(points: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Means of parts of equal size, by halving again and again."""
    rng, parts = np.random.default_rng(seed), [points]
    while len(parts) * 2 <= lists and min(map(len, parts)) >= 2:
        cut = [(part, _halved(part, rng)) for part in parts]
        parts = [half for part, side in cut for half in (part[~side], part[side])]
    return np.array([part.mean(axis=0) for part in parts], np.float32)


def centre_graph(centres: np.ndarray, seed: int = 7) -> np.ndarray:
    """Out-edges of each centre: near ones, each in another direction first, and a few drawn ones."""
    k, rng = len(centres), np.random.default_rng(seed)
    squared, rows = np.square(centres).sum(axis=1), []
    for i in range(k):
        far = squared - 2 * centres @ centres[i]
        far[i] = np.inf
        close = np.argsort(far, kind="stable")[: min(k - 1, 3 * NEAR)]
        spread, rest = [], []
        for j in close:
            d = np.square(centres[i] - centres[j]).sum()
            hidden = any(np.square(centres[j] - centres[m]).sum() < d for m in spread)
            (rest if hidden else spread).append(j)
        edges = [*spread, *rest][:NEAR]
        # The next centre in a ring: with it every centre can be reached from every other.
        rows.append([*edges, (i + 1) % k, *rng.integers(0, k, FAR), *[i] * (NEAR - len(edges))])
    return np.array(rows, np.int32)


def nearest_centres(points: np.ndarray, index: Index, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances from points to the centres that a search of the graph has seen (others infinite), and the least.

    A search starts at evenly spread centres and expands the nearest open ones, at least
    ``BEAM`` of them, as long as they are within ``ratio`` of the nearest seen; more at a time
    the longer it lasts. It ends when it has seen every centre, as there is nothing left to find.
    """
    centres, graph, n, k = index.centres, index.graph, len(points), len(index.centres)
    entries = np.unique(np.linspace(0, k - 1, min(k, int(np.sqrt(k)) + 1)).astype(int))
    squared, own_squared = np.square(centres).sum(axis=1), np.square(points).sum(axis=1)

    def table(w: np.ndarray, t: np.ndarray | slice) -> np.ndarray:
        products = points[w] @ (-2 * centres[t]).T
        products += own_squared[w, None]
        products += squared[t]
        return np.sqrt(np.maximum(products, 0, out=products), out=products)

    def pairs(w: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, own_squared[w] + squared[t] - 2 * np.einsum("ij,ij->i", points[w], centres[t])))

    found, active = np.full((n, k), np.inf, np.float32), np.arange(n)
    found[:, entries] = table(active, entries)
    seen, open_ = found, found.copy()  # of the active points
    stride, done = min(STRIDE, k), 0
    while len(active):
        picked = np.argpartition(open_, stride - 1, axis=1)[:, :stride]
        reach = np.take_along_axis(open_, picked, axis=1)
        limit = seen.min(axis=1) * ratio if done >= BEAM else np.full(len(active), np.inf)
        going = np.isfinite(reach) & (reach <= limit[:, None])
        rows, columns = np.nonzero(going)
        node = picked[rows, columns]
        open_[rows, node] = np.inf
        fresh = np.zeros((len(active), k), bool)
        fresh[rows[:, None], graph[node]] = True
        fresh &= np.isinf(seen)
        # One product for all is cheaper than single pairs, unless few of it are asked for.
        if np.count_nonzero(fresh) * 32 >= fresh.size:
            distances = table(active, slice(None))
            np.copyto(seen, distances, where=fresh)
            np.copyto(open_, distances, where=fresh)
        else:
            at, to = np.nonzero(fresh)
            for c in range(0, len(at), 1 << 16):
                w, t = at[c : c + (1 << 16)], to[c : c + (1 << 16)]
                seen[w, t] = open_[w, t] = pairs(active[w], t)
        going = going.any(axis=1) & np.isinf(seen).any(axis=1)
        if seen is not found:
            found[active] = seen
        if not going.all():
            active, seen, open_ = active[going], seen[going], open_[going]
        done += stride
        stride = min(stride if done < BEAM else 4 * stride, k)
    return found, found.min(axis=1)


def squared_between(centres: np.ndarray) -> np.ndarray:
    """Squared distances between centres."""
    squared = np.square(centres).sum(axis=1)
    between = np.maximum(0, squared[:, None] + squared - 2 * centres @ centres.T)
    np.fill_diagonal(between, 0)
    return between


def boundary_lists(seen: np.ndarray, least: np.ndarray, between: np.ndarray) -> list[list[int]]:
    """The lists of each point: its nearest, and near ones that no chosen centre is closer to."""
    near = np.where(seen <= least[:, None] * BOUNDARY, seen, np.inf)
    chosen, rows = np.full((len(seen), COPIES), -1), np.arange(len(seen))
    for copy in range(COPIES):
        nearest = near.argmin(axis=1)
        left = np.isfinite(near[np.arange(len(near)), nearest])
        rows, near, nearest = rows[left], near[left], nearest[left]
        chosen[rows, copy] = nearest
        near[between[nearest] <= np.square(near)] = np.inf
    return [row[row >= 0].tolist() for row in chosen]


# Work on partitions


def _assign(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Vectors with the lists they are posted to."""
    between = squared_between(index.centres)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            seen, least = nearest_centres(_lift(_matrix(batch.column("vector").to_pylist(), index.kind), index.bound), index, BOUNDARY)
            lists = boundary_lists(seen, least, between)
            yield batch.append_column("lists", pa.array(lists, pa.list_(pa.int32())))


def _route(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Queries with the lists that distance ratios leave."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            seen, least = nearest_centres(_lift(_matrix(batch.column("vector").to_pylist(), index.kind), index.bound, query=True), index, index.ratio)
            lists = [np.flatnonzero(d <= m * index.ratio).tolist() for d, m in zip(seen, least)]
            yield batch.append_column("lists", pa.array(lists, pa.list_(pa.int32())))


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths of vectors that are not zero, also where squares are too large or small."""
    most = np.abs(vectors).max(axis=1)
    return most * np.sqrt(np.square(vectors / most[:, None]).sum(axis=1))


SCORED = "query binary, score double, vec_id long"


class Best:
    """The ``k`` best (score, id) of each query among the blocks met so far, each id once, ties to lesser ids."""

    def __init__(self, k: int):
        self.k, self.places, self.least = k, {}, np.empty(0)
        self.rows, self.added, self.waiting = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), [], 0

    def meet(self, names: list[bytes], queries: np.ndarray, vectors: np.ndarray, ids: pa.ListArray) -> None:
        """Takes up the vectors of a block, each of which stands for several ids.

        A single-precision product of scaled vectors, whose error has a bound, leaves out pairs that cannot be
        among the best; the others get their exact inner products.
        """
        place = np.array([self.places.setdefault(name, len(self.places)) for name in names])
        self.least = np.concatenate([self.least, np.full(len(self.places) - len(self.least), -np.inf)])
        counts, every = ids.value_lengths().to_numpy(), ids.flatten().to_numpy()
        with np.errstate(all="ignore"):
            size, largest = _lengths(queries), _lengths(vectors).max()
            scaled = (queries / size[:, None]).astype(np.float32) @ (vectors / largest).astype(np.float32).T
            error = 4 * (queries.shape[1] + 4) * np.finfo(np.float32).eps
            least = self.least[place] / size / largest
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and len(vectors) > self.k and len(np.unique(every)) == len(every):
                # At least k vectors of the block, and so as many ids, score no less than this, less the error.
                least[new] = np.partition(scaled[new], len(vectors) - self.k, axis=1)[:, len(vectors) - self.k] - error
                self.least[place[new]] = least[new] * size[new] * largest
            # Written so that a pair is kept where numbers are too large or small to be scaled.
            at, to = np.nonzero(~(scaled < (least - error).astype(np.float32)[:, None]))
        for cut in range(0, len(at), 1 << 14):
            q, v = at[cut : cut + (1 << 14)], to[cut : cut + (1 << 14)]
            scores, n = inner_products(queries[q], vectors[v]), counts[v]
            # The ids of v stand one after another, from the number of those of earlier vectors on.
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found = every[np.repeat((np.cumsum(counts) - counts)[v], n) + within]
            self.added.append((np.repeat(place[q], n), np.repeat(scores, n), found))
            self.waiting += len(found)
            if self.waiting > (1 << 16) + 2 * len(self.rows[0]):
                self._cut()

    def _cut(self) -> None:
        q, score, i = (np.concatenate(parts) for parts in zip(self.rows, *self.added))
        order = np.lexsort((-score, i, q))
        q, score, i = q[order], score[order], i[order]
        once = np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1]))[: len(q)]
        q, score, i = q[once], score[once], i[once]
        order = np.lexsort((i, -score, q))
        q, score, i = q[order], score[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last, kept = rank == self.k - 1, rank < self.k
        self.least[q[last]] = score[last]
        self.rows, self.added, self.waiting = (q[kept], score[kept], i[kept]), [], 0

    def scored(self) -> pa.RecordBatch:
        """What is held, which is then forgotten."""
        self._cut()
        (q, score, i), names = self.rows, pa.array(list(self.places), pa.binary())
        self.__init__(self.k)
        return pa.RecordBatch.from_arrays([names.take(pa.array(q)), pa.array(score), pa.array(i)], ["query", "score", "vec_id"])


def _meet(batches: Iterator[pa.RecordBatch], kind: str, k: int) -> Iterator[pa.RecordBatch]:
    """The best that a task finds for each of its queries, whatever number of lists they meet in it."""
    best = Best(k)
    for batch in batches:
        for postings, queries in zip(batch.column("postings"), batch.column("queries")):
            vectors, ids = (postings.values.field(name) for name in ("vector", "ids"))
            asked, names = (queries.values.field(name).to_pylist() for name in ("vector", "name"))
            best.meet(names, _matrix(asked, kind), _matrix(vectors.to_pylist(), kind), ids)
            if len(best.places) > HELD:
                yield best.scored()
    yield best.scored()


def _brute(batches: Iterator[pa.RecordBatch], queries: np.ndarray, names: list[bytes], kind: str, k: int) -> Iterator[pa.RecordBatch]:
    """The best of all vectors of a partition for each of a few queries."""
    best = Best(k)
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            best.meet(names, queries, _matrix(batch.column("vector").to_pylist(), kind), batch.column("ids"))
    yield best.scored()


# The operator


def distinct_vectors(coded: DataFrame, most: int) -> DataFrame:
    """Vectors once each, with the least ``most`` ids that have them.

    No more can be among that many nearest, as copies tie and ties go to lesser ids. Rows
    are combined and ranked in each task before they are shuffled.
    """
    order = Window.partitionBy("name").orderBy("vec_id")
    few = coded.select("name", "vec_id").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    ids = few.groupBy("name").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return coded.groupBy("name").agg(F.first("vector").alias("vector"), F.first("squared").alias("squared")).join(ids, "name")


def _top(scored: DataFrame, k: int) -> DataFrame:
    """The best of each query over all lists; a vector found in several of them counts once."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    once = scored.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _draw(vectors: DataFrame, rows: int, most: int, kind: str) -> tuple[list[bytes], np.ndarray]:
    """Names and vectors of about ``most`` of the rows, or all; which ones depends on contents alone."""
    share = int(min(1, most / max(1, rows)) * (1 << 31))
    drawn = vectors.where(F.pmod(F.xxhash64("name"), F.lit(1 << 31)) < share).select("name", "vector").toArrow()
    return drawn.column("name").to_pylist(), _matrix(drawn.column("vector").to_pylist(), kind) if drawn.num_rows else np.zeros((0, 0))


def fit(vectors: DataFrame, kind: str) -> Index | None:
    """Centres and graph for a table of distinct vectors.

    Centres rest on a sample of about ``SAMPLE`` vectors and there are as many as lists of
    ``LIST_SIZE`` need, up to the sample over ``REST``.
    """
    rows, squared = vectors.agg(F.count("*"), F.max("squared")).first()
    if not rows:
        return None
    bound = float(np.sqrt(squared))
    points = _lift(_draw(vectors, rows, SAMPLE, kind)[1], bound)
    centres = balanced_centres(points, max(1, min(rows // LIST_SIZE, len(points) // REST)))
    return Index(centres, centre_graph(centres), bound, kind)


def pruning_ratio(posted: DataFrame, trials: DataFrame, index: Index, k: int) -> float:
    """The distance ratio within which ``REACH`` of the true neighbours of a few queries are posted.

    Each of about ``TRIALS`` queries is compared with all vectors, in blocks, once.
    """
    names, queries = _draw(trials, trials.count(), TRIALS, index.kind)
    if not names:
        return 1.0
    truth = posted.mapInArrow(functools.partial(_brute, queries=queries, names=names, kind=index.kind, k=k), SCORED)
    truth = _top(truth, k)
    lists = posted.select(F.explode("ids").alias("vec_id"), "lists")
    found = truth.join(lists, "vec_id").select("query", "lists").collect()  # TRIALS times k rows
    place = {name: i for i, name in enumerate(names)}
    points = _lift(queries, index.bound, query=True)
    far = [np.sqrt(np.square(point - index.centres).sum(axis=1)) for point in points]
    ratios = []
    for query, lists in found:
        distances = far[place[query]]
        ratios.append(distances[lists].min() / max(distances.min(), np.finfo(np.float32).tiny))
    # A little more, as distances are single precision.
    return float(np.quantile(ratios, REACH, method="higher")) * 1.0001


def search(embeddings: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """The ``k`` nearest other rows of every row that ``queries`` holds for, by inner product.

    Returns query_id, rank (from 1), vec_id and score, nearest first, ties to the lesser id.
    Fewer rows come back where there are fewer candidates.

    Equal vectors are one class with the least ids that can matter. Classes are posted to the
    list of their nearest centre and, near a boundary, to others; queries are classes too.
    Lists are cut into blocks by hash and the queries of a list likewise, so that each row of
    their join is a small dense product; a frequent list is many such rows. A query meets the
    lists whose centres are within the pruning ratio, which is fitted so that the lists
    hold 0.97 of the true neighbours of about 256 of the queries.

    Vectors that are null, zero, or hold a null or a value that is not finite take no part,
    nor do rows without an id. Vectors must have one length. Rows of one id are one candidate,
    with the best of their scores, and each of them is a query. Other columns are ignored; an
    empty table gives no rows.
    """
    most = k + 1
    element = embeddings.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    values = F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long"), F.coalesce(queries, F.lit(False)).alias("asked"), values.alias("embedding"))
    coded = materialise(rows.mapInArrow(functools.partial(_encode, kind=kind), CODED), "coded")
    vectors = materialise(distinct_vectors(coded, most), "vectors")
    asked = coded.where("asked").select(F.col("vec_id").alias("query_id"), "name")
    members = materialise(asked.groupBy("name").agg(F.count("*").alias("members")), "query-classes")
    index = fit(vectors, kind)
    if index is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = vectors.join(members, "name", "left_semi")
    posted = vectors.select("name", "vector", "ids").mapInArrow(
        functools.partial(_assign, index=index), "name binary, vector binary, ids array<bigint>, lists array<int>"
    )
    posted = materialise(posted, "posted")
    index.ratio = pruning_ratio(posted, wanted, index, most)

    postings = _blocks(posted.select("name", F.struct("ids", "vector").alias("entry"), F.explode("lists").alias("list")), BLOCK, "postings")
    routed = wanted.select("name", "vector").mapInArrow(functools.partial(_route, index=index), "name binary, vector binary, lists array<int>")
    # Tables of blocks are not written: readers hold thousands of rows at once, and each of these is a whole block.
    routed = materialise(routed, "routed").select("name", F.struct("name", "vector").alias("entry"), F.explode("lists").alias("list"))
    met = postings.hint("merge").join(_blocks(routed, QUERY_BLOCK, "queries"), "list")
    scored = met.select("postings", "queries").mapInArrow(functools.partial(_meet, kind=kind, k=most), SCORED)
    top = _top(scored, most).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    # Members of a large class are dealt over several copies of its answer.
    shares = top.join(members.withColumnRenamed("name", "query"), "query")
    shares = shares.withColumn("share", F.explode(F.sequence(F.lit(0), F.floor(F.col("members") / 4096).cast("int"))))
    answers = asked.join(members, "name").withColumn(
        "share", F.pmod(F.xxhash64("query_id"), F.floor(F.col("members") / 4096) + 1).cast("int")
    )
    answers = answers.select("query_id", F.col("name").alias("query"), "share").join(shares.drop("members"), ["query", "share"])
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    rows = answers.select("query_id", F.posexplode(others).alias("at", "x"))
    return rows.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Entries of a list in blocks of about ``size``, dealt by hash: (list, entries)."""
    counts = rows.groupBy("list").agg(F.count("*").alias("n"))  # a row for each centre
    block = F.pmod(F.xxhash64("name"), F.ceil(F.col("n") / size))
    cut = rows.join(F.broadcast(counts), "list").withColumn("block", block)
    return cut.groupBy("list", "block").agg(F.collect_list("entry").alias(name)).drop("block")
