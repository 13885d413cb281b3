"""Approximate nearest neighbours by collision counting over sorted projections.

All vectors are dealt by a hash of their row into blocks of about ``block`` rows, all queries into
chunks, and each task works on one block and one chunk. A block has ``projections`` arrays, each sorted
by one random projection. A query opens a window around its own projection in every array and all windows
grow together, along a ladder of widths, without hashing anything again; a vector collides once for each
window it is in, and one whose count reaches the threshold is verified on the original vectors. The query takes
the narrowest step of the ladder at which enough vectors are verified, which is found by halving, as counts
only grow with the width. Windows end at one of ``marks`` ranks of their array. For each mark a bitmap tells the
vectors before it, so a window is the difference of two bitmaps, and the windows of a query are added up in binary
counters, one machine word for 64 vectors.

How many of a block's different vectors are verified is a property of the whole table: ``SHARE`` of a table of
2,000 different vectors, less in a larger one by the power ``FALL``, and ``k`` more. So recall depends neither on
the number of blocks nor on copies: equal vectors are one candidate, and the ids behind it are looked up
afterwards. The best ``k`` of each block are merged.

For inner products the block's vectors are divided by their largest norm and get one more component
that makes all norms 1, and queries are scaled to norm 1; nearness in the enlarged space has the order
of the inner products.

Contract. A row with a null id, or whose vector is null, empty, zero, or has null or non-finite
components, takes no part. Vectors of another length than the query's are no candidates. Candidates are
all rows with another id than the query's, repeated rows included; a repeated query row is answered
once for each row. Scores are sums of products in double precision, the same for equal vectors; ties go
to the smaller id. Queries with fewer than ``k`` candidates get all. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import prepare, quoted

#: Rows of a block and queries of a chunk, about, and queries counted at once.
BLOCK, CHUNK, TOGETHER = 8192, 8192, 64
PROJECTIONS, MARKS = 128, 128
#: First half width of the windows, the factor between two steps, and the share of collisions asked for.
WIDTH, GROWTH, COLLISIONS = 0.3, 1.05, 0.65
#: Share of the different vectors that is verified if there are ``USUAL``, and the power it falls by.
SHARE, USUAL, FALL = 0.36, 2000, 0.3


def share_of(different: int) -> float:
    """The share of a block's different vectors to verify, in a table with so many of them."""
    return min(1.0, SHARE * (USUAL / max(1, different)) ** FALL)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), np.float64).reshape(-1, size)


def _different(data: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place for each different vector, and by vector the places of its ``most`` smallest ids: (places, ends, members)."""
    raw = np.ascontiguousarray(data + 0.0)  # one zero only
    _, first, which = np.unique(raw.view(np.dtype((np.void, raw.itemsize * raw.shape[1]))).ravel(), return_index=True, return_inverse=True)
    order = np.lexsort((ids, which))
    starts = np.searchsorted(which[order], np.arange(len(first)))
    order = order[np.arange(len(order)) - starts[which[order]] < most]
    return first, np.searchsorted(which[order], np.arange(len(first) + 1)), order


class Windows:
    """Sorted projections of a block, as bitmaps of the vectors before each mark."""

    def __init__(self, places: np.ndarray, marks: int):
        n, self.projections = places.shape
        marks = min(marks, n)
        self.n, words = n, -(-n // 64)
        edges = np.arange(marks + 1) * n // marks
        order = np.argsort(places, axis=0, kind="stable")
        line = np.take_along_axis(places, order, axis=0)
        self.first, self.last = line[edges[:-1]].T.copy(), line[edges[1:] - 1].T.copy()
        self.before = np.zeros((self.projections, marks + 1, words * 8), np.uint8)
        rank = np.empty(n, np.int64)
        for j in range(self.projections):
            rank[order[:, j]] = np.arange(n)
            bits = np.packbits(rank < edges[:, None], axis=1, bitorder="little")
            self.before[j, :, : bits.shape[1]] = bits
        self.before = self.before.view(np.uint64)

    def reached(self, centre: np.ndarray, width: np.ndarray, least: int) -> np.ndarray:
        """A bit for each vector (by query) that is in ``least`` or more of the windows ``centre`` +- ``width``."""
        bits = self.projections.bit_length()
        waiting: list[list[np.ndarray]] = [[] for _ in range(bits + 2)]

        def add(weight: int, bitmap: np.ndarray) -> None:
            own = waiting[weight]
            own.append(bitmap)
            if len(own) == 3:  # three bits make a sum and a carry
                a, b, c = own
                either = a ^ b
                waiting[weight] = [either ^ c]
                add(weight + 1, (a & b) | (c & either))

        for j in range(self.projections):
            # outward to the next mark
            low = np.searchsorted(self.last[j], centre[:, j] - width, "left")
            high = np.searchsorted(self.first[j], centre[:, j] + width, "right")
            add(0, self.before[j, np.maximum(low, high)] ^ self.before[j, low])
        # counters start so that they overflow at ``least``
        ones = np.full_like(waiting[0][0], np.iinfo(np.uint64).max) if least else None
        start = (1 << bits) - least
        for weight in range(bits):
            if start >> weight & 1:
                add(weight, ones)
            while len(waiting[weight]) > 1:
                a, b = waiting[weight][:2]
                waiting[weight] = [a ^ b, *waiting[weight][2:]]
                add(weight + 1, a & b)
        over = np.zeros((len(centre), self.before.shape[2]), np.uint64)
        for bitmap in [b for own in waiting[bits:] for b in own]:
            over |= bitmap
        return over


def candidates(
    data: np.ndarray, queries: np.ndarray, enough: int, rng: np.random.Generator,
    projections: int = PROJECTIONS, marks: int = MARKS, width: float = WIDTH, growth: float = GROWTH,
    collisions: float = COLLISIONS,
) -> Iterator[np.ndarray]:
    """For each query the rows of ``data`` whose collision counts reached the threshold, at least ``enough`` of them."""
    n = len(data)
    enough = min(n, enough)
    # scaled first, so that squares of very large or small components stay finite
    unit = data / np.abs(data).max()
    unit = unit / np.sqrt((unit * unit).sum(axis=1)).max()
    queries = queries / np.abs(queries).max(axis=1, keepdims=True)
    rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
    directions = rng.standard_normal((data.shape[1] + 1, projections))
    places = np.column_stack([unit, rest]) @ directions
    centre = (queries / np.sqrt((queries * queries).sum(axis=1))[:, None]) @ directions[:-1]
    windows = Windows(places, marks)
    least = math.ceil(collisions * projections)
    # the last step of the ladder holds everything
    widest = np.abs(places).max() + np.abs(centre).max()
    top = max(0, math.ceil(math.log(widest / width, growth))) + 1
    usual = (-1, top)
    for at in range(0, len(queries), TOGETHER):
        own = centre[at : at + TOGETHER]
        low = np.full(len(own), usual[0])  # too narrow, as far as is known
        high = np.full(len(own), top)
        best = np.full((len(own), windows.before.shape[2]), np.iinfo(np.uint64).max)
        step = np.full(len(own), usual[1])
        going = np.arange(len(own)) if usual[1] < top else np.empty(0, np.int64)
        while True:
            if len(going):
                met = windows.reached(own[going], width * growth ** step[going], least)
                full = np.bitwise_count(met).sum(axis=1) >= enough
                best[going[full]], high[going[full]] = met[full], step[going[full]]
                low[going[~full]] = np.maximum(low[going[~full]], step[going[~full]])
            going = np.flatnonzero(high - low > 1)
            if not len(going):
                break
            step = (low + high) // 2
        # where this batch ended the next one begins to look
        usual = (max(-1, int(high.min()) - 4), min(top, int(high.max()) + 1))
        for bits in np.unpackbits(best.view(np.uint8), axis=1, bitorder="little"):
            yield np.flatnonzero(bits[:n])


def _nearest(data: np.ndarray, query: np.ndarray, wanted: int) -> np.ndarray:
    """Places that hold the ``wanted`` largest products and, as sums may be rounded, all close to them."""
    if len(data) <= wanted:
        return np.arange(len(data))
    with np.errstate(over="ignore", invalid="ignore"):
        scores = data @ query
        near = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
        slack = 1e-9 * (np.abs(data).max() * np.abs(query).sum())
    # where products overflow nothing is left out
    return np.flatnonzero(scores >= near - slack) if np.isfinite(slack) and np.isfinite(scores).all() else np.arange(len(data))


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    block: int = BLOCK, chunk: int = CHUNK, seed: int = 20,
) -> DataFrame:
    """``query_id``, ``rank``, the key and ``score`` of the ``k`` nearest found of each query."""
    prepare(vectors.sparkSession)
    value = quoted(vector).cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    valid = quoted(key).isNotNull() & (F.size(value) > 0) & finite & F.exists(value, lambda v: v != 0)
    rows = vectors.where(F.coalesce(valid, F.lit(False))).select(
        quoted(key).alias("id"), value.alias("v"), F.size(value).alias("size"),
        F.monotonically_increasing_id().alias("row"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.approx_count_distinct(F.xxhash64("v"))).first()
    share = share_of(sizes[2])
    blocks, chunks = max(1, math.ceil(sizes[0] / block)), max(1, math.ceil(sizes[1] / chunk))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("id", "v", "size", deal(blocks).alias("block"), every(chunks).alias("chunk"))
    asked = rows.where("asks").select("id", "v", "row", "size", deal(chunks).alias("chunk"), every(blocks).alias("block"))
    kind = rows.schema["id"].dataType

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(left) and len(right):
            size = right["size"][0].as_py()
            ids = np.asarray(left["id"].combine_chunks())
            asked_ids = np.asarray(right["id"].combine_chunks())
            data, queries = _matrix(left["v"], size), _matrix(right["v"], size)
            # rows of the query's own id are asked for on top, as they are no answers
            own, times = np.unique(ids, return_counts=True)
            more = int(times[np.isin(own, asked_ids)].max(initial=0))
            places, ends, members = _different(data, ids, k + more)
            different = data[places]
            enough = k + more + math.ceil(share * len(different))
            found = candidates(different, queries, enough, np.random.default_rng(seed))
            for q, (query, reps) in enumerate(zip(queries, found)):
                reps = reps[_nearest(different[reps], query, k + more)]
                times = ends[reps + 1] - ends[reps]
                near = members[np.repeat(ends[reps + 1] - times.cumsum(), times) + np.arange(times.sum())]
                near = near[ids[near] != asked_ids[q]]
                scores = (data[near] * query).sum(axis=1)
                best = np.lexsort((ids[near], -scores))[:k]
                out[0].extend([asked_ids[q]] * len(best))
                out[1].extend([right["row"][q].as_py()] * len(best))
                out[2].extend(ids[near][best])
                out[3].extend(scores[best])
        types = [left.schema.field("id").type, pa.int64(), left.schema.field("id").type, pa.float64()]
        return pa.table([pa.array(c, type=t) for c, t in zip(out, types)], names=["query_id", "row", "id", "score"])

    name = kind.simpleString()
    keys = ["size", "block", "chunk"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        work, f"query_id {name}, row bigint, id {name}, score double"
    )
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
