"""Exact search for the largest inner products, by buckets of vector length.

Vectors are sorted by length and packed into buckets of bounded size. A query that has
found k products needs, in a bucket whose longest vector is l, a cosine of at least its
threshold / (|query| l): above one the bucket is left out. A low local threshold prunes the
bucket by length alone and takes products of the rest; a high one bounds single coordinates
of the vectors wanted, and products are taken only where all of them fit. Components and
products are whole numbers, so what is found is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from memberfold.llm.common import written

# Components are floor(SCALE * x).
SCALE = 256
# Squared lengths stay below this, so that every product is a long.
SQUARE_LIMIT = 1 << 62
# Bytes of a bucket, buckets of a group, and bytes of the queries that meet a group at a time.
BUCKET_BYTES, GROUP_BUCKETS, QUERY_BYTES = 1 << 20, 4, 1 << 19
# From this local cosine threshold on, coordinates prune; so many of each query's largest.
COORDINATE_FROM, FOCUS = 0.9, 4
# Allowed for rounding of lengths and cosines.
SLACK = 1e-5
# Queries whose products with a bucket are held at a time.
STRIP = 256
_NONE = -SQUARE_LIMIT - 1

_VECTOR = "vec_id long, square long, vector binary"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as whole numbers, of the vectors that take part."""
    for batch in batches:
        out = []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = vector.values
            if vec_id is None or values is None or values.null_count:
                continue
            x = np.floor(values.to_numpy().astype(np.float64) * SCALE)
            if len(x) and not np.abs(x).max() < 1 << 31:  # nor is a NaN
                continue
            square = sum(int(v) ** 2 for v in x) if np.dot(x, x) >= 1 << 53 else int(np.dot(x, x))
            if square < SQUARE_LIMIT:
                out.append((vec_id, square, x.astype("<i4").tobytes()))
        yield _batch(out, _VECTOR)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    """A row a vector; shorter ones end in zeros."""
    width = max(map(len, vectors))
    joined = b"".join(v.ljust(width, b"\0") for v in vectors)
    return np.frombuffer(joined, "<i4").reshape(len(vectors), width // 4)


_BUCKET = "part long, at long, n int, largest long, ids binary, squares binary, width int, matrix binary"


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs vectors, longest first, into rows of bounded size."""
    part, at, held, size = TaskContext.get().partitionId(), 0, [], 0

    def packed() -> pa.RecordBatch:
        ids, squares, vectors = zip(*held)
        matrix = _matrix(vectors)
        arrays = np.array(ids, "<i8").tobytes(), np.array(squares, "<i8").tobytes()
        row = (part, at, len(ids), squares[0], *arrays, matrix.shape[1], matrix.tobytes())
        return _batch([row], _BUCKET)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and size + len(row[2]) > BUCKET_BYTES:
                yield packed()
                at, held, size = at + 1, [], 0
            held.append(row)
            size += len(row[2]) + 16
    if held:
        yield packed()


class Vectors:
    """The vectors of a bucket, or queries: ids, squared lengths and components."""

    def __init__(self, ids: bytes, squares: bytes, width: int, matrix: bytes, **rest):
        self.ids, self.squares = np.frombuffer(ids, "<i8"), np.frombuffer(squares, "<i8")
        self.matrix = np.frombuffer(matrix, "<i4").reshape(len(self.ids), width)
        self.lengths = np.sqrt(self.squares.astype(np.float64))

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.matrix, ((0, 0), (0, width - self.matrix.shape[1])))


_QUERY = "chunk long, ids binary, squares binary, width int, matrix binary, own binary"


def _queries(every: int):
    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs the rows that are queries, each with the place of its own row."""
        task, chunks, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            ids, squares, own, vectors = zip(*held)
            matrix = _matrix(vectors)
            arrays = np.array(ids, "<i8").tobytes(), np.array(squares, "<i8").tobytes()
            own = np.array(own, "<i8").tobytes()
            return _batch([(task << 32 | chunks, *arrays, matrix.shape[1], matrix.tobytes(), own)], _QUERY)

        for batch in batches:
            for row in batch.to_pylist():
                bucket = Vectors(**row)
                for k in np.flatnonzero(bucket.ids % every == 0).tolist():
                    own, vector = (row["part"], row["at"], k), bucket.matrix[k].tobytes()
                    held.append((int(bucket.ids[k]), int(bucket.squares[k]), own, vector))
                    size += len(vector) + 40
                    if size >= QUERY_BYTES:
                        yield packed()
                        chunks, held, size = chunks + 1, [], 0
        if held:
            yield packed()

    return queries


class Search:
    """The k best products of some queries with the buckets given so far."""

    def __init__(self, queries: Vectors, own: bytes, k: int, floors: bytes | None = None):
        self.queries, self.k = queries, k
        self.own = np.frombuffer(own, "<i8").reshape(-1, 3)
        n = len(queries.ids)
        # No product below the floor is wanted, whatever has been found so far.
        self.floors = np.full(n, _NONE) if floors is None else np.frombuffer(floors, "<i8")
        self.scores, self.found = np.full((n, k), _NONE), np.full((n, k), np.iinfo(np.int64).max)

    def bars(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floors)

    def cosines(self, longest: float) -> np.ndarray:
        """The cosine that each query needs in a bucket; minus infinity if anything does."""
        bars = self.bars()
        threshold = bars.astype(np.float64)
        reach = self.queries.lengths * longest
        with np.errstate(divide="ignore", invalid="ignore"):
            wanted = np.where(reach > 0, threshold / reach, np.where(threshold > 0, np.inf, -np.inf))
        return np.where(bars == _NONE, -np.inf, wanted)

    def bucket(self, part: int, at: int, bucket: Vectors) -> None:
        wanted = self.cosines(bucket.lengths[0])
        own = np.where((self.own[:, 0] == part) & (self.own[:, 1] == at), self.own[:, 2], -1)
        width = max(self.queries.matrix.shape[1], bucket.matrix.shape[1])
        asked, rows = self.queries.widened(width), bucket.widened(width)
        # Sums of whole numbers are exact as long as no part of them can leave the mantissa.
        most = self.queries.lengths.max() * bucket.lengths[0] * (1 + SLACK)
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        asked, rows = asked.astype(kind), rows.astype(kind)
        low = np.flatnonzero(wanted < COORDINATE_FROM)
        for strip in np.split(low, range(STRIP, len(low), STRIP)):
            if len(strip):
                self._by_length(strip, wanted[strip], own[strip], asked, rows, bucket)
        high = np.flatnonzero((wanted >= COORDINATE_FROM) & (wanted <= 1 + SLACK))
        if len(high):
            self._by_coordinates(high, own, asked, rows, bucket)

    def _by_length(self, some, wanted, own, asked, rows, bucket) -> None:
        """Products with the vectors that are long enough for at least one of the queries."""
        least = wanted.min() * bucket.lengths[0] * (1 - SLACK)
        n = int(np.searchsorted(-bucket.lengths, -least, "right")) if least > 0 else len(rows)
        products = (asked[some] @ rows[:n].T).astype(np.int64)
        mine = np.flatnonzero((own >= 0) & (own < n))
        products[mine, own[mine]] = _NONE
        bar = self.bars()[some]
        unset = np.flatnonzero(bar == _NONE)
        if n > self.k and len(unset):
            bar[unset] = np.partition(products[unset], n - self.k, axis=1)[:, n - self.k]
        equal = (products == bar[:, None]) & (bucket.ids[:n] < self.found[some, -1][:, None])
        at, row = np.nonzero(((products > bar[:, None]) | equal) & (products > _NONE))
        self._merge(some[at], products[at, row], bucket.ids[row])

    def _by_coordinates(self, some, own, asked, rows, bucket) -> None:
        """Products with the vectors whose focus coordinates allow the cosine wanted.

        If the cosine of q and p is c at least, p's coordinate lies within
        q c -+ sqrt((1 - q^2) (1 - c^2)), but for sides on which it is free.
        """
        with np.errstate(divide="ignore", invalid="ignore"):
            columns = np.nan_to_num(rows / bucket.lengths[:, None]).T.astype(np.float32).copy()
        for query in some.tolist():
            c = min(float(self.cosines(bucket.lengths[0])[query]), 1.0)
            unit = asked[query] / self.queries.lengths[query]
            fits = np.ones(len(rows), bool)
            for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist():
                q = float(unit[f])
                spread = math.sqrt(max(0.0, (1 - q * q) * (1 - c * c)))
                if q >= -c:
                    fits &= columns[f] >= q * c - spread - SLACK
                if q <= c:
                    fits &= columns[f] <= q * c + spread + SLACK
            if own[query] >= 0:
                fits[own[query]] = False
            left = np.flatnonzero(fits)
            products = (rows[left] @ asked[query]).astype(np.int64)
            good = products >= max(self.scores[query, -1], self.floors[query])
            self._merge(np.full(int(good.sum()), query), products[good], bucket.ids[left[good]])

    def _merge(self, queries: np.ndarray, products: np.ndarray, ids: np.ndarray) -> None:
        if not len(queries):
            return
        touched = np.unique(queries)
        queries = np.concatenate([queries, np.repeat(touched, self.k)])
        products = np.concatenate([products, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.found[touched].ravel()])
        order = np.lexsort((ids, -products, queries))
        queries, products, ids = queries[order], products[order], ids[order]
        first = np.searchsorted(queries, touched)[:, None] + np.arange(self.k)
        self.scores[touched], self.found[touched] = products[first], ids[first]


_FLOORS = _QUERY + ", floors binary, least double"


def _floors(seed: dict, k: int):
    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Thresholds from the longest vectors, and the length that a bucket must have for them."""
        bucket = Vectors(**seed)
        for batch in batches:
            for row in batch.to_pylist():
                search = Search(Vectors(**row), row["own"], k)
                search.bucket(seed["part"], seed["at"], bucket)
                least = float(np.nan_to_num(search.cosines(1.0), nan=0.0, posinf=np.inf, neginf=0.0).min())
                floors = search.scores[:, -1].astype("<i8").tobytes()
                yield _batch_of_floors({**row, "floors": floors, "least": least * (1 - SLACK)})

    return floors


def _batch_of_floors(row: dict) -> pa.RecordBatch:
    fields = [f.split(" ") for f in _FLOORS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.RecordBatch.from_arrays(
        [pa.array([row[name]], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields]
    )


_FOUND = "query_id long, q_part long, q_at long, q_row long, vec_id long, score long"


def _searched(k: int):
    def searched(buckets: pa.Table, queries: pa.Table) -> pa.Table:
        out = [np.zeros((0, 6), np.int64)]
        rows = sorted(buckets.to_pylist(), key=lambda r: (r["part"], r["at"]))
        for asked in queries.to_pylist() if rows else ():
            search = Search(Vectors(**asked), asked["own"], k, asked["floors"])
            for row in rows:
                search.bucket(row["part"], row["at"], Vectors(**row))
            real = search.found < np.iinfo(np.int64).max
            at, place = np.nonzero(real)
            found = search.queries.ids[at], *search.own[at].T, search.found[at, place], search.scores[at, place]
            out.append(np.stack(found, axis=1))
        found = np.concatenate(out)
        names = [f.split(" ")[0] for f in _FOUND.split(", ")]
        return pa.table({name: pa.array(found[:, c], pa.int64()) for c, name in enumerate(names)})

    return searched


def largest_products(vectors: DataFrame, k: int = 5, every: int = 50, column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest products, ties to smaller ids.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but
    the query's own. Components become floor(256 x). Fewer than k candidates are all
    returned. Vectors that are null, hold null or non-finite components, have a null vec_id
    or a squared length of 2^62 or more (their products are no longs) take no part. Of
    vectors of different widths the shorter one goes on with zeros; an empty one scores 0.
    Rows that repeat a vec_id are rows of their own: each is a candidate, and a query where
    its id makes it one. An empty table gives no rows; other columns are not looked at.

    Groups of buckets and chunks of queries of bounded size meet in pairs, but for pairs in
    which no bucket is long enough for any query's threshold. No task holds more than one
    group and the chunks of one pair.
    """
    whole = vectors.select(F.col("vec_id").cast("long"), column).mapInArrow(_whole, _VECTOR)
    ordered = whole.repartitionByRange(F.col("square").desc(), "vec_id")
    ordered = ordered.sortWithinPartitions(F.col("square").desc(), "vec_id")
    buckets = written(ordered.mapInArrow(_buckets, _BUCKET), "buckets")
    size = F.sum(F.length("matrix")) / every / QUERY_BYTES
    tasks = math.ceil(buckets.agg(size).first()[0] or 0)
    spark = vectors.sparkSession
    seed = buckets.orderBy("part", "at").limit(1).collect()
    if not seed:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = buckets.coalesce(max(1, tasks)).mapInArrow(_queries(every), _QUERY)
    queries = written(queries.mapInArrow(_floors(seed[0].asDict(), k), _FLOORS), "queries")
    buckets = buckets.withColumn("piece", F.floor(F.col("at") / GROUP_BUCKETS))
    groups = buckets.groupBy("part", "piece").agg(F.sqrt(F.max("largest").cast("double")).alias("longest"))
    # Whatever the query set, its chunks meet all groups that are long enough.
    pairs = groups.join(queries.select("chunk", "least"), F.col("longest") >= F.col("least"))
    pairs = written(pairs.select("part", "piece", "chunk"), "pairs")
    meeting = ["part", "piece", "chunk"]
    left = buckets.join(pairs, ["part", "piece"]).select(*meeting, *_names(_BUCKET)[1:])
    right = queries.join(pairs, "chunk").select(*meeting, *_names(_FLOORS)[1:])
    found = left.groupBy(*meeting).cogroup(right.groupBy(*meeting)).applyInArrow(_searched(k), _FOUND)
    best = Window.partitionBy("query_id", "q_part", "q_at", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _names(schema: str) -> list[str]:
    return [f.split(" ")[0] for f in schema.split(", ")]
