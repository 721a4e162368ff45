"""Jaccard self-join of documents on word n-grams, by vertical partitioning.

All n-grams have one global order, rare ones first, and each document's n-grams are cut
where fixed points of that order fall. Two documents that are alike enough share one of
their first n-grams (the prefix of the order), which finds candidates; the fragments
beyond give partial overlaps, counted one fragment at a time and summed for each pair.

Only groups are wanted, not every pair. Candidates that share a prefix n-gram are first
compared with the most central document among them. What that leaves in different
groups is then compared exactly, in blocks of bounded size, and only links that join
groups leave a block.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, GroupedData, Observation, functions as F, types as T

from memberfold.llm.common import counted, run_hashes, sliced, small_part, small_written, word_hashes, written
from memberfold.llm.components import joined_nodes

WORDS = 5
PERCENT = 80
# Cells of the table of counts that orders n-grams; its size does not grow with the data.
CELLS = 1 << 20
ROW = 1024
FRAGMENTS = 4
# Bounds of a block of documents that are compared with each other.
BLOCK_DOCUMENTS, BLOCK_NGRAMS = 256, 500_000
SALTS = 32
_LOW = np.uint64(CELLS - 1)


def _grams(texts: pa.Array, k: int = WORDS) -> list[np.ndarray]:
    """Hashes of each text's k-word n-grams; with fewer words, of the whole sequence."""
    coded, bounds = word_hashes(texts, lower=True)
    runs = run_hashes(coded, k)  # those that reach over the end of a text are left out
    found = []
    for start, end in itertools.pairwise(bounds.tolist()):
        if end - start >= k:
            found.append(runs[start : end - k + 1])
        else:
            found.append(run_hashes(coded[start:end], end - start) if end > start else coded[:0])
    return found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches with the set of n-grams of each text, sorted by hash."""
    for batch in sliced(batches):
        yield batch, [np.unique(g) for g in _grams(batch.column("text"))]


def _set_id(grams: np.ndarray) -> int | None:
    """64-bit identity of a set, signed; equal sets have the same. None if it is empty."""
    import xxhash

    if not len(grams):
        return None
    return int.from_bytes(xxhash.xxh3_64_digest(grams.tobytes()), "big", signed=True)


# --- The global order.


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    total = np.zeros(CELLS, np.int64)
    for batch in sliced(batches):
        grams = np.concatenate([*_grams(batch.column("text")), np.zeros(0, np.uint64)])
        total += np.bincount((grams & _LOW).astype(np.int64), minlength=CELLS)
    if total.any():
        n = CELLS // ROW
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(n), pa.int32()),
                pa.array(np.full(n, salt), pa.int32()),
                pa.array(list(total.reshape(n, ROW)), pa.list_(pa.int64())),
            ],
            names=["row", "salt", "counts"],
        )


def _add(group: pa.Table) -> pa.Table:
    counts = group.column("counts").combine_chunks().values.to_numpy().reshape(-1, ROW).sum(axis=0)
    return pa.table({"row": group.column("row")[:1], "salt": group.column("salt")[:1], "counts": pa.array([counts], pa.list_(pa.int64()))})


def global_order(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequency class of every cell (0 to 31), and the fragments' cut points.

    Counts of all documents' n-grams by cell are summed in two steps; CELLS numbers
    reach the driver.
    """
    kind = "row int, salt int, counts array<long>"
    sums = documents.select("text").mapInArrow(_count, kind)
    sums = sums.groupBy("row", "salt").applyInArrow(_add, kind).groupBy("row").applyInArrow(_add, kind)
    counts = np.zeros((CELLS // ROW, ROW), np.int64)
    # As Arrow columns, as rows would make objects of all numbers.
    for rows in sums.select("row", "counts").toArrow().to_batches():
        counts[rows.column("row").to_numpy()] = rows.column("counts").flatten().to_numpy().reshape(-1, ROW)
    counts = counts.ravel()
    classes = np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), 31).astype(np.uint8)
    mass = np.cumsum(np.bincount(classes, counts, minlength=32))
    cuts = []
    for k in range(1, FRAGMENTS):
        want = mass[-1] * k / FRAGMENTS
        at = min(int(np.searchsorted(mass, want)), 31)
        before = mass[at - 1] if at else 0
        share = (want - before) / max(mass[at] - before, 1)
        cuts.append((at << 58) + int(share * (1 << 58)))
    return classes, np.array(sorted(cuts), np.int64)


def _ordered(grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Keys of n-grams in the global order: by frequency class, then by hash."""
    key = (classes[(grams & _LOW).astype(np.int64)].astype(np.int64) << 58) | (grams >> np.uint64(6)).astype(np.int64)
    return np.sort(key)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


# --- Sets, candidates, fragments.


def _describe(order: Broadcast):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each set's identity, size and prefix; equal sets of a task give it once."""
        done: set[int | None] = {None}
        for batch, sets in _sets(batches):
            sids = [_set_id(s) for s in sets]
            prefixes = []
            for sid, grams in zip(sids, sets):
                new = sid not in done
                if new and len(done) < 200_000:
                    done.add(sid)
                keys = _ordered(grams, order.value[0])[: prefix_length(len(grams))] if new else None
                prefixes.append(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "sid", "n", "prefix"],
            )

    return describe


def _fragments(order: Broadcast):
    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches):
            out = []
            for sid, grams in zip(batch.column("sid").to_pylist(), sets):
                if _set_id(grams) != sid:  # another text of the same doc_id
                    continue
                keys = _ordered(grams, order.value[0])
                parts = np.split(keys, np.searchsorted(keys, order.value[1]))
                out += [(sid, k, part) for k, part in enumerate(parts) if len(part)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[2] for x in out], pa.list_(pa.int64())),
                ],
                names=["sid", "fragment", "grams"],
            )

    return fragments


def _alike(overlap, n, m):
    return overlap * 100 >= (n + m - overlap) * PERCENT


def _compare(group: pa.Table) -> pa.Table:
    """Links of labels between two blocks, as many as join what is not joined yet."""
    sides: list[dict[int, list]] = [{}, {}]
    for side, sid, label, grams in zip(
        group.column("side").to_pylist(), group.column("sid").to_pylist(), group.column("label").to_pylist(), group.column("grams").combine_chunks()
    ):
        sides[side].setdefault(sid, [label]).append(grams.values.to_numpy())
    mine, theirs = ([(sid, x[0], np.unique(np.concatenate(x[1:]))) for sid, x in side.items()] for side in sides)
    found: list[tuple[int, int]] = []
    if mine and theirs:
        common = np.intersect1d(np.concatenate([x[2] for x in mine]), np.concatenate([x[2] for x in theirs]))
        overlap = np.zeros((len(mine), len(theirs)), np.float32)
        for start in range(0, len(common), 4096):
            columns = common[start : start + 4096]
            overlap += _incidence(mine, columns) @ _incidence(theirs, columns).T
        sizes = [np.array([len(x[2]) for x in side], np.int64) for side in (mine, theirs)]
        union = sizes[0][:, None] + sizes[1][None, :] - overlap
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for i, j in np.argwhere(overlap * 100 >= union * PERCENT):
            a, b = find(mine[i][1]), find(theirs[j][1])
            if a != b:
                root[a] = b
                found.append((mine[i][1], theirs[j][1]))
    return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})


def _incidence(side: list[tuple], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(side), len(columns)), np.float32)
    for row, (_, _, grams) in enumerate(side):
        at = np.searchsorted(columns, grams)
        at[at == len(columns)] = 0
        out[row, at[columns[at] == grams]] = 1
    return out


def _first_links(pairs: DataFrame, n_pairs: int, fragments: DataFrame) -> DataFrame:
    """Links of documents with their pivots: partial overlaps by fragment, summed."""
    pivots = small_part(pairs.select(F.col("pivot").alias("sid")).distinct(), n_pairs)
    pivots = fragments.join(pivots, "sid", "left_semi")
    right = pivots.select(F.col("sid").alias("pivot"), "fragment", F.col("grams").alias("pivot_grams"))
    left = fragments.join(small_part(pairs, n_pairs), "sid")
    shared = F.size(F.array_intersect("grams", "pivot_grams")).alias("shared")
    overlaps = left.join(right, ["pivot", "fragment"]).select("sid", "pivot", "n", "pivot_n", "fragment", shared)
    # A text that comes twice under one doc_id has its fragments twice.
    overlaps = overlaps.groupBy("sid", "pivot", "n", "pivot_n", "fragment").agg(F.max("shared").alias("shared"))
    overlaps = overlaps.groupBy("sid", "pivot", "n", "pivot_n").agg(F.sum("shared").alias("overlap"))
    return overlaps.where(_alike(F.col("overlap"), F.col("n"), F.col("pivot_n"))).select(
        F.col("sid").alias("a"), F.col("pivot").alias("b")
    )


def _by_cell(rows: DataFrame) -> GroupedData:
    """Rows grouped by pair of blocks, in a stated number of parts.

    A pair of blocks is few bytes and much work, so parts must not be put together by bytes.
    """
    cell = ["pivot", "kind", "i", "j"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *cell).groupBy(*cell)


def _rest_cells(members: DataFrame, buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of block pairs that may link what the first links leave in different groups.

    The members of a pivot outside the pivot's own group are cut into blocks, and so is
    the group; the former meet both, block by block. What ``labels`` leaves out is its own label.
    """
    labels = labels.select(F.col("node").alias("sid"), F.col("component").alias("label"))
    named = members.select("pivot", "sid", "size.*").join(labels, "sid", "left")
    own = labels.select(F.col("sid").alias("pivot"), F.col("label").alias("own"))
    named = named.join(own, "pivot", "left").withColumn("label", F.coalesce("label", "sid"))
    inside = F.col("label") == F.coalesce("own", "pivot")
    named = written(named.select("pivot", "sid", "n", "alone", "last", "label", inside.alias("inside")), "members")

    def blocks(wanted):
        one = F.when(wanted, F.lit(1)).otherwise(F.lit(0))
        n = F.when(wanted, F.col("n")).otherwise(F.lit(0))
        return F.ceil(F.greatest(F.sum(one) / BLOCK_DOCUMENTS, F.sum(n) / BLOCK_NGRAMS)).cast("int")

    sizes = named.groupBy("pivot").agg(blocks(F.col("inside")).alias("n_in"), blocks(~F.col("inside")).alias("n_out"))
    placed = named.join(sizes.where("n_out > 0"), "pivot")
    spread = F.abs(F.xxhash64("sid") % 1_000_003)
    mine_in, mine_out = (spread % F.col("n_in")).cast("int"), (spread % F.col("n_out")).cast("int")

    def cells(side, kind, first, last, cell):
        made = F.transform(F.sequence(first, last), cell)
        return F.transform(made, lambda c: F.struct(F.lit(side).alias("side"), F.lit(kind).alias("kind"), c["i"].alias("i"), c["j"].alias("j")))

    at = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    zero = F.lit(0)
    from_in = cells(1, 0, zero, F.col("n_out") - 1, lambda i: at(i, mine_in))
    from_out = F.concat(
        F.when(F.col("n_in") > 0, cells(0, 0, zero, F.greatest(F.col("n_in") - 1, zero), lambda j: at(mine_out, j))).otherwise(F.array()),
        cells(0, 1, mine_out, F.col("n_out") - 1, lambda k: at(mine_out, k)),
        cells(1, 1, zero, mine_out, lambda k: at(k, mine_out)),
    )
    spots = F.explode(F.when(F.col("inside"), from_in).otherwise(from_out)).alias("c")
    rows = placed.select("pivot", "sid", "label", "n", "alone", "last", spots)
    rows = rows.select("pivot", "c.kind", "c.i", "c.j", "c.side", "sid", "label", "n", "alone", "last")
    cells, n_cells = counted(_by_cell(rows).applyInArrow(_screen, _CELL), "cells")
    heads = buckets.join(small_part(cells.select("sid").distinct(), n_cells), "sid").groupBy("sid")
    rows = cells.join(heads.agg(F.collect_list("gram").alias("head")), "sid")
    return _by_cell(rows).applyInArrow(_screen_exactly, _CELL)


def _members(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """What shares a prefix n-gram with a pivot, with ``size`` and bounds of both.

    The pivot of an n-gram is the document with the greatest share of shared ones.
    ``alone`` counts the prefix n-grams that no other prefix has, ``last`` is the
    prefix's last n-gram in the global order.
    """
    n = F.col("n")
    prefix = n - F.ceil(n * PERCENT / 100) + 1
    shared = buckets.groupBy("sid").agg(F.count("*").alias("shared")).join(sets, "sid")
    central = shared.select(
        "sid", F.struct("n", (prefix - F.col("shared")).alias("alone"), "last").alias("size"), (F.col("shared") / n).alias("share")
    )
    ranked = buckets.join(central, "sid")
    pivots = ranked.groupBy("gram").agg(F.max(F.struct("share", "sid", "size")).alias("best"))
    pivots = pivots.select("gram", F.col("best.sid").alias("pivot"), F.col("best.size").alias("pivot_size"))
    return ranked.join(pivots, "gram").select("sid", "size", "pivot", "pivot_size").distinct()


def _possible(a, b):
    """Whether two documents may link, by their sizes and prefixes alone.

    Of two documents, that whose prefix ends first has all its common prefix n-grams in
    the other one's prefix as well; those that no other prefix has are not common.
    """
    held = lambda x: x["n"] - x["alone"]
    most = F.when(a["last"] < b["last"], held(a)).when(a["last"] > b["last"], held(b))
    most = most.otherwise(F.least(held(a), held(b)))
    near = F.least(a["n"], b["n"]) * 100 >= F.greatest(a["n"], b["n"]) * PERCENT
    return near & (most * (100 + PERCENT) >= (a["n"] + b["n"]) * PERCENT)


_CELL_NAMES = ["pivot", "kind", "i", "j", "side", "sid", "label", "n", "last"]
_CELL = "pivot long, kind int, i int, j int, side int, sid long, label long, n long, last long"


def _screen(group: pa.Table) -> pa.Table:
    """The rows of two blocks that may link to one of another label across them."""
    side = group.column("side").to_numpy()
    n, alone, last, label = (group.column(c).to_numpy() for c in ("n", "alone", "last", "label"))
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    x, y = a[:, None], b[None, :]
    most = np.where(last[x] < last[y], n[x] - alone[x], n[y] - alone[y])
    most = np.where(last[x] == last[y], np.minimum(n[x] - alone[x], n[y] - alone[y]), most)
    may = (most * (100 + PERCENT) >= (n[x] + n[y]) * PERCENT) & (label[x] != label[y])
    may &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * PERCENT
    rows = np.concatenate([a[may.any(axis=1)], b[may.any(axis=0)]])
    return group.select(_CELL_NAMES).take(pa.array(rows))


def _screen_exactly(group: pa.Table) -> pa.Table:
    """As ``_screen``, by the prefix n-grams that two documents have in common."""
    side = group.column("side").to_numpy()
    n, last, label = (group.column(c).to_numpy() for c in ("n", "last", "label"))
    heads = [(None, None, x.values.to_numpy()) for x in group.column("head").combine_chunks()]
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    common = [np.concatenate([*[heads[k][2] for k in rows], np.zeros(0, np.int64)]) for rows in (a, b)]
    common = np.intersect1d(*common)
    shared = np.zeros((len(a), len(b)))
    for start in range(0, len(common), 4096):
        columns = common[start : start + 4096]
        shared += _incidence([heads[k] for k in a], columns) @ _incidence([heads[k] for k in b], columns).T
    x, y = a[:, None], b[None, :]
    rest = -(-n * PERCENT // 100) - 1  # n-grams after the prefix
    most = np.where(last[x] < last[y], rest[x], rest[y])
    most = np.where(last[x] == last[y], np.minimum(rest[x], rest[y]), most) + shared
    may = (most * (100 + PERCENT) >= (n[x] + n[y]) * PERCENT) & (label[x] != label[y])
    may &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * PERCENT
    rows = np.concatenate([a[may.any(axis=1)], b[may.any(axis=0)]])
    return group.select(_CELL_NAMES).take(pa.array(rows))


def near_groups(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``doc_id, text``.

    Documents link when their sets of five-word shingles (A-Z lowered) have a Jaccard
    similarity of 0.8 or more; equal sets always do. ``component_id`` is the least doc_id
    reachable by links. A document without words (or with a null text) has an empty set
    and stays alone, under its own doc_id; one of fewer than five words has one shingle.
    A null doc_id is never a component's name unless the component has no other.
    """
    return _labelled(documents).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("name", "doc_id").alias("component_id")
    )


def _labelled(documents: DataFrame) -> DataFrame:
    """``doc_id, sid, n, label, name`` of every row: its set, the set's component and its name.

    Labels tell components apart that go by one doc_id, where it comes with unlike texts.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    order = spark.sparkContext.broadcast(global_order(documents))
    kind = "doc_id long, sid long, n long, prefix array<long>"
    described = written(documents.mapInArrow(_describe(order), kind), "sets")
    sets = described.where("sid IS NOT NULL").groupBy("sid")
    of_set = (
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.max(F.array_max("prefix")).alias("last")
    )
    sets = written(sets.agg(*of_set), "distinct")

    rows = described.select(F.explode("prefix").alias("gram"), "sid")
    shared = rows.groupBy("gram").agg(F.min("sid").alias("x"), F.max("sid").alias("y"))
    shared = shared.where("x <> y").select("gram")
    buckets = written(rows.join(shared, "gram").distinct(), "buckets")
    members = written(_members(buckets, sets), "candidates")

    def fragments(sids: DataFrame) -> DataFrame:
        wanted = sids.select("sid").distinct().join(sets.select("sid", F.col("doc_id").alias("of")), "sid")
        wanted = small_written(wanted, "wanted")
        texts = documents.join(wanted, documents["doc_id"].eqNullSafe(F.col("of"))).select("sid", "text")
        kind = "sid long, fragment int, grams array<long>"
        return written(texts.mapInArrow(_fragments(order), kind), "fragments")

    pairs = members.where((F.col("sid") != F.col("pivot")) & _possible(F.col("size"), F.col("pivot_size")))
    pairs = pairs.select("sid", "size.n", "pivot", F.col("pivot_size.n").alias("pivot_n"))
    pairs, n_pairs = counted(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("sid", "pivot")).alias("sid"))
    first = joined_nodes(written(_first_links(pairs, n_pairs, fragments(ends)), "links"))
    cells, n_cells = counted(_rest_cells(members, buckets, first), "cells")
    rows = fragments(cells).select("sid", "grams").join(small_part(cells.drop("n", "last"), n_cells), "sid")
    rest = _by_cell(rows).applyInArrow(_compare, "a long, b long")
    # The rest joins the first links' labels, so that their links need not be gone through again.
    rest = joined_nodes(written(rest, "links"))
    labelled = sets.select("sid", "doc_id")
    for labels in (first.toDF("sid", "first"), rest.toDF("first", "rest")):
        labelled = labelled.join(labels, labels.columns[0], "left")
        old, new = labels.columns
        labelled = labelled.withColumn(new, F.coalesce(new, old))
    joined = labelled.select("sid", "doc_id", F.col("rest").alias("label"))
    names = joined.groupBy("label").agg(F.min("doc_id").alias("name"))
    named = joined.join(names, "label").select(F.col("sid").alias("of"), "label", "name")
    described = described.select("doc_id", "sid", "n")
    return described.join(named, described["sid"] == F.col("of"), "left").select("doc_id", "sid", "n", "label", "name")


@F.arrow_udf(T.LongType())
def _identity(texts: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    return pa.array([_set_id(s) for _, sets in _sets([batch]) for s in sets], pa.int64())


def representatives(documents: DataFrame) -> DataFrame:
    """The documents, whole rows, one of each group: that of the least doc_id.

    Of rows that repeat a doc_id within a group one stays, that of the least text. A doc_id
    whose texts belong to several groups stays once for each group that it names. Rows
    without a doc_id stay, as groups cannot name them.
    """
    groups = written(_labelled(documents).where("doc_id IS NOT NULL"), "groups")
    times = groups.groupBy(F.col("doc_id").alias("__kept")).agg(F.count("*").alias("times"))
    kept = groups.where(F.col("doc_id") == F.coalesce("name", "doc_id"))
    kept = kept.select(F.col("doc_id").alias("__kept"), F.col("sid").alias("__sid"), F.col("label").alias("__label"))
    kept = kept.distinct().join(times, "__kept")
    repeated = Observation()
    kept = written(kept.observe(repeated, F.count(F.when(F.col("times") > 1, 1)).alias("n")), "kept")
    n_several = repeated.get["n"]
    own = documents.columns
    one = documents.join(kept.where("times = 1").select("__kept"), F.col("doc_id") == F.col("__kept"))
    found = one.select(*own).unionByName(documents.where("doc_id IS NULL"))
    if not n_several:
        return found
    several = small_part(kept.where("times > 1").drop("times"), n_several)
    # What may share a doc_id with another text is told apart by its set of n-grams.
    ids = several.select("__kept").distinct()
    rows = documents.join(small_part(ids, n_several), documents["doc_id"] == ids["__kept"], "left_semi")
    rows = rows.withColumn("__set", _identity("text"))
    rows = rows.join(several, (F.col("doc_id") == F.col("__kept")) & F.col("__set").eqNullSafe(F.col("__sid")))
    # A text without words has no label: its group is its doc_id.
    order = F.struct(F.col("text").isNotNull(), "text", F.xxhash64(*[c for c, kind in documents.dtypes if "map<" not in kind]))
    first = rows.groupBy("__label", "__kept").agg(F.min_by(F.struct(*own), order).alias("__row"))
    return found.unionByName(first.select("__row.*"))
