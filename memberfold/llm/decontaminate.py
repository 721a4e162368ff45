"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by the size of their shingle sets. Each size partition has its
own sketch length: the smallest hashes of an item, as many as guarantee that a
document which contains the wanted share of the item holds at least one of them. A
document's shingles are looked up among these sketches, whatever the document's
length; items shorter than a shingle are looked up among runs of their own length. The pairs
found are then verified by the exact share of the item's shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.llm.common import small, written

WORDS = 5
# The white space between words.
SPACES = " \t\n\x0b\x0c\r"
# Hundredths of an item's shingles that a document must hold.
CONTAINED = 80


def _with_words(text: Column, of: Callable[[Column], Column], kind: str) -> Column:
    """An array made from the lower-cased words of a text; empty without words.

    The words are bound by an outer lambda, so that a text is cut once, however often
    its words are used.
    """
    trimmed = F.btrim(F.lower(text), F.lit(SPACES))
    cut = F.transform(F.array(F.split(trimmed, f"[{SPACES}]+")), of)
    return F.when(trimmed != "", F.element_at(cut, 1)).otherwise(F.array().cast(kind))


def _starts(words: Column, k: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))


def runs(text: Column, k: int = WORDS, short: Sequence[int] = ()) -> Column:
    """The k-word shingles of a text as often as they come, lower-cased, as text.

    Fewer words: the whole sequence as one. No words or a null text: an empty array.
    ``short`` lists lengths below k whose runs are wanted as well.
    """

    def of(words: Column) -> Column:
        def every(n: int) -> Column:
            return F.transform(_starts(words, n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))

        return F.concat(*map(every, (k, *short)))

    return _with_words(text, of, "array<string>")


def run_hashes(text: Column, k: int = WORDS, short: Sequence[int] = ()) -> Column:
    """A 64-bit hash for each of ``runs``, from hashes of the words."""

    def whole(codes: Column) -> Column:
        return F.xxhash64(F.size(codes), codes)

    def cut(codes: Column, n: int) -> Column:
        return F.transform(_starts(codes, n), lambda i: whole(F.slice(codes, i + 1, n)))

    def of(words: Column) -> Column:
        coded = F.transform(words, lambda w: F.xxhash64(w))

        def each(codes: Column) -> Column:
            run = F.transform(_starts(codes, k), lambda i: F.xxhash64(*[F.get(codes, i + j) for j in range(k)]))
            every = F.when(F.size(codes) >= k, run).otherwise(F.array(whole(codes)))
            # Short runs are hashed as the items that are so long.
            return F.concat(every, *[cut(codes, n) for n in short])

        return F.element_at(F.transform(F.array(coded), each), 1)

    return _with_words(text, of, "array<bigint>")


def sketch_length(size: Column, percent: int = CONTAINED) -> Column:
    """Hashes of an item that suffice, from the largest size of its size partition.

    Of n shingles a match holds all but (100 - percent) n / 100, so one more than that
    cannot all be missing. Size partitions double in width: 1, 2-3, 4-7, 8-15, ...
    """
    largest = F.pow(2.0, F.floor(F.log2(size.cast("double"))) + 1) - 1
    return (F.floor(largest * (100 - percent) / 100) + 1).cast("int")


def item_shingles(items: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """``item_id, size, shingle, hash, sketched`` of ``item_id, text``, a row per shingle.

    Rows that repeat an id are put together: the item is the union of their shingles.
    """
    both = F.arrays_zip(run_hashes(F.col("text")).alias("hash"), runs(F.col("text")).alias("shingle"))
    parts = items.select("item_id", F.inline(both)).distinct()
    sets = parts.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("hash", "shingle"))).alias("shingles")
    )
    each = sets.select(
        "item_id", F.size("shingles").alias("size"), F.posexplode("shingles").alias("at", "one")
    )
    sketched = F.col("at") < sketch_length(F.col("size"), percent)
    return each.select("item_id", "size", "one.shingle", "one.hash", sketched.alias("sketched"))


def contained_items(documents: DataFrame, items: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """``doc_id, item_id, item_size, n_found`` where a document contains an item.

    Contained: at least ``percent`` hundredths of the item's distinct five-word shingles
    occur in the document, wherever they stand. Items without words match nothing; an item
    of fewer than five words is one shingle, of its own length, and is looked for among the
    documents' runs of that length. Rows
    that repeat a doc_id count as one document; rows with a null doc_id or item_id are
    left out, as no result could name them.
    """
    documents = documents.select("doc_id", "text").where("doc_id IS NOT NULL")
    items = items.select("item_id", "text").where("item_id IS NOT NULL")
    items = written(item_shingles(items, percent), "items")
    # At most WORDS - 1 numbers: the lengths of the items that are shorter than a shingle.
    length = F.size(F.split("shingle", " "))
    short = sorted(r[0] for r in items.select(length.alias("n")).where(F.col("n") < WORDS).distinct().collect())
    sketches = items.where("sketched").select("item_id", F.col("hash").alias("sketch"))
    found = (
        documents.select("doc_id", F.explode(run_hashes(F.col("text"), short=short)).alias("hash"))
        .join(small(sketches), F.col("hash") == F.col("sketch"))
        .select("doc_id", "item_id")
        .distinct()
    )
    candidates = written(found, "candidates")
    wanted = small(candidates.select("doc_id").distinct())
    texts = documents.join(wanted, "doc_id", "left_semi")
    held = texts.select("doc_id", F.explode(runs(F.col("text"), short=short)).alias("shingle"))
    exact = (
        held.join(small(items.select("item_id", "size", "shingle")), "shingle")
        .groupBy("doc_id", "item_id")
        .agg(F.first("size").alias("item_size"), F.countDistinct("shingle").alias("n_found"))
    )
    return (
        exact.join(candidates, ["doc_id", "item_id"], "left_semi")
        .where(F.col("n_found") * 100 >= F.col("item_size") * percent)
        .select("doc_id", "item_id", "item_size", "n_found")
    )


def without_items(documents: DataFrame, items: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """The documents, whole rows, that contain none of the items; a null doc_id stays."""
    found = contained_items(documents, items, percent).select("doc_id").distinct()
    found = small(written(found, "contaminated"))
    return documents.join(found, "doc_id", "left_anti").select(
        *documents.columns
    )
