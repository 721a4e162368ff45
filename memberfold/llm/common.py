"""Helpers shared by the operators: words, intermediate tables, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from memberfold.session import shared_folder

# A word is a run of anything but the six ASCII white space characters. In Python
# `bytes.split()` cuts at exactly these, and `bytes.lower()` lowers A-Z only.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows that may be broadcast; a longer table is joined by a shuffle.
BROADCAST_ROWS = 200_000
# Bytes of text that a Python worker handles at a time (a longer text comes alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``written``, with the number of rows, told by the write itself."""
    rows = Observation()
    df = written(df.observe(rows, F.count(F.lit(1)).alias("n")), name)
    return df, rows.get["n"]


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a count shows that the table keeps to the limit of a broadcast."""
    return df.limit(limit + 1).count() <= limit


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint, if a count shows that the table keeps to the limit."""
    return F.broadcast(df) if is_small(df, limit) else df


def small_written(df: DataFrame, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """As ``small(written(df, name))``, without a query for the count."""
    df, n = counted(df, name)
    return F.broadcast(df) if n <= limit else df


def small_part(df: DataFrame, n: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """As ``small``, for rows out of a table of n: they are counted only if it is too long."""
    return F.broadcast(df) if n <= limit else small(df, limit)


def ascii_lower(column: Column | str) -> Column:
    return F.translate(column, UPPER, LOWER)


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sliced(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each slice stay within a number of bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + limit, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, short ones kept while they take few enough bytes."""

    LIMIT = 16 << 20  # bytes
    LONGEST, ENTRY = 64, 150  # bytes of a word that is kept, and of an entry beside its word
    kept = 0

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.LONGEST:
            if self.kept >= self.LIMIT:
                self.clear()
                self.kept = 0
            self[word] = value
            self.kept += len(word) + self.ENTRY
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of texts, end to end, as numbers of distinct ones, and the bounds of each text's.

    A null text has none. With ``lower`` A-Z are lowered first.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    # White space at an end of a text leaves an empty word there.
    empty = np.fromiter((not w for w in words), bool, len(words))
    which = coded.indices.to_numpy()
    is_word = ~empty[which]
    upto = np.concatenate([[0], np.cumsum(is_word)])
    sizes = pc.list_value_length(parts).to_numpy()
    return which[is_word], words, upto[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, end to end, and the bounds of each text's in them.

    Only the distinct words of these texts are hashed, one by one; nothing is kept.
    """
    import xxhash

    which, words, bounds = split_words(texts, lower)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[which], bounds


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finalizer of splitmix64)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words, from the hashes of the words.

    Polynomial hashes of runs of doubling length are put together to length k.
    """
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, have, power = np.zeros(n, np.uint64), 0, words
    factor, length = 0x9E3779B97F4A7C15, 1
    while True:
        if k & length:
            total = total * np.uint64(factor) + power[have : have + n]
            have += length
        if 2 * length > k:
            return mixed(total + np.uint64(k))
        power = power[: len(power) - length] * np.uint64(factor) + power[length:]
        factor = factor * factor % (1 << 64)
        length *= 2
