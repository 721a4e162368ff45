"""Lempel-Ziv phrase fingerprints: likeness of documents as a compressor would see it.

A text's UTF-8 bytes are parsed into dictionary phrases (each the longest phrase seen
so far and one byte more); the set of phrases stands for the text. The dictionary starts
anew at places that the contents choose, by one rule for texts of any length. Its fingerprint
holds the smallest hashes of the set, and the share of common phrases is estimated
from two fingerprints alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from memberfold.llm.common import as_bytes, mixed, sliced

# Hashes kept of a phrase set; a smaller set is kept whole and compared exactly.
KEPT = 128
# The dictionary starts anew (the hashes found stay) after every run of RUN bytes whose hash
# begins with so many zero bits: some 256 KB apart on average, at the same places of the same
# contents in texts of any length. A text without such runs repeats itself and has few phrases.
RUN, ZERO_BITS = 8, 18
# Bytes that are searched for such runs at a time.
_BLOCK = 1 << 20
_STEP, _WRAP = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _restarts(data: bytes) -> list[int]:
    """Where a dictionary ends: the ends of the runs that are cuts."""
    found = []
    for start in range(0, len(data) - RUN + 1, _BLOCK):
        n = min(_BLOCK, len(data) - RUN + 1 - start)
        runs = np.ndarray(n, "<u8", data, start, (1,))
        found += (np.flatnonzero(runs * np.uint64(_STEP) < np.uint64(1 << 64 - ZERO_BITS)) + start + RUN).tolist()
    return found


class Parser:
    """Parses bytes into phrases, part by part; a copy goes on from where it was made."""

    def __init__(self) -> None:
        self.found = np.zeros(0, np.uint32)
        self.hashes, self.children, self.node = [0], {}, 0
        self.tail = b""

    def copy(self) -> Parser:
        twin = Parser()
        twin.found, twin.node, twin.tail = self.found, self.node, self.tail
        twin.hashes, twin.children = self.hashes.copy(), self.children.copy()
        return twin

    def feed(self, part: bytes) -> Parser:
        known = len(self.tail)  # bytes of the part before, so that a run may lie across
        joined = self.tail + part
        start = known
        for end in _restarts(joined):
            self._parse(joined[start:end])
            self.found = self.smallest()
            self.hashes, self.children, self.node = [0], {}, 0
            start = end
        self._parse(joined[start:])
        self.tail = joined[-(RUN - 1) :]
        return self

    def _parse(self, part: bytes) -> None:
        hashes, children, node = self.hashes, self.children, self.node
        get = children.get
        for byte in part:
            key = node << 8 | byte
            child = get(key)
            if child is not None:
                node = child
                continue
            children[key] = len(hashes)
            hashes.append(((hashes[node] + byte + 1) * _STEP) & _WRAP)
            node = 0
        self.node = node

    def smallest(self) -> np.ndarray:
        return _smallest(self.found, self.hashes)


def phrase_hashes(text: bytes) -> np.ndarray:
    """The smallest 32-bit hashes of the phrases of a text, in order."""
    return Parser().feed(text).smallest()


def _smallest(found: np.ndarray, hashes: list[int]) -> np.ndarray:
    new = (mixed(np.array(hashes[1:], np.uint64)) >> np.uint64(32)).astype(np.uint32)
    if len(new) > 4 * KEPT:  # enough of the smallest, even with some equal ones
        new = np.partition(new, 2 * KEPT)[: 2 * KEPT]
    return np.unique(np.concatenate([found, new]))[:KEPT]


def fingerprint(text: bytes) -> str:
    """The kept hashes, big-endian, in base64; empty for an empty text."""
    return packed(phrase_hashes(text))


def packed(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype(">u4").tobytes()).decode()


def unpacked(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases: among the smallest hashes of both sets together.

    Two empty texts are alike (1), an empty and another one are not (0).
    """
    if not len(a) and not len(b):
        return 1.0
    smallest = np.union1d(a, b)[:KEPT]
    common = np.isin(smallest, a, assume_unique=True) & np.isin(smallest, b, assume_unique=True)
    return float(common.sum()) / len(smallest)


def fingerprints(documents: DataFrame, column: str = "text", out: str = "fingerprint") -> DataFrame:
    """The documents, whole rows, with the fingerprint of a text column (null: empty)."""

    @F.pandas_udf("string")
    def of(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        return texts.__class__([fingerprint(t) for t in as_bytes(batch.column("text"))], index=texts.index)

    return documents.withColumn(out, of(F.col(column)))


# --- Documents beside an edited form of themselves, and beside the next one.

_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def _parsed(part: int, doc_id: int | None, data: bytes, alone: bool) -> dict:
    """A document's own hashes, and the parser as it was before its last quarter."""
    text = data.decode()
    cut = len(text) // 4
    kept = text[: len(text) - cut].encode()
    parser = Parser().feed(kept)
    before = None if alone else parser.copy()
    hashes = parser.feed(data[len(kept) :]).smallest()
    return {
        "part": part, "doc_id": doc_id, "text": text, "cut": cut, "kept": kept, "before": before, "hashes": hashes
    }


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, borrowed, doc_id: each document meets the row after it."""
    held = None
    for batch in sliced(batches):
        out = []
        columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "borrowed")]
        for part, doc_id, borrowed, text in zip(*columns, as_bytes(batch.column("text"))):
            row = _parsed(part, doc_id, text, bool(borrowed))
            if held is not None and held["part"] == part:
                out.append(_pair(held, row))
            held = None if borrowed else row
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _pair(row: dict, following: dict) -> dict:
    head = following["text"][: row["cut"]].encode()
    edited_hashes = row["before"].feed(head).smallest()
    return {
        "doc_id": row["doc_id"],
        "n_chars": len(row["text"]),
        "edited_sha256": hashlib.sha256(row["kept"] + head).hexdigest(),
        "fingerprint": packed(row["hashes"]),
        "edited_fingerprint": packed(edited_hashes),
        "near_edited": likeness(row["hashes"], edited_hashes),
        "near_next": likeness(row["hashes"], following["hashes"]),
    }


def _bounds_upto(value: Column, bounds: list[float], step: int = 64) -> Column:
    """How many of the sorted bounds are not above the value, by two short scans."""
    if not bounds:
        return F.lit(0)
    upto = lambda listed: F.size(F.filter(listed, lambda b: b <= value))
    every = bounds[step - 1 :: step]
    coarse = upto(F.array(*map(F.lit, every))) * step if every else F.lit(0)
    return coarse + upto(F.slice(F.array(*map(F.lit, bounds)), coarse + 1, step))


def compare_neighbours(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited form, and their likeness.

    The edited form ends in the beginning of the next document by ascending doc_id
    (after the last comes the first; a null doc_id comes first; rows with equal doc_id
    go by text). Documents are dealt out by ranges of doc_id, and the first row of each
    range is lent to the range before it, so that the text is shuffled once and no range
    waits for another. A null text is empty. A single document is its own next one.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    bounds = sorted(set(documents.approxQuantile("doc_id", shares, 0.1 / parts))) if shares else []
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_bounds_upto(F.col("doc_id"), bounds))
    dealt = documents.withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    heads = dealt.groupBy("part").agg(F.min(order).alias("head")).orderBy("part").collect()
    lent = spark.createDataFrame(
        [(row["head"]["doc_id"], heads[k - 1]["part"]) for k, row in enumerate(heads)],
        "head long, lender int",
    )
    borrowed = dealt.join(F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("head")))
    rows = dealt.select("part", F.lit(0).alias("borrowed"), "doc_id", "text").unionAll(
        borrowed.select(F.col("lender").alias("part"), F.lit(1), "doc_id", "text")
    )
    placed = rows.repartitionById(parts, F.col("part"))
    ordered = placed.sortWithinPartitions("part", "borrowed", F.asc_nulls_first("doc_id"), "text")
    return ordered.mapInArrow(_compare, _EDITED)
