"""Fill-in-the-middle examples, cut with a learned index of code point boundaries.

A cut is given as a number of code points, a text is stored as UTF-8 bytes. The byte
offsets of all code point boundaries, as a function of their rank, are fitted by straight
segments whose error is bounded; what a segment misses at each boundary is stored in a
signed byte. A cut's offset is its segment's prediction plus that residual: exact, without
counting through the text again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from memberfold.llm.common import as_bytes, sliced

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Bytes by which a segment may miss a boundary; with rounding a residual fits a signed byte.
ERROR = 126
# Bytes that are fitted at a time, and boundaries tried first for a segment.
BLOCK, FIRST_TRY = 1 << 20, 1 << 10


def fitted_segments(offsets: np.ndarray, error: int = ERROR) -> Iterator[tuple[int, int, float]]:
    """``start, stop, slope`` of segments that each go as far as one line can.

    A segment passes through its first point. The slopes that keep all points so far
    within the error form a cone that narrows from point to point; the segment ends
    before the point that closes it.
    """
    start, tried = 0, FIRST_TRY
    while start < len(offsets):
        while True:
            rise = (offsets[start + 1 : start + tried] - offsets[start]).astype(np.float64)
            run = np.arange(1, len(rise) + 1)
            highest = np.minimum.accumulate((rise + error) / run)
            lowest = np.maximum.accumulate((rise - error) / run)
            closed = np.flatnonzero(lowest > highest)
            if len(closed) or start + tried >= len(offsets):
                break
            tried *= 2
        n = int(closed[0]) if len(closed) else len(rise)
        slope = float(lowest[n - 1] + highest[n - 1]) / 2 if n else 0.0
        yield start, start + n + 1, slope
        start += n + 1
        tried = max(FIRST_TRY, 2 * n)


class BoundaryIndex:
    """Byte offset of every code point boundary of UTF-8 bytes, by its rank."""

    def __init__(self, data: bytes, error: int = ERROR):
        self.ranks, self.offsets, self.slopes, residuals = [], [], [], []
        rank = 0
        raw = np.frombuffer(data, np.uint8)
        for base in range(0, len(data) + 1, BLOCK):
            part = raw[base : base + BLOCK]
            found = np.flatnonzero((part & 0xC0) != 0x80) + base
            if base + BLOCK > len(data):
                found = np.append(found, len(data))  # the boundary after the last code point
            for start, stop, slope in fitted_segments(found, error):
                self.ranks.append(rank + start)
                self.offsets.append(found[start])
                self.slopes.append(slope)
                guess = found[start] + np.rint(slope * np.arange(stop - start)).astype(np.int64)
                residuals.append((found[start:stop] - guess).astype(np.int8))
            rank += len(found)
        self.ranks, self.offsets = np.array(self.ranks, np.int64), np.array(self.offsets, np.int64)
        self.slopes, self.residuals = np.array(self.slopes), np.concatenate(residuals)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ranks, ranks, "right") - 1
        return self.offsets[at] + np.rint(self.slopes[at] * (ranks - self.ranks[at])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residuals[ranks]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that a document's id gives; a null id is empty."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(found[k : k + 4]) for k in range(0, 16, 4)]


def form_of(text: bytes, draw: list[int], plain_percent: int, spm_percent: int) -> str:
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or draw[2] % 100 >= 100 - plain_percent:
        return "plain"
    return "spm" if draw[3] % 100 < spm_percent else "psm"


def arranged(form: str, text: bytes, first: int, second: int) -> bytes:
    """The example of a text that is cut at two byte offsets."""
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return text


def restored(form: str, example: bytes) -> bytes:
    """The text an example was made of. Its parts hold no mark, so the first ones count."""
    if form == "plain":
        return example
    rest, _, middle = example.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = rest[len(PREFIX) :].partition(SUFFIX)
    else:
        suffix, _, prefix = rest[len(SUFFIX) :].partition(PREFIX)
    return prefix + middle + suffix


_CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
_EXAMPLE = _CUT + "output string"
_DIGEST = _CUT + "output_sha256 string, restored_sha256 string"


def _examples(seed: int, plain_percent: int, spm_percent: int, digest: bool):
    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, ids = as_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            index = BoundaryIndex(b"".join(texts))
            drawn = [draws(seed, doc_id) for doc_id in ids]
            cuts = np.array([d[:2] for d in drawn], np.int64) % (sizes[:, None] + 1)
            cuts.sort(axis=1)
            first_rank = np.cumsum(sizes, dtype=np.int64) - sizes
            starts = index.offset(first_rank)[:, None]
            at = index.offset(first_rank[:, None] + cuts) - starts
            forms, outputs = [], []
            for text, draw, (first, second) in zip(texts, drawn, at.tolist()):
                form = form_of(text, draw, plain_percent, spm_percent)
                example = arranged(form, text, first, second)
                forms.append(form)
                if digest:
                    back = restored(form, example)
                    outputs.append((hashlib.sha256(example).hexdigest(), hashlib.sha256(back).hexdigest()))
                else:
                    outputs.append((example.decode("utf-8", "replace"),))
            plain = pa.array([f == "plain" for f in forms])
            prefix, middle = cuts[:, 0].astype(np.int64), (cuts[:, 1] - cuts[:, 0]).astype(np.int64)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(forms, pa.string()),
                *(pc.if_else(plain, pa.scalar(None, pa.int64()), pa.array(c)) for c in (prefix, middle)),
                *(pa.array(c, pa.string()) for c in zip(*outputs)),
            ]
            names = [f.split(" ")[0] for f in (_DIGEST if digest else _EXAMPLE).split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return examples


def fill_in_middle(
    documents: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    digest: bool = False,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    Two cuts drawn from the seed and the doc_id part a text of n code points into prefix,
    middle and suffix. ``plain_percent`` of the texts stay as they are (`plain`; so do empty
    ones and those that hold a mark), ``spm_percent`` of the others begin with their suffix
    (`spm`), the rest with their prefix (`psm`). With ``digest`` the sha256 of the output and
    of the text restored from it stand in the output's place.

    A null text is empty; a null doc_id draws as an empty id. Rows are handled each for
    itself, so repeated rows give equal results and an empty table none; other columns are
    not looked at. A text of any length is indexed block by block: beside the text, one byte
    a code point and the segments are held.
    """
    rows = documents.select("doc_id", "text")
    kernel = _examples(seed, plain_percent, spm_percent, digest)
    return rows.mapInArrow(kernel, _DIGEST if digest else _EXAMPLE)


def restored_texts(examples: DataFrame) -> DataFrame:
    """``doc_id, text``: the texts that the rows of ``fill_in_middle`` were made of."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "output"):
            outputs = as_bytes(batch.column("output"))
            texts = [restored(f, x).decode() for f, x in zip(batch.column("form").to_pylist(), outputs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return examples.select("doc_id", "form", "output").mapInArrow(back, "doc_id long, text string")
