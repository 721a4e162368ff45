"""Token ids in a compact binary form: canonical, length-limited Huffman codes.

A dataset is a folder with two tables. ``codebook`` has the code length of every id
that occurs (codes are canonical: by length, then id). ``blocks`` has the ids, in the order
of doc_id, in blocks of whole documents that are decoded independently: ``part`` and
``block`` give their order, ``doc_ids`` and ``n_tokens`` what they hold, ``bits`` the codes,
each document from a byte boundary, most significant bit first, and ``offsets`` the bit
at which every STRIDE-th code of the block starts, from where decoding can begin.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from memberfold.llm.common import sliced, small, written
from memberfold.session import shared_folder

# The longest code, in bits; decoding looks up so many bits at once.
MAX_BITS = 20
# Codes from one offset to the next: these runs are decoded side by side.
STRIDE = 128
# Ids of a block, unless a single document has more.
BLOCK = 1 << 19
# Distinct ids that a code book may have: the vocabulary's size bounds it.
MAX_IDS = 1 << 20
END = 0
# Bytes of text that are encoded at a time.
ENCODED_BYTES = 4 << 20

# Where a single space or line feed stands between two characters that are not white
# space, the tokenizer starts a new piece of text: a space goes with what follows it, a
# line feed is a piece by itself. What lies between can be encoded by itself.
_LINES = re.compile(r"(?<=\S)\n(?=\S)")
_WORDS = re.compile(r"(?<=\S) (?=\S)")
# Nothing but letters, after one space at most, is a piece that only needs merging.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = rf"\A ?[{_LATIN}]+\z"
# White space that is not of this kind, or the sign that pieces are cut at; a text
# without them can be cut without patterns. Written for Arrow's pattern language.
_CUT = "\0"
_WHITE = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = rf"[\x00\t\x0b-\r\x1c-\x1f{_WHITE}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
# Letters, and what follows them in a piece without white space: the tokenizer starts a new
# piece where a sign or digit (of ASCII or Latin-1) follows a letter.
_SIGN = r"!-@\[-`{-~\x{a1}-\x{a9}\x{ab}-\x{ac}\x{ae}-\x{b4}\x{b6}-\x{b9}\x{bb}-\x{bf}\x{d7}\x{f7}"
_HEAD_REST = rf"\A(?P<head> ?[{_LATIN}]+)(?P<rest>[{_SIGN}][^\x00-\x20{_WHITE}]*)\z"


def _byte_signs() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: its own if that
    can be printed, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: b for b in shown}, **{b: 256 + k for k, b in enumerate(hidden)}}


_SIGNS = _byte_signs()


def cuts_are_safe(tokenizer: str) -> bool:
    """Whether a tokenizer's pieces are those of this module, told from its file.

    They are for a byte-level BPE that splits by the usual pattern, changes no text before
    and has no added token that could lie across a cut.
    """
    file = json.loads(tokenizer)
    model, split = file["model"], file["pre_tokenizer"] or {}
    plain = not any(
        (
            file["normalizer"],
            file["truncation"],
            file["padding"],
            *(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")),
        )
    )
    by_pattern = split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    added = [t["content"] for t in file["added_tokens"] or []]
    within = all(not re.search(r"\s|[^\W\d_][.,]|\A[.,]|\A[^\W\d_]", t) for t in added)
    bare = not any(t[k] for t in file["added_tokens"] or [] for k in ("lstrip", "rstrip", "single_word", "normalized"))
    return plain and model["type"] == "BPE" and by_pattern and within and bare


class Encoder:
    """Encodes whole texts piece by piece and remembers the ids of pieces it has met.

    Two generations are kept, each of a bounded number of bytes: when the younger one is
    full it becomes the older one, and what is met again moves on, so that frequent pieces
    stay. Long pieces are not kept. A tokenizer whose pieces are not known to be these
    encodes whole texts.
    """

    LIMIT = 32 << 20  # bytes of a generation
    LONGEST = 64  # characters of a piece that is kept
    ENTRY = 200  # bytes that an entry takes beside its text and ids
    AT_ONCE = 20_000  # parts the tokenizer is given at a time

    def __init__(self, path: str, by_pieces: bool | None = None):
        """``by_pieces``: what ``cuts_are_safe`` says of the file, if known."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = cuts_are_safe(self.tokenizer.to_str()) if by_pieces is None else by_pieces
        self.line_feed = self._ids("\n")
        self.known: tuple[dict[str, bytes], ...] = ({},)
        self.older: tuple[dict[str, bytes], ...] = ({},)
        self.kept = 0

    def _ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")

    def _letters(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of letters, by the model's merges alone."""
        merged, found = self.tokenizer.model.tokenize, []
        for piece in pieces:
            if piece.isascii():
                signs = "Ġ" + piece[1:] if piece[0] == " " else piece
            else:
                signs = piece.encode().decode("latin-1").translate(_SIGNS)
            found.append(array("I", [t.id for t in merged(signs)]).tobytes())
        return found

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        for piece, own in zip(pieces, ids):
            if len(piece) <= self.LONGEST:
                self.known[0][piece] = own
                self.kept += len(piece) + len(own) + self.ENTRY

    def _values(self, column: pa.Array) -> list[bytes]:
        """Ids of different pieces."""
        if self.kept > self.LIMIT:
            self.known, self.older, self.kept = ({},), self.known, 0
        pieces = _strings(column)
        found = list(map(self.known[0].get, pieces))
        if self.older[0]:
            again = [k for k, ids in enumerate(found) if ids is None and pieces[k] in self.older[0]]
            for k in again:
                found[k] = self.older[0][pieces[k]]
            self._keep([pieces[k] for k in again], [found[k] for k in again])
        new = pa.array([ids is None for ids in found], pa.bool_())
        is_letters = pc.match_substring_regex(column, pattern=_LETTERS)
        for encode, wanted in ((self._letters, is_letters), (self._others, pc.invert(is_letters))):
            at = np.flatnonzero(pc.and_(new, wanted).to_numpy(zero_copy_only=False)).tolist()
            some = [pieces[k] for k in at]
            encoded = encode(some)
            self._keep(some, encoded)
            for k, ids in zip(at, encoded):
                found[k] = ids
        return found

    def _others(self, pieces: list[str]) -> list[bytes]:
        found: dict[str, bytes] = {}
        plain = [p for p in pieces if _is_plain(p)]
        for start in range(0, len(plain), self.AT_ONCE):
            some = plain[start : start + self.AT_ONCE]
            # Line feeds keep the pieces of one call apart, in the text and in its ids.
            ids = self._ids("\n".join(some))
            ends = np.flatnonzero(ids == self.line_feed[0]) if len(self.line_feed) == 1 else ids[:0]
            if len(ends) == len(some) - 1:
                data, bounds = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
                found.update((p, data[4 * a + 4 : 4 * b]) for p, a, b in zip(some, bounds, bounds[1:]))
        return [found[p] if p in found else self._ids(p).tobytes() for p in pieces]

    def _whole(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces; letters and what follows them are encoded apart."""
        # Whether a piece has two parts is far quicker told than where they meet.
        double = pc.match_substring_regex(pieces, pattern=_HEAD_REST)
        two = pc.extract_regex(pieces.filter(double), pattern=_HEAD_REST)
        heads = pc.replace_with_mask(pieces, double, pc.struct_field(two, "head"))
        rests = pc.replace_with_mask(pa.repeat(pa.scalar("", pieces.type), len(pieces)), double, pc.struct_field(two, "rest"))
        parts = pa.concat_arrays([heads, rests]).dictionary_encode()
        values = pa.array(self._values(parts.dictionary), pa.large_binary()).take(parts.indices)
        n = len(pieces)
        return pc.binary_join_element_wise(values[:n], values[n:], pa.scalar(b"", pa.large_binary()))

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces, end to end, and how many each text has."""
        odd = pc.match_substring_regex(texts, pattern=_ODD)
        cut = pc.replace_substring(pc.replace_substring(texts, " ", _CUT + " "), "\n", f"{_CUT}\n{_CUT}")
        pieces = pc.split_pattern(cut, _CUT)
        if pc.any(odd).as_py():
            apart = [_cut_by_patterns(t) for t in texts.filter(odd).to_pylist()]
            rows = np.arange(len(texts))
            marked = odd.to_numpy(zero_copy_only=False)
            rows[marked] = len(texts) + np.arange(marked.sum())
            pieces = pa.chunked_array([pieces, pa.array(apart, pieces.type)]).combine_chunks().take(pa.array(rows))
        return pieces.flatten(), pc.list_value_length(pieces).to_numpy()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are not null, end to end, and the number of each text's ids."""
        if not self.by_pieces:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64)
        pieces, per_text = self._pieces(texts)
        coded = pieces.dictionary_encode()
        taken = self._whole(coded.dictionary).take(coded.indices)
        _, ends, data = taken.buffers()
        ends = np.frombuffer(ends, np.int64)[taken.offset : taken.offset + len(taken) + 1] // 4
        ids = np.frombuffer(data, "<u4") if data is not None and len(data) else np.zeros(0, "<u4")
        bounds = np.concatenate([[0], np.cumsum(per_text, dtype=np.int64)])
        return ids[ends[0] : ends[-1]], np.diff(ends[bounds])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, sizes = self.encode_column(pa.array(texts, pa.string()))
        return [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def _strings(column: pa.Array) -> list[str]:
    """The texts of a column; several times quicker than ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _cut_by_patterns(text: str) -> list[str]:
    found = []
    for line in _LINES.split(text):
        first, *later = _WORDS.split(line)
        found += ["\n", first] if found else [first]
        found += [" " + word for word in later]
    return found


def _is_plain(part: str) -> bool:
    """No white space but one space before the first character."""
    bare = part[1:] if part[:1] == " " else part
    return bool(bare) and bare == bare.strip() and "\n" not in bare


def encode_documents(documents: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row: whole texts (null: empty), then the end id.

    ``ids`` are little-endian unsigned integers of 16 bits if the vocabulary allows it,
    of 32 bits otherwise. A text of any length is encoded whole; a task holds it and its
    ids, and a bounded number of bytes of pieces that it has met.
    """
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(tokenizer)
    width = "<u2" if loaded.get_vocab_size() <= 1 << 16 else "<u4"
    by_pieces = cuts_are_safe(loaded.to_str())  # told once, not by every task

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, by_pieces)  # what it remembers goes with the task
        for batch in sliced(batches, limit=ENCODED_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            ids, sizes = encoder.encode_column(texts)
            upto = np.cumsum(sizes + 1)
            out = np.full(int(upto[-1]), end, width)
            text_id = np.ones(len(out), bool)
            text_id[upto - 1] = False
            out[text_id] = ids
            offsets = np.concatenate([[0], upto * out.itemsize])
            data = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]
            binary = pa.Array.from_buffers(pa.large_binary(), len(sizes), data).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes + 1, pa.int64()), binary],
                names=["doc_id", "n_tokens", "ids"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return documents.select("doc_id", "text").mapInArrow(encode, schema)


def code_lengths(counts: dict[int, int], limit: int = MAX_BITS) -> dict[int, int]:
    """Huffman code lengths of at most ``limit`` bits, exact for the limit.

    Package-merge: in each of ``limit`` rounds the cheapest items and pairs of the last
    round are merged; an id's length is how often it is among the chosen ones.
    """
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need codes of more than {limit} bits")
    if len(ids) == 1:
        return {ids[0]: 1}
    weights = np.array([counts[i] for i in ids], np.float64)
    single = np.arange(len(ids))
    rounds, packed = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packed])
        order = np.argsort(merged, kind="stable")
        rounds.append(order)
        merged = merged[order]
        even = len(merged) // 2 * 2
        packed = merged[0:even:2] + merged[1:even:2]
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * len(ids) - 2
    for order in reversed(rounds):
        chosen = order[:take]
        lengths[chosen[chosen < len(ids)]] += 1
        take = 2 * int((chosen >= len(ids)).sum())
    return {int(ids[k]): int(lengths[k]) for k in single}


def canonical_codes(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths by id, as arrays up to the largest id."""
    top = max(lengths, default=0) + 1
    codes, sizes = np.zeros(top, np.uint64), np.zeros(top, np.int64)
    code, last = 0, 0
    for length, id_ in sorted((n, i) for i, n in lengths.items()):
        code <<= length - last
        codes[id_], sizes[id_], last = code, length, length
        code += 1
    return codes, sizes


def decoding_table(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every value of the next ``bits`` bits."""
    bits = max(lengths.values(), default=1)
    ids, sizes = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint8)
    at = 0
    for length, id_ in sorted((n, i) for i, n in lengths.items()):
        reach = 1 << (bits - length)
        ids[at : at + reach], sizes[at : at + reach] = id_, length
        at += reach
    return ids, sizes, bits


def pack(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of documents put end to end, and the bit at which each code starts.

    ``ends`` are the documents' ends in ``ids``; each document starts at a whole byte.
    """
    length = sizes[ids]
    upto = np.cumsum(length)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    per = upto[ends - 1] - np.where(starts > 0, upto[starts - 1], 0)
    room = (per + 7) // 8 * 8
    shift = np.cumsum(room) - room - np.where(starts > 0, upto[starts - 1], 0)
    at = upto - length + np.repeat(shift, ends - starts)
    word, bit = at >> 5, at & 31
    value = codes[ids] << (64 - length - bit).astype(np.uint64)
    n = int(room.sum()) // 32 + 2
    out = np.zeros(n, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[: int(room.sum()) // 8], at


def unpack(bits: bytes, offsets: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int], ends: np.ndarray) -> np.ndarray:
    """The ids of a block: all runs of STRIDE codes are decoded side by side."""
    ids, sizes, look = table
    # The 64 bits from each byte on. A run goes on past its last code, by at most STRIDE codes
    # and as many documents' ends, whose bits are read from what is put after the block.
    data = bits + bytes(STRIDE * (MAX_BITS // 8 + 2) + 8)
    words = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
    at = offsets.astype(np.int64).copy()
    out = np.zeros((STRIDE, len(at)), np.uint32)
    # A document's last code is followed by the bits up to the next whole byte.
    last = np.zeros(len(at) * STRIDE, bool)
    last[ends - 1] = True
    last = last.reshape(len(at), STRIDE).T
    shift, mask = 64 - look, np.uint64((1 << look) - 1)
    for k in range(STRIDE):
        window = words[at >> 3].astype(np.uint64)
        index = (window >> (shift - (at & 7)).astype(np.uint64)) & mask
        out[k] = ids[index]
        at += sizes[index]
        at = np.where(last[k], (at + 7) >> 3 << 3, at)
    return out.T.reshape(-1)[:n]


_BLOCKS = "part int, block int, doc_ids array<long>, n_tokens array<long>, n long, bits binary, offsets array<long>"


def write_dataset(encoded: DataFrame, folder: str) -> None:
    """Write ``doc_id, n_tokens, ids`` as a dataset; rows go in order of doc_id (null first).

    Rows with equal doc_id go by their ids. Counts come from all rows; only one number an
    id of the vocabulary reaches the driver.
    """
    spark = encoded.sparkSession
    encoded = written(encoded, "encoded")
    wide = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])

    def of(n: int, data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _id_counts(batches, of)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counts = encoded.select("n_tokens", "ids").mapInArrow(count, wide)
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).limit(MAX_IDS + 1).collect()
    if len(rows) > MAX_IDS:
        raise ValueError(f"more than {MAX_IDS} ids")
    lengths = code_lengths({r["id"]: r["n"] for r in rows}) if rows else {}
    spark.createDataFrame(sorted(lengths.items()), "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    codes, sizes = canonical_codes(lengths)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        for keys, arrays in _grouped(batches, of):
            ends = np.cumsum([len(x) for x in arrays])
            bits, at = pack(np.concatenate(arrays).astype(np.int64), ends, codes, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([[len(x) for x in arrays]], pa.list_(pa.int64())),
                    pa.array([int(ends[-1])], pa.int64()),
                    pa.array([bits], pa.binary()),
                    pa.array([at[::STRIDE]], pa.list_(pa.int64())),
                ],
                names=_NAMES,
            )
            block += 1

    ordered = encoded.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "ids"
    )
    ordered.mapInArrow(blocks, _BLOCKS).write.option("compression", "zstd").parquet(f"{folder}/blocks")


def _id_counts(batches: Iterator[pa.RecordBatch], of: Callable) -> np.ndarray:
    """How often each id occurs, up to the largest one."""
    total = np.zeros(0, np.int64)
    for batch in sliced(batches, "ids"):
        pairs = zip(batch.column("n_tokens").to_pylist(), batch.column("ids").to_pylist())
        # All documents of a slice at once: a count has as many numbers as the largest id.
        new = np.bincount(np.concatenate([of(n, data) for n, data in pairs]))
        if len(new) > len(total):
            total = np.concatenate([total, np.zeros(len(new) - len(total), np.int64)])
        total[: len(new)] += new
    return total


_NAMES = ["part", "block", "doc_ids", "n_tokens", "n", "bits", "offsets"]


def _grouped(batches: Iterator[pa.RecordBatch], of: Callable) -> Iterator[tuple[list, list[np.ndarray]]]:
    keys, arrays, n = [], [], 0
    for batch in sliced(batches, "ids"):
        for key, size, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
            if n and n + size > BLOCK:
                yield keys, arrays
                keys, arrays, n = [], [], 0
            keys.append(key)
            arrays.append(of(size, data))
            n += size
    if keys:
        yield keys, arrays


def read_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian
    unsigned 32-bit integers.
    """
    return _read(spark, folder, lambda ids: ids.astype("<u4").tobytes(), "ids", pa.binary(), "binary")


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_dataset``, with the ids' unsigned crc32 in place of the ids."""
    crc = lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    return _read(spark, folder, crc, "ids_crc32", pa.int64(), "long")


def _read(spark, folder: str, value: Callable, name: str, kind: pa.DataType, sql: str) -> DataFrame:
    book = spark.read.parquet(f"{folder}/codebook").limit(MAX_IDS).collect()
    lengths = {r["id"]: r["length"] for r in book}
    blocks = spark.read.parquet(f"{folder}/blocks")
    order = Window.orderBy("part")  # a row for each part of the file, without its ids
    parts = blocks.groupBy("part").agg(F.sum("n").alias("of_part"))
    parts = parts.select("part", (F.sum("of_part").over(order) - F.col("of_part")).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block")
    starts = blocks.select("part", "block", "n").withColumn("block_start", F.sum("n").over(inside) - F.col("n"))
    starts = starts.join(small(parts), "part").select(
        "part", "block", (F.col("part_start") + F.col("block_start")).alias("start")
    )
    placed = blocks.join(small(starts), ["part", "block"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in ("doc_ids", "n_tokens", "n", "bits", "offsets", "start")}
                sizes = one["n_tokens"].values.to_numpy()
                ends = np.cumsum(sizes)
                ids = unpack(one["bits"].as_py(), one["offsets"].values.to_numpy(), one["n"].as_py(), table, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        one["doc_ids"].values.cast(pa.int64()),
                        pa.array(one["start"].as_py() + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([value(x) for x in np.split(ids, ends[:-1])], kind),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    return placed.select("doc_ids", "n_tokens", "n", "bits", "offsets", "start").mapInArrow(
        decode, f"doc_id long, start long, n_tokens long, {name} {sql}"
    )


def tokenized_dataset(documents: DataFrame, tokenizer: str) -> str:
    """Encode and write all documents; the new dataset's folder under the shared one."""
    folder = shared_folder(documents.sparkSession, "tokens")
    write_dataset(encode_documents(documents, tokenizer), folder)
    return folder
