"""Removal of passages that earlier documents hold, found by repeated-phrase automata.

A passage is at least WINDOW words long. Recurring passages are confirmed first: rare
anchors (the least hash of the word runs in each window) point to the parts of documents
that can recur at all, and the hashes of these parts' windows tell which do, and in
which document first. The passages each document is first to hold are then compiled
into Aho-Corasick automata, in shards. A window's own words name its route and thereby its
shard, so each is streamed through one automaton; what its phrases point to is compared
word by word. A route with more passages than an automaton should hold is divided by the
hashes of whole windows, so that equal ones still meet.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from memberfold.llm.common import as_bytes, mixed, run_hashes, sliced, small, split_words, word_hashes, written

WINDOW = 50
# Length of the runs from which anchors are chosen, and of the automata's phrases. Any
# window holds a whole phrase of a passage cut every PHRASE words.
PHRASE = 25
# The least hash of the runs of so many words in a window is its route.
ROUTE = 5
# Words of recurring parts for a shard, and words streamed through one copy of its automaton.
SHARD_WORDS, STREAM_WORDS = 100_000, 1_000_000
# Words of passages beyond which a route is divided, and for a part of it.
ROUTE_WORDS, PART_WORDS = 500_000, 250_000
_SYMBOLS = 1_100_000
# Codes that stand between passages, and for words that no passage has: never equal.
_NO_WORD, _UNKNOWN = -1, -2
# Stands for the owner of what no passage holds; larger than any.
NOBODY = np.iinfo(np.int64).max
# Places of phrases that are compared at a time.
COMPARED = 20_000
# Bytes of text streamed through an automaton at a time, and words of parts cut at a time.
STREAMED, CUT_WORDS = 4 << 20, 1 << 20


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, have = values, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - have :])


def window_least(words: np.ndarray, k: int) -> np.ndarray:
    """For each window, the least hash of the runs of k words in it."""
    if len(words) < WINDOW:
        return np.zeros(0, np.uint64)
    return _sliding_least(run_hashes(words, k), WINDOW - k + 1)


def window_anchors(words: np.ndarray) -> np.ndarray:
    return window_least(words, PHRASE).view(np.int64)


def window_routes(words: np.ndarray) -> np.ndarray:
    """Equal windows have the same route; neighbouring ones mostly have."""
    return (mixed(window_least(words, ROUTE)) >> np.uint64(1)).astype(np.int64)


def _text_id(text: bytes) -> int:
    """Tells texts of equal doc_id apart."""
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(text), "big", signed=True)


def _each_window(name: str, of: Callable[[np.ndarray], np.ndarray]):
    """A row for each window's value and document; equal neighbours in a text give one."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            coded, bounds = word_hashes(batch.column("text"))
            values, owners = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(coded) >= WINDOW:
                # All texts end to end: windows that reach over the end of one are left out.
                text = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
                starts = text[: len(coded) - WINDOW + 1]
                inside = starts == text[WINDOW - 1 :]
                values, text = of(coded)[inside], starts[inside]
                new = np.ones(len(values), bool)
                new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
                owners = batch.column("doc_id").to_numpy(zero_copy_only=False)[text[new]]
                values = values[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(owners, pa.int64())], names=[name, "doc_id"]
            )

    return windows


def _window_hashes(words: np.ndarray) -> np.ndarray:
    return run_hashes(words, WINDOW).view(np.int64)


def _hashed(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """What ``split_words`` gives, and the hash of each word."""
    import xxhash

    which, words, bounds = split_words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return which, words, bounds, hashes[which]


def _inside(bounds: np.ndarray) -> np.ndarray:
    """Marks the windows of texts put end to end that lie in one text."""
    starts = np.zeros(max(int(bounds[-1]) - WINDOW + 1, 0), bool)
    for a, b in itertools.pairwise(bounds.tolist()):
        starts[a : max(a, b - WINDOW + 1)] = True
    return starts


def _among(values: np.ndarray, bounds: np.ndarray, listed: pa.Array) -> np.ndarray:
    """Marks the windows whose value is in the list of their own text."""
    marked = np.zeros(len(values), bool)
    for (a, b), own in zip(itertools.pairwise(bounds.tolist()), listed):
        if b - a >= WINDOW:
            marked[a : b - WINDOW + 1] = np.isin(values[a : b - WINDOW + 1], own.values.to_numpy())
    return marked


def _ranges(marked: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of the runs of marked windows that have one key (0 or above); they may overlap."""
    turns = np.flatnonzero(np.diff(np.where(marked, keys, -1), prepend=-1, append=-1))
    starts = turns[:-1][marked[turns[:-1]]]
    stops = turns[1:][marked[turns[:-1]]] - 1 + WINDOW
    return starts, stops


def _cut(
    which: np.ndarray, words: list[bytes], bounds: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Texts of word ranges, CUT_WORDS at a time or one long one.

    Gives the ranges' starts, the numbers of their texts, their places in these, their lengths
    and their words joined by one space.
    """
    known = pa.array(words, pa.binary()).cast(pa.string())
    upto = np.concatenate([[0], np.cumsum(stops - starts)])
    low = 0
    while low < len(starts):
        high = max(int(np.searchsorted(upto, upto[low] + CUT_WORDS, "right")) - 1, low + 1)
        start, n = starts[low:high], (stops - starts)[low:high]
        ends = upto[low : high + 1] - upto[low]
        at = np.repeat(start - ends[:-1], n) + np.arange(ends[-1])
        taken = known.take(pa.array(which[at]))
        text = np.searchsorted(bounds, start, "right") - 1
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken), " ")
        yield start, text, start - bounds[text], n, joined
        low = high


_SEGMENT = "doc_id long, text_id long, at long, n long, text string"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a document whose windows have recurring anchors."""
    for batch in sliced(batches):
        which, words, bounds, hashes = _hashed(batch.column("text"))
        marked = _among(window_anchors(hashes), bounds, batch.column("anchors"))
        ranges = _ranges(marked, np.zeros(len(marked), np.int64))
        texts = as_bytes(batch.column("text"))
        ids = {k: _text_id(texts[k]) for k in set((np.searchsorted(bounds, ranges[0], "right") - 1).tolist())}
        doc_ids = batch.column("doc_id").to_numpy()
        for _, text, at, n, joined in _cut(which, words, bounds, *ranges):
            text_ids = [ids[k] for k in text.tolist()]
            yield _batch([doc_ids[text], text_ids, at, n, joined], _SEGMENT)


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


_PASSAGE = "route long, owner long, n long, text string"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of windows that a document is the first to hold and another holds too."""
    for batch in sliced(batches):
        which, words, bounds, hashes = _hashed(batch.column("text"))
        marked = _among(_window_hashes(hashes), bounds, batch.column("windows"))
        routes = window_routes(hashes)
        owners = batch.column("doc_id").to_numpy()
        for start, text, _, n, joined in _cut(which, words, bounds, *_ranges(marked, routes)):
            yield _batch([routes[start], owners[text], n, joined], _PASSAGE)


_STREAM = "route long, doc_id long, text_id long, at long, n long, text string"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, cut into what each route has to look at."""
    for batch in sliced(batches):
        which, words, bounds, hashes = _hashed(batch.column("text"))
        routes = window_routes(hashes)
        doc_ids, text_ids, ats = (batch.column(c).to_numpy() for c in ("doc_id", "text_id", "at"))
        for start, text, at, n, joined in _cut(which, words, bounds, *_ranges(_inside(bounds), routes)):
            yield _batch([routes[start], doc_ids[text], text_ids[text], ats[text] + at, n, joined], _STREAM)


def _divided(schema: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of heavy routes cut by their windows' hashes, modulo ``parts``, into column ``part``."""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            which, words, bounds, hashes = _hashed(batch.column("text"))
            parts = np.repeat(batch.column("parts").to_numpy(), np.diff(bounds)).astype(np.uint64)
            windows = run_hashes(hashes, WINDOW)
            part = (windows % parts[: len(windows)]).astype(np.int64)
            for start, text, at, n, joined in _cut(which, words, bounds, *_ranges(_inside(bounds), part)):
                new = {"part": part[start], "n": n, "text": joined}
                if "at" in names:
                    new["at"] = batch.column("at").to_numpy()[text] + at
                yield _batch([new[c] if c in new else batch.column(c).to_numpy()[text] for c in names], schema)

    return divided


def _dealt(rows: DataFrame, heavy: DataFrame | None, schema: str, shards: int) -> DataFrame:
    """Adds ``shard`` and ``part`` (-1: the route is whole) in place of the route."""
    shard = F.pmod("route", F.lit(shards)).alias("shard")
    rest = [c for c in rows.columns if c != "route"]
    if heavy is None:
        return rows.select(shard, F.lit(-1).cast("long").alias("part"), *rest)
    rows = rows.join(heavy, "route", "left")
    whole = rows.where("parts IS NULL").select(shard, F.lit(-1).cast("long").alias("part"), *rest)
    schema += ", part long"
    cut = rows.where("parts IS NOT NULL").mapInArrow(_divided(schema), schema)
    return whole.unionByName(cut.select(shard, "part", *rest))


class Automaton:
    """Finds where windows of given passages occur.

    Passages are cut into phrases of PHRASE words; any window of a passage holds a whole
    one. A phrase found in a text names the places in passages where it stands. From each of
    them the match is extended word by word to both sides, by PHRASE words at most, which is
    as far as a window around the phrase reaches.
    """

    def __init__(self, passages: list[tuple[int, bytes]]):
        import ahocorasick

        of = np.array([owner for owner, _ in passages], np.int64)
        which, words, bounds = split_words(pa.array([text for _, text in passages], pa.binary()))
        self.codes = {word: k for k, word in enumerate(words)}
        # Passages lie end to end, apart by a code that no word has.
        sizes, each = np.diff(bounds), np.arange(len(of))
        self.words = np.full(len(which) + len(of) + 3 * PHRASE, _NO_WORD)
        self.words[np.arange(len(which)) + PHRASE + np.repeat(each, sizes)] = which
        line = _symbols(self.words)
        times = sizes // PHRASE
        passage, upto = np.repeat(each, times), np.cumsum(times)
        at = (PHRASE + bounds[:-1] + each)[passage]
        at += PHRASE * (np.arange(len(passage)) - np.repeat(upto - times, times))
        phrases: dict[str, int] = {}
        phrase = [phrases.setdefault(line[k : k + PHRASE], len(phrases)) for k in at.tolist()]
        self.automaton = ahocorasick.Automaton()
        for text, k in phrases.items():
            self.automaton.add_word(text, k)
        self.automaton.make_automaton()
        phrase = np.array(phrase, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(phrase, minlength=len(phrases)))])
        order = np.argsort(phrase, kind="stable")
        self.places, self.owners = at[order], of[passage][order]

    def covered(self, doc_id: int, text: bytes) -> np.ndarray:
        """Marks the words in windows that a passage of a smaller owner holds."""
        line = self.coded(text.split())
        return self.first_owners(line, np.full(len(line), doc_id)) < doc_id

    def coded(self, words: list[bytes]) -> np.ndarray:
        """Codes of words; one that no passage has is like no word."""
        get = self.codes.get
        return np.fromiter((get(w, _UNKNOWN) for w in words), np.int64, len(words))

    def first_owners(self, line: np.ndarray, latest: np.ndarray) -> np.ndarray:
        """For each word, the least owner of a passage that holds a window around it.

        ``line`` is the codes of texts put end to end, with an unknown word between two.
        Owners that are not below ``latest``, of the same length, are not looked for; where there
        is none, the word has NOBODY.
        """
        least = np.full(len(line), NOBODY)
        if len(line) < WINDOW or not len(self.places):
            return least
        hits = itertools.chain.from_iterable(self.automaton.iter(_symbols(line)))
        ends, phrases = np.fromiter(hits, np.int64).reshape(-1, 2).T
        times = np.diff(self.bounds)[phrases]
        upto = np.cumsum(times)
        padded = np.concatenate([np.full(PHRASE, _UNKNOWN), line, np.full(PHRASE, _UNKNOWN)])
        # A phrase that stands in very many passages is compared with some of them at a time.
        for low in range(0, int(upto[-1]) if len(upto) else 0, COMPARED):
            pair = np.arange(low, min(low + COMPARED, int(upto[-1])))
            hit = np.searchsorted(upto, pair, "right")
            which = self.bounds[phrases[hit]] + pair - (upto - times)[hit]
            end, owner = ends[hit], self.owners[which]
            earlier = owner < latest[end]
            self._extend(padded, end[earlier] - PHRASE + 1, self.places[which][earlier], owner[earlier], least)
        return least

    def _extend(
        self, padded: np.ndarray, start: np.ndarray, place: np.ndarray, owner: np.ndarray, least: np.ndarray
    ) -> None:
        """Lowers ``least`` to the owner where a match of at least a window covers a word."""
        reach = np.arange(PHRASE)
        same = self.words[place[:, None] + reach] == padded[start[:, None] + PHRASE + reach]
        whole = same.all(axis=1)  # signs of different words may be equal
        start, place, owner = start[whole], place[whole], owner[whole]
        before = self.words[place[:, None] - 1 - reach] == padded[start[:, None] + PHRASE - 1 - reach]
        after = self.words[place[:, None] + PHRASE + reach] == padded[start[:, None] + 2 * PHRASE + reach]
        left = np.logical_and.accumulate(before, axis=1).sum(axis=1)
        right = np.logical_and.accumulate(after, axis=1).sum(axis=1)
        far = left + right + PHRASE >= WINDOW
        first, n, owner = (start - left)[far], (left + right + PHRASE)[far], owner[far]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.minimum.at(least, at, np.repeat(owner, n))


def _symbols(coded: np.ndarray) -> str:
    """A character a word; words that share one are told apart when compared."""
    points = np.where(coded < 0, _SYMBOLS, coded % _SYMBOLS)
    points = np.where(points >= 0xD800, points + 0x800, points)  # no surrogates
    return points.astype("<u4").tobytes().decode("utf-32-le")


_SPAN = "doc_id long, text_id long, start long, stop long"


def _locate(passages: pa.Table, segments: pa.Table) -> pa.Table:
    out = [_batch([[]] * 4, _SPAN)]
    if passages.num_rows and segments.num_rows:
        texts = as_bytes(passages.column("text").combine_chunks())
        automaton = Automaton(list(zip(passages.column("owner").to_pylist(), texts)))
        out += [_located(automaton, part) for part in sliced(segments.to_batches(), limit=STREAMED)]
    return pa.Table.from_batches(out)


def _located(automaton: Automaton, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The word ranges to remove. Equal texts are streamed once, for the latest document that has them."""
    doc_ids, text_ids, ats = (batch.column(c).to_numpy() for c in ("doc_id", "text_id", "at"))
    texts = batch.column("text").dictionary_encode()
    of = texts.indices.to_numpy()
    latest = np.full(len(texts.dictionary), np.iinfo(np.int64).min)
    np.maximum.at(latest, of, doc_ids)
    which, words, bounds = split_words(texts.dictionary)
    # Each text is followed by an unknown word, which is never covered.
    sizes, each = np.diff(bounds), np.arange(len(latest))
    line = np.full(len(which) + len(latest), _UNKNOWN)
    line[np.arange(len(which)) + np.repeat(each, sizes)] = automaton.coded(words)[which]
    least = automaton.first_owners(line, np.repeat(latest, sizes + 1))
    n = (sizes + 1)[of]
    upto = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat((bounds[:-1] + each)[of] - upto[:-1], n) + np.arange(upto[-1])
    marked = least[at] < np.repeat(doc_ids, n)
    edges = np.flatnonzero(np.diff(marked, prepend=False))
    start, stop = edges[::2], edges[1::2]
    row = np.searchsorted(upto, start, "right") - 1
    moved = ats[row] - upto[row]
    return _batch([doc_ids[row], text_ids[row], moved + start, moved + stop], _SPAN)


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, text_id, start, stop``: word ranges to remove; ranges may overlap.

    Rows with a null doc_id neither lose words nor are anyone's source.
    """
    documents = documents.select("doc_id", "text").where("doc_id IS NOT NULL")
    each = _each_window("anchor", window_anchors)
    anchors = written(documents.mapInArrow(each, "anchor long, doc_id long"), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
    held = anchors.join(shared.where("x < y").select("anchor"), "anchor")
    listed = held.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    segments = written(documents.join(listed, "doc_id").mapInArrow(_segments, _SEGMENT), "segments")

    each = _each_window("window", _window_hashes)
    first = segments.select("doc_id", "text").mapInArrow(each, "window long, doc_id long")
    first = first.groupBy("window").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    owned = first.where("doc_id < last").groupBy("doc_id")
    owned = owned.agg(F.collect_list("window").alias("windows"))
    shards = max(1, -(-(segments.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS))
    passages = segments.select("doc_id", "text").join(owned, "doc_id")
    passages = written(passages.mapInArrow(_passages, _PASSAGE).distinct(), "passages")
    streams = written(segments.mapInArrow(_streams, _STREAM), "streams")
    # A divided route has a row of its own for each window.
    cut = F.sum((F.col("n") - (WINDOW - 1)) * WINDOW)
    heavy = passages.groupBy("route").agg(F.sum("n").alias("n"), F.ceil(cut / PART_WORDS).alias("parts"))
    heavy = written(heavy.where(F.col("n") > ROUTE_WORDS).select("route", "parts"), "heavy")
    heavy = None if heavy.isEmpty() else small(heavy)
    passages = _dealt(passages, heavy, _PASSAGE, shards)
    streams = _dealt(streams, heavy, _STREAM, shards)
    if heavy is not None:
        streams = written(streams, "dealt")

    # A shard whose windows very many documents hold gets several copies of its automaton.
    copies = F.ceil(F.sum("n") / STREAM_WORDS).cast("int").alias("copies")
    load = small(written(streams.groupBy("shard", "part").agg(copies), "load"))
    copy = F.pmod(F.xxhash64("doc_id"), F.col("copies")).cast("int")
    streams = streams.join(load, ["shard", "part"]).withColumn("copy", copy)
    every = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    compiled = passages.join(load, ["shard", "part"]).withColumn("copy", every)
    keys = ["shard", "part", "copy"]
    return (
        compiled.select(*keys, "owner", "text")
        .groupBy(*keys)
        .cogroup(streams.select(*keys, "doc_id", "text_id", "at", "text").groupBy(*keys))
        .applyInArrow(_locate, _SPAN)
    )


_KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _kept(digest: bool):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for doc_id, text, spans in zip(
                batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), batch.column("spans").to_pylist()
            ):
                words = text.split()
                n = len(words)
                if spans:
                    text_id = _text_id(text)
                    stays = np.ones(n, bool)
                    for span in spans:
                        if span["text_id"] == text_id:
                            stays[span["start"] : span["stop"]] = False
                    words = [words[k] for k in np.flatnonzero(stays)]
                rest = b" ".join(words)
                value = hashlib.sha256(rest).hexdigest() if digest else rest.decode()
                out.append((doc_id, n, n - len(words), value))
            yield _batch(list(zip(*out)) or [[]] * 4, _KEPT)

    return kept


def without_repeats(documents: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed`` of every row, and ``kept``, the words left.

    A word goes if it lies in a window of 50 consecutive words that also starts in a
    document of smaller doc_id. Kept words are joined by one space; with ``digest`` their
    sha256 stands in their place. A null or empty text has no words. Rows that repeat a
    doc_id are judged each, and are not each other's source.
    """
    spans = repeated_spans(documents)
    spans = spans.groupBy("doc_id").agg(F.collect_set(F.struct("text_id", "start", "stop")).alias("spans"))
    joined = documents.select("doc_id", "text").join(written(spans, "spans"), "doc_id", "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_kept(digest), _KEPT)
