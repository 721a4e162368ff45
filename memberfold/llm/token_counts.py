"""Token counts of a unigram tokenizer without making the tokens.

No unigram model is dealt, so one is estimated: the pieces of a sentencepiece model (whose
own scores, if it is a BPE model, are ranks) and 256 byte pieces get log probabilities by
expectation maximization over the word counts of all documents. The model is saved as a
file that the tokenizers library reads.

An Aho-Corasick automaton of the vocabulary lists the pieces that end at each character;
dynamic programming carries the best score and its number of pieces. Of equal scores the
first found stands, pieces being tried by their start from the left, as unigram tokenizers do.
"""

from __future__ import annotations

import collections
import itertools
import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from memberfold.llm.common import sliced, written
from memberfold.session import shared_folder

SPACE = "▁"
# An unknown character scores this much below the least piece.
UNKNOWN_PENALTY = 10.0
# Bytes of words whose counts a task remembers, what an entry takes beside its text, and the
# characters of the longest word that is remembered.
KNOWN_BYTES, ENTRY_BYTES, LONGEST_KNOWN = 100 << 20, 130, 64
# Bytes of text whose words are told apart at once.
COUNTED_BYTES = 8 << 20
# Words that are counted at once.
AT_ONCE = 20_000
# Places of a word whose scores are held beyond those that the longest piece reaches.
KEPT_PLACES = 4096
UNKNOWN = "<unk>"
BYTES = [f"<0x{k:02X}>" for k in range(256)]
# Rounds of estimation at most, and the gain of log likelihood, as a share, that ends them.
ROUNDS, GAIN = 6, 0.002
# Added to the expected count of every piece.
SMOOTHING = 0.5
# Expected counts are summed in whole numbers of this part, so that their order has no effect.
PART = 1024


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def words(text: str) -> list[str]:
    """Words of a text without the mark before each: spaces become marks, and a text that
    does not start with one gets one. Marks that follow one another belong to the word after them."""
    if not text:
        return []
    marked = text.replace(" ", SPACE)
    parts = (marked if marked.startswith(SPACE) else SPACE + marked).split(SPACE)[1:]
    if "" not in parts:
        return parts
    found, marks, last = [], 0, len(parts) - 1
    for k, word in enumerate(parts):
        if word or k == last:
            found.append(SPACE * marks + word)
            marks = 0
        else:
            marks += 1
    return found


class Trie:
    """Finds all pieces at all places of many words, a character further at a time.

    The commonest characters of the pieces have a column each in a table of steps, as many
    as a number of bytes allows; steps by the others are looked up in a sorted list.
    """

    COLUMNS, TABLE_BYTES = 128, 64 << 20

    def __init__(self, pieces: Iterable[str]):
        children: dict[tuple[int, int], int] = {}
        final = {}
        for k, piece in enumerate(pieces):
            node = 0
            for c in piece:
                node = children.setdefault((node, ord(c)), len(children) + 1)
            final[node] = k
        self.piece = np.full(len(children) + 1, -1, np.int64)
        self.piece[list(final)] = list(final.values())
        node, code = np.array(list(children), np.int64).reshape(-1, 2).T
        to = np.array(list(children.values()), np.int64)
        codes, n = np.unique(code, return_counts=True)
        self.width = max(1, min(self.COLUMNS, self.TABLE_BYTES // (4 * len(self.piece))))
        common = codes[np.argsort(-n, kind="stable")][: self.width - 1]
        self.column = np.zeros(0x110000, np.int64)  # 0: in the list, or in no piece
        self.column[common] = 1 + np.arange(len(common))
        self.table = np.zeros(len(self.piece) * self.width, np.int32)  # 0: no step
        column = self.column[code]
        self.table[(node * self.width + column)[column > 0]] = to[column > 0]
        key, to = (node << 21 | code)[column == 0], to[column == 0]
        order = np.argsort(key)
        self.listed, self.listed_to = key[order], to[order]

    def matches(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every match; ``left`` is what a word has from each place on."""
        columns = self.column[codes]
        at, node, length = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        found = [(at[:0], at[:0], at[:0])]
        while len(at):
            column = columns[at + length]
            to = self.table[node * self.width + column]
            rare = np.flatnonzero(column == 0)
            if len(rare) and len(self.listed):
                key = node[rare] << 21 | codes[at[rare] + length]
                step = np.minimum(np.searchsorted(self.listed, key), len(self.listed) - 1)
                to[rare] = np.where(self.listed[step] == key, self.listed_to[step], 0)
            alive = np.flatnonzero(to)
            at, node, length = at[alive], to[alive].astype(np.int64), length + 1
            piece = self.piece[node]
            ends = np.flatnonzero(piece >= 0)
            found.append((at[ends], np.full(len(ends), length), piece[ends]))
            more = np.flatnonzero(left[at] > length)
            at, node = at[more], node[more]
        return tuple(np.concatenate(x) for x in zip(*found))


def _codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


class Counter:
    """Counts pieces of words; ``pieces`` must not have a space mark after another character.

    With this condition no piece reaches over the start of a word, so the best
    segmentation of a text is made of those of its words. If all byte pieces are among
    the pieces, an unknown character counts as its bytes.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        import ahocorasick

        crossing = [p for p, _ in pieces if re.search(f"[^{SPACE}]{SPACE}", p)]
        if crossing:
            raise ValueError(f"pieces reach over the start of a word: {crossing[:3]}")
        self.automaton = ahocorasick.Automaton()
        last = dict(pieces)  # of a piece that comes twice the last score counts
        for k, piece in enumerate(last):
            self.automaton.add_word(piece, k)
        self.automaton.make_automaton()
        self.trie = Trie(last)
        self.scores = np.array(list(last.values()), np.float64)
        self.matches = [(len(p), score) for p, score in last.items()]
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _ in pieces), default=1)
        self.known: dict[str, int] = {}
        self.kept = 0
        self.bytes = {p for p, _ in pieces}.issuperset(BYTES)

    def word(self, text: str) -> int:
        """Pieces of the best segmentation; without byte pieces, a run of unknown characters is one.

        Scores are kept for the places that the longest piece can reach back to, and at
        most as many more before they are dropped.
        """
        best, count, unknown, base = [0.0], [0], [False], 0
        found = self.automaton.iter(text)
        last, match = next(found, (len(text), None))
        for end in range(1, len(text) + 1):
            pieces = []
            while last == end - 1:
                pieces.append(self.matches[match])
                last, match = next(found, (len(text), None))
            top, pieces_of, none = None, 0, False
            for length, score in sorted(pieces, reverse=True):  # the longest first
                total = best[end - length - base] + score
                if top is None or total > top:
                    top, pieces_of = total, count[end - length - base] + 1
            if all(length > 1 for length, _ in pieces):
                # No piece is this character: it may stand as unknown.
                total = best[-1] + self.unknown
                if top is None or total > top:
                    more = len(text[end - 1].encode()) if self.bytes else not unknown[-1]
                    top, pieces_of, none = total, count[-1] + more, True
            best.append(top)
            count.append(pieces_of)
            unknown.append(none)
            if len(best) > 2 * self.longest + KEPT_PLACES:
                drop = len(best) - self.longest - 1
                del best[:drop], count[:drop], unknown[:drop]
                base += drop
        return count[-1]

    def short_words(self, words: list[str]) -> list[int]:
        """As ``word`` of each word after its mark, place after place for all of them at once."""
        text = SPACE + SPACE.join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(words)), sizes)
        codes = _codes(text)
        start, length, piece = self.trie.matches(codes, (first + sizes)[owner] - np.arange(len(codes)))
        last = start + length - 1
        alone = np.ones(len(text), bool)
        alone[last[length == 1]] = False
        alone = np.flatnonzero(alone)  # no piece is this character: it may stand as unknown
        last, length = np.concatenate([last, alone]), np.concatenate([length, np.ones_like(alone)])
        score = np.concatenate([self.scores[piece], np.full(len(alone), self.unknown)])
        strange = np.arange(len(last)) >= len(piece)
        codes = codes[last]
        as_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        own = owner[last]
        place = last + 1 - first[own]
        # By place, word and falling length, in which order the first of the best counts.
        order = np.argsort((place << 40 | own) << 16 | (LONGEST_KNOWN + 1 - length))
        own, length, score, strange, as_bytes, place = (x[order] for x in (own, length, score, strange, as_bytes, place))
        end = first[own] + own + place  # a word of n characters has n + 1 places
        start = end - length
        best, count, unknown = np.zeros(len(text) + len(words)), np.zeros(len(text) + len(words), np.int64), np.zeros(len(text) + len(words), bool)
        cuts = np.flatnonzero(np.diff(place)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(place))):
            heads = np.append(0, np.flatnonzero(np.diff(own[a:b])) + 1)
            total = best[start[a:b]] + score[a:b]
            top = np.maximum.reduceat(total, heads)
            at = np.flatnonzero(total == np.repeat(top, np.diff(np.append(heads, b - a))))
            at = at[np.append(True, np.diff(own[a:b][at]) > 0)] + a
            before, odd = start[at], strange[at]
            more = as_bytes[at] if self.bytes else ~unknown[before]
            best[end[at]], unknown[end[at]] = top, odd
            count[end[at]] = count[before] + np.where(odd, more, 1)
        return count[first + np.arange(len(words)) + sizes].tolist()

    def counts(self, words: list[str]) -> list[int]:
        """Pieces of words, each after its mark."""
        known = self.known
        found = list(map(known.get, words))
        new = [k for k, n in enumerate(found) if n is None]
        short = [k for k in new if len(words[k]) <= LONGEST_KNOWN]
        for start in range(0, len(short), AT_ONCE):
            some = short[start : start + AT_ONCE]
            for k, n in zip(some, self.short_words([words[k] for k in some])):
                found[k] = known[words[k]] = n
                self.kept += len(words[k]) + ENTRY_BYTES
        for k in new:
            if found[k] is None:
                found[k] = self.word(SPACE + words[k])
        if self.kept > KNOWN_BYTES:
            known.clear()
            self.kept = 0
        return found

    def text(self, text: str) -> int:
        """Pieces of a text."""
        return sum(self.counts(words(text)))

    def column(self, texts: pa.Array) -> np.ndarray:
        """Pieces of each text; a null text has none."""
        which, distinct, bounds = distinct_words(texts)
        upto = np.concatenate([[0], np.cumsum(np.array(self.counts(distinct), np.int64)[which])])
        return np.diff(upto[bounds])


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The ``words`` of texts, end to end, as numbers of distinct ones, and where each text's start."""
    texts = pc.fill_null(texts, "")
    # Where no marks follow one another and none comes first, words are what spaces part.
    odd = pc.match_substring_regex(texts, pattern=f"\\A\\z|\\A |  |{SPACE}")
    parts = pc.split_pattern(texts, " ")
    if pc.any(odd).as_py():
        apart = [words(t) for t in texts.filter(odd).to_pylist()]
        rows, marked = np.arange(len(texts)), odd.to_numpy(zero_copy_only=False)
        rows[marked] = len(texts) + np.arange(len(apart))
        parts = pa.chunked_array([parts, pa.array(apart, parts.type)]).combine_chunks().take(pa.array(rows))
    coded = parts.flatten().dictionary_encode()
    sizes = pc.list_value_length(parts).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), bounds


# --- Estimation.


def _chunks(pieces: Sequence[str]):
    pairs = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
    # The last entry is above all pairs, so that every search ends at an entry.
    sorted_pairs = np.array([*sorted((ord(a) << 21) | ord(b) for a, b in pairs), 1 << 62], np.int64)

    def is_cut(words: list[str]) -> np.ndarray:
        """Whether a word, after its mark, has more than one part."""
        codes = _codes(SPACE + SPACE.join(words))
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 1)
        pair = codes[:-1] << 21 | codes[1:]
        apart = (sorted_pairs[np.searchsorted(sorted_pairs, pair)] != pair) & (owner[:-1] == owner[1:])
        found = np.zeros(len(words), bool)
        found[owner[:-1][apart]] = True
        return found

    def cut(word: str) -> Iterator[str]:
        """Parts that every segmentation has bounds between: no piece holds these two characters."""
        start = 0
        for at in range(1, len(word)):
            if word[at - 1 : at + 1] not in pairs:
                yield word[start:at]
                start = at
        yield word[start:]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: collections.Counter[str] = collections.Counter()
        kept = 0

        def batch_of(parts: list[str], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(n, pa.int64())], names=["chunk", "n"])

        def counted(numbers: Iterable[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
            numbers, found = iter(numbers), collections.Counter()
            while some := list(itertools.islice(numbers, AT_ONCE)):
                short = all(len(word) <= LONGEST_KNOWN for word, _ in some)
                cuts = is_cut([word for word, _ in some]).tolist() if short else [True] * len(some)
                whole = [pair for pair, yes in zip(some, cuts) if not yes]
                for (word, n), yes in zip(some, cuts):
                    if yes:
                        for part in cut(SPACE + word):
                            found[part] += n
                yield batch_of([SPACE + word for word, _ in whole], [n for _, n in whole])
            yield batch_of(list(found), list(found.values()))

        for batch in sliced(batches, limit=COUNTED_BYTES):
            which, distinct, _ = distinct_words(batch.column("text"))
            numbers = dict(zip(distinct, np.bincount(which, minlength=len(distinct)).tolist()))
            long = [(w, numbers.pop(w)) for w in distinct if len(w) > LONGEST_KNOWN]
            if long:
                yield from counted(long)
            before = len(seen)
            seen.update(numbers)
            kept += (len(seen) - before) * (LONGEST_KNOWN // 4 + ENTRY_BYTES)
            if kept > KNOWN_BYTES:
                yield from counted(seen.items())
                seen.clear()
                kept = 0
        yield from counted(seen.items())

    return chunks


class Lattices:
    """Expected counts of pieces over all segmentations of many chunks at once."""

    def __init__(self, pieces: Sequence[str], scores: np.ndarray):
        self.trie = Trie(pieces)
        self.scores = np.append(scores, scores.min() - UNKNOWN_PENALTY)  # the last: unknown

    def edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every match; ``left`` is what a chunk has from each place on."""
        start, length, piece = self.trie.matches(codes, left)
        single = np.zeros(len(codes), bool)
        single[start[length == 1]] = True
        at = np.flatnonzero(~single)
        unknown = np.full(len(at), len(self.scores) - 1)
        return np.append(start, at), np.append(length, np.ones_like(at)), np.append(piece, unknown)

    def expected(self, chunks: list[str], n: np.ndarray) -> tuple[np.ndarray, int]:
        """Expected counts, in parts, of the pieces (an unknown character's go to its bytes,
        the first 256 after piece 0), and the log likelihood, in parts."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        codes = _codes("".join(chunks))
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(chunks)), sizes)
        place = np.arange(len(codes)) - first[owner]
        start, length, piece = self.edges(codes, sizes[owner] - place)
        # A chunk of n characters has n + 1 nodes.
        low, own = place[start], owner[start]
        score = self.scores[piece]
        begin = start + own
        end = begin + length
        forward, backward = (np.zeros(len(codes) + len(chunks)) for _ in range(2))

        def spread(level: np.ndarray, source: np.ndarray, target: np.ndarray, values: np.ndarray, down: bool) -> None:
            order = np.lexsort((source, target, -level if down else level))
            level, source, target, score_ = level[order], source[order], target[order], score[order]
            cuts = np.flatnonzero(np.diff(level)) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(level))):
                to = target[a:b]
                heads = np.append(0, np.flatnonzero(np.diff(to)) + 1)
                sums = values[source[a:b]] + score_[a:b]
                most = np.maximum.reduceat(sums, heads)
                group = np.repeat(most, np.diff(np.append(heads, b - a)))
                values[to[heads]] = most + np.log(np.add.reduceat(np.exp(sums - group), heads))

        spread(low + length, begin, end, forward, False)
        spread(low, end, begin, backward, True)
        whole = forward[first + np.arange(len(chunks)) + sizes]
        share = np.exp(forward[begin] + score + backward[end] - whole[own])
        weight = np.rint(n[own] * share * PART).astype(np.int64)
        total = np.zeros(len(self.scores), np.int64)
        np.add.at(total, piece, weight)
        alone = np.flatnonzero(piece == len(self.scores) - 1)
        chars, at = np.unique(codes[start[alone]], return_inverse=True)
        counts = np.zeros(len(chars), np.int64)
        np.add.at(counts, at, weight[alone])
        for c, count in zip(chars.tolist(), counts.tolist()):
            for byte in chr(c).encode():
                total[1 + byte] += count
        return total[:-1], int(np.rint(n * whole * PART).astype(np.int64).sum())


def estimated(documents: DataFrame, pieces: Sequence[str]) -> str:
    """A unigram model of the pieces and byte pieces, saved in a shared folder; its path.

    Log probabilities are fitted to the words of all documents. The driver sees one
    number a piece and round.
    """
    import tokenizers

    spark = documents.sparkSession
    pieces = list(dict.fromkeys([UNKNOWN, *BYTES, *pieces]))
    chunks = documents.select("text").mapInArrow(_chunks(pieces), "chunk string, n long")
    chunks = written(chunks.groupBy("chunk").agg(F.sum("n").alias("n")), "chunks")
    scores, before = np.full(len(pieces), -np.log(len(pieces))), None
    for _ in range(ROUNDS):
        given = spark.sparkContext.broadcast((pieces, scores))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattices = Lattices(*given.value)
            total, likelihood = np.zeros(len(given.value[0]), np.int64), 0
            for batch in sliced(batches, "chunk"):
                more, also = lattices.expected(batch.column("chunk").to_pylist(), batch.column("n").to_numpy())
                total += more
                likelihood += also
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], likelihood), pa.int64())],
                names=["piece", "n"],
            )

        sums = chunks.mapInArrow(expect, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        found = {r["piece"]: r["n"] for r in sums.collect()}
        likelihood = found.pop(-1, 0)
        expected = np.full(len(pieces), SMOOTHING)
        expected[list(found)] += np.array(list(found.values())) / PART
        scores = np.log(expected / expected.sum())
        if before is not None and likelihood - before <= GAIN * abs(before):
            break
        before = likelihood
    tokenizer = tokenizers.Tokenizer(tokenizers.models.Unigram(list(zip(pieces, scores.tolist())), 0, True))
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(split=False)
    path = shared_folder(spark, "unigram")
    spark.createDataFrame([(tokenizer.to_str(),)], "value string").coalesce(1).write.text(path)
    return path


def saved(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model that ``estimated`` has saved."""
    vocab = json.loads(spark.read.text(path).first()[0])["model"]["vocab"]
    return [(piece, score) for piece, score in vocab]


def count_tokens(documents: DataFrame, pieces: Sequence[tuple[str, float]], out: str = "n_tokens") -> DataFrame:
    """The documents, whole rows, with the number of pieces of each whole text.

    A null or empty text has none. The column replaces one of the same name.
    """
    given = documents.sparkSession.sparkContext.broadcast(list(pieces))  # of the vocabulary's size

    fields = [f for f in documents.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.LongType())])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(given.value)
        for batch in sliced(batches, limit=COUNTED_BYTES):
            n = pa.array(counter.column(batch.column("text")), pa.int64())
            kept = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*kept, n], names=schema.fieldNames())

    return documents.mapInArrow(counts, schema)
