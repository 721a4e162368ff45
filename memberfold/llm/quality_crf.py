"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and its neighbours'; the
chain's forward-backward marginals, weighted by line length, make the document's score.

Only documents are labelled. Their lines' labels are latent: the chain is fitted so that the
length-weighted marginals of a document meet its label, and, where a good and a bad document
are put one after the other, the share of the good one. The latter teach where to switch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from memberfold.llm.common import as_bytes, sliced

# Labelled documents that the model is fitted on at most: those of the smallest hashes.
SAMPLE = 3000
# Bytes that the sample's texts and line features may take; documents are taken whole, in the
# order of their hashes, until they are reached, whatever the length of the next.
SAMPLE_BYTES, LINE_BYTES = 64 << 20, 700
STEPS, RATE, RIDGE = 150, 0.05, 1e-3
THRESHOLD = 0.3
# A share is told from 0 and 1 by this much; lines' log odds are moved so far for a derivative.
LEAST_SHARE, MOVE = 1e-3, 1e-4
# Features of a line without its neighbours'.
N_OWN = 14

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True
_SIGN &= ~_STOP
_CLASSES = [x.astype(np.uint8) for x in (_UPPER, _ALPHA, _DIGIT, _STOP, _SIGN)]


def _lines(text: bytes) -> list[bytes]:
    """The lines that are not blank; of a text without such lines, an empty one."""
    lines = text.split(b"\n")
    return lines if len(lines) == 1 else [x for x in lines if x.strip()] or [b""]


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with its neighbours', and each line's length in bytes.

    A text without lines counts as one empty line.
    """
    lines = _lines(text)
    sizes = np.array([len(x) for x in lines], np.int64)
    data = np.frombuffer(b"".join(lines), np.uint8)
    ends = np.cumsum(sizes)
    shares = np.zeros((len(lines), len(_CLASSES)))
    for k, members in enumerate(_CLASSES):
        total = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        shares[:, k] = (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1)
    rest = np.zeros((len(lines), 8))
    seen: set[bytes] = set()
    for k, line in enumerate(lines):
        words = line.split()
        n = len(words)
        rest[k, 0] = np.log1p(n) / 5
        rest[k, 1] = len(line) / (n + 1) / 10
        rest[k, 2] = len(set(words)) / n if n else 1.0
        rest[k, 3] = n > 1 and sum(map(bytes.__eq__, words, words[1:])) / (n - 1)
        rest[k, 4] = line in seen
        rest[k, 5] = line.rstrip()[-1:] in b".!?\"" and n > 0
        rest[k, 6] = n > 0 and sum(map(bytes.isalnum, words)) / n
        rest[k, 7] = n < 4
        seen.add(line)
    own = np.concatenate([np.ones((len(lines), 1)), shares, rest], axis=1)
    edge = np.zeros((1, own.shape[1]))
    before, after = np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])
    return np.concatenate([own, before, after], axis=1), sizes


@dataclass
class Model:
    """Weights for a line being good, and potentials of pairs of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray
    shift: float = 0.0
    slope: float = 1.0


def marginals(unary: np.ndarray, pairs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-space forward-backward over many chains put end to end.

    ``unary`` is the log odds of good, ``starts`` marks each chain's first line. Returns
    the probability of good for each line, and the expected pairs of labels in all.
    """
    n = len(unary)
    chain = np.flatnonzero(starts)
    length = np.diff(np.append(chain, n))
    order = np.argsort(-length, kind="stable")
    chain, length = chain[order], length[order]
    node = np.stack([np.zeros(n), unary], axis=1)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[chain] = node[chain]
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), "left")
    for k in range(1, longest):
        at = chain[: alive[k]] + k
        ahead[at] = node[at] + np.logaddexp(ahead[at - 1, :1] + pairs[0], ahead[at - 1, 1:] + pairs[1])
    for k in range(longest - 2, -1, -1):
        at = chain[: alive[k + 1]] + k
        last = node[at + 1] + back[at + 1]
        back[at] = np.logaddexp(last[:, :1] + pairs[:, 0], last[:, 1:] + pairs[:, 1])
    both = ahead + back
    norm = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - norm)
    inner = np.flatnonzero(~starts)
    joint = ahead[inner - 1][:, :, None] + pairs + (node + back)[inner][:, None, :] - norm[inner][:, None, None]
    return good, np.exp(joint).sum(axis=0)


def _chains(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of all lines end to end, their texts, and where chains start."""
    parts = [line_features(t) for t in texts]
    x = np.concatenate([p[0] for p in parts])
    sizes = np.concatenate([p[1] for p in parts]).astype(float) + 1
    owner = np.repeat(np.arange(len(texts)), [len(p[1]) for p in parts])
    return x, sizes, owner, np.concatenate([[True], owner[1:] != owner[:-1]])


def line_marginals(model: Model, text: bytes) -> np.ndarray:
    """Probability of each line that is not blank (of an empty text's one) to be good."""
    x, _, _, starts = _chains([text])
    return marginals(x @ model.weights, model.pairs, starts)[0]


def document_scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """Marginals of good lines, weighted by the lines' lengths, on the calibrated scale."""
    if not texts:
        return np.zeros(0)
    x, sizes, owner, starts = _chains(texts)
    good, _ = marginals(x @ model.weights, model.pairs, starts)
    share = np.bincount(owner, good * sizes) / np.bincount(owner, sizes)
    return 1 / (1 + np.exp(-np.clip(model.slope * (share - model.shift), -50, 50)))


def _spliced(texts: list[bytes], labels: list[int]) -> tuple[list[bytes], list[float]]:
    """Every second text of the more frequent label beside one of the other, in turns first
    and last, and the share that the good one has of the whole."""
    sides = [[t for t, label in zip(texts, labels) if label == of and t.strip()] for of in (0, 1)]
    fewer, more = sorted((0, 1), key=lambda of: len(sides[of]))
    made, shares = [], []
    for k, text in enumerate(sides[more][::2] if sides[fewer] else []):
        other = sides[fewer][k % len(sides[fewer])]
        made.append(b"\n".join((text, other) if k % 2 else (other, text)))
        weight = [sum(len(line) + 1 for line in _lines(t)) for t in (text, other)]
        shares.append(weight[0 if more else 1] / sum(weight))
    return made, shares


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """Maximum likelihood with a ridge of shares of good lines, the lines' labels unknown.

    The derivative of a chain's weighted marginals is the covariance of that sum with the
    chain's statistics: what these change by if the log odds move along the weights.
    """
    width = 3 * N_OWN
    if len(set(labels)) < 2:
        # Nothing to tell apart: every document gets the only label there is, or 1.
        return Model(np.zeros(width), np.zeros((2, 2)), shift=-1.0 if not labels or labels[0] else 2.0, slope=5.0)
    made, shares = _spliced(texts, labels)
    x, sizes, owner, starts = _chains([*texts, *made])
    target = np.array([*labels, *shares], float)
    weights = sizes / np.bincount(owner, sizes)[owner]
    value, first, second = (np.zeros(width + 4) for _ in range(3))
    for step in range(1, STEPS + 1):
        odds, pairs = x @ value[:width], value[width:].reshape(2, 2)
        good, inner = marginals(odds, pairs, starts)
        share = np.clip(np.bincount(owner, good * weights), LEAST_SHARE, 1 - LEAST_SHARE)
        along = ((target - share) / (share * (1 - share)))[owner] * weights
        move = MOVE / max(np.abs(along).max(), MOVE)
        moved, inner_moved = marginals(odds + move * along, pairs, starts)
        slope = np.concatenate([x.T @ (moved - good), (inner_moved - inner).ravel()]) / move
        slope = slope / len(target) - RIDGE * value
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        value += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return _calibrated(Model(value[:width], value[width:].reshape(2, 2)), texts, labels)


def _calibrated(model: Model, texts: list[bytes], labels: list[int]) -> Model:
    """Put the share of good lines that divides the sample best at the threshold."""
    good, y = _shares(model, texts), np.array(labels)
    order = np.argsort(good, kind="stable")
    right = np.concatenate([[y.sum()], y.sum() + np.cumsum(np.where(y[order] == 1, -1, 1))])
    edges = np.concatenate([[0.0], (good[order][1:] + good[order][:-1]) / 2, [1.0]])
    best = np.flatnonzero(right == right.max())
    cut = float(edges[best[len(best) // 2]])
    slope = 8.0
    return Model(model.weights, model.pairs, cut - np.log(THRESHOLD / (1 - THRESHOLD)) / slope, slope)


def _shares(model: Model, texts: list[bytes]) -> np.ndarray:
    """Length-weighted marginals of texts, before any calibration."""
    plain = document_scores(Model(model.weights, model.pairs, 0.0, 1.0), texts)
    return np.log(plain / (1 - plain))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most SAMPLE labelled documents, those of the smallest hashes of doc_id.

    They end with the one that reaches SAMPLE_BYTES; no other is left out for its length.
    Rows with a null doc_id, or a quality other than 0 and 1, teach nothing.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("label")
    )
    chosen = known.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(SAMPLE)
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("doc_id", "text", "label")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("text"), F.col("label")]
    size = F.coalesce(F.octet_length("text") + LINE_BYTES * (1 + F.regexp_count("text", F.lit("\n"))), F.lit(LINE_BYTES))
    # The window has at most SAMPLE rows, without their texts.
    sized = rows.select("doc_id", F.xxhash64("text").alias("of"), "label", size.alias("size"))
    sized = sized.orderBy(order[0], "doc_id", "of", "label").limit(SAMPLE)
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "of", "label").rowsBetween(Window.unboundedPreceding, -1)
    n = sized.select(F.coalesce(F.sum("size").over(before), F.lit(0)).alias("taken")).where(F.col("taken") < SAMPLE_BYTES).count()
    rows = rows.orderBy(*order).limit(n).collect()
    return fit([(r["text"] or "").encode() for r in rows], [r["label"] for r in rows])


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, whole rows, with ``score`` (0 to 1) and ``predicted`` (1: good).

    A null or empty text is scored as one empty line. The two columns replace columns
    of the documents with these names.
    """

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        found: Iterator[np.ndarray] = (
            document_scores(model, as_bytes(part.column("text"))) for part in sliced([batch])
        )
        return pd.Series(np.concatenate([np.zeros(0), *found]), index=texts.index)

    own = [c for c in documents.columns if c not in ("score", "predicted")]
    scored = documents.select(*own, scores("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
