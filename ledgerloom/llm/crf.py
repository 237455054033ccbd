"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line and the lines beside
it; a transition weight ties neighbours together. The field is fitted on lines
that take over the label of their document. A document's score is the mean of its
lines' marginal probabilities of being good, weighted by their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import BLOCK_BYTES, blocks, joined, runs, span_hashes
from ledgerloom.llm.samples import held_out, labelled

# The fit reads at most so many labelled documents, leaving out those with more lines than this.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 1000
# Lines whose features are held at a time.
LINES = 1 << 15
THRESHOLD = 0.7
ROUNDS = 200
RATE = 0.1
PENALTY = 1e-3


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[np.frombuffer(chars, np.uint8)] = 1
    return table


_SPACE = _table(b" \t\n\x0b\x0c\r").astype(bool)
_KINDS = {
    "upper": _table(bytes(range(0x41, 0x5B))),
    "lower": _table(bytes(range(0x61, 0x7B))),
    "symbols": _table(b"#*$%&<>@^~_=+\\"),
    "shouts": _table(b"!"),
    "bars": _table(b"|"),
    "digits": _table(b"0123456789"),
    "marks": _table(b".,;:?'\"()[]{}-/"),
    "wide": _table(bytes(range(0xC0, 0x100))),
    "inner": _table(bytes(range(0x80, 0xC0))),
}
OWN = 11
FEATURES = 3 * OWN


def line_features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, the lines' words, and where each text's lines start (one entry more).

    A text without a line end is one line, an empty text one empty line.
    """
    data, starts = joined(raws)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    first = np.searchsorted(begins, starts)
    n = {kind: np.add.reduceat(table[data], begins, dtype=np.int64).astype(np.float64) for kind, table in _KINDS.items()}
    word_at, word_end = runs(~_SPACE[data])
    line_of = np.searchsorted(begins, word_at, "right") - 1
    words = np.bincount(line_of, minlength=len(begins)).astype(np.float64)
    hashes = span_hashes(data, word_at, word_end)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of[again], minlength=len(begins))
    each = np.maximum(words, 1)
    letters = np.maximum(n["upper"] + n["lower"], 1)
    points = np.maximum(ends - begins - n["inner"], 1)
    own = np.stack(
        [
            np.ones(len(begins)),
            np.log1p(words) / 5,
            n["upper"] / letters,
            np.minimum(n["symbols"] / each, 2),
            np.minimum(n["shouts"] / each, 2),
            np.minimum(n["bars"] / each, 2),
            repeats / each,
            n["digits"] / points,
            np.minimum(n["marks"] / each, 2),
            np.minimum(points / each, 30) / 10,
            words == 0,
        ],
        axis=1,
    )
    # Beside the first and the last line of a text there is nothing, all zeros, where a line has its one.
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([own, before, after], axis=1), words, first


@dataclass
class Field:
    """Weights of the features for a good line, and of the transitions [before][after]."""

    weights: np.ndarray
    transitions: np.ndarray


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray):
    """Forward-backward over all texts side by side.

    Gives the probability that each line is good, and the expected number of
    each kind of transition.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    starts, longest = first[:-1][order], int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(1, longest + 1), "right")
    top = np.maximum(scores, 0)
    local = np.stack([np.exp(-top), np.exp(scores - top)], axis=1)
    step = np.exp(transitions - transitions.max())
    forward = np.zeros_like(local)
    for t in range(longest):
        at = starts[: active[t]] + t
        value = local[at] if t == 0 else local[at] * (forward[at - 1] @ step)
        forward[at] = value / value.sum(axis=1, keepdims=True)
    good = np.zeros(len(scores))
    moved = np.zeros((2, 2))
    back = np.ones((len(starts), 2))
    for t in range(longest - 1, -1, -1):
        at = starts[: active[t]] + t
        here = forward[at] * back[: active[t]]
        good[at] = here[:, 1] / here.sum(axis=1)
        if t:
            toward = local[at] * back[: active[t]]
            pair = forward[at - 1][:, :, None] * step[None] * toward[:, None, :]
            moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            value = toward @ step.T
            back[: active[t]] = value / value.sum(axis=1, keepdims=True)
    return good, moved


def fit_field(features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> Field:
    """Weights of the greatest penalised likelihood of lines that all bear their text's label."""
    n = max(len(features), 1)
    line_labels = np.repeat(labels.astype(np.float64), np.diff(first))
    inner = (np.diff(first) - 1).astype(np.float64)
    seen = np.array([[inner[labels == 0].sum(), 0.0], [0.0, inner[labels == 1].sum()]])
    at = np.zeros(FEATURES + 4)
    mean, square = np.zeros_like(at), np.zeros_like(at)
    for number in range(1, ROUNDS + 1 if len(features) else 1):
        weights, transitions = at[:FEATURES], at[FEATURES:].reshape(2, 2)
        good, moved = marginals(features @ weights, first, transitions)
        slope = np.concatenate([features.T @ (line_labels - good), (seen - moved).ravel()]) / n - PENALTY * at
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        at = at + RATE * (mean / (1 - 0.9**number)) / (np.sqrt(square / (1 - 0.99**number)) + 1e-8)
    return Field(at[:FEATURES].copy(), at[FEATURES:].reshape(2, 2).copy())


def chain_marginals(scores: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The probability that each line of one long text is good, with a few numbers a line."""
    step = np.exp(transitions - transitions.max())
    (s00, s01), (s10, s11) = step.tolist()
    bad, good = np.empty(len(scores)), np.empty(len(scores))
    stretches = range(0, len(scores), LINES)

    def local(begin: int) -> tuple[list[float], list[float]]:
        part = scores[begin : begin + LINES]
        top = np.maximum(part, 0)
        return np.exp(-top).tolist(), np.exp(part - top).tolist()

    before: tuple[float, float] | None = None
    for begin in stretches:
        ahead = []
        for x, y in zip(*local(begin)):
            a, b = (x, y) if before is None else (x * (before[0] * s00 + before[1] * s10), y * (before[0] * s01 + before[1] * s11))
            before = (a / (a + b), b / (a + b))
            ahead.append(before)
        bad[begin : begin + LINES], good[begin : begin + LINES] = zip(*ahead)
    b0 = b1 = 1.0
    for begin in reversed(stretches):
        xs, ys = local(begin)
        fs, gs = bad[begin : begin + LINES].tolist(), good[begin : begin + LINES].tolist()
        out = [0.0] * len(xs)
        for at in range(len(xs) - 1, -1, -1):
            a, b = fs[at] * b0, gs[at] * b1
            out[at] = b / (a + b)
            a, b = xs[at] * b0, ys[at] * b1
            b0, b1 = s00 * a + s01 * b, s10 * a + s11 * b
            b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
        good[begin : begin + LINES] = out
    return good


def line_blocks(texts: list, size: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts as ``blocks`` gives them, but no more than ``LINES`` lines together; a text of more stands alone."""
    for at, raws in blocks(texts, size):
        begin = held = 0
        for row, raw in enumerate(raws):
            lines = raw.count(b"\n") + 1
            if row > begin and held + lines > LINES:
                yield at + begin, raws[begin:row]
                begin, held = row, 0
            held += lines
        yield at + begin, raws[begin:]


def long_text(raw: bytes, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score and words of each line of a text of many lines, whose features are made for some lines at a time.

    A stretch is read with the line before it and the line behind it, so that
    its lines have the neighbours they have in the text.
    """
    ends = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10), len(raw))
    scores, words = np.empty(len(ends)), np.empty(len(ends))
    for begin in range(0, len(ends), LINES):
        to = min(begin + LINES, len(ends))
        first, last = max(0, begin - 1), min(to + 1, len(ends))
        features, count, _ = line_features([raw[ends[first - 1] + 1 if first else 0 : ends[last - 1]]])
        own = slice(begin - first, begin - first + to - begin)
        scores[begin:to], words[begin:to] = features[own] @ weights, count[own]
    return scores, words


def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for at, raws in line_blocks(batch.column("text").to_pylist()):
            if len(raws) == 1 and raws[0].count(b"\n") >= SAMPLE_LINES:
                continue
            features, _, first = line_features(raws)
            for row in range(len(raws)):
                if first[row + 1] - first[row] <= SAMPLE_LINES:
                    own = features[first[row] : first[row + 1]].astype(np.float32)
                    out.append((batch.column("doc_id")[at + row].as_py(), batch.column("label")[at + row].as_py(), own.tobytes()))
        types = [pa.int64(), pa.int32(), pa.binary()]
        columns = [pa.array(column, kind) for column, kind in zip(list(zip(*out)) or [(), (), ()], types)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SAMPLE_DOCS) -> Field:
    """A field fitted on at most ``size`` labelled documents; without any, every line is as likely good as bad.

    Documents of more than ``SAMPLE_LINES`` lines are no part of the sample, which bounds what the driver holds.
    """
    rows = labelled(docs, labels, label, size).mapInArrow(sampled, "doc_id long, label int, features binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    each = [np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES) for r in rows]
    features = np.concatenate(each + [np.zeros((0, FEATURES), np.float32)]).astype(np.float64)
    first = np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
    return fit_field(features, first, np.array([r["label"] for r in rows], np.int64))


def scoring(field: Field, lines: bool):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, each = [], []
            for _, raws in line_blocks(batch.column("text").to_pylist()):
                if len(raws) == 1 and raws[0].count(b"\n") >= LINES:
                    values, words = long_text(raws[0], field.weights)
                    good, first = chain_marginals(values, field.transitions), np.array([0, len(values)])
                else:
                    features, words, first = line_features(raws)
                    good, _ = marginals(features @ field.weights, first, field.transitions)
                weight = words + 1
                scores.append(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
                if lines:
                    each += [good[a:b].tolist() for a, b in zip(first, first[1:])]
            others = [name for name in batch.schema.names if name != "text"]
            columns = [batch.column(name) for name in others]
            columns.append(pa.array(np.clip(np.concatenate(scores), 0, 1) if scores else [], pa.float64()))
            if lines:
                columns.append(pa.array(each, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, others + ["score"] + ["lines_good"] * lines)

    return scored


def score(docs: DataFrame, field: Field, lines: bool = False) -> DataFrame:
    """``doc_id`` and ``score`` of every row, with ``lines`` the probability of each line as well.

    Whole texts are read; a null text counts as empty, and an empty text is one
    empty line with a score of its own. A text of very many lines is gone through
    in stretches, at some tens of bytes a line. Repeated rows and null ids give a row
    each, other columns are ignored, an empty table gives no rows.
    """
    schema = f"{docs.select('doc_id').schema['doc_id'].dataType.simpleString()}"
    columns = f"doc_id {schema}, score double" + ", lines_good array<double>" * lines
    return docs.select("doc_id", "text").mapInArrow(scoring(field, lines), columns)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    scored = score(docs, fit(docs, labels, label))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
