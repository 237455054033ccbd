"""Toxicity by multiple-instance learning over sentences.

A sentence's score is the logistic of the summed weights of its different words and
beginnings of words. A document is toxic unless none of its sentences is: its score
is the noisy-or of theirs. The weights are fitted on document labels alone, and
then say which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import blocks, joined, mixed, span_hashes, tokens
from ledgerloom.llm.samples import held_out, labelled
from ledgerloom.llm.tiling import folded
from ledgerloom.session import written_table

BITS = 20
# Beginnings of words that count beside whole words, in bytes.
PREFIXES = (4, 5, 6, 7, 8)
# The fit reads at most so many labelled documents, and looks at so many features.
SAMPLE_DOCS = 8000
SAMPLE_FEATURES = 4000
LEAST_DOCS = 3
# How far from chance a feature must be, in standard deviations, to be looked at.
SIGNIFICANT = 4.0
THRESHOLD = 0.3
ROUNDS = 300
RATE = 0.05
PENALTY = 0.01

_STOPS = np.zeros(256, np.uint8)
_STOPS[np.frombuffer(b".!?\n", np.uint8)] = 1


@dataclass
class Model:
    """A weight per hashed feature, and the score of a sentence without a known one."""

    weights: np.ndarray
    bias: float


@dataclass
class Bags:
    """Sentences with a word: their texts and spans, and the different known features of each."""

    features: np.ndarray
    sentence: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def features(data: np.ndarray, begin: np.ndarray, end: np.ndarray, whole: np.ndarray):
    """Numbers of the features of every word, one array of (word, feature) per kind."""
    yield np.arange(len(whole)), (whole >> np.uint64(64 - BITS)).astype(np.int64)
    for size in PREFIXES:
        word = np.flatnonzero(end - begin >= size)
        hashes = mixed(span_hashes(data, begin[word], begin[word] + size) + np.uint64(size))
        yield word, (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def sentences(raws: list[bytes], known: np.ndarray | None = None) -> Bags:
    """Split lower-cased texts at ``. ! ?`` and line ends; sentences without a word are left out.

    With ``known``, a flag per feature, other features are left out.
    """
    data, starts = joined(raws)
    begin, end, hashes = tokens(data)
    stops = np.cumsum(_STOPS[data], dtype=np.int64)
    if not len(begin):
        none = np.zeros(0, np.int64)
        return Bags(none, none, none, none, none)
    _, sentence = np.unique(stops[begin], return_inverse=True)
    sentence = sentence.astype(np.int64)
    text = np.searchsorted(starts, begin, "right") - 1
    first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
    last = np.append(first[1:], len(begin)) - 1
    pairs = []
    for word, feature in features(data, begin, end, hashes):
        if known is not None:
            use = known[feature]
            word, feature = word[use], feature[use]
        pairs.append(sentence[word] << BITS | feature)
    found = np.unique(np.concatenate(pairs))
    of = text[first]
    return Bags(found & ((1 << BITS) - 1), found >> BITS, of, begin[first] - starts[of], end[last] - starts[of])


def sentence_scores(bags: Bags, model: Model) -> np.ndarray:
    return np.bincount(bags.sentence, model.weights[bags.features], minlength=len(bags.text)) + model.bias


def fit_model(
    known: np.ndarray, odds: np.ndarray, feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, labels: np.ndarray
) -> Model:
    """Weights of the features ``known`` by proximal steps on the noisy-or likelihood, starting at their ``odds``.

    ``feature`` and ``sentence`` are the known features of each sentence, ``doc``
    numbers the document of every sentence.
    """
    weights = np.zeros(1 << BITS, np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(weights, -6.0 if share < 0.5 else 6.0)
    place = np.zeros(1 << BITS, np.int64)
    place[known] = np.arange(len(known))
    local = place[feature]
    toxic, n, bias = labels[doc] == 1, len(labels), -6.0
    # Several features speak for the same word, so each starts with its part.
    value = odds / (1 + len(PREFIXES))
    steps, bias_steps = np.full(len(known), 1e-2), 1e-2
    for _ in range(ROUNDS):
        scores = np.bincount(sentence, value[local], minlength=len(doc)) + bias
        soft = np.logaddexp(0, scores)
        chance = np.exp(scores - soft)
        total = np.maximum(np.bincount(doc, soft, minlength=n), 1e-9)
        pull = 1 / np.expm1(np.minimum(total, 500))
        slope = np.where(toxic, -chance * pull[doc], chance)
        slopes = np.bincount(local, slope[sentence], minlength=len(known))
        steps += slopes**2
        rate = RATE / np.sqrt(steps)
        value = value - rate * slopes
        value = np.sign(value) * np.maximum(np.abs(value) - rate * PENALTY * np.sqrt(n), 0)
        bias_slope = float(slope.sum())
        bias_steps += bias_slope**2
        bias -= RATE * bias_slope / np.sqrt(bias_steps)
    weights[known] = value
    return Model(weights, bias)


def document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different features of every document, one row each."""
    for batch in batches:
        for at, raws in blocks([folded(text) for text in batch.column("text").to_pylist()]):
            for row, raw in enumerate(raws, at):
                found = np.unique(sentences([raw]).features)
                label = batch.column("label")[row].as_py()
                columns = [pa.array(found, pa.int64()), pa.array(np.full(len(found), label, np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "label"])


def sampling(known: np.ndarray):
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at, raws in blocks([folded(text) for text in batch.column("text").to_pylist()]):
                for row, raw in enumerate(raws, at):
                    bags = sentences([raw], known)
                    packed = [bags.features.astype(np.int32).tobytes(), bags.sentence.astype(np.int32).tobytes()]
                    out.append((batch.column("doc_id")[row].as_py(), batch.column("label")[row].as_py(), len(bags.text), *packed))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(list(zip(*out)) or [()] * 5, types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "n", "features", "sentences"])

    return sampled


def significant(rows: DataFrame, label: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features far more frequent in toxic documents than chance allows, and the log odds of each."""
    of = label.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == 1).cast("int")).alias("toxic")).first()
    n, toxic = of["n"], of["toxic"] or 0
    if not 0 < toxic < n:
        return np.zeros(0, np.int64), np.zeros(0)
    expected = F.col("all") * (toxic / n)
    excess = (F.col("toxic") - expected) / F.sqrt(expected * (1 - toxic / n))
    found = (
        rows.mapInArrow(document_features, "feature long, label int")
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("all"), F.sum((F.col("label") == 1).cast("int")).alias("toxic"))
        .where((F.col("all") >= LEAST_DOCS) & (excess > SIGNIFICANT))
        .orderBy(excess.desc(), "feature")
        .limit(SAMPLE_FEATURES)
        .collect()
    )
    found.sort(key=lambda r: r["feature"])
    held = np.array([(r["toxic"], r["all"] - r["toxic"]) for r in found], float).reshape(-1, 2)
    odds = np.log((held[:, 0] + 0.5) / (toxic + 1)) - np.log((held[:, 1] + 0.5) / (n - toxic + 1))
    return np.array([r["feature"] for r in found], np.int64), odds


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE_DOCS) -> Model:
    """A model fitted on at most ``size`` labelled documents; without both labels every text gets the same verdict.

    Frequencies of features are counted over the sample by Spark. The driver
    gets the significant ones, ``SAMPLE_FEATURES`` at most, and where they occur.
    """
    rows = written_table(labelled(docs, labels, label, size), "mil-sample")
    known, odds = significant(rows, rows.select("label"))
    flags = np.zeros(1 << BITS, bool)
    flags[known] = True
    found = rows.mapInArrow(sampling(flags), "doc_id long, label int, n int, features binary, sentences binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    feature, sentence, doc, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for number, row in enumerate(found):
        feature.append(np.frombuffer(row["features"], np.int32).astype(np.int64))
        sentence.append(np.frombuffer(row["sentences"], np.int32).astype(np.int64) + count)
        doc.append(np.full(row["n"], number, np.int64))
        count += row["n"]
    label_of = np.array([r["label"] for r in found], np.int64)
    return fit_model(known, odds, *(np.concatenate(part) for part in (feature, sentence, doc)), label_of)


def scoring(model: Model, threshold: float):
    known = model.weights != 0
    offending = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, offences = [], []
            for _, raws in blocks([folded(text) for text in batch.column("text").to_pylist()]):
                bags = sentences(raws, known)
                value = sentence_scores(bags, model)
                # 1 - prod(1 - p), with log(1 - p) = -log(1 + exp(score)); no sentence counts as one without a known word.
                total = np.bincount(bags.text, np.logaddexp(0, value), minlength=len(raws))
                bare = np.bincount(bags.text, minlength=len(raws)) == 0
                total[bare] = np.logaddexp(0, model.bias)
                scores.append(-np.expm1(-total))
                found: list[list[dict]] = [[] for _ in raws]
                chance = np.exp(value - np.logaddexp(0, value))
                for at in np.flatnonzero(chance >= threshold):
                    found[bags.text[at]].append({"begin": int(bags.begin[at]), "end": int(bags.end[at]), "score": float(chance[at])})
                offences += found
            others = [name for name in batch.schema.names if name != "text"]
            columns = [batch.column(name) for name in others]
            columns.append(pa.array(np.clip(np.concatenate(scores), 0, 1) if scores else [], pa.float64()))
            columns.append(pa.array(offences, offending))
            yield pa.RecordBatch.from_arrays(columns, others + ["score", "offending"])

    return scored


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``offending`` (spans in bytes of the text) of every row.

    Whole texts are read. A text without a word (null, empty, blank) scores like
    one sentence without a known word. Repeated rows and null ids give a row
    each, other columns are ignored, an empty table gives no rows.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, score double, offending array<struct<begin: int, end: int, score: double>>"
    return docs.select("doc_id", "text").mapInArrow(scoring(model, threshold), columns)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``offending`` of every row."""
    scored = score(docs, fit(docs, labels, label), threshold)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending"
    )
