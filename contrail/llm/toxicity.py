"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALPHANUMERIC, Words, chunks, map_arrow, mixed

BITS = 20
#: Bound of the training sample, in documents of each label.
SAMPLE_PER_LABEL = 6_000
#: Characters of a text of the sample that are fitted on, at most.
SAMPLE_CHARS = 100_000


@dataclass(frozen=True)
class Model:
    """Sparse weights: feature numbers in order, their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def word_features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, word pairs and pairs one word apart: (feature, document)."""
    words = Words(data, offsets, ALPHANUMERIC)
    h = words.hashes
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(words.doc_starts))
    parts, docs = [h], [doc]
    for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            pair = mixed(h[:-gap] * np.uint64(salt) + h[gap:])
            parts.append(pair[same])
            docs.append(doc[gap:][same])
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(docs)


def fit_ftrl(examples: list[tuple[np.ndarray, int]], bits: int = BITS,
             alpha: float = 1.0, beta: float = 1.0, l1: float | None = None,
             l2: float = 1.0, epochs: int | None = None
             ) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal: each coordinate has its own rate, and L1 keeps most at zero.

    ``examples`` holds the distinct features of a document and its label.  The
    last coordinate is the bias, without a penalty.  By default L1 follows the
    number of examples, and few examples are gone through more often.
    """
    l1 = min(max(0.0025 * len(examples), 4.0), 20.0) if l1 is None else l1
    epochs = epochs or (4 if len(examples) > 2000 else 8)
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    penalty = np.full(size, l1)
    penalty[-1] = 0.0

    def weights(at):
        zi, pi = z[at], penalty[at]
        return np.where(np.abs(zi) <= pi, 0.0,
                        (np.sign(zi) * pi - zi) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            features, label = examples[i]
            at = np.append(features, size - 1)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            was = n[at]
            z[at] += g - (np.sqrt(was + g * g) - np.sqrt(was)) / alpha * w
            n[at] = was + g * g
    w = weights(np.arange(size))
    kept = np.flatnonzero(w[:-1])
    return kept, w[kept], float(w[-1])


def train(documents: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL,
          bits: int = BITS) -> Model:
    """Fit on a bounded sample of labelled rows, never of the held-out fifth.

    ``labels`` has doc_id and toxic; conflicting or repeated labels of a document
    count as toxic if one is.  The sample holds at most ``sample_per_label`` rows of
    each label, chosen by a hash of doc_id (rows of one doc_id by a hash of their
    features), each with its first ``SAMPLE_CHARS`` characters, so its size (and what
    a task or a broadcast holds of it) does not follow the input.  Scores are
    calibrated to the sample's balance of labels.  Without labels the model is
    empty and every score is 0.5.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .where(~held_out(F.col("doc_id"))))
    picked = None
    for label in (0, 1):
        part = (known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(sample_per_label))
        picked = part if picked is None else picked.union(part)
    # At most 2 * sample_per_label rows of two numbers.
    sample = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        F.left("text", F.lit(SAMPLE_CHARS)).alias("text"), "toxic",
        F.xxhash64("doc_id").alias("place"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            place = batch.column("place")
            for first, end, data, offsets in chunks(batch.column("text")):
                feature, doc = word_features(data, offsets, bits)
                pairs = np.unique((doc.astype(np.int64) << bits) | feature)
                cuts = np.searchsorted(pairs >> bits, np.arange(end - first + 1))
                low = (pairs & ((1 << bits) - 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic[first:end], pa.int32()), place[first:end],
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(low))],
                    ["toxic", "place", "features"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(np.asarray(features, dtype=np.int64), label)
                    for batch in batches
                    for features, label in zip(batch.column("features").to_numpy(
                        zero_copy_only=False), batch.column("toxic").to_pylist())]
        examples.sort(key=lambda e: (e[1], len(e[0]), e[0].tobytes()))
        features, weights, bias = fit_ftrl(examples, bits)
        if not any(label for _, label in examples):
            bias = min(bias, 0.0) - 1e-9 if examples else 0.0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(features, -1), pa.int64()),
             pa.array(np.append(weights, bias), pa.float64())], ["feature", "weight"])

    found = map_arrow(sample, extract, "toxic int, place bigint, features array<int>")
    some = None
    for label in (0, 1):
        part = (found.where(F.col("toxic") == label).orderBy("place", F.xxhash64("features"))
                .limit(sample_per_label).select("toxic", "features"))
        some = part if some is None else some.union(part)
    rows = map_arrow(some.repartition(1), fit, "feature bigint, weight double").toArrow()
    features = rows.column("feature").to_numpy()
    weights = rows.column("weight").to_numpy()
    order = np.argsort(features, kind="stable")
    features, weights = features[order], weights[order]
    bias = float(weights[0]) if len(weights) else 0.0
    return Model(features[1:], weights[1:], bias)


def held_out(doc_id):
    """The fifth of the documents whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score(documents: DataFrame, model: Model, bits: int = BITS, name: str = "toxicity"
          ) -> DataFrame:
    """All columns of ``documents`` and ``name`` (0 to 1); NULL text counts as empty.

    A column called ``name`` already is replaced.  Reads whole texts; repeated rows score
    alike, and an empty table gives none.  Each feature counts once a document.  The weights are
    broadcast: at most ``2**bits`` of them, mostly far fewer through L1.
    """
    spark = documents.sparkSession
    kept = documents.drop(name)
    names = [*kept.columns, name]
    text_at = kept.columns.index("text")
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weight = np.zeros(1 << bits)
        weight[model.features] = model.weights
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, end, data, offsets in chunks(batch.column(text_at)):
                feature, doc = word_features(data, offsets, bits)
                hit = weight[feature] != 0
                pairs = np.unique((doc[hit].astype(np.int64) << bits) | feature[hit])
                sums = np.bincount(pairs >> bits, weight[pairs & ((1 << bits) - 1)],
                                   end - first)
                scores[first:end] = 1 / (1 + np.exp(-np.clip(sums + model.bias, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names)

    return map_arrow(kept, apply, schema)


def reject(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns whatever
    their names.  Rows without text or doc_id are scored like others; repeated rows stay
    or go together; without documents there are none.  Where there is no label to learn
    from, all documents stay."""
    model = train(documents, labels)
    if not len(model.features) and not model.bias:
        return documents
    name = "toxicity"
    while name in documents.columns:
        name += "_"
    return (score(documents, model, name=name)
            .where(F.col(name) < threshold).select(*documents.columns))
