"""Quality classifier: nearest labelled neighbours in a latent semantic space.

A bounded sample of labelled documents is laid out as a matrix of weighted features and
reduced by a truncated singular value decomposition.  The sample's vectors are broadcast;
every document is folded into the same space, its cosine with each of them is computed in
blocks, and the labels of the nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NON_SPACE, Words, chunks, map_arrow, mixed

#: Features are hashed into so many columns, documents reduced to so many dimensions.
FEATURES, DIMENSIONS = 8_192, 64
#: Bound of the fitting sample, in rows of each label.
SAMPLE_PER_LABEL = 2_000
#: Neighbours that vote, and the power of the cosine that a vote weighs.
NEIGHBOURS, SHARPNESS = 25, 4
#: Documents whose cosines with the sample are computed at a time.
BLOCK = 256
#: Text of one product of features and weights: rounding follows its rows.
PRODUCT_BYTES = 1 << 20
#: Weight of a feature of a word's form against one of the word itself.
FORM_WEIGHT = 3.0

# Per byte its class in a word's form: capital, small letter or beyond ASCII, digit, itself.
_FORM = np.arange(256, dtype=np.uint8)
_FORM[ord("A"):ord("Z") + 1] = ord("A")
_FORM[ord("a"):ord("z") + 1] = ord("a")
_FORM[0x80:] = ord("a")
_FORM[ord("0"):ord("9") + 1] = ord("0")


@dataclass(frozen=True)
class Model:
    """Feature weights, the folding matrix, the sample's vectors of length 1, their
    labels, and the weight of a vote for each."""

    weights: np.ndarray
    fold: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float


def features_of(data: np.ndarray, offsets: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of a chunk, by document and feature.

    The first half of the features are words, the rest what words look like: their
    form (classes of characters, runs as one), pairs of forms, and whether a word
    repeats the one before it.
    """
    words = Words(data, offsets, NON_SPACE)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(words.doc_starts))
    form = _FORM[data]
    fresh = np.ones(len(form), dtype=bool)
    fresh[1:] = form[1:] != form[:-1]
    fresh[offsets[:-1][offsets[:-1] < len(form)]] = True
    short = np.concatenate([[0], np.cumsum(fresh)])[offsets]
    forms = Words(form[fresh], short, NON_SPACE, lower=False).hashes
    half = FEATURES // 2
    found, docs = [(words.hashes >> np.uint64(8)) % np.uint64(half)], [doc]
    if len(doc):
        form_hashes = [mixed(forms * np.uint64(3))]
        docs.append(doc)
        same = doc[1:] == doc[:-1]
        form_hashes.append(mixed(forms[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + forms[1:])[same])
        docs.append(doc[1:][same])
        again = same & (words.hashes[1:] == words.hashes[:-1])
        form_hashes.append(np.full(int(again.sum()), 7, dtype=np.uint64))
        docs.append(doc[1:][again])
        found.append(np.uint64(half) + np.concatenate(form_hashes) % np.uint64(half))
    key, count = np.unique(np.concatenate(docs).astype(np.int64) * FEATURES
                           + np.concatenate(found).astype(np.int64), return_counts=True)
    return key // FEATURES, key % FEATURES, count


def folded(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, size: int,
           weights: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Vectors of length 1 (or 0) of ``size`` documents in the reduced space."""
    out = np.zeros((size, fold.shape[1]), dtype=np.float32)
    value = (np.log1p(count) * weights[feature]).astype(np.float32)
    cuts = np.searchsorted(doc, np.arange(size + 1))
    for first in range(0, size, BLOCK):
        last = min(first + BLOCK, size)
        a, b = cuts[first], cuts[last]
        held = np.flatnonzero(cuts[first + 1:last + 1] > cuts[first:last])
        if len(held):
            out[first + held] = np.add.reduceat(
                fold[feature[a:b]] * value[a:b, None], cuts[first:last][held] - a)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def fit_space(rows: list[tuple[np.ndarray, np.ndarray]], dimensions: int = DIMENSIONS
              ) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and folding matrix from the (features, counts) of a sample."""
    matrix = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for row, (feature, count) in zip(matrix, rows):
        row[feature] = np.log1p(count)
    held = (matrix > 0).sum(axis=0)
    weights = np.log((1 + len(rows)) / (1 + held)) + 0.1
    weights[FEATURES // 2:] *= FORM_WEIGHT
    weights[held == 0] = 0
    matrix *= weights.astype(np.float32)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    # Range finder with power steps: the largest singular directions.
    random = np.random.default_rng(11).standard_normal((FEATURES, dimensions + 16))
    basis = np.linalg.qr(matrix @ random.astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(matrix @ np.linalg.qr(matrix.T @ basis)[0])[0]
    _, _, right = np.linalg.svd(basis.T @ matrix, full_matrices=False)
    return weights, np.ascontiguousarray(right[:dimensions].T.astype(np.float32))


def held_out(doc_id):
    """The fifth of the documents whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL,
          dimensions: int = DIMENSIONS) -> Model:
    """Fit on a bounded sample of labelled rows, never of the held-out fifth.

    ``labels`` has doc_id and quality; a document with conflicting labels counts as 0.
    The sample holds at most ``sample_per_label`` rows of each label, by a hash of
    doc_id (rows of one doc_id by a hash of their features), each at most ``FEATURES``
    numbers, so what the fitting task and the broadcast hold does not follow the
    input.  The share of each label is counted over all labels that may be learned.
    Without labels every score is 0.5.
    """
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
             .where(~held_out(F.col("doc_id"))))
    shares = {row.quality: row["count"] for row in known.groupBy("quality").count().collect()}
    picked = None
    for label in (0, 1):
        part = (known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(sample_per_label))
        picked = part if picked is None else picked.union(part)
    # At most 2 * sample_per_label rows of two numbers.
    sample = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column("text"), PRODUCT_BYTES):
                doc, feature, count = features_of(data, offsets)
                cuts = pa.array(np.searchsorted(doc, np.arange(end - first + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:end], batch.column("quality")[first:end],
                     pa.ListArray.from_arrays(cuts, pa.array(feature.astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(count.astype(np.int32)))],
                    ["doc_id", "quality", "features", "counts"])

    found = map_arrow(sample.select("doc_id", "quality", "text"), extract,
                      "doc_id bigint, quality int, features array<int>, counts array<int>")
    rows = None
    for label in (0, 1):
        part = found.where(F.col("quality") == label).orderBy(
            F.xxhash64("doc_id"), "doc_id", F.xxhash64("features", "counts")).limit(
            sample_per_label)
        rows = part if rows is None else rows.union(part)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(np.array(f.as_py(), dtype=np.int64), np.array(c.as_py(), dtype=np.int64),
                   label.as_py())
                  for batch in batches for f, c, label in
                  zip(batch.column("features"), batch.column("counts"), batch.column("quality"))]
        sample.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
        if not sample:
            return
        weights, fold = fit_space([r[:2] for r in sample], dimensions)
        doc = np.repeat(np.arange(len(sample)), [len(r[0]) for r in sample])
        vectors = folded(doc, np.concatenate([r[0] for r in sample]),
                         np.concatenate([r[1] for r in sample]), len(sample), weights, fold)
        as_list = [weights[:, None], fold, vectors]
        kinds = ["weight"] * len(weights) + ["fold"] * len(fold) + ["vector"] * len(vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array([*range(len(weights)), *range(len(fold)),
                                        *range(len(vectors))], pa.int32()),
             pa.array([-1] * (len(weights) + len(fold)) + [r[2] for r in sample], pa.int32()),
             pa.array([row for part in as_list for row in part.astype(np.float64)],
                      pa.list_(pa.float64()))], ["kind", "at", "quality", "numbers"])

    table = map_arrow(rows.repartition(1), fit,
                      "kind string, at int, quality int, numbers array<double>").toArrow()
    if not table.num_rows:
        nothing = np.zeros(0)
        return Model(np.zeros(FEATURES), np.zeros((FEATURES, 1), np.float32),
                     np.zeros((0, 1), np.float32), nothing, nothing, 0.5)
    parts: dict[str, np.ndarray] = {}
    kind, at = (table.column(c).to_numpy() for c in ("kind", "at"))
    quality = table.column("quality").to_numpy()
    numbers = table.column("numbers").to_pylist()
    for name in ("weight", "fold", "vector"):
        own = np.flatnonzero(kind == name)
        own = own[np.argsort(at[own], kind="stable")]
        parts[name] = np.array([numbers[i] for i in own])
        if name == "vector":
            labels_of = quality[own]
    # A label that the sample holds a smaller part of votes with more weight.
    sampled = np.bincount(labels_of, minlength=2)
    votes = np.array([shares.get(k, 0) / max(sampled[k], 1) for k in (0, 1)])[labels_of]
    return Model(parts["weight"][:, 0], parts["fold"].astype(np.float32),
                 parts["vector"].astype(np.float32), labels_of.astype(float), votes,
                 shares.get(1, 0) / sum(shares.values()))


def vote(vectors: np.ndarray, model: Model, neighbours: int = NEIGHBOURS,
         sharpness: float = SHARPNESS) -> np.ndarray:
    """Share of the votes for label 1 among the nearest of the sample.

    All that are as near as the last of ``neighbours`` vote; a document that is near
    none gets the share of label 1 among all labels.
    """
    out = np.full(len(vectors), model.prior)
    if not len(model.vectors):
        return out
    last = max(len(model.vectors) - neighbours, 0)
    for first in range(0, len(vectors), BLOCK):
        cosine = vectors[first:first + BLOCK] @ model.vectors.T
        bar = np.partition(cosine, last, axis=1)[:, last]
        doc, near = np.nonzero((cosine >= bar[:, None]) & (cosine > 0))
        weight = cosine[doc, near].astype(np.float64) ** sharpness * model.votes[near]
        size = len(cosine)
        total = np.bincount(doc, weight, size)
        good = np.bincount(doc, weight * model.labels[near], size)
        out[first:first + size] = (good + 1e-9 * model.prior) / (total + 1e-9)
    return out


def score(documents: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """All columns of ``documents`` and ``name``: how likely label 1 is, from 0 to 1.

    Reads whole texts; NULL counts as empty, and an empty text gets the share of label 1
    among the labels.  A column called ``name`` already is replaced.  The broadcast holds
    the folding matrix and at most twice the sample's vectors, whatever the input.
    """
    spark = documents.sparkSession
    kept = documents.drop(name)
    text_at = kept.columns.index("text")
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, end, data, offsets in chunks(batch.column(text_at), PRODUCT_BYTES):
                found = features_of(data, offsets)
                vectors = folded(*found, end - first, model.weights, model.fold)
                scores[first:end] = vote(vectors, model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)],
                                             schema.fieldNames())

    return map_arrow(kept, apply, schema)
