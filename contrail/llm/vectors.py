"""Embedding near-dedup: inverted lists with residual product codes, exact cosine rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, saved, ship

#: Vectors the index is fitted on, at least; above, so many for each of its lists.
SAMPLE = 8_192
SAMPLE_PER_LIST = 8
#: Bytes of that sample, at most: it bounds the lists of very wide vectors.
SAMPLE_BYTES = 128 << 20
#: Lists of the index at most; below it the square root of the number of vectors.
LISTS = 16_384
PROBES = 16
SUBSPACES = 8
CODES = 64
COSINE = 0.95
#: Bytes of the vectors of a tile: what one task compares with a quarter as many others.
TILE_BYTES = 8 << 20
LEAST_TILE = 1_024
#: Distances that one numpy step holds.
CELLS = 1 << 20
#: Centroids stand apart by so many times the distance of vectors that link.
APART = 1.5
#: Rounding of single precision in a distance of unit vectors, at most.
ROUNDING = 1e-5


@dataclass(frozen=True)
class Index:
    """Coarse centroids, and the codewords of each subspace for residuals."""

    centroids: np.ndarray  # lists x dimensions
    codewords: np.ndarray  # subspaces x codes x width
    width: int


def _slices(rows: int, columns: int) -> Iterator[slice]:
    """Slices of ``rows`` of which each, by ``columns``, has at most CELLS cells."""
    step = max(1, CELLS // max(columns, 1))
    return (slice(first, first + step) for first in range(0, rows, step))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (centres ** 2).sum(1)[None, :]
    found = np.zeros(len(points), dtype=np.int64)
    for some in _slices(len(points), len(centres)):
        found[some] = np.argmin(squares - 2 * points[some] @ centres.T, axis=1)
    return found


def k_means(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of at most ``k`` clusters; deterministic."""
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def thinned(centres: np.ndarray, apart: float) -> np.ndarray:
    """Of the centres, in order, those at least ``apart`` from all taken before."""
    squares, taken = (centres ** 2).sum(1), np.ones(len(centres), dtype=bool)
    for i in range(len(centres)):
        if taken[i]:
            far = squares[i + 1:] + squares[i] - 2 * centres[i + 1:] @ centres[i]
            taken[i + 1:] &= far >= apart ** 2
    return centres[taken]


def fit(sample: np.ndarray, lists: int = LISTS, subspaces: int = SUBSPACES,
        codes: int = CODES, apart: float = 0.0) -> Index:
    """An index fitted on unit vectors (a bounded sample).

    Its centroids are at least ``apart`` from one another: else a crowd of near
    copies, which the sample holds many of, would be torn into more lists than its
    members look into.
    """
    width = -(-sample.shape[1] // subspaces)
    centroids = thinned(k_means(sample, lists, 1), apart)
    residuals = _padded(sample - centroids[_nearest(sample, centroids)], subspaces * width)
    words = []
    for m in range(subspaces):
        found = k_means(residuals[:, m * width:(m + 1) * width], codes, 2 + m)
        words.append(np.vstack([found, np.repeat(found[:1], codes - len(found), axis=0)]))
    return Index(centroids, np.stack(words), width)


def _padded(points: np.ndarray, width: int) -> np.ndarray:
    return np.pad(points, ((0, 0), (0, width - points.shape[1])))


def encode(index: Index, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the residuals, and how far each vector lies from what its codes say."""
    subspaces, _, width = index.codewords.shape
    residuals = _padded(units - index.centroids[lists], subspaces * width)
    codes = np.empty((len(units), subspaces), dtype=np.uint8)
    error = np.zeros(len(units))
    for m in range(subspaces):
        part = residuals[:, m * width:(m + 1) * width]
        codes[:, m] = _nearest(part, index.codewords[m])
        error += ((part - index.codewords[m][codes[:, m]]) ** 2).sum(1)
    return codes, np.sqrt(error)


def distances(index: Index, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
    """Asymmetric distances: exact queries to the coded vectors of list ``at``, by a
    table of each query's distances to every codeword."""
    subspaces, _, width = index.codewords.shape
    shifted = _padded(queries - index.centroids[at], subspaces * width)
    total = np.zeros((len(codes), len(queries)))
    for m in range(subspaces):
        part, words = shifted[:, m * width:(m + 1) * width], index.codewords[m]
        lookup = ((part ** 2).sum(1)[None, :] + (words ** 2).sum(1)[:, None]
                  - 2 * words @ part.T)
        total += lookup[codes[:, m]]
    return np.sqrt(np.maximum(total, 0)).T


def _probes(index: Index, units: np.ndarray, probes: int) -> np.ndarray:
    """The nearest lists of each vector, its own first."""
    probes = min(probes, len(index.centroids))
    squares = (index.centroids ** 2).sum(1)[None, :]
    found = np.zeros((len(units), probes), dtype=np.int32)
    for some in _slices(len(units), len(index.centroids)):
        far = squares - 2 * units[some] @ index.centroids.T
        near = np.sort(np.argpartition(far, probes - 1, axis=1)[:, :probes], axis=1)
        order = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
        found[some] = np.take_along_axis(near, order, 1)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False))


def _components(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the links between two arrays, without
    the components' smallest nodes themselves."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[:len(left)], at[len(left):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            own = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[own], nodes[label[own]]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, lists: int | None = None,
                    probes: int = PROBES, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``vectors`` (vec_id, embedding).

    Vectors are linked when their cosine, in double precision, is at least
    ``cosine``; no link below it is reported, and those found are checked exactly.
    n_links counts the other vectors linked directly, component_id is the smallest
    vec_id reachable.  A vector that is NULL, empty, zero or holds NULL or
    non-finite components links with nothing, and vectors of different length do
    not link.  A row without vec_id has no links and no component.  Rows that
    repeat a vec_id with the same vector count as separate vectors.

    Equal vectors are one class with its number of rows, so copies cost nothing.
    The index is fitted on at most ``sample`` classes, or SAMPLE_PER_LIST for each list
    if that is more, taken by hash; the lists grow with the root of the number of
    classes.  Every class is stored with the codes of its residual in the list of its
    nearest centroid and looks into its ``probes`` nearest lists.  Codes meet queries
    tile by tile, so a large list spreads over many tasks.  The distance to a coded
    vector errs by no more than the coding error kept with it, so no pair is lost there;
    only lists not probed can cost one.  Vectors that come near no code and no query are
    done with; the full vectors of the others are fetched and compared exactly, in the
    same tiles.  A link that only one of its ends finds counts for both.  A tile returns
    counts and a spanning forest of its links, not the links.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate(
        "e", F.lit(0.0), lambda s, x: s + x * x)))
    fit_for_use = (F.col("vec_id").isNotNull() & F.col("norm").isNotNull() & (F.col("norm") > 0)
                   & (F.col("norm") < float("inf")) & ~F.isnan("norm"))
    # Negative zero is zero; so equal vectors are equal strings of bytes.
    rows = rows.withColumn("e", F.when(fit_for_use, F.transform("e", lambda x: x + F.lit(0.0))))
    classes = saved(rows.where("e is not null").groupBy("e").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    sizes = [r[0] for r in classes.select(F.size("e").alias("n")).distinct().collect()]
    counts = links = None
    for size in sizes:
        own = classes.where(F.size("e") == size)
        have = own.count()
        room = SAMPLE_BYTES // (8 * size)
        number = lists or max(16, min(LISTS, room // SAMPLE_PER_LIST, math.isqrt(have)))
        most = min(room, max(sample, SAMPLE_PER_LIST * number))
        # Few more than are taken, so that the sort that cuts them meets no more.
        share = min(1.0, 1.1 * most / have + 1e-6)
        some = (own.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
                .orderBy(F.xxhash64("id"), "id").limit(most).select("e").toArrow())
        points = _matrix(some.column("e").combine_chunks())
        points = points / np.linalg.norm(points, axis=1)[:, None]
        apart = APART * math.sqrt(max(2 - 2 * cosine, 0))
        found = _linked(own, fit(points, number, apart=apart), cosine, probes, size)
        found = saved(found, "vector-links")
        part = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
        pairs = found.where("other is not null").select(
            F.col("id").alias("a"), F.col("other").alias("b"))
        counts = part if counts is None else counts.union(part)
        links = pairs if links is None else links.union(pairs)
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"))
    roots = components(links, "vector-components")
    heads = (classes.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"),
                                                     "id", "left")
             .select("e", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "id").alias("component_id")))
    return rows.join(heads, "e", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))


def _linked(classes: DataFrame, index: Index, cosine: float, probes: int, size: int
            ) -> DataFrame:
    """Rows (id, other, n): with ``other`` a link of the spanning forests, without it a
    part of the number of vectors linked with ``id``."""
    spark = classes.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("e"))
            units = points / np.linalg.norm(points, axis=1)[:, None]
            near = _probes(shared.value, units, probes)
            codes, error = encode(shared.value, units, near[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copies"), batch.column("e"),
                 pa.array(list(units.astype(np.float32)), pa.list_(pa.float32())),
                 pa.array(list(near), pa.list_(pa.int32())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                ["id", "copies", "e", "unit", "near", "code", "error"])

    placed = saved(map_arrow(classes.select("id", "copies", "e"), assign,
                             "id bigint, copies bigint, e array<double>, unit array<float>, "
                             "near array<int>, code binary, error double"), "vector-lists")
    # A list is cut in tiles of codes and parts of queries; how many follows its size.
    tile = max(LEAST_TILE, TILE_BYTES // (8 * size))
    cuts = (placed.select(F.posexplode("near").alias("at", "list")).groupBy("list")
            .agg(F.count(F.lit(1)).alias("asking"),
                 F.sum((F.col("at") == 0).cast("int")).alias("held"))
            .where("held > 0")
            .select("list", F.ceil(F.col("held") / tile).cast("int").alias("tiles"),
                    F.ceil(F.col("asking") * 4 / tile).cast("int").alias("parts")))
    # At most one row per centroid.
    cuts = F.broadcast(saved(cuts, "vector-cuts"))
    stored = (placed.select("id", "code", "error", F.element_at("near", 1).alias("list"))
              .join(cuts, "list").select(
                  "list", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"),
                  F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id",
                  "code", "error", F.lit(None).cast("array<float>").alias("unit")))
    asking = (placed.select("id", "unit", F.explode("near").alias("list"))
              .join(cuts, "list").select(
                  "list", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
                  F.pmod(F.xxhash64(F.lit(7), "id"), F.col("parts")).cast("int").alias("part"),
                  "id", F.lit(None).cast("binary").alias("code"),
                  F.lit(None).cast("double").alias("error"), "unit"))
    reach = math.sqrt(max(2 - 2 * cosine, 0)) + ROUNDING

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        """The codes and the queries of a tile that come near one another."""
        index, at = shared.value, key[0].as_py()
        ids = rows.column("id").to_numpy()
        is_held = rows.column("code").is_valid().to_numpy()
        held, asks = np.flatnonzero(is_held), np.flatnonzero(~is_held)
        near_held, near_asks = np.zeros(len(held), bool), np.zeros(len(asks), bool)
        if len(held) and len(asks):
            chosen = rows.filter(pa.array(is_held))
            codes = np.frombuffer(b"".join(chosen.column("code").to_pylist()),
                                  dtype=np.uint8).reshape(len(held), -1)
            error = chosen.column("error").to_numpy()
            units = _matrix(rows.filter(pa.array(~is_held)).column("unit").combine_chunks()
                            ).astype(np.float64)
            for some in _slices(len(asks), len(held)):
                close = distances(index, units[some], at, codes) - error[None, :] <= reach
                close &= ids[asks[some]][:, None] != ids[held][None, :]
                near_asks[some] = close.any(1)
                near_held |= close.any(0)
        kept = np.concatenate([held[near_held], asks[near_asks]])
        part = np.full(len(kept), 1, dtype=np.int32)
        return pa.table({
            "list": pa.array(part * at), "tile": pa.array(part * key[1].as_py()),
            "part": pa.array(part * key[2].as_py()), "id": pa.array(ids[kept]),
            "held": pa.array(is_held[kept])})

    close = saved(stored.unionByName(asking).groupBy("list", "tile", "part").applyInArrow(
        meet, "list int, tile int, part int, id bigint, held boolean"), "vector-near")

    def compare(rows: pa.Table) -> pa.Table:
        """The links of a tile by exact cosine."""
        ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
        points = _matrix(rows.column("e").combine_chunks())
        lists = _matrix(rows.column("near").combine_chunks())
        norms = np.linalg.norm(points, axis=1)
        units = points / norms[:, None]
        is_held = rows.column("held").to_numpy().astype(bool)
        held, asks = np.flatnonzero(is_held), np.flatnonzero(~is_held)
        totals = np.zeros(len(ids), dtype=np.int64)
        nodes, tops = [], []
        for some in _slices(len(asks), len(held)):
            q, h = np.nonzero(units[asks[some]] @ units[held].T >= cosine - 1e-9)
            a, b = asks[some][q], held[h]
            other = ids[a] != ids[b]
            a, b = a[other], b[other]
            dots = np.zeros(len(a))
            for one in _slices(len(a), size):
                dots[one] = (np.einsum("ij,ij->i", points[a[one]], points[b[one]])
                             / (norms[a[one]] * norms[b[one]]))
            a, b = a[dots >= cosine], b[dots >= cosine]
            np.add.at(totals, a, copies[b])
            # The other end does not look into this one's list, so it never finds it.
            alone = np.ones(len(a), dtype=bool)
            for probe in lists.T:
                alone &= probe[b] != lists[a, 0]
            np.add.at(totals, b[alone], copies[a[alone]])
            node, top = _components(ids[a], ids[b])
            nodes.append(node)
            tops.append(top)
        if nodes:
            node, top = _components(np.concatenate(nodes), np.concatenate(tops))
        else:
            node = top = np.zeros(0, dtype=np.int64)
        counted = np.flatnonzero(totals)
        return pa.table({
            "id": pa.array(np.concatenate([node, ids[counted]]), pa.int64()),
            "other": pa.array([*top.tolist(), *[None] * len(counted)], pa.int64()),
            "n": pa.array(np.concatenate([np.zeros(len(node), np.int64), totals[counted]]))})

    return (close.join(placed.select("id", "copies", "e", "near"), "id")
            .groupBy("list", "tile", "part")
            .applyInArrow(compare, "id bigint, other bigint, n bigint"))
