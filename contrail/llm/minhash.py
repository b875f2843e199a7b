"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NON_SPACE, Words, chunks, components, forest, map_arrow, mixed, pick,
                     saved, ship, told_apart)

HASHES = 100
#: Chance that a link at the threshold shares no band, at most.
BAND_MISS = 2e-5
#: A pair is pruned when its similarity reaches the threshold with less than this chance.
POSTERIOR_MISS = 1e-6
#: Hashes compared at a time.
BATCH = 20
#: Rounds of comparing with bucket leaders before the pairs left are compared directly.
LEADER_ROUNDS = 2
#: Members of a bucket that one task compares with as many others, and the number of
#: groups that buckets of few pairs are put together in.
TILE = 1_024
SHARED_GROUPS = 1_024


def band_rows(percent: int, hashes: int = HASHES, miss: float = BAND_MISS) -> int:
    """The most hashes a band may have for links at the threshold to be found."""
    s = percent / 100
    return max(r for r in range(1, hashes + 1)
               if (1 - s ** r) ** (hashes // r) <= miss or r == 1)


def least_matches(percent: int, hashes: int = HASHES, batch: int = BATCH,
                  miss: float = POSTERIOR_MISS) -> list[tuple[int, int]]:
    """After each batch, (hashes compared, matches below which a pair is pruned).

    The prior is uniform, so after m matches of n the similarity is distributed
    as Beta(m + 1, n - m + 1); a pair is pruned when the mass from the threshold
    up is below ``miss``.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    bounds = []
    for n in range(batch, hashes + 1, batch):
        least = 0
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(log - log.max())
            if density[grid >= percent / 100].sum() / density.sum() >= miss:
                least = m
                break
        bounds.append((n, least))
    return bounds


def _sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document in a chunk, and where each set begins."""
    values, starts = words.shingles(size, whole=True)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[new], doc[new]
    return values, np.searchsorted(doc, np.arange(len(starts)))


def _segment(reduce, values: np.ndarray, starts: np.ndarray, empty) -> np.ndarray:
    """``reduce`` over each non-empty segment; ``empty`` for the others."""
    out = np.full(len(starts) - 1, empty, dtype=values.dtype)
    full = np.diff(starts) > 0
    if full.any():
        out[full] = reduce.reduceat(values, starts[:-1][full])
    return out


def signatures(documents: DataFrame, shingle: int, hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, signature): set size, a 128-bit digest of the set,
    and its min-hashes as packed 32-bit numbers."""
    multipliers = np.random.default_rng(11).integers(
        1, 1 << 62, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, end, data, offsets in chunks(batch.column("text")):
                values, starts = _sets(Words(data, offsets, NON_SPACE), shingle)
                signature = np.empty((end - first, hashes), dtype=np.uint32)
                for k, multiplier in enumerate(multipliers):
                    high = ((values * multiplier) >> np.uint64(32)).astype(np.uint32)
                    signature[:, k] = _segment(np.minimum, high, starts, 0)
                d1 = _segment(np.add, mixed(values + np.uint64(17)), starts, 0)
                d2 = _segment(np.add, mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts, 0)
                packed = signature.tobytes()
                width = 4 * hashes
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(np.diff(starts), pa.int64()),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array([packed[i:i + width] for i in range(0, len(packed), width)],
                              pa.binary())],
                    ["doc_id", "n_shingles", "d1", "d2", "signature"])

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                     apply, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, "
                            "signature binary")


def shingle_sets(documents: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles): the distinct shingle hashes of each document."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, end, data, offsets in chunks(batch.column("text")):
                values, starts = _sets(Words(data, offsets, NON_SPACE), shingle)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.ListArray.from_arrays(
                        pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))],
                    ["doc_id", "shingles"])

    return map_arrow(documents.select("doc_id", "text"), apply,
                     "doc_id bigint, shingles array<bigint>")


def _bands(reps: DataFrame, rows: int, hashes: int) -> DataFrame:
    """(band, place, id): one row per band of each signature."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            if not len(ids):
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()),
                                   dtype=np.uint32).reshape(len(ids), hashes).astype(np.uint64)
            for k, at in enumerate(range(0, hashes - rows + 1, rows)):
                key = np.full(len(ids), k + 1, dtype=np.uint64)
                for j in range(at, at + rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(ids), k, np.int32)),
                     pa.array(ids)], ["band", "place", "id"])

    return map_arrow(reps.select("id", "signature"), apply, "band bigint, place int, id bigint")


def _pruned(pairs: DataFrame, reps: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """The pairs that no batch of their signatures rules out."""
    a = reps.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    b = reps.select(F.col("id").alias("b"), F.col("signature").alias("sb"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32)
                           .reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            done = 0
            for n, least in bounds:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive = alive[matches[alive] >= least]
                done = n
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(kept), batch.column("b").take(kept)], ["a", "b"])

    return map_arrow(pairs.join(a, "a").join(b, "b"), apply, "a bigint, b bigint")


def _survivors(left: np.ndarray, right: np.ndarray, may: np.ndarray,
               bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of signatures that no batch rules out, among those ``may`` allows."""
    n, least = bounds[0]
    matches = np.zeros(may.shape, dtype=np.uint8)
    for k in range(n):
        matches += left[:, k][:, None] == right[:, k][None, :]
    a, b = np.nonzero((matches >= least) & may)
    matches, done = matches[a, b].astype(np.int64), n
    for n, least in bounds[1:]:
        matches += (left[a, done:n] == right[b, done:n]).sum(axis=1)
        alive = matches >= least
        a, b, matches, done = a[alive], b[alive], matches[alive], n
    return a, b


def _across(apart: DataFrame, members: DataFrame, reps: DataFrame,
            bounds: list[tuple[int, int]], rows_per_band: int) -> DataFrame:
    """Which members of one bucket but different components their signatures let link.

    ``apart`` are the members outside the component of the bucket's leader; each
    is compared with all members, in tiles of at most about TILE by TILE.  Small
    buckets share a group.  Gives (group, i, j, id, others, asked): the survivors of
    each member in a tile, as one list, so a crowded bucket is few rows; a pair is in
    the list of the first band that both share, and only there.  One row of a tile
    has in ``asked`` every member that stands in its lists, once.
    """
    left = apart.groupBy("band").agg(F.count(F.lit(1)).alias("n_left"),
                                     F.min("lead_comp").alias("lead_comp"))
    right = members.join(left, "band", "left_semi").groupBy("band").agg(
        F.count(F.lit(1)).alias("n_right"))
    sizes = left.join(right, "band").select(
        "band", "lead_comp", F.ceil(F.col("n_left") / TILE).cast("int").alias("rows"),
        F.ceil(F.col("n_right") / TILE).cast("int").alias("columns"),
        F.when(F.col("n_left") * F.col("n_right") <= TILE, F.pmod("band", F.lit(SHARED_GROUPS)))
        .otherwise(F.col("band")).alias("group"))

    def dealt(frame: DataFrame, own: str, other: str, is_left: bool) -> DataFrame:
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        own_tile = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        return frame.select("band", "place", "id", "comp").join(sizes, "band").select(
            "group", "band", "place", "id", "comp", F.lit(is_left).alias("is_left"),
            (F.col("comp") != F.col("lead_comp")).alias("minor"),
            own_tile.alias("own"), spread.alias("other"))

    rows = (dealt(apart, "rows", "columns", True)
            .unionByName(dealt(members, "columns", "rows", False))
            .withColumn("i", F.when(F.col("is_left"), F.col("own")).otherwise(F.col("other")))
            .withColumn("j", F.when(F.col("is_left"), F.col("other")).otherwise(F.col("own")))
            .drop("own", "other").join(reps, "id"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("band")
        band, place, ids, comp = (table.column(c).to_numpy()
                                  for c in ("band", "place", "id", "comp"))
        is_left, minor = (table.column(c).to_numpy(zero_copy_only=False).astype(bool)
                          for c in ("is_left", "minor"))
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()),
                                  dtype=np.uint32).reshape(len(ids), -1)
        bands = signature.shape[1] // rows_per_band
        banded = signature[:, :bands * rows_per_band].reshape(len(ids), bands, rows_per_band)
        edges = np.append(np.flatnonzero(np.diff(band, prepend=band[:1] - 1)), len(band))
        found: dict[int, list[np.ndarray]] = {}
        for first, end in zip(edges, edges[1:]):
            rows = first + np.flatnonzero(is_left[first:end])
            columns = first + np.flatnonzero(~is_left[first:end])
            for at in range(0, len(rows), 256):
                some = rows[at:at + 256]
                may = ((comp[some][:, None] != comp[columns][None, :])
                       & (~minor[columns][None, :] | (ids[some][:, None] < ids[columns][None, :])))
                a, b = _survivors(signature[some], signature[columns], may, bounds)
                for lo in range(0, len(a), 1 << 16):
                    x, y = some[a[lo:lo + (1 << 16)]], columns[b[lo:lo + (1 << 16)]]
                    shared = (banded[x] == banded[y]).all(axis=2)
                    own = np.argmax(shared, axis=1) == place[first]
                    x, y = x[own], y[own]
                    cuts = np.flatnonzero(np.diff(x, prepend=-1))
                    for part in np.split(np.arange(len(x)), cuts[1:]) if len(x) else ():
                        found.setdefault(int(ids[x[part[0]]]), []).append(ids[y[part]])
        lists = [np.unique(np.concatenate(some)) for some in found.values()]
        return pa.table({
            **{name: pa.array([value.as_py()] * len(lists), kind) for name, value, kind in
               zip(("group", "i", "j"), key, (pa.int64(), pa.int32(), pa.int32()))},
            "id": pa.array(list(found), pa.int64()),
            "others": pa.array(lists, pa.list_(pa.int64())),
            "asked": pa.array([np.unique(np.concatenate([list(found), *lists])) if k == 0 else None
                               for k in range(len(lists))], pa.list_(pa.int64()))})

    ship(apart.sparkSession)
    return rows.groupBy("group", "i", "j").applyInArrow(
        compare, "group bigint, i int, j int, id bigint, others array<bigint>, "
                 "asked array<bigint>")


def _confirmed_across(survivors: DataFrame, documents: DataFrame, shingle: int, percent: int,
                      label: str) -> DataFrame:
    """Links (a, b) among the lists that ``_across`` gives, by full sets of shingles.

    A document's set goes to each tile that asks for it once, not once a pair.
    Tiles return a spanning forest of the links found.
    """
    asked = survivors.where("asked is not null").select(
        "group", "i", "j", F.explode("asked").alias("doc_id"))
    sets = saved(shingle_sets(pick(documents, asked.select("doc_id")), shingle),
                 f"{label}-sets")
    nothing = F.lit(None)
    rows = (asked.join(sets, "doc_id").select(
        "group", "i", "j", F.col("doc_id").alias("id"), "shingles",
        nothing.cast("array<bigint>").alias("others"))
        .unionByName(survivors.drop("asked").withColumn(
            "shingles", nothing.cast("array<bigint>"))))

    def confirm(table: pa.Table) -> pa.Table:
        held: dict[int, np.ndarray] = {}
        lists: list[tuple[int, np.ndarray]] = []
        for id_, shingles, others in zip(table.column("id").to_pylist(),
                                         table.column("shingles"), table.column("others")):
            if shingles.is_valid:
                held[id_] = shingles.values.to_numpy()
            if others.is_valid:
                lists.append((id_, others.values.to_numpy()))
        found = []
        for id_, others in lists:
            own = np.sort(held[id_])
            for first in range(0, len(others), 256):
                some = others[first:first + 256]
                sizes = np.array([len(held[o]) for o in some.tolist()])
                every = np.concatenate([held[o] for o in some.tolist()])
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                common = np.add.reduceat((own[at] == every).astype(np.int64),
                                         np.cumsum(sizes) - sizes)
                linked = 100 * common >= percent * (len(own) + sizes - common)
                found += [(id_, int(o)) for o in some[linked]]
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        kept = forest(ends[:, 0], ends[:, 1])
        return pa.table({"a": pa.array([max(k) for k in kept], pa.int64()),
                         "b": pa.array([min(k) for k in kept], pa.int64())})

    ship(survivors.sparkSession)
    return rows.groupBy("group", "i", "j").applyInArrow(confirm, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, documents: DataFrame, shingle: int, percent: int,
               label: str) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = saved(shingle_sets(pick(documents, wanted), shingle),
                 f"{label}-sets")
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(a, "a").join(b, "b")
            .where(100 * common >= percent * (F.size("x") + F.size("y") - common))
            .select("a", "b"))


def _apart_from_leader(members: DataFrame) -> DataFrame:
    """Of each bucket with several components, the members that are not of the
    component of its smallest member, and that member as ``lead``."""
    leaders = members.groupBy("band").agg(
        F.min(F.struct("comp", "id")).alias("lead"), F.max("comp").alias("top")
    ).where("lead.comp < top").select(
        "band", F.col("lead.comp").alias("lead_comp"), F.col("lead.id").alias("lead"))
    return members.join(leaders, "band").where("comp <> lead_comp")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80,
                    hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents``.

    Documents are linked when their sets of ``shingle``-word runs (ASCII case
    ignored) have a Jaccard similarity of ``percent`` / 100 or more; component_id
    is the smallest doc_id reachable.  A document of fewer words is one shingle;
    one without words, or with NULL text, links with nothing, and so does a row
    without doc_id (its component is NULL).  Rows that repeat a doc_id stand each
    for its own text.  Other columns are not read.

    Equal sets form a class, whose smallest doc_id stands for it.  Every member
    of a bucket of equal bands is first compared with the bucket's leader, that
    of the bucket it shares most with; after that members of different
    components are compared, those outside the leader's component with all, so a
    large group of near copies does not emit all its pairs and yet no link
    between components is lost.
    """
    told, repeats = told_apart(documents.select("doc_id", "text"))
    found = _grouped(told.select(F.col("_row").alias("doc_id"), "text"), shingle, percent, hashes)
    if not repeats:
        return found
    named = saved(found.withColumnRenamed("doc_id", "_row").join(
        told.where("_row is not null").select("_row", F.col("doc_id").cast("long")
                                              .alias("doc_id")), "_row", "left"), "minhash-named")
    least = named.where("component_id is not null").groupBy("component_id").agg(
        F.min("doc_id").alias("least"))
    return named.join(least, "component_id", "left").select(
        "doc_id", "n_shingles", F.col("least").alias("component_id"))


def _grouped(documents: DataFrame, shingle: int, percent: int, hashes: int = HASHES) -> DataFrame:
    """What ``near_duplicates`` gives, of documents whose doc_ids do not repeat."""
    rows = band_rows(percent, hashes)
    bounds = least_matches(percent, hashes)
    table = saved(signatures(documents, shingle, hashes), "minhash-signatures")
    filled = table.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = saved(filled.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("id"), F.first("signature").alias("signature")), "minhash-classes")
    bands = _bands(classes, rows, hashes)
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    members = saved(bands.join(shared, "band"), "minhash-members")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    reps = classes.select("id", "signature")

    labelled = members.withColumn("comp", F.col("id"))
    links = saved(members.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b")),
                  "minhash-links")
    for turn in range(LEADER_ROUNDS):
        apart = _apart_from_leader(labelled)
        if turn:
            # The rest of a bucket among itself: its leader is the smallest left.
            apart = _apart_from_leader(apart.select("band", "place", "id", "comp"))
        # Each with the leader it shares most buckets with, so one pair at most.
        nearest = F.max(F.struct("n", (-F.col("lead")).alias("minus"))).alias("best")
        pairs = (apart.groupBy("id", "lead").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("id").agg(nearest)
                 .select((-F.col("best.minus")).alias("a"), F.col("id").alias("b")))
        pairs = saved(_pruned(pairs, reps, bounds), f"minhash-pairs-{turn}")
        links = saved(links.union(_confirmed(pairs, texts, shingle, percent, f"minhash-{turn}")),
                      f"minhash-links-{turn}")
        roots = saved(components(links, f"minhash-components-{turn}"), f"minhash-roots-{turn}")
        labelled = members.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
            "band", "place", "id", F.coalesce("root", "id").alias("comp"))
    survivors = saved(_across(_apart_from_leader(labelled), labelled, reps, bounds, rows),
                      "minhash-survivors")
    links = links.union(_confirmed_across(survivors, texts, shingle, percent, "minhash-last"))
    roots = saved(components(links, "minhash-components"), "minhash-roots")
    heads = (classes.select("d1", "d2", "id")
             .join(roots.withColumnRenamed("node", "id"), "id", "left")
             .select("d1", "d2", F.coalesce("root", "id").alias("component_id")))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return (table.select("doc_id", "n_shingles", "d1", "d2")
            .join(heads, ["d1", "d2"], "left")
            .select("doc_id", "n_shingles", F.when(alone, F.col("doc_id"))
                    .otherwise(F.coalesce("component_id", "doc_id")).alias("component_id")))


def deduplicated(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each near-duplicate group: that of the smallest doc_id.

    Rows that repeat a doc_id stand each for its own text; of those in one group the
    one whose text is least stays.  Rows that link with nothing stay.
    """
    row = "_row"
    while row in documents.columns:
        row += "_"
    told, repeats = told_apart(documents, row)
    found = saved(_grouped(told.select(F.col(row).alias("doc_id"), "text"), shingle, percent),
                  "minhash-found")
    if not repeats:
        gone = found.where("doc_id <> component_id").select("doc_id")
        return pick(documents, saved(gone, "minhash-gone"), keep=False)
    own = found.where("doc_id is not null").select(F.col("doc_id").alias(row), "component_id")
    own = own.join(told.select(row, "doc_id"), row)
    kept = own.groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias("kept"))
    gone = saved(own.join(kept, "component_id").where(F.col(row) != F.col(f"kept.{row}")).select(row),
                 "minhash-gone")
    return told.join(gone, row, "left_anti").select(*documents.columns)
