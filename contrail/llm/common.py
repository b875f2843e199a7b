"""Shared helpers: reading tables, scratch tables, words and shingles in numpy, components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from ..sources.tables import delete_folder

# Text handled by one numpy step: temporary arrays take about 60 times this.
CHUNK_BYTES = 1 << 18

#: Bytes of a batch that goes to a Python worker, about (64 MB unless set).
BATCH_BYTES = 8 << 20

# Odd multiplier of the polynomial hashes, arithmetic modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back.

    Cuts the lineage in a way that survives the loss of any executor.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the scratch tables behind ``saved`` frames (or unions of such) that nothing
    reads any more, so that the disk holds only those still to be read."""
    for frame in frames:
        for folder in {unquote(file).rsplit("/", 1)[0] for file in frame.inputFiles()}:
            delete_folder(frame.sparkSession, folder)


#: Identifiers that may be broadcast: about 16 MB.
BROADCAST_IDS = 1_000_000


#: Links that one task may join into components: about 8 MB.
LOCAL_LINKS = 500_000


def pick(frame: DataFrame, ids: DataFrame, keep: bool = True) -> DataFrame:
    """The rows of ``frame`` whose doc_id is among ``ids`` (or is not).

    Up to a bound the identifiers are broadcast, so the texts are not shuffled;
    beyond it the two are joined by shuffles.
    """
    ids = saved(ids.select("doc_id").distinct(), "ids")
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return frame.join(ids, "doc_id", "left_semi" if keep else "left_anti")


def told_apart(documents: DataFrame, name: str = "_row") -> tuple[DataFrame, bool]:
    """``documents`` with a number ``name``, and whether any doc_id repeats.

    It is the doc_id; rows that share one get numbers above all doc_ids, in order of
    doc_id and text.
    """
    row = F.col("doc_id").cast("long")
    repeated = saved(documents.where("doc_id is not null").groupBy("doc_id")
                     .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"),
                     "repeated-ids")
    if repeated.isEmpty():
        return documents.withColumn(name, row), False
    top = documents.agg(F.max(row)).first()[0]
    own = saved(pick(documents, repeated)
                .repartitionByRange("doc_id", "text", F.monotonically_increasing_id())
                .sortWithinPartitions("doc_id", "text", F.xxhash64(*documents.columns))
                .withColumn(name, F.lit(top + 1).cast("long") + F.monotonically_increasing_id()),
                "told-apart")
    return pick(documents, repeated, keep=False).withColumn(name, row).unionByName(own), True


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    The archive is made on the driver and served by Spark, like ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_contrail_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="contrail-")) / "contrail_package.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._contrail_shipped = True


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and the C
    library would keep what the task's arrays took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(frame: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, which give back their
    memory after each task.  The session's batches are held to ``BATCH_BYTES``: each is
    in memory several times over, in the JVM and in the worker."""
    ship(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return frame.mapInArrow(run, schema)


def word_class(pattern: bytes) -> np.ndarray:
    """Per byte value whether it belongs to a word: a byte class such as ``[a-z]``."""
    matcher = re.compile(pattern, re.DOTALL)
    return np.array([bool(matcher.fullmatch(bytes([b]))) for b in range(256)])


NON_SPACE = word_class(rb"[^\x20\x09-\x0D]")
ALPHANUMERIC = word_class(rb"[0-9A-Za-z\x80-\xff]")
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grown(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i below ``size``, modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < size:
        room = max(size, CHUNK_BYTES + 1)
        _powers, _inverses = _grown(_BASE, room), _grown(_INVERSE, room)
    return _powers[:size], _inverses[:size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, wherever it stands."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (or one row): first row, end row,
    the bytes, and the offsets of the rows in them.  NULL counts as empty."""
    if len(texts) == 0:
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        begin = offsets[first]
        yield first, end, data[begin:offsets[end]], offsets[first:end + 1] - begin
        first = end


class Words:
    """The words of a chunk: byte spans, hashes, and where each document's begin.

    ``doc_starts[i]`` is the index of the first word of document i; it has one
    entry more than there are documents.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray,
                 members: np.ndarray = NON_SPACE, lower: bool = True, hashed: bool = True):
        inside = members[data]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        bounds = offsets[1:-1]
        before[bounds[bounds < len(data)]] = False
        after[bounds[bounds > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        if hashed:
            self.hashes = span_hashes(prefix_hashes(LOWER[data] if lower else data),
                                      self.starts, self.ends)
        self.doc_starts = np.searchsorted(self.starts, offsets)

    def shingles(self, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of ``size`` words within a document, in order, and where
        each document's begin.  ``whole`` makes of a shorter document one shingle."""
        counts = np.diff(self.doc_starts)
        h = self.hashes
        if len(h) < size:
            rows = np.zeros(0, dtype=np.uint64)
        else:
            rows = np.zeros(len(h) - size + 1, dtype=np.uint64)
            for k in range(size):
                rows = rows * np.uint64(_BASE) + h[k:len(h) - size + 1 + k]
        keep = np.zeros(len(rows), dtype=bool)
        full = np.maximum(counts - size + 1, 0)
        # Positions from which size words of the same document follow.
        marks = np.zeros(len(rows) + 1, dtype=np.int64)
        at = self.doc_starts[:-1][full > 0]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + full[full > 0], -1)
        keep = np.cumsum(marks[:-1]) > 0
        values = mixed(rows[keep])
        starts = np.concatenate([[0], np.cumsum(full)])
        if not whole or not ((counts > 0) & (counts < size)).any():
            return values, starts
        per_doc = np.where(counts > 0, np.maximum(full, 1), 0)
        out = np.empty(int(per_doc.sum()), dtype=np.uint64)
        new_starts = np.concatenate([[0], np.cumsum(per_doc)])
        short = (counts > 0) & (counts < size)
        is_short = np.zeros(len(out), dtype=bool)
        is_short[new_starts[:-1][short]] = True
        out[~is_short] = values
        short_values = []
        for doc in np.flatnonzero(short):
            value = 0
            for word in h[self.doc_starts[doc]:self.doc_starts[doc + 1]]:
                value = (value * _BASE + int(word)) % (1 << 64)
            # Another length, another hash: it never equals a full shingle by design.
            short_values.append((value + int(counts[doc])) % (1 << 64))
        out[is_short] = mixed(np.array(short_values, dtype=np.uint64))
        return out, new_starts


def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the same nodes as the given ones: at most one less than nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the links between ``a`` and ``b``; the root is the smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    # Places rise with the nodes, so the smallest place is the smallest node.
    parent = list(range(len(nodes)))
    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x < y:
            parent[y] = x
        else:
            parent[x] = y
    root = np.array(parent, dtype=np.int64)
    while True:
        further = root[root]
        if (further == root).all():
            return nodes, nodes[root]
        root = further


def components(links: DataFrame, label: str, local_links: int = LOCAL_LINKS,
               rounds: int = 60) -> DataFrame:
    """Connected components of the links ``a, b`` (longs): (node, root), root smallest.

    Nodes without a link are not in the result.  Large-star and small-star steps
    in turn tie every node to the smallest of its neighbourhood, which shrinks the
    links until they settle.  Each step combines map-side before its shuffle; a
    hub's rows are only joined with its own minimum, which adaptive execution may
    split.  Once no more than ``local_links`` are left (16 bytes each), one task
    finishes with union and find.
    """
    links = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a > b").distinct(), label)
    left, seen = links.count(), None
    for _ in range(rounds):
        if left <= local_links:
            def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                ends = [(batch.column("a").to_numpy(), batch.column("b").to_numpy())
                        for batch in batches]
                if ends:
                    node, root = union_find(*(np.concatenate(e) for e in zip(*ends)))
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)],
                                                     ["node", "root"])

            return map_arrow(links.coalesce(1), finish, "node bigint, root bigint")
        both = links.union(links.select(F.col("b"), F.col("a"))).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        links = saved(large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a > b").distinct(), label)
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = links.agg(F.count(F.lit(1)), digest).first()
        if now == seen:
            roots = links.groupBy("a").agg(F.min("b").alias("root"))
            return roots.toDF("node", "root").union(links.select("b", "b").distinct())
        left, seen = now[0], now
    raise RuntimeError("components did not settle")
