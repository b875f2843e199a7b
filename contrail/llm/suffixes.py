"""Suffix-array dedup: repeated byte strings by difference-cover samples and suffix buckets."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, map_arrow, prefix_hashes, saved, ship, span_hashes

#: Length of the strings whose repeats are removed.
LENGTH = 100
#: Period of the difference cover.
PERIOD = 73
#: Bytes of text in a block, and suffixes in a bucket, about: what a task holds at once.
BLOCK_BYTES = 4 << 20
BUCKET_SUFFIXES = 1 << 20
LEAST_BUCKETS = 256
#: Suffix buckets are sent and sorted in so many rounds, so that the disk holds the
#: keys of one round only.
ROUNDS = 2
#: Bitmaps may be broadcast to the blocks up to so many bytes; else they are joined.
BROADCAST_BYTES = 64 << 20


def difference_cover(period: int = PERIOD) -> np.ndarray:
    """Residues such that any two positions meet in them after one common shift.

    The powers of 2 modulo 73 are a perfect difference set: each nonzero
    residue is the difference of exactly one pair of its nine members.
    """
    cover = np.unique([pow(2, k, period) for k in range(period)])
    if len({(a - b) % period for a in cover for b in cover}) != period:
        raise ValueError(f"powers of two are no difference cover of {period}")
    return cover


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps: it does so when
    the driver's references to them have been collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Block:
    """The texts of consecutive documents and their suffixes."""

    def __init__(self, blob: bytes, lengths: np.ndarray):
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.lengths = lengths
        self.sums = prefix_hashes(self.data)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions that a whole window follows, and the window's fingerprint.

        Strings of LENGTH bytes that are equal share, at one shift below PERIOD,
        a cover position of both and the window of LENGTH - PERIOD + 1 bytes there.
        """
        window = LENGTH - PERIOD + 1
        cover = difference_cover()
        periods = np.maximum(self.lengths - window, -1) // PERIOD + 1
        doc = np.repeat(np.arange(len(self.lengths)), periods)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods)
        at = ((number * PERIOD)[:, None] + cover[None, :]).ravel()
        doc = np.repeat(doc, len(cover))
        fits = at + window <= self.lengths[doc]
        at = at[fits] + self.starts[doc[fits]]
        return at, span_hashes(self.sums, at, at + window) >> np.uint64(16)

    def suffixes(self, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of strings of LENGTH bytes with a tied cover position within their
        first PERIOD bytes, and the fingerprint of the string."""
        marks = np.zeros(len(self.data) + 1, dtype=np.int32)
        doc = np.searchsorted(self.starts, tied, "right") - 1
        np.add.at(marks, np.maximum(tied - PERIOD + 1, self.starts[doc]), 1)
        np.add.at(marks, tied + 1, -1)
        held = np.cumsum(marks[:-1], dtype=np.int32) > 0
        # The last starts of each document have no whole string.
        short = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(short, np.maximum(self.starts[1:] - LENGTH + 1, self.starts[:-1]), 1)
        np.add.at(short, self.starts[1:], -1)
        at = np.flatnonzero(held & (np.cumsum(short[:-1], dtype=np.int32) == 0))
        return at, span_hashes(self.sums, at, at + LENGTH)


def blocks(documents: DataFrame) -> DataFrame:
    """(block, ids, lengths, blob): documents in order of doc_id, packed in blocks.

    Block numbers rise with doc_id.  A longer document is a block of its own.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, parts, size = [], [], 0
        compress = zstandard.ZstdCompressor(level=1).compress

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                 pa.array([compress(b"".join(parts))], pa.binary())],
                ["block", "ids", "lengths", "blob"])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, end, data, offsets in chunks(batch.column("text")):
                raw = data.tobytes()
                for i in range(first, end):
                    part = raw[offsets[i - first]:offsets[i - first + 1]]
                    if parts and size + len(part) > BLOCK_BYTES:
                        yield out()
                        number, ids, parts, size = number + 1, [], [], 0
                    ids.append(names[i])
                    parts.append(part)
                    size += len(part)
        if parts:
            yield out()

    ordered = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return map_arrow(ordered, pack, "block bigint, ids array<bigint>, lengths array<bigint>, "
                                    "blob binary")


def _packed(keys: np.ndarray) -> bytes:
    """Rising keys as differences, byte plane by byte plane: the high planes are empty."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), dtype=np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _by_bucket(block: int, keys: np.ndarray, bits: int, buckets: int, of: int = 1,
               turn: int = 0) -> pa.RecordBatch:
    """Rising distinct keys of ``bits`` bits, one row for each bucket they fall in;
    only the buckets of round ``turn`` among ``of``."""
    cuts = _cuts(keys, bits, buckets)
    full = np.flatnonzero(np.diff(cuts))
    full = full[full % of == turn]
    return pa.RecordBatch.from_arrays(
        [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), block), pa.int64()),
         pa.array([_packed(keys[cuts[b]:cuts[b + 1]]) for b in full], pa.binary())],
        ["bucket", "block", "keys"])


def _shift(bits: int, buckets: int) -> np.uint64:
    return np.uint64(bits - (buckets.bit_length() - 1))


def _bucket_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    return keys >> _shift(bits, buckets)


def _cuts(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    starts = np.arange(buckets, dtype=np.uint64) << _shift(bits, buckets)
    return np.append(np.searchsorted(keys, starts), len(keys))


def _answers(payloads: DataFrame, first_is_free: bool) -> DataFrame:
    """(block, answers): for each bucket a bitmap over the block's keys.

    One bucket is sorted at a time.  Set are the keys that another block holds as
    well; with ``first_is_free`` only where a block of smaller number does.  A
    block sends each key once, so a frequent string is one key a block.
    """
    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        keys = [_unpacked(p) for p in rows.column("keys").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        everything = np.concatenate(keys)
        order = np.argsort(everything, kind="stable")
        ranked = everything[order]
        same = ranked[1:] == ranked[:-1]
        tied = np.zeros(len(ranked), dtype=bool)
        tied[1:] = same
        if not first_is_free:
            tied[:-1] |= same
        flags = np.zeros(len(ranked), dtype=bool)
        flags[order] = tied
        ends = np.cumsum(sizes)
        out = [(b, k, np.packbits(flags[e - n:e]).tobytes())
               for b, k, n, e in zip(rows.column("block").to_pylist(),
                                     rows.column("bucket").to_pylist(), sizes, ends)
               if flags[e - n:e].any()]
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()),
                         "bucket": pa.array([o[1] for o in out], pa.int32()),
                         "bits": pa.array([o[2] for o in out], pa.binary())})

    ship(payloads.sparkSession)
    return (payloads.groupBy("bucket")
            .applyInArrow(merge, "block bigint, bucket int, bits binary")
            .groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")))


def _flags(keys: np.ndarray, answers, bits: int, buckets: int) -> np.ndarray:
    """Which of a block's keys the bitmaps in ``answers`` set."""
    flags = np.zeros(len(keys), dtype=bool)
    cuts = _cuts(keys, bits, buckets)
    for answer in answers or []:
        lo, hi = cuts[answer["bucket"]], cuts[answer["bucket"] + 1]
        flags[lo:hi] = np.unpackbits(np.frombuffer(answer["bits"], dtype=np.uint8),
                                     count=int(hi - lo)).astype(bool)
    return flags


def _tied_samples(block: Block, answers, buckets: int) -> np.ndarray:
    """Cover positions whose window stands elsewhere too."""
    at, prints = block.samples()
    keys, number, count = np.unique(prints, return_inverse=True, return_counts=True)
    return at[((count > 1) | _flags(keys, answers, 48, buckets))[number]]


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            yield row, Block(row.pop("blob"), np.array(row["lengths"], dtype=np.int64))


def _joined(packed: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with their bitmaps, broadcast while these are within a bound."""
    column = answers.columns[1]
    size = answers.agg(F.sum(F.aggregate(column, F.lit(0).cast("long"), lambda s, x: (
        s + F.octet_length(x["bits"]) + 32)))).first()[0] or 0
    return packed.join(F.broadcast(answers) if size <= BROADCAST_BYTES else answers,
                       "block", "left")


def repeated_bytes(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``documents``.

    Marks each byte of the UTF-8 text that is covered by a string of LENGTH bytes
    which also starts earlier, in a document of smaller doc_id or sooner in the
    same one.  ``spans`` are the maximal marked runs (start, end), ``kept`` the
    other bytes.  NULL text is empty; shorter texts keep all; rows that repeat a
    doc_id are ordered by their text, a NULL doc_id comes first.

    Documents are packed in blocks in order of doc_id.  Cover positions are
    compared first: a suffix can tie with another over LENGTH bytes only where
    the rank of a cover sample near its start is not unique.  The suffixes left
    are dealt into buckets and sorted one bucket at a time, tied when the
    fingerprints of their first LENGTH bytes (64 bits) agree.  Only sorted keys
    travel, a part of the buckets at a time, and bitmaps come back.
    """
    spark = documents.sparkSession
    packed = saved(blocks(documents), "suffix-blocks")
    release(spark)
    # Fewer than one sample in eight bytes.
    total = packed.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"),
                                         lambda s, x: s + x))).first()[0] or 0
    buckets = LEAST_BUCKETS
    while buckets * BUCKET_SUFFIXES < total // 4:
        buckets *= 2

    def send_samples(batches):
        for row, block in _opened(batches):
            yield _by_bucket(row["block"], np.unique(block.samples()[1]), 48, buckets)

    def send_suffixes(turn):
        def send(batches):
            for row, block in _opened(batches):
                tied = _tied_samples(block, row["answers"], buckets)
                prints = block.suffixes(tied)[1]
                # Sorting is most of the work: only this round's keys are sorted.
                mine = prints[_bucket_of(prints, 64, buckets) % np.uint64(ROUNDS) == turn]
                yield _by_bucket(row["block"], np.unique(mine), 64, buckets, ROUNDS, turn)
        return send

    def cut(batches):
        for row, block in _opened(batches):
            at, prints = block.suffixes(_tied_samples(block, row["answers"], buckets))
            keys, first, number = np.unique(prints, return_index=True, return_inverse=True)
            later = first[number] != np.arange(len(at))
            gone = at[later | _flags(keys, row["later"], 64, buckets)[number]]
            marks = np.zeros(len(block.data) + 1, dtype=np.int32)
            np.add.at(marks, gone, 1)
            np.add.at(marks, gone + LENGTH, -1)
            marked = np.cumsum(marks[:-1], dtype=np.int32) > 0
            before = np.concatenate([[False], marked[:-1]]) if len(marked) else marked
            after = np.concatenate([marked[1:], [False]]) if len(marked) else marked
            inner = block.starts[1:-1]
            before[inner[inner < len(marked)]] = False
            after[inner[inner > 0] - 1] = False
            begins, ends = np.flatnonzero(marked & ~before), np.flatnonzero(marked & ~after) + 1
            cuts = np.searchsorted(begins, block.starts)
            base = np.repeat(block.starts[:-1], np.diff(cuts))
            spans = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(begins - base, pa.int64()), pa.array(ends - base, pa.int64())],
                    ["start", "end"]))
            left = block.data[~marked].tobytes()
            kept_at = np.concatenate([[0], np.cumsum(~marked)])[block.starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(block.lengths, pa.int64()), spans,
                 pa.array([left[a:b] for a, b in zip(kept_at, kept_at[1:])], pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    sent = "bucket int, block bigint, keys binary"
    samples = saved(_answers(map_arrow(packed.select("block", "lengths", "blob"), send_samples,
                                       sent), first_is_free=False), "suffix-samples")
    release(spark)
    marked = _joined(packed, samples)
    later = None
    for turn in range(ROUNDS):
        part = saved(_answers(map_arrow(marked.select("block", "lengths", "blob", "answers"),
                                        send_suffixes(turn), sent), first_is_free=True),
                     f"suffix-later-{turn}")
        release(spark)
        later = part if later is None else later.union(part)
    later = later.groupBy("block").agg(F.flatten(F.collect_list("answers")).alias("later"))
    return map_arrow(_joined(marked, saved(later, "suffix-later")).select(
        "ids", "lengths", "blob", "answers", "later"), cut,
        "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, "
        "kept binary")
