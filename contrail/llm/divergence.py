"""Source divergence audit: run-length columns of term counts, compared pair by pair.

Every language keeps the terms that enough of its documents hold.  That vocabulary
is dealt into blocks of bounded size; in a block the terms are reordered so that
equal counts stand together, and the column of each source is run-length encoded.
Two columns are compared on the intersection of their run boundaries: one
difference a run, times the length of the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Words, chunks, map_arrow, saved, ship, word_class

#: A term: letters, and everything beyond ASCII.
LETTERS = word_class(rb"[A-Za-z\x80-\xff]")
#: Documents of a language that must hold a term.
MIN_DOCUMENTS = 30
#: Terms listed for each source.
TOP_TERMS = 50
#: Probabilities are whole multiples of 1 / SCALE; SMOOTHING is added to each count.
SCALE, SMOOTHING = 1_000_000_000, 5
#: Size of a block of the vocabulary, in terms and in counts, and of a tile of sources.
BLOCK_TERMS, BLOCK_COUNTS, TILE = 4_096, 500_000, 256
#: Sources whose counts order the terms of a block, the largest first.
ORDERING = 12


def probability(count, total, kept):
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)) on numpy arrays or columns of longs.

    The quotient is taken three decimal digits at a time, so that nothing overflows
    below 9e15 occurrences.
    """
    floor = ((lambda a, b: a // b) if isinstance(count, np.ndarray) else
             (lambda a, b: F.call_function("div", a, b)))
    below = total + SMOOTHING * kept
    whole = floor(count + SMOOTHING, below)
    rest = (count + SMOOTHING) % below
    for _ in range(3):
        whole = whole * 1000 + floor(rest * 1000, below)
        rest = (rest * 1000) % below
    return whole + 1


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in a chunk; a NULL term names the group."""
    for batch in batches:
        lang, source = (batch.column(k).cast(pa.string()).fill_null("") for k in (1, 2))
        pair = pa.StructArray.from_arrays([lang.dictionary_encode().indices,
                                           source.dictionary_encode().indices], ["a", "b"])
        a, b = (pair.field(k).to_numpy().astype(np.int64) for k in (0, 1))
        _, first_row, group = np.unique((a << 32) | b, return_index=True, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(first_row)), source.take(pa.array(first_row)),
             pa.nulls(len(first_row), pa.string()), pa.array(np.zeros(len(first_row), np.int64)),
             pa.array(np.zeros(len(first_row), np.int64))],
            ["lang", "source", "term", "n", "documents"])
        for first, end, data, offsets in chunks(batch.column(0), 8 << 20):
            words = Words(data, offsets, LETTERS, lower=False, hashed=False)
            if not len(words.starts):
                continue
            inside = LETTERS[data]
            lengths = words.ends - words.starts
            terms = pa.Array.from_buffers(
                pa.large_string(), len(lengths),
                [None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)])),
                 pa.py_buffer(LOWER[data[inside]])]).dictionary_encode()
            codes = terms.indices.to_numpy().astype(np.int64)
            size = len(terms.dictionary)
            row = np.repeat(np.arange(first, end), np.diff(words.doc_starts))
            of_group = group[row] * size + codes
            # A document's terms once each, then the documents of each group and term.
            once = np.unique(row.astype(np.int64) * size + codes)
            keys, n = np.unique(of_group, return_counts=True)
            held = group[once // size] * size + once % size
            _, documents = np.unique(held, return_counts=True)
            rows = pa.array(first_row[keys // size])
            yield pa.RecordBatch.from_arrays(
                [lang.take(rows), source.take(rows),
                 terms.dictionary.take(pa.array(keys % size)).cast(pa.string()),
                 pa.array(n.astype(np.int64)), pa.array(documents.astype(np.int64))],
                ["lang", "source", "term", "n", "documents"])


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents); each group has a row with a NULL term too."""
    found = map_arrow(documents.select("text", "lang", "source"), _count_terms,
                      "lang string, source string, term string, n bigint, documents bigint")
    return found.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def run_lengths(position: np.ndarray, count: np.ndarray, size: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """A column of ``size`` counts, zero but at the given rising positions, as runs:
    the first position of each run, and the count that it repeats."""
    starts = np.concatenate([position, position + 1, [0]])
    values = np.concatenate([count, np.zeros(len(position) + 1, count.dtype)])
    # At one position a count goes before the zero that follows the count before it.
    order = np.lexsort((values == 0, starts))
    starts, values = starts[order], values[order]
    first = np.concatenate([[True], starts[1:] != starts[:-1]])
    starts, values = starts[first], values[first]
    fresh = np.concatenate([[True], values[1:] != values[:-1]]) & (starts < size)
    return starts[fresh], values[fresh]


def clustered(source: np.ndarray, term: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """New position of each of ``size`` terms, such that equal counts stand together.

    Terms are ordered by their counts in the ``ORDERING`` largest sources.
    """
    sizes = np.bincount(source)
    largest = np.argsort(-sizes, kind="stable")[:ORDERING]
    table = np.zeros((ORDERING, size), dtype=np.int64)
    for row, which in enumerate(largest):
        at = source == which
        table[row, term[at]] = count[at]
    position = np.empty(size, dtype=np.int64)
    position[np.lexsort(table[::-1])] = np.arange(size)
    return position


def _encode(counts: pa.Table) -> pa.Table:
    """The run-length columns of one block: a row for each source of the language."""
    head = counts.filter(pc.is_null(counts["term"]))
    cells = counts.filter(pc.is_valid(counts["term"]))
    names = head["source"].combine_chunks().cast(pa.large_string())
    source = pc.index_in(cells["source"].combine_chunks().cast(pa.large_string()),
                         names).to_numpy(zero_copy_only=False).astype(np.int64)
    terms = cells["term"].combine_chunks().cast(pa.large_string()).dictionary_encode()
    # Numbered in the order of the terms, whatever order the rows came in.
    by_name = pc.rank(terms.dictionary, sort_keys="ascending").to_numpy() - 1
    term = by_name.astype(np.int64)[terms.indices.to_numpy()]
    count, size = cells["n"].to_numpy(), len(terms.dictionary)
    position = clustered(source, term, count, size)[term] if size else term
    order = np.lexsort((position, source))
    source, position, count = source[order], position[order], count[order]
    cuts = np.searchsorted(source, np.arange(len(names) + 1))
    runs = [run_lengths(position[a:b], count[a:b], size) for a, b in zip(cuts, cuts[1:])]
    ends = np.concatenate([[0], np.cumsum([len(s) for s, _ in runs])]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(
        np.concatenate([run[k] for run in runs]).astype(np.int64))) for k in (0, 1)]
    return pa.table([head["lang"], head["block"], head["source"], head["tile"], head["total"],
                     head["kept"], pa.array(np.full(len(names), size, np.int64)), *lists],
                    names=["lang", "block", "source", "tile", "total", "kept", "size",
                           "starts", "counts"])


def pair_difference(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray],
                    size: int) -> int:
    """Sum of |p - q| over a block: one difference for each run that both share."""
    bounds = np.union1d(one[0], other[0])
    p = one[1][np.searchsorted(one[0], bounds, "right") - 1]
    q = other[1][np.searchsorted(other[0], bounds, "right") - 1]
    return int((np.abs(p - q) * np.diff(bounds, append=size)).sum())


def _compare(columns: pa.Table) -> pa.Table:
    """The differences of all pairs of a pair of tiles, in one block."""
    left_tile, right_tile = columns["left"][0].as_py(), columns["right"][0].as_py()
    total, kept, size = (columns[k].to_numpy() for k in ("total", "kept", "size"))
    tile = columns["tile"].to_numpy()
    starts, counts = (columns[k].combine_chunks() for k in ("starts", "counts"))
    runs = []
    for i in range(columns.num_rows):
        count = counts[i].values.to_numpy(zero_copy_only=False)
        runs.append((starts[i].values.to_numpy(zero_copy_only=False),
                     probability(count, total[i], kept[i]) if kept[i] else count))
    order = np.argsort(columns["source"].to_numpy(zero_copy_only=False), kind="stable")
    lefts = [i for i in order if tile[i] == left_tile]
    rights = [i for i in order if tile[i] == right_tile]
    a, b, value = [], [], []
    for at, i in enumerate(lefts):
        for j in rights[at + 1:] if left_tile == right_tile else rights:
            a.append(i)
            b.append(j)
            value.append(pair_difference(runs[i], runs[j], int(size[i])) if size[i] else 0)
    take = [pa.array(np.array(k, dtype=np.int64)) for k in (a, b)]
    return pa.table([columns["lang"].take(take[0]), columns["source"].take(take[0]),
                     columns["source"].take(take[1]), pa.array(value, pa.int64())],
                    names=["lang", "one", "other", "value"])


def divergence(documents: DataFrame, min_documents: int = MIN_DOCUMENTS,
               top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS,
               tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language lie apart.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; a
    language keeps those in at least ``min_documents`` of its documents.  Each source
    gives a kept term the probability ``probability(count, occurrences of kept
    terms, kept terms)``.  Part ``pair`` sums the absolute differences of two sources'
    probabilities over all kept terms, for each other source of the language; part
    ``term`` lists the ``top_terms`` terms that a source uses more than its language,
    by the difference.  Ranks start at 1 for the highest value, ties go by item.

    NULL text, lang and source count as empty; every row is a document, repeated
    rows too; other columns are ignored.  A source without terms is compared like
    any other; without kept terms all values are 0.  An empty table gives no rows.

    Counts are combined before each shuffle and dealt by term, so that a source with
    a third of all documents is as many rows as it has terms.  A block of the
    vocabulary, and a tile of sources in it, have bounded sizes however large a
    language is: as many more blocks are made.
    """
    ship(documents.sparkSession)
    counts = saved(term_counts(documents), "divergence-counts")
    terms = saved(counts.where("term is not null").groupBy("lang", "term")
                  .agg(F.sum("n").alias("in_lang"), F.sum("documents").alias("documents"),
                       F.count(F.lit(1)).alias("sources"))
                  .where(F.col("documents") >= min_documents).drop("documents"),
                  "divergence-terms")
    cells = saved(counts.drop("documents").join(terms.drop("sources"), ["lang", "term"]),
                  "divergence-cells")
    langs = terms.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"),
        F.sum("sources").alias("cells"))
    groups = counts.where("term is null").select("lang", "source")
    tiles = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    blocks = F.greatest(F.ceil(F.col("kept") / block_terms),
                        F.ceil(F.col("cells") / BLOCK_COUNTS), F.lit(1)).cast("int")
    groups = saved(
        groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")),
                    ["lang", "source"], "left")
        .join(tiles, "lang").join(langs, "lang", "left")
        .na.fill(0, ["total", "kept", "lang_total", "cells"])
        .withColumn("blocks", blocks)
        .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles").cast("bigint"))
                    .cast("int")),
        "divergence-groups")

    sizes = groups.select("lang", "blocks").distinct()
    heads = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
        "tile", "total", "kept", F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("bigint").alias("n"))
    dealt = cells.join(sizes, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks").cast("bigint")).cast("int")
        .alias("block"), "source", F.lit(0).alias("tile"), F.lit(0).cast("bigint").alias("total"),
        F.lit(0).cast("bigint").alias("kept"), "term", "n")
    columns = heads.unionByName(dealt).groupBy("lang", "block").applyInArrow(
        _encode, "lang string, block int, source string, tile int, total bigint, kept bigint, "
                 "size bigint, starts array<bigint>, counts array<bigint>")
    # A column meets each tile once: as the left one, or as the right one.
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    met = columns.join(tiles, "lang").select(
        "*", F.explode(others).alias("against")).select(
        "*", F.least("tile", "against").alias("left"),
        F.greatest("tile", "against").alias("right"))
    differences = (met.groupBy("lang", "block", "left", "right").applyInArrow(
        _compare, "lang string, one string, other string, value bigint")
        .groupBy("lang", "one", "other").agg(F.sum("value").alias("value")))
    pairs = differences.select("lang", F.explode(F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("pair"),
        "value").select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")

    of_group = probability(F.col("n"), F.col("total"), F.col("kept"))
    of_lang = probability(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    above = (cells.join(groups.select("lang", "source", "total", "kept", "lang_total"),
                        ["lang", "source"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     (of_group - of_lang).alias("value")).where("value > 0"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return (above.select("*", rank).where(F.col("rank") <= top_terms)
            .unionByName(pairs.select("*", rank)))
