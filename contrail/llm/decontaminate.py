"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks,
exact weighted-shingle check.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, saved, told_apart

SHINGLE = 5
PERCENT = 80
#: Fingerprints differ in at most so many bits.
RADIUS = 17
BITS = 64
#: With more than RADIUS / 2 blocks, some block of two such fingerprints differs in at
#: most one bit.
BLOCKS = 9
#: Rows of benchmark shingles or block keys that may be broadcast, about 50 MB.
BROADCAST_ROWS = 500_000


def _bounded(frame: DataFrame) -> DataFrame:
    """``frame``, marked for broadcast if it is within the bound."""
    small = frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(frame) if small else frame


def _plain(text: Column) -> Column:
    """Lower-case words of letters and digits, one space between."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))),
                                   r"[^\p{L}\p{M}\p{N}]+", " "))


def _grams(plain: Column, size: int) -> Column:
    """Every run of ``size`` words, overlapping, in order."""
    more = f"(?: [^ ]+){{{size - 1}}}" if size > 1 else ""
    return F.regexp_extract_all(plain, F.lit(f"(?<![^ ])(?=([^ ]+{more})(?: |$))"), F.lit(1))


def _items(benchmark: DataFrame, shingle: int) -> DataFrame:
    """(item_id, item, n_words, size, grams): words of each row, and its runs of ``size``
    words; ``item`` is a digest of the words, which tells items apart whatever their id.

    An item of fewer than ``shingle`` words is one run; one without words is left out.
    """
    plain = benchmark.select("item_id", _plain(F.col("text")).alias("plain")).where("plain <> ''")
    n = F.size(F.split("plain", " "))
    return saved(plain.select(
        "item_id", F.sha2("plain", 256).alias("item"), n.alias("n_words"), F.least(n, F.lit(shingle)).alias("size"),
        F.when(n < shingle, F.array("plain")).otherwise(_grams(F.col("plain"), shingle))
        .alias("grams")), "benchmark-items")


def _weights(items: DataFrame) -> DataFrame:
    """(gram, weight): a run that several distinct items share weighs less."""
    return (items.select("item", F.explode("grams").alias("gram")).distinct()
            .groupBy("gram").agg((1.0 / F.count(F.lit(1))).alias("weight")))


def _rarest(items: DataFrame, weights: DataFrame, percent: int) -> DataFrame:
    """(item, gram): the heaviest runs of each item, just over the share of its weight
    that a window similar enough may lack; such a window holds one of them."""
    held = (items.select("item", F.explode("grams").alias("gram")).distinct()
            .join(weights, "gram"))
    earlier = (Window.partitionBy("item").orderBy(F.desc("weight"), "gram")
               .rowsBetween(Window.unboundedPreceding, -1))
    lacking = (1 - percent / 100) * F.sum("weight").over(Window.partitionBy("item"))
    return (held.withColumn("before", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
            .withColumn("lacking", lacking).where(F.col("before") <= F.col("lacking") + 1e-6)
            .select("item", "gram"))


def spots(plain: DataFrame, items: DataFrame, weights: DataFrame, percent: int) -> DataFrame:
    """(doc_id, start_word, n_words, size, item): windows to compare with an item.

    They line up with a run that document and item share, in documents that hold one
    of the item's ``_rarest`` runs.  So a run that many items share leads to none of
    them by itself, and rows grow with what documents and items truly have in common.
    """
    known = _bounded(saved(items.select("size", F.explode("grams").alias("gram")).distinct(),
                           "benchmark-runs"))
    hits = None
    for size in sorted(row[0] for row in items.select("size").distinct().collect()):
        part = (plain.select("doc_id", F.posexplode(_grams(F.col("plain"), size))
                             .alias("at", "gram"))
                .join(known.where(F.col("size") == size).select("gram"), "gram", "left_semi"))
        hits = part if hits is None else hits.union(part)
    hits = saved(hits, "benchmark-hits")
    rare = _bounded(saved(_rarest(items, weights, percent), "benchmark-rarest"))
    pairs = hits.join(rare, "gram").select("doc_id", "item").distinct()
    offsets = items.select("item", "n_words", "size", F.posexplode("grams")
                           .alias("offset", "gram")).distinct()
    return (hits.join(pairs.join(offsets, "item"), ["doc_id", "gram"])
            .select("doc_id", F.greatest(F.col("at") - F.col("offset"), F.lit(0))
                    .alias("start_word"), "n_words", "size", "item").distinct())


def fingerprints(shingled: DataFrame, keys: list[str], hash_of: str, weight: str) -> DataFrame:
    """``keys``, ``mass`` and the SimHash ``print`` of each group of weighted hashes."""
    def votes(bit: int) -> Column:
        is_set = F.shiftrightunsigned(F.col(hash_of), bit).bitwiseAND(F.lit(1)) == 1
        return F.sum(F.when(is_set, F.col(weight)).otherwise(-F.col(weight)))

    counted = shingled.groupBy(*keys).agg(
        F.sum(weight).alias("mass"), *(votes(bit).alias(f"v{bit}") for bit in range(BITS)))
    bits = [F.when(F.col(f"v{bit}") > 0, F.lit(1 << bit if bit < 63 else -(1 << 63)))
            .otherwise(F.lit(0)) for bit in range(BITS)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return counted.select(*keys, "mass", total.cast("long").alias("print"))


def _block_spans(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(first bit, width) of each block."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _blocks(flips: bool) -> Column:
    """(block, value) of a fingerprint; with ``flips`` also each value one bit away."""
    keys = []
    for number, (first, width) in enumerate(_block_spans()):
        value = F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << width) - 1))
        for change in [0, *(1 << bit for bit in range(width) if flips)]:
            keys.append(F.struct(F.lit(number).alias("block"),
                                 value.bitwiseXOR(F.lit(change)).alias("value")))
    return F.array(*keys)


def contaminated(documents: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                 percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): where documents hold an item.

    One row per document and item, for the window of the item's length that is
    most like it (the first of several): the weights of the ``shingle``-word runs
    both hold, over those that either holds, reach ``percent`` / 100.  Case and
    punctuation are ignored; whole texts are read.  NULL or empty texts and items
    match nothing, an item of fewer words than a run is one run, rows without doc_id
    or item_id are left out.  Texts that are equal in words are one item, under
    whatever ids they stand, and match alike; different texts under one item_id are
    items of their own, of which the row tells the one most alike.

    1. The text is cut into runs once, and those of the benchmark are looked up
       (broadcast while within a bound).  A window similar to an item holds one of
       its rarest runs, so a document without them meets the item no further; in
       the others, windows that line up with a shared run are made for that item.
    2. Windows of equal content are one row.  Each gets a weighted SimHash.
    3. Fingerprints within ``RADIUS`` bits share a block up to one bit, so the
       join on the item meant and on blocks, with each item's one-bit neighbours,
       misses none of them.
    4. The survivors' similarity is computed exactly.
    """
    items = _items(benchmark.where("item_id is not null"), shingle)
    weights = saved(_weights(items), "benchmark-weights")
    documents = documents.where("doc_id is not null").select("doc_id", "text")
    sizes = sorted(row[0] for row in items.select("size").distinct().collect())
    plain = documents.select("doc_id", _plain(F.col("text")).alias("plain"))
    if not sizes:
        return documents.sparkSession.createDataFrame(
            [], "doc_id bigint, item_id bigint, start_word int, n_words int, similarity double")
    meant = saved(spots(plain, items, weights, percent), "benchmark-spots")
    places = meant.drop("item").distinct()

    # The windows' runs, of the documents concerned alone.
    held = pick(plain, meant.select("doc_id"))
    windows = None
    for size in sizes:
        part = (held.select("doc_id", _grams(F.col("plain"), size).alias("grams"))
                .join(places.where(F.col("size") == size), "doc_id")
                .select("doc_id", "start_word", "n_words", F.array_distinct(F.expr(
                    "slice(grams, start_word + 1, n_words - size + 1)")).alias("grams"))
                .where(F.size("grams") > 0))
        windows = part if windows is None else windows.union(part)
    windows = saved(windows.withColumn("content", F.sha2(F.concat_ws("\n", "grams"), 256)),
                    "benchmark-windows")
    contents = windows.groupBy("content").agg(F.first("grams").alias("grams"))
    contents = saved(contents, "benchmark-contents")
    candidates = (windows.select("doc_id", "start_word", "n_words", "content")
                  .join(meant, ["doc_id", "start_word", "n_words"])
                  .select("content", "item").distinct())

    known = _bounded(weights)

    def shingled(frame: DataFrame, *keys: str) -> DataFrame:
        return (frame.select(*keys, F.explode("grams").alias("gram")).join(known, "gram", "left")
                .select(*keys, F.xxhash64("gram").alias("h"),
                        F.coalesce("weight", F.lit(1.0)).alias("w")))

    texts = items.select("item", F.array_distinct("grams").alias("grams")).distinct()
    prints = fingerprints(shingled(contents, "content"), ["content"], "h", "w")
    item_prints = saved(fingerprints(shingled(texts, "item"), ["item"], "h", "w"),
                        "benchmark-prints")
    keys = _bounded(saved(item_prints.select(
        "item", F.col("print").alias("item_print"), F.col("mass").alias("item_mass"),
        F.explode(_blocks(flips=True)).alias("key")), "benchmark-keys"))
    near = (prints.select("content", "print", "mass", F.explode(_blocks(flips=False)).alias("key"))
            .join(candidates, "content").join(keys, ["item", "key"])
            .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
            .select("content", "mass", "item", "item_mass").distinct())

    weighed = (
        texts.select("item", F.explode("grams").alias("gram")).join(known, "gram")
        .groupBy("item").agg(F.collect_list(F.struct("gram", "weight")).alias("weighed")))
    common = F.aggregate(
        F.filter("weighed", lambda x: F.array_contains(F.col("grams"), x["gram"])),
        F.lit(0.0), lambda total, x: total + x["weight"])
    similarity = F.col("common") / (F.col("mass") + F.col("item_mass") - F.col("common"))
    alike = (near.join(contents, "content").join(weighed, "item")
             .withColumn("common", common).withColumn("similarity", similarity)
             .where(F.col("similarity") >= percent / 100 - 1e-9)
              .join(items.select("item", "item_id", "n_words").distinct(), "item")
             .select("content", "n_words", "item_id", "similarity"))
    return (windows.join(alike, ["content", "n_words"]).groupBy("doc_id", "item_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "start_word", "n_words")).alias("best"))
        .select("doc_id", "item_id", "best.start_word", "best.n_words",
                (-F.col("best.s")).alias("similarity")))


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item.

    Rows without doc_id and NULL or empty texts stay.  Of rows that share a doc_id each
    is judged by its own text: where one holds an item, they are looked at row by row.
    Other columns stay as they are, whatever their names.
    """
    found = saved(contaminated(documents, benchmark).select("doc_id").distinct(),
                  "benchmark-found")
    kept = pick(documents, found, keep=False)
    row = "_row"
    while row in documents.columns:
        row += "_"
    told, repeats = told_apart(pick(documents, found), row)
    if not repeats:
        return kept
    gone = contaminated(told.select(F.col(row).alias("doc_id"), "text"), benchmark).select(
        F.col("doc_id").alias(row)).distinct()
    return kept.unionByName(told.join(saved(gone, "benchmark-gone"), row, "left_anti")
                            .select(*documents.columns))
