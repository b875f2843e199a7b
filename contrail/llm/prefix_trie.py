"""Conversation prefix trie: shared beginnings as a tree, summed up by tree contraction.

Every distinct sequence of first turns is a node.  Nodes are told apart by their depth
and two 64-bit prefix hashes of the turns, sums of turn hashes times rising powers: such
sums can be taken over parts of a conversation and put together, so one conversation may
be longer than a task can hold.  Subtree totals come from rounds of rake (leaves hand
their totals to their parents) and compress (nodes with one child are taken out of their
chains), then the nodes taken out are put back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, saved, ship

#: Odd bases of the two prefix hashes, arithmetic modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: The first turns of a conversation that others may borrow: ``borrowed`` stays below it.
BORROWED_BELOW = 9
#: Conversations whose numbers travel in one row of an end list.
IDS_PER_ROW = 4_096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def powers_at(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo 2**64, for exponents of either sign."""
    result = np.ones(len(exponents), dtype=np.uint64)
    for sign in (1, -1):
        left = np.maximum(exponents * sign, 0).astype(np.uint64)
        step = base if sign > 0 else pow(base, -1, 1 << 64)
        while left.any():
            odd = (left & np.uint64(1)).astype(bool)
            result[odd] *= np.uint64(step)
            left >>= np.uint64(1)
            step = step * step % (1 << 64)
    return result


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix hashes of each turn, counted from where its conversation begins
    in this part of the sorted turns."""
    part = TaskContext.get().partitionId()
    last, places, sums = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        of = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(conv)))
        place = np.arange(len(conv)) - begins[of]
        goes_on = conv[0] == last
        if goes_on:
            place[of == 0] += places
        before, after = [], []
        for k, base in enumerate(BASES):
            terms = _u64(batch.column(2 + k)) * powers_at(base, place)
            running = np.cumsum(terms, dtype=np.uint64)
            running -= (running[begins] - terms[begins])[of]
            if goes_on:
                running[of == 0] += sums[k]
            after.append(running)
            before.append(running - terms)
            sums[k] = running[-1]
        last, places = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(place),
             batch.column(1), *map(_i64, after), *map(_i64, before)],
            ["conv_id", "part", "place", "n_bytes", "a1", "a2", "b1", "b2"])


_NUMBERED = ("conv_id bigint, part int, place bigint, n_bytes bigint, a1 bigint, a2 bigint, "
             "b1 bigint, b2 bigint")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Place (from 0) of each turn in its conversation, and the prefix hashes up to it
    (``a1, a2``) and before it (``b1, b2``).

    Turns are sorted by range over the whole table.  A conversation that spans parts is
    put together from one count and one hash of each part, as row numbers over a whole
    table are: at most two rows of a part come to the driver.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "row"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "n_bytes", F.xxhash64("role", "digest").alias("h1"),
        F.xxhash64(F.lit(1), "digest", "role").alias("h2"))
    local = saved(map_arrow(turns, _number, _NUMBERED), "trie-turns")
    parts = local.groupBy("conv_id", "part").agg(
        F.max(F.struct("place", "a1", "a2")).alias("last"))
    torn = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    before: dict[tuple[int, int], tuple[int, int, int]] = {}
    was, count, sums = None, 0, [0, 0]
    for row in sorted(parts.join(torn, "conv_id", "left_semi").collect(),
                      key=lambda r: (r.conv_id, r.part)):
        if row.conv_id != was:
            was, count, sums = row.conv_id, 0, [0, 0]
        before[row.conv_id, row.part] = (count, *sums)
        sums = [(s + pow(base, count, 1 << 64) * x) % (1 << 64)
                for s, base, x in zip(sums, BASES, (row.last.a1, row.last.a2))]
        count += row.last.place + 1
    if not before:
        return local.drop("part")
    by_part: dict[int, list] = {}
    for (conv, part), shift in before.items():
        by_part.setdefault(part, []).append((conv, shift))

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, place = (batch.column(k).to_numpy().copy() for k in range(3))
            hashes = [_u64(batch.column(k)).copy() for k in range(4, 8)]
            for number in np.unique(part):
                for one, (count, *sums) in by_part.get(int(number), ()):
                    rows = np.flatnonzero((conv == one) & (part == number))
                    place[rows] += count
                    for k, values in enumerate(hashes):
                        values[rows] = (values[rows] * np.uint64(pow(BASES[k % 2], count, 1 << 64))
                                        + np.uint64(sums[k % 2]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(place), batch.column(3),
                 *map(_i64, hashes)], batch.schema.names)

    return map_arrow(local, join_parts, _NUMBERED).drop("part")


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from the one that it is rebuilt on."""
    return F.crc32(conv_id.cast("string").cast("binary")) % BORROWED_BELOW


def _pack(depth: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.Array:
    """Node names: 16 bytes, the two hashes, with the depth mixed into the first."""
    out = np.empty((len(depth), 2), dtype=np.uint64)
    out[:, 0] = one + depth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    out[:, 1] = other
    out[depth == 0] = 0
    return pa.Array.from_buffers(pa.binary(16), len(depth),
                                 [None, pa.py_buffer(out)]).cast(pa.binary())


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node of each rebuilt prefix, and the node before it."""
    for batch in batches:
        depth, shift = (batch.column(k).to_numpy() for k in (1, 2))
        after, before = [], []
        for k, base in enumerate(BASES):
            scale = powers_at(base, shift)
            up_to, prior, skipped, taken = (_u64(batch.column(i + k)) for i in (3, 5, 7, 9))
            after.append(taken + (up_to - skipped) * scale)
            before.append(taken + (prior - skipped) * scale)
        yield pa.RecordBatch.from_arrays(
            [_pack(depth, *after), _pack(depth - 1, *before), batch.column(1),
             batch.column(0), batch.column(11), batch.column(12)],
            ["node", "parent", "depth", "conv_id", "n_bytes", "ends"])


def rebuilt_prefixes(conversations: DataFrame) -> DataFrame:
    """(node, parent, depth, conv_id, n_bytes, ends): a row for each prefix, the empty one
    too, of each rebuilt conversation; ``ends`` marks the whole of it."""
    turns = numbered_turns(conversations)
    early = F.when(F.col("place") < BORROWED_BELOW - 1,
                   F.struct("place", "n_bytes", "a1", "a2", "b1", "b2"))
    facts = saved(turns.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("n"), F.array_sort(F.collect_list(early)).alias("early"))
        .withColumn("h", borrowed(F.col("conv_id"))), "trie-conversations")
    base = facts.select(F.col("conv_id").alias("base"), F.col("early").alias("lent"))
    plan = facts.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(
        base, "base", "left").withColumn(
        "lent", F.slice(F.coalesce("lent", F.slice("early", 1, 0)), 1, F.col("h").cast("int"))).withColumn(
        "m", F.size("lent").cast("bigint")).select(
        "conv_id", "h", "m", "lent", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .alias("length"), F.get("lent", F.col("m").cast("int") - 1).alias("t"),
        F.get("early", F.col("h").cast("int") - 1).alias("s"))
    plan = saved(plan, "trie-plan")
    zero = F.lit(0).cast("bigint")

    def rows(frame, depth, shift, up_to, skipped, taken, n_bytes):
        return frame.select(
            "conv_id", depth.alias("depth"), shift.alias("shift"),
            *(F.coalesce(c, zero).alias(f"c{i}") for i, c in enumerate((*up_to, *skipped, *taken))),
            n_bytes.alias("n_bytes"), (depth == F.col("length")).alias("ends"))

    root = rows(plan, zero, zero, [zero] * 4, [zero] * 2, [zero] * 2, zero)
    lent = plan.select("conv_id", "length", F.explode("lent").alias("e"))
    lent = rows(lent, F.col("e.place") + 1, zero,
                [F.col(f"e.{c}") for c in ("a1", "a2", "b1", "b2")], [zero] * 2, [zero] * 2,
                F.col("e.n_bytes"))
    own = turns.join(plan.drop("lent"), "conv_id").where("place >= h")
    own = rows(own, F.col("m") + F.col("place") - F.col("h") + 1, F.col("m") - F.col("h"),
               [F.col(c) for c in ("a1", "a2", "b1", "b2")],
               [F.col("s.a1"), F.col("s.a2")], [F.col("t.a1"), F.col("t.a2")], F.col("n_bytes"))
    return map_arrow(root.union(lent).union(own), _name,
                     "node binary, parent binary, depth bigint, conv_id bigint, n_bytes bigint, "
                     "ends boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): the digest of the numbers in order.

    Numbers are first joined into short lists by ranges, then each node's lists are
    streamed in order through one digest, a row at a time: a node may have any number.
    """
    lists = (ends.groupBy("node", F.floor(F.col("conv_id") / IDS_PER_ROW).alias("range"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_set("conv_id")),
                                           lambda c: c.cast("string")), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            nodes, found = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last:
                    if last is not None:
                        nodes.append(last)
                        found.append(state.hexdigest())
                    last, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()),
                                              pa.array(found, pa.string())],
                                             ["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()),
                                              pa.array([state.hexdigest()])],
                                             ["node", "ends_sha256"])

    dealt = lists.repartition("node").sortWithinPartitions("node", "range").select("node", "ids")
    return map_arrow(dealt, digest, "node binary, ends_sha256 string")


def subtree_totals(nodes: DataFrame, measures: list[str]) -> DataFrame:
    """(node, total_<measure>...): sums over the subtree of each node, by tree contraction.

    ``nodes`` has node, parent (NULL for a root), children (how many), and the measures
    as longs.  A round rakes all leaves and compresses: of the nodes left with a single
    child, those whose hash is above both neighbours' leave, about a third of a chain,
    and the child takes the place with what the chain carried.  Rounds grow with the
    logarithm of the nodes, not with the depth.  Sums are combined before they are
    shuffled, and joins are on unique keys, so a node may have any number of children.
    """
    ship(nodes.sparkSession)
    own, carried = [f"own_{m}" for m in measures], [f"carried_{m}" for m in measures]
    live = nodes.select("node", "parent", "children",
                        *(F.col(m).alias(o) for m, o in zip(measures, own)),
                        *(F.lit(0).cast("bigint").alias(c) for c in carried))
    raked, dropped = [], []
    while True:
        leaf = F.col("children") == 0
        up = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count_if(~leaf).alias("left"), F.min(F.when(~leaf, F.col("node"))).alias("kid"),
            *(F.coalesce(F.sum(F.when(leaf, F.col(o) + F.col(c))), F.lit(0)).alias(f"from_{o}")
              for o, c in zip(own, carried)))
        rank = lambda c: F.xxhash64(F.lit(len(raked)), c)
        inner = live.where(~leaf).join(up, "node").select(
            "node", "parent", F.col("left").alias("children"), "kid",
            *((F.col(o) + F.col(f"from_{o}")).alias(o) for o in own), *carried,
            ((F.col("left") == 1) & F.col("parent").isNotNull()
             & (rank("node") > rank("kid")) & (rank("node") > rank("parent"))).alias("out"))
        inner = saved(inner, "trie-inner")
        raked.append(live.where(leaf).select("node", *(F.col(o).alias(m)
                                                       for m, o in zip(measures, own))))
        out = inner.where("out")
        # A kid's carry goes up through the node that leaves.
        adopted = out.select(F.col("kid").alias("node"), F.col("parent").alias("new_parent"),
                             F.col("node").alias("gone"),
                             *((F.col(o) + F.col(c)).alias(f"with_{c}")
                               for o, c in zip(own, carried)),
                             *(F.col(o).alias(f"gone_{o}") for o in own))
        after = saved(inner.where("not out").join(adopted, "node", "left"), "trie-live")
        dropped.append(after.where("gone is not null").select(
            F.col("gone").alias("node"), F.col("node").alias("kid"),
            *((F.col(f"gone_{o}") + F.col(c)).alias(m)
              for m, o, c in zip(measures, own, carried))))
        live = after.select(
            "node", F.coalesce("new_parent", "parent").alias("parent"), "children", *own,
            *((F.col(c) + F.coalesce(f"with_{c}", F.lit(0))).alias(c) for c in carried))
        if live.isEmpty():
            break
    totals = raked[0]
    for frame in raked[1:]:
        totals = totals.union(frame)
    out = dropped[0]
    for frame in dropped[1:]:
        out = out.union(frame)
    # A node that left lacks its kid's total, and the kid may have left later: follow the
    # kids, twice as far each time, until all stand on raked nodes.
    out = saved(out, "trie-left")
    while True:
        step = out.select(F.col("node").alias("kid"), F.col("kid").alias("next"),
                          *(F.col(m).alias(f"next_{m}") for m in measures))
        if out.join(step, "kid", "left_semi").isEmpty():
            break
        out = saved(out.join(step, "kid", "left").select(
            "node", F.coalesce("next", "kid").alias("kid"),
            *((F.col(m) + F.coalesce(f"next_{m}", F.lit(0))).alias(m) for m in measures)),
            "trie-left")
    rest = out.join(totals.select(F.col("node").alias("kid"),
                                  *(F.col(m).alias(f"of_{m}") for m in measures)), "kid").select(
        "node", *((F.col(m) + F.col(f"of_{m}")).alias(m) for m in measures))
    return totals.union(rest).toDF("node", *(f"total_{m}" for m in measures))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored.  Turns
    go by ``turn``, NULL first; equal ones by role, then by the digest of the text;
    repeated rows are turns of their own.  NULL role and text count as empty.  Rows
    without conv_id belong to no conversation.  An empty table has no node.

    Each conversation c is rebuilt: ``borrowed(c)`` first turns of conversation
    c - c % 5 (fewer if it has fewer, none if it is absent), then its own turns after as
    many.  A node stands for a sequence of (role, text); rebuilt conversations that
    begin with it are its members.  Columns: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (sum over the subtree of (n_convs - 1) times the bytes of the node's
    last text), ends_sha256 (digest of the members that end here), node and parent.
    """
    prefixes = saved(rebuilt_prefixes(conversations), "trie-prefixes")
    nodes = prefixes.groupBy("node", "depth").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    nodes = saved(nodes.withColumn("parent", F.when(F.col("depth") > 0, F.col("parent"))),
                  "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("children"))
    nodes = saved(nodes.join(children, "node", "left").na.fill(0, ["children"]).withColumn(
        "leaves", (F.col("children") == 0).cast("bigint")).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("n_bytes")), "trie-tree")
    totals = subtree_totals(nodes, ["leaves", "saved"])
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    digests = end_digests(prefixes.where("ends").select("node", "conv_id"))
    return (nodes.join(totals, "node").join(digests, "node", "left")
            .join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("total_leaves").alias("n_leaves"), F.col("total_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"), "node", "parent"))
