"""Source divergence, the prefix trie and the quality classifier against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import catalogue, divergence, prefix_trie, quality
from tests.compare import connect, differences
from tests.llm.helpers import ODD_TEXTS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, lang string, source string, count bigint, n bigint"


# -- divergence -------------------------------------------------------------

def plain_divergence(rows, least, top):
    """(lang, source, part, item) -> (value, rank), with Python's integers."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = {}

    def rank(key, values):
        order = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))
        for i, (item, value) in enumerate(order, 1):
            out[(*key, item)] = (value, i)

    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        mine = {s: c for (l, s), c in groups.items() if l == lang}
        whole = sum(mine.values(), Counter())

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        probabilities, q = {s: p(c) for s, c in mine.items()}, p(whole)
        for s, own in probabilities.items():
            rank((lang, s, "pair"), {o: sum(abs(own[t] - other[t]) for t in kept)
                                     for o, other in probabilities.items() if o != s})
            above = {t: own[t] - q[t] for t in kept if mine[s][t] and own[t] > q[t]}
            rank((lang, s, "term"), dict(sorted(
                above.items(), key=lambda x: (-x[1], x[0].encode()))[:top]))
    return out


def divergence_rows(frame):
    return {(r.lang, r.source, r.part, r.item): (r.value, r.rank) for r in frame.collect()}


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(4)
    words = [f"{'ABCDéf'[k % 6]}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    rows = [(" ".join(rng.choices(words[:30 + 13 * (i % 11)], k=rng.randrange(60))) + " 12 x-y",
             ("en", "de", None)[i % 3], (None, "a", "b", "c", "long", "a")[i % 6])
            for i in range(200)]
    rows += [(text, "odd", f"s{i % 3}") for i, text in enumerate(ODD_TEXTS * 2)]
    rows += [(None, "en", "silent"), ("", None, None), ("lonely words", "xx", "only")] + rows[:9]
    return rows


@pytest.mark.parametrize("block, tile", [(4_096, 256), (7, 2)])
def test_divergence(spark, spoken, block, tile):
    frame = spark.createDataFrame([(i, *row, 0, 0) for i, row in enumerate(spoken)], DOCS)
    found = divergence.divergence(frame, min_documents=4, top_terms=5, block_terms=block,
                                  tile=tile)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence_rows(found) == plain_divergence(spoken, 4, 5)
    assert divergence.divergence(frame.limit(0)).count() == 0


def test_probability_is_exact_beyond_what_a_long_times_a_billion_holds():
    rng = random.Random(1)
    for _ in range(300):
        kept, total = rng.randrange(1, 10**9), rng.randrange(9 * 10**15 - 5 * 10**9)
        count = rng.randrange(total + 1)
        assert divergence.probability(np.array([count]), total, kept)[0] == (
            1 + 10**9 * (count + 5) // (total + 5 * kept))


def test_run_lengths_and_their_intersection():
    rng = np.random.default_rng(2)
    for _ in range(200):
        size = int(rng.integers(1, 40))
        columns = rng.integers(0, 3, (2, size)) * rng.integers(0, 2, (2, size))
        runs = []
        for column in columns:
            at = np.flatnonzero(column)
            starts, counts = divergence.run_lengths(at, column[at], size)
            assert (np.repeat(counts, np.diff(starts, append=size)) == column).all()
            assert (counts[1:] != counts[:-1]).all()
            runs.append((starts, counts))
        assert divergence.pair_difference(*runs, size) == np.abs(columns[0] - columns[1]).sum()


def test_clustering_shortens_the_runs():
    rng = np.random.default_rng(3)
    source = np.repeat(np.arange(3), 400)
    term = np.concatenate([rng.permutation(500)[:400] for _ in range(3)])
    count = rng.integers(1, 4, len(term))
    position = divergence.clustered(source, term, count, 500)
    assert sorted(position.tolist()) == list(range(500))

    def runs(place):
        return sum(len(divergence.run_lengths(*(x[np.argsort(place[term[source == s]])] for x in (
            place[term[source == s]], count[source == s])), 500)[0]) for s in range(3))

    assert runs(position) < runs(np.arange(500)) / 2


def test_divergence_query(spark, folder):
    frame = catalogue.op11_divergence(spark, folder)
    assert differences(frame, connect(folder), catalogue.oracle_sql()["op11_divergence"]) == []


# -- prefix trie ------------------------------------------------------------

def plain_trie(rows):
    """Rows of the trie, sequence by sequence."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append((turn is not None, turn or 0, role or "",
                              hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, of in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(of) - 1) * len(n[-1][1].encode()) if n else 0
    return Counter(
        (min(of), len(n), min(members[n[:-1]]) if n else None, len(of), children[n], leaves[n],
         saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, of in members.items())


def trie_rows(frame):
    return Counter(tuple(r) for r in frame.drop("node", "parent").collect())


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, node string"


def talks(seed):
    rng = random.Random(seed)
    said = ["", "hi", "é ü", "go on", "same", None]
    return [(c, t, rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else "user",
             rng.choice(said) if rng.random() < 0.3 else f"turn {t}")
            for c in range(-7, 60) for t in range(rng.randrange(14))]


def test_trie(spark):
    rows = talks(1) + [(3, None, "user", "first"), (3, None, None, None), (None, 1, "user", "x"),
                       (200, 2, "b", "tie"), (200, 2, "a", "tie"), (200, 2, "a", "other")]
    rows += rows[:5] * 2  # repeated rows are turns of their own
    frame = spark.createDataFrame([(*row, "clash") for row in rows], CONVERSATIONS)
    found = prefix_trie.prefix_trie(frame)
    assert trie_rows(found) == plain_trie(rows)
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0
    assert prefix_trie.prefix_trie(frame.where("conv_id is null")).count() == 0


def test_one_conversation_over_many_tasks_and_one_deep_chain(spark):
    """Two thirds of the rows are one conversation, whose own turns another one shares."""
    rows = [(1011, t, "user", f"t{t}") for t in range(700)] + talks(2)
    rows += [(1016, t, "user", f"t{t}") for t in range(300)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
        spread = prefix_trie.numbered_turns(frame)
        places = [r.place for r in spread.where("conv_id = 1011").orderBy("place").collect()]
        assert places == list(range(700))
        assert trie_rows(prefix_trie.prefix_trie(frame)) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_contraction_recovers_every_subtree(spark, shape):
    rng = random.Random(5)
    parent = {0: None} | {v: {"chain": v - 1, "star": 0, "random": rng.randrange(max(0, v - 4), v),
                              "forest": None if v % 40 == 0 else max(0, v - 1 - v % 2)}[shape]
                          for v in range(1, 160)}
    children, weight = Counter(parent.values()), {v: rng.randrange(100) for v in parent}
    total = dict(weight)
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    frame = spark.createDataFrame([(v, p, children[v], weight[v]) for v, p in parent.items()],
                                  "node bigint, parent bigint, children bigint, w bigint")
    found = prefix_trie.subtree_totals(frame, ["w"])
    assert {r.node: r.total_w for r in found.collect()} == total


def test_powers_of_either_sign():
    exponents = np.array([0, 1, 5, -1, -7, 1_000_000])
    for base in prefix_trie.BASES:
        found = prefix_trie.powers_at(base, exponents)
        assert found.tolist() == [pow(base, int(e), 1 << 64) for e in exponents]


def test_end_lists_are_digested_in_order(spark):
    ids = [*range(-9_000, 9_000, 7), *range(100_000, 100_050)]
    frame = spark.createDataFrame([(b"x", i) for i in reversed(ids)] + [(b"y", 5)],
                                  "node binary, conv_id bigint")
    found = {bytes(r.node): r.ends_sha256 for r in prefix_trie.end_digests(frame).collect()}
    assert found == {b"x": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     b"y": hashlib.sha256(b"5").hexdigest()}


def test_trie_query(spark, folder):
    frame = catalogue.op12_prefix_trie(spark, folder)
    assert differences(frame, connect(folder), catalogue.oracle_sql()["op12_prefix_trie"]) == []


# -- quality ----------------------------------------------------------------

def test_features_tell_words_and_forms():
    texts = ["The cat, the CAT! 12 12", "", "a"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    doc, feature, count = quality.features_of(data, offsets)
    first = feature[doc == 0]
    # the, cat, cat!, 12 / forms Aa a, a A! 0 and pairs of them, and a repeat
    assert (doc == 1).sum() == 0 and (doc == 2).sum() == 2
    words = {int(f): int(c) for d, f, c in zip(doc, feature, count)
             if d == 0 and f < quality.FEATURES // 2}
    assert sorted(words.values()) == [1, 1, 2, 2] and len(np.unique(first)) == len(first)


def test_votes_are_exact_and_do_not_depend_on_blocks():
    rng = np.random.default_rng(8)
    sample = rng.standard_normal((90, 6)).astype(np.float32)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    sample[40:60] = sample[39]  # copies tie, and all of them vote
    labels = (rng.random(90) < 0.6).astype(float)
    model = quality.Model(None, None, sample, labels, np.where(labels > 0, 2.0, 1.0), 0.7)
    asked = np.concatenate([rng.standard_normal((quality.BLOCK + 30, 6)), sample[39:40] * 2,
                            np.zeros((1, 6))]).astype(np.float32)
    length = np.linalg.norm(asked, axis=1, keepdims=True)
    asked = asked / np.where(length > 0, length, 1)
    found = quality.vote(asked, model, neighbours=10)
    for vector, score in zip(asked, found):
        cosine = (sample @ vector).astype(np.float64)
        near = (cosine >= np.sort(cosine)[-10] - 1e-6) & (cosine > 0)
        weight = np.where(near, cosine, 0) ** quality.SHARPNESS * model.votes
        expected = (weight * labels).sum() / weight.sum() if weight.sum() > 1e-6 else 0.7
        assert abs(score - expected) < 1e-3
    assert found[-1] == pytest.approx(0.7)


def test_quality_learns_from_the_rest_and_judges_the_held_out(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(400)]

    def text(good):
        w = rng.choices(words, k=rng.randrange(20, 90))
        return " ".join(w) + "." if good else " ".join(x.upper() + "!!" for x in w)

    rows = [(i, text(i % 4 > 0)) for i in range(400)] + [(500 + i, t)
                                                         for i, t in enumerate(ODD_TEXTS)]
    rows += [(1, text(True))] * 50 + [(None, "x y")]
    frame = spark.createDataFrame([(*r, 7) for r in rows],
                                  "doc_id bigint, text string, quality_score int")
    labels = spark.createDataFrame(
        [(i, int(i % 4 > 0), 0) for i in range(400)] + [(None, 1, 0), (9, None, 0)],
        "doc_id bigint, quality int, toxic int")
    model = quality.train(frame, labels, sample_per_label=60)
    assert len(model.vectors) <= 120
    scored = quality.score(frame, model).collect()
    assert len(scored) == len(rows) and all(0 <= r.quality_score <= 1 for r in scored)
    held = [(r.doc_id % 4 > 0, r.quality_score) for r in scored
            if r.doc_id is not None and r.doc_id < 400 and r.doc_id != 1
            and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 40 and all((score >= 0.3) == good for good, score in held)
    # What is held out teaches nothing: turning its labels round changes no score.
    turned = labels.withColumn("quality", F.when(
        quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score(frame, quality.train(frame, turned, sample_per_label=60)).collect()
    assert [r.quality_score for r in again] == pytest.approx([r.quality_score for r in scored])
    nothing = quality.score(frame, quality.train(frame, labels.limit(0)))
    assert {r.quality_score for r in nothing.collect()} == {0.5}
    assert quality.score(frame.limit(0), model).count() == 0


def test_quality_query(spark, folder):
    found = catalogue.op13_quality(spark, folder)
    assert [f.simpleString() for f in found.schema] == [
        "doc_id:bigint", "held_out:boolean", "score:double", "predicted:int"]
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = found.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in held)
    assert right >= 0.9 * len(held)
