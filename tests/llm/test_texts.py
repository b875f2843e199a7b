"""BPE, MinHash, passages, suffixes and toxicity against plain versions."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import bpe, catalogue, common, minhash, passages, suffixes, toxicity
from tests.llm.helpers import ODD_TEXTS, near_duplicate_groups, repeated_bytes, words


# BPE

ODD_TOKENS = ["  a", "a  b", "a \n b", "x <|endoftext|> y<|endoftext|>", "½²Ⅻ á",
              "it's we'LL ' s", "a" * 3000, "\x00 \x85z", "　a b", " \r\n x "]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(catalogue.VOCABULARY))


def test_codec_equals_library(library):
    rng = random.Random(1)
    codec = bpe.Codec(catalogue.vocabulary())
    mixed = ["".join(rng.choice(" \n\ta'sé1²😀.<|x　") for _ in range(rng.randint(1, 40)))
             for _ in range(500)]
    for text in [t or "" for t in ODD_TEXTS] + ODD_TOKENS + mixed:
        ids = library.encode(text, add_special_tokens=False).ids
        digits = codec.encode(text)
        assert digits == ",".join(map(str, ids))
        assert codec.decode(digits) == library.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    codec = bpe.Codec(catalogue.vocabulary())
    text = " ".join(f"word{i}" for i in range(100))
    assert codec.decode(codec.encode(text)) == text
    assert len(codec.memory) <= 5 and len(codec.memory.older) <= 5


def test_bpe_query(spark, folder, corpus, library):
    found = {r.doc_id: r for r in catalogue.op2_bpe(spark, folder).collect()}
    assert len(found) == len(corpus[1])
    for doc_id, text in corpus[1]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_round_trip_and_clashing_columns(docs):
    frame = docs(list(enumerate(ODD_TEXTS))).withColumn("ids", F.lit("x")).withColumn(
        "decoded", F.lit(1))
    content = catalogue.vocabulary()
    rows = bpe.decode(bpe.encode(frame, content), content).collect()
    assert [r.decoded for r in sorted(rows)] == [t or "" for t in ODD_TEXTS]
    assert bpe.encode(docs([]), content).count() == 0


# MinHash

def found_groups(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_minhash_query(spark, folder, corpus):
    found = catalogue.op4_minhash(spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_duplicate_groups(
        corpus[1], 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def near_copies(n, seed=4, size=120):
    """Texts that differ from one base in a few words each, many only linked by chains."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    rows = []
    for d in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(size)] = f"x{rng.randrange(50)}"
        rows.append((d, " ".join(copy)))
    return rows


def test_minhash_large_group(docs):
    rows = near_copies(150) + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(2000 + i, "same text again and again " * 5) for i in range(40)]
    assert found_groups(minhash.near_duplicates(docs(rows), 3, 85)) == near_duplicate_groups(
        rows, 3, 85)


def test_minhash_edge_rows(docs):
    frame = docs([(None, "a b c d"), (1, "a b c d"), (2, None), (3, "")])
    found = found_groups(minhash.near_duplicates(frame, 3, 85))
    assert found == {None: (2, None), 1: (2, 1), 2: (0, 2), 3: (0, 3)}
    assert minhash.near_duplicates(docs([]), 3, 85).count() == 0


def test_minhash_keeps_one_row(docs):
    frame = docs([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, "z")])
    assert sorted(r.doc_id for r in minhash.deduplicated(frame).collect()) == [1, 3, 4]


def test_minhash_leaves_clashing_columns_alone(docs):
    frame = docs([(1, "a b c d e f"), (2, "a b c d e f"), (2, "x y z"), (3, None)]).withColumns(
        {"_row": F.lit("kept"), "_row_": F.lit(2)})
    left = minhash.deduplicated(frame)
    assert left.columns == frame.columns
    assert sorted((r.doc_id, r._row, r._row_) for r in left.collect()) == [
        (1, "kept", 2), (2, "kept", 2), (3, "kept", 2)]


def test_minhash_tells_rows_of_one_id_apart(docs):
    rng = random.Random(12)
    x, y, z = (" ".join(text_of(rng, 80)) for _ in range(3))
    rows = [(1, x), (1, y), (2, x + " end"), (3, y + " end"), (4, z), (4, None), (5, z), (4, z)]
    kept = {(r.doc_id, r.text) for r in minhash.deduplicated(docs(rows)).collect()}
    assert kept == {(1, x), (1, y), (4, z), (4, None)}
    found = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs(rows)).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}


def test_pruning_bounds_keep_the_threshold():
    for n, least in minhash.least_matches(85):
        assert least < 0.85 * n
    rows = minhash.band_rows(85)
    assert (1 - 0.85 ** rows) ** (minhash.HASHES // rows) <= minhash.BAND_MISS


# Substring dedup

def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    starts = np.array([0, 120, 125, 300])
    found = set(zip(*(x.tolist() for x in passages.compact_windows(values, starts, 8))))
    want = set()
    for a, b in zip(starts, starts[1:]):
        for c in range(a, b):
            left, right = c, c
            while left > a and values[left - 1] > values[c]:
                left -= 1
            while right + 1 < b and values[right + 1] > values[c]:
                right += 1
            if right - left + 1 >= 8:
                want.add((c, left, right))
    assert found == want


def text_of(rng, n):
    return [f"t{rng.randrange(10_000)}" for _ in range(n)]


def test_passages(docs):
    rng = random.Random(2)
    passage, other = text_of(rng, 80), text_of(rng, 60)
    near = list(passage)
    near[40] = "changed"
    rows = [(1, text_of(rng, 50) + passage), (2, passage + text_of(rng, 70)),
            (3, text_of(rng, 30) + near + text_of(rng, 30)), (4, text_of(rng, 200)),
            (5, other + ["z"] * 30), (6, text_of(rng, 20) + other), (7, passage[:40])]
    rows = [(d, " ".join(w)) for d, w in rows] + [(8, None), (9, ""), (None, " ".join(passage))]
    found = {(r.doc_id, r.source_doc_id, r.start_word, r.end_word)
             for r in passages.repeated_passages(docs(rows)).collect()}
    # The third may be found in both of the others.
    assert found - {(3, 2, 30, 110)} == {(2, 1, 0, 80), (3, 1, 30, 110), (6, 5, 20, 80)}
    left = {r.doc_id: r.text for r in passages.without_passages(
        docs(rows), passages.repeated_passages(docs(rows))).collect()}
    assert left[2] == rows[1][1].split(" ", 80)[80]
    assert left[4] == rows[3][1] and left[8] is None and left[9] == ""
    assert passages.repeated_passages(docs([])).count() == 0


def test_passages_of_rows_that_share_an_id(docs):
    rng = random.Random(12)
    passage, tail, alone = text_of(rng, 60), text_of(rng, 60), text_of(rng, 200)
    rows = [(1, text_of(rng, 20) + passage), (5, passage + tail), (5, ["short", "text"]),
            (5, alone), (5, passage + tail), (7, text_of(rng, 9) + tail), (3, tail)]
    rows = [(d, " ".join(w)) for d, w in rows]
    found = passages.repeated_passages(docs(rows))
    spans = {(r.doc_id, r.source_doc_id, r.start_word, r.end_word) for r in found.collect()}
    # The seventh may be found in both of the others.
    assert spans - {(7, 5, 9, 69)} == {(5, 1, 0, 60), (5, 3, 60, 120), (7, 3, 9, 69)}
    assert {r.doc_id for r in found.where("text_hash is not null").collect()} == {5}
    left = sorted((r.doc_id, r.text) for r in passages.without_passages(
        docs(rows), found).collect())
    # Both equal rows of id 5 are gone, the others of that id are whole.
    own = " ".join(rows[5][1].split(" ")[:9]) + " "
    assert left == sorted([rows[0], rows[2], rows[3], (7, own), rows[6]])


def test_passages_leave_clashing_columns_alone(docs):
    rng = random.Random(13)
    passage = " ".join(text_of(rng, 60))
    frame = docs([(1, passage), (2, "own words " + passage)]).withColumns(
        {"cuts": F.lit(7), "row": F.lit("r"), "key": F.lit(1.5)})
    cut = passages.without_passages(frame, passages.repeated_passages(frame))
    assert cut.columns == frame.columns
    assert sorted((r.doc_id, r.text.strip(), r.cuts, r.row) for r in cut.collect()) == [
        (1, passage, 7, "r"), (2, "own words", 7, "r")]


def test_long_documents_are_cut_into_stretches():
    for size, least, longest in ((10, 3, 100), (100, 7, 20), (101, 7, 20), (20, 7, 20), (21, 7, 20)):
        parts = passages.stretches(size, least, longest)
        assert all(b - a <= longest for a, b in parts) and parts[-1][1] == size
        for at in range(size - least + 1):
            assert any(a <= at and at + least <= b for a, b in parts)


def test_passages_behind_a_common_line(docs):
    rng = random.Random(3)
    line = text_of(rng, 12)
    passage = text_of(rng, 30) + line + text_of(rng, 30)
    rows = [(d, text_of(rng, 40) + line + text_of(rng, 40)) for d in range(30)]
    rows += [(100, text_of(rng, 10) + passage), (101, passage + text_of(rng, 10))]
    rows = [(d, " ".join(w)) for d, w in rows]
    found = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(docs(rows)).collect()}
    assert found == {(101, 100)}


def test_passages_in_crowded_groups(docs):
    """True pairs in groups whose first windows are of unrelated documents."""
    rng = random.Random(5)
    line = text_of(rng, 22)
    rows = [(d, text_of(rng, 45) + line + text_of(rng, 45)) for d in range(40)]
    for k in range(60):
        passage = text_of(rng, 15) + line + text_of(rng, 15)
        rows += [(100 + 2 * k, text_of(rng, 10) + passage), (101 + 2 * k, passage + ["end"])]
    rows = [(d, " ".join(w)) for d, w in rows]
    found = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(docs(rows)).collect()}
    assert found == {(101 + 2 * k, 100 + 2 * k) for k in range(60)}


def test_different_shingles_equal_brute_force():
    rng = np.random.default_rng(4)
    for values in (3, 40, 5_000):
        tokens = rng.integers(0, values, 2_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        first = rng.integers(0, 1_900, 3_000)
        last = np.minimum(first + rng.integers(0, 100, 3_000), 1_999)
        found = passages.different(passages.repeats(tokens), first, last, 37)
        assert found.tolist() == [len(set(tokens[a:b + 1].tolist())) >= 37
                                  for a, b in zip(first, last)]


def _naively_compared(doc, centre, left, right, shingles, fresh, later, earlier, least, percent):
    """Every pair of windows, the earlier documents first."""
    out, need = [], passages._needed(least, percent)
    for b in later:
        open_ = fresh[b].copy()
        for a in sorted(earlier, key=lambda a: (doc[a], a)):
            reach = min(left[a], left[b]) + min(right[a], right[b]) + 1
            shared = np.isin(shingles[b], shingles[a])
            if (doc[a] >= doc[b] or reach < least or not shared[open_].any()
                    or len(np.intersect1d(shingles[b], shingles[a])) < need):
                continue
            hint = np.array([[left[a], left[b]]])
            for s, e, a_from, a_to in passages.matching(shingles[a], shingles[b], hint, least,
                                                        percent, shared):
                first_a, first_b = centre[a] - left[a], centre[b] - left[b]
                out.append((doc[b], first_b + s, first_b + e, doc[a], first_a + a_from,
                            first_a + a_to))
                open_[s:e] = False
    return out


def test_equal_windows_are_compared_once(monkeypatch):
    """Windows of the same shingles share what is found, as if each pair were compared."""
    rng, calls, real = np.random.default_rng(8), [], passages.matching
    middle = rng.integers(0, 1 << 32, 30).astype(np.uint32)
    kinds = []  # (left, shingles): around one middle, some alike at one end or both
    ends = [[rng.integers(0, 1 << 32, n).astype(np.uint32) for n in (4, 8, 20, 90)]
            for _ in range(2)]
    for i, j in itertools.product(range(4), repeat=2):
        kinds.append((len(ends[0][i]) + 15, np.concatenate([ends[0][i], middle, ends[1][j]])))
    rows = []
    for n in range(300):
        left, shingles = kinds[n % len(kinds)]
        fresh = rng.random(len(shingles)) < rng.choice([0.02, 0.5, 1.0])
        rows.append((1 + n // 2, left + n % 7, left, len(shingles) - left - 1, shingles, fresh))
    doc, centre, left, right, shingles, fresh = zip(*rows)
    numbers = tuple(map(np.array, (doc, centre, left, right)))
    later, earlier = (np.flatnonzero(rng.random(len(rows)) < share) for share in (0.6, 0.9))
    rest = (*numbers, shingles, fresh, later, earlier, 46, 80)
    monkeypatch.setattr(passages, "matching", lambda *given: calls.append(0) or real(*given))
    found = passages.compared(*rest)
    assert len(calls) <= len(kinds) ** 2
    assert found and sorted(found) == sorted(_naively_compared(*rest))
    assert passages.compared(*rest[:6], later[:0], earlier, 46, 80) == []


def test_passages_compare_no_windows_of_few_shingles(docs, monkeypatch):
    """Windows of a short line over and over, too few shingles to share, stay behind."""
    rng = random.Random(6)
    line = text_of(rng, 22)
    rows = [(d, text_of(rng, 45) + line + text_of(rng, 45)) for d in range(40)]
    rows += [(50 + d, text_of(rng, 2) + line * 20 + text_of(rng, 2)) for d in range(4)]
    for k in range(20):
        passage = text_of(rng, 15) + line + text_of(rng, 15)
        rows += [(100 + 2 * k, text_of(rng, 10) + passage), (101 + 2 * k, passage + ["end"])]
    sent, real = [], passages._slices
    monkeypatch.setattr(passages, "_slices", lambda members, *rest: sent.extend(
        (r.key, r.doc_id) for r in members.select("key", "doc_id").collect())
        or real(members, *rest))
    rows = [(d, " ".join(w)) for d, w in rows]
    found = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(docs(rows)).collect()}
    assert {(101 + 2 * k, 100 + 2 * k) for k in range(20)} <= found
    # A line repeated 20 times has a window for each time, or nearly.
    assert sent and max(map(sent.count, (x for x in sent if 50 <= x[1] < 54)), default=0) < 10


def test_passages_leave_only_spans_on_disk(docs, tmp_path, monkeypatch):
    """Between steps, tables that nothing reads any more go from the shared folder."""
    number = itertools.count()
    monkeypatch.setattr(common, "scratch_folder",
                        lambda spark, label: f"{tmp_path}/{label}-{next(number)}")
    rng = np.random.default_rng(8)
    line = " ".join(f"c{i}" for i in range(30))
    texts = [" ".join(f"x{v}" for v in rng.integers(0, 10**9, 60)) for _ in range(4)]
    rows = [(i, f"{line} {texts[i % 4]} {line} u{i}") for i in range(40)]
    found = passages.repeated_passages(docs(rows))
    left = [path.name for path in tmp_path.glob("passages-*")]
    read = tuple(f"passages-{name}-" for name in (
        "members", "pairs", "open", "crowd", "lines", "more-pairs", "rest", "left"))
    assert left and not [name for name in left if name.startswith(read)]
    assert {r.doc_id for r in found.collect()} == set(range(4, 40))


def test_passages_once_edited(docs):
    """A similarity of 41 / 51: none of 400 pairs may be missed."""
    rng = random.Random(7)
    rows = []
    for k in range(400):
        passage = text_of(rng, 50)
        edited = passage[:25] + ["changed"] + passage[26:]
        rows += [(2 * k, text_of(rng, 20) + passage + text_of(rng, 20)),
                 (2 * k + 1, text_of(rng, 20) + edited + text_of(rng, 20))]
    rows = [(d, " ".join(w)) for d, w in rows]
    found = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(docs(rows)).collect()}
    assert found == {(2 * k + 1, 2 * k) for k in range(400)}
    assert (1 - 0.8) ** passages.functions_for(80) <= passages.MISS


def test_passages_query_finds_exact_repeats(spark, folder, corpus):
    first, repeats = {}, {}
    for doc_id, text in sorted(corpus[1]):
        w = words(text)
        for i in range(len(w) - 54):
            key = tuple(w[i:i + 55])
            if first.setdefault(key, doc_id) < doc_id:
                repeats.setdefault(doc_id, set()).update(range(i, i + 55))
    found = {}
    for r in catalogue.op1_passages(spark, folder).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert set(repeats) <= set(found)
    total = sum(map(len, repeats.values()))
    assert sum(len(repeats[d] & found[d]) for d in repeats) >= 0.98 * total


# Suffix dedup

def test_cover_meets_every_shift():
    cover = set(suffixes.difference_cover().tolist())
    p = suffixes.PERIOD
    assert all(any((i + k) % p in cover and (j + k) % p in cover for k in range(p))
               for i in range(p) for j in range(p))


def suffix_rows(frame):
    return {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans),
                       [(s.start, s.end) for s in r.spans], hashlib.sha256(r.kept).hexdigest())
            for r in suffixes.repeated_bytes(frame).collect()}


def test_suffixes(docs, monkeypatch):
    rng = random.Random(6)
    base = "".join(rng.choice("abcdé ") for _ in range(400))
    rows = [(5, base), (6, base), (7, base[50:149]), (8, base[50:150]), (9, "q" + base[:120] + "z"),
            (10, base[100:220] + base[100:220]), (11, "ab" * 200), (12, None), (13, ""),
            (14, base[:150] + "!" + base[151:300]), (3, "late " + base[200:330]), (20, "x" * 100)]
    rows += [(30 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + i, base[i % 50:] + str(i)) for i in range(60)]
    assert suffix_rows(docs(rows)) == repeated_bytes(rows)
    assert suffix_rows(docs([])) == {}


def test_a_round_sorts_the_keys_it_sends():
    keys = np.unique(np.random.default_rng(0).integers(0, 2 ** 64, 5000, dtype=np.uint64))
    rounds = suffixes._bucket_of(keys, 64, 256) % np.uint64(suffixes.ROUNDS)
    for turn in range(suffixes.ROUNDS):
        mine = keys[rounds == turn]
        assert 0 < len(mine) < len(keys)
        assert suffixes._by_bucket(7, mine, 64, 256, suffixes.ROUNDS, turn).equals(
            suffixes._by_bucket(7, keys, 64, 256, suffixes.ROUNDS, turn))


def test_suffixes_query(spark, folder, corpus):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
             for r in catalogue.op9_suffixes(spark, folder).collect()}
    want = {d: (n, removed, len(spans), digest) for d, (n, removed, spans, digest)
            in repeated_bytes(corpus[1]).items()}
    assert found == want


# Toxicity

def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    scores = catalogue.op7_toxicity(spark, folder).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scores)
    held = [r for r in scores if r.held_out]
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    clean = [r for r in held if r.toxic == 0]
    assert right >= 0.93 and sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_toxicity_learns_a_word(docs, spark):
    rng = random.Random(8)
    rows = [(i, " ".join(text_of(rng, 40) + (["vile"] if i % 4 == 0 else []))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)],
                                   "doc_id bigint, toxic int")
    model = toxicity.train(docs(rows), labels)
    odd = docs([(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(2000, "so VILE here"),
                                                                   (None, "vile")])
    scores = {r.doc_id: r.toxicity for r in toxicity.score(odd, model).collect()}
    assert scores[2000] > 0.5 and scores[None] > 0.5
    assert all(scores[1000 + i] < 0.5 for i in range(len(ODD_TEXTS)))


def test_toxicity_leaves_clashing_columns_alone(docs, spark):
    rows = [(i, "vile words here" if i % 2 else "kind words here") for i in range(200)]
    frame = docs(rows).select(F.lit(9.5).alias("toxicity"), "*")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, toxic int")
    left = toxicity.reject(frame, labels)
    assert left.columns == frame.columns
    assert {(r.doc_id % 2, r.toxicity) for r in left.collect()} == {(0, 9.5)}
    assert left.count() == 100
    scored = toxicity.score(frame, toxicity.train(frame, labels))
    assert {(r.doc_id % 2, r.toxicity >= 0.5) for r in scored.collect()} == {(0, False), (1, True)}


def test_toxicity_sample_is_bounded_in_rows(docs, spark):
    """One labelled id holds nearly all rows; the sample takes no more of them."""
    rows = [(0, f"kind word{i}") for i in range(300)] + [(1, "vile words"), (2, "vile " * 9)]
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs(rows), labels, sample_per_label=20)
    assert model is not None
    assert toxicity.score(docs(rows), model).count() == len(rows)


def test_toxicity_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    frame = docs([(1, "a b"), (2, None)])
    model = toxicity.train(frame, labels)
    assert {r.toxicity for r in toxicity.score(frame, model).collect()} == {0.5}
    assert toxicity.score(docs([]), model).count() == 0
