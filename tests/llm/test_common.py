"""Words, shingles and components against plain versions."""

import random

import numpy as np
import pyarrow as pa

from contrail.llm.common import ALPHANUMERIC, NON_SPACE, Words, chunks, components, pick
from tests.llm.helpers import ODD_TEXTS, groups, words

TEXTS = ODD_TEXTS + ["x", "one two", "one two three", "Ünder  the\ttree\n", "tail "]


def test_chunks_cover_all_rows():
    array = pa.array(TEXTS)
    for limit in (1, 10, 1 << 20):
        texts, row = [], 0
        for first, end, data, offsets in chunks(array, limit):
            assert first == row and end > first
            raw = data.tobytes()
            texts += [raw[a:b].decode() for a, b in zip(offsets, offsets[1:])]
            row = end
        assert texts == [t or "" for t in TEXTS]
    assert [t for t in chunks(array.slice(3, 2))][0][1] == 2
    assert list(chunks(pa.array([], pa.string()))) == []


def test_words_and_shingles():
    for limit in (1, 1 << 20):
        seen = {}
        for first, end, data, offsets in chunks(pa.array(TEXTS), limit):
            found = Words(data, offsets, NON_SPACE)
            for i in range(end - first):
                part = slice(found.doc_starts[i], found.doc_starts[i + 1])
                want = words(TEXTS[first + i])
                raw = data.tobytes()
                assert [raw[a:b].decode().lower() for a, b in
                        zip(found.starts[part], found.ends[part])] == [w.lower() for w in want]
                for word, h in zip(want, found.hashes[part].tolist()):
                    assert seen.setdefault(word, h) == h
            for whole in (False, True):
                values, starts = found.shingles(3, whole)
                for i in range(end - first):
                    w = words(TEXTS[first + i])
                    runs = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
                    if whole and w and not runs:
                        runs = [tuple(w)]
                    got = values[starts[i]:starts[i + 1]].tolist()
                    assert len(got) == len(runs)
                    for run, h in zip(runs, got):
                        assert seen.setdefault(run, h) == h
        assert len(set(seen.values())) == len(seen)
    data = np.frombuffer(b"a-b,c", dtype=np.uint8)
    assert len(Words(data, np.array([0, 5]), ALPHANUMERIC).hashes) == 3


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)]  # a chain
    links += [(5, n) for n in range(200, 260)]  # a hub
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    links += [(7, 7), (159, 3), (3, 159)]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    want = groups([link for link in links if link[0] != link[1]], nodes)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    for bound in (0, 20, 10_000):
        found = {r.node: r.root for r in components(frame, "test", bound).collect()}
        assert found == want
    assert components(frame.limit(0), "test").count() == 0


def test_pick(docs, monkeypatch):
    from contrail.llm import common
    frame = docs([(1, "a"), (2, "b"), (2, "c"), (None, "d")])
    ids = frame.where("doc_id = 2").select("doc_id")
    for bound in (0, 10):
        monkeypatch.setattr(common, "BROADCAST_IDS", bound)
        assert sorted(r.text for r in pick(frame, ids).collect()) == ["b", "c"]
        assert sorted(r.text for r in pick(frame, ids, keep=False).collect()) == ["a", "d"]


def test_chunks_are_small():
    """Temporary arrays take about 60 times a chunk, in each worker."""
    sizes = [len(data) for _, _, data, _ in chunks(pa.array(["x" * 1000] * 2000))]
    assert max(sizes) <= 1 << 18 and sum(sizes) == 2_000_000
