import hashlib
import pickle
import random
import re
import weakref
from types import SimpleNamespace

import numpy as np
import pytest
from streamlens.llm.decontamination import Shard, decontaminate, search_shards, windows
from streamlens.llm.fm_index import FMIndex, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(t):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, bench, size):
    out = []
    items = [(i or "", WORD.findall(_lower(t))) for i, t in bench]
    for t in docs:
        w = WORD.findall(_lower(t))
        hit, names = set(), set()
        for name, iw in items:
            wins = [iw] if 0 < len(iw) < size else [iw[k:k + size] for k in range(len(iw) - size + 1)]
            for x in wins:
                for at in range(len(w) - len(x) + 1) if x else ():
                    if w[at:at + len(x)] == x:
                        hit.update(range(at, at + len(x)))
                        names.add(name)
        out.append((len(w), len(hit), sorted(names)))
    return out


def search_shard(texts, blocks):
    search_shards([shard := Shard(texts)], blocks)
    return shard.result()


def test_suffix_array_and_locate():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n_words = rng.integers(0, 30, rng.integers(1, 8))
        codes = rng.integers(0, 3, n_words.sum())
        fm = FMIndex(codes, n_words, 3, sample=4)
        docs = np.split(codes, np.cumsum(n_words)[:-1])
        for pat in ([0], [1, 2], [2, 2, 1], [0, 1, 0, 1]):
            grid = np.full((1, 5), -1)
            grid[0, 5 - len(pat):] = pat
            lo, hi = fm.search(grid, np.array([len(pat)]))
            at = sorted(fm.locate(np.arange(lo[0], max(lo[0], hi[0]))))
            want = [s + k for s, d in zip(fm.starts, docs) for k in range(len(d) - len(pat) + 1)
                    if list(d[k:k + len(pat)]) == pat]
            assert at == want
    t = np.array([1, 2, 1, 2, 1, 0])
    assert list(suffix_array(t, 3)) == sorted(range(6), key=lambda i: list(t[i:]))


def _corpus(seed):
    rng = random.Random(seed)
    voc = ["the", "Ab", "x1", "é", "ÀB", "zz", "q", "ñu"]

    def text(n):
        return "".join(rng.choice(voc) + rng.choice([" ", ", ", "\n", "_", "'"]) for _ in range(n))
    docs = [text(rng.choice([0, 1, 5, 40, 200])) for _ in range(25)] + [None, "", "...", "the"]
    docs += [docs[3]] * 4
    bench = [(f"i{k}", text(rng.choice([1, 2, 4, 9]))) for k in range(8)]
    bench += [("i1", docs[4]), (None, "zz"), ("e", ""), ("n", None), ("twin", docs[3]), ("twin2", docs[3])]
    return docs, bench


@pytest.mark.parametrize("seed", range(4))
def test_search_matches_brute_force(seed):
    docs, bench = _corpus(seed)
    for size in (1, 3, 10):
        block = [(i or "", (t or "").encode()) for i, t in bench if t is not None]
        halves = [windows(block[:5], size), windows(block[5:], size)]
        n_words, n_hit, found, spans = search_shard([(d or "").encode() for d in docs], halves)
        assert list(zip(n_words, n_hit, found)) == brute(docs, bench, size)
        for d, s, h in zip(docs, spans, n_hit):
            b = (d or "").encode()
            assert sum(len(WORD.findall(b[x:y].decode())) for x, y in s) == h


def test_operator(spark):
    docs, bench = _corpus(9)
    df = spark.createDataFrame([(i, d, "a") for i, d in enumerate(docs)] + [(None, "zz zz", "b"), (0, docs[0], "a")],
                               "doc_id long, text string, n_hit string").repartition(3)
    b = spark.createDataFrame(bench, "item_id string, text string")
    got = decontaminate(df, b, window=3, shard_bytes=200, block_bytes=500).collect()
    want = brute(docs, bench, 3)
    assert len(got) == len(docs) + 2
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_hit, sorted(r.item_ids)) == want[r.doc_id]
    cut = {r.doc_id: r for r in decontaminate(df, b, window=3, cut=True).collect()}
    for i, d in enumerate(docs):
        left = WORD.findall(_lower(cut[i].text))
        assert len(left) == want[i][0] - want[i][1] or want[i][1] == 0
    none = spark.createDataFrame([], "item_id string, text string")
    assert {r.n_hit for r in decontaminate(df, none).collect()} == {0}
    assert decontaminate(df.limit(0), b).count() == 0


def test_worker_holds_one_block(spark, monkeypatch):
    """Blocks are files built by tasks; a search keeps the last one only."""
    from streamlens.llm import decontamination as dec
    docs, bench = _corpus(11)
    paths = dec._blocks(spark.createDataFrame(bench, "item_id string, text string"), 3, "item_id", "text", 300)
    assert len(paths) > 2 and all(isinstance(p, str) for p in paths)
    load, alive, most = dec._loaded, weakref.WeakSet(), []

    class Block(dict):
        __hash__ = object.__hash__

    def counted(data):
        alive.add(block := Block(pickle.loads(data)))
        most.append(len(alive))
        return block
    monkeypatch.setattr(dec, "pickle", SimpleNamespace(loads=counted))
    n_words, n_hit, found, _ = search_shard([(d or "").encode() for d in docs], paths)
    assert list(zip(n_words, n_hit, found)) == brute(docs, bench, 3)
    assert len(most) == len(paths) and max(most) == 1 and load(paths[-1]) is load(paths[-1])


def test_blocks_pass_once_over_several_shards(spark, monkeypatch):
    from streamlens.llm import decontamination as dec
    docs, bench = _corpus(12)
    paths = dec._blocks(spark.createDataFrame(bench, "item_id string, text string"), 3, "item_id", "text", 60)
    load, read = dec.pickle.loads, []
    monkeypatch.setattr(dec, "pickle", SimpleNamespace(loads=lambda data: read.append(1) or load(data)))
    shards = [Shard([(d or "").encode() for d in docs[i:i + 5]]) for i in range(0, len(docs), 5)]
    search_shards(shards, paths)
    got = [r for s in shards for r in zip(*s.result()[:3])]
    assert got == brute(docs, bench, 3) and len(read) == len(paths) > 2 and len(shards) > 4


@pytest.mark.parametrize("held", [1, 1000, 10**6])
def test_held_shards_give_the_same(spark, held):
    docs, bench = _corpus(13)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(bench, "item_id string, text string")
    got = decontaminate(df, b, window=3, shard_bytes=200, block_bytes=60, held_bytes=held, cut=True).collect()
    assert [(r.n_words, r.n_hit, r.item_ids) for r in sorted(got)] == brute(docs, bench, 3)


def test_query_digest(spark):
    from streamlens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in QUERIES["op10_decontamination"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute([d.text for d in docs], bench, 10)
    assert sum(w[1] for w in want)
    for d, (n, h, names) in zip(docs, want):
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert tuple(rows[d.doc_id])[:6] == (d.doc_id, n, h, len(names), sha, h > 0)
