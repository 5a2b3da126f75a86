import random
import re

import numpy as np
import pytest
import xxhash
from streamlens.llm import simhash
from streamlens.llm.components import connected_components, local_roots
from streamlens.llm.queries import QUERIES


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, d=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                parent[find(i)] = find(j)
    low = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None:
            low[r] = min(low.get(r, x), x)
    return [low.get(find(i)) for i in range(len(ids))]


def test_near_pairs_match_brute_force():
    rng = np.random.default_rng(1)
    for radius in (0, 1, 3, 4, 5):
        base = rng.integers(0, 2**63, 12, dtype=np.uint64)
        fp = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, (20, 5)).astype(np.uint64)).sum(1, dtype=np.uint64)
                             for b in base] + [base, base[:3]])
        for n in (0, 1, 63, 64, 65, len(fp)):
            f = rng.permutation(fp)[:n]
            bucket = np.sort(rng.integers(0, 3, n))
            a, b = simhash.near_pairs(f, bucket, radius)
            want = {(i, j) for i in range(n) for j in range(i + 1, n)
                    if bucket[i] == bucket[j] and int(f[i] ^ f[j]).bit_count() <= radius}
            assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_local_roots():
    assert list(local_roots(6, np.array([5, 4, 3]), np.array([4, 3, 1]))) == [0, 1, 2, 1, 1, 1]


@pytest.mark.parametrize("n", [1, 2, 60])
def test_components_of_a_chain_and_a_star(spark, n):
    rng = random.Random(n)
    names = rng.sample(range(1000), 2 * n + 2)
    chain, star = names[:n + 1], names[n + 1:]
    edges = [(chain[i], chain[i + 1]) for i in range(n)] + [(star[0], s) for s in star[1:]]
    edges += [(5000, 5000), (None, 3)] + edges[:2]
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {x: min(chain) for x in chain} | ({x: min(star) for x in star} if len(star) > 1 else {})
    assert got == want


def _texts(seed):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(voc, k=rng.choice([1, 3, 4, 5, 60, 400]))) for _ in range(60)]
    for t in list(texts):
        if len(t) > 900:
            for _ in range(4):
                w = t.split()
                for _ in range(rng.randrange(3)):
                    w[rng.randrange(len(w))] = "new"
                texts.append("  ".join(w).upper())
    return texts + [None, "", " \n", None, texts[0], texts[0]]


@pytest.mark.parametrize("bucket_rows", [4, 2048])
def test_near_duplicates(spark, bucket_rows):
    texts = _texts(3)
    ids = [i if i % 9 else None for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts)], "doc_id long, text string, root int").repartition(4)
    got = simhash.near_duplicates(df, bucket_rows=bucket_rows).collect()
    fps = [fingerprint(t) for t in texts]
    comp = components(ids, fps)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == \
        sorted((str(i), f"{f:016x}", str(c)) for i, f, c in zip(ids, fps, comp))
    assert len(set(comp)) < len(ids) - 20


def test_keep_one(spark):
    texts = _texts(5)
    ids = [i if i % 9 else None for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id long, text string, lang string")
    kept = simhash.keep_one(df.union(df.limit(10))).collect()
    parent = components([(i is None, i or 0, k) for k, i in enumerate(ids)], [fingerprint(t) for t in texts])
    assert len(kept) == len(set(parent))
    assert simhash.keep_one(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [fingerprint(d.text) for d in docs]
    comp = components([d.doc_id for d in docs], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, sf).collect()}
    assert got == {d.doc_id: (f"{f:016x}", c) for d, f, c in zip(docs, fps, comp)}
