import numpy as np
import pytest
from streamlens.llm import embedding_dedup
from streamlens.llm.queries import QUERIES


def brute(ids, vectors, least=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(ids)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(vectors, ok)]
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= least] for i in range(n)]
    comp = list(range(n))
    for i in range(n):
        if comp[i] == i:
            todo = [i]
            while todo:
                k = todo.pop()
                comp[k] = i
                todo += [j for j in link[k] if comp[j] != i]
    low = {}
    for i, c in zip(ids, comp):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return [(i, len(lk), low.get(c), i is not None and i == low.get(c)) for i, lk, c in zip(ids, link, comp)]


def _planted(n, dim, seed, cosines):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    out = [base]
    for c in cosines:  # one partner each at exactly this cosine
        other = rng.normal(size=(n, dim))
        other -= (other * base).sum(1, keepdims=True) * base
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        out.append((c * base + np.sqrt(1 - c * c) * other) * rng.uniform(0.1, 9, (n, 1)))
    return np.concatenate(out)


def test_asymmetric_distance_bounds_the_true_one():
    x = embedding_dedup.unit_rows(_planted(500, 20, 1, [0.95]).reshape(-1), 20)
    z = embedding_dedup.fit(x, 16)
    top, codes, error = z.encode(x, 4)
    for k in np.unique(top[:, 0]):
        own = np.flatnonzero(top[:, 0] == k)
        d = z.distances(x[:50], int(k), codes[own])
        true = np.linalg.norm(x[:50, None] - x[None, own], axis=2)
        assert (np.abs(d - true) <= error[own] + 1e-4).all()


def test_recall_at_the_threshold_and_precision(spark):
    v = _planted(700, 32, 2, [0.903, 0.897, 0.99])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    want = brute(list(range(len(v))), v.tolist())
    assert len(got) == len(v)
    found, true = sum(r.n_links for r in got.values()), sum(w[1] for w in want)
    assert 0.9 <= found / true <= 1 and all(got[i].n_links <= n for i, n, *_ in want)
    assert found % 2 == 0


@pytest.mark.parametrize("probes", [1, 8])
def test_counts_are_symmetric(spark, probes):
    """With all lists probed the result is the brute force one; with one, the
    ordered links still come in pairs."""
    v = _planted(120, 16, 5, [0.92, 0.97])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    rows = embedding_dedup.near_duplicates(df, probes=probes, lists=8).collect()
    assert sum(r.n_links for r in rows) % 2 == 0
    if probes == 8:
        f32 = v.astype(np.float32).tolist()
        assert sorted(map(tuple, rows)) == sorted(brute(list(range(len(v))), f32))


def test_two_levels(spark, monkeypatch):
    """More lists than cells: the cells are split in Spark; recall and precision hold."""
    monkeypatch.setattr(embedding_dedup, "CELLS", 8)
    v = _planted(1500, 16, 9, [0.903, 0.897])
    hot = v[0] / np.linalg.norm(v[0]) + np.random.default_rng(3).normal(size=(1500, 16)) * 0.3  # a third of the rows
    v = np.concatenate([v, hot])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, lists=64).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.9).sum(1) - 1
    assert all(got[i] <= n for i, n in enumerate(want))
    assert 0.9 <= sum(got.values()) / want.sum() <= 1
    assert sum(got[i] >= 1 for i in range(1, 1500)) / 1499 >= 0.85  # the planted pairs at 0.903


def test_nearest_lists_of_split_cells():
    rng = np.random.default_rng(1)
    x = embedding_dedup.unit_rows(rng.normal(size=400 * 6), 6)
    z = embedding_dedup.fit(x, 40, split=lambda cells: [c + rng.normal(size=(1 + i % 4, 6)) * 0.1 for i, c in enumerate(cells)])
    assert len(z.lists) == z.starts[-1] > len(z.cells)
    got = z.nearest_lists(x, 6)
    owner = np.repeat(np.arange(len(z.cells)), np.diff(z.starts))
    for row, q in zip(got, x):
        cells = np.argsort(((z.cells - q) ** 2).sum(1))[:embedding_dedup.CELL_PROBES]
        d = np.where(np.isin(owner, cells), ((z.lists - q) ** 2).sum(1), np.inf)
        assert np.allclose(d[row[row >= 0]], np.sort(d)[:6])


def test_edges_and_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "STORED_ROWS", 16)
    monkeypatch.setattr(embedding_dedup, "QUERY_ROWS", 32)
    rng = np.random.default_rng(8)
    c = rng.normal(size=12)
    hot = (c + rng.normal(size=(150, 12)) * 0.05).tolist()
    odd = [None, [], [0.0] * 12, [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [1.0] * 11, [1.0, 2.0], [2.0, 4.0]]
    v = hot + [hot[0]] * 40 + rng.normal(size=(80, 12)).tolist() + odd
    ids = [None if i % 37 == 5 else i for i in range(len(v))] + [3]
    v.append(hot[3])
    df = spark.createDataFrame([(i, x, 9) for i, x in zip(ids, v)], "vec_id long, embedding array<double>, n_links int")
    got = sorted(map(str, map(tuple, embedding_dedup.near_duplicates(df).collect())))
    assert got == sorted(map(str, brute(ids, v)))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = sorted(map(tuple, QUERIES["op4_embedding_dedup"](spark, sf).collect()))
    assert got == sorted(brute([r.vec_id for r in rows], [r.embedding for r in rows]))
