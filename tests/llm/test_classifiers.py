import random
import zlib

import numpy as np
import pytest
from streamlens.llm import language, quality

SF = "/root/testdata/sf0.01"


def _rated(seed, n):
    rng = random.Random(seed)
    voc = ["word%d" % i for i in range(400)]
    rows = []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        w = rng.choices(voc, k=rng.randrange(20, 400))
        if grade == 0:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", "nasty"]))
        if grade == 1:
            w = [x for x in w for _ in range(rng.randrange(1, 4))]
        rows.append((i, " ".join(w), grade))
    return rows


def test_gradient_of_the_link():
    """The analytic probabilities sum to one and order with the score."""
    m = quality.Model(np.zeros(quality.BUCKETS, np.float32), np.array([-1.0, 0.5]), np.array([0, 1, 2]))
    m.weights[:4] = [-3, -1, 1, 3]
    c = m.cumulative(np.array([0, 1, 2, 3]), np.arange(5))
    assert (np.diff(c, axis=0) < 0).all() and (np.diff(c, axis=1) > 0).all()


def test_held_out_accuracy():
    train, test = _rated(1, 1500), _rated(2, 600)
    ids, off = quality.features([t.encode() for _, t, _ in train])
    m = quality.fit(ids, off, np.array([g for *_, g in train]))
    assert m.thresholds[0] < m.thresholds[1]
    c = m.cumulative(*quality.features([t.encode() for _, t, _ in test]))
    grade = np.array([g for *_, g in test])
    keep = 1 - c[:, -1] >= 0.5
    assert (keep == (grade == 2)).mean() > 0.97
    expected = (1 - c).sum(1)
    assert expected[grade == 0].mean() < expected[grade == 1].mean() < expected[grade == 2].mean()


def test_quality_operator(spark):
    rows = _rated(3, 400)
    odd = [(None, "word1 word2", None), (7, rows[7][1], None), (9001, None, None), (9002, "", None),
           (9003, "x" * 300_000, None)]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t, _ in rows + odd], "doc_id long, text string, keep double")
    labels = spark.createDataFrame(
        [(i, int(g > 1 or g < 1), int(g < 1)) for i, _, g in rows] + [(None, 1, 1), (8, None, 1), (9, None, None)] +
        [(i, 1, 0) for i, *_ in rows[:5]], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, quality.rating())
    got = quality.score(docs, model).collect()
    assert len(got) == len(docs.collect()) and all(0 <= r.p_top <= 1 and isinstance(r.keep, bool) for r in got)
    by = {r.doc_id: r.keep for r in got}
    assert np.mean([by[i] == (g == 2) for i, _, g in rows]) > 0.9
    assert quality.train(docs, labels.limit(0), quality.rating()) is None
    assert {r.keep for r in quality.score(docs, None, keep_text=False).collect()} == {True}
    assert quality.score(docs.limit(0), model).count() == 0
    same = labels.where("quality = 1 and toxic = 0")
    assert quality.train(docs, same, quality.rating()) is None


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_query_on_held_out_labels(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    part = labels.where("doc_id % 3 <> 0")
    model = quality.train(documents, part, quality.rating())
    got = {r.doc_id: r.keep for r in quality.score(documents, model).select("doc_id", "keep").collect()}
    want = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.where("doc_id % 3 = 0").collect()}
    assert np.mean([got[i] == w for i, w in want.items()]) > 0.9


def test_kernel_matches_brute_force():
    texts = ["Hello, World!", "hello the", "ça va bien", "x"]

    def grams(t):
        t = "".join(c if c.isalpha() else " " for c in t.lower())
        while "  " in t:
            t = t.replace("  ", " ")
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    bits = 1 << 20
    x = np.zeros((4, bits), np.uint8)
    assert all([language.presence(t, x[i]) for i, t in enumerate(texts)])
    k = language._kernel(x.astype(np.float32), x.astype(np.float32))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            ga, gb = grams(a), grams(b)
            assert abs(k[i, j] - len(ga & gb) / (len(ga) * len(gb)) ** 0.5) < 1e-5
    assert not language.presence("12 !\n", x[0]) and not language.presence(None, x[0])


def test_long_texts_are_read_whole(monkeypatch):
    rng = random.Random(4)
    t = "".join(rng.choices("abcdefg hij. é", k=5000))
    a, b = np.zeros(1 << 14, np.uint8), np.zeros(1 << 14, np.uint8)
    language.presence(t, a)
    monkeypatch.setattr(language, "_SPAN", 700)
    language.presence(t, b)
    assert not (a & ~b & 1).any()  # all n-grams are found in the spans, too


def test_language_held_out_accuracy(spark, documents):
    model = language.train(documents)
    got = language.predict(documents, model).withColumn("held", language.is_held_out("doc_id")).collect()
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in got if r.held]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 100 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark, documents):
    odd = [(1, None, "en"), (2, "", "en"), (None, "123 ?!", None), (None, "the and of it", None), (3, "the " * 99999, "en")]
    df = documents.select("doc_id", "text", "lang").limit(200).union(
        spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    model = language.train(df, sample_rows=50, landmarks=16)
    got = language.predict(df, model).collect()
    assert len(got) == 205 and sum(r.lang_pred == "und" and r.score == 0 for r in got) == 3
    none = df.where("lang is null")
    assert language.train(none) is None
    assert {r.lang_pred for r in language.predict(none, None).collect()} == {"und"}
    assert language.predict(df.limit(0), model).count() == 0


def test_every_language_value_is_learnt(spark):
    """More values than 1,000: the rare ones are learnt and predicted, too."""
    rng = random.Random(6)
    rows, i = [], 0
    for k in range(1205):
        for _ in range(1 if k < 200 else 2):  # the first 200 are the rare ones
            i += 1
            while zlib.crc32(str(i).encode()) % 4 == 2:
                i += 1
            rows.append((i, " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(12)), f"{'ab'[k >= 200]}{k:04d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, bits=1 << 12)
    assert len(model.languages) == 1205
    got = {r.doc_id: r.lang_pred for r in language.predict(docs.where("lang < 'b'"), model).collect()}
    assert np.mean([got[d] == lang for d, _, lang in rows[:200]]) > 0.9


def test_fit_equals_the_dense_solution():
    rng = np.random.default_rng(1)
    packed = np.packbits(rng.integers(0, 2, (60, 64), dtype=np.uint8), axis=1)
    labels = [["c", "a", "b", "a"][i % 4] for i in range(60)]
    m = language.fit(packed, labels, landmarks=12)
    k = language._kernel(language._unpack(packed), language._unpack(m.landmarks)).astype(np.float64)
    value, vector = np.linalg.eigh(language._kernel(*[language._unpack(m.landmarks)] * 2).astype(np.float64))
    root = vector[:, value > 1e-6 * value[-1]] / np.sqrt(value[value > 1e-6 * value[-1]])
    phi, y = k @ root, np.where(np.array(labels)[:, None] == np.array(m.languages), 1.0, -1.0)
    c = phi - phi.mean(0)
    beta = np.linalg.solve(c.T @ c + language.RIDGE * 60 * np.eye(c.shape[1]), c.T @ (y - y.mean(0)))
    assert np.allclose(k @ m.weights + m.bias, c @ beta + y.mean(0), atol=1e-3)
