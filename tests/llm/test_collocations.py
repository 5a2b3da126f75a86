import random
import re
from collections import Counter

import numpy as np
from streamlens.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def grams(rows, max_words=3):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    return f, n


def brute(rows, max_words=3, min_count=10, top=2000):
    f, n = grams(rows, max_words)
    cand = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= min_count}
    found = {}
    for (lang, w), a in cand.items():
        if any(x == lang and len(v) > len(w) and 100 * b >= 50 * a
               and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)) for (x, v), b in cand.items()):
            continue
        cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(lang, i + 1, p.decode(), -a, left, rest, n[lang], -s)
            for lang, rows in found.items() for i, (s, a, p, left, rest) in enumerate(sorted(rows)[:top])]


def _rows(seed, n_docs, words):
    rnd = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(words)] + ["été", "\x00z", "the", "the", "THE"]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(30))
    out = []
    for i in range(n_docs):
        parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(0, 4))]
        parts += [passage] * rnd.choice([0, 1, 1])
        out.append((i, rnd.choice([". ", "\n", "!?", "\t ", ",,"]).join(parts), rnd.choice(["en", "de", None, ""])))
    return out + [(900, None, "en"), (901, "", "xx"), (902, "same " * 700, "en"), (903, "a b. " * 12, None)] * 2


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_brute_force(spark):
    rows = _rows(1, 150, 12)
    got = _got(C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == sorted(brute(rows)) and len(got) > 50


def test_longer_phrases_and_limits(spark):
    rows = _rows(2, 80, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(C.collocations(df, max_words=4, min_count=5, top=20)) == sorted(brute(rows, 4, 5, 20))


def test_parse_covers_every_word_once(spark):
    rows = _rows(3, 60, 40)
    chunks = C.parse(spark.createDataFrame(rows, SCHEMA)).collect()
    n = Counter()
    for c in chunks:
        n[c.lang] += c.own * c.freq
        assert 1 <= c.own <= min(len(c.chunk.split(" ")), C.LONGEST)
    assert n == +grams(rows)[1]
    assert len({(c.lang, c.chunk, c.own) for c in chunks}) == len(chunks)
    assert any(c.freq > 5 and c.own > 2 for c in chunks)  # chunks of the passage that documents share


def test_full_filter_only_lets_more_through(spark, monkeypatch):
    rows = _rows(4, 60, 30)
    monkeypatch.setattr(C, "_bits_for", lambda keys: C._BLOCK_BITS)
    monkeypatch.setattr(C, "bloom", lambda frequent: np.full(C._BLOCK_BITS // 8, 255, np.uint8))
    assert _got(C.collocations(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows))


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.collocations(empty).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None), (2, "a b", "en")], SCHEMA)).collect() == []
    rows = _rows(5, 40, 8)
    clash = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", freq int, chunk string, w int")
    assert _got(C.collocations(clash)) == sorted(brute(rows))


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000
    chunks = spark.createDataFrame([("en", "x y", 2, big), ("en", "x", 1, big + 1)], "lang string, chunk string, own int, freq long")
    import unittest.mock as m
    with m.patch.object(C, "parse", lambda *a: chunks):
        got = C.collocations(chunks).collect()
    assert [(r.a, r.l, r.r, r.score) for r in got] == [(big, 2 * big + 1, big, 10**6 * big * big // ((2 * big + 1) * big))]
