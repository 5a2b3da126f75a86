import re
from collections import defaultdict

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from streamlens.llm import packing, pii
from streamlens.llm.common import materialize

from .test_decontamination import brute as contaminated
from .test_simhash import components, fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"": docs}
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_are_kept(steps):
    cols = steps[""].columns
    for name, _ in cp.STAGES[:-1]:
        assert steps[name].columns == cols and steps[name].schema == steps[""].schema
        assert steps[name].where("n_chars <> length(text)").count() == 0


def test_quality(spark, steps):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, kept = _rows(steps[""]), _rows(steps["quality"])
    good = [i for i, r in labels.items() if i in before and r.quality == 1 and r.toxic == 0]
    bad = [i for i, r in labels.items() if i in before and (r.quality < 1 or r.toxic > 0)]
    assert np.mean([i in kept for i in good]) > 0.97 and np.mean([i in kept for i in bad]) < 0.15
    assert all(kept[i] == before[i] for i in kept)


def test_simhash(steps):
    before, kept = _rows(steps["quality"]), _rows(steps["simhash"])
    ids = sorted(before)
    comp = components(ids, [fingerprint(before[i].text) for i in ids])
    assert sorted(kept) == sorted(set(comp)) and len(kept) < len(before)


def test_decontamination(spark, steps):
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = _rows(steps["simhash"]), _rows(steps["decontamination"])
    assert sorted(before) == sorted(after)
    hit = contaminated([before[i].text for i in sorted(before)], bench, 10)
    assert sum(h[1] > 0 for h in hit) > 0
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, (n, h, _) in zip(sorted(before), hit):
        left = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), after[i].text))
        assert len(left) == n - h if h else after[i] == before[i]


def test_pii(steps):
    before, after = steps["decontamination"], steps["pii"]
    found = before.select("doc_id", pii.entities(F.col("text")).alias("e")).collect()
    texts = {r.doc_id: r.text for r in after.collect()}
    old = {r.doc_id: r.text for r in before.collect()}
    assert sorted(texts) == sorted(old) and any(r.e for r in found)
    for r in found:
        assert (texts[r.doc_id] == old[r.doc_id]) == (not r.e) and not any(e in texts[r.doc_id] for e in r.e)


def test_packing(steps):
    tok = packing._load(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for r in steps["packing"].orderBy("doc_id", "start").collect():
        assert len(ids[r.doc_id]) == r.start
        ids[r.doc_id] += np.frombuffer(bytes(r.token_ids), "<u4").tolist()
    for r in steps["pii"].collect():
        assert ids.pop(r.doc_id) == tok.encode(r.text, add_special_tokens=False).ids + [1]
    assert not ids


def test_run_and_odd_tables(spark, tmp_path):
    """NULLs, repeated rows, extra and clashing columns, an empty table."""
    rows = [(1, "one two three", "en", "s", 13, 0), (1, "one two three", "en", "s", 13, 0), (None, None, None, None, None, 1),
            (2, "", "de", None, 0, 1), (3, "mail a@b.org " * 300, "en", "s", 1, 2), (4, "x" * 100_000, "fr", "s", 1, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep int"
    for n in (len(rows), 0):
        sf = f"{tmp_path}/{n}"
        spark.createDataFrame(rows[:n], schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(7, "two three"), (None, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        got = cp.run(spark, sf).collect()
        assert {r.doc_id for r in got} == ({1, 2, 3, 4} if n else set())  # NULL and empty texts are one component
        assert all(r.length == len(r.token_ids) // 4 for r in got)
