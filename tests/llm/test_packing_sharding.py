import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from streamlens.llm import packing, sharding
from streamlens.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = packing._load(PATH)
KNOWN = packing.Units(TOK)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aB'sÉ<|>\u0301  \t1!", max_size=30),
                          st.text("aJT.,3'?ñ\u030c\u0308…\xa0 ", max_size=30)), max_size=6))
def test_encoding_equals_the_tokenizer(texts):
    ids, off = packing.encode_texts(KNOWN, pa.array(texts, pa.string()), 1)
    for k, t in enumerate(texts):
        assert list(ids[off[k]:off[k + 1]]) == TOK.encode(t or "", add_special_tokens=False).ids + [1]


def test_units_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(packing, "MAX_KNOWN", 5)
    known = packing.Units(TOK)
    for texts in (["a b c"], ["d e a", "f g h i j k l m"], ["a b", "z"]):
        ids, off = packing.encode_texts(known, pa.array(texts), 1)
        for k, t in enumerate(texts):
            assert list(ids[off[k]:off[k + 1]]) == TOK.encode(t, add_special_tokens=False).ids + [1]


def test_special_strings():
    t = "a<|endoftext|>b <|startoftext|> it's"
    ids, _ = packing.encode_texts(KNOWN, pa.array([t]), 1)
    assert list(ids[:-1]) == TOK.encode(t, add_special_tokens=False).ids


def test_decompose():
    d, s, ln = packing.decompose(np.array([1, 5000, 0, 2048, 7]), 2048)
    by = defaultdict(list)
    for a, b, c in zip(d, s, ln):
        by[int(a)].append((int(b), int(c)))
    assert by[1] == [(0, 2048), (2048, 2048), (4096, 512), (4608, 256), (4864, 128), (4992, 8)]
    assert by[0] == [(0, 1)] and 2 not in by and by[3] == [(0, 2048)]
    assert by[4] == [(0, 4), (4, 2), (6, 1)]


def test_pack_round_trip(spark):
    texts = ["Hello world, it's 1999!", None, "", "x " * 5000, "é" * 3000, "Hello world, it's 1999!"]
    df = spark.createDataFrame([(i if i != 1 else None, t, 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, length int")
    rows = packing.pack(df, PATH).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        assert r.length == 1 << r.bucket <= 2048 and len(r.token_ids) == 4 * r.length and r.offset == 0
        got[r.doc_id] += list(np.frombuffer(bytes(r.token_ids), "<u4"))
    for i, t in enumerate(texts):
        assert got[i if i != 1 else None] == TOK.encode(t or "", add_special_tokens=False).ids + [1]
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_query_against_the_tokenizer(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op6_packing"](spark, sf).collect()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array(TOK.encode(d.text, add_special_tokens=False).ids + [1], "<u4")
        mine = sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.start)
        at = 0
        for r in mine:
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(-2**63, 2**63 - 1))
def test_permutation_is_a_bijection(n, seed):
    p = sharding.permute(np.arange(n), n, seed)
    assert sorted(p) == list(range(n))
    assert list(sharding.unpermute(p, n, seed)) == list(range(n))


def test_permutation_shuffles():
    p = sharding.permute(np.arange(100_000), 100_000, 7)
    assert abs(np.corrcoef(np.arange(100_000), p)[0, 1]) < 0.02
    assert not np.array_equal(p, sharding.permute(np.arange(100_000), 100_000, 8))


def test_shards(spark):
    rows = [(i % 50, "t" * (i % 7), "x") for i in range(200)] + [(None, None, "y")] * 103
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    a = sharding.feistel_shards(df.repartition(5), 8, seed=1).collect()
    b = sharding.feistel_shards(df.repartition(2), 8, seed=1).collect()
    key = lambda rs: Counter((r.doc_id, r.text, r.shard, r.slot) for r in rs)
    assert key(a) == key(b)  # whatever the layout
    assert Counter((r.doc_id, r.text) for r in a) == Counter(r[:2] for r in rows)
    slots = defaultdict(list)
    for r in a:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(r.row_number for r in a) == list(range(len(rows)))
    assert sharding.feistel_shards(df.limit(0), 8).count() == 0


def test_query_sizes(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op8_sharding"](spark, sf).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        t = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "rows", None)


def scalar_position(x, n, seed):
    """The Feistel permutation of [0, n) on Python integers."""
    mask, a = (1 << 64) - 1, 1
    while a * a < n:
        a += 1
    b = -(-n // a)

    def mix(v, key):
        v = v + key & mask
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & mask
        v = (v ^ v >> 27) * 0x94D049BB133111EB & mask
        return v ^ v >> 31
    keys = [mix(i * 0x9E3779B97F4A7C15 & mask, seed) for i in range(1, 7)]
    while True:
        left, right = divmod(x, b)
        for i, k in enumerate(keys):
            if i % 2 == 0:
                left = (left + mix(right, k) % a) % a
            else:
                right = (right + mix(left, k) % b) % b
        x = left * b + right
        if x < n:
            return x


def test_query_shard_and_slot(spark):
    """Against the scalar permutation of the row numbers in doc_id order."""
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_sharding"](spark, sf).collect()
    ids = sorted(d.doc_id for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())
    assert len(set(ids)) == len(ids) == len(rows)
    want = {i: divmod(scalar_position(k, len(ids), 42), 8)[::-1] for k, i in enumerate(ids)}
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == want
