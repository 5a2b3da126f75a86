import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from streamlens.llm import sentencepiece_bpe as S
from streamlens.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return S.Model(PATH)


def _texts(seed, n):
    rnd = random.Random(seed)
    pieces = [LIB.id_to_piece(i) for i in range(3, LIB.vocab_size())]
    for _ in range(n):
        kind = rnd.randrange(5)
        if kind == 0:
            yield "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))
        elif kind == 1:
            yield "".join(rnd.choice("ab \n\t.1▁e tsin<>\x00") for _ in range(rnd.randint(0, 60)))
        elif kind == 2:
            yield " " * rnd.randint(0, 70) + rnd.choice(["", "x", "the", " \n"]) + " " * rnd.randint(0, 40)
        elif kind == 3:
            yield "".join(chr(rnd.choice([rnd.randint(1, 0x2fff), rnd.randint(0x4e00, 0x9fff),
                                          rnd.randint(0x10000, 0x10ffff)])) for _ in range(rnd.randint(0, 20)))
        else:
            yield rnd.choice(["a", "=", "-", "1", "ha", "\n", "é", "日"]) * rnd.randint(0, 200)


def test_ids_equal_the_library(model):
    texts = list(_texts(5, 3000)) + ["x" * 20_000, "<s> </s> <unk> <0x41>", "▁▁ ▁", " "]
    ids, off = model.encode(pa.array([*texts, None, ""]))
    for t, s, e in zip(texts, off[:-1], off[1:]):
        assert ids[s:e].tolist() == LIB.encode(t), t[:60]
    assert off[-1] == off[-2] == off[-3]


def test_state_that_is_dropped_changes_no_id(model, monkeypatch):
    texts = list(_texts(6, 300))
    want = [LIB.encode(t) for t in texts]
    monkeypatch.setattr(S, "KNOWN_BYTES", 100)
    monkeypatch.setattr(S, "MAX_PAIRS", 5)
    fresh = S.Model(PATH)
    for s in range(0, len(texts), 10):
        ids, off = fresh.encode(pa.array(texts[s:s + 10]))
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want[s:s + 10]


def test_columns_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, "k", 5), (1, None, "k", 5), (2, "", "k", 6), (3, "a  b日\U0001f600", "k", None)],
                                 "doc_id int, text string, `__id` string, ids int")
    out = S.encode(rows, PATH, decoded_col="back").orderBy("doc_id").collect()
    assert out[0].__fields__ == ["doc_id", "text", "__id", "ids", "back"] and len(out) == 4
    assert [r.ids for r in out[:3]] == [[], [], []] and [r.back for r in out[:3]] == ["", "", ""]
    assert out[3].ids == LIB.encode("a  b日\U0001f600") and out[3].back == "a  b日\U0001f600"
    back = S.decode(S.encode(rows, PATH), PATH, text_col="back").orderBy("doc_id").collect()
    assert [r.back for r in back] == [r.back for r in out]
    over = S.encode(rows, PATH, ids_col="TEXT").orderBy("doc_id").collect()
    assert over[3]["TEXT"] == out[3].ids and "text" not in over[3].__fields__
    assert S.encode(rows.limit(0), PATH).collect() == []
    invalid = spark.createDataFrame([([243, 147, 29142],), (None,)], "ids array<int>")
    assert [r.text for r in S.decode(invalid, PATH).collect()] == [LIB.decode([243, 147, 29142]), None]


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_sentencepiece"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIB.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
