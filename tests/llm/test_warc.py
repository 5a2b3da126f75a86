import hashlib
import io
import random
import zipfile

import pytest
from streamlens.llm import warc
from streamlens.llm.queries import QUERIES
from streamlens.sources.files import filesystem


def _zip(members, **kw):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, **kw) as z:
        for name, data, big in members:
            with z.open(name, "w", force_zip64=big) as f:
                f.write(data)
    return out


@pytest.mark.parametrize("limit", [None, 10])
def test_directories(monkeypatch, limit):
    """ZIP and (with a limit low enough to force every 64-bit field) ZIP64."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    members = [("archive/data.warc.gz", b"x" * 50, True), ("é.txt", b"yy", False), ("indexes/i.cdxj", b"", True)]
    f = _zip(members)
    data = f.getvalue()
    got = warc.zip_members(f, len(data))
    assert list(got) == [m[0] for m in members]
    for name, body, _ in members:
        method, at, size = got[name]
        assert method == 0 and data[at:at + size] == body
    if limit:
        assert b"PK\x06\x06" in data and b"PK\x06\x07" in data


def test_comment_and_rubbish():
    f = _zip([("a", b"1", False)])
    with zipfile.ZipFile(f, "a") as z:
        z.comment = b"PK\x05\x06 in a comment" * 20
    assert list(warc.zip_members(f, len(f.getvalue()))) == ["a"]
    for bad in (b"", b"no zip at all", b"PK\x05\x06" + b"\0" * 3):
        with pytest.raises(ValueError):
            warc.zip_members(io.BytesIO(bad), len(bad))


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"x" * 100)
    with pytest.raises(ValueError):
        warc.record_ranges(out, len(out.getvalue()))


@pytest.mark.parametrize("payload", [b"", b"<html>\r\n\r\n</html>", "é".encode() * 3000])
def test_record_round_trip(payload):
    r = warc.decode_record(warc.encode_record("7", "http://a/\r\nb {x}", payload, None, "2024-01-01T00:00:00Z"))
    assert (r["page_id"], r["record_type"], r["payload"], r["refers_to"]) == ("7", "response", payload, None)
    assert r["payload_digest"] == hashlib.sha1(payload).hexdigest() and "\n" not in r["url"]
    r = warc.decode_record(warc.encode_record(None, None, payload, "9", "2024-01-01T00:00:00Z"))
    assert (r["page_id"], r["url"], r["record_type"], r["refers_to"], r["payload"], r["payload_bytes"]) == \
        (None, None, "revisit", "9", None, len(payload))


def expected(rows, least):
    best = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            best[b] = max(best.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        win = best.get(b)
        refers = win if win is not None and win != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_packages_round_trip(spark):
    rng = random.Random(1)
    texts = ["", None, "short", "x" * 999, "y" * 1000, "é" * 500, "".join(rng.choices("abc ", k=30_000))]
    rows = [(i, rng.choice([None, "http://a/", "http://b {\"offset\": 1}\n\x85"]), rng.choice(texts)) for i in range(300)]
    rows += [(None, None, "y" * 1000), (5, "http://again", "y" * 1000), (5, "http://again", "y" * 1000), (None, None, "z" * 2000),
             (None, None, "z" * 2000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    packages = warc.write_packages(df, package_bytes=3000)
    assert packages.count() > 3 and packages.agg({"records": "sum"}).first()[0] == len(rows)
    back = warc.read_packages(spark, packages, block_bytes=2000).collect()
    got = [(None if r.page_id is None else int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
            None if r.refers_to is None else int(r.refers_to)) for r in back]
    assert sorted(got, key=str) == expected(rows, 1000)
    for r in back:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest
    fs, path = filesystem(packages.first().path)
    with fs.open_input_file(path) as f:  # other readers agree
        assert zipfile.ZipFile(io.BytesIO(f.read())).testzip() is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_packages(spark, warc.write_packages(df)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op3_warc"](spark, sf).collect()), key=str) == expected(rows, 1000)
