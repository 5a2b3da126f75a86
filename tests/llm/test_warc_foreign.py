"""Packages as other tools write them: built here with zipfile and gzip by hand."""
import base64
import gzip
import hashlib
import json
import zipfile

import pytest
from streamlens.llm import warc

BODY = b"<html>" + b"x" * 50 + b"</html>"
SHA = hashlib.sha1(BODY).hexdigest()
B32 = base64.b32encode(bytes.fromhex(SHA)).decode()


def record(kind, block=b"", packed=True, **fields):
    head = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:uuid:0>", b"Content-Length: %d" % len(block)]
    head += [f"{k.replace('_', '-')}: {v}".encode("latin-1") for k, v in fields.items()]
    raw = b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw) if packed else raw


def http(body, *headers):
    return b"\r\n".join([b"HTTP/1.1 200 OK", *headers]) + b"\r\n\r\n" + body


def chunked(body):
    return b"5;a=b\r\n" + body[:5] + b"\r\n" + b"%X\r\n" % len(body[5:]) + body[5:] + b"\r\n0\r\n\r\n"


RECORDS = [
    record("warcinfo", b"software: x\r\n\r\n"),
    record("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Target_URI="http://a/"),
    record("response", http(chunked(BODY), b"Transfer-Encoding: chunked"), WARC_Target_URI="http://a/1"),
    record("response", http(BODY, b"Content-Length: 999"), WARC_Target_URI="http://a/2", WARC_Payload_Digest="sha1:" + B32),
    record("response", http(BODY), packed=False, WARC_Target_URI="http://a/\xe9", WARC_Payload_Digest="sha256:00"),
    record("response", http(b"plain", b"Transfer-Encoding: chunked"), WARC_Target_URI="http://a/4"),
    record("revisit", b"", WARC_Target_URI="http://a/5", WARC_Payload_Digest="sha1:" + B32, WARC_Refers_To="<urn:uuid:7>"),
    record("revisit", http(b"", b"Content-Length: 62"), WARC_Target_URI="http://a/6"),
    record("response", b"", WARC_Target_URI="dns:a"),
]
WANT = [("warcinfo", None, None, None, None), ("request", "http://a/", None, None, None),
        ("response", "http://a/1", SHA, len(BODY), BODY), ("response", "http://a/2", SHA, len(BODY), BODY),
        ("response", "http://a/\xe9", SHA, len(BODY), BODY),
        ("response", "http://a/4", hashlib.sha1(b"plain").hexdigest(), 5, b"plain"),
        ("revisit", "http://a/5", SHA, None, None), ("revisit", "http://a/6", None, 62, None),
        ("response", "dns:a", hashlib.sha1(b"").hexdigest(), 0, b"")]


def lines(style, offset=0):
    at, out = 0, []
    for r in RECORDS:
        if style == "text":
            out.append("a {b},) {2024 " + json.dumps({"url": "http://a/{x}", "offset": str(at), "length": str(len(r)), "filename": "rec.warc.gz"}))
        elif style == "number":
            out.append("a,) 2024 " + json.dumps({"offset": at, "length": len(r), "filename": "archive/rec.warc.gz", "more": {"a": {}}}))
        else:
            out.append(f"a 2024 http://a text/html 200 {B32} - - {len(r)} {at} rec.warc.gz")
        at += len(r)
    head = [" CDX N b a m s k r M S V g"] if style == "cdx" else ["!meta {\"offset\": 5}"]
    return "\n".join(head + out) + "\n"


def package(path, indexes, data=b"".join(RECORDS), name="archive/rec.warc.gz", how=zipfile.ZIP_STORED):
    with zipfile.ZipFile(path, "w", how) as z:
        z.writestr("archive/", "")
        z.writestr(name, data)
        for n, content in indexes.items():
            z.writestr("indexes/" + n, content)
        z.comment = b"by hand"
    return str(path)


@pytest.mark.parametrize("indexes", [
    {"index.cdxj": lines("text")}, {"index.cdx.gz": gzip.compress(lines("number").encode())}, {"index.cdx": lines("cdx")},
    {"index.cdxj": lines("text").replace("\n", "\r\n"), "copy.cdx.gz": gzip.compress(lines("cdx").encode()),
     "index.idx": 'a,) 2024 {"offset": 0, "length": 9, "filename": "index.cdx.gz"}\n'}])
def test_standard_layouts(spark, tmp_path, indexes):
    path = package(tmp_path / "a.wacz", indexes)
    rows = warc.read_packages(spark, spark.createDataFrame([(path,)], "path string"), block_bytes=300).collect()
    got = [(r.record_type, r.url, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=str) == sorted(WANT, key=str)
    assert {r.refers_to for r in rows} == {None, "urn:uuid:7"} and {r.page_id for r in rows} == {None}


def test_refused_packages(tmp_path):
    def ranges(path):
        with open(path, "rb") as f:
            return warc.record_ranges(f, len(open(path, "rb").read()))
    outside = 'a {"offset": 10, "length": 99999999, "filename": "rec.warc.gz"}\n'
    other = 'a {"offset": 0, "length": 9, "filename": "gone.warc.gz"}\n'
    for i, x in enumerate((outside, other)):
        with pytest.raises(ValueError):
            ranges(package(tmp_path / f"{i}.wacz", {"index.cdxj": x}))
    with pytest.raises(ValueError):
        ranges(package(tmp_path / "c.wacz", {"index.cdxj": lines("text")}, how=zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError):
        warc.decode_record(b"no record")
    assert ranges(package(tmp_path / "e.wacz", {"index.cdxj": ""})) == []
