"""Archives of other writers, made by hand after the standard."""

import base64
import hashlib
import struct

import pytest
import zstandard

from stayline.llm import warc

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>caf\xc3\xa9</p>"


def made(kind, block, version="WARC/1.0", name="<urn:uuid:6d3a6b0e-5f0b-4c62-9a7e-3f4c3c0c8f11>", **more):
    lines = [version, f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 2020-02-03T04:05:06Z"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


RECORDS = [
    made("warcinfo", b"software: some crawler\r\n", Content_Type="application/warc-fields", WARC_Filename="a.warc.zst"),
    made("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", Content_Type="application/http; msgtype=request", WARC_Concurrent_To="<urn:uuid:1>", warc_concurrent_to="<urn:uuid:2>"),
    made("response", HTTP, "WARC/1.1", WARC_Target_URI="http://a/", Content_Type="application/http; msgtype=response", WARC_Block_Digest=sha1(HTTP), WARC_Payload_Digest=sha1(HTTP.split(b"\r\n\r\n")[1])),
    made("resource", b"abc", WARC_Target_URI="file:///a\r\n b", Content_Type="text/plain", WARC_Block_Digest="sha256:" + hashlib.sha256(b"abc").hexdigest(), WARC_Payload_Digest="sha1:" + hashlib.sha1(b"abd").hexdigest()),
    made("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC/1.1", WARC_Refers_To="<urn:uuid:9>", WARC_Profile="p", WARC_Payload_Digest="sha1:ABC", Content_Type="application/http"),
    made("metadata", b"", WARC_Block_Digest="tiger:xyz"),
    made("conversion", b"text", Content_Type="text/plain"),
    made("continuation", b"rest", WARC_Segment_Number="2"),
]


def packed(records, dictionary=b"", compressed=False):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    pack = zstandard.ZstdCompressor(dict_data=known)
    held = zstandard.ZstdCompressor().compress(dictionary) if compressed else dictionary
    head = struct.pack("<II", warc.SKIPPABLE, len(held)) + held if dictionary else b""
    # Readers pass over skippable frames.
    return head + struct.pack("<II", 0x184D2A50, 3) + b"xyz" + b"".join(map(pack.compress, records))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    dictionary = warc.train([r * 3 + bytes([k]) * 40 for k, r in enumerate(RECORDS * 10)], 2048)
    assert dictionary
    (root / "deep").mkdir()
    (root / "plain.warc.zst").write_bytes(packed(RECORDS))
    (root / "dict.warc.zst").write_bytes(packed(RECORDS, dictionary))
    (root / "deep" / "packed.warc.zst").write_bytes(packed(RECORDS, dictionary, True))
    (root / "empty.warc.zst").write_bytes(b"")
    (root / "other.txt").write_bytes(b"no archive")
    return root


def test_standard_archives(spark, folder):
    rows = warc.read_files(spark, str(folder)).collect()
    assert len(rows) == 3 * len(RECORDS)
    for name in ("plain", "dict", "packed"):
        found = sorted((r for r in rows if f"{name}.warc.zst" in r.file), key=lambda r: r.place)
        assert [r.record_type for r in found] == ["warcinfo", "request", "response", "resource", "revisit", "metadata", "conversion", "continuation"]
        assert [r.version for r in found] == [x[:8].decode() for x in RECORDS]
        assert {r.record_id for r in found} == {"<urn:uuid:6d3a6b0e-5f0b-4c62-9a7e-3f4c3c0c8f11>"}
        response, resource = found[2], found[3]
        assert bytes(response.payload) == "<p>café</p>".encode() and response.block_ok and response.payload_ok
        assert bytes(resource.payload) == b"abc" and resource.block_ok and resource.payload_ok is False
        assert resource.target_uri == "file:///a b" and found[4].refers_to == "<urn:uuid:9>" and found[4].payload is None
        assert found[5].block_ok is None and found[5].block_bytes == 0
        assert [f.value for f in found[1].fields if f.name.lower() == "warc-concurrent-to"] == ["<urn:uuid:1>", "<urn:uuid:2>"]


@pytest.mark.parametrize(
    "record",
    [
        made("response", b"abc", "WARC/2.0"),
        made("letter", b"abc"),
        made("resource", b"abc", name="urn:uuid:1"),
        made("resource", b"abc", WARC_Block_Digest=sha1(b"abd")),
        made("resource", b"abc", WARC_Type="resource"),
        made("resource", b"abc")[:-2],
        made("resource", b"abc").replace(b"WARC-Date", b"WARC-Data"),
        b"no header",
    ],
)
def test_broken_records(record):
    with pytest.raises(warc.Broken):
        warc.standard(record)


def test_broken_archives():
    whole = packed(RECORDS)
    for data in (b"abc", whole[:-3], struct.pack("<II", warc.SKIPPABLE, 99) + b"x"):
        with pytest.raises(warc.Broken):
            list(warc.frames(data))


def test_own_archives_as_files(spark, tmp_path):
    text = "<html>" + "é" * 200
    pages = spark.createDataFrame([(k, f"http://a/{k}", text if k % 3 else f"page {k}") for k in range(40)], "page_id long, url string, html string")
    saved = warc.save_archives(warc.archived(pages.repartition(3)), str(tmp_path / "out")).collect()
    assert saved and all(r.bytes > 0 for r in saved)
    rows = warc.read_files(spark, str(tmp_path / "out")).collect()
    assert sorted(r.record_id for r in rows) == sorted(f"<urn:page:{k}>" for k in range(40))
    assert all(r.block_ok for r in rows) and sum(r.record_type == "revisit" for r in rows) == 25
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {text, *(f"page {k}" for k in range(0, 40, 3))}
