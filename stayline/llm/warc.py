"""WARC archives of Zstandard frames: write, read back, validate.

An archive starts with a skippable frame that holds the dictionary; then each record is one frame of its
own, compressed with that dictionary. The reader takes nothing but the archive: it loads the dictionary
from the leading frame, decodes frame by frame and checks headers and lengths. Archives are rows of a
table (``archive`` binary), so that any storage Spark reads will do, or files (``save_archives``). One archive
holds a bounded number of payload bytes (and one record at least).

``read_files`` reads ``.warc.zst`` files of any writer: versions 1.0 and 1.1, all record types, names of any kind,
dictionaries that are compressed themselves or missing, values over several lines. A file is one row of Spark's
``binaryFile`` source, so it may have 2 GB at most.

Of records with equal payloads of at least ``least`` bytes the one with the smallest page id is a
response, the others are revisits that refer to it.

Defined results: a null payload is empty; null urls are left out of the header; a null id is larger than
any other and is written as an empty name. Rows with the same id and payload: the first of them may be
the response, the others revisit it. An empty table gives no archive. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import apart, null_to_empty, pick, slices, staged

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
VERSIONS = ("WARC/1.0", "WARC/1.1")
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
NEEDED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
DIGESTS = ("md5", "sha1", "sha256", "sha384", "sha512")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

#: The dictionary is trained on so many records at most, and has so many bytes at most.
SAMPLE_RECORDS, DICTIONARY_BYTES = 200, 1 << 15
#: Payload bytes in one archive, unless a single record is longer.
ARCHIVE_BYTES = 4 << 20
LEAST_REVISIT = 100

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class Broken(ValueError):
    """An archive that doesn't keep to the format."""


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, length: int, payload: bytes) -> bytes:
    name = "" if page_id is None else str(page_id)
    body = payload if kind == "response" else b""
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {length}",
        f"WARC-Block-Digest: sha1:{sha1}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"] if kind == "revisit" else []),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def archive(records: list[bytes], dictionary: bytes) -> bytes:
    """A skippable frame with the dictionary, then one frame per record."""
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if known:
        known.precompute_compress(level=3)
    pack = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(dictionary)), dictionary, *map(pack.compress, records)])


def dictionary_of(data: memoryview) -> tuple[bytes, int]:
    """The dictionary in the leading skippable frame (compressed itself or not; none without such a frame), and its end."""
    if len(data) < 8:
        raise Broken("no leading frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        return b"", 0
    if 8 + size > len(data):
        raise Broken("the leading frame is cut off")
    held = bytes(data[8 : 8 + size])
    if held[:4] == FRAME:
        try:
            held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
        except zstandard.ZstdError as e:
            raise Broken(f"dictionary: {e}") from e
    return held, 8 + size


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, frame by frame. Skippable frames between them are left out."""
    rest = memoryview(data)
    dictionary, end = dictionary_of(rest)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    rest = rest[end:]
    while len(rest):
        if len(rest) >= 8 and struct.unpack_from("<I", rest)[0] & ~0xF == SKIPPABLE & ~0xF:
            rest = rest[8 + struct.unpack_from("<I", rest, 4)[0] :]
            continue
        frame = unpack.decompressobj()
        try:
            out = frame.decompress(rest)
        except zstandard.ZstdError as e:
            raise Broken(str(e)) from e
        if not frame.eof:
            raise Broken("the last frame is cut off")
        yield out
        rest = rest[len(rest) - len(frame.unused_data) :]


def matches(digest: str, data: bytes) -> bool | None:
    """Whether a labelled digest (``sha1:`` in base 32 or hexadecimal, and so on) is that of the data; None if it can't be told."""
    kind, colon, value = digest.partition(":")
    kind = kind.lower().replace("-", "")
    if not colon or kind not in DIGESTS:
        return None
    found = hashlib.new(kind, data).digest()
    if len(value) == 2 * len(found):
        return value.lower() == found.hex()
    return value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def standard(data: bytes) -> dict:
    """A record by the standard, versions 1.0 and 1.1 and all types: version, fields (name and value, in order) and block.

    Raises Broken unless the named fields are there, the block has the length of the header and its digest is right.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in VERSIONS:
        raise Broken("no WARC header")
    fields: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and fields:
            # A long value goes on in lines that begin with white space.
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
            continue
        key, colon, value = line.partition(":")
        if not colon or not key:
            raise Broken(f"header line {line!r}")
        fields.append((key, value.strip()))
    names = [key.lower() for key, _ in fields]
    # Only this field may be there more than once.
    twice = {n for n in names if names.count(n) > 1} - {"warc-concurrent-to"}
    missing = NEEDED - set(names)
    if missing or twice:
        raise Broken(f"missing {sorted(missing)}, more than once {sorted(twice)}")
    of = dict(zip(names, (v for _, v in fields), strict=True))
    if of["warc-type"] not in TYPES or not re.fullmatch(r"<[^<>\s]+>", of["warc-record-id"]):
        raise Broken(f"type {of['warc-type']!r}, record {of['warc-record-id']!r}")
    length = of["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Broken("the length isn't that of the header")
    block = rest[:-4]
    if matches(of.get("warc-block-digest", ""), block) is False:
        raise Broken("block digest")
    return {"version": lines[0], "fields": fields, "of": of, "block": block}


def payload_of(of: dict[str, str], block: bytes) -> bytes | None:
    """What a record holds without the protocol's header; None for types that hold no payload, as revisits."""
    if of["warc-type"] not in ("response", "request", "resource", "conversion"):
        return None
    if of.get("content-type", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def parse(data: bytes) -> dict:
    """A record of a page as ``record`` writes it; raises Broken unless all of it is in order."""
    found = standard(data)
    fields, body = found["of"], found["block"]
    missing = {"warc-payload-digest", "warc-payload-length", "warc-block-digest"} - fields.keys()
    kind = fields["warc-type"]
    if missing or kind not in ("response", "revisit"):
        raise Broken(f"missing {sorted(missing)}, type {kind}")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(body).hexdigest() != digest or fields["warc-payload-length"] != fields["content-length"]):
        raise Broken("payload digest")
    if (kind == "revisit") != ("warc-refers-to" in fields):
        raise Broken("a revisit refers to a response, and nothing else does")

    def page(value: str) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d*)>", value)
        if not m:
            raise Broken(f"record name {value!r}")
        return int(m[1]) if m[1] else None

    return {
        "page_id": page(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": kind,
        "refers_to": page(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_bytes": int(fields["warc-payload-length"]),
        "payload_digest": digest,
        "payload": body if kind == "response" else None,
    }


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from sample records; none if there are too few to learn from."""
    if len(samples) < 8 or sum(map(len, samples)) < 4 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with digest, size, record type and the response they refer to, written to the shared folder."""
    source = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", null_to_empty(F.col("html")))
    full = source.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    # The row with the smallest id, nulls last; rows alike in id and payload are told apart by their number.
    rows = staged(full.withColumn("row", F.monotonically_increasing_id()))
    key = F.struct(F.isnull("page_id").alias("none"), F.col("page_id").alias("id"), F.col("row").alias("row"))
    firsts = (
        rows.filter(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
        .filter("n > 1")
        .select("digest", F.col("first.id").alias("response"), F.col("first.row").alias("first_row"))
    )
    revisits = (F.col("size") >= least) & F.coalesce(F.col("row") != F.col("first_row"), F.lit(False))
    return rows.join(apart(firsts), "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        "size",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("response")).alias("refers_to"),
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All pages as a table of archives in the shared folder, with one trained dictionary."""
    linked = with_revisits(pages, id_col, url_col, html_col)
    # A bounded sample trains the dictionary; it changes the size of the archives, never their records.
    some = pick(pages, html=html_col).filter("html is not null").limit(SAMPLE_RECORDS).select(F.substring("html", 1, DICTIONARY_BYTES))
    return staged(write_archives(linked, train([row[0].encode() for row in some.collect()])))


def write_archives(pages: DataFrame, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows (archive binary) of archives with one record per row of ``pages`` as prepared above."""
    schema = pa.schema([("archive", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "html", archive_bytes):
            for row in batch.to_pylist():
                payload = row["html"].encode()
                held.append(record(row["page_id"], row["url"], row["record_type"], row["refers_to"], row["digest"], row["size"], payload))
                size += len(payload)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([archive(held, dictionary)], pa.binary())], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([archive(held, dictionary)], pa.binary())], schema=schema)

    return pages.mapInArrow(write, "archive binary")


def read_archives(archives: DataFrame, column: str = "archive") -> DataFrame:
    """One row per record of every archive; a broken archive is an error."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_pylist([parse(x) for x in frames(data.as_py())], schema=schema)

    return pick(archives, archive=column).filter("archive is not null").mapInArrow(read, RECORD)


STANDARD = (
    "file string, place long, version string, record_id string, record_type string, date string, target_uri string, "
    "refers_to string, content_type string, fields array<struct<name:string,value:string>>, block_bytes long, block_ok boolean, "
    "payload_ok boolean, payload binary"
)


def read_files(spark: SparkSession, path: str, pattern: str = "*.warc.zst") -> DataFrame:
    """One row per record of all archive files under a path (columns of STANDARD); a broken archive is an error.

    ``block_ok``, ``payload_ok``: whether the digests are right, null where there is none or of an unknown kind (and for
    payloads that the protocol encodes). ``payload`` is the block without the protocol's header, null for types without one.
    """
    named = {"record_id": "warc-record-id", "record_type": "warc-type", "date": "warc-date", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "content_type": "content-type"}
    pair = pa.struct([("name", pa.string()), ("value", pa.string())])
    kinds = {"place": pa.int64(), "fields": pa.list_(pair), "block_bytes": pa.int64(), "block_ok": pa.bool_(), "payload_ok": pa.bool_(), "payload": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds.get(c.split()[0], pa.string())) for c in STANDARD.split(", ")])

    def rows(file: str, data: bytes) -> Iterator[dict]:
        for place, raw in enumerate(frames(data)):
            found = standard(raw)
            of, block = found["of"], found["block"]
            payload = payload_of(of, block)
            encoded = payload is not block and b"transfer-encoding" in block.partition(b"\r\n\r\n")[0].lower()
            told = payload is not None and not encoded and "warc-payload-digest" in of
            row = {"file": file, "place": place, "version": found["version"], **{c: of.get(name) for c, name in named.items()}}
            row |= {"fields": [{"name": k, "value": v} for k, v in found["fields"]], "block_bytes": len(block)}
            row |= {"block_ok": matches(of.get("warc-block-digest", ""), block), "payload": payload}
            yield row | {"payload_ok": matches(of["warc-payload-digest"], payload) if told else None}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path"), batch.column("content"), strict=True):
                held, size = [], 0
                for row in rows(file.as_py(), data.as_py()):
                    held.append(row)
                    size += row["block_bytes"]
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.filter("length > 0").select("path", "content").mapInArrow(read, STANDARD)


def save_archives(archives: DataFrame, folder: str, column: str = "archive") -> DataFrame:
    """Write each archive as a file of a folder (a path or an address that Arrow knows); returns file and bytes.

    A file is named after its task and its place there and appears when it is whole, so a task that runs again
    writes the same files.
    """
    from pyarrow import fs

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        task, attempt, n = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        for batch in batches:
            names, sizes = [], []
            for data in batch.column(0):
                name = f"{root}/archive-{task:06d}-{n:06d}.warc.zst"
                with store.open_output_stream(f"{root}/_{task:06d}-{n:06d}-{attempt}") as out:
                    out.write(data.as_buffer())
                store.move(f"{root}/_{task:06d}-{n:06d}-{attempt}", name)
                names.append(name)
                sizes.append(len(data.as_buffer()))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file", "bytes"])

    return staged(pick(archives, archive=column).filter("archive is not null").mapInArrow(save, "file string, bytes long"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages into archives in the shared folder and read the records back."""
    return read_archives(archived(pages, id_col, url_col, html_col))
