"""WARC archives under Zstandard: a dictionary in a leading skippable frame, then one frame per record.

The writer deduplicates payloads: of equal ones the row with the largest id is a response, the others are revisits that
refer to it. The reader decodes frame by frame and checks versions, headers, lengths and digests; a damaged archive
raises.

Edge cases: an id column that isn't of whole numbers is refused; null payload is empty; a null id is written as an empty name and read back as null, and never is the largest
unless all ids are null; rows that repeat an id and payload are all responses if that id is the largest; an empty table
gives no archive; archive names are unique per task attempt and only those of finished attempts are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.session import Scratch

SKIPPABLE = 0x184D2A5D
ZSTD = 0xFD2FB528
READ = 1 << 20

RECORD = "id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit has no block; its payload's digest and length are in headers."""
    block = b"" if is_revisit else payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    uri = (url or "").encode().translate(None, b"\r\n")
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if is_revisit else b"response"),
        b"WARC-Record-ID: " + name(id).encode(),
        b"WARC-Target-URI: " + uri,
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: text/html; charset=utf-8",
        b"Content-Length: %d" % len(block),
    ]
    if is_revisit:
        lines += [b"WARC-Refers-To: " + name(refers_to).encode(), b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """The fields of RECORD from one record; raises ValueError if it isn't well formed."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line without a name")
        fields[key.strip().lower()] = value.strip().decode("utf-8", "replace")
    missing = [k for k in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length", b"warc-payload-digest") if k not in fields]
    if missing:
        raise ValueError(f"headers missing: {missing}")
    size = fields[b"content-length"]
    if not size.isdecimal() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block's length isn't that of Content-Length")
    kind, block = fields[b"warc-type"], rest[:-4]
    hashed = fields[b"warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if digest(block) != hashed:
            raise ValueError("the payload's digest differs")
        length = len(block)
    elif kind == "revisit":
        if b"warc-refers-to" not in fields or block:
            raise ValueError("a revisit needs a target and no block")
        length = int(fields.get(b"x-payload-length", "0"))
    else:
        raise ValueError(f"unexpected record type {kind}")
    number = lambda name: None if name == "<urn:page:>" else int(name.removeprefix("<urn:page:").removesuffix(">"))
    refers = number(fields[b"warc-refers-to"]) if kind == "revisit" else None
    return number(fields[b"warc-record-id"]), fields.get(b"warc-target-uri"), kind, length, hashed, refers, block


def train(samples: list[bytes], size: int = 1 << 15) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from sample records; None where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples) if len(samples) >= 16 else None
    except zstandard.ZstdError:
        return None


def read_archive(stream) -> Iterator[bytes]:
    """Records of an archive, one frame each, holding one record and one read buffer in memory."""
    head = stream.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    raw = stream.read(size)
    if len(raw) != size:
        raise ValueError("the dictionary is cut off")
    if len(raw) >= 4 and struct.unpack("<I", raw[:4])[0] == ZSTD:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    data = stream.read(READ)
    while data:
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("a frame is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(READ)
        yield b"".join(parts)
        data = data or stream.read(READ)


def write_archives(pages: DataFrame, folder: str, limit: int = 1 << 25, samples: int = 256) -> DataFrame:
    """Write columns id, url, payload, refers_to, is_revisit to archives of about ``limit`` payload bytes in ``folder``.

    Returns (path, records); only files that it names are whole. The dictionary comes from the first ``samples`` records
    of each archive, which are held back until it is trained.
    """

    def archives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, held, coder, written, count, path, done = None, [], None, 0, 0, "", []

        def begin():
            nonlocal out, coder, path, held, written
            book = train([r[:65536] for r in held])
            raw = zstandard.ZstdCompressor().compress(book.as_bytes()) if book else b""
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            out = store.open_output_stream(path)
            out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
            coder = zstandard.ZstdCompressor(level=3, dict_data=book)
            for r in held:
                out.write(coder.compress(r))
            held = []

        def finish():
            nonlocal out, written, count
            if held:
                begin()
            if out:
                out.close()
                done.append((path, count))
            out, written, count = None, 0, 0

        for frame in frames:
            for id, url, payload, refers_to, is_revisit in frame.itertuples(index=False, name=None):
                whole = record(None if pd.isna(id) else int(id), url, payload, None if pd.isna(refers_to) else int(refers_to), is_revisit)
                count, written = count + 1, written + len(whole)
                if out:
                    out.write(coder.compress(whole))
                else:
                    held.append(whole)
                    if len(held) >= samples or written >= limit:
                        begin()
                if written >= limit:
                    finish()
        finish()
        yield pd.DataFrame(done, columns=["path", "records"])

    rows = pages.select(F.col("id").cast("string"), "url", "payload", F.col("refers_to").cast("string"), "is_revisit")
    return rows.mapInPandas(archives, "path string, records long")


def read_archives(paths: DataFrame, folder: str) -> DataFrame:
    """RECORD rows of the archives named in column ``path``; raises where one is damaged or lacks records."""

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = arrow_fs.FileSystem.from_uri(folder)
        names = [n.strip() for n in RECORD.replace(" long", "").replace(" string", "").replace(" binary", "").split(",")]

        def table(rows):
            frame = pd.DataFrame(rows, columns=names)
            return frame.astype({"id": "Int64", "refers_to": "Int64"})

        for frame in frames:
            for path, expected in zip(frame["path"], frame["records"]):
                found, rows, held = 0, [], 0
                with store.open_input_stream(path) as stream:
                    for data in read_archive(stream):
                        rows.append(parse(data))
                        found, held = found + 1, held + len(data)
                        if held > READ * 4:
                            yield table(rows)
                            rows, held = [], 0
                if found != expected:
                    raise ValueError(f"{path}: {found} records, expected {expected}")
                if rows:
                    yield table(rows)

    return paths.mapInPandas(records, RECORD)


def archive(pages: DataFrame, scratch: Scratch, id: str = "page_id", url: str = "url", text: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write every page as a record under the scratch folder and read the archives back: RECORD rows.

    Payloads of at least ``least_bytes`` are deduplicated. The shuffles carry digests and ids, not pages, except for the
    join that tells each page its response. A payload of any number of copies is one row per map task there.
    """
    spark = pages.sparkSession
    if not isinstance(pages.schema[id].dataType, T.IntegralType):
        raise TypeError(f"{id} is {pages.schema[id].dataType.simpleString()}; record ids are whole numbers")
    rows = pages.select(
        F.col(id).alias("id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("payload")
    ).withColumn("key", F.concat(F.sha1("payload"), F.lit("-"), F.length("payload").cast("string")))
    largest = rows.select("key", "id").groupBy("key").agg(F.max("id").alias("response"), F.count("*").alias("copies"))
    first = largest.filter("copies > 1").select("key", "response")
    told = rows.join(first, "key", "left")
    again = F.coalesce(
        F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response")) & (F.length("payload") >= least_bytes), F.lit(False)
    )
    folder = f"{scratch.path}/warc"
    manifest = scratch.save(
        write_archives(
            told.select("id", "url", "payload", F.when(again, F.col("response")).alias("refers_to"), again.alias("is_revisit")), folder
        ),
        "warc-manifest",
    )
    tasks = max(1, min(spark.sparkContext.defaultParallelism * 4, manifest.count()))
    return read_archives(manifest.repartition(tasks), folder)
