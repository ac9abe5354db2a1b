"""Web archives: WARC/1.1 records in Zstandard files with a shared dictionary.

A file begins with a skippable frame that holds the dictionary; then comes one frame per record, so any
record can be read by itself. The reader loads the dictionary from that frame, decodes one frame
per record and checks version, mandatory headers, lengths and the payload digest; a damaged record
fails. Of records with equal payloads of at least ``revisit_from`` bytes the one with the smallest key
is a response, the others are revisits of it without a payload.

Tasks write files of about ``FILE_BYTES`` to a folder all executors share, through
``pyarrow.fs`` (any URI it knows), and return a manifest. Only files of a committed manifest are read, so what a
lost or repeated task left behind is never seen.

Defined cases: a null payload is empty; a null URL becomes an empty one, control characters in
it are percent-encoded. Rows that repeat the smallest key with the same payload are all responses. A row
without a key is a revisit where a keyed row has its payload, else a response; keys are integers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import drawn, materialise, text_of
from isotherm.sources.tables import scratch_path

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
FILE_BYTES, CHUNK = 64 << 20, 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, records long, payload_bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(key: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, *, revisit: bool) -> bytes:
    """The bytes of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if key is not None:
        head.append(f"X-Page-ID: {key}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, checked."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        headers[name.strip()] = value.strip()
    if missing := [n for n in NEEDED if n not in headers]:
        raise ValueError(f"headers missing: {missing}")
    length = headers["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"length {length} does not match a block of {len(rest) - 4} bytes")
    return headers, rest[:-4]


def read_record(raw: bytes) -> tuple:
    """One row of ``RECORD``; a revisit has the length and digest of the full payload it stands for."""
    headers, block = parse(raw)
    http, found, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^Content-Length:[ ]*([0-9]+)\r?$", http)
    if not found or not size:
        raise ValueError("no HTTP head in the block")
    kind, full = headers["WARC-Type"], int(size[1])
    digest = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != full or payload_digest(payload) != digest:
            raise ValueError("payload does not match its length or digest")
    elif kind != "revisit" or payload:
        raise ValueError(f"unexpected record {kind!r}")
    key, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return (
        None if key is None else int(key), headers.get("WARC-Target-URI"), kind, None if refers is None else int(refers),
        payload if kind == "response" else None, full, digest,
    )


def frames(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """Dictionary first, then one decoded record after the other."""
    start = read(8)
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    size = struct.unpack("<I", start[4:])[0]
    raw = read(size)
    if len(raw) != size:
        raise ValueError("dictionary cut short")
    if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    left = b""
    while True:
        data = left or read(CHUNK)
        if not data:
            return
        one, parts = decoder.decompressobj(), []
        while True:
            parts.append(one.decompress(data))
            if one.eof:
                left = one.unused_data
                break
            data = read(CHUNK)
            if not data:
                raise ValueError("frame cut short")
        yield b"".join(parts)


def dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A trained dictionary, or raw content where there is too little to train on."""
    if len(samples) >= 64:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size] or b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def plan(pages: DataFrame, *, key: str, url: str, payload: str, revisit_from: int) -> DataFrame:
    """Each page with the key of the response it revisits, if it does.

    Only payloads that occur more than once are joined back, one row for each.
    """
    body = text_of(F.col(payload)).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), body.alias("b"))
    rows = rows.withColumn("h", F.when(F.octet_length("b") >= revisit_from, F.sha2("b", 256)))
    copies = rows.filter("h IS NOT NULL").groupBy("h").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = rows.join(copies, "h", "left")
    return joined.select("k", "u", "b", F.when(~F.col("k").eqNullSafe(F.col("first")), F.col("first")).alias("r"))


def write(
    pages: DataFrame, folder: str | None = None, *, key: str = "page_id", url: str = "url", payload: str = "html",
    revisit_from: int = 0, samples: int = 1_000, sample_bytes: int = 16_384,
) -> DataFrame:
    """Write the archives and return their manifest. The dictionary is trained on at most
    ``samples`` payloads of at most ``sample_bytes`` bytes."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    body = text_of(F.col(payload))
    some = drawn(pages.select(body.alias("b")), samples, "b").filter(F.octet_length("b").between(1, sample_bytes)).collect()
    shared = spark.sparkContext.broadcast(dictionary([r.b.encode("utf-8", "surrogatepass") for r in some]))

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _filesystem(folder)
        raw = shared.value
        encoder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        out, path, done, records, size = None, "", [], 0, 0
        for batch in batches:
            for k, u, b, r in zip(batch["k"], batch["u"], batch["b"], batch["r"], strict=True):
                if out is None:
                    path, records, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(path)
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
                k = None if pd.isna(k) else int(k)
                revisit = not pd.isna(r)
                out.write(encoder.compress(record(k, u, b, int(r) if revisit else None, revisit=revisit)))
                records, size = records + 1, size + len(b)
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, records, size))
                    out = None
            if done:
                yield pd.DataFrame(done, columns=["path", "records", "payload_bytes"], dtype=object)
                done = []
        if out is not None:
            out.close()
            yield pd.DataFrame([(path, records, size)], columns=["path", "records", "payload_bytes"], dtype=object)

    rows = plan(pages, key=key, url=url, payload=payload, revisit_from=revisit_from)
    # keys beyond 2**53 must not pass through floating point where a batch has nulls
    rows = rows.withColumns({"k": F.col("k").cast("string"), "r": F.col("r").cast("string")})
    manifest = materialise(rows.mapInPandas(save, MANIFEST), "warc-manifest")
    return manifest.withColumn("folder", F.lit(folder))


def read(manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records of all archives in the manifest, columns ``RECORD``; one record in memory at a time."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for path, folder, records in zip(batch["path"], batch["folder"], batch["records"], strict=True):
                system, _ = _filesystem(folder)
                rows, n, held = [], 0, 0
                with system.open_input_stream(path) as file:
                    for raw in frames(file.read):
                        row, n, held = read_record(raw), n + 1, held + len(raw)
                        rows.append(row if payloads else (*row[:4], None, *row[5:]))
                        if held >= 4 << 20:
                            yield pd.DataFrame(rows, columns=names, dtype=object)
                            rows, held = [], 0
                if n != records:
                    raise ValueError(f"{path} has {n} records, the manifest says {records}")
                if rows:
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    files = max(1, manifest.count())
    spread = min(files, max(1, 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("path", "folder", "records").repartition(spread).mapInPandas(load, RECORD)
