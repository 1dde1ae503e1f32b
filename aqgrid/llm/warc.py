"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC records, and a skippable frame at the end with
the seek table of the public seekable format: compressed and decompressed size of every frame, their number, a magic
number. ``zstd -d`` reads such a file as usual. The index maps each record to its bundle, frame and offset within the
decompressed frame, so that one record costs one range read and one small frame.

Of records with equal payloads of at least ``least`` bytes, that with the largest id is the response and the others are
revisits of it, without a payload. Payloads are equal if their SHA-256 is; the SHA-1 that the format asks for is written
only. Only digests are grouped; payloads move once, to meet the verdict of their digest, in a join that Spark may split
where one payload is frequent. Shorter payloads are dealt by their id there, so that empty pages don't meet.

Bundles are written by the tasks to a shared folder through ``pyarrow.fs`` (any uri that it opens), under a name of their
own attempt; what the committed index names is valid, what a lost attempt left is never read. They are read back in groups of
``GROUP`` frames, dealt over as many tasks as their number asks for. A task holds one frame.

Nulls: a null payload is empty, a null url is left out of the headers, a row with a null id is always a response. Repeated
rows each become a record; if their id is the largest of their payload, each is a response. Extra columns are not read.
An empty table gives no bundles and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqgrid.llm.common import fresh_dir, written

# The public seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
#: Frames that are read in a row, and such groups for each reading task.
GROUP, GROUPS_A_TASK = 16, 4
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame int, offset int, length int"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class BundleWriter:
    def __init__(self, uri: str, level: int = 3):
        self.fs, self.path = file_system(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path, compression=None)  # the name must not decide
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.held = 0
        self.size = 0

    def put(self, record: bytes) -> tuple[int, int]:
        """Add a record; gives its frame and its offset there."""
        at = len(self.frames), self.held
        self.parts.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self._flush()
        return at

    def _flush(self) -> None:
        if self.parts:
            data = self.zstd.compress(b"".join(self.parts))
            self.out.write(data)
            self.frames.append((len(data), self.held))
            self.size += len(data)
            self.parts, self.held = [], 0

    def close(self) -> None:
        self._flush()
        entries = b"".join(struct.pack("<II", c, d) for c, d in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        width = 12 if descriptor & 0x80 else 8
        table = self.file.read_at(n * width, size - 9 - n * width)
        self.frames, at = [], 0
        for k in range(n):
            c, d = struct.unpack_from("<II", table, k * width)
            self.frames.append((at, c, d))
            at += c
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        at, c, d = self.frames[k]
        return self.zstd.decompress(self.file.read_at(c, at), max_output_size=d)

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]

    def records(self) -> Iterator[bytes]:
        for k in range(len(self.frames)):
            yield from cut_records(self.frame(k))

    def close(self) -> None:
        self.file.close()


def _line(v: str) -> str:
    return re.sub(r"[\r\n]+", " ", v)


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    body = http + payload if refers_to is None else http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def cut_records(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        size = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", data[at:head])[1])
        yield data[at : head + size + 4]
        at = head + size + 4


def parse_record(record: bytes) -> dict:
    """Headers (lower-cased names), the HTTP content length, and the payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    return fields | {"payload": payload, "payload_bytes": int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])}


def _id_of(text: str) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)>", text)
    return int(m[1]) if m else None


def verdicts(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", least: int = 1000) -> DataFrame:
    """For each payload of at least ``least`` bytes that occurs with two ids or more: its digest and the largest id."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    d = pages.where(F.octet_length(payload) >= least).where(F.col(id_col).isNotNull())
    d = d.groupBy(F.unhex(F.sha2(payload, 256)).alias("digest")).agg(F.max(id_col).alias("keeper"), F.min(id_col).alias("lowest"))
    return d.where("lowest < keeper").select("digest", "keeper")


def write_archive(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000, date: str = "1970-01-01T00:00:00Z", level: int = 3
) -> DataFrame:
    """Write bundles below ``folder``; gives the committed index (page_id, bundle, frame, offset, length)."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    own = F.unhex(F.hex(F.xxhash64(id_col, url_col)))  # eight bytes, which no digest has
    digest = F.when(F.octet_length(payload) >= least, F.unhex(F.sha2(payload, 256))).otherwise(own)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), digest.alias("digest"))
    rows = rows.join(verdicts(pages, id_col=id_col, html_col=html_col, least=least), "digest", "left")
    refers = F.when((F.octet_length("payload") >= least) & (F.col("page_id") < F.col("keeper")), F.col("keeper"))
    rows = rows.select("page_id", "url", "payload", refers.alias("refers_to"))

    def write(batches: Iterator) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        name, n, out = f"{folder}/bundle-{task.partitionId():06d}-{task.taskAttemptId()}", 0, None
        for batch in batches:
            index = []
            for p, u, data, ref in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "refers_to")], strict=True):
                if out is None:
                    uri = f"{name}-{n:04d}.warc.zst"
                    out, n = BundleWriter(uri, level), n + 1
                record = build_record(p.as_py(), u.as_py(), data.as_py(), ref.as_py(), date)
                frame, offset = out.put(record)
                index.append((p.as_py(), uri, frame, offset, len(record)))
                if out.size >= BUNDLE_BYTES:
                    out.close()
                    out = None
            if index:
                yield _arrow(index)
        if out is not None:
            out.close()

    return written(rows.mapInArrow(write, INDEX), "warc-index")


def _arrow(index: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), kinds, strict=True)], names=["page_id", "bundle", "frame", "offset", "length"])


def read_archive(index: DataFrame, *, payloads: bool = False) -> DataFrame:
    """Every record of the bundles that the index names, frame by frame; a payload that doesn't match its digest raises.

    Rows: page_id, url, payload_bytes, payload_digest (hexadecimal), record_type, refers_to and, if asked for, payload
    (null for revisits). A task reads some groups of frames and holds one frame at a time.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uri, part in zip(pdf["bundle"], pdf["part"], strict=True):
                reader = BundleReader(uri)
                for k in range(part * GROUP, min((part + 1) * GROUP, len(reader.frames))):
                    yield pd.DataFrame([_row(r, payloads) for r in cut_records(reader.frame(k))], columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                reader.close()

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    parts = index.select("bundle", F.floor(F.col("frame") / GROUP).alias("part")).distinct()
    tasks = -(-parts.count() // GROUPS_A_TASK)  # told to Spark, which would coalesce such few and short rows
    return parts.repartition(max(1, tasks), "bundle", "part").mapInPandas(read, schema)


def _row(record: bytes, payloads: bool) -> tuple:
    r = parse_record(record)
    said = base64.b32decode(r["warc-payload-digest"].removeprefix("sha1:")).hex()
    response = r["warc-type"] == "response"
    if response and (hashlib.sha1(r["payload"]).hexdigest() != said or len(r["payload"]) != r["payload_bytes"]):
        raise ValueError(f"{r['warc-record-id']} is damaged")
    refers = None if response else _id_of(r["warc-refers-to"])
    row = (_id_of(r["warc-record-id"]), r.get("warc-target-uri"), r["payload_bytes"], said, r["warc-type"], refers)
    return (*row, r["payload"] if response else None) if payloads else row


def fetch(index: DataFrame, ids: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records of some ids by seeking: (page_id, record binary), one frame read for each."""
    wanted = index.join(ids.select(F.col(id_col).alias("page_id")).distinct(), "page_id", "left_semi")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uri, part in pdf.groupby("bundle"):
                reader = BundleReader(uri)
                got = [reader.record(f, o, n) for f, o, n in zip(part["frame"], part["offset"], part["length"], strict=True)]
                reader.close()
                yield pd.DataFrame({"page_id": part["page_id"].to_numpy(), "record": got})

    return wanted.mapInPandas(read, "page_id long, record binary")


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archive to the shared folder and read it back; one row a record."""
    index = write_archive(pages, folder or fresh_dir(spark, "warc"))
    return read_archive(index).drop("url")
