"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that are compressed independently, frames into bundle files. A bundle
ends in a seek table in a skippable frame, as in the seekable Zstandard format, so a reader finds
every frame from the file's end. An index maps record ids to (bundle, frame, offset in the frame,
length): one record is read by decompressing one frame.

Of records with equal payloads of at least ``MIN_SHARED`` bytes, the one with the largest id is a
response and the others are revisits that refer to it and hold no payload.

Defined cases: a null payload is empty. A null URL writes no target line; control characters and
spaces in URLs are percent-encoded. Rows that share id and payload are all responses if that id is
the largest of the group, else all revisits; each is written. A null id is smaller than any other. A
payload of any length is one record; a frame holds at least one record. An empty table writes no file.

Files are written under a name of their own and then moved to the final name, which depends on the
partition and position only, so a task that runs again writes the same bundle.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.session import stored, work_folder

MIN_SHARED = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
LEVEL = 1

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_revisits(df: DataFrame, record_id: str, url: str, payload: str, min_shared: int = MIN_SHARED) -> DataFrame:
    """``record_id, url, payload, digest, refers_to``: who is written whole and who refers to whom.

    Groups are found on digests alone; payloads shuffle once, by record, so a large group of copies
    is spread over tasks.
    """
    html = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(record_id).alias("record_id"), F.col(url).alias("url"), html.alias("payload"), F.sha1(html.cast("binary")).alias("digest"))
    light = stored(rows.filter(F.octet_length("payload") >= min_shared).select("record_id", "digest"))
    largest = stored(light.groupBy("digest").agg(F.max("record_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    revisits = light.distinct().join(largest, "digest").filter("NOT record_id <=> refers_to")
    revisits = revisits.select(F.col("digest").alias("r_digest"), F.col("record_id").alias("r_id"), "refers_to")
    found = rows.join(revisits, (F.col("digest") == F.col("r_digest")) & F.col("record_id").eqNullSafe(F.col("r_id")), "left")
    return found.select("record_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), F.octet_length("payload").cast("long").alias("payload_bytes"), "digest", "refers_to")


def record_bytes(record_id, url: str | None, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit's block is the HTTP head alone, which tells the whole payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if "!" <= c <= "~" or c > "\x9f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[dict]:
    """Records of one decompressed frame, with their offsets in it."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        head = dict(line.split(": ", 1) for line in data[at:body - 4].decode().split("\r\n")[1:])
        end = body + int(head["Content-Length"])
        http = data.index(b"\r\n\r\n", body) + 4
        size = next(int(line[16:]) for line in data[body:http].split(b"\r\n") if line.startswith(b"Content-Length: "))
        yield {"head": head, "payload": data[http:end], "size": size, "offset": at, "length": end + 4 - at}
        at = end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with the compressed and decompressed size of each frame, and the footer."""
    entries = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries)) + entries


def read_seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from a bundle or the end of one."""
    count, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    frames, at = [], 0
    for packed, size in struct.iter_unpack("<II", tail[len(tail) - 9 - 8 * count:-9]):
        frames.append((at, packed, size))
        at += packed
    return frames


class _Bundle:
    """Collects records of one bundle and writes it when it is full."""

    def __init__(self, folder: str, name: str, frame_bytes: int):
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.name, self.frame_bytes = name, frame_bytes
        self.packed, self.frames, self.open, self.open_bytes, self.index, self.size = [], [], [], 0, [], 0
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress

    def add(self, record_id, record: bytes) -> None:
        self.index.append((record_id, self.name, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            packed = self.pack(b"".join(self.open))
            self.packed.append(packed)
            self.frames.append((len(packed), self.open_bytes))
            self.size += len(packed)
            self.open, self.open_bytes = [], 0

    def close(self) -> list[tuple]:
        self.flush()
        own, final = f"{self.root}/{self.name}-{uuid.uuid4().hex}.part", f"{self.root}/{self.name}.warc.zst"
        with self.files.open_output_stream(own) as out:
            for packed in self.packed:
                out.write(packed)
            out.write(seek_table(self.frames))
        if self.files.get_file_info(final).type != fs.FileType.NotFound:
            self.files.delete_file(final)  # of an earlier run of this task: the same bytes
        self.files.move(own, final)
        return self.index


_INDEX = pa.schema([("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the planned records under ``folder`` and return the stored index; one open bundle per task is held in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, bundle = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for record_id, url, payload, size, digest, refers_to in zip(*(batch.column(i) for i in range(6))):
                if bundle is None:
                    bundle, made = _Bundle(folder, f"bundle-{task:06d}-{made:06d}", frame_bytes), made + 1
                body = b"" if payload.as_py() is None else payload.as_buffer().to_pybytes()
                bundle.add(record_id.as_py(), record_bytes(record_id.as_py(), url.as_py(), body, size.as_py(), digest.as_py(), refers_to.as_py()))
                if bundle.size >= bundle_bytes:
                    yield _index_batch(bundle.close())
                    bundle = None
        if bundle is not None:
            yield _index_batch(bundle.close())

    ordered = records.select(F.col("record_id").cast("string"), "url", "payload", "payload_bytes", "digest", F.col("refers_to").cast("string"))
    ordered = ordered.sortWithinPartitions("record_id", "digest", "url")
    return stored(ordered.mapInArrow(run, "record_id string, bundle string, frame int, offset int, length int"))


def _index_batch(index: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in index], f.type) for i, f in enumerate(_INDEX)], schema=_INDEX)


_READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int32())])


def _urn(value: str | None) -> str | None:
    found = value and value.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "None" else found


def read_bundles(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of every bundle, found through the seek tables; a response's digest is taken from its payload again."""
    schema = pa.schema([*_READ, *([pa.field("payload", pa.string())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer())
                for number, (at, packed, size) in enumerate(read_seek_table(data)):
                    rows = []
                    for r in parse_records(unpack.decompress(data[at:at + packed], max_output_size=size)):
                        head, revisit = r["head"], r["head"]["WARC-Type"] == "revisit"
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(r["payload"]).hexdigest()
                        rows.append((_urn(head["WARC-Record-ID"]), head["WARC-Type"], _urn(head.get("WARC-Refers-To")), r["size"] if revisit else len(r["payload"]), digest,
                                     path.rsplit("/", 1)[-1].removesuffix(".warc.zst"), number, r["offset"], *([None if revisit else r["payload"].decode()] if payloads else [])))
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    names = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int' if f.type == pa.int32() else 'string'}" for f in schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(run, names)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """Payloads of the records in (a part of) an index: ``record_id, payload``, each from one frame read by its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        unpack, last, frame = zstandard.ZstdDecompressor(), None, b""
        for batch in batches:
            ids, payloads = [], []
            for record_id, bundle, number, offset, length in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if last != (bundle, number):
                    with files.open_input_file(f"{root}/{bundle}.warc.zst") as file:
                        total = file.size()
                        count = struct.unpack("<IBI", file.read_at(9, total - 9))[0]
                        at, packed, size = read_seek_table(file.read_at(9 + 8 * count, total - 9 - 8 * count))[number]
                        frame, last = unpack.decompress(file.read_at(packed, at), max_output_size=size), (bundle, number)
                record = next(parse_records(frame[offset:offset + length]))
                ids.append(record_id)
                payloads.append(record["payload"].decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(payloads, pa.string())], names=["record_id", "payload"])

    return index.select("record_id", "bundle", "frame", "offset", "length").sortWithinPartitions("bundle", "frame").mapInArrow(run, "record_id string, payload string")


def archive(pages: DataFrame, record_id: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None, **sizes) -> tuple[str, DataFrame]:
    """Write all rows as bundles; the folder and the stored index."""
    folder = folder_uri(folder or work_folder(pages.sparkSession))
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    return folder, write_bundles(plan_revisits(pages, record_id, url, payload), folder, **sizes)


def folder_uri(folder: str) -> str:
    """The folder as a URI that both Spark and Arrow's file systems take."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        return "file://" + folder.removeprefix("file:")
    return folder if "://" in folder else f"file://{folder}"
