"""Media columns: payloads in archives, read back by a custom Spark data source.

Writing: every payload (bytes padded with zeros to a positive multiple of 64)
becomes an 8-bit greyscale PNG, 64 samples a row, stored in ZIP archives of
bounded size under the shared folder. A task names its archives by its attempt
and lists them in a manifest; only the manifest's archives count, so an attempt
that was lost leaves nothing that is read.

Reading: the source ``gridsight_media`` plans byte ranges over the archives from
their sizes alone. A partition takes ranges of large archives or several small ones,
``range_bytes`` together; that size grows with the whole so that there are never more
than about ``MOST_PARTITIONS``. A reader takes an archive's directory, keeps the
members that start in its range and streams them as Arrow batches of bounded size. A
member is read at its offset, checked against the directory and decoded; if any of it
fails, it alone is read again, with a fresh handle. One that stays damaged is a row
with its ``error`` and without payload, and the others of its range are not affected.

Defined results: a null or empty text is one row of 64 zero samples; repeated
rows are stored and returned each; null ids come back null, ids too long for a
member's comment are members of their own; an empty table gives no archives and no
rows; other columns are not read.
"""

from __future__ import annotations

import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import scratch

WIDTH = 64
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES, MOST_PARTITIONS = 32 << 20, 50_000
BATCH_BYTES = 4 << 20
ATTEMPTS = 3
#: Fixed values of the PNG format: its signature, and depth 8, grey, deflate, adaptive filters, not interlaced.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_KIND = (8, 0, 0, 0, 0)
PNG_PART = 1 << 20
#: Fixed values of the ZIP format: the size of a local header before its name, and the longest comment.
ZIP_HEADER, LONGEST_NOTE = 30, 65_535


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def padded(data: bytes) -> bytes:
    size = max(WIDTH, -(-len(data) // WIDTH) * WIDTH)
    return data + bytes(size - len(data))


def _png_chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A payload of whole rows as a greyscale image; filter 0 on every row."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    data = zlib.compress(lines.tobytes(), 1)
    parts = [_png_chunk(b"IDAT", data[i : i + PNG_PART]) for i in range(0, len(data), PNG_PART)]
    return PNG_SIGNATURE + _png_chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), *PNG_KIND)) + b"".join(parts) + _png_chunk(b"IEND", b"")


def from_png(image: bytes) -> bytes:
    """The samples of an image made by ``to_png``; any damage is an error."""
    try:
        return _samples(image)
    except (struct.error, zlib.error) as error:
        raise ValueError("damaged PNG") from error


def _samples(image: bytes) -> bytes:
    if image[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG")
    at, data, height = 8, [], 0
    while at < len(image):
        (size,), kind = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", image[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", body)
            if width != WIDTH or tuple(form) != PNG_KIND:
                raise ValueError("another kind of PNG")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("another row filter")
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean sample, share of rising steps and the eight-bin histogram, all in whole parts of a thousand."""
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x >> 5, minlength=8) * 1000 // len(x)
    rising = int((x[1:] > x[:-1]).sum()) * 1000 // len(x)
    return f"{int(x.sum(dtype=np.int64)) * 1000 // len(x)};{rising};" + ",".join(map(str, counts.tolist()))


class _Archive:
    """One ZIP being written to a stream; members are stored as they are."""

    def __init__(self, folder: str, name: str):
        self.fs, base = filesystem(folder)
        self.name, self.path = name, f"{base}/{name}"
        self.stream = self.fs.open_output_stream(self.path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.members = 0

    def add(self, image: bytes, size: int, key: str | None) -> None:
        """One member; its comment is the text's bytes and ``:`` with the id, or ``+`` if the id is the next member."""
        info = zipfile.ZipInfo(f"{self.members:08d}.png")
        info.comment = (f"{size}" if key is None else f"{size}:{key}").encode()
        long = len(info.comment) > LONGEST_NOTE
        if long:
            info.comment = f"{size}+".encode()
        self.zip.writestr(info, image)
        if long:
            self.zip.writestr(zipfile.ZipInfo(f"{self.members:08d}.id"), key.encode())
        self.members += 1

    def size(self) -> int:
        return self.stream.tell()

    def close(self) -> tuple[str, int, int]:
        self.zip.close()
        size = self.stream.tell()
        self.stream.close()
        return self.name, self.members, size


def write_archives(docs: DataFrame, folder: str, *, text: str = "text", id: str = "doc_id", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Store every row's payload; the manifest ends in ``folder/manifest``."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, mark = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        current, done = None, []
        for batch in batches:
            for key, x in zip(batch.column(0), batch.column(1), strict=True):
                if current is None:
                    current = _Archive(folder, f"media-{task:06d}-{len(done):04d}-{mark}.zip")
                data = (x.as_py() or "").encode()
                current.add(to_png(padded(data)), len(data), key.as_py())
                if current.size() >= archive_bytes:
                    done.append(current.close())
                    current = None
        if current is not None:
            done.append(current.close())
        names, members, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(members, pa.int64()), pa.array(sizes, pa.int64())], ["name", "members", "bytes"])

    docs.select(docs[id].cast("string").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, "name string, members long, bytes long").write.parquet(f"{folder}/manifest")


@dataclass
class ByteRanges(InputPartition):
    """Ranges ``(archive, start, end)`` of a partition."""

    ranges: list[tuple[str, int, int]]


def plan(archives: list[tuple[str, int]], target: int) -> list[ByteRanges]:
    """Archives ``(name, bytes)`` as partitions of about ``target`` bytes, cut and gathered in order of their names."""
    found: list[ByteRanges] = []
    room = 0
    for name, size in sorted(archives):
        step = -(-size // max(1, -(-size // target)))  # equal ranges of a large archive
        for at in range(0, size, max(1, step)):
            end = min(size, at + step)
            if room < end - at:
                found.append(ByteRanges([]))
                room = target
            found[-1].ranges.append((name, at, end))
            room -= end - at
    return found


class MediaSource(DataSource):
    """``spark.read.format("gridsight_media").option("path", folder)``.

    Options: ``range_bytes`` (least size of a partition), ``attempts`` (reads of a member before it is given up).
    """

    @classmethod
    def name(cls) -> str:
        return "gridsight_media"

    def schema(self) -> str:
        return "doc_id string, archive string, offset long, n_bytes long, media binary, payload binary, feature string, error string"

    def reader(self, schema) -> DataSourceReader:
        return MediaReader(self.options)


class MediaReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self) -> list[ByteRanges]:
        """Byte ranges over every archive of the manifest; directories are left to the readers."""
        fs, base = filesystem(self.folder)
        files = [f for f in fs.get_file_info(pafs.FileSelector(f"{base}/manifest")) if f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", "."))]
        found: list[tuple[str, int]] = []
        for file in files:
            listed = pq.read_table(file.path, filesystem=fs, columns=["name", "bytes"]).to_pydict()
            found += zip(listed["name"], listed["bytes"], strict=True)
        return plan(found, max(self.range_bytes, -(-sum(size for _, size in found) // MOST_PARTITIONS)))

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty plan
            return
        fs, base = filesystem(self.folder)
        rows, size = [], 0
        for archive, start, end in partition.ranges:
            path = f"{base}/{archive}"
            directory = self._directory(fs, path)
            handle = fs.open_input_file(path)
            for place, member in enumerate(directory):
                if not (start <= member.header_offset < end) or member.filename.endswith(".id"):
                    continue
                image = payload = feature = error = key = None
                count, mark, note = _note(member.comment.decode())
                try:
                    if mark == "+":
                        handle, name = self._member(fs, path, handle, directory[place + 1], bytes)
                        key = name.decode()
                    elif mark:
                        key = note
                    handle, (image, payload) = self._member(fs, path, handle, member, lambda data: (data, from_png(data)))
                    feature = feature_of(payload)
                except (OSError, ValueError, struct.error) as fault:
                    error = str(fault)
                    handle = fs.open_input_file(path)
                rows.append((key, archive, member.header_offset, count, image, payload, feature, error))
                size += len(image or b"") + len(payload or b"")
                if size >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, size = [], 0
            handle.close()
        if rows:
            yield self._batch(rows)

    def _directory(self, fs, path: str) -> list[zipfile.ZipInfo]:
        with fs.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
            return sorted(archive.infolist(), key=lambda m: m.header_offset)

    def _member(self, fs, path: str, handle, member: zipfile.ZipInfo, decoded):
        """The handle in use and ``decoded`` of one member's bytes, read at its offset; what fails is repeated for it alone."""
        for attempt in range(self.attempts):
            try:
                handle.seek(member.header_offset)
                head = handle.read(ZIP_HEADER)
                name, extra = struct.unpack("<HH", head[26:30])
                handle.seek(member.header_offset + ZIP_HEADER + name + extra)
                data = handle.read(member.compress_size)
                if len(data) != member.compress_size or zlib.crc32(data) != member.CRC:
                    raise OSError(f"{path}: member at {member.header_offset} is damaged")
                return handle, decoded(data)
            except (OSError, ValueError, struct.error):
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(0.1 * 2**attempt)
                handle = fs.open_input_file(path)
        raise ValueError("attempts must be positive")

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "archive", "offset", "n_bytes", "media", "payload", "feature", "error"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _note(comment: str) -> tuple[int, str, str]:
    """Bytes of a text, the mark after them (none for a null id) and the id."""
    digits = len(comment) - len(comment.lstrip("0123456789"))
    return int(comment[:digits] or 0), comment[digits : digits + 1], comment[digits + 1 :]


def media(docs: DataFrame, *, text: str = "text", id: str = "doc_id", folder: str | None = None, **options) -> DataFrame:
    """Store the texts of ``docs`` as media and read them back; ``doc_id`` has its type again."""
    spark = docs.sparkSession
    folder = folder or scratch.new_folder(spark, "media")
    write_archives(docs, folder, text=text, id=id)
    spark.dataSource.register(MediaSource)
    back = spark.read.format("gridsight_media").options(**options).load(folder)
    return back.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id].dataType))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -WIDTH, WIDTH)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
