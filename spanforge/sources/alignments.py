"""Alignments from SAM text and BAM files."""

from __future__ import annotations

import bisect
import glob as globbing
import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spanforge.sources.lines import field, integer, numbered_lines

SCHEMA = "ord long, name string, flags int, chrom string, start long, end long, mapq int"


def sam_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM files.

    `end` follows from the operations that consume the reference; a mapped
    record without a reference or position fails the job.
    """
    lines = numbered_lines(spark, path).where(~F.col("value").startswith("@"))
    v = F.when(~F.col("value").startswith("@"), F.col("value"))  # filters may be evaluated in any order
    spans = F.regexp_extract_all(field(v, 5), F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    span = F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x.cast("long"))
    flags = field(v, 1).cast("int")
    at = integer(field(v, 3))
    mapped = flags.bitwiseAND(4) == 0
    named = F.when(field(v, 2) != "*", field(v, 2))
    checked = F.when(mapped & (named.isNull() | (at <= 0)), F.raise_error(F.lit("a mapped record without a reference or position")).cast("string")).otherwise(named)
    return lines.select(
        "file", F.col("line_no").alias("ord"), field(v, 0).alias("name"), flags.alias("flags"), checked.alias("chrom"), (at - 1).alias("start"),
        F.when(mapped, at - 1 + span).otherwise(at - 1).alias("end"), field(v, 4).cast("int").alias("mapq"),
    )


#: Compressed bytes of a BAM file that are one task's work.
SPLIT_BYTES = 64 << 20
#: Bytes of content in which a range looks for its first record.
LOOK_AHEAD = 1 << 18
# The empty block that closes a file.
CLOSING = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


class CutShort(ValueError):
    """A file ends before its end."""


def _block_size(data: bytes, at: int) -> int | None:
    """Bytes of the compressed block that begins there; None if none does."""
    if len(data) < at + 18 or data[at : at + 4] != b"\x1f\x8b\x08\x04":
        return None
    extra = struct.unpack_from("<H", data, at + 10)[0]
    field, end = at + 12, at + 12 + extra
    while field + 4 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, field + 2)[0]
        if data[field : field + 2] == b"BC" and size == 2 and field + 6 <= len(data):
            return struct.unpack_from("<H", data, field + 4)[0] + 1
        field += 4 + size
    return None


class Blocks:
    """The blocks of a file from the first that begins at `start` or later: (place, content) each, to the file's end."""

    def __init__(self, path: str, start: int = 0):
        self.path, self.size = path, os.path.getsize(path)
        self.source = open(path, "rb")
        self.at = start if not start else self._first(start)
        self.source.seek(self.at)
        self.data, self.base = b"", self.at

    def _first(self, start: int) -> int:
        """A block begins where the size that its head gives leads to another one or to the end."""
        self.source.seek(start)
        data, at = self.source.read(3 << 16), -1
        while (at := data.find(b"\x1f\x8b\x08\x04", at + 1)) >= 0:
            size = _block_size(data, at)
            if size and (start + at + size == self.size or _block_size(data, at + size)):
                return start + at
        return self.size

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while self.at < self.size:
            if self.at - self.base + (1 << 16) + 18 > len(self.data):
                self.data, self.base = self.data[self.at - self.base :] + self.source.read(1 << 22), self.at
            place = self.at - self.base
            size = _block_size(self.data, place)
            if size is None or place + size > len(self.data):
                raise CutShort(f"{self.path}: no whole block at byte {self.at}")
            inflate = zlib.decompressobj(31)
            content = inflate.decompress(self.data[place : place + size])
            if not inflate.eof:
                raise CutShort(f"{self.path}: the block at byte {self.at} ends inside")
            yield self.at, content
            self.at += size


class _Bytes:
    """Content of a file's blocks as one run of bytes."""

    def __init__(self, blocks: Blocks):
        self.parts, self.path, self.held = iter(blocks), blocks.path, b""

    def take(self, n: int) -> bytes:
        pieces, have = [self.held], len(self.held)
        while have < n:
            _, piece = next(self.parts, (0, None))
            if piece is None:
                raise CutShort(f"{self.path} is cut short")
            pieces.append(piece)
            have += len(piece)
        whole = b"".join(pieces)
        self.held = whole[n:]
        return whole[:n]


def bam_header(path: str) -> tuple[list[str], int, int]:
    """Names of the references, and where the first record begins: its block and the place in it."""
    blocks = Blocks(path)
    source = _Bytes(blocks)
    if source.take(4) != b"BAM\x01":
        raise ValueError(f"{path} is no BAM file")
    source.take(struct.unpack("<i", source.take(4))[0])
    names = []
    for _ in range(struct.unpack("<i", source.take(4))[0]):
        names.append(source.take(struct.unpack("<i", source.take(4))[0])[:-1].decode())
        source.take(4)
    left, at = len(source.held), None
    for at, content in Blocks(path):  # the block in which the header ends
        if at == blocks.at:
            return names, at, len(content) - left
    return names, blocks.size, 0


def _plausible(data: bytes, at: int, references: int) -> int | None:
    """Where the record that may begin there ends; None if none does."""
    if at + 36 > len(data):
        return None
    size, ref, pos, name_size, _, _, operations, _, bases, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    if not (32 < size < 1 << 28 and -1 <= ref < references and pos >= -1 and -1 <= mate < references and mate_pos >= -1 and bases >= 0 and name_size > 1):
        return None
    if 32 + name_size + 4 * operations + (bases + 1) // 2 + bases > size:
        return None
    name = data[at + 36 : at + 36 + name_size]
    if len(name) == name_size and (name[-1] or not all(33 <= c <= 126 for c in name[:-1])):
        return None
    return at + 4 + size


def _first_record(data: bytes, references: int, last: bool) -> int | None:
    """The first place from which plausible records follow each other: a hundred, as many as there are, or to the file's end if `last`.

    Fewer than three on the way out of the data prove nothing.
    """
    for start in range(len(data)):
        at, records = start, 0
        while at is not None and at + 36 <= len(data) and records < 100:
            at, records = _plausible(data, at, references), records + 1
        if at is not None and (records == 100 or (at == len(data) if last else records > 3)):
            return start if records else None
    return None


def _numbers(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(data[at[:, None] + np.arange(width)]).view(kind)[:, 0]


def _flat(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places start, ..., start + size - 1 of all rows together, and where each row's end."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size), ends


def decoded(content: bytes, starts: list[int], ords: list[int], names: list[str], path: str) -> pa.RecordBatch:
    """Rows of the records that begin at the given places."""
    data, at = np.frombuffer(content, dtype=np.uint8), np.array(starts, dtype=np.int64)
    ref, pos, operations, flags = (_numbers(data, at + k, t).astype(np.int64) for k, t in ((4, "<i4"), (8, "<i4"), (16, "<u2"), (18, "<u2")))
    name_size, mapq = data[at + 12].astype(np.int64), data[at + 13].astype(np.int32)
    mapped = flags & 4 == 0
    if (bad := np.flatnonzero(mapped & ((ref < 0) | (pos < 0)))).size:
        raise ValueError(f"{path}: the record at {ords[bad[0]]} is mapped without a reference or position")
    place, ends = _flat(at + 36, name_size - 1)
    text = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(data[place].tobytes())])
    place, ends = _flat(at + 36 + name_size, 4 * operations)
    cigar = data[place].view("<u4") if len(place) else np.zeros(0, np.uint32)
    spans = np.concatenate([[0], np.cumsum(np.where(np.isin(cigar & 15, (0, 2, 3, 7, 8)), cigar >> 4, 0).astype(np.int64))])
    first = np.concatenate([[0], ends[:-1]]) // 4
    span = spans[ends // 4] - spans[first]
    chrom = pa.array(names, pa.string()).take(pa.array(np.maximum(ref, 0), mask=ref < 0))
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(at), pa.string()), pa.array(ords, pa.int64()), text.cast(pa.string()), pa.array(flags.astype(np.int32)), chrom,
         pa.array(pos), pa.array(np.where(mapped, pos + span, pos)), pa.array(mapq)],
        names=["file", "ord", "name", "flags", "chrom", "start", "end", "mapq"],
    )


def bam_batches(path: str, start: int, end: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Records that begin in a block which begins in [start, end); ord is the place of a record in its file.

    The header tells where the first record begins.  A range further on begins
    with the first place from which records follow each other.
    """
    names, first_block, within = bam_header(path)
    if end <= first_block:
        return
    with open(path, "rb") as source:
        source.seek(-min(len(CLOSING), os.path.getsize(path)), os.SEEK_END)
        if source.read() != CLOSING:
            raise CutShort(f"{path} lacks the block that closes a file; its end is lost")
    blocks = Blocks(path, max(start, first_block))
    parts = iter(blocks)
    ahead, at = [], within
    if start > first_block:
        at, held = None, 0
        for block, part in parts:
            ahead.append((block, part))
            held += len(part)
            if held > LOOK_AHEAD:  # a record may be longer than that
                at, held = _first_record(b"".join(p for _, p in ahead), len(names), False), 0
                if at is not None or block >= end:
                    break
        else:
            at = _first_record(b"".join(p for _, p in ahead), len(names), True)
        if at is None:
            return
    content, marks, found, limit = b"", [], [], None

    def ord_of(place: int) -> int:
        block_at, block = marks[bisect.bisect_right(marks, place, key=lambda m: m[0]) - 1]
        return block << 16 | place - block_at

    def rows() -> pa.RecordBatch:
        return decoded(content, found, [ord_of(x) for x in found], names, path)

    for block, part in itertools.chain(ahead, parts):
        if block >= end and limit is None:
            limit = len(content)
        if limit is not None and at >= limit:
            break  # what began in the range is whole
        if part:
            marks.append((len(content), block))
            content += part
        while at + 4 <= len(content) and (limit is None or at < limit):
            size = struct.unpack_from("<i", content, at)[0]
            if size < 32:
                raise ValueError(f"{path}: no record at {ord_of(at)}")
            if at + 4 + size > len(content):
                break
            found.append(at)
            at += 4 + size
        if found and len(content) > most:
            yield rows()
            k = max(0, bisect.bisect_right(marks, at, key=lambda m: m[0]) - 1)
            drop, found = marks[k][0], []
            content, marks, at = content[drop:], [(place - drop, b) for place, b in marks[k:]], at - drop
            limit = None if limit is None else limit - drop
    else:
        if at < len(content):
            raise CutShort(f"{path} ends inside a record")
    if found:
        yield rows()


class BamRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class BamReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[InputPartition]:
        found = sorted(globbing.glob(os.path.join(self.path, "*.bam")) if os.path.isdir(self.path) else globbing.glob(self.path))
        if not found:
            raise FileNotFoundError(f"no BAM file at {self.path}")
        return [BamRange(p, a, min(a + self.split, size)) for p in found for size in [os.path.getsize(p)] for a in range(0, size, self.split)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from bam_batches(partition.path, partition.start, partition.end)


class BamSource(DataSource):
    """spark.read.format("bam").load(path): file and the columns of SCHEMA.

    A task for each `split` compressed bytes (64 MB) of each file on a shared
    file system; ord grows along a file, without being dense.  A file whose end
    is lost fails the read.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return "file string, " + SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options["path"], int(self.options.get("split", SPLIT_BYTES)))


def bam_alignments(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("split", split).load(path)


def bam_counts(spark: SparkSession, path: str) -> DataFrame:
    """file, records: number of records of each BAM file."""
    return bam_alignments(spark, path).groupBy("file").agg(F.count("*").alias("records"))
