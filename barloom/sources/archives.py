"""Zipped history: archives of headerless CSV files, one per exchange."""

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions import text
from barloom.schema import HISTORY_LINE_DDL, ZIP_SIGNATURE
from barloom.shipping import ship_with_tasks

ship_with_tasks(__name__)

ARCHIVE_ORDER = ["archive", "entry_no", "line_no"]

# Archives are named after the last day they hold, as ...Upto31012024.zip, and
# those with prices as traded have Raw. before it.
_DAY, _RAW = r"Upto(\d{8})\.zip$", r"Raw\.Upto\d{8}\.zip$"
KINDS = ("raw", "adjusted")

_LINES = "archive string, entry string, entry_no int, line_no bigint, line string, error string"
_ENTRIES = "archive string, entry string, entry_no int, method int, crc bigint, data binary, error string"
_LINES_PER_BATCH = 20_000
_LINES_PER_TASK = 200_000
_BLOCK = 1 << 20


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` with their content, as (path, content).

    The path comes from the file's metadata, so a filter on it is applied when files are
    listed, and the others are never opened.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), "content")


def archive_day(path: Column) -> Column:
    """The day an archive is named after; null if its name holds none."""
    return F.try_to_date(F.regexp_extract(path, _DAY, 1), "ddMMyyyy")


def archive_order() -> list[Column]:
    """Later archives by their day, not by their name as text; then position."""
    return [archive_day(F.col("archive")), *map(F.col, ARCHIVE_ORDER)]


def of_kind(path: Column, kind: str) -> Column:
    """Whether an archive's name fits a kind of prices; a name that tells none fits both."""
    if kind not in KINDS:
        raise ValueError(f"kind {kind!r} is none of {KINDS}")
    raw = path.rlike(_RAW)
    return (raw | ~path.rlike(_DAY)) if kind == "raw" else ~raw


def select_archives(
    files: DataFrame, kind: str = "raw", days: list[date] | None = None, until: date | None = None
) -> DataFrame:
    """Files of one kind of prices, ``raw`` or ``adjusted``, by name alone; kinds are never mixed.

    ``days`` keeps archives of these days. ``until`` keeps the newest day's up to that one, as
    archives are cumulative; it lists the names once. Without any day in a name all files stay.
    """
    files = files.filter(of_kind(F.col("path"), kind))
    if days is not None:
        names = [d.strftime("%d%m%Y") for d in days]
        files = files.filter(F.regexp_extract("path", _DAY, 1).isin(names))
    if until is not None:
        day = archive_day(F.col("path"))
        newest, dated = files.agg(F.max(F.when(day <= F.lit(until), day)), F.count(day)).first()
        if dated:
            wanted = "" if newest is None else newest.strftime("%d%m%Y")
            files = files.filter(F.regexp_extract("path", _DAY, 1) == (wanted or "none"))
    return files


def admitted(files: DataFrame) -> DataFrame:
    """Files that carry the zip signature; an error page saved as .zip does not."""
    return files.filter(_has_signature())


def quarantined(files: DataFrame) -> DataFrame:
    return files.filter(~F.coalesce(_has_signature(), F.lit(False))).select("path")


def _has_signature():
    return F.substring("content", 1, len(ZIP_SIGNATURE)) == F.lit(ZIP_SIGNATURE)


def archive_lines(files: DataFrame) -> DataFrame:
    """Lines of all CSV entries, in parallel over entries.

    A task first cuts an archive into its entries, still compressed, which are dealt out;
    then each is inflated on its own and its lines leave Python in small batches. A
    damaged archive or entry gives one row with ``error`` set and none of its lines.
    """
    entries = admitted(files).select("path", "content").mapInArrow(_entries, _ENTRIES)
    return entries.repartition("archive", "entry_no").mapInArrow(_inflate, _LINES)


def archive_problems(files: DataFrame) -> DataFrame:
    problems = archive_lines(files).filter(F.col("error").isNotNull())
    return problems.select("archive", "entry", "error")


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """CSV text to typed columns; a field that does not parse is null."""
    kept = [c for c in lines.columns if c != column]
    row = F.from_csv(F.col(column), HISTORY_LINE_DDL)
    # A generator, so that filters on the fields do not parse the line once more each.
    return lines.select(*kept, F.inline(F.array(row)))


def archive_scan(files: DataFrame) -> DataFrame:
    """Raw history lines of all archives, with exchange and position of each."""
    # One entry may hold most of the history: its lines are parsed in many tasks.
    block = F.floor(F.col("line_no") / _LINES_PER_TASK)
    return parsed_history(archive_lines(files).repartition("archive", "entry_no", block))


def parsed_history(lines: DataFrame) -> DataFrame:
    """History lines of ``archive_lines`` as typed columns; problems are left out."""
    parsed = parse_lines(lines.filter(F.col("error").isNull()).drop("error"))
    return parsed.withColumn("exchange", text.normalize_exchange(F.col("entry"))).drop("entry")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _entries_of(path.as_py(), content.as_buffer())


def _entries_of(archive, content):
    try:
        opened = zipfile.ZipFile(io.BufferedReader(pa.BufferReader(content)))
    except (zipfile.BadZipFile, ValueError, OSError) as problem:
        yield _entry(archive, None, -1, 0, 0, None, _text(problem))
        return
    with opened:
        infos = [i for i in opened.infolist() if i.filename.endswith(".csv")]
        for number, info in enumerate(infos):
            # The local header says where the data begins; its two lengths may differ from
            # those in the directory at the end.
            head = content[info.header_offset : info.header_offset + 30].to_pybytes()
            error = None
            if len(head) < 30 or head[: len(ZIP_SIGNATURE)] != ZIP_SIGNATURE:
                error = "BadZipFile: bad header of an entry"
            elif info.flag_bits & 1:
                error = "RuntimeError: entry is encrypted"
            elif info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                error = f"NotImplementedError: compression {info.compress_type}"
            if error:
                yield _entry(archive, info.filename, number, 0, 0, None, error)
                continue
            start = info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30]))
            data = content[start : start + info.compress_size].to_pybytes()
            yield _entry(archive, info.filename, number, info.compress_type, info.CRC, data, None)


def _entry(archive, name, number, method, crc, data, error):
    row = {"archive": archive, "entry": name, "entry_no": number, "method": method, "crc": crc, "data": data, "error": error}
    return pa.RecordBatch.from_pylist([row], _ENTRY_SCHEMA)


_ENTRY_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("entry", pa.string()),
        ("entry_no", pa.int32()),
        ("method", pa.int32()),
        ("crc", pa.int64()),
        ("data", pa.binary()),
        ("error", pa.string()),
    ]
)


class _Inflated(io.RawIOBase):
    """The bytes of an entry, inflated block by block."""

    def __init__(self, blocks):
        self.blocks, self.rest = blocks, b""

    def readable(self):
        return True

    def readinto(self, into):
        while not self.rest:
            self.rest = next(self.blocks, None)
            if self.rest is None:
                self.rest = b""
                return 0
        size = min(len(into), len(self.rest))
        into[:size], self.rest = self.rest[:size], self.rest[size:]
        return size


def _blocks(chunks, method):
    """What the compressed ``chunks`` of an entry hold, a bounded block at a time."""
    if method == zipfile.ZIP_STORED:
        yield from chunks
        return
    inflater = zlib.decompressobj(-15)
    for given in chunks:
        while given and not inflater.eof:
            yield inflater.decompress(given, _BLOCK)
            given = inflater.unconsumed_tail
    if not inflater.eof:
        raise EOFError("entry ends early")


def _inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            archive, name, number, method, crc, data, error = (c[row].as_py() for c in batch.columns)
            if error is None:
                error = _damage(_blocks([data], method), crc)
            if error:
                yield _batch(archive, name, -1, 0, [None], error)
            else:
                yield from _entry_lines(archive, name, number, _blocks([data], method))


def _damage(blocks, crc):
    """Inflate an entry to its end, so that a bad checksum shows before any line is used."""
    found = 0
    try:
        for block in blocks:
            found = zlib.crc32(block, found)
    except (zlib.error, EOFError) as problem:
        return _text(problem)
    return None if found == crc else "BadZipFile: bad checksum"


def _entry_lines(archive, name, number, blocks):
    stream = io.TextIOWrapper(io.BufferedReader(_Inflated(blocks)), encoding="utf-8", errors="replace", newline="\n")
    first, lines = 0, []
    for line in stream:
        lines.append(line.rstrip("\r\n"))
        if len(lines) == _LINES_PER_BATCH:
            yield _batch(archive, name, number, first, lines)
            first, lines = first + len(lines), []
    if lines:
        yield _batch(archive, name, number, first, lines)


def _text(problem):
    return f"{type(problem).__name__}: {problem}"


def _batch(archive, name, number, first, lines, error=None):
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([archive] * n, pa.string()),
            pa.array([name] * n, pa.string()),
            pa.array([number] * n, pa.int32()),
            pa.array(range(first, first + n), pa.int64()),
            pa.array(lines, pa.string()),
            pa.array([error] * n, pa.string()),
        ],
        names=["archive", "entry", "entry_no", "line_no", "line", "error"],
    )
