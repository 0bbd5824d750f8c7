"""Zipped history as a Python data source: a partition per entry, read by range.

Planning reads the directory at the end of each archive and nothing else. A task opens
the archive, goes to its entry, and inflates it in bounded blocks: once to check
its checksum, once for its lines. So no entry crosses a shuffle, an archive may be
of any size, and a damaged entry gives one row with ``error`` and none of its lines.
Files are opened through Arrow's file systems, by path or URI.
"""

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barloom.schema import ZIP_SIGNATURE
from barloom.shipping import ship_with_tasks
from barloom.sources import archives

ship_with_tasks(__name__)

FORMAT = "zip_history"
_CHUNK = 1 << 20


class EntryPartition(InputPartition):
    """An entry of an archive, or with ``error`` an archive or entry that can't be read."""

    def __init__(self, archive, entry=None, number=-1, method=0, crc=0, offset=0, size=0, error=None):
        self.archive, self.entry, self.number, self.method = archive, entry, number, method
        self.crc, self.offset, self.size, self.error = crc, offset, size, error


class ZipHistory(DataSource):
    """Options: ``path`` (a folder or file), ``kind``, ``days`` (comma-separated), ``until``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return archives._LINES

    def reader(self, schema) -> DataSourceReader:
        return ZipHistoryReader(self.options)


class ZipHistoryReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.kind = options["path"], options.get("kind", "raw")
        self.days = options.get("days")
        self.until = options.get("until")

    def partitions(self) -> list[InputPartition]:
        system, base = file_system(self.path)
        names = chosen(_files(system, base), self.kind, self.days, self.until)
        return [p for name in names for p in _entries(system, name)] or [EntryPartition(None)]

    def read(self, partition: EntryPartition) -> Iterator[pa.RecordBatch]:
        if partition.archive is None:  # there is no archive
            return
        system, _ = file_system(self.path)
        error = partition.error
        try:
            error = error or archives._damage(_content(system, partition), partition.crc)
        except (OSError, zipfile.BadZipFile) as problem:
            error = archives._text(problem)
        if error:
            yield archives._batch(partition.archive, partition.entry, -1, 0, [None], error)
        else:
            yield from archives._entry_lines(partition.archive, partition.entry, partition.number, _content(system, partition))


def file_system(path: str):
    """Arrow's file system for a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _files(system, base: str) -> list[str]:
    """Files of the folder, or the file itself; other folders in it are not entered."""
    info = system.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(base)
    if info.type == fs.FileType.File:
        return [base]
    found = system.get_file_info(fs.FileSelector(base))
    return sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))


def chosen(names: list[str], kind: str = "raw", days: str | None = None, until: str | None = None) -> list[str]:
    """The files that ``select_archives`` would keep, by their names."""
    if kind not in archives.KINDS:
        raise ValueError(f"kind {kind!r} is none of {archives.KINDS}")
    named = {name: re.search(archives._DAY, name) for name in names}
    raw = {name: bool(re.search(archives._RAW, name)) for name in names}
    names = [n for n in names if (raw[n] or not named[n] if kind == "raw" else not raw[n])]
    if days is not None:
        wanted = set(days.split(","))
        return [n for n in names if named[n] and _iso(named[n][1]) in wanted]
    if until is not None and any(named[n] for n in names):
        reached = [_iso(named[n][1]) for n in names if named[n]]
        newest = max((day for day in reached if day <= until), default=None)
        return [n for n in names if named[n] and _iso(named[n][1]) == newest]
    return names


def _iso(digits: str) -> str:
    try:
        return datetime.strptime(digits, "%d%m%Y").date().isoformat()
    except ValueError:
        return "9999-99-99"  # no day: after all others, wanted by none


def _entries(system, name: str) -> Iterator[EntryPartition]:
    """The CSV entries that the directory of an archive lists; files that are no archive are refused."""
    with system.open_input_file(name) as file:
        if file.read(len(ZIP_SIGNATURE)) != ZIP_SIGNATURE:
            yield EntryPartition(name, error="BadZipFile: no zip signature")
            return
        try:
            with zipfile.ZipFile(file) as opened:
                infos = [i for i in opened.infolist() if i.filename.endswith(".csv")]
        except (zipfile.BadZipFile, ValueError, OSError) as problem:
            yield EntryPartition(name, error=archives._text(problem))
            return
    for number, info in enumerate(infos):
        error = None
        if info.flag_bits & 1:
            error = "RuntimeError: entry is encrypted"
        elif info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            error = f"NotImplementedError: compression {info.compress_type}"
        yield EntryPartition(name, info.filename, number, info.compress_type, info.CRC, info.header_offset, info.compress_size, error)


def _content(system, entry: EntryPartition) -> Iterator[bytes]:
    return archives._blocks(_chunks(system, entry), entry.method)


def _chunks(system, entry: EntryPartition) -> Iterator[bytes]:
    """The bytes of an entry as stored, read in pieces of bounded size."""
    with system.open_input_file(entry.archive) as file:
        file.seek(entry.offset)
        head = file.read(30)  # its two lengths may differ from those in the directory
        if len(head) < 30 or head[: len(ZIP_SIGNATURE)] != ZIP_SIGNATURE:
            raise zipfile.BadZipFile("bad header of an entry")
        file.seek(sum(struct.unpack("<HH", head[26:30])), io.SEEK_CUR)
        left = entry.size
        while left:
            chunk = file.read(min(_CHUNK, left))
            if not chunk:
                raise EOFError("archive ends early")
            left -= len(chunk)
            yield chunk


@dataclass(frozen=True)
class ArchiveFolder:
    """Archives in a folder, to be given to the plans in place of ``read_archives``."""

    sparkSession: SparkSession
    path: str

    def lines(self, kind: str = "raw", days: list[date] | None = None, until: date | None = None) -> DataFrame:
        self.sparkSession.dataSource.register(ZipHistory)
        reader = self.sparkSession.read.format(FORMAT).option("kind", kind)
        if days is not None:
            reader = reader.option("days", ",".join(sorted(d.isoformat() for d in days)))
        if until is not None:
            reader = reader.option("until", until.isoformat())
        return reader.load(self.path)

    def scan(self, kind: str = "raw", days: list[date] | None = None, until: date | None = None) -> DataFrame:
        """History lines as typed columns, parsed in the task that read them."""
        return archives.parsed_history(self.lines(kind, days, until))


def scan(
    files: DataFrame | ArchiveFolder, kind: str = "raw", days: list[date] | None = None, until: date | None = None
) -> DataFrame:
    """History lines of the chosen archives, from either form of them."""
    if isinstance(files, ArchiveFolder):
        return files.scan(kind, days, until)
    return archives.archive_scan(archives.select_archives(files, kind, days, until))
