"""Zip archives as a source and a sink of Spark: a member is a row.

Reading lists the archives on the driver, by name and size only. Small archives share a task, and a large one is cut
by byte ranges: a task takes the members that begin in its range, as it does with row groups of Parquet. Each task
reads the list of members itself, and one member at a time.

Writing gives each task archives of its own, of a bounded number of members, below a hidden folder; what finished tasks wrote is moved when all
have ended, so a lost executor or a second attempt leaves nothing behind.

Folders are opened with pyarrow's file systems, so every executor must reach the path.

Defined results: a file that is no archive, and a member that is damaged, encrypted, packed in an unknown way or larger than
`memberBytes`, is a row with `error` and no content; a failure of the storage fails the task, so that Spark tries again. Folders in
an archive aren't rows. Members of one name are several rows, told apart by `place`. An empty folder gives no
rows; a null name is written as an empty one, null content as none.
"""

from __future__ import annotations

import fnmatch
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from lzma import LZMAError

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import text as T

SCHEMA = "archive string, member string, place int, length long, content binary, error string"
PARTITION_BYTES, MEMBER_BYTES = 64 << 20, 1 << 30
#: Members of a written archive, at most.
ARCHIVE_MEMBERS = 1 << 14
TEXT_MEMBERS = (".xml", ".rels", ".txt")
_END = 1 << 62
_NO_ARCHIVE = (zipfile.BadZipFile, NotImplementedError, ValueError, EOFError)
_NO_MEMBER = (*_NO_ARCHIVE, RuntimeError, zlib.error, LZMAError)


@dataclass
class Part(InputPartition):
    """Archives, each with the range of bytes in which a member of this part begins."""

    spans: list[tuple[str, int, int]]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def planned(files: list[tuple[str, int]], target: int) -> list[Part]:
    """Parts of about `target` bytes: small archives together, a large one in several ranges."""
    parts, held, room = [], [], target
    for path, size in sorted(files):
        cuts = max(1, -(-size // target))
        for i in range(cuts):
            low, high = i * size // cuts, (i + 1) * size // cuts
            if held and high - low > room:
                parts.append(Part(held))
                held, room = [], target
            held.append((path, low, high if i + 1 < cuts else _END))
            room -= high - low
    return [*parts, Part(held)] if held else parts


def _visible(path: str, root: str) -> bool:
    return not any(step.startswith(("_", ".")) for step in path.removeprefix(root).split("/") if step)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.pattern = options["path"], options.get("members", "*")
        self.target, self.limit = int(options.get("partitionBytes", PARTITION_BYTES)), int(options.get("memberBytes", MEMBER_BYTES))

    def partitions(self) -> list[Part]:
        store, root = fs.FileSystem.from_uri(self.path)
        top = store.get_file_info(root)
        found = [top] if top.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        return planned([(f.path, f.size) for f in found if f.is_file and (top.is_file or _visible(f.path, root))], self.target) or [Part([])]

    def read(self, partition: Part) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(self.path)
        for path, low, high in partition.spans:
            with store.open_input_file(path) as file:
                try:
                    archive = zipfile.ZipFile(file)
                except _NO_ARCHIVE as e:
                    if low == 0:
                        yield path, None, None, None, None, f"no archive: {e}"
                    continue
                for place, info in enumerate(archive.infolist()):
                    if low <= info.header_offset < high and not info.is_dir() and fnmatch.fnmatchcase(info.filename, self.pattern):
                        yield path, info.filename, place, info.file_size, *self._content(archive, info)

    def _content(self, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        if info.file_size > self.limit:
            return None, f"more than {self.limit} bytes"
        damage = (*_NO_MEMBER, OSError) if info.compress_type == zipfile.ZIP_BZIP2 else _NO_MEMBER
        try:
            return archive.read(info), None
        except damage as e:
            return None, f"damaged member: {e}"


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.hidden = path, overwrite, f"_open-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        rows = iter(iterator)
        first = next(rows, None)
        if first is None:
            return Written([])
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(f"{root}/{self.hidden}", recursive=True)
        names = []
        while first is not None:
            # A reader holds an archive's list of members, so a full one is followed by another.
            names.append(f"{uuid.uuid4().hex}.zip")
            with store.open_output_stream(f"{root}/{self.hidden}/{names[-1]}") as out, zipfile.ZipFile(out, "w") as archive:
                while first is not None and len(archive.filelist) < ARCHIVE_MEMBERS:
                    archive.writestr(zipfile.ZipInfo(first["member"] or ""), bytes(first["content"] or b""), zipfile.ZIP_DEFLATED)
                    first = next(rows, None)
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        old = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.is_file and _visible(f.path, root)] if self.overwrite else []
        for m in messages:
            for name in m.names if m else ():
                store.move(f"{root}/{self.hidden}/{name}", f"{root}/{name}")
        for path in old:
            store.delete_file(path)
        self._tidy(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy(*fs.FileSystem.from_uri(self.path))

    def _tidy(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/{self.hidden}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.hidden}")


class ArchiveMembers(DataSource):
    """Options: path, members (a pattern of names), partitionBytes, memberBytes."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if not {"member", "content"} <= set(schema.names):
            raise ValueError("an archive is written from the columns member and content")
        return _Writer(self.options["path"], overwrite)


def members(spark: SparkSession, path: str, pattern: str = "*", partition_bytes: int = PARTITION_BYTES, member_bytes: int = MEMBER_BYTES) -> DataFrame:
    """archive, member, place, length, content, error of all archives below a folder."""
    spark.dataSource.register(ArchiveMembers)
    options = {"members": pattern, "partitionBytes": partition_bytes, "memberBytes": member_bytes}
    return spark.read.format("archive_members").options(**options).load(path)


def write(rows: DataFrame, path: str, mode: str = "append") -> None:
    """member and content of rows as archives, one or more of each task that has rows."""
    rows.sparkSession.dataSource.register(ArchiveMembers)
    plain = rows.select("member", F.col("content").cast("binary").alias("content"))
    plain.write.format("archive_members").mode(mode).save(path)


def texts(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """archive, text: what the XML and text members of an archive say, without tags, in the order they stand in.

    Bytes that aren't UTF-8 are left out. An archive without such members, or that is none, has a null text. An archive's
    text is one row, so members are read by pattern where archives are larger than a task can hold.
    """
    wanted = F.coalesce(F.col("member").rlike(r"\.(" + "|".join(s[1:] for s in TEXT_MEMBERS) + ")$"), F.lit(False)) & F.col("content").isNotNull()
    plain = F.regexp_replace(F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "�", ""), "<[^>]+>", " ")
    said = F.when(wanted, F.struct("place", T.collapsed(plain).alias("x")))
    out = rows.groupBy("archive").agg(F.array_sort(F.collect_list(said)).alias("s"))
    text = T.collapsed(F.array_join(F.col("s.x"), " "))
    return out.select("archive", F.when(F.size("s") > 0, F.substring(text, 1, limit) if limit else text).alias("text"))
