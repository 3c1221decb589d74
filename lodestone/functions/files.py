"""What a file is, from its first bytes; columns over the content that `binaryFile` reads."""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: First bytes in hex, and the category that they stand for, in the order of the test.
SIGNATURES = (
    ("25504446", "pdf"),
    ("D0CF11E0A1B1", "ole2"),
    ("504B0304", "zip"),
    ("FFD8FF", "image"),
    ("89504E470D0A1A0A", "image"),
    ("474946383761", "image"),
    ("474946383961", "image"),
    ("424D", "image"),
    ("49492A00", "image"),
    ("4D4D002A", "image"),
    ("52494646", "riff"),
    ("7B5C727466", "word"),
    ("3C3F786D6C", "xml"),
    ("EFBBBF3C3F786D6C", "xml"),
    ("FFFE3C3F786D6C", "xml"),
    ("FEFF3C3F786D6C", "xml"),
    ("308006092A864886F70D0107", "pkcs7"),
)
#: Stream names of a compound file and what they tell, in the order of the test.
OLE2_STREAMS = (
    ("Workbook", "excel"),
    ("WordDocument", "word"),
    ("Book", "excel"),
    ("PowerPoint Document", "word"),
    ("1Table", "word"),
    ("0Table", "word"),
    ("_xlwd.MSExcelWorkspace", "excel"),
)
#: Media types in an archive.
MEDIA_TYPES = (
    ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", "word"),
    ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "excel"),
    ("application/vnd.oasis.opendocument.text", "word"),
    ("application/vnd.oasis.opendocument.spreadsheet", "excel"),
)
#: Bytes looked at for the text test, and the share of NUL that ends it.
TEXT_BYTES, NUL_SHARE = 8192, 0.10
GARBAGE_BYTES, GARBAGE_LINES = 3072, 2


def head(content: Column, n: int) -> Column:
    return F.hex(F.substring(content, 1, n))


def signature(content: Column) -> Column:
    """Category by the first bytes; text if few are NUL; null if empty or neither."""
    first = head(content, 16)
    out = F.when(likely_text(content), F.lit("text"))
    for magic, name in reversed(SIGNATURES):
        out = F.when(first.startswith(magic), F.lit(name)).otherwise(out)
    return F.when(F.octet_length(content) > 0, out)


def ole2_kind(content: Column) -> Column:
    """word or excel by the stream names (UTF-16LE) in the first 64 KB, the first that stands there; null for files under 512 bytes."""
    shown, out = head(content, 65536), F.lit(None).cast("string")
    for name, kind in reversed(OLE2_STREAMS):
        out = F.when(F.contains(shown, F.lit(name.encode("utf-16-le").hex().upper())), kind).otherwise(out)
    return F.when(F.octet_length(content) >= 512, out)


def riff_kind(content: Column) -> Column:
    return F.when(F.hex(F.substring(content, 9, 4)) == "57454250", "image")


@F.pandas_udf(StringType())
def zip_kind(content: pd.Series) -> pd.Series:
    """word or excel by an archive's content types, member names, media type or manifest; null for other or broken archives."""

    def named(archive: zipfile.ZipFile, member: str, kinds: tuple) -> str | None:
        try:
            text = archive.read(member).decode("utf-8", "replace")
        except (KeyError, OSError, RuntimeError, NotImplementedError, zipfile.BadZipFile, zlib.error):
            return None
        return next((kind for mark, kind in kinds if mark in text or mark in text.lower()), None)

    def of(data: bytes | None) -> str | None:
        try:
            archive = zipfile.ZipFile(io.BytesIO(data or b""))
        except (zipfile.BadZipFile, ValueError, OSError):
            return None
        with archive:
            members = archive.namelist()
            by_folder = next((kind for folder, kind in (("word/", "word"), ("xl/", "excel")) if any(m.startswith(folder) for m in members)), None)
            return (
                named(archive, "[Content_Types].xml", MEDIA_TYPES) or by_folder or named(archive, "mimetype", MEDIA_TYPES)
                or named(archive, "META-INF/manifest.xml", (("text", "word"), ("spreadsheet", "excel")))
            )

    return content.map(of)


def kind(content: Column) -> Column:
    """signature, with containers named by what they hold; null for a container of something else.

    The archives' bytes go to Python, those of other files don't.
    """
    first = signature(content)
    archive = zip_kind(F.when(first == "zip", content))
    return F.when(first == "zip", archive).when(first == "ole2", ole2_kind(content)).when(first == "riff", riff_kind(content)).otherwise(first)


def likely_text(content: Column) -> Column:
    """At most a tenth of the first bytes are NUL; an 8-bit code page decodes any others."""
    shown = F.regexp_replace(head(content, TEXT_BYTES), "(..)", "$1 ")
    n = F.least(F.octet_length(content), F.lit(TEXT_BYTES))
    return F.coalesce(F.regexp_count(shown, F.lit(r"00 ")) <= n * NUL_SHARE, F.lit(False))


def is_garbage(content: Column) -> Column:
    """A text file too small, or of too few lines, to be worth reading."""
    lines = F.size(F.split(F.trim(F.decode(content, "UTF-8")), r"\r\n|\r|\n"))
    return F.coalesce((F.octet_length(content) <= GARBAGE_BYTES) | (lines <= GARBAGE_LINES), F.lit(False))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def is_marked(name: Column, part: int = 8) -> Column:
    """Whether the eighth part of a name between underscores is 1."""
    return F.coalesce(F.get(F.split(name, "_"), part - 1) == "1", F.lit(False))


def category(path: Column, categories: dict[str, tuple[str, ...]], rest: str | None = None) -> Column:
    """The category that lists a path's extension, with its dot and in lower case; `rest` for others and for none.

    An extension that two categories list belongs to the first.
    """
    of = {e: name for name, listed in reversed(categories.items()) for e in listed}
    if not of:
        return F.lit(rest).cast("string")
    table = F.create_map(*(F.lit(x) for kv in of.items() for x in kv))
    return F.coalesce(F.element_at(table, extension(path)), F.lit(rest))
