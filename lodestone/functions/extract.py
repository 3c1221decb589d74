"""Texts of files: one reader for each kind, and the choice among them.

A reader makes a struct of text and error from a column of bytes. `extracted` picks a reader for each file by its kind,
else by its name's extension, in one projection: the table is read once, and a reader in Python sees the bytes of
its own files only.
"""

from __future__ import annotations

from collections.abc import Callable
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files as kinds
from . import text as T

Reader = Callable[[Column], Column]
RESULT = "text string, error string"
#: The name space of an OpenDocument body, elements whose text counts, and the most characters of an XML text.
OFFICE = "urn:oasis:names:tc:opendocument:xmlns:office:1.0"
SPOKEN = ("p", "span", "h", "list-item")
XML_CHARS = 8000


class _Document:
    """One pass over an XML file: the lines of an OpenDocument body, or the paths of any other file.

    Open elements are a stack. An element's line is what it says before its first child, so it is complete when a
    child begins or the element ends, which is also the order of the document.
    """

    def __init__(self) -> None:
        self.office = False
        self.bodies: dict[bool, list[str]] = {}
        self.paths: set[str] = set()
        self._body: list[str] | None = None
        self._stack: list[tuple[str, list[str] | None]] = []
        self._parser = expat.ParserCreate(namespace_separator="}")
        self._parser.StartElementHandler, self._parser.EndElementHandler = self._begin, self._end
        self._parser.CharacterDataHandler = self._said

    def read(self, data: bytes) -> _Document:
        self._parser.Parse(data, True)
        return self

    def _line(self) -> None:
        path, said = self._stack[-1]
        if said is not None:
            self._stack[-1] = path, None
            if line := "".join(said).strip():
                self._body.append(line)

    def _begin(self, name: str, attributes: dict[str, str]) -> None:
        space, _, local = name.rpartition("}")
        if not self._stack:
            self.office = space == OFFICE
        else:
            self._line()
        if len(self._stack) == 1 and local == "body" and (space == OFFICE) not in self.bodies:
            self._body = self.bodies[space == OFFICE] = []
        path = ""
        if not self.office:
            full = lambda n: "{" + n if "}" in n else n
            path = f"{self._stack[-1][0] if self._stack else ''}/{full(name)}"
            self.paths.add(path)
            self.paths.update(f"{path}/@{full(a)}" for a in attributes)
        self._stack.append((path, [] if self._body is not None and local in SPOKEN else None))

    def _said(self, data: str) -> None:
        if self._stack[-1][1] is not None:
            self._stack[-1][1].append(data)

    def _end(self, name: str) -> None:
        self._line()
        self._stack.pop()
        if len(self._stack) == 1:
            self._body = None


def _spoken(document: _Document, limit: int) -> tuple[str | None, str | None]:
    lines = document.bodies.get(True, document.bodies.get(False))
    if not lines:
        return None, "no body" if lines is None else "no text"
    return "\n".join(lines)[:limit], None


def _in_python(one: Callable[[bytes], tuple[str | None, str | None]]) -> Reader:
    """A reader that calls one(bytes) for each file that isn't null."""

    @F.pandas_udf(RESULT)
    def read(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if data is None else one(data) for data in column], columns=["text", "error"])

    return read


def open_document_text(content: Column, limit: int = XML_CHARS) -> Column:
    """Lines of the paragraphs, headings, spans and list items of a flat OpenDocument file, each what it says before its first child.

    The office body counts, else the first body of any name space. Without a body or a line, or where XML doesn't parse,
    text is null and error says why; null stays null in both.
    """

    def one(data: bytes) -> tuple[str | None, str | None]:
        try:
            return _spoken(_Document().read(data), limit)
        except (expat.ExpatError, ValueError, LookupError) as e:
            return None, f"no XML: {e}"

    return _in_python(one)(content)


def xml_text(content: Column, limit: int = XML_CHARS) -> Column:
    """The lines of an OpenDocument file; of any other XML the sorted set of its element and @attribute paths; the first characters where XML doesn't parse."""

    def one(data: bytes) -> tuple[str | None, str | None]:
        try:
            document = _Document().read(data)
        except (expat.ExpatError, ValueError, LookupError):
            return data.decode("utf-8", "replace")[:limit], None
        return _spoken(document, limit) if document.office else (" ".join(sorted(document.paths)), None)

    return _in_python(one)(content)


def _decoded(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def _whole(text: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(None).cast("string").alias("error"))


def plain_text(content: Column) -> Column:
    """The file, trimmed; bytes that aren't UTF-8 are replaced."""
    return _whole(T.stripped(_decoded(content)))


def delimited_text(content: Column, separator: str = ",") -> Column:
    """Rows as lines, cells trimmed and joined by a bar, empty ones left out."""
    lines = F.transform(F.split(_decoded(content), r"\r?\n"), lambda x: T.csv_line(F.split(x, F.lit(separator))))
    return _whole(F.array_join(F.filter(lines, lambda x: x != ""), "\n"))


#: Readers by kind and by extension. Both are parameters of `extracted`.
BY_KIND: dict[str, Reader] = {"xml": xml_text}
BY_EXTENSION: dict[str, Reader] = {".txt": plain_text, ".csv": delimited_text, **dict.fromkeys((".xml", ".xsd", ".xsl", ".xslt", ".wsdl", ".fodt"), xml_text)}


def extracted(
    files: DataFrame, path: str = "path", content: str = "content", kind: Column | None = None, by_kind: dict[str, Reader] | None = None, by_extension: dict[str, Reader] | None = None,
) -> DataFrame:
    """files with kind, text and error, by the reader of their kind, else of their extension.

    A file that neither names has a null text and says so in `error`, also one with null bytes or an empty name. Input columns named
    like the results are replaced; `kind` may be made of them.
    """
    by_kind, by_extension = BY_KIND if by_kind is None else by_kind, BY_EXTENSION if by_extension is None else by_extension
    end = F.coalesce(kinds.extension(F.col(path)), F.lit(""))
    rows = files.withColumn("_kind", kinds.kind(F.col(content)) if kind is None else kind)
    known = F.coalesce(F.col("_kind").isin(*by_kind), F.lit(False))
    route = F.when(known, F.concat(F.lit("kind "), F.col("_kind"))).when(end.isin(*by_extension), F.concat(F.lit("end "), end))
    rows = rows.withColumn("_route", route)
    routes: dict[Reader, list[str]] = {}
    for prefix, table in (("kind ", by_kind), ("end ", by_extension)):
        for name, reader in table.items():
            routes.setdefault(reader, []).append(prefix + name)
    read = F.lit(None).cast("struct<text:string,error:string>")
    for reader, names in routes.items():
        mine = F.coalesce(F.col("_route").isin(*names), F.lit(False))
        read = F.when(mine, reader(F.when(mine, F.col(content)))).otherwise(read)
    rows = rows.withColumn("_read", read)
    missed = F.when(F.col("_route").isNull(), F.concat(F.lit("Unknown format: "), end)).when(F.col(content).isNull(), F.lit("no content"))
    out = rows.drop(*({"kind", "text", "error"} & set(files.columns) - {path, content}))
    return out.withColumns({"kind": F.col("_kind"), "text": F.col("_read.text"), "error": F.coalesce(missed, F.col("_read.error"))}).drop("_kind", "_route", "_read")
