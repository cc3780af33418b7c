"""A batch data source for .xlsx workbooks: ``spark.read.format("xlsx")``.

Sheets are read as strings, one partition for each sheet.  Options: sheet (number from 0, or name; all by default),
headerRow (1 by default), skipSheets (how many to leave out at the front), columns (the header, comma separated,
if given).  The sheet's name comes as the column _sheet.  The workbook must be readable at its path by executors."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(reference: str) -> int:
    """0 for A1, 26 for AA7."""
    n = 0
    for ch in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheet_files(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, file) of the sheets in order."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    return [(s.get("name"), (t if (t := targets[s.get(_REL)]).startswith("xl/") else "xl/" + t.lstrip("/").removeprefix("xl/"))) for s in sheets]


def sheet_rows(path: str, file: str) -> Iterator[list[str | None]]:
    """Rows of a sheet as strings, gaps as None; rows that the file leaves out are empty."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        at = 0
        for _, row in ElementTree.iterparse(book.open(file)):
            if row.tag != f"{_MAIN}row":
                continue
            number = int(row.get("r") or at + 1)
            for _ in range(number - at - 1):
                yield []
            at, cells = number, []
            for i, c in enumerate(row.iter(f"{_MAIN}c")):
                place = column_number(c.get("r")) if c.get("r") else i
                cells += [None] * (place - len(cells))
                value = c.find(f"{_MAIN}v")
                if c.get("t") == "inlineStr":
                    cells.append("".join(t.text or "" for t in c.iter(f"{_MAIN}t")))
                elif value is None or value.text is None:
                    cells.append(None)
                else:
                    cells.append(shared[int(value.text)] if c.get("t") == "s" else value.text)
            yield cells
            row.clear()


class _Sheet(InputPartition):
    def __init__(self, name: str, file: str) -> None:
        self.name, self.file = name, file


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.header, self.width = options["path"], int(options.get("headerrow", 1)), len(schema) - 1
        self.sheet, self.skip = options.get("sheet"), int(options.get("skipsheets", 0))

    def partitions(self) -> list[_Sheet]:
        return [_Sheet(*s) for s in chosen(self.path, self.sheet, self.skip)]

    def read(self, partition: _Sheet) -> Iterator[tuple]:
        for i, row in enumerate(sheet_rows(self.path, partition.file)):
            if i >= self.header and any(v not in (None, "") for v in row):
                cells = row[: self.width] + [None] * (self.width - len(row))
                yield (partition.name, *cells)


def chosen(path: str, sheet: str | None, skip: int) -> list[tuple[str, str]]:
    with zipfile.ZipFile(path) as book:
        sheets = sheet_files(book)[skip:]
    if sheet is None:
        return sheets
    return [s for i, s in enumerate(sheets) if str(i) == sheet or s[0] == sheet]


class XlsxDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        options = {k.lower(): v for k, v in self.options.items()}
        if names := options.get("columns"):
            header = names.split(",")
        else:
            first = chosen(options["path"], options.get("sheet"), int(options.get("skipsheets", 0)))[0]
            rows = sheet_rows(options["path"], first[1])
            header = next(r for i, r in enumerate(rows, 1) if i == int(options.get("headerrow", 1)))
        names = [f"_c{i}" if not (n or "").strip() else n.strip() for i, n in enumerate(header)]
        return ", ".join(["`_sheet` string", *(f"`{n.replace('`', '')}` string" for n in names)])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()}, schema)


def register_xlsx(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxDataSource)
