"""Excel workbooks as a PySpark data source: all cells as strings, one sheet per read.

Only the standard library is used. A workbook is one partition (its format
cannot be split). Options: path, sheet (name or 0-based number; default 0).
``write_workbook`` writes small result sheets on the driver; Parquet is the sink
for large results.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

# XML names of the format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _sheet_path(book: zipfile.ZipFile, sheet: str | int) -> str:
    root = ET.fromstring(book.read("xl/workbook.xml"))
    sheets = [(s.get("name"), s.get(f"{_REL}id")) for s in root.iter(f"{_MAIN}sheet")]
    if str(sheet).isdigit():
        if int(sheet) >= len(sheets):
            raise ValueError(f"there is no sheet number {sheet}")
        wanted = sheets[int(sheet)][1]
    else:
        wanted = dict(sheets).get(sheet)
        if wanted is None:
            raise ValueError(f"there is no sheet named {sheet}")
    links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links.iter(f"{_PACKAGE}Relationship") if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _plain(number: str) -> str:
    return number[:-2] if number.endswith(".0") else number


def rows(path: str, sheet: str | int = 0) -> list[list[str | None]]:
    """All rows of a sheet, the header first; blank cells are None."""
    with zipfile.ZipFile(path.removeprefix("file://")) as book:
        shared = [_text(x) for x in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in book.namelist() else []
        out = []
        for row in ET.fromstring(book.read(_sheet_path(book, sheet))).iter(f"{_MAIN}row"):
            cells: list[str | None] = []
            for c in row.iter(f"{_MAIN}c"):
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                value = c.find(f"{_MAIN}v")
                kind = c.get("t")
                if kind == "inlineStr":
                    cells[at] = _text(c)
                elif value is not None and value.text is not None:
                    cells[at] = shared[int(value.text)] if kind == "s" else value.text if kind == "str" else _plain(value.text)
            out.append(cells)
    return out


class XlsxReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.sheet, self.size = options["path"], options.get("sheet", "0"), len(schema.fields)

    def partitions(self):
        return [InputPartition(self.path)]

    def read(self, partition):
        for cells in rows(partition.value, self.sheet)[1:]:
            if any(c is not None for c in cells):
                yield tuple((cells + [None] * self.size)[: self.size])


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        head = rows(self.options["path"], self.options.get("sheet", "0"))[:1] or [[]]
        return StructType([StructField(c or f"column{k + 1}", StringType()) for k, c in enumerate(head[0])])

    def reader(self, schema):
        return XlsxReader(self.options, schema)


def read_xlsx(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    spark.dataSource.register(XlsxSource)
    return spark.read.format("xlsx").option("sheet", str(sheet)).load(path)


def _letters(n: int) -> str:
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def _cell(at: int, line: int, value) -> str:
    if value is None:
        return ""
    ref = f'r="{_letters(at)}{line}"'
    if isinstance(value, bool):
        return f'<c {ref} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {ref}><v>{value}</v></c>"
    return f'<c {ref} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def write_workbook(path: str, sheets: dict[str, tuple[list[str], Iterable[tuple]]]) -> None:
    """Sheets by name: a header and rows, streamed into the file."""
    names = list(sheets)
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main = _MAIN[1:-1]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(len(names)))
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>')
        office = _REL[1:-1]
        book.writestr("_rels/.rels", f'{head}<Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(names))
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k + 1}" Type="{office}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(names)))
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACKAGE[1:-1]}">{links}</Relationships>')
        for k, name in enumerate(names):
            header, body = sheets[name]
            with book.open(f"xl/worksheets/sheet{k + 1}.xml", "w") as out:
                out.write(f'{head}<worksheet xmlns="{main}"><sheetData>'.encode())
                for line, values in enumerate([tuple(header), *body] if isinstance(body, list) else _chain(header, body), 1):
                    cells = "".join(_cell(at, line, v) for at, v in enumerate(values))
                    out.write(f'<row r="{line}">{cells}</row>'.encode())
                out.write(b"</sheetData></worksheet>")


def _chain(header, body):
    yield tuple(header)
    yield from body
