"""Excel workbooks (``.xlsx``) as a Spark source (A2).

Spark has no Excel reader and no Excel library is installed, so a folder of
workbooks is read as ``binaryFile`` rows (one per workbook, spread over the
cluster) and each task unpacks its workbooks with the standard library: an
``.xlsx`` is a zip of XML parts.  The first worksheet named by the workbook is
streamed row by row; its first row is the header, values arrive as text.

A workbook cannot be split, so one workbook is one task's input; Excel caps
a sheet at about a million rows, which bounds it.  Legacy binary ``.xls``
is not supported.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format
M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
ROWS_AT_ONCE = 5000


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{M}t"))


def _first_sheet(z: zipfile.ZipFile) -> str:
    """Part name of the first sheet that the workbook lists."""
    sheet = ET.fromstring(z.read("xl/workbook.xml")).find(f"{M}sheets/{M}sheet")
    wanted = sheet.get(f"{R}id")
    for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == wanted:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("the workbook has no sheet")


def workbook_rows(data: bytes) -> Iterator[list[str | None]]:
    """The rows of the first worksheet as text cells (missing -> None)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for _, node in ET.iterparse(z.open("xl/sharedStrings.xml")):
                if node.tag == f"{M}si":
                    shared.append(_text(node))
                    node.clear()
        for _, row in ET.iterparse(z.open(_first_sheet(z))):
            if row.tag != f"{M}row":
                continue
            cells: dict[int, str | None] = {}
            at = -1
            for c in row.findall(f"{M}c"):
                at = _col_index(c.get("r")) if c.get("r") else at + 1
                kind, v = c.get("t"), c.find(f"{M}v")
                if kind == "inlineStr":
                    inline = c.find(f"{M}is")
                    value = _text(inline) if inline is not None else None
                elif v is None:
                    value = None
                elif kind == "s":
                    value = shared[int(v.text)]
                elif kind == "b":
                    value = "true" if v.text == "1" else "false"
                else:
                    value = v.text
                cells[at] = value
            yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
            row.clear()


def read_xlsx(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Every column of the workbooks' headers, as text, and ``_source_path``.
    The headers are read first; their union is the schema."""
    from ..session import ship_package
    ship_package(spark)
    content = (spark.read.format("binaryFile")
               .load([paths] if isinstance(paths, str) else list(paths)).select("path", "content"))

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["content"]:
                first = next(workbook_rows(bytes(data)), [])
                yield pd.DataFrame({"name": [h.strip() for h in first if h and h.strip()]})

    names = sorted(r["name"] for r in content.mapInPandas(headers, "name string").distinct().collect())

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(held: list, pos: dict[str, int], path: str) -> pd.DataFrame:
            out = {n: [r[pos[n]] if n in pos and pos[n] < len(r) else None for r in held] for n in names}
            return pd.DataFrame(out | {"_source_path": [path] * len(held)})

        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"]):
                rows = workbook_rows(bytes(data))
                pos = {h.strip(): i for i, h in enumerate(next(rows, [])) if h}
                held: list = []
                for r in rows:
                    held.append(r)
                    if len(held) == ROWS_AT_ONCE:
                        yield frame(held, pos, path)
                        held = []
                if held:
                    yield frame(held, pos, path)

    return content.mapInPandas(parse, ", ".join(f"`{n}` string" for n in [*names, "_source_path"]))


# ---------------------------------------------------------------- writing

def _cell(ref: str, value) -> str:
    if value is None or (isinstance(value, float) and pd.isna(value)):
        return ""
    s = str(value).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{s}</t></is></c>'


def _ref(col: int, row: int) -> str:
    letters = ""
    col += 1
    while col:
        col, rem = divmod(col - 1, 26)
        letters = chr(65 + rem) + letters
    return f"{letters}{row}"


def workbook_bytes(pdf: pd.DataFrame) -> bytes:
    """A minimal one-sheet ``.xlsx`` (header + rows, all inline text)."""
    rows = [list(pdf.columns)] + pdf.astype(object).values.tolist()
    body = "".join(
        f'<row r="{i + 1}">' + "".join(_cell(_ref(j, i + 1), v) for j, v in enumerate(r)) + "</row>"
        for i, r in enumerate(rows))
    parts = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            '</Types>'),
        "_rels/.rels": (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            '</Relationships>'),
        "xl/workbook.xml": (
            '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'),
        "xl/_rels/workbook.xml.rels": (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            '</Relationships>'),
        "xl/worksheets/sheet1.xml": (
            '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{body}</sheetData></worksheet>'),
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, xml in parts.items():
            z.writestr(name, xml)
    return buf.getvalue()


def write_xlsx(df: DataFrame, folder: str, rows_per_book: int = 50_000) -> None:
    """Land ``df`` as a folder of workbooks of at most ``rows_per_book`` rows,
    on any file system: the text sink writes one workbook's bytes per file.
    A zip without a comment ends with a zero byte; that one is the sink's
    separator."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    cols = df.columns

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending: list[pd.DataFrame] = []
        count = 0
        for b in batches:  # stream: hold at most one workbook's rows
            while len(b):
                take = b.iloc[:rows_per_book - count]
                b = b.iloc[len(take):]
                pending.append(take)
                count += len(take)
                if count == rows_per_book:
                    yield pd.DataFrame({"book": [workbook_bytes(pd.concat(pending)[cols])[:-1]]})
                    pending, count = [], 0
        if count:
            yield pd.DataFrame({"book": [workbook_bytes(pd.concat(pending)[cols])[:-1]]})

    (df.mapInPandas(pack, "book binary").select(F.col("book").cast("string")).write
     .option("lineSep", "\0").option("maxRecordsPerFile", 1).text(folder))
