"""Tables to files.  Parquet is the deliverable; CSV, JSON lines and workbooks are for people."""

from __future__ import annotations

import json
import os
import tempfile
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined
from ..operators.phones import contacts
from ..operators.state import split_ok

#: Rows that a sheet can hold below its header.
SHEET_ROWS = 1_048_575


def as_csv_text(rows: DataFrame) -> DataFrame:
    """All columns as text: null as empty, booleans as True and False, arrays separated by semicolons."""

    def text(name: str, kind: str) -> Column:
        own = F.col(f"`{name}`")
        if kind.startswith("array"):
            return joined(own.cast("array<string>"))
        return F.coalesce(F.initcap(own.cast("string")) if kind == "boolean" else own.cast("string"), F.lit(""))

    return rows.select(*[text(c, k).alias(c) for c, k in rows.dtypes])


def write_csv(rows: DataFrame, path: str, mark: bool = True) -> None:
    """CSV files with a header; with a byte order mark unless told otherwise, as sheet programs like it."""
    own = as_csv_text(rows)
    if mark and own.columns:
        first = own.columns[0]
        own = own.withColumnRenamed(first, f"﻿{first}")
    own.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json_lines(rows: DataFrame, path: str, keys: list[str]) -> None:
    """JSON lines in the order of the keys; Spark's commit makes the whole folder appear at once."""
    rows.orderBy(*keys).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def page_tables(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contacts of good pages and errors of the others, as text."""
    good, failed = split_ok(pages)
    return (
        as_csv_text(contacts(good.select("file", "page", "extracted")).select("file", "page", "name", "company", "title", "phones", "emails", "websites", "wechat_ids", "qq_ids", "address")),
        as_csv_text(failed.select("file", "page", "error", "http_like_code", "request_id")),
    )


def write_pages(pages: DataFrame, folder: str) -> None:
    good, failed = page_tables(pages)
    write_csv(good, f"{folder}/ocr_contacts.csv")
    write_csv(failed, f"{folder}/ocr_failed.csv")


def write_cards(cards: DataFrame, folder: str) -> None:
    """Cards as JSON lines and their contacts as CSV."""
    write_json_lines(cards, f"{folder}/ocr_card_results.jsonl", ["file", "page", "card_no"])
    write_csv(contacts(cards), f"{folder}/ocr_card_contacts.csv")


def write_json_atomically(value: dict, path: str) -> None:
    """A small JSON file on the driver, whole or not at all."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder, suffix=".part")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)


_TYPES = (
    '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" '
    'ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>'
)
_SHEET_TYPE = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
_RELATIONS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """One workbook with a sheet per table, a row at a time through the driver.

    A sheet cannot hold more than SHEET_ROWS rows; a larger table is an error and belongs
    in Parquet or CSV.
    """
    for name, rows in sheets.items():
        if rows.limit(SHEET_ROWS + 1).count() > SHEET_ROWS:
            raise ValueError(f"{name} has more rows than a sheet can hold; write it as Parquet or CSV")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        numbers = range(1, len(sheets) + 1)
        book.writestr("[Content_Types].xml", _TYPES.format("".join(map(_SHEET_TYPE.format, numbers))))
        book.writestr("_rels/.rels", _RELATIONS.format(f'<Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/>'))
        links = "".join(f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
        book.writestr("xl/_rels/workbook.xml.rels", _RELATIONS.format(links))
        named = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{named}</sheets></workbook>')
        for i, rows in enumerate(sheets.values(), 1):
            with book.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                f.write(_row(1, rows.columns).encode())
                for n, row in enumerate(as_csv_text(rows).toLocalIterator(), 2):
                    f.write(_row(n, row).encode())
                f.write(b"</sheetData></worksheet>")


def _row(number: int, values) -> str:
    def name(at: int) -> str:
        letters = ""
        while at:
            at, rest = divmod(at - 1, 26)
            letters = chr(65 + rest) + letters
        return letters

    cells = "".join(f'<c r="{name(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(_printable(v or ""))}</t></is></c>' for i, v in enumerate(values, 1))
    return f'<row r="{number}">{cells}</row>'


def _printable(text: str) -> str:
    """Without control characters that XML cannot hold."""
    return "".join(c for c in text if c >= " " or c in "\t\n\r")
