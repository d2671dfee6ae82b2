"""Tables from files: JSON lines, CSV, listings, page images and sheets.

Readers are Spark's own; a file's place and line order come along as columns where
an operator needs an order.  Python reads only formats that Spark has no reader for,
one file per record, in tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed
from ..functions.text import card_key, fingerprint
from ..operators.merge import partition_dim
from ..operators.state import keep_last, logged


def json_lines(spark: SparkSession, paths: str | list[str], schema: str = schemas.PAGE, mode: str = "FAILFAST") -> DataFrame:
    """Rows of JSON lines with an ordinal ``ord`` of file and position; blank lines are skipped.

    A malformed line is an error; mode PERMISSIVE keeps it as a row of nulls instead.
    """
    rows = spark.read.schema(schema).option("mode", mode).json(paths)
    return rows.withColumn("ord", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))


def json_lines_apart(spark: SparkSession, paths: str | list[str], schema: str = schemas.PAGE) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines with ``ord``, and (path, ord, text) of the lines that are no JSON of the schema; blank lines are skipped."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("id"))
    lines = spark.read.text(paths).select("value", place.alias("ord")).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _malformed string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    rows = lines.select("value", "ord", parsed.alias("row"))
    good = rows.where("row IS NOT NULL AND row._malformed IS NULL").select("row.*", "ord").drop("_malformed")
    return good, rows.where("row IS NULL OR row._malformed IS NOT NULL").select(F.col("ord.file_path").alias("path"), "ord", F.col("value").alias("text"))


def lines_log(good: DataFrame, bad: DataFrame, run: str, input_fingerprint: str) -> DataFrame:
    """What json_lines_apart() gives as rows of a run log, a unit for each line."""
    error = F.concat(F.lit("malformed line: "), F.left("text", F.lit(200)))
    both = good.select("ord", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")).unionByName(bad.select("ord", F.lit(False).alias("ok"), error.alias("error")))
    unit = F.concat_ws(":", "ord.file_path", F.col("ord.file_block_start").cast("string"), F.col("ord.id").cast("string"), F.col("ok").cast("string"))
    return logged(both.select(F.lit(run).alias("run"), F.lit(input_fingerprint).alias("input_fingerprint"), unit.alias("unit"), "ok", "error"))


def _is_there(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def parquet_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, and no rows of the schema where the path does not exist."""
    return spark.read.parquet(path) if _is_there(spark, path) else spark.createDataFrame([], schema)


def json_lines_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As json_lines, and no rows where the path does not exist; the path may be in any store that Spark reads."""
    if _is_there(spark, path):
        return json_lines(spark, path, schema)
    return spark.createDataFrame([], schema).withColumn("ord", F.lit(None).cast("struct<file_path:string,file_block_start:bigint,id:bigint>"))


def pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The last result of each (file, page); rows without a page are dropped."""
    return keep_last(json_lines(spark, paths, schemas.PAGE), ["file", "page"], "ord").drop("ord")


def good_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every good page with the lines and rects that layout.cards() reads."""
    none = F.array()
    return json_lines(spark, paths, schemas.PAGE).where("ok").select(
        "file", "page",
        F.coalesce("line_texts", none.cast("array<string>")).alias("line_texts"),
        F.coalesce("raw.data.line_rects", none.cast(f"array<{schemas.RECT}>")).alias("line_rects"),
    )


def partition_cards(
    spark: SparkSession, root: str, partitions: list[tuple[str, str]] | None = None, only: str | None = None, dataset: str = fixed.DATASET, file: str = "ocr_card_results.jsonl"
) -> DataFrame:
    """Cards with text of all partitions, or of the one with a label, keyed.

    Only the paths of wanted partitions are read; a missing file is an error.
    """
    wanted = [p for p in (fixed.PARTITIONS if partitions is None else partitions) if only is None or p[1] == only]
    rows = json_lines(spark, [f"{root.rstrip('/')}/{run}/{file}" for run, _ in wanted], schemas.CARD).where("has_text")
    run = F.element_at(F.split(F.col("ord.file_path"), "/"), -2)
    # a few rows that the caller has listed
    labelled = rows.withColumn("run_name", run).join(F.broadcast(partition_dim(spark, wanted)).drop("ord"), "run_name")
    return labelled.withColumn("source_dataset", F.lit(dataset)).withColumn("card_key", card_key("source_label", "file", "page", "card_no"))


def results(spark: SparkSession, path: str) -> DataFrame:
    """The last standardised row of each card; no rows where there is no file yet."""
    return keep_last(json_lines_if_there(spark, path, schemas.STANDARD), ["card_key"], "ord").drop("ord")


def csv_rows(spark: SparkSession, paths: str | list[str], schema: str | None = None, encoding: str | None = None, lines: bool = True) -> DataFrame:
    """CSV with a header, all columns text; each file is read as UTF-8 if all its lines are that, else as GB18030.

    Which files are which is found by a pass over their lines that sends back names; with an
    encoding given there is no such pass.  ``lines`` says that fields may hold line ends, which makes each file
    one task; without it large files are split.  Needs ``spark.sql.legacy.javaCharsets`` for GB18030.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)

    def read(own: list[str], encoding: str) -> DataFrame:
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", lines).option("encoding", encoding)
        return (reader.schema(schema) if schema else reader).csv(own)

    if encoding:
        return read(listed, encoding)
    every = [r[0] for r in spark.read.format("binaryFile").load(listed).select("path").collect()]  # names only, as Spark lists them itself
    lines_of = spark.read.text(listed).select(F.col("_metadata.file_path").alias("path"), F.is_valid_utf8("value").alias("utf8"))
    others = {r[0].split(":", 1)[-1].lstrip("/") for r in lines_of.where("NOT utf8").select("path").distinct().collect()}
    kinds: dict[str, list[str]] = {}
    for path in every:
        kinds.setdefault("GB18030" if path.split(":", 1)[-1].lstrip("/") in others else "UTF-8", []).append(path)
    found = [read(own, kind) for kind, own in sorted(kinds.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else spark.createDataFrame([], schema or schemas.CONTACT)


def listed(spark: SparkSession, folder: str, suffixes: list[str] | None = None) -> DataFrame:
    """(path, length, modified) of a folder's files with the suffixes, in any case, not of folders in it; no contents are read."""
    pattern = "|".join(suffixes or fixed.IMAGE_SUFFIXES)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return files.where(F.lower("path").rlike(rf"\.({pattern})$")).select("path", "length", F.col("modificationTime").alias("modified"))


def inputs(spark: SparkSession, folder: str, suffixes: list[str]) -> DataFrame:
    """(path, run, input_fingerprint) of a folder's input files: run is the name, the fingerprint changes with size and time."""
    files = listed(spark, folder, suffixes)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("run"), fingerprint("path", "length", "modified").alias("input_fingerprint"))


def pdf_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, page, content, error): one-page documents; a file that can't be read is one row with an error.  Needs pypdf on executors."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    from pypdf import PdfReader, PdfWriter

                    for i, page in enumerate(PdfReader(io.BytesIO(content)).pages, 1):
                        writer, out = PdfWriter(), io.BytesIO()
                        writer.add_page(page)
                        writer.write(out)
                        yield _page(path, i, out.getvalue(), None)
                except Exception as e:  # noqa: BLE001  a bad file is a row
                    yield _page(path, None, None, f"{type(e).__name__}: {e}")

    def _page(path, page, content, error) -> pa.RecordBatch:
        return pa.record_batch([pa.array([path], pa.string()), pa.array([page], pa.int32()), pa.array([content], pa.binary()), pa.array([error], pa.string())], ["path", "page", "content", "error"])

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(split, "path string, page int, content binary, error string")


def as_jpeg(path: Column, content: Column) -> Column:
    """HEIC and HEIF images as JPEG (null without the library for them), other contents unchanged."""

    @F.arrow_udf("binary")
    def converted(paths: pa.Array, contents: pa.Array) -> pa.Array:
        def one(p: str, c: bytes) -> bytes | None:
            if not p.lower().endswith((".heic", ".heif")):
                return c
            try:
                import pillow_heif
                from PIL import Image
            except ImportError:
                return None
            pillow_heif.register_heif_opener()
            out = io.BytesIO()
            Image.open(io.BytesIO(c)).convert("RGB").save(out, "JPEG", quality=95)
            return out.getvalue()

        return pa.array([one(p, c) for p, c in zip(paths.to_pylist(), contents.to_pylist())], pa.binary())

    return converted(path, content)


_CELL = re.compile("([A-Z]+)")
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


#: Bytes of a workbook for which a task of its own reads rows, and rows in a row that one task reads.
PART_BYTES, STRIPE = 1 << 21, 1024


def _sheet_rows(content: bytes, sheet: str, part: int = 0, parts: int = 1) -> Iterator[tuple[int, dict[str, str]]]:
    """(number, {header: text}) of the rows of a sheet that belong to a part, read as a stream; other rows are passed over."""
    book = zipfile.ZipFile(io.BytesIO(content))
    names = {x.get("name"): x.get(_REL) for x in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
    links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[names[sheet]].lstrip("/")
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    header: list[str] | None = None
    number = -1
    with book.open(target if target.startswith("xl/") else f"xl/{target}") as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != f"{_MAIN}row":
                continue
            if header is not None:
                number += 1
                if number // STRIPE % parts != part:
                    row.clear()
                    continue
            cells: dict[int, str] = {}
            for cell in row.iter(f"{_MAIN}c"):
                at = 0
                for letter in _CELL.match(cell.get("r", "A"))[1]:
                    at = at * 26 + ord(letter) - 64
                value = cell.find(f"{_MAIN}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if cell.get("t") == "inlineStr" else (value.text or "") if value is not None else ""
                cells[at] = shared[int(text)] if cell.get("t") == "s" and text else text
            row.clear()
            if header is None:
                header = [cells.get(i, "") for i in range(1, max(cells, default=0) + 1)]
            else:
                yield number, {h: cells.get(i, "") for i, h in enumerate(header, 1)}


def sheet_rows(spark: SparkSession, paths: str | list[str], columns: list[str], sheet: str = fixed.PHONE_SHEET) -> DataFrame:
    """Rows of a workbook's sheet as text: path, ord (row number) and the columns asked for, empty where the sheet lacks them.

    Blank rows are kept; merge.not_blank() drops them.  A large workbook goes to several tasks, each of which reads its stripes of rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, part, parts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held: list[list] = []
                for i, row in _sheet_rows(content, sheet, part, parts):
                    held.append([path, i, *(row.get(c, "") for c in columns)])
                    if len(held) == 4096:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    def _rows(held: list[list]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * len(columns)]
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*held), kinds)], ["path", "ord", *columns])

    ddl = ", ".join(["path string", "ord bigint", *(f"`{c}` string" for c in columns)])
    parts = F.greatest(F.ceil(F.col("length") / PART_BYTES), F.lit(1)).cast("int")
    books = spark.read.format("binaryFile").load(paths).select("path", "content", parts.alias("parts"))
    dealt = books.select("path", "content", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts")
    # with their number given, small partitions are not put together again
    return dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "part").mapInArrow(read, ddl)
