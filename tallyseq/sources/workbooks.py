"""Packed inputs, opened in tasks: order workbooks and zipped quality reports, one file a row."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: the names of its elements.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

ROWS_SCHEMA = "file string, row long, cells array<struct<text boolean, value string>>"


def _column(place: str) -> int:
    """The number of a cell's column, from 0, by its letters."""
    n = 0
    for c in re.match(r"[A-Z]*", place)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t"))


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets/{MAIN}sheet")
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[sheet.get(LINK)]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _sheet_rows(data: bytes, most: int) -> Iterator[tuple[int, list]]:
    """(number from 0, first ``most`` cells) of the rows of the first sheet; a cell is (is it text, value) or None."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = [_text(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in book.namelist() else []
    n = -1
    for _, row in ElementTree.iterparse(book.open(_first_sheet(book))):
        if row.tag != f"{MAIN}row":
            continue
        cells: list = [None] * most
        for k, cell in enumerate(row.iter(f"{MAIN}c")):
            at = _column(cell.get("r")) if cell.get("r") else k
            kind, value = cell.get("t"), cell.find(f"{MAIN}v")
            raw = _text(cell) if kind == "inlineStr" else value.text if value is not None else None
            if at < most and raw is not None:
                cells[at] = (kind in ("s", "str", "inlineStr"), shared[int(raw)] if kind == "s" else raw)
        n = int(row.get("r", n + 2)) - 1
        yield n, cells
        row.clear()


def read_workbook(spark: SparkSession, paths: list[str], columns: int) -> DataFrame:
    """file, row (from 0), cells: the first sheet of each workbook. A workbook has at most 1,048,576 rows and is read by one task."""

    def opened(frames):
        for frame in frames:
            for path, data in zip(frame["path"], frame["content"], strict=True):
                found = [(path, n, [c and {"text": c[0], "value": c[1]} for c in cells]) for n, cells in _sheet_rows(data, columns)]
                for k in range(0, len(found), 10_000):
                    yield pd.DataFrame(found[k : k + 10_000], columns=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(opened, ROWS_SCHEMA)


def read_order(spark: SparkSession, paths: list[str], robust: bool = True) -> DataFrame:
    """``pool`` and ``sequence``, the first two columns of an order's workbook below its first row, with file and row.

    If ``robust``, only text cells that are bases (or N) once trimmed stay, upper case, and an order without any raises when it
    is read; else all rows stay as they are.
    """
    rows = read_workbook(spark, paths, 2).where("row > 0")
    pool, cell = (F.col("cells")[k] for k in (0, 1))
    named = rows.select("file", "row", pool["value"].alias("pool"), cell["value"].alias("sequence"), cell["text"].alias("text"))
    if not robust:
        return named.drop("text")
    kept = named.where("text").withColumn("sequence", F.upper(F.regexp_replace("sequence", r"^\s+|\s+$", ""))).where(F.col("sequence").rlike(r"\A[ACGTN]+\z")).drop("text")
    per_file = kept.groupBy("file").agg(F.count("*").alias("n"))
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))
    empty = files.join(per_file, "file", "left_anti").select(F.raise_error(F.concat(F.lit("no sequences in "), F.col("file"))).cast("string").alias("file"), *[F.lit(None).cast(t).alias(c) for c, t in kept.dtypes[1:]])
    return kept.unionByName(empty)


def zipped_reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``folder`` and text, ``value``, of the reports in zip files; a zip without one raises."""

    def opened(frames):
        for frame in frames:
            for path, data in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    found = [(n.split("/")[-2], z.read(n).decode()) for n in z.namelist() if n.endswith("/fastqc_data.txt")]
                if not found:
                    raise ValueError(f"no report in {path}")
                yield pd.DataFrame(found, columns=["folder", "value"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(opened, "folder string, value string")
