"""Readers and writers of files: workbooks, SQLite databases, CSV and JSON documents.

Workbooks and databases are read as binary files by Spark and parsed from bytes on the executors with the standard
library, so that any store that Spark can read will do. One file is one task.
"""

from __future__ import annotations

import glob
import io
import re
import sqlite3
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark import fixed

SHEET_COLUMNS = ["sys_id", "sys_entitytype", *[f"{f}_{x}" for f in fixed.FIELD_WEIGHTS for x in (fixed.SOURCE_LOCALE, *fixed.TARGET_LOCALES)]]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def workbook_rows(data: bytes, sheet: str) -> Iterator[list[str | None]]:
    """The rows of a worksheet of an xlsx file, as texts."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter() if _local(t.tag) == "t"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        names = {}
        for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
            if _local(s.tag) == "sheet":
                names[s.get("name")] = next(v for k, v in s.attrib.items() if _local(k) == "id")
        if sheet not in names:
            raise ValueError(f"no sheet {sheet}; there are {', '.join(map(str, names))}")
        target = links[names[sheet]].lstrip("/")
        path = target if target.startswith("xl/") else f"xl/{target}"
        for row in ElementTree.fromstring(book.read(path)).iter():
            if _local(row.tag) != "row":
                continue
            cells: list[str | None] = []
            for cell in row:
                letters = re.match("[A-Z]+", cell.get("r", "")) or re.match("", "")
                at = 0
                for letter in letters.group():
                    at = at * 26 + ord(letter) - 64
                at = at - 1 if at else len(cells)
                cells += [None] * (at + 1 - len(cells))
                if cell.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
                else:
                    value = next((v.text for v in cell if _local(v.tag) == "v"), None)
                    cells[at] = shared[int(value)] if cell.get("t") == "s" and value is not None else value
            yield cells


def resolve_workbook(path: str, expected: str | None = None) -> str:
    """The workbook that a path means: a file, the first match of a pattern, the expected (else the first) workbook of a folder, or the path itself.

    Only for local paths; a path with a scheme is left to Spark.
    """
    if "://" in path or Path(path).is_file():
        return path
    if any(c in path for c in "*?[]"):
        found = sorted(glob.glob(path))
    elif Path(path).is_dir():
        found = sorted(map(str, Path(path).glob("*.xlsx")))
        found = [f for f in found if Path(f).name == expected] or found
    else:
        found = []
    return found[0] if found else path


def read_workbook(spark: SparkSession, path: str, sheet: str = fixed.ITEM_SHEET, columns: list[str] | None = None) -> DataFrame:
    """row_no and the named columns (by header) of a sheet, as strings. Columns that the sheet lacks are null."""

    wanted = columns or SHEET_COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = workbook_rows(data, sheet)
                place = {h: i for i, h in enumerate(next(rows, [])) if h}
                found = [[r[place[c]] if c in place and place[c] < len(r) else None for c in wanted] for r in rows]
                arrays = [pa.array(range(len(found)), pa.int64()), *[pa.array([r[k] for r in found], pa.string()) for k in range(len(wanted))]]
                yield pa.RecordBatch.from_arrays(arrays, ["row_no", *wanted])

    schema = ", ".join(["row_no long", *[f"`{c}` string" for c in wanted]])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_sqlite(spark: SparkSession, path: str, query: str, schema: str) -> DataFrame:
    """The result of a query on a SQLite file, in the given schema (same number and order of columns)."""
    kinds = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                with sqlite3.connect(":memory:") as db:
                    db.deserialize(data)
                    cursor = db.execute(query)
                    while rows := cursor.fetchmany(10_000):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns strings; a byte-order mark in front of the first name is dropped."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def write_csv(df: DataFrame, path: str, order: list[str | Column] | None = None) -> None:
    """One CSV file with a header, for glossaries: their size is that of a vocabulary, not of the corpus."""
    (df.orderBy(*order) if order else df).coalesce(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


DECISIONS = (
    "case_canonical_map map<string,string>, auto_merged_report array<struct<canonical:string,aliases:array<string>>>, "
    "decisions map<string,struct<action:string,canonical:string,aliases:array<string>,terms:array<string>,_auto_reason:string>>"
)


def read_decisions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A decisions document as two tables: (term, canonical) and (seq, action, canonical, aliases, members, reason)."""
    doc = spark.read.option("multiLine", True).schema(DECISIONS).json(path)
    case = doc.select(F.explode("case_canonical_map").alias("term", "canonical"))
    made = doc.select(F.explode("decisions").alias("k", "d"))
    return case, made.select(F.col("k").cast("long").alias("seq"), "d.action", "d.canonical", "d.aliases", F.col("d.terms").alias("members"), F.col("d._auto_reason").alias("reason"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)
