"""Workbook (.xlsx) landing files -> one raw table per non-empty sheet.

Spark job, not a driver-side reader:

1. ``binaryFile`` scan of the workbooks (one task per file: a zip cannot be split);
2. ``mapInPandas`` decodes each workbook (zip + XML, standard library only) and
   emits one row per sheet row: (workbook, sheet, row_no, values, kinds), where
   ``kinds`` tags each cell as s(tring) / n(umber) / b(oolean) / d(ate) / t(imestamp);
3. the decoded rows are pinned once as parquet partitioned by sheet (every
   sheet is read by several jobs; a per-sheet read prunes to its folder);
4. the first row of each sheet is its header (names cleaned, collisions
   rejected); column types of *all* sheets are inferred by one aggregate over the
   cell kinds (all integral numbers -> bigint, numbers -> double, booleans,
   dates, timestamps, anything mixed -> string);
5. per sheet, one projection casts the cells and the table is written.

Only the small things reach the driver: header cells and one row of kind
counts per sheet column.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions.naming import clean_name, clean_names

ROWS_SCHEMA = "workbook string, sheet string, row_no bigint, values array<string>, kinds array<string>"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_M = "{%s}" % _NS["m"]

# Built-in number formats that denote dates (ECMA-376 part 1, 18.8.30).
BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 22}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()
    return any(ch in code for ch in "yd")


def _serial_to_iso(serial: float, epoch_1904: bool) -> tuple[str, str]:
    if epoch_1904:
        base = dt.datetime(1904, 1, 1)
    else:  # the 1900 system counts a non-existent 1900-02-29 (serial 60)
        base = dt.datetime(1899, 12, 30) if serial >= 61 else dt.datetime(1899, 12, 31)
    value = base + dt.timedelta(days=serial)
    if serial == int(serial):
        return value.date().isoformat(), "d"
    return value.isoformat(sep=" ", timespec="microseconds"), "t"


def _text(node) -> str:
    """Text of a shared string / inline string: its own <t> or its rich-text runs' <t>.

    Phonetic runs (<rPh>) are annotations, not cell text, and are skipped.
    """
    parts = []
    for child in node:
        if child.tag == _M + "t":
            parts.append(child.text or "")
        elif child.tag == _M + "r":
            parts.extend(t.text or "" for t in child.findall(_M + "t"))
    return "".join(parts)


def decode_workbook(path: str, content: bytes) -> Iterator[tuple]:
    """Yield (workbook, sheet, row_no, values, kinds) for every row of every sheet."""
    zf = zipfile.ZipFile(io.BytesIO(content))
    names = set(zf.namelist())
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    pr = wb.find("m:workbookPr", _NS)
    epoch_1904 = pr is not None and pr.get("date1904") in ("1", "true")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = [_text(si) for si in ET.fromstring(zf.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    date_styles: set[int] = set()
    if "xl/styles.xml" in names:
        st = ET.fromstring(zf.read("xl/styles.xml"))
        custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in st.iter(_M + "numFmt")}
        xfs = st.find("m:cellXfs", _NS)
        for i, xf in enumerate(xfs.findall("m:xf", _NS) if xfs is not None else []):
            fid = int(xf.get("numFmtId", "0"))
            if fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])):
                date_styles.add(i)
    for sheet in wb.find("m:sheets", _NS).findall("m:sheet", _NS):
        target = targets[sheet.get("{%s}id" % _NS["r"])]
        part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
        with zf.open(part) as fh:
            row_no = 0
            for _, row in ET.iterparse(fh):
                if row.tag != _M + "row":
                    continue
                row_no = int(row.get("r")) if row.get("r") else row_no + 1  # "r" is optional
                cells: dict[int, tuple[str, str]] = {}
                nxt = 0
                for c in row.findall(_M + "c"):
                    m = _CELL_REF.match(c.get("r", ""))
                    idx = _col_index(m.group(1)) if m else nxt
                    nxt = idx + 1
                    kind, v = c.get("t", "n"), c.find(_M + "v")
                    raw = v.text if v is not None else None
                    if kind == "s" and raw is not None:
                        cells[idx] = (shared[int(raw)], "s")
                    elif kind == "inlineStr":
                        inline = c.find(_M + "is")
                        cells[idx] = (_text(inline) if inline is not None else "", "s")
                    elif kind in ("str", "e") and raw is not None:
                        cells[idx] = (raw, "s")
                    elif kind == "b" and raw is not None:
                        cells[idx] = ("true" if raw == "1" else "false", "b")
                    elif kind == "d" and raw is not None:
                        cells[idx] = (raw.replace("T", " "), "t" if "T" in raw else "d")
                    elif raw is not None:
                        if int(c.get("s", "0")) in date_styles:
                            cells[idx] = _serial_to_iso(float(raw), epoch_1904)
                        else:
                            cells[idx] = (raw, "n")
                if cells:
                    width = max(cells) + 1
                    yield (path, sheet.get("name"), row_no,
                           [cells.get(i, (None, None))[0] for i in range(width)],
                           [cells.get(i, (None, None))[1] for i in range(width)])
                row.clear()


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["workbook", "sheet", "row_no", "values", "kinds"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            buf = []
            for rec in decode_workbook(path, bytes(content)):
                buf.append(rec)
                if len(buf) >= 10_000:
                    yield pd.DataFrame(buf, columns=cols)
                    buf = []
            if buf:
                yield pd.DataFrame(buf, columns=cols)


def decoded_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per sheet row of every workbook in ``paths`` (decoded in tasks)."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(_decode_batches, ROWS_SCHEMA)


SHEET = "sheet_id"  # partition column of the pinned rows: one folder per sheet


def pin_decoded(rows: DataFrame, path: str) -> DataFrame:
    """Write the decoded rows once, partitioned by sheet, and read them back.

    Every sheet is read by several jobs (header, type probe, table write); the
    pinned copy is decoded once, survives a lost executor, and a per-sheet read
    prunes to that sheet's folder.
    """
    (rows.withColumn(SHEET, F.xxhash64("workbook", "sheet"))
         .write.partitionBy(SHEET).parquet(path))
    return rows.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class SheetPlan:
    workbook: str
    sheet: str
    sheet_id: int
    table: str
    header_row: int
    columns: list[str]
    types: list[str]  # one of bigint, double, boolean, date, timestamp, string
    data_rows: int


_KINDS = ("n", "i", "f", "b", "d", "t")


def plan_sheets(pinned: DataFrame) -> list[SheetPlan]:
    """Header (first row) and inferred column types of every sheet, in two small jobs.

    Only per-sheet headers and per-column kind counts reach the driver.
    """
    first = pinned.groupBy(SHEET, "workbook", "sheet").agg(F.min("row_no").alias("header_row"))
    headers = (pinned.join(first, [SHEET, "workbook", "sheet"])
               .where(F.col("row_no") == F.col("header_row"))
               .select(SHEET, "workbook", "sheet", "header_row", "values").collect())
    data = (pinned.join(first, [SHEET, "workbook", "sheet"], "left")
            .where(F.col("row_no") > F.col("header_row")))
    cells = data.select(SHEET, F.posexplode(F.arrays_zip("values", "kinds")).alias("pos", "cell"))
    v, k = F.col("cell.values"), F.col("cell.kinds")
    as_double = v.try_cast("double")
    stats = (cells.groupBy(SHEET, "pos").agg(
        F.count(v).alias("n"),
        F.count(F.when(k.eqNullSafe("n") & (as_double == as_double.try_cast("bigint")), 1)).alias("i"),
        F.count(F.when(k == "n", 1)).alias("f"),
        F.count(F.when(k == "b", 1)).alias("b"),
        F.count(F.when(k == "d", 1)).alias("d"),
        F.count(F.when(k.isin("d", "t"), 1)).alias("t")).collect())
    rows_per_sheet = {r[SHEET]: r["count"] for r in data.groupBy(SHEET).count().collect()}
    by_sheet: dict[int, dict[int, dict]] = {}
    for r in stats:
        by_sheet.setdefault(r[SHEET], {})[r["pos"]] = {kd: r[kd] for kd in _KINDS}

    plans = []
    for h in sorted(headers, key=lambda r: (r["workbook"], r["sheet"])):
        raw = [val if val is not None else f"Unnamed: {i}" for i, val in enumerate(h["values"])]
        names = clean_names(raw, what=f"sheet {h['sheet']!r} column")
        col_stats = by_sheet.get(h[SHEET], {})
        plans.append(SheetPlan(h["workbook"], h["sheet"], h[SHEET], clean_name(h["sheet"]), h["header_row"],
                               names, [_infer(col_stats.get(i)) for i in range(len(names))],
                               rows_per_sheet.get(h[SHEET], 0)))
    return plans


def _infer(c: dict | None) -> str:
    """All non-empty cells integral -> bigint, numeric -> double, boolean, date, date/time; else string."""
    if not c or not c["n"]:
        return "string"
    for kind, type_name in (("i", "bigint"), ("f", "double"), ("b", "boolean"), ("d", "date"), ("t", "timestamp")):
        if c[kind] == c["n"]:
            return type_name
    return "string"


def _typed(value, type_name: str):
    if type_name == "bigint":
        return value.try_cast("double").try_cast("bigint")
    if type_name == "double":
        return value.try_cast("double")
    if type_name == "boolean":
        return value.cast("boolean")
    if type_name == "date":
        return F.to_date(value)
    if type_name == "timestamp":
        return F.to_timestamp(value)
    return value


def sheet_frame(pinned: DataFrame, plan: SheetPlan) -> DataFrame | None:
    """Typed DataFrame of one sheet's data rows; None when the sheet has no data rows."""
    if plan.data_rows == 0:
        return None
    data = pinned.where((F.col(SHEET) == plan.sheet_id) & (F.col("workbook") == plan.workbook)
                        & (F.col("sheet") == plan.sheet) & (F.col("row_no") > plan.header_row))
    return data.select(*[_typed(F.get(F.col("values"), i), t).alias(name)
                         for i, (name, t) in enumerate(zip(plan.columns, plan.types))])
