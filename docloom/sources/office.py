"""Office documents and archives by the standard library: rows in, rows out, one file at a time."""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import stat
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import fixed

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _text(node: ET.Element, tag: str) -> str:
    return "".join(t.text or "" for t in node.iter(tag)).strip()


def docx_paragraphs(content: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    return [_text(p, f"{WORD}t") for p in root.iter(f"{WORD}p")]


def docx_markdown(content: bytes) -> str:
    """Paragraphs and tables in document order; headings by their style."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    body, out = root.find(f"{WORD}body"), []
    for node in body if body is not None else ():
        if node.tag == f"{WORD}p" and (text := _text(node, f"{WORD}t")):
            style = node.find(f"{WORD}pPr/{WORD}pStyle")
            heading = style is not None and (style.get(f"{WORD}val") or "").lower().startswith("heading")
            out.append("## " * heading + text)
        elif node.tag == f"{WORD}tbl":
            rows = [[_text(c, f"{WORD}t") for c in r.iter(f"{WORD}tc")] for r in node.iter(f"{WORD}tr")]
            out.append(table(rows))
    return "\n\n".join(filter(None, out))


def pptx_markdown(content: bytes) -> str:
    """Texts of each slide; slides without text are left out."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)]
        for n, name in enumerate(sorted(names, key=lambda x: int(re.search(r"\d+", x)[0])), 1):
            frames = ET.fromstring(z.read(name)).iter("{http://schemas.openxmlformats.org/presentationml/2006/main}txBody")
            texts = ["\n".join(_text(p, f"{DRAWING}t") for p in f.iter(f"{DRAWING}p")).strip() for f in frames]
            if any(texts):
                out.append(f"## اسلاید {n}\n\n" + "\n\n".join(filter(None, texts)))
    return "\n\n".join(out)


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def xlsx_sheets(content: bytes) -> list[tuple[str, list[list[str]], int]]:
    """(sheet, rows, all rows): values, not formulas; the first 1000 rows and 40 columns."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(s, f"{SHEET}t") for s in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{SHEET}sheet"):
            target = links[sheet.get(RELATION)].lstrip("/")
            rows, total = [], 0
            for row in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{SHEET}row"):
                total = int(row.get("r") or total + 1)
                if total > fixed.SHEET_ROWS:
                    continue
                cells: list[str] = []
                for i, cell in enumerate(row.iter(f"{SHEET}c")):
                    at = _column(cell.get("r")) if cell.get("r") else i
                    if at < fixed.SHEET_COLUMNS:
                        cells += [""] * (at + 1 - len(cells))
                        cells[at] = _cell(cell, shared)
                rows.append(cells)
            out.append((sheet.get("name"), rows, total))
    return out


def _cell(cell: ET.Element, shared: list[str]) -> str:
    value = cell.find(f"{SHEET}v")
    if cell.get("t") == "inlineStr":
        return _text(cell, f"{SHEET}t")
    if value is None or value.text is None:
        return ""
    if cell.get("t") == "s":
        return shared[int(value.text)]
    if re.fullmatch(r"-?\d+\.0*", value.text):
        return value.text.partition(".")[0]
    return value.text


def compact_rows(rows: list[list[str]]) -> list[list[str]]:
    """Without blank rows and columns."""
    rows = [r for r in rows if any(str(x).strip() for x in r)]
    width = max(map(len, rows), default=0)
    full = [c for c in range(width) if any(c < len(r) and str(r[c]).strip() for r in rows)]
    return [[r[c] if c < len(r) else "" for c in full] for r in rows]


def table(rows: list[list[str]]) -> str:
    width = max(map(len, rows), default=0)
    if not width:
        return ""
    cells = [[x.replace("\n", " ").replace("|", "\\|").strip() for x in r] + [""] * (width - len(r)) for r in rows]
    lines = ["| " + " | ".join(r) + " |" for r in cells]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


def is_red(argb: str | None) -> bool:
    """Is a font colour (alpha, red, green, blue in hex) clearly red?"""
    digits = (argb or "")[-6:]
    if not re.fullmatch("[0-9A-Fa-f]{6}", digits):
        return False
    r, g, b = bytes.fromhex(digits)
    return r >= 150 and r > g + 40 and r > b + 40


def xlsx_markdown(content: bytes) -> str:
    out = []
    for name, rows, total in xlsx_sheets(content):
        if rows := compact_rows(rows):
            part = f"## شیت: {name}\n\n{table(rows)}"
            if total > fixed.SHEET_ROWS:
                part += f"\n\n_جدول بریده شد: {fixed.SHEET_ROWS} سطر از {total}_"
            out.append(part)
    return "\n\n".join(out)


def xls_markdown(content: bytes) -> str:
    """The old binary sheets, where the xlrd library is installed; an error row elsewhere."""
    import xlrd

    out = []
    for sheet in xlrd.open_workbook(file_contents=content).sheets():
        number = lambda x: str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)
        rows = [[number(x).strip() for x in sheet.row_values(i)] for i in range(min(sheet.nrows, fixed.SHEET_ROWS))]
        if rows := compact_rows(rows):
            part = f"## شیت: {sheet.name}\n\n{table(rows)}"
            if sheet.nrows > fixed.SHEET_ROWS:
                part += f"\n\n_جدول بریده شد: {fixed.SHEET_ROWS} سطر از {sheet.nrows}_"
            out.append(part)
    return "\n\n".join(out)


def plain_text(content: bytes) -> str:
    return content.decode("utf-8-sig", "replace")


READERS = {
    ".docx": docx_markdown,
    ".pptx": pptx_markdown,
    ".xlsx": xlsx_markdown,
    ".xlsm": xlsx_markdown,
    ".xls": xls_markdown,
    ".txt": plain_text,
    ".csv": plain_text,
}


def converted(files: DataFrame) -> DataFrame:
    """``files(name, content)`` to (name, kind, body, error): a file that cannot be read is a row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                kind = posixpath.splitext(name)[1].lower()
                try:
                    rows.append((name, kind, READERS[kind](bytes(content)), None))
                except Exception as e:
                    rows.append((name, kind, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["name", "kind", "body", "error"])

    wanted = files.where(F.lower(F.regexp_extract("name", r"(\.[^.]+)$", 1)).isin(*READERS)).select("name", "content")
    return wanted.mapInPandas(run, "name string, kind string, body string, error string")


def _archive(name: str, content: bytes):
    """A ZIP file, or a RAR file where the rarfile library is installed."""
    if not name.lower().endswith(".rar"):
        return zipfile.ZipFile(io.BytesIO(content))
    import rarfile

    return rarfile.RarFile(io.BytesIO(content))


def _is_link(info) -> bool:
    return info.is_symlink() if hasattr(info, "is_symlink") else stat.S_ISLNK(info.external_attr >> 16)


def zip_members(archives: DataFrame) -> DataFrame:
    """``archives(name, content)`` (ZIP, RAR) to (archive, member, name, sha256, content): files alone, no path kept, no links, no
    hidden ones. A broken archive gives a row with its error."""
    schema = "archive string, member string, name string, sha256 string, content binary, error string"

    def members(name: str, content: bytes) -> Iterator[tuple]:
        stem = posixpath.splitext(name)[0]
        try:
            with _archive(name, content) as z:
                for info in z.infolist():
                    base = info.filename.replace("\\", "/").rsplit("/", 1)[-1]
                    if info.is_dir() or _is_link(info) or base.startswith((".", "__MACOSX")):
                        continue
                    base = re.sub(r'[<>:"/\\|?*\x00-\x1f]', "_", base).rstrip(" .")
                    if base:
                        data = z.read(info)
                        yield name, info.filename, f"{stem}_unzipped_{base}", hashlib.sha256(data).hexdigest(), data, None
        except Exception as e:
            yield name, None, None, None, None, f"{type(e).__name__}: {e}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [x.split()[0] for x in schema.split(", ")]
        for pdf in frames:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                rows = list(members(name, bytes(content)))
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return archives.select("name", "content").mapInPandas(run, schema)


def flattened(archives: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files of the archives under names that are theirs, and their parents' edges, taken from the archives.

    One content under one name is there once; another content under a taken name gets a part of its hash.
    """
    from pyspark.sql import Window as W

    members = zip_members(archives).where("error is null")
    one = members.groupBy("name", "sha256").agg(F.min(F.struct("archive", "member")).alias("_f"), F.first("content").alias("content"))
    n = F.row_number().over(W.partitionBy("name").orderBy("_f"))
    stem, suffix = F.regexp_extract("name", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("name", r"(\.[^.]*)$", 1)
    unique = F.when(n == 1, F.col("name")).otherwise(F.concat(stem, F.lit("_"), F.substring("sha256", 1, 12), suffix))
    named = one.select("name", "sha256", "content", unique.alias("file"))
    owners = members.select("name", "sha256", "archive").distinct().join(named.select("name", "sha256", "file"), ["name", "sha256"])
    more = owners.join(edges, owners["archive"] == edges["attachment"]).select(F.col("file").alias("attachment"), "parent").distinct()
    return named.select("file", "sha256", "content"), more
