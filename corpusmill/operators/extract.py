"""Text extraction: what to do with a file, what came of it, and the audit."""

from __future__ import annotations

import io
import re
import subprocess
import tempfile
import time
import zipfile
from collections.abc import Callable
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import markup
from corpusmill.functions.text import stripped

#: Extensions, limits, and what a status takes.
TEXT = (".txt", ".md", ".csv")
SKIPPED = (".zip", ".mobi", ".epub", ".doc", ".xls", ".pptx", ".ppt")
PARSED = (".pdf", ".html", ".htm", ".docx", ".xlsx")
PDF_SECONDS, XLSX_BYTES, SHEET_ROWS = 120, 10 * 1024 * 1024, 3000
NO_LAYER, THIN, EMPTY = 200, 1.5, 40
SITE = "Occupational Safety and Health Administration"
OCR_SECONDS, OCR_PAGES, OCR_LEAST = 45 * 60, 400, 200
MAGIC = {".pdf": b"%PDF", ".docx": b"PK", ".xlsx": b"PK", ".zip": b"PK", ".pptx": b"PK"}


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(?<=[^/])(\.[^./]+)\z", 1))


def kind(ext: Column) -> Column:
    """skip, text, parse or unhandled."""
    return F.when(ext.isin(*SKIPPED), "skip").when(ext.isin(*TEXT), "text").when(ext.isin(*PARSED), "parse").otherwise("unhandled")


def has_magic(content: Column, ext: Column) -> Column:
    """Whether the content begins as its extension says; true for extensions without a mark."""
    found = F.lit(True)
    for e, mark in MAGIC.items():
        found = F.when(ext == e, F.substring(content, 1, len(mark)) == F.lit(mark)).otherwise(found)
    return found


def classified(ext: Column, body: Column, kilobytes: Column) -> Column:
    """struct(status, chars, note) of an extracted body."""
    n = F.length(body)
    said = lambda status, note, chars=n: F.struct(F.lit(status).alias("status"), chars.cast("long").alias("chars"), note.alias("note"))
    none = F.lit(0)
    return (
        F.when(ext.isin(*SKIPPED), said("skip", F.concat(ext, F.lit(" not text-extractable here")), none))
        .when(~ext.isin(*TEXT, *PARSED), said("skip", F.concat(F.lit("unhandled "), ext), none))
        .when((ext == ".pdf") & (n < NO_LAYER), said("none", F.lit("no text layer - needs OCR")))
        .when((ext == ".pdf") & (n / kilobytes < THIN), said("thin", F.lit("very low text density - likely partial scan")))
        .when(F.length(stripped(body)) < EMPTY, said("thin", F.lit("nearly empty")))
        .otherwise(said("ok", F.lit("")))
    )


def kilobytes(size: Column) -> Column:
    return F.greatest(size / 1024.0, F.lit(1.0))


def audit(rows: DataFrame) -> DataFrame:
    """The audit of rows (corpus, relative_path, size, status, chars, note); whoever writes it for people sorts it then, so that texts are classified once."""
    kb = kilobytes(F.col("size"))
    return rows.select("corpus", "relative_path", "status", "chars", F.bround(kb).cast("long").alias("source_kb"), F.round(F.col("chars") / kb, 2).alias("chars_per_kb"), "note")


def ocr_candidates(audited: DataFrame) -> DataFrame:
    return audited.filter(F.col("status").isin("none", "thin") & F.lower("relative_path").endswith(".pdf"))


def ocr_sources(audited: DataFrame, documents: DataFrame, texts: DataFrame) -> DataFrame:
    """(relative_path, content, have) of the audit's candidates: the PDF's bytes, and how many bytes of text the mirror (relative_path, text) has already."""
    have = texts.groupBy("relative_path").agg(F.max(F.octet_length("text")).alias("have"))
    return ocr_candidates(audited).select("relative_path").join(documents.select("relative_path", "content"), "relative_path").join(have, "relative_path", "left").select("relative_path", "content", "have")


def up_to_date(source: DataFrame, mirror: DataFrame, key: str = "relative_path") -> DataFrame:
    """source (key, modified) with `current`: whether mirror (key, modified, size) has text no older than it."""
    m = mirror.select(key, F.col("modified").alias("_m"), F.col("size").alias("_s"))
    return source.join(m, key, "left").withColumn("current", F.coalesce((F.col("_s") > 0) & (F.col("_m") >= F.col("modified")), F.lit(False))).drop("_m", "_s")


# extractors: bytes to (title, body); ValueError is a deliberate skip


def pdf(content: bytes) -> tuple[str, str]:
    """By pdftotext, in a process of its own."""
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(content)
        f.flush()
        done = subprocess.run(["pdftotext", "-q", "-enc", "UTF-8", f.name, "-"], capture_output=True, timeout=PDF_SECONDS)
    return "", done.stdout.decode(errors="replace").strip()


def page(content: bytes) -> tuple[str, str]:
    found = markup.main_text(content.decode(errors="replace"))
    return re.sub(rf"\s*\|\s*{SITE}\s*\Z", "", found["title"]).strip(), found["body"]


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _runs(node) -> str:
    return "".join("\t" if t.tag == _W + "tab" else "\n" if t.tag in (_W + "br", _W + "cr") else t.text or "" for t in node.iter() if t.tag in (_W + "t", _W + "tab", _W + "br", _W + "cr"))


def docx(content: bytes) -> tuple[str, str]:
    """Paragraphs that are not blank, then tables, their cells barred."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(_W + "body")
    lines = [t for p in body.findall(_W + "p") if (t := _runs(p)).strip()]
    for row in (r for t in body.findall(_W + "tbl") for r in t.findall(_W + "tr")):
        cells = ["\n".join(_runs(p) for p in c.findall(_W + "p")).strip() for c in row.findall(_W + "tc")]
        lines.append(" | ".join(filter(None, cells)))
    return "", markup.tidy("\n".join(filter(None, lines)))


def xlsx(content: bytes) -> tuple[str, str]:
    """Sheets as barred rows; sheets are cut after SHEET_ROWS rows, with a line that says so."""
    if len(content) > XLSX_BYTES:
        raise ValueError(f"xlsx over {XLSX_BYTES >> 20}MB - bulk data, not a document")
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in si.iter(_S + "t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(_S + "si")]
    dates, first = _date_styles(book, names), datetime(1904, 1, 1) if _is_1904(book) else datetime(1899, 12, 30)
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    lines = []
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).find(_S + "sheets"):
        lines.append(f"## Sheet: {sheet.get('name')}")
        target = targets[sheet.get(_R + "id")].lstrip("/")
        at = 0
        for row in ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}")).iter(_S + "row"):
            at = int(row.get("r") or at + 1)  # blank rows count
            if at > SHEET_ROWS:
                lines.append(f"[... truncated at {SHEET_ROWS} rows]")
                break
            lines.append(" | ".join(filter(None, (_cell(c, shared, dates, first) for c in row.findall(_S + "c")))))
    return "", markup.tidy("\n".join(filter(None, lines)))


#: Numbers of the built-in formats that show a date or a time.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(book: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Places of the cell styles whose number format shows a date or a time."""
    if "xl/styles.xml" not in names:
        return set()
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    written = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in styles.iter(_S + "numFmt")}
    # what is quoted, escaped or in brackets is no part of the format
    bare = {i: re.sub(r'"[^"]*"|\\.|_.|\[[^\]]*\]', "", code).split(";")[0].lower() for i, code in written.items()}
    shown = {i for i, code in bare.items() if re.search("[ymdhs]", code) and "general" not in code}
    formats = styles.find(_S + "cellXfs")
    kinds = [int(x.get("numFmtId") or 0) for x in formats] if formats is not None else []
    return {k for k, i in enumerate(kinds) if (i in shown if i in written else i in _DATE_FORMATS)}


def _is_1904(book: zipfile.ZipFile) -> bool:
    settings = ElementTree.fromstring(book.read("xl/workbook.xml")).find(_S + "workbookPr")
    return settings is not None and settings.get("date1904") in ("1", "true")


def _moment(serial: float, first: datetime) -> str:
    """A day number as a date and time; below one it is a time alone."""
    days, part = divmod(serial, 1)
    part = timedelta(milliseconds=round(part * 86_400_000))
    if 0 <= serial < 1 and part.days == 0:
        return str((datetime.min + part).time())
    if 0 < serial < 60 and first.year == 1899:
        days += 1  # that calendar has a 29th of February 1900
    return str(first + timedelta(days=days) + part)


def _cell(c, shared: list[str], dates: set[int], first: datetime) -> str:
    v = c.find(_S + "v")
    if c.get("t") == "inlineStr":
        return "".join(t.text or "" for t in c.iter(_S + "t")).strip()
    if v is None or v.text is None:
        return ""
    if c.get("t") == "s":
        return shared[int(v.text)].strip()
    if c.get("t") == "b":
        return "True" if v.text == "1" else "False"
    if c.get("t") in (None, "n") and int(c.get("s") or 0) in dates:
        try:
            return _moment(float(v.text), first)
        except (ValueError, OverflowError):
            return v.text.strip()
    return v.text.strip()


def plain(content: bytes) -> tuple[str, str]:
    return "", content.decode(errors="replace")


EXTRACTORS: dict[str, Callable[[bytes], tuple[str, str]]] = {".pdf": pdf, ".html": page, ".htm": page, ".docx": docx, ".xlsx": xlsx} | dict.fromkeys(TEXT, plain)


def extract(files: DataFrame, extractors: dict | None = None) -> DataFrame:
    """files (corpus, relative_path, size, content) as rows with title, body, status, chars and note.

    One bad file is an error row, not a failed run; what cannot be read here says so in its note.
    """
    tools = EXTRACTORS | (extractors or {})

    def run(batches):
        for batch in batches:
            out = []
            for path, content in zip(batch.column("relative_path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                found = re.search(r"(?<=[^/])\.[^./]+\Z", path or "")
                tool = tools.get(found[0].lower() if found else "")
                title, body, failed, note = "", "", None, ""
                try:
                    if tool:
                        title, body = tool(content or b"")
                except ValueError as e:
                    failed, note = "skip", str(e)
                except FileNotFoundError as e:
                    failed, note = "skip", f"{e.filename} is not installed"
                except subprocess.TimeoutExpired:
                    failed, note = "error", "pdftotext timeout"
                except Exception as e:  # noqa: BLE001  whatever a parser raises is the file's result
                    failed, note = "error", f"{type(e).__name__}: {str(e)[:70]}"
                out.append((title, body, failed, note))
            columns = [pa.array([r[i] for r in out], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("corpus", "relative_path", "size")), *columns], ["corpus", "relative_path", "size", "title", "body", "failed", "said"])

    rows = files.select("corpus", "relative_path", F.col("size").cast("long").alias("size"), "content")
    rows = rows.mapInArrow(run, "corpus string, relative_path string, size long, title string, body string, failed string, said string")
    ext = extension(F.col("relative_path"))
    said = classified(ext, F.col("body"), kilobytes(F.col("size")))
    failed = F.struct(F.col("failed").alias("status"), F.lit(0).cast("long").alias("chars"), F.col("said").alias("note"))
    return rows.withColumn("r", F.when(F.col("failed").isNotNull(), failed).otherwise(said)).select("corpus", "relative_path", "size", "title", "body", "r.*")


def mirror_text(title: Column, body: Column) -> Column:
    """A text file of the mirror: a header if there is a title, and the body."""
    head = F.when(title != "", F.concat(F.lit("Title: "), title, F.lit("\n" + "-" * 72 + "\n\n"))).otherwise("")
    return F.concat(head, body, F.lit("\n"))


def ocr(candidates: DataFrame, provider: Callable[[bytes], tuple[int, str, str]]) -> DataFrame:
    """(relative_path, status, chars, note, text) of candidates (relative_path, content, have): provider gives (exit code, text, error). Rows whose mirror already has more than OCR_LEAST bytes (have) are left out."""

    def run(batches):
        for batch in batches:
            out = []
            for path, content in zip(batch.column("relative_path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    code, text, error = provider(content)
                    size = len(text.encode())
                    ok = code == 0 and size >= OCR_LEAST
                    out.append((path, "ok" if ok else "fail" if code else "empty", size, "" if ok else error[-200:].strip(), text if ok else None))
                except subprocess.TimeoutExpired:
                    out.append((path, "timeout", 0, f"> {OCR_SECONDS}s", None))
                except Exception as e:  # noqa: BLE001  one bad file must not end the run
                    out.append((path, "error", 0, f"{type(e).__name__}: {str(e)[:120]}", None))
            yield pa.RecordBatch.from_pylist([dict(zip(("relative_path", "status", "chars", "note", "text"), r, strict=True)) for r in out], _OCR)

    rows = candidates.filter(F.coalesce("have", F.lit(0)) <= OCR_LEAST).select("relative_path", "content")
    return rows.mapInArrow(run, "relative_path string, status string, chars long, note string, text string")


_OCR = pa.schema([("relative_path", pa.string()), ("status", pa.string()), ("chars", pa.int64()), ("note", pa.string()), ("text", pa.string())])


def tesseract(content: bytes, lang: str = "eng") -> tuple[int, str, str]:
    """An OCR provider: pages as 300 dpi images by pdftoppm, read by tesseract."""
    ends = time.monotonic() + OCR_SECONDS
    with tempfile.TemporaryDirectory() as d:
        with open(f"{d}/in.pdf", "wb") as f:
            f.write(content)
        subprocess.run(["pdftoppm", "-r", "300", "-l", str(OCR_PAGES), "-png", f"{d}/in.pdf", f"{d}/page"], check=True, capture_output=True, timeout=OCR_SECONDS)
        import glob

        texts, code, error = [], 0, ""
        for image in sorted(glob.glob(f"{d}/page*.png")):
            left = ends - time.monotonic()  # the limit is the whole file's
            if left <= 0:
                raise subprocess.TimeoutExpired("tesseract", OCR_SECONDS)
            r = subprocess.run(["tesseract", image, "-", "--psm", "3", "-l", lang], capture_output=True, text=True, timeout=min(300, left))
            texts.append(r.stdout)
            code, error = code or r.returncode, error + r.stderr * bool(r.returncode)
    return code, "\n".join(texts), error


#: Folders that hold no sources of plain-text twins.
NO_TWINS = (".git", ".venv", "node_modules", "__pycache__", ".pytest_cache", "dist", "build", "site-packages", "state")


def twins(documents: DataFrame) -> DataFrame:
    """(relative_path, want, stale) of the Markdown files of documents (relative_path, text): the twin's text, and whether the .txt file beside it differs or is missing."""
    folders = F.slice(F.split("relative_path", "/"), F.lit(1), F.size(F.split("relative_path", "/")) - 1)
    md = documents.filter(F.col("relative_path").endswith(".md") & ~F.arrays_overlap(folders, F.array(*map(F.lit, NO_TWINS))))
    md = md.select(F.regexp_replace("relative_path", r"\.md\z", ".txt").alias("relative_path"), markup.md_text(F.col("text")).alias("want"))
    have = documents.select("relative_path", F.col("text").alias("have"))
    return md.join(have, "relative_path", "left").select("relative_path", "want", (~F.col("want").eqNullSafe(F.col("have"))).alias("stale"))


def missing_tools(tools: tuple[str, ...] = ("tesseract", "pdftoppm")) -> list[str]:
    import shutil

    return [t for t in tools if shutil.which(t) is None]
