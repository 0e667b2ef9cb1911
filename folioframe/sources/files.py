"""Reading documents, tables and run reports from files, as DataFrames."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators.validate import without_fences

LIMIT = 50 * 1024 * 1024
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def text_files(spark: SparkSession, path: str, pattern: str = "*.{md,markdown}", *, recursive: bool = False) -> DataFrame:
    """(path, text) of whole files, in the order of their paths when collected by path."""
    r = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return r.format("text").load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def html_files(spark: SparkSession, path: str, **options) -> DataFrame:
    return text_files(spark, path, "*.{html,htm}", **options).withColumnRenamed("text", "html")


def binary_files(spark: SparkSession, path: str, pattern: str, *, recursive: bool = False, most: int | None = LIMIT) -> DataFrame:
    """(path, length, modificationTime, content), content null where a file is larger than ``most``; None takes files of any size."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return df if most is None else df.withColumn("content", F.when(F.col("length") <= most, F.col("content")))


def file_kind(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def _style(p: ElementTree.Element) -> str:
    s = p.find(f"{_W}pPr/{_W}pStyle")
    return s.get(f"{_W}val", "") if s is not None else ""


_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _relations(z: zipfile.ZipFile, name: str) -> dict[str, str]:
    """Relation id -> target of a part of an office file."""
    if name not in z.namelist():
        return {}
    return {r.get("Id", ""): r.get("Target", "") for r in ElementTree.fromstring(z.read(name))}


def _run_markdown(r: ElementTree.Element) -> str:
    text = "".join("\n" if t.tag == f"{_W}br" else "\t" if t.tag == f"{_W}tab" else t.text or "" for t in r if t.tag in (f"{_W}t", f"{_W}br", f"{_W}tab"))
    on = lambda n: (e := r.find(f"{_W}rPr/{_W}{n}")) is not None and e.get(f"{_W}val", "1") not in ("0", "false")
    mark = ("**" if on("b") else "") + ("*" if on("i") else "")
    bare = text.strip()
    return text.replace(bare, mark + bare + mark[::-1], 1) if mark and bare else text


def _paragraph_markdown(p: ElementTree.Element, links: dict[str, str]) -> str:
    out = ""
    for e in p:
        if e.tag == f"{_W}r":
            out += _run_markdown(e)
        elif e.tag == f"{_W}hyperlink":
            inner = "".join(_run_markdown(r) for r in e.iter(f"{_W}r"))
            target = links.get(e.get(f"{_R}id", ""))
            out += f"[{inner}]({target})" if target else inner
        elif e.tag in (f"{_W}ins", f"{_W}smartTag"):
            out += "".join(_run_markdown(r) for r in e.iter(f"{_W}r"))
    return out.replace("****", "").strip()


def docx_markdown(content: bytes) -> str:
    """A Word file as Markdown: headings, lists, emphasis, links and tables; empty paragraphs are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        links = _relations(z, "word/_rels/document.xml.rels")
    out: list[tuple[str, str]] = []
    for e in body if body is not None else ():
        if e.tag == f"{_W}p" and (t := _paragraph_markdown(e, links)):
            level = re.fullmatch(r"Heading(\d)", _style(e))
            depth = e.find(f"{_W}pPr/{_W}numPr/{_W}ilvl")
            if level:
                out.append(("p", "#" * int(level[1]) + " " + t))
            elif e.find(f"{_W}pPr/{_W}numPr") is not None or _style(e).startswith("List"):
                out.append(("li", "  " * int(depth.get(f"{_W}val", "0") if depth is not None else 0) + "- " + t))
            else:
                out.append(("p", t))
        elif e.tag == f"{_W}tbl":
            cell = lambda c: " ".join(x for p in c.iter(f"{_W}p") if (x := _paragraph_markdown(p, links)))
            out.append(("p", "\n".join("| " + " | ".join(cell(c) for c in r.iter(f"{_W}tc")) + " |" for r in e.iter(f"{_W}tr"))))
    text = ""
    for i, (kind, t) in enumerate(out):
        text += ("" if not i else "\n" if kind == "li" == out[i - 1][0] else "\n\n") + t
    return text


def docx_paragraphs(content: bytes) -> list[str]:
    """The plain text of the body's paragraphs that aren't empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    texts = ("".join(t.text or "" for t in p.iter(f"{_W}t")).strip() for p in (body.iter(f"{_W}p") if body is not None else ()))
    return [t for t in texts if t]


CONVERTED = "success boolean, markdown_content string, error_message string, metadata map<string,string>, original_file_size bigint, markdown_length bigint, markdown_lines bigint, markdown_words bigint, conversion_tool string"


def _converted(content, name: str) -> tuple:
    size = len(content) if content is not None else None
    try:
        if content is None:
            raise ValueError("no content, or larger than the limit")
        md = docx_markdown(bytes(content))
        meta = {"source": name, "paragraphs": str(len(docx_paragraphs(bytes(content))))}
        return bool(md), md or None, None if md else "no content", meta, size, len(md), len(md.split("\n")), len(md.split()), "docx"
    except Exception as e:  # noqa: BLE001  a broken file is a row, not a failed job
        return False, None, f"{type(e).__name__}: {e}", {"source": name}, size, 0, 0, 0, "docx"


def convert_docx(df: DataFrame, *, name: str, content: str) -> DataFrame:
    """(name, success, markdown_content, error_message, metadata, statistics) of Word files in a column of bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(n, *_converted(c, n)) for n, c in zip(b["n"], b["c"])], columns=["n", *(f.split()[0] for f in CONVERTED.split(", "))])

    return df.select(F.col(name).alias("n"), F.col(content).alias("c")).mapInPandas(run, f"n string, {CONVERTED}").withColumnRenamed("n", name)


def docx_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """:func:`convert_docx` of the Word files under a path, the name being the path."""
    return convert_docx(binary_files(spark, path, "*.docx", **options), name="path", content="content")


def xlsx_sheets(content: bytes) -> dict[str, list[list[str | None]]]:
    """Sheet name -> rows of cell texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        parts = _relations(z, "xl/_rels/workbook.xml.rels")
        out = {}
        for i, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"), 1):
            name, target = sheet.get("name"), parts.get(sheet.get(f"{_R}id", ""), f"worksheets/sheet{i}.xml")
            where = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            rows = []
            for r in ElementTree.fromstring(z.read(where)).iter(f"{_S}row"):
                cells: dict[int, str | None] = {}
                for k, c in enumerate(r.iter(f"{_S}c")):
                    ref = re.match(r"[A-Z]+", c.get("r") or "")
                    at = k
                    if ref:
                        at = 0
                        for ch in ref[0]:
                            at = at * 26 + ord(ch) - 64
                        at -= 1
                    v = c.find(f"{_S}v")
                    if c.get("t") == "s" and v is not None:
                        cells[at] = shared[int(v.text)]
                    elif c.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                    else:
                        cells[at] = v.text if v is not None else None
                rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
            out[name] = rows
    return out


def xlsx_rows(spark: SparkSession, path: str, **options) -> DataFrame:
    """(path, sheet, row_no, cells, error) of spreadsheets; a broken file is one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, c in zip(b["path"], b["content"]):
                try:
                    rows += [(p, s, i, r, None) for s, rs in xlsx_sheets(bytes(c)).items() for i, r in enumerate(rs)]
                except Exception as e:  # noqa: BLE001
                    rows.append((p, None, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["path", "sheet", "row_no", "cells", "error"])
            out["row_no"] = out["row_no"].astype("Int64")
            yield out

    files = binary_files(spark, path, "*.xlsx", **options).select("path", "content")
    return files.mapInPandas(run, "path string, sheet string, row_no bigint, cells array<string>, error string")


def xlsx_table(rows: DataFrame, sheet: str) -> DataFrame:
    """One sheet as a table, its first row being the header."""
    mine = rows.filter(F.col("sheet") == sheet)
    head = mine.filter("row_no = 0").first()
    names = [c or f"column_{i}" for i, c in enumerate(head.cells)] if head else []
    return mine.filter("row_no > 0").select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def csv_table(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(header=True, inferSchema=True, **options).csv(path)


def mapping_rows(spark: SparkSession, path: str) -> DataFrame:
    """(section_no, title, question_no, label, filename) of a mapping file, either key for the file's name."""
    m = spark.read.option("multiLine", True).json(path).select(F.explode("sections").alias("s"))
    q = m.select(F.col("s.index").alias("section_no"), F.col("s.title").alias("title"), F.explode_outer("s.questions").alias("q"))
    fields = set(q.schema["q"].dataType.fieldNames())
    name = F.coalesce(*[F.col(f"q.{n}") for n in ("html_filename", "filename") if n in fields])
    return q.select("section_no", "title", F.col("q.index").alias("question_no"), F.col("q.label").alias("label"), name.alias("filename"))


def json_texts(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(path, text) of JSON written by a model, its fences removed."""
    return text_files(spark, path, pattern).select("path", without_fences(F.col("text")).alias("text"))


def readable_files(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """(path, length, readable): whether each file, of any size, is UTF-8 text."""
    files = binary_files(spark, path, pattern, most=None)
    return files.select("path", "length", F.coalesce(F.try_validate_utf8(F.col("content").cast("string")).isNotNull(), F.lit(False)).alias("readable"))


def stale_files(spark: SparkSession, path: str, hours: float, pattern: str = "*") -> DataFrame:
    """The files last written more than ``hours`` ago, of which parts count."""
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros("modificationTime")
    return binary_files(spark, path, pattern, most=-1).filter(age > F.lit(int(hours * 3_600_000_000))).select("path", "modificationTime")


def delete_stale(spark: SparkSession, path: str, hours: float, pattern: str = "*") -> list[str]:
    """Delete the stale files and give their paths."""
    gone = [r.path for r in stale_files(spark, path, hours, pattern).orderBy("path").collect()]
    for name in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(name)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    return gone


def sessions(spark: SparkSession, path: str) -> DataFrame:
    """(session_id, checkpoints, last_updated) of the checkpoints under a path, the newest first."""
    rows = spark.read.parquet(path)
    return rows.groupBy("session_id").agg(F.count("*").alias("checkpoints"), F.max("saved_at").alias("last_updated")).orderBy(F.desc("last_updated"), "session_id")


def settings(path: str, known: dict[str, str]) -> dict[str, str]:
    """The settings of an env file, of the environment where that has them, else the known defaults; unknown names are left out."""
    import os

    found = dict(known)
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, sign, value = line.strip().partition("=")
                if sign and not name.startswith("#") and name.strip() in known:
                    found[name.strip()] = value.strip().strip("\"'")
    return {n: os.environ.get(n, v) for n, v in found.items()}
