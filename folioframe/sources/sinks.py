"""Writing chunks, mappings, surveys, reports and checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import safe_label


def chunk_names(index: Column, width: int = 3) -> Column:
    """``chunk_000.md`` and so on, from 0; a longer number keeps all its digits."""
    return F.format_string(f"chunk_%0{width}d.md", index.cast("bigint"))


def write_chunks(chunks: DataFrame, path: str, *, doc: str = "doc_id") -> None:
    """Chunks with their file names, partitioned by document."""
    chunks.withColumn("filename", chunk_names(F.col("chunk_index"))).write.mode("overwrite").partitionBy(doc).parquet(path)


def question_names(section_no: Column, title: Column, question_no: Column, label: Column) -> Column:
    return F.format_string("%03d_%s__%03d_%s.html", section_no, safe_label(title, "section"), question_no, safe_label(label, "chunk"))


def mapping_json(m: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, mapping) with the sections in order and their totals."""
    s = F.struct(F.col("section_no").alias("index"), F.col("section_title").alias("title"), "filename", "question_count")
    totals = m.groupBy(key).agg(F.array_sort(F.collect_list(s)).alias("sections"), F.count("*").alias("n"), F.sum("question_count").alias("q"))
    return totals.select(key, F.to_json(F.struct(F.struct(F.col("n").alias("total_sections"), F.col("q").alias("total_questions")).alias("metadata"), "sections")).alias("mapping"))


def with_provenance(json: Column, **facts: Column) -> Column:
    return F.to_json(F.struct(F.struct(*[c.alias(n) for n, c in facts.items()]).alias("metadata"), json.alias("data")))


def write_json(df: DataFrame, path: str, *, replace: bool = False) -> None:
    """One JSON object a line; an existing result stays unless it is to be replaced."""
    df.write.mode("overwrite" if replace else "errorifexists").json(path)


def write_json_version(df: DataFrame, path: str) -> str:
    """As :func:`write_json`; an existing result is moved to a name with the time first. The backup's path, or an empty string."""
    from datetime import datetime, timezone

    spark = df.sparkSession
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    backup = ""
    if files.exists(here):
        backup = f"{path.rstrip('/')}.backup-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
        files.rename(here, spark._jvm.org.apache.hadoop.fs.Path(backup))
    write_json(df, path)
    return backup


#: the folders of a run's output
FOLDERS = ("output", "monitoring", "temp")


def output_paths(root: str, name: str) -> dict[str, str]:
    """Where the results, the reports and the temporary files of a document go, and the name of its result."""
    stem = name.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    return {**{f: f"{root.rstrip('/')}/{f}" for f in FOLDERS}, "result": f"{root.rstrip('/')}/output/{stem}_survey.json"}


def structure_map_json(m: DataFrame, *, doc: str = "doc_id", strategy: str = "delimiter") -> DataFrame:
    """(doc, structure_map): the structure map of each document as one JSON text, chunks in order."""
    kept = ("chunk_index", "size", "lines", "has_section_header", "section_title", "section_position", "elements_count", "has_value_table", "has_variable_table", "table_row_count", "has_table", "starts_with", "next_section_element_position", "chunk_type", "priority")
    rows = m.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(*kept))).alias("chunks_info"))
    whole = F.struct(F.lit("questionnaire_markdown").alias("document_type"), F.size("chunks_info").alias("total_chunks"), F.lit(strategy).alias("splitting_strategy"), "chunks_info")
    return rows.select(doc, F.to_json(whole).alias("structure_map"))


def markdown_mapping_json(m: DataFrame, markdown: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, mapping): the mapping of each page with the Markdown name beside each file's name, and how much was converted."""
    stats = markdown.select(key, F.struct(F.length("markdown").alias("markdown_length"), F.size(F.split("markdown", "\n")).alias("markdown_lines")).alias("conversion_stats"))
    md = lambda c: F.regexp_replace(c, r"\.html$", ".md")
    questions = F.transform("questions", lambda q: F.struct(q["index"].alias("index"), q["label"].alias("label"), q["filename"].alias("html_filename"), md(q["filename"]).alias("md_filename")))
    s = F.struct(F.col("section_no").alias("index"), F.col("section_title").alias("title"), F.col("filename").alias("html_filename"), md("filename").alias("md_filename"), "question_count", questions.alias("questions"))
    rows = m.groupBy(key).agg(F.array_sort(F.collect_list(s)).alias("sections")).join(stats, key, "left")
    return rows.select(key, F.to_json(F.struct("sections", "conversion_stats")).alias("mapping"))


def write_markdown_files(df: DataFrame, path: str, *, name: str, text: str) -> DataFrame:
    """Write each text to a file of its name under a folder all workers share; (name, bytes, error) of each."""
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(path)
        filesystem.create_dir(root, recursive=True)
        for b in batches:
            out = []
            for n, t in zip(b["n"], b["t"]):
                try:
                    data = (t or "").encode("utf-8")
                    with filesystem.open_output_stream(f"{root}/{n}") as f:
                        f.write(data)
                    out.append((n, len(data), None))
                except OSError as e:
                    out.append((n, None, str(e)))
            yield pd.DataFrame(out, columns=["name", "bytes", "error"]).astype({"bytes": "Int64"})

    return df.select(F.col(name).alias("n"), F.col(text).alias("t")).mapInPandas(run, "name string, bytes bigint, error string")


def debug_dump(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """(doc, filename, text): each chunk behind a header of comments with its details, as the debug view writes them."""
    from folioframe.operators.structure import chunk_details

    d = chunk_details(chunks, doc=doc).select(doc, "chunk_index", "kind", "size", "line_count", F.array_join("markers", ", ").alias("marks"))
    line = lambda n, c: F.concat(F.lit(f"<!-- {n}: "), F.col(c).cast("string"), F.lit(" -->"))
    head = F.concat_ws("\n", line("chunk", "chunk_index"), line("type", "kind"), line("characters", "size"), line("lines", "line_count"), line("markers", "marks"))
    return chunks.join(d, [doc, "chunk_index"]).select(doc, chunk_names(F.col("chunk_index")).alias("filename"), F.concat(head, F.lit("\n\n"), "chunk").alias("text"))


def write_checkpoints(rows: DataFrame, path: str) -> None:
    """Append-only checkpoint records by session and type."""
    rows.write.mode("append").partitionBy("session_id", "cp_type").parquet(path)


def diff_style(diff: Column) -> Column:
    """The colour name a diff row is shown in."""
    return F.when(diff.isNull(), "plain").when(diff == "ADDED", "green").when(diff == "REMOVED", "red").otherwise("yellow")


def write_diff(diffs: DataFrame, path: str) -> None:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in diffs.columns]
    diffs.select(*text, diff_style(F.col("diff")).alias("style")).write.mode("overwrite").option("header", True).csv(path)


_COLORS = {"green": "FFC6EFCE", "red": "FFFFC7CE", "yellow": "FFFFEB9C"}


def diff_workbook(columns: list[str], rows: list[tuple]) -> bytes:
    """A spreadsheet file of a diff, rows coloured by the style in their last column; for a diff that fits into one sheet."""
    import io
    import zipfile
    from html import escape

    styles = ["plain", *_COLORS]
    cell = lambda v, s: f'<c t="inlineStr" s="{s}"><is><t xml:space="preserve">{escape(excel_safe(v))}</t></is></c>'
    line = lambda values, s: "<row>" + "".join(cell(v, s) for v in values) + "</row>"
    body = line(columns[:-1], 0) + "".join(line(r[:-1], styles.index(r[-1]) if r[-1] in styles else 0) for r in rows)
    space = "http://schemas.openxmlformats.org"
    main, relation = f"{space}/spreadsheetml/2006/main", f"{space}/officeDocument/2006/relationships"
    fills = '<fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>' + "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in _COLORS.values())
    formats = "".join(f'<xf fillId="{k + 1 if k else 0}" applyFill="1"/>' for k in range(len(styles)))
    kind = f"{space}/package/2006"
    office = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{kind}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{office}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{office}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{office}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{kind}/relationships"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{relation}"><sheets><sheet name="diff" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{kind}/relationships"><Relationship Id="rId1" Type="{relation}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{relation}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills>{fills}</fills><borders count="1"><border/></borders><cellXfs>{formats}</cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


def excel_safe(value) -> str:
    """A value as a cell can hold it: null is empty, control characters go, no more than 32,767 characters."""
    text = "" if value is None else str(value)
    return "".join(c for c in text if c >= " " or c in "\t\n\r")[:32_767]


def write_diff_workbook(diffs: DataFrame, path: str, *, most: int = 1_048_575) -> bool:
    """Write a diff as one spreadsheet; a diff of more rows than a sheet holds goes to CSV instead, and the outcome is False."""
    if diffs.limit(most + 1).count() > most:
        write_diff(diffs, path)
        return False
    styled = diffs.withColumn("style", diff_style(F.col("diff")))
    with open(path, "wb") as f:
        f.write(diff_workbook(styled.columns, [tuple(r) for r in styled.collect()]))  # no more than a sheet
    return True


def html_page(body: Column) -> Column:
    return F.concat(F.lit("<html><body>\n"), body, F.lit("\n</body></html>"))


def summary_text(stats: DataFrame) -> DataFrame:
    """The split statistics of each row as lines of text."""
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in stats.columns]
    return stats.select(F.concat_ws("\n", *lines).alias("summary"))
