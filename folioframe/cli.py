"""Command line: convert Word files, split, extract, validate and compare.

    python -m folioframe.cli convert IN OUT
    python -m folioframe.cli split IN OUT [--mode cascade] [--size 2000] [--overlap 200]
    python -m folioframe.cli survey IN OUT
    python -m folioframe.cli validate IN
    python -m folioframe.cli clean-html IN OUT
    python -m folioframe.cli diff A.csv B.csv OUT --key K [--key K]
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from folioframe.operators import assemble, chunking, diff, extract, html, metrics
from folioframe.session import local_session, ship
from folioframe.sources import files, sinks


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="folioframe")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("convert", "split", "survey", "clean-html"):
        s = sub.add_parser(name)
        s.add_argument("source")
        s.add_argument("target")
        if name == "split":
            s.add_argument("--mode", default="cascade")
            s.add_argument("--size", type=int, default=2000)
            s.add_argument("--overlap", type=int, default=200)
    sub.add_parser("validate").add_argument("source")
    d = sub.add_parser("diff")
    d.add_argument("source")
    d.add_argument("compare")
    d.add_argument("target")
    d.add_argument("--key", action="append", required=True)
    a = p.parse_args(argv)

    spark = local_session()
    ship(spark)
    if a.command == "convert":
        sinks.write_json(files.docx_files(spark, a.source), a.target)
    elif a.command == "split":
        docs = files.text_files(spark, a.source).withColumnRenamed("path", "doc_id")
        sinks.write_json(chunking.split_documents(docs, a.mode, key="doc_id", text="text", size=a.size, overlap=a.overlap), a.target)
    elif a.command == "survey":
        docs = files.text_files(spark, a.source).withColumnRenamed("path", "doc_id")
        chunks = chunking.explode_chunks(docs, chunking.by_delimiter(F.col("text")), keep=["doc_id"])
        sinks.write_json(assemble.survey_json(extract.rule_extract(chunks)), a.target)
    elif a.command == "validate":
        metrics.validate_stats(files.text_files(spark, a.source), key="path", text="text").show(1000, truncate=False)
    elif a.command == "clean-html":
        sinks.write_json(html.to_markdown(files.html_files(spark, a.source), key="path"), a.target)
    elif a.command == "diff":
        both = [diff.normalize_columns(files.csv_table(spark, x)) for x in (a.source, a.compare)]
        sinks.write_diff(diff.keyed_diff(*both, a.key), a.target)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
