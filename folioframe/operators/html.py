"""HTML as rows of nodes: sections, questions, cleaning, and Markdown.

``nodes`` turns each page into one row for each node in document order; the rest
are relational operators over those rows. Null and empty pages have no nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.text import strip
from folioframe.operators.extract import strip_prefix

# Attributes the cleaner takes away, elements without an end tag, the end line's attributes.
DROPPED = ("width", "align", "size", "cellpadding", "cellspacing", "valign", "height")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
END_LINE = {"lang": "en-US", "class": "western", "style": "line-height: 100%; margin-bottom: 0in"}
BLUE = "#0070c0"

NODES = "node_id int, parent_id int, depth int, tag string, attrs map<string,string>, text string, inner_text string, body_child int, top boolean, has_bold boolean, has_blue boolean"


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.children = 0

    def _add(self, tag: str, attrs: dict, text: str | None) -> int:
        parent = self.open[-1] if self.open else -1
        in_body = next((k for k in reversed(self.open) if self.rows[k]["tag"] == "body"), None)
        child = self.rows[parent]["body_child"] if parent >= 0 else None
        top = in_body is not None and parent == in_body
        if in_body is not None and parent == in_body:
            child = self.children
            self.children += 1
        self.rows.append({"node_id": len(self.rows), "parent_id": parent, "depth": len(self.open), "tag": tag, "attrs": attrs, "text": text, "inner": [], "body_child": child, "top": top, "has_bold": False, "has_blue": False})
        return len(self.rows) - 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = {k: v or "" for k, v in attrs}
        k = self._add(tag, found, None)
        for up in self.open:
            self.rows[up]["has_bold"] |= tag == "b"
            self.rows[up]["has_blue"] |= tag == "font" and found.get("color") == BLUE
        if tag not in VOID:
            self.open.append(k)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]]["tag"] == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self._add("#text", {}, data)
        for up in self.open:
            self.rows[up]["inner"].append(data.strip())


def parse(html: str) -> list[dict]:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    for r in tree.rows:
        inner = "".join(r.pop("inner"))
        r["inner_text"] = inner if r["tag"] != "#text" else r["text"]
    return tree.rows


def nodes(df: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, node_id, parent_id, depth, tag, attrs, text, inner_text, body_child, top, has_bold, has_blue).

    ``inner_text`` is that of all text nodes within, each stripped; ``top`` marks the
    body's own children, ``body_child`` which of them a node belongs to.
    """
    names = [f.split(" ")[0] for f in NODES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *(r[n] for n in names)) for k, h in zip(b["k"], b["h"]) if h for r in parse(h)]
            yield pd.DataFrame(rows, columns=["k", *names])

    rows = df.select(F.col(key).alias("k"), F.col(html).alias("h"))
    return rows.mapInPandas(run, f"k {rows.schema['k'].dataType.simpleString()}, {NODES}").withColumnRenamed("k", key)


def body_html(html: Column) -> Column:
    """The inner HTML of the body, the whole where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(html, r"(?is)<body[^>]*>(.*)</body>", 1), F.lit("")), html)


def sections(n: DataFrame, *, key: str = "page_id") -> DataFrame:
    """The nodes of the body with ``section_no`` from 0 and its title.

    A section begins with an ``h1`` among the body's own children that has a title,
    the text of its first ``font``, else its own. What comes before the first is left
    out, as is what follows an ``h1`` without a title.
    """
    order = Window.partitionBy(key).orderBy("node_id")
    heading = F.col("top") & (F.col("tag") == "h1")
    fonts = n.filter("tag = 'font'").groupBy(key, "body_child").agg(F.min_by("inner_text", "node_id").alias("font_text"))
    rows = n.filter("body_child is not null").join(fonts, [key, "body_child"], "left")
    title = F.when(heading, F.coalesce("font_text", "inner_text"))
    rows = rows.withColumn("section_title", F.last(title, ignorenulls=True).over(order)).withColumn("section_no", F.sum(F.when(title != "", 1).otherwise(0)).over(order) - 1)
    return rows.filter("section_title <> ''").drop("font_text")


def question_start(tag: Column, text: Column, bold: Column, blue: Column, *, need_blue: bool = True) -> Column:
    return (tag == "p") & bold & (blue if need_blue else F.lit(True)) & F.contains(text, F.lit(":")) & (F.length(text) > 4)


def questions(s: DataFrame, *, key: str = "page_id", need_blue: bool = True) -> DataFrame:
    """The nodes of sections with ``question_no`` from 0 within the section and its label; what comes before the first question is left out."""
    order = Window.partitionBy(key, "section_no").orderBy("node_id")
    start = F.col("top") & question_start(F.col("tag"), F.col("inner_text"), F.col("has_bold"), F.col("has_blue"), need_blue=need_blue)
    rows = s.withColumn("question_no", F.sum(F.when(start, 1).otherwise(0)).over(order) - 1).filter("question_no >= 0")
    return rows.withColumn("question_label", F.concat(F.lit("question_"), "question_no"))


def mapping(s: DataFrame, q: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, section_no, title, filename, question_count, questions) with the questions' labels and file names."""
    from folioframe.functions.text import safe_label

    stem = F.format_string("%03d_%s", F.col("section_no"), safe_label(F.col("section_title"), "section"))
    name = F.concat(stem, F.format_string("__%03d_%s.html", "question_no", "question_label"))
    each = q.select(key, "section_no", F.struct(F.col("question_no").alias("index"), F.col("question_label").alias("label"), name.alias("filename")).alias("q")).distinct()
    by_section = each.groupBy(key, "section_no").agg(F.array_sort(F.collect_list("q")).alias("questions"))
    heads = s.select(key, "section_no", "section_title", F.concat(stem, F.lit(".html")).alias("filename")).distinct()
    rows = heads.join(by_section, [key, "section_no"], "left")
    none = F.array().cast(by_section.schema["questions"].dataType)
    return rows.select(key, "section_no", "section_title", "filename", F.size(F.coalesce("questions", none)).cast("bigint").alias("question_count"), F.coalesce("questions", none).alias("questions"))


def legacy_chunks(n: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, chunk_no, code, node_ids): the body's own children by questions that a ``[TYPE]`` in their paragraph marks.

    A question goes on until a line ``===``; paragraphs before the first one are the
    preface, a paragraph between two questions begins one of its own, and what
    belongs to none is the epilogue.
    """
    text = F.when(F.col("tag") == "#text", strip(F.col("text"))).otherwise(F.col("inner_text"))
    rows = n.filter("top").withColumn("t", F.coalesce(text, F.lit("")))
    order = Window.partitionBy(key).orderBy("node_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    typed = (F.col("tag") == "p") & F.col("t").rlike(r"\[\w+\]")
    rows = rows.withColumn("typed", typed).withColumn("seen", F.coalesce(F.max(typed).over(order), F.lit(False)))
    # a chunk is open from its start to its end line; then the next paragraph starts one
    closing = F.col("seen") & (F.col("t") == "===")
    rows = rows.withColumn("after_end", F.coalesce(F.sum(F.when(closing, 1).otherwise(0)).over(before), F.lit(0)))
    run = Window.partitionBy(key, "after_end").orderBy("node_id")
    plain_start = F.col("seen") & ~F.col("typed") & (F.col("tag") == "p") & (F.col("after_end") > 0)
    first_plain = plain_start & (F.sum(F.when(plain_start | F.col("typed"), 1).otherwise(0)).over(run) == 1)
    start = F.col("typed") | first_plain
    rows = rows.withColumn("start", start).withColumn("in_run", F.sum(F.when(start, 1).otherwise(0)).over(run)).withColumn("n", F.sum(F.when(start, 1).otherwise(0)).over(order))
    code = F.when(F.col("start"), F.coalesce(F.nullif(strip(F.when(F.col("typed"), F.substring_index("t", "[", 1)).otherwise(F.col("t"))), F.lit("")), F.lit("chunk")))
    part = F.when(~F.col("seen"), F.lit(-1)).when(F.col("in_run") > 0, F.col("n")).otherwise(F.lit(1 << 30))
    grouped = rows.withColumn("part", part).withColumn("code", code).groupBy(key, "part").agg(F.max("code").alias("code"), F.array_sort(F.collect_list("node_id")).alias("node_ids"))
    name = F.when(F.col("part") == -1, "preface").when(F.col("part") == 1 << 30, "epilogue").otherwise(F.col("code"))
    return grouped.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("part")) - 1).cast("bigint").alias("chunk_no"), name.alias("code"), "node_ids")


def clean_attributes(n: DataFrame) -> DataFrame:
    """Of ``style`` only the colour stays; layout attributes, the plain language and class go."""
    color = F.regexp_extract(F.col("attrs")["style"], r"(?i)(?:^|;)\s*(color\s*:\s*[^;]+)", 1)
    kept = F.map_filter("attrs", lambda k, v: ~k.isin("style", *DROPPED) & ~((k == "lang") & (v == "en-US")) & ~((k == "class") & (v == "western")))
    styled = F.when(color != "", F.map_concat(kept, F.create_map(F.lit("style"), strip(color)))).otherwise(kept)
    return n.withColumn("attrs", F.coalesce(styled, kept))


def is_end_line(attrs: Column) -> Column:
    out = F.lit(True)
    for k, v in END_LINE.items():
        out = out & (F.coalesce(attrs[k], F.lit("")) == v)
    return out


def drop_empty_paragraphs(n: DataFrame) -> DataFrame:
    return n.filter((F.col("tag") != "p") | (F.coalesce(strip(F.col("inner_text")), F.lit("")) != "") | is_end_line(F.col("attrs")))


def table_labels(n: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, node_id, label): the label paragraph before each table, ``OTHER TABLE`` without one; a label serves one table."""
    t = F.upper(strip(F.col("inner_text")))
    label = F.when((F.col("tag") == "p") & t.isin("VARIABLES TABLE", "COLUMNS TABLE"), t).when(F.col("tag") == "table", F.lit("used"))
    before = Window.partitionBy(key).orderBy("node_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = n.withColumn("near", F.last(label, ignorenulls=True).over(before)).filter("tag = 'table'")
    return rows.select(key, "node_id", F.when(F.coalesce("near", F.lit("used")) == "used", "OTHER TABLE").otherwise(F.col("near")).alias("label"))


def cell_codes(cells: Column) -> Column:
    return F.transform(cells, lambda c, i: F.when(i == 0, strip_prefix(c)).otherwise(c))


def leftover_nodes(n: DataFrame, used: DataFrame, *, key: str = "page_id") -> DataFrame:
    return n.join(used.select(key, "node_id"), [key, "node_id"], "left_anti")


def question_parts(q: DataFrame, *, key: str = "page_id") -> DataFrame:
    """(key, section_no, question_no, code, type, label, content): the label goes until ``===``, the rest is content."""
    lines = q.filter("tag in ('p', 'td', 'li')").groupBy(key, "section_no", "question_no").agg(F.array_sort(F.collect_list(F.struct("node_id", F.col("inner_text").alias("t")))).alias("x"))
    text = F.array_join(F.transform("x", lambda r: r["t"]), "\n")
    halves = F.split(text, "===", 2)
    head = halves[0]
    code, kind = F.regexp_extract(head, r"^\s*([\w.-]+)", 1), F.regexp_extract(head, r"\[([A-Z0-9_]+)\]", 1)
    label = strip(F.regexp_replace(head, r"^\s*[\w.-]+\s*(?:\[[A-Z0-9_]+\])?\s*:?\s*", ""))
    return lines.select(key, "section_no", "question_no", code.alias("code"), F.coalesce(F.nullif(kind, F.lit("")), F.lit("CHOICE")).alias("type"), label.alias("label"), strip(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("content"))


def collapse_markdown(c: Column) -> Column:
    """Line ends stripped, runs of blank lines made one, outer white space stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?md)[ \t\r]+$", ""), r"\n{3,}", "\n\n"))


def to_markdown(df: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, markdown): headings, paragraphs, emphasis, bullets, highlights and pipe tables."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "markdown": [_markdown(h) for h in b["h"]]})

    rows = df.select(F.col(key).alias("k"), F.col(html).alias("h"))
    out = rows.mapInPandas(run, f"k {rows.schema['k'].dataType.simpleString()}, markdown string")
    return out.select(F.col("k").alias(key), collapse_markdown(F.col("markdown")).alias("markdown"))


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.cells: list[str] | None = None
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "head"):
            self.skip += 1
        elif tag[0] == "h" and tag[1:].isdigit():
            self.out.append("\n\n" + "#" * int(tag[1:]) + " ")
        elif tag in ("p", "div", "ul", "ol", "table"):
            self.out.append("\n\n" if self.cells is None else " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "br":
            self.out.append("\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "mark":
            self.out.append("==")
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.out.append("\0")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "head"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "mark":
            self.out.append("==")
        elif tag in ("td", "th") and self.cells is not None and "\0" in self.out:
            at = len(self.out) - 1 - self.out[::-1].index("\0")
            self.cells.append(" ".join("".join(self.out[at + 1 :]).split()))
            del self.out[at:]
        elif tag == "tr" and self.cells is not None:
            self.out.append("\n| " + " | ".join(self.cells) + " |")
            self.cells = None

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(" ".join(data.split("\n")) if data.strip() else (" " if self.out and not self.out[-1].endswith(("\n", " ")) else ""))


def _markdown(html: str | None) -> str | None:
    if html is None:
        return None
    p = _Markdown()
    p.feed(html)
    p.close()
    return "".join(p.out).replace("\0", "")


class _Node:
    """A node of a page that is being cleaned: a tag with attributes and children, or text."""

    def __init__(self, tag: str, attrs: dict | None = None, text: str = "") -> None:
        self.tag, self.attrs, self.data = tag, attrs or {}, text
        self.kids: list[_Node] = []

    def text(self) -> str:
        return self.data.strip() if self.tag == "#" else "".join(k.text() for k in self.kids)

    def all(self, *tags: str) -> list[_Node]:
        out = [self] if self.tag in tags or (not tags and self.tag != "#") else []
        for k in self.kids:
            out += k.all(*tags)
        return out

    def html(self) -> str:
        if self.tag == "#":
            return escape(self.data, quote=False)
        inner = "".join(k.html() for k in self.kids)
        if self.tag == "":
            return inner
        attrs = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}/>" if self.tag in VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"

    def each(self, change) -> None:
        """Every child replaced by what ``change`` makes of it, from the leaves up."""
        for k in self.kids:
            k.each(change)
        self.kids = [x for k in self.kids for x in change(k)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = _Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), None)
        if at:
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(_Node("#", text=data))


def _only_color(style: str) -> str:
    pairs = [p.split(":", 1) for p in style.split(";") if ":" in p]
    return "; ".join(f"{k.strip()}: {v.strip()}" for k, v in pairs if k.strip().lower() == "color")


def _keep_styles(node: _Node) -> list[_Node]:
    for a in DROPPED:
        node.attrs.pop(a, None)
    if "style" in node.attrs:
        node.attrs["style"] = _only_color(node.attrs["style"])
        if not node.attrs["style"]:
            del node.attrs["style"]
    return [node]


def _unwrap_fonts(node: _Node) -> list[_Node]:
    return node.kids if node.tag == "font" else [node]


def _wrap_section(node: _Node) -> list[_Node]:
    found = _SECTION.match(node.text()) if node.tag in ("h1", "h2", "p") else None
    if not found:
        return [node]
    div = _Node("div", {"id": f"section-{found[1]}", "class": "section"})
    div.kids = [node]
    return [div]


_SECTION = re.compile(r"Section\s+(\d{3,4})\s*[-–—]?\s*(.*)", re.I)
LABELS = ("VARIABLES TABLE", "COLUMNS TABLE")


def _label_tables(root: _Node) -> None:
    """Label paragraphs go; the paragraph before a table gets the last of them before it, which serves once."""
    label = None

    def walk(node: _Node) -> None:
        nonlocal label
        kids = []
        for i, k in enumerate(node.kids):
            if k.tag == "p" and k.text().upper() in LABELS:
                label = k.text().upper()
                continue
            after = next((x for x in node.kids[i + 1 :] if x.tag != "#"), None)
            if k.tag == "p" and after is not None and after.tag == "table":
                mark = _Node("p")
                mark.kids = [_Node("#", text=f"[TABLE LABEL: {label or 'OTHER TABLE'}]")]
                kids.append(mark)
                label = None
            walk(k)
            kids.append(k)
        node.kids = kids

    walk(root)


def _short_codes(root: _Node) -> None:
    for row in (r for t in root.all("table") for r in t.all("tr")):
        cells = row.all("td")
        if cells and (m := re.match(r"Q\d{1,4}_(\d+)", cells[0].text())):
            cells[0].kids = [_Node("#", text=m[1])]


def _wrap_questions(body: _Node) -> None:
    """The body as question blocks of label and content, what belongs to none behind them."""
    questions: list[dict] = []
    rest: list[_Node] = []
    for el in (k for k in body.kids if k.tag != "#"):
        text = el.text()
        typed = re.search(r"\[(\w+)\]", text)
        if el.tag == "p" and (typed or not questions):
            questions.append({"code": text.split("[")[0].strip() if typed else text.strip(), "type": typed[1] if typed else "CHOICE", "label": [el], "content": [], "at": "label"})
            continue
        if not questions:
            rest.append(el)
            continue
        q = questions[-1]
        if q["at"] == "label":
            q["label"].append(el)
            q["at"] = "content" if text == "===" else "label"
        elif q["at"] == "content" and not _ends(el):
            q["content"].append(el)
        else:
            q["at"] = "done"
            rest.append(el)
    body.kids = []
    for q in questions:
        block = _Node("div", {"class": "question", "data-code": q["code"], "data-type": q["type"]})
        for part in ("label", "content"):
            if q[part]:
                div = _Node("div", {"class": part})
                div.kids = q[part]
                block.kids.append(div)
        body.kids.append(block)
    if rest:
        misc = _Node("div", {"class": "misc"})
        misc.kids = rest
        body.kids.append(misc)


def _ends(node: _Node) -> bool:
    return node.tag == "p" and all(node.attrs.get(k) == v for k, v in END_LINE.items())


def _drop_empty(node: _Node) -> list[_Node]:
    return [] if node.tag == "p" and not node.text() and not _ends(node) else [node]


def _flatten_cell(node: _Node) -> list[_Node]:
    if node.tag == "td":
        kids = node.kids
        if len(kids) == 1 and kids[0].tag == "p":
            node.kids = kids[0].kids
        elif kids and all(k.tag == "p" for k in kids):
            node.kids = [_Node("#", text=" ".join(k.text() for k in kids))]
    return [node]


def _plain_attrs(node: _Node) -> list[_Node]:
    for name, value in (("lang", "en-US"), ("class", "western")):
        if node.attrs.get(name) == value:
            del node.attrs[name]
    return [node]


def clean_page(html: str) -> str:
    """A page after all steps of the cleaner, in their order; a page without a body keeps what needs none."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    root = builder.root
    body = next(iter(root.all("body")), None)
    root.each(_keep_styles)
    root.each(_unwrap_fonts)
    if body:
        body.kids = [x for k in body.kids for x in _wrap_section(k)]
    _label_tables(root)
    _short_codes(root)
    if body:
        _wrap_questions(body)
    root.each(_drop_empty)
    root.each(_flatten_cell)
    root.each(_plain_attrs)
    return root.html()


def clean_pages(df: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, status, cleaned, error) of every page; a page that can't be cleaned is a row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, h in zip(b["k"], b["h"]):
                try:
                    rows.append((k, "ok", clean_page(h or ""), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((k, "failed", None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["k", "status", "cleaned", "error"])

    rows = df.select(F.col(key).alias("k"), F.col(html).alias("h"))
    return rows.mapInPandas(run, f"k {rows.schema['k'].dataType.simpleString()}, status string, cleaned string, error string").withColumnRenamed("k", key)
