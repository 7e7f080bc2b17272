"""Files and web pages to markdown. Rows are converted in Arrow batches; a failed file gives an error, not a failed job."""

from __future__ import annotations

import io
import re
import subprocess
import zipfile
from collections.abc import Callable, Mapping, Sequence
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.sheets import related, xlsx

#: What a folder is searched for; ``convert`` takes .htm too.
FORMATS = (".docx", ".html", ".md", ".pdf", ".pptx", ".txt", ".xlsx")


class _Markdown(HTMLParser):
    """Collects markdown: headers, paragraphs, lists (numbered ones too), quotes, emphasis, code, rules and tables."""

    BLOCKS = frozenset("p div section article table ul ol dl pre blockquote".split())
    HIDDEN = frozenset("script style head".split())
    # Marks around text.
    MARKS = {"b": "**", "strong": "**", "i": "_", "em": "_", "code": "`", "del": "~~", "s": "~~"}

    def __init__(self):
        super().__init__()
        self.parts: list[str] = []
        self.hidden: list[str] = []
        self.lists: list[int] = []  # the number before the next item; none for plain lists
        self.cells: list[int] = []  # by open table: cells of the row at hand
        self.heads: list[int] = []  # by open table: rows so far
        self.plain = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.hidden.append(tag)
        elif re.fullmatch("h[1-6]", tag):
            self.parts.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            mark = "* "
            if self.lists and self.lists[-1] >= 0:
                self.lists[-1] += 1
                mark = f"{self.lists[-1]}. "
            self.parts.append("\n" + "\u0001" * max(0, len(self.lists) - 1) + mark)
        elif tag == "br":
            self.parts.append("\n")
        elif tag == "hr":
            self.parts.append("\n\n* * *\n\n")
        elif tag in ("td", "th"):
            if self.cells:
                self.parts.append(" | " if self.cells[-1] else "")
                self.cells[-1] += 1
        elif tag == "tr":
            self.parts.append("\n")
            if self.cells:
                self.cells[-1] = 0
        elif tag in self.MARKS and not self.plain:
            self.parts.append(self.MARKS[tag])
        elif tag in self.BLOCKS:
            self.parts.append("\n\n")
            if tag in ("ul", "ol"):
                self.lists.append(0 if tag == "ol" else -1)
            elif tag == "table":
                self.cells.append(0), self.heads.append(0)
            elif tag == "blockquote":
                self.parts.append("> ")
            elif tag == "pre":
                self.plain += 1
                self.parts.append("```\n")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            while self.hidden and self.hidden.pop() != tag:
                pass
        elif tag == "tr" and self.cells:
            self.heads[-1] += 1
            if self.heads[-1] == 1 and self.cells[-1]:
                self.parts.append("\n" + "|".join(["---"] * self.cells[-1]))
        elif tag in self.MARKS and not self.plain:
            self.parts.append(self.MARKS[tag])
        elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag == "table" and self.cells:
                self.cells.pop(), self.heads.pop()
            elif tag == "pre" and self.plain:
                self.plain -= 1
                self.parts.append("\n```")
            self.parts.append("\n\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data.replace("\n", "\n\u0002") if self.plain else re.sub(r"\s+", " ", data))


def html_text(html: str | None) -> str:
    """Markdown of a page; links keep their text only, lines are not wrapped. Null is empty."""
    parser = _Markdown()
    parser.feed(html or "")
    parser.close()
    lines = "\n".join(line.rstrip() if line.startswith("\u0002") else line.strip() for line in "".join(parser.parts).split("\n"))
    # Marks of the parser: an indented item, a line of code that keeps its blanks.
    return re.sub(r"\n{3,}", "\n\n", lines).strip().replace("\u0001", "  ").replace("\u0002", "")


def html_table(df: DataFrame, html_col: str) -> DataFrame:
    """``df`` with the markdown of its pages in place of ``html_col``, in Arrow batches."""

    @F.arrow_udf("string")
    def converted(pages: pa.Array) -> pa.Array:
        return pa.array(map(html_text, pages.to_pylist()), pa.string())

    return df.select(*[c for c in df.columns if c != html_col], converted(html_col).alias("markdown"))


def _texts(node: ElementTree.Element, paragraph: str, run: str) -> list[str]:
    made = ("".join(t.text or "" for t in p.iter(run)) for p in node.iter(paragraph))
    return [t for t in made if t.strip()]


def _docx(data: bytes) -> str:
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    found = [_texts(p, f"{w}p", f"{w}t") for p in body.findall(f"{w}p")]
    return "\n\n".join(t for one in found for t in one)


def _pptx(data: bytes) -> str:
    """Slides in their order with the text of their shapes and, where there are any, their notes."""
    a = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        slides = []
        for k, name in enumerate(names, 1):
            shown = [f"### Slide {k}", *_texts(ElementTree.fromstring(z.read(name)), f"{a}p", f"{a}t")]
            for part in related(z, name).values():
                if "/notesSlides/" in part and part in z.namelist():
                    notes = "\n".join(_texts(ElementTree.fromstring(z.read(part)), f"{a}p", f"{a}t"))
                    shown += [f"\nNotes:\n{notes}"] if notes.strip() else []
            slides.append("\n".join(shown))
    return "\n\n".join(slides)


def to_markdown(suffix: str, data: bytes) -> str:
    if suffix == ".docx":
        return _docx(data)
    if suffix == ".pptx":
        return _pptx(data)
    if suffix == ".xlsx":
        return xlsx(data)
    if suffix in (".htm", ".html"):
        return html_text(data.decode("utf-8", "replace"))
    if suffix in (".md", ".txt"):
        return data.decode("utf-8")
    raise ValueError(f"no converter for {suffix}")


def convert(files: DataFrame, more: Mapping[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """path, suffix, markdown, error of rows with path and content; works on batch and streaming tables. ``more`` has
    converters of further suffixes, as for .pdf."""
    own = dict(more or {})
    named = files.select("path", F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("suffix"), "content")

    def run(batches):
        for pdf in batches:
            out = []
            for suffix, data in zip(pdf.suffix, pdf.content, strict=True):
                try:
                    data = bytes(data or b"")
                    out.append((own[suffix](data) if suffix in own else to_markdown(suffix, data), None))
                except Exception as e:  # noqa: BLE001 - a file's fault is that file's row
                    out.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame({"path": pdf.path, "suffix": pdf.suffix, "markdown": [m for m, _ in out], "error": [e for _, e in out]})

    return named.mapInPandas(run, "path string, suffix string, markdown string, error string")


def folder(spark: SparkSession, path: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Files below ``path`` in a known format, as path and content; ValueError if there are none. Tables have no order:
    what comes after numbers files by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*formats)).select("path", "content")
    if found.select("path").isEmpty():
        raise ValueError(f"no supported files in {path}")
    return found


def command(*line: str) -> Callable[[bytes], str]:
    """A converter that runs a program of one's own, as for .pdf: it gets the file on its standard input and writes
    markdown; a failure is that file's error."""

    def run(data: bytes) -> str:
        return subprocess.run(line, input=data, capture_output=True, check=True, timeout=600).stdout.decode("utf-8")

    return run
