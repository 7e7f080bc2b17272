"""Spreadsheets as markdown: one pipe table a sheet, from the file's own XML."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def related(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Targets of a part's relationships by id, as paths from the file's top; none where it has no such list."""
    folder, _, name = part.rpartition("/")
    listed = f"{folder}/_rels/{name}.rels"
    if listed not in z.namelist():
        return {}
    out = {}
    for r in ElementTree.fromstring(z.read(listed)).findall(f"{_PACKAGE}Relationship"):
        target, path = r.get("Target", ""), folder.split("/")
        if target.startswith("/"):
            path, target = [], target[1:]
        for step in target.split("/"):
            path = path[:-1] if step == ".." else [*path, step]
        out[r.get("Id", "")] = "/".join(path)
    return out


def _column(reference: str) -> int:
    """The place of a cell's column from 0: A is 0, AA is 26."""
    n = 0
    for letter in re.match("[A-Z]*", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _value(cell: ElementTree.Element, shared: list[str]) -> str | int | float | bool | None:
    kind, v = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    if v is None:
        return None
    if kind == "s":
        return shared[int(v)]
    if kind == "b":
        return v == "1"
    if kind == "n":
        number = float(v)
        return int(number) if number.is_integer() else number
    return v


def _rows(sheet: ElementTree.Element, shared: list[str]) -> list[list]:
    """Cells by row; cells and rows that the file leaves out are None."""
    rows: list[list] = []
    for row in sheet.iter(f"{_MAIN}row"):
        cells: list = []
        for cell in row.findall(f"{_MAIN}c"):
            at = _column(cell.get("r", "")) if cell.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            cells[at] = _value(cell, shared)
        rows += [[]] * (int(row.get("r", len(rows) + 1)) - 1 - len(rows))
        rows.append(cells)
    return rows


def pipe_table(rows: list[list]) -> str:
    """The first row as header, the others below it, columns as wide as their widest cell: text to the left, numbers
    to the right. A missing header is 'Unnamed: k', a missing cell 'nan'."""
    if not rows:
        return ""
    width = max(map(len, rows))
    head = [str(h) if h is not None else f"Unnamed: {k}" for k, h in enumerate([*rows[0], *[None] * (width - len(rows[0]))])]
    body = [[*r, *[None] * (width - len(r))] for r in rows[1:]]
    lines, rule = [[f" {h}" for h in head], *[[] for _ in body]], []
    for k, h in enumerate(head):
        held = [r[k] for r in body]
        numeric = bool(held) and all(v is None or (isinstance(v, int | float) and not isinstance(v, bool)) for v in held)
        shown = ["nan" if v is None else str(v) for v in held]
        wide = max([len(h) + 2, *map(len, shown)])
        pad = str.rjust if numeric else str.ljust
        lines[0][k] = pad(h, wide)
        for line, v in zip(lines[1:], shown, strict=True):
            line.append(pad(v, wide))
        rule.append("-" * (wide + 1) + ":" if numeric else ":" + "-" * (wide + 1))
    made = ["| " + " | ".join(line) + " |" for line in lines]
    return "\n".join([made[0], "|" + "|".join(rule) + "|", *made[1:]])


def xlsx(data: bytes) -> str:
    """All sheets in the workbook's order, each under its name."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        targets = related(z, "xl/workbook.xml")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            items = ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")
            shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in items]
        out = []
        for sheet in book.iter(f"{_MAIN}sheet"):
            rows = _rows(ElementTree.fromstring(z.read(targets[sheet.get(f"{_REL}id", "")])), shared)
            out.append(f"## Sheet: {sheet.get('name')}\n\n{pipe_table(rows)}\n")
    return "\n".join(out)
