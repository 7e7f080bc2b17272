import io
import zipfile

from docloom.sources.converters import convert
from docloom.sources.sheets import pipe_table, xlsx


def workbook(sheets, shared=()):
    """An xlsx file's bytes; ``sheets`` maps names to the XML of their rows."""
    main = "xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        listed = "".join(f"<sheet name='{n}' r:id='r{k}'/>" for k, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f"<workbook {main} xmlns:r='{rel}'><sheets>{listed}</sheets></workbook>")
        targets = "".join(f"<Relationship Id='r{k}' Target='worksheets/s{k}.xml'/>" for k in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>{targets}</Relationships>")
        for k, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{s}</t></si>' for s in shared)}</sst>")
    return out.getvalue()


PRICES = "<row r='1'><c r='A1' t='s'><v>0</v></c><c r='B1' t='s'><v>1</v></c></row><row r='2'><c r='A2' t='inlineStr'><is><t>pear</t></is></c><c r='B2'><v>12</v></c></row><row r='4'><c r='B4'><v>2.5</v></c></row>"


def test_sheets_become_pipe_tables():
    got = xlsx(workbook({"Prices": PRICES, "Empty": ""}, ["name", "n"]))
    table = "| name   |   n |\n|:-------|----:|\n| pear   |  12 |\n| nan    | nan |\n| nan    | 2.5 |"
    assert got == f"## Sheet: Prices\n\n{table}\n\n## Sheet: Empty\n\n\n"
    assert pipe_table([]) == "" and pipe_table([["a"]]) == "| a   |\n|:----|"
    assert pipe_table([[None, "b"], [True, "x"]]).startswith("| Unnamed: 0   | b   |")


def test_convert_with_sheets_and_own_converters(spark):
    files = [("f/a.xlsx", workbook({"S": PRICES}, ["name", "n"])), ("f/b.pdf", b"pages"), ("f/c.pdf", b"bad"), ("f/d.xlsx", b"no zip")]

    def pdf(data):
        if data == b"bad":
            raise ValueError("unreadable")
        return "# " + data.decode()

    df = spark.createDataFrame([(p, bytearray(b)) for p, b in files], "path string, content binary")
    got = {r.path: r for r in convert(df, {".pdf": pdf}).collect()}
    assert got["f/a.xlsx"].markdown.startswith("## Sheet: S\n") and got["f/b.pdf"].markdown == "# pages"
    assert got["f/c.pdf"].error == "ValueError: unreadable" and "BadZipFile" in got["f/d.xlsx"].error
    assert "no converter" in {r.path: r for r in convert(df).collect()}["f/b.pdf"].error
