import zipfile

import pytest

from clipforge.functions import constants as C
from clipforge.operators.blocklists import read_list
from clipforge.sources.persons_export import read_persons_export, resolve_layout
from clipforge.sources.settings import Settings, parse_settings, read_settings
from clipforge.sources.sheets import read_sheet

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(path, sheets, shared=None):
    """A workbook of sheets given as the XML of their rows."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><sheets>' + "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        if shared is not None:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
    return str(path)


def text_rows(*rows):
    cell = lambda v: "<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{v}</t></is></c>'
    return "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows)


def test_cells(spark, tmp_path):
    shared = '<si><t>Name</t></si><si><r><t>Zoë </t></r><r><t>&amp; co</t></r><rPh sb="0" eb="1"><t>guide</t></rPh></si>'
    rows = ('<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>0</v></c></row>'
            '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3"><v>1.5</v></c><c r="AB3" t="b"><v>1</v></c></row>'
            '<row r="4"><c r="A4" s="1"/></row><row r="5"><c r="B5" t="e"><v>#N/A</v></c><c r="C5" t="str"><f>A1</f><v>x</v></c></row>')
    df = read_sheet(spark, workbook(tmp_path / "a.xlsx", {"one": rows, "none": ""}, shared))
    assert df.columns == ["Name", "_c1", "Name.1", "row_pos"]
    assert [tuple(r) for r in df.orderBy("row_pos").collect()] == [("Zoë & co", "1.5", None, 1), (None, None, "x", 2)]
    assert read_sheet(spark, str(tmp_path / "a.xlsx"), "none").columns == ["row_pos"]
    with pytest.raises(Exception, match="no sheet 'two'"):
        read_sheet(spark, str(tmp_path / "a.xlsx"), "two")


def test_block_lists_and_long_sheets(spark, tmp_path):
    many = text_rows(["Word"], *[[f" w{i % 6000} "] for i in range(12000)], [None], ["  "])
    path = workbook(tmp_path / "lists.xlsx", {"Media name": text_rows(["Source", "n"], ["fd.nl ", "1"], ["fd.nl", "2"]), "Media title": many})
    assert [r.source for r in read_list(spark, path, out_col="source", sheet="Media name").collect()] == ["fd.nl"]
    assert {r.word for r in read_list(spark, path, "Word", sheet="Media title").collect()} == {f"w{i}" for i in range(6000)}
    assert read_list(spark, str(tmp_path / "no.xlsx"), sheet="Media name").count() == 0


def test_persons_export(spark, tmp_path):
    unit, name = C.UNIT_COLUMN_CANDIDATES[0], C.NAME_COLUMN_CANDIDATES[0]
    path = workbook(tmp_path / "p.xlsx", {"Persons": text_rows([unit.replace(">", "&gt;"), name.replace(">", "&gt;")], ["U1", " Ann "], [None, "Bob"])})
    assert [tuple(r) for r in resolve_layout(read_persons_export(spark, path)).orderBy("row_pos").collect()] == [("U1", "Ann", 1), (None, "Bob", 2)]


def test_settings(spark, tmp_path):
    text = ("[DEFAULTS]\nALLOWED_LANGUAGES = en, nl,,\n[FILTERS]\nUNWANTED_TERMS = \\bUtrecht\\b, x\nBLACKLIST_NAMES = A B\n[NAME]\nDUTCH = de u\n"
            "[SOURCE_MAP]\nFD.nl = https://fd.nl\n[WORKFLOW STATUS]\ngeo = forApproval\n[AI]\nAI = no\n")
    (tmp_path / "c.cfg").write_text(text)
    s = read_settings(spark, str(tmp_path / "c.cfg"))
    assert s == parse_settings(text)
    assert (s.languages, s.faculties, s.patterns, s.blacklist, s.name_nl) == (["en", "nl"], [], [r"\bUtrecht\b", "x"], ["A B"], "de u")
    assert (s.source_urls, s.workflow, s.use_model) == ({"fd.nl": "https://fd.nl"}, {"GEO": "forApproval"}, False)
    assert read_settings(spark, str(tmp_path / "none.cfg")) == Settings() and Settings().languages == C.ALLOWED_LANGUAGES
