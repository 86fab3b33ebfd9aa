"""CSV in splits against the reader of whole files, and workbooks made here."""

import random
import zipfile

import pytest

from txnlake.sources import files, quoted, workbook


def listed(df):
    return sorted(tuple("" if x is None else x for x in r) for r in df.collect())


def field(rnd):
    kind = rnd.randrange(8)
    plain = "".join(rnd.choice("ab é-5'") for _ in range(rnd.randrange(1, 6))).strip() or "x"
    if kind == 0:
        return '"' + plain + "\n" * rnd.randrange(1, 4) + 'x, ""q""' + '"'
    if kind == 1:
        return f'"{plain}\r\n,""\n"'
    if kind == 2:
        return f'{plain}"inch'  # a quote that begins no field
    return f'"{plain}"' if kind == 3 else plain


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [40, 333, 1 << 20])
def test_splits_equal_the_whole_file(spark, tmp_path, split, end):
    rnd = random.Random(split)
    text = f'﻿a,"b ""x""",c{end}' + "".join(",".join(field(rnd) for _ in range(3)) + end * rnd.choice([1, 1, 1, 2]) for _ in range(150))
    (tmp_path / "x.csv").write_bytes(text.encode())
    got = quoted.scan(spark, str(tmp_path / "x.csv"), split_bytes=split)
    want = files.csv(spark, str(tmp_path / "x.csv"))
    assert [c.lstrip("﻿") for c in want.columns] == got.columns and listed(got) == listed(want)
    if split == 40:
        assert quoted.records(spark, str(tmp_path / "x.csv"), split_bytes=split).select("start").distinct().count() > 20


def test_files_of_a_folder_and_hostile_ones(spark, tmp_path):
    for n, rows in enumerate(['1,"x\ny"\n2,z', '3,"open\nnever closed\n4,w\n', "", "5,\n\n\n"]):
        (tmp_path / f"{n}.csv").write_text("k,v\n" + rows)
    got = listed(quoted.scan(spark, str(tmp_path), split_bytes=5))
    assert got == [("1", "x\ny"), ("2", "z"), ("3", '"open\nnever closed\n4,w'), ("5", "")] or got[0:2] + got[3:] == [("1", "x\ny"), ("2", "z"), ("5", "")]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.csv").write_text("")
    assert quoted.scan(spark, str(tmp_path / "e")).count() == 0


def test_large_files_are_read_in_splits(spark, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text('k,v\n1,"a\nb"\n')
    monkeypatch.setattr(files, "PARALLEL_ABOVE", 3)
    calls = []
    monkeypatch.setattr(quoted, "scan", lambda *a: calls.append(a) or "split")
    assert files.scan(spark, str(tmp_path / "x.csv")) == "split" and len(calls) == 1


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def make(path, rows, strings=(), since_1904=False):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN}><workbookPr date1904="{int(since_1904)}"/><sheets><sheet name="A" sheetId="7" r:id="rId3"/><sheet name="B" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/other.xml"/><Relationship Id="rId3" Target="/xl/worksheets/first.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="dd\\.mm\\.yyyy"/><numFmt numFmtId="165" formatCode="0.00&quot; days&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(strings) + "</sst>")
        z.writestr("xl/worksheets/first.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/worksheets/other.xml", f"<worksheet {MAIN}><sheetData><row><c><v>9</v></c></row></sheetData></worksheet>")


HEAD = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>amount</t></is></c></row>'
STRINGS = ["<si><t>date</t></si>", "<si><r><t>no</t></r><r><t>te</t></r><rPh><t>zz</t></rPh></si>", '<si><t xml:space="preserve"> a &amp; b </t></si>', "<si><t/></si>"]


def test_workbook(spark, tmp_path):
    rows = HEAD
    rows += '<row r="2"><c r="A2" s="1"><v>45356</v></c><c r="B2" t="s"><v>2</v></c><c r="C2" t="b"><v>1</v></c><c r="D2"><v>12.5</v></c></row>'
    rows += '<row r="3"><c r="A3" s="2"><v>45356.5</v></c><c r="C3" t="e"><v>#N/A</v></c><c r="D3" s="3"><v>3</v></c></row><row r="4"/><row r="5"><c r="B5" t="s"><v>3</v></c></row>'
    rows += '<row r="9"><c r="A9" s="1"><v>1</v></c><c r="B9" t="str"><f>x</f><v>made</v></c><c r="D9"><v>1E-3</v></c></row>'
    make(tmp_path / "x.xlsx", rows, STRINGS)
    got = files.scan(spark, str(tmp_path / "x.xlsx"))
    assert got.columns == ["date", "note", "_c2", "amount"]
    assert [tuple(r) for r in got.collect()] == [("2024-03-05", " a & b ", "True", "12.5"), ("2024-03-05 12:00:00", None, None, "3"), ("1900-01-01", "made", None, "0.001")]
    make(tmp_path / "y.xlsx", HEAD + '<row r="2"><c r="A2" s="1"><v>43894</v></c></row>', STRINGS, since_1904=True)
    assert files.scan(spark, str(tmp_path / "y.xlsx")).first().date == "2024-03-05"
    make(tmp_path / "z.xlsx", "")
    assert files.scan(spark, str(tmp_path / "z.xlsx")).count() == 0


def test_folder_of_long_workbooks(spark, tmp_path):
    for n in range(3):
        body = "".join(f'<row r="{i}"><c r="A{i}"><v>{n * 10_000 + i}</v></c><c r="AB{i}"><v>{i}</v></c></row>' for i in range(2, 5002))
        make(tmp_path / f"{n}.xlsx", '<row r="1"><c r="A1" t="inlineStr"><is><t>id</t></is></c></row>' + body)
    got = workbook.scan(spark, str(tmp_path))
    assert got.columns == ["id"] and got.count() == 15_000 == got.distinct().count()
