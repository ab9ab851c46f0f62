"""Workbooks and zipped reports: what is written reads back, odd cells, files without sequences."""

import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyseq.__main__ import _write_table
from tallyseq.sinks import workbooks as sinks
from tallyseq.sources import inputs
from tallyseq.sources.workbooks import read_order, read_workbook


def test_round_trip(spark, tmp_path):
    rows = [("pool1", " acgt\n", 3), ("pool1", "ACGX", 1), (None, "NNA", 2), ("p<&>\x01", None, 5), ("pool2", "", 4), ("pool2", "A A", None)]
    table = spark.createDataFrame(rows, "`Pool name` string, `Sequence` string, place int").repartition(3)
    path = str(tmp_path / "order.xlsx")
    sinks.write_workbook(table, path, F.col("place").asc_nulls_last())
    cells = [[c and (c.text, c.value) for c in r.cells] for r in read_workbook(spark, [path], 3).orderBy("row").collect()]
    t = lambda v: None if v is None else (True, v)
    ordered = sorted(rows, key=lambda r: (r[2] is None, r[2]))
    assert cells == [[t("Pool name"), t("Sequence"), t("place")]] + [[t(a and a.replace("\x01", "")), t(b), n and (False, str(n))] for a, b, n in ordered]
    assert [(r.row, r.pool, r.sequence) for r in read_order(spark, [path]).orderBy("row").collect()] == [(2, None, "NNA"), (3, "pool1", "ACGT")]
    assert read_order(spark, [path], robust=False).count() == 6
    assert [p.name for p in tmp_path.iterdir()] == ["order.xlsx"]
    _write_table(table.select(F.col("place").alias("b"), F.col("Sequence").alias("a")).limit(0), str(tmp_path / "none.xlsx"), "a")
    with pytest.raises(PySparkException, match="no sequences"):
        read_order(spark, [path, str(tmp_path / "none.xlsx")]).collect()


def test_shared_texts_sparse_rows_and_numbers(spark, tmp_path):
    """A book as office programs write it: shared texts, some in runs, holes, cells with places, a second sheet."""
    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = '<row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="4"><c r="B4" t="s"><v>1</v></c><c r="AA4"><v>9</v></c></row><row r="6"><c r="A6"><v>7</v></c><c r="B6"><v>12.5</v></c></row><row r="7"><c r="A7" t="s"><v>0</v></c><c r="B7" t="str"><f>X()</f><v>GG</v></c></row>'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="x" sheetId="4" r:id="k9"/><sheet name="y" sheetId="1" r:id="k1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R xmlns="p"><Relationship Id="k1" Target="worksheets/sheet1.xml"/><Relationship Id="k9" Target="/xl/worksheets/other.xml"/></R>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>head</t></si><si><r><t>AC</t></r><r><t>GT</t></r></si></sst>')
        z.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')
    assert [(r.row, r.pool, r.sequence) for r in read_order(spark, [str(tmp_path / "b.xlsx")]).orderBy("row").collect()] == [(3, None, "ACGT"), (6, "head", "GG")]


def test_too_many_rows_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="fit a sheet"):
        sinks.write_workbook(spark.range(sinks.MOST_ROWS + 1), str(tmp_path / "x.xlsx"))
    assert not [*tmp_path.iterdir()]


def test_zipped_reports_equal_unpacked_ones(spark, tmp_path):
    text = "##x\n>>Per sequence quality scores\tpass\n#Quality\tCount\n29\t5.0\n30\t15.0\n>>END_MODULE\n"
    folder = tmp_path / "s1_S1_R1_001_fastqc"
    folder.mkdir()
    (folder / "fastqc_data.txt").write_text(text)
    with zipfile.ZipFile(tmp_path / "s1_S1_R1_001_fastqc.zip", "w") as z:
        z.writestr("s1_S1_R1_001_fastqc/summary.txt", "x")
        z.writestr("s1_S1_R1_001_fastqc/fastqc_data.txt", text)
    plain = sorted(map(tuple, inputs.read_quality_reports(spark, [str(folder / "fastqc_data.txt")]).collect()))
    packed = sorted(map(tuple, inputs.read_quality_reports(spark, [str(tmp_path / "s1_S1_R1_001_fastqc.zip")]).collect()))
    both = inputs.read_quality_reports(spark, [str(tmp_path / "s1_S1_R1_001_fastqc.zip"), str(folder / "fastqc_data.txt")])
    assert packed == plain and len(plain) == 2 and both.count() == 4
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(PySparkException, match="no report"):
        inputs.read_quality_reports(spark, [str(tmp_path / "none.zip")]).collect()
