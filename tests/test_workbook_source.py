"""The workbook data source: sheets as partitions, bounded memory."""

import os
import tracemalloc
import zipfile

from pyspark.sql import functions as F

from fraudmart.plans.workbook_files import write_workbook
from fraudmart.sources import workbook


def test_partitions_are_sheets_of_all_files(spark, tmp_root):
    for k in range(3):
        write_workbook(os.path.join(tmp_root, f"terminals_0{k + 1}032021.xlsx"),
                       {f"s{i}": [["b", "a"]] + [[f"{k}{i}{n}", n] for n in range(5000)] + [[None, None]] for i in range(2)})
    every = workbook.read_workbook(spark, tmp_root, ["a", "b", "missing"], sheets="all")
    assert every.rdd.getNumPartitions() == 6
    got = every.groupBy("file_name", "sheet").agg(F.count("*").alias("n"), F.sum("a").alias("s"), F.count("missing").alias("m"))
    assert {tuple(r)[2:] for r in got.collect()} == {(5000, 5000 * 4999 / 2, 0)} and got.count() == 6
    last = workbook.read_workbook(spark, tmp_root, ["a"], sheets="last")
    assert [r[0] for r in last.select("sheet").distinct().collect()] == ["s1"]
    write_workbook(os.path.join(tmp_root, "empty_01032021.xlsx"), {"none": []})
    assert workbook.read_workbook(spark, tmp_root + "/empty*", ["a"]).count() == 0


def test_a_long_sheet_is_read_in_bounded_memory(tmp_path):
    """Twenty times the rows, the same peak (a million rows would take no more)."""
    def peak(rows):
        path = str(tmp_path / f"b{rows}.xlsx")
        row = '<row><c t="inlineStr"><is><t>some text of a cell</t></is></c><c><v>1</v></c></row>'
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{workbook.NS["m"]}"><sheets><sheet name="s" sheetId="1"/></sheets></workbook>')
            with z.open("xl/worksheets/sheet1.xml", "w") as f:
                f.write(f'<worksheet xmlns="{workbook.NS["m"]}"><sheetData>'.encode() + (row * rows).encode() + b"</sheetData></worksheet>")
        reader = workbook.WorkbookReader([path], ["some text of a cell"], "all")
        part, = reader.partitions()
        tracemalloc.start()
        n = sum(b.num_rows for b in reader.read(part))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == rows - 1
        return most

    assert peak(100_000) < 1.2 * peak(10_000) + 1_000_000
