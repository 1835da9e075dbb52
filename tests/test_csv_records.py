"""Records of CSV files cut by many tasks, against a reader that goes through them in order."""

import csv
import io
import random

import pytest

from clinflat.sources import csv_records


def _cells(spark, path, width):
    records = csv_records.read_records(spark, str(path))
    rows = csv_records.cells(records, ["x"] * width, "raw").collect()
    return sorted(tuple(c or "" for c in r[:width]) for r in rows)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_against_a_reader_in_order(spark, tmp_path, small_splits, end):
    dice = random.Random(3)
    bits = ["a", "ä,", 'said ""', "\n", "\n\n", ",\n", '"",""', "", " x ", '""\n']
    rows = [["".join(dice.choice(bits) for _ in range(dice.randint(0, 9))).replace('""', '"') for _ in range(4)]
            for _ in range(400)]
    rows[7][2] = "long\n" * 700  # a record over many splits
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["A", "B \n,b", "C", "D"])
    writer.writerows(rows)
    (tmp_path / "d.csv").write_bytes(("\ufeff" + out.getvalue()).encode())
    lines = csv_records.lines(spark, str(tmp_path / "d.csv"))
    assert lines.select("block").distinct().count() > 20
    assert _cells(spark, tmp_path / "d.csv", 4) == sorted(tuple(r) for r in rows)
    records = csv_records.read_records(spark, str(tmp_path / "d.csv"))
    assert csv_records.header(records) == ["A", "B \n,b", "C", "D"]


def test_quotes_inside_cells_are_text(spark, tmp_path, small_splits):
    """Only a quote at the start of a cell opens; elsewhere lines stay apart."""
    body = "A,B\n" + "".join(f'5" pipe {i},b"c\n"q"x,"y\nz"\n' for i in range(60))
    (tmp_path / "d.csv").write_text(body)
    got = csv_records.read_records(spark, str(tmp_path / "d.csv")).where("not first")
    expected = [f'5" pipe {i},b"c' for i in range(60)] + ['"q"x,"y\nz"'] * 60
    assert sorted(r["record"] for r in got.collect()) == sorted(expected)


def test_several_files_and_empty_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n\nA,B\n1,"x\n\ny"\n\n2,z')
    (tmp_path / "b.csv").write_text('A,B\n3,\n')
    (tmp_path / "c.csv").write_text('')
    assert _cells(spark, tmp_path, 2) == [("1", "x\n\ny"), ("2", "z"), ("3", "")]


def test_open_quote_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="a.csv ends inside quotes"):
        csv_records.read_records(spark, str(tmp_path))
