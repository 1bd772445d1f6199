"""Files without a profile and dates only their file decides, on small odd files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from corvid.operators.dates import resolve_dates
from corvid.sources.dialects import infer_dialects, read_any_bank_csv, read_lines, split_cells


def write(tmp_path, name, lines, encoding="utf-8", end="\n"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join(lines).encode(encoding))


def dialect(spark, tmp_path):
    return {r.file.rsplit("/", 1)[1]: r for r in infer_dialects(read_lines(spark, str(tmp_path))).collect()}


def test_split_cells(spark):
    lines = ['a,b,c', '"a,b",c', 'x,"he said ""no, no""",y', ',,', '"",z', 'plain', 'a;b,c']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(split_cells(F.col("line"), F.lit(","))).collect()]
    assert got == [["a", "b", "c"], ["a,b", "c"], ["x", 'he said "no, no"', "y"], ["", "", ""], ["", "z"], ["plain"], ["a;b", "c"]]


def test_layouts_nobody_described(spark, tmp_path):
    write(tmp_path, "pipe-2023.csv", ["When|What|How much", "13/01/2023|Café, à côté|-1,234.50", "02/02/2023|Rent|-900.00",
                                      "15/02/2023||12.00"], encoding="latin-1")
    write(tmp_path, "tab-2022.csv", ["-10,00\t12/31/2022\tA\t7", "5,25\t12/30/2022\tB\t8"], end="\r\n")
    write(tmp_path, "one-2021.csv", ["2021-05-06;Shop;3;-4,00"])
    write(tmp_path, "prose.csv", ["no bank here", "at all, or so"])
    write(tmp_path, "quoted-2020.csv", ["﻿id,date,amount,text", '1,2020-01-02,"-1,000.00","x, y"', '2,2020-01-03,5.00,z', "3,2020-01-04"])
    d = dialect(spark, tmp_path)
    assert sorted(d) == ["one-2021.csv", "pipe-2023.csv", "quoted-2020.csv", "tab-2022.csv"]
    assert (d["pipe-2023.csv"].sep, d["pipe-2023.csv"].encoding, d["pipe-2023.csv"].day_first) == ("|", "ISO-8859-1", True)
    assert d["pipe-2023.csv"].header is not None and d["pipe-2023.csv"].pos_id is None
    assert (d["tab-2022.csv"].sep, d["tab-2022.csv"].header, d["tab-2022.csv"].day_first) == ("\t", None, False)
    assert d["one-2021.csv"].sep == ";" and d["one-2021.csv"].header is None
    got = {(r.file.rsplit("/", 1)[1], r.date, r.amount, r.description_raw, r.row_id, r.corrupt)
           for r in read_any_bank_csv(spark, str(tmp_path)).collect()}
    assert got == {
        ("pipe-2023.csv", "2023-01-13", -1234.5, "Café, à côté", None, None), ("pipe-2023.csv", "2023-02-02", -900.0, "Rent", None, None),
        ("pipe-2023.csv", "2023-02-15", 12.0, None, None, None),
        ("tab-2022.csv", "2022-12-31", -10.0, "A", 7, None), ("tab-2022.csv", "2022-12-30", 5.25, "B", 8, None),
        ("one-2021.csv", "2021-05-06", -4.0, "Shop", 3, None),
        ("prose.csv", None, None, None, None, "no bank here"), ("prose.csv", None, None, None, None, "at all, or so"),
        ("quoted-2020.csv", "2020-01-02", -1000.0, "x, y", 1, None), ("quoted-2020.csv", "2020-01-03", 5.0, "z", 2, None),
        ("quoted-2020.csv", None, None, None, None, "3,2020-01-04")}


def test_an_empty_folder_has_no_rows(spark, tmp_path):
    write(tmp_path, "blank.csv", ["", "   "])
    assert read_any_bank_csv(spark, str(tmp_path)).count() == 0


FORM = {"dm": "{d:02d}/{m:02d}", "md": "{m}/{d}", "dmy": "{d}/{m}/{y}", "mdy": "{m:02d}/{d:02d}/{y}"}


@pytest.mark.parametrize("form", sorted(FORM))
@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("only_small", [False, True])
def test_sorted_statements(spark, form, newest_first, only_small):
    """Any form, either direction, over three years, in several blocks, with gaps and repeats."""
    rng = random.Random(hash((form, newest_first, only_small)) % 1000)
    days = [dt.date(2019, 1, 1) + dt.timedelta(i) for i in range(0, 1000, 3)]
    days = sorted(rng.choices([d for d in days if d.day <= 12] if only_small else days, k=400), reverse=newest_first)
    rows = []
    for i, d in enumerate(days):
        text = FORM[form].format(d=d.day, m=d.month, y=d.year) if i % 17 else [None, "x", "99/99"][i % 3]
        rows.append(("f", i // 90, i, text, str(d) if i % 17 else None, None if only_small else form.startswith("d"),
                     max(days).year))
    df = spark.createDataFrame(rows, "file string, block long, place long, date_raw string, want string, day_first boolean, year int")
    got = resolve_dates(df.repartition(5)).collect()
    assert len(got) == 400 and [r for r in got if r.date != r.want] == []


def test_unsorted_statements_take_the_files_year(spark):
    rng = random.Random(3)
    rows = [("f", 0, i, f"{rng.randrange(13, 29)}/{rng.randrange(1, 13):02d}", True, 2020) for i in range(60)]
    df = spark.createDataFrame(rows, "file string, block long, place long, date_raw string, day_first boolean, year int")
    assert {r.date[:4] for r in resolve_dates(df).collect()} == {"2020"}


def test_files_without_any_date(spark):
    df = spark.createDataFrame([("f", 0, 1, None, None, 2020), ("g", 0, 1, "n/a", None, None), ("h", 0, 1, "03/04", None, 2021)],
                               "file string, block long, place long, date_raw string, day_first boolean, year int")
    assert {(r.file, r.date) for r in resolve_dates(df).collect()} == {("f", None), ("g", None), ("h", "2021-04-03")}
