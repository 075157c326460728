import csv as plain_csv

import pytest
from pyspark.sql import types as T

from saldo.operators.clean import POSITION
from saldo.schema import HEADERS
from saldo.sources import csv
from tests.test_clean import FULL


def write(path, rows, encoding="utf-8", header=None, **form):
    header = header or list(HEADERS)
    with open(path, "w", encoding=encoding, newline="") as f:
        out = plain_csv.DictWriter(f, header, extrasaction="ignore", **form)
        out.writeheader()
        out.writerows({**FULL, **r} for r in rows)
    return str(path)


def values(df, header):
    return [r[0] for r in df.orderBy(*POSITION).select(f"`{header}`").collect()]


@pytest.mark.parametrize("encoding, expected", [
    ("utf-8", "utf-8"), ("utf-8-sig", "utf-8"), ("cp1252", "windows-1252"),
])
def test_encodings(spark, tmp_path, encoding, expected):
    path = write(tmp_path / "a.csv", [{"Customer": "São “Ω”".replace("Ω", "€"), "City": "Nº"}], encoding)
    assert csv.detect_form(spark, path) == csv.TextForm(expected, False)
    df = csv.read_raw_csv(spark, path)
    assert values(df, "Customer") == ["São “€”"] and values(df, "City") == ["Nº"]
    assert values(df, "Row ID") == ["1"]


def test_bytes_without_a_meaning_in_1252_make_it_latin(spark, tmp_path):
    path = write(tmp_path / "a.csv", [{"Customer": "ã\x81x"}], "latin-1")
    assert csv.detect_form(spark, path).encoding == "iso-8859-1"
    assert values(csv.read_raw_csv(spark, path), "Customer") == ["ã\x81x"]


def test_1252_table_equals_the_codec(spark, tmp_path):
    meant = [b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    text = bytes(meant).decode("cp1252")
    path = write(tmp_path / "a.csv", [{"Customer": f"x{text}x"}], "cp1252")
    assert values(csv.read_raw_csv(spark, path), "Customer") == [f"x{text}x"]


def test_missing_texts(spark, tmp_path):
    texts = ["", "NA", "null", "NaN", "None", "n/a", "#N/A", "<NA>", "none", " NA", "N/A."]
    path = write(tmp_path / "a.csv", [{"Sales": t, "Product": t} for t in texts])
    df = csv.read_raw_csv(spark, path)
    expected = [None] * 8 + ["none", " NA", "N/A."]
    assert values(df, "Sales") == expected and values(df, "Product") == expected


def test_quotes_and_blanks_are_kept(spark, tmp_path):
    texts = ['say "hi", you', " blanks ", "back\\slash", 'a\\"b', "tab\t"]
    path = write(tmp_path / "a.csv", [{"Customer": t} for t in texts])
    assert values(csv.read_raw_csv(spark, path), "Customer") == texts


def test_values_over_two_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", [{"Customer": "one\ntwo"}, {"Customer": "three"}])
    assert csv.detect_form(spark, path).multi_line
    assert values(csv.read_raw_csv(spark, path), "Customer") == ["one\ntwo", "three"]


def test_columns_go_by_header_and_others_pass(spark, tmp_path):
    header = ["Note", *reversed(HEADERS)]
    path = write(tmp_path / "a.csv", [{"Note": "n"}], header=header)
    df = csv.read_raw_csv(spark, path)
    assert df.columns == header + list(POSITION)
    assert values(df, "Sales") == ["261.96"] and values(df, "Note") == ["n"]


def test_missing_header_is_found_before_any_row_is_read(spark, tmp_path):
    path = write(tmp_path / "a.csv", [], header=[h for h in HEADERS if h != "Profit"])
    with pytest.raises(ValueError, match="Profit"):
        csv.read_raw_csv(spark, path)


def test_missing_file(spark, tmp_path):
    for read in (csv.read_raw_csv, csv.read_clean_csv):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "absent.csv"))


def test_position_is_the_order_of_the_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", [{"Row ID": str(i)} for i in range(5)])
    # The larger file is read first, but comes second.
    write(tmp_path / "in" / "b.csv", [{"Row ID": str(i)} for i in range(5, 500)])
    df = csv.read_raw_csv(spark, str(tmp_path / "in"))
    assert values(df, "Row ID") == [str(i) for i in range(500)]


def test_each_file_is_read_by_its_own_form(spark, tmp_path):
    folder = tmp_path / "in +x %20"
    folder.mkdir()
    write(folder / "a.csv", [{"Customer": "São"}])
    write(folder / "b c.csv", [{"Customer": "Zoë “x”"}], "cp1252")
    write(folder / "d.csv", [{"Customer": "one\ntwo é"}])
    df = csv.read_raw_csv(spark, str(tmp_path / "in*"))
    assert sorted(values(df, "Customer")) == sorted(["São", "Zoë “x”", "one\ntwo é"])


@pytest.mark.parametrize("end", [",more", ",", ',"a,b"'])
def test_rows_of_more_fields_than_the_header_are_refused(spark, tmp_path, end):
    path = write(tmp_path / "a.csv", [{"Customer": 'a, "b"'}])
    lines = (tmp_path / "a.csv").read_text().splitlines()
    short = ",".join(lines[1].split(",")[:2])
    (tmp_path / "a.csv").write_text("\n".join([*lines, short]) + "\n")
    assert csv.read_raw_csv(spark, path).count() == 2
    (tmp_path / "a.csv").write_text("\n".join([*lines, lines[1] + end]) + "\n")
    for df in (csv.read_raw_csv(spark, path), csv.read_raw_csv(spark, path).select("Sales")):
        with pytest.raises(Exception, match="more than [0-9]+ fields"):
            df.collect()


@pytest.mark.parametrize("value", ['"' + "a, b " * 200_000 + '"', '"' + 'say ""x"", ' * 100_000 + '"', '"' + '""' * 500_000 + '"'])
def test_long_quoted_values_in_short_and_long_rows(spark, tmp_path, value):
    path = write(tmp_path / "a.csv", [{}])
    lines = (tmp_path / "a.csv").read_text().splitlines()
    (tmp_path / "a.csv").write_text("\n".join([*lines, f"5,{value}"]) + "\n")
    df = csv.read_raw_csv(spark, path)
    assert values(df, "Row ID") == ["1", "5"] and values(df, "Order ID")[1] == value[1:-1].replace('""', '"')
    (tmp_path / "a.csv").write_text("\n".join([*lines, lines[1] + "," + value]) + "\n")
    with pytest.raises(Exception, match="more than [0-9]+ fields"):
        csv.read_raw_csv(spark, path).collect()


def test_type_check(spark):
    df = spark.createDataFrame([("x",)], "order_date string")
    with pytest.raises(TypeError, match="order_date should be date, is string"):
        csv.require_type(df, "order_date", T.DateType())


def test_packed_files_are_small_and_read_alike(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "ROWS_PER_FILE", 40)
    raw = csv.read_raw_csv(spark, write(tmp_path / "a.csv", [{"Row ID": str(i), "City": 'São "x", ' + str(i)} for i in range(100)]))
    raw = raw.drop(*POSITION).coalesce(1)
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    csv.write_csv(raw, str(plain))
    csv.write_csv(raw, str(packed), packed=True)
    size = lambda folder: sum(f.stat().st_size for f in folder.glob("part-*"))
    assert [len(list(packed.glob("*.csv.gz"))), size(packed) < size(plain) / 3] == [3, True]
    read = [sorted(csv.read_raw_csv(spark, str(p)).drop(*POSITION).collect()) for p in (plain, packed)]
    assert read[0] == read[1] and len(read[1]) == 100
