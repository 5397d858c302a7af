"""CSV extracts, with pandas' default reader as the oracle."""

import csv
import io
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordermill.sources import csv_extract, quoted_lines
from ordermill.sources.csv_extract import MalformedExtract
from ordermill.sources.staging import require_rows, typed_extract

TYPES = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}


@pytest.fixture
def monkeypatch_conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(key, value):
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


def write(folder, content, name="x.csv"):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def table_type(column):
    """The type of the database column that pandas would make of this one."""
    kind = pd.api.types.infer_dtype(column, skipna=True)
    return "boolean" if kind == "boolean" else TYPES[str(column.dtype)]


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return value


def check_like_pandas(spark, path, content):
    expected = pd.read_csv(io.BytesIO(content if isinstance(content, bytes) else content.encode()))
    got = typed_extract(spark, path)
    assert got.table.columns == list(expected.columns)
    assert [t for _, t in got.table.dtypes] == [table_type(c) for _, c in expected.items()]
    rows = [tuple(r) for r in got.table.collect()]
    wanted = [tuple(plain(v) for v in r)
              for r in expected.astype(object).itertuples(index=False, name=None)]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
    assert (got.rows, got.columns) == expected.shape
    return got


SAME_AS_PANDAS = {
    "bom_crlf": "﻿name,label\r\na,x\r\nb,y",
    "quotes": 'a,b\n1,"say ""hi"", ok"\n2,"x,y"\n3,""\n',
    "line_breaks": 'a,b\n1,"two\nlines"\n2,plain\n3,"three\n\nlines, ""q"""\n',
    "line_breaks_crlf": 'a,b\r\n1,"two\r\nlines"\r\n2,plain\r\n',
    "line_break_in_header": '"a\nb",c\n1,2\n3,"x\ny"\n',
    "bare_cr_in_quotes": 'a,b\n1,"two\rlines"\n2,plain\n',
    "missing": "a,b\nx,NULL\nnan,N/A\nNone,NA\n,#N/A\nnull,y\n",
    "long": "a\n1\n-2\n+3\n",
    "long_with_missing": "a,b\n1,1\n,2\n",
    "all_missing": "a,b\n1,\n2,NA\n",
    "booleans": "a,b\nTrue,x\nfalse,y\nTRUE,z\n",
    "booleans_with_missing": "a,b\nTrue,x\n,y\nTrue,z\n",
    "booleans_and_numbers": "a,b\nTrue,x\n1,y\n",
    "leading_zero": "a\n01234\n00001\n",
    "id_like": "a,b,c,d\n1d,123D,t,yes\n2f,4F,f,no\n",
    "wide_integer": "a,b\n12345678901234567890123,x\n1,y\n",
    "decimals": "a,b,c,d,e\n.5,5.,1e3,inf,1\n1.25,2,-1E-2,-inf,2.5\n",
    "blanks_around_numbers": "a,b\n 12 ,1.5 \n3, 2\n",
    "tabs_around_numbers": "a,b\n\t12,1.5\t\n3\t,\t2\n",
    "edges_of_64_bits": "a\n9223372036854775807\n-9223372036854775808\n",
    "just_wide": "a\n-9223372036854775809\n1\n",
    "huge_integers_and_decimals": "a,b\n123456789012345678901,x\n1.5,y\n",
    "unsigned_integers_and_decimals": "a,b\n18446744073709551615,x\n1.5,y\n",
    "huge_integers_and_missing": "a,b\n123456789012345678901,x\n,y\n",
    "overflowing_decimals": "a,b\n1e400,1e-400\n-1e400,2\n",
    "not_numbers": "a,b\n0x1A,1_000\n0x2B,2_000\n",
    "timestamps": "a,b\n2017-10-02 10:56:33,2017-10-02\n2018-01-01 00:00:00,2018-01-01\n",
    "short_and_blank": "a,b,c\n1,2\n\n3,4,5\n   \n6,7,8\n",
    "double_header": "a,a,b,a\n1,2,3,4\n",
    "unnamed_header": "a,,c\n1,2,3\n",
    "stray_quotes": 'a,b\n5" pipe,x\n6" pipe,"y\nz"\n7,8\n',
    "stray_pair": 'a,b\n5" by 6" pipe,x\n"p\nq",z\n',
    "stray_quotes_on_one_line": 'a,b\n5" pipe,x\n6" by 7" pipe,"y,z"\n7,8"\n',
    "only_quotes": 'a,b\n"""",""\n"""x""",1\n',
    "blank_before_header": "\n  \na,b\n1,2\n3,x\n",
    "blank_before_header_quoted": '\n\na,b\n1,"2\n3"\n',
    "tabs_on_a_line": 'a,b\n\t\n1,"x\ny"\n \t \n2,z\n',
    "tabs_on_a_plain_line": "\t\na,b\n\t\n1,x\n \t \n2,z\n",
    "returns_in_quotes": 'a,b\n1,"x\r\ny"\n2,"p\rq\nr"\n',
    "separators_in_quotes": 'a,b\n",,,",1\n"x,",",,"\n",""",","\n',
    "one_column": 'a\n"x,y"\nz\n',
    "blanks_kept": "a,b\n x , y\nz , w \n",
    "backslash": 'a,b\n"x\\",y\n\\N,z\n',
    "no_rows_but_quotes": 'a\n"x"\n',
}


# Cases with quotes or blank lines are read in splits smaller than a record as well.
@pytest.mark.parametrize("case, split_bytes", [
    (case, size) for case, text in SAME_AS_PANDAS.items() for size in ("134217728", "13")
    if size != "13" or '"' in text or "blank" in case])
def test_same_as_pandas(spark, tmp_path, monkeypatch_conf, case, split_bytes):
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", split_bytes)
    monkeypatch_conf("spark.sql.files.openCostInBytes", split_bytes)
    content = SAME_AS_PANDAS[case]
    check_like_pandas(spark, write(tmp_path, content), content)


@pytest.mark.parametrize("content", ["a,b\n", "", "\n", "a,b"])
def test_empty_is_refused(spark, tmp_path, content):
    with pytest.raises(MalformedExtract, match="empty or malformed"):
        typed_extract(spark, write(tmp_path, content))


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        typed_extract(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("content", ["a,b\n1,2\n3,4,5\n", "a,b\n1,2,3\n4,5,6\n",
                                     'a,b\n1,"x\ny",3\n', "a,b\n1,2\n3,4,\n", "a,b\n1,2,\n",
                                     'a,b\n"1,2","x,y",\n', 'a,b\n1,"x\ny",\n2,z\n'])
def test_too_long_row_is_refused(spark, tmp_path, content):
    with pytest.raises(MalformedExtract, match="more fields"):
        typed_extract(spark, write(tmp_path, content))


@pytest.mark.parametrize("content", ['a,b\n1,"x\ny"\nz,2,\n', "a,b\n1,x\nz,2,\n"])
def test_empty_extra_field_is_refused_with_and_without_line_breaks(spark, tmp_path, content):
    with pytest.raises(MalformedExtract, match="more fields"):
        typed_extract(spark, write(tmp_path, content))


@pytest.mark.parametrize("split_bytes", ["7", "100", "134217728"])
@pytest.mark.parametrize("content", [
    'a,b\n1,"x\n' + "2,y\n" * 50, 'a,b\n1,x\n2,"y', '"a,b\n1,2\n', 'a,b\n"p\nq",1\n3,"\n'])
def test_unclosed_quote_is_refused(spark, tmp_path, monkeypatch_conf, content, split_bytes):
    """pandas: EOF inside string."""
    with pytest.raises(pd.errors.ParserError):
        pd.read_csv(io.StringIO(content))
        raise pd.errors.ParserError("a header that is never closed")
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", split_bytes)
    monkeypatch_conf("spark.sql.files.openCostInBytes", split_bytes)
    with pytest.raises(MalformedExtract, match="inside quotes|empty"):
        typed_extract(spark, write(tmp_path, content))


@pytest.mark.parametrize("content", ["a,b\nz,2\rx,1\n", "a,b\rz,2\rx,1\r", 'a,b\n1,"x\ny"\rz,2\n'])
def test_bare_carriage_return_as_line_end_is_refused(spark, tmp_path, content):
    with pytest.raises(MalformedExtract, match="carriage returns"):
        typed_extract(spark, write(tmp_path, content))


def test_folder_of_files(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    write(folder, 'a,b\n1,"x\ny"\n', "part-0.csv")
    write(folder, "a,b\n2,z\n", "part-1.csv")
    table = typed_extract(spark, str(folder)).table
    assert sorted(map(tuple, table.collect())) == [(1, "x\ny"), (2, "z")]


def test_folder_with_another_column_order_is_refused(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    write(folder, "a,b\n1,x\n", "part-0.csv")
    write(folder, "b,a\ny,2\na,b\n", "part-1.csv")  # the header is there, but not in front
    with pytest.raises(MalformedExtract, match="another header"):
        typed_extract(spark, str(folder))


HEADERS = {
    "many_blank_lines": "\n" * 1_500 + '"a\nb",c\n1,2\n3,x\n',
    "many_breaks": '"a' + "\n" * 1_500 + '",c\n1,2\n3,"x\ny"\n',
    "crlf": '"a\r\nb",c\r\n1,2\r\n',
    "quoted": '"a","b ""c"""\n1,"x\ny"\n',
}


@pytest.mark.parametrize("split_bytes", ["134217728", "97"])
@pytest.mark.parametrize("case", HEADERS)
def test_header_of_any_length(spark, tmp_path, monkeypatch_conf, case, split_bytes):
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", split_bytes)
    monkeypatch_conf("spark.sql.files.openCostInBytes", "0")
    content = HEADERS[case]
    check_like_pandas(spark, write(tmp_path, content), content)


@pytest.mark.parametrize("split_bytes", ["134217728", "5"])
@pytest.mark.parametrize("first, second", [
    ('a,"b\nc",x,y\n1,2,3,4\n', 'a,"b\nd",y,x\n1,2,4,3\n'),
    ('a,"b\nc"\n1,2\n', 'a,"b\nc",d\n1,2,3\n'),
    ('a,b\n1,"x\ny"\n', 'b,a\n1,"x\ny"\n'),
    ("a,b\n1,2\n", 'a,"b\n"\n1,2\n')])
def test_folder_with_another_record_for_a_header_is_refused(spark, tmp_path, monkeypatch_conf, first,
                                                            second, split_bytes):
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", split_bytes)
    monkeypatch_conf("spark.sql.files.openCostInBytes", "0")
    folder = tmp_path / "x.csv"
    folder.mkdir()
    write(folder, first, "part-0.csv")
    write(folder, second, "part-1.csv")
    with pytest.raises(MalformedExtract, match="another header"):
        typed_extract(spark, str(folder))


@pytest.mark.parametrize("rows", ["1,2\n", '1,"x\ny"\n'])
def test_headers_are_compared_as_fields(spark, tmp_path, rows):
    """Quotes around a name, blank lines and line ends make no other header."""
    folder = tmp_path / "x.csv"
    folder.mkdir()
    for i, header in enumerate(["a,b\n", '\n \n"a",b\n', 'a,"b"\r\n']):
        write(folder, header + rows, f"part-{i}.csv")
    write(folder, "\n\n", "part-9.csv")  # no record, no header
    got = typed_extract(spark, str(folder))
    assert got.table.columns == ["a", "b"] and got.rows == got.table.count() == 3


def test_long_pieces_are_fetched(spark, tmp_path, monkeypatch_conf):
    """Pieces above the bound are left out of the first pass; lines without quotes are not one."""
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", "700000")
    monkeypatch_conf("spark.sql.files.openCostInBytes", "0")
    long = "\n".join(f"line {i}" for i in range(400_000))
    content = f'a,b\n1,"{long}"\n2,x\n' + "3,y\n" * 400_000 + f'4,"{long}"\n'
    path = write(tmp_path, content)
    got = typed_extract(spark, path)
    assert got.rows == 400_003 and got.columns == 2
    longest = got.table.where("length(b) > 1").collect()
    assert sorted(r.a for r in longest) == [1, 4] and {r.b for r in longest} == {long}


def test_quoted_file_is_read_twice(spark, tmp_path):
    """One scan of the text for the counts of both readings, and one for the table."""
    path = write(tmp_path, 'a,b\n1,"x\ny"\n2,z\n')
    read = quoted_lines.both_readings(spark, path)
    assert read._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    table = typed_extract(spark, path).table
    assert table._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1


def random_csv(seed, rows, stray=False):
    rng = random.Random(seed)
    bits = ["x", " ", ",", '""', "\n", "\n\n", "\r\n", "word", "1"]
    lines = ["id,text,n"]
    for i in range(rows):
        quoted = rng.random() < 0.6
        size = rng.randint(0, 60 if rng.random() < 0.05 else 8)
        text = '"' + "".join(rng.choice(bits) for _ in range(size)) + '"' if quoted else "plain"
        if stray and not quoted:
            text = rng.choice(['5" pipe', 'a"b"c', 'x""', 'p"', '-"""'])
        lines.append(f"{i},{text},{rng.randint(0, 9)}")
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("batch_rows,stray,seed,split_bytes", [
    ("3", False, 1, 100), ("10000", True, 2, 256), ("3", True, 3, 1000), ("10000", False, 4, 60)])
def test_records_over_many_splits(spark, tmp_path, monkeypatch_conf, seed, split_bytes,
                                  batch_rows, stray):
    """Splits much smaller than a record, so records start, pass and end in many splits;
    with and without quotes in the middle of unquoted fields."""
    content = random_csv(seed, 120, stray)
    path = write(tmp_path, content)
    monkeypatch_conf("spark.sql.files.maxPartitionBytes", str(split_bytes))
    monkeypatch_conf("spark.sql.files.openCostInBytes", "0")
    monkeypatch_conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    assert spark.read.text(path).select("_metadata.file_block_start").distinct().count() > 4
    check_like_pandas(spark, path, content)


def test_many_files_in_one_task(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    parts = [random_csv(seed, 20) for seed in range(12)]
    for i, part in enumerate(parts):
        write(folder, part, f"part-{i}.csv")
    got = typed_extract(spark, str(folder)).table
    wanted = pd.concat([pd.read_csv(io.StringIO(part, newline="")) for part in parts])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr(tuple(map(plain, r))) for r in wanted.astype(object).itertuples(index=False, name=None))


def test_reading_modes(spark, tmp_path, monkeypatch_conf):
    """What the lines hold decides who puts records together; both ways are split."""
    def mode(content):
        rows = csv_extract.read_extract(spark, write(tmp_path, content)).rows
        assert rows.rdd.getNumPartitions() > 1
        return "MapInArrow" in rows._jdf.queryExecution().toString()

    for key, value in {"spark.sql.files.maxPartitionBytes": "6",
                       "spark.sql.files.openCostInBytes": "0"}.items():
        monkeypatch_conf(key, value)
    assert not mode("a,b\n1,x\n")
    assert not mode('a,b\n1,"x,y"\n')
    assert not mode('a,b\n1,5" pipe\n')
    assert mode('a,b\n1,"x\ny"\n')
    assert mode('a,b\n1,"x\ny"\n2,5" pipe\n')


def test_plain_file_is_read_twice(spark, tmp_path):
    """One scan of the text for all counts, and one for the table."""
    path = write(tmp_path, "a,b\n1,x\n2,y\n")
    lines = csv_extract._lines(spark, path)
    assert str(lines._jdf.queryExecution().executedPlan().toString()).count("Scan text") == 1
    table = typed_extract(spark, path).table
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1 and "Scan text" not in plan


def test_names_that_differ_in_case_only():
    assert csv_extract.column_names(["A", "a", "a.1", None]) == ["A", "a.1", "a.1.1", "Unnamed: 3"]


def test_require_rows(spark):
    table = spark.range(1)
    assert require_rows(table, "t") is table
    with pytest.raises(MalformedExtract, match="t is empty or malformed"):
        require_rows(table.where("id > 5"), "t")
    with pytest.raises(MalformedExtract):
        require_rows(table.select(), "t")


def ends_inside_quotes(line):
    """Go through a line character by character, the way a CSV reader does."""
    state = "start"
    for c in line:
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "quote" and c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            state = "plain"
    return state == "quoted"


def test_whole_and_cut_lines(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice('a"",') for _ in range(rng.randint(0, 14))) for _ in range(40_000)]
    line = F.col("line")
    found = spark.createDataFrame([(text,) for text in lines], "line string").select(
        line, quoted_lines.effect(line).alias("effect"),
        quoted_lines.occurrences(",", quoted_lines.unquoted_part(line)).alias("separators"))
    for r in found.collect():
        cut, inside = ends_inside_quotes(r.line), ends_inside_quotes('"' + r.line)
        assert r.effect == cut + 2 * inside, r.line
        if not cut:
            assert r.separators + 1 == len(next(csv.reader([r.line]))) or not r.line, r.line


# Groups of field texts that pandas types without regard to their order in the column.
FIELDS = [
    ["1", "-2", "+3", "007", " 4 ", "900719925474099"],
    ["1.5", ".5", "5.", "1e3", "-2E-2", " 2.5", "inf", "-Infinity"],
    ["", "NA", "nan", "null", "None", "#N/A", "-1.#IND"],
    ["True", "TRUE", "true"],
    ["False", "FALSE", "false"],
    ["x", "1d", "2f", "0x1A", "1_000", "t", "yes", "na", "NONE", "1-2", "1e", "e1", "--1", "i",
     "I", "in", "+", ".", "2017-10-02", "1 2", "Inf1", "Tru", "nAn"],
]


@pytest.mark.parametrize("seed", range(3))
def test_types_of_many_columns(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = []
    for _ in range(150):
        groups = rng.sample(FIELDS, rng.choice([1, 1, 2, 2, 3]))
        columns.append([rng.choice(rng.choice(groups)) for _ in range(3)])
    # A last column without gaps, so that no line is blank.
    columns.append(["end"] * 3)
    lines = [",".join(f"c{i}" for i in range(len(columns)))] + [",".join(r) for r in zip(*columns)]
    content = "\n".join(lines) + "\n"
    check_like_pandas(spark, write(tmp_path, content), content)
