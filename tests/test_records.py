"""Quoted text with line breaks in its fields: the same rows as Spark's one-task reader, from several tasks."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import delimited as D, records as R

SCHEMA = "id bigint, name string, note string"


def as_spark_reads(spark, path, schema=SCHEMA):
    return spark.read.options(**D.QUOTING, multiLine="true").schema(schema).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def quoted(v):
    return '"' + v.replace('"', '""') + '"'


@pytest.fixture
def small_ranges(spark):
    for c, v in (("spark.sql.files.maxPartitionBytes", "700"), ("spark.sql.files.openCostInBytes", "0"), ("spark.sql.files.minPartitionNum", "1")):
        spark.conf.set(c, v)
    yield
    for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{c}")


def write(path, n, newline="\n", seed=1, long_field=0):
    rng = random.Random(seed)
    parts = ["plain", "semi;colon", 'a "quoted" word', "two\nlines", "many\n\n\nlines\n", 'odd" quote', "", "é;\n\"", "\n", '""', ";"]
    out = ["id;name;note"]
    for i in range(n):
        name, note = "".join(rng.choices(parts, k=rng.randint(0, 3))), rng.choice(parts)
        if i == n // 2:
            note = "x;\n" * long_field
        stray = rng.random() < 0.1
        out.append(";".join([str(i), '5" disk' if stray else quoted(name.replace("\n", newline)), quoted(note.replace("\n", newline))]))
    path.write_bytes((newline.join(out) + newline).encode())


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("many", [False, True])
def test_same_rows_as_one_task(spark, tmp_path, small_ranges, monkeypatch, newline, many):
    if many:
        monkeypatch.setattr(R, "MANY_RANGES", 0)
    for i in range(2):
        write(tmp_path / f"part{i}.csv", 300, newline, seed=i, long_field=900 * i)
    want = rows(as_spark_reads(spark, str(tmp_path)))
    assert len(want) == 600
    assert rows(D.read_typed(spark, str(tmp_path), SCHEMA)) == want
    lines = R._lines(spark, str(tmp_path / "part0.csv"))
    tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    inside = R.range_starts(R._range_ends(lines, ";")).count()
    assert tasks > 10 and 0 < inside < tasks  # several tasks read one file, and some begin inside a field
    assert rows(D.read_columns(spark, str(tmp_path), SCHEMA, ["note"])) == sorted(((r[2],) for r in want), key=repr)


def test_record_longer_than_several_ranges(spark, tmp_path, small_ranges):
    path = tmp_path / "a.csv"
    path.write_text('id;name;note\n1;"' + "line\n" * 2000 + '";a\n2;b;"' + ";\n" * 1500 + '"\n3;c;d\n')
    assert rows(D.read_typed(spark, str(path), SCHEMA)) == rows(as_spark_reads(spark, str(path)))


@pytest.mark.parametrize("text", ["", "id;name;note\n", "id;name;note", "id;name;note\n1;a;b", "id;name;note\n\n1;;\n\n2;\"\";x\n", 'id;name;note\nx;"a;b\nc";9\n7;a\n'])
def test_edges(spark, tmp_path, text):
    path = tmp_path / "a.csv"
    path.write_text(text)
    assert rows(D.read_typed(spark, str(path), SCHEMA)) == rows(as_spark_reads(spark, str(path)))


def test_unclosed_quote_takes_the_rest(spark, tmp_path, small_ranges):
    path = tmp_path / "a.csv"
    path.write_text('id;name;note\n1;a;b\n2;"open;c\n' + "3;d;e\n" * 400)
    got = D.read_typed(spark, str(path), SCHEMA).orderBy("id").collect()
    assert [r.id for r in got] == [1, 2] and got[1].name.count("\n") >= 399


def test_inferred_types(spark, tmp_path, small_ranges):
    path = tmp_path / "a.csv"
    path.write_text("n;x;t\n" + "".join(f'{i};{i}.5;"a\n{i}"\n' for i in range(200)))
    got = D.read_inferred(spark, str(path))
    assert got.dtypes == [("n", "int"), ("x", "double"), ("t", "string")] and got.count() == 200
    assert rows(got) == rows(spark.read.options(**D.QUOTING, multiLine="true", inferSchema="true").csv(str(path)))


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        D.read_typed(spark, str(tmp_path / "none"), SCHEMA).collect()


@pytest.mark.parametrize("line,out,inside", [("a;b", False, True), ('"a', True, False), ('a"b', False, False), ('""', False, True), ('x;"y""z', True, False),
                                             ('a";"b', True, True), ('";x', True, False), ("", False, True)])
def test_ends_inside(line, out, inside):
    assert (R.ends_inside(line, False, ";"), R.ends_inside(line, True, ";")) == (out, inside)
