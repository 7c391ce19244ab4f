import random
from pathlib import Path

import pytest
from conftest import row_set
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.plans.inputs import ALL_TABLES
from latticework.plans.readers import QUERIES
from latticework.session import scratch_dir
from latticework.sources import records, tables
from latticework.streaming.runs import run_available


def lines(path, name, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(rows) + "\n", encoding="utf-8")


def test_directory_of_tables(spark, tmp_path):
    lines(tmp_path / "in", "region.csv", ["R_KEY;R_NAME", "1;AFRICA", "2;ASIA"])
    lines(tmp_path / "in", "price.csv", ["P_KEY;P_PRICE;P_DAY", "01;1.50;2024-01-05", "7;;2024-01-06"])
    tables.write_table(spark.range(3), str(tmp_path / "in" / "folder.csv"))
    assert list(tables.list_tables(spark, str(tmp_path / "in"))) == ["folder", "price", "region"]
    got = tables.read_tables(spark, f"file:{tmp_path}/in/")
    assert got["region"].dtypes == [("R_KEY", "int"), ("R_NAME", "string")]
    assert got["price"].dtypes == [("P_KEY", "int"), ("P_PRICE", "double"), ("P_DAY", "date")]
    assert row_set(got["price"].selectExpr("P_KEY", "P_PRICE")) == {(1, 1.5), (7, None)}
    assert got["folder"].count() == 3


def test_tables_come_back_as_written(spark, tmp_path):
    rows = [
        ("a\nb", 1, b"\x00\xff", [1.5]), ("", 2, None, []), (" lead ", 3, b"", None), (None, 4, None, None),
        ('q"u;o\\t"e', 5, None, None), ('"', 6, None, None), ("\\", 7, None, None), ('""', 8, None, None), ("a\r\nb", 9, None, None),
    ]
    df = spark.createDataFrame(rows, "t string, k int, b binary, a array<double>").repartition(2)
    df = df.withColumn("ts", F.lit("2024-01-01 00:09:58.778549").cast("timestamp"))
    tables.write_table(df, f"{tmp_path}/in/x.csv")
    schema = spark.createDataFrame([], "t string, k int, b string, a string, ts timestamp").schema
    got = tables.read_tables(spark, f"{tmp_path}/in", {"x": schema})["x"]
    want = df.select("t", "k", F.hex("b"), F.to_json("a"), "ts")
    assert row_set(got) == row_set(want)


def test_a_file_is_split_between_and_inside_its_records(spark, tmp_path):
    rng = random.Random(1)
    texts = ["a", "x\ny", 'q"q', ' "lead', ";\n\n;", "\r\n", "", None, "é\n" * 20, '"\n"']
    rows = [(i, "\n" * rng.randrange(6000) if rng.random() < 0.01 else rng.choice(texts), rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, text string, v double").coalesce(1)
    tables.write_table(df, f"{tmp_path}/in/many.csv")
    tables.write_table(df.select("id", "v"), f"{tmp_path}/in/plain.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(f"{tmp_path}/in/many.csv").select("_metadata.file_block_start").distinct().count() > 20
        got = tables.read_tables(spark, f"{tmp_path}/in")
        assert got["many"].schema == df.schema
        assert sorted(map(tuple, got["many"].collect())) == rows
        # Without line breaks in fields a file is read in splits as it is.
        assert tables.records(spark, f"{tmp_path}/in/plain.csv") is None
        assert got["plain"].rdd.getNumPartitions() > 5
        assert sorted(map(tuple, got["plain"].collect())) == [(i, v) for i, _, v in rows]
        # A record over many splits, alone and after another.
        tables.write_table(spark.createDataFrame([(1, "x"), (2, "\n" * 30_000)], "id int, text string").coalesce(1), f"{tmp_path}/long")
        assert sorted(tables.read_tables(spark, {"t": f"{tmp_path}/long"})["t"].collect()) == [(1, "x"), (2, "\n" * 30_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _stored(spark):
    """Bytes below the scratch folder."""
    return sum(f.stat().st_size for f in Path(spark.conf.get("spark.checkpoint.dir")).rglob("*") if f.is_file())


def test_records_are_stored_once(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "\n".join(f"{rng.random():.12f}" for _ in range(30))) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    df.write.parquet(f"{tmp_path}/given")
    given = sum(f.stat().st_size for f in (tmp_path / "given").rglob("*") if f.is_file())
    tables.write_table(df, f"{tmp_path}/in/t.csv")
    before = _stored(spark)
    got = tables.read_tables(spark, f"{tmp_path}/in")["t"]
    assert sorted(map(tuple, got.collect())) == rows
    assert _stored(spark) - before < 1.1 * given


def test_packed_tables_come_back_as_written(spark, tmp_path):
    rows = [(i, ["a", "x\ny", 'q"q', "", None, "a\r\nb", '"\n'][i % 7], i / 8) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, text string, v double").coalesce(1)
    tables.write_table(df, f"{tmp_path}/in/t.csv", **tables.PACKED | {"maxRecordsPerFile": 100})
    assert [f.suffix for f in (tmp_path / "in" / "t.csv").glob("part-*")] == [".gz"] * 5
    got = tables.read_tables(spark, f"{tmp_path}/in")["t"]
    assert got.schema == df.schema
    assert sorted(map(tuple, got.collect())) == rows


def test_the_query_stores_less_than_twice_its_tables(spark, tmp_path):
    rng = random.Random(3)
    words = [f"{rng.random():.9f}"[2:] for _ in range(20_000)]
    texts = ["\n".join(rng.choice(words) for _ in range(40)) for _ in range(3000)]
    odd = spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")
    plain = odd.select("item_id", F.col("item_id").cast("double").alias("v"))
    for name in ALL_TABLES:
        (odd if name in ("benchmark", "documents", "pages") else plain).write.parquet(f"{tmp_path}/{name}.parquet")
    given = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file())
    before = _stored(spark)
    got = QUERIES["read_tables"](spark, str(tmp_path))
    assert _stored(spark) - before < 2 * given
    want = {("documents.text", t, 1) for t in texts} | {("lineitem.v", f"{i}.0", 1) for i in range(3000)}
    assert row_set(got.where("attr IN ('documents.text', 'lineitem.v')").select("attr", "value", "n_cells")) == want


def test_tables_of_one_name_are_an_error(spark, tmp_path):
    lines(tmp_path / "tmp" / "tmp", "t.csv", ["k", "1"])
    assert list(tables.list_tables(spark, str(tmp_path / "tmp" / "tmp"))) == ["t"]
    lines(tmp_path / "tmp" / "tmp" / "t", "part.csv", ["k", "1"])
    with pytest.raises(ValueError, match="one name"):
        tables.list_tables(spark, str(tmp_path / "tmp" / "tmp"))


def test_map_of_paths_with_a_schema(spark, tmp_path):
    lines(tmp_path, "a.csv", ["k,v", "01,x"])
    schema = spark.createDataFrame([], "k string, v string").schema
    got = tables.read_tables(spark, {"a": str(tmp_path / "a.csv")}, {"a": schema}, sep=",")
    assert row_set(got["a"]) == {("01", "x")}


def test_report_and_result_sinks(spark):
    path = scratch_dir(spark, "sinks")
    tables.write_report(spark.createDataFrame([("a < b",)], "line string"), f"{path}/report")
    assert row_set(spark.read.text(f"{path}/report")) == {("a < b",)}
    tables.write_results(spark.createDataFrame([(1, "x", "found")], "id int, value string, status string"), f"{path}/results")
    assert row_set(spark.read.parquet(f"{path}/results")) == {(1, "x", "found")}


RECORD_LINES = [
    "ID;Name;PasswordChars;PasswordLength;Password;Hint1;Hint2",
    "1;  Ann;ABC;2;h1;x;y",
    '2;"Bo;b";ABC;2;h2;"";',
    "3;short;ABC",
    "4;long;ABC;2;h4;x;y;z",
    '5;"say \\"hi\\"";ABC;2;h5;x;y',
    "6;kürz;ABC;two;h6;x;y",
]


@pytest.fixture
def record_dir(tmp_path):
    lines(tmp_path / "data", "passwords.csv", RECORD_LINES)
    return tmp_path / "data"


def test_record_dialect(spark, record_dir):
    dialect = records.Dialect(directory=str(record_dir))
    df = records.read_records(spark, records.record_schema(2), dialect=dialect)
    got = {r["id"]: (r["name"], r["plen"], r["hint_1"], r["hint_2"]) for r in df.collect()}
    assert got == {
        1: ("Ann", 2, "x", "y"),
        2: ("Bo;b", 2, "", None),
        5: ('say "hi"', 2, "x", "y"),
        6: ("kürz", None, "x", "y"),
    }
    # Lines of another length stay out even if few columns are read.
    assert {r["id"] for r in df.select("id").collect()} == {1, 2, 5, 6}
    assert df.count() == 4


def test_lenient_mode_keeps_differing_lines(spark, record_dir):
    dialect = records.Dialect(directory=str(record_dir), skip_differing_lines=False)
    df = records.read_records(spark, records.record_schema(2), dialect=dialect)
    assert {r["id"] for r in df.collect()} == {1, 2, 3, 4, 5, 6}


def test_other_dialects(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("7|J\xf6|AB|1|h|'p|q'|\n".encode("latin-1"))
    dialect = records.Dialect(
        directory=str(tmp_path), name="x", ending="txt", has_header=False, charset="ISO-8859-1",
        separator="|", quote="'",
    )
    rows = records.read_records(spark, records.record_schema(2), dialect=dialect).collect()
    assert [(r["id"], r["name"], r["hint_1"], r["hint_2"]) for r in rows] == [(7, "Jö", "p|q", None)]


def test_path_of_a_dialect():
    assert records.Dialect().path == "data/passwords.csv"
    assert records.Dialect(directory="d", name="n", ending="tsv").path == "d/n.tsv"


def test_hint_array(spark, record_dir):
    df = records.read_records(spark, records.record_schema(2), str(record_dir))
    got = {r["id"]: r["hints"] for r in records.with_hint_array(df).collect()}
    assert got[1] == ["x", "y"] and got[2] == ["", None]


def test_stream_of_record_files(spark, tmp_path):
    for i in range(3):
        lines(tmp_path / "s", f"f{i}.csv", ["a;b;c;d;e;f;g", f"{i};n;AB;1;h;x;y", "bad;line"])
    stream = records.stream_records(spark, records.record_schema(2), str(tmp_path / "s"))
    got = run_available(stream, "record-test")
    assert {r["id"] for r in got.collect()} == {0, 1, 2} and got.count() == 3


STRICT = {
    '"a";"b"': ["a", "b"],
    ' x"a"y ; "b" ': ["a", "b"],
    'a;"b"': [None, "b"],
    '"";': ["", None],
    "": [None],
    ";": [None, None],
    '"a;b";"c"': ["a;b", "c"],
    '"say \\"hi\\"";"c\\\\"': ['say "hi"', "c\\"],
    '"a""b";""""': ['a"b', '"'],
    '"a" "b";"c"': ["ab", "c"],
    '"open;"': ["open;"],
    '"open;b': None,
    '"\\n";"\u0001s\u0001"': ["\\n", "\u0001s\u0001"],
    'x\u0001s;"\u0001t;\u0001q"': [None, "\u0001t;\u0001q"],
}


def test_strict_quotes(spark):
    rows = spark.createDataFrame([(line,) for line in [*STRICT, None]], "line string")
    fields = records.strict_fields(F.col("line"), records.Dialect())
    assert {r.line: r.fields for r in rows.select("line", fields.alias("fields")).collect()} == {**STRICT, None: None}


def test_strict_quotes_of_a_very_long_field(spark):
    text = 'a"b\\c;' * 200_000
    line = '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '";"z"'
    rows = spark.createDataFrame([(line,)], "line string")
    assert rows.select(records.strict_fields(F.col("line"), records.Dialect())).first()[0] == [text, "z"]


def test_strict_quotes_with_other_signs(spark):
    dialect = records.Dialect(separator="||", quote="'", escape="'")
    rows = spark.createDataFrame([("'a''b'||x||''||'c||d'",)], "line string")
    assert rows.select(records.strict_fields(F.col("line"), dialect)).first()[0] == ["a'b", None, "", "c||d"]


@pytest.mark.parametrize("skip", [True, False])
def test_strict_record_files(spark, tmp_path, skip):
    held = ["id;name", '1"7"x;"J\xf6"', '"8"', '"9";"cut', '"10";""', 'no;"\x01\x02\x01"', "", 'y"11";z']
    (tmp_path / "x.txt").write_bytes("\r\n".join(held).encode("latin-1"))
    dialect = records.Dialect(
        directory=str(tmp_path), name="x", ending="txt", charset="ISO-8859-1", strict_quotes=True, skip_differing_lines=skip
    )
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    got = sorted(map(tuple, records.read_records(spark, schema, dialect=dialect).collect()), key=repr)
    want = [(7, "Jö"), (10, ""), (None, "\x01\x02\x01"), (11, None)]
    assert got == sorted(want if skip else [*want, (8, None), (None, None)], key=repr)
    streamed = run_available(records.stream_records(spark, schema, str(tmp_path), dialect=dialect), "strict-test")
    assert sorted(map(tuple, streamed.collect()), key=repr) == got


def test_strict_quotes_refuse_several_lines(spark):
    with pytest.raises(ValueError):
        records.read_records(spark, records.record_schema(1), "x", records.Dialect(strict_quotes=True, multi_line=True))
