import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from safelabel.operators.sampling import ratio_split
from safelabel.operators.scanning import first_n, reject_summary, require_keys, scan_summary, with_rejects
from safelabel.session import collect_config, scratch_root
from safelabel.sources.jsonl import read_jsonl
from safelabel.sources.sinks import write_jsonl, write_predictions, write_split
from safelabel.sources.tables import read_parquet_with_id, read_table
from tests.helpers import optimized

FAILURES = (PySparkException, Py4JJavaError)
SCHEMA = "id bigint, text string, n double"
LINES = ['{"id": 1, "text": "অ", "n": 0.5}', "", "  ", '{"id": 2, "text": ', "[1, 2]", "3", '{"id": 4}', '{"id": 5, "extra": true}', '{"id": "x"}', "null"]


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_tolerant_scan(spark, lines):
    df = read_jsonl(spark, lines, SCHEMA)
    assert sorted(r.id for r in df.collect()) == [1, 4, 5]
    assert df.count() == 3 and df.filter("id = 1").first().text == "অ"


def test_lines_are_parsed_once(spark, lines):
    assert optimized(read_jsonl(spark, lines, SCHEMA)).count("from_json(") == 1


def test_kept_rejects(spark, lines):
    df = read_jsonl(spark, lines, SCHEMA, "keep")
    counts = reject_summary(with_rejects(df, F.col("_corrupt_record").isNotNull())).first()
    assert (counts.processed, counts.valid, counts.malformed) == (8, 3, 5)
    assert {r._corrupt_record for r in df.collect()} >= {"[1, 2]", '{"id": 2, "text": '}


def test_strict_scan(spark, lines, tmp_path):
    with pytest.raises(FAILURES):
        read_jsonl(spark, lines, SCHEMA, "fail").collect()
    for bad in ("[1]", "3", '{"id": '):
        path = tmp_path / f"bad{len(bad)}.jsonl"
        path.write_text('{"id": 1}\n' + bad + "\n")
        with pytest.raises(FAILURES):
            read_jsonl(spark, str(path), SCHEMA, "fail").collect()
    good = tmp_path / "good.jsonl"
    good.write_text('{"id": 1}\n\n{"id": 2}\n')
    assert read_jsonl(spark, str(good), SCHEMA, "fail").count() == 2
    with pytest.raises(ValueError):
        read_jsonl(spark, str(good), SCHEMA, "other")


def test_jsonl_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    write_jsonl(spark.createDataFrame([(2, "ଅ\"\n", None)], "b int, a string, c string").coalesce(1), path)
    line = next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    assert "ଅ" in line and list(json.loads(line)) == ["b", "a", "c"] and json.loads(line) == {"b": 2, "a": 'ଅ"\n', "c": None}


def test_csv_sink(spark, tmp_path):
    rows = [(1, ' a "quoted", text\nwith lines ', "SAFE"), (2, "-", None), (3, "\\", "x")]
    schema = "id int, text string, gold string"
    write_predictions(spark.createDataFrame(rows, schema), str(tmp_path / "p"))
    back = read_table(spark, str(tmp_path / "p"), "csv", schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_split_sink(spark, tmp_path):
    df = spark.range(20)
    write_split(ratio_split(df, 0.9), str(tmp_path / "s"))
    sizes = [read_jsonl(spark, str(tmp_path / "s" / f"split={n}"), "id bigint").count() for n in ("train", "test")]
    assert sizes == [18, 2]


def test_row_ids(spark, tmp_path):
    spark.range(100).selectExpr("'copy' AS text").repartition(3).write.parquet(str(tmp_path / "t"))
    read = lambda: {r.id for r in read_parquet_with_id(spark, str(tmp_path / "t")).collect()}
    assert len(read()) == 100 and read() == read()


def test_tables(spark, tmp_path, sf):
    assert read_table(spark, f"{sf}/labels.parquet").count() > 0
    with pytest.raises(ValueError):
        read_table(spark, "x", "csv")
    with pytest.raises(ValueError):
        read_table(spark, "x", "xml")


def test_keys_and_first_rows(spark):
    df = spark.createDataFrame([(1, "s", "l"), (2, None, "l"), (3, "", "l"), (4, "s", None)], "id int, source string, language string")
    good, bad = require_keys(df, ["source", "language"])
    assert sorted(r.id for r in good.collect()) == [1, 3] and sorted(r.id for r in bad.collect()) == [2, 4]
    assert [r.id for r in first_n(df, 2).collect()] == [1, 2]


def test_scan_summary(spark):
    good = " ".join(["0.5"] * 17)
    df = spark.createDataFrame([(good,), ("",), (None,), ("x",)], "safety_distribution string")
    assert tuple(scan_summary(df).first()) == (4, 1, 3)


def test_session_helpers(spark):
    assert scratch_root(spark) == scratch_root(spark)
    with pytest.raises(ValueError):
        collect_config(spark.range(5), 4, "the table")


def test_scratch_root_is_the_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "/shared"}.get(key, default))

    assert scratch_root(Session) == "/shared"

    class Plain:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "/house/"}.get(key, default))

    assert scratch_root(Plain) == "/house/scratch"
