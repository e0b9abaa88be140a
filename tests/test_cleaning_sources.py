from datetime import datetime

import pytest
from pyspark.sql import Row, functions as F

from metricloom import session
from metricloom.functions import scalars as s
from metricloom.operators import cleaning, features, relational
from metricloom.session import scratch_path
from metricloom.sources import delimited
from metricloom.sources.ledger import KeyLedger


def _column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.withColumn("y", expr(F.col("x"))).orderBy("i").collect()]


def test_corrective_messages(spark):
    yes = ["Fix it", "closes #12", "fixes#3x", "a BUG!", "Resolving: x", "line\nhotfix\n"]
    no = ["prefix", "closes 12", "fixing", "Errors", "éfix", "bug_1", "reverted", "", None]
    assert _column(spark, yes + no, s.is_corrective) == [True] * len(yes) + [False] * len(no)


def test_numbers(spark):
    got = _column(spark, ["1", " 2.5 ", "-3e2", ".5", "1d", "0x1", "", "NaN", "1_0", None, "inf"], s.to_number)
    assert got == [1.0, 2.5, -300.0, 0.5, None, None, None, None, None, None, float("inf")]


def test_instants(spark):
    df = spark.createDataFrame([("2024-03-01T12:00:00+02:00",), ("junk",), (None,)], "at string")
    rows = cleaning.coerce_timestamp(df, "at").collect()
    assert [r["at"] for r in rows] == [datetime(2024, 3, 1, 10)]


def test_message_head_cuts_before_collapsing(spark):
    text = "a" * 118 + " \n  tail"
    assert _column(spark, [text, "  x \t  y  "], s.message_head) == ["a" * 118, "x y"]


def test_paths(spark):
    paths = ["src\\a\\b.py", "top.py", "d/x.txt", "d//e.py"]
    assert _column(spark, paths, s.subsystem) == ["src", "top.py", "d", "d"]
    assert _column(spark, paths, s.directory) == ["src/a", "", "d", "d"]
    assert _column(spark, paths + [None], s.is_python) == [True, True, False, True, False]


def test_lines(spark):
    lines = ["", "  ", "# c", "  # c", "x # c", " ", "#a\nb"]
    assert _column(spark, lines, s.is_meaningful_line) == [False] * 4 + [True, False, True]


def test_label_clamp(spark):
    got = _column(spark, [None, float("nan"), -2.0, 0.9, 1.0, 1.9, 7.0], cleaning.clamp_label, "double")
    assert got == [0, 0, 0, 0, 1, 1, 1]


def test_author_key(spark):
    df = spark.createDataFrame([("e", "n"), ("", "n"), (None, ""), (None, None)], "e string, n string")
    got = [r[0] for r in df.select(s.author_key(F.col("e"), F.col("n"))).collect()]
    assert got == ["e", "n", "unknown", "unknown"]


def test_first_row_per_key(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}", 100 - i) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, k string, at int").repartition(4)
    got = {r["k"]: r["id"] for r in cleaning.dedup_keep_first(df, "k", ["at", "id"]).collect()}
    assert got["hot"] == 89 and len(got) == 31


def test_constant_columns_rules(spark):
    one = spark.createDataFrame([(1.0, None, 2.0)], "a double, e double, b double")
    names = lambda df, rule: {r[0] for r in cleaning.constant_columns(df, df.columns, rule).collect()}
    assert names(one, "distinct") == {"a", "e", "b"} and names(one, "deviation") == set()
    two = one.unionAll(spark.createDataFrame([(1.0, None, 3.0)], one.schema))
    assert names(two, "deviation") == {"a"}
    assert cleaning.drop_constant_columns(two, two.columns).columns == ["b"]


def test_maturity_is_strict(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 17),), (datetime(2024, 1, 16, 23),)], "at timestamp")
    assert cleaning.maturity_filter(df, "at", datetime(2024, 7, 15)).count() == 1


def test_derived_columns_survive_dropped_inputs(spark):
    df = spark.createDataFrame([(4.0, 0.5)], "LA double, LT double")
    row = features.log1p_bank(features.size_ratios(features.churn(df))).first()
    assert row["churn"] == 4.0 and row["LA_ratio"] == 4.0 and row["LD_ratio"] == 0.0
    assert "LD_log" not in row.asDict()


def test_zscore_keeps_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "k double, x double")
    rows = features.zscore(df, ["k", "x"]).collect()
    assert [r["k_z"] for r in rows] == [1.0, 1.0]
    assert sorted(r["x_z"] for r in rows) == pytest.approx([-(0.5**0.5), 0.5**0.5])


def test_touched_path(spark):
    df = spark.createDataFrame([("a\\b", "c"), (None, "c"), ("", None)], "n string, o string")
    got = [r[0] for r in df.select(cleaning.touched_path(F.col("n"), F.col("o"))).collect()]
    assert got == ["a/b", "c", None]


def test_pivot_and_lookup(spark):
    df = spark.createDataFrame([("m", "s", 1.0), ("m", "s", 3.0), ("m", "t", 4.0)], "r string, c string, v double")
    row = relational.pivot_metric(df, "r", "c", "v", ["s", "t"]).first()
    assert (row["s"], row["t"]) == (2.0, 4.0)
    assert relational.key_lookup(df, df.where("v > 3"), ["c"]).count() == 1


def test_ragged_csv(spark):
    path = scratch_path(spark, "t")
    text = 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,"x\ny",12'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    read = delimited.read_lenient_csv(spark, path, ["a", "b", "c"], quoted_breaks=True)
    rows = read.collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "2", "3"), ("10", "x\ny", "12"), ("4", "5", None)]


@pytest.mark.parametrize("breaks", [False, True])
def test_ragged_rows_go_whatever_is_read(spark, breaks):
    path = scratch_path(spark, "t")
    text = 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"10",x,12\n,,\n"a,b","c",d,"e,f"'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    read = delimited.read_lenient_csv(spark, path, ["a", "b", "c"], quoted_breaks=breaks)
    whole = read.collect()
    assert sorted(map(tuple, whole), key=str) == [("1", "2", "3"), ("10", "x", "12"), ("4", "5", None), (None, None, None)]
    assert read.count() == 4
    for cols in (["a"], ["b"], ["c"], ["c", "a"]):
        narrow = read.select(*cols).collect()
        assert sorted(map(str, narrow)) == sorted(str(spark_row(r, cols)) for r in whole)


def spark_row(row, cols):
    return Row(**{c: row[c] for c in cols})


def test_large_ragged_files_are_split(spark):
    path = scratch_path(spark, "t")
    lines = spark.range(20_000).selectExpr("concat(id, ',', id, ',', id) as value")
    lines.coalesce(1).write.text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        read = delimited.read_lenient_csv(spark, path, ["a", "b", "c"], header=False)
        assert read.rdd.getNumPartitions() > 2 and read.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_result_round_trip(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    for fmt in ("csv", "parquet"):
        path = scratch_path(spark, "t")
        for _ in range(2):
            delimited.write_result(df, path, fmt)
        back = delimited.read_result(spark, path, df.schema, fmt)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_ledger(spark):
    log = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "repo string, v int")
    offered = spark.createDataFrame([("a",), ("empty",)], "repo string")
    ledger = KeyLedger(spark, scratch_path(spark, "t"), "repo")
    ledger.ingest(log.where("repo = 'a'"), offered)
    ledger.ingest(log)
    ledger.ingest(log.unionAll(spark.createDataFrame([("empty", 9)], log.schema)))
    assert sorted(r["v"] for r in ledger.rows().collect()) == [1, 2, 3]
    assert {r["repo"] for r in ledger.keys().collect()} == {"a", "b", "empty"}
    ledger.ingest(log.where("repo = 'b'"), force=True)
    assert [r["v"] for r in ledger.rows().collect()] == [3]
    assert {r["repo"] for r in ledger.keys().collect()} == {"b"}


def test_ledger_takes_a_missing_key_once(spark):
    log = spark.createDataFrame([("a", 1), (None, 2)], "repo string, v int")
    ledger = KeyLedger(spark, scratch_path(spark, "t"), "repo")
    for _ in range(3):
        ledger.ingest(log)
    assert sorted(r["v"] for r in ledger.rows().collect()) == [1, 2]
    assert ledger.keys().count() == 2


def test_own_folder_without_the_setting(spark, monkeypatch):
    monkeypatch.setattr(spark.conf.__class__, "get", lambda *_: None)
    root = session.scratch_root(spark)
    assert root == session.scratch_root(spark) and session.scratch_path(spark, "t").startswith(root)


def test_ledger_shows_real_faults(spark):
    from metricloom.session import scratch_path
    from metricloom.sources.ledger import KeyLedger

    root = scratch_path(spark, "ledger")
    ledger = KeyLedger(spark, root, "k")
    assert ledger.rows() is None
    spark.createDataFrame([("no parquet",)], "x string").write.text(f"{root}/rows")
    with pytest.raises(Exception):
        ledger.rows().count()


def test_features_that_are_numbers_are_not_read_as_text(spark):
    df = spark.createDataFrame(
        [(1.5e-7, 2**53 + 1, "1d"), (float("nan"), None, " 2 "), (float("-inf"), -3, None)], "a double, b long, c string"
    )
    got = cleaning.ensure_features(df, ["a", "b", "c", "absent"])
    assert got.collect() == [
        (1.5e-7, float(2**53 + 1), 0.0, 0.0), (0.0, 0.0, 2.0, 0.0), (float("-inf"), -3.0, 0.0, 0.0),
    ]
    plan = cleaning.ensure_features(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "as string" not in plan
