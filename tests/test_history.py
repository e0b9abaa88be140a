"""Brute-force replay of a small history against the window recipes."""

import math
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from metricloom.operators import history, labels
from metricloom.operators.history import change_features

AS_OF = datetime(2020, 6, 1)
DAY0 = datetime(2020, 1, 1)

# repo, hash, seq, author, day, message, merge, [(path, added, deleted, nloc)]
CHANGES = [
    ("r", "c1", 1, "ann", 0, "start", False, [("src/a.py", 10, 0, 100), ("src/b.py", 5, 0, 50)]),
    ("r", "c2", 2, "bob", 3, "Fix it", False, [("src/a.py", 2, 4, 98), ("top.py", 1, 1, None)]),
    ("r", "c3", 3, "ann", 2, "closes #12", False, [("src/a.py", 3, 3, 98), ("src/a.py", 0, 0, 98)]),
    ("r", "c4", 4, "bob", 9, "merge", True, [("src/a.py", 99, 99, 1)]),
    ("r", "c5", 5, "cy", 11, "prefix", False, []),
    ("r", "c6", 6, "bob", 15, "tidy", False, [("doc/x.txt", 0, 0, None), ("src/a.py", 1, 0, 99)]),
    ("q", "c7", 1, "ann", 1, "errors", False, [("src/a.py", 1, 0, 7)]),
]


def _frame(spark, changes=CHANGES):
    rows = [
        (r, h, s, a, DAY0 + timedelta(days=d), m, g, p, la, ld, n)
        for r, h, s, a, d, m, g, files in changes
        for p, la, ld, n in (files or [(None, 0, 0, None)])
    ]
    schema = (
        "repo string, hash string, commit_seq long, author string, committer_date timestamp, "
        "msg string, merge boolean, path string, added long, deleted long, nloc long"
    )
    return spark.createDataFrame(rows, schema)


def _replay(changes):
    """One pass in order, reading the state before updating it."""
    out = {}
    for repo in {c[0] for c in changes}:
        authors, last, count = defaultdict(set), {}, defaultdict(int)
        commits, recent, areas = defaultdict(int), defaultdict(float), defaultdict(int)
        for _, h, _, who, day, msg, merge, files in sorted(
            (c for c in changes if c[0] == repo), key=lambda c: c[2]
        ):
            if merge or not files:
                continue
            paths = [f[0] for f in files]
            spots = {p.split("/")[0] for p in paths}
            lines = [f[1] + f[2] for f in files]
            total = sum(lines)
            entropy = 0.0
            if total and len(files) > 1:
                entropy = -sum(x / total * math.log2(x / total) for x in lines if x)
                entropy /= math.log2(len(files))
            sizes = [f[3] for f in files if f[3] is not None and f[3] >= 0]
            ages = [max(day - last[p], 0) for p in paths if p in last]
            out[h] = {
                "NS": len(spots),
                "ND": len({p.rpartition("/")[0] for p in paths}),
                "NF": len(files),
                "Entropy": entropy,
                "LA": sum(f[1] for f in files),
                "LD": sum(f[2] for f in files),
                "LT": sum(sizes) / len(sizes) if sizes else 0.0,
                "FIX": int(msg in ("Fix it", "closes #12")),
                "NDEV": sum(len(authors[p]) for p in paths) / len(paths),
                "AGE": sum(ages) / len(ages) if ages else 0.0,
                "NUC": sum(count[p] for p in paths) / len(paths),
                "EXP": commits[who],
                "REXP": recent[who],
                "SEXP": sum(areas[who, s] for s in spots),
            }
            for p in paths:
                authors[p].add(who)
                last[p] = day
                count[p] += 1
            commits[who] += 1
            years = (AS_OF - (DAY0 + timedelta(days=day))).days / 365.25
            recent[who] += 1 / (years + 1)
            for s in spots:
                areas[who, s] += 1
    return out


def _check(df, expected):
    rows = {r["hash"]: r.asDict() for r in df.collect()}
    assert rows.keys() == expected.keys()
    digits = {"Entropy": 6, "LT": 2, "NDEV": 2, "AGE": 2, "NUC": 2, "REXP": 4}
    for h, want in expected.items():
        for name, value in want.items():
            assert rows[h][name] == pytest.approx(value, abs=0.6 * 10 ** -digits.get(name, 9)), (h, name)


def test_replay(spark):
    _check(change_features(_frame(spark), AS_OF), _replay(CHANGES))


def _busy():
    """A file and an author that appear in a third and more of all changes."""
    out = []
    for i in range(160):
        who = "bot" if i % 2 else f"dev{i % 7}"
        files = [("core/hot.py", i % 5, i % 3, 10 + i)]
        if i % 4 == 0:
            files.append((f"lib{i % 6}/m{i % 11}.py", 3, 1, 5))
        out.append(("r", f"h{i}", i, who, (i * 13) % 50, "x", False, files))
    return out


def test_hot_files_and_authors_are_split_without_changing_results(spark):
    changes = _busy()
    frame = _frame(spark, changes)
    assert len(history._blocks(frame, 30).bounds) > 3
    _check(change_features(frame, AS_OF, rows_per_task=30), _replay(changes))


def test_single_dimension_operators_agree_with_the_full_table(spark):
    frame = _frame(spark)
    full = change_features(frame, AS_OF)
    for part in (history.diffusion(frame), history.size(frame), history.purpose(frame),
                 history.history(frame), history.experience(frame, AS_OF)):
        cols = sorted(part.columns)
        assert sorted(map(tuple, part.select(cols).collect())) == sorted(
            map(tuple, full.select(cols).collect())
        )


def test_diffusion_counts_root_files_and_does_not_expand_the_log(spark):
    files = ["a.py", "b.py", "x/c.py", "x/y/d.py", "x/y/e.py", "z/f.py"]
    frame = _frame(spark, [("r", "h", 1, "a", 0, "m", False, [(f, 2, 0, 1) for f in files])])
    table = history.diffusion(frame)
    row = table.first()
    assert (row["NS"], row["ND"], row["NF"], row["Entropy"]) == (4, 4, 6, 1.0)
    assert "Expand" not in table._jdf.queryExecution().executedPlan().toString()


def test_order_of_rows_does_not_matter(spark):
    frame = _frame(spark)
    a = change_features(frame, AS_OF).collect()
    b = change_features(frame.orderBy(F.desc("path")).repartition(3), AS_OF).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_labelling(spark):
    changes = [
        ("r", "w1", 1, "ann", 0, "new", False, [("a.py", 2, 0, 9), ("b.txt", 1, 0, 9)]),
        ("r", "w2", 2, "ann", 1, "more", False, [("a.py", 1, 0, 9)]),
        ("r", "f1", 3, "bob", 2, "fix a", False, [("a.py", 0, 2, 9), ("b.txt", 0, 1, 9)]),
        ("r", "f2", 4, "bob", 3, "bug", False, [("a.py", 0, 1, 9)]),
    ]
    frame = _frame(spark, changes).withColumn("file_order", F.col("path"))
    lines = spark.createDataFrame(
        [
            ("r", "w1", 1, "a.py", 1, "write", "x = 1"), ("r", "w1", 1, "a.py", 2, "write", "y = 1"),
            ("r", "w2", 2, "a.py", 1, "write", "x = 2"), ("r", "w1", 1, "b.txt", 1, "write", "t"),
            ("r", "f1", 3, "a.py", 1, "delete", "x = 2"), ("r", "f1", 3, "a.py", 2, "delete", "# c"),
            ("r", "f1", 3, "b.txt", 1, "delete", "t"), ("r", "f2", 4, "a.py", 1, "delete", "  # only"),
        ],
        "repo string, hash string, commit_seq long, path string, line_id int, op string, content string",
    )
    candidates = labels.fix_candidates(frame, lines)
    assert [(r["hash"], r["path"]) for r in candidates.collect()] == [("f1", "a.py")]
    for rows_per_task in (2, 1_000_000):
        origins = labels.line_origins(candidates, lines, rows_per_task)
        # the comment line is traced too: a meaningful line only admits the file
        assert {(r["line_id"], r["origin"]) for r in origins.collect()} == {(1, "w2"), (2, "w1")}
    out = labels.inducing_label(history.purpose(frame), origins)
    assert {r["hash"]: r["is_buggy"] for r in out.collect()} == {"w1": 1, "w2": 1, "f1": 0, "f2": 0}
    report = labels.labelling_report(out).first()
    assert (report["commits"], report["fixes"], report["labelled"], report["rate_pct"]) == (4, 2, 2, 50.0)


def test_all_files_of_a_fix_count_unless_told_otherwise(spark):
    files = [(f"d/{i:02d}.py", 0, 1, 1) for i in range(12)] + [("d/00.txt", 0, 1, 1)]
    frame = _frame(spark, [("r", "f", 1, "a", 0, "bugfix", False, files)]).withColumn(
        "file_order", F.col("path")
    )
    lines = frame.select(
        "repo", "hash", "commit_seq", "path", F.lit(1).alias("line_id"),
        F.lit("delete").alias("op"), F.lit("x").alias("content"),
    )
    for most, count in ((None, 12), (8, 8)):
        found = labels.fix_candidates(frame, lines, max_files=most).collect()
        assert sorted(r["path"] for r in found) == [f"d/{i:02d}.py" for i in range(count)]


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(".data" in str(f) for f in manager.getAllFiles().mkString(" ").split())


def test_what_was_shuffled_for_a_stored_table_leaves_the_disk(spark):
    """The files of a shuffle go with the write, and tables that nobody reads any more with the next one."""
    from metricloom.session import path_exists, written_once

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(setting, "false"), _shuffle_files(spark)
    table = spark.range(5_000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    first = written_once(table, "first")
    assert _shuffle_files(spark) <= files
    second = written_once(first.groupBy("k").count(), "second", instead_of=[first])
    assert _shuffle_files(spark) <= files and spark.conf.get(setting, "false") == before
    assert not path_exists(spark, first.__dict__["_written_to"]) and second.count() == 7


def test_the_pasts_of_a_change_are_stored_one_after_the_other(spark):
    """The plan that is left only joins them: no window, and no second shuffle of file rows."""
    table = change_features(_frame(spark), AS_OF)
    plan = table._jdf.queryExecution().toString()
    assert "Window" not in plan and "Generate" not in plan and plan.count("Exchange") < 20
    assert len(table.collect()) == len({c[1] for c in CHANGES if not c[6] and c[7]})
