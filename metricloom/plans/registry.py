"""Every operator as a runnable query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from metricloom.functions import scalars as s
from metricloom.operators import (
    cleaning,
    correlation,
    evaluation,
    features,
    history,
    labels,
    learners,
    linear_models,
    normality,
    profile,
    relational,
    splits,
)
from metricloom.operators.ordered import running_before
from metricloom.plans import roles
from metricloom.plans.roles import METRICS, TEXT_FEATURES
from metricloom.plans.risk import (
    build_dataset,
    compare_models,
    compare_regressors,
    dataset_statistics,
    dataset_summary,
    risk_study,
    risk_table,
)
from metricloom.session import scratch_path, written_once
from metricloom.sources import delimited
from metricloom.sources.ledger import KeyLedger
from metricloom.streaming import history as stream_history
from metricloom.streaming import ingest as stream_ingest

AS_OF = datetime(2002, 1, 1)
EVENTS_AS_OF = datetime(2024, 7, 15)
PAIRS = [("l_quantity", "l_extendedprice"), ("p_size", "l_linenumber"), ("l_tax", "p_retailprice")]
PREDICTORS = ["l_quantity", "p_retailprice", "l_linenumber"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _metric_query(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, d: fn(roles.metric_table(spark, d))


def _change_query(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, d: fn(roles.change_log(spark, d, by_change=True))


def _scored_query(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, d: fn(roles.scored(spark, d))


# --- sources and sinks ------------------------------------------------------------------


@query("csv_metric_scan")
def _(spark, d):
    lines = roles.table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_linenumber").cast("string")).alias(
            "l_linenumber"
        ),
    )
    path = scratch_path(spark, "csv")
    delimited.write_result(lines, path)
    return delimited.read_metric_csv(spark, path, ["l_returnflag", "l_linestatus"])


def _ragged(spark, d, quoted_breaks: bool) -> DataFrame:
    key, kind, broken = F.col("event_id").cast("string"), F.col("event_type"), "\n" * quoted_breaks
    line = (
        F.when(F.col("event_id") % 10 == 0, F.concat_ws(",", key, kind, F.lit("1"), F.lit("extra")))
        .when(F.col("event_id") % 7 == 0, F.concat_ws(",", key, kind))
        .when(F.col("event_id") % 3 == 0, F.concat(key, F.lit(',"'), kind, F.lit(f',{broken}""x""",2')))
        .otherwise(F.concat_ws(",", key, kind, F.lit("3")))
    )
    path = scratch_path(spark, "ragged")
    roles.table(spark, d, "events").select(line.alias("value")).write.text(path)
    return delimited.read_lenient_csv(
        spark, path, ["key", "kind", "size"], header=False, quoted_breaks=quoted_breaks
    )


QUERIES["csv_lenient_scan"] = lambda spark, d: _ragged(spark, d, True)
QUERIES["csv_lenient_one_column"] = lambda spark, d: _ragged(spark, d, False).select("kind")


@query("incremental_ingest")
def _(spark, d):
    log = roles.commit_log(spark, d).select("repo", "hash", "author")
    ledger = KeyLedger(spark, scratch_path(spark, "ledger"), "repo")
    ledger.ingest(log.where(F.col("repo") < 2))
    ledger.ingest(log)
    ledger.ingest(log)
    return ledger.rows().select("repo", "hash", "author")


@query("result_sink")
def _(spark, d):
    table = profile.group_balance(_labelled_log(spark, d), "repo", "label")
    path = scratch_path(spark, "result")
    delimited.write_result(table, path)
    return delimited.read_result(spark, path, table.schema)


@query("feature_scan")
def _(spark, d):
    log = roles.commit_log(spark, d)
    stamp = F.date_format("committer_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = log.select(
        "hash",
        F.when(F.col("hash") % 9 == 0, "not a date").otherwise(stamp).alias("committer_date"),
        F.log1p("churn").alias("churn_log"),
    )
    path = scratch_path(spark, "features")
    delimited.write_result(text, path, "parquet")
    table, present = delimited.read_features(spark, path, ["LA_log", "churn_log"], keep=["hash"])
    return table.select(
        "hash",
        F.unix_seconds("committer_date").alias("committed"),
        *[s.half_even(F.col(c), 6).alias(c) for c in present],
    ).orderBy("committed", "hash")


# --- cleaning ---------------------------------------------------------------------------


@query("coerce_numeric")
def _(spark, d):
    key = F.col("event_id")
    raw = (
        F.when(key % 7 == 0, "n/a").when(key % 11 == 0, "1d").when(key % 13 == 0, " 12.5 ")
        .when(key % 17 == 0, "NaN").otherwise(F.col("value").cast("string"))
    )
    events = roles.table(spark, d, "events").select("event_id", raw.alias("value"))
    return cleaning.coerce_numeric(events, ["value"])


@query("coerce_timestamp")
def _(spark, d):
    stamp = F.concat(F.date_format("committer_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    text = roles.commit_log(spark, d).select(
        "hash", F.when(F.col("hash") % 5 == 0, "soon").otherwise(stamp).alias("at")
    )
    return cleaning.coerce_timestamp(text, "at").select("hash", F.unix_seconds("at").alias("at"))


@query("drop_incomplete")
def _(spark, d):
    table = roles.metric_table(spark, d).select("id", "l_partkey", *METRICS)
    subset = cleaning.drop_incomplete(table, ["l_linenumber"]).select(
        "id", "l_partkey", "l_linenumber", F.lit("subset").alias("rule")
    )
    every = cleaning.drop_incomplete(table).select(
        "id", "l_partkey", "l_linenumber", F.lit("every").alias("rule")
    )
    return subset.unionByName(every)


@query("dedup_keep_first")
def _(spark, d):
    log = roles.commit_log(spark, d).select("author", "committer_date", "hash", "msg", "churn")
    first = cleaning.dedup_keep_first(log, "author", ["committer_date", "hash"])
    return first.select("author", "hash", "msg", "churn")


@query("maturity_filter")
def _(spark, d):
    log = roles.commit_log(spark, d)
    return cleaning.maturity_filter(log, "committer_date", EVENTS_AS_OF).select("hash", "author")


@query("ensure_features")
def _(spark, d):
    table = roles.metric_table(spark, d).select("id", "l_partkey", "l_linenumber")
    return cleaning.ensure_features(table, ["l_linenumber", "absent"])


@query("drop_constant_columns")
def _(spark, d):
    table = roles.metric_table(spark, d)
    cols = [*METRICS, "constant", "empty"]
    return profile.union_all(
        [
            cleaning.constant_columns(table, cols, rule).withColumn("rule", F.lit(rule))
            for rule in ("distinct", "deviation")
        ]
    )


_metric_query(
    "select_columns",
    lambda t: cleaning.select_columns(t, keep=["id", "l_quantity", "nowhere", "p_size"]),
)


@query("clamp_label")
def _(spark, d):
    raw = F.nullif(F.col("l_linenumber"), F.lit(7)) * 0.75 - 1.5
    return roles.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", cleaning.clamp_label(raw).alias("label")
    )


_metric_query(
    "binarize",
    lambda t: cleaning.binarize(
        t.withColumn("shifted", F.col("l_linenumber") - 3), "shifted", "positive"
    ).select("id", "l_partkey", "positive"),
)


@query("message_head")
def _(spark, d):
    return roles.table(spark, d, "documents").select(
        "doc_id", s.message_head(F.col("text")).alias("head")
    )


@query("path_parts")
def _(spark, d):
    raw = F.concat(
        F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.concat("p_brand", F.lit("/"), "p_type", F.lit("/"))),
        F.lit("f"), "p_partkey", F.when(F.col("p_size") % 4 == 0, ".txt").otherwise(".py"),
    )
    path = F.when(F.col("p_partkey") % 3 == 0, F.replace(raw, F.lit("/"), F.lit("\\"))).otherwise(raw)
    parts = roles.table(spark, d, "part").select("p_partkey", path.alias("path"))
    return parts.select(
        "p_partkey",
        s.slashed(F.col("path")).alias("path"),
        s.subsystem(F.col("path")).alias("subsystem"),
        s.directory(F.col("path")).alias("directory"),
        s.is_python(F.col("path")).alias("is_python"),
    )


@query("author_key")
def _(spark, d):
    key = F.col("c_custkey")
    email = F.when(key % 3 == 0, F.concat(F.lit("a"), key, F.lit("@x"))).when(key % 3 == 1, F.lit(""))
    name = F.when(key % 2 == 0, F.col("c_name")).when(key % 5 == 0, F.lit(""))
    return roles.table(spark, d, "customer").select(
        "c_custkey", s.author_key(email, name).alias("author")
    )


@query("fix_flag")
def _(spark, d):
    return roles.table(spark, d, "documents").select(
        "doc_id", s.is_corrective(F.col("text")).cast("int").alias("fix")
    )


_change_query(
    "commit_filter",
    lambda c: cleaning.commit_filter(c).groupBy("repo", "hash").agg(F.count(F.lit(1)).alias("files")),
)


@query("meaningful_line")
def _(spark, d):
    lines = roles.table(spark, d, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(s.is_meaningful_line(F.col("line"))).alias("meaningful"),
    )


# --- row features -----------------------------------------------------------------------


def _sized(spark, d) -> DataFrame:
    """Per-row sizes with negative and missing values."""
    return roles.metric_table(spark, d).select(
        "id", "l_partkey",
        (F.col("l_quantity") - 10).alias("LA"),
        F.col("l_linenumber").alias("LD"),
        (F.col("p_size") - 5).alias("LT"),
    )


@query("churn")
def _(spark, d):
    return features.churn(_sized(spark, d)).select("id", "l_partkey", "churn")


@query("size_ratios")
def _(spark, d):
    table = features.size_ratios(_sized(spark, d))
    return table.select(
        "id", "l_partkey",
        *[s.half_even(F.col(c), 9).alias(c) for c in ("LA_ratio", "LD_ratio")],
    )


@query("log1p_bank")
def _(spark, d):
    table = features.log1p_bank(features.size_ratios(features.churn(_sized(spark, d))))
    logs = [c for c in table.columns if c.endswith("_log")]
    return table.select("id", "l_partkey", *[s.half_even(F.col(c), 9).alias(c) for c in logs])


_metric_query("unpivot_metrics", lambda t: profile.long_values(t, METRICS))


@query("standardize")
def _(spark, d):
    table = roles.metric_table(spark, d).select("id", "l_partkey", "l_returnflag", "l_quantity", "p_size")
    train = table.where(F.col("l_returnflag") == "A")
    out = features.standardize(train, table, ["l_quantity", "p_size"])
    return out.select(
        "id", "l_partkey",
        *[s.half_even(F.col(c), 6).alias(c) for c in ("l_quantity_std", "p_size_std")],
    )


@query("zscore")
def _(spark, d):
    table = roles.metric_table(spark, d).select("id", "l_partkey", "l_linenumber", "constant")
    out = features.zscore(table, ["l_linenumber", "constant"])
    return out.select(
        "id", "l_partkey",
        *[s.half_even(F.col(c), 6).alias(c) for c in ("l_linenumber_z", "constant_z")],
    )


# --- change history ---------------------------------------------------------------------

_change_query("kamei_diffusion", history.diffusion)
_change_query("kamei_size", history.size)
_change_query("kamei_purpose", history.purpose)
QUERIES["kamei_history"] = lambda spark, d: history.history(_stored_changes(spark, d))
QUERIES["kamei_experience"] = lambda spark, d: history.experience(_stored_changes(spark, d), AS_OF)


def _stored_changes(spark, d) -> DataFrame:
    """The change log as a table: several branches read it, each only its columns."""
    return written_once(roles.change_log(spark, d).drop("file_order", "line_id"), "changes")


@query("change_features")
def change_features(spark, d):
    table = history.change_features(_stored_changes(spark, d), AS_OF)
    return table.drop("commit_seq").withColumn("committer_date", F.unix_seconds("committer_date"))


# --- labelling --------------------------------------------------------------------------


def _changes_and_lines(spark, d):
    # The order of files only serves a limit on the files of a change, which no query sets.
    changes = written_once(roles.change_log(spark, d).drop("file_order"), "changes")
    return changes, roles.line_log(changes)


@query("szz_candidates")
def _(spark, d):
    return labels.fix_candidates(*_changes_and_lines(spark, d)).select("repo", "hash", "path")


@query("szz_origin")
def _(spark, d):
    changes, lines = _changes_and_lines(spark, d)
    return labels.line_origins(labels.fix_candidates(changes, lines), lines)


def _labelled_commits(spark, d) -> DataFrame:
    changes, lines = _changes_and_lines(spark, d)
    return labels.label_changes(changes, lines, history.purpose(changes))


QUERIES["szz_label"] = _labelled_commits
QUERIES["szz_report"] = lambda spark, d: labels.labelling_report(_labelled_commits(spark, d))


# --- joins, unions, order ---------------------------------------------------------------


@query("annotate_join")
def _(spark, d):
    table = roles.metric_table(spark, d)
    cols = ["l_quantity", "p_size"]
    long = profile.long_values(table, cols, ["id"])
    return relational.annotate_join(long, profile.outlier_fences(table, cols).select("variable", "iqr"))


@query("aligned_join")
def _(spark, d):
    log = roles.commit_log(spark, d)
    left, right = log.select("hash", "author"), log.select("hash", "churn")
    return relational.aligned_join(left, right, ["hash"])


@query("key_lookup")
def _(spark, d):
    orders = roles.table(spark, d, "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    lines = roles.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return relational.key_lookup(lines, urgent, ["l_orderkey"])


def _labelled_log(spark, d) -> DataFrame:
    return roles.commit_log(spark, d).withColumn("label", (F.col("msg") == "error").cast("int"))


@query("tagged_union")
def _(spark, d):
    log = _labelled_log(spark, d)
    return relational.tagged_union(
        {
            "all": profile.group_balance(log, "repo", "label"),
            "small": profile.group_balance(log.where("churn < 20"), "repo", "label"),
        }
    )


@query("pivot_metric")
def _(spark, d):
    log = roles.commit_log(spark, d)
    kinds = ["click", "error", "purchase", "signup", "view"]
    wide = relational.pivot_metric(log, "repo", "msg", "churn", kinds)
    return wide.select("repo", *[s.half_even(F.col(k), 4).alias(k) for k in kinds])


@query("chrono_sort")
def _(spark, d):
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("long")
    orders = roles.table(spark, d, "orders").select(
        "o_orderkey", (day * F.lit(roles.DAY_SPAN) + F.col("o_orderkey")).alias("seq")
    )
    placed = running_before(orders, [], "seq", {"position": F.lit(1).cast("long")}, unique_order=True,
                            at_most=orders.count())
    return relational.chronological(placed, "seq", ["o_orderkey"]).select("o_orderkey", "position")


@query("top_extremes")
def _(spark, d):
    log = roles.commit_log(spark, d)
    return profile.top_extremes(log, "churn", ["hash", "churn", "author", "repo"], ["hash"])


# --- profiling --------------------------------------------------------------------------

_metric_query("central_tendency", lambda t: profile.central_tendency(t, METRICS))
_metric_query("central_tendency_first_seen", lambda t: profile.central_tendency(
    t.withColumn("place", F.struct("id", "l_partkey", F.col("l_suppkey") % 1000)),
    ["l_quantity", "p_size", "l_tax"], "place"))
_metric_query("skew_class", lambda t: profile.skew_class(t, METRICS))
_metric_query("dispersion", lambda t: profile.dispersion(t, METRICS))
_metric_query("cv_class", lambda t: profile.cv_class(t, METRICS))
_metric_query("percentiles", lambda t: profile.percentiles(t, METRICS))
_metric_query("outlier_fences", lambda t: profile.outlier_fences(t, METRICS))


@query("outlier_fences_skewed")
def _(spark, d):
    return profile.outlier_fences(roles.commit_log(spark, d), ["churn"])


@query("box_summary")
def _(spark, d):
    return profile.box_summary(roles.commit_log(spark, d), ["churn"]).unionByName(
        profile.box_summary(roles.metric_table(spark, d), METRICS)
    )


_metric_query("describe_skew", lambda t: profile.describe_with_skew(t, METRICS))
QUERIES["group_balance"] = lambda spark, d: profile.group_balance(_labelled_log(spark, d), "repo", "label")
QUERIES["overall_balance"] = lambda spark, d: profile.overall_balance(_labelled_log(spark, d), "label")
QUERIES["balance_rollup"] = lambda spark, d: profile.balance_rollup(_labelled_log(spark, d), "repo", "label")
_metric_query("value_frequency", lambda t: profile.value_frequency(t, "l_linenumber"))
_metric_query("histogram", lambda t: profile.histogram(t, [*METRICS, "constant"], 30))
_metric_query("kde_curve", lambda t: profile.kde_curve(t, ["l_quantity", "p_size", "p_retailprice"], 50))
_metric_query("kde_curve_binned", lambda t: profile.kde_curve(
    t, ["l_quantity", "l_extendedprice"], 512, cut=3.0, bandwidth="nrd0", cells=512))
_metric_query("profile_all", lambda t: profile.profile_all(t, [*METRICS, "empty"]))


# --- tests and correlation --------------------------------------------------------------


_metric_query("shapiro_wilk", lambda t: _round(
    normality.shapiro_wilk(t, METRICS), 7, "w", "p"))
_metric_query("ks_normal", lambda t: _round(_round(normality.ks_normal(t, METRICS), 8, "d"), 6, "p"))
_metric_query("ks_statistic", lambda t: normality.ks_statistic(t, METRICS).withColumn(
    "d", s.half_even(F.col("d"), 8)))


@query("lilliefors")
def _(spark, d):
    table = normality.lilliefors(roles.commit_log(spark, d), ["churn"]).unionByName(
        normality.lilliefors(roles.metric_table(spark, d), METRICS)
    )
    return table.select("variable", "n", *[s.half_even(F.col(c), 8).alias(c) for c in ("d", "p")])


_metric_query("normality_table", lambda t: _round(
    normality.normality_table(t, METRICS), 6, "sw_p", "ks_p"))


@query("qq_points")
def _(spark, d):
    points = normality.qq_points(roles.commit_log(spark, d), ["churn"])
    return points.select(
        "i", "value", *[s.half_even(F.col(c), 8).alias(c) for c in ("p", "theoretical")]
    )


@query("qq_line")
def _(spark, d):
    line = normality.qq_line(normality.qq_points(roles.commit_log(spark, d), ["churn"], "hazen"))
    return line.select(
        "variable", "n", *[s.half_even(F.col(c), 6).alias(c) for c in ("slope", "intercept", "r2")]
    )


_metric_query("log1p_effect", lambda t: _round(
    normality.log1p_effect(t, METRICS), 6, "p_before", "p_after"))
_metric_query("pearson_matrix", lambda t: correlation.pearson_matrix(t, METRICS))
_metric_query("pearson_matrix_listwise", lambda t: correlation.pearson_matrix(t, METRICS, "listwise"))
_metric_query("spearman_matrix", lambda t: correlation.spearman_matrix(t, METRICS))
_metric_query("spearman_matrix_pairwise", lambda t: correlation.spearman_matrix(
    t, ["l_quantity", "p_size", "l_linenumber"], "pairwise"))


@query("notable_pairs")
def _(spark, d):
    table = roles.metric_table(spark, d).select(
        "l_quantity", "p_size", "p_retailprice",
        (F.col("l_quantity") + F.col("p_size")).alias("both"),
        (F.col("l_quantity") * 3 - F.col("p_size")).alias("mostly"),
    )
    return correlation.notable_pairs(table, table.columns)


_metric_query("pair_lines", lambda t: correlation.pair_lines(t, PAIRS))
_metric_query("pair_summary", lambda t: correlation.pair_summary(t, PAIRS))


# --- statistical models -----------------------------------------------------------------

TARGET = "l_extendedprice"


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: s.half_even(F.col(c), digits) for c in cols})


_metric_query("ols_summary", lambda t: _round(_round(
    linear_models.ols_summary(t, TARGET, PREDICTORS), 4, "coefficient", "std_error", "t"), 6, "p"))
_metric_query("ols_one_predictor", lambda t: _round(
    linear_models.ols_summary(t, TARGET, ["p_retailprice"]).drop("p"), 4,
    "coefficient", "std_error", "t"))
_metric_query("ols_fit_quality", lambda t: linear_models.ols_fit_quality(t, TARGET, ["p_retailprice"]))
_metric_query("vif", lambda t: _round(linear_models.vif(t, PREDICTORS), 6, "vif"))
_metric_query("vif_with_constant", lambda t: _round(
    linear_models.vif(t, PREDICTORS, constant=True), 6, "vif"))
_metric_query("nested_models", lambda t: linear_models.nested_models(
    t, TARGET, ["l_quantity"], ["p_retailprice"]))
_metric_query("residual_diagnostics", lambda t: _round(
    linear_models.residuals(t, TARGET, ["l_quantity"], ["id", "l_partkey"]), 3, "fitted", "residual"))
_metric_query("residual_histogram", lambda t: _round(profile.histogram(
    linear_models.residuals(t, TARGET, PREDICTORS), ["residual"], 40), 3, "left_edge"))
_metric_query("residual_qq", lambda t: _round(normality.qq_line(normality.qq_points(
    linear_models.residuals(t, TARGET, PREDICTORS), ["residual"])), 4, "slope", "intercept", "r2"))


def _binary(t: DataFrame) -> DataFrame:
    return cleaning.binarize(t.withColumn("over", F.col("l_extendedprice") - 53_000), "over", "high")


_metric_query("logit_summary", lambda t: _round(
    linear_models.logit_summary(_binary(t), "high", PREDICTORS), 6, "coefficient", "std_error", "z", "p"))
_metric_query("odds_ratios", lambda t: linear_models.odds_ratios(_binary(t), "high", PREDICTORS))


# --- learners: the operators' own settings; all rows take part ---------------------------

#: Every tree model with its defaults.
TREE_MODELS = {"boosted": {}, "boosted_leafwise": {}, "forest": {}}


def _stored_labelled(spark, d) -> DataFrame:
    """The text features as a table: splits and fits read it many times, the texts are read once."""
    return written_once(roles.labelled(spark, d), "labelled")


def _holdout(spark, d) -> tuple[DataFrame, DataFrame]:
    marked = splits.stratified_split(_stored_labelled(spark, d), "id", "label")
    return marked.where(~F.col("is_test")), marked.where(F.col("is_test"))


def _trained(spark, d, model) -> DataFrame:
    train, test = _holdout(spark, d)
    return learners.scores(model.fit(train), test, ["id"]).withColumn(
        "score", s.half_even(F.col("score"), 6)
    )


@query("train_logreg")
def _(spark, d):
    return _trained(spark, d, learners.LogisticBaseline(TEXT_FEATURES))


@query("train_rf")
def _(spark, d):
    return _trained(spark, d, learners.TreeClassifier("forest", TEXT_FEATURES))


@query("train_gbt")
def _(spark, d):
    return _trained(spark, d, learners.TreeClassifier("boosted", TEXT_FEATURES))


@query("train_gbt_leaf")
def _(spark, d):
    return _trained(spark, d, learners.TreeClassifier("boosted_leafwise", TEXT_FEATURES))


def _regression_rows(spark, d) -> DataFrame:
    cols = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
    # A line is named by its order and number; number 7 is missing in this role.
    row = F.col("id").cast("long") * 8 + F.coalesce("l_linenumber", F.lit(7.0)).cast("long")
    return cleaning.drop_incomplete(
        roles.metric_table(spark, d).select("id", "l_partkey", row.alias("row"), TARGET, *cols),
        ["id", "l_partkey", TARGET, *cols],
    )


REGRESSORS = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]


def _regression_split(spark, d) -> tuple[DataFrame, DataFrame]:
    """Three quarters of the rows to fit on, the rest to judge on."""
    marked = written_once(splits.random_split(_regression_rows(spark, d), "row", stored=True), "split")
    return marked.where(~F.col("is_test")), marked.where(F.col("is_test"))


def _judged(spark, d, model) -> DataFrame:
    train, test = _regression_split(spark, d)
    return evaluation.regression_metrics(model.fit(train).transform(test), TARGET, "prediction", digits=2)


@query("train_ridge")
def _(spark, d):
    return _judged(spark, d, learners.RidgeRegression(REGRESSORS, TARGET))


@query("ridge_one_predictor")
def _(spark, d):
    rows = _regression_rows(spark, d)
    model = learners.RidgeRegression(["p_retailprice"], TARGET, alpha=1000.0).fit(rows)
    return learners.score_batch(model, rows, ["id", "l_partkey"])


@query("train_rf_regressor")
def _(spark, d):
    return _judged(spark, d, learners.ForestRegression(REGRESSORS, TARGET, "row"))


@query("feature_importance")
def _(spark, d):
    train, _ = _regression_split(spark, d)
    model = learners.ForestRegression.plain(REGRESSORS, TARGET, "row").fit(train)
    return learners.feature_importance(model.model)


@query("feature_split_counts")
def _(spark, d):
    train, _ = _holdout(spark, d)
    model = learners.TreeClassifier("boosted_leafwise", TEXT_FEATURES).fit(train)
    return learners.split_counts(model.model)


@query("top_importance")
def _(spark, d):
    return relational.top_importance(QUERIES["feature_importance"](spark, d))


@query("random_search")
def _(spark, d):
    train, _ = _holdout(spark, d)
    _, _, table = learners.random_search(train, "forest", TEXT_FEATURES, "id")
    return table


@query("score_batch")
def _(spark, d):
    train, test = _regression_split(spark, d)
    model = learners.ForestRegression.plain(REGRESSORS, TARGET, "row").fit(train)
    return learners.score_batch(model, test, ["id", "l_partkey", "row"])


_scored_query("class_weights", lambda t: evaluation.class_weights(t, "label"))


# --- splits and evaluation --------------------------------------------------------------


def _with_micros(t: DataFrame) -> DataFrame:
    return t.withColumn("at", s.micros(F.col("date")))


@query("temporal_split")
def _(spark, d):
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    orders = roles.table(spark, d, "orders").select("o_orderkey", day.alias("day"))
    train, test = splits.temporal_split(orders, "day", "o_orderkey")
    return relational.tagged_union({"train": train, "test": test})


_scored_query("stratified_split", lambda t: splits.stratified_split(t, "id", "label").select(
    "id", "label", "is_test"))
_scored_query("random_split", lambda t: splits.random_split(t, "id").select("id", "is_test"))
_scored_query("stratified_folds", lambda t: splits.stratified_folds(t, "id", "label").select(
    "id", "label", "fold"))


def _predicted(t: DataFrame) -> DataFrame:
    return evaluation.with_prediction(t, "score", 0.1)


_scored_query("confusion_matrix", lambda t: evaluation.confusion_matrix(_predicted(t), "label", "prediction"))
_scored_query("classification_report", lambda t: evaluation.classification_report(
    _predicted(t), "label", "prediction"))
_scored_query("classifier_metrics", lambda t: evaluation.classifier_metrics(
    _predicted(t), "score", "label", "prediction"))
_scored_query("roc_curve", lambda t: _round(evaluation.roc_curve(t, "score", "label"), 9, "fpr", "tpr"))
_scored_query("roc_auc", lambda t: evaluation.roc_auc(t, "score", "label"))
_scored_query("pr_curve", lambda t: _round(evaluation.pr_curve(t, "score", "label"), 9, "precision", "recall"))
_scored_query("average_precision", lambda t: evaluation.average_precision(t, "score", "label"))


@query("regression_metrics")
def _(spark, d):
    table = roles.metric_table(spark, d)
    return evaluation.regression_metrics(table, "l_quantity", "p_size", ["l_returnflag"])


def _threshold_models(t: DataFrame) -> DataFrame:
    """Three simple scorers as stand-ins for models, stacked by name."""
    shown = {"low": 0.01, "mid": 0.05, "high": 0.2}
    return relational.tagged_union(
        {k: evaluation.with_prediction(t, "score", v) for k, v in shown.items()}, "model"
    )


def _by_model(t: DataFrame) -> DataFrame:
    return evaluation.classifier_metrics(_threshold_models(t), "score", "label", "prediction", ["model"])


@query("classifier_metrics_by_model")
def _(spark, d):
    return _by_model(roles.scored(spark, d))


@query("leakage_gap")
def _(spark, d):
    scored = _with_micros(roles.scored(spark, d))
    _, late = splits.temporal_split(scored, "at", "id")
    mixed = splits.random_split(scored, "id").where("is_test").drop("is_test")
    late, mixed = (
        evaluation.threshold_metrics(_threshold_models(t), "label", "prediction", ["model"])
        for t in (late, mixed)
    )
    return evaluation.leakage_gap(late, mixed)


@query("model_comparison")
def _(spark, d):
    marked = splits.stratified_split(_stored_labelled(spark, d), "id", "label")
    return compare_models(
        marked.where(~F.col("is_test")), marked.where(F.col("is_test")), TEXT_FEATURES,
        TREE_MODELS,
    )


QUERIES["build_dataset"] = lambda spark, d: build_dataset(
    *_changes_and_lines(spark, d), AS_OF
).select("repo", "hash", "churn", "is_buggy", *[
    s.half_even(F.col(c), 6).alias(c) for c in ("LA_log", "NDEV_log", "REXP_log", "LD_ratio_log")
])


@query("risk_end_to_end")
def _(spark, d):
    return risk_table(*_changes_and_lines(spark, d), AS_OF, TREE_MODELS)


@query("risk_tuned")
def _(spark, d):
    return risk_study(*_changes_and_lines(spark, d), AS_OF, TREE_MODELS, tune={}).as_one_table()


@query("risk_leakage")
def _(spark, d):
    return risk_study(*_changes_and_lines(spark, d), AS_OF, TREE_MODELS).leakage()


@query("churn_regression")
def _(spark, d):
    data = written_once(build_dataset(*_changes_and_lines(spark, d), AS_OF), "dataset")
    return compare_regressors(data, [c for c in features.MODEL_FEATURES if c in data.columns])


QUERIES["dataset_summary"] = lambda spark, d: dataset_summary(
    build_dataset(*_changes_and_lines(spark, d), AS_OF))
QUERIES["dataset_statistics"] = lambda spark, d: dataset_statistics(
    written_once(build_dataset(*_changes_and_lines(spark, d), AS_OF), "dataset"))


# --- streams ----------------------------------------------------------------------------


@query("stream_ingest")
def _(spark, d):
    schema = roles.table(spark, d, "events").schema
    root = scratch_path(spark, "ingest")
    # Later events first: every second arrival is older than what is stored already.
    cuts = roles.table(spark, d, "events").agg(F.max("event_id").alias("m")).first()["m"]
    for low, high in ((0.6, 1.1), (0.0, 0.3), (0.2, 0.7)):
        here = (F.col("event_id") >= low * cuts) & (F.col("event_id") <= high * cuts)
        roles.table(spark, d, "events").where(here).write.mode("append").parquet(f"{root}/in")
        arriving = stream_ingest.read_stream(spark, f"{root}/in", schema)
        arriving = arriving.withColumn("hash", F.floor(F.col("event_id") / 2)).select("hash")
        stream_ingest.run_deduplicated(arriving, "hash", f"{root}/rows", f"{root}/checkpoint")
    return spark.read.schema("hash long").parquet(f"{root}/rows").select("hash")


@query("stream_history")
def _(spark, d):
    log = roles.commit_log(spark, d).select("repo", "author", "hash")
    root = scratch_path(spark, "running")
    for i in (1, 0, 2):  # every third change at a time, so that most arrive out of order
        log.where(F.col("hash") % 3 == i).write.mode("append").parquet(f"{root}/in")
        stream = stream_ingest.read_stream(spark, f"{root}/in", log.schema)
        stream_history.running_counts(stream, ["repo", "author"], "hash", root)
    return stream_history.current_counts(spark, root, log.schema, ["repo", "author"])
