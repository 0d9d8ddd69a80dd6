"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from callwise.functions import scalars as S
from callwise.operators import features as X
from callwise.operators import forest as FO
from callwise.operators import heavy as HV
from callwise.operators import metrics as M
from callwise.operators import models as MM
from callwise.operators import network as NN
from callwise.operators import newton as N
from callwise.operators import relational as R
from callwise.operators import resampling as RS
from callwise.operators import schema as SC
from callwise.operators import selection as SEL
from callwise.operators import serving as SV
from callwise.operators import span_states as SS
from callwise.operators import splits as SP
from callwise.operators import stats as ST
from callwise.operators import tracking as TR
from callwise.operators import validation as V
from callwise.operators.neighbors import minority_knn
from callwise.plans import flows
from callwise.sources import campaign as C
from callwise.sources import snapshots as SN
from callwise.sources import tables as T
from callwise.sources.staging import fresh_path, local_rows, pin, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def dated(df: DataFrame) -> DataFrame:
    """The date as text, so that results compare by value."""
    return df.withColumn("last_order", S.date_render(F.col("last_order")))


# ---- sources, projections, filters ---------------------------------------------------------------------------


@query
def campaign_base(spark, d):
    return dated(C.campaign_base(spark, d))


@query
def csv_roundtrip(spark, d):
    base = C.campaign_table(spark, d)
    path = fresh_path(spark, "csv")
    T.write_csv(base.withColumn("row_index", F.monotonically_increasing_id()), path)
    written = base.select("*", F.lit(0).cast("bigint").alias("row_index")).schema
    return dated(T.read_csv(spark, path, written, drop=["row_index"]))


@query
def split_table_roundtrip(spark, d):
    rows = SP.three_way_split(C.campaign_table(spark, d), C.KEY, C.LABEL)
    path = fresh_path(spark, "split-table")
    T.write_splits(rows, path)
    return T.read_split(spark, path, "eval").select("id", "segment", "income", "response")


@query
def feature_table_roundtrip(spark, d):
    path = fresh_path(spark, "feature-table")
    T.write_features(C.campaign_features(spark, d), path)
    return rounded(T.read_table(spark, path).select("id", *C.NUMERIC, "response"), *C.NUMERIC)


@query
def feature_allowlist(spark, d):
    return dated(R.feature_allowlist(C.campaign_table(spark, d), ["id"]))


@query
def serving_projection(spark, d):
    return dated(R.serving_projection(C.campaign_table(spark, d), ["id", *C.CATEGORICAL, *C.NUMERIC, "last_order"]))


@query
def split_label(spark, d):
    features, label = R.split_label(C.campaign_table(spark, d), C.KEY, C.LABEL)
    return dated(features.join(label, C.KEY))


@query
def column_routing(spark, d):
    return R.column_routing(C.campaign_table(spark, d), C.KEY, C.NUMERIC, C.CATEGORICAL)


@query
def dropna_any(spark, d):
    return dated(R.dropna_any(C.campaign_table(spark, d)))


@query
def min_value_filter(spark, d):
    return dated(R.min_value_filter(C.campaign_table(spark, d), "n_orders", 2))


@query
def threshold_classify(spark, d):
    return C.campaign_scores(spark, d).select("id", "score", S.threshold_classify(F.col("score")).alias("pred"))


@query
def fit_union(spark, d):
    rows = SP.three_way_split(C.campaign_table(spark, d), C.KEY, C.LABEL)
    parts = [rows.filter(F.col("split") == s) for s in ("train", "eval")]
    return R.fit_union(*parts).groupBy("split").agg(F.count("*").alias("n"), F.sum("n_orders").alias("orders"))


# ---- scalar functions ----------------------------------------------------------------------------------------


@query
def date_render(spark, d):
    return C.campaign_table(spark, d).select("id", S.date_render(F.col("last_order")).alias("value"))


@query
def lenient_timestamp(spark, d):
    """Every third event gets its time as text, the others the text of their properties, which is no time."""
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.col("props"))
    return C.table(spark, d, "events").select("event_id", S.date_render(S.lenient_timestamp(text)).alias("value"))


@query
def days_since(spark, d):
    base = C.campaign_table(spark, d).select("id", S.days_since(F.col("last_order"), "2001-07-01").alias("days"))
    events = C.table(spark, d, "events").select((-1 - F.col("event_id")).alias("id"), S.days_since(F.col("ts"), "2024-02-01 06:00:00").alias("days"))
    return base.unionByName(events).withColumn("days", F.col("days").cast("double"))


@query
def winsorize_expr(spark, d):
    c = S.clamp(F.col("income"), F.lit(1000.0), F.lit(8000.0))
    return C.campaign_table(spark, d).select("id", c.alias("income"))


# ---- splits --------------------------------------------------------------------------------------------------


@query
def stratified_holdout(spark, d):
    return SP.stratified_holdout(C.campaign_table(spark, d), C.KEY, C.LABEL, 0.1).select("id", "response", "is_holdout")


@query
def three_way_split(spark, d):
    return SP.three_way_split(R.dropna_any(C.campaign_table(spark, d)), C.KEY, C.LABEL).select("id", "response", "split")


@query
def serving_emulation(spark, d):
    return dated(SP.serving_emulation(SP.three_way_split(C.campaign_table(spark, d), C.KEY, C.LABEL), C.LABEL))


@query
def stratified_kfold(spark, d):
    docs = C.document_labels(spark, d).select("doc_id", "toxic")
    return SP.stratified_kfold(docs, "doc_id", "toxic")


# ---- feature preparation -------------------------------------------------------------------------------------


@query
def iqr_winsorize(spark, d):
    cols = [*C.NUMERIC, "complain"]
    base = C.campaign_table(spark, d).select("id", *cols)
    return rounded(X.iqr_winsorizer(cols).transform(base), *cols)


@query
def iqr_winsorize_fitted(spark, d):
    """Fences from the rows with response 1, applied to all rows."""
    base = C.campaign_table(spark, d).select("id", *C.NUMERIC, "response")
    fitted = X.iqr_winsorizer(C.NUMERIC, bounds="fitted").fit(base.filter(F.col("response") == 1))
    return rounded(fitted.transform(base), *C.NUMERIC)


@query
def median_impute(spark, d):
    base = C.campaign_table(spark, d).select("id", *C.NUMERIC)
    doubles = S.as_doubles(base, C.NUMERIC)
    return rounded(X.MedianImputer(cols=C.NUMERIC).fit(doubles).transform(doubles), *C.NUMERIC)


@query
def mode_impute(spark, d):
    base = C.campaign_table(spark, d).select("id", *C.CATEGORICAL)
    return X.ModeImputer(cols=C.CATEGORICAL).fit(base).transform(base)


@query
def label_encode(spark, d):
    base = R.dropna_any(C.campaign_table(spark, d).select("id", *C.CATEGORICAL))
    return X.LabelEncoder(cols=C.CATEGORICAL).fit(base).transform(base)


@query
def label_encode_large(spark, d):
    """A category per order: more values than any list of literals should hold."""
    orders = C.table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("code"))
    return X.LabelEncoder(cols=["code"]).fit(orders).transform(orders)


@query
def label_encode_join(spark, d):
    """Numbers as categories, encoded through a dictionary table: 10 sorts after 2."""
    base = C.campaign_table(spark, d).select("id", "n_orders")
    return X.encode_with(base, X.label_dictionary(base, ["n_orders"]), "n_orders")


@query
def label_unseen(spark, d):
    """Values that do not occur among the customers with over 16 orders."""
    base = C.campaign_table(spark, d)
    known = X.label_dictionary(base.filter(F.col("n_orders") > 16), ["nation", "n_orders"])
    return X.unseen_values(base, known, ["nation", "n_orders"])


@query
def fit_apply_pipeline(spark, d):
    """Fit on training and evaluation rows, apply to each split with its own clamping bounds."""
    rows, _ = flows.prepare(C.campaign_table(spark, d), C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL, minimum=("n_orders", 2))
    return rounded(rows, *C.NUMERIC)


@query
def standardize(spark, d):
    base = C.campaign_table(spark, d).select("id", *C.NUMERIC)
    return rounded(X.Standardizer(cols=C.NUMERIC).fit(base).transform(base), *C.NUMERIC)


@query
def anova_f(spark, d):
    base = C.campaign_table(spark, d).withColumns({"separator": F.col("response") * 3, "constant": F.lit(7)})
    campaign = SEL.anova_f(base, [*C.NUMERIC, "separator", "constant"], C.LABEL).withColumn("task", F.lit("response"))
    docs = SEL.anova_f(C.document_labels(spark, d), ["n_chars", "n_words"], "toxic").withColumn("task", F.lit("toxic"))
    return rounded(campaign.unionByName(docs), "f")


@query
def select_k_best(spark, d):
    """A column that separates the classes perfectly comes first."""
    features = C.campaign_features(spark, d).withColumn("separator", F.col("response") * 3.0)
    chosen = SEL.select_k_best(features, C.KEY, [*C.NUMERIC, "separator"], C.LABEL, 4)
    kept = [c for c in chosen.columns if c in (*C.NUMERIC, "separator")]
    return rounded(chosen.unpivot(["id", "response"], kept, "feature", "value"), "value")


# ---- statistics ----------------------------------------------------------------------------------------------


@query
def stats_common(spark, d):
    base = C.campaign_table(spark, d)
    return ST.stats_common(base, ST.features_of(base, ["id"]))


@query
def stats_numeric(spark, d):
    base = C.campaign_table(spark, d)
    campaign = ST.stats_numeric(base, [*C.NUMERIC, "complain", "response"])
    events = ST.stats_numeric(C.table(spark, d, "events"), ["value"])
    return rounded(campaign.unionByName(events), "mean", "std_dev", "min", "max", "median")


@query
def stats_string(spark, d):
    base = C.campaign_table(spark, d).withColumn("last_order", S.date_render(F.col("last_order")))
    campaign = ST.stats_string(base, ["segment", "nation", "last_order"])
    events = ST.stats_string(C.table(spark, d, "events"), ["event_type", "props"])
    return rounded(campaign.unionByName(events), "avg_length")


@query
def stats_by_split(spark, d):
    """One pass over all splits instead of one pass per split."""
    rows = SP.three_way_split(C.campaign_table(spark, d), C.KEY, C.LABEL)
    out = ST.feature_stats(rows.select("split", "segment", "income", "n_orders"), by=["split"])
    return rounded(
        out.select("split", "feature", "type", "num_examples", "num_missing", "mean", "std_dev", "median", F.col("num_unique").cast("double").alias("num_unique"), "top_value"), "mean", "std_dev", "median"
    )


@query
def stats_typed(spark, d):
    """Statistics of an all-text table under the types of its schema."""
    base = C.campaign_table(spark, d).select(*C.NUMERIC, "segment")
    text = base.select([F.col(c).cast("string").alias(c) for c in base.columns])
    typed = ST.cast_to_schema(text, SC.infer_schema(base))
    return ST.stats_common(typed, typed.columns).select("feature", "type", "num_non_missing", "num_missing")


@query
def hist_equal_width(spark, d):
    campaign = ST.hist_equal_width(C.campaign_table(spark, d), [*C.NUMERIC, "complain"])
    events = ST.hist_equal_width(C.table(spark, d, "events"), ["value"])
    return rounded(campaign.unionByName(events), "low", "high")


@query
def hist_quantiles(spark, d):
    campaign = ST.hist_quantiles(C.campaign_table(spark, d), C.NUMERIC)
    events = ST.hist_quantiles(C.table(spark, d, "events"), ["value"])
    return rounded(campaign.unionByName(events), "low", "high")


@query
def top_values(spark, d):
    campaign = ST.top_values(C.campaign_table(spark, d), C.CATEGORICAL, 5)
    events = ST.top_values(C.table(spark, d, "events"), ["event_type", "props"], 5)
    return campaign.unionByName(events)


@query
def heavy_values(spark, d):
    """The most frequent values of columns with many values, from summaries and one exact count of the candidates."""
    lines = HV.heavy_values(C.table(spark, d, "lineitem"), ["l_partkey", "l_orderkey", "l_returnflag"], 5)
    return lines.unionByName(HV.heavy_values(C.table(spark, d, "events"), ["event_type", "props", "user_id"], 5))


@query
def stats_compare(spark, d):
    rows = SP.three_way_split(C.campaign_table(spark, d), C.KEY, C.LABEL)
    cols = ["income", "n_orders", "spend_a", "complain", "response"]
    both = pin(ST.stats_numeric(rows.filter(F.col("split") != "serving"), cols, ["split"]))
    side = lambda s: both.filter(F.col("split") == s).select("feature", "mean", "median", F.col("num_zeros").cast("double").alias("num_zeros"))
    out = ST.compare_stats(side("eval").filter(F.col("feature") != "response"), side("train"), "eval", "train")
    return rounded(out, "eval_mean", "eval_median", "train_mean", "train_median")


# ---- schema and validation -----------------------------------------------------------------------------------


def _constraints(spark, d):
    """Constraints of the rows with a known segment; the label is not expected in SERVING."""
    schema = SC.infer_schema(R.dropna_any(C.campaign_table(spark, d)), ["id"])
    return pin(SC.exclude_from(schema, "response", "SERVING"))


def _faulty(spark, d):
    """A serving table with one fault of each kind."""
    base = C.campaign_table(spark, d)
    odd = F.when(F.col("n_orders") > 14, F.lit("SPACE")).when(F.col("n_orders") < 5, F.lit("AIR")).otherwise(F.col("segment"))
    return base.select(
        "id",
        odd.alias("segment"),
        "nation",
        "income",
        F.col("n_orders").cast("string").alias("n_orders"),
        F.array_repeat("n_urgent", F.col("n_high") % 3 + 1).alias("n_urgent"),
        "n_high",
        "n_low",
        "spend_a",
        "spend_n",
        "last_order",
        F.when(F.col("n_low") > 3, 2).otherwise(F.col("complain")).alias("complain"),
        F.lit(0.5).alias("old_score"),
    )


def _fault_stats(spark, d):
    rows = _faulty(spark, d)
    return pin(ST.profile(rows, ST.features_of(rows, ["id"])))


@query
def infer_schema(spark, d):
    schema = SC.infer_schema(C.campaign_table(spark, d).withColumn("last_order", S.date_render(F.col("last_order"))), ["id"])
    return schema.select("feature", "type", "min_fraction", "min_count", "shape_dim", F.array_join("domain", "|").alias("domain"), "is_bool")


@query
def schema_environments(spark, d):
    return SC.environments_of(_constraints(spark, d))


@query
def schema_roundtrip(spark, d):
    path = fresh_path(spark, "schema")
    SC.write_schema(_constraints(spark, d), path)
    return SC.read_schema(spark, path).select("feature", "type", F.array_join("domain", "|").alias("domain"), F.array_join("not_in_environment", "|").alias("not_in"))


@query
def anomaly_type(spark, d):
    return V.anomaly_type(_fault_stats(spark, d), _constraints(spark, d))


@query
def anomaly_missing_column(spark, d):
    return V.anomaly_missing_column(_fault_stats(spark, d), _constraints(spark, d), "SERVING")


@query
def anomaly_new_column(spark, d):
    return V.anomaly_new_column(_fault_stats(spark, d), _constraints(spark, d))


@query
def anomaly_presence(spark, d):
    return V.anomaly_presence(_fault_stats(spark, d), _constraints(spark, d))


@query
def anomaly_domain(spark, d):
    return V.anomaly_domain(ST.value_counts(_faulty(spark, d), ["segment", "nation"]), _constraints(spark, d))


@query
def anomaly_bool(spark, d):
    return V.anomaly_bool(_fault_stats(spark, d), _constraints(spark, d))


@query
def anomaly_shape(spark, d):
    return V.anomaly_shape(_fault_stats(spark, d), _constraints(spark, d))


@query
def anomaly_report(spark, d):
    return V.validate(_faulty(spark, d), _constraints(spark, d), "SERVING", exclude=["id"]).select("feature", "anomaly_type", "severity", "detail")


@query
def validation_gate(spark, d):
    """Number of anomalies, and whether a run would warn, for a clean and for a faulty table."""
    schema = _constraints(spark, d)
    clean = R.dropna_any(C.campaign_table(spark, d))
    reports = {
        "clean": V.validate(clean, schema, "TRAINING", exclude=["id"]),
        "faulty": V.validate(_faulty(spark, d), schema, "SERVING", exclude=["id"], ignore_columns=["old_score"]),
    }
    rows = []
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, report in reports.items():
            report = stage(report, "report")
            rows.append((name, report.count(), V.gate(report)))
    return local_rows(spark, rows, "data string, anomalies bigint, warns boolean")


@query
def skew_linf(spark, d):
    previous, current = C.event_spans(spark, d)
    return rounded(V.linf_distance(previous, current, ["event_type", "props"]), "distance")


@query
def drift_jsd(spark, d):
    previous, current = C.event_spans(spark, d)
    doubled = current.withColumn("value", F.col("value") * 2)
    return rounded(V.jensen_shannon(previous, doubled, ["value", "user_id"]), "distance")


@query
def skew_drift_report(spark, d):
    """Thresholds turned on: the event types drift, the users do not."""
    previous, current = C.event_spans(spark, d)
    current = current.select("event_type", "user_id", (F.col("value") * 2).alias("value"))
    schema = SC.infer_schema(current)
    for feature in ("event_type", "value", "user_id"):
        schema = SC.with_thresholds(schema, feature, skew=0.1, drift=0.01)
    schema = pin(schema)
    report = V.drift(previous, current, schema).unionByName(V.skew(previous, current, schema))
    return report.select("feature", "anomaly_type", "expected")


VALUE_EDGES = [0.0, 10.0, 25.0, 50.0, 100.0, 200.0]


@query
def span_statistics(spark, d):
    """Days are stored, a day is stored again, and the weeks are merged from what is stored."""
    events = C.table(spark, d, "events")
    path = fresh_path(spark, "moments")
    SS.save_days(SS.day_moments(events, "ts", ["value", "user_id"], ["event_type"]), path)
    again = F.to_date("ts") == F.lit("2024-01-09").cast("date")
    SS.save_days(SS.day_moments(events.filter(again & (F.col("event_type") != "error")), "ts", ["value", "user_id"], ["event_type"]), path)
    days = SS.read_days(spark, path).withColumn("week", F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd"))
    weeks = SS.span_statistics(SS.merge_moments(days, ["week"])).drop("unique_est", "quantiles_est").fillna(0, ["zeros"])
    return rounded(weeks, "mean", "std_dev", "min", "max")


@query
def span_drift(spark, d):
    """Every day against the seven days before it, from the counts kept per day."""
    counts = stage(SS.day_counts(C.table(spark, d, "events"), "ts", {"value": VALUE_EDGES}, ["event_type", "props"]), "counts")
    drift = SS.drift_by_day(counts, ["value"], days=7)
    return rounded(drift.withColumn("day", F.date_format("day", "yyyy-MM-dd")), "distance")


# ---- resampling ----------------------------------------------------------------------------------------------


@query
def knn_minority(spark, d):
    near = minority_knn(C.campaign_features(spark, d), C.KEY, C.NUMERIC, C.LABEL)
    return near.select("id", "neighbor", "rank", F.round(F.sqrt("distance2"), 6).alias("distance"))


@query
def knn_documents(spark, d):
    return minority_knn(C.document_labels(spark, d), "doc_id", ["n_chars", "n_words"], "toxic", k=3)


@query
def smote_rows(spark, d):
    made = RS.synthetic_rows(C.campaign_features(spark, d), C.KEY, C.NUMERIC, C.LABEL)
    return rounded(made, "gap", *C.NUMERIC, digits=4)


@query
def smote(spark, d):
    """Class sizes and column means after balancing."""
    rows = RS.smote(C.campaign_features(spark, d), C.KEY, C.NUMERIC, C.LABEL)
    return rows.groupBy("response").agg(F.count("*").alias("n"), *[F.round(F.avg(c), 3).alias(f"avg_{c}") for c in C.NUMERIC])


@query
def class_weights(spark, d):
    return rounded(RS.class_weights(C.campaign_table(spark, d), C.LABEL).select("id", "response", "weight"), "weight")


@query
def class_weights_many(spark, d):
    """Thousands of classes: the orders of a customer."""
    orders = C.table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 5000).alias("cls"))
    return rounded(RS.class_weights(orders, "cls"), "weight")


@query
def stratified_kfold_text(spark, d):
    """Folds by ids that are texts."""
    docs = C.document_labels(spark, d).select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("doc_id"), "toxic")
    return SP.stratified_kfold(docs, "doc_id", "toxic")


# ---- scores and evaluation -----------------------------------------------------------------------------------


def _predicted(spark, d):
    return C.campaign_scores(spark, d).withColumn("pred", S.threshold_classify(F.col("score")))


@query
def predict_proba(spark, d):
    features = C.campaign_features(spark, d)
    return features.select("id", F.round(S.linear_logistic(C.INTERCEPT, C.WEIGHTS), 6).alias("score"))


@query
def soft_vote(spark, d):
    return rounded(C.campaign_scores(spark, d).select("id", MM.soft_vote(["score", "old_score"]).alias("score")), "score")


@query
def confusion_matrix(spark, d):
    return M.confusion_matrix(_predicted(spark, d))


@query
def classification_report(spark, d):
    return rounded(M.classification_report(_predicted(spark, d)), "precision", "recall", "f1")


@query
def precision_recall_curve(spark, d):
    return rounded(M.precision_recall_curve(C.campaign_scores(spark, d)), "threshold", "precision", "recall")


@query
def best_threshold(spark, d):
    curve = stage(M.precision_recall_curve(C.campaign_scores(spark, d)), "curve")
    out = None
    for name in ("reference", "f1"):
        row = M.best_threshold(curve, name).withColumn("name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return rounded(out, "threshold", "objective")


@query
def roc_curve(spark, d):
    by_score = M.roc_curve(C.campaign_scores(spark, d)).withColumn("ranked_by", F.lit("score"))
    by_label = M.roc_curve(_predicted(spark, d), score="pred").withColumn("ranked_by", F.lit("pred"))
    return rounded(by_score.unionByName(by_label), "threshold", "fpr", "tpr")


@query
def auc_trapezoid(spark, d):
    roc = M.auc(M.roc_curve(C.campaign_scores(spark, d)), "fpr", "tpr").withColumn("curve", F.lit("roc"))
    hard = M.auc(M.roc_curve(_predicted(spark, d), score="pred"), "fpr", "tpr").withColumn("curve", F.lit("roc of labels"))
    curve = M.precision_recall_curve(C.campaign_scores(spark, d)).withColumn("at", F.coalesce(-F.col("threshold"), F.lit(float("-inf"))))
    recall = M.auc(curve, "recall", "precision", order="at").withColumn("curve", F.lit("precision-recall"))
    return rounded(roc.unionByName(hard).unionByName(recall), "auc")


@query
def point_metrics(spark, d):
    return rounded(M.point_metrics(_predicted(spark, d)), "precision", "recall", "accuracy")


# ---- serving and tracking ------------------------------------------------------------------------------------


def _scores(spark, d):
    """The new version scored the customers with over 5 orders, the old one those with a low-priority order."""
    scored = C.campaign_scores(spark, d)
    new = SV.as_scores(scored.filter(F.col("n_orders") > 5), "v0.0.2")
    return new.unionByName(SV.as_scores(scored.filter(F.col("n_low") > 0), "v0.0.1", score="old_score"))


def _outcomes(spark, d):
    return C.campaign_table(spark, d).filter(F.col("n_urgent") > 2).select("id", F.col("response").alias("result"))


@query
def attach_scores(spark, d):
    base = C.campaign_table(spark, d).select("id", "segment")
    return SV.attach_scores(base, _scores(spark, d), "v0.0.2", "success_rate")


@query
def champion_challenger(spark, d):
    return rounded(SV.champion_challenger(_scores(spark, d), "v0.0.1", "v0.0.2"), "change")


@query
def outcome_metrics(spark, d):
    return rounded(SV.outcome_metrics(_scores(spark, d), _outcomes(spark, d)), "precision", "recall", "accuracy")


def _judged(spark, d):
    """Scores of both versions with the response and a fold."""
    labels = C.campaign_scores(spark, d).select("id", "label")
    return _scores(spark, d).join(labels, "id").withColumn("fold", (F.col("id") % 5).cast("int"))


@query
def version_curves(spark, d):
    """The curve of every version on every fold, all in one job."""
    curves = M.curves_by(_judged(spark, d), ["version", "fold"])
    points = curves.select("version", "fold", "threshold", "tp", "fp", "precision", "recall", "fpr", "tpr")
    return rounded(points, "threshold", "precision", "recall", "fpr", "tpr")


@query
def version_areas(spark, d):
    """Areas and best F1 threshold of every version on every fold."""
    curves = stage(M.curves_by(_judged(spark, d), ["version", "fold"]), "curves")
    areas = M.areas_by(curves, ["version", "fold"])
    best = M.best_threshold(curves, "f1", by=["version", "fold"])
    return rounded(areas.join(best, ["version", "fold"]), "roc_auc", "pr_auc", "threshold", "objective")


@query
def call_list(spark, d):
    return SV.call_list(_scores(spark, d), _outcomes(spark, d), "v0.0.2", 100)


@query
def score_upsert(spark, d):
    """Two versions are written, one of them again with other scores; the customers then carry both columns, and the
    wide table replaces itself."""
    path, wide = fresh_path(spark, "scores"), fresh_path(spark, "customers")
    scores = _scores(spark, d)
    T.write_scores(scores, path)
    T.write_scores(scores.filter(F.col("version") == "v0.0.1").withColumn("score", F.round(F.col("score") / 2, 6)), path)
    C.campaign_table(spark, d).select("id", "nation").write.parquet(wide)
    columns = {"v0.0.1": "old_rate", "v0.0.2": "new_rate"}
    T.overwrite_with_column(spark, SV.attach_versions(T.read_table(spark, wide), T.read_scores(spark, path), columns), wide)
    return T.read_table(spark, wide)


@query
def snapshot_upsert(spark, d):
    """As ``score_upsert``, but the wide table is replaced by published versions, one column after the other."""
    wide = fresh_path(spark, "snapshots")
    scores = _scores(spark, d)
    halved = scores.withColumn("score", F.when(F.col("version") == "v0.0.1", F.round(F.col("score") / 2, 6)).otherwise(F.col("score")))
    SN.commit(C.campaign_table(spark, d).select("id", "nation"), wide)
    for version, column in (("v0.0.1", "old_rate"), ("v0.0.2", "new_rate")):
        SN.change(spark, wide, lambda t, version=version, column=column: SV.attach_scores(t, halved, version, column))
    return SN.read_version(spark, wide)


@query
def daily_scores(spark, d):
    """Two days are written, the first one again with other scores: history stays, the latest score of each customer counts."""
    path = fresh_path(spark, "daily")
    scores = _scores(spark, d)
    T.write_daily_scores(scores, "2024-03-01", path)
    T.write_daily_scores(scores.filter(F.col("id") % 2 == 0).withColumn("score", F.round(F.col("score") / 4, 6)), "2024-03-02", path)
    T.write_daily_scores(scores.withColumn("score", F.round(F.col("score") / 2, 6)), "2024-03-01", path)
    latest = SV.latest_scores(T.read_scores(spark, path, T.DAILY_SCHEMA))
    return latest.withColumn("scored_on", S.date_render(F.col("scored_on")))


@query
def outcomes_latest(spark, d):
    """Some customers are called twice; their last outcome counts, once."""
    path = fresh_path(spark, "outcomes")
    first = _outcomes(spark, d)
    T.write_outcomes(first, "2024-03-01", path)
    T.write_outcomes(first.filter(F.col("id") % 3 == 0).withColumn("result", 1 - F.col("result")), "2024-03-02", path)
    return rounded(SV.outcome_metrics(_scores(spark, d), SV.latest_outcomes(T.read_outcomes(spark, path))), "precision", "recall", "accuracy")


def _runs(spark, d):
    scored = C.campaign_scores(spark, d)
    runs = None
    for name, column, threshold in (("new", "score", 0.53), ("new-low", "score", 0.3), ("old", "old_score", 0.53)):
        pred = scored.withColumn("pred", S.threshold_classify(F.col(column), threshold))
        run = TR.run_rows(rounded(M.point_metrics(pred), "precision", "recall", "accuracy"), name, {"threshold": threshold, "n": 8})
        runs = run if runs is None else runs.unionByName(run)
    return runs


@query
def log_run(spark, d):
    path = fresh_path(spark, "runs")
    TR.log_run(_runs(spark, d), path)
    TR.log_run(TR.run_row(spark, "manual", {"n": 18}, {"validation_recall": 0.5}, "models/v0"), path)
    runs = TR.read_runs(spark, path)
    return runs.select(
        "run_name",
        F.map_keys("params").getItem(0).alias("first_param"),
        F.try_element_at("params", F.lit("n")).alias("n"),
        F.try_element_at("metrics", F.lit("validation_recall")).alias("recall"),
        "model_path",
    )


@query
def leaderboard(spark, d):
    return TR.leaderboard(_runs(spark, d))


@query
def holdout_report(spark, d):
    """The flagship: complete rows, split, features, fixed coefficients, decision, report per split."""
    rows, _ = flows.prepare(C.campaign_table(spark, d), C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL, minimum=("n_orders", 2))
    scored = rows.select("split", F.col("response").alias("label"), S.threshold_classify(F.round(S.linear_logistic(C.INTERCEPT, C.WEIGHTS), 6)).alias("pred"))
    return rounded(M.classification_report(scored, by=["split"]), "precision", "recall", "f1")


# ---- training ------------------------------------------------------------------------------------------------


def _prepared(spark, d):
    return C._once(spark, d, "prepared", lambda: flows.prepare(C.campaign_table(spark, d), C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL)[0])


def _probability(c: str):
    return F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False)).alias("scored")


def _logistic(spark, d):
    train = _prepared(spark, d).filter(F.col("split") == "train")
    return RS.Smoted(inner=N.NewtonLogistic(), key=C.KEY, cols=C.FEATURES, label=C.LABEL).fit(train)


@query
def logistic_fit(spark, d):
    """Coefficients, each times the root mean square of its feature."""
    model = _logistic(spark, d)
    train = _prepared(spark, d).filter(F.col("split") == "train")
    sizes = train.agg(*[F.sqrt(F.avg(F.col(c) * F.col(c))).alias(c) for c in C.FEATURES])
    effects = [F.struct(F.lit(c).alias("feature"), (F.col(c) * w).alias("effect")) for c, w in zip(C.FEATURES, model.getOrDefault("coefficients"), strict=True)]
    effects.append(F.struct(F.lit("intercept").alias("feature"), F.lit(model.getOrDefault("intercept")).alias("effect")))
    return rounded(sizes.select(F.inline(F.array(*effects))), "effect")


@query
def logistic_scores(spark, d):
    rows = _prepared(spark, d).filter(F.col("split") == "eval")
    scored = MM.positive_probability(_logistic(spark, d), MM.assemble(rows, C.FEATURES))
    return rounded(scored.select("id", "response", "score"), "score")


@query
def random_forest_fit(spark, d):
    """What each of 100 trees drew, its first cut, and the rows that have come to its leaves."""
    train = _prepared(spark, d).filter(F.col("split") == "train")
    rows = FO.forest_rows(RS.smote_keyed(train, C.KEY, C.FEATURES, C.LABEL), C.KEY, C.FEATURES, C.LABEL)
    nodes = FO.grow(stage(rows, "forest-rows"), 100)
    leaves = nodes.filter("left < 0").groupBy("tree").agg(F.sum("n").alias("in_leaves"), F.sum(F.round(F.col("n") * F.col("p"))).cast("bigint").alias("positive"))
    name = F.element_at(F.array(*map(F.lit, C.FEATURES)), F.col("feature") + 1)
    return rounded(nodes.filter("node = 0").join(leaves, "tree").select("tree", "n", "in_leaves", "positive", name.alias("feature"), "threshold"), "threshold", digits=4)


@query
def forest_search(spark, d):
    """48 settings on ten folds: mean accuracy. Trained trees are not SQL; the tests compare them with plain ones."""
    train = _prepared(spark, d).filter(F.col("split") == "train")
    folded = stage(SP.stratified_kfold(train, C.KEY, C.LABEL, 10), "folds")
    rows = RS.smote_keyed(folded, C.KEY, C.FEATURES, C.LABEL, fold="fold", folds=list(range(10)))
    runs = FO.forest_search(stage(FO.forest_rows(rows, C.KEY, C.FEATURES, C.LABEL, "fold"), "forest-rows"), list(range(10)))
    table = local_rows(spark, [(r.deepest, r.trees, r.subset, r.fold, r.accuracy) for r in runs], "deepest int, trees int, subset string, fold int, accuracy double")
    return rounded(table.groupBy("deepest", "trees", "subset").agg(F.avg("accuracy").alias("accuracy")), "accuracy")


@query
def mlp_fit(spark, d):
    """A hundred rectified units, Adam, 300 epochs at most; SQL checks which rows are scored."""
    rows = _prepared(spark, d)
    train = FO.forest_rows(RS.smote_keyed(rows.filter(F.col("split") == "train"), C.KEY, C.FEATURES, C.LABEL), C.KEY, C.FEATURES, C.LABEL)
    (network,) = NN.train(stage(train, "network-rows"), [NN.Setting()])
    scored = NN.with_score(rows.filter(F.col("split") == "eval"), F.array(*[F.col(c).cast("double") for c in C.FEATURES]), network)
    return scored.select("id", "response", _probability("score"))


@query
def fold_features(spark, d):
    """F of every feature with each of ten folds left out, and the five best."""
    train = _prepared(spark, d).filter(F.col("split") == "train")
    folded = stage(SP.stratified_kfold(train, C.KEY, C.LABEL, 10), "folds")
    chosen = SEL.fold_choices(folded, C.FEATURES, C.LABEL, "fold", 5)
    picks = local_rows(spark, [(f, c) for f, cs in chosen.items() for c in cs], "left_out int, feature string").withColumn("chosen", F.lit(True))
    scores = SEL.fold_anova_f(folded, C.FEATURES, C.LABEL, "fold").withColumn("left_out", F.col("left_out").cast("int"))
    return rounded(scores.join(picks, ["left_out", "feature"], "left").select("left_out", "feature", "f", F.coalesce("chosen", F.lit(False)).alias("chosen")), "f")


def _grid_runs(spark, d):
    """All settings on all ten folds: one search serves both queries."""

    def build():
        train = _prepared(spark, d).filter(F.col("split") == "train")
        folded = stage(SP.stratified_kfold(train, C.KEY, C.LABEL, 10), "folds")
        found = N.logistic_search(folded, C.KEY, C.FEATURES, C.LABEL, "fold")
        rows = [(m.fit.C, m.fit.max_iter, m.fit.fold, a, m.fit.C == found.best.fit.C and m.fit.max_iter == found.best.fit.max_iter) for m, a in found.runs]
        return local_rows(spark, rows, "c double, max_iter int, fold int, accuracy double, chosen boolean")

    return C._once(spark, d, "grid", build)


@query
def grid_runs(spark, d):
    return rounded(_grid_runs(spark, d).drop("chosen"), "accuracy")


@query
def grid_search(spark, d):
    """Mean accuracy of each setting over its folds; the best one is fitted again on all rows."""
    return rounded(_grid_runs(spark, d).groupBy("c", "max_iter", "chosen").agg(F.avg("accuracy").alias("accuracy")), "accuracy")


@query
def feature_ablation(spark, d):
    runs = flows.feature_ablation(_prepared(spark, d), C.KEY, C.FEATURES, C.LABEL, [5, 10, len(C.FEATURES)])
    measures = [F.round(F.element_at("metrics", f"validation_{m}"), 6).alias(m) for m in ("precision", "recall", "accuracy")]
    return runs.select("run_name", F.element_at("params", "n").alias("n"), *measures)


@query
def batch_score(spark, d):
    """Score the serving split with a saved model, store the scores and attach them to the customers."""
    rows = _prepared(spark, d)
    model = flows.train_ensemble(rows.filter(F.col("split") == "train"), C.KEY, C.FEATURES, C.LABEL)
    root, path = fresh_path(spark, "models"), fresh_path(spark, "scores")
    MM.save_version(model, root, "v0.0.2")
    serving = rows.filter(F.col("split") == "serving").drop("response")
    T.write_scores(flows.batch_score(serving, MM.load_version(spark, root, "v0.0.2"), "v0.0.2"), path)
    customers = C.campaign_table(spark, d).select("id", "nation")
    return SV.attach_scores(customers, T.read_scores(spark, path), "v0.0.2", "rate").select("id", "nation", _probability("rate"))


@query
def saved_pipeline(spark, d):
    """Fit the feature pipeline, save it, load it and apply it: the rows are those of the fitted one."""
    rows, fitted = flows.prepare(C.campaign_table(spark, d), C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL, minimum=("n_orders", 2))
    path = fresh_path(spark, "pipeline")
    fitted.write().save(path)
    base = SP.three_way_split(R.dropna_any(C.campaign_table(spark, d)), C.KEY, C.LABEL)
    kept = base.filter((F.col("split") == "serving") | (F.col("n_orders") > 2))
    again = PipelineModel.load(path).transform(kept)
    return rounded(again.select(rows.columns), *C.NUMERIC)


@query
def daily_run(spark, d):
    """The daily flow on the serving split: check, prepare, score with a saved model, store and attach the scores."""
    rows, fitted = flows.prepare(C.campaign_table(spark, d), C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL)
    root, path = fresh_path(spark, "models"), fresh_path(spark, "scores")
    train = rows.filter(F.col("split") == "train")
    member = RS.Smoted(inner=N.NewtonLogistic(), key=C.KEY, cols=C.FEATURES, label=C.LABEL).fit(train)
    MM.save_version(MM.voting_model({"lr": member}, C.FEATURES), root, "v0.0.2")
    split = SP.three_way_split(R.dropna_any(C.campaign_table(spark, d)), C.KEY, C.LABEL)
    schema = stage(SC.infer_schema(split.filter(F.col("split") == "train").drop("split", "response", "id")), "schema")
    customers = SP.serving_emulation(split, C.LABEL)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        scored = flows.daily_run(spark, customers, schema, fitted, root, path, "v0.0.2", "rate", ignore_columns=["last_order"])
    return rounded(scored.select("id", "rate"), "rate")
