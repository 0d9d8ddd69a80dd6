import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from callwise.operators import features as X
from callwise.operators import relational as R
from callwise.operators import selection as SEL
from callwise.operators.stats import value_counts


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, 1.0, 5, "b", 10, "train"),
        (2, 2.0, 5, "a", 2, "train"),
        (3, 3.0, 5, "b", 2, "train"),
        (4, 4.0, 5, None, 10, "train"),
        (5, 100.0, 9, "a", None, "train"),
        (6, None, 5, "c", 2, "eval"),
        (7, float("nan"), None, "c", 2, "eval"),
        (8, 3.0, 5, "a", 10, "eval"),
    ]
    return spark.createDataFrame(rows, "id long, x double, k int, s string, n int, split string")


def column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_batch_fences_come_from_the_batch(people):
    train = people.filter("split = 'train'")
    out = X.iqr_winsorizer(["x", "k"]).transform(train)
    assert column(out, "x") == [1.0, 2.0, 3.0, 4.0, 7.0]  # quartiles 2 and 4
    assert column(out, "k") == [5.0] * 5  # interquartile range 0 collapses the column


def test_fitted_fences_are_frozen(people):
    train = people.filter("split = 'train'")
    model = X.iqr_winsorizer(["x"], bounds="fitted").fit(train)
    assert column(model.transform(people), "x") == [1.0, 2.0, 3.0, 4.0, 7.0, None, None, 3.0]


def test_grouped_fences_equal_one_batch_at_a_time(people):
    both = X.iqr_winsorizer(["x", "k"], group="split").transform(people).orderBy("id").select("id", "x", "k").collect()
    one = [X.iqr_winsorizer(["x", "k"]).transform(people.filter(F.col("split") == s)) for s in ("train", "eval")]
    assert both == R.fit_union(*one).orderBy("id").select("id", "x", "k").collect()


def test_median_counts_nan_as_missing_and_may_be_fractional(spark, people):
    model = X.MedianImputer(cols=["x"]).fit(people)
    assert column(model.transform(people), "x")[5:7] == [3.0, 3.0]
    whole = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id long, k int")
    assert column(X.MedianImputer(cols=["k"]).fit(whole).transform(whole), "k") == [1.0, 2.0, 1.5]


def test_mode_tie_goes_to_the_smallest(people):
    model = X.ModeImputer(cols=["s", "n"]).fit(people.filter("id < 5"))
    assert model.values() == {"s": "b", "n": 2.0}
    assert column(model.transform(people), "s")[3] == "b"
    assert column(model.transform(people), "n")[4] == 2


def test_codes_follow_the_type_order(people):
    rows = people.na.drop(subset=["s", "n"])
    model = X.LabelEncoder(cols=["s", "n"]).fit(rows)
    codes = {(r["feature"], r["code"]): r["value"] for r in model.dictionary(rows.sparkSession).collect()}
    assert codes == {("s", 0): "a", ("s", 1): "b", ("s", 2): "c", ("n", 0): "2", ("n", 1): "10"}
    assert column(model.transform(rows), "n") == [1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    joined = X.encode_with(rows, X.label_dictionary(rows, ["n"]), "n")
    assert column(joined, "n") == column(model.transform(rows), "n")


def test_dictionary_in_ranges(spark):
    words = [f"{w}{i}" for i in range(150) for w in ("http://", "Z'", "é", "a")]
    df = spark.createDataFrame([(w, float(i % 97) - 50) for i, w in enumerate(words)] + [(None, None)], "s string, n double")
    for partitions in (1, 16):
        got = {(r["feature"], r["value"]): r["code"] for r in X.label_dictionary(df, ["s", "n"], partitions).collect()}
        assert got == {("s", w): i for i, w in enumerate(sorted(words))} | {("n", str(float(v) - 50)): v for v in range(97)}


def test_unseen_category(people):
    fit_on, later = people.filter("s = 'a' OR s = 'b'"), people.filter("s = 'c'")
    with pytest.raises(Exception, match="unseen value in s: c"):
        X.LabelEncoder(cols=["s"]).fit(fit_on).transform(later).collect()
    assert column(X.LabelEncoder(cols=["s"], unseen="code").fit(fit_on).transform(later), "s") == [-1.0, -1.0]
    unseen = X.unseen_values(people, X.label_dictionary(fit_on, ["s"]), ["s"])
    assert [tuple(r) for r in unseen.collect()] == [("s", "c", 2)]


def test_dictionaries_have_no_limit(spark):
    rows = spark.range(30_000).select((F.col("id") * 7 % 30_000).alias("id"))
    out = X.LabelEncoder(cols=["id"]).fit(rows).transform(rows.withColumn("same", F.col("id")))
    assert out.filter("id <> same").count() == 0 and out.count() == 30_000



def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, 4.0)], "id long, x double, c double")
    out = X.Standardizer(cols=["x", "c"]).fit(df).transform(df)
    assert column(out, "x") == [-1.0, 1.0] and column(out, "c") == [0.0, 0.0]


def test_pipeline_equals_its_steps_and_survives_saving(people, tmp_path):
    fitted = X.feature_pipeline("id", ["x", "k"], ["s", "n"], keep=["split"], group="split").fit(people)
    out = fitted.transform(people)
    assert out.columns == ["id", "x", "k", "s", "n", "split"]
    clamped = X.iqr_winsorizer(["x", "k"], group="split").transform(people)
    steps = X.MedianImputer(cols=["x", "k"]).fit(X.iqr_winsorizer(["x", "k"]).transform(people)).transform(clamped)
    steps = X.ModeImputer(cols=["s", "n"]).fit(people).transform(steps)
    steps = X.LabelEncoder(cols=["s", "n"]).fit(steps).transform(steps)
    for c in ("x", "k", "s", "n"):
        assert column(out, c) == [float(v) for v in column(steps, c)]
    fitted.write().save(str(tmp_path / "pipeline"))
    again = PipelineModel.load(str(tmp_path / "pipeline"))
    assert again.transform(people).orderBy("id").collect() == out.orderBy("id").collect()


def test_fitted_pipeline_is_one_narrow_projection(people):
    fitted = X.feature_pipeline("id", ["x", "k"], ["s", "n"], bounds="fitted").fit(people)
    plan = fitted.transform(people)._jdf.queryExecution().executedPlan().toString()
    # two small dictionaries are broadcast; the table itself stays where it is
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_dropna_counts_nan(people):
    assert column(R.dropna_any(people), "id") == [1, 2, 3, 8]


def test_anova_by_hand(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 1.0), (2, 0, 3.0, 5.0), (3, 1, 5.0, 1.0), (4, 1, 7.0, 5.0)], "id long, y int, a double, b double")
    f = {r["feature"]: r["f"] for r in SEL.anova_f(df, ["a", "b"], "y").collect()}
    assert f == {"a": 8.0, "b": 0.0}
    assert SEL.best_features(df, ["b", "a"], "y", 1) == ["a"]
    assert SEL.select_k_best(df, "id", ["b", "a"], "y", 2).columns == ["id", "b", "a", "y"]


def test_anova_keeps_digits_of_large_values(spark):
    base = 1e9
    df = spark.createDataFrame([(0, base + 1), (0, base + 3), (1, base + 5), (1, base + 7)], "y int, a double")
    assert SEL.anova_f(df, ["a"], "y").collect()[0]["f"] == pytest.approx(8.0, rel=1e-6)


def test_value_counts_skips_missing(people):
    got = {(r["feature"], r["value"]): r["n"] for r in value_counts(people, ["s", "x"]).collect()}
    assert got[("s", "a")] == 3 and got[("x", "3.0")] == 2 and not any(k[1] in (None, "NaN") for k in got)
