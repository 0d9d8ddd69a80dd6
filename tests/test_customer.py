import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from callwise.functions.scalars import date_render
from callwise.operators import relational as R
from callwise.operators import schema as SC
from callwise.operators import validation as V
from callwise.plans import flows
from callwise.sources import customer as CU


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        row = {c: rng.randrange(60) for c in CU.SERVING_COLUMNS}
        row |= {
            "Id": 1000 + 7 * i,
            "Year_Birth": 1893 if i % 40 == 0 else 1940 + rng.randrange(55),
            "Education": CU.DOMAINS["Education"][i % 5],
            "Marital_Status": CU.DOMAINS["Marital_Status"][i % 8],
            "Income": None if i % 30 == 7 else 20000.0 + 500 * rng.randrange(100),
            "Dt_Customer": date(2012, 1, 8) + timedelta(days=3 * i),
            "Complain": int(i % 24 == 0),
        }
        rows.append(tuple(row[c] for c in CU.SERVING_COLUMNS) + (int(i % 7 == 0),))
    return spark.createDataFrame(rows, CU.table_schema(labelled=True))


def rendered(df):
    return df.withColumn(CU.DATE, date_render(F.col(CU.DATE)))


def test_frozen_constraints_equal_inferred_ones(spark, history):
    inferred = SC.exclude_from(SC.infer_schema(rendered(R.dropna_any(history)), [CU.KEY]), CU.LABEL, "SERVING")
    assert CU.constraints(spark).orderBy("feature").collect() == inferred.orderBy("feature").collect()
    assert CU.constraints(spark).count() == 21 and len(CU.FEATURES) == 18


def test_serving_batch_meets_the_constraints(spark, history):
    batch = R.serving_projection(rendered(R.dropna_any(history)), CU.SERVING_COLUMNS)
    assert V.validate(batch, CU.constraints(spark), "SERVING", exclude=[CU.KEY]).count() == 0
    odd = batch.withColumn("Education", F.lit("Diploma"))
    report = V.validate(odd, CU.constraints(spark), "SERVING", exclude=[CU.KEY]).collect()
    assert [(r["feature"], r["observed"]) for r in report] == [("Education", f"1 values in {batch.count()} rows")]


def test_features_of_the_customer_table(history):
    features, fitted = flows.prepare(history, CU.KEY, CU.LABEL, CU.NUMERIC, CU.CATEGORICAL, minimum=CU.MINIMUM)
    assert features.columns == [CU.KEY, *CU.FEATURES, CU.LABEL, "split"]
    complete = R.dropna_any(history)
    assert features.filter("split = 'serving'").count() == -(-complete.count() // 10)
    # nulls in a later batch are filled and its rows are all kept
    batch = fitted.transform(history.select(*CU.SERVING_COLUMNS))
    assert batch.count() == 240 and batch.columns == [CU.KEY, *CU.FEATURES]
    assert R.dropna_any(batch).count() == 240
