"""The tree fit depends on the rows, not on the cores; prefix models equal shorter fits."""

import json
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.config import TreeParams
from demand_engine.operators.ml import VEC, BoostedTreesForecaster, feature_vector, prefix_model

SCRIPT = """
import json, sys
from pyspark.sql import functions as F
from demand_engine.config import TreeParams
from demand_engine.operators.ml import BoostedTreesForecaster
from demand_engine.session import get_spark
spark = get_spark(sys.argv[1], shuffle_partitions=4)
n = F.col("id")
df = spark.range(52_000).select(
    (n % 400).alias("Store"), F.date_add(F.lit("2020-01-06").cast("date"), ((n / 400).cast("int") * 7)).alias("Date"),
    F.lit(False).alias("IsHoliday"), F.lit("A").alias("Type"), F.lit(10).cast("long").alias("Size"),
    ((F.xxhash64(n) % 100_003) / 1000.0).alias("sales_lag_1"), ((F.xxhash64(n, F.lit(1)) % 100_003) / 1000.0).alias("sales_lag_2"))
df = df.withColumn("Weekly_Sales", 1000 + 5 * F.col("sales_lag_1") - F.col("sales_lag_2") * F.col("sales_lag_1") / 20)
m = BoostedTreesForecaster(TreeParams(max_iter=6, step_size=0.3, early_stopping_rounds=4), features=["sales_lag_1", "sales_lag_2", "Store"]).fit(df)
print("RESULT", json.dumps([m.n_trees, m.validation_losses]))
"""


def test_trees_do_not_depend_on_the_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root}
    found = []
    for master in ("local[2]", "local[4]", "local[8]"):
        out = subprocess.run([sys.executable, "-c", SCRIPT, master], env=env, capture_output=True, text=True, timeout=600, cwd=root)
        assert out.returncode == 0, out.stderr[-2000:]
        found.append(json.loads(out.stdout.split("RESULT ")[1]))
    assert found[0][0] == found[1][0] == found[2][0]
    np.testing.assert_allclose(found[0][1], found[1][1], rtol=1e-6)
    np.testing.assert_allclose(found[0][1], found[2][1], rtol=1e-6)


def test_prefix_model_equals_a_shorter_fit(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(100 * a + 10 * b * a)) for a, b in rng.normal(size=(400, 2))]
    df = spark.createDataFrame(rows, "sales_lag_1 double, sales_lag_2 double, Weekly_Sales double")
    cols = ["sales_lag_1", "sales_lag_2"]
    data = df.select(feature_vector(cols).alias(VEC), "Weekly_Sales").coalesce(1).cache()
    f = BoostedTreesForecaster(TreeParams(max_iter=8, step_size=0.3, min_instances_per_node=5), features=cols)
    short, cut = f._estimator(3).fit(data), prefix_model(f._estimator(8).fit(data), 3)
    assert cut.getNumTrees == 3
    a, b = (m.transform(data).agg(F.sum("_raw_prediction")).first()[0] for m in (short, cut))
    assert a == pytest.approx(b, rel=1e-9)
    np.testing.assert_allclose(short.featureImportances.toArray(), cut.featureImportances.toArray(), rtol=1e-9)
