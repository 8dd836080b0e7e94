import os
import tempfile

from tabreg.operators import models as M
from tabreg.operators import prep as R
from tabreg.plans.data import PRIORITY_ORDER, orders_customers
from tabreg.streaming import score, score_stream_to_table

from conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    df = orders_customers(spark, SF_SMALL)
    train, test = R.train_test_split(df, "o_orderkey", 0.2)
    spec = R.FeatureSpec(numerical=("c_acctbal",), nominal=("o_orderstatus",),
                         ordinal={"o_orderpriority": PRIORITY_ORDER})
    pipe = R.FeaturePipeline(spec, key=("o_orderkey",), label="o_totalprice").fit(train)
    model = M.fit(M.linear_regression(), pipe.transform(train, assemble_vector=True))
    base = tempfile.mkdtemp(prefix="tabreg-stream-")
    src = os.path.join(base, "in")
    test.write.parquet(src)
    stream = spark.readStream.schema(test.schema).parquet(src)
    q = score_stream_to_table(stream, pipe, model, os.path.join(base, "out"),
                              os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    got = {r.o_orderkey: r.prediction for r in
           spark.read.parquet(os.path.join(base, "out")).select("o_orderkey", "prediction").collect()}
    exp = {r.o_orderkey: r.prediction for r in score(test, pipe, model).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-6 for k in exp)
