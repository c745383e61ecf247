"""The pipeline's finding of round 4: what a stage's plans ask of the driver."""

from pyspark.sql import functions as F

from lodestone.llm import quality


def test_factors_of_all_starts_in_few_projections(spark):
    """Both starts' factors come in one projection a column and one for its square root; the factor times its transpose is the covariance plus floors."""
    s = {(i, j): (2.0 + i if i == j else 0.1 * (i + j)) for i, j in quality.PAIRS}
    one = spark.range(1).select(*[F.lit(v * k).alias(f"{n}_s{i}{j}") for n, k in (("m", 1.0), ("c", 3.0)) for (i, j), v in s.items()])
    out = quality.factor(one, *quality.STARTS)
    assert out._jdf.queryExecution().analyzed().toString().count("Project") <= 2 * quality.P + 1
    r = out.head()
    for n, k in (("m", 1.0), ("c", 3.0)):
        for (i, j), v in s.items():
            want = v * k + (quality.FLOORS[i] ** 2 if i == j else 0.0)
            assert abs(sum(r[f"{n}_l{i}{x}"] * r[f"{n}_l{j}{x}"] for x in range(j + 1)) - want) < 1e-12
