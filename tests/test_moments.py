from __future__ import annotations

import random
import statistics as st

from clickloom.operators import moments as mom


def frame(spark, values, metric="m"):
    return spark.createDataFrame([(metric, v) for v in values], "metric string, value double")


def figures(found):
    return {r.metric: (r.n, r.mean, r.std) for r in mom.statistics(found).collect()}


def test_joining_and_leaving(spark):
    random.seed(1)
    values = [round(random.uniform(0, 1e6), 2) for _ in range(60)]
    a, b, c = (mom.moments(frame(spark, v)) for v in (values[:20], values[20:45], values[45:]))
    whole = figures(mom.joined(a, b, c))["m"]
    assert whole[0] == 60 and abs(whole[1] - st.mean(values)) < 1e-6 and abs(whole[2] - st.stdev(values)) < 1e-6
    without = mom.joined(mom.joined(a, b, c), without=b)
    rest = values[:20] + values[45:]
    assert abs(figures(without)["m"][2] - st.stdev(rest)) < 1e-6
    assert sorted(without.collect()) == sorted(mom.joined(a, c).collect())


def test_large_means_do_not_hide_small_deviations(spark):
    values = [1e9 + x for x in (0.0, 0.5, 1.0, 1.5)]
    assert abs(figures(mom.moments(frame(spark, values)))["m"][2] - st.stdev([0.0, 0.5, 1.0, 1.5])) < 1e-5


def test_few_values(spark):
    found = mom.joined(mom.moments(frame(spark, [3.0])), mom.moments(frame(spark, [None], "none")), mom.moments(frame(spark, [2.0, 2.0], "same")))
    assert figures(found) == {"m": (1, 3.0, None), "none": (0, None, None), "same": (2, 2.0, 0.0)}
    assert mom.moments(frame(spark, [])).count() == 0
