"""The filter of fixed size loses no key, and lets few others through while it is sparse."""

import numpy as np


def test_filter_holds_all_keys(spark):
    from quillwork.plans.bloom import bloom_of

    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    df = spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long")
    bloom = bloom_of(df)
    assert bloom.holds(keys).all()
    others = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 20_000)
    assert bloom.holds(others).mean() < 0.01
    assert not bloom_of(df.where("k is null")).holds(keys).any()
