"""Profiling: exact quartiles (distributed ranks) equal a data-frame describe,
also where one value holds half the rows."""
import numpy as np

from flowlens.operators import profile as P


def test_quartiles_match_pandas(tables):
    raw = tables["raw_flows"]
    pdf = raw.toPandas()
    for r in P.profile_describe(raw).collect():
        col = pdf[r.column_name].astype(float)
        col = col[np.isfinite(col)]
        assert np.allclose(col.quantile([0.25, 0.5, 0.75]).tolist(), [r.q25, r.q50, r.q75], atol=1e-9)
        assert r["count"] == len(col)


def test_one_value_holds_half_the_rows(spark):
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 7, id) AS x", "if(id < 0, 1D, null) AS none")
    want = df.toPandas()["x"].astype(float)
    got = {r.column_name: r for r in P.profile_describe(df).collect()}
    assert [got["x"].q25, got["x"].q50, got["x"].q75] == want.quantile([0.25, 0.5, 0.75]).tolist()
    assert got["none"]["count"] == 0 and got["none"].q50 is None
    ranked = P.ranked_values(df, ["x"]).where("x = 7").first()
    assert (ranked.n, ranked.before) == (2001, int((want < 7).sum()))


def test_null_and_inf_profiles(tables):
    raw = tables["raw_flows"]
    nulls = {r.column_name: r.nulls for r in P.null_profile(raw).collect()}
    assert set(nulls) == {"protocol_raw", "label_raw"}
    infs = {r.column_name: r.inf_count for r in P.inf_profile(raw).collect()}
    assert set(infs) == {"flow_bytes_per_sec"}
