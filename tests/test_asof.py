import random

from ledgerline.functions.asof import asof_backward, asof_forward


def _brute(left, right, forward, inclusive):
    out = {}
    for (s, t) in left:
        cands = [(rt, v) for (rs, rt, v) in right if rs == s and
                 ((rt > t or (inclusive and rt == t)) if forward else (rt < t or (inclusive and rt == t)))]
        if not cands:
            out[(s, t)] = None
        else:
            out[(s, t)] = (min if forward else max)(cands)[1]
    return out


def test_asof_matches_brute_force(spark):
    rnd = random.Random(5)
    left = sorted({(rnd.choice("ab"), rnd.randint(0, 60)) for _ in range(120)})
    right = [(rnd.choice("abc"), t, f"v{i}") for i, t in enumerate(rnd.sample(range(0, 70), 25))]
    ldf = spark.createDataFrame(left, "k string, t int")
    rdf = spark.createDataFrame(right, "k string, rt int, v string")
    for fwd in (True, False):
        for inc in (True, False):
            fn = asof_forward if fwd else asof_backward
            got = {(r.k, r.t): r.v for r in fn(ldf, rdf, "k", "t", "rt", ["v"], inclusive=inc).collect()}
            assert got == _brute(left, right, fwd, inc), (fwd, inc)


def test_asof_forward_reads_no_frame_of_the_rows_that_follow(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, t int, v string")
    plan = asof_forward(df.select("k", "t"), df.withColumnRenamed("t", "rt"), "k", "t", "rt", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing" not in plan.lower()
