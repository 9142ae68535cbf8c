"""The two custom operators against brute force: the bucketed interval lookup
and the bucketed LAG/LEAD."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from waferline.operators.intervals import interval_aggregate, interval_lookup
from waferline.operators.routes import explode_route, route_string
from waferline.operators.sequence import keyed_lag

T0 = datetime(2024, 1, 1)


def _rand_ts(rng, span_h=72):
    return T0 + timedelta(seconds=rng.randrange(span_h * 3600), microseconds=rng.randrange(2) * 500000)


def test_interval_aggregate_equals_nested_loop(spark):
    rng = random.Random(11)
    wins = []
    for i in range(300):
        s = _rand_ts(rng)
        wins.append((rng.randrange(5), s, s + timedelta(minutes=rng.randrange(0, 400))))
    wins += wins[:20]                                   # repeated windows
    evs = [(rng.randrange(6), _rand_ts(rng), float(rng.randrange(100))) for _ in range(2000)]
    w = spark.createDataFrame(wins, "k int, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame(evs, "k int, t timestamp_ntz, v double")
    got = interval_aggregate(w, ev, "k", "s", "e", "t", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("sv")],
                             bucket_seconds=3600)
    got = {(r.k, r.s, r.e): (r.n, r.sv) for r in got.collect()}
    want = {}
    for k, s, e in set(wins):
        m = [v for kk, t, v in evs if kk == k and s <= t <= e]
        if m:
            want[(k, s, e)] = (len(m), sum(m))
    assert got == want


def test_interval_lookup_bounds_inclusive_and_defaults(spark):
    s, e = datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 1, 30)       # crosses an hour
    left = spark.createDataFrame([("A", s, e), ("B", s, e)], "tool string, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame([
        ("A", s, 1.0), ("A", e, 3.0), ("A", s - timedelta(microseconds=1), 100.0),
        ("A", e + timedelta(microseconds=1), 100.0), ("A", datetime(2024, 1, 1, 1, 0), 2.0),
    ], "tool string, t timestamp_ntz, v double")
    out = interval_lookup(left, ev, "tool", "s", "e", "t",
                          [F.count(F.lit(1)).alias("n"), F.avg("v").alias("a")], defaults={"n": 0})
    got = {r.tool: (r.n, r.a) for r in out.collect()}
    assert got == {"A": (3, 2.0), "B": (0, None)}


def test_keyed_lag_equals_window_lag(spark):
    rng = random.Random(5)
    data = [(rng.randrange(4), T0 + timedelta(hours=rng.randrange(24 * 20), minutes=rng.randrange(60)), i)
            for i in range(1500)]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, i int")
    got = keyed_lag(df, "k", "t", ["i"], tie=["i"], bucket_seconds=86400)
    got = {r.i: r.prev_i for r in got.collect()}
    w = Window.partitionBy("k").orderBy("t", "i")
    want = {r.i: r.p for r in df.select("i", F.lag("i").over(w).alias("p")).collect()}
    assert got == want
    got2 = keyed_lag(df, "k", "t", ["i"], tie=["i"], bucket_seconds=3 * 86400, direction="lead", prefix="next_")
    want2 = {r.i: r.p for r in df.select("i", F.lead("i").over(w).alias("p")).collect()}
    assert {r.i: r.next_i for r in got2.collect()} == want2


def test_route_string_orders_by_lowest_step_once(spark):
    df = spark.createDataFrame([("w1", "T9", 1), ("w1", "T2", 2), ("w1", "T9", 3), ("w1", "T5", 4),
                                ("w2", "B", 2), ("w2", "A", 2)], "wafer string, equipment_id string, process_step_id int")
    got = dict(route_string(df, ["wafer"]).collect())
    assert got == {"w1": "T9,T2,T5", "w2": "A,B"}


def test_explode_route_positions(spark):
    df = spark.createDataFrame([("B1", "LIT001,ETC002, IMP003")], "batch_id string, equipment_sequence string")
    assert [tuple(r) for r in explode_route(df).collect()] == [("B1", 1, "LIT001"), ("B1", 2, "ETC002"),
                                                                ("B1", 3, "IMP003")]


def test_keyed_lag_with_explicit_bucket_columns(spark):
    rng = random.Random(9)
    data = [("w", rng.randrange(1, 7), T0 + timedelta(days=rng.randrange(5), minutes=rng.randrange(999)), i)
            for i in range(400)]
    df = spark.createDataFrame(data, "k string, step int, t timestamp_ntz, i int")
    got = keyed_lag(df, "k", "step", ["i"], tie=["t", "i"], bucket=[F.col("step"), F.to_date("t")])
    w = Window.partitionBy("k").orderBy("step", "t", "i")
    want = {r.i: r.p for r in df.select("i", F.lag("i").over(w).alias("p")).collect()}
    assert {r.i: r.prev_i for r in got.collect()} == want


def test_interval_sums_equal_nested_loop_with_copies(spark):
    from waferline.operators.intervals import interval_sums
    rng = random.Random(21)
    wins = []
    for i in range(300):
        s = _rand_ts(rng)
        wins.append((rng.randrange(4), s, s + timedelta(minutes=rng.randrange(0, 3000))))
    wins.append((1, T0, T0 - timedelta(minutes=5)))                 # inverted: no rows
    evs = [(rng.randrange(5), _rand_ts(rng), float(rng.randrange(100))) for _ in range(1500)]
    evs += [evs[0]] * 50                                            # copies of one reading
    evs += [(w[0], w[1], 1.0) for w in wins[:30]] + [(w[0], w[2], 2.0) for w in wins[30:60]]   # on the bounds
    w = spark.createDataFrame(wins, "k int, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame(evs, "k int, t timestamp_ntz, v double")
    got = interval_sums(w, ev, "k", "s", "e", "t",
                        {"n": F.lit(1).cast("long"), "sv": F.col("v").cast("decimal(20,2)")}, bucket_seconds=3600)
    got = {(r.k, r.s, r.e): (r.n, float(r.sv)) for r in got.collect()}
    want = {}
    for k, s, e in set(wins):
        if e < s:
            continue
        m = [v for kk, t, v in evs if kk == k and s <= t <= e]
        want[(k, s, e)] = (len(m), float(sum(m)))
    assert got == want


def test_sums_appended_to_rows_equal_a_nested_loop(spark):
    import random
    from waferline.operators.intervals import with_interval_sums
    rnd = random.Random(7)
    at = lambda h: T0 + timedelta(minutes=round(h * 60))
    ev = [(rnd.choice(["a", "b", None]), at(rnd.randrange(0, 2400) / 20), rnd.choice([1, 2, None])) for _ in range(300)]
    ev += [ev[0]] * 3 + [("a", None, 5)]
    left = [(i % 40, rnd.choice(["a", "b", "c", None]), at(s), at(s + rnd.choice([-2, 0, 0.05, 1, 1.5, 30, 24 * 400]))) for i, s in
            enumerate(rnd.randrange(0, 2400) / 20 for _ in range(120))]
    left += [left[0]] * 2 + [(99, "a", None, at(1)), (98, "a", at(1), None), (97, None, None, None), (96, "a", at(-24 * 365 * 60), at(3))]
    w, e = spark.createDataFrame(left, "id int, k string, s timestamp_ntz, e timestamp_ntz"), spark.createDataFrame(ev, "k string, t timestamp_ntz, v int")
    values = {"n": F.lit(1).cast("long"), "v": F.col("v").cast("long")}

    def loop(_, k, s, e):
        if None in (k, s, e) or e < s:
            return None, None
        inside = [x for x in ev if x[0] == k and x[1] is not None and s <= x[1] <= e]
        return len(inside), sum(x[2] or 0 for x in inside)

    want = sorted((r + loop(*r) for r in left), key=str)
    for prune in (False, True):
        got = with_interval_sums(w, e, "k", "s", "e", "t", values, 3600, prune=prune).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_interval_events_keep_copies_and_rows_without_a_window(spark):
    from waferline.operators.intervals import interval_events
    at = lambda h: T0 + timedelta(minutes=round(h * 60))
    left = [(1, "a", at(0.5), at(1.5)), (1, "a", at(0.5), at(1.5)), (2, None, at(0), at(9)), (3, "a", at(3), at(2)), (4, "a", None, at(2)),
            (5, "a", at(-24 * 30), at(24 * 30)), (6, "b", at(1), at(1))]
    ev = [("a", at(0.5), "x"), ("a", at(1.5), "y"), ("a", at(1.6), "z"), (None, at(1), "n"), ("b", at(1), "w"), ("a", None, "t")]
    w, e = spark.createDataFrame(left, "id int, k string, s timestamp_ntz, e timestamp_ntz"), spark.createDataFrame(ev, "k string, t timestamp_ntz, st string")
    df = interval_events(w, e, "k", "s", "e", "t")
    assert df.columns == ["k", "s", "e", "id", "t", "st"]
    assert sorted(((r.id, r.st) for r in df.collect()), key=str) == sorted(
        [(1, "x"), (1, "y"), (1, "x"), (1, "y"), (2, None), (3, None), (4, None), (5, "x"), (5, "y"), (5, "z"), (6, "w")], key=str)
