import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake.functions import ranking, skew, timeline
from bazaarlake.functions import scalars as S


def test_safe_divide_edges(spark, rows):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 3), (-1, 3), (1, 8), (12345, 100000)], "n int, d int")
    assert [r[0] for r in df.select(S.safe_divide(F.col("n"), F.col("d"))).collect()] == [
        None, None, None, -0.3333, 0.125, 0.1235]


@pytest.mark.parametrize("p,decision", [
    (0.4999, "APPROVED"), (0.50, "3DS_REQUIRED"), (0.7999, "3DS_REQUIRED"), (0.80, "BLOCK"), (1.0, "BLOCK"),
    (None, "APPROVED")])
def test_decision_bands(spark, p, decision):
    assert spark.createDataFrame([(p,)], "p double").select(S.decide(F.col("p"))).first()[0] == decision


def test_age_bands(spark):
    ages = [None, 17, 18, 24, 25, 34, 35, 49, 50]
    got = spark.createDataFrame([(a,) for a in ages], "a int").select(S.age_group(F.col("a"))).collect()
    assert [r[0] for r in got] == ["50+", "minor", "18-24", "18-24", "25-34", "25-34", "35-49", "35-49", "50+"]


def test_timestamps_never_fail(spark):
    texts = ["2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-02-31T00:00:00Z",
             "x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.unix_micros(S.parse_timestamp(F.col("t")))).collect()
    base = 1704164645
    assert [r[0] for r in got] == [base * 1_000_000 + 123456, base * 1_000_000, (base - 7200) * 1_000_000, None, None,
                                   None]


def test_distance(spark):
    km = spark.range(1).select(S.country_distance_km(F.lit("FR"), F.lit("FR")), S.country_distance_km(
        F.lit("FR"), F.lit("NG")), S.country_distance_km(F.lit("TOR"), F.lit("FR"))).first()
    assert km[0] == 0 and 4000 < km[1] < 4200 and km[2] is None


def make_events(seed, n, users, span):
    random.seed(seed)
    # A third of all rows belongs to one user.
    return [(i, 0 if i % 3 == 0 else random.randrange(users), random.randrange(span), random.randrange(-50, 50),
             random.choice(["a", "b", "c", None])) for i in range(n)]


def brute(events, width):
    out = []
    for i, u, t, v, c in events:
        near = [e for e in events if e[1] == u and t - width <= e[2] <= t]
        out.append((i, len(near), sum(e[3] for e in near), len({e[4] for e in near if e[4] is not None})))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [[], [0], [0, 1, 2, 3]])
def test_trailing_equals_brute_force(spark, rows, hot):
    events = make_events(1, 240, 4, 300)
    df = spark.createDataFrame(events, "id int, u int, t bigint, v int, c string")
    got = timeline.trailing(df, "u", "t", 40, {"n": F.lit(1), "s": F.col("v")}, {"d": "c"}, chunk=25, hot=hot)
    assert rows(got.select("id", F.col("n").cast("int"), F.col("s").cast("int"), F.col("d").cast("int"))) == brute(
        events, 40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 60), st.sampled_from(["a", "b", None])), min_size=1,
                max_size=25), st.integers(0, 15), st.integers(1, 20))
def test_swept_route_property(spark, rows, points, width, chunk):
    events = [(i, u, t, 1, c) for i, (u, t, c) in enumerate(points)]
    df = spark.createDataFrame(events, "id int, u int, t bigint, v int, c string")
    got = timeline.trailing(df, "u", "t", width, {"n": F.lit(1), "s": F.col("v")}, {"d": "c"}, chunk=chunk, hot=skew.ALL)
    assert rows(got.select("id", F.col("n").cast("int"), F.col("s").cast("int"), F.col("d").cast("int"))) == brute(
        events, width)


@pytest.mark.parametrize("chunk", [5, 17, 1000])
def test_sessions_same_on_both_routes(spark, rows, chunk):
    events = make_events(2, 200, 3, 900)
    df = spark.createDataFrame(events, "id int, u int, t bigint, v int, c string")
    plain = timeline.gap_sessions(df, "u", "t", 12, hot=[])
    mixed = timeline.gap_sessions(df, "u", "t", 12, chunk=chunk, hot=[0])
    chunked = timeline.gap_sessions(df, "u", "t", 12, chunk=chunk, hot=skew.ALL)
    want = rows(plain, "id", "session_open")
    assert rows(mixed, "id", "session_open") == want and rows(chunked, "id", "session_open") == want


def test_hot_keys_finds_the_heavy_third(spark):
    df = spark.createDataFrame([(1,)] * 40 + [(i,) for i in range(2, 60)] + [(None,)] * 50, "u int")
    assert [tuple(r) for r in skew.hot_keys(df, "u", min_rows=10).collect()] == [(1,)]
    found = skew.hot_keys(spark.range(100).select(F.lit(1).alias("u")), "u", min_rows=10)
    assert [tuple(r) for r in found.collect()] == [(1,)]
    light, heavy = skew.cut(spark.createDataFrame([(1, 1), (None, 2), (3, 3)], "u int, v int"), "u", found)
    assert sorted(r["v"] for r in light.collect()) == [2, 3] and [r["v"] for r in heavy.collect()] == [1]


@pytest.mark.parametrize("hot", [["a"], skew.ALL])
def test_rows_without_time_or_key_stay_on_every_route(spark, rows, hot):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (2, "a", None, 2), (3, None, 7, 3), (4, "a", 40, None), (5, "a", 41, None), (6, "b", None, 4),
         (7, "a", None, 8), (8, "a", 90, 5), (9, None, None, 6)], "id int, u string, t bigint, v int")

    def all_of(route):
        options = {"chunk": 20, "hot": route}
        return (rows(timeline.previous(df, "u", "t", "id", "v", "p", **options), "id", "p"),
                rows(timeline.trailing(df, "u", "t", 10, {"s": F.col("v"), "n": F.lit(1)}, {"d": "v"}, **options), "id", "s", "n", "d"),
                rows(timeline.gap_sessions(df, "u", "t", 10, **options), "id", "session_open"))

    assert all_of(hot) == all_of([])


def test_dedup_latest(spark, rows, plan):
    data = [("a", 1, 0), ("a", 3, 1), ("a", 2, 2), ("b", 5, 1), ("b", 5, 2)]
    df = spark.createDataFrame(data, "k string, at int, o int")
    got = ranking.dedup_latest(df, ["k"], [F.col("at").desc(), F.col("o").desc()])
    assert rows(got) == [("a", 3, 1), ("b", 5, 2)]
    assert rows(ranking.dedup_latest(got, ["k"], [F.col("at").desc()])) == rows(got)
    assert "WindowGroupLimit" in plan(got), "copies of a hot key must be dropped before the shuffle"


@pytest.mark.parametrize("count,tiles", [(3, 5), (5, 5), (23, 5), (100, 7)])
def test_sorted_tiles_equal_window(spark, rows, count, tiles):
    random.seed(count)
    df = spark.createDataFrame([(i, random.choice([None, 1, 1, 1, 2, 9])) for i in range(count)], "k int, v int")
    order = {"t": [F.col("v").asc_nulls_first(), F.col("k")]}
    window = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order["t"])))
    assert rows(ranking.add_ntiles(df, "k", order, tiles), "k", "t") == rows(window, "k", "t")


def test_surrogate_key_is_stable(spark):
    import hashlib
    got = spark.createDataFrame([("a", None)], "x string, y int").select(S.surrogate_key("x", "y")).first()[0]
    assert got == hashlib.md5(b"a-_null_").hexdigest()


@pytest.mark.parametrize("chunk", [5, 40, 1000])
def test_previous_value_same_on_both_routes(spark, rows, chunk):
    df = spark.createDataFrame(make_events(4, 150, 3, 400), "id int, u int, t bigint, v int, c string")
    want = rows(timeline.previous(df, "u", "t", "id", "c", "p", chunk, hot=[]), "id", "p")
    assert rows(timeline.previous(df, "u", "t", "id", "c", "p", chunk, hot=[0, 2]), "id", "p") == want


def test_no_cross_join_for_incremental_reads(spark, plan):
    from bazaarlake.sources import readers
    df = spark.range(10).select(F.timestamp_seconds("id").alias("at"))
    text = plan(readers.newer_rows(df, df.filter(F.col("at") < F.timestamp_seconds(F.lit(5))), "at"))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_library_works_without_a_package_of_the_optional_folder():
    import subprocess
    import sys

    code = ("import sys, warnings; warnings.simplefilter('ignore'); sys.modules['ahocorasick'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'silver_payments' in q and 'op3_decontamination' not in q")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/", 2)[0])
    assert done.returncode == 0, done.stderr


def test_windows_on_one_key_share_one_shuffle(spark, rows, plan):
    df = spark.createDataFrame([(i % 7, i * 13 % 50 if i % 11 else None, i) for i in range(300)], "u int, t long, v long")
    first = timeline.trailing(df, "u", "t", 5, {"a": F.lit(1)}, hot=[])
    second = timeline.trailing(first.withColumn("s", F.col("t") * 2), "u", "s", 20, {"b": F.col("v")}, hot=[])
    assert plan(second).count("Exchange hashpartitioning") == 1
    data = [(i % 7, i * 13 % 50 if i % 11 else None, i) for i in range(300)]

    def near(t, other, width):
        return (t is None and other is None) or (t is not None and other is not None and 0 <= t - other <= width)

    want = sorted((v, sum(w[0] == u and near(t, w[1], 5) for w in data),
                   sum(w[2] for w in data if w[0] == u and near(t, w[1], 10))) for u, t, v in data)
    assert sorted((r["v"], int(r["a"]), int(r["b"])) for r in second.collect()) == want


def test_hot_keys_of_even_keys_are_an_empty_list(spark):
    assert skew.hot_keys(spark.range(20), "id", min_rows=1) == []
