import math

from spanforge.operators.copies import differences, newest

SCHEMA = "k string, v double, w string, at int"


def brute(left, right):
    def latest(rows):
        out = {}
        for k, v, w, at in rows:
            if k not in out or (at is not None, at or 0) > out[k][0]:
                out[k] = ((at is not None, at or 0), v, w)
        return out

    def same(x, y):
        if x is None or y is None:
            return x is y
        if math.isnan(x) or math.isnan(y):
            return math.isnan(x) and math.isnan(y)
        if math.isinf(x) or math.isinf(y):
            return x == y
        return not abs(x - y) > 1e-9 * max(abs(x), abs(y))

    a, b = latest(left), latest(right)
    found = [(k, "only_left") for k in a.keys() - b.keys()] + [(k, "only_right") for k in b.keys() - a.keys()]
    for k in a.keys() & b.keys():
        found += [(k, "v")] * (not same(a[k][1], b[k][1])) + [(k, "w")] * (a[k][2] != b[k][2])
    return sorted(found, key=repr)


def test_against_brute_force(spark, rows):
    nan, inf = float("nan"), float("inf")
    values = [None, nan, inf, -inf, 0.0, 1.0, 1.0 + 1e-12, 1.0 + 1e-6, 1e308, -1e308]
    left = [(f"k{i % 60}" if i % 17 else None, values[i % 10], None if i % 5 == 0 else f"w{i % 3}", i if i % 7 else None) for i in range(300)]
    right = [(f"k{i % 64}" if i % 19 else None, values[i * 3 % 10], None if i % 4 == 0 else f"w{i % 3}", i if i % 11 else None) for i in range(300)]
    # equal versions are decided by the greatest values, so keep one row for each version
    left, right = ([r for j, r in enumerate(s) if r[3] is not None] for s in (left, right))
    df = differences(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"], ["v", "w"], ["at"], buckets=3)
    assert rows(df, "k", "what") == brute(left, right)


def test_empty_tables_and_repeats(spark, rows):
    some = spark.createDataFrame([("a", 1.0, "x", 1), ("a", 1.0, "x", 1)], SCHEMA)
    none = some.limit(0)
    assert rows(differences(some, none, ["k"], ["v"])) == [("a", "only_left", None, None)]
    assert rows(differences(none, some, ["k"], ["v"])) == [("a", "only_right", None, None)]
    assert rows(differences(none, none, ["k"], ["v"])) == []
    assert rows(differences(some, some, ["k"], ["v", "w"])) == []


def test_cells_and_clashing_columns(spark, rows):
    a = spark.createDataFrame([("a", 1.5, "x", 1)], "k string, v double, what string, left_value int")
    b = spark.createDataFrame([("a", 2.5, "y", 2)], "k string, v double, what string, left_value int")
    assert rows(differences(a, b, ["k"], ["v"])) == [("a", "v", "1.5", "2.5")]


def test_newest_prefers_greatest_version(spark, rows):
    df = spark.createDataFrame([("a", 1.0, "x", None), ("a", 2.0, "y", 3), ("a", 9.0, "z", 2), (None, 4.0, "n", 1)], SCHEMA)
    assert rows(newest(df, ["k"], ["v"], ["at"])) == [("a", 2.0), (None, 4.0)]


def test_hot_key_and_bucket_count_change_nothing(spark, rows):
    left = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id) end k", "cast(id as double) v", "'x' w", "cast(id as int) at")
    right = left.selectExpr("k", "case when k = 'hot' then v + 1 else v end v", "w", "at")
    one = rows(differences(left, right, ["k"], ["v"], ["at"], buckets=1), "k", "what")
    assert one == rows(differences(left, right, ["k"], ["v"], ["at"], buckets=17), "k", "what") == [("hot", "v")]
