import math

from pyspark.sql import functions as F

from spanforge.operators import logs, selection as sel


def test_groups_and_ranks(spark, rows):
    data = [("s", "BI", 2**62, 300, "P", 5), ("s", "BI", 2**62, None, "Q", 3), ("s", "BI", 2**62, 100, "R", 9), ("t", "SC", None, None, None, 1)]
    df = spark.createDataFrame(data, "s string, c string, reads long, ins int, pop string, o int")
    got = {r.s: r for r in sel.candidate_groups(df, ["s", "c"], "reads", "ins", "pop", "o").collect()}
    assert (got["s"].files, got["s"].reads, got["s"].mean_insert, got["s"].population, got["s"].first) == (3, 3 * 2**62, 200.0, "Q", 3)
    assert math.isnan(got["t"].mean_insert) and got["t"].reads == 0
    ranks = spark.createDataFrame([("BGI",), ("SC",), ("BI",), ("x",), (None,)], "c string").select("c", sel.preference_rank(F.col("c"), ["BGI", "SC", "BI"], 2).alias("r"))
    assert rows(ranks) == sorted([("BGI", 1), ("SC", 1), ("BI", 3), ("x", None), (None, None)], key=repr)
    best = sel.best_per_group(df, ["s"], [F.col("ins").desc_nulls_last()])
    assert rows(best, "s", "o") == [("s", 5), ("t", 1)]


def test_quotas(spark, rows):
    pool = spark.createDataFrame([(f"a{i}", "A", i) for i in range(6)] + [("b0", "B", 0), ("c0", "C", 0), ("n", None, 0)], "s string, g string, o int")
    wanted = spark.createDataFrame([("a5",), ("c0",), ("zz",)], "s string")
    got = sel.fill_quotas(pool, wanted, "s", "g", [F.col("o")], 3, ["A", "B"])
    assert rows(got, "s", "of_interest") == [("a0", False), ("a1", False), ("a5", True), ("b0", False), ("c0", True)]
    assert sel.fill_quotas(pool.limit(0), wanted, "s", "g", [F.col("o")], 3).count() == 0


def test_lists(spark, rows):
    a, b = spark.createDataFrame([("x",), ("y",), ("x",)], "s string"), spark.createDataFrame([("y",), (None,)], "s string")
    assert rows(sel.union_of_lists(a, b)) == sorted([("x",), ("y",), (None,)], key=repr)
    assert rows(sel.without(a.unionByName(b), b, "s")) == sorted([("x",), ("x",), (None,)], key=repr)
    listed, found = spark.createDataFrame([("q", 1), ("p", 2)], "s string, o int"), spark.createDataFrame([("p", 0), ("z", 1)], "s string, o int")
    assert rows(sel.listed_first(listed, found, "s", "o"), "s", "index") == [("p", 2), ("q", 1), ("z", None)]
    assert rows(sel.repeated(a, "s")) == [("x", 2)]


def test_trim_log(spark, rows):
    data = [(0, "f1", "total", 100), (1, "f1", "discarded", 90), (2, "f1", "discarded", 20), (3, "f2", "total", 50), (4, "f3", "other", 7)]
    latest = logs.latest_entries(spark.createDataFrame(data, "o int, file string, kind string, reads long"), ["file", "kind"], "reads", "o")
    got = {r.file: r for r in logs.trim_summary(latest, "file").collect()}
    assert (got["f1"].total_reads, got["f1"].filtered_reads, got["f1"].remaining_reads, got["f1"].percent_filtered) == (100, 20, 80, 0.2)
    assert (got["f2"].files, got["f2"].percent_filtered, got["f3"].files, got["f3"].percent_filtered) == (1, 0.0, 0, 0.0)


def test_counts_and_reports(spark, rows):
    lines = spark.createDataFrame([("c\t1\t2\tn1",), ("c\t1\t2\tn1\tx",), ("short",), ("c\t1\t2\tn2",)], "value string")
    assert logs.distinct_names(lines.withColumn("k", F.lit(1)), ["k"]).first().names == 3
    reads = spark.createDataFrame([("s", 2**62), ("s", 2**62), ("s", 2**62), ("t", 0), ("u", None)], "s string, r long")
    assert [int(r.expected) if r.expected is not None else None for r in logs.expected_reads(reads, "s", "r").orderBy("s").collect()] == [3 * 2**62, None, None]
    assert [(int(r.expected_pairs), r.expected_files) for r in logs.expected_halves(reads, "s", "r").orderBy("s").collect()] == [(3 * 2**61, 1), (0, 0), (0, 0)]
    names = spark.createDataFrame([("s",), ("t",)], "s string")
    summary = spark.createDataFrame([("s", 10)], "s string, total long")
    aligned = spark.createDataFrame([("t", 4)], "s string, aligned long")
    got = logs.sample_report(names, "s", summary, aligned, beds=names.where("s = 's'"))
    assert rows(got) == [("s", 10, None, True), ("t", 0, 4, False)]
    states = spark.createDataFrame([(0, 0), (5, 0), (5, 2), (4, 2)], "i long, o long").select(logs.survival(F.col("i"), F.col("o")))
    assert [r[0] for r in states.collect()] == ["no_input", "none", "low", "ordinary"]
    x = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.0)], "k string, v double")
    y = spark.createDataFrame([("a", 1.5), ("c", 0.0), ("d", 1.0)], "k string, v double")
    got = logs.largest_relative_error(x, y, ["k"], "v").first()
    assert (got.compared, got.alone) == (2, 2) and abs(got.error - 1 / 3) < 1e-12
