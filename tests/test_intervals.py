import random

import pytest
from pyspark.sql import functions as F

from spanforge.operators import intervals as iv
from spanforge.plans import pipeline
from spanforge.plans.pipeline import cohort_coverage, domain_depth

BED = "chrom string, start long, end long, name string"


def random_rows(n, seed, length):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        s = draw.choice([None, *[draw.randrange(-50, 3000)] * 40])
        e = draw.choice([None, *[(s or 0) + draw.randrange(-3, length)] * 40])
        out.append((draw.choice([None, "chr1", "chr1", "chr10", "chr2"]), s, e, f"n{i // 2}"))
    return out + out[:5]


def brute(a, b):
    out = []
    for x in a:
        met = [
            (y, min(x[2], y[2]) - max(x[1], y[1]))
            for y in b
            if None not in (*x[:3], *y[:3]) and x[0] == y[0] and x[1] < x[2] and y[1] < y[2] and min(x[2], y[2]) > max(x[1], y[1])
        ]
        out += [(*x, *y, n) for y, n in met] or [(*x, None, None, None, None, 0)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [7, 100, 5000])
def test_left_join_against_brute_force(spark, rows, width):
    a, b = random_rows(120, 1, 300), random_rows(250, 2, 40)
    got = iv.overlap_left(spark.createDataFrame(a, BED), spark.createDataFrame(b, BED), width=width)
    assert rows(got) == brute(a, b)


def test_book_ended_empty_and_missing(spark, rows):
    a = spark.createDataFrame([("c", 0, 10, "x"), ("c", 10, 20, "y")], BED)
    b = spark.createDataFrame([("c", 10, 12, "r"), ("c", 5, 5, "empty")], BED)
    assert rows(iv.overlap_left(a, b), "a_name", "b_name", "overlap") == [("x", None, 0), ("y", "r", 2)]
    assert rows(iv.overlap_left(a, b.limit(0)), "a_name", "overlap") == [("x", 0), ("y", 0)]
    assert rows(iv.overlap_left(a.limit(0), b)) == []


def test_every_domain_has_a_depth(spark, rows):
    domains = spark.createDataFrame([("c", 100, 200, "a"), ("c", 300, 400, "b"), ("d", 0, 9, "e")], BED)
    reads = spark.createDataFrame([("c", 50, 150, "r"), ("c", 50, 150, "r2"), ("c", 199, 400, "s")], BED)
    assert rows(domain_depth(domains, reads)) == [("a", 1.0), ("b", 100 / 101), ("e", 0.0)]
    cohort = reads.withColumn("sample", F.when(F.col("name") == "s", "two").otherwise("one"))
    expected = [("one", "a", 100 / 101), ("one", "b", 0.0), ("one", "e", 0.0), ("two", "a", 1 / 101), ("two", "b", 100 / 101), ("two", "e", 0.0)]
    assert rows(cohort_coverage(cohort, domains)) == expected
    three = cohort_coverage(cohort, domains, samples=spark.createDataFrame([("one",), ("none",), (None,)], "sample string"))
    assert rows(three) == sorted([*expected, ("none", "a", 0.0), ("none", "b", 0.0), ("none", "e", 0.0)], key=repr)


def rows_moved(df):
    """Rows that the exchanges of a frame write when it is collected, the most of any of them."""
    df.collect()
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        left += [node.children().apply(k) for k in range(node.children().size())]
    return max(found)


def test_cohort_repeats_domains_after_the_last_shuffle(spark, rows, monkeypatch):
    """Most samples do not cover most domains: such pairs come out with 0, but none is moved, and many tasks share them."""
    domains = [*[(f"d{k}", "c", 100 * k, 100 * k + 50) for k in range(57)], (None, "c", 20, 70), ("empty", "c", 30, 29), ("back", "c", 60, 20)]
    reads = [(None if k == 7 else f"s{k % 50:02}", "c", 97 * k, 97 * k + 40) for k in range(60)] * 2
    depth = {}
    for d, _, s, e in domains:
        for of in {r[0] for r in reads if r[0]}:
            met = sum(max(0, min(e, y) - max(s, x)) for name, _, x, y in reads if name == of) if s < e else 0
            depth[of, d] = None if e - s + 1 == 0 else met / (e - s + 1)
    monkeypatch.setattr(pipeline, "TASK_ROWS", 100, raising=False)
    cohort = spark.createDataFrame(reads, "sample string, chrom string, start long, end long")
    got = cohort_coverage(cohort, spark.createDataFrame(domains, "name string, chrom string, start long, end long"))
    assert rows(got) == sorted(((*k, v) for k, v in depth.items()), key=repr) and len(depth) == 3000
    assert rows_moved(got) < 600
    assert got.rdd.getNumPartitions() == 30


MERGE = "key string, start long, end long, value long"


def test_merge(spark, rows):
    data = [("a", 0, 10, 1), ("a", 10, 20, 2), ("a", 21, 30, 4), ("a", 0, 10, 8), ("b", 0, 5, None), (None, 1, 2, 3), ("a", None, 2, 9)]
    df = spark.createDataFrame(data, MERGE)
    assert rows(iv.merge_sum(df)) == [("a", 0, 20, 11), ("a", 21, 30, 4), ("b", 0, 5, 0), (None, 1, 2, 3)]
    assert rows(iv.merge_sum(df.limit(0))) == []
    nested = spark.createDataFrame([("a", 0, 100, 1), ("a", 5, 6, 1), ("a", 50, 60, 1)], MERGE)
    assert rows(iv.merge_sum(nested)) == [("a", 0, 100, 3)]


def test_contiguity_check(spark, rows):
    schema = "key string, start long, o long"
    fine = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 0, 2)], schema)
    assert iv.check_contiguous(fine, "key", "start", "o").count() == 3
    for bad, said in (([("a", 1, 0), ("b", 2, 1), ("a", 3, 2)], "comes back"), ([("a", 2, 0), ("a", 1, 1)], "goes back")):
        with pytest.raises(Exception, match=said):
            iv.check_contiguous(spark.createDataFrame(bad, schema), "key", "start", "o").collect()


def test_total_order(spark):
    data = [("chr2", 5, 9, "a"), ("chr10", 50, 60, "b"), ("chr10", 9, 60, "d"), ("chr10", 9, 60, "c"), ("A", 1, 2, "x"), ("a", 1, 2, "x")]
    got = [(r.chrom, r.start, r.name) for r in iv.in_total_order(spark.createDataFrame(data, BED)).collect()]
    assert got == [("A", 1, "x"), ("a", 1, "x"), ("chr10", 9, "c"), ("chr10", 9, "d"), ("chr10", 50, "b"), ("chr2", 5, "a")]
    texts = spark.createDataFrame([("10",), ("9",), ("x",), ("-1.5",), (None,)], "t string")
    assert [r[0] for r in texts.orderBy(iv.text_number(F.col("t")), "t").collect()] == ["-1.5", None, "x", "9", "10"]


def test_width_of_the_bins_follows_the_lengths(spark, rows):
    """Intervals of millions of positions touch as few bins as short ones do; a few long ones among short ones stay bounded."""
    make = lambda data: spark.createDataFrame(data, "start long, end long")
    long = [(k * 10**6, k * 10**6 + 2 * 10**6) for k in range(50)]
    for data in (long, [(k, k + 3) for k in range(5000)] + long[:3], [(5, 5), (None, 3), (9, 2)], []):
        width = iv.bin_width(make(data)).first()[0]
        bins = sum((e - 1) // width - s // width + 1 for s, e in data if s is not None and s < e)
        assert bins <= 2.1 * len(data) + 1
    a = spark.createDataFrame([(f"a{k}", "c", *x) for k, x in enumerate([*long, (3, 9), (10**6 + 5, 10**6 + 9)])], "name string, chrom string, start long, end long")
    got = iv.overlap_inner(a, a)
    assert rows(got, "a_name", "b_name", "overlap") == rows(iv.overlap_inner(a, a, width=1000), "a_name", "b_name", "overlap") and got.count() > 100
