import random

import pytest
from pyspark.sql import functions as F

from spanforge.functions.seeded import normal_of
from spanforge.operators import fragments as fr
from spanforge.operators import pairing as pr

ALN = "ord long, name string, flags int, chrom string, start long, end long, mapq int"


def paired(stream):
    """Mates and orphans of a name-sorted stream, read one after the other."""
    out, orphans, i = [], 0, 0
    while i + 1 < len(stream):
        one, two = stream[i], stream[i + 1]
        if one[1] == two[1]:
            if one[2] & 1 and two[2] & 1:
                out.append((one, two))
            i += 2
            continue
        orphans += one[2] & 1
        i += 1
        while i + 1 < len(stream) and stream[i][1] != stream[i + 1][1]:
            orphans += stream[i][2] & 1
            i += 1
        if i + 1 < len(stream):
            out.append((stream[i], stream[i + 1]))
        i += 2
    return out, orphans


@pytest.mark.parametrize("seed", range(4))
def test_pairs_of_a_stream(spark, rows, seed):
    draw = random.Random(seed)
    stream = []
    for k in range(150):
        for j in range(draw.choice([1, 2, 2, 2, 3, 4, 5])):
            stream.append((len(stream), f"r{k:03d}", draw.choice([1, 1, 1, 0]) + [64, 128][j % 2] * 0, "c", k * 10 + j, k * 10 + j + 5, 7))
    got = pr.mate_pairs(spark.createDataFrame(draw.sample(stream, len(stream)), ALN))
    pairs, orphans = paired(stream)
    assert rows(got, "name", "start1", "start2") == sorted([(a[1], a[4], b[4]) for a, b in pairs], key=repr)
    assert pr.mate_orphans(spark.createDataFrame(stream, ALN)).first()[0] == orphans


@pytest.mark.parametrize("seed", range(2))
def test_pairs_of_several_samples(spark, rows, seed):
    """Each sample is a stream of its own, whatever names it shares with others."""
    draw = random.Random(seed)
    streams, data = {}, []
    for of in ("x", "y", None):
        stream = []
        for k in range(60):
            for j in range(draw.choice([0, 1, 2, 2, 3])):
                stream.append((len(stream), f"r{k:03d}", draw.choice([1, 1, 0]), "c", k * 10 + j, k * 10 + j + 5, 7))
        streams[of] = paired(stream)
        data += [(of, *r) for r in stream]
    df = spark.createDataFrame(draw.sample(data, len(data)), "sample string, " + ALN)
    got = rows(pr.mate_pairs(df, by=["sample"]), "sample", "name", "start1", "start2")
    assert got == sorted([(of, a[1], a[4], b[4]) for of, (pairs, _) in streams.items() for a, b in pairs], key=repr)
    orphans = dict(rows(pr.mate_orphans(df.where("sample is not null"), by=["sample"])))
    assert orphans == {of: n for of, (_, n) in streams.items() if of}


def test_distribution_of_each_sample(spark, rows):
    data = [("x", *pair(0, 150)), ("x", *pair(0, 250)), ("y", *pair(0, 70)), ("z", *pair(0, 70, c2="d")), ("x", *pair(100, 9000, "far"))]
    df = spark.createDataFrame(data, "sample string, " + PAIR)
    stats = fr.fragment_stats(df, by=["sample"])
    assert rows(stats) == [("x", 150, 50, 400, 2), ("y", 20, 0, 20, 1)]
    got = rows(fr.fragments(df, stats, draw=False, by=["sample"]), "sample", "start", "end")
    assert got == [("x", 0, 200), ("x", 0, 300), ("x", 100, 150), ("x", 9000, 9050), ("y", 0, 120)]


def test_cohort(spark, rows):
    """All samples of a cohort get every domain; one without a proper pair leaves the others as they are."""
    from spanforge.plans import pipeline

    mate = lambda of, name, at, second: [
        (of, 0, name, 1 | 64, "c", at, at + 50, 9), (of, 1, name, 1 | 128 | 16, "c", at + 100 if second else at - 2000, at + 150 if second else at - 1950, 9)
    ]
    data = [r for of, at, good in (("x", 3000, True), ("y", 5000, True), ("y", 5100, True), ("z", 3000, False)) for r in mate(of, f"r{at}", at, good)]
    alignments = spark.createDataFrame(data, "sample string, " + ALN)
    domains = spark.createDataFrame([("a", "c", 3000, 3199), ("b", "c", 5000, 5099), ("none", "d", 0, 9)], "name string, chrom string, start long, end long")
    got = pipeline.cohort_depth(alignments, domains, draw=False)
    assert rows(got) == sorted([("x", "a", 0.75), ("x", "b", 0.0), ("x", "none", 0.0), ("y", "a", 0.0), ("y", "b", 0.99), ("y", "none", 0.0)], key=repr)
    for of in "xy":
        one = pipeline.coverage(alignments.where(f"sample = '{of}'"), domains, draw=False)
        assert rows(one) == [r[1:] for r in rows(got) if r[0] == of]
    gc = spark.createDataFrame([("a", 0.4)], "domain string, percent_gc double")
    status = pipeline.cohort_status(alignments, got, pipeline.copy_numbers(got, gc), "sample")
    assert rows(status) == [("x", "bins", 0), ("y", "bins", 0), ("z", "coverage", 0)]
    assert rows(pipeline.cohort_depth(alignments.limit(0), domains)) == []


def test_block_order_and_scores(spark, rows):
    data = [
        (0, "a", 1 | 64, "chr9", 50, 60, 30), (1, "a", 1 | 128 | 16, "chr10", 5, 15, 20),
        (2, "b", 1 | 64 | 4, None, 0, 0, 9), (3, "b", 1 | 128, "chr1", 7, 17, 40),
        (4, "c", 1 | 64, "chr1", 9, 99, 3), (5, "c", 1 | 128, "chr1", 9, 19, 4),
        (6, "d", 1 | 64, "chr1", 1, 2, 3), (7, "d", 1 | 128, "chr1", 1, 2, 3), (8, "d", 1 | 64 | 2048, "chr1", 8, 9, 3), (9, "d", 1 | 64 | 256, "chr1", 8, 9, 3),
    ]
    got = pr.mate_pairs(spark.createDataFrame(data, ALN))
    assert rows(got) == sorted([
        ("chr10", 5, 15, "chr9", 50, 60, "a", 20, "-", "+"), (".", -1, -1, "chr1", 7, 17, "b", 0, ".", "+"),
        ("chr1", 9, 99, "chr1", 9, 19, "c", 3, "+", "+"), ("chr1", 1, 2, "chr1", 1, 2, "d", 3, "+", "+"),
    ], key=repr)
    single = pr.single_intervals(spark.createDataFrame(data, ALN).where("ord in (0, 1, 2, 9)"))
    assert rows(single, "name", "strand") == [("a/1", "+"), ("a/2", "-"), ("d/1", "+")]
    order = [r.ord for r in pr.in_name_order(spark.createDataFrame([(0, "r10", 64, "c", 1, 2, 3), (1, "r9", 128, "c", 1, 2, 3), (2, "r9", 64, "c", 1, 2, 3)], ALN)).collect()]
    assert order == [2, 1, 0]


PAIR = "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, name string, score int, strand1 string, strand2 string"


def pair(start1, start2, name="p", c1="c", c2="c", s1="+", s2="-"):
    return (c1, start1, start1 + 50, c2, start2, start2 + 50, name, 9, s1, s2)


def test_proper_pairs_and_their_distribution(spark):
    data = [pair(0, 150), pair(0, 20), pair(0, 850), pair(0, 851), pair(0, 150, s2="+"), pair(0, 150, c2="d"), pair(0, 150, c1="."), pair(200, 0)]
    df = spark.createDataFrame(data, PAIR)
    assert df.where(fr.proper_pair(F.lit(800))).select("start1", "start2").collect() == [(0, 150), (0, 20), (0, 850)]
    d = [100, -30, 800]
    mean = round(sum(d) / 3)
    sd = round((sum((x - mean) ** 2 for x in d) / 3) ** 0.5)
    assert tuple(fr.fragment_stats(df).first()) == (mean, sd, mean + 5 * sd, 3)
    assert fr.fragment_stats(df.withColumn("o", F.monotonically_increasing_id()), "o", 2).first().n == 2
    none = fr.fragment_stats(df.limit(0))
    assert tuple(none.first()) == (None, None, None, 0)
    with pytest.raises(fr.NoProperPairs):
        fr.require_pairs(none)


def test_fragments(spark, rows):
    import hashlib

    data = [pair(100, 200, "ok"), pair(10, 30, "same", s2="+"), pair(5, 9, "half", c1=".", s1="."), pair(100, 9000, "far")]
    df = spark.createDataFrame(data, PAIR)
    stats = spark.createDataFrame([(100, 10, 150, 5)], "mean long, sd long, max_inner_distance long, n long")
    by = {}
    for p in data:
        phrase = hashlib.md5("\t".join(map(str, p)).encode()).hexdigest().encode()
        by[p[6]] = max(0, round(normal_of(phrase, 100, 10) / 2))
    expected = [
        ("c", 100, 250, "ok", 9, "+"), ("c", 10, 60 + by["same"], "same", 9, "+"), ("c", 30, 80 + by["same"], "same", 9, "+"),
        ("c", max(0, 9 - by["half"]), 59, "half", 9, "-"), ("c", 100, 150 + by["far"], "far", 9, "+"), ("c", 9000 - by["far"], 9050, "far", 9, "-"),
    ]
    assert rows(fr.fragments(df, stats)) == sorted(expected, key=repr)
    assert rows(fr.fragments(df, stats, draw=False).where("name = 'half'")) == [("c", 9, 59, "half", 9, "-")]


@pytest.mark.parametrize("seed", range(2))
def test_names_that_begin_alike_are_sorted_in_ranges(spark, rows, seed):
    draw = random.Random(seed)
    stream = []
    for k in range(400):
        for j in range(draw.choice([1, 2, 2, 3])):
            stream.append((len(stream), f"ERR000{k:04d}", draw.choice([1, 0]), "c", k * 10 + j, k * 10 + j + 5, 7))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept, found = pr.cut, []
    pr.cut = lambda df: found.append(kept(df)) or found[-1]
    try:
        got = rows(pr.mate_pairs(spark.createDataFrame(draw.sample(stream, len(stream)), ALN)), "name", "start1", "start2")
        ends = next(f for f in found if "range" in f.columns).where("range is not null").collect()
    finally:
        pr.cut = kept
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted([(a[1], a[4], b[4]) for a, b in paired(stream)[0]], key=repr)
    firsts = sorted(r["name"] for r in ends) + ["ERR0000400"]
    assert len(ends) == 4 and max(int(b[6:]) - int(a[6:]) for a, b in zip(firsts, firsts[1:])) < 200
