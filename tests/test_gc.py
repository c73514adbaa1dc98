import math
import random

import pytest
from pyspark.sql import functions as F

from spanforge.operators import gc


def counted(s):
    s = (s or "").encode()
    kept = [b for b in s if b not in b"ATN"]
    return len(s), len(kept), sum(97 <= b <= 122 for b in kept), sum(b not in b"CGcgatn" for b in kept)


def test_counts(spark, rows):
    data = [("a", "ACGTacgtNnRYKM"), ("a", "GG"), ("b", ""), ("c", None), ("d", "é" * 10), (None, "AC"), ("e", "G" * 300_000)]
    got = rows(gc.sequence_counts(spark.createDataFrame(data, "name string, seq string")))
    expected = {}
    for n, s in data:
        expected[n] = tuple(x + y for x, y in zip(expected.get(n, (0, 0, 0, 0)), counted(s)))
    assert got == sorted([(n, *v) for n, v in expected.items()], key=repr)
    df = spark.createDataFrame([(1, 4), (0, 0)], "gc long, length long")
    assert [r[0] if not math.isnan(r[0]) else "nan" for r in df.select(gc.gc_fraction(df.gc, df.length)).collect()] == [0.25, "nan"]


def test_regions_across_pieces(spark, rows):
    draw = random.Random(6)
    contigs = {"c1": "".join(draw.choice("ACGTacgtN") for _ in range(500)), "c2": "".join(draw.choice("ACGT") for _ in range(90))}
    chunks = gc.contig_chunks(spark.createDataFrame(list(contigs.items()), "contig string, seq string"), 32)
    regions = [(f"r{i}", draw.choice(["c1", "c2"]), s := draw.randrange(0, 95), s + draw.randrange(0, 120)) for i in range(60)] + [("gone", "c9", 1, 5)]
    df = spark.createDataFrame(regions, "name string, chrom string, start long, end long")
    pieces = {n: contigs.get(c, "")[s:e] for n, c, s, e in regions}
    assert rows(gc.region_sequences(df, chunks, 32), "name", "seq") == sorted([(n, p) for n, p in pieces.items() if p], key=repr)
    assert rows(gc.region_gc(df, chunks, 32)) == sorted([(n, *counted(p)) for n, p in pieces.items() if p], key=repr)


DEPTH, GC = "sample string, domain string, coverage double", "domain string, percent_gc double"


def test_copy_numbers_of_several_samples(spark):
    draw = random.Random(9)
    domains = [(f"baseline_{i}", 0.2 + 0.5 * i / 400) for i in range(400)] + [(f"NBPF_uc_{i}", 0.4) for i in range(5)] + [(f"other_{i}", 0.45) for i in range(20)] + [("low", 0.1), ("high", 0.9)]
    depth = []
    for sample, scale in (("one", 20.0), ("two", 35.0)):
        for name, g in domains:
            copies = 6 if name.startswith("other") else 2
            depth.append((sample, name, copies / 2 * scale * (1 + 0.3 * math.sin(6 * g)) * draw.uniform(0.98, 1.02)))
        depth.append((sample, "other_zero", 0.0))
        depth.append((sample, "not in the table", 5.0))
    g = spark.createDataFrame([*domains, ("other_zero", 0.5)], GC)
    got = gc.corrected_depth(spark.createDataFrame(depth, DEPTH), g, check=True).cache()
    assert got.count() == 2 * (len(domains) + 1)
    for sample in ("one", "two"):
        own = got.where(F.col("sample") == sample)
        conserved = own.where(gc.conserved(F.col("domain"), False))
        assert conserved.agg(F.median("corrected_coverage")).first()[0] == pytest.approx(2, abs=1e-9)
        for r in own.where("domain like 'other%' and domain <> 'other_zero'").collect():
            assert 4.5 < r.corrected_coverage < 8
        assert own.where("domain = 'other_zero'").first().corrected_coverage == 0
        ends = {r.domain: r.k_gc for r in own.where("domain in ('low', 'high')").collect()}
        bins = {r.percent_gc: r.k_gc for r in own.where("domain like 'baseline%'").collect()}
        assert ends["low"] == bins[min(bins)] and ends["high"] == bins[max(bins)]
        # a sample alone is corrected as it is among others
        alone = gc.corrected_depth(spark.createDataFrame([d for d in depth if d[0] == sample], DEPTH), g)
        assert alone.orderBy("domain").collect() == own.orderBy("domain").collect()


def test_errors(spark):
    depth, g = spark.createDataFrame([("s", "baseline_1", 1.0)], DEPTH), spark.createDataFrame([("baseline_1", 0.4)], GC)
    with pytest.raises(gc.EmptyJoin):
        gc.corrected_depth(depth, g.limit(0), check=True)
    with pytest.raises(Exception, match="composition bins"):
        gc.corrected_depth(depth, g).collect()


def test_powers_of_nothing(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, -1.0), (0.0, 0.0), (2.0, 2.0), (None, 1.0), (-1.0, 1.0)], "c double, k double")
    got = [r[0] for r in df.select(gc.powered(df.c, df.k)).collect()]
    assert got[0] == 0 and got[1] == math.inf and math.isnan(got[2]) and got[3] == pytest.approx(4) and got[4] is None and math.isnan(got[5])
    assert gc.latest_by_name(spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], "n string, v double, o int"), "n", "v", "o").first().v == 2.0


def test_samples_without_a_curve_keep_the_others(spark):
    from spanforge.plans.pipeline import copy_numbers

    names = [(f"baseline_{i}", 0.2 + 0.5 * i / 40) for i in range(40)] + [("other", 0.4)]
    depth = [("whole", n, 20 + i % 3 + 0.0) for i, (n, _) in enumerate(names)] + [("few", "baseline_1", 9.0), ("few", "other", 8.0), ("none", "other", 7.0), (None, "other", 6.0)]
    g = spark.createDataFrame(names, GC)
    got = copy_numbers(spark.createDataFrame(depth, "sample string, name string, depth double"), g).collect()
    assert sorted((r.sample or "", r.domain) for r in got) == sorted((s or "", n) for s, n, _ in depth)
    assert {(r.sample, r.reason) for r in got} == {("whole", None), ("few", "bins"), ("none", "bins"), (None, "bins")}
    assert all((r.corrected_coverage is None) == (r.k_gc is None) == (r.sample != "whole") for r in got)
    alone = gc.corrected_depth(spark.createDataFrame([d for d in depth if d[0] == "whole"], DEPTH), g)
    assert {(r.domain, r.k_gc, r.corrected_coverage) for r in got if r.sample == "whole"} == {(r.domain, r.k_gc, r.corrected_coverage) for r in alone.collect()}


def test_registered_by_sample(spark, tmp_path):
    from spanforge.plans import reference

    names = [f"baseline_{i}" for i in range(40)]
    spark.createDataFrame([(n, 100, 20 + i, i) for i, n in enumerate(names)], "name string, length long, gc long, gc_id long").write.parquet(str(tmp_path / "gc_model.parquet"))
    spark.createDataFrame([(s, n, k * (10.0 + i % 3)) for s, k in (("a", 1), ("b", 5)) for i, n in enumerate(names)], "sample_name string, name string, depth double").write.parquet(str(tmp_path / "read_depth.parquet"))
    got = reference.gc_correct_copy_number(spark, str(tmp_path))
    assert {r["sample_name"]: r["unit"] for r in gc.haploid_unit(got, "sample_name").collect()} == {"a": pytest.approx(1), "b": pytest.approx(1)}


def test_medians_against_numpy(spark, rows):
    import random

    import numpy as np

    from spanforge.operators.gc import exact_medians

    draw = random.Random(3)
    data = [(draw.choice("hhhhab"), draw.choice([draw.gauss(0, 1), draw.gauss(500, 1e4), 0.0, -0.0, 7.5, 1e300, -1e300, float("inf"), None])) for _ in range(3000)]
    data += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0), ("same", 3.0), ("none", None), (None, 1.0), ("not", float("nan"))]
    got = dict(rows(exact_medians(spark.createDataFrame(data, "k string, v double"), "k", "v")))
    assert np.isnan(got.pop("not"))
    assert got == {k: float(np.median([v for n, v in data if n == k and v is not None])) for k in ("h", "a", "b", "one", "two", "same")}
    assert exact_medians(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0
