import random
from collections import Counter

import pytest

from spanforge.llm.sampling import cell_quotas, matched_sample, shortfalls, target_report


def margin(first, category, share_bp=0, min_rows=0, wanted=0, available=0):
    return {"first": first, "dim": "a" if first else "b", "category": category, "share_bp": share_bp, "min_rows": min_rows, "wanted": wanted, "available": available}


def test_scarce_is_what_is_missing_and_conflict_what_the_other_side_keeps_out():
    margins = [margin(True, "p", wanted=5, available=3), margin(True, "q", wanted=2, available=9), margin(False, "c", wanted=6, available=12)]
    got = shortfalls(margins, {("p", "c"): 3, ("q", "c"): 9})
    assert [m["scarce"] for m in got] == [2, 0, 0]
    # five rows can be had from p and q together; c wants six
    assert sum(m["conflict"] for m in got) == 1
    margins = [margin(True, "p", wanted=4, available=4), margin(False, "c", wanted=1, available=4)]
    assert [(m["scarce"], m["conflict"]) for m in shortfalls(margins, {("p", "c"): 4})] == [(0, 3), (0, 0)]


@pytest.mark.parametrize("seed", range(20))
def test_scarce_against_the_definition(seed):
    draw = random.Random(seed)
    cells = {(a, b): draw.randrange(0, 6) for a in ("p", "q", None) for b in ("c", "d", "e", None)}
    margins = []
    for first, names in ((True, "pq"), (False, "cde")):
        for n in names:
            there = sum(v for k, v in cells.items() if k[not first] == n)
            margins.append(margin(first, n, wanted=draw.randrange(0, 25), available=there))
    for m in shortfalls(margins, cells):
        assert m["scarce"] == max(0, m["wanted"] - m["available"])


def test_quotas_meet_both_margins_exactly_where_they_can():
    margins = [margin(True, "p", 5000), margin(True, "q", 5000), margin(False, "c", 2500), margin(False, "d", 7500)]
    cells = {(a, b): 100 for a in "pq" for b in "cd"}
    quotas = cell_quotas(margins, cells, 40)
    for first, name, n in ((0, "p", 20), (0, "q", 20), (1, "c", 10), (1, "d", 30)):
        assert sum(v for k, v in quotas.items() if k[first] == name) == n


def test_quotas_keep_floors_before_shares_and_fill_the_sample():
    margins = [margin(True, "p", 9900, 0), margin(True, "q", 100, 3), margin(False, "c", 10000)]
    quotas = cell_quotas(margins, {("p", "c"): 50, ("q", "c"): 50}, 10)
    assert quotas == {("p", "c"): 7, ("q", "c"): 3}
    quotas = cell_quotas(margins, {("p", "c"): 2, ("q", "c"): 50, (None, "c"): 50}, 10)
    assert sum(quotas.values()) == 10 and quotas[("p", "c")] == 2 and (None, "c") not in quotas


def four_by_four(**stock):
    margins = [margin(first, n, 2500) for first, names in ((True, "ABCD"), (False, "WXYZ")) for n in names]
    return margins, {(a, b): stock.get(a + b, 100) for a in "ABCD" for b in "WXYZ"}


def test_quotas_are_spread_over_all_cells():
    """Each population comes from every centre, in proportion to what there is."""
    margins, cells = four_by_four()
    assert cell_quotas(margins, cells, 80) == {c: 5 for c in cells}
    seen = Counter()
    for seed in range(300):
        quotas = cell_quotas(margins, cells, 40, seed)
        assert all(sum(v for k, v in quotas.items() if k[i] == n) == 10 for i, names in enumerate(("ABCD", "WXYZ")) for n in names)
        assert set(quotas) == set(cells) and set(quotas.values()) <= {2, 3}
        seen.update(quotas)
    assert all(2.3 < seen[c] / 300 < 2.7 for c in cells)
    few = Counter()
    for seed in range(300):  # fewer rows than cells: each cell has its turn
        few.update(cell_quotas(margins, cells, 8, seed))
    assert all(0.3 < few[c] / 300 < 0.7 for c in cells)


def test_quotas_follow_what_there_is():
    margins, cells = four_by_four(AW=300, BX=1, CY=0)
    seen = Counter()
    for seed in range(200):
        quotas = cell_quotas(margins, cells, 80, seed)
        assert sum(quotas.values()) == 80 and all(n <= cells[c] for c, n in quotas.items())
        assert all(sum(v for k, v in quotas.items() if k[i] == n) == 20 for i, names in enumerate(("ABCD", "WXYZ")) for n in names)
        seen.update(quotas)
    assert seen["A", "W"] > 1.5 * seen["A", "X"] and seen["B", "X"] <= 200 and not seen["C", "Y"]
    assert len({tuple(sorted(cell_quotas(margins, cells, 79, seed).items())) for seed in range(20)}) > 10
    assert cell_quotas(margins, cells, 79, 3) == cell_quotas(margins, cells, 79, 3)


@pytest.mark.parametrize("seed", range(15))
def test_quotas_cost_no_more_than_the_best_of_all(seed):
    draw = random.Random(seed)
    margins = [margin(True, "p", 3000, 1), margin(True, "q", 7000), margin(False, "c", 6000, 2), margin(False, "d", 4000)]
    cells = {(a, b): draw.randrange(0, 4) for a in "pq" for b in "cd"}
    size = draw.randrange(1, 7)

    def off(q):
        total = 0
        for m in margins:
            n = sum(v for k, v in q.items() if k[0 if m["first"] else 1] == m["category"])
            total += 1000 * max(0, m["min_rows"] - n)
        return total

    best = None
    from itertools import product

    for values in product(*(range(n + 1) for n in cells.values())):
        if sum(values) == min(size, sum(cells.values())):
            cost = off(dict(zip(cells, values)))
            best = cost if best is None else min(best, cost)
    got = cell_quotas(margins, cells, size)
    assert all(n <= cells[k] for k, n in got.items()) and sum(got.values()) == min(size, sum(cells.values()))
    assert off(got) == best


CANDIDATE = "release_tag string, candidate_id long, population string, centre_name string, wanted int"
TARGET = "release_tag string, dim string, category string, share_bp int, min_rows int, sample_size int"


def test_operators(spark, rows):
    people = [("r", i, ["P", "p ", " q", "Q", None, "NA", ""][i % 7], ["c", "C ", "d"][i % 3], 1) for i in range(210)]
    people += people[:40] + [(None, 1, "P", "c", 1), ("r", None, "P", "c", 1), ("s", 1, "P", "c", 1)]
    targets = [("r", "population", "P", 5000, 0, 100), ("r", "population", "Q", 5000, 70, 100), ("r", "centre_name", "c", 6667, 0, 100), ("r", "centre_name", "D", 3333, 0, 100)]
    targets += [("s", "population", "P", 10000, 2, 1), ("t", "population", "P", 10000, 0, 5)]
    a, b = spark.createDataFrame(people, CANDIDATE), spark.createDataFrame(targets + targets[:1], TARGET)
    report = {(r.release_tag, r.dim, r.category): r for r in target_report(a, b).collect()}
    assert len(report) == len(targets)
    assert (report["r", "population", "Q"].wanted, report["r", "population", "Q"].available, report["r", "population", "Q"].scarce) == (70, 60, 10)
    assert report["s", "population", "P"].scarce == 1 and report["t", "population", "P"].scarce == 5
    sample = matched_sample(a, b)
    drawn = sample.collect()
    assert Counter(r.release_tag for r in drawn) == {"r": 100, "s": 1}
    assert len({(r.release_tag, r.candidate_id) for r in drawn}) == len(drawn)
    got = Counter(r.population for r in drawn if r.release_tag == "r")
    assert got["Q"] == 60 and got["P"] == 40
    assert rows(matched_sample(a, b)) == rows(sample)
    assert target_report(a.limit(0), b).where("scarce = wanted").count() == len(targets)
    assert target_report(a, b.limit(0)).count() == 0 and matched_sample(a.limit(0), b).count() == 0
