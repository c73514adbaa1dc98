import datetime as dt
import random

from spanforge.operators.references import merge_ledgers, orphan_references, reference_ledger

REFS, RECORDS = "id int, name string, at timestamp", "name string, added_at timestamp, deleted_at timestamp"
T0 = dt.datetime(2020, 1, 1)


def hours(n):
    return None if n is None else T0 + dt.timedelta(hours=n)


def brute(refs, records):
    out = []
    for i, name, at in refs:
        own = [r for r in records if r[0] == name and name is not None]
        if name is None or any(a is not None and at is not None and a <= at and (d is None or at < d) for _, a, d in own):
            continue
        later = at is not None and all(a is not None and a > at for _, a, _ in own)
        out.append((i, "missing" if not own else "later" if later else "deleted"))
    return sorted(out, key=repr)


def test_against_brute_force(spark, rows):
    draw = random.Random(5)
    names = [f"n{i}" for i in range(12)]
    records = []
    for _ in range(60):
        start = draw.choice([None, *[draw.randrange(0, 200)] * 15])
        end = draw.choice([None, draw.randrange(0, 220)])
        records.append((draw.choice([None, *names[:9]]), hours(start), hours(end)))
    records += records[:10]
    refs = [(i, draw.choice([None, "hot", *names]), hours(draw.choice([None, *[draw.randrange(-5, 230)] * 20]))) for i in range(800)]
    got = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(records, RECORDS))
    assert rows(got, "id", "reason") == brute(refs, records)


def test_parts_of_a_hot_key_and_day(spark, rows, monkeypatch):
    """References of one name on one day of change are divided by their number, and each part sees all changes."""
    from spanforge.operators import references

    monkeypatch.setattr(references, "ROWS_PER_PART", 7)
    records = [("hot", hours(3), hours(5)), ("hot", hours(9), hours(15)), ("cold", hours(0), None)]
    refs = [(i, "hot" if i % 9 else "cold", hours(i % 24)) for i in range(700)]
    got = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(records, RECORDS))
    assert rows(got, "id", "reason") == brute(refs, records)


def test_boundaries(spark, rows):
    records = [("a", hours(10), hours(20)), ("b", hours(5), hours(5))]
    refs = [(1, "a", hours(9)), (2, "a", hours(10)), (3, "a", hours(19)), (4, "a", hours(20)), (5, "b", hours(5)), (6, "b", hours(4))]
    got = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(records, RECORDS))
    assert rows(got, "id", "reason") == [(1, "later"), (4, "deleted"), (5, "deleted"), (6, "later")]


def test_empty_tables_and_clashing_columns(spark, rows):
    refs = spark.createDataFrame([(1, "a", hours(1), 7, "x")], REFS + ", moves int, reason string")
    none = spark.createDataFrame([], RECORDS)
    assert rows(orphan_references(refs, none)) == [(1, "a", hours(1), 7, "missing")]
    assert rows(orphan_references(refs.limit(0), none)) == []


def test_ledgers_add_up(spark, rows):
    records = spark.createDataFrame([("a", hours(1), hours(30)), ("b", hours(2), None)], RECORDS)
    refs = spark.createDataFrame([(i, "a" if i % 2 else "b", hours(i)) for i in range(60)], REFS)
    parts = [refs.where("id < 25"), refs.where("id >= 25")]
    whole = reference_ledger(refs, records)
    merged = merge_ledgers(reference_ledger(parts[0], records), reference_ledger(parts[1], records.limit(0)))
    assert rows(whole) == rows(merged)
    assert rows(orphan_references(refs, records, ledger=merged), "id") == rows(orphan_references(refs, records), "id")
