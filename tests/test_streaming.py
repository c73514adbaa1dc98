import datetime as dt

from spanforge.operators.references import orphan_references, reference_ledger
from spanforge.streaming.logs import compact_ledger, keep_ledger, kept_ledger, trim_log_stream, trim_totals


def test_trim_totals(spark, rows, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1").write_text("fastq/s/f\ttotal\t10\nfastq/s/f\tdiscarded\t2\nbroken\n")
    query = trim_totals(trim_log_stream(spark, str(logs))).writeStream.outputMode("complete").format("memory").queryName("trim_totals").start()
    try:
        query.processAllAvailable()
        assert rows(spark.table("trim_totals")) == [("s", "fastq/s/f", "discarded", 2), ("s", "fastq/s/f", "total", 10)]
    finally:
        query.stop()


def t(h):
    return None if h is None else dt.datetime(2020, 1, 1) + dt.timedelta(hours=h)


RECORDS = "name string, added_at timestamp, deleted_at timestamp, sign int"
REFS = "id int, name string, at timestamp, sign int"


def test_ledger_of_batches_is_the_ledger_of_all(spark, rows, tmp_path):
    """Names that are added or deleted in later batches, and references taken back, count like those of a ledger made at once."""
    refs = [(i, "abcd"[i % 4], t(i), 1) for i in range(80)]
    batches = [
        ([("a", t(5), None, 1), ("b", t(1), None, 1)], refs[::3]),
        ([("a", t(5), None, -1), ("a", t(5), t(40), 1)], refs[1::3]),
        ([("c", t(30), t(31), 1), ("c", None, None, 1)], refs[2::3]),
        ([("b", t(1), None, -1), ("b", t(1), t(60), 1)], [(*r[:3], -1) for r in refs[40:48]]),
    ]
    ledger = tmp_path / "ledger"
    for k, (changes, came) in enumerate(batches):
        spark.createDataFrame(changes, RECORDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "records"))
        spark.createDataFrame(came, REFS).coalesce(1).write.mode("append").parquet(str(tmp_path / "refs"))
        streams = [spark.readStream.schema(s).parquet(str(tmp_path / n)) for s, n in ((REFS, "refs"), (RECORDS, "records"))]
        query = keep_ledger(*streams, str(ledger), str(tmp_path / "state"), sign="sign")
        assert query.awaitTermination(120) and query.exception() is None
        if k == 1:
            compact_ledger(spark, str(ledger), str(tmp_path / "compact"))
            ledger = tmp_path / "compact"
    assert sorted(p.name for p in ledger.iterdir() if p.name.startswith("batch")) == ["batch=-1", "batch=2", "batch=3"]
    records = spark.createDataFrame([("a", t(5), t(40)), ("b", t(1), t(60)), ("c", t(30), t(31)), ("c", None, None)], "name string, added_at timestamp, deleted_at timestamp")
    left = spark.createDataFrame(refs[:40] + refs[48:], REFS)
    kept = kept_ledger(spark, str(ledger))
    some = "refs <> 0 or delta <> 0 or moves <> 0 or first_added is not null or undated"
    assert rows(kept.where(some)) == rows(reference_ledger(left, records).where(some))
    found = rows(orphan_references(left, records, ledger=kept))
    assert found == rows(orphan_references(left, records)) and {r[-1] for r in found} == {"missing", "later", "deleted"}
