import random

from spanforge.operators import trimming as tr


def by_hand(quality, cutoff):
    total, best, end = 0, 0, len(quality)
    for i in range(len(quality) - 1, -1, -1):
        total += cutoff - quality[i]
        if total < 0:
            break
        if total > best:
            best, end = total, i
    return end


def test_quality_ends():
    draw = random.Random(1)
    qualities = [[draw.randrange(0, 40) for _ in range(draw.randrange(0, 60))] for _ in range(500)]
    texts = ["".join(chr(33 + x) for x in q) for q in qualities]
    assert tr.quality_ends(tr.Reads(texts), 10).tolist() == [by_hand(q, 10) for q in qualities]


def test_adapter():
    cases = {
        "TTTTAGATCGGAAGAGCTT": 4, "TTTTAGATCGGAAGAGGTT": 4, "TTTTT": 5, "TTTTA": 4, "TTTAG": 3, "": 0,
        "TTTTAGATCGGTAAGAGCTT": 4,  # a letter too many
        "TTTTAGATCGAAGAGCTT": 4,  # a letter missing
        "TTTTAGATGGAAGAGGTT": 18,  # two differences
        "TTTTAGATCGGTAAGAG": 4,  # the beginning of the adapter at the read's end, a letter too many
    }
    assert dict(zip(cases, tr.adapter_starts(tr.Reads(list(cases)), "AGATCGGAAGAGC").tolist())) == cases


def edits(adapter, rest):
    """Fewest differences of the whole adapter, or of its beginning up to the end of the read, from the letters that follow."""
    before = [0] + [len(rest) + 1] * len(rest)
    for j in range(1, len(rest) + 1):
        before[j] = before[j - 1] + 1
    least = before[-1]
    for i, a in enumerate(adapter, 1):
        now = [i]
        for j, b in enumerate(rest, 1):
            now.append(min(before[j - 1] + (a != b), before[j] + 1, now[-1] + 1))
        before = now
        least = min(least, before[-1])
    return min(least, min(before))


def test_pairs(spark, rows):
    good, bad = "I" * 100, "#" * 100
    data = [(1, "A" * 100, good, "C" * 100, good), (2, "A" * 100, bad, "C" * 100, good), (3, "NN" + "A" * 90 + "NNN", "I" * 95, "C" * 100, good), (4, None, None, "C", "I")]
    df = spark.createDataFrame(data, "id int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = tr.trim_pairs(df)
    assert rows(got.selectExpr("id", "length(seq1)", "length(qual1)", "kept")) == [(1, 100, 100, True), (2, 0, 0, False), (3, 90, 90, True), (4, 0, 0, False)]
    assert rows(tr.trim_report(got.selectExpr("*", "'x' k"), ["k"])) == [("x", 4, 2, "ordinary")]
    reads = spark.createDataFrame([("ACGT" + tr.ADAPTERS["nextera"],), ("ACGT",)], "seq string")
    assert tr.detect_adapter(reads) == "nextera" and tr.detect_adapter(reads.limit(0)) == "illumina"


def test_adapter_place_by_place():
    """All reads together against each place alone: other letters, letters too many or missing, the adapter's beginning at the end."""
    draw, adapter = random.Random(2), "ACCAGACCATGA"
    reads = []
    for _ in range(400):
        seq = [draw.choice("ACG") for _ in range(draw.randrange(0, 40))]
        if len(seq) > 14 and draw.randrange(3):
            at = draw.randrange(len(seq))
            seq[at : at + 12] = list(adapter)[: len(seq[at:])]
            if draw.randrange(2):
                seq.insert(min(len(seq), at + draw.randrange(12)), draw.choice("ACG"))
            elif draw.randrange(2):
                del seq[min(len(seq) - 1, at + draw.randrange(12))]
        reads.append("".join(seq))
    for overlap, errors in ((1, 0.1), (3, 0.3), (20, 0.1)):
        got = tr.adapter_starts(tr.Reads(reads), adapter, overlap, errors)
        for seq, place in zip(reads, got.tolist()):
            best, found = 0, len(seq)
            for at in range(len(seq)):
                m = min(len(adapter), len(seq) - at)
                wrong = edits(adapter, seq[at:])
                if m >= min(overlap, len(adapter)) and wrong <= int(m * errors) and m - wrong > best:
                    best, found = m - wrong, at
            assert place == found, (seq, overlap, errors)


def test_long_and_empty_reads(monkeypatch):
    seqs = ["", "A" * 5000 + "AGATCGGAAGAGC" + "T" * 5000, "N" * 50, "é" * 30, ""]
    quals = ["I" * len(s) for s in seqs]
    whole = tr._in_blocks(seqs, quals, "AGATCGGAAGAGC", 10)
    assert [len(s) for s, _ in whole] == [0, 5000, 0, 30, 0]
    monkeypatch.setattr(tr, "BLOCK_LETTERS", 40)
    assert tr._in_blocks(seqs, quals, "AGATCGGAAGAGC", 10) == whole and tr._in_blocks([], [], None, 10) == []


def test_adapter_that_shows_late(spark):
    from pyspark.sql import functions as F

    late = F.when(F.col("id") >= 1_100_000, tr.ADAPTERS["nextera"]).otherwise("ACGT")
    assert tr.detect_adapter(spark.range(0, 1_200_000, 1, 1).select(late.alias("seq"))) == "nextera"


def test_registered_with_the_detected_adapter(spark, tmp_path):
    from spanforge.plans import reference

    texts = [("en", "I" * 90 + tr.ADAPTERS["bgiseq"] + "I" * 90), ("de", "I" * 20 + tr.ADAPTERS["bgiseq"] + "I" * 200)]
    spark.createDataFrame(texts, "lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = reference.quality_trim_reads(spark, str(tmp_path)).collect()
    assert {r.lang: (r.pairs_in, r.pairs_out) for r in got} == {"en": (1, 1), "de": (1, 0)}
