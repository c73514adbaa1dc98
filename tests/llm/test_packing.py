import random
from collections import Counter

from spanforge.llm.packing import best_fit_runs, fill_report, pack, token_counts


def brute(capacity, items):
    bins = []
    for size in sorted(items, reverse=True):
        fit = [(room, i) for i, room in enumerate(bins) if room >= size]
        if fit:
            bins[min(fit)[1]] -= size
        else:
            bins.append(capacity - size)
    return sorted(bins)


def filled(capacity, items):
    used, seen = Counter(), Counter()
    for size, first, n, bin_, each in best_fit_runs(capacity, dict(Counter(items))):
        assert seen[size] == first
        seen[size] += n
        for k in range(n):
            used[bin_ + k // each] += size
    assert seen == Counter(items)
    return sorted(capacity - u for u in used.values())


def test_runs_are_best_fit_decreasing():
    draw = random.Random(2)
    for _ in range(800):
        capacity = draw.randrange(1, 60)
        items = [draw.randrange(1, capacity + 1) for _ in range(draw.randrange(0, 80))]
        assert filled(capacity, items) == brute(capacity, items)


COUNTS, SIZES = "doc_id int, tokenizer string, tokens long", "size_id int, tokenizer string, capacity_tokens int"


def test_every_item_is_packed_once(spark):
    draw = random.Random(8)
    lengths = [draw.choice([0, 3, 3, 3, draw.randrange(0, 250)]) for _ in range(3000)]
    counts = spark.createDataFrame([(i, "t", n) for i, n in enumerate(lengths)], COUNTS)
    sizes = spark.createDataFrame([(1, "t", 100), (2, "t", 7), (3, "t", None), (4, "other", 5)], SIZES)
    rows = pack(counts, sizes).collect()
    for size, capacity in ((1, 100), (2, 7)):
        own = [r for r in rows if r.size_id == size]
        tokens, bins = Counter(), Counter()
        for r in own:
            tokens[r.doc_id] += r.piece_tokens
            assert r.first_token == r.piece * capacity
            assert (r.container_id is None) == (lengths[r.doc_id] == 0)
            if r.container_id:
                bins[r.container_id] += r.piece_tokens
            assert lengths[r.doc_id] > capacity or r.piece == 0
        assert tokens == Counter(dict(enumerate(lengths)))
        assert max(bins.values()) <= capacity
        rest = [n % capacity for n in lengths if n % capacity]
        assert len(bins) == sum(n // capacity for n in lengths) + len(brute(capacity, rest))
    assert {r.size_id for r in rows} == {1, 2}
    report = {r.size_id: r for r in fill_report(pack(counts, sizes), sizes).collect()}
    assert report[1].tokens == sum(lengths) and report[1].unused == report[1].containers * 100 - sum(lengths)


def test_empty_and_repeated(spark, rows):
    sizes = spark.createDataFrame([(1, "t", 10)], SIZES)
    assert pack(spark.createDataFrame([], COUNTS), sizes).count() == 0
    twice = spark.createDataFrame([(1, "t", 25), (1, "t", 25), (None, "t", 5)], COUNTS)
    got = pack(twice, sizes)
    assert got.count() == 7 and got.select("container_id").distinct().count() == 6


def test_counts_of_null_and_empty_texts(spark, rows):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "Two words", 9)], "doc_id int, text string, tokens int")
    got = token_counts(df, ["byte_bpe_50k", "word_bpe_49k", "piece_bpe_32k"])
    assert rows(got.where("doc_id < 3").select("tokens").distinct()) == [(0,)]
    assert rows(got.where("doc_id = 3")) == [(3, "byte_bpe_50k", 2), (3, "piece_bpe_32k", 2), (3, "word_bpe_49k", 2)]
