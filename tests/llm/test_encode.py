import base64
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm.encode import decode_ids, encode_block, encode_corpus
from spanforge.llm.pretokenize import SPLITTERS, Automaton, Block, Slices, _automata, utf8
from spanforge.llm.vocabulary import DEFAULT_FOLDER, vocabulary

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def reference():
    with open(f"{DEFAULT_FOLDER}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed):
    draw = random.Random(seed)
    parts = [*" \n\t'sretvlmdLl1é٣ 　-̈", "'re", "'ll", " '", " 's", "\r\n", "한", "😀", "<|endoftext|>", "word", " the"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 25))) for _ in range(n)]


def test_random_texts(reference):
    sample = texts(20_000, 1)
    ids, _ = encode_block(pa.array(sample), vocabulary("byte_bpe_50k"))
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in sample]


def test_scan_of_an_automaton_that_never_forgets():
    """Quotes open and close, so a state depends on all symbols before it, and the scan goes on doubling."""
    rules = {
        "outside": {0: ("outside", True), 1: ("inside", True), 2: ("outside", True)},
        "inside": {0: ("inside", False), 1: ("outside", False), 2: ("escaped", False)},
        "escaped": dict.fromkeys(range(3), ("inside", False)),
    }
    machine, draw = Automaton(rules, "outside", 3), np.random.default_rng(5)
    for n in (1, 2, 7, 1000, 4097):
        symbol, first = draw.integers(0, 3, n), draw.random(n) < 0.002
        first[0] = True
        state, expected = "outside", []
        for a, new in zip(symbol, first):
            state = "outside" if new else state
            state, begins = rules[state][a]
            expected.append(begins or new)
        assert machine.slices(symbol, first).tolist() == expected
    assert all(len(a.then) < 400 for a in _automata().values())


def shifted_boundaries(text):
    """Starts of the byte-level pattern by comparison of each character with its neighbours."""
    kind = ["w" if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else {"L": "l", "N": "n"}.get(unicodedata.category(c)[0], "o") for c in text]
    starts, i = set(), 0
    while i < len(text):
        starts.add(i)
        short = next((k for k in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d") if text.startswith(k, i)), None)
        at = i + (text[i] == " " and i + 1 < len(text) and kind[i + 1] != "w")
        end = at
        while end < len(text) and kind[end] == kind[at]:
            end += 1
        white = kind[i] == "w" and at == i
        i = i + len(short) if short else end - 1 if white and end < len(text) and end - i > 1 else end
    return starts


def test_scan_against_a_reader_of_single_characters():
    sample = texts(3_000, 6)
    data, offsets = utf8(pa.array(sample))
    block = Block(data, offsets)
    begins = set(block.pos[SPLITTERS["byte_level"](block)].tolist())
    for text, at in zip(sample, offsets):
        sizes = np.cumsum([0, *(len(c.encode()) for c in text)]) + at
        assert {k for k, p in enumerate(sizes[:-1]) if int(p) in begins} == shifted_boundaries(text), text


def test_every_codepoint(reference):
    sample = [f"a{chr(c)}a1{chr(c)}1" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    ids, _ = encode_block(pa.array(sample), vocabulary("byte_bpe_50k"))
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in sample]


def test_nulls_long_texts_and_slices_of_arrays(reference):
    sample = ["", None, "x" * 50_000, " ", None, "it's", "a" + " " * 5_000 + "b"]
    ids, offsets = encode_block(pa.array(["unused", *sample]).slice(1), vocabulary("byte_bpe_50k"))
    assert ids.to_pylist() == [reference.encode_ordinary(t) if t else [] for t in sample]
    assert offsets.to_pylist()[0] == [] == offsets.to_pylist()[1]


def test_offsets_cut_the_text_into_its_tokens(reference):
    sample = texts(500, 2)
    ids, offsets = encode_block(pa.array(sample), vocabulary("byte_bpe_50k"))
    for text, i, o in zip(sample, ids.to_pylist(), offsets.to_pylist()):
        data, ends = text.encode(), [*o[1:], len(text.encode())]
        assert [data[a:b] for a, b in zip(o, ends)] == [reference.decode_single_token_bytes(t) for t in i]


@pytest.mark.parametrize("name", ["piece_bpe_32k", "word_bpe_49k"])
def test_counts_by_slices_are_those_of_whole_texts(name):
    v = vocabulary(name)
    sample = texts(3_000, 3) + ["", "ΟΔΟΣ ΣΑΣ", "İstanbul", "éa", "▁ ▁▁x  y"]
    s = Slices(v.prepare(pa.array(sample)), v.splitter)
    per = v.counts(s.distinct)[s.index]
    got = [int(per[a:b].sum()) for a, b in zip(s.doc_slices[:-1], s.doc_slices[1:])]
    if name == "piece_bpe_32k":
        assert got == [len(x) for x in v.model.encode(sample)]
    else:
        assert got == [len(x.ids) for x in v.tokenizer.encode_batch(sample, add_special_tokens=False)]


def test_long_texts_in_parts(monkeypatch, reference):
    from spanforge.llm import pretokenize
    from spanforge.llm.encode import encode_texts
    from spanforge.llm.lookalike import plain_keys
    from spanforge.llm.packing import lengths

    for seed in range(40):
        text = " ".join(texts(30, seed)) + "x" * (seed * 7)
        monkeypatch.setattr(pretokenize, "LONG_BYTES", 1 << 20)
        one = pa.array([text])
        whole = [encode_texts(one, vocabulary("byte_bpe_50k")), plain_keys(one)]
        counts = [lengths(one, vocabulary(n)).tolist() for n in ("byte_bpe_50k", "piece_bpe_32k", "word_bpe_49k")]
        monkeypatch.setattr(pretokenize, "LONG_BYTES", 24)
        assert len(pretokenize.long_parts(one)) > 1
        assert whole == [encode_texts(one, vocabulary("byte_bpe_50k")), plain_keys(one)]
        assert counts == [lengths(one, vocabulary(n)).tolist() for n in ("byte_bpe_50k", "piece_bpe_32k", "word_bpe_49k")]
        assert whole[0][0].to_pylist() == [reference.encode_ordinary(text)]


def test_operator_and_round_trip(spark, rows, reference):
    sample = [*texts(300, 4), None, "", "same", "same"]
    df = spark.createDataFrame([(i, t, "mine", 5) for i, t in enumerate(sample)], "doc_id int, text string, ids string, other int")
    got = encode_corpus(df, offsets="begins")
    assert set(got.columns) == {"doc_id", "other", "ids", "begins"}
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {i: reference.encode_ordinary(t) if t else [] for i, t in enumerate(sample)}
    back = got.select("doc_id", decode_ids(got.ids).alias("text"))
    assert rows(back) == sorted([(i, t or "") for i, t in enumerate(sample)], key=repr)
    assert rows(encode_corpus(df.limit(0))) == []
