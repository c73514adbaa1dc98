import random
import unicodedata

from pyspark.sql import functions as F

from spanforge.llm.lookalike import ALIKE, _no_width, consistent_digests, consistent_texts, look_alike_pairs, look_classes, may_be_among

BASE = {other: latin for latin, others in ALIKE.items() for other in others}


def look(text):
    plain = "".join(
        chr(ord(c) - 0xFEE0) if 0xFF01 <= ord(c) <= 0xFF5E else " " if unicodedata.category(c) == "Zs" else c for c in text if c not in _no_width()
    )
    return unicodedata.normalize("NFC", "".join(BASE.get(c, c) for c in unicodedata.normalize("NFD", plain)))


def brute(docs):
    shown = [(i, t, look(t)) for i, t in docs if t is not None and look(t).strip()]
    return sorted((min(a, b), max(a, b)) for k, (a, x, p) in enumerate(shown) for b, y, q in shown[:k] if x != y and p == q)


def disguised(text, draw):
    back = {}
    for other, latin in BASE.items():
        back.setdefault(latin, []).append(other)
    out = []
    for c in text:
        kind = draw.randrange(8)
        if kind == 0 and c in back:
            c = draw.choice(back[c])
        elif kind == 1 and 0x21 <= ord(c) <= 0x7E:
            c = chr(ord(c) + 0xFEE0)
        elif kind == 2:
            c = unicodedata.normalize(draw.choice(["NFC", "NFD"]), c)
        elif kind == 3:
            c += draw.choice("​⁠﻿­")
        elif kind == 4 and c == " ":
            c = draw.choice(" 　 ")
        out.append(c)
    return "".join(out)


def test_against_brute_force(spark, rows):
    draw = random.Random(4)
    words = ["Hello", "déjà", "vu", "Ήλιος", "ёлка", "が", "Il", "l1", "O0", "Ångström", "ẹ́", "K"]
    plain = [" ".join(draw.choice(words) for _ in range(3)) for _ in range(60)]
    docs = [(i, disguised(t, draw) if i % 3 else t) for i, t in enumerate(plain * 3)]
    docs += [(900, None), (901, ""), (902, "​"), (903, "  "), (904, "a\x01b"), (905, "ab"), (906, "ａb"), (907, "x" * 300_000), (908, "ｘ" + "x" * 299_999)]
    df = spark.createDataFrame([(i, t, "m") for i, t in docs], "doc_id int, text string, class_id string")
    expected = brute(docs)
    assert len(expected) > 60 and (905, 906) in expected and (907, 908) in expected
    assert rows(look_alike_pairs(df)) == sorted(expected, key=repr)


def test_key_of_equivalent_characters():
    """Composition never changes the key, for any character that has a canonical form of its own."""
    import pyarrow as pa

    from spanforge.llm.lookalike import plain_keys

    chars = [chr(c) for c in range(0x80, 0x30000) if unicodedata.decomposition(chr(c)) and "<" not in unicodedata.decomposition(chr(c))]
    chars += ["각", "ẹ́", "が", "Ή"]
    forms = [[f"x{unicodedata.normalize(f, c)}y" for c in chars] for f in ("NFC", "NFD")] + [[f"x{c}y" for c in chars]]
    keys = [plain_keys(pa.array(f)).to_pylist() for f in forms]
    assert keys[0] == keys[1] == keys[2]
    assert len(set(plain_keys(pa.array(["日本", "本日", "мир", "日本語", None, "​"])).to_pylist())) == 5


def test_letters_that_must_stay_apart(spark):
    texts = ["I1", "l1", "11", "O0", "00", "resume", "résumé", "n", "ñ", "и", "й", "cat", "Cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert look_alike_pairs(df).count() == 0


def test_copies_classes_and_forms(spark, rows):
    df = spark.createDataFrame([(5, "abc"), (7, "аbс"), (9, "аbс"), (3, "abc"), (1, "other"), (2, "other"), (4, None)], "doc_id int, text string")
    assert rows(look_alike_pairs(df)) == [(3, 7), (3, 9), (5, 7), (5, 9)]
    assert rows(look_classes(df), "doc_id", "class_id") == [(3, 3), (5, 3), (7, 3), (9, 3)]
    assert rows(consistent_texts(df)) == [(1, "other"), (2, "other"), (3, "abc"), (4, None), (5, "abc"), (7, "abc"), (9, "abc")]
    assert look_alike_pairs(df.limit(0)).count() == 0


def test_digests_and_texts_agree(spark, rows):
    import hashlib

    docs = [(5, "abc"), (7, "аbс"), (9, "аbс"), (3, "abc"), (1, "other"), (2, "other"), (4, None), (6, ""), (None, "аbc"), (8, "ab\x01c")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id int, text string, class_id string")
    texts = {i: t for i, t, _ in rows(consistent_texts(df), "doc_id", "text", "class_id")}
    assert len(texts) == len(docs) and texts[7] == texts[9] == "abc" and texts[8] == "ab\x01c" and texts[4] is None
    digest = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    found = dict(rows(consistent_digests(df)))
    assert {i: v for i, v in found.items() if i} == {i: digest(t) for i, t in texts.items() if i}


def test_a_full_filter_only_costs_time(spark, rows):
    df = spark.range(200).withColumn("k", F.col("id").cast("string"))
    keys = spark.range(0, 200, 5).select(F.col("id").cast("string").alias("key"))
    for bits in (64, 1 << 12):
        kept = {r[0] for r in rows(may_be_among(df, F.col("k"), keys, "key", bits).where("__may"), "id")}
        assert kept >= set(range(0, 200, 5)) and (bits == 64 or len(kept) < 60)
    assert may_be_among(df, F.col("k"), keys.limit(0), "key").where("__may").count() == 0


# Letters drawn alike, apart from the operator's own list; each pair once.
DRAWN_ALIKE = (
    "aа cс cϲ dԁ eе hһ iі jј jϳ lӏ oо oο pр pρ qԛ sѕ uυ vѵ vν wԝ xх yу yү æӕ əә ɵө ʒӡ AА AΑ BВ BΒ CС CϹ EЕ EΕ GԌ HН HΗ IІ IΙ IӀ JЈ JͿ KК KΚ "
    "MМ MΜ MϺ NΝ OО OΟ PР PΡ QԚ SЅ TТ TΤ VѴ WԜ XХ XΧ YҮ YΥ ZΖ ÆӔ ƏӘ ƟӨ ƷӠ ГΓ ПΠ ФΦ кκ μµ ёë їï άά öӧ äӓ éé ÇÇ ΈΈ йй"
).split()


def test_each_pair_of_letters_drawn_alike(spark, rows):
    """A pair of documents for each pair of letters, with and without accent and width, all told apart from each other."""
    docs = []
    for k, pair in enumerate(DRAWN_ALIKE):
        for j, letter in enumerate((pair[0], pair[1:])):
            docs.append((10 * k + j, f"{k}-{letter}-ẹ́"))
    docs += [(10 * k + 2, f"{k}\u3164-{pair[0]}-ẹ́") for k, pair in enumerate(DRAWN_ALIKE)]
    found = rows(look_classes(spark.createDataFrame(docs, "doc_id int, text string")), "doc_id", "class_id")
    assert found == sorted(((i, i // 10 * 10) for i, _ in docs), key=repr)


def test_the_collation_decides(spark, rows):
    """Texts with one plain key that differ in accents, in case or in control characters are of different classes."""
    texts = ["é", "e\u0301", "è", "e", "É", "e\x01", "e\x02", "e\x1f", "\x01e", "e\u0301\x01", "é\x01", "e\n", "e\t", "e\r", "e\u2028"]
    docs = [(i, f"same {t}") for i, t in enumerate(texts)]
    assert rows(look_classes(spark.createDataFrame(docs, "doc_id int, text string")), "doc_id", "class_id") == sorted([(0, 0), (1, 0), (9, 9), (10, 9)], key=repr)


def test_copies_of_one_text_never_meet(spark, monkeypatch):
    """A class of many copies and one disguised variant gives as many pairs as copies, without trying all pairs of copies."""
    from threading import Timer

    from spanforge.llm import lookalike

    n = 300_000
    md5 = F.when(F.col("id") == 7, "variant").otherwise("copy")
    classes = spark.range(n).select(F.col("id").alias("doc_id"), md5.alias("text_md5"), F.lit(0).alias("class_id"), F.lit("copy").alias("canonical_md5"))
    monkeypatch.setattr(lookalike, "look_classes", lambda *_: classes)
    stop = Timer(90, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        got = look_alike_pairs(None).agg(F.count("*"), F.sum((F.col("doc_id_a") == 7).cast("int")), F.sum((F.col("doc_id_b") == 7).cast("int"))).first()
    finally:
        stop.cancel()
    assert tuple(got) == (n - 1, n - 8, 7)


def test_divided_copies(spark, rows, monkeypatch):
    from spanforge.llm import lookalike

    monkeypatch.setattr(lookalike, "COPIES", 3)
    docs = [(i, ["abc", "аbc", "аbс", "ａbc", "other"][min(i % 7, 4) if i % 2 else 0]) for i in range(60)]
    assert rows(look_alike_pairs(spark.createDataFrame(docs, "doc_id int, text string"))) == sorted(brute(docs), key=repr)


# From the Unicode character database, apart from the operator's own list.
UNSEEN = [
    0xAD, 0x34F, 0x61C, 0x180B, 0x180F, 0x200B, 0x200D, 0x2060, 0x2064, 0xFE00, 0xFE0F, 0xFEFF, 0x1BCA0, 0x1BCA3, 0x1D173, 0x1D17A,
    0xE0001, *range(0xE0020, 0xE0080), *range(0xE0100, 0xE01F0),
]


def test_no_width_in_every_plane(spark, rows):
    docs = [(0, "abc déjà 𠮷")] + [(k + 1, f"ab{chr(c)}c déjà 𠮷{chr(c)}") for k, c in enumerate(UNSEEN)]
    docs += [(9000, "".join(map(chr, UNSEEN))), (9001, "ab\U000110bdc déjà 𠮷"), (9002, "abc déjà 𠮸")]
    found = look_classes(spark.createDataFrame(docs, "doc_id int, text string"))
    assert rows(found, "doc_id", "class_id") == sorted(((k, 0) for k in range(len(UNSEEN) + 1)), key=repr)
