"""Text that looks the same but is stored with different characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.checkpoints import cut
from spanforge.llm.pretokenize import Block, long_parts, text_blocks, utf8

BLOCK_BYTES = 2 << 20

# Greek and Cyrillic letters drawn like a Latin one, and Greek ones drawn like a Cyrillic one.
ALIKE = {
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "јϳ", "l": "ӏ", "o": "оο", "p": "рρ", "q": "ԛ", "s": "ѕ",
    "u": "υ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү", "æ": "ӕ", "ə": "ә", "ɵ": "ө", "ʒ": "ӡ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ",
    "M": "МΜϺ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ",
    "Y": "ҮΥ", "Z": "Ζ", "Æ": "Ӕ", "Ə": "Ә", "Ɵ": "Ө", "Ʒ": "Ӡ", "Г": "Γ", "П": "Π", "Ф": "Φ", "к": "κ", "μ": "µ",
}


@lru_cache(maxsize=1)
def _mapping() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one character, and several.

    Composed letters follow the letter they are built on.  Characters whose
    canonical form is another single character are mapped too, so that what is
    ASCII after the mapping does not depend on composition.
    """
    base = {other: latin for latin, others in ALIKE.items() for other in others}
    base |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    one, more = {}, {}
    unseen = set(_no_width())
    for c in range(0x80, 0x110000):
        char = chr(c)
        if unicodedata.category(char) == "Zs":
            one[char] = " "
        elif char not in unseen and (char in base or unicodedata.decomposition(char)):  # others stay as they are
            apart = unicodedata.normalize("NFD", char)
            to = unicodedata.normalize("NFC", "".join(base.get(x, x) for x in apart))
            if to != unicodedata.normalize("NFC", char) or to.isascii():
                (one if len(to) == 1 else more)[char] = to
    return one, more


@lru_cache(maxsize=1)
def _no_width() -> str:
    """Format characters with the tags, variation selectors of all blocks, the grapheme joiner, fillers and inherent vowels.

    The two Kaithi number signs are format characters that show.
    """
    selectors = {0x034F, *range(0x180B, 0x180E), 0x180F, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
    fillers = {0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0}
    return "".join(
        chr(c) for c in range(0x80, 0x110000)
        if c in selectors or c in fillers or unicodedata.category(chr(c)) == "Cf" and c not in (0x110BD, 0x110CD)
    )


#: Where control characters go in the mapped form: private characters, which the collation tells apart.
CONTROLS = 0xF0000


def look_mapped(text: Column) -> Column:
    """Text with look-alikes mapped to one letter, other spaces to a blank and characters of no width taken out.

    Accents are neither composed nor decomposed; that is left to the collation.
    Control characters, which the collation ignores though they are no such
    difference, become private characters.
    """

    @F.pandas_udf(T.StringType())
    def mapped(texts):
        one, more = _mapping()
        controls = {chr(c): chr(CONTROLS + c) for c in range(0xA0) if unicodedata.category(chr(c)) == "Cc" and not chr(c).isspace()}
        table = str.maketrans(one | more | controls | dict.fromkeys(_no_width(), ""))
        return texts.map(lambda t: None if t is None else t.translate(table))

    return mapped(text)


# What the plain key makes of a codepoint that it does not keep.
_DROPPED, _MARK, _UNSEEN = -1, -2, -3


@lru_cache(maxsize=1)
def _plain_table() -> tuple[np.ndarray, np.ndarray]:
    """What each codepoint becomes in the plain key, and whether it shows.

    Kept are characters that no accent is part of, as what they are mapped to.
    Those built with accents are dropped, and so are Hangul syllables and their
    letters, which compose without a mark.
    """
    becomes = np.arange(0x110000, dtype=np.int32)
    shows = np.ones(0x110000, dtype=bool)
    one, more = _mapping()
    for c in range(0x110000):
        char = chr(c)
        kind = unicodedata.category(char)
        if kind in ("Cc", "Cf", "Zs", "Zl", "Zp"):
            shows[c] = False
        if kind[0] == "M":
            becomes[c] = _MARK
        elif char in more or 0x1100 <= c < 0x1200 or 0xAC00 <= c < 0xD7A4:
            becomes[c] = _DROPPED
        elif c >= 0x80:
            apart = unicodedata.normalize("NFD", one.get(char, char))
            becomes[c] = ord(apart) if len(apart) == 1 else _DROPPED
    for char in _no_width():
        becomes[ord(char)], shows[ord(char)] = _UNSEEN, False
    return becomes, shows


def _plain_rests(texts: pa.Array) -> list[tuple[bool, bytes]]:
    """Of each text, whether it shows anything and what the plain key keeps of it."""
    data, offsets = utf8(texts)
    if not len(data):
        return [(False, b"")] * len(texts)
    block = Block(data, offsets)
    code = block.lead.astype(np.int32)
    wide = np.flatnonzero(block.lead >= 0xC0)
    code[wide] = block.codepoints(wide)
    becomes, shows = _plain_table()
    doc = np.searchsorted(block.pos, offsets)
    shown = np.concatenate([[0], np.cumsum(shows[code])])
    visible = shown[doc[1:]] > shown[doc[:-1]]
    value = becomes[code]
    seen = value != _UNSEEN
    first = np.concatenate([[0], np.cumsum(seen)])[doc]
    value = value[seen]
    marked = np.concatenate([value[1:] == _MARK, [False]])
    marked[first[(first > 0)] - 1] = False
    keep = (value >= 0) & ~marked
    bounds = 2 * np.concatenate([[0], np.cumsum(keep)])[first]
    rest = value[keep].astype(np.uint16).tobytes()  # the low bits are enough for a hash
    return [(bool(v), rest[a:b]) for a, b, v in zip(bounds[:-1], bounds[1:], visible)]


def plain_keys(texts: pa.Array) -> pa.Array:
    """A hash of what no accent touches: equal for texts that look the same, whatever their composition.

    Look-alikes count as one letter; letters followed by combining marks and
    those composed with accents are left out, so both leave the same rest.
    Null for a null text and one that shows nothing.
    """
    parts = [_plain_rests(part) for part in long_parts(texts)]
    if len(parts) > 1:
        parts = [[(any(p[0][0] for p in parts), b"".join(p[0][1] for p in parts))]]
    return pa.array([xxhash.xxh3_64_intdigest(rest) - (1 << 63) if v else None for v, rest in parts[0]], pa.int64())


#: Bits of the filter that leaves rows out before a join; as 64-bit words, at most a 64th of this number of rows is broadcast.
FILTER_BITS = 1 << 24


def may_be_among(df: DataFrame, column: Column, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """df with `__may`: false only where `column` is certainly not among the keys.

    The keys' hashes set bits of a table of fixed size, which is all that is
    broadcast, however many keys there are.
    """

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    set_bits = keys.select(place(F.col(key)).alias("h")).select(F.shiftright("h", 6).alias("__word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    words = F.broadcast(set_bits.groupBy("__word").agg(F.bit_or("bit").alias("__bits")))
    marked = df.withColumn("__h", place(column)).withColumn("__word", F.shiftright("__h", 6)).join(words, "__word", "left")
    is_set = F.expr("shiftright(__bits, cast(__h & 63 as int)) & 1") == 1
    return marked.withColumn("__may", F.coalesce(is_set & column.isNotNull(), F.lit(False))).drop("__word", "__bits", "__h")


def keyed_texts(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """__doc, __md5, __key of every row: the text's digest and plain key. One pass over the texts, written to the checkpoint folder."""
    base = df.select(F.col(f"`{doc}`").alias("__doc"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([base.schema["__doc"], T.StructField("__md5", T.StringType()), T.StructField("__key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "__text", BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([block.column("__doc"), block.column("__md5"), plain_keys(block.column("__text"))], names=["__doc", "__md5", "__key"])

    return cut(base.select("__doc", F.md5("__text").alias("__md5"), "__text").mapInArrow(run, schema))


def text_classes(keyed: DataFrame, df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """text_md5, class_id, canonical_md5 of every different text that another one looks like; keyed: see keyed_texts.

    Texts are grouped in SQL by their look-alike-mapped form under the
    accent-sensitive collation UNICODE, which equates composed and combined
    accents and nothing else that shows.  The document with the least id is the
    canonical member, and class_id is its id; it is joined back to all texts.

    Only texts whose plain key another text shares come so far: of the others
    nothing but digest and key is moved.  Of each different text one document
    is read again, and a filter of fixed size leaves the others where they are.
    The mapped forms are written to the checkpoint folder, so that no filter on
    a form is inferred and run over the whole corpus.
    """
    texts = keyed.where("__key is not null and __doc is not null").groupBy("__key", "__md5").agg(F.min("__doc").alias("__doc"))
    shared = texts.groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1").select("__key")
    asked = cut(texts.join(shared, "__key").select("__md5", F.col("__doc").alias("__asked")))
    rows = may_be_among(df.select(F.col(f"`{doc}`").alias("__doc"), F.col(f"`{text}`").alias("__text")), F.col("__doc"), asked, "__asked").where("__may")
    some = rows.withColumn("__md5", F.md5("__text")).join(asked, ["__md5"]).where("__doc = __asked")
    looks = cut(some.select("__doc", "__md5", F.collate(look_mapped(F.col("__text")), "UNICODE").alias("__look")))
    members = looks.groupBy("__look").agg(
        F.min("__doc").alias("class_id"), F.min_by("__md5", F.struct("__doc", "__md5")).alias("canonical_md5"),
        F.min("__md5").alias("__least"), F.max("__md5").alias("__most"),
    ).where("__least <> __most").select("__look", "class_id", "canonical_md5")
    return cut(looks.join(members, "__look").select(F.col("__md5").alias("text_md5"), "class_id", "canonical_md5").distinct())


def look_classes(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, text_md5, class_id, canonical_md5 of every document in a class with different texts; see text_classes.

    Null texts, texts that show no character and documents without an id belong
    to no class.  Repeated documents (the same text) are members like others; a
    class needs at least two different texts.
    """
    keyed = keyed_texts(df, doc, text)
    classes = text_classes(keyed, df, doc, text)
    members = keyed.where("__doc is not null").join(classes, F.col("__md5") == F.col("text_md5"))
    return members.select(F.col("__doc").alias(doc), "text_md5", "class_id", "canonical_md5")


#: Documents of one text that meet a text pair in one task; the copies of a text with more are divided.
COPIES = 10_000


def look_alike_pairs(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_a, doc_b: pairs that look the same and whose texts differ; pairs of equal texts are never formed.

    The different texts of a class are paired first; the documents of either
    text then meet the text pair, so that copies of one text never meet each
    other.  The text with fewer documents comes first, and the copies of a text
    with more than COPIES are divided into parts.  The texts so divided, at
    most one for each COPIES documents, are broadcast.
    """
    c = cut(look_classes(df, doc, text).select("class_id", "text_md5", F.col(doc).alias("__doc")))
    texts = cut(c.groupBy("class_id", "text_md5").agg(F.count("*").alias("__n")).withColumn("__parts", F.ceil(F.col("__n") / COPIES).cast("int")))
    divided = F.broadcast(texts.where("__parts > 1").select("class_id", "text_md5", "__parts"))
    part = F.pmod(F.xxhash64("__doc"), F.coalesce("__parts", F.lit(1))).cast("int")
    docs = c.join(divided, ["class_id", "text_md5"], "left").select("class_id", "text_md5", part.alias("__part"), "__doc")
    one, two = (texts.select("class_id", F.struct("__n", "text_md5", "__parts").alias(side)) for side in ("__one", "__two"))
    met = one.join(two, "class_id").where("__one < __two")
    for side, found in (("__one", f"{doc}_a"), ("__two", f"{doc}_b")):
        met = met.withColumn("text_md5", F.col(f"{side}.text_md5")).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col(f"{side}.__parts") - 1)))
        met = met.join(docs, ["class_id", "text_md5", "__part"]).drop("text_md5", "__part").withColumnRenamed("__doc", found)
    a, b = F.col(f"{doc}_a"), F.col(f"{doc}_b")
    return met.where(a != b).select(F.least(a, b).alias(f"{doc}_a"), F.greatest(a, b).alias(f"{doc}_b"))


def consistent_digests(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, text_md5: the digest of the one consistent form of each document's text; null for a null text.

    A text that nothing else looks like is its own form.  No text is moved.
    """
    keyed = keyed_texts(df, doc, text)
    classes = text_classes(keyed, df, doc, text).select("text_md5", "canonical_md5")
    joined = keyed.join(classes, F.col("__md5") == F.col("text_md5"), "left")
    return joined.select(F.col("__doc").alias(doc), F.coalesce("canonical_md5", "__md5").alias("text_md5"))


def consistent_texts(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of df, with each text replaced by the one consistent form of its class.

    A text that nothing else looks like is its own form; so are null texts and
    those that show nothing.  Rows whose text changes are found by its digest;
    a filter of fixed size leaves almost all others where they are.  The
    canonical text of a class is fetched from df by the id of its document.
    """
    names = df.columns
    classes = text_classes(keyed_texts(df, doc, text), df, doc, text)
    changed = classes.where("text_md5 <> canonical_md5")
    heads = changed.select(F.col("class_id").alias("__doc"), F.col("canonical_md5").alias("__md5")).distinct()
    rows = may_be_among(df.select(F.col(f"`{doc}`").alias("__doc"), F.col(f"`{text}`").alias("__form")), F.col("__doc"), heads, "__doc").where("__may")
    forms = rows.withColumn("__md5", F.md5("__form")).join(heads, ["__doc", "__md5"], "left_semi").groupBy("__md5").agg(F.first("__form").alias("__form"))
    known = changed.join(forms, F.col("canonical_md5") == F.col("__md5")).select("text_md5", "__form")
    marked = may_be_among(df.withColumn("__md5", F.md5(F.col(f"`{text}`"))), F.col("__md5"), changed, "text_md5")
    asked = marked.where("__may").join(known, F.col("__md5") == F.col("text_md5"), "left").withColumn(text, F.coalesce("__form", F.col(f"`{text}`")))
    columns = [F.col(f"`{c}`") for c in names]
    return marked.where("not __may").select(*columns).unionByName(asked.select(*columns))
