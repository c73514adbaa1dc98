"""Encoding of a whole corpus with a public byte-level vocabulary, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.pretokenize import Slices, long_parts, text_blocks
from spanforge.llm.vocabulary import DEFAULT_FOLDER, BytePairs, vocabulary

#: Bytes of text that a worker holds as arrays at a time; a longer text is handled by itself.
BLOCK_BYTES = 2 << 20


def encode_block(texts: pa.Array, bpe: BytePairs) -> tuple[pa.ListArray, pa.ListArray]:
    """Token ids of each text and the byte offset at which each token begins."""
    s = Slices(texts, bpe.splitter)
    pieces = bpe.ids(s.distinct)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    flat = np.fromiter((i for p in pieces for i in p), dtype=np.int32, count=int(lengths.sum()))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    per = lengths[s.index]
    ends = np.concatenate([[0], np.cumsum(per)])
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], per)
    source = np.repeat(begin[s.index], per) + within
    lists = ends[s.doc_slices].astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(lists), pa.array(flat[source]))
    # A token begins after the bytes of the tokens before it.
    width = bpe.widths[flat[source]]
    after = np.cumsum(width)
    starts = after - width - np.repeat(s.doc_offsets[:-1], np.diff(lists))
    return ids, pa.ListArray.from_arrays(pa.array(lists), pa.array(starts))


def encode_texts(texts: pa.Array, bpe: BytePairs) -> tuple[pa.ListArray, pa.ListArray]:
    """Like encode_block; one long text goes through it part by part."""
    parts = long_parts(texts)
    if len(parts) == 1:
        return encode_block(texts, bpe)
    done, base = [], 0
    for part in parts:
        ids, starts = encode_block(part, bpe)
        done.append((ids.values, pc.add(starts.values, base)))
        base += len(part[0].as_buffer())
    joined = [pa.concat_arrays(x) for x in zip(*done)]
    ends = pa.array([0, len(joined[0])], pa.int32())
    return tuple(pa.ListArray.from_arrays(ends, x) for x in joined)


def encode_corpus(
    df: DataFrame,
    text: str = "text",
    tokenizer: str = "byte_bpe_50k",
    ids: str = "ids",
    offsets: str | None = None,
    folder: str = DEFAULT_FOLDER,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds the token ids of each text, without special tokens.

    Narrow: a scan, one Arrow pass, no shuffle.  An empty and a null text both
    give an empty list; strings that spell a special token are ordinary text.
    keep: columns to carry along (default: all but the text); one named like
    the new columns is replaced by them.  offsets: also give the byte offset of
    each token under this name, from which a token's piece of the text is found
    without decoding.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != text and c not in (ids, offsets)]
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    fields = [source.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if offsets:
        fields.append(T.StructField(offsets, T.ArrayType(T.LongType(), False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(tokenizer, folder)
        for batch in batches:
            for block in text_blocks(batch, "__text", BLOCK_BYTES):
                found, starts = encode_texts(block.column("__text"), bpe)
                columns = [block.column(c) for c in keep] + [found] + ([starts] if offsets else [])
                yield pa.RecordBatch.from_arrays(columns, names=keep + [ids] + ([offsets] if offsets else []))

    return source.mapInArrow(run, T.StructType(fields))


def decode_ids(ids: Column, tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER) -> Column:
    """Text of a list of token ids; an empty list gives an empty text, a null list a null."""

    @F.pandas_udf(T.StringType())
    def decode(lists):
        bpe = vocabulary(tokenizer, folder)
        return lists.map(lambda x: None if x is None else b"".join(bpe.pieces[int(i)] for i in x).decode("utf-8", "replace"))

    return decode(ids)
