"""Quality, adapter and ambiguity trimming of reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.operators.logs import survival

# Published adapter sequences by library preparation.
ADAPTERS = {
    "illumina": "AGATCGGAAGAGC", "nextera": "CTGTCTCTTATA", "small_rna": "TGGAATTCTCGG",
    "stranded_illumina": "ACTGTCTCTTATA", "bgiseq": "AAGTCGGAGGCCAAGCGGTC",
}
QUALITY, LENGTH, PHRED, OVERLAP, ERRORS = 10, 80, 33, 1, 0.1


#: Letters of the reads that a worker holds as arrays at a time; a longer read is handled by itself.
BLOCK_LETTERS = 2 << 20


class Reads:
    """Texts as one array of letters, each text followed by a place that belongs to none."""

    def __init__(self, texts: list[str]):
        self.size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.letters = np.frombuffer(("\0".join(texts) + "\0").encode("latin-1", "replace"), dtype=np.uint8)
        self.start = np.cumsum(self.size + 1) - self.size - 1
        self.last = self.start + self.size  # the place after each text
        self.read = np.repeat(np.arange(len(texts)), self.size + 1)
        self.at = np.arange(len(self.letters)) - self.start[self.read]


def quality_ends(quality: Reads, cutoff: int) -> np.ndarray:
    """Where each read ends after cutting its low-quality tail: the running sum of cutoff - quality from the end peaks there.

    The sum is followed until it falls below 0; of equal peaks the one nearest
    to the end counts.
    """
    gain = cutoff + PHRED - quality.letters.astype(np.int64)
    gain[quality.last] = 0
    gain, first = gain[::-1], (len(gain) - 1 - quality.last)[::-1]  # backwards, each read begins with its place of none
    total = np.cumsum(gain)
    own = np.repeat(np.arange(len(first)), (quality.size + 1)[::-1])
    total -= (total[first] - gain[first])[own]
    place = np.arange(len(total))
    fallen = np.minimum.reduceat(np.where(total < 0, place, len(total)), first)
    total[place >= fallen[own]] = -1
    peak = np.maximum.reduceat(total, first)
    cut = np.minimum.reduceat(np.where(total == peak[own], place, len(total)), first) - first
    return quality.size - cut[::-1]


def adapter_starts(reads: Reads, adapter: str, overlap: int = OVERLAP, errors: float = ERRORS) -> np.ndarray:
    """Where the adapter begins in each read, its size if nowhere: the place where most letters match, the first of equal ones.

    The adapter or, at the read's end, its beginning has to match with at most
    `errors` differences a letter: other letters, letters too many or missing.
    overlap: letters of the adapter that have to be there, all of them at most.
    The rest of the adapter from each place on is compared from its end
    backwards, for all places of all reads together.
    """
    letters = np.frombuffer(adapter.encode("latin-1"), dtype=np.uint8)
    most, ended = int(len(letters) * errors), np.zeros(len(reads.letters), dtype=bool)
    ended[reads.last] = True

    def following(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x[1:], [True]]) | ended

    after = [np.ones(len(ended), dtype=bool)] * (most + 1)  # no letter of the adapter is left
    for letter in letters[::-1]:
        now, same = [], reads.letters == letter
        for e in range(most + 1):
            fits = (same & following(after[e])) | ended
            if e:
                fits |= following(after[e - 1]) | following(now[e - 1]) | after[e - 1]
            now.append(fits)
        after = now
    covered = np.minimum(len(letters), reads.size[reads.read] - reads.at)
    wrong = np.full(len(ended), most + 1)
    for e in range(most, -1, -1):
        wrong[after[e]] = e
    matches = np.where((wrong <= (covered * errors).astype(np.int64)) & (covered >= min(overlap, len(letters))) & ~ended, covered - wrong, 0)
    best = np.maximum.reduceat(matches, reads.start)
    found = np.minimum.reduceat(np.where((matches == best[reads.read]) & (matches > 0), reads.at, len(ended)), reads.start)
    return np.minimum(found, reads.size)


def trimmed(seqs: list[str], quals: list[str], adapter: str | None, cutoff: int = QUALITY) -> list[tuple[str, str]]:
    """Each read and its qualities after cutting the low-quality tail, the adapter, and N at both ends."""
    if not seqs:
        return []
    ends = np.minimum(quality_ends(Reads(quals), cutoff), np.fromiter(map(len, seqs), dtype=np.int64, count=len(seqs)))
    if adapter:
        ends = adapter_starts(Reads([s[:e] for s, e in zip(seqs, ends)]), adapter)
    out = []
    for s, q, end in zip(seqs, quals, ends):
        right = len(s[:end].rstrip("Nn"))
        left = min(end - len(s[:end].lstrip("Nn")), right)
        out.append((s[left:right], q[left:right]))
    return out


def _in_blocks(seqs: list[str], quals: list[str], adapter: str | None, cutoff: int) -> list[tuple[str, str]]:
    out, row = [], 0
    while row < len(seqs):
        end, held = row, 0
        while end < len(seqs) and (end == row or held + len(seqs[end]) <= BLOCK_LETTERS):
            held += len(seqs[end])
            end += 1
        out += trimmed(seqs[row:end], quals[row:end], adapter, cutoff)
        row = end
    return out


def detect_adapter(reads: DataFrame, seq: str = "seq") -> str:
    """Name of the preset whose sequence most reads hold, `illumina` if none does. All reads are looked at."""
    counts = [F.count(F.when(F.contains(F.col(seq), F.lit(a)), 1)).alias(n) for n, a in ADAPTERS.items()]
    found = reads.select(seq).agg(*counts).first().asDict()
    best = max(found, key=found.get)
    return best if found[best] else "illumina"


def trim_pairs(df: DataFrame, adapter: str | None = None, cutoff: int = QUALITY, length: int = LENGTH, keep: list[str] | None = None) -> DataFrame:
    """keep, seq1, qual1, seq2, qual2, kept: both mates trimmed; kept where both still have `length` letters.

    Low-quality tail, then adapter, then N at both ends.  adapter: a sequence,
    or none to cut none.  A null read is empty.
    """
    keep = [c for c in df.columns if c not in ("seq1", "qual1", "seq2", "qual2")] if keep is None else keep
    names = ["seq1", "qual1", "seq2", "qual2"]
    source = df.select(*keep, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names])
    schema = T.StructType([source.schema[c] for c in [*keep, *names]] + [T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mates = [_in_blocks(batch.column(a).to_pylist(), batch.column(b).to_pylist(), adapter, cutoff) for a, b in (names[:2], names[2:])]
            columns = [pa.array([m[i] for m in mate], pa.string()) for mate in mates for i in (0, 1)]
            kept = pa.array([len(a[0]) >= length and len(b[0]) >= length for a, b in zip(*mates)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns + [kept], names=[*keep, *names, "kept"])

    return source.mapInArrow(run, schema)


def trim_report(pairs: DataFrame, by: list[str]) -> DataFrame:
    """by, pairs_in, pairs_out, survival."""
    sums = pairs.groupBy(*by).agg(F.count("*").alias("pairs_in"), F.count(F.when(F.col("kept"), 1)).alias("pairs_out"))
    return sums.withColumn("survival", survival(F.col("pairs_in"), F.col("pairs_out")))
