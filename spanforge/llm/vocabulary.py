"""Public tokenizer vocabularies and the cached merging of byte pairs."""

from __future__ import annotations

import base64
import heapq
import os
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_FOLDER = "/opt/tokenizers"
#: Slices kept in a worker's cache. A full cache is emptied, which costs time and changes no result.
CACHE_ENTRIES = 1_000_000


class BytePairs:
    """Byte-level BPE over a rank file: merges of one slice, cached."""

    splitter = "byte_level"

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
        self.widths = np.zeros(max(self.ranks.values()) + 1, dtype=np.int64)
        self.widths[list(self.ranks.values())] = list(map(len, self.ranks))
        self.cache: dict[bytes, tuple[int, ...]] = {}

    @cached_property
    def pieces(self) -> dict[int, bytes]:
        """Bytes of each id."""
        return {i: b for b, i in self.ranks.items()}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the neighbours of lowest rank merge first, the leftmost of equals before others."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if part[i] is None or (j := right[i]) >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (r := ranks.get(joined := part[a] + part[b])) is not None:
                    heapq.heappush(heap, (r, a, len(joined)))
        return tuple(ranks[x] for x in part if x is not None)

    def ids(self, distinct: pa.Array) -> list[tuple[int, ...]]:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        out, cache = [], self.cache
        for piece in distinct.to_pylist():
            if (found := cache.get(piece)) is None:
                found = cache[piece] = self.merge(piece)
            out.append(found)
        return out

    def counts(self, distinct: pa.Array) -> np.ndarray:
        return np.fromiter(map(len, self.ids(distinct)), dtype=np.int64, count=len(distinct))

    def prepare(self, texts: pa.Array) -> pa.Array:
        return texts


class _Counted:
    """A library tokenizer asked only for the lengths of slices not seen before."""

    def __init__(self) -> None:
        self.cache: dict[bytes, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        raise NotImplementedError

    def counts(self, distinct: pa.Array) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        pieces = distinct.to_pylist()
        new = [p for p in pieces if p not in self.cache]
        self.cache.update(zip(new, self.lengths([p.decode("utf-8") for p in new])))
        return np.fromiter((self.cache[p] for p in pieces), dtype=np.int64, count=len(pieces))


class LowerWords(_Counted):
    """BPE with word ends over NFC, lower-cased text without white space."""

    splitter = "lower_word"

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)] if pieces else []

    def prepare(self, texts: pa.Array) -> pa.Array:
        """Lower case letter by letter: a final sigma has no form of its own."""
        low = (None if t is None else unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts.to_pylist())
        return pa.array(low, type=pa.string())


class BlankPieces(_Counted):
    """Sentence pieces by merges, word mark before each text."""

    splitter = "blank_unit"

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def lengths(self, pieces: list[str]) -> list[int]:
        """A line break before each unit keeps the model's own word mark away from it; both are then taken off."""
        return [len(ids) - 2 for ids in self.model.encode(["\n" + p for p in pieces], num_threads=1)] if pieces else []

    def prepare(self, texts: pa.Array) -> pa.Array:
        some = pc.greater(pc.binary_length(texts), 0)
        return pc.if_else(some, pc.binary_join_element_wise(" ", texts, ""), texts)


# File and kind of each public vocabulary.
VOCABULARIES = {
    "byte_bpe_50k": ("byte_bpe_50k.tiktoken", BytePairs),
    "byte_bpe_multi_50k": ("byte_bpe_multi_50k.tiktoken", BytePairs),
    "word_bpe_49k": ("word_bpe_49k.json", LowerWords),
    "piece_bpe_32k": ("piece_bpe_32k.model", BlankPieces),
}


@lru_cache(maxsize=None)
def vocabulary(name: str, folder: str = DEFAULT_FOLDER):
    """One instance with its cache for each Python worker."""
    if name not in VOCABULARIES:
        raise ValueError(f"unknown tokenizer {name!r}; known: {', '.join(VOCABULARIES)}")
    file, kind = VOCABULARIES[name]
    return kind(os.path.join(folder, file))
