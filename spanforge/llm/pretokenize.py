"""Vectorised pre-tokenisation of UTF-8 buffers.

Where a text is split is what a small automaton says that reads a class for
each codepoint.  What a stretch of codepoints does to the state is a transition
function; composing those is associative, so the states of all codepoints of a
block come from a scan by doubling.  The functions that can arise are few and
are composed once for all, so a step of the scan is a look-up in a table.  A
codepoint whose composed function has become constant knows its state and
leaves the scan.  No regular expression and no loop over characters is
involved; documents of a block are processed together and never see each
other's characters.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Codepoint classes.
OTHER, LETTER, NUMBER, WHITE, BLANK, APOSTROPHE = range(6)

# The Unicode White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    """Class of every codepoint, from the Unicode general categories."""
    first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (first.get(unicodedata.category(chr(cp))[0], OTHER) for cp in range(0x110000)), dtype=np.uint8, count=0x110000
    )
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = BLANK
    table[0x27] = APOSTROPHE
    return table


class Block:
    """Codepoint positions, classes and document starts of one block of texts."""

    def __init__(self, data: np.ndarray, doc_offsets: np.ndarray):
        """data: UTF-8 bytes of all texts; doc_offsets: n + 1 byte offsets into it."""
        self.size = len(data)
        self.data = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
        self.pos = np.flatnonzero((data & 0xC0) != 0x80)
        self.lead = data[self.pos]
        self.cls = codepoint_classes()[np.minimum(self.lead, 0x7F)]
        wide = np.flatnonzero(self.lead >= 0xC0)
        if len(wide):
            self.cls[wide] = codepoint_classes()[self.codepoints(wide)]
        begins = doc_offsets[:-1][np.diff(doc_offsets) > 0]
        self.first = np.zeros(len(self.pos) + 1, dtype=bool)
        self.first[np.searchsorted(self.pos, begins)] = True
        self.first[-1] = True

    def codepoints(self, index: np.ndarray) -> np.ndarray:
        """Codepoints of the multi-byte characters at the given character indices."""
        p = self.pos[index]
        b0, b1, b2, b3 = (self.data[p + k].astype(np.int32) for k in range(4))
        two = (b0 & 0x1F) << 6 | b1 & 0x3F
        three = (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F
        four = (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F
        return np.minimum(np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)), 0x10FFFF)


class Automaton:
    """A finite automaton and the functions that stretches of its symbols make of its state.

    rules: for each state and symbol, the next state and whether a slice begins
    at the symbol.  A text's first symbol is read in the state `fresh`, whatever
    came before it.
    """

    def __init__(self, rules: dict[str, dict[int, tuple[str, bool]]], fresh: str, symbols: int):
        number = {state: i for i, state in enumerate(rules)}
        step = np.array([[number[rules[q][a][0]] for a in range(symbols)] for q in rules], dtype=np.uint16)
        self.symbols, self.begins = symbols, np.array([[rules[q][a][1] for a in range(symbols)] for q in rules])
        letters = [tuple(step[:, a]) for a in range(symbols)] + [(step[number[fresh], a],) * len(rules) for a in range(symbols)]
        known = {f: i for i, f in enumerate(dict.fromkeys(letters))}
        functions = list(known)
        for f in functions:  # grows while functions that are new follow from those before
            for g in letters:
                h = tuple(g[q] for q in f)
                if h not in known:
                    known[h] = len(functions)
                    functions.append(h)
        table = np.array(functions, dtype=np.uint16)
        self.letter = np.array([known[f] for f in letters], dtype=np.uint16)
        self.then = np.array([[known[tuple(g[q] for q in f)] for g in functions] for f in functions], dtype=np.uint16)
        self.constant, self.value = (table == table[:, :1]).all(axis=1), table[:, 0]

    def slices(self, symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a slice begins at each symbol; first: whether a text does."""
        function = self.letter[symbol + self.symbols * first]
        reach, open_ = 1, np.flatnonzero(~self.constant[function])
        while len(open_):  # each function covers `reach` symbols up to its own
            function[open_] = self.then[function[open_ - reach], function[open_]]
            open_, reach = open_[~self.constant[function[open_]]], 2 * reach
        before = np.concatenate([[0], self.value[function[:-1]]])
        return first | self.begins[before, symbol]


# Symbols of the splitting patterns; white space is told apart by what follows it, apostrophes by the contraction they
# may begin, and letters by whether they are part of one. All but the last three alone settle the state.
_WHITE_INSIDE, _LAST_BLANK, _LAST_WHITE, _SHORT, _LONG, _TAIL, _SYMBOLS = 3, 4, 5, 6, 7, 8, 9
_ALL_WHITE, _ALL_OTHER = (_WHITE_INSIDE, _LAST_BLANK, _LAST_WHITE), (OTHER, _SHORT, _LONG)


def _pattern_symbols(block: Block) -> np.ndarray:
    n, symbol = len(block.pos), block.cls.copy()
    white = np.flatnonzero((block.cls == WHITE) | (block.cls == BLANK))
    after = np.minimum(white + 1, n - 1)
    inside = block.first[white + 1] | (block.cls[after] == WHITE) | (block.cls[after] == BLANK)
    symbol[white] = np.where(inside, _WHITE_INSIDE, np.where(block.cls[white] == BLANK, _LAST_BLANK, _LAST_WHITE))
    mark = np.flatnonzero(block.cls == APOSTROPHE)
    symbol[mark] = OTHER
    mark = mark[~block.first[mark + 1]]
    short = mark[np.isin(block.lead[mark + 1], np.frombuffer(b"stmd", dtype=np.uint8))]
    symbol[short], symbol[short + 1] = _SHORT, _TAIL
    mark = mark[mark + 2 < n]
    mark = mark[~block.first[mark + 2]]
    one, two = block.lead[mark + 1], block.lead[mark + 2]
    long = mark[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]
    symbol[long], symbol[long + 1], symbol[long + 2] = _LONG, _TAIL, _TAIL
    return symbol


def _rules(fresh: dict[int, str], goes_on: dict[str, dict[int, str]]) -> dict[str, dict[int, tuple[str, bool]]]:
    """fresh: state after a slice's first symbol; goes_on: symbols that do not begin a slice, by state. All others do."""
    return {q: {a: (own[a], False) if a in own else (to, True) for a, to in fresh.items()} for q, own in goes_on.items()}


@lru_cache(maxsize=1)
def _automata() -> dict[str, Automaton]:
    letters = {LETTER: "letters", _TAIL: "letters"}
    word = letters | dict.fromkeys(_ALL_OTHER, "others")
    contraction = {"one to come": {_TAIL: "done"}, "two to come": {_TAIL: "one to come"}, "done": {}}  # nothing else comes there
    begun = letters | {OTHER: "others", _SHORT: "one to come", _LONG: "two to come"}
    byte_level = _rules(
        begun | {NUMBER: "numbers", _WHITE_INSIDE: "white", _LAST_BLANK: "blank", _LAST_WHITE: "done"},
        {
            "letters": letters, "numbers": {NUMBER: "numbers"}, "others": dict.fromkeys(_ALL_OTHER, "others"), "white": {_WHITE_INSIDE: "white"},
            "blank": word | {NUMBER: "numbers"}, **contraction,
        },
    )
    lower_word = _rules(
        begun | {NUMBER: "done"} | dict.fromkeys(_ALL_WHITE, "white"),
        {"letters": letters, "others": dict.fromkeys(_ALL_OTHER, "others"), "white": dict.fromkeys(_ALL_WHITE, "white"), **contraction},
    )
    to = {0: "other", 1: "mark", 2: "line"}
    blank_unit = _rules(to, {"other": {0: "other"}, "mark": {0: "other", 1: "mark"}, "line": {}})
    return {
        "byte_level": Automaton(byte_level, "done", _SYMBOLS), "lower_word": Automaton(lower_word, "done", _SYMBOLS),
        "blank_unit": Automaton(blank_unit, "line", 3),
    }


def _byte_level(block: Block) -> np.ndarray:
    return _automata()["byte_level"].slices(_pattern_symbols(block), block.first[:-1])


def _lower_word(block: Block) -> np.ndarray:
    return _automata()["lower_word"].slices(_pattern_symbols(block), block.first[:-1])


def _blank_unit(block: Block) -> np.ndarray:
    """Units between which no piece with an inner word mark and no line break can merge."""
    symbol = (block.cls == BLANK).astype(np.uint8)
    wide = np.flatnonzero(block.lead == 0xE2)
    symbol[wide[block.codepoints(wide) == 0x2581]] = 1
    symbol[block.lead == 0x0A] = 2
    return _automata()["blank_unit"].slices(symbol, block.first[:-1])


SPLITTERS = {"byte_level": _byte_level, "lower_word": _lower_word, "blank_unit": _blank_unit}


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null text has none."""
    texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(raw, dtype=np.uint8)[low:high] if high > low else np.zeros(0, np.uint8), offsets - low


class Slices:
    """Slices of a block: distinct byte strings, which of them each slice is, and how many each document has."""

    def __init__(self, texts: pa.Array, splitter: str):
        data, offsets = utf8(texts)
        block = Block(data, offsets)
        self.starts = block.pos[SPLITTERS[splitter](block)] if len(data) else np.zeros(0, np.int64)
        self.doc_slices = np.searchsorted(self.starts, offsets)
        bounds = np.concatenate([self.starts, [len(data)]]).astype(np.int32)
        array = pa.Array.from_buffers(
            pa.binary(), len(self.starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = array.dictionary_encode()
        self.distinct = coded.dictionary
        self.index = coded.indices.to_numpy(zero_copy_only=False)
        self.doc_offsets = offsets


#: Bytes of one text that are held as arrays at a time.
LONG_BYTES = 8 << 20


def long_parts(texts: pa.Array, most: int | None = None) -> list[pa.Array]:
    """The array itself or, for one long text, arrays of one part each that are cut where no token or letter can reach over.

    Such a place is a blank or line break after a visible ASCII character.  A
    text without any is not cut.
    """
    most = most or LONG_BYTES
    if len(texts) != 1 or not texts.is_valid()[0].as_py():
        return [texts]
    data, _ = utf8(texts)
    cuts = [0]
    while len(data) - cuts[-1] > most:
        low = cuts[-1] + most // 2
        found = np.zeros(0, dtype=np.int64)
        while not len(found) and low < len(data):
            window = data[low - 1 : low + most // 2]
            before, here = window[:-1], window[1:]
            found = np.flatnonzero(((here == 0x20) | (here == 0x0A)) & (before > 0x20) & (before < 0x7F))
            low += most // 2
        if not len(found):
            break
        cuts.append(low - most // 2 + int(found[-1]))
    bounds = [*cuts, len(data)]
    return [pa.array([data[a:b].tobytes()], pa.binary()).cast(pa.string()) for a, b in zip(bounds, bounds[1:])]


def text_blocks(batch: pa.RecordBatch, column: str, most_bytes: int):
    """Slices of a batch whose texts hold about most_bytes together (a longer text is a block by itself)."""
    texts = batch.column(column)
    if len(texts) == 0:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        done = sizes[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(sizes, done + most_bytes, side="right")))
        yield batch.slice(row, end - row)
        row = end
