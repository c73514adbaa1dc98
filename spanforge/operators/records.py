"""Loading delimited records and setting apart, with the reason, those that fail to parse."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a sequence index.
INDEX_COLUMNS = (
    "fastq_file md5 run_id study_id study_name center_name submission_id submission_date sample_id sample_name population "
    "experiment_id instrument_platform instrument_model library_name run_name run_block_name insert_size library_layout "
    "paired_fastq withdrawn withdrawn_date comment read_count base_count analysis_group"
).split()
#: Lines and bytes that are first parsed together.
BLOCK_LINES, BLOCK_BYTES = 4096, 8 << 20
_GREATEST = str(2**63 - 1)
# One field: quoted, or not beginning with a quote and without a line break.
_FIELD = r'(?:"(?:[^"]|"")*"|[^"\t\n][^\t\n]*)?'
_WELL_QUOTED = rf"\A{_FIELD}(?:\t{_FIELD})*\z"


def _count_like(column: pa.Array) -> pa.Array:
    """Empty, NA or digits up to the greatest 64-bit integer, without surrounding blanks."""
    bare = pc.utf8_trim(column, " ")
    digits = pc.utf8_ltrim(bare, "0")
    width = pc.utf8_length(digits)
    fits = pc.or_(pc.less(width, 19), pc.and_(pc.equal(width, 19), pc.less_equal(digits, _GREATEST)))
    number = pc.and_(pc.match_substring_regex(bare, "^[0-9]+$"), fits)
    return pc.or_(number, pc.is_in(bare, pa.array(["", "NA"])))


def _flag_like(column: pa.Array) -> pa.Array:
    return pc.is_in(pc.utf8_trim(column, " "), pa.array(["", "NA", "0", "1"]))


def _is_count(text: str) -> bool:
    bare = text.strip(" ")
    digits = bare.lstrip("0")
    number = bare.isascii() and bare.isdigit() and (len(digits) < 19 or len(digits) == 19 and digits <= _GREATEST)
    return number or bare in ("", "NA")


def _is_flag(text: str) -> bool:
    return text.strip(" ") in ("", "NA", "0", "1")


#: Columns with a rule for all values and for one, in the order in which their failures are named.
INDEX_RULES: dict[str, tuple[Callable[[pa.Array], pa.Array], Callable[[str], bool]]] = {
    "insert_size": (_count_like, _is_count), "read_count": (_count_like, _is_count), "withdrawn": (_flag_like, _is_flag),
}


def parse_block(lines: pa.Array, columns: list[str], wanted: list[str]) -> pa.Table | None:
    """The wanted columns of all lines at once by a columnar CSV parser; None if any line is no record of these columns."""
    data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")[0].as_buffer()
    try:
        table = pcsv.read_csv(
            pa.BufferReader(data),
            read_options=pcsv.ReadOptions(column_names=columns, use_threads=False, block_size=data.size + 1024),
            parse_options=pcsv.ParseOptions(delimiter="\t", newlines_in_values=True, ignore_empty_lines=False),
            convert_options=pcsv.ConvertOptions(
                column_types=dict.fromkeys(wanted, pa.string()), include_columns=wanted, strings_can_be_null=False, check_utf8=False
            ),
        )
    except pa.ArrowInvalid:
        return None
    return table if len(table) == len(lines) else None


def fields_of(line: str) -> list[str] | None:
    """Fields of one line; None if a quoted field is not closed or is followed by text."""
    fields, at = [], 0
    while True:
        if line.startswith('"', at):
            end = at + 1
            while (end := line.find('"', end)) >= 0 and line.startswith('""', end):
                end += 2
            if end < 0:
                return None
            fields.append(line[at + 1 : end].replace('""', '"'))
            end += 1
            if end < len(line) and line[end] != "\t":
                return None
        else:
            end = line.find("\t", at)
            end = len(line) if end < 0 else end
            fields.append(line[at:end])
        if end >= len(line):
            return fields
        at = end + 1


def diagnose(line: str, columns: list[str], rules: dict) -> tuple[str | None, list[str] | None]:
    """Reason of failure, or the fields of a sound record."""
    fields = fields_of(line)
    if fields is None:
        return "quoting", None
    if len(fields) != len(columns):
        return "columns", None
    for c, (_, sound) in rules.items():
        if not sound(fields[columns.index(c)]):
            return c, None
    return None, fields


def _blocks(index: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of about BLOCK_LINES lines or BLOCK_BYTES bytes."""
    after, found, a = np.cumsum(sizes[index]), [], 0
    while a < len(index):
        b = int(np.searchsorted(after, (after[a - 1] if a else 0) + BLOCK_BYTES, side="right"))
        b = min(max(b, a + 1), a + BLOCK_LINES, len(index))
        found.append((a, b))
        a = b
    return found


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _mask(array: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return array.to_numpy() if isinstance(array, pa.ChunkedArray) else array.to_numpy(zero_copy_only=False)


def parse_lines(
    lines: pa.Array, columns: list[str], rules: dict, wanted: list[str] | None = None
) -> Iterator[tuple[np.ndarray, str | None, pa.Table | None, bool]]:
    """(numbers of the lines, reason, table of the wanted columns, whether looked at strictly); every line is in one of them.

    Masks over all lines set apart those that cannot be parsed: broken quoting,
    which the parser is lenient about, carriage returns and unquoted line
    breaks, which it takes for a line's end, and lines without quotes that have
    another number of separators.  The rest is parsed in blocks, and a block
    that fails is halved until its failing lines stand alone.  Only lines so
    isolated are looked at strictly, and those whose values break a rule, which
    masks over the parsed columns find.
    """
    wanted = list(columns) if wanted is None else wanted
    needed = list(dict.fromkeys([*wanted, *rules]))
    returned, broken, quoted = (_mask(pc.match_substring(lines, x)) for x in ("\r", "\n", '"'))
    marked = np.flatnonzero(returned | broken | quoted)
    ill = returned.copy()
    ill[marked] |= ~_mask(pc.match_substring_regex(lines.take(pa.array(marked)), _WELL_QUOTED))
    plain = np.ones(len(lines), dtype=bool)
    plain[marked] = False
    ill |= plain & ~_mask(pc.equal(pc.count_substring(lines, "\t"), len(columns) - 1))
    sizes = _mask(pc.binary_length(lines)).astype(np.int64) + 1
    pending = [part[a:b] for part in (np.flatnonzero(plain & ~ill), np.flatnonzero(~plain & ~ill)) for a, b in _blocks(part, sizes)]
    pending += [np.array([i]) for i in np.flatnonzero(ill)]
    while pending:
        index = pending.pop()
        table = None if ill[index].any() else parse_block(lines.take(pa.array(index)), columns, needed)
        if table is None and len(index) > 1:
            middle = len(index) // 2
            pending += [index[middle:], index[:middle]]
            continue
        bad = index
        if table is not None:
            sound = np.ones(len(index), dtype=bool)
            for c, (rule, _) in rules.items():
                sound &= _mask(rule(table.column(c)))
            if sound.any():
                yield index[sound], None, table.select(wanted).filter(pa.array(sound)), False
            bad = index[~sound]
        for i in bad:
            reason, fields = diagnose(lines[int(i)].as_py(), columns, rules)
            found = None if fields is None else pa.table({c: pa.array([fields[columns.index(c)]], pa.string()) for c in wanted})
            yield np.array([i]), reason, found, True


def parsed_records(
    df: DataFrame,
    line: str = "line",
    columns: list[str] = INDEX_COLUMNS,
    rules: dict = INDEX_RULES,
    header: str = "FASTQ_FILE",
    keep: list[str] | None = None,
    records: bool = True,
) -> DataFrame:
    """keep, reason and, if wanted, record (a struct of texts) of every line that is a record or fails to be one.

    reason is null for a sound record, otherwise the first that applies of
    `quoting`, `columns` and the names of the rules; record is then null.  Null
    and empty lines and header lines are left out.  One carriage return at the
    end of a line is not part of it.  Narrow: one Arrow pass, no shuffle, so
    repeated lines are all given and order and skew do not matter.
    """
    keep = [c for c in df.columns if c not in (line, "reason", "record")] if keep is None else keep
    bare = F.regexp_replace(F.col(f"`{line}`"), r"\r\z", "")
    first = F.split_part(bare, F.lit("\t"), F.lit(1))
    source = df.select(*[F.col(f"`{c}`") for c in keep], bare.alias("__line")).where((F.col("__line") != "") & ~first.isin(header, f'"{header}"'))
    columns = list(columns)
    kind = pa.struct([(c, pa.string()) for c in columns])
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField("reason", T.StringType())])
    if records:
        schema.add("record", T.StructType([T.StructField(c, T.StringType()) for c in columns]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = np.full(batch.num_rows, None, dtype=object)
            order, parts = [], []
            for index, reason, found, _ in parse_lines(batch.column("__line"), columns, rules, columns if records else []):
                if reason is not None:
                    reasons[index] = reason
                elif records:
                    order.append(index)
                    parts.append(found)
            arrays = [batch.column(c) for c in keep] + [pa.array(reasons, pa.string())]
            if records:
                place = np.full(batch.num_rows, -1)
                if order:
                    place[np.concatenate(order)] = np.arange(sum(map(len, order)))
                found = pa.concat_tables([pa.table({c: pa.array([], pa.string()) for c in columns}), *parts]).combine_chunks()
                struct = pa.StructArray.from_arrays([_whole(found.column(c)) for c in columns], fields=list(kind))
                arrays.append(struct.take(pa.array(place, mask=place < 0)))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "reason"] + ["record"] * records)

    return source.mapInArrow(run, schema)
