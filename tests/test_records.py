import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanforge.operators.records import INDEX_COLUMNS, INDEX_RULES, diagnose, fields_of, parse_lines, parsed_records

GOOD = "\t".join(["f", *["x"] * 16, "300", "PAIRED", "p", "0", "NA", "c", "1000", "2", "exome"])


def changed(i, value):
    cells = GOOD.split("\t")
    cells[i] = value
    return "\t".join(cells)


CASES = {
    GOOD: None,
    changed(22, '"two\twords"'): None,
    changed(22, '"two\nlines"'): None,
    changed(22, '""""'): None,
    changed(22, 'a 4" mark'): None,
    changed(17, ' "" '.strip()): None,
    changed(17, '" 12 "'): None,
    changed(17, "NA"): None,
    changed(23, "9223372036854775807"): None,
    changed(23, "0009223372036854775807"): None,
    changed(20, " 1 "): None,
    changed(22, '"open'): "quoting",
    changed(22, '"closed" then'): "quoting",
    changed(17, '"') + '"': "columns",  # one quoted field to the end
    GOOD + "\tmore": "columns",
    "a\tb": "columns",
    " ": "columns",
    changed(17, "12.5"): "insert_size",
    changed(17, "-1"): "insert_size",
    changed(23, "9223372036854775808"): "read_count",
    changed(23, "١٢"): "read_count",
    changed(23, "1 "): "read_count",
    changed(20, "2"): "withdrawn",
    changed(20, "true"): "withdrawn",
    changed(17, "x").replace("1000", "y"): "insert_size",
}


def test_each_case_alone():
    for line, reason in CASES.items():
        assert diagnose(line, INDEX_COLUMNS, INDEX_RULES)[0] == reason, line


def parsed(lines, columns=INDEX_COLUMNS, rules=INDEX_RULES):
    """Reason, record and whether looked at strictly, of each line."""
    out = [None] * len(lines)
    for index, reason, table, strict in parse_lines(pa.array(lines, pa.string()), columns, rules):
        records = [None] * len(index) if table is None else table.to_pylist()
        for i, record in zip(index, records, strict=True):
            assert out[i] is None
            out[i] = (reason, record, strict)
    return out


def test_blocks_give_what_single_lines_give():
    lines = [line for k in range(60) for line in list(CASES)[k % 7 :]] + [GOOD] * 2000
    assert [r for r, _, _ in parsed(lines)] == [CASES[line] for line in lines]


def test_sound_lines_are_parsed_in_blocks():
    lines = [line for k in range(400) for line in [*CASES, *[GOOD] * 60]]
    found = parsed(lines)
    sound = [strict for reason, _, strict in found if reason is None]
    assert [r for r, _, _ in found] == [CASES[line] for line in lines]
    assert len(sound) > 24_000 and not any(sound)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_sound_lines_of_the_test_table_are_parsed_in_blocks():
    column = pq.read_table("/root/testdata/sf0.01/index_raw.parquet").column("line").to_pylist()
    lines = [x.removesuffix("\r") for x in column if x and x.removesuffix("\r") and not x.startswith("FASTQ_FILE\t")]
    found = parsed(lines)
    sound = [strict for reason, _, strict in found if reason is None]
    assert len(sound) > 1200 and sum(sound) <= 0.01 * len(sound)
    assert sum(strict for _, _, strict in found) <= 0.1 * len(lines)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet='a"\t\n\r1', min_size=1, max_size=9), min_size=1, max_size=30))
def test_columnar_path_agrees_with_the_strict_one(lines):
    columns = ["a", "b"]
    for line, (reason, record, _) in zip(lines, parsed(lines, columns, {}), strict=True):
        fields = fields_of(line)
        assert reason == ("quoting" if fields is None else "columns" if len(fields) != 2 else None)
        assert record == (dict(zip(columns, fields)) if reason is None else None)


def test_operator(spark, rows):
    header = "FASTQ_FILE\t" + "\t".join("x" * 25)
    lines = [None, "", "\r", header, GOOD, GOOD + "\r", GOOD + "\r\r", "short", changed(22, "y" * 1_000_000), GOOD]
    df = spark.createDataFrame(list(enumerate(lines)), "line_id int, line string").selectExpr("*", "'mine' reason", "line_id record")
    got = parsed_records(df)
    assert rows(got, "line_id", "reason") == [(4, None), (5, None), (6, None), (7, "columns"), (8, None), (9, None)]
    assert got.where("line_id = 5").first().record.analysis_group == "exome"
    assert got.where("line_id = 8").selectExpr("length(record.comment)").first()[0] == 1_000_000
    assert rows(parsed_records(df.limit(0))) == []
    assert rows(parsed_records(df, keep=["line_id"], records=False).where("reason is not null")) == [(7, "columns")]
