import gzip
import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from spanforge.operators.records import INDEX_COLUMNS
from spanforge.sources import alignments, files, lines, project, sequences, sinks


def text(path, content, packed=False):
    path.write_bytes(gzip.compress(content.encode()) if packed else content.encode())
    return str(path)


def test_lines(spark, rows, tmp_path):
    many = "\n".join(f"line {i}" for i in range(5000)) + "\n"
    plain, packed = text(tmp_path / "a.txt", many), text(tmp_path / "b.txt.gz", many, True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = lines.numbered_lines(spark, [plain, packed])
        assert got.where("value <> concat('line ', line_no)").count() == 0 and got.count() == 10_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "odd").mkdir()
    text(tmp_path / "odd" / "named.txt", "x\ny\n", True)
    text(tmp_path / "odd" / "plain.gz", "z")
    assert rows(lines.sniffed_lines(spark, str(tmp_path / "odd")), "line_no", "value") == [(0, "x"), (0, "z"), (1, "y")]
    (tmp_path / "bad.gz").write_bytes(gzip.compress(many.encode())[:-200])
    with pytest.raises(Exception):
        lines.text_lines(spark, str(tmp_path / "bad.gz")).collect()


def test_parsers(spark, rows):
    df = spark.createDataFrame([("c\t1\t9\tn\t5\t+",), ("c\t1\t9",), ("c\tx\t9",), ("c\t1",), (None,), ("",)], "value string")
    assert rows(lines.intervals(df)) == [("c", 1, 9, ""), ("c", 1, 9, "n\t5\t+")]
    assert rows(lines.regions(df)) == [("n", "c", 1, 9)]
    pair = "\t".join(["a", "1", "x", "b", "3", "4", "n", "5", "+", "-"])
    assert rows(lines.pair_rows(spark.createDataFrame([(pair,), ("a\t1",)], "value string")).drop("line")) == [("a", 1, 0, "b", 3, 4, "n", "5", "+", "-")]
    numbers = spark.createDataFrame([("d\t 0.5 ",), ("head\tvalue",), ("alone",)], "value string")
    assert rows(lines.number_pairs(numbers, ("domain", "gc"))) == [("d", 0.5)]
    assert rows(lines.name_list(spark.createDataFrame([(" a ",), ("",), ("a",), (None,)], "value string"))) == [("a",)]
    wide = spark.createDataFrame([("\t".join(["c", "1", "9", "n", "0", "+", ".", "-1", "-1", ".", "-1", ".", "0"]),), ("c\t1",)], "value string")
    assert rows(lines.overlap_rows(wide)) == [("n", 1, 9, "c", 0)]
    log = spark.createDataFrame([("fastq/s/f\ttotal\t5",), ("f\ttotal\tx",), ("f",)], "value string")
    assert rows(lines.trim_log(log)) == [("fastq/s/f", "total", 5)]
    clean = spark.createDataFrame([("correct number of reads for:\ts\tbed\tremoving:\tbam",), ("other\ts\tbed",)], "value string")
    assert rows(lines.clean_log(clean)) == [("s", "bed")]
    assert rows(lines.align_log(spark.createDataFrame([("HG1_sorted.bed 12",), ("x",)], "value string"))) == [("HG1", 12)]


RECORDS = [("r1", 99, 0, 10, 60, [(50, 0)]), ("r1", 147, 1, 5, 30, [(10, 4), (40, 0)]), ("r2", 4, -1, -1, 0, []), ("r3", 0, 0, 7, 9, [(20, 0), (5, 2), (30, 0)]), ("r4", 0, 0, 7, 9, [(25, 0), (100, 3), (25, 0)])]
EXPECTED = [("r1", 99, "chr1", 10, 60, 60), ("r1", 147, "chr10", 5, 45, 30), ("r2", 4, None, -1, -1, 0), ("r3", 0, "chr1", 7, 62, 9), ("r4", 0, "chr1", 7, 157, 9)]


def bam(records, piece=60, level=6, closed=True):
    out = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for name in (b"chr1\0", b"chr10\0"):
        out += struct.pack("<i", len(name)) + name + struct.pack("<i", 1000)
    for name, flags, ref, at, mapq, cigar in records:
        n = name.encode() + b"\0"
        body = struct.pack("<iiBBHHHiiii", ref, at, len(n), mapq, 0, len(cigar), flags, 0, -1, -1, 0) + n
        body += b"".join(struct.pack("<I", size << 4 | op) for size, op in cigar)
        out += struct.pack("<i", len(body)) + body
    packed = b""
    for p in [out[i : i + piece] for i in range(0, len(out), piece)] + [b""] * closed:
        z = zlib.compressobj(level if p else 6, zlib.DEFLATED, -15)
        body = z.compress(p) + z.flush()
        packed += struct.pack("<4sIBBH2sHH", b"\x1f\x8b\x08\x04", 0, 0, 255, 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(p), len(p))
    return packed


def test_bam_and_sam(spark, rows, tmp_path):
    (tmp_path / "x.bam").write_bytes(bam(RECORDS))
    got = alignments.bam_alignments(spark, str(tmp_path / "x.bam"))
    assert [tuple(r) for r in got.orderBy("ord").drop("file", "ord").collect()] == EXPECTED
    names, ops = ["chr1", "chr10"], "MIDNSHP=X"
    sam = "@HD\tVN:1.6\n" + "".join(
        "\t".join([n, str(f), names[r] if r >= 0 else "*", str(at + 1), str(q), "".join(f"{s}{ops[o]}" for s, o in c) or "*", "*", "0", "0", "*", "*", "NM:i:0"]) + "\n"
        for n, f, r, at, q, c in RECORDS
    )
    got = alignments.sam_alignments(spark, text(tmp_path / "x.sam", sam))
    assert rows(got.drop("file", "ord")) == sorted(EXPECTED, key=repr)
    (tmp_path / "lost.bam").write_bytes(bam([("r", 0, -1, -1, 0, [])]))
    with pytest.raises(Exception, match="without a reference"):
        alignments.bam_alignments(spark, str(tmp_path / "lost.bam")).collect()
    with pytest.raises(Exception, match="without a reference"):
        alignments.sam_alignments(spark, text(tmp_path / "y.sam", "r\t0\t*\t0\t0\t*\t*\t0\t0\t*\t*\n")).collect()
    (tmp_path / "none.bam").write_bytes(bam([]))
    assert alignments.bam_alignments(spark, str(tmp_path / "none.bam")).count() == 0


def many(n):
    return [(f"read{i}", [99, 147, 4][i % 3], -1 if i % 3 == 2 else i % 2, -1 if i % 3 == 2 else i, i % 61, [] if i % 3 == 2 else [(10 + i % 90, 0), (i % 7, 1), (5, 2)]) for i in range(n)]


@pytest.mark.parametrize("piece, ahead", [(70, 1 << 18), (333, 1 << 18), (5000, 1 << 14)])
def test_ranges_of_a_bam_file_give_every_record_once(spark, tmp_path, monkeypatch, piece, ahead):
    """Wherever a file is divided, and however its records lie in blocks; one record is longer than a range looks ahead."""
    monkeypatch.setattr(alignments, "LOOK_AHEAD", ahead)
    records = many(700) + [("long" + "x" * 200, 0, 0, 5, 1, [(1, 0)] * 9000)] + many(50)
    path = str(tmp_path / "x.bam")
    (tmp_path / "x.bam").write_bytes(bam(records, piece))
    whole = [r for b in alignments.bam_batches(path, 0, 1 << 60) for r in b.to_pylist()]
    assert [r["name"] for r in whole] == [r[0] for r in records]
    assert [r["end"] - r["start"] for r in whole if r["name"] == "read7"] == [22, 22]
    size = (tmp_path / "x.bam").stat().st_size
    for split in (97, 1000, 4096, size // 3):
        parts = [r for a in range(0, size, split) for b in alignments.bam_batches(path, a, min(a + split, size)) for r in b.to_pylist()]
        assert parts == whole, split
    small = [r for b in alignments.bam_batches(path, 0, 1 << 60, most=500) for r in b.to_pylist()]
    assert small == whole
    got = alignments.bam_alignments(spark, path, split=size // 5)
    assert got.rdd.getNumPartitions() >= 5 and [r.name for r in got.orderBy("ord").collect()] == [r[0] for r in records]
    assert alignments.bam_counts(spark, path).first().records == len(records)


def test_a_bam_file_that_lost_its_end_fails(tmp_path):
    records, path = many(300), str(tmp_path / "x.bam")
    good = bam(records, 400)
    for content in (good[:-28], good[:-1], good[:-3000], bam(records, 400, closed=False), good[: len(good) // 2]):
        (tmp_path / "x.bam").write_bytes(content)
        with pytest.raises(ValueError):
            list(alignments.bam_batches(path, 0, 1 << 60))
        with pytest.raises(ValueError):
            for a in range(0, len(content), 900):
                list(alignments.bam_batches(path, a, min(a + 900, len(content))))


def test_sequences(spark, rows, tmp_path):
    fasta = text(tmp_path / "g.fa", "lost\nACGT\n>a one\nAC\nGT\n>b\n\n>a again\nNN\n>c\r\nGG\r\n")
    assert rows(sequences.fasta_records(spark, fasta)) == [("a", "ACGT"), ("a", "NN"), ("b", ""), ("c", "GG")]
    fastq = text(tmp_path / "r.fastq.gz", "".join(f"@id{i} x\nAC{i}\n+\n@I{i}\n" for i in range(7)), True)
    got = sequences.fastq_records(spark, fastq)
    assert rows(got, "record", "id", "seq", "qual") == [(i, f"id{i}", f"AC{i}", f"@I{i}") for i in range(7)]
    assert sequences.fastq_pairs(got, got).count() == 7
    assert sequences.fastq_count(lines.text_lines(spark, fastq)).first().reads == 7
    cells = ["f_1.fastq.gz"] + ["x"] * 16 + ["300", "PAIRED", "p", "0", "NA", "", "12", "NA", "exome"]
    index = text(tmp_path / "i.tsv", "\t".join(["FASTQ_FILE", *["h"] * 25]) + "\n" + "\t".join(cells) + "\nshort\n")
    row = sequences.index_records(spark, index).collect()
    assert len(row) == 1 and (row[0].insert_size, row[0].read_count, row[0].base_count, row[0].withdrawn, row[0].mate, row[0].withdrawn_date) == (300, 12, None, False, 1, None)
    assert len(INDEX_COLUMNS) == 26


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_contigs_from_their_lines(spark, rows, tmp_path, monkeypatch, block):
    import random

    from spanforge.operators.gc import contig_chunks, region_sequences

    monkeypatch.setattr(sequences, "BLOCK_LINES", block)
    draw = random.Random(4)
    contigs = {f"c{k}": "".join(draw.choice("ACGTn") for _ in range(n)) for k, n in enumerate((0, 1, 59, 60, 61, 437))}
    lines_of = lambda s: [s[i : i + 20] for i in range(0, len(s), 20)]
    content = "lost\n" + "".join(f">{n} more\n" + "".join(x + "\n" for x in lines_of(s)) for n, s in contigs.items())
    fasta = text(tmp_path / "g.fa", content)
    got = sequences.fasta_lines(spark, fasta)
    assert rows(got.where("seq <> ''"), "name", "start", "seq") == sorted([(n, 20 * k, x) for n, s in contigs.items() for k, x in enumerate(lines_of(s))], key=repr)
    assert {r.name for r in got.collect()} == set(contigs)
    whole = spark.createDataFrame(list(contigs.items()), "contig string, seq string")
    for size in (7, 64, 1 << 16):
        assert rows(sequences.fasta_chunks(spark, fasta, size)) == rows(contig_chunks(whole, size))
    regions = spark.createDataFrame([(f"r{i}", f"c{draw.randrange(7)}", a, a + draw.randrange(1, 90)) for i in range(60) for a in [draw.randrange(0, 430)]], "name string, chrom string, start long, end long")
    at, index = len("lost\n"), []
    for n, s in contigs.items():
        at += len(f">{n} more\n")
        index.append(f"{n}\t{len(s)}\t{at}\t20\t21\n")
        at += len(s) + len(lines_of(s))
    fai = sequences.fasta_index(spark, text(tmp_path / "g.fa.fai", "".join(index)))
    expected = [r for r in rows(region_sequences(regions, contig_chunks(whole, 64), 64)) if r[-1]]  # a region past the end has no row here
    assert rows(sequences.indexed_sequences(regions, fai, fasta)) == expected and len(expected) > 10


def test_files(spark, rows, tmp_path):
    d = tmp_path / "d"
    d.mkdir()
    a = text(d / "a.bed", "x\ny\n")
    text(d / "b.bed.gz", "z\n", True)
    assert [r.path.rsplit("/", 1)[1] for r in files.gathered(spark, str(d), ".bed").collect()] == ["b.bed.gz"]
    digest = files.digests(spark, a).first()
    assert (digest.bytes, digest.lines, digest.sha256) == (4, 2, hashlib.sha256(b"x\ny\n").hexdigest())
    expected = spark.createDataFrame([("ftp://h/a.bed", hashlib.md5(b"x\ny\n").hexdigest().upper()), ("ftp://h/b.bed.gz", "0"), ("ftp://h/c", "0")], "file string, md5 string")
    found = rows(files.line_counts(lines.text_lines(spark, str(d)), expected), "file", "lines")
    assert found == [("ftp://h/a.bed", 2), ("ftp://h/b.bed.gz", 1), ("ftp://h/c", None)]
    assert rows(files.verified(files.digests(spark, str(d)), expected), "state") == [("absent",), ("differs",), ("ok",)]


def test_sinks(spark, rows, tmp_path):
    depth = spark.createDataFrame([("a", 0.594059405), ("b", 2.0)], "name string, depth double")
    sinks.write_read_depth(depth, str(tmp_path / "d"), compress=True, single=True)
    assert rows(spark.read.text(str(tmp_path / "d"))) == [("a\t0.594059",), ("b\t2",)]
    table = spark.createDataFrame([("a", 1.0, 0.345, 1.0, None)], "domain string, coverage double, percent_gc double, k_gc double, corrected_coverage double")
    sinks.write_corrected(table, str(tmp_path / "c"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "c")).collect()] == ["domain\tcoverage\tpercent.gc\tk.gc\tcorrected.coverage", "a\t1\t0.345\t1\tNA"]
    bed = spark.createDataFrame([("c", 1, 2, "n", 3, "+")], "chrom string, start long, end long, name string, score int, strand string")
    sinks.write_intervals(bed, str(tmp_path / "b"))
    assert rows(spark.read.text(str(tmp_path / "b"))) == [("c\t1\t2\tn\t3\t+",)]
    pairs = spark.createDataFrame([("c", 1, 2, "d", 3, 4, "n", 5, "+", "-")], "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, name string, score int, strand1 string, strand2 string")
    sinks.write_pairs(pairs, str(tmp_path / "p"))
    assert rows(spark.read.text(str(tmp_path / "p"))) == [("c\t1\t2\td\t3\t4\tn\t5\t+\t-",)]
    fasta = spark.createDataFrame([("n", "c", 1, 3, "AC")], "name string, chrom string, start long, end long, seq string")
    sinks.write_fasta(fasta, str(tmp_path / "f"), with_place=True)
    assert rows(sequences.fasta_records(spark, str(tmp_path / "f"))) == [("n::c:1-3", "AC")]
    log = spark.createDataFrame([("fastq/s/f", 10, 7)], "file string, pairs_in long, pairs_out long")
    for _ in range(2):
        sinks.append_trim_log(log, str(tmp_path / "l"))
    assert rows(lines.trim_log(spark.read.text(str(tmp_path / "l"))).groupBy("kind").agg(F.sum("reads"))) == [("discarded", 6), ("total", 20)]
    assert sinks.corrected_name("s_read_depth.bed.gz") == "s_gc_correct.txt.gz" and sinks.corrected_name("x") == "x"
    assert sinks.packed_name("a.bed.gz", True) == "a.bed.gz" and sinks.packed_name("a.bed.gz", False) == "a.bed"


def test_project(tmp_path):
    good = '[reference]\ndomains = "d.bed"\ngc_table = "g.txt"\n[options]\npaired = false\n'
    p = project.load_project(text(tmp_path / "p.toml", 'samples = ["a", "b"]\n' + good))
    assert p.samples == ["a", "b"] and not p.options.paired and p.paths.logs == "logs"
    with pytest.raises(FileNotFoundError):
        p.check_reference()
    for bad in ('samples = ["a", "a"]\n' + good, good + "speed = 3\n", "[other]\n"):
        with pytest.raises(ValueError):
            project.load_project(text(tmp_path / "q.toml", bad))
    assert project.shell_samples("x=1\nSAMPLES=(\n a\n\n b \n)\nc\n") == ["a", "b"]
