"""The commands on a small cohort of files."""

import gzip
import math
import random

import pytest

from spanforge.__main__ import main


def write(path, text):
    (path.write_bytes(gzip.compress(text.encode())) if path.suffix == ".gz" else path.write_text(text))
    return str(path)


@pytest.fixture
def domains(tmp_path):
    rows = [("chr1", 1000 * i, 1000 * i + 600, f"{'baseline' if i < 40 else 'other'}_{i}") for i in range(50)]
    bed = write(tmp_path / "d.bed", "".join(f"{c}\t{s}\t{e}\t{n}\t0\t+\n" for c, s, e, n in rows))
    return rows, bed


def sam(rows, each):
    out = ["@HD\tVN:1.6"]
    for chrom, start, _, name in rows:
        for k in range(each if name.startswith("baseline") else 3 * each):
            at = start + 10 + (7 * k) % 200
            for flags, place in ((99, at), (147, at + 150)):
                out.append(f"{name}.{k}\t{flags}\t{chrom}\t{place + 1}\t60\t100M\t=\t1\t0\t*\t*")
    random.Random(1).shuffle(out[1:])
    return "\n".join(out) + "\n"


def table(spark, path):
    return [tuple(r[0].split("\t")) for r in spark.read.text(path).collect()]


def test_coverage_and_correction(spark, tmp_path, domains):
    rows, bed = domains
    reads = write(tmp_path / "s.sam", sam(rows, 5))
    depth = str(tmp_path / "s_read_depth.bed")
    assert main(["coverage", "-r", bed, "-b", reads, "-o", depth], spark) == 0
    got = {n: float(d) for n, d in table(spark, depth)}
    assert got == {n: pytest.approx((5 if n.startswith("baseline") else 15) * 250 / 601, rel=1e-5) for _, _, _, n in rows}
    gc = write(tmp_path / "gc.txt", "".join(f"{n}\t{0.22 + 0.01 * (i % 45):.3f}\n" for i, (_, _, _, n) in enumerate(rows)))
    assert main(["gc-correct", depth, gc], spark) == 0
    result = table(spark, str(tmp_path / "s_gc_correct.txt"))
    assert result[0] == ("domain", "coverage", "percent.gc", "k.gc", "corrected.coverage") and len(result) == 51
    copies = {r[0]: float(r[4]) for r in result[1:]}
    assert all(v == pytest.approx(2, abs=1e-6) for n, v in copies.items() if n.startswith("baseline"))
    assert all(4 < v < 8 for n, v in copies.items() if n.startswith("other"))
    other = write(tmp_path / "x.txt", "baseline_1::chr1:1-2\t0.4\n")
    assert main(["gc-correct", depth, other, "-o", str(tmp_path / "none")], spark) == 1
    assert main(["coverage", "-r", bed, "-b", reads, "-o", str(tmp_path / "single"), "-p", "single", "--gzip"], spark) == 0
    assert sum(float(d) for _, d in table(spark, str(tmp_path / "single"))) == pytest.approx((40 * 5 + 10 * 15) * 200 / 601, rel=1e-4)
    lone = write(tmp_path / "lone.sam", "r\t0\tchr1\t1\t60\t9M\t*\t0\t0\t*\t*\n")
    assert main(["coverage", "-r", bed, "-b", lone, "-o", str(tmp_path / "lone")], spark) == 1


def test_composition(spark, tmp_path, domains):
    fasta = write(tmp_path / "g.fa", ">chr1\n" + "\n".join("ACGT" * 15 for _ in range(900)) + "\n")
    assert main(["build-gc-model", "-b", domains[1], "-f", fasta, "-o", str(tmp_path / "model")], spark) == 0
    assert sorted(table(spark, str(tmp_path / "model"))) == sorted((n, "0.5") for *_, n in domains[0])
    assert main(["gc-from-fasta", fasta, "-o", str(tmp_path / "whole")], spark) == 0
    assert table(spark, str(tmp_path / "whole")) == [("chr1", "0.5")]


def test_trimming_and_reports(spark, tmp_path, capsys):
    (tmp_path / "fastq" / "s").mkdir(parents=True)
    read = lambda i, q: f"@r{i}\n{'ACGT' * 25}\n+\n{q * 100}\n"
    one = write(tmp_path / "fastq" / "s" / "x_1.fastq.gz", "".join(read(i, "I") for i in range(8)))
    two = write(tmp_path / "fastq" / "s" / "x_2.fastq.gz", "".join(read(i, "#" if i < 2 else "I") for i in range(8)))
    log = str(tmp_path / "log")
    assert main(["trim", "-1", one, "-2", two, "-o", str(tmp_path / "out"), "--adapters", "none", "--log", log], spark) == 0
    assert spark.read.text(str(tmp_path / "out_1")).count() == 24
    assert sorted(t[1:] for t in table(spark, log)) == [("discarded", "2"), ("total", "8")]
    write(tmp_path / "t.txt", "fastq/s/f\ttotal\t8\nfastq/s/f\tdiscarded\t2\n")
    bed = write(tmp_path / "s_sorted.bed", "c\t1\t2\ta\nc\t1\t2\ta\nc\t3\t4\tb\n")
    assert main(["align-report", "-b", bed, "--sample", "s", "--report", str(tmp_path / "report")], spark) == 0
    assert main(["qc-report", "--trim-stats", str(tmp_path / "t.txt"), "--align-report", str(tmp_path / "report"), "-o", str(tmp_path / "qc")], spark) == 0
    written = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "qc")).collect()
    assert [(r["sample"], r.percent_filtered, r.aligned) for r in written] == [("s", "0.25", "2")]
    said = capsys.readouterr().out
    assert "0.25" in said and math.isclose(2 / 8, 0.25)


def test_selection_and_settings(spark, tmp_path, capsys):
    def row(sample, centre, reads):
        return "\t".join([f"{sample}_2.fastq.gz", *["x"] * 4, centre, "x", "x", "x", sample, "P", *["x"] * 3, f"lib{reads}", "x", "x", "300", "PAIRED", "p", "0", "NA", "NA", str(reads), "9", "exome"])

    index = write(tmp_path / "i.tsv", "\n".join(["\t".join(["FASTQ_FILE", *["h"] * 25]), row("a", "SC", 5), row("a", "SC", 9), row("b", "SC", 7), row("c", "SC", 8)]) + "\n")
    failed, liked = write(tmp_path / "failed", "c\n"), write(tmp_path / "liked", "b\n")
    assert main(["select-samples", "--index", index, "--failed", failed, "--of-interest", liked, "--centres", "SC", "--quota", "2", "-o", str(tmp_path / "chosen")], spark) == 0
    assert [t[0] for t in table(spark, str(tmp_path / "chosen"))[1:]] == ["b", "a"]
    lines = [x for x in capsys.readouterr().out.splitlines() if "|P" in x]
    assert [x.split("|")[1].strip() for x in lines] == ["b", "a"]
    assert main(["init", "--output", str(tmp_path / "p.toml")], spark) == 0
    from spanforge.sources.project import load_project

    assert load_project(str(tmp_path / "p.toml")).options.min_length == 80
    with pytest.raises(FileExistsError):
        main(["init", "--output", str(tmp_path / "p.toml")], spark)


def test_last_of_a_name_and_order_of_rows(spark, tmp_path, domains):
    """A name that comes twice in the composition table has its last value; rows keep the order of the depth file."""
    rows, _ = domains
    names = [n for _, _, _, n in rows][::-1]
    depth = write(tmp_path / "d_read_depth.bed", "".join(f"{n}\t{1 + k % 5}\n" for k, n in enumerate(names)))
    gc = write(tmp_path / "gc.txt", "".join(f"{n}\t0.9\n" for n in names) + "".join(f"{n}\t{0.22 + 0.01 * (i % 45):.2f}\n" for i, n in enumerate(names)))
    assert main(["gc-correct", depth, gc], spark) == 0
    result = table(spark, str(tmp_path / "d_gc_correct.txt"))[1:]
    assert [r[0] for r in result] == names and [r[2] for r in result][:3] == ["0.22", "0.23", "0.24"]


def test_run_of_a_project(spark, tmp_path, domains):
    """Two samples that work, one without a proper pair and one that is not there."""
    rows, bed = domains
    folder = tmp_path / "alignments"
    folder.mkdir()
    for name, pairs in (("a", 5), ("b_sorted", 7), ("unlisted", 5)):
        write(folder / f"{name}.sam", sam(rows, pairs))
    write(folder / "lone.sam", "r\t0\tchr1\t1\t60\t9M\t*\t0\t0\t*\t*\n")
    gc = write(tmp_path / "gc.txt", "".join(f"{n}\t{0.22 + 0.01 * (i % 45):.3f}\n" for i, (_, _, _, n) in enumerate(rows)))
    settings = f'samples = ["a", "b", "lone", "absent"]\n[reference]\ndomains = "{bed}"\ngc_table = "{gc}"\n[paths]\n'
    settings += "".join(f'{k} = "{tmp_path / k}"\n' for k in ("alignments", "results", "logs"))
    assert main(["run", write(tmp_path / "p.toml", settings)], spark) == 0
    status = [tuple(r) for r in spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "logs" / "status")).collect()]
    assert status == [("a", "done", "50"), ("absent", "coverage", "0"), ("b", "done", "50"), ("lone", "coverage", "0")]
    one = str(tmp_path / "one")
    assert main(["coverage", "-r", bed, "-b", str(folder / "b_sorted.sam"), "-o", one], spark) == 0
    assert sorted(table(spark, str(tmp_path / "results" / "read_depth" / "sample=b"))) == sorted(table(spark, one))
    assert len(table(spark, str(tmp_path / "results" / "corrected" / "sample=a"))) == 50
