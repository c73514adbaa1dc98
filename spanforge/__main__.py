"""python -m spanforge COMMAND ...: the chains and reports on files."""

from __future__ import annotations

import argparse
import functools
import glob as globbing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.checkpoints import cut
from spanforge.functions.names import sample_of
from spanforge.functions.numbers import as_awk, as_general
from spanforge.operators import gc, logs, selection, trimming
from spanforge.operators.fragments import NoProperPairs
from spanforge.plans import pipeline
from spanforge.sources import alignments, files, lines, project, sequences, sinks

TEMPLATE = """samples = []

[reference]
domains = "domains.bed"
gc_table = "domains_gc.txt"

[paths]
fastq = "fastq"
alignments = "alignments"
results = "results"
logs = "logs"

[options]
paired = true
quality_cutoff = 10
min_length = 80
compress = false
"""


def _alignments(spark: SparkSession, path: str) -> DataFrame:
    return (alignments.sam_alignments if path.endswith((".sam", ".sam.gz")) else alignments.bam_alignments)(spark, path)


def _regions(spark: SparkSession, path: str) -> DataFrame:
    return lines.regions(lines.text_lines(spark, path))


def _gc_lines(counts: DataFrame):
    return sinks.tabbed(F.col("name"), as_general(gc.gc_fraction(F.col("gc"), F.col("length"))))


def coverage(spark: SparkSession, a: argparse.Namespace) -> None:
    rows, domains = _alignments(spark, a.alignments), _regions(spark, a.reference)
    fragments = pipeline.fragment_intervals(rows, a.pairing == "paired", check=True)
    sinks.write_read_depth(pipeline.domain_depth(domains, fragments), a.output, compress=a.gzip)


def gc_correct(spark: SparkSession, a: argparse.Namespace) -> None:
    depth = lines.number_pairs(lines.numbered_lines(spark, a.read_depth), ("domain", "coverage")).withColumn("sample", F.lit("one"))
    table = lines.number_pairs(lines.numbered_lines(spark, a.gc_table), ("domain", "percent_gc")).withColumn("ord", F.struct("file", "line_no"))
    composition = gc.latest_by_name(table, "domain", "percent_gc", "ord")
    rows = gc.corrected_depth(depth, composition, check=True, keep=["file", "line_no"])
    sinks.write_corrected(rows, a.output or sinks.corrected_name(a.read_depth), ["file", "line_no"], compress=a.gzip)


def gc_from_fasta(spark: SparkSession, a: argparse.Namespace) -> None:
    counts = gc.sequence_counts(sequences.fasta_lines(spark, a.fasta))
    sinks.write_lines(counts, a.output, _gc_lines(counts))


def build_gc_model(spark: SparkSession, a: argparse.Namespace) -> None:
    counts = gc.region_gc(_regions(spark, a.bed), sequences.fasta_chunks(spark, a.fasta))
    sinks.write_lines(counts, a.output, _gc_lines(counts))


def trim(spark: SparkSession, a: argparse.Namespace) -> None:
    first, second = (sequences.fastq_records(spark, p) for p in (a.first, a.second))
    name = trimming.detect_adapter(first) if a.adapters == "detect" else a.adapters
    adapter = None if name == "none" else trimming.ADAPTERS.get(name, name)
    pairs = trimming.trim_pairs(sequences.fastq_pairs(first, second).withColumn("file", F.lit(a.first)), adapter).persist()
    for i in (1, 2):
        record = F.concat(F.lit("@"), "id", F.lit("\n"), f"seq{i}", F.lit("\n+\n"), f"qual{i}")
        sinks.write_lines(pairs.where("kept").orderBy("record"), f"{a.output}_{i}", record, compress=True)
    report = trimming.trim_report(pairs, ["file"])
    report.show(truncate=False)
    if not a.no_log:
        sinks.append_trim_log(report, a.log)


def align_report(spark: SparkSession, a: argparse.Namespace) -> None:
    counts = logs.distinct_names(lines.text_lines(spark, a.bed), ["file"])
    sinks.write_lines(counts, a.report, F.concat_ws(" ", F.lit(a.sample), F.col("names").cast("string")), mode="append")


def _report(rows: DataFrame, path: str) -> None:
    """Writes all rows with a header as tab-separated text, in their order, and shows the first twenty."""
    rows.write.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    rows.show(20, False)
    print(f"{rows.sparkSession.read.option('sep', chr(9)).option('header', True).csv(path).count()} rows in {path}")


def qc_report(spark: SparkSession, a: argparse.Namespace) -> None:
    log = lines.numbered_lines(spark, a.trim_stats).select("line_no", "value")
    latest = logs.latest_entries(lines.trim_log(log).withColumn("sample", sample_of(F.col("file"))), ["sample", "file", "kind"], "reads", "line_no")
    aligned = lines.align_log(lines.text_lines(spark, a.align_report)).groupBy("sample").agg(F.max("aligned").alias("aligned"))
    summary = logs.trim_summary(latest, "sample")
    report = logs.sample_report(summary.select("sample"), "sample", summary, aligned)
    report = report.withColumn("percent_aligned", logs.percent_aligned(F.col("aligned"), F.col("remaining_reads")))
    _report(report.orderBy("sample"), a.output)


def select_samples(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = sequences.index_records(spark, a.index).where("mate = 2").withColumn("ord", F.monotonically_increasing_id())
    groups = selection.candidate_groups(rows, ["sample_name", "center_name", "library_name"], "read_count", "insert_size", "population", "ord")
    names = lambda paths: lines.name_list(lines.text_lines(spark, paths)).withColumnRenamed("name", "sample_name")
    if a.failed:
        groups = selection.without(groups, names(a.failed), "sample_name")
    rank = selection.preference_rank(F.col("center_name"), a.centres, len(a.centres))
    order = [rank.asc_nulls_last(), F.col("reads").desc(), F.col("first")]
    best = selection.best_per_group(groups, ["sample_name"], order)
    wanted = names(a.of_interest) if a.of_interest else best.select("sample_name").limit(0)
    chosen = selection.fill_quotas(best, wanted, "sample_name", "population", order, a.quota)
    _report(chosen.orderBy(F.col("of_interest").desc(), "population", "place"), a.output)


def verify(spark: SparkSession, a: argparse.Namespace) -> None:
    expected = sequences.index_records(spark, a.index).select("fastq_file", "md5")
    files.verified(files.digests(spark, a.files), expected, "fastq_file").groupBy("state").count().show()


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    """All samples of a project in one job, from alignments to copies.

    Under the results: read_depth and corrected, a folder for each sample, and
    under the logs a table of how each sample fared.  A sample that fails takes
    no other along.
    """
    settings = project.load_project(a.project)
    settings.check_reference()
    folder = settings.paths.alignments
    read = [f(spark, f"{folder}/*.{kind}") for kind, f in (("bam", alignments.bam_alignments), ("sam", alignments.sam_alignments)) if globbing.glob(f"{folder}/*.{kind}")]
    rows = functools.reduce(lambda x, y: x.unionByName(y), read)
    rows = rows.withColumn("sample", F.regexp_extract("file", r"([^/]+?)(_sorted)?\.[bs]am$", 1))
    listed = rows.sparkSession.createDataFrame([(s,) for s in settings.samples], "sample string") if settings.samples else rows.select("sample").distinct()
    rows = rows.join(F.broadcast(listed), "sample", "left_semi")  # the project's list
    depths = cut(pipeline.cohort_depth(rows, _regions(spark, settings.reference.domains), paired=settings.options.paired))
    table = lines.number_pairs(lines.numbered_lines(spark, settings.reference.gc_table), ("domain", "percent_gc")).withColumn("ord", F.struct("file", "line_no"))
    copies = cut(pipeline.copy_numbers(depths, gc.latest_by_name(table, "domain", "percent_gc", "ord")))
    compression = "gzip" if settings.options.compress else "none"
    for name, df, line in (
        ("read_depth", depths, sinks.tabbed(F.col("name"), as_awk(F.col("depth")))), ("corrected", copies.where("reason is null"), sinks.corrected_line())
    ):
        written = df.select("sample", line.alias("value")).write.partitionBy("sample").option("compression", compression)
        written.mode("overwrite").text(f"{settings.paths.results}/{name}")
    _report(pipeline.cohort_status(listed, depths, copies).orderBy("sample"), f"{settings.paths.logs}/status")


def init(spark: SparkSession | None, a: argparse.Namespace) -> None:
    with open(a.output, "x") as f:
        f.write(TEMPLATE)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spanforge")
    commands = top.add_subparsers(dest="command", required=True)

    def command(action, *arguments):
        c = commands.add_parser(action.__name__.replace("_", "-"))
        c.set_defaults(run=action)
        for flags, how in arguments:
            c.add_argument(*flags.split(), **how)

    need, flag = {"required": True}, {"action": "store_true"}
    command(coverage, ("-r --reference", need), ("-b --alignments", need), ("-o --output", need), ("--gzip", flag), ("-p --pairing", {"choices": ["paired", "single"], "default": "paired"}))
    command(gc_correct, ("read_depth", {}), ("gc_table", {}), ("-o --output", {}), ("--gzip", flag))
    command(gc_from_fasta, ("fasta", {}), ("-o --output", need))
    command(build_gc_model, ("-b --bed", need), ("-f --fasta", need), ("-o --output", need))
    command(trim, ("-1 --first", need), ("-2 --second", need), ("-o --output", need), ("--adapters", {"default": "detect"}), ("--log", {"default": "logs/trim_stats"}), ("--no-log", flag))
    command(align_report, ("-b --bed", need), ("--sample", need), ("--report", need))
    command(qc_report, ("--trim-stats", need), ("--align-report", need), ("-o --output", {"default": "qc_report"}))
    command(select_samples, ("--index", need), ("--failed", {"nargs": "*"}), ("--of-interest", {"nargs": "*"}), ("--centres", {"nargs": "*", "default": []}), ("--quota", {"type": int, "default": 25}), ("-o --output", {"default": "selected_samples"}))
    command(run, ("project", {}))
    command(verify, ("--index", need), ("--files", need))
    command(init, ("--output", need))
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    if a.run is init:
        init(None, a)
        return 0
    try:
        a.run(spark or SparkSession.builder.appName("spanforge").getOrCreate(), a)
    except (NoProperPairs, gc.EmptyJoin) as e:
        print(e)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
