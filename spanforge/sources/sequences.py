"""FASTA, FASTQ and sequence-index files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spanforge.functions.names import mate_of
from spanforge.operators.records import INDEX_COLUMNS
from spanforge.sources.lines import numbered_lines


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """name (first word of the header), seq of each record; what stands before the first header is left out.

    Records are split by the reader; a repeated name gives several rows, which
    later counts add up.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_block_start").alias("at"), "value")
    text = F.regexp_replace("value", "\r", "")
    headed = records.withColumn("__first", F.col("value").startswith(">")).withColumn("__text", F.regexp_replace(text, "^>", ""))
    body = F.regexp_replace(F.regexp_replace("__text", r"^[^\n]*(\n|\z)", ""), "\n", "")
    name = F.regexp_extract("__text", r"^([^\s]*)", 1)
    leading = (F.col("at") == 0) & (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0) & ~F.col("__first")
    return headed.where(~leading).select(name.alias("name"), body.alias("seq"))


#: Lines of a file that are looked at together, in order.
BLOCK_LINES = 1 << 16


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, head, name, start, seq of each line of each record: `start` letters stand before it; a header gives an empty line.

    A record of any length stays in its lines.  Lines look back to their header
    and add up their lengths within blocks; a row for each block of a file, and
    for each record and block, carries on what came before.
    """
    lines = numbered_lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", "")).withColumn("__block", F.expr(f"line_no div {BLOCK_LINES}"))
    header = F.col("value").startswith(">")
    in_block = W.partitionBy("file", "__block").orderBy("line_no")
    marked = lines.withColumn("__head", F.when(header, F.col("line_no"))).withColumn("__own", F.last("__head", ignorenulls=True).over(in_block))
    earlier = W.partitionBy("file").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    blocks = marked.groupBy("file", "__block").agg(F.max("__head").alias("__most")).select("file", "__block", F.last("__most", ignorenulls=True).over(earlier).alias("__before"))
    headed = marked.join(blocks, ["file", "__block"]).withColumn("head", F.coalesce("__own", "__before")).where("head is not null")
    headed = headed.withColumn("seq", F.when(header, F.lit("")).otherwise(F.col("value")))
    record = ["file", "head"]
    within = F.sum(F.length("seq")).over(W.partitionBy(*record, "__block").orderBy("line_no")) - F.length("seq")
    sums = headed.groupBy(*record, "__block").agg(F.sum(F.length("seq")).alias("__letters"))
    ahead = F.coalesce(F.sum("__letters").over(W.partitionBy(*record).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = headed.withColumn("__within", within).join(sums.select(*record, "__block", ahead.alias("__ahead")), [*record, "__block"])
    names = lines.where(header).select("file", F.col("line_no").alias("head"), F.regexp_extract("value", r"^>([^\s]*)", 1).alias("name"))
    return placed.join(names, record).select(*record, "name", (F.col("__ahead") + F.col("__within")).alias("start"), "seq")


def fasta_chunks(spark: SparkSession, path: str, size: int = 1 << 16) -> DataFrame:
    """contig, chunk, piece: sequences cut into pieces of `size` letters, put together from their lines; see operators.gc.contig_chunks.

    Of a name that comes more than once the first record of its file counts.
    """
    lines = fasta_lines(spark, path)
    first = lines.groupBy("file", "name").agg(F.min("head").alias("head"))
    lines = lines.join(first, ["file", "name", "head"], "left_semi").where("seq <> ''")
    cut = lines.withColumn("chunk", F.explode(F.expr(f"sequence(start div {size}, (start + length(seq) - 1) div {size})")))
    low = F.greatest(F.col("start"), F.col("chunk") * size)
    part = F.substring(F.col("seq"), (low - F.col("start") + 1).cast("int"), (F.least(F.col("start") + F.length("seq"), (F.col("chunk") + 1) * size) - low).cast("int"))
    parts = F.sort_array(F.collect_list(F.struct(low.alias("at"), part.alias("text"))))  # of at most `size` letters
    return cut.groupBy(F.col("name").alias("contig"), "chunk").agg(F.array_join(F.transform(parts, lambda p: p.text), "").alias("piece"))


def fasta_index(spark: SparkSession, path: str) -> DataFrame:
    """contig, letters, offset, line_letters, line_bytes of a FASTA file's index (.fai)."""
    columns = "contig string, letters long, offset long, line_letters long, line_bytes long"
    return spark.read.option("sep", "\t").schema(columns).csv(path)


def indexed_sequences(regions: DataFrame, index: DataFrame, path: str) -> DataFrame:
    """name, chrom, start, end, seq: letters of each region, read at their places in a FASTA file that all executors reach.

    Only the bytes of the regions are read; a region past its contig's end gets
    what there is, one on no contig of the index no row.
    """
    last = F.least(F.col("end"), F.col("letters"))
    byte = lambda at: F.col("offset") + F.expr(f"({at}) div line_letters * line_bytes + ({at}) % line_letters")
    met = regions.join(index, F.col("chrom") == F.col("contig")).where("start < least(end, letters)").withColumn("__last", last)
    asked = met.select("name", "chrom", "start", "end", byte("start").alias("__from"), (byte("__last - 1") + 1).alias("__to"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as source:
            for batch in batches:
                found = []
                for a, b in zip(batch.column("__from").to_pylist(), batch.column("__to").to_pylist()):
                    source.seek(a)
                    found.append(source.read(b - a).replace(b"\n", b"").replace(b"\r", b"").decode("latin-1"))
                columns = [batch.column(c) for c in ("name", "chrom", "start", "end")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], names=["name", "chrom", "start", "end", "seq"])

    kinds = dict(asked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("name", "chrom", "start", "end")) + ", seq string"
    return asked.mapInArrow(read, schema)


def fastq_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (from 0), id, seq, qual; four lines a record."""
    lines = numbered_lines(spark, path).withColumn("record", F.expr("line_no div 4"))
    part = [F.max(F.when(F.col("line_no") % 4 == i, F.col("value"))) for i in range(4)]
    return lines.groupBy("file", "record").agg(
        F.substring_index(F.expr("substring(max(case when line_no % 4 = 0 then value end), 2)"), " ", 1).alias("id"), part[1].alias("seq"), part[3].alias("qual")
    )


def fastq_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates by record number: record, id, seq1, qual1, seq2, qual2."""
    a = first.select("record", "id", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    return a.join(second.select("record", F.col("seq").alias("seq2"), F.col("qual").alias("qual2")), "record")


def fastq_count(lines: DataFrame) -> DataFrame:
    """file, reads: a fourth of the lines, rounded up."""
    return lines.groupBy("file").agg(F.ceil(F.count("*") / 4).alias("reads"))


def index_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows of sequence-index files by position, NA and empty as null; header rows and rows without a sample are left out.

    For files with damaged lines see operators.records.
    """
    schema = ", ".join(f"{c} string" for c in INDEX_COLUMNS)
    rows = spark.read.option("sep", "\t").option("nullValue", "NA").option("quote", "").schema(schema).csv(path)
    rows = rows.where((F.col("fastq_file") != "FASTQ_FILE") & F.col("analysis_group").isNotNull())
    numbers = {c: F.expr(f"try_cast(trim({c}) as bigint)") for c in ("insert_size", "read_count", "base_count")}
    return rows.withColumns(numbers | {"withdrawn": F.col("withdrawn") == "1", "mate": mate_of(F.col("fastq_file"))})
