"""Readers of annotation and sequence files, plain or gzipped.

Where a later line wins over an earlier one, lines are ordered by the path of their file, the start of their
split in it, and their place in the split, whatever tasks Spark packs files and splits into.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions import columns as C
from residua.session import shuffle_partitions

#: What lines of a record are trimmed of.
BLANKS = " \t\n\x0b\f\r"
#: Bytes of a file that are hashed at once.
BLOCK = 1 << 20


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """df with a column to order its rows by as they stand in their files; it is a struct.

    A split is read by one task from its start, so within a split the task's running number will do. A table
    that isn't read from files is ordered as its partitions are.
    """
    within = F.monotonically_increasing_id()
    try:
        return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), within.alias("n")))
    except AnalysisException:
        return df.withColumn(name, F.struct(F.lit("").alias("path"), F.lit(0).cast("long").alias("start"), within.alias("n")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line and line_no, its place in the files."""
    return in_file_order(spark.read.text(path), "line_no").select(F.col("value").alias("line"), "line_no")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Rows of nine fields, neither blank nor comment: line_no, seqname, feature, attrs; text and odd, for attribute()."""
    rows = _lines(spark, path).filter((F.trim("line") != "") & ~F.col("line").startswith("#"))
    # Fields are cut out where they stand: a split would be made again for each filter on a field.
    tabs = F.octet_length("line") - F.octet_length(F.replace("line", F.lit("\t"), F.lit("")))
    rows = rows.filter(tabs == 8).select(
        "line_no",
        F.substring_index("line", "\t", 1).alias("seqname"),
        F.substring_index(F.substring_index("line", "\t", 3), "\t", -1).alias("feature"),
        F.concat(F.lit(" "), F.substring_index("line", "\t", -1)).alias("text"),
    )
    # Only odd lines need the map. It is exploded, so that it is made once, and not for lines that a feature leaves out.
    odd = F.when(~F.col("text").rlike(C.PLAIN_ATTRIBUTES), C.attributes(F.col("text")))
    rows = rows.select("*", F.explode(F.array(odd)).alias("odd")).filter(C.attribute("gene_id") != "")
    return rows.withColumn("attrs", F.coalesce("odd", C.attributes(F.col("text"))))


def _last_by(df: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    columns = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("r")).select(key, "r.*")


def gtf_genes(gtf: DataFrame) -> DataFrame:
    """One row a gene_id, of the last line: gene_id, gene_id_stable, gene_name, gene_type."""
    rows = gtf.filter(F.col("feature") == "gene").select(
        C.attribute("gene_id").alias("gene_id"),
        C.stable_id(C.attribute("gene_id")).alias("gene_id_stable"),
        C.attribute("gene_name").alias("gene_name"),
        C.attribute("gene_type", "gene_biotype").alias("gene_type"),
        "line_no",
    )
    return _last_by(rows, "gene_id").drop("line_no")


def gtf_transcripts(gtf: DataFrame) -> DataFrame:
    """One row a transcript line, with its place in the file."""
    rows = gtf.filter(F.col("feature") == "transcript").select(
        "line_no",
        C.attribute("gene_id").alias("gene_id"),
        C.attribute("gene_name").alias("gene_name"),
        C.attribute("gene_type", "gene_biotype").alias("gene_type"),
        "seqname",
        C.attribute("transcript_id").alias("transcript_id"),
        C.attribute("transcript_name").alias("transcript_name"),
        C.attribute("transcript_type", "transcript_biotype").alias("transcript_type"),
        C.attribute("protein_id").alias("protein_id"),
    )
    # Ids are taken apart in a step of their own, after the look-ups in the map.
    return rows.select(
        "line_no",
        "gene_id",
        C.stable_id(F.col("gene_id")).alias("gene_id_stable"),
        "gene_name",
        "gene_type",
        "seqname",
        "transcript_id",
        C.stable_id(F.col("transcript_id")).alias("transcript_id_stable"),
        "transcript_name",
        "transcript_type",
        F.nullif("protein_id", F.lit("")).alias("protein_id"),
        C.stable_id(F.col("protein_id")).alias("protein_id_stable"),
    )


def transcripts_of(gtf: DataFrame, symbols: DataFrame) -> DataFrame:
    """Transcripts with a protein whose gene_name is among symbols (gene_name)."""
    rows = gtf_transcripts(gtf).filter(F.col("protein_id").isNotNull())
    return rows.join(symbols.select("gene_name").distinct(), "gene_name", "left_semi")


def read_fasta(spark: SparkSession, path: str, fields: int = 8) -> DataFrame:
    """Records: record_no, header (array), malformed, sequence.

    A record is cut at a line that starts with >. Lines are trimmed and joined, letters made upper-case;
    blanks within a line stay, and are invalid later.
    """
    raw = in_file_order(spark.read.option("lineSep", "\n>").text(path), "record_no").select("value", "record_no")
    # Only a file's first record still has its mark. What starts a record tells, without a look at its letters.
    marked = functools.reduce(lambda a, b: a | b, [F.col("value").startswith(x) for x in ">" + BLANKS])
    bare = F.when(marked, F.regexp_replace("value", "^\\s*>", "")).otherwise(F.col("value"))
    raw = raw.withColumn("value", bare).filter(F.col("value").rlike("[^ ]")).select("record_no", F.split("value", "\n").alias("lines"))
    header = F.split(F.trim(F.get("lines", F.lit(0))), r"\|")
    joined = F.array_join(F.transform(F.slice("lines", 2, 1 << 30), lambda x: F.btrim(x, F.lit(BLANKS))), "")
    return raw.select("record_no", header.alias("header"), (F.size(header) < fields).alias("malformed"), F.upper(joined).alias("sequence"))


def protein_records(fasta: DataFrame) -> DataFrame:
    """Well-formed records with their ids, hash, length, validity and issue."""
    s = F.col("sequence")
    rows = fasta.filter(~F.col("malformed")).select(
        "record_no",
        F.get("header", F.lit(0)).alias("protein_id"),
        C.stable_id(F.get("header", F.lit(0))).alias("protein_id_stable"),
        s.alias("amino_acid_sequence"),
        F.length(s).alias("protein_length"),
        C.sequence_hash(s).alias("protein_sequence_hash"),
        C.sequence_issue(s).alias("sequence_issue"),
    )
    # A step of its own, so that the issue is worked out once.
    issue = F.col("sequence_issue")
    return rows.select(*[c for c in rows.columns if c != "sequence_issue"], (issue == "").alias("sequence_valid"), issue)


def protein_index(records: DataFrame) -> DataFrame:
    """Records by key: an exact id finds its last record, a stable id its first unless an exact id equals it.

    Both kinds of ids are grouped together, so the records are read once. They are brought together by their stable
    ids before, so each is shuffled once and not once for each kind.
    """
    kept = [c for c in records.columns if c not in ("protein_id", "protein_id_stable")]
    ids = F.array(F.struct(F.col("protein_id").alias("key"), F.lit(True).alias("exact")), F.struct(F.col("protein_id_stable").alias("key"), F.lit(False).alias("exact")))
    held = records.repartition(shuffle_partitions(records.sparkSession), "protein_id_stable")
    rows = held.select("protein_id_stable", F.inline(ids), *kept).filter(F.col("exact") | F.col("key").isNotNull())
    row, exact, no = F.struct(*kept), F.col("exact"), F.col("record_no")
    last, first = F.max_by(row, F.when(exact, no)), F.min_by(row, F.when(~exact, no))
    return rows.groupBy("protein_id_stable", "key").agg(F.coalesce(last, first).alias("r")).select("key", "r.*")


def fasta_report(fasta: DataFrame) -> DataFrame:
    """One row: well-formed records, malformed headers, and records with any invalid character."""
    bad = F.size(C.invalid_residues(F.col("sequence"))) > 0
    return fasta.agg(
        F.count_if(~F.col("malformed")).alias("total"),
        F.count_if("malformed").alias("malformed_header"),
        F.count_if(~F.col("malformed") & bad).alias("with_unusual_characters"),
    )


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A headed file with all columns as strings; empty values stay empty strings."""
    df = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return df.fillna("")


def read_mane(spark: SparkSession, path: str) -> DataFrame:
    """One row a stable transcript id: flags, and distinct non-empty statuses and ids joined by ';'."""
    rows = read_delimited(spark, path, "\t").filter(F.col("Ensembl_nuc") != "")

    def joined(name: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(name), F.lit("")))), ";")

    return rows.groupBy(C.stable_id(F.col("Ensembl_nuc")).alias("transcript_id_stable")).agg(
        F.bool_or(F.col("MANE_status") == "MANE Select").alias("is_mane_select"),
        F.bool_or(F.col("MANE_status").contains("Plus Clinical")).alias("is_mane_plus_clinical"),
        joined("MANE_status").alias("mane_status"),
        joined("RefSeq_nuc").alias("refseq_transcript_id"),
        joined("RefSeq_prot").alias("refseq_protein_id"),
    )


def hgnc_tokens(complete: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """Every name a gene goes or went by: token, method, hgnc_id, symbol, status, merged_into, ord.

    ord follows the files: rows in order, within a row symbol, previous, alias; withdrawn entries last.
    """
    rows = in_file_order(complete, "n")
    named = F.array(
        F.struct(F.lit("approved_symbol").alias("method"), F.array("symbol").alias("tokens")),
        F.struct(F.lit("previous_symbol").alias("method"), C.pipe_list(F.col("prev_symbol")).alias("tokens")),
        F.struct(F.lit("alias_symbol").alias("method"), C.pipe_list(F.col("alias_symbol")).alias("tokens")),
    )
    rows = rows.select("hgnc_id", "symbol", "status", "n", F.posexplode(named).alias("k", "x"))
    rows = rows.select("hgnc_id", "symbol", "status", "n", "k", F.col("x.method").alias("method"), F.posexplode("x.tokens").alias("j", "token"))
    kept = rows.select(
        F.trim("token").alias("token"), "method", "hgnc_id", "symbol", "status", F.lit("").alias("merged_into"), F.struct(F.lit(0).alias("f"), "n", "k", "j").alias("ord")
    )
    gone = in_file_order(withdrawn, "n").select(
        F.trim("WITHDRAWN_SYMBOL").alias("token"),
        F.lit("withdrawn_or_merged_symbol").alias("method"),
        F.col("HGNC_ID").alias("hgnc_id"),
        F.col("WITHDRAWN_SYMBOL").alias("symbol"),
        F.col("STATUS").alias("status"),
        F.element_at(F.array(*[F.col(f"`{c}`") for c in withdrawn.columns if c.upper().startswith("MERGED_INTO")] or [F.lit("")]), 1).alias("merged_into"),
        F.struct(F.lit(1).alias("f"), "n", F.lit(0).alias("k"), F.lit(0).alias("j")).alias("ord"),
    )
    return kept.unionByName(gone).filter(F.col("token") != "")


MANIFEST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "source_sha256", "created_utc")]
    + [T.StructField(n, T.LongType()) for n in ("shard_size", "total_rows", "unique_sequence_hashes", "duplicates", "missing_hashes", "missing_sequences")]
    + [
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField(
            "shards",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.StringType()) for n in ("shard_id", "filename", "first_sequence_hash", "last_sequence_hash", "sha256")]
                    + [T.StructField("row_count", T.LongType())]
                )
            ),
        ),
    ]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            # A path without a scheme is an absolute one on this machine.
            fs, at = FileSystem.from_uri(path if "://" in path or path.startswith("/") else re.sub("^file:/+", "/", path))
            digest = hashlib.sha256()
            with fs.open_input_stream(at) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["path", "length", "sha256"])


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of the files that a path or pattern names.

    Each file is streamed by a task in blocks of 1 MiB, so it may be of any size. Stores must be ones that
    Arrow opens, such as local paths and HDFS.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = [s for x in fs.globStatus(fs_path) or [] for s in ([x] if x.isFile() else fs.listStatus(x.getPath()))]
    files = [(s.getPath().toString(), s.getLen()) for s in named if s.isFile()]
    rows = spark.createDataFrame(files, "path string, length long")
    return rows.repartition(max(1, len(files))).mapInArrow(_digests, "path string, length long, sha256 string")


def check_gtf(gtf: DataFrame) -> DataFrame:
    """One row: gene rows among the first 100 records, and whether each has the five attributes needed."""
    first = gtf.orderBy("line_no").limit(100).filter(F.col("feature") == "gene")
    need = ["gene_id", "gene_name"]
    held = [F.bool_and(F.coalesce(F.try_element_at("attrs", F.lit(k)), F.lit("")) != "").alias(f"has_{k}") for k in need]
    typed = F.bool_and(C.first_attribute(F.col("attrs"), "gene_type", "gene_biotype") != "").alias("has_gene_type")
    return first.agg(F.count(F.lit(1)).alias("genes"), *held, typed)
