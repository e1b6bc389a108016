"""Readers and writers of the text formats around the tables; Parquet is the native format.

Readers keep all columns as text, since values must survive unchanged; types come from functions.text. A file's own
faults come back as rows or raise in Spark's own reader (FAILFAST), never as a driver loop over rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cladeframe.functions.text import finite, number, parsed
from cladeframe.operators.store import tasks_for

#: Columns of the files.
BUSCO = ("marker", "status", "sequence", "score", "length")
HITS = "query string, target string, raw int, qstart int, qend int, tstart int, tend int, cigar string"
QC = "species string, run string, targets long, protein_genes long, quantified_proteins long, mapped_targets long, ambiguous_targets long, retained_targets long, orthogroups long, total_tpm double, mapped_tpm double, mapped_tpm_fraction double, retained_tpm double, retained_tpm_fraction double, multimap string"


def _options(reader, multiline: bool = False):
    return reader.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline).option("mode", "FAILFAST").option("emptyValue", "").option("nullValue", "\0").option("enforceSchema", False)


def read_tsv(spark: SparkSession, path: str | list[str], fields: Sequence[str], multiline: bool = False) -> DataFrame:
    """A table of text columns whose header must hold the fields, each name once; other columns stay. Rows that are too
    short or long, or files whose header differs, fail the read. Blank is the empty string. Line ends inside quotes need
    multiline, which makes every file one task; without it Spark splits large files."""
    first = path if isinstance(path, str) else path[0]
    head = spark.read.option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"').csv(first).limit(1).first()
    names = [x or "" for x in head] if head else []
    if len(set(names)) < len(names):
        raise ValueError(f"repeated column in the header of {first}")
    if lacking := [f for f in fields if f not in names]:
        raise ValueError(f"{first} lacks {lacking}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _options(spark.read.schema(schema), multiline).csv(path).na.fill("")


def preferred_paths(paths: Sequence[str]) -> list[str]:
    """Of x and x.gz the latter."""
    packed = {p for p in paths if p.endswith(".gz")}
    return sorted(packed | {p for p in paths if f"{p}.gz" not in packed})


def read_runs(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str], name: str = r"([^/]+?)\.[^/]*$") -> DataFrame:
    """Many per-run tables as one, with column source from the file's path. One read for all files, of a list or of one path
    with wildcards."""
    out = read_tsv(spark, paths if isinstance(paths, str) else preferred_paths(paths), fields)
    return out.withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), name, 1))


def read_fasta(spark: SparkSession, path: str | list[str], name: str = r"([^/]+?)\.[^/]*$") -> DataFrame:
    """(source, id, header, seq, problem): one row per record; the id is the header's first word. problem: no_id,
    empty_sequence or null. Ids that repeat within a source: check_unique."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_extract("_metadata.file_path", name, 1).alias("source"), F.regexp_replace("value", r"\A>", "").alias("r"))
    raw = raw.where(F.trim("r") != "")
    header = F.regexp_replace(F.substring_index("r", "\n", 1), r"\r\z", "")
    seq = F.regexp_replace(F.substring(F.col("r"), F.length(F.substring_index("r", "\n", 1)) + 2, F.length("r")), r"\s", "")
    out = raw.select("source", F.regexp_extract(header, r"^(\S*)", 1).alias("id"), header.alias("header"), seq.alias("seq"))
    return out.withColumn("problem", F.when(F.col("id") == "", "no_id").when(F.col("seq") == "", "empty_sequence"))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\r\z", "").alias("line"))


def read_annotation_pairs(spark: SparkSession, path: str | list[str], group_separator: str = ",") -> DataFrame:
    """(file, gene_id, orthogroup) from annotation text in either dialect: #query with ODB_OG, or #cluster_id with
    gene_id. Each file's header is joined back to its lines; a file that says it has no data gives none."""
    lines = _lines(spark, path)
    dialect = F.col("line").startswith("#query") | F.col("line").startswith("#cluster_id")
    heads = lines.where(dialect).groupBy("file").agg(F.min("line").alias("head"))
    cols = F.split(F.col("head"), "\t")
    query = F.col("head").startswith("#query")
    place = lambda n: F.array_position(cols, n).cast("int")
    heads = heads.select("file", F.when(query, F.lit(1)).otherwise(place("gene_id")).alias("gene_at"), F.when(query, place("ODB_OG")).otherwise(F.lit(1)).alias("group_at"))
    rows = lines.where(~F.col("line").startswith("#") & (F.trim("line") != "") & ~F.contains("line", F.lit("No data found"))).join(heads, "file")
    parts = F.split(F.col("line"), "\t")
    out = rows.select("file", F.try_element_at(parts, F.col("gene_at")).alias("gene_id"), F.explode(F.split(F.try_element_at(parts, F.col("group_at")), group_separator)).alias("orthogroup"))
    return out.select("file", "gene_id", F.trim("orthogroup").alias("orthogroup")).where(~F.col("orthogroup").isin("", "-"))


def read_markers(spark: SparkSession, path: str | list[str], lineage: str | None = None) -> DataFrame:
    """(file, lineage, marker, status, sequence, score, length, problem) from full marker tables. problem: genome_table,
    lineage, status, score or length."""
    lines = _lines(spark, path)
    note = F.regexp_extract("line", r"^# The lineage dataset is: (\S+)", 1)
    per_file = lines.where(F.col("line").startswith("#")).groupBy("file").agg(F.max(F.nullif(note, F.lit(""))).alias("lineage"), F.bool_or(F.contains("line", F.lit("Gene Start"))).alias("genome"))
    parts = F.split("line", "\t")
    rows = lines.where(~F.col("line").startswith("#") & (F.trim("line") != "")).join(per_file, "file", "left")
    out = rows.select("file", "lineage", "genome", *[F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(BUSCO)])
    missing = F.col("status") == "Missing"
    problem = (
        F.when(F.col("genome"), "genome_table").when(F.col("lineage").isNull() | (F.lit(lineage is not None) & (F.col("lineage") != F.lit(lineage or ""))), "lineage")
        .when(~F.coalesce(F.col("status").isin("Complete", "Duplicated", "Fragmented", "Missing"), F.lit(False)), "status")
        .when(~missing & number(F.col("score"), nonnegative=False).isNull(), "score").when(~missing & number(F.col("length")).isNull(), "length")
    )
    return out.withColumn("problem", problem).withColumns({"score": number(F.col("score"), nonnegative=False), "length": number(F.col("length"))}).drop("genome")


def read_search_detail(spark: SparkSession, path: str | list[str], thresholds: DataFrame | None = None) -> DataFrame:
    """(gene_id, ko, score, threshold, evalue, accepted, assignment_status, problem) from detail text, whose acceptance
    mark (*) decides, since printed scores are rounded. problem: mark (differs from the score by more than rounding) or
    conflict (a gene and label with two different hits)."""
    x = _lines(spark, path).where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    # step by step, as an expression that is named several times in one step is computed as often
    at = lambda i: F.nullif(F.trim(F.try_element_at("parts", F.lit(i))), F.lit(""))
    own = x.select(F.split("line", "\t").alias("parts")).select(at(1).alias("mark"), at(2).alias("gene_id"), at(3).alias("ko"), at(4).alias("threshold"), at(5).alias("score"), at(6).alias("evalue"))
    own = own.select(F.coalesce(F.col("mark") == "*", F.lit(False)).alias("mark"), "gene_id", "ko", parsed(F.nullif("threshold", F.lit("-"))).alias("threshold"), parsed(F.col("score")).alias("score"), parsed(F.col("evalue")).alias("evalue"))
    own = own.select("mark", "gene_id", "ko", finite(F.col("threshold")).alias("threshold"), finite(F.col("score"), nonnegative=False).alias("score"), finite(F.col("evalue")).alias("evalue"))
    # one shuffle by gene and label, for distinct hits and for their number
    own = own.where("gene_id is not null and ko is not null").repartition("gene_id", "ko").distinct()
    if thresholds is not None:
        own = own.drop("threshold").join(thresholds.select("ko", "threshold"), "ko", "left")
    status = F.when(F.col("mark"), "accepted").when(F.col("threshold").isNull(), "threshold_missing").otherwise("below_threshold")
    off = (F.col("mark") & (F.col("score") < F.col("threshold") - 0.06)) | (~F.col("mark") & (F.col("score") > F.col("threshold") + 0.06))
    out = own.withColumn("n", F.count("*").over(Window.partitionBy("gene_id", "ko")))
    return out.select("gene_id", "ko", "score", "threshold", "evalue", F.col("mark").alias("accepted"), status.alias("assignment_status"), F.when(F.col("n") > 1, "conflict").when(off, "mark").alias("problem"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(ko, definition) of a label list; ids without their prefix."""
    x = F.split("value", "\t")
    return spark.read.text(path).where(F.trim("value") != "").select(F.regexp_replace(F.get(x, F.lit(0)), r"^ko:", "").alias("ko"), F.coalesce(F.get(x, F.lit(1)), F.lit("")).alias("definition"))


def normalized_links(links: DataFrame, kind: str) -> DataFrame:
    """Distinct (ko, module) or (ko, pathway) from links(a, b) in either direction; prefixes go, ko00010 is map00010."""
    bare = lambda c: F.regexp_replace(c, r"^[a-z]+:", "")
    a, b = bare(F.col("a")), bare(F.col("b"))
    swapped = ~a.rlike(r"^K[0-9]{5}\z")
    ko, other = F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b)
    other = F.regexp_replace(other, r"^ko(?=[0-9]{5}\z)", "map") if kind == "pathway" else other
    wanted = r"^map[0-9]{5}\z" if kind == "pathway" else r"^M[0-9]{5}\z"
    return links.select(ko.alias("ko"), other.alias(kind)).where(F.col("ko").rlike(r"^K[0-9]{5}\z") & F.col(kind).rlike(wanted)).distinct()


def read_links(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return normalized_links(spark.read.option("sep", "\t").schema("a string, b string").csv(path), kind)


def read_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("sep", "\t").option("mode", "FAILFAST").schema(HITS).csv(path)


def read_qc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(QC).option("multiLine", True).option("mode", "FAILFAST").json(path)


def taxonomy_problems(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """(problem): no_root, or redirects that lead away from a node that still exists."""
    root = nodes.where("taxid = 1").agg(F.count("*").alias("n")).where("n = 0").select(F.lit("no_root").alias("problem"))
    live = merged.join(nodes.select(F.col("taxid").alias("taxid_old")), "taxid_old", "left_semi").select(F.lit("merged_but_live").alias("problem"))
    return root.union(live)


def write_long(df: DataFrame, path: str, order: Sequence[str] = (), compression: str = "gzip") -> None:
    """Tab-separated text; values that are text stay as they are. With an order the files are range-sorted."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("compression", compression).csv(path)


def write_qc(df: DataFrame, path: str) -> None:
    """A JSON file for each row, all in one folder: a folder for each file would be listed by itself, by writer and reader. A task
    writes a few thousand files."""
    df.repartition(tasks_for(df, 2_000)).write.option("maxRecordsPerFile", 1).json(path)


def write_parts(df: DataFrame, path: str, by: str = "sample") -> None:
    """One folder per sample; rows of a sample come from few tasks."""
    df.repartition(by).write.partitionBy(by).parquet(path)


def fasta_records(df: DataFrame, name: str = "id", seq: str = "seq") -> Column:
    return F.concat(F.lit(">"), df[name], F.lit("\n"), df[seq])


def write_fasta(df: DataFrame, path: str, by: str | None = None, name: str = "id", seq: str = "seq") -> None:
    out = df.select(*([by] if by else []), fasta_records(df, name, seq).alias("value"))
    (out.repartition(by).sortWithinPartitions(by, "value").write.partitionBy(by) if by else out.write).text(path)


def content_identity(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, bytes, sha256) of stored files. A file must fit a task."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            digest, raw = hashlib.sha256(), pa.BufferReader(content.as_buffer())
            with pa.CompressedInputStream(raw, "gzip") if path.endswith(".gz") else raw as stream:
                while block := stream.read(1 << 20):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "sha256"])


def decoded_identity(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, sha256) of what files hold once unpacked, a block at a time. A packed file must fit a task."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_decoded, "path string, sha256 string")
