"""Readers of tab-separated tables."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from readloom.functions.ids import parse_read_id, parse_region_key, split_functions
from readloom.operators.taxonomy import complete_taxonomy
from readloom.params import RANKS
from readloom.schemas import HIT_LIST, HITS, KEPT_HIT
from readloom.session import broadcast_if_small

# Bits of an order key that number the rows of one file.
_PLACE_BITS = 41

# Name of a hit table: sample, end, then the kind of table.
_TABLE_NAME = r"([^/=]+)_(pe[12])_[^/]*$"

ANNOTATED = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("read_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("functions", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("taxonomy", T.StringType()),
    T.StructField("hits", T.ArrayType(KEPT_HIT)),
])


def _in_order(rows: DataFrame, *of_file: Column) -> DataFrame:
    """Put ``ord`` and ``file`` before the columns: files by name, lines as in the file.

    ``of_file`` are columns made from ``file``, once a file; they follow it.

    Spark packs splits by size, so its own row ids follow no order of names. A split that does not
    end its file fills a task alone, hence its rows number fewer than the bytes up to the next one:
    start of the split plus row in the task grows along a file. The key has room for 2^22 files of 2^41
    bytes; one that would not fit fails the job.
    """
    files = sorted({re.sub("^file:/+", "file:/", unquote(f)) for f in rows.inputFiles()})
    if len(files) > 1 << (63 - _PLACE_BITS):
        raise ValueError(f"more than {1 << (63 - _PLACE_BITS)} files in one table")
    # Spark's own index has these names on the driver; only few of them are sent to every task.
    numbers = broadcast_if_small(rows.sparkSession.createDataFrame(
        [(f, k) for k, f in enumerate(files)], "file string, _number long").select("*", *of_file))
    # A plus sign is itself in a path, a blank only in a form.
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    placed = rows.select(
        F.regexp_replace(decoded, "^file:/+", "file:/").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"), *rows.columns)
    number = F.coalesce("_number", F.raise_error(F.concat(F.lit("unlisted file "), "file")).cast("long"))
    place = F.col("_block") + F.col("_row")
    fits = F.when(place < 1 << _PLACE_BITS, place).otherwise(
        F.raise_error(F.concat(F.lit("too long to be numbered: "), "file")).cast("long"))
    return placed.join(numbers, "file", "left").select(
        (F.shiftleft(number, _PLACE_BITS) + fits).alias("ord"), "file",
        *[c for c in numbers.columns if c not in ("file", "_number")], *rows.columns)


def _with_origin(rows: DataFrame) -> DataFrame:
    """Sample and end from the file's name, and ``ord``: the order of rows."""
    folder_or_file = F.regexp_replace("file", r"/part-[^/]*$", "")
    part = lambda k: F.when(folder_or_file.rlike(_TABLE_NAME),
                            F.regexp_extract(folder_or_file, _TABLE_NAME, k))
    named = lambda c: F.coalesce(F.col(c), F.raise_error(
        F.concat(F.lit("no sample and end in the name "), "file")).cast("string"))
    return _in_order(rows, part(1).alias("_sample"), part(2).alias("_end")).select(
        named("_sample").alias("sample_id"), named("_end").alias("end"), "ord", *rows.columns)


def _read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Headerless table; a row that does not fit the schema fails the job."""
    return spark.read.schema(schema).csv(path, sep="\t", mode="FAILFAST")


def read_reference_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """First search: query ids are read headers and are reduced to read ids."""
    rows = _with_origin(_read_tsv(spark, path, HITS))
    return rows.withColumn("read_id", parse_read_id(F.col("query_id"))["read_id"])


def read_background_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Second search: query ids are region keys."""
    rows = _with_origin(_read_tsv(spark, path, HITS))
    return rows.withColumn("key", parse_region_key(F.col("query_id"))).select(
        *rows.columns, "key.read_id", "key.r_start", "key.r_end"
    )


def read_hit_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Exported hits with their functions in a 13th column."""
    rows = _with_origin(_read_tsv(spark, path, HIT_LIST))
    return rows.withColumn("functions", split_functions(F.col("functions")))


def regroup_hit_list(rows: DataFrame) -> DataFrame:
    """Exported hits back to one row per read, to resume after the first search."""
    fields = ["ord", *[f for f in KEPT_HIT.fieldNames()]]
    return rows.groupBy("sample_id", "end", F.col("query_id").alias("read_id")).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("hits")
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _in_order(spark.read.text(path)).select(
        "ord", F.regexp_replace("value", r"\r$", "").alias("line"))


def _data_fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated fields of every line that is not a comment."""
    lines = _lines(spark, path).where(~F.col("line").startswith("#"))
    return lines.select("ord", F.split("line", "\t").alias("f")).withColumn("n", F.size("f"))


def _last_per(rows: DataFrame, key: str, *columns: Column) -> DataFrame:
    """The last line of each key wins."""
    names = rows.select(*columns).columns
    last = rows.groupBy(key).agg(F.max(F.struct("ord", *columns)).alias("last"))
    return last.select(key, *[f"last.{name}" for name in names])


def read_functions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Function, name, group and, in longer rows, identity cutoffs from species upwards."""
    rows = _data_fields(spark, path).where(F.col("n") > 2)
    number = lambda i: F.col("f")[i].cast("double")
    listed = [F.lit(RANKS[0]), number(3)]
    for position, rank in enumerate(reversed(RANKS[1:]), start=4):
        listed += [F.lit(rank), number(position)]
    has_cutoffs = F.col("n") > 3
    return _last_per(
        rows.withColumn("function", F.col("f")[0])
        .withColumn("function_cutoff", F.when(has_cutoffs, number(3)))
        .withColumn("cutoff_list", F.when(has_cutoffs, F.array(*listed[1::2]))),
        "function",
        F.col("f")[1].alias("name"), F.col("f")[2].alias("group"),
        F.col("function_cutoff"), F.col("cutoff_list"),
    ).select(
        "function", "name", "group", "function_cutoff",
        F.when(
            F.col("cutoff_list").isNotNull(),
            F.map_from_arrays(F.array(*listed[0::2]), "cutoff_list"),
        ).otherwise(F.create_map().cast("map<string,double>")).alias("cutoffs"),
    )


def read_proteins(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Protein, taxon, any columns, source, '|'-joined functions; short rows are skipped."""
    rows = _data_fields(spark, path).where(F.col("n") > 3)
    return _last_per(
        rows.withColumn("protein_id", F.col("f")[0]), "protein_id",
        F.col("f")[1].alias("taxid"),
        F.try_element_at("f", F.lit(-1)).alias("joined"),
        F.try_element_at("f", F.lit(-2)).alias("source"),
    ).select(
        "protein_id", "taxid", split_functions(F.col("joined")).alias("functions"), "source"
    )


def read_taxonomy(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Taxon, name, rank, parent; an empty file is an error."""
    rows = _last_per(
        _lines(spark, path).select("ord", F.split("line", "\t").alias("f"))
        .withColumn("taxid", F.col("f")[0]),
        "taxid",
        F.col("f")[1].alias("name"), F.col("f")[2].alias("rank"), F.col("f")[3].alias("parent"),
    )
    if rows.isEmpty():
        raise ValueError(f"no taxonomy in {path}")
    return complete_taxonomy(rows)


def read_coverage(spark: SparkSession, path: str | None) -> DataFrame:
    """Contig and coverage; no file, or none at the path, gives no rows."""
    empty = spark.createDataFrame([], "contig_id string, coverage double")
    if path is None:
        return empty
    try:
        rows = _data_fields(spark, path)
    except AnalysisException:
        return empty
    return _last_per(
        rows.withColumn("contig_id", F.col("f")[0]), "contig_id",
        F.col("f")[1].cast("double").alias("coverage"),
    )


def read_alignments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SAM rows: read, contig and length of the aligned sequence."""
    return read_function_alignments(spark, path).drop("function")


def read_function_alignments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SAM rows with the function whose folder the file lies in."""
    lines = spark.read.text(path).select(
        folder_value(F.col("_metadata.file_path")).alias("function"),
        F.regexp_replace("value", r"\r$", "").alias("line"))
    fields = lines.where(~F.col("line").startswith("@")).select(
        "function", F.split("line", "\t").alias("f")).where(F.size("f") > 9)
    return fields.select(
        "function", F.col("f")[0].alias("read_id"), F.col("f")[2].alias("contig_id"),
        F.length(F.col("f")[9]).alias("aligned_length"),
    )


def folder_value(file: Column) -> Column:
    """Name of the folder a file lies in; of a partition folder, the value."""
    folder = F.regexp_replace(F.regexp_extract(file, "([^/]+)/[^/]+$", 1), "^[^=]*=", "")
    # Spark escapes the path as a URL and, before that, the value of a partition.
    return F.url_decode(F.url_decode(F.replace(F.replace(folder, F.lit("+"), F.lit("%2B")), F.lit("%2B"), F.lit("%252B"))))


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample, forward file, reverse file (empty for single-end); replicate is the row number."""
    fields = _lines(spark, path).select("ord", F.split("line", "\t").alias("f"))
    reverse = F.coalesce(F.get("f", F.lit(2)), F.lit(""))
    return fields.select(
        F.col("f")[0].alias("sample_id"), F.col("f")[1].alias("fwd_path"),
        reverse.alias("rev_path"), (reverse != "").alias("is_paired_end"),
        (F.row_number().over(Window.orderBy("ord")) - 1).cast("string").alias("replicate"),
    )


def read_genome_sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The average genome size on file in each sample's folder."""
    sample = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    rows = spark.read.text(path).select(sample.alias("sample_id"), "value")
    return rows.where(F.col("value").startswith("average_genome_size:")).select(
        "sample_id",
        F.substring_index("value", "\t", -1).cast("double").alias("genome_size"),
    )


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """Annotated queries as nested JSON; a missing file gives no rows."""
    try:
        return spark.read.schema(ANNOTATED).json(path)
    except AnalysisException:
        return spark.createDataFrame([], ANNOTATED)
