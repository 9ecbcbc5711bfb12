"""Domain tables built from the benchmark's relational tables.

Every rule here has the same wording in the oracle's SQL views.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.ids import region_key
from readloom.operators.assembly import align_contigs, gene_abundance
from readloom.operators.catalogue import protein_dimension
from readloom.operators.classify import (
    classify_by_coverage, classify_reads, find_candidates,
)
from readloom.operators.coverage import protein_abundance
from readloom.operators.samples import average_read_lengths
from readloom.operators.taxonomy import complete_taxonomy, taxon_dimension
from readloom.params import RunParams
from readloom.session import Stages, sorted_groups

READ_KEYS = ["sample_id", "end", "read_id"]
GENE_KEYS = ["gene_id"]


class Domain:
    """Lazy domain views over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str, params: RunParams | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.params = params or RunParams()
        self.stages = Stages(spark, self.folder.rsplit("/", 1)[-1])
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    # Taxonomy and catalogues -------------------------------------------------------------

    @property
    def taxonomy_rows(self) -> DataFrame:
        """Taxonomy as a source file would list it: root, cellular node, and the geography."""
        fixed = self.spark.createDataFrame(
            [("1", "root", "no rank", "1"), ("131567", "cellular organisms", "no rank", "1")],
            "taxid string, name string, rank string, parent string",
        )
        region = self.source("region").select(
            (F.col("r_regionkey") + 10).cast("string").alias("taxid"),
            F.col("r_name").alias("name"), F.lit("superkingdom").alias("rank"),
            F.when(F.col("r_regionkey") == 4, "1").otherwise("131567").alias("parent"),
        )
        nation = self.source("nation").select(
            (F.col("n_nationkey") + 100).cast("string").alias("taxid"),
            F.col("n_name").alias("name"), F.lit("phylum").alias("rank"),
            (F.col("n_regionkey") + 10).cast("string").alias("parent"),
        )
        clade = self.source("nation").select(
            (F.col("n_nationkey") + 500).cast("string").alias("taxid"),
            F.concat(F.lit("Clade ("), F.col("n_nationkey").cast("string"), F.lit(")"))
            .alias("name"),
            F.lit("no rank").alias("rank"),
            (F.col("n_nationkey") + 100).cast("string").alias("parent"),
        )
        supplier = self.source("supplier").select(
            (F.col("s_suppkey") + 1000).cast("string").alias("taxid"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_suppkey") % 3 == 0, "genus").otherwise("species").alias("rank"),
            (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 2 == 0, 500).otherwise(100))
            .cast("string").alias("parent"),
        )
        rows = fixed
        for part in (region, nation, clade, supplier):
            rows = rows.unionByName(part)
        return rows

    @property
    def taxonomy(self) -> DataFrame:
        return complete_taxonomy(self.taxonomy_rows)

    @property
    def taxa(self) -> DataFrame:
        return self.stages.dimension("taxa", lambda: taxon_dimension(self.taxonomy))

    @property
    def proteins(self) -> DataFrame:
        suppliers = self.source("supplier").agg(F.count("*")).scalar()
        second = F.concat(F.lit("Brand#"), (F.col("p_size") % 25 + 1).cast("string"))
        two = (F.col("p_partkey") % 7 == 0) & (second != F.col("p_brand"))
        return (
            self.source("part")
            .where(F.col("p_partkey") % 13 != 0)
            .withColumn("suppliers", suppliers)
            .select(
                F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("protein_id"),
                F.when(F.col("p_partkey") % 41 == 0, "0")
                .otherwise((F.col("p_partkey") % F.col("suppliers") + 1000).cast("string"))
                .alias("taxid"),
                F.when(two, F.array("p_brand", second)).otherwise(F.array("p_brand"))
                .alias("functions"),
                F.col("p_type").alias("source"),
            )
        )

    @property
    def functions(self) -> DataFrame:
        """Functions with a number divisible by 5 list no cutoffs."""
        number = F.substring_index("p_brand", "#", -1).cast("int")
        own = F.when(F.col("k") % 5 != 0, F.lit(50.0) + 5 * (F.col("k") % 4))
        # The rank cutoffs every listed function has.
        ranks = {"superkingdom": 50.0, "phylum": 55.0, "class": 60.0, "order": 65.0,
                 "family": 70.0, "genus": 75.0, "species": 80.0}
        listed = [c for rank, cutoff in ranks.items() for c in (F.lit(rank), F.lit(cutoff))]
        return (
            self.source("part").select(F.col("p_brand").alias("function"), number.alias("k"))
            .distinct()
            .select(
                "function",
                F.concat(F.lit("Function "), F.col("k").cast("string")).alias("name"),
                F.concat(F.lit("G"), (F.col("k") % 4).cast("string")).alias("group"),
                own.alias("function_cutoff"),
                F.when(own.isNotNull(), F.create_map(F.lit("norank"), own, *listed))
                .otherwise(F.create_map().cast("map<string,double>"))
                .alias("cutoffs"),
            )
        )

    @property
    def function_catalogue(self) -> DataFrame:
        return self.stages.dimension("functions", lambda: self.functions)

    @property
    def protein_catalogue(self) -> DataFrame:
        return self.stages.dimension(
            "proteins",
            lambda: protein_dimension(
                self.proteins, self.function_catalogue, self.taxa, self.params
            ),
            key="protein_id",
        )

    @cached_property
    def function_list(self) -> list[str]:
        """Function ids in order; a catalogue column used for report headers."""
        rows = self.function_catalogue.select("function").orderBy("function").collect()
        return [row["function"] for row in rows]

    # Reads -------------------------------------------------------------------------------

    @property
    def _lines(self) -> DataFrame:
        """Lines of known parts, each a hit if its order is known too."""
        parts = self.source("part").select("p_partkey", "p_size")
        return self.source("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))

    @property
    def _orders(self) -> DataFrame:
        return self.source("orders").select(
            "o_orderkey",
            F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("sample_id"),
        )

    @property
    def hits(self) -> DataFrame:
        """Aligned hits of both searches; ``searched`` tells them apart.

        Orders are joined last: rows are then dealt out by order, as ``place_in_regions`` asks for.
        """
        start = F.col("l_partkey") % 80 + 1
        length = F.col("l_quantity").cast("int") + 10
        end = start + 3 * length - 1
        forward = F.col("l_suppkey") % 2 == 0
        return self._lines.join(self._orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "sample_id",
            F.when(F.col("l_linestatus") == "F", "pe1").otherwise("pe2").alias("end"),
            F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("read_id"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("subject_id"),
            (F.lit(50.0) + ((37 * F.col("l_partkey") + 11 * F.col("l_suppkey")) % 500) / 10.0)
            .alias("identity"),
            length.alias("length"),
            (F.col("l_suppkey") % 10).cast("int").alias("mismatch"),
            (F.lit(60) + 10 * F.col("p_size")).cast("int").alias("s_len"),
            F.when(forward, start).otherwise(end).cast("int").alias("q_start"),
            F.when(forward, end).otherwise(start).cast("int").alias("q_end"),
            (F.col("l_suppkey") % 50 + 1).cast("int").alias("s_start"),
            (F.col("l_suppkey") % 50 + length).cast("int").alias("s_end"),
            F.lit(1e-5).alias("evalue"),
            (F.lit(40.0) + (13 * F.col("l_partkey") + 7 * F.col("l_linenumber")) % 50)
            .alias("bitscore"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("ord"),
            F.when(F.col("l_returnflag") == "A", "ref").otherwise("bg").alias("searched"),
            F.col("l_orderkey").alias("order_key"),
            F.col("l_partkey").alias("part_key"),
        )

    @property
    def reference_hits(self) -> DataFrame:
        return self.hits.where(F.col("searched") == "ref").drop("searched")

    @property
    def background_rows(self) -> DataFrame:
        return self.hits.where(F.col("searched") == "bg").drop("searched")

    @property
    def candidates(self) -> DataFrame:
        return self.stages.table(
            "candidates",
            lambda: find_candidates(
                self.reference_hits, self.protein_catalogue, self.params, READ_KEYS
            ),
        )

    def place_in_regions(
        self, rows: DataFrame, candidates: DataFrame, keys: list[str],
        order_key: Column | None = None,
    ) -> DataFrame:
        """Give every second-search row the region its query would have been cut from.

        Where a query's name tells its order, ``order_key`` reads it: rows that are dealt out by order
        then meet the candidates of theirs where they are.
        """
        spots = candidates.select(
            *keys,
            F.transform(
                "hits",
                lambda h: F.struct(h["q_start"].alias("r_start"), h["q_end"].alias("r_end")),
            ).alias("spots"),
        )
        number = F.pmod(F.col("part_key") + F.col("ord"), F.size("spots")).cast("int")
        if order_key is None:
            met = rows.join(spots, keys)
        else:
            of_order = spots.groupBy(order_key.alias("order_key")).agg(
                F.collect_list(F.struct(*keys, "spots")).alias("queries"))
            own = F.filter("queries", lambda q: reduce(
                lambda a, b: a & b, [q[k] == F.col(k) for k in keys]))
            # One at most; unlike a filter, no later condition is moved before it.
            met = rows.join(of_order, "order_key").select(
                *rows.columns, F.explode(F.transform(own, lambda q: q["spots"])).alias("spots"))
        return (
            met.withColumn("spot", F.get("spots", number))
            .select(*rows.columns, "spot.r_start", "spot.r_end")
        )

    @property
    def background_hits(self) -> DataFrame:
        order_key = F.substring("read_id", 2, 30).cast("bigint")
        return self.place_in_regions(
            self.background_rows, self.candidates, READ_KEYS, order_key)

    @property
    def background_queries(self) -> DataFrame:
        """The second search as its table lists it: the region key is the query id."""
        key = region_key(F.col("read_id"), F.col("r_start"), F.col("r_end"))
        return self.background_hits.withColumn("query_id", key)

    @property
    def samples(self) -> DataFrame:
        """Library sizes are counted from the hit table; S5 has no insert size on record."""
        def build() -> DataFrame:
            # The ends of an order's lines are found first, so that lines do not travel.
            forward = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
            ends = self._lines.groupBy("l_orderkey").agg(
                F.bool_or(forward).alias("pe1"), F.bool_or(~forward).alias("pe2"))
            reads = ends.join(
                self._orders, F.col("l_orderkey") == F.col("o_orderkey")
            ).select("sample_id", "l_orderkey", "pe1", "pe2").distinct()
            return reads.groupBy("sample_id").agg(
                F.count_if("pe1").alias("fwd_reads"), F.count_if("pe2").alias("rev_reads"),
            ).select(
                "sample_id",
                F.concat(F.lit("Sample "), F.substring("sample_id", 2, 10)).alias("sample_name"),
                F.lit(True).alias("is_paired_end"),
                (F.substring("sample_id", 2, 10).cast("int") - 1).cast("string").alias("replicate"),
                "fwd_reads", "rev_reads",
                (F.col("fwd_reads") * 150).alias("fwd_bases"),
                (F.col("rev_reads") * 150).alias("rev_bases"),
                F.lit(3.0e6).alias("genome_size"),
                F.when(F.col("sample_id") == "S5", 0.0).otherwise(300.0).alias("insert_size"),
            )
        return self.stages.dimension("samples", build)

    @property
    def single_samples(self) -> DataFrame:
        return self.samples.withColumn("is_paired_end", F.lit(False))

    @cached_property
    def sample_list(self) -> list[str]:
        rows = self.samples.select("sample_id").orderBy("sample_id").collect()
        return [row["sample_id"] for row in rows]

    def classified_reads(self) -> DataFrame:
        return classify_reads(
            self.candidates, self.background_hits, self.protein_catalogue,
            average_read_lengths(self.samples), self.params, READ_KEYS, self.taxa,
        )

    @property
    def annotated(self) -> DataFrame:
        """Annotated reads, the table every read report starts from."""
        with sorted_groups(self.spark):
            return self.stages.table(
                "annotated", self.classified_reads, partition_by=("sample_id", "end")
            )

    @property
    def annotated_single(self) -> DataFrame:
        return self.annotated.where(F.col("end") == "pe1")

    # Text of reads -----------------------------------------------------------------------

    @property
    def read_texts(self) -> DataFrame:
        """One FASTQ record per document and end; the header style follows the document id."""
        letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", "N"))
        ends = F.array(
            F.struct(F.lit("pe1").alias("end"), F.lit("1").alias("n"), letters.alias("sequence")),
            F.struct(F.lit("pe2").alias("end"), F.lit("2").alias("n"),
                     F.reverse(letters).alias("sequence")),
        )
        name = F.concat(F.lit("R"), F.col("doc_id").cast("string"))
        style = F.col("doc_id") % 5
        header = (
            F.when(style == 0, F.concat(name, F.lit("/"), "n"))
            .when(style == 1, F.concat(name, F.lit(" "), "n", F.lit(":N:0:AAG")))
            .when(style == 2, F.concat(name, F.lit("."), "n", F.lit(" "), "n", F.lit(" length=9")))
            .when((style == 3) & (F.col("doc_id") % 2 == 1),
                  F.concat(name, F.lit(".7."), "n"))
            .when(style == 3, F.concat(F.lit("WP_0"), F.col("doc_id").cast("string"), F.lit(".1")))
            .otherwise(F.concat(name, F.lit(" b c d")))
        )
        return (
            self.source("documents").select("doc_id", F.inline(ends))
            .withColumn("header", F.concat(F.lit("@"), header))
            .withColumn("quality", F.repeat(F.lit("I"), F.length("sequence")))
            .select("doc_id", "end", "header", "sequence", F.lit("+").alias("line3"), "quality")
        )

    # Proteins ----------------------------------------------------------------------------

    def _with_sizes(self, df: DataFrame) -> DataFrame:
        """Add the number of contigs (five per supplier) and of parts."""
        contigs = self.source("supplier").agg(F.count("*") * 5).scalar()
        parts = self.source("part").agg(F.count("*")).scalar()
        return df.withColumn("contig_count", contigs).withColumn("part_count", parts)

    def _as_protein_hits(self, read_id, hits: DataFrame) -> DataFrame:
        start = (F.col("part_key") % 40 + 1).cast("int")
        return (
            self._with_sizes(hits)
            .withColumn("read_id", read_id)
            .withColumn("q_start", start)
            .withColumn("q_end", start + F.col("length") - 1)
            .drop("contig_count", "part_count")
        )

    @property
    def protein_hits(self) -> DataFrame:
        contig = (F.col("order_key") % F.col("contig_count")).cast("string")
        name = F.concat(F.lit("xC"), contig, F.lit("_"), F.col("order_key").cast("string"))
        return self._as_protein_hits(name, self.hits).withColumn("end", F.lit("pe1"))

    @property
    def coverage(self) -> DataFrame:
        """Coverage of each sample's contigs; contigs numbered in sevens are not on file."""
        orders = self.source("orders").select("o_orderkey", "o_orderpriority")
        contig = F.col("l_orderkey") % F.col("contig_count")
        lines = self.source("lineitem").join(
            orders, F.col("l_orderkey") == F.col("o_orderkey")
        )
        return (
            self._with_sizes(lines)
            .withColumn("k", contig)
            .where(F.col("k") % 7 != 0)
            .groupBy(
                F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("sample_id"),
                F.concat(F.lit("C"), F.col("k").cast("string")).alias("contig_id"),
            )
            .agg((F.avg("l_quantity") / 10.0).alias("coverage"))
        )

    @property
    def protein_texts(self) -> DataFrame:
        """FASTA records of the query proteins, one per order."""
        contig = (F.col("o_orderkey") % F.col("contig_count")).cast("string")
        name = F.concat(F.lit("xC"), contig, F.lit("_"), F.col("o_orderkey").cast("string"))
        length = (F.lit(100) + F.col("o_orderkey") % 300).cast("int")
        return self._with_sizes(self.source("orders")).select(
            F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("sample_id"),
            F.concat(name, F.lit(" predicted protein")).alias("header"),
            name.alias("read_id"),
            F.substring(F.repeat(F.lit("MKVLA"), 80), F.lit(1), length).alias("sequence"),
        )

    @property
    def protein_candidates(self) -> DataFrame:
        def build() -> DataFrame:
            rows = self.protein_hits.where(F.col("searched") == "ref")
            return find_candidates(rows, self.protein_catalogue, self.params, READ_KEYS)
        return self.stages.table("protein_candidates", build)

    def classified_proteins(self) -> DataFrame:
        rows = self.protein_hits.where(F.col("searched") == "bg")
        order_key = F.substring_index("read_id", "_", -1).cast("bigint")
        background = self.place_in_regions(rows, self.protein_candidates, READ_KEYS, order_key)
        abundance = protein_abundance(
            self.protein_candidates.select(*READ_KEYS), self.coverage
        )
        return classify_by_coverage(
            self.protein_candidates, background, self.protein_catalogue, abundance,
            self.params, READ_KEYS, keep_good=False, taxa=self.taxa,
        )

    @property
    def annotated_proteins(self) -> DataFrame:
        with sorted_groups(self.spark):
            return self.stages.table(
                "annotated_proteins", self.classified_proteins, partition_by=("sample_id", "end")
            )

    @property
    def protein_samples(self) -> DataFrame:
        return self.samples.withColumn("is_paired_end", F.lit(False))

    # Assembly ----------------------------------------------------------------------------

    @staticmethod
    def _assembly_function(k):
        """The function whose reads a contig was assembled from."""
        return F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string"))

    @property
    def contigs(self) -> DataFrame:
        k = F.col("k")
        length = (F.lit(250) + (k * 37) % 400).cast("int")
        return (
            self._with_sizes(self.source("part"))
            .select((F.col("p_partkey") % F.col("contig_count")).alias("k")).distinct()
            .select(
                self._assembly_function(k).alias("function"),
                F.concat(F.lit("C"), k.cast("string")).alias("contig_id"),
                F.substring(
                    F.repeat(F.lit("ACGTN"), 131), (k % 5 + 1).cast("int"), length
                ).alias("sequence"),
            )
        )

    @property
    def _line_name(self) -> Column:
        return F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("_"),
                        F.col("l_linenumber").cast("string"))

    @property
    def _assembled_lines(self) -> DataFrame:
        orders = self.source("orders").select("o_orderkey", "o_orderpriority")
        k = F.col("l_orderkey") % F.col("contig_count")
        lines = self.source("lineitem").join(
            orders, F.col("l_orderkey") == F.col("o_orderkey")
        )
        return (
            self._with_sizes(lines)
            .select(
                self._assembly_function(k).alias("function"),
                F.concat(F.lit("C"), k.cast("string")).alias("contig_id"), self._line_name.alias("read_id"),
                F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("sample_id"),
                (F.lit(50) + F.col("l_quantity").cast("int")).alias("aligned_length"),
                "l_returnflag", "l_orderkey", "l_linenumber",
            )
        )

    @property
    def assembly_reads(self) -> DataFrame:
        """The sample each exported read came from, the first one where it came twice.

        A line's order and number are its name, and lines are dealt out by order; those without a number
        have no name.
        """
        lines = self._assembled_lines
        first = F.min("sample_id").alias("sample_id")
        numbered = lines.where(F.col("l_linenumber").isNotNull()).groupBy(
            "l_orderkey", "l_linenumber", "function").agg(first)
        unnamed = lines.where(F.col("l_linenumber").isNull()).groupBy("function", "read_id").agg(first)
        return numbered.select("function", self._line_name.alias("read_id"), "sample_id").unionByName(unnamed)

    @property
    def alignments(self) -> DataFrame:
        return self._assembled_lines.where(F.col("l_returnflag") != "R").select(
            "function", "contig_id", "read_id", "aligned_length"
        )

    @property
    def genes(self) -> DataFrame:
        k = F.col("p_partkey") % F.col("contig_count")
        start = F.col("p_partkey") * 7 % 60 + 1
        protein_length = F.lit(60) + F.col("p_size") * 10
        contig_length = F.lit(250) + (k * 37) % 400
        return self._with_sizes(self.source("part")).select(
            F.concat(
                self._assembly_function(k), F.lit("|C"), k.cast("string"), F.lit("_"),
                F.col("p_partkey").cast("string"),
            ).alias("gene_id"),
            start.cast("int").alias("gene_start"),
            F.least(contig_length, start + protein_length * 3 - 1).cast("int").alias("gene_end"),
            F.when(F.col("p_partkey") % 2 == 0, "1").otherwise("-1").alias("strand"),
            F.substring(F.repeat(F.lit("MKVLA"), 113), F.lit(1), protein_length)
            .alias("protein_sequence"),
            F.col("p_partkey").alias("part_key"),
        )

    @property
    def gene_hits(self) -> DataFrame:
        p = F.col("order_key") % F.col("part_count")
        k = p % F.col("contig_count")
        name = F.concat(
            self._assembly_function(k), F.lit("|C"), k.cast("string"), F.lit("_"),
            p.cast("string"),
        )
        return (
            self._as_protein_hits(name, self.hits)
            .drop("sample_id", "end")
            .withColumnRenamed("read_id", "gene_id")
        )

    @property
    def gene_candidates(self) -> DataFrame:
        def build() -> DataFrame:
            rows = self.gene_hits.where(F.col("searched") == "ref")
            return find_candidates(
                rows, self.protein_catalogue, self.params, GENE_KEYS, fixed_identity=True
            )
        return self.stages.table("gene_candidates", build)

    @property
    def contig_samples(self) -> DataFrame:
        """Reads and aligned positions per contig and sample."""
        return self.stages.table(
            "contig_samples",
            lambda: align_contigs(self.alignments, self.contigs, self.assembly_reads),
        )

    def classified_genes(self) -> DataFrame:
        rows = self.gene_hits.where(F.col("searched") == "bg")
        background = self.place_in_regions(rows, self.gene_candidates, GENE_KEYS)
        abundance = gene_abundance(
            self.gene_candidates.select("gene_id"), self.contigs, self.contig_samples
        )
        return classify_by_coverage(
            self.gene_candidates, background, self.protein_catalogue, abundance,
            self.params, GENE_KEYS, keep_good=True, taxa=self.taxa,
        )

    @property
    def annotated_genes(self) -> DataFrame:
        with sorted_groups(self.spark):
            return self.stages.table("annotated_genes", self.classified_genes)
