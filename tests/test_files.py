"""Text readers on files with awkward records."""

from __future__ import annotations

import gzip

import pytest

from readloom.functions.ids import parse_read_id
from readloom.sinks.text import write_hits
from readloom.sources import fasta, fastq, tables
from readloom.sources.fastq import read_fastq
from pyspark.sql import functions as F


def records(n):
    """Quality lines that look like headers, plus lines and empty records."""
    for i in range(n):
        sequence = "ACGT" * (i % 7)
        quality = ("@+I#" * (i % 7)) if i % 3 else ("+@@+" * (i % 7))
        yield f"@r{i} 1:N:0:A", sequence, "+" if i % 2 else f"+r{i}", quality


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_fastq_ranges_see_every_record_once(spark, tmp_path, split, newline):
    want = list(records(83))
    path = tmp_path / "a.fq"
    path.write_bytes("".join(newline.join(r) + newline for r in want).encode())
    splits = max(split, path.stat().st_size // 40)
    got = read_fastq(spark, str(path), splits).drop("file").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_fastq_every_offset():
    """Cut a file at every byte: the two halves always hold every record once."""
    import io
    from readloom.sources.fastq import _records
    want = list(records(23))
    data = "".join("\n".join(r) + "\n" for r in want).encode()
    for cut in range(len(data) + 1):
        head = list(_records(io.BytesIO(data), 0, cut))
        tail = list(_records(io.BytesIO(data), cut, len(data))) if cut else want
        assert head + tail == want, cut


def test_fastq_gzip_and_folder(spark, tmp_path):
    want = list(records(30))
    with gzip.open(tmp_path / "a.fq.gz", "wt") as out:
        out.writelines("\n".join(r) + "\n" for r in want[:10])
    (tmp_path / "b.fq").write_text("".join("\n".join(r) + "\n" for r in want[10:]))
    got = read_fastq(spark, str(tmp_path)).drop("file").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    with pytest.raises(Exception, match="nowhere"):
        read_fastq(spark, str(tmp_path / "nowhere")).count()


def test_fastq_blank_lines_torn_records_and_commas(spark, tmp_path):
    path = tmp_path / "a,b.fq"
    path.write_text("\n@a\nACGT\n+\n@III\n\n\n@b\nAC\n+b\n+@\n\n")
    for splits in (1 << 20, 9):
        got = read_fastq(spark, [str(path)], splits).drop("file").collect()
        assert sorted(tuple(r) for r in got) == [("@a", "ACGT", "+", "@III"), ("@b", "AC", "+b", "+@")]
    for torn in ("@a\nACGT\n+\nIIII\n@b\nAC\n", "@a\nACGT\n+\nIII\n", "a\nACGT\n+\nIIII\n"):
        path.write_text(torn)
        with pytest.raises(Exception, match="no whole FASTQ record"):
            read_fastq(spark, [str(path)]).count()


def test_tables_keep_the_order_of_names_and_lines(spark, tmp_path):
    """The larger part comes second by name, and first when Spark packs splits."""
    folder = tmp_path / "My+sample x_pe1_ref.tsv"
    folder.mkdir()
    line = "q|{0}\tp{0}\t90.0\t30\t1\t0\t1\t30\t1\t30\t1e-5\t60.0\n"
    (folder / "part-00000").write_text("".join(line.format(k) for k in range(3)))
    (folder / "part-00001").write_text("".join(line.format(k) for k in range(3, 4000)))
    rows = tables._in_order(spark.read.text(str(folder))).orderBy("ord").select("value").collect()
    assert [r["value"].split("\t")[1] for r in rows] == [f"p{k}" for k in range(4000)]


def test_fasta_folded_and_gzip(spark, tmp_path):
    text = ">a first\nACGT\nAC\n>b\n>c last\r\nGG\r\nTT\r\n"
    with gzip.open(tmp_path / "x.fa.gz", "wt", newline="") as out:
        out.write(text)
    got = {r["header"]: r["sequence"] for r in fasta.read_fasta(spark, str(tmp_path)).collect()}
    assert got == {"a first": "ACGTAC", "b": "", "c last": "GGTT"}


@pytest.mark.parametrize("line,read_id,end", [
    ("@X:1078#CTCTCT/1", "X:1078#CTCTCT", "1"),
    ("@K00364:132:9069 1:N:0:AAG", "K00364:132:9069", "1"),
    ("@SRR6048159.1.1 1 length=151", "SRR6048159.1", "1"),
    ("SRR6048159.1.2", "SRR6048159.1", "2"),
    ("WP_0123.1", "WP_0123.1", ""),
    ("a b c d", "a", ""),
    ("a b c", "a", ""),
    ("plain", "plain", ""),
])
def test_header_styles(spark, line, read_id, end):
    row = spark.createDataFrame([(line,)], "line string").select(
        parse_read_id(F.col("line")).alias("p")
    ).first()["p"]
    assert (row["read_id"], row["end"]) == (read_id, end)


def test_hit_table_bad_row_fails(spark, tmp_path):
    good = "r/1\tp\t87.9\t33\t4\t101\t100\t2\t1\t33\t1.1e-09\t58.5\n"
    path = tmp_path / "S1_pe1_hits.txt"
    path.write_text(good)
    [row] = tables.read_reference_hits(spark, str(path)).collect()
    assert (row["sample_id"], row["end"], row["read_id"]) == ("S1", "pe1", "r")
    assert (row["q_start"], row["q_end"], row["bitscore"]) == (100, 2, 58.5)
    path.write_text(good + good.replace("87.9", "high"))
    with pytest.raises(Exception):
        tables.read_reference_hits(spark, str(path)).collect()


def test_hit_order_follows_the_file(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        path = tmp_path / "S1_pe1_hits.txt"
        path.write_text("".join(
            f"r\tp{i}\t87.9\t33\t4\t101\t1\t60\t1\t33\t1e-09\t58.5\n" for i in range(2000)))
        rows = tables.read_reference_hits(spark, str(path))
        assert rows.rdd.getNumPartitions() > 1
        ordered = [r["subject_id"] for r in rows.orderBy("ord").collect()]
        assert ordered == [f"p{i}" for i in range(2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hit_table_round_trip(spark, tmp_path):
    path = tmp_path / "S1_pe1_in.txt"
    path.write_text("r\tp\t87.9\t33\t4\t101\t99\t1\t1\t33\t1e-09\t58.5\n")
    rows = tables.read_reference_hits(spark, str(path))
    write_hits(rows, str(tmp_path / "S1_pe1_out"))
    again = tables.read_reference_hits(spark, str(tmp_path / "S1_pe1_out"))
    assert again.drop("ord").collect() == rows.drop("ord").collect()


def test_region_key_with_pipes(spark, tmp_path):
    path = tmp_path / "S1_pe2_hits.txt"
    path.write_text("a|b|100|2\tp\t87.9\t33\t4\t101\t99\t1\t1\t33\t1e-09\t58.5\n")
    [row] = tables.read_background_hits(spark, str(path)).collect()
    assert (row["read_id"], row["r_start"], row["r_end"]) == ("a|b", 100, 2)


def test_catalogue_files(spark, tmp_path):
    (tmp_path / "f.tsv").write_text(
        "#x\nA\tname a\tg1\nB\tname b\tg2\t60\t80\t75\t70\t65\t62\t61\t60\nA\tnewer\tg1\nC\tshort\n")
    got = {r["function"]: r for r in tables.read_functions(spark, str(tmp_path / "f.tsv")).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"]["name"] == "newer" and got["A"]["cutoffs"] == {}
    assert got["B"]["cutoffs"]["species"] == 80.0 and got["B"]["cutoffs"]["norank"] == 60.0
    (tmp_path / "p.tsv").write_text("p1\t571\tsrc\tA|B\np1\t573\tx\tsrc2\tB\np2\t5\tA\n")
    [row] = tables.read_proteins(spark, str(tmp_path / "p.tsv")).collect()
    assert (row["taxid"], row["functions"], row["source"]) == ("573", ["B"], "src2")


def test_missing_and_empty_files(spark, tmp_path):
    assert tables.read_coverage(spark, None).count() == 0
    assert tables.read_coverage(spark, str(tmp_path / "no")).count() == 0
    assert tables.read_annotated(spark, str(tmp_path / "no")).count() == 0
    (tmp_path / "t.tsv").write_text("")
    with pytest.raises(ValueError, match="no taxonomy"):
        tables.read_taxonomy(spark, str(tmp_path / "t.tsv"))


@pytest.fixture
def text_splits(spark):
    """Sets how many bytes a split of Spark's own readers has."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {name: spark.conf.get(name) for name in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
    yield set_size
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("split", [11, 64, 1000, 1 << 20])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_fastq_through_text_splits(spark, tmp_path, text_splits, split, newline):
    want = list(records(83))
    (tmp_path / "a+b c.fq").write_bytes("".join(newline.join(r) + newline for r in want).encode())
    text_splits(split)
    got = fastq.read_fastq_as_text(spark, [str(tmp_path)]).drop("file").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_fastq_of_a_store_only_spark_opens(spark, tmp_path):
    want = list(records(40))
    with gzip.open(tmp_path / "a.fq.gz", "wt") as out:
        out.writelines("\n".join(r) + "\n" for r in want[:15])
    (tmp_path / "b.fq").write_text("\n\n" + "".join("\n".join(r) + "\n" for r in want[15:]) + "\n")
    (tmp_path / "c.fq").write_text("")
    spark.sparkContext._jsc.hadoopConfiguration().set(
        "fs.viewfs.mounttable.reads.link./in", f"file://{tmp_path}")
    table = read_fastq(spark, "viewfs://reads/in")
    assert sorted(tuple(r) for r in table.drop("file").collect()) == sorted(want)
    assert {r["file"].rsplit("/", 1)[1] for r in table.select("file").distinct().collect()} == {"a.fq.gz", "b.fq"}


@pytest.mark.parametrize("split", [9, 1 << 20])
@pytest.mark.parametrize("torn", [
    "@a\nACGT\n+\nIIII\n@b\nAC\n", "@a\nACGT\n+\nIII\n", "a\nACGT\n+\nIIII\n", "@a\nACGT\n+\n@II\n",
    "@a\nACGT\n+\n", "@a\nACGT\n-\nIIII\n"])
def test_torn_fastq_through_text_splits_is_refused(spark, tmp_path, text_splits, split, torn):
    (tmp_path / "a.fq").write_text(torn)
    text_splits(split)
    with pytest.raises(Exception, match="no whole FASTQ record"):
        fastq.read_fastq_as_text(spark, [str(tmp_path)]).collect()


def test_sample_and_end_are_read_off_each_file_once(spark, tmp_path):
    rows = [f"q{i}\tP{i}\t90.0\t30\t1\t0\t1\t90\t1\t30\t1e-9\t50.0\n" for i in range(4)]
    for name in ("S1_pe1_hits", "S2_pe2_hits"):
        (tmp_path / f"{name}.txt").write_text("".join(rows))
    table = tables.read_reference_hits(spark, [str(tmp_path / f"{n}.txt") for n in ("S1_pe1_hits", "S2_pe2_hits")])
    found = sorted((r["sample_id"], r["end"], r["query_id"]) for r in table.collect())
    assert found == sorted((s, e, f"q{i}") for s, e in (("S1", "pe1"), ("S2", "pe2")) for i in range(4))
    # The name is looked for on the side of the list of files, not on the rows.
    plan = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
    looking = [line for line in plan if "RLIKE" in line]
    assert looking and all("_number" in line and "query_id" not in line for line in looking)
