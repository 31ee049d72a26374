"""Readers: text formats of sequencing and annotation data as DataFrames, split by Spark, never opened on the driver."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixloom.functions.seq import gtf_attributes, mismatches


def tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = False, comment: str | None = None) -> DataFrame:
    """SRC1: tab-separated text, plain or compressed. Empty fields are empty strings; without a schema all columns are text."""
    reader = spark.read.option("sep", "\t").option("quote", "").option("header", header).option("nullValue", "\0").option("emptyValue", "")
    if comment:
        reader = reader.option("comment", comment)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def groups(df: DataFrame, key: str, order: str) -> DataFrame:
    """SRC2: all rows of a key as a sorted array; rows of a key needn't be next to each other."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *rest))).alias("rows"))


FASTQ_ROW = "file string, ord bigint, read_id string, seq string, qual string"
#: Numbers kept for the lines of a byte of a split: compressed text has many lines to a byte.
LINES_PER_BYTE = 4096


class _Framer:
    """Records of four lines out of the lines of splits, in their order.

    A line is a header if it starts with @ and the next but one with +: a quality line may start with @, but the next but
    one after it is a sequence. What precedes a split's first header, and the record that its end cuts, are loose lines.
    """

    def __init__(self):
        self.key, self.held, self.at, self.framed = None, [], 0, False

    def flush(self) -> list[tuple]:
        """What is held of the last split, as loose lines: (file, split's start, number of the line, line)."""
        out = [(*self.key, self.at + i, x) for i, x in enumerate(self.held)] if self.key else []
        self.held, self.at, self.framed = [], 0, False
        return out

    def feed(self, batch: pa.RecordBatch) -> Iterator[tuple[list[tuple], tuple | None]]:
        """Loose lines and framed records (file, start, number of the first line, lines) of a batch of value, file, start."""
        files = batch.column(1).dictionary_encode()
        which, start = files.indices.to_numpy(), batch.column(2).to_numpy()
        cut = np.flatnonzero((which[1:] != which[:-1]) | (start[1:] != start[:-1])) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if lo == hi:
                continue
            key = (files.dictionary[int(which[lo])].as_py(), int(start[lo]))
            loose = []
            if key != self.key:
                loose = self.flush()
                self.key = key
            lines = batch.column(0).slice(lo, hi - lo)
            if self.held:
                lines = pa.concat_arrays([pa.array(self.held, lines.type), lines])
            if not self.framed:
                head, plus = (pc.starts_with(lines, x).to_numpy(zero_copy_only=False) for x in "@+")
                heads = np.flatnonzero(head[:-2] & plus[2:])
                if not len(heads):
                    self.held = lines.to_pylist()
                    yield loose, None
                    continue
                first = int(heads[0])
                loose += [(*key, self.at + i, x) for i, x in enumerate(lines.slice(0, first).to_pylist())]
                lines, self.at, self.framed = lines.slice(first), self.at + first, True
            n = len(lines) // 4 * 4
            yield loose, (*key, self.at, lines.slice(0, n)) if n else None
            self.held, self.at = lines.slice(n).to_pylist(), self.at + n


def _whole_records(batches):
    framer = _Framer()
    for batch in batches:
        for _, found in framer.feed(batch):
            if found:
                file, start, at, lines = found
                n = len(lines) // 4
                ids, seqs, quals = (lines.take(pa.array(np.arange(k, 4 * n, 4))) for k in (0, 1, 3))
                ord_ = start * LINES_PER_BYTE + at + 4 * np.arange(n)
                yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(ord_), pc.utf8_slice_codeunits(ids, 1), seqs, quals], names=["file", "ord", "read_id", "seq", "qual"])


def _loose_lines(batches):
    framer = _Framer()
    names = ["file", "start", "at", "line"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        for loose, _ in framer.feed(batch):
            if loose:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*loose, strict=True), types, strict=True)], names=names)
    loose = framer.flush()
    if loose:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*loose, strict=True), types, strict=True)], names=names)


def _cut_records(lines: pd.DataFrame) -> pd.DataFrame:
    """One file's loose lines, a few for each of its splits, framed in order; an incomplete record at the end is left out."""
    lines = lines.sort_values(["start", "at"], ignore_index=True)
    n = len(lines) // 4 * 4
    head = lines.iloc[0:n:4]
    out = {"file": head["file"], "ord": head["start"] * LINES_PER_BYTE + head["at"], "read_id": head["line"].str.slice(1)}
    return pd.DataFrame({k: v.to_numpy() for k, v in out.items()} | {"seq": lines["line"].iloc[1:n:4].to_numpy(), "qual": lines["line"].iloc[3:n:4].to_numpy()})


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: file, ord (the order of records in their file), read_id, seq, qual; plain or compressed text.

    Splits are those of the text source (one for a gzip file), and each is framed by itself. Only the records that a split's
    end cuts are put together by file, from a second pass that returns nothing but these lines.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    loose = lines.mapInArrow(_loose_lines, "file string, start bigint, at bigint, line string")
    return lines.mapInArrow(_whole_records, FASTQ_ROW).union(loose.groupBy("file").applyInPandas(_cut_records, FASTQ_ROW))


#: Endings of read files, and how the names of mates differ (fixed values).
READ_FILES = (".fq", ".fastq", ".fq.gz", ".fastq.gz", ".fq.bz2", ".fastq.bz2")
MATE_MARKS = (("_1.", "_2."), ("_R1.", "_R2."), ("_R1_", "_R2_"), (".1.", ".2."))


def read_files(spark: SparkSession, folder: str) -> tuple[list[tuple[str, str]], list[str]]:
    """SRC23: the read files of a folder in order of their names: pairs of mates, and files without a mate.

    The folder is listed by Hadoop's file system, so it may be on any store that Spark reads. File names reach the driver.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    paths = sorted(x.getPath().toString() for x in listed if x.isFile() and x.getLen() > 0 and x.getPath().getName().endswith(READ_FILES))
    pairs, taken = [], set()
    for p in paths:
        folder_, name = p.rsplit("/", 1)
        for one, two in MATE_MARKS:
            at = name.rfind(one)
            mate = f"{folder_}/{name[:at]}{two}{name[at + len(one):]}"
            if at >= 0 and mate in paths and not taken & {p, mate}:
                pairs.append((p, mate))
                taken |= {p, mate}
                break
    return pairs, [p for p in paths if p not in taken]


def paired_fastq(spark: SparkSession, first: str, second: str) -> DataFrame:
    """SRC4: frag, seq_1, qual_1, seq_2, qual_2, joined by the id without its mate mark."""
    frag = F.regexp_replace(F.regexp_replace("read_id", r"\s.*$", ""), r"[/.][12]$", "")
    a, b = (fastq(spark, p).select(frag.alias("frag"), F.col("seq").alias(f"seq_{i}"), F.col("qual").alias(f"qual_{i}")) for i, p in ((1, first), (2, second)))
    return a.join(b, "frag")


def unpaired(first: DataFrame, second: DataFrame) -> DataFrame:
    """Ids that only one of two read tables has; a synchronised pair of files has none."""
    frag = F.regexp_replace("read_id", r"[/.][12]$", "").alias("frag")
    a, b = first.select(frag), second.select(frag)
    return a.join(b, "frag", "left_anti").union(b.join(a, "frag", "left_anti"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: id (up to the first blank), seq."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v"))
    head = F.regexp_extract("v", r"^([^\s]*)", 1)
    body = F.regexp_replace(F.regexp_replace("v", r"^[^\n]*(\n|$)", ""), r"\s", "")
    return rows.where("trim(v) <> ''").select(head.alias("id"), body.alias("seq"))


def sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC6: alignment rows with nm, and the table rname, length."""
    lines = spark.read.text(path)
    parts = F.split("value", "\t")
    head = lines.where("value like '@SQ%'").select(F.regexp_extract("value", r"\tSN:([^\t]*)", 1).alias("rname"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("bigint").alias("length"))
    names = (("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "int"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "int"), ("tlen", "int"), ("seq", "string"), ("qual", "string"))
    rows = lines.where("value not like '@%'").select(*[F.get(parts, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(names)], F.regexp_extract("value", r"\tNM:i:(\d+)", 1).alias("nm"))
    return rows.withColumn("nm", F.when(F.col("nm") != "", F.col("nm").cast("int"))), head


PSL_COLUMNS = ("matches mismatches rep_matches n_count q_num_insert q_base_insert t_num_insert t_base_insert strand q_name q_size q_start q_end t_name t_size t_start t_end block_count block_sizes q_starts t_starts").split()


def psl(spark: SparkSession, path: str, with_seq: bool = False) -> DataFrame:
    """SRC7: PSL rows with array columns."""
    text = {"strand", "q_name", "t_name", "block_sizes", "q_starts", "t_starts"}
    names = [*PSL_COLUMNS, *(["seq"] if with_seq else [])]
    rows = tsv(spark, path, ", ".join(f"{c} {'string' if c in text or c == 'seq' else 'int'}" for c in names))
    lists = {c: F.split(F.rtrim(F.col(c), F.lit(",")), ",").cast("array<int>") for c in ("block_sizes", "q_starts", "t_starts")}
    return rows.withColumns(lists)


def bowtie_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: read_id, frag, mate, strand, transcript, gene, pos, seq, n_mism."""
    rows = tsv(spark, path, "read_id string, strand string, ref string, pos int, seq string, qual string, reserved string, mism string")
    mate = F.regexp_extract("read_id", r"/([12])$", 1).cast("int")
    return rows.select("read_id", F.regexp_replace("read_id", "/[12]$", "").alias("frag"), mate.alias("mate"), "strand", F.split_part("ref", F.lit(";"), F.lit(1)).alias("transcript"), F.split_part("ref", F.lit(";"), F.lit(2)).alias("gene"), "pos", "seq", mismatches(F.coalesce("mism", F.lit(""))).alias("n_mism"))


def gtf(spark: SparkSession, path: str, feature: list[str] | None = None) -> DataFrame:
    """SRC9: features with their attributes as a map; swapped ends are put right."""
    rows = tsv(spark, path, "chrom string, source string, feature string, a int, b int, score string, strand string, frame string, attributes string", comment="#")
    if feature:
        rows = rows.where(F.col("feature").isin(feature))
    return rows.select("chrom", "source", "feature", F.least("a", "b").alias("start"), F.greatest("a", "b").alias("end"), "score", "strand", "frame", gtf_attributes("attributes").alias("attributes"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    """SRC10."""
    return tsv(spark, path, "chrom string, start bigint, end bigint")


EXONS = "peptide string, gene string, transcript string, exon string, exon_start int, exon_end int, rank int, gene_start int, gene_end int, transcript_start int, transcript_end int, strand int, chrom string"


def exons(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: the 13-column exon dump; for genes, symbols and other two-column dumps see ``pairs_table``."""
    return tsv(spark, path, EXONS)


def pairs_table(spark: SparkSession, path: str, left: str, right: str) -> DataFrame:
    """SRC12, SRC13: distinct rows of a two-column dump whose second column isn't empty."""
    return tsv(spark, path, f"{left} string, {right} string").where(F.col(right) != "").distinct()


def dump_schema(ddl: str, table: str) -> T.StructType:
    """SRC16: a table's columns from a dump's CREATE TABLE text, all as strings."""
    body = ddl.split(f"CREATE TABLE `{table}`", 1)[1].split("(", 1)[1]
    names = [line.strip().split("`")[1] for line in body.splitlines() if line.strip().startswith("`")]
    end = next((i for i, line in enumerate(body.splitlines()) if line.strip().startswith(")")), None)
    if end is not None:
        names = [line.strip().split("`")[1] for line in body.splitlines()[:end] if line.strip().startswith("`")]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def fusion_pairs(spark: SparkSession, path: str, column: int, header: bool = True, csv: bool = False, several: str | None = None) -> DataFrame:
    """SRC18: symbol_1, symbol_2 out of a column of names such as A--B, A::B or A->B; of a comma-separated file with quotes if
    ``csv``, and of each part of the column between ``several`` (a pattern) if given."""
    from helixloom.functions.seq import pair_symbols

    rows = spark.read.option("header", header).option("escape", '"').csv(path) if csv else tsv(spark, path, header=header)
    name = F.col(rows.columns[column])
    rows = rows.select((F.explode(F.split(name, several)) if several else name).alias("n"))
    names = pair_symbols("n")
    return rows.select(names.alias("p")).where("size(p) = 2 and p[0] <> '' and p[1] <> '' and p[0] <> p[1]").select(F.least(F.col("p")[0], F.col("p")[1]).alias("symbol_1"), F.greatest(F.col("p")[0], F.col("p")[1]).alias("symbol_2")).distinct()


def counted_pairs(spark: SparkSession, path: str, name_column: int, count_column: int, least: int = 5) -> DataFrame:
    """SRC18: as ``fusion_pairs`` for lists with counts and alternatives between bars; pairs below ``least`` go."""
    from helixloom.functions.seq import pair_symbols

    rows = tsv(spark, path, header=True)
    kept = rows.where(F.col(rows.columns[count_column]).cast("int") >= least).select(F.explode(F.split(F.col(rows.columns[name_column]), r"\|")).alias("n"))
    p = kept.select(pair_symbols("n").alias("p")).where("size(p) = 2 and p[0] <> p[1]")
    return p.select(F.least(F.col("p")[0], F.col("p")[1]).alias("symbol_1"), F.greatest(F.col("p")[0], F.col("p")[1]).alias("symbol_2")).distinct()


def _sheet_rows(body: bytes, sheet: int) -> list[tuple[int, list[str]]]:
    """Rows of a sheet of a workbook (a zip of XML files) as texts, with their numbers."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(body)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in x.iter(f"{main}t")) for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{main}si")]
        root = ElementTree.fromstring(book.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for k, row in enumerate(root.iter(f"{main}row"), 1):
        cells = []
        for cell in row.iter(f"{main}c"):
            name = "".join(c for c in cell.get("r") or "" if c.isalpha())
            at = 0
            for c in name:
                at = 26 * at + ord(c) - 64
            cells += [""] * ((at or len(cells) + 1) - 1 - len(cells))
            value = cell.find(f"{main}v")
            if cell.get("t") == "s":
                cells.append(shared[int(value.text)])
            elif cell.get("t") == "inlineStr":
                cells.append("".join(t.text or "" for t in cell.iter(f"{main}t")))
            else:
                cells.append("" if value is None else value.text or "")
        out.append((int(row.get("r") or k), cells))
    return out


def spreadsheet(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """SRC17: file, row (from 1), cells (texts) of a sheet of .xlsx workbooks; each workbook is one task's."""

    def run(batches):
        for batch in batches:
            for file, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = _sheet_rows(body, sheet)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), pa.array([n for n, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.string()))], names=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, row int, cells array<string>")


def translocation_pairs(rows: DataFrame, column: str) -> DataFrame:
    """SRC18: symbol_1, symbol_2 out of names such as A{T1.1}:r.1_142_B{T2.3}:r.444_3097. Of a name with two different parts
    their symbols make a pair, of one with more all parts of different transcripts do; a symbol makes none with itself."""
    parts = F.filter(F.split(F.upper(F.col(column)), ":"), lambda x: x.endswith("}"))
    bare = F.transform(parts, lambda x: F.split(F.substring(x, F.lit(1), F.length(x) - 1), r"\{"))
    told = F.array_distinct(F.transform(bare, lambda x: F.struct(F.element_at(F.split(F.element_at(x, 1), "_"), -1).alias("s"), F.element_at(x, -1).alias("t"))))
    named = rows.select(told.alias("p")).where("size(p) > 1")
    pairs = named.select("p", F.posexplode("p").alias("i", "a")).select("a", F.explode(F.slice("p", F.col("i") + 2, F.size("p"))).alias("b"), F.size("p").alias("n"))
    pairs = pairs.where("(n = 2 or a.t <> b.t) and a.s <> b.s")
    return pairs.select(F.least("a.s", "b.s").alias("symbol_1"), F.greatest("a.s", "b.s").alias("symbol_2")).distinct()


#: Names of receptor loci that get @, first parts of symbols with a dash, and corrected symbols (fixed values).
LOCI = ("IGH", "IGL", "IGK", "TRA", "TRB")
DASHED = ("HLA", "NKX2")
CORRECTED = {"SEC16A1": "SEC16A", "NKX2": "NKX2-1"}


def alteration_pairs(rows: DataFrame, column: str) -> DataFrame:
    """SRC18: symbol_1, symbol_2 out of alterations such as A-B Fusion. A symbol may have a dash itself if it begins with a part
    of DASHED; names of three parts without one are left out."""
    p = F.split(F.translate(F.regexp_replace(F.upper(F.col(column)), " FUSION.*$", ""), "?", "-"), "-")
    at = lambda i: F.trim(F.get(p, F.lit(i)))
    joined = lambda i, j: F.concat_ws("-", at(i), at(j))
    two = F.size(p) == 2
    first, second = F.get(p, F.lit(0)).isin(*DASHED), F.get(p, F.lit(1)).isin(*DASHED)
    a = F.when(two, at(0)).when(first, joined(0, 1)).when(second, joined(1, 2))
    b = F.when(two, at(1)).when(first, at(2)).when(second, at(0))

    def corrected(x):
        out = F.when(x.isin(*LOCI), F.concat(x, F.lit("@")))
        for wrong, right in CORRECTED.items():
            out = out.when(x == wrong, right)
        return out.otherwise(x)

    named = rows.where(F.col(column).endswith("usion")).where(F.size(p).isin(2, 3)).select(corrected(a).alias("a"), corrected(b).alias("b")).where("a is not null")
    return named.select(F.least("a", "b").alias("symbol_1"), F.greatest("a", "b").alias("symbol_2")).distinct()


def duplicate_groups(groups_table: DataFrame) -> DataFrame:
    """SRC18: all pairs inside the groups of duplicated genes (group, gene)."""
    a, b = groups_table.select("group", F.col("gene").alias("g_lo")), groups_table.select("group", F.col("gene").alias("g_hi"))
    return a.join(b, "group").where("g_lo < g_hi").select("g_lo", "g_hi").distinct()


def literal_pairs(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """SRC20: a curated list of symbol pairs."""
    return spark.createDataFrame(rows, "symbol_1 string, symbol_2 string")


def literal_sequences(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """SRC21: id, seq; the first id of equal sequences stays."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, id string, seq string")
    w = Window.partitionBy("seq").orderBy("ord")
    return df.withColumn("k", F.row_number().over(w)).where("k = 1").select("id", "seq")


def configuration(text: str) -> dict[str, dict[str, str]]:
    """SRC22: sections of an INI text, with ~ and environment variables expanded."""
    import configparser
    import os

    parser = configparser.ConfigParser(interpolation=None)
    parser.optionxform = str
    parser.read_string(text)
    return {s: {k: os.path.expandvars(os.path.expanduser(v.split("#")[0].strip())) for k, v in parser[s].items()} for s in parser.sections()}
