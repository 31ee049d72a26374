"""Writers: reports, sequences, per-candidate folders, VCF, BED."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tsv(df: DataFrame, path: str, header: bool = True, single: bool = False) -> None:
    """SNK1, SNK2: tab-separated text; an empty result still has its header if it is written as one file."""
    out = df.coalesce(1) if single else df
    out.write.option("sep", "\t").option("quote", "").option("header", header).option("emptyValue", "").csv(path)


def fasta_lines(df: DataFrame, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), F.col(seq_col)).alias("value"))


def fasta(df: DataFrame, path: str, most_per_file: int = 0) -> None:
    """SNK3, SNK10: FASTA text, cut into files of at most ``most_per_file`` records if given."""
    writer = fasta_lines(df).write
    if most_per_file:
        writer = writer.option("maxRecordsPerFile", most_per_file)
    writer.text(path)


def fasta_parts(df: DataFrame, path: str, most_bases: int, id_col: str = "id", seq_col: str = "seq") -> None:
    """SNK10: FASTA text in folders part=... whose sequences have at most ``most_bases`` bases in all (a longer sequence is alone).
    Each task deals its own rows to parts as they come, so nothing is shuffled."""

    def deal(batches):
        task, part, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            parts = []
            for n in pc.utf8_length(batch.column(1)).to_pylist():
                if held and held + n > most_bases:
                    part, held = part + 1, 0
                held += n
                parts.append(f"{task}-{part}")
            lines = pc.binary_join_element_wise(">", batch.column(0), "\n", batch.column(1), "")
            yield pa.RecordBatch.from_arrays([lines, pa.array(parts)], names=["value", "part"])

    rows = df.select(F.col(id_col).cast("string"), F.coalesce(F.col(seq_col), F.lit("")))
    rows.mapInArrow(deal, "value string, part string").write.partitionBy("part").text(path)


def fastq(df: DataFrame, path: str) -> None:
    """SNK3."""
    df.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.text(path)


def by_candidate(df: DataFrame, path: str, column: str = "fusion", listing: str | None = None) -> None:
    """SNK4, R10: one folder per candidate; the candidates' names as a text file ``listing`` if given. A hot candidate's rows are
    written by several tasks."""
    df.write.partitionBy(column).parquet(path)
    if listing:
        df.select(F.col(column).cast("string")).distinct().orderBy(column).coalesce(1).write.text(listing)


def candidate_name(prefix: str = "candidate") -> Column:
    """SNK4: the name of a candidate's files out of symbol_i and g_i: prefix.s1--s2__g1--g2."""
    return F.concat(F.lit(prefix + "."), "symbol_1", F.lit("--"), "symbol_2", F.lit("__"), "g_1", F.lit("--"), "g_2")


def evidence_reads(evidence: DataFrame, reads: DataFrame, path: str) -> None:
    """SNK5: a folder per fusion with its reads as FASTQ, each name followed by the read's role. ``evidence``: fusion, read_id,
    role; ``reads``: read_id, seq, qual."""
    rows = evidence.join(reads, "read_id")
    lines = F.concat(F.lit("@"), "read_id", "role", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    rows.select("fusion", lines.alias("value")).write.partitionBy("fusion").text(path)


#: Keys of the INFO column (fixed values): number, type, what it tells.
VCF_INFO = {
    "SVTYPE": ("1", "String", "Type of structural variant"),
    "MATEID": ("1", "String", "ID of the mate breakend"),
    "EVENT": ("1", "String", "ID of the fusion that the breakend belongs to"),
    "SP": ("1", "Integer", "Read pairs that span the fusion"),
    "SR": ("1", "Integer", "Reads over the fusion junction"),
    "FUSION": ("1", "String", "Symbols of the fused genes"),
    "END": ("1", "String", "Side of the fusion: 5 or 3"),
    "GENE5": ("1", "String", "Symbol of the gene on the 5 prime side"),
    "GENE3": ("1", "String", "Symbol of the gene on the 3 prime side"),
    "GENS5": ("1", "String", "Gene id on the 5 prime side"),
    "GENS3": ("1", "String", "Gene id on the 3 prime side"),
    "EFFECT": ("1", "String", "Predicted effect"),
    "DESC": ("1", "String", "Labels of the fusion"),
    "PUBLISHED": ("0", "Flag", "Known from the literature or from public databases"),
    "STRAND": ("1", "String", "Strand of the gene at this breakend"),
}


def vcf_header(about: dict[str, str] | None = None) -> list[str]:
    """Header lines; ``about`` gives further ones, such as fileDate, source, reference, in its order."""
    return ["##fileformat=VCFv4.3", *[f"##{k}={v}" for k, v in (about or {}).items()], *[f'##INFO=<ID={k},Number={n},Type={t},Description="{d}">' for k, (n, t, d) in VCF_INFO.items()], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]


def vcf_lines(rows: DataFrame, about: dict[str, str] | None = None) -> DataFrame:
    """SNK6: header and rows in order, ready for one text file."""
    head = rows.sparkSession.createDataFrame(list(enumerate(vcf_header(about))), "end int, value string").select(F.lit(-1).cast("bigint").alias("ord"), "end", "value")
    body = rows.select("ord", "end", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", "ref", "alt", "qual", "filter", "info").alias("value"))
    return head.union(body).orderBy("ord", "end").select("value")


def bed(df: DataFrame, path: str) -> None:
    """SNK8."""
    tsv(df.select("chrom", "start", "end").orderBy("chrom", "start", "end"), path, header=False)


def divergent_blocks(pairs: DataFrame) -> DataFrame:
    """SNK9: adds block, numbers such that no gene occurs twice in a block: a pair goes to the first block without its genes.

    The rule is sequential over all pairs, which are candidates of one run (thousands): one group holds them by design.
    """
    import pandas as pd

    columns = [*pairs.columns, "block"]

    def colour(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["g_1", "g_2"])
        used: list[set] = []
        out = []
        for a, b in zip(rows["g_1"], rows["g_2"], strict=True):
            at = next((i for i, s in enumerate(used) if a not in s and b not in s), len(used))
            if at == len(used):
                used.append(set())
            used[at] |= {a, b}
            out.append(at)
        return rows.assign(block=out)[columns]

    return pairs.groupBy().applyInPandas(colour, T.StructType([*pairs.schema.fields, T.StructField("block", T.IntegerType())]))
