"""Bounded training samples, chosen by hash order of ids, with whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most characters of a sample (64 million): what reaches the driver is bounded whatever the texts' lengths.
SAMPLE_CHARS = 64 << 20


def _named(rows: DataFrame, id_col: str, keep: Column, columns: list[str]) -> DataFrame:
    """``i`` and ``c0, c1, ...``: only the columns that are needed, under names of our own; rows without an id go."""
    return rows.where(keep & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("i"), *[F.col(c).alias(f"c{n}") for n, c in enumerate(columns)])


def _marks(named: DataFrame) -> tuple[Column, Column]:
    """A digest of a row's columns, and their length."""
    columns = [F.col(c) for c in named.columns[1:]]
    return F.xxhash64(*columns), sum((F.coalesce(F.length(c.cast("string")), F.lit(0)).cast("bigint") for c in columns), F.lit(0).cast("bigint"))


def _fetched(named: DataFrame, sized: list, most_chars: int) -> list[tuple]:
    """Rows (i, c0, ...) of the picked (i, r.h, r.b) in their order, as long as their lengths fit ``most_chars``."""
    chosen, left = [], most_chars
    for row in sized:
        if row.r.b <= left:
            chosen.append((row.i, row.r.h))
            left -= row.r.b
    if not chosen:
        return []
    mark, _ = _marks(named)
    picked = named.sparkSession.createDataFrame(chosen, "i bigint, h bigint")
    found = named.withColumn("h", mark).join(F.broadcast(picked), ["i", "h"]).dropDuplicates(["i"]).select(*named.columns).collect()
    return sorted((tuple(r) for r in found), key=lambda r: r[0])


def sample_rows(rows: DataFrame, id_col: str, keep: Column, columns: list[str], most: int, seed: int, most_chars: int = SAMPLE_CHARS) -> list[tuple]:
    """Rows (id, *columns) of up to ``most`` ids among the rows with ``keep``, the first ids in hash order; of the rows of one
    id the one of least digest. The sample holds at most ``most_chars`` characters; a row that doesn't fit is passed over.

    Hash order is cut to the share of it that holds about four times the sample's ids, so only those are ordered.
    """
    named = _named(rows, id_col, keep, columns)
    n = named.agg(F.approx_count_distinct("i")).first()[0]
    if not n:
        return []
    order, (mark, size) = F.xxhash64(F.lit(seed), F.col("i")), _marks(named)
    cut = min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, 4 * most / n)))
    near = named.where(order <= F.lit(cut)).groupBy("i").agg(F.min(F.struct(mark.alias("h"), size.alias("b"))).alias("r"))
    return _fetched(named, near.orderBy(order, "i").limit(most).collect(), most_chars)


def rows_of(rows: DataFrame, id_col: str, ids: list[int], columns: list[str], keep: Column, most_chars: int = SAMPLE_CHARS) -> list[tuple]:
    """Rows (id, *columns) of the given ids, one row an id, under the bounds of ``sample_rows``; ids in the given order."""
    if not ids:
        return []
    named = _named(rows, id_col, keep, columns)
    picked = named.sparkSession.createDataFrame([(i, n) for n, i in enumerate(dict.fromkeys(ids))], "i bigint, o int")
    mark, size = _marks(named)
    sized = named.withColumn("r", F.struct(mark.alias("h"), size.alias("b"))).join(F.broadcast(picked), "i")
    return _fetched(named, sized.groupBy("i").agg(F.min("r").alias("r"), F.min("o").alias("o")).orderBy("o").collect(), most_chars)
