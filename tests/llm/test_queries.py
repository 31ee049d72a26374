"""Every corpus query over whole tables, and those that SQL can express against it."""

from pathlib import Path

import duckdb
import pytest

from helixloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toArrow()
    table = "embeddings" if "embedding" in name else "documents"
    ids = duckdb.sql(f"SELECT count(*) FROM '{sf}/{table}.parquet'").fetchall()[0][0]
    assert len(set(got.column(0).to_pylist())) == ids and (got.num_rows == ids or "packing" in name)
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for f in Path(sf).glob("*.parquet"):
            con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
        want = con.sql(queries.ORACLE_SQL[name]).to_arrow_table()
        con.register("got", got), con.register("want", want)
        cols = ", ".join(got.column_names)
        for a, b in (("got", "want"), ("want", "got")):
            assert con.sql(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []
