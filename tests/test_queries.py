"""Every query against its SQL twin on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from corpusflow.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v != v:
            return None
        return round(float(v), 6) if isinstance(v, float) or hasattr(v, "as_tuple") else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else str(v)

    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(small_data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, small_data):
    got = QUERIES[name](spark, small_data).toPandas()
    if name in ORACLES:
        assert plain(got) == plain(duck.sql(ORACLES[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_passages_are_found_in_documents(spark, tmp_path):
    passage = "the quick brown fox jumps over the lazy dog while seven small birds sing in the old green tree by the river"
    other = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(1, f"{other} {passage} {other}"), (2, other), (3, None), (4, passage.replace("seven small", "eleven little").title())]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["aligned_documents"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 4} and all(r.item_id == 7 and r.n == r.aligned for r in got.values())
    assert got[1].worst_cer == 0 and 0 < got[4].worst_cer < 50
