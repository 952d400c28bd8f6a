"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
import os
import re

import duckdb
import pytest

from siltstone import queries as engine

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_matches_sql(spark, sql, name):
    got = engine.queries()[name](spark, DATA)
    want = sql.execute(engine.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(columns, want.fetchall())


def test_packing_of_every_day(spark, tmp_path):
    days = engine.queries()["q_lpt_packing_days"](spark, DATA).collect()
    assert len(days) > 1 and all(r.balanced for r in days)
    assert sum(r.units for r in days) == engine.adapter.objects(spark, DATA).count()
    spark.read.parquet(f"{DATA}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert engine.queries()["q_lpt_packing_days"](spark, str(tmp_path)).count() == 0
    assert engine.queries()["q_lpt_packing"](spark, str(tmp_path)).count() == 0


def test_delimiter_tokens_of_paths(spark):
    rows = engine.queries()["q_delimiter_tokens_paths"](spark, DATA).collect()
    assert sorted(r.path for r in rows) == sorted(r.path for r in engine.adapter.objects(spark, DATA).collect())
    hashes = engine.bloom.shape(1000, 0.01)[1]
    for r in rows:
        pieces = [x for x in re.split(r"([/:=@.\-$#%\\_])", r.path) if x]
        tokens = {"".join(pieces[i:k]) for i in range(len(pieces)) for k in range(i + 1, len(pieces) + 1)}
        assert set(r.tokens) == tokens and len(r.tokens) == len(tokens) and hashes <= r.n_bits <= len(tokens) * hashes


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
