"""Every query with SQL equals that SQL on the smallest tables, whatever the partitioning."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if hasattr(v, "asDict"):
        return str(v.asDict(recursive=True))
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (int, bool)) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = con.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(got.columns)
    key = lambda r: [(x is not None, str(x)) for x in r]
    a = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    b = sorted((tuple(plain(r[got.columns.index(c)]) for c in cols) for r in got.fetchall()), key=key)
    assert a == b


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_groups_keep_all_members(spark, tmp_path):
    names = [f"n{i:03}" for i in range(120)]
    spark.createDataFrame([(1, 0, names[:70]), (1, 1, names[60:]), (2, 0, ["x"])], "id_groupe_total int, lot int, noms array<string>").write.parquet(f"{tmp_path}/groupes_finals.parquet")
    got = sorted((r.seq, r.nom) for r in entry.queries()["group_members"](spark, str(tmp_path)).where("id_groupe_total = 1").collect())
    assert got == list(enumerate(names, 1))


def test_groups_keep_all_texts(spark, tmp_path):
    spark.createDataFrame([(f"{i:03}", 1, f"t{i}") for i in range(45)], "id string, id_groupe_total int, provenance string").write.parquet(f"{tmp_path}/prenoms_grouped.parquet")
    assert [r.texte for r in entry.queries()["group_texts"](spark, str(tmp_path)).collect()] == [" --- ".join(f"t{i}" for i in range(45))]


def test_outliers_come_from_groups_of_2_to_30(spark, tmp_path):
    near, far = [1.0, 0.0], [-1.0, 0.1]
    groups = {1: [near] * 5 + [far], 2: [near] * 31 + [far], 3: [far]}
    rows = [(f"{g}-{i:02}", g, v) for g, vs in groups.items() for i, v in enumerate(vs)]
    spark.createDataFrame([(i, g) for i, g, _ in rows], "id string, id_groupe_total int").write.parquet(f"{tmp_path}/prenoms_grouped.parquet")
    spark.createDataFrame([(at, i, v) for at, (i, _, v) in enumerate(rows)], "pos bigint, id string, embedding array<float>").write.parquet(f"{tmp_path}/prenoms_vecteurs.parquet")
    assert [(r.g, r.pos) for r in entry.queries()["outliers"](spark, str(tmp_path)).collect()] == [(1, 5)]
