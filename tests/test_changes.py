"""Changes by key, versions, statistics and streams."""

import pytest
from pyspark.sql import functions as F

from fedspark.errors import FederationError, NoKey, ReadOnly, RowCountMismatch, SerializationFailure
from fedspark.functions import concat, date_part, initcap, substr, trunc
from fedspark.operators import VersionedTable, analyze, delete, insert, truncate, update
from fedspark.streaming import stream_into, upsert

SCHEMA = "k1 int, k2 string, v decimal(9,2)"


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", None)], "k1 int, k2 string, v int").select("k1", "k2", F.col("v").cast("decimal(9,2)").alias("v"))


def rows(df):
    return sorted(((r[0], r[1], None if r[2] is None else float(r[2])) for r in df.collect()), key=str)


def test_insert(spark, table):
    change = insert(table, spark.createDataFrame([(3, 5)], "k1 int, v int"))
    assert rows(change.returning) == [(3, None, 5.0)] and change.table.count() == 4
    with pytest.raises(FederationError, match="other"):
        insert(table, spark.createDataFrame([(3,)], "other int"))


def test_update_composite_key(spark, table):
    change = update(table, spark.createDataFrame([(1, "b", 9)], "k1 int, k2 string, v int"), ["k1", "k2"])
    assert rows(change.table) == [(1, "a", 1.0), (1, "b", 9.0), (2, "a", None)]
    assert rows(change.returning) == [(1, "b", 9.0)]
    assert change.statement == 'UPDATE t SET "v" = ? WHERE "k1" = ? AND "k2" = ?'
    to_null = update(table, spark.createDataFrame([(1, "b", None)], "k1 int, k2 string, v int"), ["k1", "k2"])
    assert rows(to_null.table)[1] == (1, "b", None)


def test_update_of_a_key(spark, table):
    moved = update(table, spark.createDataFrame([(1, "b", "z")], "k1 int, k2 string, n string"), ["k1", "k2"], new_keys={"k2": "n"})
    assert rows(moved.table) == [(1, "a", 1.0), (1, "z", 2.0), (2, "a", None)]


def test_one_row_each(spark, table):
    for bad in ([(9, "q", 1)], [(1, "a", 1), (1, "a", 2)], [(None, "a", 1)]):
        with pytest.raises(RowCountMismatch):
            update(table, spark.createDataFrame(bad, "k1 int, k2 string, v int"), ["k1", "k2"])
    with pytest.raises(RowCountMismatch):
        delete(table, spark.createDataFrame([(1,)], "k1 int"), ["k1"])
    with pytest.raises(NoKey):
        delete(table, table)
    with pytest.raises(FederationError, match="no columns"):
        update(table, spark.createDataFrame([(1, "a")], "k1 int, k2 string"), ["k1", "k2"])


def test_delete_and_truncate(spark, table):
    change = delete(table, spark.createDataFrame([(1, "a")], "k1 int, k2 string"), ["k1", "k2"])
    assert rows(change.table) == [(1, "b", 2.0), (2, "a", None)] and rows(change.returning) == [(1, "a", 1.0)]
    assert truncate(table).table.count() == 0 and "RESTART" in truncate(table, True).statement


def test_versions(spark, table, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", ["k1", "k2"])
    assert t.version == 0 and t.commit(table) == 1
    t.savepoint("one")
    t.update(spark.createDataFrame([(1, "a", 7)], "k1 int, k2 string, v int"))
    t.savepoint("two")
    t.delete(spark.createDataFrame([(1, "a")], "k1 int, k2 string"))
    assert t.read().count() == 2 and t.version == 3
    t.rollback("one")
    assert rows(t.read()) == rows(table) and [s for s, _ in t.savepoints] == ["one"]
    with pytest.raises(FederationError, match="two"):
        t.rollback("two")
    t.truncate()
    assert t.read().count() == 0 and t.read(1).count() == 3
    with pytest.raises(SerializationFailure):
        t.commit(table, on=1)
    with pytest.raises(ReadOnly):
        VersionedTable(spark, f"file://{tmp_path}/t", readonly=True).truncate()


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, n int").write.parquet(source)
    t = VersionedTable(spark, f"file://{tmp_path}/t", ["id"])
    stream = spark.readStream.schema("id int, v string, n int").parquet(source)

    def run():
        q = stream_into(stream, t, str(tmp_path / "state"), order="n").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    spark.createDataFrame([(2, "c", 2), (3, "d", 1), (2, "old", 0)], "id int, v string, n int").write.mode("append").parquet(source)
    run()
    assert sorted(tuple(r)[:2] for r in t.read().collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert upsert(t.read(), t.read().limit(0), ["id"]).count() == 3


def test_analyze(spark):
    df = spark.createDataFrame([(k, None if k % 4 == 0 else "x" * (k % 3 + 1)) for k in range(1000)], "a int, b string")
    found = {r["column_name"]: r for r in analyze(df).collect()}
    assert found["a"]["total_rows"] == 1000 and found["a"]["min_value"] == "0" and found["a"]["max_value"] == "999"
    assert found["b"]["null_fraction"] == 0.25 and found["b"]["n_distinct"] == 3
    assert abs(found["a"]["n_distinct"] - 1000) < 100
    sampled = analyze(df, sample_percent=50).where("column_name = 'a'").first()
    assert 800 < sampled["total_rows"] < 1200
    assert analyze(df.limit(0)).first()["total_rows"] == 0
    with pytest.raises(FederationError):
        analyze(df, sample_percent=0)


def test_text_functions(spark):
    one = spark.createDataFrame([("foo-bar", None)], "s string, n string")
    assert one.select(initcap("s"), concat("s", "n"), substr("s", -1, 3), substr("s", 0, 3)).first()[:] == ("Foo-Bar", "foo-bar", "f", "fo")
    with pytest.raises(Exception, match="negative substring length"):
        one.select(substr("s", 1, -1)).collect()


def test_number_and_date_functions(spark):
    one = spark.sql("SELECT 2.3D AS d, -2.57D AS e, CAST(NULL AS DOUBLE) AS n, TIMESTAMP_NTZ '2024-02-29 10:11:12.5' AS t")
    assert one.select(trunc("d", 1), trunc("e", 1), trunc("n"), date_part("second", "t")).first()[:] == (2.3, -2.5, None, 12.5)
    with pytest.raises(ValueError):
        date_part("century", "t")


def test_the_loser_of_two_writers_leaves_the_winners_rows(spark, tmp_path):
    import pytest

    from fedspark.errors import SerializationFailure
    from fedspark.operators.versions import VersionedTable

    rows = lambda *x: spark.createDataFrame([(v,) for v in x], "k int")
    a, b = (VersionedTable(spark, str(tmp_path / "t"), ["k"]) for _ in range(2))
    a.commit(rows(1))
    base = b.version
    a.commit(rows(1, 2), on=base)
    with pytest.raises(SerializationFailure):
        b.commit(rows(7, 8), on=base)
    assert sorted(r["k"] for r in a.read().collect()) == [1, 2] and a.version == 2

    class Slow(VersionedTable):
        """Finds no marker, so that its rows are written before another's commit is seen."""

        def _at(self, name):
            fs, at = super()._at(name)
            if name.startswith("commits/") and not self.looked:
                self.looked = True
                a.commit(rows(3), on=2)
                fs.delete(at, False)
                late = fs.create(at, False)
                late.write(b"theirs")
                late.close()
                return type("Blind", (), {"exists": lambda _, x: False, "create": lambda _, *x: fs.create(*x), "delete": lambda _, *x: fs.delete(*x)})(), at
            return fs, at

    c = Slow(spark, str(tmp_path / "t"), ["k"])
    c.looked = False
    with pytest.raises(SerializationFailure):
        c.commit(rows(9), on=2)
    folders = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]
    assert sorted(f[:9] for f in folders) == ["v00000001", "v00000002", "v00000003"]  # the loser's own is gone
