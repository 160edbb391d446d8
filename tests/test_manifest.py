import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import manifest as m

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def values(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_record_delta_masks_what_processed_units_carry(spark, monkeypatch):
    landed = spark.createDataFrame([(1, None, 10), (1, 5, 10), (2, 5, 10), (2, 6, 11), (3, None, 11), (4, 7, None), (4, 7, None)], "seq bigint, a bigint, b bigint")
    done = spark.createDataFrame([(None, 10), (5, 11), (6, 11), (6, 11)], "a bigint, b bigint")
    unit = ["a", "b"]

    def delta(landed, done):
        return m.record_delta(landed, m.diff(m.manifest(landed, unit), done, unit), unit, ["seq"], [F.count(F.lit(1)).alias("n")])

    for _ in range(2):
        assert sorted(map(tuple, delta(landed, done).collect())) == [(3, 1), (4, 2)]
        assert delta(landed.limit(0), done).count() == 0 and delta(landed, done.limit(0)).count() == 4
        monkeypatch.setattr(m, "small_enough", lambda *_: False)


def test_units_are_processed_once_whatever_fails(spark, tmp_path, monkeypatch):
    """A run that dies between its data and its commit leaves nothing behind; the next one takes all."""
    out, unit = m.VersionedTable(spark, str(tmp_path / "o")), ["w"]
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("n", T.LongType())])
    landed = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (None, "c")], "seq bigint, w string")
    run = lambda rows, done="x string": m.process_units(rows, spark.createDataFrame([(done,)], "w string"), unit, ["seq"], [F.count(F.lit(1)).alias("n")], out, "feed")
    seen = lambda: sorted((r.seq is not None, r.seq, r.n) for r in out.read(schema).collect())
    real = m.VersionedTable._publish
    monkeypatch.setattr(m.VersionedTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        run(landed, "a")
    assert out.version() == -1 and seen() == []
    monkeypatch.setattr(m.VersionedTable, "_publish", real)
    assert run(landed, "a") == 0 and out.processed("feed") == 3
    assert seen() == [(False, None, 1), (True, 3, 1)]
    assert run(landed, "a") == 0
    more = landed.unionByName(spark.createDataFrame([(3, "d"), (4, "d"), (4, "d")], "seq bigint, w string"))
    assert run(more, "a") == 1 and out.processed("feed") == 4
    assert seen() == [(False, None, 1), (True, 3, 1), (True, 4, 2)]


def test_a_commit_file_is_whole_or_absent(spark, tmp_path):
    t = m.VersionedTable(spark, str(tmp_path / "t"))
    t.commit(-1, added=rows(spark, (1, "a")))
    (tmp_path / "t/commits/.left.json").write_text("")
    assert t.version() == 0 and t.commit(0, added=rows(spark, (2, "b"))) == 1
    assert values(t.read(SCHEMA)) == [(1, "a"), (2, "b")]
    assert sorted(p.name for p in (tmp_path / "t/commits").glob("[0-9]*.json")) == ["0.json", "1.json"]


def test_diff(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "u bigint"), spark.createDataFrame([(2,), (3,), (None,)], "u bigint")
    assert {(r.u, r.change) for r in m.diff(a, b, ["u"]).collect()} == {(1, "added"), (2, "kept"), (None, "kept"), (3, "removed")}


def test_versions_deltas_and_deletion_vectors(spark, tmp_path):
    t = m.VersionedTable(spark, str(tmp_path / "t"))
    assert t.version() == -1 and values(t.read(SCHEMA)) == []
    t.commit(-1, added=rows(spark, (1, "a"), (2, "b"), (3, "c")).coalesce(1))
    file = t.files(0).first().file
    t.commit(0, added=rows(spark, (4, "d")), deleted=spark.createDataFrame([(file, 1)], "file string, row_index bigint"))
    assert values(t.read(SCHEMA)) == [(1, "a"), (3, "c"), (4, "d")]
    assert values(t.read(SCHEMA, 0)) == [(1, "a"), (2, "b"), (3, "c")]
    got = t.changes(SCHEMA, 0, 1)
    assert sorted((r.id, r._change) for r in got.collect()) == [(2, "delete"), (4, "insert")]
    t.commit(1, removed=[file])
    assert sorted((r.id, r._change) for r in t.changes(SCHEMA, 1, 2).collect()) == [(1, "delete"), (3, "delete")]
    assert sorted((r.id, r._change) for r in t.changes(SCHEMA, -1, 2).collect()) == [(4, "insert")]


def test_second_writer_of_a_version_fails(spark, tmp_path):
    t = m.VersionedTable(spark, str(tmp_path / "t"))
    t.commit(-1, added=rows(spark, (1, "a")))
    with pytest.raises(Exception, match="(?i)exist"):
        t.commit(-1, added=rows(spark, (2, "b")))
    assert values(t.read(SCHEMA)) == [(1, "a")]


def test_process_new_survives_failures_without_skipping_or_repeating(spark, tmp_path):
    source, target = m.VersionedTable(spark, str(tmp_path / "s")), m.VersionedTable(spark, str(tmp_path / "o"))
    keep = lambda df: df.filter("_change = 'insert'").select("id", "v")
    source.commit(-1, added=rows(spark, (1, "a"), (2, "b")))
    assert m.process_new(source, target, "s", SCHEMA, keep) == 0
    source.commit(0, added=rows(spark, (3, "c")))

    def crash(df):
        return keep(df).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        m.process_new(source, target, "s", SCHEMA, crash)
    assert target.processed("s") == 0
    assert m.process_new(source, target, "s", SCHEMA, keep) == 1
    assert m.process_new(source, target, "s", SCHEMA, keep) == 1
    assert values(target.read(SCHEMA)) == [(1, "a"), (2, "b"), (3, "c")] and target.processed("s") == 1
