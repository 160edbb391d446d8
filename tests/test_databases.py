"""Databases are read by processes that haven't made them: driver and executors apart, as in a cluster."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

import oracle
from sluice.plans import catalogue, landing

REPO = Path(__file__).resolve().parent.parent
NAMES = ["jdbc_captured_bound", "jdbc_full_table", "jdbc_range_partitions", "jdbc_select_query", "jdbc_custom_sql", "jdbc_predicates", "jdbc_seed_then_windows", "jdbc_template"]
RUN = """
import json, sys
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.config(map=json.loads(sys.argv[1])).getOrCreate()
got = {}
for name in sys.argv[4:]:
    try:
        df = __spark_entry__.queries()[name](spark, sys.argv[2])
        got[name] = [df.columns, [list(r) for r in df.collect()]]
    except Exception as e:
        got[name] = str(e)[-2000:]
json.dump(got, open(sys.argv[3], "w"))
spark.stop()
"""


@pytest.fixture(scope="module")
def apart(tmp_path_factory):
    """What the queries give where executors are processes of their own."""
    at = tmp_path_factory.mktemp("cluster")
    (at / "home" / "work").mkdir(parents=True)  # the executors' logs go to work in Spark's home
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (at / "home" / p.name).symlink_to(p)
    conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "768m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": f"file://{at}/shared", "spark.sql.warehouse.dir": f"{at}/warehouse"}
    env = os.environ | {"SPARK_HOME": str(at / "home"), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(at / "local"), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable, "PYTHONPATH": str(REPO)}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    with (at / "log").open("w") as log:
        subprocess.run([sys.executable, "-c", RUN, json.dumps(conf), str(oracle.DATA), str(at / "got.json"), *NAMES], cwd=at, env=env, stdout=log, stderr=log, timeout=300, check=True)
    return json.loads((at / "got.json").read_text())


@pytest.mark.skipif(not oracle.DATA.exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql_where_executors_are_processes(apart, name):
    assert isinstance(apart[name], list), apart[name]
    want = oracle.connect().execute(catalogue.SQL[name])
    assert oracle.rows(*apart[name]) == oracle.rows([d[0] for d in want.description], want.fetchall())


def test_a_database_holds_what_it_was_given(spark):
    given = [(1, None), (2, ""), (None, "a,b"), (4, 'q"x"q'), (5, "two\nlines\r\n"), (6, "  pad\t"), (7, " "), (8, '"'), (9, "\\"), (10, "\u00e9\U0001f600"), (None, None)]
    df, kinds = spark.createDataFrame(given, "k bigint, t string"), {"k": "BIGINT", "t": "VARCHAR(40)"}
    for rows in (df, df.limit(0)):
        url = landing.archived_database(spark, rows, "t", kinds)
        got = spark.read.jdbc(url, '"t"', properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, rows.collect())))


def test_files_are_packed_in_pieces(tmp_path):
    import zipfile

    files = {"a.dat": bytes(range(256)) * 5, "seg/b.dat": b"", "seg/c.dat": b"x" * 64}
    for name, data in files.items():
        p = tmp_path / "db" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    landing._pack(tmp_path / "db", tmp_path / "db.jar", piece=64)
    with zipfile.ZipFile(tmp_path / "db.jar") as z:
        assert z.testzip() is None and {i.filename: z.read(i) for i in z.infolist()} == {f"db/{n}": d for n, d in files.items()} and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def test_a_shared_folder_without_a_path_is_refused(spark):
    assert landing._local(spark, "file:/a %20b/c") == Path("/a %20b/c")
    with pytest.raises(RuntimeError, match="hdfs"):
        landing._local(spark, "hdfs://h/x")
