import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]
import oracle  # noqa: E402

from test_history import brute  # noqa: E402

from sluice.functions.text import canonical_id  # noqa: E402
from sluice.llm import leakage, queries, survivor, tokens  # noqa: E402

pytestmark = pytest.mark.skipif(not oracle.DATA.exists(), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    oracle.compare(spark, oracle.connect(), queries.QUERIES[name], queries.SQL[name])


def table(spark, name):
    return spark.read.parquet(f"{oracle.DATA}/{name}.parquet")


def run(spark, name):
    return queries.QUERIES[name](spark, str(oracle.DATA))


def test_queries_without_sql_are_known():
    assert set(queries.QUERIES) - set(queries.SQL) == {"p3_currency", "p4_found", "p7_ids", "p8_clean", "p9_found", "p9_restored"}


def test_every_group_has_one_current_value_of_its_own(spark):
    rows = table(spark, "health_sherpa_member_curated")
    long = rows.select(canonical_id(F.col("subscriber_id")).alias("key"), F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.trim(F.col(f)).alias("v"), survivor.has_value(F.col(f)).alias("ok")) for f in queries.SURVIVOR_FIELDS])).alias("c"))
    own = {tuple(r) for r in long.filter("key IS NOT NULL AND c.ok").select("key", "c.f", "c.v").distinct().collect()}
    got = [(r.key, r.field_name, r.value) for r in run(spark, "p3_currency").collect()]
    assert set(got) <= own and len(got) == len({g[:2] for g in got}) == len({o[:2] for o in own})


def test_deliveries_equal_the_sequential_rule(spark):
    state = lambda c: F.upper(F.trim(c))
    bare = lambda x: re.sub(r"^[a-z][a-z0-9_-]*[:=]", "", re.sub(r"\s+", "", (x or "").lower())) or None
    stamp = lambda t: None if t is None else t.timestamp()
    audit = table(spark, "ingest_file_audit").filter(state(F.col("status")) == "VALIDATED").select("audit_id", "event_ts", "checksum", "file_path").collect()
    registry = table(spark, "ingest_file_registry").filter(state(F.col("status")) == "PROCESSED").select("checksum", "file_path").collect()
    samples = [tuple(r) for r in table(spark, "file_sample").select("file_path", "content").collect()]
    want = brute([(r[0], stamp(r[1]), bare(r[2]), r[3]) for r in audit], [(bare(r[0]), r[1]) for r in registry], samples)
    assert {tuple(r) for r in run(spark, "p4_found").collect()} == want and {k for _, k in want} == {"exact", "near"}


def test_token_ids_decode_to_the_texts(spark):
    import tiktoken

    with open(tokens.VOCABULARY, "rb") as f:
        public = tiktoken.Encoding("public", pat_str=tokens.PATTERN, mergeable_ranks=tokens.load_ranks(f.read()), special_tokens={})
    texts = {r.doc_id: r.text for r in table(spark, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in run(spark, "p7_ids").collect()}
    assert got.keys() == texts.keys() and all(ids == public.encode_ordinary(texts[d] or "") and public.decode(ids) == (texts[d] or "") for d, ids in got.items())


def test_clean_texts_are_the_documents_less_their_leaks(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in run(spark, "p8_clean").collect()}
    leaking = {r.doc_id for r in run(spark, "p8_found").collect()}
    assert got.keys() == texts.keys() and {d for d, r in got.items() if r.n_leaked_words} == leaking == {d for d, r in got.items() if r.text != texts[d]}
    assert all(len(leakage.words(texts[d])) - len(leakage.words(got[d].text)) == got[d].n_leaked_words for d in leaking)


def test_restored_texts_differ_where_records_are_found(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in run(spark, "p9_restored").collect()}
    found = {r.doc_id for r in run(spark, "p9_found").collect()}
    assert got.keys() == texts.keys() and {d for d, r in got.items() if r.n_restored + r.n_lost} == found and {d for d, r in got.items() if r.text != texts[d]} == {d for d, r in got.items() if r.n_restored}


def test_nothing_else_imports_the_package():
    root = Path(__file__).parents[2] / "sluice"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "sluice.llm" in p.read_text()]
