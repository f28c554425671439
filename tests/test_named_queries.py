"""Every named query against its SQL twin, and the driver contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from brookmill.plans import load_all, rollups
from brookmill.plans.registry import expand_round_to
from tests.compare import connect, difference
from tests.conftest import MIDDLE, SMALL

ALL = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql])
def test_equals_sql(spark, con, name):
    bad = difference(spark, con, ALL[name], SMALL)
    if bad == "no rows on either side":  # too few rows there: the next size has some
        bad = difference(spark, connect(MIDDLE), ALL[name], MIDDLE)
    assert bad is None, bad


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if not q.sql])
def test_runs_without_sql(spark, name):
    assert ALL[name].run(spark, SMALL).count() > 0


def test_contract(spark):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries)
    assert entry_module.entry(spark).count() > 0


def test_fraud_has_positives(middle):
    assert ALL["q_udf_fraud"].build(middle).filter("fraud_status = 'potential_fraud'").count() > 1000


def test_round_to_expansion():
    assert "round_to" not in expand_round_to("round_to(a + round_to(f(b, 1), 0), 3)")


def test_round_to_agrees_with_its_sql_form(spark, con):
    from brookmill.functions.types import round_to

    values = [0.0, 2.5, -2.5, -1.25, 1.25, 0.49, -0.4, 9.9e17, -9.9e17, 1e300, float("inf"), float("-inf"), float("nan"), None]
    want = [0.0, 3.0, -3.0, -1.0, 1.0, 0.0, 0.0, 9.9e17, -9.9e17, 1e300, float("inf"), float("-inf"), "nan", None]
    named = lambda rows: ["nan" if v is not None and v != v else v for v in rows]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v double").orderBy("i")
    assert named(r[0] for r in frame.select(round_to("v")).collect()) == want
    con.execute("CREATE OR REPLACE TEMP TABLE rounding (i INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO rounding VALUES (?, ?)", list(enumerate(values)))
    sql = expand_round_to("SELECT round_to(v, 0) FROM rounding ORDER BY i")
    assert named(r[0] for r in con.execute(sql).fetchall()) == want


def test_every_inventory_id_is_covered():
    from tests.inventory import ROOT, covered, inventory, table

    ids = inventory()
    assert len(ids) == 211
    assert set(ids) == set(covered())
    assert (ROOT / "COVERAGE.md").read_text() == table()


def test_entry_works_without_what_the_training_queries_need():
    """A missing tokenizer package leaves out those queries and nothing else."""
    import subprocess
    import sys

    from tests.inventory import ROOT

    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    done = subprocess.run([sys.executable, "-W", "always", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(ALL)), "False"] and "left out" in done.stderr


def test_topic_files_follow_the_rows(spark, monkeypatch):
    """A task writes about ``TOPIC_FILE_ROWS`` rows of the topic, and the stream still takes it in three batches."""
    paths, new_path = {}, rollups.new_path
    monkeypatch.setattr(rollups, "new_path", lambda s, name: paths.setdefault(name, new_path(s, name)))
    monkeypatch.setattr(rollups, "TOPIC_FILE_ROWS", 500)
    assert difference(spark, connect(SMALL), ALL["rollup_populate_then_stream"], SMALL) is None
    topic = spark.read.parquet(paths["sales-topic"])
    sizes = [r["count"] for r in topic.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 1_000 and sum(sizes) == topic.count()
    batches = {r["batch_id"] for r in spark.read.parquet(f"{paths['sales-rollup']}/batches").select("batch_id").distinct().collect()}
    assert batches <= {"populate", "stream-0", "stream-1", "stream-2"}
