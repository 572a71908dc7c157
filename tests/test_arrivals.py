import pytest

from build import spark_tables, written
from compare import spark_rows
from tidemark import columns as c
from tidemark.operators import incremental as inc
from tidemark.plans import loads, marts, stored
from tidemark.session import new_scratch_database
from tidemark.sources import contracts
from tidemark.streaming.arrivals import load_on_arrival


def test_each_call_loads_what_arrived(spark, tmp_path):
    source, target = f"{tmp_path}/source", f"{new_scratch_database(spark)}.target"
    contract = contracts.ACCOUNT_CLOSED

    def arrive(*rows):
        spark_tables(spark, written(closed=rows)).closed.write.mode("append").parquet(source)
        query = load_on_arrival(spark, source, contract, target, contract, c.CLOSED,
                                f"{tmp_path}/checkpoint")
        assert query.awaitTermination(120)
        stored = loads.read_base(spark, target, contract)
        return sorted((r.account_id_hashed, r.closed_ts.day) for r in stored.collect())

    assert arrive(("a", "1 10:00"), ("a", "9 10:00")) == [("a", 1), ("a", 9)]
    # The row of the 2nd is older than the look-back and is missed, as in any later run.
    assert arrive(("late", "2 10:00"), ("b", "8 10:00"), ("b", "10 10:00")) == [
        ("a", 1), ("a", 9), ("b", 8), ("b", 10)]
    assert arrive() == [("a", 1), ("a", 9), ("b", 8), ("b", 10)]


@pytest.fixture()
def stream(spark, tmp_path):
    """Adds closures to a source and loads what arrived, with a table for late rows."""
    database, contract = new_scratch_database(spark), contracts.ACCOUNT_CLOSED

    def arrive(*rows, buckets=None):
        if rows:
            spark_tables(spark, written(closed=rows)).closed.coalesce(1).write.mode(
                "append").parquet(f"{tmp_path}/source")
        query = load_on_arrival(spark, f"{tmp_path}/source", contract, f"{database}.closed",
                                contract, c.CLOSED, f"{tmp_path}/checkpoint",
                                late_table=f"{database}.late", buckets=buckets)
        assert query.awaitTermination(120)
        return loads.read_base(spark, f"{database}.closed", contract)

    yield arrive, f"{database}.late"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def days(df):
    return sorted((r.account_id_hashed, r.closed_ts.day) for r in df.collect())


@pytest.mark.parametrize("buckets", [None, 3])
def test_late_rows_are_loaded_and_told(spark, stream, buckets):
    arrive, late = stream
    first = [("a", "1 10:00"), ("a", "2 10:00"), ("b", "20 10:00")]
    arrive(*first, buckets=buckets)
    assert not stored.exists(spark, late)
    # On a day the target has, on one it lacks, at the bound, and in the look-back.
    more = [("x", "2 11:00"), ("y", "5 10:00"), ("edge", "17 10:00"), ("new", "21 10:00"),
            ("early", "17 09:59")]
    assert days(arrive(*more)) == sorted((a, int(t.split()[0])) for a, t in first + more)
    assert days(spark.table(late)) == [("early", 17), ("x", 2), ("y", 5)]
    last = [("z", "1 11:00")]
    assert len(days(arrive(*last))) == 9
    assert days(spark.table(late)) == [("early", 17), ("x", 2), ("y", 5), ("z", 1)]
    assert len({r[0] for r in spark.table(late).select("arrival").distinct().collect()}) == 2
    assert len(days(arrive())) == 9


def test_a_rebuild_takes_late_accounts_as_touched(spark, stream):
    arrive, late = stream
    created = [(a, "u", "uk_retail", "1") for a in ("a", "b", "x", "new")]

    def tables(closed):
        t = spark_tables(spark, written(created=created))
        return type(t)(t.created, closed, t.reopened, t.transactions)

    before = tables(arrive(("a", "1 10:00"), ("b", "20 10:00")))
    mart = late.replace(".late", ".mart")
    loads.rebuild_touched(spark, before, inc.touched_accounts(before.created), mart, buckets=4)
    now = tables(arrive(("x", "2 11:00"), ("new", "21 10:00")))
    recent = inc.look_back(now.closed, now.closed, c.CLOSED)
    got = loads.rebuild_touched(
        spark, now, inc.touched_accounts(recent, spark.table(late)), mart)
    assert spark_rows(got) == spark_rows(marts.unified_accounts(now))
