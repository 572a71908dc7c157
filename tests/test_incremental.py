import datetime
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from build import drawn, spark_tables, ts, written
from compare import spark_rows
from survey_tables import survey_tables
from tidemark.session import new_scratch_database
from tidemark import columns as c
from tidemark.operators import incremental as inc
from tidemark.plans import kept_rate, loads, marts, stored
from tidemark.sources import contracts

CLOSED = (contracts.ACCOUNT_CLOSED, c.CLOSED)


def closures(spark, *rows):
    return spark_tables(spark, written(closed=rows)).closed


@pytest.fixture()
def table(spark):
    """The name of a table that is not there yet, in a database of its own."""
    database = new_scratch_database(spark)
    yield f"{database}.t"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def load(spark, source, table, **options):
    loads.load_base(spark, source, table, *CLOSED, **options)
    return loads.read_base(spark, table, contracts.ACCOUNT_CLOSED)


def days(df):
    return sorted((r.account_id_hashed, r.closed_ts.day) for r in df.collect())


def test_first_run_takes_everything(spark, table):
    source = closures(spark, ("a", "1 10:00"), ("b", None))
    assert spark_rows(load(spark, source, table)) == spark_rows(source)


def test_look_back_is_three_days_inclusive_and_misses_older_rows(spark, table):
    load(spark, closures(spark, ("a", "1 10:00"), ("a", "10 10:00")), table)
    source = closures(spark, ("a", "1 10:00"), ("a", "10 10:00"), ("late", "5 10:00"),
                      ("edge", "7 10:00"), ("early", "7 09:59"), ("new", "12 10:00"))
    got = load(spark, source, table)
    assert days(got) == [("a", 1), ("a", 10), ("edge", 7), ("new", 12)]


def test_rows_of_a_reloaded_key_are_replaced(spark, table):
    load(spark, closures(spark, ("gone", "9 10:00"), ("kept", "9 11:00"), ("a", "10 10:00")), table)
    got = load(spark, closures(spark, ("there", "9 10:00"), ("a", "10 10:00")), table)
    assert days(got) == [("a", 10), ("kept", 9), ("there", 9)]


def test_running_twice_changes_nothing(spark, table, small):
    t = survey_tables(spark, small)
    once = spark_rows(load(spark, t.closed, table))
    assert once == spark_rows(t.closed)
    assert spark_rows(load(spark, t.closed, table)) == once


def files(spark, table, **partition):
    """The files of the table's partitions with the given values, with their times."""
    (place,) = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").collect()
    root = pathlib.Path(place.data_type.removeprefix("file:"))
    wanted = {f"{k}={v}" for k, v in partition.items()}
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")
            if wanted <= set(p.relative_to(root).parts)}


def test_only_days_in_the_look_back_are_rewritten(spark, table):
    load(spark, closures(spark, ("a", "1 10:00"), ("n", None), ("a", "10 10:00")), table)
    kept = {"event_date": "2024-01-01"}, {"event_date": stored.NULL_PARTITION}
    before = [files(spark, table, **p) for p in kept]
    old = files(spark, table, event_date="2024-01-10")
    got = load(spark, closures(spark, ("a", "1 10:00"), ("a", "10 10:00"), ("b", "10 11:00")),
               table)
    assert all(before) and before == [files(spark, table, **p) for p in kept]
    assert not old.keys() & files(spark, table, event_date="2024-01-10").keys()
    assert got.count() == 4


def test_empty_target_loads_nothing(spark, table):
    empty = closures(spark)
    source = closures(spark, ("a", "1 10:00"))
    assert inc.look_back(source, empty, c.CLOSED).count() == 0
    load(spark, empty, table)
    assert load(spark, source, table).count() == 0


def test_changed_schema_is_refused(spark, table):
    load(spark, closures(spark, ("a", "1 10:00")), table)
    with pytest.raises(contracts.SchemaMismatch):
        loads.load_base(spark, closures(spark).drop(c.CLOSED), table, *CLOSED)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (more string)")
    with pytest.raises(contracts.SchemaMismatch, match="more"):
        loads.load_base(spark, closures(spark), table, *CLOSED)


def test_an_interrupted_first_run_leaves_no_table(spark, table):
    """A first run that fails while it writes can be run again."""
    source = closures(spark, ("a", "1 10:00"), ("b", "2 10:00"))
    broken = source.withColumn(c.CLOSED, F.when(
        F.col(c.ACCOUNT) == "b", F.raise_error(F.lit("lost"))).otherwise(F.col(c.CLOSED)))
    with pytest.raises(Exception, match="lost"):
        loads.load_base(spark, broken, table, *CLOSED)
    assert not stored.exists(spark, table)
    assert days(load(spark, source, table)) == [("a", 1), ("b", 2)]


def test_a_later_run_that_fails_leaves_the_table_as_it_was(spark, table):
    load(spark, closures(spark, ("a", "1 10:00"), ("a", "9 10:00")), table)
    source = closures(spark, ("a", "9 10:00"), ("b", "9 11:00"))
    broken = source.withColumn(c.ACCOUNT, F.when(
        F.col(c.ACCOUNT) == "b", F.raise_error(F.lit("lost"))).otherwise(F.col(c.ACCOUNT)))
    with pytest.raises(Exception, match="lost"):
        loads.load_base(spark, broken, table, *CLOSED)
    assert days(loads.read_base(spark, table, contracts.ACCOUNT_CLOSED)) == [("a", 1), ("a", 9)]
    assert days(load(spark, source, table)) == [("a", 1), ("a", 9), ("b", 9)]


def test_the_overwrite_mode_of_the_session_stays(spark, table):
    load(spark, closures(spark, ("a", "9 10:00")), table)
    before = spark.conf.get(stored.OVERWRITE_MODE)
    load(spark, closures(spark, ("a", "9 10:00")), table)
    assert spark.conf.get(stored.OVERWRITE_MODE) == before


def test_days_cut_by_account_hold_the_same_rows(spark, table):
    """A row that replaces one of another account empties the bucket that one lay in."""
    first = closures(spark, ("a", "1 10:00"), *[(f"g{i}", f"9 10:{i:02}") for i in range(12)],
                     (None, "9 09:00"))
    load(spark, first, table, buckets=5)
    assert stored.buckets_of(spark, table) == 5
    old = files(spark, table, event_date="2024-01-01")
    now = closures(spark, ("late", "1 10:00"), *[(f"h{i}", f"9 10:{i:02}") for i in range(12)],
                   ("x", "10 10:00"))
    got = load(spark, now, table)
    assert days(got.filter(F.col(c.ACCOUNT).isNotNull())) == sorted(
        [("a", 1), *[(f"h{i}", 9) for i in range(12)], ("x", 10)])
    assert old == files(spark, table, event_date="2024-01-01")
    named = {(p["event_date"], p[stored.BUCKET]) for p in stored.partitions(spark, table)}
    rows = spark.table(table).select(stored.EVENT_DATE, stored.BUCKET).distinct().collect()
    assert named == {(str(r[0]), str(r[1])) for r in rows}


def test_a_whole_table_is_replaced(spark, table):
    assert not stored.exists(spark, table)
    stored.replace(spark.range(3), table)
    stored.replace(spark.range(5), table)
    assert spark.table(table).count() == 5 and stored.buckets_of(spark, table) is None


def test_the_batch_is_read_once(spark, table, tmp_path):
    """What is deleted is what is inserted, even if the source has changed in between."""
    source = f"{tmp_path}/source"
    closures(spark, ("a", "9 10:00"), ("b", "9 11:00")).write.parquet(source)
    read = spark.read.schema(contracts.ACCOUNT_CLOSED).parquet(source)
    load(spark, read, table)
    assert days(load(spark, read, table)) == [("a", 9), ("b", 9)]


@pytest.fixture(scope="module")
def runs(spark, small):
    return survey_tables(spark, small, before="2024-01-20 00:00:00"), survey_tables(spark, small)


def test_mart_keeps_stale_open_rows(spark, table, runs):
    first, second = (marts.unified_accounts(t) for t in runs)
    before = loads.load_mart(spark, first, table)
    assert before.count() == 336
    assert inc.changed_rows(second, before).count() == 341
    merged = loads.load_mart(spark, second, table)
    assert merged.count() == 592
    rows = ["account_id_hashed", "closed_ts", "account_status"]
    extra = merged.select(rows).exceptAll(second.select(rows)).collect()
    assert {r.account_status for r in extra if r.closed_ts is None} == {"open"}
    assert len(merged.select(rows[:2]).exceptAll(second.select(rows[:2])).collect()) == 8


def test_rebuilding_touched_accounts_equals_a_full_rebuild(spark, table, runs):
    seen, now = runs
    loads.rebuild_touched(spark, seen, inc.touched_accounts(seen.created), table)
    new = [inc.look_back(b, a, ts_) for a, b, ts_ in (
        (seen.created, now.created, c.CREATED), (seen.closed, now.closed, c.CLOSED),
        (seen.reopened, now.reopened, c.REOPENED), (seen.transactions, now.transactions, c.TX_DATE))]
    got = loads.rebuild_touched(spark, now, inc.touched_accounts(*new), table)
    assert got.count() == 584
    assert spark_rows(got) == spark_rows(marts.unified_accounts(now))


@pytest.mark.parametrize("others", [0, 1_000_000])
def test_rebuild_is_the_same_however_many_accounts_are_touched(spark, table, others):
    created = [("a", "u", "uk_retail", "1"), ("b", "u", "uk_retail", "1"), (None, "v", None, "1")]
    old = spark_tables(spark, written(created=created, transactions=[("a", 1, "2"), ("b", 1, "2")]))
    loads.rebuild_touched(spark, old, inc.touched_accounts(old.created), table)
    # b has a late row, but is not touched; a and the rows without id are.
    now = spark_tables(spark, written(
        created=[*created, (None, "w", "uk_retail", "9")],
        transactions=[("a", 1, "2"), ("b", 1, "2"), ("b", 5, "1"), ("a", 2, "9")]))
    touched = spark_tables(spark, written(closed=[("a", "9"), (None, "9")])).closed.select(c.ACCOUNT)
    many = spark.range(others).select(F.concat(F.lit("other-"), "id").alias(c.ACCOUNT))
    got = loads.rebuild_touched(spark, now, inc.touched_accounts(touched, many), table)
    rows = sorted((r.account_id_hashed or "", r.user_id_hashed, r.total_transactions)
                  for r in got.collect())
    assert rows == [("", "v", 0), ("", "w", 0), ("a", "u", 3), ("b", "u", 1)]


def test_untouched_buckets_keep_their_files(spark, table):
    t = spark_tables(spark, written(created=[(f"a{i}", "u", "uk_retail", "1") for i in range(40)]))
    loads.rebuild_touched(spark, t, inc.touched_accounts(t.created), table, buckets=7)
    before = files(spark, table)
    touched = t.created.filter(F.col(c.ACCOUNT) == "a7").select(c.ACCOUNT)
    got = loads.rebuild_touched(spark, t, touched, table)
    after = files(spark, table)
    assert got.count() == 40 and stored.buckets_of(spark, table) == 7
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert len(changed) == 1 and len(stored.partitions(spark, table)) == 7


def test_a_rebuild_from_bases_reads_the_touched_buckets_only(spark, table):
    database = table.removesuffix(".t")
    first = spark_tables(spark, written(
        created=[(f"a{i}", f"u{i % 3}", "uk_retail", "1") for i in range(40)] + [(None, "v", None, "1")],
        closed=[(f"a{i}", f"{2 + i % 5} 10:00") for i in range(40)],
        transactions=[(f"a{i}", i, "3") for i in range(40)]))
    assert loads.load_bases(spark, first, database, buckets=8) is None
    mart = f"{database}.mart"
    got = loads.rebuild_from_bases(spark, database, None, mart)
    assert spark_rows(got) == spark_rows(marts.unified_accounts(first))
    before = files(spark, mart)
    # a3 is closed again and reopened, one transaction of a5 replaces that of all others that day.
    now = spark_tables(spark, written(
        created=[(f"a{i}", f"u{i % 3}", "uk_retail", "1") for i in range(40)] + [(None, "v", None, "1")],
        closed=[(f"a{i}", f"{2 + i % 5} 10:00") for i in range(40)] + [("a3", "7 10:00")],
        reopened=[("a3", "8 10:00")], transactions=[(f"a{i}", i, "3") for i in range(40)]))
    touched = loads.load_bases(spark, now, database)
    only = touched.filter(F.col(c.ACCOUNT) == "a3")
    loads.rebuild_from_bases(spark, database, only, mart)
    changed = {p.parent.name for p in before.keys() ^ files(spark, mart).keys()}
    assert len(changed) == 1
    bucket = int(changed.pop().split("=")[1])
    plan = loads.read_bases(spark, database, [bucket]).closed._jdf.queryExecution() \
        .executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^]]*bucket#\d+ = {bucket}\)", plan)
    assert spark_rows(loads.rebuild_from_bases(spark, database, touched, mart)) == spark_rows(
        marts.unified_accounts(loads.read_bases(spark, database)))
    with pytest.raises(ValueError, match="buckets"):
        loads.load_mart(spark, marts.unified_accounts(now), f"{database}.other", buckets=3)
        loads.rebuild_from_bases(spark, database, touched, f"{database}.other")


def test_accounts_of_deleted_rows_are_touched(spark, table):
    database = table.removesuffix(".t")
    old = spark_tables(spark, written(created=[("a", "u", None, "9"), ("b", "u", None, "9 01:00")],
                                      closed=[("a", "9 10:00")], transactions=[("b", 1, "9")]))
    loads.load_bases(spark, old, database, buckets=2)
    now = spark_tables(spark, written(created=[("a", "u", None, "9"), ("b", "u", None, "9 01:00")],
                                      closed=[("b", "9 10:00")], transactions=[("b", 1, "9")]))
    mart = loads.rebuild_from_bases(spark, database, None, f"{database}.mart")
    assert {r.account_id_hashed for r in mart.filter("account_status = 'closed'").collect()} == {"a"}
    touched = loads.load_bases(spark, now, database)
    assert {r[0] for r in touched.collect()} == {"a", "b"}
    mart = loads.rebuild_from_bases(spark, database, touched, f"{database}.mart")
    assert {r.account_id_hashed for r in mart.filter("account_status = 'closed'").collect()} == {"b"}


def test_an_account_that_vanished_leaves_its_bucket(spark, table):
    t = spark_tables(spark, written(created=[("a", "u", "uk_retail", "1"), ("b", "u", "uk_retail", "1")]))
    loads.rebuild_touched(spark, t, inc.touched_accounts(t.created), table)
    less = spark_tables(spark, written(created=[("b", "u", "uk_retail", "1")]))
    got = loads.rebuild_touched(spark, less, inc.touched_accounts(t.created), table)
    assert [r.account_id_hashed for r in got.collect()] == ["b"]


@pytest.mark.parametrize("seed, shared, hot", [(2, True, 0.0), (3, True, 0.4)])
def test_a_kept_rate_equals_a_full_rebuild(spark, table, seed, shared, hot):
    database = table.removesuffix(".t")
    rows = drawn(seed, accounts=60, hot_share=hot, shared_ids=shared)
    first = {n: [r for r in values if (r[-1] or ts("1")) < ts("25")] for n, values in rows.items()}
    for run in (first, rows):
        touched = loads.load_bases(spark, spark_tables(spark, run), database, buckets=3)
        got = kept_rate.load_rate(spark, database, touched, buckets=5)
        want = marts.active_user_rate(loads.read_bases(spark, database))
        assert spark_rows(got) == spark_rows(want)
        # The kept days hold no more than what a first run would write.
        whole = kept_rate._summed(kept_rate._per_day(kept_rate._steps(
            loads.read_bases(spark, database), 7)))
        assert spark_rows(spark.table(f"{database}.{kept_rate.DAYS}")) == spark_rows(whole)


def test_a_kept_rate_follows_an_account_to_another_user(spark, table):
    database = table.removesuffix(".t")
    created = [(f"a{i}", f"u{i}", "uk_retail", "9 08:00") for i in range(12)]
    old = written(created=created + [("moved", "from", None, "9 09:00")],
                  transactions=[("moved", 1, "9"), ("a1", 1, "9")])
    now = written(created=created + [("moved", "to", None, "9 09:00")],
                  transactions=[("moved", 1, "9"), ("a1", 1, "9"), ("a1", 1, "10")])
    loads.load_bases(spark, spark_tables(spark, old), database, buckets=3)
    kept_rate.load_rate(spark, database, None, buckets=50)
    steps = f"{database}.{kept_rate.STEPS}"
    assert stored.cut_of(spark, steps) == (50, c.USER)
    touched = loads.load_bases(spark, spark_tables(spark, now), database)
    assert {"from", "to"} <= {r[1] for r in touched.collect()}
    before = files(spark, steps)
    only = touched.filter((F.col(c.ACCOUNT) == "moved"))
    got = kept_rate.load_rate(spark, database, only)
    users = {r[0] for r in spark.table(steps).select(c.USER).distinct().collect()}
    assert "to" in users and "from" not in users
    changed = {p.parent.name for p in before.keys() ^ files(spark, steps).keys()}
    assert len(changed) <= 2
    assert {r.total_open_users for r in got.collect()} == {13}


def test_contents_that_differ_are_found(spark, table):
    """Totals alone, copies, NULL keys and values that move between columns."""
    created = [(f"a{i}", f"u{i}", "uk_retail", "1") for i in range(30)] + [
        (None, "v", None, "1"), (None, "w", "x", "1")]
    old = spark_tables(spark, written(created=created, closed=[("a1", "2"), ("a2", "2")],
                                      transactions=[("a3", 1, "2"), ("a4", 1, "2")]))
    now = spark_tables(spark, written(
        created=created[:-2] + [(None, None, "v", "1"), (None, "w", "x", "1"),
                                ("new", "u", None, "1")],
        closed=[("a1", "2"), ("a2", "3")], transactions=[("a3", 5, "2"), ("a4", 1, "2")]))
    mart, changes = loads.load_by_content(spark, marts.unified_accounts(old), table, buckets=40)
    assert changes is None and spark_rows(mart) == spark_rows(marts.unified_accounts(old))
    before = files(spark, table)
    mart, changes = loads.load_by_content(spark, marts.unified_accounts(now), table)
    assert {(r.account_id_hashed, r.closed_ts and r.closed_ts.day, r.change)
            for r in changes.collect()} == {
        ("a3", None, "changed"), ("new", None, "new"), (None, None, "changed"),
        ("a2", 2, "vanished"), ("a2", 3, "new")}
    assert spark_rows(mart) == spark_rows(marts.unified_accounts(now))
    changed = {p.parent.name for p in before.keys() ^ files(spark, table).keys()}
    assert "bucket=-1" in changed and len(changed) <= 4
    _, changes = loads.load_by_content(spark, marts.unified_accounts(now), table)
    assert changes.count() == 0


def test_repeated_rows_count(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "x", None), (3, "y", "y")],
                               "k int, a string, b string")
    now, key = inc.with_row_hash(df), ["k"]
    once = now.dropDuplicates()
    assert [tuple(r) for r in inc.content_changes(now, once, key).collect()] == [(1, "new")]
    moved = inc.with_row_hash(df.select("k", F.col("b").alias("a"), F.col("a").alias("b")))
    assert sorted(tuple(r) for r in inc.content_changes(now, moved, key).collect()) == [
        (1, "changed"), (2, "changed")]
    assert {len(r.row_hash) for r in now.collect()} == {32}


def test_newest_open_account_is_inserted_again_unless_null_safe(spark, table):
    t = spark_tables(spark, written(created=[("a", "u", "uk_retail", "1 08:00")],
                                    closed=[("x", "1 09:00")], reopened=[("x", "1 09:00")]))
    unified = marts.unified_accounts(t)
    loads.load_mart(spark, unified, f"{table}_plain")
    assert loads.load_mart(spark, unified, f"{table}_plain").count() == 2
    loads.load_mart(spark, unified, f"{table}_safe", null_safe=True)
    assert loads.load_mart(spark, unified, f"{table}_safe", null_safe=True).count() == 1


def test_look_back_filter_reaches_the_scan(spark, tmp_path):
    closures(spark, ("a", "1 10:00"), ("a", "9 10:00")).write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    plan = inc.look_back(source, source, c.CLOSED)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(closed_ts,2024-01-06T10:00)" in plan


def test_build_marts_reads_back_what_the_operators_give(spark, table, smallest):
    t, database = survey_tables(spark, smallest), table.removesuffix(".t")
    built = marts.build_marts(spark, t, database)
    assert spark_rows(built["unified_accounts"]) == spark_rows(marts.unified_accounts(t))
    assert spark_rows(built["active_user_rate"]) == spark_rows(marts.active_user_rate(t))
    again = marts.build_marts(spark, t, database)
    assert again["unified_accounts"].count() == 53
    comment = built["unified_accounts"].schema[c.FLAG].metadata["comment"]
    assert "never reopened" in comment


def test_base_views_and_comments_in_the_catalog(spark, smallest):
    t = survey_tables(spark, smallest)
    marts.create_base_views(t)
    assert spark.table("base_account_created").count() == 14
    t.created.write.mode("overwrite").saveAsTable("account_created_saved")
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE account_created_saved").collect()}
    assert described[c.ACCOUNT_TYPE] == "product the account belongs to"
    spark.sql("DROP TABLE account_created_saved")


def test_freshness_start_is_a_plain_datetime(spark):
    assert inc.look_back_start(closures(spark, ("a", "9 10:00")), c.CLOSED) == datetime.datetime(
        2024, 1, 6, 10)
