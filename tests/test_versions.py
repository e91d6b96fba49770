"""Versioned tables and the copies synced from them: readers, crashes, lost updates, retention."""

import threading

import pytest
from pyspark.sql import functions as F
from retail_helpers import rows

from keepwell.operators import sync as feeds
from keepwell.sources import tables
from keepwell.sources.files import SharedFiles
from keepwell.sources.served import ServedCopy, sync
from keepwell.sources.versions import ConcurrentUpdate, VersionLog

KEY = "customer_id"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="module")
def database(spark):
    tables.create_database(spark, "versioned")
    return "versioned"


def people(spark, n, **changed):
    """n customers with a score; changed: score by customer."""
    df = spark.range(n).select(F.col("id").alias(KEY), (F.col("id") % 7).alias("score"))
    for customer, score in changed.items():
        df = df.withColumn("score", F.when(F.col(KEY) == int(customer[1:]), score).otherwise(F.col("score")))
    return df


class Crash(Exception):
    pass


def test_a_log_takes_each_number_once(spark, base):
    log = VersionLog(spark, base)
    assert (log.latest(), log.commit({"n": "é"}, 0), log.entry(1)) == (0, 1, {"n": "é"})
    with pytest.raises(ConcurrentUpdate):
        log.commit({}, 0)
    assert not log.files.write_new(f"{base}/000000000001.json", "{}") and log.entry(1) == {"n": "é"}
    assert log.files.names(base) == ["000000000001.json"]  # no draft is left over
    done = []

    def write(n):
        try:
            done.append((log.commit({"writer": n}, 1), n))
        except ConcurrentUpdate:
            pass

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 1 and log.entry(2) == {"writer": done[0][1]}


def test_a_reader_finds_the_table_at_any_moment(spark, database, base):
    name = f"{database}.busy"
    tables.publish(people(spark, 10), name, base, bucket_key=KEY)
    seen, wrong, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as problem:  # whatever a reader gets to see is a fault
                wrong.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (20, 30, 40):
        tables.publish(people(spark, n), name, base, bucket_key=KEY, retain=10)
    stop.set()
    reader.join()
    assert not wrong and seen <= {10, 20, 30, 40}
    assert spark.table(name).count() == 40


def test_a_crash_before_the_switch_changes_nothing(spark, database, base, monkeypatch):
    name = f"{database}.crashed"
    tables.publish(people(spark, 10), name, base)

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patched, pytest.raises(Crash):
        patched.setattr(VersionLog, "commit", crash)
        tables.publish(people(spark, 99), name, base)
    assert spark.table(name).count() == 10
    # a process that is gone cannot tidy up: its folder is named by no version
    people(spark, 5).write.parquet(f"{base}/versioned/crashed/snapshot-orphan")
    assert tables.remove_orphans(spark, name, base) == ["snapshot-orphan"]
    assert tables.publish(people(spark, 12), name, base).count() == 12
    assert tables.history(spark, name, base).count() == 2


def test_a_crash_after_the_switch_is_made_up_for(spark, database, base, monkeypatch):
    name = f"{database}.late"
    tables.publish(people(spark, 10), name, base)

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patched, pytest.raises(Crash):
        patched.setattr(tables, "point", crash)
        tables.publish(people(spark, 20), name, base)
    assert spark.table(name).count() == 10  # the view is behind its log by one version
    assert tables.table_at(spark, name, base, 2).count() == 20
    tables.point(spark, name, base)
    assert spark.table(name).count() == 20


def test_a_lost_update_is_refused(spark, database, base):
    name = f"{database}.contended"
    first = tables.publish(people(spark, 10), name, base)
    started = tables.version_log(spark, name, base).latest()
    tables.publish(first.filter(f"{KEY} < 5"), name, base, after=started)
    with pytest.raises(ConcurrentUpdate):
        tables.publish(first.filter(f"{KEY} >= 5"), name, base, after=started)
    assert spark.table(name).count() == 5
    assert len([n for n in SharedFiles(spark).names(f"{base}/versioned/contended") if n.startswith("snapshot")]) == 2


def test_time_travel_feed_and_retention(spark, database, base):
    name = f"{database}.travelled"
    for n in (10, 12, 9):
        tables.publish(people(spark, n, c3=n), name, base, "note", KEY, retain=3)
    assert [tables.table_at(spark, name, base, v).count() for v in (1, 2, 3)] == [10, 12, 9]
    feed = tables.table_feed(spark, name, base, 1, 2, KEY)
    assert "Exchange" not in feed._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(feed, KEY, feeds.CHANGE)) == [(3, feeds.AFTER), (3, feeds.BEFORE), (10, feeds.INSERT), (11, feeds.INSERT)]
    # a session whose catalogue has never seen the version finds it by the log
    spark.sql(f"DROP TABLE {tables.version_log(spark, name, base).entry(1)['snapshot']}")
    assert tables.table_at(spark, name, base, 1).count() == 10
    tables.publish(people(spark, 4).withColumn("more", F.lit("x")), name, base, retain=2)
    assert tables.version_log(spark, name, base).versions() == [3, 4]
    assert len([n for n in SharedFiles(spark).names(f"{base}/versioned/travelled") if n.startswith("snapshot")]) == 2
    assert spark.table(name).columns == [KEY, "score", "more"]


# --- served copies --------------------------------------------------------------------
def source(spark, database, base, *versions):
    """A published table with these versions, and a copy that is synced after the first."""
    name = f"{database}.s{abs(hash(base)) % 10**9}"
    copy = ServedCopy(spark, f"{base}/copy", KEY, 16)
    for n, df in enumerate(versions):
        tables.publish(df, name, base, bucket_key=KEY)
        if n == 0:
            assert sync(spark, name, base, copy) == 1
    return name, copy


def test_a_sync_rewrites_only_buckets_that_changed(spark, database, base):
    name, copy = source(spark, database, base, people(spark, 200), people(spark, 201, c17=99))
    assert sync(spark, name, base, copy) == 2
    assert rows(copy.read()) == rows(spark.table(name)) and copy.applied == 2
    before, after = copy.log.entry(1)["folders"], copy.log.entry(2)["folders"]
    changed = {b for b in after if before.get(b) != after[b]}
    assert 1 <= len(changed) <= 2 < len(after)
    assert rows(copy.read(1)) == rows(people(spark, 200))
    # the next sync finds nothing to do and adds no version
    assert (sync(spark, name, base, copy), copy.log.latest()) == (2, 2)
    feed = copy.changes(1, 2)
    assert sorted(rows(feed, KEY, feeds.CHANGE)) == [(17, feeds.AFTER), (17, feeds.BEFORE), (200, feeds.INSERT)]
    read = {path.split("/data/")[1].split("/part")[0] for path in feed.inputFiles()}
    assert read <= {at.removeprefix("data/") for b in changed for at in (before.get(b, ""), after[b])}


def test_a_crash_in_a_sync_applies_the_same_feed_again(spark, database, base, monkeypatch):
    name, copy = source(spark, database, base, people(spark, 100), people(spark, 90, c1=50, c2=51))

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patched, pytest.raises(Crash):
        patched.setattr(VersionLog, "commit", crash)  # the rows are written, the version is not
        sync(spark, name, base, copy)
    assert copy.applied == 1 and rows(copy.read()) == rows(people(spark, 100))
    again = ServedCopy(spark, f"{base}/copy", KEY)
    assert again.buckets == 16
    assert sync(spark, name, base, again) == 2
    assert rows(again.read()) == rows(spark.table(name))


def test_two_syncs_at_once(spark, database, base):
    name, copy = source(spark, database, base, people(spark, 50), people(spark, 60))
    late = copy.log.latest()
    feed = tables.table_feed(spark, name, base, 1, 2, KEY)
    sync(spark, name, base, copy)
    with pytest.raises(ConcurrentUpdate):
        copy.log.commit(copy.log.entry(late), late)
    # the same feed once more gives the same rows
    copy.merge(feed, 2)
    assert rows(copy.read()) == rows(people(spark, 60))


def test_added_columns_deletes_and_retention(spark, database, base):
    wider = people(spark, 40).withColumn("note", F.when(F.col(KEY) == 3, "new"))
    name, copy = source(spark, database, base, people(spark, 50), wider)
    sync(spark, name, base, copy)
    assert rows(copy.read(), *wider.columns) == rows(wider)
    for n in (41, 42, 43):
        tables.publish(people(spark, n).withColumn("note", F.lit(None).cast("string")), name, base, bucket_key=KEY)
        sync(spark, name, base, copy)
    assert copy.log.versions() == [3, 4, 5] and copy.read().count() == 43
    named = {at for e in copy.log.entries().values() for at in e["folders"].values()}
    files = SharedFiles(spark)
    stored = {f"data/{run}/{b}" for run in files.names(f"{base}/copy/data") for b in files.names(f"{base}/copy/data/{run}")}
    assert {at for at in stored if "_bucket=" in at} == named


def test_a_copy_left_behind_is_written_anew(spark, database, base):
    """Its version of the source is no longer retained, so no feed leads on from it."""
    versions = [people(spark, n) for n in (10, 11, 12, 13, 14)]
    name, copy = source(spark, database, base, *versions)
    assert copy.applied not in tables.version_log(spark, name, base).versions()
    assert sync(spark, name, base, copy) == 5
    assert rows(copy.read()) == rows(versions[-1])


def test_a_copy_of_nothing(spark, database, base):
    name, copy = source(spark, database, base, people(spark, 0), people(spark, 3))
    assert copy.read().count() == 0
    assert sync(spark, name, base, copy) == 2 and copy.read().count() == 3
