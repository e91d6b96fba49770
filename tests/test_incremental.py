"""Customer state moved on by new files equals a full refresh, whatever is folded or interrupted in between."""

import pytest
from pyspark.sql import functions as F
from retail_helpers import rows

from keepwell.operators import dedup
from keepwell.plans import customer360
from keepwell.sources.files import SharedFiles
from keepwell.streaming import ingest
from keepwell.streaming.incremental import CustomerState
from keepwell.streaming.refresh import stream_to_silver


class Crash(Exception):
    pass


@pytest.fixture
def arrivals(spark, env, tmp_path):
    """Lands a third of orders and sales and brings them to silver; returns the silver tables."""
    frames = {"orders": env.inputs.orders(), "pos": env.inputs.pos()}
    landing = {name: str(tmp_path / "landing" / name) for name in frames}

    def arrive(part):
        for name, df in frames.items():
            ingest.write_landing(df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == part), landing[name], 2)
        return {name: tables.silver for name, tables in stream_to_silver(spark, landing, str(tmp_path / "tables")).items()}

    return arrive


def full(env, silver):
    products = dedup.first_products(env.inputs.products())
    tables = {name: sink.read() for name, sink in silver.items()}
    return customer360.transaction_rollup_p(tables["orders"], tables["pos"], products, env.as_of)


def test_state_equals_a_full_refresh_after_every_arrival(spark, env, arrivals, tmp_path):
    state = CustomerState(spark, str(tmp_path / "state"))
    products = dedup.first_products(env.inputs.products())
    taken = []
    for part in range(3):
        silver = arrivals(part)
        state.advance(silver)
        taken.append(state.parts["days"].totals()["rows"])
        expected = full(env, silver)
        assert rows(state.rollup(products, env.as_of).select(expected.columns)) == rows(expected)
        if part == 1:
            state.compact()
            assert rows(state.rollup(products, env.as_of).select(expected.columns)) == rows(expected)
    # every run read the rows that had arrived since the last one, and no others
    sizes = [sum(sink.read().count() for sink in silver.values())]
    assert taken[-1] == sizes[0] and taken[0] < taken[1] < taken[2]
    state.advance(silver)
    assert state.parts["days"].totals()["rows"] == taken[-1]


def test_a_crash_takes_no_batch_twice(spark, env, arrivals, tmp_path, monkeypatch):
    silver = arrivals(0)
    state = CustomerState(spark, str(tmp_path / "state"))
    note = SharedFiles.write_new
    calls = []

    def crash(self, path, text):
        if "/state/" in path and "_figures" in path:
            calls.append(path)
            if len(calls) == 2:
                raise Crash
        return note(self, path, text)

    with monkeypatch.context() as patched, pytest.raises(Exception, match="Crash"):
        patched.setattr(SharedFiles, "write_new", crash)
        state.advance(silver)
    state.advance(silver)
    expected = full(env, silver)
    products = dedup.first_products(env.inputs.products())
    assert rows(state.rollup(products, env.as_of).select(expected.columns)) == rows(expected)


def test_folding_leaves_one_row_per_key(spark, env, arrivals, tmp_path):
    state = CustomerState(spark, str(tmp_path / "state"))
    for part in range(2):
        state.advance(arrivals(part))
        state.compact()
    folded, batches = state._folded("days")
    assert folded.count() == folded.select("customer_id", "day").distinct().count()
    assert batches == set(state.parts["days"].batches())
    assert rows(state.read("days")) == rows(folded)
    files = SharedFiles(spark)
    assert len(files.names(f"{state.base}/days/_folded")) == 1
