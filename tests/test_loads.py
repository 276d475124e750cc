import datetime
import random
import uuid
from collections import Counter

import micro
import pytest
from pyspark.sql import functions as F

from linetally.functions.blooms import possibly_among
from linetally.session import shared_folder
from linetally.sources import fixtures, loads, schemas, snapshots
from linetally.sources.loads import load_rows, read_rejects
from linetally.sources.schemas import EVENTS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def path(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def parents_of(spark):
    return fixtures.all_tables(spark, SF)


def stored(spark, path, table=EVENTS):
    return Counter(tuple(r) for r in snapshots.read_table(spark, path, table).select(table.schema.names).collect())


def rejected(spark, path, table=EVENTS):
    return Counter((*r[:-1], tuple(r[-1])) for r in read_rejects(spark, path, table).collect())


def test_the_same_batch_twice_gives_the_table_once(spark, make, path):
    rows = make(EVENTS, micro.EVENTS)
    assert load_rows(rows.limit(8), EVENTS, path, "a")
    assert load_rows(rows, EVENTS, path, "b")
    assert not load_rows(rows, EVENTS, path, "b") and not load_rows(rows, EVENTS, path, "a")
    assert stored(spark, path) == Counter(tuple(r) for r in rows.collect())
    assert len(rejected(spark, path)) == 8 and {r[-1] for r in rejected(spark, path)} == {("key",)}


def brute(given, table, parents, known):
    """Accepted and rejected rows, one row after the other."""
    names, good, bad, by_key = table.schema.names, Counter(), Counter(), {}
    for row in given:
        value = dict(zip(names, row, strict=True))
        reasons = [f"null: {c}" for c in table.required if value[c] is None]
        reasons += [f"domain: {c}" for c, a in table.domains.items() if value[c] is not None and value[c] not in a]
        reasons += [f"reference: {r.column}" for r in table.references if value[r.column] is not None and value[r.column] not in parents[r.column]]
        if value[table.key[0]] in known:
            reasons.append("key")
        if reasons:
            bad[(*row, tuple(reasons))] += 1
        else:
            by_key.setdefault(value[table.key[0]], []).append(row)
    for rows in by_key.values():
        rows.sort(key=lambda r: tuple((x is not None, x) for x in r))
        good[rows[0]] += 1
        bad.update((*r, ("key",)) for r in rows[1:])
    return good, bad


def test_every_row_is_accepted_or_rejected_with_its_reasons(spark, make, path):
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)

    def row():
        ts = rng.choice([None, *[start + datetime.timedelta(hours=rng.randrange(100)) for _ in range(9)]])
        return (
            rng.choice([None, 7, 7, *range(10, 400)]),
            rng.choice([None, 1, 2, 3, 99]),
            ts,
            rng.choice(["RUN", "STOP", "RUN", "STOP", "IDLE", None]),
            rng.choice([None, "MECH", "MECH", "NONE"]),
            rng.choice([None, 1, 12345678901]),
        )

    machines, runs = make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)
    known = {r[0]: r for r in micro.EVENTS if r[1] != 9}  # machine 9 has no dimension row
    reasons = schemas.REASONS
    parents = {
        "dim_machines": machines,
        "dim_reason_codes": make(reasons, [("MECH", "MECH", "m"), ("ELEC", "E", "e"), ("CHNG", "C", "c"), ("QUAL", "Q", "q")]),
        "fct_production_runs": runs,
    }
    keys = {"machine_id": {1, 2, 3}, "reason_code": {"MECH", "ELEC", "CHNG", "QUAL"}, "work_order_id": {1, 2, 3, 4, 5}}
    assert load_rows(make(EVENTS, micro.EVENTS), EVENTS, path, "first", parents)
    assert {r[0] for r in stored(spark, path)} == set(known)
    before_good, before_bad = stored(spark, path), rejected(spark, path)
    given = [row() for _ in range(800)]
    given += [(7, 1, start, "RUN", None, None)] * 400 + [(3, 1, start, "RUN", None, None)]
    assert load_rows(make(EVENTS, given, strict=False), EVENTS, path, "second", parents)
    good, bad = brute(given, EVENTS, keys, known)
    assert stored(spark, path) - before_good == good and rejected(spark, path) - before_bad == bad
    assert sum(good.values()) + sum(bad.values()) == len(given) and len({r[-1] for r in bad}) > 10


def test_a_load_that_stops_anywhere_can_be_made_again(spark, make, path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    machines = {"dim_machines": make(schemas.MACHINES, micro.MACHINES), "dim_reason_codes": fixtures.reason_codes(spark)}
    parents = {**machines, "fct_production_runs": make(schemas.RUNS, micro.RUNS)}
    load_rows(make(EVENTS, micro.EVENTS[:3]), EVENTS, path, "a", parents)
    before = stored(spark, path)
    rows = make(EVENTS, micro.EVENTS + micro.EVENTS[5:])
    original, left, stopped = DataFrameWriter.parquet, [0], 0

    def write(self, *args, **kwargs):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("stopped")
        original(self, *args, **kwargs)

    for n in range(20):
        left[0] = n
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        try:
            load_rows(rows, EVENTS, path, "b", parents)
        except OSError:
            stopped += 1
            assert stored(spark, path) == before
            continue
        finally:
            monkeypatch.undo()
        break
    assert stopped == 7  # used, lost, keys, doubtful, rows, settled, snapshot
    assert {r[0] for r in stored(spark, path)} == {r[0] for r in micro.EVENTS if r[1] != 9}
    assert max(stored(spark, path).values()) == 1


def test_tables_without_dates_and_missing_columns(spark, path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "customer_id int, customer_name string")
    assert load_rows(rows, schemas.CUSTOMERS, path, "a")
    assert stored(spark, path, schemas.CUSTOMERS) == Counter([(1, "a")])
    assert rejected(spark, path, schemas.CUSTOMERS) == Counter([(1, "b", ("key",)), (2, None, ("null: customer_name",))])
    assert load_rows(rows.select("customer_id"), schemas.CUSTOMERS, path, "b")
    assert stored(spark, path, schemas.CUSTOMERS) == Counter([(1, "a")])
    assert load_rows(rows.limit(0), schemas.CUSTOMERS, path, "c")
    assert sum(rejected(spark, path, schemas.CUSTOMERS).values()) == 5
    with pytest.raises(ValueError, match="letters"):
        load_rows(rows, schemas.CUSTOMERS, path, "a/b")


def test_bloom_filter_keeps_all_partners_and_drops_most_others(spark):
    keys = spark.range(0, 2_000, 2).selectExpr("cast(id as string) as k")
    rows = spark.range(100_000)
    kept = possibly_among(rows, ["id"], keys, ["k"])
    found = {r.id for r in kept.collect()}
    assert set(range(0, 2_000, 2)) <= found and len(found) < 1_100
    assert possibly_among(rows, ["id"], keys.limit(0), ["k"]).count() == 0
    full = possibly_among(spark.range(2_000), ["id"], keys, ["k"], bits=64)
    assert full.count() == 2_000  # too small a filter only filters less
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_are_not_shuffled_by_key_or_reference(spark, path):
    """Rows move once, to their folders; lost values and doubtful keys are small and broadcast."""
    events = fixtures.machine_events(spark, SF)
    lost = loads.lost_values(events, list(EVENTS.references), parents_of(spark), path)
    rows = loads.judged(events, EVENTS, lost, loads.doubtful_keys(events, EVENTS, None, path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # No event has a work order yet, which the optimizer sees.
    assert plan.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in plan
    assert rows.where(F.col("verdict") != "accepted").count() == 0 < rows.count()
