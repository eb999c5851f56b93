"""Random small frames against plain Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from stagehouse.operators import changes, merge, watermark
from stagehouse.plans import marts
from stagehouse.schemas import struct
from test_operators import at, ledger_frame, log_frame, stage_row, STAGE
from test_plans import fact

SEEDS = [11, 12, 13]


@pytest.mark.parametrize("seed", SEEDS)
def test_change_capture(spark, seed):
    rng = random.Random(seed)
    entries = [
        ("old", rng.choice(["CREATE", "UPDATE", "DELETE", None]), rng.randrange(30))
        for _ in range(40)
    ]
    idents = [rng.choice([str(rng.randrange(40)), f"0{rng.randrange(40)}", None]) for _ in range(80)]
    stage = spark.createDataFrame([stage_row("new", i, v) for i, v in enumerate(idents)], STAGE)
    ledger = ledger_frame(spark, [("new", "SUCCESS", at(2))])
    found = changes.capture_changes(stage, log_frame(spark, entries), ledger)
    live = {i for _, mode, i in entries if mode not in ("DELETE", None)}
    expected = sorted(
        (record, int(v), "UPDATE" if int(v) in live else "CREATE")
        for record, v in enumerate(idents)
        if v is not None and v == str(int(v))
    )
    assert sorted(map(tuple, found.select("record_id", "id_employee", "mode").collect())) == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_monthly_marts(spark, seed):
    rng = random.Random(seed)
    sales = []
    for _ in range(200):
        date = dt.datetime(rng.choice([2022, 2023]), rng.choice([1, 2, 3, 5, 8, 9, 12]), 3)
        sales.append((None if rng.random() < 0.05 else date, Decimal(rng.randrange(1, 9999)) / 100))
    totals: dict = {}
    for date, price in sales:
        key = (date.year, date.month) if date else (None, None)
        totals[key] = totals.get(key, 0) + price
    frame = fact(spark, sales)

    growth = {
        (r.sale_year, r.sale_month): (r.current_month_sales, r.previous_month_sales, r.sales_growth)
        for r in marts.sales_growth_by_month(frame).collect()
    }
    expected = {}
    for (year, month), total in totals.items():
        before = totals.get((year, month - 1)) if month else None
        expected[year, month] = (total, before, None if before is None else total - before)
    assert growth == expected

    months = sorted((k for k in totals if k[0]), key=lambda k: k) + [k for k in totals if not k[0]]
    averages = {
        (r.sale_year, r.sale_month): r.moving_average
        for r in marts.sales_with_moving_average(frame).collect()
    }
    for i, key in enumerate(months):
        frame_totals = [totals[k] for k in months[max(0, i - 3) : i + 2]]
        assert averages[key] == float(sum(frame_totals)) / len(frame_totals)


@pytest.mark.parametrize("seed", SEEDS)
def test_watermark_and_missing_rows(spark, seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, *range(12)])
    source = [(value(), value()) for _ in range(60)]
    target = rng.sample(source, 15)
    schema = struct("a:long b:long")
    frames = spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)
    order = lambda t: [(v is not None, v or 0) for v in t]
    mark = max(map(order, target))
    after = sorted((t for t in source if order(t) > mark), key=order)
    found = watermark.rows_after(*frames, ["a", "b"]).collect()
    assert sorted(map(tuple, found), key=order) == after
    held = {t for t in target if None not in t}
    lost = sorted((t for t in source if t not in held), key=order)
    found = watermark.rows_not_loaded(*frames, ["a", "b"]).collect()
    assert sorted(map(tuple, found), key=order) == lost


@pytest.mark.parametrize("seed", SEEDS)
def test_upsert_and_insert_ignore(spark, seed, rows):
    rng = random.Random(seed)
    schema = struct("k:long v")
    target = {k: f"t{k}" for k in rng.sample(range(40), 20)}
    updates = {k: f"u{k}" for k in rng.sample(range(40), 20)}
    frames = [spark.createDataFrame(list(d.items()), schema) for d in (target, updates)]
    assert rows(merge.upsert(*frames, ["k"])) == sorted({**target, **updates}.items())
    assert rows(merge.insert_ignore(*frames, ["k"])) == sorted({**updates, **target}.items())


@pytest.mark.parametrize("seed", SEEDS)
def test_backlog_capture(spark, seed):
    rng = random.Random(seed)
    names = ["r1", "r2", "r3", "r4", "bad"]
    entries = [("old", rng.choice(["CREATE", "DELETE", None]), rng.randrange(20)) for _ in range(15)]
    stage = spark.createDataFrame(
        [stage_row(rng.choice(names), v, rng.choice([str(rng.randrange(25)), "07", None])) for v in range(90)], STAGE
    )
    dates = {n: at(rng.randrange(1, 9)) if rng.random() < 0.8 else None for n in names}
    ledger = ledger_frame(spark, [(n, "FAILED" if n == "bad" else "SUCCESS", dates[n]) for n in names])
    log = log_frame(spark, entries)
    found = changes.capture_backlog(stage, log, ledger)
    assert found.drop("turn").schema.fieldNames() == log.schema.fieldNames()
    expected, after = [], list(entries)
    for name in sorted(names[:-1], key=lambda n: (dates[n] is None, dates[n] or at(1), n)):
        live = {i for _, mode, i in after if mode not in ("DELETE", None)}
        new = [
            (name, r.record_id, "UPDATE" if int(r.id_employee) in live else "CREATE", int(r.id_employee))
            for r in stage.collect()
            if r.request_id == name and r.id_employee not in (None, "07")
        ]
        expected += new
        after += [(name, mode, i) for _, _, mode, i in new]
    got = [(r.request_id, r.record_id, r.mode, r.id_employee) for r in found.collect()]
    assert sorted(got) == sorted(expected)


def test_backlog_capture_looks_at_the_log_once(spark, tmp_path):
    log_frame(spark, [("old", "CREATE", 1)]).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    stage = spark.createDataFrame([stage_row(r, 1, "1") for r in ("r1", "r2", "r3")], STAGE)
    turns = spark.createDataFrame([(r, (False, at(1), r)) for r in ("r1", "r2", "r3")], "request_id string, turn struct<undated: boolean, load_date: timestamp_ntz, request_id: string>")
    found = changes.classify_backlog(stage.join(turns, "request_id"), log)
    assert {r.mode for r in found.collect()} == {"UPDATE"}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
