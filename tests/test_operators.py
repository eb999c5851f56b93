import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stagehouse.operators import changes, filters, joins, keys, lookup, merge, typing, watermark
from stagehouse.schemas import COMPANY_NDS, EMPLOYEE_NDS, REGION_NDS, struct


# --- filters ----------------------------------------------------------------
def test_filter_in(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v long")
    assert filters.filter_in(df, "v", None) is df
    assert filters.filter_in(df, "v", []) is df
    assert rows(filters.filter_in(df, "v", [2, 3])) == [(2,)]
    assert rows(filters.filter_in(df, "v", [2, 3], max_literals=1)) == [(2,)]
    assert rows(filters.filter_not_in(df, "v", [2])) == [(1,)]


# --- typed projection -------------------------------------------------------
def text_frame(spark, schema, **values):
    names = schema.fieldNames()
    data = [tuple(values.get(n) for n in names)]
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))


def test_typed_values(spark):
    df = text_frame(spark, EMPLOYEE_NDS, id_employee=" 12 ", fio="x", birth_date="2023-02-01")
    row = typing.to_typed(df, EMPLOYEE_NDS).first()
    assert (row.id_employee, row.fio, row.birth_date) == (12, "x", dt.datetime(2023, 2, 1))
    assert row.id_region is None


@pytest.mark.parametrize("bad", ["", "1.5", "x"])
def test_bad_integer_fails_or_is_set_aside(spark, bad):
    df = text_frame(spark, EMPLOYEE_NDS, id_employee="1", id_region=bad)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typing.to_typed(df, EMPLOYEE_NDS).collect()
    row = typing.to_typed(df, EMPLOYEE_NDS, on_error="quarantine").first()
    assert (row.id_employee, row.id_region, row["_rejected"]) == (1, None, ["id_region"])


def test_numeric_rounds_half_away_and_overflows(spark):
    for value, expected in (("2.5", 3), ("-2.5", -3), ("2.4", 2)):
        df = text_frame(spark, REGION_NDS, population=value)
        assert int(typing.to_typed(df, REGION_NDS).first().population) == expected
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CANNOT_CHANGE|overflow"):
        df = text_frame(spark, REGION_NDS, population="123456789012345")
        typing.to_typed(df, REGION_NDS).collect()


def test_blank_f_value(spark):
    df = text_frame(spark, REGION_NDS, f_value="")
    assert typing.to_typed(df, REGION_NDS, blank_null=("f_value",)).first().f_value is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typing.to_typed(df, REGION_NDS).collect()


def test_dotted_date_needs_a_format(spark):
    df = text_frame(spark, COMPANY_NDS, create_date="01.02.2023")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typing.to_typed(df, COMPANY_NDS).collect()
    row = typing.to_typed(df, COMPANY_NDS, timestamp_format="dd.MM.yyyy").first()
    assert row.create_date == dt.datetime(2023, 2, 1)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    gap = text_frame(spark, COMPANY_NDS, create_date="12.03.2023 02:30")
    try:
        row = typing.to_typed(gap, COMPANY_NDS, timestamp_format="dd.MM.yyyy HH:mm").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.create_date == dt.datetime(2023, 3, 12, 2, 30)
    wrong = text_frame(spark, COMPANY_NDS, create_date="2023-02-01")
    kept = typing.to_typed(
        wrong, COMPANY_NDS, timestamp_format="dd.MM.yyyy", on_error="quarantine"
    ).first()
    assert kept["_rejected"] == ["create_date"]


def test_strict_casts_refuse_a_lenient_session(spark):
    df = text_frame(spark, COMPANY_NDS)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            typing.to_typed(df, COMPANY_NDS)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_tag_batch_and_measures(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert typing.tag_batch(df, "r").columns == ["request_id", "a", "b"]
    measures = spark.createDataFrame(
        [("a", None, float("nan"), 1.5, None)],
        "dim string, emission_total double, discharge_total double, waste_total double, "
        "co2_total double",
    )
    assert tuple(typing.fill_measures(measures).first()) == ("a", 0.0, 0.0, 1.5, 0.0)


# --- keys -------------------------------------------------------------------
def test_latest_per_key(spark, rows):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame(
        [
            (1, 1, new, "dated"), (1, 2, None, "open"),
            (2, 1, new, "first"), (2, 2, new, "second"),
            (3, 1, old, "single"),
            (None, 1, old, "older"), (None, 2, new, "newer"),
        ],
        "k long, record_id long, d timestamp_ntz, v string",
    )
    latest = keys.latest_per_key(df, ["k"], "d", ["record_id"])
    assert latest.columns == df.columns
    assert rows(latest, "k", "v") == [(None, "newer"), (1, "open"), (2, "second"), (3, "single")]


def test_assert_unique(spark, rows):
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k long, v string")
    assert rows(keys.assert_unique(good, ["k"], "t")) == rows(good)
    assert rows(keys.assert_unique(good.select("v"), ["v"], "t")) == rows(good, "v")
    bad = good.union(spark.createDataFrame([(2, "x")], good.schema))
    with pytest.raises(Exception, match="duplicate key in t: 2"):
        keys.assert_unique(bad, ["k"], "t").collect()


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_surrogate_keys_are_dense_and_sorted(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice([None, "", "a", "b", "ё"]), rng.choice([None, *range(40)])) for _ in range(500)]
    df = spark.createDataFrame(data, "a string, b int")
    found = keys.surrogate_keys(df, ["a", "b"], "id", start=100, partitions=partitions).collect()
    assert {(r.a, r.b) for r in found} == set(data)
    by_id = sorted(found, key=lambda r: r.id)
    assert [r.id for r in by_id] == list(range(100, 100 + len(set(data))))
    order = [((r.a is not None, r.a), (r.b is not None, r.b)) for r in by_id]
    assert order == sorted(order)


def test_surrogate_keys_of_nothing(spark):
    assert keys.surrogate_keys(spark.createDataFrame([], "a string"), ["a"]).count() == 0


def test_join_null_safe(spark, rows):
    left = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "z", "q")], "i int, a string, b string")
    dim = spark.createDataFrame([("a", None, 10), (None, None, 20)], "a string, b string, id int")
    joined = joins.join_null_safe(left, dim, ["a", "b"])
    assert joined.columns == ["i", "a", "b", "id"]
    assert rows(joined, "i", "id") == [(1, 10), (2, 20), (3, None)]


def test_lookup(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    index = spark.createDataFrame([(1, "one"), (None, "x"), (None, "y")], "key long, name string")
    for bound in (None, 4):
        found = lookup.lookup(df, "k", index, "key", "name", max_entries=bound)
        assert rows(found) == [(None, None), (1, "one"), (2, None)]
    doubled = index.union(index)
    with pytest.raises(Exception, match="duplicate key"):
        lookup.lookup(df, "k", doubled, "key", "name").collect()


# --- merges -----------------------------------------------------------------
KV = "k long, v string"


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], KV)
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], KV)
    expected = [(None, "m"), (None, "n"), (1, "a"), (2, "B"), (3, "C")]
    assert rows(merge.upsert(target, updates, ["k"])) == expected
    empty = spark.createDataFrame([], KV)
    assert rows(merge.upsert(empty, updates, ["k"])) == rows(updates)
    assert rows(merge.upsert(target, empty, ["k"])) == rows(target)
    with pytest.raises(Exception, match="duplicate key"):
        merge.upsert(target, updates.union(updates), ["k"]).collect()


def test_upsert_twice_is_upsert_once(spark, rows):
    rng = random.Random(1)
    target = spark.createDataFrame([(i, "t") for i in range(0, 60, 2)], KV)
    updates = spark.createDataFrame([(i, "u") for i in rng.sample(range(60), 25)], KV)
    once = merge.upsert(target, updates, ["k"])
    assert rows(merge.upsert(once, updates, ["k"])) == rows(once)
    assert once.select("k").distinct().count() == once.count()


def test_insert_ignore(spark, rows):
    target = spark.createDataFrame([(1, "a")], KV)
    fresh = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y"), (None, "n"), (None, "n")], KV)
    assert rows(merge.insert_ignore(target, fresh, ["k"])) == [
        (None, "n"), (None, "n"), (1, "a"), (2, "y"),
    ]


def test_new_dim_values(spark, rows):
    dim = spark.createDataFrame([(1, "A"), (7, "B")], "code long, name string")
    values = spark.createDataFrame([("B",), ("C",), (None,), ("C",)], "v string")
    once = merge.append_new_values(dim, values, "name", "code")
    assert rows(once, "code", "name") == [(1, "A"), (7, "B"), (8, None), (9, "C")]
    assert rows(merge.append_new_values(once, values, "name", "code")) == rows(once)
    twice = merge.append_new_values(once, values, "name", "code", dedupe=False)
    assert twice.count() == once.count() + 3


def test_lookup_codes_by_name(spark, rows):
    stage = spark.createDataFrame(
        [("1", "T", "I"), ("2", None, "I"), ("3", "T", "?")],
        "id string, type_company string, type_industry string",
    )
    types = spark.createDataFrame([(1, "T"), (2, "T")], "type_company_cd int, type_company_name string")
    industries = spark.createDataFrame([(5, "I")], "type_industry_cd int, type_indystry_name string")
    found = lookup.lookup_codes_by_name(stage, types, industries)
    assert rows(found, "id", "type_company_cd", "type_industry_cd") == [("1", 1, 5), ("1", 2, 5)]


# --- set operations ---------------------------------------------------------
def test_except_and_intersect(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "v long")
    right = spark.createDataFrame([(2,), (2,), (None,)], "v long")
    assert rows(changes.except_distinct(left, right)) == [(1,)]
    assert rows(changes.intersect_distinct(left, right)) == [(None,), (2,)]


# --- change capture ---------------------------------------------------------
def at(day):
    return dt.datetime(2024, 1, day)


STAGE = "request_id string, record_id long, " + ", ".join(
    f"{n} string" for n in EMPLOYEE_NDS.fieldNames()
)


def stage_row(request, record, ident):
    return (request, record, ident, "A B C", *["1"] * 5, "1990-01-01", "2024-01-01", "u", "1")


def log_frame(spark, entries):
    from stagehouse.schemas import EMPLOYEE_LOG

    return spark.createDataFrame(
        [(r, 0, m, i, "A B C", *[1] * 5, at(1), at(1), "u", 1) for r, m, i in entries], EMPLOYEE_LOG
    )


def ledger_frame(spark, entries):
    return spark.createDataFrame(
        [(r, "T", f"{r}.xml", s, d) for r, s, d in entries],
        "request_id string, table_name string, filename string, status string, load_date timestamp_ntz",
    )


def test_change_capture(spark, rows):
    log = log_frame(
        spark,
        [("old", "CREATE", 1), ("old", "DELETE", 2), ("old", None, 3), ("old", "DELETE", 4), ("old", "UPDATE", 4)],
    )
    idents = ["1", "2", "3", "4", "5", "5", "007", None, " 8 "]
    stage = spark.createDataFrame(
        [stage_row("new", i, ident) for i, ident in enumerate(idents)], STAGE
    )
    ledger = ledger_frame(spark, [("new", "SUCCESS", at(2)), ("old", "SUCCESS", at(1))])
    found = changes.capture_changes(stage, log, ledger)
    assert rows(found, "id_employee", "mode", "record_id") == [
        (1, "UPDATE", 0), (2, "CREATE", 1), (3, "CREATE", 2), (4, "UPDATE", 3),
        (5, "CREATE", 4), (5, "CREATE", 5),
    ]
    loose = changes.capture_changes(stage, log, ledger, strict_text_key=False)
    assert {(7, "CREATE"), (8, "CREATE")} <= set(rows(loose, "id_employee", "mode"))
    creates, updates = changes.created(found), changes.updated(found)
    assert set(rows(creates, "id_employee")) & set(rows(updates, "id_employee")) == set()
    assert creates.count() + updates.count() == found.count()
    after = log.unionByName(found)
    assert changes.capture_changes(stage, after, ledger).count() == 0


def test_queue_is_first_in_first_out(spark):
    log = log_frame(spark, [("done", "CREATE", 1)])
    stage = spark.createDataFrame(
        [stage_row(r, 0, "1") for r in ("done", "late", "early", "busy", "undated")], STAGE
    )
    ledger = ledger_frame(
        spark,
        [
            ("done", "SUCCESS", at(1)), ("late", "SUCCESS", at(9)), ("early", "SUCCESS", at(5)),
            ("busy", "RUNNING", at(2)), ("undated", "SUCCESS", None), ("unstaged", "SUCCESS", at(3)),
        ],
    )
    assert changes.pick(changes.next_request(ledger, stage, log)) == "early"
    assert changes.pick(changes.latest_request(ledger, "T")) == "undated"
    assert changes.pick(changes.latest_request(ledger, "other")) is None
    nothing = changes.capture_changes(stage.limit(0), log, ledger)
    assert nothing.count() == 0 and "mode" in nothing.columns


def test_bad_id_fails_the_batch(spark):
    stage = spark.createDataFrame([stage_row("new", 0, "abc")], STAGE)
    ledger = ledger_frame(spark, [("new", "SUCCESS", at(2))])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        changes.capture_changes(stage, log_frame(spark, []), ledger).collect()


# --- watermark --------------------------------------------------------------
def pairs(spark, data):
    return spark.createDataFrame(data, struct("a:long b:long"))


def test_rows_after(spark, rows):
    source = pairs(spark, [(1, 23), (12, 3), (99, 1), (1010, 1), (12, 9), (12, None), (None, 5)])
    target = pairs(spark, [(12, 3), (1, 23)])
    assert rows(watermark.rows_after(source, target, ["a", "b"])) == [(12, 9), (99, 1), (1010, 1)]
    nothing = pairs(spark, [])
    assert watermark.rows_after(source, nothing, ["a", "b"]).count() == source.count()
    assert rows(watermark.high_watermark(target, ["a", "b"])) == [(12, 3)]
    lost = watermark.rows_not_loaded(source, target, ["a", "b"])
    assert rows(lost) == [(None, 5), (12, None), (12, 9), (99, 1), (1010, 1)]


def test_count_drift(spark):
    one, two = pairs(spark, [(1, 1)]), pairs(spark, [(1, 1), (2, 2)])
    assert tuple(watermark.count_drift(two, one).first()) == (2, 1, True)
    assert tuple(watermark.count_drift(one, one).first()) == (1, 1, False)
    assert tuple(watermark.count_drift(one, one.limit(0)).first()) == (1, 0, True)


# --- hot keys ---------------------------------------------------------------
@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        # A hot partition is cut between map outputs, so there must be several.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_after_run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark):
    """A third of the rows under key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    return spark.range(0, 60_000, 1, 8).select(
        key.cast("long").alias("id_employee"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t")
    )


def test_hot_key_is_split_beside_a_distinct_side(spark, no_broadcast):
    target = spark.range(0, 400).select(F.col("id").alias("id_employee"))
    df = watermark.rows_not_loaded(hot(spark), target, ["id_employee"])
    assert "skew=true" in plan_after_run(df)
    assert df.count() == hot(spark).where(F.col("id_employee") >= 400).count()


def test_hot_key_is_split_in_a_lookup(spark, no_broadcast):
    index = spark.range(0, 400).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    df = lookup.lookup(hot(spark), "id_employee", index, "key", "name")
    assert "skew=true" in plan_after_run(df)
    assert df.where("name is null").count() == hot(spark).where(F.col("id_employee") >= 400).count()


def test_hot_employee_is_split_in_change_capture(spark, no_broadcast):
    columns = [F.lit("1").alias(n) for n in EMPLOYEE_NDS.fieldNames()[2:7]]
    batch = hot(spark).select(
        F.lit("new").alias("request_id"), F.col("id").alias("record_id"),
        F.col("id_employee").cast("string"), F.col("t").alias("fio"), *columns,
        F.lit("1990-01-01").alias("birth_date"), F.lit("2024-01-01").alias("date_devations"),
        F.lit("u").alias("uik"), F.lit("1").alias("uik_num"),
    )
    known = log_frame(spark, [("old", "CREATE", i) for i in range(400)])
    df = changes.classify(batch, known)
    assert "skew=true" in plan_after_run(df)
    assert changes.created(df).count() == hot(spark).where("id_employee >= 400").count()


def test_hot_tuple_is_split_in_a_null_safe_join(spark, no_broadcast):
    dim = keys.surrogate_keys(hot(spark), ["id_employee"], "number", start=0)
    df = joins.join_null_safe(hot(spark), dim, ["id_employee"])
    assert "skew=true" in plan_after_run(df)
    assert df.where("number is null").count() == 0


def hot_stage(spark, lines, sales):
    """500 services in 20 lines, each in a resort of its own; 500 customers."""
    identity = F.col("id")
    return {
        "invoice_line": lines,
        "sales": sales,
        "service": spark.range(500).select(
            identity.alias("service_id"), (identity % 20).alias("sl_id"),
            F.lit(2).cast("decimal(12,2)").alias("price"),
        ),
        "service_line": spark.range(20).select(
            identity.alias("sl_id"), identity.alias("resort_id")
        ),
        "resort": spark.range(20).select(
            identity.alias("resort_id"), (identity % 3).alias("country_id")
        ),
        "customer": spark.range(500).select(
            identity.alias("cust_id"), (identity % 9).alias("sales_id")
        ),
    }


@pytest.mark.parametrize("side", ["service", "customer", "invoice"])
def test_hot_key_is_split_in_the_fact(spark, no_broadcast, side):
    from stagehouse.plans.star import fact_sale

    spread, hot_id = F.col("id") % 500, F.col("id_employee")
    rows_ = hot(spark)
    lines = rows_.select(
        (F.col("id") if side != "invoice" else hot_id).alias("inv_id"),
        (hot_id if side == "service" else F.pmod(F.xxhash64("id"), F.lit(500))).alias("service_id"),
        F.xxhash64("id").alias("days"), F.xxhash64("t").alias("nb_guests"),
    )
    sales = rows_.select(
        F.col("id").alias("inv_id"),
        (hot_id if side == "customer" else spread).alias("cust_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("invoice_date"),
    )
    df = fact_sale(hot_stage(spark, lines, sales))
    assert "skew=true" in plan_after_run(df)
    assert df.count() == 60_000


def test_filter_in_casts_alike_at_any_length(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    for most in (10, 0):
        kept = filters.filter_in(df, "k", ["1", "2", None], max_literals=most)
        assert sorted(r.k for r in kept.collect()) == [1, 2]
