"""Sales loads that fetch, stage and add up only what came since the last one.

Invoice lines, invoices and customers grow with the sales. Of these a load reads
the rows past the greatest key of the last load, which the scan itself compares,
and stages them as a batch. Lines whose invoice, customer or service is not there
yet wait for the next load. The new part of the fact is summed by seller and date,
service, and place and date; these sums are added to those of the last load, and
all nine marts come out of them. So a load costs its delta, the sums and the marts
(which are of one size), and the customer and service keys its lines meet, not the
sales of all years.

The small reference tables are fetched whole. A new name shows in the marts at
once. Where the price or place of a service changed, the sums are made anew from
the staged lines, since a full reload would apply the change to old sales as well.

``reconcile=True`` looks for keys that are not staged, in place of keys past the
mark, and so also finds rows that came late with a smaller key. Rows of the three
growing tables that change or go at the source are found by neither; that takes a
full reload (``jobs.repeated_load``). Their keys are taken to be unique, as in the
source; a line without its first key is loaded by the first load only.

Everything a load writes is a batch of its request, and the next load starts from
the newest request that succeeded, so a load that broke off is simply run again.
One load runs at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import ledger
from stagehouse.functions.buckets import REPEATED, AgeBuckets
from stagehouse.functions.dates import SUNDAY_FIRST
from stagehouse.operators import merge, watermark
from stagehouse.operators.joins import unplaced
from stagehouse.operators.typing import tag_batch
from stagehouse.plans import jobs, marts, star
from stagehouse.schemas import SALES_TABLES, struct
from stagehouse.session import delete, job_scratch, materialize
from stagehouse.sinks.warehouse import BATCH, Warehouse, tagged
from stagehouse.sources.tables import TableSource, read_table

LAYER = "inc"
LOAD = "sales increments"
# The tables that grow, with the key they are followed by.
GROWING = {
    "invoice_line": ("inv_id", "service_id"),
    "sales": ("inv_id",),
    "customer": ("cust_id",),
}
REFERENCE = ("country", "resort", "sales_person", "service", "service_line")
LOADS = struct(
    "request number:long base:long line_inv:long line_service:long invoice:long customer:long"
)
MARKS = {
    "invoice_line": ("line_inv", "line_service"),
    "sales": ("invoice",),
    "customer": ("customer",),
}
# Kept sums by name: their keys. Months and weekdays are sums over the dates of ``by_seller``.
SUMS = {
    "by_seller": "seller_id:long invoice_date:time",
    "by_service": "service_id:long",
    "by_place": "country_id:long resort_id:long invoice_date:time",
}
AGES = T.StructType([*struct("age:long").fields, T.StructField("_count", T.LongType())])
# Digits of a price and of sums of it, by measure.
DIGITS = {"price": (12, 22), "amount": (24, 34)}


def _sums_schema(name: str, measure: str) -> T.StructType:
    total = T.StructField("_total", T.DecimalType(DIGITS[measure][1], 2))
    return T.StructType([*struct(SUMS[name]).fields, total, T.StructField("_count", T.LongType())])


def _fact_schema(measure: str) -> T.StructType:
    price = T.StructField("price", T.DecimalType(DIGITS[measure][0], 2))
    start = struct("inv_id:long cust_id:long invoice_date:time").fields
    rest = struct("seller_id:long service_id:long sl_id:long resort_id:long country_id:long").fields
    return T.StructType([*start, price, *rest])


def last_load(warehouse: Warehouse) -> Mapping | None:
    """Number, marks and request of the newest load that succeeded."""
    loads = warehouse.read_committed(LAYER, "loads", LOADS)
    row = loads.orderBy(F.desc("number")).first()
    return None if row is None else row.asDict()


def facts(warehouse: Warehouse, measure: str = "price") -> DataFrame:
    """The fact as the loads made it: all batches since it was last made anew."""
    schema = _fact_schema(measure)
    last = last_load(warehouse)
    loads = warehouse.read_committed(LAYER, "loads", LOADS)
    valid = loads.where(F.col("number") >= F.lit(last["base"] if last else 0))
    rows = warehouse.batches(LAYER, "fact_sale", tagged(schema))
    requests = unplaced(valid.select(F.col("request").alias(BATCH)))
    return rows.join(requests, BATCH, "left_semi").select(*schema.fieldNames())


def new_rows(
    source: TableSource, warehouse: Warehouse, table: str, last: Mapping | None, reconcile: bool
) -> DataFrame:
    """Rows of a growing table past the mark, or those whose key is not staged."""
    keys = list(GROWING[table])
    if last is None:
        return read_table(source, table)
    if reconcile:
        staged = warehouse.read_committed(LAYER, table, SALES_TABLES[table])
        return watermark.rows_not_loaded(read_table(source, table), staged, keys).select(
            *SALES_TABLES[table].fieldNames()
        )
    mark = [last[column] for column in MARKS[table]]
    if mark[0] is None:
        return read_table(source, table)
    return read_table(source, table, low=mark[0]).where(watermark.past_mark(keys, mark))


def _mark(rows: DataFrame, table: str, last: Mapping | None) -> list:
    """The greatest key of the new rows and those before."""
    found = watermark.high_watermark(rows, GROWING[table]).first()
    before = [last[column] for column in MARKS[table]] if last else [None] * len(MARKS[table])
    order = lambda key: [(part is not None, part or 0) for part in key]
    return max(list(found), before, key=order)


class _Load:
    """One load: its request, what it stages and what it starts from."""

    def __init__(self, source: TableSource, warehouse: Warehouse, request: str, measure: str):
        self.source, self.warehouse = source, warehouse
        self.request, self.measure = request, measure
        self.last = last_load(warehouse)

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        """Write a batch of this load and read it back."""
        self.warehouse.append_batch(tag_batch(rows, self.request), LAYER, name)
        return self.own(name, rows.schema)

    def own(self, name: str, schema: T.StructType) -> DataFrame:
        return self.warehouse.batch(LAYER, name, tagged(schema), self.request).drop(BATCH)

    def before(self, name: str, schema: T.StructType) -> DataFrame:
        """The batch of the last load; empty when there is none."""
        request = self.last["request"] if self.last else None
        return self.warehouse.batch(LAYER, name, tagged(schema), request).drop(BATCH)

    def all_staged(self, table: str) -> DataFrame:
        """Staged rows of all loads and this one."""
        schema = SALES_TABLES[table]
        return self.warehouse.read_committed(LAYER, table, schema).unionByName(
            self.own(table, schema)
        )

    def stage(self, reconcile: bool) -> dict[str, DataFrame]:
        """The new rows of the growing tables and all rows of the others, staged."""
        names = [*GROWING, *REFERENCE]
        fetched = {
            table: new_rows(self.source, self.warehouse, table, self.last, reconcile)
            if table in GROWING
            else read_table(self.source, table)
            for table in names
        }
        jobs.side_by_side([lambda t=t: self.write(fetched[t], t) for t in names])
        return {table: self.own(table, SALES_TABLES[table]) for table in names}

    def changed(self, stage: Mapping[str, DataFrame]) -> tuple[bool, bool]:
        """Whether any reference row is new or gone, and whether one changed that lines use."""
        if self.last is None:
            return True, False
        held = {table: self.before(table, SALES_TABLES[table]) for table in REFERENCE}
        moved = star.service_terms(held).subtract(star.service_terms(stage))
        if not moved.isEmpty():
            return True, True
        differ = [
            stage[t].exceptAll(held[t]).limit(1).select(F.lit(1)).unionAll(
                held[t].exceptAll(stage[t]).limit(1).select(F.lit(1))
            )
            for t in REFERENCE
        ]
        return any(not rows.isEmpty() for rows in differ), False

    def place(self, stage: Mapping[str, DataFrame], anew: bool) -> DataFrame:
        """The new part of the fact; lines that cannot be placed yet are kept for later."""
        line = SALES_TABLES["invoice_line"]
        if anew:
            lines = self.all_staged("invoice_line")
        else:
            lines = stage["invoice_line"].unionByName(self.before("waiting", line))
        # Keys grow, so the range of the new ones leaves out most files of old invoices.
        low, high = lines.agg(F.min("inv_id"), F.max("inv_id")).first()
        invoices = self.all_staged("sales").where(F.col("inv_id").between(low, high))
        placed = star.place_lines(
            lines, invoices, self.all_staged("customer"), star.service_terms(stage), self.measure
        )
        placed = materialize(placed, "placed")
        self.write(placed.where(~F.col("placed")).select(*line.fieldNames()), "waiting")
        schema = _fact_schema(self.measure)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        return self.write(placed.where("placed").select(*columns), "fact_sale")

    def add_up(self, fact: DataFrame, customers: DataFrame, anew: bool) -> dict[str, DataFrame]:
        """Kept sums plus those of the new rows."""
        sums = {}
        for name in SUMS:
            schema = _sums_schema(name, self.measure)
            keys = struct(SUMS[name]).fieldNames()
            rows = marts.sums_by(fact, keys)
            if not anew:
                rows = marts.sums_by(rows.unionByName(self.before(name, schema)), keys)
            sums[name] = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        fresh = star.dim_customer({"customer": customers})
        ages = marts.counts_by(fresh, ["age"]).unionByName(self.before("by_age", AGES))
        sums["by_age"] = marts.counts_by(ages, ["age"])
        jobs.side_by_side([lambda n=n: self.write(sums[n], n) for n in sums])
        return {name: self.own(name, rows.schema) for name, rows in sums.items()}

    def update_dimensions(self, stage: Mapping[str, DataFrame]) -> None:
        for name, (table, _) in star.DIMENSIONS.items():
            if table in REFERENCE:
                rows = star.dimension(stage, name)
                held = self.warehouse.snapshot(LAYER, name, rows.schema)
                merged = merge.upsert(held, rows, [rows.columns[0]], check_unique=False)
                self.warehouse.replace(merged, LAYER, name)
                self.warehouse.expire(LAYER, name)

    def finish(self, stage: Mapping[str, DataFrame], anew: bool) -> None:
        """Record the load: its number, where its fact begins, and the marks."""
        number = self.last["number"] + 1 if self.last else 1
        base = number if anew or not self.last else self.last["base"]
        marks = [part for t in GROWING for part in _mark(stage[t], t, self.last)]
        row = (self.request, number, base, *marks)
        self.write(self.warehouse.spark.createDataFrame([row], LOADS), "loads")

    def forget(self) -> None:
        """Delete sums and reference batches older than those of the last load."""
        kept = {self.request, self.last["request"] if self.last else None}
        for name in (*SUMS, "by_age", "waiting", *REFERENCE):
            # As many ids as there are batches left: two, and those of loads that broke off.
            for row in self.warehouse.batch_ids(LAYER, name).collect():
                if row[0] not in kept:
                    path = f"{self.warehouse.path(LAYER, name)}/{BATCH}={row[0]}"
                    delete(self.warehouse.spark, path)


def incremental_load(
    source: TableSource,
    warehouse: Warehouse,
    reconcile: bool = False,
    measure: str = "price",
    labels: tuple[str, ...] = SUNDAY_FIRST,
    buckets: AgeBuckets = REPEATED,
) -> bool:
    """Load what is new into fact, sums and the nine marts; whether there was anything.

    The first load takes everything. ``measure`` stays what the first load had.
    """
    request = warehouse.ledger.open(LOAD)
    try:
        with job_scratch(warehouse.spark):
            load = _Load(source, warehouse, request, measure)
            stage = load.stage(reconcile)
            changed, anew = load.changed(stage)
            if not changed and all(stage[table].isEmpty() for table in GROWING):
                warehouse.ledger.close(request, ledger.EMPTY)
                return False
            fact = load.place(stage, anew)
            sums = load.add_up(fact, stage["customer"], anew)
            load.update_dimensions(stage)
            ages = sums.pop("by_age")
            jobs.write_marts(warehouse, LAYER, *sums.values(), ages, labels, buckets)
            load.finish(stage, anew)
    except Exception:
        warehouse.ledger.close(request, ledger.FAILED)
        raise
    warehouse.ledger.close(request, ledger.SUCCESS)
    load.forget()
    return True
