"""Request queue, new and known ids, and change capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.operators.joins import unplaced
from stagehouse.operators.typing import to_typed
from stagehouse.schemas import EMPLOYEE_LOG, EMPLOYEE_NDS

CREATE, UPDATE, DELETE = "CREATE", "UPDATE", "DELETE"


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right``; nulls are equal.

    Both sides are reduced to distinct rows first: ``subtract`` alone would
    shuffle every row of both before it drops the repeats.
    """
    return left.distinct().subtract(right.distinct())


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.distinct().intersect(right.distinct())


def next_request(ledger: DataFrame, stage: DataFrame, log: DataFrame) -> DataFrame:
    """The oldest successful request that is staged but not in the log; at most one row."""
    waiting = except_distinct(stage.select("request_id"), log.select("request_id"))
    return (
        ledger.where(F.col("status") == "SUCCESS")
        .join(waiting, "request_id")
        .orderBy(F.asc_nulls_last("load_date"), "request_id")
        .limit(1)
        .select("request_id")
    )


def waiting_requests(ledger: DataFrame, stage: DataFrame, log: DataFrame) -> DataFrame:
    """Every request that waits, and its ``turn``: requests taken oldest first go by it."""
    waiting = except_distinct(stage.select("request_id"), log.select("request_id"))
    turn = F.struct(F.col("load_date").isNull().alias("undated"), "load_date", "request_id")
    return (
        ledger.where(F.col("status") == "SUCCESS")
        .join(waiting, "request_id")
        .select("request_id", turn.alias("turn"))
    )


def latest_request(ledger: DataFrame, table: str) -> DataFrame:
    """The newest request of ``table`` whatever its status; at most one row."""
    return (
        ledger.where(F.col("table_name") == table)
        .orderBy(F.desc_nulls_first("load_date"), "request_id")
        .limit(1)
        .select("request_id")
    )


def pick(request: DataFrame) -> str | None:
    """The id out of a one-row frame."""
    row = request.first()
    return None if row is None else row[0]


def rows_of(stage: DataFrame, request_id: str | None) -> DataFrame:
    """The rows of one request.

    A literal prunes the partitions of the staging table while planning, which
    a join to a sorted and limited ledger does not.
    """
    if request_id is None:
        return stage.where(F.lit(False))
    return stage.where(F.col("request_id") == request_id)


def live_ids(log: DataFrame) -> DataFrame:
    """Distinct ids with an entry other than DELETE; a null mode does not count."""
    return log.where(F.col("mode") != DELETE).select("id_employee").distinct()


def _is_canonical(text: Column) -> Column:
    """Whether the id's text is what its number prints as; ``'007'`` is not."""
    return text == text.cast(T.LongType()).cast(T.StringType())


def _with_key(batch: DataFrame, strict_text_key: bool) -> DataFrame:
    number = F.col("id_employee")
    return batch.where(_is_canonical(number) if strict_text_key else number.isNotNull())


def classify(batch: DataFrame, log: DataFrame, strict_text_key: bool = True) -> DataFrame:
    """Log rows for one staged batch, CREATE for new ids and UPDATE for known ones.

    Both modes come from one look at the log. Only log ids that occur in the
    batch matter: Catalyst moves that semi join below the distinct when the
    batch is small enough to broadcast, so the log is then scanned without a
    shuffle; otherwise ids are made distinct before they move.
    """
    batch = _with_key(batch, strict_text_key)
    rows = to_typed(batch, EMPLOYEE_NDS, keep=("request_id", "record_id"))
    ids = batch.select(F.col("id_employee").cast(T.LongType()).alias("id_employee")).distinct()
    known = unplaced(live_ids(log).join(ids, "id_employee", "left_semi")).withColumn(
        "_known", F.lit(True)
    )
    mode = F.when(F.col("_known"), UPDATE).otherwise(CREATE).alias("mode")
    return (
        rows.join(known, "id_employee", "left")
        .select("request_id", "record_id", mode, *EMPLOYEE_NDS.fieldNames())
        .select(*EMPLOYEE_LOG.fieldNames())
    )


def capture_changes(
    stage: DataFrame, log: DataFrame, ledger: DataFrame, strict_text_key: bool = True
) -> DataFrame:
    """Log rows of the next waiting request; none when nothing waits."""
    request_id = pick(next_request(ledger, stage, log))
    return classify(rows_of(stage, request_id), log, strict_text_key)


def classify_backlog(backlog: DataFrame, log: DataFrame, strict_text_key: bool = True) -> DataFrame:
    """Log rows of many staged requests at once, each with its ``turn``.

    What taking them one by one would log: an id is new in the first request
    that has it, unless the log knows it, and known in all later ones. Both
    follow from the least turn of an id and one look at the log.
    """
    backlog = _with_key(backlog, strict_text_key)
    rows = to_typed(backlog, EMPLOYEE_NDS, keep=("request_id", "record_id", "turn"))
    first = backlog.groupBy(F.col("id_employee").cast(T.LongType()).alias("id_employee")).agg(
        F.min("turn").alias("_first")
    )
    known = live_ids(log).join(first.select("id_employee"), "id_employee", "left_semi")
    seen = first.join(unplaced(known).withColumn("_known", F.lit(True)), "id_employee", "left")
    is_known = F.col("_known").isNotNull() | (F.col("turn") > F.col("_first"))
    mode = F.when(is_known, UPDATE).otherwise(CREATE).alias("mode")
    return (
        rows.join(unplaced(seen), "id_employee", "left")
        .select("request_id", "record_id", mode, *EMPLOYEE_NDS.fieldNames(), "turn")
        .select(*EMPLOYEE_LOG.fieldNames(), "turn")
    )


def capture_backlog(
    stage: DataFrame, log: DataFrame, ledger: DataFrame, strict_text_key: bool = True
) -> DataFrame:
    """Log rows of all waiting requests, each with its ``turn``."""
    waiting = unplaced(waiting_requests(ledger, stage, log))
    return classify_backlog(stage.join(waiting, "request_id"), log, strict_text_key)


def created(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("mode") == CREATE)


def updated(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("mode") == UPDATE)


