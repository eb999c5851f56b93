"""Extract of the emissions registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.filters import filter_in


def extract_emissions(
    tables: Mapping[str, DataFrame], nvos_ids: Sequence | None = None
) -> DataFrame:
    """Objects with their organisation and all four measurements.

    An object without every measurement drops out. The four measurement joins
    come first: they share ``nvos_id``, so one shuffle per table carries the
    whole chain, and only the result moves again for the organisation.
    """
    objects = filter_in(tables["nvosentities"], "nvos_id", nvos_ids).select(
        "nvos_id",
        "org_id",
        F.col("code").alias("object_code"),
        F.col("name").alias("object_name"),
        F.col("location").alias("object_location"),
        F.col("category").alias("object_category"),
    )
    emissions = tables["emissions"].select(
        "nvos_id",
        F.col("source_count").alias("emission_count"),
        F.col("total_emission").alias("emission_total"),
    )
    discharges = tables["discharges"].select(
        "nvos_id", "discharge_count", F.col("total_discharge").alias("discharge_total")
    )
    waste = tables["waste"].select(
        "nvos_id",
        F.col("object_count").alias("waste_count"),
        F.col("total_mass").alias("waste_total"),
    )
    gases = tables["greenhousegases"].select("nvos_id", F.col("co2_emission").alias("co2_total"))
    organizations = tables["organizations"].select(
        "org_id",
        F.col("organization_name").alias("org_name"),
        F.col("legal_address").alias("org_address"),
        "inn",
    )
    measured = objects
    for measurement in (emissions, discharges, waste, gases):
        measured = measured.join(measurement, "nvos_id")
    return measured.join(organizations, "org_id").select(
        "nvos_id",
        "object_code",
        "object_name",
        "object_location",
        "org_name",
        "org_address",
        "inn",
        "object_category",
        "emission_count",
        "emission_total",
        "discharge_count",
        "discharge_total",
        "waste_count",
        "waste_total",
        "co2_total",
    )
