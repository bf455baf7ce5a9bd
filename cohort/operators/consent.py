"""Consent gate.

The gate is the first step of every plan: anything derived from a person who
has not consented (GDPR) or has opted out (CCPA) never reaches a join or an
aggregate. Gating is a ``left_semi`` join, so it never fans out rows even
when the allowed-key side repeats, and AQE turns it into a broadcast only when
the runtime size of the allowed side is below the broadcast threshold.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.expressions import is_allowed


def with_processing_allowed(persons: DataFrame) -> DataFrame:
    """Add ``processing_allowed`` derived from the regime flags."""
    if "processing_allowed" in persons.columns:
        return persons
    return persons.withColumn("processing_allowed", is_allowed())


def consent_report(persons: DataFrame) -> DataFrame:
    """One-row suppression report (C1, C2), one global aggregate.

    ``suppressed_gdpr_no_consent`` counts EU people without consent;
    ``suppressed_ccpa_opt_out`` counts every opt-out regardless of region.
    An empty input yields zeros rather than an error.
    """
    p = with_processing_allowed(persons)
    eu_no_consent = (F.col("region") == "EU") & ~F.coalesce(F.col("gdpr_consent"), F.lit(False))
    agg = p.agg(
        F.count(F.lit(1)).alias("total_people"),
        F.count_if(F.coalesce(F.col("processing_allowed"), F.lit(False))).alias("allowed_people"),
        F.count_if(F.coalesce(eu_no_consent, F.lit(False))).alias("suppressed_gdpr_no_consent"),
        F.count_if(F.coalesce(F.col("ccpa_opt_out"), F.lit(False))).alias("suppressed_ccpa_opt_out"),
    )
    return agg.select(
        "total_people", "allowed_people",
        F.round(F.lit(100.0) * F.col("allowed_people") / F.greatest(F.lit(1), F.col("total_people")), 2)
         .alias("retained_pct"),
        "suppressed_gdpr_no_consent", "suppressed_ccpa_opt_out")


def device_suppression(devices: DataFrame, persons: DataFrame) -> DataFrame:
    """One-row device-level audit of the gate: kept and dropped devices by reason.

    A device is dropped for GDPR (EU owner without consent), for CCPA (owner
    opted out), or because its owner is not in the persons table. One left
    join of devices to the owner's flags, then one global aggregate.
    """
    p = with_processing_allowed(persons).select(
        "person_id", F.lit(True).alias("_known"),
        F.coalesce(F.col("processing_allowed"), F.lit(False)).alias("_ok"),
        ((F.col("region") == "EU") & ~F.coalesce(F.col("gdpr_consent"), F.lit(False))).alias("_gdpr"),
        F.coalesce(F.col("ccpa_opt_out"), F.lit(False)).alias("_ccpa"))
    j = devices.select("person_id").join(p, "person_id", "left")
    known = F.coalesce(F.col("_known"), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("total_devices"),
                 F.count_if(known & F.col("_ok")).alias("kept_devices"),
                 F.count_if(known & F.coalesce(F.col("_gdpr"), F.lit(False))).alias("dropped_gdpr_no_consent"),
                 F.count_if(known & F.col("_ccpa")).alias("dropped_ccpa_opt_out"),
                 F.count_if(~known).alias("dropped_unknown_owner"))


def allowed_person_ids(persons: DataFrame) -> DataFrame:
    """The consented population (C3): ``[person_id]``. Null flags drop the row."""
    return (with_processing_allowed(persons)
            .where(F.coalesce(F.col("processing_allowed"), F.lit(False)))
            .select("person_id"))


def gate_devices(devices: DataFrame, persons: DataFrame) -> DataFrame:
    """Devices owned by consented people (C4)."""
    return devices.join(allowed_person_ids(persons), "person_id", "left_semi")


def gate_by_devices(table: DataFrame, kept_devices: DataFrame, key: str = "device_id") -> DataFrame:
    """Signals or events of kept devices only."""
    return table.join(kept_devices.select(key), key, "left_semi")


def gate_by_persons(table: DataFrame, persons: DataFrame, key: str = "person_id") -> DataFrame:
    """Any person-keyed table restricted to the consented population."""
    return table.join(allowed_person_ids(persons).withColumnRenamed("person_id", key), key, "left_semi")
