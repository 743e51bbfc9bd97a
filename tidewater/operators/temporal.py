"""Point-in-time joins of facts with versioned dimensions, and the checks that prove them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .history import as_checks


def version_at(fact_key: Column, event: Column, version_key: Column, valid_from: Column, valid_to: Column) -> Column:
    """Half-open interval, open end null; a null key or event matches nothing."""
    return (fact_key == version_key) & (event >= valid_from) & (valid_to.isNull() | (event < valid_to))


def point_in_time_join(facts: DataFrame, versions: DataFrame, fact_key: str, event: str, version_key: str, columns: dict[str, str]) -> DataFrame:
    """``facts`` with ``columns`` (version column: new name) of the version valid at the event; null where none was.

    An equi join with a residual range condition: hash or sort-merge as sizes ask, never a nested loop.
    """
    held = versions.select(F.col(version_key).alias("_vk"), F.col("valid_from").alias("_vf"), F.col("valid_to").alias("_vt"), *[F.col(c).alias(n) for c, n in columns.items()])
    return facts.join(held, version_at(F.col(fact_key), F.col(event), F.col("_vk"), F.col("_vf"), F.col("_vt")), "left").drop("_vk", "_vf", "_vt")


def match_profile(facts: DataFrame, versions: DataFrame, fact_id: list[str], fact_key: str, event: str, version_key: str) -> DataFrame:
    """A row a fact: how many versions match, which one, the current one, the first boundary, and why none matches.

    ``reason``: matched, null_key, null_event, no_version, before_first, gap.
    """
    held = versions.select(F.col(version_key).alias("_vk"), "valid_from", "valid_to", "is_current", "version_key")
    hit = version_at(F.col(fact_key), F.col(event), F.col("_vk"), F.col("valid_from"), F.col("valid_to"))
    joined = facts.select(*fact_id, F.col(fact_key).alias("_fk"), F.col(event).alias("_ev")).join(held, F.col("_fk") == F.col("_vk"), "left")
    hit = F.coalesce((F.col("_ev") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_ev") < F.col("valid_to"))), F.lit(False))
    out = joined.groupBy(*fact_id, "_fk", "_ev").agg(
        F.count_if(hit).alias("matches"), F.max(F.when(hit, F.col("version_key"))).alias("version_key"), F.max(F.when(F.col("is_current"), F.col("version_key"))).alias("current_key"), F.min("valid_from").alias("first_from")
    )
    reason = (
        F.when(F.col("matches") > 0, "matched").when(F.col("_fk").isNull(), "null_key").when(F.col("_ev").isNull(), "null_event").when(F.col("first_from").isNull(), "no_version")
        .when(F.col("_ev") < F.col("first_from"), "before_first").otherwise("gap")
    )
    return out.withColumn("reason", reason).withColumnsRenamed({"_fk": "fact_key", "_ev": "event"})


def mapping_checks(profile: DataFrame, stored: DataFrame, fact_id: list[str], stored_key: str, null_key_allowed: bool = False) -> DataFrame:
    """check, failures: valid dates, no overlap, the stored key is the expected one, every missing key explained."""
    both = profile.join(stored.select(*fact_id, F.col(stored_key).alias("_stored")), fact_id, "left")
    return as_checks(both, {
        "valid_date": F.col("event").isNull(), "no_overlap": F.col("matches") > 1, "exact_key": ~F.col("_stored").eqNullSafe(F.col("version_key")),
        "null_key": F.lit(False) if null_key_allowed else F.col("fact_key").isNull(), "key_has_version": F.col("reason") == "no_version", "explained": F.col("reason") == "gap",
    })
