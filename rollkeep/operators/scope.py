"""Which parties of a snapshot are in scope, and which lists a run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.scalar import IN_SCOPE, classify, shown
from rollkeep.schemas import SOURCE_LISTS

#: The scopes that may be set.
SCOPES = {"SDN_ONLY": ["SDN"], "SDN_AND_CONSOLIDATED": ["SDN", "CONSOLIDATED"]}


class ScopeError(ValueError):
    """A scope setting that is missing, blank or not known; `kind` says which."""

    def __init__(self, kind: str, given: str | None) -> None:
        super().__init__(f"{kind}: {given!r}")
        self.kind = kind


def lists_in_scope(setting: str | None) -> list[str]:
    """The lists of a scope setting, in order of precedence; trimmed, case-sensitive."""
    if setting is None:
        raise ScopeError("MISSING", setting)
    if not setting.strip():
        raise ScopeError("BLANK", setting)
    if setting.strip() not in SCOPES:
        raise ScopeError("UNKNOWN", setting)
    return SCOPES[setting.strip()]


def check_source_list(name: str) -> str:
    if name not in SOURCE_LISTS:
        raise ValueError(f"unknown source list {name!r}")
    return name


def classified(parties: DataFrame, sub_type: str = "party_sub_type_id") -> DataFrame:
    """parties with party_class and entity_type; the latter is null out of scope."""
    kind = classify(F.col(sub_type))
    return parties.withColumns({"party_class": kind, "entity_type": F.when(kind.isin(*IN_SCOPE), kind)})


def in_scope(parties: DataFrame, sub_type: str = "party_sub_type_id") -> DataFrame:
    return classified(parties, sub_type).where("entity_type is not null").drop("party_class")


def scope_counts(parties: DataFrame, sub_type: str = "party_sub_type_id", by: tuple[str, ...] = ("snapshot_id",)) -> DataFrame:
    """record_count, in_scope_count and out_of_scope_count, one row for each snapshot."""
    rows = classified(parties, sub_type).withColumn("in_", F.col("entity_type").isNotNull().cast("long"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"), F.sum("in_").alias("in_scope_count"), F.sum(1 - F.col("in_")).alias("out_of_scope_count"))


def scope_diagnostics(parties: DataFrame, sub_type: str = "party_sub_type_id") -> DataFrame:
    """One UNRECOGNIZED_TYPE row for each party whose type is null, blank or unknown; none for vessels and aircraft."""
    rows = classified(parties, sub_type).where("party_class = 'Unrecognized'")
    detail = F.concat(F.lit("party sub-type "), shown(F.col(sub_type)))
    return rows.select("snapshot_id", "fixed_ref", F.lit("UNRECOGNIZED_TYPE").alias("kind"), detail.alias("detail"))
