"""Evidence import: contract checks, verification of tier A, fingerprints, append without repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import fingerprint
from ..functions.text import canonical
from .ranking import first_by

IDENTITY = (
    "address", "assertion_type", "candidate_entity_id", "candidate_entity_name", "candidate_label", "candidate_wallet_role",
    "provider_entity_id", "provider_tag_id", "source_authority", "evidence_tier", "independence_group", "artifact_sha256",
    "observed_at"
)
# The allowed words of each enumeration.
ENUMS = {
    "assertion_type": ("entity_control", "address_label", "address_kind", "relationship", "wallet_role"),
    "source_authority": ("official", "regulator", "commercial_provider", "public_explorer", "local_inference"),
    "evidence_tier": ("A", "B", "C", "D", "E"),
}


class Verifiers(dict[str, Callable[[DataFrame], DataFrame]]):
    """By method: a function that adds verification_result to the rows of its method."""


def contract_codes() -> Column:
    c = F.col
    empty = lambda x: F.coalesce(c(x), F.lit("")) == ""
    rules = {
        "address_missing": empty("address"),
        "entity_missing": (c("assertion_type") == "entity_control") & empty("candidate_entity_id") & empty("candidate_entity_name"),
        "label_missing": c("assertion_type").isin("address_label", "address_kind", "relationship") & empty("candidate_label"),
        "role_missing": (c("assertion_type") == "wallet_role") & empty("candidate_wallet_role"),
        "verification_missing": (c("evidence_tier") == "A") & c("verification_result").isNull(),
        "effective_order": c("effective_to") < c("effective_from"),
    } | {f"{k}_unknown": ~F.coalesce(c(k), F.lit("")).isin(*v) for k, v in ENUMS.items()}
    return F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))


def checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that hold the contract, and the others with their codes."""
    judged = rows.withColumn("codes", contract_codes())
    return judged.where(F.size("codes") == 0).drop("codes"), judged.where(F.size("codes") > 0)


def verified(rows: DataFrame, verifiers: Verifiers) -> DataFrame:
    """Tier A rows pass through their method's verifier; those of unknown methods are invalid."""
    known = F.col("verification_method").isin(*verifiers) if verifiers else F.lit(False)
    is_a = F.col("evidence_tier") == "A"
    out = rows.where(~is_a).unionByName(rows.where(is_a & ~F.coalesce(known, F.lit(False))).withColumn("verification_result", F.lit("invalid")))
    for name, verify in verifiers.items():
        out = out.unionByName(verify(rows.where(is_a & (F.col("verification_method") == name))).select(*rows.columns))
    return out


def fingerprinted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("evidence_fingerprint", fingerprint(**{k: F.col(k) for k in IDENTITY if k in rows.columns}))


def new_rows(rows: DataFrame, ledger: DataFrame, key: str = "evidence_fingerprint") -> DataFrame:
    """One row of each fingerprint that the ledger doesn't hold, the first by all fields: what an append adds."""
    return first_by(rows, [key], *[F.asc(c) for c in sorted(rows.columns) if c != key]).join(ledger.select(key), key, "left_anti")


def claim_eligible() -> Column:
    """Commercial tags of an address label stay evidence and make no claim."""
    c = F.col
    return ~((c("assertion_type") == "address_label") & (c("source_authority") == "commercial_provider") & (F.coalesce(c("provider_tag_id"), F.lit("")) != ""))


def canonical_value() -> Column:
    """Names come before ids, so ids of different sources can support one claim."""
    c = F.col
    first = lambda *x: F.coalesce(*[F.when(c(k) != "", c(k)) for k in x])
    raw = F.when(
        c("assertion_type") == "entity_control", first("candidate_entity_name", "candidate_entity_id")
    ).when(c("assertion_type") == "wallet_role", c("candidate_wallet_role")).otherwise(c("candidate_label"))
    return canonical(raw)
