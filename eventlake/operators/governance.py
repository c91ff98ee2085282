"""Masked and row-filtered views of the keyed state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.masking import mask_name, mask_tax_id

PRIVILEGED_GROUP = "data_engineers"


def is_member(memberships: DataFrame, caller: str, group: str) -> Column:
    """Group membership as a scalar subquery over a ``(member, grp)`` table."""
    mine = memberships.filter((F.col("member") == caller) & (F.col("grp") == group))
    return mine.agg(F.count("*") > 0).scalar()


def all_memberships(memberships: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``member, grp``: the groups of each member, also those that it is in through other groups.

    Only groups that are members themselves are followed, level by level, and a pair is followed once, so a circle of groups
    ends; its groups are members of themselves. The table of members is joined to the result once.
    ``keep`` materialises rows, such as by writing them to the shared folder. Nulls are in no group and no group has them.
    """
    direct = memberships.select("member", "grp").dropna().distinct()
    nested = keep(direct.join(direct.select(F.col("grp").alias("member")).distinct(), "member", "left_semi"))
    step = nested.select(F.col("member").alias("grp"), F.col("grp").alias("outer"))
    found = fresh = nested
    while not fresh.isEmpty():
        reached = fresh.join(step, "grp").select("member", F.col("outer").alias("grp")).distinct()
        fresh = keep(reached.join(found, ["member", "grp"], "left_anti"))
        found = keep(found.union(fresh))
    through = found.select(F.col("member").alias("grp"), F.col("grp").alias("outer"))
    indirect = direct.join(through, "grp").select("member", F.col("outer").alias("grp"))
    return direct.union(indirect).distinct()


def entitled_insurers(entitlements: DataFrame, caller: str) -> Column:
    """The caller's insurers as an array, from a ``(member, insurer_id)`` table.

    A caller without an entry gets an empty array and therefore sees no row.
    """
    mine = entitlements.filter(F.col("member") == caller)
    return mine.agg(F.collect_set("insurer_id")).scalar()


def masked_view(state: DataFrame, privileged: Column) -> DataFrame:
    return state.withColumns(
        {
            "tax_id": mask_tax_id(F.col("tax_id"), privileged),
            "client_name": mask_name(F.col("client_name"), privileged),
        }
    )


def masked_by_context(state: DataFrame, privileged: Column, open_banks: Sequence[str]) -> DataFrame:
    """The tax id stays readable for some banks only: the mask looks at another column."""
    readable = privileged | F.coalesce(F.col("bank_id").isin(list(open_banks)), F.lit(False))
    return state.withColumn("tax_id", mask_tax_id(F.col("tax_id"), readable))


def row_filtered_view(
    state: DataFrame,
    privileged: Column,
    insurers: Column,
    also: Column | None = None,
) -> DataFrame:
    """Rows of the caller's insurers, or all rows for privileged callers.

    ``also`` is a further condition on what an unprivileged caller may see.
    """
    mine = F.coalesce(F.array_contains(insurers, F.col("insurer_id")), F.lit(False))
    if also is not None:
        mine = mine & F.coalesce(also, F.lit(False))
    return state.filter(privileged | mine)


def without_columns(rows: DataFrame, *hidden: str) -> DataFrame:
    return rows.drop(*hidden)


def secured_view(
    state: DataFrame, memberships: DataFrame, entitlements: DataFrame, caller: str
) -> DataFrame:
    """Row filter and masks together, as an analyst reads the state."""
    privileged = is_member(memberships, caller, PRIVILEGED_GROUP)
    rows = row_filtered_view(state, privileged, entitled_insurers(entitlements, caller))
    return masked_view(rows, privileged)
