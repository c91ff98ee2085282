"""The event contract as column expressions.

Each rule is a named boolean column over a parsed event. The broken rules of an
event are its reasons; an event without reasons is valid. Valid and quarantined
are exact complements by construction, with ANSI mode on or off.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """What an event must fulfil beyond being readable.

    ``types`` and ``statuses`` are closed value sets; ``None`` leaves them open.
    ``strict`` adds the rules of the publishing side (bank, insurer, scope).
    """

    types: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    strict: bool = False


# What the keyed state can hold: client, readable time, at least one typed item.
INTAKE = Contract()


#: A date of four-digit year and a time of day. Shorter forms are castable too, but take the rest from the clock.
_WHOLE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|UTC|[+-]\d{2}:?(\d{2})?))?$"


def whole_time(text: Column) -> Column:
    return text.rlike(_WHOLE_TIME) & ~text.startswith("0000")


def _blank(column: Column) -> Column:
    return column.isNull() | (F.length(column) == 0)


def _any_item(items: Column, broken) -> Column:
    return F.coalesce(F.exists(items, broken), F.lit(False))


def broken_rules(event: Column, contract: Contract = INTAKE) -> list[tuple[str, Column]]:
    """``(reason, is_broken)`` pairs; every ``is_broken`` is never NULL for a readable event."""
    items = event["items"]
    rules = [
        ("missing_client", _blank(event["client_id"])),
        ("missing_time", event["time_text"].isNull()),
        ("bad_time", event["time_text"].isNotNull() & event["event_time"].isNull()),
        ("no_items", items.isNull() | (F.coalesce(F.size(items), F.lit(0)) <= 0)),
        ("untyped_item", _any_item(items, lambda i: i["consent_type"].isNull())),
    ]
    if contract.strict:
        rules += [
            ("missing_bank", _blank(event["bank_id"])),
            ("missing_insurer", _blank(event["insurer_id"])),
            (
                "no_scope",
                _any_item(items, lambda i: F.coalesce(F.size(i["scope"]), F.lit(0)) <= 0),
            ),
        ]
    if contract.types is not None:
        known = list(contract.types)
        rules.append(("unknown_type", _any_item(items, lambda i: ~i["consent_type"].isin(known))))
    if contract.statuses is not None:
        known_status = list(contract.statuses)
        rules.append(
            (
                "unknown_status",
                _any_item(
                    items,
                    lambda i: i["status"].isNull() | ~i["status"].isin(known_status),
                ),
            )
        )
    return rules


def reason_text(event: Column, contract: Contract = INTAKE) -> Column:
    """Comma-joined reasons, empty for a valid event.

    ``concat_ws`` skips NULLs, so one expression both collects the reasons and,
    compared with the empty text, decides validity.
    """
    named = [F.when(broken, F.lit(name)) for name, broken in broken_rules(event, contract)]
    readable = F.concat_ws(",", *named)
    return (
        F.when(event.isNull() | event["unreadable"], F.lit("malformed_json"))
        .when(event["wrong_shape"], F.concat_ws(",", F.lit("wrong_shape"), F.nullif(readable, F.lit(""))))
        .otherwise(readable)
    )
