"""Row types, wire formats and the comparison of two schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names and value sets of the two JSON formats in use.
# ---------------------------------------------------------------------------
CONSENT_TYPES = (
    "compartilhar_dados_cadastrais",
    "compartilhar_dados_financeiros",
    "compartilhar_historico_sinistros",
)
CONSENT_STATUSES = ("ativo", "revogado")


@dataclass(frozen=True)
class Wire:
    """JSON field names of an event. Columns keep our own names throughout."""

    client_id: str = "client_id"
    bank_id: str = "bank_id"
    insurer_id: str = "insurer_id"
    event_time: str = "event_time"
    items: str = "items"
    item_type: str = "type"
    item_scope: str = "scope"
    item_status: str = "status"

    @property
    def item_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.item_type, T.StringType()),
                T.StructField(self.item_scope, T.ArrayType(T.StringType())),
                T.StructField(self.item_status, T.StringType()),
            ]
        )

    @property
    def event_schema(self) -> T.StructType:
        """Times stay text here, so a wrong time is seen as such and not as a missing one."""
        text = [self.client_id, self.bank_id, self.insurer_id, self.event_time]
        return T.StructType(
            [T.StructField(name, T.StringType()) for name in text]
            + [T.StructField(self.items, T.ArrayType(self.item_schema))]
        )


ENGLISH = Wire()
PORTUGUESE = Wire(
    client_id="cliente_id",
    bank_id="banco_origem",
    insurer_id="seguradora_id",
    event_time="timestamp",
    items="consentimentos",
    item_type="tipo",
    item_scope="escopo",
    item_status="status",
)

# ---------------------------------------------------------------------------
# Row types of the stored tables.
# ---------------------------------------------------------------------------
STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
TIME, DATE, BINARY = T.TimestampType(), T.DateType(), T.BinaryType()
STRINGS = T.ArrayType(STRING)


def row(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ITEM = row(consent_type=STRING, scope=STRINGS, status=STRING)

LOG = row(key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG, timestamp=TIME)
RAW = row(raw_json=STRING, topic=STRING, partition=INT, offset=LONG, kafka_timestamp=TIME)

STATE = row(
    client_id=STRING,
    bank_id=STRING,
    insurer_id=STRING,
    client_name=STRING,
    tax_id=STRING,
    event_time=TIME,
    topic=STRING,
    offset=LONG,
    consent_type=STRING,
    scope=STRINGS,
    status=STRING,
)
STATE_KEY = ("client_id", "consent_type")

METRICS = row(
    ref_date=DATE,
    bank_id=STRING,
    insurer_id=STRING,
    consent_type=STRING,
    total_events=LONG,
    total_clients=LONG,
)
METRIC_KEY = ("ref_date", "bank_id", "insurer_id", "consent_type")

DOCUMENT_ITEM = row(consent_type=STRING, event_time=TIME, status=STRING, scope=STRINGS)
DOCUMENTS = row(
    client_id=STRING,
    bank_id=STRING,
    insurer_id=STRING,
    part=INT,
    items=T.ArrayType(DOCUMENT_ITEM),
)
DOCUMENT_KEY = ("client_id", "bank_id", "insurer_id", "part")

CLIENT_MASTER = row(client_id=STRING, client_name=STRING, tax_id=STRING, bank_id=STRING)
BANKS = row(bank_id=STRING, name=STRING)
INSURERS = row(insurer_id=STRING, name=STRING)
PROVENANCE = row(_ingested_at=TIME, _source_file=STRING, _file_modified=TIME, _rescued_data=STRING)
QUARANTINE = T.StructType(RAW.fields + row(reasons=STRINGS, _batch_id=LONG).fields)


def merge_schemas(stored: T.StructType | None, found: T.StructType) -> T.StructType:
    """Stored columns first and unchanged, then the columns seen for the first time."""
    if stored is None:
        return found
    known = {field.name.lower() for field in stored.fields}
    return T.StructType(
        stored.fields + [field for field in found.fields if field.name.lower() not in known]
    )


def apply_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Override the types of some columns, e.g. ``"tax_id STRING, amount DECIMAL(10,2)"``."""
    wanted = {f.name.lower(): f for f in T.StructType.fromDDL(hints).fields}
    kept = [wanted.pop(field.name.lower(), field) for field in schema.fields]
    return T.StructType(kept + list(wanted.values()))


def schema_changes(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str]]:
    """Differences as ``(kind, column, detail)``; an empty list means the contract holds."""
    left = {field.name: field for field in expected.fields}
    right = {field.name: field for field in actual.fields}
    found = [("removed", name, left[name].dataType.simpleString()) for name in left if name not in right]
    found += [("added", name, right[name].dataType.simpleString()) for name in right if name not in left]
    for name in left:
        if name in right and left[name].dataType != right[name].dataType:
            change = f"{left[name].dataType.simpleString()} -> {right[name].dataType.simpleString()}"
            found.append(("type", name, change))
    return sorted(found)
