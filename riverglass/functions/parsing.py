"""JSON in and out: messages, flat maps, windows, envelopes, CSV lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import schemas

PERMISSIVE = {"mode": "PERMISSIVE"}


def parse_message(value: Column) -> Column:
    """A message from JSON; measurements fall back to the numeric fields of a flat object where that key is missing."""
    message = F.from_json(value, schemas.MESSAGE_DDL, PERMISSIVE)
    return message.withField("measurements", F.coalesce(message["measurements"], numeric_map(value)))


def numeric_map(value: Column) -> Column:
    """The numeric fields of a flat JSON object; other fields are left out, and bad JSON gives null."""
    fields = F.from_json(value, "map<string,string>", PERMISSIVE)
    numbers = F.transform_values(fields, lambda _, v: v.try_cast("double"))
    return F.map_filter(numbers, lambda _, v: v.isNotNull())


def device_key(value: Column, field: str = "device_id") -> Column:
    """A JSON object's device, or unknown."""
    return F.coalesce(F.get_json_object(value, f"$.{field}"), F.lit("unknown"))


def csv_line(value: Column, ddl: str) -> Column:
    """A JSON object as a CSV line in the order of a schema."""
    return F.to_csv(F.from_json(value, ddl))


def sorted_entries(m: Column) -> Column:
    """key:value, sorted by key and joined by |."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), "|")


def content_key(device: Column, edge_ms: Column, measurements: Column) -> Column:
    """A message's identity by content: device, time, and measures by name."""
    return F.concat_ws("|", device.cast("string"), edge_ms.cast("string"), sorted_entries(measurements))


def window_key(device: Column, start: Column, end: Column, count: Column, ids: Column) -> Column:
    """A window's identity: device, bounds, count and its sorted message ids."""
    return F.concat_ws("|", device.cast("string"), start.cast("string"), end.cast("string"), count.cast("string"), F.array_join(F.sort_array(ids), ","))


def window_id(device: Column, start: Column, end: Column) -> Column:
    """device_start_end."""
    return F.concat_ws("_", device.cast("string"), start.cast("string"), end.cast("string"))


def group_vector(measures: Column, names: Sequence[str]) -> Column:
    """A group's measures in order, 0 for a missing one; null where none is there."""
    there = F.exists(F.array(*map(F.lit, names)), lambda n: F.map_contains_key(measures, n))
    return F.when(there, F.array(*[F.coalesce(F.element_at(measures, F.lit(n)), F.lit(0.0)) for n in names]))


def envelope(transaction_id: Column, checkpoint_id: Column) -> Column:
    """The transport JSON of a row that is a window record: its twelve fields, and the transaction that sends it."""
    return F.to_json(F.struct(transaction_id.alias("transaction_id"), checkpoint_id.alias("checkpoint_id"), *schemas.WINDOW_FIELDS))


def parse_window(value: Column) -> Column:
    """A window record from JSON, an envelope's too; null fields where they are missing."""
    return F.from_json(value, schemas.WINDOW_DDL, PERMISSIVE)
