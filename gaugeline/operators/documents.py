"""Raw document texts to typed readings, with nothing lost on the way.

A text is parsed once by the fixed schema, which types what is known, and once as VARIANT, which keeps
what is not. Texts that are no documents become rows of their own with the reason; fields the schema
does not know travel in a map until their types over all rows are known, and then become columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.functions import snake_case
from gaugeline.operators.reshape import typed, with_event_date

#: Columns of :func:`document_readings` besides those of the documents.
UNKNOWN, REASON, PLACE = "_unknown", "_reason", "_place"
#: Where values go whose field cannot be a column: JSON text.
LEFT_OVER = "unknownFields"
MALFORMED, NO_DOCUMENT, OTHER_KIND = ("no readable JSON", "not a document or a list of documents",
                                      "a field of another kind")
_CORRUPT = "_corrupt_document"
_REST = "map<string,variant>"


def _parse_schema(schema: T.StructType) -> T.StructType:
    """Envelope, readings and the single-reading payload; numbers of the envelope come as text too."""
    fields = [T.StructField(f.name, T.StringType()) if f.name in schemas.ENVELOPE_NUMBER else f
              for f in schema]
    payload = list(schema["records"].dataType.elementType)
    present = {f.name for f in payload}
    payload += [T.StructField(n, T.StringType()) for n in (*schemas.ENVELOPE_TEXT, "eventTimestamp")
                if n not in present]
    return T.StructType([*fields, T.StructField("rawPayload", T.StructType(payload)),
                         T.StructField(_CORRUPT, T.StringType())])


def _rest(value: Column, known: set[str]) -> Column:
    """Fields of a VARIANT object that are not known; an empty map for anything else."""
    fields = F.try_variant_get(value, "$", _REST)
    return F.coalesce(F.map_filter(fields, lambda name, _: ~name.isin(*sorted(known))),
                      F.create_map().cast(_REST))


def _variant(text: Column) -> Column:
    """NaN and infinities, which the fixed schema reads and VARIANT does not, are null here."""
    numbers = F.regexp_replace(text, r"([:\[,]\s*)[+-]?(?:NaN|INF|Infinity)(?=\s*[,}\]])", "$1null")
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(numbers))


def parse_documents(texts: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """(path, place, document, variant, reason, text) of each document of ``texts`` (text, path).

    A text is one document or a list of documents. Blank texts are none. Where a text is neither,
    cannot be read to its end, or has a field of another kind than the schema says - readings that are
    no list, for example - there is one row with the reason and the text, without a document.
    """
    parsed = _parse_schema(schema or schemas.raw_schema())
    text = F.col("text")
    is_list = text.rlike(r"\A\s*\[")
    single = F.from_json(text, parsed, {"columnNameOfCorruptRecord": _CORRUPT})
    found = F.when(is_list, F.from_json(text, T.ArrayType(parsed))).otherwise(F.array(single))
    variants = F.when(F.col("is_list"), F.try_variant_get("variant", "$", "array<variant>")
                      ).otherwise(F.array("variant"))
    rows = (texts.where(text.rlike(r"\S"))
            .select("path", "text", is_list.alias("is_list"), found.alias("found"),
                    _variant(text).alias("variant")))
    # In a list, an element that is no object gives a document without any field.
    readable = F.col("found").isNotNull() & ~F.exists("found", lambda d: d.isNull()
                                                      | d[_CORRUPT].isNotNull())
    kind = F.schema_of_variant("variant")
    reason = (F.when(F.col("variant").isNull() & ~F.col("readable"), MALFORMED)
              .when(~F.col("readable") & ~F.col("is_list") & ~kind.startswith("OBJECT"), NO_DOCUMENT)
              .when(~F.col("readable"), OTHER_KIND))
    rows = rows.withColumn("readable", readable).withColumn(REASON, reason)
    aligned = F.arrays_zip(
        F.col("found").alias("document"),
        F.coalesce(variants, F.array().cast("array<variant>")).alias("variant"))
    nothing = F.array(F.struct(F.lit(None).cast(parsed).alias("document"),
                               F.lit(None).cast("variant").alias("variant")))
    each = F.when(F.col(REASON).isNull(), aligned).otherwise(nothing)
    return rows.select("path", REASON, F.when(F.col(REASON).isNotNull(), text).alias("text"),
                       F.posexplode(each).alias("at", "d")).select(
        "path", "at", REASON, "text", F.col("d.document").alias("document"),
        F.col("d.variant").alias("variant"))


def document_readings(parsed: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Readings of parsed documents, one row each, and a row for every text that is no document.

    Day batches hold a list of readings, single-reading documents one payload that repeats the
    identifiers; both give the same columns. A name found on both levels keeps the envelope's value.
    Documents without readings yield no row. ``_unknown`` maps the fields that the schema does not know
    to their values, null where there is none; ``_place`` tells where a reading comes from; ``_reason`` and
    ``text`` are set for texts that are no documents.
    """
    schema = schema or schemas.raw_schema()
    envelope = [n for n in schema.fieldNames() if n != "records"]
    record = schema["records"].dataType.elementType.fieldNames()
    d, payload = F.col("document"), F.col("document")["rawPayload"]

    def of_envelope(name: str) -> Column:
        value = d[name]
        if name in schemas.ENVELOPE_TEXT:
            value = F.coalesce(value, payload[name])
        if name in schemas.ENVELOPE_NUMBER:
            value = value.try_cast("double").try_cast("bigint")
        return value.alias(name)

    single = F.array(F.struct(*[
        (F.coalesce(payload[n], payload["eventTimestamp"]) if n == "timestamp" else payload[n])
        .alias(n) for n in record]))
    records = F.coalesce(d["records"], F.when(payload.isNotNull(), single))
    known = {*record, *envelope}
    rests = F.when(d["records"].isNotNull(), F.transform(
        F.try_variant_get("variant", "$.records", "array<variant>"), lambda r: _rest(r, known))
        ).when(payload.isNotNull(), F.array(_rest(
            F.try_variant_get("variant", "$.rawPayload", "variant"), known)))
    items = F.arrays_zip(records.alias("record"),
                         F.coalesce(rests, F.array().cast(f"array<{_REST}>")).alias("rest"))
    lost = F.array(F.struct(F.lit(None).cast(schema["records"].dataType.elementType).alias("record"),
                            F.lit(None).cast(_REST).alias("rest")))
    # Beside an explode, what concerns the document would be worked out for each of its readings.
    whole = parsed.select(
        "path", "at", REASON, "text", *[of_envelope(n) for n in envelope],
        _rest(F.col("variant"), {*envelope, "records", "rawPayload"}).alias("outer"),
        F.when(F.col(REASON).isNotNull(), lost).otherwise(items).alias("items"))
    rows = whole.select(*[c for c in whole.columns if c != "items"],
                        F.posexplode("items").alias("n", "item"))
    inner = F.coalesce(F.col("item.rest"), F.create_map().cast(_REST))
    unknown = F.map_concat("outer", F.map_filter(
        inner, lambda name, _: ~F.array_contains(F.map_keys("outer"), name)))
    return with_event_date(rows.select(
        "path", REASON, "text", F.concat_ws("#", "path", "at", "n").alias(PLACE),
        F.when((F.size("outer") > 0) | (F.size("item.rest") > 0), unknown).alias(UNKNOWN), *envelope,
        *[typed(n, F.col("item.record")[n]).alias(n) for n in record if n not in envelope]))


def unknown_fields(rows: DataFrame, most: int = 1_000) -> dict[str, str]:
    """Name to VARIANT type, over all rows, of the fields in ``_unknown``. A field that is null wherever
    it occurs is none. Of more than ``most`` names, a sign of names that are data, the first in order
    count; the next one is listed without a type, to say that there are more."""
    found = (rows.select(F.explode(UNKNOWN).alias("name", "value")).where(~F.is_variant_null("value"))
             .groupBy("name").agg(F.schema_of_variant_agg("value").alias("kind"))
             .orderBy("name").limit(most + 1))
    return {r["name"]: r["kind"] if k < most else "" for k, r in enumerate(found.collect())}


def _column_type(name: str, kind: str) -> str:
    if name in schemas.PAYLOAD_TEXT:
        return "string"
    if kind in ("BIGINT", "BOOLEAN"):
        return kind.lower()
    return "double" if kind.startswith(("DECIMAL", "DOUBLE", "FLOAT")) else "string"


def promote_unknown(rows: DataFrame, fields: Mapping[str, str],
                    recorded: Mapping[str, str] | None = None) -> DataFrame:
    """Turn the fields (name to VARIANT type) of ``_unknown`` into columns and drop the map.

    Whole numbers, other numbers and flags get their type, everything else is text, objects and lists
    as JSON. Where the table already has such a column (``recorded``: name to type) and the types are not
    both numbers, the table's is used. What cannot become a column - its name is that of another column
    once both are in snake case, or is no plain identifier, or its value does not fit the table's type -
    stays as JSON text in ``unknownFields``, which is added only where something may stay.
    """
    taken = {snake_case(c) for c in rows.columns}
    columns: dict[str, Column] = {}
    always: list[str] = [""]
    sometimes: dict[str, Column] = {}
    for name, kind in fields.items():
        if not kind or snake_case(name) in taken or not re.fullmatch(r"[A-Za-z]\w*", name, re.ASCII):
            continue
        taken.add(snake_case(name))
        own = wanted = _column_type(name, kind)
        held = (recorded or {}).get(name, own)
        if not {own, held} <= {"bigint", "double"}:
            wanted = held
        columns[name] = F.col(UNKNOWN)[name].try_cast(wanted)
        if wanted in (own, "string"):
            always.append(name)
        else:
            sometimes[name] = columns[name].isNotNull()
    out = rows
    if len(always) <= len(fields):
        def stays(name: Column, value: Column) -> Column:
            kept = [(name == n) & fits for n, fits in sometimes.items()]
            return ~F.is_variant_null(value) & ~reduce(or_, [name.isin(*always), *kept])

        left = F.map_filter(UNKNOWN, stays)
        out = out.withColumn(LEFT_OVER, F.when(F.size(left) > 0, F.to_json(left)))
    return out.withColumns(columns).drop(UNKNOWN)


def unreadable(rows: DataFrame) -> DataFrame:
    """Dead letters of documents: document_id (of path and text), path, text, reason."""
    return rows.where(F.col(REASON).isNotNull()).select(
        F.sha2(F.concat_ws("\n", "path", "text"), 256).alias("document_id"), "path", "text",
        F.col(REASON).alias("reason"))


def readings(rows: DataFrame) -> DataFrame:
    """Readings with the columns of the documents and ``_unknown``."""
    return rows.where(F.col(REASON).isNull()).drop("path", REASON, "text", PLACE)
