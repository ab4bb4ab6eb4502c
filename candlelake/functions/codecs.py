"""Payload codecs: JSON and Avro messages to typed structs and back.

The codec is the caller's choice. JSON needs nothing else; Avro needs Spark's own Avro module in the session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.schema import CANDLE_CONTRACT, contract_defaults, contract_fields, contract_schema, wire_schema

# A registry-framed payload starts with a zero byte and a 4-byte schema id.
HEADER_BYTES = 5
MAGIC_BYTE = "00"

# Fixed value: what a later version of a contract may read a field as.
PROMOTED = (("long", "double"),)


def strip_header(value: Column | str, check_magic: bool = False) -> Column:
    """Payload after the registry header; with ``check_magic`` NULL unless the first byte is 0."""
    value = F.col(value) if isinstance(value, str) else value
    body = F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)
    if not check_magic:
        return body
    framed = (F.length(value) >= HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == MAGIC_BYTE)
    return F.when(framed, body)


def add_header(payload: Column, schema_id: int) -> Column:
    return F.concat(F.unhex(F.lit(f"{MAGIC_BYTE}{schema_id:08X}")), payload)


def _complete(record: Column, contract: str) -> Column:
    """Whether every required field is there.

    A permissive decoder answers garbage with a struct of NULLs, which is not itself NULL.
    """
    complete = record.isNotNull()
    for name, _, nullable in contract_fields(contract):
        if not nullable:
            complete = complete & record[name].isNotNull()
    return complete


def decode_json(payload: Column, contract: str = CANDLE_CONTRACT, strict: bool = False) -> Column:
    """JSON message to its wire struct, times being epoch milliseconds.

    Spark's parser reads the first value of a text and passes over what follows. With ``strict`` such a message is
    NULL: the text must also be whole as the only item of an array, which nothing but a closing bracket may follow,
    and as a field of an object, which nothing but a closing brace may.
    """
    return _parsed_json(payload, wire_schema(contract), strict)


def _parsed_json(payload: Column, schema: T.StructType, strict: bool) -> Column:
    text = payload.cast("string")
    if not strict:
        return F.from_json(text, schema, {"mode": "PERMISSIVE"})
    items = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    field = F.from_json(F.concat(F.lit('{"message":'), text, F.lit("}")), "message string")["message"]
    return F.when((F.size(items) == 1) & field.isNotNull(), F.get(items, 0))


def wire_to_record(wire: Column, contract: str = CANDLE_CONTRACT) -> Column:
    fields = []
    for name, kind, _ in contract_fields(contract):
        field = wire[name]
        fields.append((F.timestamp_millis(field) if kind == "timestamp-millis" else field).alias(name))
    return F.struct(*fields)


def decode_avro(payload: Column, contract: str = CANDLE_CONTRACT) -> Column:
    """Schemaless Avro message to the contract struct; an error where the session lacks Spark's Avro module."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, contract, {"mode": "PERMISSIVE"})


def decode_payload(
    frame: DataFrame,
    contract: str = CANDLE_CONTRACT,
    *,
    value_column: str = "value",
    output_column: str = "data",
    confluent_header: bool = False,
    codec: str = "json",
    strict: bool = False,
) -> DataFrame:
    """Add the decoded record, NULL where the payload is not a complete one.

    ``strict`` also refuses a message that something else follows; Spark's Avro decoder cannot tell, so it is an
    error there.
    """
    payload = strip_header(value_column) if confluent_header else F.col(value_column)
    if codec == "json":
        wire, convert = decode_json(payload, contract, strict), wire_to_record
    elif codec == "avro" and not strict:
        wire, convert = decode_avro(payload, contract), lambda record, _: record
    elif codec == "avro":
        raise ValueError("strict decoding is offered for JSON only")
    else:
        raise ValueError(f"unknown codec: {codec}")
    # As the output of a generator the decoded struct is computed once per row. As a plain column it would
    # be decoded again in every filter on its fields, which the optimizer moves below the decoding.
    wired = frame.withColumn("_wire", wire).select(
        *[name for name in frame.columns if name != output_column],
        F.explode_outer(F.array("_wire")).alias(output_column),
    )
    decoded = F.col(output_column)
    return wired.withColumn(output_column, F.when(_complete(decoded, contract), convert(decoded, contract)))


def schema_id(value: Column | str) -> Column:
    """The id of the writer's contract in the registry header; NULL where there is no such header."""
    value = F.col(value) if isinstance(value, str) else value
    framed = (F.length(value) >= HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == MAGIC_BYTE)
    return F.when(framed, F.conv(F.hex(F.substring(value, 2, HEADER_BYTES - 1)), 16, 10).cast("bigint"))


def _resolved(wire: Column, writer: str, reader: str) -> Column:
    """A writer's record as the reader's contract has it, NULL where a required field is missing.

    Fields are matched by name; one that the writer did not know takes the reader's default.
    """
    written = {name: (kind, nullable) for name, kind, nullable in contract_fields(writer)}
    defaults, fields = contract_defaults(reader), []
    for name, kind, nullable in contract_fields(reader):
        to = wire_schema(reader)[name].dataType
        if name in written:
            if written[name][0] != kind and (written[name][0], kind) not in PROMOTED:
                raise ValueError(f"contract field {name} changes from {written[name][0]} to {kind}")
            field = wire[name].cast(to)
        elif name in defaults:
            field = F.lit(defaults[name]).cast(to)
        elif nullable:
            field = F.lit(None).cast(to)
        else:
            raise ValueError(f"contract field {name} is required, has no default, and an earlier version does not have it")
        fields.append((F.timestamp_millis(field) if kind == "timestamp-millis" else field).alias(name))
    record = F.struct(*fields)
    complete = wire.isNotNull()
    for name, (_, nullable) in written.items():
        if not nullable:
            complete = complete & wire[name].isNotNull()
    return F.when(complete, record)


def decode_versions(
    frame: DataFrame,
    versions: Mapping[int, str],
    contract: str = CANDLE_CONTRACT,
    *,
    value_column: str = "value",
    output_column: str = "data",
    strict: bool = False,
) -> DataFrame:
    """Add the decoded record of JSON messages that several versions of a contract have written.

    The id in a message's header picks the contract it was written with (``versions``), and its record is resolved to the
    reader's ``contract``: fields added since are their default, or NULL where they may be, and dropped ones are passed over. A
    whole number may have become a double. Versions that cannot be resolved are an error here; a message of an unknown id,
    or without a header, has a NULL record and so goes to the rejects with its envelope. Messages are parsed once, by a
    schema that has the fields of all versions.
    """
    known: dict[str, T.DataType] = {}
    for writer in versions.values():
        for field in wire_schema(writer):
            kind = known.setdefault(field.name, field.dataType)
            # Where versions differ the wider type reads both.
            known[field.name] = kind if kind == field.dataType else T.DoubleType()
    every = T.StructType([T.StructField(name, kind) for name, kind in known.items()])
    wire, version = _parsed_json(strip_header(value_column), every, strict), schema_id(value_column)
    names = [name for name in frame.columns if name != output_column]
    wired = frame.withColumns({"_wire": wire, "_version": version}).select(*names, "_version", F.explode_outer(F.array("_wire")).alias("_wire"))
    data = F.lit(None).cast(contract_schema(contract))
    for number, writer in versions.items():
        data = F.when(F.col("_version") == number, _resolved(F.col("_wire"), writer, contract)).otherwise(data)
    return wired.select(*names, data.alias(output_column))


def encode_payload(
    frame: DataFrame,
    contract: str = CANDLE_CONTRACT,
    *,
    output_column: str = "value",
    codec: str = "json",
    schema_id: int | None = None,
) -> DataFrame:
    """Add the encoded record of the contract columns, with a registry header if ``schema_id`` is given."""
    fields = contract_fields(contract)
    if codec == "json":
        columns = [
            (F.unix_millis(name) if kind == "timestamp-millis" else F.col(name)).alias(name)
            for name, kind, _ in fields
        ]
        payload = F.encode(F.to_json(F.struct(*columns)), "UTF-8")
    elif codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        payload = to_avro(F.struct(*[F.col(name) for name, _, _ in fields]), contract)
    else:
        raise ValueError(f"unknown codec: {codec}")
    encoded = frame.withColumn(output_column, payload)
    if schema_id is None:
        return encoded
    return encoded.withColumn(output_column, add_header(F.col(output_column), schema_id))
