"""Request payloads, status classes and label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def error_class(status: Column | str) -> Column:
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status >= 500, F.lit("server_error")).when(status >= 400, F.lit("client_error"))


def parse_payload(text: Column | str, schema: T.StructType | str) -> Column:
    """JSON text to a struct; broken or missing text gives a struct of NULLs, and NaN is NULL."""
    text = F.col(text) if isinstance(text, str) else text
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})

    def fields(p: Column) -> Column:
        floats = (T.DoubleType, T.FloatType)
        parts = {f.name: p.getField(f.name) for f in schema}
        return F.struct(*[(F.when(~F.isnan(parts[f.name]), parts[f.name]) if isinstance(f.dataType, floats) else parts[f.name]).alias(f.name) for f in schema])

    # a list of one, so that the text is parsed once however many fields there are
    return F.transform(F.array(parsed), fields)[0]


def payload_field(text: Column | str, field: str) -> Column:
    """One field of a JSON payload as text. The path is quoted, so names with dots are safe."""
    text = F.col(text) if isinstance(text, str) else text
    return F.get_json_object(text, "$['" + field.replace("'", "\\'") + "']")


def bound_label(bound: float) -> str:
    """The ``le`` label text of a histogram bound."""
    return str(int(bound)) if float(bound).is_integer() else repr(float(bound))
