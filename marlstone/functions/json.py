"""JSON text in a string column, read as VARIANT.

A payload is parsed once into a VARIANT column; every path is then read from
that column. Scalar reads return NULL for objects and arrays, as well as for
missing fields and JSON nulls.

Reads over a whole bronze table that need a few top-level fields use
`top_level` and `top_level_scalar` instead: same results, but the reader skips
over the other fields rather than building the whole document.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_payload(payload: Column | str, strict: bool = True) -> Column:
    """VARIANT of a JSON text. Malformed text fails, or is NULL when not strict."""
    return F.parse_json(payload) if strict else F.try_parse_json(payload)


def is_malformed(payload: Column | str) -> Column:
    """True where a non-NULL text is not valid JSON."""
    text = F.col(payload) if isinstance(payload, str) else payload
    return text.isNotNull() & F.try_parse_json(text).isNull()


def json_scalar(document: str, path: str) -> Column:
    """Text of the scalar at `path`; NULL where the node is an object or array.

    The node's own type decides, so a string that merely begins with a brace is
    still returned. `document` is a VARIANT column or expression in SQL.
    """
    return F.expr(_scalar_sql(document, path))


def with_scalars(df: DataFrame, document: str, paths: dict[str, str]) -> DataFrame:
    """Add many json_scalar reads of one document, each path looked up once.

    Texts are taken first, with nested nodes as JSON text, and checked in a
    projection of their own: only a text that may be a nested node needs the
    node's type.
    """
    texts = [f"variant_get({document}, '{p}', 'string') AS {c}" for c, p in paths.items()]
    checked = [f"{_unless_nested(c, document, p)} AS {c}" for c, p in paths.items()]
    return df.selectExpr("*", *texts).selectExpr(*df.columns, *checked)


def _scalar_sql(document: str, path: str) -> str:
    node = f"variant_get({document}, '{path}', 'variant')"
    return (
        f"CASE WHEN left(schema_of_variant({node}), 5) NOT IN ('OBJEC', 'ARRAY') "
        f"THEN CAST({node} AS STRING) END"
    )


def _unless_nested(text: str, document: str, path: str) -> str:
    return (
        f"CASE WHEN left({text}, 1) IN ('{{', '[') "
        f"THEN {_scalar_sql(document, path)} ELSE {text} END"
    )


def top_level(payload: Column | str, names: list[str], strict: bool = True) -> Column:
    """Struct of the named top-level fields as text, nested nodes as JSON text.

    Malformed text fails, or gives NULL fields when not strict.
    """
    fields = ", ".join(f"`{name}` STRING" for name in names)
    return F.from_json(payload, fields, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def top_level_scalar(fields: str, payload: str, name: str) -> Column:
    """One field of a `top_level` struct, read as json_scalar would.

    Only a text that may be a nested node needs the document's own word on it.
    """
    document = f"try_parse_json({payload})"
    return F.expr(_unless_nested(f"{fields}.{name}", document, f"$.{name}"))


def as_bigint(text: Column | str, strict: bool = True) -> Column:
    """BIGINT of a scalar's text: `7.0` was read as 7, `7.5` is malformed."""
    return _typed(text, "bigint", strict)


def as_double(text: Column | str, strict: bool = True) -> Column:
    return _typed(text, "double", strict)


def json_pairs(document: Column | str, path: str, strict: bool = True) -> Column:
    """Array of number pairs at `path`. NULL elements stay, numeric text is read."""
    get = F.variant_get if strict else F.try_variant_get
    return get(document, path, "array<array<double>>")


def _typed(text: Column | str, kind: str, strict: bool) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return text.cast(kind) if strict else text.try_cast(kind)
