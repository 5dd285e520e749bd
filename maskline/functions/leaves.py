"""String leaves of nested columns: list them, and rebuild the value around new ones.

Typed columns are walked by their schema. JSON of any shape, as a string or a VARIANT,
is walked by its string literals: keys, numbers, order and white space stay as they
are, and so does every literal that is not changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import types as T

from maskline.functions import sql as Q

LEAVES_TYPE = "array<struct<path:string,text:string>>"
NO_LEAVES = f"cast(array() as {LEAVES_TYPE})"
# A JSON string, with its colon if it is a key. Possessive, so that Java neither
# backtracks nor recurses on long strings.
LITERAL = r'(?s)"(?:[^"\\]++|\\.)*+"(?:\s*+:)?+'
# Put around literals; JSON does not allow this character in a text.
MARK = "\x01"


class JsonText(T.DataType):
    """A string column that holds JSON, one value per row."""


def has_text(kind: T.DataType) -> bool:
    if isinstance(kind, (T.StringType, T.VariantType, JsonText)):
        return True
    if isinstance(kind, T.StructType):
        return any(has_text(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return has_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return has_text(kind.valueType)
    return False


def _step(path: str, index: str | int) -> str:
    return f"concat({path}, '.', string({index}))"


def is_json(value: str) -> str:
    """Whether a text is one JSON value and nothing behind it; keys must not be repeated."""
    # the parser stops after a value, so what follows shows inside brackets only
    whole = f"concat('[', {value}, ']')"
    return f"(try_parse_json({whole}) is not null and json_array_length({whole}) = 1)"


def _json(value: str, kind: T.DataType) -> str:
    """The JSON text of a column; text that is no JSON is an error, as is a repeated key."""
    if isinstance(kind, T.VariantType):
        return f"to_json({value})"
    wrong = "raise_error('malformed JSON in a column of payloads')"
    return f"if({value} is null or {is_json(value)}, {value}, {wrong})"


def _literals(json: str) -> str:
    """What stands between the strings of a JSON text, and the strings, in turn."""
    return f"split(regexp_replace({json}, {Q.text(LITERAL)}, {Q.text(MARK + '$0' + MARK)}), {Q.text(MARK)}, -1)"


def _said(literal: str) -> str:
    """The text of a JSON string that is no key."""
    plain = f"substring({literal}, 2, length({literal}) - 2)"
    read = f"get(from_json(concat('[', {literal}, ']'), 'array<string>'), 0)"
    return f"if(contains({literal}, {Q.text(chr(92))}), {read}, {plain})"


def _is_value(literal: str) -> str:
    return f"(endswith({literal}, {Q.text(chr(34))}) and length({literal}) > 2)"


def _json_leaves(json: str, path: str) -> str:
    def listed(parts: str) -> str:
        values = Q.keep(f"sequence(1, size({parts}) - 2, 2)", lambda i: _is_value(f"get({parts}, {i})"))
        named = Q.transform(values, lambda i: Q.struct(path=_step(path, i), text=_said(f"get({parts}, {i})")))
        return f"if(size({parts}) < 3, {NO_LEAVES}, {named})"

    return f"coalesce({Q.let(_literals(json), listed)}, {NO_LEAVES})"


def _json_rebuilt(json: str, path: str, new_text: Callable[[str, str], str]) -> str:
    def written(literal: str, i: str) -> str:
        quoted = lambda new: Q.let(f"to_json(array({new}))", lambda j: f"substring({j}, 2, length({j}) - 2)")
        changed = Q.let(
            _said(literal),
            lambda old: Q.let(
                new_text(old, _step(path, i)), lambda new: f"if({new} = {old}, {literal}, {quoted(new)})"
            ),
        )
        return f"if({i} % 2 = 1 and {_is_value(literal)}, {changed}, {literal})"

    return f"array_join({Q.transform_indexed(_literals(json), written)}, '')"


def leaves(value: str, kind: T.DataType, path: str) -> str:
    """array<struct<path,text>> of all non-empty strings; keys of maps and objects are not leaves."""
    if not has_text(kind):
        return NO_LEAVES
    if isinstance(kind, (JsonText, T.VariantType)):
        return Q.let(_json(value, kind), lambda json: _json_leaves(json, path))
    if isinstance(kind, T.StringType):
        return f"if({value} != '', array({Q.struct(path=path, text=value)}), {NO_LEAVES})"
    if isinstance(kind, T.StructType):
        parts = [
            leaves(f"{value}.{Q.name(f.name)}", f.dataType, _step(path, i))
            for i, f in enumerate(kind.fields)
            if has_text(f.dataType)
        ]
        return f"concat({', '.join([NO_LEAVES, *parts])})"
    if isinstance(kind, T.ArrayType):
        inner = Q.transform_indexed(
            value, lambda x, i: leaves(x, kind.elementType, _step(path, i))
        )
    else:
        inner = Q.transform_indexed(
            f"map_entries({value})",
            lambda e, i: leaves(f"{e}.value", kind.valueType, _step(path, i)),
        )
    return f"coalesce(flatten({inner}), {NO_LEAVES})"


def rebuilt(
    value: str, kind: T.DataType, path: str, new_text: Callable[[str, str], str]
) -> str:
    """The same value with every string leaf replaced by `new_text(text, path)`."""
    if not has_text(kind):
        return value
    if isinstance(kind, T.StringType):
        return new_text(value, path)
    if isinstance(kind, JsonText):
        return f"if({value} is null, null, {_json_rebuilt(value, path, new_text)})"
    if isinstance(kind, T.VariantType):
        return Q.let(
            f"to_json({value})",
            lambda old: Q.let(
                _json_rebuilt(old, path, new_text),
                lambda new: f"if({old} is null or {new} = {old}, {value}, parse_json({new}))",
            ),
        )
    if isinstance(kind, T.StructType):
        fields = ", ".join(
            f"{Q.text(f.name)}, "
            + rebuilt(f"{value}.{Q.name(f.name)}", f.dataType, _step(path, i), new_text)
            for i, f in enumerate(kind.fields)
        )
        return f"if({value} is null, null, named_struct({fields}))"
    if isinstance(kind, T.ArrayType):
        return Q.transform_indexed(
            value, lambda x, i: rebuilt(x, kind.elementType, _step(path, i), new_text)
        )
    entries = Q.transform_indexed(
        f"map_entries({value})",
        lambda e, i: Q.struct(
            key=f"{e}.key",
            value=rebuilt(f"{e}.value", kind.valueType, _step(path, i), new_text),
        ),
    )
    return f"map_from_entries({entries})"
