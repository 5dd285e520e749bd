"""Building blocks for SQL expressions with lambdas.

The span expressions are long. As SQL text they reach Spark in one call; built
from Column objects they would take thousands of round trips to the JVM.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable

_numbers = itertools.count(1)

# A fold that appends to an array copies it on every step. Folding blocks of
# 2**BLOCK_BITS items and then the block totals keeps long arrays affordable.
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS


def text(value: str) -> str:
    """A string literal, whatever the session's escaping rules."""
    if all(c.isalnum() and c.isascii() or c in " _.-[]()" for c in value):
        return f"'{value}'"
    return f"cast(X'{value.encode().hex()}' as string)"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def fresh() -> str:
    return f"v{next(_numbers)}"


def each(fn: str, items: str, body: Callable[..., str], *, arity: int = 1) -> str:
    """`fn(items, (x, ...) -> body)` with variables no enclosing lambda uses."""
    names = [fresh() for _ in range(arity)]
    variables = names[0] if arity == 1 else f"({', '.join(names)})"
    return f"{fn}({items}, {variables} -> {body(*names)})"


def transform(items: str, body: Callable[[str], str]) -> str:
    return each("transform", items, body)


def transform_indexed(items: str, body: Callable[[str, str], str]) -> str:
    return each("transform", items, body, arity=2)


def keep(items: str, test: Callable[[str], str]) -> str:
    return each("filter", items, test)


def exists(items: str, test: Callable[[str], str]) -> str:
    return each("exists", items, test)


def zip_with(a: str, b: str, body: Callable[[str, str], str]) -> str:
    return each("zip_with", f"{a}, {b}", body, arity=2)


def aggregate(items: str, start: str, step: Callable[[str, str], str]) -> str:
    return each("aggregate", f"{items}, {start}", step, arity=2)


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate `value` once and use it several times in `body`."""
    return f"get({transform(f'array({value})', body)}, 0)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def array(items: Iterable[str]) -> str:
    return f"array({', '.join(items)})"


def last(items: str) -> str:
    return f"get({items}, size({items}) - 1)"


def _fold(items: str, merge: Callable[[str, str], str]) -> str:
    return aggregate(
        items,
        "cast(array() as array<int>)",
        lambda acc, x: f"array_append({acc}, if(size({acc}) = 0, {x}, {merge(last(acc), x)}))",
    )


def running(items: str, merge: Callable[[str, str], str]) -> str:
    """Inclusive running `merge` (a sum, a maximum) of an int array."""

    def long(xs: str) -> str:
        blocks = transform(
            f"sequence(0, shiftright(size({xs}) - 1, {BLOCK_BITS}))",
            lambda b: _fold(f"slice({xs}, shiftleft({b}, {BLOCK_BITS}) + 1, {BLOCK})", merge),
        )
        return let(
            blocks,
            lambda inner: let(
                _fold(transform(inner, last), merge),
                lambda totals: "flatten("
                + transform_indexed(
                    inner,
                    lambda block, b: f"if({b} = 0, {block}, "
                    + transform(block, lambda x: merge(f"get({totals}, {b} - 1)", x))
                    + ")",
                )
                + ")",
            ),
        )

    return let(items, lambda xs: f"if(size({xs}) <= {BLOCK}, {_fold(xs, merge)}, {long(xs)})")
