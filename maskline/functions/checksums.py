"""Check digits of public number formats, as SQL conditions.

`{}` stands for the value, which already has the shape of its detector.
"""

from __future__ import annotations

from maskline.functions import sql as Q

# Published weights of the Polish numbers.
PESEL_WEIGHTS = (1, 3, 7, 9, 1, 3, 7, 9, 1, 3)
NIP_WEIGHTS = (6, 5, 7, 2, 3, 4, 5, 6, 7)
REGON9_WEIGHTS = (8, 9, 2, 3, 4, 5, 6, 7)
REGON14_WEIGHTS = (2, 4, 8, 5, 0, 9, 7, 3, 6, 1, 2, 4, 8)
# "PL" spelled in digits, P = 25 and L = 21.
IBAN_COUNTRY_DIGITS = "2521"


def _number(test) -> str:
    """`test` of the value as a number, separators removed."""
    return Q.let("try_cast(translate({}, ' -', '') as bigint)", test)


def _digit(number: str, places: int, position: int) -> str:
    """The digit at `position` (from 1) of a number with that many places."""
    return f"({number} div {10 ** (places - position)}L % 10)"


def _weighted(number: str, places: int, weights: tuple[int, ...]) -> str:
    terms = (f"{w} * {_digit(number, places, i)}" for i, w in enumerate(weights, 1) if w)
    return f"({' + '.join(terms)})"


def _modulus(number: str, places: int, weights: tuple[int, ...], rest: str) -> str:
    """Weighted sum modulo 11 (and then `rest`) equals the digit after the weighted ones."""
    total = _weighted(number, places, weights)
    return f"{total} % 11{rest} = {_digit(number, places, len(weights) + 1)}"


PESEL = _number(
    lambda n: f"(10 - {_weighted(n, 11, PESEL_WEIGHTS)} % 10) % 10 = {_digit(n, 11, 11)}"
)
NIP = _number(lambda n: _modulus(n, 10, NIP_WEIGHTS, ""))
REGON = _number(
    lambda n: f"if(length({{}}) = 9, {_modulus(n, 9, REGON9_WEIGHTS, ' % 10')}, "
    f"{_modulus(n, 14, REGON9_WEIGHTS, ' % 10')} and {_modulus(n, 14, REGON14_WEIGHTS, ' % 10')})"
)
IBAN = Q.let(
    "translate({}, ' -', '')",
    lambda chars: f"try_cast(concat(substring({chars}, 5), '{IBAN_COUNTRY_DIGITS}', substring({chars}, 3, 2)) "
    "as decimal(38,0)) % 97 = 1",
)
LUHN = "luhn_check(translate({}, ' -', ''))"
