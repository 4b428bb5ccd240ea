"""Column and SQL expressions.

Long column lists are built as SQL text and parsed in one call: a Python call
per operator costs more than the query itself on small inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwright.schemas import MONEY, TOTAL

ZERO = "CAST(0 AS DECIMAL(19,4))"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def total(amount: str) -> Column:
    """Sum of a money expression at full width."""
    return F.expr(f"CAST(sum({amount}) AS {TOTAL.simpleString()})")


def total_or_zero(amount: str) -> Column:
    return F.expr(f"CAST(coalesce(sum({amount}), 0) AS {TOTAL.simpleString()})")


def rows() -> Column:
    return F.expr("count(1)")


def stamp(now: str) -> str:
    return f"CAST('{now}' AS TIMESTAMP_NTZ)"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scramble(*keys: str, salt: int = 0) -> str:
    """A repeatable number in 0..2147483646 from integer columns.

    Plain modular arithmetic, so any SQL engine gives the same value. Each
    step stays far below 2**63.
    """
    state = f"CAST({salt} AS BIGINT)"
    for key in keys:
        state = f"(({state} * 48271 + pmod({key}, 2147483647) * 69621 + 12345) % 2147483647)"
    return f"({state} * 16807 % 2147483647)"


def scramble_wide(*keys: str, salt: int = 0) -> str:
    """A repeatable number below 2**62 from two draws, for ranges beyond one."""
    return f"({scramble(*keys, salt=salt)} * 2147483647 + {scramble(*keys, salt=salt + 100)})"


def key_id(*parts: str) -> str:
    """A whole number of 120 bits from the given expressions, the same in every run."""
    text = f"md5(CAST(concat_ws('/', {', '.join(parts)}) AS BINARY))"
    half = "CAST(conv(substr({}, {}, 15), 16, 10) AS DECIMAL(19,0))".format
    return f"CAST({half(text, 1)} * 1152921504606846976BD + {half(text, 16)} AS DECIMAL(38,0))"
