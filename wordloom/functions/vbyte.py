"""Variable-byte code: 7 bits per byte, low group first, high bit set on all but the last byte."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_GROUPS = 9  # 7-bit groups of a non-negative BIGINT


def vbyte_hex(number: Column) -> Column:
    """Upper-case hex of the code."""
    return F.concat(*[
        _group_hex(number, i) if i == 0 else F.when(number >= _floor(i), _group_hex(number, i)).otherwise("")
        for i in range(_GROUPS)
    ])


def vbyte_length(number: Column) -> Column:
    """Bytes of the code."""
    length = F.lit(1)
    for i in range(1, _GROUPS):
        length = length + (number >= _floor(i)).cast("int")
    return length


def _floor(group: int) -> Column:
    """Least number that has this 7-bit group."""
    return F.lit(1 << (7 * group)).cast("long")


def _group_hex(number: Column, group: int) -> Column:
    value = F.shiftright(number, 7 * group).bitwiseAND(F.lit(127).cast("long"))
    if group + 1 < _GROUPS:
        value = F.when(number >= _floor(group + 1), value + 128).otherwise(value)
    return F.lpad(F.hex(value), 2, "0")
