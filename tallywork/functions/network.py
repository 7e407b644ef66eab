"""IPv4 address arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywork.functions.text import java_split, typed


def ip_to_long(ip: Column, strict: bool = True) -> Column:
    """Fold dotted numbers into one long: `acc << 8 | part`, left to right.

    Octets are not range-checked. An address that is no list of numbers fails
    the job when strict, else gives null, whatever the session's ANSI setting is.
    """
    return F.element_at(F.transform(F.array(ip_parts(ip, strict)), parts_to_long), 1)


def ip_parts(ip: Column, strict: bool = True) -> Column:
    """The dotted numbers; dots at the end separate nothing."""
    return F.transform(java_split(ip, "."), lambda part: typed(part, "bigint", strict))


def parts_to_long(parts: Column) -> Column:
    """The fold over the numbers.

    A part that is i places from the end ends up shifted by 8 * i bits. From
    eight places on nothing of it is left in a long, so any number of parts
    comes down to the last eight. IPv4 addresses take the short form.
    """

    def shifted(place: int, part: Column) -> Column:
        return F.shiftleft(part, 8 * place)

    four = [shifted(3 - index, F.get(parts, F.lit(index))) for index in range(4)]
    last = F.size(parts) - 1
    eight = [F.when(last < place, F.lit(0).cast("bigint")).otherwise(shifted(place, F.get(parts, last - place)))
             for place in range(8)]
    return F.when(F.size(parts) == 4, reduce(Column.bitwiseOR, four)).otherwise(reduce(Column.bitwiseOR, eight))
