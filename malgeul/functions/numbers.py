"""Reading numbers in Korean, as columns.  Words are joined by ``SPACE``, a mark that later becomes a space."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from malgeul.functions.textexpr import let

SPACE = "␣"
# The words of the number systems.
DIGITS = "영일이삼사오육칠팔구"
NATIVE_ONES = ["", "한", "두", "세", "네", "다섯", "여섯", "일곱", "여덟", "아홉"]
NATIVE_TENS = ["", "열", "스물", "서른", "마흔", "쉰", "예순", "일흔", "여든", "아흔"]
GROUPS = [(16, "경"), (12, "조"), (8, "억"), (4, "만"), (0, "")]


def _pick(words, at: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), at.cast("int"))


def _join(*parts: Column) -> Column:
    return F.concat_ws(SPACE, *parts)


def _place(count: Column, name: str) -> Column:
    """A count of thousands or hundreds; 1 is silent, none is left out."""
    return F.when(count == 1, F.lit(name)).when(count > 1, F.concat(_pick(DIGITS, count), F.lit(name)))


def sino_under_100(n: Column) -> Column:
    tens, ones = F.floor(n / 10), n % 10
    lead = F.when(tens == 1, F.lit("십")).when(tens > 1, F.concat(_pick(DIGITS, tens), F.lit("십")))
    return F.when(n == 0, "영").otherwise(_join(lead, F.when(ones > 0, _pick(DIGITS, ones))))


def sino_under_10000(n: Column) -> Column:
    rest = n % 100
    return F.when(n == 0, "영").otherwise(_join(_place(F.floor(n / 1000), "천"), _place(F.floor(n / 100) % 10, "백"), F.when(rest > 0, sino_under_100(rest))))


def read_sino(n: Column) -> Column:
    """Any whole number below 10^20 in size; others give null."""

    def group(q: Column, name: str) -> Column:
        said = lambda v: F.when(v > 0, _join(sino_under_10000(v), F.lit(name)) if name else sino_under_10000(v))
        return let(q.cast("int"), said)

    def positive(x: Column) -> Column:
        # but for the first group, in long arithmetic
        low = [group(F.call_function("div", x["low"], F.lit(10**zeros)) % 10000, name) for zeros, name in GROUPS[1:]]
        return F.when((x["high"] == 0) & (x["low"] == 0), "영").otherwise(_join(group(x["high"], GROUPS[0][1]), *low))

    unit, limit = (F.lit(str(v)).cast("decimal(38,0)") for v in (10 ** GROUPS[0][0], 10 ** (GROUPS[0][0] + 4)))
    parts = lambda v: F.struct(((v - v % unit) / unit).cast("long").alias("high"), (v % unit).cast("long").alias("low"))
    read = lambda v: F.concat(F.when(v < 0, "마이너스" + SPACE).otherwise(""), let(parts(F.abs(v)), positive))
    return let(n.cast("decimal(38,0)"), lambda v: F.when(F.abs(v) < limit, read(v)))


def read_number(n: Column, native: Callable[[Column], Column]) -> Column:
    """1 to 99 in native words where ``native`` of the number holds, all others as ``read_sino``."""
    small = lambda v: _join(F.nullif(_pick(NATIVE_TENS, F.floor(v / 10)), F.lit("")), F.nullif(_pick(NATIVE_ONES, v % 10), F.lit("")))
    return let(n.cast("decimal(38,0)"), lambda v: F.when(native(v) & (v > 0) & (v < 100), small(v.cast("int"))).otherwise(read_sino(v)))


def read_native(n: Column) -> Column:
    """1 to 99 in native words, all others as ``read_sino``."""
    return read_number(n, lambda v: F.lit(True))


def read_hour(n: Column) -> Column:
    return read_number(n, lambda v: v <= 12)


def read_each_digit(text: Column) -> Column:
    said = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: _pick(DIGITS, c.try_cast("int")))
    return F.array_join(said, SPACE)


def number_of(text: Column) -> Column:
    """The number that digits with commas stand for; null beyond 38 digits."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("decimal(38,0)")
