"""Risky spans of a transcript: addresses (U1), Latin text (E2) and numbers (N3), in this order of precedence.

Spans are found by Arrow functions: nested column expressions for seven patterns whose matches keep each other
out take some hundred times as long.  Runs of letters and digits come from arrays over the bytes of many texts at once; only texts with an
address, with Hangul or with digits that aren't ASCII are searched by pattern.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from malgeul import schemas
from malgeul.functions.textexpr import U

# Patterns and word lists of the span rules.
DIGIT_RUN = rf"{U}\d[\d,.\-]*\d|\d"
HANGUL_NUMERALS = "[일이삼사오육칠팔구십백천만억조영공빵]+"
NUMBER_SUFFIXES = "개 명 원 년 월 일 시 분 초 번 회 차 층 호 반 등 위 살 세 대 배 퍼센트 % 킬로 미터 센티 그램 리터 을 를 이 가 은 는 의 에 와 과".split()
NUMBER_PREFIXES = "인증번호 비밀번호 코드 OTP 일회용 계좌번호 주민번호 학번 사번 전화번호 핀번호 PIN 패스워드 암호 번호 카드번호 주문번호 예약번호 등록번호".split()
LATIN = "[A-Za-z]{2,}"
ALPHANUMERIC = rf"{U}[A-Za-z]+\d+[A-Za-z\d]*|\d+[A-Za-z]+[A-Za-z\d]*"
ADDRESS = rf"{U}https?://[^\s]+|www\.[^\s]+|[a-zA-Z0-9][-a-zA-Z0-9]*\.(?:com|net|org|kr|co\.kr|go\.kr|or\.kr|io|ai|xyz)"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
SPOKEN_ADDRESS = rf"{U}(?:더블유\s*){{2,3}}|쓰리\s*더블유|닷\s*컴|점\s*컴|닷컴|닷\s*넷|점\s*넷|닷\s*오알지|닷\s*오아르지|닷\s*케이알|닷\s*코\s*케이알|닷\s*아이오|닷\s*에이아이|슬래시\s*슬래시|에이치티티피|에이치티티피에스"
CONTEXT = 40
SUFFIX_WINDOW, PREFIX_WINDOW = 5, 20


def left_context(text: Column, start: Column, size: int) -> Column:
    first = F.greatest(start - size, F.lit(0))
    return F.substr(text, first + 1, start - first)


def right_context(text: Column, end: Column, size: int) -> Column:
    return F.substr(text, end + 1, F.lit(size))


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern.removeprefix(U))


def _counted(text: str, start: int, end: int) -> bool:
    """Whether a run of numerals has a counter after it or a keyword before it."""
    if end - start < 2:
        return False
    return text.startswith(tuple(NUMBER_SUFFIXES), end, end + SUFFIX_WINDOW) or any(w in text[max(0, start - PREFIX_WINDOW) : start] for w in NUMBER_PREFIXES)


#: Tag, pattern, a test that texts without matches mostly fail, and a test of matches; the first rules have precedence.
_RULES: list[tuple[str, re.Pattern, Callable[[str], bool], Callable[[str, int, int], bool] | None]] = [
    ("U1", _compiled(ADDRESS), lambda t: "." in t or "://" in t, None),
    ("U1", _compiled(EMAIL), lambda t: "@" in t, None),
    ("U1", _compiled(SPOKEN_ADDRESS), lambda t: not t.isascii(), None),
    ("E2", _compiled(ALPHANUMERIC), lambda t: True, None),
    ("E2", _compiled(LATIN), lambda t: True, None),
    ("N3", _compiled(DIGIT_RUN), lambda t: True, None),
    ("N3", _compiled(HANGUL_NUMERALS), lambda t: not t.isascii(), _counted),
]


def _taken(text: str, rules: list) -> list[tuple[int, int, str]]:
    taken: list[tuple[int, int, str]] = []
    for tag, pattern, worth, fits in rules:
        if not worth(text):
            continue
        new, i = [], 0
        for match in pattern.finditer(text):
            start, end = match.span()
            while i < len(taken) and taken[i][1] <= start:
                i += 1
            if (i == len(taken) or taken[i][0] >= end) and (fits is None or fits(text, start, end)):
                new.append((start, end, tag))
        if new:
            taken = sorted(taken + new)
    return taken


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, tag) by start: the matches of each rule that overlap none of the rules before it."""
    return _taken(text, _RULES)


# ---- many texts at once ----


def _bytes(wanted: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in wanted]] = True
    return table


_LETTER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT = _bytes("0123456789")
_RUN = _DIGIT | _bytes(",.-")
#: First bytes of characters among which there are Hangul or digits (D8 to DF, E0, E1, EA and above): texts that are searched by pattern.
_OTHER = np.zeros(256, bool)
_OTHER[0xD8:0xE2] = _OTHER[0xEA:] = True
#: What every address or e-mail has.
_HINT = re.compile(rb"://|@|www\.|\.(?:com|net|org|kr|co\.kr|go\.kr|or\.kr|io|ai|xyz)")
_TAGS = ("U1", "E2", "N3")
#: Bytes of text that are searched at once; their contexts take some hundred times that for a moment.
CHUNK = 1 << 18


@dataclass
class Found:
    """Spans of a chunk of texts by place: row, tag (of ``_TAGS``), half-open places in code points and in ``data``."""

    row: np.ndarray
    tag: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    seen: np.ndarray  # code points before each byte
    at: np.ndarray  # the byte of each code point

    def slices(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """Texts of slices of the data, which may overlap."""
        size = last - first
        stops = np.concatenate([[0], np.cumsum(size)])
        picked = self.data[np.arange(stops[-1]) + np.repeat(first - stops[:-1], size)]
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(picked))

    def lists(self, values: pa.Array) -> pa.Array:
        """``values`` of all spans as a list for each row."""
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(self.row, np.arange(len(self.bounds))).astype(np.int32)), values)

    def contexts(self, context: int) -> tuple[pa.Array, pa.Array]:
        low, high = self.seen[self.bounds[self.row]], self.seen[self.bounds[self.row + 1]]
        left = self.at[np.maximum(low, self.seen[self.first] - context)]
        right = self.at[np.minimum(high, self.seen[self.last] + context)]
        return self.slices(left, self.first), self.slices(self.last, right)

    def gaps(self) -> tuple[pa.Array, pa.Array]:
        """What is between each span and the one before it, and after the last span of each row."""
        new = np.ones(len(self.row), bool)
        new[1:] = self.row[1:] != self.row[:-1]
        before = np.where(new, self.bounds[self.row], np.concatenate([[0], self.last[:-1]]) if len(self.row) else self.last)
        after = self.bounds[:-1].copy()
        ends = np.ones(len(self.row), bool)
        ends[:-1] = new[1:]
        after[self.row[ends]] = self.last[ends]
        return self.slices(before, self.first), self.slices(after, self.bounds[1:])


def _runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of runs that cross no bound."""
    before, after = np.zeros_like(mask), np.zeros_like(mask)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    before[bounds[bounds < len(mask)]] = False
    after[bounds[bounds > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def _apart(first: np.ndarray, last: np.ndarray, taken: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether slices overlap none of the ``taken``, which are in order and apart."""
    if not len(taken[0]):
        return np.ones(len(first), bool)
    i = np.searchsorted(taken[1], first, "right")
    return (i == len(taken[0])) | (taken[0][np.minimum(i, len(taken[0]) - 1)] >= last)


def _found(texts: pa.Array) -> Found:
    """The spans of all texts, nulls as empty; equal to ``spans_of`` of each."""
    texts = texts.cast(pa.string()).fill_null("")
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]] if buffers[2] else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    heads = (data & 0xC0) != 0x80
    seen = np.concatenate([[0], np.cumsum(heads)])
    at = np.append(np.flatnonzero(heads), len(data))
    row_of = lambda places: np.searchsorted(bounds, places, "right") - 1
    by_pattern = np.unique(row_of(np.flatnonzero(_OTHER[data])))
    hinted = np.setdiff1d(np.unique(row_of(np.fromiter((m.start() for m in _HINT.finditer(data)), np.int64))), by_pattern)
    plain, own, hints = data, [], []
    if len(by_pattern):
        plain = data.copy()
    for rows, rules, out in ((by_pattern, _RULES, own), (hinted, _RULES[:2], hints)):
        for r in rows.tolist():
            low = seen[bounds[r]]
            if rules is _RULES:
                plain[bounds[r] : bounds[r + 1]] = 32
            out += [(at[low + start], at[low + end], _TAGS.index(tag)) for start, end, tag in _taken(texts[r].as_py(), rules)]
    own += hints
    address = tuple(np.array([x[i] for x in hints], np.int64) for i in (0, 1))

    letter, digit = _LETTER[plain], _DIGIT[plain]
    first, last = _runs(letter | digit, bounds)
    letters = np.concatenate([[0], np.cumsum(letter)])
    count = letters[last] - letters[first]
    mixed = (count > 0) & (count < last - first)
    mixed[mixed] = _apart(first[mixed], last[mixed], address)
    both = first[mixed], last[mixed]
    first, last = _runs(letter, bounds)
    fits = last - first > 1
    first, last = first[fits], last[fits]
    fits = _apart(first, last, address) & _apart(first, last, both)
    latin = first[fits], last[fits]
    first, last = _runs(_RUN[plain], bounds)
    digits = np.append(np.flatnonzero(digit), len(data))
    i, j = np.searchsorted(digits, first), np.searchsorted(digits, last) - 1
    fits = i <= j
    first, last = digits[i[fits]], digits[j[fits]] + 1
    fits = _apart(first, last, address) & _apart(first, last, both)
    number = first[fits], last[fits]

    parts = [(tuple(np.array([x[i] for x in own], np.int64) for i in (0, 1)), np.array([x[2] for x in own], np.int8))]
    parts += [(p, np.full(len(p[0]), tag, np.int8)) for p, tag in ((both, 1), (latin, 1), (number, 2))]
    first, last, tags = (np.concatenate(x) for x in ([p[0] for p, _ in parts], [p[1] for p, _ in parts], [t for _, t in parts]))
    order = np.argsort(first, kind="stable")
    first, last, tags = first[order], last[order], tags[order]
    rows = row_of(first)
    low = seen[bounds[rows]]
    return Found(rows, tags, seen[first] - low, seen[last] - low, first, last, data, bounds, seen, at)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices of rows with about ``CHUNK`` bytes of text, a row at least."""
    stops = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        most = (stops[low - 1] if low else 0) + CHUNK
        high = max(low + 1, int(np.searchsorted(stops, most, "right")))
        yield low, high - low
        low = high


def _structs(found: Found, context: int | None, gaps: pa.Array | None = None, more: dict[str, pa.Array] | None = None) -> pa.Array:
    """All spans as structs, with ``left`` and ``right`` unless there is no context, and with ``before`` if there are ``gaps``."""
    own = {"start": pa.array(found.start.astype(np.int32)), "end": pa.array(found.end.astype(np.int32)), "text": found.slices(found.first, found.last), "tag": pa.array(_TAGS).take(pa.array(found.tag))}
    if context is not None:
        own["left"], own["right"] = found.contexts(context)
    if gaps is not None:
        own["before"] = gaps
    own |= more or {}
    return pa.StructArray.from_arrays(list(own.values()), list(own))


@lru_cache
def _finder(context: int):
    def find(texts: pa.Array) -> pa.Array:
        made = [(f := _found(texts.slice(*part))).lists(_structs(f, context)) for part in _chunks(texts)]
        return pa.concat_arrays(made) if made else (f := _found(texts)).lists(_structs(f, context))

    return F.arrow_udf(find, f"array<{schemas.SPAN}>")


def find_spans(text: Column, context: int = CONTEXT) -> Column:
    """``array<struct<start, end, text, tag, left, right>>``, by start.  Offsets are half-open and count
    code points; a context of 0 leaves ``left`` and ``right`` empty.  Null has no spans."""
    return _finder(context)(text)


def with_spans(rows: DataFrame, text: str, context: int | None = CONTEXT, look_up: Callable[[Found, pa.RecordBatch], tuple[pa.Array, pa.Array]] | None = None) -> DataFrame:
    """``rows`` with ``spans`` and ``tail``: as ``find_spans``, each with the text ``before`` it up to the span before, and the text after the last one.
    Without a context there is no ``left, right``.  ``look_up`` tells the ``candidates`` of a chunk's spans, and those of its rows without spans
    (``whole_candidates``).  A few megabytes are held at once, however many spans a batch of rows has."""
    one = "`start`: int, `end`: int, text: string, tag: string" + (", `left`: string, `right`: string" if context is not None else "") + ", before: string"
    one += f", candidates: array<{schemas.CANDIDATE}>" if look_up else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for part in _chunks(texts):
                own = batch.slice(*part)
                found = _found(texts.slice(*part))
                before, tail = found.gaps()
                told = look_up(found, own) if look_up else ()
                spans = found.lists(_structs(found, context, before, {"candidates": told[0]} if told else None))
                yield pa.RecordBatch.from_arrays([*own.columns, spans, tail, *told[1:]], [*own.schema.names, *(f.name for f in added)])

    added = [StructField("spans", _parse_datatype_string(f"array<struct<{one}>>")), StructField("tail", _parse_datatype_string("string"))]
    if look_up:
        added.append(StructField("whole_candidates", _parse_datatype_string(f"array<{schemas.CANDIDATE}>")))
    return rows.mapInArrow(run, StructType([*(StructField(f.name, f.dataType) for f in rows.schema.fields), *added]))


@lru_cache
def _scorer():
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for part in _chunks(texts):
            found = _found(texts.slice(*part))
            out.append(np.bincount(found.row, weights=np.array([2.0, 1.0, 0.5])[found.tag], minlength=part[1]))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(score, "double")


def text_risk(text: Column) -> Column:
    """``risk_score`` of the spans of a text, without making them; 0 for null."""
    return _scorer()(text)


def addresses(text: Column) -> Column:
    return F.filter(find_spans(text, 0), lambda s: s["tag"] == "U1")


def hangul_numbers(text: Column) -> Column:
    """Runs of two or more numerals with a counter after or a keyword before them."""
    return F.filter(find_spans(text, 0), lambda s: (s["tag"] == "N3") & ~s["text"].rlike(rf"{U}\d"))


def risk_score(spans: Column) -> Column:
    """2 for each address, 1 for each Latin run, else a half."""
    return F.aggregate(spans, F.lit(0.0), lambda a, s: a + F.when(s["tag"] == "U1", 2.0).when(s["tag"] == "E2", 1.0).otherwise(0.5))
