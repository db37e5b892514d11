"""Normalising Korean text for speech: symbols, letters, numbers with units, spacing of compounds and particles.

Each stage is a function from column to column; ``normalize`` runs them in their fixed order.  Words that
must stay apart are joined by ``SPACE`` until the last stage.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from malgeul.functions.numbers import SPACE, number_of, read_each_digit, read_number, read_sino
from malgeul.functions.textexpr import LOST, U, collapse, either, let, replace_with, sanitize, words

# Word lists of the language rules.
LETTERS = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "에이 비 씨 디 이 에프 지 에이치 아이 제이 케이 엘 엠 엔 오 피 큐 알 에스 티 유 브이 더블유 엑스 와이 지".split(), strict=True))
NATIVE_UNITS = "개 명 곳 칸 번 시간 살 마리 권 장".split()
UNITS = "개조 개 명 곳 칸 대 번 시간 살 마리 권 장 년 월 일 시 분 초 퍼센트 도씨 도 키로미터 킬로미터 미터 km 원 세 부 회".split()
UNITS_AFTER_BIG = "원 명 개 곳 칸 대 번 시간 살 마리 권 장 회 부".split()
PARTICLES = "께서 에서 에게 으로 부터 까지 은 는 이 가 을 를 에 로 과 와 도 만 의".split()
JOINED_PARTICLES = "을 를 은 는 이 가 에 에서 에게 께서 으로 로 과 와 도 만 부터 까지 의".split()
FORCED_SUFFIXES = ["체육공원", "운송사업조합"]
NO_SPLIT_TAILS = "체육회 협회 위원회 공사 센터 국민체육센터 장애인체육관 체육센터".split()
PROTECTED_ENDINGS = "적으로 적인 하기로 하기 하게 하며 했다 한다 됩니다 였다 이었다 이었".split()
BAD_SEGMENTS = "제 회 원 장 부 시 군 구 면 리 동 법 안 은 는 이 가 을 를 에 의 로 과 와 도 만".split()
ADMIN_SUFFIXES = "시 군 구 읍 면 리 동".split()
SPORTS = ["배드민턴"]
PUNCTUATION = "[\"'“”‘’`´•…(),;:!?{}\\[\\]<>—–\\-/\\\\|]"
FOLLOWS_SSI = r"(?:\s|$|[을를은는이가에의과와도만부터까지에서에게께서으로로]|[.,;:!?])"
SHORT_NUMERALS = r"(?:\d+|[한두세네다섯여섯일곱여덟아홉열]+)"


def _longest_first(items: list[str]) -> str:
    return "|".join(sorted(map(re.escape, items), key=len, reverse=True))


_UNIT, _TAIL = f"({_longest_first(UNITS)})", rf"(?:\s*({_longest_first([*PARTICLES, '인'])}))?"
_N = r"(\d[\d,]*)"
DECIMAL_UNIT = rf"{U}{_N}\.(\d+)\s*{_UNIT}{_TAIL}"
APPROXIMATE = rf"{U}{_N}\s*(천|만|억|조)\s*여\s*{_UNIT}?{_TAIL}"
MIXED_MAN = rf"{U}{_N}\s*만\s*{_N}\s*{_UNIT}{_TAIL}"
BIG_UNIT = rf"{U}{_N}\s*(천|만|억|조)\s*({'|'.join(UNITS_AFTER_BIG)}){_TAIL}"
CRIMINAL_COURT, NTH_TIME = rf"{U}형사\s*{_N}\s*부{_TAIL}", rf"{U}제\s*{_N}\s*회{_TAIL}"
INTEGER_UNIT = rf"{U}{_N}\s*{_UNIT}{_TAIL}"
BARE_NUMBER = rf"{U}{_N}"


def _mark(*parts) -> Column:
    """Parts with marks between them; strings are literals."""
    out = []
    for p in parts:
        out += [F.lit(SPACE), F.lit(p) if isinstance(p, str) else p]
    return F.concat(*out[1:])


def symbols(text: Column) -> Column:
    """℃, %, ° and ㎞ in words."""
    for symbol, word in (("℃", "도씨"), ("%", f"{SPACE}퍼센트{SPACE}"), ("°", f"{SPACE}도{SPACE}"), ("㎞", "km")):
        text = F.replace(text, F.lit(symbol), F.lit(word))
    return text


def letters(text: Column) -> Column:
    """Latin letters by name; a run that is just "km" stays for the units."""
    names = F.create_map(*(F.lit(x) for pair in LETTERS.items() for x in pair))

    def spelled(groups: list[Column]) -> Column:
        run = groups[0]
        return F.when(F.lower(run) == "km", run).otherwise(F.array_join(F.transform(F.filter(F.split(F.upper(run), ""), lambda c: c != ""), lambda c: names[c]), ""))

    return replace_with(text, "([A-Za-z]+)", 1, spelled)


def ssi(text: Column) -> Column:
    return F.regexp_replace(text, rf"{U}([가-힣]{{1,4}})씨(?={FOLLOWS_SSI})", f"$1{SPACE}씨")


def covid(text: Column) -> Column:
    said = f"코로나{SPACE}일구"
    return F.regexp_replace(F.regexp_replace(text, rf"{U}코로나\s*19\b", said), r"(?Uid)COVID\s*[-–]?\s*19\b", said)


def _unit(unit: Column) -> Column:
    return F.when(F.lower(unit) == "km", "키로미터").otherwise(unit)


def _one_by_one(text: Column) -> Column:
    return read_each_digit(F.replace(text, F.lit(","), F.lit("")))


def _sino(text: Column) -> Column:
    """Digits with commas as a number, or one by one where they are too many to read."""
    return F.coalesce(read_sino(number_of(text)), _one_by_one(text))


def _counted(number: Column, unit: Column) -> Column:
    """Hours and native units in native words, machines so below ten, all others in Sino-Korean."""
    return read_number(number, lambda n: ((unit == "시") & (n <= 12)) | unit.isin(NATIVE_UNITS) | ((unit == "대") & (n < 10)))


def decimals(text: Column) -> Column:
    return replace_with(text, DECIMAL_UNIT, 4, lambda g: F.concat(_mark(_sino(g[0]), "점", read_each_digit(g[1]), _unit(g[2])), g[3]))


def approximations(text: Column) -> Column:
    return replace_with(text, APPROXIMATE, 4, lambda g: F.concat(_mark(_sino(g[0]), g[1], "여"), _unit(g[2]), g[3]))


def mixed_man(text: Column) -> Column:
    said = lambda g: F.coalesce(_counted(number_of(g[0]) * 10000 + number_of(g[1]), g[2]), _mark(_one_by_one(g[0]), "만", _one_by_one(g[1])))
    return replace_with(text, MIXED_MAN, 4, lambda g: F.concat(_mark(said(g), _unit(g[2])), g[3]))


def big_units(text: Column) -> Column:
    return replace_with(text, BIG_UNIT, 4, lambda g: F.concat(_mark(_sino(g[0]), g[1], g[2]), g[3]))


def special_counters(text: Column) -> Column:
    text = replace_with(text, CRIMINAL_COURT, 2, lambda g: F.concat(_mark("형사", _sino(g[0]), "부"), g[1]))
    return replace_with(text, NTH_TIME, 2, lambda g: F.concat(_mark("제", _sino(g[0]), "회"), g[1]))


def integers(text: Column) -> Column:
    return replace_with(text, INTEGER_UNIT, 3, lambda g: F.concat(_mark(F.coalesce(_counted(number_of(g[0]), g[1]), _one_by_one(g[0])), _unit(g[1])), g[2]))


def bare_numbers(text: Column) -> Column:
    return collapse(replace_with(text, BARE_NUMBER, 1, lambda g: _sino(g[0])))


def punctuation(text: Column) -> Column:
    """The middle dot goes, other punctuation becomes a space."""
    return collapse(F.regexp_replace(F.replace(text, F.lit("·"), F.lit("")), PUNCTUATION, " "))


# ---- compounds ----

_PARTICLE = rf"^([가-힣]{{2,}})({_longest_first(PARTICLES)})$"


def split_particle(token: Column) -> Column:
    """``struct<stem, particle>``; of the particles that fit, the shortest."""
    return F.when(
        token.rlike(_PARTICLE), F.struct(F.regexp_extract(token, _PARTICLE, 1).alias("stem"), F.regexp_extract(token, _PARTICLE, 2).alias("particle"))
    ).otherwise(F.struct(token.alias("stem"), F.lit("").alias("particle")))


def _without(text: Column, suffix: str) -> Column:
    return F.left(text, F.length(text) - len(suffix))


def split_suffix(stem: Column) -> Column:
    """A space before a forced suffix, else before a final forest, if two letters or more precede it."""
    out = F.when(stem.endswith("숲") & (F.length(stem) >= 3), F.concat(_without(stem, "숲"), F.lit(" 숲")))
    for suffix in reversed(FORCED_SUFFIXES):
        out = F.when(stem.endswith(suffix) & (F.length(stem) > len(suffix) + 1), F.concat(_without(stem, suffix), F.lit(" " + suffix))).otherwise(out)
    return F.coalesce(out, stem)


def accepts_split(original: Column, spaced: Column) -> Column:
    """Whether a proposed spacing of a stem is taken: it must only add spaces, and none of seven rules may speak against it."""

    def rules(parts: Column) -> Column:
        last, n = F.get(parts, F.size(parts) - 1), F.size(parts)
        head = F.get(parts, F.lit(0))
        single = F.exists(F.slice(parts, 1, F.greatest(n - 1, F.lit(0))), lambda p: F.length(p) == 1) | ((F.length(last) == 1) & (last != "숲"))
        against = [
            spaced == original,
            F.array_join(parts, "") != original,
            single,
            F.exists(parts, lambda p: p.isin(BAD_SEGMENTS)),
            last.isin(ADMIN_SUFFIXES),
            original.contains("법"),
            (n == 2) & (last == "길") & (F.length(head) >= 2),
            n >= 4,
            (n == 2) & last.isin(NO_SPLIT_TAILS) & ((F.length(head) <= 3) | F.right(head, F.lit(1)).isin(ADMIN_SUFFIXES)),
            original.endswith("대회") & _any(SPORTS, lambda s: original.contains(s)),
        ]
        return ~_any(against, lambda c: F.coalesce(c, F.lit(False)))

    return let(words(spaced), rules)


def _any(items, test) -> Column:
    out = F.lit(False)
    for item in items:
        out = out | test(item)
    return out


Spacer = Callable[[Column], Column]


def compound(token: Column, spacer: Spacer | None = None, least: int = 5) -> Column:
    """The spacing of one token.  ``spacer`` proposes spacings of stems, as a morphological analyser does; without it
    only the fixed rules apply."""

    def whole(parts: Column) -> Column:
        stem0, particle = parts["stem"], parts["particle"]
        before_cup = _without(stem0, "배")
        is_cup = stem0.endswith("배") & (F.length(stem0) >= 4) & ~before_cup.rlike(rf"{U}^{SHORT_NUMERALS}\z")
        def spaced(stem: Column, cup: Column) -> Column:
            def proposed(split: Column) -> Column:
                free = stem
                if spacer is not None:
                    told = lambda s: F.when(accepts_split(stem, s), s).otherwise(stem)
                    free = F.when(_any(PROTECTED_ENDINGS, lambda e: stem.endswith(e)), stem).otherwise(let(F.coalesce(spacer(stem), stem), told))
                return F.concat(F.when(split.contains(" "), split).otherwise(free), cup, particle)

            short = F.when(cup != "", F.concat(stem, cup, particle)).otherwise(token)
            return F.when(F.length(stem) >= least, let(split_suffix(stem), proposed)).otherwise(short)

        with_cup = F.struct(F.when(is_cup, before_cup).otherwise(stem0).alias("stem"), F.when(is_cup, " 배").otherwise("").alias("cup"))
        return F.when(stem0.rlike("^[가-힣]+$"), let(with_cup, lambda c: spaced(c["stem"], c["cup"]))).otherwise(token)

    return F.when(token.contains(SPACE), token).when(token == "빈차", "빈 차").otherwise(let(split_particle(token), whole))


def compounds(text: Column, spacer: Spacer | None = None) -> Column:
    return collapse(F.array_join(F.transform(words(text), lambda t: compound(t, spacer)), " "))


def join_particles(text: Column) -> Column:
    """Particles that stand alone join the word before them; at most three times over."""
    for _ in range(3):
        text = F.regexp_replace(text, rf"{U}(\S+)\s+({'|'.join(JOINED_PARTICLES)})\b", "$1$2")
    return text


def glue(text: Column) -> Column:
    return collapse(F.replace(F.replace(text, F.lit("이 번"), F.lit("이번")), F.lit("저 번"), F.lit("저번")))


def restore_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(SPACE), F.lit(" "))


NUMBER_STAGES = (covid, decimals, approximations, mixed_man, big_units, special_counters, integers, bare_numbers)


def numbers_and_units(text: Column) -> Column:
    for stage in NUMBER_STAGES:
        text = stage(text)
    return text


def normalize(text: Column, spacer: Spacer | None = None) -> Column:
    """All stages; null counts as ''.  A number of 10^20 or more is read digit by digit; the control characters U+0001 to U+0004 go."""
    text = numbers_and_units(ssi(letters(symbols(sanitize(either(text))))))
    done = glue(join_particles(compounds(punctuation(text), spacer)))
    return let(done, lambda t: F.when(~t.contains(LOST), restore_spaces(t)))


# ---- comparing ----


def canonical_levels(text: Column) -> list[Column]:
    """As it is; without punctuation; with single spaces; without spaces."""
    raw = either(text)
    bare = F.replace(F.regexp_replace(raw, PUNCTUATION, ""), F.lit("·"), F.lit(""))
    return [raw, bare, collapse(bare), F.regexp_replace(collapse(bare), rf"{U}\s+", "")]


def text_flags(text: Column) -> dict[str, Column]:
    return {"has_digit": text.rlike(rf"{U}\d"), "has_english": text.rlike("[A-Za-z]"), "has_symbol": text.rlike(rf"{U}[^0-9A-Za-z가-힣\s]")}
