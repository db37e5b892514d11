"""Golden cases of the text rules: numbers, normalisation, spans, triage, decisions, fixes."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from malgeul.functions import decide, normalize, numbers, spans
from malgeul.functions.textexpr import collapse, match_offsets, replace_with, strip
from malgeul.operators import quantiles, triage


def column(spark, values, kind, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def spoken(n):
    """An independent reader, digit place by digit place."""
    if n == 0:
        return "영"
    digits, out = "영일이삼사오육칠팔구", []
    for at, big in ((16, "경"), (12, "조"), (8, "억"), (4, "만"), (0, "")):
        q = n // 10**at % 10000
        if not q:
            continue
        for place, name in ((3, "천"), (2, "백"), (1, "십"), (0, "")):
            d = q // 10**place % 10
            if d:
                out.append((digits[d] if d > 1 or not name else "") + name)
        if big:
            out.append(big)
    return " ".join(out)


def test_sino(spark):
    rng = random.Random(1)
    values = [*range(0, 20_000), *(rng.randrange(10 ** rng.randint(5, 20)) for _ in range(2000)), 10**20 - 1]
    got = column(spark, [str(v) for v in values], "string", lambda c: numbers.read_sino(numbers.number_of(c)))
    assert [g.replace("␣", " ") for g in got] == [spoken(v) for v in values]
    odd = column(spark, [str(10**20), "-12345", None, "12,345", "9" * 45], "string", lambda c: numbers.read_sino(numbers.number_of(c)))
    assert odd == [None, "마이너스␣일␣만␣이천␣삼백␣사십␣오", None, "일␣만␣이천␣삼백␣사십␣오", None]


@pytest.mark.parametrize(
    "n, sino, native",
    [(0, "영", "영"), (1, "일", "한"), (10, "십", "열"), (11, "십 일", "열 한"), (20, "이십", "스물"), (21, "이십 일", "스물 한"), (99, "구십 구", "아흔 아홉"), (100, "백", "백"), (110, "백 십", "백 십"),
     (2024, "이천 이십 사", "이천 이십 사"), (10000, "일 만", "일 만"), (51300, "오 만 천 삼백", "오 만 천 삼백"), (100000000, "일 억", "일 억")],
)
def test_readings(spark, n, sino, native):
    r = spark.range(1).select(numbers.read_sino(F.lit(n)).alias("s"), numbers.read_native(F.lit(n)).alias("n"), numbers.read_hour(F.lit(n)).alias("h"), numbers.read_each_digit(F.lit("019")).alias("d")).first()
    assert (r["s"].replace("␣", " "), r["n"].replace("␣", " "), r["d"]) == (sino, native, "영␣일␣구")
    assert r["h"].replace("␣", " ") == (native if 1 <= n <= 12 else sino)


NORMALIZED = [
    ("도시철도는 정원 120명인 1칸 차량에 180명이 탑승", "도시철도는 정원 백 이십 명인 한 칸 차량에 백 팔십 명이 탑승"),
    ("50% 할인", "오십 퍼센트  할인"), ("36.5℃", "삼십 육 점 오 도 씨"), ("COVID-19", "씨오브이아이디 십 구"), ("코로나19 확진", "코로나 일구 확진"),
    ("코로나19가", "코로나십 구가"), ("3명 이상", "세 명이상"), ("가격은 2만원", "가격은이 만 원"), ("3.14", "삼.십 사"), ("5KM", "오KM"), ("5km", "오 키로미터"),
    ("pokm", "피오케이엠"), ("3만여 곡", "삼 만 여곡"), ("5만1300명", "오 만 천 삼백 명"), ("350억원", "삼백 오십 억 원"), ("1,234명", "천 이백 삼십 사 명"),
    ("3시 30분", "세 시 삼십 분"), ("13시", "십 삼 시"), ("제3회", "제 삼 회"), ("출·퇴근", "출퇴근"), ("자작나무숲에", "자작나무 숲에"), ("잣나무숲", "잣나무숲"),
    ("대통령배", "대통령 배"), ("빈차", "빈 차"), ("사이 번호", "사이번호"), ("10,20개", "천 이십 개"), ("1번", "한 번"), (None, ""), ("", ""), ("9" * 25 + "명", " ".join("구" * 25) + " 명"),
    ("형사 3부의", "형사 삼 부의"), ("9대와 12대", "아홉 대와 십 이 대"), ("국민체육공원에서", "국민 체육공원에서"), ("두배", "두배"), ("50% 할인\x01\x02\x03", "오십 퍼센트  할인"),
]


def test_normalize(spark):
    got = column(spark, [a for a, _ in NORMALIZED], "string", normalize.normalize)
    assert [(a, g) for (a, _), g in zip(NORMALIZED, got, strict=True)] == NORMALIZED


def test_spacing_provider(spark):
    cases = [
        ("정보통신진흥", "정보통신 진흥", True), ("정보통신", "정보통신", False), ("정보통신진흥", "정보 통신진", False), ("가나다라마", "가 나다라마", False), ("자작나무숲", "자작나무 숲", True),
        ("부천시청구", "부천시청 구", False), ("민사소송법률", "민사소송 법률", False), ("덕수궁길", "덕수궁 길", False), ("가나다라마바사아", "가나 다라 마바 사아", False), ("순창군체육회", "순창군 체육회", False),
        ("대한민국체육회", "대한민국 체육회", True), ("전국배드민턴대회", "전국 배드민턴 대회", False), ("전국바둑대회", "전국 바둑 대회", True), ("가나장라마", "가나 장 라마", False),
    ]
    rows = spark.createDataFrame(cases, "a string, b string, want boolean")
    assert [r["got"] for r in rows.select(normalize.accepts_split(F.col("a"), F.col("b")).alias("got")).collect()] == [c[2] for c in cases]
    spacer = lambda stem: F.when(stem == "정보통신진흥", F.lit("정보통신 진흥"))
    assert column(spark, ["정보통신진흥에서", "하나둘셋넷다섯", "정보통신진흥배"], "string", lambda c: normalize.normalize(c, spacer)) == ["정보통신 진흥에서", "하나둘셋넷다섯", "정보통신 진흥 배"]


SPANS = [
    ("인증번호가 일이삼사야", [("N3", 6, 10)]), ("2024년 3월 15일", [("N3", 0, 4), ("N3", 6, 7), ("N3", 9, 11)]), ("www.naver.com 접속해봐", [("U1", 0, 13)]),
    ("더블유더블유더블유 점 네이버 점 컴", [("U1", 0, 10), ("U1", 16, 19)]), ("COVID19 확진자 1234명", [("E2", 0, 7), ("N3", 12, 16)]), ("KDH가 만들었습니다", [("E2", 0, 3)]),
    ("010-1234-5678로 전화해", [("N3", 0, 13)]), ("이메일은 test@example.com입니다", [("E2", 5, 9), ("U1", 10, 21)]), ("COVID19 1234", [("E2", 0, 7), ("N3", 8, 12)]),
    ("😀 12 ab", [("N3", 2, 4), ("E2", 5, 7)]), ("", []), (None, []), ("삼십 명", []), ("이십명", [("N3", 0, 2)]),
]


def test_spans(spark):
    got = column(spark, [t for t, _ in SPANS], "string", lambda c: spans.find_spans(c, 4))
    for (text, want), own in zip(SPANS, got, strict=True):
        assert [(s["tag"], s["start"], s["end"]) for s in own] == want, text
        for s in own:
            assert s["text"] == text[s["start"] : s["end"]] and s["left"] == text[max(0, s["start"] - 4) : s["start"]] and s["right"] == text[s["end"] : s["end"] + 4]


def plain_spans(text):
    """Every match against all that the rules before it have taken."""
    rules = [("U1", spans.ADDRESS), ("U1", spans.EMAIL), ("U1", spans.SPOKEN_ADDRESS), ("E2", spans.ALPHANUMERIC), ("E2", spans.LATIN), ("N3", spans.DIGIT_RUN), ("N3", spans.HANGUL_NUMERALS)]
    out = []
    for tag, pattern in rules:
        new = [m.span() for m in re.finditer(pattern.replace("(?Ud)", ""), text)]
        if pattern == spans.HANGUL_NUMERALS:
            after, before = (lambda e: text[e : e + 5]), (lambda a: text[max(0, a - 20) : a])
            new = [(a, e) for a, e in new if e - a > 1 and (any(after(e).startswith(w) for w in spans.NUMBER_SUFFIXES) or any(w in before(a) for w in spans.NUMBER_PREFIXES))]
        out += [(a, e, tag) for a, e in new if all(e <= b or a >= d for b, d, _ in out)]
    return sorted(out)


def test_spans_equal_all_pairs():
    rng = random.Random(2)
    pieces = ["www.a.com", "http://x.org/q", "me@b.net", "더블유더블유", "점 컴", "AB12", "12ab", "abc", "x", "1,234.5", "7", "이십", "일이삼", "명", " ", " ", "번호", "가", ".", "\x01", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        assert spans.spans_of(text) == plain_spans(text), text


def test_control_characters_keep_places(spark):
    text = "금\x01\x02 98765 원 ab\x03c"
    found, offsets = spark.range(1).select(spans.find_spans(F.lit(text), 3), match_offsets(F.lit(text), r"[a-z\x05]+|\d+")).first()
    assert [(s["start"], s["text"], s["left"], s["right"]) for s in found] == [(4, "98765", "\x01\x02 ", " 원 "), (12, "ab", "원 "[-2:] and text[9:12], "\x03c")]
    assert all(text[m["start"] : m["end"]] == m["text"] for m in offsets) and [m["text"] for m in offsets][-1] == "ab\x03c"


def test_exact_percentiles(spark, monkeypatch):
    rng = random.Random(4)
    many = [rng.choice([rng.gauss(0, 1), 5.0, 10.0 ** rng.randint(-3, 3), -1e-320]) for _ in range(600)]
    for values in (many, [1.0] * 900 + [2.0], [-math.inf, *many[:300], math.inf], [3.0] * 700):
        rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
        want = [np.percentile(values, 100 * p) for p in (0.0, 0.031, 0.5, 0.77, 1.0)]
        for few in (100_000, 50):
            monkeypatch.setattr(quantiles, "FEW", few)
            assert quantiles.exact_percentiles(rows, "x", (0.0, 0.031, 0.5, 0.77, 1.0)) == pytest.approx(want, rel=1e-12, nan_ok=True)
    assert quantiles.exact_percentiles(rows.limit(0), "x", (0.5,)) == [None]


def test_regex_helpers(spark):
    assert column(spark, ["a1b22", "", "x"], "string", lambda c: replace_with(c, r"(\d)(\d)?", 2, lambda g: F.concat(F.lit("<"), g[1], g[0], F.lit(">")))) == ["a<1>b<22>", "", "x"]
    assert [[(m["start"], m["end"], m["text"]) for m in x] for x in column(spark, ["😀12가3", "", "12"], "string", lambda c: match_offsets(c, r"\d+"))] == [[(1, 3, "12"), (4, 5, "3")], [], [(0, 2, "12")]]
    assert column(spark, ["　 a \n b \n", None], "string", lambda c: collapse(c)) == ["a b", ""] and column(spark, [" a b\n"], "string", strip) == ["a b"]


TRIAGE = [
    ("안녕하세요", -0.15, 1.4, "A", "high_confidence"), ("오늘 날씨가", -0.5, 1.8, "B", "medium_confidence"), ("어", -0.9, 2.0, "C", "too_short"), ("네네네네네네", -0.2, 1.5, "C", "repeated_ngram"),
    ("테스트 문장", -0.2, 5.0, "C", "compression_ratio_high"), ("정상적인 문장입니다", -0.85, 1.6, "C", "low_confidence"), ("네네네네네", -0.2, 1.5, "A", "high_confidence"), ("가나다", -0.3, 1.0, "B", "medium_confidence"),
    ("가나다", -0.7, 1.0, "C", "low_confidence"), ("가나다", -0.1, 4.0, "A", "high_confidence"), ("가나다", math.nan, 1.0, "C", "low_confidence"), ("가나다", -0.1, math.nan, "A", "high_confidence"),
    ("안녕 안녕 안녕", -0.1, 1.0, "C", "repeated_ngram"), ("네 네 네", -0.1, 1.0, "A", "high_confidence"), (None, -0.1, 1.0, "C", "processing_error"), ("가나다", None, 1.0, "C", "processing_error"),
]


def test_triage(spark):
    rows = spark.createDataFrame([(i, *t[:3]) for i, t in enumerate(TRIAGE)], "i int, t string, l double, c double")
    got = [r["x"] for r in rows.select("i", triage.triage(F.col("t"), F.col("l"), F.col("c")).alias("x")).orderBy("i").collect()]
    assert [(x["bucket"], x["reason"]) for x in got] == [t[3:] for t in TRIAGE]
    assert [x["has_repetition"] for x in got[:4]] == [False, False, False, True]


def test_percentile_buckets(spark):
    count = lambda values: {r["bucket"]: r["count"] for r in triage.percentile_buckets(spark.createDataFrame([(v,) for v in values], "logprob double")).groupBy("bucket").count().collect()}
    assert count([float(v) for v in range(-100, 1)]) == {"RED": 4, "ORANGE": 12, "YELLOW": 25, "GREEN": 60}
    assert count([-1.0] * 9) == {"RED": 9} and count([-1.0]) == {"RED": 1} and count([-1.0, math.nan, -2.0]) == {"GREEN": 3} and count([]) == {}
    rows = triage.with_logprob(spark.createDataFrame([("www.a.com ab1 12", None)], "text_raw string, avg_logprob double"))
    assert rows.first()["logprob"] == pytest.approx(-1.35)
    assert triage.bucket_statistics(spark.createDataFrame([], "bucket string")).first().asDict() == {"total": 0, "a_count": 0, "a_ratio": None, "b_count": 0, "b_ratio": None, "c_count": 0, "c_ratio": None}


DECISIONS = [
    ("U1", "GREEN", "더블유더블유더블유", "www.example.com", [0.9], "NEEDS_REVIEW"), ("N3", "GREEN", "일이삼사", "1234", [0.9, 0.5], "NEEDS_REVIEW"), ("N3", "YELLOW", "12345", "12346", [0.9, 0.5], "AUTO_FIX"),
    ("N3", "ORANGE", "12345", "12346", [0.9, 0.5], "NEEDS_REVIEW"), ("N3", "GREEN", "1234", "1235", [0.9, 0.5], "NEEDS_REVIEW"), ("N3", "GREEN", "12345", "12345", [0.9], "AUTO_FIX"),
    ("E2", "GREEN", "COVIDAB", "COVIDAC", [0.9, 0.5], "AUTO_FIX"), ("E2", "YELLOW", "COVIDAB", "COVIDAC", [0.9, 0.5], "NEEDS_REVIEW"), ("E2", "GREEN", "COVIDAB", "COVIDA가", [0.9, 0.5], "NEEDS_REVIEW"),
    ("N3", "GREEN", "123", "...", [0.9], "NEEDS_REVIEW"), ("OOV", "GREEN", "abc", "abc", [0.9], "NEEDS_REVIEW"), ("X", "GREEN", "abc", "abc", [0.9], "PASS"), ("N3", "GREEN", "12345", "12346", [0.75, 0.5], "AUTO_FIX"),
    ("N3", "GREEN", "12345", "12346", [0.74, 0.5], "NEEDS_REVIEW"), ("E2", "GREEN", "COVIDAB", "COVIDAC", [0.84, 0.5], "NEEDS_REVIEW"),
]


def test_decisions(spark):
    rows = spark.createDataFrame([(i, a, b, c, d, [(d, s) for s in e]) for i, (a, b, c, d, e, _) in enumerate(DECISIONS)], "i int, tag string, bucket string, raw string, rec string, cands array<struct<text:string,score:double>>")
    got = rows.select("i", decide.span_action(F.col("tag"), F.col("bucket"), F.col("raw"), F.col("rec"), decide.margin(F.col("cands"))).alias("y")).orderBy("i").collect()
    assert [r["y"] for r in got] == [d[-1] for d in DECISIONS]
    ratio = lambda a, b: spark.range(1).select(decide.edit_ratio(F.lit(a), F.lit(b))).first()[0]
    assert [ratio(*p) for p in (("hello", "hello"), ("hello", "hallo"), ("hello", "world"), ("", ""))] == [0.0, 0.2, 0.8, 0.0]
    sentence = lambda bucket, address=False: spark.range(1).select(decide.sentence_action(F.lit(bucket), F.lit("같은 말"), F.lit("같은 말"), F.lit(address))).first()[0]
    assert (sentence("GREEN"), sentence("YELLOW"), sentence("GREEN", True)) == ("AUTO_FIX", "NEEDS_REVIEW", "NEEDS_REVIEW")


@pytest.mark.parametrize("fixes, want", [([(1, 3, "X"), (4, 5, "Y")], "aXdYf"), ([(0, 4, "X"), (2, 5, "Y")], "abYf"), ([(1, 5, "X"), (1, 3, "Y")], "aYdef"), ([], "abcdef")])
def test_apply_fixes(spark, fixes, want):
    rows = spark.createDataFrame([("abcdef", fixes)], "t string, f array<struct<start:int,end:int,new:string>>")
    assert rows.select(decide.apply_fixes(F.col("t"), F.col("f"))).first()[0] == want


def test_prompts_and_candidates(spark):
    p = spark.range(1).select(decide.prompt("STW_SPAN", F.lit("l"), F.lit("s"), F.lit("r")), decide.prompt("STW_CANON", F.lit(""), F.lit("s"), F.lit(""))).first()
    assert tuple(p) == ("<STW_SPAN>\nLEFT: l\nSPAN: ⟦s⟧\nRIGHT: r\n</STW_SPAN>", "<STW_CANON>\ns\n</STW_CANON>")
    with pytest.raises(ValueError):
        decide.prompt("OTHER", F.lit(""), F.lit(""), F.lit(""))
    rows = spark.createDataFrame([([("a", 0.5), ("b", 0.9), ("a", 0.7), ("c", 0.9)],)], "c array<struct<text:string,score:double>>")
    got = rows.select(decide.ranked(F.col("c")), decide.rank_scores(F.array(F.lit("x"), F.lit("y"))), decide.review_cell(F.col("c"), 2)).first()
    assert [tuple(x) for x in got[0]] == [("b", 0.9), ("c", 0.9), ("a", 0.7)] and [tuple(x) for x in got[1]] == [("x", 1.0), ("y", 0.5)] and got[2] == "a (0.500) | b (0.900)"


def test_spans_of_many_texts(spark):
    """Places, contexts, gaps and scores of a chunk of texts are those of each text by itself, whatever stands next to it."""
    rng = random.Random(5)
    pieces = ["www.a.com", "http://x.org/q", "me@b.net", "AB12", "12ab", "abc", "x", "1,234.5", "7", "-", "..", " ", " ", ",", "\x01", "é", "ñab", "日本", "😀", "이십", "명", "번호", "٣", "²", ".kr", "a1"]
    for _ in range(400):
        texts = [None if rng.random() < 0.05 else "".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 8))]
        found = spans._found(pa.array(texts, pa.string()))
        before, tail = found.gaps()
        told = list(zip(*(x.tolist() for x in (found.row, found.start, found.end, found.tag)), *(x.to_pylist() for x in (*found.contexts(4), before)), strict=True))
        for r, text in enumerate(t or "" for t in texts):
            own = [x[1:] for x in told if x[0] == r]
            assert [(a, b, spans._TAGS[tag]) for a, b, tag, *_ in own] == spans.spans_of(text)
            assert all((left, right) == (text[max(0, a - 4) : a], text[b : b + 4]) for a, b, _, left, right, _ in own)
            assert "".join(gap + text[a:b] for a, b, _, _, _, gap in own) + tail[r].as_py() == text
    assert all(spans._OTHER[chr(c).encode()[0]] for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and (chr(c).isdecimal() or 0xAC00 <= c <= 0xD7A3))
    got = column(spark, ["www.a.com ab 12", "", None], "string", spans.text_risk)
    assert got == [3.5, 0.0, 0.0]


def test_spans_are_made_in_chunks(spark, monkeypatch):
    """However many spans a batch of rows has, those of a few texts are made at a time, and none for scores."""
    seen = []
    whole = spans._found
    monkeypatch.setattr(spans, "_found", lambda texts: seen.append(len(texts)) or whole(texts))
    monkeypatch.setattr(spans, "CHUNK", 100)
    texts = pa.array(["ab 12 " * 10] * 7 + [None, "x" * 500, ""])
    assert spans._finder.__wrapped__(0).func(texts).to_pylist()[6][-1]["end"] == 59 and max(seen) <= 3
    monkeypatch.setattr(spans, "_structs", None)
    assert spans._scorer.__wrapped__().func(texts).to_pylist() == [15.0] * 7 + [0.0, 1.0, 0.0]
