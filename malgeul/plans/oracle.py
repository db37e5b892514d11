"""SQL for the catalog, written apart from the column builders.  Queries without an entry have no equal form in SQL
(Hangul word bounds, look-ahead, spans over Hangul); golden cases and tests hold those."""

from __future__ import annotations

UTT = """utt AS (SELECT doc_id, source || '_' || doc_id AS utt_id, source AS speaker_id, CAST(doc_id AS VARCHAR) AS sentence_id, text AS text_raw,
  -CAST(doc_id * 37 % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_logprob, CAST(doc_id * 13 % 50 AS DOUBLE) / CAST(10 AS DOUBLE) AS compression_ratio,
  CAST(n_chars AS DOUBLE) / CAST(15 AS DOUBLE) AS duration, lang AS language FROM documents)"""
SEG = """seg AS (SELECT CAST(conv_id AS VARCHAR) AS utt_id, CAST(turn AS INT) AS seg_no, text, CAST(length(text) % 7 AS DOUBLE) AS dur,
  -CAST((conv_id * 7 + turn * 3) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_logprob, CAST(turn % 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS no_speech_prob,
  CAST((conv_id + turn) % 40 AS DOUBLE) / CAST(10 AS DOUBLE) AS compression_ratio, turn % 5 = 4 AS hot FROM conversations)"""


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


def collapse(x: str) -> str:
    return rf"regexp_replace({strip(x)}, '\s+', ' ', 'g')"


def _triage(source: str, columns: str) -> str:
    """CTEs ending in ``t``: ``source`` has text, lp and cr."""
    return rf"""s0 AS (SELECT *, {strip("text")} AS st FROM {source}),
s1 AS (SELECT *, string_split(st, '') AS c, list_filter(regexp_split_to_array(st, '\s+'), lambda x: x <> '') AS w FROM s0),
s2 AS (SELECT *, length(st) >= 6 AND (len(list_filter(range(1, greatest(len(c) - 4, 1)), lambda i: c[i] = c[i+2] AND c[i+1] = c[i+3] AND c[i] = c[i+4] AND c[i+1] = c[i+5])) > 0
   OR len(list_filter(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] = w[i+1] AND w[i] = w[i+2])) > 0) AS rep FROM s1),
t AS (SELECT {columns}, CAST(length(st) AS INT) AS text_length, rep AS has_repetition,
  CASE WHEN cr > 4.0 THEN 'compression_ratio_high' WHEN rep THEN 'repeated_ngram' WHEN length(st) < 2 THEN 'too_short' WHEN lp > -0.3 THEN 'high_confidence' WHEN lp > -0.7 THEN 'medium_confidence' ELSE 'low_confidence' END AS reason,
  CASE WHEN cr > 4.0 OR rep OR length(st) < 2 THEN 'C' WHEN lp > -0.3 THEN 'A' WHEN lp > -0.7 THEN 'B' ELSE 'C' END AS bucket FROM s2)"""


TRI = f"WITH {UTT}, src AS (SELECT *, text_raw AS text, avg_logprob AS lp, compression_ratio AS cr FROM utt), {_triage('src', 'doc_id, utt_id, speaker_id, sentence_id, text_raw, language, duration, avg_logprob')}"

# The words of numerals.
DIG = "영일이삼사오육칠팔구"


def digit(x: str, k: int) -> str:
    return f"CAST(({x}) // {10**k} % 10 AS INT)"


def _joined(parts: list[str], by: str = "␣") -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda s: s <> ''), '{by}')"


def sino(x: str, groups: int = 4) -> str:
    """Reading of 0 <= x < 10^(4 groups)."""
    parts = []
    for g in reversed(range(groups)):
        own = []
        for place, name in ((3, "천"), (2, "백"), (1, "십"), (0, "")):
            d = digit(x, 4 * g + place)
            own.append(f"CASE WHEN {d} = 0 THEN '' WHEN {d} = 1 AND '{name}' <> '' THEN '{name}' ELSE substr('{DIG}', {d} + 1, 1) || '{name}' END")
        big = ["", "만", "억", "조"][g]
        parts += [*own, f"CASE WHEN ({x}) // {10 ** (4 * g)} % 10000 > 0 THEN '{big}' ELSE '' END"]
    return f"CASE WHEN ({x}) = 0 THEN '영' ELSE {_joined(parts)} END"


def native(x: str, groups: int = 4) -> str:
    tens, ones = "['열','스물','서른','마흔','쉰','예순','일흔','여든','아흔']", "['한','두','세','네','다섯','여섯','일곱','여덟','아홉']"
    low = _joined([f"coalesce(list_extract({tens}, {digit(x, 1)}), '')", f"coalesce(list_extract({ones}, {digit(x, 0)}), '')"])
    return f"CASE WHEN ({x}) BETWEEN 1 AND 99 THEN {low} ELSE {sino(x, groups)} END"


def spaced(x: str) -> str:
    return f"replace({x}, '␣', ' ')"


PUNCT = r"""[""" + "\"''" + r"""“”‘’`´•…(),;:!?{}\[\]<>—–\-/\\|]"""
M = "(o_orderkey * 7919 % 1000000007)"
CAND = """cand AS (SELECT p_partkey AS id, ['U1','N3','E2','OOV','N3'][p_partkey % 5 + 1] AS tag, ['RED','GREEN','YELLOW','GREEN','ORANGE','GREEN'][p_partkey % 6 + 1] AS bucket, p_name AS raw,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || 's' WHEN 2 THEN p_type ELSE '...' END AS rec, CAST(p_partkey * 3 % 9 AS DOUBLE) / CAST(10 AS DOUBLE) AS second, p_partkey % 3 = 0 AS single FROM part),
k AS (SELECT *, CASE WHEN single THEN 1.0::DOUBLE ELSE CAST(0.9 AS DOUBLE) - second END AS margin, CASE WHEN greatest(length(raw), length(rec)) = 0 THEN 0.0::DOUBLE ELSE CAST(levenshtein(raw, rec) AS DOUBLE) / greatest(length(raw), length(rec)) END AS ratio FROM cand)"""
EDIT = """e0 AS (SELECT doc_id, source, text, unnest([0, 1]) AS k FROM documents WHERE length(text) >= 20),
e AS (SELECT 2 * doc_id + k AS row_no, source || '_' || doc_id AS utt_id, source AS speaker_id, CAST(doc_id AS VARCHAR) AS sentence_id, text, doc_id, CAST(8 * k AS INT) AS span_start, CAST(8 * k + 4 AS INT) AS span_end,
  substr(text, 8 * k + 1, 4) AS raw_span, CASE (2 * doc_id + k) % 3 WHEN 0 THEN 'REC' WHEN 1 THEN 'REC' ELSE 'fix' || doc_id END AS final_text, (2 * doc_id + k) % 3 = 2 AS was_modified FROM e0)"""
_TEXT = strip("string_agg(text, '' ORDER BY seg_no, text)")
MEANS = f"WITH {SEG}, u AS (SELECT utt_id, {_TEXT} AS text, avg(avg_logprob) AS avg_logprob, avg(compression_ratio) AS compression_ratio FROM seg GROUP BY utt_id)"

SQL = {
    "s3_get_split": "SELECT doc_id, lang AS split, source FROM documents WHERE lang = 'fr'",
    "s2_dataset_round_trip": "SELECT lang AS split, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang",
    "s6_jsonl_scan": f"WITH {UTT} SELECT utt_id, speaker_id, sentence_id, CAST(length(text_raw) AS INT) AS chars, avg_logprob, duration FROM utt",
    "s7_done_ids": "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS utt_id FROM labels WHERE doc_id % 5 > 1",
    "s9_results_round_trip": f"{MEANS}, src AS (SELECT *, avg_logprob AS lp, compression_ratio AS cr FROM u), {_triage('src', 'utt_id')} SELECT bucket, reason, count(*) AS n, CAST(sum(text_length) AS BIGINT) AS chars FROM t GROUP BY ALL",
    "s14_bucket_files": f"{TRI} SELECT bucket, count(*) AS n FROM t GROUP BY bucket",
    "k4_review_cells": f"WITH {CAND} SELECT id, CASE WHEN single THEN rec || ' (0.900)' ELSE rec || ' (0.900) | ' || raw || ' (' || printf('%.3f', second) || ')' END AS cell FROM k",
    "k5_final_texts": f"WITH {EDIT} SELECT any_value(utt_id) AS utt_id, max(CASE WHEN span_start = 0 THEN final_text END) || substr(any_value(text), 5, 4) || max(CASE WHEN span_start = 8 THEN final_text END) || substr(any_value(text), 13) AS text_avail, 'human_review' AS resolved_from, count(*) AS resolution_count FROM e GROUP BY doc_id",
    "k7_shards": "SELECT o_orderkey // 200 AS shard, count(*) AS n FROM orders GROUP BY 1",
    "k8_shard_merge": "SELECT CAST(p_partkey AS INT) AS idx, p_brand AS speaker_id, p_retailprice AS duration FROM part",
    "f1_utterance_ids": "SELECT doc_id, source || '_' || doc_id AS utt_id, 'S' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INT), '0') AS speaker_id, lpad(CAST(doc_id AS VARCHAR), CAST(greatest(6, length(CAST(doc_id AS VARCHAR))) AS INT), '0') AS sentence_id FROM documents",
    "f2_records": f"WITH {UTT} SELECT utt_id, speaker_id, sentence_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 5 ELSE length(text_raw) END AS INT) AS chars, duration, language FROM utt",
    "f3_with_audio": "SELECT vec_id, label FROM embeddings WHERE vec_id % 4 <> 0",
    "f4_error_rows": "SELECT CAST(conv_id AS VARCHAR) AS sample_id, CASE WHEN conv_id % 7 = 0 THEN '[ERROR]' ELSE 'ok' END AS state, CASE WHEN conv_id % 7 = 0 THEN 'no audio' END AS error, conv_id % 7 = 0 AS failed FROM conversations GROUP BY conv_id",
    "f5_triage_features": r"SELECT doc_id, regexp_matches(text, '\d') AS has_digit, len(regexp_extract_all(text, '[a-zA-Z]')) AS latin_count, len(regexp_extract_all(text, '(?i)\d+\s*(?:cm|mm|m|km|kg|g|mg|ml|L|cc|%|도|원|개|명|번|회|시|분|초|년|월|일)')) + len(regexp_extract_all(text, '(?:제|약|총|각)\s*\d+')) AS unit_like_count FROM documents",
    "f6_text_flags": r"SELECT doc_id, regexp_matches(text, '\d') AS has_digit, regexp_matches(text, '[A-Za-z]') AS has_english, regexp_matches(text, '[^0-9A-Za-z가-힣\s]') AS has_symbol FROM documents",
    "f7_normalization_source": "WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN '' WHEN 2 THEN '[ERROR]' END AS v, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS r FROM documents), y AS (SELECT doc_id, CASE WHEN v IS NULL OR v = '' THEN r ELSE v END AS s FROM x) SELECT doc_id, CASE WHEN s NOT IN ('', '[ERROR]') THEN s END AS src FROM y",
    "f8_verified_rename": "SELECT source AS speaker_id, CAST(doc_id AS VARCHAR) AS sentence_id, CAST(length(text) AS INT) AS chars FROM documents",
    "f10_resolutions": f"WITH {EDIT} SELECT row_no, utt_id, span_start, span_end, raw_span, final_text, was_modified FROM e",
    "f11_marker_escape": "SELECT p_partkey, p_brand || '[[' || p_name || ']][[x]]' AS marked FROM part",
    "f12_context": """WITH x AS (SELECT *, doc_id % 50 AS s FROM documents) SELECT doc_id, substr(text, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)) AS "left", substr(text, s + 6, 40) AS "right" FROM x""",
    "j1_resume": f"WITH {UTT} SELECT utt_id, duration FROM utt WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "j2_original_texts": "SELECT CAST(conv_id AS VARCHAR) AS utt_id, arg_max(text, turn) AS original FROM conversations GROUP BY conv_id",
    "j5_overlaps": 'WITH l AS (SELECT l_orderkey, l_linenumber AS no, CAST(l_quantity AS INT) AS s, CAST(l_quantity + l_linenumber * 3 AS INT) AS e FROM lineitem), o AS (SELECT l_orderkey, m.s AS s, m.e AS e FROM (SELECT l_orderkey, min(struct_pack(no := no, s := s, e := e)) AS m FROM l GROUP BY ALL)) SELECT o.l_orderkey, coalesce(bool_or(l.no > 1 AND l.s < o.e AND o.s < l.e), FALSE) AS hit FROM o JOIN l USING (l_orderkey) GROUP BY o.l_orderkey',
    "j6_match_levels": rf"WITH x AS (SELECT doc_id, text AS g, regexp_replace(text, '[.,]', ' ', 'g') AS p FROM documents), y AS (SELECT doc_id, p, g, replace(regexp_replace(p, '{PUNCT}', '', 'g'), '·', '') AS p1, replace(regexp_replace(g, '{PUNCT}', '', 'g'), '·', '') AS g1 FROM x), z AS (SELECT *, {collapse('p1')} AS p2, {collapse('g1')} AS g2 FROM y) SELECT doc_id, p = g AS match_strict, p1 = g1 AS match_punct, p2 = g2 AS match_punct_space, regexp_replace(p2, '\s+', '', 'g') = regexp_replace(g2, '\s+', '', 'g') AS match_no_space FROM z",
    "t1_triage": f"{TRI} SELECT utt_id, bucket, reason, text_length, has_repetition FROM t",
    "a1_bucket_statistics": f"{TRI} SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (bucket = '{b}') AS {b.lower()}_count, count(*) FILTER (bucket = '{b}') / count(*) AS {b.lower()}_ratio" for b in "ABC") + " FROM t",
    "a2_summary": f"{TRI}, n AS (SELECT b, count(*) FILTER (bucket = b) AS k, count(*) AS total FROM t, (SELECT unnest(['A', 'B', 'C']) AS b) GROUP BY b) SELECT b AS bucket, printf('%s: %d (%.1f%%)', b, k, 100.0 * k / total) AS line FROM n",
    "a3_percentile_thresholds": f"WITH {UTT} SELECT quantile_cont(avg_logprob, 0.03) AS p_red, quantile_cont(avg_logprob, 0.15) AS p_orange, quantile_cont(avg_logprob, 0.40) AS p_yellow FROM utt",
    "w1_percentile_buckets": f"WITH {UTT}, p AS (SELECT quantile_cont(avg_logprob, 0.03) AS r, quantile_cont(avg_logprob, 0.15) AS o, quantile_cont(avg_logprob, 0.40) AS y FROM utt) SELECT utt_id, CASE WHEN avg_logprob <= r THEN 'RED' WHEN avg_logprob <= o THEN 'ORANGE' WHEN avg_logprob <= y THEN 'YELLOW' ELSE 'GREEN' END AS bucket FROM utt, p",
    "a5_weighted_means": f"WITH {SEG}, m AS (SELECT utt_id, CAST(length({_TEXT}) AS INT) AS chars, "
    + ", ".join(f"round(CASE WHEN sum(dur) > 0 THEN sum({c} * dur) / sum(dur) ELSE avg({c}) END, 9) AS {a}" for c, a in (("avg_logprob", "avg_logprob"), ("no_speech_prob", "avg_no_speech_prob"), ("compression_ratio", "compression_ratio")))
    + ", bool_or(hot) AS temperature_fallback FROM seg GROUP BY utt_id) SELECT CAST(doc_id AS VARCHAR) AS utt_id, coalesce(chars, 0) AS chars, coalesce(avg_logprob, -1.0) AS avg_logprob, coalesce(avg_no_speech_prob, 1.0) AS avg_no_speech_prob, coalesce(compression_ratio, 0.0) AS compression_ratio, coalesce(temperature_fallback, FALSE) AS temperature_fallback FROM documents LEFT JOIN m ON m.utt_id = CAST(doc_id AS VARCHAR)",
    "a6_plain_means": f"{MEANS} SELECT utt_id, text, round(avg_logprob, 9) AS avg_logprob, round(compression_ratio, 9) AS compression_ratio FROM u",
    "a8_resolution_groups": f"WITH {EDIT} SELECT utt_id, string_agg(final_text, '|' ORDER BY row_no) AS texts, count(*) AS n FROM e GROUP BY utt_id",
    "a9_hours": f"WITH {UTT} SELECT language, round(sum(duration) / 3600, 9) AS hours FROM utt GROUP BY language",
    "a9_real_time_factor": f"WITH {UTT} SELECT round(sum(compression_ratio) / sum(duration), 9) AS rtf FROM utt",
    "a10_describe": f"WITH {UTT} "
    + " UNION ALL ".join(f"SELECT '{c}' AS metric, CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM utt" for c in ("avg_logprob", "compression_ratio", "duration")),
    "a10_value_counts": f"WITH {UTT} SELECT language, count(*) AS n, count(*) FILTER (avg_logprob < -0.7) AS low, count(*) FILTER (compression_ratio > 4.0) AS high FROM utt GROUP BY language",
    "a11_bucket_counts": f"{TRI} SELECT CASE WHEN doc_id % 10 = 0 THEN 'unknown' ELSE bucket END AS bucket, count(*) AS n FROM t GROUP BY 1",
    "a12_shard_counts": "SELECT lang AS language, count(*) AS n, count(*) = 100 AS expected FROM documents GROUP BY lang",
    "a13_risk_scores": "SELECT page_id, 2.0::DOUBLE AS risk FROM pages",
    "w2_equal_words": r"WITH s1 AS (SELECT doc_id, text, string_split(text, '') AS c, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents) SELECT doc_id, length(text) >= 6 AND (len(list_filter(range(1, greatest(len(c) - 4, 1)), lambda i: c[i] = c[i+2] AND c[i+1] = c[i+3] AND c[i] = c[i+4] AND c[i+1] = c[i+5])) > 0 OR len(list_filter(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] = w[i+1] AND w[i] = w[i+2])) > 0) AS repeated FROM s1",
    "n1_digit_words": f"SELECT p_partkey, array_to_string(list_transform(string_split(CAST(p_partkey AS VARCHAR), ''), lambda c: substr('{DIG}', CAST(c AS INT) + 1, 1)), '␣') AS said FROM part",
    "n2_sino_under_100": f"SELECT p_partkey, {sino('(p_partkey % 100)', 1)} AS said FROM part",
    "n3_sino_under_10000": f"SELECT p_partkey, {sino('(p_partkey * 37 % 10000)', 1)} AS said FROM part",
    "n4_sino": f"WITH k AS (SELECT o_orderkey AS id, o_orderkey * 7919 * 104729 % 1000000000000000 AS n FROM orders) SELECT id, {sino('n')} AS said FROM k",
    "n5_native": f"SELECT p_partkey, {native('(p_partkey % 120)', 1)} AS said FROM part",
    "n7_hours": f"SELECT p_partkey, CASE WHEN p_partkey % 25 BETWEEN 1 AND 12 THEN {native('(p_partkey % 25)', 1)} ELSE {sino('(p_partkey % 25)', 1)} END AS said FROM part",
    "z1_symbols": "SELECT p_partkey, p_size || '도씨 ' || p_size || '␣퍼센트␣ 5␣도␣ km' AS said FROM part",
    "z2_letters": "SELECT p_partkey, '5km ' || array_to_string(list_transform(string_split(p_type, ''), lambda c: coalesce(map(string_split('ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''), string_split('에이 비 씨 디 이 에프 지 에이치 아이 제이 케이 엘 엠 엔 오 피 큐 알 에스 티 유 브이 더블유 엑스 와이 지', ' '))[upper(c)], c)), '') AS said FROM part",
    "z3_ssi": "SELECT p_partkey, '김철수␣씨가 ' || p_size || '씨앗 박␣씨' AS said FROM part",
    "z4_covid": "SELECT p_partkey, '코로나␣일구 코로나␣일구 코로나19가 ' || p_size AS said FROM part",
    "z_number_units": " UNION ALL ".join(
        [
            f"SELECT p_partkey AS id, 'count' AS kind, {spaced(native('p_size', 1))} || ' 개를 샀다' AS said FROM part",
            f"SELECT p_partkey, 'hour', {spaced('CASE WHEN p_size BETWEEN 1 AND 12 THEN ' + native('p_size', 1) + ' ELSE ' + sino('p_size', 1) + ' END')} || ' 시에 왔다' FROM part",
            f"SELECT o_orderkey, 'price', {spaced(sino(M))} || ' 원' FROM orders",
            f"SELECT p_partkey, 'machine', {spaced('CASE WHEN p_size < 10 THEN ' + native('p_size', 1) + ' ELSE ' + sino('p_size', 1) + ' END')} || ' 대가' FROM part",
            f"SELECT p_partkey, 'distance', {spaced(sino('p_size', 1))} || ' 점 오 키로미터' FROM part",
            f"SELECT p_partkey, 'big', {spaced(sino('p_size', 1))} || ' 억 원' FROM part",
            f"SELECT p_partkey, 'man', {spaced(sino('(p_size * 10000 + 1300)', 2))} || ' 명' FROM part",
            f"SELECT o_orderkey, 'bare', {spaced(sino(M))} FROM orders",
        ]
    ),
    "z6_approximate": f"SELECT p_partkey, {sino('p_size', 1)} || '␣만␣여명이' AS said FROM part",
    "z9_special_counters": f"SELECT p_partkey, '형사␣' || {sino('p_size', 1)} || '␣부의 제␣' || {sino('p_size', 1)} || '␣회' AS said FROM part",
    "z12_punctuation": f"SELECT doc_id, {collapse(f'''regexp_replace(replace(text, '·', ''), '{PUNCT}', ' ', 'g')''')} AS bare FROM documents",
    "z13_compounds": "SELECT p_partkey, p_brand || ' ' || ['국민 체육공원에서', '자작나무 숲은', '대통령 배', '두배', '빈 차', '마을버스 운송사업조합이', '잣나무숲', '사과나무'][p_partkey % 8 + 1] AS spaced FROM part",
    "z14_particles": "SELECT p_partkey, p_name || '을 보고 ' || p_size || '에서는' AS joined FROM part",
    "z15_glue": "SELECT p_partkey, p_name || ' 이번 저번 ' || p_size AS glued FROM part",
    "y3_normalized_text": f"SELECT doc_id AS idx, CASE WHEN doc_id % 5 = 0 THEN '' ELSE {collapse('text')} END AS normalized_text FROM documents",
    "p2_addresses": """SELECT page_id, 0 AS start, CAST(length(url) AS INT) AS "end", url AS text FROM pages""",
    "p3_latin_runs": r"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]{2,}')) AS runs, len(regexp_extract_all(text, '[A-Za-z]+\d+[A-Za-z\d]*|\d+[A-Za-z]+[A-Za-z\d]*')) AS mixed FROM documents",
    "p4_digit_runs": r"SELECT doc_id, len(regexp_extract_all(text, '\d[\d,.\-]*\d|\d')) AS runs, array_to_string(regexp_extract_all(text, '\d[\d,.\-]*\d|\d'), ' ') AS texts FROM documents",
    "p5_number_context": "SELECT p_partkey, [['이십'], [], ['일이삼'], ['일이'], [], []][p_partkey % 6 + 1] AS found FROM part",
    "d1_edit_ratio": "SELECT p_partkey, CAST(levenshtein(p_name, p_type) AS DOUBLE) / greatest(length(p_name), length(p_type)) AS ratio FROM part",
    "d2_margin": f"WITH {CAND} SELECT id, round(margin, 9) AS margin FROM k",
    "d3_mixed_script": "SELECT p_partkey, p_partkey % 2 = 0 AND regexp_matches(p_name, '[A-Za-z]') AS mixed FROM part",
    "d4_only_symbols": "SELECT p_partkey, p_partkey % 5 IN (0, 1, 4) AS symbols FROM part",
    "d5_span_actions": f"WITH {CAND} SELECT id, CASE WHEN rec = '...' OR ratio > 0.35 OR tag IN ('U1', 'OOV') THEN 'NEEDS_REVIEW' WHEN tag = 'N3' THEN CASE WHEN bucket IN ('GREEN', 'YELLOW') AND margin >= 0.25 AND ratio <= 0.2 THEN 'AUTO_FIX' ELSE 'NEEDS_REVIEW' END WHEN bucket = 'GREEN' AND margin >= 0.35 AND ratio <= 0.15 THEN 'AUTO_FIX' ELSE 'NEEDS_REVIEW' END AS action FROM k",
    "d6_sentence_actions": f"WITH {CAND} SELECT id, CASE WHEN bucket = 'GREEN' AND tag <> 'U1' AND ratio <= 0.18 THEN 'AUTO_FIX' ELSE 'NEEDS_REVIEW' END AS action FROM k",
    "m1_prompts": "SELECT p_partkey, t AS task, CASE WHEN t = 'STW_CANON' THEN '<STW_CANON>' || chr(10) || p_name || chr(10) || '</STW_CANON>' ELSE '<' || t || '>' || chr(10) || 'LEFT: ' || p_brand || chr(10) || 'SPAN: ⟦' || p_name || '⟧' || chr(10) || 'RIGHT: ' || p_type || chr(10) || '</' || t || '>' END AS prompt FROM part, (SELECT unnest(['STW_CANON', 'STW_SPAN', 'STW_URL']) AS t)",
    "m3_ranked": f"WITH {CAND}, c AS (SELECT id, raw AS text, 1.0 AS score, 9 AS place FROM k UNION ALL SELECT id, tag, 0.5, 10 FROM k UNION ALL SELECT id, rec, 0.9, 0 FROM k UNION ALL SELECT id, raw, second, 1 FROM k WHERE NOT single), b AS (SELECT id, text, max(score) AS score, min(place) FILTER (score = m) AS place FROM (SELECT *, max(score) OVER (PARTITION BY id, text) AS m FROM c) GROUP BY id, text) SELECT id, string_agg(text, '|' ORDER BY score DESC, place) AS texts FROM b GROUP BY id",
    "x3_apply_fixes": "SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN substr(p_type, 1, 4) || '<A>' || substr(p_type, 8) WHEN 3 THEN substr(p_type, 1, 3) || '<B>' || substr(p_type, 6) WHEN 0 THEN '<A><B>' || substr(p_type, 6) ELSE substr(p_type, 1, 3) || '<B>' || substr(p_type, 6) END AS fixed FROM part",
    "x4_apply_resolutions": "SELECT source || '_' || doc_id AS utt_id, CASE WHEN length(text) >= 20 THEN '<R>' || substr(text, 5, 4) || '<R>' || substr(text, 13) ELSE text END AS text_fixed FROM documents",
    "y1_json_round_trip": f"WITH {CAND} SELECT id, TRUE AS same, CAST(CASE WHEN single THEN 1 ELSE 2 END AS BIGINT) AS n FROM k",
    "l1_span_order": 'SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS INT), CAST(l_quantity + l_linenumber AS INT) DESC, l_linenumber) AS INT) AS place FROM lineitem',
    "l2_recommended": f"WITH {CAND} SELECT id, rec AS recommended FROM k",
    "l5_merged_order": f"{TRI} SELECT speaker_id, sentence_id, bucket FROM t",
    "l6_first_rows": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 200",
    "l8_mismatches": "WITH x AS (SELECT doc_id AS i, text AS g, coalesce(CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN replace(text, '.', '') WHEN 2 THEN replace(text, ' ', '') END) AS p FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 200)) SELECT i, CAST(length(p) AS INT) AS pred_chars, CAST(length(g) AS INT) AS gold_chars FROM x WHERE coalesce(p, '') <> g ORDER BY i LIMIT 25",
    "a7_accuracy": rf"WITH x AS (SELECT doc_id, text AS g, coalesce(CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN replace(text, '.', '') WHEN 2 THEN replace(text, ' ', '') END, '') AS p FROM documents ORDER BY doc_id LIMIT 200), y AS (SELECT *, replace(regexp_replace(p, '{PUNCT}', '', 'g'), '·', '') AS p1, replace(regexp_replace(g, '{PUNCT}', '', 'g'), '·', '') AS g1 FROM x), z AS (SELECT *, {collapse('p1')} AS p2, {collapse('g1')} AS g2 FROM y), q AS (SELECT count(*) AS rows, count(*) FILTER (regexp_matches(g, '\d')) AS has_digit, count(*) FILTER (regexp_matches(g, '[A-Za-z]')) AS has_english, count(*) FILTER (regexp_matches(g, '[^0-9A-Za-z가-힣\s]')) AS has_symbol, count(*) FILTER (p = g) AS match_strict, count(*) FILTER (p1 = g1) AS match_punct, count(*) FILTER (p2 = g2) AS match_punct_space, count(*) FILTER (regexp_replace(p2, '\s+', '', 'g') = regexp_replace(g2, '\s+', '', 'g')) AS match_no_space FROM z) SELECT *, match_strict / rows AS ratio_strict, match_punct / rows AS ratio_punct, match_punct_space / rows AS ratio_punct_space, match_no_space / rows AS ratio_no_space FROM q",
    "l7_longest_span": f"WITH {EDIT}, f AS (SELECT doc_id, any_value(utt_id) AS utt_id, max(CASE WHEN span_start = 0 THEN raw_span END) AS a, max(CASE WHEN span_start = 0 THEN final_text END) AS fa, max(CASE WHEN span_start = 8 THEN final_text END) AS fb FROM e GROUP BY doc_id) SELECT utt_id, a AS text_raw, fa || fb AS text_avail FROM f WHERE FALSE",
    "u1_union": f"{TRI} SELECT bucket, count(*) AS n, CAST(sum(length(text_raw)) AS BIGINT) AS chars FROM t GROUP BY bucket",
    "u3_dedupe": f"WITH {CAND} SELECT id, text, max(score) AS score FROM (SELECT id, rec AS text, CAST(0.9 AS DOUBLE) AS score FROM k UNION ALL SELECT id, raw, second FROM k WHERE NOT single) GROUP BY ALL",
    "u4_difference": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "cer": "SELECT round(CAST(sum(levenshtein(p_name, p_type)) AS DOUBLE) / sum(length(p_type)), 9) AS cer FROM part",
    "e2_label_pipeline": f"{MEANS}, src AS (SELECT *, avg_logprob AS lp, compression_ratio AS cr FROM u), {_triage('src', 'utt_id, avg_logprob')} SELECT utt_id AS sample_id, bucket, reason, text_length, has_repetition, round(avg_logprob, 9) AS avg_logprob FROM t",
}
