"""SQL for the queries of this folder that SQL can express, written apart from the operators."""

from __future__ import annotations

from malgeul.llm.license_scan import DIGESTS, PHRASES, SPELLINGS

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *, lag(role) OVER w AS previous, row_number() OVER w AS place,
         length(regexp_replace(text, '([\\#<])', '\1\\', 'g')) AS body,
         length(regexp_replace(role, '([\\#<])', '\1\\', 'g')) AS head
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + CASE WHEN previous = role THEN 7 WHEN previous IS NULL THEN head + 12 ELSE head + 20 END) + 8 AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

BM25 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents) AS mean),
idf AS (SELECT term, ln(1 + (total.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, total GROUP BY term, total.n),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(q.tf * idf.idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * l.n / total.mean))), 4) AS score
  FROM tf q JOIN idf USING (term) JOIN tf d USING (term) JOIN lengths l ON l.doc_id = d.doc_id, total
  WHERE q.doc_id % 20 = 0 GROUP BY ALL
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores WHERE score > 0)
SELECT query_id, doc_id, score, rank FROM ranked WHERE rank <= 10
"""

_HEX = "CAST(('0x' || substr(md5(pattern), {}, 4)) AS BIGINT)"
URL_FILTER = rf"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 365 AS INT) AS fetched,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)', 1)), '.') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS folders
  FROM pages
), looked AS (
  SELECT page_id, url, fetched, host || '/' || array_to_string(folders[1:n], '/') AS pattern, -n AS rank FROM (SELECT *, unnest(range(1, len(folders) + 1)) AS n FROM captures WHERE host <> '')
  UNION ALL
  SELECT page_id, url, fetched, host, 1 FROM captures WHERE host <> ''
  UNION ALL
  SELECT page_id, url, fetched, array_to_string(string_split(host, '.')[i:], '.'), i
  FROM (SELECT *, unnest(range(2, len(string_split(host, '.')))) AS i FROM captures WHERE host <> '' AND NOT regexp_matches(host, '^\[|^[0-9.]+$'))
), named AS (SELECT DISTINCT pattern, {_HEX.format(1)} AS a, {_HEX.format(5)} AS b, {_HEX.format(9)} AS c FROM looked),
spells AS (
  SELECT pattern, 'category' || c % 3 AS category, DATE '2024-01-01' + CAST(b % 300 AS INT) AS since,
         CASE WHEN a % 2 = 0 THEN DATE '2024-01-01' + CAST(b % 300 + 20 + c % 60 AS INT) END AS until
  FROM named WHERE a % 4 < 2
  UNION ALL
  SELECT pattern, 'category' || c % 3, DATE '2024-01-01' + CAST(b % 300 + 120 + c % 60 AS INT), NULL FROM named WHERE a % 4 = 0
), met AS (
  SELECT page_id, looked.url, looked.fetched, arg_min(struct_pack(p := spells.pattern, c := category, s := since), rank) AS best
  FROM looked JOIN spells ON spells.pattern = looked.pattern AND since <= looked.fetched AND (until IS NULL OR looked.fetched < until)
  GROUP BY ALL
)
SELECT c.page_id, c.url, c.fetched, best IS NOT NULL AS blocked, best.p AS pattern, best.c AS category, best.s AS since
FROM captures c LEFT JOIN met ON met.page_id = c.page_id AND met.url = c.url AND met.fetched = c.fetched
"""


# Of the rows of whole licences that the query adds, the digests and ids, and the digests of the texts that the operator has; all made
# by a plain program over the same public texts.
PROBES = """
  (-1, '0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c', 'MIT'),
  (-2, '35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164', 'MIT'),
  (-3, '6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127', 'MIT'),
  (-4, 'a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30', 'BSD-2-Clause'),
  (-5, '447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2', 'BSD-2-Clause'),
  (-6, '9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2', 'BSD-3-Clause'),
  (-7, 'cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15', 'BSD-3-Clause'),
  (-8, '217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a', 'ISC'),
  (-9, 'f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee', 'ISC'),
  (-10, '25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c', '0BSD'),
  (-11, '9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153', '0BSD'),
  (-12, '1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7', 'Zlib'),
  (-13, '28de6b6f31af692f3276f4c7d7f809bc7d39d3206a71fe090d61d943447aabc6', 'Apache-2.0'),
  (-14, '123a3b9fdc300d1b6f077f74b288de15d7f2c5b0b3b11e89fd799b48bfad5940', 'MIT'),
  (-15, 'e34399ae0e957e9bb9b4a0e3f615d05722861801f4e0718f35cefc762c349a16', 'CC-BY-NC-4.0'),
  (-16, '37d45dc3b9135ed58bd277e14112dfea95629cda77a8d62cdb6bcd862e7b5bf5', 'GPL-3.0-only')"""
KNOWN = """
  ('25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c', '0BSD'),
  ('9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153', '0BSD'),
  ('28de6b6f31af692f3276f4c7d7f809bc7d39d3206a71fe090d61d943447aabc6', 'Apache-2.0'),
  ('447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2', 'BSD-2-Clause'),
  ('a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30', 'BSD-2-Clause'),
  ('9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2', 'BSD-3-Clause'),
  ('cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15', 'BSD-3-Clause'),
  ('e34399ae0e957e9bb9b4a0e3f615d05722861801f4e0718f35cefc762c349a16', 'CC-BY-NC-4.0'),
  ('37d45dc3b9135ed58bd277e14112dfea95629cda77a8d62cdb6bcd862e7b5bf5', 'GPL-3.0-only'),
  ('217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a', 'ISC'),
  ('f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee', 'ISC'),
  ('0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c', 'MIT'),
  ('123a3b9fdc300d1b6f077f74b288de15d7f2c5b0b3b11e89fd799b48bfad5940', 'MIT'),
  ('35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164', 'MIT'),
  ('6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127', 'MIT'),
  ('1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7', 'Zlib')"""


def _license() -> str:
    wide = lambda s: " " + s.replace(" ", "  ") + " "
    chain = "' ' || replace(bare, ' ', '  ') || ' '"
    for a, b in [*PHRASES.items(), *SPELLINGS.items()]:
        chain = f"replace({chain}, '{wide(a)}', '{wide(b)}')"
    listed = ", ".join(f"('{d}', '{n}')" for n, d in DIGESTS)
    line = r"regexp_matches(l, '^[ \t#*/;%-]*(?:©|\(c\)[ \t]*(?:copyright\b|(?:19|20)\d\d)|copyright\b|all rights reserved\.?[ \t\r]*$)')"
    body = r"""regexp_matches(l, '^[ \t#*/;%-]*copyright\b[ \t]*(?:$|[,.;)"''\[<{]|(?:holders?|owners?|notices?|laws?|licen[cs]es?|statements?|interests?|and[ \t]+(?:this|permission|related)|or|in|of|is|to)\b)')"""
    bare = r"trim(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    return rf"""
WITH low AS (SELECT doc_id, lower(coalesce(text, '')) AS t, list_filter(string_split(lower(coalesce(text, '')), chr(10)), lambda l: {line} AND NOT {body}) AS cut FROM documents),
texts AS (
  SELECT doc_id, 0 AS whole, array_to_string(list_filter(string_split(t, chr(10)), lambda l: NOT ({line} AND NOT {body})), chr(10)) AS t FROM low
  UNION ALL SELECT doc_id, 1, t FROM low WHERE len(cut) > 0
), bare AS (SELECT doc_id, whole, {bare.format("t")} AS bare FROM texts),
digests AS (SELECT doc_id, whole, sha256(trim(replace({chain}, '  ', ' '))) AS digest FROM bare),
known(digest, license_id) AS (SELECT col0, min(col1) FROM (VALUES {KNOWN}, {listed}) GROUP BY col0)
SELECT doc_id, max(digest) FILTER (whole = 0) AS digest, coalesce(max(license_id) FILTER (whole = 0), max(license_id)) AS license_id
FROM digests LEFT JOIN known USING (digest) GROUP BY doc_id
UNION ALL SELECT * FROM (VALUES {PROBES})
"""


JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
components AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN components ON a = doc_id
"""

SQL = {"op1_bm25_search": BM25, "op3_url_filter": URL_FILTER, "op4_chat_format": CHAT, "op5_license_scan": _license(), "op10_ngram_jaccard": JACCARD}
