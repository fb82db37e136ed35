"""DuckDB SQL of the registered queries: one chain of common table expressions and a last SELECT each."""

from __future__ import annotations

from ..functions import lexicon as lx
from ..operators.scoring import BIAS, WEIGHTS
from ..sources.fixtures import CITIES, STREETS, SUFFIXES, SYLLABLES


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ",".join(map(_text, words)) + "]"


def _word(k: str) -> str:
    return " || ".join(f"{_list(SYLLABLES)}[(((({k}) * 7919) % 83521) // {d}) % 17 + 1]" for d in (1, 17, 289, 4913))


#: What strip_accents leaves of the Latin letters and signs in the tables; a rule of its own, apart from the engine's table.
LEFT = {"ß": "ss", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "’": "'", "‘": "'", "–": "-", "—": "--", "…": "...", "\xa0": " "}


def _clean(c: str) -> str:
    s = f"CASE WHEN {c} IS NULL OR {c} = 'null' THEN '' ELSE {c} END"
    for a, b in LEFT.items():
        s = f"replace({s}, '{a}', {_text(b)})"
    s = f"lower(regexp_replace(strip_accents({s}), '[^\\x00-\\x7F]', '', 'g'))"
    for pattern, new in lx.CLEANING:
        s = f"regexp_replace({s}, {_text(pattern)}, {_text(new)}, 'g')"
    return f"trim({s})"


def _tokens(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


FIXTURE = f"""
b0 AS (SELECT c_custkey AS k, p_name AS p, r_name AS country, {_word("c_custkey")} AS w, {_word("c_custkey + 1")} AS w1,
  CAST(c_custkey % 997 + 1 AS VARCHAR) AS num, CAST(c_custkey % 997 + 2 AS VARCHAR) AS num1,
  {_list(STREETS)}[c_custkey % 8 + 1] AS street, {_list(CITIES)}[c_custkey % 12 + 1] AS city, {_list(SUFFIXES)}[c_custkey % 6 + 1] AS suffix
  FROM customer JOIN part ON c_custkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b1 AS (SELECT 1 AS src, 'S1-' || k AS entity_id, 1 AS v, 0 AS a, * FROM b0
  UNION ALL SELECT 2, 'S2-' || k, k % 6, k % 5, * FROM b0 WHERE k % 7 <> 0
  UNION ALL SELECT 3, 'S3-' || k, (k + 3) % 6, (k + 2) % 5, * FROM b0 WHERE k % 5 <> 0
  UNION ALL SELECT 4, 'S2-X' || k, 1, 0, * FROM b0 WHERE k % 10 = 3),
biz AS (SELECT src, entity_id, country, k AS ordinal,
  CASE WHEN src = 1 THEN w || ' ' || p || ' ' || suffix WHEN src = 4 THEN w1 || ' ' || p || ' ' || suffix
    WHEN v = 0 THEN upper(w || ' ' || p || ' ' || suffix) WHEN v = 1 THEN w || ' ' || p WHEN v = 2 THEN p || ' ' || w || ' ' || suffix
    WHEN v = 3 THEN substr(w, 1, 2) || substr(w, 4) || ' ' || p || ' ' || suffix
    WHEN v = 4 THEN replace(w || ' ' || p, 'e', 'é') || ' ' || suffix ELSE w || ' ' || p || '.com' END AS business_name,
  CASE WHEN src = 1 THEN num || ' ' || street || ', ' || city WHEN src = 4 THEN num1 || ' ' || street || ', ' || city
    WHEN k % 23 = 0 THEN 'null' WHEN a = 3 THEN '' WHEN a = 4 THEN num || 'b ' || street || ' ' || city
    WHEN a = 1 THEN '00' || num || ' ' || street || ', ' || city
    WHEN a = 2 THEN num || ' ' || replace(replace(street, 'Street', 'St'), 'Road', 'Rd') || ', ' || city
    ELSE num || ' ' || street || ', ' || city END AS business_address FROM b1),
truth AS (SELECT 'S1-' || c_custkey AS s1_id, 'S2-' || c_custkey AS tid FROM customer WHERE c_custkey % 7 <> 0
  UNION ALL SELECT 'S1-' || c_custkey, 'S3-' || c_custkey FROM customer WHERE c_custkey % 5 <> 0)"""

NORM = f"""
n0 AS (SELECT *, {_clean("business_name")} AS clean_name, {_clean("business_address")} AS ca FROM biz),
n1 AS (SELECT *, {_tokens("clean_name")} AS nt, list_transform(regexp_extract_all(ca, '\\b(\\d+)\\b', 1), lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END) AS nn,
  list_transform({_tokens("ca")}, lambda t: coalesce(map_extract(MAP({_list(lx.EXPANSIONS)}, {_list(lx.EXPANSIONS.values())}), t)[1], t)) AS aw FROM n0),
n2 AS (SELECT *, list_filter(nt, lambda t: NOT list_contains({_list(lx.LEGAL_SUFFIXES)}, t)) AS lt FROM n1),
n3 AS (SELECT *, CASE WHEN len(lt) > 0 THEN lt ELSE nt END AS ct FROM n2),
norm AS (SELECT src, entity_id, country, ordinal, clean_name, nt, array_to_string(aw, ' ') AS clean_addr, nn[1] AS primary_num, list_distinct(nn) AS nums, nn,
  array_to_string(CASE WHEN len(ct) > 1 AND list_contains({_list(lx.ARTICLES)}, ct[1]) THEN ct[2:] ELSE ct END, ' ') AS core_name FROM n3)"""

KEYS = f"""
k0 AS (SELECT entity_id, src, country, core_name, {_tokens("core_name")} AS n, {_tokens("clean_addr")} AS a, nums FROM norm),
k1 AS (SELECT *, list_filter(a, lambda t: NOT list_contains({_list(lx.COMMON_ADDRESS_WORDS)}, t) AND length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$')) AS sig FROM k0),
name_keys AS (
  SELECT entity_id, src, country, 'compact_n' AS ktype, array_to_string(n, '') AS kval FROM k1 WHERE length(array_to_string(n, '')) >= 4
  UNION SELECT entity_id, src, country, 'compact_sort_n', array_to_string(list_sort(n), '') FROM k1 WHERE length(array_to_string(n, '')) >= 4
  UNION SELECT entity_id, src, country, 'core_n', core_name FROM k1 WHERE length(core_name) >= 3
  UNION SELECT entity_id, src, country, 'n2', n[1] || '_' || n[2] FROM k1 WHERE len(n) >= 2
  UNION SELECT entity_id, src, country, 'sort_n', array_to_string(list_sort(n), ' ') FROM k1 WHERE len(n) >= 2
  UNION SELECT entity_id, src, country, 'n1', n[1] FROM k1 WHERE len(n) = 1 AND length(n[1]) >= 3
  UNION SELECT entity_id, src, country, 'n_tok', t FROM (SELECT *, unnest(n) AS t FROM k1) WHERE length(t) >= 4 AND NOT list_contains({_list(lx.LEGAL_SUFFIXES + lx.ARTICLES)}, t)),
kn AS (SELECT *, unnest(nums) AS x FROM k1),
address_keys AS (
  SELECT entity_id, src, country, 'num_city1' AS ktype, x || '_' || a[-1] AS kval FROM kn WHERE len(a) >= 1
  UNION SELECT entity_id, src, country, 'num_city2', x || '_' || a[-2] FROM kn WHERE len(a) >= 2
  UNION SELECT entity_id, src, country, 'num_street', x || '_' || unnest(sig[1:3]) FROM kn
  UNION SELECT entity_id, src, country, 'name_num', n[1] || '_' || x FROM kn WHERE len(n) >= 1
  UNION SELECT entity_id, src, country, 'name_num2', n[2] || '_' || x FROM kn WHERE len(n) >= 2
  UNION SELECT entity_id, src, country, 'name_city', n[1] || '_' || a[-1] FROM k1 WHERE len(n) >= 1 AND len(a) >= 1
  UNION SELECT entity_id, src, country, 'name_city2', n[1] || '_' || a[-2] FROM k1 WHERE len(n) >= 1 AND len(a) >= 2
  UNION SELECT entity_id, src, country, 'addr_pair', least(sig[i], sig[j]) || '_' || greatest(sig[i], sig[j])
    FROM k1, (VALUES (1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)) AS p(i, j) WHERE len(sig) >= j),
keys AS (SELECT * FROM name_keys UNION ALL SELECT * FROM address_keys),
freq AS (SELECT country, ktype, kval, count(*) AS postings FROM keys WHERE src > 1 GROUP BY ALL),
active AS (SELECT t.* FROM keys t JOIN freq USING (country, ktype, kval) WHERE t.src > 1 AND postings <= CASE WHEN regexp_matches(ktype, '^(n|core|compact)') THEN 250 ELSE 100 END)"""

PAIRS = """
pairs AS (SELECT s.country, s.entity_id AS s1_id, t.entity_id AS tid, count(*) AS shared_keys FROM keys s JOIN active t USING (country, ktype, kval) WHERE s.src = 1 GROUP BY ALL),
topk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, s1_id ORDER BY shared_keys DESC, tid) AS rank FROM pairs) WHERE rank <= 20)"""


def _lev(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> '' AND {b} <> '' THEN 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) ELSE 0.0 END"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END"


def _both(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN {_both(a, b)} / len(list_distinct(list_concat({a}, {b}))) ELSE 0.0 END"


def _grams(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN [] ELSE list_distinct(list_transform(range(1, greatest(length({c}) - 2, 1) + 1), lambda i: substr({c}, i, 3))) END"


_ADDR = "(clean_addr1 <> '' AND clean_addr2 <> '')"
_CORES = "(core_name1 <> '' AND core_name2 <> '')"
_KNOWN = f"({_ADDR} AND primary_num1 IS NOT NULL AND primary_num2 IS NOT NULL)"
_FIRST = _lev("string_split(core_name1, ' ')[1]", "string_split(core_name2, ' ')[1]")


def _addr(x: str) -> str:
    return f"CASE WHEN {_ADDR} THEN ({x}) ELSE 0.0 END"


NATIVE = {
    "name_exact_clean": _flag("clean_name1 = clean_name2 AND clean_name1 <> ''"),
    "name_exact_core": _flag(f"core_name1 = core_name2 AND {_CORES}"),
    "name_lev_sim": _lev("clean_name1", "clean_name2"),
    "name_token_jaccard": _jaccard("t1", "t2"),
    "name_token_overlap": f"CASE WHEN {_CORES} THEN {_both('t1', 't2')} / least(len(t1), len(t2)) ELSE 0.0 END",
    "name_len_diff": "abs(length(clean_name1) - length(clean_name2))",
    "name_len_ratio": "CASE WHEN greatest(length(clean_name1), length(clean_name2)) > 0 THEN least(length(clean_name1), length(clean_name2)) / greatest(length(clean_name1), length(clean_name2)) ELSE 0.0 END",
    "name_prefix_match": _flag("length(core_name1) >= 4 AND length(core_name2) >= 4 AND substr(core_name1, 1, 4) = substr(core_name2, 1, 4)"),
    "name_char_3gram": _jaccard("g1", "g2"),
    "name_first_token_match": _flag(f"{_CORES} AND ({_FIRST}) >= 0.80"),
    "name_first_token_conflict": _flag(f"{_CORES} AND ({_FIRST}) < 0.50"),
    "addr_has_val": _flag("clean_addr2 <> ''"),
    "addr_exact_clean": _addr(_flag("clean_addr1 = clean_addr2")),
    "addr_lev_sim": _lev("clean_addr1", "clean_addr2"),
    "addr_token_jaccard": _addr(_jaccard("d1", "d2")),
    "num_common_count": _addr(_both("nums1", "nums2")),
    "num_has_match": _addr(_flag(f"{_both('nums1', 'nums2')} > 0")),
    "num_has_mismatch": _addr(_flag(f"{_both('nums1', 'nums2')} = 0 AND len(nums1) > 0 AND len(nums2) > 0")),
    "primary_num_match": _flag(f"{_KNOWN} AND primary_num1 = primary_num2"),
    "primary_num_mismatch": _flag(f"{_KNOWN} AND primary_num1 <> primary_num2"),
    "primary_num_diff": f"CASE WHEN {_KNOWN} THEN ln(1 + abs(CAST(primary_num1 AS BIGINT) - CAST(primary_num2 AS BIGINT))) ELSE 0.0 END",
    "exact_core_no_addr": _flag(f"clean_addr2 = '' AND core_name1 = core_name2 AND {_CORES}"),
    "is_source2": _flag("tid LIKE 'S2-%'"),
    "is_source3": _flag("tid LIKE 'S3-%'"),
    "shared_keys_count": "shared_keys",
}

_SIDE = ", ".join(f"{s}.{c} AS {c}{i}" for i, s in ((1, "l"), (2, "r")) for c in ("clean_name", "core_name", "clean_addr", "nums", "primary_num"))
SIDES = f"""
sides AS (SELECT c.*, l.ordinal AS s1_ordinal, {_SIDE}, {_tokens("l.core_name")} AS t1, {_tokens("r.core_name")} AS t2, {_grams("l.core_name")} AS g1, {_grams("r.core_name")} AS g2,
  {_tokens("l.clean_addr")} AS d1, {_tokens("r.clean_addr")} AS d2
  FROM topk c JOIN norm l ON l.src = 1 AND l.entity_id = c.s1_id JOIN norm r ON r.src > 1 AND r.entity_id = c.tid AND r.country = c.country),
f0 AS (SELECT * REPLACE (list_distinct(t1) AS t1, list_distinct(t2) AS t2, list_distinct(d1) AS d1, list_distinct(d2) AS d2) FROM sides),
feat AS (SELECT country, s1_id, tid, s1_ordinal, primary_num1, primary_num2, {", ".join(f"CAST({x} AS DOUBLE) AS {n}" for n, x in NATIVE.items())} FROM f0)"""


def _common(a: str, b: str) -> str:
    """Length of the longest common subsequence: the table's column as the bits of one number, a character of b after another. Texts of up to 120 characters."""
    masks = f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN 1::HUGEINT << i::HUGEINT ELSE 0::HUGEINT END))::HUGEINT)"
    every = f"((1::HUGEINT << length({a})::HUGEINT) - 1)"
    step = f"((v + (v & m)) | (v & ({every} - m))) & {every}"
    return f"(length({a}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {every})))"


def _token_ratios(a: str, b: str) -> str:
    """CTEs that give, for each distinct pair of two texts, their sorted-token and token-set similarities."""
    la, lb, both = "length(ra)", "length(rb)", "length(shared)"
    gap = f"(CASE WHEN {both} > 0 THEN 1 ELSE 0 END)"
    wa, wb = f"({both} + {gap} + {la})", f"({both} + {gap} + {lb})"
    rests = f"(1 - ({la} + {lb} - 2 * CASE WHEN ra = '' OR rb = '' THEN 0 ELSE {_common('ra', 'rb')} END) / ({wa} + {wb}))"
    sorts = f"(1 - (length(sa) + length(sb) - 2 * {_common('sa', 'sb')}) / (length(sa) + length(sb)))"
    return f"""
texts AS (SELECT DISTINCT {a} AS x, {b} AS y FROM f0),
listed AS (SELECT x, y, list_sort({_tokens("x")}) AS tx, list_sort({_tokens("y")}) AS ty FROM texts),
cut AS (SELECT x, y, array_to_string(tx, ' ') AS sa, array_to_string(ty, ' ') AS sb, array_to_string(list_sort(list_intersect(list_distinct(tx), list_distinct(ty))), ' ') AS shared,
  array_to_string(list_sort(list_filter(list_distinct(tx), lambda t: NOT list_contains(ty, t))), ' ') AS ra,
  array_to_string(list_sort(list_filter(list_distinct(ty), lambda t: NOT list_contains(tx, t))), ' ') AS rb FROM listed),
ratios AS (SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0.0 ELSE jaro_winkler_similarity(x, y) END AS jw,
  CASE WHEN x = '' OR y = '' THEN 0.0 WHEN sa = sb THEN 1.0 ELSE {sorts} END AS tsort,
  CASE WHEN sa = '' OR sb = '' THEN 0.0 WHEN shared <> '' AND (ra = '' OR rb = '') THEN 1.0 WHEN shared = '' THEN {rests}
    ELSE greatest({rests}, 1 - (1 + {la}) / ({both} + {wa}), 1 - (1 + {lb}) / ({both} + {wb})) END AS tset FROM cut)"""


_ADDR1, _ADDR2 = (f"CASE WHEN {_ADDR} THEN clean_addr{i} ELSE '' END" for i in (1, 2))
_EFF = "(CASE WHEN clean_addr2 <> '' THEN a.tsort ELSE n.tsort END)"
FUZZY = {
    "name_jw_sim": "n.jw", "name_token_sort": "n.tsort", "name_token_set": "n.tset", "addr_jw_sim": "a.jw", "addr_token_sort": "a.tsort", "addr_token_set": "a.tset",
    "cross_prod": f"n.tsort * {_EFF}", "cross_sum": f"n.tsort + {_EFF}", "cross_max": f"greatest(n.tsort, {_EFF})", "cross_min": f"least(n.tsort, {_EFF})",
    "name_high_but_num_conflict": _flag(f"n.tsort >= 0.75 AND {_KNOWN} AND primary_num1 <> primary_num2"),
}


def _named(ctes: str, prefix: str) -> str:
    """The chain of _token_ratios under names of its own."""
    for name in ("texts", "listed", "cut", "ratios"):
        ctes = ctes.replace(f"{name} AS (", f"{prefix}_{name} AS (").replace(f"FROM {name})", f"FROM {prefix}_{name})")
    return ctes


_Z = " + ".join([str(BIAS), *(f"({w} * CAST(CAST({n} AS FLOAT) AS DOUBLE))" for n, w in WEIGHTS.items())])
SCORES = f"""
lin AS (SELECT *, CAST(CAST(round(1 / (1 + exp(-({_Z}))), 9) AS FLOAT) AS DOUBLE) AS prob FROM feat),
pen AS (SELECT * REPLACE (CASE WHEN primary_num1 IS NOT NULL AND primary_num2 IS NOT NULL AND primary_num1 <> primary_num2 AND name_exact_core < 1 THEN prob * 0.1 ELSE prob END AS prob) FROM lin),
over AS (SELECT * FROM pen WHERE prob >= CASE WHEN tid LIKE 'S2-%' THEN 0.70 ELSE 0.75 END),
links AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, tid ORDER BY prob DESC, s1_ordinal, s1_id) AS r FROM over) WHERE r = 1),
s1 AS (SELECT entity_id AS s1_id, country FROM biz WHERE src = 1),
matched AS (SELECT s1_id, country, count(tid) AS n, coalesce(string_agg(tid, ',' ORDER BY tid), '') AS matched FROM s1 LEFT JOIN (SELECT s1_id, tid FROM links) USING (s1_id) GROUP BY ALL)"""

_F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END"
COUNTS = """
counts AS (SELECT s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = s.s1_id) AS n_true, (SELECT count(*) FROM links t WHERE t.s1_id = s.s1_id) AS n_pred,
  (SELECT count(*) FROM links t JOIN truth u USING (s1_id, tid) WHERE t.s1_id = s.s1_id) AS tp FROM s1 s)"""


METRICS = f"""CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_pred) AS BIGINT) AS pred_links, CAST(sum(n_true) AS BIGINT) AS true_links, round(avg({_F05}), 6) AS macro_f05,
  round(coalesce(avg(CASE WHEN n_true > 0 THEN CASE WHEN tp > 0 THEN 2 * (tp / n_pred) * (tp / n_true) / (tp / n_pred + tp / n_true) ELSE 0.0 END END), 0.0), 6) AS macro_f1,
  count(*) FILTER (n_true = 0) AS singletons, count(*) FILTER (n_true = 0 AND n_pred = 0) AS singletons_correct, count(*) FILTER (n_true > 0) AS non_singletons,
  CAST(sum(n_pred) - sum(tp) AS BIGINT) AS fp, CAST(sum(n_true) - sum(tp) AS BIGINT) AS fn, round(CASE WHEN sum(n_pred) > 0 THEN sum(tp) / sum(n_pred) ELSE 1.0 END, 6) AS precision,
  round(CASE WHEN sum(n_true) > 0 THEN sum(tp) / sum(n_true) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN count(*) FILTER (n_true = 0) > 0 THEN count(*) FILTER (n_true = 0 AND n_pred = 0) / count(*) FILTER (n_true = 0) ELSE 1.0 END, 6) AS singleton_accuracy"""


GCOUNTS = """gcounts AS (SELECT s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = s.s1_id) AS n_true, (SELECT count(*) FROM glinks t WHERE t.s1_id = s.s1_id) AS n_pred,
  (SELECT count(*) FROM glinks t JOIN truth u USING (s1_id, tid) WHERE t.s1_id = s.s1_id) AS tp FROM s1 s)"""


def _grid(points: str, extra: str) -> str:
    return f"""
pts AS ({points}),
nt AS (SELECT s1_id, count(*) AS n FROM truth GROUP BY ALL),
hits AS (SELECT p.s2, p.s3, x.s1_id, count(*) AS n_pred, count(u.tid) AS tp FROM pen x JOIN pts p ON x.prob >= CASE WHEN x.tid LIKE 'S2-%' THEN p.s2 ELSE p.s3 END
  LEFT JOIN truth u ON u.s1_id = x.s1_id AND u.tid = x.tid {extra} GROUP BY ALL),
tried AS (SELECT p.s2, p.s3, coalesce(nt.n, 0) AS n_true, coalesce(h.n_pred, 0) AS n_pred, coalesce(h.tp, 0) AS tp
  FROM s1 CROSS JOIN pts p LEFT JOIN nt USING (s1_id) LEFT JOIN hits h ON h.s1_id = s1.s1_id AND h.s2 = p.s2 AND h.s3 = p.s3),
best AS (SELECT s2, s3, round(avg({_F05}), 12) AS macro_f05 FROM tried GROUP BY ALL)"""


LEVELS = (FIXTURE, NORM, KEYS, PAIRS, SIDES, SCORES, COUNTS)


def _sql(level: int, last: str, *more: str) -> str:
    return "WITH " + ",".join([*LEVELS[: level + 1], *more]) + "\n" + last


def _all(names) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


ORACLES: dict[str, str] = {
    "record_scan": _sql(0, "SELECT entity_id, business_name, business_address, country FROM biz"),
    "clean_string": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "normalize_name": _sql(1, "SELECT entity_id, clean_name, core_name, array_to_string(list_sort(nt), ' ') AS sorted_name FROM norm"),
    "normalize_address": _sql(1, "SELECT entity_id, clean_addr FROM norm"),
    "extract_numbers": _sql(1, "SELECT entity_id, array_to_string(list_filter(nn, lambda x, i: list_position(nn, x) = i), ',') AS nums, primary_num FROM norm"),
    "char_ngrams": _sql(1, f"SELECT entity_id, array_to_string(list_sort({_grams('core_name')}), ',') AS grams FROM norm"),
    "country_share": _sql(0, "SELECT country, count(*) AS entities, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM biz WHERE src = 1 GROUP BY country"),
    "distinct_countries": _sql(0, "SELECT DISTINCT country FROM biz WHERE src = 1 AND country <> ''"),
    "ground_truth_links": _sql(0, "SELECT s1_id, tid FROM truth"),
    "blocking_keys_name": _sql(2, "SELECT entity_id, country, ktype, kval FROM name_keys"),
    "blocking_keys_address": _sql(2, "SELECT entity_id, country, ktype, kval FROM address_keys"),
    "blocking_keys_all": _sql(2, "SELECT entity_id, country, ktype, kval FROM keys"),
    "key_frequency": _sql(2, "SELECT country, ktype, kval, postings FROM freq"),
    "active_keys": _sql(2, "SELECT entity_id, country, ktype, kval FROM active"),
    "candidate_pairs": _sql(3, "SELECT country, s1_id, tid, shared_keys FROM pairs"),
    "candidate_topk": _sql(3, "SELECT country, s1_id, tid, shared_keys, rank FROM topk"),
    "candidate_list": _sql(3, "SELECT entity_id AS s1_id, coalesce(string_agg(tid, ',' ORDER BY rank), '') AS candidates FROM (SELECT entity_id FROM biz WHERE src = 1) LEFT JOIN topk ON s1_id = entity_id GROUP BY entity_id"),
    "candidate_recall": _sql(3, "SELECT count(*) AS true_links, count(rank) AS found_links, round(count(rank) / count(*), 6) AS candidate_recall FROM truth LEFT JOIN topk USING (s1_id, tid)"),
    "sim_levenshtein": _sql(4, f"SELECT s1_id, tid, round({_lev('clean_name1', 'clean_name2')}, 6) AS sim FROM f0"),
    "sim_jaro_winkler": _sql(4, "SELECT s1_id, tid, round(CASE WHEN clean_name1 = '' OR clean_name2 = '' THEN 0.0 ELSE jaro_winkler_similarity(clean_name1, clean_name2) END, 6) AS sim FROM f0"),
    "sim_token_ratios": _sql(4, "SELECT s1_id, tid, round(tsort, 6) AS token_sort, round(tset, 6) AS token_set FROM f0 JOIN ratios ON x = clean_name1 AND y = clean_name2", _token_ratios("clean_name1", "clean_name2")),
    "features_all": _sql(
        4, f"SELECT f0.s1_id, f0.tid, {', '.join(f'round(CAST({x} AS DOUBLE), 6) AS {n}' for n, x in (FUZZY | NATIVE).items())} FROM f0 JOIN n_ratios n ON n.x = clean_name1 AND n.y = clean_name2 JOIN a_ratios a ON a.x = {_ADDR1} AND a.y = {_ADDR2}",
        _named(_token_ratios("clean_name1", "clean_name2"), "n"), _named(_token_ratios(_ADDR1, _ADDR2), "a"),
    ),
    "features_native": _sql(4, f"SELECT s1_id, tid, {_all(NATIVE)} FROM feat"),
    "score_linear": _sql(5, "SELECT s1_id, tid, round(prob, 6) AS prob FROM lin"),
    "number_penalty": _sql(5, "SELECT s1_id, tid, round(prob, 6) AS prob FROM pen"),
    "threshold_filter": _sql(5, "SELECT s1_id, tid, round(prob, 6) AS prob FROM over"),
    "target_assignment": _sql(5, "SELECT s1_id, tid, round(prob, 6) AS prob FROM links"),
    "matching_results": _sql(5, "SELECT s1_id, matched FROM matched"),
    "singletons": _sql(5, "SELECT s1_id FROM matched WHERE n = 0"),
    "country_stats": _sql(5, "SELECT country, count(*) AS total_s1, count(*) FILTER (n = 0) AS singletons, CAST(sum(n) AS BIGINT) AS matched_links, round(100 * count(*) FILTER (n = 0) / count(*), 6) AS singleton_pct, round(sum(n) / count(*), 6) AS avg_matches FROM matched GROUP BY country"),
    "run_totals": _sql(5, """SELECT (SELECT count(*) FROM s1) AS total_s1, (SELECT count(*) FROM matched WHERE n = 0) AS singletons, (SELECT count(*) FROM topk) AS candidate_pairs,
  count(*) AS matches, count(*) FILTER (tid LIKE 'S2-%') AS s2_matches, count(*) FILTER (tid LIKE 'S3-%') AS s3_matches, count(DISTINCT s1_id) AS matched_entities FROM links"""),
    "tsv_scan": _sql(0, "SELECT entity_id, business_name, business_address, country FROM biz"),
    "tsv_country": _sql(0, "SELECT entity_id, business_name, business_address, country FROM biz WHERE country = 'ASIA'"),
    "tsv_truth": _sql(0, "SELECT s1_id, string_agg(tid, ',' ORDER BY tid) AS matched FROM truth GROUP BY s1_id"),
    "tsv_targets": _sql(0, "SELECT entity_id, upper(business_name) AS business_name, business_address, country FROM biz WHERE src > 1"),
    "sorted_address": _sql(1, "SELECT entity_id, array_to_string(list_sort(aw), ' ') AS sorted_addr FROM n1"),
    "near_copy_documents": f"""WITH heads AS (SELECT doc_id, substr({_clean("text")}, 1, 40) AS head FROM documents),
shared AS (SELECT doc_id, count(*) OVER (PARTITION BY head) AS postings, min(doc_id) OVER (PARTITION BY head) AS first_doc FROM heads WHERE head <> '')
SELECT doc_id, postings, first_doc FROM shared WHERE postings <= 250""",
    "entity_f05": _sql(6, f"SELECT s1_id, round({_F05}, 6) AS f05 FROM counts"),
    "evaluation_metrics": _sql(6, f"SELECT {METRICS} FROM counts"),
    "grid_global": _sql(
        5, f"SELECT t AS threshold, {METRICS} FROM gcounts, top1 GROUP BY t",
        _grid("SELECT 0.30::DOUBLE + i * ((0.90::DOUBLE - 0.30::DOUBLE) / 30) AS s2, s2 AS s3 FROM range(31) t(i)", ""),
        """top1 AS (SELECT s2 AS t FROM best ORDER BY macro_f05 DESC, s2 LIMIT 1),
glinks AS (SELECT s1_id, tid FROM pen, top1 WHERE prob >= t),
"""
        + GCOUNTS,
    ),
    "grid_source": _sql(
        5, f"SELECT a AS s2, b AS s3, {METRICS} FROM gcounts, top1 GROUP BY a, b",
        _grid("SELECT 0.40::DOUBLE + i * ((0.85::DOUBLE - 0.40::DOUBLE) / 9) AS s2, 0.40::DOUBLE + j * ((0.85::DOUBLE - 0.40::DOUBLE) / 9) AS s3 FROM range(10) t(i), range(10) u(j)", "WHERE x.tid LIKE 'S2-%' OR x.tid LIKE 'S3-%'"),
        """top1 AS (SELECT s2 AS a, s3 AS b FROM best ORDER BY macro_f05 DESC, s2, s3 LIMIT 1),
glinks AS (SELECT s1_id, tid FROM pen, top1 WHERE (tid LIKE 'S2-%' AND prob >= a) OR (tid LIKE 'S3-%' AND prob >= b)),
"""
        + GCOUNTS,
    ),
}
