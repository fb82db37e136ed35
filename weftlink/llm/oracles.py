"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .chat_format import Template
from .exact_topk import SCALE
from .quality_rules import BASE_REPEAT, BASE_WORDS, CONFIDENCE_LEFT, RISK, RULES, SPAN
from .secrets import ALLOW, ASSIGN_LEAST, CLASSES, KINDS
from .source_mix import BLOCK, MOST, PRIME, ROUNDS, SHARE, WEIGHTS, _round_numbers

WORD = r"[^\x20\x09-\x0D]+"

ARCHIVE = """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
hashed AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM bodies),
origins AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS origin FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> origin THEN origin END AS refers_to FROM origins"""

TOP = f"""
WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


def _chat() -> str:
    t = Template()
    said = r"'\### Assistant: </turn> ok'"
    escaped = rf"replace(replace(replace(text, '\', '\\'), '{t.opening}', '\{t.opening}'), '{t.mark}', '\{t.mark}')"
    label = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(n)}" for r, n in t.labels.items()) + " WHEN NULL THEN 9 ELSE length('Role ') + length(to_json(role)) END"
    sets = {s: ", ".join(f"'{r}'" for r in sorted(x)) for s, x in t.moves.items()}
    moves = "CASE WHEN n = 1 THEN role IN (" + sets[""] + ") " + " ".join(f"WHEN prev = '{s}' THEN role IN ({x})" for s, x in sets.items() if s) + " ELSE false END"
    return f"""
WITH rows AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said})),
placed AS (SELECT *, lag(role) OVER w AS prev, row_number() OVER w AS n FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(t.opening) + len(t.after) + len(t.closing)} + {label} + length({escaped})) AS BIGINT) AS formatted_chars,
  bool_and(coalesce({moves}, false)) AS order_ok FROM placed GROUP BY conv_id"""


def _quality() -> str:
    tests = "\n  UNION ALL ".join(
        f"SELECT stratum, '{rule}' AS rule, {i} AS step, {c} AS cutoff, count(*) AS n, count(*) FILTER (100 * {a} > {c} * {b}) AS k FROM good GROUP BY stratum"
        for rule, (a, b, cuts) in RULES.items() for i, c in enumerate(cuts, 1)
    )
    rejects = " OR ".join(f"(rule = '{rule}' AND 100 * {a} > cutoff * {b})" for rule, (a, b, _) in RULES.items())
    term = f"exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK}))"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, lang, text, regexp_extract_all(text, '{WORD}') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM texts),
windows AS (SELECT r, i, array_to_string(w[i : i + {SPAN - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {SPAN - 2})) AS i FROM split)),
found AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM found, range({SPAN}) t(j) WHERE c > 1 GROUP BY r),
counted AS (SELECT r, doc_id, coalesce('=' || lang, 'null') AS stratum, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS n_capitals FROM split LEFT JOIN covered USING (r)),
marks AS (SELECT doc_id, min(quality) = 1 AND max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
good AS (SELECT counted.* FROM counted JOIN marks USING (doc_id) WHERE good),
tests AS ({tests}),
tails AS (SELECT *, CASE WHEN k >= n * {RISK} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j: {term})) END AS tail FROM tests),
judged AS (SELECT *, tail <= {CONFIDENCE_LEFT} / ((SELECT count(DISTINCT stratum) FROM good) * {len(RULES)}) AS passed FROM tails),
sound AS (SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY step) AS so_far FROM judged),
cuts AS (SELECT stratum, rule, arg_max(cutoff, step) AS cutoff FROM sound WHERE so_far GROUP BY stratum, rule),
rejected AS (SELECT DISTINCT r FROM counted JOIN cuts USING (stratum) WHERE {rejects})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
  n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT} * n_words AS base_failed,
  NOT (n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT} * n_words) AND rejected.r IS NULL AS kept
FROM counted LEFT JOIN rejected USING (r)"""


def _mix() -> str:
    rounds, last = [], "p0"
    for r in range(ROUNDS):
        a, b, c, d = _round_numbers(r, 1)
        other = f"(((key % {PRIME}) * {a % 100003} + {b}) % {PRIME} % blocks - x) % blocks"
        t = f"((top % 1000003) * {c % 1000003} + (top // 1000003) * {d % 1000003} + (key % 1000003) * {a % 1000003} + {b}) % {PRIME}"
        rounds.append(f"""o{r} AS (SELECT *, ({other} + blocks) % blocks AS other FROM {last}),
t{r} AS (SELECT *, greatest(x, other) AS top FROM o{r}),
p{r + 1} AS (SELECT sidx, key, blocks, CASE WHEN (({t}) * ({t})) % {PRIME} % 2 = 1 THEN other ELSE x END AS x FROM t{r})""")
        last = f"p{r + 1}"
    steps = ",\n".join(rounds)
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return f"""
WITH rows AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  md5(concat_ws(chr(31), coalesce(CAST(doc_id AS VARCHAR), ''), coalesce('s' || source, 'n'), coalesce(md5(text), '-'))) AS rkey FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM rows GROUP BY source),
places AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS sidx FROM sums),
weights AS (SELECT *, {list(WEIGHTS)}[sidx % {len(WEIGHTS)} + 1] AS weight, {MOST} * size AS most, sum(size) OVER () * {SHARE}::DOUBLE AS total FROM places),
levels AS (SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, sidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / sum(weight) OVER (ORDER BY most / weight, sidx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM weights),
shares AS (SELECT *, first_value(CASE WHEN level * weight <= most THEN level END IGNORE NULLS) OVER (ORDER BY most / weight, sidx {whole}) AS share FROM levels),
aims AS (SELECT *, coalesce(least(share * weight, most::DOUBLE), most::DOUBLE) AS target, CAST(ceil(size / {BLOCK}) AS BIGINT) AS blocks FROM shares),
sources AS (SELECT *, CASE WHEN size > 0 THEN least({MOST} * blocks, CAST(round(target / size * blocks) AS BIGINT)) ELSE 0 END AS slots FROM aims),
p0 AS (SELECT sidx, blocks, q % blocks AS x, sidx * 7919 + (q // blocks) * 104729 + 17 AS key FROM (SELECT sidx, blocks, unnest(range(slots)) AS q FROM sources)),
{steps},
taken AS (SELECT sidx, x AS block, count(*) AS times FROM {last} GROUP BY sidx, x),
stream AS (SELECT rows.*, row_number() OVER () AS r, sidx, CAST(coalesce(sum(rows.size) OVER (PARTITION BY sidx
  ORDER BY rkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spot
  FROM rows JOIN sources ON rows.source IS NOT DISTINCT FROM sources.source),
parts AS (SELECT r, sidx, spot, size, unnest(range(spot // {BLOCK}, (spot + size - 1) // {BLOCK} + 1)) AS block FROM stream WHERE size > 0),
got AS (SELECT r, sum(times * (least((block + 1) * {BLOCK}, spot + size) - greatest(block * {BLOCK}, spot))) AS taken FROM parts JOIN taken USING (sidx, block) GROUP BY r)
SELECT doc_id, stream.size, sources.size AS source_size, target, CAST(coalesce(got.taken, 0) AS BIGINT) AS taken
FROM stream JOIN sources USING (sidx) LEFT JOIN got USING (r)"""


def _secrets() -> str:
    assign = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    base = {"assign": assign, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
    text = lambda x: "'" + x.replace("'", "''") + "'"
    # what stands between the matches gives their places
    found = lambda o, kind, p, second: (
        f"SELECT r, {o} AS o, '{kind}' AS kind, regexp_extract_all(text, {text(p)}) AS m, {second} AS value, string_split_regex(text, {text(p)}) AS rest FROM texts"
    )
    matches = "\n  UNION ALL ".join(found(i, k, p, f"regexp_extract_all(text, {text(p)}, 2)" if k == "assign" else "NULL") for i, (k, p) in enumerate(base.items()))
    place = "CAST(list_sum(list_transform(rest[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS BIGINT)"
    allowed = " OR ".join(f"regexp_full_match(s, {text(a.pattern)})" for a in ALLOW)
    limits = " ".join(f"WHEN regexp_full_match(s, {text(c.pattern)}) THEN {{'width': {w}, 'bits': {b}}}" for _, c, w, b in CLASSES)
    entropy = "-list_sum(list_transform(map_values(list_aggregate(string_split(substr(s, w, c.width), ''), 'histogram')), lambda n: n / c.width * log2(n / c.width)))"
    listed = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o, b){}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({matches}),
placed AS (SELECT r, o, kind, {place} AS a, m[i] AS s, value[i] AS v FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matches)),
base AS (SELECT r, o, kind, a, a + length(s) AS b FROM placed WHERE kind <> 'assign' OR length(v) >= {ASSIGN_LEAST}),
runs AS ({found(3, "entropy", "[A-Za-z0-9+/_=-]{20,}", "NULL")}),
candidates AS (SELECT r, o, kind, {place} AS a, m[i] AS s FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM runs)),
free AS (SELECT *, a + length(s) AS b, CASE {limits} END AS c FROM candidates x
  WHERE NOT ({allowed}) AND NOT EXISTS (SELECT 1 FROM base y WHERE y.r = x.r AND y.a < x.a + length(x.s) AND y.b > x.a)),
windows AS (SELECT *, unnest(range(1, length(s) - c.width + 2)) AS w FROM free),
high AS (SELECT DISTINCT r, o, kind, a, b FROM windows WHERE {entropy} >= c.bits - 1e-12),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM high),
joined AS (SELECT r, {counts}, {listed.format(" FILTER (kind <> 'entropy')")} AS based, {listed.format("")} AS spans FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN joined USING (r)"""


ORACLES: dict[str, str] = {
    "op3_warc_segments": ARCHIVE,
    "op5_chat_format": _chat(),
    "op6_quality_rules": _quality(),
    "op8_source_mix": _mix(),
    "op9_exact_topk": TOP,
    "op10_secret_scan": _secrets(),
}
