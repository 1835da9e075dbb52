"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from clinflat.llm import feistel_shards, revisits, suffix_dedup, url_filter

LENGTH = suffix_dedup.LENGTH

SUFFIX_ARRAY = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM d
), cut AS (
  SELECT doc_id, n, unnest(range(0, n - {LENGTH} + 1, 256)) AS s, h FROM sized WHERE n >= {LENGTH}
), pieces AS (
  SELECT doc_id, s, least(256, n - {LENGTH} + 1 - s) AS k,
    substr(h, 2 * s + 1, 2 * (255 + {LENGTH})) AS piece
  FROM cut
), starts AS (
  SELECT doc_id, s + j AS i, md5(substr(piece, 2 * j + 1, {2 * LENGTH})) AS window_
  FROM (SELECT doc_id, s, piece, unnest(range(0, k)) AS j FROM pieces)
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY window_ ORDER BY doc_id, i) AS nth FROM starts
), gone AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step
  FROM ranked WHERE nth > 1
), islands AS (
  SELECT doc_id, i, sum(CASE WHEN step <= {LENGTH} THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS island
  FROM gone
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b FROM islands GROUP BY doc_id, island
), removed AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id
), edges AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
  UNION ALL
  SELECT s.doc_id, coalesce(max(b), 0), any_value(n) FROM sized s LEFT JOIN spans USING (doc_id)
  GROUP BY s.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS rest
  FROM edges JOIN sized USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM sized JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


def _rounds() -> str:
    """The rounds of one permutation as nested selects over ``walk`` and ``size``."""
    sql = "SELECT number, step, n, a, b, (x - x % b) // b AS l, x % b AS r FROM walk, size"
    sql += " WHERE step = 0 OR x >= n"
    for k in range(feistel_shards.ROUNDS):
        half, other, range_ = ("l", "r", "a") if k % 2 == 0 else ("r", "l", "b")
        keyed = f"('0x' || substr(md5('{feistel_shards.SEED}:{k}:' || {other}), 1, 13))::BIGINT"
        moved = f"({half} + {keyed}) % {range_} AS {half}"
        sql = f"SELECT number, step, n, a, b, {moved}, {other} FROM ({sql})"
    return f"SELECT number, l * b + r AS x, step + 1 AS step FROM ({sql})"


SHARDING = f"""
WITH RECURSIVE table_(entry) AS (
  SELECT list(c ORDER BY i) FROM (
    SELECT i, list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1
      THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) t(i))
), bytes AS (
  SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents
), checked AS (
  SELECT doc_id, text, length(h) // 2 + {feistel_shards.OVERHEAD} AS size,
    xor(list_reduce(
      list_transform(regexp_extract_all(h, '..'), lambda v: ('0x' || v)::BIGINT),
      lambda c, v: xor(c >> 8, entry[xor(c & 255, v) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM bytes, table_
), numbered AS (
  SELECT doc_id, size, text_crc32,
    row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS number
  FROM checked
), size AS (
  SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM (
    SELECT n, floor(sqrt(greatest(n - 1, 0)))::BIGINT + 1 AS a FROM (
      SELECT count(*) AS n FROM documents))
), walk(number, x, step) AS (
  SELECT number, number, 0 FROM numbered
  UNION ALL
  {_rounds()}
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, number,
  (x % {feistel_shards.SHARDS})::INTEGER AS shard, x // {feistel_shards.SHARDS} AS slot,
  NULL::INTEGER AS grown_shard
FROM numbered JOIN walk USING (number), size WHERE step > 0 AND x < n
"""

_TOKEN = "'\"' || substr(digest, 1, 12) || version || '\"'"
_NOT_MERGED = ", ".join(f"'{h}'" for h in revisits.NOT_MERGED)

REVISITS = f"""
WITH visits AS (
  SELECT page_id, url, md5(html) AS digest, visit,
    CASE WHEN visit >= 2 AND page_id % 3 = 0 AND NOT (visit = 3 AND page_id % 5 = 0)
      THEN 'b' ELSE 'a' END AS version
  FROM pages, range(4) t(visit)
), captures AS (
  SELECT page_id * 4 + visit AS record_id,
    CASE WHEN visit % 2 = 0 THEN url
      ELSE regexp_replace(url, '[#].*$', '') || '#v' || visit END AS url,
    1767225600 + page_id * 7919 % 86400 + visit * 86400 AS seconds,
    CASE WHEN (visit = 0 AND page_id % 11 <> 0) OR (visit = 2 AND page_id % 3 = 0)
      THEN 200 ELSE 304 END AS status,
    CASE WHEN (page_id + visit) % 7 = 0 THEN NULL
      WHEN visit = 1 AND page_id % 4 = 0 THEN 'W/' || {_TOKEN} ELSE {_TOKEN} END AS etag,
    CASE WHEN page_id % 13 = 0 THEN NULL ELSE '2026-01-0' || version END AS modified,
    'day ' || visit AS date, (length(digest) + visit)::VARCHAR AS length
  FROM visits
), parts AS (
  SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
    regexp_extract(url, '://(?:[^/?#@]*@)?([^/?#]*)', 1) AS host,
    regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query
  FROM captures
), named AS (
  SELECT *, regexp_replace(regexp_replace(lower(host), '^www\\.', ''),
      CASE WHEN lower(scheme) = 'https' THEN ':443$' ELSE ':80$' END, '')
    || CASE WHEN path = '' THEN '/' ELSE path END AS place,
    list_sort(list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT starts_with(p, '{revisits.TRACKING}'))) AS kept
  FROM parts
), keyed AS (
  SELECT *, place || CASE WHEN len(kept) = 0 THEN ''
    ELSE '?' || array_to_string(kept, '&') END AS canonical_url
  FROM named
), found AS (
  SELECT k.*, max(CASE WHEN f.record_id IS NOT NULL
    THEN {{'s': f.seconds, 'id': f.record_id, 'etag': f.etag, 'modified': f.modified,
           'length': f.length}} END) AS f
  FROM keyed k LEFT JOIN keyed f
    ON f.canonical_url = k.canonical_url AND f.status = 200 AND f.seconds < k.seconds
  GROUP BY ALL
), judged AS (
  SELECT *, CASE WHEN status = 200 THEN 'full'
    WHEN f IS NULL THEN 'no_earlier_response'
    WHEN etag IS NOT NULL AND f.etag IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f.etag, '^W/', '')
        THEN 'resolved' ELSE 'changed' END
    WHEN modified IS NOT NULL AND f.modified IS NOT NULL THEN
      CASE WHEN modified = f.modified THEN 'resolved' ELSE 'changed' END
    ELSE 'no_validator' END AS state
  FROM found
), merged AS (
  SELECT *, state = 'resolved' AS ok FROM judged
)
SELECT record_id, canonical_url, make_timestamp(seconds * 1000000) AS ts, state,
  CASE WHEN ok THEN f.id END AS refers_to,
  array_to_string(list_filter([
    'content-length: ' || CASE WHEN ok AND 'content-length' IN ({_NOT_MERGED})
      THEN f.length ELSE length END,
    'date: ' || date,
    'etag: ' || CASE WHEN ok THEN coalesce(etag, f.etag) ELSE etag END,
    'last-modified: ' || CASE WHEN ok THEN coalesce(modified, f.modified) ELSE modified END
  ], lambda x: x IS NOT NULL), chr(10)) AS headers
FROM merged
"""


def url_filter_sql(rules: list[tuple[str, str]], blocked: list[str], allowed: list[str]) -> str:
    rows = ", ".join([f"('{u}', 1)" for u in blocked] + [f"('{u}', 0)" for u in allowed])
    listed = ", ".join(f"('{v}', '{r}')" for v, r in rules)
    rest = "substr(url, instr(url, '://') + 3)"
    host = f"CASE WHEN instr(url, '://') > 0 THEN lower(regexp_extract({rest}, '^([^/?#]*)', 1)) ELSE '' END"  # noqa: E501
    path = f"CASE WHEN instr(url, '://') > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"  # noqa: E501

    def grams(kind: str, text: str, n: int) -> str:
        return (
            f"list_transform(range(1, greatest(length({text}) - {n} + 1, 1) + 1), "
            f"lambda k: '{kind}' || substr({text}, k, {n}))"
        )

    every = [
        grams(k, t, n)
        for n in url_filter.GRAMS
        for k, t in (("h", "('^' || host || '$')"), ("p", "('/' || path)"))
    ]
    both = every[0]
    for g in every[1:]:
        both = f"list_concat({both}, {g})"
    buckets = (
        f"list_distinct(list_transform({both}, "
        f"lambda g: ('0x' || substr(md5(g), 1, 8))::BIGINT % {url_filter.BUCKETS}))"
    )
    rate, decay = url_filter.RATE, url_filter.DECAY
    return f"""
WITH RECURSIVE labelled(url, y) AS (VALUES {rows}
), parted AS (
  SELECT url, y, {host} AS host, {path} AS path FROM labelled
), marked AS (
  SELECT md5(url) AS k, url, y::DOUBLE AS y, {buckets} AS x FROM parted
), examples AS (
  SELECT row_number() OVER (ORDER BY k, url, y) AS i, y, x, sqrt(len(x)) AS m FROM marked
), products AS (
  SELECT a.i, any_value(a.y) AS y,
    list(len(list_intersect(a.x, b.x)) / (a.m * b.m) ORDER BY b.i) AS p
  FROM examples a, examples b GROUP BY a.i
), packed AS (
  SELECT list(y ORDER BY i) AS ys, list(p ORDER BY i) AS ps, count(*) AS n FROM products
), fit(step, alpha, bias) AS (
  SELECT 0, list_transform(ys, lambda v: 0.0::DOUBLE), 0.0::DOUBLE FROM packed
  UNION ALL
  SELECT step + 1,
    list_transform(errors, lambda e, i: alpha[i] * (1 - {rate} * {decay}) + {rate} / n * e),
    bias + list_sum(errors) * {rate} / n
  FROM (
    SELECT step, alpha, bias, n, list_transform(ys, lambda v, i:
      v - 1 / (1 + exp(-(list_dot_product(ps[i], alpha) + bias)))) AS errors
    FROM fit, packed WHERE step <= {url_filter.STEPS}
  )
), model AS (
  SELECT alpha, bias FROM fit ORDER BY step DESC LIMIT 1
), weights AS (
  SELECT bucket, sum(share) AS w FROM (
    SELECT unnest(x) AS bucket, alpha[i] / m AS share FROM examples, model) GROUP BY bucket
), rules(verdict, rule) AS (VALUES {listed}
), judged AS (
  SELECT page_id, {host} AS host, {path} AS path FROM pages
), rows_ AS (
  SELECT row_number() OVER () AS r, page_id, host, path, {buckets} AS x FROM judged
), ruled AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM rows_, rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, instr(rule, '/')))
  GROUP BY r
), summed AS (
  SELECT r, sum(w) AS s, any_value(m) AS m FROM (
    SELECT r, unnest(x) AS bucket, sqrt(len(x)) AS m FROM rows_
  ) LEFT JOIN weights USING (bucket) GROUP BY r
), scored AS (
  SELECT r, 1 / (1 + exp(-(coalesce(s, 0) / m + bias))) AS score FROM summed, model
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN score > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(score, 6) AS score
FROM rows_ JOIN scored USING (r) LEFT JOIN ruled USING (r)
"""

HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS s FROM w),
g AS (
  SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM i, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE s + k - 1 <= len(words)
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f FROM g WHERE f >= 100),
inside AS (
  SELECT DISTINCT y.lang, x.phrase
  FROM f y, unnest(range(1, 5)) AS starts(s), unnest(range(2, 5)) AS sizes(m), f x
  WHERE m < y.k AND s + m - 1 <= y.k AND x.lang = y.lang
    AND x.phrase = array_to_string(y.words[s:s + m - 1], ' ') AND 100 * y.f >= 100 * x.f),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k.k,
    array_to_string(c.words[1:k.k], ' ') AS head, array_to_string(c.words[k.k + 1:], ' ') AS tail
  FROM f c JOIN (VALUES (1), (2), (3), (4)) AS k(k) ON k.k < c.k
  ANTI JOIN inside ON inside.lang = c.lang AND inside.phrase = c.phrase),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, h.f AS l, t.f AS r, n.n, cuts.k,
    CAST(1000::HUGEINT * cuts.a * n.n // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = cuts.head
    JOIN f t ON t.lang = cuts.lang AND t.phrase = cuts.tail JOIN n ON n.lang = cuts.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
