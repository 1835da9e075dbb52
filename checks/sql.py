"""Shared parts of the oracle SQL: each restates a fixture rule on the base tables."""

SPACE = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
BASE = "http://fixture.example/"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trim(expr: str) -> str:
    return f"trim({expr}, {quote(SPACE)})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PAT = """pat AS (
  SELECT 'p' || c_custkey AS patient_uuid,
         CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE 'p' || c_custkey END AS pid,
         CASE WHEN c_custkey % 23 <> 0 THEN 1930 + c_custkey % 70 END AS birth_year,
         c_nationkey, c_custkey
  FROM customer WHERE c_custkey % 17 <> 0)"""

OBS = """ev AS (
  SELECT event_id AS e, event_type AS et, value AS v, CAST(value AS VARCHAR) AS vt,
         regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp, ts,
         event_id % 8 AS kind, (event_id // 8) % 6 AS sub,
         CASE WHEN event_id % 103 = 0 OR event_id % 101 = 0 THEN NULL
              ELSE 'p' || user_id END AS patient_uuid
  FROM events),
obs AS (
  SELECT *, CASE WHEN e % 11 = 0 THEN NULL
                 WHEN e % 13 = 0 THEN strftime(ts, '%Y-%m-%d')
                 WHEN e % 29 = 0 THEN strftime(ts, '%Y-%m')
                 ELSE stamp END AS date,
         et AS code,
         CASE WHEN e % 7 = 0 THEN 'Alt ' || et ELSE 'Event ' || et END AS display,
         CASE WHEN kind IN (0, 1, 6) THEN vt END AS v_qty,
         CASE WHEN kind = 2 THEN k END AS v_int,
         CASE WHEN kind = 3 THEN 'note ' || et END AS v_str,
         CASE WHEN kind = 4 THEN 'flag ' || et END AS v_code,
         CASE WHEN kind IN (0, 6) THEN 'mg' END AS unit
  FROM ev),
part_kinds AS (
  SELECT e, patient_uuid, date, et, vt, v, k, stamp, 'a' AS part, sub AS ck FROM obs WHERE kind = 5
  UNION ALL
  SELECT e, patient_uuid, date, et, vt, v, k, stamp, 'b', (sub + 3) % 6 FROM obs WHERE kind = 5
  UNION ALL
  SELECT e, patient_uuid, date, et, vt, v, k, stamp, 'c', sub FROM obs WHERE kind = 6),
comp AS (
  SELECT patient_uuid, date, part AS code, 'Part ' || part AS display,
         CASE WHEN ck = 0 THEN vt END AS c_qty, CASE WHEN ck = 1 THEN k END AS c_int,
         CASE WHEN ck = 2 THEN 'text ' || et END AS c_str,
         CASE WHEN ck = 3 THEN CASE WHEN v > 50 THEN 'true' ELSE 'false' END END AS c_bool,
         CASE WHEN ck = 4 THEN stamp END AS c_dt,
         CASE WHEN ck = 5 THEN 'grade ' || et END AS c_code,
         CASE WHEN ck = 0 THEN 'mmol' END AS unit
  FROM part_kinds),
meas AS (
  SELECT patient_uuid, code, display,
         coalesce(v_qty, v_int, v_str, v_code) || coalesce(' ' || unit, '') AS value, date
  FROM obs WHERE kind NOT IN (5, 7)
  UNION ALL
  SELECT patient_uuid, code, display,
         coalesce(c_qty, c_int, c_str, c_bool, c_dt, c_code) || coalesce(' ' || unit, ''), date
  FROM comp)"""

OBS_LONG = """obs_long AS (
  SELECT coalesce(pat.pid, meas.patient_uuid) AS pid, code, display, value, date
  FROM meas LEFT JOIN pat USING (patient_uuid))"""

_ANSWERS = (
    "val_code val_disp_resp val_string val_integer val_decimal val_boolean val_date "
    "val_datetime val_time val_uri val_qty val_qty_unit"
).split()


def _item(source: str, head: str, question: str, text: str = "NULL", **answer: str) -> str:
    cells = ", ".join(f"{answer.get(a, 'NULL')}::VARCHAR AS {a}" for a in _ANSWERS)
    return (
        f"SELECT {head}, ({question})::VARCHAR AS question_id, ({text})::VARCHAR AS text_resp, "
        f"{cells} FROM {source}"
    )


_ORDER = "rid, patient_uuid, date, ref"
_SIZE = (
    "CASE WHEN l_quantity < 15 THEN 'S' WHEN l_quantity < 30 THEN 'M' "
    "WHEN l_quantity < 45 THEN 'L' ELSE 'X' END"
)

ORD = f"""ord AS (
  SELECT *, o_orderkey AS k, 'qo' || o_orderkey AS rid, 'p' || o_custkey AS patient_uuid,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL
              WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-%m')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL
              WHEN o_orderkey % 3 = 0 THEN '{BASE}fhir/Questionnaire/q1'
              WHEN o_orderkey % 3 = 1 THEN 'Questionnaire/q2'
              ELSE 'Questionnaire/q3|2.0' END AS ref
  FROM orders),
lin AS (
  SELECT *, 'ql' || l_orderkey || '-' || l_linenumber AS rid, 'p' || l_suppkey AS patient_uuid,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS date,
         'Questionnaire/q' || l_partkey AS ref
  FROM lineitem)"""

ITEMS = "items AS (\n" + "\nUNION ALL\n".join(
    [
        _item("ord", _ORDER, "'status'", val_code="o_orderstatus"),
        _item(
            "ord", _ORDER, "'priority'", "'Priority'", val_code="left(o_orderpriority, 1)",
            val_disp_resp="o_orderpriority",
        ),
        _item("ord", _ORDER, "'pricing'", "'Pricing'"),
        _item(
            "ord", _ORDER, "CASE WHEN k % 37 <> 0 THEN 'total' END", "'Total price'",
            val_decimal="o_totalprice",
        ),
        _item(
            "ord", _ORDER, "'misc'", "CASE WHEN k % 41 <> 0 THEN 'Misc' END",
            val_string="CASE WHEN k % 6 = 0 THEN o_orderpriority END",
            val_integer="CASE WHEN k % 6 = 1 THEN k % 1000 END",
            val_boolean="CASE WHEN k % 6 = 2 THEN k % 2 = 0 END",
            val_date="CASE WHEN k % 6 = 3 THEN strftime(o_orderdate, '%Y-%m-%d') END",
            val_time="CASE WHEN k % 6 = 4 THEN '08:30:00' END",
            val_uri="CASE WHEN k % 6 = 5 THEN 'urn:x:' || k END",
        ),
        _item("lin", _ORDER, "'sec' || l_partkey"),
        _item("lin", _ORDER, "'size' || l_partkey", val_code=_SIZE),
        _item(
            "lin", _ORDER, "'brand' || l_partkey", "'Brand (response)'", val_string="l_returnflag"
        ),
        _item(
            "lin", _ORDER, "'price' || l_partkey", "'Price paid'", val_qty="l_extendedprice",
            val_qty_unit="CASE WHEN l_linenumber % 2 = 0 THEN 'EUR' END",
        ),
        _item("lin", _ORDER, "'line'", "'Line number'", val_integer="l_linenumber"),
    ]
) + ")"

QUESTIONS = f"""used_q AS (
  SELECT DISTINCT split_part(ref, '/', -1) AS id
  FROM (SELECT ref FROM ord UNION ALL SELECT ref FROM lin) WHERE ref IS NOT NULL),
all_q AS (
  SELECT 'q' || p_partkey AS id, 'sec' || p_partkey AS question_id, p_name AS text_def,
         NULL::VARCHAR AS value_set_url, p_partkey, p_name, p_brand FROM part
  UNION ALL SELECT 'q' || p_partkey, 'size' || p_partkey, 'Size of ' || p_name, NULL,
         p_partkey, p_name, p_brand FROM part
  UNION ALL SELECT 'q' || p_partkey, 'brand' || p_partkey, 'Brand', '{BASE}ValueSet/brand',
         p_partkey, p_name, p_brand FROM part
  UNION ALL SELECT 'q' || p_partkey, 'price' || p_partkey,
         CASE WHEN p_partkey % 4 <> 0 THEN 'Price' END, NULL, p_partkey, p_name, p_brand FROM part
  UNION ALL SELECT 'q' || p_partkey, 'status',
         CASE WHEN p_partkey = 1 THEN 'Order status' ELSE 'Status of the order' END, NULL,
         p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (1, 2)
  UNION ALL SELECT 'q' || p_partkey, 'line', 'Line of ' || p_name, NULL, p_partkey, p_name, p_brand
  FROM part
  UNION ALL SELECT 'u' || s_suppkey, 'status', s_name, NULL, NULL, NULL, NULL FROM supplier),
opts AS (
  SELECT 'size' || p_partkey AS question_id, 0 AS pos, 'S' AS opt_code, 'Small' AS opt_display
  FROM part
  UNION ALL SELECT 'size' || p_partkey, 1, 'M', NULL FROM part
  UNION ALL SELECT 'size' || p_partkey, 2, 'L', 'Large ' || p_brand FROM part),
status_opts AS (
  SELECT 'q1' AS id, 0 AS pos, 'O' AS opt_code, 'Open' AS opt_display
  UNION ALL SELECT 'q2', 0, 'O', 'Still open'
  UNION ALL SELECT 'q1', 1, 'F', 'Filled' UNION ALL SELECT 'q2', 1, 'F', 'Filled'),
q_options AS (
  SELECT all_q.id, question_id, text_def, value_set_url,
         coalesce(opts.pos, status_opts.pos) AS pos,
         coalesce(opts.opt_code, status_opts.opt_code) AS opt_code,
         coalesce(opts.opt_display, status_opts.opt_display) AS opt_display
  FROM all_q LEFT JOIN opts USING (question_id)
  LEFT JOIN status_opts ON status_opts.id = all_q.id AND question_id = 'status'),
defs AS (
  SELECT DISTINCT id AS questionnaire_id, question_id, text_def, value_set_url, opt_code, opt_display
  FROM q_options WHERE id IN (SELECT id FROM used_q)),
def_opts AS (
  SELECT questionnaire_id AS q, question_id, opt_code AS val_code, min(opt_display) AS opt_display
  FROM defs WHERE opt_code IS NOT NULL GROUP BY ALL),
def_text AS (SELECT questionnaire_id AS q, question_id, min(text_def) AS text_def FROM defs
  WHERE text_def IS NOT NULL GROUP BY ALL)"""

JOIN_OPTIONS = """LEFT JOIN def_opts o ON o.q = split_part(i.ref, '/', -1)
  AND o.question_id = i.question_id AND o.val_code = i.val_code"""
JOIN_TEXTS = """LEFT JOIN def_text t ON t.q = split_part(i.ref, '/', -1)
  AND t.question_id = i.question_id"""

ANSWER = """coalesce(opt_display, val_disp_resp, val_string, val_integer, val_decimal, val_boolean,
           val_date, val_datetime, val_time, val_uri,
           val_qty || coalesce(' ' || val_qty_unit, ''), i.val_code)"""

SURVEY_LONG = f"""survey_long AS (
  SELECT coalesce(pat.pid, i.patient_uuid) AS pid, i.question_id AS code,
         coalesce(text_def, text_resp) AS display, {ANSWER} AS answer, date
  FROM (SELECT * FROM items WHERE question_id IS NOT NULL) i
  {JOIN_OPTIONS} {JOIN_TEXTS}
  LEFT JOIN pat ON pat.patient_uuid = i.patient_uuid
  WHERE {ANSWER} IS NOT NULL AND coalesce(text_def, text_resp) IS NOT NULL)"""

FULL_LONG = """full_long AS (
  SELECT pid, code, display, value, date FROM obs_long
  UNION ALL SELECT pid, code, display, answer, date FROM survey_long)"""

OBSERVED = (PAT, OBS, OBS_LONG)
SURVEYED = (PAT, ORD, ITEMS, QUESTIONS, SURVEY_LONG)
EVERYTHING = (PAT, OBS, OBS_LONG, ORD, ITEMS, QUESTIONS, SURVEY_LONG, FULL_LONG)

VOCAB_OBS = """vocab_obs AS (
  SELECT 'observation_codes' AS vocab_id, code, min(display) AS display FROM obs_long
  WHERE code IS NOT NULL AND display IS NOT NULL GROUP BY code)"""
VOCAB_Q = """vocab_q AS (
  SELECT 'question_codes' AS vocab_id, code, min(display) AS display FROM survey_long
  WHERE code IS NOT NULL AND display IS NOT NULL GROUP BY code)"""
VOCAB_OPT = """vocab_opt AS (
  SELECT question_id AS vocab_id, opt_code AS code, min(opt_display) AS display FROM defs
  WHERE question_id IS NOT NULL AND opt_code IS NOT NULL AND opt_display IS NOT NULL
  GROUP BY ALL)"""
VOCAB_ALL = """vocab_all AS (
  SELECT * FROM vocab_obs UNION ALL SELECT * FROM vocab_q UNION ALL SELECT * FROM vocab_opt)"""
