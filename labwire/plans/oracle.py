"""DuckDB SQL that states the expected result of every registered query.

The expected values are computed from ``orders`` and ``customer`` with the
fixture rules (FIXTURES.md), never by parsing message text, so the Spark
parser is checked independently.  Tables are the driver's pre-registered
views: ``orders customer nation``.
"""

from __future__ import annotations

CR = "chr(13)"

# Per-order facts: k, its message pieces, expected fields and route.
_BASE = f"""
n_all AS (SELECT count(*) AS n FROM orders),
b AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, c.c_nationkey AS nk,
         CAST(o.o_orderdate AS DATE) AS od,
         strftime(o.o_orderdate, '%Y%m%d') AS ymd,
         o.o_orderkey - CASE WHEN o.o_orderkey % 5 = 4 THEN 1 ELSE 0 END AS bk,
         lpad(CAST(o.o_orderkey % 24 AS VARCHAR), 2, '0') AS hh,
         lpad(CAST(o.o_orderkey % 60 AS VARCHAR), 2, '0') AS mi,
         CAST(10000 + o.o_orderkey % 50 AS VARCHAR) || '-' || CAST(o.o_orderkey % 10 AS VARCHAR) AS lc
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
p AS (
  SELECT b.*, n_all.n,
    CAST(bk % 3 AS INTEGER) AS part,
    CASE WHEN k % 83 = 11 THEN 'empty'
         WHEN k % 71 = 8 OR k % 73 = 9 OR k % 79 = 10 OR k % 137 = 43 THEN 'unparseable'
         WHEN k % 41 = 0 THEN 'no_message_id'
         WHEN k % 43 = 1 OR k % 7 = 3 THEN 'bad_mfl'
         WHEN k % 11 = 5 THEN 'dlq' ELSE 'valid' END AS route,
    CASE WHEN k % 41 = 0 THEN ''
         ELSE 'MSG' || lpad(CAST(bk AS VARCHAR), 8, '0') || CASE WHEN bk % 131 = 41 THEN repeat('Y', 100) ELSE '' END
    END AS mid_raw,
    CASE WHEN k % 107 = 23 THEN 'A' || chr(57345) || 'B' || chr(1) || 'FC\\T\\D'
         WHEN k % 113 = 31 THEN 'APPLICATION-NAME-OVER-25-CHARS'
         WHEN k % 19 = 4 THEN 'A\\T\\B' ELSE 'APP' || CAST(k % 4 AS VARCHAR) END AS app_raw,
    CASE WHEN k % 107 = 23 THEN 'A' || chr(57345) || 'B' || chr(1) || 'FC&D'
         WHEN k % 113 = 31 THEN 'APPLICATION-NAME-OVER-25-CHARS'
         WHEN k % 19 = 4 THEN 'A&B' ELSE 'APP' || CAST(k % 4 AS VARCHAR) END AS app,
    CASE WHEN k % 43 = 1 THEN ''
         WHEN k % 7 = 3 THEN '1' || lpad(CAST(ck AS VARCHAR), 7, '0')
         ELSE CAST(1000 + ck % 9000 AS VARCHAR) END AS mfl,
    CASE WHEN k % 11 = 5 THEN ''
         WHEN k % 47 = 2 THEN '""'
         WHEN k % 109 = 29 THEN 'LAB-TOO-LONG-1'
         ELSE 'L' || lpad(CAST(nk AS VARCHAR), 2, '0') END AS lab_raw,
    CASE WHEN k % 73 = 9 THEN 'ORU^R01^ORU_R01'
         WHEN k % 137 = 43 THEN 'OML^O21^OML_021'
         WHEN k % 17 = 1 THEN 'OML^O21'
         ELSE 'OML^O21^OML_O21' END AS mtype,
    CASE WHEN k % 79 = 10 THEN '2.4' ELSE '2.5' END AS ver,
    CASE WHEN k % 139 = 47 THEN '19900230' WHEN k % 149 = 53 THEN '1990' ELSE '19900102' END AS dob_raw,
    CASE WHEN k % 151 = 59 THEN '' WHEN k % 3 = 0 THEN 'M' WHEN k % 3 = 1 THEN 'F' ELSE 'U' END AS sex,
    CASE WHEN k % 89 = 12 THEN ''
         WHEN k % 13 = 7 THEN '^CBC^^' || lc
         ELSE lc || '^CBC^LN' END AS obr4,
    CASE WHEN k % 59 = 4 THEN ymd
         WHEN k % 61 = 5 THEN '20230231' || hh || mi || '00'
         WHEN k % 67 = 6 THEN ymd || '240000'
         ELSE ymd || hh || mi || '37+0200' END AS obr7,
    CASE WHEN k % 59 = 4 OR (k % 103 = 19 AND k % 53 <> 3) THEN NULL
         WHEN k % 61 = 5 THEN DATE '2023-02-28'
         WHEN k % 67 = 6 THEN od + 1
         ELSE od END AS odate,
    CASE WHEN k % 59 = 4 OR (k % 103 = 19 AND k % 53 <> 3) THEN NULL
         WHEN k % 61 = 5 THEN hh || ':' || mi || ':00'
         WHEN k % 67 = 6 THEN '00:00:00'
         ELSE hh || ':' || mi || ':00' END AS otime,
    'ORD-' || CAST(k AS VARCHAR) || CASE WHEN k % 127 = 37 THEN '-' || repeat('X', 50) ELSE '' END AS oid_raw,
    CASE WHEN k % 53 = 3 THEN (CASE WHEN k % 97 = 13 AND k % 103 <> 19 THEN 'SECOND' END)
         WHEN k % 101 = 17 THEN NULL
         ELSE 'ORD-' || CAST(k AS VARCHAR) || CASE WHEN k % 127 = 37 THEN '-' || repeat('X', 50) ELSE '' END END AS oid,
    CASE WHEN k % 89 = 12 OR (k % 103 = 19 AND k % 53 <> 3) THEN NULL ELSE lc END AS loinc
  FROM b, n_all
),
s AS (
  SELECT p.*,
    NULLIF(mid_raw, '') AS mid,
    NULLIF(lab_raw, '') AS lab,
    'MSH|^~\\&|' || app_raw || '^1.2^ISO|FAC^' || mfl || '^L|LAB|' || lab_raw || '^9^L|' || ymd
      || '080000||' || mtype || '|' || mid_raw || '|P|' || ver || '||||AL' AS seg_msh,
    'PID|1||P' || CAST(ck AS VARCHAR) || '^^^MRN~X^^^ALT||Banda&van^Mary||' || dob_raw || '|' || sex AS seg_pid,
    CASE WHEN k % 53 <> 3 THEN (CASE WHEN k % 101 = 17 THEN 'ORC' ELSE 'ORC|NW|' || oid_raw || '^SCP' END) END AS seg_orc,
    CASE WHEN k % 103 = 19 THEN 'ORC' END AS seg_bare,
    'OBR|1|x||' || obr4 || '|||' || obr7 AS seg_obr,
    CASE WHEN k % 97 = 13 THEN 'ORC|NW|SECOND' END AS seg_orc2,
    CASE WHEN k % 97 = 13 THEN 'OBR|2|x||99999-9^Z^LN|||199901010000' END AS seg_obr2,
    CASE WHEN k % 2 = 0 THEN chr(13) || chr(10) ELSE chr(13) END AS sep
  FROM p
),
m AS (
  SELECT s.*,
    CASE WHEN k % 83 = 11 THEN ''
         WHEN k % 71 = 8 THEN 'not an hl7 message ' || CAST(k AS VARCHAR)
         ELSE concat_ws(sep, seg_msh, seg_pid, seg_orc, seg_bare, seg_obr,
                        CASE WHEN k % 3 = 0 THEN 'NTE|1||fasting' END,
                        CASE WHEN k % 9 = 0 THEN 'NTE|2||repeat' END,
                        seg_orc2, seg_obr2) || sep END AS raw_message
  FROM s
),
v AS (
  SELECT k, part, oid AS order_id, mid AS message_ref_id, mfl AS mfl_code, odate AS order_date,
         otime AS order_time, app AS sending_application, loinc AS test_id, lab AS lab_code, n
  FROM m WHERE route = 'valid'
),
st AS (
  SELECT order_id, message_ref_id, mfl_code, order_date, order_time, sending_application, test_id, lab_code, k, n
  FROM v QUALIFY row_number() OVER (PARTITION BY message_ref_id ORDER BY k DESC) = 1
)"""

_STORED = "order_id, message_ref_id, mfl_code, order_date, order_time, sending_application, test_id, lab_code"
_POS = 'part AS "partition", k AS "offset"'


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip() + "\n"


_UPSERT = f"""
, t_rows AS (SELECT * FROM v WHERE 2 * k < n),
u_rows AS (SELECT * FROM v WHERE 4 * k >= n),
t_ids AS (SELECT message_ref_id, row_number() OVER (ORDER BY min(k)) AS id FROM t_rows GROUP BY message_ref_id),
t_last AS (SELECT * FROM t_rows QUALIFY row_number() OVER (PARTITION BY message_ref_id ORDER BY k DESC) = 1),
target AS (SELECT i.id, l.* FROM t_last l JOIN t_ids i USING (message_ref_id)),
u_last AS (SELECT * FROM u_rows QUALIFY row_number() OVER (PARTITION BY message_ref_id ORDER BY k DESC) = 1),
u_new AS (
  SELECT message_ref_id,
         (SELECT max(id) FROM target) + row_number() OVER (ORDER BY min(k)) AS id
  FROM u_rows WHERE message_ref_id NOT IN (SELECT message_ref_id FROM target)
  GROUP BY message_ref_id
),
state AS (
  SELECT id, {_STORED} FROM target WHERE message_ref_id NOT IN (SELECT message_ref_id FROM u_last)
  UNION ALL
  SELECT coalesce(t.id, nw.id) AS id, u.order_id, u.message_ref_id, u.mfl_code, u.order_date,
         u.order_time, u.sending_application, u.test_id, u.lab_code
  FROM u_last u LEFT JOIN target t USING (message_ref_id) LEFT JOIN u_new nw USING (message_ref_id)
)
SELECT id, {_STORED} FROM state
"""

# the columns that O3 looks rows up by
LOOKUP_KEYS = ("lab_code", "mfl_code", "message_ref_id", "order_id", "sending_application", "test_id")

_BUSIEST_FAC = """
, top AS (SELECT mfl_code FROM st WHERE mfl_code IS NOT NULL GROUP BY mfl_code ORDER BY count(*) DESC, mfl_code LIMIT 1)
"""

ORACLE: dict[str, str] = {
    "decode_sanitize": _q(f"""
SELECT {_POS}, (k % 83 = 11) AS is_empty,
  CASE WHEN k % 83 = 11 THEN ''
       WHEN k % 71 = 8 THEN 'not an hl7 message ' || CAST(k AS VARCHAR)
       ELSE concat_ws({CR}, seg_msh, seg_pid, seg_orc, seg_bare, seg_obr) || {CR}
            || CASE WHEN k % 9 = 0 THEN {CR} ELSE '' END
            || CASE WHEN k % 97 = 13 THEN seg_orc2 || {CR} || seg_obr2 || {CR} ELSE '' END
  END AS message
FROM m"""),
    "segments_long": _q(f"""
, er7 AS (SELECT part, k, 3 + CASE WHEN k % 53 <> 3 THEN 1 ELSE 0 END + CASE WHEN k % 103 = 19 THEN 1 ELSE 0 END AS obr_idx FROM m
          WHERE k % 83 <> 11 AND k % 71 <> 8),
segs AS (
  SELECT part, k, 1 AS seg_idx, 'MSH' AS seg_name, 16 AS n_fields FROM er7
  UNION ALL SELECT part, k, 2, 'PID', 9 FROM er7
  UNION ALL SELECT part, k, 3, 'ORC', CASE WHEN k % 101 = 17 THEN 1 ELSE 3 END FROM er7 WHERE k % 53 <> 3
  UNION ALL SELECT part, k, obr_idx - 1, 'ORC', 1 FROM er7 WHERE k % 103 = 19
  UNION ALL SELECT part, k, obr_idx, 'OBR', 8 FROM er7
  UNION ALL SELECT part, k, obr_idx + 1, 'ORC', 3 FROM er7 WHERE k % 97 = 13
  UNION ALL SELECT part, k, obr_idx + 2, 'OBR', 8 FROM er7 WHERE k % 97 = 13
)
SELECT {_POS}, CAST(seg_idx AS INTEGER) AS seg_idx, seg_name, CAST(n_fields AS INTEGER) AS n_fields FROM segs"""),
    "oml_gate": _q(f"""
SELECT {_POS}, 'OML_O21' AS structure, '2.5' AS version FROM m
WHERE route NOT IN ('empty', 'unparseable')"""),
    "oru_gate": _q(f"""
SELECT {_POS}, 'ORU_R01' AS structure, '2.5' AS version FROM m
WHERE k % 73 = 9 AND k % 83 <> 11 AND k % 71 <> 8 AND k % 79 <> 10"""),
    "lab_orders": _q(f"""
SELECT mid AS message_ref_id, app AS sending_application, mfl AS mfl_code, lab AS lab_code,
       oid AS order_id, loinc, odate AS order_date, otime AS order_time, raw_message
FROM m WHERE route IN ('bad_mfl', 'dlq', 'valid')"""),
    "header_projection": _q(f"""
, h AS (SELECT *, k % 17 = 1 AS no_struct FROM m WHERE route NOT IN ('empty', 'unparseable'))
SELECT {_POS},
  CASE WHEN no_struct THEN NULL ELSE 'ACK' END AS message_type,
  CASE WHEN no_struct THEN NULL ELSE '2.5' END AS version,
  CASE WHEN no_struct THEN NULL ELSE strftime(od, '%Y-%m-%d') || ' 08:00:00' END AS timestamp,
  CASE WHEN no_struct THEN NULL ELSE NULLIF(mfl, '') END AS sender_id,
  CASE WHEN no_struct THEN NULL ELSE lab END AS receiver_id,
  CASE WHEN no_struct THEN NULL ELSE mid END AS message_id,
  CASE WHEN no_struct THEN NULL ELSE 'AL' END AS ack_type
FROM h"""),
    "patient_projection": _q(f"""
, q AS (SELECT *, k % 151 = 59 OR (k % 149 = 53 AND k % 139 <> 47) AS no_patient
      FROM m WHERE route NOT IN ('empty', 'unparseable'))
SELECT {_POS},
  CASE WHEN no_patient THEN NULL ELSE 'P' || CAST(ck AS VARCHAR) END AS id,
  CASE WHEN no_patient THEN NULL ELSE 'Mary' END AS first_name,
  CASE WHEN no_patient THEN NULL ELSE 'Banda' END AS last_name,
  CASE WHEN no_patient THEN NULL WHEN sex = 'M' THEN 'MALE' WHEN sex = 'F' THEN 'FEMALE' ELSE 'OTHER' END AS gender,
  CASE WHEN no_patient THEN NULL WHEN k % 139 = 47 THEN '1990-02-28' ELSE '1990-01-02' END AS dob
FROM q"""),
    "header_any": _q(f"""
, h AS (SELECT *, k % 17 = 1 AND k % 73 <> 9 AND k % 137 <> 43 AS no_struct FROM m WHERE k % 83 <> 11 AND k % 71 <> 8)
SELECT {_POS},
  CASE WHEN no_struct THEN NULL WHEN k % 73 = 9 THEN 'ORU_R01' WHEN k % 137 = 43 THEN 'OML_021' ELSE 'ACK' END AS message_type,
  CASE WHEN no_struct THEN NULL ELSE ver END AS version,
  CASE WHEN no_struct THEN NULL ELSE NULLIF(mfl, '') END AS sender_id,
  CASE WHEN no_struct THEN NULL ELSE lab END AS receiver_id
FROM h"""),
    "delete_guard": _q("""
, del AS (SELECT DISTINCT CAST(1000 + c_custkey % 9000 AS VARCHAR) AS mfl_code FROM customer WHERE c_custkey % 50 = 0)
SELECT mfl_code FROM del WHERE mfl_code IN (SELECT mfl_code FROM st)"""),
    "date_layout_scan": _q("""
SELECT message_ref_id, mfl_code, order_date FROM st
WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '1998-02-28' AND mfl_code >= '1050'"""),
    "lookup_keys": _q("".join(f"""
, t_{c} AS (SELECT {c} AS v FROM st WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
                              for c in LOOKUP_KEYS) + "\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS lookup_key, message_ref_id FROM st WHERE {c} = (SELECT v FROM t_{c})" for c in LOOKUP_KEYS)),
    "route_each": _q(f"SELECT {_POS}, route FROM m"),
    "route_counts": _q("SELECT route, count(*) AS n FROM m GROUP BY route"),
    "valid_orders": _q(f"SELECT {_STORED} FROM v"),
    "dead_letters": _q("SELECT raw_message AS value FROM m WHERE route = 'dlq'"),
    "reject_report": _q("""
SELECT k AS "offset", route, substr(raw_message, 1, 100) AS preview FROM m
WHERE route IN ('empty', 'unparseable', 'no_message_id', 'bad_mfl')"""),
    "split_partition_check": _q("""
SELECT count(*) AS n_f5, count(*) FILTER (WHERE route = 'valid') AS n_valid,
       count(*) FILTER (WHERE route = 'dlq') AS n_dlq, CAST(0 AS BIGINT) AS n_overlap,
       CAST(0 AS BIGINT) AS n_uncovered
FROM m WHERE route IN ('dlq', 'valid')"""),
    "latest_per_message": _q(f"SELECT {_STORED} FROM st"),
    "upsert_state": _q(_UPSERT),
    "replay": _q(_UPSERT),
    "duplicate_keys": _q("SELECT message_ref_id, count(*) AS n FROM v GROUP BY message_ref_id HAVING count(*) > 1"),
    "contract_violations": _q("""
, rules AS (
  SELECT message_ref_id, 'not_null' AS rule, 'mfl_code' AS column_name FROM st WHERE mfl_code IS NULL
  UNION ALL SELECT message_ref_id, 'not_null', 'order_id' FROM st WHERE order_id IS NULL
  UNION ALL SELECT message_ref_id, 'not_null', 'test_id' FROM st WHERE test_id IS NULL
  UNION ALL SELECT message_ref_id, 'not_null', 'order_date' FROM st WHERE order_date IS NULL
  UNION ALL SELECT message_ref_id, 'not_null', 'order_time' FROM st WHERE order_time IS NULL
  UNION ALL SELECT message_ref_id, 'not_null', 'message_ref_id' FROM st WHERE message_ref_id IS NULL
  UNION ALL SELECT message_ref_id, 'max_length', 'order_id' FROM st WHERE length(order_id) > 50
  UNION ALL SELECT message_ref_id, 'max_length', 'message_ref_id' FROM st WHERE length(message_ref_id) > 100
  UNION ALL SELECT message_ref_id, 'max_length', 'sending_application' FROM st WHERE length(sending_application) > 25
  UNION ALL SELECT message_ref_id, 'max_length', 'lab_code' FROM st WHERE length(lab_code) > 10
)
SELECT message_ref_id, rule, column_name FROM rules"""),
    "fk_facility": _q("""
, fac AS (SELECT DISTINCT CAST(1000 + c_custkey % 9000 AS VARCHAR) AS mfl_code FROM customer WHERE c_custkey % 20 <> 0)
SELECT message_ref_id, mfl_code FROM st WHERE mfl_code IS NULL OR mfl_code NOT IN (SELECT mfl_code FROM fac)"""),
    "fk_lab": _q("""
, labs AS (SELECT 'L' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS lab_code FROM nation WHERE n_nationkey <= 22)
SELECT message_ref_id, lab_code FROM st WHERE lab_code IS NOT NULL AND lab_code NOT IN (SELECT lab_code FROM labs)"""),
    "facility_rename": _q("""
, ren AS (SELECT DISTINCT CAST(1000 + c_custkey % 9000 AS VARCHAR) AS old_code,
                 '9' || right(CAST(1000 + c_custkey % 9000 AS VARCHAR), 3) AS new_code
          FROM customer WHERE c_custkey % 50 = 0)
SELECT message_ref_id, coalesce(r.new_code, st.mfl_code) AS mfl_code
FROM st LEFT JOIN ren r ON st.mfl_code = r.old_code"""),
    "facility_timeline": _q(_BUSIEST_FAC + """
SELECT row_number() OVER (ORDER BY order_date DESC NULLS FIRST, message_ref_id) AS rn,
       message_ref_id, order_date, order_time
FROM st WHERE mfl_code = (SELECT mfl_code FROM top)"""),
    "facility_test": _q("""
, top AS (SELECT mfl_code, test_id FROM st WHERE mfl_code IS NOT NULL AND test_id IS NOT NULL
          GROUP BY mfl_code, test_id ORDER BY count(*) DESC, mfl_code, test_id LIMIT 1)
SELECT message_ref_id, mfl_code, test_id, order_date FROM st
WHERE (mfl_code, test_id) IN (SELECT (mfl_code, test_id) FROM top)"""),
    "lookup_by_key": _q("""
SELECT message_ref_id, sending_application, order_id FROM st WHERE sending_application = 'A&B'"""),
    "orders_by_date": _q("""
SELECT row_number() OVER (ORDER BY order_date DESC NULLS LAST, message_ref_id) AS rn, message_ref_id, order_date
FROM st"""),
    "add_lab_code_column": _q("""
SELECT message_ref_id, mfl_code, CASE WHEN 2 * k < n THEN NULL ELSE lab_code END AS lab_code FROM st"""),
}
