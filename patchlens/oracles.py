"""DuckDB SQL for every registered query (same column names, same values).

The SQL is written independently of the Spark plans where that is natural:
the recommended list, for example, is computed here with DuckDB list
functions (sorted list per product line, position of the first qualifying
element, slice), while Spark computes it relationally.
"""

from __future__ import annotations

_HOSTS = """
inst AS (SELECT o.o_custkey AS hostname, max(l.l_partkey) AS last_kb
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey),
hosts AS (SELECT c.c_custkey AS hostname, c.c_nationkey AS os_line, c.c_name AS codename,
                 c.c_mktsegment AS version, i.last_kb
          FROM customer c LEFT JOIN inst i ON c.c_custkey = i.hostname),
cat AS (SELECT s.s_nationkey AS product, l.l_partkey AS kb, s.s_name AS cve,
               CAST(l.l_shipdate AS DATE) AS release_date, l.l_orderkey
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
kd AS (SELECT product, kb, max(release_date) AS d FROM cat GROUP BY product, kb),
lists AS (SELECT product, list(struct_pack(kb := kb, d := d) ORDER BY kb) AS arr FROM kd GROUP BY product),
hl AS (SELECT h.*, l.arr,
              list_position(list_transform(l.arr, lambda e: coalesce(e.kb > h.last_kb
                    AND date_trunc('month', e.d) = date_trunc('month', l.arr[-1].d), false)), true) AS p
       FROM hosts h LEFT JOIN lists l ON l.product = h.os_line),
hr AS (SELECT *, CASE WHEN p IS NULL OR p = 0 THEN [] ELSE arr[p:] END AS rec FROM hl)
"""

ORACLES: dict[str, str] = {
    "exposure_open_items": f"""
WITH {_HOSTS},
hc AS (SELECT DISTINCT h.hostname, c.cve FROM hosts h JOIN cat c
       ON c.product = h.os_line AND c.kb > h.last_kb)
SELECT h.hostname, h.os_line, coalesce(CAST(h.last_kb AS VARCHAR), '') AS last_kb,
       coalesce(hc.cve, '') AS cve
FROM hosts h LEFT JOIN hc ON h.hostname = hc.hostname
""",
    "exposure_recommended_list": f"""
WITH {_HOSTS}
SELECT hostname, os_line, coalesce(CAST(last_kb AS VARCHAR), '') AS last_kb,
       array_to_string(list_transform(rec, lambda e: CAST(e.kb AS VARCHAR) || ':' || strftime(e.d, '%Y-%m-%d')), ',') AS rec_kb_text
FROM hr
""",
    "exposure_full_report": f"""
WITH {_HOSTS},
first_order AS (SELECT o_custkey, min(o_orderdate) AS first_ts FROM orders GROUP BY o_custkey),
kb_label AS (SELECT l.l_partkey AS kb, strftime(max(strptime(strftime(o.o_orderdate, '%Y-%b'), '%Y-%b')), '%Y-%b') AS label
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY l.l_partkey),
hc AS (SELECT DISTINCT h.hostname, c.cve FROM hr h JOIN cat c
       ON c.product = h.os_line AND c.kb > h.last_kb WHERE len(h.rec) > 0)
SELECT CAST(h.hostname AS VARCHAR) AS hostname, coalesce(h.codename, '') AS os_name,
       coalesce(h.version, '') AS os_version, coalesce(CAST(h.last_kb AS VARCHAR), '') AS last_kb,
       coalesce(kl.label, '') AS last_kb_date,
       coalesce(strftime(f.first_ts, '%Y-%m-%d %H:%M:%S'), '') AS last_update_date,
       array_to_string(list_transform(h.rec, lambda e: CAST(e.kb AS VARCHAR) || ':' || strftime(e.d, '%Y-%m-%d')), ',') AS rec_kb_text,
       coalesce(hc.cve, '') AS cve
FROM hr h LEFT JOIN hc ON h.hostname = hc.hostname
LEFT JOIN kb_label kl ON kl.kb = h.last_kb
LEFT JOIN first_order f ON f.o_custkey = h.hostname
""",
    "newest_label_per_item": """
WITH lab AS (SELECT DISTINCT l.l_partkey AS kb, strftime(o.o_orderdate, '%Y-%b') AS label
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
nl AS (SELECT kb, strftime(max(strptime(label, '%Y-%b')), '%Y-%b') AS newest_label FROM lab GROUP BY kb)
SELECT p.p_partkey, coalesce(nl.newest_label, '') AS newest_label
FROM part p LEFT JOIN nl ON p.p_partkey = nl.kb
""",
    "mart_wide_star": """
WITH v AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%b') AS doc_xml_date,
                  'CVE-' || CAST(o_orderkey AS VARCHAR) AS cve, o_orderpriority AS vul_title,
                  o_orderstatus AS cwe FROM orders),
st AS (SELECT l_orderkey AS fk, l_linestatus AS status_type,
              array_to_string(list_sort(list_distinct(list(l_partkey))), ',') AS status_product_id
       FROM lineitem GROUP BY l_orderkey, l_linestatus),
ss AS (SELECT l_orderkey AS fk, l_returnflag AS base_score, printf('%.2f', l_tax) AS temporal_score,
              array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS score_set_product_id
       FROM lineitem GROUP BY 1, 2, 3),
di AS (SELECT strftime(o_orderdate, '%Y-%b') AS id,
              strftime(min(o_orderdate), '%Y-%m-%d') AS initial_relise_date,
              strftime(max(o_orderdate), '%Y-%m-%d') AS current_relise_date
       FROM orders GROUP BY 1)
SELECT DISTINCT v.doc_xml_date, v.cve, v.vul_title, v.cwe,
       coalesce(st.status_type, '') AS status_type,
       coalesce(st.status_product_id, '') AS status_product_id,
       coalesce(ss.base_score, '') AS base_score, coalesce(ss.temporal_score, '') AS temporal_score,
       coalesce(ss.score_set_product_id, '') AS score_set_product_id,
       coalesce(di.initial_relise_date, '') AS doc_initial_relise_date,
       coalesce(di.current_relise_date, '') AS doc_current_relise_date
FROM v LEFT JOIN st ON v.id = st.fk LEFT JOIN ss ON v.id = ss.fk LEFT JOIN di ON v.doc_xml_date = di.id
""",
    "mart_revision_right_join": """
WITH r AS (SELECT o_custkey AS fk, strftime(o_orderdate, '%Y-%m-%d') AS rev_date,
                  CAST(o_totalprice AS VARCHAR) AS number, o_orderpriority AS description FROM orders),
mr AS (SELECT fk, max(rev_date) AS rev_date, max(TRY_CAST(number AS FLOAT)) AS number FROM r GROUP BY fk)
SELECT mr.fk, mr.rev_date, CAST(mr.number AS DOUBLE) AS rev_number,
       coalesce(r.description, '') AS rev_description
FROM r RIGHT JOIN mr ON r.rev_date = mr.rev_date AND TRY_CAST(r.number AS FLOAT) = mr.number AND r.fk = mr.fk
""",
    "mart_catalog_top_build": """
WITH rem AS (
  SELECT strftime(o.o_orderdate, '%Y-%b') AS doc_xml_date, 'CVE-' || CAST(l.l_orderkey AS VARCHAR) AS cve,
         CASE WHEN l.l_returnflag = 'R' THEN '' ELSE CAST(l.l_suppkey AS VARCHAR) END AS kb,
         [CAST(l.l_partkey AS VARCHAR)] AS product_id,
         '10.0.' || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS fixed_build,
         printf('%.2f', l.l_discount) AS base_score, printf('%.2f', l.l_tax) AS temporal_score,
         l.l_linestatus AS cwe, o.o_orderpriority AS vul_title
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
pn AS (SELECT DISTINCT ids.doc_xml_date, ids.kb, ids.id AS product_id, p.p_name AS product_name, ids.fixed_build
       FROM (SELECT doc_xml_date, kb, fixed_build, unnest(product_id) AS id FROM rem) ids
       LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = ids.id),
ranked AS (
  SELECT r.doc_xml_date, r.cve, pn.kb, pn.product_id AS kb_product_id, pn.product_name AS product_names,
         pn.fixed_build, r.base_score, r.temporal_score, r.cwe, r.vul_title,
         row_number() OVER (PARTITION BY r.cve, r.doc_xml_date, pn.kb, pn.product_id, pn.product_name
                            ORDER BY pn.fixed_build DESC, r.base_score DESC, r.temporal_score DESC,
                                     r.cwe DESC, r.vul_title DESC) AS rn
  FROM rem r JOIN pn ON pn.doc_xml_date = r.doc_xml_date AND pn.kb = r.kb
  WHERE r.kb <> '')
SELECT doc_xml_date, cve, kb, kb_product_id, product_names, fixed_build, base_score, temporal_score, cwe, vul_title
FROM ranked WHERE rn = 1
""",
    "collect_distinct_1key": """
SELECT l_orderkey,
       array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS threats_type,
       array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS treat_description
FROM lineitem GROUP BY l_orderkey
""",
    "collect_distinct_2key": """
SELECT l_orderkey, l_linestatus, array_to_string(list_sort(list_distinct(list(l_partkey))), ',') AS product_id
FROM lineitem GROUP BY l_orderkey, l_linestatus
""",
    "collect_distinct_3key": """
SELECT l_orderkey, l_returnflag, l_linestatus,
       array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS product_id
FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus
""",
    "latest_per_key": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""",
    "argmax_per_group": """
SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ASC) AS rn
  FROM orders) WHERE rn = 1
""",
    "normalise_prefix": """
SELECT * FROM (
  SELECT p_partkey, p_name,
         CASE WHEN starts_with(p_name, 'small') THEN 'small items'
              WHEN starts_with(p_name, 'large') THEN 'large items'
              WHEN starts_with(p_name, 'red') THEN 'red items'
              WHEN starts_with(p_name, 'blue') THEN 'blue items'
              WHEN starts_with(p_name, 'hot') THEN 'hot items'
              WHEN starts_with(p_name, 'cold') THEN 'cold items'
              ELSE p_name END AS product_line
  FROM part)
WHERE product_line IN ('small items', 'large items', 'red items', 'blue items', 'hot items')
""",
    "normalise_contains": """
SELECT p_partkey, p_name,
       CASE WHEN contains(p_name, 'bolt') OR contains(p_name, 'rod') THEN 'fasteners'
            WHEN contains(p_name, 'gear') OR contains(p_name, 'ring') THEN 'drive parts'
            WHEN contains(p_name, 'widget') OR contains(p_name, 'gizmo') THEN 'gadgets'
            ELSE p_name END AS product_line
FROM part
""",
    "strip_chars_to_int": """
SELECT c_custkey, TRY_CAST(ltrim(c_name, 'Customer#') AS BIGINT) AS key_from_name FROM customer
""",
    "digits_or_empty": """
SELECT event_id,
       CASE WHEN regexp_full_match(json_extract_string(props, '$.k'), '[0-9]+')
            THEN json_extract_string(props, '$.k') ELSE '' END AS kb,
       CASE WHEN regexp_full_match(event_type, '[0-9]+') THEN event_type ELSE '' END AS type_digits
FROM events
""",
    "like_anti_filter": """
SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE 'small%'
""",
    "recent_month_filter": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
WHERE month(o_orderdate) >= month(DATE '1998-03-10') - 1
""",
    "recent_month_filter_calendar": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
WHERE o_orderdate >= date_trunc('month', DATE '1998-03-10') - INTERVAL 1 MONTH
""",
    "label_format_parse": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%b') AS label,
       strftime(strptime(strftime(o_orderdate, '%Y-%b'), '%Y-%b'), '%Y-%m-%d') AS label_first_day,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day,
       date_trunc('month', strptime(strftime(o_orderdate, '%Y-%b'), '%Y-%b')) = date_trunc('month', o_orderdate) AS same_month
FROM orders
""",
    "epoch_to_ts": """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch,
       strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS ts_text
FROM events
""",
    "missing_months": """
WITH b AS (SELECT year(min(o_orderdate)) AS y0, year(max(o_orderdate)) AS y1 FROM orders),
spine AS (SELECT CAST(m AS DATE) AS month_start
          FROM b, generate_series(make_date(b.y0, 1, 1), make_date(b.y1, 12, 1), INTERVAL 1 MONTH) t(m)),
loaded AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%b') AS label FROM orders)
SELECT strftime(month_start, '%Y-%b') AS label, strftime(month_start, '%Y-%m-%d') AS month_start
FROM spine WHERE strftime(month_start, '%Y-%b') NOT IN (SELECT label FROM loaded)
""",
    "explode_inner": """
WITH a AS (
  SELECT o.o_orderkey, l.l_linenumber,
         CASE WHEN l.l_orderkey IS NULL THEN NULL
              ELSE list_filter([l.l_partkey, l.l_suppkey], lambda x: x % 3 <> 0) END AS arr
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
SELECT o_orderkey, l_linenumber, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS item,
       CAST(len(arr) AS INTEGER) AS arr_size, arr[-1] AS last_item
FROM a
""",
    "explode_outer": """
WITH a AS (
  SELECT o.o_orderkey, l.l_linenumber,
         CASE WHEN l.l_orderkey IS NULL THEN NULL
              ELSE list_filter([l.l_partkey, l.l_suppkey], lambda x: x % 3 <> 0) END AS arr
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
SELECT o_orderkey, l_linenumber, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS item,
       CAST(len(arr) AS INTEGER) AS arr_size, arr[-1] AS last_item
FROM a WHERE len(arr) > 0
UNION ALL
SELECT o_orderkey, l_linenumber, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS BIGINT) AS item,
       CAST(len(arr) AS INTEGER) AS arr_size, arr[-1] AS last_item
FROM a WHERE arr IS NULL OR len(arr) = 0
""",
    "distinct_codes": """
SELECT DISTINCT p_brand FROM part
""",
}

_LINES = """
j AS (SELECT l.*, o.o_orderdate, o.o_orderpriority,
             strftime(o.o_orderdate, '%Y-%b') || '#' || CAST(l.l_orderkey AS VARCHAR) || '#' || CAST(l.l_linenumber AS VARCHAR)
             || '#' || CAST(l.l_partkey AS VARCHAR) || '#' || CAST(l.l_suppkey AS VARCHAR)
             || '#' || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || '#' || printf('%.2f', l.l_discount)
             || '#' || printf('%.2f', l.l_tax) || '#' || l.l_returnflag || '#' || l.l_linestatus AS k
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

ORACLES.update({
    "xml_roundtrip_lines": f"""
WITH {_LINES}
SELECT CAST(0 AS BIGINT) AS id, k AS doc_xml_date, 'CVE-' || CAST(l_orderkey AS VARCHAR) AS cve,
       o_orderpriority AS title, l_returnflag AS cwe, l_linestatus AS cwe_text FROM j
UNION ALL
SELECT CAST(1 AS BIGINT), k, 'CVE-S-' || CAST(l_suppkey AS VARCHAR), 'Supplier ' || CAST(l_suppkey AS VARCHAR), '', ''
FROM j WHERE l_returnflag <> 'R'
""",
    "xml_position_key": f"""
WITH {_LINES}
SELECT CAST(0 AS BIGINT) AS vulnerability_fk, k AS doc_xml_date, l_linestatus AS status_type,
       CAST(l_partkey AS VARCHAR) AS product_id FROM j
UNION ALL
SELECT CAST(0 AS BIGINT), k, l_linestatus, CAST(l_suppkey AS VARCHAR) FROM j
UNION ALL
SELECT CAST(1 AS BIGINT), k, 'Supplier', CAST(l_suppkey AS VARCHAR) FROM j WHERE l_returnflag <> 'R'
""",
    "xml_all_children": f"""
WITH {_LINES}
SELECT CAST(0 AS BIGINT) AS vulnerability_fk, k AS doc_xml_date, CAST(l_partkey AS VARCHAR) AS kb,
       'Vendor Fix' AS remediation_type, 'https://example.com/kb/' || CAST(l_partkey AS VARCHAR) AS url,
       CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) AS product_id,
       'Security Update' AS subtype, '10.0.' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS fixed_build
FROM j
UNION ALL
SELECT CAST(0 AS BIGINT), k, '', 'Workaround', '', CAST(l_partkey AS VARCHAR), '', '' FROM j
""",
    "xml_nested_flatten": """
SELECT 'acct-' || CAST(c_custkey AS VARCHAR) AS id, c_name AS product_name, '' AS product_type,
       '' AS branch_name, CAST(c_custkey AS VARCHAR) AS doc_xml_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, 'Nation', n.n_name, CAST(c_custkey AS VARCHAR)
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "xml_document_attrs": """
SELECT strftime(o_orderdate, '%Y-%b') || '#' || CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
       '2.0' AS version, 2 AS revision_history_number,
       strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS revision_history_date,
       o_orderpriority AS revision_history_description,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS initial_relise_date,
       strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS current_relise_date,
       'Vendor' AS publisher_type, CAST(o_custkey AS VARCHAR) AS contact_details,
       'Order desk' AS issuring_authority, 'Order ' || CAST(o_orderkey AS VARCHAR) AS document_title,
       'Order Record' AS document_type, '' AS vlun, '' AS cvrf,
       CAST(2 AS BIGINT) AS note_count, 'Internal' AS last_note_audience
FROM orders
""",
})

ORACLES.update({
    "xml_first_child": f"""
WITH {_LINES}
SELECT CAST(0 AS BIGINT) AS vulnerability_fk, k AS doc_xml_date, printf('%.2f', l_discount) AS base_score,
       printf('%.2f', l_tax) AS temporal_score, l_returnflag || '/' || l_linestatus AS vector,
       CAST(l_suppkey AS VARCHAR) AS product_id
FROM j
""",
    "xml_threats": f"""
WITH {_LINES}
SELECT CAST(0 AS BIGINT) AS vulnerability_fk, k AS doc_xml_date, '' AS title, 'Impact' AS threats_type,
       l_returnflag AS description, CAST(l_suppkey AS VARCHAR) AS product_id
FROM j
""",
    "json_columns_to_rows": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
""",
    "json_records_roundtrip": """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events
""",
    "rename_and_default_load": """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation_id, '' AS title,
       '1998-03-10 00:00:00' AS loaded_at FROM supplier
""",
    "overwrite_month_idempotent": """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%b') AS doc_xml_date FROM orders
""",
})
ORACLES["stream_star_mart"] = ORACLES["mart_wide_star"]
ORACLES["stream_catalog"] = ORACLES["mart_catalog_top_build"]
ORACLES["stream_latest"] = ORACLES["latest_per_key"]
ORACLES["distinct_sets_by_month"] = """
SELECT l_partkey || '/' || CAST(l_quantity AS INTEGER) AS value, count(DISTINCT strftime(o_orderdate, '%Y-%b')) AS months
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE NOT (year(o_orderdate) = 1995 AND l_returnflag = 'N')
GROUP BY ALL
"""
ORACLES["stream_key_parts"] = ORACLES["latest_per_key"]

ORACLES["xml_cve_mart"] = f"""
WITH {_LINES},
v AS (
  SELECT k AS doc, CAST(0 AS BIGINT) AS id, 'CVE-' || CAST(l_orderkey AS VARCHAR) AS cve,
         o_orderpriority AS title, l_returnflag AS cwe, l_linestatus AS cwe_text FROM j
  UNION ALL
  SELECT k, CAST(1 AS BIGINT), 'CVE-S-' || CAST(l_suppkey AS VARCHAR), 'Supplier ' || CAST(l_suppkey AS VARCHAR), '', ''
  FROM j WHERE l_returnflag <> 'R'),
st_rows AS (
  SELECT k AS doc, CAST(0 AS BIGINT) AS id, l_linestatus AS status_type, CAST(l_partkey AS VARCHAR) AS product_id FROM j
  UNION ALL SELECT k, CAST(0 AS BIGINT), l_linestatus, CAST(l_suppkey AS VARCHAR) FROM j
  UNION ALL SELECT k, CAST(1 AS BIGINT), 'Supplier', CAST(l_suppkey AS VARCHAR) FROM j WHERE l_returnflag <> 'R'),
st AS (SELECT doc, id, status_type, array_to_string(list_sort(list_distinct(list(product_id))), ',') AS status_product_id
       FROM st_rows GROUP BY doc, id, status_type),
th AS (SELECT k AS doc, CAST(0 AS BIGINT) AS id, 'Impact' AS threats_type,
              array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS treat_description
       FROM j GROUP BY k),
ss AS (SELECT k AS doc, CAST(0 AS BIGINT) AS id, printf('%.2f', l_discount) AS base_score, printf('%.2f', l_tax) AS temporal_score,
              array_to_string(list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))), ',') AS score_set_product_id
       FROM j GROUP BY k, printf('%.2f', l_discount), printf('%.2f', l_tax)),
rem AS (
  SELECT k AS doc, CAST(0 AS BIGINT) AS id, '10.0.' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS fixed_build,
         CAST(l_partkey AS VARCHAR) AS kb, CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) AS kb_product_id
  FROM j
  UNION ALL SELECT k, CAST(0 AS BIGINT), '', '', CAST(l_partkey AS VARCHAR) FROM j)
SELECT DISTINCT '1998-03-10 00:00:00' AS timestamp, v.doc AS doc_xml_date, v.cve, v.title AS vul_title, v.cwe, v.cwe_text,
       coalesce(st.status_type, '') AS status_type, coalesce(st.status_product_id, '') AS status_product_id,
       '' AS note, coalesce(th.threats_type, '') AS threats_type, coalesce(th.treat_description, '') AS treat_description,
       coalesce(ss.base_score, '') AS base_score, coalesce(ss.temporal_score, '') AS temporal_score,
       coalesce(ss.score_set_product_id, '') AS score_set_product_id,
       CAST(0 AS DOUBLE) AS rev_number, '' AS rev_date, '' AS rev_description,
       coalesce(rem.fixed_build, '') AS fixed_build, coalesce(rem.kb, '') AS kb, coalesce(rem.kb_product_id, '') AS kb_product_id,
       0 AS doc_revision_history_number, '1970-01-01 00:00:00' AS doc_revision_history_date,
       '' AS doc_revision_history_description, '1970-01-01 00:00:00' AS doc_initial_relise_date,
       '1970-01-01 00:00:00' AS doc_current_relise_date, 'Line document' AS doc_document_title
FROM v LEFT JOIN st ON st.doc = v.doc AND st.id = v.id
LEFT JOIN th ON th.doc = v.doc AND th.id = v.id
LEFT JOIN ss ON ss.doc = v.doc AND ss.id = v.id
LEFT JOIN rem ON rem.doc = v.doc AND rem.id = v.id
"""

ORACLES["exposure_salted_report"] = ORACLES["exposure_full_report"]
