"""DuckDB SQL equal to each registered query, written against the driver
tables directly (the feed documents' derivation undone by joins)."""
from __future__ import annotations

ADV_ROWS = """adv_rows AS (
  SELECT n.n_name AS tenant, CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP) AS extract_datetime,
         floor(o.o_orderkey / 256) AS chunk, c.c_custkey, c.c_name, c.c_mktsegment, o.o_orderpriority, l.l_partkey, p.p_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey)"""

ADV_FLAT = """adv_flat AS (
  SELECT 'OO' AS mo_system, tenant, 'NATIONAL' AS system, 'N' AS advertiser_mapped_by_media, 'ADVERTISER' AS feed_type,
         'DS-OO-NATIONAL-ADVERTISERFEED-' || strftime(extract_datetime, '%Y%m%d') || '-000000' AS filename,
         extract_datetime, CAST(c_custkey AS VARCHAR) AS advertiser_id, c_name AS advertiser_name, c_mktsegment AS advertiser_media,
         CAST(l_partkey AS VARCHAR) AS brand_id, p_name AS brand_name
  FROM adv_rows WHERE o_orderpriority <> '5-LOW')"""

CLIENT = """client AS (
  SELECT ROW_NUMBER() OVER (ORDER BY tenant_id NULLS FIRST, mo_id NULLS FIRST) AS id, mo_id, name, tenant_id
  FROM (SELECT f.advertiser_id AS mo_id, f.advertiser_name AS name, CAST(n.n_nationkey AS BIGINT) AS tenant_id
        FROM adv_flat f LEFT JOIN nation n ON f.tenant = n.n_name
        QUALIFY ROW_NUMBER() OVER (PARTITION BY CAST(n.n_nationkey AS BIGINT), f.advertiser_id
                                   ORDER BY f.extract_datetime NULLS FIRST, f.advertiser_name NULLS FIRST) = 1))"""

EST_FLAT = """est AS (
  SELECT n.n_name AS tenant, CAST(o.o_orderdate AS TIMESTAMP) AS extract_datetime,
         CAST(o.o_custkey AS VARCHAR) || '-' || o.o_orderpriority AS id, 'EST-' || CAST(o.o_orderkey AS VARCHAR) AS estimate_name,
         CAST(o.o_orderdate AS DATE) AS start_date, CAST(o.o_orderdate AS DATE) + 30 AS end_date, o.o_orderstatus AS media,
         CAST(o.o_custkey AS VARCHAR) AS advertiser_id,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'B' || CAST(o.o_orderkey % 100 AS VARCHAR) END AS brand_id,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'B' || CAST(o.o_orderkey % 100 AS VARCHAR)
              ELSE 'B' || CAST(o.o_orderkey % 100 AS VARCHAR) || ',B' || CAST(o.o_orderkey % 7 AS VARCHAR) END AS brand_list
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

DEST_FLAT = """s AS (SELECT s_suppkey, s_name, n.n_name FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey),
dest AS (
  SELECT n_name AS tenant, TIMESTAMP '2018-01-01 06:00:00' AS extract_datetime, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'NATIONAL' ELSE 'LOCAL' END AS media, CAST(s_suppkey % 100 AS VARCHAR) AS nielsen_code,
         CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'BROADCAST' ELSE 'CABLE' END AS type
  FROM s
  UNION ALL
  SELECT n_name, TIMESTAMP '2018-07-01 06:00:00', CAST(s_suppkey AS VARCHAR), s_name || ' (renamed)',
         CASE WHEN s_suppkey % 2 = 0 THEN 'NATIONAL' ELSE 'LOCAL' END, CAST(s_suppkey % 100 AS VARCHAR),
         CASE WHEN s_suppkey % 3 = 0 THEN 'BROADCAST' ELSE 'CABLE' END
  FROM s)"""

NETWORK = f"""WITH {DEST_FLAT},
j AS (SELECT d.*, CAST(t.n_nationkey AS BIGINT) AS tenant_id FROM dest d LEFT JOIN nation t ON d.tenant = t.n_name),
r AS (SELECT id AS mo_id, name, tenant_id, media, type AS network_type, nielsen_code FROM j
      QUALIFY ROW_NUMBER() OVER (PARTITION BY id, tenant_id ORDER BY extract_datetime NULLS FIRST, name NULLS FIRST,
                                 media NULLS FIRST, type NULLS FIRST, nielsen_code NULLS FIRST) = 1)
SELECT ROW_NUMBER() OVER (ORDER BY tenant_id NULLS FIRST, mo_id NULLS FIRST) AS id, mo_id, name, tenant_id, media, network_type, nielsen_code
FROM r WHERE network_type IS NOT NULL"""

CUSTOMER_TENANTS = """f AS (SELECT CAST(c_custkey AS VARCHAR) AS advertiser_id, n_name AS tenant FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT CAST(n_nationkey AS BIGINT) AS tenant_id, n_name AS tenant_mo_id FROM nation WHERE n_regionkey IN (0, 1, 2))"""

TWO_TENANT_CLIENTS = """client AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey AS VARCHAR) AS mo_id, CAST(c_nationkey AS BIGINT) AS tenant_id FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS BIGINT) + 1000000, CAST(c_custkey AS VARCHAR), (CAST(c_nationkey AS BIGINT) + 1) % 25 FROM customer WHERE c_custkey % 7 = 0)"""

EVENT_KINDS = """e AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS kind FROM events)"""

FILE_NAMES = """f AS (SELECT event_id,
  CASE WHEN event_id % 50 = 0 THEN 'ds-oo-national-' || event_type || 'feed'
       ELSE 'ds-oo-national-' || event_type || 'feed-' || strftime(ts, '%Y%m%d-%H%M%S') END AS file_name FROM events)"""

SUPPLIER_ROWS = "SELECT CAST(s_suppkey AS VARCHAR) AS mo_id, s_name AS name, CAST(s_nationkey AS BIGINT) AS tenant_id FROM supplier"

EVENT_BATCHES = """e AS (SELECT event_type AS mo_id, CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS client_id, ts, event_id FROM events),
b1 AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-15'
       QUALIFY ROW_NUMBER() OVER (PARTITION BY mo_id, client_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1),
b2 AS (SELECT * FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY mo_id, client_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1)"""

ESTIMATE_FIRST = """SELECT id AS mo_id, media, client_id, start_date, end_date, estimate_name AS name FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY id, client_id ORDER BY extract_datetime NULLS FIRST, media NULLS FIRST,
                           start_date NULLS FIRST, end_date NULLS FIRST, estimate_name NULLS FIRST) = 1"""

NETWORK_ROWS = NETWORK.replace("ROW_NUMBER() OVER (ORDER BY tenant_id NULLS FIRST, mo_id NULLS FIRST) AS id, ", "")

ORACLE_SQL: dict[str, str] = {
    "feed_file_select": f"""WITH {FILE_NAMES}
SELECT event_id, file_name, TRY_CAST(NULLIF(regexp_extract(file_name, '([0-9]{{8}})', 1), '') AS INTEGER) AS file_date
FROM f WHERE contains(upper(file_name), 'CLICKFEED')
  AND TRY_CAST(NULLIF(regexp_extract(file_name, '([0-9]{{8}})', 1), '') AS INTEGER) > 20240115""",
    "json_scan_flatten": f"WITH {ADV_ROWS}, {ADV_FLAT} SELECT * FROM adv_flat",
    "flatten_drops_empty": f"WITH {ADV_ROWS}, {ADV_FLAT} SELECT tenant, extract_datetime, advertiser_id, brand_id FROM adv_flat",
    "flatten_keeps_empty": f"""WITH {ADV_ROWS}, {ADV_FLAT}
SELECT tenant, extract_datetime, advertiser_id, brand_id FROM adv_flat
UNION ALL
SELECT tenant, extract_datetime, CAST(c_custkey AS VARCHAR) AS advertiser_id, CAST(NULL AS VARCHAR) AS brand_id FROM adv_rows
GROUP BY tenant, extract_datetime, chunk, c_custkey, c_name, c_mktsegment
HAVING count(*) FILTER (WHERE o_orderpriority <> '5-LOW') = 0""",
    "feed_since_cutoff": f"""WITH {ADV_ROWS}, {ADV_FLAT}
SELECT filename, extract_datetime, advertiser_id, brand_id FROM adv_flat
WHERE CAST(strftime(extract_datetime, '%Y%m%d') AS INTEGER) > 19980101""",
    "scan_permissive": """SELECT n.n_name AS tenant, l.l_shipdate AS extract_datetime, CAST(l.l_partkey AS VARCHAR) AS program_id,
       CAST(l.l_suppkey AS VARCHAR) AS program_network_id, CAST(l.l_shipdate AS DATE) AS program_start_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part pt ON l.l_partkey = pt.p_partkey
WHERE floor(l.l_orderkey / 256) % 10 <> 3""",
    "estimate_versions": f"""WITH {EST_FLAT}
SELECT tenant, extract_datetime, id, estimate_name, start_date, end_date, media, advertiser_id, brand_id, brand_list FROM est""",
    "union_all_sources": """SELECT o_orderkey, o_custkey, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
    "rename_drop_project": """SELECT CAST(c_custkey AS VARCHAR) AS mo_id, c_name AS name, CAST(n_nationkey AS BIGINT) AS tenant_id,
       lower(n_name) AS tenant_name, c_name || '@' || lower(n_name) AS label
FROM customer LEFT JOIN nation ON CAST(c_nationkey AS BIGINT) = CAST(n_nationkey AS BIGINT)""",
    "lookup_left_outer": f"""WITH {CUSTOMER_TENANTS}
SELECT advertiser_id, tenant, tenant_id FROM f LEFT JOIN t ON f.tenant = t.tenant_mo_id""",
    "lookup_drop": f"""WITH {CUSTOMER_TENANTS}
SELECT advertiser_id, tenant, tenant_id FROM f LEFT JOIN t ON f.tenant = t.tenant_mo_id WHERE tenant_id IS NOT NULL""",
    "missing_parents": f"""WITH {CUSTOMER_TENANTS}
SELECT DISTINCT tenant FROM f WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.tenant_mo_id = f.tenant)""",
    "lookup_fan_out": f"""WITH {TWO_TENANT_CLIENTS}
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS advertiser_id, client.id AS client_id, client.tenant_id
FROM orders LEFT JOIN client ON CAST(o_custkey AS VARCHAR) = client.mo_id""",
    "lookup_scoped": f"""WITH {TWO_TENANT_CLIENTS}
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS advertiser_id, client.id AS client_id, client.tenant_id
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN client ON CAST(o_custkey AS VARCHAR) = client.mo_id AND CAST(c_nationkey AS BIGINT) = client.tenant_id""",
    "lookup_shuffled_nulls": """WITH f AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS advertiser_id FROM events)
SELECT event_id, advertiser_id, CAST(c_custkey AS BIGINT) AS client_id, CAST(c_nationkey AS BIGINT) AS tenant_id
FROM f LEFT JOIN customer ON f.advertiser_id = CAST(c_custkey AS VARCHAR)""",
    "product_candidates": f"""WITH {ADV_ROWS}, {ADV_FLAT}
SELECT DISTINCT advertiser_id, brand_id, brand_name, extract_datetime FROM adv_flat""",
    "first_seen": """SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) = 1""",
    "dedupe_then_filter": f"""WITH {EVENT_KINDS},
d AS (SELECT * FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1)
SELECT user_id, event_id, ts, kind FROM d WHERE kind IS NOT NULL""",
    "filter_then_dedupe": f"""WITH {EVENT_KINDS}
SELECT user_id, event_id, ts, kind FROM e WHERE kind IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1""",
    "assign_ids": """WITH r AS (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS tenant_id, CAST(c_custkey AS VARCHAR) AS mo_id FROM customer)
SELECT ROW_NUMBER() OVER (ORDER BY tenant_id NULLS FIRST, mo_id NULLS FIRST) AS id, tenant_id, mo_id FROM r""",
    "ids_continue": """WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS mo_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS tenant_id,
                  c_mktsegment = 'BUILDING' AS first FROM customer),
a AS (SELECT ROW_NUMBER() OVER (ORDER BY tenant_id, mo_id) AS id, mo_id, name, tenant_id FROM r WHERE first),
b AS (SELECT (SELECT count(*) FROM a) + ROW_NUMBER() OVER (ORDER BY tenant_id, mo_id) AS id, mo_id, name, tenant_id FROM r WHERE NOT first)
SELECT * FROM a UNION ALL SELECT * FROM b""",
    "load_client": f"WITH {ADV_ROWS}, {ADV_FLAT}, {CLIENT} SELECT id, mo_id, name, tenant_id FROM client",
    "load_product": f"""WITH {ADV_ROWS}, {ADV_FLAT}, {CLIENT},
cand AS (SELECT DISTINCT advertiser_id, brand_id, brand_name, extract_datetime FROM adv_flat),
j AS (SELECT cand.*, client.id AS client_id, client.tenant_id FROM cand LEFT JOIN client ON cand.advertiser_id = client.mo_id)
SELECT brand_id AS mo_id, brand_name AS name, client_id FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY tenant_id, brand_id ORDER BY extract_datetime NULLS FIRST, brand_name NULLS FIRST, client_id NULLS FIRST) = 1""",
    "load_network": NETWORK,
    "load_estimate": f"""WITH {EST_FLAT},
j AS (SELECT est.*, CAST(c.c_custkey AS BIGINT) AS client_id FROM est LEFT JOIN customer c ON est.advertiser_id = CAST(c.c_custkey AS VARCHAR))
SELECT id AS mo_id, media, client_id, start_date, end_date, estimate_name AS name FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY id, client_id ORDER BY extract_datetime NULLS FIRST, media NULLS FIRST,
                           start_date NULLS FIRST, end_date NULLS FIRST, estimate_name NULLS FIRST) = 1""",
    "load_estimate_fan_out": f"""WITH {EST_FLAT}, {TWO_TENANT_CLIENTS},
j AS (SELECT est.*, client.id AS client_id FROM est LEFT JOIN client ON est.advertiser_id = client.mo_id)
{ESTIMATE_FIRST}""",
    "load_estimate_scoped": f"""WITH {EST_FLAT}, {TWO_TENANT_CLIENTS},
j AS (SELECT est.*, client.id AS client_id FROM est LEFT JOIN nation t ON est.tenant = t.n_name
      LEFT JOIN client ON est.advertiser_id = client.mo_id AND CAST(t.n_nationkey AS BIGINT) = client.tenant_id)
{ESTIMATE_FIRST}""",
    "load_daypart": """WITH ev AS (SELECT e.*, n.n_name FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
d AS (SELECT n_name AS tenant, date_trunc('second', ts) AS extract_datetime, event_type AS id,
             event_type || '-' || CAST(hour(ts) AS VARCHAR) AS daypart_name,
             CASE WHEN value >= 50 THEN 'DIGITAL' ELSE 'LINEAR' END AS media,
             CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS advertiser_id FROM ev),
j AS (SELECT d.*, CAST(c.c_custkey AS BIGINT) AS client_id, CAST(c.c_nationkey AS BIGINT) AS tenant_id
      FROM d LEFT JOIN customer c ON d.advertiser_id = CAST(c.c_custkey AS VARCHAR))
SELECT id AS mo_id, media, client_id, daypart_name AS name, tenant_id FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY id, client_id, tenant_id ORDER BY extract_datetime NULLS FIRST, media NULLS FIRST, daypart_name NULLS FIRST) = 1""",
    "load_program": """WITH p AS (
  SELECT n.n_name AS tenant, l.l_shipdate AS extract_datetime, CAST(l.l_partkey AS VARCHAR) AS program_id, pt.p_name AS program_name,
         CAST(l.l_suppkey AS VARCHAR) AS program_network_id, CAST(l.l_shipdate AS DATE) AS program_start_date,
         CAST(l.l_shipdate AS DATE) + 90 AS program_end_date, l.l_returnflag AS program_media
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part pt ON l.l_partkey = pt.p_partkey),
j AS (SELECT p.*, CAST(t.n_nationkey AS BIGINT) AS tenant_id, CAST(s.s_suppkey AS BIGINT) AS network_id
      FROM p LEFT JOIN nation t ON p.tenant = t.n_name
      LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 10 <> 0) s ON p.program_network_id = CAST(s.s_suppkey AS VARCHAR)
      WHERE s.s_suppkey IS NOT NULL)
SELECT tenant_id, network_id, program_id AS mo_id, program_name AS name, program_media AS media,
       program_start_date AS start_date, program_end_date AS end_date FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY program_id, tenant_id ORDER BY extract_datetime NULLS FIRST, network_id NULLS FIRST,
        program_name NULLS FIRST, program_media NULLS FIRST, program_start_date NULLS FIRST, program_end_date NULLS FIRST) = 1""",
    "append_twice": f"{SUPPLIER_ROWS} UNION ALL {SUPPLIER_ROWS}",
    "append_only_new": f"""WITH {EVENT_BATCHES}
SELECT mo_id, client_id, ts, event_id FROM b1
UNION ALL
SELECT mo_id, client_id, ts, event_id FROM b2
WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.mo_id IS NOT DISTINCT FROM b2.mo_id AND b1.client_id IS NOT DISTINCT FROM b2.client_id)""",
    "overwrite_partitions": """SELECT CAST(s_suppkey AS VARCHAR) AS mo_id, CASE WHEN s_nationkey = 0 THEN upper(s_name) ELSE s_name END AS name,
       CAST(s_nationkey AS BIGINT) AS tenant_id FROM supplier""",
    "rerun_only_new": NETWORK,
    "stream_load_network": NETWORK,
    "stream_network_batches": NETWORK_ROWS,
    "incremental_network": NETWORK_ROWS,
    "incremental_client": f"WITH {ADV_ROWS}, {ADV_FLAT}, {CLIENT} SELECT mo_id, name, tenant_id FROM client",
    "incremental_product": f"""WITH {ADV_ROWS}, {ADV_FLAT}, {CLIENT},
cand AS (SELECT DISTINCT advertiser_id, brand_id, brand_name, extract_datetime FROM adv_flat),
j AS (SELECT cand.*, client.mo_id AS client_mo_id, client.tenant_id FROM cand LEFT JOIN client ON cand.advertiser_id = client.mo_id)
SELECT brand_id AS mo_id, brand_name AS name, client_mo_id, tenant_id FROM j
QUALIFY ROW_NUMBER() OVER (PARTITION BY tenant_id, brand_id ORDER BY extract_datetime NULLS FIRST, brand_name NULLS FIRST, advertiser_id NULLS FIRST) = 1""",
    "run_feed_client": f"WITH {ADV_ROWS}, {ADV_FLAT}, {CLIENT} SELECT id, mo_id, name, tenant_id FROM client",
    "run_feed_multi_line": NETWORK,
    "scan_quarantine": """SELECT 'DS-OO-NATIONAL-PROGRAMFEED-' || strftime(date_trunc('month', l.l_shipdate), '%Y%m%d') || '-000000' AS feed_file,
       count(DISTINCT (n.n_name, l.l_shipdate, floor(l.l_orderkey / 256))) AS n_bad
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part pt ON l.l_partkey = pt.p_partkey
WHERE floor(l.l_orderkey / 256) % 10 = 3 GROUP BY 1""",
    "undated_files": f"WITH {FILE_NAMES} SELECT DISTINCT file_name FROM f WHERE contains(upper(file_name), 'CLICKFEED') AND event_id % 50 = 0",
    "missing_parent_table": """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS advertiser_id FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)""",
    "first_seen_by_name": "SELECT c_mktsegment AS name, min(c_custkey) AS c_custkey FROM customer GROUP BY 1",
    "append_spread": f"SELECT *, CAST(least(3, (SELECT count(*) FROM supplier)) AS BIGINT) AS files FROM ({SUPPLIER_ROWS})",
}
# the same rows over several runs, and with lookups above the broadcast bound
for _table in ("estimate", "daypart", "program"):
    ORACLE_SQL[f"incremental_{_table}"] = ORACLE_SQL[f"load_{_table}_shuffled"] = ORACLE_SQL[f"load_{_table}"]
ORACLE_SQL["load_product_shuffled"] = ORACLE_SQL["load_product"]
ORACLE_SQL["commit_interrupted"] = ORACLE_SQL["incremental_product"]
ORACLE_SQL["lookup_change_followed"] = ORACLE_SQL["load_estimate"]
ORACLE_SQL["quarantine_accounting"] = """WITH d AS (
  SELECT DISTINCT 'DS-OO-NATIONAL-PROGRAMFEED-' || strftime(date_trunc('month', l.l_shipdate), '%Y%m%d') || '-000000' AS feed_file,
    n.n_name, l.l_shipdate, floor(l.l_orderkey / 256) AS chunk
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part pt ON l.l_partkey = pt.p_partkey)
SELECT feed_file, count(*) AS n_lines, count(*) FILTER (chunk % 10 NOT IN (3, 4)) AS n_loaded, count(*) FILTER (chunk % 10 IN (3, 4)) AS n_quarantined
FROM d GROUP BY 1"""

EST_FILES = """e AS (
  SELECT 'DS-OO-NATIONAL-ESTIMATEFEED-' || strftime(date_trunc('month', o.o_orderdate), '%Y%m%d') || '-000000' AS feed_file,
    n.n_name, o.o_orderdate, floor(o.o_orderkey / 256) AS chunk, o.o_orderkey % 2 AS version
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

ORACLE_SQL["feed_file_ledger"] = f"""WITH {EST_FILES}
SELECT DISTINCT CAST(CASE WHEN date_trunc('month', o_orderdate) > DATE '1996-01-01' THEN 1 ELSE 2 END AS BIGINT) AS run, feed_file FROM e"""

ORACLE_SQL["schema_drift"] = f"""WITH {EST_FILES}, d AS (SELECT DISTINCT * FROM e)
SELECT feed_file, '$.estimates[].mediaType' AS path, CAST(NULL AS VARCHAR) AS expected, 'SCALAR' AS found, count(*) AS n
FROM e WHERE chunk % 10 = 5 GROUP BY 1
UNION ALL SELECT feed_file, '$.region', NULL, 'OBJECT', count(*) FROM d WHERE chunk % 10 = 6 GROUP BY 1
UNION ALL SELECT feed_file, '$.tenant', 'SCALAR', 'OBJECT', count(*) FROM d WHERE chunk % 10 = 7 GROUP BY 1"""

ORACLE_SQL["lookup_bucketed"] = ORACLE_SQL["lookup_shuffled_nulls"]
