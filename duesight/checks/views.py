"""The receivables tables over the test tables, in SQL."""

from __future__ import annotations

VIEWS = {
    "people": """
        SELECT s_suppkey AS id, 'E' || s_suppkey AS employee_number,
               split_part(s_name, '#', 1) AS first_name,
               CASE WHEN s_suppkey % 11 <> 7 THEN split_part(s_name, '#', 2) END AS last_name,
               CASE WHEN s_suppkey % 13 <> 5 THEN 'e' || s_suppkey || '@example.com' END AS work_email_address,
               'NATION_' || s_nationkey AS structure_name,
               CASE WHEN s_suppkey % 7 = 3 THEN 'r' WHEN s_suppkey % 9 <> 8 THEN 'c' END AS employment_status
        FROM supplier""",
    "employees": """
        SELECT *, first_name || ' ' || last_name AS full_name FROM people""",
    "customers": """
        SELECT c_custkey AS id, 'C' || c_custkey AS customer_code, c_name AS customer_name,
               c_mktsegment AS division FROM customer""",
    "credit_days": """
        SELECT * FROM (VALUES ('MACHINERY', 30), ('BUILDING', 45), ('AUTOMOBILE', 60), ('FURNITURE', 90))
        AS v(segment, days)""",
    "customer_place": """
        SELECT c.*, n.n_regionkey, d.days FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN credit_days d ON d.segment = c.c_mktsegment""",
    "sales_orders": """
        SELECT c_custkey * 4 + copy AS id, 'SO' || (c_custkey * 4 + copy) AS sales_order_code,
               CASE WHEN copy = 2 THEN 15 ELSE days END AS credit_period, c_custkey AS customer_id,
               c_custkey * 2 + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS finance_contact_id,
               (c_custkey + 3) % 10 AS rsh_id,
               (c_custkey + CASE WHEN copy = 1 THEN 1 ELSE 0 END) % 10 AS sales_person_id,
               c_nationkey AS sbu,
               (n_regionkey + CASE WHEN copy = 2 THEN 1 ELSE 0 END) % 5 AS currency_id,
               n_regionkey AS legal_entity_id
        FROM customer_place, (VALUES (0), (1), (2)) AS v(copy)
        WHERE copy = 0 OR (copy = 1 AND c_custkey % 4 = 0) OR (copy = 2 AND c_custkey % 6 = 0)""",
    "project_so_masters": """
        SELECT customer_id AS project_id, id AS sales_order_id FROM sales_orders""",
    "projects": """
        SELECT c_custkey AS id, 'P' || c_custkey AS project_code, c_name || ' works' AS project_name,
               n_regionkey AS currency_id, (c_custkey + 5) % 10 AS project_manager
        FROM customer_place""",
    "customer_contacts": """
        SELECT c_custkey * 2 + copy AS id, c_custkey AS customer_id,
               'Contact ' || (c_custkey * 2 + copy) AS contact_person_name,
               'c' || (c_custkey * 2 + copy) || '@example.org' AS contact_person_email,
               '+91 ' || (c_custkey * 2 + copy + 1000) AS contact_person_mobile
        FROM customer, (VALUES (0), (1)) AS v(copy) WHERE copy = 0 OR c_custkey % 3 = 0""",
    "currencies": """
        SELECT r_regionkey AS id, CASE WHEN r_regionkey = 0 THEN 'INR' ELSE r_name END AS currency_code
        FROM region""",
    "forex_conversions": """
        SELECT event_id AS id, user_id % 4 AS from_currency_id,
               (ts::DATE - INTERVAL 276 MONTH)::DATE AS date, value::DECIMAL(14,6) AS value
        FROM events""",
    "newest_rate": """
        SELECT from_currency_id AS currency_id, value AS rate, date FROM forex_conversions
        QUALIFY row_number() OVER (PARTITION BY from_currency_id ORDER BY date DESC, id DESC) = 1""",
    "known_rate": """
        SELECT from_currency_id AS currency_id, value AS rate, date FROM forex_conversions
        WHERE date <= DATE '{as_of}'
        QUALIFY row_number() OVER (PARTITION BY from_currency_id ORDER BY date DESC, id DESC) = 1""",
    "rates": """
        SELECT currency_id, rate, date AS rate_date FROM {rate_rows} WHERE date <= DATE '{as_of}'""",
    "invoices": """
        SELECT o_orderkey AS id, o_custkey AS project_id,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey // 8 END AS po_id,
               'IN' || o_orderkey AS invoice_code, o_totalprice::DECIMAL(18,2) AS total_amount,
               (CASE o_orderstatus WHEN 'F' THEN 0::DECIMAL(18,2)
                    WHEN 'P' THEN o_totalprice::DECIMAL(18,2) - floor(o_totalprice / 2)::DECIMAL(18,2)
                    ELSE o_totalprice::DECIMAL(18,2) END)::DECIMAL(18,2) AS balance_amount,
               o_orderdate::DATE AS invoice_date,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'd' ELSE 'a' END AS status,
               CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS deleted,
               CASE WHEN o_orderkey % 13 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 WHEN o_orderkey % 11 = 5 THEN 0 END AS invoice_reference,
               CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey - o_orderkey % 20 END AS consolidated_id,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE + 2 END AS submitted_on,
               CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate::DATE + 60 END AS expected_on
        FROM orders""",
    "invoice_consolidations": """
        SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 20 = 0""",
    "invoice_consolidation_details": """
        SELECT o_orderkey - o_orderkey % 20 AS invoice_consolidation_id, o_orderkey AS invoice_id
        FROM orders WHERE o_orderkey % 10 IN (1, 2, 3) OR o_orderkey % 30 = 0""",
    "direct_invoices": """
        SELECT o.o_orderkey AS id, c.c_custkey AS customer_id,
               'C' || (c.c_custkey + CASE WHEN o.o_orderkey % 19 = 0 THEN 1 ELSE 0 END) AS customer_code,
               'DPO' || o.o_orderkey AS po_no,
               'NI' || (o.o_orderkey - CASE WHEN o.o_orderkey % 50 = 1 THEN 1 ELSE 0 END) AS invoice_code,
               l.amount AS total_amount, l.amount AS balance_amount, l.day AS invoice_date,
               c.days AS credit_period, c.n_regionkey AS invoicing_currency_id,
               'Direct ' || o.o_orderkey AS project_name, (c.c_custkey + 3) % 10 AS rsh_id,
               c.c_custkey % 10 AS bdm_id, (c.c_custkey + 5) % 10 AS pm_id, c.c_nationkey AS sbu_id,
               c.n_regionkey AS entity_id,
               CASE WHEN o.o_orderkey % 31 = 0 AND o.o_orderkey > 0 THEN o.o_orderkey - 1 END AS invoice_reference,
               CASE WHEN o.o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS deleted,
               CASE WHEN o.o_orderkey % 2 = 0 THEN l.day + 2 END AS submitted_on,
               CASE WHEN o.o_orderkey % 5 = 0 THEN l.day + 60 END AS expected_on
        FROM (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(18,2) AS amount,
                     max(l_shipdate)::DATE AS day
              FROM lineitem WHERE l_returnflag IN ('N', 'A') GROUP BY l_orderkey) l
        JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN customer_place c ON c.c_custkey = o.o_custkey""",
    "credit_notes": """
        SELECT l_orderkey AS id, 'CN' || l_orderkey AS mode_no, amount::DECIMAL(18,2) AS balance_amount,
               day AS date, CASE WHEN l_orderkey % 41 = 0 THEN 1 ELSE 0 END AS deleted
        FROM (SELECT l_orderkey, max(l_shipdate)::DATE AS day,
                     round(sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2)), 2) AS amount
              FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
        WHERE amount > 0""",
    "credit_references": """
        SELECT o.o_orderkey AS credit_note_id, c.c_custkey AS customer_no,
               CASE WHEN r.r_regionkey = 0 THEN 'INR' ELSE r.r_name END AS currency,
               c.c_custkey AS project_id, (c.c_custkey + 3) % 10 AS rsh_id, c.c_custkey % 10 AS bdm_id,
               'NATION_' || c.c_nationkey AS sbu, r.r_name AS entity
        FROM orders o JOIN customer_place c ON c.c_custkey = o.o_custkey
        JOIN region r ON r.r_regionkey = c.n_regionkey""",
    "project_purchase_orders": """
        SELECT p_partkey AS id, CASE WHEN p_size = 1 THEN '' WHEN p_size <> 2 THEN 'PO-' || p_partkey END AS attachment_reference_no,
               CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS is_primary
        FROM part""",
    "po_so_masters": """
        SELECT p_partkey AS po_id, p_partkey - p_partkey % 4 AS sales_order_id FROM part""",
    "general_approvers": """
        SELECT n_nationkey * 2 + copy AS id, n_nationkey AS structure_id, 4 AS function_id,
               'E' || ((n_nationkey + copy) % 10) AS employee_id,
               CASE WHEN copy = 0 THEN 1 ELSE 0 END AS status
        FROM nation, (VALUES (0), (1)) AS v(copy) WHERE copy = 0 OR n_nationkey % 3 = 0
        UNION ALL
        SELECT c_custkey + 1000, c_nationkey, c_custkey % 10 + 100, 'E' || (c_custkey // 10 % 12),
               CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END
        FROM customer""",
    "company_structures": """
        SELECT n_nationkey AS id, n_name AS name FROM nation""",
    "legal_entities": """
        SELECT r_regionkey AS id, r_name AS legal_entity, substr(r_name, 1, 2) AS legal_entity_code FROM region""",
    "debtor_reports": """
        SELECT c_custkey % 10 AS bdm_id FROM customer""",
    "function_names": """
        SELECT s_suppkey + 100 AS id, 'Mail' AS type, 'debtors_ccmail_empbase_e' || s_suppkey AS name FROM supplier
        UNION ALL
        SELECT p_partkey + 1000000000, CASE WHEN p_partkey % 3 = 0 THEN 'Web' ELSE 'Cron' END,
               'job_' || (p_partkey % 7)
        FROM part""",
    "configuration_values": """
        SELECT r_regionkey AS id, NULL::BIGINT AS parent_id,
               CASE r_regionkey WHEN 0 THEN 'mail_details' WHEN 1 THEN 'ar_mail_config'
                    ELSE 'other_' || r_name END AS configuration_key,
               NULL::VARCHAR AS configuration_value
        FROM region
        UNION ALL
        SELECT p_partkey + 100, p_partkey % 5,
               CASE p_size WHEN 1 THEN 'host' WHEN 2 THEN 'port' WHEN 3 THEN 'ar_username' WHEN 4 THEN 'ar_from'
                    WHEN 5 THEN 'debtors_bdm_cron_bcc' ELSE 'key_' || p_size END,
               CASE WHEN p_partkey % 17 = 3 THEN NULL WHEN p_size = 5 THEN 'a' || p_partkey || '@example.com, b@example.com,,'
                    ELSE p_name || ' ' || p_partkey END
        FROM part""",
    "mail_configurations": """
        SELECT c_custkey AS id, c_custkey % 5 AS function_id, c_nationkey AS structure_id,
               'E' || (c_custkey % 12) AS employee_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'to' WHEN 'BUILDING' THEN 'cc'
                    WHEN 'AUTOMOBILE' THEN 'bcc' ELSE 'off' END AS mail_to_type
        FROM customer""",
    "schedules": """
        SELECT c_custkey AS id, 'job_' || (c_custkey % 9) AS name,
               CASE WHEN c_custkey % 5 <> 0 THEN 1 ELSE 0 END AS status, c_custkey % 24 AS hour,
               c_custkey % 60 AS minute, c_custkey % 7 AS dayofweek
        FROM customer""",
    "scheduler_logs": """
        SELECT event_id AS id, user_id AS schedule_id, event_type AS log,
               CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS status,
               floor(epoch(ts))::BIGINT AS date_runned,
               floor(epoch(date_trunc('hour', ts)))::BIGINT AS date_cron
        FROM events""",
    "heads": """
        SELECT a.structure_id, a.id AS approver_id, e.full_name
        FROM general_approvers a LEFT JOIN employees e ON e.employee_number = a.employee_id
        WHERE a.function_id = 4""",
}
