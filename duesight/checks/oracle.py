"""One SQL statement per registered query.

The statements follow the row-level rules: join everything, filter, then pick or
add up. They share no shortcut with the Spark code, which makes lookups unique
first and adds up before it joins.
"""

from __future__ import annotations

from duesight.checks.views import VIEWS

# The dates the statements are evaluated for.
AS_OF = "2001-06-15"
RATE_AS_OF = "2001-01-20"

MONTHS = "(year({due}) * 12 + month({due}) - (year(DATE '{as_of}') * 12 + month(DATE '{as_of}')))"
BUCKET = """CASE WHEN {due} IS NULL THEN 'unplaced' WHEN {m} < -3 THEN 'past' WHEN {m} < 0 THEN 'm' || {m}
    WHEN {m} > 0 THEN 'p' || {m} WHEN {due} < DATE '{as_of}' THEN 'current_due' ELSE 'current_not_due' END"""


def _months(due: str) -> str:
    return MONTHS.replace("{due}", due)


def _bucket(due: str) -> str:
    return BUCKET.replace("{m}", _months(due)).replace("{due}", due)


def _money_text(value: str, currency: str = "NULL") -> str:
    """Grouped whole-unit text without look-around."""
    digits = f"(round(abs({value}), 0)::DECIMAL(38,0))::VARCHAR"
    # Group by three or, after the last three, by two; a leading comma is cut.
    three = f"ltrim(reverse(regexp_replace(reverse({digits}), '([0-9]{{3}})', '\\1,', 'g')), ',')"
    tail = f"right({digits}, 3)"
    front = f"left({digits}, greatest(length({digits}) - 3, 0))"
    two = f"ltrim(reverse(regexp_replace(reverse({front}), '([0-9]{{2}})', '\\1,', 'g')), ',')"
    indian = f"CASE WHEN length({digits}) > 3 THEN {two} || ',' || {tail} ELSE {digits} END"
    grouped = f"CASE WHEN {currency} = 'INR' THEN {indian} ELSE {three} END"
    return (
        f"CASE WHEN {value} IS NULL THEN '' WHEN {value} < 0 THEN '(' || {grouped} || ')'"
        f" WHEN round({value}, 0) = 0 THEN '' ELSE {grouped} END"
    )


# Row-level joins, fan-out included.
CORE = {
    "inv_star": """
        SELECT so.sales_person_id AS bdm_id, i.*, so.id AS sales_order_id, so.credit_period,
               so.currency_id AS so_currency_id, so.customer_id, so.sbu, so.rsh_id, so.finance_contact_id,
               so.legal_entity_id, so.sales_order_code, p.id AS known_project, p.project_code, p.project_name,
               p.currency_id AS project_currency_id, p.project_manager, c.customer_code, c.customer_name,
               c.division, i.invoice_date + so.credit_period::INTEGER AS due_date
        FROM invoices i
        LEFT JOIN projects p ON i.project_id = p.id
        LEFT JOIN project_so_masters ps ON i.project_id = ps.project_id
        LEFT JOIN sales_orders so ON ps.sales_order_id = so.id
        LEFT JOIN customers c ON c.id = so.customer_id""",
    "con_pairs": """
        SELECT i.id AS parent_id, i.consolidated_id AS parent_consolidation, i.invoice_code AS parent_code,
               i.total_amount AS parent_total, i.balance_amount AS parent_balance,
               i.invoice_date AS parent_date, i.status AS parent_status, i.deleted AS parent_deleted,
               i.invoice_reference AS parent_reference, i.submitted_on AS parent_submitted,
               i.expected_on AS parent_expected, d.invoice_id AS constituent_id
        FROM invoices i JOIN invoice_consolidations ic ON i.consolidated_id = ic.id
        LEFT JOIN invoice_consolidation_details d ON d.invoice_consolidation_id = ic.id""",
    "con_star": """
        SELECT s.*, cp.* FROM con_pairs cp JOIN inv_star s ON s.id = cp.constituent_id""",
    "crn_star": """
        SELECT n.id, n.mode_no, n.balance_amount, n.date, n.deleted, r.*, c.customer_code, c.customer_name,
               c.division
        FROM credit_notes n LEFT JOIN credit_references r ON r.credit_note_id = n.id
        LEFT JOIN customers c ON c.id = r.customer_no""",
    "dir_star": """
        SELECT d.*, c.customer_code AS list_code, c.customer_name AS list_name, cu.currency_code,
               r.rate, d.invoice_date + d.credit_period AS due_date
        FROM direct_invoices d LEFT JOIN customers c ON d.customer_id = c.id
        LEFT JOIN currencies cu ON cu.id = d.invoicing_currency_id
        LEFT JOIN rates r ON r.currency_id = d.invoicing_currency_id""",
    "items_inv": """
        SELECT s.bdm_id, 'INV' AS source, s.id AS doc_id, s.id::VARCHAR AS doc_key, s.customer_id,
               s.customer_code || ' - ' || s.customer_name AS customer_label, s.division,
               CASE WHEN po.attachment_reference_no <> '' THEN po.attachment_reference_no
                    ELSE (SELECT first(q.attachment_reference_no ORDER BY q.id) FROM po_so_masters m
                          JOIN project_purchase_orders q ON q.id = m.po_id AND q.is_primary = 1
                          WHERE m.sales_order_id = s.sales_order_id) END AS po_no,
               cc.contact_person_name AS contact_name, cc.contact_person_email AS contact_email,
               cc.contact_person_mobile AS contact_phone, s.invoice_code AS doc_no, 1 AS sign,
               s.total_amount AS amount, s.balance_amount AS balance, r.rate * s.balance_amount AS balance_base,
               s.invoice_date, s.credit_period AS credit_days, s.due_date, cu.currency_code, s.sales_order_code,
               s.known_project AS project_id, s.project_code, s.project_name, e1.full_name AS rsh,
               e2.full_name AS bdm, h.full_name AS business_head, e4.full_name AS pm, st.name AS unit,
               le.legal_entity AS entity_name, le.legal_entity_code AS entity_code, s.submitted_on, s.expected_on,
               s.sales_order_id
        FROM inv_star s
        LEFT JOIN project_purchase_orders po ON po.id = s.po_id
        LEFT JOIN customer_contacts cc ON cc.id = s.finance_contact_id
        LEFT JOIN currencies cu ON cu.id = s.project_currency_id
        LEFT JOIN employees e1 ON e1.id = s.rsh_id
        LEFT JOIN employees e2 ON e2.id = s.bdm_id
        LEFT JOIN heads h ON h.structure_id = s.sbu
        LEFT JOIN employees e4 ON e4.id = s.project_manager
        LEFT JOIN company_structures st ON st.id = s.sbu
        LEFT JOIN legal_entities le ON le.id = s.legal_entity_id
        LEFT JOIN rates r ON r.currency_id = s.project_currency_id
        LEFT JOIN (SELECT DISTINCT invoice_reference AS ref FROM invoices) child ON child.ref = s.id
        WHERE s.status = 'a' AND s.deleted = 0 AND s.balance_amount > 0 AND child.ref IS NULL
          AND coalesce(s.invoice_reference, 0) = 0 AND e2.id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY s.bdm_id, s.id
                                   ORDER BY s.sales_order_id, s.project_id, h.approver_id, cc.id) = 1""",
    "items_con": """
        SELECT s.bdm_id, 'CON' AS source, s.parent_id AS doc_id, s.parent_id::VARCHAR AS doc_key, s.customer_id,
               s.customer_code || ' - ' || s.customer_name AS customer_label, s.division,
               CASE WHEN po.attachment_reference_no <> '' THEN po.attachment_reference_no
                    ELSE (SELECT first(q.attachment_reference_no ORDER BY q.id) FROM po_so_masters m
                          JOIN project_purchase_orders q ON q.id = m.po_id AND q.is_primary = 1
                          WHERE m.sales_order_id = s.sales_order_id) END AS po_no,
               cc.contact_person_name AS contact_name, cc.contact_person_email AS contact_email,
               cc.contact_person_mobile AS contact_phone, s.parent_code AS doc_no, 1 AS sign,
               s.parent_total AS amount, s.parent_balance AS balance, r.rate * s.parent_balance AS balance_base,
               s.parent_date AS invoice_date, s.credit_period AS credit_days,
               s.parent_date + s.credit_period::INTEGER AS due_date, cu.currency_code, s.sales_order_code,
               s.known_project AS project_id, s.project_code, s.project_name, e1.full_name AS rsh,
               e2.full_name AS bdm, h.full_name AS business_head, e4.full_name AS pm, st.name AS unit,
               le.legal_entity AS entity_name, le.legal_entity_code AS entity_code,
               s.parent_submitted AS submitted_on, s.parent_expected AS expected_on, s.sales_order_id
        FROM con_star s
        LEFT JOIN project_purchase_orders po ON po.id = s.po_id
        LEFT JOIN customer_contacts cc ON cc.id = s.finance_contact_id
        LEFT JOIN currencies cu ON cu.id = s.project_currency_id
        LEFT JOIN employees e1 ON e1.id = s.rsh_id
        LEFT JOIN employees e2 ON e2.id = s.bdm_id
        LEFT JOIN heads h ON h.structure_id = s.sbu
        LEFT JOIN employees e4 ON e4.id = s.project_manager
        LEFT JOIN company_structures st ON st.id = s.sbu
        LEFT JOIN legal_entities le ON le.id = s.legal_entity_id
        LEFT JOIN rates r ON r.currency_id = s.project_currency_id
        WHERE s.parent_status = 'a' AND s.parent_deleted = 0 AND s.parent_balance > 0
          AND s.invoice_reference IS NULL AND coalesce(s.parent_reference, 0) = 0 AND e2.id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY s.bdm_id, s.parent_id
            ORDER BY s.sales_order_id, s.project_id, s.constituent_id, h.approver_id, cc.id) = 1""",
    "items_dir": """
        SELECT d.bdm_id, 'DIR' AS source, d.id AS doc_id, 'NON_' || d.id AS doc_key, d.customer_id,
               d.customer_code || ' - ' || c.customer_name AS customer_label, ' ' AS division, d.po_no,
               cc.contact_person_name AS contact_name, cc.contact_person_email AS contact_email,
               cc.contact_person_mobile AS contact_phone, d.invoice_code AS doc_no, 1 AS sign,
               d.total_amount AS amount, d.balance_amount AS balance, d.rate * d.balance_amount AS balance_base,
               d.invoice_date, d.credit_period AS credit_days, d.due_date, d.currency_code,
               ' ' AS sales_order_code, NULL::BIGINT AS project_id, ' ' AS project_code, d.project_name,
               e1.full_name AS rsh, e2.full_name AS bdm, h.full_name AS business_head, e4.full_name AS pm,
               st.name AS unit, le.legal_entity AS entity_name, le.legal_entity_code AS entity_code,
               d.submitted_on, d.expected_on, NULL::BIGINT AS sales_order_id
        FROM dir_star d
        LEFT JOIN customers c ON c.customer_code = d.customer_code
        LEFT JOIN customer_contacts cc ON cc.customer_id = d.customer_id
        LEFT JOIN employees e1 ON e1.id = d.rsh_id
        LEFT JOIN employees e2 ON e2.id = d.bdm_id
        LEFT JOIN heads h ON h.structure_id = d.sbu_id
        LEFT JOIN employees e4 ON e4.id = d.pm_id
        LEFT JOIN company_structures st ON st.id = d.sbu_id
        LEFT JOIN legal_entities le ON le.id = d.entity_id
        LEFT JOIN (SELECT DISTINCT invoice_reference AS ref FROM direct_invoices) child ON child.ref = d.id
        WHERE d.balance_amount > 0 AND d.deleted = 0 AND child.ref IS NULL AND e2.id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY d.bdm_id, d.invoice_code
                                   ORDER BY d.id, h.approver_id, cc.id, c.id) = 1""",
    "items_crn": """
        SELECT n.bdm_id, 'CRN' AS source, n.id AS doc_id, 'Cr_' || n.id AS doc_key, n.customer_no AS customer_id,
               n.customer_code || ' - ' || n.customer_name AS customer_label, n.division, ' ' AS po_no,
               cc.contact_person_name AS contact_name, cc.contact_person_email AS contact_email,
               cc.contact_person_mobile AS contact_phone, n.mode_no AS doc_no, -1 AS sign,
               n.balance_amount AS amount, n.balance_amount AS balance, r.rate * n.balance_amount AS balance_base,
               n.date AS invoice_date, 0 AS credit_days, n.date AS due_date, n.currency AS currency_code,
               so.sales_order_code, p.id AS project_id, p.project_code, p.project_name, e1.full_name AS rsh,
               e2.full_name AS bdm, h.full_name AS business_head, e4.full_name AS pm, n.sbu AS unit,
               n.entity AS entity_name, le.legal_entity_code AS entity_code, NULL::DATE AS submitted_on,
               NULL::DATE AS expected_on, so.id AS sales_order_id
        FROM crn_star n
        LEFT JOIN projects p ON p.id = n.project_id
        LEFT JOIN project_so_masters ps ON ps.project_id = n.project_id
        LEFT JOIN sales_orders so ON so.id = ps.sales_order_id
        LEFT JOIN legal_entities le ON le.legal_entity = n.entity
        LEFT JOIN currencies cu ON cu.currency_code = n.currency
        LEFT JOIN employees e1 ON e1.id = n.rsh_id
        LEFT JOIN employees e2 ON e2.id = n.bdm_id
        LEFT JOIN heads h ON h.structure_id = so.sbu
        LEFT JOIN employees e4 ON e4.id = p.project_manager
        LEFT JOIN customer_contacts cc ON cc.customer_id = n.customer_no
        LEFT JOIN rates r ON r.currency_id = cu.id
        WHERE n.balance_amount > 0 AND n.deleted = 0 AND n.bdm_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY n.bdm_id, n.mode_no
            ORDER BY n.id, so.id NULLS LAST, n.project_id NULLS LAST, n.customer_no, h.approver_id, cc.id) = 1""",
    "every_item": """
        SELECT * EXCLUDE (sales_order_id) FROM items_inv
        UNION ALL SELECT * EXCLUDE (sales_order_id) FROM items_dir
        UNION ALL SELECT * EXCLUDE (sales_order_id) FROM items_crn
        UNION ALL SELECT * EXCLUDE (sales_order_id) FROM items_con""",
    "items": """
        SELECT CASE WHEN max(source) = 'INV' THEN 'INV' ELSE min(source) END AS source, * EXCLUDE (source)
        FROM every_item GROUP BY ALL""",
    "inv_orders": """
        SELECT s.*, cu.currency_code, r.rate FROM inv_star s
        LEFT JOIN currencies cu ON cu.id = s.so_currency_id
        LEFT JOIN rates r ON r.currency_id = s.project_currency_id
        WHERE {inv_once}""",
    "con_orders": """
        SELECT s.*, cu.currency_code FROM con_star s LEFT JOIN currencies cu ON cu.id = s.so_currency_id
        WHERE {con_once}""",
    "candidates": """
        SELECT DISTINCT bdm_id, customer_code FROM (
            SELECT bdm_id, customer_code FROM inv_orders WHERE balance_amount <> 0 AND bdm_id IS NOT NULL
            UNION SELECT bdm_id, customer_code FROM direct_invoices WHERE balance_amount <> 0
            UNION SELECT bdm_id, customer_code FROM crn_star WHERE balance_amount > 0 AND deleted = 0
            UNION SELECT bdm_id, customer_code FROM con_orders WHERE parent_balance <> 0)
        WHERE customer_code IS NOT NULL""",
    "due_maxima": """
        SELECT bdm_id, 'INV' AS source, max(due_date) AS due FROM inv_orders WHERE balance_amount > 0 GROUP BY 1
        UNION ALL SELECT bdm_id, 'DIR', max(due_date) FROM dir_star WHERE balance_amount > 0 GROUP BY 1
        UNION ALL SELECT bdm_id, 'CON', max(parent_date + credit_period::INTEGER) FROM con_orders
        WHERE parent_balance > 0 GROUP BY 1""",
    "horizon": """
        SELECT bdm_id, max(due) AS last_due_date, greatest(0, {months:max(due)}) AS months
        FROM due_maxima WHERE source IN ({horizon_sources}) GROUP BY bdm_id HAVING max(due) IS NOT NULL""",
    "lines": """
        SELECT 'INV' AS source, bdm_id, customer_code, customer_name, currency_code, due_date, balance_amount AS amount
        FROM inv_orders WHERE balance_amount > 0 AND status = 'a'
        UNION ALL
        SELECT 'CON', bdm_id, customer_code, customer_name, currency_code, due_date, balance_amount
        FROM con_orders WHERE parent_balance > 0 AND parent_status = 'a' AND parent_deleted = 0
        UNION ALL
        SELECT 'DIR', bdm_id, list_code, list_name, currency_code, due_date, balance_amount
        FROM dir_star WHERE balance_amount > 0
        UNION ALL
        SELECT 'CRN', bdm_id, customer_code, customer_name, currency, date, balance_amount
        FROM crn_star WHERE balance_amount > 0 AND deleted = 0""",
    "placed_lines": """
        SELECT l.*, {months:l.due_date} AS months_ahead, coalesce(h.months, 0) AS months_shown
        FROM lines l JOIN candidates USING (bdm_id, customer_code) LEFT JOIN horizon h USING (bdm_id)""",
    "summaries": """
        SELECT source, bdm_id, customer_code, customer_name, currency_code, amount,
               CASE WHEN months_ahead > months_shown THEN 'unplaced' ELSE {bucket:due_date} END AS bucket,
               CASE WHEN months_ahead <= months_shown THEN greatest(months_ahead, -4) END AS month_offset
        FROM placed_lines""",
    "signed": """
        SELECT *, CASE WHEN source = 'CRN' THEN -amount ELSE amount END AS net,
               CASE WHEN source = 'CRN' AND NOT ({added} AND coalesce(month_offset, 0) > 0)
                    THEN -amount ELSE amount END AS cell_net
        FROM summaries""",
    "merged": """
        SELECT bdm_id, customer_code, currency_code, bucket, month_offset, sum(cell_net) AS net_amount
        FROM signed GROUP BY ALL""",
    "labels_of_keys": """
        SELECT bdm_id, customer_code, currency_code,
               min(customer_code) || ' - ' || min_by(coalesce(customer_name, ''),
                   CASE source WHEN 'DIR' THEN 1 WHEN 'INV' THEN 2 WHEN 'CON' THEN 3 ELSE 4 END) AS customer_label,
               coalesce(sum(net) FILTER (bucket <> 'unplaced'), 0) AS grand_total
        FROM signed GROUP BY ALL""",
    "total_lines": """
        SELECT 'INV' AS source, bdm_id, customer_code, due_date,
               CASE WHEN {months:due_date} > 0 THEN balance_amount::DECIMAL(38,8)
                    ELSE (rate * balance_amount)::DECIMAL(38,8) END AS amount
        FROM inv_orders WHERE balance_amount > 0
        UNION ALL
        SELECT 'CON', bdm_id, customer_code, due_date, balance_amount::DECIMAL(38,8)
        FROM con_orders WHERE parent_balance > 0
        UNION ALL
        SELECT 'DIR', bdm_id, list_code, due_date,
               CASE WHEN {months:due_date} > 0 THEN balance_amount::DECIMAL(38,8)
                    ELSE (rate * balance_amount)::DECIMAL(38,8) END
        FROM dir_star WHERE balance_amount > 0
        UNION ALL
        SELECT 'CRN', bdm_id, customer_code, date, balance_amount::DECIMAL(38,8)
        FROM crn_star WHERE balance_amount > 0 AND deleted = 0""",
    "totals": """
        SELECT l.bdm_id, l.source, {bucket:l.due_date} AS bucket, greatest({months:l.due_date}, -4) AS month_offset,
               coalesce(sum(l.amount), 0) AS total
        FROM total_lines l JOIN candidates USING (bdm_id, customer_code) LEFT JOIN horizon h USING (bdm_id)
        WHERE l.due_date IS NOT NULL AND {months:l.due_date} <= coalesce(h.months, 0)
        GROUP BY ALL""",
    "visible": """
        SELECT * FROM (
            SELECT bdm_id, bucket, month_offset, {money:sum(total)} AS total_text
            FROM totals GROUP BY bdm_id, bucket, month_offset)
        WHERE total_text <> ''""",
    "owners": """
        SELECT DISTINCT d.bdm_id, concat_ws(' ', e.first_name, e.last_name) AS owner_name,
               e.work_email_address AS email, e.employee_number, e.structure_name AS unit
        FROM debtor_reports d LEFT JOIN employees e ON e.id = d.bdm_id""",
    "active": """
        SELECT id AS bdm_id FROM employees WHERE employment_status NOT IN ('r', 'q', 'b', 'o', 't')""",
    "copies": """
        SELECT o.bdm_id, coalesce(e.full_name, '') AS cc_name, max_by(e.work_email_address, ga.id) AS cc_email
        FROM general_approvers ga JOIN function_names fn ON fn.id = ga.function_id
        JOIN owners o ON fn.name ILIKE 'debtors_ccmail_empbase_' || o.employee_number
        JOIN employees e ON e.employee_number = ga.employee_id
        WHERE ga.status = 1 AND e.work_email_address IS NOT NULL
        GROUP BY 1, 2""",
    "config": """
        SELECT a.configuration_key AS parent_key, c.configuration_key,
               last(c.configuration_value ORDER BY c.id) AS configuration_value
        FROM configuration_values c JOIN configuration_values a ON c.parent_id = a.id GROUP BY 1, 2""",
    "report_config": """
        SELECT configuration_key, last(configuration_value ORDER BY parent_key = 'mail_details') AS configuration_value
        FROM config WHERE parent_key = 'ar_mail_config'
            OR (parent_key = 'mail_details' AND configuration_key IN ('host', 'port'))
        GROUP BY 1""",
}

USUAL_RULES = {
    "{rate_rows}": "newest_rate",
    "{horizon_sources}": "'INV', 'DIR'",
    "{inv_once}": "true",
    "{con_once}": "true",
    "{added}": "false",
}


def _expand(sql: str, as_of: str, rules: dict[str, str]) -> str:
    for marker, function in (("{months:", _months), ("{bucket:", _bucket), ("{money:", _money_text)):
        while marker in sql:
            start = sql.index(marker)
            end = sql.index("}", start)
            arguments = sql[start + len(marker) : end].rsplit(":", 1)
            sql = sql[:start] + function(*arguments) + sql[end + 1 :]
    for name, text in rules.items():
        sql = sql.replace(name, text)
    return sql.replace("{as_of}", as_of)


def statement(select: str, as_of: str = AS_OF, **changed: str) -> str:
    """``select`` with the views it needs in front of it."""
    views = {**VIEWS, **CORE}
    rules = {**USUAL_RULES, **{"{" + name + "}": text for name, text in changed.items()}}
    needed, names = {}, list(views)

    def words(sql: str) -> set[str]:
        for mark in "(),.=<>|{}:\n":
            sql = sql.replace(mark, " ")
        return set(sql.split())

    def visit(sql: str) -> None:
        for name in names:
            if name not in needed and name in words(sql):
                needed[name] = None
                visit(views[name])

    visit(select)
    for view in ("newest_rate", "known_rate"):
        if "rates" in needed:
            needed["forex_conversions"] = needed[view] = None
    parts = [f"{name} AS ({views[name]})" for name in names if name in needed]
    prefix = f"WITH {', '.join(parts)}\n" if parts else ""
    return _expand(prefix + select, as_of, rules)
