"""Expected results by query name, each a single statement over the base tables."""

from __future__ import annotations

from oracle.constants import LINEITEM, ORDERS
from oracle.decimals import DECIMALS
from oracle.idioms import TODAY
from oracle.models import ANALYTIC, GOLD, SILVER
from silverlode.sources.derived import BASE_TABLES, STATEMENTS, Repeat, statement

REPEATS = {
    "version": Repeat("unnest(range(0, case when {id}%10=0 then 2 else 1 end)) as v"),
    "contract": Repeat("unnest(range(0, 2)) as k"),
}
_names = {name: name for name in BASE_TABLES}
RAW = {source: ((), statement(source, _names, REPEATS)) for source in STATEMENTS}
MODELS = {**RAW, **SILVER, **ANALYTIC, **GOLD}

_day = "usage_date <= " + TODAY
_first_load = "_airbyte_extracted_at <= TIMESTAMP '2024-01-15'"
_usage_sql = SILVER["int_usage_clean"][1]
_fact_sql = GOLD["fact_usage_snapshot"][1]
_upserted = """SELECT * FROM incremental_slice UNION ALL
SELECT * FROM first_fact WHERE usage_key NOT IN (SELECT usage_key FROM incremental_slice)"""
LOADS = {
    "first_usage": (("service_usage",), f"SELECT * FROM service_usage WHERE {_first_load}"),
    "first_clean": (("first_usage",), _usage_sql.replace("FROM service_usage", "FROM first_usage")),
    "first_fact": (("first_clean",), _fact_sql.replace("FROM int_usage_clean", "FROM first_clean")),
    "incremental_slice": (
        ("fact_usage_snapshot", "first_fact"),
        """SELECT * FROM fact_usage_snapshot
WHERE source_extracted_at > (SELECT coalesce(max(source_extracted_at), TIMESTAMP '1900-01-01') FROM first_fact)""",
    ),
    "upsert": (("first_fact", "incremental_slice"), _upserted),
    "upsert_files": (("first_fact", "incremental_slice"), _upserted),
}
_calendar = f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date, CAST(year(d) AS INTEGER) AS year_number,
  CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%Y-%m') AS year_month,
  strftime(d, '%b') AS month_name, CAST(weekofyear(d) AS INTEGER) AS iso_week_number, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(isodow(d) AS INTEGER) AS iso_day_of_week, strftime(d, '%a') AS day_name, isodow(d) > 5 AS is_weekend,
  CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end
FROM (SELECT DATE '2015-01-01' + CAST(i AS INTEGER) AS d FROM range(7305) t(i)) WHERE d <= {TODAY} + INTERVAL 2 YEAR"""


def _failures(model: str, column: str, kind: str, condition: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS check_name,"
        f" count(*) FILTER ({condition}) AS failures FROM {model.removeprefix('stg_')}"
    )


def _repeats(model: str, column: str) -> str:
    return (
        f"SELECT '{model}', '{column}', 'unique', count(*) FROM"
        f" (SELECT {column} FROM {model.removeprefix('stg_')} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


_suite = "\nUNION ALL ".join(
    [
        _failures("stg_crm_customers", "msisdn", "not_null", "msisdn IS NULL"),
        _failures("stg_crm_customers", "age", "between", "age < 18 OR age > 120"),
        _failures("stg_churn_labels", "churned", "accepted_values", "churned NOT IN (0, 1)"),
        _failures("int_customer_clean", "customer_id", "not_null", "customer_id IS NULL"),
        _failures("int_customer_clean", "age", "not_null", "age IS NULL"),
        _failures("int_customer_clean", "registration_date", "not_null", "registration_date IS NULL"),
        _failures("int_customer_clean", "age", "between", "age < 18 OR age > 120"),
        _failures(
            "int_customer_clean",
            "dependents_dq_status",
            "accepted_values",
            "dependents_dq_status NOT IN ('VALID', 'IMPUTED_ZERO', 'CORRECTED_TO_ZERO', 'BOOLEAN_ALIGNED_TO_COUNT')",
        ),
        _failures("int_churn_clean", "customer_id", "not_null", "customer_id IS NULL"),
        _failures("int_churn_clean", "churn_date", "not_null", "churn_date IS NULL"),
        _failures(
            "int_churn_clean",
            "customer_id",
            "relationships",
            "customer_id NOT IN (SELECT customer_id FROM int_customer_clean)",
        ),
        _failures("int_support_clean", "ticket_id", "not_null", "ticket_id IS NULL"),
        _failures("int_support_clean", "satisfaction_score", "between", "satisfaction_score < 0 OR satisfaction_score > 5"),
        _repeats("stg_service_usage", "usage_id"),
        _repeats("int_customer_clean", "customer_id"),
        _repeats("int_churn_clean", "customer_id"),
        _repeats("int_support_clean", "ticket_id"),
    ]
)
_ages = {source: 24 * 3600 for source in STATEMENTS} | {
    "macro_monthly": 45 * 24 * 3600,
    "metas_retencion_region_mes": 45 * 24 * 3600,
    "xref_customer_id": 7 * 24 * 3600,
}
_freshness = "\nUNION ALL ".join(
    f"""SELECT '{source}' AS source_name, max(_airbyte_extracted_at) AS max_loaded_at,
  epoch(TIMESTAMP '2024-02-01 12:00:00')::BIGINT - epoch(max(_airbyte_extracted_at))::BIGINT AS age_seconds,
  if(epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(max(_airbyte_extracted_at)) <= {age}, 'pass', 'warn') AS status FROM {source}"""
    for source, age in _ages.items()
)
OPERATORS = {
    "dim_date_of_invoices": (
        ("int_billing_clean",),
        f"SELECT c.*, i.invoices FROM ({_calendar}) c JOIN (SELECT issue_date, count(*) AS invoices"
        " FROM int_billing_clean GROUP BY issue_date) i ON c.calendar_date = i.issue_date",
    ),
    "dq_not_null": (("crm_customers",), "SELECT * FROM crm_customers WHERE registration_date IS NULL"),
    "dq_unique": (
        ("service_usage",),
        "SELECT usage_id, count(*) AS n_records FROM service_usage GROUP BY usage_id HAVING count(*) > 1",
    ),
    "dq_accepted_values": (("churn_labels",), "SELECT * FROM churn_labels WHERE churned <> 0 AND churned <> 1"),
    "dq_relationships": (
        ("int_usage_clean", "int_customer_clean"),
        "SELECT * FROM int_usage_clean u WHERE NOT EXISTS (SELECT 1 FROM int_customer_clean c WHERE c.customer_id = u.customer_id)",
    ),
    "dq_between": (("crm_customers",), "SELECT * FROM crm_customers WHERE age < 18 OR age > 120"),
    "dq_singular": (
        ("order_item",),
        "SELECT order_key, line_number, extended_price, item_discount_amount FROM (SELECT * REPLACE (CASE WHEN order_key % 50 = 0"
        " THEN CAST(extended_price * -2 AS DECIMAL(16, 2)) ELSE item_discount_amount END AS item_discount_amount) FROM order_item)"
        " WHERE -item_discount_amount > extended_price OR item_discount_amount > extended_price",
    ),
    "dq_suite_silver": (
        (
            "crm_customers",
            "churn_labels",
            "service_usage",
            "int_customer_clean",
            "int_churn_clean",
            "int_support_clean",
        ),
        _suite,
    ),
    "freshness": (tuple(STATEMENTS), _freshness),
    "normalize_boolean": (
        ("support_tickets",),
        """SELECT ticket_id, coalesce(lower(trim(reopened)) IN ('1', 'true', 't', 'yes', 'y', 'si', 'sí', 's'), false) AS reopened,
  CASE WHEN lower(trim(first_contact_resolution)) IN ('1', 'true', 't', 'yes', 'y', 'si', 'sí', 's') THEN true
    WHEN lower(trim(first_contact_resolution)) IN ('0', 'false', 'f', 'no', 'n') THEN false END AS first_contact_resolution
FROM support_tickets""",
    ),
}


# The whole suite: keys (not missing, not repeated), required columns, and the other checks with their condition.
_keys = {
    "int_customer_clean": "customer_id", "int_churn_clean": "customer_id", "int_subscription_clean": "subscription_id",
    "int_billing_clean": "invoice_id", "int_payment_clean": "payment_id", "int_usage_clean": "usage_id", "int_network_clean": "event_id",
    "int_support_clean": "ticket_id", "int_marketing_clean": "interaction_id", "int_macro_clean": "year_month",
    "int_retention_target_clean": "target_id", "dim_customer": "customer_key customer_id", "dim_subscription": "subscription_key subscription_id",
    "dim_date": "date_key", "dim_region": "region_key", "dim_plan": "plan_key", "dim_agent_team": "agent_team_key",
    "dim_campaign": "campaign_key", "dim_network_node": "network_node_key", "fact_billing": "billing_key", "fact_payment": "payment_key",
    "fact_usage_snapshot": "usage_key", "fact_network_event": "network_event_key", "fact_support_ticket": "support_ticket_key",
    "fact_marketing_interaction": "marketing_interaction_key", "fact_churn_event": "churn_event_key", "fact_macro_monthly": "macro_month_key",
    "fact_retention_target_monthly": "retention_target_key", "fact_subscription_event": "subscription_event_key",
    "fact_customer_month_snapshot": "customer_month_key",
}
_required = {
    "int_customer_clean": "age registration_date", "int_churn_clean": "churn_date", "int_subscription_clean": "customer_id",
    "int_xref_customer_clean": "account_id customer_id", "fact_billing": "invoice_id", "fact_churn_event": "churn_date_key",
    "fact_customer_month_snapshot": "month_date_key", "int_r5_ml_features": "observation_date label_churn_next_90d",
    "order_item": "order_key line_number item_discount_amount",
}
_unknown = "customer_id NOT IN (SELECT customer_id FROM int_customer_clean)"
_others = [
    ("int_customer_clean", "age", "between", "age < 18 OR age > 120"),
    (
        "int_customer_clean",
        "dependents_dq_status",
        "accepted_values",
        "dependents_dq_status NOT IN ('VALID', 'IMPUTED_ZERO', 'CORRECTED_TO_ZERO', 'BOOLEAN_ALIGNED_TO_COUNT')",
    ),
    ("int_churn_clean", "customer_id", "relationships", _unknown),
    ("int_subscription_clean", "customer_id", "relationships", _unknown),
    ("int_support_clean", "satisfaction_score", "between", "satisfaction_score < 0 OR satisfaction_score > 5"),
    ("int_r5_ml_features", "label_churn_next_90d", "accepted_values", "label_churn_next_90d NOT IN (0, 1)"),
]
# What the query does to some tables before it checks them.
_damage = {
    "int_customer_clean": """SELECT * REPLACE (if(customer_id LIKE '%7', age + 200, age) AS age,
  if(customer_id LIKE '%3', 'BROKEN', dependents_dq_status) AS dependents_dq_status,
  if(customer_id LIKE '%9', NULL, registration_date) AS registration_date) FROM int_customer_clean""",
    "int_usage_clean": "SELECT * FROM int_usage_clean UNION ALL SELECT * FROM int_usage_clean WHERE usage_id LIKE '%1'",
    "int_support_clean": """SELECT * REPLACE (if(ticket_id LIKE '%5', satisfaction_score + 10, satisfaction_score) AS satisfaction_score)
FROM int_support_clean""",
    "int_billing_clean": "SELECT * REPLACE (if(invoice_id LIKE '%8', NULL, invoice_id) AS invoice_id) FROM int_billing_clean",
    "int_r5_ml_features": """SELECT * REPLACE (if(customer_id LIKE '%2', 5, label_churn_next_90d) AS label_churn_next_90d)
FROM int_r5_ml_features""",
}
_whole_suite = "\nUNION ALL ".join(
    [_failures(m, c, "not_null", f"{c} IS NULL") for m, cs in _keys.items() for c in cs.split()]
    + [_failures(m, c, "not_null", f"{c} IS NULL") for m, cs in _required.items() for c in cs.split()]
    + [_failures(*check) for check in _others]
    + [_repeats(m, c) for m, cs in _keys.items() for c in cs.split()]
)
for _name in _damage:
    _whole_suite = _whole_suite.replace(f"FROM {_name}", f"FROM damaged_{_name}")
_whole_suite = _whole_suite.replace("SELECT customer_id FROM damaged_", "SELECT customer_id FROM ")

_n = "CAST(regexp_extract({}, '([0-9]+)', 1) AS BIGINT)"
_earlier = "DATE '2023-07-01'"
_payment, _ticket = _n.format("payment_id"), _n.format("ticket_id")
_invoice = _n.format("invoice_id")
_merged = "SELECT * FROM {new} UNION ALL SELECT * FROM {old} WHERE {key} NOT IN (SELECT {key} FROM {new})"
_parsed = """try_strptime(payment_date, ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%m/%d/%Y', '%d-%b-%Y'])"""
LATER = {
    "dim_date": ((), _calendar),
    **{f"damaged_{name}": ((name,), text) for name, text in _damage.items()},
    "dq_suite": ((*_keys, "int_xref_customer_clean", "order_item", *(f"damaged_{n}" for n in _damage)), _whole_suite),
    "text_payments": (
        ("payments",),
        f"""SELECT * REPLACE (CASE {_payment} % 5 WHEN 0 THEN strftime(payment_date, '%Y-%m-%d') WHEN 1 THEN strftime(payment_date, '%-m/%-d/%Y')
  WHEN 2 THEN strftime(payment_date, '%-d-%b-%Y') WHEN 3 THEN strftime(payment_date, '%Y-%m-%d 10:30:00')
  ELSE if(payment_date IS NULL, NULL, '31/31/2024') END AS payment_date) FROM payments""",
    ),
    "parsed_payments": (("text_payments",), f"SELECT * REPLACE (CAST({_parsed} AS DATE) AS payment_date) FROM text_payments"),
    "text_dates": (("parsed_payments",), SILVER["int_payment_clean"][1].replace("FROM payments", "FROM parsed_payments")),
    "early_invoices": (("billing_invoices",), f"SELECT * FROM billing_invoices WHERE {_invoice} % 3 <> 0"),
    "late_invoices": (
        ("billing_invoices",),
        f"""SELECT * REPLACE (_airbyte_extracted_at + INTERVAL 1 DAY AS _airbyte_extracted_at) FROM billing_invoices
WHERE {_invoice} % 3 = 0 OR {_invoice} % 5 = 0""",
    ),
    **{
        name: (inputs, text)
        for side in ("early", "late")
        for name, inputs, text in (
            (
                f"{side}_billing_clean",
                (f"{side}_invoices",),
                SILVER["int_billing_clean"][1].replace("FROM billing_invoices", f"FROM {side}_invoices"),
            ),
            (
                f"{side}_fact_billing",
                (f"{side}_billing_clean", "int_subscription_clean", "int_customer_clean"),
                GOLD["fact_billing"][1].replace("int_billing_clean", f"{side}_billing_clean"),
            ),
        )
    },
    "synced_fact": (
        ("early_fact_billing", "late_fact_billing"),
        """SELECT * FROM late_fact_billing WHERE source_extracted_at > (SELECT max(source_extracted_at) FROM early_fact_billing)""",
    ),
    "sync_columns_files": (
        ("early_fact_billing", "synced_fact"),
        """SELECT * FROM synced_fact UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS currency) FROM early_fact_billing
WHERE billing_key NOT IN (SELECT billing_key FROM synced_fact)""",
    ),
    "earlier_contracts": (
        ("subscriptions_contracts",),
        "SELECT * REPLACE (contract_start_date - 20 AS contract_start_date) FROM subscriptions_contracts",
    ),
    "earlier_clean": (
        ("earlier_contracts",),
        SILVER["int_subscription_clean"][1].replace("FROM subscriptions_contracts", "FROM earlier_contracts").replace(TODAY, _earlier),
    ),
    "earlier_snapshot": (
        ("earlier_clean",),
        GOLD["fact_customer_month_snapshot"][1].replace("int_subscription_clean", "earlier_clean").replace(TODAY, _earlier),
    ),
    "snapshot_files": (
        ("earlier_snapshot", "fact_customer_month_snapshot"),
        _merged.format(new="fact_customer_month_snapshot", old="earlier_snapshot", key="customer_month_key"),
    ),
    "punctual_usage": (("service_usage",), f"SELECT * FROM service_usage WHERE {_first_load} AND sms_count % 3 <> 0"),
    "punctual_clean": (("punctual_usage",), _usage_sql.replace("FROM service_usage", "FROM punctual_usage")),
    "punctual_fact": (("punctual_clean",), _fact_sql.replace("FROM int_usage_clean", "FROM punctual_clean")),
    "looked_back": (
        ("fact_usage_snapshot", "punctual_fact"),
        """SELECT * FROM fact_usage_snapshot
WHERE source_extracted_at > (SELECT coalesce(max(source_extracted_at), TIMESTAMP '1900-01-01') - INTERVAL 5 DAY FROM punctual_fact)""",
    ),
    "lookback_files": (("looked_back", "punctual_fact"), _merged.format(new="looked_back", old="punctual_fact", key="usage_key")),
    "live_tickets": (
        ("support_tickets",),
        f"SELECT * FROM support_tickets WHERE _ab_cdc_deleted_at IS NULL AND {_ticket} % 11 <> 0",
    ),
    "deletes_tombstone": (("live_tickets",), SILVER["int_support_clean"][1].replace("FROM support_tickets", "FROM live_tickets")),
    "deletes_tombstone_files": (
        ("deletes_tombstone", "int_customer_clean"),
        GOLD["fact_support_ticket"][1].replace("FROM int_support_clean", "FROM deletes_tombstone"),
    ),
    **{f"no_{m}": ((f"int_{m}_clean",), f"SELECT * FROM int_{m}_clean WHERE false") for m in ("usage", "network", "support")},
    "friction_by_changes": (
        ("int_billing_clean", "int_payment_clean", "no_usage", "no_network", "no_support", "int_customer_clean"),
        ANALYTIC["int_r3_friction_monthly"][1]
        .replace("int_usage_clean", "no_usage")
        .replace("int_network_clean", "no_network")
        .replace("int_support_clean", "no_support"),
    ),
    "contracts_by_changes": (("int_subscription_clean",), "SELECT * FROM int_subscription_clean"),
    "mart_r1_loaded": (("mart_r1_churn_early",), "SELECT *, true AS loaded_today FROM mart_r1_churn_early"),
    "order_item_clustered": (("order_item",), "SELECT *, false AS overlaps FROM order_item"),
    "views": (
        ("int_customer_clean", "int_subscription_clean"),
        """SELECT region, contract_type, count(*) AS contracts, count(DISTINCT customer_id) AS customers
FROM int_subscription_clean JOIN (SELECT customer_id, region FROM int_customer_clean) USING (customer_id) GROUP BY ALL""",
    ),
}
_STEPS = ("damaged_", "text_payments", "parsed_", "early_", "late_", "synced_", "earlier_", "punctual_", "looked_", "live_", "first_", "no_")
STAGING = {
    **{f"stg_{source}": ((source,), f"SELECT * FROM {source}") for source in STATEMENTS},
    "tpch_orders": ((), "SELECT " + ", ".join(f"{a} AS {b}" for a, b in ORDERS.items()) + " FROM orders"),
    "tpch_lineitem": ((), "SELECT " + ", ".join(f"{a} AS {b}" for a, b in LINEITEM.items()) + " FROM lineitem"),
}
ALL = {**MODELS, **LOADS, **OPERATORS, **STAGING, **LATER}
QUERIES = [n for n in ALL if n not in RAW and n != "dim_date" and not n.startswith(_STEPS)]



def needed(name: str, found: dict[str, None] | None = None) -> dict[str, None]:
    """The models a query reads, inputs first."""
    found = {} if found is None else found
    for i in ALL[name][0]:
        if i not in found:
            needed(i, found)
            found[i] = None
    return found


def oracle_sql() -> dict[str, str]:
    def text(name: str) -> str:
        ctes = ",\n".join(f"{i} AS ({ALL[i][1].strip()})" for i in needed(name))
        casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS.get(name, ()))
        columns = f"* REPLACE ({casts})" if casts else "*"
        return (f"WITH {ctes}\n" if ctes else "") + f"SELECT {columns} FROM ({ALL[name][1].strip()})"

    return {name: text(name) for name in QUERIES}
