"""Each model as one SELECT over the models it reads.

Written against the rules of the models, not against their Spark code, and in
another form where there is one: ``DISTINCT ON`` for the newest version, a spine
with joins for the monthly friction, a range join for the snapshot, integer
arithmetic for rounded quotients.
"""

from __future__ import annotations

from oracle.constants import (
    CONTRACT_TYPES,
    GENDERS,
    MARITAL_STATUSES,
    PAYMENT_STATUSES,
    SERVICES,
    SUBSCRIPTION_STATUSES,
    TICKET_STATUSES,
)
from oracle.idioms import (
    ORIGIN,
    TODAY,
    category,
    codes,
    day_key,
    half_up,
    key,
    mean,
    money,
    money0,
    newest,
    percentage,
    title,
    whole0,
)

EXTRACTED = "_airbyte_extracted_at AS source_extracted_at"

SILVER: dict[str, tuple[tuple[str, ...], str]] = {}
SILVER["int_customer_clean"] = (
    ("crm_customers",),
    f"""
SELECT trim(customer_id) AS customer_id, sha256(coalesce(msisdn, '')) AS msisdn_hash, CAST(age AS BIGINT) AS age,
  {codes('gender', GENDERS)} AS gender,
  coalesce(nullif({title('trim(city)')}, ''), 'Unknown') AS city, {category('region')} AS region,
  nullif(upper(trim(postal_code)), '') AS postal_code, {codes('marital_status', MARITAL_STATUSES)} AS marital_status,
  age >= 65 AS senior_citizen, coalesce(senior_citizen = 1, false) AS senior_citizen_source,
  {category('customer_segment')} AS customer_segment, registration_date,
  coalesce(number_of_dependents > 0, false) AS has_dependents, coalesce(dependents = 1, false) AS has_dependents_source,
  {whole0('number_of_dependents')} AS dependents_count, {category('estimated_income_band')} AS estimated_income_band,
  CASE WHEN number_of_dependents < 0 THEN 'CORRECTED_TO_ZERO'
    WHEN coalesce(dependents = 1, false) <> coalesce(number_of_dependents > 0, false) THEN 'BOOLEAN_ALIGNED_TO_COUNT'
    ELSE 'VALID' END AS dependents_dq_status,
  'VALID' AS registration_date_dq_status,
  if(coalesce(senior_citizen = 1, false) = (age >= 65), 'VALID', 'FLAG_ALIGNED_TO_AGE') AS senior_dq_status,
  CASE WHEN age < 25 THEN '18_24' WHEN age < 35 THEN '25_34' WHEN age < 45 THEN '35_44' WHEN age < 65 THEN '45_64'
    ELSE '65_PLUS' END AS age_band,
  CAST(datediff('month', registration_date, {TODAY}) AS INTEGER) AS customer_tenure_months,
  {ORIGIN.replace('source_extracted_at', EXTRACTED)}
FROM ({newest('crm_customers', ['customer_id'], "trim(customer_id) <> '' AND age BETWEEN 18 AND 120")})
WHERE registration_date <= {TODAY}""",
)
SILVER["int_subscription_clean"] = (
    ("subscriptions_contracts",),
    f"""
SELECT *, CAST(datediff('month', contract_start_date, coalesce(contract_end_date, {TODAY})) AS INTEGER) AS tenure_months,
  status = 'ACTIVE' AND coalesce(contract_end_date >= {TODAY}, true) AS is_active_subscription,
  status = 'CANCELLED' OR coalesce(contract_end_date < {TODAY}, false) AS churn_candidate_flag
FROM (
  SELECT trim(subscription_id) AS subscription_id, trim(customer_id) AS customer_id, {codes('status', SUBSCRIPTION_STATUSES)} AS status,
    {category('plan_name')} AS plan_name, {category('plan_tier')} AS plan_tier,
    {codes('contract_type', CONTRACT_TYPES, category('contract_type'))} AS contract_type,
    contract_start_date,
    if(contract_end_date < contract_start_date, NULL, contract_end_date) AS contract_end_date,
    contract_end_date AS contract_end_date_source,
    if(plan_change_date < contract_start_date, NULL, plan_change_date) AS plan_change_date,
    plan_change_date AS plan_change_date_source,
    nullif(upper(trim(previous_plan)), '') AS previous_plan, {money0('base_monthly_price')} AS base_monthly_price,
    {", ".join(f"coalesce({raw} = 1, false) AS {name}" for raw, name in SERVICES.items())},
    coalesce(contract_end_date >= contract_start_date, true) AS dq_valid_contract_dates,
    coalesce(plan_change_date >= contract_start_date, true) AS dq_valid_plan_change_date,
    plan_change_date IS NULL OR trim(previous_plan) <> '' AS dq_plan_change_has_previous_plan,
    CASE WHEN contract_end_date < contract_start_date THEN 'INVALID_END_DATE_TO_NULL'
      WHEN plan_change_date < contract_start_date THEN 'INVALID_PLAN_CHANGE_TO_NULL'
      WHEN plan_change_date IS NOT NULL AND coalesce(trim(previous_plan), '') = '' THEN 'MISSING_PREVIOUS_PLAN'
      ELSE 'VALID' END AS subscription_dq_status,
    {ORIGIN.replace('source_extracted_at', EXTRACTED)}
  FROM ({newest('subscriptions_contracts', ['subscription_id'],
    "trim(subscription_id) <> '' AND trim(customer_id) <> '' AND contract_start_date IS NOT NULL")})
  WHERE contract_start_date <= {TODAY})""",
)
_charges = ("base_charge", "service_charge", "equipment_charge", "extra_usage_charge", "tax", "discount")
SILVER["int_billing_clean"] = (
    ("billing_invoices",),
    f"""
WITH typed AS (
  SELECT trim(invoice_id) AS invoice_id, trim(customer_id) AS customer_id, trim(subscription_id) AS subscription_id,
    trim(account_id) AS account_id, issue_date, due_date AS due_date_source, strftime(issue_date, '%Y-%m') AS billing_period,
    {category('invoice_status')} AS invoice_status, {category('currency', 'BOB')} AS currency,
    {", ".join(f"{money0(x)} AS {x}" for x in (*_charges, 'previous_month_amount'))},
    {money0('total_amount')} AS total_amount_source, total_amount IS NULL AS no_total,
    {money('coalesce(amount_change, 0)')} AS amount_change, {money('coalesce(amount_change_pct, 0)', 4)} AS amount_change_pct,
    {EXTRACTED}
  FROM ({newest('billing_invoices', ['invoice_id'],
    "trim(invoice_id) <> '' AND trim(customer_id) <> '' AND issue_date IS NOT NULL AND NOT coalesce(total_amount < 0, false)")})
  WHERE issue_date <= {TODAY}),
summed AS (
  SELECT *, {money0('base_charge + service_charge + equipment_charge + extra_usage_charge + tax - discount')}
    AS total_amount_recalculated FROM typed)
SELECT invoice_id, customer_id, subscription_id, account_id, issue_date,
  if(due_date_source < issue_date, NULL, due_date_source) AS due_date, due_date_source, billing_period, invoice_status, currency,
  {", ".join(_charges)}, total_amount_source, total_amount_recalculated,
  {money('total_amount_source - total_amount_recalculated')} AS amount_variance, previous_month_amount, amount_change,
  amount_change_pct, coalesce(due_date_source >= issue_date, true) AS dq_valid_dates, true AS dq_nonnegative_total,
  total_amount_source - total_amount_recalculated BETWEEN -0.05 AND 0.05 AS dq_total_match,
  CASE WHEN due_date_source < issue_date THEN 'INVALID_DUE_DATE_TO_NULL'
    WHEN total_amount_source - total_amount_recalculated NOT BETWEEN -0.05 AND 0.05 THEN 'TOTAL_MISMATCH_REVIEW'
    WHEN no_total THEN 'TOTAL_IMPUTED_ZERO' ELSE 'VALID' END AS billing_dq_status, {ORIGIN}
FROM summed""",
)
SILVER["int_payment_clean"] = (
    ("payments",),
    f"""
WITH typed AS (
  SELECT trim(payment_id) AS payment_id, trim(invoice_id) AS invoice_id, trim(customer_id) AS customer_id, payment_date,
    {category('payment_method')} AS payment_method, {codes('payment_status', PAYMENT_STATUSES)} AS payment_status,
    {category('collection_action', 'NONE')} AS collection_action, {money0('amount_due')} AS amount_due,
    {money0('amount_paid')} AS amount_paid, {money0('outstanding_balance')} AS reported,
    {whole0('days_late')} AS days_late, {whole0('failed_attempts')} AS failed_attempts, {EXTRACTED}
  FROM ({newest('payments', ['payment_id'], "trim(payment_id) <> '' AND trim(customer_id) <> ''"
    " AND NOT coalesce(amount_due < 0, false) AND NOT coalesce(amount_paid < 0, false)")})),
balanced AS (SELECT *, {money0('amount_due - amount_paid')} AS still_open FROM typed)
SELECT payment_id, invoice_id, customer_id, payment_date, payment_method, payment_status, collection_action, amount_due, amount_paid,
  still_open AS outstanding_balance, reported AS outstanding_balance_source, {money('reported - still_open')} AS outstanding_balance_variance,
  days_late, failed_attempts, true AS dq_valid_amount_due, true AS dq_valid_amount_paid, true AS dq_valid_outstanding_source,
  amount_due = 0 OR 100 * amount_paid <= 105 * amount_due AS dq_payment_not_materially_overpaid,
  abs(reported - still_open) <= 0.05 AS dq_outstanding_reconciles,
  CASE WHEN payment_date > {TODAY} THEN 'FUTURE_PAYMENT_DATE_REVIEW'
    WHEN amount_due > 0 AND 100 * amount_paid > 105 * amount_due THEN 'OVERPAYMENT_REVIEW'
    WHEN abs(reported - still_open) > 0.05 THEN 'BALANCE_RECALCULATED' ELSE 'VALID' END AS payment_dq_status,
  'VALID' AS days_late_dq_status, {ORIGIN}
FROM balanced""",
)
SILVER["int_usage_clean"] = (
    ("service_usage",),
    f"""
WITH typed AS (
  SELECT trim(usage_id) AS usage_id, trim(customer_id) AS customer_id, usage_date,
    {", ".join(f"{money0(x, 4)} AS {x}" for x in ('data_download_gb', 'data_upload_gb', 'peak_usage_gb', 'offpeak_usage_gb'))},
    {", ".join(f"{money0(x)} AS {x}" for x in ('voice_minutes', 'international_minutes'))},
    {money0('streaming_hours')} AS hours, {money0('avg_session_minutes')} AS minutes,
    {whole0('sms_count')} AS sms_count, {whole0('total_session_count')} AS total_session_count, {EXTRACTED}
  FROM ({newest('service_usage', ['usage_id'],
    "trim(usage_id) <> '' AND trim(customer_id) <> '' AND usage_date IS NOT NULL")})
  WHERE usage_date <= {TODAY}),
capped AS (
  SELECT *, {money('least(hours, 24)')} AS streaming_hours, {money('least(minutes, 1440)')} AS avg_session_minutes,
    10 * abs(peak_usage_gb + offpeak_usage_gb - data_download_gb) <= greatest(1, data_download_gb) AS dq_peak_offpeak_reconciles,
    data_download_gb + data_upload_gb + voice_minutes + sms_count + least(hours, 24) AS activity
  FROM typed)
SELECT usage_id, customer_id, usage_date, data_download_gb, data_upload_gb, voice_minutes, sms_count, streaming_hours,
  total_session_count, avg_session_minutes, international_minutes, peak_usage_gb, offpeak_usage_gb,
  {money('data_download_gb + data_upload_gb', 4)} AS total_data_gb, {money('voice_minutes + international_minutes')} AS total_voice_minutes,
  CASE WHEN total_session_count > 0 THEN
    {half_up('(data_download_gb + data_upload_gb) * 10000', 'total_session_count', 0)} / 10000 END AS avg_data_gb_per_session,
  true AS dq_nonnegative_metrics, dq_peak_offpeak_reconciles,
  CASE WHEN hours > 24 OR minutes > 1440 THEN 'OUTLIER_CAPPED' WHEN activity = 0 THEN 'NO_RECORDED_USAGE'
    WHEN NOT dq_peak_offpeak_reconciles THEN 'USAGE_COMPONENT_MISMATCH' ELSE 'VALID' END AS usage_dq_status,
  activity > 0 AS has_service_activity, {ORIGIN}
FROM capped""",
)
SILVER["int_network_clean"] = (
    ("network_quality",),
    f"""
WITH typed AS (
  SELECT trim(event_id) AS event_id, trim(customer_id) AS customer_id, trim(device_id) AS device_id,
    TRY_CAST("timestamp" AS TIMESTAMP) AS event_timestamp, {category('event_type')} AS event_type_norm,
    {category('technology')} AS technology_norm, {category('network_node')} AS network_node,
    {", ".join(f"{money(f'coalesce({x}_in, 0)', 4 if x == 'packet_loss_pct' else 2)} AS {x}_in" for x in
      ('latency_ms', 'jitter_ms', 'packet_loss_pct', 'signal_strength_dbm', 'download_mbps', 'upload_mbps', 'outage_duration_seconds'))},
    coalesce(lower(trim(connection_dropped)) IN ('true', 't', 'yes', 'y', 'on', '1'), false) AS connection_dropped_bool, {EXTRACTED}
  FROM (SELECT * RENAME (latency_ms AS latency_ms_in, jitter_ms AS jitter_ms_in, packet_loss_pct AS packet_loss_pct_in,
      signal_strength_dbm AS signal_strength_dbm_in, download_mbps AS download_mbps_in, upload_mbps AS upload_mbps_in,
      outage_duration_seconds AS outage_duration_seconds_in)
    FROM ({newest('network_quality', ['event_id'],
      "trim(event_id) <> '' AND trim(customer_id) <> '' AND _ab_cdc_deleted_at IS NULL")}))),
capped AS (
  SELECT *, {money('least(greatest(latency_ms_in, 0), 10000)')} AS latency_ms, {money('least(greatest(jitter_ms_in, 0), 5000)')} AS jitter_ms,
    {money('least(greatest(packet_loss_pct_in, 0), 100)', 4)} AS packet_loss_pct, {money0('download_mbps_in')} AS download_mbps,
    {money0('upload_mbps_in')} AS upload_mbps, {money0('outage_duration_seconds_in')} AS outage_duration_seconds,
    if(signal_strength_dbm_in BETWEEN -150 AND -10, signal_strength_dbm_in, NULL) AS signal_strength_dbm
  FROM typed WHERE CAST(event_timestamp AS DATE) <= {TODAY})
SELECT event_id, customer_id, device_id, event_timestamp, event_type_norm, technology_norm, network_node, latency_ms, jitter_ms,
  packet_loss_pct, download_mbps, upload_mbps, signal_strength_dbm, outage_duration_seconds, connection_dropped_bool,
  CASE WHEN least(latency_ms_in, jitter_ms_in, download_mbps_in, upload_mbps_in, outage_duration_seconds_in) < 0
      THEN 'NEGATIVE_METRIC_CORRECTED'
    WHEN packet_loss_pct_in < 0 OR packet_loss_pct_in > 100 THEN 'PACKET_LOSS_CAPPED'
    WHEN signal_strength_dbm IS NULL THEN 'INVALID_SIGNAL_TO_NULL'
    WHEN latency_ms_in > 2000 OR jitter_ms_in > 1000 OR outage_duration_seconds_in > 86400 THEN 'EXTREME_OUTLIER_CAPPED'
    ELSE 'VALID' END AS network_dq_status,
  CASE WHEN connection_dropped_bool OR outage_duration_seconds > 0 THEN 'OUTAGE_OR_DROP'
    WHEN packet_loss_pct >= 5 OR latency_ms >= 200 OR jitter_ms >= 50 THEN 'DEGRADED'
    WHEN coalesce(signal_strength_dbm < -110, true) THEN 'WEAK_SIGNAL' ELSE 'NORMAL' END AS network_quality_band,
  latency_ms_in >= 0 AS dq_valid_latency, packet_loss_pct_in BETWEEN 0 AND 100 AS dq_valid_packet_loss,
  signal_strength_dbm IS NOT NULL AS dq_valid_signal, {ORIGIN}
FROM capped""",
)
_truth = "IN ('true', 't', 'yes', 'y', 'on', '1')"
SILVER["int_support_clean"] = (
    ("support_tickets",),
    f"""
WITH typed AS (
  SELECT trim(ticket_id) AS ticket_id, trim(customer_id) AS customer_id, TRY_CAST(created_at AS TIMESTAMP) AS created_timestamp,
    TRY_CAST(resolved_at AS TIMESTAMP) AS resolved_timestamp_source, {codes('status', TICKET_STATUSES)} AS status,
    {", ".join(f"{category(x)} AS {x}" for x in ('channel', 'category', 'priority', 'reason', 'agent_team'))},
    coalesce(lower(trim(reopened)) {_truth}, false) AS reopened,
    coalesce(lower(trim(first_contact_resolution)) {_truth}, false) AS first_contact_resolution,
    {whole0('interaction_count')} AS interaction_count,
    {money0('TRY_CAST(resolution_minutes AS DECIMAL(38,0))')} AS resolution_minutes_num, {money('satisfaction_score')} AS score, {EXTRACTED}
  FROM ({newest('support_tickets', ['ticket_id'],
    "trim(ticket_id) <> '' AND trim(customer_id) <> '' AND _ab_cdc_deleted_at IS NULL")}))
SELECT ticket_id, customer_id, CAST(NULL AS VARCHAR) AS contact_id, created_timestamp,
  if(resolved_timestamp_source < created_timestamp, NULL, resolved_timestamp_source) AS resolved_timestamp, resolved_timestamp_source,
  status, channel, category, priority, reason, agent_team,
  CASE WHEN regexp_matches(category || ' ' || reason, 'CANCEL|CHURN') THEN 'RETENTION_RISK'
    WHEN regexp_matches(category, 'BILL') OR regexp_matches(reason, 'PAY') THEN 'BILLING'
    WHEN regexp_matches(category, 'NETWORK|OUTAGE') OR regexp_matches(reason, 'SIGNAL') THEN 'NETWORK'
    WHEN regexp_matches(category, 'TECH') THEN 'TECHNICAL' ELSE 'GENERAL' END AS classification,
  reopened, interaction_count, resolution_minutes_num, if(score BETWEEN 0 AND 5, score, NULL) AS satisfaction_score,
  first_contact_resolution,
  CASE WHEN score IS NULL THEN 'MISSING' WHEN score BETWEEN 0 AND 5 THEN 'VALID' ELSE 'OUT_OF_RANGE_TO_NULL' END AS satisfaction_dq_status,
  coalesce(resolved_timestamp_source >= created_timestamp, true) AS dq_valid_resolution_timestamp, true AS dq_valid_resolution_minutes,
  CASE WHEN resolved_timestamp_source < created_timestamp THEN 'INVALID_RESOLUTION_TO_NULL'
    WHEN score < 0 OR score > 5 THEN 'SATISFACTION_OUTLIER_TO_NULL'
    WHEN status IN ('RESOLVED', 'CLOSED') AND resolved_timestamp_source IS NULL THEN 'CLOSED_WITHOUT_VALID_RESOLUTION'
    ELSE 'VALID' END AS support_dq_status,
  CASE WHEN NOT coalesce(resolved_timestamp_source >= created_timestamp, false) THEN 'OPEN_OR_UNRESOLVED'
    WHEN resolution_minutes_num > CASE WHEN priority IN ('CRITICAL', 'URGENT') THEN 240 WHEN priority = 'HIGH' THEN 480 ELSE 1440 END
      THEN 'SLA_BREACH' ELSE 'WITHIN_SLA' END AS sla_status, {ORIGIN}
FROM typed WHERE CAST(created_timestamp AS DATE) <= {TODAY}""",
)
SILVER["int_marketing_clean"] = (
    ("marketing_retention",),
    f"""
WITH typed AS (
  SELECT trim(interaction_id) AS interaction_id, trim(customer_id) AS customer_id, nullif(trim(campaign_id), '') AS campaign_id,
    coalesce(nullif({title('trim(campaign_name)')}, ''), 'Unknown') AS campaign_name, contact_date AS contact_date_parsed,
    response_date AS response_date_source, {category('channel')} AS channel_norm, {category('offer_type')} AS offer_type_norm,
    coalesce(accepted, false) AS accepted_bool, coalesce(upgrade_offered, false) AS upgrade_offered,
    coalesce(equipment_upgrade, false) AS equipment_upgrade, {money0('discount_pct', 4)} AS discount,
    {whole0('free_months')} AS months, {money0('campaign_cost')} AS campaign_cost_num,
    {money0('estimated_customer_value')} AS estimated_customer_value_num,
    coalesce(retained_30d, false) AS retained_30d_source, coalesce(retained_60d, false) AS retained_60d_source,
    coalesce(retained_90d, false) AS retained_90d_source, nullif(upper(trim(retention_reason)), '') AS retention_reason, {EXTRACTED},
    coalesce(response_date BETWEEN contact_date AND {TODAY}, true) AS dq_valid_response_date
  FROM ({newest('marketing_retention', ['interaction_id'],
    "trim(interaction_id) <> '' AND trim(customer_id) <> '' AND contact_date IS NOT NULL")})
  WHERE contact_date <= {TODAY})
SELECT interaction_id, customer_id, campaign_id, campaign_name, contact_date_parsed,
  if(dq_valid_response_date, response_date_source, NULL) AS response_date_parsed, response_date_source, channel_norm, offer_type_norm,
  accepted_bool, upgrade_offered, equipment_upgrade, {money('least(discount, 100)', 4)} AS discount_pct_num, least(months, 24) AS free_months_num,
  campaign_cost_num, estimated_customer_value_num, retained_30d_source OR retained_60d_source OR retained_90d_source AS retained_30d,
  retained_60d_source OR retained_90d_source AS retained_60d, retained_90d_source AS retained_90d, retained_30d_source,
  retained_60d_source, retained_90d_source, retention_reason,
  CASE WHEN campaign_cost_num > 0 THEN
    {half_up('100 * (estimated_customer_value_num - campaign_cost_num)', '100 * campaign_cost_num', 4)} END AS estimated_campaign_roi,
  discount <= 100 AS dq_valid_discount, dq_valid_response_date,
  (NOT retained_90d_source OR retained_60d_source) AND (NOT retained_60d_source OR retained_30d_source) AS dq_retention_windows_monotonic,
  CASE WHEN NOT dq_valid_response_date THEN 'INVALID_RESPONSE_DATE_TO_NULL' WHEN discount > 100 THEN 'DISCOUNT_CAPPED'
    WHEN months > 24 THEN 'FREE_MONTHS_CAPPED'
    WHEN retained_90d_source > retained_60d_source OR retained_60d_source > retained_30d_source THEN 'RETENTION_WINDOWS_CORRECTED'
    ELSE 'VALID' END AS marketing_dq_status,
  response_date_source IS NOT NULL OR retained_30d_source OR retained_60d_source OR retained_90d_source OR retention_reason IS NOT NULL
    AS has_post_outcome_data, {ORIGIN}
FROM typed""",
)
SILVER["int_churn_clean"] = (
    ("churn_labels", "int_customer_clean"),
    f"""
WITH events AS (
  SELECT trim(customer_id) AS customer_id, churn_date, {whole0('tenure_months_at_end')} AS tenure_months_source,
    {category('churn_reason')} AS churn_reason_raw, {EXTRACTED}
  FROM ({newest('churn_labels', ['customer_id'], "trim(customer_id) <> '' AND churned IN (0, 1)")}) WHERE churned = 1),
dated AS (
  SELECT e.*, datediff('month', c.registration_date, churn_date) AS tenure_months_recalculated
  FROM events e LEFT JOIN (SELECT customer_id, registration_date FROM int_customer_clean) c USING (customer_id)
  WHERE churn_date <= {TODAY} AND coalesce(churn_date >= registration_date, true))
SELECT customer_id, churn_date, greatest(coalesce(tenure_months_recalculated, tenure_months_source), 0) AS tenure_months_at_end,
  tenure_months_source, CAST(tenure_months_recalculated AS INTEGER) AS tenure_months_recalculated,
  CASE WHEN regexp_matches(churn_reason_raw, 'PRICE|COST|EXPENS') THEN 'PRICE'
    WHEN regexp_matches(churn_reason_raw, 'NETWORK|SIGNAL|OUTAGE') THEN 'NETWORK_QUALITY'
    WHEN regexp_matches(churn_reason_raw, 'SUPPORT|SERVICE|ATTENTION') THEN 'CUSTOMER_SERVICE'
    WHEN regexp_matches(churn_reason_raw, 'COMPET') THEN 'COMPETITOR'
    WHEN regexp_matches(churn_reason_raw, 'MOVE|RELOCAT') THEN 'RELOCATION'
    WHEN churn_reason_raw = 'UNKNOWN' THEN 'UNKNOWN' ELSE 'OTHER' END AS churn_reason,
  churn_reason_raw, 'CHURNED' AS customer_status,
  CASE WHEN {TODAY} - churn_date <= 30 THEN 'CHURN_0_30_DAYS' WHEN {TODAY} - churn_date <= 60 THEN 'CHURN_31_60_DAYS'
    WHEN {TODAY} - churn_date <= 90 THEN 'CHURN_61_90_DAYS' ELSE 'CHURN_OVER_90_DAYS' END AS churn_recency_window,
  CAST({TODAY} - churn_date AS INTEGER) AS days_since_churn, true AS dq_churn_after_registration, true AS dq_valid_source_tenure,
  if(abs(tenure_months_source - tenure_months_recalculated) > 1, 'TENURE_RECALCULATED', 'VALID') AS churn_dq_status,
  'TARGET_OUTCOME' AS churned_field_class, 'POST_OUTCOME_DETAIL' AS churn_detail_field_class, {ORIGIN}
FROM dated""",
)
SILVER["int_macro_clean"] = (
    ("macro_monthly",),
    f"""
WITH typed AS (
  SELECT trim(year_month) AS year_month, CAST(trim(year_month) || '-01' AS DATE) AS month_start, CAST(ipc_index AS DOUBLE) AS ipc,
    CAST(desempleo_pct AS DOUBLE) AS jobless, CAST(inflacion_mensual AS DOUBLE) AS inflation,
    CAST(tipo_cambio_bob_usd AS DOUBLE) AS rate, CAST(coalesce(shock_tarifa = 1, false) AS INTEGER) AS shock_tarifa, {EXTRACTED}
  FROM ({newest('macro_monthly', ['year_month'], "regexp_full_match(trim(year_month), '[0-9]{4}-(0[1-9]|1[0-2])')")})),
judged AS (
  SELECT *, ipc > 0 AND ipc < 10000 AS dq_valid_ipc, jobless BETWEEN 0 AND 100 AS dq_valid_unemployment,
    inflation BETWEEN -50 AND 100 AS dq_valid_inflation, rate > 0 AND rate < 100 AS dq_valid_exchange_rate
  FROM typed WHERE month_start <= date_trunc('month', {TODAY}))
SELECT year_month, month_start, if(dq_valid_ipc, ipc, NULL) AS ipc_index, if(dq_valid_unemployment, jobless, NULL) AS desempleo_pct,
  if(dq_valid_inflation, inflation, NULL) AS inflacion_mensual, if(dq_valid_exchange_rate, rate, NULL) AS tipo_cambio_bob_usd,
  shock_tarifa, true AS dq_valid_year_month, dq_valid_ipc, dq_valid_unemployment, dq_valid_inflation, dq_valid_exchange_rate,
  CASE dq_valid_ipc AND dq_valid_unemployment AND dq_valid_inflation AND dq_valid_exchange_rate WHEN true THEN 'VALID'
    ELSE if(ipc + jobless + inflation + rate IS NULL, 'MISSING_INDICATOR_TO_NULL', 'OUTLIER_TO_NULL') END AS macro_dq_status, {ORIGIN}
FROM judged""",
)


def _number(x: str, scale: int) -> str:
    precision = 18 if scale else 38
    return f"TRY_CAST(regexp_replace({x}, '[^0-9.-]', '', 'g') AS DECIMAL({precision},{scale}))"


def _target_status(x: str, more: str = "") -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'IMPUTED_ZERO' WHEN {x} < 0 THEN 'NEGATIVE_CORRECTED_TO_ZERO' {more} ELSE 'VALID' END"
    )


SILVER["int_retention_target_clean"] = (
    ("metas_retencion_region_mes",),
    f"""
WITH typed AS (
  SELECT trim(target_id) AS target_id, {category('region')} AS region, trim(year_month) AS year_month,
    CAST(trim(year_month) || '-01' AS DATE) AS month_start, {_number('arpu_target_bob', 2)} AS arpu,
    CAST({_number('active_base_target', 0)} AS BIGINT) AS base, {_number('retention_budget_bob', 2)} AS budget,
    {_number('churn_rate_target_pct', 4)} AS rate, CAST({_number('retained_customers_target', 0)} AS BIGINT) AS retained,
    {category('responsable_comercial', 'UNASSIGNED')} AS responsable_comercial,
    TRY_CAST(ultima_actualizacion AS TIMESTAMP) AS ultima_actualizacion_ts, nullif(trim(comentario), '') AS comentario, {EXTRACTED}
  FROM ({newest('metas_retencion_region_mes', ['target_id'],
    "trim(target_id) <> '' AND regexp_full_match(trim(year_month), '[0-9]{4}-(0[1-9]|1[0-2])')")})),
bounded AS (
  SELECT *, greatest(coalesce(base, 0), 0) AS active_base_target_num,
    least(greatest(coalesce(retained, 0), 0), greatest(coalesce(base, 0), 0)) AS retained_customers_target_num FROM typed)
SELECT target_id, region, year_month, month_start, {money0('arpu')} AS arpu_target_bob_num, active_base_target_num,
  {money0('budget')} AS retention_budget_bob_num, {money('least(greatest(coalesce(rate, 0), 0), 100)', 4)} AS churn_rate_target_pct_num,
  retained_customers_target_num, responsable_comercial, ultima_actualizacion_ts, comentario,
  CASE WHEN active_base_target_num > 0 THEN
    {half_up('100 * retained_customers_target_num', 'active_base_target_num', 4)} END AS retention_rate_target_pct_num,
  true AS dq_valid_year_month, {_target_status('arpu')} AS arpu_target_dq_status,
  {_target_status('rate', "WHEN rate > 100 THEN 'CAPPED_AT_100'")} AS churn_target_dq_status,
  {_target_status('retained', "WHEN retained > active_base_target_num THEN 'CAPPED_TO_ACTIVE_BASE'")} AS retained_target_dq_status,
  {_target_status('budget')} AS budget_target_dq_status, {ORIGIN}
FROM bounded""",
)
SILVER["int_xref_customer_clean"] = (
    ("xref_customer_id",),
    f"""
SELECT trim(account_id) AS account_id, trim(customer_id) AS customer_id, upper(trim(source_crm)) AS source_crm,
  upper(trim(source_billing)) AS source_billing, {EXTRACTED}
FROM ({newest('xref_customer_id', ['account_id', 'customer_id'], "trim(account_id) <> '' AND trim(customer_id) <> ''")})""",
)

_age_of_contract = f"datediff('month', contract_start_date, {TODAY})"
ANALYTIC: dict[str, tuple[tuple[str, ...], str]] = {
    "int_r1_early_churn": (
        ("int_customer_clean", "int_subscription_clean", "int_churn_clean"),
        f"""
SELECT customer_id, region, customer_segment, gender, age, subscription_id, plan_name, plan_tier, contract_type, contract_start_date,
  if(e.customer_id IS NULL, 0, 1) AS churned, churn_date, churn_reason, tenure_months_at_end, true AS is_first_12_months
FROM int_subscription_clean s SEMI JOIN int_customer_clean USING (customer_id)
LEFT JOIN (SELECT customer_id, region, customer_segment, gender, age FROM int_customer_clean) c USING (customer_id)
LEFT JOIN (SELECT customer_id, churn_date, churn_reason, tenure_months_at_end FROM int_churn_clean) e USING (customer_id)
WHERE coalesce(tenure_months_at_end, {_age_of_contract}) BETWEEN 0 AND 12""",
    ),
    "int_r2_contract_opportunity": (
        ("int_customer_clean", "int_subscription_clean", "int_churn_clean"),
        f"""
SELECT customer_id, region, customer_segment, subscription_id, plan_name, plan_tier, contract_type, base_monthly_price,
  contract_start_date, CAST({_age_of_contract} AS INTEGER) AS tenure_months,
  CAST(customer_id IN (SELECT customer_id FROM int_churn_clean) AS INTEGER) AS churned,
  CASE WHEN customer_id IN (SELECT customer_id FROM int_churn_clean) THEN 'NO_ACTION_CHURNED'
    ELSE ['LOW', 'MEDIUM', 'HIGH'][1 + CAST({_age_of_contract} >= 6 AS INTEGER) + CAST({_age_of_contract} >= 12 AS INTEGER)]
    END AS migration_priority
FROM (SELECT * FROM int_subscription_clean WHERE contract_type = 'MONTH_TO_MONTH') s
JOIN (SELECT customer_id, region, customer_segment FROM int_customer_clean) c USING (customer_id)""",
    ),
    "int_r3_friction_monthly": (
        (
            "int_billing_clean",
            "int_payment_clean",
            "int_usage_clean",
            "int_network_clean",
            "int_support_clean",
            "int_customer_clean",
        ),
        f"""
WITH i AS (SELECT customer_id, date_trunc('month', issue_date) AS m, sum(total_amount_recalculated) AS billed, sum(amount_change) AS change
    FROM int_billing_clean GROUP BY ALL),
p AS (SELECT b.customer_id, date_trunc('month', payment_date) AS m, sum(failed_attempts) AS failed, sum(outstanding_balance) AS owed,
    sum(days_late) AS late FROM int_payment_clean p JOIN int_billing_clean b ON p.invoice_id = b.invoice_id GROUP BY ALL),
u AS (SELECT customer_id, date_trunc('month', usage_date) AS m, sum(data_download_gb + data_upload_gb) AS gb, sum(voice_minutes) AS voice
    FROM int_usage_clean GROUP BY ALL),
n AS (SELECT customer_id, date_trunc('month', event_timestamp) AS m, count(*) FILTER (connection_dropped_bool) AS drops,
    sum(outage_duration_seconds) AS outage, {mean('latency_ms', 2)} AS latency, {mean('packet_loss_pct', 4)} AS loss
    FROM int_network_clean GROUP BY ALL),
t AS (SELECT customer_id, date_trunc('month', created_timestamp) AS m, count(*) AS tickets, {mean('resolution_minutes_num', 2)} AS minutes,
    {mean('satisfaction_score', 2)} AS score FROM int_support_clean GROUP BY ALL),
spine AS (SELECT customer_id, m FROM i UNION SELECT customer_id, m FROM p UNION SELECT customer_id, m FROM u
    UNION SELECT customer_id, m FROM n UNION SELECT customer_id, m FROM t)
SELECT customer_id, strftime(m, '%Y-%m') AS year_month, CAST(m AS DATE) AS month_start, region,
  coalesce(billed, 0) AS billed_amount, coalesce(change, 0) AS billing_amount_change,
  CAST(coalesce(failed, 0) AS BIGINT) AS failed_payment_attempts, coalesce(owed, 0) AS outstanding_balance,
  CAST(coalesce(late, 0) AS BIGINT) AS total_days_late, coalesce(gb, 0) AS total_data_gb, coalesce(voice, 0) AS voice_minutes,
  coalesce(drops, 0) AS dropped_connections, coalesce(outage, 0) AS outage_seconds, coalesce(latency, 0) AS avg_latency_ms,
  coalesce(loss, 0) AS avg_packet_loss_pct, coalesce(tickets, 0) AS ticket_count, coalesce(minutes, 0) AS avg_resolution_minutes,
  coalesce(score, 0) AS avg_satisfaction_score
FROM spine LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c USING (customer_id)
LEFT JOIN i USING (customer_id, m) LEFT JOIN p USING (customer_id, m) LEFT JOIN u USING (customer_id, m)
LEFT JOIN n USING (customer_id, m) LEFT JOIN t USING (customer_id, m)""",
    ),
    "int_r4_campaign_effectiveness": (
        ("int_marketing_clean", "int_customer_clean"),
        """
SELECT interaction_id, campaign_id, campaign_name, customer_id, region, customer_segment, contact_date_parsed AS contact_date,
  strftime(contact_date_parsed, '%Y-%m') AS year_month, channel_norm AS channel, offer_type_norm AS offer_type,
  discount_pct_num AS discount_pct, free_months_num AS free_months, campaign_cost_num AS campaign_cost,
  estimated_customer_value_num AS estimated_customer_value, accepted_bool AS accepted, retained_30d, retained_60d, retained_90d,
  upgrade_offered, equipment_upgrade, retention_reason,
  if(accepted_bool, estimated_customer_value_num, 0) - campaign_cost_num AS estimated_net_value
FROM int_marketing_clean LEFT JOIN (SELECT customer_id, region, customer_segment FROM int_customer_clean) c USING (customer_id)""",
    ),
    "int_r5_ml_features": (
        ("int_r3_friction_monthly", "int_customer_clean", "int_subscription_clean", "int_macro_clean", "int_churn_clean"),
        """
WITH contract AS (
  SELECT DISTINCT ON (customer_id) customer_id, plan_tier, contract_type, base_monthly_price FROM int_subscription_clean
  ORDER BY customer_id, contract_start_date DESC, subscription_id DESC)
SELECT f.*, last_day(f.month_start) AS observation_date, age, gender, customer_segment, senior_citizen AS is_senior_citizen,
  plan_tier, contract_type, base_monthly_price, ipc_index, desempleo_pct AS unemployment_pct,
  inflacion_mensual AS monthly_inflation_pct, tipo_cambio_bob_usd AS bob_usd_exchange_rate,
  coalesce(shock_tarifa = 1, false) AS tariff_shock,
  CAST(coalesce(churn_date - last_day(f.month_start) BETWEEN 1 AND 90, false) AS INTEGER) AS label_churn_next_90d
FROM int_r3_friction_monthly f
LEFT JOIN (SELECT customer_id, age, gender, customer_segment, senior_citizen FROM int_customer_clean) c ON f.customer_id = c.customer_id
LEFT JOIN contract s ON f.customer_id = s.customer_id
LEFT JOIN int_macro_clean m ON f.year_month = m.year_month
LEFT JOIN (SELECT customer_id, churn_date FROM int_churn_clean) e ON f.customer_id = e.customer_id
WHERE churn_date IS NULL OR churn_date > last_day(f.month_start)""",
    ),
}

GOLD: dict[str, tuple[tuple[str, ...], str]] = {
    "dim_customer": (
        ("int_customer_clean",),
        f"""
SELECT {key('customer_id')} AS customer_key, {key('region')} AS region_key, customer_id, age, gender, city, region, postal_code,
  marital_status, senior_citizen, customer_segment, registration_date, has_dependents, dependents_count, estimated_income_band,
  source_extracted_at AS effective_from, true AS is_current FROM int_customer_clean""",
    ),
    "dim_subscription": (
        ("int_subscription_clean",),
        f"""
SELECT {key('subscription_id')} AS subscription_key, {key('customer_id')} AS customer_key, {key('plan_name', 'plan_tier')} AS plan_key,
  subscription_id, status, contract_type, contract_start_date, contract_end_date, plan_change_date, previous_plan, base_monthly_price,
  {", ".join(SERVICES.values())}, source_raw_id, source_extracted_at, source_generation_id FROM int_subscription_clean""",
    ),
    "dim_plan": (
        ("int_subscription_clean",),
        f"""SELECT DISTINCT {key('plan_name', 'plan_tier')} AS plan_key, plan_name, plan_tier FROM int_subscription_clean""",
    ),
    "dim_region": (
        ("int_customer_clean",),
        f"""SELECT DISTINCT {key('region')} AS region_key, region AS region_name FROM int_customer_clean""",
    ),
    "dim_campaign": (
        ("int_marketing_clean",),
        f"""
SELECT DISTINCT ON (campaign_id) {key('campaign_id')} AS campaign_key, campaign_id, campaign_name FROM int_marketing_clean
WHERE campaign_id IS NOT NULL ORDER BY campaign_id, source_extracted_at DESC NULLS FIRST, campaign_name, interaction_id""",
    ),
    "dim_agent_team": (
        ("int_support_clean",),
        f"""SELECT DISTINCT {key('agent_team')} AS agent_team_key, agent_team AS agent_team_name FROM int_support_clean""",
    ),
    "dim_network_node": (
        ("int_network_clean",),
        f"""SELECT DISTINCT {key('network_node')} AS network_node_key, network_node FROM int_network_clean""",
    ),
    "fact_billing": (
        ("int_billing_clean", "int_subscription_clean", "int_customer_clean"),
        f"""
SELECT {key('invoice_id')} AS billing_key, {key('b.customer_id')} AS customer_key, {key('b.subscription_id')} AS subscription_key,
  {key('plan_name', 'plan_tier')} AS plan_key, {key('region')} AS region_key, {day_key('issue_date')} AS issue_date_key,
  {day_key('due_date')} AS due_date_key, invoice_id, account_id, billing_period, invoice_status, currency, {", ".join(_charges)},
  total_amount_source, total_amount_recalculated, CAST(CAST(amount_variance AS DECIMAL(38,0)) AS BIGINT) AS amount_variance,
  previous_month_amount, amount_change, amount_change_pct, 1 AS invoice_count, dq_valid_dates, dq_nonnegative_total, dq_total_match,
  b.source_raw_id, b.source_extracted_at, b.source_generation_id
FROM int_billing_clean b LEFT JOIN (SELECT subscription_id, plan_name, plan_tier FROM int_subscription_clean) s
  ON b.subscription_id = s.subscription_id
LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c ON b.customer_id = c.customer_id""",
    ),
    "fact_payment": (
        ("int_payment_clean",),
        f"""
SELECT {key('payment_id')} AS payment_key, {key('customer_id')} AS customer_key, payment_id, invoice_id, payment_date, payment_method,
  payment_status, collection_action, amount_due, amount_paid, outstanding_balance, days_late, failed_attempts,
  CAST(greatest(failed_attempts, days_late, outstanding_balance) > 0 AS INTEGER) AS payment_friction_count,
  source_raw_id, source_extracted_at, source_generation_id FROM int_payment_clean""",
    ),
    "fact_usage_snapshot": (
        ("int_usage_clean",),
        f"""
SELECT {key('usage_id')} AS usage_key, {key('customer_id')} AS customer_key, {day_key('usage_date')} AS usage_date_key, usage_id,
  data_download_gb, data_upload_gb, voice_minutes, sms_count, streaming_hours, total_session_count, avg_session_minutes,
  international_minutes, peak_usage_gb, offpeak_usage_gb, 1 AS usage_snapshot_count, dq_nonnegative_metrics, usage_dq_status,
  source_raw_id, source_extracted_at, source_generation_id FROM int_usage_clean""",
    ),
    "fact_network_event": (
        ("int_network_clean", "int_customer_clean"),
        f"""
SELECT {key('event_id')} AS network_event_key, {key('customer_id')} AS customer_key, {key('region')} AS region_key,
  {key('network_node')} AS network_node_key, {day_key('event_timestamp')} AS event_date_key, event_id, device_id, event_timestamp,
  event_type_norm, technology_norm, latency_ms, jitter_ms, packet_loss_pct, download_mbps, upload_mbps, signal_strength_dbm,
  outage_duration_seconds, connection_dropped_bool, CAST(connection_dropped_bool AS INTEGER) AS connection_drop_count,
  1 AS network_event_count, network_dq_status, source_is_deleted, 'PRE_OUTCOME_FEATURE' AS ml_field_class,
  source_raw_id, source_extracted_at, source_generation_id
FROM int_network_clean LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c USING (customer_id)""",
    ),
    "fact_support_ticket": (
        ("int_support_clean", "int_customer_clean"),
        f"""
SELECT {key('ticket_id')} AS support_ticket_key, {key('customer_id')} AS customer_key, {key('region')} AS region_key,
  {key('agent_team')} AS agent_team_key, {day_key('created_timestamp')} AS created_date_key, ticket_id, contact_id,
  created_timestamp, resolved_timestamp, status, channel, category, priority, reason, classification, reopened, interaction_count,
  resolution_minutes_num, satisfaction_score, first_contact_resolution,
  CAST(first_contact_resolution AS INTEGER) AS first_contact_resolution_count, CAST(reopened AS INTEGER) AS reopened_count,
  1 AS ticket_count, satisfaction_dq_status, dq_valid_resolution_minutes, source_is_deleted,
  'PRE_OUTCOME_FEATURE' AS ml_field_class, source_raw_id, source_extracted_at, source_generation_id
FROM int_support_clean LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c USING (customer_id)""",
    ),
    "fact_marketing_interaction": (
        ("int_marketing_clean", "int_customer_clean"),
        f"""
SELECT {key('interaction_id')} AS marketing_interaction_key, {key('customer_id')} AS customer_key, {key('region')} AS region_key,
  if(campaign_id IS NULL, NULL, {key('campaign_id')}) AS campaign_key, {day_key('contact_date_parsed')} AS contact_date_key,
  interaction_id, contact_date_parsed, response_date_parsed, channel_norm, offer_type_norm, accepted_bool, upgrade_offered,
  equipment_upgrade, discount_pct_num, free_months_num, campaign_cost_num, estimated_customer_value_num, retained_30d, retained_60d,
  retained_90d, retention_reason, CAST(accepted_bool AS INTEGER) AS accepted_count, 1 AS contact_count, dq_valid_discount,
  dq_valid_response_date, has_post_outcome_data, source_raw_id, source_extracted_at, source_generation_id
FROM int_marketing_clean LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c USING (customer_id)""",
    ),
    "fact_churn_event": (
        ("int_churn_clean", "int_customer_clean"),
        f"""
SELECT {key('customer_id', 'churn_date')} AS churn_event_key, {key('customer_id')} AS customer_key, {key('region')} AS region_key,
  {day_key('churn_date')} AS churn_date_key, customer_id, tenure_months_at_end, 1 AS churn_event_count, churn_reason,
  customer_status, churned_field_class, churn_detail_field_class, source_raw_id, source_extracted_at, source_generation_id
FROM int_churn_clean LEFT JOIN (SELECT customer_id, region FROM int_customer_clean) c USING (customer_id)""",
    ),
    "fact_subscription_event": (
        ("int_subscription_clean",),
        f"""
SELECT {key('subscription_id', 'contract_start_date')} AS subscription_event_key, {key('subscription_id')} AS subscription_key,
  {key('customer_id')} AS customer_key, {key('plan_name', 'plan_tier')} AS plan_key, {day_key('contract_start_date')} AS start_date_key,
  subscription_id, status, contract_type, base_monthly_price, CAST(plan_change_date IS NOT NULL AS INTEGER) AS plan_change_count,
  1 AS subscription_event_count, dq_valid_contract_dates, dq_valid_plan_change_date, source_raw_id, source_extracted_at,
  source_generation_id FROM int_subscription_clean""",
    ),
    "fact_macro_monthly": (
        ("int_macro_clean",),
        f"""
SELECT {key('year_month')} AS macro_month_key, {day_key('month_start')} AS month_date_key, year_month, ipc_index, desempleo_pct,
  inflacion_mensual, tipo_cambio_bob_usd, shock_tarifa, dq_valid_year_month, source_raw_id, source_extracted_at, source_generation_id
FROM int_macro_clean""",
    ),
    "fact_retention_target_monthly": (
        ("int_retention_target_clean",),
        f"""
SELECT {key('target_id')} AS retention_target_key, {key('region')} AS region_key, {day_key('month_start')} AS month_date_key, target_id,
  year_month, arpu_target_bob_num, active_base_target_num, retention_budget_bob_num, churn_rate_target_pct_num,
  retained_customers_target_num, responsable_comercial, ultima_actualizacion_ts, comentario, dq_valid_year_month,
  arpu_target_dq_status, churn_target_dq_status, source_raw_id, source_extracted_at, source_generation_id
FROM int_retention_target_clean""",
    ),
    "fact_customer_month_snapshot": (
        ("int_subscription_clean",),
        f"""
WITH months AS (
  SELECT CAST(m AS DATE) AS month_start
  FROM generate_series(DATE '2015-01-01', least(DATE '2034-12-31', {TODAY} + INTERVAL 2 YEAR), INTERVAL 1 MONTH) g(m)),
newest AS (
  SELECT DISTINCT ON (customer_id, month_start) * FROM int_subscription_clean JOIN months
    ON month_start BETWEEN date_trunc('month', contract_start_date) AND date_trunc('month', coalesce(contract_end_date, {TODAY}))
  ORDER BY customer_id, month_start, contract_start_date DESC, subscription_id DESC)
SELECT {key('customer_id', 'month_start')} AS customer_month_key, {key('customer_id')} AS customer_key,
  {key('subscription_id')} AS subscription_key, {key('plan_name', 'plan_tier')} AS plan_key, {day_key('month_start')} AS month_date_key,
  strftime(month_start, '%Y-%m') AS year_month, month_start, last_day(month_start) AS month_end, contract_type, base_monthly_price,
  CAST(greatest(datediff('month', contract_start_date, last_day(month_start)), 0) AS INTEGER) AS tenure_months_at_month_end,
  CAST(status = 'ACTIVE' AND coalesce(contract_end_date > last_day(month_start), true) AS INTEGER) AS active_at_month_end_count
FROM newest""",
    ),
    "mart_r1_churn_early": (
        ("int_r1_early_churn",),
        f"""
SELECT region, customer_segment, count(DISTINCT customer_id) AS customers_first_12_months, CAST(sum(churned) AS BIGINT) AS churned_customers,
  {percentage('sum(churned)', 'count(DISTINCT customer_id)')} AS churn_rate_pct, avg(tenure_months_at_end) AS avg_tenure_months
FROM int_r1_early_churn GROUP BY ALL""",
    ),
    "mart_r2_contract_opportunity": (
        ("int_r2_contract_opportunity",),
        """
SELECT *, coalesce(map(['HIGH', 'MEDIUM', 'LOW'], ['OFFER_TWO_YEAR', 'OFFER_ONE_YEAR', 'NURTURE'])[migration_priority], 'EXCLUDE')
  AS recommended_action FROM int_r2_contract_opportunity""",
    ),
    "mart_r3_friction": (
        ("int_r3_friction_monthly",),
        """
SELECT *, CAST(CAST(billing_amount_change > 0 AS INTEGER) + CAST(failed_payment_attempts > 0 AS INTEGER)
  + CAST(dropped_connections + outage_seconds > 0 AS INTEGER) + CAST(ticket_count > 0 AS INTEGER) AS INTEGER) AS friction_score
FROM int_r3_friction_monthly""",
    ),
    "mart_r4_campaigns": (
        ("int_r4_campaign_effectiveness",),
        f"""
SELECT year_month, region, campaign_id, campaign_name, channel, offer_type, count(*) AS contacts,
  count(*) FILTER (accepted) AS accepted_offers, count(*) FILTER (retained_30d) AS retained_30d,
  count(*) FILTER (retained_60d) AS retained_60d, count(*) FILTER (retained_90d) AS retained_90d,
  {percentage('count(*) FILTER (accepted)', 'count(*)')} AS acceptance_rate_pct,
  {percentage('count(*) FILTER (retained_90d)', 'count(*) FILTER (accepted)')} AS retention_90d_pct,
  sum(campaign_cost) AS campaign_cost, sum(estimated_net_value) AS estimated_net_value
FROM int_r4_campaign_effectiveness GROUP BY year_month, region, campaign_id, campaign_name, channel, offer_type""",
    ),
    "mart_r5_crispdm_dataset": (("int_r5_ml_features",), "SELECT * FROM int_r5_ml_features"),
    "order_item": (
        (),
        """
SELECT l_partkey AS part_key, l_linenumber AS line_number, l_extendedprice AS extended_price, o_orderkey AS order_key,
  o_custkey AS customer_key, o_orderdate AS order_date,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) * -1 AS DECIMAL(16,2)) AS item_discount_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
}
