"""Stand-in raw tables, derived from a star schema of orders and events.

Real raw tables of the churn domain are not public, so tests, the benchmark and
the registered queries make them from ``customer``, ``orders``, ``lineitem`` and
``events``, with the kinds of dirt the silver models repair. Each text runs
unchanged in Spark and in other engines; ``{...}`` names an input table, and
``{version}`` stands for a column ``v`` with one row per extracted version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# The day the stand-in tables are built around.
AS_OF = dt.date(2024, 2, 1)

BASE_TABLES = ("customer", "nation", "region", "orders", "lineitem", "events")

STATEMENTS: dict[str, str] = {
    "crm_customers": """
select case when v=1 then ' C'||cast(c_custkey as string)||' ' else 'C'||cast(c_custkey as string) end as customer_id,
 case when c_custkey%17=0 then null else '+591'||cast(70000000+c_custkey as string) end as msisdn,
 cast(case when c_custkey%23=0 then 999 else 16+c_custkey%70 end as int) as age,
 case c_custkey%7 when 0 then 'M' when 1 then ' masculino' when 2 then 'FEMALE' when 3 then 'mujer ' when 4 then 'nb' when 5 then '' end as gender,
 case when c_custkey%5=0 then '' else lower(n_name)||' city' end as city,
 case c_custkey%3 when 0 then lower(r_name) when 1 then ' '||r_name||' ' else r_name end as region,
 case when c_custkey%4=0 then ' ' else 'z'||cast(c_custkey%100 as string) end as postal_code,
 case c_custkey%6 when 0 then 'casada' when 1 then 'SINGLE' when 2 then ' divorciado ' when 3 then 'viuda' when 4 then 'n/a' end as marital_status,
 cast(c_custkey%2 as int) as senior_citizen, lower(c_mktsegment) as customer_segment,
 case when c_custkey%41=0 then date '2030-01-01' when c_custkey%43=0 then null else date '2024-02-01' - cast((c_custkey*37)%2500 as int) end as registration_date,
 cast(c_custkey%2 as int) as dependents, cast(case when c_custkey%11=0 then -1 when c_custkey%13=0 then null else c_custkey%4 end as int) as number_of_dependents,
 case when c_acctbal<0 then null when c_acctbal<5000 then 'low' else 'high' end as estimated_income_band,
 timestamp '2024-01-31 00:00:00' - interval 1 day * v as _airbyte_extracted_at, cast(2-v as bigint) as _airbyte_generation_id
from (select c.*, {version:c_custkey} from {customer} c) c join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey""",
    "subscriptions_contracts": """
select case when k=1 and c_custkey%10=0 then ' S'||cast(c_custkey as string)||'-1' else 'S'||cast(c_custkey as string)||'-'||cast(k as string) end as subscription_id,
 'C'||cast(c_custkey as string) as customer_id, case (c_custkey+k)%5 when 0 then 'activo' when 1 then 'ACTIVE ' when 2 then 'baja' when 3 then 'replaced' end as status,
 'plan '||cast(c_custkey%9 as string) as plan_name, case c_custkey%3 when 0 then 'gold' when 1 then 'silver' else '' end as plan_tier,
 case (c_custkey+k)%5 when 0 then 'mensual' when 1 then 'Month-to-month' when 2 then 'one year' when 3 then '2 year' else 'weekly' end as contract_type,
 case when c_custkey%47=0 then date '2030-06-01' else date '2024-02-01' - cast((c_custkey*(k+7))%900 as int) end as contract_start_date,
 case when c_custkey%4=0 then date '2024-02-01' - cast(c_custkey%700 as int) when c_custkey%4=1 then date '2024-06-01' end as contract_end_date,
 case when c_custkey%6=0 then date '2023-06-01' + cast(c_custkey%300 as int) end as plan_change_date, case when c_custkey%12=0 then 'plan old' else '' end as previous_plan,
 cast(case when c_custkey%37=0 then -5 when c_custkey%38=0 then null else 20+c_custkey%60 end as decimal(18,2)) as base_monthly_price,
 cast(c_custkey%2 as int) as phone_service, cast(null as int) as multiple_lines, cast((c_custkey+1)%2 as int) as internet_service, cast(c_custkey%3 as int) as online_security, cast(0 as int) as online_backup, cast(1 as int) as device_protection,
 cast(c_custkey%2 as int) as tech_support, cast(c_custkey%2 as int) as streaming_tv, cast(1 as int) as streaming_movies, cast(c_custkey%4 as int) as paperless_billing,
 timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from (select c.*, {contract} from {customer} c) c""",
    "billing_invoices": """
select case when v=1 then ' I'||cast(o_orderkey as string) else 'I'||cast(o_orderkey as string) end as invoice_id,
 'C'||cast(o_custkey as string) as customer_id, 'S'||cast(o_custkey as string)||'-'||cast(o_orderkey%2 as string) as subscription_id, 'A'||cast(o_custkey as string) as account_id,
 cast(o_orderdate as date) + 8200 + case when o_orderkey%97=0 then 400 else 0 end as issue_date,
 cast(o_orderdate as date) + 8200 + case when o_orderkey%19=0 then -5 else 30 end as due_date,
 case o_orderkey%4 when 0 then '' when 1 then ' usd' else 'BOB' end as currency, case o_orderstatus when 'F' then 'paid' when 'O' then ' open ' else null end as invoice_status,
 cast(cast(o_totalprice as decimal(18,2))*0.001 as decimal(18,2)) as base_charge, cast(10 as decimal(18,2)) as service_charge, cast(case when o_orderkey%9=0 then -4 else 4 end as decimal(18,2)) as equipment_charge,
 cast(null as decimal(18,2)) as extra_usage_charge, cast(o_orderkey%6 as decimal(18,2)) as discount, cast(3 as decimal(18,2)) as tax,
 case when o_orderkey%29=0 then null when o_orderkey%31=0 then cast(-20 as decimal(18,2)) when o_orderkey%7=0 then cast(cast(o_totalprice as decimal(18,2))*0.001 as decimal(18,2)) else cast(cast(cast(o_totalprice as decimal(18,2))*0.001 as decimal(18,2)) + 17 + case when o_orderkey%9=0 then -4 else 0 end - o_orderkey%6 as decimal(18,2)) end as total_amount,
 cast(o_orderkey%50 as decimal(18,2)) as previous_month_amount, cast(case when o_orderkey%5=0 then null else o_orderkey%9-4 end as decimal(18,2)) as amount_change, cast(null as decimal(18,4)) as amount_change_pct,
 timestamp '2024-01-31 00:00:00' - interval 1 day * v as _airbyte_extracted_at, cast(2-v as bigint) as _airbyte_generation_id
from (select o.*, {version:o_orderkey} from {orders} o) o""",
    "payments": """
select 'P'||cast(o_orderkey as string) as payment_id, case when o_orderkey%13=0 then 'I-missing' else 'I'||cast(o_orderkey as string) end as invoice_id, 'C'||cast(o_custkey as string) as customer_id,
 case when o_orderkey%61=0 then null when o_orderkey%67=0 then date '2030-01-01' else cast(o_orderdate as date) + 8215 end as payment_date,
 case o_orderkey%3 when 0 then ' card' when 1 then 'CASH' end as payment_method, case o_orderkey%6 when 0 then 'paid' when 1 then 'declined' when 2 then 'PARTIAL' when 3 then 'processing' when 4 then 'Completed ' end as payment_status,
 cast(case when o_orderkey%101=0 then -1 else o_orderkey%200 end as decimal(18,2)) as amount_due, cast(o_orderkey%180 as decimal(18,2)) as amount_paid, cast(case when o_orderkey%5=0 then -3 else o_orderkey%40 end as decimal(18,2)) as outstanding_balance,
 cast(case when o_orderkey%8=0 then o_orderkey%45-5 end as int) as days_late, cast(o_orderkey%4-1 as int) as failed_attempts, case when o_orderkey%9=0 then 'sms' else '' end as collection_action,
 timestamp '2024-01-31 00:00:00' - interval 1 day * cast(o_orderkey%30 as int) as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {orders}""",
    "service_usage": """
select 'U'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string) as usage_id, 'C'||cast(o_custkey as string) as customer_id, cast(l_shipdate as date) + 8090 as usage_date, cast(l_quantity as int)-5 as sms_count,
 cast(cast(l_extendedprice as decimal(18,2))*0.01 as decimal(18,4)) as voice_minutes, cast(cast(l_tax as decimal(18,2))*100 as decimal(18,4)) as international_minutes, cast(cast(l_discount as decimal(18,2))*50-1 as decimal(18,4)) as data_upload_gb, cast(cast(l_quantity as decimal(18,2)) as decimal(18,4)) as data_download_gb,
 cast(cast(l_quantity as decimal(18,2))*0.6 as decimal(18,4)) as peak_usage_gb, cast(cast(l_quantity as decimal(18,2))*case when l_returnflag='N' then 0.4 else 0.1 end as decimal(18,4)) as offpeak_usage_gb, cast(cast(l_quantity as decimal(18,2))*0.6-3 as decimal(18,4)) as streaming_hours,
 cast(cast(l_quantity as decimal(18,2))*40 as decimal(18,4)) as avg_session_minutes, cast(l_quantity as int)%7 as total_session_count,
 timestamp '2024-01-31 00:00:00' - interval 1 day * cast(l_suppkey%30 as int) as _airbyte_extracted_at, l_partkey*1000000 + l_suppkey*1000 + cast(l_quantity as int) as _airbyte_generation_id
from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "network_quality": """
select 'E'||cast(event_id as string) as event_id, ' C'||cast(user_id as string) as customer_id, 'R'||cast(user_id as string) as customer_ref, 'D'||cast(user_id%20 as string) as device_id,
 case when event_id%53=0 then 'N/A' when event_id%59=0 then '2031-01-01 00:00:00' else substr(cast(ts as string),1,19) end as timestamp, event_type, case when event_id%3=0 then '5g' else ' 4G' end as technology,
 'node-'||cast(user_id%12 as string) as network_node, cast(cast(value as decimal(18,2))*30-40 as decimal(18,2)) as latency_ms, cast(value as decimal(18,2)) as jitter_ms, cast(cast(value as decimal(18,2))*0.3-1 as decimal(18,4)) as packet_loss_pct,
 cast(case when event_id%8=0 then null else -60-event_id%110 end as decimal(18,2)) as signal_strength_dbm, cast(value as decimal(18,2)) as download_mbps, cast(cast(value as decimal(18,2))*0.25 as decimal(18,2)) as upload_mbps,
 cast(case when event_id%15=0 then event_id%600-30 else 0 end as decimal(18,2)) as outage_duration_seconds, case event_id%6 when 0 then 'true' when 1 then 'N/A' when 2 then null else 'false' end as connection_dropped,
 case when event_id%71=0 then '2024-01-30' end as _ab_cdc_deleted_at, timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {events} where event_type in ('error','view')""",
    "support_tickets": """
select 'T'||cast(event_id as string) as ticket_id, 'C'||cast(user_id as string) as customer_id, case event_id%6 when 0 then 'cerrado' when 1 then 'RESOLVED' when 2 then 'abierto ' when 3 then 'pending' when 4 then 'closed' end as status,
 case event_id%3 when 0 then 'phone' when 1 then ' chat' else '' end as channel, case event_id%6 when 0 then 'billing' when 1 then 'network' when 2 then 'tech' when 3 then 'cancel' when 4 then 'outage' end as category,
 case event_id%5 when 0 then 'no signal' when 1 then 'payment' when 2 then 'churn risk' when 3 then '' end as reason, case event_id%4 when 0 then 'critical' when 1 then 'HIGH' when 2 then 'low' end as priority, case event_id%4 when 0 then 'team a' when 1 then 'TEAM A ' when 2 then 'team b' end as agent_team,
 case when event_id%53=0 then '' else substr(cast(ts as string),1,19) end as created_at, case when event_id%7=0 then '2023-12-01 00:00:00' when event_id%5=0 then null else '2024-02-01 00:00:00' end as resolved_at,
 case event_id%3 when 0 then 'true' when 1 then 'no' end as reopened, case event_id%2 when 0 then 'yes' else 'x' end as first_contact_resolution, case event_id%4 when 0 then null when 1 then '-15' else cast(event_id%2000 as string) end as resolution_minutes,
 cast(event_id%6-1 as int) as interaction_count, cast(case when event_id%9=0 then null else event_id%8-1 end as decimal(18,2)) as satisfaction_score, case when event_id%71=0 then '2024-01-30' end as _ab_cdc_deleted_at,
 timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {events} where event_type='click'""",
    "marketing_retention": """
select 'M'||cast(event_id as string) as interaction_id, 'C'||cast(user_id as string) as customer_id, case when event_id%10=0 then '' else 'K'||cast(event_id%6 as string) end as campaign_id, 'summer promo '||cast(event_id%6 as string) as campaign_name,
 case event_id%3 when 0 then 'sms' when 1 then ' EMAIL' end as channel, case event_id%2 when 0 then 'discount' else '' end as offer_type, cast(ts as date) as contact_date, case when event_id%4=0 then cast(ts as date) - 3 when event_id%4=1 then cast(ts as date) + 2 end as response_date,
 case event_id%3 when 0 then true when 1 then false end as accepted, event_id%4=0 as retained_30d, event_id%5=0 as retained_60d, event_id%6=0 as retained_90d, event_id%2=0 as upgrade_offered, cast(null as boolean) as equipment_upgrade,
 cast(event_id%130-10 as decimal(18,4)) as discount_pct, cast(event_id%30 as int) as free_months, cast(case when event_id%7=0 then 0 else event_id%40 end as decimal(18,2)) as campaign_cost, cast(value as decimal(18,2)) as estimated_customer_value,
 case when event_id%8=0 then 'price match' else '' end as retention_reason, timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {events} where event_type in ('purchase','signup')""",
    "churn_labels": """
select 'C'||cast(c_custkey as string) as customer_id, cast(case when c_custkey%25=0 then 2 when c_custkey%3=0 then 1 else 0 end as int) as churned,
 case when c_custkey%3=0 then date '2024-02-01' - cast((c_custkey*13)%400 as int) + case when c_custkey%33=0 then 500 else 0 end end as churn_date,
 case c_custkey%8 when 0 then 'Too expensive!' when 1 then 'bad signal' when 2 then 'support delay' when 3 then 'Competitor offer' when 4 then 'relocated' when 5 then '' else 'other stuff' end as churn_reason,
 'churned' as customer_status, cast(case when c_custkey%9=0 then null else c_custkey%30-3 end as int) as tenure_months_at_end,
 timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {customer}""",
    "macro_monthly": """
select distinct case when o_orderkey%97=0 then '2024-13' else substr(cast(cast(o_orderdate as date) + 8200 as string),1,7) end as year_month, cast(100+year(o_orderdate)-1995 as decimal(18,4)) as ipc_index, cast(case when month(o_orderdate)=3 then 140 else month(o_orderdate) end as decimal(18,4)) as desempleo_pct,
 cast(0.5 as decimal(18,4)) as inflacion_mensual, cast(case when month(o_orderdate)=7 then null else 6.96 end as decimal(18,6)) as tipo_cambio_bob_usd, cast(month(o_orderdate)%2 as int) as shock_tarifa,
 timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(year(o_orderdate)*100+month(o_orderdate) as bigint) as _airbyte_generation_id
from {orders}""",
    "metas_retencion_region_mes": """
select 'G'||cast(c_custkey as string) as target_id, lower(r_name) as region, case when c_custkey%9=0 then '2024-1' else '2023-'||lpad(cast(1+c_custkey%12 as string),2,'0') end as year_month, case when c_custkey%7=0 then 'N/A' when c_custkey%10=3 then '-12.5' else 'BOB '||cast(c_custkey*10 as string)||'.50' end as arpu_target_bob,
 cast(c_custkey*100 as string) as active_base_target, '1,'||lpad(cast(c_custkey%1000 as string),3,'0')||' BOB' as retention_budget_bob, case when c_custkey%5=0 then '150%' else '2.5%' end as churn_rate_target_pct, case when c_custkey%4=0 then '99999999' else cast(c_custkey*90 as string) end as retained_customers_target,
 case when c_custkey%3=0 then '' else 'ana' end as responsable_comercial, ' ok ' as comentario, case when c_custkey%6=0 then 'bad' else '2024-01-15 10:00:00' end as ultima_actualizacion,
 timestamp '2024-01-31 00:00:00' as _airbyte_extracted_at, cast(1 as bigint) as _airbyte_generation_id
from {customer} join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey""",
    "xref_customer_id": """
select case when c_custkey%30=0 then '' else ' A'||cast(c_custkey as string) end as account_id, 'C'||cast(c_custkey as string) as customer_id, 'crm' as source_crm, ' billing' as source_billing,
 timestamp '2024-01-31 00:00:00' - interval 1 day * v as _airbyte_extracted_at, cast(2-v as bigint) as _airbyte_generation_id
from (select c.*, {version:c_custkey} from {customer} c) c""",
}


class Repeat(str):
    """Format field for a column that repeats rows: 0 and, for some ids, 1."""

    def __format__(self, id_column: str) -> str:
        return str.format(self, id=id_column)


SPARK_REPEATS = {
    # Every tenth record also has an older version; every customer has two contracts.
    "version": Repeat("explode(sequence(0, case when {id}%10=0 then 1 else 0 end)) as v"),
    "contract": Repeat("explode(sequence(0, 1)) as k"),
}


def statement(source: str, tables: dict[str, str], repeats: dict[str, Repeat]) -> str:
    """The text of a source with the given table names."""
    return STATEMENTS[source].format(**tables, **repeats)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, source: str, sf_dir: str) -> DataFrame:
    """A raw table from the base tables its text names; no other is opened."""
    text = statement(source, {name: f"{{{name}}}" for name in BASE_TABLES}, SPARK_REPEATS)
    used = {name: base_table(spark, sf_dir, name) for name in BASE_TABLES if f"{{{name}}}" in text}
    return spark.sql(text, **used)
