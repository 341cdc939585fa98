"""The eight source views of the fixture mapping, as DuckDB SQL CTEs."""

from __future__ import annotations

from sql_oracle import params as P


def d(value) -> str:
    return f"DATE '{value.isoformat()}'"


SUPPLIER_REGION = """
    SELECT s.s_suppkey, r.r_name
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

VEHICLE = """CASE l.l_linenumber % 7 WHEN 0 THEN NULL WHEN 1 THEN 'ATV' WHEN 2 THEN 'Motorcycle'
                 WHEN 3 THEN 'RV' ELSE 'Other' END"""

# dealers of this kind have no business before the start date
EARLY = f"(l.l_suppkey % 10 = 3 AND CAST(l.l_shipdate AS DATE) < {d(P.NEWCOMER_START)})"

VIEWS: dict[str, str] = {
    "fact_funded": f"""
    SELECT l.l_suppkey AS dealership_id,
           CAST(l.l_shipdate AS DATE) AS funding_pending_date,
           CASE WHEN l.l_returnflag = 'R' OR {EARLY} THEN 'No' ELSE 'Yes' END AS is_funded,
           CAST(1 AS BIGINT) AS "count",
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_financed,
           {VEHICLE} AS vehicle_type,
           sr.r_name AS rsm_territory_regions__c
    FROM lineitem l LEFT JOIN ({SUPPLIER_REGION}) sr ON l.l_suppkey = sr.s_suppkey""",
    "fact_apps": f"""
    SELECT l.l_suppkey AS dealership_id,
           CAST(l.l_shipdate AS DATE) AS submitted_at,
           CASE WHEN l.l_quantity >= 2 AND l.l_quantity < 4
                     AND CAST(l.l_shipdate AS DATE) >= {d(P.FLEX_LAUNCH)}
                THEN 'direct_to_consumer_flex' ELSE 'dealer_portal' END AS source_client,
           {VEHICLE} AS vehicle_type,
           CASE WHEN (l.l_quantity < 2 OR l.l_suppkey % 10 = 3 AND l.l_quantity < 25) AND NOT {EARLY}
                THEN CASE WHEN l.l_linestatus = 'O' THEN 'Dealer' ELSE 'lightspeed' END
                ELSE 'Consumer' END AS app_type,
           sr.r_name AS rsm_territory_regions__c
    FROM lineitem l LEFT JOIN ({SUPPLIER_REGION}) sr ON l.l_suppkey = sr.s_suppkey""",
    "dim_account": f"""
    SELECT s.s_suppkey AS dealership_id__c,
           s.s_name AS name,
           'Powersports' AS vertical_type__c,
           'Active' AS status__c,
           CASE s.s_suppkey % 7 WHEN 0 THEN 'A1 - top' WHEN 1 THEN 'A2' WHEN 2 THEN 'A3 core'
                WHEN 3 THEN 'B1' WHEN 4 THEN 'B2 - x' WHEN 5 THEN 'B3' END
               AS powersports_sales_tier__c,
           sr.r_name AS rsm_territory_regions__c,
           CASE WHEN s.s_suppkey % 5 = 0
                THEN DATE '1996-01-10' + CAST((s.s_suppkey * 37 + 20) % 1500 AS INTEGER) END
               AS prequal_integrated_enrolled_date__c,
           CASE WHEN s.s_suppkey % 35 = 0
                THEN DATE '1996-01-10' + CAST((s.s_suppkey * 37 + 20) % 1500 AS INTEGER) + 200 END
               AS prequal_integrated_unenrolled_date__c,
           CASE WHEN s.s_suppkey % 3 <> 0
                THEN CAST(DATE '1997-12-01' + CAST((s.s_suppkey * 11) % 150 AS INTEGER) AS TIMESTAMP) END
               AS enrolled_time_stamp__c,
           CASE WHEN s.s_suppkey % 4 = 0 THEN s.s_suppkey + 1 END AS previous_dealer_id__c
    FROM supplier s JOIN ({SUPPLIER_REGION}) sr ON s.s_suppkey = sr.s_suppkey""",
    "status_monthly": """
    SELECT dealership_id__c, partition_date, full_status,
           LAG(full_status) OVER (PARTITION BY dealership_id__c ORDER BY partition_date)
               AS full_status_prior
    FROM (
        SELECT l_suppkey AS dealership_id__c,
               CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS partition_date,
               CASE WHEN COUNT(*) >= 12 THEN 'MVP' WHEN COUNT(*) >= 9 THEN 'All-Star'
                    WHEN COUNT(*) >= 6 THEN 'Core' ELSE 'Base' END AS full_status
        FROM lineitem GROUP BY 1, 2) m""",
    "region_rep": """
    SELECT r_name AS region, 'RSM' AS team, 'rsm_' || lower(replace(r_name, ' ', '_')) AS sales_name
    FROM region
    UNION ALL
    SELECT r_name, 'BDR', 'bdr_' || lower(replace(r_name, ' ', '_'))
    FROM region WHERE r_regionkey <> 4""",
    "manual_report": f"""
    SELECT CASE WHEN o.o_custkey % 2 = 0 THEN 'rsm_' ELSE 'bdr_' END
               || lower(replace(cr.r_name, ' ', '_')) AS sales_name,
           CASE WHEN o.o_custkey % 2 = 0 THEN 'RSM' ELSE 'BDR' END AS team,
           CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 8 WHEN '2-HIGH' THEN 10 WHEN '3-MEDIUM' THEN 11
                WHEN '4-NOT SPECIFIED' THEN 12 WHEN '5-LOW' THEN 13 END AS INTEGER) AS metric_id,
           CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Referral' WHEN '2-HIGH' THEN 'Demo'
                WHEN '3-MEDIUM' THEN 'Training' WHEN '4-NOT SPECIFIED' THEN 'Visit'
                WHEN '5-LOW' THEN 'Call' END AS metric_name,
           CAST(o.o_orderdate AS DATE) AS "date",
           CAST(CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE 1 END AS BIGINT) AS metric_volume,
           'order ' || CAST(o.o_orderkey AS VARCHAR) AS note
    FROM orders o
    LEFT JOIN (SELECT c.c_custkey, r.r_name FROM customer c
               JOIN nation n ON c.c_nationkey = n.n_nationkey
               JOIN region r ON n.n_regionkey = r.r_regionkey) cr ON o.o_custkey = cr.c_custkey""",
    "bounty": "SELECT CAST(metric_id AS INTEGER) AS metric_id, team, CAST(bounty_per_unit AS BIGINT) AS bounty_per_unit FROM (VALUES "
              + ", ".join(f"({m}, '{t}', {p})" for t, m, p in P.BOUNTY_ROWS)
              + ") v(metric_id, team, bounty_per_unit)",
    "user_hist": """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS partition_date,
           CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS dealership_id,
           CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS TIMESTAMP)
               - to_days(CAST((o_orderkey * 13) % 90 AS INTEGER))
               + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS last_login,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Default' WHEN '2-HIGH' THEN 'ADMINISTRATOR'
                WHEN '3-MEDIUM' THEN 'Finance Manager' ELSE 'Sales Rep' END AS dealer_user_type
    FROM orders""",
}


def with_views(body: str, ctes: str = "") -> str:
    """``WITH <source views>[, <ctes>] <body>``."""
    parts = [f"{name} AS ({sql}\n)" for name, sql in VIEWS.items()]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body
