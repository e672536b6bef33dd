"""SQL for every registered query, run by another engine on the same tables."""

from __future__ import annotations

import re

from ledgerwide import reference_data as ref
from ledgerwide.functions import fiscal
from ledgerwide.functions.status import NO_DATA_COLOUR, RAG_COLOURS
from ledgerwide.plans.peers import SIZE_BANDS
from ledgerwide.sources.derived import CURRENT_YEAR as YEAR
from ledgerwide.sources.derived import YEARS
from verification.queries import EXPECT, RELOAD_SCOPE
from verification.sql_tables import (
    VIEW_KEY,
    billions,
    label_of,
    mean,
    millions,
    pct,
    pct_text,
    plain,
    quoted,
    ratio,
    rmean,
    rnd,
    start_of,
    thousands,
    total,
    with_tables,
)

OY = "org_code, financial_year"
BEFORE = fiscal.shift_label(YEAR, -1)
TAG, TAG_BEFORE = (y[2:4] + y[5:7] for y in (YEAR, BEFORE))
SQL: dict[str, str] = {}


def threshold(default: str | None = "65.0") -> str:
    tail = f"ELSE CAST({default} AS DOUBLE) END" if default else "END"
    return (
        "CASE sector WHEN 'Acute' THEN 65.0::DOUBLE WHEN 'Mental Health' THEN 70.0 "
        f"WHEN 'Community' THEN 70.0 WHEN 'Ambulance' THEN 68.0 WHEN 'Specialist' THEN 60.0 {tail}"
    )


def fiscal_label(date: str) -> str:
    return label_of(f"({start_of(date)})")


def period_no(date: str) -> str:
    return f"((month({date}) + 8) % 12 + 1)"


def share(column: str, places: int = 1) -> str:
    return pct(f"SUM({column})", "SUM(total_income_000s)", places)


def mean_share(column: str, places: int = 1) -> str:
    return rmean(ratio(column, "total_income_000s", "100.0::DOUBLE"), places, 6)


DESCRIBE_YEAR = (
    f"{label_of('y')} AS financial_year, make_date(y, 4, 1) AS start_date, "
    "make_date(y + 1, 3, 31) AS end_date, printf('%02d/%02d', y % 100, (y + 1) % 100) AS year_label_short, "
    "CASE WHEN y <= 2000 THEN 1 ELSE 0 END AS is_complete"
)
YEAR_ROWS = f"SELECT DISTINCT {start_of('l_shipdate')} AS y FROM lineitem"
YEAR_DIM = f"(SELECT {DESCRIBE_YEAR} FROM ({YEAR_ROWS}) ys)"

# --- sources and sinks ---------------------------------------------------------------
IE_COLUMNS = (
    "patient_care_income_000s, other_income_000s, total_income_000s, total_expenditure_000s, "
    "operating_surplus_000s, net_surplus_000s"
)
EXTRACT = """
    SELECT worksheet_name, code AS sub_code,
           trim(regexp_replace(label, '\\s+', ' ', 'g')) AS description, shown_sign AS expected_sign, row_no
    FROM (SELECT replace(worksheet_name, '&amp;', '&') AS worksheet_name, row_no, code,
                 CASE style WHEN 2 THEN '' ELSE
                     CASE WHEN p_size % 5 = 0 THEN ' total  ' || p_name
                          WHEN p_size % 5 = 1 THEN upper(p_type) || ' 12'
                          WHEN p_size % 5 = 2 THEN p_name || ' wte' ELSE p_name END END AS label,
                 sign AS shown_sign,
                 row_number() OVER (PARTITION BY worksheet_name, code ORDER BY row_no) AS nth
          FROM grid WHERE style <> 3 AND worksheet_name NOT IN ('Intro', 'TAC09 Staff')) g
    WHERE nth = 1"""
EXTRACTED = f"""
    SELECT sub_code, worksheet_name, description, expected_sign,
           CASE WHEN upper(description) LIKE '%WTE%' THEN 'No.' ELSE '£000' END AS unit,
           CASE WHEN lower(description) LIKE 'total%' OR
                     (length(regexp_replace(description, '[^A-Za-z]', '', 'g')) > 3
                      AND regexp_replace(description, '[^A-Za-z]', '', 'g')
                        = upper(regexp_replace(description, '[^A-Za-z]', '', 'g')))
                THEN 1 ELSE 0 END AS is_subtotal,
           CAST(NULL AS VARCHAR) AS analytics_category, row_no
    FROM ({EXTRACT}) e"""

_scope = f"financial_year = '{RELOAD_SCOPE[0]}' AND trust_type = '{RELOAD_SCOPE[1]}'"
SQL["S1_discover_files"] = """
    SELECT DISTINCT 'raw/' || source_file AS path FROM raw"""
SQL["S2_read_provider_list"] = "SELECT * FROM providers"
SQL["S3_find_sheet_name"] = "SELECT s_suppkey AS supplier_key, s_name AS supplier_name FROM supplier"
SQL["S4_read_all_data"] = "SELECT * FROM staged"
SQL["S4b_mixed_headers"] = "SELECT *, unnest(['csv', 'parquet']) AS form FROM staged"
SQL["S6b_emptied_scope"] = f"SELECT * FROM staged WHERE NOT ({_scope})"
SQL["S5_sql_scan"] = f"""
    SELECT org_code, main_code, sub_code, total_000s FROM fact
    WHERE financial_year = '{YEAR}' AND trust_type = 'NHS_TRUST'"""
SQL["S6_load_staging"] = f"SELECT * FROM staged WHERE NOT ({_scope}) OR total > 0"
SQL["S7_export_query"] = f"SELECT {VIEW_KEY}, {IE_COLUMNS} FROM ie"

ITEMS = """
    SELECT t.org_code, t.organisation_name, t.sector, t.trust_type, f.financial_year, f.sub_code,
           sc.description AS line_item, sc.analytics_category, f.total_000s AS amount_000s
    FROM fact f JOIN trusts t ON f.org_code = t.org_code JOIN codes sc ON f.sub_code = sc.sub_code
    WHERE f.worksheet_name IN ({sheets}) AND f.main_code NOT LIKE '%PY%' AND sc.is_subtotal = 0"""
INCOME_ITEMS = ITEMS.format(sheets=f"'{ref.INCOME_1}', '{ref.INCOME_2}'")
SPEND_ITEMS = ITEMS.format(sheets=f"'{ref.EXPENDITURE}'")
TRUST_EXPORT = """
    SELECT t.org_code, organisation_name, t.trust_type, sector, region, is_foundation,
           first_year_seen, last_year_seen
    FROM trusts t LEFT JOIN (SELECT org_code, MIN(financial_year) AS first_year_seen,
                                    MAX(financial_year) AS last_year_seen FROM fact GROUP BY org_code) s
         ON t.org_code = s.org_code"""
BENCHMARK_EXPORT = f"""
    SELECT financial_year, sector, trust_type, COUNT(DISTINCT org_code) AS provider_count,
           {rnd('CAST(SUM(total_income_000s) AS DOUBLE) / 1000', 0)} AS total_income_m,
           {rnd('CAST(SUM(total_expenditure_000s) AS DOUBLE) / 1000', 0)} AS total_expenditure_m,
           {rnd('CAST(SUM(operating_surplus_000s) AS DOUBLE) / 1000', 0)} AS total_op_surplus_m,
           {rmean('ebitda_margin_pct')} AS avg_ebitda_margin_pct,
           {rmean('pay_pct_income')} AS avg_pay_pct_income,
           {rmean('net_surplus_margin_pct')} AS avg_net_surplus_margin_pct,
           COUNT(CASE WHEN operating_surplus_000s < 0 THEN 1 END) AS deficit_count,
           COUNT(CASE WHEN operating_surplus_000s >= 0 THEN 1 END) AS surplus_count
    FROM kpis WHERE sector IS NOT NULL GROUP BY financial_year, sector, trust_type"""
SQL["S8_csv_exports"] = f"""
    SELECT 'dim_trust' AS dataset, (SELECT COUNT(*) FROM trusts) AS row_count, 8 AS column_count
    UNION ALL SELECT 'dim_financial_year', (SELECT COUNT(*) FROM {YEAR_DIM} y), 5
    UNION ALL SELECT 'ie_summary', (SELECT COUNT(*) FROM ie), 12
    UNION ALL SELECT 'expenditure_breakdown', (SELECT COUNT(*) FROM ex), 12
    UNION ALL SELECT 'workforce', (SELECT COUNT(*) FROM wf WHERE total_staff_cost_000s IS NOT NULL), 14
    UNION ALL SELECT 'kpis', (SELECT COUNT(*) FROM kpis), 19
    UNION ALL SELECT 'income_detail', (SELECT COUNT(*) FROM ({INCOME_ITEMS}) i), 9
    UNION ALL SELECT 'expenditure_detail', (SELECT COUNT(*) FROM ({SPEND_ITEMS}) i), 9
    UNION ALL SELECT 'profit_and_loss', (SELECT COUNT(*) FROM pl), 33
    UNION ALL SELECT 'balance_sheet', (SELECT COUNT(*) FROM bs), 46
    UNION ALL SELECT 'sector_benchmarks', (SELECT COUNT(*) FROM ({BENCHMARK_EXPORT}) b), 12"""
SQL["S10_build_reference"] = f"""
    SELECT * FROM codes UNION ALL
    SELECT sub_code, worksheet_name, description, expected_sign, unit, is_subtotal, analytics_category
    FROM (SELECT *, row_number() OVER (PARTITION BY sub_code ORDER BY worksheet_name, row_no) AS nth
          FROM ({EXTRACTED}) x WHERE sub_code NOT IN (SELECT sub_code FROM codes)) y WHERE nth = 1"""
SQL["S11_seed_dimensions"] = f"""
    SELECT w.schedule_title, w.category, w.sub_code_prefix, y.year_label_short, y.start_date,
           y.end_date, y.is_complete, COUNT(*) AS fact_rows
    FROM fact f JOIN worksheets w ON f.worksheet_name = w.worksheet_name
    JOIN {YEAR_DIM} y ON f.financial_year = y.financial_year GROUP BY ALL"""

SQL["S11b_stored_codes"] = SQL["S10_build_reference"]
SQL["S11c_stored_years"] = f"""
    SELECT {DESCRIBE_YEAR.replace('CASE WHEN y <= 2000 THEN 1 ELSE 0 END', '1')}
    FROM ({YEAR_ROWS} UNION SELECT unnest(range({ref.FIRST_YEAR}, {ref.LAST_YEAR + 1}))) ys"""

# --- projections and scalar functions ----------------------------------------------------
SQL["P1_financial_year_from_name"] = f"SELECT l_suppkey, fy, {label_of('fy')} AS financial_year FROM base"
SQL["P2_trust_type_from_name"] = """
    SELECT l_suppkey, fy, CASE WHEN l_suppkey % 3 = 0 THEN 'NHS_TRUST' ELSE 'FOUNDATION_TRUST' END AS trust_type
    FROM base"""
SQL["P3_year_type"] = """
    SELECT CASE WHEN contains(main_code, 'PY') THEN 'PY' ELSE 'CY' END AS year_type,
           main_code NOT LIKE '%PY%' AS is_current, COUNT(*) AS n FROM fact GROUP BY 1, 2"""
SQL["P4_clean_and_coerce"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           CASE WHEN l_linenumber = 7 THEN 0 ELSE -CAST(trunc(l_extendedprice) AS BIGINT) END AS amount,
           l_returnflag AS flag FROM lineitem"""
SQL["P5_normalise_sectors"] = """
    SELECT org_code, COALESCE(m.canonical, t.sector) AS sector
    FROM trusts t LEFT JOIN sector_map m ON t.sector = m.spelled"""
SQL["P6_is_large"] = f"""
    SELECT {OY}, CASE WHEN total_income_000s >= 1000000 THEN 1 ELSE 0 END AS is_large FROM card"""
SQL["P7_pay_pressure_flag"] = f"""
    SELECT {OY}, CASE WHEN pay_pct_income > {threshold(None)} THEN 1 ELSE 0 END AS strict_flag,
           CASE WHEN pay_pct_income > {threshold()} THEN 1 ELSE 0 END AS default_flag FROM card"""
SQL["P8_income_mix"] = f"""
    SELECT {OY}, {pct('patient_care_income_000s', 'total_income_000s')} AS patient_income_pct,
           {pct('other_income_000s', 'total_income_000s')} AS other_income_pct FROM card"""
SQL["P9_fiscal_year"] = f"""
    SELECT {DESCRIBE_YEAR} FROM (SELECT DISTINCT {start_of('o_orderdate')} AS y FROM orders) ys"""
SQL["P10_period_and_quarter"] = f"""
    SELECT {fiscal_label('o_orderdate')} AS financial_year, printf('M%02d', {period_no('o_orderdate')}) AS period,
           printf('Q%d', CAST((month(o_orderdate) + 8) % 12 // 3 + 1 AS INT)) AS quarter, COUNT(*) AS n
    FROM orders GROUP BY 1, 2, 3"""
SQL["P11_case_when"] = f"""
    SELECT {OY}, {threshold()} AS threshold, CASE WHEN is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END AS status,
           ebitda_rag, surplus_rag FROM card"""
SQL["P12_null_handling"] = f"""
    SELECT {OY}, COALESCE(patient_care_income_000s, 0) AS patient_or_zero,
           NULLIF(total_income_000s, 0) AS income_or_null, ABS(net_surplus_000s) AS net_size FROM ie"""
SQL["P13_rounding"] = """
    SELECT l_suppkey, l_quantity, COUNT(*) AS n, round(l_quantity / 8, 2) AS half_up,
           round_even(l_quantity / 8, 2) AS half_even FROM lineitem GROUP BY l_suppkey, l_quantity"""
SQL["P14_thousands_text"] = f"""
    SELECT {OY}, {millions('total_income_000s')} AS income_m,
           {millions('operating_surplus_000s', 1)} AS surplus_m, operating_surplus_000s FROM card"""
SIGNED = "CASE WHEN {v} > 0 THEN '+' || {p} || 'pp' ELSE {p} || 'pp' END"
SQL["P15_concatenated_text"] = f"""
    SELECT {OY}, {pct_text('ebitda_margin_pct')} AS margin,
           {SIGNED.format(v='ebitda_margin_yoy_pp', p=plain('ebitda_margin_yoy_pp'))} AS change FROM enriched"""
SQL["P16_whole_numbers"] = f"SELECT {OY}, total_income_000s, net_surplus_000s FROM ie"
SQL["P17_predicates"] = f"""
    SELECT {OY}, main_code, sub_code, total_000s FROM fact
    WHERE worksheet_name IN ('{ref.SOCI}', '{ref.EXPENDITURE}') AND total_000s BETWEEN -1000000 AND 1000000
      AND sub_code LIKE '%0A' AND source_file IS NOT NULL AND length(trim(sub_code)) = 8"""
SQL["P18_unit_rescale"] = f"""
    SELECT {OY}, CAST(total_income_000s AS DOUBLE) / 1e3 AS income_m,
           CAST(total_income_000s AS DOUBLE) / 1e6 AS income_bn FROM card"""
SQL["P19_column_pruning"] = f"""
    SELECT {OY}, total_income_000s, patient_care_income_000s, other_income_000s, total_expenditure_000s,
           operating_surplus_000s, net_surplus_000s, patient_income_pct, other_income_pct FROM enriched"""

# --- joins -----------------------------------------------------------------------------------
SQL["J1_resolve_codes"] = "SELECT * FROM resolved"
SQL["J2_unmatched_names"] = """
    SELECT DISTINCT organisation_name, financial_year, trust_type FROM staged s
    WHERE NOT EXISTS (SELECT 1 FROM providers p WHERE p.organisation_name = s.organisation_name
                      AND p.financial_year = s.financial_year AND p.trust_type = s.trust_type)"""
SQL["J3_fact_with_trust"] = f"""
    SELECT t.region, f.worksheet_name, COUNT(*) AS n, {total('f.total_000s')} AS total_000s
    FROM fact f JOIN trusts t ON f.org_code = t.org_code GROUP BY 1, 2"""
SQL["J4_fact_with_trust_and_code"] = f"""
    SELECT t.sector, sc.analytics_category, sc.is_subtotal, COUNT(*) AS n, {total('f.total_000s')} AS total_000s
    FROM fact f JOIN trusts t ON f.org_code = t.org_code JOIN codes sc ON f.sub_code = sc.sub_code
    GROUP BY 1, 2, 3"""
SQL["J5_kpi_join"] = """
    SELECT ie.org_code, ie.financial_year, ie.total_income_000s, ex.pay_000s, ex.depreciation_amort_000s,
           wf.total_wte
    FROM ie LEFT JOIN ex ON ie.org_code = ex.org_code AND ie.financial_year = ex.financial_year
    LEFT JOIN wf ON ie.org_code = wf.org_code AND ie.financial_year = wf.financial_year"""
SQL["J6_scorecard_lines"] = f"SELECT {OY}, {', '.join(ref.SCORECARD_LINES.values())} FROM card"
SQL["J7_year_pairs"] = f"""
    SELECT a.org_code, a.organisation_name, a.is_deficit, a.ebitda_margin_pct, a.total_income_000s,
           b.ebitda_margin_pct AS ebitda_margin_pct_prior, b.total_income_000s AS total_income_000s_prior
    FROM card a JOIN card b ON a.org_code = b.org_code
     AND a.financial_year = '{YEAR}' AND b.financial_year = '{BEFORE}'"""
SQL["J8_orphan_facts"] = """
    SELECT COUNT(DISTINCT f.org_code) AS orphans FROM fact f LEFT JOIN trusts t ON f.org_code = t.org_code
    WHERE t.org_code IS NULL"""
SQL["J9_missing_worksheets"] = """
    SELECT * FROM worksheets UNION ALL
    SELECT DISTINCT s.worksheet_name, s.worksheet_name, 'OTHER', CAST(NULL AS VARCHAR) FROM staged s
    WHERE s.worksheet_name NOT IN (SELECT worksheet_name FROM worksheets)"""

# --- upserts ------------------------------------------------------------------------------------
SQL["M1_fact_upsert"] = """
    SELECT l.org_code, l.financial_year, l.main_code, l.sub_code, l.worksheet_name, l.table_id, l.trust_type,
           COALESCE(r.total_000s, l.total_000s) AS total_000s, COALESCE(r.source_file, l.source_file) AS source_file
    FROM loaded l LEFT JOIN (
        SELECT org_code, financial_year, main_code, sub_code, 'reload_' || source_file AS source_file,
               total_000s + row_num AS total_000s,
               row_number() OVER (PARTITION BY org_code, financial_year, main_code, sub_code
                                  ORDER BY source_file DESC, row_num DESC) AS nth
        FROM resolved WHERE trust_type = 'NHS_TRUST') r
      ON l.org_code = r.org_code AND l.financial_year = r.financial_year AND l.main_code = r.main_code
     AND l.sub_code = r.sub_code AND r.nth = 1"""
SQL["M2_trust_upsert"] = """
    SELECT org_code,
           CASE WHEN MIN(financial_year) < '1998'
                THEN first(organisation_name ORDER BY financial_year)
                ELSE first(organisation_name ORDER BY financial_year) || ' renamed' END AS organisation_name,
           first(trust_type ORDER BY financial_year) AS trust_type,
           last(sector ORDER BY financial_year) FILTER (sector IS NOT NULL) AS sector,
           last(region ORDER BY financial_year) FILTER (region IS NOT NULL) AS region,
           CASE WHEN first(trust_type ORDER BY financial_year) = 'FOUNDATION_TRUST' THEN 1 ELSE 0 END
               AS is_foundation,
           MIN(financial_year) AS first_year_seen, MAX(financial_year) AS last_year_seen
    FROM providers GROUP BY org_code"""
for key in (
    "M3_reload_is_idempotent", "M4_load_files_twice", "M5_stream_load", "M6_stream_late_providers", "M7_load_mixed_headers",
):
    SQL[key] = "SELECT * FROM loaded"
SQL["M8_refused_load"] = f"""
    SELECT 'staged' AS name, COUNT(*) AS n, {total('total')} AS total_000s FROM staged
    UNION ALL SELECT 'fact', COUNT(*), {total('total_000s')} FROM loaded"""
SQL["M9_quarantine"] = """
    SELECT s.* FROM staged s WHERE s.trust_type <> 'NHS_TRUST' OR NOT EXISTS (
        SELECT 1 FROM providers p WHERE lower(p.organisation_name) = lower(s.organisation_name)
        AND p.financial_year = s.financial_year AND p.trust_type = s.trust_type)"""
SQL["M10_changed_rows"] = """
    SELECT main_code, COUNT(*) AS n, main_code LIKE '%01' AS rewritten FROM loaded GROUP BY main_code"""

# --- views ------------------------------------------------------------------------------------------
def _stored_line(code: str) -> str:
    return f"MAX(CASE WHEN sub_code = '{code}' THEN total_000s END)"


_patient, _other, _spent = (_stored_line(c) for c in ("SCI0100A", "SCI0110A", "SCI0125A"))
SQL["V9_stored_views"] = f"""
    SELECT org_code, financial_year, {_patient} AS patient_care_income_000s, {_other} AS other_income_000s,
           COALESCE({_patient}, 0) + COALESCE({_other}, 0) AS total_income_000s,
           ABS(COALESCE({_spent}, 0)) AS total_expenditure_000s,
           {_stored_line('SCI0140A')} AS operating_surplus_000s, {_stored_line('SCI0240')} AS net_surplus_000s
    FROM loaded WHERE worksheet_name = '{ref.SOCI}' GROUP BY org_code, financial_year"""
for key, name in {
    "V1_income_expenditure": "ie",
    "V2_profit_and_loss": "pl",
    "V3_expenditure_breakdown": "ex",
    "V4_workforce": "wf",
    "V5_balance_sheet": "bs",
    "V6_kpis": "kpis",
    "V7_annual_scorecard": "card",
}.items():
    SQL[key] = f"SELECT * FROM {name}"
SQL["V8_strict_income_variant"] = f"""
    SELECT {VIEW_KEY}, patient AS patient_care_income_000s, other AS other_income_000s,
           patient + COALESCE(other, 0) AS total_income_000s, ABS(spent) AS total_expenditure_000s,
           operating_surplus_000s, net_surplus_000s FROM ie0"""

# --- aggregations -------------------------------------------------------------------------------------
SQL["A1_basic_aggregates"] = f"""
    SELECT sector, region, {total('total_income_000s')} AS sum_income, {mean('ebitda_margin_pct')} AS avg_margin,
           MIN(total_income_000s) AS min_income, MAX(total_income_000s) AS max_income, COUNT(*) AS n
    FROM card GROUP BY 1, 2"""
SQL["A2_distinct_counts"] = """
    SELECT financial_year, COUNT(DISTINCT org_code || '|' || main_code || '|' || sub_code) AS distinct_keys
    FROM fact GROUP BY 1"""
SQL["A3_conditional_aggregates"] = f"""
    SELECT financial_year, COUNT(CASE WHEN operating_surplus_000s < 0 THEN 1 END) AS deficits,
           COUNT(CASE WHEN operating_surplus_000s >= 0 THEN 1 END) AS surpluses,
           {total('CASE WHEN operating_surplus_000s < 0 THEN operating_surplus_000s END')} AS deficit_000s
    FROM ie GROUP BY 1"""
BY_YEAR = {y: total(f"CASE WHEN financial_year = '{y}' THEN total_income_000s END") for y in YEARS}
SQL["A4_year_pivot"] = (
    "SELECT region, "
    + ", ".join(f"{sql} AS y{y[:4]}" for y, sql in BY_YEAR.items())
    + " FROM card GROUP BY region"
)
SQL["A5_weighted_and_mean_ratios"] = f"""
    SELECT financial_year, trust_type, {share('pay_000s', 2)} AS weighted_pct,
           {mean_share('pay_000s', 2)} AS mean_pct FROM card GROUP BY 1, 2"""
SQL["A6_repeated_keys"] = """
    SELECT org_code, financial_year, main_code, sub_code, COUNT(*) AS copies FROM resolved
    GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1"""
SQL["A7_sector_benchmarks"] = f"""
    SELECT financial_year, sector, COUNT(DISTINCT org_code) AS providers,
           {total('total_income_000s')} AS total_income_000s,
           {total('total_expenditure_000s')} AS total_expenditure_000s,
           COALESCE({total('operating_surplus_000s')}, 0) AS total_surplus_000s,
           COALESCE({total('pay_000s')}, 0) AS total_pay_000s, COALESCE({total('total_wte')}, 0) AS total_wte,
           {rmean('ebitda_margin_pct')} AS avg_ebitda_margin_pct,
           round(quantile_cont(CAST(round(ebitda_margin_pct * 10) AS BIGINT), 0.5)) / 10 + 0.0 AS median_ebitda_pct,
           {rmean('pay_pct_income')} AS avg_pay_pct_income,
           {rmean('cost_per_wte_000s')} AS avg_cost_per_wte_000s,
           {total('is_deficit')} AS deficit_trusts,
           {pct('COALESCE(SUM(pay_000s), 0)', 'SUM(total_income_000s)')} AS sector_pay_pct
    FROM enriched WHERE sector IS NOT NULL GROUP BY financial_year, sector"""
SQL["A7b_median_of_any_spread"] = """
    SELECT financial_year, sector, quantile_cont(total_income_000s, 0.5) AS median_income_000s
    FROM enriched GROUP BY financial_year, sector"""
SQL["A8_benchmark_export"] = BENCHMARK_EXPORT
SQL["A9_global_aggregate"] = f"""
    SELECT COUNT(*) AS fact_rows, {total('total_000s')} AS total_000s, MIN(financial_year) AS first_year,
           MAX(financial_year) AS last_year FROM fact"""
REPEATED = """
    SELECT CAST(COUNT(*) - COUNT(DISTINCT organisation_name || '|' || financial_year || '|' || trust_type || '|'
                || main_code || '|' || sub_code) AS BIGINT) AS {name} FROM staged"""
SQL["A10_repeated_rows"] = REPEATED.format(name="repeated_rows")
SQL["A11_distinct_rows"] = "SELECT DISTINCT worksheet_name, main_code, financial_year FROM staged"

# --- windows, order, limit ----------------------------------------------------------------------------
SQL["W1_income_quartiles"] = f"""
    SELECT {OY}, total_income_000s, CAST(ntile(4) OVER (PARTITION BY financial_year
           ORDER BY total_income_000s, org_code) AS INT) AS income_quartile FROM card"""
SQL["W2_rank_of_top_rows"] = f"""
    SELECT {OY}, net_surplus_margin_pct,
           CAST(rank() OVER (ORDER BY net_surplus_margin_pct NULLS FIRST) AS INT) AS margin_rank
    FROM card ORDER BY net_surplus_margin_pct NULLS FIRST, org_code || financial_year LIMIT 40"""
SQL["W3_previous_row_and_year"] = f"""
    SELECT c.org_code, c.financial_year,
           lag(c.ebitda_margin_pct) OVER (PARTITION BY c.org_code ORDER BY c.financial_year) AS previous_row_pct,
           p.ebitda_margin_pct AS previous_year_pct
    FROM card c
    LEFT JOIN card p ON c.org_code = p.org_code
     AND CAST(substr(c.financial_year, 1, 4) AS INT) = CAST(substr(p.financial_year, 1, 4) AS INT) + 1"""
SQL["W4_year_to_date"] = f"""
    SELECT o_orderpriority, financial_year, period, orders,
           CAST(SUM(orders) OVER (PARTITION BY o_orderpriority, financial_year ORDER BY period) AS BIGINT) AS ytd_orders
    FROM (SELECT o_orderpriority, {fiscal_label('o_orderdate')} AS financial_year,
                 printf('M%02d', {period_no('o_orderdate')}) AS period, COUNT(*) AS orders
          FROM orders GROUP BY 1, 2, 3) m"""
SQL["W5_multi_key_order"] = f"SELECT {OY}, total_income_000s FROM ie"
SQL["W6_top_k"] = f"""
    SELECT {OY}, net_surplus_000s, org_code || financial_year AS row_key FROM ie
    ORDER BY net_surplus_000s NULLS FIRST, row_key LIMIT 25"""

# --- trends ---------------------------------------------------------------------------------------------
SQL["T1_national_trend"] = f"""
    SELECT financial_year, {billions('SUM(total_income_000s)')} AS total_income_bn,
           {billions('SUM(total_expenditure_000s)')} AS total_expenditure_bn,
           {millions('SUM(operating_surplus_000s)')} AS op_surplus_m,
           {millions('SUM(net_surplus_000s)')} AS net_surplus_m,
           {rmean('ebitda_margin_pct')} AS avg_ebitda_pct, {total('is_deficit')} AS deficit_trusts,
           COUNT(*) AS total_trusts FROM card GROUP BY financial_year"""
SQL["T2_sector_comparison"] = f"""
    SELECT sector, trust_type, COUNT(*) AS providers, {millions('SUM(total_income_000s)')} AS total_income_m,
           {rmean('ebitda_margin_pct')} AS avg_ebitda_pct, {rmean('pay_pct_income')} AS avg_pay_pct,
           {rmean('net_surplus_margin_pct')} AS avg_net_surplus_pct, {total('is_deficit')} AS deficit_count,
           {millions('SUM(CASE WHEN operating_surplus_000s < 0 THEN operating_surplus_000s ELSE 0 END)')}
               AS total_deficit_m
    FROM card WHERE financial_year = '{YEAR}' GROUP BY sector, trust_type"""
SQL["T3_region_growth"] = (
    "SELECT region, "
    + ", ".join(f"{sql} AS income_{y[2:4]}{y[5:7]}_000s" for y, sql in BY_YEAR.items())
    + f", {pct(f'({BY_YEAR[YEARS[2]]} - {BY_YEAR[YEARS[0]]})', BY_YEAR[YEARS[0]])} AS growth_2yr_pct"
    + " FROM card WHERE region IS NOT NULL GROUP BY region"
)
SQL["T4_ebitda_distribution"] = f"""
    SELECT sector, {rnd('MIN(ebitda_margin_pct)')} AS min_ebitda_pct, {rmean('ebitda_margin_pct')} AS avg_ebitda_pct,
           {rnd('MAX(ebitda_margin_pct)')} AS max_ebitda_pct,
           COUNT(CASE WHEN ebitda_margin_pct < 0 THEN 1 END) AS negative_ebitda,
           COUNT(CASE WHEN ebitda_margin_pct BETWEEN 0 AND 2 THEN 1 END) AS low_0_2,
           COUNT(CASE WHEN ebitda_margin_pct BETWEEN 2 AND 5 THEN 1 END) AS mid_2_5,
           COUNT(CASE WHEN ebitda_margin_pct > 5 THEN 1 END) AS high_gt5
    FROM card WHERE financial_year = '{YEAR}' AND sector IS NOT NULL GROUP BY sector"""
SQL["T5_largest_by_income"] = f"""
    SELECT CAST(rank() OVER (ORDER BY total_income_000s DESC) AS INT) AS rank, organisation_name, sector, region,
           {millions('total_income_000s')} AS income_m, {millions('operating_surplus_000s')} AS op_surplus_m,
           {pct_text('ebitda_margin_pct')} AS ebitda_margin, {pct_text('pay_pct_income')} AS pay_pct,
           CASE WHEN is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END AS status
    FROM card WHERE financial_year = '{YEAR}' ORDER BY total_income_000s DESC, org_code LIMIT 20"""
SQL["T6_weakest_by_margin"] = f"""
    SELECT CAST(rank() OVER (ORDER BY net_surplus_margin_pct NULLS FIRST) AS INT) AS deficit_rank,
           organisation_name, sector, region, trust_type, {millions('total_income_000s')} AS income_m,
           {millions('net_surplus_000s')} AS net_surplus_m, {pct_text('net_surplus_margin_pct')} AS net_margin,
           {pct_text('ebitda_margin_pct')} AS ebitda_margin
    FROM card WHERE financial_year = '{YEAR}'
    ORDER BY net_surplus_margin_pct NULLS FIRST, org_code LIMIT 20"""
SQL["T7_pay_trend"] = f"""
    SELECT financial_year, sector, {rmean('pay_pct_income')} AS avg_pay_pct,
           {rnd('CAST(SUM(pay_000s) AS DOUBLE) / 1e6')} AS total_pay_bn,
           {rnd('CAST(SUM(total_income_000s) AS DOUBLE) / 1e6')} AS total_income_bn,
           {share('pay_000s')} AS sector_pay_pct
    FROM card WHERE sector IS NOT NULL GROUP BY financial_year, sector"""
SQL["T8_drugs_cost"] = f"""
    SELECT financial_year, sector, {millions('SUM(drugs_cost_000s)')} AS total_drugs_m,
           {share('drugs_cost_000s')} AS drugs_pct_income, {mean_share('drugs_cost_000s')} AS avg_drugs_pct
    FROM card WHERE sector IN ('Acute', 'Specialist') AND drugs_cost_000s IS NOT NULL
    GROUP BY financial_year, sector"""
SQL["T9_negligence_by_year"] = f"""
    SELECT financial_year, {millions('SUM(clinical_negligence_000s)')} AS total_neg_m,
           {share('clinical_negligence_000s')} AS neg_pct_income, COUNT(DISTINCT org_code) AS trusts_reporting
    FROM card WHERE clinical_negligence_000s IS NOT NULL GROUP BY financial_year"""
SQL["T10_finance_lines"] = f"""
    SELECT financial_year, {millions('SUM(finance_income_000s)')} AS finance_income_m,
           {millions('SUM(finance_expense_000s)')} AS finance_expense_m,
           {millions('SUM(pdc_dividend_000s)')} AS pdc_dividend_m,
           {millions('(SUM(finance_income_000s) - SUM(finance_expense_000s) - SUM(pdc_dividend_000s))')} AS net_finance_m
    FROM card WHERE finance_income_000s IS NOT NULL GROUP BY financial_year"""

# --- peers --------------------------------------------------------------------------------------------------
SQL["B1_size_bands"] = f"""
    SELECT income_quartile, CASE income_quartile {' '.join(f"WHEN {q} THEN {quoted(n)}" for q, n in SIZE_BANDS.items())} END
               AS size_band,
           COUNT(*) AS trust_count, {millions('MIN(total_income_000s)')} AS min_income_m,
           {millions('MAX(total_income_000s)')} AS max_income_m, {rmean('ebitda_margin_pct')} AS avg_ebitda_pct,
           {rmean('pay_pct_income')} AS avg_pay_pct, {rmean('cost_per_wte_000s')} AS avg_cost_per_wte_000s,
           {total('is_deficit')} AS deficit_trusts
    FROM (SELECT *, CAST(ntile(4) OVER (PARTITION BY financial_year ORDER BY total_income_000s, org_code) AS INT)
                 AS income_quartile FROM card WHERE financial_year = '{YEAR}') s
    GROUP BY income_quartile"""
SQL["B2_type_comparison"] = f"""
    SELECT financial_year, trust_type, COUNT(*) AS providers, {rmean('ebitda_margin_pct')} AS avg_ebitda_pct,
           {rmean('pay_pct_income')} AS avg_pay_pct, {rmean('net_surplus_margin_pct')} AS avg_net_surplus_pct,
           {total('is_deficit')} AS deficit_count, {millions('SUM(operating_surplus_000s)')} AS total_surplus_m,
           {billions('SUM(total_income_000s)')} AS total_income_bn
    FROM card WHERE trust_type IS NOT NULL GROUP BY financial_year, trust_type"""
SQL["B3_pay_pressure"] = f"""
    SELECT organisation_name, sector, region, trust_type, financial_year, {pct_text('pay_pct_income')} AS pay_pct,
           {threshold()} AS sector_amber_threshold_pct, {rnd(f'pay_pct_income - {threshold()}')} AS excess_pp,
           {pct_text('ebitda_margin_pct')} AS ebitda_margin
    FROM card WHERE financial_year = '{YEAR}' AND pay_pct_income > {threshold()}
    ORDER BY excess_pp DESC, org_code LIMIT 30"""
SQL["B4_regional_health"] = f"""
    SELECT region, COUNT(DISTINCT org_code) AS trusts, {millions('SUM(total_income_000s)')} AS total_income_m,
           {millions('SUM(operating_surplus_000s)')} AS total_surplus_m,
           {share('operating_surplus_000s')} AS sector_op_margin_pct, {rmean('ebitda_margin_pct')} AS avg_ebitda_pct,
           {rmean('pay_pct_income')} AS avg_pay_pct, {total('is_deficit')} AS deficit_trusts,
           {pct('SUM(is_deficit)', 'COUNT(*)', 0)} AS deficit_pct
    FROM card WHERE financial_year = '{YEAR}' AND region IS NOT NULL GROUP BY region"""
SQL["B5_cost_per_wte"] = f"""
    SELECT financial_year, sector, COUNT(*) AS trusts, {rmean('cost_per_wte_000s')} AS avg_cost_per_wte_000s,
           {rnd('MIN(cost_per_wte_000s)')} AS min_cost_per_wte_000s,
           {rnd('MAX(cost_per_wte_000s)')} AS max_cost_per_wte_000s,
           {millions('SUM(total_staff_cost_000s)')} AS total_pay_bill_m,
           {thousands('CAST(SUM(total_wte) AS DOUBLE)', 0)} AS total_wte
    FROM card WHERE sector IS NOT NULL AND total_wte > 0 AND cost_per_wte_000s IS NOT NULL
    GROUP BY financial_year, sector"""
SQL["B6_private_income"] = f"""
    SELECT organisation_name, sector, region, financial_year,
           {millions('private_patient_income_000s', 1)} AS private_income_m,
           {millions('total_income_000s')} AS total_income_m,
           {pct('private_patient_income_000s', 'total_income_000s', 2)} AS private_pct
    FROM card WHERE financial_year = '{YEAR}' AND private_patient_income_000s > 0
    ORDER BY private_patient_income_000s DESC, org_code LIMIT 25"""
SQL["B7_negligence_by_sector"] = f"""
    SELECT financial_year, sector, COUNT(DISTINCT org_code) AS trusts_reporting,
           {millions('SUM(clinical_negligence_000s)')} AS total_neg_m,
           {share('clinical_negligence_000s', 2)} AS neg_pct_income,
           {mean_share('clinical_negligence_000s', 2)} AS avg_neg_pct_per_trust
    FROM card WHERE clinical_negligence_000s IS NOT NULL AND sector IS NOT NULL GROUP BY financial_year, sector"""
SQL["B8_ebitda_movers"] = f"""
    SELECT organisation_name, sector, region, income_m, {pct_text('before')} AS ebitda_{TAG_BEFORE},
           {pct_text('now')} AS ebitda_{TAG}, {SIGNED.format(v='change', p=plain('change'))} AS yoy_change,
           CASE WHEN is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END AS status_{TAG}
    FROM (SELECT a.org_code, a.organisation_name, a.sector, a.region, a.is_deficit,
                 a.ebitda_margin_pct AS now, b.ebitda_margin_pct AS before,
                 {rnd('a.ebitda_margin_pct - b.ebitda_margin_pct')} AS change,
                 {millions('a.total_income_000s')} AS income_m
          FROM card a JOIN card b ON a.org_code = b.org_code AND a.financial_year = '{YEAR}'
           AND b.financial_year = '{BEFORE}') p
    ORDER BY change NULLS FIRST, org_code LIMIT 30"""
SQL["B9_sickness"] = f"""
    SELECT c.financial_year, c.sector, COUNT(*) AS trusts, {rmean('w.avg_days_lost_per_wte')} AS avg_days_lost_per_wte,
           {thousands('CAST(SUM(c.total_wte) AS DOUBLE)', 0)} AS total_wte,
           {thousands("CAST(SUM(CAST(w.avg_days_lost_per_wte AS HUGEINT) * c.total_wte"
                      " * CAST(round(c.cost_per_wte_000s * 10) AS BIGINT)) AS DOUBLE) / 2250.0 / 1e3", 0)}
               AS est_sickness_cost_m
    FROM card c JOIN wf w ON c.org_code = w.org_code AND c.financial_year = w.financial_year
    WHERE w.avg_days_lost_per_wte IS NOT NULL AND c.total_wte > 0 AND c.cost_per_wte_000s IS NOT NULL
      AND c.sector IS NOT NULL
    GROUP BY c.financial_year, c.sector"""
ACADEMIC = "(COALESCE(rd_income_000s, 0) + COALESCE(education_training_income_000s, 0))"
SQL["B10_academic_income"] = f"""
    SELECT organisation_name, sector, region, financial_year, {millions('rd_income_000s', 1)} AS rd_income_m,
           {millions('education_training_income_000s', 1)} AS education_income_m,
           {millions(ACADEMIC, 1)} AS rd_edu_total_m, {pct(ACADEMIC, 'total_income_000s')} AS rd_edu_pct_income,
           {pct_text('ebitda_margin_pct')} AS ebitda_margin
    FROM card WHERE financial_year = '{YEAR}' AND (rd_income_000s > 0 OR education_training_income_000s > 0)
    ORDER BY {ACADEMIC} DESC, org_code LIMIT 25"""

# --- exports ------------------------------------------------------------------------------------------------
SQL["E1_dim_trust"] = TRUST_EXPORT
SQL["E2_dim_financial_year"] = f"SELECT * FROM {YEAR_DIM} y"
SQL["E3_ie_summary"] = SQL["S7_export_query"]
SQL["E4_expenditure_breakdown"] = f"""
    SELECT {VIEW_KEY}, pay_000s, non_pay_000s, depreciation_amort_000s, drugs_cost_000s, staff_cost_000s,
           total_expenditure_000s FROM ex"""
SQL["E5_workforce"] = f"""
    SELECT {VIEW_KEY}, total_staff_cost_000s, gross_staff_cost_000s, total_wte, medical_wte, nursing_wte,
           admin_estates_wte, scientific_tech_wte, avg_days_lost_per_wte
    FROM wf WHERE total_staff_cost_000s IS NOT NULL"""
SQL["E6_kpis"] = f"""
    SELECT {VIEW_KEY}, total_income_000s, total_expenditure_000s, operating_surplus_000s, net_surplus_000s,
           pay_000s, drugs_cost_000s, depreciation_amort_000s, ebitda_000s, ebitda_margin_pct, pay_pct_income,
           cost_per_wte_000s, net_surplus_margin_pct, total_wte FROM kpis"""
SQL["E7_income_detail"] = INCOME_ITEMS
SQL["E8_expenditure_detail"] = SPEND_ITEMS
SQL["E9_profit_and_loss"] = "SELECT * FROM pl"
SQL["E10_balance_sheet"] = "SELECT * FROM bs"
SQL["E11_sector_benchmarks"] = BENCHMARK_EXPORT


def _cells(key: str) -> str:
    return f"""
    SELECT '{key.split('_', 1)[1]}' AS dataset, column_name, COUNT(*) AS cells,
           CAST(SUM(CAST('0x' || substr(md5(cell), 1, 8) AS BIGINT)) AS BIGINT) AS checksum
    FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({SQL[key]}) e) ON COLUMNS(*) INTO NAME column_name VALUE cell)
    GROUP BY column_name"""


SQL["S8b_export_contents"] = " UNION ALL ".join(_cells(k) for k in SQL if re.match(r"E\d+_", k))
SQL["X1_enriched_kpis"] = f"""
    SELECT {VIEW_KEY}, total_income_000s, ebitda_000s, ebitda_margin_pct, pay_000s, pay_pct_income, total_wte,
           cost_per_wte_000s, net_surplus_000s, net_surplus_margin_pct, is_deficit, is_large, pay_pressure_flag,
           ebitda_rag, ebitda_margin_yoy_pp FROM enriched"""
SQL["X2_income_detail_long"] = f"""
    SELECT t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year, f.worksheet_name,
           f.sub_code, sc.description AS sub_code_description, sc.is_subtotal, f.total_000s AS value_000s
    FROM fact f JOIN trusts t ON f.org_code = t.org_code JOIN codes sc ON f.sub_code = sc.sub_code
    WHERE f.worksheet_name IN ('{ref.INCOME_1}', '{ref.INCOME_2}', '{ref.SOCI}')
      AND sc.analytics_category IN ('PATIENT_INCOME', 'OTHER_INCOME', 'TOTAL_INCOME')"""
SQL["X3_expenditure_detail_long"] = f"""
    SELECT t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year, f.sub_code,
           sc.description AS sub_code_description, sc.analytics_category, sc.is_subtotal,
           f.total_000s AS value_000s
    FROM fact f JOIN trusts t ON f.org_code = t.org_code JOIN codes sc ON f.sub_code = sc.sub_code
    WHERE f.worksheet_name = '{ref.EXPENDITURE}'"""
SQL["X4_extract_codes"] = EXTRACTED
LETTERS = "regexp_replace({c}, '[^A-Za-z]', '', 'g')"


def _subtotal(column: str) -> str:
    letters = LETTERS.format(c=column)
    return (
        f"CASE WHEN lower(trim({column})) LIKE 'total%' OR (length({letters}) > 3 "
        f"AND {letters} = upper({letters})) THEN 1 ELSE 0 END"
    )


SQL["X5_label_rules"] = f"""
    SELECT p_partkey, p_name || ' ' || p_type || ' WTE' AS label, p_brand || ' & x' AS worksheet,
           {_subtotal('p_name')} AS name_is_subtotal, {_subtotal('p_type')} AS type_is_subtotal, 'No.' AS unit,
           CASE WHEN upper(p_name) LIKE '%WTE%' THEN 'No.' ELSE '£000' END AS name_unit FROM part"""
SQL["X6_skipped_worksheets"] = """
    SELECT worksheet_name, COUNT(*) AS sheet_rows FROM grid
    WHERE worksheet_name NOT IN ('Intro', 'TAC09 Staff') GROUP BY worksheet_name"""

# --- checks --------------------------------------------------------------------------------------------------
SQL["C1_rows_by_scope"] = f"""
    SELECT financial_year, trust_type, COUNT(DISTINCT org_code) AS providers,
           {thousands('CAST(COUNT(*) AS DOUBLE)', 0)} AS total_rows FROM fact GROUP BY 1, 2"""
SQL["C2_patient_income"] = f"""
    SELECT financial_year, {billions('SUM(total_000s)')} AS patient_income_bn,
           COUNT(DISTINCT org_code) AS providers FROM fact WHERE sub_code = 'SCI0100A' GROUP BY 1"""
SQL["C3_income_expenditure_by_year"] = f"""
    SELECT financial_year, {billions('SUM(patient_care_income_000s)')} AS patient_income_bn,
           {billions('SUM(other_income_000s)')} AS other_income_bn,
           {billions('SUM(total_income_000s)')} AS total_income_bn,
           {billions('SUM(total_expenditure_000s)')} AS total_exp_bn,
           {billions('SUM(operating_surplus_000s)')} AS op_surplus_bn,
           COUNT(DISTINCT org_code) AS providers FROM ie GROUP BY 1"""
SQL["C4_kpis_by_sector"] = f"""
    SELECT sector, trust_type, COUNT(DISTINCT org_code) AS providers,
           {rmean('ebitda_margin_pct')} AS avg_ebitda_margin_pct, {rmean('pay_pct_income')} AS avg_pay_pct_income,
           {rmean('net_surplus_margin_pct')} AS avg_net_surplus_pct
    FROM kpis WHERE financial_year = '{YEAR}' GROUP BY 1, 2"""
_surplus = "SUM(CASE WHEN operating_surplus_000s {op} 0 THEN operating_surplus_000s ELSE 0 END)"
SQL["C5_deficit_summary"] = f"""
    SELECT COUNT(CASE WHEN operating_surplus_000s < 0 THEN 1 END) AS deficit_trusts,
           COUNT(CASE WHEN operating_surplus_000s >= 0 THEN 1 END) AS surplus_trusts, COUNT(*) AS total_trusts,
           {millions(_surplus.format(op='<'), 1)} AS total_deficit_m,
           {millions(_surplus.format(op='>='), 1)} AS total_surplus_m
    FROM ie WHERE financial_year = '{YEAR}'"""
_listing = f"""
    SELECT organisation_name, sector, trust_type, {millions('total_income_000s', 1)} AS total_income_m,
           {millions('operating_surplus_000s', 1)} AS op_surplus_m, """
SQL["C6_largest"] = f"""{_listing} {pct_text('net_surplus_margin_pct')} AS net_margin FROM kpis
    WHERE financial_year = '{YEAR}' ORDER BY total_income_000s DESC, org_code LIMIT 10"""
SQL["C7_largest_deficits"] = f"""{_listing} {pct_text('ebitda_margin_pct')} AS ebitda_margin FROM kpis
    WHERE financial_year = '{YEAR}' AND operating_surplus_000s IS NOT NULL
    ORDER BY operating_surplus_000s, org_code LIMIT 10"""
SQL["C8_cost_mix"] = f"""
    SELECT financial_year, {billions('SUM(pay_000s)')} AS total_pay_bn,
           {billions('SUM(drugs_cost_000s)')} AS total_drugs_bn, {billions('SUM(non_pay_000s)')} AS total_non_pay_bn,
           {billions('SUM(total_expenditure_000s)')} AS total_exp_bn,
           {pct('SUM(pay_000s)', 'SUM(total_expenditure_000s)')} AS pay_pct_exp FROM ex GROUP BY 1"""
SQL["C9_workforce_by_year"] = f"""
    SELECT financial_year, {thousands('CAST(SUM(total_wte) AS DOUBLE)', 0)} AS total_wte,
           {billions('SUM(total_staff_cost_000s)')} AS staff_cost_bn,
           {rnd(ratio('SUM(total_staff_cost_000s)', 'SUM(total_wte)'))} AS avg_cost_per_wte_000s
    FROM wf WHERE total_wte IS NOT NULL GROUP BY 1"""
SQL["C10_key_uniqueness"] = """
    SELECT COUNT(*) AS total_rows,
           COUNT(DISTINCT org_code || '|' || financial_year || '|' || main_code || '|' || sub_code) AS unique_keys
    FROM fact"""

# --- quality -------------------------------------------------------------------------------------------------
SQL["D1_critical_nulls"] = """
    SELECT COUNT(*) FILTER (organisation_name IS NULL) AS null_organisation_name,
           COUNT(*) FILTER (sub_code IS NULL) AS null_sub_code,
           COUNT(*) FILTER (financial_year IS NULL) AS null_financial_year,
           COUNT(*) FILTER (total IS NULL) AS null_total FROM staged"""
SQL["D2_batch_warnings"] = f"""
    SELECT 'repeated_rows' AS warning, found FROM ({REPEATED.format(name='found')}) r
    UNION ALL SELECT 'unmatched_names', (SELECT COUNT(*) FROM ({SQL['J2_unmatched_names']}) u)"""


def check(name: str, severity: str, passed: str, detail: str, source: str) -> str:
    return (
        f"SELECT {quoted(name)} AS check_name, '{severity}' AS severity, COALESCE({passed}, false) AS passed, "
        f"{detail} AS detail FROM ({source}) s"
    )


_years = {
    y: check(
        f"year coverage: {y}",
        "CRITICAL",
        "n > 0",
        "CASE WHEN n > 0 THEN 'found' ELSE 'MISSING' END || ' in fact'",
        f"SELECT COUNT(*) AS n FROM fact WHERE financial_year = '{y}'",
    )
    for y in EXPECT.years
}
_fact_count = check(
    "fact row count",
    "CRITICAL",
    f"n >= {EXPECT.fact_rows_min}",
    f"format('{{:,}}', n) || ' rows (expected ≥ {EXPECT.fact_rows_min:,})'",
    "SELECT COUNT(*) AS n FROM fact",
)
_trust_count = check(
    "dim_trust row count",
    "CRITICAL",
    f"n >= {EXPECT.trusts_min}",
    f"n || ' trusts (expected ≥ {EXPECT.trusts_min})'",
    "SELECT COUNT(*) AS n FROM trusts",
)
SQL["D3_row_counts"] = f"{_fact_count} UNION ALL {_trust_count}"
SQL["D4_year_coverage"] = " UNION ALL ".join(_years.values())
SQL["D5_blank_org_codes"] = check(
    "no null org_codes in fact",
    "CRITICAL",
    "n = 0",
    "n || ' rows carry no organisation code'",
    "SELECT COUNT(*) AS n FROM fact WHERE org_code IS NULL OR trim(org_code) = ''",
)


def _duplicates(source: str) -> str:
    return check(
        "no duplicate fact keys",
        "CRITICAL",
        "n = 0",
        "n || ' keys are held by more than one row'",
        f"SELECT COUNT(*) AS n FROM (SELECT 1 FROM {source} GROUP BY org_code, financial_year, main_code, "
        "sub_code HAVING COUNT(*) > 1) d",
    )


SQL["D6_duplicate_keys"] = _duplicates("resolved")
SQL["D7_orphan_codes"] = check(
    "no orphan org_codes in fact",
    "CRITICAL",
    "orphans = 0",
    "orphans || ' codes of the fact lack an organisation'",
    SQL["J8_orphan_facts"],
)
_lo, _hi = EXPECT.income_bn
SQL["D8_income_total"] = check(
    f"total income {YEAR} in expected range",
    "WARNING",
    f"v BETWEEN {_lo} AND {_hi}",
    f"'£' || {plain(rnd('v'))} || 'bn (expected £{_lo}–{_hi}bn)'",
    f"SELECT COALESCE(CAST(SUM(total_income_000s) AS DOUBLE) / 1e6, 0.0) AS v FROM ie WHERE financial_year = '{YEAR}'",
)
_lo, _hi = EXPECT.deficits
SQL["D9_deficit_count"] = check(
    f"deficit trust count {YEAR}",
    "WARNING",
    f"v BETWEEN {_lo} AND {_hi}",
    f"v || ' organisations below zero (limits {_lo}–{_hi})'",
    f"SELECT COALESCE({total('is_deficit')}, 0) AS v FROM card WHERE financial_year = '{YEAR}'",
)
_lo, _hi = EXPECT.ebitda_pct
SQL["D10_ebitda_mean"] = check(
    f"avg EBITDA margin {YEAR}",
    "WARNING",
    f"v BETWEEN {_lo} AND {_hi}",
    f"{plain('v')} || '% (expected {_lo}–{_hi}%)'",
    f"SELECT COALESCE({rmean('ebitda_margin_pct')}, 0.0) AS v FROM kpis WHERE financial_year = '{YEAR}'",
)
_lo, _hi = EXPECT.pay_pct
SQL["D11_pay_share"] = check(
    f"avg pay % acute trusts {YEAR}",
    "WARNING",
    f"v BETWEEN {_lo} AND {_hi}",
    f"{plain('v')} || '% (benchmark {_lo}–{_hi}%)'",
    f"SELECT COALESCE({rmean('pay_pct_income')}, 0.0) AS v FROM kpis WHERE financial_year = '{YEAR}' AND sector = 'Acute'",
)
SQL["D12_balance"] = check(
    "income - expenditure = operating surplus",
    "WARNING",
    "n = 0",
    "n || ' organisation-years whose surplus is not income less spending'",
    "SELECT COUNT(*) AS n FROM ie WHERE ABS(total_income_000s - total_expenditure_000s - operating_surplus_000s) > 1000",
)
SQL["D13_wte_range"] = check(
    "WTE values plausible (0 < WTE ≤ 50,000)",
    "WARNING",
    "n = 0",
    "n || ' organisation-years with a staff count outside the limits'",
    "SELECT COUNT(*) AS n FROM wf WHERE total_wte <= 0 OR total_wte > 50000",
)
SQL["D14_all_checks"] = " UNION ALL ".join(
    [
        _fact_count,
        _trust_count,
        *_years.values(),
        SQL["D5_blank_org_codes"],
        _duplicates("fact"),
        *(SQL[k] for k in ("D7_orphan_codes", "D8_income_total", "D9_deficit_count", "D10_ebitda_mean",
                           "D11_pay_share", "D12_balance", "D13_wte_range")),
    ]
)
SQL["S9_validation_report"] = SQL["D14_all_checks"]
SQL["D14b_stored_checks"] = SQL["D14_all_checks"]
#: Tables that stand for others in a statement: here the fact and the organisations that a load leaves.
INSTEAD = {
    "D14b_stored_checks": {
        "fact": "SELECT * FROM loaded",
        "trusts": """
            SELECT org_code, any_value(organisation_name) AS organisation_name, any_value(trust_type) AS trust_type,
                   last(sector ORDER BY financial_year) FILTER (sector IS NOT NULL) AS sector,
                   last(region ORDER BY financial_year) FILTER (region IS NOT NULL) AS region
            FROM providers GROUP BY org_code""",
    }
}

# --- measures ---------------------------------------------------------------------------------------------------
KEYS = "financial_year, sector"


def m(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) / 1e3"


def grouped(columns: str, keys: str = KEYS) -> str:
    return f"SELECT {keys}, {columns} FROM mbase GROUP BY {keys}"


EBITDA_PCT = ratio("SUM(kpi_ebitda)", "SUM(kpi_income)", "100.0::DOUBLE")
PAY_PCT = ratio("SUM(kpi_pay)", "SUM(kpi_income)", "100.0::DOUBLE")
SURPLUS_PCT = ratio("SUM(net_surplus_000s)", "SUM(total_income_000s)", "100.0::DOUBLE")
DEFICITS = "COUNT(CASE WHEN kpi_surplus < 0 THEN 1 END)"
SURPLUSES = "COUNT(CASE WHEN kpi_surplus >= 0 THEN 1 END)"

SQL["G1_income_sums"] = grouped(
    f"{m('total_income_000s')} AS total_income_m, {m('patient_care_income_000s')} AS patient_care_income_m, "
    f"{m('other_income_000s')} AS other_income_m, {m('total_expenditure_000s')} AS total_expenditure_m, "
    f"{m('operating_surplus_000s')} AS operating_surplus_m, {m('net_surplus_000s')} AS net_surplus_m"
)
SQL["G2_expenditure_sums"] = grouped(
    f"{m('pay_000s')} AS total_pay_m, {m('non_pay_000s')} AS total_non_pay_m, "
    f"{m('depreciation_amort_000s')} AS depreciation_amort_m, {m('drugs_cost_000s')} AS drugs_cost_m"
)
SQL["G3_margins"] = grouped(
    f"{m('kpi_ebitda')} AS ebitda_m, {EBITDA_PCT} AS ebitda_margin_pct, {PAY_PCT} AS pay_pct_of_income, "
    f"{SURPLUS_PCT} AS net_surplus_margin_pct"
)
SQL["G4_trust_counts"] = grouped(
    f"{DEFICITS} AS deficit_trusts, {SURPLUSES} AS surplus_trusts, COUNT(DISTINCT kpi_org) AS total_trusts, "
    f"{ratio(DEFICITS, 'COUNT(DISTINCT kpi_org)', '100.0::DOUBLE')} AS deficit_pct",
    "region",
)
SQL["G5_staff_cost"] = grouped(
    f"{total('total_wte')} AS total_wte, {m('total_staff_cost_000s')} AS total_staff_cost_m, "
    f"{ratio('SUM(total_staff_cost_000s)', 'SUM(total_wte)')} AS avg_cost_per_wte_000s"
)
SQL["G6_wte_groups"] = grouped(
    ", ".join(f"{total(c)} AS {c}" for c in ("medical_wte", "nursing_wte", "admin_estates_wte", "scientific_tech_wte"))
    + f", {ratio('SUM(medical_wte)', 'SUM(total_wte)', '100.0::DOUBLE')} AS medical_pct_of_wte, "
    f"{ratio('SUM(nursing_wte)', 'SUM(total_wte)', '100.0::DOUBLE')} AS nursing_pct_of_wte"
)
START = "CAST(substr(financial_year, 1, 4) AS INT)"
SQL["G7_prior_year"] = f"SELECT DISTINCT {KEYS}, {label_of(f'({START} - 1)')} AS prior_year FROM mbase"


def with_prior(columns: str, prior_columns: str) -> str:
    now = grouped(columns)
    return (
        f"SELECT c.financial_year, c.sector, {prior_columns} FROM ({now}) c LEFT JOIN ({now}) p "
        "ON c.sector IS NOT DISTINCT FROM p.sector AND CAST(substr(c.financial_year, 1, 4) AS INT) "
        "= CAST(substr(p.financial_year, 1, 4) AS INT) + 1"
    )


def minus(a: str, b: str, zero: str = "0.0::DOUBLE") -> str:
    return f"CASE WHEN {a} IS NOT NULL OR {b} IS NOT NULL THEN COALESCE({a}, {zero}) - COALESCE({b}, {zero}) END"


SQL["G8_income_growth"] = with_prior(
    f"{m('total_income_000s')} AS v",
    "p.v AS prior_year_income_m, CASE WHEN p.v IS NOT NULL THEN "
    f"{ratio('(COALESCE(c.v, 0.0::DOUBLE) - p.v)', 'p.v', '100.0::DOUBLE')} END AS income_yoy_growth_pct",
)
SQL["G9_margin_changes"] = with_prior(
    f"{EBITDA_PCT} AS e, {PAY_PCT} AS y",
    f"p.e AS prior_year_ebitda_margin_pct, {minus('c.e', 'p.e')} AS ebitda_margin_yoy_pp, "
    f"p.y AS prior_year_pay_pct, {minus('c.y', 'p.y')} AS pay_pct_yoy_pp",
)
SQL["G10_deficit_change"] = with_prior(
    f"{DEFICITS} AS d",
    f"p.d AS prior_year_deficit_trusts, {minus('c.d', 'p.d', '0')} AS deficit_trusts_yoy_change",
)


def rag(value: str, green: float, amber: float) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN 'Grey' WHEN {value} >= {green} THEN 'Green' "
        f"WHEN {value} >= {amber} THEN 'Amber' ELSE 'Red' END"
    )


RAGS = {
    "ebitda_rag": rag(EBITDA_PCT, 5, 2),
    "surplus_rag": rag(SURPLUS_PCT, 0, -2),
    "pay_rag": f"CASE WHEN {PAY_PCT} IS NULL THEN 'Grey' WHEN {PAY_PCT} < 65 THEN 'Green' "
    f"WHEN {PAY_PCT} < 70 THEN 'Amber' ELSE 'Red' END",
}
SQL["G11_rag"] = grouped(", ".join(f"{sql} AS {name}" for name, sql in RAGS.items()))
_colour = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RAG_COLOURS.items())
SQL["G12_rag_colours"] = grouped(
    ", ".join(
        f"CASE {sql} {_colour} ELSE '{NO_DATA_COLOUR}' END AS {name}_colour" for name, sql in RAGS.items()
    )
)
SQL["G13_selections"] = """
    SELECT region, financial_year, financial_year AS selected_year,
           CASE WHEN COUNT(DISTINCT COALESCE(sector, '-')) = 1 AND MAX(sector) IS NOT NULL THEN MAX(sector)
                ELSE 'All Sectors' END AS selected_sector,
           COALESCE(region, 'All Regions') AS selected_region
    FROM mbase GROUP BY region, financial_year"""


def one_decimal(value: str) -> str:
    return f"COALESCE({plain(rnd(value))}, '')"


SQL["G14_labels"] = grouped(
    "'Income & Expenditure - ' || financial_year || ' | ' || COALESCE(sector, 'All Sectors') AS page_title, "
    f"'£' || {one_decimal('ABS(' + m('operating_surplus_000s') + ')')} || CASE WHEN SUM(operating_surplus_000s) < 0 "
    "THEN 'm deficit' ELSE 'm surplus' END AS surplus_label, "
    f"{one_decimal(EBITDA_PCT)} || '% EBITDA margin' AS ebitda_label, "
    f"{DEFICITS} || ' of ' || COUNT(DISTINCT kpi_org) || ' trusts in deficit' AS deficit_count_label"
)
SQL["G15_sector_benchmark"] = f"""
    SELECT e.financial_year, b.v AS sector_benchmark_ebitda_pct, {minus('e.v', 'b.v')} AS ebitda_vs_benchmark_pp
    FROM ({grouped(EBITDA_PCT + ' AS v', 'financial_year')}) e
    LEFT JOIN (SELECT financial_year, {mean('s', 9)} AS v
               FROM (SELECT financial_year, sector, {mean('avg_ebitda_margin_pct')} AS s
                     FROM ({BENCHMARK_EXPORT}) x GROUP BY 1, 2) y GROUP BY 1) b
      ON e.financial_year = b.financial_year"""
SQL["G16a_surplus_bridge"] = f"""
    SELECT financial_year, 1 AS step_no, 'Income' AS step, {m('total_income_000s')} AS amount_m FROM ie GROUP BY 1
    UNION ALL SELECT financial_year, 2, 'Expenditure', -({m('total_expenditure_000s')}) FROM ie GROUP BY 1
    UNION ALL SELECT financial_year, 3, 'Surplus', {m('operating_surplus_000s')} FROM ie GROUP BY 1"""
SQL["G16b_best_by_ebitda"] = f"""
    SELECT CAST(rank() OVER (ORDER BY ebitda_margin_pct DESC NULLS LAST) AS INT) AS rank, org_code,
           organisation_name, sector, ebitda_margin_pct, total_income_000s
    FROM card WHERE financial_year = '{YEAR}' ORDER BY ebitda_margin_pct DESC NULLS LAST, org_code LIMIT 20"""
_tenths = "CAST(round(ebitda_margin_pct * 10) AS BIGINT)"
SQL["G16c_margin_box_plot"] = f"""
    SELECT financial_year, sector, MIN(ebitda_margin_pct) AS low,
           quantile_cont({_tenths}, 0.25) / 10 + 0.0 AS q1, quantile_cont({_tenths}, 0.5) / 10 + 0.0 AS median,
           quantile_cont({_tenths}, 0.75) / 10 + 0.0 AS q3, MAX(ebitda_margin_pct) AS high
    FROM card WHERE sector IS NOT NULL GROUP BY financial_year, sector"""
SQL["G16d_wte_by_sector"] = f"""
    SELECT financial_year, sector, {total('total_wte')} AS total_wte FROM wf WHERE sector IS NOT NULL GROUP BY 1, 2"""
SQL["G16e_deficit_split"] = """
    SELECT financial_year, CASE WHEN operating_surplus_000s < 0 THEN 'Deficit' ELSE 'Surplus' END AS result,
           COUNT(*) AS trusts FROM kpis WHERE operating_surplus_000s IS NOT NULL GROUP BY 1, 2"""

# --- plan KPIs ----------------------------------------------------------------------------------------------------
SHIPMENTS = f"""
    SELECT l_suppkey, {fiscal_label('l_shipdate')} AS financial_year,
           printf('M%02d', {period_no('l_shipdate')}) AS period,
           CASE WHEN l_returnflag = 'A' THEN 'EXPENDITURE' ELSE 'INCOME' END AS account_type,
           CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS plan,
           CAST(floor(l_extendedprice * 100 * (1 + l_tax - l_discount) + 0.5) AS BIGINT) AS outcome,
           CASE WHEN l_linenumber = 1 THEN CAST(floor(l_extendedprice * 100 * l_tax + 0.5) AS BIGINT) ELSE 0 END
               AS agency, l_quantity
    FROM lineitem"""
OF = "l_suppkey, financial_year"


def _ratio_query(a: str, b: str, a_sql: str, b_sql: str, value: str, name: str, flag: str, extra: str) -> str:
    return f"""
        SELECT {OF}, {a}, {b}, {rnd('v')} AS {name}, {flag} AS {extra}
        FROM (SELECT {OF}, {a}, {b}, {value} AS v
              FROM (SELECT {OF}, {total(a_sql)} AS {a}, {total(b_sql)} AS {b}
                    FROM ({SHIPMENTS}) s GROUP BY {OF}) g) w"""


SQL["K1_savings_achievement"] = _ratio_query(
    "delivered_000s", "target_000s", "outcome", "plan",
    ratio("delivered_000s", "target_000s", "100.0::DOUBLE"), "achievement_pct", rag("v", 100, 80), "rag",
)
SQL["K3_capital_spend"] = _ratio_query(
    "actual_000s", "plan_000s", "CASE WHEN l_quantity >= 40 THEN 0 ELSE outcome END", "plan",
    ratio("actual_000s", "plan_000s", "100.0::DOUBLE"), "spend_pct",
    "CASE WHEN v IS NULL THEN 'Grey' WHEN v BETWEEN 90 AND 110 THEN 'Green' "
    "WHEN v >= 75 AND v < 90 THEN 'Amber' ELSE 'Red' END", "rag",
)
SQL["K4_agency_share"] = _ratio_query(
    "agency_000s", "pay_000s", "agency", "plan",
    ratio("agency_000s", "(pay_000s + agency_000s)", "100.0::DOUBLE"), "agency_pct",
    "CASE WHEN v >= 3.5 THEN 1 ELSE 0 END", "over_ceiling",
)
_of = f"{OF}, account_type"
_good = "CASE WHEN account_type = 'INCOME' THEN v ELSE -v END"
SQL["K2_budget_variance"] = f"""
    SELECT {_of}, period, actual_000s, budget_000s, actual_000s - budget_000s AS variance_000s,
           {rnd('v')} AS variance_pct,
           CASE WHEN (account_type = 'INCOME' AND actual_000s >= budget_000s)
                  OR (account_type <> 'INCOME' AND actual_000s <= budget_000s) THEN 'FAV' ELSE 'ADV' END AS direction,
           CASE WHEN v IS NULL THEN 'Grey' WHEN {_good} >= 0 THEN 'Green' WHEN {_good} >= -2 THEN 'Amber'
                ELSE 'Red' END AS rag,
           ytd_actual - ytd_budget AS ytd_variance_000s,
           {pct('(ytd_actual - ytd_budget)', 'ABS(ytd_budget)')} AS ytd_variance_pct
    FROM (SELECT *, {ratio('(actual_000s - budget_000s)', 'ABS(budget_000s)', '100.0::DOUBLE')} AS v,
                 CAST(SUM(actual_000s) OVER w AS BIGINT) AS ytd_actual,
                 CAST(SUM(budget_000s) OVER w AS BIGINT) AS ytd_budget
          FROM (SELECT {_of}, period, {total('outcome')} AS actual_000s, {total('plan')} AS budget_000s
                FROM ({SHIPMENTS}) s GROUP BY {_of}, period) g
          WINDOW w AS (PARTITION BY {_of} ORDER BY period)) x"""


def statements() -> dict[str, str]:
    return {name: with_tables(sql, INSTEAD.get(name)) for name, sql in SQL.items()}
