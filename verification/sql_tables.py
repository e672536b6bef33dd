"""SQL definitions of the shared tables, for checking results in another engine.

Views are written the long way (one pivot per view, then joins), so they check the
single-pass plans of the library instead of repeating them. Only the fixture's
line table is shared, because it is input data.
"""

from __future__ import annotations

import re

from ledgerwide import reference_data as ref
from ledgerwide.sources import derived

VIEW_KEY = "org_code, organisation_name, sector, region, trust_type, financial_year"


def rnd(value: str, places: int = 1) -> str:
    """Rounded, without negative zero."""
    return f"(round({value}, {places}) + 0.0)"


def ratio(top: str, bottom: str, scale: str = "1.0::DOUBLE") -> str:
    return f"(CAST({top} AS DOUBLE) * {scale} / NULLIF(CAST({bottom} AS DOUBLE), 0))"


def pct(top: str, bottom: str, places: int = 1) -> str:
    return rnd(ratio(top, bottom, "100.0::DOUBLE"), places)


def mean(value: str, scale: int = 1) -> str:
    steps = f"CAST(floor({value} * 1e{scale} + 0.5) AS BIGINT)"
    return f"(CAST(SUM({steps}) AS DOUBLE) / NULLIF(COUNT({value}) * 1e{scale}, 0))"


def rmean(value: str, places: int = 1, scale: int = 1) -> str:
    return rnd(mean(value, scale), places)


def thousands(value: str, places: int) -> str:
    return f"format('{{:,.{places}f}}', round({value}, {places}) + 0.0)"


def millions(value: str, places: int = 0) -> str:
    return thousands(f"CAST({value} AS DOUBLE) / 1e3", places)


def billions(value: str, places: int = 1) -> str:
    return thousands(f"CAST({value} AS DOUBLE) / 1e6", places)


def plain(value: str, places: int = 1) -> str:
    return f"CAST(CAST({value} AS DECIMAL(20,{places})) AS VARCHAR)"


def pct_text(value: str) -> str:
    return f"({plain(value)} || '%')"


def total(value: str) -> str:
    return f"CAST(SUM({value}) AS BIGINT)"


def quoted(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values(rows: list[tuple], name: str, columns: str) -> str:
    body = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) {name}({columns})"


def _amount(condition: str) -> str:
    cents = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
    return f"CAST(floor(CAST(SUM(CASE WHEN {condition} THEN {cents} END) AS BIGINT) / 100) AS BIGINT)"


def _units(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN CAST(floor(l_quantity + 0.5) AS BIGINT) END) AS BIGINT)"


def label_of(start: str) -> str:
    return f"printf('%04d/%02d', {start}, ({start} + 1) % 100)"


def start_of(date: str) -> str:
    return f"CAST(year({date}) - CASE WHEN month({date}) < 4 THEN 1 ELSE 0 END AS INTEGER)"


def sector(key: str) -> str:
    names = ["Acute", "Mental Health", "Community", "Ambulance", "Specialist"]
    whens = " ".join(
        f"WHEN {key} % 5 = {i} THEN CASE WHEN {key} % 50 >= 45 THEN '{n.upper().replace(' ', '_')}' "
        f"WHEN {key} % 50 >= 40 THEN '{n} Trust' ELSE '{n}' END"
        for i, n in enumerate(names)
    )
    return f"CASE WHEN {key} % 23 = 7 THEN NULL {whens} END"


def trust_type(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN 'NHS_TRUST' ELSE 'FOUNDATION_TRUST' END"


def source_file(key: str, start: str) -> str:
    kind = f"CASE WHEN {key} % 3 = 0 THEN 'trusts' ELSE 'foundation_trusts' END"
    return f"printf('TAC_NHS_%s_%04d-%02d.csv', {kind}, {start}, ({start} + 1) % 100)"


def _lines(lines: list[tuple]) -> str:
    structs = ", ".join(
        "{'worksheet_name': %s, 'table_id': CAST(%d AS SMALLINT), 'main_code': '%s', 'row_num': %d, "
        "'sub_code': '%s', 'total_000s': CAST(%s AS BIGINT)}" % (quoted(w), t, m, i + 1, s, a)
        for i, (w, t, m, s, a) in enumerate(lines)
    )
    return f"SELECT l_suppkey, fy, unnest([{structs}], recursive := true) FROM base"


def _largest(lines: dict[str, str], prefix: str = "") -> str:
    return ", ".join(
        f"MAX(CASE WHEN sub_code = '{code}' THEN total_000s END) AS {prefix}{column}"
        for code, column in lines.items()
    )


def _view(worksheet: str, columns: str) -> str:
    keys = "t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year"
    return (
        f"SELECT {keys}, {columns} FROM fact f JOIN trusts t ON f.org_code = t.org_code "
        f"WHERE f.worksheet_name = '{worksheet}' GROUP BY {keys}"
    )


SAME = "{a}.org_code = {b}.org_code AND {a}.financial_year = {b}.financial_year"

TABLES: dict[str, str] = {
    "base0": f"""
        SELECT l_suppkey, {start_of('l_shipdate')} AS fy,
               {_amount("l_returnflag = 'N'")} AS n,
               {_amount("l_returnflag = 'A'")} AS a,
               {_amount("l_returnflag = 'R'")} * 2 AS e,
               COALESCE({_amount("l_returnflag = 'N' AND l_linestatus = 'F'")}, 0) AS nf,
               COALESCE({_amount("l_returnflag = 'N' AND l_linestatus = 'O'")}, 0) AS "no",
               COALESCE({_amount("l_returnflag = 'A' AND l_linestatus = 'F'")}, 0) AS af,
               COALESCE({_amount("l_returnflag = 'A' AND l_linestatus = 'O'")}, 0) AS ao,
               {_units('true')} AS q,
               COALESCE({_units("l_linestatus = 'F'")}, 0) AS qf,
               COALESCE({_units("l_linestatus = 'O'")}, 0) AS qo,
               COUNT(*) AS c
        FROM lineitem GROUP BY 1, 2""",
    "base": """
        SELECT *, COALESCE(n, 0) AS n0, COALESCE(a, 0) AS a0, COALESCE(e, 0) AS e0 FROM base0""",
    "lines": _lines(derived.LINES),
    "raw_lines": _lines(derived.LINES + derived.RAW_ONLY_LINES),
    "fact": f"""
        SELECT printf('S%06d', l_suppkey) AS org_code, {label_of('fy')} AS financial_year,
               worksheet_name, table_id, main_code, sub_code, total_000s,
               {trust_type('l_suppkey')} AS trust_type, {source_file('l_suppkey', 'fy')} AS source_file
        FROM lines WHERE total_000s IS NOT NULL""",
    "trusts": f"""
        SELECT printf('S%06d', s_suppkey) AS org_code, s_name AS organisation_name,
               {trust_type('s_suppkey')} AS trust_type, {sector('s_suppkey')} AS sector,
               CASE WHEN s_suppkey % 29 <> 3 THEN r_name END AS region,
               CASE WHEN s_suppkey % 3 <> 0 THEN 1 ELSE 0 END AS is_foundation
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal >= -500""",
    "codes": values(
        ref.CURATED_CODES,
        "codes0",
        "sub_code, worksheet_name, description, expected_sign, unit, is_subtotal, analytics_category",
    ),
    "worksheets": values(
        ref.WORKSHEETS, "worksheets0", "worksheet_name, schedule_title, category, sub_code_prefix"
    ),
    "ie0": _view(
        ref.SOCI,
        _largest(
            {
                "SCI0100A": "patient",
                "SCI0110A": "other",
                "SCI0125A": "spent",
                "SCI0140A": "operating_surplus_000s",
                "SCI0240": "net_surplus_000s",
            }
        ),
    ),
    "ie": f"""
        SELECT {VIEW_KEY}, patient AS patient_care_income_000s, other AS other_income_000s,
               COALESCE(patient, 0) + COALESCE(other, 0) AS total_income_000s,
               ABS(COALESCE(spent, 0)) AS total_expenditure_000s,
               operating_surplus_000s, net_surplus_000s FROM ie0""",
    "pl": _view(ref.SOCI, _largest(ref.PROFIT_AND_LOSS_LINES)),
    "bs": _view(ref.SOFP, _largest(ref.BALANCE_SHEET_LINES)),
    "wf": _view(ref.STAFF, _largest(ref.WORKFORCE_LINES)),
    "spend_rows": f"""
        SELECT f.*, sc.analytics_category FROM fact f JOIN codes sc ON f.sub_code = sc.sub_code
        WHERE f.worksheet_name = '{ref.EXPENDITURE}'""",
    "ex": """
        SELECT t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year, """
    + ", ".join(
        f"CAST(SUM(CASE WHEN analytics_category = '{c}' THEN total_000s ELSE 0 END) AS BIGINT) AS {n}"
        for c, n in ref.EXPENDITURE_CATEGORIES.items()
    )
    + ", "
    + _largest(ref.EXPENDITURE_LINES)
    + """ FROM spend_rows f JOIN trusts t ON f.org_code = t.org_code
        GROUP BY t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year""",
    "kpis0": f"""
        SELECT ie.*, ex.pay_000s, ex.non_pay_000s, ex.depreciation_amort_000s, ex.staff_cost_000s,
               ex.drugs_cost_000s, ex.clinical_negligence_000s, wf.total_wte, wf.medical_wte,
               wf.nursing_wte, wf.avg_days_lost_per_wte, wf.total_staff_cost_000s,
               wf.gross_staff_cost_000s,
               ie.operating_surplus_000s + COALESCE(ex.depreciation_amort_000s, 0) AS ebitda_000s
        FROM ie LEFT JOIN ex ON {SAME.format(a='ie', b='ex')}
        LEFT JOIN wf ON {SAME.format(a='ie', b='wf')}
        WHERE ie.total_income_000s > 0""",
    "kpis1": f"""
        SELECT *, {ratio('ebitda_000s', 'total_income_000s', '100.0::DOUBLE')} AS margin,
               {ratio('net_surplus_000s', 'total_income_000s', '100.0::DOUBLE')} AS net_margin,
               {pct('pay_000s', 'total_income_000s')} AS pay_pct_income,
               {rnd(ratio('staff_cost_000s', 'total_wte'))} AS cost_per_wte_000s,
               CASE WHEN operating_surplus_000s < 0 THEN 1 ELSE 0 END AS is_deficit
        FROM kpis0""",
    "kpis2": f"""
        SELECT *, {rnd('margin')} AS ebitda_margin_pct, {rnd('net_margin')} AS net_surplus_margin_pct
        FROM kpis1""",
    "kpis": f"""
        SELECT {VIEW_KEY}, total_income_000s, total_expenditure_000s, operating_surplus_000s,
               net_surplus_000s, pay_000s, non_pay_000s, depreciation_amort_000s, staff_cost_000s,
               drugs_cost_000s, clinical_negligence_000s, total_wte, medical_wte, nursing_wte,
               avg_days_lost_per_wte, ebitda_000s, ebitda_margin_pct, pay_pct_income,
               cost_per_wte_000s, net_surplus_margin_pct, is_deficit,
               CASE WHEN margin >= 5 THEN 'Green' WHEN margin >= 2 THEN 'Amber' ELSE 'Red' END AS ebitda_rag,
               CASE WHEN net_margin >= 0 THEN 'Green' WHEN net_margin >= -2 THEN 'Amber' ELSE 'Red' END
                   AS surplus_rag
        FROM kpis2""",
    "card_lines": f"""
        SELECT k.org_code, k.financial_year, {_largest(ref.SCORECARD_LINES)}
        FROM kpis0 k LEFT JOIN fact f ON {SAME.format(a='k', b='f')}
             AND f.sub_code IN ({', '.join(quoted(c) for c in ref.SCORECARD_LINES)})
        GROUP BY k.org_code, k.financial_year""",
    "card": f"""
        SELECT k.org_code, k.organisation_name, k.sector, k.region, k.trust_type, k.financial_year,
               k.total_income_000s, k.patient_care_income_000s, k.other_income_000s,
               {', '.join('l.' + c for c in list(ref.SCORECARD_LINES.values()))},
               k.total_expenditure_000s, k.pay_000s, k.non_pay_000s, k.depreciation_amort_000s,
               k.drugs_cost_000s, k.staff_cost_000s, k.operating_surplus_000s, k.net_surplus_000s,
               k.ebitda_000s, k.total_wte, k.total_staff_cost_000s, k.gross_staff_cost_000s,
               k.ebitda_margin_pct, k.pay_pct_income, k.cost_per_wte_000s, k.net_surplus_margin_pct,
               k.is_deficit,
               CASE WHEN k.ebitda_margin_pct < 2 THEN 'Red' WHEN k.ebitda_margin_pct < 5 THEN 'Amber'
                    ELSE 'Green' END AS ebitda_rag,
               CASE WHEN k.net_surplus_000s < 0 THEN 'Red' WHEN k.net_surplus_000s = 0 THEN 'Amber'
                    ELSE 'Green' END AS surplus_rag
        FROM kpis2 k JOIN card_lines l ON {SAME.format(a='k', b='l')}""",
    "enriched0": f"""
        SELECT c.* REPLACE (COALESCE(m.canonical, c.sector) AS sector), k.medical_wte, k.nursing_wte
        FROM card c JOIN kpis0 k ON {SAME.format(a='c', b='k')}
        LEFT JOIN sector_map m ON c.sector = m.spelled""",
    "sector_map": """
        SELECT s || x AS spelled, s AS canonical
        FROM (VALUES ('Acute'), ('Mental Health'), ('Community'), ('Ambulance'), ('Specialist')) a(s),
             (VALUES (''), (' Trust')) b(x)
        UNION ALL
        SELECT upper(replace(s, ' ', '_')), s
        FROM (VALUES ('Acute'), ('Mental Health'), ('Community'), ('Ambulance'), ('Specialist')) a(s)""",
    "amber": """
        SELECT * FROM (VALUES ('Acute', 65.0::DOUBLE), ('Mental Health', 70.0), ('Community', 70.0),
                              ('Ambulance', 68.0), ('Specialist', 60.0)) a(sector, threshold)""",
    "enriched": f"""
        SELECT e.* REPLACE (CASE WHEN e.ebitda_margin_pct >= 5 THEN 'Green' WHEN e.ebitda_margin_pct >= 2
                       THEN 'Amber' WHEN e.ebitda_margin_pct IS NOT NULL THEN 'Red' END AS ebitda_rag),
               CASE WHEN e.total_income_000s >= 1000000 THEN 1 ELSE 0 END AS is_large,
               CASE WHEN e.pay_pct_income > a.threshold THEN 1 ELSE 0 END AS pay_pressure_flag,
               {pct('e.patient_care_income_000s', 'e.total_income_000s')} AS patient_income_pct,
               {pct('e.other_income_000s', 'e.total_income_000s')} AS other_income_pct,
               lag(e.ebitda_margin_pct) OVER w AS ebitda_margin_pct_prior_yr,
               {rnd('e.ebitda_margin_pct - lag(e.ebitda_margin_pct) OVER w')} AS ebitda_margin_yoy_pp
        FROM enriched0 e LEFT JOIN amber a ON e.sector = a.sector
        WINDOW w AS (PARTITION BY e.org_code ORDER BY e.financial_year)""",
    # Every organisation-year of any view, beside its KPI row when there is one.
    "org_years": """
        SELECT org_code, financial_year FROM ie UNION SELECT org_code, financial_year FROM ex
        UNION SELECT org_code, financial_year FROM wf
        UNION SELECT f.org_code, f.financial_year FROM fact f JOIN trusts t ON f.org_code = t.org_code""",
    "mbase": f"""
        SELECT o.org_code, o.financial_year, t.organisation_name, t.sector, t.region, t.trust_type,
               ie.patient_care_income_000s, ie.other_income_000s, ie.total_income_000s,
               ie.total_expenditure_000s, ie.operating_surplus_000s, ie.net_surplus_000s,
               ex.pay_000s, ex.non_pay_000s, ex.depreciation_amort_000s, ex.drugs_cost_000s,
               wf.total_staff_cost_000s, wf.total_wte, wf.medical_wte, wf.nursing_wte,
               wf.admin_estates_wte, wf.scientific_tech_wte,
               k.ebitda_000s AS kpi_ebitda, k.total_income_000s AS kpi_income, k.pay_000s AS kpi_pay,
               k.operating_surplus_000s AS kpi_surplus, k.ebitda_margin_pct, k.org_code AS kpi_org,
               wf.org_code AS staff_org
        FROM org_years o JOIN trusts t ON o.org_code = t.org_code
        LEFT JOIN ie ON {SAME.format(a='o', b='ie')} LEFT JOIN ex ON {SAME.format(a='o', b='ex')}
        LEFT JOIN wf ON {SAME.format(a='o', b='wf')} LEFT JOIN kpis k ON {SAME.format(a='o', b='k')}""",
    # Ingest side.
    "raw": f"""
        SELECT CASE WHEN fy % 2 = 0 THEN upper(printf('Supplier#%09d', l_suppkey))
                    ELSE printf('Supplier#%09d', l_suppkey) END AS organisation_name, worksheet_name, table_id,
               main_code, row_num, sub_code, total_000s, {source_file('l_suppkey', 'fy')} AS source_file,
               {trust_type('l_suppkey')} AS trust_type, {label_of('fy')} AS financial_year
        FROM raw_lines""",
    "staged": """
        SELECT organisation_name, worksheet_name, table_id, main_code, row_num, sub_code,
               total_000s AS total, source_file, trust_type, financial_year, 'CY' AS year_type
        FROM raw WHERE total_000s IS NOT NULL AND main_code NOT LIKE '%PY%'""",
    "provider_codes": """
        SELECT l_suppkey, fy,
               CASE WHEN l_suppkey % 31 = 30 THEN 'X' ELSE '' END
               || lpad(CASE WHEN l_suppkey >= 1296 THEN d[CAST(l_suppkey // 1296 AS INT) + 1] ELSE '' END
                    || CASE WHEN l_suppkey >= 36 THEN d[CAST(l_suppkey // 36 % 36 AS INT) + 1] ELSE '' END
                    || d[CAST(l_suppkey % 36 AS INT) + 1], 3, '0') AS org_code
        FROM base, (SELECT string_split('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', '') AS d) digits""",
    "providers": f"""
        SELECT s_name AS organisation_name, p.org_code, r_name AS region,
               CASE WHEN l_suppkey % 6 = 0 AND p.fy % 4 = 1 THEN NULL ELSE {sector('l_suppkey')} END AS sector,
               CASE WHEN l_suppkey % 10 = 0 THEN 'merged' END AS comments,
               {source_file('l_suppkey', 'p.fy')} AS source_file, {trust_type('l_suppkey')} AS trust_type,
               {label_of('p.fy')} AS financial_year
        FROM provider_codes p JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE length(p.org_code) = 3 AND s_acctbal >= 0""",
    "resolved": """
        SELECT p.org_code, r.financial_year, r.worksheet_name, r.table_id, r.main_code, r.sub_code,
               r.total AS total_000s, r.trust_type, r.source_file, r.row_num
        FROM staged r JOIN (SELECT DISTINCT lower(organisation_name) AS name, financial_year, trust_type, org_code
                            FROM providers) p
          ON lower(r.organisation_name) = p.name AND r.financial_year = p.financial_year
         AND r.trust_type = p.trust_type""",
    "loaded": """
        SELECT org_code, financial_year, main_code, sub_code,
               first(worksheet_name ORDER BY source_file, row_num) AS worksheet_name,
               first(table_id ORDER BY source_file, row_num) AS table_id,
               first(trust_type ORDER BY source_file, row_num) AS trust_type,
               last(total_000s ORDER BY source_file, row_num) AS total_000s,
               last(source_file ORDER BY source_file, row_num) AS source_file
        FROM resolved GROUP BY org_code, financial_year, main_code, sub_code""",
    # Template-sheet grid made of parts.
    "grid": """
        SELECT CASE WHEN p_size % 9 = 0 THEN 'TAC09 Staff' WHEN p_size % 9 = 1 THEN 'Intro'
                    ELSE p_brand || ' &amp; more' END AS worksheet_name,
               p_partkey AS row_no, p_partkey % 4 AS style, p_size, p_name, p_type,
               printf('PRT%04d', p_partkey % 700) || CASE WHEN p_partkey % 3 = 0 THEN 'A' ELSE '' END AS code,
               CASE p_partkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '+/-' END AS sign
        FROM part""",
}


def with_tables(query: str, instead: dict[str, str] | None = None) -> str:
    """Prefix a query with the tables it needs, in dependency order; ``instead`` redefines some."""
    tables = TABLES | (instead or {})
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", re.sub(r"'[^']*'", "", text)):
            if name in tables and name not in needed and name not in active:
                active.append(name)
                visit(tables[name])
                active.remove(name)
                needed.append(name)

    active: list[str] = []
    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in needed) + "\n" + query
