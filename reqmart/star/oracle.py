"""SQL that gives the results of the queries on the raw tables, for DuckDB, without the library.

Each statement starts from the raw tables. It takes other ways than the library where there are any:
datasets by a join with two rows, ranks and QUALIFY by windows, unpivoting by UNNEST, and scenario
settings straight from the order lines, never by way of JSON.
"""

from __future__ import annotations

from reqmart.star.inputs import CLOCK_FROM, CUTOFF, DRUG_CODES, LATE, PHARMACIES

KEYS = ["parent_request_id", "request_id", "task_id"]


def listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def chicago(expression: str) -> str:
    return f"({expression}) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago'"


def word(expression: str) -> str:
    """One word with a capital first letter."""
    return f"(upper({expression}[1]) || lower({expression}[2:]))"


def same(left: str, right: str, columns: list[str]) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in columns)


# Named subqueries. Each may use the ones before it.
PARTS = {
    "li": """
        SELECT *, CAST(l_suppkey AS VARCHAR) AS parent_request_id,
               CAST(l_linenumber AS VARCHAR) AS request_id,
               CASE WHEN l_linenumber = 7 THEN 'QA7' WHEN l_linenumber > 3 THEN 'UW2' ELSE 'UW1' END AS task_id,
               l_partkey - CASE WHEN l_partkey % 3 = 1 THEN 1 ELSE 0 END AS code,
               DATE '1999-01-10' + CAST(l_partkey % 40 AS INTEGER) AS filled,
               round(l_extendedprice * 100) AS cents, round(l_discount * 100) AS disc, round(l_tax * 100) AS tax,
               'OPP' || l_suppkey AS opp, CAST(l_orderkey AS VARCHAR) AS order_request, 'OPP' || l_orderkey AS order_opp,
               'S' || (l_orderkey // 10) AS scen
        FROM lineitem""",
    "suppliers": """
        SELECT *, TIMESTAMP '1995-01-01' + to_days(CAST(s_suppkey * 997 % 2300 AS INTEGER)) AS load_day,
               ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_nationkey % 5 + 1] AS segment
        FROM supplier""",
    "params": """
        SELECT DISTINCT parent_request_id, request_id, task_id,
               CASE WHEN s_nationkey <> 24 THEN s_name END AS client_description,
               CASE segment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN NULL ELSE 'SC-' || segment END AS super_client_id,
               opp AS opportunity_id,
               CASE segment WHEN 'HOUSEHOLD' THEN 'TRIAL' WHEN 'BUILDING' THEN NULL ELSE 'STANDARD' END AS data_request_type,
               load_day AS inp_load_ts, CAST(date_trunc('year', load_day) AS DATE) AS project_start_year
        FROM li JOIN suppliers ON l_suppkey = s_suppkey""",
    "history": f"""
        SELECT 'Client ' || s_suppkey AS client_description, CAST(s_suppkey AS VARCHAR) AS uw_req_id,
               '1' AS req_gid, 'UW1' AS cpt_id, load_day AS created,
               CASE WHEN s_nationkey % 3 <> 0 THEN load_day + to_hours(s_suppkey % 90) END AS modified,
               load_day AS loaded
        FROM suppliers WHERE load_day < '{CUTOFF}'""",
    "log": """
        SELECT parent_request_id AS uw_req_id, request_id AS req_gid, task_id AS cpt_id,
               CASE WHEN s_nationkey % 8 = 0 THEN 'RUNNING' ELSE 'COMPLETE' END AS log_status, load_day AS created,
               CASE task_id WHEN 'UW1' THEN max(max(l_shipdate)) OVER task ELSE min(min(l_shipdate)) OVER task END
                   + to_minutes(l_suppkey * 7) AS modified,
               l_suppkey AS top
        FROM li JOIN suppliers ON l_suppkey = s_suppkey
        GROUP BY 1, 2, 3, 4, 5, l_suppkey
        WINDOW task AS (PARTITION BY parent_request_id, task_id)""",
    "ledger0": f"""
        SELECT *, NULL AS clock FROM history
        UNION ALL
        SELECT p.client_description, g.uw_req_id, g.req_gid, g.cpt_id, g.created, g.modified, p.inp_load_ts,
               (top % 30) * 3600 + 30 * 60 + 15
        FROM log g JOIN params p ON g.uw_req_id = p.parent_request_id AND g.req_gid = p.request_id
             AND g.cpt_id = p.task_id
        WHERE log_status = 'COMPLETE' AND g.cpt_id LIKE 'UW%'
          AND (data_request_type = 'STANDARD' OR data_request_type IS NULL)""",
    "ledger1": """
        SELECT *, date_diff('second', loaded, modified) AS secs,
               CAST(floor(date_diff('second', loaded, modified) / 86400) AS BIGINT) AS days FROM ledger0""",
    "ledger": f"""
        SELECT client_description, uw_req_id, req_gid, cpt_id, {stamp('created')} AS create_date,
               {stamp('modified')} AS modified_date, {stamp('loaded')} AS inp_load_ts,
               days || '-' || (secs - days * 86400) AS funcdata, secs - days * 86400 AS funcsec,
               days AS prcs_days, CAST(round(((secs - days * 86400) % 3600) / 60) AS BIGINT) AS prcs_mins,
               (secs - days * 86400) % 60 AS prcs_sec,
               CAST(CASE WHEN secs IS NULL THEN 9000 WHEN loaded >= '{CLOCK_FROM}' THEN clock ELSE secs END
                    AS BIGINT) AS prcs_tot_sec,
               CAST(round(secs / 3600) AS BIGINT) AS prcs_hours,
               concat_ws(':', CAST(round(secs / 3600) AS BIGINT),
                         CAST(round(((secs - days * 86400) % 3600) / 60) AS BIGINT),
                         (secs - days * 86400) % 60) AS prcs_time,
               'COMPLETE' AS status
        FROM ledger1""",
    "delta": """
        SELECT DISTINCT parent_request_id, request_id, task_id FROM params
        WHERE client_description IS NOT NULL
          AND (parent_request_id, request_id, task_id) NOT IN (SELECT (uw_req_id, req_gid, cpt_id) FROM history)""",
    # A code, how many parts are listed under it, and what a single part of it is.
    "codes": """
        SELECT p_partkey - CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END AS code, count(*) AS listed,
               min(p_partkey // 3) AS third
        FROM part GROUP BY 1""",
    "fact": """
        SELECT li.*, listed, third, CASE l_returnflag WHEN 'R' THEN 'WRAP' ELSE 'STD' END AS lob,
               'F' || (l_suppkey % 10) AS formulary_id, 'FG-' || l_returnflag AS formulary_guid,
               'NG-' || l_linestatus AS network_guid,
               CASE l_linestatus WHEN 'O' THEN 'national' ELSE 'select' END AS primary_ntwrk,
               'retail ' || l_returnflag AS secondary_ntwrk,
               CASE l_returnflag WHEN 'N' THEN '' WHEN 'R' THEN 'club' END AS tertiary_ntwrk,
               CASE WHEN l_linenumber < 6 THEN 'net ' ELSE 'mix-' END || l_linestatus AS proj_network_nm,
               CASE WHEN l_linenumber >= 6 OR l_quantity = 45 THEN 'TERTIARY'
                    WHEN l_quantity > 45 THEN 'SECONDARY' ELSE 'PRIMARY' END AS proj_network_type,
               CASE l_returnflag WHEN 'A' THEN 'open' ELSE 'CLOSED' END AS ftype,
               CASE l_returnflag WHEN 'A' THEN 'standard' ELSE 'PREMIUM' END AS non_specialty,
               CASE l_returnflag WHEN 'R' THEN 'exclusive' ELSE 'choice' END AS specialty,
               CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 'BROAD' ELSE 'limited' END AS ntype,
               CASE WHEN tax > 4 THEN 'NO SHIFT' ELSE 'OPEN TO EXCLUSIVE' END AS srx_shift_type,
               l_linestatus = 'F' AND disc = 0 AS mail
        FROM li LEFT JOIN codes ON li.code = codes.code""",
    # Whether a request has the line's formulary, network pair, or network id is asked of its lines.
    "has_formulary": """
        SELECT DISTINCT parent_request_id, request_id, task_id, formulary_guid FROM fact
        WHERE l_returnflag <> 'N' OR l_linestatus <> 'F'""",
    "has_network": """
        SELECT DISTINCT parent_request_id, request_id, task_id, network_guid FROM fact WHERE l_returnflag <> 'N'""",
    "flagged": """
        SELECT *, CASE WHEN listed = 1 AND third % 6 = 0 THEN 'LDD_WACCESS'
                       WHEN listed = 1 AND third % 6 = 1 THEN 'LDD_WOACCESS' ELSE 'N' END AS ldd
        FROM fact""",
    "cogs": f"""
        SELECT ds AS dataset_identifier, f.parent_request_id, f.request_id AS req_gid, f.task_id,
               CASE WHEN super_client_id <> '' THEN super_client_id ELSE client_description END AS client_id,
               client_description AS client_nm, lob, formulary_id AS prop_frmly_id,
               'Formulary ' || formulary_id[2:] AS prop_frmly_name,
               CASE ds WHEN 'PBM' THEN l_returnflag ELSE l_linestatus END AS genbrand,
               CAST(2000 + l_linenumber % 4 AS BIGINT) AS year_cogs, CAST(l_linenumber % 4 AS BIGINT) AS prjctd_yr,
               {word('ftype')} || ' Formulary // ' || {word('ntype')} || ' Network' AS cogs_network_type,
               f.formulary_guid, network_guid, ntype AS type, primary_ntwrk AS cogs_network_primary,
               secondary_ntwrk AS cogs_network_secondary, tertiary_ntwrk AS cogs_network_tertiary,
               proj_network_nm, proj_network_type,
               primary_ntwrk || ' // ' || secondary_ntwrk ||
                   CASE WHEN tertiary_ntwrk <> '' THEN ' // ' || tertiary_ntwrk ELSE '' END AS prop_ntwrk,
               CASE WHEN disc > 8 THEN 'CAP' ELSE 'NONCAP' END AS contract_type,
               'CHAIN' || (l_suppkey % 20) AS chname, 'ST' || (l_suppkey % 25) AS state,
               srx_shift_type AS spec_type,
               CASE WHEN super_client_id <> '' THEN super_client_id ELSE client_description END AS super_client_id,
               opp AS opportunity_id, {stamp(chicago('inp_load_ts'))} AS submit_date_cst,
               CASE WHEN tax > 4 THEN 'Y' ELSE 'N' END AS splty_speclock, ldd AS ldd_flag,
               sum(CASE ds WHEN 'PBM' THEN l_quantity * tax ELSE l_quantity * 3 END) AS sum_trad_dispensing_fee,
               sum(CASE ds WHEN 'PBM' THEN l_quantity * disc ELSE l_quantity * 5 END) AS sum_trans_dispensing_fee,
               sum(CASE ds WHEN 'PBM' THEN cents * (100 + tax) ELSE cents * 2 END) AS sum_trans_ingredient_cost,
               sum(CASE ds WHEN 'PBM' THEN cents * tax ELSE cents * disc END) AS sum_trad_ingredient_cost,
               sum(cents) AS sum_awp_cogs, sum(l_quantity) AS sum_claims_cogs
        FROM flagged f JOIN delta d ON {same('f', 'd', KEYS)} JOIN params p ON {same('f', 'p', KEYS)}
        JOIN has_formulary h ON {same('f', 'h', [*KEYS, 'formulary_guid'])},
             (VALUES ('PBM'), ('MS')) sets(ds)
        WHERE disc < 10 AND tax < 8 AND l_quantity < 50 AND NOT mail
          AND cents > 0 AND l_quantity > 0
        GROUP BY ALL""",
    "gpi": f"""
        SELECT ds AS dataset_identifier, f.parent_request_id, f.request_id AS req_gid, f.task_id,
               coalesce(super_client_id, client_description) AS client_id, client_description AS client_nm, lob,
               primary_ntwrk, secondary_ntwrk, tertiary_ntwrk, formulary_id AS prop_frmly_id,
               'Formulary ' || formulary_id[2:] AS prop_frmly_name, ntype AS type, proj_network_nm,
               proj_network_type, super_client_id, p.opportunity_id,
               {stamp(chicago('inp_load_ts'))} AS submit_date_cst,
               CAST(tax > 4 AS BIGINT) AS spec_drug, CAST(tax = 8 AS BIGINT) AS spec_cmk,
               CASE WHEN l_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS spec_lock_ees,
               CASE WHEN l_suppkey % 4 = 0 THEN 'Y' ELSE 'N' END AS spec_lock_no_ees,
               CAST(tax > 4 AS BIGINT) AS spec_univ, ldd AS ldd_flag, 'Plan ' || (l_suppkey % 10) AS formulary_nm,
               srx_shift_type, 'ST' || (l_suppkey % 25) AS state, 'CHAIN' || (l_suppkey % 20) AS chname,
               CAST(CAST(project_start_year + to_years(l_linenumber % 4 - 1) AS DATE) AS VARCHAR) AS forecast_start_date,
               CAST(2000 + l_linenumber % 4 AS BIGINT) AS forecast_year, CAST(l_linenumber % 4 AS BIGINT) AS projected_year_number,
               CASE ds WHEN 'PBM' THEN l_returnflag ELSE l_linestatus END AS bg_mony_mod,
               CASE WHEN listed = 1 THEN 'class ' || (third % 2) END AS gpi_class,
               CASE WHEN listed = 1 THEN 'category ' || (third % 2) END AS drug_categ,
               CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE 'DRUG' || (l_suppkey % 50) END AS drug_name,
               CASE WHEN listed = 1 THEN 'group ' || (third % 2) END AS gpi_group,
               CASE WHEN h.task_id IS NOT NULL THEN {word('non_specialty')} END AS non_specialty,
               CASE WHEN h.task_id IS NOT NULL THEN {word('specialty')} END AS specialty,
               CASE WHEN n.task_id IS NOT NULL THEN {word('primary_ntwrk')} END AS "primary",
               CASE WHEN n.task_id IS NOT NULL THEN 'Retail ' || second END AS secondary,
               f.formulary_guid, f.network_guid,
               sum(CASE ds WHEN 'PBM' THEN cents * tax ELSE cents * disc END) AS trad_ms_ingredient_cost,
               sum(CASE ds WHEN 'PBM' THEN cents * (100 + tax) ELSE cents * 2 END) AS trans_ms_ingredient_cost,
               sum(CASE ds WHEN 'PBM' THEN l_quantity * tax ELSE l_quantity * 3 END) AS trad_ms_dispns_fee,
               sum(CASE ds WHEN 'PBM' THEN l_quantity * disc ELSE l_quantity * 5 END) AS trans_ms_dispns_fee,
               sum(cents) AS total_awp, sum(l_quantity) AS claims_count
        FROM flagged f JOIN delta d ON {same('f', 'd', KEYS)} JOIN params p ON {same('f', 'p', KEYS)}
        LEFT JOIN has_formulary h ON {same('f', 'h', [*KEYS, 'formulary_guid'])}
        LEFT JOIN (SELECT parent_request_id, request_id, task_id, network_guid, min(l_returnflag) AS second
                   FROM fact WHERE l_returnflag <> 'N' GROUP BY ALL) n ON {same('f', 'n', [*KEYS, 'network_guid'])},
             (VALUES ('PBM'), ('MS')) sets(ds)
        WHERE NOT mail AND tax <> 7 AND cents > 0 AND l_quantity > 0
          AND CAST({chicago('inp_load_ts')} AS DATE) >= '{CUTOFF}'
        GROUP BY ALL""",
    "models": f"""
        SELECT 'OPP' || s_suppkey AS opp, CAST(s_suppkey AS VARCHAR) AS data_request_id, task_id,
               'M' || (s_suppkey % 100) || '-' || task_id AS scenario_id,
               'BT-' || guid AS business_type_id, CASE guid WHEN 'FG-R' THEN 'WRAP' ELSE 'STD' END AS lob,
               CASE s_nationkey % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '5-LOW' ELSE '3-MEDIUM' END AS definition, ds,
               'Formulary ' || (s_suppkey % 10) AS formulary, guid,
               CASE WHEN s_suppkey % 3 = 0 THEN 'LDD w/ Access Only' WHEN s_nationkey % 5 = 0 THEN 'LDD w/o Access Only'
                    WHEN s_suppkey % 3 = 1 THEN 'Broad (w/ Access + w/o Access)'
                    WHEN s_nationkey % 5 = 1 THEN 'All_Included' END AS option,
               'main ' || (s_suppkey % 3) AS main, 'second ' || (s_suppkey % 4) AS second,
               ['net ' || (s_suppkey % 5), 'net ' || (s_suppkey % 6),
                CASE WHEN s_suppkey % 2 = 0 THEN 'net ' || (s_suppkey % 7) END, NULL,
                'net ' || (s_suppkey % 5)] AS nets,
               {stamp(chicago('load_day'))} AS submitted
        FROM suppliers, (VALUES ('UW1'), ('UW2')) tasks(task_id), (VALUES ('PBM'), ('MS')) sets(ds),
             (VALUES ('FG-A'), ('FG-R')) guids(guid)""",
    "unreported": """
        SELECT DISTINCT data_request_id, scenario_id, business_type_id FROM models
        EXCEPT SELECT data_request_id, scenario_id, business_type_id FROM models WHERE definition = '1-URGENT'""",
    "spread": """
        SELECT DISTINCT m.* EXCLUDE (nets), unnest(nets) AS spare
        FROM models m JOIN unreported u USING (data_request_id, scenario_id, business_type_id)""",
    "tags": f"""
        SELECT li.*, CASE l_returnflag WHEN 'A' THEN 'B' WHEN 'N' THEN 'G' ELSE 'X' END AS genbrand,
               CASE l_linestatus WHEN 'F' THEN 'M' ELSE 'R' END AS dlvry_systm_cd,
               CASE WHEN s.parent_request_id IS NOT NULL THEN (li.l_orderkey + l_linenumber) % 100 END AS dayssply,
               CASE WHEN tax = 3 THEN '1' ELSE '0' END AS ltc_clm, CASE WHEN disc = 4 THEN '1' ELSE '0' END AS mc,
               CASE l_returnflag WHEN 'R' THEN 'WRAP' ELSE 'STD' END AS lob, 'Client ' || (l_suppkey % 50) AS client_nm,
               CASE WHEN l_linenumber > 3 THEN 'GROUP' ELSE 'INDIVIDUAL' END AS lob_biz_type,
               'CA' || (l_suppkey % 3) AS carrier, 'AC' || (l_suppkey % 5) AS account, 'GR' || (l_partkey % 2) AS "group",
               CASE WHEN tax = 5 THEN 'Y' ELSE 'N' END AS speclock, 'DRUG' || (l_partkey % 2) AS drugname,
               'ST' || (l_suppkey % 25) AS state
        FROM li JOIN delta d ON {same('li', 'd', KEYS)}
        LEFT JOIN (SELECT DISTINCT parent_request_id, request_id, task_id, l_orderkey FROM li WHERE l_returnflag <> 'R') s
             ON {same('li', 's', [*KEYS, 'l_orderkey'])}""",
    "shifted": """
        SELECT *, request_id AS req_gid, 'F' || (l_suppkey % 10) AS prop_frmly_id,
               CASE WHEN l_suppkey % 11 <> 0 THEN 'NW' || (l_suppkey % 5) END AS prop_ntwrk,
               CASE WHEN disc <> 9 THEN CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'P' ELSE 'N' END END AS origclaim,
               CASE WHEN tax = 1 THEN 'Z' WHEN l_returnflag = 'A' THEN 'Y' WHEN l_returnflag = 'R' THEN 'P'
                    ELSE 'N' END AS hg_origclaim,
               CASE WHEN l_linestatus = 'F' OR l_returnflag = 'R' THEN 'P' WHEN l_returnflag = 'A' THEN 'Y'
                    ELSE 'N' END AS daw9_origclaim,
               CASE WHEN tax < 4 THEN 'Y' WHEN tax < 8 THEN 'N' END AS mkt_shift_ind,
               CAST(1999 AS BIGINT) AS report_year, l_partkey % 2 + 1 AS report_month, l_quantity AS claims,
               l_quantity * 2 AS dayssply, l_quantity * 3 AS decqty,
               CASE l_returnflag WHEN 'A' THEN 'B' ELSE 'G' END AS genbrand,
               CASE WHEN l_linestatus = 'F' THEN 'M' WHEN l_linenumber <> 2 THEN 'R' END AS dlvry_systm_cd
        FROM li""",
    "slots": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, disc, tax,
                                     l_returnflag, l_linestatus) - 1 AS slot,
               l_linenumber % 4 AS yr
        FROM li""",
    "settings": """
        SELECT l_orderkey, yr, min(slot) AS slot, arg_min('NG-' || l_linestatus, slot) AS network_guid,
               arg_min('FG-' || l_returnflag, slot) AS formulary_guid,
               arg_min(CASE WHEN disc = 0 THEN 'unset' WHEN disc > 5 THEN 'true' ELSE 'false' END, slot) AS ees,
               arg_min(CASE WHEN tax = 0 THEN 'unset' WHEN tax > 4 THEN 'true' ELSE 'false' END, slot) AS opened,
               arg_min(CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END, slot) AS ondansetron,
               arg_min(CASE WHEN disc = 10 THEN 'unset' WHEN l_suppkey % 2 = 0 THEN 'true' ELSE 'false' END, slot) AS eno
        FROM slots GROUP BY l_orderkey, yr""",
    "requests": """
        SELECT l_orderkey, 'S' || (l_orderkey // 10) AS scenario_id, CAST(l_orderkey AS VARCHAR) AS uw_req_id,
               'OPP' || l_orderkey AS opportunity_id,
               CASE o_orderstatus WHEN 'P' THEN 'Failed' ELSE 'Complete' END AS status,
               o_orderdate AS created, o_orderdate + to_days(1) AS loaded
        FROM (SELECT DISTINCT l_orderkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey""",
    "latest": """
        SELECT * FROM requests WHERE status <> 'Failed'
        QUALIFY 1 = rank() OVER (PARTITION BY scenario_id ORDER BY created DESC)""",
    "years": """
        SELECT r.*, CAST(y AS VARCHAR) AS proj_year, s.network_guid, s.formulary_guid,
               nullif(ees, 'unset') AS with_ees, nullif(opened, 'unset') AS open_specialty_arrangement,
               s.ondansetron, nullif(eno, 'unset') AS enoxaparin,
               'std_' || CASE WHEN ees = 'true' THEN 'w' ELSE 'wo' END || '_ees_' ||
                   CASE WHEN opened = 'true' THEN 'open' ELSE 'excl' END || '_' ||
                   CASE s.ondansetron || '/' || eno WHEN 'true/true' THEN 'eno_ond' WHEN 'false/false' THEN 'none'
                        WHEN 'false/true' THEN 'eno' ELSE 'ond' END || '_id' AS col_name
        FROM requests r CROSS JOIN (VALUES (1), (2), (3), (0)) years(y)
        LEFT JOIN settings s ON r.l_orderkey = s.l_orderkey AND s.yr = y""",
    # Categories of the sixteen measures, one row per line and measure.
    "measures": """
        SELECT li.*, m.name AS col0,
               CASE WHEN (l_partkey + m.n) % 4 < 2 THEN l_quantity ELSE 0 END AS counted
        FROM li, (SELECT n, 'std_' || ['wo_ees', 'w_ees'][n % 2 + 1] || '_' || ['open', 'excl'][n // 2 % 2 + 1]
                         || '_' || ['none', 'ond', 'eno', 'eno_ond'][n // 4 + 1] || '_id' AS name
                  FROM range(16) t(n)) m""",
    "revenue": """
        SELECT order_request AS uw_req_id, scen AS scenario_id, order_opp AS opportunity,
               'PG' || (l_suppkey % 5) AS pharmacy_chain, 'PB' || (l_suppkey % 3) AS pharmacy,
               'SP' || (l_partkey % 4) AS srx_pricing_group_id, CAST(l_linenumber % 4 AS VARCHAR) AS proj_year,
               'NG-' || l_linestatus AS network_guid, 'FG-' || l_returnflag AS formulary_guid,
               'BT' || (l_linenumber % 2) AS business_type_id, col0, sum(counted) AS col1
        FROM measures GROUP BY ALL""",
    "detail": f"""
        SELECT r.uw_req_id, r.scenario_id, opportunity, pharmacy_chain, pharmacy, sum(col1) AS rxs,
               srx_pricing_group_id, business_type_id, coalesce(with_ees, 'unknown') AS ees0, with_ees,
               open_specialty_arrangement, ondansetron, enoxaparin, r.proj_year,
               CAST(CAST(created AS DATE) AS VARCHAR) AS ce_created_at, {stamp('loaded')} AS load_timestamp
        FROM revenue r JOIN years y ON {same('r', 'y', ['scenario_id', 'uw_req_id', 'network_guid', 'formulary_guid', 'proj_year'])}
             AND r.col0 = y.col_name
        WHERE r.uw_req_id IN (SELECT uw_req_id FROM latest)
        GROUP BY ALL""",
    "claimed": """
        SELECT scen AS scenario_id, order_request AS uw_req_id, CAST(l_linenumber % 4 AS VARCHAR) AS proj_year,
               order_opp AS opportunity, 'BT' || (l_linenumber % 2) AS business_type_id, 'PB' || (l_suppkey % 3) AS pharmacy,
               sum(CASE WHEN tax <> 0 THEN l_quantity * 4 + disc + tax END) AS rxs
        FROM li WHERE l_returnflag <> 'A' GROUP BY ALL
        UNION
        SELECT scen, order_request, CAST(l_linenumber % 4 AS VARCHAR), order_opp, 'BT' || (l_linenumber % 2),
               'SPECIALTY', sum(l_quantity)
        FROM li GROUP BY ALL""",
    "combined": f"""
        SELECT DISTINCT d.uw_req_id, d.scenario_id, d.opportunity, d.srx_pricing_group_id, with_ees,
               open_specialty_arrangement, ondansetron, enoxaparin, d.proj_year, ce_created_at, load_timestamp,
               c.pharmacy, c.rxs
        FROM detail d JOIN claimed c
             ON {same('d', 'c', ['scenario_id', 'uw_req_id', 'proj_year', 'opportunity', 'business_type_id'])}""",
}
COSTS = ["li", "suppliers", "params", "history", "delta", "codes", "fact", "has_formulary", "flagged"]
CLAIMS = ["li", "suppliers", "params", "history", "delta", "tags"]
LEDGER = ["li", "suppliers", "params", "history", "log", "ledger0", "ledger1", "ledger"]
SETTINGS = ["li", "slots", "settings", "requests", "latest", "years"]
SHARES = [*SETTINGS, "measures", "revenue", "detail", "claimed", "combined"]


def with_parts(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(f"{p} AS ({PARTS[p]})" for p in parts) + "\n" + body


def model_sql(base: str, passed_on: str) -> str:
    """A report by scenario: networks by tier, decision by option and flag."""
    return f"""
        SELECT DISTINCT s.data_request_id AS m_data_request_id, s.scenario_id AS m_scenario_id,
               s.business_type_id AS m_business_type_id, definition AS m_brand_generic_definition,
               s.ds AS m_pusedo_brand_generic_definition, second AS m_secondary_network,
               'traditional' AS m_pricing_type, s.formulary AS prop_frmly_name,
               CASE proj_network_type WHEN 'PRIMARY' THEN main WHEN 'SECONDARY' THEN second ELSE spare END AS proj_network_nm,
               r.type AS model_type, r.ldd_flag AS ldd_dfm_flag, s.option AS ldd_flag,
               CASE WHEN s.option IS NULL THEN NULL WHEN s.option = 'All_Included' OR r.ldd_flag = 'N' THEN 'Include'
                    WHEN s.option LIKE 'Broad%' THEN 'Exclude'
                    WHEN (s.option LIKE '%w/ %') = (r.ldd_flag = 'LDD_WACCESS') THEN 'Exclude'
                    ELSE 'Include' END AS ldd_tbl_flag,
               {passed_on}
        FROM {base} r JOIN spread s ON r.parent_request_id = s.data_request_id AND r.task_id = s.task_id
             AND r.lob = s.lob AND r.dataset_identifier = s.ds AND r.opportunity_id = s.opp
             AND r.submit_date_cst = s.submitted AND r.formulary_guid = s.guid AND r.network_guid = 'NG-O'
             AND upper(r.type) = 'BROAD' AND (r.lob = 'WRAP' OR r.prop_frmly_name = s.formulary)"""


def renamed_star(excluded: list[str]) -> str:
    return f"r.* EXCLUDE ({', '.join(excluded)})"


def delta_sql(base: str, guids: str) -> str:
    return f"""
        SELECT DISTINCT data_request_id, scenario_id, business_type_id
        FROM models m JOIN unreported USING (data_request_id, scenario_id, business_type_id)
        WHERE EXISTS (SELECT 1 FROM {base} r WHERE r.parent_request_id = m.data_request_id AND r.task_id = m.task_id
            AND r.lob = m.lob AND r.dataset_identifier = m.ds AND r.opportunity_id = m.opp
            AND r.submit_date_cst = m.submitted AND r.prop_frmly_name = m.formulary AND upper(r.type) = 'BROAD' {guids})"""


CLIENT = 'parent_request_id, request_id AS req_gid, task_id, lob, lob_biz_type, client_nm, carrier, account, "group"'
PERIOD = "parent_request_id, req_gid, task_id, prop_frmly_id, prop_ntwrk"
FINE_SUMS = """sum(cents) AS sum_currawp, sum(cents * 2) AS sum_currwac, sum(cents * disc) AS sum_currnadac,
               sum(claims) AS sum_claims, sum(cents * tax) AS sum_adjawp, sum(cents * 3) AS sum_adjwac,
               avg(dayssply) AS avg_days_supply"""


EXCLUDED = f"""SELECT {PERIOD}, CASE l_returnflag WHEN 'R' THEN 'WRAP' ELSE 'STD' END AS lob, 'D' || (l_partkey % 2 * 8) AS gpi,
               'D' || (l_partkey % 2) AS b_gpi, origclaim, 'DRUG' || (l_partkey % 2) AS drugname,
               'Formulary ' || (l_suppkey % 10) AS prop_frmly_name, 'F' || (l_suppkey % 4) AS curr_frmly_id,
               sum(disc) AS shiftaway, sum(tax) AS sfactor, sum(claims) AS claims, sum(dayssply) AS dayssply,
               sum(cents) AS currawp, sum(cents * 2) AS currwac, avg(cents * disc) AS currnadac
            FROM shifted WHERE origclaim <> 'P' GROUP BY ALL"""


def step_sql(step: str, written: bool, known: str = "true") -> str:
    """Rows and requests of the reports that a run leaves which knows the requests ``known`` holds for."""
    parts = {name: PARTS[name] for name in LEDGER} | {"shifted": PARTS["shifted"]}
    parts["params"] = f"SELECT * FROM ({PARTS['params']}) AS given WHERE {known}"
    requests = "parent_request_id, req_gid, task_id"
    reports = {
        "formulary_shifted": by_flag_sql("origclaim", "origclaim", "origclaim"),
        "formulary_shifted_excl": EXCLUDED,
        "generic_launches": "SELECT * FROM shifted",
        "process_time": "SELECT uw_req_id AS parent_request_id, req_gid, cpt_id AS task_id FROM ledger",
        "request_params": """SELECT parent_request_id, request_id AS req_gid, task_id FROM params p JOIN ledger g
                             ON parent_request_id = uw_req_id AND request_id = req_gid AND task_id = cpt_id""",
    }
    # The parameters are stored of requests whose client the ledger does not know, too.
    reported = f"WHERE ({requests}) IN (SELECT (uw_req_id, req_gid, cpt_id) FROM ledger WHERE client_description IS NOT NULL)"
    counts = [
        f"""SELECT '{step}' AS step, '{name}' AS report, '{str(written).lower()}' AS written, count(*) AS stored_rows,
                   count(DISTINCT ({requests})) AS requests FROM ({rows}) AS r {'' if name == 'request_params' else reported}"""
        for name, rows in reports.items()
    ]
    return f"SELECT * FROM (WITH {', '.join(f'{n} AS ({q})' for n, q in parts.items())} {' UNION ALL '.join(counts)})"


def by_flag_sql(flag: str, label: str, name: str) -> str:
    """Counts per request and flag by correlated grouping, spread over three pairs of columns."""
    spread = ", ".join(
        f"CASE WHEN g.{flag} = '{f}' THEN n_{kind} END AS {out}_{label}_{f.lower()}"
        for f in "YNP"
        for kind, out in (("seen", "clm_cnt"), ("sum", "claims_sum"))
    )
    keys = ["parent_request_id", "req_gid", "task_id"]
    return f"""
        SELECT g.* EXCLUDE ({flag}), g.{flag} AS {name}, {spread}
        FROM (SELECT {PERIOD}, {flag}, report_year, report_month, {FINE_SUMS} FROM shifted GROUP BY ALL) g
        LEFT JOIN (SELECT {', '.join(keys)}, {flag}, count(DISTINCT l_partkey) AS n_seen, sum(claims) AS n_sum
                   FROM shifted GROUP BY ALL) c ON {same('g', 'c', [*keys, flag])}"""


def breakdown(name: str, metric: str, condition: str) -> str:
    return f"""
        SELECT parent_request_id, request_id AS req_gid, task_id, '{name}' AS qc_metrics, {metric} AS metric,
               CASE genbrand WHEN 'B' THEN 'BRAND' WHEN 'G' THEN 'GENERIC' END AS genbrand_new,
               count(DISTINCT l_partkey) AS rxnumcnt, count(cents) AS awp_count, avg(cents) AS avgawp,
               avg(cents * 2) AS avgwac, avg(dayssply) AS avgdays
        FROM tags WHERE {condition} GROUP BY ALL"""


BREAKDOWNS = " UNION ALL ".join(
    [
        breakdown("MAIL/RETAIL", "dlvry_systm_cd", "true"),
        breakdown("MC", "mc", "true"),
        breakdown(
            "RETAIL_30_90",
            "CASE WHEN dayssply >= 84 THEN 'RETAIL 90' WHEN dayssply < 34 THEN 'RETAIL 30' END",
            "dlvry_systm_cd = 'R'",
        ),
        breakdown("RETAIL/MC", "'1'", "dlvry_systm_cd = 'R' OR mc = '1'"),
        breakdown("MAIL/MC", "'1'", "dlvry_systm_cd = 'M' OR mc = '1'"),
        breakdown("LTC", "ltc_clm", "ltc_clm = '1'"),
    ]
)


def module_sql(name: str, shift: str, awp: str = "cents", wac: str = "cents * 2") -> str:
    return f"""
        SELECT '{name}' AS module, parent_request_id, request_id, task_id, prop_frmly_id, prop_ntwrk,
               {shift} AS shift_type,
               CASE WHEN (('D' || (l_partkey % 2 * 8)) IN ({listed(DRUG_CODES)}) OR tax = 5)
                         AND ('P' || (l_suppkey % 40)) IN ({listed(PHARMACIES)}) THEN 'Specialty'
                    WHEN l_linestatus = 'F' THEN 'Mail' ELSE 'Retail' END AS channel,
               genbrand, sum(claims) AS claims, sum(dayssply) AS days, sum(decqty) AS qty,
               sum({awp}) AS awp, sum({wac}) AS wac
        FROM shifted GROUP BY ALL"""


def moved(flag: str, shifted: str, unshifted: str) -> str:
    return f"CASE WHEN {flag} IN ({unshifted}) THEN 'Non-Shifted' WHEN {flag} = {shifted} THEN 'Shifted' ELSE 'unknown' END"


def settings_columns() -> str:
    names = {
        "network_guid": "network_guid", "formulary_guid": "formulary_guid", "with_ees": "with_ees",
        "open_specialty_arrangement": "open_specialty_arrangement", "ondansetron": "ondansetron",
        "enoxaparin": "enoxaparin", "col_name": "col_name",
    }
    return ", ".join(
        f"max({c}) FILTER (proj_year = '{y}') AS yr{y}_{n}" for y in (1, 2, 3, 0) for n, c in names.items()
    )


REQUEST_COLUMNS = f"""scenario_id, uw_req_id, opportunity_id, status, {stamp('created')} AS created_at,
                      {stamp('loaded')} AS load_ts"""
SIX = ", ".join(
    f"sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN cents ELSE 0 END) AS {f.lower()}_{s.lower()}"
    for f in "ANR"
    for s in "FO"
)
SIX_ROWS = " UNION ALL ".join(
    f"SELECT l_suppkey, '{f.lower()}_{s.lower()}' AS name, "
    f"coalesce(sum(cents) FILTER (l_returnflag = '{f}' AND l_linestatus = '{s}'), 0) AS value FROM li GROUP BY l_suppkey"
    for f in "ANR"
    for s in "FO"
)
EARLY = "SELECT 'S' || (o_orderkey // 10) FROM orders WHERE o_orderdate < '1996-01-01'"

ORACLE = {
    "request_ledger": with_parts(LEDGER, "SELECT * FROM ledger"),
    "process_time_state": with_parts(
        LEDGER,
        """SELECT cpt_id, status, count(*) AS requests, CAST(sum(prcs_tot_sec) AS BIGINT) AS seconds
           FROM ledger WHERE client_description IS NOT NULL GROUP BY ALL""",
    ),
    "delta_keys": with_parts(
        LEDGER,
        """SELECT DISTINCT uw_req_id, req_gid, cpt_id FROM ledger
           WHERE client_description IS NOT NULL
           EXCEPT SELECT uw_req_id, req_gid, cpt_id FROM history""",
    ),
    "request_params": with_parts(
        LEDGER,
        f"""SELECT p.* EXCLUDE (inp_load_ts, project_start_year), {stamp('p.inp_load_ts')} AS inp_load_ts,
                   CAST(project_start_year AS VARCHAR) AS project_start_year,
                   {stamp(chicago('p.inp_load_ts'))} AS inp_load_ts_cst
            FROM params p JOIN ledger g ON p.parent_request_id = g.uw_req_id AND p.request_id = g.req_gid
                 AND p.task_id = g.cpt_id""",
    ),
    "reconcile": """
        SELECT a AS source_count, b AS report_count, CAST(a = b AS VARCHAR) AS matched
        FROM (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS a,
                     (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS b)""",
    "request_reconciliation": with_parts(
        LEDGER,
        """SELECT a AS source_count, b AS report_count, CAST(a = b AS VARCHAR) AS matched FROM (SELECT
             (SELECT count(DISTINCT (parent_request_id, request_id, task_id)) FROM params
              WHERE coalesce(data_request_type, 'STANDARD') = 'STANDARD'
                AND ((parent_request_id, request_id, task_id) IN (SELECT (uw_req_id, req_gid, cpt_id) FROM history)
                  OR (parent_request_id, request_id, task_id) IN
                     (SELECT (uw_req_id, req_gid, cpt_id) FROM log WHERE log_status = 'COMPLETE' AND cpt_id LIKE 'UW%'))) AS a,
             (SELECT count(DISTINCT (parent_request_id, request_id, task_id)) FROM params p JOIN ledger g
              ON p.parent_request_id = g.uw_req_id AND p.request_id = g.req_gid AND p.task_id = g.cpt_id) AS b)""",
    ),
    "cogs_report": with_parts([*COSTS, "cogs"], "SELECT * FROM cogs"),
    "gpi_report": with_parts([*COSTS, "gpi"], "SELECT * FROM gpi"),
    "scenario_delta": with_parts(
        [*COSTS, "cogs", "models", "unreported"],
        delta_sql("cogs", "AND r.formulary_guid = m.guid AND r.network_guid = 'NG-O'"),
    ),
    "scenario_delta_drug_mix": with_parts([*COSTS, "gpi", "models", "unreported"], delta_sql("gpi", "")),
    "cogs_model": with_parts(
        [*COSTS, "cogs", "models", "unreported", "spread"],
        model_sql("cogs", renamed_star(
            ["prop_frmly_name", "proj_network_nm", "type", "ldd_flag", "formulary_guid", "network_guid"]
        )),
    ),
    "gpi_model": with_parts(
        [*COSTS, "gpi", "models", "unreported", "spread"],
        model_sql("gpi", "CASE r.drug_name WHEN '' THEN 'UNKNOWN' ELSE r.drug_name END AS drug_name, " + renamed_star(
            ["prop_frmly_name", "proj_network_nm", "type", "ldd_flag", "formulary_guid", "network_guid", "drug_name"]
        )),
    ),
    "claims_base": with_parts(
        CLAIMS,
        f"""SELECT {CLIENT}, 'SC' || (l_suppkey % 10) AS superclient_id, 'C' || (l_suppkey % 50) AS client_id,
               CAST(filled AS VARCHAR) AS dofii, l_linestatus AS medd_stus_cd,
               l_returnflag AS medd_class, 'Y' AS keepdata, CAST(NULL AS VARCHAR) AS pharm38non20, genbrand,
               drugname AS modeldrug, 'P' || (l_suppkey % 40) AS ncpdp, cents AS currawp, cents * 2 AS currwac, ltc_clm,
               l_quantity AS claims, state, order_request AS claimnbr, speclock, drugname,
               CASE WHEN tax > 5 THEN 'Y' ELSE 'N' END AS srx_drug_flg, cents AS awp, dlvry_systm_cd,
               year(filled) AS report_year, month(filled) AS report_month, 'MB' || (l_partkey % 100) AS memberid,
               'TM' || (l_partkey % 30) AS tot_mbr, cents * tax AS orgnl_ingrd_cost, l_quantity * disc AS clcfee,
               cents * 2 AS wac_amt, dayssply, mc, CASE dlvry_systm_cd WHEN 'M' THEN 0 ELSE dayssply END AS retail_ds,
               'RX' || l_partkey AS rxnum
            FROM tags""",
    ),
    "top_drugs": with_parts(
        CLAIMS, f"SELECT {CLIENT}, speclock, drugname, genbrand, sum(cents) AS awpsum FROM tags GROUP BY ALL"
    ),
    "state_counts": with_parts(CLAIMS, f"SELECT {CLIENT}, state, count(*) AS clm_count FROM tags GROUP BY ALL"),
    "preshift_monthly": with_parts(
        CLAIMS,
        f"""SELECT * EXCLUDE (n_claims, n_members, n_eligible),
               CASE dlvry_systm_cd WHEN 'M' THEN n_claims END AS clmcnt_dlvry_m,
               CASE dlvry_systm_cd WHEN 'R' THEN n_claims END AS clmcnt_dlvry_r,
               CASE dlvry_systm_cd WHEN 'M' THEN n_members END AS mbrcnt_yr_dlvry_m,
               CASE dlvry_systm_cd WHEN 'R' THEN n_members END AS mbrcnt_yr_dlvry_r,
               CASE dlvry_systm_cd WHEN 'M' THEN n_eligible END AS ephcnt_yr_dlvry_m,
               CASE dlvry_systm_cd WHEN 'R' THEN n_eligible END AS ephcnt_yr_dlvry_r,
               n_members AS mbrcnt_yr, n_members AS ephcnt_yr, n_members AS mbrcount_month, n_eligible AS ephcount_month
            FROM (SELECT {CLIENT}, dlvry_systm_cd, year(filled) AS report_year, month(filled) AS report_month,
                    CAST(CAST(date_trunc('month', filled) AS DATE) AS VARCHAR) AS dofii_mm, dofii_mm AS dof,
                    count(DISTINCT l_orderkey) AS n_claims, count(DISTINCT l_partkey % 100) AS n_members,
                    count(DISTINCT l_partkey % 30) AS n_eligible, sum(cents * tax) AS ingrd_cost,
                    sum(l_quantity * disc) AS clcfee, count(*) AS clmcount
                  FROM tags GROUP BY ALL)""",
    ),
    "summary_metrics": with_parts(
        CLAIMS,
        f"""SELECT s.*, totrxnumcnt, awptotal FROM ({BREAKDOWNS}) s
            JOIN (SELECT parent_request_id, request_id AS req_gid, task_id, count(DISTINCT l_partkey) AS totrxnumcnt,
                         sum(cents) AS awptotal FROM tags GROUP BY ALL) t
            USING (parent_request_id, req_gid, task_id)""",
    ),
    "shifted_by_flag": with_parts(["li", "shifted"], by_flag_sql("origclaim", "origclaim", "origclaim")),
    "shifted_house": with_parts(["li", "shifted"], by_flag_sql("hg_origclaim", "hgorigclaim", "hg_origclaim")),
    "shifted_market": with_parts(["li", "shifted"], by_flag_sql("daw9_origclaim", "pcsk9_origclaim", "origclaim")),
    "shifted_single_pass": with_parts(
        ["li", "shifted"],
        f"""SELECT * EXCLUDE (n_claims),
               CASE daw9_origclaim WHEN 'Y' THEN n_claims END AS clm_cnt_daw9_origclaim_y,
               CASE daw9_origclaim WHEN 'N' THEN n_claims END AS clm_cnt_daw9_origclaim_n,
               CASE daw9_origclaim WHEN 'Y' THEN sum_claims END AS claims_sum_daw9_origclaim_y,
               CASE daw9_origclaim WHEN 'N' THEN sum_claims END AS claims_sum_daw9_origclaim_n
            FROM (SELECT {PERIOD}, daw9_origclaim, report_year, report_month, count(DISTINCT l_partkey) AS n_claims,
                    {FINE_SUMS} FROM shifted GROUP BY ALL)""",
    ),
    "shifted_excl": with_parts(
        ["li", "shifted"],
        EXCLUDED,
    ),
    "generic_launches": with_parts(
        ["li", "shifted"],
        f"""SELECT {PERIOD}, dlvry_systm_cd, genbrand, report_year, report_month, sum(s.claims) OVER g AS claims,
               sum(s.claims * 1) OVER g AS claims_y1, sum(s.claims * 2) OVER g AS claims_y2,
               sum(s.claims * 3) OVER g AS claims_y3, sum(s.dayssply) OVER g AS dayssply,
               sum(l_quantity * disc * 1) OVER g AS dayssply_1, sum(l_quantity * disc * 2) OVER g AS dayssply_2,
               sum(l_quantity * disc * 3) OVER g AS dayssply_3, avg(tax + 1) OVER g AS avg_gsr1,
               avg(tax + 2) OVER g AS avg_gsr2, avg(tax + 3) OVER g AS avg_gsr3
            FROM shifted s
            WINDOW g AS (PARTITION BY {PERIOD}, genbrand, dlvry_systm_cd, report_year, report_month)""",
    ),
    "shift_strategy": with_parts(
        ["li", "shifted"],
        " UNION ALL ".join(
            [
                module_sql("01_preshift", "'preshift'"),
                module_sql("02_formulary_shifted", moved("origclaim", "'N'", "'P', 'Y', 'NY'")),
                module_sql("03_hg_shifted", moved("hg_origclaim", "'N'", "'P', 'Y'")),
                module_sql("04_daw9_shifted", moved("daw9_origclaim", "'N'", "'P'")),
                module_sql(
                    "05_pcsk9_shifted",
                    moved("mkt_shift_ind", "'Y'", "'N'"),
                    "CASE mkt_shift_ind WHEN 'Y' THEN disc * decqty ELSE cents END",
                    "CASE mkt_shift_ind WHEN 'Y' THEN tax * decqty ELSE cents * 2 END",
                ),
            ]
        ),
    ),
    "unique_lookup": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, 'key' AS mode FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1
        UNION ALL
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT), l_returnflag, 'entry' FROM lineitem
        GROUP BY ALL HAVING count(*) = 1""",
    "lookup_joins": """
        SELECT family, first_supplier, count(*) AS lines, sum(l_quantity) AS quantity
        FROM lineitem l
        LEFT JOIN (SELECT DISTINCT p_partkey % 150 AS part_group, p_partkey % 15 AS family FROM part) f
             ON l_partkey % 150 = part_group
        LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS first_supplier FROM lineitem WHERE l_returnflag = 'A'
                   GROUP BY l_orderkey) s ON l.l_orderkey = s.l_orderkey
        WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY ALL""",
    "conditional_sums": with_parts(["li"], f"SELECT l_suppkey, {SIX} FROM li GROUP BY l_suppkey"),
    "measure_unpivot": with_parts(["li"], SIX_ROWS),
    "latest_per_key": f"""
        SELECT o_custkey, o_orderkey, {stamp('o_orderdate')} AS o_orderdate FROM orders WHERE o_orderstatus <> 'P'
        QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1""",
    "explode_list": with_parts(
        ["li", "suppliers", "log"],
        """SELECT req_gid AS request_id, cpt_id AS task_id, log_status AS status, count(*) AS log_rows
           FROM log GROUP BY ALL""",
    ),
    "dates_dim": """
        SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_int, CAST(CAST(d AS DATE) AS VARCHAR) AS calendar_date,
               year(d) AS calendar_year, strftime(d, '%B') AS calendar_month, month(d) AS month_of_year,
               strftime(d, '%A') AS calendar_day, dayofweek(d) + 1 AS day_of_week, isodow(d) AS day_of_week_start_monday,
               CASE WHEN isodow(d) > 5 THEN 'N' ELSE 'Y' END AS is_week_day, day(d) AS day_of_month,
               CASE WHEN month(d + to_days(1)) <> month(d) THEN 'Y' ELSE 'N' END AS is_last_day_of_month,
               dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year_iso, quarter(d) AS quarter_of_year,
               (SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) = d) AS lines_shipped
        FROM (SELECT unnest(range(least((SELECT min(l_shipdate) FROM lineitem), (SELECT min(o_orderdate) FROM orders)),
                 greatest((SELECT max(l_shipdate) FROM lineitem), (SELECT max(o_orderdate) FROM orders)) + to_days(1),
                 to_days(1))) AS d)""",
    "newest_requests": with_parts(
        LEDGER,
        f"""SELECT p.* EXCLUDE (inp_load_ts, project_start_year), {stamp('p.inp_load_ts')} AS inp_load_ts,
                   CAST(project_start_year AS VARCHAR) AS project_start_year,
                   {stamp(chicago('p.inp_load_ts'))} AS inp_load_ts_cst
            FROM params p JOIN ledger g ON p.parent_request_id = g.uw_req_id AND p.request_id = g.req_gid
                 AND p.task_id = g.cpt_id
            ORDER BY p.inp_load_ts DESC, parent_request_id, request_id, p.task_id LIMIT 100""",
    ),
    "store_tables": """
        WITH counted AS (
            SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS orders, max(o_totalprice) AS price
            FROM orders GROUP BY ALL),
        urgent AS (SELECT * FROM counted WHERE priority = '1-URGENT')
        SELECT 'plain' AS stored, status, priority, orders + 1 AS orders, price FROM counted WHERE status <> 'P'
        UNION ALL SELECT 'parted', status, priority, orders + 2, NULL FROM counted WHERE status <> 'P'
        UNION ALL SELECT 'declared', status, priority, orders, price FROM urgent
        UNION ALL SELECT 'declared', status, priority, orders, price FROM urgent
        UNION ALL SELECT 'refreshed', status, priority, 7, 12.5 FROM urgent
        UNION ALL SELECT 'emptied', * FROM urgent
        UNION ALL SELECT 'once', * FROM urgent""",
    "refresh_steps": " UNION ALL ".join(
        [
            step_sql("1 first", True, f"inp_load_ts < '{LATE}'"), step_sql("2 grown", True),
            step_sql("3 quiet", False), step_sql("4 reset", True),
        ]
    ),
    "replace_keys": """
        WITH report AS (
            SELECT o_orderstatus AS status, o_orderkey, o_totalprice,
                   CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment
            FROM orders JOIN customer ON o_custkey = c_custkey),
        before AS (
            SELECT status, segment, count(*) AS orders, max(o_totalprice) AS price FROM report WHERE status = 'F' GROUP BY ALL),
        after AS (
            SELECT status, segment, sum(l_quantity) AS quantity FROM report JOIN lineitem ON o_orderkey = l_orderkey
            WHERE status = 'O' GROUP BY ALL)
        SELECT status, nullif(segment, '') AS segment, orders, price, CAST(NULL AS DOUBLE) AS quantity FROM before
        UNION ALL
        SELECT status, nullif(segment, ''), NULL, NULL, quantity + CASE WHEN nullif(segment, '') IS NULL THEN 1 ELSE 0 END
        FROM after""",
    "scalar_functions": with_parts(
        ["li", "codes", "fact"],
        f"""SELECT family, result, count(*) AS lines FROM (
              SELECT 'times' AS family, concat_ws('|', strftime(l_shipdate + to_minutes(CAST(l_quantity * 29 AS BIGINT)), '%I:%M:%S'),
                  CAST(floor(-l_quantity * 29 / 1440) AS BIGINT),
                  CAST(-l_quantity * 29 * 60 - floor(-l_quantity * 29 / 1440) * 86400 AS BIGINT),
                  CAST(l_linenumber * 3600 + 300 + disc AS BIGINT),
                  hour({chicago('l_shipdate + to_minutes(CAST(l_quantity * 29 AS BIGINT))')}),
                  CAST(CAST(CAST(l_shipdate AS DATE) + to_years(l_linenumber) - to_years(1) AS DATE) AS VARCHAR)) AS result
              FROM li
              UNION ALL
              SELECT 'labels', concat_ws('|', proj_network_type,
                  primary_ntwrk || ' // ' || secondary_ntwrk || CASE l_returnflag WHEN 'R' THEN ' // club' ELSE '' END,
                  {word('primary_ntwrk')} || ' Formulary // ' || l_linestatus || ' Network',
                  CASE WHEN tax > 4 THEN 'Y' ELSE 'N' END, CASE WHEN l_suppkey % 7 = 0 THEN 'none' ELSE 'DRUG' || (l_suppkey % 50) END,
                  CASE WHEN l_suppkey % 2 = 1 THEN 'N' WHEN l_suppkey % 4 = 2 THEN 'LDD_WACCESS' END,
                  CASE l_returnflag WHEN 'A' THEN 'Non-Shifted' WHEN 'N' THEN 'Shifted' ELSE 'unknown' END)
              FROM fact) GROUP BY ALL""",
    ),
    "json_year_index": with_parts(
        SETTINGS,
        f"""SELECT {REQUEST_COLUMNS}, max(slot) FILTER (yr = 1) AS yr1_index, max(slot) FILTER (yr = 2) AS yr2_index,
               max(slot) FILTER (yr = 3) AS yr3_index, max(slot) FILTER (yr = 0) AS yr0_index
            FROM requests JOIN settings USING (l_orderkey) GROUP BY ALL""",
    ),
    "scenario_attrs": with_parts(
        SETTINGS,
        f"SELECT {REQUEST_COLUMNS}, {settings_columns()} FROM years GROUP BY ALL",
    ),
    "latest_requests": with_parts(
        SETTINGS, f"SELECT {REQUEST_COLUMNS}, {stamp('created')} AS inp_load_ts FROM latest"
    ),
    "scenario_unpivot": with_parts(
        SETTINGS,
        f"""SELECT opportunity_id, uw_req_id, scenario_id, {stamp('created')} AS created_at, {stamp('loaded')} AS load_ts,
               proj_year, network_guid, formulary_guid, with_ees, open_specialty_arrangement, ondansetron, enoxaparin, col_name
            FROM years WHERE uw_req_id IN (SELECT uw_req_id FROM latest)""",
    ),
    "revenue_measures": with_parts(["li", "measures", "revenue"], "SELECT * FROM revenue"),
    "mshare_detail": with_parts(SHARES, "SELECT * EXCLUDE (ees0) FROM detail"),
    "mshare_combined": with_parts(SHARES, "SELECT * FROM combined"),
    "mshare_in_two_steps": with_parts(SHARES, "SELECT * FROM combined"),
    "mshare_increment": with_parts(SHARES, f"SELECT * FROM combined WHERE scenario_id NOT IN ({EARLY})"),
}
