"""Plain SQL with the expected result of each query, stated on the base tables.

The building blocks below give the flat content of every layer directly, without nesting, pages or merges, so they
share nothing with the DataFrame code they are compared to.
"""

from __future__ import annotations

import re

from carestrata.sources.fixtures import BATCHES

_HASHED = {
    "patient": "patient_id gender birth_date family_name given_name city state postal_code country marital_status "
    "active_flag source_system",
    "encounter": "encounter_id status encounter_class encounter_type patient_id period_start period_end "
    "service_provider source_system",
    "observation": "observation_id status observation_code_text observation_code coding_system patient_id "
    "encounter_id value_numeric value_unit value_string effective_date source_system",
    "condition": "condition_id clinical_status verification_status condition_text condition_code patient_id "
    "encounter_id onset_date recorded_date source_system",
}


def _columns(resource: str) -> list[str]:
    return _HASHED[resource].split()


def _hash(resource: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _columns(resource))
    return f"sha256(concat_ws('||', {parts}))"


def _silver_columns(resource: str) -> str:
    business = ", ".join(_columns(resource)[:-1])
    return (
        f"{business}, batch_id, extraction_timestamp, load_timestamp, source_system, ingestion_date, "
        f"silver_load_timestamp, record_hash"
    )


_LOADED = "TIMESTAMP '2024-01-02 08:00:00'"
_TAIL = (
    f"{_LOADED} AS load_timestamp, 'CLINIC_R4' AS source_system, {_LOADED} AS silver_load_timestamp"
)

# name -> SQL; later blocks may use earlier ones
_BLOCKS: dict[str, str] = {
    "people": """
        SELECT c_custkey AS k, c_name, n_name, r_name, c_mktsegment, c_acctbal,
            CASE c_custkey % 4 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'OTHER' END AS gender,
            CASE WHEN c_custkey % 53 = 0 OR c_custkey % 59 = 0 THEN NULL
                 WHEN c_custkey % 61 = 0 THEN DATE '1980-01-01'
                 ELSE DATE '1930-01-01' + CAST(c_custkey * 37 % 30000 AS INTEGER) END AS birth_date,
            CASE WHEN c_custkey % 41 <> 0 THEN c_name END AS family_name,
            CASE WHEN c_custkey % 41 <> 0 THEN 'G' || (c_custkey % 7) END AS given_name,
            lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS postal_code,
            CASE WHEN c_custkey % 3 = 0 THEN true ELSE c_acctbal > 0 END AS active_flag
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "extracted": """
        SELECT 'A' AS batch, CASE WHEN k % 97 <> 0 THEN 'p' || k END AS patient_id, n_name AS city, * FROM people
        UNION ALL
        SELECT 'B', CASE WHEN k % 97 <> 0 THEN 'p' || k END, CASE WHEN k % 10 = 0 THEN 'Moved' ELSE n_name END, *
        FROM people WHERE k % 5 = 0
        UNION ALL
        SELECT 'B', 'n' || k, n_name, * FROM people WHERE k % 50 = 1""",
    "patient_rows": f"""
        SELECT *, {_hash('patient')} AS record_hash FROM (
            SELECT batch, k, patient_id, gender, birth_date, family_name, given_name, city, r_name AS state,
                postal_code, 'XX' AS country, upper(c_mktsegment) AS marital_status, active_flag,
                'batch' || batch AS batch_id,
                CASE batch WHEN 'A' THEN TIMESTAMP '2024-01-01 06:00:00' ELSE TIMESTAMP '2024-01-02 06:00:00' END
                    AS extraction_timestamp,
                CASE batch WHEN 'A' THEN '2024-01-01' ELSE '2024-01-02' END AS ingestion_date,
                {_TAIL}
            FROM extracted)""",
    "silver_patient_first": "SELECT * FROM patient_rows WHERE batch = 'A' AND patient_id IS NOT NULL",
    "silver_patient": """
        SELECT * FROM patient_rows WHERE patient_id IS NOT NULL AND (batch = 'B' OR k % 5 <> 0)""",
    "dim_patient": """
        SELECT *, DATE '2024-01-01' AS scd_effective_start_date,
            CASE WHEN k % 10 = 0 THEN DATE '2024-01-02' END AS scd_effective_end_date,
            k % 10 <> 0 AS scd_current_flag
        FROM silver_patient_first
        UNION ALL
        SELECT *, DATE '2024-01-02', NULL, true FROM silver_patient
        WHERE batch = 'B' AND (k % 10 = 0 OR patient_id LIKE 'n%')""",
    "silver_encounter": f"""
        SELECT *, {_hash('encounter')} AS record_hash FROM (
            SELECT 'e' || o_orderkey AS encounter_id,
                CASE WHEN o_orderkey % 13 = 0 THEN 'ARRIVED' WHEN o_orderstatus = 'F' THEN 'FINISHED'
                     WHEN o_orderstatus = 'O' THEN 'IN-PROGRESS' WHEN o_orderstatus = 'P' THEN 'CANCELLED' END AS status,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' WHEN '3-MEDIUM' THEN 'AMB'
                     WHEN '4-NOT SPECIFIED' THEN 'OBSENC' WHEN '5-LOW' THEN 'VR' END AS encounter_class,
                o_orderpriority AS encounter_type,
                CASE WHEN o_orderkey % 59 <> 0 THEN 'p' || o_custkey END AS patient_id,
                CAST(o_orderdate AS DATE) + 9131 AS period_start,
                CASE WHEN o_orderkey % 7 <> 0
                     THEN CAST(o_orderdate AS DATE) + 9131 + CAST(o_orderkey % 45 - 2 AS INTEGER) END AS period_end,
                'Supplier#' || (o_orderkey % 100) AS service_provider,
                'batchA' AS batch_id, TIMESTAMP '2024-01-01 06:00:00' AS extraction_timestamp,
                '2024-01-01' AS ingestion_date, {_TAIL}
            FROM orders)""",
    "observation_rows": f"""
        SELECT *, {_hash('observation')} AS record_hash FROM (
            SELECT 'o' || l_orderkey || '-' || l_linenumber AS observation_id, 'FINAL' AS status,
                CASE p_type WHEN 'ECONOMY' THEN 'Blood Pressure' WHEN 'MEDIUM' THEN 'Body Weight'
                     WHEN 'STANDARD' THEN 'Heart rate' WHEN 'PROMO' THEN 'Blood Glucose'
                     WHEN 'SMALL' THEN 'Body Height' END AS observation_code_text,
                CASE WHEN p_type <> 'LARGE' THEN p_brand END AS observation_code,
                CASE WHEN p_type <> 'LARGE' THEN 'http://loinc.org' END AS coding_system,
                'p' || o_custkey AS patient_id, 'e' || l_orderkey AS encounter_id,
                CASE WHEN l_linenumber <> 7 THEN l_quantity END AS value_numeric,
                CASE WHEN l_linenumber <> 7 THEN 'u' END AS value_unit,
                CASE WHEN l_linenumber = 7 THEN l_returnflag END AS value_string,
                CAST(l_shipdate AS DATE) + 9131 AS effective_date,
                'batchA' AS batch_id,
                CAST(CAST(l_shipdate AS DATE) + 9131 AS TIMESTAMP) AS extraction_timestamp,
                '2024-01-01' AS ingestion_date, {_TAIL}
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
    "silver_observation": """
        SELECT * FROM observation_rows
        QUALIFY row_number() OVER (PARTITION BY observation_id
            ORDER BY extraction_timestamp DESC, batch_id DESC, record_hash DESC) = 1""",
    "silver_condition": f"""
        SELECT *, {_hash('condition')} AS record_hash FROM (
            SELECT 'c' || o_custkey || '-' || p_type AS condition_id,
                CASE count(*) % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'RESOLVED' ELSE 'INACTIVE' END AS clinical_status,
                CASE o_custkey % 2 WHEN 0 THEN 'CONFIRMED' ELSE 'PROVISIONAL' END AS verification_status,
                p_type AS condition_text, p_type AS condition_code, 'p' || o_custkey AS patient_id,
                'e' || min(l_orderkey) AS encounter_id,
                min(CAST(l_shipdate AS DATE)) + 9131 AS onset_date,
                max(CAST(l_shipdate AS DATE)) + 9131 AS recorded_date,
                'batchA' AS batch_id, TIMESTAMP '2024-01-01 06:00:00' AS extraction_timestamp,
                '2024-01-01' AS ingestion_date, {_TAIL}
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
            WHERE l_returnflag = 'R' GROUP BY o_custkey, p_type)""",
    "dim_condition": """
        SELECT *, DATE '2024-01-01' AS scd_effective_start_date, CAST(NULL AS DATE) AS scd_effective_end_date,
            true AS scd_current_flag FROM silver_condition""",
    "dim_date": """
        SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
            CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
            CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
            CAST(week(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""",
    "aged": """
        SELECT *, CAST(floor(date_diff('day', birth_date, DATE '2024-06-30') / 365.25) AS INTEGER) AS age
        FROM dim_patient WHERE scd_current_flag""",
    "gold_dim_patient": """
        SELECT CAST(row_number() OVER (ORDER BY patient_id) AS INTEGER) AS patient_sk,
            patient_id AS patient_business_key, gender, birth_date, age,
            CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '0-17' WHEN age < 35 THEN '18-34'
                 WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64' ELSE '65+' END AS age_group,
            CAST(CASE WHEN age IS NULL THEN 99 WHEN age < 18 THEN 1 WHEN age < 35 THEN 2
                 WHEN age < 50 THEN 3 WHEN age < 65 THEN 4 ELSE 5 END AS INTEGER) AS age_group_sort_order,
            family_name, given_name, city, state, postal_code, country, marital_status, active_flag,
            scd_effective_start_date, scd_effective_end_date
        FROM aged""",
    "gold_dim_condition": """
        SELECT CAST(row_number() OVER (ORDER BY condition_id) AS INTEGER) AS condition_sk,
            condition_id AS condition_business_key, clinical_status, verification_status, condition_text,
            condition_code, patient_id AS patient_business_key, onset_date, recorded_date,
            scd_effective_start_date, scd_effective_end_date
        FROM dim_condition WHERE scd_current_flag""",
    "stays": """
        SELECT s.*, p.patient_sk, CAST(date_diff('day', period_start, period_end) AS DOUBLE) AS los
        FROM silver_encounter s LEFT JOIN gold_dim_patient p ON s.patient_id = p.patient_business_key""",
    "fact_encounter": """
        SELECT encounter_id, patient_sk, CAST(strftime(period_start, '%Y%m%d') AS INTEGER) AS start_date_key,
            CAST(strftime(period_end, '%Y%m%d') AS INTEGER) AS end_date_key, status, encounter_class, encounter_type,
            service_provider, period_start, period_end, los AS length_of_stay_days,
            CASE WHEN los IS NULL THEN 'Not Applicable' WHEN los <= 1 THEN '0 – 1 day' WHEN los <= 3 THEN '2 – 3 days'
                 WHEN los <= 7 THEN '4 – 7 days' WHEN los <= 14 THEN '8 – 14 days' WHEN los <= 30 THEN '15 – 30 days'
                 ELSE '30+ days' END AS los_bucket,
            CAST(CASE WHEN los IS NULL THEN 99 WHEN los <= 1 THEN 1 WHEN los <= 3 THEN 2 WHEN los <= 7 THEN 3
                 WHEN los <= 14 THEN 4 WHEN los <= 30 THEN 5 ELSE 6 END AS INTEGER) AS los_bucket_sort_order
        FROM stays""",
    "fact_observation": """
        SELECT observation_id, patient_sk, encounter_id,
            CAST(strftime(effective_date, '%Y%m%d') AS INTEGER) AS observation_date_key, status,
            observation_code_text, observation_code, coding_system, value_numeric, value_unit, value_string,
            effective_date
        FROM silver_observation s LEFT JOIN gold_dim_patient p ON s.patient_id = p.patient_business_key""",
    "event_pulls": """
        SELECT 'ev' || event_id AS resource_id, 'b' || strftime(d, '%Y-%m-%d') AS batch_id,
            strftime(d, '%Y-%m-%d') AS ingestion_date, event_type, value AS event_value
        FROM (SELECT *, unnest(generate_series(CAST(ts AS DATE),
                least(CAST(ts AS DATE) + 3, DATE '2024-01-30'), INTERVAL 1 DAY)) AS d FROM events)""",
    "enc": """
        SELECT f.*, p.gender, p.state, p.city, p.age_group, p.age_group_sort_order, p.patient_business_key,
            d.full_date, d.year, d.quarter, d.month, d.month_name
        FROM fact_encounter f LEFT JOIN gold_dim_patient p USING (patient_sk)
        LEFT JOIN dim_date d ON f.start_date_key = d.date_key""",
    "obs": """
        SELECT f.*, p.gender, p.state, p.patient_business_key, d.full_date, d.year, d.month_name
        FROM fact_observation f LEFT JOIN gold_dim_patient p USING (patient_sk)
        LEFT JOIN dim_date d ON f.observation_date_key = d.date_key""",
    "sliced": """
        SELECT * FROM enc WHERE gender IN ('MALE', 'FEMALE') AND encounter_class IN ('IMP', 'EMER')
            AND year IN (2023, 2024)""",
    "months": "SELECT DISTINCT year, month, year * 12 + month - 1 AS i FROM dim_date",
}


def _sql(body: str) -> str:
    """``body`` behind the blocks it mentions, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _BLOCKS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(_BLOCKS[name])

    visit(body)
    blocks = ",\n".join(f"{n} AS ({_BLOCKS[n]})" for n in _BLOCKS if n in needed)
    return f"WITH {blocks}\n{body}" if blocks else body


def _patients(value: str = "patient_sk") -> str:
    """Distinct count where null is one more value."""
    return f"nullif(count(DISTINCT {value}) + coalesce(max(CASE WHEN {value} IS NULL THEN 1 ELSE 0 END), 0), 0)"


def _n(where: str | None = None) -> str:
    return "nullif(count(*), 0)" if where is None else f"nullif(count(*) FILTER (WHERE {where}), 0)"


def _silver(resource: str) -> str:
    return f"SELECT {_silver_columns(resource)} FROM silver_{resource}"


_SCD = "scd_effective_start_date, scd_effective_end_date, scd_current_flag"
_HISTORY = f"patient_id, city, state, record_hash, {_SCD}"
_IMP = "encounter_class = 'IMP'"


def _month_over_month(value: str, name: str, group: str = "") -> str:
    """Monthly value, the month before and the change, for calendar months where either has rows."""
    keys = f"{group}, " if group else ""
    same = f"AND c.{group} IS NOT DISTINCT FROM p.{group}" if group else ""
    out = f"coalesce(c.{group}, p.{group}) AS {group}, " if group else ""
    return f"""
        SELECT {out}CAST(m.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month, c.v AS {name},
            p.v AS {name}_prior_month,
            round(CASE WHEN p.v <> 0 THEN CAST(coalesce(c.v, 0) - p.v AS DOUBLE) / p.v END, 6) AS {name}_mom_pct
        FROM (SELECT {keys}year * 12 + month - 1 AS i, {value} AS v FROM enc GROUP BY ALL) c
        FULL JOIN (SELECT {keys}year * 12 + month AS i, {value} AS v FROM enc GROUP BY ALL) p ON c.i = p.i {same}
        JOIN months m ON m.i = coalesce(c.i, p.i)"""


_LI = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_DRIFT_ROWS = "patient_rows WHERE batch = 'A'"
_CODES = "('Blood Pressure', 'Body Weight', 'Heart rate', 'Blood Glucose')"


def _union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def _count_of(tables: list[str]) -> str:
    return _union([f"SELECT '{t}' AS tbl, count(*) AS cnt FROM {s}" for t, s in tables])


_BRONZE = {
    "patient": "patient_rows",
    "encounter": "silver_encounter",
    "observation": "observation_rows",
    "condition": "silver_condition",
}
_PK = {r: f"{r}_id" for r in _BRONZE}


def _bodies() -> dict[str, str]:
    q: dict[str, str] = {}

    # landing and Bronze
    q["bronze_explode_pages"] = f"""
        SELECT CASE WHEN k % 97 <> 0 THEN 'p' || k END AS resource_id,
            'https://clinic.example/r4/Patient' || CASE WHEN k % 97 <> 0 THEN '/p' || k ELSE '' END AS full_url,
            'Patient' AS source_resource_type, 'batchA' AS batch_id,
            TIMESTAMP '2024-01-01 06:00:00' AS extraction_timestamp, 'CLINIC_R4' AS source_system,
            'https://clinic.example/r4' AS api_url, {_LOADED} AS load_timestamp, '2024-01-01' AS ingestion_date,
            CASE k % 4 WHEN 0 THEN ' male' WHEN 1 THEN 'female ' WHEN 2 THEN 'other' END AS gender,
            CASE WHEN k % 53 = 0 THEN '1850-06-15' WHEN k % 59 = 0 THEN 'unknown' WHEN k % 61 = 0 THEN '1980'
                 ELSE CAST(birth_date AS VARCHAR) END AS birth_text,
            CAST(CASE WHEN k % 41 = 0 THEN 0 ELSE 1 END AS INTEGER) AS names, postal_code
        FROM people"""
    q["bronze_manifest_valid"] = """
        SELECT 'complete' AS batch_id, true AS is_valid, CAST(ceil(count(*) / 50.0) AS BIGINT) AS page_count,
            count(*) AS total_records FROM customer
        UNION ALL SELECT unnest(['missing', 'extra', 'unreadable']), false, NULL, NULL"""
    q["raw_folder_census"] = """
        SELECT 'patient' AS resource_type, count(DISTINCT ingestion_date) AS date_folders FROM patient_rows
        UNION ALL SELECT 'encounter', count(DISTINCT ingestion_date) FROM silver_encounter
        UNION ALL SELECT unnest(['observation', 'condition']), 0"""
    q["bronze_lookback_pull"] = """
        SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS pulled FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-20' GROUP BY ALL"""
    q["bronze_merge_insert_new"] = "SELECT * FROM event_pulls"
    q["stream_bronze_result"] = "SELECT * FROM event_pulls"
    q["stream_bronze_complete_batches"] = """
        SELECT 'loaded ' || coalesce(patient_id, 'none') AS entry, batch_id, count(*) AS n FROM patient_rows GROUP BY ALL
        UNION ALL SELECT 'COMPLETE true ' || count(*), batch_id, 1 FROM patient_rows GROUP BY batch_id
        UNION ALL SELECT 'waiting after 1', 'batchA', 1
        UNION ALL SELECT unnest(['waiting after 1', 'waiting after 2']), 'batchB', 1"""
    q["silver_patient_bucketed"] = _silver("patient")
    q["fact_encounter_refreshed"] = """
        SELECT *, NOT coalesce(year(period_start) = 2021 AND right(encounter_id, 1) IN ('3', '4'), false) AS from_first_load
        FROM fact_encounter"""
    q["bronze_merge_pruned"] = """
        SELECT count(*) AS rows_to_insert FROM event_pulls s WHERE ingestion_date = '2024-01-20' AND NOT EXISTS (
            SELECT 1 FROM event_pulls t WHERE t.ingestion_date = '2024-01-20'
                AND t.resource_id = s.resource_id AND t.batch_id = s.batch_id)"""
    q["bronze_loads_per_day"] = """
        SELECT ingestion_date, count(*) AS row_count, count(DISTINCT batch_id) AS batch_count
        FROM event_pulls GROUP BY ingestion_date"""
    q["bronze_top_reingested"] = """
        SELECT resource_id, count(DISTINCT batch_id) AS times_reingested FROM event_pulls GROUP BY resource_id
        HAVING count(DISTINCT batch_id) > 1 ORDER BY times_reingested DESC, resource_id LIMIT 20"""
    q["bronze_preview"] = """
        SELECT patient_id AS resource_id, family_name,
            CASE k % 4 WHEN 0 THEN ' male' WHEN 1 THEN 'female ' WHEN 2 THEN 'other' END AS gender, ingestion_date
        FROM patient_rows WHERE patient_id IS NOT NULL ORDER BY patient_id, batch_id LIMIT 10"""
    q["bronze_dup_keys"] = """
        SELECT observation_id AS resource_id, batch_id, count(*) AS cnt FROM observation_rows
        GROUP BY ALL HAVING count(*) > 1"""
    q["bronze_lineage_complete"] = """
        SELECT count(*) AS rows_missing_metadata FROM event_pulls WHERE batch_id IS NULL OR ingestion_date IS NULL"""
    q["table_detail"] = """
        SELECT ingestion_date, count(*) AS num_rows, true AS has_files, true AS has_bytes
        FROM event_pulls GROUP BY ingestion_date"""
    q["compact_preserves"] = """
        SELECT ingestion_date, count(*) AS num_rows, round(sum(event_value), 2) AS total_value, true AS fewer_files
        FROM event_pulls GROUP BY ingestion_date"""
    q["schema_drift_report"] = f"""
        SELECT 'resource_data.address[].district' AS path, 'NEW' AS change, 'string' AS data_type,
            count(patient_id) AS rows_with_value FROM {_DRIFT_ROWS}
        UNION ALL SELECT 'name_count', 'NEW', 'int', count(*) FROM {_DRIFT_ROWS}
        UNION ALL SELECT 'resource_data.maritalStatus.text', 'MISSING', 'string', count(marital_status)
        FROM {_DRIFT_ROWS}"""
    q["schema_evolution_merge"] = f"""
        SELECT patient_id AS resource_id, 'batchA' AS batch_id, CAST(NULL AS VARCHAR) AS district,
            lower(marital_status) AS marital_status, CAST(NULL AS INTEGER) AS name_count FROM {_DRIFT_ROWS}
        UNION ALL
        SELECT patient_id, 'batchC', 'D-' || right(patient_id, 1), NULL, CAST(CASE WHEN k % 41 = 0 THEN 0 ELSE 1 END
            AS INTEGER) FROM {_DRIFT_ROWS}"""

    q["schema_evolution_stored"] = f"SELECT *, batch_id = 'batchA' AS in_old_file FROM ({q['schema_evolution_merge']})"
    q["check_partition_columns"] = """
        SELECT 'bronze_patient' AS tbl, 'ingestion_date' AS partition_columns, true AS as_expected,
            count(DISTINCT ingestion_date) AS partitions FROM patient_rows
        UNION ALL SELECT 'bronze_encounter', 'ingestion_date', true, count(DISTINCT ingestion_date) FROM silver_encounter
        UNION ALL SELECT 'silver_condition', '', false, 0"""

    # Silver
    for resource in _BRONZE:
        q[f"silver_{resource}"] = _silver(resource)
    q["silver_patient_stepwise"] = q["silver_patient"]
    q["silver_quarantine_metrics"] = _union(
        [
            f"SELECT '{r}' AS resource_type, count(*) AS total_rows, "
            f"count(*) - count({_PK[r]}) AS null_primary_key_count, "
            f"round(CAST(count(*) - count({_PK[r]}) AS DOUBLE) / count(*) * 100, 2) AS null_pk_pct FROM {t}"
            for r, t in _BRONZE.items()
        ]
    )
    q["quarantine_backfill"] = f"""
        SELECT batch_id, CASE batch_id WHEN 'batchA' THEN '{BATCHES["A"][0]}' ELSE '{BATCHES["B"][0]}' END AS source_date,
            count(*) AS rejected_rows
        FROM patient_rows WHERE patient_id IS NULL GROUP BY batch_id"""
    q["bronze_unknown_fields"] = """
        SELECT patient_id AS resource_id, 'T-' || patient_id AS telecom, 'false' AS deceased
        FROM patient_rows WHERE batch_id = 'batchA'"""
    q["silver_quarantine_sink"] = """
        SELECT patient_id, family_name, CASE WHEN k % 53 = 0 THEN DATE '1850-06-15' ELSE birth_date END AS birth_date,
            batch_id, '2024-06-30' AS ingestion_date
        FROM patient_rows WHERE patient_id IS NULL"""
    outside = "year({0}) < 1900 OR year({0}) > 2026"
    dates = {
        "encounter": ["period_start", "period_end"],
        "observation": ["effective_date"],
        "condition": ["onset_date", "recorded_date"],
    }
    q["silver_bad_dates"] = _union(
        [
            "SELECT 'patient' AS resource_type, 'birth_date' AS column_name, count(*) AS bad_row_count "
            "FROM patient_rows WHERE k % 53 = 0 AND patient_id IS NOT NULL"
        ]
        + [
            f"SELECT '{r}', '{c}', count(*) FROM {_BRONZE[r]} WHERE {outside.format(c)}"
            for r, cs in dates.items()
            for c in cs
        ]
    )
    q["silver_dedup_latest"] = f"""
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, {_LI}) = 1"""
    q["silver_dedup_counts"] = _union(
        [
            f"SELECT '{r}' AS resource_type, count({_PK[r]}) AS rows_before, count(DISTINCT {_PK[r]}) AS rows_after, "
            f"count({_PK[r]}) - count(DISTINCT {_PK[r]}) AS duplicates_removed FROM {t}"
            for r, t in _BRONZE.items()
        ]
    )

    # slowly changing dimensions
    dim_columns = f"{_silver_columns('patient')}, {_SCD}"
    q["scd2_initial"] = f"""
        SELECT {_silver_columns('patient')}, DATE '2024-01-01' AS scd_effective_start_date,
            CAST(NULL AS DATE) AS scd_effective_end_date, true AS scd_current_flag FROM silver_patient_first"""
    q["scd2_classify"] = """
        SELECT s.patient_id, s.record_hash,
            CASE WHEN f.patient_id IS NULL THEN 'new' WHEN f.record_hash <> s.record_hash THEN 'changed'
                 ELSE 'unchanged' END AS change
        FROM silver_patient s LEFT JOIN silver_patient_first f USING (patient_id)"""
    q["scd2_change_counts"] = f"SELECT change, count(*) AS row_count FROM ({q['scd2_classify']}) GROUP BY change"
    q["scd2_apply"] = f"SELECT {dim_columns} FROM dim_patient"
    q["scd2_rerun"] = q["scd2_apply"]
    q["scd2_invariants"] = _union(
        [
            f"SELECT '{t}' AS tbl, unnest(['multiple_current', 'closed_without_end', 'current_with_end']) "
            f"AS check_name, unnest([(SELECT count(*) FROM (SELECT 1 FROM {t} WHERE scd_current_flag "
            f"GROUP BY {pk} HAVING count(*) > 1)), "
            f"(SELECT count(*) FROM {t} WHERE NOT scd_current_flag AND scd_effective_end_date IS NULL), "
            f"(SELECT count(*) FROM {t} WHERE scd_current_flag AND scd_effective_end_date IS NOT NULL)]) AS bad_rows"
            for t, pk in (("dim_patient", "patient_id"), ("dim_condition", "condition_id"))
        ]
    )
    q["scd2_version_histogram"] = """
        SELECT version_count, count(*) AS key_count
        FROM (SELECT patient_id, count(*) AS version_count FROM dim_patient GROUP BY patient_id) GROUP BY version_count"""
    q["scd2_current_split"] = _union(
        [
            f"SELECT '{t}' AS tbl, count(*) AS total_rows, count(*) FILTER (WHERE scd_current_flag) AS current_rows, "
            f"count(*) FILTER (WHERE NOT scd_current_flag) AS historical_rows FROM {t}"
            for t in ("dim_patient", "dim_condition")
        ]
    )
    q["scd2_history"] = f"SELECT {_HISTORY} FROM dim_patient ORDER BY patient_id, scd_effective_start_date"
    q["scd2_one_changed_key"] = f"""
        SELECT {_HISTORY} FROM dim_patient WHERE patient_id = (SELECT min(patient_id) FROM (
            SELECT patient_id FROM dim_patient GROUP BY patient_id HAVING count(*) > 1))
        ORDER BY scd_effective_start_date"""

    # Gold
    q["dim_date"] = """
        SELECT d.*, f.encounters_started FROM dim_date d LEFT JOIN (SELECT CAST(o_orderdate AS DATE) + 9131 AS day,
            count(*) AS encounters_started FROM orders GROUP BY 1) f ON d.full_date = f.day"""
    for table in ("gold_dim_patient", "gold_dim_condition", "fact_encounter", "fact_observation"):
        q[table] = f"SELECT * FROM {table}"
    q["vw_fact_encounter"] = """
        SELECT encounter_id, status, encounter_class, encounter_type, service_provider, length_of_stay_days,
            patient_business_key, gender, city AS patient_city, state AS patient_state,
            full_date AS encounter_start_date, year, month_name, quarter FROM enc"""
    q["vw_fact_observation"] = """
        SELECT observation_id, status, observation_code_text, value_numeric, value_unit, patient_business_key, gender,
            full_date AS observation_date, year, month_name FROM obs"""
    q["vw_condition_distribution"] = """
        SELECT c.condition_text, c.clinical_status, p.gender, count(*) AS condition_count
        FROM gold_dim_condition c LEFT JOIN gold_dim_patient p USING (patient_business_key) GROUP BY ALL"""

    # checks
    q["check_orphans"] = _union(
        [
            f"SELECT '{t}' AS tbl, count(*) AS orphans FROM {t} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM silver_patient p WHERE p.patient_id = c.patient_id)"
            for t in ("silver_encounter", "silver_observation", "dim_condition")
        ]
    )
    q["check_unmatched_facts"] = _union(
        [
            f"SELECT '{t}' AS tbl, count(*) AS total, count(*) - count(patient_sk) AS orphaned FROM {t}"
            for t in ("fact_encounter", "fact_observation")
        ]
    )
    keyed = {f"silver_{r}": _PK[r] for r in _BRONZE}
    keyed |= {"gold_dim_patient": "patient_sk", "gold_dim_condition": "condition_sk"}
    q["check_duplicate_keys"] = _union(
        [
            f"SELECT '{t}' AS tbl, count(*) AS duplicate_keys FROM "
            f"(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)"
            for t, k in keyed.items()
        ]
    )
    census = [(f"bronze_{r}", t) for r, t in _BRONZE.items()] + [(f"silver_{r}", f"silver_{r}") for r in _BRONZE]
    stars = ("dim_date", "gold_dim_patient", "gold_dim_condition", "fact_encounter", "fact_observation")
    q["check_row_census"] = _count_of(census + [(t, t) for t in stars])
    q["check_bronze_silver_totals"] = """
        SELECT count(*) AS bronze_total_rows, count(DISTINCT patient_id) AS bronze_distinct_ids,
            (SELECT count(*) FROM silver_patient) AS silver_total_rows FROM patient_rows"""
    q["check_layer_totals"] = """
        SELECT count(DISTINCT ingestion_date) AS distinct_load_days, count(*) AS bronze_total_rows,
            (SELECT count(*) FROM silver_patient) AS silver_current_rows,
            (SELECT count(*) FROM dim_patient) AS dim_total_versions,
            (SELECT count(*) FROM dim_patient WHERE scd_current_flag) AS dim_current_versions,
            (SELECT count(*) FROM dim_patient WHERE NOT scd_current_flag) AS dim_historical_versions
        FROM patient_rows"""
    q["check_current_totals"] = """
        SELECT (SELECT count(*) FROM dim_patient WHERE scd_current_flag) AS current_patients,
            (SELECT count(*) FROM dim_condition WHERE scd_current_flag) AS current_conditions"""

    # measures
    q["measures_encounter"] = f"""
        SELECT encounter_class, {_patients()} AS total_patients, {_n()} AS total_encounters,
            {_n("status = 'FINISHED'")} AS encounters_finished, {_n("status = 'CANCELLED'")} AS encounters_cancelled,
            {_n("status = 'IN-PROGRESS'")} AS encounters_in_progress, {_n("status = 'ARRIVED'")} AS encounters_arrived,
            (SELECT round(avg(length_of_stay_days), 6) FROM fact_encounter WHERE {_IMP}) AS avg_los_days,
            round(avg(length_of_stay_days), 6) AS avg_los_all_classes,
            (SELECT max(length_of_stay_days) FROM fact_encounter WHERE {_IMP}) AS max_los_days,
            sum(length_of_stay_days) AS total_los_days,
            round(CAST(count(*) AS DOUBLE) / {_patients()}, 6) AS encounters_per_patient
        FROM fact_encounter GROUP BY encounter_class"""
    q["measures_by_status"] = """
        SELECT status, count(*) AS total_encounters,
            (SELECT count(*) FROM fact_encounter WHERE status = 'FINISHED') AS encounters_finished,
            (SELECT count(*) FROM fact_encounter WHERE status = 'ARRIVED') AS encounters_arrived
        FROM fact_encounter GROUP BY status"""
    q["measures_observation"] = """
        SELECT observation_code_text, count(*) AS total_observations,
            nullif(count(value_numeric), 0) AS numeric_observations,
            round(avg(value_numeric), 6) AS avg_observation_value
        FROM fact_observation GROUP BY observation_code_text"""
    q["measures_per_patient"] = f"""
        SELECT e.gender, total_patients, total_encounters, total_observations,
            round(CAST(total_observations AS DOUBLE) / total_patients, 6) AS observations_per_patient,
            round(CAST(total_encounters AS DOUBLE) / total_patients, 6) AS encounters_per_patient
        FROM (SELECT gender, {_patients()} AS total_patients, count(*) AS total_encounters FROM enc GROUP BY gender) e
        FULL JOIN (SELECT gender, count(*) AS total_observations FROM obs GROUP BY gender) o
            ON e.gender IS NOT DISTINCT FROM o.gender"""
    q["measures_condition"] = f"""
        SELECT condition_text, count(*) AS total_conditions, {_n("clinical_status = 'ACTIVE'")} AS active_conditions,
            {_patients('patient_business_key')} AS patients_with_condition,
            round(CAST({_n("clinical_status = 'RESOLVED'")} AS DOUBLE) / count(*), 6) AS condition_resolution_rate
        FROM gold_dim_condition GROUP BY condition_text"""
    q["measures_overall"] = f"""
        SELECT {_patients()} AS total_patients, {_n()} AS total_encounters,
            (SELECT count(*) FROM fact_observation) AS total_observations,
            (SELECT count(*) FROM gold_dim_condition) AS total_conditions,
            (SELECT count(*) FROM gold_dim_condition WHERE clinical_status = 'ACTIVE') AS active_conditions,
            round(avg(length_of_stay_days) FILTER (WHERE {_IMP}), 6) AS avg_los_days,
            (SELECT count(value_numeric) FROM fact_observation) AS numeric_observations,
            (SELECT {_patients('patient_business_key')} FROM gold_dim_condition) AS patients_with_condition,
            (SELECT round(CAST(count(*) FILTER (WHERE clinical_status = 'RESOLVED') AS DOUBLE) / count(*), 6)
             FROM gold_dim_condition) AS condition_resolution_rate
        FROM fact_encounter"""
    q["encounter_status_share"] = """
        SELECT encounter_class, status, n AS total_encounters,
            round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY encounter_class), 6) AS encounter_status_pct
        FROM (SELECT encounter_class, status, count(*) AS n FROM fact_encounter GROUP BY ALL)"""
    for name, group in (("encounters_mtd_ytd", ""), ("encounters_mtd_ytd_by_class", "encounter_class")):
        keys = f"{group}, " if group else ""
        grid_keys = f"y.{group}, " if group else ""
        same = f"AND y.{group} IS NOT DISTINCT FROM n.{group}" if group else ""
        q[name] = f"""
        SELECT {keys}full_date, nullif(n, 0) AS encounters,
            CAST(nullif(sum(n) OVER (PARTITION BY {keys}year, month ORDER BY full_date), 0) AS BIGINT) AS encounters_mtd,
            CAST(nullif(sum(n) OVER (PARTITION BY {keys}year ORDER BY full_date), 0) AS BIGINT) AS encounters_ytd
        FROM (SELECT {grid_keys}d.full_date, d.year, d.month, coalesce(n.n, 0) AS n
              FROM (SELECT DISTINCT {keys}year FROM enc WHERE year IS NOT NULL) y JOIN dim_date d ON d.year = y.year
              LEFT JOIN (SELECT {keys}full_date, count(*) AS n FROM enc GROUP BY ALL) n
                  ON n.full_date = d.full_date {same})"""
    q["encounters_mom"] = _month_over_month("count(*)", "encounters")
    q["patients_mom"] = _month_over_month(_patients(), "patients")
    q["patients_mom_by_state"] = _month_over_month(_patients(), "patients", "state")
    q["los_by_discharge"] = f"""
        SELECT d.year, d.month, round(avg(CASE WHEN {_IMP} THEN length_of_stay_days END), 6) AS avg_los_by_discharge_date
        FROM fact_encounter f LEFT JOIN dim_date d ON f.end_date_key = d.date_key GROUP BY ALL"""
    one_class = "CASE WHEN count(DISTINCT encounter_class) = 1 THEN max(encounter_class) ELSE 'All Classes' END"
    q["context_labels"] = f"""
        SELECT 'none' AS context, 'Healthcare Analytics | All Years | ' || {one_class} AS page_title,
            'All Years — All Quarters' AS selected_period FROM enc
        UNION ALL SELECT 'class', 'Healthcare Analytics | All Years | ' || {one_class}, 'All Years — All Quarters'
        FROM enc WHERE encounter_class = 'IMP'
        UNION ALL SELECT 'quarter', 'Healthcare Analytics | 2024 | ' || {one_class}, '2024 — 1'
        FROM enc WHERE year = 2024 AND quarter = 1"""

    # dashboard
    total = "count(*) AS total_encounters"
    q["dash_cards"] = f"""
        SELECT (SELECT count(*) FROM gold_dim_condition WHERE clinical_status = 'ACTIVE') AS active_conditions,
            {_patients()} AS total_patients, round(avg(length_of_stay_days) FILTER (WHERE {_IMP}), 6) AS avg_los_days,
            {total} FROM enc"""
    q["dash_month_type"] = f"SELECT month_name, encounter_type, {total} FROM enc GROUP BY ALL"
    q["dash_gender"] = f"SELECT gender, {_patients()} AS total_patients FROM enc GROUP BY gender"
    q["dash_age_group"] = f"SELECT age_group, age_group_sort_order, {total} FROM enc GROUP BY ALL"
    q["dash_class"] = f"SELECT encounter_class, {total} FROM enc GROUP BY ALL"
    q["dash_los_bucket"] = f"SELECT los_bucket, los_bucket_sort_order, {total} FROM enc GROUP BY ALL"
    q["dash_status_table"] = f"SELECT status, {_patients()} AS total_patients, {total} FROM enc GROUP BY status"
    for name, source in (("dash_month_code", "enc"), ("dash_sliced_codes", "sliced")):
        q[name] = f"""
        SELECT e.month_name, o.observation_code_text, count(DISTINCT e.encounter_id) AS total_encounters
        FROM {source} e JOIN fact_observation o ON e.encounter_id = o.encounter_id
        WHERE o.observation_code_text IN {_CODES} GROUP BY ALL"""
    q["dash_code"] = f"""
        SELECT o.observation_code_text, count(DISTINCT e.encounter_id) AS total_encounters
        FROM fact_encounter e JOIN fact_observation o ON e.encounter_id = o.encounter_id
        WHERE o.observation_code_text IN {_CODES} GROUP BY ALL"""
    q["dash_state"] = f"SELECT state, {total} FROM enc GROUP BY state"
    q["dash_condition_patients"] = """
        SELECT c.condition_text, count(DISTINCT e.patient_sk) AS total_patients
        FROM gold_dim_condition c JOIN enc e USING (patient_business_key) GROUP BY ALL"""
    q["dash_slicer_lists"] = _union(
        [
            f"SELECT '{c}' AS slicer, {c} AS value, {total} FROM enc GROUP BY {c}"
            for c in ("state", "gender", "encounter_class", "status")
        ]
    )
    rules = {
        "gender": "gender IN ('MALE', 'FEMALE')", "encounter_class": "encounter_class IN ('IMP', 'EMER')",
        "state": "true", "status": "true",
    }
    q["dash_slicer_lists_sliced"] = _union(
        [
            f"SELECT '{c}' AS slicer, {c} AS value, {total} FROM enc WHERE year IN (2023, 2024) AND "
            + " AND ".join(rule for other, rule in rules.items() if other != c)
            + f" GROUP BY {c}"
            for c in rules
        ]
    )
    q["dash_date_hierarchy_sliced"] = f"""
        SELECT year, quarter, month_name, d.full_date, total_encounters FROM dim_date d
        LEFT JOIN (SELECT start_date_key, count(*) AS total_encounters FROM enc
                   WHERE {rules["gender"]} AND {rules["encounter_class"]} GROUP BY 1) f
            ON f.start_date_key = d.date_key"""
    q["dash_date_hierarchy"] = """
        SELECT year, quarter, month_name, d.full_date, total_encounters FROM dim_date d
        LEFT JOIN (SELECT start_date_key, count(*) AS total_encounters FROM fact_encounter GROUP BY 1) f
            ON f.start_date_key = d.date_key"""
    q["dash_sliced"] = f"SELECT status, {_patients()} AS total_patients, {total} FROM sliced GROUP BY status"
    q["dash_sliced_cards"] = f"""
        SELECT (SELECT count(*) FROM gold_dim_condition JOIN gold_dim_patient USING (patient_business_key)
                WHERE clinical_status = 'ACTIVE' AND gender IN ('MALE', 'FEMALE')) AS active_conditions,
            {_patients()} AS total_patients,
            (SELECT round(avg(length_of_stay_days), 6) FROM enc WHERE {_IMP} AND gender IN ('MALE', 'FEMALE')
                AND year IN (2023, 2024)) AS avg_los_days,
            {total} FROM sliced"""

    q["dash_sliced_case"] = q["dash_sliced"]
    q["measures_period_sliced"] = """
        SELECT CAST(2024 AS INTEGER) AS year, d.month, 'IMP' AS encounter_class, c.v AS total_encounters, c.v AS encounters_mtd,
            p.v AS encounters_prior_month,
            round(CASE WHEN p.v <> 0 THEN CAST(coalesce(c.v, 0) - p.v AS DOUBLE) / p.v END, 6) AS encounters_mom_pct
        FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) d
        LEFT JOIN (SELECT year * 12 + month AS at, count(*) AS v FROM enc WHERE encounter_class = 'IMP' GROUP BY 1) c
            ON c.at = 2024 * 12 + d.month
        LEFT JOIN (SELECT year * 12 + month AS at, count(*) AS v FROM enc WHERE encounter_class = 'IMP' GROUP BY 1) p
            ON p.at = 2024 * 12 + d.month - 1"""

    q["stored_views"] = _union(
        [f"SELECT '{v}' AS tbl, count(*) AS cnt FROM ({q[v]})" for v in ("vw_condition_distribution", "vw_fact_encounter", "vw_fact_observation")]
    )
    for name in ("patients_mom", "patients_mom_by_state", "encounters_mtd_ytd_by_class"):
        q[f"{name}_from_days"] = q[name]
    q["totals_from_days"] = f"""
        SELECT encounter_class, {_n()} AS total_encounters, {_patients()} AS total_patients FROM enc GROUP BY encounter_class"""
    q["catalog_tables"] = """
        SELECT 'fact_encounter' AS table_name, count(*) AS row_count FROM fact_encounter
        UNION ALL SELECT 'fact_observation', count(*) FROM fact_observation
        UNION ALL SELECT 'fact_missing', NULL"""

    # the whole run
    q["run_two_days"] = _count_of(
        [
            ("bronze_patient", "patient_rows"),
            ("silver_patient", "silver_patient"),
            ("dim_patient", "dim_patient"),
            ("silver_observation", "silver_observation"),
            ("gold_dim_patient", "gold_dim_patient"),
            ("gold_dim_condition", "gold_dim_condition"),
            ("fact_encounter", "fact_encounter"),
            ("fact_observation", "fact_observation"),
        ]
    ) + "\nUNION ALL SELECT unnest(['log:runA:SUCCESS', 'log:runB:PARTIAL_SUCCESS']), 1"
    first = "(SELECT count(DISTINCT patient_id) FROM patient_rows WHERE batch_id = 'batchA')"
    q["run_log_and_events"] = f"""
        SELECT 'runA:patient:bronze:SUCCESS' AS entry, count(*) AS cnt FROM patient_rows WHERE batch_id = 'batchA'
        UNION ALL SELECT 'runA:patient:silver:SUCCESS', {first}
        UNION ALL SELECT 'runA:patient:scd2:SUCCESS', {first}
        UNION ALL SELECT 'runB:patient:bronze:SUCCESS', count(*) FROM patient_rows
        UNION ALL SELECT 'runB:patient:silver:SUCCESS', count(*) FROM silver_patient
        UNION ALL SELECT 'runB:patient:scd2:SUCCESS', count(*) FROM dim_patient
        UNION ALL SELECT unnest(['runA:ALL:gold:FAILED', 'runB:ALL:gold:FAILED']), NULL
        UNION ALL SELECT 'SCHEMA_DRIFT_NEW_COLUMNS:deceasedBoolean,telecom[].system', 1"""
    q["lifecycle_events"] = """
        SELECT 'INFO:TABLE_CREATED:patient:12' AS entry, 1 AS cnt
        UNION ALL SELECT 'ERROR:SCHEMA_DRIFT_MERGE_FAILED:patient:full_url is int in the table and string in the batch', 1
        UNION ALL SELECT 'bronze_patient', count(*) FROM patient_rows WHERE batch = 'A'"""
    return q


def all_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in _bodies().items()}
