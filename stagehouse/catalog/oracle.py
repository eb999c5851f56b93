"""The SQL each registered query must agree with, runnable on the given tables."""

from __future__ import annotations

import re

from stagehouse.catalog.inputs_sql import VIEWS
from stagehouse.schemas import SALES_TABLES

_PRINTED = {"sales_revenue": "DOUBLE", "price": "DOUBLE"}


def _columns(table: str) -> str:
    return ", ".join(
        f"CAST({c} AS {_PRINTED[c]}) AS {c}" if c in _PRINTED else c
        for c in SALES_TABLES[table].fieldNames()
    )


SELECTS: dict[str, str] = {}
for _t in SALES_TABLES:
    SELECTS[f"scan_{_t}"] = f"SELECT {_columns(_t)} FROM fx_{_t}"
    SELECTS[f"stage_{_t}"] = f"SELECT 'batch-{_t}' AS request_id, {_columns(_t)} FROM fx_{_t}"

# Weekday and category names, and the regions, companies and
# employees tables of the ledger, are those of the modules under test.
_WEEKDAYS = (
    "['Воскресенье', 'Понедельник', 'Вторник', 'Среда', 'Четверг', 'Пятница', 'Суббота']"
)
_EXTRACT_MEASURES = ", ".join(
    f"COALESCE(CAST(replace(replace(NULLIF({m}, ''), ' ', ''), ',', '.') AS DOUBLE), 0) AS {m}"
    for m in ("emission_total", "discharge_total", "waste_total", "co2_total")
)
_LOG = """request_id, record_id, mode, id_employee, fio, id_region, id_company, l_faktor,
    j_faktor, x_faktor, birth_date, date_devations, uik, uik_num"""
_COPY = """(SELECT * FROM fx_invoice_line
    WHERE inv_id <= (SELECT MAX(o_orderkey) // 2 FROM orders))"""
_DRIFT = """
    WITH here AS (
        SELECT *, (inv_id // 512) % 7 = 3 AS hit FROM fx_invoice_line),
    moved AS (
        SELECT CASE WHEN hit AND inv_id % 5 = 0 THEN inv_id + 1000000000 ELSE inv_id END AS inv_id, service_id,
            CASE WHEN hit AND inv_id % 5 = 1 THEN days + 1 ELSE days END AS days, nb_guests FROM here),
    a AS (SELECT inv_id, service_id,
            string_agg(concat(days, ':', nb_guests), ',' ORDER BY days, nb_guests) AS held
        FROM fx_invoice_line GROUP BY ALL),
    b AS (SELECT inv_id, service_id,
            string_agg(concat(days, ':', nb_guests), ',' ORDER BY days, nb_guests) AS held
        FROM moved GROUP BY ALL),
    found AS (
        SELECT COALESCE(a.inv_id, b.inv_id) AS inv_id, COALESCE(a.service_id, b.service_id) AS service_id,
            CASE WHEN b.held IS NULL THEN 'new' WHEN a.held IS NULL THEN 'gone' ELSE 'changed' END AS change
        FROM a FULL JOIN b ON a.inv_id = b.inv_id AND a.service_id = b.service_id
        WHERE a.held IS DISTINCT FROM b.held)"""
_NAME = "split_part(fio, ' ', {}) AS {}"
_PERSON = """id_employee, split_part(fio, ' ', 1) AS first_name,
    split_part(fio, ' ', 2) AS last_name, split_part(fio, ' ', 3) AS sur_name, birth_date"""

SELECTS.update(
    {
        "tag_batch": "SELECT 'batch-1' AS request_id, * FROM fx_invoice_line",
        "emissions_extract": "SELECT * FROM extract",
        "filter_in": """
            SELECT nvos_id, code, name, location, category, CAST(org_id AS BIGINT) AS org_id
            FROM fx_nvos WHERE category IN ('I', 'III')""",
        "ledger_running": """
            SELECT request_id, filename FROM file_ledger
            WHERE table_name = 'DWH_DSO_1STGemployees' AND status = 'RUNNING'
            ORDER BY load_date NULLS LAST, request_id LIMIT 1""",
        "filter_not_in_status": """
            SELECT filename FROM file_ledger WHERE status NOT IN ('RUNNING', 'FAILED')""",
        "new_files_anti_join": """
            SELECT filename FROM file_listing
            EXCEPT SELECT filename FROM file_ledger WHERE status NOT IN ('RUNNING', 'FAILED')""",
        "route_by_name": """
            SELECT filename, CASE WHEN contains(filename, 'region') THEN 'region'
                WHEN contains(filename, 'companies') THEN 'companies'
                WHEN contains(filename, 'employee') THEN 'employee' END AS route
            FROM file_listing""",
        "ledger_status_update": """
            SELECT request_id, table_name, filename, load_date,
                CASE WHEN request_id = (SELECT request_id FROM file_ledger
                        WHERE table_name = 'DWH_AO_0regions' AND status = 'RUNNING'
                        ORDER BY load_date NULLS LAST, request_id LIMIT 1)
                     THEN 'SUCCESS' ELSE status END AS status
            FROM file_ledger""",
        "latest_request": """
            SELECT request_id FROM file_ledger WHERE table_name = 'DWH_AO_0companies'
            ORDER BY load_date DESC NULLS FIRST, request_id LIMIT 1""",
        "typed_projection": """
            SELECT request_id, record_id, CAST(id_employee AS BIGINT) AS id_employee, fio,
                id_region, id_company, l_faktor, j_faktor, x_faktor, birth_date, date_devations,
                uik, uik_num
            FROM stg_emp""",
        "range_drift": f"""SELECT * FROM ({_DRIFT}
            SELECT inv_id // 512 * 512 AS range_low, COUNT(*) FILTER (change = 'new') AS n_new,
                COUNT(*) FILTER (change = 'gone') AS n_gone, COUNT(*) FILTER (change = 'changed') AS n_changed
            FROM found GROUP BY 1)""",
        "row_drift": f"""SELECT * FROM ({_DRIFT}
            SELECT inv_id // 512 * 512 AS range_low, inv_id, service_id, change FROM found)""",
        "typed_quarantine": """
            SELECT record_id, fio,
                CASE WHEN record_id % 11 <> 0 AND record_id % 13 <> 0 THEN id_region END AS id_region,
                concat_ws(',', CASE WHEN record_id % 11 = 0 THEN 'id_region' END,
                    CASE WHEN record_id % 13 = 0 THEN 'birth_date' END) AS rejected,
                CASE WHEN record_id % 11 = 0 THEN 'n/a'
                    WHEN record_id % 13 = 0 THEN CAST(id_region AS VARCHAR) END AS raw_region
            FROM stg_emp""",
        "typed_regions": """
            SELECT CAST(id_region AS BIGINT) AS id_region, region_name, region_parent,
                CAST(round(CAST(population AS DECIMAL(12,2)), 0) AS BIGINT) AS population,
                name_eng, CAST(code AS BIGINT) AS code, CAST(region_oktmo AS BIGINT) AS region_oktmo,
                CAST(trim(region_okato) AS BIGINT) AS region_okato,
                CAST(NULLIF(f_value, '') AS BIGINT) AS f_value
            FROM stg_reg""",
        "blank_to_null_cast": """
            SELECT id_region, CAST(NULLIF(f_value, '') AS BIGINT) AS f_value FROM stg_reg""",
        "blank_to_null_frame": """
            SELECT nvos_id, NULLIF(code, '') AS code, NULLIF(name, '') AS name,
                NULLIF(location, '') AS location, NULLIF(category, '') AS category,
                CAST(org_id AS BIGINT) AS org_id
            FROM fx_nvos""",
        "null_to_zero_measures": f"SELECT nvos_id, {_EXTRACT_MEASURES} FROM extract",
        "split_full_name": f"""
            SELECT record_id, {_NAME.format(1, "first_name")}, {_NAME.format(2, "last_name")},
                {_NAME.format(3, "sur_name")}
            FROM stg_emp""",
        "addr_postcode": "SELECT nvos_id, postcode FROM parsed",
        "addr_region": "SELECT nvos_id, region FROM parsed",
        "addr_locality": "SELECT nvos_id, locality FROM parsed",
        "addr_street": "SELECT nvos_id, street FROM parsed",
        "addr_house": "SELECT nvos_id, house_number FROM parsed",
        "org_name_extract": "SELECT nvos_id, NULLIF(org_name, '') AS org_name FROM parsed",
        "digits_only": "SELECT nvos_id, NULLIF(inn, '') AS inn FROM parsed",
        "collapse_whitespace": """
            SELECT nvos_id, regexp_replace(name, '\\s+', ' ', 'g') AS object_name,
                regexp_replace(location, '\\s+', ' ', 'g') AS object_location
            FROM fx_nvos""",
        "parse_ru_decimal": """
            SELECT nvos_id,
                CAST(replace(replace(NULLIF(total, ''), ' ', ''), ',', '.') AS DOUBLE) AS emission_total
            FROM fx_meas""",
        "category_recode": """
            SELECT nvos_id, category,
                CASE category WHEN 'I' THEN 'Первая категория' WHEN 'II' THEN 'Вторая категория'
                    WHEN 'III' THEN 'Третья категория' WHEN 'IV' THEN 'Четвёртая категория' END AS category_name,
                CAST(CASE category WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 ELSE 4 END AS BIGINT) AS category_num
            FROM fx_nvos""",
        "latest_request_rows": "SELECT * FROM reg_latest",
        "lookup_codes_by_name": """
            SELECT request_id, CAST(id_company AS VARCHAR) AS id_company, type_company_cd, type_industry_cd
            FROM stg_com JOIN type_com ON type_company = type_company_name
            JOIN type_ind ON type_industry = type_indystry_name""",
        "lookup_left": """
            SELECT inv_id, cust_id,
                (SELECT last_name FROM fx_customer c WHERE c.cust_id = s.cust_id AND c.age >= 18) AS last_name
            FROM fx_sales s""",
        "distinct_type_company": "SELECT DISTINCT type_company FROM stg_com",
        "except_new_ids": """
            SELECT CAST(id_employee AS BIGINT) AS id_employee FROM emp_batch
            EXCEPT SELECT id_employee FROM live""",
        "intersect_known_ids": """
            SELECT CAST(id_employee AS BIGINT) AS id_employee FROM emp_batch
            INTERSECT SELECT id_employee FROM live""",
        "append_new_dim_values": "SELECT * FROM all_type_ind",
        "insert_ignore": """
            SELECT cust_id, CASE WHEN age >= 18 THEN last_name ELSE first_name END AS last_name
            FROM fx_customer""",
        "upsert_regions": """
            SELECT * FROM reg_typed
            UNION ALL BY NAME
            SELECT * FROM reg_target WHERE id_region NOT IN (SELECT id_region FROM reg_typed)""",
        "latest_per_key": """
            SELECT id_employee, record_id, date_devations, fio FROM (
                SELECT CAST(id_employee AS BIGINT) AS id_employee, record_id, date_devations, fio,
                    row_number() OVER (PARTITION BY CAST(id_employee AS BIGINT)
                        ORDER BY date_devations DESC NULLS FIRST, record_id DESC) AS rn
                FROM stg_emp)
            WHERE rn = 1""",
        "surrogate_key_dense": """
            SELECT company_name, type_company, id_region,
                row_number() OVER (ORDER BY company_name NULLS FIRST, type_company NULLS FIRST,
                    id_region NULLS FIRST) AS id
            FROM (SELECT DISTINCT company_name, type_company, CAST(id_region AS VARCHAR) AS id_region
                  FROM stg_com)""",
        "cdc_next_request": "SELECT request_id FROM next_req",
        "cdc_changes": f"SELECT {_LOG} FROM emp_changes",
        "cdc_backlog": f"SELECT {_LOG} FROM emp_backlog",
        "upsert_partitions": f"SELECT {_PERSON} FROM emp_all",
        "cdc_create": f"SELECT {_LOG} FROM emp_changes WHERE mode = 'CREATE'",
        "cdc_update": f"SELECT {_LOG} FROM emp_changes WHERE mode = 'UPDATE'",
        "current_persons": f"SELECT {_PERSON} FROM emp_newest",
        "current_employment": """
            SELECT id_employee, id_region, id_company, l_faktor, j_faktor, x_faktor,
                date_devations, uik, uik_num
            FROM emp_newest""",
        "upsert_latest": f"SELECT {_PERSON} FROM emp_newest",
        "load_companies": """
            SELECT id_company, company_name, company_parent, id_region, type_company_cd,
                type_industry_cd, CAST(round(rosstat, 0) AS BIGINT) AS rosstat, create_date, date2, inn
            FROM com_latest JOIN all_type_com ON type_company = type_company_name
            JOIN all_type_ind ON type_industry = type_indystry_name""",
        "composite_key": """
            SELECT inv_id, service_id, concat(inv_id, service_id) AS compose_key
            FROM fx_invoice_line""",
        "count_drift": f"""
            SELECT s.n AS source_count, t.n AS target_count, s.n <> t.n AS changed
            FROM (SELECT COUNT(*) AS n FROM fx_invoice_line) s, (SELECT COUNT(*) AS n FROM {_COPY}) t""",
        "high_watermark_key": f"""
            SELECT inv_id, service_id FROM {_COPY} ORDER BY inv_id DESC, service_id DESC LIMIT 1""",
        "rows_after_watermark": f"""
            SELECT l.* FROM fx_invoice_line l,
                (SELECT inv_id AS i, service_id AS s FROM {_COPY} ORDER BY i DESC, s DESC LIMIT 1) top
            WHERE l.inv_id > i OR (l.inv_id = i AND l.service_id > s)""",
        "rows_not_loaded": f"""
            SELECT l.* FROM fx_invoice_line l WHERE NOT EXISTS (SELECT 1 FROM {_COPY} c
                WHERE c.inv_id = l.inv_id AND c.service_id = l.service_id)""",
        "dim_resort": "SELECT resort_id, resort, country_id FROM fx_resort",
        "dim_seller": "SELECT sales_id AS seller_id, sales_person FROM fx_sales_person",
        "dim_service": """
            SELECT service_id, service, sl_id, CAST(price AS DOUBLE) AS price FROM fx_service""",
        "dim_country": "SELECT country_id, country FROM fx_country",
        "dim_service_line": "SELECT sl_id, service_line, resort_id FROM fx_service_line",
        "dim_customer": """
            SELECT cust_id, first_name, last_name, age, city_id, sales_id AS seller_id
            FROM fx_customer""",
        "fact_sale": """
            SELECT inv_id, cust_id, invoice_date, CAST(price AS DOUBLE) AS price, seller_id,
                service_id, sl_id, resort_id, country_id FROM fact""",
        "fact_sale_amount": """
            SELECT inv_id, cust_id, invoice_date, CAST(price * days * nb_guests AS DOUBLE) AS price,
                seller_id, service_id, sl_id, resort_id, country_id FROM fact""",
        "sales_trends_by_month": """
            SELECT y AS sale_year, m AS sale_month, CAST(total AS DOUBLE) AS total_sales FROM monthly""",
        "sales_with_moving_average": """
            SELECT y AS sale_year, m AS sale_month, CAST(total AS DOUBLE) AS total_sales,
                CAST(SUM(total) OVER w AS DOUBLE) / COUNT(total) OVER w AS moving_average
            FROM monthly
            WINDOW w AS (ORDER BY y NULLS LAST, m NULLS LAST ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING)""",
        "sales_growth_by_month": """
            SELECT cur.y AS sale_year, cur.m AS sale_month,
                CAST(cur.total AS DOUBLE) AS current_month_sales,
                CAST(prev.total AS DOUBLE) AS previous_month_sales,
                CAST(cur.total - prev.total AS DOUBLE) AS sales_growth
            FROM monthly cur LEFT JOIN monthly prev ON prev.y = cur.y AND prev.m + 1 = cur.m""",
        "average_sales_by_day_of_week": f"""
            SELECT COALESCE({_WEEKDAYS}[dayofweek(invoice_date) + 1], 'Неизвестный день') AS day_of_week,
                CAST(SUM(price) AS DOUBLE) / COUNT(price) AS average_sale
            FROM fact GROUP BY 1""",
        "average_sales_by_day_of_week_shifted": f"""
            SELECT COALESCE({_WEEKDAYS}[(dayofweek(invoice_date) + 1) % 7 + 1], 'Неизвестный день') AS day_of_week,
                CAST(SUM(price) AS DOUBLE) / COUNT(price) AS average_sale
            FROM fact GROUP BY 1""",
        "average_sales_by_seller": """
            SELECT sales_person, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS average_sale
            FROM fact JOIN fx_sales_person sp ON sp.sales_id = fact.seller_id GROUP BY sales_person""",
        "sales_by_service": """
            SELECT service, CAST(SUM(fact.price) AS DOUBLE) AS total_sales
            FROM fact JOIN fx_service USING (service_id) GROUP BY service""",
        "customer_age_groups": """
            SELECT CASE WHEN age < 30 THEN '18-29' WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49'
                    WHEN age < 60 THEN '50-59' ELSE '60-80' END AS age_group, COUNT(*) AS customer_count
            FROM fx_customer WHERE age >= 18 AND age <= 80 GROUP BY 1""",
        "customer_age_groups_decades": """
            SELECT CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 10 THEN 'Under 10'
                    WHEN age >= 80 THEN '80 and Over'
                    ELSE CAST(age // 10 AS VARCHAR) || '0-' || CAST(age // 10 AS VARCHAR) || '9' END AS age_group,
                COUNT(*) AS customer_count
            FROM fx_customer GROUP BY 1""",
        "sales_by_country_and_region": """
            SELECT country, resort, invoice_date, CAST(SUM(price) AS DOUBLE) AS total_sales
            FROM fact JOIN fx_country USING (country_id) JOIN fx_resort USING (resort_id)
            GROUP BY ALL""",
        "sales_by_employee": """
            SELECT sales_person, invoice_date, CAST(SUM(price) AS DOUBLE) AS total_price
            FROM fact JOIN fx_sales_person sp ON sp.sales_id = fact.seller_id GROUP BY ALL""",
        "dim_address": "SELECT id, postcode, region, locality, street, house_number FROM addr",
        "dim_organization": """
            SELECT id, NULLIF(org_name, '') AS org_name, NULLIF(inn, '') AS org_inn FROM orgs""",
        "bridge_org_address": "SELECT id, organization_id, address_id FROM bridge",
        "dim_category": """
            SELECT id, CASE category_code WHEN 'I' THEN 'Первая категория' WHEN 'II' THEN 'Вторая категория'
                    WHEN 'III' THEN 'Третья категория' WHEN 'IV' THEN 'Четвёртая категория' END AS category_name,
                category_code,
                CAST(CASE category_code WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 ELSE 4 END AS BIGINT) AS category_num
            FROM category""",
        "emission_objects": """
            SELECT nvos_id * 9 AS id, nvos_id, object_code,
                NULLIF(regexp_replace(object_name, '\\s+', ' ', 'g'), '') AS object_name,
                NULLIF(regexp_replace(object_location, '\\s+', ' ', 'g'), '') AS object_location,
                category.id AS category_id, emission_count, discharge_count, waste_count
            FROM extract JOIN category ON category_code = object_category""",
        "emissions_fact": f"""
            SELECT nvos_id, bridge.id AS org_address_id, nvos_id * 9 AS obj_id, {_EXTRACT_MEASURES}
            FROM extract JOIN parties USING (nvos_id)
            JOIN bridge USING (organization_id, address_id)""",
    }
)


# Jobs end in tables that a query above gives too; the rest reads staged text.
_XML_EMPLOYEES = """
    SELECT id_employee, fio, CAST(id_region AS VARCHAR) AS id_region,
        CAST(id_company AS VARCHAR) AS id_company, CAST(l_faktor AS VARCHAR) AS l_faktor,
        CAST(j_faktor AS VARCHAR) AS j_faktor, CAST(x_faktor AS VARCHAR) AS x_faktor,
        CAST(CAST(birth_date AS DATE) AS VARCHAR) AS birth_date,
        CAST(date_devations AS VARCHAR) AS date_devations, uik, CAST(uik_num AS VARCHAR) AS uik_num
    FROM stg_emp"""
_MONTH_KEY = "concat_ws('|', coalesce(CAST(sale_year AS VARCHAR), '-'), coalesce(CAST(sale_month AS VARCHAR), '-'))"
_DAY_KEY = "coalesce(strftime(invoice_date, '%Y-%m-%d'), '-')"
_CANONICAL = "id_employee = CAST(CAST(id_employee AS BIGINT) AS VARCHAR)"
SELECTS.update(
    {
        "xml_employees": _XML_EMPLOYEES,
        "xml_employees_split": _XML_EMPLOYEES,
        "xml_regions": """
            SELECT region_name, id_region, region_parent, population, name_eng, code,
                region_oktmo, region_okato, f_value
            FROM stg_reg""",
        "xml_companies": """
            SELECT CAST(id_company AS VARCHAR) AS id_company, company_name, company_parent,
                CAST(id_region AS VARCHAR) AS id_region, type_company, type_industry,
                CAST(rosstat AS VARCHAR) AS rosstat,
                CAST(CAST(create_date AS DATE) AS VARCHAR) AS create_date,
                CAST(date2 AS VARCHAR) AS date2, inn
            FROM stg_com""",
        "job_regions_file": SELECTS["upsert_regions"],
        "job_companies_file": SELECTS["load_companies"],
        "job_employees_files": f"""
            SELECT CAST(id_employee AS BIGINT) AS id_employee, first_name, last_name, sur_name, birth_date
            FROM (
                SELECT {_PERSON}, row_number() OVER (PARTITION BY id_employee ORDER BY ts DESC) AS rn
                FROM stg_emp JOIN events ON event_id = record_id WHERE {_CANONICAL})
            WHERE rn = 1""",
        "folder_stream": f"""
            SELECT CAST(id_employee AS BIGINT) AS id_employee, fio, id_region, birth_date,
                ts AS date_devations
            FROM stg_emp JOIN events ON event_id = record_id WHERE {_CANONICAL}""",
        "job_initial_load": SELECTS["sales_by_employee"],
        "job_repeated_load": SELECTS["average_sales_by_day_of_week_shifted"],
        "job_incremental_load": " UNION ALL ".join(
            f"SELECT '{mart}' AS mart, {key} AS key, CAST({value} AS DOUBLE) AS value FROM ({SELECTS[mart]})"
            for mart, value, key in [
                ("sales_trends_by_month", "total_sales", _MONTH_KEY),
                ("sales_with_moving_average", "moving_average", _MONTH_KEY),
                ("sales_growth_by_month", "sales_growth", _MONTH_KEY),
                ("average_sales_by_day_of_week", "average_sale", "day_of_week"),
                ("average_sales_by_seller", "average_sale", "coalesce(sales_person, '-')"),
                ("sales_by_service", "total_sales", "coalesce(service, '-')"),
                ("customer_age_groups", "customer_count", "age_group"),
                (
                    "sales_by_country_and_region",
                    "total_sales",
                    f"concat_ws('|', coalesce(country, '-'), coalesce(resort, '-'), {_DAY_KEY})",
                ),
                ("sales_by_employee", "total_price", f"concat_ws('|', coalesce(sales_person, '-'), {_DAY_KEY})"),
            ]
        ),
        "job_emissions": SELECTS["emissions_fact"],
        "job_emissions_incremental": """
            SELECT 'address' AS table_name, id, concat_ws('|', coalesce(postcode, '-'), coalesce(region, '-'),
                coalesce(locality, '-'), coalesce(street, '-'), coalesce(house_number, '-')) AS key FROM addr_2
            UNION ALL SELECT 'organizations', id, concat_ws('|', coalesce(org_name, '-'), coalesce(inn, '-')) FROM orgs_2
            UNION ALL SELECT 'organizations_x_address', id, concat_ws('|', organization_id, address_id) FROM bridge_2
            UNION ALL SELECT 'environmental_emissions', nvos_id, CAST(id AS VARCHAR)
            FROM parties_2 JOIN bridge_2 USING (organization_id, address_id)""",
    }
)


def with_views(select: str) -> str:
    """``select`` behind the views it needs, in the order they are defined."""
    needed: set[str] = set()

    def need(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                need(VIEWS[name])

    need(select)
    views = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    return f"WITH {', '.join(views)} {select}" if views else select


def oracle_sql() -> dict[str, str]:
    return {name: with_views(select) for name, select in SELECTS.items()}
