"""The tables of ``inputs`` as SQL views, by name.

Fixed values here (address patterns, ledger table names) are those of
``functions.address`` and ``schemas``.
"""

VIEWS = {
    # sales
    "fx_age_group": """
        SELECT DISTINCT (a // 10) AS age_group_id, (a // 10) * 10 AS age_min,
               (a // 10) * 10 + 9 AS age_max,
               CAST((a // 10) * 10 AS VARCHAR) || '-' || CAST((a // 10) * 10 + 9 AS VARCHAR) AS age_range
        FROM (SELECT 5 + c_custkey % 90 AS a FROM customer WHERE c_custkey % 97 <> 0)""",
    "fx_city": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, 'City ' || n_name AS city,
               CAST(n_regionkey AS BIGINT) AS region_id FROM nation""",
    "fx_country": """
        SELECT CAST(r_regionkey AS BIGINT) AS country_id, r_name AS country FROM region""",
    "fx_customer": """
        SELECT c_custkey AS cust_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 97 <> 0 THEN 5 + c_custkey % 90 END AS age,
               '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number,
               c_mktsegment AS address, CAST(c_nationkey AS BIGINT) AS city_id,
               c_custkey % 10 AS sales_id,
               CASE WHEN c_custkey % 7 <> 0 THEN c_custkey - c_custkey % 7 END AS sponsor_id
        FROM customer""",
    "fx_invoice_line": """
        SELECT l_orderkey AS inv_id, l_partkey AS service_id, CAST(l_linenumber AS BIGINT) AS days,
               CAST(l_quantity AS BIGINT) AS nb_guests FROM lineitem""",
    "fx_region": """
        SELECT CAST(r_regionkey AS BIGINT) AS region_id, 'Region ' || r_name AS region,
               CAST(r_regionkey AS BIGINT) AS country_id FROM region""",
    "fx_region_sline": """
        SELECT CAST(substr(p_brand, 7) AS BIGINT) AS sl_id, CAST(p_size % 5 AS BIGINT) AS region_id,
               SUM(CAST(p_retailprice AS DECIMAL(12,2))) AS sales_revenue
        FROM part GROUP BY ALL""",
    "fx_reservation_line": """
        SELECT l_orderkey AS res_id, l_partkey AS service_id,
               CAST(l_linenumber AS BIGINT) AS res_days, CAST(l_quantity AS BIGINT) AS future_guests
        FROM lineitem WHERE l_linestatus = 'O'""",
    "fx_reservations": """
        SELECT o_orderkey AS res_id, o_custkey AS cust_id, o_orderdate AS res_date
        FROM orders WHERE o_orderstatus = 'O'""",
    "fx_resort": """
        SELECT CAST(n_nationkey AS BIGINT) AS resort_id, n_name AS resort,
               CAST(n_regionkey AS BIGINT) AS country_id FROM nation""",
    "fx_sales": """
        SELECT o_orderkey AS inv_id, o_custkey AS cust_id, o_orderdate AS invoice_date FROM orders""",
    "fx_sales_person": """
        SELECT s_suppkey AS sales_id, s_name AS sales_person FROM supplier""",
    "fx_service": """
        SELECT p_partkey AS service_id, p_name AS service,
               CAST(substr(p_brand, 7) AS BIGINT) AS sl_id,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part""",
    "fx_service_line": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS sl_id, p_brand AS service_line,
               CAST(substr(p_brand, 7) AS BIGINT) - 1 AS resort_id FROM part""",
    "fact": """
        SELECT inv.inv_id, inv.cust_id, inv.invoice_date, sv.price, cu.sales_id AS seller_id,
               line.service_id, sv.sl_id, sl.resort_id, re.country_id, line.days, line.nb_guests
        FROM fx_invoice_line line, fx_sales inv, fx_customer cu, fx_service sv,
             fx_service_line sl, fx_resort re
        WHERE line.inv_id = inv.inv_id AND inv.cust_id = cu.cust_id
          AND line.service_id = sv.service_id AND sv.sl_id = sl.sl_id
          AND sl.resort_id = re.resort_id""",
    "monthly": """
        SELECT year(invoice_date) AS y, month(invoice_date) AS m, SUM(price) AS total
        FROM fact GROUP BY 1, 2""",
    # employees
    "stg_emp": """
        SELECT 'req-' || CAST((day(ts) - 1) // 10 AS VARCHAR) AS request_id, event_id AS record_id,
               CASE WHEN event_id % 37 = 0 THEN '0' ELSE '' END || CAST(user_id AS VARCHAR) AS id_employee,
               event_type || ' u' || CAST(user_id AS VARCHAR) || ' x' AS fio,
               event_id % 50 AS id_region, event_id % 70 AS id_company, event_id % 11 AS l_faktor,
               event_id % 13 AS j_faktor, event_id % 17 AS x_faktor,
               CAST(CAST(ts AS DATE) - CAST(user_id % 9000 AS INTEGER) AS TIMESTAMP) AS birth_date,
               CASE WHEN event_id % 53 <> 0 THEN ts END AS date_devations,
               'U' || CAST(event_id % 5 AS VARCHAR) AS uik, event_id % 19 AS uik_num
        FROM events""",
    "emp_ledger": """
        SELECT request_id, 'SUCCESS' AS status, MIN(date_devations) AS load_date
        FROM stg_emp GROUP BY request_id""",
    "emp_log": """
        SELECT request_id, record_id, CASE WHEN record_id % 29 = 0 THEN 'DELETE' ELSE 'CREATE' END AS mode,
               CAST(id_employee AS BIGINT) AS id_employee, fio, id_region, id_company, l_faktor,
               j_faktor, x_faktor, birth_date, date_devations, uik, uik_num
        FROM stg_emp WHERE request_id = 'req-0' AND CAST(id_employee AS BIGINT) % 3 <> 0""",
    "next_req": """
        SELECT request_id FROM emp_ledger
        WHERE status = 'SUCCESS' AND request_id IN (SELECT request_id FROM stg_emp)
          AND request_id NOT IN (SELECT request_id FROM emp_log)
        ORDER BY load_date ASC NULLS LAST, request_id LIMIT 1""",
    "emp_batch": """
        SELECT * FROM stg_emp WHERE request_id = (SELECT request_id FROM next_req)""",
    "live": """
        SELECT DISTINCT id_employee FROM emp_log WHERE mode <> 'DELETE'""",
    "emp_changes": """
        SELECT b.request_id, b.record_id,
               CASE WHEN EXISTS (SELECT 1 FROM live WHERE live.id_employee = CAST(b.id_employee AS BIGINT))
                    THEN 'UPDATE' ELSE 'CREATE' END AS mode,
               CAST(b.id_employee AS BIGINT) AS id_employee, b.fio, b.id_region, b.id_company,
               b.l_faktor, b.j_faktor, b.x_faktor, b.birth_date, b.date_devations, b.uik, b.uik_num
        FROM emp_batch b
        WHERE b.id_employee = CAST(CAST(b.id_employee AS BIGINT) AS VARCHAR)""",
    "emp_newest": """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY id_employee
                   ORDER BY date_devations DESC NULLS FIRST, record_id DESC) AS rn
          FROM (SELECT * FROM emp_log UNION ALL SELECT * FROM emp_changes))
        WHERE rn = 1""",
    "turns": """
        SELECT request_id, row_number() OVER (ORDER BY load_date NULLS LAST, request_id) AS turn
        FROM emp_ledger
        WHERE status = 'SUCCESS' AND request_id IN (SELECT request_id FROM stg_emp)
          AND request_id NOT IN (SELECT request_id FROM emp_log)""",
    "emp_backlog": """
        SELECT request_id, record_id,
               CASE WHEN turn > min(turn) OVER (PARTITION BY CAST(id_employee AS BIGINT))
                      OR CAST(id_employee AS BIGINT) IN (SELECT id_employee FROM live)
                    THEN 'UPDATE' ELSE 'CREATE' END AS mode,
               CAST(id_employee AS BIGINT) AS id_employee, fio, id_region, id_company,
               l_faktor, j_faktor, x_faktor, birth_date, date_devations, uik, uik_num
        FROM stg_emp JOIN turns USING (request_id)
        WHERE id_employee = CAST(CAST(id_employee AS BIGINT) AS VARCHAR)""",
    "emp_all": """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY id_employee
                   ORDER BY date_devations DESC NULLS FIRST, record_id DESC) AS rn
          FROM (SELECT * FROM emp_log UNION ALL SELECT * FROM emp_backlog))
        WHERE rn = 1""",
    # files
    "file_ledger": """
        SELECT 'f-' || CAST(o_orderkey AS VARCHAR) AS request_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'DWH_AO_0regions' WHEN 1 THEN 'DWH_AO_0companies'
                    ELSE 'DWH_DSO_1STGemployees' END AS table_name,
               CASE o_orderkey % 3 WHEN 0 THEN 'region' WHEN 1 THEN 'companies' ELSE 'employee' END
                 || '_' || CAST(o_orderkey AS VARCHAR) || '.xml' AS filename,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'FAILED' END AS status,
               o_orderdate AS load_date
        FROM orders""",
    "file_listing": """
        SELECT filename FROM file_ledger
        UNION ALL SELECT 'note_' || CAST(l_orderkey AS VARCHAR) || '.txt' FROM lineitem""",
    # regions and companies
    "stg_reg": """
        SELECT 'reg-' || CAST(c_custkey % 3 AS VARCHAR) AS request_id, c_name AS region_name,
               CAST(c_custkey AS VARCHAR) AS id_region, c_mktsegment AS region_parent,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS population,
               'Region ' || CAST(c_custkey AS VARCHAR) AS name_eng, CAST(c_nationkey AS VARCHAR) AS code,
               CAST(c_custkey * 1000 + c_nationkey AS VARCHAR) AS region_oktmo,
               ' ' || CAST(c_nationkey AS VARCHAR) || ' ' AS region_okato,
               CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey % 100 AS VARCHAR) END AS f_value
        FROM customer""",
    "reg_ledger": """
        SELECT DISTINCT request_id, 'DWH_AO_0regions' AS table_name,
               DATE '2024-01-01' + CAST(split_part(request_id, '-', 2) AS INTEGER) AS load_date
        FROM stg_reg""",
    "reg_latest": """
        SELECT * FROM stg_reg WHERE request_id =
          (SELECT request_id FROM reg_ledger ORDER BY load_date DESC NULLS FIRST, request_id LIMIT 1)""",
    "reg_typed": """
        SELECT CAST(id_region AS BIGINT) AS id_region, region_name, region_parent,
               CAST(round(CAST(population AS DECIMAL(12,2)), 0) AS BIGINT) AS population, name_eng,
               CAST(code AS BIGINT) AS code, CAST(region_oktmo AS BIGINT) AS region_oktmo,
               CAST(trim(region_okato) AS BIGINT) AS region_okato,
               CAST(NULLIF(f_value, '') AS BIGINT) AS f_value
        FROM reg_latest""",
    "reg_target": """
        SELECT c_custkey AS id_region, 'old ' || c_name AS region_name, c_mktsegment AS region_parent,
               c_custkey AS population, 'old' AS name_eng, c_custkey AS code, c_custkey AS region_oktmo,
               c_custkey AS region_okato, c_custkey AS f_value
        FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "stg_com": """
        SELECT 'com-' || CAST(p_partkey % 3 AS VARCHAR) AS request_id, p_partkey AS id_company,
               p_name AS company_name, p_brand AS company_parent, CAST(p_size AS BIGINT) AS id_region,
               CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS type_company,
               CASE WHEN p_partkey % 43 <> 0 THEN p_brand END AS type_industry,
               CAST(p_retailprice AS DECIMAL(12,2)) AS rosstat,
               CAST(DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) AS create_date,
               CAST(DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP)
                 + INTERVAL '10 hours 20 minutes 30 seconds' AS date2,
               '77' || CAST(p_partkey AS VARCHAR) AS inn
        FROM part""",
    "com_latest": """
        SELECT * FROM stg_com WHERE request_id = (SELECT MAX(request_id) FROM stg_com)""",
    "type_com": """
        SELECT MAX(p_partkey) AS type_company_cd, p_type AS type_company_name
        FROM part WHERE p_size > 40 GROUP BY p_type""",
    "type_ind": """
        SELECT MAX(p_partkey) AS type_industry_cd, p_brand AS type_indystry_name
        FROM part WHERE p_size > 48 GROUP BY p_brand""",
    "new_type_com": """
        SELECT (SELECT COALESCE(MAX(type_company_cd), 0) FROM type_com)
                 + row_number() OVER (ORDER BY v NULLS FIRST) AS type_company_cd, v AS type_company_name
        FROM (SELECT DISTINCT type_company AS v FROM com_latest) n
        WHERE NOT EXISTS (SELECT 1 FROM type_com t WHERE t.type_company_name IS NOT DISTINCT FROM n.v)""",
    "new_type_ind": """
        SELECT (SELECT COALESCE(MAX(type_industry_cd), 0) FROM type_ind)
                 + row_number() OVER (ORDER BY v NULLS FIRST) AS type_industry_cd, v AS type_indystry_name
        FROM (SELECT DISTINCT type_industry AS v FROM com_latest) n
        WHERE NOT EXISTS (SELECT 1 FROM type_ind t WHERE t.type_indystry_name IS NOT DISTINCT FROM n.v)""",
    "all_type_com": "SELECT * FROM type_com UNION ALL SELECT * FROM new_type_com",
    "all_type_ind": "SELECT * FROM type_ind UNION ALL SELECT * FROM new_type_ind",
    # emissions
    "fx_nvos": """
        SELECT c_custkey AS nvos_id, 'OBJ-' || CAST(c_custkey AS VARCHAR) AS code,
               CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'Object  ' || c_mktsegment END AS name,
               'Site ' || chr(9) || ' ' || CAST(c_nationkey AS VARCHAR) AS location,
               CASE c_custkey % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' ELSE 'IV' END AS category,
               c_nationkey AS org_id
        FROM customer""",
    "fx_org": """
        SELECT n_nationkey AS org_id,
               CASE WHEN n_nationkey % 5 = 0 THEN 'ИП ' || n_name ELSE 'ООО "' || n_name || '"' END AS organization_name,
               CASE WHEN n_nationkey % 7 = 0 THEN 'no address'
                    ELSE CAST(100000 + n_nationkey AS VARCHAR) || ', Московская область, г. Химки'
                      || CASE WHEN n_nationkey % 4 = 0 THEN ', улица Ленина' ELSE ', ул. Мира' END
                      || ', д. ' || CAST(n_nationkey % 9 + 1 AS VARCHAR) || 'а' END AS legal_address,
               CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE 'ИНН ' || CAST(7700000000 + n_nationkey AS VARCHAR) END AS inn
        FROM nation""",
    "fx_meas": """
        SELECT c_custkey AS nvos_id, c_custkey % 9 AS n,
               CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 10 AS VARCHAR) || ' '
                    || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ',5' ELSE '' END AS total
        FROM customer WHERE c_acctbal > 0""",
    "extract": """
        SELECT o.nvos_id, o.code AS object_code, o.name AS object_name, o.location AS object_location,
               g.organization_name AS org_name, g.legal_address AS org_address, g.inn,
               o.category AS object_category, m.n AS emission_count, m.total AS emission_total,
               m.n AS discharge_count, m.total AS discharge_total, m.n AS waste_count,
               m.total AS waste_total, m.total AS co2_total
        FROM fx_nvos o JOIN fx_org g USING (org_id) JOIN fx_meas m USING (nvos_id)""",
    "parsed": """
        SELECT nvos_id,
          NULLIF(regexp_extract(org_address, '(\\d{5,6})', 1), '') AS postcode,
          NULLIF(regexp_extract(org_address, ',\\s*([А-Яа-я]*\\s(край|обл|область))', 1), '') AS region,
          NULLIF(regexp_extract(org_address, ',\\s*((?:г\\.|г|город|с\\.|c|село|п\\.|п|пос(е|ё)лок|д\\.|д.|деревня)\\s*[А-Яа-я-]*)\\s*,', 1), '') AS locality,
          NULLIF(regexp_extract(org_address, ',\\s*((пр-кт|ул\\.|ул|улица|пр-д)\\s*[А-Яа-я]*),?|,\\s*([А-Яа-я]*\\s*(улица|ул\\.|ул)),?', 1), '') AS street,
          NULLIF(regexp_extract(org_address, '(?i),\\s*((д|д\\.|дом)\\s*\\d{1,4}[а-я]*)', 1), '') AS house_number,
          CASE WHEN regexp_matches(org_name, '["`].*["`]') THEN regexp_extract(org_name, '["`](.*)["`]', 1) END AS org_name,
          regexp_replace(inn, '\\D', '', 'g') AS inn
        FROM extract""",
    "addr": """
        SELECT row_number() OVER (ORDER BY postcode NULLS FIRST, region NULLS FIRST,
                 locality NULLS FIRST, street NULLS FIRST, house_number NULLS FIRST) AS id, *
        FROM (SELECT DISTINCT postcode, region, locality, street, house_number FROM parsed)""",
    "orgs": """
        SELECT row_number() OVER (ORDER BY org_name NULLS FIRST, inn NULLS FIRST) AS id, *
        FROM (SELECT DISTINCT org_name, inn FROM parsed)""",
    "parties": """
        SELECT p.nvos_id, o.id AS organization_id, a.id AS address_id
        FROM parsed p
        JOIN orgs o ON p.org_name IS NOT DISTINCT FROM o.org_name AND p.inn IS NOT DISTINCT FROM o.inn
        JOIN addr a ON p.postcode IS NOT DISTINCT FROM a.postcode AND p.region IS NOT DISTINCT FROM a.region
         AND p.locality IS NOT DISTINCT FROM a.locality AND p.street IS NOT DISTINCT FROM a.street
         AND p.house_number IS NOT DISTINCT FROM a.house_number""",
    "bridge": """
        SELECT row_number() OVER (ORDER BY organization_id, address_id) AS id, *
        FROM (SELECT DISTINCT organization_id, address_id FROM parties)""",
    # two runs of the emissions job: the ids of the first stay, new tuples go on after the last
    "addr_1": """
        SELECT row_number() OVER (ORDER BY postcode NULLS FIRST, region NULLS FIRST,
                 locality NULLS FIRST, street NULLS FIRST, house_number NULLS FIRST) AS id, *
        FROM (SELECT DISTINCT postcode, region, locality, street, house_number
              FROM parsed WHERE nvos_id % 3 <> 0)""",
    "orgs_1": """
        SELECT row_number() OVER (ORDER BY org_name NULLS FIRST, inn NULLS FIRST) AS id,
            NULLIF(org_name, '') AS org_name, NULLIF(inn, '') AS inn
        FROM (SELECT DISTINCT org_name, inn FROM parsed WHERE nvos_id % 3 <> 0)""",
    "clean": """
        SELECT nvos_id, postcode, region, locality, street, house_number,
            NULLIF(org_name, '') AS org_name, NULLIF(inn, '') AS inn FROM parsed""",
    "bridge_1": """
        SELECT row_number() OVER (ORDER BY organization_id, address_id) AS id, *
        FROM (SELECT DISTINCT o.id AS organization_id, a.id AS address_id
              FROM clean p
              JOIN orgs_1 o ON p.org_name IS NOT DISTINCT FROM o.org_name AND p.inn IS NOT DISTINCT FROM o.inn
              JOIN addr_1 a ON p.postcode IS NOT DISTINCT FROM a.postcode AND p.region IS NOT DISTINCT FROM a.region
               AND p.locality IS NOT DISTINCT FROM a.locality AND p.street IS NOT DISTINCT FROM a.street
               AND p.house_number IS NOT DISTINCT FROM a.house_number
              WHERE nvos_id % 3 <> 0)""",
    "last_id": """
        SELECT max(id) AS n FROM (SELECT id FROM addr_1 UNION ALL SELECT id FROM orgs_1
                                  UNION ALL SELECT id FROM bridge_1)""",
    "addr_2": """
        SELECT * FROM addr_1 UNION ALL
        SELECT (SELECT n FROM last_id) + row_number() OVER (ORDER BY postcode NULLS FIRST, region NULLS FIRST,
                 locality NULLS FIRST, street NULLS FIRST, house_number NULLS FIRST), *
        FROM (SELECT postcode, region, locality, street, house_number FROM clean
              EXCEPT SELECT postcode, region, locality, street, house_number FROM addr_1)""",
    "orgs_2": """
        SELECT * FROM orgs_1 UNION ALL
        SELECT (SELECT n FROM last_id) + row_number() OVER (ORDER BY org_name NULLS FIRST, inn NULLS FIRST), *
        FROM (SELECT org_name, inn FROM clean EXCEPT SELECT org_name, inn FROM orgs_1)""",
    "parties_2": """
        SELECT p.nvos_id, min(o.id) AS organization_id, a.id AS address_id
        FROM clean p
        JOIN orgs_2 o ON p.org_name IS NOT DISTINCT FROM o.org_name AND p.inn IS NOT DISTINCT FROM o.inn
        JOIN addr_2 a ON p.postcode IS NOT DISTINCT FROM a.postcode AND p.region IS NOT DISTINCT FROM a.region
         AND p.locality IS NOT DISTINCT FROM a.locality AND p.street IS NOT DISTINCT FROM a.street
         AND p.house_number IS NOT DISTINCT FROM a.house_number
        GROUP BY p.nvos_id, a.id""",
    "bridge_2": """
        SELECT * FROM bridge_1 UNION ALL
        SELECT (SELECT n FROM last_id) + row_number() OVER (ORDER BY organization_id, address_id), *
        FROM (SELECT organization_id, address_id FROM parties_2
              EXCEPT SELECT organization_id, address_id FROM bridge_1)""",
    "category": """
        SELECT f.code AS category_code,
               (SELECT COUNT(*) FROM extract e WHERE e.nvos_id < f.first_id) * 12 + 1 AS id
        FROM (SELECT object_category AS code, MIN(nvos_id) AS first_id FROM extract GROUP BY 1) f""",
}
