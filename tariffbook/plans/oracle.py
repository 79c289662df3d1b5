"""The queries of ``catalogue.py`` as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

# White space of any kind, and addresses: one @, then a dot, none of them twice.
_SPACE = r"\s\v\x1c-\x1f\x85\p{Z}"
_EMAIL = rf"[{_SPACE}]*[^@{_SPACE}]+@[^@{_SPACE}]+\.[^@{_SPACE}]+[{_SPACE}]*"
# Phones: without look-around, so every sign that may stand between two of them is doubled first.
_DOUBLED = "regexp_replace(text, '([^0-9A-Za-z.()+-])', '\\1\\1', 'g')"
_NUMBER = r"(?:\+?\d{1,3}(?:  |[.-]))?(?:\(\d\d\d\)(?:  )?|\d\d\d(?:  |[.-])?)\d\d\d(?:  |[.-])?\d\d\d\d"
_ALONE = rf"(?:^|[^0-9A-Za-z.()+-])({_NUMBER})(?:$|\.$|[^0-9A-Za-z.()+-]|\.[^0-9A-Za-z])"
_INPUT_TABLES = ("customer", "nation", "part", "orders", "lineitem", "documents")


def _country_of(n: str) -> str:
    return f"""CASE {n} % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'us' WHEN 2 THEN ' United States ' WHEN 3 THEN 'U.K.'
        WHEN 4 THEN 'England' WHEN 5 THEN 'CAN' WHEN 6 THEN '  ' WHEN 7 THEN NULL ELSE n_name END"""


def _normalised(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'Unknown'
        WHEN lower(trim({c})) IN ('usa', 'us', 'united states') THEN 'United States'
        WHEN lower(trim({c})) IN ('u.k.', 'england') THEN 'United Kingdom'
        WHEN lower(trim({c})) IN ('canada', 'can') THEN 'Canada'
        ELSE trim({c}) END"""


def _phone(c: str) -> str:
    digits = rf"regexp_replace({c}, '\P{{Nd}}', '', 'g')"
    return f"CASE WHEN length({digits}) = 10 THEN {digits}[1:3] || '-' || {digits}[4:6] || '-' || {digits}[7:] END"


def _valid_email(c: str) -> str:
    return f"coalesce(regexp_full_match({c}, '{_EMAIL}'), false)"


def _name(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'Unknown' ELSE {c} END"


def _date(c: str) -> str:
    return f"CAST(coalesce(try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%Y-%m-%d')) AS DATE)"


def _amount(cents: str) -> str:
    return f"({cents} // 100) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"


def _cents(c: str) -> str:
    return f"CAST(100 * TRY_CAST({c} AS DECIMAL(18, 4)) AS BIGINT)"


def _mean(x: str, per_unit: int) -> str:
    """Half-up mean to two places of a non-negative whole number counted in 1/per_unit."""
    scale = 100 // per_unit
    return f"((2 * {scale} * CAST(sum({x}) AS BIGINT) + count({x})) // nullif(2 * count({x}), 0)) / 100.0"


_VIEWS = {
    "raw_subscribers": f"""
        SELECT c_custkey AS subscriber_id,
            CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '  ' ELSE c_name END AS name,
            CASE WHEN c_custkey % 17 = 0 THEN NULL
                WHEN c_custkey % 19 = 0 THEN 'invalid-email'
                WHEN c_custkey % 23 = 0 THEN 'a b' || c_custkey || '@x.com'
                WHEN c_custkey % 10 < 3 THEN 'u' || (c_custkey - c_custkey % 10) || '@mail.example.com'
                ELSE 'u' || c_custkey || '@mail.example.com' END AS email,
            CASE c_custkey % 5
                WHEN 0 THEN '(555) ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '.0001'
                WHEN 1 THEN '555' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0')
                WHEN 2 THEN '+1 555 ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ' 0002'
                WHEN 4 THEN '555-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-0003' END AS phone,
            {_country_of('c_nationkey')} AS country,
            CASE WHEN c_custkey % 31 = 0 THEN 'last spring' WHEN c_custkey % 29 <> 0
                THEN strftime(DATE '1994-01-01' + CAST(c_custkey * 37 % 1500 AS INTEGER), '%Y-%m-%d') END AS signup_date,
            CASE WHEN c_custkey % 37 = 0 THEN 'forty' ELSE CAST(18 + c_custkey % 60 AS VARCHAR) END AS age
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_plans": f"""
        SELECT CASE WHEN s % 97 = 0 THEN NULL WHEN s % 101 = 0 THEN '  '
                ELSE CAST(p_partkey AS VARCHAR) END AS plan_id,
            p_type AS plan_tier,
            CASE WHEN s % 31 = 0 THEN NULL WHEN s % 17 = 0 THEN '-5.00' WHEN s % 37 = 0 THEN '-0.00001'
                WHEN s % 41 = 0 THEN 'on request' WHEN s % 43 = 0 THEN ''
                ELSE {_amount('(CAST(round(p_retailprice * 100) AS BIGINT) + 100 * k)')} END AS price,
            CASE WHEN p_partkey % 40 = 3 THEN strftime(week, '%Y-%m-%d')
                WHEN k % 2 = 0 THEN '1/1/' || (1995 + k) ELSE (1995 + k) || '-01-01' END AS effective_date,
            CASE WHEN p_partkey % 40 = 3 THEN CASE WHEN k = 364 THEN NULL WHEN k % 10 = 9 THEN 'open'
                    ELSE strftime(week + CASE k % 10 WHEN 3 THEN 10 WHEN 6 THEN -3 ELSE 6 END, '%Y-%m-%d') END
                WHEN k = 6 THEN NULL WHEN k % 2 = 0 THEN '12/31/' || (1995 + k)
                ELSE (1995 + k) || '-12-31' END AS end_date
        FROM (SELECT *, p_partkey + k AS s, DATE '1995-01-01' + CAST(7 * k AS INTEGER) AS week FROM (
            SELECT *, unnest(range(CASE WHEN p_partkey % 40 = 3 THEN 365 ELSE 7 END)) AS k FROM part))""",
    "raw_subscriptions": f"""
        SELECT l_orderkey * 10 + l_linenumber AS subscription_id,
            CASE WHEN o_custkey % 59 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS subscriber_id,
            CASE WHEN l_partkey % 53 = 0 THEN 'X' ELSE '' END || l_partkey AS plan_id,
            month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS subscription_start_date,
            CASE WHEN l_linestatus <> 'O'
                THEN month(finish) || '/' || day(finish) || '/' || year(finish) END AS subscription_end_date,
            CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN l_linenumber = 7 THEN NULL
                WHEN l_linenumber = 6 THEN 'Cancelled' ELSE 'active' END AS status,
            {_country_of('(c_nationkey + l_linenumber)')} AS billing_country,
            CASE WHEN l_partkey % 19 = 0 THEN 'waived' WHEN l_partkey % 23 = 0 THEN ''
                WHEN l_discount <> 0 THEN {_amount('CAST(round(l_extendedprice * 100) AS BIGINT)')} END AS charge,
            CASE WHEN l_partkey % 29 = 0 THEN 'n/a'
                ELSE (tenths // 10) || '.' || (tenths % 10) END AS rating
        FROM (SELECT *, CAST(o_orderdate AS DATE) + CAST(l_quantity * 10 AS INTEGER) AS finish,
                CAST(l_quantity AS BIGINT) % 41 + 10 AS tenths
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "valid_subscribers": f"SELECT * FROM raw_subscribers WHERE {_valid_email('email')}",
    "kept_subscribers": """
        SELECT * REPLACE (TRY_CAST(signup_date AS DATE) AS signup_date, TRY_CAST(age AS INTEGER) AS age)
        FROM valid_subscribers QUALIFY row_number() OVER (
            PARTITION BY email ORDER BY TRY_CAST(valid_subscribers.signup_date AS DATE) NULLS FIRST, subscriber_id) = 1""",
    "subscribers": f"""
        SELECT subscriber_id, {_name('name')} AS name, email, {_phone('phone')} AS phone,
            {_normalised('country')} AS country, signup_date, age
        FROM kept_subscribers""",
    "valid_plans": f"""
        SELECT *, {_cents('price')} AS price_cents FROM raw_plans
        WHERE trim(plan_id) <> '' AND TRY_CAST(price AS DOUBLE) >= 0""",
    "history": f"""
        SELECT plan_id, plan_tier, price_cents, {_date('effective_date')} AS effective_date,
            CASE WHEN end_date IS NULL THEN DATE '9999-12-31' ELSE {_date('end_date')} END AS end_date
        FROM valid_plans""",
    "current_price": """
        SELECT plan_id, price_cents AS current_price_cents FROM history
        QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY effective_date DESC NULLS LAST) = 1""",
    "typed": f"""
        SELECT subscription_id, subscriber_id, plan_id, {_date('subscription_start_date')} AS subscription_start_date,
            {_date('subscription_end_date')} AS subscription_end_date, status,
            {_normalised('billing_country')} AS billing_country,
            coalesce({_cents('charge')}, 0) AS charge_cents, CAST(10 * TRY_CAST(rating AS DECIMAL(9, 4)) AS BIGINT) AS rating_tenths
        FROM raw_subscriptions""",
    "fact": """
        SELECT * FROM typed WHERE subscriber_id IN (SELECT subscriber_id FROM subscribers)
            AND plan_id IN (SELECT plan_id FROM history) AND status <> 'cancelled'""",
    "priced": """
        SELECT f.*, h.plan_tier, h.price_cents AS actual_cents, c.current_price_cents
        FROM fact f
        LEFT JOIN history h ON f.plan_id = h.plan_id
            AND f.subscription_start_date BETWEEN h.effective_date AND h.end_date
        LEFT JOIN current_price c ON f.plan_id = c.plan_id""",
    "enriched": """
        SELECT p.*, s.name, s.email, s.country, s.age, s.signup_date,
            count(subscription_id) OVER (PARTITION BY p.subscriber_id) AS total_subscriptions,
            CAST(date_diff('day', subscription_start_date,
                coalesce(subscription_end_date, DATE '2002-01-01')) AS INTEGER) AS duration_days,
            strftime(subscription_start_date, '%Y-%m') AS subscription_month
        FROM priced p JOIN subscribers s ON p.subscriber_id = s.subscriber_id""",
    "revenue": f"""
        SELECT subscription_month, billing_country, plan_tier,
            CAST(sum(actual_cents) AS BIGINT) / 100.0 AS total_revenue,
            count(subscription_id) AS num_active_subscriptions,
            {_mean('actual_cents', 100)} AS avg_price_in_effect
        FROM enriched GROUP BY ALL""",
    "delivered_rows": """
        SELECT 'a/' || source AS path, 1 AS number, doc_id, text, lang FROM documents
        UNION ALL
        SELECT 'b/' || source || '-' || part, 2, doc_id, CASE WHEN edited THEN text || '.' ELSE text END, lang
        FROM (SELECT *, unnest(['1', '2']) AS part FROM (
            SELECT *, doc_id % 2 = 0 AND doc_id = max(doc_id) OVER (PARTITION BY source) AS edited FROM documents))""",
    "delivered_files": """
        SELECT path, number, count(*) AS "rows",
            list(struct_pack(doc_id := doc_id, text := text, lang := lang) ORDER BY doc_id, lang, text) AS content
        FROM delivered_rows GROUP BY path, number""",
    "rejected_rows": f"""
        SELECT 'subscribers' AS "table", CAST(subscriber_id AS VARCHAR) AS record_id, 'invalid_email' AS rule
        FROM raw_subscribers WHERE NOT {_valid_email('email')}
        UNION ALL
        SELECT 'subscribers', CAST(subscriber_id AS VARCHAR), 'duplicate_email' FROM valid_subscribers
        WHERE subscriber_id NOT IN (SELECT subscriber_id FROM kept_subscribers)
        UNION ALL
        SELECT 'plans', plan_id, CASE WHEN plan_id IS NULL OR trim(plan_id) = '' THEN 'blank_plan_id'
            ELSE 'null_or_negative_price' END
        FROM raw_plans WHERE plan_id IS NULL OR trim(plan_id) = '' OR NOT coalesce(TRY_CAST(price AS DOUBLE) >= 0, false)
        UNION ALL
        SELECT 'subscriptions', CAST(subscription_id AS VARCHAR), rule FROM (
            SELECT subscription_id,
                CASE WHEN subscriber_id NOT IN (SELECT subscriber_id FROM subscribers) THEN 'orphan_subscriber'
                    WHEN plan_id NOT IN (SELECT plan_id FROM history) THEN 'orphan_plan'
                    WHEN status = 'cancelled' THEN 'cancelled'
                    WHEN status IS NULL THEN 'null_status' END AS rule
            FROM raw_subscriptions) WHERE rule IS NOT NULL""",
}

_QUERIES = {
    "normalise_country": f"""
        SELECT subscriber_id, country AS country_raw, {_normalised('country')} AS country FROM raw_subscribers""",
    "normalise_phone": f"SELECT subscriber_id, {_phone('phone')} AS phone FROM raw_subscribers",
    "phone_from_documents": f"""
        SELECT doc_id, token, {_phone('token')} AS phone
        FROM (SELECT doc_id, replace(unnest(regexp_extract_all({_DOUBLED}, '{_ALONE}', 1)), '  ', ' ') AS token FROM documents)""",
    "valid_email_filter": "SELECT subscriber_id, email FROM valid_subscribers",
    "email_from_documents": f"""
        SELECT doc_id, token, {_valid_email('token')} AS is_valid
        FROM (SELECT doc_id, unnest(string_split_regex(text, '[{_SPACE}]+')) AS token FROM documents)
        WHERE contains(token, '@')""",
    "fill_missing_name": f"SELECT subscriber_id, {_name('name')} AS name FROM raw_subscribers",
    "trim_all_strings": """
        SELECT subscriber_id, trim(name) AS name, trim(email) AS email, trim(phone) AS phone,
            trim(country) AS country, signup_date, age
        FROM raw_subscribers""",
    "parse_dates_multi": f"""
        SELECT plan_id, raw, {_date('raw')} AS parsed
        FROM (SELECT plan_id, effective_date AS raw FROM raw_plans
            UNION ALL SELECT plan_id, end_date FROM raw_plans)""",
    "plan_rows_valid": "SELECT plan_id, plan_tier, price_cents, effective_date, end_date FROM valid_plans",
    "plan_price_history": """
        SELECT plan_id, plan_tier, price_cents, effective_date, end_date,
            CASE WHEN end_date >= DATE '2002-01-01' THEN 'Y' ELSE 'N' END AS is_active
        FROM history""",
    "current_prices": "SELECT plan_id, current_price_cents FROM current_price",
    "dedup_earliest_signup": "SELECT email, subscriber_id, signup_date FROM kept_subscribers",
    "clean_subscribers": "SELECT * FROM subscribers",
    "fill_monthly_charge": "SELECT subscription_id, charge_cents / 100.0 AS charge FROM typed",
    "orphan_subscribers": """
        SELECT subscription_id FROM raw_subscriptions
        WHERE subscriber_id NOT IN (SELECT subscriber_id FROM subscribers)""",
    "orphan_plans": """
        SELECT subscription_id FROM raw_subscriptions WHERE plan_id NOT IN (SELECT plan_id FROM history)""",
    "valid_subscriber_semi": """
        SELECT subscription_id FROM raw_subscriptions
        WHERE subscriber_id IN (SELECT subscriber_id FROM subscribers)""",
    "valid_plan_semi": """
        SELECT subscription_id FROM raw_subscriptions WHERE plan_id IN (SELECT plan_id FROM history)""",
    "distinct_plan_keys": "SELECT DISTINCT plan_id FROM history",
    "active_status_filter": "SELECT subscription_id, status FROM raw_subscriptions WHERE status <> 'cancelled'",
    "clean_subscriptions": """
        SELECT subscription_id, subscriber_id, plan_id, subscription_start_date, subscription_end_date, status,
            billing_country, charge_cents / 100.0 AS monthly_charge, rating_tenths / 10.0 AS satisfaction_rating
        FROM fact""",
    "rejects_by_rule": """SELECT "table", rule, count(*) AS "rows" FROM rejected_rows GROUP BY ALL""",
    "rejected_records": """
        SELECT "table", record_id, rule, count(*) AS "rows" FROM rejected_rows GROUP BY ALL""",
    "scd_price_resolution": """
        SELECT subscription_id, plan_id, subscription_start_date, plan_tier,
            actual_cents / 100.0 AS actual_monthly_price
        FROM priced""",
    "scd_price_as_of": """
        SELECT * FROM (WITH versions AS (SELECT *, row_number() OVER () AS id FROM history WHERE effective_date <= end_date),
        twice AS (
            SELECT DISTINCT a.plan_id FROM versions a JOIN versions b ON a.plan_id = b.plan_id AND a.id < b.id
            WHERE a.effective_date <= b.end_date AND b.effective_date <= a.end_date)
        SELECT subscription_id, plan_id, subscription_start_date, plan_tier,
            actual_cents / 100.0 AS actual_monthly_price
        FROM priced WHERE plan_id NOT IN (SELECT plan_id FROM twice))""",
    "price_gaps_and_overlaps": """
        SELECT * FROM (WITH seen AS (
            SELECT *, max(end_date) OVER (
                PARTITION BY plan_id ORDER BY effective_date, end_date, price_cents, plan_tier
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered
            FROM history WHERE effective_date <= end_date)
        SELECT plan_id, 'gap' AS kind, covered + 1 AS first_day, effective_date - 1 AS last_day
        FROM seen WHERE effective_date - 1 > covered
        UNION ALL
        SELECT plan_id, 'overlap', effective_date, least(end_date, covered) FROM seen WHERE effective_date <= covered)""",
    "unresolved_prices": """
        SELECT plan_id, count(*) AS "rows" FROM priced WHERE actual_cents IS NULL GROUP BY plan_id""",
    "price_variance": """
        SELECT subscription_id, actual_cents / 100.0 AS actual_monthly_price,
            current_price_cents / 100.0 AS current_price,
            (actual_cents - current_price_cents) / 100.0 AS price_variance
        FROM priced""",
    "total_subscriptions": "SELECT subscription_id, subscriber_id, total_subscriptions FROM enriched",
    "subscription_duration": """
        SELECT subscription_id, duration_days, duration_days > 183 AS long_term_subscriber
        FROM (SELECT subscription_id, CAST(date_diff('day', subscription_start_date,
            coalesce(subscription_end_date, DATE '2002-01-01')) AS INTEGER) AS duration_days FROM typed)""",
    "subscription_month": """
        SELECT subscription_id, strftime(subscription_start_date, '%Y-%m') AS subscription_month FROM typed""",
    "enriched_subscriptions": """
        SELECT subscriber_id, plan_id, subscription_id, subscription_start_date, subscription_end_date, status,
            billing_country, charge_cents / 100.0 AS monthly_charge, rating_tenths / 10.0 AS satisfaction_rating,
            plan_tier, actual_cents / 100.0 AS actual_monthly_price, current_price_cents / 100.0 AS current_price,
            total_subscriptions, duration_days, duration_days > 183 AS long_term_subscriber, subscription_month,
            (actual_cents - current_price_cents) / 100.0 AS price_variance, name, email, country, age, signup_date
        FROM enriched""",
    "subscriber_summary": f"""
        SELECT billing_country, plan_tier, count(DISTINCT subscriber_id) AS num_subscribers,
            CAST(sum(actual_cents) AS BIGINT) / 100.0 AS total_revenue,
            {_mean('rating_tenths', 10)} AS avg_satisfaction,
            count(subscription_id) AS num_subscriptions
        FROM enriched GROUP BY billing_country, plan_tier ORDER BY billing_country, plan_tier""",
    "monthly_revenue": "SELECT * FROM revenue ORDER BY subscription_month, billing_country, plan_tier",
    "monthly_revenue_top_n": """
        SELECT * FROM revenue ORDER BY total_revenue DESC NULLS LAST, subscription_month NULLS FIRST,
            billing_country NULLS FIRST, plan_tier NULLS FIRST LIMIT 50""",
    "monthly_revenue_preview": """
        SELECT * FROM revenue ORDER BY subscription_month NULLS FIRST, billing_country NULLS FIRST,
            plan_tier NULLS FIRST LIMIT 50""",
    "stage_row_counts": "\n UNION ALL ".join(
        f"""SELECT '{table}' AS "table", count(*) AS "rows" FROM {view}"""
        for table, view in {
            "raw_subscribers": "raw_subscribers",
            "raw_plans": "raw_plans",
            "raw_subscriptions": "raw_subscriptions",
            "clean_subscribers": "subscribers",
            "plan_price_history": "history",
            "enriched_subscriptions": "enriched",
        }.items()
    ),
    "content_hash_dedup": """
        SELECT md5(text) AS content_md5, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY ALL""",
    "input_manifest_missing": """
        SELECT source || '-' || unnest(['de', 'en', 'es', 'fr', 'it']) AS file_name
        FROM (SELECT DISTINCT source FROM documents)
        EXCEPT SELECT source || '-' || lang FROM documents""",
    "delivery_ledger": """
        SELECT path, number, "rows",
            CASE WHEN number = 2 AND content IN (SELECT content FROM delivered_files WHERE number = 1) THEN 'known'
                WHEN row_number() OVER (PARTITION BY number, content ORDER BY path) > 1 THEN 'known'
                ELSE 'landed' END AS state
        FROM delivered_files""",
    "content_digests": """
        SELECT path, md5(concat_ws('|', sum(strlen(text) + 1), count(*), sum(a), sum(a * k), sum(b), sum(b * k))) AS content_md5,
            count(*) AS lines
        FROM (SELECT 'file-' || (doc_id // 1000) AS path, text, doc_id % 1000 AS k,
            CAST(CAST('0x' || md5(text)[1:15] AS BIGINT) AS HUGEINT) AS a,
            CAST(CAST('0x' || md5(text)[17:31] AS BIGINT) AS HUGEINT) AS b FROM documents)
        GROUP BY path""",
    "records_and_bad_lines": """
        SELECT * FROM (WITH texts AS (
            SELECT *, subscriber_id AS key, CAST(subscriber_id AS VARCHAR) AS id, '"' || coalesce(name, '') || ', \\"q\\","' AS quoted,
                [coalesce(email, ''), coalesce(phone, ''), coalesce(country, ''), coalesce(signup_date, ''), coalesce(age, '')] AS rest
            FROM raw_subscribers),
        told AS (
            SELECT *, CASE WHEN key % 13 = 1 THEN 'too_few_fields' WHEN key % 17 = 2 THEN 'too_many_fields'
                WHEN key % 19 = 3 THEN 'open_quote' WHEN key % 23 = 4 THEN 'blank' WHEN key % 29 = 5 THEN 'header'
                ELSE 'record' END AS kind FROM texts)
        SELECT key AS line, kind, CASE kind
                WHEN 'too_few_fields' THEN concat_ws(',', id, quoted, array_to_string(rest, ','))
                WHEN 'too_many_fields' THEN concat_ws(',', id, quoted, array_to_string(rest, ','), 'x,y', 'z')
                WHEN 'open_quote' THEN concat_ws(',', id, quoted, rest[1], rest[2], '"open', rest[4], rest[5], 'x')
                WHEN 'blank' THEN '  '
                WHEN 'header' THEN 'subscriber_id,name,email,phone,country,signup_date,age,note' END AS raw,
            CASE WHEN kind = 'record' THEN id END AS subscriber_id,
            CASE WHEN kind = 'record' THEN coalesce(name, '') || ', "q",' END AS name,
            CASE WHEN kind = 'record' THEN email END AS email, CASE WHEN kind = 'record' THEN country END AS country,
            CASE WHEN kind = 'record' THEN signup_date END AS signup_date, CASE WHEN kind = 'record' THEN age END AS age
        FROM told)""",
    "input_file_rows": "\n UNION ALL ".join(
        f"""SELECT '{table}.parquet' AS file_name, count(*) AS "rows" FROM {table}"""
        for table in _INPUT_TABLES
    ),
}
_QUERIES["monthly_revenue_merged"] = _QUERIES["monthly_revenue"]
_QUERIES["scd_price_resolution_bucketed"] = _QUERIES["scd_price_resolution"]


def oracle_sql() -> dict[str, str]:
    views = ",\n".join(f"{name} AS ({sql})" for name, sql in _VIEWS.items())
    return {name: f"WITH {views}\n{sql.strip()}" for name, sql in _QUERIES.items()}
