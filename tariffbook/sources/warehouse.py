"""Raw subscription tables derived from a customer / part / order star schema.

They carry the faults that the cleaning rules deal with: blanks, malformed and
repeated emails, mixed date formats, bad prices, orphan keys, missing states.
Amounts, ratings, ages and dates are text, as in raw files, some of it unreadable.
All rules are functions of the keys, so the same rows come out everywhere.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Run date for these tables: after the last order.
AS_OF = date(2002, 1, 1)

# Parts whose versions one task makes: 160,000 versions.
PARTS_A_TASK = 10_000

# Columns in use; a given schema spares a footer read per table.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
        l_discount double, l_returnflag string, l_linestatus string""",
    "documents": "doc_id bigint, text string, lang string, source string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _country(n: str) -> str:
    """Country spellings by residue of nine; the last one is the nation's own name."""
    return f"get(array('USA', 'us', ' United States ', 'U.K.', 'England', 'CAN', '  ', null, n_name), {n} % 9)"


def _amount(cents: str) -> str:
    """Text of an amount of zero or more."""
    return f"concat({cents} div 100, '.', lpad({cents} % 100, 2, '0'))"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey)


def raw_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).selectExpr(
        "c_custkey AS subscriber_id",
        "CASE WHEN c_custkey % 11 = 0 THEN null WHEN c_custkey % 13 = 0 THEN '  ' ELSE c_name END AS name",
        """CASE WHEN c_custkey % 17 = 0 THEN null
            WHEN c_custkey % 19 = 0 THEN 'invalid-email'
            WHEN c_custkey % 23 = 0 THEN concat('a b', c_custkey, '@x.com')
            WHEN c_custkey % 10 < 3 THEN concat('u', c_custkey - c_custkey % 10, '@mail.example.com')
            ELSE concat('u', c_custkey, '@mail.example.com') END AS email""",
        """CASE c_custkey % 5
            WHEN 0 THEN concat('(555) ', lpad(c_custkey % 1000, 3, '0'), '.0001')
            WHEN 1 THEN concat('555', lpad(c_custkey % 10000000, 7, '0'))
            WHEN 2 THEN concat('+1 555 ', lpad(c_custkey % 1000, 3, '0'), ' 0002')
            WHEN 4 THEN concat('555-', lpad(c_custkey % 1000, 3, '0'), '-0003') END AS phone""",
        f"{_country('c_nationkey')} AS country",
        """CASE WHEN c_custkey % 31 = 0 THEN 'last spring' WHEN c_custkey % 29 <> 0
            THEN cast(date_add(DATE '1994-01-01', cast(c_custkey * 37 % 1500 AS int)) AS string) END AS signup_date""",
        "CASE WHEN c_custkey % 37 = 0 THEN 'forty' ELSE cast(18 + c_custkey % 60 AS string) END AS age",
    )


def raw_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version a year per part (1995 to 2001), dates written in two formats by turns.

    The parts are dealt to tasks by their number, which the file's footer tells:
    a row of 20 bytes becomes 16 versions, so a split of the file is far too much for one.

    Every fortieth part has a version a week instead. Of these, some run into
    the next week, some end before they start, some have an unreadable end.
    """
    parts = table(spark, sf_dir, "part")
    dealt = parts.repartition(max(1, -(-parts.count() // PARTS_A_TASK))).selectExpr("*", "p_partkey % 40 = 3 AS weekly")
    week, cents = "date_add(DATE '1995-01-01', 7 * k)", "(cast(round(p_retailprice * 100) AS bigint) + 100 * k)"
    # Made by the generator, a text is a column; as an expression it would stand in every use of it in filters and parsers.
    # The numbers are exploded first, as code is compiled for these generators and not for a lambda over the numbers.
    version = f"""named_struct(
        'plan_id', CASE WHEN (p_partkey + k) % 97 = 0 THEN null WHEN (p_partkey + k) % 101 = 0 THEN '  '
            ELSE cast(p_partkey AS string) END,
        'price_per_month', CASE WHEN (p_partkey + k) % 31 = 0 THEN null WHEN (p_partkey + k) % 17 = 0 THEN '-5.00'
            WHEN (p_partkey + k) % 37 = 0 THEN '-0.00001' WHEN (p_partkey + k) % 41 = 0 THEN 'on request'
            WHEN (p_partkey + k) % 43 = 0 THEN '' ELSE {_amount(cents)} END,
        'effective_date', CASE WHEN weekly THEN cast({week} AS string)
            WHEN k % 2 = 0 THEN concat('1/1/', 1995 + k) ELSE concat(1995 + k, '-01-01') END,
        'end_date', CASE WHEN weekly THEN CASE WHEN k = 364 THEN null
                WHEN k % 10 = 3 THEN cast(date_add({week}, 10) AS string)
                WHEN k % 10 = 6 THEN cast(date_add({week}, -3) AS string) WHEN k % 10 = 9 THEN 'open'
                ELSE cast(date_add({week}, 6) AS string) END
            WHEN k = 6 THEN null WHEN k % 2 = 0 THEN concat('12/31/', 1995 + k)
            ELSE concat(1995 + k, '-12-31') END)"""
    numbered = dealt.selectExpr("*", "explode(sequence(0, if(weekly, 364, 6))) AS k")
    versions = numbered.selectExpr("p_type", f"inline(array({version}))")
    return versions.selectExpr("plan_id", "p_type AS plan_tier", "price_per_month", "effective_date", "end_date")


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customers = _customers(spark, sf_dir)
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(
        customers, orders.o_custkey == customers.c_custkey
    )
    return lines.selectExpr(
        "l_orderkey * 10 + l_linenumber AS subscription_id",
        "CASE WHEN o_custkey % 59 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS subscriber_id",
        "concat(CASE WHEN l_partkey % 53 = 0 THEN 'X' ELSE '' END, l_partkey) AS plan_id",
        "date_format(o_orderdate, 'M/d/yyyy') AS subscription_start_date",
        """CASE WHEN l_linestatus <> 'O' THEN date_format(
            date_add(cast(o_orderdate AS date), cast(l_quantity * 10 AS int)), 'M/d/yyyy')
            END AS subscription_end_date""",
        """CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN l_linenumber = 7 THEN null
            WHEN l_linenumber = 6 THEN 'Cancelled' ELSE 'active' END AS status""",
        f"{_country('(c_nationkey + l_linenumber)')} AS billing_country",
        f"""CASE WHEN l_partkey % 19 = 0 THEN 'waived' WHEN l_partkey % 23 = 0 THEN ''
            WHEN l_discount <> 0 THEN {_amount('cast(round(l_extendedprice * 100) AS bigint)')} END AS monthly_charge""",
        """CASE WHEN l_partkey % 29 = 0 THEN 'n/a' ELSE concat((cast(l_quantity AS bigint) % 41 + 10) div 10, '.',
            (cast(l_quantity AS bigint) % 41 + 10) % 10) END AS satisfaction_rating""",
    )
