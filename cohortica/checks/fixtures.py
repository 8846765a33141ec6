"""Inputs in the shapes the operators expect, derived from the shared test tables.

Each statement runs unchanged in Spark SQL and in DuckDB, so a query and its oracle read the same
rows. Literals such as ``1e1`` keep both engines in double precision.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FIXTURES = {
    "fx_retail": """
select case when l_returnflag = 'R' then 'C' else '' end || cast(l_orderkey as string) as invoice,
       p_brand || '_' || p_type as stock_code, p_name as description, l_quantity as quantity,
       o_orderdate as invoice_date, l_extendedprice / l_quantity as price,
       case when o_custkey % 10 = 0 then null else o_custkey end as customer_id, n_name as country
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
     join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""",
    "fx_omnichannel": """
select o_custkey as master_id, case when o_custkey % 4 = 0 then 'Mobile' when o_custkey % 4 = 1 then 'Desktop' else 'Offline' end as order_channel,
       min(o_orderdate) as first_order_date, max(o_orderdate) as last_order_date,
       cast(sum(case when o_orderkey % 2 = 0 then 1 else 0 end) as double) as order_num_online,
       cast(sum(case when o_orderkey % 2 = 1 then 1 else 0 end) as double) as order_num_offline,
       sum(case when o_orderkey % 2 = 0 then o_totalprice else 0e0 end) as value_online,
       sum(case when o_orderkey % 2 = 1 then o_totalprice else 0e0 end) as value_offline,
       case when o_custkey % 3 = 0 then 'WOMEN,KIDS' when o_custkey % 3 = 1 then 'MEN' else null end as categories
from orders group by o_custkey
""",
    "fx_reviews": """
select o_orderkey as review_id, o_custkey as asin, cast(1 + (o_orderkey * 7 + o_custkey * 3) % 5 as double) as overall,
       (o_orderkey * 7919) % 1064 as day_diff, (o_orderkey * 5) % 11 as helpful_yes,
       (o_orderkey * 5) % 11 + (o_custkey + o_orderkey) % 7 as total_vote
from orders
""",
    "fx_ab": """
select event_id, case when user_id % 2 = 0 then 'control' else 'test' end as grp, value as purchase
from events where event_type = 'purchase'
""",
    "fx_ratings": """
select o_custkey as user_id, p_brand as movie_id, cast(1 + (l_orderkey * 7 + l_partkey * 3) % 5 as double) as rating, o_orderdate as ts
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
""",
    "fx_baskets": """
select distinct l_orderkey as basket, p_brand as item from lineitem join part on l_partkey = p_partkey
""",
    "fx_services": """
select o_custkey as user_id, p_size % 5 as service_id, p_partkey % 4 as category_id, o_orderdate as create_date
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
""",
    "fx_people": """
select c_custkey as id, case when c_custkey % 41 = 0 then 'Ng, Dr. ' when c_custkey % 2 = 0 then 'Doe, Mr. ' when c_custkey % 3 = 0 then 'Roe, Mrs. ' else 'NoTitle ' end || c_name as name,
       case when c_custkey % 5 = 0 then null else 18 + (c_custkey * 37) % 60 + 5e-1 * (c_custkey % 2) end as age,
       case when c_custkey % 2 = 0 then 'male' else 'female' end as sex, 1 + c_custkey % 3 as pclass,
       (c_custkey * 3) % 4 as sibsp, (c_custkey * 5) % 3 as parch,
       case when c_custkey % 13 = 0 then 900 + c_acctbal * 3e0 else abs(c_acctbal) / 1e2 end as fare,
       case when c_custkey % 4 <> 0 then null else 'C' || cast(c_custkey as string) end as cabin,
       case when c_custkey % 19 = 0 then null when c_custkey % 211 = 1 then 'RAREPORT' else c_mktsegment end as embarked,
       case when (c_custkey * 7919) % 10 < 4 then 1 else 0 end as survived
from customer
""",
    "fx_telco": """
select c_custkey as customer_id, c_custkey % 73 as tenure, 18e0 + (c_custkey * 31) % 1000 / 1e1 as monthly_charges,
       case when c_custkey % 73 = 0 then ' ' else cast((c_custkey * 17) % 8000 as string) end as total_charges,
       case when c_custkey % 6 = 0 then 1 else 0 end as senior,
       case c_custkey % 3 when 0 then 'Month-to-month' when 1 then 'One year' else 'Two year' end as contract,
       case c_custkey % 4 when 0 then 'Mailed check' when 1 then 'Bank transfer (automatic)' when 2 then 'Credit card (automatic)' else 'Electronic check' end as payment,
       case when c_custkey % 2 = 0 then 'Yes' else 'No' end as backup, case when c_custkey % 5 < 2 then 'Yes' else 'No' end as protection,
       case when c_custkey % 7 < 3 then 'Yes' else 'No' end as support, case when c_custkey % 11 < 5 then 'Yes' else 'No' end as tv,
       case when c_custkey % 13 < 4 then 'Yes' else 'No' end as movies,
       case when c_custkey % 10 < 9 then 'Yes' else 'No' end as phone, case when c_custkey % 9 < 4 then 'Yes' else 'No' end as lines,
       case when c_custkey % 8 < 3 then 'Yes' else 'No' end as security, case when (c_custkey * 7919) % 10 < 3 then ' Yes' else 'no' end as churn
from customer
""",
    "fx_health": """
select p_partkey as id, (p_partkey * 7) % 12 as pregnancies, 21 + (p_partkey * 13) % 60 as age,
       case when p_partkey % 23 = 0 then 0e0 else 60e0 + (p_partkey * 37) % 140 end as glucose,
       case when p_partkey % 3 = 0 then 0e0 else 10e0 + 5e-1 * ((p_partkey * 37) % 140) + (p_partkey * 53) % 90 end as insulin,
       case when p_partkey % 4 = 0 then 0e0 else 10e0 + (p_partkey * 29) % 40 end as skin,
       case when p_partkey % 19 = 0 then 0e0 else 50e0 + (p_partkey * 13) % 60 * 5e-1 + (p_partkey * 43) % 25 end as pressure,
       case when p_partkey % 17 = 0 then 0e0 else 15e0 + 5e-1 * ((p_partkey * 29) % 40) + (p_partkey * 11) % 50 / 1e1 end as bmi,
       case when (p_partkey * 37) % 140 + (p_partkey * 13) % 60 > 110 then 1 else 0 end as outcome
from part
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or one of the derived inputs."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    used: dict[str, DataFrame] = {}

    def bind(match: re.Match) -> str:
        used[match[2]] = table(spark, sf_dir, match[2])
        return f"{match[1]} {{{match[2]}}} as {match[2]}"

    text = re.sub(rf"\b(from|join)\s+({'|'.join(TABLES)})\b", bind, FIXTURES[name])
    return spark.sql(text, **used)


def with_fixture(*names: str) -> str:
    """The ``with`` clause that gives a SQL query the derived inputs."""
    return "with " + ", ".join(f"{n} as ({FIXTURES[n].strip()})" for n in names) + " "
