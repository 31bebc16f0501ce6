"""The driver's tables in the roles of listings, reviews and reference tables.

Each binding is one SELECT that both Spark and other SQL engines read alike; {table} marks the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import large

A = """select cast(c_nationkey % 5 as bigint) as list_id, cast(c_custkey as bigint) as idx,
 concat(p.p_name, case c_custkey % 5 when 0 then ' LLC' when 1 then ' & Sons, Inc.' when 2 then ' Auto Sales' when 3 then '''s Group' else '' end) as name,
 case when c_custkey % 11 = 0 then null when c_custkey % 2 = 0 then concat('(', cast(200 + c_custkey % 150 as string), ') 555-', lpad(cast(c_nationkey * 37 as string), 4, '0')) else concat('+1', cast(200 + c_custkey % 150 as string), '555', lpad(cast(c_nationkey * 37 as string), 4, '0')) end as phone,
 case when c_custkey % 7 = 0 then null else concat(lpad(cast(c_custkey % 300 as string), 5, '0'), '-1234') end as postal,
 concat('City-', cast(c_nationkey as string)) as city, concat('s', cast(c_nationkey % 5 as string), ' ') as state,
 case when c_custkey % 13 = 0 then null else 30 + cast(c_nationkey as double) / 2 + cast(c_custkey % 97 as double) / 1000 end as lat,
 case when c_custkey % 13 = 0 then null else -100 + cast(c_nationkey as double) / 2 + cast(c_custkey % 89 as double) / 1000 end as lon,
 case c_custkey % 14 when 0 then 'A+' when 1 then 'a' when 2 then ' A-' when 3 then 'B +' when 4 then 'B' when 5 then 'B-' when 6 then 'C+' when 7 then 'C' when 8 then 'C-' when 9 then 'D+' when 10 then 'D' when 11 then 'D-' when 12 then 'F' else 'NR' end as grade,
 c_acctbal as balance, c_mktsegment as industry, concat('Metro ', cast(c_nationkey % 5 as string)) as metro
 from {customer} join {part} p on p.p_partkey = c_custkey % 200"""
B = """select cast(s_nationkey % 5 as bigint) as list_id, cast(s_suppkey as bigint) as idx,
 concat(p.p_name, case s_suppkey % 3 when 0 then ' Co' when 1 then ' Sons' else ' Service' end) as name,
 case when s_suppkey % 9 = 0 then null else concat(cast(200 + s_suppkey % 150 as string), '-555-', lpad(cast(s_nationkey * 37 as string), 4, '0')) end as phone,
 case when s_suppkey % 5 = 0 then null else lpad(cast(s_suppkey % 300 as string), 5, '0') end as postal,
 concat('city-', cast(s_nationkey as string)) as city, concat('S', cast(s_nationkey % 5 as string)) as state,
 case when s_suppkey % 8 = 0 then null else 30 + cast(s_nationkey as double) / 2 + cast(s_suppkey % 97 as double) / 1000 end as lat,
 case when s_suppkey % 8 = 0 then null else -100 + cast(s_nationkey as double) / 2 + cast(s_suppkey % 89 as double) / 1000 end as lon,
 cast(s_suppkey % 9 as bigint) as review_count, cast(s_suppkey % 50 as double) / 10 as rating
 from {supplier} join {part} p on p.p_partkey = s_suppkey % 200"""
CITIES = """select n_name as name, concat('S', cast(n_nationkey % 5 as string)) as state, 30 + cast(n_nationkey as double) / 2 as lat, -100 + cast(n_nationkey as double) / 2 as lon,
 cast(10000 * (n_nationkey + 1) as bigint) as population, lpad(cast(n_nationkey as string), 7, '0') as geoid from {nation}"""
REVIEWS = """select cast(user_id as bigint) as business, cast(event_id as int) as pos, case event_id % 3 when 0 then 'registry' when 1 then 'angi' else 'mapquest' end as source,
 case when event_id % 17 = 0 then null else cast(ts as date) end as date, case event_type when 'error' then 'negative' when 'view' then 'neutral' when 'click' then 'mixed' else 'positive' end as sentiment,
 cast(event_id % 5 + 1 as int) as severity, concat('theme ', cast(event_id % 7 as string)) as theme, concat('summary ', cast(event_id as string)) as summary, event_id % 2 = 0 as actionable from {events}"""
# A master: every input of the scores, from listing keys alone.
MASTER = """select a.industry, a.metro, a.list_id, a.idx, case idx % 4 when 0 then 'matched' when 1 then 'a_only' when 2 then 'matched' else 'c_only' end as match_status,
 a.name as registry_name, case when idx % 6 = 0 then null else a.phone end as registry_phone, a.grade as registry_rating, case idx % 3 when 0 then 'true' when 1 then 'No' else null end as registry_accredited,
 case when idx % 10 = 0 then 'x@y.com' else '' end as registry_email, case when idx % 4 = 1 then 'Pat Q, owner' else null end as registry_principal_contact, cast(idx % 23 as double) as registry_years_in_business,
 case when idx % 19 = 0 then 'yes' else '' end as website_dead, case when idx % 5 = 0 then null else cast(idx % 51 as double) / 10 end as yelp_rating, case when idx % 7 = 0 then null else cast(idx % 201 as double) end as yelp_review_count,
 case when idx % 3 = 0 then a.name else null end as angi_name, case when idx % 12 = 0 then '2125551234' else null end as angi_phone, cast(idx % 47 as double) / 10 as angi_overall_rating, case when idx % 8 = 0 then null else cast(idx % 77 as double) end as angi_review_count,
 case when idx % 31 = 0 then 'Y' else '' end as angi_is_corporate_account, case idx % 5 when 1 then 'Yelp ' when 2 then 'other' else null end as mapquest_rating_provider, cast(idx % 41 as double) / 10 as mapquest_rating_value, cast(idx % 70 as double) as mapquest_review_count,
 case idx % 3 when 0 then 'ok' when 1 then 'unavailable' else null end as facebook_status, cast(idx % 101 as double) as facebook_recommend_percentage, case when idx % 9 = 0 then null else cast(idx % 300 as double) end as facebook_review_count,
 case when idx % 4 = 3 then null else cast(idx % 6 as double) end as review_sentiment_analyzed_count, cast(idx % 3 as double) as review_sentiment_negative_count,
 case when idx % 5 = 2 then null else cast('2024-01-01' as date) - cast(idx % 900 as int) end as most_recent_review_date, case when idx % 4 = 2 then null else cast(idx % 100 as double) end as avg_review_gap_days,
 case when idx % 6 = 1 then null else cast(idx % 12 as int) end as reviews_total, cast(idx % 50 as double) / 10 as review_average, case when idx % 9 = 4 then null else cast(idx % 40 as int) end as complaints_total from (""" + A + ") a"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")
_NAME = re.compile(r"\{(\w+)\}")


def bound(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SELECT over the tables under sf_dir.  Tables that it joins grow with the input."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(sql, **{t: large(read(t)) if " join " in sql else read(t) for t in sorted(set(_NAME.findall(sql)))})


def plain(sql: str) -> str:
    """The SELECT with plain table names."""
    return _NAME.sub(r"\1", sql)
