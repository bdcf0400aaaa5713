"""Registered queries over captions, file names, labels and company names, with DuckDB twins written on their own.

The supplied tables have no such texts, so they are built from ids; both engines build the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions import labels, numbers, periods
from finloom.operators import entities

NUMBERS = "nums as (select event_id, case event_id % 14 when 0 then '(' || cast(event_id as varchar(20)) || '.50)' when 1 then 'RM ' || cast(event_id as varchar(20)) || ',000' when 2 then cast(event_id as varchar(20)) || '-' when 3 then 'n/a' when 4 then cast(event_id as varchar(20)) || '.5%' when 5 then 'Note ' || cast(event_id as varchar(20)) when 6 then '–' when 7 then 'Nil' when 8 then '+' || cast(event_id as varchar(20)) when 9 then cast(event_id as varchar(20)) || ')' when 10 then cast(event_id as varchar(20)) || ' sen' when 11 then cast(event_id as varchar(20)) || ' *' when 12 then '-' || cast(event_id as varchar(20)) else '' end as raw from events)"
CAPTIONS = "captions as (select event_id, case event_id % 12 when 0 then 'RM''000' when 1 then 'Amounts in RM million' when 2 then 'RM''000,000' when 3 then '(in billions of S$, SGD billion)' when 4 then 'in thousands' when 5 then 'sen per share' when 6 then 'US$ thousand' when 7 then 'presented in terms of plans' when 8 then 'Basic earnings per share (Sen)' when 9 then 'USD''000' when 10 then 'Ringgit Malaysia mil' else 'Note ' || cast(event_id as varchar(20)) end as caption from events)"
FILES = "files as (select event_id, cast(1000 + user_id as varchar(10)) || case event_id % 9 when 0 then '_Q3_2023.pdf' when 1 then '-annual-report-2022.pdf' when 2 then '_2023-11-28.pdf' when 3 then '_AR2021.pdf' when 4 then '_part_test2.pdf' when 5 then '_Investor-Briefing_Q1_2024.pdf' when 6 then '_Key-Statistics.pdf' when 7 then '-Sustainability_Statement.pdf' else '_Results-Review.pdf' end as name, cast(event_id % 40 as int) as pages from events where user_id is not null)"
COMPANIES = "named as (select s_suppkey as company_id, case s_suppkey % 6 when 0 then 'Alpha & Sons' when 1 then 'ALPHA and Sons Berhad' when 2 then 'O''Malley (M) Bhd.' when 3 then 'Omalley Sdn Bhd' when 4 then 'A.B.C. Corporation' else 'ABC Corp Berhad' end || ' ' || n_name as name from supplier join nation on s_nationkey = n_nationkey)"
LABELS = "labels as (select distinct p_type || case p_partkey % 4 when 0 then ' (Note 12)' when 1 then ' 24' when 2 then ' - attributable to owners' else '' end as label from part)"
HEADS = "heads as (select o_orderkey as id, case o_orderkey % 5 when 0 then 'for the financial year ended ' || cast(1 + o_orderkey % 31 as varchar(9)) || ' September 2024' when 1 then 'as at ' || cast(1 + o_orderkey % 30 as varchar(9)) || '/' || cast(1 + o_orderkey % 13 as varchar(9)) || '/2023' when 2 then 'Three months ended March ' || cast(1 + o_orderkey % 33 as varchar(9)) || ', 2022' when 3 then '3 months ended 9 months ended' else 'Revenue' end as head from orders)"


def _sql(spark: SparkSession, sf_dir: str, names: str, statement: str) -> DataFrame:
    for name in names.split():
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql("with " + statement)


def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "events", NUMBERS + " select * from nums")
    return rows.select("event_id", "raw", numbers.parse_number(F.col("raw")).cast("double").alias("number"), numbers.looks_numeric(F.col("raw")).alias("looks_numeric"))


def detect_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "events", CAPTIONS + " select * from captions").withColumn("s", numbers.detect_scale(F.col("caption")))
    return rows.select("event_id", "caption", "s.multiplier", "s.currency", numbers.mentions_per_share(F.col("caption")).alias("per_share"))


def filename_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "events", FILES + " select * from files")
    return rows.select("event_id", "name", labels.file_hints(F.col("name")).alias("h")).select("event_id", "name", "h.code", "h.doc_type", "h.fiscal_year", "h.quarter", "h.day")


def junk_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "events", FILES + " select event_id as document_id, name as file_name, pages, 'X Berhad' as company_name, '' as head from files")
    return entities.junk_documents(rows)


def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "part", LABELS + " select * from labels").select("label", labels.normalize_label(F.col("label")).alias("normalized"))


def company_dup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "supplier nation", COMPANIES + " select * from named").withColumn("name_key", labels.company_key(F.col("name")))
    groups = rows.groupBy("name_key").agg(F.count("*").alias("n"), F.min("company_id").alias("first_id")).where("n > 1")
    return rows.join(groups, "name_key").select("company_id", "name", "name_key", "n", "first_id")


def company_dup_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: the similarity is that of the standard library; a test holds it against all pairs."""
    return entities.duplicate_companies(_sql(spark, sf_dir, "supplier nation", COMPANIES + " select * from named"))


def stated_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "orders", HEADS + " select * from heads")
    head = F.col("head")
    return rows.select("id", "head", periods.stated_period_end(head, False).alias("stated_end"), periods.statement_months(head).alias("months"), periods.is_interim(head).alias("interim"), F.array_join(periods.stated_durations(head).cast("array<string>"), ",").alias("durations"))


FRAMES = {f.__name__: f for f in (parse_numbers, detect_scale, filename_hints, junk_classify, label_normalize, company_dup_exact, company_dup_fuzzy, stated_periods)}
SQL = {
    "parse_numbers": f"with {NUMBERS}, t as (select *, event_id % 14 as kind from nums) select event_id, raw, case when kind in (0, 9) then -(event_id + case when kind = 0 then 0.5 else 0 end)::double when kind in (2, 12) then -event_id::double when kind = 1 then (event_id::varchar || '000')::double when kind = 4 then event_id + 0.5::double when kind in (8, 10, 11) then event_id::double end as number, kind <> 5 as looks_numeric from t",
    "detect_scale": f"with {CAPTIONS}, t as (select *, event_id % 12 as kind from captions) select event_id, caption, case when kind in (1, 2, 10) then 1000000 when kind = 3 then 1000000000 when kind in (0, 4, 6, 9) then 1000 else 1 end::bigint as multiplier, case when kind in (6, 9) then 'USD' when kind = 3 then 'SGD' else 'MYR' end as currency, kind in (5, 8) as per_share from t",
    "filename_hints": f"with {FILES}, t as (select *, event_id % 9 as kind, split_part(replace(name, '-', '_'), '_', 1) as head from files) select event_id, name, case when length(head) between 4 and 5 and not (length(head) = 4 and head[1:2] in ('19', '20')) then head end as code, case when kind in (0, 5) then 'QUARTERLY' when kind in (1, 3) then 'ANNUAL' else 'OTHER' end as doc_type, case when length(head) = 4 and head[1:2] in ('19', '20') then head::int when kind in (0, 2) then 2023 when kind = 1 then 2022 when kind = 3 then 2021 when kind = 5 then 2024 end as fiscal_year, case kind when 0 then 3 when 5 then 1 end as quarter, case when kind = 2 then date '2023-11-28' end as day from t",
    "junk_classify": f"with {FILES}, t as (select *, event_id % 9 as kind from files), k as (select event_id, case kind when 4 then 'TEST_FILE' when 5 then 'PRESENTATION' when 7 then 'SUSTAINABILITY_ONLY' when 8 then case when pages <= 30 then 'BROKER_NOTE' end end as kind from t union all select event_id, 'KEY_STATISTICS' from t where kind = 6 or pages between 1 and 2) select event_id as document_id, kind, true as certain from k where kind is not null",
    "label_normalize": f"with {LABELS} select label, trim(regexp_replace(replace(regexp_replace(regexp_replace(lower(label), ' [(]note 12[)]$', ''), ' 24$', ''), ' - attributable to ', ' '), ' +', ' ', 'g')) as normalized from labels",
    "company_dup_exact": f"with {COMPANIES}, k as (select company_id, name, case when company_id % 6 < 2 then 'alpha and sons ' when company_id % 6 < 4 then 'omalley ' else 'abc corp ' end || replace(lower(n_name), '_', ' ') as name_key from named join supplier on s_suppkey = company_id join nation on n_nationkey = s_nationkey) select company_id, name, name_key, count(*) over w as n, min(company_id) over w as first_id from k window w as (partition by name_key) qualify n > 1",
    "stated_periods": f"with {HEADS}, t as (select *, id % 5 as kind from heads) select id, head, case kind when 0 then try_cast('2024-09-' || lpad((1 + id % 31)::varchar, 2, '0') as date) when 1 then try_cast('2023-' || lpad((1 + id % 13)::varchar, 2, '0') || '-' || lpad((1 + id % 30)::varchar, 2, '0') as date) when 2 then try_cast('2022-03-' || lpad((1 + id % 33)::varchar, 2, '0') as date) end as stated_end, case kind when 0 then 12 when 2 then 3 when 3 then 3 end as months, kind in (2, 3) as interim, case kind when 2 then '3' when 3 then '3,9' else '' end as durations from t",
}
