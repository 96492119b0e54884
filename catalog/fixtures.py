"""A bronze table of any size, derived from an ``orders`` table.

The one SELECT below runs unchanged in Spark SQL and in other engines; it makes documents with
plain and sex-specific ranges, decimals, sentinels, blanks, duplicate names, mixed-case, repeated
and free-text tags, so that every rule of the silver layer has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FREE_TEXT_TAG = "differs from one individual to the next"

SCALED_DOCUMENTS = """
select k as entity_id,
 '{"id":"' || cast(k as string) || '","name":"' || nm || '","life_span":' || case when k%16=0 then 'null' else '"' || cast(8+k%6 as string) || '-' || cast(8+k%6+2+k%3 as string) || '"' end
 || ',"temperament":"' || case when k%701=0 then 'Differs from one individual to the next' else
      case when k%2=0 then 'Loyal' else 'loyal' end || ', ' || case when k%5=0 then 'Calm' when k%5=1 then 'playful' when k%5=2 then 'alert' else 'Quick to learn' end
      || case when k%7=0 then ', loyal' else '' end || case when k%11=0 then ', ' else '' end end
 || '","origin":"' || case when k%13=0 then '' else 'Region ' || cast(k%25 as string) end
 || '","weight":{"imperial":"' || case when k%313=0 then 'unknown' else cast(lo*2 as string) || '.' || cast((lo*2)%10 as string) end
 || '","metric":"' || case when k%313=0 then 'unknown' when k%3=0 then cast(lo as string) || '-' || cast(hi as string)
      else 'Male: ' || cast(lo+1 as string) || '-' || cast(hi+1 as string) || '.5; Female: ' || cast(lo as string) || '-' || cast(hi as string) end
 || '"},"height":{"imperial":"' || cast(lo as string) || '","metric":"' || cast(lo*2 as string) || '.5"}}' as payload
from (select o_orderkey as k, 1+(o_orderkey*7)%60 as lo, 1+(o_orderkey*7)%60+o_orderkey%9 as hi,
   'Entity ' || cast(o_orderkey - case when o_orderkey%97=0 and o_orderkey>0 then 1 else 0 end as string) as nm from orders) t
"""

# The same documents with every kind of defect the checks look for spread over them.
DEFECT_DOCUMENTS = """
select k as entity_id,
 '{"id":"' || cast(k as string) || '","name":"Entity ' || cast(k - case when k%89=0 and k>0 then 1 else 0 end as string) || case when k%83=0 then ' ' else '' end
 || '","life_span":"' || case when k%12=0 then '' when k%17=0 then 'n/a' when k%19=0 then '120-180' when k%23=0 then '12 years - 13 years' when k%29=0 then '10–12' else cast(8+k%6 as string) || '-' || cast(10+k%6 as string) || ' years' end
 || '","temperament":"' || case when k%37=0 then 'Quick to make new friends' else 'Loyal' end || ',' || case when k%41=0 then ' loyal' else ' Calm' end
 || '","origin":"Region ' || cast(k%25 as string)
 || '","weight":{"imperial":"' || cast(2*(1+k%60) as string)
 || '","metric":"' || case when k%43=0 then '' when k%47=0 then 'N/A' when k%31=0 then 'unknown' when k%67=0 then '5000-6000' when k%53=0 then '1,200-1,500' when k%59=0 then '3.5 kg (7.7 lb)' else cast(1+k%60 as string) || '-' || cast(3+k%60 as string) end
 || '"},"height":{"imperial":"' || cast(1+k%60 as string) || '","metric":"' || case when k%61=0 then 'tall' else cast(2*(1+k%60) as string) end || '"}}' as payload
from (select o_orderkey as k from orders) t
"""


# Documents whose units agree, so that a whole run passes its checks and is published.
SOUND_DOCUMENTS = """
select k as entity_id,
 '{"id":"' || cast(k as string) || '","name":"Entity ' || cast(k - case when k%97=0 and k>0 then 1 else 0 end as string)
 || '","life_span":' || case when k%16=0 then 'null' else '"' || cast(8+k%6 as string) || '-' || cast(10+k%6+k%3 as string) || '"' end
 || ',"temperament":"' || case when k%3=0 then 'Playful, alert' when k%3=1 then 'calm, protective, Energetic' else 'Loyal, calm' end
 || '","origin":"Region ' || cast(k%25 as string)
 || '","weight":{"imperial":"' || case when k%313=0 then 'unknown' when k%10=0 then '4.4-8.8' else cast(22*(1+k%9) as string) || '-' || cast(22*(1+k%9)+11 as string) end
 || '","metric":"' || case when k%313=0 then 'unknown' when k%10=0 then '2-4' else cast(10*(1+k%9) as string) || '-' || cast(10*(1+k%9)+5 as string) end
 || '"},"height":{"imperial":"' || cast(50*(1+k%2) as string) || '","metric":"' || cast(127*(1+k%2) as string) || '"}}' as payload
from (select o_orderkey as k from orders) t
"""

# The documents of the first run date: those of an earlier run.
EARLIER_DOCUMENTS = f"select * from ({SCALED_DOCUMENTS}) d where entity_id % 10 <> 0"

KINDS = {"earlier": EARLIER_DOCUMENTS, "scaled": SCALED_DOCUMENTS, "defects": DEFECT_DOCUMENTS, "sound": SOUND_DOCUMENTS}


# About as many documents as one task makes, some 100 MB of text.
DOCUMENTS_A_TASK = 1 << 18


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    # Keys are small and the documents made from them are not: dealt out, all cores make documents. The count
    # comes from the files' footers; no task makes more documents as the table grows.
    tasks = -(-keys.count() // DOCUMENTS_A_TASK)
    return keys.repartition(max(spark.sparkContext.defaultParallelism, tasks))


def documents(spark: SparkSession, sf_dir: str, kind: str = "scaled") -> DataFrame:
    """(entity_id, payload), one row per order."""
    escaped = KINDS[kind].replace("{", "{{").replace("}", "}}").replace("from orders", "from {orders}")
    return spark.sql(escaped, orders=_orders(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str, kind: str = "scaled") -> DataFrame:
    """Two run dates: all documents on the second, nine in ten on the first."""
    days = F.when(F.col("entity_id") % 10 == 0, F.array(F.lit("2024-01-02"))).otherwise(
        F.array(F.lit("2024-01-01"), F.lit("2024-01-02"))
    )
    dated = documents(spark, sf_dir, kind).withColumn("day", F.explode(days))
    return dated.select(
        F.col("entity_id").cast("long").alias("entity_id"),
        "payload",
        F.col("day").cast("date").alias("run_date"),
        (F.col("day").cast("timestamp") + F.expr("interval 2 hours")).alias("loaded_at"),
    )
