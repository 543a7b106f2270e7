"""Mix of kinds per area, in the DataFrame API and in SQL; both must give equal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import unmatched
from millrace.plans.registry import query
from millrace.sources.tables import Tables


def kind_mix(rows: DataFrame, area: str, kind: str, without: str, kinds: list[str]) -> DataFrame:
    """Rows per area and kind, for some kinds and all areas but one."""
    return (
        rows.filter(F.col(area) != without)
        .filter(F.col(kind).isin(*kinds))
        .groupBy(area, kind)
        .agg(F.count("*").alias("n"))
        .orderBy(F.asc(area), F.desc("n"), F.asc(kind))
    )


_MIX_SQL = """
    SELECT p_brand, p_type, COUNT(*) AS n FROM {part}
    WHERE p_brand <> 'Brand#1' AND p_type IN ('PROMO', 'ECONOMY')
    GROUP BY p_brand, p_type
    ORDER BY p_brand, n DESC, p_type
"""


@query(_MIX_SQL.format(part="part"))
def job_zone_mix_df(t: Tables) -> DataFrame:
    return kind_mix(t.part, "p_brand", "p_type", "Brand#1", ["PROMO", "ECONOMY"])


@query(_MIX_SQL.format(part="part"))
def job_zone_mix_sql(t: Tables) -> DataFrame:
    return t.spark.sql(_MIX_SQL, part=t.part)


@query("""
    SELECT c_custkey, c_name, c_mktsegment FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)
""")
def job_unreferenced(t: Tables) -> DataFrame:
    """Customers that no event refers to."""
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return unmatched(customers, t.events, "c_custkey", "user_id").distinct()
