"""Sorts, limits, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.operators import metrics
from wardstat.plans.registry import query
from wardstat.sources import sinks


@query("ordered_output", "SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def ordered_output(t):
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(200).select("o_orderkey", "o_custkey", "o_totalprice")
    ranked = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("k"), "o_orderkey", "o_custkey", "o_totalprice"))).alias("a"))   # 200 rows
    return ranked.select(F.posexplode("a")).select("col.o_orderkey", "col.o_custkey", "col.o_totalprice", (F.col("pos") + 1).cast("bigint").alias("place"))


@query("seeded_sample", "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS opened, '' AS found_in_source, '' AS auditor FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|20010716') LIMIT 100")
def seeded_sample(t):
    key = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("|20010716")).cast("binary"))
    s = sinks.seeded_sample(t.orders, key, 100)
    return s.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("opened"), F.lit("").alias("found_in_source"), F.lit("").alias("auditor"))


@query("disposition_groups", """WITH o AS (SELECT o_orderkey, coalesce(nullif(CASE WHEN o_totalprice < 50000 THEN '' ELSE o_orderstatus END, ''), '(blank)') AS resolution, CASE WHEN o_totalprice > 400000 THEN 'big' ELSE '(blank)' END AS sub, o_orderpriority AS ty FROM orders),
  k AS (SELECT resolution, sub, ty, count(*) AS n FROM o GROUP BY ALL)
  SELECT a.resolution, a.sub, a.n AS closed_requests, t.top AS top_types, s.ids AS samples FROM (SELECT resolution, sub, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1, 2) a
  JOIN (SELECT resolution, sub, string_agg(ty, '; ' ORDER BY n DESC, ty) AS top FROM (SELECT *, row_number() OVER (PARTITION BY resolution, sub ORDER BY n DESC, ty) AS r FROM k) WHERE r <= 3 GROUP BY 1, 2) t USING (resolution, sub)
  JOIN (SELECT resolution, sub, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY h) AS ids FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS h, row_number() OVER (PARTITION BY resolution, sub ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS r FROM o) WHERE r <= 5 GROUP BY 1, 2) s USING (resolution, sub)""")
def disposition_groups(t):
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_totalprice") < 50000, "").otherwise(F.col("o_orderstatus")).alias("resolution"),
                        F.when(F.col("o_totalprice") > 400000, "big").otherwise(" ").alias("sub"), F.col("o_orderpriority").alias("type"))
    return metrics.dispositions(o, "resolution", "sub", "type", F.col("id").cast("string"))


@query("union_by_name", "SELECT c_custkey AS id, 'customer' AS kind, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS size FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_acctbal, NULL, NULL FROM supplier UNION ALL SELECT p_partkey, 'part', NULL, NULL, p_size FROM part")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"))
    c = t.part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), F.col("p_size").alias("size"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query("except_values", "SELECT o_custkey AS value FROM orders WHERE o_totalprice > 300000 EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal >= 0")
def except_values(t):
    seen = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("value"))
    return seen.subtract(t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("value")))


@query("intersect_union_keys", """SELECT 'both' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
  UNION ALL SELECT 'either', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def intersect_union_keys(t):
    a, b = (t.orders.where(c).select("o_custkey") for c in ("o_orderstatus = 'O'", "o_totalprice > 400000"))
    n = lambda d, k: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
    return n(a.intersect(b), "both").unionByName(n(a.union(b).distinct(), "either"))


@query("dedupe_exact_rows", "SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_tax, count(*) AS copies FROM lineitem GROUP BY ALL")
def dedupe_exact_rows(t):
    d = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_tax")
    return d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias("copies"))
