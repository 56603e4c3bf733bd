"""Top-k report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.operators import market as mk
from lotmarket.operators.stats import group_quantiles
from lotmarket.plans.binding import with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.plans.market_q import S_CTE, floored


@register("top_by_count", with_sales("""
SELECT address, borough_name, count(*) AS n FROM s GROUP BY 1, 2 ORDER BY n DESC, address, borough_name LIMIT 15""", S_CTE))
def top_by_count(spark, d):
    c = mk.count_by(floored(spark, d, part=True), ["address", "borough_name"])
    return finish(mk.top_k(c, [F.desc("n"), "address", "borough_name"], 15))


@register("top_by_unit_price", with_sales("""
SELECT neighborhood, borough_name, substring(neighborhood, 1, 25) AS label, count(*) AS n, round(median(unit_price), 4) AS median_unit_price
FROM s WHERE unit_price IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5 ORDER BY median_unit_price DESC, neighborhood LIMIT 15""", S_CTE))
def top_by_unit_price(spark, d):
    s = floored(spark, d, part=True).where(F.col("unit_price").isNotNull())
    keys = ["neighborhood", "borough_name"]
    c = mk.count_by(s, keys).where(F.col("n") >= 5)
    m = group_quantiles(s, keys, "unit_price", {"median_unit_price": 0.5})
    j = c.join(m, keys).withColumn("label", F.substring("neighborhood", 1, 25))  # only what is shown is cut
    return finish(mk.top_k(j, [F.desc("median_unit_price"), "neighborhood"], 15))
