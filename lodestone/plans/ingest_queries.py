"""Stored paths, product lookups and grid rebuilding over the driver tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators.grids import grid_cells
from lodestone.plans.retrieval_queries import t
from lodestone.sources.registrations import registrations
from lodestone.sources.stores import outside, store_key

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'raw/' || page_id WHEN 1 THEN 'parsed/' || page_id || '/a' WHEN 2 THEN '/elsewhere/' || page_id ELSE 'raw/' || page_id END AS key, page_id % 4 = 2 AS outside FROM pages""")
def path_keys(spark, d):
    """Absolute paths to keys: inside the root, from another machine, outside, keys already."""
    n, p = F.col("page_id").cast("string"), F.col("page_id") % 4
    path = F.when(p == 0, F.concat(F.lit("/srv/a.b/raw/"), n)).when(p == 1, F.concat(F.lit("C:\\x\\data\\parsed\\"), n, F.lit("\\a"))).when(p == 2, F.concat(F.lit("/elsewhere/"), n)).otherwise(F.concat(F.lit("raw/"), n))
    pages = t(spark, d, "pages").select("page_id", path.alias("path"))
    return pages.select("page_id", store_key(F.col("path"), "/srv/a.b/").alias("key"), outside(F.col("path"), "/srv/a.b/").alias("outside"))


@query("""WITH i AS (SELECT l_partkey AS c, string_agg(DISTINCT 'S' || l_suppkey, ', ' ORDER BY 'S' || l_suppkey) AS ing, strftime(min(l_shipdate), '%Y-%m-%d') AS d, arg_min(l_linestatus, l_shipdate::VARCHAR || l_linestatus) AS st FROM lineitem GROUP BY 1),
p AS (SELECT p_partkey, p_name, p_brand, i.* FROM part LEFT JOIN i ON c = p_partkey)
SELECT 'DPD:' || replace(p_name, ' ', '') || ':' || lower(replace(p_brand, '#', '')) AS native_key, list_aggregate(list_transform(string_split(min(p_name), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS brand_name, arg_min(coalesce(ing, '-'), p_partkey) AS ingredient, min(p_brand) AS holder,
arg_max(st, p_partkey) FILTER (st IS NOT NULL) AS status, min(d) AS first_market_date, string_agg('D' || p_partkey, ',' ORDER BY p_partkey) AS din, string_agg(DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || ' SC' END, ',') AS other_names FROM p GROUP BY p_name, p_brand""")
def lookup_registrations(spark, d):
    part, line = t(spark, d, "part"), t(spark, d, "lineitem")
    brand = F.concat(F.upper("p_name"), F.when(F.col("p_partkey") % 3 == 0, " SC").otherwise(""))
    products = part.select(F.col("p_partkey").alias("drug_code"), brand.alias("brand_name"), F.col("p_brand").alias("company_name"), F.concat(F.lit("D"), "p_partkey").alias("din"))
    ingredients = line.select(F.col("l_partkey").alias("drug_code"), F.concat(F.lit("S"), "l_suppkey").alias("ingredient_name"))
    status = line.select(F.col("l_partkey").alias("drug_code"), F.struct("l_shipdate", "l_linestatus").alias("pos"), F.col("l_linestatus").alias("status"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("original_market_date"), F.lit("").alias("history_date"))
    found = registrations(products, ingredients, status)
    joined = {"ingredient": F.coalesce("ingredient", F.lit("-")), "din": F.array_join("din", ","), "other_names": F.when(F.size("other_names") > 0, F.array_join("other_names", ","))}
    return found.withColumns(joined).drop("drug_code")


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, max(l_quantity)::BIGINT AS q, max(l_partkey) AS p, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS row, count(*) OVER (PARTITION BY l_orderkey) AS k FROM n)
SELECT l_orderkey, row::INTEGER AS row, c AS col, CASE c WHEN 0 THEN f WHEN 1 THEN q::VARCHAR ELSE p || ' %' END AS text FROM r, (SELECT unnest([0, 1, 2]) AS c) WHERE k >= 3""")
def grid_rebuild(spark, d):
    """Cells from the line boxes of each order: a label, two numbers (one with its sign in a box of its own)."""
    rows = t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").cast("string").alias("q"), F.max("l_partkey").cast("string").alias("p"), F.min("l_returnflag").alias("f"))
    y, shift = -20.0 * F.col("l_linenumber"), F.col("l_linenumber") % 3
    box = lambda l, r, up, text: F.struct(l.alias("l"), (y + up).alias("b"), r.alias("r"), (y + up + 10).alias("t"), text.alias("text"))
    at = lambda x: (F.lit(float(x)) + shift).cast("double")
    boxes = F.array(box(at(0), at(15), F.lit(0.0), F.col("f")), box(at(50), at(60), shift * 1.0, F.col("q")), box(at(100), at(120), shift * -1.0, F.col("p")), box(at(121), at(125), F.lit(1.0), F.lit(" % ")))
    lines = rows.select("l_orderkey", F.explode(boxes).alias("e")).select("l_orderkey", "e.*")
    return grid_cells(lines, "l_orderkey").drop("structure")
