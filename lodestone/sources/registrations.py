"""Registrations from product, ingredient and status lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators.relational import latest


def registrations(products: DataFrame, ingredients: DataFrame, status: DataFrame) -> DataFrame:
    """One row per base brand and company.

    products: drug_code, brand_name, company_name, din; ingredients: drug_code, ingredient_name; status: drug_code, pos,
    status, original_market_date, history_date (its first row counts). A product without a code or brand goes; one
    without ingredients or status stays. Products count in the order of their codes: the first gives the shown brand and
    ingredients, the last that has a status gives the status; the first market date is the least.
    """
    told = X.pick(F.col("original_market_date"), F.col("history_date"))
    state = latest(status, ["drug_code"], F.col("pos")).select("drug_code", X.pick(F.col("status")).alias("status"), X.iso_date(told).alias("market_date"))
    made_of = ingredients.filter("ingredient_name != ''").groupBy("drug_code").agg(F.array_join(F.array_sort(F.collect_set("ingredient_name")), ", ").alias("ingredient"))
    known = latest(products.filter("drug_code IS NOT NULL AND trim(brand_name) != ''"), ["drug_code"], F.col("din"), F.col("brand_name"))
    p = known.join(made_of, "drug_code", "left").join(state, "drug_code", "left").withColumn("brand", F.trim("brand_name"))
    p = p.withColumn("base", X.base_brand(F.col("brand"))).withColumn("company", F.coalesce("company_name", F.lit("")))
    p = p.withColumn("native_key", F.concat(F.lit("DPD:"), X.norm_name(F.col("base")), F.lit(":"), X.norm_name(F.col("company"))))
    runs = F.regexp_extract_all(F.lower("base"), F.lit(r"(\p{L}+|\P{L}+)"))
    titled = F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")
    shouted = (F.upper("base") == F.col("base")) & (F.lower("base") != F.col("base"))
    code = F.col("drug_code")
    row = F.struct(code, "din", F.when(F.col("brand") != F.col("base"), F.col("brand")).alias("other"))
    groups = p.groupBy("native_key").agg(
        F.min_by(F.when(shouted, titled).otherwise(F.col("base")), code).alias("brand_name"),
        F.min_by("ingredient", code).alias("ingredient"),
        F.min_by(F.when(F.col("company") != "", F.col("company")), code).alias("holder"),
        F.max_by("status", F.when(F.col("status").isNotNull(), code)).alias("status"),
        F.min("market_date").alias("first_market_date"),
        F.sort_array(F.collect_list(row)).alias("rows"),
    )
    others = F.array_distinct(F.array_compact(F.col("rows.other")))
    return groups.select("native_key", "brand_name", "ingredient", "holder", "status", "first_market_date", F.col("rows.din").alias("din"), F.col("rows.drug_code").alias("drug_code"), others.alias("other_names"))
