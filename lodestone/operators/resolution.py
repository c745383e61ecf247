"""Names to programs, and registrations to clusters.

Names are compared in normal form (letters and digits). A name matches an alias if both are equal, or if it begins with an alias of five
letters and more. Both tests are equi-joins: a name offers itself and its beginnings, so nothing is compared pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators.relational import components, latest

LEAST_PREFIX, LEAST_SIMILAR = 5, 7  # fixed values
MOST_ALIASES = 100_000  # aliases that are broadcast
BLOCK, TASK_PAIRS = 1024, 4_000_000  # ids of one name that meet others together; pairs of a task


def name_matches(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows of names (key columns and `name`) joined to the aliases (`alias` and more columns) they match; both raw.

    A name's beginnings are many times the table it comes from, which a plan's estimate does not see: they are never the side that is broadcast."""
    offered = names.withColumn("_n", X.norm_name(F.col("name"))).filter("_n != ''")
    beginnings = F.transform(F.sequence(F.lit(LEAST_PREFIX), F.length("_n")), lambda k: F.substring(F.col("_n"), F.lit(1), k))
    probes = F.when(F.length("_n") >= LEAST_PREFIX, beginnings).otherwise(F.array("_n"))
    known = aliases.withColumn("_a", X.norm_name(F.col("alias"))).filter("_a != ''")
    few = F.broadcast(known) if known.limit(MOST_ALIASES + 1).count() <= MOST_ALIASES else known
    return offered.withColumn("_a", F.explode(probes)).hint("merge").join(few, "_a").drop("_a", "_n").distinct()


def match_programs(registrations: DataFrame, aliases: DataFrame) -> DataFrame:
    """(reg_id, program_id): the first program in order with an alias of the registration's agency, else with any name.

    registrations: reg_id, agency, names (array); aliases: program_id, ord, agency (null: a name of no agency), alias."""
    names = registrations.select("reg_id", F.col("agency").alias("_of"), F.explode("names").alias("name"))
    met = name_matches(names, aliases)
    by_agency = F.when(F.col("agency") == F.col("_of"), 0).otherwise(1)
    return met.groupBy("reg_id").agg(F.min_by("program_id", F.struct(by_agency.alias("pass"), F.col("ord"))).alias("program_id"))


def excluded(registrations: DataFrame, held_out: DataFrame) -> DataFrame:
    """The registrations that match a held-out program under any of its names."""
    names = registrations.select("reg_id", F.explode("names").alias("name"))
    return registrations.join(name_matches(names, held_out.select("alias")).select("reg_id").distinct(), "reg_id", "left_semi")


def kept_rows(rows: DataFrame, aliases: DataFrame, synonyms: list[str], product_scoped: bool) -> DataFrame:
    """Catalog rows (row_id, name, ingredient) of a target: by alias alone if it names products, else by alias or ingredient."""
    by_name = name_matches(rows.select("row_id", "name"), aliases.select("alias")).select("row_id").distinct().withColumn("_hit", F.lit(True))
    marked = rows.join(by_name, "row_id", "left")
    wanted = F.coalesce("_hit", F.lit(False))
    return marked.filter(wanted if product_scoped else wanted | X.contains_any(F.col("ingredient"), synonyms)).drop("_hit")


def similar_names(names: DataFrame) -> DataFrame:
    """(a, b) of different names (id, name): equal length of seven and more, one letter apart, or up to three with the same first three letters.

    Distinct names are compared (`name_links`); the ids of a name, dealt into blocks, meet those of the names linked with it block by block, so neither a task nor a key
    holds all pairs of a common name."""
    ids = names.filter(F.length("name") >= LEAST_SIMILAR).select("name", "id").distinct()
    held = ids.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    spread = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / BLOCK).cast("long"))
    blocks = ids.join(held, "name").groupBy("name", spread.alias("_b")).agg(F.collect_list("id").alias("_ids"))
    links = name_links(ids.select("name"))
    pairs = links.join(held.select(F.col("name").alias("x"), F.col("_n").cast("double").alias("_nx")), "x").join(held.select(F.col("name").alias("y"), F.col("_n").alias("_ny")), "y").agg(F.sum(F.col("_nx") * F.col("_ny"))).head()[0]
    x, y = blocks.select(F.col("name").alias("x"), F.col("_b").alias("_bx"), F.col("_ids").alias("_ix")), blocks.select(F.col("name").alias("y"), F.col("_b").alias("_by"), F.col("_ids").alias("_iy"))
    met = links.join(x, "x").join(y, "y").repartition(int((pairs or 0) // TASK_PAIRS) + 1, "x", "y", "_bx", "_by")
    each = met.withColumn("_i", F.explode("_ix")).select("_iy", "_i").withColumn("_j", F.explode("_iy")).filter("_i != _j")
    return each.select(F.least("_i", "_j").alias("a"), F.greatest("_i", "_j").alias("b"))


def name_links(names: DataFrame) -> DataFrame:
    """(x, y), x before y: the similar ones of distinct names (column `name`).

    One letter apart: both share a variant with the letter at one place left out, so variants join by equality. Same beginning: length and
    first three letters are the key."""
    long = names.filter(F.length("name") >= LEAST_SIMILAR).select("name").distinct()
    places = F.sequence(F.lit(1), F.length("name"))
    variants = F.transform(places, lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring("name", F.lit(1), i - 1), F.lit("_"), F.substring("name", i + 1, F.length("name"))))
    begins = F.concat(F.lit("p:"), F.length("name").cast("string"), F.lit(":"), F.substring("name", 1, 3))
    keyed = long.withColumn("_k", F.explode(F.array_append(variants, begins)))
    met = keyed.select(F.col("name").alias("x"), "_k").join(keyed.select(F.col("name").alias("y"), "_k"), "_k").filter((F.col("x") < F.col("y")) & (F.length("x") == F.length("y"))).select("x", "y").distinct()
    d = F.levenshtein("x", "y")
    return met.filter((d <= 1) | ((d <= 3) & (F.substring("x", 1, 3) == F.substring("y", 1, 3))))


def chains(rows: DataFrame, key: list[str], rule: str) -> DataFrame:
    """Links (a, b, rule) that connect all ids of a key: each to the smallest, so a group of n gives n - 1 links."""
    least = rows.groupBy(*key).agg(F.min("id").alias("a"))
    return rows.join(least, key).filter("a != id").select("a", F.col("id").alias("b"), F.lit(rule).alias("rule"))


def first_links(registrations: DataFrame) -> DataFrame:
    """Links of the first phase: same brand; one holder at EMA; similar names across agencies. registrations: id, agency, brand, holder, reference (null: not said)."""
    r = registrations.withColumn("name", X.norm_name(X.base_brand(F.col("brand")))).withColumn("who", X.holder_key(F.col("holder")))
    free = r.filter(~F.coalesce("reference", F.lit(False)))
    same = chains(r.filter("name != ''"), ["name"], "same_brand")
    one_each = free.filter("agency = 'ema' AND who != ''").groupBy("who", F.when(F.col("name") == "", F.col("id").cast("string")).otherwise(F.col("name")).alias("_as")).agg(F.min("id").alias("id"))
    holder = chains(one_each, ["who"], "same_holder")  # equal names have met already
    # Equal names have met: one registration of each name and agency stands for all of them.
    some = free.filter(F.length("name") >= LEAST_SIMILAR).groupBy("name", "agency").agg(F.min("id").alias("id"))
    close = name_links(some.select("name")).join(some.select(F.col("name").alias("x"), F.col("agency").alias("_x"), F.col("id").alias("_i")), "x").join(some.select(F.col("name").alias("y"), F.col("agency").alias("_y"), F.col("id").alias("_j")), "y")
    return same.unionByName(holder).unionByName(close.filter("_x != _y").select(F.least("_i", "_j").alias("a"), F.greatest("_i", "_j").alias("b"), F.lit("similar_name").alias("rule")))


def labelled(registrations: DataFrame, links: DataFrame) -> DataFrame:
    """registrations with `cluster`, the smallest id reachable."""
    found = components(links.select("a", "b"))
    return registrations.join(found, "id", "left").withColumn("cluster", F.coalesce("component", "id")).drop("component")


def cross_links(marked: DataFrame) -> DataFrame:
    """Second phase: a holder that spans several clusters, but one per agency, joins them. marked: registrations with cluster."""
    r = marked.withColumn("who", X.holder_key(F.col("holder"))).filter((F.col("who") != "") & ~F.coalesce("reference", F.lit(False)))
    per = r.groupBy("who", "agency").agg(F.count_distinct("cluster").alias("n"))
    spans = r.groupBy("who").agg(F.count_distinct("cluster").alias("all"))
    good = per.groupBy("who").agg(F.max("n").alias("most")).join(spans, "who").filter("most = 1 AND all > 1").select("who")
    return chains(r.join(good, "who", "left_semi"), ["who"], "same_holder_cross")


def clusters(registrations: DataFrame) -> DataFrame:
    """registrations with `cluster` and `basis`, the sorted rules that joined it (`single_registration` if none)."""
    links = first_links(registrations)
    marked = labelled(registrations, links)
    links = links.unionByName(cross_links(marked))
    whole = labelled(registrations, links)
    rules = links.join(whole.select(F.col("id").alias("a"), "cluster"), "a").groupBy("cluster").agg(F.array_sort(F.collect_set("rule")).alias("basis"))
    return whole.join(rules, "cluster", "left").withColumn("basis", F.coalesce("basis", F.array(F.lit("single_registration"))))


def titled(brand: Column) -> Column:
    return F.when((F.upper(brand) == brand) & (F.lower(brand) != brand), F.initcap(brand)).otherwise(brand)


def programs(marked: DataFrame, taken: DataFrame, has_reference: bool = False) -> DataFrame:
    """One program per cluster: program_id, role, lead, holder, n.

    A cluster is a reference if FDA says so, or EMA alone says so while no FDA or curated reference exists. Its lead is FDA's, then EMA's, then the
    earliest registration. In the order of first approval each takes its lead's brand, or the first of brand-2, brand-3 ... that neither `taken` (name) nor an earlier
    cluster holds."""
    no_date = F.lit("9999")
    r = marked.withColumn("date", F.coalesce("approved", no_date)).withColumn("place", F.when(F.col("agency") == "fda", 0).when(F.col("agency") == "ema", 1).otherwise(2))
    says = F.coalesce("reference", F.lit(False))
    order = F.struct("place", "date", "id")
    c = r.groupBy("cluster").agg(F.bool_or(says & (F.col("agency") == "fda")).alias("_fda"), F.bool_or(says).alias("_any"), F.min("date").alias("_first"), F.min_by("id", order).alias("lead"), F.min_by(X.base_brand(F.col("brand")), order).alias("_brand"), F.min_by("holder", F.when(F.col("holder") != "", order)).alias("holder"), F.count(F.lit(1)).alias("n"))
    some = F.max("_fda").over(W.partitionBy()) | F.lit(has_reference)  # one row per cluster
    role = F.when(F.col("_fda") | (F.col("_any") & ~some), "reference").otherwise("biosimilar")
    named = unique_names(c.select("cluster", titled(F.col("_brand")).alias("base"), F.struct("_first", "lead").alias("order")), taken)
    return c.withColumn("role", role).join(named, "cluster").select("cluster", "program_id", "role", "lead", "holder", F.col("n").cast("long").alias("n"))


def unique_names(wanted: DataFrame, taken: DataFrame) -> DataFrame:
    """(cluster, program_id): in `order` each cluster takes its base, or the first base-2, base-3 ... that is free. wanted: cluster, base, order (a struct); taken: name.

    Names can only collide if they are equal without their ending numbers, so roots are independent. A root's clusters stream by in order; what is kept of a root is its taken names and one number
    per distinct base: the numbers of a base only grow, so all below its next one are held."""
    root = lambda c: F.regexp_replace(c, r"(-[0-9]+)+$", "")
    kinds = dict(wanted.dtypes)
    held = taken.filter("name IS NOT NULL").select(root(F.lower("name")).alias("_root"), F.lit(0).alias("_late"), F.lit(None).cast(kinds["order"]).alias("order"), F.lit(None).cast(kinds["cluster"]).alias("cluster"), F.lit(None).cast("string").alias("base"), F.lower("name").alias("_low"))
    turns = wanted.select(root(F.lower("base")).alias("_root"), F.lit(1).alias("_late"), "order", "cluster", "base", F.lower("base").alias("_low"))
    rows = turns.unionByName(held.join(turns.select("_root").distinct(), "_root", "left_semi")).repartition("_root").sortWithinPartitions("_root", "_late", "order", "cluster", "base")

    def run(batches):
        import pyarrow as pa

        now, names, following = None, set(), {}
        for b in batches:
            at, out = [], []
            for i, (r, late, base, low) in enumerate(zip(*(b.column(k).to_pylist() for k in range(4)))):
                if r != now:
                    now, names, following = r, set(), {}
                if not late:
                    names.add(low)
                    continue
                at.append(i)
                if base is None:
                    out.append(None)
                    continue
                n = following.get(low)
                if n is None:
                    over, _, last = low.rpartition("-")
                    own = over and len(last) < 16 and last.isascii() and last.isdigit() and last[0] != "0" and 2 <= int(last) < following.get(over, 0)  # the shorter base came by here
                    n = 2 if own or low in names else 1
                    names.add(low)
                while n > 1 and f"{low}-{n}" in names:
                    n += 1
                out.append(base if n == 1 else f"{base}-{n}")
                following[low] = n + 1
            yield pa.RecordBatch.from_arrays([b.column(4).take(pa.array(at, pa.int64())), pa.array(out, pa.string())], ["cluster", "program_id"])

    return rows.select("_root", "_late", "base", "_low", "cluster").mapInArrow(run, f"cluster {kinds['cluster']}, program_id string")


def agency_names(marked: DataFrame) -> DataFrame:
    """(cluster, agency, names): what each agency calls a cluster's product, each name once, in the order of its registrations: the brand, FDA's proper name, other names.

    marked: cluster, id, agency, brand, proper_name, other_names (array)."""
    own = F.array_compact(F.concat(F.array(titled(X.base_brand(F.col("brand"))), F.when(F.col("agency") == "fda", F.col("proper_name"))), F.coalesce("other_names", F.array().cast("array<string>"))))
    each = marked.select("cluster", "agency", "id", F.filter(own, lambda n: n != "").alias("_n"))
    lists = F.transform(F.array_sort(F.collect_list(F.struct("id", "_n"))), lambda x: x["_n"])
    return each.groupBy("cluster", "agency").agg(F.array_distinct(F.flatten(lists)).alias("names"))


def auto_actions(clusters_: DataFrame, wanted: DataFrame, held_out: DataFrame) -> DataFrame:
    """Set differences of auto-mapping: a cluster with a held-out registration goes, one with a wanted one stays, others are skipped."""
    out = held_out.select("id", F.lit(True).alias("_out"))
    want = wanted.select("id", F.lit(True).alias("_want"))
    marks = clusters_.join(out, "id", "left").join(want, "id", "left").groupBy("cluster").agg(F.max(F.coalesce("_out", F.lit(False))).alias("_o"), F.max(F.coalesce("_want", F.lit(False))).alias("_w"))
    return marks.select("cluster", F.when(F.col("_o"), "held_out").when(F.col("_w"), "keep").otherwise("skip").alias("action"))


def resolve_target(programs_: DataFrame, names: DataFrame, requested: list[str] | None, ingredient: str | None, include_holdout: bool = False) -> DataFrame:
    """The programs of a target and how each is held: selected, excluded (held out), or unknown (a requested name without a program).

    programs_: program_id, ingredient, holdout; names: program_id, name."""
    spark = programs_.sparkSession
    if requested:
        asked = spark.createDataFrame([(x,) for x in requested], "name string").withColumn("_n", X.norm_name(F.col("name")))
        met = asked.join(names.select("program_id", X.norm_name(F.col("name")).alias("_n")).distinct(), "_n", "left").groupBy("name").agg(F.min("program_id").alias("program_id"))
        return met.select(F.coalesce("program_id", "name").alias("program_id"), F.when(F.col("program_id").isNull(), "unknown").otherwise("selected").alias("state")).distinct()
    own = programs_.filter(F.col("ingredient") == ingredient)
    return own.select("program_id", F.when(F.col("holdout") & ~F.lit(include_holdout), "excluded").otherwise("selected").alias("state"))


def majority(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of a key; ties go to the value seen first."""
    each = rows.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    return latest(each, key, F.desc("_n"), F.col("_first"), F.col(value)).drop("_n", "_first")
