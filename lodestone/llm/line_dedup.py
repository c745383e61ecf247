"""Line dedup by deletion-neighbourhood join: a line goes if an earlier line is equal or one word edit away.

Native DataFrame expressions only. Lines are compared by their words (space runs are one space, ends trimmed). Equal lines meet by a
128-bit hash. Lines of every length also meet within the edit bound: one word, and no more than a `share`-th (a third) of the longer line's words,
so a line of one word has no other line within its bound and two words meet three:

1. Two lines one word edit apart share their first or their last half of words (the halves of the shorter). Only
   lines that share such a half with another distinct line go on; the others have no partner.
2. Each of these emits all its one-word deletions as hashed keys, from running xors over its words (word hashes
   with their place), so a line of n words costs n rows and no n x n work. Equal (variant, place) means one
   word replaced; a variant equal to a whole line means one word added.
3. Equal variants join by the earliest line of each key: within one (variant, place) all lines are one edit apart and of one length, so the
   earliest serves them all and no pairs are listed. Only variants of lines that are long enough for the bound take part, so no line outside it
   can stand in front of one within it. The edit distance to the earliest line is verified on the words.

A line is dropped on what stands in the input, not on what is left: the earliest (doc_id, then text hash, then line number) of equal or
linked lines stays. Texts keep the order and spelling of their kept lines. Tables between the steps are deleted once what reads them is written.

Defined cases: null and empty texts have no lines and stay; blank lines are never dropped; a null doc_id comes first; rows repeated in
full are one document, treated alike; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import NON_SPACE, cut, discard, sized_join, skew_join, table

SHARE = 3
HOT = 4096  # places of one line from which on its verdict is broadcast to them


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, pos, line): non-blank lines in one spacing. Texts without odd spaces skip the regular expression."""
    text = F.col("text").cast("string")
    odd = F.lit(False)
    for c in ("  ", "\t", "\r", "\x0b", "\f"):
        odd = odd | F.contains(text, F.lit(c))
    one = F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_h"), F.posexplode(F.split(one, "\n")).alias("pos", "raw"))
    return each.select("doc_id", "_h", "pos", F.trim("raw").alias("line")).filter("line != ''")


def rank() -> Column:
    """Order of lines: earliest first."""
    return F.struct("doc_id", "_h", "pos")


KEYS = {"k1": "xxhash64(line)", "k2": "xxhash64(29, line)"}


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, pos, k1, k2, halves): hashes of each line and, from two words on, of its halves at both lengths a partner may imply."""
    half = lambda h: [f"xxhash64(0, {h}, substring_index(line, ' ', {h}))", f"xxhash64(1, {h}, substring_index(line, ' ', -{h}))"]
    even, odd = half("CAST(n DIV 2 AS INT)"), half("CAST((n - 1) DIV 2 AS INT)")
    keys = F.expr(f"CASE WHEN n < 2 THEN NULL WHEN n % 2 = 0 THEN array({', '.join([*even, *odd])}) ELSE array({', '.join(even)}) END")
    lines = lines_of(docs).withColumn("n", F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    return lines.select("doc_id", "_h", "pos", *[F.expr(e).alias(k) for k, e in KEYS.items()], keys.alias("halves"))


def linked(docs: DataFrame, lines: DataFrame, share: int = SHARE, bound: int = 1_000_000) -> DataFrame:
    """(k1, k2, early): distinct lines with the earliest place of a verified line one word edit away that comes before them."""
    sides = lines.filter("halves IS NOT NULL").select("k1", F.explode("halves").alias("half"))
    shared = sides.groupBy("half").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo != hi").select("half")
    some = cut(sides.join(shared, "half").select("k1").distinct())
    texts = lines_of(docs).withColumns({k: F.expr(e) for k, e in KEYS.items()})
    lines2 = cut(sized_join(texts, some, ["k1"], "left_semi", bound).groupBy("k1", "k2").agg(F.min(rank()).alias("first"), F.min("line").alias("line")))
    # Running xors over the words of each line; the exchange comes before the explode.
    word = lines2.repartition("k1", "k2").select("k1", "k2", "first", F.posexplode(F.split("line", " ")).alias("i", "w"))
    every = W.partitionBy("k1", "k2").orderBy("i")
    upto = every.rowsBetween(W.unboundedPreceding, 0)
    whole = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    v = word.select("k1", "k2", "first", "i", F.xxhash64("w", "i").alias("a"), F.xxhash64("w", F.col("i") - 1).alias("b"))
    v = v.select("k1", "k2", "first", "i", F.bit_xor("a").over(upto).bitwiseXOR(F.col("a")).alias("before"), F.bit_xor("b").over(whole).bitwiseXOR(F.bit_xor("b").over(upto)).alias("after"), F.bit_xor("a").over(whole).alias("full"))
    # A deletion counts only if the line it comes from, the longer one or as long, has the words that the bound asks for.
    able = F.max("i").over(whole) + 1 >= share
    v = v.select("k1", "first", "i", F.when(able, F.col("before").bitwiseXOR(F.col("after"))).alias("v"), F.when(F.col("i") == 0, F.col("full")).alias("full"))
    variants = cut(v.filter("v IS NOT NULL OR full IS NOT NULL"))
    # One word replaced: the earliest line of the same variant and place.
    place = variants.filter("v IS NOT NULL").groupBy("v", "i").agg(F.min("first").alias("early"), F.max("first").alias("late")).filter("early < late").select("v", "i", "early")
    replaced = variants.select("v", "i", "first").join(place, ["v", "i"]).filter("early < first").select("first", "early")
    # One word added or left out: a variant that is a whole line. Both sides are summed per hash first.
    full = variants.filter("full IS NOT NULL").groupBy(F.col("full").alias("v")).agg(F.min("first").alias("f"))
    met = variants.select("v", "first").join(full, "v")
    by_whole = met.filter("f < first").select("first", F.col("f").alias("early"))
    by_variant = met.filter("first < f").select(F.col("f").alias("first"), F.col("first").alias("early"))
    found = replaced.union(by_whole).union(by_variant).groupBy("first").agg(F.min("early").alias("early"))
    one = found.join(lines2, "first").join(lines2.select(F.col("first").alias("early"), F.col("line").alias("other")), "early")
    words, others = F.split("line", " "), F.split("other", " ")
    out = cut(one.filter((F.greatest(F.size(words), F.size(others)) >= share) & one_word_apart(words, others)).select("k1", "k2", "early"))
    discard(some, lines2, variants)
    return out


def one_word_apart(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one word edit: what they share in front and behind leaves at most one word of the longer."""

    def same(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.lit(False))
        return F.when(at == 0, F.greatest(F.size(x), F.size(y))).otherwise(at - 1)

    return same(a, b) + same(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def dropped(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, _h, gone): the sorted places of the lines that each text loses, for texts that lose any."""
    lines = cut(keyed_lines(docs))
    near = linked(docs, lines, share)
    places = lines.select("doc_id", "_h", "pos", "k1", "k2")
    first = places.groupBy("k1", "k2").agg(F.min(rank()).alias("first"), F.max(rank()).alias("last"), F.count(F.lit(1)).alias("n"))
    judged = cut(first.join(near.select("k1", "k2", F.lit(True).alias("near")), ["k1", "k2"], "left").filter("near OR first < last").select("k1", "k2", "first", "n", F.coalesce("near", F.lit(False)).alias("near")))
    met = skew_join(places, judged.drop("n"), ["k1", "k2"], "inner", hot=judged.filter(F.col("n") > HOT))
    marks = cut(met.filter(F.col("near") | (F.col("first") < rank())).groupBy("doc_id", "_h").agg(F.array_sort(F.collect_set("pos")).alias("gone")))
    discard(lines, near, judged)
    return marks


def dedup_lines(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """All columns of docs with `text` stripped of dropped lines, and n_lines (not blank, before) and n_dropped."""
    marks = dropped(docs, share)
    of, gone, text = lambda c: F.col(f"d.`{c}`"), F.col("m.gone"), F.col("d.text").cast("string")
    joined = docs.alias("d").join(marks.alias("m"), of("doc_id").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64(of("text")) == F.col("m._h")), "left")

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    lines = F.split(text, "\n")
    stripped = F.when(gone.isNull(), text).otherwise(F.element_at(F.transform(F.array(lines), kept), 1))
    n = F.coalesce(F.size(F.filter(lines, lambda x: x.rlike(NON_SPACE))), F.lit(0)).cast("long")
    n_dropped = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    own = [stripped.alias("text") if c == "text" else of(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*own, n.alias("n_lines"), n_dropped.alias("n_dropped"))


def stripped_documents(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """The documents with their own columns only; n_chars, if any, follows the text."""
    kept = {c: F.col("d.text_left") if c == "text" else F.length("d.text_left").cast("long") if c == "n_chars" else F.col(f"d._doc.`{c}`") for c in docs.columns}
    whole = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc"))
    return dedup_lines(whole, share).withColumnRenamed("text", "text_left").alias("d").select(*[x.alias(c) for c, x in kept.items()])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))
