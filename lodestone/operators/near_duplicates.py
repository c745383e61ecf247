"""Near-duplicates by shingle sets: classes of equal sets, links between their representatives, membership.

Documents whose sets are equal form a class, found by order-free fingerprints; only a class's representative (its first document in the given order)
goes on, so a family of copies costs one set however large it is. Sets travel as byte strings of numbers, not as rows: the representatives' shingles are
dealt by hash into buckets, where those that a second one has are found; these go back to their documents. A set of which less than
threshold is shared with anyone meets nothing and ends there. The others meet by a prefix filter: with a set's shingles from the rarest up, two sets that are
similar enough share one of the first n - ceil(t n) + 1 of both. Where two beginnings meet bounds what the sets can share, and pairs within the bound are confirmed on
all shared shingles, in squares of two blocks of documents.

A bucket or a group of documents holds about TASK_SHINGLES numbers, whatever the input; a shingle's documents are in one bucket.

Defined cases: documents without a shingle are classes of their own with no links; repeated doc_ids count once per distinct set; ties in order go to the smaller
doc_id; documents without a language are classes by their sets but are linked with nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.shared import removed, written

PIECE = 1 << 19  # bytes of text that are hashed at once, unless one text has more
HELD = 1 << 20  # shingles that a task deals at once
TASK_SHINGLES = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(raw: np.ndarray, ends: np.ndarray, salt: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text its distinct hashes, sorted, of the k-word runs; words are runs of three and more of a to z. raw: lower-case texts end to end; salt: a number that tells languages apart."""
    letter = (raw >= 97) & (raw <= 122)
    cut = np.zeros(len(raw) + 1, bool)
    cut[ends] = cut[0] = True
    start = np.flatnonzero(letter & (cut[:-1] | ~np.concatenate([[False], letter[:-1]])))
    end = np.flatnonzero(letter & (cut[1:] | ~np.concatenate([letter[1:], [False]]))) + 1
    long = end - start >= 3
    start, end = start[long], end[long]
    size, of = end - start, np.searchsorted(ends, start, "right")
    if len(start) < k:
        return [np.zeros(0, np.uint64)] * len(ends)
    h, some = np.zeros(len(start), np.uint64), np.arange(len(start))
    for j in range(size.max()):  # a letter of every word that has one there
        some = some[size[some] > j]
        h[some] = mixed(h[some] * np.uint64(31) + raw[start[some] + j])
    run = h[: len(h) - k + 1]
    for j in range(1, k):
        run = mixed(run + np.uint64(0x9E3779B97F4A7C15)) + h[j : len(h) - k + 1 + j]
    whole = of[: len(run)] == of[k - 1 :]  # within one text
    run, of = run[whole], of[: len(run)][whole]
    run = mixed(run + salt[of])
    at = np.searchsorted(of, np.arange(len(ends) + 1))
    return [distinct(run[i:j]) for i, j in zip(at[:-1], at[1:])]


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]]


def pieces(size: np.ndarray, most: int):
    """(from, to) of neighbouring rows that together have about `most`."""
    at = 0
    while at < len(size):
        to = at + max(1, int(np.searchsorted(np.cumsum(size[at : at + most]), most, "right")))
        yield at, to
        at = to


def sizes_of(column) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def numbers(column) -> np.ndarray:
    """The numbers of all byte strings of a column, end to end."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64)


def text_sets(batches, k: int = 5):
    """Batches lang, doc_id, set of each text with a k-word run: sorted hashes as bytes. batches: lang, doc_id, text, salt."""
    import pyarrow as pa

    for b in batches:
        for i, j in pieces(sizes_of(b.column(2)), PIECE):
            part = b.slice(i, j - i)
            texts = part.column(2).to_pylist()
            found = run_hashes(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(x) for x in texts]), part.column(3).to_numpy().view(np.uint64), k)
            has = [x for x, f in enumerate(found) if len(f)]
            at = pa.array(has, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array([found[x].tobytes() for x in has], pa.binary())], ["lang", "doc_id", "set"])


def united(batches):
    """Batches lang, doc_id, set of batches with a list of sets: the texts of a repeated doc_id give one."""
    import pyarrow as pa

    for b in batches:
        found = [distinct(np.frombuffer(b"".join(x), np.uint64)).tobytes() for x in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["lang", "doc_id", "set"])


def marked(batches):
    """Batches lang, doc_id, set with a number of their own (u), their size (n) and two fingerprints that no order matters to."""
    import pyarrow as pa
    from pyspark import TaskContext

    u = TaskContext.get().partitionId() << 40
    for b in batches:
        n = sizes_of(b.column(2)) // 8
        for i, j in pieces(n, HELD):
            part, h = b.slice(i, j - i), numbers(b.column(2).slice(i, j - i))
            at = np.cumsum(n[i:j]) - n[i:j]
            f1, f2 = np.bitwise_xor.reduceat(mixed(h), at), np.add.reduceat(mixed(h + np.uint64(0xD1B54A32D192ED03)), at)
            own = [np.arange(u, u + j - i), n[i:j], f1.view(np.int64), f2.view(np.int64)]
            u += j - i
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, own)], ["lang", "doc_id", "set", "u", "n", "f1", "f2"])


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, set, u, n, f1, f2): documents with a shingle, to be written before it is read twice (u numbers the rows of tasks); only repeated doc_ids are brought together."""
    kinds = dict(docs.dtypes)
    plain = f"lang {kinds['lang']}, doc_id {kinds['doc_id']}, set binary"
    whole = f"{plain}, u long, n long, f1 long, f2 long"
    texts = docs.filter("text IS NOT NULL").select("lang", "doc_id", F.lower("text").cast("binary").alias("t"), F.xxhash64("lang"))
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return texts.mapInArrow(lambda b: marked(text_sets(b)), whole)
    each = texts.mapInArrow(lambda b: text_sets(b), plain).groupBy("lang", "doc_id").agg(F.collect_list("set").alias("_s"))
    return each.mapInArrow(lambda b: marked(united(b)), whole)


def classes(sets: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """(lang, doc_id, rep, n, u): each document with the first document of equal set in its language. order: doc_id, rank."""
    mark = sets.drop("set")
    ranked = mark.withColumn("rank", F.lit(0)) if order is None else mark.join(order.select("doc_id", "rank"), "doc_id")
    first = ranked.groupBy(F.col("lang").alias("_l"), F.col("n").alias("_n"), F.col("f1").alias("_f1"), F.col("f2").alias("_f2")).agg(F.min_by("doc_id", F.struct("rank", "doc_id")).alias("rep"))
    same = F.col("lang").eqNullSafe(F.col("_l")) & (F.col("n") == F.col("_n")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2"))
    return mark.join(first, same).select("lang", "doc_id", "rep", "n", "u")


def dealt(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of numbers by the bucket they belong to, and where each bucket begins in it."""
    bucket = ((mixed(h) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16)
    return np.argsort(bucket, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=parts))])


def blobs(parts: int, by: np.ndarray, *columns: np.ndarray):
    """One row (bucket, bytes of each column) for each bucket that has numbers of `by`."""
    import pyarrow as pa

    order, at = dealt(by, parts)
    has = np.flatnonzero(np.diff(at))
    rows = [[c[at[i] : at[i + 1]].tobytes() for i in has] for c in (c[order] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], ["bucket", *"abc"[: len(columns)]])


def shared(sets: DataFrame, threshold: float, shingles: int) -> DataFrame:
    """(u, n, set, first): of each set of which at least threshold is in another one, the shingles in others, sorted, and those of its beginning, from the rarest up. sets: u, n, set."""
    parts = min(1 << 16, shingles // TASK_SHINGLES + 1)

    def deal(batches):
        for b in batches:
            n = b.column(1).to_numpy().astype(np.int64)
            for i, j in pieces(n, HELD):
                yield blobs(parts, h := numbers(b.column(2).slice(i, j - i)), h, np.repeat(b.column(0).to_numpy()[i:j].astype(np.uint64), n[i:j]))

    def meet(bucket):
        h, u = numbers(bucket["a"]), numbers(bucket["b"])
        order = np.argsort(h)
        h, u = h[order], u[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        c = np.repeat(size := np.diff(np.append(at, len(h))), size).astype(np.uint64)
        found = c > 1
        import pyarrow as pa

        return pa.Table.from_batches([blobs(parts, u[found], u[found], h[found], c[found])])

    def begin(bucket):
        import pyarrow as pa
        import pyarrow.compute as pc

        sized, rows = bucket.filter(pc.is_null(bucket["c"])), bucket.filter(pc.is_valid(bucket["c"]))
        own, n = numbers(sized["a"]), numbers(sized["b"]).astype(np.int64)
        order = np.argsort(own)
        own, n = own[order], n[order]
        u, h, c = (numbers(rows[x]) for x in "abc")
        i = np.searchsorted(own, u)
        have = np.bincount(i, minlength=len(own))
        need = np.ceil(threshold * n - 1e-9).astype(np.int64)
        go = have >= need
        i, h, c = (x[go[i]] for x in (i, h, c))
        order = np.lexsort((h, c, i))
        i, h = i[order], h[order]
        docs = np.flatnonzero(go)
        at = np.searchsorted(i, docs)
        some = [h[a : a + have[d]] for a, d in zip(at, docs)]
        first = [s[: have[d] - need[d] + 1].tobytes() for s, d in zip(some, docs)]
        return pa.table([pa.array(own[docs].view(np.int64)), pa.array(n[docs]), pa.array([np.sort(s).tobytes() for s in some], pa.binary()), pa.array(first, pa.binary())], ["u", "n", "set", "first"])

    def sizes(batches):
        for b in batches:
            if b.num_rows:
                u = b.column(0).to_numpy().astype(np.uint64)
                yield blobs(parts, u, u, b.column(1).to_numpy().astype(np.uint64))

    two, three = "bucket int, a binary, b binary", "bucket int, a binary, b binary, c binary"
    met = sets.select("u", "n", "set").mapInArrow(deal, two).repartition(parts, "bucket").groupBy("bucket").applyInArrow(meet, three)
    known = sets.select("u", "n").mapInArrow(sizes, two).withColumn("c", F.lit(None).cast("binary"))
    return met.unionByName(known).repartition(parts, "bucket").groupBy("bucket").applyInArrow(begin, "u long, n long, set binary, first binary")


def links(sets: DataFrame, shingles: int, threshold: float = 0.6) -> DataFrame:
    """(u, v, jaccard): pairs, written, of different sets with a Jaccard of at least threshold, u < v. sets: u, n, set, one document per distinct set; shingles: how many they have in all."""

    def begun(batches):
        import pyarrow as pa

        for b in batches:
            m = sizes_of(b.column(2)) // 8
            for i, j in pieces(m, HELD):
                h, d, at = numbers(b.column(2).slice(i, j - i)), np.repeat(np.arange(i, j), m[i:j]), np.cumsum(m[i:j]) - m[i:j]
                left = b.column(3).to_numpy()[d] - (np.arange(len(h)) - np.repeat(at, m[i:j]))  # shared ones behind it
                pos = np.arange(len(h)) - np.repeat(at, m[i:j])
                prev = pa.array(np.roll(h, 1).view(np.int64), mask=pos == 0)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(0).take(pa.array(d)), b.column(1).take(pa.array(d)), pa.array(left - 1), pa.array(pos), prev], ["sh", "u", "n", "left", "pos", "prev"])

    def common(pairs, sets):
        import pyarrow as pa

        rank = np.unique(numbers(sets["set"]), return_inverse=True)[1]
        doc, size = sets["doc"].to_numpy(), sizes_of(sets["set"].combine_chunks()) // 8
        own = dict(zip(doc.tolist(), np.split(rank, np.cumsum(size)[:-1])))
        pairs = pairs.sort_by("u")
        u, v, both, marks = pairs["u"].to_numpy(), pairs["v"].to_numpy().tolist(), [], np.zeros(len(rank), bool)
        at = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1], [True]]))
        for i, j in zip(at[:-1], at[1:]):
            marks[own[u[i]]] = True
            others = [own[x] for x in v[i:j]]
            begin = np.cumsum([0] + [len(x) for x in others[:-1]])
            both.append(np.add.reduceat(marks[np.concatenate(others)].astype(np.int64), begin))
            marks[own[u[i]]] = False
        return pairs.select(["u", "v", "xy"]).append_column("both", pa.array(np.concatenate(both)))

    some = written(shared(sets, threshold, shingles))
    prefix = some.select("u", "n", "first", (F.octet_length("set") / 8).cast("long")).mapInArrow(begun, "sh long, u long, n long, left long, pos long, prev long")
    a, b = prefix, prefix.select("sh", F.col("u").alias("v"), F.col("n").alias("m"), F.col("left").alias("_l"), F.col("pos").alias("_p"), F.col("prev").alias("_v"))
    met = a.join(b, "sh").filter((F.col("u") < F.col("v")) & (F.least("n", "m") >= threshold * F.greatest("n", "m")))
    met = met.filter(F.coalesce(F.col("prev") != F.col("_v"), F.lit(True)))  # of a run that both have the first one is enough
    most = F.least("pos", "_p") + 1 + F.least("left", "_l")  # what both can have before, here and behind
    near = written(met.filter(most * (1 + threshold) >= threshold * (F.col("n") + F.col("m")) - 1e-6).select("u", "v", (F.col("n") + F.col("m")).alias("xy")).distinct())
    # Pairs are confirmed in squares of two blocks of documents, so a document's set goes once to each square it has pairs in, not to each pair.
    whole = some.select("u", "set").join(near.select("u").union(near.select("v")).distinct(), "u", "left_semi")
    held, pairs = whole.agg(F.sum(F.octet_length("set") / 8)).head()[0] or 0, near.count()
    blocks = int(max(held / TASK_SHINGLES, (pairs / TASK_SHINGLES) ** 0.5)) + 1
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    square = near.select("u", "v", "xy", block("u").alias("x"), block("v").alias("y"))
    asked = square.select("x", "y", "u").union(square.select("x", "y", "v")).distinct().join(whole, "u").select("x", "y", "u", "set").toDF("_x", "_y", "doc", "set")
    sized = square.groupBy("x", "y").cogroup(asked.groupBy("_x", "_y")).applyInArrow(common, "u long, v long, xy long, both long")
    union = F.col("xy") - F.col("both")
    found = written(sized.filter(F.col("both") >= threshold * union).select("u", "v", F.round(F.col("both") / union, 9).alias("jaccard")))
    removed(some, near)
    return found


def near_classes(docs: DataFrame, threshold: float = 0.6, order: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, rep, n) of every document, both written, and links (lang, a, b, jaccard) between representatives.

    docs: lang, doc_id, text; order: doc_id, rank (which document of a class represents it; by default the smallest doc_id)."""
    sets = written(shingle_sets(docs))
    of = written(classes(sets, order))
    reps = written(of.filter("doc_id = rep AND lang IS NOT NULL").select("u", "lang", "doc_id", "n"))
    shingles = reps.agg(F.sum("n")).head()[0] or 0
    met = links(sets.select("u", "n", "set").join(reps.select("u"), "u", "left_semi"), shingles, threshold)
    a, b = reps.select("u", "lang", F.col("doc_id").alias("_x")), reps.select(F.col("u").alias("v"), F.col("doc_id").alias("_y"))
    between = written(met.join(a, "u").join(b, "v").select("lang", F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "jaccard"))
    every = docs.select("doc_id").distinct().join(of.select("doc_id", "rep", "n"), "doc_id", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("n", F.lit(0)).alias("n"))
    member = written(every)
    removed(sets, of, reps, met)
    return member, between


def counted(member: DataFrame, between: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, n_links): how many other documents each one is linked with, copies included, without listing a pair of copies."""
    size = member.groupBy("rep").agg(F.count(F.lit(1)).alias("class_size"))
    both = between.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(between.select("b", "a"))
    far = both.join(size.select(F.col("rep").alias("other"), F.col("class_size").alias("_o")), "other").groupBy("rep").agg(F.sum("_o").alias("_far"))
    per = size.join(far, "rep", "left").select("rep", "class_size", (F.col("class_size") - 1 + F.coalesce("_far", F.lit(0))).alias("n_links"))
    return member.join(per, "rep").select("doc_id", F.col("rep").alias("class_id"), "class_size", "n_links")
