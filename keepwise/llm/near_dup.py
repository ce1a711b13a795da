"""Near-duplicate documents: MinHash with tensored banding, candidates confirmed on full shingle sets.

``m`` small collections of two minhashes (side A) and ``m`` more (side B) give
``m * m`` tables: the key of table (i, j) pairs A_i with B_j.  ``4 m`` minhash
values thus serve ``m * m`` tables of four values each, about the square root
of the work of independent tables.  ``m`` follows from the similarity and the
chance of missing a link at exactly that similarity on one side.

Documents with equal shingle sets are one class; tables hold one row per class.
In each bucket, classes meet the bucket's smallest and largest class id (a star,
not all pairs).  Buckets of more than three classes that still span several
components go through an exact prefix-filter join: two sets with Jaccard >= s
share one of their rarest ``n - ceil(s n) + 1`` shingles. First each row meets only the hubs of its
shingles (per shingle and band of sizes the few rows with the fewest rarer shingles, next to the middle of
their group), in turns while that joins components; then all rows of still different components meet, the
largest component of a shingle only the others. Two bounds of the overlap are part of both
joins: after their first common shingle (in order of rarity) both sets have only so many left, and
bitmaps have only so many common bits (and shingles that share a bit with another of their own set).
Pairs that merely share a passage fall to the first bound, as their own shingles are rarer and come first. Every
candidate is confirmed on both full sets before it links anything. Joins of narrow tables that every turn
repeats are sort-merge joins at every size: the driver would hold a thread and pages for each broadcast.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepwise.llm.common import fan_out, per_key, salted, saved, table_text
from keepwise.llm.components import components
from keepwise.session import ship_package

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 14
_CLASS_SALTS = 1024
_HUB_SALTS = 8
_HUBS = 4             # of a shingle and size band a turn; what hubs leave open meets in the exact join
_HUB_TURNS = 3
_BITMAP_WORDS = 12


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words: one shingle; no word: empty."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=k)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += _scramble(h[j:j + n] * _MIX[200 + j])
    return np.unique(_scramble(out))


def _minhashes(s: np.ndarray, count: int) -> np.ndarray:
    best = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), _BLOCK):
        best = np.minimum(best, (s[None, at:at + _BLOCK] * _MIX[:count, None]).min(axis=1))
    return best


def side_count(similarity: float, miss: float) -> int:
    """Collections a side needs: (1 - s^2)^m <= miss."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity ** 2)))


def _signatures(k: int, m: int):
    def run(batches):
        for batch in batches:
            rows = {"doc_id": batch.column(0), "n_shingles": [], "fp": [], "sides": []}
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                rows["n_shingles"].append(len(s))
                rows["fp"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                two = _minhashes(s, 4 * m).reshape(2 * m, 2)
                rows["sides"].append(_scramble(two[:, 0] * _MIX[100] + two[:, 1]).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array(rows["n_shingles"], pa.int64()), pa.array(rows["fp"], pa.binary()),
                 pa.array(rows["sides"], pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "fp", "sides"])
    return run


def _set_rows(k: int):
    """(class, its fingerprint, a text of its document) -> (class, set bytes), where the text is of that class."""
    def run(batches):
        for batch in batches:
            ids, sets = [], []
            for i, fp, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                s = shingle_set(text.as_py(), k).tobytes()
                if xxhash.xxh3_128_digest(s) == fp:
                    ids.append(i)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["id", "s"])
    return run


def _unpacked(batches):
    """id, set bytes -> id, shingles, bitmap of ``64 * _BITMAP_WORDS`` hashed places, shingles beyond its bits."""
    for batch in batches:
        shingles, bitmaps, beyond = [], [], []
        for s in batch.column(1).to_pylist():
            x = np.frombuffer(s, np.uint64)
            bits = np.zeros(64 * _BITMAP_WORDS, np.uint8)
            bits[(x % np.uint64(len(bits))).astype(np.int64)] = 1
            shingles.append(x.view(np.int64))
            bitmaps.append(np.packbits(bits).view(np.int64))
            beyond.append(len(x) - int(bits.sum()))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles, longs), pa.array(bitmaps, longs), pa.array(beyond, pa.int64())],
                                         names=["rep", "shingles", "bitmap", "beyond"])


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = [], []
            for i, j, s, t in zip(*(batch.column(c).to_pylist() for c in range(4))):
                x, y = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if den * both >= num * (len(x) + len(y) - both):
                    a.append(i)
                    b.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
            .mapInArrow(_confirm(num, den), "a long, b long"))


def _sizes_fit(x: str, y: str, num: int, den: int):
    return F.expr(f"{den} * least({x}, {y}) >= {num} * greatest({x}, {y})")


def _meeting(one: DataFrame, two: DataFrame, on: list[str], num: int, den: int, also: str = "true") -> DataFrame:
    """Pairs (a < b) of rows of different components, equal in ``on``, that the bounds of size and overlap leave."""
    columns = ["rep", "root", "main", "n", "at", "beyond", *(f"w{i}" for i in range(_BITMAP_WORDS))]
    one = one.select(*on, *(F.col(c).alias(f"a_{c}") for c in columns))
    two = two.select(*on, *(F.col(c).alias(f"b_{c}") for c in columns))
    common_bits = " + ".join(f"bit_count(a_w{i} & b_w{i})" for i in range(_BITMAP_WORDS))
    # no more in common than what follows the first common shingle in both orders, nor than the bitmaps leave
    overlap = f"least(least(a_n - a_at, b_n - b_at) + 1, least(a_beyond, b_beyond) + {common_bits})"
    return (one.join(two.hint("merge"), on)
            .filter(F.expr(also) & (F.col("a_root") != F.col("b_root"))
                    & _sizes_fit("a_n", "b_n", num, den) & F.expr(f"({den} + {num}) * {overlap} >= {num} * (a_n + b_n)"))
            .select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")).distinct())


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (rep, root) after the components that ``links`` (a, b) join have become one."""
    ends = (links.join(roots.select(F.col("rep").alias("a"), F.col("root").alias("ra")).hint("merge"), "a")
            .join(roots.select(F.col("rep").alias("b"), F.col("root").alias("rb")).hint("merge"), "b"))
    joined = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return (roots.join(joined.select(F.col("id").alias("root"), F.col("root").alias("to")).hint("merge"), "root", "left")
            .select("rep", F.coalesce("to", "root").alias("root")))


def _rest(multi: DataFrame, roots: DataFrame, sets: DataFrame, done: DataFrame, num: int, den: int) -> DataFrame:
    """Links that stars have not settled: of classes of different components in a bucket of over three,
    that share one of their rarest shingles. Exact for Jaccard >= num / den up to links inside a component."""
    known = (multi.filter("classes > 3")
             .join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left")
             .withColumn("root", F.coalesce("root", "rep")))
    open_keys = known.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    unsettled = saved(known.join(open_keys.select("key"), "key", "left_semi")
                      .groupBy("rep").agg(F.first("root").alias("root"), F.first("n").alias("n")), "unsettled")
    unpacked = saved(sets.join(unsettled.select(F.col("rep").alias("id")), "id", "left_semi")
                     .mapInArrow(_unpacked, "rep long, shingles array<long>, bitmap array<long>, beyond long").join(unsettled, "rep"), "unpacked")
    shingles = unpacked.select("rep", "root", "n", F.explode("shingles").alias("shingle"))
    shared = shingles.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    mine = Window.partitionBy("rep")
    prefix = (shingles.join(shared, "shingle")
              .withColumn("at", F.row_number().over(mine.orderBy("df", "shingle")))
              .withColumn("at", F.col("at") + F.col("n") - F.count("*").over(mine))        # shingles of no other set come first
              .filter(F.expr(f"at <= n - cast(ceil({num} * n / {den}) as long) + 1"))
              .select("shingle", "rep", "n", F.col("at").cast("int").alias("at")))
    prefix = saved(prefix, "prefix")
    facts = unpacked.select("rep", "beyond", F.floor(F.log("n") / math.log(den / num)).alias("band"),
                            *(F.coalesce(F.col("bitmap")[i], F.lit(0)).alias(f"w{i}") for i in range(_BITMAP_WORDS)))
    roots, links, tried = unsettled.select("rep", "root"), None, done

    def still_open() -> DataFrame:
        """Rows whose shingle several components share, and which even the smallest set with that shingle lets reach
        the similarity; ``main`` is the largest component with that shingle. Each step is written: as one plan they would
        repeat each other, and the driver keeps a description of the whole plan for each stage that ends."""
        sizes = roots.groupBy("root").agg(F.count("*").alias("members"))
        sized = saved(roots.join(sizes.hint("merge"), "root"), "sized")
        rows = prefix.join(sized.hint("merge"), "rep")
        for _ in range(2):
            groups = (rows.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least_n"),
                                                  F.max(F.struct("members", "root"))["root"].alias("main")).filter("lo != hi"))
            groups = saved(groups.select("shingle", "least_n", "main"), "groups")
            rows = (rows.drop("main").join(groups.hint("merge"), "shingle")
                    .filter(f"({den} + {num}) * (n - at + 1) >= {num} * (n + least_n)").drop("least_n"))
        return saved(rows.drop("members"), "open").join(facts, "rep")

    rows = still_open()
    for turn in range(_HUB_TURNS):
        order = F.row_number().over(Window.partitionBy("shingle", "band").orderBy("at", "rep"))
        hubs = (rows.withColumn("_rank", order).filter(F.col("_rank") <= (turn + 1) * _HUBS).filter(F.col("_rank") > turn * _HUBS)
                .withColumn("_salt", F.explode(F.expr(f"sequence(0L, {_HUB_SALTS - 1}L)"))))
        meets = salted(rows.withColumn("band", F.explode(F.expr("array(band - 1, band, band + 1)"))), "rep", _HUB_SALTS)
        pairs = saved(_meeting(meets, hubs, ["shingle", "band", "_salt"], num, den).join(tried.hint("merge"), ["a", "b"], "left_anti"), "pairs")
        found = saved(_verified(pairs, sets, num, den), "found")
        if found.isEmpty():
            break
        tried = tried.union(pairs)
        links = found if links is None else links.union(found)
        roots = saved(_joined(roots, found), "roots")
        rows = still_open()
    # of two different components one is not the shingle's largest: members of that one need not meet each other
    pairs = saved(_meeting(rows.filter("root != main"), rows, ["shingle"], num, den, "b_root = b_main or a_rep < b_rep").join(tried.hint("merge"), ["a", "b"], "left_anti"), "rest")
    last = _verified(pairs, sets, num, den)
    return last if links is None else links.union(last)


def _of_one_document(sigs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows that repeat a doc_id with different sets."""
    several = sigs.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo != hi").select("doc_id")
    mine = sigs.select("doc_id", "fp").join(several, "doc_id", "left_semi").distinct().join(classes.select("fp", "cid"), "fp").select("doc_id", "cid")
    mine = saved(mine, "repeated")
    return mine.join(mine.groupBy("doc_id").agg(F.min("cid").alias("a")), "doc_id").select("a", F.col("cid").alias("b")).filter("a != b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    num: int = 80, den: int = 100, miss: float = 2e-4) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs of non-blank characters, A-Z lower-cased; documents link when
    ``den * |intersection| >= num * |union|`` of their k-word shingle sets; component_id is the
    smallest doc_id reachable. Null, empty and blank texts have no shingle and link with nothing.
    Rows that repeat a doc_id are one document: the links of each of their texts are its links.
    A null doc_id never links: component_id null, kept true. Other columns are ignored. An empty table
    gives an empty table. Whole texts are read, whatever their length, in batches of bounded bytes.
    """
    ship_package(docs.sparkSession)
    m = side_count(num / den, miss)
    texts = table_text(docs, id_col, text_col)
    sigs = saved(texts.mapInArrow(_signatures(k, m), "doc_id long, n_shingles long, fp binary, sides array<long>"), "sigs")

    known = sigs.filter("n_shingles > 0 and doc_id is not null")
    classes, pairs = per_key(salted(known, "doc_id", _CLASS_SALTS), ["fp"], [F.min("doc_id").alias("rep")], [F.min("rep").alias("rep")])
    # a class is a shingle set: its number, its smallest doc_id
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    reps = (known.join(classes.select("fp", F.col("rep").alias("doc_id"), "cid"), ["fp", "doc_id"])
            .groupBy(F.col("cid").alias("rep")).agg(F.first("n_shingles").alias("n"), F.first("sides").alias("sides")))
    keys = saved(reps, "reps").select(
        "rep", "n", F.expr(f"explode(flatten(transform(slice(sides, 1, {m}), (x, i) -> "
                           f"transform(slice(sides, {m + 1}, {m}), (y, j) -> xxhash64(x, y, i * {m} + j)))))").alias("key"))
    hubs = (keys.groupBy("key")
            .agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.min_by("n", "rep").alias("n_lo"),
                 F.max_by("n", "rep").alias("n_hi"), F.count("*").alias("classes"))
            .filter("lo != hi")
            .withColumn("_salt", F.explode(F.expr(f"sequence(0L, {_HUB_SALTS - 1}L)"))))
    multi = saved(salted(keys, "rep", _HUB_SALTS).join(hubs, ["key", "_salt"]).drop("_salt"), "multi")

    starred = multi.select("rep", "n", F.explode(F.expr("array(struct(lo as hub, n_lo as m), struct(hi as hub, n_hi as m))")).alias("h"))
    stars = saved(starred.filter(F.col("rep") != F.col("h.hub")).filter(_sizes_fit("n", "h.m", num, den))
                  .select(F.least("rep", "h.hub").alias("a"), F.greatest("rep", "h.hub").alias("b")).distinct(), "stars")
    wanted = (classes.join(multi.select(F.col("rep").alias("cid")).distinct(), "cid", "left_semi")
              .select("cid", "fp", F.col("rep").alias("doc_id")))
    sets = saved(wanted.join(texts, "doc_id").select("cid", "fp", "text").mapInArrow(_set_rows(k), "id long, s binary")
                 .groupBy("id").agg(F.min("s").alias("s")), "sets")
    links = saved(_verified(stars, sets, num, den), "links")
    rest = _rest(multi, components(links), sets, stars, num, den)
    links = saved(links.union(rest).union(_of_one_document(known, classes)), "links")

    rooted = saved(classes.join(components(links).withColumnRenamed("id", "cid"), "cid", "left")
                   .select("fp", "rep", "cid", F.coalesce("root", "cid").alias("root")), "rooted")
    rooted = salted(rooted, "cid", _CLASS_SALTS)
    smallest, spread = per_key(rooted, ["root"], [F.min("rep").alias("component_id")], [F.min("component_id").alias("component_id")])
    facts = saved(fan_out(rooted, spread, smallest, ["root"]).select("fp", "component_id"), "facts")
    linked = fan_out(salted(sigs.select("doc_id", "n_shingles", "fp"), "doc_id", _CLASS_SALTS), pairs, facts, ["fp"])
    root = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (linked.select("doc_id", "n_shingles", root.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
