"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders; windows of ``window``
template tokens are hash-joined between documents and benchmark items, and the
slots of an aligned run must map consistently (one benchmark value to one
document value and back), so re-parameterised copies are caught while texts that
merely share a frame are not. Beside each template window stands that of its plain, case-folded
words, which needs no slots: copies in another case and items of few or no literal words are found by it.
One pass over the documents serves the windows of all items, whatever their lengths. DataFrame operations only.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwise.llm.common import BLANK, saved

# fixed values: typed placeholders and the words that become them
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty "
                "sixty seventy eighty ninety hundred thousand million billion").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs pound pounds oz ounce ounces ml l "
         "liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
         "month months year years cent cents dollar dollars euro euros usd eur percent degree degrees").split()
NUMBER = r"^[$€£]?[0-9]+([.,:/][0-9]+)*(st|nd|rd|th|%)?$"
NAME = r"^\p{Lu}\p{Ll}+$"
# a word without the punctuation at its edges; words of punctuation only are no token
TOKEN = rf"[$€£]?[\p{{L}}\p{{N}}](?:[^{BLANK}]*[\p{{L}}\p{{N}}%])?"

# the benchmark's window hashes, eight bytes each, are broadcast up to this many bytes; beyond it both sides are shuffled
_BROADCAST_BYTES = 32 << 20
# template tokens of the short runs that measure how much of an item stands around its matching windows
_GRAM = 3
_SALTS = 16


def _template(token: Column, low: Column) -> Column:
    """Patterns run only where they can match: numbers start below ":" or at a currency sign, names differ from their lower case."""
    number = ((low < ":") | (low >= "£")) & low.rlike(NUMBER)
    return (F.when(number | low.isin(NUMBER_WORDS), F.lit("<num>"))
            .when(low.isin(UNITS), F.lit("<unit>"))
            .when((token != low) & token.rlike(NAME), F.lit("<name>"))
            .otherwise(low))


def _with_runs(hashed: DataFrame, lengths: list[int]) -> DataFrame:
    """``hashed`` + run_hash_n, run_plain_n per length n: the hashes of the runs of n elements, one for each place where n are left.

    A run's hash is made of its two parts' hashes, the first part a power of two long, so that each length costs one step an element."""
    def part(n: int) -> int:
        return 1 << (n - 1).bit_length() - 1

    need = set(lengths)
    for n in range(max(lengths), 1, -1):
        if n in need:
            need |= {part(n), n - part(n)}
    kinds = ("hash", "plain")
    out = hashed.withColumns({f"run_{c}_1": F.col(c) for c in kinds})
    for n in sorted(need - {1}):
        first, second = f"run_%s_{part(n)}", f"run_%s_{n - part(n)}"
        size = lambda c: F.greatest(F.size(c) - (n - 1), F.lit(0))  # noqa: B023, E731
        out = out.withColumns({f"run_{c}_{n}": F.zip_with(F.slice(first % c, 1, size(c)), F.slice(second % c, part(n) + 1, size(c)),
                                                       lambda x, y: F.xxhash64(x, y))
                               for c in kinds})
    return out.drop(*(f"run_{c}_{n}" for c in kinds for n in need - set(lengths)))


def _hashed(texts: DataFrame) -> DataFrame:
    """id, text -> id, body (one per id and text), token, hash (of the templates), plain (of the case-folded tokens), slot (0/1).
    Bits of ``plain`` are turned, so that the two kinds of windows never meet."""
    t = texts.select("id", F.xxhash64("id", "text").alias("body"),
                     F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(TOKEN), F.lit(0)).alias("token"))
    t = t.withColumn("both", F.transform("token", lambda x: F.struct(x.alias("token"), F.lower(x).alias("low"))))
    t = t.withColumn("template", F.transform("both", lambda x: _template(x["token"], x["low"])))
    return t.select("id", "body", "token", F.transform("template", lambda x: F.xxhash64(x)).alias("hash"),
                    F.transform("both", lambda x: F.bitwise_not(F.xxhash64(x["low"]))).alias("plain"),
                    F.transform("template", lambda x: x.startswith("<").cast("int")).alias("slot"))


def _placed(hashed: DataFrame, length: int) -> DataFrame:
    """id, body, at, kind, window, said (the window's tokens), is_slot (0/1 of each): two rows per place, its template's
    window (kind 0) and its plain words' (kind 1)."""
    both = F.arrays_zip(F.col(f"run_hash_{length}").alias("t"), F.col(f"run_plain_{length}").alias("p"))
    at = _with_runs(hashed, [length]).select("id", "body", "token", "slot", F.posexplode(both).alias("at", "w"))
    part = lambda c: F.slice(c, F.col("at") + 1, length)
    return at.select("id", "body", "at", part("token").alias("said"), part("slot").alias("is_slot"),
                     F.posexplode(F.array("w.t", "w.p")).alias("kind", "window"))


def _longest(places: Column) -> Column:
    """Length of the longest run of consecutive numbers in an array of distinct ints."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        n = F.when(x == s["last"] + 1, s["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), n.alias("n"), F.greatest(s["best"], n).alias("best"))

    return F.aggregate(F.array_sort(places), start, step, lambda s: s["best"])


def _grams(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(hashes) - (_GRAM - 1), F.lit(1))),
                       lambda i: F.xxhash64(F.slice(hashes, i, _GRAM)))


def _groups(runs: DataFrame, window: int) -> DataFrame:
    """Matching windows of a (document, item) by alignment: every single shift, and every chain of
    shifts that lie at most ``window`` apart, as an inserted or deleted word moves the rest of a copy."""
    nothing = F.expr("cast(array() as array<int>)")
    shifts = (runs.groupBy("id", "body", "item", "shift")
              .agg(F.collect_set("item_at").alias("places"), F.collect_set(F.when(F.col("kind") == 0, F.col("item_at"))).alias("matched"),
                   F.coalesce(F.collect_set(F.when(F.col("verbatim"), F.col("item_at"))), nothing).alias("same"),
                   F.array_distinct(F.flatten(F.collect_set("values"))).alias("pairs")))
    order = Window.partitionBy("id", "body", "item").orderBy("shift")
    chained = (shifts.withColumn("_new", (F.col("shift") - F.lag("shift", 1, 0).over(order) > window).cast("int"))
               .withColumn("chain", F.sum("_new").over(order).cast("int")))
    each = F.explode(F.array(F.struct(F.lit(0), "shift"), F.struct(F.lit(1), F.col("chain").alias("shift")))).alias("group")
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return (chained.select("*", each).groupBy("id", "body", "item", "group")
            .agg(union("matched").alias("matched"), union("same").alias("same"), union("pairs").alias("pairs"),
                 F.min("shift").alias("low"), F.max("shift").alias("high"),
                 F.min(F.col("shift") + F.array_min("places")).alias("at"), F.max(_longest(F.col("same"))).alias("run")))


def _with_share(groups: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """groups + share: the part of the item's template tokens that stand, in runs of ``_GRAM``, where the group lies."""
    n = F.size("item_hash")
    start = F.greatest(F.col("low") - window, F.lit(0))
    region = F.slice("hash", start + 1, F.col("high") + n + window - start)
    texts = docs.select(F.col("body"), "hash").dropDuplicates(["body"])
    met = saved(groups.join(texts, "body").withColumn("region", region).withColumn("n", n)
                .select(*groups.columns, "n", _grams(F.col("item_hash")).alias("grams"), _grams(F.col("region")).alias("there")), "regions")
    met = met.withColumn("common", F.array_intersect("grams", "there")).drop("there")
    covered = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.arrays_overlap(
        F.slice("grams", F.greatest(i - (_GRAM - 2), F.lit(1)), F.least(i + 1, F.lit(_GRAM))), F.col("common")))
    return met.withColumn("share", F.size(covered) / F.col("n"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = 8, min_literals: int = 4,
                 min_tokens: int = 3, cover: float = 0.6, run: int | None = None) -> DataFrame:
    """Pairs (doc_id, item_id, at, windows, item_windows, exact): documents that hold a benchmark item.

    Windows match by their templates or by their plain words, case-folded. Template windows need ``min_literals``
    literal tokens (fewer are no evidence); plain ones need none, so items and windows of numbers and names are found
    where they stand as they are, and in any case. Matching windows count on one alignment or on a chain of alignments that lie at
    most ``window`` tokens apart (words inserted or deleted between them). An item
    is held where every slot value maps to one value and back and ``cover`` of its
    usable template windows match or ``cover`` of its tokens stand there in runs of three;
    where ``cover`` of its windows are verbatim, whatever the other slots;
    or where ``run`` windows in a row (default: ``window``) are, whatever their share. ``at`` is the first aligned token, ``windows`` the places
    that match (verbatim or by template), ``item_windows`` all of the item's, ``exact`` tells whether no slot
    value was changed. Items of fewer than ``window`` tokens are matched whole; those of fewer than ``min_tokens``
    are words of any text and never match.
    Null and empty texts hold nothing; whole texts of any length are searched; rows that repeat an id count once per id;
    null ids, of documents or items, are reported as null. Other columns are ignored; an empty table on
    either side gives an empty table.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = saved(_hashed(benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).distinct()), "items")
    sizes = F.array_sort(F.collect_set(F.least(F.size("token"), F.lit(window))))
    lengths = [n for n in (items.agg(sizes).first()[0] or []) if n >= min_tokens]         # at most ``window`` numbers
    schema = "doc_id long, item_id long, at int, windows long, item_windows long, exact boolean"
    if not lengths:
        return docs.sparkSession.createDataFrame([], schema)

    def of_length(length: int) -> DataFrame:
        mine = items.filter(F.size("token") == length) if length < window else items.filter(F.size("token") >= window)
        literal = length - F.aggregate("is_slot", F.lit(0), lambda a, x: a + x)
        return (_placed(mine, length).filter((F.col("kind") == 1) | (literal >= min(min_literals, length)))
                .select(F.col("body").alias("item"), F.col("at").alias("item_at"), F.lit(length).alias("length"), "kind", "window",
                        F.col("said").alias("item_said"), "is_slot"))

    known = saved(reduce(DataFrame.unionByName, map(of_length, lengths)), "windows")
    narrow = saved(known.select("window").distinct(), "narrow")
    small = 8 * narrow.count() <= _BROADCAST_BYTES
    every = F.concat(*(F.col(f"run_{c}_{n}") for n in lengths for c in ("hash", "plain")))
    hits = saved(_with_runs(_hashed(texts), lengths).select("id", F.explode(every).alias("window"))
                 .join(F.broadcast(narrow) if small else narrow, "window", "left_semi")
                 .groupBy("id").agg(F.count("*").alias("n")), "hits")
    chosen = saved(_hashed(texts.join(hits.select(F.col("id").alias("hit")), F.col("id").eqNullSafe(F.col("hit")), "left_semi")), "chosen")
    places = reduce(DataFrame.unionByName, [_placed(chosen, n).select("id", "body", "at", "window", "said") for n in lengths])
    # a frequent window's places are dealt out to several tasks, each with all of its item places
    places = places.withColumn("_salt", F.pmod(F.xxhash64("body", "at"), F.lit(_SALTS)))
    copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    pair = lambda x: F.struct(F.lower(x["item_said"]).alias("b"), F.lower(x["said"]).alias("d"))
    values = F.transform(F.filter(F.arrays_zip("item_said", "said", "is_slot"), lambda x: x["is_slot"] == 1), pair)
    runs = (places.join(copies, ["window", "_salt"])
            .withColumn("values", F.when(F.col("kind") == 0, values).otherwise(F.slice(values, 1, 0)))
            .select("id", "body", "item", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "kind", "values",
                    F.forall("values", lambda p: p["b"] == p["d"]).alias("verbatim")))
    total = known.groupBy("item").agg(F.count_if(F.col("kind") == 0).alias("template_windows"), F.count_if(F.col("kind") == 1).alias("item_windows"))
    facts = items.select(F.col("body").alias("item"), F.col("id").alias("item_id"), F.col("hash").alias("item_hash")).join(total, "item")
    groups = _with_share(_groups(runs, window).join(facts, "item"), chosen, window)
    side = lambda c: F.size(F.array_distinct(F.transform("pairs", lambda p: p[c])))
    mapped = (side("b") == F.size("pairs")) & (side("d") == F.size("pairs")) & (F.size("matched") > 0)
    enough = (F.size("matched") >= cover * F.col("template_windows")) | ((F.col("n") >= window) & (F.col("share") >= cover))
    long_run = (F.col("n") >= window) & (F.col("run") >= (run or window))
    verbatim = F.size("same") >= cover * F.col("item_windows")
    found = (groups.filter((mapped & enough) | verbatim | long_run)
             .select(F.col("id").alias("doc_id"), "item_id", F.col("at").cast("int").alias("at"),
                     F.size(F.array_union("matched", "same")).cast("long").alias("windows"), "item_windows",
                     F.forall("pairs", lambda p: p["b"] == p["d"]).alias("exact")))
    best = F.max(F.struct("exact", "windows", F.negative("at").alias("minus_at"), "item_windows")).alias("b")
    return (found.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", F.negative("b.minus_at").cast("int").alias("at"), F.col("b.windows").alias("windows"),
                    F.col("b.item_windows").alias("item_windows"), F.col("b.exact").alias("exact")))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns."""
    bad = contaminated(docs, benchmark, id_col, **settings).select(F.col("doc_id").alias("held_id")).distinct()
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["held_id"]), "left_anti")
