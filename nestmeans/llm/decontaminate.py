"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact check.

Every item is compared with windows of its own number of words. A window that shares no shingle
with an item has similarity 0, and one that reaches ``similarity`` shares one of the item's
*anchor* shingles: any set of them that holds more than 1 - similarity of the item's weight; the rarest of the
benchmark are taken. So every window that holds an anchor found in the document is laid, wherever the anchor
stands in it (the similarity is free of order, so moved sentences shift it), for the items whose anchor it holds; all
others are skipped unhashed and nothing is lost by it. Each window's 64-bit SimHash (features are
its shingles, weighted by their counts) is then looked up among its items in a multi-index: fingerprints within
``radius`` agree, in at least one of ``blocks`` blocks, up to radius // blocks bits, and all block
values within that many bits are listed for each item, so every fingerprint within the radius is
found. Fingerprints of windows at the similarity of 0.75 differ in each bit with probability 0.172; the radius
of 24 passes all but 3e-05 of them (binomial; 0.020 at 17). Candidates are kept when the exact weighted
similarity, sum of the smaller by sum of the larger counts, reaches ``similarity``.

Built-in functions only. The texts are read once and never shuffled: words are exploded and meet the
anchors (rows of fixed width) in a broadcast join while those have at most ``max_broadcast`` rows, else in a shuffled one.

Words are runs of letters and digits, lower-cased. Defined cases: NULL and empty texts, and items
without a word, match nothing; items of fewer than five words have one shingle of all of them;
repeated documents or items are each reported once by id; NULL ids are reported as NULL; a window that
would begin before the text or end after it is moved inside, and a shorter text is one window; of equally similar windows the
one of the smaller distance, then of the smaller start is reported; texts of any length are read whole; an empty table on
either side gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestmeans.llm.common import SHINGLE_WORDS, SIMILARITY, let
from nestmeans.scratch import checkpoint, materialize

RADIUS = 24
BLOCKS = 9
BITS = 64
MAX_BROADCAST = 2_000_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(parts, "")


def _hash_at(words: Column, at: Column, width: int) -> Column:
    """Hash of ``width`` words from the 0-based place ``at``."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(width)])


def shingles_of(words: Column, width: int) -> Column:
    """Shingle hashes in order; all words as one when there are fewer than ``width``."""
    full = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: _hash_at(words, i, width))
    short = F.lit(None).cast("array<bigint>")
    for n in range(width - 1, 0, -1):
        short = F.when(F.size(words) == n, F.array(_hash_at(words, F.lit(0), n))).otherwise(short)
    return F.when(F.size(words) >= width, full).otherwise(F.coalesce(short, F.array().cast("array<bigint>")))


def weights_of(shingles: Column) -> Column:
    """``[(shingle, count)]`` of the distinct shingles."""
    return F.transform(
        F.array_distinct(shingles), lambda s: F.struct(s.alias("s"), F.size(F.filter(shingles, lambda x: x == s)).alias("c"))
    )


def simhash(weights: Column) -> Column:
    """64-bit SimHash: a bit is set where the weight of features with that bit is the larger half."""
    total = F.aggregate(weights, F.lit(0), lambda a, w: a + w["c"])
    held = F.aggregate(
        weights, F.array_repeat(F.lit(0), BITS), lambda acc, w: F.transform(acc, lambda a, place: a + F.getbit(w["s"], place) * w["c"])
    )
    one = F.lit(1).cast("bigint")

    def folded(total: Column) -> Column:
        bits = F.transform(held, lambda a, place: F.when(a * 2 > total, F.call_function("shiftleft", one, place)).otherwise(0))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseOR(y))

    return let(total, folded)


def similarity_of(a: Column, b: Column) -> Column:
    """Sum of the smaller by sum of the larger counts of two weight lists."""
    common = F.aggregate(
        a, F.lit(0),
        lambda t, x: t + F.coalesce(
            F.array_max(F.transform(F.filter(b, lambda y: y["s"] == x["s"]), lambda y: F.least(y["c"], x["c"]))), F.lit(0)
        ),
    )
    size = lambda w: F.aggregate(w, F.lit(0), lambda t, x: t + x["c"])
    return F.try_divide(common, size(a) + size(b) - common)


def _block_spans(blocks: int) -> list[tuple[int, int]]:
    """``(first bit, bits)`` of each block."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(cuts)]


def block_keys(fingerprint: Column, blocks: int, reach: int) -> Column:
    """All ``(block, value)`` within ``reach`` bits of the fingerprint's own blocks."""
    flips = [  # number, start and width of the block, and the bits to flip, a byte each but for the last
        number | start << 8 | bits << 16 | sum(1 << f for f in chosen) << 24
        for number, (start, bits) in enumerate(_block_spans(blocks))
        for n in range(reach + 1) for chosen in itertools.combinations(range(bits), n)
    ]
    byte = lambda flip, at: F.shiftright(flip, at).bitwiseAND(F.lit(255)).cast("int")

    def key(flip: Column) -> Column:
        own = F.call_function("shiftrightunsigned", fingerprint, byte(flip, 8))
        low = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), BITS - byte(flip, 16))
        value = own.bitwiseAND(low).bitwiseXOR(F.shiftright(flip, 24))
        return F.struct(byte(flip, 0).alias("block"), value.alias("value"))

    return F.transform(F.lit(flips).cast("array<bigint>"), key)


def item_table(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """``(item, item_id, size, weights, fingerprint)`` of items with a word, written once; ``item`` numbers the rows."""
    parsed = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    weighed = let(shingles_of(F.col("words"), width), weights_of)
    parsed = parsed.select("item_id", F.size("words").alias("size"), weighed.alias("weights"))
    return checkpoint(parsed.select(F.monotonically_increasing_id().alias("item"), "*", simhash(F.col("weights")).alias("fingerprint")))


def anchors_of(items: DataFrame, similarity: float, width: int) -> DataFrame:
    """``(span, shingle, item, size)``: the anchor shingles of every item.

    The rarest shingles of the item, by the number of items that hold them, that weigh more than ``1 - similarity``
    of it together. ``span`` is the number of words the shingle covers.
    """
    each = items.select("item", "size", F.inline("weights")).withColumnRenamed("s", "shingle")
    each = each.join(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("items")), "shingle")
    ordered = F.array_sort(F.collect_list(F.struct("items", F.col("shingle").alias("s"), "c"))).alias("ordered")
    listed = each.groupBy("item", "size").agg(ordered, F.sum("c").alias("total"))
    chosen = F.aggregate(
        "ordered",
        F.struct(F.lit(0).alias("t"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, w: F.when(
            acc["t"] > (1 - similarity) * F.col("total"), acc
        ).otherwise(F.struct((acc["t"] + w["c"]).alias("t"), F.concat(acc["out"], F.array(w["s"])).alias("out"))),
        lambda acc: acc["out"],
    )
    placed = listed.select("item", "size", F.explode(chosen).alias("shingle"))
    return placed.select(F.least("size", F.lit(width)).alias("span"), "shingle", "item", "size")


def _places(known: DataFrame, spans: list[int]) -> DataFrame:
    """``(doc_id, words, at, span, shingle)``: the shingles of every span wherever they begin, from one scan."""
    places = known.where(F.size("words") >= min(spans)).select(
        "doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - min(spans))).alias("at")
    )
    if len(spans) == 1:
        return places.select("*", F.lit(spans[0]).alias("span"), _hash_at(F.col("words"), F.col("at"), spans[0]).alias("shingle"))
    each = [F.struct(F.lit(n).alias("span"), _hash_at(F.col("words"), F.col("at"), n).alias("shingle")) for n in spans]
    return places.select("*", F.inline(F.array(*each))).where(F.col("at") + F.col("span") <= F.size("words"))


def candidate_windows(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, width: int, similarity: float, max_broadcast: int) -> DataFrame:
    """``(w, doc_id, item, start, weights, fingerprint)``: the windows of each item's size that hold an anchor of it; written.

    ``w`` numbers the rows: a window is one row for each item it is to be compared with.
    """
    anchors = checkpoint(anchors_of(items, similarity, width))
    counts = anchors.groupBy("span").count().collect()  # at most ``width`` values
    if sum(r["count"] for r in counts) <= max_broadcast:
        anchors = F.broadcast(anchors)
    known = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    met = _places(known, sorted(r["span"] for r in counts) or [width]).join(anchors, ["span", "shingle"])
    last = F.greatest(F.size("words") - F.col("size"), F.lit(0))
    low = F.least(F.greatest(F.col("at") - F.col("size") + F.col("span"), F.lit(0)), last)
    hits = met.select(
        "doc_id", F.xxhash64("words").alias("body"), "item", "size", "at", low.alias("low"), F.least("at", last).alias("high"),
        F.array_join(F.slice("words", low + 1, F.col("at") + F.col("size") - low), " ").alias("around"),
    )
    # a window belongs to its first anchor of the item: those that hold the anchor before are left to that one
    before = F.lag("at").over(Window.partitionBy("doc_id", "body", "item").orderBy("at"))
    hits = hits.distinct().withColumn("from", F.greatest("low", F.least(F.coalesce(before + 1, F.lit(0)), "high")))
    hits = hits.select("doc_id", "item", "size", "low", "around", F.explode(F.sequence("from", "high")).alias("start"))
    words = F.slice(F.split("around", " "), F.col("start") - F.col("low") + 1, F.col("size"))
    hits = hits.select("doc_id", "item", "start", F.array_join(words, " ").alias("window"))
    # small in bytes but dear to hash, so spread by number and not by size
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    windows = hits.repartition(parts, "doc_id", "item", "start").distinct()

    def hashed(weights: Column) -> Column:
        return F.struct(weights.alias("weights"), simhash(weights).alias("fingerprint"))

    def weighed(shingles: Column) -> Column:
        return let(weights_of(shingles), hashed)

    known = let(F.split("window", " "), lambda words: let(shingles_of(words, width), weighed))
    windows = windows.select(F.monotonically_increasing_id().alias("w"), "doc_id", "item", "start", known.alias("k"))
    return materialize(windows.select("w", "doc_id", "item", "start", "k.*"), "windows")


def within_radius(windows: DataFrame, items: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``(w, item, distance)`` of the windows whose fingerprint is within ``radius`` of their item's, by the multi-index.

    Only numbers and fingerprints move; the lists of weights stay where they are.
    """
    listed = items.select(
        "item", F.col("fingerprint").alias("item_fingerprint"), F.explode(block_keys(F.col("fingerprint"), blocks, radius // blocks)).alias("key")
    )
    probes = windows.select("w", "item", "fingerprint", F.explode(block_keys(F.col("fingerprint"), blocks, 0)).alias("key"))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    met = probes.join(listed, ["item", "key"]).select("w", "item", distance.alias("distance"))
    return met.where(F.col("distance") <= radius).distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", width: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY, radius: int = RADIUS, blocks: int = BLOCKS, max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``(doc_id, item_id, start, words, distance, similarity)``: the best window of each item found in a document.

    ``start`` is the window's first word, counted from 0.
    """
    items = item_table(benchmark, item_col, item_text, width)
    windows = candidate_windows(docs, items, id_col, text_col, width, similarity, max_broadcast)
    met = materialize(within_radius(windows, items, radius, blocks), "near-windows")
    known = items.select("item", "item_id", "size", F.col("weights").alias("item_weights"))
    met = windows.select("w", "doc_id", "start", "weights").join(met, "w").join(known, "item")
    met = met.withColumn("similarity", similarity_of(F.col("weights"), F.col("item_weights"))).where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("start", "distance"), F.struct("similarity", -F.col("distance"), -F.col("start"))).alias("best")
    return met.groupBy("doc_id", "item_id", "size").agg(best, F.max("similarity").alias("similarity")).select(
        "doc_id", "item_id", F.col("best.start").alias("start"), F.col("size").alias("words"),
        F.col("best.distance").cast("int").alias("distance"), "similarity",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the documents in which an item was found."""
    found = leaks(docs, benchmark, id_col, text_col, **settings).select(F.col("doc_id").alias("__gone")).distinct()
    # written as a table, whose known size lets Spark broadcast it when small and shuffle it else
    return docs.join(materialize(found, "gone"), docs[id_col].eqNullSafe(F.col("__gone")), "left_anti")
