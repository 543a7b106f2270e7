"""Benchmark passages in documents, by SimHash of item-sized windows; DataFrame functions only.

A document's windows are as many shingles long as the item they may hold. Only windows that
contain a shingle of some item can reach any similarity with one, so only those are made: each
shared shingle puts a window where its item would begin. A shingle weighs as much as it has
places in the window or item, whatever other items have it: an item that is listed under many ids
is found like any other. The weighted shingles give 64-bit SimHash fingerprints. Fingerprints are cut into one block more than the
radius; two within the radius agree in one block at least, so joins on blocks find them all.
Candidates are verified by the weighted Jaccard similarity of their shingles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import stored, whole_row
from millrace.operators.joins import join_broadcasting

WORDS = 5
LEAST = 0.75
#: Bits in which fingerprints may differ. Similarity 0.75 gives 11 on average, with deviation 3.
RADIUS = 21
_SPACES = r"[\x20\x09-\x0D]+"


def with_shingles(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add ``shingles``: hashes of five words in a row, or of all words of a shorter text, in order.

    To explode them use the outer forms: for the others Catalyst infers a filter on the size and
    computes the whole expression once more below, per element.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SPACES), lambda w: w != "")
    rows = rows.withColumn("_words", words).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    size = F.size("_hashes")
    many = F.transform(
        F.sequence(F.lit(0), F.greatest(size - WORDS, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(F.col("_hashes"), i + k) for k in range(WORDS))),
    )
    few = F.array(F.xxhash64(size, F.array_join("_words", " ")))
    shingles = F.when(size >= WORDS, many).when(size > 0, few).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn("shingles", shingles).drop("_words", "_hashes")


def fingerprints(rows: DataFrame, *key: str) -> DataFrame:
    """SimHash of the weighted shingles under each key: ``key, fingerprint, total`` from ``key, shingle, times``."""
    amount = F.col("times")
    half = 32
    # Two counters to a number, 32 bits each.
    lanes = [
        F.sum((F.shiftrightunsigned("shingle", j).bitwiseAND(F.lit(0x0000000100000001))) * amount).alias(f"lane_{j}") for j in range(half)
    ]
    sums = rows.groupBy(*key).agg(F.sum(amount).alias("total"), *lanes)

    def bit(j: int) -> Column:
        lane = F.col(f"lane_{j % half}")
        count = lane.bitwiseAND(F.lit(0x7FFFFFFF)) if j < half else F.shiftright(lane, 32)
        return F.shiftleft((count * 2 > F.col("total")).cast("long"), j)

    return sums.select(*key, "total", reduce(lambda a, b: a.bitwiseOR(b), map(bit, range(64))).alias("fingerprint"))


def blocks(fingerprint: str, radius: int) -> Column:
    """The blocks of a fingerprint as ``(number, bits)``: one more than the radius."""
    count = radius + 1
    edges = [64 * k // count for k in range(count + 1)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("number"),
                F.shiftrightunsigned(fingerprint, start).bitwiseAND(F.lit((1 << (end - start)) - 1)).alias("bits"),
            )
            for k, (start, end) in enumerate(zip(edges[:-1], edges[1:]))
        )
    )


def _item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, item_hash, length, place, shingle``; repeated rows count once, other texts under the same id stand apart by their hash."""
    rows = items.filter("item_id is not null").select("item_id", F.xxhash64("text").alias("item_hash"), "text").dropDuplicates(["item_id", "item_hash"])
    rows = with_shingles(rows).select("item_id", "item_hash", F.size("shingles").alias("length"), F.posexplode_outer("shingles").alias("place", "shingle"))
    return rows.filter("shingle is not null")


def contaminated(
    docs: DataFrame, items: DataFrame, least: float = LEAST, radius: int = RADIUS, key: str = "doc_id"
) -> DataFrame:
    """``doc_id, item_id, similarity, start, length`` of documents that hold a passage like an item.

    One row for each document and item, at its most similar window (the first of equals), which
    begins at shingle ``start``. Null and empty texts, documents without an id and empty items
    match nothing. Items of fewer than five words match documents that are nothing else. Rows
    that share an id are one document or item: each of their texts is compared by itself, a
    repeated text once. Extra columns are ignored.
    """
    item = ("item_id", "item_hash")
    places = stored(_item_shingles(items), "items")
    counts = stored(places.groupBy(*item, "length", "shingle").agg(F.count("*").cast("long").alias("times")), "item-counts")

    texts = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    found = with_shingles(texts).select("doc_id", "text_hash", F.size("shingles").alias("size"), F.posexplode_outer("shingles").alias("at", "doc_shingle"))
    hits = join_broadcasting(found, places, F.col("doc_shingle") == F.col("shingle"))
    # Where the item would begin, within the document.
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("size") - F.col("length")))
    windows = hits.select("doc_id", "text_hash", start.alias("start"), "length").distinct()
    by_doc = stored(windows.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("windows")), "windows")

    same = (F.col("doc_id") == F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    held = join_broadcasting(texts, by_doc.withColumnsRenamed({"doc_id": "of", "text_hash": "of_hash"}), same).drop("of", "of_hash")
    held = held.dropDuplicates(["doc_id", "text_hash"])
    opened = with_shingles(held).select("doc_id", "text_hash", "shingles", F.explode_outer("windows").alias("window"))
    opened = opened.select(
        "doc_id", "text_hash", "window.start", "window.length", F.explode_outer(F.slice("shingles", F.col("window.start") + 1, F.col("window.length"))).alias("shingle")
    )
    name = ("doc_id", "text_hash", "start", "length")
    inside = opened.groupBy(*name, "shingle").agg(F.count("*").cast("long").alias("times"))
    inside = stored(inside, "window-shingles")

    marks = stored(fingerprints(inside, *name), "window-fingerprints")
    item_marks = stored(fingerprints(counts, *item, "length"), "item-fingerprints").select(
        *item, F.col("length").alias("item_length"), F.col("total").alias("item_total"), F.col("fingerprint").alias("item_fingerprint")
    )
    item_blocks = item_marks.withColumn("item_block", F.explode(blocks("item_fingerprint", radius)))
    near = marks.withColumn("block", F.explode(blocks("fingerprint", radius))).join(
        item_blocks, (F.col("length") == F.col("item_length")) & (F.col("block") == F.col("item_block"))
    )
    near = near.filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= radius)
    near = near.select(*name, "total", *item, "item_total").distinct()

    shared = near.join(inside, [*name]).alias("w").join(
        counts.select(F.col("item_id").alias("of_item"), F.col("item_hash").alias("of_hash"), F.col("length").alias("of_length"), F.col("shingle").alias("of_shingle"), F.col("times").alias("item_times")),
        (F.col("item_id") == F.col("of_item")) & (F.col("item_hash") == F.col("of_hash")) & (F.col("length") == F.col("of_length")) & (F.col("shingle") == F.col("of_shingle")),
    )
    both = shared.groupBy(*name, "total", *item, "item_total").agg(F.sum(F.least("times", "item_times")).alias("both"))
    similarity = F.col("both") / (F.col("total") + F.col("item_total") - F.col("both"))
    alike = both.withColumn("similarity", similarity).filter(F.col("similarity") >= least)
    best = F.max_by(F.struct("similarity", "start", "length"), F.struct("similarity", -F.col("start"), "length"))
    return alike.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.similarity", "best.start", "best.length"
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` without documents that hold a passage like an item; rows without an id stay."""
    bad = stored(contaminated(docs, items, key=key, **settings).select(F.col("doc_id").alias("bad_id")).distinct(), "contaminated")
    rows = docs.select(whole_row(docs).alias("row"), F.col(key).alias("id"))
    return join_broadcasting(rows, bad, F.col("id") == F.col("bad_id"), "left_anti").select("row.*")
