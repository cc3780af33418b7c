"""Fingerprints of documents by closed syncmers, with DataFrame functions only.

A text is a row of words: runs without blanks, at most ``PIECE`` characters each, a CJK character for itself.  Of its windows of k words
those are anchors whose least run of s words, by a hash, is the first or the last one in the window.  Whether a window is an
anchor depends on the window alone, so an edit touches only the anchors it overlaps, and anchors follow each other by
at most k - s words.  A text without an anchor is one itself if it has a word.

A fingerprint lists the anchors in order, 8 hex digits each: 28 bits of the anchor's hash, and the words since the anchor before
(the first: since the start), from which places follow.  Two fingerprints are compared by anchors that both have, in the same order.

Nulls and odd input: a null text is an empty one, whose fingerprint is empty and like itself alone; texts equal but for blanks have equal
fingerprints; rows without an id come last in the order of documents; rows of one id are ordered by a hash of the text, and of repeated rows
each is followed by the next; long texts are read as a whole in the row; other columns aren't looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import written

PIECE = 16
#: Words of an anchor and of the runs in it.
K, S = 6, 2
_CJK = r"\x{2E80}-\x{D7FF}"
WORD = rf"[{_CJK}]|[^\s{_CJK}]{{1,{PIECE}}}"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The anchors of a text in order, as numbers of 28 and 4 bits: hash, and words since the anchor before."""
    if not 0 < s < k or k - s > 15:
        raise ValueError("s is below k, by 15 at most")

    def chosen(h: Column, g: Column) -> Column:
        n = F.size(h)
        at = lambda i, j: F.get(g, i + j)

        def is_anchor(i: Column) -> Column:
            ends = F.least(at(i, 0), at(i, k - s))
            between = [at(i, j) for j in range(1, k - s)]
            return F.lit(True) if not between else ends <= (F.least(*between) if len(between) > 1 else between[0])

        places = F.filter(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), is_anchor)
        listed = lambda p: F.transform(p, lambda i, j: _entry(F.xxhash64(F.slice(h, i + 1, k)), i - F.coalesce(F.get(p, j - 1), F.lit(0))))
        whole = F.array(_entry(F.xxhash64(h), F.lit(0)))
        some = let(places, lambda p: F.when(F.size(p) > 0, listed(p)).otherwise(whole))
        return F.when(n >= k, some).when(n > 0, whole).otherwise(F.array().cast("array<int>"))

    def runs(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(*[x if j == 0 else F.get(h, i + j) for j in range(s)]))

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), lambda h: let(runs(h), lambda g: chosen(h, g)))


def _entry(hashed: Column, gap: Column) -> Column:
    return F.shiftleft(F.shiftright(hashed, 36).cast("int"), 4).bitwiseOR(gap.cast("int").bitwiseAND(F.lit(15)))


def digits(found: Column) -> Column:
    """The fingerprint of a text's anchors."""
    return F.array_join(F.transform(found, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the anchors that two texts have in the same order, over the distinct anchors of both; 1 if neither has any.

    Of an anchor that occurs again the first counts.  An anchor is in order if it comes behind the shared anchor before it in both texts."""
    hashed = lambda x: F.shiftright(x, 4).cast("long")
    last = (1 << 31) - 1
    # sorted by hash, then a before b; the first of an anchor's places is the last of a's and the first of b's
    one = F.transform(a, lambda x, i: F.shiftleft(hashed(x), 32) + (F.lit(last) - i).cast("long"))
    two = F.transform(b, lambda x, i: F.shiftleft(hashed(x), 32) + (i + F.lit(1 << 31).cast("long")))
    side = lambda x: F.shiftright(x, 31).bitwiseAND(F.lit(1).cast("long"))
    place = lambda x: x.bitwiseAND(F.lit(last).cast("long"))

    def compare(z: Column) -> Column:
        kinds = F.size(F.filter(z, lambda x, i: (i == 0) | (F.shiftright(x, 31) != F.shiftright(F.get(z, i - 1), 31))))  # distinct anchors of a, and of b
        met = F.transform(z, lambda x, i: F.when((side(x) == 0) & (F.shiftright(F.get(z, i + 1), 31) == F.shiftright(x, 31) + 1), F.shiftleft(F.lit(last) - place(x), 32) + place(F.get(z, i + 1))).otherwise(F.lit(-1).cast("long")))
        low = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1).cast("long"))
        inorder = let(F.sort_array(F.filter(met, lambda x: x >= 0)), lambda p: F.size(F.filter(p, lambda x, i: (i == 0) | (low(x) > low(F.get(p, i - 1))))))
        return F.when(kinds == 0, 1.0).otherwise(2.0 * inorder / kinds)

    return let(F.sort_array(F.concat(one, two)), compare)


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """docs with ``fingerprint``, which replaces a column of that name."""
    return docs.withColumn("fingerprint", digits(anchors(F.coalesce(F.col(text), F.lit("")), k, s)))


def successors(keys: DataFrame, order: list[Column]) -> DataFrame:
    """keys with ``follower``, a struct of the row that comes next by an order that tells rows apart; the first follows the last.

    Rows are numbered by ranges of the order and the ranges' sizes, and meet the next number; only sizes of partitions are broadcast."""
    columns = keys.columns
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    ranged = written(ranged.withColumn("_part", F.shiftright("_m", 33)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.select("_part", "_first", (F.sum("_n").over(w) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))  # a row for each partition
    numbered = ranged.join(F.broadcast(sizes), "_part").withColumn("_at", F.col("_before") + F.col("_m") - F.col("_first"))
    after = numbered.select(F.col("_at").alias("_to"), F.struct(*columns).alias("follower"))
    return numbered.withColumn("_to", (F.col("_at") + 1) % F.col("_all")).join(after, "_to").select(*columns, "follower")


def edited_report(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of docs.

    The edited text has the first characters of the next document, by falling id, in the place of its last third.  Whole texts are
    shuffled once, to their id; a third of each and its anchors go on to the document before."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.md5("text"))
    # a row for each distinct (id, text), the same for both ends of a link, so that texts are shuffled once
    key = lambda c="doc_id": F.coalesce(F.col(c).cast("string"), F.lit(""))
    keys = rows.groupBy("doc_id", "hash").agg(F.count("*").alias("copies"), F.first(F.length("text")).alias("size"))
    links = written(successors(keys, [F.desc_nulls_last("doc_id"), F.asc("hash")]).withColumn("null_id", F.col("doc_id").isNull()))
    links = links.select(key("follower.doc_id").alias("to_id"), F.col("follower.doc_id").isNull().alias("to_null"), F.col("follower.hash").alias("to_hash"), key().alias("id"), "null_id", "hash", "copies", "size")

    moved = rows.select("doc_id", key().alias("id"), F.col("doc_id").isNull().alias("null_id"), "hash", "text", anchors(F.col("text"), k, s).alias("own"))
    moved = moved.groupBy("id", "null_id", "hash").agg(F.first(F.struct("doc_id", "text", "own")).alias("d"))
    sent = moved.select(F.col("id").alias("to_id"), F.col("null_id").alias("to_null"), F.col("hash").alias("to_hash"), F.col("d").alias("after")).join(links, ["to_id", "to_null", "to_hash"])
    sent = sent.select("id", "null_id", "hash", "copies", F.expr("left(after.text, size div 3)").alias("head"), F.col("after.own").alias("next"))
    both = moved.join(sent, ["id", "null_id", "hash"]).select("d.doc_id", "d.text", "d.own", "head", "next", "copies")

    third = F.floor(F.length("text") / 3).cast("int")
    last = F.struct(F.lit(1).cast("long").alias("rows"), "head", "next")
    repeated = F.struct((F.col("copies") - 1).alias("rows"), F.left("text", third).alias("head"), F.col("own").alias("next"))
    both = both.select("doc_id", "text", "own", F.inline(F.when(F.col("copies") > 1, F.array(last, repeated)).otherwise(F.array(last))))
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.concat(F.left("text", F.length("text") - third), "head").alias("edited"), "own", "next", "rows")
    both = both.withColumn("changed", anchors(F.col("edited"), k, s))
    out = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digits(F.col("own")).alias("fingerprint"), digits(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"), "rows")
    return out.withColumn("rows", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
