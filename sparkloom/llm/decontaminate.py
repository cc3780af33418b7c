"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` words of each benchmark item, or the whole item if it is shorter.
Patterns of one length form one searcher.  Its shift table says for each block of two words (one word, for
patterns of one word) how far the search may move on; where the shift is zero, the last block of some pattern
was met, the bucket of that suffix lists the patterns that end so, and the words are compared directly.
All rows of a slice move on together, each by its own shift.

The benchmark reaches the tasks in blocks of about ``block_bytes`` of text at most, which bounds what the driver holds
and what is broadcast: a block's hits are written to the shared folder before the next block is read.  A larger
benchmark takes several passes over the documents, and the passes' hits are merged for each document.  A single item that
is longer than a block makes a block of its own.

Nulls and odd input: very long texts are searched whole; other columns stay, whatever their names; a null text, or one without a word, has no words, no hits and isn't contaminated; a null
or wordless item matches nothing; items with equal text are all listed; a null item_id isn't listed though its
words are hit.  Repeated documents each get a row.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import LOWER, byte_table, checkpointed, fresh, runs, utf8_slices, word_hashes

#: Word bytes after lower-casing: 0-9, a-z and every byte of a non-ASCII character.
WORD = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz", above_ascii=True)
#: Blocks hash to this many places of the shift table.
PLACES = 1 << 16


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the words, and the words' hashes."""
    low = LOWER[data]
    starts, ends = runs(WORD[low], offsets)
    return low, starts, ends, word_hashes(low, starts, ends)


class Searcher:
    """Wu-Manber over words for patterns that all have ``length`` words."""

    def __init__(self, length: int, patterns: dict[bytes, int]) -> None:
        self.length, self.block = length, min(2, length)
        self.shift = np.full(PLACES, length - self.block + 1, np.int32)
        self.buckets: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for words, number in patterns.items():
            raw = np.frombuffer(words, np.uint8)
            _, starts, _, hashes = words_of(raw, np.array([0, len(raw)]))
            places = self.places(hashes)
            np.minimum.at(self.shift, places[: length - self.block + 1], np.arange(length - self.block, -1, -1, dtype=np.int32))
            self.buckets[int(places[length - self.block])].append((words, number))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the shift table of the block that starts at each word."""
        if self.block == 1:
            return (hashes & np.uint64(PLACES - 1)).astype(np.int64)
        both = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        return (both >> np.uint64(48)).astype(np.int64)

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        """Yield (first word, pattern number) of each occurrence; bounds: first word of each row, and the end."""
        if len(hashes) < self.length:
            return
        shift = self.shift[places := self.places(hashes)]
        # a place is a block's first word; the block closes a possible occurrence that starts `back` words earlier
        back = self.length - self.block
        at, stop = bounds[:-1] + back, bounds[1:] - self.block
        alive = at <= stop
        at, stop = at[alive], stop[alive]
        while len(at):
            move = shift[at]
            for k in at[move == 0].tolist():
                first = k - back
                text = b" ".join([low[s:e].tobytes() for s, e in zip(starts[first : first + self.length].tolist(), ends[first : first + self.length].tolist(), strict=True)])
                for words, number in self.buckets.get(int(places[k]), ()):
                    if words == text:
                        yield first, number
            at = at + np.maximum(move, 1)
            alive = at <= stop
            at, stop = at[alive], stop[alive]


def build(items: list[tuple[str | None, str | None]], window: int) -> tuple[list[Searcher], list[list[str]]]:
    """Searchers by length, and for each pattern number the ids of the items that hold it."""
    numbers: dict[bytes, int] = {}
    owners: list[set[str]] = []
    by_length: dict[int, dict[bytes, int]] = defaultdict(dict)
    for item_id, text in items:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        low, starts, ends, _ = words_of(raw, np.array([0, len(raw)]))
        words = [low[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        k = min(window, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            pattern = b" ".join(words[i : i + k])
            number = numbers.setdefault(pattern, len(numbers))
            if number == len(owners):
                owners.append(set())
            if item_id is not None:
                owners[number].add(item_id)
            by_length[k][pattern] = number
    return [Searcher(k, v) for k, v in sorted(by_length.items())], [sorted(o) for o in owners]


def blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The benchmark's rows in blocks of about block_bytes, each small enough for the driver and a broadcast."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // block_bytes))
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else rows
        yield [(r["id"], r["text"]) for r in part.collect()]


def hit_words(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20, block_bytes: int = 8 << 20) -> DataFrame:
    """Add n_words, n_hit, n_items, items (sorted ids as strings), items_sha256 and contaminated (n_hit > 0 and
    share * n_hit >= n_words) to each row; input columns of these names are replaced."""
    added = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    docs = docs.drop(*added)
    spans, row = fresh(docs, "_spans"), fresh(docs, "_row")
    parts = blocks(benchmark, item_id, item_text, block_bytes)
    first, second = next(parts), next(parts, None)
    if second is None:
        searched = _searched(docs, first, text, window, spans)
    else:  # the hits of several passes meet by row
        rows = checkpointed(docs.withColumn(row, F.monotonically_increasing_id()))
        texts = rows.select(F.col(row).alias("_row"), F.col(text).alias("t"))
        merged = checkpointed(_searched(texts, first, "t", window, "_spans").drop("t"))
        part = second
        while part is not None:
            one = _searched(texts, part, "t", window, "_spans").where(F.size("_spans") > 0).drop("t")
            merged, part = merged.union(checkpointed(one)), next(parts, None)
        merged = merged.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("_spans")).alias(spans), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        searched = rows.join(merged.withColumnRenamed("_row", row), row)
    # spans are (first word, after the last); sorted and swept, so that words under several count once
    swept = F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")), lambda a, s: F.struct(F.greatest(a["to"], s["e"]).alias("to"), (a["n"] + F.greatest(F.lit(0).cast("long"), s["e"] - F.greatest(s["s"], a["to"]))).alias("n")))
    out = searched.withColumn("n_hit", swept["n"]).withColumn("n_items", F.size("items").cast("long")).withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    return out.select(*docs.columns, *added)


def _searched(docs: DataFrame, items: list[tuple[str | None, str | None]], text: str, window: int, name: str) -> DataFrame:
    """docs with n_words, ``name`` (spans of words hit by this block's items) and items."""
    searchers, owners = build(items, window)
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    schema = docs.withColumns({"n_words": F.lit(0).cast("long"), name: none, "items": F.array().cast("array<string>")}).schema
    span_type = pa.list_(pa.struct([pa.field("s", pa.int64()), pa.field("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words: list[int] = []
            spans: list[list[dict]] = []
            ids: list[list[str]] = []
            for first, last, data, offsets in utf8_slices(batch.column(batch.schema.get_field_index(text))):
                low, starts, ends, hashes = words_of(data, offsets)
                bounds = np.searchsorted(starts, offsets)
                found: dict[int, tuple[list, set]] = defaultdict(lambda: ([], set()))
                for searcher in searchers:
                    for word, number in searcher.find(low, starts, ends, hashes, bounds):
                        row = int(np.searchsorted(bounds, word, "right")) - 1
                        own = word - int(bounds[row])
                        found[row][0].append((own, own + searcher.length))
                        found[row][1].update(owners[number])
                n_words += np.diff(bounds).tolist()
                for row in range(last - first):
                    hits, who = found.get(row, ((), ()))
                    spans.append([{"s": s, "e": e} for s, e in _joined(hits)])
                    ids.append(sorted(who))
            new = [pa.array(n_words, pa.int64()), pa.array(spans, span_type), pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema=pa.schema([*batch.schema, pa.field("n_words", pa.int64()), pa.field(name, span_type), pa.field("items", pa.list_(pa.string()))]))

    return docs.mapInArrow(run, schema)


def _joined(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


