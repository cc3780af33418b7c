"""Phrases whose words stand together more often than their parts would have it, counted in quotient filters.

1. Words are counted for each language.  From the number of words follows the width of a word id: ids are so many bits of a
   hash of the word within its language, wide enough that few words clash.  Words that clash with a frequent one get
   numbers of their own instead (their list is counted before it goes to the tasks), so ids of frequent words are
   unique and counts exact.
2. Tasks turn texts to ids and pack the ids of each n-gram into one key of ``longest`` times that width.  An invertible
   permutation spreads the keys.  Its leading bits, the quotient, are the place in a filter; the rest, the remainder, is kept in full,
   so the counters are lossless.  A filter is written as sorted runs: for each place how many entries it has, in unary,
   then the bytes of the remainders and of the counts.
3. Filters are cut into shards by leading bits of the quotient.  A shard's filters of all tasks meet and are merged; the number of shards
   follows from the number of words, and a frequent n-gram is one entry in each filter, so no shard grows with a hot word.
4. Entries with the wanted count are turned back into word ids; words and parts join to them.

Nulls and odd input: a null text has no words; a null language is ``und``; repeated rows and null or repeated ids count as
rows, ids and other columns aren't looked at; long texts are read in parts of some MB, except that a word is never parted; ties are
told apart by the phrase; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import mix, small_batches, utf8_slices, written

#: Entries and counted n-grams that a task holds at most, and that a shard is meant to have.
HELD, BLOCK, SHARD = 1_500_000, 1 << 18, 2_000_000
#: Words that may get a number in place of their hash; ids are made wide enough that a few thousand are expected.
MOST_CLASHES, EXPECTED_CLASHES = 1 << 20, 1 << 12
#: Salts of the first of two rankings within a language.
SALTS = 32
#: Distinct words that a task remembers at a time.
WORDS = 200_000
PART_BYTES = 4 << 20
BREAK = b"\xff"  # stands in no UTF-8 text
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
ODD = 0x9E3779B97F4A7C15


def tokens(raw: bytes) -> Iterator[list[bytes]]:
    """Lists of the words of a text in order, with BREAK between pieces; a long text comes in several lists."""
    raw = raw.lower().translate(BREAKS)  # bytes: A to Z only
    at = 0
    while at < len(raw):
        end = at + PART_BYTES
        while end < len(raw) and raw[end] not in b" \t\xff":
            end += 1
        yield raw[at:end].replace(BREAK, b" \xff ").split()
        at = end


def texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    """(text, language) of the rows of a batch of these two columns."""
    langs = [b"und" if x is None else x.encode() for x in batch.column(1).to_pylist()]
    for first, _, data, offsets in utf8_slices(batch.column(0)):
        for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            yield data[s:e].tobytes(), langs[first + k]


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n): occurrences of each word in each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, Counter] = {}

        def leave() -> Iterator[pa.RecordBatch]:
            for name, counts in found.items():
                counts.pop(BREAK, None)
                words, n = list(counts), list(counts.values())
                for at in range(0, len(words), 1 << 16):
                    part = words[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.binary()), pa.array(part, pa.binary()), pa.array(n[at : at + (1 << 16)], pa.int64())], names=["lang", "word", "n"])
            found.clear()

        for batch in batches:
            for raw, name in texts(batch):
                counts = found.setdefault(name, Counter())
                for words in tokens(raw):
                    counts.update(words)
                    if sum(map(len, found.values())) > WORDS:
                        yield from leave()
                        counts = found.setdefault(name, Counter())
        yield from leave()

    rows = docs.select(F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(run, "lang binary, word binary, n long")
    rows = rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return rows.select(F.col("lang").cast("string").alias("lang"), F.col("word").cast("string").alias("word"), "n")


def width_of(words: int, frequent: int, longest: int) -> int:
    """Bits of a word id so that few words are expected to clash with a frequent one."""
    need = 2 * max(words, 1) * max(frequent, 1) // EXPECTED_CLASHES
    return min(max(need.bit_length() + 1, 16), 126 // longest)


def word_id(lang: Column | str, word: Column | str, width: int) -> Column:
    """The id of a word that clashes with no frequent one: its first bit is set."""
    return F.shiftrightunsigned(F.xxhash64(lang, word), 65 - width).bitwiseOR(F.lit(1 << (width - 1)))


class WordIds(dict):
    """Ids of the words of one language, made when first asked for; BREAK is 0."""

    def __init__(self, lang: bytes, width: int, numbers: dict[bytes, int]) -> None:
        super().__init__(numbers)
        self.numbers, self.seed, self.shift, self.top = numbers, xxhash.xxh64_intdigest(lang, 42), 65 - width, 1 << (width - 1)
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS + len(self.numbers):
            self.clear()
            self.update(self.numbers)
            self[BREAK] = 0
        out = self[word] = xxhash.xxh64_intdigest(word, self.seed) >> self.shift | self.top
        return out


class Packing:
    """Keys of n-grams: up to ``longest`` ids of ``width`` bits (0 behind the last), as two numbers of ``high`` and ``low`` bits, permuted."""

    def __init__(self, width: int, longest: int) -> None:
        self.width, self.longest, bits = width, longest, width * longest
        self.low = min(64, max(8, -8 * (-(bits - 60) // 8)))
        self.high = bits - self.low
        self.ones = [np.uint64((1 << b) - 1) for b in (self.high, self.low)]
        self.fold = np.uint64((self.high + 1) // 2)
        self.odd, self.even = np.uint64(ODD & ((1 << self.high) - 1)), np.uint64(pow(ODD, -1, 1 << self.high))

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Columns of ids, first to last, as (high, low)."""
        high, low = np.zeros((2, len(ids[0])), np.uint64)
        at = 0  # from the low end
        for x in reversed(ids):
            if at < self.low:
                low |= (x << np.uint64(at)) & self.ones[1]
            if at + self.width > self.low:
                high |= x >> np.uint64(self.low - at) if at < self.low else x << np.uint64(at - self.low)
            at += self.width
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        out, at, one = [], 0, np.uint64((1 << self.width) - 1)
        for _ in range(self.longest):
            x = np.zeros(len(low), np.uint64)
            if at < self.low:
                x |= low >> np.uint64(at)
            if at + self.width > self.low:
                x |= high << np.uint64(self.low - at) if at < self.low else high >> np.uint64(at - self.low)
            out.append(x & one)
            at += self.width
        return out[::-1]

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in range(3):
            high = high * self.odd & self.ones[0]
            high = high ^ (high >> self.fold)
            low = low ^ (mix(high + np.uint64(k)) & self.ones[1])
            high = high ^ (mix(low + np.uint64(k + 7)) & self.ones[0])
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(range(3)):
            high = high ^ (mix(low + np.uint64(k + 7)) & self.ones[0])
            low = low ^ (mix(high + np.uint64(k)) & self.ones[1])
            high = high ^ (high >> self.fold)
            high = high * self.even & self.ones[0]
        return high, low


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # high, low and count, in the order of (high, low), each key once


def summed(high: np.ndarray, low: np.ndarray, n: np.ndarray | None = None) -> Entries:
    """Entries of keys in any order; a key counts n, or 1."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    order = np.argsort(high, kind="stable" if n is not None else None)  # filters are runs already in order
    a, b = high[order], low[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():
        order = np.lexsort((low, high))
        a, b = high[order], low[order]
        same = a[1:] == a[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~(same & (b[1:] == b[:-1]))]))
    counts = np.diff(first, append=len(a)) if n is None else np.add.reduceat(n[order], first)
    return a[first], b[first], counts.astype(np.int64)


def merged(filters: list[Entries]) -> Entries:
    """Entries of sorted filters, equal keys added up."""
    return filters[0] if len(filters) == 1 else summed(*(np.concatenate(x) for x in zip(*filters, strict=True)))


def _planes(x: np.ndarray, bits: int) -> bytes:
    """The lowest bytes that so many bits need, of each number."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


def _numbers(raw: bytes, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, : (bits + 7) // 8] = np.frombuffer(raw, np.uint8).reshape(n, (bits + 7) // 8)
    return out.view("<u8").ravel().astype(np.uint64)


def encode(entries: Entries, shard_bits: int, packing: Packing) -> bytes:
    """A shard's filter: the number of entries, how many have each quotient (in unary), remainders, counts.

    The quotient has so many bits beyond the shard's that there are about as many places as entries."""
    high, low, n = entries
    q = min(max(len(high) - 1, 1).bit_length(), packing.high - shard_bits)
    rest = packing.high - shard_bits - q
    places = ((high >> np.uint64(rest)) & np.uint64((1 << q) - 1)).astype(np.int64)
    unary = np.zeros(len(high) + (1 << q), bool)
    unary[places + np.arange(len(high))] = True
    small, large = np.minimum(n, 255).astype(np.uint8), n[n >= 255]
    parts = [np.array([len(high), q], "<u4").tobytes(), np.packbits(unary).tobytes(), _planes(high & np.uint64((1 << rest) - 1), rest), _planes(low, packing.low), small.tobytes(), large.astype("<i8").tobytes()]
    return b"".join(parts)


def decode(raw: bytes, shard: int, shard_bits: int, packing: Packing) -> Entries:
    size, q = (int(x) for x in np.frombuffer(raw, "<u4", 2))
    rest = packing.high - shard_bits - q
    at = 8
    lengths = ((size + (1 << q) + 7) // 8, size * ((rest + 7) // 8), size * ((packing.low + 7) // 8), size)
    unary, high, low, small = (raw[at + sum(lengths[:i]) : at + sum(lengths[: i + 1])] for i in range(4))
    large = np.frombuffer(raw, "<i8", offset=at + sum(lengths))
    places = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8))) - np.arange(size)
    n = np.frombuffer(small, np.uint8).astype(np.int64)
    n[n == 255] = large
    top = (np.uint64(shard) << np.uint64(q)) | places.astype(np.uint64) if shard_bits else places.astype(np.uint64)
    return _numbers(high, size, rest) | top << np.uint64(rest), _numbers(low, size, packing.low), n


def ngram_keys(ids: np.ndarray, seen: int, packing: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys of the n-grams of 2 to ``longest`` ids that end behind the first ``seen`` ids and hold no 0."""
    none = np.zeros(len(ids), np.uint64)
    found = []
    whole = ids != 0
    for k in range(2, packing.longest + 1):
        whole = whole[1:] & (ids[: len(ids) - k + 1] != 0) if k > 2 else whole[1:] & whole[:-1]
        starts = np.flatnonzero(whole)
        starts = starts[starts + k > seen]
        found.append(packing.pack([ids[starts + i] for i in range(k)] + [none[: len(starts)]] * (packing.longest - k)))
    return packing.permute(*(np.concatenate(x) for x in zip(*found, strict=True)))


def count_ngrams(docs: DataFrame, packing: Packing, shard_bits: int, least: int, numbers: dict[str, dict[bytes, int]], text: str = "text", lang: str = "lang") -> DataFrame:
    """(i1, i2, ..., a): ids of the words of each n-gram that occurs ``least`` times or more (0 behind its last), and how often it does."""
    longest = packing.longest

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, WordIds] = {}
        waiting: list[Entries] = []  # each at most half as long as the one before it
        ids: list[int] = []
        seen = 0

        def add() -> None:
            nonlocal ids, seen
            if len(ids) > seen:
                waiting.append(summed(*ngram_keys(np.array(ids, np.uint64), seen, packing)))
            while len(waiting) > 1 and 2 * len(waiting[-1][0]) > len(waiting[-2][0]):
                waiting.append(merged([waiting.pop(), waiting.pop()]))
            ids = ids[-(longest - 1) :]
            seen = len(ids)

        def leave() -> Iterator[pa.RecordBatch]:
            if waiting:
                high, low, n = merged(waiting)
                waiting.clear()
                shards = (high >> np.uint64(packing.high - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(high), np.int64)
                cuts = np.flatnonzero(np.diff(shards, prepend=-1)).tolist() if len(high) else []
                rows, size = [], 0
                for s, e in zip(cuts, [*cuts[1:], len(high)], strict=False):
                    rows.append((int(shards[s]), encode((high[s:e], low[s:e], n[s:e]), shard_bits, packing)))
                    size += len(rows[-1][1])
                    if size > PART_BYTES or e == len(high):
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "entries"])
                        rows, size = [], 0

        for batch in batches:
            for raw, name in texts(batch):
                if name not in words:
                    if len(words) > 64:  # however many languages there are
                        words.clear()
                    words[name] = WordIds(name, packing.width, numbers.get(name.decode(), {}))
                known = words[name]
                ids.append(0)
                for part in tokens(raw):
                    ids += map(known.__getitem__, part)
                    if len(ids) >= BLOCK:
                        add()
                        if sum(len(x[0]) for x in waiting) > HELD:
                            yield from leave()
        add()
        yield from leave()

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merges the filters of one shard after another; rows come in the order of the shards."""
        now, waiting = -1, []

        def leave() -> pa.RecordBatch:
            high, low, n = merged(waiting)
            often = n >= least
            columns = [*packing.unpack(*packing.restore(high[often], low[often])), n[often]]
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=[*(f"i{k + 1}" for k in range(longest)), "a"])

        for batch in batches:
            for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shard != now and waiting:
                    yield leave()
                    waiting = []
                now = shard
                waiting.append(decode(raw.as_py(), shard, shard_bits, packing))
                while len(waiting) > 1 and 2 * len(waiting[-1][0]) > len(waiting[-2][0]):
                    waiting.append(merged([waiting.pop(), waiting.pop()]))
        if waiting:
            yield leave()

    rows = docs.select(F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(fill, "shard int, entries binary")
    rows = rows.repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(unite, ", ".join(f"i{k + 1} long" for k in range(longest)) + ", a long")


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly for counts of up to 15 digits."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(l) * wide(r))


def first_of(rows: DataFrame, keys: list[str], order: list[Column], n: int, salt: Column) -> DataFrame:
    """The first n rows of each key with their ``rank``; ranked within each salt first, so that a hot key isn't ranked in one task."""
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))).where(F.col("rank") <= n).drop("rank", "_salt")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= n)


def mine(docs: DataFrame, *, least: int = 10, top: int = 2000, longest: int = 3, held_percent: int = 50, text: str = "text", lang: str = "lang", width: int | None = None, shard: int = SHARD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` (2 or 3) words.

    a: the phrase's count, l and r: those of its parts at the cut with the least score, n: all words of the language.  Phrases counted
    less than ``least`` times, and those whose words lie in a longer one with ``held_percent`` of their count, aren't listed.

    width: bits of a word id, to be chosen by the number of words if not given."""
    if longest not in (2, 3):
        raise ValueError("phrases have 2 or 3 words at most")
    small_batches(docs.sparkSession)
    words = written(count_words(docs, text, lang))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    size = words.agg(F.count("*").alias("words"), F.count_if(F.col("n") >= least).alias("frequent"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    width = width or width_of(size["words"], size["frequent"], longest)
    packing = Packing(width, longest)
    shard_bits = max(0, ((longest - 1) * size["n"] // shard).bit_length())

    known = words.withColumn("id", word_id("lang", "word", width))
    clashes = known.groupBy("id").agg(F.count("*").alias("c"), F.max("n").alias("most")).where((F.col("c") > 1) & (F.col("most") >= least))
    listed = known.join(clashes, "id", "left_semi").orderBy("lang", "word").limit(MOST_CLASHES + 1).select("lang", "word").collect()
    if len(listed) > min(MOST_CLASHES, (1 << (width - 1)) - 1):
        raise ValueError(f"too many words clash in ids of {width} bits")
    numbers: dict[str, dict[bytes, int]] = {}
    for k, r in enumerate(listed):
        numbers.setdefault(r["lang"], {})[r["word"].encode()] = k + 1
    given = docs.sparkSession.createDataFrame([(r["lang"], r["word"], k + 1) for k, r in enumerate(listed)], "lang string, word string, number long")
    frequent = known.where(F.col("n") >= least).join(F.broadcast(given), ["lang", "word"], "left").select(F.coalesce("number", "id").alias("id"), "lang", "word", F.col("n").alias("f"))  # MOST_CLASHES rows at most

    counted = written(count_ngrams(docs, packing, shard_bits, least, numbers, text, lang))
    one = lambda k: frequent.select(F.col("id").alias(f"i{k}"), *(["lang"] if k == 1 else []), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))
    pairs = counted if longest == 2 else counted.where("i3 = 0").drop("i3")
    pairs = written(pairs.join(one(1), "i1").join(one(2), "i2"))
    found = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "i1", "i2")
    if longest == 3:
        triples = counted.where("i3 <> 0")
        front = pairs.select("lang", "i1", "i2", "w1", "w2", "f1", F.col("a").alias("a12"))
        back = pairs.select(F.col("i1").alias("i2"), F.col("i2").alias("i3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("a23"))
        triples = triples.join(front, ["i1", "i2"]).join(back, ["i2", "i3"])
        cuts = triples.withColumns({"s1": score(F.col("a"), F.col("f1"), F.col("a23")), "s2": score(F.col("a"), F.col("a12"), F.col("f3"))})
        second = F.col("s2") < F.col("s1")
        longer = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(second, F.col("a12")).otherwise(F.col("f1")).alias("l"), F.when(second, F.col("f3")).otherwise(F.col("a23")).alias("r"))
        holders = counted.where("i3 <> 0").select(F.explode(F.array(F.struct("i1", "i2"), F.struct(F.col("i2").alias("i1"), F.col("i3").alias("i2")))).alias("p"), "a")
        holders = holders.groupBy("p.i1", "p.i2").agg(F.max("a").alias("holder"))
        found = found.join(holders, ["i1", "i2"], "left").where(F.coalesce(100 * F.col("holder") < held_percent * F.col("a"), F.lit(True)))
        found = found.drop("i1", "i2", "holder").union(longer)
    scored = found.drop("i1", "i2").withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    first = first_of(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, F.xxhash64("phrase"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
