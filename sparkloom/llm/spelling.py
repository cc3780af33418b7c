"""Spelling variants: words one edit apart, and the common word that a rare one is a form of.

1. Runs of letters are counted over all texts; the words of the vocabulary are those long and frequent enough.
2. The vocabulary goes to blocked Bloom filters: blocks of 64 bits, a share of the blocks for each word length.  The blocks of all lengths
   lie in one row of blocks, which is cut into rounds of ``ROUND`` blocks.  A round is broadcast, so a broadcast has 32 MB at
   most; larger vocabularies take more rounds.
3. Every word generates the edits that make it shorter by a letter, or put a smaller letter in a place (the other edits are these,
   seen from the other word), by their hashes: a hash of powers changes by one term.  Edits that a filter has go on, as fixed-size rows.
4. They join the vocabulary by the hash, and the words themselves are compared, which leaves no false positive.  Pairs are then read both ways.

Nulls and odd input: a null text has no words; a null id is written as nothing where ids are hashed; repeated rows and ids count as
rows; ties of the most frequent near word go to the smaller one; texts are read in parts of some MB, parted where no letter is, and long
words edit by edit; other columns aren't looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import POWERS, checkpointed, mix, small_batches, utf8_slices, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: What a letter can be once A to Z are lower-cased; all are single bytes in Latin-1.
LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], np.int64)
#: Filter bits for each word, bits set by a word, blocks of a filter piece and of a round.
BITS, SET, PIECE, ROUND = 20, 4, 1 << 14, 1 << 22
#: Lengths from here on share a filter.
LONGEST = 64
#: Distinct words that a task counts at a time; letters whose edits it looks at together.
WORDS, LOOK = 200_000, 1 << 17
PART_BYTES = 4 << 20
NO_LETTER = re.compile(rb"[\x00-\x40]")


def parts(raw: bytes) -> Iterator[str]:
    """A text, A to Z in lower case, in parts that don't cut runs of letters."""
    raw = raw.lower()  # bytes: A to Z only
    at = 0
    while at < len(raw):
        cut = NO_LETTER.search(raw, at + PART_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].decode("utf-8", "replace")
        at = end


def count_runs(docs: DataFrame, *, drop_of: int | None, min_length: int, min_count: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): lower-cased runs of letters of at least so many letters and occurrences.

    drop_of: one in so many (document, run) pairs, by a hash, loses a letter first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def leave() -> Iterator[pa.RecordBatch]:
            words, n = list(found), list(found.values())
            for at in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(words[at : at + (1 << 16)], pa.string()), pa.array(n[at : at + (1 << 16)], pa.int64())], names=["word", "n"])
            found.clear()

        for batch in batches:
            ids = [crc32(f"{'' if x is None else x}:".encode()) for x in batch.column(0).to_pylist()]
            for first, _, data, offsets in utf8_slices(batch.column(1)):
                for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    for part in parts(data[s:e].tobytes()):
                        for word, n in Counter(RUN.findall(part)).items():
                            if drop_of:
                                h = crc32(word.encode(), ids[first + k])
                                if h % drop_of == 0:
                                    p = h % len(word)
                                    word = word[:p] + word[p + 1 :]
                            if len(word) >= min_length:
                                found[word] += n
                        if len(found) > WORDS:
                            yield from leave()
        yield from leave()

    rows = docs.select(F.col(id_column).cast("string"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Words:
    """The letters of a batch of words, one after another, and the words' hashes."""

    def __init__(self, words: list[str]) -> None:
        raw = [w.encode("latin-1") for w in words]
        self.lengths = np.array([len(x) for x in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        self.row = np.repeat(np.arange(len(raw)), self.lengths)
        self.place = np.arange(len(self.letters)) - self.starts[self.row]
        self.up, self.down = POWERS.upto(int(self.lengths.max(initial=1)) + 1)
        self.terms = (self.letters + 1).astype(np.uint64) * self.up[self.place]
        self.before = np.cumsum(self.terms) - self.terms  # modulo 2**64
        self.hashes = np.add.reduceat(self.terms, self.starts) if len(raw) else np.zeros(0, np.uint64)

    def edits(self, s: int, e: int, min_length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, str]]:
        """(index into letters, hash of the edited word, its length, letter put there) of the edits at letters s to e."""
        letters, row = self.letters[s:e], self.row[s:e]
        for c in LETTERS.tolist():
            at = np.flatnonzero(letters > c)
            if len(at):
                t = at + s
                yield t, self.hashes[row[at]] - (letters[at] - c).astype(np.uint64) * self.up[self.place[t]], self.lengths[row[at]], chr(c)
        # of a run of equal letters only the first is taken out
        t = np.arange(s, e)
        t = t[((self.place[t] == 0) | (self.letters[t] != self.letters[t - 1])) & (self.lengths[row] > min_length)]
        r = self.row[t]
        left = self.before[t] - self.before[self.starts[r]]
        yield t, left + (self.hashes[r] - left - self.terms[t]) * self.down[1], self.lengths[r] - 1, ""


class Places:
    """Where words lie in the row of blocks: each length has blocks of its own, LONGEST and above share theirs."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.blocks = np.array([-(-counts.get(k, 0) * BITS // 64) for k in range(LONGEST + 1)], np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.blocks.astype(np.int64))])
        self.total = int(self.starts[-1])

    def of(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, bits in it) of each hash; block -1 for lengths that no word has."""
        k = np.minimum(lengths, LONGEST)
        m = mix(hashes)
        block = self.starts[k] + ((m >> np.uint64(32)) * self.blocks[k] >> np.uint64(32)).astype(np.int64)
        bits = np.zeros(len(m), np.uint64)
        for i in range(SET):
            bits |= np.uint64(1) << (m >> np.uint64(6 * i) & np.uint64(63))
        return np.where(self.blocks[k] > 0, block, -1), bits


def filter_pieces(words: DataFrame, places: Places) -> DataFrame:
    """(piece, bits): the filters' blocks in pieces of PIECE."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = places.of(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(block // PIECE), pa.array(block % PIECE), pa.array(bits.view(np.int64))], names=["piece", "block", "bits"])

    def build(group: pa.Table) -> pa.Table:
        blocks = np.zeros(PIECE, np.uint64)
        np.bitwise_or.at(blocks, group["block"].to_numpy(), group["bits"].to_numpy().view(np.uint64))
        return pa.table({"piece": group["piece"][:1], "bits": pa.array([blocks.tobytes()], pa.binary())})

    rows = words.select("h", "length").mapInArrow(place, "piece long, block long, bits long")
    return rows.groupBy("piece").applyInArrow(build, "piece long, bits binary")


def probe(words: DataFrame, places: Places, first: int, blocks, min_length: int) -> DataFrame:
    """(h, near, place, letter): edits of the words that the filter's blocks from ``first`` on have; blocks: a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(blocks.value, np.uint64)
        for batch in batches:
            words = Words(batch.column(0).to_pylist())
            for s in range(0, len(words.letters), LOOK):
                found = []
                for t, hashes, lengths, letter in words.edits(s, min(s + LOOK, len(words.letters)), min_length):
                    block, bits = places.of(hashes, lengths)
                    here = (block >= first) & (block < first + len(known))
                    hit = np.flatnonzero(here)
                    hit = hit[known[block[hit] - first] & bits[hit] == bits[hit]]
                    if len(hit):
                        found.append((words.hashes[words.row[t[hit]]], hashes[hit], words.place[t[hit]], np.full(len(hit), letter, object)))
                if found:
                    h, near, place, letter = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(near.view(np.int64)), pa.array(place), pa.array(letter, pa.string())], names=["h", "near", "place", "letter"])

    return words.select("word").mapInArrow(run, "h long, near long, place long, letter string")


def hashed(words: DataFrame) -> DataFrame:
    """words (word, n) with their length and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(w.lengths), pa.array(w.hashes.view(np.int64))], names=["word", "n", "length", "h"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, length long, h long")


def near_words(words: DataFrame, *, min_length: int = 6) -> DataFrame:
    """(word, n, other, other_n), once for each pair of words that differ by one letter put in, taken out or replaced.

    words: what ``hashed`` gives, each word once; words of fewer letters than ``min_length`` aren't in it."""
    spark = words.sparkSession
    counts = {r["k"]: r["n"] for r in words.groupBy(F.least("length", F.lit(LONGEST)).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}  # LONGEST rows at most
    places = Places(counts)
    pieces = checkpointed(filter_pieces(words, places))
    dealt = words.repartition(max(1, sum(counts.values()) // 5000), "h")  # the edits of a few thousand words are a task's work
    found = None
    for first in range(0, places.total, ROUND):
        blocks = np.zeros(min(ROUND, places.total - first), np.uint64)
        for r in pieces.where(F.col("piece").between(first // PIECE, (first + ROUND) // PIECE - 1)).toLocalIterator():
            at = r["piece"] * PIECE - first
            blocks[at : at + PIECE] |= np.frombuffer(r["bits"], np.uint64)[: len(blocks) - at]
        shared = spark.sparkContext.broadcast(blocks.tobytes())  # 8 * ROUND bytes at most
        some = written(probe(dealt, places, first, shared, min_length))
        shared.destroy()
        found = some if found is None else found.union(some)
    if found is None:
        found = spark.createDataFrame([], "h long, near long, place long, letter string")
    # equal rows come from words of equal hash only
    found = found.repartition("near").dropDuplicates(["near", "h", "place", "letter"])
    found = found.join(words.select(F.col("h").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n")), "near")
    found = found.join(words.select("h", "word", "n"), "h")
    edited = F.concat(F.substr("word", F.lit(1), F.col("place").cast("int")), F.col("letter"), F.substr("word", F.col("place").cast("int") + 2))
    return found.where(edited == F.col("other")).select("word", "n", "other", "other_n")


def roots(forms: DataFrame, depth: int) -> DataFrame:
    """(word, root) of forms (word, form): the word at the end of a word's forms, which are ``depth`` steps at most."""
    out = checkpointed(forms.select("word", F.col("form").alias("root")))
    steps = 1
    while steps < depth:
        ahead = out.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        out = checkpointed(out.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
        steps *= 2
    return out


def variants(docs: DataFrame, *, min_length: int = 6, min_count: int = 5, ratio: int = 5, drop_of: int | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of so many letters and occurrences.

    form: the most frequent of the words one edit away, if it occurs ``ratio`` (2 or more) times as often; root: the last of its forms."""
    if ratio < 2:
        raise ValueError("a form is more frequent than the word")
    small_batches(docs.sparkSession)
    counted = count_runs(docs, drop_of=drop_of, min_length=min_length, min_count=min_count, id_column=id_column, text=text)
    words = written(hashed(counted))
    pairs = written(near_words(words, min_length=min_length))
    both = pairs.select("word", "other", "other_n").union(pairs.select("other", "word", "n"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    most = F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.n")).alias("n")))
    named = written(words.select("word", "n").join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), most["form"].alias("form"), most["n"].alias("form_n")))
    largest = words.agg(F.max("n")).first()[0] or 1
    depth = next(k for k in range(1, 65) if min_count * ratio**k > largest)  # each form occurs ratio times as often
    ends = roots(named.where("form is not null"), depth)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
