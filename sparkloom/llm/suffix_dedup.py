"""Repeated passages, found with suffix arrays and longest-previous-factor arrays.

A passage is a string of ``length`` bytes.  The corpus is dealt out so that equal passages meet: each passage has
an anchor, the ``gram``-byte string in it with the smallest hash (the first one of equals), which depends on
the passage's bytes alone; consecutive starts with the same anchor form a run, and all places where a passage
stands lie in runs of one anchor.

1. Every text gives its runs: anchor hash, hash of the run's bytes, place.  About one row for 170 bytes.
2. Anchors that occur once are dropped.  Runs that are equal byte for byte fall together to the first of them and
   their number, before anything is gathered, so that many copies of a text are one run.
3. The bytes of the runs left are fetched from their texts and grouped by anchor.  A task takes some groups at a
   time, sorts the suffixes at the runs' starts up to ``length`` bytes (prefix doubling), finds for each suffix the
   previous and next one in suffix order that stands earlier in the corpus, and takes the longer of the two matches:
   the longest previous factor.  The same with later places gives the longest later factor.
4. A start whose factor reaches ``length`` is repeated; the ranges go back to all runs that equal the one
   judged, and to the texts.

An anchor with more than ``crowd`` different runs (a line that very many texts share, each in other
surroundings) isn't gathered as it is.  Its runs are cut to spans of starts at fixed distances from the anchor,
and the bytes that all passages of a span share, up to ``length`` of them, become a longer anchor.  Such anchors go through
steps 2 to 4 in turn; spans shrink until, at one start, equal anchors are equal passages and fall together.

Texts count as their UTF-8 bytes; nulls are empty; passages don't cross texts.  Order for ``keep="first"`` is the
id's, and then the place.  Rows whose ids are null or repeated are told apart by a row number on a checkpointed copy
of the table.  Very long texts are looked at in overlapping parts.  An empty table gives an empty result; columns other
than the id and the text are not in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import checkpointed, prefix_sums, span_hashes, utf8_slices, written

#: Places of packed keys: a chunk has fewer than 2**PLACE_BITS bytes.
PLACE_BITS = 20
CHUNK_BYTES = 1 << 19
#: Bytes that the first ranks stand for; five and a place fill a 64-bit key.
FIRST = 5
#: Starts of a very long text that are looked at together.
STARTS = 1 << 21


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of keys[i : i + width] for each i, by doubling."""
    n, have = len(keys) - width + 1, 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    return np.minimum(keys[:n], keys[width - have : width - have + n]) if have < width else keys[:n]


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """row, anchor place, first start, last start (within the row), anchor hash, run hash; a row for each run."""
    sizes = np.diff(offsets)
    if len(data) < length or not (sizes >= length).any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int32, np.uint64, np.uint64))
    prefix = prefix_sums(data.astype(np.uint64) + np.uint64(1))
    place = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix, place, place + gram)
    keys = (hashes >> np.uint64(24) << np.uint64(24)) | place.astype(np.uint64)
    anchor = (sliding_least(keys, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(len(anchor), bool)  # starts of passages that end in their row
    for s, e in zip(offsets[:-1][sizes >= length].tolist(), offsets[1:][sizes >= length].tolist(), strict=True):
        inside[s : e - length + 1] = True
    starts = np.flatnonzero(inside)
    row = np.searchsorted(offsets, starts, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (anchor[starts][1:] != anchor[starts][:-1]) | (row[1:] != row[:-1])]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    row, at = row[new], anchor[starts[new]]
    raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    run = [digest(raw[a : b + length], p - a) for a, b, p in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)]
    base = offsets[row]
    return row, (at - base).astype(np.int32), (first - base).astype(np.int32), (last - base).astype(np.int32), hashes[at], np.array(run, np.uint64)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row added, place added, bytes, offsets): a very long text in parts that overlap by length - 1 bytes."""
    if len(offsets) > 2 or len(data) <= STARTS + length:
        yield 0, 0, data, offsets
        return
    for at in range(0, len(data) - length + 1, STARTS):
        part = data[at : at + STARTS + length - 1]
        yield 0, at, part, np.array([0, len(part)])


def repeats(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of every text: row, pos, lo, hi (int), h, fp (long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, _, data, offsets in utf8_slices(batch.column(1)):
                for _, moved, part, bounds in pieces(data, offsets, length):
                    row, pos, lo, hi, h, fp = runs_of(part, bounds, length, gram)
                    if len(row):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(row + first)), *(pa.array(x + np.int32(moved)) for x in (pos, lo, hi)), pa.array(h.view(np.int64)), pa.array(fp.view(np.int64))], names=["row", "pos", "lo", "hi", "h", "fp"])

    return rows.mapInArrow(run, "row long, pos int, lo int, hi int, h long, fp long")


class SuffixOrder:
    """Suffixes at chosen starts of a text made of parts, in order of their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int) -> None:
        """ends: for each byte, the end of its part.  Each start has at least ``length`` bytes before that."""
        n, bits = len(data), np.uint64(PLACE_BITS)
        place, mask = np.arange(n, dtype=np.uint64), np.uint64((1 << PLACE_BITS) - 1)
        padded = np.concatenate([data, np.zeros(FIRST, np.uint8)]).astype(np.uint64)
        word = np.zeros(n, np.uint64)
        for i in range(FIRST):
            word = word << np.uint64(8) | padded[i : n + i]
        self.levels: list[tuple[int, np.ndarray]] = [(FIRST, self._ranks(np.sort(word << bits | place), bits, mask, n))]
        have = FIRST
        while 2 * have < length:
            rank = self.levels[-1][1].astype(np.uint64)
            then = np.zeros(n, np.uint64)
            then[: n - have] = rank[have:]
            # a rank whose bytes reach over the end of a part belongs to no suffix asked for
            self.levels.append((2 * have, self._ranks(np.sort(rank << (bits + bits) | then << bits | place), bits, mask, n)))
            have *= 2
        self.length, self.starts = length, starts
        rank = self.levels[-1][1].astype(np.uint64)
        keys = np.sort(rank[starts] << (bits + bits) | rank[starts + (length - have)] << bits | np.arange(len(starts), dtype=np.uint64))
        #: indices of starts in suffix order
        self.order = (keys & mask).astype(np.int64)

    @staticmethod
    def _ranks(keys: np.ndarray, bits: np.uint64, mask: np.uint64, n: int) -> np.ndarray:
        value = keys >> bits
        rank = np.empty(n, np.int32)
        rank[(keys & mask).astype(np.int64)] = np.concatenate([[0], np.cumsum(value[1:] != value[:-1], dtype=np.int32)])
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at bytes a and b: exactly ``length`` where they agree so far,
        else rounded down to a multiple of ``FIRST``."""
        far = np.zeros(len(a), np.int64)
        for size, rank in [self.levels[-1], *reversed(self.levels)]:  # the largest may fit twice
            fits = np.flatnonzero(far + size <= self.length)
            p, q = a[fits] + far[fits], b[fits] + far[fits]
            far[fits[rank[p] == rank[q]]] += size
        near = np.flatnonzero((far < self.length) & (far + FIRST > self.length))
        first = self.levels[0][1]
        tail = self.length - FIRST
        far[near[first[a[near] + tail] == first[b[near] + tail]]] = self.length
        return far

    def nearest(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix in order, the nearest one before and after it in order whose ``place`` is smaller, -1: none.

        Pointers start at the neighbour and jump over what is known to be larger, all at once."""
        out = []
        for values in (place, place[::-1]):
            n = len(values)
            values = np.concatenate([values, [np.iinfo(np.int64).min]])  # index n, and -1, end every chain
            pointer = np.arange(-1, n)
            pointer[n] = -1
            live = np.arange(n)
            while len(live := live[values[pointer[live]] > values[live]]):
                pointer[live] = pointer[pointer[live]]
            out.append(pointer[:n])
        after = len(place) - 1 - out[1][::-1]
        after[after == len(place)] = -1
        return out[0], after

    def previous_factors(self, later: bool = False) -> np.ndarray:
        """For each start: the longest match, up to ``length``, with an earlier (or later) start."""
        at = self.starts[self.order]
        before, after = self.nearest(-at if later else at)
        best = np.zeros(len(at), np.int64)
        for pointer in (before, after):
            has = np.flatnonzero(pointer >= 0)
            best[has] = np.maximum(best[has], self.common(at[has], at[pointer[has]]))
        out = np.empty(len(at), np.int64)
        out[self.order] = best
        return out


def judged(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs given in corpus order within groups: start index of each run's starts, and for each start if its
    passage stands earlier, and if it stands later, in the same chunk."""
    sizes = np.array([len(b) for b in bodies])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    counts = sizes - length + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(bounds[-1]) + np.repeat(edges[:-1] - bounds[:-1], counts)
    suffixes = SuffixOrder(data, np.repeat(edges[1:], sizes), starts, length)
    return bounds, suffixes.previous_factors() >= length, suffixes.previous_factors(later=True) >= length


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def row_numbers(docs: DataFrame, id_column: str) -> tuple[DataFrame, bool]:
    """docs with ``row``, a long that tells rows apart and orders them, and whether it is the id itself."""
    if dict(docs.dtypes)[id_column] in ("bigint", "int", "smallint", "tinyint"):
        seen = docs.groupBy(id_column).count().where(F.col(id_column).isNull() | (F.col("count") > 1))
        if seen.isEmpty():
            return docs.withColumn("row", F.col(id_column).cast("long")).where("row is not null"), True
    return checkpointed(docs.orderBy(id_column).withColumn("row", F.monotonically_increasing_id())).where("row is not null"), False


#: Starts in a span, step by step, where an anchor is met in too many surroundings.
SPANS = (24, 1)
KEY = 0x5DEECE66D
#: Tasks that the runs of one anchor are dealt to.
SALTS = 8
RANGES = "array<struct<a:int,b:int>>"
_RANGE = pa.list_(pa.struct([pa.field("a", pa.int32()), pa.field("b", pa.int32())]))


def _fetch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[dict, int, bytes]]:
    """(run, row, its bytes) of the runs listed with each text."""
    for batch in batches:
        rows, column, runs = (batch.column(i) for i in range(3))
        for i in range(len(rows)):
            raw, row = column[i].as_buffer().to_pybytes() if column[i].is_valid else b"", rows[i].as_py()
            for run in runs[i].as_py():
                yield run, row, raw[run["lo"] : run["hi"] + length]


def _batched(items: Iterator[tuple], names: list[str], types: list[pa.DataType], each: int = 2048) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for x in items:
        block.append(x)
        if len(block) == each:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block, strict=True), types, strict=True)], names=names)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block, strict=True), types, strict=True)], names=names)


def repeated_ranges(rows: DataFrame, *, length: int = 400, gram: int = 64, keep: str = "none", crowd: int = 512) -> DataFrame:
    """rows (row long, text) -> (row, spans: array of (s, e)), the bytes covered by repeated passages, not merged.

    keep="none": every passage that starts at two or more places.  keep="first": such starts but the first one."""
    if not 8 <= gram <= length // 2 or keep not in ("none", "first"):
        raise ValueError("gram must be 8 to half the length, keep none or first")
    crowd = min(crowd, ((1 << PLACE_BITS) - CHUNK_BYTES) // (2 * length) - 1)
    runs = written(repeats(rows.select("row", "text"), length, gram))
    spans = _judged(rows, runs.withColumn("n", F.lit(1).cast("long")), length, gram, keep, crowd, SPANS)
    spans = spans.select("row", "pos", F.inline("own"))
    return spans.groupBy("row").agg(F.collect_list(F.struct((F.col("pos") + F.col("a")).alias("s"), (F.col("pos") + F.col("b") + length).alias("e"))).alias("spans"))


def _judged(rows: DataFrame, runs: DataFrame, length: int, gram: int, keep: str, crowd: int, spans: tuple[int, ...], parents: tuple[str, ...] = ()) -> DataFrame:
    """(row, pos, parents..., own): ranges of repeated starts, from the anchor, of each run that has some.

    runs: row, pos, lo, hi, h, fp, n (equal runs that a row stands for) and the parents' columns.  Runs of texts are
    checkpointed once they are few.  Runs of spans stay in the plan, so that its joins with the texts share one shuffle."""
    top = not parents
    columns = ["row", "pos", "lo", "hi", "n", *parents, F.col("h").bitwiseXOR(F.col("fp")).alias("x"), "fp"]
    if top:
        # the key is changed to and fro, so that Spark deals the join's left side by itself and can split a hot anchor
        often = runs.groupBy(F.col("h").bitwiseXOR(F.lit(KEY)).alias("k")).agg(F.count("*").alias("all")).where("all > 1").select(F.col("k").bitwiseXOR(F.lit(KEY)).alias("h"))
        shared = checkpointed(runs.join(often, "h", "left_semi").select(columns))
    else:
        shared = runs.select(columns)
    # h and fp are told by (x, fp); grouping on these deals the runs of one anchor over many tasks
    distinct = shared.groupBy("x", "fp").agg(F.min(F.struct("row", "pos", "lo", "hi")).alias("r"), F.sum("n").alias("n"))
    distinct = distinct.select(F.col("x").bitwiseXOR(F.col("fp")).alias("h"), "fp", "r.*", "n")
    distinct = checkpointed(distinct) if top else distinct
    groups = distinct.groupBy("h").agg(F.count("*").alias("different"), F.sum("n").alias("all")).where("all > 1").select("h", "different")
    # an anchor's runs may be very many: they meet its counts in SALTS tasks
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
    sized = distinct.withColumn("salt", salt).join(groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["h", "salt"]).drop("salt")
    marks = _by_suffixes(rows, sized.where(F.col("different") <= crowd), length, keep)
    if spans and not (top and groups.where(F.col("different") > crowd).isEmpty()):
        marks = marks.union(_by_spans(rows, sized.where(F.col("different") > crowd), length, gram, keep, crowd, spans))
    marks = marks.select(F.col("h").bitwiseXOR(F.col("fp")).alias("x"), "fp", F.col("row").alias("row0"), F.col("pos").alias("pos0"), "own")
    whole = F.array(F.struct((F.col("lo") - F.col("pos")).alias("a"), (F.col("hi") - F.col("pos")).alias("b")))
    first = (F.col("row") == F.col("row0")) & (F.col("pos") == F.col("pos0"))
    return shared.join(marks, ["x", "fp"]).select("row", "pos", *parents, F.when(first, F.col("own")).otherwise(whole).alias("own")).where(F.size("own") > 0)


def _listed(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Each text with the runs wanted from it; as many as its length allows."""
    wanted = runs.groupBy("row").agg(F.collect_list(F.struct("h", "fp", "n", "pos", "lo", "hi")).alias("runs"))
    return rows.select("row", "text").join(wanted, "row").select("row", "text", "runs")


def _by_suffixes(rows: DataFrame, runs: DataFrame, length: int, keep: str) -> DataFrame:
    """(h, fp, row, pos, own): ranges of repeated starts, from the anchor, of the run judged."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((x["h"], x["fp"], x["n"], row, x["pos"], x["lo"] - x["pos"], body) for x, row, body in _fetch(batches, length))
        yield from _batched(found, ["h", "fp", "n", "row", "pos", "low", "body"], [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def verdicts() -> Iterator[tuple]:
            chunk: list[tuple] = []
            size = 0
            for batch in batches:
                for record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if size >= CHUNK_BYTES and record[0] != chunk[-1][0]:
                        yield from settle(chunk)
                        chunk, size = [], 0
                    chunk.append(record)
                    size += len(record[-1])
            if chunk:
                yield from settle(chunk)

        def settle(chunk: list[tuple]) -> Iterator[tuple]:
            bounds, earlier, later = judged([x[-1] for x in chunk], length)
            for i, (h, fp, n, row, pos, low, _) in enumerate(chunk):
                flags = earlier[bounds[i] : bounds[i + 1]]
                if keep == "none":
                    # a run with equals elsewhere is repeated at all its starts
                    flags = np.ones_like(flags) if n > 1 else flags | later[bounds[i] : bounds[i + 1]]
                own = [{"a": low + a, "b": low + b} for a, b in ranges(flags)]
                if own or n > 1:
                    yield h, fp, row, pos, own

        yield from _batched(verdicts(), ["h", "fp", "row", "pos", "own"], [pa.int64()] * 3 + [pa.int32(), _RANGE])

    bodies = _listed(rows, runs).mapInArrow(fetch, "h long, fp long, n long, row long, pos int, low int, body binary")
    return bodies.repartition("h").sortWithinPartitions("h", "row", "pos").mapInArrow(judge, f"h long, fp long, row long, pos int, own {RANGES}")


def _by_spans(rows: DataFrame, runs: DataFrame, length: int, gram: int, keep: str, crowd: int, spans: tuple[int, ...]) -> DataFrame:
    """As _by_suffixes, for anchors with a crowd of different runs, by longer anchors for spans of their starts."""
    span = spans[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest

        def parts() -> Iterator[tuple]:
            for x, row, body in _fetch(batches, length):
                low, pos = x["lo"], x["pos"]
                for j in range((low - pos + length) // span, (x["hi"] - pos + length) // span + 1):
                    begin = pos - length + j * span  # the span's starts, in the text: begin to begin + span - 1
                    a, b = max(low, begin), min(x["hi"], begin + span - 1)
                    common = body[begin + span - 1 - low : begin + length - low]
                    yield row, pos, a, b, _signed(digest(common, j)), _signed(digest(body[a - low : b + length - low], a - pos & 0xFFFFFFFF)), x["n"], x["h"], x["fp"]

        yield from _batched(parts(), ["row", "pos", "lo", "hi", "h", "fp", "n", "h0", "fp0"], [pa.int64()] + [pa.int32()] * 3 + [pa.int64()] * 5)

    each = _listed(rows, runs).mapInArrow(cut, "row long, pos int, lo int, hi int, h long, fp long, n long, h0 long, fp0 long")
    found = _judged(rows, each, length, gram, keep, crowd, spans[1:], ("h0", "fp0"))
    found = found.select("h0", "fp0", F.explode("own").alias("r")).groupBy("h0", "fp0").agg(F.sort_array(F.collect_list("r")).alias("own"))
    found = found.withColumnsRenamed({"h0": "h", "fp0": "fp"})
    own = F.coalesce("own", F.array().cast(RANGES))
    kept = runs.join(found, ["h", "fp"], "left").where("own is not null or n > 1")
    return kept.select("h", "fp", "row", "pos", own.alias("own"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def remove_repeats(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", length: int = 400, gram: int = 64, keep: str = "none", crowd: int = 512, with_text: bool = False) -> DataFrame:
    """One row per input row: the id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes
    left, joined), removed (array of (s, e)), and with ``with_text`` kept, the text left, without the characters that a cut parts."""
    rows, is_id = row_numbers(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "id")
    spans = repeated_ranges(rows.select("row", "text"), length=length, gram=gram, keep=keep, crowd=crowd)
    chosen = rows.select("row", "text").join(spans, "row", "left").select("row", "text", "spans")
    fields = [("row", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([pa.field("s", pa.int32()), pa.field("e", pa.int32())]))), ("kept", pa.string())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for batch in batches:
                ids, column, spans = (batch.column(i) for i in range(3))
                for i in range(len(ids)):
                    raw = column[i].as_buffer().to_pybytes() if column[i].is_valid else b""
                    merged: list[list[int]] = []
                    for s, e in sorted((x["s"], x["e"]) for x in spans[i].as_py() or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    left = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in merged)], [*(s for s, _ in merged), len(raw)], strict=True))
                    yield ids[i].as_py(), len(raw), len(raw) - len(left), len(merged), sha256(left).hexdigest(), [{"s": s, "e": e} for s, e in merged], left.decode("utf-8", "ignore") if with_text else None

        yield from _batched(results(), [n for n, _ in fields], [t for _, t in fields], 512)

    out = chosen.mapInArrow(cut, "row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<s:int,e:int>>, kept string")
    out = out if with_text else out.drop("kept")
    if is_id:
        return out.withColumn("row", F.col("row").cast(docs.schema[id_column].dataType)).withColumnRenamed("row", id_column)
    return out.join(rows.select("row", F.col("id").alias(id_column)), "row").drop("row")
