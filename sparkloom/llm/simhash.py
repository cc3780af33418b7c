"""SimHash near-duplicates with the generalised pigeonhole principle.

Fingerprints are taken over word shingles.  Equal fingerprints collapse to one row first.  The 64 bits are
dealt into partitions so that correlated bits share one; for each fingerprint a small dynamic program gives
every partition its own radius (-1: not probed), such that the radii add up to ``max_bits - partitions + 1``
and the estimated number of candidates is least.  If two fingerprints differ in at most ``max_bits`` bits,
some partition then differs by no more than its radius, so probing these balls finds every link.  Estimates
come from counts over all fingerprints (bit co-occurrence and 8-bit histograms, sizes that do not depend on
the data).

A bucket in which more than ``dense`` fingerprints agree is not expanded to pairs.  Its members, and the
probes that reach it, are linked exactly through shared centres: two words differ in at most 2r bits if and
only if a word within r bits of both exists.  Each member lists the words within r bits and members of one
centre are tied to the smallest of them, which costs a fixed number of rows for each fingerprint.

Nulls and odd input: a null or blank text has fingerprint zero and links like any other; texts with fewer
words than a shingle are one shingle; repeated rows and repeated or null ids are kept as rows (a component whose
ids are all null has a null id); result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .runtime import checkpointed, utf8_slices

POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
DISTANCE = POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


def fingerprint(raw: bytes, shingle: int) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = raw.lower().split()  # bytes: A to Z only, and exactly 20 and 09 to 0D part words
    if not words:
        return 0
    text = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    votes, n, left = np.zeros(64, np.int64), len(words) - k + 1, 0
    while left < n:  # in slices, for very long texts
        right = min(n, left + 8192)
        hashes = b"".join([digest(text[s:e], 42) for s, e in zip(starts[left:right], ends[left + k - 1 : right + k - 1], strict=True)])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
        left = right
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and fp, the fingerprint as a signed long."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "fp" and (keep is not None or c != text)]
    chosen = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    schema = chosen.drop("t").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[int] = []
            for _, _, data, offsets in utf8_slices(batch.column(batch.num_columns - 1)):
                raw = data.tobytes()
                found += [fingerprint(raw[s:e], shingle) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], names=[*batch.schema.names[:-1], "fp"])

    out = chosen.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "fp")


def table_values(batch: pa.RecordBatch, tables: int) -> np.ndarray:
    """(rows, tables) fingerprints of a batch whose last column lists them."""
    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)


def bit_orders(distinct: DataFrame, tables: int) -> tuple[int, list[list[int]]]:
    """The number of rows, and for each table the 64 bits in an order that puts correlated bits side by side.

    distinct: one column fps, an array of ``tables`` fingerprints."""
    kinds = {"t": pa.int64(), "i": pa.int64(), "j": pa.int64(), "n": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((tables, 64, 64)), 0
        for batch in batches:
            values = table_values(batch, tables)
            n += len(values)
            for t in range(tables):
                bits = np.unpackbits(values[:, t].astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
                total[t] += bits.T @ bits
        if n:
            t, i, j = (x.ravel() for x in np.indices((tables, 64, 64)))
            columns = ([*t, -1], [*i, -1], [*j, -1], [*total.ravel().astype(np.int64), n])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    rows = distinct.select("fps").mapInArrow(count, "t long, i long, j long, n long").groupBy("t", "i", "j").agg(F.sum("n").alias("n")).collect()
    joint, n = np.zeros((tables, 64, 64)), 0
    for r in rows:
        if r["t"] < 0:
            n = r["n"]
        else:
            joint[r["t"], r["i"], r["j"]] = r["n"]
    return n, [_correlated(x, n) for x in joint]


def _correlated(joint: np.ndarray, n: int) -> list[int]:
    if not n:
        return list(range(64))
    p = joint.diagonal() / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs((joint / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    order, left = [int(tied.sum(axis=0).argmax())], set(range(64))
    left.remove(order[0])
    while left:  # the bit most tied to the last eight taken comes next
        order.append(max(sorted(left), key=lambda b: tied[b, order[-8:]].sum()))
        left.remove(order[-1])
    return order


def _permuted(fp: np.ndarray, order: list[int]) -> np.ndarray:
    """(n, 8) bytes of the fingerprints with their bits in the order given."""
    bits = np.unpackbits(fp.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits[:, order], axis=1)


def _cuts(parts: int) -> list[tuple[int, int]]:
    """Bytes of each partition, as even as they can be."""
    edges = [round(8 * i / parts) for i in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def allocate(within: np.ndarray, probes: np.ndarray, total: int) -> np.ndarray:
    """Radii for each fingerprint by dynamic programming.

    within[x, i, t + 1]: estimated candidates of x in partition i at radius t, 0 at t = -1; probes[i, t + 1]: words
    to look up.  The radii of x add up to ``total`` and the sum of both costs is least."""
    n, parts, choices = within.shape
    cost = within + probes[None]
    low, high = -parts, total + parts
    best = np.full((n, parts + 1, high - low + 1), np.inf)
    took = np.zeros((n, parts + 1, high - low + 1), np.int8)
    best[:, 0, -low] = 0
    for i in range(parts):
        for s in range(high - low + 1):
            for t in range(-1, choices - 1):
                if 0 <= s - t <= high - low:
                    value = best[:, i, s - t] + cost[:, i, t + 1]
                    better = value < best[:, i + 1, s]
                    best[better, i + 1, s], took[better, i + 1, s] = value[better], t
    radii, s = np.zeros((n, parts), np.int64), np.full(n, total - low)
    for i in range(parts, 0, -1):
        radii[:, i - 1] = took[np.arange(n), i, s]
        s = s - radii[:, i - 1]
    return radii


def _ball(width: int, radius: int) -> np.ndarray:
    """XOR masks of words of ``width`` bits with at most ``radius`` bits set."""
    masks, layer = [0], [(0, 0)]
    for _ in range(radius):
        layer = [(m | 1 << b, b + 1) for m, start in layer for b in range(start, width)]
        masks += [m for m, _ in layer]
    return np.array(masks, np.uint64)


def _probes(parts: int, max_bits: int) -> np.ndarray:
    """Words to look up in each partition at radius -1, 0, 1, ..."""
    sizes = [8 * (e - s) for s, e in _cuts(parts)]
    return np.array([[0.0] + [float(sum(comb(w, i) for i in range(t + 1))) if t <= w else np.inf for t in range(max_bits + 1)] for w in sizes])


def fitting_parts(n: int, max_bits: int) -> int:
    """The number of partitions for which looking up and comparing cost least if bits were independent."""
    costs = {}
    for parts in range(1, min(8, max_bits + 2) + 1):
        probes = _probes(parts, max_bits)
        within = n * probes / np.array([[2.0 ** (8 * (e - s))] for s, e in _cuts(parts)])
        radii = allocate(within[None], probes, max_bits - parts + 1)[0]
        costs[parts] = sum((within + probes)[i, t + 1] for i, t in enumerate(radii))
    return min(costs, key=costs.get)


@dataclass
class Allocation:
    """How one table of fingerprints is cut, and the counts by which each fingerprint gets its radii."""

    n: int
    max_bits: int
    parts: int
    order: list[int]
    near: np.ndarray  # near[g, v, d]: share of fingerprints that differ from v in exactly d bits of byte g

    def rows(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, bool]]:
        """(which fingerprints, partition, word, looked up rather than listed), for at most a few thousand fingerprints."""
        cuts, probes = _cuts(self.parts), _probes(self.parts, self.max_bits)
        data = _permuted(fp, self.order)
        within = np.zeros((len(fp), self.parts, self.max_bits + 2))
        values = []
        for i, (s, e) in enumerate(cuts):
            exact = np.zeros((len(fp), self.max_bits + 1))
            exact[:, 0] = 1
            for g in range(s, e):  # distances in bytes of a partition add up
                step = self.near[g][data[:, g]]
                exact = np.stack([(exact[:, : d + 1] * step[:, d::-1]).sum(axis=1) for d in range(self.max_bits + 1)], axis=1)
            within[:, i, 1:] = self.n * exact.cumsum(axis=1)
            word = np.zeros(len(fp), np.uint64)
            for g in range(s, e):
                word = word << np.uint64(8) | data[:, g].astype(np.uint64)
            values.append(word)
        radii, every = allocate(within, probes, self.max_bits - self.parts + 1), np.arange(len(fp))
        for i, (s, e) in enumerate(cuts):
            yield every, i, values[i], False
            for t in range(min(self.max_bits, 8 * (e - s)) + 1):
                mine = np.flatnonzero(radii[:, i] == t)
                if len(mine):
                    masks = _ball(8 * (e - s), t)
                    yield np.repeat(mine, len(masks)), i, (values[i][mine][:, None] ^ masks[None]).ravel(), True


def allocations(distinct: DataFrame, tables: int, max_bits: int, parts: int | None) -> list[Allocation]:
    """For each table its allocation, from counts over all rows.  distinct: a column fps; it is read twice."""
    n, orders = bit_orders(distinct, tables)
    kinds = {"t": pa.int64(), "g": pa.int64(), "v": pa.int64(), "n": pa.int64()}

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((tables, 8, 256), np.int64)
        for batch in batches:
            values = table_values(batch, tables)
            for t in range(tables):
                for g, column in enumerate(_permuted(values[:, t], orders[t]).T):
                    counts[t, g] += np.bincount(column, minlength=256)
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*at, counts[at])], names=list(kinds))

    shares = np.zeros((tables, 8, 256))
    for r in distinct.select("fps").mapInArrow(histogram, "t long, g long, v long, n long").groupBy("t", "g", "v").agg(F.sum("n").alias("n")).collect():
        shares[r["t"], r["g"], r["v"]] = r["n"] / max(n, 1)
    parts = parts or fitting_parts(n, max_bits)
    near = lambda share: np.stack([np.stack([(DISTANCE == d) @ share[g] for d in range(max_bits + 1)], axis=1) for g in range(8)])
    return [Allocation(n, max_bits, parts, order, near(share)) for order, share in zip(orders, shares, strict=True)]


def links(distinct: DataFrame, *, max_bits: int = 2, parts: int | None = 3, dense: int = 64) -> DataFrame:
    """Pairs (a, b) of fingerprints that differ in at most ``max_bits`` bits, enough of them to connect all that
    are linked.  distinct: one long column fp without repeats; it is read several times (checkpoint it)."""
    if max_bits < 0 or parts is not None and (not 1 <= parts <= 8 or max_bits - parts + 1 < -parts):
        raise ValueError("max_bits must be 0 or more, parts 1 to 8")
    (table,) = allocations(distinct.select(F.array("fp").alias("fps")), 1, max_bits, parts)

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), 4096):
                fp = whole["fp"].to_numpy()[at : at + 4096]
                yield pd.concat([pd.DataFrame({"fp": fp[x], "part": np.int32(i), "word": w.view(np.int64), "probe": p}) for x, i, w, p in table.rows(fp)])

    rows = checkpointed(distinct.select("fp").mapInPandas(keys, "fp long, part int, word long, probe boolean"))
    index, probe = rows.where("not probe").drop("probe"), rows.where("probe").drop("probe")
    size = index.groupBy("part", "word").agg(F.count("*").alias("n"))
    cold = index.join(size.where((F.col("n") <= dense)), ["part", "word"], "left_semi")
    pairs = probe.withColumnRenamed("fp", "a").join(cold.withColumnRenamed("fp", "b"), ["part", "word"])
    pairs = pairs.where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    hot = size.where(F.col("n") > dense).select("part", "word")
    crowd = rows.join(hot, ["part", "word"], "left_semi").select("fp").distinct()
    return pairs.union(through_centres(crowd, max_bits)).distinct()


def through_centres(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links among the fingerprints given, found without pairs: through words near both ends of a link."""
    inner, outer = max_bits // 2, max_bits - max_bits // 2
    near = _ball(64, inner).view(np.int64).tolist()
    far = _ball(64, outer).view(np.int64).tolist()
    if outer == inner:
        masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(True).alias("inner")) for m in near])
    else:
        close = set(near)
        masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(m in close).alias("inner")) for m in far])
    rows = crowd.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m.mask")).alias("centre"), "m.inner")
    hub = rows.where("inner").groupBy("centre").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    if outer == inner:
        hub = hub.where("n > 1")
    # Spark sizes both sides before the explode; a merge join is right whatever comes of it
    return rows.hint("merge").join(hub.hint("merge"), "centre").where("fp <> b").select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2, parts: int = 3, dense: int = 64) -> DataFrame:
    """One row per input row: the id, fingerprint (16 hex digits) and component_id, the smallest id that can be
    reached over links of at most ``max_bits`` bits."""
    fps = checkpointed(fingerprints(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), shingle=shingle, keep=["id"]))
    distinct = checkpointed(fps.groupBy("fp").agg(F.min("id").alias("least")))
    found = connected_components(links(distinct, max_bits=max_bits, parts=parts, dense=dense))
    labelled = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = labelled.join(least, "component").select("fp", "component_id")
    out = fps.join(labels, "fp").select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return out


def drop_near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Keep one row of each group: that with the smallest id; of rows with that same id, the first text in order.

    A row with a null id can't be named by a decision and stays.  All columns stay as they are."""
    return keep_least(docs, near_duplicates(docs, id_column=id_column, text=text, **options), id_column=id_column, text=text)


def keep_least(docs: DataFrame, marks: DataFrame, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that drop_near_duplicates keeps, by the component_id of each id in ``marks``."""
    marks = marks.where(F.col(id_column) == F.col("component_id")).groupBy(F.col(id_column).alias("_kept")).agg(F.count("*").alias("_n"))
    marks = checkpointed(marks)
    kept = docs.join(marks.select("_kept"), docs[id_column] == F.col("_kept"), "left_semi")
    nameless = docs.where(F.col(id_column).isNull())
    repeated = marks.where("_n > 1").select("_kept")
    if repeated.isEmpty():
        return kept.union(nameless)
    single = kept.join(repeated, kept[id_column] == F.col("_kept"), "left_anti")
    first = kept.join(repeated, kept[id_column] == F.col("_kept"), "left_semi").groupBy(id_column)
    first = first.agg(F.min_by(F.struct(*docs.columns), F.struct(text, F.xxhash64(*docs.columns))).alias("row")).select("row.*")
    return single.union(first).union(nameless)
