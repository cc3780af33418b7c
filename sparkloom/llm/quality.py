"""Quality rules: measures of each text, and lines that repeat over the documents of a host.

Base measures come from one pass over the bytes.  The cross-document part hashes each distinct normalised line
of a document (A to Z lower-cased, blanks at the ends dropped and inner runs made one space, digits made 0), counts
the documents of a host in which it stands, and takes lines over the limit as boilerplate.  A document that
passes the base rules is still rejected if what is left after removing those lines is too little.

Only (host, line hash) counts and numbers of words are shuffled, never texts.  Counts combine before the shuffle,
and lines over the limit are joined back by (host, hash), where adaptive execution splits a hot host.

Nulls and odd input: a null text has no words and fails the base rules; a null host is a host of its own;
repeated rows and ids are judged as rows (each counts as a document); very long texts are measured whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import LOWER, NOT_BLANK, byte_table, checkpointed, prefix_sums, runs, span_hashes, utf8_slices, word_hashes

SYMBOL = byte_table(b"#*$%&|<>")
CONTINUES = np.arange(256) & 0xC0 == 0x80  # bytes of a character after its first
NEWLINE = 10
_DIGITS = LOWER.copy()
_DIGITS[48:58] = 48
REPEAT = 8


def measures(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Base measures of each row, and (row, hash, words) of each distinct normalised line with a word."""
    k = len(offsets) - 1
    starts, ends = runs(NOT_BLANK[data], offsets)
    bounds = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(k), np.diff(bounds))
    code_points = np.concatenate([[0], np.cumsum(~CONTINUES[data] & NOT_BLANK[data])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[data])])
    out = {"n_words": np.diff(bounds), "word_chars": np.diff(code_points[offsets]), "n_symbols": np.diff(symbols[offsets])}

    # words in windows of 8 that occur twice or more in one row
    hashes, covered = word_hashes(data, starts, ends), np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= REPEAT:
        prefix = prefix_sums(hashes)
        first = np.arange(len(starts) - REPEAT + 1)
        first = first[row[first] == row[first + REPEAT - 1]]
        window = span_hashes(prefix, first, first + REPEAT) ^ (row[first].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = first[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    out["n_repeat_words"] = np.bincount(row[repeated], minlength=k)

    # lines: runs between newlines and row bounds that hold a word
    line_starts, line_ends = runs(data != NEWLINE, offsets)
    a, b = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    full = b > a
    line_starts, line_ends, a, b = line_starts[full], line_ends[full], a[full], b[full]
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    exact = span_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1)), line_starts, line_ends) ^ (line_row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    firsts = np.unique(exact, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_row, minlength=k) - np.bincount(line_row[firsts], minlength=k)

    plain = span_hashes(prefix_sums(word_hashes(_DIGITS[data], starts, ends)), a, b) if len(a) else np.zeros(0, np.uint64)
    key = plain ^ (line_row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, one, inverse = np.unique(key, return_index=True, return_inverse=True)
    words = np.bincount(inverse, b - a, minlength=len(one)).astype(np.int64)
    return out, (line_row[one], plain[one], words)


def measured(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """keep columns, the measures (long) and lines: array of (h: line hash, w: its words over all its copies)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    lines = F.array().cast("array<struct<h:bigint,w:bigint>>")
    schema = chosen.drop("t").withColumns({n: F.lit(0).cast("long") for n in names} | {"lines": lines}).schema
    struct = pa.struct([pa.field("h", pa.int64()), pa.field("w", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {n: [] for n in names}
            sizes, hs, ws = [], [], []
            for _, _, data, offsets in utf8_slices(batch.column(batch.num_columns - 1)):
                found, (row, h, w) = measures(data, offsets)
                for n in names:
                    parts[n].append(found[n].astype(np.int64))
                order = np.argsort(row, kind="stable")
                sizes.append(np.bincount(row, minlength=len(offsets) - 1))
                hs.append(h[order].view(np.int64))
                ws.append(w[order])
            if not sizes:
                continue
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(np.concatenate(hs)), pa.array(np.concatenate(ws))], fields=list(struct))
            columns = [*batch.columns[:-1], *(pa.array(np.concatenate(parts[n])) for n in names), pa.ListArray.from_arrays(pa.array(bounds), values)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *names, "lines"])

    return chosen.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def judge(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", host: str = "source", most_documents: int = 20, small_host: int = 3, small_share: float = 0.1, least_left: float = 0.5, least_words: int = 20) -> DataFrame:
    """One row per input row: the id, the base measures, base_failed, n_common_words (in removed lines) and kept.

    A line is removed if it stands in more than ``most_documents`` documents of its host, however large that is; on hosts
    too small for it, if it stands in at least ``small_host`` documents and in more than ``small_share`` of them.  A document
    is depleted, and not kept, if fewer than ``least_words`` words or less than the share ``least_left`` of its
    words are left."""
    rows = measured(docs.select(F.col(id_column).alias("_id"), F.col(host).cast("string").alias("_host"), F.col(text).alias("_text")), text="_text", keep=["_id", "_host"])
    rows = rows.withColumn("_host", F.coalesce(F.concat(F.lit("="), "_host"), F.lit("")))
    rows = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    lines = rows.select("_row", "_host", F.inline("lines"))
    hosts = rows.groupBy("_host").agg(F.count("*").alias("n_docs"))
    common = lines.groupBy("_host", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min(small_host, most_documents + 1))
    # a host's lines may be very many: those over the absolute limit need no host, the others are at most 20 for each line
    over = common.where(F.col("n") > most_documents).select("_host", "h")
    small = hosts.where(F.col("n_docs") * small_share < most_documents)
    few = common.where(F.col("n") <= most_documents).join(small, "_host").where(F.col("n") > small_share * F.col("n_docs")).select("_host", "h")
    common = over.union(few)
    lost = lines.join(common, ["_host", "h"]).groupBy("_row").agg(F.sum("w").alias("n_common_words"))
    out = rows.drop("lines", "_host").join(lost, "_row", "left").withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0).cast("long")))
    out = out.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    left = F.col("n_words") - F.col("n_common_words")
    out = out.withColumn("kept", ~F.col("base_failed") & (left >= least_words) & (left >= least_left * F.col("n_words")))
    return out.drop("_row").withColumnRenamed("_id", id_column)
