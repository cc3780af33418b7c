"""Language identification by averaged, hashed subword embeddings and a linear softmax.

A text is lower-cased (A to Z) and cut into its byte n-grams; each n-gram hashes to one of ``BUCKETS``
embeddings, the document vector is their mean, and a linear layer with softmax scores the languages and one more class:
none of them.  Training is stochastic gradient descent in numpy over a sample of labelled rows, bounded as a whole
(``sample_rows``, ``sample_bytes``) and shared evenly among all labels, however many.  That last class learns from decoys
made of the sample: words with their letters shuffled, texts with their letters exchanged, letters that follow one
another as pairs of the sample do, and random letters.  Texts and decoys are also learnt as short crops.

A part of the sample is set aside for calibration.  It gives a temperature, and two limits for rejection: a score,
between what known texts and decoys reach; and how usual a text's n-grams are in the language predicted (their mean
log-frequency, less that of the language's own texts, over the spread that a text of that length has), which tells
languages that were never learnt.  Neither is so high that more than 1 - ``keep`` of the known texts are lost to it.

Scoring covers every row and the whole text.  Because the mean and the linear layer commute, embeddings times
weights are folded to one table of ``BUCKETS`` x languages (about 1 MB, and as much again for the frequencies), so that its
size does not depend on the data but for the number of languages, and it travels with the task.

Nulls and odd input: very long texts are scored whole, in parts; a null text, or one without a letter, is ``und`` with score 0; rows without a label are
never learnt from; if nothing can be learnt, every row is ``und``.  Repeated rows each get their own result.
Columns of the input other than the text and the ones named are passed through; the result columns replace
input columns of the same name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import LOWER, checkpointed, fresh, utf8_slices

BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
DIM = 16
#: Bytes looked at together.
SLICE = 1 << 18


@dataclass
class LanguageModel:
    """languages; table: logits per bucket for these and for none of them; bias; temperature; reject_below: the score needed;
    usual: log-frequency of each bucket by language; centre: its mean by language; spread: variance of a long text, and what a
    text of one n-gram adds; reject_unusual: the least deviation allowed."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float
    usual: np.ndarray
    centre: np.ndarray
    spread: tuple[float, float]
    reject_unusual: float


def gram_ids(data: np.ndarray, offsets: np.ndarray, before: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each byte n-gram that lies within one row (and starts ``before`` that byte)."""
    low = LOWER[data].astype(np.uint32)
    n, lengths = len(low), np.diff(offsets)
    end = np.repeat(offsets[1:], lengths)
    place, parts, rows = np.arange(n), [], []
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    h = np.full(n, 2166136261, np.uint32)
    for size in range(1, max(GRAMS) + 1):
        if n < size:
            break
        h = (h[: n - size + 1] ^ low[size - 1 :]) * np.uint32(16777619)
        inside = place[: n - size + 1] + size <= end[: n - size + 1]
        if before is not None:
            inside[before:] = False
        if size in GRAMS:
            x = h[inside]
            parts.append(((x ^ (x >> np.uint32(15))) * np.uint32(2654435761)) >> np.uint32(16))
            rows.append(owner[: n - size + 1][inside])
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(parts), np.concatenate(rows)


def row_logits(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The linear layer's output for each row, before the temperature, and how usual the row is in the best language, in
    spreads of its length; a row longer than a slice goes in parts."""
    k, known = len(offsets) - 1, len(model.languages)
    if k == 1 and len(data) > SLICE:
        both = np.concatenate([model.table, model.usual], axis=1)
        sums, counts = np.zeros(both.shape[1]), np.zeros(1)
        for at in range(0, len(data), SLICE):
            part = data[at : at + SLICE + max(GRAMS) - 1]
            ids, _ = gram_ids(part, np.array([0, len(part)]), SLICE)
            sums += both[ids].sum(axis=0, dtype=np.float64)
            counts += len(ids)
        logits = sums[None, : known + 1] / counts + model.bias
        best = logits[:, :known].argmax(axis=1)
        usual = sums[known + 1 + best] / counts
    else:
        ids, rows = gram_ids(data, offsets)
        counts = np.maximum(np.bincount(rows, minlength=k), 1)
        logits = np.empty((k, known + 1))
        for c in range(known + 1):
            logits[:, c] = np.bincount(rows, model.table[:, c][ids], minlength=k) / counts
        logits += model.bias
        best = logits[:, :known].argmax(axis=1)
        usual = np.bincount(rows, model.usual.ravel()[ids * np.uint32(known) + best.astype(np.uint32)[rows]], minlength=k) / counts
    return logits, (usual - model.centre[best]) / np.sqrt(model.spread[0] + model.spread[1] / counts)


def judged(model: LanguageModel, logits: np.ndarray, usual: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its score, and whether it is rejected, of each row."""
    p = softmax(logits / model.temperature)[:, : len(model.languages)]
    return p.argmax(axis=1), p.max(axis=1), (p.max(axis=1) < model.reject_below) | (usual < model.reject_unusual)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def crop(raw: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Some 30 to 300 bytes of a text, from a blank on."""
    size = int(random.integers(30, 300))
    if len(raw) <= size:
        return raw
    at = int(random.integers(0, len(raw) - size))
    blank = np.flatnonzero(raw[at : at + size // 2] == 32)
    return raw[at + (int(blank[0]) if len(blank) else 0) : at + size]


def decoy(raw: np.ndarray, kind: int, chain: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A text that is like the given one in length and words, but in no known language."""
    raw = LOWER[raw]
    letters = (raw >= 97) & (raw <= 122)
    if kind == 0:  # letters shuffled within their words
        word = np.cumsum(raw == 32)
        order = np.lexsort((random.random(len(raw)), word))
        out = raw[order]
        out[raw == 32] = 32
        return out
    if kind == 1:  # letters exchanged
        table = np.arange(256, dtype=np.uint8)
        table[97:123] = 97 + random.permutation(26)
        return table[raw]
    out = raw.copy()
    if kind == 2:  # each letter follows the one before as in all texts
        n = int(letters.sum())
        at = int(random.integers(0, len(chain)))
        out[letters] = np.resize(np.roll(chain, -at), n) if n > len(chain) else np.concatenate([chain, chain])[at : at + n]
        return out
    out[letters] = random.integers(97, 123, int(letters.sum()))
    return out


def letter_chain(raws: list[np.ndarray], random: np.random.Generator, chains: int = 256, steps: int = 1024) -> np.ndarray:
    """Letters of which each follows the one before as often as in the texts, in several chains one after the other."""
    pairs = np.ones((26, 26))
    for raw in raws:
        low = LOWER[raw[: 1 << 14]].astype(np.int64) - 97
        letter = (low >= 0) & (low < 26)
        both = letter[:-1] & letter[1:]
        np.add.at(pairs, (low[:-1][both], low[1:][both]), 1)
    cut = pairs.cumsum(axis=1) / pairs.sum(axis=1, keepdims=True)
    state, out = random.integers(0, 26, chains), np.empty((chains, steps), np.uint8)
    for i in range(steps):
        state = np.minimum((random.random(chains)[:, None] > cut[state]).sum(axis=1), 25)
        out[:, i] = 97 + state
    return out.ravel()


def gram_shares(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets, their shares, and the number of n-grams."""
    ids, count = np.unique(gram_ids(raw, np.array([0, len(raw)]))[0], return_counts=True)
    return ids.astype(np.int64), (count / max(count.sum(), 1)).astype(np.float32), int(count.sum())


def fit(texts: list[str], labels: list[str], *, epochs: int = 4, rate: float = 8.0, seed: int = 7, keep: float = 0.995) -> LanguageModel | None:
    """Train on the texts given; one in five is set aside for temperature and rejection."""
    languages = sorted(set(labels))
    if not languages:
        return None
    random = np.random.default_rng(seed)
    raws = [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
    place = {name: i for i, name in enumerate(languages)}
    other, chain = len(languages), letter_chain(raws, random)
    grams, sizes, y, group = [], [], [], []
    for i, raw in enumerate(raws):
        short = crop(raw, random)
        false = decoy(raw[: 1 << 12] if i % 8 < 4 else short, i % 4, chain, random)
        for part, label in ((raw, place[labels[i]]), (short, place[labels[i]]), (false, other)):
            ids, share, n = gram_shares(part)
            grams.append((ids, share))
            sizes.append(n)
            y.append(label)
            group.append(i)
    y, order = np.array(y), random.permutation(len(texts))
    is_aside = np.zeros(len(texts), bool)
    is_aside[order[: len(order) // 5]] = True
    away = is_aside[np.array(group)]
    aside, train = np.flatnonzero(away), np.flatnonzero(~away)
    table = random.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, other + 1), np.float32), np.zeros(other + 1, np.float32)
    steps = max(1, epochs * len(train))
    done = 0
    for _ in range(epochs):
        for i in random.permutation(train):
            ids, share = grams[i]
            if not len(ids):
                continue
            step = rate * (1 - done / steps) * 0.05
            done += 1
            hidden = share @ table[ids]
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = weights @ p
            weights -= step * 4 * np.outer(hidden, p)
            bias -= step * 0.1 * p
            # the mean divides an n-gram's gradient by the text's length; sqrt keeps rare n-grams learning
            table[ids] -= step * 4 * np.sqrt(share)[:, None] * back[None, :]
    often = np.full((other, BUCKETS), 1.0 / BUCKETS)
    for i in train:
        if y[i] < other:
            often[y[i], grams[i][0]] += grams[i][1]
    usual = np.log(often / often.sum(axis=1, keepdims=True)).T.astype(np.float32)
    model = LanguageModel(languages, table @ weights, bias.astype(np.float64), 1.0, 0.0, usual, np.zeros(other), (1.0, 0.0), -np.inf)
    held = aside if len(aside) else train
    z = np.array([model.bias + (s @ model.table[g] if len(g) else 0) for g, s in (grams[i] for i in held)]).reshape(len(held), other + 1)
    grid = np.geomspace(0.02, 20, 60)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / model.temperature)[:, :other]
    score, known = p.max(axis=1), y[held] < other
    right = np.sort(score[known & (p.argmax(axis=1) == y[held])])
    if len(right):
        low = right[int((1 - keep) * (len(right) - 1))]
        false = np.quantile(score[~known], 0.99) if (~known).any() else 0.0
        model.reject_below = float(low if false >= low else np.sqrt(max(false, 1e-6) * low))
    known = np.array([i for i in held if y[i] < other and len(grams[i][0])], int)
    if len(known):
        own = np.array([grams[i][1] @ usual[grams[i][0], y[i]] for i in known], np.float64)
        share = np.array([1 / sizes[i] for i in known])
        model.centre = np.array([own[y[known] == c].mean() if (y[known] == c).any() else own.mean() for c in range(other)])
        off = own - model.centre[y[known]]
        # medians (0.455 is that of a squared normal deviate), so that odd texts don't widen the spread
        long, short = share <= np.quantile(share, 0.25), share >= np.quantile(share, 0.75)
        base = max(float(np.median(off[long] ** 2)) / 0.455, 1e-6)
        slope = max((float(np.median(off[short] ** 2)) / 0.455 - base) / float(np.median(share[short])), 0.0)
        model.spread = (base, slope)
        far = np.sort(off / np.sqrt(model.spread[0] + model.spread[1] * share))
        model.reject_unusual = float(far[int((1 - keep) * (len(far) - 1))]) - 0.5
    return model


def train(rows: DataFrame, *, text: str = "text", lang: str = "lang", id_column: str = "doc_id", sample_rows: int = 3000, sample_bytes: int = 16 << 20, seed: int = 7) -> LanguageModel | None:
    """Fit on a bounded sample of labelled rows, drawn by a hash of the id and the text.

    Every label has the same part of ``sample_rows`` and ``sample_bytes``: the share drawn of it is such that about that
    many rows and bytes are expected, however large the table; texts are taken whole."""
    rows = rows.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    sizes = checkpointed(sizes)
    labels = sizes.count()
    if not labels:
        return None
    share = F.least(F.lit(1.0), sample_rows / (labels * F.col("n")), sample_bytes / (labels * F.greatest("bytes", F.lit(1))))
    shares = sizes.select("lang", share.alias("share"))
    draw = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    wanted = rows.join(F.broadcast(shares) if labels <= 10_000 else shares, "lang").where(draw < F.col("share"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn = sorted((name, i or "", t) for f in frames for name, i, t in zip(f["lang"], f["id"], f["text"], strict=True))
        if drawn:
            yield pd.DataFrame({"model": [pickle.dumps(fit([t for _, _, t in drawn], [name for name, _, _ in drawn], seed=seed))]})

    # the sample is bounded, so that one task holds it; the model alone comes to the driver
    found = wanted.select("lang", "id", "text").repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(bytes(found["model"])) if found else None


def identify(docs: DataFrame, model: LanguageModel | None, *, text: str = "text") -> DataFrame:
    """Add lang_pred (string), score (double, 0 to 1) and rejected (boolean: the calibrated score is too low)."""
    docs = docs.drop("lang_pred", "score", "rejected")
    mark = fresh(docs, "_letters")
    docs = docs.withColumn(mark, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = docs.drop(mark).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)}).schema

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            best, score, off = np.zeros(len(column), np.int64), np.zeros(len(column)), np.ones(len(column), bool)
            letters = np.array(batch.column(batch.schema.get_field_index(mark)).to_pylist(), bool)
            if model is not None:
                for first, last, data, offsets in utf8_slices(column, SLICE):
                    best[first:last], score[first:last], off[first:last] = judged(model, *row_logits(model, data, offsets))
            else:
                letters[:] = False
            names = [model.languages[i] if ok else "und" for i, ok in zip(best, letters, strict=True)] if model else ["und"] * len(column)
            score = np.where(letters, np.clip(score, 0, 1), 0.0)
            rejected = ~letters | off
            kept = [c for c, f in zip(batch.columns, batch.schema, strict=True) if f.name != mark]
            fields = [f for f in batch.schema if f.name != mark]
            new = [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*kept, *new], schema=pa.schema([*fields, pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]))

    return docs.mapInArrow(predict, schema)


def held_out(doc_id: Column | str) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
