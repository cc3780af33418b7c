"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic programming carries the
best score and the number of pieces.  Rules are those of the common unigram tokenizer implementation: scores add
up, a tie is won by the segmentation whose last piece starts first, a character that no single-character piece covers
is an unknown piece with the least score of the vocabulary less 10, and adjacent unknown pieces count as one (or,
with ``byte_fallback``, as one piece for each byte).  Spaces become the mark U+2581, one of which is put in front.

Where the vocabulary shows that no piece reaches over (before a mark, and before runs of certain signs), a text
falls apart exactly; the counts of such segments are kept in a bounded memory for each Python worker.

Nulls and odd input: a null or empty text has no tokens; repeated rows each get a row; input columns named like
a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers at most; then it starts anew.
REMEMBERED = 1 << 19


def read_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file; control, unknown and byte pieces are left out."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(p.id_to_piece(i), float(p.get_score(i))) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


#: Latin letters; between one of these and a sign that follows it in no piece, a text falls apart.
LETTER = "A-Za-z\u00c0-\u024f"


def cut_characters(vocabulary: list[tuple[str, float]]) -> str:
    """ASCII signs that are pieces of their own (so never unknown) and follow a Latin letter in no piece."""
    signs = {piece for piece, _ in vocabulary if len(piece) == 1 and piece.isascii() and not piece.isalnum()}
    after = {c for piece, _ in vocabulary for c in re.findall(f"(?<=[{LETTER}])(?s:.)", piece)}
    return "".join(sorted(signs - after))


def segments(vocabulary: list[tuple[str, float]]) -> re.Pattern:
    """Matches parts of a text over whose ends no vocabulary piece or run of unknown characters reaches.

    If that can't be told from the vocabulary, the pattern takes the whole text."""
    pieces = {piece for piece, _ in vocabulary}
    if MARK not in pieces or any(MARK in piece.lstrip(MARK) for piece in pieces):
        return re.compile("(?s:.+)")
    if not (cut := re.escape(cut_characters(vocabulary))):
        return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
    word = f"{MARK}*[{LETTER}]+(?![^{MARK}{cut}])"
    return re.compile(f"{word}|{MARK}*[^{MARK}]+?(?:(?<=[{LETTER}])(?=[{cut}])|(?={MARK})|\\Z)|{MARK}+")


class Counter:
    """Counts pieces of texts; holds the automaton and what it has counted."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = False) -> None:
        self.byte_fallback = byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.segment = segments(vocabulary)
        self.known: dict[str, int] = {}

    def count_segment(self, s: str) -> int:
        """Pieces of one segment by the Viterbi recurrence.

        The automaton gives the matches in the order of their ends and, for one end, the longest first; so a later
        match wins only by a better score, and the piece that starts first wins a tie."""
        n = len(s)
        score, pieces, unknown_last = [-inf] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        score[0] = 0.0
        filled, single = 0, True  # the end being filled, and if a piece of one character ends there
        for last, (length, own) in self.automaton.iter(s):
            if last >= filled:
                if not single or last > filled:
                    self.unknowns(s, filled - (not single), last, score, pieces, unknown_last)
                filled, single = last + 1, False
            start = filled - length
            if (total := score[start] + own) > score[filled]:
                score[filled], pieces[filled] = total, pieces[start] + 1
            if length == 1:
                single = True
        if not single or n > filled:
            self.unknowns(s, filled - (not single), n, score, pieces, unknown_last)
        return pieces[n]

    def unknowns(self, s: str, start: int, end: int, score: list[float], pieces: list[int], unknown_last: list[bool]) -> None:
        """Offer each character from start to end as an unknown piece; none of them is a piece."""
        for i in range(start, end):
            if (total := score[i] + self.unknown) > score[i + 1]:
                more = len(s[i].encode("utf-8", "surrogatepass")) if self.byte_fallback else not unknown_last[i]
                score[i + 1], pieces[i + 1], unknown_last[i + 1] = total, pieces[i] + more, True

    def count(self, text: str) -> int:
        """Pieces of a text with its spaces marked and one mark in front."""
        if not text:
            return 0
        known, total = self.known, 0
        for part in self.segment.findall(MARK + text.replace(" ", MARK)):
            n = known.get(part)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = self.count_segment(part)
                if len(part) <= 64:
                    known[part] = n
            total += n
        return total


@lru_cache(maxsize=4)
def counter(model_file: str, byte_fallback: bool) -> Counter:
    """One counter for each Python worker."""
    return Counter(read_vocabulary(model_file), byte_fallback)


def count_tokens(docs: DataFrame, model_file: str, *, text: str = "text", byte_fallback: bool = False, keep: list[str] | None = None) -> DataFrame:
    """keep columns (all but the text by default) and n_tokens, n_chars_text (long).

    model_file must be readable at that path by every executor."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c not in ("n_tokens", "n_chars_text")]
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    schema = chosen.drop("t").withColumns({"n_tokens": F.lit(0).cast("long"), "n_chars_text": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_file, byte_fallback)
        for batch in batches:
            tokens, chars = [], []
            for value in batch.column(batch.num_columns - 1):
                value = value.as_py() or ""
                tokens.append(model.count(value))
                chars.append(len(value))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(tokens, pa.int64()), pa.array(chars, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens", "n_chars_text"])

    return chosen.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})
