"""Secret scans: base patterns, and assignment-aware lexing of source and configuration text.

Base spans are the leftmost, non-overlapping matches of the three patterns in ``BASE`` that are long enough.

The lexer adds spans.  It cuts the text into strings (with quotes, backticks or three quotes), comments, names, bare
values and marks, and reads from these the pairs of a name and a value, as they stand in

* code: ``name = "..."``, also with a type between, with concatenated pieces, as a keyword argument, as a comparison, and as
  the argument of a setter or of a call whose first argument is the name;
* JSON and YAML: ``"name": "..."``, ``name: value``, and block scalars (``name: |`` and the deeper lines below);
* shell and INI: ``name=value``, below a ``[section]`` whose name counts too;
* XML: attributes, ``<add key="name" value="..."/>`` and ``<name>value</name>``.

A name that is given another name, or an interpolated one, stands for that name's literals: constants are followed by
scope (braces, or outside of all braces the indentation of a block; nesting beyond ``DEEPEST`` is one scope), the nearest
enclosing one first, whether they are defined before or after their use.  Each literal is scored by how sensitive the names are that it reaches.  It counts if its
score reaches ``least_score`` and its value looks like a credential (long enough, no blank, letters and digits mixed, or
quoted with several kinds of characters).  Text in comments is read like other text: secrets are left there too.

Each text is judged by itself and whole, so the work is one pass over the rows without a shuffle.  Texts that hold no
part of a sensitive name anywhere can't have a literal that counts and aren't lexed.

Nulls and odd input: a null text has no spans, an empty one neither; repeated rows each get a row; input
columns named like a result are replaced, all others stay.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, group whose length counts, its least length; in the order in which kinds are listed.
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
]
KINDS = ["assign", "access", "hex", "literal"]

#: How much a part of a name says that its value is secret.
SENSITIVE = {"password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "apikey": 3, "credential": 3, "credentials": 3, "token": 2, "auth": 2, "bearer": 2, "private": 2, "signing": 1, "access": 1, "key": 1, "salt": 1}
HARMLESS = {"public": 2, "id": 1, "name": 1, "path": 2, "file": 2, "url": 2, "length": 2, "count": 2, "type": 2, "example": 2}
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Every part of a sensitive name has one of these in it.
STEMS = ("pass", "pwd", "secret", "key", "credential", "token", "auth", "bearer", "private", "signing", "access", "salt")


def may_score(text: str) -> bool:
    """False only if no name in the text can score."""
    low = text.lower()
    return any(x in low for x in STEMS)


#: Strings begin where a token has no kind: with letters that may stand before a quote, and a quote.
TOKEN = re.compile(
    r"""(?P<blank>[ \t\r\f\v]+)|(?P<line>\n)|[rbuf]{0,2}(?:\"{3}|'{3}|["'`])"""
    r"""|(?P<ref>\$\{[A-Za-z_][\w.]*\}|\$[A-Za-z_]\w*)|(?P<name>@?[A-Za-z_][\w]*(?:[.-]\w+|::\w+|->\w+)*)"""
    r"""|(?P<mark>:=|===?|=>|->|[=:,;+.&(){}\[\]<>|/!?])|(?P<rest>.)""",
    re.S,
)
WORD = re.compile(r"@?[A-Za-z_][\w]*(?:[.-]\w+|::\w+|->\w+)*")
OPENING = re.compile(r"""[rbuf]{0,2}""")
#: What stands in a string, up to its closing quote; a backslash takes the next character along.
INSIDE = {
    '"""': re.compile(r'''(?:[^"\\]|\\.|"(?!""))*+"""''', re.S), "'''": re.compile(r"""(?:[^'\\]|\\.|'(?!''))*+'''""", re.S),
    '"': re.compile(r'''[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"''', re.S), "'": re.compile(r"""[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'""", re.S),
    "`": re.compile(r"""[^`\\]*+(?:\\.[^`\\]*+)*+`""", re.S),
}
DIGIT, LETTER = re.compile(r"\d"), re.compile(r"[A-Za-z]")
#: What a value that isn't quoted may be made of.
BARE = re.compile(r"[A-Za-z0-9+/_.=$@!%^&*~:-]+")
NAME = re.compile(r"[A-Za-z_][\w]*(?:[.-]\w+)*")
CHAINED = re.compile(r"([A-Za-z_]\w*)=(?=[^=\s])")
DEEPEST = 64
SECTION = re.compile(r"[ \t]*\[([A-Za-z_][\w .:-]*)\][ \t]*(?:\n|\Z)")
BLOCK = re.compile(r"[|>][+-]?[0-9]?[ \t]*\n")
TYPE = re.compile(r"[ \t]*:[ \t]*[A-Za-z_][\w.<>\[\], |?]{0,63}?[ \t]{0,8}=(?![=>])[ \t]*")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)[^<>]*>([^<>\n]+)</\1>")

Piece = tuple[int, int, bool]  # start, end, quoted


def name_score(name: str) -> int:
    """Sum of what the parts of a name (snake, kebab, dotted or camel case) say about secrecy."""
    parts = [p.lower() for p in PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    return sum(SENSITIVE.get(p, 0) - HARMLESS.get(p, 0) for p in {*parts, *joined})


#: Beginnings of values that aren't secrets.
FOREIGN = ("http:", "https:", "${", "{{", "<")


def credential_like(value: str, quoted: bool, least: int) -> bool:
    if len(value) < least or any(c.isspace() for c in value) or value.startswith(FOREIGN):
        return False
    digit, letter = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
    return digit and letter or quoted and len(set(value)) >= 6 and bool(re.search(r"[^A-Za-z]", value))


class Lexer:
    """Pairs of a text: ``pairs`` lists (scope, name, pieces, names that it stands for); ``outer`` gives the scope around each."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.closers: dict[str, array] = {}
        self.tokens = list(self.read_tokens())
        self.starts = {s: i for i, (_, s, _, _) in enumerate(self.tokens)}
        self.pairs: list[tuple[int, str, list[Piece], list[str]]] = []
        self.outer: list[int] = [-1]
        self.mixed: dict[tuple[int, int], bool] = {}  # of unquoted values: whether they have letters and digits
        self.run = (0, 0, 0, -1, -1)  # the unquoted run read last: start, end, end less marks, last digit, last letter
        self.read()

    def read_tokens(self) -> Iterator[tuple[str, int, int, tuple[int, int] | None]]:
        """(kind, start, end, what stands inside a string)."""
        text, at = self.text, 0
        while at < len(text):
            m = TOKEN.match(text, at)
            kind, end, within = m.lastgroup, m.end(), None
            if kind is None:
                kind, end, within = self.string(at, end)
            yield kind, at, end, within
            at = end

    def string(self, start: int, opened: int) -> tuple[str, int, tuple[int, int] | None]:
        """The string that begins at a place, or what stands there if it isn't closed: a word or a character."""
        first = OPENING.match(self.text, start).end()
        for quote in (self.text[first:opened], self.text[first]):
            inner = first + len(quote)
            end = self.closer(quote, inner)
            if end >= 0:
                return "s", end + len(quote), (inner, end)
        if first > start:
            return "name", WORD.match(self.text, start).end(), None
        return "rest", start + 1, None

    def closer(self, quote: str, at: int) -> int:
        """Where the quote that closes a string stands, -1 if there is none.

        The first time that one isn't closed, the closing quotes for all places behind it are found in one pass from the end."""
        if quote not in self.closers:
            if m := INSIDE[quote].match(self.text, at):
                return m.end() - len(quote)
            text, n = self.text, len(self.text)
            found = array("q", [-1]) * (n + 2)
            for i in range(n - 1, at - 1, -1):
                c = text[i]
                if c == "\\":
                    found[i] = found[i + 2] if i + 1 < n else -1
                elif c == quote[0] and text.startswith(quote, i):
                    found[i] = i
                elif c != "\n" or quote not in "\"'":
                    found[i] = found[i + 1]
            self.closers[quote] = found
        return self.closers[quote][at]

    def bare(self, s: int) -> tuple[int, bool, bool] | None:
        """End of the unquoted value at a place, less marks at its end, and whether it has a digit and a letter; None if there is none.

        A run of such characters is read once, wherever in it values begin."""
        if not self.run[0] <= s < self.run[1]:
            m = BARE.match(self.text, s)
            if not m:
                return None
            body = m[0].rstrip(":.")
            digit, letter = DIGIT.search(m[0][::-1]), LETTER.search(m[0][::-1])
            self.run = (s, m.end(), s + len(body), m.end() - 1 - digit.start() if digit else -1, m.end() - 1 - letter.start() if letter else -1)
        _, end, stripped, digit, letter = self.run
        return (stripped if stripped > s else end), digit >= s, letter >= s

    @staticmethod
    def inside(within: tuple[int, int]) -> Piece:
        return (*within, True)

    def skip(self, i: int, lines: bool = False) -> int:
        while i < len(self.tokens) and (self.tokens[i][0] == "blank" or lines and self.tokens[i][0] == "line"):
            i += 1
        return i

    def mark(self, i: int) -> str:
        return self.text[self.tokens[i][1] : self.tokens[i][2]] if i < len(self.tokens) and self.tokens[i][0] == "mark" else ""

    def value(self, i: int, code: bool = True) -> tuple[list[Piece], list[str], int]:
        """Literal pieces, names and the token after the value that starts at token i."""
        pieces: list[Piece] = []
        names: list[str] = []
        deep, want = 0, True
        while True:
            i = self.skip(i, lines=deep > 0)
            if i >= len(self.tokens):
                return pieces, names, i
            kind, s, e, m = self.tokens[i]
            word = self.text[s:e]
            if kind == "s":
                pieces.append(self.inside(m))
                want, i = False, i + 1
            elif kind == "ref":
                names.append(word.strip("${}"))
                want, i = False, i + 1
            elif kind == "mark" and word == "(" and want:
                deep, i = deep + 1, i + 1
            elif kind == "mark" and word == ")" and deep:
                deep, i = deep - 1, i + 1
            elif kind == "mark" and word in ("+", ".", "&") and (pieces or names) and not want:
                j = self.skip(i + 1, lines=True)
                if j >= len(self.tokens) or self.tokens[j][0] not in ("s", "name", "ref"):
                    return pieces, names, i
                want, i = True, j
            elif kind == "rest" and word == "\\" and i + 1 < len(self.tokens) and self.tokens[i + 1][0] == "line":
                i += 2
            elif want and (b := CHAINED.match(self.text, s)):
                names.append(b[1])
                want, i = False, self.at(b.end(1))
            elif want and (b := self.bare(s)):
                if NAME.fullmatch(self.text, s, b[0]):
                    bare = self.text[s : b[0]]
                    if bare.lower() == "new":
                        i += 1
                        continue
                    names.append(bare)
                if not pieces:
                    pieces.append((s, b[0], False))
                    self.mixed[s, b[0]] = b[1] and b[2]
                want, i = False, self.at(b[0])
            else:
                return pieces, names, i

    def at(self, place: int) -> int:
        """The first token that starts at or after a place."""
        while place < len(self.text) and place not in self.starts:
            place += 1
        return self.starts.get(place, len(self.tokens))

    def read(self) -> None:
        text, i, section, fresh = self.text, 0, "", True
        braces: list[int] = []  # the open scopes
        indents: list[tuple[int, int]] = []  # (indentation, scope) of the open blocks, where no brace is open

        def open_scope(around: int, depth: int) -> int:
            if depth >= DEEPEST:
                return around
            self.outer.append(around)
            return len(self.outer) - 1

        while i < len(self.tokens):
            kind, s, e, m = self.tokens[i]
            if fresh and kind != "line":
                width = e - s if kind == "blank" else 0
                rest = self.skip(i)
                if not braces and rest < len(self.tokens) and self.tokens[rest][0] != "line":
                    while indents and indents[-1][0] > width:
                        indents.pop()
                    if width and (not indents or indents[-1][0] < width):
                        indents.append((width, open_scope(indents[-1][1] if indents else 0, len(indents))))
                fresh = False
                if head := SECTION.match(text, s):
                    section, i, fresh = head[1], self.at(head.end()), True
                    continue
            if kind == "line":
                fresh, i = True, i + 1
                continue
            scope = braces[-1] if braces else indents[-1][1] if indents else 0
            word = text[s:e]
            if kind == "mark" and word == "{":
                braces.append(open_scope(scope, len(braces)))
            elif kind == "mark" and word == "}" and braces:
                braces.pop()
            elif kind == "mark" and word == "<":
                if (tag := ELEMENT.match(text, s)) and tag[2].strip():
                    a = tag.start(2) + len(tag[2]) - len(tag[2].lstrip())
                    self.pairs.append((scope, tag[1], [(a, a + len(tag[2].strip()), False)], []))
                i = self.tag(i, scope)
                continue
            elif kind in ("name", "s"):
                i = self.pair(i, scope, section)
                continue
            i += 1

    def tag(self, i: int, scope: int) -> int:
        """Attributes of the tag at token i: pairs of their own, and name and value of the tag's."""
        held: dict[str, Piece] = {}
        i += 1
        while i < len(self.tokens) and self.mark(i) not in ("<", ">") and self.tokens[i][0] != "line":
            kind, s, e, _ = self.tokens[i]
            j = self.skip(i + 1)
            if kind == "name" and self.mark(j) == "=" and (k := self.skip(j + 1)) < len(self.tokens) and self.tokens[k][0] == "s":
                piece = self.inside(self.tokens[k][3])
                held[self.text[s:e].lower()] = piece
                self.pairs.append((scope, self.text[s:e], [piece], []))
                i = k
            i += 1
        label = next((held[k] for k in ("key", "name", "id") if k in held), None)
        if label and "value" in held:
            self.pairs.append((scope, self.text[label[0] : label[1]], [held["value"]], []))
        return i

    def pair(self, i: int, scope: int, section: str) -> int:
        """The pair whose name is token i, if one follows; the token to go on with."""
        text = self.text
        kind, s, e, m = self.tokens[i]
        if kind == "s":
            a, b, _ = self.inside(m)
            name = text[a:b]
            if len(name) > 64 or not NAME.fullmatch(name):
                return i + 1
        else:
            name = text[s:e]
        j = self.skip(i + 1)
        if self.mark(j) == "]":  # config["name"] = ...
            j = self.skip(j + 1)
        sign = self.mark(j)
        if sign == "(" and kind == "name":
            return self.call(i, j, scope, name)
        full = f"{section} {name}" if section else name
        if sign == ":":
            k = self.skip(j + 1)
            if k < len(self.tokens) and (b := BLOCK.match(text, self.tokens[k][1])):
                return self.block(i, b.end(), scope, full)
            if typed := TYPE.match(text, self.tokens[j][1]):
                j = self.at(typed.end()) - 1
                sign = "="
        if sign not in ("=", ":", ":=", "==", "===", "=>"):
            return i + 1
        pieces, names, k = self.value(j + 1)
        if pieces or names:
            self.pairs.append((scope, full, pieces, names))
        # a value that is a name may itself start a pair (a = b = "...", or a label before one)
        first = self.skip(j + 1)
        return first if first < len(self.tokens) and self.tokens[first][0] == "name" else max(k, i + 1)

    def call(self, i: int, j: int, scope: int, name: str) -> int:
        """set_password("...") and put("password", "...")."""
        k = self.skip(j + 1, lines=True)
        if k < len(self.tokens) and self.tokens[k][0] == "s":
            first = self.inside(self.tokens[k][3])
            after = self.skip(k + 1, lines=True)
            label = self.text[first[0] : first[1]]
            if self.mark(after) == "," and len(label) <= 64 and NAME.fullmatch(label):
                pieces, names, _ = self.value(self.skip(after + 1, lines=True))
                self.pairs.append((scope, label, pieces, names))
            elif self.mark(after) == ")" and re.match(r"(?:.*[.>:])?(?:set|with|use)_?[A-Z_a-z]", name):
                self.pairs.append((scope, name, [first], []))
        return i + 1

    def block(self, i: int, start: int, scope: int, name: str) -> int:
        """A YAML block scalar: the lines below that are deeper than the line of its name."""
        text, s = self.text, self.tokens[i][1]
        line = text.rfind("\n", 0, s) + 1
        width = len(text[line:]) - len(text[line:].lstrip(" ")) if line < s else 0
        width = min(width, s - line)
        at, pieces = start, []
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            body = text[at:end]
            inner = body.lstrip(" ")
            if inner and len(body) - len(inner) <= width:
                break
            if inner:
                pieces.append((at + len(body) - len(inner), at + len(body.rstrip()), True))
            at = end + 1
        if pieces:
            self.pairs.append((scope, name, pieces, []))
        return self.at(min(at, len(text)))


def literals(text: str, *, least_score: int = 2, least_length: int = 8) -> list[tuple[int, int, int]]:
    """(start, end, score) of literals that reach a sensitive name, directly or over other names."""
    if not may_score(text):
        return []
    lexed = Lexer(text)
    pairs = lexed.pairs
    held: dict[tuple[int, str], list[int]] = {}
    for k, (scope, name, _, _) in enumerate(pairs):
        held.setdefault((scope, name.rsplit(" ", 1)[-1].lower()), []).append(k)

    def definition(name: str, k: int) -> int:
        """The pair that name means in pair k: in the innermost scope that has it the last one before, else the first after; -1: none."""
        scope, name = pairs[k][0], name.lower()
        while scope >= 0:
            if found := held.get((scope, name)):
                x = bisect_left(found, k)
                if x:
                    return found[x - 1]
                if found[-1] != k:
                    return found[1 if found[0] == k else 0]
            scope = lexed.outer[scope]
        return -1

    scores: dict[int, int] = {}
    ranked = sorted(((name_score(name), -k) for k, (_, name, _, _) in enumerate(pairs)), reverse=True)
    for score, k in ranked:  # the highest first, so that each pair is met once, with the best score that reaches it
        todo = [-k] if score >= least_score else []
        while todo:
            k = todo.pop()
            if k not in scores:
                scores[k] = score
                todo += [x for name in pairs[k][3] if (x := definition(name, k)) >= 0]
    best: dict[tuple[int, int], int] = {}
    for k, score in scores.items():
        _, _, pieces, names = pairs[k]
        if any(definition(name, k) >= 0 for name in names):  # the value is put together with others
            good = [(s, e) for s, e, quoted in pieces if quoted and credential_like(text[s:e], True, least_length)]
        elif len(pieces) == 1 and (at := pieces[0][:2]) in lexed.mixed:  # looked at without a copy: values may overlap
            good = [at] if at[1] - at[0] >= least_length and lexed.mixed[at] and not text.startswith(FOREIGN, at[0]) else []
        else:
            whole = "".join(text[s:e] for s, e, _ in pieces)
            good = [(s, e) for s, e, _ in pieces if s < e] if credential_like(whole, all(q for *_, q in pieces), least_length) else []
        for at in good:
            best[at] = max(score, best.get(at, 0))
    return sorted((s, e, score) for (s, e), score in best.items())


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans as (start, kind number, end), sorted; code points, end exclusive."""
    base = [(m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(BASE) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    more = [(s, 3, e) for s, e, _ in literals(text)]
    return sorted(base), sorted(base + more)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each union of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, *, text: str = "text", mark: str | None = None) -> DataFrame:
    """Add n_assign, n_access, n_hex (long), n_literal (long), base_sha256 and spans (string) to each row.

    With ``mark`` the text column comes back with every span replaced by it."""
    added = ["n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"]
    docs = docs.drop(*added)
    schema = docs.withColumns({c: F.lit(0).cast("long") for c in added[:4]} | {c: F.lit("") for c in added[4:]}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            counts, digests, every, clean = ([], [], [], []), [], [], []
            for value in batch.column(at):
                value = value.as_py()
                base, spans = spans_of(value or "")
                kinds = [k for _, k, _ in spans]
                for k in range(4):
                    counts[k].append(kinds.count(k))
                digests.append(sha256(listed(base).encode()).hexdigest())
                every.append(listed(spans))
                if mark is not None:
                    clean.append(redacted(value, spans, mark) if spans else value)
            columns = list(batch.columns)
            if mark is not None:
                columns[at] = pa.array(clean, batch.schema.field(at).type)
            new = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(every, pa.string())]
            fields = [*batch.schema, *(pa.field(n, c.type) for n, c in zip(added, new, strict=True))]
            yield pa.RecordBatch.from_arrays([*columns, *new], schema=pa.schema(fields))

    return docs.mapInArrow(run, schema)
