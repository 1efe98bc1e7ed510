"""Edit-aware token counts: each document keeps a segment tree over its pre-tokens, and an edit encodes
again only what it touched plus the context that its boundaries depend on."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load
from .common import give_back, ready_for_python

#: Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_pieces = regex.compile(PATTERN)
#: Pre-tokens in a leaf.
_LEAF = 32
#: A pre-token's end depends on at most this many characters behind it.
_AHEAD = 4

Edit = tuple[int, int, str]


class Counter:
    """Tokens of a pre-token, kept for pieces of up to 64 characters in two generations of bounded size."""

    def __init__(self, tokenizer: str, most: int = 200_000):
        self.table, self.most, self.young, self.old = load(tokenizer).table, most, {}, {}

    def __call__(self, piece: str) -> int:
        n = self.young.get(piece) or self.old.get(piece)
        if n is None:
            n = sum(1 for _ in self.table.stream(piece.encode()))
        if len(piece) <= 64:
            if len(self.young) >= self.most:
                self.young, self.old = {}, self.young
            self.young[piece] = n
        return n


class CountTree:
    """A document as leaves of whole pre-tokens under a binary tree of sums of characters and tokens."""

    def __init__(self, text: str, count: Callable[[str], int], leaf: int = _LEAF):
        self.count, self.encoded = count, 0
        pieces = _pieces.findall(text)
        self.n_pieces = len(pieces)
        self.leaves = ["".join(pieces[k : k + leaf]) for k in range(0, len(pieces), leaf)] or [""]
        sums = list(map(count, pieces))
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, t in enumerate(self.leaves):
            self.chars[self.size + k], self.tokens[self.size + k] = len(t), sum(sums[k * leaf : k * leaf + leaf])
        for k in range(self.size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position, and where the leaf begins; the last one that isn't empty for the
        end."""
        position = max(0, min(position, self.chars[1] - 1))
        k, begin = 1, 0
        while k < self.size:
            k *= 2
            if position - begin >= self.chars[k]:
                begin += self.chars[k]
                k += 1
        return min(k - self.size, len(self.leaves) - 1), begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        k = self.size + leaf
        self.chars[k], self.tokens[k] = len(text), tokens
        while k > 1:
            k //= 2
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def replace(self, start: int, stop: int, text: str) -> None:
        """Puts text in place of the characters from start to stop.

        Pre-tokens are found from left to right with no look behind, so those whose end plus one is before
        start stay, and from any old boundary behind the edit that is a boundary again all stay.
        """
        first, begin = self._leaf_at(start - 2)
        last, at = self._leaf_at(max(start, stop - 1))
        touched, end = [first], begin + self.chars[self.size + first]
        while touched[-1] < last:
            k, _ = self._leaf_at(end)
            touched.append(k)
            end += self.chars[self.size + k]
        old = "".join([self.leaves[k] for k in touched])
        new = old[: start - begin] + text + old[stop - begin :]
        more = 1
        while True:
            ahead, place = "", end
            while len(ahead) < _AHEAD and place < self.chars[1]:
                k, _ = self._leaf_at(place)
                ahead += self.leaves[k]
                place += self.chars[self.size + k]
            found, met = [], not ahead
            for m in _pieces.finditer(new + ahead):
                if m.end() > len(new):
                    break
                found.append(m[0])
                met = met or m.end() == len(new)
            if met or not new:
                break
            for _ in range(more):  # twice as many each time, so that what is looked at again stays in proportion
                if end < self.chars[1]:
                    k, _ = self._leaf_at(end)
                    touched.append(k)
                    new += self.leaves[k]
                    end += self.chars[self.size + k]
            more *= 2
        if not new:
            found = []
        self.encoded += len(found)
        # spread over the leaves it came from, so that none gathers its neighbours' text edit by edit
        each = -(-len(found) // len(touched))
        for i, k in enumerate(touched):
            part = found[i * each : (i + 1) * each]
            self._set(k, "".join(part), sum(map(self.count, part)))

    def apply(self, edits: Iterable[Edit]) -> int:
        """Applies edits given in positions of the text as it is, from the last to the first; returns how
        many. Positions outside the text are moved in; of edits that overlap the later gives way."""
        done, size, clean, reach = 0, self.chars[1], [], 0
        for start, stop, text in sorted(edits, key=lambda e: (e[0], e[1])):
            start, stop = max(min(start, size), reach), min(max(start, stop), size)
            if stop < start:
                continue
            clean.append((start, stop, text))
            reach = stop
        for start, stop, text in reversed(clean):
            self.replace(start, stop, text)
            done += 1
        return done


#: What the query's edits look for: addresses, long numbers and long runs of hexadecimal digits. Addresses are
#: found by runs of what a name may hold, so each character is looked at once.
_RUNS = regex.compile(r"[\w.+-]++")
_DOMAIN = re.compile(r"[\w-]++(?:\.[\w-]++)++")
_PRIVATE = regex.compile(r"(?P<key>\b(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{20,}+\b)|(?P<number>\+?\d[\d ().-]{6,}\d)")


def _private(line: str) -> list[tuple[int, int, str]]:
    """Places of personal data: the first from the left counts, an address before what begins with it."""
    found, reach = [], 0
    for run in _RUNS.finditer(line) if "@" in line else ():
        start, stop = max(run.start(), reach), run.end()
        if start < stop and line[stop : stop + 1] == "@" and (m := _DOMAIN.match(line, stop + 1)):
            found.append((start, 0, m.end(), "mail", stop))
            reach = m.end()
    found += [(m.start(), 1, m.end(), m.lastgroup, 0) for m in _PRIVATE.finditer(line)]
    out, reach = [], 0
    for start, _, stop, kind, at in sorted(found):
        if start < reach < at:
            start = reach
        if start >= reach:
            out.append((start, stop, kind))
            reach = stop
    return out


def cleaning_edits(text: str) -> list[Edit]:
    """Personal data and keys by placeholders; lines that repeat an earlier one of the text go."""
    edits: list[Edit] = []
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        stop = at + len(line)
        if line.strip() and line in seen:
            edits.append((max(at - 1, 0), stop, ""))
        else:
            seen.add(line)
            if "@" in line or any(c.isdigit() for c in line):
                edits += [(at + a, at + b, f"[{kind}]") for a, b, kind in _private(line)]
        at = stop + 1
    return edits


_counters: dict[str, Counter] = {}


def count_with_edits(docs: DataFrame, tokenizer: str, edits: Callable[[str], list[Edit]] = cleaning_edits, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_pieces, n_edits, n_tokens_edited, n_encoded_again, n_chars_edited for each row.

    Special tokens count as ordinary text. A null text counts as empty, with no tokens and no edits.
    edits gives (start, stop, replacement) for a text. Repeated rows come out repeated.
    """
    ready_for_python(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["n_tokens", "n_pieces", "n_edits", "n_tokens_edited", "n_encoded_again", "n_chars_edited"]

    def one(value: str) -> tuple:
        if tokenizer not in _counters:
            _counters[tokenizer] = Counter(tokenizer)
        tree = CountTree(value, _counters[tokenizer])
        before, pieces = tree.n_tokens, tree.n_pieces
        done = tree.apply(edits(value))
        return before, pieces, done, tree.n_tokens, tree.encoded, tree.chars[1]

    def run(batches):
        for batch in batches:
            found = [one(x.as_py() or "") for x in batch.column(1)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])
        _counters.clear()
        give_back()

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{n} long" for n in names))
