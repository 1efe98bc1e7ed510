"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

The merge list alone fixes how far the end of a text can act backwards. Say that the merges of two
continuations of one prefix differ. The first difference is a rule whose right part starts at the
prefix's end; it moves the leftmost difference left by the length of its left part u. A further rule
moves it on only if the rule comes later in the list and its right part starts with u in some way of
building it (u is on its left spine), because only then do the two runs disagree on whether its right
part is there. So the furthest reach is the longest such chain of rules, weighed by the lengths of
their left parts, found in one pass over the list. Tokens that end at least that far before the end
of what was read are stable: they are emitted, and reading goes on after them.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, ready_for_python

_NONE = 1 << 60
_SHIFT = 21
_LOW = (1 << _SHIFT) - 1
_WORDS, _SPACE = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[\x20\x09-\x0D]")
#: The split pattern of the word vocabulary as its file writes it, and as it reads for lower-case text
#: below U+0180 without spaces and controls. There the normalizer only turns to lower case, and stays there: nothing
#: composes, and U+0130, which would become two characters, is left out.
_WORD_SPLIT = json.dumps(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LATIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]+")
_LETTER, _NUMBER = ("".join(re.escape(chr(c)) for c in range(0x21, 0x180) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
_LATIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself if it is printable
    Latin-1, else the next one free from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(0x100 + n)
    return [table[b] for b in range(256)]


#: The byte that each of these characters stands for.
_BYTE_OF = {s: b for b, s in enumerate(byte_symbols())}


class MergeTable:
    """Vocabulary, ranks and sufficient lookahead of a byte-level BPE file in the tokenizers format."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.last = [vocab.get(s + suffix) for s in symbols]
        #: Pair of ids to rank and made id, each packed into one integer.
        self.pairs: dict[int, int] = {}
        width = dict.fromkeys([x for x in (*self.inner, *self.last) if x is not None], 1)
        #: Left parts of the rules that make a token: the next steps down its left spine.
        lefts: dict[int, tuple[int, ...]] = {}
        reach: dict[int, int] = {}
        self.lookahead = 1
        for rank, (left, right) in enumerate(merges):
            u, v, made = vocab[left], vocab[right], vocab[left + right]
            far, spine = 0, [v]
            while spine:
                x = spine.pop()
                far = max(far, reach.get(x, 0))
                spine += lefts.get(x, ())
            far += width[u]
            reach[u] = max(reach.get(u, 0), far)
            self.lookahead = max(self.lookahead, far)
            self.pairs.setdefault((u << _SHIFT) | v, (rank << _SHIFT) | made)
            width[made] = width[u] + width[v]
            lefts[made] = (*lefts.get(made, ()), u)
        self.longest = max(width.values(), default=1)
        self.window = max(256, 2 * (self.lookahead + self.longest))
        self.width = width

    def merged(self, ids: list[int]) -> list[int]:
        """All merges of one window: the earliest rule first, from left to right."""
        get = self.pairs.get
        found = [get((a << _SHIFT) | b, _NONE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != _NONE:
            k = found.index(best)
            made = ids[k] = best & _LOW
            del ids[k + 1], found[k]
            if k < len(found):
                found[k] = get((made << _SHIFT) | ids[k + 1], _NONE)
            if k:
                found[k - 1] = get((ids[k - 1] << _SHIFT) | made, _NONE)
        return ids

    def stream(self, piece: bytes) -> Iterator[int]:
        """Tokens of one pre-token, each emitted once stable; holds one window of symbols at a time."""
        at, n, window = 0, len(piece), self.window
        while n - at > window:
            part = self.merged([x for b in piece[at : at + window] if (x := self.inner[b]) is not None])
            done = 0
            for token in part:
                if done + self.width[token] > window - self.lookahead:
                    break
                done += self.width[token]
                yield token
            at += done
        ids = [x for b in piece[at : n - 1] if (x := self.inner[b]) is not None]
        if n and (x := self.last[piece[n - 1]]) is not None:
            ids.append(x)
        yield from self.merged(ids)


class Decoder:
    """Ids to text, a token at a time. Without a decoder in the file the tokens are joined by spaces, as
    the library does; a byte-level decoder runs bytes through a UTF-8 state machine that keeps at most
    three pending bytes and puts U+FFFD for what is no text."""

    def __init__(self, pieces: dict[int, str], byte_level: bool):
        self.pieces, self.byte_level = pieces, byte_level
        self.state, self.first = codecs.getincrementaldecoder("utf-8")("replace"), True

    def reset(self) -> None:
        self.state.reset()
        self.first = True

    def feed(self, token: int) -> str:
        piece = self.pieces.get(token)
        if piece is None:
            return ""
        if not self.byte_level:
            return self.joint() + piece
        if all(c in _BYTE_OF for c in piece):
            return self.state.decode(bytes(_BYTE_OF[c] for c in piece))
        return self.state.decode(piece.encode())

    def joint(self) -> str:
        """What stands before the next token of a file without a decoder."""
        joint, self.first = "" if self.first else " ", False
        return joint

    def finish(self) -> str:
        return self.state.decode(b"", final=True) if self.byte_level else ""


def _word_blocks(text: str, size: int = 65_536) -> Iterator[list[str]]:
    """The words of a text, those of about size characters at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        block = text[at : cut.start()] if cut else text[at:]
        at += len(block)
        yield block.split() if not _ODD_SPACE.search(block) else _WORDS.findall(block)


class Transducer:
    """Encoder and decoder of one tokenizer file. Normalizer and pre-tokenizer are the file's own; the
    merges are run by MergeTable. What one white-space-free word gives is kept in a two-generation
    cache of bounded size."""

    def __init__(self, path: str, cache_words: int = 250_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = MergeTable(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        # only for the normalizer and the pre-tokenizer: the library needs no vocabulary for these
        bare = {**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": [], "unk_token": None}}
        library = Tokenizer.from_str(json.dumps(bare))
        self.normalizer, self.pre = library.normalizer, library.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True))) if self.special else None
        pieces = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.pieces, self.byte_level = pieces, (spec.get("decoder") or {}).get("type") == "ByteLevel"
        #: Words can be taken one by one only if the file drops white space before the merges.
        self.by_word = model.get("end_of_word_suffix") is not None
        #: For words alone: made once, as a corpus has more of them than texts.
        self.of_word = Decoder(pieces, self.byte_level)
        self.plain = self.by_word and _WORD_SPLIT in json.dumps(spec["pre_tokenizer"]) and '"Lowercase"' in json.dumps(spec["normalizer"])
        self.plain &= not self.byte_level and None not in (*self.table.inner, *self.table.last)
        self.digits = {i: str(i) for i in pieces} if self.by_word else {}
        self.cache_words = cache_words
        self.forget()

    def forget(self) -> None:
        self.young, self.old, self.pieces_young, self.pieces_old = {}, {}, {}, {}

    def _plain_pieces(self, word: str) -> list[str] | None:
        """The pre-tokens of a word, where no more than lower case is needed for them. Each, taken as a word, is
        its own only pre-token."""
        return _LATIN_PIECES.findall(word.lower()) if self.plain and _LATIN.fullmatch(word) else None

    def _plain_tokens(self, piece: str) -> list[int]:
        raw, table = piece.encode(), self.table
        if len(raw) > table.window:
            return list(table.stream(raw))
        ids = [table.inner[b] for b in raw]
        ids[-1] = table.last[raw[-1]]
        return table.merged(ids)

    def _tokens(self, word: str) -> list[int]:
        pieces = self._plain_pieces(word)
        return list(self._general(word)) if pieces is None else [i for p in pieces for i in self._plain_tokens(p)]

    def _general(self, text: str) -> Iterator[int]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        for piece, _ in self.pre.pre_tokenize_str(text):
            yield from self.table.stream(bytes(_BYTE_OF[c] for c in piece))

    def _piece(self, piece: str) -> tuple[int, str, str]:
        hit = self.pieces_young.get(piece) or self.pieces_old.get(piece)
        if hit is None:
            ids = self._plain_tokens(piece)
            hit = (len(ids), " ".join([self.digits[i] for i in ids]), " ".join([self.pieces[i] for i in ids]))
        if len(piece) <= 64:
            if len(self.pieces_young) >= self.cache_words:
                self.pieces_young, self.pieces_old = {}, self.pieces_young
            self.pieces_young[piece] = hit
        return hit

    def _word(self, word: str) -> tuple[int, str, str]:
        hit = self.young.get(word) or self.old.get(word)
        if hit is None:
            pieces = self._plain_pieces(word)
            if pieces is None:
                ids = self._tokens(word)
                self.of_word.reset()
                hit = (len(ids), " ".join(map(str, ids)), "".join(map(self.of_word.feed, ids)) + self.of_word.finish())
            elif len(pieces) == 1:
                hit = self._piece(pieces[0])
            else:  # words differ by capitals and marks more than their pre-tokens do
                n, ids, text = zip(*map(self._piece, pieces))
                hit = (sum(n), " ".join(ids), " ".join(text))
        if len(word) <= 64:
            if len(self.young) >= self.cache_words:
                self.young, self.old = {}, self.young
            self.young[word] = hit
        return hit

    def _segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        at = 0
        for m in self.split.finditer(text) if self.split else ():
            yield text[at : m.start()], self.special[m[0]]
            at = m.end()
        yield text[at:], None

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a whole text, in order, as they become stable."""
        for segment, special in self._segments(text):
            if self.by_word:
                for m in _WORDS.finditer(segment):
                    yield from self._general(m[0]) if len(m[0]) > self.table.window else self._tokens(m[0])
            elif segment:
                yield from self._general(segment)
            if special is not None:
                yield special

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        decoder = Decoder(self.pieces, self.byte_level)
        for i in ids:
            yield decoder.feed(i)
        yield decoder.finish()

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by spaces, SHA-256 of the decoded text. Beside the text
        memory stays constant: words come in blocks and hashes are fed block by block. A word's ids and what
        the decoder makes of them are remembered together."""
        text, n = text or "", 0
        ids, out = hashlib.sha256(), hashlib.sha256()
        decoder = Decoder(self.pieces, self.byte_level)
        if not self.by_word:
            for i in self.encode(text):
                ids.update((b" " if n else b"") + str(i).encode())
                out.update(decoder.feed(i).encode())
                n += 1
            out.update(decoder.finish().encode())
            return n, ids.hexdigest(), out.hexdigest()
        for segment, special in self._segments(text):
            for words in _word_blocks(segment):
                part = []
                get, add = self.young.get, part.append
                for w in words:
                    hit = get(w)
                    if hit is None:
                        hit = self._word(w)
                        get = self.young.get
                    add(hit)
                part = [x for x in part if x[0]]
                if part:
                    ids.update(((" " if n else "") + " ".join([x[1] for x in part])).encode())
                    out.update((decoder.joint() + " ".join([x[2] for x in part])).encode())
                    n += sum([x[0] for x in part])
            if special is not None:
                ids.update(((" " if n else "") + str(special)).encode())
                out.update(decoder.feed(special).encode())
                n += 1
        return n, ids.hexdigest(), out.hexdigest()


_loaded: dict[str, Transducer] = {}


def load(path: str, cache_words: int = 250_000) -> Transducer:
    """One transducer a file and process."""
    if path not in _loaded:
        _loaded[path] = Transducer(path, cache_words)
    _loaded[path].cache_words = cache_words
    return _loaded[path]


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """docs with an array column of ids. A null text counts as empty and gives no ids."""
    ready_for_python(docs.sparkSession)

    @F.udf("array<int>", useArrow=True)
    def run(value):
        return list(load(tokenizer).encode(value or ""))

    return docs.withColumn(ids, run(F.col(text)))


def decode(docs: DataFrame, tokenizer: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """docs with the text of an array column of ids; null ids are left out, unknown ids give nothing."""
    ready_for_python(docs.sparkSession)

    @F.udf("string", useArrow=True)
    def run(value):
        return "".join(load(tokenizer).decode(i for i in value or () if i is not None))

    return docs.withColumn(text, run(F.col(ids)))


def digests(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", cache_words: int = 250_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row, repeated rows and null ids included.
    cache_words bounds the words whose tokens a worker remembers (twice that, 0.4 KB each). An empty or null text has 0 tokens and the hash of no bytes."""
    ready_for_python(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        engine = load(tokenizer, cache_words)
        for batch in batches:
            found = [engine.digest(x.as_py()) for x in batch.column(1)]
            n, a, b = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        engine.forget()
        give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
