"""Word-level BPE with word ends: the tokenizer file's own normaliser, splitter,
vocabulary and merges, encoded by a prefix-sharing trie instead of by the
library, so that each distinct word of a batch is encoded once and each shared
prefix once.

Why a trie works: the BPE encoding of a prefix of a word is the encoding of the
word cut at a token border, and the last token of a prefix is the one token
that ends it and may stand after the last token of what precedes it. So a node
of the trie needs one state, its last token; a child needs only its ancestors'.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import regex

#: An encoder remembers so many distinct chunks. Further ones are encoded each
#: time they come, until AFRESH times as many have been; then all are forgotten and
#: the next ones remembered. Bounds on a worker's memory and on stale memory;
#: results don't depend on them.
MAX_WORDS, AFRESH = 500_000, 4
#: Characters that are cut into words at a time.
STRIDE = 2_000_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes
    that print stand for themselves, the others for code points from 256 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


#: Lengths to try where no token of three or more symbols has that ending.
SHORT = (2, 1)


def _ends(tokens: dict[str, int]) -> dict[str, tuple[int, ...]]:
    """For each ending of three symbols the lengths of the tokens that have it,
    longest first, so that few slices are looked up in vain."""
    found: dict[str, set[int]] = {}
    for t in tokens:
        if len(t) >= 3:
            found.setdefault(t[-3:], {1, 2}).add(len(t))
    return {k: tuple(sorted(v, reverse=True)) for k, v in found.items()}


class _Words(dict):
    """Encodings of chunks. An unknown chunk gets a place that is filled in
    before the texts are joined."""

    def __init__(self, start: dict):
        super().__init__(start)
        self.fixed, self.beyond = dict(start), 0
        self.pending: dict[str, bytearray] = {}

    def __missing__(self, chunk: str) -> bytearray:
        return self.pending.setdefault(chunk, bytearray())

    def remember(self) -> None:
        """Takes in the pending chunks, now encoded, or counts them."""
        if len(self) >= MAX_WORDS:
            self.beyond += len(self.pending)
            if self.beyond > AFRESH * MAX_WORDS:
                self.beyond = 0
                self.clear()
                self.update(self.fixed)
        if len(self) < MAX_WORDS:
            self.update([(c, bytes(put)) for c, put in self.pending.items()])


class WordBpe:
    """Encodes texts exactly as the tokenizers library does with this file,
    special tokens in the text included, without added special tokens."""

    def __init__(self, path: str, *, by_library: bool = False):
        self.path, self.by_library, self._library = path, by_library, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != "</w>" or spec["decoder"]:
            raise ValueError("not a word-end BPE file of the known layout")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.between = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.symbols = byte_symbols()
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            pair, made = (self.vocab[a], self.vocab[b]), self.vocab[a + b]
            self.rank.setdefault(pair, r)
            self.halves.setdefault(made, (r, *pair))
        self.size = {i: len(t.removesuffix("</w>")) for t, i in self.vocab.items()}
        self.whole: dict[int, bool] = {}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for t, i in self.vocab.items():
            if self.reachable(i):
                (self.final if t.endswith("</w>") else self.inner)[t.removesuffix("</w>")] = i
        self.inner_ends, self.final_ends = _ends(self.inner), _ends(self.final)
        self.longest = max(3, *map(len, self.inner), *map(len, self.final))
        self.names = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.names[i] = t
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words({i: i.to_bytes(4, "little") for i in self.special.values()})

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE, run on both tokens' symbols, keeps the border between
        them: undo the younger merge step by step and see that at no moment an
        earlier merge was waiting across the border."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known, until = True, float("inf")
            while True:
                across = self.rank.get((left, right))
                if across is not None and across < until:
                    known = False
                    break
                l, r = self.halves.get(left), self.halves.get(right)
                if l is None and r is None:
                    break
                if r is None or (l is not None and l[0] > r[0]):
                    until, left = l[0], l[2]
                else:  # of equal merges the left one runs first, and so before one across the border
                    until, right = r[0] + 0.5, r[1]
            self.pairs[key] = known
        return known

    def reachable(self, token: int) -> bool:
        """Whether BPE makes this token of its own symbols."""
        known = self.whole.get(token)
        if known is None:
            h = self.halves.get(token)
            known = h is None or self.reachable(h[1]) and self.reachable(h[2]) and self._joined(h)
            self.whole[token] = known
        return known

    def _joined(self, half: tuple[int, int, int]) -> bool:
        until, left, right = half
        while True:
            across = self.rank.get((left, right))
            if across is not None and across < until:
                return (left, right) == half[1:]
            l, r = self.halves.get(left), self.halves.get(right)
            if l is None and r is None:
                return True
            if r is None or (l is not None and l[0] > r[0]):
                until, left = l[0], l[2]
            else:
                until, right = r[0] + 0.5, r[1]

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """The trie traversal. Words are symbol strings; sorted order visits
        the trie depth first, `last` holds the states of the path from the root
        and is cut back to the prefix that the next word shares."""
        out: dict[str, list[int]] = {}
        last: list[int] = []  # last[i]: last token of the encoding of the first i+1 symbols
        before, size, state, most = "", self.size, self.state, self.longest
        for word in sorted(words):
            n = len(word)
            shared, limit = 0, min(len(last), n - 1)
            while shared < limit and before[shared] == word[shared]:
                shared += 1
            del last[shared:]
            for i in range(shared + 1, n):
                last.append(state(word[:i] if i <= most else word[i - most : i], i, last, self.inner, self.inner_ends))
            end, ids, i = state(word[-most:], n, last, self.final, self.final_ends), [], n
            while True:
                ids.append(end)
                i -= size[end]
                if i <= 0:
                    break
                end = last[i - 1]
            ids.reverse()
            out[word] = ids
            before = word
        return out

    def state(self, tail: str, n: int, last: list[int], tokens: dict, ends: dict) -> int:
        """The last token of a prefix of n symbols, from its ancestors' states:
        of the tokens that end it, the one that may stand where it would. tail:
        as much of the prefix's end as the longest token may take."""
        pairs = self.pairs
        for k in ends.get(tail[-3:], SHORT):
            if k <= n and (token := tokens.get(tail[-k:])) is not None:
                if k == n:
                    return token
                left = last[n - k - 1]
                fits = pairs.get((left, token))
                if self.may_follow(left, token) if fits is None else fits:
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # the library lowers each letter alone, without a final form
                text = text.replace("Σ", "σ")
        return text.lower()

    def learn(self, pending: dict[str, bytearray]) -> None:
        """Puts the packed uint32 ids of white-space-free chunks in place."""
        if len(self.pairs) > MAX_WORDS:
            self.pairs.clear()
        symbols, parts, words = self.symbols, {}, set()
        if self.by_library:
            found = self.library.encode_batch_fast(list(pending), add_special_tokens=False)
            for put, e in zip(pending.values(), found, strict=True):
                put[:] = array("I", e.ids).tobytes()
        else:
            for c, put in pending.items():
                if not c.isascii() and any(unicodedata.category(x) == "Cn" for x in c):
                    # letters younger than this Python's tables: only the library knows its own
                    put[:] = array("I", self.library.encode(c, add_special_tokens=False).ids).tobytes()
                    continue
                cut = (c,) if c.isascii() and c.isalpha() else self.cut.findall(c)
                parts[c] = cut = [
                    w if w.isascii() and w.isprintable() else "".join([symbols[b] for b in w.encode()]) for w in cut
                ]
                words.update(cut)
            ids = self.encode_words(words)
            for c, cut in parts.items():
                found = ids[cut[0]] if len(cut) == 1 else [i for w in cut for i in ids[w]]
                pending[c][:] = array("I", found).tobytes()
        self.words.remember()

    @property
    def library(self):
        if self._library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def pieces(self, text: str) -> list:
        """The text's chunks in order; special tokens appear as their ids."""
        if self.between and "<|" in text:
            out: list = []
            for part in self.between.split(text):
                if part in self.special:
                    out.append(self.special[part])
                else:
                    out += _split(self.normal(part))
            return out
        return _split(self.normal(text))

    def packed(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        out: list[bytes] = []
        get = self.words.__getitem__
        at = 0
        while at < len(texts):
            chars, coded = 0, []
            while at < len(texts) and (chars == 0 or chars + len(texts[at]) <= STRIDE):
                chars += len(texts[at])
                coded.append(list(map(get, self.pieces(texts[at]))))
                at += 1
            if self.words.pending:
                self.learn(self.words.pending)
                self.words.pending = {}
            out += map(b"".join, coded)
        return out


#: str.split() also breaks at these separators, which Unicode's White_Space lacks.
_ODD = re.compile("[\x1c-\x1f]")


def _split(text: str) -> list[str]:
    return re.findall(r"[\S\x1c-\x1f]+", text) if _ODD.search(text) else text.split()


_held: dict[tuple[str, bool], WordBpe] = {}


def encoder(path: str, *, by_library: bool = False) -> WordBpe:
    """One encoder for each worker process and file. by_library: distinct words
    are encoded by the tokenizers library, not by the trie."""
    key = (path, by_library)
    if key not in _held:
        _held.clear()
        _held[key] = WordBpe(path, by_library=by_library)
    return _held[key]
