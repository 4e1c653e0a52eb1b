"""A byte-level BPE vocabulary with word ends, and its exact encoder and decoder tables."""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import regex

# Code points that became letters or numbers after Unicode 16, which the vocabulary's
# word pattern takes for symbols.
NEWER = (
    r"՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟝꟢꟱꭬-꭭"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    r"\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    r"\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    r"\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f"
    r"\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# Lower case of letters newer than the standard library's tables.
LOWER = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3}
LOWER |= {0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}

_LATER = regex.compile("[^\\u0000-\\u052F]")  # the shorter pattern does for what comes before
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_ALL_WORDS = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{NEWER}]]+|[\p{{N}}--[{NEWER}]]|(?:[^\s\p{{L}}\p{{N}}]|[{NEWER}])+"
)
WORD_END = "</w>"


def _printable_bytes() -> dict[str, int]:
    """The printable stand-in of every byte: itself where it prints, else the next free code point."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Tables of the backtracking encoder.

    A token is a string over 512 symbols: the 256 bytes, and the 256 bytes at a word's end.
    Tokens are numbered by merge rank; ``ids`` gives the vocabulary's own numbers.
    """

    ids: np.ndarray
    automaton: ahocorasick.Automaton
    shorter: list[int]
    lengths: list[int]
    left: list[int]
    right: list[int]
    pairs: dict[tuple[int, int], int]
    special: dict[str, int]
    texts: np.ndarray
    offsets: np.ndarray
    fitting: dict[int, bool] = field(default_factory=dict)
    cached: dict[str, bytes] = field(default_factory=dict)
    cache_size: int = 400_000  # entries of each cache; a full one starts anew

    @staticmethod
    def parse(source: str, encoder: bool = True) -> Vocabulary:
        """Tables from the text of a tokenizer file; those of the encoder may be left empty."""
        spec = json.loads(source)
        own = spec["model"]["vocab"]
        stand_ins = _printable_bytes()
        names = [c + end for end in ("", WORD_END) for c in sorted(stand_ins, key=stand_ins.get)]
        strings = [chr(i) for i in range(512)]
        rank = {name: i for i, name in enumerate(names)}
        left, right, pairs = list(range(512)), list(range(512)), {}
        for merge in spec["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if a + b in rank:
                raise ValueError(f"two merges make {a + b!r}")
            i, j = rank[a], rank[b]
            rank[a + b] = pairs[i, j] = len(strings)
            strings.append(strings[i] + strings[j])
            names.append(a + b)
            left.append(i)
            right.append(j)
        known = {s: i for i, s in enumerate(strings)}
        automaton = ahocorasick.Automaton()
        if encoder:
            for s, i in known.items():
                automaton.add_word(s, (len(s), i))
            automaton.make_automaton()
        shorter = [] if not encoder else [next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), -1) for s in strings]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        by_id = {own[n]: n for n in names} | {i: s for s, i in special.items()}
        shown = [(by_id.get(i, "") + " ").encode() for i in range(max(by_id) + 1)]
        return Vocabulary(
            ids=np.array([own[n] for n in names], "<u4"),
            automaton=automaton,
            shorter=shorter,
            lengths=[len(s) for s in strings] if encoder else [],
            left=left if encoder else [],
            right=right if encoder else [],
            pairs=pairs if encoder else {},
            special=special,
            texts=np.frombuffer(b"".join(shown), np.uint8),
            offsets=np.cumsum([0, *map(len, shown)]),
        )

    def fits(self, a: int, b: int) -> bool:
        """``compatible``, remembered."""
        key = a << 32 | b
        known = self.fitting.get(key)
        if known is None:
            if len(self.fitting) >= self.cache_size:
                self.fitting.clear()
            known = self.fitting[key] = self.compatible(a, b)
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Would BPE leave tokens ``a`` and ``b`` side by side?

        Undo the later merge of the two sides step by step; a merge across the
        border that comes before what is undone would have been made instead.
        """
        limit = len(self.lengths)
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, self.right[a]
                if a == limit:
                    return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    # ``b`` is one symbol, and so is ``a``, whose number is not larger.
                    return True

    def word(self, text: str) -> bytes:
        """Token ids of one word, as little-endian 32-bit integers.

        At each place the longest token is tried first; if it does not fit behind
        the token before, the next shorter one; if none fits, that token is undone.
        Every place is given up at most once, so the time is linear in the length.
        """
        raw = text.encode()
        symbols = "".join(map(chr, raw[:-1])) + chr(256 + raw[-1])
        size = len(symbols)
        longest, token_at = [0] * size, [-1] * size
        for end, (length, token) in self.automaton.iter(symbols):
            start = end + 1 - length
            if length > longest[start]:
                longest[start], token_at[start] = length, token
        if longest[0] == size:
            return self.ids[token_at[0]].tobytes()
        open_place = [True] * (size + 1)
        tokens: list[int] = []
        place, token = 0, token_at[0]
        while place < size:
            end = place + self.lengths[token]
            if open_place[end] and (not tokens or self.fits(tokens[-1], token)):
                tokens.append(token)
                place = end
                token = token_at[place] if place < size else -1
                continue
            token = self.shorter[token]
            while token < 0:
                open_place[place] = False
                last = tokens.pop()
                place -= self.lengths[last]
                token = self.shorter[last]
        return self.ids[tokens].tobytes()

    def words(self, text: str) -> list[str]:
        """Words of the normal form: composed, lower case, white space dropped."""
        if text.isascii():
            return _WORDS.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = text.translate(LOWER)
            if _LATER.search(text):
                return _ALL_WORDS.findall(text.lower())
        return _WORDS.findall(text.lower())

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        words = self.words(text)
        missing = set(words).difference(self.cached)
        if missing:
            if len(self.cached) + len(missing) > self.cache_size:
                self.cached.clear()
                missing = set(words)
            self.cached.update([(w, self.word(w)) for w in missing])
        return b"".join(map(self.cached.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text; the special tokens' own strings stand for themselves."""
        if not text:
            return np.empty(0, "<u4")
        if not any(s in text for s in self.special):
            return np.frombuffer(self.plain(text), "<u4")
        parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
        out = [
            np.uint32(self.special[p]).astype("<u4").tobytes() if i % 2 else self.plain(p)
            for i, p in enumerate(parts)
        ]
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by spaces, gathered from one buffer by its offsets."""
        if not len(ids):
            return ""
        ids = np.asarray(ids, np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        take = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        return self.texts[take[:-1]].tobytes().decode()
