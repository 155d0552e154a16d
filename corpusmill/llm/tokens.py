"""Token ids by a public tokenizer, encoded part by part and remembered.

A text is cut at boundaries that its pre-tokenizer never crosses, so each part's ids do not depend on its
neighbours.  Strings of added tokens are cut out first, as the library does.  Texts within Latin-1 are cut at spaces, and parts not
known into the pre-tokenizer's own words, which the library's model takes as they are; others at white space, and their parts go through the whole library in batches;
texts with white space on which Python and the library differ are
encoded by the whole library, long ones in pieces cut at single spaces between plain letters or digits.  Parts that are known are looked up.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import tokenizers

#: parts in each of a memory's two generations (about 200 bytes each), and the longest part that is remembered
REMEMBERED, LONGEST = 300_000, 64
#: separators and controls that Python's white space and the library's \s treat differently
_ODD = re.compile("[\x1c-\x1f\x85\u180e\u200b-\u200f\u2028\u2029\ufeff]")
#: those of Latin-1, and white space of Latin-1 before a space
_ODD_LATIN = "\x1c\x1d\x1e\x1f\x85"
_BEFORE_SPACE = tuple(c + " " for c in " \t\n\r\x0b\x0c\xa0")
_SPACED = re.compile(r"\s ")
_UNITS = re.compile(r"\s*\S+|\s+\Z")
#: characters of a piece of a text that only the library can cut, and where it may be cut
PIECE = 1 << 16
_SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
_INNER = re.compile(r"\S\s|\s\s|\s\Z")

#: The letters and numbers of Latin-1, and the two pre-tokenizers' patterns over them.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORDS = re.compile(rf"{_CONTRACTIONS}|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_PREFIXED = re.compile(rf"{_CONTRACTIONS}| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_LETTERS_OF_SPACE = " ".translate(_LETTERS)
#: marks that end words
_MARKS = frozenset(",.;:!?")


def _within_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=4)
def coder(path: str, prefixed: bool, remembered: int | None = None) -> Coder:
    """One Coder a worker process and file."""
    return Coder(path, prefixed, remembered)


class Memory(dict):
    """Ids of parts; what is not known is made. A full memory becomes the older generation, from which parts still in use are taken over."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.make(part)
        if len(part) <= LONGEST:
            self[part] = ids
        return ids

    def turn(self, more: int = 0) -> None:
        if len(self) + more > self.most:
            self.older = dict(self)
            self.clear()


class Coder:
    """prefixed: parts keep the white space before them (byte-level vocabularies); otherwise it is dropped, and letters are lower-cased."""

    def __init__(self, path: str, prefixed: bool, remembered: int | None = None):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.prefixed = prefixed
        added = self.tokenizer.get_added_tokens_decoder()
        contents = sorted((x.content for x in added.values()), key=len, reverse=True)
        self.contents = contents
        self.special = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if added else None
        # a token that takes no white space and has no word bounds parts a text into texts of their own
        self.parting = {x.content: int(i).to_bytes(4, "little") for i, x in added.items()} if not any(x.lstrip or x.rstrip or x.single_word for x in added.values()) else None
        self.model = self.tokenizer.model
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        most = remembered or REMEMBERED
        self.of_word = Memory(self._word, most // 2)
        self.gap, self.before = (" ", _LETTERS_OF_SPACE) if prefixed else ("", "")
        self.of_part = Memory(self._part, most + most // 2)  # it holds the plain words too
        self.of_unit = Memory(lambda unit: self._encoded([unit])[0], most)

    def _word(self, word: str) -> bytes:
        return self._model(word.encode().decode("latin-1").translate(_LETTERS))

    def _model(self, letters: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.model.tokenize(letters)])

    def _part(self, part: str) -> bytes:
        """A part of a text within Latin-1. Letters alone are one word; so are those before one mark, which is another."""
        if part.isalpha():
            return self._model(self.before + part) if part.isascii() else self._word(self.gap + part)
        if part[-1:] in _MARKS and part[:-1].isalpha():
            return self.of_part[part[:-1]] + self.of_word[part[-1]]
        return self._words(self.gap + part)

    def _words(self, text: str) -> bytes:
        """A text within Latin-1 by the pre-tokenizer's words."""
        return b"".join(map(self.of_word.__getitem__, (_PREFIXED if self.prefixed else _WORDS).findall(text)))

    def latin(self, text: str) -> bytes:
        """A text within Latin-1, part by part: what follows a single space begins with it and ends before the next."""
        if not self.prefixed:
            return b"".join(map(self.of_part.__getitem__, text.lower().split()))
        if any(c in text for c in _BEFORE_SPACE):
            return self._words(text)
        first, *rest = text.split(" ")
        return self._words(first) + b"".join(map(self.of_part.__getitem__, rest))

    def segments(self, text: str) -> list[str]:
        """A text, parted at the added tokens' strings, which stand at odd places."""
        return self.special.split(text) if self.parting and any(c in text for c in self.contents) else [text]

    def whole(self, text: str) -> bool:
        if any(c in text for c in _ODD_LATIN) or (not text.isascii() and _ODD.search(text)):
            return True
        return not self.parting and any(c in text for c in self.contents)

    def pieces(self, text: str) -> list[str]:
        """A text that only the library can cut, in pieces whose ids do not depend on each other."""
        out, begin = [], 0
        while len(text) - begin > PIECE and not (not self.parting and self.special):
            at = _SAFE.search(text, begin + PIECE)
            if not at:
                break
            out.append(text[begin : at.start()])
            begin = at.start()
        return [*out, text[begin:]]

    def units(self, text: str) -> list[str]:
        """A text cut at white space only."""
        if not self.prefixed:
            return text.split()
        if _SPACED.search(text):
            return _UNITS.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]

    def learn(self, units: set[str]) -> None:
        """Make the ids of these units known, many at a time."""
        for memory, more in ((self.of_word, 0), (self.of_part, 0), (self.of_unit, len(units))):
            memory.turn(more)
        order = sorted(u for u in units.difference(self.of_unit) if u not in self.of_unit.older)
        for at in range(0, len(order), 4096):
            part = order[at : at + 4096]
            self.of_unit.update((u, x) for u, x in zip(part, self._encoded(part), strict=True) if len(u) <= LONGEST)

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. Parts without inner white space are encoded as one text and cut by offsets: far fewer calls."""
        if self.prefixed:
            plain = [u for u in parts if u[0] == " " and not _INNER.search(u)]
            joined, gap = "".join(plain), 0
        else:
            plain, joined, gap = parts, " ".join(parts), 1
        out: dict[str, bytes] = {}
        if plain:
            got = self.tokenizer.encode(joined, add_special_tokens=False)
            ids = np.array(got.ids, "<u4")
            at = np.array(got.offsets, np.int64).reshape(-1, 2)[:, 0]
            if (np.diff(at) >= 0).all():
                ends = 4 * np.searchsorted(at, np.cumsum([len(u) + gap for u in plain]))
                raw, begin = ids.tobytes(), 0
                for u, end in zip(plain, ends.tolist(), strict=True):
                    out[u] = raw[begin:end]
                    begin = end
        rest = [u for u in parts if u not in out]
        for u, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False) if rest else [], strict=True):
            out[u] = np.array(e.ids, "<u4").tobytes()
        return [out[u] for u in parts]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        units: set[str] = set()
        cut: list[list] = []
        for t in texts:
            parts: list = []
            for k, segment in enumerate(self.segments(t)):
                if k % 2:
                    parts.append(self.parting[segment])
                elif self.whole(segment):
                    parts += [np.array(e.ids, "<u4").tobytes() for e in (self.tokenizer.encode(p, add_special_tokens=False) for p in self.pieces(segment))]
                elif _within_latin(segment):
                    parts.append(self.latin(segment))
                else:
                    parts.append(self.units(segment))
                    units.update(parts[-1])
            cut.append(parts)
        self.learn(units)
        of_unit = self.of_unit
        return [b"".join([p if isinstance(p, bytes) else b"".join([of_unit[u] for u in p]) for p in parts]) for parts in cut]

    def balanced(self, texts: list[str], sizes: list[int], size: int = 1 << 20):
        """ids() over groups of texts of about size bytes; sizes are the texts' own."""
        first, held = 0, 0
        for i, n in enumerate(sizes):
            held += n
            if held >= size:
                yield from self.ids(texts[first : i + 1])
                first, held = i + 1, 0
        if first < len(texts):
            yield from self.ids(texts[first:])
