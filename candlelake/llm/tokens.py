"""Token ids of whole texts by the tokenizers library, with each word's ids kept by the worker that met it.

The library's own call takes about one CPU second a megabyte. Here a text is first cut where no token can span the
cut; each piece goes through the library's normalizer, pre-tokenizer and model once and is then looked up.
The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

from candlelake.llm.common import worker_store

#: The white space of the tokenizers' patterns (the Unicode property White_Space).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A space belongs to the word after it; of other white space before a word, all but the last is one piece.
SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
BARE = re.compile(f"[^{WHITE}]+")
AFTER_ONE_SPACE = re.compile(f"\\n?[^{WHITE}]+")
#: Signs that ``str.lower`` and ``str.split`` might treat otherwise than the library does.
NOT_PLAIN = re.compile("[\\x1c-\\x1f\\u0130]|[^\\x00-\\u024f]")
#: A word of Latin letters, perhaps after a space, with ASCII signs but no quote behind it: one token group each.
LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
SIMPLE = re.compile(f"( ?[{LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
MOST_KEPT = 600_000


def byte_letters() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones as they are, others from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


BYTE_LETTERS = byte_letters()

class Encoder:
    """A tokenizer file with the pieces met so far; the store is emptied when it holds ``MOST_KEPT`` pieces."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.encode("A").ids == self.tokenizer.encode("a").ids
        self.kept: dict[str, bytes] = {}
        self.after_space: dict[str, bytes] = {}
        self.drops_white = self._drops_white()

    def _drops_white(self) -> bool:
        return self.tokenizer.encode("a \n b", add_special_tokens=False).ids == [
            *self.tokenizer.encode("a", add_special_tokens=False).ids,
            *self.tokenizer.encode("b", add_special_tokens=False).ids,
        ]

    def _letters(self, word: str) -> bytes:
        """Ids of a word that the pre-tokenizer leaves whole."""
        signs = word.replace(" ", BYTE_LETTERS[32]) if word.isascii() else "".join([BYTE_LETTERS[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        own, simple = self.tokenizer, SIMPLE.fullmatch(piece)
        if simple and (not self.lower or piece.islower()):
            word, signs = simple.groups()
            return self._known(word) + self._known(signs) if signs else self._letters(word)
        if "<" in piece and any(s in piece for s in self.special):
            ids = own.encode(piece, add_special_tokens=False).ids
        else:
            normal = own.normalizer.normalize_str(piece) if own.normalizer else piece
            ids = [t.id for part, _ in own.pre_tokenizer.pre_tokenize_str(normal) for t in own.model.tokenize(part)]
        return array("I", ids).tobytes()

    def _known(self, piece: str) -> bytes:
        ids = self.kept.get(piece)
        if ids is None:
            ids = self.kept[piece] = self._piece(piece)
        return ids

    def _words(self, text: str) -> bytes:
        """For a vocabulary that drops white space: any of it parts two words."""
        plain = text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") or not NOT_PLAIN.search(text)
        pieces = text.lower().split() if plain else BARE.findall(text)
        try:
            return b"".join(map(self.kept.__getitem__, pieces))
        except KeyError:
            return b"".join(map(self._known, pieces))

    def _after_space(self, part: str) -> bytes | None:
        """Ids of what lies between two single spaces, with the first; None where the cut may part a token."""
        ids = self.after_space.get(part)
        if ids is None:
            simple = SIMPLE.fullmatch(part)
            if simple and part[0] != " ":
                word, signs = simple.groups()
                ids = self._after_space(word) + self._known(signs) if signs else self._letters(" " + word)
            elif not AFTER_ONE_SPACE.fullmatch(part):
                return None
            elif part[0] == "\n":
                ids = self._known("\n") + self._known(part[1:])
            else:
                ids = self._piece(" " + part)
            self.after_space[part] = ids
        return ids

    def _spaced(self, text: str) -> bytes:
        """For a vocabulary that keeps white space: the cut is before single spaces and around single line ends."""
        first, *parts = text.replace("\n", " \n").split(" ")
        if first:
            try:
                return self._known(first) + b"".join(map(self.after_space.__getitem__, parts))
            except KeyError:
                found = [self._after_space(part) for part in parts]
                if None not in found:
                    return self._known(first) + b"".join(found)
        return b"".join(map(self._known, SPACED.findall(text)))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<" in text and any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.kept) + len(self.after_space) > MOST_KEPT:
            self.kept.clear()
            self.after_space.clear()
        return self._words(text) if self.drops_white else self._spaced(text)


def encoder(path: str) -> Callable[[str], bytes]:
    """The worker's encoder for a tokenizer file: loaded once for all tasks that the worker runs."""
    kept = worker_store("encoders")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path].encode
