"""Token ids of whole texts with a public tokenizer, word by word.

The tokenizer splits at white space before anything else and drops it, so a text's ids are those of its words in a
row. Words repeat: the ids of the words seen last are kept as packed 32-bit integers, in two generations so that frequent
words outlast rare ones, and a text is put together from them. A new word of common Latin letters is cut into letters, digits and signs as the tokenizer does and its parts go
straight to the tokenizer's model; any other word goes through the whole tokenizer. ``tests/llm`` compare both ways
with encoding whole texts.
"""

from __future__ import annotations

from array import array

import public_tokenizers
import regex
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CACHE_WORDS = 250_000  # words, and parts of words, in a generation; a worker keeps two of each

_END = b"\xff" * 4  # an id that no token has

# Visible ASCII and Latin letters and signs that lower-casing and composition treat one by one.
_OTHER = regex.compile(r"[^\x21-\x7e\xa1-\xffĀ-įı-ſ]")
# The tokenizer's own split pattern, and the line feed.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write a byte: visible ones as they are, the others as the letters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class WordIds(dict):
    """Packed token ids by word. ``learn`` a chunk's words before looking them up."""

    def __init__(self, path: str, plain: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {"\n": _END}
        self.older: dict[bytes, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.special = () if plain else tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())

    def _common(self, text: str) -> bool:
        return not _OTHER.search(text) and not any(s in text for s in self.special)

    def learn(self, words: set[bytes]) -> None:
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        if len(self.parts) >= CACHE_WORDS:
            self.older_parts, self.parts = self.parts, {"\n": _END}
        missing = words - self.keys()
        again = missing & self.older.keys()
        self.update(zip(again, map(self.older.__getitem__, again)))
        fresh = list(missing - again)
        texts = b"\n".join(fresh).decode("utf-8", "replace").split("\n")
        if not self._common(" ".join(texts).replace(" ", "")):
            odd = [not self._common(text) for text in texts]
            for word, text, strange in zip(fresh, texts, odd):
                if strange:
                    ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                    self[word] = array("I", ids).tobytes()
            fresh = [word for word, strange in zip(fresh, odd) if not strange]
            texts = [text for text, strange in zip(texts, odd) if not strange]
        if not fresh:
            return
        # All words in one go: a line feed ends a word, and its id, which no token has, ends the word's ids.
        cut = _SPLIT.findall("\n".join(texts).lower())
        missing_parts = set(cut) - self.parts.keys()
        known = missing_parts & self.older_parts.keys()
        self.parts.update(zip(known, map(self.older_parts.__getitem__, known)))
        for part in missing_parts - known:
            written = part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS)
            self.parts[part] = array("I", [token.id for token in self.model.tokenize(written)]).tobytes()
        self.update(zip(fresh, b"".join(map(self.parts.__getitem__, cut)).split(_END)))


def packed_texts(texts: list[bytes | None], known: WordIds) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of whole texts."""
    split = [text.split() if text else [] for text in texts]
    known.learn(set().union(*split))
    return [b"".join(map(known.__getitem__, words)) for words in split]


_KEPT: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str = TOKENIZER, plain: bool = False) -> WordIds:
    """The worker's cache. ``plain``: the strings of special tokens in a text are ordinary text."""
    if (path, plain) not in _KEPT:
        _KEPT[path, plain] = WordIds(path, plain)
    return _KEPT[path, plain]
