"""Token ids with public tokenizers, memoised by chunk.

The tokenizers split a text into words before they merge anything, and no token crosses such a split. A text is cut at
places that are certain to be splits, each distinct chunk is encoded once by the library, and a text's ids are the
concatenation of its chunks' ids. A memo is bounded: two generations of at most `limit` chunks each, and as many words.
"""

from __future__ import annotations

import os
import re
from struct import pack

import regex

from paceline.llm.common import claim

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

# The word patterns that the two kinds of tokenizer split by.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACED_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: After this many distinct chunks the younger generation of a memo replaces the older one; some 200 bytes for each. The
#: memo of words behind a space, and that of words at the beginning of a line.
MEMO_LIMIT, SPACED_LIMIT, PLAIN_LIMIT = 400_000, 200_000, 50_000


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Memo(dict):
    """Chunk to ids (little-endian unsigned 32-bit integers), filled as chunks are asked for.

    Chunks of plain Latin letters, digits and signs are split by the tokenizer's own word pattern, and each distinct word
    goes straight to the library's model, which skips the costs of a whole encoding; other chunks are encoded whole."""

    _plain = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, tokenizer, words: str, lower: bool, prefix: str = "", limit: int = MEMO_LIMIT):
        super().__init__()
        self.tokenizer, self.prefix, self.limit, self.lower = tokenizer, prefix, limit, lower
        self.tokenize, self.find, self.map = tokenizer.model.tokenize, regex.compile(words).findall, _byte_characters()
        self.space = self.map[0x20]  # of the printable ASCII characters the only one that another stands for
        self.packed = [pack("<I", i) for i in range(tokenizer.get_vocab_size())]
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def rest(self) -> None:
        """Between texts: a full generation becomes the old one."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        if len(self.words) > self.limit:
            self.words.clear()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            spelled = word.replace(" ", self.space) if word.isascii() else "".join([self.map[b] for b in word.encode()])
            packed = self.packed
            ids = self.words[word] = b"".join([packed[t.id] for t in self.tokenize(spelled)])
        return ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isascii() and chunk.isprintable() or self._plain.fullmatch(chunk):
                text = chunk.lower() if self.lower else chunk
                if text.isalpha():
                    ids = self._word(self.prefix + text)
                elif text[:-1].isalpha():  # a word and one sign or digit
                    ids = self._word(self.prefix + text[:-1]) + self._word(text[-1])
                else:
                    ids = b"".join([self._word(w) for w in self.find(self.prefix + text)])
            else:
                found = self.tokenizer.encode(self.prefix + chunk, add_special_tokens=False).ids
                ids = pack(f"<{len(found)}I", *found)
        self[chunk] = ids
        return ids


class WordEncoder:
    """For tokenizers that drop white space: a space or a newline always ends a word."""

    def __init__(self, tokenizer, memory: int = 1):
        self.memo = Memo(tokenizer, WORDS, True, limit=memory * MEMO_LIMIT)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, ids = [], self.memo.__getitem__
        for text in texts:
            self.memo.rest()
            out.append(b"".join(map(ids, text.replace("\n", " ").split(" "))))
        return out


class ByteEncoder:
    """For byte-level tokenizers, whose words take one leading space: a single space or newline between two characters
    that are no white space begins a word."""

    _cut = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
    _other = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"))
    _ascii = tuple(x for x in _other if x.isascii())

    def __init__(self, tokenizer, memory: int = 1):
        self.plain, self.spaced = Memo(tokenizer, SPACED_WORDS, False, "", memory * PLAIN_LIMIT), Memo(tokenizer, SPACED_WORDS, False, " ", memory * SPACED_LIMIT)
        self.newline = self.plain["\n"]

    def _single(self, text: str) -> bool:
        """Whether all white space is single spaces and newlines between words. Searches for what may not be there are cheaper
        than a list of the words."""
        return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in (self._ascii if text.isascii() else self._other))

    def encode(self, texts: list[str]) -> list[bytes]:
        out, plain, spaced = [], self.plain.__getitem__, self.spaced.__getitem__
        for text in texts:
            self.plain.rest()
            self.spaced.rest()
            if self._single(text):
                lines = [iter(line.split(" ")) for line in text.split("\n")]
                out.append(self.newline.join([plain(next(words)) + b"".join(map(spaced, words)) for words in lines]))
            else:
                out.append(b"".join(map(plain, self._cut.split(text))))
        return out


_encoders: dict[tuple[str, int], WordEncoder | ByteEncoder] = {}


def encoder(path: str, memory: int = 1) -> WordEncoder | ByteEncoder:
    """The process's encoder for a tokenizer file; its memos hold `memory` times the limits. Special tokens' strings in a text
    count as ordinary text."""
    claim("tokens", _encoders.clear)
    if (path, memory) not in _encoders:
        _encoders.clear()  # one at a time
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        spaced = tokenizer.encode("a b", add_special_tokens=False).ids
        keeps_space = tokenizer.encode("a  b", add_special_tokens=False).ids != spaced
        found = _encoders[path, memory] = (ByteEncoder if keeps_space else WordEncoder)(tokenizer, memory)
        found.size = tokenizer.get_vocab_size()
    return _encoders[path, memory]
