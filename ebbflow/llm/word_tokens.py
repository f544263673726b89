"""Pre-tokens of the ``word_bpe_49k`` tokenizer and their ids, by whole words.

The library lower-cases a text and splits it into words, single digits and
runs of other characters; each pre-token is then merged on its own. So the ids
of a text are the ids of its pre-tokens, and a pre-token needs merging once.

``prove_whole_tokens`` tells ahead of the texts which vocabulary strings encode alone as
one token: those pre-tokens are looked up, only the rest are merged by the
library. The split below is the library's own one restricted to characters
where both agree by construction (printable ASCII, Latin-1 letters and common
typographic punctuation); a text with any other character, or with the string
of a special token, goes to the library as a whole.
"""

from __future__ import annotations

import re

import numpy as np

# Characters for which lower-casing, NFC and the classes below need no library.
SAFE_TEXT = re.compile("[\t\n\r\x20-\x7e\xa1-\xff–—‘’“”•…€]*")
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
PRE_TOKEN = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
MAX_CACHED_WORDS = 1_000_000  # distinct words that a worker remembers

_LOADED: dict[str, object] = {}


def load_tokenizer(path: str):
    """The library's tokenizer, once per process, without truncation or padding."""
    if path not in _LOADED:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def prove_whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings that are one pre-token and encode alone as exactly one id.

    Every word-final vocabulary entry is turned back into text, must come back
    from the pre-tokenizer unsplit, and must be encoded by the library as its
    own id and nothing else. At most one entry per vocabulary string.
    """
    t = load_tokenizer(path)
    alphabet, suffix = _byte_alphabet(), "</w>"
    words: list[tuple[str, int]] = []
    for piece, token in t.get_vocab(with_added_tokens=False).items():
        if not piece.endswith(suffix) or any(ch not in alphabet for ch in piece[: -len(suffix)]):
            continue
        try:
            word = bytes(alphabet[ch] for ch in piece[: -len(suffix)]).decode()
        except UnicodeDecodeError:
            continue
        if word and SAFE_TEXT.fullmatch(word) and PRE_TOKEN.findall(word) == [word]:
            words.append((word, token))
    encoded = t.encode_batch([w for w, _ in words], add_special_tokens=False)
    return {w: token for (w, token), e in zip(words, encoded, strict=True) if e.ids == [token]}


class Words(dict):
    """Value of each white-space separated word, made on first sight.

    Pre-tokens never cross white space, so a word's value joins those of its
    pre-tokens: whole tokens are there from the start, others are merged. Once
    full the table takes no more words: it holds the frequent ones by then, and
    the others are made each time.
    """

    def __init__(self, library, whole: dict, merged, join):
        super().__init__(whole)
        self.tokenize, self.merged, self.join = library.model.tokenize, merged, join

    def __missing__(self, word: str):
        parts = PRE_TOKEN.findall(word)
        if len(parts) == 1:
            value = self.merged(self.tokenize(_printable(word)))
        else:
            value = self.join([self[p] for p in parts])
        if len(self) < MAX_CACHED_WORDS:
            self[word] = value
        return value


def _printable(word: str) -> str:
    """The word's bytes in the alphabet of byte-level vocabularies."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_PRINTABLE)


_PRINTABLE = {b: ch for ch, b in _byte_alphabet().items()}


class TokenIds:
    """Ids and counts of whole texts."""

    def __init__(self, path: str, whole: dict[str, int]):
        self.library = load_tokenizer(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.counts = Words(self.library, dict.fromkeys(whole, 1), len, sum)
        self.ids = Words(self.library, {w: np.uint32(i).astype("<u4").tobytes() for w, i in whole.items()},
                         lambda tokens: b"".join([t.id.to_bytes(4, "little") for t in tokens]), b"".join)

    def words(self, text: str) -> list[str] | None:
        """Lower-cased words, or None where the library must take the whole text."""
        if not SAFE_TEXT.fullmatch(text) or any(s in text for s in self.special):
            return None
        return text.lower().split()

    def count(self, text: str) -> int:
        words = self.words(text)
        if words is None:
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.counts.__getitem__, words))

    def id_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        words = self.words(text)
        if words is None:
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.ids.__getitem__, words))


def token_ids(path: str) -> TokenIds:
    """One per worker process, so that what it has proved and merged serves its later tasks; the driver loads none."""
    key = f"ids:{path}"
    if key not in _LOADED:
        _LOADED[key] = TokenIds(path, prove_whole_tokens(path))
    return _LOADED[key]
