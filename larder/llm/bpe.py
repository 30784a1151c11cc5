"""Word-level encoding with a public BPE vocabulary, equal to the tokenizers library on whole texts."""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

VOCABULARY = "word_bpe_49k.json"
#: Words kept per generation in a worker; two generations are held.
MEMO = 300_000

#: The vocabulary's pattern for the characters that ``_PLAIN`` lets through; there, Python's classes agree with Unicode's L and N.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Printable ASCII and the Latin letters whose lower case is one character, already composed.
_PLAIN = re.compile(r"[!-~À-įı-ɏ]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: visible bytes stand for themselves, the others for the characters from 256 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts by whitespace-separated words, each encoded once while it stays in the memo.

    ASCII white space always separates: the vocabulary's normaliser and splitter look at no context beyond it, and no special token holds
    any. Plain words go straight to the merges; all others to the library itself.
    """

    def __init__(self, path: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.width = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.alphabet = byte_alphabet()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            symbols = piece if piece.isascii() else "".join(self.alphabet[b] for b in piece.encode())
            found = array(self.width.char, [t.id for t in self.model.tokenize(symbols)]).tobytes()
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def word(self, word: bytes) -> bytes:
        """The ids of one word as packed integers."""
        found = self.old.get(word)
        if found is None and word.isalpha():  # of bytes: ASCII letters only
            found = self._piece(word.lower().decode())
        elif found is None and word[-1:] in (b".", b",") and word[:-1].isalpha():
            found = self._piece(word[:-1].lower().decode()) + self._piece(word[-1:].decode())
        elif found is None:
            text = word.decode()
            if _PLAIN.fullmatch(text) and "<|" not in text:
                found = b"".join(map(self._piece, _PIECE.findall(unicodedata.normalize("NFC", text).lower())))
            else:
                found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        if len(self.young) >= MEMO:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def encode(self, text: bytes) -> np.ndarray:
        young, word = self.young, self.word
        out = [young.get(w) or word(w) for w in text.split()]
        return np.frombuffer(b"".join(out), self.width)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str | None = None) -> WordEncoder:
    """The worker's encoder for a vocabulary file, made once."""
    path = path or vocabulary_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
