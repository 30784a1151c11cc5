"""Tokens and hashed n-grams for the quality rule and the classifier."""

from __future__ import annotations

import re

import numpy as np

from larder.llm.common import mixed, sequence_hashes, word_hashes

#: Runs of letters, digits and non-ASCII bytes, and runs of ASCII punctuation, of the lower-cased bytes.
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-~]+")


def hashed_ngrams(text: bytes, bits: int) -> np.ndarray:
    """Bucket numbers below 2 ** bits of all unigrams and bigrams of a whole text, repeats included."""
    words = word_hashes(TOKEN.findall(text.lower()))
    both = np.concatenate([mixed(words), sequence_hashes(words, 2)])
    return (both >> np.uint64(64 - bits)).astype(np.int64)
