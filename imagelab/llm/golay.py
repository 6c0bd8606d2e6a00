"""Keys of 23-bit words by the perfect binary Golay code.

Every 23-bit word is within 3 bits of exactly one of the 4,096 codewords. A word within 2 bits of
its codeword has no other within 4; a word at distance 3 has five more at distance 4. The indices
of all codewords within 4 bits are the word's keys: one, or six. Two words that differ in at most
2 bits share a key, because the word half way between them has its codeword within 3 bits of
itself and so within 4 bits of both.
"""

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS, DATA_BITS = 23, 12
CHECK_BITS = BITS - DATA_BITS
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
KEYS = 6
NONE = -1


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of the words modulo the generator; zero for codewords."""
    rest = words.copy()
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


@lru_cache(maxsize=1)
def _error_patterns() -> np.ndarray:
    """(2048, 6) error patterns of up to 4 bits by syndrome, NONE where there are fewer."""
    table = np.full((1 << CHECK_BITS, KEYS), NONE, np.int64)
    filled = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(BITS), weight)], np.int64)
        for pattern, syndrome in zip(patterns.tolist(), _syndromes(patterns).tolist()):
            table[syndrome, filled[syndrome]] = pattern
            filled[syndrome] += 1
    return table


def keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices within 4 bits of each word, NONE where there are fewer."""
    errors = _error_patterns()[_syndromes(words)]
    indices = (words[:, None] ^ errors) >> CHECK_BITS
    return np.where(errors == NONE, NONE, indices)
