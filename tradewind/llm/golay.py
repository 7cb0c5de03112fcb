"""The binary Golay code of 23 bits: nearby codeword indices of a word.

Every 23-bit word has exactly one codeword within three bits. Words at distance three
have five more at distance four. With all of these as keys, two words that differ in at
most two bits share a key (shown for all words in the tests, by syndromes).
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, DATA = 23, 12
CHECK = BITS - DATA
# Fixed value: a generator polynomial of the code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
KEYS = 6


def remainder(word: int) -> int:
    for shift in range(DATA - 1, -1, -1):
        if word >> (shift + CHECK) & 1:
            word ^= GENERATOR << shift
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of each 12-bit value; the near error patterns of each syndrome, -1 padded."""
    check = np.array([remainder(v << CHECK) for v in range(1 << DATA)], dtype=np.int64)
    single = [remainder(1 << i) for i in range(BITS)]
    errors = np.full((1 << CHECK, KEYS), -1, dtype=np.int64)
    filled = np.zeros(1 << CHECK, dtype=int)
    least = np.full(1 << CHECK, 9)
    for weight in range(5):
        for bits in combinations(range(BITS), weight):
            syndrome = 0
            for i in bits:
                syndrome ^= single[i]
            if weight < 4:
                least[syndrome] = weight
            elif least[syndrome] < 3:
                continue
            errors[syndrome, filled[syndrome]] = sum(1 << i for i in bits)
            filled[syndrome] += 1
    return check, errors


def near_indices(words: np.ndarray) -> np.ndarray:
    """Indices of the nearby codewords, one row of six per word, -1 where there is one only."""
    check, errors = tables()
    words = words.astype(np.int64)
    syndrome = (words & ((1 << CHECK) - 1)) ^ check[words >> CHECK]
    near = errors[syndrome]
    return np.where(near < 0, -1, (words[:, None] ^ near) >> CHECK)
