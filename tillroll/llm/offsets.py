"""Token offsets of byte-level BPE: tokens are the text's bytes in order, so offsets are sums."""

from __future__ import annotations

import base64
import functools

import numpy as np
import tiktoken


class ByteBpe:
    """A tokenizer from a file of ranks; strings of special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each token where its first and last character begin and end.

        Offsets count code points. A character whose bytes lie in several tokens belongs to
        each of them, so the spans of neighbours may overlap by one character.
        """
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.n_bytes[ids])
        starts = ends - self.n_bytes[ids]
        if text.isascii():
            return ids, starts, ends
        data = np.frombuffer(text.encode(), np.uint8)
        # Number of the character that each byte belongs to.
        number = np.cumsum((data & 0xC0) != 0x80) - 1
        return ids, number[starts], number[ends - 1] + 1


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One tokenizer for each worker process."""
    return ByteBpe(path, pattern)


def cut(bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted spans ``bounds[:, 0:2]`` that don't overlap: the first and the last one
    that each token has a character in, by binary search; first > last where there is none."""
    first = np.searchsorted(bounds[:, 1], starts, "right")
    last = np.searchsorted(bounds[:, 0], ends, "left") - 1
    return first, last
