"""Word shingles of whole texts as 64-bit hashes, for many texts at once.

A second, independent hash of each shingle goes into the 128 bits that stand for a whole set.

A word is a maximal run of ASCII letters, digits, underscores and non-ASCII characters, in lower case.
A text of five words or more has a shingle for each five words in a row; a shorter one has one shingle of all
its words; a text without words (null, empty, punctuation) has none.
"""

from __future__ import annotations

import numpy as np
import regex

from shelfpulse.llm.common import mix

SIZE = 5
SIMILAR = 0.8

_word = np.zeros(256, bool)
_word[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_words = regex.compile(r"[0-9A-Za-z_\u0080-\U0010FFFF]+").findall


def words(text: str | None) -> list[str]:
    return _words((text or "").lower())


def shingle_texts(text: str | None, size: int = SIZE) -> set[tuple[str, ...]]:
    """The set of shingles as words, for exact checks."""
    own = words(text)
    return {tuple(own[i: i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


# A Mersenne prime, and four bases below it, two for each of two independent hashes.
PRIME = np.uint64((1 << 31) - 1)
BASES = ((1_234_567_891, 987_654_319), (1_618_033_989, 271_828_183))
START = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))

_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _below(values: np.ndarray) -> np.ndarray:
    """The same modulo PRIME, for values below 2**62."""
    out = (values & PRIME) + (values >> np.uint64(31))
    out = (out & PRIME) + (out >> np.uint64(31))
    out[out == PRIME] = 0
    return out


def _ladder(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i below a power of two of at least `count`, by doubling."""
    size = 1 << max(12, int(count - 1).bit_length())
    if (base, size) not in _powers:
        for key in [key for key in _powers if key[0] == base]:
            del _powers[key]
        made = []
        for factor in (base, pow(base, -1, int(PRIME))):
            out, step = np.ones(1, np.uint64), factor
            while len(out) < size:
                out = np.concatenate([out, _below(out * np.uint64(step))])
                step = step * step % int(PRIME)
            made.append(out)
        _powers[base, size] = made[0], made[1]
    return _powers[base, size]


def word_hashes(joined: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of the bytes of each word: polynomials of two bases modulo a prime, so that no fixed pair of long
    words is alike by construction, as it would be modulo a power of two."""
    out = (stops - starts).astype(np.uint64)
    values = joined.astype(np.uint64)
    for base in BASES[which]:
        up, down = _ladder(base, len(joined) + 1)
        sums = np.zeros(len(joined) + 1, np.uint64)
        terms = values * down[: len(joined)]  # below 2**39, so 2**23 of them stay below 2**62
        np.cumsum(terms if len(terms) < 1 << 23 else _below(terms), out=sums[1:])
        out = mix(out ^ (_below(_below(sums[stops] - sums[starts]) * up[starts]) + START[which]))
    return out


def shingle_hashes(texts: list[str | None], size: int = SIZE, both: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes of all shingles in reading order and where each text's begin (one more at the end); with `both`, between
    them a second hash of each shingle that is independent of the first."""
    data = [(text or "").lower().encode("utf-8", "surrogatepass") for text in texts]
    joined = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter((len(d) + 1 for d in data), np.int64, len(data)))
    inside = _word[joined]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(joined) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, stops = edge[0::2], edge[1::2]
    last = np.searchsorted(starts, ends)  # words up to the end of each text
    first = np.concatenate([[0], last[:-1]])
    count = last - first
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(number)])
    begin = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], number)
    held = np.repeat(np.minimum(count, size), number)
    out = []
    for which in range(1 + both):
        own = word_hashes(joined, starts, stops, which)
        value = mix(held.astype(np.uint64) + START[which])
        for place in range(size):
            more = np.flatnonzero(held > place)
            value[more] = mix(value[more] * np.uint64(3) ^ own[begin[more] + place])
        out.append(value)
    return (*out, offsets)


def _distinct(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]


def shingle_sets(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, offsets = shingle_hashes(texts, size)
    out = []
    for start, stop in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
        own = np.sort(hashes[start:stop])
        out.append(own[_distinct(own)])
    return out


def keyed_sets(texts: list[str | None], size: int = SIZE) -> tuple[list[np.ndarray], list[bytes]]:
    """The sets and 128 bits that tell them apart, half from each of two independent hashes of their shingles."""
    hashes, seconds, offsets = shingle_hashes(texts, size, both=True)
    sets, keys = [], []
    for start, stop in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
        order = np.argsort(hashes[start:stop], kind="stable")
        own = hashes[start:stop][order]
        fresh = _distinct(own)
        sets.append(own[fresh])
        keys.append((mix(sets[-1] ^ START[1]).sum(dtype=np.uint64), seconds[start:stop][order][fresh].sum(dtype=np.uint64)))
    return sets, [row.tobytes() for row in mix(np.array(keys, np.uint64).reshape(-1, 2)).astype(">u8")]
