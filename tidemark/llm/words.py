"""Words of many texts at once, as numpy hashes.

Inside a task an Arrow batch of texts is one run of UTF-8 bytes. White space marks the words. A word's 64-bit hash is made of its
groups of eight bytes, each mixed with its place before they are summed, so that words of up to eight bytes never collide and
longer ones only by chance, whatever their pattern. Running sums of word hashes give a hash to each run of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 4 << 20  # bytes of text handled at a time; a longer text is handled alone
BLOCK = 1 << 20  # powers made at a time
_ONE = np.uint64(1)
_SHIFTS = (np.uint64(30), np.uint64(27), np.uint64(31))
_FACTORS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
GOLDEN = 0x9E3779B97F4A7C15
RUN_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# For learning and matching, everything of ASCII but letters and digits separates words.
MARKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over their range (a bijection)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _SHIFTS[0])
        x *= _FACTORS[0]
        x ^= x >> _SHIFTS[1]
        x *= _FACTORS[1]
        x ^= x >> _SHIFTS[2]
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, BLOCK + 4096), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each text; null texts are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each; a longer text comes alone."""
    _, offsets = text_bytes(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each offset on, as a number; zeros follow the last."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, none of them empty."""
    eights, lengths = _eights(data), ends - starts
    with np.errstate(over="ignore"):
        sums = mix((eights[starts] & _KEEP[np.minimum(lengths, 8)]) + np.uint64(GOLDEN))
        long = np.flatnonzero(lengths > 8)
        if len(long):  # the groups after the first of all longer words, one after another
            more = (lengths[long] - 1) // 8
            begins = np.cumsum(more) - more
            place = np.arange(more.sum()) - np.repeat(begins, more) + 1
            at = np.repeat(starts[long], more) + 8 * place
            left = np.minimum(np.repeat(ends[long], more) - at, 8)
            groups = mix((eights[at] & _KEEP[left]) ^ mix(place.astype(np.uint64) * np.uint64(GOLDEN)))
            sums[long] += np.add.reduceat(groups, begins)
        return mix(sums + lengths.astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, *, lower: bool = False, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, ...]:
    """Words of texts: ``hashes, starts, ends`` (bytes) and ``first``, the index of each text's first word and, last, their number.

    Words end at bytes of ``gaps`` and where texts end. With ``lower``, A-Z count as a-z.
    """
    inside = ~gaps[data]
    cut = np.zeros(len(data) + 1, bool)  # a text starts or ends here
    cut[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:-1]
    closes[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return word_hashes(LOWER[data] if lower else data, starts, ends), starts, ends, np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A hash of every ``length`` consecutive words, by the index of the first; borders of texts are ignored."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    base = RUN_BASES[lane]
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * powers(base, n), out=sums[1:])
        return mix((sums[length:] - sums[:-length]) * powers(_inverse(base), n)[: n - length + 1])


def run_starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at which a run of ``length`` words of one text starts, and the text of each."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(text)) - before[text] + first[:-1][text], text
