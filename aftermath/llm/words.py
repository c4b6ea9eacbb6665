"""Words and byte strings as 64-bit hashes, many at a time, inside tasks."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts of about this many bytes are hashed at once; a longer text is taken alone.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = bytes(b for b in range(1, 128) if not chr(b).isalnum())


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(name: str, n: int) -> np.ndarray:
    known = _powers[name]
    if len(known) < n:
        size = max(n, CHUNK_BYTES + (1 << 16), 2 * len(known))
        factor = np.full(size, _BASE if name == "up" else _INVERSE, np.uint64)
        factor[0] = 1
        known = _powers[name] = np.multiply.accumulate(factor)
    return known[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums s with s[j] - s[i] = the hash of bytes i to j, times the base to the power i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(_RANDOM[values] * powers("up", len(values)), out=out[1:])
    return out


def hash_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers("down", len(sums))[starts])


def word_table(separators: bytes, lower: bool) -> np.ndarray:
    """For each byte 0 if it parts words, else the byte that counts in its place."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    table[0] = 1
    table[list(separators)] = 0
    return table


def hashed_words(joined: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word."""
    values = table[np.frombuffer(joined, np.uint8)]
    inside = np.zeros(len(values) + 2, np.int8)
    inside[1:-1] = values != 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return hash_between(prefix_hashes(values), starts, ends), starts, ends


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES`` together."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def words_of(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the first word of each text (one more at the end)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    hashes, starts, _ = hashed_words(b"\n".join(texts), table)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return hashes, np.searchsorted(starts, begins)


def column_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def each_bytes(column: pa.Array) -> Iterator[bytes]:
    """As ``column_bytes``, but one text after the other."""
    column = column.cast(pa.binary())
    for i in range(len(column)):
        yield column[i].as_py() or b""


def each_struct(column: pa.ListArray) -> Iterator[dict[str, np.ndarray]]:
    """For each list of structs of numbers its fields as arrays; a null list is an empty one."""
    begin = column.offsets.to_numpy()
    fields = {f.name: column.values.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(column.type.value_type)}
    absent = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        end = begin[i] if absent[i] else begin[i + 1]
        yield {name: values[begin[i] : end] for name, values in fields.items()}


def each_list(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Each list of numbers as an array; no list is null."""
    begin, values = column.offsets.to_numpy().tolist(), column.values.to_numpy()
    for i in range(len(column)):
        yield values[begin[i] : begin[i + 1]]
