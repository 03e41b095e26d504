"""Elias-Fano sequences in memory-mapped files, read with vectorised numpy.

A nondecreasing sequence of n values below u keeps the low l = log2(u / n) bits of each
packed, and the high parts as a bit vector: a one for each value, a zero for each step of the
high part.  Counts of ones before each word serve select.  Sequences of many parts lie side by side
in one file, so that values of any parts are read in one call, whose time does not grow with the
number of parts.  Each part is written by one task to its own place in the file; a task that runs
twice writes the same bytes there.  In other stores than folders each part is an object of its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np

WORD = np.uint64(64)
_ONE = np.uint64(1)


def _local(path: str) -> str | None:
    """The plain path of a folder that all machines mount; None for other stores."""
    url = urlparse(path)
    return url.path if url.scheme in ("", "file") else None


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file holding the arrays, each at a multiple of 8 bytes after a JSON head."""
    index, at = {}, 0
    for k, a in arrays.items():
        index[k] = [str(a.dtype), len(a), at]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(index).encode()
    head += b" " * (-len(head) % 8)
    blob = [len(head).to_bytes(8, "little"), head]
    for a in arrays.values():
        raw = np.ascontiguousarray(a).tobytes()
        blob += [raw, b"\0" * (-len(raw) % 8)]
    if (local := _local(folder)) is not None:
        os.makedirs(local, exist_ok=True)
        part = f"{local}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.writelines(blob)
        os.replace(part, f"{local}/{name}")
        return
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    part = f"{base}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        for b in blob:
            f.write(b)
    store.move(part, f"{base}/{name}")


def map_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; a file of another store is fetched into a
    nameless local file first, which goes with the mapping."""
    if (local := _local(folder)) is not None:
        raw = np.memmap(f"{local}/{name}", np.uint8, "r")
    else:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        with tempfile.TemporaryFile() as here, store.open_input_stream(f"{base}/{name}") as f:
            while part := f.read(1 << 22):
                here.write(part)
            here.flush()
            raw = np.memmap(here, np.uint8, "r")
    raw = raw.view(np.ndarray)  # plain arrays over the mapping
    size = int(raw[:8].view("<u8")[0])
    index = json.loads(raw[8 : 8 + size].tobytes())
    begin = 8 + size
    out = {}
    for k, (kind, n, at) in index.items():
        width = np.dtype(kind).itemsize
        out[k] = raw[begin + at : begin + at + n * width].view(kind)
    return out


# Place of the set bit number r in each byte value, as _SELECT[8 * value + r].
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_SELECT = np.argsort(1 - _BITS, axis=1, kind="stable").astype(np.uint8).ravel()
_EVERY = np.uint64(0x0101010101010101)


def select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each word: counts of ones up to the end of each
    byte, side by side in one word, tell the byte, and a table the bit.  Of a rank that a word does not
    have, some place is given."""
    rank = rank.astype(np.uint64) & np.uint64(63)
    x = word - ((word >> np.uint64(1)) & np.uint64(0x5555555555555555))
    x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
    x = ((x + (x >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EVERY
    high = np.uint64(0x8080808080808080)
    byte = np.minimum(np.bitwise_count((rank * _EVERY | high) - x & high), 7).astype(np.uint64) << np.uint64(3)
    left = rank - ((x << np.uint64(8)) >> byte & np.uint64(0xFF)) & np.uint64(7)
    value = word >> byte & np.uint64(0xFF)
    return byte.astype(np.int64) + _SELECT[(value << np.uint64(3) | left).astype(np.int64)]


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, one after another, in 64-bit words (one spare)."""
    total = len(values) * width
    out = np.zeros(-(-total // 64) + 1, "<u8")
    if total:
        view = out.view(np.uint8)
        for i in range(0, len(values), 1 << 16):  # 2**16 values end on a word for any width
            part = values[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(part, axis=1, bitorder="little")[:, :width]
            packed = np.packbits(bits.ravel(), bitorder="little")
            at = i * width // 8
            view[at : at + len(packed)] = packed
    return out


def unpack_bits(words: np.ndarray, at: np.ndarray, width: int | np.ndarray, begin: int | np.ndarray = 0) -> np.ndarray:
    """Values number ``at`` of a packed array that starts at word ``begin``; all of one width, or each of its own."""
    width = np.asarray(width, np.uint64)
    bit = at.astype(np.uint64) * width
    i, shift = (bit >> np.uint64(6)).astype(np.int64) + begin, bit & np.uint64(63)
    low = words[i] >> shift
    ends = np.minimum(i + 1, len(words) - 1)  # only a width of 0 has no spare word
    high = np.where(shift == 0, np.uint64(0), words[ends] << ((WORD - shift) & np.uint64(63)))
    return (low | high) & ((_ONE << width) - _ONE)


def shapes(n: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Rows of (values, bits of a low part, words of all low parts, words of the high parts) of
    sequences of ``n`` values up to ``top`` each."""
    rows = []
    for m, t in zip(map(int, n), map(int, top), strict=True):
        l = max(0, (t // max(m, 1)).bit_length() - 1)
        rows.append((m, l, -(-m * l // 64) + 1, -(-((t >> l) + m + 1) // 64)))
    return np.array(rows, np.int64).reshape(-1, 4)


class EliasFano:
    """Nondecreasing sequences of unsigned 64-bit values, one for each part, side by side in the same
    arrays; ``shape`` has a row of ``shapes`` for each.  By default there is one."""

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = "", shape: np.ndarray | None = None):
        self.low, self.high = arrays[f"{prefix}low"], arrays[f"{prefix}high"]
        self.ones, self.zeros = arrays[f"{prefix}ones"], arrays[f"{prefix}zeros"]
        if shape is None:
            shape = np.append(arrays[f"{prefix}meta"], [len(self.low), len(self.high)])[None]
        self.each, self.l = shape[:, 0], shape[:, 1].astype(np.uint64)
        self.before, self.lows, self.highs = (np.append(0, np.cumsum(shape[:, c])) for c in (0, 2, 3))
        self.n = int(self.before[-1])

    @staticmethod
    def build(values: np.ndarray, prefix: str = "", top: int | None = None, before: int = 0, words: int = 0) -> dict[str, np.ndarray]:
        """Arrays of one sequence; ``before`` and ``words``: values and words of high parts in the parts before it."""
        values = values.astype(np.uint64)
        n = len(values)
        top = top if top is not None else int(values[-1]) if n else 0
        l, size = (int(x) for x in shapes([n], [top])[0, [1, 3]])
        bits = np.zeros(64 * size, np.uint8)
        bits[(values >> np.uint64(l)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        ones = before + np.append(0, np.cumsum(np.bitwise_count(high).astype(np.int64)))[:-1]
        return {
            f"{prefix}meta": np.array([n, l], np.int64),
            f"{prefix}low": pack_bits(values, l),
            f"{prefix}high": high,
            f"{prefix}ones": ones,
            f"{prefix}zeros": 64 * (words + np.arange(len(high))) - ones,
        }

    def _select(self, k: np.ndarray, zero: bool, part: int | np.ndarray) -> np.ndarray:
        """Place of a part's one or zero number ``k`` among the part's bits."""
        index, at = (self.zeros, 64 * self.highs[part] - self.before[part]) if zero else (self.ones, self.before[part])
        k = k + at
        i = np.searchsorted(index, k, "right") - 1
        word = self.high[i]
        return 64 * (i - self.highs[part]) + select_in_word(~word if zero else word, k - index[i])

    def get(self, i: np.ndarray, part: int | np.ndarray = 0) -> np.ndarray:
        """Values number ``i`` of the parts."""
        up = (self._select(i, False, part) - i).astype(np.uint64)
        return up << self.l[part] | unpack_bits(self.low, i, self.l[part], self.lows[part])

    def find(self, values: np.ndarray, part: int | np.ndarray = 0) -> np.ndarray:
        """Places of values in the strictly increasing sequences of their parts; -1 where absent."""
        out = np.full(len(values), -1, np.int64)
        values, part = values.astype(np.uint64), np.broadcast_to(part, len(values))
        zeros = 64 * np.diff(self.highs) - self.each
        some = np.flatnonzero((self.each[part] > 0) & (values >> self.l[part] < zeros[part].astype(np.uint64)))
        if not len(some):
            return out
        values, part = values[some], part[some]
        n, l, low = self.each[part], self.l[part], self.lows[part]
        up, want = (values >> l).astype(np.int64), values & ((_ONE << l) - _ONE)
        end = np.minimum(self._select(up, True, part) - up, n)
        begin = np.where(up > 0, self._select(np.maximum(up - 1, 0), True, part) + 1 - up, 0)
        ends, go = end.copy(), np.flatnonzero(begin < end)
        while len(go):  # lower bound among equal high parts
            mid = (begin[go] + end[go]) >> 1
            less = unpack_bits(self.low, mid, l[go], low[go]) < want[go]
            begin[go[less]], end[go[~less]] = mid[less] + 1, mid[~less]
            go = go[begin[go] < end[go]]
        there = np.flatnonzero(begin < ends)  # a value whose high part is the same; the low part decides
        there = there[unpack_bits(self.low, begin[there], l[there], low[there]) == want[there]]
        out[some[there]] = begin[there]
        return out


class Layout:
    """Where arrays of many parts lie in one file: those of one name side by side, in the order of the parts."""

    def __init__(self, arrays: dict[str, tuple[str, np.ndarray]]):
        """``arrays``: kind and each part's length, by name."""
        self.kinds = {k: np.dtype(kind) for k, (kind, _) in arrays.items()}
        self.begins = {k: np.append(0, np.cumsum(n, dtype=np.int64)) for k, (_, n) in arrays.items()}
        self.at, self.size = {}, 0
        for k, begins in self.begins.items():
            self.at[k] = self.size
            self.size += -(-int(begins[-1]) * self.kinds[k].itemsize // 8) * 8

    @staticmethod
    def sequences(shape: np.ndarray, prefix: str = "") -> dict[str, tuple[str, np.ndarray]]:
        """The arrays of Elias-Fano sequences, one for each row of ``shape``."""
        return {f"{prefix}low": ("<u8", shape[:, 2]), **{f"{prefix}{k}": (kind, shape[:, 3]) for k, kind in (("high", "<u8"), ("ones", "<i8"), ("zeros", "<i8"))}}

    def _put(self, f, part: int, arrays: dict[str, np.ndarray]) -> None:
        for k, kind in self.kinds.items():
            begin, end = self.begins[k][part], self.begins[k][part + 1]
            if len(arrays[k]) > end - begin:
                raise ValueError(f"{k} of part {part} has {len(arrays[k])} values, its place {end - begin}")
            f.seek(self.at[k] + int(begin) * kind.itemsize)
            f.write(np.ascontiguousarray(arrays[k], kind).tobytes())

    def write(self, folder: str, name: str, part: int, arrays: dict[str, np.ndarray]) -> None:
        """Writes a part to its place; what its arrays don't fill is zero."""
        if (local := _local(folder)) is None:
            write_arrays(folder, f"{name}-{part}", arrays)
            return
        os.makedirs(local, exist_ok=True)
        with open(os.open(f"{local}/{name}", os.O_RDWR | os.O_CREAT, 0o666), "r+b") as f:
            if os.fstat(f.fileno()).st_size < self.size:
                os.ftruncate(f.fileno(), self.size)  # the same size for all parts
            self._put(f, part, arrays)

    def map(self, folder: str, name: str) -> dict[str, np.ndarray]:
        """The arrays of all parts, memory-mapped; parts in another store are fetched into a nameless local
        file first, which goes with the mapping."""
        if (local := _local(folder)) is not None:
            raw = np.memmap(f"{local}/{name}", np.uint8, "r")
        else:
            with tempfile.TemporaryFile() as here:
                here.truncate(self.size)
                for part in np.flatnonzero(np.any([np.diff(b) > 0 for b in self.begins.values()], axis=0)):
                    self._put(here, int(part), map_arrays(folder, f"{name}-{part}"))
                here.flush()
                raw = np.memmap(here, np.uint8, "r")
        raw = raw.view(np.ndarray)  # plain arrays over the mapping
        return {k: raw[at : at + int(self.begins[k][-1]) * self.kinds[k].itemsize].view(self.kinds[k]) for k, at in self.at.items()}


LEVELS = 4096


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each positive value, codebook of at most LEVELS values); exact if no more
    differ, else bins of the logarithm, half by even steps and half by rank, at their means."""
    distinct, inverse = np.unique(values, return_inverse=True)
    if len(distinct) <= LEVELS:
        return inverse.astype(np.uint16), distinct if len(distinct) else np.ones(1)
    logs = np.log(values)
    half = np.linspace(0, 1, LEVELS // 2 + 1)[1:-1]
    edges = np.unique(np.concatenate([logs.min() + half * (logs.max() - logs.min()), np.quantile(logs, half)]))
    code = np.searchsorted(edges, logs, "right")
    total = np.bincount(code, logs, len(edges) + 1)
    return code.astype(np.uint16), np.exp(total / np.maximum(np.bincount(code, minlength=len(edges) + 1), 1))
