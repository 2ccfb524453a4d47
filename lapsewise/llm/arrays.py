"""Byte ranges of many texts handled as arrays, for functions that run in tasks."""

import sys
import types

import numpy as np
from pyspark import cloudpickle

# executors unpickle these helpers without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def worker_state(name: str) -> dict:
    """A dictionary that outlives the tasks of a reused worker process."""
    return sys.modules.setdefault(f"_corpus_{name}", types.ModuleType(name)).__dict__.setdefault("held", {})


def ascii_space():
    """Which bytes are U+0020 or U+0009 to U+000D."""
    space = np.zeros(256, bool)
    space[[*range(9, 14), 32]] = True
    return space


def ranges(inside) -> tuple:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def gathered(flat, start, end) -> tuple:
    """The ranges of flat, one after the other, and their sizes."""
    size = end - start
    stop = np.cumsum(size)
    return flat[np.repeat(start - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)], size


def distinct(text, start, end) -> tuple:
    """A first place of each distinct byte range, and the number of each range's content.

    Ranges are told apart by a 64-bit hash from running sums; a second one and the length expose
    different ranges with one hash, which then stand for themselves.
    """
    one, two = (hash_of(text, start, end, which) for which in (0, 1))
    order = np.argsort(one, kind="stable")
    new = np.concatenate([[True], one[order][1:] != one[order][:-1]]) if len(order) else np.zeros(0, bool)
    first, number = order[new], np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    mate = first[number]
    strange = np.flatnonzero((two != two[mate]) | (end - start != (end - start)[mate]))
    number[strange] = len(first) + np.arange(len(strange))
    return np.concatenate([first, strange]), number


def hash_of(text, start, end, which: int):
    letter, power, back = _factors(max(1 << 20, 1 << len(text).bit_length()), which)
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(letter[text] * power[: len(text)], out=total[1:])
    return (total[end] - total[start]) * back[start]


def _factors(size: int, which: int) -> tuple:
    """A number for each byte; powers of an odd factor, and of its inverse, all modulo 2**64."""
    held = worker_state("factors")
    if (size, which) in held:
        return held[size, which]
    random = np.random.Generator(np.random.PCG64(7 + which))
    letter, factor = random.integers(0, 2**64, 256, np.uint64), int(random.integers(0, 2**61)) * 8 + 5
    rows = []
    for x in (factor, pow(factor, -1, 2**64)):
        row = np.full(size, x, np.uint64)
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    if len(held) > 4:
        held.clear()
    held[size, which] = (letter, *rows)
    return held[size, which]
