"""Space-led units of a text and their memo, for token counting.

A byte-level BPE with the common pattern (contractions, or letters, digits or other signs
after one optional space, or white space) always starts a new pre-token at a single
space between two signs that are no white space. So a text cut there can be encoded piece by
piece, each later piece with its space in front.
"""

import numpy as np

from .rolling import Spans

_SPACE = np.array([chr(i).isspace() for i in range(0x3001)])
LONGEST_KEYED = 64


class Lengths:
    """Summed values of the units of whole texts, with one look-up for each different unit of a slice.

    A unit of up to 64 signs is known by a Rabin-Karp fingerprint of them, worked out for all units at once; a longer one is
    valued by itself. ``known`` are fingerprints and values to start from; what they lack is valued by ``count`` (a
    list of strings to a list of numbers) and remembered, up to ``most`` units besides those of the slice.
    """

    def __init__(self, count, known: dict[int, int], most: int):
        self.count, self.known, self.most = count, known, most
        self.memo = dict(known)

    def of(self, texts: list) -> np.ndarray:
        joined = "".join(t or "" for t in texts)
        sizes = np.array([len(t or "") for t in texts], np.int64)
        row, start, end, keys, signs = spans_of(joined, sizes)
        total = np.zeros(len(texts), np.int64)
        if not len(start):
            return total
        short = end - start <= LONGEST_KEYED
        if not short.all():
            long = np.flatnonzero(~short)
            values = self.count([joined[a:b] for a, b in zip(start[long].tolist(), end[long].tolist())])
            np.add.at(total, row[long], values)
            row, start, end, keys = row[short], start[short], end[short], keys[short]
        units, first, place = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.memo) > self.most:
            self.memo = dict(self.known)
        get = self.memo.get
        found = [get(k, -1) for k in units.tolist()]
        values = np.array(found, np.int64)
        missed = np.flatnonzero(values < 0)
        if len(missed):
            at = first[missed]
            new = self.count([joined[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            values[missed] = new
            self.memo.update(zip(units[missed].tolist(), new))
        return total + np.bincount(row, values[place], len(texts)).astype(np.int64)


def spans_of(joined: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, end and fingerprint of every unit of texts of these sizes that follow each other, and their signs.

    A text is cut before each single space between two signs that are no white space.
    """
    signs = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[np.minimum(signs, len(_SPACE) - 1)]
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    cut = np.zeros(len(signs) + 1, bool)
    if len(signs) > 2:
        cut[1:-2] = (signs[1:-1] == 32) & ~space[:-2] & ~space[2:]
    # the first and last sign of a text have no neighbour there
    edge = starts[:-1][sizes > 0]
    cut[np.maximum(edge - 1, 0)] = False
    cut[edge] = True
    start = np.flatnonzero(cut[:-1])
    end = np.append(start[1:], len(signs))[:len(start)]
    row = np.searchsorted(starts, start, side="right") - 1
    return row, start, end, Spans(signs).of(start, end), signs


def fingerprint(unit: str) -> int:
    """The fingerprint that ``Lengths`` knows a unit by."""
    signs = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
    return int(Spans(signs).of(np.array([0]), np.array([len(signs)]))[0])
