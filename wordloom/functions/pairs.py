"""Counting the neighbouring pairs of records in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pairs that are counted at a time.
PAIRS = 1 << 20

Cells = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def record_cells(words: np.ndarray, sizes: np.ndarray, kinds: int, distance: int, lone: bool, most: int = PAIRS) -> Iterator[Cells]:
    """Record, left word, right word and count of all pairs, both triangles, in that order, piece by piece.

    ``words`` are numbers below ``kinds``, the records of ``sizes`` words one
    after the other.  Places are taken in the order of record and word, as many
    at a time as have ``most`` neighbours, so the pieces follow each other in the order
    of the result: there is nothing to merge, and memory is for ``most`` pairs and the words, whatever the
    records' length, the distance or the number of different pairs.  A word that has more neighbours by itself is
    counted in several steps into one count for each neighbour; a piece never cuts a word's row of the matrix.
    With ``lone`` the words of a record without pairs come with right word -1 and count 0.
    """
    ends = np.cumsum(sizes)
    rec = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    begin, end = (ends - sizes)[rec], ends[rec]
    reach = max(0, min(distance, int(sizes.max(initial=0))))
    first, last = np.maximum(begin, at - reach), np.minimum(end, at + reach + 1)
    alone = (end - begin < 2) | (distance < 1)
    order = np.lexsort((words, rec))
    new = np.concatenate([[True], (rec[order][1:] != rec[order][:-1]) | (words[order][1:] != words[order][:-1])]) if len(order) else np.empty(0, bool)
    starts = np.concatenate([np.flatnonzero(new), [len(order)]])
    work = np.concatenate([[0], np.cumsum((last - first)[order])])
    row, rows = 0, len(starts) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(work[starts], work[starts[row]] + most, "right")) - 1)
        places = order[starts[row] : starts[stop]]
        if stop == row + 1:
            yield from _one_row(places, words, rec, first, last, alone, kinds, lone, most)
        else:
            owner = np.repeat(np.arange(stop - row), np.diff(starts[row : stop + 1]))
            left, right = _neighbours(places, first, last)
            code, n = np.unique(owner[left] * kinds + words[right], return_counts=True)
            of = order[starts[row:stop]]
            held = code // kinds
            cells = rec[of][held], words[of][held], code % kinds, n
            single = of[alone[of]] if lone else of[:0]
            yield _with_lone(cells, rec[single], words[single]) if len(single) else cells
        row = stop


def _neighbours(places: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into places, neighbour's place) of all neighbours."""
    counts = last[places] - first[places]
    left = np.repeat(np.arange(len(places)), counts)
    right = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + first[places][left]
    apart = right != places[left]
    return left[apart], right[apart]


def _one_row(places, words, rec, first, last, alone, kinds, lone, most) -> Iterator[Cells]:
    """The cells of one word of one record; its neighbours are counted a bounded number at a time."""
    work = np.concatenate([[0], np.cumsum((last - first)[places])])
    total = np.zeros(kinds, np.int64) if work[-1] > min(kinds, most) else None
    r = n = np.empty(0, np.int64)
    at = 0
    while at < len(places):
        stop = max(at + 1, int(np.searchsorted(work, work[at] + most, "right")) - 1)
        for lo in range(int(first[places[at]]), int(last[places[at]]), most) if stop == at + 1 else [None]:
            if lo is None:
                _, right = _neighbours(places[at:stop], first, last)
            else:
                right = np.arange(lo, min(lo + most, int(last[places[at]])))
                right = right[right != places[at]]
            if total is None:
                r, n = np.unique(words[right], return_counts=True)
            else:
                total += np.bincount(words[right], minlength=kinds)
        at = stop
    if total is not None:
        r = np.flatnonzero(total)
        n = total[r]
    of = places[0]
    if len(r):
        yield np.full(len(r), rec[of]), np.full(len(r), words[of]), r, n
    elif lone and alone[of]:
        yield np.array([rec[of]]), np.array([words[of]]), np.array([-1]), np.array([0])


def _with_lone(cells: Cells, rec: np.ndarray, left: np.ndarray) -> Cells:
    more = rec, left, np.full(len(rec), -1), np.zeros(len(rec), np.int64)
    both = [np.concatenate(x) for x in zip(cells, more, strict=True)]
    order = np.lexsort((both[2], both[1], both[0]))
    return tuple(x[order] for x in both)
