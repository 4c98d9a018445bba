"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S suffixes (LMS) are sorted by
one induction, named, sorted recursively as a text of names, and a second induction gives the whole array. An induction over
bytes walks over the buckets of the first character, where all entries that are ready induce their left neighbours at once; one
over many names goes entry by entry.
"""

from __future__ import annotations

import numpy as np

from berthlake.llm import arrays

FEW_LETTERS = 512

def _grouped(chars: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by character, each entry's number in its group, the groups' characters and sizes."""
    order = np.argsort(chars, kind="stable")  # a radix sort, as characters have 16 bits
    sizes = np.bincount(chars, minlength=letters)
    kinds = np.flatnonzero(sizes)
    sizes = sizes[kinds]
    return order, np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes), kinds, sizes


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array induced from LMS suffixes in the given order; text ends with a single 0, the smallest character."""
    n = len(text)
    sa = np.full(n, -1, np.int64)
    order, number, kinds, sizes = _grouped(text[lms], len(starts))
    seeds = np.zeros(len(starts), np.int64)
    seeds[kinds] = sizes
    sa[(ends - seeds)[text[lms][order]] + number] = lms[order]

    def put(found: np.ndarray, at: np.ndarray, step: int) -> None:
        chars = text[found]
        if len(found) == 1:
            c = chars[0]
            sa[at[c] if step > 0 else at[c] - 1] = found[0]
            at[c] += step
            return
        order, number, kinds, sizes = _grouped(chars, len(starts))
        base = np.repeat(at[kinds], sizes)
        sa[base + number if step > 0 else base - 1 - number] = found[order]
        at[kinds] += step * sizes

    heads = starts.copy()
    for c in np.flatnonzero(ends > starts).tolist():
        low = starts[c]
        while True:
            ready = sa[low: heads[c]]
            if not len(ready):
                break
            low = heads[c]
            left = ready[ready > 0] - 1
            left = left[~small[left]]
            if len(left):
                put(left, heads, 1)
        left = sa[ends[c] - seeds[c]: ends[c]] - 1
        left = left[(left >= 0)]
        left = left[~small[left]]
        if len(left):
            put(left, heads, 1)

    tails = ends.copy()
    sa[0] = n - 1
    tails[0] = 0
    for c in np.flatnonzero(ends > starts)[::-1].tolist():
        high = ends[c]
        while True:
            ready = sa[tails[c]: high][::-1]
            if not len(ready):
                break
            high = tails[c]
            left = ready[ready > 0] - 1
            left = left[small[left]]
            if len(left):
                put(left, tails, -1)
        left = sa[starts[c]: heads[c]][::-1]
        left = left[left > 0] - 1
        left = left[small[left]]
        if len(left):
            put(left, tails, -1)
    return sa


def _induce_one_by_one(text: np.ndarray, small: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``_induce``, entry by entry: for texts of names, whose many buckets hold an entry or two each."""
    sa = [-1] * len(text)
    chars = text.tolist()
    tails = ends.tolist()
    for i in lms[::-1].tolist():
        tails[chars[i]] -= 1
        sa[tails[chars[i]]] = i
    # by position: the character on its left if that one is to be induced, else -1; the last one stands for empty entries, too
    left = np.roll(text, 1)
    left_small = np.roll(small, 1)
    larger = np.where(left_small, -1, left)
    larger[0] = -1
    heads = starts.tolist()
    larger = larger.tolist() + [-1]
    for i in sa:  # entries put further on are met, too
        c = larger[i]
        if c >= 0:
            sa[heads[c]] = i - 1
            heads[c] += 1
    smaller = np.where(left_small, left, -1)
    smaller[0] = -1
    tails = ends.tolist()
    smaller = smaller.tolist() + [-1]
    for i in reversed(sa):
        c = smaller[i]
        if c >= 0:
            tails[c] -= 1
            sa[tails[c]] = i - 1
    sa[0] = len(text) - 1
    return np.array(sa, np.int64)


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Positions of the sorted suffixes of a text over 1 to ``letters``; a final 0 is added and its suffix left out."""
    few = letters <= FEW_LETTERS
    induce = _induce if few else _induce_one_by_one
    text = np.append(text, 0).astype(np.uint16 if few else np.int64)
    n = len(text)
    if n < 3:
        return np.arange(n - 1)
    change = np.diff(text.astype(np.int64))
    decided = np.where(change != 0, np.arange(n - 1), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    small = np.ones(n, bool)
    inside = decided < n
    small[:-1][inside] = change[decided[inside]] > 0
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    sizes = np.bincount(text, minlength=letters + 1)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = induce(text, small, lms, starts, ends)
    ordered = sa[is_lms[sa]]
    # name the LMS substrings: equal ones, including the LMS character at their end, get the same name
    finish = np.zeros(n, np.int64)
    finish[lms] = np.append(lms[1:], n - 1) + 1
    up, down = arrays.Powers.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    digest = arrays.mix((sums[finish[ordered]] - sums[ordered]) * down[ordered])
    length = finish[ordered] - ordered
    new = np.ones(len(ordered), np.int64)
    new[1:] = (digest[1:] != digest[:-1]) | (length[1:] != length[:-1])
    names = np.cumsum(new)
    del change, decided, inside, sa, finish, sums, digest, length, new  # not held while the names are sorted
    if names[-1] < len(ordered):
        named = np.zeros(n, np.int64)
        named[ordered] = names
        named = named[lms]
        ordered = lms[suffix_array(named, int(names[-1]))]
    return induce(text, small, ordered, starts, ends)[1:]


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, least: int = 1) -> np.ndarray:
    """By text position: bytes that a suffix has in common with the one before it in the suffix array. Of prefixes shorter than
    ``least`` only that is known: the number given is below it, too, and may be less than they have.

    Where the bytes left of both suffixes differ, the prefix is found by bisection on span hashes. Everywhere else it is one
    byte shorter than that of the position on the left, whose predecessor lies one byte to the left, too.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    own = np.ones(n, bool)
    inner = np.flatnonzero(before[1:] > 0) + 1
    own[inner] = data[inner - 1] != data[before[inner] - 1]
    at = np.flatnonzero(own)
    other = before[at]
    low = np.zeros(len(at), np.int64)
    high = np.where(other >= 0, n - np.maximum(at, other), 0)
    sums = arrays.prefix_sums(data)
    todo = np.flatnonzero(high >= least)
    i, j = at[todo], other[todo]
    todo = todo[arrays.span_hashes(sums, i, i + least) == arrays.span_hashes(sums, j, j + least)]
    low[todo] = least
    todo = todo[low[todo] < high[todo]]
    while len(todo):
        middle = (low[todo] + high[todo] + 1) // 2
        i, j = at[todo], other[todo]
        same = arrays.span_hashes(sums, i, i + middle) == arrays.span_hashes(sums, j, j + middle)
        low[todo[same]] = middle[same]
        high[todo[~same]] = middle[~same] - 1
        todo = todo[low[todo] < high[todo]]
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    found = np.zeros(n, np.int64)
    found[at] = low
    return found[last] - (np.arange(n) - last)


def repeated_starts(data: np.ndarray, size: int) -> np.ndarray:
    """True at each position whose next ``size`` bytes also start elsewhere in ``data``: the suffix shares them with the one
    before it in the suffix array, or with the one after."""
    n = len(data)
    out = np.zeros(n, bool)
    if n <= size:
        return out
    sa = suffix_array(data.astype(np.uint16) + np.uint16(1), 256)
    long = permuted_prefixes(data, sa, size) >= size
    out |= long
    out[sa[:-1][long[sa[1:]]]] = True
    return out
