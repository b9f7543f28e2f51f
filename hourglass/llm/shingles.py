"""Word shingles of whole batches of texts, as 64-bit hashes in numpy."""

from __future__ import annotations

from functools import lru_cache

#: Bytes of text in a slice of a batch, and hashed at a time: numbers made on the way
#: to the words' hashes take some twenty bytes for each of these.
SLICE, HASHED = 1 << 20, 1 << 17


@lru_cache(maxsize=1)
def _tables():
    import numpy as np
    lower = np.arange(256, dtype="u1")
    lower[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    codes = mixed(np.arange(1, 257, dtype="u8"))[lower]  # a number for each byte, the same for A and a
    return codes, blank


def mixed(x):
    """Spreads 64-bit integers over all bits."""
    import numpy as np
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int):
    import numpy as np
    with np.errstate(over="ignore"):
        up = np.full(n, BASE, "u8")
        down = np.full(n, INVERSE, "u8")
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def _word_hashes(data, breaks):
    """(hash, first byte) of each word in ``data``; a word also begins at
    each of the places ``breaks``."""
    import numpy as np
    codes, blank = _tables()
    n = len(data)
    inside = ~blank[data]
    fresh = np.zeros(n + 1, bool)
    fresh[breaks] = True
    fresh[0] = fresh[n] = True
    before = np.concatenate([[False], inside[:-1]])
    first = np.flatnonzero(inside & (~before | fresh[:n]))
    after = np.concatenate([inside[1:], [False]])
    last = np.flatnonzero(inside & (~after | fresh[1:]))
    up, down = _powers(max(2 * HASHED, 1 << n.bit_length()))  # of one size but for longer words
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(codes[data] * up[:n])])
    words = (sums[last + 1] - sums[first]) * down[first]  # as if each word stood at 0
    return mixed(words + (last - first + 1).astype("u8") * np.uint64(0xD6E8FEB86659FD93)), first


def _batch_words(data, offsets):
    """(word hash, text number) for all words of a batch, in order."""
    import numpy as np
    _, blank = _tables()
    hashes, rows, at, n = [], [], 0, len(data)
    while at < n:
        end = min(n, at + HASHED)
        if end < n:  # cut where no word is: at a blank or where a text begins
            ahead = np.flatnonzero(blank[data[end:end + HASHED]])
            nearest = offsets[np.searchsorted(offsets, end)]
            end = min(int(nearest), end + int(ahead[0]) if len(ahead) else n)
        own = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)]
        h, first = _word_hashes(data[at:end], own - at)
        hashes.append(h)
        rows.append(np.searchsorted(offsets, first + at, side="right") - 1)
        at = end
    if not hashes:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    return np.concatenate(hashes), np.concatenate(rows)


def sliced(batch, *texts: int):
    """A record batch in slices of about 1 MB in its columns ``texts``, so that
    work on a slice needs little memory; a longer text is a slice alone."""
    import numpy as np
    import pyarrow.compute as pc
    size = np.zeros(batch.num_rows)
    for i in texts:
        size += pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(size) // SLICE).astype("i8")
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield batch.slice(lo, hi - lo)


def shingle_sets(column, width: int = 5):
    """(row, hash) of the distinct shingles of an Arrow string column, sorted
    by row and hash, and how many each row has. A text of fewer words has
    one, of all its words."""
    import numpy as np
    import pyarrow as pa
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if n == 0:
        return np.zeros(0, "i8"), np.zeros(0, "u8"), np.zeros(0, "i8")
    column = column.fill_null("") if column.null_count else column
    _, ends, raw = column.buffers()
    offsets = np.frombuffer(ends, "i4")[column.offset:column.offset + n + 1].astype("i8")
    data = np.frombuffer(raw, "u1")[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, "u1")
    h, row = _batch_words(data, offsets - offsets[0])
    with np.errstate(over="ignore"):
        weights = mixed(np.arange(101, 101 + width, dtype="u8")) | np.uint64(1)
        full = np.flatnonzero(row[width - 1:] == row[:len(row) - width + 1]) if len(row) >= width else np.zeros(0, "i8")
        s = np.zeros(len(full), "u8")
        for k in range(width):
            s += h[full + k] * weights[k]
        rows = [row[full]]
        found = [mixed(s)]
        words = np.bincount(row, minlength=n)
        short = np.flatnonzero((words > 0) & (words < width))
        first = np.concatenate([[0], np.cumsum(words)])[short]
        s = words[short].astype("u8") * np.uint64(0xA24BAED4963EE407)
        for k in range(width - 1):
            here = words[short] > k
            s[here] += h[first[here] + k] * weights[k]
        rows.append(short)
        found.append(mixed(s))
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    if len(rows):
        new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])])
        rows, found = rows[new], found[new]
    return rows, found, np.bincount(rows, minlength=n)
