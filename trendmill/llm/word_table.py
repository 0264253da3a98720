"""Words of many texts as Arrow slices, and values of words that a worker remembers in arrays.

Texts are cut into units in front of white space, at places over which no token of the vocabularies
used here reaches. Arrow's dictionary finds the distinct units of a slab exactly; a value is made
once for each unit and worker, and what belongs to a text is gathered from flat arrays.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units, and bytes of them with their values, after which a worker starts its table anew.
MOST_UNITS, MOST_BYTES = 1_000_000, 128_000_000


def text_slabs(texts, most):
    """``(start, end)`` runs of an Arrow string column with about ``most`` bytes or one text."""
    total = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, "right")))
        yield start, end
        start = end


def _bytes_of(texts):
    """Offsets (from 0) and bytes of an Arrow string column without nulls."""
    texts = pc.cast(texts, pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


_GRAPH = np.zeros(256, bool)
_GRAPH[0x21:0x7F] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def before_blanks(data):
    """Places of a blank (0x20) after a character that is no white space in any table.

    These are printable ASCII and the letters U+00C0 to U+00FF, whose first byte is C3.
    """
    mark = np.zeros(len(data), bool)
    if len(data) > 1:
        solid = _GRAPH[data[:-1]]
        solid[1:] |= (data[:-2] == 0xC3) & (data[1:-1] >= 0x80)
        mark[1:] = (data[1:] == 0x20) & solid
    return mark


def units(texts, cut, last=True):
    """The units of an Arrow string column without nulls, and how many each text has.

    ``cut(data)`` marks the bytes before which a text is cut. Without ``last`` a single byte at a
    text's end stays with the unit before it. An empty text has no unit.
    """
    offsets, data = _bytes_of(texts)
    mark = cut(data)
    sizes = np.diff(offsets)
    if not last:
        ends = offsets[1:][sizes > 1] - 1
        mark[ends] = False
    mark[offsets[:-1][sizes > 0]] = True
    starts = np.flatnonzero(mark)
    counts = np.diff(np.searchsorted(starts, offsets))
    edges = np.append(starts, len(data)).astype(np.int64)
    made = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return made, counts


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def pieces(texts, mark=b"<|"):
    """Units without ASCII white space, for a vocabulary that drops it, lowers case and splits at letters.

    Besides white space, words are cut between an ASCII letter and ASCII punctuation, but not after an
    apostrophe, and not in a word that holds ``mark`` (special tokens begin with it). ASCII letters
    are lowered, unless something other than ASCII follows, which might combine with them.
    """
    offsets, data = _bytes_of(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    blank, letter = _BLANK[data], _LETTER[data]
    solid = _GRAPH[data] & ~letter
    begin = ~blank
    begin[1:] &= blank[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    begin &= ~blank
    inner = np.zeros(len(data), bool)
    inner[1:] = letter[:-1] & solid[1:] | solid[:-1] & letter[1:] & (data[:-1] != 0x27)
    if mark in data.tobytes():
        word = np.cumsum(begin)
        held = np.flatnonzero((data[:-1] == mark[0]) & (data[1:] == mark[1]))
        inner &= ~np.isin(word, word[held])
    lowered = letter & (data < 0x60)
    lowered[:-1] &= data[1:] < 0x80
    data = data + (lowered * np.uint8(32))
    begin |= inner
    kept = ~blank
    place = np.concatenate([[0], np.cumsum(kept)])
    starts = np.flatnonzero(begin)
    counts = np.diff(np.searchsorted(starts, offsets))
    data = data[kept]
    edges = np.append(place[starts], len(data)).astype(np.int64)
    made = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)]
    )
    return made, counts


def ragged(offsets, rows):
    """Places in a flat array of the values of ``rows``, and how many each row has."""
    begin = offsets[rows]
    sizes = offsets[rows + 1] - begin
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - sizes), sizes) + np.arange(total), sizes


class WordTable:
    """Values of units: ``columns`` of one number a unit, ``flat`` values and ``objects``.

    ``compute(units)`` returns a dict with ``sizes`` and ``flat`` (the values of each unit one after the
    other), ``objects`` (a list, or None) and one array for each further name.
    """

    def __init__(self, compute, units=MOST_UNITS, most=MOST_BYTES):
        self.compute, self.units, self.most = compute, units, most
        self._clear()

    def _clear(self):
        self.index, self.held = {}, 0
        self.offsets, self.flat, self.objects, self.columns = np.zeros(1, np.int64), None, [], {}

    def rows_of(self, values):
        """The row of this table for each value of an Arrow string column."""
        if len(self.index) > self.units or self.held > self.most:
            self._clear()
        coded = values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        find = self.index.get
        rows = np.array([find(u, -1) for u in distinct], np.int64)
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown.tolist()]
            rows[unknown] = np.arange(len(self.index), len(self.index) + len(new))
            self._add(new, self.compute(new))
        return rows[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else rows

    def _add(self, new, made):
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        sizes, flat = made.pop("sizes"), made.pop("flat")
        objects = made.pop("objects", None)
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        self.flat = flat if self.flat is None else np.concatenate([self.flat, flat])
        if objects is not None:
            self.objects += objects
            self.held += sum(map(len, objects))
        for name, values in made.items():
            old = self.columns.get(name)
            self.columns[name] = values if old is None else np.concatenate([old, values])
        self.held += sum(map(len, new)) + flat.nbytes
