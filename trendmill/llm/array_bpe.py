"""Exact byte-pair merging of many pieces at once, in arrays.

Pieces of one length form a matrix of symbols beside the ranks of their neighbouring pairs. Each round
takes every row's leftmost pair of lowest rank, as :meth:`trendmill.llm.bpe.Merges.merge` does, so
all rows lose one symbol a round and the matrix stays full; rows without a pair are done.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa

from trendmill.llm.bpe import Merges, encoder_of
from trendmill.llm.word_table import WordTable, pieces, ragged

#: Bytes up to which pieces are merged in arrays; longer ones keep their pairs in a heap.
LONGEST = 48
_NONE = np.int32(2**31 - 1)
_FILTER_BITS = 22


class ArrayMerges:
    def __init__(self, merges):
        self.merges = merges
        pairs = np.array(list(merges.merged), np.uint64).reshape(-1, 2)
        found = np.array(list(merges.merged.values()), np.int64).reshape(-1, 2)
        keys = pairs[:, 0] << np.uint64(32) | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], found[order, 0].astype(np.int32)
        self.made = np.zeros(len(found), np.int32)
        self.made[found[:, 0]] = found[:, 1]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.keys)] = True
        self.first = np.array([merges.first_inner, merges.first_ended], np.int32)
        all_first = self.first[0]
        grid = [self.rank(np.repeat(all_first, 256), np.tile(then, 256)) for then in self.first]
        #: Ranks of two first symbols, the second without and with word end.
        self.first_ranks = np.stack(grid)

    @staticmethod
    def _slot(keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)

    def rank(self, left, right):
        """Ranks of pairs of symbols, the largest int for pairs without a merge."""
        out = np.full(len(left), _NONE, np.int32)
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        maybe = np.flatnonzero(self.filter[self._slot(keys)])
        asked = keys[maybe]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        hit = self.keys[at] == asked
        out[maybe[hit]] = self.ranks[at[hit]]
        return out

    def encode(self, pieces):
        """Ids of all pieces one after the other, and how many each has."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        joined = np.frombuffer(b"".join(data), np.uint8)
        begins = np.cumsum(lengths) - lengths
        sizes, done = np.zeros(len(data), np.int64), []
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            if length == 0:
                continue
            if length > LONGEST:
                for row in rows.tolist():
                    ids = np.array(self.merges.merge(data[row]), np.int32)
                    sizes[row] = len(ids)
                    done.append((np.array([row]), ids[None]))
                continue
            for some, ids in self._merge(joined[begins[rows][:, None] + np.arange(length)]):
                sizes[rows[some]] = ids.shape[1]
                done.append((rows[some], ids))
        offsets = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int32)
        for rows, ids in done:
            flat[offsets[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, sizes

    def _merge(self, data):
        """Yields ``(rows, ids)`` of a matrix of bytes as rows are done."""
        symbols = np.concatenate([self.first[0][data[:, :-1]], self.first[1][data[:, -1:]]], axis=1)
        pairs = data[:, :-1].astype(np.int64) * 256 + data[:, 1:]
        ranks = self.first_ranks[0][pairs]
        if ranks.shape[1]:
            ranks[:, -1] = self.first_ranks[1][pairs[:, -1]]
        rows = np.arange(len(data))
        while True:
            if ranks.shape[1] == 0:
                yield rows, symbols
                return
            best = ranks.argmin(axis=1)
            at = np.arange(len(rows))
            rank = ranks[at, best]
            over = rank == _NONE
            if over.any():
                yield rows[over], symbols[over]
                go = ~over
                rows, symbols, ranks, best, rank = rows[go], symbols[go], ranks[go], best[go], rank[go]
                at = np.arange(len(rows))
                if not len(rows):
                    return
            symbols[at, best] = self.made[rank]
            symbols = _without(symbols, best + 1)
            ranks = _without(ranks, np.minimum(best, ranks.shape[1] - 1))
            width = ranks.shape[1]
            before = np.flatnonzero(best > 0)
            ranks[before, best[before] - 1] = self.rank(
                symbols[before, best[before] - 1], symbols[before, best[before]]
            )
            after = np.flatnonzero(best < width)
            ranks[after, best[after]] = self.rank(symbols[after, best[after]], symbols[after, best[after] + 1])


def _without(matrix, place):
    """A matrix without the given place of each row."""
    keep = np.ones(matrix.shape, bool)
    keep[np.arange(len(matrix)), place] = False
    return matrix[keep].reshape(len(matrix), matrix.shape[1] - 1)


def unit_encoder(merges, encode):
    """A function for :class:`~trendmill.llm.word_table.WordTable`: ids of units without white space.

    ``encode(pieces)`` returns the ids of all pieces one after the other, and how many each has.
    """
    kind = np.uint16 if max(merges.names) < 1 << 16 else np.uint32

    def pieces_of(unit):
        """Pieces of a unit, and ids of the special tokens among them."""
        out = []
        for part in merges.parts(unit):
            out += merges.pieces(part) if type(part) is str else [part]
        return out

    def compute(texts):
        # Most units are one piece; the others' pieces follow them in ``found``.
        whole = [u.isascii() and u.isalpha() and u.islower() for u in texts]
        others = [i for i, w in enumerate(whole) if not w]
        split = [pieces_of(texts[i]) for i in others]
        number = {}
        code = number.setdefault
        codes = np.zeros(len(texts), np.int64)
        one = np.array(whole, bool)
        codes[one] = [code(u, len(number)) for u, w in zip(texts, whole) if w]
        found = np.array([code(p, len(number)) for some in split for p in some], np.int64)
        per_unit = np.ones(len(texts), np.int64)
        per_unit[others] = [len(some) for some in split]
        order = np.empty(int(per_unit.sum()), np.int64)
        own = np.repeat(one, per_unit)
        order[own], order[~own] = codes[one], found
        special = {k: p for k, p in enumerate(number) if type(p) is int}
        flat, sizes = encode(["" if type(p) is int else p for p in number])
        if special:
            # Specials have no bytes, so a place is made for each.
            places = np.array(list(special))
            flat = np.insert(flat, (np.cumsum(sizes) - sizes)[places], list(special.values()))
            sizes[places] = 1
        at, counts = ragged(np.concatenate([[0], np.cumsum(sizes)]), order)
        ends = np.concatenate([[0], np.cumsum(counts)])
        borders = np.concatenate([[0], np.cumsum(per_unit)])
        return {"sizes": np.diff(ends[borders]), "flat": flat[at].astype(kind)}

    return compute


@lru_cache(maxsize=2)
def table_of(path):
    """The remembered units of a vocabulary file, one table for the life of a worker."""
    merges = Merges(path)
    return WordTable(unit_encoder(merges, ArrayMerges(merges).encode))


class SpeculatedTable:
    """Ids of texts; units not met before are speculated and verified, failing pieces merged in arrays."""

    def __init__(self, path):
        encoder = encoder_of(path)
        exact = ArrayMerges(encoder.merges).encode
        self.units = WordTable(unit_encoder(encoder.merges, lambda found: encoder.encode_flat(found, exact)))

    def flat_of(self, texts):
        """The ids of all texts one after the other, and the places where each text begins and the last ends."""
        found, counts = pieces(pa.array(texts, pa.large_string()))
        rows = self.units.rows_of(found)
        places, sizes = ragged(self.units.offsets, rows)
        flat = self.units.flat[places] if len(places) else np.zeros(0, np.uint16)
        return flat, np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]


@lru_cache(maxsize=2)
def speculated_table_of(path):
    """One table for the life of a worker."""
    return SpeculatedTable(path)
