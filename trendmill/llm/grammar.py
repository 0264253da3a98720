"""Re-Pair grammars of token ids: rules, expansion lengths, and decoding from any place.

A shard's ids become symbols. Rounds replace the most frequent neighbouring pairs by new symbols until
little is gained; each new symbol has a rule of two earlier ones and the number of ids it
stands for. A round takes many pairs at once: where two frequent pairs overlap, the more frequent one
wins, and the other is met again in the next round. Pairs are counted at all places of a shard, whatever its
length, and so are the uses that decide whether a rule stays.
"""

import struct

import numpy as np

from trendmill.llm.word_table import ragged

MAGIC = b"RPG1"
_HEADER = struct.Struct("<4sQIIIQ")
#: Uses a rule must have, pairs that a round replaces, rounds at most.
LEAST_USES, ROUND_RULES, ROUNDS = 4, 8192, 8
#: A round must take away one symbol in so many, else it is the last.
LEAST_GAIN = 40
#: Symbols between two stored places.
STEP = 1024
_SLOT_BITS = 18


def _counted(codes):
    """Distinct codes and how often each stands there."""
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.diff(np.append(first, len(ordered)))


def compress(ids, least_uses=LEAST_USES, rounds=ROUNDS):
    """The bytes of a shard that holds an array of ids from 0."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and ids.max() < 1 << 20:
        used = np.flatnonzero(np.bincount(ids))
        place = np.zeros(int(used[-1]) + 1, np.uint32)
        place[used] = np.arange(len(used))
        places = place[ids]
    else:
        used, places = np.unique(ids, return_inverse=True)
    # Two symbols fit one 32-bit code if there is room for rules below 65,536, else a 64-bit one.
    half, kind = (16, np.uint32) if len(used) <= 49_152 else (32, np.uint64)
    room = (1 << half) - 1 - len(used)
    seq = places.astype(kind)
    lefts, rights, total = [], [], 0
    for _ in range(rounds):
        if len(seq) < 2 or total >= room:
            break
        codes = seq[:-1] << kind(half) | seq[1:]
        pairs, counts = _counted(codes)
        often = np.flatnonzero(counts >= max(2, least_uses))
        most = min(ROUND_RULES, room - total)
        if len(often) > most:
            often = often[np.argpartition(-counts[often], most - 1)[:most]]
        # Rarer pairs are entered first, so that of two in a slot the more frequent one stays.
        often = often[np.argsort(counts[often], kind="stable")]
        if not len(often):
            break
        chosen = pairs[often]
        slots = _slot(chosen)
        rank_of = np.full(1 << _SLOT_BITS, len(often), np.int32)
        code_of = np.zeros(1 << _SLOT_BITS, kind)
        rank_of[slots], code_of[slots] = np.arange(len(often) - 1, -1, -1), chosen
        at = _slot(codes)
        rank = rank_of[at]
        rank[code_of[at] != codes] = len(often)
        better = rank < len(often)
        better[1:] &= rank[1:] < rank[:-1]
        better[:-1] &= rank[:-1] <= rank[1:]
        taken = np.flatnonzero(better)
        rank = rank[taken]
        uses = np.bincount(rank, minlength=len(often))
        kept = uses >= least_uses
        number = np.cumsum(kept) - 1
        stays = kept[rank]
        taken, rank = taken[stays], rank[stays]
        if not len(taken):
            break
        by_rank = chosen[::-1][kept]
        lefts.append(by_rank >> kind(half))
        rights.append(by_rank & kind((1 << half) - 1))
        seq[taken] = (number[rank] + len(used) + total).astype(kind)
        total += len(by_rank)
        left = np.ones(len(seq), bool)
        left[taken + 1] = False
        before, seq = len(seq), seq[left]
        if before - len(seq) < before // LEAST_GAIN:
            break
    left = np.concatenate([np.zeros(0, np.int64), *lefts]).astype(np.int64)
    right = np.concatenate([np.zeros(0, np.int64), *rights]).astype(np.int64)
    sizes = np.ones(len(used) + total, np.int64)
    at = len(used)
    for rules in lefts:
        upto = at + len(rules)
        sizes[at:upto] = sizes[left[at - len(used) : upto - len(used)]] + sizes[right[at - len(used) : upto - len(used)]]
        at = upto
    seq = seq.astype(np.int64)
    begins = np.cumsum(sizes[seq]) - sizes[seq]
    width = "<u2" if len(used) + total <= 1 << 16 else "<u4"
    return b"".join([
        _HEADER.pack(MAGIC, len(ids), len(used), total, len(lefts), len(seq)),
        np.array([len(x) for x in lefts], "<u4").tobytes(), used.astype("<u4").tobytes(),
        left.astype(width).tobytes(), right.astype(width).tobytes(),
        sizes[len(used):].astype("<u4").tobytes(), seq.astype(width).tobytes(),
        begins[::STEP].astype("<u8").tobytes(),
    ])


def _slot(codes):
    """A slot for each code, from the high bits of its product with an odd number."""
    if codes.dtype == np.uint32:
        return ((codes * np.uint32(2654435769)) >> np.uint32(32 - _SLOT_BITS)).astype(np.int64)
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class Shard:
    """A shard's bytes, opened without expanding anything."""

    def __init__(self, data):
        magic, self.n_ids, self.n_used, rules, rounds, symbols = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        width = "<u2" if self.n_used + rules <= 1 << 16 else "<u4"
        self._at = _HEADER.size
        self._data = data
        self.rounds = self._next("<u4", rounds).astype(np.int64)
        self.used = self._next("<u4", self.n_used)
        self.left, self.right = self._next(width, rules), self._next(width, rules)
        self.sizes = np.concatenate([np.ones(self.n_used, np.int64), self._next("<u4", rules)])
        self.seq = self._next(width, symbols)
        self.places = self._next("<u8", -(-symbols // STEP)).astype(np.int64)

    def _next(self, kind, count):
        out = np.frombuffer(self._data, kind, count, self._at)
        self._at += out.nbytes
        return out

    def span(self, start, stop):
        """Ids from ``start`` to before ``stop``, expanding only the symbols that hold them."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        block = int(np.searchsorted(self.places, start, "right")) - 1
        until = int(np.searchsorted(self.places, stop, "left"))
        symbols = self.seq[block * STEP : until * STEP].astype(np.int64)
        ends = self.places[block] + np.cumsum(self.sizes[symbols])
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        symbols = symbols[first : last + 1]
        begin = int(ends[first] - self.sizes[symbols[0]])
        while (rule := symbols >= self.n_used).any():
            twice = np.repeat(symbols, 1 + rule)
            at = (np.cumsum(1 + rule) - 1)[rule]
            twice[at - 1], twice[at] = self.left[symbols[rule] - self.n_used], self.right[symbols[rule] - self.n_used]
            symbols = twice
        return self.used[symbols[start - begin : stop - begin]]

    def all(self):
        """All ids. The expansions of a round's rules are put together from those of earlier rounds."""
        flat, offsets = self.used, np.arange(self.n_used + 1)
        at = 0
        for count in self.rounds.tolist():
            halves = np.empty(2 * count, np.int64)
            halves[::2], halves[1::2] = self.left[at : at + count], self.right[at : at + count]
            places, _ = ragged(offsets, halves)
            flat = np.concatenate([flat, flat[places]])
            sizes = self.sizes[self.n_used + at : self.n_used + at + count]
            offsets = np.concatenate([offsets, offsets[-1] + np.cumsum(sizes)])
            at += count
        places, _ = ragged(offsets, self.seq)
        return flat[places]
