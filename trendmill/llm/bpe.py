"""Byte-pair tokens of a vocabulary file with word ends, speculated first and verified.

The file names the vocabulary, the merges in their order and the special tokens. A text is
normalised (NFC, white space, lower case) and split into pieces; each piece is a sequence of byte symbols
whose last one carries the word end. :class:`Merges` holds the vocabulary as byte strings.

Encoding proposes tokens by greedy longest match. Two neighbouring tokens are compatible if the exact
merging of their joined bytes gives these two tokens again, and a sequence is the exact encoding if
every neighbouring pair is compatible. All pairs of the new pieces of a batch are tested at once
against sorted arrays of pairs already decided; only pieces with a failing pair are merged exactly.
"""

import heapq
import json
import unicodedata
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

from trendmill.llm.shared import map_column, map_texts

WORD_END = "</w>"
#: Words a worker remembers in each of two generations, and bytes they may take with their values.
REMEMBERED, REMEMBERED_BYTES = 300_000, 160_000_000
#: Bytes that are reckoned for a word, and for each of its characters, at the most costly value.
_WORD_BYTES, _CHAR_BYTES = 250, 24
#: Pairs of tokens whose verdict a worker remembers.
PAIRS = 2_000_000
#: Symbols up to which exact merging looks over all pairs.
SHORT = 24
_SPACE = regex.compile(r"\s+")


def byte_symbols():
    """The printable character that stands for each byte, printable Latin-1 by itself."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = {}, 256
    for byte in range(256):
        symbols[byte] = chr(byte) if byte in own else chr(spare)
        spare += byte not in own
    return symbols


class Merges:
    """A vocabulary file; ``inner`` and ``ended`` map bytes to ids of tokens without and with word end."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.vocabulary = model["vocab"]
        self.names = {i: t for t, i in self.vocabulary.items()} | {
            i: t for t, i in self.special.items()
        }
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = self.vocabulary
        #: (left id, right id) -> (rank, id of the merged token)
        self.merged = {
            (ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)
        }
        #: token -> rank of the merge that makes it (-1: a single byte), and its two halves
        self.rank = dict.fromkeys(ids.values(), -1)
        self.halves = {}
        for pair, (rank, new) in self.merged.items():
            if new in self.halves or rank <= max(self.rank[pair[0]], self.rank[pair[1]]):
                raise ValueError("merges that repeat a token or come before their parts")
            self.rank[new], self.halves[new] = rank, pair
        symbols = byte_symbols()
        self.first_inner = [ids[symbols[b]] for b in range(256)]
        self.first_ended = [ids[symbols[b] + WORD_END] for b in range(256)]
        back = {ord(s): b for b, s in symbols.items()}
        self.inner, self.ended = {}, {}
        reachable = set(self.first_inner) | set(self.first_ended) | {i for _, i in self.merged.values()}
        for name, i in ids.items():
            if i not in reachable:
                continue
            ended = name.endswith(WORD_END) and name != WORD_END
            body = name[: -len(WORD_END)] if ended else name
            try:
                data = bytes(back[ord(c)] for c in body)
            except KeyError:
                continue
            (self.ended if ended else self.inner)[data] = i
        self.bytes_of = {i: d for d, i in self.inner.items()} | {i: d for d, i in self.ended.items()}
        self.ended_ids = set(self.ended.values())
        self.longest = max(map(len, self.bytes_of.values()))
        self._keep_exact()
        #: Longest token without word end by its first two bytes.
        self.reach = {}
        for data in self.inner:
            self.reach[data[:2]] = max(len(data), self.reach.get(data[:2], 0))

    def _keep_exact(self):
        """Drops tokens that merging their own bytes doesn't give; no encoding contains them."""
        exact = set(self.first_inner) | set(self.first_ended)
        for (left, right), (_, new) in self.merged.items():
            if left in exact and right in exact and self._stay_apart(left, right, joined=True):
                exact.add(new)
        for table in (self.inner, self.ended):
            for data in [d for d, i in table.items() if i not in exact]:
                del table[data]

    def merge(self, data, ended=True):
        """Exact merging: the neighbouring pair of lowest rank first, leftmost among equals."""
        ids = [self.first_inner[b] for b in data]
        if ended:
            ids[-1] = self.first_ended[data[-1]]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids):
        """Looks over all pairs for the next one, which is fastest for a few symbols."""
        find, none = self.merged.get, (len(self.merged), -1)
        found = [find(pair, none) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none or best[1] < 0:
                break
            at = found.index(best)
            ids[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = find((ids[at - 1], ids[at]), none)
            if at < len(found):
                found[at] = find((ids[at], ids[at + 1]), none)
        return ids

    def _merge_long(self, ids):
        """Keeps the pairs in a heap, for a number of symbols that may be large."""
        follow = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        merged = self.merged
        heap = []

        def offer(at):
            then = follow[at]
            found = then >= 0 and merged.get((ids[at], ids[then]))
            if found:
                heapq.heappush(heap, (found[0], at, ids[at], ids[then], found[1]))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, left, right, new = heapq.heappop(heap)
            then = follow[at]
            if ids[at] != left or then < 0 or ids[then] != right:
                continue
            ids[at], ids[then] = new, -1
            follow[at] = follow[then]
            if follow[then] >= 0:
                before[follow[then]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [i for i in ids if i >= 0]

    def compatible(self, left, right):
        """Whether merging the joined bytes of two tokens gives these two again."""
        return self._stay_apart(left, right)

    def _stay_apart(self, a, b, joined=False):
        """Whether no merge crosses the border of two tokens while they are put together.

        The later of the two tokens at the border is taken apart step by step. Each step shows the
        pair that once met there; if its merge comes before the one that took either away, it is
        taken first. Among equal ranks the leftmost goes first. ``joined`` leaves out the pair itself.
        """
        merged, rank, halves = self.merged, self.rank, self.halves
        a_taken = b_taken = len(merged)
        while True:
            found = merged.get((a, b))
            if found and not joined and found[0] < a_taken and found[0] <= b_taken:
                return False
            joined = False
            if rank[a] > rank[b]:
                a_taken, a = rank[a], halves[a][1]
            elif rank[b] >= 0:
                b_taken, b = rank[b], halves[b][0]
            else:
                return True

    def parts(self, text):
        """Words of a text between white space, and its special tokens as ids, in order.

        No piece reaches over white space or a special token.
        """
        if self.split_special is None or not any(s in text for s in self.special):
            return split_at_space(text)
        out = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += split_at_space(part)
        return out

    def pieces(self, word):
        return self.pattern.findall(normalised(word))


def split_at_space(text):
    """Words between Unicode white space, to which the four separators 1C to 1F don't belong."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


def normalised(word):
    """NFC and lower case of a word without white space."""
    return lower(unicodedata.normalize("NFC", word))


def lower(text):
    """Lower case without regard to context: a capital sigma never becomes a final one."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


def propose(merges, data):
    """Greedy longest match from the left; the last token takes the word end."""
    out, at, n = [], 0, len(data)
    while at < n:
        if n - at <= merges.longest and data[at:] in merges.ended:
            out.append(merges.ended[data[at:]])
            break
        for size in range(min(merges.reach.get(data[at : at + 2], 1), n - at - 1), 0, -1):
            found = merges.inner.get(data[at : at + size])
            if found is not None:
                break
        out.append(found)
        at += size
    return out


class Remembered:
    """Values of keys, computed for many at a time; keys not met for a generation are forgotten.

    A generation ends after ``limit`` keys or ``most`` bytes, whichever comes first; only the keys of one
    call are held whatever their size.
    """

    def __init__(self, compute, limit=REMEMBERED, most=REMEMBERED_BYTES):
        self.compute, self.limit, self.most = compute, limit, most
        self.young, self.old, self.held = {}, {}, 0

    def of(self, keys):
        """A dict that has every key of the set ``keys``."""
        new = [k for k in keys if k not in self.young]
        size = _WORD_BYTES * len(new) + _CHAR_BYTES * sum([len(k) for k in new if type(k) is str])
        if new and (len(self.young) + len(new) > self.limit or self.held + size > self.most):
            # A generation of a few large keys isn't worth its memory.
            self.old = self.young if self.held <= self.most else {}
            self.young, self.held, new = {}, 0, list(keys)
            size = _WORD_BYTES * len(new) + _CHAR_BYTES * sum([len(k) for k in new if type(k) is str])
        self.held += size
        unknown = []
        for key in new:
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.young[key] = value
        if unknown:
            self.young.update(zip(unknown, self.compute(unknown)))
        return self.young


class Encoder:
    """Encodes words and pieces in batches; :meth:`encode_pieces` is the vectorised step."""

    def __init__(self, merges):
        self.merges = merges
        self.special_ids = set(merges.special.values())
        self.known_pieces = Remembered(self.encode_pieces)
        self.known_words = Remembered(self.encode_words)
        self.pairs = np.empty(0, np.int64)
        self.verdicts = np.empty(0, bool)
        self.speculated = self.corrected = 0

    def encode_words(self, words):
        """Tuples of the token ids of words without white space or special tokens."""
        split = [self.merges.pieces(w) for w in words]
        known = self.known_pieces.of({p for pieces in split for p in pieces})
        return [
            known[pieces[0]] if len(pieces) == 1 else tuple(i for p in pieces for i in known[p])
            for pieces in split
        ]

    def _speculate(self, data):
        """Proposals for byte strings, one after the other, their sizes, and which have a failing pair."""
        proposals = [propose(self.merges, d) for d in data]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(data)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] << 32 | flat[1:])[inside]
        failed = np.zeros(len(data), bool)
        failed[owner[1:][inside][~self._verdict(pairs)]] = True
        self.speculated += len(data)
        self.corrected += int(failed.sum())
        return flat, sizes, failed

    def encode_pieces(self, pieces):
        """Exact tokens of pieces: proposals whose pairs all pass, exact merging for the rest."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        flat, sizes, failed = self._speculate(data)
        flat, ends = flat.tolist(), np.cumsum(sizes).tolist()
        return [
            tuple(self.merges.merge(d) if bad else flat[end - size : end])
            for d, size, end, bad in zip(data, sizes.tolist(), ends, failed.tolist())
        ]

    def encode_flat(self, pieces, exact):
        """As :meth:`encode_pieces`, but all ids in one array, and how many each piece has.

        ``exact(pieces)`` merges the failing pieces exactly and returns the same.
        """
        flat, sizes, failed = self._speculate([p.encode("utf-8", "surrogatepass") for p in pieces])
        if not failed.any():
            return flat, sizes
        merged, merged_sizes = exact([pieces[i] for i in np.flatnonzero(failed).tolist()])
        passed = flat[np.repeat(~failed, sizes)]
        sizes[failed] = merged_sizes
        out, mended = np.empty(int(sizes.sum()), np.int64), np.repeat(failed, sizes)
        out[mended], out[~mended] = merged, passed
        return out, sizes

    def _verdict(self, pairs):
        """Which pairs are compatible; pairs not met before are decided once."""
        asked, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.pairs, asked)
        known = np.zeros(len(asked), bool)
        inside = at < len(self.pairs)
        known[inside] = self.pairs[at[inside]] == asked[inside]
        fresh = asked[~known]
        if len(fresh) and len(self.pairs) + len(fresh) > PAIRS:
            self.pairs, self.verdicts = np.empty(0, np.int64), np.empty(0, bool)
            fresh = asked
        if len(fresh):
            decided = np.array([self.merges.compatible(p >> 32, p & 0xFFFFFFFF) for p in fresh.tolist()])
            pairs_now = np.concatenate([self.pairs, fresh])
            order = np.argsort(pairs_now)
            self.pairs = pairs_now[order]
            self.verdicts = np.concatenate([self.verdicts, decided])[order]
            at = np.searchsorted(self.pairs, asked)
        return self.verdicts[at][back] if len(asked) else np.empty(0, bool)


@lru_cache(maxsize=4)
def encoder_of(path):
    """The encoder of a vocabulary file, one for the life of a worker process."""
    return Encoder(Merges(path))


def parts_and_values(encoder, texts, remembered):
    """The parts of each text, and a dict with the value of every word among them."""
    parts = [encoder.merges.parts(t) for t in texts]
    words = set()
    for p in parts:
        words.update(p)
    return parts, remembered.of(words - encoder.special_ids)


def encode_texts(encoder, texts):
    """Lists of token ids, one for each text."""
    parts, known = parts_and_values(encoder, texts, encoder.known_words)
    return [
        [i for w in words for i in (known[w] if type(w) is str else (w,))] for words in parts
    ]


def decode_ids(merges, ids):
    """Names of the tokens joined by blanks; the file states no decoder."""
    names = merges.names
    return " ".join([names[i] for i in ids])


def encode(docs, path):
    """``docs`` without ``text`` but with ``ids`` (array of int), the tokens of every row's whole text.

    Null and empty texts have no ids. Rows with null or repeated ids each give a row, and other
    columns are kept, but for one named ``ids``, which is replaced. The strings of special tokens in a text give their ids.
    """
    rows = docs.drop("ids").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))

    def make():
        encoder = encoder_of(path)
        return lambda texts: {"ids": encode_texts(encoder, texts)}

    return map_texts(rows, make, "ids array<int>")


def decode(tokens, path):
    """``tokens`` without ``ids`` but with ``text``, decoded; null ids count as none."""
    rows = tokens.drop("text").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))

    def make():
        merges = encoder_of(path).merges
        return lambda rows: {"text": [decode_ids(merges, ids) for ids in rows]}

    return map_column(rows, "ids", make, "text string")


def digests(docs, path, keep=(), ids=False):
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every row in one pass over the texts.

    Columns named in ``keep`` follow ``doc_id``; with ``ids`` the tokens are returned as well. The digests
    are those of the decimal ids joined by blanks and of the decoded text.
    """
    def make():
        # That module builds on this one.
        from trendmill.llm.array_bpe import speculated_table_of

        table = speculated_table_of(path)
        names = encoder_of(path).merges.names
        written = [
            pa.array([str(i) for i in range(max(names) + 1)], pa.large_string()),
            pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string()),
        ]
        blank = pa.scalar(" ", pa.large_string())

        def run(texts):
            flat, edges = table.flat_of(texts)
            offsets = pa.array(edges.astype(np.int32))
            numbers, decoded = (
                [
                    sha256(t).hexdigest()
                    for t in pc.binary_join(
                        pa.ListArray.from_arrays(offsets, strings.take(pa.array(flat))), blank
                    ).cast(pa.large_binary()).to_pylist()
                ]
                for strings in written
            )
            out = {"n_tokens": pa.array(np.diff(edges)), "ids_sha256": numbers, "decoded_sha256": decoded}
            if ids:
                out["ids"] = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))
            return out

        return run

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *keep,
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return map_texts(rows, make, schema)
