"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

For every prefix of a piece the table holds the last token of its exact encoding and the count. The
last token of a longer prefix is the one token that ends there and is compatible with the last
token of the prefix before it; one such token exists, as every string has one exact encoding and
an encoding is exact if its neighbouring pairs are. A second table does the same for prefixes that
end the piece, whose last token carries the word end. Counts of a text's prefixes are sums over
its words, so truncation and budgets are looked up without encoding anything again.

Prefixes are those of the normalised text: NFC, a run of white space as one blank, lower case.
"""

from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import regex
from pyspark.sql import functions as F

from trendmill.llm import bpe
from trendmill.llm.shared import id_and_text, map_texts

LIMIT = 2048
_SPACE = regex.compile(r"\s+")


def matcher(tokens):
    """Finds the tokens that end at each place of a byte string given as Latin-1 text, longest first."""
    automaton = ahocorasick.Automaton()
    for data, token in tokens.items():
        automaton.add_word(data.decode("latin-1"), (token, len(data)))
    automaton.make_automaton()
    return automaton


class PrefixCounter:
    """Prefix counts of words and texts for one vocabulary file."""

    def __init__(self, merges):
        self.merges = merges
        self.inner, self.ended = matcher(merges.inner), matcher(merges.ended)
        self.pieces = bpe.Remembered(lambda pieces: [self.piece(p) for p in pieces])
        #: word -> counts of its prefixes, the last one for the whole word
        self.words = bpe.Remembered(self.tables)

    def piece(self, piece):
        """Counts of ``piece[:1]``, ``piece[:2]`` and so on, each as a piece of its own."""
        data = piece.encode("utf-8", "surrogatepass")
        latin = data.decode("latin-1")
        last, count = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        fits = self.merges.compatible
        done = 0
        for at, (token, size) in self.inner.iter(latin):
            end = at + 1
            if end == done:
                continue
            start = end - size
            if start == 0 or fits(last[start], token):
                last[end], count[end], done = token, count[start] + 1, end
        out, done = [], 0
        for at, (token, size) in self.ended.iter(latin):
            end = at + 1
            if end == done or (end < len(data) and data[end] & 0xC0 == 0x80):
                continue
            start = end - size
            if start == 0 or fits(last[start], token):
                out.append(count[start] + 1)
                done = end
        return packed(out)

    def tables(self, words):
        """Prefix counts of words without white space or special tokens; words are normalised."""
        split = [self.merges.pattern.findall(w) for w in words]
        known = self.pieces.of({p for pieces in split for p in pieces})
        out = []
        for word, pieces in zip(words, split):
            if len(pieces) == 1 and len(pieces[0]) == len(word) and not contraction(word):
                out.append(known[word])
                continue
            counts, base = [], 0
            for piece in pieces:
                if contraction(piece):
                    # Cut short, its apostrophe and letters are pieces of their own.
                    counts += [base + self._cut(piece[:i]) for i in range(1, len(piece))]
                    base += known[piece][-1]
                    counts.append(base)
                else:
                    counts += [base + n for n in known[piece]]
                    base = counts[-1]
            out.append(packed(counts))
        return out

    def _cut(self, part):
        return sum(self.piece(p)[-1] for p in self.merges.pattern.findall(part))

    def parts(self, text):
        """Normalised words as they stand between blanks, and special tokens as 1-tuples."""
        special = self.merges.special
        if self.merges.split_special is None or not any(s in text for s in special):
            return normalised_text(text).split(" ")
        out = []
        for part in self.merges.split_special.split(text):
            if part in special:
                out.append((part,))
            else:
                out += normalised_text(part).split(" ")
        return out

    def split(self, texts):
        """Parts of each text, and a dict with the table of every word among them."""
        parts = [self.parts(t) for t in texts]
        words = {w for p in parts for w in p}
        return parts, self.words.of({w for w in words if type(w) is str and w})

    def totals(self, parts, known, limit):
        """Tokens of a text, and characters of its longest prefix of at most ``limit`` tokens.

        A prefix's count can fall when a character completes a longer token, so the word in which
        the limit is passed is searched from its end.
        """
        if limit < 1 or any(type(w) is tuple for w in parts):
            counts = self.prefixes(parts, known)
            fits = np.flatnonzero(counts <= limit)
            return int(counts[-1]) if len(counts) else 0, int(fits[-1]) + 1 if len(fits) else 0
        counts = [known[w][-1] if w else 0 for w in parts]
        total = sum(counts)
        if total <= limit:
            return total, sum(map(len, parts)) + len(parts) - 1
        before = [0, *accumulate(counts)]
        at = bisect_left(before, limit) - 1
        chars = sum(map(len, parts[:at])) + at
        table = known[parts[at]]
        inside = [i for i, n in enumerate(table, 1) if before[at] + n <= limit]
        fit = chars + (inside[-1] if inside else 0)
        # A blank after a word that just fits has no token of its own.
        return total, fit + (before[at + 1] == limit and at + 1 < len(parts))

    def prefixes(self, parts, known):
        """Counts of all prefixes of a text, its empty prefix left out, as int32."""
        out, base, glued, after_word = [], 0, "", False
        for word in parts:
            if type(word) is tuple:
                # Cut short, its characters are ordinary and join the word they follow.
                before = base - (known[glued][-1] if glued else 0)
                name = word[0]
                cut = [glued + bpe.lower(name[:i]) for i in range(1, len(name))]
                tables = self.tables(cut)
                out += [before + t[-1] for t in tables]
                base += 1
                out.append(base)
                glued, after_word = "", False
                continue
            if after_word:
                out.append(base)
            if word:
                out += [base + n for n in known[word]]
                base += known[word][-1]
            glued, after_word = word, True
        return np.array(out, np.int32)


def packed(counts):
    """Small counts as bytes, others as a tuple; both are sequences of ints."""
    return bytes(counts) if not counts or max(counts) < 256 else tuple(counts)


def contraction(piece):
    return len(piece) > 1 and piece[0] == "'" and piece[1].isalpha()


def normalised_text(text):
    if text.isascii() and "\x1c" not in text:
        # Words of ASCII text need lower case only.
        text = text.lower()
        return _SPACE.sub(" ", text) if needs_blanks(text) else text
    return bpe.lower(_SPACE.sub(" ", bpe.unicodedata.normalize("NFC", text)))


def needs_blanks(text):
    return "  " in text or any(c in text for c in "\t\n\x0b\x0c\r\x1d\x1e\x1f")


@lru_cache(maxsize=4)
def counter_of(path):
    """The counter of a vocabulary file, one for the life of a worker process."""
    return PrefixCounter(bpe.Merges(path))


def count_tokens(docs, path, limit=LIMIT):
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars`` of every row's whole text.

    ``fit_chars`` is the length of the longest prefix of the normalised text with at most ``limit``
    tokens. Null and empty texts have no bytes and no tokens. Rows with null or repeated ids each
    give a row.
    """
    rows = id_and_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))

    def make():
        counter = counter_of(path)

        def run(texts):
            parts, known = counter.split(texts)
            totals = [counter.totals(p, known, limit) for p in parts]
            return {"n_tokens": [n for n, _ in totals], "fit_chars": [c for _, c in totals]}

        return run

    counted = map_texts(rows, make, "n_tokens long, fit_chars long")
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars"
    )


def prefix_counts(docs, path):
    """``docs`` without ``text`` but with ``prefix_tokens``: entry i counts the first i + 1 characters.

    The table to store where budgets are asked often; see :func:`longest_prefix`. Null and empty texts
    have an empty array. Other columns and repeated rows are kept.
    """
    rows = docs.drop("prefix_tokens").withColumn(
        "text", F.coalesce(F.col("text").cast("string"), F.lit(""))
    )

    def make():
        counter = counter_of(path)

        def run(texts):
            parts, known = counter.split(texts)
            return {"prefix_tokens": [counter.prefixes(p, known) for p in parts]}

        return run

    return map_texts(rows, make, "prefix_tokens array<int>")


def longest_prefix(prefix_tokens, budget):
    """Column: characters of the longest prefix within ``budget`` tokens, from a stored array."""
    over = F.transform(F.reverse(prefix_tokens), lambda n: n <= budget)
    place = F.array_position(over, F.lit(True))
    return F.when(place > 0, F.size(prefix_tokens) - place + 1).otherwise(0).cast("long")
