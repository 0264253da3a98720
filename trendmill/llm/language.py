"""Language of a text in two steps: its family first, then the language within the family.

Features are hashed byte n-grams of the lower-cased letters, taken over the whole text. Families
are not given: languages whose mean features are alike are joined (average linkage) as long as the
likeness exceeds the mean likeness of all pairs. One linear support vector machine a family, against
all others, chooses the family; one for each pair of its languages votes for the language.

Machines are fitted on a bounded sample: ``PER_LANGUAGE`` texts of a language and ``SAMPLE`` in all at
most. Each gives its whole text and one short passage of it, so short texts are known as well.
"""

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.llm.shared import crc_part, id_and_text, map_texts

BINS, GRAMS = 4096, (1, 2, 3, 4)
PER_LANGUAGE, SAMPLE = 300, 6000
PASSAGE_BYTES = 60
PENALTY, STEPS = 1e-4, 300
HELD_OUT_PARTS, HELD_OUT = 4, 2
UNDETERMINED = "und"

#: ASCII characters other than letters become blanks.
_LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(128)) + bytes(range(128, 256))


def letters(text):
    """Lower-cased bytes of a text with single blanks for everything in ASCII that is no letter."""
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "


def features(data):
    """Square roots of hashed n-gram counts, of length one."""
    codes = np.frombuffer(data, np.uint8).astype(np.uint64)
    counts, gram = np.zeros(BINS), codes
    for n in range(1, max(GRAMS) + 1):
        if n > 1:
            if len(gram) < 2:
                break
            gram = gram[:-1] * np.uint64(257) + codes[n - 1 :]
        if n in GRAMS:
            hashed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)
            counts += np.bincount(hashed.astype(np.int64), minlength=BINS)
    root = np.sqrt(counts)
    return (root / (np.linalg.norm(root) or 1)).astype(np.float32)


@dataclass
class Machines:
    """Families of languages, a row of weights a family, and weights of each pair in a family."""

    families: list
    family_weights: np.ndarray
    pairs: dict


def machine(rows, signs):
    """Weights (the last is the offset) of a linear machine with squared hinge loss, by fast gradient steps."""
    x = np.concatenate([rows, np.ones((len(rows), 1), np.float32)], axis=1)
    share = np.where(signs > 0, 0.5 / max(1, (signs > 0).sum()), 0.5 / max(1, (signs < 0).sum()))
    weights = np.zeros(x.shape[1], np.float32)
    ahead = weights.copy()
    step = 1 / (PENALTY + 4)
    for t in range(STEPS):
        slack = np.maximum(0, 1 - signs * (x @ ahead))
        slope = PENALTY * ahead - x.T @ (2 * share * signs * slack).astype(np.float32)
        now = ahead - step * slope
        ahead = now + t / (t + 3) * (now - weights)
        weights = now
    return weights


def families_of(rows, languages):
    """Lists of alike languages, from the features of a labelled sample."""
    names = sorted(set(languages))
    centres = np.array([rows[languages == n].mean(axis=0) for n in names])
    centres -= centres.mean(axis=0)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12
    alike = centres @ centres.T
    groups = [[i] for i in range(len(names))]
    if len(names) > 2:
        enough = alike[np.triu_indices(len(names), 1)].mean()
        while len(groups) > 1:
            value, a, b = max(
                (alike[np.ix_(groups[a], groups[b])].mean(), -a, -b)
                for a, b in combinations(range(len(groups)), 2)
            )
            if value <= enough:
                break
            groups[-a] += groups.pop(-b)
    return [sorted(names[i] for i in g) for g in groups]


def fit(rows, languages):
    """Machines for features and their languages; None without any."""
    if not len(rows):
        return None
    families = families_of(rows, languages)
    member = {n: k for k, family in enumerate(families) for n in family}
    family = np.array([member[n] for n in languages])
    weights = [machine(rows, np.where(family == k, 1.0, -1.0)) for k in range(len(families))]
    pairs = {}
    for names in families:
        for a, b in combinations(names, 2):
            both = (languages == a) | (languages == b)
            pairs[a, b] = machine(rows[both], np.where(languages[both] == a, 1.0, -1.0))
    return Machines(families, np.array(weights), pairs)


def predict(model, rows):
    """Language and confidence from 0 to 1 of each row of features."""
    x = np.concatenate([rows, np.ones((len(rows), 1), np.float32)], axis=1)
    margins = np.clip(4 * (x @ model.family_weights.T), -30, 30)
    shares = np.exp(margins - margins.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    chosen = shares.argmax(axis=1)
    languages, scores = np.empty(len(rows), object), shares.max(axis=1).astype(float)
    for k, names in enumerate(model.families):
        mine = np.flatnonzero(chosen == k)
        votes = np.zeros((len(mine), len(names)))
        for a, b in combinations(range(len(names)), 2):
            margin = np.clip(4 * (x[mine] @ model.pairs[names[a], names[b]]), -30, 30)
            won = 1 / (1 + np.exp(-margin))
            # A won duel counts one; how clearly it is won decides between equal counts.
            votes[:, a] += (won > 0.5) + 0.01 * won
            votes[:, b] += (won <= 0.5) + 0.01 * (1 - won)
            scores[mine] *= np.maximum(won, 1 - won)
        languages[mine] = np.array(names, object)[votes.argmax(axis=1)]
    return languages.tolist(), scores.tolist()


def _examples(texts):
    whole = [letters(t) for t in texts]
    short = []
    for data in whole:
        # A passage from a place that depends on the text only.
        at = sum(data[:64]) * 7919 % max(1, len(data) - PASSAGE_BYTES)
        short.append(data[at : at + PASSAGE_BYTES])
    return {
        "_whole": [features(d).astype(np.float16).tobytes() for d in whole],
        "_short": [features(d).astype(np.float16).tobytes() for d in short],
        "_letters": [any(c.isalpha() for c in t) for t in texts],
    }


def train(docs, per_language=PER_LANGUAGE, sample=SAMPLE):
    """Machines fitted on rows with a language outside the held-out quarter.

    Rows are chosen by the hash of their id. Null ids, null languages and texts without a letter
    take no part. Returns None without usable rows.
    """
    known = (
        docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("_lang"))
        .where("doc_id is not null and _lang is not null")
        .where(crc_part(F.col("doc_id"), HELD_OUT_PARTS) != HELD_OUT)
    )
    # A distinct count keeps the sample within its bound for any number of languages.
    languages = max(1, known.select("_lang").distinct().count())
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= max(2, min(per_language, sample // languages)))
        .drop("_place")
    )
    # At most ``sample`` ids, or two of each language.
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id")
    found = map_texts(texts, lambda: _examples, "_whole binary, _short binary, _letters boolean")
    rows = found.where("_letters").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        return None
    halves = [
        np.array([np.frombuffer(r[c], np.float16) for r in rows], np.float32)
        for c in ("_whole", "_short")
    ]
    names = np.array([r["_lang"] for r in rows], object)
    return fit(np.concatenate(halves), np.concatenate([names, names]))


def identify(docs, model):
    """``doc_id``, ``lang_pred`` and ``score`` of every row from its whole text.

    Texts that are null or have no letter, and all texts without a model, give ``und`` with score 0.
    Rows with null or repeated ids each give a row.
    """
    def make():
        def run(texts):
            known = [model is not None and any(c.isalpha() for c in t) for t in texts]
            languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            at = [i for i, k in enumerate(known) if k]
            for start in range(0, len(at), 512):
                part = at[start : start + 512]
                rows = np.array([features(letters(texts[i])) for i in part])
                for i, name, score in zip(part, *predict(model, rows)):
                    languages[i], scores[i] = name, score
            return {"lang_pred": languages, "score": scores}

        return run

    return map_texts(id_and_text(docs), make, "lang_pred string, score double")
