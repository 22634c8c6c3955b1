"""Language of a text by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is cut from the left into the longest pieces
that occur in that text (Ziv and Merhav's cross parsing); the fewer pieces, weighed by the logarithm of the labelled text's
length, the closer the language. Pieces do not run over a space, so words are parsed once per task and remembered.

A null text, a text without letters, and any text when nothing could be learnt, is ``und`` with score 0.
Equal entropies go to the language first by name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramloom.llm.common import over_texts, row_share

LEARNT_DOCS = 120  # labelled documents of a language, at most about
LEARNT_CHARS = 40_000  # characters of a language, at most: texts in order of hash, the last one cut
CACHED_WORDS = 300_000
SHARPNESS = 6.0
_WORD = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """Longest matches in a text: transitions keyed by state and character."""

    def __init__(self, text: str):
        steps: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for char in text:
            state = len(steps)
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and char not in steps[at]:
                steps[at][char] = state
                at = link[at]
            if at >= 0:
                target = steps[at][char]
                if length[at] + 1 == length[target]:
                    link[state] = target
                else:
                    clone = len(steps)
                    steps.append(dict(steps[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and steps[at].get(char) == target:
                        steps[at][char] = clone
                        at = link[at]
                    link[target] = link[state] = clone
            last = state
        self.steps = {(state << 21) | ord(c): to for state, row in enumerate(steps) for c, to in row.items()}

    def pieces(self, word: str) -> int:
        """Number of longest-match pieces of a word, from the left; an unknown character is a piece."""
        count, state, step = 0, 0, self.steps.get
        for char in word:
            code = ord(char)
            to = step((state << 21) | code)
            if to is None:
                count += state > 0  # the piece before ends here
                to = step(code)
                if to is None:
                    count, to = count + 1, 0
            state = to
        return count + (state > 0)


def learn(labelled: DataFrame) -> dict[str, str]:
    """Normalised labelled text per language, from rows (doc_id, text, lang), each bounded by LEARNT_CHARS."""
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return {}
    chosen = F.lit(False)
    for r in counts:
        chosen |= (F.col("lang") == r["lang"]) & row_share("doc_id", "text", min(1.0, LEARNT_DOCS / r["n"]))
    # rows of one hot id are chosen all or none, so the number that comes home has a bound of its own
    ranked = rows.where(chosen).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"))))
    picked = ranked.where(F.col("rank") <= 2 * LEARNT_DOCS).select("lang", F.substring("text", 1, LEARNT_CHARS).alias("text"), F.xxhash64("doc_id").alias("h"))
    found: dict[str, list[str]] = {r["lang"]: [] for r in counts}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["h"], r["text"])):
        found[r["lang"]] += _WORD.findall(r["text"].lower())
    texts = {lang: f" {' '.join(words)} "[:LEARNT_CHARS] for lang, words in found.items() if words}
    return dict(sorted(texts.items()))


class Entropies:
    """Pieces of words for every language, in a table that grows with the words seen."""

    def __init__(self, texts: dict[str, str]):
        self.langs = list(texts)
        self.automata = [SuffixAutomaton(t) for t in texts.values()]
        self.bits = np.log2([max(2, len(t)) for t in texts.values()])
        self.index = _Index(self)
        self.counts = np.zeros((CACHED_WORDS, len(texts)), np.int32)

    def of(self, text: str) -> np.ndarray | None:
        """Bits per character under each language, or None without letters."""
        words = _WORD.findall(text.lower())
        if not words:
            return None
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), CACHED_WORDS // 2):
            part = words[at:at + CACHED_WORDS // 2]
            if len(self.index) + len(part) >= CACHED_WORDS:
                self.index.clear()
            total += self.counts[np.fromiter(map(self.index.__getitem__, part), np.int64, len(part))].sum(0)
        return total * self.bits / (sum(map(len, words)) + len(words))


class _Index(dict):
    def __init__(self, owner: Entropies):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.owner.counts[row] = [a.pieces(f" {word} ") for a in self.owner.automata]
        return row


def identify(text: Column, texts: dict[str, str]) -> Column:
    """Struct of lang and score (0 to 1: the winner's share of 2 ** (-sharpness * bits))."""

    def make():
        own = Entropies(texts) if texts else None

        def one(text):
            bits = own.of(text) if own and text else None
            if bits is None:
                return {"lang": "und", "score": 0.0}
            best = int(bits.argmin())
            return {"lang": own.langs[best], "score": float(1 / np.exp2(SHARPNESS * (bits[best] - bits)).sum())}

        return lambda rows: pa.array([one(t) for t in rows], pa.struct([("lang", pa.string()), ("score", pa.float64())]))

    return over_texts(make, "struct<lang:string,score:double>")(text)
