"""Tokeniser rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Results depend on them being exactly these.
START, END = "<s>", "</s>"
UNKNOWN_MARKER = "<unk>"
SENTENCE_BREAK = r"[.!?]+"
WORD = r"[\p{L}][\p{L}']*"
NOT_LETTER_OR_BLANK = r"[^A-Za-z \t]"
BLANK = r"[ \t]"
ALNUM_OR_PUNCT = r"[A-Za-z0-9]+|[!-/:-@\[-`{-~]"
MAX_ORDER = 9


def sentence_texts(content: Column) -> Column:
    """Split a text into its sentences, after blanking the unknown-word marker."""
    scrubbed = F.replace(content, F.lit(UNKNOWN_MARKER), F.lit(" "))
    return F.split(scrubbed, SENTENCE_BREAK, -1)


def words(text: Column) -> Column:
    """Lower-case letter runs, inner and trailing apostrophes kept."""
    folded = F.replace(F.lower(text), F.lit("’"), F.lit("'"))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def with_sentinels(tokens: Column) -> Column:
    return F.concat(F.array(F.lit(START)), tokens, F.array(F.lit(END)))


def letter_tokens(text: Column) -> Column:
    """ASCII letters split at single blanks: case kept, everything else dropped.

    Line ends are not blanks, so words on both sides of one run together; repeated
    blanks give empty tokens; only an empty last token is left out.
    """
    pieces = F.split(F.regexp_replace(text, NOT_LETTER_OR_BLANK, ""), BLANK, -1)
    kept = F.size(pieces) - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return F.slice(pieces, F.lit(1), kept)


def punct_tokens(text: Column) -> Column:
    """ASCII letter/digit runs, with every punctuation mark a token of its own."""
    return F.regexp_extract_all(text, F.lit(ALNUM_OR_PUNCT), F.lit(0))


def prompt_history(seed: Column) -> Column:
    """Tokens a walk starts from: all words of the seed, or the start sentinel."""
    tokens = words(F.coalesce(seed, F.lit("")))
    return F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(START)))
