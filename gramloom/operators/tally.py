"""Everything a training run needs to know, counted from one pass over the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gramloom.functions.tokens import sentence_texts, with_sentinels, words
from gramloom.operators.ngrams import CHUNK, chunked

VOCABULARY = 0  # ``ord`` of the rows that count single tokens
LEDGER = -1     # ``ord`` of the rows that sum tokens per source; LEDGER - k sums order-k n-grams
GRAMS = -100    # ``ord`` of counted rows that :func:`shorter` still needs: n-grams cut by a sentence's end, sentences


def longest(corpus: DataFrame, k: int, chunk: int = CHUNK) -> DataFrame:
    """(ord, state_key, next_token, n) of order ``k``, and rows of ``ord`` GRAMS that :func:`shorter` sums the rest from.

    The raw text is read and tokenised once. Each position gives one row, its longest n-gram (k + 1 tokens, fewer at
    a sentence's end), and each sentence one row of its source and length. Map-side sums collapse the hot rows.
    """
    split = corpus.select("source_id", F.explode_outer(sentence_texts(F.col("content"))).alias("sent"))
    tokenised = split.select("source_id", words(F.col("sent")).alias("w"))
    sents = tokenised.select(
        "source_id", F.when(F.size("w") > 0, with_sentinels(F.col("w"))).alias("toks"))

    parts = chunked(sents, ["source_id"], k, chunk)
    size = F.coalesce(F.when(F.col("c").isNotNull(), F.size("c")), F.lit(0))
    first = F.when(F.col("length").isNotNull(), F.lit(-1)).otherwise(F.lit(0))  # -1: the sentence itself
    slots = parts.select("source_id", "c", "length", F.explode(F.sequence(first, F.least(size, F.lit(chunk)) - 1)).alias("i"))
    # Tokens hold no blank and are not empty, so a leading blank marks the rows " length source".
    sentence = F.concat(F.lit(" "), F.col("length").cast("string"), F.lit(" "), F.coalesce("source_id", F.lit("")))
    gram = F.concat_ws(" ", *[F.get("c", F.col("i") + j) for j in range(k + 1)])  # beyond the end there is nothing to add
    counted = (slots.select(F.when(F.col("i") < 0, sentence).otherwise(gram).alias("gram"))
               .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    begun = F.substring_index("gram", " ", k)  # all of a gram that is cut
    whole = ~_of_source() & (F.octet_length(begun) < F.octet_length("gram"))
    return counted.select(
        F.when(whole, F.lit(k)).otherwise(F.lit(GRAMS)).cast("tinyint").alias("ord"),
        F.when(whole, begun).otherwise(F.col("gram")).alias("state_key"),
        F.when(whole, F.substring_index("gram", " ", -1)).otherwise(F.lit("")).alias("next_token"), "n")


def shorter(counted: DataFrame, k: int, keep: Callable[[DataFrame, int], DataFrame] = lambda rows, order: rows) -> DataFrame:
    """The rows of lower orders, of the vocabulary and of the ledgers, from the rows of :func:`longest`.

    An order's n-grams are the states of the order above, with the n-grams that a sentence's end cut to their length. So
    each order is summed from the distinct rows of the one above it, with sums on the map side. ``keep`` may store an
    order's rows before the next is summed from them: then one order's shuffle is on disk at a time.
    """
    cut = counted.where(F.col("ord") == GRAMS).select(F.col("state_key").alias("gram"), "n")
    found, above = ledgers(cut, k), counted.where(F.col("ord") == k)
    for order in range(k - 1, VOCABULARY - 1, -1):
        begun = above.select(F.col("state_key").alias("gram"), "n").unionAll(cut.where(~_of_source() & (_blanks() == order)))
        summed = begun.groupBy("gram").agg(F.sum("n").alias("n")).select(
            F.lit(order).cast("tinyint").alias("ord"), F.substring_index("gram", " ", order).alias("state_key"),
            F.substring_index("gram", " ", -1).alias("next_token"), "n")
        above = keep(summed, order)
        found = found.unionByName(above)
    return found


def ledgers(cut: DataFrame, k: int) -> DataFrame:
    """The rows of the ledgers, from the rows (gram, n) of sentences."""
    m = F.col("m")  # the order whose n-grams are counted for a source, 0: tokens
    per_order = cut.where(_of_source()).select(_number().alias("length"), _source().alias("source"), "n",
                                               F.explode(F.sequence(F.lit(0), F.lit(k))).alias("m"))
    return per_order.groupBy("source", "m").agg(F.sum(F.greatest(F.col("length") - m, F.lit(0)) * F.col("n")).alias("n")).select(
        (LEDGER - m).cast("tinyint").alias("ord"), F.col("source").alias("state_key"), F.lit("").alias("next_token"), "n")


def tally(corpus: DataFrame, k: int, chunk: int = CHUNK) -> DataFrame:
    """(ord, state_key, next_token, n) of a corpus of (source_id, content).

    * ``ord`` 1..k: transitions, ``n`` = occurrences;
    * ``ord`` 0: vocabulary, ``next_token`` = token, ``n`` = frequency;
    * ``ord`` -1: ``state_key`` = source, ``n`` = tokens with sentinels;
    * ``ord`` -1-j: ``state_key`` = source, ``n`` = n-grams of order j.

    Records without a word still count as 0 for their source. Training stores the rows of :func:`longest` and reads
    them for :func:`shorter`; here they are one plan, which counts the longest n-grams for either part.
    """
    counted = longest(corpus, k, chunk)
    return counted.where(F.col("ord") == k).unionByName(shorter(counted, k))


def _of_source() -> Column:
    return F.col("gram").startswith(" ")


def _blanks() -> Column:
    return F.length("gram") - F.length(F.replace(F.col("gram"), F.lit(" "), F.lit("")))


def _number() -> Column:
    """The number after the leading blank of a source's row."""
    return F.trim(F.substring_index("gram", " ", 2)).try_cast("bigint")


def _source() -> Column:
    return F.expr("substr(gram, length(substring_index(gram, ' ', 2)) + 2)")
