from pyspark.sql import functions as F

from gramloom.functions.text import detokenize, format_bytes
from gramloom.functions.tokens import letter_tokens, prompt_history, punct_tokens
from gramloom.operators.sentences import doc_tokens, sentences


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("r")).first().r


def test_word_rule_and_sentence_rule(corpus):
    rows = sentences(corpus("It’s dogs' 'tis 21st mid-20th don''t É", "A b. C d... e!? ", "x <unk> y <UNK>",
                            "one\ntwo.", None, "", ".", "123!"), "source_id").collect()
    assert sorted(r.toks[1:-1] for r in rows) == sorted([
        ["it's", "dogs'", "tis", "st", "mid", "th", "don''t", "é"],
        ["a", "b"], ["c", "d"], ["e"], ["x", "y", "unk"], ["one", "two"]])
    assert all(r.toks[0] == "<s>" and r.toks[-1] == "</s>" for r in rows)


def test_positions_start_at_one(corpus):
    rows = doc_tokens(sentences(corpus("Hi you."), "source_id"), "source_id").orderBy("pos").collect()
    assert [(r.pos, r.token) for r in rows] == [(1, "<s>"), (2, "hi"), (3, "you"), (4, "</s>")]


def test_other_tokenisers(spark):
    assert one(spark, letter_tokens(F.col("x")), x="A1b, c\nd  e ") == ["Ab", "cd", "", "e"]
    assert one(spark, letter_tokens(F.col("x")), x="a b") == ["a", "b"]
    assert one(spark, letter_tokens(F.col("x")), x="") == []
    assert one(spark, punct_tokens(F.col("x")), x="it's 21st—ok!?") == ["it", "'", "s", "21st", "ok", "!", "?"]


def test_prompt_history(spark):
    assert one(spark, prompt_history(F.col("x")), x="The CITY, 7") == ["the", "city"]
    assert one(spark, prompt_history(F.col("x")), x=" 12 ") == ["<s>"]
    assert one(spark, prompt_history(F.lit(None).cast("string"))) == ["<s>"]
    assert len(one(spark, prompt_history(F.col("x")), x="w " * 50)) == 50  # whole prompts: no cap on the words a walk starts from


def test_format_bytes_cuts(spark):
    cases = {0: "0 bytes", 1: "1 byte", 1023: "1023 bytes", 1024: "1.0 KiB", 15353: "14.9 KiB",
             24000000: "22.8 MiB", 2**40: "1.0 TiB"}
    got = spark.createDataFrame([(n,) for n in cases], "n long").select("n", format_bytes(F.col("n")).alias("t")).collect()
    assert {r.n: r.t for r in got} == cases


def test_detokenize(spark):
    frame = spark.createDataFrame([(["<s>", "hi", "</s>", "<s>", "you"],), (["</s>", "<s>", "a", "</s>"],),
                                   (["a", "</s>", "</s>", "b"],), (["<s>"],), (["</s>", "<s>"],)], "h array<string>")
    assert [r.t for r in frame.select(detokenize(F.col("h")).alias("t")).collect()] == [
        "hi. you", "a.", "a.. b", "", ""]
