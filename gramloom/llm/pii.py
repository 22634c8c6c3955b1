"""Personal data: base formats, and candidates judged by gradient-boosted trees. DataFrame expressions alone.

Generators of high recall propose spans, which may overlap: anything around an @, dotted numbers, long groups of digits,
and numbers grouped as phone numbers are. Boosted trees judge each candidate by its format (length, digits, separators, check
digit, shape of groups) and its context (the words and characters about it). They learn from two thirds of all
candidates, labelled by whether a base format holds for just that span; the checks that define the
base formats are held back from the trees on half of them, so they learn what such spans look like. The
threshold of each kind is calibrated on the last third: the lowest score above which PRECISION of the candidates hold.
Candidates of equal features are counted by Spark, and the trees take the counts, so none is left out and what comes
to the driver grows with the kinds of candidates, not with the texts. Lengths count up to LONGEST.
Accepted candidates that overlap no base span are added.

The trees are numpy arrays on the driver and become one expression: texts never leave the JVM.
Null and empty texts have no spans.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.quality import Trees, fit
from gramloom.llm.spans import matches, none_of, overlapping

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
#: Base formats. Looking back from the start of a run, or from the last match (\\G), spares trying every position of
#: a long run; possessive repeats spare the stack. Neither changes what is matched.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators: kind, pattern, and what a text must have.
GENERATORS = {
    "email": (r"(?<!\S)[^\s@]++(?:@|\(at\)|\[at\])[^\s@]+", r"@|\(at\)|\[at\]"),
    "ip": (r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![0-9])", r"[0-9]\.[0-9]"),
    "card": (r"(?<![0-9])[0-9]{2,8}+(?:[\x20.-]?[0-9]{2,8}+){1,6}", r"[0-9]{4}"),
    "phone": (r"(?<![0-9+(])[+(]?[0-9][0-9().\x20/-]{5,22}[0-9](?![0-9])", r"[0-9]{3}"),
}
LONGEST = 64  # lengths and numbers of separators above this are one feature value, which bounds the distinct ones
PRECISION = 0.98
PLACE = "struct<start:int,rank:int,end:int,kind:string>"
CANDIDATE = "struct<start:int,rank:int,end:int,kind:string,x:array<double>,base:boolean>"
_WORDS = {"email": "mail|e-mail|contact|@", "ip": r"\bip\b|host|server|addr", "card": "card|visa|iban|account|karte|carte|tarjeta",
          "phone": r"tel|phone|call|fax|mobil|\bnr\b"}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit doubled, digits of the sums added."""
    total = F.aggregate(
        F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int"))
                    .otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda done, x: done + x)
    return total % 10 == 0


def _octets(s: Column) -> Column:
    parts = F.split(s, r"\.")
    return F.forall(parts, lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))


def _valid(kind: str, s: Column) -> Column:
    """The check of a base format on a match of its pattern."""
    n = F.length(_digits(s))
    if kind == "ip":
        return _octets(s)
    if kind == "card":
        return n.between(13, 19) & _luhn(_digits(s))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans (start, rank, end, kind) of the base formats by kind, then start."""
    found = {"email": matches(text, EMAIL, text.contains("@")), "ip": matches(text, IP), "card": matches(text, CARD),
             "phone": matches(text, PHONE, text.contains("+"))}
    return F.concat(*[_named(kind, F.filter(found[kind], _check(kind))) for kind in KINDS])


def _check(kind: str):
    return lambda s: _valid(kind, s["match"])


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("rank"), s["end"], F.lit(kind).alias("kind")))


def _number(condition: Column) -> Column:
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def _features(kind: str, text: Column, s: Column) -> Column:
    """Format and context of a candidate."""
    m, digits = s["match"], _digits(s["match"])
    before = F.lower(F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))))
    after = F.substring(text, s["end"] + 1, F.lit(1))
    groups = F.regexp_replace(m, "[^0-9]+", "x")

    def long(s: Column) -> Column:
        return F.least(F.length(s), F.lit(LONGEST)).cast("double")

    return F.array(
        F.lit(float(KINDS.index(kind))), long(m), long(digits), long(F.regexp_replace(groups, "[0-9]", "")), _number(m.startswith("+")), _number(m.contains("(")),
        long(F.regexp_replace(m, r"[^\x20]", "")), long(F.regexp_replace(m, r"[^.]", "")),
        _number(F.lit(kind == "ip") & _octets(m)), _number(F.lit(kind == "card") & F.length(digits).between(13, 19) & _luhn(digits)),
        _number(m.rlike(r"^[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}")), _number(m.rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]{2,}")),
        _number(m.rlike(r"[^A-Za-z0-9]$")), _number(before.rlike(_WORDS[kind])), _number(after.rlike(r"[A-Za-z0-9_]")),
        _number(before.rlike(r"[A-Za-z0-9_.#/]$")))


def candidates(text: Column, spans: Column) -> Column:
    """All generators' candidates with features, and whether a base span of their kind is just theirs."""

    def judged(kind: str):
        return lambda s: F.struct(
            s["start"], F.lit(KINDS.index(kind)).alias("rank"), s["end"], F.lit(kind).alias("kind"), _features(kind, text, s).alias("x"),
            F.exists(spans, lambda b: (b["kind"] == kind) & (b["start"] == s["start"]) & (b["end"] == s["end"])).alias("base"))

    return F.concat(*[F.transform(matches(text, pattern, text.rlike(needs)), judged(kind))
                      for kind, (pattern, needs) in GENERATORS.items()])


def scored(trees: Trees, x: Column) -> Column:
    """The trees' log-odds as an expression of the array of features."""
    inner = trees.feature.shape[1]

    def node(t: int, k: int) -> Column:
        if k >= inner:
            return F.lit(float(trees.leaf[t, k - inner]))
        if not np.isfinite(trees.threshold[t, k]):
            return node(t, 2 * k + 1)  # never goes right
        return F.when(x[int(trees.feature[t, k])] > float(trees.threshold[t, k]), node(t, 2 * k + 2)).otherwise(node(t, 2 * k + 1))

    total = F.lit(float(trees.start))
    for t in range(len(trees.feature)):
        if np.any(trees.leaf[t]):
            total = total + node(t, 0)
    return total


def learn(found: DataFrame) -> tuple[Trees | None, dict[str, float]]:
    """Trees, and the threshold of each kind, from all rows' (doc_id, candidates)."""
    rows = found.where(F.size("candidates") > 0).select("doc_id", F.explode("candidates").alias("c"))
    third = F.pmod(F.xxhash64("doc_id", "c.start", "c.kind"), F.lit(3)).alias("part")
    seen = rows.select("c.kind", "c.x", "c.base", third).groupBy("kind", "x", "base", "part").agg(F.count(F.lit(1)).alias("n")).collect()
    seen.sort(key=lambda r: (r["kind"], r["x"], r["base"], r["part"]))
    if len({r["base"] for r in seen if r["part"] != 2}) < 2 or all(r["part"] != 2 for r in seen):
        return None, {}
    x, y = np.array([r["x"] for r in seen]), np.array([r["base"] for r in seen], float)
    kinds, part, n = np.array([r["kind"] for r in seen]), np.array([r["part"] for r in seen]), np.array([r["n"] for r in seen], float)
    hidden = x.copy()
    hidden[part == 0, 8:10] = 0.0  # without the check digit and the range of numbers
    learning, checking = part != 2, part == 2
    trees = fit(hidden[learning], y[learning], [0] * x.shape[1], trees=20, depth=3, rate=0.3, counts=n[learning])
    thresholds = {}
    margin = trees.margin(x[checking])
    for kind in KINDS:
        mine = kinds[checking] == kind
        order = np.argsort(-margin[mine], kind="stable")
        m, often = margin[mine][order], n[checking][mine][order]
        share = np.cumsum(y[checking][mine][order] * often) / np.cumsum(often)
        last = np.flatnonzero((share >= PRECISION) & np.append(m[1:] < m[:-1], True)) if len(m) else []
        if len(last) and m[last[-1]] > 0:
            thresholds[kind] = float(m[last[-1]])
    return trees, thresholds


def find(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, base, spans) for every row of docs: base spans and all spans (start, rank, end, kind) by kind, then start.

    Base spans and candidates of all rows are written to ``folder``, a new folder that all executors share, so that
    texts are searched once.
    """
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.when(text.rlike("[0-9]|@"), base_spans(text)).alias("spans"))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "spans",
                       F.when(text.rlike(r"[0-9]|@|[(\[]at[)\]]"), candidates(text, F.coalesce("spans", none_of(PLACE)))).alias("candidates"))
    rows.write.parquet(folder)
    found = docs.sparkSession.read.parquet(folder).select("doc_id", "row", F.coalesce("spans", none_of(PLACE)).alias("spans"),
                                                          F.coalesce("candidates", none_of(CANDIDATE)).alias("candidates"))
    trees, thresholds = learn(found)
    if not thresholds:
        return found.select("doc_id", F.col("spans").alias("base"), "spans")
    limit = F
    for kind, least in thresholds.items():
        limit = limit.when(F.col("c.kind") == kind, least)
    judged = (found.where(F.size("candidates") > 0).select("row", "spans", F.explode("candidates").alias("c"))
              .where(~F.col("c.base") & ~overlapping(F.col("spans"), F.col("c")))
              .where(scored(trees, F.col("c.x")) >= limit.otherwise(F.lit(float("inf")))))
    added = judged.groupBy("row").agg(F.collect_list(F.struct("c.start", "c.rank", "c.end", "c.kind")).alias("added"))
    both = F.array_sort(F.concat("spans", "added"), lambda a, b: F.when(a["rank"] != b["rank"], a["rank"] - b["rank"])
                        .when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"]))
    return found.join(added, "row", "left").select(
        "doc_id", F.col("spans").alias("base"), F.when(F.col("added").isNull(), F.col("spans")).otherwise(both).alias("spans"))

