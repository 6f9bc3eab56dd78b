"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one failure bit per rule, so that policies (named sets of rules) and ablations
(what would be kept without a rule) need no second look at any text.

Null, empty and blank texts have no words and fail the rule of the fewest words.
Each row is judged alone, so repeated rows get the same result; the input's
columns are kept as they are in ``row``.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.llm.text import BLANKS, at, given, has_word, packed, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# name: what makes a document fail, from the measurements.  The place is the bit.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "2 * n_symbols > n_words",
    "exclamations": "2 * n_exclamations > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 24 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "no_letters": "n_letters = 0",
}
BASE = ("few_words", "repeated_words")
# Versioned policies: the rules a document must pass.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "exclamations"),
    "strict": tuple(RULES),
}
DEFAULT_POLICY = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def _with_repeated_words(df: DataFrame, size: int) -> DataFrame:
    """Adds the words in runs of ``size`` words that occur twice or more, from ``hashes``.

    Each step is a column of its own: inside a lambda an expression would be
    computed anew for every element.
    """
    hashes, runs, ranked, starts = map(F.col, ("hashes", "runs", "ranked", "starts"))
    every = F.transform(
        hashes, lambda x, i: F.xxhash64(x, *[at(hashes, i + k) for k in range(1, size)])
    )
    whole = F.slice(every, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    # A look at the distinct runs spares most documents the sort.
    twice = F.size(F.array_distinct(runs)) < F.size(runs)
    placed = F.transform(runs, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    equal = F.filter(
        ranked,
        lambda x, k: F.coalesce(at(ranked, k + 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.when(k > 0, at(ranked, k - 1)["g"]) == x["g"], F.lit(False)),
    )
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.lit(size), at(starts, k + 1) - s)),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return (
        df.withColumn("runs", whole)
        .withColumn("ranked", F.when(twice, F.sort_array(placed)))
        .withColumn("starts", F.sort_array(F.transform(equal, lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``row`` with the document, its measurements, and ``fail_bits``."""
    text = given(F.col("text"))
    df = packed(docs, text=text)
    df = df.withColumn("words", words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), has_word)
    )
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = _with_repeated_words(df, WINDOW)
    bare = F.translate("text", BLANKS, "")
    df = df.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(bare).cast("bigint").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("text"), "!").alias("n_exclamations"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.when(F.col("text").rlike(r"\p{L}"), 1).otherwise(0).cast("bigint").alias("n_letters"),
    )
    bits = sum(
        (F.when(F.expr(test), bit(rule)).otherwise(0) for rule, test in RULES.items()), F.lit(0)
    )
    return df.withColumn("fail_bits", bits.cast("bigint"))


def passes(policy: str = DEFAULT_POLICY) -> Column:
    """Whether a row of the ledger passes every rule of a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents that fail it, and that fail nothing else.

    Documents are counted by their failure bits first, of which there are at most
    two to the number of rules.
    """
    rules = [(rule, bit(rule)) for rule in POLICIES[policy]]
    counts = ledger.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")
    ).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(b).alias("bit")) for r, b in rules])
    each = counts.select("bits", "n", F.explode(pairs).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"),
    )
