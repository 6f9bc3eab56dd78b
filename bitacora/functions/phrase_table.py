"""Long lists of phrases as tables that texts look up, instead of a part of the plan.

A text is a row of runs, of word characters and of others in turn, and a phrase between
word edges covers whole runs.  So phrases are found by equality of runs: a table of them is
keyed by the run of each that is rarest in the table, the runs of a text meet it in a join,
and only what the join brings is compared in full.  The cost of a text depends on how many
phrases have such a run of it, not on how many there are.

What was found goes back to the rows by the hash of their text, so equal texts are one;
rows compare it with their own runs again, and a hash that two texts share does no harm.
It is written and counted before: a little is broadcast, so the texts stay where they are,
and where it is much the texts are moved, of which Spark splits hot ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.functions.dialect import (
    AFTER_WORD,
    BEFORE_WORD,
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    WORD,
    WORD_SET,
)
from bitacora.operators.lookup import HOT_ROWS, frequent_keys
from bitacora.storage import Workspace

# Texts and phrases found in them, about 200 bytes each, that are broadcast together.
BROADCAST_ENTRIES = 100_000

# Lower-case letters that more than one letter stands for, where any case may stand.
_FOLDED = ("İıſςµϐϑϕϖϰϱϵẛι", "iisσμβθφπκρεṡι")


def runs(text: Column) -> Column:
    """Runs of word characters and runs of others, in turn."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}+|[^{WORD_SET}]+"), F.lit(0))


def folded(text: Column) -> Column:
    """``text`` in one case, as patterns for any case compare it."""
    return F.lower(F.translate(text, *_FOLDED))


def is_word_run(run: Column) -> Column:
    return run.rlike(f"^{WORD}")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def _without_idle(places: DataFrame, table: DataFrame) -> DataFrame:
    """``places`` without those under frequent keys that the ``table`` does not have.

    Texts share words that are in no phrase, and all places of such a word would meet in one
    task of the join.  They are counted before they are moved; no more than one key in
    HOT_ROWS places is frequent.
    """
    idle = frequent_keys(places, "key", HOT_ROWS).join(table, "key", "left_anti")
    return places.join(F.broadcast(idle), "key", "left_anti")


def _looked_up(df: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """Every row of ``df`` as ``row``, its ``text`` and the ``entries`` found for it by hash ``h``."""
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text")
    )
    found, seen = Workspace(df.sparkSession).stage(
        found, texts=F.count(F.lit(1)), entries=F.sum(F.size("entries"))
    )
    if (seen["texts"] or 0) + (seen["entries"] or 0) <= BROADCAST_ENTRIES:
        found = F.broadcast(found)
    return rows.withColumn("h", _text_hash(F.col("text"))).join(found, "h", "left").drop("h")


def _texts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull())


def _with_value(rows: DataFrame, columns: list[str], name: str, value: Column) -> DataFrame:
    """The rows under their columns, of which ``name`` holds ``value``."""
    return rows.select(
        *[(value if c == name else F.col(f"row.`{c}`")).alias(c) for c in dict.fromkeys([*columns, name])]
    )


def _rarest_run(table: DataFrame) -> DataFrame:
    """(phrase, key, offset): the run of each phrase that fewest of the phrases have, and where.

    It is a word if the phrase has one.
    """
    by_run = table.select("phrase", F.posexplode("runs").alias("offset", "key"))
    usual = by_run.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # Blanks are everywhere in a text, however few of the phrases have any.
    place = F.struct(~is_word_run(F.col("key")), "n", -F.length("key"), "key", "offset")
    least = F.min(place).alias("least")
    return by_run.join(usual, "key").groupBy("phrase").agg(least).select("phrase", "least.key", "least.offset")


def replace_from_table(df: DataFrame, text: str, phrases: DataFrame, result: str) -> DataFrame:
    """Replaces every phrase of a table (phrase, new) in one pass from left to right.

    As ``replace_phrases`` does: whole words, any case, the longest that begins at a place.
    Phrases are unique in lower case.  Where a text spells one so that its lower case is
    another, it stays, but nothing else is found inside.
    """
    table = phrases.where("phrase <> ''").select(
        F.lower("phrase").alias("phrase"), "new", runs(folded(F.col("phrase"))).alias("runs")
    )
    table = table.join(_rarest_run(table), "phrase")
    own = _texts(df, text).select(
        _text_hash(F.col("text")).alias("h"), runs(folded(F.col("text"))).alias("low")
    )
    places = own.select("h", F.posexplode("low").alias("k", "key"))
    entry = F.struct(
        (F.col("k") - F.col("offset")).alias("i"), (-F.size("runs")).alias("less"), "runs", "phrase", "new"
    )
    found = (
        _without_idle(places, table)
        .join(table, "key")
        .where("k >= offset")
        .groupBy("h")
        .agg(F.collect_set(entry).alias("entries"))
    )
    rows = _looked_up(df, text, found)
    rows = rows.withColumn("runs", F.when(F.col("entries").isNotNull(), runs(F.col("text"))))
    n = F.size("runs")

    def fits(e: Column) -> Column:
        size = -e["less"]
        mine = F.transform(F.slice("runs", e["i"] + 1, size), folded)
        # A phrase that begins or ends with other characters stands beside a word there.
        before = is_word_run(F.get(e["runs"], 0)) | (e["i"] > 0)
        after = is_word_run(F.get(e["runs"], size - 1)) | (e["i"] + size < n)
        return (mine == e["runs"]) & before & after

    def take(done: Column, e: Column) -> Column:
        taken = F.struct(
            (e["i"] - e["less"]).alias("next"), F.concat(done["taken"], F.array(e)).alias("taken")
        )
        return F.when(e["i"] >= done["next"], taken).otherwise(done)

    kind = "array<struct<i: int, less: int, runs: array<string>, phrase: string, new: string>>"
    rows = rows.withColumn("hits", F.array_sort(F.filter("entries", fits)).cast(kind))
    none = F.struct(F.lit(0).alias("next"), F.array().cast(kind).alias("taken"))
    rows = rows.withColumn("taken", F.aggregate("hits", none, take)["taken"])

    def piece(e: Column, k: Column) -> Column:
        before = F.get("taken", k - 1)
        start = F.coalesce(before["i"] - before["less"], F.lit(0))
        match = F.array_join(F.slice("runs", e["i"] + 1, -e["less"]), "")
        gap = F.array_join(F.slice("runs", start + 1, e["i"] - start), "")
        return F.concat(gap, F.when(F.lower(match) == e["phrase"], e["new"]).otherwise(match))

    last = F.try_element_at(F.col("taken"), F.lit(-1))
    end = last["i"] - last["less"]
    tail = F.array_join(F.slice("runs", end + 1, F.greatest(n - end, F.lit(0))), "")
    replaced = F.concat(F.array_join(F.transform("taken", piece), ""), tail)
    value = F.when(F.size("taken") > 0, replaced).otherwise(F.col("text"))
    return _with_value(rows, df.columns, result, value)


# --------------------------------------------------------------------------
# One after the other
# --------------------------------------------------------------------------


def whole_phrase_pattern(phrase: Column) -> Column:
    """The pattern for a phrase between word edges, as ``dialect.whole_phrase`` has it."""
    text = F.regexp_replace(phrase, r"([\x00-\x7F&&[^A-Za-z0-9_\n\r\t\x00]])", r"\\$1")
    left = F.when(phrase.rlike(f"^{WORD}"), F.concat(F.lit(f"(?<!{WORD}"), text, F.lit(")"))).otherwise(
        F.concat(F.lit(f"(?<={WORD}"), text, F.lit(")"))
    )
    right = F.when(phrase.rlike(f"{WORD}\\z"), F.lit(NOT_BEFORE_WORD)).otherwise(F.lit(BEFORE_WORD))
    edge = f"(?:{AFTER_WORD}{NOT_BEFORE_WORD}|{NOT_AFTER_WORD}{BEFORE_WORD})"
    return F.when(phrase == "", F.lit(edge)).otherwise(F.concat(text, left, right))


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0)))


def _rarest_word(table: DataFrame) -> DataFrame:
    """(phrase, key): the word of each phrase that fewest of the phrases have."""
    by_word = table.select("phrase", F.explode("words").alias("word"))
    usual = by_word.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct("n", "word")).getField("word")
    return by_word.join(usual, "word").groupBy("phrase").agg(least.alias("key"))


def _steps_by_word(table: DataFrame, ws: Workspace) -> DataFrame:
    """(key, step): all steps that may change a text in which the word ``key`` stands.

    Those are the phrases that have it as their key, and those whose key one of these puts
    in, as long as they come later in the order.  Steps under an empty key may change any text.
    """
    own, seen = ws.stage(
        table.join(_rarest_word(table), "phrase", "left").select(
            F.coalesce("key", F.lit("")).alias("key"), "step", _words(F.col("new")).alias("puts")
        ),
        n=F.count(F.lit(1)),
    )
    later = own.select(F.col("key").alias("word"), F.col("step").alias("then"), F.col("puts").alias("then_puts"))
    last, reached = own, own.select("key", "step")
    while seen["n"]:
        put_in = last.select("key", "step", F.explode("puts").alias("word"))
        last, seen = ws.stage(
            put_in.join(later, "word")
            .where(F.col("step") < F.col("then"))
            .select("key", F.col("then").alias("step"), F.col("then_puts").alias("puts"))
            .distinct()
            .join(reached, ["key", "step"], "left_anti"),
            n=F.count(F.lit(1)),
        )
        reached = reached.union(last.select("key", "step"))
    return reached


def replace_each_from_table(df: DataFrame, text: str, phrases: DataFrame) -> DataFrame:
    """Replaces the phrases of a table (phrase, new) in turn, longest first, then by ``at``.

    As a fold over all of them does, but a row only tries those whose rarest word it has.  What
    is put in may be part of a match too, so a phrase also comes with those that may put in
    its rarest word.  A phrase without a word is tried in every row.
    """
    step = F.struct(
        (-F.length("phrase")).alias("less"),
        "at",
        "phrase",
        whole_phrase_pattern(F.col("phrase")).alias("pattern"),
        F.regexp_replace("new", r"([\\$])", r"\\$1").alias("new"),
    )
    # A null phrase is found nowhere.
    table = phrases.where("phrase IS NOT NULL").select(
        "phrase", "new", _words(F.col("phrase")).alias("words"), step.alias("step")
    )
    keyed = _steps_by_word(table, Workspace(df.sparkSession))
    # Phrases that any row may come to hold are few; they become part of the plan.
    always = [r["step"] for r in keyed.where("key = ''").select("step").distinct().collect()]
    words = _texts(df, text).select(
        _text_hash(F.col("text")).alias("h"), F.explode(_words(F.col("text"))).alias("key")
    )
    keyed = keyed.where("key <> ''")
    found = (
        _without_idle(words, keyed).join(keyed, "key").groupBy("h").agg(F.collect_set("step").alias("entries"))
    )
    kind = found.schema["entries"].dataType
    rows = _looked_up(df, text, found)
    steps = F.coalesce("entries", F.array().cast(kind))
    if always:
        fixed = [F.struct(*[F.lit(v).alias(k) for k, v in s.asDict().items()]) for s in always]
        steps = F.array_distinct(F.concat(steps, F.array(*fixed).cast(kind)))

    def change(done: Column, s: Column) -> Column:
        return F.when(done.contains(s["phrase"]), F.regexp_replace(done, s["pattern"], s["new"])).otherwise(done)

    value = F.aggregate(F.array_sort(steps), F.col("text"), change)
    return _with_value(rows, df.columns, text, value)
