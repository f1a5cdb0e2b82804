"""Operator 3: line-first quality rules, in DataFrame functions only.

Every line is judged by itself first:

* punctuation: over ``MARK_SHARE`` of its visible characters are neither
  letters nor digits, or it has no letter or digit at all;
* navigation: at least ``MENU_MARKS`` menu separators, one for every
  ``MENU_WORDS`` words or fewer;
* boilerplate: a licence, rights, cookie, script or sign-in phrase for every
  ``PHRASE_WORDS`` words or fewer, whatever the line's length.

Failing lines are taken out.  A document is rejected when the lines taken out
hold more than ``LOSS_SHARE`` of its visible characters, or when it fails the
base rules on the whole text: fewer than ``LEAST_WORDS`` words, or over
``REPEAT_PERCENT`` of its words in windows of ``WINDOW`` words that occur
twice or more in the text.

Null and empty texts have no words and fail the base rules.  Lines without a
word are neither judged nor counted.  Windows are compared through 64-bit
hashes inside one text.  No row needs another row: there is no shuffle, and
the work per text grows as n log n at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import SPACE_CLASS, let, words

LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
MARK_SHARE = 0.25
MENU_MARKS = 3
MENU_WORDS = 4
LOSS_SHARE = 0.5
PHRASE_WORDS = 25
SYMBOLS = "[#*$%&|<>]"
# Phrases of licence, rights, cookie, script and sign-in lines.
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
               "privacy policy", "cookie policy", "use cookies", "enable javascript", "lorem ipsum",
               "sign in to continue", "subscribe to our newsletter")


def repeat_words(ws: Column, k: int = WINDOW) -> Column:
    """Words covered by windows of ``k`` words found twice or more."""
    n = F.size(ws)
    windows = F.when(n < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(ws, i, k))))

    def places(h: Column) -> Column:
        """Starts of the repeated windows, ascending: equal hashes are
        neighbours once (hash, start) pairs are sorted."""
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def twin(x: Column, j: Column) -> Column:
                return ((F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)))
                        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))
        return let(pairs, repeated)

    def covered(p: Column) -> Column:
        """Each window adds its words up to the next window's start."""
        step = F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(k)), F.lit(k)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(let(places(h), covered)))


def visible(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.regexp_replace(text, SPACE_CLASS + "+", ""))


def line_fails(line: Column) -> dict[str, Column]:
    """The three rules for one line that has a word."""
    shown = visible(line)
    marks = F.length(F.regexp_replace(line, r"[\p{L}\p{N}\x20\x09-\x0D]+", ""))
    count = F.size(words(line))
    menus = F.length(line) - F.length(F.regexp_replace(line, "[|»›•]", ""))
    def phrased(low: Column) -> Column:
        found = low.contains(BOILERPLATE[0])
        for phrase in BOILERPLATE[1:]:
            found = found | low.contains(phrase)
        return found

    def dense(low: Column) -> Column:
        # phrases are only counted where there is one at all
        return F.when(phrased(low), F.regexp_count(low, F.lit("|".join(BOILERPLATE))) * PHRASE_WORDS >= count).otherwise(
            F.lit(False))
    boiler = let(F.lower(line), dense)
    return {"punctuation": marks > shown * F.lit(MARK_SHARE),
            "navigation": (menus >= MENU_MARKS) & (menus * MENU_WORDS >= count),
            "boilerplate": boiler}


def clean_lines(text: Column) -> Column:
    """Lines of the text that pass the line rules; lines without a word stay."""
    def passes(line: Column) -> Column:
        rules = line_fails(line)
        return (~line.rlike(r"[^\x20\x09-\x0D]")
                | ~(rules["punctuation"] | rules["navigation"] | rules["boilerplate"]))
    return F.filter(F.split(text, "\n", -1), passes)


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, base_failed, n_lines_removed, loss_share
    (of the visible characters), clean_text and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ws = words(text)
    lines = F.split(text, "\n", -1)
    filled = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(ws, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    by_line = let(filled, lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long"))
    cleaned = let(clean_lines(text), lambda c: F.struct(
        (F.size(lines) - F.size(c)).cast("long").alias("n_lines_removed"),
        F.array_join(c, "\n").alias("clean_text")))
    names = ["__base", "__dup", "__clean"]
    out = docs.withColumns(dict(zip(names, (counted, by_line, cleaned))))
    base = F.col("__base")
    shown, left = base["word_chars"], visible(F.col("__clean.clean_text")).cast("long")
    loss = F.when(shown > 0, (shown - left) / shown).otherwise(F.lit(0.0))
    failed = (base["n_words"] < LEAST_WORDS) | (base["n_repeat_words"] * 100 > base["n_words"] * REPEAT_PERCENT)
    plain = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(
        *plain, base["n_words"].alias("n_words"), base["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.col("__dup").alias("n_dup_lines"),
        base["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
        F.col("__clean.n_lines_removed").alias("n_lines_removed"), loss.cast("double").alias("loss_share"),
        F.col("__clean.clean_text").alias("clean_text"),
        (~failed & (loss <= LOSS_SHARE)).alias("kept"))
