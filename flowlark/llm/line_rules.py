"""Line-first cleaning of documents, in DataFrame functions.

Every line with a word is judged by punctuation rules (mostly symbols, shouting, a fragment
without any sentence mark), navigation rules (separators between words, a few words without
an end) and boilerplate phrases that fill a third of it, or most of it inside a passage. A line of a running passage is
no fragment: its neighbours, up to two lines on either side without a blank one between,
make sentences with it. So prose with hard line breaks is judged like prose without.
Failing lines go; a document is rejected if it fails the base rules or if less than
``keep_percent`` of its characters in lines with words are left.

All steps are array functions over one row, so nothing is shuffled and a hot source
or a group of copies costs no more than other rows. A line is measured once.

Defined results: a null text has no words and is rejected; blank lines are kept and
not counted; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Fixed values of the line rules: characters, and phrases as a pattern that Java and SQL
# engines share, over lower-cased lines.
BLANKS = " \t\n\x0b\x0c\r"
MARKUP = "#*$%&|<>=_~^{}[]\\+@"
SEPARATORS = "|»›•·>"
MARKS = ".!?,:;…。！？"
ENDS = ".!?:;…。！？"
CLOSERS = "\"'”’»)]"
SHOUTS = r"[!?]{2,}"
BOILERPLATE = (
    r"cookie policy|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|"
    r"enable javascript|subscribe to our|sign up for|log in to|click here|read more|"
    r"share this|follow us on|powered by|back to top|skip to content"
)
#: A running passage has this many words a line, and a mark in this many words.
LINE_WORDS, MARK_WORDS = 4, 30


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice in the array.

    Windows are compared by 64-bit hashes. Arrays without a repeat, most of them,
    end at a hash-set count; the others sort their windows once.
    """
    n = F.size(words)
    starts = F.when(n >= window, F.sequence(F.lit(1), n - window + 1)).otherwise(
        F.array().cast("array<int>")
    )

    def covered(hashes):
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(s):
            last = F.size(s) - 1
            same = lambda x, k: (
                ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
                | ((k < last) & (s[F.least(k + 1, last)]["h"] == x["h"]))
            )
            return F.array_sort(F.transform(F.filter(s, same), lambda x: x["i"]))

        def length(s):
            last = F.size(s) - 1
            step = F.transform(
                s, lambda x, k: F.when(k == last, window).otherwise(
                    F.least(F.lit(window), s[F.least(k + 1, last)] - x)
                )
            )
            return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

        return _let(_let(placed, repeats), length)

    def count(hashes):
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0).cast("long")).otherwise(covered(hashes))

    def windows(hashes):
        here = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(-1, window - 1)])
        return F.transform(starts_of(hashes, starts), here)

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)


def starts_of(words: Column, starts: Column) -> Column:
    return F.when(words.isNotNull(), starts)


def _any_of(characters: str) -> str:
    return "[" + "".join("\\" + c if c in "[]\\^" else c for c in characters) + "]"


def _count(line: Column, characters: str) -> Column:
    return F.regexp_count(line, F.lit(_any_of(characters)))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(line, "[\\x09-\\x0D]", " "), " "), "")


#: Lines without a match have no markup, separators or shouts.
ODD = _any_of(MARKUP + SEPARATORS) + "|" + SHOUTS
#: Finds the phrases by their second words: text without a blank and one of these is passed fast.
SECOND_WORDS = " (?:%s)" % "|".join(f"{x}(?<={p})" for p in BOILERPLATE.split("|") for x in [p.split(" ", 1)[1]])


def _measures(line: Column, words: Column) -> Column:
    """What the rules ask about a line, once."""
    n = F.size(words)
    odd = line.rlike(ODD)
    trimmed = F.rtrim(line, F.lit(CLOSERS + BLANKS))
    solid = F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w))

    def told(lower):
        left = F.length(lower) - F.length(F.regexp_replace(lower, BOILERPLATE, ""))
        return F.when(lower.rlike(SECOND_WORDS), left).otherwise(0)

    return F.struct(
        n.alias("n"),
        F.length(line).alias("chars"),
        (odd & (_count(line, MARKUP) * 5 > solid)).alias("markup"),
        (odd & (F.regexp_count(line, F.lit(SHOUTS)) * 2 > n)).alias("shouts"),
        F.when(odd, _count(line, SEPARATORS)).otherwise(0).alias("parts"),
        _count(line, MARKS).alias("marks"),
        ((F.length(trimmed) > 0) & F.lit(ENDS).contains(F.right(trimmed, F.lit(1)))).alias("ended"),
        F.when((n > 0) & (n <= 30), _let(F.lower(line), told)).otherwise(0).alias("told"),
    )


def _running(lines: Column, i: Column) -> Column:
    """Whether line i and its neighbours are a running passage."""

    def near(step: int) -> list[Column]:
        one, two = F.get(lines, i + step), F.get(lines, i + 2 * step)
        first = F.coalesce(one["n"] > 0, F.lit(False))
        second = first & F.coalesce(two["n"] > 0, F.lit(False))
        return [
            F.when(first, a).otherwise(0) + F.when(second, b).otherwise(0)
            for a, b in ((F.lit(1), F.lit(1)), (one["n"], two["n"]), (one["marks"], two["marks"]))
        ]

    own = F.get(lines, i)
    sums = zip(near(-1), near(1), (F.lit(1), own["n"], own["marks"]))
    count, words, marks = (a + b + c for a, b, c in sums)
    return (count >= 2) & (words >= LINE_WORDS * count) & (marks * MARK_WORDS >= words)


def _passes(lines: Column, x: Column, i: Column) -> Column:
    """Whether measured line x, at place i and with a word, survives."""
    before = F.get(lines, i - 1)
    goes_on = F.coalesce((before["n"] > 2) & ~before["ended"], F.lit(False))
    fragment = (x["n"] < 10) & (x["marks"] == 0) & ~_running(lines, i)
    short = (x["n"] <= 2) & ~x["ended"] & ~(goes_on & _running(lines, i))
    navigation = (x["parts"] >= 3) & (x["parts"] * 5 > x["n"])
    most = (x["told"] * 5 >= x["chars"] * 4) | ((x["told"] * 3 >= x["chars"]) & ~_running(lines, i))
    return ~(x["markup"] | x["shouts"] | navigation | fragment | short | ((x["told"] > 0) & most))


def judge(docs: DataFrame, text: str = "text", keep_percent: int = 60) -> DataFrame:
    """Rows (row, n_words, ..., base_failed, kept, clean_text); ``row`` holds the input."""
    given = F.coalesce(F.col(_quoted(text)), F.lit(""))
    rows = docs.select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"), given.alias("_t"))
    rows = rows.withColumn("_l", F.split("_t", "\n"))
    rows = rows.withColumn("_lw", F.transform("_l", _words))
    rows = rows.withColumns({"_w": F.flatten("_lw"), "_m": F.transform("_l", lambda x, i: _measures(x, F.get("_lw", i)))})
    verdicts = F.transform("_m", lambda x, i: (x["n"] == 0) | _passes(F.col("_m"), x, i))
    rows = rows.withColumn("_ok", verdicts)
    full = F.filter("_l", lambda x, i: F.get("_m", i)["n"] > 0)
    zero = F.lit(0).cast("long")

    def chars(counts) -> Column:
        sizes = F.transform("_m", lambda x, i: F.when((x["n"] > 0) & counts(i), x["chars"]).otherwise(0))
        return F.aggregate(sizes, zero, lambda a, x: a + x)

    judged = F.struct(
        F.col("row"),
        F.size("_w").cast("long").alias("n_words"),
        F.aggregate("_w", zero, lambda a, w: a + F.length(w)).alias("word_chars"),
        _count(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        chars(lambda i: F.lit(True)).alias("line_chars"),
        chars(lambda i: F.get("_ok", i)).alias("kept_chars"),
        F.size(F.filter("_ok", lambda x: ~x)).cast("long").alias("n_lines_removed"),
        F.array_join(F.filter("_l", lambda x, i: F.get("_ok", i)), "\n").alias("clean_text"),
    )
    # Generated, so that a filter on a verdict does not judge every line again.
    rows = rows.withColumn("_full", full).select(F.explode(F.array(judged)).alias("_j")).select("_j.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    enough = 100 * F.col("kept_chars") >= keep_percent * F.col("line_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & enough)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_documents(
    docs: DataFrame, text: str = "text", length: str = "n_chars", keep_percent: int = 60
) -> DataFrame:
    """Documents that pass, without their failing lines, in the columns of ``docs``."""
    kept = judge(docs, text, keep_percent).filter("kept")
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text:
            value = F.when(F.col("n_lines_removed") > 0, F.col("clean_text")).otherwise(value)
        elif c == length:
            changed = F.length("clean_text").cast(docs.schema[c].dataType)
            value = F.when(F.col("n_lines_removed") > 0, changed).otherwise(value)
        columns.append(value.alias(c))
    return kept.select(*columns)
