"""Quality rules, line first: each line is judged alone, failing lines go, and a document
that loses too much of its text is rejected.

Defined results: null text has no words and fails; an empty or blank line is neither kept nor
lost text; repeated rows and ties are judged alike; further columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart.llm.common import pinned, restored, shelved, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
ITEMS = r"[|»›·•]"
CAPITALS = r"\p{Lu}"


@dataclass(frozen=True)
class Rules:
    min_words: int = 10  # of a document
    max_repeat: int = 20  # percent of words in repeated windows
    max_lost: float = 0.5  # share of words in failing lines from which a document is rejected
    max_symbols: float = 0.25  # symbols for each word of a line
    max_shout: float = 0.5  # share of a line's characters that are capitals
    min_distinct: float = 0.75  # share of distinct words below which a line can stutter
    max_stutter: float = 0.25  # share of words that repeat the word before
    min_line: int = 6  # words from which the rules on shares apply
    menu_items: int = 4  # separators from which a line can be a menu
    menu_words: float = 4.0  # words for each item of a menu, at most
    boilerplate_words: int = 40  # a longer line is prose, whatever phrase it holds
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "cookie policy", "privacy policy", "terms of use",
        "terms of service", "click here", "enable javascript", "subscribe to our newsletter",
        "skip to content", "share on facebook", "lorem ipsum",
        "tous droits réservés", "alle rechte vorbehalten", "todos los derechos reservados",
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _phrases(text: Column, rules: Rules) -> Column:
    """Whether a text holds a boilerplate phrase; plain searches, no alternation."""
    lower, found = F.lower(text), F.lit(False)
    for phrase in rules.boilerplate:
        found = found | lower.contains(phrase)
    return found


def line_fault(line: Column, rules: Rules, phrases: Column, marks: Column) -> Column:
    """Name of the first rule that a line fails, else null. A blank line fails none.

    ``phrases`` and ``marks`` say whether the line's document holds a boilerplate phrase, or
    a symbol or separator, at all: most do not, and their lines skip those rules.
    """

    def stutter(w: Column) -> Column:
        again = F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, F.greatest(i - 1, F.lit(0)))))
        return F.size(again) > rules.max_stutter * F.size(w)

    def judged(w: Column) -> Column:
        n = F.size(w)
        long = n >= rules.min_line
        items = F.when(marks, _count(line, ITEMS)).otherwise(0)
        return (
            F.when(n == 0, F.lit(None))
            .when(
                (items >= rules.menu_items) & (n <= rules.menu_words * (items + 1)),
                F.lit("navigation"),
            )
            .when(marks & (_count(line, SYMBOLS) > rules.max_symbols * n), F.lit("punctuation"))
            .when(long & (_count(line, CAPITALS) > rules.max_shout * F.length(line)), F.lit("capitals"))
            .when(long & (F.size(F.array_distinct(w)) < rules.min_distinct * n) & stutter(w), F.lit("stutter"))
            .when(phrases & (n <= rules.boilerplate_words) & _phrases(line, rules), F.lit("boilerplate"))
        )

    # A lambda over one element binds the words, so that they are split once for a line.
    return F.element_at(F.transform(F.array(words_of(line)), judged), 1)


def _repeated(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside windows of five that occur twice or more.

    Windows are compared by a 64-bit hash inside one document. Only a document that has
    equal windows sorts them.
    """
    hashes = F.when(
        F.size("words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = pinned(df, hashes=hashes)
    ordered = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(
            F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))
    df = pinned(df, ordered=ordered)

    def again(x: Column, i: Column) -> Column:
        before = F.get(F.col("ordered"), i - 1)["h"]
        after = F.get(F.col("ordered"), i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    starts = F.sort_array(F.transform(F.filter("ordered", again), lambda x: x["at"]))

    def covered(acc: Column, at: Column) -> Column:
        new = F.least(F.lit(WINDOW), at - acc["last"])
        return F.struct(at.alias("last"), (acc["n"] + new).alias("n"))

    nothing = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    repeated = F.aggregate(starts, nothing, covered)["n"].cast("long")
    return pinned(df, n_repeat_words=repeated).drop("hashes", "ordered")


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: its columns under the names that ``shelved`` gives, counts, base_failed, kept, lost_words (words
    of failing lines) and cleaned (its text without failing lines)."""
    df, names = shelved(docs)
    row, old = names.values(), F.col(names["text"])
    text = F.coalesce(old, F.lit(""))
    df = pinned(df, words=words_of(text))
    df = _repeated(df).select(
        *row,
        "n_repeat_words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.split(text, "\n").alias("raw"),
        F.struct(
            F.split(text, "\n").alias("lines"),
            _phrases(text, rules).alias("phrases"),
            text.rlike(f"{SYMBOLS}|{ITEMS}").alias("marks"),
        ).alias("unpinned"),
    )
    df = pinned(df, of=F.col("unpinned")).drop("unpinned")
    fault = lambda x: line_fault(x, rules, F.col("of.phrases"), F.col("of.marks"))
    df = pinned(df, faults=F.transform("of.lines", fault))
    df = pinned(df, full=F.filter("of.lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    sound = F.forall("faults", lambda x: x.isNull())
    good = F.filter("of.lines", lambda x, i: F.get("faults", i).isNull())
    cleaned = F.when(sound, old).otherwise(F.array_join(good, "\n"))
    df = pinned(df, cleaned=cleaned, sound=sound)
    left = F.when(F.col("sound"), F.col("n_words")).otherwise(F.size(words_of(F.col("cleaned"))))
    df = pinned(df, lost_words=(F.col("n_words") - left).cast("long"))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat * F.col("n_words")
    )
    enough = F.col("lost_words") <= rules.max_lost * F.col("n_words")
    return df.select(
        *row,
        "n_words",
        "word_chars",
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        "lost_words",
        "cleaned",
    )


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept documents with the columns of ``docs``, without their failing lines."""
    return restored(judge(docs, rules).filter("kept"), docs, F.col("cleaned"))
