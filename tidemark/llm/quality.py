"""Line-first cleaning: lines that fail a rule go, then documents that lost too much.

Only DataFrame functions are used, and no shuffle: each document is judged from its
own text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import WORD, named, text_of, words_of

SYMBOLS = "#*$%&|<>"
#: Fixed values of the base figures.
WINDOW, LEAST_WORDS, REPEATED_PERCENT = 8, 20, 30

#: A line holds a sentence when one of these ends a word in it (closing quotes may follow).
SENTENCE = r"""[.!?;:…。！？；：][\x22'”’»)\]]*(\s|$)"""
#: Sentence marks of other scripts; words need not be parted there.
OTHER_SENTENCE = "[।॥؟۔։።፧፨။។៕།༎๚๛｡。！？]"
#: A line without a sentence end may be the middle of a wrapped sentence. It fails if it has
#: few words (and no run of a script that does not part them), if half of its words or more
#: are repeated, or if more than two thirds of them begin with a capital, as in a menu.
FEW_WORDS = 4
UNPARTED = r"[\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{8}"
CAPITAL = r"(?<![^\x20\x09-\x0D])\p{Lu}"
#: A line fails by its punctuation if it hangs so, has more symbols than one for
#: five words, or more repeated !!, ?? or … marks than one for five words.
MARKS_PERCENT = 20
#: Signs that part the entries of a menu or a trail, with blanks around them.
MENU = r"\s(\||»|›|·|•|→|/|>)(?=\s)"
MENU_SIGNS, MENU_WORDS = 2, 4
#: Wording of notices (fixed values, natural order); a line fails of which one makes up this share or more, in percent.
NOTICES = (
    "accept cookies",
    "accept all cookies",
    "all rights reserved",
    "alle rechte vorbehalten",
    "back to top",
    "click here",
    "cookie policy",
    "datenschutzerklärung",
    "enable javascript",
    "licensed under",
    "mentions légales",
    "política de privacidad",
    "politique de confidentialité",
    "powered by",
    "privacy policy",
    "released under the",
    "sign up for our",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "todos los derechos reservados",
    "tous droits réservés",
    "we use cookies",
)
NOTICE_PERCENT = 5
#: A document that keeps less than this share of its words is rejected.
KEPT_PERCENT = 50


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _if_any(text: Column, signs: str | tuple[str, ...], count: Column) -> Column:
    """``count``, spared where ``text`` has none of ``signs``."""
    return F.when(reduce(or_, (text.contains(c) for c in signs)), count).otherwise(0)


def _figures(line: Column) -> Column:
    return F.struct(
        line.alias("line"),
        F.size(F.split(line, " ")).alias("words"),
        _count(line, r"[#*$%&<>{}~^\\=_]").alias("symbols"),
        _if_any(line, ("!!", "!?", "?!", "??", "……"), _count(line, r"[!?]{2,}|…{2,}")).alias("shouts"),
        _if_any(line, "|»›·•→/>", _count(line, MENU)).alias("signs"),
        # No notice is such a share of a longer line.
        F.when(F.length(line) * NOTICE_PERCENT <= 100 * max(map(len, NOTICES)), F.lower(line)).alias("lower"),
    )


def _hanging(line: Column) -> Column:
    """Whether a line without a sentence end shows otherwise, too, that it is no part of a sentence."""
    words = words_of(line)
    n = F.size(words)
    few = (n <= FEW_WORDS) & ~line.rlike(UNPARTED)
    return few | (F.size(F.array_distinct(words)) * 2 <= n) | (_count(line, CAPITAL) * 3 > n * 2)


def _verdict(f: Column) -> Column:
    line, words, signs = f["line"], f["words"], f["signs"]
    menu = (signs >= MENU_SIGNS) & (signs * MENU_WORDS >= words - signs)
    share = F.length(line) * NOTICE_PERCENT
    notice = f["lower"].isNotNull() & reduce(or_, (f["lower"].contains(n) & (share <= 100 * len(n)) for n in NOTICES))
    marks = (f["symbols"] * 100 > words * MARKS_PERCENT) | (f["shouts"] * 100 > words * MARKS_PERCENT)
    sentence = line.endswith(".") | line.endswith("!") | line.endswith("?") | line.rlike(SENTENCE) | line.rlike(OTHER_SENTENCE)
    hanging = F.when(sentence, F.lit(False)).otherwise(_hanging(line))
    return F.when(menu, "navigation").when(marks | hanging, "punctuation").when(notice, "boilerplate")


def line_verdicts(lines: Column) -> Column:
    """Each line as (line, verdict): the rule it fails (navigation, punctuation, boilerplate) or null."""
    figures = F.transform(lines, _figures)
    return F.transform(figures, lambda f: F.struct(f["line"].alias("line"), _verdict(f).alias("verdict")))


def run_hashes(words: Column, window: int = WINDOW) -> Column:
    """The 64-bit hash of every run of ``window`` words, in text order; null if there is no second run."""
    last = F.size(words) - window
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, window))))


def with_repeated_words(df: DataFrame, runs: str, to: str, window: int = WINDOW) -> DataFrame:
    """The words under runs that occur twice or more in a text, from the hashes of its runs.

    Only a text with two equal runs is looked at further: equal neighbours among the
    sorted (hash, place) give the repeated places, and these in order the words covered.
    """
    placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.size(F.array_distinct(runs)) < F.size(runs)
    df = df.withColumn("__placed", F.when(twice, placed))

    def again(x: Column, k: Column) -> Column:
        before, after = F.get("__placed", k - 1)["h"], F.get("__placed", k + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("__placed", again), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))

    def cover(acc: Column, i: Column) -> Column:
        return F.struct((acc["n"] + F.least(i - acc["last"], F.lit(window))).alias("n"), i.alias("last"))

    covered = F.aggregate(places, start, cover, lambda acc: acc["n"])
    return df.withColumn(to, F.coalesce(covered, F.lit(0).cast("long"))).drop("__placed")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept_text, n_kept_words and kept; columns of those names are replaced."""
    body = text_of(text)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    out = docs.withColumns({"__words": words_of(body), "__lines": lines})
    out = out.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    good = F.filter(line_verdicts(F.col("__lines")), lambda x: x["verdict"].isNull())
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": _count(body, f"[{SYMBOLS}]").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "kept_text": F.array_join(F.transform(good, lambda x: x["line"]), "\n"),
            "__runs": run_hashes(F.col("__hashes")),
        }
    ).drop("__words", "__lines", "__hashes")
    out = with_repeated_words(out, "__runs", "n_repeat_words").drop("__runs")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    out = out.withColumns({"base_failed": failed, "n_kept_words": _count(F.col("kept_text"), WORD).cast("long")})
    enough = 100 * F.col("n_kept_words") >= KEPT_PERCENT * F.col("n_words")
    # A filter on ``kept`` must not be moved below, where it would repeat all of the above;
    # the optimizer leaves it in place as a partition's number is not a function of the row.
    return out.withColumn("kept", ~F.col("base_failed") & enough & (F.spark_partition_id() >= 0))


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, the base figures, kept_text (its good lines), and kept.

    A null or empty text has no words, so it fails. Lines without a word are left out of
    the kept text. Other columns are not read; repeated rows are judged alike.
    """
    return measured(docs.select(named(id).alias("doc_id"), text_of(text).alias("text")))


def cleaned(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` that are kept, with the kept lines as their text, all columns in place.

    ``length``, if ``docs`` has it, becomes the text's new length in code points.
    """
    whole = measured(docs.select(F.struct("*").alias("row"), text_of(text).alias("text")))
    kept = whole.where("kept").select("row", "kept_text")

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == text:
            return F.col("kept_text").alias(name)
        if name == length:
            return F.length("kept_text").cast(docs.schema[name].dataType).alias(name)
        return own.alias(name)

    return kept.select(*[column(c) for c in docs.columns])
