"""Quality rules: a table of thresholds compiled into one Spark projection.

Every statistic is a built-in expression over the row's own text, so the operator is a single map-only pass: no
shuffle, no user function, nothing collected. ``measure`` adds the statistics, ``verdict`` compiles ``RULES``.

Edge cases: a null or empty text has no words (all counts 0, ``base_failed``); very long texts are handled whole,
in time proportional to length (only texts that do repeat a window sort their windows); repeated rows are judged
separately and equally; an empty table gives an empty result; a null ``lang``, a language without stop words here, or a
table without that column: the stop-word rule isn't applied; other columns are ignored by ``score`` and passed through by
``keep_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, bind, keep, text_or_empty

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Very common words of the languages served, by ``lang``, in lower case; words are compared without regard to case.
STOP_WORDS = {
    "en": "the and of to in is that it on was for as with be are".split(),
    "de": "der die das und von zu ist den sich ein eine nicht".split(),
    "fr": "le la les de et des en un une est que du dans pas".split(),
    "es": "el los las y que se con por no es del al lo".split(),
}
ALL_STOP_WORDS = sorted({w for words in STOP_WORDS.values() for w in words})
#: A text in a language served has a stop word, of any of them, for so many words.
WORDS_A_STOP_WORD = 60

#: (rule, statistic, least, most); None: no bound.
RULES = (
    ("length", "n_words", 10, None),
    ("word_length", "mean_word_chars", 2.5, 12.0),
    ("symbols", "symbols_per_word", None, 0.1),
    ("exclamation", "exclamations_per_word", None, 0.3),
    ("letters", "words_with_letters", 0.5, None),
    ("stop_words", "missing_stop_words", None, 0),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
    ("bullets", "bullet_line_ratio", None, 0.9),
    ("ellipsis", "ellipsis_line_ratio", None, 0.3),
)


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs at least twice. Windows sorted by hash put equal ones side by side;
    the positions found, in order, each add what reaches past the window before."""
    # sort_array orders the structs by hash, then position
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = lambda j, x: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(j - 1, x) | same(j + 1, x), x["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        bind(pairs, positions), start,
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + (p + WINDOW) - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"])


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of each row's text (``_t``, ``_w``, ``_h`` and ``_g`` are working columns)."""
    df = df.withColumn("_t", text_or_empty(text))
    df = keep(df, "_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    df = keep(df, "_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)))
    df = keep(df, "_h", F.transform("_w", lambda x: F.xxhash64(x)))
    n = F.size("_w")
    at = F.col("_h")
    df = keep(df, "_g", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(at, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    stop = F.array(*map(F.lit, ALL_STOP_WORDS))
    served = F.col("lang").cast("string").isin(list(STOP_WORDS)) if "lang" in df.columns else F.lit(False)
    found = F.size(F.filter("_w", lambda x: F.array_contains(stop, F.lower(x))))
    return df.select(
        "*",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_g")) < F.size("_g"), _covered(F.col("_g")))
        .otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_exclamations"),
        F.size(F.filter("_w", lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.when(F.coalesce(served, F.lit(False)), F.floor(n / F.lit(WORDS_A_STOP_WORD)) - found).cast("long").alias("missing_stop_words"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long").alias("n_bullets"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long")
        .alias("n_ellipsis"),
    ).drop("_t", "_w", "_lines", "_h", "_g")


def _statistics() -> dict[str, Column]:
    ratio = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "exclamations_per_word": ratio("n_exclamations", "n_words"),
        "words_with_letters": ratio("n_letter_words", "n_words"),
        "missing_stop_words": F.col("missing_stop_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullets", "n_lines"),
        "ellipsis_line_ratio": ratio("n_ellipsis", "n_lines"),
    }


def compile_rules(rules=RULES) -> Column:
    """The names of the rules a row breaks, as one expression. A rule without a value (no words, a language that isn't
    served) isn't broken."""
    stats, broken = _statistics(), []
    for name, stat, least, most in rules:
        bad = F.lit(False)
        if least is not None:
            bad = bad | (stats[stat] < F.lit(least))
        if most is not None:
            bad = bad | (stats[stat] > F.lit(most))
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def verdict(measured: DataFrame, rules=RULES) -> DataFrame:
    """Add ``broken_rules``, ``base_failed`` and ``kept`` to measured rows."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (measured.withColumn("broken_rules", compile_rules(rules)).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)))


def _lang(docs: DataFrame) -> list[str]:
    return ["lang"] if "lang" in docs.columns else []


def score(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: the statistics and the verdict."""
    out = verdict(measure(docs.select("doc_id", "text", *_lang(docs))), rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def keep_documents(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns (carried in a struct, so no name can clash)."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"), *_lang(docs))
    return verdict(measure(packed), rules).filter("kept").select("_row.*")
