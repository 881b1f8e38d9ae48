"""Statistics of a text as built-in Spark expressions, without Python and without a shuffle.

Everything is computed inside the row, so hot keys and groups of copies play no part. A null text counts as empty;
every statistic of an empty text is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm._common import words

#: Words of a window of which repeats are counted.
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"

#: Ratios that the learned rules and rule ensembles may test; all are doubles without nulls.
RATIOS = [
    "symbols_per_word", "bangs_per_word", "pipes_per_word", "upper_per_char", "digits_per_char", "chars_per_word",
    "distinct_share", "dup_line_share", "repeat_share", "words_per_line", "log_words", "end_marks_per_word",
]


def with_statistics(df: DataFrame, text: str = "text", ratios: bool = True) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and the ``RATIOS`` added.

    n_repeat_words counts the words in five-word windows that the text holds at least twice, the first one included.
    Windows are compared by a 64-bit hash over their words' 64-bit hashes; only texts in which one occurs again
    have theirs sorted. Working columns are called ``_s_*`` and are gone from the result.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.select(*keep, t.alias("_s_t"), words(t).alias("_s_w"))
    df = df.withColumn("_s_h", F.transform("_s_w", lambda w: F.xxhash64(w)))
    n = F.size("_s_h")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_s_h"), i + k) for k in range(WINDOW)])),
    )
    df = df.withColumn("_s_win", windows)
    df = df.withColumn("_s_again", F.coalesce(F.size(F.array_distinct("_s_win")) < F.size("_s_win"), F.lit(False)))
    df = df.withColumn("_s_sorted", F.when(F.col("_s_again"), F.array_sort(F.transform("_s_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s_sorted")
    marked = F.transform(
        "_s_sorted",
        lambda x, k: F.when(
            F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]), x["i"]
        ),
    )
    df = df.withColumn("_s_at", F.when(F.col("_s_again"), F.sort_array(F.array_compact(marked))))
    at = F.col("_s_at")
    covered = F.aggregate(
        F.transform("_s_at", lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    lines = F.filter(F.split("_s_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_s_lines", lines)
    joined = F.array_join("_s_w", "")
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(joined).cast("long"),
            "n_symbols": F.regexp_count("_s_t", F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_s_lines") - F.size(F.array_distinct("_s_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(F.when(F.col("_s_again"), covered), F.lit(0)).cast("long"),
        }
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    if ratios:
        per_word = lambda c: c / F.greatest(F.col("n_words"), F.lit(1)).cast("double")
        per_char = lambda c: c / F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
        n_lines = F.size("_s_lines")
        df = df.withColumns(
            {
                "symbols_per_word": per_word(F.col("n_symbols")),
                "bangs_per_word": per_word(F.regexp_count("_s_t", F.lit("!"))),
                "pipes_per_word": per_word(F.regexp_count("_s_t", F.lit(r"\|"))),
                "upper_per_char": per_char(F.regexp_count("_s_t", F.lit("[A-Z]"))),
                "digits_per_char": per_char(F.regexp_count("_s_t", F.lit("[0-9]"))),
                "chars_per_word": per_word(F.col("word_chars")),
                "distinct_share": per_word(F.size(F.array_distinct("_s_h"))),
                "dup_line_share": F.col("n_dup_lines") / F.greatest(n_lines, F.lit(1)).cast("double"),
                "repeat_share": per_word(F.col("n_repeat_words")),
                "words_per_line": F.col("n_words") / F.greatest(n_lines, F.lit(1)).cast("double"),
                "log_words": F.log1p(F.col("n_words").cast("double")),
                "end_marks_per_word": per_word(F.regexp_count("_s_t", F.lit(r"[.]"))),
            }
        )
        names += RATIOS
    # A filter on a statistic must not be pushed below the steps above, which would spell all of them out again inside
    # each other; it stops at a generator.
    return df.select(*keep, F.inline(F.array(F.struct(*names))))
