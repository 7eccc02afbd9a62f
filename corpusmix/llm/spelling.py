"""Spelling variants of a corpus's words, found by sorting rotations.

A word gets an end mark and is written in all its rotations. Two words that differ by one replaced
character have rotations that agree up to their last character, the edited one; a word with one
character more has a rotation that is a rotation of the shorter word and then that character. So
neighbours share a range of the sorted rotations: those that are, or that begin with, one string and have at most
one character after it. Such a range holds at most one word more than the alphabet has letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.session import materialize

END = "$"  # no letter of a word
# The letters of a word and the rates of the query's contract.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5


def _slipped(doc_id: Column, run: Column, every: int) -> Column:
    """``run`` without one letter where the checksum of its document and itself is a multiple of ``every``."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    hashed = F.crc32(key.cast("binary"))
    at = (hashed % F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(hashed % every == 0, shorter).otherwise(run)


def word_counts(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    slip_every: int = SLIP_EVERY,
) -> DataFrame:
    """``word, n`` of the words of whole texts (``doc_id, text``) that are long and frequent enough.

    A null text has no words; a null doc_id counts as empty text in the checksum; repeated rows
    count as often as they are there. A word that may lose a letter has as many letters before.
    """
    run = F.col("run")
    # A maximal run that is too short is passed over by the pattern itself.
    runs = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1))
    listed = docs.select("doc_id", F.explode(F.transform(runs, lambda r: F.translate(r, UPPER, LOWER))).alias("run"))
    words = listed.select(_slipped(F.col("doc_id"), run, slip_every).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """``word, n, range, gone, counts``: each rotation whole, and without its last letter.

    ``gone`` is the letter left out, empty for a whole rotation. Of several equal letters side by side
    only leaving out the first ``counts`` as an insertion or deletion, as all give the same word.
    """
    word, at = F.col("word"), F.col("at")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")).select(
        "word", "n", "at", F.concat(F.substr(word, at + 1), F.lit(END), F.substr(word, F.lit(1), at)).alias("rotation")
    )
    last = F.substr(word, at, F.lit(1))
    opens = (at == 1) | (last != F.substr(word, at - 1, F.lit(1)))
    whole = F.struct(F.col("rotation").alias("range"), F.lit("").alias("gone"), F.lit(True).alias("counts"))
    short = F.struct(
        F.substr("rotation", F.lit(1), F.length("word")).alias("range"), last.alias("gone"), opens.alias("counts")
    )
    both = F.when(at > 0, F.array(whole, short)).otherwise(F.array(whole))
    return turned.select("word", "n", F.inline(both))


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: how many words are near, and the most frequent one of them.

    Words without a near one have no row. Of equally frequent ones the first in code-point order is best.
    """
    same = Window.partitionBy("range")
    ranked = same.orderBy(F.desc("n"), "word")
    line = F.struct("n", "word")
    is_whole = F.col("gone") == ""
    scanned = rotations(words).select(
        "word",
        is_whole.alias("whole"),
        "counts",
        F.when(F.row_number().over(ranked) == 1, F.lead(line).over(ranked))
        .otherwise(F.first(line).over(ranked))
        .alias("other"),
        F.count_if(~is_whole).over(same).alias("shorts"),
        F.count_if(is_whole).over(same).alias("wholes"),
        F.count_if(~is_whole & F.col("counts")).over(same).alias("longer"),
    )
    shorter = F.when(F.col("counts"), F.col("wholes")).otherwise(0)
    near = F.when(F.col("whole"), F.col("longer")).otherwise(F.col("shorts") - 1 + shorter)
    return (
        scanned.where(F.col("other").isNotNull())
        .groupBy("word")
        .agg(
            F.sum(near).alias("n_near"),
            F.min(F.struct((-F.col("other.n")).alias("less"), F.col("other.word").alias("word"))).alias("best"),
        )
        .select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form (``word, form``): the last word when forms are followed.

    Every round doubles the steps taken. Counts grow with each form, so there are no rings, and few rounds.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "variant_roots")
    while True:
        steps = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = roots.join(steps, "root", "left")
        if followed.where(F.col("next").isNotNull()).isEmpty():
            return roots
        roots = materialize(followed.select("word", F.coalesce("next", "root").alias("root")), "variant_roots")


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, form, root, n_near, form_n`` of each row of ``words`` (``word, n``; words once each).

    A word's form is its most frequent near word if that is ``times`` as frequent as itself; the root is
    where forms end, the word itself without one. An empty table gives an empty one. Null words are left out.
    """
    known = materialize(words.select("word", "n").where(F.col("word").isNotNull()), "variant_words")
    is_form = F.col("best_n") >= F.col("n") * times
    judged = materialize(
        known.join(neighbours(known), "word", "left").select(
            "word",
            "n",
            F.when(is_form, F.col("best")).alias("form"),
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "variant_forms",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
