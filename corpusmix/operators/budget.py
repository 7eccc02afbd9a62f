"""Token budget: drop over-long sources, cut over-long targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.frames import compute_once
from corpusmix.functions.text import fill
from corpusmix.functions.tokens import PatternTokenizer, Tokenizer
from corpusmix.operators.prompts import TRANSLATION_TEMPLATE, completion, prompt


def measure(df: DataFrame, tokenizer: Tokenizer = PatternTokenizer()) -> DataFrame:
    """Add ``src_len`` and ``tgt_len``, each counted exactly once per row."""
    if "src_len" in df.columns and "tgt_len" in df.columns:
        return df
    return compute_once(
        df,
        src_len=tokenizer.count(F.col("source_text")),
        tgt_len=tokenizer.count(F.col("target_text")),
    )


def is_over_limit(max_tokens: int = fixed.MAX_TOKENS) -> Column:
    """Either side alone is longer than the budget."""
    return (F.col("src_len") > max_tokens) | (F.col("tgt_len") > max_tokens)


def enforce_budget(
    df: DataFrame,
    tokenizer: Tokenizer = PatternTokenizer(),
    max_tokens: int = fixed.MAX_TOKENS,
    max_source_tokens: int = fixed.MAX_SOURCE_TOKENS,
    template: str = TRANSLATION_TEMPLATE,
    bos: str = fixed.BOS,
    budget: str = "sides",
) -> DataFrame:
    """Rows within the budget, and over-long ones with their target cut to fit.

    One scan and one projection: the two buckets differ by the ``over_limit``
    column, and only rows of the second are tokenised again to be cut. What is
    left for the target is the budget less padding, prompt and closing marker. A row is over
    the limit if one of its sides alone is (``sides``), or if its target is longer than what is
    left for it (``total``), which takes counting every prompt.
    """
    if budget not in ("sides", "total"):
        raise ValueError(f"budget is {budget!r}, not 'sides' or 'total'")
    short_sources = measure(df, tokenizer).where(F.col("src_len") <= max_source_tokens)
    measured = prompt(template, bos)
    if budget == "sides":
        measured = F.when(is_over_limit(max_tokens), measured)
    left = F.lit(max_tokens - tokenizer.pad_tokens) - tokenizer.count(measured)
    room = F.greatest(F.lit(0), left - tokenizer.count(F.lit(fixed.END_OF_TURN)))
    # Counted once, whatever uses it.
    short_sources = compute_once(short_sources, _allowed=room)
    allowed = F.col("_allowed")
    over = is_over_limit(max_tokens) if budget == "sides" else F.col("tgt_len") > allowed
    shortened = tokenizer.cut(F.when(over, F.col("target_text")), F.when(over, allowed))
    fitted = compute_once(
        short_sources,
        target_text=F.when(over & (F.col("tgt_len") > allowed), shortened).otherwise(
            F.col("target_text")
        ),
        over_limit=over,
    )
    return fitted.where(~F.col("over_limit") | (F.col("target_text") != "")).drop(
        "src_len", "tgt_len", "_allowed"
    )


def measured_text() -> Column:
    """The text whose tokens the length analysis counts, the same for both tasks."""
    return fill(
        fixed.MEASURED_TEXT,
        source="coalesce(source_text, '')",
        target="coalesce(target_text, '')",
    )


def rendered_text(template: str = TRANSLATION_TEMPLATE, bos: str = fixed.BOS) -> Column:
    """The prompt with its completion, as training reads them."""
    return F.concat(prompt(template, bos), completion())


def total_lengths(
    df: DataFrame, tokenizer: Tokenizer = PatternTokenizer(), text: Column | None = None
) -> DataFrame:
    """``task`` and ``total_tokens`` of every row, of the measured or of another ``text``."""
    total = tokenizer.count(measured_text() if text is None else text)
    return df.select("task", total.alias("total_tokens"))
