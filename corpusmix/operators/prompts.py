"""Prompt and completion texts in the turn format the model is trained on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import fill, strip
from corpusmix.operators.selection import first_rows

# A plain stand-in for the model's own chat template, which callers pass in.
TRANSLATION_TEMPLATE = (
    fixed.BOS
    + fixed.USER_TURN
    + "Translate from {source_lang_code} to {target_lang_code}:\n{text}"
    + fixed.END_OF_TURN
    + fixed.MODEL_TURN
)


def check_template(template: str) -> None:
    """A template must leave off exactly where the model's answer starts."""
    if "{text}" not in template:
        raise ValueError("the translation template has no {text} slot")
    if not template.endswith(fixed.MODEL_TURN):
        raise ValueError(f"the translation template must end with {fixed.MODEL_TURN!r}")


def translation_prompt(template: str = TRANSLATION_TEMPLATE) -> Column:
    check_template(template)
    return fill(
        template,
        source_lang_code="source_lang_code",
        target_lang_code="target_lang_code",
        text="source_text",
    )


def instruction_prompt(bos: str = fixed.BOS) -> Column:
    return F.concat(
        F.lit(bos + fixed.USER_TURN),
        strip(F.col("source_text")),
        F.lit(fixed.END_OF_TURN + fixed.MODEL_TURN),
    )


def prompt(template: str = TRANSLATION_TEMPLATE, bos: str = fixed.BOS) -> Column:
    """The prompt for the row's task; a task that has none fails the query."""
    unknown = F.concat(F.lit("no prompt for task "), F.coalesce(F.col("task"), F.lit("null")))
    return (
        F.when(F.col("task") == fixed.TASK_TRANSLATION, translation_prompt(template))
        .when(F.col("task") == fixed.TASK_INSTRUCTION, instruction_prompt(bos))
        .otherwise(F.raise_error(unknown).cast("string"))
    )


def completion() -> Column:
    return F.concat(strip(F.col("target_text")), F.lit(fixed.END_OF_TURN))


def render(
    df: DataFrame,
    template: str = TRANSLATION_TEMPLATE,
    bos: str = fixed.BOS,
    max_rows: int | None = None,
    order_key: str = "order_key",
) -> DataFrame:
    """``prompt`` and ``completion`` of all rows, or of the first ``max_rows`` of them."""
    rows = df if max_rows is None else first_rows(df, max_rows, order_key)
    return rows.select(prompt(template, bos).alias("prompt"), completion().alias("completion"))


def boundary_violations(rendered: DataFrame) -> DataFrame:
    """Number of prompts that do not stop where the answer starts (should be 0)."""
    wrong = ~F.col("prompt").endswith(fixed.MODEL_TURN)
    return rendered.agg(F.count_if(wrong).alias("violations"), F.count("*").alias("rows"))
