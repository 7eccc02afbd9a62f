"""Dictionary sources: term pairs become translations, definitions become questions and answers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import column, fill_sql, is_missing, keyed_hash, pick, quoted, strip
from corpusmix.operators.bitext import direction_struct


def _field(df: DataFrame, name: str) -> Column:
    """A dictionary column, stripped; blank where it is null or the table lacks it."""
    if name not in df.columns:
        return F.lit("")
    return strip(F.coalesce(column(name).cast("string"), F.lit("")))


def dictionary_terms(df: DataFrame) -> DataFrame:
    """Rows with both terms present, as ``en, cy, en_def, cy_def, en_full, cy_full``.

    The ``_full`` columns are the definitions with their context appended.
    """
    fields = df.select(
        "order_key",
        _field(df, fixed.TERM_EN).alias("en"),
        _field(df, fixed.TERM_CY).alias("cy"),
        _field(df, fixed.DEFINITION_EN).alias("en_def"),
        _field(df, fixed.DEFINITION_CY).alias("cy_def"),
        _field(df, fixed.CONTEXT_EN).alias("en_ctx"),
        _field(df, fixed.CONTEXT_CY).alias("cy_ctx"),
    )

    def enriched(definition: str, context: str, label: str) -> Column:
        text = F.col(definition)
        return F.when(is_missing(F.col(context)), text).otherwise(
            F.concat(text, F.lit(label), F.col(context))
        )

    present = fields.where(~is_missing(F.col("en")) & ~is_missing(F.col("cy")))
    return present.select(
        "order_key",
        "en",
        "cy",
        "en_def",
        "cy_def",
        enriched("en_def", "en_ctx", fixed.CONTEXT_LABEL_EN).alias("en_full"),
        enriched("cy_def", "cy_ctx", fixed.CONTEXT_LABEL_CY).alias("cy_full"),
    )


def _question_struct(
    position: int,
    direction: str,
    templates: Sequence[tuple[str, str]],
    definition: str,
    full: str,
) -> str:
    """SQL for one question record; column ``pick_<source>`` says which template is used."""
    source, target = direction.split("-")
    slots = {"en": "en", "cy": "cy", "definition": full}

    def chosen(side: int) -> str:
        texts = ", ".join(fill_sql(template[side], **slots) for template in templates)
        return f"get(array({texts}), pick_{source})"

    return (
        f"named_struct('task', {quoted(fixed.TASK_INSTRUCTION)}, "
        f"'source_text', {chosen(0)}, 'target_text', {chosen(1)}, "
        f"'source_lang_code', '{source}', 'target_lang_code', '{target}', "
        f"'emit_ord', {position}, '_present', has_{definition})"
    )


def dictionary_records(
    df: DataFrame, directions: Iterable[str], seed: object = fixed.SEED
) -> DataFrame:
    """All flat records of a dictionary source in one pass over it.

    A row gives its translations first, then a question about the Welsh term if
    there is a Welsh definition, then one about the English term if there is an
    English definition. The questions do not depend on ``directions``.
    """
    hashes = {code: keyed_hash(f"{seed}/{code}", F.col("order_key")) for code in ("en", "cy")}
    terms = dictionary_terms(df).select(
        "*",
        pick(hashes["en"], len(fixed.EN_TO_CY_TEMPLATES)).alias("pick_en"),
        pick(hashes["cy"], len(fixed.CY_TO_EN_TEMPLATES)).alias("pick_cy"),
        (~is_missing(F.col("en_def"))).alias("has_en_def"),
        (~is_missing(F.col("cy_def"))).alias("has_cy_def"),
    )
    records = [
        direction_struct(position, direction, {"en": "en", "cy": "cy"}, ", '_present', true")
        for position, direction in enumerate(directions)
    ]
    at = len(records)
    records += [
        _question_struct(at, "en-cy", fixed.EN_TO_CY_TEMPLATES, "cy_def", "cy_full"),
        _question_struct(at + 1, "cy-en", fixed.CY_TO_EN_TEMPLATES, "en_def", "en_full"),
    ]
    emitted = terms.select("order_key", F.expr(f"inline(array({', '.join(records)}))"))
    return emitted.where("_present").drop("_present")


def dictionary_breakdown(records: DataFrame) -> DataFrame:
    """How many translations and questions each direction got."""
    return records.groupBy("task", "source_lang_code", "target_lang_code").agg(
        F.count("*").alias("rows")
    )
