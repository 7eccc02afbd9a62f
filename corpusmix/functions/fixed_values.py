"""Values that must equal the published ones for results to agree.

Everything in this module is a fixed value (a word list, a column-name list, a
template text or a default), stated as plain text. There is no logic here.
"""

# --- fixed values: tasks and directions -------------------------------------
TASK_TRANSLATION = "translation"
TASK_INSTRUCTION = "instruction"
DIRECTIONS = ("en-cy", "cy-en")
DEFAULT_DIRECTIONS = ("en-cy",)

# --- fixed values: the flat record ------------------------------------------
FLAT_COLUMNS = (
    "task",
    "source_text",
    "target_text",
    "source_lang_code",
    "target_lang_code",
)

# --- fixed values: column names tried for each side, first usable one wins ---
ENGLISH_COLUMNS = ("text_en", "en", "english", "source", "Saesneg")
WELSH_COLUMNS = ("text_cy", "cy", "welsh", "cymraeg", "target")
INSTRUCTION_SOURCE_COLUMNS = ("instruction", "prompt", "input", "text_en")
INSTRUCTION_TARGET_COLUMNS = ("output", "response", "completion", "text_cy")

# --- fixed values: dictionary columns ---------------------------------------
TERM_EN = "Saesneg"
TERM_CY = "Cymraeg"
DEFINITION_EN = "Diffiniad Saesneg"
DEFINITION_CY = "Diffiniad Cymraeg"
CONTEXT_EN = "Cyd-destun Saesneg"
CONTEXT_CY = "Cyd-destun Cymraeg"
CONTEXT_LABEL_EN = "\nContext: "
CONTEXT_LABEL_CY = "\nCyd-destun: "
MISSING_WORDS = ("none", "null", "")

# --- fixed values: dictionary question and answer texts ----------------------
# {en} and {cy} are the two terms, {definition} is the definition with context.
EN_TO_CY_TEMPLATES = (
    (
        "How do you say '{en}' in Welsh? Please provide a definition.",
        "The Welsh term for '{en}' is '{cy}'. It refers to {definition}",
    ),
    (
        "What is the Welsh equivalent of the term '{en}'? Explain what it means.",
        "In Welsh, '{en}' is translated as '{cy}'. This term is used to describe {definition}",
    ),
    (
        "I'm looking for the Welsh word for '{en}'. Could you also explain its meaning?",
        "Certainly! The Welsh word is '{cy}', which means {definition}",
    ),
)
CY_TO_EN_TEMPLATES = (
    (
        "Beth yw'r gair Saesneg am '{cy}', a beth yw'r diffiniad?",
        "Y term Saesneg ar gyfer '{cy}' yw '{en}'. Mae'n golygu {definition}",
    ),
    (
        "Sut ydych chi'n dweud '{cy}' yn Saesneg? Eglurwch yr ystyr hefyd.",
        "'{en}' yw'r cyfystyron Saesneg ar gyfer '{cy}'. Dyma'r esboniad: {definition}",
    ),
)

# --- fixed values: conversation roles ----------------------------------------
USER_ROLES = ("user", "human")
ASSISTANT_ROLES = ("assistant",)

# --- fixed values: turn markers ----------------------------------------------
USER_TURN = "<start_of_turn>user\n"
MODEL_TURN = "<start_of_turn>model\n"
END_OF_TURN = "<end_of_turn>\n"
BOS = "<bos>"
MEASURED_TEXT = (
    "<start_of_turn>user\nTranslate this: {source}<end_of_turn>\n"
    "<start_of_turn>model\n{target}<end_of_turn>"
)

# --- fixed values: budgets, shares, seeds ------------------------------------
MAX_TOKENS = 2048
MAX_SOURCE_TOKENS = 1266
SEED = 42
DEFAULT_RATIO = "70:30"
DEFAULT_EVAL_ROWS = 1000
PERCENTILES = (0.5, 0.95, 0.99, 0.999)

# --- fixed values: the 29 characters that count as white space ----------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
