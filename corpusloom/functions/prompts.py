"""Prompt and conversation templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default system prompt, prompt template and chat layout.
SYSTEM_PROMPT = (
    "You are a knowledgeable assistant trained to provide accurate and helpful information. "
    "Please respond to the user's queries promptly and politely."
)
PROMPT_TEMPLATE = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n"
    + SYSTEM_PROMPT
    + "<|eot_id|>\n<|start_header_id|>user<|end_header_id|>\n{input}<|eot_id|>\n"
    + "<|start_header_id|>assistant<|end_header_id|>\n{output}"
)
CHAT_START = "<|begin_of_text|>"
TURN_PARTS = ("<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>")


def _template_parts(template: str) -> tuple[str, str, str]:
    """What stands before ``{input}``, between it and ``{output}``, and after."""
    if template.count("{input}") != 1 or template.count("{output}") != 1:
        raise ValueError("the template needs exactly one {input} and one {output}")
    head, rest = template.split("{input}")
    if "{output}" not in rest:
        raise ValueError("{output} must come after {input}")
    return head, *rest.split("{output}")


def prompt_parts(
    input_text: Column, output_text: Column, template: str = PROMPT_TEMPLATE
) -> tuple[Column, Column]:
    """The filled template in two: what is given, and what is to be answered."""
    head, middle, tail = _template_parts(template)
    return F.concat(F.lit(head), input_text, F.lit(middle)), F.concat(output_text, F.lit(tail))


def render_prompt(
    input_text: Column, output_text: Column, template: str = PROMPT_TEMPLATE
) -> Column:
    """Fill ``{input}`` and ``{output}``, each of which must occur once, in that order."""
    return F.concat(*prompt_parts(input_text, output_text, template))


def render_chat(turns: Column) -> Column:
    """One chat string from ``array<struct(turn, role, text)>`` in turn order.

    A turn without a role or text keeps its place, with nothing in that part.
    """
    before, after, end = TURN_PARTS
    parts = F.transform(
        F.array_sort(turns),
        lambda t: F.concat(F.lit(before), F.coalesce(t["role"], F.lit("")), F.lit(after), F.coalesce(t["text"], F.lit("")), F.lit(end)),
    )
    return F.concat(F.lit(CHAT_START), F.array_join(parts, ""))


def messages(user: Column, assistant: Column) -> Column:
    """``array<struct(role, content)>`` of one user and one assistant message."""
    return F.array(
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )
