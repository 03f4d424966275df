"""Text columns built from prediction columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventward import catalog


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill `{name}` places of a template with columns."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def or_text(column: str, text: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(text))


def format_confidence(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f%%", c * 100.0))


def _prediction_values(missing: str) -> dict[str, Column]:
    names = ["predicted_label", "description", "predicted_tactic", "tactic_name", "predicted_technique"]
    return {n: or_text(n, missing) for n in names} | {
        "stage1": format_confidence("stage1_confidence"),
        "stage2": format_confidence("stage2_confidence"),
    }


def analyze_prompt() -> Column:
    return render(catalog.ANALYZE_PROMPT + catalog.PLAIN_PROSE_SUFFIX, _prediction_values("None"))


def report_prompt() -> Column:
    return render(catalog.REPORT_PROMPT + catalog.PLAIN_PROSE_SUFFIX, _prediction_values("None"))


def ask_prompt(question: str | Column) -> Column:
    """Confidence lines appear only where there is a confidence."""
    values = _prediction_values("None")
    values["question"] = F.coalesce(F.lit(question) if isinstance(question, str) else question, F.lit(""))
    optional = [
        F.when(F.col(column).isNotNull(), render(line, values)).otherwise(F.lit(""))
        for column, line in [
            ("stage1_confidence", catalog.ASK_PROMPT_STAGE1),
            ("stage2_confidence", catalog.ASK_PROMPT_STAGE2),
        ]
    ]
    return F.concat(
        render(catalog.ASK_PROMPT_HEAD, values),
        *optional,
        render(catalog.ASK_PROMPT_TAIL + catalog.PLAIN_PROSE_SUFFIX, values),
    )


def report_text(explanation: str | Column = "explanation") -> Column:
    values = _prediction_values("-")
    for name in ("predicted_tactic", "tactic_name", "predicted_technique"):
        values[name] = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("-"))
    values["predicted_label"] = or_text("predicted_label", "None")
    values["severity"] = F.when(F.col("is_attack"), F.lit("CRITIQUE")).otherwise(F.lit("INFO"))
    text = F.col(explanation) if isinstance(explanation, str) else explanation
    values["explanation"] = F.coalesce(text, F.lit("None"))
    return render(catalog.REPORT_FORMAT, values)
