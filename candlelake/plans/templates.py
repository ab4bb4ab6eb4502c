"""SQL text with ``{{name}}`` placeholders."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_BRACES = re.compile(r"\{\{(.*?)\}\}", re.DOTALL)


def render_sql(sql: str, context: Mapping[str, str]) -> str:
    """Fill in the placeholders. Every name in the text must be known; values enter the text as they are."""
    parts = _BRACES.split(sql)
    literal, names = parts[::2], [name.strip() for name in parts[1::2]]
    unknown = sorted({name for name in names if name not in context})
    if unknown or any("{{" in text or "}}" in text for text in literal):
        raise KeyError(f"template names without a value: {', '.join(unknown) or 'unpaired braces'}")
    values = [context[name] for name in names]
    return "".join(text + value for text, value in zip(literal, [*values, ""], strict=True))


def run_template(
    spark: SparkSession, sql: str, context: Mapping[str, str], args: Mapping[str, object] | None = None
) -> DataFrame:
    """Run a template: names by placeholder, values from outside by SQL parameter (``:name``)."""
    return spark.sql(render_sql(sql, context), args=dict(args or {}))
