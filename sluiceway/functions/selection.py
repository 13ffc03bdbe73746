"""Which streams an option applies to: booleans, text, or glob patterns, last match wins."""

from __future__ import annotations

import fnmatch
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean yes and no.
TRUE_STRINGS = {"1", "true", "t", "yes", "y", "on"}
FALSE_STRINGS = {"", "0", "false", "f", "no", "n", "off", "none", "null"}


def _steps(selection: Any) -> list[Any]:
    """Any accepted form as an ordered list of patterns and plain yes/no values."""
    if isinstance(selection, str):
        text = selection.strip()
        if text.lower() in TRUE_STRINGS:
            return [True]
        if text.lower() in FALSE_STRINGS:
            return [False]
        if text[0] == "[":
            try:
                return _steps(json.loads(text))
            except json.JSONDecodeError:
                pass
        return [part for part in map(str.strip, text.split(",")) if part]
    return list(selection) if isinstance(selection, (list, tuple)) else [bool(selection)]


def is_selected(selection: Any, stream: str) -> bool:
    """Whether a selection picks one stream known on the driver."""
    verdict = False
    for step in _steps(selection):
        if not isinstance(step, str):
            verdict = bool(step)
        elif fnmatch.fnmatchcase(stream, step.removeprefix("!")):
            verdict = step[:1] != "!"
    return verdict


def _java_glob(pattern: str) -> str:
    regex = fnmatch.translate(pattern)
    for end in (r"\Z", r"\z"):
        regex = regex.removesuffix(end)
    return "^" + regex + r"\z"


def selects(selection: Any, stream: Column | str = "stream") -> Column:
    """The same rule as a condition over a column of stream names."""
    column = F.col(stream) if isinstance(stream, str) else stream
    verdict = F.lit(False)
    for step in _steps(selection):
        if not isinstance(step, str):
            verdict = F.lit(bool(step))
        else:
            hit = column.rlike(_java_glob(step.removeprefix("!")))
            verdict = F.when(hit, F.lit(step[:1] != "!")).otherwise(verdict)
    return verdict
