"""strftime-style timestamp formats as Spark datetime patterns."""

from __future__ import annotations

import re

# The directives we translate, and their Spark pattern letters.
DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%e": "d", "%j": "DDD",
    "%H": "HH", "%I": "hh", "%M": "mm", "%S": "ss", "%p": "a",
    "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE",
    "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%R": "HH:mm", "%D": "MM/dd/yy",
    "%z": "Z", "%Ez": "XXX", "%Z": "z", "%E6S": "ss.SSSSSS", "%E3S": "ss.SSS", "%%": "%",
}
_TOKEN = re.compile(r"%E?\d?[A-Za-z%]|[A-Za-z]+|.", re.DOTALL)


def java_pattern(fmt: str) -> str:
    """Translate a format, refusing directives without an exact counterpart."""
    out = []
    for token in _TOKEN.findall(fmt):
        if token[0] == "%":
            if token not in DIRECTIVES:
                raise ValueError(f"unsupported directive {token!r} in timestamp format {fmt!r}")
            out.append(DIRECTIVES[token])
        elif token == "'":
            out.append("''")
        else:
            out.append(f"'{token}'" if token.isalpha() or token in "[]{}#" else token)
    return "".join(out)
