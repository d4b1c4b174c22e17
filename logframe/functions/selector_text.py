"""Selectors written as text: ``{job="api", level=~"err.*"} |= "timeout" !~ "retry [0-9]+"``.

Only the braces with their matchers and the four line operators behind them are read.  Whatever
else follows (pipeline stages, functions over ranges) is refused.
"""

from __future__ import annotations

import re

from logframe.functions.lines import LineFilter
from logframe.functions.matchers import Matcher

# The operators of the text form.
_LABEL_OPERATORS = r"=~|!~|!=|="
_LINE_OPERATORS = {"|=": "contains", "!=": "not contains", "|~": "regex", "!~": "not regex"}
_ESCAPED = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "\\": "\\", '"': '"', "'": "'"}

_TEXT = r'"(?:[^"\\\n]|\\.)*"|`[^`]*`'
_MATCHER = re.compile(rf"\s*([A-Za-z_][A-Za-z0-9_]*)\s*({_LABEL_OPERATORS})\s*({_TEXT})\s*")
_FILTER = re.compile(rf"\s*(\|=|\|~|!=|!~)\s*({_TEXT})\s*")
_ESCAPE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)


def _text(quoted: str) -> str:
    if quoted[0] == "`":
        return quoted[1:-1]

    def plain(found: re.Match) -> str:
        code = found.group(1) or found.group(2) or found.group(3)
        if code is None and found.group(4) not in _ESCAPED:
            raise ValueError(f"unknown escape {found.group(0)!r} in {quoted}")
        if code is not None and int(code, 16) > 0x10FFFF:
            raise ValueError(f"no such character: {found.group(0)!r}")
        return _ESCAPED[found.group(4)] if code is None else chr(int(code, 16))

    return _ESCAPE.sub(plain, quoted[1:-1])


def read_selector(text: str) -> tuple[list[Matcher], list[LineFilter]]:
    """The matchers and the line filters of a selector text."""
    opening = re.compile(r"\s*\{").match(text)
    if not opening:
        raise ValueError(f"a selector text begins with a brace: {text!r}")
    at, matchers, filters = opening.end(), [], []
    while True:
        found = _MATCHER.match(text, at)
        if found is None:
            if not matchers and (closing := re.compile(r"\s*\}").match(text, at)):
                at = closing.end()
                break
            raise ValueError(f"expected a matcher at {text[at:at + 20]!r} in {text!r}")
        matchers.append((found.group(1), found.group(2), _text(found.group(3))))
        at = found.end() + 1
        if text[found.end() : at] == "}":
            break
        if text[found.end() : at] != ",":
            raise ValueError(f"expected a comma or a closing brace at {text[found.end():at + 20]!r} in {text!r}")
    while text[at:].strip():
        found = _FILTER.match(text, at)
        if found is None:
            raise ValueError(f"only line filters may follow the braces, not {text[at:at + 20]!r}")
        filters.append((_LINE_OPERATORS[found.group(1)], _text(found.group(2))))
        at = found.end()
    return matchers, filters
