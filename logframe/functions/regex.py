"""Regular expressions: RE2 syntax in, Java syntax out.

Log selectors and line filters use RE2 patterns; Spark's ``rlike`` runs Java
patterns.  The two agree on nearly everything users write.  This module holds
the small driver-side adapter for the places where they differ, so that the
resulting ``Column`` stays a plain built-in expression.
"""

from __future__ import annotations

import re

# The characters that carry meaning in a pattern and must be
# preceded by a backslash to stand for themselves.
SPECIAL_CHARACTERS = "\\.+*?()|[]{}^$"

# RE2 names for character classes inside brackets. Those with letters are ranges, as only
# ranges take in the two letters of other scripts that fold to ASCII ones.
_POSIX_CLASSES = {
    "alnum": r"0-9A-Za-z",
    "alpha": r"A-Za-z",
    "ascii": r"\x00-\x7F",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}",
    "graph": r"!-~",
    "lower": r"a-z",
    "print": r" -~",
    "punct": r"\p{Punct}",
    "space": r"\p{Space}",
    "upper": r"A-Z",
    "word": r"0-9A-Za-z_",
    "xdigit": r"\p{XDigit}",
}

# Letters that may follow a backslash, and how Java has to be told.
_ESCAPES = {
    "a": r"\x07",
    "f": r"\f",
    "n": r"\n",
    "r": r"\r",
    "t": r"\t",
    "v": r"\x0B",
    "d": r"\d",
    "D": r"\D",
    "s": r"[\t\n\f\r ]",
    "S": r"[^\t\n\f\r ]",
    "w": r"[0-9A-Za-z_]",
    "W": r"[^0-9A-Za-z_]",
    "A": r"\A",
    "z": r"\z",
    # Java would count letters and digits of all scripts as parts of a word here.
    "b": r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))",
    "B": r"(?:(?<=\w)(?=\w)|(?<!\w)(?!\w))",
}
_IN_CLASS = {c: j for c, j in _ESCAPES.items() if c not in "sSAzbBw"} | {"s": r"\t\n\f\r ", "w": "0-9A-Za-z_"}

# The general categories, and the scripts that are passed on.
_CATEGORIES = (
    "C Cc Cf Co Cs L Ll Lm Lo Lt Lu M Mc Me Mn N Nd Nl No P Pc Pd Pe Pf Pi Po Ps S Sc Sk Sm So Z Zl Zp Zs".split()
)
_SCRIPTS = (
    "Arabic Armenian Bengali Bopomofo Braille Cherokee Common Coptic Cyrillic Devanagari Ethiopic Georgian Gothic "
    "Greek Gujarati Gurmukhi Han Hangul Hebrew Hiragana Inherited Kannada Katakana Khmer Lao Latin Malayalam Mongolian "
    "Myanmar Ogham Oriya Runic Sinhala Syriac Tamil Telugu Thaana Thai Tibetan Yi"
).split()

_MOST_REPEATS = 1000
_REPEAT = re.compile(r"\{([0-9]+)(,([0-9]*))?\}")
_FLAGS = re.compile(r"\(\?([imsU]*)(-[imsU]+)?([:)])")
_NAMED = re.compile(r"\(\?P?<([A-Za-z0-9_]+)>")
_HEX = re.compile(r"\\x(?:[0-9A-Fa-f]{2}|\{([0-9A-Fa-f]+)\})")
_PROPERTY = re.compile(r"\\([pP])(?:\{(\^?)([A-Za-z_]+)\}|([A-Z]))")


def escape_literal(text: str) -> str:
    """Return a pattern that matches exactly ``text``."""
    return "".join("\\" + c if c in SPECIAL_CHARACTERS else c for c in text)


def _posix_class(pattern: str, at: int) -> tuple[str, int] | None:
    m = re.compile(r"\[:(\^?)(\w+):\]").match(pattern, at)
    if m is None or m.group(2) not in _POSIX_CLASSES:
        return None
    java = _POSIX_CLASSES[m.group(2)]
    if m.group(1):
        java = r"\P" + java[2:] if java.startswith(r"\p") else f"[^{java}]"
    return java, m.end()


class _Translation:
    """One pass over a pattern: its Java form, and whether it accepts the empty text."""

    def __init__(self, pattern: str) -> None:
        self.pattern, self.at, self.names = pattern, 0, set()
        self.java, self.empty, self.repeats = self._alternatives(False, 0)
        if self.at < len(pattern):
            raise self._refused("unexpected )")

    def _refused(self, why: str) -> ValueError:
        return ValueError(f"{why} in pattern {self.pattern!r}")

    def _alternatives(self, multiline: bool, depth: int) -> tuple[str, bool, int]:
        """Up to the end of the group: Java text, whether empty is accepted, the largest repeat count."""
        if depth > 200:
            raise self._refused("too many nested groups")
        out: list[str] = []
        some_empty, all_empty, most = False, True, 1
        while self.at < len(self.pattern) and self.pattern[self.at] != ")":
            c = self.pattern[self.at]
            if c == "|":
                some_empty, all_empty = some_empty or all_empty, True
                out.append(c)
                self.at += 1
                continue
            flags = _FLAGS.match(self.pattern, self.at)
            if flags and flags.group(3) == ")":
                multiline = self._switched(flags, multiline)
                out.append(self._java_flags(flags))
                self.at = flags.end()
                if self._repeat() is not None:
                    raise self._refused("nothing to repeat")
                continue
            java, empty, count = self._atom(multiline, depth)
            repeat = self._repeat()
            if repeat is not None:
                text, least, times = repeat
                if self._repeat() is not None:
                    raise self._refused("a repeat of a repeat")
                count *= times
                if count > _MOST_REPEATS:
                    raise self._refused("too many repeats")
                java, empty = (f"(?:{java})" if java in ("^", "$", "\\z") else java) + text, empty or least == 0
            most = max(most, count)
            all_empty = all_empty and empty
            out.append(java)
        return "".join(out), some_empty or all_empty, most

    def _repeat(self) -> tuple[str, int, int] | None:
        """The repeat that begins here, if any: its text, the least number, the factor it adds."""
        rest = self.pattern[self.at : self.at + 1]
        counted = _REPEAT.match(self.pattern, self.at)
        if rest and rest in "*+?":
            text, least, times = rest, 1 if rest == "+" else 0, 1
        elif counted:
            low, high = int(counted.group(1)), counted.group(3)
            if max(low, int(high or 0)) > _MOST_REPEATS or (high and int(high) < low):
                raise self._refused("bad repeat count")
            text, least, times = counted.group(0), low, max(int(high or 0), low, 1)
        else:
            return None
        self.at += len(text)
        if self.pattern[self.at : self.at + 1] == "?":  # the shortest match first
            text += "?"
            self.at += 1
        return text, least, times

    def _atom(self, multiline: bool, depth: int) -> tuple[str, bool, int]:
        c = self.pattern[self.at]
        if c == "(":
            return self._group(multiline, depth)
        if c == "[":
            return self._bracket(), False, 1
        if c == "\\":
            return self._escape()
        if c in "*+?" or _REPEAT.match(self.pattern, self.at):
            raise self._refused("nothing to repeat")
        self.at += 1
        if c == "$":
            return ("$" if multiline else r"\z"), True, 1
        if c == "^":
            return (r"(?:^|(?<=\n))" if multiline else "^"), True, 1
        return ("\\" + c if c in "{}]" else c), False, 1

    def _switched(self, flags: re.Match, multiline: bool) -> bool:
        on, off = flags.group(1), flags.group(2) or ""
        if "U" in on + off:
            raise self._refused("the U flag is not supported")
        return "m" in on or (multiline and "m" not in off)

    def _java_flags(self, flags: re.Match) -> str:
        # Java folds the case of ASCII letters only, unless told with u.
        return flags.group(0).replace("i", "iu")

    def _group(self, multiline: bool, depth: int) -> tuple[str, bool, int]:
        flags, named = _FLAGS.match(self.pattern, self.at), _NAMED.match(self.pattern, self.at)
        if flags:
            opener, inner, self.at = self._java_flags(flags), self._switched(flags, multiline), flags.end()
        elif named:
            if named.group(1) in self.names or named.group(1)[0].isdigit():
                raise self._refused("bad group name")
            self.names.add(named.group(1))
            opener, inner, self.at = "(", multiline, named.end()  # names are never read, and Java knows fewer
        elif self.pattern.startswith("(?", self.at):
            raise self._refused("look-around, atomic groups and other extensions are not supported:")
        else:
            opener, inner, self.at = "(", multiline, self.at + 1
        java, empty, count = self._alternatives(inner, depth + 1)
        if self.at >= len(self.pattern):
            raise self._refused("missing closing )")
        self.at += 1
        return opener + java + ")", empty, count

    def _escape(self) -> tuple[str, bool, int]:
        c = self.pattern[self.at + 1 : self.at + 2]
        if c == "Q":
            end = self.pattern.find("\\E", self.at + 2)
            text = self.pattern[self.at + 2 : end if end >= 0 else len(self.pattern)]
            self.at = end + 2 if end >= 0 else len(self.pattern)
            # A repeat behind it means the last character only.
            if len(text) > 1 and self.pattern[self.at : self.at + 1] and self.pattern[self.at] in "*+?{":
                raise self._refused("a repeat behind quoted text is not supported")
            return escape_literal(text), not text, 1
        return self._escaped(_ESCAPES), c in ("A", "z", "B"), 1

    def _escaped(self, known: dict[str, str]) -> str:
        """The Java form of the escape that begins here."""
        c = self.pattern[self.at + 1 : self.at + 2]
        special = _PROPERTY.match(self.pattern, self.at) if c in ("p", "P") else _HEX.match(self.pattern, self.at) if c == "x" else None
        if special and c == "x":
            if int(special.group(1) or "0", 16) > 0x10FFFF:
                raise self._refused("bad character code")
            self.at = special.end()
            return special.group(0)
        if special:
            name = special.group(3) or special.group(4)
            sign = special.group(1) if not special.group(2) else "P" if special.group(1) == "p" else "p"
            if name not in _CATEGORIES and name not in _SCRIPTS:
                raise self._refused(f"unknown character class {name!r}")
            self.at = special.end()
            return f"\\{sign}{{{name if name in _CATEGORIES else 'Is' + name}}}"
        if not c:
            raise self._refused("trailing backslash")
        if c.isalnum() and c not in known:
            raise self._refused(f"invalid escape \\{c}")
        self.at += 2
        return known.get(c, "\\" + c)

    def _bracket(self) -> str:
        """The Java form of the bracket expression that begins here."""
        out = ["["]
        self.at += 1
        if self.pattern[self.at : self.at + 1] == "^":
            out.append("^")
            self.at += 1
        first = True
        while self.at < len(self.pattern):
            c = self.pattern[self.at]
            if c == "]" and not first:
                self.at += 1
                return "".join(out) + "]"
            first = False
            posix = _posix_class(self.pattern, self.at) if c == "[" else None
            if posix:
                java, self.at = posix
                out.append(java)
            elif self.pattern.startswith("[:", self.at):
                raise self._refused("unknown class name")
            elif c == "\\":
                out.append(self._escaped(_IN_CLASS))
            else:
                # '[' and '&&' would nest or intersect classes in Java.
                out.append("\\" + c if c in "[&]" else c)
                self.at += 1
        raise self._refused("missing closing ]")


def to_java(pattern: str) -> str:
    """Translate an RE2 pattern for partial matching with ``rlike``.

    * only ``\\n`` ends a line, so ``.`` matches ``\\r`` (the ``(?d)`` flag);
    * ``$`` means the very end of the text, not "before a final newline";
    * case folding reaches all letters, word boundaries only those of ASCII words;
    * a brace that is no repeat is a plain character;
    * what RE2 refuses and Java accepts (look-around, back-references, possessive repeats), and
      the little that cannot be said in Java, raises ``ValueError``.
    """
    return "(?d)" + _Translation(pattern).java


def to_java_anchored(pattern: str) -> str:
    """Like :func:`to_java`, but the whole text has to match."""
    return "(?d)^(?:" + _Translation(pattern).java + r")\z"


def literal_alternatives(pattern: str) -> list[str] | None:
    """``a|b|c`` made only of plain characters, as a list; otherwise ``None``."""
    parts = pattern.split("|")
    if any(c in SPECIAL_CHARACTERS for part in parts for c in part):
        return None
    return parts


def literal_prefix(pattern: str) -> str:
    """Plain characters every full match of ``pattern`` has to start with."""
    if "|" in pattern or "\\" in pattern or "(?" in pattern:
        return ""
    prefix = re.match(r"[^.+*?()|\[\]{}^$]*", pattern).group(0)
    if pattern[len(prefix) : len(prefix) + 1] in ("*", "+", "?", "{"):
        prefix = prefix[:-1]
    return prefix


def required_literal(pattern: str) -> str:
    """The longest plain text every (partial) match of ``pattern`` has to contain, if easily told."""
    if any(c in pattern for c in "|\\([{"):
        return ""
    optional = re.compile(r"[^.+*?^$)\]}][*?]")  # a character that may be absent
    runs = re.split(r"[.+*?^$)\]}]+", optional.sub(".", pattern))
    return max(runs, key=len)


def matches_empty(pattern: str) -> bool:
    """Whether a fully anchored ``pattern`` accepts the empty string."""
    return _Translation(pattern).empty
