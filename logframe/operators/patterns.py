"""What lines have in common: templates with their variable parts masked, and the fields that lines name.

Words that hold a digit are variable.  Lines are counted by the text that is left, in the scan tasks, and only
these texts go on.  They form a token tree, one per number of tokens; where a node of the tree has more children
than ``most``, its children are values and not words, and become one.  A node's children are known only when those above it are
settled, so the tree is walked level by level, down to ``depth``.  Every step is a count, so the result does not
depend on the order of the lines or on how they are dealt.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from logframe.functions.lines import LineFilter
from logframe.functions.matchers import Matcher
from logframe.functions.timebounds import TimeBound
from logframe.model import LINE, TS_NS, check_label_names, quoted
from logframe.operators.scan import scan_logs

MASK = "<_>"
#: A word with a digit: letters, digits and underscores.
VARIABLE = "[A-Za-z_]*[0-9][A-Za-z0-9_]*"
#: ``name=value`` at the start of the line or after white space, a bracket or a comma; the value may be quoted.
FIELD = r'(?:^|[\s,({\[])([A-Za-z_][A-Za-z0-9_.-]*)=("[^"]*"|[^\s,)}\]]*)'


def detected_patterns(
    df: DataFrame,
    selector: str | Iterable[Matcher],
    *,
    line: Iterable[LineFilter] = (),
    by: Sequence[str] = (),
    depth: int = 6,
    most: int = 40,
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> DataFrame:
    """The templates of a selection's lines: ``by`` labels, ``pattern, entries, first_ns, last_ns``.

    ``<_>`` stands for a variable part.  Tokens are parted by single blanks.  Of the first ``depth`` tokens those become
    ``<_>`` that have more than ``most`` others in their place after the same beginning, in lines of as many tokens.
    """
    for name, value in (("depth", depth), ("most", most)):
        if isinstance(value, bool) or not isinstance(value, int) or value < 0:
            raise ValueError(f"{name} must be a whole number, not {value!r}")
    names = check_label_names(by)
    keys = [quoted(name) for name in names]
    selected = scan_logs(df, selector, line=line, labels=names, start=start, end=end, limit=None, now=now)
    masked = selected.select(*keys, F.split(F.regexp_replace(LINE, VARIABLE, MASK), " ").alias("tokens"), TS_NS)
    found = masked.groupBy(*keys, "tokens").agg(F.count("*").alias("entries"), F.min(TS_NS).alias("first_ns"), F.max(TS_NS).alias("last_ns"))
    for level in range(depth):
        node = [F.size("tokens").alias("size"), F.slice("tokens", 1, level).alias("above")]
        token = F.get("tokens", F.lit(level))
        children = found.where(token.isNotNull()).select(*node, token.alias("token")).distinct()
        crowded = children.groupBy("size", "above").agg(F.count("*").alias("children")).where(F.col("children") > most)
        crowded = crowded.select(F.col("size").alias("s"), F.col("above").alias("a"))
        joined = found.join(crowded, (F.size("tokens") == F.col("s")) & (F.slice("tokens", 1, level) == F.col("a")), "left")
        merged = F.concat(F.slice("tokens", 1, level), F.array(F.lit(MASK)), F.slice("tokens", level + 2, 1 << 30))
        found = joined.withColumn("tokens", F.when(F.col("s").isNotNull(), merged).otherwise(F.col("tokens"))).drop("s", "a")
    return found.groupBy(*keys, F.array_join("tokens", " ").alias("pattern")).agg(F.sum("entries").alias("entries"), F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"))


def detected_fields(
    df: DataFrame,
    selector: str | Iterable[Matcher],
    *,
    line: Iterable[LineFilter] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> DataFrame:
    """The ``name=value`` fields of a selection's lines: ``field, kind, entries, distinct_values``.

    ``entries`` counts the fields found, ``distinct_values`` their values exactly.  The kind is the narrowest of ``int``, ``float``,
    ``boolean`` and ``string`` that all values have; quotes around a value do not count.
    """
    selected = scan_logs(df, selector, line=line, start=start, end=end, limit=None, now=now)
    pairs = selected.select(F.explode(F.arrays_zip(F.regexp_extract_all(LINE, F.lit(FIELD), 1).alias("f"), F.regexp_extract_all(LINE, F.lit(FIELD), 2).alias("v"))).alias("p"))
    values = pairs.select(F.col("p.f").alias("field"), F.regexp_replace("p.v", '^"(.*)"$', "$1").alias("value"))
    values = values.groupBy("field", "value").agg(F.count("*").alias("entries"))
    whole, number, truth = (F.bool_and(F.col("value").rlike(p)) for p in (r"^[+-]?[0-9]+\z", r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\z", r"^(true|false)\z"))
    kind = F.when(whole, "int").when(number, "float").when(truth, "boolean").otherwise("string")
    return values.groupBy("field").agg(kind.alias("kind"), F.sum("entries").alias("entries"), F.count("*").alias("distinct_values"))
