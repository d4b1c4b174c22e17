from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def formatted_plan(df: DataFrame) -> str:
    """The text of ``df.explain("formatted")``."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_facts(df: DataFrame) -> dict[str, list[str]]:
    """What each scan of the plan reads and pushes, by heading of the formatted plan."""
    text = formatted_plan(df)
    return {
        heading: re.findall(rf"^{heading}: (.*)$", text, flags=re.MULTILINE)
        for heading in ("PartitionFilters", "PushedFilters", "ReadSchema")
    }
