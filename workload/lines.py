"""Line filters, on free text."""

from __future__ import annotations

from pyspark.sql import functions as F

from logframe import scan_logs
from workload.registry import query
from workload.relations import DOC_LOGS, doc_logs, with_relations

ANY_LANG = [("lang", "=~", ".+")]
# Wide enough for every document id.
ALL_TIME = {"start": 0, "end": 2**63 - 1}


def doc_scan(spark, sf_dir, line=(), **arguments):
    arguments = {"labels": ["lang"], "keep": ["doc_id", "line_no"], "limit": None, **ALL_TIME, **arguments}
    return scan_logs(doc_logs(spark, sf_dir), ANY_LANG, line=line, **arguments)


def doc_sql(condition: str) -> str:
    return with_relations(
        DOC_LOGS, select=f"SELECT doc_id, line_no, line FROM doc_logs WHERE lang <> '' AND ({condition})"
    )


def _filtered(name, condition, *line):
    @query(name, doc_sql(condition))
    def run(spark, sf_dir):
        return doc_scan(spark, sf_dir, line).select("doc_id", "line_no", "line")


def _residual(name, condition, column):
    @query(name, doc_sql(condition))
    def run(spark, sf_dir):
        return doc_scan(spark, sf_dir).where(column()).select("doc_id", "line_no", "line")


_filtered("line_contains", "contains(line, 'the')", ("contains", "the"))
_filtered("line_not_contains", "line NOT LIKE '%the%'", ("not contains", "the"))
_filtered("line_prefix", "line LIKE 'Th%'", ("prefix", "Th"))
_filtered("line_suffix", "line LIKE '%is.'", ("suffix", "is."))
_filtered("line_not_prefix", "line NOT LIKE 'Th%'", ("not prefix", "Th"))
_filtered("line_not_suffix", "line NOT LIKE '%is.'", ("not suffix", "is."))
_filtered("line_regex", "regexp_matches(line, 'th.*ing')", ("regex", "th.*ing"))
_filtered("line_not_regex", "NOT regexp_matches(line, 'th.*ing')", ("not regex", "th.*ing"))
_filtered("line_regex_nocase", "regexp_matches(line, '(?i)É[a-zà-ü]+')", ("regex", "(?i)É[a-zà-ü]+"))
_filtered("line_regex_named_group", "regexp_matches(line, '(?P<first_word>th)e (?P<rest_1>[a-m])')", ("regex", "(?P<first_word>th)e (?P<rest_1>[a-m])"))
_filtered(
    "line_multi",
    "contains(line, 'e') AND NOT regexp_matches(line, '[0-9]+$') AND line NOT LIKE 'Th%'",
    ("contains", "e"),
    ("not regex", "[0-9]+$"),
    ("not prefix", "Th"),
)
_residual("line_double_not", "NOT (line NOT LIKE '%the%')", lambda: ~(~F.col("line").like("%the%")))
_residual("line_like_general", "line LIKE '%th_o%ing%'", lambda: F.col("line").like("%th_o%ing%"))
_residual(
    "line_residual",
    "length(line) > 200 OR line = ''",
    lambda: (F.length("line") > 200) | (F.col("line") == ""),
)


@query(
    "line_of_quality",
    with_relations(
        DOC_LOGS,
        select="SELECT doc_id, line_no, line FROM doc_logs WHERE quality = '1' AND contains(line, 'the')",
    ),
)
def line_of_quality(spark, sf_dir):
    scan = scan_logs(
        doc_logs(spark, sf_dir, quality=True),
        [("quality", "=", "1")],
        line=[("contains", "the")],
        keep=["doc_id", "line_no"],
        limit=None,
        **ALL_TIME,
    )
    return scan.select("doc_id", "line_no", "line")
