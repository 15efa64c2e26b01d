"""Ordered text rules: the first rule whose keyword occurs wins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, functions as F

# The programming-language rules of the posts reports, in the
# order they are tried (keyword matched as a substring of the lower-cased
# tag, then the label given).  Tags matching none are labelled NA.
LANGUAGE_RULES: tuple[tuple[str, str], ...] = (
    ("python", "Python"),
    ("node.js", "Node.js"),
    ("java", "Java"),
    ("ruby", "Ruby"),
    ("c#", "C#"),
    ("c++", "C++"),
    ("sql", "SQL"),
    ("css", "CSS"),
    ("html", "HTML"),
    ("react", "React"),
)
NO_LANGUAGE = "NA"


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify_sql(col_sql: str, rules: Sequence[tuple[str, str]] = LANGUAGE_RULES,
                 default: str = NO_LANGUAGE) -> str:
    """The ordered rules as a SQL ``CASE`` over the expression ``col_sql``."""
    whens = " ".join(f"WHEN contains(lower({col_sql}), {_sql_text(kw.lower())}) "
                     f"THEN {_sql_text(label)}" for kw, label in rules)
    return f"CASE {whens} ELSE {_sql_text(default)} END"


def classify(c: "Column | str", rules: Sequence[tuple[str, str]] = LANGUAGE_RULES,
             default: str | None = NO_LANGUAGE) -> Column:
    """Label ``c`` by the first rule whose keyword is a substring of lower(c).

    Keywords are literal text (no wildcards), so ``c++`` or ``node.js`` need
    no escaping; a NULL input gets the default.  For a column name the CASE
    is built as one SQL expression (one call instead of one per branch).
    """
    if isinstance(c, str) and rules and default is not None:
        return F.expr(classify_sql("`" + c.replace("`", "``") + "`", rules, default))
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    expr = None
    for keyword, label in rules:
        cond = text.contains(keyword.lower())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
