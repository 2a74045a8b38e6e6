"""Cleaning scripts held in a text column: rewrite rules, statement extraction, variables, routing.

A table has one row per script. Everything is a column expression over whole texts, so a
job is one pass over the table, without a shuffle until statuses are counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.functions.times import col_of
from histkit.operators.events import Order, top_rank


@dataclass(frozen=True)
class Rule:
    """Replace a regular expression (or, with ``literal``, a plain text)."""

    pattern: str
    replacement: str = ""
    literal: bool = False
    trim: bool = False


# The rewrite rules of each step, in the order they apply.
# Flags: U - Unicode white space and word borders, d - only \\n ends a line.
COMMENT_RULES = (Rule(r"(?s)/\*.*?\*/"),)
KEYWORD_RULES = (Rule(r"(?iU)\bSEL\b", "SELECT"),)
OPERATOR_RULES = (Rule(".LT.", "<", True), Rule(".GT.", ">", True), Rule(".EQ.", "=", True))
CAST_RULES = (
    Rule(r"(?idU)CAST\((.*?) AS\s+DECIMAL\(\d+,\d+\)\)", "CAST($1 AS DECIMAL(18,0))"),
    Rule(r"(?idU)CAST\((.*?) AS\s+VARCHAR\(\d+\)\)", "CAST($1 AS STRING)"),
    Rule(r"(?idU)CAST\((.*?) AS\s+INTEGER\)", "CAST($1 AS INT)"),
    Rule(r"(?idU)CAST\((.*?) AS\s+SMALLINT\)", "CAST($1 AS SMALLINT)"),
    Rule(r"(?idU)CAST\((.*?) AS\s+CHAR\(\d+\)\)", "CAST($1 AS STRING)"),
)
CLOCK_RULES = (Rule(r"(?iU)\bCURRENT_TIMESTAMP\(0\)\b", "CURRENT_TIMESTAMP"),)
NOISE_RULES = (
    Rule(r"(?imdU)^\s*SET\s+intcntr\s*=\s*intcntr\s*;", trim=True),
    Rule(r"(?imdU)^\s*SET\s+strSTEP\s*=\s*'Step'\s*\|\|.*$", trim=True),
    Rule(r"(?imdU)^\s*SET\s+ReturnCode\s*=\s*SQLSTATE\s*;", trim=True),
    Rule(r"(?isU)INSERT\s+INTO\s+DP_MEDW\..*?\);", trim=True),
    Rule(r"(?isU)UPDATE\s+DP_MEDW\..*?WHERE\s+spName\s*=\s*.*?;", trim=True),
    # The next two ask for a backslash and any one character after Env.
    Rule(r"(?imdU)^\s*CALL\s+EDW_Env\\.sp_InsertQuery\(.*\);", trim=True),
    Rule(r"(?imdU)^\s*CALL\s+EDW_Env\\.sysexecsql\(:strSQLCmd\);", trim=True),
    Rule(r"\n{3,}", trim=True),
)
NORMALIZE_RULES = COMMENT_RULES + KEYWORD_RULES + OPERATOR_RULES

JOB_NAME = r"(?iU)Env_JobName\s*=\s*'([^']+)'"
DYNAMIC_CALL = r"(?imd)^[ \t]*CALL[ \t]+EDW_Env\.sysexecsql\(:strSQLCmd\);"
STATEMENT = r"(?isU)SET\s+strSQLCmd\s*=\s*(.*?);"
LOG_MARKS = ("strStatusLog", "strCheckPointLog", "sqlCmd =", "sp_InsertQuery")
LOG_TARGET = r"(?iU)\A\s*(INSERT\s+INTO|UPDATE)\s+DP_MEDW\."
# Variable of a script -> column of the environment table that holds its value.
VARIABLES = {
    "strEnv": "Env_Name",
    "strEnvJOBNAME": "Env_JobName",
    "strSRCDB": "Env_Src",
    "strTGTDB": "Env_Tgt",
    "strLOADDB": "Env_LoadDB",
    "strMACDB": "Env_MacDB",
    "strWRKDB": "Env_WrkDB",
    "strUTLDB": "Env_UtlDB",
    "strVDB": "Env_VDB",
}

SUCCESS = "Success"
NO_JOB = "Skipped (No Env_JobName in WHERE clause)"
NO_CALL = "Skipped (No sysexecsql)"
NO_MAPPING = "Skipped (No env mapping for JobName: "
NO_SQL = "Skipped (No valid SQL)"


# Fixed value: the characters that count as white space at the ends of a text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space, line breaks included, from both ends."""
    return F.btrim(c, F.lit(SPACES))


def apply_rules(c: str | Column, rules: Sequence[Rule]) -> Column:
    out = col_of(c)
    for r in rules:
        if r.literal:
            out = F.replace(out, F.lit(r.pattern), F.lit(r.replacement))
        else:
            out = F.regexp_replace(out, r.pattern, r.replacement)
        if r.trim:
            out = strip(out)
    return out


def rewrite_text(df: DataFrame, col: str = "text", rules: Sequence[Rule] = NORMALIZE_RULES, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, apply_rules(col, rules))


def job_name(col: str | Column = "text") -> Column:
    """Job a script belongs to; null when it names none."""
    return F.nullif(strip(F.regexp_extract(col_of(col), JOB_NAME, 1)), F.lit(""))


def has_dynamic_call(col: str | Column = "text") -> Column:
    return F.regexp_like(col_of(col), F.lit(DYNAMIC_CALL))


def extract_statements(
    df: DataFrame, col: str = "text", regex: str = STATEMENT, group: int = 1, outer: bool = False
) -> DataFrame:
    """One row per statement: adds ``statement_no`` (from 1) and ``statement``."""
    explode = F.posexplode_outer if outer else F.posexplode
    found = F.regexp_extract_all(F.col(col), F.lit(regex), F.lit(group))
    rows = df.select("*", explode(found).alias("_pos", "statement"))
    return rows.withColumn("statement_no", F.col("_pos") + 1).drop("_pos")


def evaluate_concat(expr: str | Column, variables: Mapping[str, Column]) -> Column:
    """Resolve ``'text' || variable || ...``: unquote the parts, put in values, join, undouble quotes."""

    def unquote(x: Column) -> Column:
        quoted = (x.startswith("'") & x.endswith("'")) | (x.startswith('"') & x.endswith('"'))
        return F.when(quoted, F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0)))).otherwise(x)

    def fill(x: Column) -> Column:
        # Long literals cannot be variables; the size test spares lower-casing them.
        chain = F.when(F.octet_length(x) > 3 * max(map(len, variables)), x)
        for name, value in variables.items():
            chain = chain.when(F.lower(x) == name.lower(), F.coalesce(value, F.lit("")))
        return chain.otherwise(x)

    # One pass over the few parts per step: nesting the steps instead would evaluate the
    # inner ones again for every use.
    parts = F.transform(F.split(col_of(expr), r"\|\|", -1), strip)
    parts = F.transform(parts, unquote)
    if variables:
        parts = F.transform(parts, fill)
    return F.replace(F.array_join(parts, ""), F.lit("''"), F.lit("'"))


def active_environments(env: DataFrame, order: Order = ()) -> DataFrame:
    """The productive, enabled row of each job, text trimmed. Give an order if a job has several."""
    text = {f.name: F.trim(F.col(f.name)) for f in env.schema.fields if f.dataType.simpleString() == "string"}
    live = env.withColumns(text).where((F.lower("Env_Name") == "prod") & (F.col("Env_Flag") == "T"))
    live = live.withColumn("_job", F.lower("Env_JobName"))
    return top_rank(live, ["_job"], list(order) or [(c, "asc") for c in env.columns])


def _environment_values(env: DataFrame) -> DataFrame:
    """Final variable values per job. A value that names a later variable takes that one's value."""
    side = active_environments(env).withColumns(
        {f"_env_{v}": F.coalesce(F.col(c), F.lit("")) for v, c in VARIABLES.items()}
    )
    names = list(VARIABLES)
    for i in reversed(range(len(names) - 1)):
        mine = F.col(f"_env_{names[i]}")
        later = [(F.lower(mine) == n.lower(), F.col(f"_env_{n}")) for n in names[i + 1 :]]
        chain = F.when(*later[0])
        for cond, value in later[1:]:
            chain = chain.when(cond, value)
        side = side.withColumn(f"_env_{names[i]}", chain.otherwise(mine))
    return side.select("_job", F.lit(True).alias("_mapped"), *[f"_env_{n}" for n in names])


_VALUES = {v: f"_env_{v}" for v in VARIABLES}


def substitute_vars(df: DataFrame, env: DataFrame, expr: str = "statement", job: str = "job_name", out: str | None = None) -> DataFrame:
    """Look up each row's environment by job name and resolve the expression with its values.

    The environment table is small and left to Spark's own size check for broadcasting.
    """
    rows = df.withColumn("_job", F.lower(job)).join(_environment_values(env), "_job", "left")
    values = {v: F.col(c) for v, c in _VALUES.items()}
    rows = rows.withColumn(out or expr, evaluate_concat(expr, values))
    keep = [*df.columns, *([out] if out and out not in df.columns else [])]
    return rows.select(*keep, F.col("_mapped").isNotNull().alias("has_environment"))


def is_log_statement(expr: str | Column) -> Column:
    low = F.lower(col_of(expr))
    hit = F.lit(False)
    for mark in LOG_MARKS:
        hit = hit | low.contains(mark.lower())
    return hit


def finish_statement(c: Column) -> Column:
    # The variable of the function holds the rewritten text, so the rules run once per text.
    ended = F.transform(F.array(apply_rules(c, CAST_RULES + CLOCK_RULES)), lambda x: F.when(x.endswith(";"), x).otherwise(F.concat(x, F.lit(";"))))
    return F.element_at(ended, 1)


def _prepared(scripts: DataFrame, col: str) -> DataFrame:
    """Rewritten texts with job_name and has_call; texts without both are not cleaned further.

    The rewritten text is the variable of a function, and its results come out of a generator,
    into which filters on them are not pushed: each rule runs once per text.
    """

    def parts(x: Column) -> Column:
        name, call = job_name(x), has_dynamic_call(x)
        return F.struct(name.alias("job_name"), call.alias("has_call"), F.when(name.isNotNull() & call, apply_rules(x, NOISE_RULES)).alias(col))

    others = [c for c in scripts.columns if c != col]
    made = F.transform(F.array(apply_rules(col, NORMALIZE_RULES)), parts)
    # The outer form: for the plain one Spark adds a filter that repeats the whole expression.
    return scripts.select(*others, F.inline_outer(made))


def script_statements(scripts: DataFrame, env: DataFrame, id_col: str = "doc_id", col: str = "text") -> DataFrame:
    """Cleaned statements of every script that can be converted: id, job, number, statement."""
    rows = _prepared(scripts, col).where(F.col("job_name").isNotNull() & F.col("has_call"))
    rows = extract_statements(rows.select(id_col, "job_name", col), col).drop(col)
    rows = rows.where(~is_log_statement("statement"))
    rows = substitute_vars(rows, env).where("has_environment")
    rows = rows.where(~F.regexp_like("statement", F.lit(LOG_TARGET)))
    return rows.select(id_col, "job_name", "statement_no", finish_statement(F.col("statement")).alias("statement"))


def route_status(scripts: DataFrame, env: DataFrame, id_col: str = "doc_id", col: str = "text") -> DataFrame:
    """Outcome of each script and how many statements it gives.

    Statements are tested inside the row (higher-order functions), so no join back is needed.
    """
    rows = _prepared(scripts, col)
    rows = rows.withColumn("_job", F.lower("job_name")).join(_environment_values(env), "_job", "left")
    values = {v: F.col(c) for v, c in _VALUES.items()}

    def usable(x: Column) -> Column:
        return ~is_log_statement(x) & ~F.regexp_like(evaluate_concat(x, values), F.lit(LOG_TARGET))

    found = F.regexp_extract_all(F.col(col), F.lit(STATEMENT), F.lit(1))
    # Undecided scripts only; a column of its own, so that the count is not computed again for the status.
    undecided = F.col("job_name").isNotNull() & F.col("has_call") & F.col("_mapped").isNotNull()
    rows = rows.withColumn("_n", F.when(undecided, F.size(F.filter(found, usable))).otherwise(0))
    count = F.col("_n")
    status = (
        F.when(F.col("job_name").isNull(), F.lit(NO_JOB))
        .when(~F.col("has_call"), F.lit(NO_CALL))
        .when(F.col("_mapped").isNull(), F.concat(F.lit(NO_MAPPING), F.col("job_name"), F.lit(")")))
        .when(count == 0, F.lit(NO_SQL))
        .otherwise(F.lit(SUCCESS))
    )
    rows = rows.select(id_col, "job_name", status.alias("status"), "_n")
    return rows.select(
        id_col, "job_name", "status", F.when(F.col("status") == SUCCESS, F.col("_n")).otherwise(0).alias("statement_count")
    )


def status_summary(routed: DataFrame) -> DataFrame:
    return routed.groupBy("status").agg(
        F.count(F.lit(1)).alias("script_count"), F.sum("statement_count").alias("statement_count")
    )
