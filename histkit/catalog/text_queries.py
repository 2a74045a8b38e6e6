"""Script cleaning over whole documents wrapped into script text."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog.registry import query, table
from histkit.operators import textrules as tr

# The rules, marks and status texts of this module's SQL, as the operators have them.
# Script text around a document: (literal or column) pieces. ' is doubled in SQL only.
HEAD = "/* generated\n from "
BODY = """ */
SEL a FROM t WHERE a .LT. 5 AND b .GT. 2 AND c .EQ. 1;
SET intcntr = intcntr ;
SET strSTEP = 'Step' || 4;
INSERT INTO DP_MEDW.log VALUES (1, 'x');
UPDATE DP_MEDW.log SET a = 1 WHERE spName = 'p';
CALL EDW_Env\\.sp_InsertQuery('q');
CALL EDW_Env\\.sysexecsql(:strSQLCmd);



"""
JOB = "WHERE Env_JobName = ' "
AFTER_JOB = "';\n"
CMD = "SET strSQLCmd = 'INSERT INTO ' || strTGTDB || '.t SEL CAST(a AS VARCHAR(10)), CAST(b AS DECIMAL(9,2)), ''"
CMD_END = "'' FROM ' || STRSRCDB || '.s';\n"
LOG = "SET strSQLCmd = 'x ' || strStatusLog;\nSET strSQLCmd = ' UPDATE DP_MEDW.log2 SET a = 1';\n"
CALL = "  CALL EDW_Env.sysexecsql(:strSQLCmd);\n"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SCRIPTS_SQL = f"""
    scripts as (select doc_id, {_q(HEAD)} || source || {_q(BODY)}
        || case when source <> 'src0' then {_q(JOB)} || lang || {_q(AFTER_JOB)} else '' end
        || case when source <> 'src2' then {_q(CMD)} || text || {_q(CMD_END)} else '' end || {_q(LOG)}
        || case when source <> 'src1' then {_q(CALL)} else '' end as text from documents)"""


def scripts(spark, sf):
    src = F.col("source")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(
            F.lit(HEAD),
            src,
            F.lit(BODY),
            F.when(src != "src0", F.concat(F.lit(JOB), F.col("lang"), F.lit(AFTER_JOB))).otherwise(""),
            F.when(src != "src2", F.concat(F.lit(CMD), F.col("text"), F.lit(CMD_END))).otherwise(""),
            F.lit(LOG),
            F.when(src != "src1", F.lit(CALL)).otherwise(""),
        ).alias("text"),
    )


ENV_SQL = """
    env as (select distinct 'PROD' as env_name, upper(lang) as job, 'src_' || lang as src, 'tgt_' || lang as tgt
            from documents where lang <> 'es')"""


def environments(spark, sf):
    lang = F.col("lang")
    live = table(spark, sf, "documents").select(lang).distinct()
    named = {"Env_Src": "src_", "Env_Tgt": "tgt_", "Env_LoadDB": "load_", "Env_MacDB": "mac_"}
    named |= {"Env_WrkDB": "wrk_", "Env_UtlDB": "utl_", "Env_VDB": "v_"}
    values = [F.concat(F.lit(p), lang).alias(c) for c, p in named.items()]
    prod = live.select(
        F.lit("PROD ").alias("Env_Name"), F.upper(lang).alias("Env_JobName"), F.when(lang != "es", "T").otherwise("F").alias("Env_Flag"), *values
    )
    return prod.unionByName(prod.withColumns({"Env_Name": F.lit("test"), "Env_Src": F.lit("other")}))


STRIP = r"regexp_replace({}, '\A\s+|\s+\z', '', 'g')"


def _norm(x: str) -> str:
    x = rf"regexp_replace({x}, '/\*.*?\*/', '', 'gs')"
    # SEL as a word; the border is spelled out so that accented letters count as letters.
    word = r"(^|[^\pL\pM\pN_\x{200c}\x{200d}])SEL($|[^\pL\pM\pN_\x{200c}\x{200d}])"
    for _ in range(2):
        x = rf"regexp_replace({x}, '{word}', '\1SELECT\2', 'gi')"
    return f"replace(replace(replace({x}, '.LT.', '<'), '.GT.', '>'), '.EQ.', '=')"


def _noise(x: str) -> str:
    for pattern, flags in (
        (r"(?m)^\s*SET\s+intcntr\s*=\s*intcntr\s*;", "gi"),
        (r"(?m)^\s*SET\s+strSTEP\s*=\s*''Step''\s*\|\|.*$", "gi"),
        (r"(?m)^\s*SET\s+ReturnCode\s*=\s*SQLSTATE\s*;", "gi"),
        (r"INSERT\s+INTO\s+DP_MEDW\..*?\);", "gis"),
        (r"UPDATE\s+DP_MEDW\..*?WHERE\s+spName\s*=\s*.*?;", "gis"),
        (r"(?m)^\s*CALL\s+EDW_Env\\.sp_InsertQuery\(.*\);", "gi"),
        (r"(?m)^\s*CALL\s+EDW_Env\\.sysexecsql\(:strSQLCmd\);", "gi"),
        (r"\n{3,}", "g"),
    ):
        x = STRIP.format(f"regexp_replace({x}, '{pattern}', '', '{flags}')")
    return x


NORMAL_SQL = f"with {SCRIPTS_SQL}, normal as (select doc_id, {_norm('text')} as text from scripts)"
JOB_SQL = STRIP.format(r"regexp_extract(text, 'Env_JobName\s*=\s*''([^'']+)''', 1, 'i')")
PREP_SQL = rf"""{NORMAL_SQL}, {ENV_SQL},
    prep as (select doc_id, nullif({JOB_SQL}, '') as job_name,
                    regexp_matches(text, '(?m)^[ \t]*CALL[ \t]+EDW_Env\.sysexecsql\(:strSQLCmd\);', 'i') as has_call,
                    {_noise('text')} as text from normal),
    raw as (select doc_id, job_name, has_call, env.job is not null as mapped, src, tgt, env_name, job,
                   regexp_extract_all(text, 'SET\s+strSQLCmd\s*=\s*(.*?);', 1, 'is') as found
            from prep left join env on env.job = upper(job_name)),
    one as (select *, unnest(found) as expr, generate_subscripts(found, 1)::integer as statement_no from raw),
    part as (select * exclude (found),
               list_transform(list_transform(string_split(expr, '||'), lambda p: {STRIP.format("p")}),
                 lambda p: case when (starts_with(p, '''') and ends_with(p, '''')) or (starts_with(p, '"') and ends_with(p, '"'))
                             then substr(p, 2, greatest(length(p) - 2, 0)) else p end) as parts,
               contains(lower(expr), 'strstatuslog') or contains(lower(expr), 'strcheckpointlog')
               or contains(lower(expr), 'sqlcmd =') or contains(lower(expr), 'sp_insertquery') as is_log from one),
    filled as (select *, replace(array_to_string(list_transform(parts, lambda p: case lower(p)
                 when 'strsrcdb' then src when 'strtgtdb' then tgt when 'strenv' then env_name when 'strenvjobname' then job
                 else p end), ''), '''''', '''') as done from part),
    good as (select * from filled where not is_log and not regexp_matches(done, '\A\s*(INSERT\s+INTO|UPDATE)\s+DP_MEDW\.', 'i'))"""


def _casts(x: str) -> str:
    for pattern, to in (
        (r"CAST\((.*?) AS\s+DECIMAL\(\d+,\d+\)\)", r"CAST(\1 AS DECIMAL(18,0))"),
        (r"CAST\((.*?) AS\s+VARCHAR\(\d+\)\)", r"CAST(\1 AS STRING)"),
        (r"CAST\((.*?) AS\s+INTEGER\)", r"CAST(\1 AS INT)"),
        (r"CAST\((.*?) AS\s+SMALLINT\)", r"CAST(\1 AS SMALLINT)"),
        (r"CAST\((.*?) AS\s+CHAR\(\d+\)\)", r"CAST(\1 AS STRING)"),
        (r"\bCURRENT_TIMESTAMP\(0\)\b", "CURRENT_TIMESTAMP"),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'gi')"
    return x


@query("text_rewrite", f"{NORMAL_SQL} select doc_id, text from normal")
def text_rewrite(spark, sf):
    return tr.rewrite_text(scripts(spark, sf))


@query(
    "statement_extract",
    rf"""with {SCRIPTS_SQL}, f as (select doc_id, regexp_extract_all(text, 'SET\s+strSQLCmd\s*=\s*(.*?);', 1, 'is') as found from scripts)
        select doc_id, generate_subscripts(found, 1)::integer as statement_no, unnest(found) as statement from f""",
)
def statement_extract(spark, sf):
    return tr.extract_statements(scripts(spark, sf)).drop("text")


@query("var_substitute", f"{PREP_SQL} select doc_id, job_name, statement_no, done as statement, mapped as has_environment from filled where mapped")
def var_substitute(spark, sf):
    rows = scripts(spark, sf).withColumn("text", tr.apply_rules("text", tr.NORMALIZE_RULES))
    rows = rows.withColumn("job_name", tr.job_name()).withColumn("text", tr.apply_rules("text", tr.NOISE_RULES))
    rows = tr.extract_statements(rows).drop("text")
    return tr.substitute_vars(rows, environments(spark, sf)).where("has_environment")


@query(
    "text_statements",
    f"""{PREP_SQL}, f as (select doc_id, job_name, statement_no, {_casts("done")} as s from good where mapped and has_call)
        select doc_id, job_name, statement_no, case when ends_with(s, ';') then s else s || ';' end as statement from f""",
)
def text_statements(spark, sf):
    return tr.script_statements(scripts(spark, sf), environments(spark, sf))


STATUS_SQL = f"""{PREP_SQL}, n as (select doc_id, count(*)::integer as n from good group by 1),
    st as (select raw.doc_id, job_name, case
             when job_name is null then 'Skipped (No Env_JobName in WHERE clause)'
             when not has_call then 'Skipped (No sysexecsql)'
             when not mapped then 'Skipped (No env mapping for JobName: ' || job_name || ')'
             when coalesce(n, 0) = 0 then 'Skipped (No valid SQL)' else 'Success' end as status, coalesce(n, 0) as n
           from raw left join n on n.doc_id = raw.doc_id)"""


@query("text_status", f"{STATUS_SQL} select doc_id, job_name, status, case when status = 'Success' then n else 0 end as statement_count from st")
def text_status(spark, sf):
    return tr.route_status(scripts(spark, sf), environments(spark, sf))


@query(
    "text_status_summary",
    f"""{STATUS_SQL} select status, count(*) as script_count,
        sum(case when status = 'Success' then n else 0 end)::bigint as statement_count from st group by status""",
)
def text_status_summary(spark, sf):
    return tr.status_summary(tr.route_status(scripts(spark, sf), environments(spark, sf)))
