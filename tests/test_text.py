"""Script cleaning against the same rules run with Python's re on a small fixture."""

import re

import pytest

from histkit.operators import textrules as tr

SCRIPTS = {
    1: "/* a\nb */ SEL x, éSEL, sel y\nEnv_JobName = ' Job1 ';\nSET strSQLCmd = 'A ' || strSRCDB || '.t WHERE a .LT. ''q''';\nCALL EDW_Env.sysexecsql(:strSQLCmd);",
    2: "SET strSQLCmd = 'x';\nCALL EDW_Env.sysexecsql(:strSQLCmd);",
    3: "Env_JobName='job1'; SET strSQLCmd = 'x';",
    4: "Env_JobName='nobody';\n\tcall EDW_Env.sysexecsql(:strSQLCmd);",
    5: "Env_JobName='job1';\nSET strSQLCmd = ' insert into DP_MEDW.log';\nset strsqlcmd = 'a' || strStatusLog;\nCALL EDW_Env.sysexecsql(:strSQLCmd);",
    6: "Env_JobName='job1';\n\n\n\nSET strSQLCmd = \"SEL CAST(a AS VARCHAR(10)), cast(b as decimal(9,2)), CURRENT_TIMESTAMP(0)x\" || '\n' || strtgtdb || 'T' || '';\n"
    "SET strSTEP = 'Step' || 1\r;x\nSET strSQLCmd = UPDATE_it; CALL EDW_Env.sysexecsql(:strSQLCmd);\nCALL EDW_Env.sysexecsql(:strSQLCmd);",
}
ENV = {"Env_Name": "PROD", "Env_JobName": "JOB1", "Env_Flag": "T", "Env_Src": "strVDB", "Env_Tgt": " tgt ", "Env_LoadDB": "l", "Env_MacDB": "m", "Env_WrkDB": "w", "Env_UtlDB": "u", "Env_VDB": "v"}


def expected(text):
    """(status, statements) by the rules, with Python's own regular expressions."""
    flags = re.IGNORECASE
    text = re.sub(r"/\*.*?\*/", "", text, flags=re.DOTALL)
    text = re.sub(r"\bSEL\b", "SELECT", text, flags=flags)
    for a, b in ((".LT.", "<"), (".GT.", ">"), (".EQ.", "=")):
        text = text.replace(a, b)
    job = re.search(r"Env_JobName\s*=\s*'([^']+)'", text, flags)
    job = job.group(1).strip() if job else ""
    if not job:
        return tr.NO_JOB, []
    if not re.search(r"^[ \t]*CALL[ \t]+EDW_Env\.sysexecsql\(:strSQLCmd\);", text, flags | re.M):
        return tr.NO_CALL, []
    if job.lower() != "job1":
        return f"{tr.NO_MAPPING}{job})", []
    for rule in tr.NOISE_RULES:
        text = re.sub(re.sub(r"[dU](?=[^(]*\))", "", rule.pattern, count=2) if "(?" in rule.pattern[:2] else rule.pattern, "", text).strip()
    values = {k.lower(): ENV[c].strip() for k, c in tr.VARIABLES.items()}
    out = []
    for raw in re.findall(r"SET\s+strSQLCmd\s*=\s*((?:.|\n)*?);", text, flags):
        if any(m.lower() in raw.lower() for m in tr.LOG_MARKS):
            continue
        done = ""
        for part in raw.split("||"):
            part = part.strip()
            if len(part) > 0 and part[0] == part[-1] and part[0] in "'\"":
                part = part[1:-1]
            for name, value in values.items():
                if part.lower() == name:
                    part = value
            done += part
        done = done.replace("''", "'")
        for rule in tr.CAST_RULES + tr.CLOCK_RULES:
            done = re.sub(rule.pattern.replace("dU", "").replace("U", "", 1), rule.replacement.replace("$1", r"\1"), done)
        if not re.match(r"\s*(INSERT\s+INTO|UPDATE)\s+DP_MEDW\.", done, flags):
            out.append(done if done.endswith(";") else done + ";")
    return (tr.SUCCESS, out) if out else (tr.NO_SQL, [])


@pytest.fixture(scope="module")
def sides(spark):
    scripts = spark.createDataFrame(list(SCRIPTS.items()), "doc_id int, text string")
    other = {**ENV, "Env_Flag": "F", "Env_Src": "bad"}
    env = spark.createDataFrame([ENV, other, {**ENV, "Env_Name": "test", "Env_Src": "bad"}], ", ".join(f"{c} string" for c in ENV))
    return scripts, env


def test_status_of_every_script(sides):
    rows = {r.doc_id: (r.status, r.statement_count) for r in tr.route_status(*sides).collect()}
    assert rows == {i: (s, len(x)) for i, t in SCRIPTS.items() for s, x in [expected(t)]}
    assert {s for s, _ in rows.values()} >= {tr.NO_JOB, tr.NO_CALL, tr.NO_SQL, tr.SUCCESS}


def test_statements(sides):
    rows = tr.script_statements(*sides).orderBy("doc_id", "statement_no").collect()
    want = [(i, s) for i, t in SCRIPTS.items() for s in expected(t)[1]]
    assert [(r.doc_id, r.statement) for r in rows] == want
    # A value that names a later variable takes that one's value.
    assert any(s.startswith("A v.t") for _, s in want)


def test_one_pass_without_python(sides):
    plan = tr.script_statements(*sides)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_calls_with_a_backslash_are_cleaned_away(spark):
    text = "a\nCALL EDW_Env\\.sp_InsertQuery('x', 1);\nb\n call edw_env\\!sysexecsql(:strSQLCmd);\nCALL EDW_Env.sp_InsertQuery(1);"
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(tr.apply_rules("text", tr.NOISE_RULES)).first()[0] == "a\n\nb\n\nCALL EDW_Env.sp_InsertQuery(1);"


def test_rules_run_once_per_text(spark):
    scripts = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    names = ["Env_Name", "Env_JobName", "Env_Flag", "Env_Src", "Env_Tgt", "Env_LoadDB", "Env_MacDB", "Env_WrkDB", "Env_UtlDB", "Env_VDB"]
    env = spark.createDataFrame([tuple("x" for _ in names)], ", ".join(f"{n} string" for n in names))
    plan = tr.script_statements(scripts, env)._jdf.queryExecution().optimizedPlan().toString()
    rules = [r for r in tr.NORMALIZE_RULES + tr.NOISE_RULES + tr.CAST_RULES + tr.CLOCK_RULES if not r.literal]
    assert plan.count("regexp_replace(") <= len(rules)
