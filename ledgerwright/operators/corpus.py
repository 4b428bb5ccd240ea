"""Scan of a corpus of SQL text for constructs that do not carry over.

The rules are expressions over a line, evaluated where the text is read: one
row per file in, one row per finding out, no shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.functions.exprs import quoted
from ledgerwright.functions.stored import materialize
from ledgerwright.functions.text import (
    blank_comments,
    ends_in_comment,
    has_noqa,
    has_text,
    lines,
    noqa_codes,
    one_unit,
    stripped,
)

SNIPPET_LENGTH = 120
BOM = "^\ufeff"
#: Letters outside of ASCII that a pattern takes for I, I, S and K when it ignores case.
FOLDED = "\u0130\u0131\u017f\u212a"


class Rule(NamedTuple):
    code: str
    severity: str
    pattern: str
    message: str
    remedy: str
    words: tuple[str, ...] = ()  # upper case; a match contains one of them


#: Severities, most severe first, and the rules. Patterns ignore case. SS004 leaves out that a quote may
#: be doubled inside the literal: its first position is the same, and a long literal does not exhaust the regex stack.
SEVERITIES = ("error", "warning", "info")
RULES = (
    Rule("SS001", "error", r"\bGETDATE\s*\(\s*\)",
         "GETDATE() is not available.", "Call CURRENT_TIMESTAMP().", ("GETDATE",)),
    Rule("SS002", "error", r"\bGETUTCDATE\s*\(\s*\)",
         "GETUTCDATE() is not available.", "Call SYSDATE(), which is in UTC.", ("GETUTCDATE",)),
    Rule("SS003", "error", r"\bISNULL\s*\(",
         "ISNULL() is not available.", "Call COALESCE() or IFNULL().", ("ISNULL",)),
    Rule("SS004", "error", r"(?:^|(?<=[\s(,=+|]))N'[^']*'",
         "N'...' literals are not valid.", "Remove the N; strings are Unicode.", ("N'",)),
    Rule("SS005", "error", r"\[[A-Za-z_][\w ]*\]",
         "Identifier in brackets.", "Quote it with double quotes, or not at all.", ("[",)),
    Rule("SS006", "error", r"@@ROWCOUNT",
         "@@ROWCOUNT is not available.", "Read SQLROWCOUNT in a scripting block.", ("@@ROWCOUNT",)),
    Rule("SS007", "error", r"@@IDENTITY|\bSCOPE_IDENTITY\s*\(\s*\)",
         "The last identity value is not available.", "Use a sequence, or look the row up by a value of this run.",
         ("IDENTITY",)),
    Rule("SS008", "error", r"\bSELECT\s+TOP\s+\(?\s*\d+",
         "SELECT TOP is not valid.", "Use LIMIT.", ("TOP",)),
    Rule("SS009", "error", r"\bIDENTITY\s*\(\s*\d+\s*,\s*\d+\s*\)",
         "IDENTITY(seed, step) is not valid.", "Declare the column AUTOINCREMENT.", ("IDENTITY",)),
    Rule("SS010", "error", r"\bNVARCHAR\s*\(|\bNCHAR\s*\(|\bNTEXT\b",
         "National character types do not exist.", "Declare VARCHAR.", ("NVARCHAR", "NCHAR", "NTEXT")),
    Rule("SS011", "error", r"\bDATETIME2?\b(?!_)",
         "DATETIME and DATETIME2 do not exist.", "Declare TIMESTAMP_NTZ, or TIMESTAMP_TZ with an offset.",
         ("DATETIME",)),
    Rule("SS012", "error", r"\bUNIQUEIDENTIFIER\b",
         "UNIQUEIDENTIFIER does not exist.", "Declare VARCHAR(36) and default it to UUID_STRING().",
         ("UNIQUEIDENTIFIER",)),
    Rule("SS013", "error", r"\bMONEY\b|\bSMALLMONEY\b",
         "MONEY types do not exist.", "Declare NUMBER(19,4).", ("MONEY",)),
    Rule("SS014", "error", r"\bCREATE\s+(?:NON)?CLUSTERED\s+INDEX\b|\bCREATE\s+INDEX\b",
         "Indexes cannot be created.", "Remove it; CLUSTER BY helps pruning.", ("INDEX",)),
    Rule("SS015", "error", r"\bWITH\s*\(\s*NOLOCK\s*\)|\bNOLOCK\b",
         "NOLOCK is a locking hint.", "Remove it; readers do not block.", ("NOLOCK",)),
    Rule("SS016", "error", r"\bsp_executesql\b|\bEXEC\s*\(",
         "Dynamic SQL of another dialect.", "Use EXECUTE IMMEDIATE.", ("EXEC",)),
    Rule("SS017", "error", r"\b(?:BEGIN|COMMIT|ROLLBACK)\s+TRAN\b",
         "TRAN is an abbreviation of another dialect.", "Write TRANSACTION, or plain COMMIT and ROLLBACK.", ("TRAN",)),
    Rule("SS018", "error", r"\bPRINT\s+",
         "PRINT is not available.", "Return the value.", ("PRINT",)),
    Rule("SS019", "error", r"\bDATEADD\s*\(\s*(?:yy|yyyy|mm|m|dd|d|hh|mi|n|ss|s|ms)\b",
         "Abbreviated date part in DATEADD.", "Write the part in full.", ("DATEADD",)),
    Rule("SS020", "error", r"\bCREATE\s+TYPE\b.*\bAS\s+TABLE\b",
         "Table types do not exist.", "Pass a staging table or an array.", ("TYPE",)),
    Rule("SS101", "warning", r"\+\s*(?:N?'|\w+\s*\+)",
         "Strings joined with + may be added as numbers.", "Join them with || or CONCAT().", ("+",)),
    Rule("SS102", "info", r"\bTINYINT\b|\bSMALLINT\b|\bBIGINT\b|\bINT\b",
         "All integer types are one 38-digit number.", "Declare a precision where the width mattered.", ("INT",)),
    Rule("SS103", "warning", r"\bCHARINDEX\s*\(",
         "CHARINDEX takes its arguments in another order.", "Use POSITION and check the order.", ("CHARINDEX",)),
    Rule("SS104", "warning", r"\bLEN\s*\(",
         "LEN() leaves trailing blanks out, LENGTH() counts them.", "Use LENGTH(), after a TRIM() if it mattered.",
         ("LEN",)),
    Rule("SS105", "warning", r"\bTRUNCATE\s+TABLE\b",
         "TRUNCATE acts differently inside a transaction.", "Check the transaction around it.", ("TRUNCATE",)),
    Rule("SS106", "warning", r"\bMERGE\b",
         "MERGE treats several matches of a row differently.", "Make the source unique per target row.", ("MERGE",)),
    Rule("SS107", "warning",
         r":=\s*\(\s*SELECT\s+MAX\s*\(\s*[\w.]*ID\s*\)|\bSELECT\s+MAX\s*\(\s*[\w.]*ID\s*\)\s+INTO\b",
         "MAX() of an id is not the row just written.", "Write a value of this run and look it up.", ("MAX",)),
)


def rules_at(min_severity: str = "warning") -> list[Rule]:
    if min_severity not in SEVERITIES:
        raise ValueError(f"severity must be one of {', '.join(SEVERITIES)}")
    return [r for r in RULES if SEVERITIES.index(r.severity) <= SEVERITIES.index(min_severity)]


def _hits(rules: list[Rule]) -> str:
    """The rules a scanned line meets, each with its first position.

    Word characters are those of Unicode. A line is searched for a rule's word
    before the pattern runs. The texts of a rule are looked up for its hits only.
    """

    def place(rule: Rule) -> str:
        found = f"regexp_instr(scan, {quoted('(?iU)' + rule.pattern)})"
        hints = " OR ".join(f"contains(upscan, {quoted(w)})" for w in rule.words)
        return f"CASE WHEN {hints} THEN {found} ELSE 0 END"

    places = ", ".join(place(r) for r in rules)
    texts = ", ".join(
        f"struct({quoted(r.code)} AS code, {quoted(r.severity)} AS severity,"
        f" {quoted(r.message)} AS message, {quoted(r.remedy)} AS remedy)"
        for r in rules
    )
    return f"""transform(
        filter(transform(array({places}), (p, i) -> struct(p AS column, i AS rule)), h -> h.column > 0),
        h -> struct(h.column AS column, array({texts})[h.rule] AS about))"""


def sql_corpus_findings(corpus: DataFrame, min_severity: str = "warning") -> DataFrame:
    """Findings in a (path, text) corpus: at most one per rule and line.

    Comments are blanked first and literals are scanned. A noqa mark on the raw
    line drops the line, or the codes it names. Lines are numbered after
    blanking, so a line end inside a comment other than a newline does not count.
    """
    text = F.regexp_replace("text", BOM, "")
    return _findings(_lines(corpus.select("path", text.alias("text"), blank_comments(text).alias("code"))), min_severity)


def _lines(texts: DataFrame, *others: str) -> DataFrame:
    """``path, others, line, scan, raw`` of the lines of (path, others, text, code) that hold something but comments."""
    return (
        texts.select("path", *others, lines(one_unit(F.col("code"))).alias("scan"), lines(F.col("text")).alias("raw"))
        # Zipped first, so that a line does not carry its whole file along. An inner explode would have Spark cut the
        # text into lines once more, to leave empty arrays out.
        .selectExpr("path", *others, "posexplode_outer(arrays_zip(scan, raw)) AS (pos, both)")
        .selectExpr("path", *others, "pos + 1 AS line", "both.scan", "both.raw")
        .where(has_text(F.col("scan")))
    )


def _findings(scanned: DataFrame, min_severity: str) -> DataFrame:
    """Findings in lines (path, line, scan, raw)."""
    raw = F.col("raw")
    return (
        scanned.withColumn("muted", F.when(has_noqa(raw), noqa_codes(raw)))
        .where("muted IS NULL OR size(muted) > 0")
        .selectExpr("*", f"upper(translate(scan, {quoted(FOLDED)}, 'IISK')) AS upscan")
        .selectExpr("path", "line", "raw", "muted", f"explode_outer({_hits(rules_at(min_severity))}) AS hit")
        .where("hit IS NOT NULL AND NOT coalesce(array_contains(muted, hit.about.code), false)")
        .withColumn("snippet", F.substring(stripped(raw), 1, SNIPPET_LENGTH))
        .select("path", "line", "hit.column", "hit.about.*", "snippet")
    )


def _earlier(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """What all rows of the group before a row do, as one function of the state, in ``was0`` and ``was1``.

    A row maps an open comment (1) or none (0) to the state after it, in ``to0`` and
    ``to1``. It either sets the state, keeps it, or turns it around. So the state before
    a row is what the last setting row made of it, turned by the rows since.
    """
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.expr("CAST(to0 > to1 AS INT)")).over(before), F.lit(0))
    rows = rows.withColumn("_turned", turned)
    # The number of turns is kept with each setting row: it has none of its own.
    setting = F.when(F.col("to0") == F.col("to1"), F.struct(F.col("to0").alias("made"), F.col("_turned").alias("at")))
    rows = rows.withColumn("_set", F.last(setting, ignorenulls=True).over(before))
    return rows.selectExpr(
        *[c for c in rows.columns if c not in ("_turned", "_set")],
        *[f"(coalesce(_set.made, {k}) + _turned - coalesce(_set.at, 0)) % 2 AS was{k}" for k in (0, 1)],
    )


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """``path, block, chunk, open, before, raw_before`` of every chunk.

    That is whether a comment is open where it begins, and the lines before it: as they are
    numbered, and as they are in the text, where a line end inside a comment counts too.

    Each chunk is a function of the state at its beginning: of whether a comment is open,
    and of how many lines it has. Functions are put together within a block, blocks within
    a file, and nothing but one small row a chunk is ordered for it.
    """
    text, code = F.col("text"), blank_comments(F.col("text"))
    rest = F.substring("text", F.expr("instr(text, '*/') + 2"), F.length("text"))
    ends = F.size(lines(code)) - 1
    inside = F.size(lines(_blank_open(text))) - 1
    rows = chunks.select(
        "path", "block", "chunk",
        ends_in_comment(text).cast("int").alias("to0"),
        F.when(text.contains("*/"), ends_in_comment(rest).cast("int")).otherwise(1).alias("to1"),
        ends.alias("lines0"), inside.alias("lines1"), (F.size(lines(text)) - 1).alias("raw"),
    )
    rows = materialize(rows, "chunk-states")
    rows = _earlier(rows, ["path", "block"], ["chunk"])
    lines_of = "IF(was{k} = 1, lines1, lines0)".format
    of_block = rows.groupBy("path", "block").agg(
        *[F.expr(f"max_by(IF(was{k} = 1, to1, to0), chunk)").alias(f"to{k}") for k in (0, 1)],
        *[F.expr(f"sum({lines_of(k=k)})").alias(f"lines{k}") for k in (0, 1)],
        F.sum("raw").alias("raw"),
    )
    blocks = _earlier(of_block, ["path"], ["block"])
    blocks = _sums_before(blocks.selectExpr("path", "block", "was0 AS open", "IF(was0 = 1, lines1, lines0) AS n", "raw"), ["path"], "block")
    blocks = blocks.selectExpr("path", "block", "open", "n_before AS n_block", "raw_before AS raw_block")
    rows = rows.join(blocks, ["path", "block"]).selectExpr(
        "path", "block", "chunk", "n_block", "raw_block", "raw", "IF(open = 1, was1, was0) AS open",
        f"IF(open = 1, {lines_of(k=1)}, {lines_of(k=0)}) AS n",
    )
    return _sums_before(rows, ["path", "block"], "chunk").selectExpr(
        "path", "block", "chunk", "open", "n_block + n_before AS before", "raw_block + raw_before AS raw_before"
    )


def _sums_before(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """``rows`` with the sums of ``n`` and ``raw`` over the earlier rows of the group."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "raw")])


def _blank_open(text):
    """The text with its comments blanked, where one is open at its beginning."""
    end = F.expr("instr(text, '*/') + 1")
    head, rest = F.substring(text, F.lit(1), end), F.substring(text, end + 1, F.length(text))
    spaces = F.regexp_replace(head, r"[^\n]", " ")
    return F.when(text.contains("*/"), F.concat(spaces, blank_comments(rest))).otherwise(F.regexp_replace(text, r"[^\n]", " "))


def sql_chunk_findings(chunks: DataFrame, min_severity: str = "warning") -> DataFrame:
    """Findings in files given in pieces (path, block, chunk, text), as of the files as a whole.

    Chunks end with a line feed, but for a file's last one, and are in order of (block,
    chunk); a block is what one task can order. No task needs a whole file: a comment that
    is open over many chunks reaches them as one bit (see ``chunk_starts``).
    """
    chunks = materialize(chunks.withColumn("text", F.coalesce("text", F.lit(""))), "chunks")
    texts = chunks.join(chunk_starts(chunks), ["path", "block", "chunk"]).withColumn(
        "text", F.when(F.col("before") == 0, F.regexp_replace("text", BOM, "")).otherwise(F.col("text"))
    )
    text = F.col("text")
    code = F.when(F.col("open") == 1, _blank_open(text)).otherwise(blank_comments(text))
    texts = texts.select("path", "before", "raw_before", "text", code.alias("code"))
    scanned = _lines(texts, "before", "raw_before").withColumn("line", F.expr("CAST(before + line AS INT)"))
    # A line is shown as the text's line of its number. After line ends inside of comments that is an earlier one,
    # which may be in another chunk.
    late = F.col("raw_before") > F.col("before")
    shown = texts.join(texts.where(late).select("path").distinct(), "path", "left_semi").select(
        "path", "raw_before", F.posexplode(lines(F.col("text"))).alias("pos", "raw")
    )
    shown = shown.selectExpr("path", "CAST(raw_before + pos + 1 AS INT) AS line", "raw")
    moved = scanned.where(late).select("path", "line", "scan").join(_numbered_once(shown), ["path", "line"])
    same = scanned.where(~late).select("path", "line", "scan", "raw")
    return _findings(same.unionByName(moved), min_severity)


def _numbered_once(shown: DataFrame) -> DataFrame:
    """A chunk's last line is empty and has the number of the next chunk's first: that one counts."""
    return shown.groupBy("path", "line").agg(F.max("raw").alias("raw"))


def sorted_findings(findings: DataFrame) -> DataFrame:
    """Findings most severe first, then by path and position."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    return findings.orderBy(rank, "path", "line", "column", "code")


def sql_corpus_tally(findings: DataFrame) -> DataFrame:
    """Findings per severity, distinct files, and the summary text: one row."""
    per_file = findings.groupBy("path").agg(
        *[F.expr(f"count_if(severity = '{s}')").alias(s) for s in SEVERITIES]
    )
    sums = per_file.selectExpr(*[f"coalesce(sum({s}), 0L) AS {s}" for s in SEVERITIES], "count(path) AS files")
    parts = ", ".join(f"CASE WHEN {s} > 0 THEN concat({s}, ' {s}') END" for s in SEVERITIES)
    return sums.selectExpr(
        "*",
        f"""CASE WHEN files = 0 THEN 'No dialect issues found.'
            ELSE concat(concat_ws(', ', {parts}), ' across ', files, ' file(s).') END AS summary""",
    )
