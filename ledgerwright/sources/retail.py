"""Planning tables derived from the retail test tables.

Every function reads the whole of its Parquet inputs and stays lazy, so a query
pays only for the columns it uses. Column lists are SQL expressions, parsed in
one call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright import schemas as S
from ledgerwright.functions.exprs import quoted
from ledgerwright.functions.numbering import number_rows
from ledgerwright.functions.stored import partitions

LOADED_AT = "2024-01-01 00:00:00"
VALID_FROM = "DATE'1992-01-01'"
SUPPLIER_BASE = 1000
NATION_BASE = 100
REGION_BASE = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) AS y", "month(o_orderdate) AS m"
    )


_PERIOD = "CAST(y AS BIGINT) * 100 + m"


def fiscal_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = _order_months(spark, sf_dir).select("y", "m").distinct().selectExpr(
        f"{_PERIOD} AS FiscalPeriodID",
        "y AS FiscalYear",
        "CAST((m + 2) DIV 3 AS INT) AS FiscalQuarter",
        "m AS FiscalMonth",
        "concat(y, '-', lpad(CAST(m AS STRING), 2, '0')) AS PeriodName",
        "make_date(y, m, 1) AS PeriodStartDate",
        "last_day(make_date(y, m, 1)) AS PeriodEndDate",
    )
    return S.complete(periods, S.FISCAL_PERIOD, LOADED_AT)


def gl_accounts(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Accounts from parts. ``dirty`` gives some of them a neighbour's number."""
    number = "p_partkey - CASE WHEN p_partkey % 97 = 1 THEN 1 ELSE 0 END" if dirty else "p_partkey"
    accounts = (
        table(spark, sf_dir, "part")
        .selectExpr(
            "*",
            """CASE p_type WHEN 'ECONOMY' THEN 'R' WHEN 'MEDIUM' THEN 'A' WHEN 'PROMO' THEN 'L'
               WHEN 'SMALL' THEN 'E' ELSE 'X' END AS AccountType""",
        )
        .selectExpr(
            "p_partkey AS GLAccountID",
            f"CAST({number} AS STRING) AS AccountNumber",
            "p_name AS AccountName",
            "AccountType",
            "p_brand AS AccountSubType",
            "AccountType IN ('R', 'X') AS IsBudgetable",
            "CASE WHEN AccountType IN ('R', 'L', 'E') THEN 'C' ELSE 'D' END AS NormalBalance",
            "p_size % 10 = 0 AS IntercompanyFlag",
            "p_size < 49 AS IsActive",
        )
    )
    return S.complete(accounts, S.GL_ACCOUNT, LOADED_AT)


def cost_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corporate, then regions, nations and suppliers below it."""

    def level(df, id_, code, name, parent, active="true", weight="1"):
        return df.selectExpr(
            f"CAST({id_} AS BIGINT) AS CostCenterID",
            f"{code} AS CostCenterCode",
            f"{name} AS CostCenterName",
            f"CAST({parent} AS BIGINT) AS ParentCostCenterID",
            f"{active} AS IsActive",
            f"CAST({weight} AS DECIMAL(5,4)) AS AllocationWeight",
            f"{VALID_FROM} AS EffectiveFromDate",
        )

    top = level(spark.range(1), 1, "'CORP'", "'Corporate'", "NULL")
    regions = level(
        table(spark, sf_dir, "region"), f"r_regionkey + {REGION_BASE}", "concat('R', r_regionkey)", "r_name", 1
    )
    nations = level(
        table(spark, sf_dir, "nation"), f"n_nationkey + {NATION_BASE}", "concat('N', n_nationkey)", "n_name",
        f"n_regionkey + {REGION_BASE}",
    )
    suppliers = level(
        table(spark, sf_dir, "supplier"), f"s_suppkey + {SUPPLIER_BASE}", "concat('S', s_suppkey)", "s_name",
        f"s_nationkey + {NATION_BASE}", "s_acctbal >= 0", "(s_suppkey % 10 + 1) * 0.1",
    )
    tree = top.unionByName(regions).unionByName(nations).unionByName(suppliers)
    return S.complete(tree, S.COST_CENTER, LOADED_AT)


def budget_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = (
        _order_months(spark, sf_dir)
        .groupBy("y")
        .agg(F.expr(f"min({_PERIOD})").alias("first"), F.expr(f"max({_PERIOD})").alias("last"))
        .selectExpr(
            "CAST(y AS BIGINT) AS BudgetHeaderID",
            "concat('BUDGET-', y, '-001') AS BudgetCode",
            "concat(y, ' Annual Budget') AS BudgetName",
            "'ANNUAL' AS BudgetType",
            "'BASE' AS ScenarioType",
            "y AS FiscalYear",
            "first AS StartPeriodID",
            "last AS EndPeriodID",
        )
    )
    return S.complete(headers, S.BUDGET_HEADER, LOADED_AT)


#: A line's id from its natural key, in (period, account, center) order. It has
#: 38 digits: at full scale an account and a cost center number do not fit into
#: 63 bits together. Accounts stay below 10**12, centers below 10**14.
LINE_ID = """CAST(CAST(FiscalPeriodID * 1000000000000 + GLAccountID AS DECIMAL(19,0)) * 100000000000000BD
    + CAST(CostCenterID AS DECIMAL(14,0)) AS DECIMAL(38,0))"""


def _money(units: str) -> str:
    """Money from a whole number of its smallest unit."""
    return f"CAST(CAST({units} AS DECIMAL(19,0)) * 0.0001BD AS DECIMAL(19,4))"


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's year and month, keys named as in the ledger.

    Prices are whole cents and discounts whole percents, so ``price`` and
    ``reduction`` are exact whole numbers of a 10,000th.
    """
    lines = table(spark, sf_dir, "lineitem")
    months = _order_months(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")
    return lines.join(months, "l_orderkey").selectExpr(
        "CAST(y AS BIGINT) AS BudgetHeaderID",
        "l_partkey AS GLAccountID",
        f"l_suppkey + {SUPPLIER_BASE} AS CostCenterID",
        f"{_PERIOD} AS FiscalPeriodID",
        "CAST(round(l_extendedprice * 100) AS BIGINT) * 100 AS price",
        "-CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) AS reduction",
        "*",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> int:
    """The number of order lines, from the files' footers."""
    return table(spark, sf_dir, "lineitem").count()


def budget_lines(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """The ledger: order lines summed by natural key.

    ``status`` keeps order lines of one line status only: the part of the
    budget that is already booked when an import arrives. Lines beyond what the
    session's shuffle partitions hold are spread over more of them, which what
    groups the ledger by its natural key again has as well.
    """
    lines = keyed_lines(spark, sf_dir)
    if status is not None:
        lines = lines.where(f"l_linestatus = '{status}'")
    needed = partitions(spark, order_lines(spark, sf_dir))
    if needed > partitions(spark, 0):
        lines = lines.repartition(needed, *S.NATURAL_KEY)
    sums = {
        "original": "price",
        "adjusted": "reduction",
        "local": "CASE WHEN l_returnflag = 'R' THEN price END",
        "reporting": "CASE WHEN l_linestatus = 'F' THEN price + reduction END",
    }
    ledger = (
        lines.groupBy(*S.NATURAL_KEY)
        .agg(*[F.expr(f"sum({amount})").alias(name) for name, amount in sums.items()])
        .selectExpr(
            f"{LINE_ID} AS BudgetLineItemID",
            *S.NATURAL_KEY,
            f"{_money('original')} AS OriginalAmount",
            f"{_money('adjusted')} AS AdjustedAmount",
            f"{_money('original + adjusted')} AS FinalAmount",
            f"{_money('local')} AS LocalCurrencyAmount",
            f"{_money('reporting')} AS ReportingCurrencyAmount",
            "'EVEN' AS SpreadMethodCode",
        )
    )
    return S.complete(ledger, S.BUDGET_LINE_ITEM, LOADED_AT)


def allocation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per part, up to three targets each.

    Targets name an existing cost center by id, by code, or by an id and a code
    that disagree; promo parts carry an object instead of an array.
    """
    center = "p_partkey DIV 20"
    by_id = f"""to_json(named_struct('CostCenterID', {center} + {SUPPLIER_BASE}, 'AllocationPercentage', 0.25,
        'Priority', 1, 'AccountFilter', concat(p_partkey, '%')))"""
    by_code = f"""to_json(named_struct('CostCenterCode', concat('S', {center} + 1), 'AllocationPercentage', 0.25,
        'Priority', 2, 'Conditions', CASE WHEN p_size % 4 = 0 THEN named_struct('MinimumSize', p_size) END))"""
    both = f"""to_json(named_struct('CostCenterID', p_size % 25 + {NATION_BASE}, 'CostCenterCode',
        concat('S', {center}), 'ExcludePattern', 'X*'))"""
    named = f"to_json(named_struct('targetCostCenters', array(concat('S', {center}), concat('S', {center} + 1))))"
    rules = table(spark, sf_dir, "part").selectExpr(
        "p_partkey + 1 AS AllocationRuleID",
        "concat('RULE-', p_partkey) AS RuleCode",
        "concat('Allocate ', p_name) AS RuleName",
        "CASE WHEN p_size % 2 = 0 THEN 'DIRECT' ELSE 'STEP_DOWN' END AS RuleType",
        "CASE WHEN p_size % 5 = 0 THEN 'HEADCOUNT' ELSE 'EQUAL' END AS AllocationMethod",
        "CAST(1 AS BIGINT) AS SourceCostCenterID",
        f"""CASE WHEN p_type = 'PROMO' THEN {named}
            ELSE concat('[', concat_ws(',', {by_id}, {by_code}, CASE WHEN p_size % 3 = 0 THEN {both} END), ']')
            END AS TargetSpecification""",
        "CASE WHEN p_size % 5 = 0 THEN 'HEADCOUNT' ELSE 'EQUAL' END AS AllocationBasis",
        "CAST(p_size * 10 AS INT) AS ExecutionSequence",
        f"{VALID_FROM} AS EffectiveFromDate",
        "p_size <= 40 AS IsActive",
    )
    return S.complete(rules, S.ALLOCATION_RULE, LOADED_AT)


def journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = fiscal_periods(spark, sf_dir).selectExpr(
        "FiscalPeriodID AS JournalID",
        "concat('CONS-', FiscalPeriodID) AS JournalNumber",
        "'ELIMINATION' AS JournalType",
        "CAST(FiscalYear AS BIGINT) AS BudgetHeaderID",
        "FiscalPeriodID",
        "PeriodEndDate AS PostingDate",
        "concat('Consolidation adjustments for ', PeriodName) AS Description",
        "concat('row-', FiscalPeriodID) AS AttachmentRowGuid",
    )
    return S.complete(book, S.CONSOLIDATION_JOURNAL, LOADED_AT)


def journal_lines(
    spark: SparkSession, sf_dir: str, numbered: bool = True, ledger: DataFrame | None = None
) -> DataFrame:
    """One line per ledger line, odd cost centers on the credit side.

    Numbering shuffles and stores the lines; pass ``numbered=False`` where no
    line number is read.
    """
    credit, nothing = "CostCenterID % 2 = 1", "CAST(0 AS DECIMAL(19,4))"
    ledger = budget_lines(spark, sf_dir) if ledger is None else ledger
    lines = ledger.selectExpr(
        "BudgetLineItemID AS JournalLineID",
        "FiscalPeriodID AS JournalID",
        "GLAccountID",
        "CostCenterID",
        f"CASE WHEN {credit} THEN {nothing} ELSE FinalAmount END AS DebitAmount",
        f"CASE WHEN {credit} THEN FinalAmount ELSE {nothing} END AS CreditAmount",
        f"CASE WHEN {credit} THEN CAST(-FinalAmount AS DECIMAL(19,4)) ELSE FinalAmount END AS NetAmount",
    )
    if numbered:
        lines = number_rows(lines, ["JournalID"], ["JournalLineID"], "LineNumber")
    else:
        lines = lines.selectExpr("*", "CAST(NULL AS INT) AS LineNumber")
    return S.complete(lines, S.CONSOLIDATION_JOURNAL_LINE, LOADED_AT)


def allocation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS AllocationSessionID",
        "event_id AS SourceBudgetLineItemID",
        f"user_id + {SUPPLIER_BASE} AS TargetCostCenterID",
        "user_id AS TargetGLAccountID",
        "CAST(value AS DECIMAL(19,4)) AS AllocatedAmount",
        "CAST(1 AS DECIMAL(8,6)) AS AllocationPercentage",
        "CAST(1 AS BIGINT) AS AllocationRuleID",
        "1 AS ProcessingSequence",
        "ts AS CreatedDateTime",
    )
    return S.complete(staged, S.ALLOCATION_RESULT_STAGING, LOADED_AT)


def core_tables(
    spark: SparkSession, sf_dir: str, numbered: bool = True, ledger: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables; those made from ledger lines from the given ledger, if there is one."""
    ledger = budget_lines(spark, sf_dir) if ledger is None else ledger
    return {
        "FiscalPeriod": fiscal_periods(spark, sf_dir),
        "GLAccount": gl_accounts(spark, sf_dir),
        "CostCenter": cost_centers(spark, sf_dir),
        "AllocationRule": allocation_rules(spark, sf_dir),
        "BudgetHeader": budget_headers(spark, sf_dir),
        "BudgetLineItem": ledger,
        "ConsolidationJournal": journals(spark, sf_dir),
        "ConsolidationJournalLine": journal_lines(spark, sf_dir, numbered, ledger),
    }


def _element(notes: str) -> str:
    """The JSON text of an order line as a payload element."""
    return f"""to_json(named_struct(
        'account_number',
        CAST(GLAccountID + CASE WHEN l_quantity = 1 THEN 1000000000000 ELSE 0 END AS STRING),
        'cost_center_code', CASE WHEN l_quantity = 2 THEN 'NOPE' ELSE concat('S', l_suppkey) END,
        'fiscal_year', y,
        'fiscal_month', CASE WHEN l_quantity = 3 THEN 13 ELSE m END,
        'original_amount', CASE WHEN l_tax <> 0.08D THEN {_money('price')} END,
        'adjusted_amount', CASE WHEN l_discount > 0 THEN {_money('reduction')} END,
        'spread_method_code', CASE WHEN l_returnflag <> 'N' THEN 'LINEAR' END,
        'notes', {notes}))"""


#: Notes that look like JSON themselves.
NOTES = """concat(l_returnflag, '],"[{\\\\\", é')"""


def import_chunks(spark: SparkSession, sf_dir: str, lines: int = 100) -> DataFrame:
    """One payload a year: an array of null and all its order lines, in chunks that are cut inside of a line."""
    order = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity price l_tax l_discount l_returnflag".split()
    # What no element has is not stored with the numbers.
    used = keyed_lines(spark, sf_dir).select("BudgetHeaderID", "GLAccountID", *order, "reduction", "y", "m")
    numbered = number_rows(used, ["BudgetHeaderID"], order, "n")
    pieces = numbered.selectExpr(
        "BudgetHeaderID", "n", f"concat(',', {_element(NOTES)}) AS text", "CAST(l_partkey % 150 AS INT) AS at"
    )
    halves = f"""explode(array(struct(n div {lines} AS chunk, 2 * n AS place, left(text, at) AS data),
        struct((n + 1) div {lines} AS chunk, 2 * n + 1 AS place, substr(text, at + 1) AS data))) AS h"""
    last = f"struct((max(n) + 1) div {lines} AS chunk, 2 * max(n) + 2 AS place, ']' AS data)"
    ends = pieces.groupBy("BudgetHeaderID").agg(
        F.expr(f"array(struct(0L AS chunk, 0L AS place, '[null' AS data), {last})").alias("ends")
    )
    parts = pieces.selectExpr("BudgetHeaderID", halves).unionAll(ends.selectExpr("BudgetHeaderID", "explode(ends) AS h"))
    text = "array_join(transform(array_sort(collect_list(struct(h.place, h.data))), x -> x.data), '')"
    return (
        parts.groupBy("BudgetHeaderID", F.col("h.chunk").alias("chunk"))
        .agg(F.expr(text).alias("text"))
        .selectExpr(
            "concat('y', BudgetHeaderID) AS payload_id", "BudgetHeaderID", "chunk div 100 AS block", "chunk",
            "CAST(text AS BINARY) AS data",
        )
    )


def import_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per order line: an array of one element, or of two equal
    ones for returned lines of quantity 4. Some codes, months and amounts are
    wrong on purpose."""
    return (
        keyed_lines(spark, sf_dir)
        .selectExpr("*", f"{_element('l_returnflag')} AS element")
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payload_id",
            "BudgetHeaderID",
            """concat('[', element,
                CASE WHEN l_returnflag = 'R' AND l_quantity = 4 THEN concat(',', element) ELSE '' END, ']')
                AS payload""",
        )
    )


def hierarchy_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per cost center, holding its node; NULL for inactive ones."""
    return cost_centers(spark, sf_dir).selectExpr(
        "CostCenterID AS payload_id",
        f"""CASE WHEN IsActive THEN concat('[', to_json(named_struct(
            'NodeID', CostCenterID,
            'ParentNodeID', ParentCostCenterID,
            'NodeLevel', CASE WHEN CostCenterID >= {SUPPLIER_BASE} THEN 3 WHEN CostCenterID >= {NATION_BASE} THEN 2
                         WHEN CostCenterID >= {REGION_BASE} THEN 1 ELSE 0 END,
            'NodePath', concat_ws('/', ParentCostCenterID, CostCenterCode),
            'SortOrder', CAST(CostCenterID % 1000 AS INT),
            'IsLeaf', CostCenterID >= {SUPPLIER_BASE},
            'AggregationWeight', AllocationWeight)), ']') END AS payload""",
    )


def factor_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One allocation-factor request per order; some ask for empty periods or
    unknown targets."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS request_id",
        "CAST(1 AS BIGINT) AS SourceCostCenterID",
        f"o_custkey + {SUPPLIER_BASE} AS TargetCostCenterID",
        "CASE o_orderkey % 3 WHEN 0 THEN 'EQUAL' WHEN 1 THEN 'HEADCOUNT' ELSE 'REVENUE' END AS AllocationBasis",
        """CAST(year(o_orderdate) AS BIGINT) * 100
            + CASE WHEN o_orderkey % 50 = 0 THEN 13 ELSE month(o_orderdate) END AS FiscalPeriodID""",
        "CAST(year(o_orderdate) AS BIGINT) AS BudgetHeaderID",
    )


#: One statement per corpus rule that is on by default, with the rule it is written for.
STATEMENTS = (
    ("SS001", "SELECT GETDATE() AS loaded_at;"),
    ("SS002", "SELECT GETUTCDATE() AS loaded_at;"),
    ("SS003", "SELECT IsNull(amount, 0) FROM ledger;"),
    ("SS004", "INSERT INTO notes VALUES (N'budget', N'plan');"),
    ("SS005", "SELECT total FROM [plan].[Budget Lines];"),
    ("SS006", "IF @@ROWCOUNT = 0 RETURN;"),
    ("SS007", "SET @id = SCOPE_IDENTITY();"),
    ("SS008", "SELECT TOP (25) amount FROM ledger;"),
    ("SS009", "CREATE TABLE header (id NUMBER IDENTITY(1, 1));"),
    ("SS010", "ALTER TABLE header ADD label NVARCHAR(40);"),
    ("SS011", "ALTER TABLE header ADD closed_at DATETIME2;"),
    ("SS012", "ALTER TABLE header ADD guid uniqueidentifier;"),
    ("SS013", "ALTER TABLE ledger ADD rounded SMALLMONEY;"),
    ("SS014", "CREATE NONCLUSTERED INDEX by_period ON ledger (period);"),
    ("SS015", "SELECT amount FROM ledger WITH (NOLOCK);"),
    ("SS016", "EXEC ('SELECT amount FROM ledger');"),
    ("SS017", "BEGIN TRAN; COMMIT TRAN;"),
    ("SS018", "PRINT 'closing period';"),
    ("SS019", "SELECT DATEADD(mm, 3, start_date) FROM period;"),
    ("SS020", "CREATE TYPE LineRows AS TABLE (id NUMBER);"),
    ("SS101", "SELECT first_name + ' ' + last_name FROM manager;"),
    ("SS102", "ALTER TABLE header ADD revision SMALLINT;"),
    ("SS103", "SELECT CHARINDEX('-', code) FROM center;"),
    ("SS104", "SELECT LEN(code) FROM center;"),
    ("SS105", "TRUNCATE TABLE staging;"),
    ("SS106", "MERGE INTO ledger USING staging ON ledger.id = staging.id;"),
    ("SS107", "SELECT MAX(journal.JournalID) INTO :last_id FROM journal;"),
    ("", "SELECT amount FROM ledger WHERE code = 'SALES-N';"),
)


def sql_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL files: one per order, and one per document with all of its text.

    An order's file has a note, a statement, and a query over the order. By
    customer the statement stands alone, inside a comment, or next to a bare or a
    targeted noqa mark. A document's file has its text between two statements.
    """
    by_document = f"element_at(array({', '.join(quoted(x) for _, x in STATEMENTS)}), CAST(doc_id % {len(STATEMENTS)} AS INT) + 1)"
    documents = table(spark, sf_dir, "documents").selectExpr(
        "concat('d/', doc_id, '.sql') AS path",
        f"concat({by_document}, '\\n', coalesce(text, ''), '\\n', {by_document}, '\\n') AS text",
    )
    which = f"CAST(o_orderkey % {len(STATEMENTS)} AS INT)"
    codes = ", ".join(quoted(c) for c, _ in STATEMENTS)
    statements = ", ".join(quoted(s) for _, s in STATEMENTS)
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", f"array({statements})[{which}] AS statement", f"array({codes})[{which}] AS code")
        .selectExpr(
            "concat('q/', o_orderkey, '.sql') AS path",
            """concat('-- order ', o_orderkey, ': ISNULL(), LEN() were replaced\\n',
                CASE o_custkey % 4 WHEN 1 THEN concat('/* ', statement, '\\n*/')
                    WHEN 2 THEN concat(statement, ' -- noqa')
                    WHEN 3 THEN concat(statement, ' -- noqa: ', code) ELSE statement END,
                '\\n  SELECT [status], LEN(\\'', o_orderpriority, '\\') FROM sales;\\n') AS text""",
        )
        .unionByName(documents)
    )


def sql_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long SQL file for each order priority, in chunks of an order each.

    By customer an order's statement stands alone, or opens a comment that a later order
    closes, so that whole runs of orders are inside of one.
    """
    which = f"CAST(o_orderkey % {len(STATEMENTS)} AS INT)"
    statements = ", ".join(quoted(x) for _, x in STATEMENTS)
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('s/', o_orderpriority, '.sql') AS path",
        "o_orderkey div 1000 AS block",
        "o_orderkey AS chunk",
        f"""concat('-- order ', o_orderkey, '\n', CASE WHEN o_custkey % 7 = 0 THEN '*/ ' ELSE '' END,
            array({statements})[{which}], CASE WHEN o_custkey % 11 = 0 THEN ' /* later' ELSE '' END, '\n') AS text""",
    )
