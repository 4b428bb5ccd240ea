"""The same queries in plain SQL, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from ledgerwright.operators.corpus import RULES
from ledgerwright.operators.parity import PLANNING_SPEC
from ledgerwright.plans.queries import BATCH, CLOSE_BEFORE, FORECAST_MONTHS, NOW, RINGS, RUN
from ledgerwright.schemas import TABLES
from ledgerwright.sources.retail import LOADED_AT, STATEMENTS

STAMP = f"TIMESTAMP '{NOW}'"

#: Derived tables as CTEs, each with the CTEs it reads.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    _CTES[name] = (needs, body)


def _ordered(names, seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(_CTES[name][0], seen)
            seen.append(name)
    return seen


def sql(body: str, *needs: str) -> str:
    parts = [f"{n} AS ({_CTES[n][1]})" for n in _ordered(needs, [])]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body if parts else body


cte("order_months", "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders")
cte("FiscalPeriod", f"""
    SELECT CAST(y * 100 + m AS BIGINT) AS FiscalPeriodID, CAST(y AS INTEGER) AS FiscalYear,
           CAST((m + 2) // 3 AS INTEGER) AS FiscalQuarter, CAST(m AS INTEGER) AS FiscalMonth,
           y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS PeriodName,
           make_date(y, m, 1) AS PeriodStartDate, last_day(make_date(y, m, 1)) AS PeriodEndDate,
           FALSE AS IsClosed, CAST(NULL AS TIMESTAMP) AS ClosedDateTime, FALSE AS IsAdjustmentPeriod,
           TIMESTAMP '{LOADED_AT}' AS CreatedDateTime, TIMESTAMP '{LOADED_AT}' AS ModifiedDateTime,
           TIMESTAMP '{LOADED_AT}' AS RowVersionTimestamp
    FROM (SELECT DISTINCT y, m FROM order_months)""", "order_months")


def _accounts(number: str) -> str:
    return f"""
    SELECT p_partkey AS GLAccountID, CAST({number} AS VARCHAR) AS AccountNumber, p_name AS AccountName, AccountType,
           AccountType IN ('R', 'X') AS IsBudgetable, TRUE AS IsPostable, 1 AS AccountLevel, FALSE AS IsStatistical,
           CASE WHEN AccountType IN ('R', 'L', 'E') THEN 'C' ELSE 'D' END AS NormalBalance, 'USD' AS CurrencyCode,
           p_size % 10 = 0 AS IntercompanyFlag, p_size < 49 AS IsActive,
           TIMESTAMP '{LOADED_AT}' AS CreatedDateTime, TIMESTAMP '{LOADED_AT}' AS ModifiedDateTime
    FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'R' WHEN 'MEDIUM' THEN 'A' WHEN 'PROMO' THEN 'L'
                    WHEN 'SMALL' THEN 'E' ELSE 'X' END AS AccountType FROM part)"""


cte("GLAccount", _accounts("p_partkey"))
cte("DirtyAccount", _accounts("p_partkey - CASE WHEN p_partkey % 97 = 1 THEN 1 ELSE 0 END"))
cte("CostCenter", f"""
    SELECT *, DATE '1992-01-01' AS EffectiveFromDate, TIMESTAMP '{LOADED_AT}' AS ValidFrom FROM (
    SELECT CAST(1 AS BIGINT) AS CostCenterID, 'CORP' AS CostCenterCode, 'Corporate' AS CostCenterName,
           CAST(NULL AS BIGINT) AS ParentCostCenterID, TRUE AS IsActive, CAST(1 AS DECIMAL(5,4)) AS AllocationWeight
    UNION ALL SELECT r_regionkey + 10, 'R' || r_regionkey, r_name, 1, TRUE, 1 FROM region
    UNION ALL SELECT n_nationkey + 100, 'N' || n_nationkey, n_name, n_regionkey + 10, TRUE, 1 FROM nation
    UNION ALL SELECT s_suppkey + 1000, 'S' || s_suppkey, s_name, s_nationkey + 100, s_acctbal >= 0,
           CAST((s_suppkey % 10 + 1) * 0.1 AS DECIMAL(5,4)) FROM supplier)""")
cte("BudgetHeader", f"""
    SELECT CAST(y AS BIGINT) AS BudgetHeaderID, 'BUDGET-' || y || '-001' AS BudgetCode,
           y || ' Annual Budget' AS BudgetName, 'ANNUAL' AS BudgetType, 'BASE' AS ScenarioType,
           CAST(y AS INTEGER) AS FiscalYear, CAST(min(y * 100 + m) AS BIGINT) AS StartPeriodID,
           CAST(max(y * 100 + m) AS BIGINT) AS EndPeriodID, 'DRAFT' AS StatusCode, FALSE AS IsLocked,
           1 AS VersionNumber, TIMESTAMP '{LOADED_AT}' AS CreatedDateTime,
           TIMESTAMP '{LOADED_AT}' AS ModifiedDateTime
    FROM order_months GROUP BY y""", "order_months")
_LINE_ID = """CAST(CAST(FiscalPeriodID AS HUGEINT) * 100000000000000000000000000
    + CAST(GLAccountID AS HUGEINT) * 100000000000000 + CAST(CostCenterID AS HUGEINT) AS DECIMAL(38,0))"""
cte("keyed_lines", """
    SELECT CAST(y AS BIGINT) AS BudgetHeaderID, l_partkey AS GLAccountID, l_suppkey + 1000 AS CostCenterID,
           CAST(y * 100 + m AS BIGINT) AS FiscalPeriodID, y, m, lineitem.*,
           CAST(l_extendedprice AS DECIMAL(19,4)) AS price,
           CAST(-CAST(l_extendedprice AS DECIMAL(19,4)) * CAST(l_discount AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS cut
    FROM lineitem JOIN order_months ON l_orderkey = o_orderkey""", "order_months")


def _ledger(where: str = "") -> str:
    return f"""
    SELECT {_LINE_ID} AS BudgetLineItemID, *, CAST(OriginalAmount + AdjustedAmount AS DECIMAL(19,4)) AS FinalAmount,
           'EVEN' AS SpreadMethodCode, CAST(NULL AS VARCHAR) AS ImportBatchID, FALSE AS IsAllocated,
           TIMESTAMP '{LOADED_AT}' AS LastModifiedDateTime
    FROM (SELECT BudgetHeaderID, GLAccountID, CostCenterID, FiscalPeriodID,
                 CAST(sum(price) AS DECIMAL(19,4)) AS OriginalAmount, CAST(sum(cut) AS DECIMAL(19,4)) AS AdjustedAmount,
                 CAST(sum(CASE WHEN l_returnflag = 'R' THEN price END) AS DECIMAL(19,4)) AS LocalCurrencyAmount,
                 CAST(sum(CASE WHEN l_linestatus = 'F' THEN price + cut END) AS DECIMAL(19,4))
                     AS ReportingCurrencyAmount
          FROM keyed_lines {where} GROUP BY ALL)"""


cte("BudgetLineItem", _ledger(), "keyed_lines")
cte("BookedLine", _ledger("WHERE l_linestatus = 'F'"), "keyed_lines")
cte("AllocationRule", f"""
    SELECT p_partkey + 1 AS AllocationRuleID, 'RULE-' || p_partkey AS RuleCode, 'Allocate ' || p_name AS RuleName,
           CASE WHEN p_size % 2 = 0 THEN 'DIRECT' ELSE 'STEP_DOWN' END AS RuleType,
           CASE WHEN p_size % 5 = 0 THEN 'HEADCOUNT' ELSE 'EQUAL' END AS AllocationMethod,
           CASE WHEN p_size % 5 = 0 THEN 'HEADCOUNT' ELSE 'EQUAL' END AS AllocationBasis,
           CAST(1 AS BIGINT) AS SourceCostCenterID, 'given' AS TargetSpecification,
           'NEAREST' AS RoundingMethod, 2 AS RoundingPrecision,
           CAST(p_size * 10 AS INTEGER) AS ExecutionSequence, DATE '1992-01-01' AS EffectiveFromDate,
           CAST(NULL AS DATE) AS EffectiveToDate, p_size <= 40 AS IsActive, p_partkey, p_size, p_type,
           TIMESTAMP '{LOADED_AT}' AS CreatedDateTime, TIMESTAMP '{LOADED_AT}' AS ModifiedDateTime
    FROM part""")
cte("ConsolidationJournal", f"""
    SELECT FiscalPeriodID AS JournalID, 'CONS-' || FiscalPeriodID AS JournalNumber, 'ELIMINATION' AS JournalType,
           CAST(FiscalYear AS BIGINT) AS BudgetHeaderID, FiscalPeriodID, PeriodEndDate AS PostingDate,
           'DRAFT' AS StatusCode, FALSE AS IsAutoReverse, FALSE AS IsReversed,
           CAST(0 AS DECIMAL(19,4)) AS TotalDebits, CAST(0 AS DECIMAL(19,4)) AS TotalCredits, FALSE AS IsBalanced,
           'row-' || FiscalPeriodID AS AttachmentRowGuid
    FROM FiscalPeriod""", "FiscalPeriod")
cte("ConsolidationJournalLine", f"""
    SELECT BudgetLineItemID AS JournalLineID, FiscalPeriodID AS JournalID, GLAccountID, CostCenterID,
           CASE WHEN CostCenterID % 2 = 1 THEN 0 ELSE FinalAmount END AS DebitAmount,
           CASE WHEN CostCenterID % 2 = 1 THEN FinalAmount ELSE 0 END AS CreditAmount,
           CASE WHEN CostCenterID % 2 = 1 THEN -FinalAmount ELSE FinalAmount END AS NetAmount,
           CAST(NULL AS INTEGER) AS LineNumber, 'USD' AS LocalCurrencyCode, CAST(NULL AS BIGINT) AS AllocationRuleID,
           TIMESTAMP '{LOADED_AT}' AS CreatedDateTime
    FROM BudgetLineItem""", "BudgetLineItem")
cte("AllocationResultStaging", """
    SELECT CAST(user_id AS VARCHAR) AS AllocationSessionID, event_id AS SourceBudgetLineItemID,
           user_id + 1000 AS TargetCostCenterID, user_id AS TargetGLAccountID,
           CAST(value AS DECIMAL(19,4)) AS AllocatedAmount, CAST(1 AS DECIMAL(8,6)) AS AllocationPercentage,
           1 AS AllocationRuleID, 1 AS ProcessingSequence, ts AS CreatedDateTime
    FROM events""")

_KEYS = "BudgetHeaderID, GLAccountID, CostCenterID, FiscalPeriodID"


def _wide(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,4))"


ORACLES: dict[str, str] = {}

ORACLES["budget_consolidation_summary"] = sql(f"""
SELECT h.BudgetHeaderID, BudgetCode, BudgetName, BudgetType, ScenarioType, h.FiscalYear, p.FiscalPeriodID,
       FiscalQuarter, FiscalMonth, PeriodName, a.GLAccountID, AccountNumber, AccountName, AccountType,
       c.CostCenterID, CostCenterCode, CostCenterName, ParentCostCenterID,
       {_wide("sum(OriginalAmount)")} AS TotalOriginalAmount, {_wide("sum(AdjustedAmount)")} AS TotalAdjustedAmount,
       {_wide("sum(OriginalAmount + AdjustedAmount)")} AS TotalFinalAmount,
       {_wide("sum(coalesce(LocalCurrencyAmount, 0))")} AS TotalLocalCurrency,
       {_wide("sum(coalesce(ReportingCurrencyAmount, 0))")} AS TotalReportingCurrency, count(*) AS LineItemCount
FROM BudgetLineItem l JOIN BudgetHeader h ON l.BudgetHeaderID = h.BudgetHeaderID
JOIN GLAccount a ON l.GLAccountID = a.GLAccountID JOIN CostCenter c ON l.CostCenterID = c.CostCenterID
JOIN FiscalPeriod p ON l.FiscalPeriodID = p.FiscalPeriodID
GROUP BY ALL""", "BudgetLineItem", "BudgetHeader", "GLAccount", "CostCenter", "FiscalPeriod")

cte("targets", """
    SELECT *, p_partkey // 20 + 1000 AS id, CAST(NULL AS VARCHAR) AS code, 0.25 AS pct, 1 AS priority,
           p_partkey || '%' AS filter, CAST(NULL AS VARCHAR) AS exclude, CAST(NULL AS VARCHAR) AS cond
    FROM AllocationRule WHERE p_type <> 'PROMO'
    UNION ALL
    SELECT *, NULL, 'S' || (p_partkey // 20 + 1), 0.25, 2, NULL, NULL,
           CASE WHEN p_size % 4 = 0 THEN '{"MinimumSize":' || p_size || '}' END
    FROM AllocationRule WHERE p_type <> 'PROMO'
    UNION ALL
    SELECT *, p_size % 25 + 100, 'S' || (p_partkey // 20), NULL, NULL, NULL, 'X*', NULL
    FROM AllocationRule WHERE p_type <> 'PROMO' AND p_size % 3 = 0
    UNION ALL
    SELECT *, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM AllocationRule WHERE p_type = 'PROMO'""", "AllocationRule")
ORACLES["allocation_rule_targets"] = sql(f"""
SELECT AllocationRuleID, RuleCode, RuleName, RuleType, AllocationMethod, ExecutionSequence,
       CAST(id AS BIGINT) AS TargetCostCenterID, code AS TargetCostCenterCode,
       CAST(pct AS DECIMAL(8,6)) AS TargetAllocationPct, CAST(priority AS INTEGER) AS TargetPriority,
       filter AS AccountFilter, exclude AS ExcludePattern, cond IS NOT NULL AS HasConditions, cond AS ConditionsJson,
       c.CostCenterName AS TargetCostCenterName, c.ParentCostCenterID AS TargetParentCostCenterID,
       c.IsActive AS TargetIsActive, t.EffectiveFromDate, t.EffectiveToDate, t.IsActive AS RuleIsActive,
       {STAMP} AS ViewGeneratedDateTime
FROM targets t LEFT JOIN CostCenter c ON c.CostCenterID = t.id OR c.CostCenterCode = t.code
WHERE t.IsActive""", "targets", "CostCenter")

ORACLES["allocation_factor"] = sql("""
SELECT r.*, CAST(CASE basis_kind WHEN 0 THEN CAST(1.0 AS DOUBLE) / nullif(s.n, 0)
                 WHEN 1 THEN coalesce(c.AllocationWeight, 1) ELSE 1 END AS DECIMAL(18,10)) AS AllocationFactor
FROM (SELECT o_orderkey AS request_id, CAST(1 AS BIGINT) AS SourceCostCenterID, o_custkey + 1000 AS TargetCostCenterID,
             CASE o_orderkey % 3 WHEN 0 THEN 'EQUAL' WHEN 1 THEN 'HEADCOUNT' ELSE 'REVENUE' END AS AllocationBasis,
             CAST(year(o_orderdate) * 100 + CASE WHEN o_orderkey % 50 = 0 THEN 13 ELSE month(o_orderdate) END AS BIGINT)
                 AS FiscalPeriodID,
             CAST(year(o_orderdate) AS BIGINT) AS BudgetHeaderID FROM orders) r
JOIN (SELECT o_orderkey AS request_id, o_orderkey % 3 AS basis_kind FROM orders) k USING (request_id)
LEFT JOIN (SELECT BudgetHeaderID, FiscalPeriodID, count(DISTINCT CostCenterID) AS n FROM BudgetLineItem GROUP BY ALL) s
  ON r.BudgetHeaderID = s.BudgetHeaderID AND r.FiscalPeriodID = s.FiscalPeriodID
LEFT JOIN CostCenter c ON c.CostCenterID = r.TargetCostCenterID""", "BudgetLineItem", "CostCenter")

cte("up", """
    SELECT CostCenterID AS start, CostCenterCode AS path, ParentCostCenterID AS parent, 1 AS depth FROM CostCenter
    UNION ALL
    SELECT start, c.CostCenterCode || '/' || path, c.ParentCostCenterID, depth + 1
    FROM up JOIN CostCenter c ON c.CostCenterID = up.parent WHERE depth < 20""", "CostCenter")
ORACLES["cost_center_path"] = sql("""
SELECT CostCenterID, arg_max(path, depth) AS path, any_value(CostCenterCode) AS literal_path
FROM up JOIN CostCenter ON CostCenterID = start GROUP BY CostCenterID""", "up")

cte("down", """
    SELECT CostCenterID AS RootCostCenterID, CostCenterID, CostCenterCode, CostCenterName, ParentCostCenterID,
           0 AS HierarchyLevel, CostCenterCode AS HierarchyPath FROM CostCenter WHERE IsActive
    UNION ALL
    SELECT RootCostCenterID, c.CostCenterID, c.CostCenterCode, c.CostCenterName, c.ParentCostCenterID,
           HierarchyLevel + 1, HierarchyPath || '/' || c.CostCenterCode
    FROM down JOIN CostCenter c ON c.ParentCostCenterID = down.CostCenterID
    WHERE c.IsActive AND HierarchyLevel < 20""", "CostCenter")
ORACLES["cost_center_explode"] = sql("SELECT * FROM down", "down")

cte("active", "SELECT CostCenterID AS id, ParentCostCenterID AS parent FROM CostCenter WHERE IsActive", "CostCenter")
cte("walk", """
    SELECT id, 0 AS level, [id] AS path FROM active WHERE parent IS NULL OR parent NOT IN (SELECT id FROM active)
    UNION ALL SELECT a.id, level + 1, list_append(path, a.id) FROM walk JOIN active a ON a.parent = walk.id""", "active")
cte("below", "SELECT unnest(path) AS id, count(*) AS n FROM walk GROUP BY 1", "walk")
ORACLES["cost_center_labels"] = sql("""
SELECT w.id AS CostCenterID, CAST(2 * r - level AS BIGINT) AS "first", CAST(2 * r - level + 2 * n - 1 AS BIGINT) AS "last",
       CAST(level AS INTEGER) AS level
FROM (SELECT *, row_number() OVER (ORDER BY path) - 0.5 AS r FROM walk) w JOIN below USING (id)""", "walk", "below")

ORACLES["budget_variance"] = sql("""
SELECT BudgetHeaderID, FiscalPeriodID, GLAccountID, CostCenterID, OriginalAmount, AdjustedAmount, FinalAmount,
       AdjustedAmount AS VarianceAmount,
       CAST(CASE WHEN OriginalAmount <> 0 THEN AdjustedAmount / OriginalAmount * 100 ELSE 0 END AS DECIMAL(10,2))
           AS VariancePercent
FROM BudgetLineItem WHERE AdjustedAmount <> 0""", "BudgetLineItem")

cte("payload_rows", """
    SELECT payload_id, BudgetHeaderID, row_id, account_number, cost_center_code, fiscal_year, fiscal_month,
           original_amount, adjusted_amount, spread_method_code, notes
    FROM (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS payload_id,
                 BudgetHeaderID,
                 CAST(l_partkey + CASE WHEN l_quantity = 1 THEN 1000000000000 ELSE 0 END AS VARCHAR) AS account_number,
                 CASE WHEN l_quantity = 2 THEN 'NOPE' ELSE 'S' || l_suppkey END AS cost_center_code,
                 CAST(y AS INTEGER) AS fiscal_year,
                 CAST(CASE WHEN l_quantity = 3 THEN 13 ELSE m END AS INTEGER) AS fiscal_month,
                 CASE WHEN l_tax <> 0.08 THEN price END AS original_amount,
                 CASE WHEN l_discount > 0 THEN cut END AS adjusted_amount,
                 CASE WHEN l_returnflag <> 'N' THEN 'LINEAR' END AS spread_method_code, l_returnflag AS notes,
                 CASE WHEN l_returnflag = 'R' AND l_quantity = 4 THEN 2 ELSE 1 END AS copies
          FROM keyed_lines) s
    JOIN (SELECT CAST(1 AS INTEGER) AS row_id UNION ALL SELECT 2) n ON row_id <= copies""", "keyed_lines")
ORACLES["import_payload_rows"] = sql("SELECT * FROM payload_rows", "payload_rows")

ORACLES["import_chunk_rows"] = sql("""
SELECT 'y' || BudgetHeaderID AS payload_id, BudgetHeaderID, CAST(1 + row_number() OVER (PARTITION BY BudgetHeaderID ORDER BY
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, price, l_tax, l_discount, l_returnflag) AS INTEGER) AS row_id,
       CAST(l_partkey + CASE WHEN l_quantity = 1 THEN 1000000000000 ELSE 0 END AS VARCHAR) AS account_number,
       CASE WHEN l_quantity = 2 THEN 'NOPE' ELSE 'S' || l_suppkey END AS cost_center_code,
       CAST(y AS INTEGER) AS fiscal_year, CAST(CASE WHEN l_quantity = 3 THEN 13 ELSE m END AS INTEGER) AS fiscal_month,
       CASE WHEN l_tax <> 0.08 THEN price END AS original_amount, CASE WHEN l_discount > 0 THEN cut END AS adjusted_amount,
       CASE WHEN l_returnflag <> 'N' THEN 'LINEAR' END AS spread_method_code, l_returnflag || '],"[{\\", é' AS notes
FROM keyed_lines
UNION ALL
SELECT DISTINCT 'y' || BudgetHeaderID, BudgetHeaderID, 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM keyed_lines""", "keyed_lines")

cte("resolved", """
    SELECT r.*, a.id AS GLAccountID, c.id AS CostCenterID, p.id AS FiscalPeriodID
    FROM payload_rows r
    LEFT JOIN (SELECT AccountNumber, min(GLAccountID) AS id FROM DirtyAccount GROUP BY ALL HAVING count(*) = 1) a
      ON a.AccountNumber = r.account_number
    LEFT JOIN (SELECT CostCenterCode, min(CostCenterID) AS id FROM CostCenter GROUP BY ALL HAVING count(*) = 1) c
      ON c.CostCenterCode = r.cost_center_code
    LEFT JOIN (SELECT FiscalYear, FiscalMonth, min(FiscalPeriodID) AS id FROM FiscalPeriod
               GROUP BY ALL HAVING count(*) = 1) p
      ON p.FiscalYear = r.fiscal_year AND p.FiscalMonth = r.fiscal_month""",
    "payload_rows", "DirtyAccount", "CostCenter", "FiscalPeriod")
ORACLES["import_resolve_keys"] = sql("SELECT * FROM resolved", "resolved")

cte("checked", f"""
    SELECT *, CASE WHEN GLAccountID IS NULL THEN 'Unknown or ambiguous account_number'
                   WHEN CostCenterID IS NULL THEN 'Unknown or ambiguous cost_center_code'
                   WHEN FiscalPeriodID IS NULL THEN 'No unique fiscal period for fiscal_year/fiscal_month'
                   WHEN original_amount IS NULL THEN 'Missing required fields'
                   WHEN copies > 1 THEN 'Duplicate key within the import payload' END AS reason
    FROM (SELECT *, count(*) OVER (PARTITION BY {_KEYS}) AS copies FROM resolved)""", "resolved")
cte("matched", f"""
    SELECT c.*, c.reason IS NULL AND b.BudgetLineItemID IS NOT NULL AS found
    FROM checked c LEFT JOIN BookedLine b USING ({_KEYS})""", "checked", "BookedLine")
_ROW = """payload_id, BudgetHeaderID, row_id, account_number, cost_center_code, fiscal_year, fiscal_month,
       original_amount, adjusted_amount, spread_method_code, notes, GLAccountID, CostCenterID, FiscalPeriodID"""
cte("validated", f"""
    SELECT {_ROW}, error IS NULL AS is_valid, error AS validation_errors, found AS line_exists
    FROM (SELECT *, CASE WHEN found THEN 'Line already exists in the target budget' ELSE reason END AS error
          FROM matched)""", "matched")
ORACLES["import_validate"] = sql("SELECT * FROM validated", "validated")

_NEW_HASH = f"md5('{BATCH}/' || payload_id || '/' || row_id)"
_NEW_ID = f"""CAST(('0x' || substr({_NEW_HASH}, 1, 15))::BIGINT AS HUGEINT) * 1152921504606846976
       + ('0x' || substr({_NEW_HASH}, 16, 15))::BIGINT"""
ORACLES["import_apply"] = sql(f"""
SELECT b.BudgetLineItemID, {_KEYS},
       CASE WHEN m.found THEN m.original_amount ELSE b.OriginalAmount END AS OriginalAmount,
       CASE WHEN m.found THEN coalesce(m.adjusted_amount, 0) ELSE b.AdjustedAmount END AS AdjustedAmount,
       CAST(CASE WHEN m.found THEN m.original_amount + coalesce(m.adjusted_amount, 0) ELSE b.FinalAmount END
            AS DECIMAL(19,4)) AS FinalAmount,
       CASE WHEN m.found THEN coalesce(m.spread_method_code, b.SpreadMethodCode) ELSE b.SpreadMethodCode END
           AS SpreadMethodCode,
       CASE WHEN m.found THEN '{BATCH}' END AS ImportBatchID,
       CASE WHEN m.found THEN {STAMP} ELSE b.LastModifiedDateTime END AS LastModifiedDateTime
FROM BookedLine b LEFT JOIN (SELECT * FROM matched WHERE found) m USING ({_KEYS})
UNION ALL
SELECT {_NEW_ID}, {_KEYS}, original_amount, coalesce(adjusted_amount, 0),
       CAST(original_amount + coalesce(adjusted_amount, 0) AS DECIMAL(19,4)), spread_method_code, '{BATCH}', {STAMP}
FROM matched WHERE reason IS NULL AND NOT found""", "matched", "BookedLine")

ORACLES["import_result"] = sql(f"""
SELECT '{BATCH}' AS import_batch_id, 'VARIANT' AS import_source, 'REJECT' AS duplicate_handling, c.BudgetHeaderID,
       total_rows_loaded, rows_inserted AS rows_imported, rows_inserted, 0 AS rows_updated,
       total_rows_loaded - rows_inserted AS rows_rejected, coalesce(rejections, '[]') AS rejections,
       CASE WHEN total_rows_loaded = rows_inserted THEN 'SUCCESS' WHEN rows_inserted = 0 THEN 'FAILED'
            ELSE 'PARTIAL_SUCCESS' END AS status
FROM (SELECT BudgetHeaderID, count(*) AS total_rows_loaded, count(*) FILTER (is_valid) AS rows_inserted
      FROM validated GROUP BY ALL) c
LEFT JOIN (
    SELECT BudgetHeaderID, '[' || string_agg('{{"payload_id":"' || payload_id || '","row":' || row_id
           || ',"account_number":"' || account_number || '","cost_center_code":"' || cost_center_code
           || '","error":"' || validation_errors || '"}}', ',' ORDER BY n) || ']' AS rejections
    FROM (SELECT *, row_number() OVER (PARTITION BY BudgetHeaderID ORDER BY payload_id, row_id, account_number,
                 cost_center_code, validation_errors) AS n FROM validated WHERE NOT is_valid)
    WHERE n <= 100 GROUP BY ALL) r USING (BudgetHeaderID)""", "validated")


def _journal(prefix: str, kind: str, about: str) -> str:
    return f"""
    SELECT ('0x' || substr(md5('{kind}/{RUN.id}/' || BudgetHeaderID), 1, 15))::BIGINT AS JournalID,
           '{prefix}' || strftime({STAMP}, '%Y%m%d%H%M%S') || '-'
               || printf('%08x', (BudgetHeaderID + {int(RUN.id[:8], 16)}) % 4294967296) AS JournalNumber,
           '{kind}' AS JournalType, BudgetHeaderID, StartPeriodID AS FiscalPeriodID,
           CAST({STAMP} AS DATE) AS PostingDate, '{about}' || BudgetCode AS Description, 'DRAFT' AS StatusCode,
           NULL AS SourceEntityCode, NULL AS TargetEntityCode, FALSE AS IsAutoReverse, NULL AS ReversalPeriodID,
           NULL AS ReversedFromJournalID, FALSE AS IsReversed, CAST(0 AS DECIMAL(19,4)) AS TotalDebits,
           CAST(0 AS DECIMAL(19,4)) AS TotalCredits, FALSE AS IsBalanced, NULL AS PreparedByUserID,
           NULL AS PreparedDateTime, NULL AS ReviewedByUserID, NULL AS ReviewedDateTime, NULL AS ApprovedByUserID,
           NULL AS ApprovedDateTime, NULL AS PostedByUserID, NULL AS PostedDateTime, NULL AS AttachmentReference
    FROM BudgetHeader"""


def _with_guid(journal: str) -> str:
    return f"SELECT *, md5('{RUN.id}' || JournalNumber) AS AttachmentRowGuid FROM {journal}"


cte("alloc_journal", _journal("ALLOC-", "ALLOCATION", "Cost allocation for budget "), "BudgetHeader")
cte("consol_journal", _journal("CONSOL-", "CONSOLIDATION", "Budget consolidation (FULL) for budget "), "BudgetHeader")
ORACLES["cost_allocation_journal"] = sql(_with_guid("alloc_journal"), "alloc_journal")
ORACLES["consolidation_journal"] = sql(_with_guid("consol_journal"), "consol_journal")


def _journal_lines(journal: str, join: str = "") -> str:
    return f"""
SELECT CAST(JournalID AS HUGEINT) * 1000000000000
           + row_number() OVER (PARTITION BY JournalID ORDER BY BudgetLineItemID) AS JournalLineID,
       JournalID, CAST(row_number() OVER (PARTITION BY JournalID ORDER BY BudgetLineItemID) AS INTEGER) AS LineNumber,
       l.GLAccountID, l.CostCenterID, l.FinalAmount AS DebitAmount, CAST(0 AS DECIMAL(19,4)) AS CreditAmount,
       l.FinalAmount AS NetAmount, {STAMP} AS CreatedDateTime
FROM BudgetLineItem l JOIN {journal} j ON l.BudgetHeaderID = j.BudgetHeaderID {join}"""


_ACTIVE = "JOIN CostCenter c ON c.CostCenterID = l.CostCenterID AND c.IsActive"
ORACLES["cost_allocation_lines"] = sql(_journal_lines("alloc_journal"), "alloc_journal", "BudgetLineItem")
ORACLES["consolidation_lines"] = sql(
    _journal_lines("consol_journal", _ACTIVE), "consol_journal", "BudgetLineItem", "CostCenter")
ORACLES["cost_allocation_result"] = sql(f"""
SELECT j.BudgetHeaderID, {STAMP} AS allocation_start, {STAMP} AS allocation_end,
       (SELECT count(*) FROM AllocationRule WHERE IsActive) AS rules_processed,
       {_wide("coalesce(sum(l.FinalAmount), 0)")} AS total_allocated, 0 AS error_count, FALSE AS dry_run,
       JournalID AS journal_id, JournalNumber AS journal_number,
       CAST(NULL AS VARCHAR) AS allocation_basis_override, 'SUCCESS' AS status
FROM alloc_journal j LEFT JOIN BudgetLineItem l ON l.BudgetHeaderID = j.BudgetHeaderID
GROUP BY j.BudgetHeaderID, JournalID, JournalNumber""", "alloc_journal", "BudgetLineItem", "AllocationRule")
ORACLES["consolidation_result"] = sql(f"""
SELECT {STAMP} AS consolidation_start, {STAMP} AS consolidation_end, j.BudgetHeaderID AS budget_header_id,
       'FULL' AS consolidation_type, TRUE AS eliminate_intercompany, count(c.CostCenterID) AS consolidated_lines,
       JournalID AS journal_id, JournalNumber AS journal_number, {_wide("0")} AS eliminated_amount,
       'SUCCESS' AS status
FROM consol_journal j LEFT JOIN BudgetLineItem l ON l.BudgetHeaderID = j.BudgetHeaderID LEFT {_ACTIVE}
GROUP BY j.BudgetHeaderID, JournalID, JournalNumber""", "consol_journal", "BudgetLineItem", "CostCenter")

cte("forecast", f"""
    SELECT BudgetHeaderID, n AS PeriodNumber, CAST(FiscalYear + 1 + (n - 1) // 12 AS INTEGER) AS FiscalYear,
           CAST((n - 1) % 12 + 1 AS INTEGER) AS FiscalMonth, CAST(100000 AS DECIMAL(19,4)) AS ForecastAmount
    FROM BudgetHeader, (SELECT CAST(unnest(range(1, {FORECAST_MONTHS + 1})) AS INTEGER) AS n)""", "BudgetHeader")
ORACLES["rolling_forecast"] = sql("SELECT * FROM forecast", "forecast")
ORACLES["rolling_forecast_result"] = sql(f"""
SELECT BudgetHeaderID, count(*) AS periods_generated, {_wide("sum(ForecastAmount)")} AS total_forecast_amount,
       CAST(0 AS DECIMAL(9,4)) AS growth_rate_pct
FROM forecast GROUP BY BudgetHeaderID""", "forecast")

_CLOSED = f"PeriodEndDate < DATE '{CLOSE_BEFORE}'"
ORACLES["close_period"] = sql(f"""
SELECT FiscalPeriodID, FiscalYear, FiscalMonth, PeriodName, {_CLOSED} AS IsClosed,
       CASE WHEN {_CLOSED} THEN {STAMP} END AS ClosedDateTime
FROM FiscalPeriod""", "FiscalPeriod")
ORACLES["close_lines"] = sql(f"""
SELECT BudgetLineItemID, BudgetHeaderID, FiscalPeriodID, FinalAmount,
       FiscalPeriodID IN (SELECT FiscalPeriodID FROM FiscalPeriod WHERE {_CLOSED}) AS IsAllocated
FROM BudgetLineItem""", "BudgetLineItem", "FiscalPeriod")

cte("items", """
    SELECT l.BudgetLineItemID, l.CostCenterID, l.GLAccountID, l.FiscalPeriodID, l.FinalAmount, 'UNMATCHED' AS status
    FROM BudgetLineItem l JOIN GLAccount a ON a.GLAccountID = l.GLAccountID
    JOIN CostCenter c ON c.CostCenterID = l.CostCenterID WHERE a.IntercompanyFlag""",
    "BudgetLineItem", "GLAccount", "CostCenter")
ORACLES["intercompany_items"] = sql("SELECT * FROM items", "items")
ORACLES["intercompany_result"] = sql("""
SELECT p.FiscalPeriodID AS fiscal_period_id, CAST(0.01 AS DECIMAL(19,4)) AS tolerance_amount,
       count(i.BudgetLineItemID) AS reconciled_count, CAST(0 AS BIGINT) AS variance_count,
       CAST(0 AS DECIMAL(19,4)) AS total_variance_amount
FROM FiscalPeriod p LEFT JOIN items i ON i.FiscalPeriodID = p.FiscalPeriodID
GROUP BY p.FiscalPeriodID""", "items", "FiscalPeriod")

ORACLES["hierarchy_nodes"] = sql("""
SELECT CostCenterID AS NodeID, ParentCostCenterID AS ParentNodeID,
       CASE WHEN CostCenterID >= 1000 THEN 3 WHEN CostCenterID >= 100 THEN 2 WHEN CostCenterID >= 10 THEN 1 ELSE 0 END
           AS NodeLevel,
       concat_ws('/', CAST(ParentCostCenterID AS VARCHAR), CostCenterCode) AS NodePath,
       CAST(CostCenterID % 1000 AS INTEGER) AS SortOrder, CostCenterID >= 1000 AS IsLeaf,
       CAST(AllocationWeight AS DECIMAL(8,6)) AS AggregationWeight
FROM CostCenter WHERE IsActive""", "CostCenter")

_OLD = f"CreatedDateTime < {STAMP} - INTERVAL 24 HOUR"
ORACLES["cleanup_allocation_results"] = sql(f"""
SELECT count(*) FILTER ({_OLD}) AS deleted, count(*) FILTER (NOT ({_OLD})) AS kept,
       'Deleted ' || count(*) FILTER ({_OLD}) || ' old allocation results' AS message
FROM AllocationResultStaging""", "AllocationResultStaging")
ORACLES["kept_allocation_results"] = sql(f"""
SELECT AllocationSessionID, SourceBudgetLineItemID, AllocatedAmount, CreatedDateTime
FROM AllocationResultStaging WHERE NOT ({_OLD})""", "AllocationResultStaging")

_CORE = ("FiscalPeriod", "GLAccount", "CostCenter", "AllocationRule", "BudgetHeader", "BudgetLineItem",
         "ConsolidationJournal", "ConsolidationJournalLine")
ORACLES["table_counts"] = sql(
    "\nUNION ALL ".join(f"SELECT '{t}' AS TableName, count(*) AS RecordCount FROM {t}" for t in _CORE), *_CORE)

ORACLES["budget_line_sample"] = sql("""
SELECT BudgetCode, BudgetName, AccountNumber, AccountName, CostCenterCode, CostCenterName,
       OriginalAmount, AdjustedAmount, FinalAmount
FROM BudgetLineItem l JOIN BudgetHeader h ON l.BudgetHeaderID = h.BudgetHeaderID
JOIN GLAccount a ON l.GLAccountID = a.GLAccountID JOIN CostCenter c ON l.CostCenterID = c.CostCenterID
ORDER BY BudgetLineItemID LIMIT 10""", "BudgetLineItem", "BudgetHeader", "GLAccount", "CostCenter")
ORACLES["budget_analysis"] = sql(f"""
SELECT BudgetCode, BudgetName, count(DISTINCT FiscalPeriodID) AS PeriodsIncluded, count(*) AS LineItemCount,
       {_wide("sum(OriginalAmount)")} AS TotalOriginal, {_wide("sum(AdjustedAmount)")} AS TotalAdjusted,
       {_wide("sum(FinalAmount)")} AS TotalFinal,
       CAST(round(sum(FinalAmount) / nullif(sum(OriginalAmount), 0), 4) AS DECIMAL(19,4)) AS FinalToOriginalRatio
FROM BudgetLineItem l JOIN BudgetHeader h ON l.BudgetHeaderID = h.BudgetHeaderID
GROUP BY BudgetCode, BudgetName""", "BudgetLineItem", "BudgetHeader")
ORACLES["cost_center_summary"] = sql(f"""
SELECT c.CostCenterCode, c.CostCenterName, coalesce(p.CostCenterCode, 'ROOT') AS ParentCode,
       count(DISTINCT BudgetLineItemID) AS BudgetLineCount, {_wide("sum(FinalAmount)")} AS TotalBudgetAmount
FROM CostCenter c LEFT JOIN CostCenter p ON c.ParentCostCenterID = p.CostCenterID
LEFT JOIN BudgetLineItem l ON l.CostCenterID = c.CostCenterID
WHERE c.IsActive GROUP BY c.CostCenterCode, c.CostCenterName, p.CostCenterCode""", "CostCenter", "BudgetLineItem")
ORACLES["gl_account_distribution"] = sql(f"""
SELECT BudgetCode, CASE AccountType WHEN 'R' THEN 'Revenue' WHEN 'X' THEN 'Expense' WHEN 'A' THEN 'Asset'
           WHEN 'L' THEN 'Liability' WHEN 'E' THEN 'Equity' END AS AccountCategory,
       CAST(count(*) AS BIGINT) AS AccountCount, CAST(sum((l.FiscalPeriodID IS NOT NULL)::INT) AS BIGINT)
           AS BudgetedAccounts,
       {_wide("sum(coalesce(FinalAmount, 0))")} AS TotalBudgetAmount
FROM GLAccount a CROSS JOIN BudgetHeader h
LEFT JOIN BudgetLineItem l ON a.GLAccountID = l.GLAccountID AND l.BudgetHeaderID = h.BudgetHeaderID
WHERE a.IsActive GROUP BY ALL""", "GLAccount", "BudgetHeader", "BudgetLineItem")


def _scenario(name: str, kind: str, suffix: str, label: str, month: int) -> str:
    return f"""
SELECT 'BUDGET-' || FiscalYear || '-{suffix}' AS BudgetCode, FiscalYear || ' {label}' AS BudgetName,
       '{kind}' AS BudgetType, '{name}' AS ScenarioType, FiscalYear,
       min(CASE WHEN FiscalMonth = {month} THEN FiscalPeriodID END) AS StartPeriodID,
       max(CASE WHEN FiscalMonth = 12 THEN FiscalPeriodID END) AS EndPeriodID, 'DRAFT' AS StatusCode,
       1 AS VersionNumber, FALSE AS IsLocked
FROM FiscalPeriod GROUP BY FiscalYear"""


ORACLES["budget_header_bounds"] = sql("\nUNION ALL".join([
    _scenario("BASE", "ANNUAL", "001", "Annual Budget - Base Case", 1),
    _scenario("OPTIMISTIC", "ROLLING", "002", "Rolling Forecast - Optimistic", 2),
    _scenario("PESSIMISTIC", "ROLLING", "003", "Rolling Forecast - Conservative", 3),
]), "FiscalPeriod")


def _scramble(salt: int, *keys: str) -> str:
    state = str(salt)
    for key in keys:
        state = f"(({state}) * 48271 + ({key} % 2147483647) * 69621 + 12345) % 2147483647"
    return f"CAST((({state}) * 16807) % 2147483647 AS BIGINT)"


def _cells(owners: str, owner: str, size: str, lines: int, salt: int) -> str:
    """Stratified cell numbers of every owner."""
    return f"""
    SELECT *, low + (CAST({_scramble(salt, owner, "draw")} AS HUGEINT) * 2147483647
                     + {_scramble(salt + 100, owner, "draw")}) % (high - low) AS cell
    FROM (SELECT *, draw * size // wanted AS low, (draw + 1) * size // wanted AS high
          FROM (SELECT *, CAST(unnest(range(0, CAST(wanted AS BIGINT))) AS HUGEINT) AS draw
                FROM (SELECT *, least(size, {lines}) AS wanted
                      FROM (SELECT *, CAST({size} AS HUGEINT) AS size FROM ({owners})))))"""


cte("usable_accounts", """
    SELECT GLAccountID, AccountType, row_number() OVER (ORDER BY GLAccountID) - 1 AS a
    FROM GLAccount WHERE IsBudgetable""", "GLAccount")
cte("postable_accounts", """
    SELECT GLAccountID, AccountName, NormalBalance, row_number() OVER (ORDER BY GLAccountID) - 1 AS a
    FROM GLAccount WHERE IsPostable""", "GLAccount")
cte("active_centers", """
    SELECT CostCenterID, CostCenterName, row_number() OVER (ORDER BY CostCenterID) - 1 AS c
    FROM CostCenter WHERE IsActive""", "CostCenter")
cte("grid_cells", _cells(
    """SELECT BudgetHeaderID, h.FiscalYear, periods, (SELECT count(*) FROM usable_accounts) AS accounts,
              (SELECT count(*) FROM active_centers) AS centers
       FROM BudgetHeader h JOIN (SELECT FiscalYear, count(*) AS periods FROM FiscalPeriod GROUP BY ALL) p
         ON p.FiscalYear = h.FiscalYear""",
    "BudgetHeaderID", "CAST(accounts AS HUGEINT) * centers * periods", 250, 11),
    "BudgetHeader", "FiscalPeriod", "usable_accounts", "active_centers")
_CELL = ("BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID")
_GRID_DRAW = _scramble(1, *_CELL)


def _tenth(salt: int) -> str:
    return f"(base * ({_scramble(salt, *_CELL)} % 10001) + 50000) // 100000"


def _cents(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(19,0)) * 0.01 AS DECIMAL(19,4))"


ORACLES["budget_grid"] = sql(f"""
SELECT {_KEYS}, {_cents("base")} AS OriginalAmount, {_cents(_tenth(2))} AS AdjustedAmount,
       {_cents("base + " + _tenth(3))} AS FinalAmount, 'EVEN' AS SpreadMethodCode, FALSE AS IsAllocated
FROM (SELECT *, CASE AccountType WHEN 'R' THEN {_GRID_DRAW} % 50000001 + 10000000
                     WHEN 'X' THEN {_GRID_DRAW} % 5000001 + 1000000 ELSE {_GRID_DRAW} % 10000001 END AS base
      FROM (SELECT g.BudgetHeaderID, GLAccountID, CostCenterID, FiscalPeriodID, AccountType
            FROM grid_cells g
            JOIN usable_accounts u ON u.a = g.cell % accounts
            JOIN active_centers c ON c.c = g.cell // accounts % centers
            JOIN (SELECT FiscalYear, FiscalPeriodID,
                         row_number() OVER (PARTITION BY FiscalYear ORDER BY FiscalMonth, FiscalPeriodID) - 1 AS p
                  FROM FiscalPeriod) m
              ON m.FiscalYear = g.FiscalYear AND m.p = g.cell // accounts // centers))""",
    "grid_cells", "usable_accounts", "active_centers", "FiscalPeriod")

ORACLES["journal_headers_numbered"] = sql("""
SELECT 'CONS-' || h.FiscalYear || '-' || row_number() OVER (PARTITION BY h.FiscalYear
           ORDER BY h.BudgetHeaderID, p.FiscalPeriodID) AS JournalNumber,
       'ELIMINATION' AS JournalType, h.BudgetHeaderID, p.FiscalPeriodID, p.PeriodEndDate AS PostingDate,
       'Consolidation adjustments for ' || p.PeriodName AS Description, 'DRAFT' AS StatusCode, FALSE AS IsBalanced
FROM BudgetHeader h JOIN FiscalPeriod p ON p.FiscalYear = h.FiscalYear
WHERE p.FiscalMonth IN (1, 3, 6, 9, 12)""", "BudgetHeader", "FiscalPeriod")

cte("journal_cells", _cells(
    """SELECT JournalID, (SELECT count(*) FROM postable_accounts) AS accounts,
              (SELECT count(*) FROM active_centers) AS centers FROM ConsolidationJournal""",
    "JournalID", "CAST(accounts AS HUGEINT) * centers", 100, 12),
    "ConsolidationJournal", "postable_accounts", "active_centers")


def _journal_amount(salt: int) -> str:
    return _cents(f"{_scramble(salt, 'JournalID', 'GLAccountID', 'CostCenterID')} % 1000001 + 100000")


ORACLES["journal_lines_numbered"] = sql(f"""
SELECT JournalID, CAST(row_number() OVER (PARTITION BY JournalID ORDER BY GLAccountID, CostCenterID) AS INTEGER)
           AS LineNumber,
       GLAccountID, CostCenterID,
       CASE WHEN NormalBalance = 'D' THEN {_journal_amount(4)} ELSE 0 END AS DebitAmount,
       CASE WHEN NormalBalance = 'C' THEN {_journal_amount(5)} ELSE 0 END AS CreditAmount,
       CASE WHEN NormalBalance = 'D' THEN {_journal_amount(6)} ELSE -{_journal_amount(6)} END AS NetAmount,
       'Consolidation: ' || AccountName || ' - ' || CostCenterName AS Description
FROM journal_cells g JOIN postable_accounts u ON u.a = g.cell % accounts
JOIN active_centers c ON c.c = g.cell // accounts""", "journal_cells", "postable_accounts", "active_centers")

# --- parity -----------------------------------------------------------------

_AGGREGATES = {"numeric": "count sum min max", "text": "count min max", "date": "count min max"}
#: The drifted copies, as in the Spark query.
_DRIFT = {
    "FiscalPeriod": "SELECT * FROM FiscalPeriod WHERE FiscalPeriodID <> 199606",
    "GLAccount": "SELECT * REPLACE (AccountName || '   ' AS AccountName) FROM GLAccount",
    "CostCenter": "SELECT * REPLACE (left(CostCenterName, 8) AS CostCenterName) FROM CostCenter",
    "BudgetHeader": """SELECT * REPLACE (CASE WHEN FiscalYear = 1996 THEN 'APPROVED' ELSE StatusCode END AS StatusCode)
        FROM BudgetHeader""",
    "BudgetLineItem": """SELECT * REPLACE (CASE WHEN GLAccountID = 7 THEN CAST(round(OriginalAmount, 0) AS DECIMAL(19,4))
        ELSE OriginalAmount END AS OriginalAmount) FROM BudgetLineItem""",
}


def _plain(value: str) -> str:
    return f"rtrim(rtrim(CAST({value} AS VARCHAR), '0'), '.')"


def _metrics(side: dict[str, str]) -> str:
    selects = []
    for entry in PLANNING_SPEC["tables"]:
        table = entry["name"]
        source = f"({side[table]})" if table in side else table

        def one(metric: str, value: str, numeric: bool) -> str:
            number = f"CAST({value} AS DECIMAL(38,10))"
            text = f"rtrim(CAST({value} AS VARCHAR))"
            return (f"SELECT '{table}' AS \"table\", '{metric}' AS metric, "
                    + (f"{number} AS number, {_plain(number)} AS text" if numeric
                       else f"CAST(NULL AS DECIMAL(38,10)) AS number, {text} AS text") + f" FROM {source}")

        selects.append(one("row_count", "count(*)", True))
        for column in entry["columns"]:
            column = {"name": column} if isinstance(column, str) else column
            name, kind, scale = column["name"], column.get("kind", "text"), column.get("scale", 4)
            for how in _AGGREGATES[kind].split():
                value = (f"CAST(sum(CAST({name} AS DECIMAL(38,{scale}))) AS DECIMAL(38,{scale}))"
                         if how == "sum" else f"{how}({name})")
                selects.append(one(f"{name}__{how}".lower(), value, kind == "numeric" or how == "count"))
    return "\nUNION ALL ".join(selects)


cte("source_metrics", _metrics({}), *_CORE)
cte("target_metrics", _metrics(_DRIFT), *_CORE)
ORACLES["parity_metrics"] = sql("SELECT * FROM source_metrics", "source_metrics")
cte("compared", f"""
    SELECT "table", metric, coalesce(s.text, 'NULL') AS source, coalesce(t.text, 'NULL') AS target,
           CASE WHEN s.number IS NOT NULL AND t.number IS NOT NULL THEN abs(s.number - t.number) > 0.0001
                ELSE coalesce(s.text, 'NULL') <> coalesce(t.text, 'NULL') END AS differs,
           CASE WHEN s.number IS NOT NULL AND t.number IS NOT NULL AND abs(s.number - t.number) > 0.0001
                THEN {_plain("abs(s.number - t.number)")} ELSE '' END AS delta
    FROM source_metrics s FULL JOIN target_metrics t USING ("table", metric)""", "source_metrics", "target_metrics")
ORACLES["parity_diff"] = sql(
    'SELECT "table", metric, source, target, delta FROM compared WHERE differs', "compared")
ORACLES["parity_report"] = sql("""
SELECT "table", CAST(max(CASE WHEN metric = 'row_count' THEN source END) AS BIGINT) AS source_rows,
       CAST(max(CASE WHEN metric = 'row_count' THEN target END) AS BIGINT) AS target_rows,
       count(*) AS metrics_compared, count(*) FILTER (differs) AS mismatches, '' AS error,
       count(*) FILTER (differs) = 0 AS matched
FROM compared GROUP BY "table" """, "compared")

#: Further changes that only a comparison by row shows.
_SWAPPED = _DRIFT | {
    "GLAccount": """SELECT * REPLACE (CAST(GLAccountID + CASE GLAccountID % 50 WHEN 10 THEN 1 WHEN 11 THEN -1 ELSE 0 END
        AS VARCHAR) AS AccountNumber) FROM GLAccount""",
    "ConsolidationJournalLine": """SELECT * REPLACE (CASE WHEN CostCenterID % 2 = 0 AND NetAmount > 50000 THEN -NetAmount
        ELSE NetAmount END AS NetAmount) FROM ConsolidationJournalLine""",
}


def _row_differences() -> str:
    selects = []
    for entry in PLANNING_SPEC["tables"]:
        table, key = entry["name"], entry["key"]
        target = f"({_SWAPPED[table]})" if table in _SWAPPED else table
        columns = []
        for column in entry["columns"]:
            column = {"name": column} if isinstance(column, str) else column
            name, kind, scale = column["name"], column.get("kind", "text"), column.get("scale", 4)
            if kind != "numeric":
                value = f"rtrim(CAST({{}}.{name} AS VARCHAR))"
            elif scale:
                value = _plain(f"CAST({{}}.{name} AS DECIMAL(38,{scale}))")
            else:
                value = f"CAST(CAST({{}}.{name} AS DECIMAL(38,0)) AS VARCHAR)"
            columns.append(f"{{{{'c': '{name}', 's': coalesce({value}, 'NULL'), 't': coalesce({value}, 'NULL')}}}}"
                           .replace("{{", "{").replace("}}", "}").replace("{}", "s", 1).replace("{}", "t", 1))
        selects.append(f"""SELECT '{table}' AS "table", CAST(coalesce(s.{key}, t.{key}) AS VARCHAR) AS key,
            unnest(CASE WHEN s.{key} IS NULL THEN [{{'c': '(rows)', 's': '0', 't': '1'}}]
                        WHEN t.{key} IS NULL THEN [{{'c': '(rows)', 's': '1', 't': '0'}}]
                        ELSE [{", ".join(columns)}] END) AS d
        FROM {table} s FULL JOIN {target} t ON s.{key} = t.{key}""")
    union = "\nUNION ALL ".join(selects)
    return f'SELECT "table", key, d.c AS "column", d.s AS source, d.t AS target FROM ({union}) WHERE d.s <> d.t'


ORACLES["parity_rows"] = sql(_row_differences(), *_CORE)

# --- audits -----------------------------------------------------------------

cte("NumberedLine", """
    SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY JournalID ORDER BY JournalLineID) AS INTEGER) AS LineNumber)
    FROM ConsolidationJournalLine""", "ConsolidationJournalLine")
_AUDITED = {t: t for t in (*_CORE, "AllocationResultStaging")} | {"GLAccount": "DirtyAccount"}


def _key(columns) -> str:
    return "concat_ws('/', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + ")"


def _audit_unique() -> str:
    source = _AUDITED | {"ConsolidationJournalLine": "NumberedLine"}
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{name}' AS constraint_name, {_key(columns)} AS key, count(*) AS copies
        FROM {source[t]} GROUP BY {", ".join(columns)} HAVING count(*) > 1"""
        for t in _AUDITED
        for name, columns in {f"PK_{t}": TABLES[t].primary_key, **TABLES[t].unique}.items())


def _audit_foreign_keys() -> str:
    source = _AUDITED | {"CostCenter": "(SELECT * FROM CostCenter WHERE IsActive)"}
    given = {  # references that the derived tables fill
        "GLAccount": (), "AllocationRule": ("SourceCostCenterID",), "CostCenter": ("ParentCostCenterID",),
        "BudgetHeader": ("StartPeriodID", "EndPeriodID"),
        "BudgetLineItem": _CELL, "ConsolidationJournal": ("BudgetHeaderID", "FiscalPeriodID"),
        "ConsolidationJournalLine": ("JournalID", "GLAccountID", "CostCenterID"),
    }
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{fk.name}' AS constraint_name, CAST({fk.column} AS VARCHAR) AS key,
        count(*) AS orphan_rows FROM {source[t]} c WHERE {fk.column} IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM {source[fk.parent]} p WHERE p.{fk.parent_key} = c.{fk.column}) GROUP BY {fk.column}"""
        for t, columns in given.items() for fk in TABLES[t].foreign_keys if fk.column in columns)


def _audit_checks() -> str:
    source = _AUDITED | {"ConsolidationJournalLine":
                         "(SELECT * REPLACE (NetAmount AS DebitAmount) FROM ConsolidationJournalLine)"}
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{name}' AS constraint_name, {_key(TABLES[t].primary_key)} AS row_key
        FROM {source[t]} WHERE NOT ({condition})"""
        for t in _AUDITED for name, condition in TABLES[t].checks.items())


def _audit_not_null() -> str:
    source = _AUDITED | {"BudgetLineItem": """(SELECT * REPLACE
        (CASE WHEN LocalCurrencyAmount IS NULL THEN FinalAmount END AS FinalAmount) FROM BudgetLineItem)"""}
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
        count(*) FILTER ({c} IS NULL) AS null_count FROM {source[t]}"""
        for t in _AUDITED for c in TABLES[t].required)


ORACLES["audit_unique"] = sql(
    _audit_unique(), *_CORE, "DirtyAccount", "AllocationResultStaging", "NumberedLine")
ORACLES["audit_foreign_keys"] = sql(
    _audit_foreign_keys(), *_CORE, "DirtyAccount", "AllocationResultStaging")
ORACLES["audit_checks"] = sql(_audit_checks(), *_CORE, "DirtyAccount", "AllocationResultStaging")
ORACLES["audit_not_null"] = sql(_audit_not_null(), *_CORE, "DirtyAccount", "AllocationResultStaging")
ORACLES["audit_invariants"] = sql("""
SELECT 'BudgetLineItem' AS table_name, 'final = original + adjusted' AS invariant,
       CAST(BudgetLineItemID AS VARCHAR) AS row_key
FROM BudgetLineItem WHERE round(FinalAmount, 1) <> OriginalAmount + AdjustedAmount
UNION ALL
SELECT 'ConsolidationJournal', unnest(list_filter([
           CASE WHEN debits = credits THEN 'balanced = debits equal credits' END,
           CASE WHEN debits <> 0 THEN 'total debits = sum of lines' END,
           CASE WHEN credits <> 0 THEN 'total credits = sum of lines' END], lambda x: x IS NOT NULL)),
       CAST(JournalID AS VARCHAR)
FROM (SELECT j.JournalID, coalesce(sum(DebitAmount), 0) AS debits, coalesce(sum(CreditAmount), 0) AS credits
      FROM ConsolidationJournal j LEFT JOIN ConsolidationJournalLine l ON l.JournalID = j.JournalID
      GROUP BY j.JournalID)""", "BudgetLineItem", "ConsolidationJournal", "ConsolidationJournalLine")

_SELF = [(t, fk, RINGS[t]) for t in RINGS for fk in TABLES[t].foreign_keys if fk.column == RINGS[t][0]]
cte("rings", "\nUNION ALL ".join(
    f"SELECT '{t}' AS t, '{fk.name}' AS c, {fk.parent_key} AS id, {ring[1]} AS parent FROM {t}" for t, fk, ring in _SELF),
    *RINGS)
cte("reached", """
    SELECT t, c, id AS start, parent AS node FROM rings WHERE parent IS NOT NULL
    UNION SELECT r.t, r.c, start, parent FROM reached r JOIN rings g ON g.t = r.t AND g.c = r.c AND g.id = node
    WHERE parent IS NOT NULL""", "rings")
cte("on_ring", "SELECT t, c, start AS id FROM reached WHERE start = node", "reached")
cte("ring_of", """
    SELECT r.t, r.c, start, min(node) AS ring FROM reached r JOIN on_ring o ON o.t = r.t AND o.c = r.c AND o.id = node
    GROUP BY r.t, r.c, start""", "on_ring", "reached")
ORACLES["audit_cycles"] = sql("""
SELECT g.t AS table_name, g.c AS constraint_name, CAST(ring AS VARCHAR) AS cycle, count(o.id) AS length,
       count(*) - count(o.id) AS hanging
FROM ring_of g LEFT JOIN on_ring o ON o.t = g.t AND o.c = g.c AND o.id = start GROUP BY g.t, g.c, ring""", "ring_of", "on_ring")

# --- corpus -----------------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DRESSED = """CASE o_custkey % 4 WHEN 1 THEN '/* ' || statement || chr(10) || '*/'
    WHEN 2 THEN statement || ' -- noqa' WHEN 3 THEN statement || ' -- noqa: ' || code ELSE statement END"""
cte("statements", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {_quoted(c)}, {_quoted(s)})" for i, (c, s) in enumerate(STATEMENTS)) + ") v(n, code, statement)")
cte("corpus", f"""
    SELECT 'q/' || o_orderkey || '.sql' AS path,
           '-- order ' || o_orderkey || ': ISNULL(), LEN() were replaced' || chr(10) || {_DRESSED} || chr(10)
           || '  SELECT [status], LEN(''' || o_orderpriority || ''') FROM sales;' || chr(10) AS text
    FROM orders JOIN statements ON n = o_orderkey % {len(STATEMENTS)}
    UNION ALL
    SELECT 'd/' || doc_id || '.sql', statement || chr(10) || coalesce(text, '') || chr(10) || statement || chr(10)
    FROM documents JOIN statements ON n = doc_id % {len(STATEMENTS)}""", "statements")
cte("scripts", f"""
    SELECT 's/' || o_orderpriority || '.sql' AS path,
           string_agg('-- order ' || o_orderkey || chr(10) || CASE WHEN o_custkey % 7 = 0 THEN '*/ ' ELSE '' END || statement
                      || CASE WHEN o_custkey % 11 = 0 THEN ' /* later' ELSE '' END || chr(10), '' ORDER BY o_orderkey) AS text
    FROM orders JOIN statements ON n = o_orderkey % {len(STATEMENTS)} GROUP BY o_orderpriority""", "statements")


def _prefixed(pattern: str) -> str:
    """The pattern behind the shortest text before its first match; no lookaround."""
    if pattern.startswith("(?:^|(?<="):
        return r"^(|.*?[\s(,=+|])N'[^']*'"
    return f"^(.*?)(?:{pattern.replace('(?!_)', '')})"


def _found(marked: str) -> str:
    return "\nUNION ALL ".join(
    f"""SELECT path, line, len(regexp_extract(scan, {_quoted("(?i)" + _prefixed(r.pattern))}, 1)) + 1 AS "column",
    {_quoted(r.code)} AS code, {_quoted(r.severity)} AS severity, {_quoted(r.message)} AS message,
    {_quoted(r.remedy)} AS remedy, left(trim(raw), 120) AS snippet
    FROM {marked} WHERE regexp_matches(scan, {_quoted("(?i)" + _prefixed(r.pattern))})
    AND NOT (marked AND (len(codes) = 0 OR list_contains(codes, {_quoted(r.code)})))""" for r in RULES)


for _texts in ("corpus", "scripts"):
    cte(f"{_texts}_lines", rf"""
        SELECT path, unnest(range(1, len(scans) + 1)) AS line, unnest(scans) AS scan, unnest(raws) AS raw
        FROM (SELECT path, string_split(text, chr(10)) AS raws, string_split(array_to_string(list_transform(
                  regexp_extract_all(text, '(--[^\n]*|/\*[\s\S]*?(?:\*/|\z)|[^-/]+|[-/])', 1),
                  lambda t: CASE WHEN t[1:2] IN ('--', '/*') THEN regexp_replace(t, '[^\n]', ' ', 'g') ELSE t END), ''),
                  chr(10)) AS scans FROM {_texts})""", _texts)
    cte(f"{_texts}_marked", rf"""
        SELECT *, regexp_matches(raw, '(?i)--\s*noqa\b') AS marked,
               list_filter(list_transform(string_split(regexp_extract(raw, '(?i)--\s*noqa\b(?::\s*([\w\s,]+))?', 1), ','),
                                          lambda c: upper(trim(c))), lambda c: c <> '') AS codes
        FROM {_texts}_lines WHERE trim(scan) <> ''""", f"{_texts}_lines")
    cte(f"{_texts}_findings", _found(f"{_texts}_marked"), f"{_texts}_marked")
ORACLES["sql_corpus_findings"] = sql("""SELECT * REPLACE (CAST(line AS INTEGER) AS line,
    CAST("column" AS INTEGER) AS "column") FROM corpus_findings""", "corpus_findings")
ORACLES["sql_script_findings"] = sql("""SELECT * REPLACE (CAST(line AS INTEGER) AS line,
    CAST("column" AS INTEGER) AS "column") FROM scripts_findings""", "scripts_findings")
ORACLES["sql_corpus_tally"] = sql("""
SELECT error, warning, info, files,
       error || ' error, ' || warning || ' warning, ' || info || ' info across ' || files || ' file(s).'
           AS summary
FROM (SELECT count(*) FILTER (severity = 'error') AS error, count(*) FILTER (severity = 'warning') AS warning,
             count(*) FILTER (severity = 'info') AS info, count(DISTINCT path) AS files
      FROM corpus_findings)""", "corpus_findings")

# --- stored ledger: published changes give the same rows -----------------------

ORACLES["close_lines_stored"] = ORACLES["close_lines"]
ORACLES["import_apply_stored"] = ORACLES["import_apply"]
