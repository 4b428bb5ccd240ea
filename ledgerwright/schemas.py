"""Planning tables: columns, defaults, declared constraints and layout keys.

Storage enforces none of the constraints; ``operators.audit`` turns them into
queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
TEXT = T.StringType()
BOOL = T.BooleanType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()
MONEY = T.DecimalType(19, 4)
QUANTITY = T.DecimalType(18, 6)
RATE = T.DecimalType(18, 10)
SHARE = T.DecimalType(8, 6)
WEIGHT = T.DecimalType(5, 4)
#: Sums of MONEY are widened to this, so both sides of a comparison agree.
TOTAL = T.DecimalType(38, 4)
#: Ids of ledger and journal lines: built from their keys, wider than 63 bits.
LINE_ID = T.DecimalType(38, 0)

NOW = object()  # default: the load time
UUID = object()  # default: a fresh identifier per row


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = True
    default: object = None


@dataclass(frozen=True)
class ForeignKey:
    name: str
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, not c.required) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]


def _need(name, type_, default=None):
    return Col(name, type_, True, default)


def _may(name, type_):
    return Col(name, type_, False)


def _stamps(*names):
    return tuple(_need(n, STAMP, NOW) for n in names)


FISCAL_PERIOD = Table(
    "FiscalPeriod",
    (
        _need("FiscalPeriodID", LONG),
        _need("FiscalYear", INT),
        _need("FiscalQuarter", INT),
        _need("FiscalMonth", INT),
        _need("PeriodName", TEXT),
        _need("PeriodStartDate", DATE),
        _need("PeriodEndDate", DATE),
        _need("IsClosed", BOOL, False),
        _may("ClosedByUserID", LONG),
        _may("ClosedDateTime", STAMP),
        _need("IsAdjustmentPeriod", BOOL, False),
        _may("WorkingDays", INT),
        *_stamps("CreatedDateTime", "ModifiedDateTime", "RowVersionTimestamp"),
    ),
    primary_key=("FiscalPeriodID",),
    unique={"UQ_FiscalPeriod_YearMonth": ("FiscalYear", "FiscalMonth")},
    checks={
        "CK_FiscalPeriod_Quarter": "FiscalQuarter BETWEEN 1 AND 4",
        "CK_FiscalPeriod_Month": "FiscalMonth BETWEEN 1 AND 13",
        "CK_FiscalPeriod_DateRange": "PeriodEndDate >= PeriodStartDate",
    },
    cluster_by=("FiscalYear", "FiscalMonth"),
)

GL_ACCOUNT = Table(
    "GLAccount",
    (
        _need("GLAccountID", LONG),
        _need("AccountNumber", TEXT),
        _need("AccountName", TEXT),
        _need("AccountType", TEXT),
        _may("AccountSubType", TEXT),
        _may("ParentAccountID", LONG),
        _need("AccountLevel", INT, 1),
        _need("IsPostable", BOOL, True),
        _need("IsBudgetable", BOOL, True),
        _need("IsStatistical", BOOL, False),
        _need("NormalBalance", TEXT, "D"),
        _need("CurrencyCode", TEXT, "USD"),
        _may("ConsolidationAccountID", LONG),
        _need("IntercompanyFlag", BOOL, False),
        _need("IsActive", BOOL, True),
        *_stamps("CreatedDateTime", "ModifiedDateTime"),
        _may("TaxCode", TEXT),
        _may("StatutoryAccountCode", TEXT),
        _may("IFRSAccountCode", TEXT),
    ),
    primary_key=("GLAccountID",),
    unique={"UQ_GLAccount_Number": ("AccountNumber",)},
    foreign_keys=(ForeignKey("FK_GLAccount_Parent", "ParentAccountID", "GLAccount", "GLAccountID"),),
    checks={
        "CK_GLAccount_Type": "AccountType IN ('A', 'L', 'E', 'R', 'X')",
        "CK_GLAccount_Balance": "NormalBalance IN ('D', 'C')",
    },
    cluster_by=("AccountType", "IsActive"),
)

_COST_CENTER_BODY = (
    _need("CostCenterID", LONG),
    _need("CostCenterCode", TEXT),
    _need("CostCenterName", TEXT),
    _may("ParentCostCenterID", LONG),
    _may("HierarchyLevel", INT),
    _may("ManagerEmployeeID", LONG),
    _may("DepartmentCode", TEXT),
    _need("IsActive", BOOL, True),
    _need("EffectiveFromDate", DATE),
    _may("EffectiveToDate", DATE),
    _need("AllocationWeight", WEIGHT, 1),
    _need("ValidFrom", STAMP, NOW),
)

COST_CENTER = Table(
    "CostCenter",
    (*_COST_CENTER_BODY, _may("ValidTo", STAMP)),
    primary_key=("CostCenterID",),
    unique={"UQ_CostCenter_Code": ("CostCenterCode",)},
    foreign_keys=(ForeignKey("FK_CostCenter_Parent", "ParentCostCenterID", "CostCenter", "CostCenterID"),),
    checks={"CK_CostCenter_Weight": "AllocationWeight BETWEEN 0 AND 1"},
    cluster_by=("IsActive", "EffectiveFromDate"),
)

COST_CENTER_HISTORY = Table(
    "CostCenterHistory",
    (*_COST_CENTER_BODY, _need("ValidTo", STAMP), _need("ChangeDateTime", STAMP, NOW)),
)

ALLOCATION_RULE = Table(
    "AllocationRule",
    (
        _need("AllocationRuleID", LONG),
        _need("RuleCode", TEXT),
        _need("RuleName", TEXT),
        _may("RuleDescription", TEXT),
        _need("RuleType", TEXT),
        _need("AllocationMethod", TEXT),
        _may("SourceCostCenterID", LONG),
        _may("SourceCostCenterPattern", TEXT),
        _may("SourceAccountPattern", TEXT),
        _need("TargetSpecification", TEXT),  # JSON text on disk
        _may("AllocationBasis", TEXT),
        _may("AllocationPercentage", SHARE),
        _need("RoundingMethod", TEXT, "NEAREST"),
        _need("RoundingPrecision", INT, 2),
        _may("MinimumAmount", MONEY),
        _need("ExecutionSequence", INT, 100),
        _may("DependsOnRuleID", LONG),
        _need("EffectiveFromDate", DATE),
        _may("EffectiveToDate", DATE),
        _need("IsActive", BOOL, True),
        _may("CreatedByUserID", LONG),
        _need("CreatedDateTime", STAMP, NOW),
        _may("ModifiedByUserID", LONG),
        _need("ModifiedDateTime", STAMP, NOW),
    ),
    primary_key=("AllocationRuleID",),
    unique={"UQ_AllocationRule_Code": ("RuleCode",)},
    foreign_keys=(
        ForeignKey("FK_AllocationRule_SourceCC", "SourceCostCenterID", "CostCenter", "CostCenterID"),
        ForeignKey("FK_AllocationRule_DependsOn", "DependsOnRuleID", "AllocationRule", "AllocationRuleID"),
    ),
    checks={
        "CK_AllocationRule_Type": "RuleType IN ('DIRECT', 'STEP_DOWN', 'RECIPROCAL', 'ACTIVITY_BASED')",
        "CK_AllocationRule_Rounding": "RoundingMethod IN ('NEAREST', 'UP', 'DOWN', 'NONE')",
    },
)

BUDGET_HEADER = Table(
    "BudgetHeader",
    (
        _need("BudgetHeaderID", LONG),
        _need("BudgetCode", TEXT),
        _need("BudgetName", TEXT),
        _need("BudgetType", TEXT),
        _need("ScenarioType", TEXT),
        _need("FiscalYear", INT),
        _need("StartPeriodID", LONG),
        _need("EndPeriodID", LONG),
        _may("BaseBudgetHeaderID", LONG),
        _need("StatusCode", TEXT, "DRAFT"),
        _may("SubmittedByUserID", LONG),
        _may("SubmittedDateTime", STAMP),
        _may("ApprovedByUserID", LONG),
        _may("ApprovedDateTime", STAMP),
        _may("LockedDateTime", STAMP),
        _need("IsLocked", BOOL, False),
        _need("VersionNumber", INT, 1),
        _may("Notes", TEXT),
        _may("ExtendedProperties", TEXT),  # JSON text on disk
        *_stamps("CreatedDateTime", "ModifiedDateTime"),
    ),
    primary_key=("BudgetHeaderID",),
    unique={"UQ_BudgetHeader_Code_Year": ("BudgetCode", "FiscalYear", "VersionNumber")},
    foreign_keys=(
        ForeignKey("FK_BudgetHeader_StartPeriod", "StartPeriodID", "FiscalPeriod", "FiscalPeriodID"),
        ForeignKey("FK_BudgetHeader_EndPeriod", "EndPeriodID", "FiscalPeriod", "FiscalPeriodID"),
        ForeignKey("FK_BudgetHeader_BaseBudget", "BaseBudgetHeaderID", "BudgetHeader", "BudgetHeaderID"),
    ),
    checks={
        "CK_BudgetHeader_Status": (
            "StatusCode IN ('DRAFT', 'SUBMITTED', 'APPROVED', 'REJECTED', 'LOCKED', 'ARCHIVED')"
        ),
    },
)

NATURAL_KEY = ("BudgetHeaderID", "GLAccountID", "CostCenterID", "FiscalPeriodID")

BUDGET_LINE_ITEM = Table(
    "BudgetLineItem",
    (
        _need("BudgetLineItemID", LINE_ID),
        _need("BudgetHeaderID", LONG),
        _need("GLAccountID", LONG),
        _need("CostCenterID", LONG),
        _need("FiscalPeriodID", LONG),
        _need("OriginalAmount", MONEY, 0),
        _need("AdjustedAmount", MONEY, 0),
        _need("FinalAmount", MONEY, 0),
        _may("LocalCurrencyAmount", MONEY),
        _may("ReportingCurrencyAmount", MONEY),
        _may("StatisticalQuantity", QUANTITY),
        _may("UnitOfMeasure", TEXT),
        _may("SpreadMethodCode", TEXT),
        _may("SeasonalityFactor", SHARE),
        _may("SourceSystem", TEXT),
        _may("SourceReference", TEXT),
        _may("ImportBatchID", TEXT),
        _need("IsAllocated", BOOL, False),
        _may("AllocationSourceLineID", LINE_ID),
        _may("AllocationPercentage", SHARE),
        _may("LastModifiedByUserID", LONG),
        _need("LastModifiedDateTime", STAMP, NOW),
        _may("RowHash", TEXT),
    ),
    primary_key=("BudgetLineItemID",),
    unique={"idx_BudgetLineItem_NaturalKey": NATURAL_KEY},
    foreign_keys=(
        ForeignKey("FK_BudgetLineItem_Header", "BudgetHeaderID", "BudgetHeader", "BudgetHeaderID"),
        ForeignKey("FK_BudgetLineItem_Account", "GLAccountID", "GLAccount", "GLAccountID"),
        ForeignKey("FK_BudgetLineItem_CostCenter", "CostCenterID", "CostCenter", "CostCenterID"),
        ForeignKey("FK_BudgetLineItem_Period", "FiscalPeriodID", "FiscalPeriod", "FiscalPeriodID"),
        ForeignKey(
            "FK_BudgetLineItem_AllocationSource", "AllocationSourceLineID", "BudgetLineItem", "BudgetLineItemID"
        ),
    ),
    cluster_by=("BudgetHeaderID", "FiscalPeriodID"),
)

CONSOLIDATION_JOURNAL = Table(
    "ConsolidationJournal",
    (
        _need("JournalID", LONG),
        _need("JournalNumber", TEXT),
        _need("JournalType", TEXT),
        _need("BudgetHeaderID", LONG),
        _need("FiscalPeriodID", LONG),
        _need("PostingDate", DATE),
        _may("Description", TEXT),
        _need("StatusCode", TEXT, "DRAFT"),
        _may("SourceEntityCode", TEXT),
        _may("TargetEntityCode", TEXT),
        _need("IsAutoReverse", BOOL, False),
        _may("ReversalPeriodID", LONG),
        _may("ReversedFromJournalID", LONG),
        _need("IsReversed", BOOL, False),
        _need("TotalDebits", MONEY, 0),
        _need("TotalCredits", MONEY, 0),
        _need("IsBalanced", BOOL, False),
        _may("PreparedByUserID", LONG),
        _may("PreparedDateTime", STAMP),
        _may("ReviewedByUserID", LONG),
        _may("ReviewedDateTime", STAMP),
        _may("ApprovedByUserID", LONG),
        _may("ApprovedDateTime", STAMP),
        _may("PostedByUserID", LONG),
        _may("PostedDateTime", STAMP),
        _may("AttachmentReference", TEXT),
        _need("AttachmentRowGuid", TEXT, UUID),
    ),
    primary_key=("JournalID",),
    unique={"UQ_ConsolidationJournal_Number": ("JournalNumber",)},
    foreign_keys=(
        ForeignKey("FK_ConsolidationJournal_Header", "BudgetHeaderID", "BudgetHeader", "BudgetHeaderID"),
        ForeignKey("FK_ConsolidationJournal_Period", "FiscalPeriodID", "FiscalPeriod", "FiscalPeriodID"),
        ForeignKey("FK_ConsolidationJournal_ReversalPeriod", "ReversalPeriodID", "FiscalPeriod", "FiscalPeriodID"),
        ForeignKey(
            "FK_ConsolidationJournal_ReversedFrom", "ReversedFromJournalID", "ConsolidationJournal", "JournalID"
        ),
    ),
)

CONSOLIDATION_JOURNAL_LINE = Table(
    "ConsolidationJournalLine",
    (
        _need("JournalLineID", LINE_ID),
        _need("JournalID", LONG),
        _need("LineNumber", INT),
        _need("GLAccountID", LONG),
        _need("CostCenterID", LONG),
        _need("DebitAmount", MONEY, 0),
        _need("CreditAmount", MONEY, 0),
        _need("NetAmount", MONEY, 0),
        _need("LocalCurrencyCode", TEXT, "USD"),
        _may("LocalCurrencyAmount", MONEY),
        _may("ExchangeRate", RATE),
        _may("Description", TEXT),
        _may("ReferenceNumber", TEXT),
        _may("PartnerEntityCode", TEXT),
        _may("PartnerAccountID", LONG),
        _may("StatisticalQuantity", QUANTITY),
        _may("StatisticalUOM", TEXT),
        _may("AllocationRuleID", LONG),
        _need("CreatedDateTime", STAMP, NOW),
    ),
    primary_key=("JournalLineID",),
    unique={"UQ_ConsolidationJournalLine_JournalLine": ("JournalID", "LineNumber")},
    foreign_keys=(
        ForeignKey("FK_ConsolidationJournalLine_Journal", "JournalID", "ConsolidationJournal", "JournalID"),
        ForeignKey("FK_ConsolidationJournalLine_Account", "GLAccountID", "GLAccount", "GLAccountID"),
        ForeignKey("FK_ConsolidationJournalLine_CostCenter", "CostCenterID", "CostCenter", "CostCenterID"),
        ForeignKey(
            "FK_ConsolidationJournalLine_AllocationRule", "AllocationRuleID", "AllocationRule", "AllocationRuleID"
        ),
    ),
    checks={
        "CK_ConsolidationJournalLine_DebitCredit": (
            "DebitAmount >= 0 AND CreditAmount >= 0 AND NOT (DebitAmount > 0 AND CreditAmount > 0)"
        ),
    },
    cluster_by=("JournalID",),
)

HIERARCHY_NODE_TEMPLATE = Table(
    "HierarchyNodeTemplate",
    (
        _need("NodeID", LONG),
        _may("ParentNodeID", LONG),
        _need("NodeLevel", INT),
        _need("NodePath", TEXT),
        _need("SortOrder", INT),
        _need("IsLeaf", BOOL),
        _need("AggregationWeight", SHARE, 1),
    ),
    primary_key=("NodeID",),
)

ALLOCATION_RESULT_STAGING = Table(
    "AllocationResultStaging",
    (
        _need("AllocationSessionID", TEXT),
        _need("SourceBudgetLineItemID", LONG),
        _need("TargetCostCenterID", LONG),
        _need("TargetGLAccountID", LONG),
        _need("AllocatedAmount", MONEY),
        _need("AllocationPercentage", SHARE),
        _need("AllocationRuleID", LONG),
        _need("ProcessingSequence", INT),
        _need("CreatedDateTime", STAMP, NOW),
    ),
    primary_key=("AllocationSessionID", "SourceBudgetLineItemID", "TargetCostCenterID", "TargetGLAccountID"),
)

BUDGET_LINE_ITEM_STAGING = Table(
    "BudgetLineItemStaging",
    (
        _need("StagingBatchID", TEXT),
        _need("GLAccountID", LONG),
        _need("CostCenterID", LONG),
        _need("FiscalPeriodID", LONG),
        _need("OriginalAmount", MONEY),
        _may("AdjustedAmount", MONEY),
        _may("SpreadMethodCode", TEXT),
        _may("Notes", TEXT),
        _need("LineSequence", INT),
        _need("RowStatus", TEXT, "PENDING"),
        _may("ErrorMessage", TEXT),
        _need("CreatedDateTime", STAMP, NOW),
        _may("LoadedDateTime", STAMP),
    ),
    primary_key=("StagingBatchID", "GLAccountID", "CostCenterID", "FiscalPeriodID"),
)

CORE_TABLES = (
    FISCAL_PERIOD,
    GL_ACCOUNT,
    COST_CENTER,
    ALLOCATION_RULE,
    BUDGET_HEADER,
    BUDGET_LINE_ITEM,
    CONSOLIDATION_JOURNAL,
    CONSOLIDATION_JOURNAL_LINE,
)
STAGING_TABLES = (HIERARCHY_NODE_TEMPLATE, ALLOCATION_RESULT_STAGING, BUDGET_LINE_ITEM_STAGING)
TABLES = {t.name: t for t in (*CORE_TABLES, COST_CENTER_HISTORY, *STAGING_TABLES)}


def _default(column: Col, now: str) -> str:
    if column.default is NOW:
        return f"CAST('{now}' AS TIMESTAMP_NTZ)"
    if column.default is UUID:
        return "uuid()"
    value = "NULL" if column.default is None else repr(column.default)
    return f"CAST({value} AS {column.type.simpleString()})"


def complete(df: DataFrame, table: Table, now: str) -> DataFrame:
    """Fill the columns of ``table`` that ``df`` lacks with their defaults.

    Columns that ``df`` has keep their own type; the result has the table's
    column order. ``now`` is the load time, fixed by the caller so that a
    recomputed task writes the same value.
    """
    have = set(df.columns)
    return df.selectExpr(
        *[c.name if c.name in have else f"{_default(c, now)} AS {c.name}" for c in table.columns]
    )
