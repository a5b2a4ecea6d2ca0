"""The contract sheet (SRC3, SRC4, STR18): billing terms and seller logins per contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codes, headers, text
from ledgerloom.operators import match, scope

# Column of the row position that ``read_sheet`` adds; the first row of a contract wins.
ROW_POSITION = "sheet_row"

# Names of the activity column, first match decides.
ACTIVE_COLUMNS = ("orcamento_ativo", "ativo?")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The exported sheet as text cells with clean headers and its row order.

    Cells may hold line breaks, so one task reads the file; a spreadsheet has a bounded row count.
    """
    raw = spark.read.csv(path, header=True, multiLine=True)
    return headers.with_clean_headers(raw).withColumn(
        ROW_POSITION, F.monotonically_increasing_id()
    )


def _require_id_column(sheet: DataFrame) -> str:
    column = headers.contract_id_column(sheet)
    if column is None:
        raise ValueError("the sheet has no contract id column")
    return column


def sheet_terms(sheet: DataFrame) -> DataFrame:
    """SRC3: one row per contract: the first active row with a readable id.

    ``sheet`` has clean headers. Columns are found by name or by a pattern on their name, and a
    column the sheet lacks is null.
    """
    id_column = _require_id_column(sheet)

    def cell(column: str | None):
        return F.col(f"`{column}`") if column else F.lit(None).cast("string")

    def named(name: str):
        return cell(name if name in sheet.columns else None)

    def parameter(name: str):
        return cell(headers.parameter_column(sheet, name))

    order = [ROW_POSITION] if ROW_POSITION in sheet.columns else []
    active = scope.active_rows(sheet, ACTIVE_COLUMNS[0])
    rows = active.select(
        F.col(f"`{id_column}`").cast("string").try_cast("bigint").alias("contract_id"),
        *order,
        named("nome_cliente").alias("sheet_name"),
        codes.safe_int(named("dia_faturamento"), None).alias("sheet_billing_day"),
        codes.safe_int(named("dia_vencimento"), None).alias("sheet_due_day"),
        parameter("contract_parameters_billing_type").alias("sheet_billing_type"),
        parameter("contract_parameters_thirteenth_salary_type").alias("sheet_thirteenth_type"),
        cell(headers.calculation_column(sheet)).alias("sheet_calculation"),
        codes.safe_bool(named(ACTIVE_COLUMNS[0]), True).alias("sheet_active"),
        text.seller_login(cell(headers.login_column(sheet, "farmer"))).alias("farmer_login"),
        text.seller_login(cell(headers.login_column(sheet, "hunter"))).alias("hunter_login"),
    ).filter(F.col("contract_id").isNotNull())
    return match.first_per_key(rows, ["contract_id"], order).drop(ROW_POSITION)


def marked_contracts(sheet: DataFrame, require_active: bool = True) -> DataFrame:
    """SRC4: contracts marked for migration (and active)."""
    id_column = _require_id_column(sheet)
    rows = scope.active_rows(sheet, *ACTIVE_COLUMNS) if require_active else sheet
    return (
        rows.filter(codes.safe_bool(F.col("migrar"), False))
        .select(F.col(f"`{id_column}`").cast("string").try_cast("bigint").alias("contract_id"))
        .filter(F.col("contract_id").isNotNull())
        .distinct()
    )
