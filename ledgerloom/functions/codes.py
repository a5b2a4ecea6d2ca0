"""Number, boolean and code rules (NUM, BOO, MAP) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import WHITESPACE, digits, literal_map, strip

# Visits per week -> frequency label.
FREQUENCY_LABELS = {
    0.25: "once_per_month",
    0.5: "every_15_days",
    1.0: "once_per_week",
    1.5: "once_per_week",
    2.0: "twice_per_week",
    2.5: "twice_per_week",
    3.0: "three_times_per_week",
    4.0: "four_times_per_week",
    5.0: "five_times_per_week",
    6.0: "six_times_per_week",
    7.0: "seven_times_per_week",
    15.0: "every_15_days",
    30.0: "once_per_month",
}

# Frequency label -> the source texts it stands for.
FREQUENCY_TEXTS = {
    "once_per_week": ("1", "1.5"),
    "twice_per_week": ("2", "2.5"),
    "three_times_per_week": ("3",),
    "four_times_per_week": ("4",),
    "five_times_per_week": ("5",),
    "six_times_per_week": ("6",),
    "seven_times_per_week": ("7",),
    "every_15_days": ("15", "0.5"),
    "once_per_month": ("30", "0.25"),
}

# Order status code -> text.
ORDER_STATUS = {
    0: "pending",
    1: "approved",
    2: "rejected",
    3: "cancelled",
    4: "active",
    5: "inactive",
}

# Marital status code -> label; person type -> id type.
MARITAL_STATUS = {1: "Solteiro", 2: "Casado", 3: "Divorciado", 4: "Viúvo"}
PERSON_ID_TYPES = {"F": "CPF", "J": "CNPJ"}

# Words read as true and as false.
TRUE_WORDS = ("true", "1", "sim", "yes")
FALSE_WORDS = ("false", "0", "nao", "não", "no")

# Contract terms that are the same for every contract.
BILLING_TYPE = "current"
OPERATION_TYPE = "shared"
THIRTEENTH_SALARY_TYPE = "monthly"
TRADE_TYPE = "shared"

# Source status codes of a closed and of an inactive scenario.
CLOSED_STATUSES = (0, 11)

MAX_INT = 2147483647
WEEKS_PER_MONTH = 4.0

# Blanks a cast to double does not skip by itself, and what a decimal number is made of.
_OTHER_SPACE = "".join(c for c in WHITESPACE if c > " ")
_NUMBER_CHARACTERS = "0123456789.-+eE" + "".join(c for c in WHITESPACE if c <= " ")


def _parsed(c: Column) -> Column:
    """A cast alone would also take suffixes, hex digits and words, so those are ruled out."""
    return F.when(F.btrim(c, F.lit(_NUMBER_CHARACTERS)) == "", c.try_cast("double"))


def to_number(c: Column) -> Column:
    """Text with a decimal point to double; anything else is null."""
    return _parsed(F.translate(c.cast("string"), _OTHER_SPACE, " " * len(_OTHER_SPACE)))


def to_decimal_comma(c: Column) -> Column:
    """NUM3 / NUM8: as ``to_number`` with a decimal comma allowed."""
    spaces = " " * len(_OTHER_SPACE)
    return _parsed(F.translate(c.cast("string"), "," + _OTHER_SPACE, "." + spaces))


def safe_int(c: Column, default: int | None) -> Column:
    """NUM12: integer text, else the default."""
    return F.coalesce(strip(c.cast("string")).try_cast("int"), F.lit(default).cast("int"))


def hour_rate(price: Column, frequency: Column, hours: Column) -> Column:
    """NUM1: price over the monthly hours, two decimals, 0 when there are no hours.

    ``frequency`` and ``hours`` are numbers. The quotient is fixed to ten decimals and rounded
    half to even.
    """
    monthly = (
        F.coalesce(frequency, F.lit(0.0)) * F.coalesce(hours, F.lit(0.0)) * F.lit(WEEKS_PER_MONTH)
    )
    quotient = F.try_divide(F.coalesce(price.cast("double"), F.lit(0.0)), monthly)
    rounded = F.bround(quotient.cast("decimal(38,10)"), 2).cast("decimal(18,2)")
    return F.coalesce(rounded, F.lit(0).cast("decimal(18,2)"))


def rate_key(rate: Column) -> Column:
    """NUM2: the rate as a key with two decimals; missing is 0.00."""
    return F.coalesce(rate.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


def frequency_label(number: Column) -> Column:
    """NUM4: label of the exact number, else of the number rounded half to even, else ''."""
    labels = literal_map(FREQUENCY_LABELS)
    exact, rounded = number.cast("string"), F.bround(number).cast("string")
    return F.coalesce(labels[exact], labels[rounded], F.lit(""))


def frequency_key(c: Column, number: Column) -> Column:
    """NUM5: integers without decimals, other numbers as they are, other text unchanged."""
    whole = F.when(number == F.floor(number), number.cast("bigint").cast("string"))
    return F.coalesce(whole, number.cast("string"), c.cast("string"), F.lit(""))


def hours_key(c: Column, number: Column) -> Column:
    """Hours as key text: a double, 0.0 when missing, '' when the text is no number."""
    return F.when(c.isNull(), "0.0").otherwise(F.coalesce(number.cast("string"), F.lit("")))


def frequency_texts(label: Column) -> Column:
    """NUM6: the texts a label stands for; an unknown label stands for itself."""
    table = literal_map({name: ",".join(texts) for name, texts in FREQUENCY_TEXTS.items()})
    return F.split(F.coalesce(table[label], label), ",")


def expected_amount(hours: Column, rate: Column) -> Column:
    """NUM7."""
    return F.coalesce(hours * rate.cast("double"), F.lit(0.0))


def place_code(c: Column) -> Column:
    """NUM9: first ten digits as a number; none is null."""
    return F.substring(digits(c.cast("string")), 1, 10).try_cast("bigint")


def place_code_text(code: Column) -> Column:
    """NUM10: a positive code as text of at most ten characters."""
    return F.when(code > 0, F.substring(code.cast("string"), 1, 10))


def registration_number(c: Column) -> Column:
    """NUM11: digits that fit a 32-bit integer and are not all zeros."""
    d = F.nullif(F.regexp_extract(digits(c), "^[0-9]{1,10}$", 0), F.lit("")).try_cast("bigint")
    return F.when((d > 0) & (d <= MAX_INT), d).cast("int")


def safe_bool(c: Column, default: bool | None = True) -> Column:
    """BOO1: lenient boolean."""
    s = F.lower(strip(c.cast("string")))
    return (
        F.when(s.isin(*TRUE_WORDS), True)
        .when(s.isin(*FALSE_WORDS), False)
        .otherwise(F.lit(default))
    )


def flag(c: Column) -> Column:
    """A nullable flag as a plain boolean."""
    return F.coalesce(c, F.lit(False))


def active_text(c: Column) -> Column:
    """BOO2: only a real true is active."""
    return F.when(c, "active").otherwise("inactive")


def scenario_status(c: Column) -> Column:
    """BOO3: 1, but 0 for closed, inactive and missing source status."""
    return F.when(F.coalesce(c, F.lit(0)).isin(*CLOSED_STATUSES), 0).otherwise(1)


def order_status_text(c: Column) -> Column:
    """MAP1."""
    return F.coalesce(
        literal_map(ORDER_STATUS)[c.cast("string")],
        F.concat(F.lit("status_"), c.cast("string")),
        F.lit("pending"),
    )


def status_number(status: Column, active: Column) -> Column:
    """MAP2: the status, else the flag as a number."""
    return F.coalesce(status.cast("int"), F.when(active, 1).otherwise(0))


def marital_label(c: Column) -> Column:
    """MAP3."""
    return literal_map(MARITAL_STATUS)[c.cast("string")]


def person_id_type(c: Column) -> Column:
    """MAP3."""
    return literal_map(PERSON_ID_TYPES)[c]
