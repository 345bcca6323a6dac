"""Income levels: bands of 20 thousand, open at the top."""

from pyspark.sql import Column, functions as F

BAND_WIDTH = 20
TOP_INCOME = 500
TOP_LEVEL = 25


def has_income(income: Column) -> Column:
    """A parsed income is present; zero counts as present."""
    return income.isNotNull()


def income_level(income: Column) -> Column:
    """0-19 is level 1, 20-39 level 2, ..., 500 and above 25; negatives round down."""
    band = F.floor(income / F.lit(BAND_WIDTH)) + 1
    return F.when(income < TOP_INCOME, band).otherwise(F.lit(TOP_LEVEL)).cast("int")
