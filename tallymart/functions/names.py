"""Vectorised text UDF for names that only Python can make.

Pools of names need no Python: ``columns.pick`` draws from them. ``name_udf`` is for a
caller's own batch function; it moves whole Arrow batches, never single rows.
"""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F


def name_udf(make: Callable[[pd.Series], pd.Series]):
    """Pandas UDF from a whole number column to text, made by ``make`` a batch at a time."""

    @F.pandas_udf("string")
    def names(numbers: pd.Series) -> pd.Series:
        return make(numbers)

    return names


def letter_code(numbers: pd.Series) -> pd.Series:
    """Three capital letters for a number: base 26, the last letter first, repeating past 17,576."""
    rest = numbers.to_numpy()
    letters = [pd.Series([chr(65 + n) for n in (rest // 26 ** k % 26)], index=numbers.index) for k in range(3)]
    return letters[0] + letters[1] + letters[2]
