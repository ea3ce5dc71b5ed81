"""Exact lower medians of many columns without sorting or collecting them.

A sketch brackets each median, counting passes say on which side of the bracket
ends it lies, and the open interval left over is bracketed again. Each round keeps
a small fraction of the values. Values that fill a large share of the rows become
bracket ends and drop out of the interval, so they cannot stall the search.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import Imputer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gradewise.functions import column, is_missing

SKETCH_ACCURACY = 1000
# An interval this small is sorted whole, one array per column, few columns at a time.
MAX_SORTED_VALUES = 20_000
COLUMNS_AT_ONCE = 8


@dataclass
class _Search:
    """One column's open interval: its bounds, and the median's rank among its values."""

    name: str
    value: Column
    rank: int = 1
    size: int = 2
    low: float | None = None
    high: float | None = None
    median: float | None = None

    def inside(self) -> Column:
        """The column's value where it lies in the open interval, else null."""
        bounds = ~is_missing(self.value)
        if self.low is not None:
            bounds &= self.value > self.low
        if self.high is not None:
            bounds &= self.value < self.high
        return F.when(bounds, self.value)

    def bracket(self) -> Column:
        """Two sketch values that very likely enclose the wanted rank."""
        slack = 2 / SKETCH_ACCURACY
        wanted = self.rank / self.size
        ends = [max(wanted - slack, 0.0), min(wanted + slack, 1.0)]
        return F.percentile_approx(self.inside(), ends, SKETCH_ACCURACY)

    def counts(self, low: float, high: float) -> Column:
        value = self.inside()
        return F.array(
            F.count_if(value < low),
            F.count_if(value == low),
            F.count_if((value > low) & (value < high)),
            F.count_if((value == high) & (value > low)),
        )

    def narrow(self, low: float, high: float, counts: list[int]) -> None:
        """Move to the part of the interval that holds the wanted rank."""
        below, at_low, between, at_high = counts
        if self.rank <= below:
            self.high, self.size = low, below
        elif self.rank <= below + at_low:
            self.median = low
        elif self.rank <= below + at_low + between:
            self.rank -= below + at_low
            self.low, self.high, self.size = low, high, between
        elif self.rank <= below + at_low + between + at_high:
            self.median = high
        else:
            skipped = below + at_low + between + at_high
            self.rank, self.size, self.low = self.rank - skipped, self.size - skipped, high


def exact_medians(
    df: DataFrame, cols: list[str], max_sorted: int = MAX_SORTED_VALUES
) -> dict[str, float | None]:
    """The lower middle value of each column, null and NaN left out; None for an empty one.

    Two passes shrink every interval about 250 times, and one pass finishes: three for
    up to five million rows, five for a billion. Only bracket ends and counts reach the
    driver.
    """
    searches = [_Search(c, column(c).cast("double")) for c in cols]
    # Until it is counted, a column is a search for rank 1 of 2: the same fraction.
    found = _one_row(
        df, [F.struct(F.count(s.inside()).alias("n"), s.bracket().alias("ends")) for s in searches]
    )
    brackets = {}
    for search, first in zip(searches, found):
        search.size, search.rank = first["n"], (first["n"] + 1) // 2
        brackets[search.name] = first["ends"]
    while open_ := [s for s in searches if s.median is None and s.size > max_sorted]:
        unbracketed = [s for s in open_ if s.name not in brackets]
        ends = _one_row(df, [s.bracket() for s in unbracketed])
        brackets.update({s.name: e for s, e in zip(unbracketed, ends)})
        counts = _one_row(df, [s.counts(*brackets[s.name]) for s in open_])
        for search, sizes in zip(open_, counts):
            search.narrow(*brackets.pop(search.name), sizes)
    small = [s for s in searches if s.median is None and s.size]
    for at in range(0, len(small), COLUMNS_AT_ONCE):
        few = small[at : at + COLUMNS_AT_ONCE]
        middles = _one_row(df, [F.sort_array(F.collect_list(s.inside()))[s.rank - 1] for s in few])
        for search, middle in zip(few, middles):
            search.median = middle
    return {s.name: s.median for s in searches}


def _one_row(df: DataFrame, aggregates: list[Column]) -> list:
    if not aggregates:
        return []
    return list(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first())


class ExactMedianImputer(Estimator, HasInputCols, HasOutputCols):
    """Fits the stock ``ImputerModel`` with exact lower medians."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        cols = self.getInputCols()
        medians = exact_medians(dataset, cols)
        empty = [c for c in cols if medians[c] is None]
        if empty:
            raise ValueError(f"no value to impute from in: {empty}")
        schema = StructType([StructField(c, DoubleType()) for c in cols])
        one_row = dataset.sparkSession.createDataFrame([tuple(medians[c] for c in cols)], schema)
        imputer = Imputer(strategy="median", inputCols=cols, outputCols=self.getOutputCols())
        return imputer.fit(one_row)
