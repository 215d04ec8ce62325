"""Classes of polarity and subjectivity scores."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodmart import fixed_values as V


def polarity_class(polarity: Column, band: float = V.NEUTRAL_BAND) -> Column:
    """Positive or negative outside the band, neutral on its edges, inside it and for scores outside -1 to 1 or NaN."""
    return (
        F.when((polarity < -band) & (polarity >= -1), "negative")
        .when((polarity > band) & (polarity <= 1), "positive")
        .otherwise("neutral")
    )


def subjectivity_class(subjectivity: Column) -> Column:
    return F.when(subjectivity.between(V.SUBJECTIVE_FROM, 1), "subjective").otherwise("objective")


def label_flag(label: Column, value: str) -> Column:
    """1 where the label has the value, 0 where it has another, null where it is null."""
    return (label == value).cast("long")
