"""Label expressions over the `labels` map of a metric sample."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(name: str, labels: str = "labels") -> Column:
    """The label's value; a missing label counts as the empty string."""
    return F.coalesce(F.try_element_at(F.col(labels), F.lit(name)), F.lit(""))


def label_equals(name: str, value: str) -> Column:
    return label(name) == F.lit(value)


def label_matches(name: str, pattern: str) -> Column:
    """Regex match on the whole label value, not on a part of it."""
    return label(name).rlike(rf"(?s)\A(?:{pattern})\z")


def label_map(pairs: dict[str, Column]) -> Column:
    """A label map that leaves out labels whose value is null or empty."""
    entries = F.create_map(*[part for name, value in pairs.items() for part in (F.lit(name), value.cast("string"))])
    return F.map_filter(entries, lambda _, value: value.isNotNull() & (value != ""))
