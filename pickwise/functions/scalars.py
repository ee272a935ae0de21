"""Scalar column functions; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickwise.schemas import POSITIVE_THRESHOLD


def parse_json(message: Column, schema: StructType) -> Column:
    """JSON text (or bytes) to a struct; bad input gives NULL fields."""
    return F.from_json(message.cast("string"), schema)


def encode_json(*columns) -> Column:
    """Row to JSON text, NULL fields kept out as Spark writes them."""
    return F.to_json(F.struct(*columns))


def map_lookup(mapping: Mapping, key: Column) -> Column:
    """Literal dictionary lookup, NULL for missing keys; for small fixed dictionaries only."""
    pairs = [F.lit(part) for entry in mapping.items() for part in entry]
    return F.element_at(F.create_map(*pairs), key)


def feature_vector(*columns) -> Column:
    return F.array(*columns)


def join_list(values: Column, separator: str = ",") -> Column:
    return F.concat_ws(separator, values)


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit.cast("double")))


def format_id(value: Column, prefix: str = "ID_") -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def run_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd_HH-mm-ss")


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970. A time without time zone is read as UTC, whatever the session's."""
    day = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    clock = day * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return F.when(F.typeof(moment) == "timestamp", F.unix_timestamp(moment)).otherwise(clock)


def binarize(target: Column, threshold: float = POSITIVE_THRESHOLD) -> Column:
    """1 at or above the threshold, else 0; NULL and NaN count as 0."""
    reached = (target >= F.lit(threshold)) & ~F.isnan(target)
    return F.when(reached, F.lit(1)).otherwise(F.lit(0))


def fm_cross_term(vector: Column) -> Column:
    """Half of (square of the sum minus sum of the squares) over all entries of the vector."""
    zero = F.lit(0.0)
    total = F.aggregate(vector, zero, lambda acc, x: acc + x.cast("double"))
    squares = F.aggregate(
        vector, zero, lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.lit(0.5) * (total * total - squares)


def bce_with_logits(logit: Column, label: Column) -> Column:
    """Binary cross entropy of one row, in the overflow-safe form."""
    z = logit.cast("double")
    y = label.cast("double")
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - y * z
