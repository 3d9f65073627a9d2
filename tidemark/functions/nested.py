"""Arrays, structs and maps, with Spark's higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import to_time

# Engine-name prefixes and the source class each stands for.
ENGINE_CLASSES = {"Pandas": "pandas", "Spark": "spark"}
OTHER_ENGINE_CLASS = "sql"


def pack(**fields: Column) -> Column:
    """A struct with the given field names."""
    return F.named_struct(*[part for name, col in fields.items() for part in (F.lit(name), col)])


def fold_to_int(values: Column) -> Column:
    """Sum of an array in bigint, returned as int; overflow is an error, empty is 0."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x).cast("int")


def none_if_empty(array: Column) -> Column:
    return F.when(F.array_size(array) > 0, array)


def sorted_lower(array: Column) -> Column:
    """Canonical form of a list of names: lower case, sorted, nulls last."""
    return F.array_sort(F.transform(array, F.lower))


def true_keys(flags: Column) -> Column:
    """Keys of a map<string,boolean> whose value is true, in map order."""
    return F.map_keys(F.map_filter(flags, lambda _, on: on))


def engine_classes(names: Column) -> Column:
    """Source class of each engine name; duplicates and order are kept."""

    def one(name: Column) -> Column:
        out = F.lit(OTHER_ENGINE_CLASS)
        for prefix, label in ENGINE_CLASSES.items():
            out = F.when(F.startswith(name, F.lit(prefix)), F.lit(label)).otherwise(out)
        return out

    return F.transform(names, one)


def times_in_struct(struct: Column, fields: list[str]) -> Column:
    """The struct's named text fields as timestamps."""
    return pack(**{f: to_time(struct[f]) for f in fields})
