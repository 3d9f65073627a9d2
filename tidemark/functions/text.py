"""Names, paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name of a schema file, without its extension.
SCHEMA_FILE_NAME = r"(Expect[A-Za-z]+)\.json"


def spaced(text: Column) -> Column:
    """Lower case with spaces for underscores."""
    return F.translate(F.lower(text), "_", " ")


def underscored(text: Column) -> Column:
    """Lower case with underscores for spaces."""
    return F.translate(F.lower(text), " ", "_")


def schema_name(path: Column) -> Column:
    """The schema's name in a file path; a path without one is an error."""
    name = F.regexp_extract(path, SCHEMA_FILE_NAME, 1)
    wrong = F.raise_error(F.concat(F.lit("no schema name in path "), path)).cast("string")
    return F.when(path.isNull(), F.lit(None)).when(name == "", wrong).otherwise(name)


def url_map(fields: Column) -> Column:
    """URLs of a record given as map<string,string>: non-null ``…url`` keys.

    ``_url`` is taken out of the key; two keys that become equal keep the later one,
    so the caller's map may hold both ``x`` and ``x_url`` forms.
    """
    urls = F.map_filter(fields, lambda k, v: k.endswith("url") & v.isNotNull())
    named = F.transform(
        F.map_entries(urls),
        lambda e: F.struct(F.replace(e["key"], F.lit("_url"), F.lit("")).alias("key"), e["value"].alias("value")),
    )
    # map_from_entries refuses equal keys, so only each key's last entry is kept.
    last_of_key = F.filter(
        named,
        lambda e, i: ~F.exists(
            F.slice(named, i + 2, F.greatest(F.size(named) - i - 1, F.lit(0))), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(last_of_key)


def without_params(url: Column) -> Column:
    """A URL template's text before its first ``{``."""
    return F.substring_index(url, "{", 1)


def pick_url(urls: Column, name: str = "url", with_params: bool = False) -> Column:
    """The named URL; a name the record does not have is an error."""
    found = F.try_element_at(urls, F.lit(name))
    names = F.concat_ws(", ", F.array_sort(F.map_keys(urls)))
    wrong = F.raise_error(F.concat(F.lit(f"no URL named {name}; there are: "), names)).cast("string")
    url = F.when(found.isNull(), wrong).otherwise(found)
    return url if with_params else without_params(url)
